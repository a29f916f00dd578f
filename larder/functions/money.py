"""Fees, pay tiers and the rounding of amounts."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Share of the platform, share of pay and tips kept by a courier.
PLATFORM_SHARE = "0.25"
COURIER_SHARE = "0.95"


@dataclass(frozen=True)
class PayTier:
    """Pay for couriers whose average rate is at least ``from_rate``.

    If ``test_share`` of the order sums is above ``floor`` the courier gets
    ``pay_share`` of them, otherwise the floor.
    """

    from_rate: Decimal | None
    test_share: str
    pay_share: str
    floor: int


# Fixed values.  The two upper tiers test one share and pay another, so pay can
# be less than the floor; a corrected schedule is another list of tiers.
PAY_TIERS = (
    PayTier(None, "0.05", "0.05", 100),
    PayTier(Decimal("4"), "0.07", "0.07", 150),
    PayTier(Decimal("4.5"), "0.08", "0.07", 175),
    PayTier(Decimal("4.9"), "0.10", "0.07", 200),
)


def amount(number: str, kind: str) -> Column:
    return F.lit(Decimal(number)).cast(kind)


def share_of(total: Column, share: str) -> Column:
    return total * amount(share, "decimal(3,2)")


def tiered_pay(rate_avg: Column, total: Column, tiers: tuple[PayTier, ...] = PAY_TIERS) -> Column:
    """Pay by average rate and total, as decimal(27,7).

    ``rate_avg`` is the unrounded average as a double: the average of a decimal
    is rounded to four digits, which may lift it over a tier's edge.
    """
    ordered = sorted(
        tiers,
        key=lambda tier: (tier.from_rate is not None, tier.from_rate or 0),
        reverse=True,
    )
    pay = None
    for tier in ordered:
        floor = F.lit(tier.floor).cast("decimal(27,7)")
        earned = F.when(
            share_of(total, tier.test_share) > floor,
            share_of(total, tier.pay_share).cast("decimal(27,7)"),
        ).otherwise(floor)
        if tier.from_rate is None:
            # An unknown average belongs to no tier.
            reached = rate_avg.isNotNull()
        else:
            reached = rate_avg >= F.lit(float(tier.from_rate))
        pay = F.when(reached, earned) if pay is None else pay.when(reached, earned)
    return pay


def half_away_int(value: Column) -> Column:
    """Rounded to an integer, halves away from zero (a bare cast truncates)."""
    return F.round(value, 0).cast("int")
