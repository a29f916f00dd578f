"""The two marts.

Both join the big tables on keys that are unique on one side, reduce to the
grain of the report, and only then look up what has few rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.money import (
    COURIER_SHARE,
    PAY_TIERS,
    PLATFORM_SHARE,
    PayTier,
    half_away_int,
    share_of,
    tiered_pay,
)
from larder.operators.lookup import active_at
from larder.plans.facts import CLOSED

# A sum of decimal(19,5); kept when sums are summed again, so that fees have
# room for all their digits.
_SUM = "decimal(29,5)"


def settlement_report(
    orders: DataFrame,
    sales: DataFrame,
    timestamps: DataFrame,
    restaurants: DataFrame,
    as_of: str,
    closed_status: str = CLOSED,
) -> DataFrame:
    """Closed orders per active restaurant and day, before validation.

    A day without sales has NULL sums; orders of a restaurant that is not
    active at ``as_of`` are summed under a NULL restaurant.
    """
    per_order = sales.groupBy("order_id").agg(
        F.sum("total_sum").alias("total"),
        F.sum("bonus_payment").alias("payment"),
        F.sum("bonus_grant").alias("granted"),
    )
    closed = orders.filter(F.col("order_status") == closed_status).select(
        "id", "restaurant_id", "timestamp_id"
    )
    days = timestamps.select(F.col("id").alias("timestamp_id"), "date")
    # An order has one restaurant and one day, so orders with sales can be
    # counted instead of counted distinct.
    sums = [
        F.sum("n").alias("n"),
        *[F.sum(name).cast(_SUM).alias(name) for name in ("total", "payment", "granted")],
    ]
    by_day = (
        closed.join(per_order, closed["id"] == per_order["order_id"], "left")
        .withColumn("n", F.when(F.col("order_id").isNotNull(), 1).otherwise(0))
        .join(days, "timestamp_id", "left")
        .groupBy("restaurant_id", "date")
        .agg(*sums)
    )
    return report_rows(by_day, restaurants, as_of)


def report_rows(by_day: DataFrame, restaurants: DataFrame, as_of: str) -> DataFrame:
    """Report rows from sums per restaurant and day; ``n`` counts the orders with sales."""
    sums = [
        F.sum("n").alias("n"),
        *[F.sum(name).cast(_SUM).alias(name) for name in ("total", "payment", "granted")],
    ]
    # The report's grain is reached; names are looked up on few rows.
    active = active_at(restaurants, as_of).select(
        F.col("id").alias("active_id"), "restaurant_name"
    )
    report = (
        by_day.join(active, by_day["restaurant_id"] == active["active_id"], "left")
        .groupBy("active_id", "restaurant_name", "date")
        .agg(*sums)
    )
    fee = share_of(F.col("total"), PLATFORM_SHARE)
    return report.select(
        F.col("active_id").cast("string").alias("restaurant_id"),
        "restaurant_name",
        F.col("date").alias("settlement_date"),
        F.col("n").cast("int").alias("orders_count"),
        F.col("total").alias("orders_total_sum"),
        F.col("payment").alias("orders_bonus_payment_sum"),
        F.col("granted").alias("orders_bonus_granted_sum"),
        fee.alias("order_processing_fee"),
        (F.col("total") - fee - F.col("payment")).alias("restaurant_reward_sum"),
    )


def courier_totals(deliveries: DataFrame, orders: DataFrame, timestamps: DataFrame) -> DataFrame:
    """Deliveries per courier and month of the order, with the unrounded average rate."""
    moments = orders.select(F.col("id").alias("order_id"), "timestamp_id")
    months = timestamps.select(F.col("id").alias("timestamp_id"), "year", "month")
    return (
        deliveries.select("order_id", "courier_id", "rate", "order_sum", "tip_sum")
        .join(moments, "order_id", "left")
        .join(months, "timestamp_id", "left")
        .groupBy("courier_id", "year", "month")
        .agg(
            F.count("order_id").alias("order_count"),
            F.sum("order_sum").alias("total"),
            F.avg(F.col("rate").cast("int")).alias("rate_avg"),
            F.sum("tip_sum").alias("tips"),
        )
    )


def courier_ledger(
    deliveries: DataFrame,
    orders: DataFrame,
    timestamps: DataFrame,
    tiers: tuple[PayTier, ...] = PAY_TIERS,
) -> DataFrame:
    """Monthly pay of the couriers, before validation."""
    return ledger_rows(courier_totals(deliveries, orders, timestamps), tiers)


def ledger_rows(totals: DataFrame, tiers: tuple[PayTier, ...] = PAY_TIERS) -> DataFrame:
    """Ledger rows from the sums per courier and month."""
    paid = totals.withColumn("pay", tiered_pay(F.col("rate_avg"), F.col("total"), tiers))
    return paid.select(
        F.col("courier_id").cast("string").alias("courier_id"),
        F.col("year").alias("settlement_year"),
        F.col("month").alias("settlement_month"),
        F.col("order_count").cast("int").alias("order_count"),
        F.col("total").alias("orders_total_sum"),
        half_away_int(F.col("rate_avg")).alias("rate_avg"),
        share_of(F.col("total"), PLATFORM_SHARE).alias("order_processing_fee"),
        F.col("pay").alias("courier_order_sum"),
        F.col("tips").alias("courier_tips_sum"),
        share_of(F.col("pay") + F.col("tips"), COURIER_SHARE).alias("courier_reward_sum"),
    )
