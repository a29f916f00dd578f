"""Lookups of dimension rows by natural key."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def resolve(
    facts: DataFrame,
    dimension: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str],
    how: str = "inner",
    large: bool = False,
) -> DataFrame:
    """Join ``facts`` to a dimension that is unique on its key.

    ``on`` maps fact columns to dimension columns, ``take`` maps result names
    to dimension columns.  There is no broadcast hint: the planner compares the
    measured size of the dimension with its limit and otherwise shuffles, where
    a hot key on the fact side is split by the adaptive skew join.

    ``large`` says that the dimension grows with the facts: both sides are
    shuffled and neither goes through the driver.  Without it the planner may
    take facts that are read out of documents, whose size it estimates far too
    low, for the small side of an inner join.
    """
    side = dimension.select(
        *[F.col(column).alias(f"_on_{name}") for name, column in on.items()],
        *[F.col(column).alias(name) for name, column in take.items()],
    )
    if large:
        side = side.hint("merge")
    condition = [F.col(name) == F.col(f"_on_{name}") for name in on]
    return facts.join(side, condition, how).drop(*[f"_on_{name}" for name in on])


def active_at(dimension: DataFrame, as_of: str) -> DataFrame:
    """Rows whose validity ends after ``as_of``; apply before an outer join."""
    return dimension.filter(F.col("active_to") > F.lit(as_of).cast("timestamp_ntz"))
