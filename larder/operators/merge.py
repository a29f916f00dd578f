"""Keyed merge of a batch into a table (insert, or replace on conflict)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.operators.numbering import number_rows
from larder.session import pin


def last_per_key(batch: DataFrame, key: list[str], order: list[str | Column]) -> DataFrame:
    """The last row of every key in ascending ``order``.

    The rank filter is applied before the shuffle as well, so of a hot key one
    row per task travels.
    """
    latest = [
        (F.col(item) if isinstance(item, str) else item).desc_nulls_last() for item in order
    ]
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*latest))
    return batch.withColumn("_place", place).filter("_place = 1").drop("_place")


def copies_per_key(batch: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once, with the number of rows."""
    return batch.groupBy(*key).agg(F.count("*").alias("copies")).filter("copies > 1")


def split_conflicts(
    batch: DataFrame, key: list[str], distinct: bool = False, repeated: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows fit for a set-based upsert, and the rows of keys that are in conflict.

    A set-based upsert must not meet a key twice.  With ``distinct``, rows
    equal in all columns count as one.  Keys are counted by themselves
    (``repeated``, if that was done before), so rows of keys that occur once
    are not shuffled for this; pass a pinned frame, because it is read several
    times.
    """
    repeated = (copies_per_key(batch, key) if repeated is None else repeated).select(*key)
    single = batch.join(repeated, key, "left_anti").select(*batch.columns)
    several = batch.join(repeated, key, "left_semi").select(*batch.columns)
    if not distinct:
        return single, several
    several = several.distinct()
    differing = copies_per_key(several, key).select(*key)
    equal = several.join(differing, key, "left_anti").select(*batch.columns)
    conflicts = several.join(differing, key, "left_semi").select(*batch.columns)
    return single.unionByName(equal), conflicts


def match_rows(
    incoming: DataFrame, current: DataFrame, key: list[str], surrogate: str | None
) -> DataFrame:
    """Keys both sides have, with the surrogate key and whether any other column differs."""
    rest = [name for name in incoming.columns if name not in key]
    old = current.select(*key, *([surrogate] if surrogate else []), F.struct(*rest).alias("_old"))
    new = incoming.select(*key, F.struct(*rest).alias("_new"))
    differs = ~F.col("_old").eqNullSafe(F.col("_new"))
    return old.join(new, key).withColumn("changed", differs).drop("_old", "_new")


def with_surrogate(
    incoming: DataFrame,
    current: DataFrame,
    key: list[str],
    surrogate: str = "id",
    start: int | None = None,
    only_changed: bool = False,
) -> DataFrame:
    """Give rows the surrogate key the table has for them, new rows the next ones.

    ``start`` is the highest surrogate key in use; it is read from ``current``
    if not given.  ``incoming`` has one row per key and no surrogate column.
    ``only_changed`` leaves out rows the table already has as they are.
    """
    columns = [surrogate, *incoming.columns]
    # Never more rows than came in; a small batch is broadcast to the table's
    # scan, which then needs no shuffle.
    matched = pin(match_rows(incoming, current, key, surrogate))
    wanted = matched.filter("changed") if only_changed else matched
    known = incoming.join(wanted, key).select(*columns)
    fresh = incoming.join(matched, key, "left_anti").select(*incoming.columns)
    if fresh.isEmpty():
        return known
    if start is None:
        start = current.agg(F.max(surrogate)).first()[0] or 0
    numbered = number_rows(fresh, list(key), start=start, into=surrogate)
    return known.unionByName(numbered.select(*columns))


def merge_rows(current: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``current`` without a match in ``incoming``, plus all of ``incoming``.

    Both have one row per key and the same columns.
    """
    kept = current.join(incoming.select(*key), key, "left_anti")
    return kept.select(*current.columns).unionByName(incoming.select(*current.columns))


def upsert(
    current: DataFrame,
    batch: DataFrame,
    key: list[str],
    order: list[str | Column],
    surrogate: str | None = None,
) -> DataFrame:
    """Upsert a batch whose last row per key wins; known rows keep their surrogate key."""
    incoming = last_per_key(batch, key, order)
    if surrogate:
        incoming = with_surrogate(incoming, current, key, surrogate)
    return merge_rows(current, incoming, key)
