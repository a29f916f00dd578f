"""Sums per group that are kept: what changes is taken out of its old group and added to its new one.

Two tables belong to a rollup.  The images hold, per counted thing, the group
and the amounts it was last counted with; the totals hold the sums per group.
An increment brings the new images of the things it touches.  Their old images
are found through the index of the table, so no other thing is read; the
difference of both is summed per group (on the map side first, whatever a group
holds) and added to the totals of the touched groups alone.

The two tables are committed one after the other: a load that breaks off in
between leaves versions that it has not kept, and must start both anew.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.schemas import ALL_TABLES
from larder.session import pin
from larder.sources.store import Store


@dataclass(frozen=True)
class Rollup:
    """``sums`` are additive columns of both tables; the first counts what a group holds, 0 means that it is empty."""

    images: str
    totals: str
    group: tuple[str, ...]
    sums: tuple[str, ...]

    @property
    def key(self) -> list[str]:
        return list(ALL_TABLES[self.images].key)


def _summed(rows: DataFrame, rollup: Rollup) -> DataFrame:
    types = ALL_TABLES[rollup.totals].columns
    return rows.groupBy(*rollup.group).agg(*[F.sum(name).cast(types[name]).alias(name) for name in rollup.sums])


def differences(rollup: Rollup, after: DataFrame, before: DataFrame) -> DataFrame:
    """What the groups gain or lose, without those whose sums stay."""
    columns = [*rollup.group, *rollup.sums]
    taken = before.select(*rollup.group, *[(-F.col(name)).alias(name) for name in rollup.sums])
    moved = reduce(lambda a, b: a | b, [F.col(name) != 0 for name in rollup.sums])
    return _summed(after.select(*columns).unionByName(taken), rollup).filter(moved)


def fold(store: Store, rollup: Rollup, after: DataFrame) -> DataFrame:
    """Count the things of ``after`` (pinned, one row per key) anew; the new sums of the groups that differ.

    A group that is left with nothing is returned with a count of 0 and is no
    longer among the totals.
    """
    before = store.with_keys(rollup.images, after.select(*rollup.key))
    change = pin(differences(rollup, after, before))
    kept = store.with_keys(rollup.totals, change.select(*rollup.group))
    now = pin(_summed(kept.select(*change.columns).unionByName(change), rollup))
    empty = F.col(rollup.sums[0]) == 0
    # A NULL would be left out of the sums: it stops the load.
    store.upsert(rollup.images, after, order=rollup.key, on_fail="abort")
    store.upsert(rollup.totals, now.filter(~empty), order=list(rollup.group), on_fail="abort")
    if not store.empty(rollup.totals):
        store.remove(rollup.totals, now.filter(empty).select(*rollup.group))
    return now
