"""Documents whose lookups are not all found wait for the parent key that is missing.

An incremental load reads the documents that have changed and those whose
parent has come since.  The latter are found in a narrow table with one row per
waiting document: the id of its staged row and the first parent key it lacks.
The new keys of the parents probe that table, so neither the documents nor the
target are searched, and with no new key nothing is read at all.  A document
that finds one parent and lacks another waits for that one.

A document that names no parent (NULL) waits for nothing: it must change to be
read again.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.session import pin
from larder.sources.store import Commit, Store


@dataclass(frozen=True)
class Reference:
    """A lookup: the parent table and its key, the key that a document names, the column that is NULL if not found."""

    parent: str
    key: str
    named: str
    found: str


@dataclass(frozen=True)
class Waiting:
    """The staged documents of a load, the table of those that wait, and what they refer to."""

    staged: str
    table: str
    references: tuple[Reference, ...]


#: What looked-up rows carry besides the columns of the references.
DOCUMENT_ID = ("object_id", "id AS staged_id")


def first_missing(references: tuple[Reference, ...]) -> Column:
    """The first parent key that was named and not found; NULL if all were found or one is not named."""
    named = reduce(lambda a, b: a & b, [F.col(one.named).isNotNull() for one in references])
    missing = [
        F.when(
            F.col(one.found).isNull(),
            F.struct(F.lit(one.parent).alias("parent"), F.col(one.named).cast("string").alias("parent_key")),
        )
        for one in references
    ]
    return F.when(named, F.coalesce(*missing))


def woken(waiting: DataFrame, parents: list[tuple[str, DataFrame]]) -> DataFrame:
    """The ids of staged rows that wait for one of the keys; ``parents`` are names and frames of one column."""
    keys = [
        rows.toDF("parent_key").select(F.lit(name).alias("parent"), F.col("parent_key").cast("string"))
        for name, rows in parents
    ]
    probed = reduce(DataFrame.unionByName, keys)
    # A semi join: keys need not be distinct, and a key many documents wait for is split like any hot key.
    return waiting.join(probed, ["parent", "parent_key"], "left_semi").select(F.col("staged_id").alias("id"))


def due(
    store: Store, waiting: Waiting, since: dict[str, int], now: dict[str, Commit], changed: DataFrame | None
) -> DataFrame | None:
    """The staged rows to read: those that changed and those whose parent has come; ``None`` if there are none.

    ``since`` and ``now`` say up to where each table was read and is read now.
    """
    parents = [
        (one.parent, store.changed_since(one.parent, since[one.parent], now[one.parent]).select(one.key))
        for one in waiting.references
        if now[one.parent].version != since[one.parent]
    ]
    if not parents:
        return changed
    ids = pin(woken(store.read(waiting.table), parents))
    if ids.isEmpty():
        return changed
    came = store.with_ids(waiting.staged, ids, now[waiting.staged])
    if changed is None:
        return came
    return changed.unionByName(came.join(changed.select("id"), "id", "left_anti").select(*changed.columns))


def keep(store: Store, waiting: Waiting, looked_up: DataFrame) -> None:
    """Keep which of the documents just read wait now, and let go of the others; ``looked_up`` is pinned."""
    state = looked_up.select("object_id", "staged_id", first_missing(waiting.references).alias("_for"))
    waits = state.filter("_for IS NOT NULL").select("object_id", "staged_id", "_for.parent", "_for.parent_key")
    settled = state.filter("_for IS NULL").select("object_id")
    if not store.empty(waiting.table):
        store.remove(waiting.table, settled)
    store.upsert(waiting.table, waits, order=["staged_id"])
