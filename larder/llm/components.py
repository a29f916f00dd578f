"""Connected components of a graph given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from larder.session import pin

#: Rows of a pinned list of a few numbers each, at most, for it to be broadcast; entries of arrays count as rows.
BROADCAST_ROWS = 250_000

#: Bits of the sieve for longer lists, 64 in a row.
SIEVE_BITS = 1 << 24

#: Rows of a graph that a task of a round is meant for.
TASK_ROWS = 1 << 18


def few(pinned: DataFrame) -> bool:
    """Whether a pinned narrow list is short enough to be broadcast."""
    rows = F.lit(1)
    for column in pinned.schema:
        if isinstance(column.dataType, ArrayType):
            rows = rows + F.coalesce(F.size(column.name), F.lit(0))
    return (pinned.agg(F.sum(rows).alias("rows")).first()["rows"] or 0) <= BROADCAST_ROWS


def listed(pinned: DataFrame) -> DataFrame:
    """A pinned narrow list, to be broadcast in joins if its counted rows are few; a longer one is merged, whatever its size on disk."""
    return F.broadcast(pinned) if few(pinned) else pinned.hint("merge")


def sifted(rows: DataFrame, column: str, pinned: DataFrame, number: str) -> DataFrame:
    """``rows`` with ``_maybe``: false only where ``column`` is not among the ``number`` of a pinned list, true for few of the others.

    The list is broadcast as bits of a fixed size, whatever its length, so that
    rows that it surely does not hold need no shuffle.
    """

    def bit(name: str):
        place = F.pmod(F.xxhash64(F.col(name).cast("long")), F.lit(SIEVE_BITS))
        return F.shiftrightunsigned(place, 6), place.bitwiseAND(F.lit(63)).cast("int")

    word, at = bit(number)
    kept = pinned.select(word.alias("_word"), F.call_function("shiftleft", F.lit(1).cast("long"), at).alias("_bits"))
    kept = pin(kept.groupBy("_word").agg(F.bit_or("_bits").alias("_bits")))
    word, at = bit(column)
    found = rows.join(F.broadcast(kept), word == F.col("_word"), "left")
    return found.withColumn("_maybe", F.coalesce(F.getbit("_bits", at) == 1, F.lit(False))).drop("_word", "_bits")


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, its smallest reachable node, for every node of the links ``a``, ``b``.

    Every round takes the smallest label among a node's neighbours and then
    the label of that label, so that the number of rounds grows with the
    logarithm of the longest path.  Labels are written after every round;
    only the number of changes reaches the driver.
    """
    ways = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = pin(links.filter("a <> b").select(F.inline(ways)))
    # as many tasks as the counted rows need; a round over few rows would take its time in starting tasks and writing files
    tasks = max(both.sparkSession.sparkContext.defaultParallelism, -(-both.count() // TASK_ROWS))
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).coalesce(tasks)
    labels = pin(labels.select("node", F.least("node", "least").alias("component")))
    if labels.isEmpty():
        return labels
    while True:
        held = listed(labels)
        seen = both.join(held, both["b"] == held["node"]).groupBy("a").agg(F.min("component").alias("least")).coalesce(tasks)
        nearer = seen.join(held, seen["a"] == held["node"]).select(
            "node", F.least("component", "least").alias("component"), F.col("component").alias("before")
        )
        jump = held.select(F.col("node").alias("_node"), F.col("component").alias("_next"))
        moved = nearer.join(jump, nearer["component"] == jump["_node"]).select(
            "node", F.least("component", "_next").alias("component"), "before"
        )
        changed = Observation()
        moved = pin(moved.observe(changed, F.count_if(F.col("component") != F.col("before")).alias("n")))
        if not changed.get["n"]:
            return moved.select("node", "component")
        labels = moved.select("node", "component")
