"""Dense numbers for rows in a given order, without one task seeing them all."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.session import pin

# monotonically_increasing_id() keeps the row position in the low 33 bits and
# the partition number above them.
_POSITION_BITS = 33


def number_rows(
    df: DataFrame, order: list[str | Column], start: int = 0, into: str = "id"
) -> DataFrame:
    """Number rows ``start + 1, start + 2, ...`` in ``order`` (must be unique).

    Rows are range partitioned, sorted and written to the shared folder with
    their partition and their position in it.  Written, they stay the rows that
    were counted; the range bounds come from a sample and may fall differently
    when computed again.  A row's number is its position plus the size of the
    partitions before it, and only those sizes, one per partition, reach the
    driver.
    """
    ordered = [F.col(item) if isinstance(item, str) else item for item in order]
    ranged = df.repartitionByRange(*ordered).sortWithinPartitions(*ordered)
    placed = pin(ranged.withColumn("_spot", F.monotonically_increasing_id()))
    part = F.shiftright("_spot", _POSITION_BITS).cast("int")
    position = F.col("_spot").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))

    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("n"))
    counted = sorted(sizes.collect())
    starts = accumulate((row["n"] for row in counted), initial=start + 1)
    # One row per partition, so the size of the broadcast is known.
    offsets = df.sparkSession.createDataFrame(
        [(row["_part"], first) for row, first in zip(counted, starts)],
        "_part int, _offset bigint",
    )
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(into, position + F.col("_offset"))
        .drop("_spot", "_part", "_offset")
    )
