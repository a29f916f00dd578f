"""Snapshot, incremental, paged and look-back reads.

A source is anything ``spark.read`` knows: ``Source("jdbc", {...})`` for the
bonus system, ``Source("mongodb", {...})`` for the order system (with that
connector on the class path), files for landed pages.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions.calendar import lookback_bounds

# Watermarks before the first load.
FIRST_ID = -1
FIRST_TS = "1900-01-01T00:00:00"


@dataclass(frozen=True)
class Source:
    """A named format with its options, and a schema where the format has none."""

    format: str
    options: Mapping[str, str] = field(default_factory=dict)
    path: str | None = None
    schema: str | None = None

    def load(self, spark: SparkSession) -> DataFrame:
        reader = spark.read.format(self.format).options(**self.options)
        if self.schema:
            reader = reader.schema(self.schema)
        return reader.load(self.path) if self.path else reader.load()


def jdbc(
    url: str,
    table: str,
    id_column: str | None = None,
    id_range: tuple[int, int] | None = None,
    partitions: int = 32,
    **options: str,
) -> Source:
    """A table behind JDBC, read by several tasks if the range of its ids is given."""
    settings = {"url": url, "dbtable": table, "fetchsize": "10000", **options}
    if id_column and id_range:
        settings |= {
            "partitionColumn": id_column,
            "lowerBound": str(id_range[0]),
            "upperBound": str(id_range[1]),
            "numPartitions": str(partitions),
        }
    return Source("jdbc", settings)


def landed_pages(path: str, schema: str) -> Source:
    """API pages kept as files, each one JSON array; reading the folder unites them."""
    return Source("json", {"multiLine": "true"}, path=path, schema=schema)


def snapshot(df: DataFrame, columns: list[str]) -> DataFrame:
    """The whole table, only the columns that are staged."""
    return df.select(*columns)


def after_id(df: DataFrame, watermark: int, column: str = "id") -> DataFrame:
    """Rows with an id above the watermark; the comparison reaches the scan."""
    return df.filter(F.col(column) > F.lit(watermark))


def after_ts(df: DataFrame, watermark: str = FIRST_TS, column: str = "update_ts") -> DataFrame:
    """Rows changed after the watermark (strictly: a row at the watermark was read before)."""
    return df.filter(F.col(column) > F.lit(watermark).cast("timestamp_ntz"))


def lookback(df: DataFrame, column: str, run_date: dt.date, days: int = 7) -> DataFrame:
    """Rows of the last ``days`` whole days before the run date."""
    start, end = lookback_bounds(run_date, days)
    return df.filter((F.col(column) >= start) & (F.col(column) < end))
