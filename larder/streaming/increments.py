"""Landing folder to warehouse table, each file once.

The stream's checkpoint takes the place of the load state: it knows which files
were read.  A batch that is delivered again after a crash merges to the same
rows, because the last row of a key wins.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from larder.sources.store import Store


def landing_stream(
    spark: SparkSession,
    path: str,
    schema: str,
    file_format: str = "parquet",
    files_per_batch: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Files of a folder as a stream, read as they arrive."""
    reader = spark.readStream.schema(schema).options(**(options or {}))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.format(file_format).load(path)


def landed_page_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON pages of the delivery service as a stream."""
    return landing_stream(spark, path, schema, "json", options={"multiLine": "true"})


def stream_upsert(
    stream: DataFrame,
    store: Store,
    table: str,
    order: list[str],
    checkpoint: str,
    stage: Callable[[DataFrame], DataFrame] | None = None,
    on_fail: str = "quarantine",
    newest: bool = True,
) -> StreamingQuery:
    """Upsert everything new into ``table`` and stop.

    ``checkpoint`` must lie on storage that outlives the job.  ``stage`` shapes
    the rows of a batch into the table's columns.  Files may arrive late: with
    ``newest`` a row does not replace one with a later ``update_ts``, in tables
    that have it.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        rows = stage(batch) if stage else batch
        store.upsert(table, rows, order=order, on_fail=on_fail, newest=newest)

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
