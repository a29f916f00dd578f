"""Objects for all tasks, sent by value so that executors need no copy of this package."""

from __future__ import annotations

import ctypes
import pickle
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import SparkSession

#: Rows of an Arrow batch: texts are some kilobytes, and both Spark and the Python process hold a batch.
BATCH_SETTING, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 500


def share(spark: SparkSession, value: object) -> Broadcast:
    """Broadcast an object whose size the caller has bounded."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def shared(block: Broadcast):
    """The object, in a task."""
    return pickle.loads(block.value)


def small_batches(spark: SparkSession) -> None:
    """Keep batches of texts small, unless the session says how large they are."""
    if spark.conf.get(BATCH_SETTING, "0") == "0":
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))


Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def tidy(run: Task) -> Task:
    """``run``, after which the process gives free memory back: it stays for later tasks, beside others."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
            if trim is not None:
                trim(0)

    return tidied


def gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches, several together: at least ``rows`` rows each, but for the last; for narrow rows."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
