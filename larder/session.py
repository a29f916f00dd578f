"""Session settings and the shared folder that cut lineages go to."""

from __future__ import annotations

import atexit
import tempfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from threading import Lock
from uuid import uuid4
from weakref import WeakKeyDictionary

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, Observation, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

#: Removes the shuffle files of a query at its end; else they stay until the driver happens to collect its garbage.
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(
    name: str = "larder",
    cores: str | int = "*",
    shuffle_partitions: int = 8,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the session.

    Only a local session without the setting gets a folder of its own; on a
    cluster a machine-local folder would be lost with the machine, so a
    missing setting is an error there.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_SETTING, None) or context.getConf().get(CHECKPOINT_SETTING)
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="larder-"))
    return context.getCheckpointDir()


def observed(observation: Observation, **otherwise) -> dict:
    """The values of an observation; ``otherwise`` if the planner knew the frame to be empty and left it out."""
    try:
        return observation.get
    except Py4JError:
        return otherwise


_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)
_released_at_exit: set[str] = set()
_pinned_at: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
_removing: WeakKeyDictionary[SparkSession, tuple[int, str | None]] = WeakKeyDictionary()  # how many are inside, the setting before
_one_setter = Lock()


def delete_folder(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def session_folder(spark: SparkSession) -> str:
    """The part of the shared folder that belongs to this session's application; removed when the process ends."""
    context = spark.sparkContext
    folder = f"{shared_folder(spark)}/pinned/{context.applicationId}"
    if folder not in _released_at_exit:
        _released_at_exit.add(folder)
        jvm = context._jvm

        def release() -> None:
            target = jvm.org.apache.hadoop.fs.Path(folder)
            target.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(target, True)

        atexit.register(_quietly, release)
    return folder


def _quietly(job: Callable[[], None]) -> None:
    try:
        job()
    except (Py4JError, OSError):  # the gateway is gone: the folder stays for whoever cleans the shared one
        pass


def release_pinned(spark: SparkSession) -> None:
    """Remove everything this session has pinned; frames that read it must have been consumed."""
    delete_folder(spark, session_folder(spark))


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A new folder that goes with the session."""
    return f"{session_folder(spark)}/{kind}-{uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Frames pinned inside are removed at the end; use where all work is done inside."""
    folder = f"{session_folder(spark)}/{uuid4().hex}"
    token = _scratch.set(folder)
    try:
        yield
    finally:
        _scratch.reset(token)
        delete_folder(spark, folder)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries started inside leave no shuffle files; for frames that are run once, such as what is written.

    Lanes of one session may be inside at the same time; the last one to leave restores the setting.
    """
    with _one_setter:
        inside, before = _removing.get(spark) or (0, spark.conf.get(CLEANUP_SETTING, None))
        _removing[spark] = (inside + 1, before)
        spark.conf.set(CLEANUP_SETTING, "true")
    try:
        yield
    finally:
        with _one_setter:
            inside, before = _removing.pop(spark)
            if inside > 1:
                _removing[spark] = (inside - 1, before)
            elif before is None:
                spark.conf.unset(CLEANUP_SETTING)
            else:
                spark.conf.set(CLEANUP_SETTING, before)


def pin(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and read it back from a table in the shared folder.

    Used where a frame is read several times.  It survives the loss of
    executors, can be read column by column, and its size on disk tells the
    planner whether a side is small enough to broadcast.
    """
    spark = df.sparkSession
    folder = _scratch.get() or session_folder(spark)
    path = f"{folder}/{uuid4().hex}"
    with shuffles_removed(spark):
        df.write.parquet(path)
    pinned = spark.read.schema(df.schema).parquet(path)
    _pinned_at[pinned] = path
    return pinned


def unpin(pinned: DataFrame) -> None:
    """Remove what :func:`pin` has written before its scratch ends; no frame made from it may be read any more."""
    path = _pinned_at.pop(pinned, None)
    if path:
        delete_folder(pinned.sparkSession, path)
