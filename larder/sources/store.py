"""Versioned parquet tables: a batch becomes visible as a whole or not at all.

Plain parquet has no MERGE.  A table is a set of buckets, ranges of its ``id``.
A row keeps its id, so it stays in its bucket; new rows go to the newest ones.
Beside the rows there is a narrow index of key, id and hash of the row, laid
out by hash of the key: a batch is matched with the index parts of its keys
alone, whatever the size of the table and the width of its rows.

An upsert leaves out rows that are stored as they come, rewrites the buckets
and index parts of the others under a new folder and then writes one small file
named by the version.  Readers take the folders that the highest version names,
so a failed write is never seen.  Folders that neither of the last two versions
names are removed.  A second writer finds the file of its version there and is
refused.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass, field, replace
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from larder.operators import merge, quality
from larder.operators.numbering import number_rows
from larder.schemas import ALL_TABLES, TABLES, WORKING_TABLES, Table
from larder.session import delete_folder, observed, pin, scratch, shuffles_removed, unpin

HASH, STAMP = "row_hash", "update_ts"
HASH_BYTES = 16  # of SHA-256; rows are compared under one key only, so no two of a table need to differ
SLICE, SLICES = "_slice", 16  # slices that a bucket or index part is merged by
PASSES, PASS_BYTES = 8, 512 * 2**20  # buckets or index parts above this size are merged in several passes


def _content_hash(table: Table) -> Column:
    content = F.to_json(F.struct(*table.payload), {"ignoreNullFields": "false"})
    return F.substring(F.unhex(F.sha2(content, 256)), 1, HASH_BYTES)


def _write(frame: DataFrame, path: str, by: str | None = None) -> None:
    """Add a frame to a folder; its shuffle files go at once."""
    writer = frame.write.mode("append").option("compression", "zstd")
    with shuffles_removed(frame.sparkSession):
        (writer.partitionBy(by) if by else writer).parquet(path)


class SecondWriter(RuntimeError):
    """Raised when another writer has committed the version that a load was about to commit."""


@dataclass(frozen=True)
class Commit:
    """What a version consists of: the version that wrote every filled bucket and index part.

    ``span`` is the range of ids of a bucket and ``parts`` the number of index
    parts, both fixed when the table is created; ``max_id`` is the highest id
    handed out, ``folders`` the folder of every version that is referred to and
    ``created`` the version that started the table empty.
    """

    version: int
    span: int
    buckets: dict[int, int]
    max_id: int
    parts: int = 1
    keys: dict[int, int] = field(default_factory=dict)
    folders: dict[int, str] = field(default_factory=dict)
    created: int = 0


@dataclass(frozen=True)
class LoadResult:
    """Row counts of one load: received = rejected + loaded + superseded.

    ``superseded`` rows gave way to a later row of their key, in the batch or
    in the table, or are one of several equal rows; ``changed`` are the loaded
    rows that were new or different; ``skipped`` rows the source gave lie
    outside of what the load asks for.  ``watermark`` is the highest value of
    the watermark column among the rows this load has read, not among what the
    source holds by now.
    """

    table: str
    received: int
    rejected: int
    loaded: int
    changed: int
    watermark: str | None = None
    superseded: int = 0
    skipped: int = 0


class Store:
    def __init__(self, spark: SparkSession, root: str, span: int = 1_000_000, parts: int = 16):
        """``span`` rows make up a bucket, choose it so that a bucket has about 1 GB; ``parts`` likewise for the index."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.span = span
        self.parts = parts

    # -- layout ---------------------------------------------------------------

    def _commits_path(self, table: Table) -> str:
        return f"{self.root}/commits/{table.name}"

    def _data_path(self, table: Table) -> str:
        return f"{self.root}/data/{table.name}"

    def _rejected_path(self, table: Table, version: int, kind: str = "rejected") -> str:
        return f"{self.root}/{kind}/{table.name}/version={version}"

    @staticmethod
    def _bucket(commit: Commit) -> Column:
        return F.floor(F.col("id") / F.lit(commit.span)).cast("bigint")

    @staticmethod
    def _part(table: Table, commit: Commit) -> Column:
        return F.pmod(F.xxhash64(*table.key), F.lit(commit.parts)).cast("int")

    @staticmethod
    def _index_ddl(table: Table) -> str:
        columns = dict.fromkeys([*table.key, "id"])
        ddl = ", ".join(f"{name} {table.columns[name]}" for name in columns)
        return f"{ddl}, {HASH} binary" + (f", {STAMP} timestamp_ntz" if STAMP in table.columns else "")

    # -- files ----------------------------------------------------------------

    def _at(self, path: str):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()), target

    def _has(self, path: str) -> bool:
        system, target = self._at(path)
        return system.exists(target)

    def _names(self, path: str) -> list[str]:
        system, target = self._at(path)
        return [found.getPath().getName() for found in system.listStatus(target)] if system.exists(target) else []

    # -- commits --------------------------------------------------------------

    def create(self, tables: Iterable[str] | None = None) -> None:
        """Start every table empty, or those named; earlier versions are no longer referred to."""
        if tables is None:
            tables = [*TABLES, *[name for name, table in WORKING_TABLES.items() if self.exists(table)]]
        for name in tables:
            table = ALL_TABLES[name]
            version = self.last_commit(table).version + 1 if self.exists(table) else 0
            self._commit(table, Commit(version, self.span, {}, 0, self.parts, created=version))

    def _versions(self, table: Table) -> list[int]:
        names = self._names(self._commits_path(table))
        return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json") and name[0] != ".")

    def exists(self, table: Table) -> bool:
        return bool(self._versions(table))

    def _read_commit(self, table: Table, version: int) -> Commit:
        system, target = self._at(f"{self._commits_path(table)}/{version:012d}.json")
        stream = system.open(target)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        values = json.loads(text)
        for name in ("buckets", "keys", "folders"):
            values[name] = {int(key): value for key, value in values[name].items()}
        return Commit(**values)

    def last_commit(self, table: Table) -> Commit:
        return self._read_commit(table, self._versions(table)[-1])

    def _commit(self, table: Table, commit: Commit) -> None:
        system, target = self._at(f"{self._commits_path(table)}/{commit.version:012d}.json")
        if system.exists(target):
            raise SecondWriter(f"{table.name}: version {commit.version} is already there")
        stream = system.create(target, False)  # fails if another writer was faster
        stream.write(bytearray(json.dumps(asdict(commit)).encode()))
        stream.close()
        self._forget(table, commit)

    def _forget(self, table: Table, commit: Commit) -> None:
        """Remove what the last two versions do not name."""
        versions = self._versions(table)
        kept = [commit] + [self._read_commit(table, v) for v in versions[-2:-1]]
        folders = {folder for one in kept for folder in one.folders.values()}
        for folder in self._names(self._data_path(table)):
            written = int(folder.split("-")[0].removeprefix("version="))
            if folder not in folders and written <= commit.version:
                delete_folder(self.spark, f"{self._data_path(table)}/{folder}")
        for version in versions[:-2]:
            old = self._read_commit(table, version)
            for kind in ("buckets", "keys"):
                live = {(item, one.folders[v]) for one in kept for item, v in getattr(one, kind).items()}
                for item, v in getattr(old, kind).items():
                    if (item, old.folders[v]) not in live and old.folders[v] in folders:
                        delete_folder(self.spark, self._folder(table, old, kind, item))
            delete_folder(self.spark, f"{self._commits_path(table)}/{version:012d}.json")

    def _folder(self, table: Table, commit: Commit, kind: str, item: int) -> str:
        version = getattr(commit, kind)[item]
        name = {"buckets": "bucket", "keys": "part"}[kind]
        return f"{self._data_path(table)}/{commit.folders[version]}/{kind}/{name}={item}"

    # -- reading --------------------------------------------------------------

    def read(self, name: str, at: Commit | None = None, only: Iterable[int] | None = None) -> DataFrame:
        """The current rows of a table, or those of a commit; ``only`` those of some buckets."""
        return self._read(ALL_TABLES[name], at or self.last_commit(ALL_TABLES[name]), only)

    def bucket(self, name: str, at: Commit | None = None) -> Column:
        """The bucket of a row by its ``id``; it stays the same for as long as the table is there."""
        return self._bucket(at or self.last_commit(ALL_TABLES[name]))

    def empty(self, name: str) -> bool:
        """Whether a table has no rows; its last commit tells."""
        return not self.last_commit(ALL_TABLES[name]).buckets

    def _read(
        self, table: Table, commit: Commit, only: Iterable[int] | None = None, kind: str = "buckets"
    ) -> DataFrame:
        filled = getattr(commit, kind)
        wanted = set(filled) if only is None else set(only) & set(filled)
        ddl = table.ddl if kind == "buckets" else self._index_ddl(table)
        paths = [self._folder(table, commit, kind, item) for item in sorted(wanted)]
        if not paths:
            return self.spark.createDataFrame([], ddl)
        return self.spark.read.schema(ddl).parquet(*paths)

    def changed_since(self, name: str, version: int, up_to: Commit | None = None) -> DataFrame:
        """The current rows that are new or different since a version; all rows if the table was created after it.

        Only the buckets of changed ids are read.  ``up_to`` is a commit held
        by the reader: later commits of the table do not disturb it.
        """
        table = ALL_TABLES[name]
        commit = up_to or self.last_commit(table)
        if version < commit.created:
            return self._read(table, commit)
        paths = [self._rejected_path(table, v, "changes") for v in range(version + 1, commit.version + 1)]
        paths = [path for path in paths if self._has(path)]
        if not paths:
            return self.spark.createDataFrame([], table.ddl)
        ids = self.spark.read.schema("id bigint").parquet(*paths).distinct()
        return self.with_ids(name, ids, commit)

    def with_ids(self, name: str, ids: DataFrame, at: Commit | None = None) -> DataFrame:
        """The rows of the ids in column ``id``, read from the buckets of these ids alone."""
        table = ALL_TABLES[name]
        commit = at or self.last_commit(table)
        touched = {row["bucket"] for row in ids.select(self._bucket(commit).alias("bucket")).distinct().collect()}
        rows = self._read(table, commit, only=touched)  # the buckets of an increment are few
        return rows.join(ids.select(F.col("id").alias("_wanted")), F.col("id") == F.col("_wanted"), "left_semi")

    def with_keys(self, name: str, keys: DataFrame, at: Commit | None = None) -> DataFrame:
        """The rows of some keys, found through the index."""
        table = ALL_TABLES[name]
        commit = at or self.last_commit(table)
        return self.with_ids(name, pin(self._entries(table, commit, pin(keys)).select("id")), commit)

    def _entries(self, table: Table, commit: Commit, keys: DataFrame) -> DataFrame:
        """The index entries of some keys."""
        key = list(table.key)
        slots = keys.select(self._part(table, commit).alias("part")).distinct().collect()  # at most one row per part
        index = self._read(table, commit, only={row["part"] for row in slots}, kind="keys")
        return index.join(keys.select(*key), key, "left_semi")

    def rejected(self, name: str, version: int | None = None) -> DataFrame:
        """Rows the rules kept out of one version, with the reasons."""
        table = ALL_TABLES[name]
        columns = ", ".join(f"{column} {table.columns[column]}" for column in table.payload)
        return self._rejected(table, version, columns, "rejected")

    def rejected_documents(self, name: str, version: int | None = None) -> DataFrame:
        """Source documents of one version that gave no rows, with the reasons."""
        return self._rejected(ALL_TABLES[name], version, quality.DOCUMENT, "rejected_documents")

    def _rejected(self, table: Table, version: int | None, columns: str, kind: str) -> DataFrame:
        version = self.last_commit(table).version if version is None else version
        ddl = f"{columns}, {quality.REASONS} array<string>"
        path = self._rejected_path(table, version, kind)
        if not self._has(path):
            return self.spark.createDataFrame([], ddl)
        return self.spark.read.schema(ddl).parquet(path)

    # -- writing --------------------------------------------------------------

    def upsert(
        self,
        name: str,
        batch: DataFrame,
        order: list[str] | None = None,
        distinct: bool = False,
        on_fail: str = "quarantine",
        bounds: dict | None = None,
        watermark: str | None = None,
        broken: DataFrame | None = None,
        newest: bool = False,
        foreign: bool = True,
    ) -> LoadResult:
        """Merge a batch into a table.

        With ``order`` a key may come several times and its last row wins.
        Without, it is a set-based upsert: such keys are in conflict, except
        for equal rows if ``distinct``.  Columns only used for the order are
        dropped.  ``broken`` are documents that gave no rows
        (:data:`quality.DOCUMENT` and reasons); they count as received and
        rejected.  With ``newest`` a row does not replace one with a later
        ``update_ts``.  ``foreign`` checks foreign keys; rows made by lookups
        in the parents need no check.
        """
        table = ALL_TABLES[name]
        with scratch(self.spark):
            return self._upsert(
                table, batch, order, distinct, on_fail, bounds, watermark, broken, newest and STAMP in table.columns, foreign
            )

    def _upsert(self, table, batch, order, distinct, on_fail, bounds, watermark, broken, newest, foreign) -> LoadResult:
        key = list(table.key)
        commit = self.last_commit(table)
        version = commit.version + 1
        seen, judged = Observation(), Observation()
        rows = batch.observe(seen, F.count("*").alias("rows"))
        if order:
            rows = merge.last_per_key(rows, key, order)
        flagged = quality.flag_rows(rows.select(*table.payload), table, bounds)
        for link in table.foreign if foreign else ():
            parent = ALL_TABLES[link.parent]
            if self.exists(parent):
                flagged = quality.flag_orphans(flagged, link, self.read(parent.name))
        flagged = flagged.withColumn("_slot", self._part(table, commit))
        highest = F.max(watermark).cast("string") if watermark else F.lit(None).cast("string")
        flagged = pin(
            flagged.observe(
                judged,
                F.count("*").alias("rows"),
                F.count_if(F.size(quality.REASONS) > 0).alias("refused"),
                highest.alias("highest"),
                F.collect_set("_slot").alias("parts"),
            )
        )
        received = observed(seen, rows=0)["rows"]
        found = observed(judged, rows=0, refused=0, highest=None, parts=[])
        good, rejected = quality.split(flagged)
        rejected = rejected.drop("_slot")
        refused, loaded = found["refused"], found["rows"] - found["refused"]
        held = flagged
        if not order:
            kept = self._without_conflicts(good, rejected, key, distinct, refused, loaded)
            if kept[0] is not good:
                unpin(flagged)
                held = kept[0]
            good, rejected, refused, loaded = kept
        if on_fail == "abort":
            quality.refuse(rejected, table.name)
        if refused:
            with shuffles_removed(self.spark):
                rejected.write.mode("overwrite").parquet(self._rejected_path(table, version))
        documents = self._set_aside(table, broken, version, on_fail)

        new, changed, stale = replace(commit, version=version), 0, 0
        if loaded:
            new, changed, stale = self._rewrite(table, good, held, commit, new, found["parts"], newest, loaded)
        if changed or refused or documents:
            self._commit(table, new)
        superseded = received - refused - loaded + stale
        return LoadResult(
            table.name, received + documents, refused + documents, loaded - stale, changed, found["highest"], superseded
        )

    def remove(self, name: str, keys: DataFrame) -> int:
        """Remove the rows of some keys; how many there were."""
        table, key = ALL_TABLES[name], list(ALL_TABLES[name].key)
        with scratch(self.spark):
            commit = self.last_commit(table)
            found = self._entries(table, commit, pin(keys.select(*key))).select(*key, "id")
            found = pin(found.withColumn("part", self._part(table, commit)).withColumn("bucket", self._bucket(commit)))
            counts = found.groupBy("bucket").agg(F.count("*").alias("n"), F.collect_set("part").alias("parts")).collect()
            if not counts:
                return 0
            touched = {row["bucket"] for row in counts}
            parts = {part for row in counts for part in row["parts"]}

            def rows(some: list[int]) -> DataFrame:
                return self._read(table, commit, only=some).join(found.select("id"), "id", "left_anti")

            def index(some: list[int]) -> DataFrame:
                return self._read(table, commit, only=some, kind="keys").join(found.select(*key), key, "left_anti")

            new = replace(commit, version=commit.version + 1)
            self._commit(table, self._laid_out(table, commit, new, rows, index, touched, parts))
        return sum(row["n"] for row in counts)

    def _passes(self, table: Table, commit: Commit, kind: str, items: Iterable[int], incoming: int = 0) -> list[list[int]]:
        """The buckets or index parts that are merged together: the shuffle files of a pass go before the next one.

        As many as the stored files and the ``incoming`` rows, at some 64 bytes, ask for.
        """
        size = incoming * 64
        for item in set(items) & set(getattr(commit, kind)):
            system, target = self._at(self._folder(table, commit, kind, item))
            size += system.getContentSummary(target).getLength()
        ordered = sorted(items)
        n = max(1, min(PASSES, len(ordered), -(-size // PASS_BYTES)))
        return [ordered[k::n] for k in range(n)]

    def _laid_out(
        self,
        table: Table,
        commit: Commit,
        new: Commit,
        rows: Callable[[list[int]], DataFrame],
        index: Callable[[list[int]], DataFrame],
        touched: set,
        parts: set,
        sorted_by_id: bool = False,
        incoming: int = 0,
    ) -> Commit:
        """Write the touched buckets and index parts anew; those left without rows are named no more.

        ``rows`` and ``index`` give what some of the buckets and of the parts shall hold.
        """
        folder = f"version={new.version}-{uuid4().hex[:8]}"
        path = f"{self._data_path(table)}/{folder}"
        # Rows that lie in the order of their ids are not shuffled.
        for some in [sorted(touched)] if sorted_by_id else self._passes(table, commit, "buckets", touched, incoming):
            found = rows(some).withColumn("bucket", self._bucket(commit))
            if not sorted_by_id and SLICE not in found.columns:
                # One bucket per task, large buckets split by their measured size.
                found = found.hint("rebalance", "bucket")
            _write(found.drop(SLICE), f"{path}/buckets", "bucket")
        for some in self._passes(table, commit, "keys", parts, incoming):
            found = index(some).withColumn("part", self._part(table, commit))
            if SLICE not in found.columns:
                found = found.hint("rebalance", "part")
            _write(found.drop(SLICE), f"{path}/keys", "part")

        def named(old: dict[int, int], written: set, kind: str) -> dict[int, int]:
            filled = {int(name.split("=")[1]) for name in self._names(f"{path}/{kind}") if "=" in name}
            return {item: v for item, v in old.items() if item not in written} | dict.fromkeys(filled, new.version)

        buckets, keys = named(commit.buckets, touched, "buckets"), named(commit.keys, parts, "keys")
        used = {*buckets.values(), *keys.values()}
        folders = {v: f for v, f in {**commit.folders, new.version: folder}.items() if v in used}
        return replace(new, buckets=buckets, keys=keys, folders=folders)

    @staticmethod
    def _merged(current: DataFrame, incoming: DataFrame, key: list[str], part: Column) -> DataFrame:
        """Rows of both, those of ``incoming`` in place of rows with their key; shuffled once, by slices of what is written together.

        Every slice lies in one bucket or index part, so the rows stay where
        they are to be written.
        """
        both = current.withColumn("_fresh", F.lit(False)).unionByName(incoming.withColumn("_fresh", F.lit(True)))
        place = F.row_number().over(Window.partitionBy(SLICE, *key).orderBy(F.desc("_fresh")))
        sliced = both.withColumn(SLICE, part.cast("bigint")).repartition(SLICE)
        return sliced.withColumn("_place", place).filter("_place = 1").drop("_place", "_fresh")

    def _hashed(self, table: Table, rows: DataFrame) -> DataFrame:
        """Index entries of rows; hashes do not compress, so they are made last and travel once."""
        columns = [name.split()[0] for name in self._index_ddl(table).split(", ")]
        return rows.withColumn(HASH, _content_hash(table)).select(*columns)

    def _set_aside(self, table: Table, broken: DataFrame | None, version: int, on_fail: str) -> int:
        """Keep documents that gave no rows; their number."""
        if broken is None:
            return 0
        if on_fail == "abort":
            quality.refuse(broken, table.name)
        seen, path = Observation(), self._rejected_path(table, version, "rejected_documents")
        with shuffles_removed(self.spark):
            broken.observe(seen, F.count("*").alias("rows")).write.mode("overwrite").parquet(path)
        return observed(seen, rows=0)["rows"]

    def _without_conflicts(
        self, good: DataFrame, rejected: DataFrame, key: list[str], distinct: bool, refused: int, loaded: int
    ) -> tuple[DataFrame, DataFrame, int, int]:
        seen = Observation()
        repeated = pin(merge.copies_per_key(good, key).observe(seen, F.count("*").alias("keys")))
        if not observed(seen, keys=0)["keys"]:
            return good, rejected, refused, loaded
        good, conflicts = merge.split_conflicts(good, key, distinct, repeated)
        reason = F.array(F.lit(f"duplicate key: {', '.join(key)}"))
        rejected = rejected.unionByName(conflicts.drop("_slot").withColumn(quality.REASONS, reason))
        kept, bad = Observation(), Observation()
        good = pin(good.observe(kept, F.count("*").alias("rows")))
        rejected = pin(rejected.observe(bad, F.count("*").alias("rows")))
        return good, rejected, observed(bad, rows=0)["rows"], observed(kept, rows=0)["rows"]

    def _rewrite(
        self,
        table: Table,
        good: DataFrame,
        held: DataFrame,
        commit: Commit,
        new: Commit,
        parts: list[int],
        newest: bool,
        loaded: int,
    ) -> tuple[Commit, int, int]:
        """Write what new and changed rows touch: the new commit, their number, and that of rows older than the stored ones.

        ``held`` is the pinned frame that ``good`` is read from.
        """
        rows, stale = self._numbered(table, good, held, commit, parts, newest, loaded)
        if rows is None:
            return new, 0, stale
        incoming = rows.withColumn("bucket", self._bucket(commit))  # of pinned rows: nothing is shuffled again to read it
        counts = incoming.groupBy("bucket").agg(
            F.count("*").alias("n"), F.max("id").alias("max_id"), F.collect_set("_slot").alias("parts")
        ).collect()  # one row per bucket
        if not counts:
            return new, 0, stale
        touched = {row["bucket"] for row in counts}
        touched_parts = {part for row in counts for part in row["parts"]}
        changed = sum(row["n"] for row in counts)

        def merged(some: list[int]) -> DataFrame:
            fresh = incoming if len(some) == len(touched) else incoming.filter(F.col("bucket").isin(some))
            fresh = fresh.select(*table.columns)
            if not touched & set(commit.buckets):
                return fresh
            current = self._read(table, commit, only=some)
            return self._merged(current, fresh, ["id"], F.floor(F.col("id") * SLICES / F.lit(commit.span)))

        def entries(some: list[int]) -> DataFrame:
            fresh = incoming if len(some) == len(touched_parts) else incoming.filter(F.col("_slot").isin(some))
            fresh = self._hashed(table, fresh)
            if not touched_parts & set(commit.keys):
                return fresh
            index = self._read(table, commit, only=some, kind="keys")
            slot = F.pmod(F.xxhash64(*table.key), F.lit(commit.parts * SLICES))
            return self._merged(index, fresh.select(*index.columns), list(table.key), slot)

        # Rows that were numbered just now lie in the order of their ids, each task has few buckets.
        sorted_by_id = bool(table.surrogate) and not commit.keys
        new = self._laid_out(table, commit, new, merged, entries, touched, touched_parts, sorted_by_id, changed)
        ids = incoming.select(F.col("id").cast("bigint"))
        ids.coalesce(len(touched)).write.mode("overwrite").parquet(self._rejected_path(table, new.version, "changes"))
        max_id = max(commit.max_id, *[row["max_id"] for row in counts])
        return replace(new, max_id=max_id), changed, stale

    def _numbered(
        self, table: Table, good: DataFrame, held: DataFrame, commit: Commit, parts: list[int], newest: bool, loaded: int
    ) -> tuple[DataFrame | None, int]:
        """New and changed rows with their ids, and how many rows are older than the stored ones; lets go of ``held``."""
        key = list(table.key)
        if not commit.keys:
            if table.surrogate:
                numbered = number_rows(good, key, start=commit.max_id, into="id")
                unpin(held)
                return numbered, 0
            return good, 0
        passes = self._passes(table, commit, "keys", parts, loaded)
        found, counts = [], dict.fromkeys(("new", "stale", "changed"), 0)
        for some in passes:
            given = good if len(passes) == 1 else good.filter(F.col("_slot").isin(some))
            rows, counted = self._matched(table, given, commit, some, newest)
            counts = {name: n + counted[name] for name, n in counts.items()}
            found.append(rows)
        unpin(held)
        matched = reduce(DataFrame.unionByName, found)
        columns = [*table.columns, "_slot"]
        found = []
        if counts["changed"]:
            known = matched.filter("_state = 'changed'")
            found.append((known.withColumn("id", F.col("_id")) if table.surrogate else known).select(*columns))
        if counts["new"]:
            rows = matched.filter("_state = 'new'").drop("_id")
            if table.surrogate:
                rows = number_rows(rows, key, start=commit.max_id, into="id")
            found.append(rows.select(*columns))
        if not found:
            return None, counts["stale"]
        return (found[0] if len(found) == 1 else found[0].unionByName(found[1])), counts["stale"]

    def _matched(
        self, table: Table, good: DataFrame, commit: Commit, parts: list[int], newest: bool
    ) -> tuple[DataFrame, dict[str, int]]:
        """The rows of some index parts that are new or changed, and how many are new, changed or older than the stored ones."""
        key = list(table.key)
        index = self._read(table, commit, only=parts, kind="keys")
        # Tables from before have the whole hash.
        stored = [F.col("id").alias("_id"), F.substring(HASH, 1, HASH_BYTES).alias("_hash")]
        if newest:
            stored.append(F.col(STAMP).alias("_stamp"))
        matched = good.join(index.select(*key, *stored), key, "left").withColumn(HASH, _content_hash(table))
        late = F.coalesce(F.col("_stamp") > F.col(STAMP), F.lit(False)) if newest else F.lit(False)
        fresh = F.col("_id").isNull()
        state = F.when(fresh, "new").when(late, "stale").when(F.col("_hash") == F.col(HASH), "same").otherwise("changed")
        seen = Observation()
        matched = matched.withColumn("_state", state).observe(
            seen, *[F.count_if(F.col("_state") == name).alias(name) for name in ("new", "stale", "changed")]
        )
        matched = pin(matched.filter(F.col("_state").isin("new", "changed")).drop(HASH, "_hash", "_stamp"))
        return matched, observed(seen, new=0, stale=0, changed=0)

    def record(self, results: Iterable[LoadResult], load_ts: str) -> None:
        """Append the row counts of a run to the list of loads."""
        rows = [tuple(asdict(result).values()) for result in results]
        frame = self.spark.createDataFrame(
            rows,
            "table string, received bigint, rejected bigint, loaded bigint, changed bigint,"
            " watermark string, superseded bigint, skipped bigint",
        ).withColumn("load_ts", F.lit(load_ts).cast("timestamp_ntz"))
        frame.coalesce(1).write.mode("append").parquet(f"{self.root}/loads")

    def loads(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/loads")
