"""Line deduplication with levelled sorted runs of line hashes.

A line's key is the line without ASCII white space at both ends, A-Z
lower-cased, as a pair of independent 64-bit hashes.  Every batch of documents
adds one run: its keys, each with the number of documents that hold it and
the largest document id among them, sorted by key.  The batch's keys are merged
with those of the runs: keys without a match are fresh rows of the run, seen
keys add their counts.  So every key is fresh in one run.  When a level has
``fanout`` runs they are merged into one run of the next level.

A document is a row; a null text is one empty line, a document without id
counts as smaller than any other.  Repeated rows are documents of their own.
Of several rows with the largest id all keep their lines.  Extra columns are
passed on by ``drop_repeated_lines`` whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.session import delete_folder, scratch_path

from .textbytes import MULTIPLIERS, SpanHashes, chunks, lower_table

#: Shortest key, in code points, that counts; shorter lines always stay.
MIN_CHARS = 20

#: Documents that must hold a key before its lines go.
MIN_DOCS = 3

#: Batches that a whole table is added in, newest documents first.
BATCHES = 4

KEY = ["hash_a", "hash_b"]

_LINES = "hash_a long, hash_b long, doc_id long, text_hash long, places array<int>"


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per document and key: the key's hashes, the document and the numbers of the lines (from 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lower, hashes = lower_table(), [SpanHashes(m) for m in MULTIPLIERS]
        blank = np.zeros(256, bool)
        blank[[0x20, *range(0x09, 0x0E)]] = True
        for batch in batches:
            for first, _, raw, offsets in chunks(batch.column("text")):
                data = lower[raw]
                # lines of all texts: every text starts one, every line feed another
                feeds = np.flatnonzero(data == 10)
                starts = np.sort(np.concatenate((offsets[:-1], feeds + 1)), kind="stable")
                ends = np.sort(np.concatenate((feeds, offsets[1:])), kind="stable")
                text = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(feeds, offsets)) + 1)
                place = np.arange(len(starts)) - np.searchsorted(text, text)
                solid = np.flatnonzero(~blank[data])
                low, high = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
                full = np.flatnonzero(high > low)
                begin, end = solid[low[full]], solid[high[full] - 1] + 1
                points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
                long = points[end] - points[begin] >= min_chars
                full, begin, end = full[long], begin[long], end[long]
                if not len(full):
                    continue
                a, b = (h.load(data).of(begin, end).view(np.int64) for h in hashes)
                order = np.lexsort((place[full], b, a, text[full]))
                a, b, owner, place = a[order], b[order], text[full][order], place[full][order]
                new = np.ones(len(order), bool)
                new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (owner[1:] != owner[:-1])
                heads = np.flatnonzero(new)
                rows = pa.array(owner[heads] + first)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(a[heads]),
                        pa.array(b[heads]),
                        batch.column("doc_id").cast(pa.int64()).take(rows),
                        batch.column("text_hash").take(rows),
                        pa.ListArray.from_arrays(
                            pa.array(np.append(heads, len(order)).astype(np.int32)), pa.array(place.astype(np.int32))
                        ),
                    ],
                    names=["hash_a", "hash_b", "doc_id", "text_hash", "places"],
                )

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(run, _LINES)


class LineRuns:
    """Levelled runs of (key, documents, largest document id, whether no earlier run has the key) in a shared folder."""

    def __init__(self, spark: SparkSession, fanout: int = 4) -> None:
        self.spark, self.fanout = spark, fanout
        self.folder = scratch_path(spark, "line-runs")
        self.levels: list[list[str]] = []

    def _write(self, counted: DataFrame, level: int) -> None:
        path = f"{self.folder}/level-{level}-{uuid4().hex}"
        counted.sortWithinPartitions(*KEY).write.parquet(path)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)
        if len(self.levels[level]) >= self.fanout:
            merged, self.levels[level] = self.levels[level], []
            self._write(self._merge(self.spark.read.parquet(*merged)), level + 1)
            for path in merged:
                delete_folder(self.spark, path)

    @staticmethod
    def _merge(runs: DataFrame) -> DataFrame:
        sums = F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc"), F.bool_or("fresh").alias("fresh")
        return runs.groupBy(*KEY).agg(*sums)

    def add(self, lines: DataFrame) -> None:
        """One more run, from rows of ``line_keys``."""
        counted = lines.groupBy(*KEY).agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc"))
        known = self._keys().withColumn("_known", F.lit(True)).hint("merge")
        marked = counted.join(known, KEY, "left").withColumn("fresh", F.col("_known").isNull()).drop("_known")
        self._write(marked if self._paths() else counted.withColumn("fresh", F.lit(True)), 0)

    def read(self) -> DataFrame:
        """All keys, once each."""
        paths = self._paths()
        if not paths:
            return self.spark.createDataFrame([], "hash_a long, hash_b long, n_docs long, last_doc long")
        runs = self.spark.read.parquet(*paths)
        return (runs if len(paths) == 1 else self._merge(runs)).drop("fresh")

    def _paths(self) -> list[str]:
        return [path for level in self.levels for path in level]

    def _keys(self) -> DataFrame:
        """The keys of all runs, each from the run where it is fresh."""
        paths = self._paths()
        return self.spark.read.parquet(*paths).filter("fresh").select(*KEY) if paths else self.read().select(*KEY)

    def unseen(self, lines: DataFrame) -> DataFrame:
        """The rows of ``line_keys`` whose key is in no run."""
        return lines.join(self._keys(), KEY, "left_anti")


def batches_of(docs: DataFrame, batches: int) -> Iterator[DataFrame]:
    """The documents by falling ranges of their id; those without id come last."""
    edges = docs.approxQuantile("doc_id", [k / batches for k in range(1, batches)], 0.01) if batches > 1 else []
    edges = sorted({int(x) for x in edges}, reverse=True)
    above = None
    for edge in edges:
        upper = F.lit(True) if above is None else F.col("doc_id") <= above
        yield docs.filter((F.col("doc_id") > edge) & upper)
        above = edge
    yield docs if above is None else docs.filter((F.col("doc_id") <= above) | F.col("doc_id").isNull())


def repeated_places(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES
) -> DataFrame:
    """``doc_id``, ``text_hash`` and the sorted numbers of the lines to drop, for documents that have any."""
    runs = LineRuns(docs.sparkSession)
    for batch in batches_of(docs, batches):
        runs.add(line_keys(batch, min_chars))
    common = runs.read().filter(F.col("n_docs") >= min_docs)
    lines = line_keys(docs, min_chars).join(common, KEY)
    dropped = lines.filter(~F.col("doc_id").eqNullSafe(F.col("last_doc")))
    return dropped.groupBy("doc_id", "text_hash").agg(F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"))


def _without(texts: pd.Series, places: pd.Series) -> pd.DataFrame:
    """Texts without the lines at the given places, and their number of lines before."""
    kept, counts = [], []
    for text, drop in zip(texts, places, strict=True):
        lines = (text or "").split("\n")
        counts.append(len(lines))
        if drop is not None and len(drop):
            gone = set(drop.tolist())
            lines = [line for k, line in enumerate(lines) if k not in gone]
            kept.append("\n".join(lines))
        else:
            kept.append(text or "")
    return pd.DataFrame({"text": kept, "n_lines": counts})


def _joined(docs: DataFrame, **rule: int) -> DataFrame:
    """``doc`` (the whole row), ``kept`` (text and number of lines before) and ``n_dropped``."""
    without = F.pandas_udf(_typed(_without), "text string, n_lines long")
    places = repeated_places(docs, **rule).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("places").alias("_places")
    )
    left = docs.select(F.struct(*docs.columns).alias("doc"))
    same = F.col("doc.doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("doc.text") == F.col("_hash"))
    joined = left.join(places, same, "left")
    return joined.select(
        "doc", without("doc.text", "_places").alias("kept"), F.coalesce(F.size("_places"), F.lit(0)).cast("long").alias("n_dropped")
    )


def _typed(function):
    """``pandas_udf`` reads types, not their names."""
    function.__annotations__ = {"texts": pd.Series, "places": pd.Series, "return": pd.DataFrame}
    return function


def report(docs: DataFrame, **rule: int) -> DataFrame:
    """Per document ``doc_id``, ``n_lines`` before, ``n_dropped`` and a digest of the text that stays."""
    return _joined(docs.select("doc_id", "text"), **rule).select(
        "doc.doc_id", "kept.n_lines", "n_dropped", F.sha2("kept.text", 256).alias("kept_sha256")
    )


def drop_repeated_lines(docs: DataFrame, **rule: int) -> DataFrame:
    """The documents with all their columns, the text without its repeated lines (and ``n_chars``, if there, to match)."""
    columns = [F.col("doc")[name].alias(name) for name in docs.columns]
    if "text" in docs.columns:
        columns[docs.columns.index("text")] = F.col("kept.text").alias("text")
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        columns[docs.columns.index("n_chars")] = F.char_length("kept.text").cast(kind).alias("n_chars")
    return _joined(docs, **rule).select(*columns)


def oracle(min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    blank = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
    WITH docs AS (SELECT doc_id, row_number() OVER () AS copy, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
    spread AS (SELECT copy, doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS i FROM docs),
    keyed AS (SELECT copy, doc_id, i, line, translate(trim(line, {blank}), '{upper}', '{upper.lower()}') AS key FROM spread),
    common AS (
      SELECT key, max(doc_id) AS last_doc FROM keyed WHERE length(key) >= {min_chars}
      GROUP BY key HAVING count(DISTINCT copy) >= {min_docs})
    SELECT any_value(k.doc_id) AS doc_id, CAST(count(*) AS BIGINT) AS n_lines,
           CAST(count(*) FILTER (c.key IS NOT NULL AND k.doc_id IS DISTINCT FROM c.last_doc) AS BIGINT) AS n_dropped,
           sha256(coalesce(string_agg(k.line, chr(10) ORDER BY k.i)
             FILTER (c.key IS NULL OR k.doc_id IS NOT DISTINCT FROM c.last_doc), '')) AS kept_sha256
    FROM keyed k LEFT JOIN common c USING (key) GROUP BY k.copy
    """
