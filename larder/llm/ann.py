"""Approximate nearest neighbours by multiprobe p-stable hashing.

Every table projects a vector on ``m`` random Gaussian directions and cuts the
projections into cells of one width; the cells together are its bucket.  A
neighbour at distance r differs from a query by a Gaussian with deviation r in
every projection, so the chance that it lies in a given bucket is known.  A
query visits the buckets of a table by falling chance, until the tables
together find a neighbour at the assumed distance with probability ``TARGET``.
Every bucket holds all its rows: a large one is split over several tasks, and
the queries that visit it go to each part.  Candidates of all tables are
merged and ranked by their exact distance.

The assumed distance is taken from ``SAMPLE`` queries (the smallest hashes of
ids) compared with all rows: the largest of their ``k``-th distances.  The
number of directions grows with the logarithm of the number of rows, so that
buckets keep their size.  Queries that find fewer than ``k`` rows are compared
with all rows, in blocks.

Vectors that are null, zero or of another length than most, or that hold a
null or a non-finite component, take no part, nor do rows without id.  Rows of
the query's own id are not its neighbours; an id found several times counts
with its smallest distance.  With fewer than ``k`` other vectors all are
returned, with none no row.  Extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from math import erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.session import pin

from .shared import share, shared

#: Neighbours per query, one id in how many is a query.
K, EVERY = 10, 100

#: Tables, wanted probability of finding a neighbour, queries that the distance is taken from.
TABLES, TARGET, SAMPLE = 4, 0.95, 64

#: Rows of a bucket that a task holds, and rows that a bucket should have.
BLOCK, BUCKET_ROWS = 2048, 100

#: Cells per direction that a data set covers, for the number of directions.
SPREAD = 5.0

#: Neighbours found that a task merges before it passes them on.
MERGED = 2_000_000

#: Queries that are compared with all rows in one pass.
EXACT_QUERIES = 1024

SEED = 20240613


@dataclass
class Tables:
    """Directions, offsets and cell width of all tables, and the distance assumed of neighbours."""

    directions: np.ndarray  # table, component, direction
    offsets: np.ndarray  # table, direction
    width: float
    distance: float

    @classmethod
    def make(cls, size: int, rows: int, distance: float) -> Tables:
        m = int(np.clip(round(np.log(max(rows, 1) / BUCKET_ROWS) / np.log(SPREAD)), 1, 24))
        random = np.random.default_rng(SEED)
        distance = max(distance, 1e-12)
        return cls(random.normal(size=(TABLES, size, m)), random.uniform(0, distance, (TABLES, m)), distance, distance)

    def cells(self, vectors: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
        """Cells of vectors and where in the cells they lie (0 to 1)."""
        at = (vectors @ self.directions[table] + self.offsets[table]) / self.width
        cells = np.floor(at)
        return cells.astype(np.int64), at - cells

    def keys(self, cells: np.ndarray, table: int) -> np.ndarray:
        """A 64-bit key of buckets; should two buckets share one, their rows are candidates of both."""
        key = np.full(len(cells), table + 1, np.uint64)
        for column in cells.T:
            key = key * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.uint64)
            key ^= key >> np.uint64(29)
        return key.view(np.int64)

    def probes(self, place: np.ndarray) -> np.ndarray:
        """Shifts of cells in the order of their chance, for a query at ``place`` in its cell."""
        wanted = 1.0 - (1.0 - TARGET) ** (1.0 / TABLES)
        scale = self.width / (self.distance * sqrt(2.0))
        options = []
        for f in place.tolist():
            shifts = range(-6, 7)
            chances = [(erf((s + 1 - f) * scale) - erf((s - f) * scale)) / 2 for s in shifts]
            options.append(sorted(zip(chances, shifts, strict=True), reverse=True))
        first = (0,) * len(options)
        heap, total, out = [(-float(np.prod([o[0][0] for o in options])), first, 0)], 0.0, []
        while heap and total < wanted:
            chance, ranks, since = heapq.heappop(heap)
            total -= chance
            out.append([options[j][r][1] for j, r in enumerate(ranks)])
            for j in range(since, len(options)):  # each combination is reached once
                r = ranks[j]
                if r + 1 < len(options[j]) and options[j][r + 1][0] > 0:
                    after = chance / options[j][r][0] * options[j][r + 1][0]
                    heapq.heappush(heap, (after, (*ranks[:j], r + 1, *ranks[j + 1 :]), j))
        return np.array(out, np.int64)


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column without nulls and with equal lengths as a matrix of doubles."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def sound(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``embedding`` (doubles) of the rows that take part."""
    plain = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    plain = plain.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)
    plain = plain.filter(F.exists("embedding", lambda x: x != 0))
    sizes = plain.groupBy(F.size("embedding").alias("size")).count().orderBy(F.desc("count"), "size")
    most = sizes.first()  # one row per length
    return plain.filter(F.size("embedding") == (most["size"] if most else 0))


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` smallest scores, ties to the smaller id."""
    if len(score) > k:
        limit = np.partition(score, k - 1)[k - 1]
        near = np.flatnonzero(score <= limit)
    else:
        near = np.arange(len(score))
    return near[np.lexsort((ids[near], score[near]))][:k]


def _distances(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return np.sqrt(((rows - query) ** 2).sum(axis=1))


_FOUND = "query_id long, vec_id long, score double"


def _found(found: list[tuple]) -> pa.RecordBatch:
    queries, ids, scores = ([np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.zeros(0)] * 3)
    return pa.RecordBatch.from_arrays(
        [pa.array(queries.astype(np.int64)), pa.array(ids.astype(np.int64)), pa.array(scores.astype(np.float64))],
        names=["query_id", "vec_id", "score"],
    )


def _top(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest of each query with their ranks."""
    merged = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return merged.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def exact(vectors: DataFrame, queries: list[tuple[int, list[float]]], k: int) -> DataFrame:
    """The ``k`` nearest of at most ``EXACT_QUERIES`` queries among all rows of ``sound`` vectors."""
    ids = np.array([q for q, _ in queries], np.int64)
    block = share(vectors.sparkSession, (ids, np.array([v for _, v in queries], np.float64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, points = shared(block)
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            rows, row_ids = _matrix(batch.column("embedding")), batch.column("vec_id").to_numpy()
            for q, (query, point) in enumerate(zip(query_ids.tolist(), points, strict=True)):
                other = np.flatnonzero(row_ids != query)
                old_ids, old = best.get(q, (np.zeros(0, np.int64), np.zeros(0)))
                all_ids, all_ = np.concatenate((old_ids, row_ids[other])), np.concatenate((old, _distances(point, rows[other])))
                # an id may come several times: more than k rows may be needed for k ids, so keep the nearest of each id
                order = np.lexsort((all_, all_ids))
                first = order[np.concatenate(([True], all_ids[order][1:] != all_ids[order][:-1]))] if len(order) else order
                near = first[_best(all_[first], all_ids[first], k)]
                best[q] = all_ids[near], all_[near]
        yield _found([(np.full(len(i), query_ids[q]), i, s) for q, (i, s) in best.items()])

    return _top(vectors.mapInArrow(run, _FOUND), k)


def _buckets(tables: Tables, vectors: DataFrame) -> DataFrame:
    """One row per table and vector."""
    block = share(vectors.sparkSession, tables)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared(block)
        for batch in batches:
            rows = _matrix(batch.column("embedding"))
            for table in range(TABLES if len(rows) else 0):
                keys = own.keys(own.cells(rows, table)[0], table)
                yield pa.RecordBatch.from_arrays([pa.array(keys), *batch.columns], names=["bucket", "vec_id", "embedding"])

    return vectors.mapInArrow(run, "bucket long, vec_id long, embedding array<double>")


def _probes(tables: Tables, queries: DataFrame) -> DataFrame:
    """One row per query and bucket that it visits."""
    block = share(queries.sparkSession, tables)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared(block)
        for batch in batches:
            rows = _matrix(batch.column("embedding"))
            for table in range(TABLES if len(rows) else 0):
                cells, places = own.cells(rows, table)
                for q in range(len(rows)):
                    keys = np.unique(own.keys(cells[q] + own.probes(places[q]), table))
                    same = pa.array(np.full(len(keys), q))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys), *(c.take(same) for c in batch.columns)], names=["bucket", "vec_id", "embedding"]
                    )

    return queries.mapInArrow(run, "bucket long, vec_id long, embedding array<double>")


def _compare(k: int):
    """Rows in order of (bucket, part, query): of every query the ``k`` nearest in all buckets of the task that it visits."""

    def merged(found: list[tuple]) -> pa.RecordBatch:
        """One row per query and id, and no more than ``k`` per query."""
        if not any(len(f[0]) for f in found):
            return _found([])
        queries, ids, scores = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((scores, ids, queries))
        queries, ids, scores = queries[order], ids[order], scores[order]
        first = np.concatenate(([True], (queries[1:] != queries[:-1]) | (ids[1:] != ids[:-1])))
        queries, ids, scores = queries[first], ids[first], scores[first]
        order = np.lexsort((ids, scores, queries))
        queries, ids, scores = queries[order], ids[order], scores[order]
        near = np.arange(len(queries)) - np.searchsorted(queries, queries) < k
        return _found([(queries[near], ids[near], scores[near])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows, ids = None, [], []
        points = all_ids = distinct = None
        found: list[tuple] = []
        for batch in batches:
            matrix, own = _matrix(batch.column("embedding")), batch.column("vec_id").to_numpy()
            keys = np.stack([batch.column(c).to_numpy() for c in ("bucket", "part")], axis=1)
            asks = batch.column("query").to_numpy()
            edges = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1) | (asks[1:] != asks[:-1])) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(keys)], strict=True):
                if (now := tuple(keys[a].tolist())) != group:
                    group, rows, ids, points = now, [], [], None
                if not asks[a]:
                    rows.append(matrix[a:b])
                    ids.append(own[a:b])
                    continue
                if points is None:
                    points = np.concatenate(rows) if rows else np.zeros((0, matrix.shape[1]))
                    all_ids = np.concatenate(ids) if ids else np.zeros(0, np.int64)
                    distinct = len(np.unique(all_ids)) == len(all_ids)
                for q in range(a, b):
                    other = np.flatnonzero(all_ids != own[q])
                    score = _distances(matrix[q], points[other])
                    # if an id comes twice, its rows fill more than one place
                    near = _best(score, all_ids[other], k) if distinct else np.arange(len(other))
                    found.append((np.full(len(near), own[q]), all_ids[other[near]], score[near]))
            if sum(len(f[0]) for f in found) > MERGED:
                yield merged(found)
                found = []
        yield merged(found)

    return run


def nearest(vectors: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the ``k`` nearest found for every id divisible by ``every``."""
    rows = pin(sound(vectors))
    queries = rows.filter(F.col("vec_id") % every == 0)
    sample = [tuple(r) for r in queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()]
    if not sample:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    far = exact(rows, sample, k).groupBy("query_id").agg(F.max("score").alias("score")).agg(F.max("score")).first()[0]
    tables = Tables.make(len(sample[0][1]), rows.count(), far or 0.0)
    index = _buckets(tables, rows)
    parts = index.groupBy(F.col("bucket").alias("_bucket")).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    parts = pin(parts)
    large = parts.filter("parts > 1")
    split = F.when(F.col("parts").isNotNull(), F.pmod(F.hash("vec_id"), F.col("parts"))).otherwise(0)
    held = index.join(large, F.col("bucket") == F.col("_bucket"), "left")
    held = held.select("bucket", split.alias("part"), F.lit(0).alias("query"), "vec_id", "embedding")
    asked = _probes(tables, queries).join(parts, F.col("bucket") == F.col("_bucket"))
    asked = asked.select(
        "bucket", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(1).alias("query"), "vec_id", "embedding"
    )
    dealt = held.unionByName(asked).repartition("bucket", "part").sortWithinPartitions("bucket", "part", "query")
    top = pin(_top(dealt.mapInArrow(_compare(k), _FOUND), k))
    # the rest: queries with fewer than k
    counts = top.groupBy(F.col("query_id").alias("_id")).count()
    short = queries.join(counts, F.col("vec_id") == F.col("_id"), "left").filter(F.coalesce("count", F.lit(0)) < k)
    short = pin(short.select("vec_id", "embedding").dropDuplicates(["vec_id"]))
    if short.isEmpty():
        return top
    blocks = -(-short.count() // EXACT_QUERIES) * 2
    for block in range(blocks):
        some = short.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block)
        for start in _slices(some):
            again = exact(rows, start, k)
            top = top.join(again.select(F.col("query_id").alias("_id")).distinct(), F.col("query_id") == F.col("_id"), "left_anti")
            top = top.unionByName(again)
    return top


def _slices(queries: DataFrame) -> Iterator[list[tuple[int, list[float]]]]:
    """Rows, at most ``EXACT_QUERIES`` at a time."""
    rows: list = []
    for row in queries.toLocalIterator():
        rows.append((row["vec_id"], row["embedding"]))
        if len(rows) == EXACT_QUERIES:
            yield rows
            rows = []
    if rows:
        yield rows
