"""Compression of vectors to codes: per part of a vector the index of the nearest entry of a codebook, found in a GNAT.

A component x becomes the integer floor(4096 * x), and a vector is cut into
``PARTS`` equal consecutive parts.  Each position has a codebook, which starts
as that part of the vectors with the smallest ids.  A round assigns every part
to the nearest entry of its codebook (squared Euclidean distance, ties to the
lower index) and moves every entry to the componentwise floor of the mean of
its parts; an entry without parts stays.  All sums are integers, so the result
does not depend on how the rows are dealt.

Nearest entries are found in a geometric near-neighbour access tree.  A node
has some of the entries as split points, far from each other, and one child per
split point with the entries that are nearest to it.  For every split point and
child the smallest and largest distance between the two is kept.  A query
measures a split point; a child leaves the search if no entry within the ranges
can be as near as the best one found so far.  The tree prunes with floating
point numbers rounded outwards and only on strict inequality; what is left is
compared by integer distances, so ties go to the lower index exactly.  The
queries of a batch walk the tree together.

Every round is one pass over the rows.  Tasks pass on sums and counts per part,
entry and position; what reaches the driver are the codebooks.

Vectors that are null or empty, or hold a null or a non-finite component, are
left out; so are those of another length than most (ties: the shorter), and
those with a component so large that squared distances might not fit a long (x
with x * x * length of 2^37 or more).  If the length is no multiple of the number of parts, all are left
out.  Rows without id come after all others when entries are chosen; rows of
one id are told apart by their components.  With fewer vectors than entries the
codebooks are smaller.  Repeated rows count and are returned each for itself;
rows without label share one label; extra columns are ignored.  Without vectors
there are no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.session import pin

from .shared import share, shared

#: Parts of a vector, entries of a codebook, rounds, and the factor of components.
PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096

#: Square of a component times the length of its vector: from here on squared distances might not fit a long.
LARGEST = 2.0**37

#: Split points of a node.
DEGREE = 4

#: Vectors that walk the trees together.
BATCH = 4096

#: How far floating point distances are rounded outwards, relatively.
SLACK = 1e-12


@dataclass
class Node:
    """Split points by index of their entry, and per child its entries' distances from every split point."""

    splits: list[int]
    low: np.ndarray  # split point, child
    high: np.ndarray
    children: list[Node | None]  # the entries of a child other than its split point


class Gnat:
    """The entries of one codebook."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        self.root = self._node(list(range(len(entries))))

    def _squares(self, points: np.ndarray, entry: int) -> np.ndarray:
        away = points - self.entries[entry]
        return np.einsum("ij,ij->i", away, away)

    def _node(self, members: list[int]) -> Node:
        # split points: the first, then always the one farthest from those chosen
        splits, left = [members[0]], np.array(members[1:], np.int64)
        squares = [self._squares(self.entries[left], splits[0])]
        while len(left) and len(splits) < DEGREE:
            at = int(np.argmax(np.min(squares, axis=0)))
            splits.append(int(left[at]))
            left, squares = np.delete(left, at), [np.delete(s, at) for s in squares]
            squares.append(self._squares(self.entries[left], splits[-1]))
        nearest = np.argmin(squares, axis=0)
        low, high = np.zeros((len(splits), len(splits))), np.zeros((len(splits), len(splits)))
        children: list[Node | None] = []
        for child, split in enumerate(splits):
            own = left[nearest == child].tolist()
            for k, from_ in enumerate(splits):
                away = np.sqrt(self._squares(self.entries[[split, *own]], from_).astype(np.float64))
                low[k, child], high[k, child] = away.min() * (1 - SLACK), away.max() * (1 + SLACK)
            children.append(self._node(own) if own else None)
        return Node(splits, low, high, children)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of every point, the lowest of equally near ones, and its squared distance."""
        best = np.full(len(points), np.iinfo(np.int64).max)
        index = np.zeros(len(points), np.int64)
        self._search(self.root, points, np.arange(len(points)), best, index)
        return index, best

    def _search(self, node: Node, points: np.ndarray, asking: np.ndarray, best: np.ndarray, index: np.ndarray) -> None:
        alive = np.ones((len(asking), len(node.splits)), bool)
        for k, split in enumerate(node.splits):
            on = np.flatnonzero(alive[:, k])
            if not len(on):
                continue
            who = asking[on]
            square = self._squares(points[who], split)
            better = (square < best[who]) | ((square == best[who]) & (split < index[who]))
            best[who[better]], index[who[better]] = square[better], split
            away, reach = np.sqrt(square.astype(np.float64))[:, None], np.sqrt(best[who].astype(np.float64))[:, None]
            slack = (away + reach) * SLACK
            out = (away - reach - slack > node.high[k]) | (away + reach + slack < node.low[k])
            alive[on] &= ~out
        for child, below in enumerate(node.children):
            if below is not None and alive[:, child].any():
                self._search(below, points, asking[alive[:, child]], best, index)


def sound(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``label`` and ``embedding`` (doubles) of the rows that take part."""
    plain = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (x * x * F.size("embedding") < LARGEST))
    plain = plain.filter(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & usable)
    sizes = plain.groupBy(F.size("embedding").alias("size")).count().orderBy(F.desc("count"), "size")
    most = sizes.first()  # the commonest length
    usual = most["size"] if most and most["size"] % PARTS == 0 else 0
    return plain.filter(F.size("embedding") == usual)


def integers(column: pa.Array) -> np.ndarray:
    """Equally long lists without nulls as a matrix of scaled components."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return np.floor(values * SCALE).astype(np.int64).reshape(len(column), -1)


def first_codebooks(rows: DataFrame) -> np.ndarray:
    """Part, entry, position: the parts of the vectors with the smallest ids."""
    chosen = rows.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(ENTRIES).select("embedding").collect()
    matrix = np.floor(np.array([row["embedding"] for row in chosen]) * SCALE).astype(np.int64)
    return matrix.reshape(len(chosen), PARTS, -1).transpose(1, 0, 2)


def _nearest(trees: list[Gnat], column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per run of rows its start, the parts, and per row and part the entry and its squared distance."""
    for start in range(0, len(column), BATCH):
        matrix = integers(column.slice(start, BATCH))
        parts = matrix.reshape(len(matrix), PARTS, -1)
        found = [tree.nearest(np.ascontiguousarray(parts[:, p])) for p, tree in enumerate(trees)]
        yield start, parts, np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def moved(rows: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """The codebooks after one round."""
    block = share(rows.sparkSession, codebooks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared(block)
        trees = [Gnat(book) for book in books]
        sums, counts = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            for _, parts, index, _ in _nearest(trees, batch.column("embedding")):
                for p in range(PARTS):
                    np.add.at(sums[p], index[:, p], parts[:, p])
                    counts[p] += np.bincount(index[:, p], minlength=counts.shape[1])
        part, entry = np.nonzero(counts)
        lists = pa.ListArray.from_arrays(
            pa.array(np.arange(len(part) + 1, dtype=np.int32) * books.shape[2]), pa.array(sums[part, entry].ravel())
        )
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(counts[part, entry]), lists],
            names=["part", "entry", "n", "sums"],
        )

    width = codebooks.shape[2]
    partial = rows.select("embedding").mapInArrow(run, "part int, entry int, n long, sums array<long>")
    totals = [F.sum(F.col("sums")[k]).alias(f"s{k}") for k in range(width)]
    after = codebooks.copy()
    for row in partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *totals).collect():  # at most PARTS * ENTRIES rows
        after[row["part"], row["entry"]] = [row[f"s{k}"] // row["n"] for k in range(width)]
    return after


def codebooks_of(rows: DataFrame) -> np.ndarray:
    """The codebooks after all rounds."""
    books = first_codebooks(rows)
    for _ in range(ROUNDS):
        books = moved(rows, books)
    return books


def encode(rows: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """``vec_id``, ``label``, ``code`` and ``error`` of ``sound`` rows."""
    block = share(rows.sparkSession, codebooks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(book) for book in shared(block)]
        for batch in batches:
            for start, _, index, square in _nearest(trees, batch.column("embedding")):
                own = batch.slice(start, len(index))
                codes = [bytes(row).hex() for row in index.astype(np.uint8)]
                yield pa.RecordBatch.from_arrays(
                    [own.column("vec_id"), own.column("label"), pa.array(codes, pa.string()), pa.array(square.sum(axis=1))],
                    names=["vec_id", "label", "code", "error"],
                )

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("vec_id", "label"))
    return rows.mapInArrow(run, f"{kinds}, code string, error long")


def decode(codes: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """``codes`` with a column ``embedding``, the vector (doubles) that the code stands for; a null code has none."""
    entries = F.lit([[(part[k] / SCALE).tolist() for k in range(len(part))] for part in codebooks])
    number = [F.conv(F.substring("code", 2 * p + 1, 2), 16, 10).cast("int") for p in range(PARTS)]
    whole = F.concat(*[F.element_at(entries, p + 1)[number[p]] for p in range(PARTS)])
    return codes.withColumn("embedding", whole)


def digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame) -> DataFrame:
    """Per vector ``vec_id``, ``code``, ``error``, ``label_error`` and ``codebooks_sha256``."""
    rows = pin(sound(vectors))
    if rows.isEmpty():
        kind = vectors.schema["vec_id"].dataType.simpleString()
        return rows.sparkSession.createDataFrame(
            [], f"vec_id {kind}, code string, error long, label_error long, codebooks_sha256 string"
        )
    books = codebooks_of(rows)
    codes = pin(encode(rows, books))
    by_label = codes.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    joined = codes.join(by_label, F.col("label").eqNullSafe(F.col("_label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def oracle() -> str:
    assigned = """
      SELECT p.vec_id, p.part, p.v, arg_min(b.entry, (d, b.entry)) AS entry, min(d) AS d
      FROM parts p JOIN {book} b ON b.part = p.part,
           LATERAL (SELECT list_sum(list_transform(list_zip(p.v, b.v), lambda x: (x[1] - x[2]) * (x[1] - x[2])))::BIGINT AS d)
      GROUP BY p.vec_id, p.part, p.v"""
    rounds = ""
    for k in range(ROUNDS):
        rounds += f"""
    a{k} AS MATERIALIZED ({assigned.format(book=f"b{k}")}),
    m{k} AS (
      SELECT part, entry, i, (s - ((s % n) + n) % n) // n AS x
      FROM (SELECT part, entry, i, sum(v[i])::BIGINT AS s, count(*) AS n
            FROM a{k}, (SELECT unnest(range(1, (SELECT max(len(v)) FROM parts) + 1)) AS i) GROUP BY part, entry, i)),
    b{k + 1} AS MATERIALIZED (
      SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM b{k} b
      LEFT JOIN (SELECT part, entry, list(x ORDER BY i) AS v FROM m{k} GROUP BY part, entry) m USING (part, entry)),"""
    return f"""
    WITH kept AS MATERIALIZED (
      SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
      FROM embeddings
      WHERE embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    parts AS MATERIALIZED (
      SELECT vec_id, part, v[part * len(v) // {PARTS} + 1 : (part + 1) * len(v) // {PARTS}] AS v
      FROM kept, (SELECT unnest(range({PARTS})) AS part)),
    firsts AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT {ENTRIES}),
    b0 AS MATERIALIZED (SELECT part, entry, v FROM parts JOIN firsts USING (vec_id)),{rounds}
    last AS MATERIALIZED ({assigned.format(book=f"b{ROUNDS}")}),
    codes AS (
      SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
      FROM last GROUP BY vec_id),
    books AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{ROUNDS})
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
    FROM codes JOIN kept USING (vec_id), books
    """
