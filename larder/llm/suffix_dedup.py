"""Removal of byte strings that repeat anywhere in a corpus, by distributed ranking of growing prefixes.

Every start of a ``length``-byte window is to be ranked by the window's
content, and starts whose rank is not unique are covered.  Doubling ranks of
all byte positions would sort the whole corpus several times at a multiple of
its size, so positions are sampled first, in a way that depends on content
alone: a window belongs to the position in it whose 32-byte gram has the
smallest hash (the leftmost of equal ones).  Equal windows have equal sampled
positions, and neighbouring windows share theirs, so that a row stands for
some 70 starts.

1. The starts of a sampled position are ranked by its gram (32 bytes) and by
   the whole context that their windows cover (200 to 368 bytes).  A context
   that comes twice is past the threshold for all its starts; a gram that
   comes once is unique and drops out with all its starts.
2. What is left are contexts that share a gram but differ somewhere.  One row
   per distinct context, with its bytes, goes to its gram, where the windows
   (200 bytes) are ranked among each other.  Grams with very many different
   contexts are not gathered: their windows are counted as rows.
3. The starts found are merged into spans per document.

Ranks are pairs of independent 64-bit hashes, so no global numbering is needed.

A null text is empty, texts below ``length`` bytes keep everything, repeated
rows are documents of their own (so all their windows repeat).  Rows with null
or repeated ids are told apart.  Extra columns are ignored.  A long text is
cut into overlapping pieces, so a task holds a few megabytes at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.session import pin

from .rows import REF, with_ref
from .textbytes import CHUNK_BYTES, MULTIPLIERS, SpanHashes, chunks, mix

#: Bytes of a repeated string.
LENGTH = 200

#: Bytes of the grams that positions are sampled by.
GRAM = 32

#: Different contexts of one gram that are compared in one task.
GATHERED = 4096

_PLACE_BITS = np.uint64(22)  # a piece has fewer than 2**22 bytes


def pieces(texts: pa.Array, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """First row, bytes, offsets and distance from the start of the text; windows of a long text lie in one piece each."""
    for first, _, data, offsets in chunks(texts):
        if len(offsets) > 2 or len(data) <= CHUNK_BYTES:
            yield first, data, offsets, 0
            continue
        for begin in range(0, len(data) - length + 1, CHUNK_BYTES):
            part = data[begin : begin + CHUNK_BYTES + length - 1]
            yield first, part, np.array([0, len(part)]), begin


class Sampler:
    """Ranges of window starts that share a sampled position."""

    def __init__(self, length: int, gram: int) -> None:
        self.length, self.gram = length, gram
        self.hashes = SpanHashes(MULTIPLIERS[0])

    def ranges(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        """Text, first start, number of starts, sampled position, hash of its gram, hash of the context."""
        none = np.zeros(0, np.int64)
        if len(data) < self.length:
            return none, none, none, none, none, none
        hashes = self.hashes.load(data)
        at = np.arange(len(data) - self.gram + 1)
        grams = hashes.of(at, at + self.gram)
        low_bits = (np.uint64(1) << _PLACE_BITS) - np.uint64(1)
        least, size, span = (grams & ~low_bits) | at.astype(np.uint64), 1, self.length - self.gram + 1
        while size * 2 <= span:
            least, size = np.minimum(least[:-size], least[size:]), size * 2
        if span > size:
            least = np.minimum(least[: -(span - size)], least[span - size :])
        chosen = (least & low_bits).astype(np.int64)
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(chosen)]
        whole = np.arange(len(chosen)) + self.length <= offsets[1:][text]
        new = np.ones(len(chosen), bool)
        new[1:] = (chosen[1:] != chosen[:-1]) | (text[1:] != text[:-1])
        first = np.flatnonzero(new & whole)
        breaks = np.flatnonzero(new | ~whole)
        end = np.append(breaks, len(chosen))[np.searchsorted(breaks, first, side="right")]
        place = chosen[first]
        shape = ((end - first) << 8 | (place - first)).astype(np.uint64)
        context = mix(hashes.of(first, end - 1 + self.length) + mix(shape))
        return text[first], first, end - first, place, grams[place], context


def _sampled(refs: DataFrame, length: int, gram: int) -> DataFrame:
    """One row per sampled position and context of a batch, with further occurrences in ``more``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(length, gram)
        for batch in batches:
            ids = batch.column("ref").to_numpy()
            for row, data, offsets, begin in pieces(batch.column("text"), length):
                text, first, count, place, grams, context = sampler.ranges(data, offsets)
                if not len(text):
                    continue
                at = (first - offsets[text] + begin) << 16 | count << 8 | (place - first)
                ref = ids[text + row]
                order = np.lexsort((context, grams))
                grams, context, ref, at = grams[order], context[order], ref[order], at[order]
                new = np.ones(len(order), bool)
                new[1:] = (grams[1:] != grams[:-1]) | (context[1:] != context[:-1])
                heads = np.flatnonzero(new)
                sizes = np.diff(np.append(heads, len(order))) - 1
                more: list = [None] * len(heads)
                pairs = np.stack((ref, at), axis=1)
                for k in np.flatnonzero(sizes).tolist():
                    more[k] = pairs[heads[k] + 1 : heads[k] + 1 + sizes[k]].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(grams[heads].view(np.int64)),
                        pa.array(context[heads].view(np.int64)),
                        pa.array(ref[heads]),
                        pa.array(at[heads]),
                        pa.array(more, pa.binary()),
                    ],
                    names=["gram", "context", "ref", "at", "more"],
                )

    return refs.mapInArrow(run, "gram long, context long, ref long, at long, more binary")


def _one_late(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, pa.RecordBatch | None]]:
    """Every batch with the next one."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            yield held, batch
        held = batch
    if held is not None:
        yield held, None


#: Kinds of rows after the first ranking.
REPEATED, KNOWN, ASKING = 0, 1, 2


def _rank_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (gram, context): repeated starts, and one row per context for the ranking by gram."""
    before = None
    for batch, after in _one_late(batches):
        gram, context = batch.column("gram").to_numpy(), batch.column("context").to_numpy()
        ref, at = batch.column("ref").to_numpy(), batch.column("at").to_numpy()
        same = np.zeros(len(gram) + 1, bool)  # row k and the row before it
        same[1:-1] = (gram[1:] == gram[:-1]) & (context[1:] == context[:-1])
        same[0] = before == (gram[0], context[0])
        if after is not None:
            same[-1] = (after.column("gram")[0].as_py(), after.column("context")[0].as_py()) == (gram[-1], context[-1])
        more = batch.column("more")
        has_more = more.is_valid().to_numpy(zero_copy_only=False)
        repeated = same[:-1] | same[1:] | has_more
        head = ~same[:-1]
        packed = b"".join(more.drop_null().to_pylist())
        pairs = np.frombuffer(packed, np.int64).reshape(-1, 2)
        refs = np.concatenate((ref[repeated], pairs[:, 0], ref[head]))
        n_repeated = int(repeated.sum()) + len(pairs)
        kinds = np.concatenate((np.full(n_repeated, REPEATED), np.where(repeated[head], KNOWN, ASKING)))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate((refs[:n_repeated], gram[head]))),
                pa.array(kinds.astype(np.int32)),
                pa.array(refs),
                pa.array(np.concatenate((at[repeated], pairs[:, 1], at[head]))),
            ],
            names=["key", "kind", "ref", "at"],
        )
        before = (gram[-1], context[-1])


def _rank_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (key, falling kind): repeated starts pass; grams with one context, or none that asks, drop out."""
    before, leads = None, False  # the key of the row before (if not REPEATED), and whether its first row asks
    for batch, after in _one_late(batches):
        key, kind = batch.column("key").to_numpy(), batch.column("kind").to_numpy()
        ranked = kind != REPEATED
        same = np.zeros(len(key) + 1, bool)
        same[1:-1] = (key[1:] == key[:-1]) & ranked[1:] & ranked[:-1]
        same[0] = ranked[0] and before == key[0]
        if after is not None and ranked[-1] and after.column("kind")[0].as_py() != REPEATED:
            same[-1] = after.column("key")[0].as_py() == key[-1]
        head = np.maximum.accumulate(np.where(same[:-1], -1, np.arange(len(key))))
        asks = np.where(head >= 0, kind[np.maximum(head, 0)] == ASKING, leads)
        keep = ~ranked | (asks & (same[:-1] | same[1:]))
        before, leads = (key[-1] if ranked[-1] else None), bool(asks[-1])
        yield batch.filter(pa.array(keep))


def _contexts(refs: DataFrame, open_: DataFrame, length: int) -> DataFrame:
    """The bytes of the contexts still in question."""
    wanted = open_.groupBy(F.col("ref").alias("_ref")).agg(F.collect_list(F.struct("key", "kind", "at", "hot")).alias("wanted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column("wanted")
            for row, end, data, offsets in chunks(batch.column("text")):
                part = wanted.slice(row, end - row)
                fields = part.flatten()
                sizes = pc.list_value_length(part).to_numpy(zero_copy_only=False)
                owner = np.repeat(np.arange(end - row), sizes)
                at = fields.field("at").to_numpy()
                count = (at >> 8) & 0xFF
                begin, span = offsets[owner] + (at >> 16), count + length - 1
                ends = np.cumsum(span)
                source = np.arange(int(ends[-1])) + np.repeat(begin - ends + span, span)
                content = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(),
                    len(at),
                    [None, pa.py_buffer(np.append(0, ends).astype(np.int64)), pa.py_buffer(data[source])],
                )
                ids = batch.column("ref").to_numpy()[row:end]
                yield pa.RecordBatch.from_arrays(
                    [fields.field("key"), fields.field("kind"), fields.field("hot")]
                    + [pa.array(ids[owner]), pa.array(at >> 16), pa.array(count.astype(np.int32)), content.cast(pa.binary())],
                    names=["key", "kind", "hot", "ref", "first", "n", "content"],
                )

    # both sides need all of a document, which is one row on the left
    joined = refs.join(wanted, refs["ref"] == F.col("_ref")).select("ref", "text", "wanted")
    return joined.mapInArrow(run, "key long, kind int, hot boolean, ref long, first long, n int, content binary")


def _windows(batch: pa.RecordBatch, length: int, hashes: list[SpanHashes]) -> tuple[np.ndarray, ...]:
    """Row, number within the row, and two hashes of every window of contexts."""
    _, _, data, offsets = next(chunks_of_binary(batch.column("content")))
    n = batch.column("n").to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(n)), n)
    within = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    begin = offsets[row] + within
    a, b = (h.load(data).of(begin, begin + length) for h in hashes)
    return row, within, mix(a + mix(batch.column("key").to_numpy().view(np.uint64))[row]), b


def chunks_of_binary(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """All values of a binary column at once, in the form of ``chunks``."""
    column = column.cast(pa.large_binary())
    buffers = column.buffers()
    ends = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    yield 0, len(column), np.frombuffer(buffers[2], np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def _runs(row: np.ndarray, within: np.ndarray, hit: np.ndarray, batch: pa.RecordBatch) -> pa.RecordBatch:
    """Runs of hit windows as ranges of starts."""
    opens = hit.copy()
    opens[1:] &= ~(hit[:-1] & (row[1:] == row[:-1]))
    closes = hit.copy()
    closes[:-1] &= ~(hit[1:] & (row[1:] == row[:-1]))
    a, b = np.flatnonzero(opens), np.flatnonzero(closes)
    first = batch.column("first").to_numpy()[row[a]] + within[a]
    return pa.RecordBatch.from_arrays(
        [pa.array(batch.column("ref").to_numpy()[row[a]]), pa.array(first), pa.array(b - a + 1)], names=["ref", "first", "n"]
    )


def _compare(contexts: DataFrame, length: int) -> DataFrame:
    """Repeated starts among the contexts of each gram, gathered by gram."""

    def ranked(batch: pa.RecordBatch, hashes: list[SpanHashes]) -> pa.RecordBatch:
        row, within, a, b = _windows(batch, length, hashes)
        asking = batch.column("kind").to_numpy()[row] == ASKING
        order = np.lexsort((b, a))
        new = np.ones(len(order), bool)
        new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
        heads = np.flatnonzero(new)
        weight = np.add.reduceat(np.where(asking, 1, 2)[order], heads)
        hit = np.empty(len(order), bool)
        hit[order] = np.repeat(weight >= 2, np.diff(np.append(heads, len(order))))
        return _runs(row, within, hit & asking, batch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held = [SpanHashes(m) for m in MULTIPLIERS], None
        for batch, after in _one_late(batches):
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            held = None
            if after is not None:  # the last gram may go on in the next batch
                key = batch.column("key").to_numpy()
                cut = int(np.searchsorted(key, key[-1]))
                held, batch = batch.slice(cut), batch.slice(0, cut)
            if batch.num_rows:
                yield ranked(batch, hashes)

    return contexts.repartition("key").sortWithinPartitions("key").mapInArrow(run, "ref long, first long, n long")


def _count(contexts: DataFrame, length: int) -> DataFrame:
    """The same for grams with very many contexts, whose windows are counted as rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = [SpanHashes(m) for m in MULTIPLIERS]
        for batch in batches:
            if batch.num_rows:
                row, within, a, b = _windows(batch, length, hashes)
                asking = batch.column("kind").to_numpy()[row] == ASKING
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(np.where(asking, 1, 2))]
                    + [pa.array(batch.column("ref").to_numpy()[row]), pa.array(batch.column("first").to_numpy()[row] + within)],
                    names=["a", "b", "weight", "ref", "first"],
                )

    windows = contexts.mapInArrow(run, "a long, b long, weight long, ref long, first long")
    repeated = windows.groupBy("a", "b").agg(F.sum("weight").alias("total")).filter("total >= 2")
    return windows.filter("weight = 1").join(repeated, ["a", "b"]).select("ref", "first", F.lit(1).cast("long").alias("n"))


def repeated_starts(refs: DataFrame, length: int = LENGTH, gathered: int = GATHERED) -> DataFrame:
    """``ref``, ``first`` and ``n``: ranges of starts of strings that also start elsewhere."""
    gram = min(GRAM, length)
    sampled = _sampled(refs.select("ref", "text"), length, gram)
    by_context = sampled.repartition("gram", "context").sortWithinPartitions("gram", "context")
    rows = by_context.mapInArrow(_rank_contexts, "key long, kind int, ref long, at long")
    by_gram = rows.repartition("key").sortWithinPartitions("key", F.desc("kind"))
    ranked = pin(by_gram.mapInArrow(_rank_grams, "key long, kind int, ref long, at long"))
    whole = ranked.filter(F.col("kind") == REPEATED).select(
        "ref", F.shiftright("at", 16).alias("first"), F.shiftright("at", 8).bitwiseAND(F.lit(255)).alias("n")
    )
    open_ = ranked.filter(F.col("kind") != REPEATED)
    sizes = open_.groupBy(F.col("key").alias("_key")).count().filter(F.col("count") > gathered).select("_key")
    marked = open_.join(sizes, open_["key"] == F.col("_key"), "left").withColumn("hot", F.col("_key").isNotNull())
    contexts = pin(_contexts(refs, marked.select("key", "kind", "ref", "at", "hot"), length))
    few = _compare(contexts.filter(~F.col("hot")), length)
    many = _count(contexts.filter(F.col("hot")), length)
    return whole.unionByName(few).unionByName(many)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gathered: int = GATHERED) -> DataFrame:
    """Per document ``doc_id``, ``n_bytes``, the removed ``spans`` of bytes (first, end) and the ``kept`` bytes."""
    refs = with_ref(docs.select("doc_id", "text")).withColumnRenamed(REF, "ref")
    starts = repeated_starts(refs, length, gathered)
    ranges = starts.groupBy(F.col("ref").alias("_ref")).agg(F.collect_list(F.struct("first", "n")).alias("ranges"))
    joined = refs.join(ranges, refs["ref"] == F.col("_ref"), "left").select("doc_id", "text", "ranges")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("first", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            for row, stop, data, offsets in chunks(batch.column("text")):
                part = batch.column("ranges").slice(row, stop - row)
                sizes = pc.fill_null(pc.list_value_length(part), 0).to_numpy(zero_copy_only=False)
                fields = part.flatten()
                begin = offsets[:-1][np.repeat(np.arange(stop - row), sizes)] + fields.field("first").to_numpy()
                cover = np.zeros(len(data) + 1, np.int32)
                np.add.at(cover, begin, 1)
                np.add.at(cover, begin + fields.field("n").to_numpy() + length - 1, -1)
                gone = np.cumsum(cover)[:-1] > 0
                opens, closes = gone.copy(), gone.copy()
                filled = offsets[1:] > offsets[:-1]
                opens[1:] &= ~gone[:-1]
                closes[:-1] &= ~gone[1:]
                heads, tails = offsets[:-1][filled], offsets[1:][filled] - 1
                opens[heads], closes[tails] = gone[heads], gone[tails]
                first, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
                edges = np.searchsorted(first, offsets)
                left = np.concatenate(([0], np.cumsum(~gone)))[offsets]
                base = np.repeat(offsets[:-1], np.diff(edges))
                spans = pa.StructArray.from_arrays([pa.array(first - base), pa.array(end - base)], fields=list(span))
                kept = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), stop - row, [None, pa.py_buffer(left.astype(np.int64)), pa.py_buffer(data[~gone])]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(row, stop - row),
                        pa.array(np.diff(offsets)),
                        pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), spans),
                        kept.cast(pa.binary()),
                    ],
                    names=["doc_id", "n_bytes", "spans", "kept"],
                )

    return joined.mapInArrow(run, f"doc_id {kind}, n_bytes long, spans array<struct<first:long,end:long>>, kept binary")


def report(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per document its bytes, the removed bytes and spans, and a digest of what is kept."""
    return remove_repeats(docs, length).select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def oracle(length: int = LENGTH) -> str:
    return f"""
    WITH docs AS (
      SELECT doc_id, row_number() OVER () AS copy, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
    starts AS (SELECT copy, h, unnest(range(0, len(h) // 2 - {length - 1})) AS s FROM docs WHERE len(h) >= {2 * length}),
    windows AS (SELECT copy, s, md5(substr(h, CAST(2 * s + 1 AS BIGINT), {2 * length})) AS w FROM starts),
    repeated AS (
      SELECT copy, s FROM windows WHERE w IN (SELECT w FROM windows GROUP BY w HAVING count(*) > 1)),
    islands AS (
      SELECT copy, s, sum(CASE WHEN s <= before + {length} THEN 0 ELSE 1 END) OVER (PARTITION BY copy ORDER BY s) AS island
      FROM (SELECT copy, s, lag(s, 1, -{2 * length}) OVER (PARTITION BY copy ORDER BY s) AS before FROM repeated)),
    spans AS (SELECT copy, min(s) AS first, max(s) + {length} AS stop FROM islands GROUP BY copy, island),
    gaps AS (
      SELECT copy, first, stop, lag(stop, 1, 0) OVER (PARTITION BY copy ORDER BY first) AS start FROM spans),
    cut AS (
      SELECT g.copy, count(*) AS n, sum(g.stop - g.first) AS removed, max(g.stop) AS last,
             string_agg(substr(d.h, CAST(2 * g.start + 1 AS BIGINT), CAST(2 * (g.first - g.start) AS BIGINT)), '' ORDER BY g.first) AS h
      FROM gaps g JOIN docs d USING (copy) GROUP BY g.copy)
    SELECT d.doc_id, CAST(len(d.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(c.removed, 0) AS BIGINT) AS n_removed,
           CAST(coalesce(c.n, 0) AS BIGINT) AS n_spans,
           sha256(unhex(CASE WHEN c.copy IS NULL THEN d.h ELSE c.h || substr(d.h, CAST(2 * c.last + 1 AS BIGINT)) END)) AS kept_sha256
    FROM docs d LEFT JOIN cut c USING (copy)
    """
