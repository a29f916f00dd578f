"""Benchmark decontamination with an FM-index per shard of training text.

A shard is a run of whole texts of one task.  Its words are coded by the
vocabulary of the test phrases; everything else is one separator symbol, and
runs of known words that are shorter than every phrase are separators too, as
no phrase can occur there.  Over the coded shard the task builds a suffix
array, its Burrows-Wheeler transform in a wavelet matrix and a sample of the
suffix positions.  All phrases advance together in the backward search, each
step one rank per phrase; occurrences are located through the sampled
positions and merged into removal spans.

Words are ``WORD_PATTERN`` with A-Z lower-cased.  A phrase is ``window``
consecutive words of an item, or all words of a shorter item.  A text that is
null or empty has no words and no hits; an item without words has no phrases;
a null item id counts as the empty string, and rows of the same id are one
item.  Repeated documents are searched each for itself.  Without items nothing
is hit.  Extra columns of either table are ignored (or, where texts are
filtered, passed on).

The test items are the query set.  They are broadcast in blocks of at most
``BLOCK_BYTES`` of text, whose number follows from their measured size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.session import pin

from .shared import share, shared
from .textbytes import MULTIPLIERS, WORD_PATTERN, SpanHashes, chunks, lower_table, word_spans, word_table

#: Words of a phrase.
WINDOW = 10

#: Bytes of items that are searched for in one pass over the documents.
BLOCK_BYTES = 16 << 20

#: Text positions between two sampled ones.
SAMPLE = 8

#: Bytes of text in a shard.
SHARD_BYTES = 2 << 20


class Phrases:
    """The distinct phrases of some items, coded by their vocabulary."""

    def __init__(self, items: list[tuple[str, list[str]]], window: int) -> None:
        known: dict[tuple[str, ...], set[str]] = {}
        for item, words in items:
            for k in range(max(1, len(words) - window + 1) if words else 0):
                known.setdefault(tuple(words[k : k + window]), set()).add(item)
        self.items = [sorted(x) for x in known.values()]
        words = sorted({w for phrase in known for w in phrase})
        joined = np.frombuffer("".join(words).encode(), np.uint8)
        ends = np.cumsum([len(w.encode()) for w in words], dtype=np.int64) if words else np.zeros(0, np.int64)
        starts = ends - np.diff(ends, prepend=0)
        hashes = [SpanHashes(m).load(joined).of(starts, ends) for m in MULTIPLIERS]
        order = np.argsort(hashes[0])
        self.hashes, self.checks = hashes[0][order], hashes[1][order]
        code = {words[k]: i + 2 for i, k in enumerate(order.tolist())}  # 0 ends the text, 1 separates
        self.symbols = len(words) + 2
        self.lengths = np.array([len(p) for p in known], np.int64)
        self.codes = np.zeros((len(known), window), np.int64)
        for row, phrase in enumerate(known):
            self.codes[row, : len(phrase)] = [code[w] for w in phrase]
        self.least = int(self.lengths.min()) if len(known) else 0


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix positions in order, by prefix doubling; the last symbol occurs once and is the smallest."""
    order = np.argsort(text, kind="stable")
    rank = np.empty(len(text), np.int64)
    step = 1
    sorted_keys = text[order]
    while True:
        rank[order] = np.cumsum(np.concatenate(([0], sorted_keys[1:] != sorted_keys[:-1])))
        if rank[order[-1]] == len(text) - 1:
            return order
        after = np.zeros(len(text), np.int64)
        after[:-step] = rank[step:] + 1
        keys = rank * (len(text) + 1) + after
        order = np.argsort(keys, kind="stable")
        sorted_keys = keys[order]
        step *= 2


class FMIndex:
    """Backward search over a sequence of symbols below ``symbols``; symbol 0 must end it and occur nowhere else."""

    def __init__(self, text: np.ndarray, symbols: int, sample: int = SAMPLE) -> None:
        places = suffix_array(text)
        self.bwt = text[places - 1]
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols))))[:symbols]
        self.levels = []
        left = self.bwt
        for level in range(max(1, int(symbols - 1).bit_length()) - 1, -1, -1):
            bits = (left >> level) & 1
            ones = np.concatenate(([0], np.cumsum(bits)))
            self.levels.append((level, len(text) - int(ones[-1]), ones))
            left = np.concatenate((left[bits == 0], left[bits == 1]))
        self.sampled = places % sample == 0
        self.sample_rank = np.cumsum(self.sampled) - 1
        self.samples = places[self.sampled]

    def rank(self, symbols: np.ndarray, *places: np.ndarray) -> list[np.ndarray]:
        """For every place, how often its symbol stands before it in the transform."""
        start, at = np.zeros(len(symbols), np.int64), list(places)
        for level, zeros, ones in self.levels:
            up = (symbols >> level) & 1 == 1
            start = np.where(up, zeros + ones[start], start - ones[start])
            at = [np.where(up, zeros + ones[x], x - ones[x]) for x in at]
        return [x - start for x in at]

    def search(self, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of ``codes`` that occur, with first and end row of their suffixes."""
        rows = np.arange(len(lengths))
        low, high = np.zeros(len(rows), np.int64), np.full(len(rows), len(self.bwt), np.int64)
        out: list[tuple[np.ndarray, ...]] = []
        step = 0
        while len(rows):
            symbols = codes[rows, lengths[rows] - 1 - step]
            low, high = (self.before[symbols] + x for x in self.rank(symbols, low, high))
            step += 1
            alive = high > low
            done = alive & (lengths[rows] == step)
            out.append((rows[done], low[done], high[done]))
            alive &= ~done
            rows, low, high = rows[alive], low[alive], high[alive]
        if not out:
            return rows, low, high
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))  # type: ignore[return-value]

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes, stepping back to the next sampled one."""
        rows, found = rows.copy(), np.full(len(rows), -1, np.int64)
        open_, steps = np.arange(len(rows)), 0
        while len(open_):
            ends = self.sampled[rows[open_]]
            found[open_[ends]] = self.samples[self.sample_rank[rows[open_[ends]]]] + steps
            open_ = open_[~ends]
            symbols = self.bwt[rows[open_]]
            rows[open_] = self.before[symbols] + self.rank(symbols, rows[open_])[0]
            steps += 1
        return found


class Searcher:
    """Finds the phrases in shards of texts."""

    def __init__(self, phrases: Phrases) -> None:
        self.phrases = phrases
        self.hashes, self.check = SpanHashes(MULTIPLIERS[0]), SpanHashes(MULTIPLIERS[1])
        self.lower, self.table = lower_table(), word_table()

    def occurrences(self, lower, starts, ends, bounds) -> tuple[np.ndarray, np.ndarray]:
        """First word and phrase of every occurrence."""
        p, none = self.phrases, np.zeros(0, np.int64)
        if not len(p.lengths) or not len(starts):
            return none, none
        words = self.hashes.load(lower).of(starts, ends)
        slot = np.searchsorted(p.hashes, words)
        slot[slot == len(p.hashes)] = 0
        known = p.hashes[slot] == words
        # runs of known words that stay in one text
        opens, closes = known.copy(), known.copy()
        opens[1:] &= ~known[:-1]
        closes[:-1] &= ~known[1:]
        heads = bounds[:-1][np.diff(bounds) > 0]
        tails = bounds[1:][np.diff(bounds) > 0] - 1
        opens[heads], closes[tails] = known[heads], known[tails]
        first, last = np.flatnonzero(opens), np.flatnonzero(closes)
        long = last - first + 1 >= p.least
        first, sizes = first[long], (last - first + 1)[long]
        if not len(first):
            return none, none
        # every run, a separator after each, and the end
        begins = np.cumsum(sizes + 1) - sizes - 1
        text = np.ones(int(sizes.sum()) + len(sizes) + 1, np.int64)
        within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        origin = np.repeat(first, sizes) + within
        target = np.repeat(begins, sizes) + within
        text[target] = slot[origin] + 2
        text[-1] = 0
        back = np.full(len(text), -1, np.int64)
        back[target] = origin
        index = FMIndex(text, p.symbols)
        found, low, high = index.search(p.codes, p.lengths)
        if not len(found):
            return none, none
        counts = high - low
        rows = np.repeat(low, counts) + np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
        place, phrase = back[index.locate(rows)], np.repeat(found, counts)
        # a second hash of every word of an occurrence
        checks = self.check.load(lower)
        good = np.ones(len(place), bool)
        for k in range(p.codes.shape[1]):
            has = np.flatnonzero(p.lengths[phrase] > k)
            at = place[has] + k
            good[has] &= checks.of(starts[at], ends[at]) == p.checks[p.codes[phrase[has], k] - 2]
        return place[good], phrase[good]

    def texts(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, list[tuple[int, int]], list[str]]]:
        """Per text: number of words, merged spans of hit words (first, end), item ids in order."""
        lower = self.lower[data]
        starts, ends, bounds = word_spans(lower, offsets, self.table)
        place, phrase = self.occurrences(lower, starts, ends, bounds)
        cover = np.zeros(len(starts) + 1, np.int64)
        np.add.at(cover, place, 1)
        np.add.at(cover, place + self.phrases.lengths[phrase], -1)
        hit = np.cumsum(cover)[:-1] > 0
        text = np.searchsorted(bounds, place, side="right") - 1
        items: dict[int, set[str]] = {}
        for pair in np.unique(text * len(self.phrases.items) + phrase).tolist() if len(place) else ():
            t, one = divmod(pair, len(self.phrases.items))
            items.setdefault(t, set()).update(self.phrases.items[one])
        for t, (begin, end) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
            spans: list[tuple[int, int]] = []
            if t in items:
                edges = np.flatnonzero(np.diff(np.concatenate(([False], hit[begin:end], [False])).astype(np.int8)))
                spans = list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))
            yield end - begin, spans, sorted(items.get(t, ()))


_FOUND = "n_words long, spans array<struct<first:long,end:long>>, items array<string>"


def _blocks(items: DataFrame, window: int) -> Iterator[Phrases]:
    """The phrases of the items, ``BLOCK_BYTES`` of text at a time."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    words = F.expr(f"regexp_extract_all(translate(text, '{letters}', '{letters.lower()}'), r'({WORD_PATTERN})', 1)")
    texts = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    size = texts.select(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    for block in range(blocks):
        own = texts.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block) if blocks > 1 else texts
        yield Phrases([(r[0], r[1]) for r in own.filter("text IS NOT NULL").select("item", words).collect()], window)


def find_leaks(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document ``doc_id``, ``n_words``, ``spans`` of hit words and the ``items`` that they come from.

    ``docs`` needs ``doc_id`` and ``text``, ``items`` needs ``item_id`` and ``text``.
    """
    found = docs.select("doc_id", "text")
    for k, phrases in enumerate(_blocks(items, window)):
        if k:  # one block at a time in memory
            found = pin(found)
        found = _search(found, phrases, more=k > 0)
    return found.drop("text")


def _search(docs: DataFrame, phrases: Phrases, more: bool) -> DataFrame:
    """One block of phrases; adds to what earlier blocks have found."""
    block = share(docs.sparkSession, phrases)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(shared(block))
        for batch in batches:
            rows: list[tuple] = []
            for _, _, data, offsets in chunks(batch.column("text"), SHARD_BYTES):
                rows += searcher.texts(data, offsets)
            if more:
                before = zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist(), strict=True)
                rows = [
                    (n, merge_spans(spans + [(s["first"], s["end"]) for s in old]), sorted({*names, *own}))
                    for (n, spans, names), (old, own) in zip(rows, before, strict=True)
                ]
            span = pa.struct([("first", pa.int64()), ("end", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text"),
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([[{"first": a, "end": b} for a, b in r[1]] for r in rows], pa.list_(span)),
                    pa.array([r[2] for r in rows], pa.list_(pa.string())),
                ],
                names=["doc_id", "text", "n_words", "spans", "items"],
            )

    return docs.mapInArrow(run, f"doc_id {kind}, text string, {_FOUND}")


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans as one."""
    out: list[tuple[int, int]] = []
    for first, end in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((first, end))
    return out


def report(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document the number of words, of hit words and of items, a digest of the item ids, and whether any is hit."""
    hits = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])
    return find_leaks(docs, items, window).select(
        "doc_id",
        "n_words",
        hits.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def drop_leaking(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without any hit word, with all their columns."""
    kept = docs
    for phrases in _blocks(items, window):
        block = share(docs.sparkSession, phrases)

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            searcher = Searcher(shared(block))
            for batch in batches:
                clean: list[bool] = []
                for _, _, data, offsets in chunks(batch.column("text"), SHARD_BYTES):
                    clean += [not spans for _, spans, _ in searcher.texts(data, offsets)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        kept = kept.mapInArrow(run, docs.schema)
    return kept


def remove_spans(text: str | None, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and what stands between them."""
    text = text or ""
    words = [m.span() for m in re.finditer(r"(?:" + WORD_PATTERN.replace(r"\x3A-\x60", r"\x3A-\x40\x5B-\x60") + ")", text)]
    out, at = [], 0
    for first, end in spans:
        out.append(text[at : words[first][0]])
        at = words[end - 1][1]
    return "".join(out) + text[at:]


def oracle(window: int = WINDOW) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '{WORD_PATTERN}')"
    return f"""
    WITH docs AS (SELECT doc_id, row_number() OVER () AS copy, {words} AS w FROM documents),
    items AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {words} AS w FROM benchmark),
    phrases AS (
      SELECT DISTINCT item, len(p) AS n, array_to_string(p, ' ') AS phrase FROM (
        SELECT item, w[i:least(i + {window - 1}, len(w))] AS p
        FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - {window - 1}) + 1)) AS i FROM items WHERE len(w) > 0))),
    places AS (
      SELECT copy, doc_id, i, s.n, array_to_string(w[i:i + s.n - 1], ' ') AS phrase
      FROM (SELECT copy, doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM docs), (SELECT DISTINCT n FROM phrases) s
      WHERE i + s.n - 1 <= len(w)),
    found AS (SELECT p.copy, p.doc_id, p.i, p.n, f.item FROM places p JOIN phrases f ON p.phrase = f.phrase AND p.n = f.n),
    hits AS (SELECT copy, count(DISTINCT k) AS n FROM (SELECT copy, unnest(range(i, i + n)) AS k FROM found) GROUP BY copy),
    named AS (
      SELECT copy, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
      FROM (SELECT DISTINCT copy, item FROM found) GROUP BY copy)
    SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit,
           CAST(coalesce(n.n, 0) AS BIGINT) AS n_items, sha256(coalesce(n.ids, '')) AS items_sha256,
           coalesce(h.n, 0) > 0 AS contaminated
    FROM docs d LEFT JOIN hits h USING (copy) LEFT JOIN named n USING (copy)
    """
