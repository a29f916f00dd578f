"""Self-join of documents on the Jaccard similarity of their word n-grams, with prefixes of tokens and token combinations.

A token is a 52-bit hash of ``WORDS`` consecutive words (any characters but
ASCII white space, A-Z lower-cased).  Two sets of sizes m <= n link when
100 * common >= percent * union.

Tokens have one order for all documents: rare ones first, by hash, then those
that are counted as too common, then the frequent class, by falling rarity.  A
set's prefix is as long as it may be without a link partner being missed: the
first token that two linked sets share stands in both prefixes.  The frequent
class is a first guess: what is repeated within batches of some thousand
documents, in a list of at most ``FREQUENT_TOKENS``.  What it leaves in more
than ``RARE`` prefixes is counted exactly, over all documents, kept as a table
that grows with them, and moved back.  The order decides the cost only; any
gives the same result.

* Prefix tokens are indexed one by one.  The sets of a token that at most
  ``RARE`` sets have in their prefix are candidates of each other.
* For sets with a more common token in their prefix the prefix is extended to
  the whole set, which is split by hash into more parts than linked sets of
  this size can have differences; at least one part is the same in both.  The
  parts, combinations of some seven tokens, are indexed.

Two linked sets share a first token; if few sets have it, they meet there, else
they meet in a part.  Sets that hang together by parts are a family.  A family
of up to ``FAMILY`` sets and ``FAMILY_TOKENS`` tokens is compared in one task.
In a larger one every set is compared with the set that shares its parts with
most others, the centre.  What is left are pairs of which one does not link with the centre.
The sets far from the centre go through the same again, as families of the
parts that they share among themselves, as long as a centre links enough sets.
For pairs of a far and a near set, and for far sets of a centre that links few,
the triangle inequality says that they must share many of their differences
from the centre, so the differences, which are rare tokens, are indexed with
prefixes of their own.  So no group that a centre holds together is expanded
into all its pairs, and no link between different components is lost.
A family that would make many pairs even so, as one of sets that all lie just
below the limit, is compared in blocks: two blocks of sets meet in one task,
which counts what all their sets have in common at once.  This is still
quadratic in the family, but a set travels once per block, not once per pair.
Candidates that cannot reach the overlap are dropped, all others are verified
on whole sets.

Null and empty texts have an empty set, which links with nothing.  Repeated
rows and equal sets are one class with one representative.  Rows of one id, or
without id, are documents of their own; the id of a component is the smallest
one in it, null if it has none.  Extra columns are ignored, or passed on by
``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.session import pin

from .components import components, few, listed, sifted
from .rows import REF, with_ref
from .shared import gathered, share, shared, small_batches, tidy
from .textbytes import MULTIPLIERS, SpanHashes, chunks, gram_hashes, lower_table, mix, word_spans

#: Words of a token, and the similarity in percent.
WORDS, PERCENT = 3, 90

#: Tokens of the frequent class; what is rarer than ``FREQUENT`` documents is not in it.
FREQUENT_TOKENS, FREQUENT = 1 << 20, 4

#: Documents of one batch of ``BATCH_BYTES`` that must share a token for it to be counted.
LOCAL, BATCH_BYTES = 2, 8 << 20

#: Sets that have a token in their prefix, at most, for them to be paired under it.
RARE = 24

#: Narrow rows that are handled together.
TOGETHER = 1 << 16

#: How often the sets with a more common token get a new prefix.
ROUNDS = 2

#: Sets and tokens of a family that are compared in one task, and that a centre is compared with in one task.
FAMILY, FAMILY_TOKENS = 512, 1 << 22

#: A family goes on with its far sets if its centre links ``FAMILY`` sets or one in so many.
SPLIT = 16

#: The same for a family whose far sets would make many pairs.
SPLIT_DENSE = 64

#: Pairs of far sets that are compared directly, per set of a family.
PAIRS = 64

#: Sets and tokens of a block, about; two blocks are compared in one task.
BLOCK_SETS, BLOCK_TOKENS = 1024, 1 << 20

#: Pairs that take as long as comparing one set with a block.
BLOCK_PAIRS = 32

#: A token that one in so many pairs of two blocks share is counted by a product of matrices, so many columns at a time.
DENSE, COLUMNS = 512, 1024

#: Pairs of two blocks that are counted together.
COUNTED = 1 << 20

#: Bits of a token; the others number the texts that are sorted together.
TOKEN_BITS = 52

#: Partners that a set is compared with in one task.
BLOCK = 512


class Sets:
    """Token sets of texts."""

    def __init__(self, words: int) -> None:
        self.words = words
        self.hashes, self.lower = SpanHashes(MULTIPLIERS[0]), lower_table()
        self.table = np.ones(256, bool)
        self.table[[0x20, *range(0x09, 0x0E)]] = False

    def of(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All tokens, text by text in order of their hash, and where each text starts."""
        data = self.lower[raw]
        starts, ends, bounds = word_spans(data, offsets, self.table)
        words = self.hashes.load(data).of(starts, ends)
        count = np.diff(bounds)
        grams, whole = gram_hashes(words, self.words, bounds)
        at = np.flatnonzero(whole)
        tokens, text = [grams[at]], [np.searchsorted(bounds, at, side="right") - 1]
        for n in range(1, self.words):  # shorter texts are one token
            own = np.flatnonzero(count == n)
            short = np.full(len(own), n, np.uint64)
            for k in range(n):
                short = mix(short * np.uint64(5) + words[bounds[own] + k])
            tokens.append(short)
            text.append(own)
        value, text_ = np.concatenate(tokens) >> np.uint64(64 - TOKEN_BITS), np.concatenate(text)
        order = np.argsort(text_, kind="stable") if len(text_) > len(at) else slice(None)
        value, text_ = value[order], text_[order]
        # sorted with the number of the text in the upper bits, some thousand texts at a time
        step, out, sizes = 1 << (64 - TOKEN_BITS), [], np.zeros(len(offsets) - 1, np.int64)
        edges = np.searchsorted(text_, np.arange(0, len(offsets) - 1 + step, step))
        for k, (begin, end) in enumerate(zip(edges, edges[1:], strict=False)):
            packed = value[begin:end] | (text_[begin:end] - k * step).astype(np.uint64) << np.uint64(TOKEN_BITS)
            packed.sort()
            packed = packed[np.concatenate(([True], packed[1:] != packed[:-1]))] if len(packed) else packed
            out.append(packed & np.uint64((1 << TOKEN_BITS) - 1))
            own = np.bincount((packed >> np.uint64(TOKEN_BITS)).astype(np.int64), minlength=1)
            sizes[k * step : k * step + len(own)] = own[: len(sizes) - k * step]
        return np.concatenate([*out, np.zeros(0, np.uint64)]), np.concatenate(([0], np.cumsum(sizes)))


def frequent_tokens(docs: DataFrame, words: int) -> np.ndarray:
    """The frequent class in order of falling rarity."""

    def repeated(held: list[np.ndarray]) -> pa.RecordBatch:
        tokens = np.concatenate([*held, np.zeros(0, np.uint64)])
        tokens.sort()
        ends = np.flatnonzero(np.append(tokens[1:] != tokens[:-1], len(tokens) > 0))
        n = np.diff(ends, prepend=-1)
        many = n >= LOCAL
        return pa.RecordBatch.from_arrays([pa.array(tokens[ends[many]].view(np.int64)), pa.array(n[many])], names=["token", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, held, size = Sets(words), [], 0
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column("text")):
                held.append(sets.of(data, offsets)[0])
                size += len(data)
                if size >= BATCH_BYTES:
                    yield repeated(held)
                    held, size = [], 0
        yield repeated(held)

    counted = docs.select("text").mapInArrow(tidy(run), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    level = F.floor(F.log2("n") * 16).cast("int")
    counted = pin(counted.filter(F.col("n") >= FREQUENT).withColumn("level", level))
    least, total = 0, 0
    for row in sorted(counted.groupBy("level").count().collect(), reverse=True):  # some hundred levels
        total += row["count"]
        if total > FREQUENT_TOKENS:
            least = row["level"] + 1
            break
    often = counted.filter(F.col("level") >= least).select("token", "n").toArrow()  # at most FREQUENT_TOKENS
    tokens, n = often.column("token").to_numpy().view(np.uint64), often.column("n").to_numpy()
    return tokens[np.lexsort((tokens, n))]


def prefixes(
    tokens: np.ndarray, bounds: np.ndarray, wanted: np.ndarray, frequent: np.ndarray, order: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first ``wanted`` tokens of every set, rare ones first, where each set's begin, and how many of them are rare.

    ``frequent`` is sorted, ``order`` has the places of its tokens in the class.
    """
    rank = np.zeros(len(tokens), np.int64)
    if len(frequent):
        slot = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
        rank = np.where(frequent[slot] == tokens, order[slot] + 1, 0)
    rare = np.concatenate(([0], np.cumsum(rank == 0)))
    owner = np.repeat(np.arange(len(wanted)), np.diff(bounds))
    taken = (rank == 0) & (rare[:-1] - rare[bounds[:-1]][owner] < wanted[owner])
    short = np.flatnonzero(rare[bounds[1:]] - rare[bounds[:-1]] < wanted)
    for k in short.tolist():
        begin, end = bounds[k], bounds[k + 1]
        often = begin + np.flatnonzero(rank[begin:end])
        missing = wanted[k] - int(rare[end] - rare[begin])
        taken[often[np.argsort(rank[often], kind="stable")][:missing]] = True
    # in their order within each set
    place = np.flatnonzero(taken)
    place = place[np.lexsort((tokens[place], rank[place], owner[place]))]
    ends = np.concatenate(([0], np.cumsum(np.bincount(owner[place], minlength=len(wanted)))))
    return tokens[place], ends, np.minimum(rare[bounds[1:]] - rare[bounds[:-1]], wanted)


def overlap(n: np.ndarray | int, percent: int):
    """Tokens that a set of ``n`` shares with any link partner, at least."""
    return -(-percent * n // 100)


class SizeClasses:
    """Ranges of set sizes such that linked sets are of the same or of neighbouring ranges."""

    def __init__(self, percent: int) -> None:
        if not 50 <= percent <= 100:
            raise ValueError("percent from 50 to 100")
        lows = [1]
        while lows[-1] < 1 << 40:
            lows.append(max(lows[-1] + 1, lows[-1] * 125 // percent))
        self.lows, self.percent = np.array(lows, np.int64), percent

    def of(self, n: int) -> int:
        return int(np.searchsorted(self.lows, n, side="right")) - 1

    def differences(self, k: int) -> int:
        """How many tokens linked sets can differ in, if the larger is in range ``k``."""
        return int((self.lows[k + 1] - 1) * (100 - self.percent) // self.percent)


def parts_of(tokens: np.ndarray, classes: SizeClasses) -> np.ndarray:
    """Index keys of the parts of a set, for its own range of sizes and the next."""
    keys = []
    own = classes.of(len(tokens))
    for k in (own, own + 1):
        least = classes.differences(k)
        count = least + 1 + least // 8 + 2
        part = (mix(tokens + np.uint64(k + 1)) % np.uint64(count)).astype(np.int64)
        content = np.zeros(count, np.uint64)
        np.add.at(content, part, mix(tokens ^ np.uint64(0x5851F42D4C957F2D)))
        filled = np.bincount(part, minlength=count) > 0
        # if too few parts have tokens, parts may also agree by being empty
        used = np.flatnonzero(filled) if filled.sum() > least else np.arange(count)
        keys.append(mix(content[used] + mix(used.astype(np.uint64) * np.uint64(4096) + np.uint64(k + 1))))
    return np.concatenate(keys)


def _signatures(refs: DataFrame, words: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """Per document the size of its set, a digest of it and its prefix; equal sets of a batch leave the prefix to the first."""
    at = np.argsort(frequent)
    block = share(refs.sparkSession, (frequent[at], at))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, (often, order) = Sets(words), shared(block)
        for batch in batches:
            for row, end, data, offsets in chunks(batch.column("text")):
                tokens, bounds = sets.of(data, offsets)
                n = np.diff(bounds)
                sums = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(tokens ^ np.uint64(m))))) for m in MULTIPLIERS]
                digests = [(s[bounds[1:]] - s[bounds[:-1]]).view(np.int64) for s in sums]
                _, first = np.unique(np.stack([n, *digests]), axis=1, return_index=True)
                length = np.zeros(len(n), np.int64)
                length[first] = np.where(n > 0, n - overlap(n, percent) + 1, 0)[first]
                prefix, ends, rare = prefixes(tokens, bounds, length, often, order)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(row, end - row),
                        batch.column(REF).slice(row, end - row),
                        pa.array(n),
                        *map(pa.array, digests),
                        pa.array(rare),
                        pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(prefix.view(np.int64))),
                    ],
                    names=["doc_id", REF, "n", "digest_a", "digest_b", "n_rare", "prefix"],
                )

    kind = refs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {REF} long, n long, digest_a long, digest_b long, n_rare long, prefix array<long>"
    return refs.mapInArrow(tidy(run), schema)


def _entries(arrays: DataFrame) -> DataFrame:
    """One row per set and token of its prefix; ``rare`` if the token is of no class that the set knows."""
    rows = arrays.select("node", "n", "n_rare", F.posexplode("prefix").alias("at", "key"))
    return rows.select("key", "node", "n", (F.col("at") + 1).cast("long").alias("place"), (F.col("at") < F.col("n_rare")).alias("rare"))


def _rebuilt(refs: DataFrame, crowded: DataFrame, words: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """Prefixes of the sets of ``crowded`` (``node`` and ``tokens`` with their counts), whose tokens come after the rare ones."""
    at = np.argsort(frequent)
    block = share(refs.sparkSession, (frequent[at], at))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, (often, order) = Sets(words), shared(block)
        for batch in batches:
            later = batch.column("tokens").to_pylist()
            for row, end, data, offsets in chunks(batch.column("text")):
                tokens, bounds = sets.of(data, offsets)
                n = np.diff(bounds)
                wanted = np.where(n > 0, n - overlap(n, percent) + 1, 0)
                found, rare = [], []
                for k in range(end - row):
                    own = tokens[bounds[k] : bounds[k + 1]]
                    rank = np.zeros(len(own), np.int64)
                    if len(often):
                        slot = np.minimum(np.searchsorted(often, own), len(often) - 1)
                        rank = np.where(often[slot] == own, order[slot] + (1 << 60), 0)
                    known = np.array([t["key"] for t in later[row + k]], np.int64).view(np.uint64)
                    rank[np.searchsorted(own, known)] = [t["held"] for t in later[row + k]]
                    found.append(own[np.lexsort((own, rank))[: wanted[k]]])
                    rare.append(min(int((rank == 0).sum()), int(wanted[k])))
                ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(REF).slice(row, end - row),
                        pa.array(n),
                        pa.array(rare, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found).view(np.int64))),
                    ],
                    names=["node", "n", "n_rare", "prefix"],
                )

    return _texts(refs, crowded.withColumnRenamed("node", "_to")).mapInArrow(tidy(run), "node long, n long, n_rare long, prefix array<long>")


def _whole_sets(refs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """All tokens of some sets as entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = Sets(words)
        for batch in batches:
            for row, end, data, offsets in chunks(batch.column("text")):
                tokens, bounds = sets.of(data, offsets)
                owner = np.repeat(np.arange(end - row), np.diff(bounds))
                nodes_ = batch.column(REF).slice(row, end - row).to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tokens.view(np.int64)), pa.array(nodes_[owner]), pa.array(np.diff(bounds)[owner])], names=["key", "node", "n"]
                )

    rows = _texts(refs, nodes.select(F.col("node").alias("_to"))).mapInArrow(tidy(run), "key long, node long, n long")
    return rows.select("key", "node", "n", F.lit(1).cast("long").alias("place"), F.lit(True).alias("rare"))


def _index(refs: DataFrame, arrays: DataFrame, words: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """Entries (``key``, ``node``, ``n``, ``place``) of all sets, by an order in which tokens of many prefixes come late.

    Tokens that more than ``RARE`` prefixes have are counted, over all sets, and
    come after the rare ones, by count; the sets that have them get a new
    prefix.  What is counted is a table, joined to the prefixes.  A count stays
    once it is made, so that the order is the same for all sets.  Sets that
    still have such a token after ``ROUNDS`` rounds are indexed with all tokens,
    which needs no order.
    """
    entries, rebuilt, ranked, hits = _entries(arrays), None, None, None

    def counted(rows: DataFrame, name: str) -> DataFrame:
        return rows.filter("rare").groupBy("key").agg(F.count("*").alias(name))

    several = pin(counted(entries, "held").filter("held > 1"))
    crowded = pin(several.filter(F.col("held") > RARE))
    for step in range(ROUNDS + 1):
        if crowded.isEmpty():
            break
        found = pin(entries.filter("rare").join(listed(crowded.select("key", "held")), "key").select("node", "key", "held"))
        if step == ROUNDS:
            stale = pin(found.select("node").distinct())
            return entries.join(listed(stale), "node", "left_anti").unionByName(_whole_sets(refs, stale, words))
        ranked = crowded if ranked is None else pin(ranked.unionByName(crowded.filter("new").drop("new")))
        hits = found if hits is None else pin(hits.unionByName(found))
        nodes = found.select("node").distinct()
        lists = hits.join(nodes, "node", "left_semi").groupBy("node").agg(F.collect_list(F.struct("key", "held")).alias("tokens"))
        fresh = pin(_rebuilt(refs, lists, words, percent, frequent))
        rebuilt = fresh if rebuilt is None else pin(rebuilt.join(fresh.select("node"), "node", "left_anti").unionByName(fresh))
        done = listed(pin(rebuilt.select("node")))
        entries = _entries(arrays.join(done, "node", "left_anti")).unionByName(_entries(rebuilt))
        # the counts change by what the new prefixes have and the old ones had; a token that is not among those of several sets had one
        old = counted(_entries(arrays.join(done, "node", "left_semi")), "gone")
        now = counted(_entries(rebuilt), "come").join(old, "key", "left").join(several, "key", "left")
        held = F.coalesce("held", F.lit(1)) - F.coalesce("gone", F.lit(0)) + F.col("come")
        before = ranked.select("key", F.col("held").alias("known"))
        now = now.select("key", held.alias("held")).join(before, "key", "left").filter(F.col("known").isNotNull() | (F.col("held") > RARE))
        crowded = pin(now.select("key", F.coalesce("known", "held").alias("held"), F.col("known").isNull().alias("new")))
    return entries


def _rare_pairs(percent: int):
    """Rows in order of (key, n, node): pairs of sets under rare keys, and a row without ``b`` for every set under a frequent one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, frequent = None, None
        for batch in _and_end(gathered(batches, TOGETHER)):
            if batch is None and held is None:
                break
            final = batch is None
            if held is not None:
                batch = held if final else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            key, node, n, place = (batch.column(c).to_numpy() for c in ("key", "node", "n", "place"))
            heads = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            sizes = np.diff(np.append(heads, len(key)))
            many = sizes > RARE
            many[0] |= frequent is not None and frequent == key[0]
            held = None
            if not final and not many[-1]:  # too few so far to tell
                held = batch.slice(int(heads[-1]))
                heads, sizes, many = heads[:-1], sizes[:-1], many[:-1]
            frequent = key[-1] if len(many) and many[-1] and not final else None
            rows = np.repeat(many, sizes)
            marked = np.flatnonzero(rows)
            out = [(node[marked], np.full(len(marked), -1), n[marked], n[marked], np.zeros(len(marked), bool))]
            for size in range(2, RARE + 1):
                begin = heads[(sizes == size) & ~many]
                for i in range(size):
                    for j in range(i + 1, size):
                        a, b = begin + i, begin + j
                        near = n[b] * percent <= n[a] * 100
                        a, b = a[near], b[near]
                        least = -(-percent * (n[a] + n[b]) // (100 + percent))
                        good = 1 + np.minimum(n[a] - place[a], n[b] - place[b]) >= least
                        out.append((node[a], node[b], n[a], n[b], good))
            columns = [np.concatenate(x) for x in zip(*out, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in columns[:1]]
                + [pa.array(columns[1], mask=np.arange(len(columns[1])) < len(marked))]
                + [pa.array(c) for c in columns[2:]],
                names=["a", "b", "a_n", "b_n", "good"],
            )

    return run


def _parts(refs: DataFrame, marked: DataFrame, words: int, percent: int) -> DataFrame:
    """The parts of the marked sets (``node``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, classes = Sets(words), SizeClasses(percent)
        for batch in batches:
            for row, end, data, offsets in chunks(batch.column("text")):
                tokens, bounds = sets.of(data, offsets)
                keys = [parts_of(tokens[a:b], classes) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                owner = np.repeat(np.arange(end - row), [len(k) for k in keys])
                nodes = batch.column(REF).slice(row, end - row).to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)), pa.array(nodes[owner]), pa.array(np.diff(bounds)[owner])],
                    names=["key", "node", "n"],
                )

    return _texts(refs, marked.select(F.col("node").alias("_to"))).mapInArrow(tidy(run), "key long, node long, n long")


def _texts(refs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``refs`` whose number is in ``_to``, with the other columns of ``wanted``.

    A list of checked size is broadcast to the scan of the texts; for a longer one, the texts that it may hold are merged with it.
    """
    wanted = pin(wanted)
    if few(wanted):
        return refs.join(F.broadcast(wanted), refs[REF] == F.col("_to"))
    some = sifted(refs, REF, wanted, "_to").filter("_maybe").drop("_maybe")
    return some.join(wanted.hint("merge"), some[REF] == F.col("_to"))


def _with_pivots(percent: int):
    """Rows in order of (key, n, node): those of shared keys, each with its pivot, an earlier row of its key.

    The pivot is the first row of the key, or the last one too large for the pivot before it, so a row's size may
    link with its pivot's.  A pivot also has the row directly before it, if their sizes may link.  A row without
    such a row has itself.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last, pivot, before = None, None, None, None
        for batch in _and_end(gathered(batches, TOGETHER)):
            if held is not None:
                key = held.column("key").to_numpy()
                same = np.zeros(len(key) + 1, bool)
                same[1:-1] = key[1:] == key[:-1]
                same[0] = last is not None and last == key[0]
                same[-1] = batch is not None and batch.column("key")[0].as_py() == key[-1]
                node, n = held.column("node").to_numpy(), held.column("n").to_numpy()
                shift = 2 * int(same[0])
                if shift:  # pivot and last row of the key stand before the batch
                    node, n = np.concatenate(([pivot[0], before[0]], node)), np.concatenate(([pivot[1], before[1]], n))
                start = np.concatenate((np.array([True, False])[:shift], ~same[:-1]))
                head = np.maximum.accumulate(np.where(start, np.arange(len(n)), 0))
                while True:
                    far = n * percent > n[head] * 100
                    if not far.any():
                        break
                    far[1:] &= ~(far[:-1] & (head[1:] == head[:-1]))  # the first of each key becomes a pivot
                    fresh = np.maximum.accumulate(np.where(far, np.arange(len(n)), 0))
                    head = np.where(fresh >= head, fresh, head)
                before_it = np.maximum(np.arange(len(n)) - 1, 0)
                alone = start | (head != np.arange(len(n))) | (n * percent > n[before_it] * 100)
                chain = np.where(alone, np.arange(len(n)), before_it)
                last, pivot, before = key[-1], (node[head[-1]], n[head[-1]]), (node[-1], n[-1])
                shared = same[:-1] | same[1:]
                own = held.filter(pa.array(shared))
                arrays = [pa.array(node[x][shift:][shared]) for x in (head, chain)]
                yield pa.RecordBatch.from_arrays([*own.columns, *arrays], names=[*own.schema.names, "pivot", "chain"])
            held = batch

    return run


def _and_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    """The batches that hold rows, then None."""
    for batch in batches:
        if batch.num_rows:
            yield batch
    yield None


def _verify(refs: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) with ``linked``, by their whole sets.

    The partners of a set come to its task one after the other; a set with
    more than ``BLOCK`` of them is sent to several tasks.
    """
    pairs = pin(pairs)
    if pairs.isEmpty():
        return pairs.select("a", "b", F.lit(True).alias("linked"))
    large = pairs.groupBy(F.col("a").alias("_a")).count().filter(F.col("count") > BLOCK)
    parts = F.coalesce(F.ceil(F.col("count") / BLOCK), F.lit(1)).cast("int")
    dealt = pairs.join(large, pairs["a"] == F.col("_a"), "left").select("a", "b", F.pmod(F.hash("b"), parts).alias("part"))
    goal = F.struct("a", "part", "member").alias("goal")
    members = dealt.select(F.col("b").alias("_to"), "a", "part", F.lit(1).alias("member"))
    pivots = dealt.select(F.col("a").alias("_to"), "a", "part", F.lit(0).alias("member"))
    goals = members.union(pivots).select("_to", goal).groupBy("_to").agg(F.collect_set("goal").alias("goals"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, pivot = Sets(words), np.zeros(0, np.uint64)
        for batch in batches:
            firsts, seconds, linked = [], [], []
            columns = [batch.column(c).to_pylist() for c in ("a", "member", "b")]
            for row, end, data, offsets in chunks(batch.column("text")):
                tokens, bounds = sets.of(data, offsets)
                for k in range(row, end):
                    a, member, b = (c[k] for c in columns)
                    own = tokens[bounds[k - row] : bounds[k - row + 1]]
                    if not member:
                        pivot = own.copy()
                        continue
                    few, many = sorted((own, pivot), key=len)
                    slot = np.searchsorted(many, few)
                    slot[slot == len(many)] = 0
                    common = int((many[slot] == few).sum()) if len(many) else 0
                    firsts.append(a)
                    seconds.append(b)
                    linked.append(100 * common >= percent * (len(few) + len(many) - common))
            yield pa.RecordBatch.from_arrays(
                [pa.array(firsts, pa.int64()), pa.array(seconds, pa.int64()), pa.array(linked, pa.bool_())],
                names=["a", "b", "linked"],
            )

    sent = _texts(refs, goals).select(F.explode("goals").alias("goal"), F.col(REF).alias("b"), "text")
    sent = sent.select("goal.a", "goal.part", "goal.member", "b", "text")
    dealt_out = sent.repartition("a", "part").sortWithinPartitions("a", "part", "member")
    return pin(dealt_out.mapInArrow(tidy(compare), "a long, b long, linked boolean"))


def _rest_verified(refs: DataFrame, pairs: DataFrame, links: DataFrame, words: int, percent: int) -> DataFrame:
    """Components (``node``, ``component``) of ``links`` and of what is linked among ``pairs``.

    Pairs that the links have connected already need no comparison.
    """
    known = components(links)
    held = listed(known)
    for side in ("a", "b"):
        own = held.select(F.col("node").alias(f"_{side}"), F.col("component").alias(f"_in_{side}"))
        pairs = pairs.join(own, F.col(side) == F.col(f"_{side}"), "left")
    apart = pairs.filter(F.coalesce("_in_a", "a") != F.coalesce("_in_b", "b")).select("a", "b")
    more = pin(_verify(refs, apart, words, percent).filter("linked").select("a", "b"))
    if more.isEmpty():
        return known
    return components(known.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))


def _members(refs: DataFrame, words: int, percent: int) -> DataFrame:
    """Per document ``doc_id``, ``REF``, ``n`` and the ``component`` of its set, the smallest ``REF`` in it."""
    small_batches(refs.sparkSession)
    refs = refs.select("doc_id", REF, "text")
    frequent = frequent_tokens(refs, words)
    signatures = pin(_signatures(refs, words, percent, frequent))
    digest = ["n", "digest_a", "digest_b"]
    filled = signatures.filter("n > 0")
    # a set's representative has a prefix; in every batch the first of equal sets has one
    classes = filled.filter("size(prefix) > 0").groupBy(*digest).agg(F.min(REF).alias("node"))
    node_of = pin(
        signatures.select("doc_id", REF, *digest, (F.size("prefix") > 0).alias("indexed"))
        .join(classes, digest, "left")
        .select("doc_id", REF, "n", "indexed", F.coalesce("node", REF).alias("node"))
    )

    # single tokens
    least = f"ceil({percent} * (a_n + b_n) / {100 + percent}.0)"
    copies = node_of.filter(F.col("indexed") & (F.col("node") != F.col(REF))).select(F.col(REF).alias("node"))
    arrays = filled.select(F.col(REF).alias("node"), "n", "n_rare", "prefix")
    arrays = pin(arrays.join(listed(pin(copies)), "node", "left_anti"))
    by_token = pin(
        _index(refs, arrays, words, percent, frequent)
        .select("key", "node", "n", "place")
        .repartition("key")
        .sortWithinPartitions("key", "n", "node")
        .mapInArrow(tidy(_rare_pairs(percent)), "a long, b long, a_n long, b_n long, good boolean")
    )
    marked = by_token.filter("b IS NULL").select(F.col("a").alias("node")).distinct()
    rare = by_token.filter("b IS NOT NULL").groupBy("a", "b", "a_n", "b_n").agg(
        F.count("*").alias("shared"), F.max("good").alias("good")
    )
    # a linked pair that shares a frequent token as well meets in a part; all that others share in their prefixes is counted
    beyond = f"greatest(ceil({percent} * a_n / 100.0), ceil({percent} * b_n / 100.0)) - 1"
    rare = rare.filter(f"good AND shared + {beyond} >= {least}")
    # combinations
    by_part = pin(
        _parts(refs, marked, words, percent)
        .repartition("key")
        .sortWithinPartitions("key", "n", "node")
        .mapInArrow(tidy(_with_pivots(percent)), "key long, node long, n long, pivot long, chain long")
    )
    pairs = rare.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "shared")
    # every set is first compared with the one that it shares most with
    place = F.row_number().over(Window.partitionBy("b").orderBy(F.desc("shared"), "a"))
    pairs = pin(pairs.select("a", "b", place.alias("place")))
    best = _verify(refs, pairs.filter("place = 1").select("a", "b"), words, percent).filter("linked").select("a", "b")
    links, far = _link_families(refs, by_part, words, percent)
    rest = pairs.filter("place > 1").select("a", "b").unionByName(far)
    found = _rest_verified(refs, rest, links.unionByName(best), words, percent)
    return node_of.join(found.withColumnRenamed("node", "_found"), F.col("node") == F.col("_found"), "left").select(
        "doc_id", REF, "n", F.coalesce("component", "node").alias("component")
    )


def _link_families(refs: DataFrame, by_part: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links ``a``, ``b`` between sets that share parts, and candidates to be verified: enough of both for all components."""
    # every set hangs on one pivot, and its other pivots on that one
    chain = F.when(F.col("chain") != F.col("node"), F.col("chain"))
    pivots = by_part.groupBy("node").agg(F.collect_set("pivot").alias("pivots"), F.collect_set(chain).alias("chains"), F.max("n").alias("n"))
    pivots = pin(pivots.withColumn("first", F.array_min("pivots")))
    hang = pivots.select(F.col("node").alias("a"), F.explode(F.concat(F.array("first"), "chains")).alias("b"))
    hang = hang.union(pivots.filter("size(pivots) > 1").select("first", F.explode("pivots"))).filter("a <> b").distinct()
    own = listed(components(hang)).withColumnsRenamed({"node": "_node", "component": "family"})
    families = pivots.select("node", "n").join(own, F.col("node") == F.col("_node")).select("node", "n", "family")
    tasks = F.greatest(F.ceil(F.count("*") / FAMILY), F.ceil(F.sum("n") / FAMILY_TOKENS)).cast("int").alias("tasks")
    sizes = listed(pin(families.groupBy("family").agg(F.count("*").alias("size"), tasks)))
    families = pin(families.join(sizes, "family"))
    small = families.filter(F.col("tasks") == 1).select(F.col("node").alias("_to"), "family")
    linked = (
        _texts(refs, small)
        .select("family", F.col(REF).alias("node"), "text")
        .repartition("family")
        .sortWithinPartitions("family")
        .mapInArrow(tidy(_compare_all(words, percent)), "a long, b long")
    )
    linked = pin(linked)
    large = pin(families.filter(F.col("tasks") > 1).drop("n"))
    if large.isEmpty():
        return linked, linked.limit(0)
    # the centre of a large family shares its parts with most sets
    holders = by_part.groupBy("key").agg(F.count("*").alias("holders"))
    shares = by_part.select("key", "node").join(holders, "key").groupBy("node").agg(F.sum("holders").alias("parts"))
    centres = shares.join(listed(large), "node").groupBy("family").agg(
        F.max_by("node", F.struct("parts", -F.col("node"))).alias("centre"), F.max("tasks").alias("tasks")
    )
    centres = listed(pin(centres))
    # a set goes to a task of its family, a centre to all of them as well
    goals = large.select("node", "family").join(centres, "family")
    member = F.struct("family", F.pmod(F.hash("node"), "tasks").alias("task"), F.lit(1).alias("member"))
    every = F.transform(F.sequence(F.lit(0), F.col("tasks") - 1), lambda task: F.struct("family", task.alias("task"), F.lit(0).alias("member")))
    both = F.when(F.col("node") == F.col("centre"), F.concat(F.array(member), every)).otherwise(F.array(member))
    goals = goals.select(F.col("node").alias("_to"), both.alias("goals"))
    sent = _texts(refs, goals).select(F.explode("goals").alias("goal"), F.col(REF).alias("node"), "text")
    sent = sent.select("goal.family", "goal.task", "goal.member", "node", "text")
    away = pin(
        sent.repartition("family", "task")
        .sortWithinPartitions("family", "task", "member")
        .mapInArrow(tidy(_differences(words)), "family long, centre long, node long, n long, n_centre long, tokens array<long>")
    )
    limit = f"{100 - percent} * (n + n_centre) div {100 + percent}"
    is_near = F.expr(f"size(tokens) <= {limit} AND node <> centre")
    near = away.filter(is_near).select(F.col("centre").alias("a"), F.col("node").alias("b"))
    enough = (F.count_if(is_near) >= FAMILY) | (F.count_if(is_near) * SPLIT >= F.count("*"))
    some = F.count_if(is_near) * SPLIT_DENSE >= F.count("*")
    split = pin(away.groupBy("family").agg(enough.alias("split"), some.alias("some")).filter("split OR some"))
    pairs, split, crossed = _far_pairs(away, split, percent)
    links, pairs = linked.unionByName(near), pin(pairs)
    if not crossed.isEmpty():
        links = links.unionByName(_cross(refs, away.select("family", "node", "n", F.expr(f"size(tokens) > {limit}").alias("far")), crossed, words, percent))
    far = pin(away.filter(f"size(tokens) > {limit}").join(listed(pin(split)), "family").select(F.col("node").alias("_far")))
    if far.isEmpty():
        return links, pairs
    # the far sets among themselves; every round leaves out what the centres link
    held = by_part.select("key", "node", "n").join(listed(far), F.col("node") == F.col("_far"), "left_semi")
    held = pin(
        held.repartition("key")
        .sortWithinPartitions("key", "n", "node")
        .mapInArrow(tidy(_with_pivots(percent)), "key long, node long, n long, pivot long, chain long")
    )
    if held.isEmpty():
        return links, pairs
    more, later = _link_families(refs, held, words, percent)
    return links.unionByName(more), pairs.unionByName(later)


def _compare_all(words: int, percent: int):
    """Rows family by family, each small: links that connect what is connected."""

    def linked(nodes: list[int], sets: list[np.ndarray]) -> Iterator[tuple[int, int]]:
        order = sorted(range(len(nodes)), key=lambda k: (len(sets[k]), nodes[k]))
        root = {k: k for k in order}

        def find(k: int) -> int:
            while root[k] != k:
                root[k] = k = root[root[k]]
            return k

        for i, x in enumerate(order):
            for y in order[i + 1 :]:
                few, many = sets[x], sets[y]
                if len(many) * percent > len(few) * 100:
                    break
                if find(x) == find(y) or not len(few):
                    continue
                slot = np.searchsorted(many, few)
                slot[slot == len(many)] = 0
                common = int((many[slot] == few).sum())
                if 100 * common >= percent * (len(few) + len(many) - common):
                    root[find(y)] = find(x)
                    yield nodes[x], nodes[y]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, now, nodes, sets = Sets(words), None, [], []

        def done() -> pa.RecordBatch:
            pairs = list(linked(nodes, sets))
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["a", "b"])

        for batch in batches:
            families, own = batch.column("family").to_pylist(), batch.column("node").to_pylist()
            for row, end, data, offsets in chunks(batch.column("text")):
                tokens, bounds = hasher.of(data, offsets)
                for k in range(row, end):
                    if families[k] != now:
                        yield done()
                        now, nodes, sets = families[k], [], []
                    nodes.append(own[k])
                    sets.append(tokens[bounds[k - row] : bounds[k - row + 1]].copy())
        yield done()

    return run


def _differences(words: int):
    """Rows in order of (family, task, member): for every member the tokens that only it or only the centre has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, middle, centre = Sets(words), np.zeros(0, np.uint64), -1
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("family", "member", "node")]
            rows: list[tuple] = []
            for row, end, data, offsets in chunks(batch.column("text")):
                tokens, bounds = sets.of(data, offsets)
                for k in range(row, end):
                    family, member, node = (c[k] for c in columns)
                    own = tokens[bounds[k - row] : bounds[k - row + 1]]
                    if not member:
                        middle, centre = own.copy(), node
                        continue
                    both = np.sort(np.concatenate((own, middle)))
                    twice = np.concatenate((both[1:] == both[:-1], [False])) if len(both) else np.zeros(0, bool)
                    once = ~twice
                    once[1:] &= ~twice[:-1]
                    rows.append((family, centre, node, len(own), len(middle), both[once].view(np.int64)))
            lists = [r[5] for r in rows]
            ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
            flat = np.concatenate([*lists, np.zeros(0, np.int64)])
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], pa.int64()) for k in range(5)]
                + [pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                names=["family", "centre", "node", "n", "n_centre", "tokens"],
            )

    return run


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many tokens every set on the left has in common with every set on the right."""
    shape = len(left), len(right)
    common = np.zeros(shape, np.float32)  # exact up to 2**24 tokens
    tokens = np.concatenate([*left, *right, np.zeros(0, np.uint64)])
    owner = np.concatenate([np.repeat(np.arange(len(side)), [len(s) for s in side]) for side in (left, right)])
    cut = sum(map(len, left))
    _, token = np.unique(tokens, return_inverse=True)
    held = [np.bincount(part, minlength=len(tokens)) for part in (token[:cut], token[cut:])]
    pairs = held[0] * held[1]
    dense = pairs * DENSE > shape[0] * shape[1]
    column = np.cumsum(dense) - 1
    for first in range(0, int(dense.sum()), COLUMNS):
        sides = []
        for n, part in zip(shape, (slice(0, cut), slice(cut, None)), strict=True):
            own = dense[token[part]] & (column[token[part]] >= first) & (column[token[part]] < first + COLUMNS)
            sides.append(np.zeros((n, COLUMNS), np.float32))
            sides[-1][owner[part][own], column[token[part]][own] - first] = 1
        common += sides[0] @ sides[1].T
    # the others pair by pair
    seldom = (pairs > 0) & ~dense
    x, y = (np.flatnonzero(seldom[token[part]]) + part.start for part in (slice(0, cut), slice(cut, len(token))))
    y = y[np.argsort(token[y], kind="stable")]
    begin = np.searchsorted(token[y], token[x])
    times = held[1][token[x]]
    ends = np.cumsum(times)
    start, flat = 0, common.reshape(-1)
    while start < len(x):
        end = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + COUNTED, side="right")))
        n = times[start:end]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        other = y[np.repeat(begin[start:end], n) + step]
        np.add.at(flat, np.repeat(owner[x[start:end]], n) * shape[1] + owner[other], np.float32(1))
        start = end
    return common


def _forest(linked: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links (row and column) that connect what the links of the matrix connect, without circles."""
    rows, columns = linked.any(axis=1), linked.any(axis=0)
    while rows.any():
        now = np.array([np.argmax(rows)])
        rows[now] = False
        while len(now):
            seen = linked[now]
            fresh = np.flatnonzero(seen.any(axis=0) & columns)
            if not len(fresh):
                break
            yield now[seen[:, fresh].argmax(axis=0)], fresh
            columns[fresh] = False
            seen = linked[:, fresh]
            now = np.flatnonzero(seen.any(axis=1) & rows)
            yield now, fresh[seen[now].argmax(axis=1)]
            rows[now] = False


def _compare_blocks(words: int, percent: int):
    """Rows in order of (family, block, other, side): links that connect what is connected between the two sides, or within one."""

    def links(nodes: list[list[int]], sets: list[list[np.ndarray]]) -> pa.RecordBatch:
        found: list[list] = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)]]
        other = 1 if nodes[1] else 0  # a block by itself has one side
        if nodes[0]:
            n = [np.array([len(s) for s in side], np.float64) for side in (sets[0], sets[other])]
            common = _common(sets[0], sets[other])
            linked = 100 * common >= percent * (n[0][:, None] + n[1] - common)
            linked &= common > 0
            if not other:
                np.fill_diagonal(linked, False)
            for x, y in _forest(linked):
                found[0].append(np.array(nodes[0], np.int64)[x])
                found[1].append(np.array(nodes[other], np.int64)[y])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(f)) for f in found], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, now, nodes, sets = Sets(words), None, ([], []), ([], [])
        for batch in batches:
            goals = list(zip(*(batch.column(c).to_pylist() for c in ("family", "block", "other")), strict=True))
            side, own = batch.column("side").to_pylist(), batch.column("node").to_pylist()
            for row, end, data, offsets in chunks(batch.column("text")):
                tokens, bounds = hasher.of(data, offsets)
                for k in range(row, end):
                    if goals[k] != now:
                        yield links(nodes, sets)
                        now, nodes, sets = goals[k], ([], []), ([], [])
                    nodes[side[k]].append(own[k])
                    sets[side[k]].append(tokens[bounds[k - row] : bounds[k - row + 1]].copy())
        yield links(nodes, sets)

    return run


def _cross(refs: DataFrame, members: DataFrame, crossed: DataFrame, words: int, percent: int) -> DataFrame:
    """Links within the families of ``crossed`` that connect what is connected: far sets with each other, or with near ones, or both.

    Far and near sets (``members``) are dealt to blocks of their own, and a set
    goes to one task for every block that its block is compared with.
    """
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_TOKENS)).cast("int")
    members = members.join(listed(crossed), "family")
    sizes = members.groupBy("family", "far").agg(blocks.alias("blocks"))
    some, none = F.max(F.when(F.col("far"), F.col("blocks"))), F.max(F.when(~F.col("far"), F.col("blocks")))
    sizes = sizes.groupBy("family").agg(F.coalesce(some, F.lit(0)).alias("fars"), F.coalesce(none, F.lit(0)).alias("nears"))
    members = members.filter("far OR with_near").join(sizes, "family")
    members = members.withColumn("own", F.pmod(F.hash("node"), F.when(F.col("far"), F.col("fars")).otherwise(F.col("nears"))))
    sent = _texts(refs, members.select(F.col("node").alias("_to"), "family", "far", "with_far", "with_near", "fars", "nears", "own"))

    def goals(count: str, goal, wanted: str):
        return F.when(F.expr(f"{wanted} AND {count} > 0"), F.transform(F.sequence(F.lit(0), F.expr(f"{count} - 1")), goal)).otherwise(F.array())

    def goal(block, other, side):
        return F.struct(block.alias("block"), other.alias("other"), side.cast("int").alias("side"))

    own, fars = F.col("own"), F.col("fars")
    far = goals("fars", lambda k: goal(F.least(k, own), F.greatest(k, own), k < own), "far AND with_far")
    far_near = goals("nears", lambda k: goal(own, fars + k, F.lit(0)), "far AND with_near")
    near_far = goals("fars", lambda k: goal(k, fars + own, F.lit(1)), "NOT far AND with_near")
    sent = sent.select("family", F.explode(F.concat(far, far_near, near_far)).alias("goal"), F.col(REF).alias("node"), "text")
    sent = sent.select("family", "goal.block", "goal.other", "goal.side", "node", "text")
    order = ["family", "block", "other"]
    return pin(sent.repartition(*order).sortWithinPartitions(*order, "side").mapInArrow(tidy(_compare_blocks(words, percent)), "a long, b long"))


def _far_pairs(away: DataFrame, centres: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Candidates ``a``, ``b`` within large families of which one at least is not linked with the centre.

    In the families of ``centres`` that are to be ``split`` only one is not; their
    far sets are compared by themselves.  So are those of the others there, if
    they have more than ``PAIRS`` pairs a set.  All such families are returned too.
    What would still make many pairs is left to blocks: the families are returned
    last, ``with_far`` if their far sets are to be compared with each other and
    ``with_near`` if with the near ones.

    Let d be the number of differences from the centre and D(x, y) how many
    differences linked x and y may have.  Linked x and y share at least
    (d(x) + d(y) - D(x, y)) / 2 differences.  If y is not linked with the
    centre, d(y) > D(y, centre), so this is about half of d(x) or more: with
    the differences in order of rarity, one of the first half of x is shared.
    Of y the bound is d(y) less the largest D.
    """
    spread = f"({100 - percent} * greatest(0, n - n_centre) div {100 + percent} + 2)"
    most = f"({100 - percent} * (n + 100 * n div {percent}) div {100 + percent})"
    rows = away.select("family", "node", "n", "n_centre", F.size("tokens").cast("long").alias("d"), F.explode("tokens").alias("token"))
    counts = rows.groupBy("family", "token").agg(F.count("*").alias("rarity")).filter("rarity > 1")
    ranked = rows.join(counts, ["family", "token"], "left")
    ranked = ranked.groupBy("family", "node", "n", "n_centre", "d").agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("rarity", F.lit(1)).alias("rarity"), "token"))).alias("tokens")
    )
    ranked = ranked.withColumns(
        {
            "far": F.expr(f"d > {100 - percent} * (n + n_centre) div {100 + percent}"),
            "half": F.expr(f"d - greatest(1, ceil((d - {spread}) / 2)) + 1"),
            "long": F.expr(f"d - greatest(1, d - {most}) + 1"),
        }
    )
    ranked = pin(ranked)

    def index(which: str, length: str, side: str) -> DataFrame:
        entry = F.explode(F.slice("tokens", F.lit(1), F.col(length).cast("int"))).alias("entry")
        entries = ranked.filter(which).select("family", "node", "n", entry).filter("entry.rarity > 1")
        return entries.select("family", F.col("entry.token").alias("token"), F.col("node").alias(side), F.col("n").alias(f"n_{side}"))

    near_size = f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)"
    split = centres.filter("split").select("family")
    sizes = ranked.groupBy("family").agg(F.count("*").alias("size"))
    most = F.greatest(F.lit(PAIRS), F.col("size") * BLOCK_PAIRS / BLOCK_SETS) * F.col("size")

    def held(entries: DataFrame, name: str) -> DataFrame:
        return entries.groupBy("family", "token").agg(F.count("*").alias(name))

    whole = index("far", "half", "a").join(split, "family", "left_anti")
    loads = held(whole, "held").groupBy("family").agg(F.sum(F.expr("held * (held - 1) div 2")).alias("load"))
    loads = pin(loads.join(sizes, "family").join(centres.select("family", F.lit(True).alias("known")), "family", "left"))
    dense = loads.filter((F.col("load") > PAIRS * F.col("size")) & F.col("known")).select("family")
    far_far = loads.filter((F.col("load") > most) & F.col("known").isNull()).select("family")
    near, long = index("NOT far", "half", "a"), index("far", "long", "b")
    mixed = held(near, "near").join(held(long, "far"), ["family", "token"]).groupBy("family").agg(F.sum(F.expr("near * far")).alias("load"))
    mixed = pin(mixed.join(sizes, "family").filter(F.col("load") > most).select("family"))
    crossed = far_far.select("family", F.lit(True).alias("f"), F.lit(False).alias("n"))
    crossed = crossed.unionByName(mixed.select("family", F.lit(False).alias("f"), F.lit(True).alias("n")))
    crossed = pin(crossed.groupBy("family").agg(F.max("f").alias("with_far"), F.max("n").alias("with_near")))
    whole, split = whole.join(dense.union(far_far), "family", "left_anti"), split.union(dense)
    both_far = whole.join(index("far", "half", "b"), ["family", "token"]).filter(f"a < b AND {near_size}")
    one_far = near.join(mixed, "family", "left_anti").join(long, ["family", "token"]).filter(near_size)
    return both_far.select("a", "b").union(one_far.select("a", "b")).distinct(), split, crossed


def join_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per document ``doc_id``, ``n_shingles`` and ``component_id``, the smallest document id reachable by links."""
    refs = with_ref(docs.select("doc_id", "text"))
    members = _members(refs, words, percent)
    low = members.groupBy(F.col("component").alias("_component")).agg(F.min("doc_id").alias("component_id"))
    joined = members.join(low, F.col("component") == F.col("_component"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One document of each component, the one with the smallest id, with all its columns; rows without id come last."""
    rows = with_ref(docs)
    members = pin(_members(rows, words, percent).select(REF, "doc_id", "component"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", REF)).alias("first")
    several = members.groupBy(F.col("component").alias("_component")).agg(first, F.count("*").alias("docs")).filter("docs > 1")
    # those that go are fewer than those that stay, as a rule, and no text travels if their list is short
    gone = members.join(several, F.col("component") == F.col("_component")).filter(F.col(REF) != F.col(f"first.{REF}"))
    gone = pin(gone.select(F.col(REF).alias("_gone")))
    if few(gone):
        return rows.join(F.broadcast(gone), rows[REF] == F.col("_gone"), "left_anti").select(*docs.columns)
    rows = sifted(rows, REF, gone, "_gone")
    some = rows.filter("_maybe").join(gone.hint("merge"), F.col(REF) == F.col("_gone"), "left_anti")
    return rows.filter("NOT _maybe").select(*docs.columns).unionByName(some.select(*docs.columns))


def oracle(words: int = WORDS, percent: int = PERCENT) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    gram = f"array_to_string(w[i:i + {words - 1}], ' ')"
    return f"""
    WITH RECURSIVE docs AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\\x20\\x09-\\x0D]+') AS w
      FROM documents),
    spread AS (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - {words - 1}) + 1)) AS i FROM docs WHERE len(w) > 0),
    tokens AS (SELECT DISTINCT doc_id, {gram} AS token FROM spread),
    sizes AS (SELECT doc_id, count(*) AS n FROM tokens GROUP BY doc_id),
    common AS (
      SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
      FROM tokens a JOIN tokens b ON a.token = b.token AND a.doc_id < b.doc_id GROUP BY 1, 2),
    links AS (
      SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
      WHERE 100 * c >= {percent} * (x.n + y.n - c)),
    both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
    reach AS (
      SELECT doc_id, doc_id AS other FROM docs
      UNION
      SELECT r.doc_id, l.b FROM reach r JOIN both_ways l ON r.other = l.a)
    SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, c.component_id
    FROM docs d LEFT JOIN sizes s USING (doc_id)
    JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)
    """
