"""SentencePiece encoding and decoding with a batched Viterbi search in numpy.

The model file gives pieces and scores.  A text gets a space in front, spaces
become U+2581, and it is cut where a run of U+2581 begins, as no piece
stands across such a place.  The distinct words of a batch are grouped by
length (long ones padded to a common length); the words of a group advance
together, one code point a step.  Substrings are looked up by hash among the
sorted hashes of the pieces of their length, and a second hash confirms them.
At every code point the best of the pieces that end there is kept with a back
pointer.

* A unigram model ranks paths by the sum of scores; of equal sums the longest
  last piece wins, and a code point that is no piece scores ``UNKNOWN`` below
  the lowest ordinary score.
* A BPE model allows a piece after another only if merging their letters by
  falling score ends with just these two pieces.  Then exactly one piece can
  end at a code point, and the path is the one that merging the whole word
  gives.  Whether two pieces may follow each other is found by taking their
  merges back, the latest first, for all open pairs together: no merge across
  the border may come before the merge just taken back.

Either gives the ids of the SentencePiece library.  A code point that is no
piece becomes the pieces of its bytes.

Decoding is exact: ids of byte pieces are bytes, a U+2581 of the text itself
is encoded by its bytes.  Null and empty texts have no ids, and no ids decode
to the empty text.  Repeated rows are encoded each for itself; extra columns
are ignored.  A text, however long, is encoded whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .shared import share, shared
from .textbytes import MULTIPLIERS, SpanHashes, chunks, mix

#: Path of the vocabulary that the query uses; any SentencePiece model without normalisation will do.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"

#: How far an unknown code point scores below the lowest ordinary piece.
UNKNOWN = 10.0

#: Scores below this mark pieces that are not meant to be used.
UNUSED_SCORE = -1e8

SPACE = 0x2581
_OWN_SPACE = 0x110000  # a U+2581 of the text; above all code points, so no piece has it
_PAD = 0x110001

#: Bytes of text that are cut into words at a time, and whose words are encoded together, each distinct word once.
CUT_BYTES, BATCH_BYTES = 1 << 20, 12 << 20

#: Up to this length words are grouped exactly, then lengths grow by a quarter.
EXACT_LENGTHS = 24


class Vocabulary:
    """Pieces of a model as arrays, small enough to broadcast (some 100 bytes a piece)."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        plain = model.normalizer_spec
        if plain.precompiled_charsmap or plain.remove_extra_whitespaces or not plain.add_dummy_prefix:
            raise ValueError(f"{path} normalises texts, which is not supported")
        processor = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        size = processor.get_piece_size()
        pieces = [processor.id_to_piece(k) for k in range(size)]
        plain_ids = [
            k
            for k in range(size)
            if not (processor.is_byte(k) or processor.is_control(k) or processor.is_unknown(k) or processor.is_unused(k))
        ]
        self.byte_ids = np.full(256, -1, np.int32)
        self.surfaces: list[bytes] = [b""] * size
        self.merges = model.trainer_spec.model_type == 2
        if not self.merges and model.trainer_spec.model_type != 1:
            raise ValueError(f"{path} is neither a unigram nor a BPE model")
        for k in range(size):
            if processor.is_byte(k):
                value = int(pieces[k][1:-1], 16)
                self.byte_ids[value] = k
                self.surfaces[k] = bytes([value])
        for k in plain_ids:
            self.surfaces[k] = pieces[k].replace("▁", " ").encode()
        if (self.byte_ids < 0).any():
            raise ValueError(f"{path} has no byte pieces")
        self.scores = np.array([processor.get_score(k) for k in range(size)], np.float64)
        ordinary = [self.scores[k] for k in plain_ids if self.scores[k] > UNUSED_SCORE]
        self.unknown = min(ordinary, default=0.0) - UNKNOWN
        self.cuts = not any("▁" in pieces[k].lstrip("▁") for k in plain_ids)
        # the last entry is for id -1, a substring that is no piece
        self.single_scores, self.piece_scores = np.append(self.scores, self.unknown), np.append(self.scores, -np.inf)
        self.tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        for n in sorted({len(pieces[k]) for k in plain_ids}):
            ids = np.array([k for k in plain_ids if len(pieces[k]) == n], np.int32)
            points = np.frombuffer("".join(pieces[k] for k in ids).encode("utf-32-le"), np.uint32)
            starts = np.arange(len(ids)) * n
            first, second = (SpanHashes(m).load(points).of(starts, starts + n) for m in MULTIPLIERS)
            order = np.argsort(first)
            heads = np.zeros(1 << 16, bool)  # first 16 bits of the keys: most substrings end here
            heads[(first >> np.uint64(48)).astype(np.int64)] = True
            self.tables[n] = (first[order], second[order], ids[order], heads)
        width = max(self.tables, default=1)
        self.lengths = np.ones(size + 1, np.int64)  # of id -1: an unknown code point
        self.points = np.full((size + 1, width), _PAD, np.uint32)
        for k in plain_ids:
            self.lengths[k] = len(pieces[k])
            self.points[k, : len(pieces[k])] = np.frombuffer(pieces[k].encode("utf-32-le"), np.uint32)
        # pieces that merging their own letters does not give are never the result of merging
        self.stable = np.ones(size + 1, bool)


class Merges:
    """The order in which a BPE model merges."""

    #: Pairs whose answer is remembered; a pair overwrites another one with the same place.
    REMEMBERED = 1 << 20

    def __init__(self, vocabulary: Vocabulary, found) -> None:
        v = vocabulary
        size = len(v.lengths)
        own = np.concatenate([t[2] for t in v.tables.values()]).astype(np.int64)
        order = own[np.argsort(-v.scores[own], kind="stable")]
        #: Rank of the merge that makes a piece; -1 for single letters.
        self.rank = np.full(size, -1, np.int64)
        self.rank[order] = np.arange(len(order))
        self.any_rank = self.rank.copy()
        self.rank[v.lengths == 1] = -1
        self.left, self.right = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for n in np.unique(v.lengths[own]).tolist():
            if n == 1:
                continue
            some = own[v.lengths[own] == n]
            rows = v.points[some, :n]
            ids = found(rows)
            cuts = self._last_cuts(ids, len(some), n)
            v.stable[some] = cuts > 0
            for cut in range(1, n):
                column = np.flatnonzero(cuts == cut)
                self.left[some[column]], self.right[some[column]] = ids[cut][0][column], ids[n - cut][cut][column]
        if (self.left < 0).any() or (self.right < 0).any():
            raise ValueError("a letter of a piece is no piece")
        # hashes of pieces that can be joined, and the sorted hashes of all pieces
        self.raw, self.power, keys = [], [], []
        for m in MULTIPLIERS:
            powers = np.array([pow(m, k, 1 << 64) for k in range(v.points.shape[1] + 1)], np.uint64)
            inside = np.arange(v.points.shape[1]) < v.lengths[:, None]
            raw = np.where(inside, (v.points.astype(np.uint64) + np.uint64(1)) * powers[:-1], 0).sum(axis=1, dtype=np.uint64)
            self.raw.append(raw)
            self.power.append(powers[v.lengths])
            keys.append(mix(raw + v.lengths.astype(np.uint64))[own])
        at = np.argsort(keys[0])
        self.keys, self.checks, self.joined = keys[0][at], keys[1][at], self.any_rank[own[at]]
        self.lengths, self.widest = v.lengths, v.points.shape[1]
        self.heads = np.zeros(1 << 18, bool)
        self.heads[(self.keys >> np.uint64(46)).astype(np.int64)] = True
        self.pairs, self.answers = np.full(self.REMEMBERED, -1, np.int64), np.zeros(self.REMEMBERED, bool)

    def _last_cuts(self, ids: dict[int, np.ndarray], count: int, width: int) -> np.ndarray:
        """Where the last two symbols of pieces meet if merging makes them whole, else 0."""
        ranks = np.full((width + 1, width, count), np.iinfo(np.int64).max)
        for n, found in ids.items():
            if n > 1:
                ranks[n, : width - n + 1] = np.where(found >= 0, self.any_rank[found], ranks[n, : width - n + 1])
        ends = np.tile(np.arange(1, width + 1), (count, 1))
        place, open_, cuts = np.arange(width), np.arange(count), np.zeros(count, np.int64)
        while len(open_):
            own = ends[open_]
            after = np.where((own > 0) & (own < width), np.take_along_axis(own, np.minimum(own, width - 1), axis=1), 0)
            rank = ranks[np.where(after > 0, after - place, 0), place, open_[:, None]]
            best, row = rank.argmin(axis=1), np.arange(len(open_))
            able = rank[row, best] < np.iinfo(np.int64).max
            open_, row, best = open_[able], row[able], best[able]
            cut, end = own[row, best], after[row, best]
            cuts[open_] = np.where((best == 0) & (end == width), cut, 0)
            ends[open_, cut] = 0
            ends[open_, best] = end
        return cuts

    def across(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the piece that two pieces make, or the largest number."""
        none = np.iinfo(np.int64).max
        length = (self.lengths[left] + self.lengths[right]).astype(np.uint64)
        hashes = mix(self.raw[0][left] + self.power[0][left] * self.raw[0][right] + length)
        out = np.full(len(left), none)
        near = np.flatnonzero(self.heads[(hashes >> np.uint64(46)).astype(np.int64)])
        if len(near):
            slot = np.searchsorted(self.keys, hashes[near])
            slot[slot == len(self.keys)] = 0
            same = self.keys[slot] == hashes[near]
            near, slot = near[same], slot[same]
            check = mix(self.raw[1][left[near]] + self.power[1][left[near]] * self.raw[1][right[near]] + length[near])
            same = self.checks[slot] == check
            out[near[same]] = self.joined[slot[same]]
        return out

    def _answer(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        good, open_ = np.zeros(len(left), bool), np.arange(len(left))
        limit = np.full(len(left), np.iinfo(np.int64).max)
        while len(open_):
            early = self.across(left, right) < limit
            whole = ~early & (self.rank[left] < 0) & (self.rank[right] < 0)
            good[open_[whole]] = True
            on = ~early & ~whole
            open_, left, right = open_[on], left[on], right[on]
            # of equal merges the left one comes first
            from_left = self.rank[left] > self.rank[right]
            limit = np.where(from_left, self.rank[left], self.rank[right] + 1)
            left, right = np.where(from_left, self.right[left], left), np.where(from_left, right, self.left[right])
        return good

    def may_follow(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Whether pieces may follow pieces; an unknown code point (-1) merges with nothing."""
        out = np.ones(len(before), bool)
        known = np.flatnonzero((before >= 0) & (piece >= 0))
        left, right = before[known], piece[known]
        pairs = left * len(self.lengths) + right
        place = (mix(pairs.view(np.uint64)) & np.uint64(self.REMEMBERED - 1)).astype(np.int64)
        answer = self.answers[place]
        new = np.flatnonzero(self.pairs[place] != pairs)
        if len(new):
            answer[new] = self._answer(left[new], right[new])
            self.answers[place[new]], self.pairs[place[new]] = answer[new], pairs[new]
        out[known] = answer
        return out


@dataclass
class Words:
    """The distinct words of some texts: code points one word after the other, lengths, hashes; and the texts as words."""

    points: np.ndarray
    lengths: np.ndarray
    first: np.ndarray
    second: np.ndarray
    which: np.ndarray
    bounds: np.ndarray


class Encoder:
    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.hashes = [SpanHashes(m) for m in MULTIPLIERS]
        self.word_hashes = [SpanHashes(m) for m in MULTIPLIERS]
        self.merges = Merges(vocabulary, self.found) if vocabulary.merges else None

    def found(self, words: np.ndarray) -> dict[int, np.ndarray]:
        """By length: the id of the piece at every place (row) of every word (column), or -1."""
        count, width = words.shape
        second = self.hashes[1].load(words.ravel())
        columns = words.T.astype(np.uint64) + np.uint64(1)
        sums, power = np.zeros((width + 1, count), np.uint64), 1
        ids = {1: np.full((width, count), -1, np.int32)}
        for n in range(1, min(width, max(self.vocabulary.tables)) + 1):
            # the hash of a substring from that of the one without its last code point
            sums = sums[:-1] + columns[n - 1 :] * np.uint64(power)
            power = power * MULTIPLIERS[0] % (1 << 64)
            if n not in self.vocabulary.tables:
                continue
            keys, checks, piece_ids, heads = self.vocabulary.tables[n]
            hashes = mix(sums.ravel() + np.uint64(n))
            hit = np.flatnonzero(heads[(hashes >> np.uint64(48)).astype(np.int64)])
            slot = np.searchsorted(keys, hashes[hit])
            slot[slot == len(keys)] = 0
            same = keys[slot] == hashes[hit]
            hit, slot = hit[same], slot[same]
            start = hit % count * width + hit // count
            same = checks[slot] == second.of(start, start + n)
            found = np.full(sums.size, -1, np.int32)
            found[hit[same]] = piece_ids[slot[same]]
            ids[n] = found.reshape(-1, count)
        return ids

    def follow(self, ids: dict[int, np.ndarray], back: np.ndarray, last: np.ndarray) -> None:
        """Fill back pointers and pieces for a BPE model: of the pieces that end at a place, the one that may follow."""
        v = self.vocabulary
        sizes = sorted(ids, reverse=True)
        for end in range(1, len(back)):
            usable = [n for n in sizes if n <= end]
            pieces = np.stack([ids[n][end - n] for n in usable])
            able = (pieces >= 0) & v.stable[pieces]
            able[-1] = True  # a single code point, known or not
            open_ = np.arange(pieces.shape[1])
            while len(open_):
                choice = able[:, open_].argmax(axis=0)  # the longest not refused yet
                piece = pieces[choice, open_].astype(np.int64)
                n = np.array(usable)[choice]
                start = end - n
                good = (start == 0) | self.merges.may_follow(last[start, open_].astype(np.int64), piece)
                good |= n == 1
                back[end, open_[good]], last[end, open_[good]] = n[good], piece[good]
                able[choice, open_] = False
                open_ = open_[~good]

    def group(self, words: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Viterbi over words as rows of code points: word, place and id (-1: unknown) of every piece."""
        v = self.vocabulary
        count, width = words.shape
        ids = self.found(words)
        back = np.zeros((width + 1, count), np.int32)
        last = np.full((width + 1, count), -1, np.int32)
        if v.merges:
            self.follow(ids, back, last)
        else:
            best = np.full((width + 1, count), -np.inf)
            best[0] = 0.0
            for end in range(1, width + 1):
                for n in sorted((n for n in ids if n <= end), reverse=True):
                    piece = ids[n][end - n]
                    total = best[end - n] + (v.single_scores if n == 1 else v.piece_scores)[piece]
                    better = total > best[end]
                    np.copyto(best[end], total, where=better)
                    np.copyto(back[end], n, where=better)
                    np.copyto(last[end], piece, where=better)
        at, open_ = lengths.copy(), np.arange(count)
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(open_):
            place = at[open_]
            step = back[place, open_]
            out.append((open_, place - step, last[place, open_]))
            at[open_] -= step
            open_ = open_[at[open_] > 0]
        word, place, piece = (np.concatenate(x) for x in zip(*out, strict=True))
        order = np.lexsort((place, word))
        return word[order], place[order], piece[order]

    def words(self, points: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, one after the other, and where each word's ids start."""
        groups = np.where(
            lengths <= EXACT_LENGTHS,
            lengths,
            np.ceil(EXACT_LENGTHS * 1.25 ** np.ceil(np.log(np.maximum(lengths, 1) / EXACT_LENGTHS) / np.log(1.25)) + 1),
        ).astype(np.int64)
        owners, places, pieces = [], [], []
        for width in np.unique(groups).tolist():
            own = np.flatnonzero(groups == width)
            step = max(1, (1 << 19) // width)  # bounds the rows that advance together
            for k in range(0, len(own), step):
                some = own[k : k + step]
                at = starts[some, None] + np.arange(width)
                inside = np.arange(width) < lengths[some, None]
                rows = np.where(inside, points[np.minimum(at, len(points) - 1)], _PAD)
                word, place, piece = self.group(rows, lengths[some])
                owners.append(some[word])
                places.append(place)
                pieces.append(piece)
        word, place, piece = (np.concatenate(x) for x in (owners, places, pieces))
        order = np.argsort(word, kind="stable")
        word, place, piece = word[order], place[order], piece[order]
        # unknown code points become bytes
        unknown = np.flatnonzero(piece < 0)
        codes = points[starts[word[unknown]] + place[unknown]]
        codes = np.where(codes == _OWN_SPACE, SPACE, codes)
        size = 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)
        counts = np.ones(len(piece), np.int64)
        counts[unknown] = size
        heads = np.cumsum(counts) - counts
        ids = np.repeat(piece, counts)
        spelled = "".join(map(chr, codes.tolist())).encode()
        slots = np.repeat(heads[unknown], size) + np.arange(len(spelled)) - np.repeat(np.cumsum(size) - size, size)
        ids[slots] = self.vocabulary.byte_ids[np.frombuffer(spelled, np.uint8)]
        total = np.bincount(np.repeat(word, counts), minlength=len(starts))
        return ids, np.concatenate(([0], np.cumsum(total)))

    def cut(self, data: np.ndarray, offsets: np.ndarray) -> Words:
        """The words of texts."""
        plain = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        marks = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[offsets]
        filled = np.diff(marks) > 0
        # a space in front of every text that is not empty
        shift = np.concatenate(([0], np.cumsum(filled)))
        points = np.empty(len(plain) + int(filled.sum()), np.uint32)
        front = (marks[:-1] + shift[:-1])[filled]
        is_text = np.ones(len(points), bool)
        is_text[front] = False
        points[is_text] = np.where(plain == SPACE, _OWN_SPACE, np.where(plain == 0x20, SPACE, plain))
        points[front] = SPACE
        opens = np.zeros(len(points), bool)
        if self.vocabulary.cuts:
            gap = points == SPACE
            opens[1:] = gap[1:] & ~gap[:-1]
        opens[front] = True
        starts = np.flatnonzero(opens)
        lengths = np.diff(np.append(starts, len(points)))
        first, second = (h.load(points).of(starts, starts + lengths) for h in self.word_hashes)
        distinct, which = _distinct(first, second)
        ends = np.cumsum(lengths[distinct])
        own = points[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts[distinct] - ends + lengths[distinct], lengths[distinct])]
        return Words(own, lengths[distinct], first[distinct], second[distinct], which, np.searchsorted(starts, marks + shift))

    def encode(self, many: list[Words]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each of several batches the ids of its texts, one after the other, and where each text's begin."""
        lengths = np.concatenate([w.lengths for w in many])
        if not len(lengths):
            yield from ((np.zeros(0, np.int32), np.zeros(len(w.bounds), np.int64)) for w in many)
            return
        points = np.concatenate([w.points for w in many])
        starts = np.cumsum(lengths) - lengths
        distinct, which = _distinct(np.concatenate([w.first for w in many]), np.concatenate([w.second for w in many]))
        ids, bounds = self.words(points, starts[distinct], lengths[distinct])
        before = 0
        for w in many:
            word = which[before : before + len(w.lengths)][w.which]
            before += len(w.lengths)
            counts = np.diff(bounds)[word]
            ends = np.cumsum(counts)
            total = int(ends[-1]) if len(ends) else 0
            own = ids[np.arange(total) + np.repeat(bounds[word] - ends + counts, counts)]
            yield own, np.concatenate(([0], ends))[w.bounds]

    def texts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts, one after the other, and where each text's begin."""
        return next(self.encode([self.cut(data, offsets)]))


def _distinct(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One place of every distinct pair, and for every pair the number of its place."""
    order = np.lexsort((second, first))
    new = np.ones(len(order), bool)
    new[1:] = (first[order][1:] != first[order][:-1]) | (second[order][1:] != second[order][:-1])
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    return order[new], which


class Decoder:
    def __init__(self, vocabulary: Vocabulary) -> None:
        self.sizes = np.array([len(s) for s in vocabulary.surfaces], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(vocabulary.surfaces), np.uint8)

    def texts(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """Texts of ids; the space in front of the first piece goes."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        data = self.bytes[np.arange(total) + np.repeat(self.starts[ids] - ends + sizes, sizes)].tobytes()
        edges = np.concatenate(([0], ends))[bounds].tolist()
        return [
            data[a + data[a : min(a + 1, b)].startswith(b" ") : b].decode(errors="replace")
            for a, b in zip(edges, edges[1:], strict=False)
        ]


def _encoded(encoder: Encoder, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Document ids, piece ids one text after the other, and where each text's begin."""
    for batch in batches:
        held: list[tuple[int, int, Words]] = []
        size = 0
        for row, end, data, offsets in chunks(batch.column("text"), CUT_BYTES):
            held.append((row, end, encoder.cut(data, offsets)))
            size += len(data)
            if size >= BATCH_BYTES or end == batch.num_rows:
                for (first, last, _), (ids, bounds) in zip(held, encoder.encode([h[2] for h in held]), strict=True):
                    yield batch.column("doc_id").slice(first, last - first), ids, bounds
                held, size = [], 0


def _lists(ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids, pa.int32()))


def encode(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """``doc_id`` and ``ids`` of every document (``doc_id``, ``text``)."""
    vocabulary = share(docs.sparkSession, Vocabulary(model))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for docs_, ids, bounds in _encoded(Encoder(shared(vocabulary)), batches):
            yield pa.RecordBatch.from_arrays([docs_, _lists(ids, bounds)], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """``doc_id``, ``ids`` and the ``text`` that the ids stand for; null ids are none."""
    vocabulary = share(encoded.sparkSession, Vocabulary(model))
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(shared(vocabulary))
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                lists = part.column("ids")
                counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                texts = decoder.texts(lists.flatten().to_numpy(), np.concatenate(([0], np.cumsum(counts))))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), lists, pa.array(texts, pa.string())], names=["doc_id", "ids", "text"]
                )

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids array<int>, text string")


def round_trip(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """Per document its ids, their number, and length and digest of the text decoded from them.

    A task encodes and decodes at once, so that the decoded texts need not leave it.
    """
    vocabulary = share(docs.sparkSession, Vocabulary(model))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared(vocabulary)
        decoder = Decoder(own)
        for docs_, ids, bounds in _encoded(Encoder(own), batches):
            texts = decoder.texts(ids, bounds)
            yield pa.RecordBatch.from_arrays(
                [
                    docs_,
                    pa.array(np.diff(bounds).astype(np.int64)),
                    _lists(ids, bounds),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids", "n_chars", "decoded_sha256"],
            )

    schema = f"doc_id {kind}, n_tokens long, ids array<int>, n_chars long, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
