"""Token counts of texts by byte-pair merging with a heap and a linked list.

A text is normalised and cut into words as its vocabulary file says; a word is
a linked list of symbols, its bytes, the last one marked as the end.  A heap
holds the adjacent pairs that may merge, by rank and then by place.  The pair
of lowest rank is popped and merged, and the pairs with its neighbours are
pushed, until none is left.  The tokens of a word are its symbols less its
merges; no token is built or named.

A word is cut first where two symbols never stand side by side in any entry of
the vocabulary, as no merge can reach across.  So a very long word takes memory
for its longest part only.  A text is cut into words a megabyte at a time, at
white space; the number of a word's tokens is kept while a task meets it again.

Special strings in a text are one token each, and what stands between them is a
text of its own, as the library of the file has it by default.  Words of texts
whose characters all exist since Unicode 3.2 are found by a pattern; as later
versions of Unicode differ in what is a letter, other texts are normalised and
cut by the library of the file, so that both agree on every character.

A null or empty text has no bytes and no tokens.  Repeated rows are counted
each for itself, rows without id are kept, extra columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from .shared import share, shared

#: Path of the vocabulary that the query uses, and the tokens beyond which a text is too long.
MODEL, LIMIT = "/opt/tokenizers/word_bpe_49k.json", 2048

#: Characters that are cut into words at a time, and words whose number of tokens a task keeps.
PIECE_CHARS, KEPT_WORDS = 1 << 20, 1 << 19

#: Suffix of the last symbol of a word in the file.
WORD_END = "</w>"

#: Symbols are numbered by byte; those at the end of a word come after the others.
_BYTES = 256


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte in files of this kind: itself if it prints, else the next from U+0100."""
    printing = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(_BYTES) if b not in set(printing)]
    return {chr(b): b for b in printing} | {chr(0x100 + k): b for k, b in enumerate(others)}


@dataclass
class Merges:
    """What a vocabulary file says about merging, small enough to broadcast (some 100 bytes a merge).

    Symbols are numbers: bytes, bytes at the end of a word, then the result of each merge.
    """

    pattern: str
    specials: list[str]
    ranks: dict[tuple[int, int], tuple[int, int]]  # pair: rank and symbol
    adjacent: set[tuple[int, int]]  # symbols of one byte that stand side by side in some entry
    source: str = field(repr=False)  # the file, for texts with recent characters

    @classmethod
    def read(cls, path: str) -> Merges:
        with open(path, encoding="utf-8") as file:
            source = file.read()
        given = json.loads(source)
        steps = [step["type"] for step in given["normalizer"]["normalizers"]]
        split, level = given["pre_tokenizer"]["pretokenizers"]
        model = given["model"]
        known = steps == ["NFC", "Replace", "Lowercase"] and split["behavior"] == "Removed" and split["invert"]
        known &= model["type"] == "BPE" and model["end_of_word_suffix"] == WORD_END and not level["add_prefix_space"]
        if not known or model["dropout"] or model["ignore_merges"]:
            raise ValueError("a byte-level BPE file with word ends, lower case and a splitting pattern is needed")
        of_character = byte_characters()
        number = {c: b for c, b in of_character.items()} | {c + WORD_END: b + _BYTES for c, b in of_character.items()}
        ranks = {}
        for rank, (a, b) in enumerate(model["merges"]):
            made = number.setdefault(a + b, len(number))
            ranks.setdefault((number[a], number[b]), (rank, made))
        adjacent = set()
        for entry in model["vocab"]:
            plain = entry.removesuffix(WORD_END)
            symbols = [of_character[c] for c in plain]
            if plain != entry and symbols:
                symbols[-1] += _BYTES
            adjacent.update(zip(symbols, symbols[1:], strict=False))
        specials = [token["content"] for token in given["added_tokens"] if token["special"] and not token["normalized"]]
        if len(specials) < len(given["added_tokens"]):
            raise ValueError("added tokens other than special ones are not supported")
        return cls(split["pattern"]["Regex"], specials, ranks, adjacent, source)


def merges_of(symbols: list[int], ranks: dict[tuple[int, int], tuple[int, int]]) -> int:
    """How many merges a run of symbols allows, always the pair of lowest rank first, ties to the left."""
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(found[0], i) for i in range(n - 1) if (found := ranks.get((symbols[i], symbols[i + 1])))]
    heapq.heapify(heap)
    symbols, merged = list(symbols), 0
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i]
        if symbols[i] < 0 or j >= n:
            continue
        found = ranks.get((symbols[i], symbols[j]))
        if found is None or found[0] != rank:  # one of the two has merged since
            continue
        merged += 1
        symbols[i], symbols[j] = found[1], -1
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if right := ranks.get((symbols[i], symbols[k])):
                heapq.heappush(heap, (right[0], i))
        h = before[i]
        if h >= 0 and (left := ranks.get((symbols[h], symbols[i]))):
            heapq.heappush(heap, (left[0], h))
    return merged


class WordCounts(dict):
    """Tokens of words, counted when a word is met first."""

    def __init__(self, merges: Merges) -> None:
        super().__init__()
        self.ranks, self.adjacent = merges.ranks, merges.adjacent

    def __missing__(self, word: str) -> int:
        symbols = list(word.encode())
        symbols[-1] += _BYTES
        adjacent, ranks, total, begin = self.adjacent, self.ranks, len(symbols), 0
        for end in range(1, len(symbols) + 1):
            if end == len(symbols) or (symbols[end - 1], symbols[end]) not in adjacent:
                if end - begin > 1:
                    total -= merges_of(symbols[begin:end], ranks)
                begin = end
        if len(self) >= KEPT_WORDS:
            self.clear()
        self[word] = total
        return total


class Settled(dict):
    """Whether a character existed in Unicode 3.2."""

    def __missing__(self, character: str) -> bool:
        self[character] = known = unicodedata.ucd_3_2_0.category(character) != "Cn"
        return known


class Counter:
    """Counts tokens of texts, in a task."""

    def __init__(self, merges: Merges) -> None:
        self.merges, self.words, self.settled, self.library = merges, WordCounts(merges), Settled(), None
        self.word, self.space = regex.compile(merges.pattern), regex.compile(r"\s")
        self.special = regex.compile("|".join(map(regex.escape, merges.specials))) if merges.specials else None

    def pieces(self, text: str) -> Iterator[str]:
        """A text cut before white space, so that no word, and no character made of several, is cut."""
        begin = 0
        while len(text) - begin > PIECE_CHARS:
            gap = self.space.search(text, begin + PIECE_CHARS)
            if gap is None:
                break
            yield text[begin : gap.start()]
            begin = gap.start()
        yield text[begin:] if begin else text

    def words_of(self, text: str) -> list[str]:
        if text.isascii() or all(map(self.settled.__getitem__, set(text))):
            if not text.isascii():
                # one character at a time: a capital sigma has the same small letter everywhere
                text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
            return self.word.findall(text.lower())
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(self.merges.source)
        of_character = byte_characters()
        normal = self.library.normalizer.normalize_str(text)
        found = self.library.pre_tokenizer.pre_tokenize_str(normal)
        return [bytes(of_character[c] for c in word).decode() for word, _ in found]

    def count(self, text: str) -> int:
        plain = [text]
        if self.special is not None:
            plain = self.special.split(text)
        total, words = len(plain) - 1, self.words
        for part in plain:
            for piece in self.pieces(part):
                total += sum(map(words.__getitem__, self.words_of(piece)))
        return total


def count_tokens(docs: DataFrame, model: str = MODEL, limit: int = LIMIT) -> DataFrame:
    """Per document ``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit``: whether it has more than ``limit`` tokens."""
    block = share(docs.sparkSession, Merges.read(model))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared(block))
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            counts = pa.array([counter.count(text.as_py()) for text in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pc.binary_length(texts).cast(pa.int64()), counts, pc.greater(counts, limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
