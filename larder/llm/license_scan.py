"""License scan: license templates as token automata over whole texts.

A template is wording with markup.  ``<<beginOptional>>..<<endOptional>>``
encloses wording that may be left out, ``<<var;name="x";words="a-b">>`` stands
for any ``a`` to ``b`` words and ``<<var;name="x";match="p|q r">>`` for one of
the given wordings.  Both may be nested in optional regions.  All other words
are mandatory.  Texts and templates are compared by their words (A-Z
lower-cased, see ``WORD_PATTERN``), so punctuation and line breaks do not
matter.  A template is accepted where a run of words of the text is a word of
its automaton.

Null and empty texts have no words, no labels and score 0.  Repeated rows are
scanned each for itself.  Other columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .textbytes import MULTIPLIERS, WORD_PATTERN, SpanHashes, chunks, lower_table, word_hash, word_spans, word_table

#: The phrases that are always looked for, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Public wordings of licenses and notices by the label that a match adds.
TEMPLATES = {
    "mit-notice": """<<var;name="verb";match="released|licensed|distributed|available|provided">> under <<beginOptional>>the
        <<beginOptional>>terms of the<<endOptional>><<endOptional>> MIT License""",
    "apache-2.0-notice": """Licensed under the Apache License <<beginOptional>>Version<<endOptional>> 2.0""",
    "gpl-3.0-notice": """licensed under the <<beginOptional>>terms of the<<endOptional>> <<beginOptional>>GNU<<endOptional>> General
        Public License <<beginOptional>>as published by the Free Software Foundation<<endOptional>>
        <<beginOptional>>either<<endOptional>> <<var;name="version";match="version|v">> 3""",
    "cc-by-nc-4.0-notice": """Licensed under <<var;name="article";words="0-1">> <<beginOptional>>Creative Commons<<endOptional>>
        <<var;name="short";match="CC BY-NC|Attribution-NonCommercial">> 4.0""",
    "apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this
        <<var;name="what";words="1-3">> except in compliance with the License. You may obtain a copy of the License at
        <<var;name="address";words="3-10">> Unless required by applicable law or agreed to in writing, software distributed
        under the License is distributed on an "AS IS" BASIS""",
    "mit-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software
        <<beginOptional>>and associated documentation files (the "Software")<<endOptional>>, to deal in the Software without
        restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,
        and/or sell copies of the Software""",
    "isc-text": """Permission to use, copy, modify, and <<var;name="join";match="and or|or">>
        distribute this software for any purpose with or without fee is hereby granted""",
    "bsd-text": """Redistribution and use in source and binary forms, with or without modification, are permitted
        <<beginOptional>>(subject to the limitations in the disclaimer below)<<endOptional>> provided that the following
        conditions are met""",
    "gpl-header": """This <<var;name="work";words="1-3">> is free software<<beginOptional>>:<<endOptional>> you can redistribute it
        and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation""",
}

_MARK = re.compile(r"<<(beginOptional|endOptional|var;[^>]*)>>")


def words_of(text: str) -> list[str]:
    """The words of a text as the scan sees them."""
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return re.findall(WORD_PATTERN, lower)


def parse(template: str) -> list:
    """A template as a list of words, ``("any", low, high)``, ``("one", wordings)`` and ``("opt", parts)``."""
    stack: list[list] = [[]]
    at = 0
    for mark in _MARK.finditer(template):
        stack[-1] += words_of(template[at : mark.start()])
        at = mark.end()
        if mark[1] == "beginOptional":
            stack.append([])
        elif mark[1] == "endOptional":
            if len(stack) == 1:
                raise ValueError("endOptional without beginOptional")
            parts = stack.pop()
            if parts:
                stack[-1].append(("opt", parts))
        else:
            given = dict(re.findall(r'(\w+)="([^"]*)"', mark[1]))
            if "words" in given:
                low, high = map(int, given["words"].split("-"))
                stack[-1].append(("any", low, high))
            else:
                stack[-1].append(("one", [words_of(x) for x in given["match"].split("|")]))
    if len(stack) > 1:
        raise ValueError("beginOptional without endOptional")
    return stack[0] + words_of(template[at:])


def pattern(parts: list) -> str:
    """The same template as a regular expression over words that are each followed by one space."""
    out = ""
    for part in parts:
        if isinstance(part, str):
            out += re.escape(part) + " "
        elif part[0] == "any":
            out += f"(?:[^ ]+ ){{{part[1]},{part[2]}}}"
        elif part[0] == "one":
            out += "(?:" + "|".join("".join(re.escape(w) + " " for w in x) for x in part[1]) + ")"
        else:
            out += "(?:" + pattern(part[1]) + ")?"
    return out


class Automaton:
    """A position automaton: position sets are the bits of an integer, one step per word of the text."""

    def __init__(self, template: str) -> None:
        self.symbols: list[str | None] = []  # None: any word
        self.follow: list[int] = []
        self.first, self.last, empty, self.most = self._sequence(parse(template))
        if empty:
            raise ValueError("a template needs mandatory wording")
        self.by_word: dict[str, int] = {}
        self.wild = 0
        for k, symbol in enumerate(self.symbols):
            if symbol is None:
                self.wild |= 1 << k
            else:
                self.by_word[symbol] = self.by_word.get(symbol, 0) | 1 << k
        self.anchor, self.before = self._anchor(parse(template))

    def _symbol(self, symbol: str | None) -> tuple[int, int, bool, int]:
        self.symbols.append(symbol)
        self.follow.append(0)
        bit = 1 << len(self.symbols) - 1
        return bit, bit, False, 1

    def _sequence(self, parts: list) -> tuple[int, int, bool, int]:
        """First and last positions, whether no word is enough, and the most words."""
        first = last = most = 0
        empty = True
        for part in parts:
            if isinstance(part, str):
                f, l, e, m = self._symbol(part)
            elif part[0] == "opt":
                f, l, _, m = self._sequence(part[1])
                e = True
            elif part[0] == "one":
                f = l = m = 0
                e = False
                for x in part[1]:
                    f2, l2, _, m2 = self._sequence(x)
                    f, l, m = f | f2, l | l2, max(m, m2)
            else:
                inner: list = []
                for _ in range(part[2] - part[1]):
                    inner = [("opt", [("any", 1, 1), *inner])]
                if part[1:] == (1, 1):
                    f, l, e, m = self._symbol(None)
                else:
                    f, l, e, m = self._sequence([("any", 1, 1)] * part[1] + inner)
            for k in _bits(last):
                self.follow[k] |= f
            first = first | f if empty else first
            last = l | last if e else l
            empty, most = empty and e, most + m
        return first, last, empty, most

    @staticmethod
    def _most(parts: list) -> int:
        sizes = {"any": lambda p: p[2], "one": lambda p: max(map(len, p[1])), "opt": lambda p: Automaton._most(p[1])}
        return sum(1 if isinstance(p, str) else sizes[p[0]](p) for p in parts)

    def _anchor(self, parts: list) -> tuple[list[str], int]:
        """Three (or fewer) mandatory words in a row, of most characters, and the most words before them."""
        runs = [(k, parts[k : k + n]) for n in (3, 2, 1) for k in range(len(parts) - n + 1)]
        solid = [(k, run) for k, run in runs if all(isinstance(x, str) for x in run)]
        at, words = max(solid, key=lambda x: (len(x[1]), sum(map(len, x[1]))))
        return words, self._most(parts[:at])

    def found(self, words: list[str], begin: int, end: int) -> bool:
        """Whether a match starts at a word from ``begin`` to before ``end``."""
        active = 0
        for k in range(begin, len(words)):
            reach = self.first if k < end else 0
            for bit in _bits(active):
                reach |= self.follow[bit]
            active = reach & (self.by_word.get(words[k], 0) | self.wild)
            if active & self.last:
                return True
            if not active and k + 1 >= end:
                return False
        return False


def _bits(value: int) -> Iterator[int]:
    while value:
        low = value & -value
        yield low.bit_length() - 1
        value ^= low


class Scanner:
    """All phrases and templates, looked for in one pass over the words of a batch."""

    def __init__(self, phrases: dict[str, str], templates: dict[str, str]) -> None:
        self.phrases = [(words_of(phrase), label) for phrase, label in phrases.items()]
        self.automata = {label: Automaton(text) for label, text in templates.items()}
        self.hash = SpanHashes(MULTIPLIERS[0])
        self.lower, self.table = lower_table(), word_table()
        vocabulary = {w for words, _ in self.phrases for w in words}
        vocabulary |= {w for a in self.automata.values() for w in a.anchor}
        self.codes = {w: word_hash(w) for w in vocabulary}

    def places(self, hashes: np.ndarray, bounds: np.ndarray, words: list[str]) -> np.ndarray:
        """Where the words stand one after the other in one text."""
        n = max(len(hashes) - len(words) + 1, 0)
        hit = np.ones(n, bool)
        for k, word in enumerate(words):
            hit &= hashes[k : k + n] == np.uint64(self.codes[word])
        at = np.flatnonzero(hit)
        return at[at + len(words) <= bounds[np.searchsorted(bounds, at, side="right")]] if len(at) else at

    def scan(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple]:
        """Per text: number of words, places of phrases, first, last, base labels, labels, score."""
        lower = self.lower[data]
        starts, ends, bounds = word_spans(lower, offsets, self.table)
        hashes = self.hash.load(lower).of(starts, ends)
        base: dict[int, list[tuple[int, str]]] = {}
        more: dict[int, set[str]] = {}
        for words, label in self.phrases:
            at = self.places(hashes, bounds, words)
            for text, place in zip((np.searchsorted(bounds, at, side="right") - 1).tolist(), at.tolist(), strict=True):
                base.setdefault(text, []).append((place - int(bounds[text]), label))
        for label, automaton in self.automata.items():
            at = self.places(hashes, bounds, automaton.anchor)
            reach = -1
            for text, place in zip((np.searchsorted(bounds, at, side="right") - 1).tolist(), at.tolist(), strict=True):
                if label in more.get(text, ()):
                    continue
                begin = max(int(bounds[text]), place - automaton.before, reach)
                stop = min(int(bounds[text + 1]), place + automaton.most)
                own = [lower[s:e].tobytes().decode() for s, e in zip(starts[begin:stop], ends[begin:stop], strict=True)]
                reach = place + 1
                if automaton.found(own, 0, place + 1 - begin):
                    more.setdefault(text, set()).add(label)
        for text, n in enumerate(np.diff(bounds).tolist()):
            found, extra = base.get(text, ()), more.get(text, set())
            labels = {label for _, label in found}
            yield (
                n,
                len(found),
                min(found)[0] if found else None,
                max(found)[0] if found else None,
                ",".join(sorted(labels)),
                ",".join(sorted(labels | extra)),
                1.0 if extra else 0.5 if labels else 0.0,
            )


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
)
_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64())]
    + [("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())]
)


def scan_licenses(
    docs: DataFrame, phrases: dict[str, str] | None = None, templates: dict[str, str] | None = None
) -> DataFrame:
    """One row per document (``doc_id``, ``text``): words, places of phrases, labels and a score.

    The score is 1 if a template is accepted, else 0.5 if a phrase occurs, else 0.
    """
    given = (PHRASES if phrases is None else phrases, TEMPLATES if templates is None else templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(*given)
        for batch in batches:
            rows: list[tuple] = []
            for _, _, data, offsets in chunks(batch.column("text")):
                rows += scanner.scan(data, offsets)
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
            arrays = [batch.column("doc_id").cast(pa.int64())]
            arrays += [pa.array(c, f.type) for c, f in zip(columns, list(_ARROW)[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=_ARROW)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def oracle(phrases: dict[str, str] | None = None, templates: dict[str, str] | None = None) -> str:
    """The same result in SQL, with every template as a regular expression."""
    phrases = PHRASES if phrases is None else phrases
    templates = TEMPLATES if templates is None else templates
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    places = []
    for phrase, label in phrases.items():
        same = " AND ".join(f"w[i + {k}] = '{word}'" for k, word in enumerate(words_of(phrase)))
        places.append(f"SELECT copy, i - 1 AS place, '{label}' AS label FROM spread WHERE {same}")
    accepted = " UNION ALL ".join(
        f"SELECT copy, '{label}' AS label FROM words WHERE regexp_matches(line, ' {pattern(parse(text))}')"
        for label, text in templates.items()
    )
    return f"""
    WITH words AS (
      SELECT copy, doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS line FROM (
        SELECT row_number() OVER () AS copy, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '{WORD_PATTERN}') AS w
        FROM documents)),
    spread AS (SELECT copy, w, unnest(range(1, len(w) + 1)) AS i FROM words WHERE contains(line, ' license ')),
    places AS ({" UNION ALL ".join(places)}),
    base AS (
      SELECT copy, count(*) AS n, min(place) AS first_word, max(place) AS last_word,
             string_agg(DISTINCT label, ',' ORDER BY label) AS labels
      FROM places GROUP BY copy),
    accepted AS ({accepted}),
    named AS (
      SELECT copy, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
      FROM (SELECT copy, label FROM places UNION SELECT copy, label FROM accepted) GROUP BY copy)
    SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(b.n, 0) AS BIGINT) AS n_base,
           CAST(b.first_word AS BIGINT) AS first_word, CAST(b.last_word AS BIGINT) AS last_word,
           coalesce(b.labels, '') AS base_labels, coalesce(n.labels, '') AS labels,
           CASE WHEN d.copy IN (SELECT copy FROM accepted) THEN 1.0 WHEN b.n > 0 THEN 0.5 ELSE 0.0 END::DOUBLE AS score
    FROM words d LEFT JOIN base b USING (copy) LEFT JOIN named n USING (copy)
    """
