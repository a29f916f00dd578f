"""Conversation repair, token counts and vector codes against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from larder.llm import token_counts, turn_repair, vector_codes

# 11 conversation repair

TURNS = "conv_id long, turn long, role string, text string"


def cheapest(kinds):
    """The least (cost, edits) by dynamic programming over what came last."""
    best = {turn_repair.START: (0, "")}

    def put(into, state, way):
        into[state] = min(way, into.get(state, (1 << 60, "")))

    def inserted(ways):
        ways = dict(ways)
        for _ in range(3):
            for state, (cost, edits) in list(ways.items()):
                put(ways, turn_repair.ASSISTANT if state == turn_repair.USER else turn_repair.USER, (cost + 5, edits + "I"))
        return ways

    for kind in kinds:
        after = {}
        initial, fault = "sua-"[kind % 4], kind // 4
        for state, (cost, edits) in inserted(best).items():
            put(after, state, (cost + 2, edits + "D"))
            if fault == 1:
                continue
            more = cost + (5 if fault == 2 else 0)
            wanted = "a" if state == turn_repair.USER else "u"
            next_ = turn_repair.ASSISTANT if wanted == "a" else turn_repair.USER
            if initial == "s" and state == turn_repair.START:
                put(after, turn_repair.SYSTEM, (more, edits + "K"))
            if initial == wanted:
                put(after, next_, (more, edits + "K"))
            put(after, next_, (more + 1, edits + "R"))
        best = after
    return min(way for state, way in inserted(best).items() if state in (turn_repair.START, turn_repair.ASSISTANT))


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 8, 30, 47, 48, 49, 97, 200, 600])
def test_repair_is_the_cheapest_and_least(n):
    dice = random.Random(n)
    for _ in range(60 if n < 50 else 6):
        kinds = bytes(dice.choices(range(12), weights=[2, 6, 6, 1, 1, 1, 1, 1, 1, 1, 1, 1], k=n))
        cost, audit, _ = turn_repair.repair(kinds)
        assert (cost, audit) == cheapest(kinds)


def test_examples_of_repairs(spark):
    said = [
        (1, 0, "user", "Hi."), (1, 1, "assistant", "Hello!"),
        (2, 0, "user", "Hi."), (2, 1, "user", "Still here?"),
        (3, 0, "system", "Be kind."), (3, 1, "assistant", "Yes."), (3, 5, "user", "Thanks."),
        (4, 0, "user", "  "), (4, 1, None, None),
        (5, 0, "user", "cut"),
        (6, 0, "user", "A:b."), (6, 0, "user", "A:b."), (6, 1, "a:b", "c."),
        (None, 1, "assistant", "No id."), (None, 0, "user", "No id?"),
    ]
    rows = spark.createDataFrame(said, TURNS)
    found = {r["conv_id"]: r for r in turn_repair.repair_conversations(rows).collect()}
    assert {k: (r["cost"], r["audit"]) for k, r in found.items()} == {
        1: (0, "KK"), 2: (1, "KR"), 3: (2, "KRR"), 4: (4, "DD"), 5: (2, "D"), 6: (2, "KDK"), None: (0, "KK")
    }
    assert (found[3]["gaps"], found[3]["illegal"], found[4]["blank"], found[5]["truncated"], found[6]["duplicate"]) == (3, 1, 2, 1, 1)
    turns = {}
    for r in turn_repair.repaired_turns(rows).orderBy("conv_id", "step").collect():
        turns.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert turns[6] == [("user", "A:b."), ("a:b", "c.")] and turns[2][1] == ("assistant", "Still here?")
    assert 4 not in turns and 5 not in turns


def test_long_conversations_are_repaired_in_segments(spark):
    dice = random.Random(5)
    said = []
    for conversation in (1, 2, None):
        for k in range(300):
            text = dice.choice(["Yes.", "No", " ", f"Turn {k}.", f"turn {k}"])
            said.append((conversation, dice.choice([None, k, k, k]), dice.choice(["user", "assistant", "system", "tool", ""]), text))
    said += [(3, 0, "user", "Short."), (3, 1, "assistant", "Yes.")]
    rows = spark.createDataFrame(said, TURNS).repartition(5)
    short, long = turn_repair.repair_conversations(rows), turn_repair.repair_conversations(rows, whole=4, segment=7)
    assert sorted(map(str, short.collect())) == sorted(map(str, long.collect()))

    def turns(whole, segment):
        made = turn_repair.repaired_turns(rows, whole, segment)
        place = F.row_number().over(Window.partitionBy("conv_id").orderBy("step"))
        return sorted(map(str, made.withColumn("step", place).collect()))

    assert turns(2048, 1024) == turns(4, 7)


def test_damage_by_hash(spark):
    from zlib import crc32

    said = [(k, t, "assistant", f"One. Two! {k}") for k in range(40) for t in range(3)]
    rows = turn_repair.damaged(spark.createDataFrame(said, TURNS))
    found = sorted((r["conv_id"], r["turn"], r["role"], r["text"]) for r in rows.collect())
    want = []
    for conversation, turn, role, text in said:
        luck = crc32(f"{conversation}:{turn}".encode()) % 20
        text = {1: "", 2: text.replace(".", "").replace("!", "")}.get(luck, text)
        want += [(conversation, turn, "user" if luck == 4 else role, text)] * {0: 0, 3: 2}.get(luck, 1)
    assert found == sorted(want)
    assert turn_repair.repair_damaged(spark.createDataFrame([], TURNS)).count() == 0


# 12 token counts


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(token_counts.MODEL)


def library_count(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


ODD_TEXTS = [
    None, "", " ", "ΑΣ ΣΑΣ", "İI", "a<|endoftext|>b<|startoftext|>", "<|endoftext|><|endoftext|>", "<|EndOfText|>", "é ́x",
    "don't I'LL we'Ve 's 'S''s", "１２３ ½ ²", "🙂🙂👩‍👩‍👧 ok", "a" * 5000, "ab" * 3000, "Å", "\x1c\x1d a\x85b\u200b\u3000c",
    "日本語テキスト", "Ᲊx Ꟛ", "</w> x</w>", "\x00\x01", "ſS ﬁ", "word " * 3000,
]


def test_counts_equal_the_library(spark, library, monkeypatch):
    dice = random.Random(1)
    common = [chr(c) for c in range(0x600)] + list("abcdefgh \n\t'<|>") * 60
    any_ = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ODD_TEXTS + ["".join(dice.choices(common, k=dice.randint(1, 80))) for _ in range(800)]
    texts += ["".join(dice.choices(any_, k=20)) for _ in range(40)]
    rows = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)] + [(None, "two words", "y")] * 2, "doc_id long, text string, n_tokens string")
    found = token_counts.count_tokens(rows).collect()
    assert len(found) == len(texts) + 2
    for r in found:
        text = texts[r["doc_id"]] if r["doc_id"] is not None else "two words"
        want = library_count(library, text)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len((text or "").encode()), want, want > 2048), text
    monkeypatch.setattr(token_counts, "PIECE_CHARS", 5)
    counter = token_counts.Counter(token_counts.Merges.read(token_counts.MODEL))
    assert all(counter.count(t or "") == library_count(library, t) for t in texts)


def test_counts_of_the_table(spark, library):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {r["doc_id"]: library_count(library, r["text"]) for r in rows.collect()}
    assert {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(rows).collect()} == want
    assert token_counts.count_tokens(rows.limit(0)).count() == 0


def test_lowest_rank_merges_first():
    ranks = {(1, 2): (1, 9), (2, 1): (0, 8), (8, 2): (2, 7)}
    assert token_counts.merges_of([1, 2, 1, 2], ranks) == 2  # (2 1) first, then (8 2)
    assert token_counts.merges_of([1, 2], ranks) == 1 and token_counts.merges_of([2, 2, 2], ranks) == 0
    assert token_counts.merges_of([5, 5, 5, 5, 5], {(5, 5): (0, 6), (6, 6): (1, 7)}) == 3


# 13 vector codes


@pytest.mark.parametrize("entries,spread", [(1, 5), (2, 1), (5, 3), (16, 4), (16, 1000), (60, 6)])
def test_tree_finds_the_lowest_nearest_entry(entries, spread):
    dice = np.random.default_rng(entries + spread)
    book = dice.integers(-spread, spread + 1, (entries, 4))
    points = np.concatenate((dice.integers(-2 * spread, 2 * spread + 1, (500, 4)), book))
    index, square = vector_codes.Gnat(book).nearest(points)
    every = ((points[:, None] - book[None]) ** 2).sum(axis=2)
    assert (index == every.argmin(axis=1)).all() and (square == every.min(axis=1)).all()


def test_tree_eliminates_entries(monkeypatch):
    dice = np.random.default_rng(0)
    middles = np.repeat(dice.integers(-4000, 4000, (4, 8)), 4, axis=0)
    tree, measured = vector_codes.Gnat(middles + dice.integers(-20, 20, (16, 8))), []
    plain = vector_codes.Gnat._squares
    monkeypatch.setattr(vector_codes.Gnat, "_squares", lambda self, points, entry: measured.append(len(points)) or plain(self, points, entry))
    tree.nearest(np.repeat(middles, 50, axis=0) + dice.integers(-20, 20, (800, 8)))
    assert sum(measured) < 800 * 10


VECTORS = "vec_id long, embedding array<float>, label int, sums int"


def plain_codes(vectors):
    """Codes and errors of (id, vector) in order of id, and the codebooks."""
    grid = np.floor(np.array([v for _, v in vectors], np.float32).astype(float) * 4096).astype(np.int64).reshape(len(vectors), 8, -1)
    books = grid[:16].transpose(1, 0, 2).copy()
    for last in [False] * 6 + [True]:
        away = ((grid[:, :, None] - books[None]) ** 2).sum(axis=3)
        index = away.argmin(axis=2)
        if last:
            return {v: (bytes(i.tolist()).hex(), int(d.min(axis=1).sum())) for (v, _), i, d in zip(vectors, index, away, strict=True)}, books
        for part in range(8):
            for entry in range(books.shape[1]):
                own = grid[index[:, part] == entry, part]
                if len(own):
                    books[part, entry] = own.sum(axis=0) // len(own)


@pytest.mark.parametrize("n", [1, 7, 16, 120])
def test_codes(spark, n):
    dice = np.random.default_rng(n)
    vectors = [(k * 3, dice.normal(size=24).astype(np.float32).tolist()) for k in range(n)]
    rows = [(k, v, k % 4 or None, 0) for k, v in vectors] + [(-1, None, 1, 0), (-2, [1.0, None] * 12, 1, 0), (-3, [1e30] * 24, 1, 0)]
    rows += [(-4, [], 2, 0), (-5, [1.0] * 23, 2, 0)] if n > 1 else []
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    found = vector_codes.compress(df).collect()
    want, books = plain_codes(vectors)
    assert {r["vec_id"]: (r["code"], r["error"]) for r in found} == want
    labels = {}
    for k, _ in vectors:
        labels[k % 4 or None] = labels.get(k % 4 or None, 0) + want[k][1]
    assert all(r["label_error"] == labels[r["vec_id"] % 4 or None] for r in found)
    assert {r["codebooks_sha256"] for r in found} == {vector_codes.digest(books)}
    back = {r["vec_id"]: r["embedding"] for r in vector_codes.decode(spark.createDataFrame(found), books).collect()}
    for k, _ in vectors:
        code = bytes.fromhex(want[k][0])
        assert np.allclose(back[k], np.concatenate([books[p, code[p]] for p in range(8)]) / 4096)


def test_odd_vectors(spark):
    same = [(1, [0.5] * 8, None, 0), (1, [0.5] * 8, None, 0), (None, [-0.5] * 8, 1, 0), (None, [0.25] * 8, 1, 0)]
    found = vector_codes.compress(spark.createDataFrame(same, VECTORS)).collect()
    assert sorted((str(r["vec_id"]), r["code"], r["error"]) for r in found) == [
        ("1", "00" * 8, 0), ("1", "00" * 8, 0), ("None", "02" * 8, 0), ("None", "03" * 8, 0)
    ]
    for rows in ([], [(1, None, 1, 0)], [(1, [1.0] * 9, 1, 0)], [(1, [], 1, 0)]):
        assert vector_codes.compress(spark.createDataFrame(rows, VECTORS)).collect() == []
