"""The corpus pipeline against a brute-force version of each stage, on the smallest tables and on odd rows."""

import hashlib
import re

import corpus_pipeline
from larder.llm import quality, sentencepieces
from larder.llm.textbytes import WORD_PATTERN
from test_text_operators import brute_components

FOLDER = "/root/testdata/sf0.001"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute_lines(docs):
    def key(line):
        return lower(line.strip(" \t\n\x0b\x0c\r"))

    holders = {}
    for doc_id, text in docs.items():
        for k in {key(line) for line in (text or "").split("\n")}:
            if len(k) >= 20:
                holders.setdefault(k, []).append(doc_id)
    gone = {k: max(ids) for k, ids in holders.items() if len(ids) >= 3}
    return {
        i: "\n".join(line for line in (t or "").split("\n") if gone.get(key(line), i) == i) for i, t in docs.items()
    }


def brute_leaks(docs, items):
    def words(text):
        return re.findall(WORD_PATTERN, lower(text))

    phrases = set()
    for text in items:
        w = words(text)
        phrases |= {tuple(w[k : k + 10]) for k in range(max(1, len(w) - 9))} if w else set()
    sizes = {len(p) for p in phrases}
    out = {}
    for i, text in docs.items():
        w = words(text)
        if not any(tuple(w[k : k + n]) in phrases for n in sizes for k in range(len(w) - n + 1)):
            out[i] = text
    return out


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    steps = [f for _, f in corpus_pipeline.STAGES]
    assert len(steps) == 5

    def after(k, frame):
        steps[k](spark, frame, FOLDER).write.parquet(f"{tmp_path}/{k}")
        return spark.read.parquet(f"{tmp_path}/{k}")

    one = after(0, docs)
    model = quality.train(docs, quality.grades_of(spark.read.parquet(f"{FOLDER}/labels.parquet")))
    keep = {r["doc_id"] for r in quality.judge(docs, model).collect() if r["keep"]}
    assert {r["doc_id"]: r["text"] for r in one.collect()} == {i: t for i, t in texts.items() if i in keep}
    two = after(1, one)
    lines = brute_lines({i: t for i, t in texts.items() if i in keep})
    assert {r["doc_id"]: r["text"] for r in two.collect()} == lines
    three = after(2, two)
    groups = brute_components(list(lines.items()), 5, 80)
    single = {i: t for i, t in lines.items() if groups[i][1] == i}
    assert {r["doc_id"]: r["text"] for r in three.collect()} == single
    four = after(3, three)
    items = [r["text"] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    clean = brute_leaks(single, items)
    assert {r["doc_id"]: r["text"] for r in four.collect()} == clean
    assert one.columns == two.columns == three.columns == four.columns == docs.columns
    five = {r["doc_id"]: r for r in after(4, four).collect()}
    assert {i: r["decoded_sha256"] for i, r in five.items()} == {
        i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in clean.items()
    }
    encoder = sentencepieces.Encoder(sentencepieces.Vocabulary(sentencepieces.MODEL))
    assert encoder and all(len(r["ids"]) == r["n_tokens"] for r in five.values())
    whole = corpus_pipeline.run(spark, FOLDER)
    assert {tuple(r[:2]) for r in whole.select("doc_id", "n_tokens").collect()} == {(i, r["n_tokens"]) for i, r in five.items()}


def test_odd_rows_and_empty_tables(spark, tmp_path):
    from test_text_queries import ODD_DOCUMENTS, ODD_ITEMS, odd_tables

    for name, rows in (("odd", ODD_DOCUMENTS + [(None, None), (8, "again")]), ("none", [])):
        folder = tmp_path / name
        folder.mkdir()
        odd_tables(folder, rows, ODD_ITEMS, [])
        labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
        labels.write.parquet(f"{folder}/labels.parquet")
        result = corpus_pipeline.run(spark, str(folder))
        assert result.count() <= len(rows) and (result.count() > 0) == bool(rows)
