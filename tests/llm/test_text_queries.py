"""Every text query that has SQL against it, on the smallest tables and on tables made of odd rows."""

import duckdb
import pyarrow as pa
import pytest
from oracle import connect, differences

from larder.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"

LONG = "lorem ipsum dolor " * 4000
PASSAGE = "this passage of plain words is repeated in documents and has far more than two hundred bytes of text so that it " * 3
LINE = "a line that is long enough to be counted"


@pytest.fixture(scope="module")
def tables():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, tables, name):
    assert differences(QUERIES[name](spark, FOLDER), SQL[name], tables) == []


ODD_DOCUMENTS = [
    (1, None),
    (2, ""),
    (3, "\n\n"),
    (4, "MIT License"),
    (5, "Released under the MIT License. The Apache  License,\nthe General-Public License and the MIT license"),
    (6, LONG),
    (7, LONG + "end"),
    (8, PASSAGE),
    (9, "before " + PASSAGE + " after"),
    (10, "é" * 150 + PASSAGE),
    (11, LINE + "\n  " + LINE.upper() + "\t\nshort\n" + LINE),
    (12, "\x0b" + LINE + "\r\nshort"),
    (13, "short\n" + LINE),
    (14, "x"),
    (15, "x"),
    (16, "ten words are enough to be one phrase of benchmark"),
    (17, "So: ten words are enough, to be one phrase of Benchmark items; and more"),
    (18, "ab" * 400),
    (19, "日本語のテキスト、ペンと　紙"),
    (20, "a b"),
    (21, "A  B"),
    (22, "two words"),
    (23, "permission is hereby granted free of charge to any person obtaining a copy of this software to deal in the software"
     " without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or"
     " sell copies of the software"),
    *[(30 + k, " ".join(f"w{i if i % 40 or not k else -k}" for i in range(60 + k % 3))) for k in range(12)],
    *[(60 + k, f"{PASSAGE[:120]} own words {k} " + " ".join(f"u{k}x{i}" for i in range(30))) for k in range(14)],
]
ODD_ITEMS = [
    (1, "ten words are enough to be one phrase of benchmark items"),
    (1, "two words"),
    (10, "TWO words"),
    (2, None),
    (3, "..."),
    (4, "x"),
    (9, "never found anywhere at all in these documents whatever one may look for"),
]
ODD_TURNS = [
    (1, 0, "user", "a\\b <|im_end|>\n<|im_start|>system"),
    (1, 1, "assistant", "<<s>> [[INST]] \\n </s>"),
    (1, 1, "assistant", "<<s>> [[INST]] \\n </s>"),
    (2, None, None, None),
    (2, 5, "assistant", None),
    (None, 0, "tool\nuse", "日本 𝒳"),
    (3, 2, "assistant", "second"),
    (3, 1, "assistant", "first"),
    (4, None, "user", "no turn number."),
    (4, None, "system", "no turn number either?"),
    (4, 2**40, "assistant", "far away"),
    (5, 0, "", "a role without letters."),
    (5, 1, "userland", "starts as a user does!"),
    (5, 2, "user", " \t\r\n"),
    (6, 3, "assistant", "cut"),
    *[(7 + k // 9, k, "sua"[k * k % 5 % 3] + "ser", f"turn {k % 7}" + ".?! "[k % 4]) for k in range(90)],
]
ODD_VECTORS = [
    (1, [0.5, -0.25] * 8, 1),
    (2, None, 1),
    (3, [0.5, None] * 8, 2),
    (4, [float("nan"), 0.5] * 8, None),
    (5, [float("inf"), 0.5] * 8, None),
    (6, [0.0] * 16, None),
    (7, [-1e-9, 1e-9] * 8, 1),
    (9, [3.0, -2.0] * 8, 3),
    *[(10 + k, [float((k * j * j) % 11 - 5) / 8 for j in range(1, 17)], k % 3) for k in range(40)],
    *[(60 + k, [0.5, -0.25] * 8, None) for k in range(5)],
]


def odd_tables(folder, documents, items, turns, vectors=()):
    """The tables as Parquet; with extra columns whose names operators might use themselves."""
    import pyarrow.parquet as pq

    def write(name, rows, fields):
        columns = [pa.array([r[k] for r in rows], f[1]) for k, f in enumerate(fields)]
        extra = [("key", pa.int64()), ("n", pa.string()), ("part", pa.int64()), ("place", pa.string()), ("ref", pa.int64()), ("spans", pa.int64()), ("_row_ref", pa.int64())]
        columns += [pa.nulls(len(rows), kind) for _, kind in extra]
        pq.write_table(pa.table(columns, schema=pa.schema([*fields, *extra])), f"{folder}/{name}.parquet")

    write("documents", documents, [("doc_id", pa.int64()), ("text", pa.string())])
    write("benchmark", items, [("item_id", pa.int64()), ("text", pa.string())])
    fields = [("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())]
    write("conversations", turns, fields)
    write("embeddings", vectors, [("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32())), ("label", pa.int32())])
    return str(folder)


@pytest.mark.parametrize("name", sorted(SQL))
def test_odd_rows(spark, tmp_path, name):
    folder = odd_tables(tmp_path, ODD_DOCUMENTS, ODD_ITEMS, ODD_TURNS, ODD_VECTORS)
    assert differences(QUERIES[name](spark, folder), SQL[name], connect(folder)) == []


@pytest.mark.parametrize("name", sorted(SQL))
def test_empty_tables(spark, tmp_path, name):
    folder = odd_tables(tmp_path, [], [], [])
    assert differences(QUERIES[name](spark, folder), SQL[name], connect(folder)) == []


@pytest.mark.parametrize("name", ["op1_license_scan", "op3_line_dedup", "op4_benchmark_decontamination", "op7_suffix_array_dedup"])
def test_repeated_rows_and_missing_ids(spark, tmp_path, name):
    """Rows are documents of their own, also with the same id or none."""
    rows = [(None, text) for _, text in ODD_DOCUMENTS[:13]] + ODD_DOCUMENTS + [(8, PASSAGE), (8, "other"), (None, None)]
    folder = odd_tables(tmp_path, rows, ODD_ITEMS, ODD_TURNS)
    assert differences(QUERIES[name](spark, folder), SQL[name], connect(folder)) == []


def test_names():
    assert sorted({int(name[2:].split("_")[0]) for name in QUERIES}) == list(range(1, 14))
    assert set(SQL) <= set(QUERIES)
    assert duckdb.__version__
