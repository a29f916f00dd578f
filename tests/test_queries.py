"""Every registered query against its SQL on the smallest test tables."""

import os

import pytest
from oracle import connect, differences
from pyspark.sql import DataFrame

import __spark_entry__ as entry_file
from larder.catalog import CATALOG, staged_texts
from larder.sources import readers

FOLDER = "/root/testdata/sf0.001"
QUERIES = {name: entry.run for name, entry in CATALOG.items()}
SQL = {name: entry.sql for name, entry in CATALOG.items() if entry.sql}


@pytest.fixture(scope="module")
def tables():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry_file.queries()) and set(SQL) <= set(entry_file.oracle_sql())


def test_entry(spark):
    result = entry_file.entry(spark)
    assert isinstance(result, DataFrame) and result.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    assert differences(QUERIES[name](spark, FOLDER), SQL[name], tables) == []


def test_texts_of_any_length_are_staged(spark, tables):
    assert differences(staged_texts(spark, FOLDER), "SELECT doc_id, lang, n_chars FROM documents", tables) == []


@pytest.mark.parametrize("name", ["settlement_report", "courier_ledger", "fact_product_sales"])
def test_no_python_in_plans(spark, name):
    text = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_mart_scans_are_narrow_and_filtered(spark):
    text = QUERIES["settlement_report"](spark, FOLDER)._jdf.queryExecution().toString()
    assert "EqualTo(o_orderstatus,F)" in text
    assert "o_totalprice" not in text.split("== Physical Plan ==")[1]


def test_pages_lie_in_one_folder(spark, tmp_path, monkeypatch):
    """One file per page, and none of the folders and tasks that would grow with the pages."""
    spark.range(320).selectExpr("id AS p_partkey", "concat('part ', id % 7) AS p_name").write.parquet(f"{tmp_path}/part.parquet")
    landed, read = [], readers.landed_pages
    monkeypatch.setattr(readers, "landed_pages", lambda path, schema: landed.append(path) or read(path, schema))
    found = QUERIES["pages_union"](spark, str(tmp_path))
    names = [name for name in os.listdir(landed[0]) if name[0] not in "._"]
    assert len(names) == 7 and all(name.endswith(".txt") for name in names)
    assert sorted((row["page_no"], row["place"]) for row in found.collect()) == [(n // 50, n % 50 + 1) for n in range(320)]
