"""A third of all rows under one key: results stay whole, the hot group is split."""

from contextlib import contextmanager
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from larder import demo
from larder.operators import merge
from larder.operators.lookup import resolve
from larder.plans import dimensions, facts, marts

# Limits scaled down to the size of the test rows.
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@contextmanager
def settings(spark, values):
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def hot(spark):
    """60,000 rows, every third of them with key 0."""
    return spark.range(0, 60_000, 1, 8).select(
        "id",
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000).cast("bigint").alias("code"),
    )


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_of_a_hot_key_is_split(spark, hot, how):
    dim = spark.range(5000).select(F.col("id").alias("natural"), (F.col("id") * 2).alias("n"))
    with settings(spark, SMALL):
        found = resolve(hot, dim, {"code": "natural"}, {"dim_id": "n"}, how)
        assert "skew=true" in final_plan(found)
        assert found.count() == 60_000
        assert found.filter("dim_id != code * 2").count() == 0


def test_settlement_of_a_hot_second_and_restaurant(spark, hot):
    orders = hot.select(
        "id",
        F.lit("CLOSED").alias("order_status"),
        (F.col("code") % 40).alias("restaurant_id"),
        F.col("code").alias("timestamp_id"),
    )
    one = F.lit(1).cast("decimal(19,5)")
    sales = hot.select(
        F.col("id").alias("order_id"),
        one.alias("total_sum"),
        one.alias("bonus_payment"),
        one.alias("bonus_grant"),
    )
    days = spark.range(5000).select("id", F.lit("2024-01-01").cast("date").alias("date"))
    restaurants = spark.range(40).select(
        "id",
        F.col("id").cast("string").alias("restaurant_name"),
        F.lit("2099-12-31").cast("timestamp_ntz").alias("active_to"),
    )
    with settings(spark, SMALL):
        report = marts.settlement_report(orders, sales, days, restaurants, "2024-01-01 00:00:00")
        assert "skew=true" in final_plan(report)
        rows = {row["restaurant_id"]: row for row in report.collect()}
    assert sum(row["orders_count"] for row in rows.values()) == 60_000
    assert rows["0"]["orders_total_sum"] == Decimal(rows["0"]["orders_count"])
    assert rows["0"]["orders_count"] > 20_000


def test_hot_account_is_reduced_to_its_key(spark, hot):
    users = spark.range(10).select(
        F.col("id").cast("string").alias("object_id"),
        F.lit('{"name": "n", "login": "l"}').alias("object_value"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("update_ts"),
    )
    accounts = hot.select("id", F.col("code").cast("string").alias("order_user_id"))
    with settings(spark, SMALL):
        found = dimensions.users(users, accounts)
        text = final_plan(found)
        assert found.count() == 10
    # Accounts are aggregated on the map side before they are exchanged.
    assert text.count("HashAggregate(keys=[order_user_id") >= 2


def test_hot_conflict_is_reported_whole(spark, hot):
    batch = hot.filter("code = 0 or id < 5000")
    with settings(spark, SMALL):
        good, conflicts = merge.split_conflicts(batch, ["code"])
        hot_rows = batch.filter("code = 0").count()
        assert hot_rows >= 20_000
        assert conflicts.filter("code = 0").count() == hot_rows
        assert good.count() + conflicts.count() == batch.count()


def test_sales_and_large_dimensions_are_not_broadcast(spark):
    events = spark.range(200).select(
        F.col("id").cast("int").alias("id"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("event_ts"),
        F.lit("bonus_transaction").alias("event_type"),
        F.format_string(
            '{"order_id": "o%d", "product_payments": [{"product_id": "p%d", "price": 2, "quantity": 3}]}',
            F.col("id") % 10, F.col("id") % 4,
        ).alias("event_value"),
    )
    orders = spark.range(10).select(
        "id", F.format_string("o%d", "id").alias("order_key"), F.lit("CLOSED").alias("order_status"),
        F.lit(1).cast("bigint").alias("restaurant_id"),
    )
    products = spark.range(4).select(
        "id", F.format_string("p%d", "id").alias("product_id"), F.lit(1).cast("bigint").alias("restaurant_id")
    )
    for match in (False, True):
        sales = facts.product_sales(events, products, orders, match)
        assert "Broadcast" not in final_plan(sales)
        assert sales.count() == 200
    fanout = facts.sales_fanout(events, products)
    assert "Broadcast" not in final_plan(fanout)
    assert {(row["product_id"], row["matches"]) for row in fanout.collect()} == {(f"p{n}", 50) for n in range(4)}


def test_menus_are_not_broadcast(spark, tmp_path):
    spark.sql("SELECT bigint(0) AS s_suppkey, 'a' AS s_name UNION ALL SELECT 7, 'b'").write.parquet(f"{tmp_path}/supplier.parquet")
    part = "SELECT bigint(2) AS p_partkey, 'x' AS p_name, 1.5D AS p_retailprice, 't' AS p_type"
    spark.sql(part).write.parquet(f"{tmp_path}/part.parquet")
    found = demo.source_restaurants(spark, str(tmp_path))
    assert "Broadcast" not in final_plan(found)
    assert {row["_id"]: len(row["menu"]) for row in found.collect()} == {0: 2, 7: 0}
