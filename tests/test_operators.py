import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from larder.functions.calendar import calendar_parts, second_number
from larder.functions.documents import document, moment, rebuilt, text, to_second, whole_number
from larder.functions.money import PAY_TIERS, PayTier, half_away_int
from larder.operators import merge, numbering, paging, quality
from larder.operators.lookup import active_at, resolve
from larder.plans import marts
from larder.schemas import ForeignKey
from larder.sources import readers


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df, *columns):
    return sorted(tuple(row) for row in (df.select(*columns) if columns else df).collect())


# -- numbering and pages -------------------------------------------------------


def test_numbers_are_dense_and_in_order(spark):
    keys = spark.range(0, 20_000, 1, 7).select((F.col("id") * 7919 % 20_011).alias("key"))
    numbered = numbering.number_rows(keys, ["key"], start=100)
    got = [tuple(row) for row in numbered.orderBy("key").select("key", "id").collect()]
    assert got == [(key, 101 + i) for i, key in enumerate(sorted(key for key, _ in got))]
    assert len(got) == 20_000


def test_numbering_uses_several_partitions(spark):
    keys = spark.range(0, 50_000, 1, 7).select(F.col("id").alias("key"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = numbering.number_rows(keys, ["key"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert "SinglePartition" not in plan(numbered)
    assert "Window" not in plan(numbered)
    assert numbered.filter("id != key + 1").count() == 0
    assert numbered.count() == 50_000


def test_numbering_an_empty_frame(spark):
    assert numbering.number_rows(spark.range(0).toDF("key"), ["key"]).count() == 0


def test_pages_cover_every_row(spark):
    parts = spark.range(0, 107).select((F.col("id") % 10).alias("name"), "id")
    found = paging.pages(parts, ["name", "id"], 50)
    assert rows(found.groupBy("page_no").count()) == [(0, 50), (1, 50), (2, 7)]
    second = paging.page(parts, ["name", "id"], 50, 50)
    assert rows(second) == rows(found.filter("page_no = 1"), "name", "id")


# -- merge ---------------------------------------------------------------------


def test_last_row_of_a_key_wins_and_ids_stay(spark):
    current = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "id bigint, key string, ts int")
    batch = spark.createDataFrame([("b", 1), ("b", 2), ("c", 1)], "key string, ts int")
    merged = merge.upsert(current, batch, ["key"], ["ts"], surrogate="id")
    assert rows(merged) == [(1, "a", 0), (2, "b", 2), (3, "c", 1)]
    again = merge.upsert(merged, batch, ["key"], ["ts"], surrogate="id")
    assert rows(again) == rows(merged)


def test_hot_key_is_reduced_before_the_shuffle(spark):
    batch = spark.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("key"), F.col("id").alias("ts")
    )
    last = merge.last_per_key(batch, ["key"], ["ts"])
    assert "WindowGroupLimit" in plan(last)
    assert last.count() == 20_001
    assert last.filter("key = 0").first()["ts"] == 29_997


def test_conflicts_of_a_set_based_upsert(spark):
    batch = spark.createDataFrame(
        [("a", 1), ("b", 1), ("b", 2), ("c", 3), ("c", 3)], "key string, value int"
    )
    good, conflicts = merge.split_conflicts(batch, ["key"])
    assert rows(good) == [("a", 1)]
    assert rows(conflicts) == [("b", 1), ("b", 2), ("c", 3), ("c", 3)]
    good, conflicts = merge.split_conflicts(batch, ["key"], distinct=True)
    assert rows(good) == [("a", 1), ("c", 3)]
    assert rows(conflicts) == [("b", 1), ("b", 2)]
    assert rows(merge.copies_per_key(batch, ["key"])) == [("b", 2), ("c", 2)]


def test_two_batches_give_the_rows_of_one(spark):
    empty = spark.createDataFrame([], "key string, ts int")
    batch = spark.createDataFrame(
        [("a", 1), ("b", 1), ("a", 2), ("c", 3)], "key string, ts int"
    )
    whole = merge.upsert(empty, batch, ["key"], ["ts"])
    first = merge.upsert(empty, batch.filter("ts < 2"), ["key"], ["ts"])
    parts = merge.upsert(first, batch.filter("ts >= 2"), ["key"], ["ts"])
    assert rows(whole) == rows(parts)


# -- lookups -------------------------------------------------------------------


def test_lookups_drop_or_keep_misses(spark):
    facts = spark.createDataFrame([(1, "x"), (2, "y")], "n int, code string")
    dim = spark.createDataFrame([(10, "x")], "id bigint, natural string")
    inner = resolve(facts, dim, {"code": "natural"}, {"dim_id": "id"})
    assert rows(inner, "n", "dim_id") == [(1, 10)]
    left = resolve(facts, dim, {"code": "natural"}, {"dim_id": "id"}, "left")
    assert {(row["n"], row["dim_id"]) for row in left.collect()} == {(1, 10), (2, None)}
    counts = quality.unresolved(left, ["dim_id", "code"])
    assert rows(counts) == [("code", 0), ("dim_id", 1)]


def test_a_large_dimension_is_shuffled_not_broadcast(spark):
    facts = spark.range(1000).withColumnRenamed("id", "code")
    dim = spark.range(1000).withColumnRenamed("id", "natural")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        looked_up = resolve(facts, dim, {"code": "natural"}, {"found": "natural"})
        assert "SortMergeJoin" in plan(looked_up)
        assert looked_up.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_active_rows(spark):
    dim = spark.sql("select 1 id, timestamp_ntz'2024-01-01' active_to")
    assert active_at(dim, "2023-12-31 23:59:59").count() == 1
    assert active_at(dim, "2024-01-01 00:00:00").count() == 0


# -- documents -----------------------------------------------------------------


def test_documents_keep_text_nulls_and_element_order(spark):
    source = spark.createDataFrame(
        [("Пирог \"o'clock\"", None, [(2, 1.5), (1, 2.0)])],
        "name string, cost int, items array<struct<id int, price double>>",
    )
    items = rebuilt("items", id=lambda item: text(item["id"]), price=lambda item: text(item["price"]))
    value = source.select(document(name="name", cost="cost", items=items).alias("v")).first()["v"]
    assert value == (
        '{"name":"Пирог \\"o\'clock\\"","cost":null,'
        '"items":[{"id":"2","price":"1.5"},{"id":"1","price":"2.0"}]}'
    )


def test_moments(spark):
    row = spark.sql("select '2023-03-10T10:00:07.999999' a, 'soon' b").select(
        to_second(moment("a")).alias("a"), moment("b").alias("b")
    )
    assert tuple(row.first()) == (dt.datetime(2023, 3, 10, 10, 0, 7), None)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_seconds_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 02:30 on that day does not exist in New York.
        frame = spark.sql("select '2023-03-12 02:30:07.999999' a").select(
            to_second(moment("a")).alias("ts")
        )
        row = calendar_parts(frame).select("*", second_number(F.col("ts")).alias("n")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert row["ts"] == dt.datetime(2023, 3, 12, 2, 30, 7)
    assert (row["year"], row["month"], row["day"], row["time"]) == (2023, 3, 12, "02:30:07")
    assert row["date"] == dt.date(2023, 3, 12)
    assert row["n"] == int(dt.datetime(2023, 3, 12, 2, 30, 7, tzinfo=dt.timezone.utc).timestamp())


@pytest.mark.parametrize("value, cut, rounded", [("2.5", 2, 3), ("-2.5", -2, -3), ("4.4", 4, 4)])
def test_number_casts(spark, value, cut, rounded):
    row = spark.range(1).select(
        whole_number(F.lit(value)).cast("int").alias("cut"),
        half_away_int(F.lit(value).cast("double")).alias("rounded"),
        F.lit(value).cast("decimal(4,1)").cast("decimal(4,0)").cast("int").alias("assigned"),
    )
    assert tuple(row.first()) == (cut, rounded, rounded)


# -- ledger --------------------------------------------------------------------


def ledger_inputs(spark, couriers):
    deliveries, orders = [], []
    for courier, lines in couriers.items():
        for rate, amount, tip in lines:
            order = len(orders) + 1
            orders.append((order, 1))
            deliveries.append((order, courier, rate, Decimal(amount), Decimal(tip)))
    return (
        spark.createDataFrame(
            deliveries,
            "order_id bigint, courier_id bigint, rate int, order_sum decimal(14,5),"
            " tip_sum decimal(14,5)",
        ),
        spark.createDataFrame(orders, "id bigint, timestamp_id bigint"),
        spark.createDataFrame([(1, 2023, 3)], "id bigint, year int, month int"),
    )


LEDGER = {
    # courier: lines, then count, total, rate, fee, pay, tips, reward
    1: ([(5, "500", "10"), (4, "500", "0"), (4, "500", "0"), (3, "500", "0")],
        (4, "2000", 4, "500", "150", "10", "152")),
    2: ([(5, "1100", "0"), (4, "1100", "0")], (2, "2200", 5, "550", "154", "0", "146.3")),
    3: ([(5, "2000", "5")], (1, "2000", 5, "500", "200", "5", "194.75")),
    4: ([(5, "2000.01", "0")],
        (1, "2000.01", 5, "500.0025", "140.0007", "0", "133.00067")),
    5: ([(3, "2000", "0")], (1, "2000", 3, "500", "100", "0", "95")),
    6: ([(5, "10", "0")] * 9 + [(4, "10", "0")], (10, "100", 5, "25", "200", "0", "190")),
}


def test_ledger_at_the_edges_of_all_tiers(spark):
    inputs = ledger_inputs(spark, {courier: lines for courier, (lines, _) in LEDGER.items()})
    good, rejected = quality.validate(marts.courier_ledger(*inputs), "cdm.dm_courier_ledger")
    assert rejected.count() == 0
    columns = (
        "order_count", "orders_total_sum", "rate_avg", "order_processing_fee",
        "courier_order_sum", "courier_tips_sum", "courier_reward_sum",
    )
    found = {int(row["courier_id"]): tuple(row[c] for c in columns) for row in good.collect()}
    for courier, (_, expected) in LEDGER.items():
        assert found[courier] == tuple(
            Decimal(value) if isinstance(value, str) else value for value in expected
        ), courier


def test_tiers_are_a_parameter(spark):
    fixed = tuple(
        PayTier(tier.from_rate, tier.test_share, tier.test_share, tier.floor) for tier in PAY_TIERS
    )
    inputs = ledger_inputs(spark, {4: LEDGER[4][0]})
    pay = marts.courier_ledger(*inputs, tiers=fixed).first()["courier_order_sum"]
    assert pay == Decimal("200.001")


def test_delivery_without_order_has_no_period(spark):
    deliveries, orders, timestamps = ledger_inputs(spark, {3: LEDGER[3][0]})
    ledger = marts.courier_ledger(deliveries, orders.filter("id > 1"), timestamps)
    _, rejected = quality.validate(ledger, "cdm.dm_courier_ledger")
    assert rejected.first()["reasons"][:2] == ["null: settlement_year", "null: settlement_month"]


# -- quality -------------------------------------------------------------------


def settlement_row(**changes):
    row = {
        "restaurant_id": "1",
        "restaurant_name": "r",
        "settlement_date": dt.date(2022, 1, 2),
        "orders_count": 1,
        **{
            name: Decimal("1.00")
            for name in (
                "orders_total_sum", "orders_bonus_payment_sum", "orders_bonus_granted_sum",
                "order_processing_fee", "restaurant_reward_sum",
            )
        },
    }
    return {**row, **changes}


SETTLEMENT_ROW = (
    "restaurant_id string, restaurant_name string, settlement_date date, orders_count int,"
    " orders_total_sum decimal(30,5), orders_bonus_payment_sum decimal(30,5),"
    " orders_bonus_granted_sum decimal(30,5), order_processing_fee decimal(30,5),"
    " restaurant_reward_sum decimal(30,5)"
)


@pytest.mark.parametrize(
    "changes, reasons",
    [
        ({}, None),
        ({"settlement_date": dt.date(2022, 1, 1)}, ["check: settlement_date_in_range"]),
        ({"settlement_date": dt.date(2500, 1, 1)}, ["check: settlement_date_in_range"]),
        ({"orders_total_sum": Decimal("-0.01")}, ["check: orders_total_sum_not_negative"]),
        ({"orders_total_sum": Decimal("-0.001")}, None),
        ({"orders_total_sum": Decimal("999999999999.99")}, None),
        ({"orders_total_sum": Decimal("999999999999.995")}, ["overflow: orders_total_sum"]),
        ({"restaurant_name": "n" * 250}, None),
        ({"restaurant_name": "n" * 251}, ["length: restaurant_name"]),
        ({"restaurant_name": None, "orders_count": -1},
         ["null: restaurant_name", "check: orders_count_not_negative"]),
    ],
)
def test_settlement_rules(spark, changes, reasons):
    batch = spark.createDataFrame([settlement_row(**changes)], SETTLEMENT_ROW)
    good, rejected = quality.validate(batch, "cdm.dm_settlement_report")
    assert good.count() == (0 if reasons else 1)
    assert [row["reasons"] for row in rejected.collect()] == ([reasons] if reasons else [])


def test_all_rules_are_one_pass(spark):
    batch = spark.createDataFrame([settlement_row()], SETTLEMENT_ROW)
    flagged = quality.flag_rows(batch, "cdm.dm_settlement_report")
    assert "Exchange" not in plan(flagged)


def ledger_row(year):
    one = Decimal("1")
    return ("1", year, 3, 1, one, 5, one, one, one, one)


def test_years_that_are_accepted(spark):
    columns = (
        "courier_id string, settlement_year int, settlement_month int, order_count int,"
        " orders_total_sum decimal(14,5), rate_avg int, order_processing_fee decimal(14,5),"
        " courier_order_sum decimal(14,5), courier_tips_sum decimal(14,5),"
        " courier_reward_sum decimal(14,5)"
    )
    batch = spark.createDataFrame([ledger_row(2022), ledger_row(2023)], columns)
    good, rejected = quality.validate(batch, "cdm.dm_courier_ledger")
    assert [row["settlement_year"] for row in good.collect()] == [2023]
    assert rejected.first()["reasons"] == ["check: settlement_year_in_range"]
    good, _ = quality.validate(
        batch, "cdm.dm_courier_ledger", bounds={"ledger_year_after": 2000}
    )
    assert good.count() == 2
    day = spark.sql(
        "select timestamp_ntz'2022-05-01' ts, 2022 year, 5 month, 1 day, '00:00:00' time,"
        " date'2022-05-01' date"
    )
    assert quality.validate(day, "dds.dm_timestamps")[1].count() == 0


def test_keys_foreign_keys_and_abort(spark):
    batch = spark.createDataFrame(
        [("o1", "CLOSED", 1, 1, 1), ("o2", "CLOSED", 9, 1, 1), ("o3", "CLOSED", 1, 1, 1),
         ("o3", "CLOSED", 1, 1, 1)],
        "order_key string, order_status string, user_id bigint, restaurant_id bigint,"
        " timestamp_id bigint",
    )
    parents = {"dds.dm_users": spark.createDataFrame([(1,)], "id bigint")}
    good, rejected = quality.validate(batch, "dds.dm_orders", parents=parents, unique=True)
    assert rows(good, "order_key") == [("o1",)]
    assert {(row["order_key"], tuple(row["reasons"])) for row in rejected.collect()} == {
        ("o2", ("foreign key: user_id -> dds.dm_users",)),
        ("o3", ("duplicate key: order_key",)),
    }
    orphan = quality.orphans(batch, ForeignKey("user_id", "dds.dm_users"), parents["dds.dm_users"])
    assert rows(orphan, "order_key") == [("o2",)]
    with pytest.raises(quality.RejectedRows, match=r"duplicate key: order_key \(2\)"):
        quality.validate(batch, "dds.dm_orders", unique=True, on_fail="abort")


# -- reads ---------------------------------------------------------------------


def test_increments_are_strict_and_pushed_to_the_scan(spark, tmp_path):
    at = dt.datetime(2024, 1, 1)
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, at), (2, at + dt.timedelta(1))], "id int, update_ts timestamp_ntz") \
        .write.parquet(path)
    source = readers.Source("parquet", path=path).load(spark)
    by_id = readers.after_id(source, 1)
    assert rows(by_id, "id") == [(2,)]
    assert "GreaterThan(id,1)" in plan(by_id)
    by_ts = readers.after_ts(source, "2024-01-01 00:00:00")
    assert rows(by_ts, "id") == [(2,)]
    assert "GreaterThan(update_ts,2024-01-01T00:00)" in plan(by_ts)
    assert readers.after_id(source, readers.FIRST_ID).count() == 2
    assert readers.after_ts(source).count() == 2


def test_landed_pages_are_united_without_a_cap(spark, tmp_path):
    for page in range(60):
        lines = ", ".join(
            f'{{"_id": "c{page * 50 + i:04d}", "name": "Имя"}}' for i in range(50)
        )
        (tmp_path / f"page-{page}.json").write_text(f"[{lines}]", encoding="utf-8")
    source = readers.landed_pages(str(tmp_path), "_id string, name string").load(spark)
    assert source.count() == 3000
    assert source.select("name").distinct().first()["name"] == "Имя"


def test_lookback_is_midnight_to_midnight(spark):
    moments = ["2024-01-12 23:59:59", "2024-01-13 00:00:00", "2024-01-19 23:59:59",
               "2024-01-20 00:00:00"]
    frame = spark.createDataFrame([(m,) for m in moments], "m string").select(
        moment("m").alias("ts")
    )
    assert readers.lookback(frame, "ts", dt.date(2024, 1, 20)).count() == 2


def test_partitioned_jdbc_options():
    source = readers.jdbc(
        "jdbc:postgresql://source/bonus", "public.outbox", "id", (0, 1000), 16, user="reader"
    )
    assert source.format == "jdbc"
    assert source.options["numPartitions"] == "16"
    assert source.options["partitionColumn"] == "id"
    assert source.options["user"] == "reader"
