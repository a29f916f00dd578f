"""Whole runs over small sources, against results worked out by hand."""

import datetime as dt
from dataclasses import replace
from decimal import Decimal

import pytest
from marketplace import SETTINGS, UPDATED, order, payment, sources
from marketplace import DELIVERY_ROW, ORDER_ROW, OUTBOX_ROW, RESTAURANT_ROW

from larder.operators.quality import RejectedRows
from larder.plans import dimensions, facts, marts, staging
from larder.plans.runs import LOADS, Run
from larder.schemas import TABLES
from larder.sources.store import Store


def delivery(order_id, delivery_id, courier, day, rate=5, amount="100", tip="10"):
    moment = f"2023-03-{day:02d} 13:00:00.250000"
    return (
        order_id, moment, delivery_id, courier, "ул. Ленина, 1", moment, rate,
        Decimal(amount), Decimal(tip),
    )


# The last one is outside the seven days before the run date.
DELIVERIES = [
    delivery("o1", "d1", "c1", 27),
    delivery("o2", "d2", "c1", 28, rate=4),
    delivery("o5", "d5", "c2", 29, tip="0"),
    delivery("o3", "d3", "c9", 30),
    delivery("o3", "d0", "c1", 10),
]


def rows(df, *columns):
    return sorted(tuple(row) for row in df.select(*columns).collect())


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    store = Store(spark, str(tmp_path_factory.mktemp("warehouse")), span=3)
    store.create()
    run = Run(store, sources(spark, DELIVERIES), SETTINGS)
    results = {result.table: result for result in run.everything()}
    return run, results


def test_creating_again_empties_every_table(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    row = spark.createDataFrame([(1, "u1")], "id int, order_user_id string")
    store.create(["stg.bonussystem_users"])
    store.upsert("stg.bonussystem_users", row, order=["order_user_id"])
    assert store.read("stg.bonussystem_users").count() == 1
    store.create(["stg.bonussystem_users"])
    assert store.read("stg.bonussystem_users").count() == 0


def test_layers(loaded):
    run, _ = loaded
    assert len(TABLES) == 22
    for name, table in TABLES.items():
        assert run.store.exists(table)
        assert table.payload and set(table.key) <= set(table.columns)


def test_staged_payloads(loaded):
    run, _ = loaded
    text = run.table("stg.ordersystem_restaurants").filter("object_id = 'r1'").first()
    assert '"name":"Пельменная"' in text["object_value"]
    assert text["update_ts"] == UPDATED
    names = rows(run.table("dds.dm_users"), "user_id", "user_name", "user_login")
    assert names == [("u1", "Аня", "anya"), ("u2", "O'Neil", "oneil")]


def test_restaurants_and_couriers_are_open_ended(loaded):
    run, _ = loaded
    end = dt.datetime(2099, 12, 31)
    found = rows(run.table("dds.dm_restaurants"), "restaurant_id", "active_from", "active_to")
    assert found == [("r1", UPDATED, end), ("r2", UPDATED, end), ("r3", UPDATED, end)]
    couriers = rows(run.table("dds.dm_couriers"), "courier_id", "courier_name", "active_from")
    assert couriers == [
        ("c1", "Иван", dt.datetime(2023, 4, 1)),
        ("c2", "Bob", dt.datetime(2023, 4, 1)),
    ]


def test_products_per_restaurant(loaded):
    run, _ = loaded
    restaurants = run.table("dds.dm_restaurants").selectExpr("id as rid", "restaurant_id as r")
    products = run.table("dds.dm_products").withColumnRenamed("restaurant_id", "rid")
    found = products.join(restaurants, "rid")
    assert rows(found, "r", "product_id", "product_price") == [
        ("r1", "p1", Decimal("10.00")),
        ("r1", "p2", Decimal("5.50")),
        ("r2", "p1", Decimal("11.00")),
        ("r2", "p3", Decimal("7.00")),
    ]


def test_timestamps_are_cut_to_seconds(loaded):
    run, _ = loaded
    found = rows(run.table("dds.dm_timestamps"), "ts", "time")
    assert (dt.datetime(2023, 3, 10, 10, 0, 0), "10:00:00") in found
    assert dt.datetime(2023, 3, 12, 8, 0, 0) not in [ts for ts, _ in found]
    assert (dt.datetime(2023, 3, 27, 13, 0, 0), "13:00:00") in found
    assert len(found) == 5 + 4


def test_orders_with_all_lookups(loaded):
    run, _ = loaded
    assert rows(run.table("dds.dm_orders"), "order_key") == [("o1",), ("o2",), ("o3",), ("o5",)]


def test_delivery_of_unknown_courier_is_set_aside(loaded):
    run, results = loaded
    assert rows(run.table("dds.dm_deliveries"), "delivery_id") == [("d1",), ("d2",), ("d5",)]
    rejected = run.store.rejected("dds.dm_deliveries").collect()
    assert [(row["delivery_id"], row["reasons"]) for row in rejected] == [
        ("d3", ["null: courier_id"])
    ]
    assert results["dds.dm_deliveries"].rejected == 1


def test_product_sales(loaded):
    run, _ = loaded
    orders = run.table("dds.dm_orders").selectExpr("id as oid", "order_key")
    products = run.table("dds.dm_products").selectExpr("id as pid", "product_id as p")
    sales = run.table("dds.fct_product_sales")
    found = sales.join(orders, sales.order_id == orders.oid).join(
        products, sales.product_id == products.pid
    )
    assert rows(found, "order_key", "p", "count", "total_sum", "bonus_payment") == [
        ("o1", "p2", 2, Decimal("11.00000"), Decimal("1.25000")),
        ("o2", "p1", 1, Decimal("10.00000"), Decimal("0.00000")),
        ("o2", "p1", 1, Decimal("10.00000"), Decimal("0.00000")),
    ]


def test_settlement_report(loaded):
    run, results = loaded
    found = rows(
        run.table("cdm.dm_settlement_report"),
        "restaurant_name", "settlement_date", "orders_count", "orders_total_sum",
        "orders_bonus_payment_sum", "orders_bonus_granted_sum", "order_processing_fee",
        "restaurant_reward_sum",
    )
    assert found == [
        (
            "Пельменная", dt.date(2023, 3, 10), 2, Decimal("31.00"), Decimal("1.25"),
            Decimal("2.00"), Decimal("7.75"), Decimal("22.00"),
        )
    ]
    rejected = run.store.rejected("cdm.dm_settlement_report").collect()
    assert len(rejected) == 1 and "null: orders_total_sum" in rejected[0]["reasons"]
    assert results["cdm.dm_settlement_report"].received == 2


def test_settlement_report_with_matching_restaurant(loaded):
    run, _ = loaded
    sales = facts.product_sales(
        run.table("stg.bonussystem_events"),
        run.table("dds.dm_products"),
        run.table("dds.dm_orders"),
        match_restaurant=True,
    )
    report = marts.settlement_report(
        run.table("dds.dm_orders"),
        sales,
        run.table("dds.dm_timestamps"),
        run.table("dds.dm_restaurants"),
        SETTINGS.as_of,
    ).filter("orders_count > 0")
    row = report.first()
    assert (row["orders_count"], row["orders_total_sum"]) == (2, Decimal("21"))
    assert row["order_processing_fee"] == Decimal("5.25")
    assert row["restaurant_reward_sum"] == Decimal("14.50")


def test_inactive_restaurants_are_summed_without_a_name(loaded):
    run, _ = loaded
    report = marts.settlement_report(
        run.table("dds.dm_orders"),
        run.table("dds.fct_product_sales"),
        run.table("dds.dm_timestamps"),
        run.table("dds.dm_restaurants"),
        "2100-01-01 00:00:00",
    )
    assert {row["restaurant_id"] for row in report.collect()} == {None}


def test_ledger_counts_by_month_of_the_order(loaded):
    run, _ = loaded
    couriers = {row["id"]: row["courier_id"] for row in run.table("dds.dm_couriers").collect()}
    ledger = run.table("cdm.dm_courier_ledger").collect()
    found = {
        couriers[int(row["courier_id"])]: (
            row["settlement_year"], row["settlement_month"], row["order_count"], row["rate_avg"],
            row["courier_order_sum"], row["courier_reward_sum"],
        )
        for row in ledger
    }
    # c1: average 4.5 of 200 in total -> floor 175; c2: average 5 of 100 -> floor 200
    assert found == {
        "c1": (2023, 3, 2, 5, Decimal("175.00000"), Decimal("185.25000")),
        "c2": (2023, 3, 1, 5, Decimal("200.00000"), Decimal("190.00000")),
    }


def test_second_run_changes_nothing(loaded):
    run, _ = loaded
    before = {name: sorted(map(repr, run.table(name).collect())) for name in TABLES}
    results = {result.table: result for result in run.everything()}
    after = {name: sorted(map(repr, run.table(name).collect())) for name in TABLES}
    assert before == after
    assert results["stg.bonussystem_events"].received == 0
    assert results["stg.ordersystem_orders"].received == 0


def test_loads_are_recorded(loaded):
    run, results = loaded
    recorded = run.store.loads().collect()
    assert {row["table"] for row in recorded} == set(results)
    assert len(results) == 20


def test_changed_order_is_picked_up_and_keeps_its_id(loaded, spark):
    run, _ = loaded
    before = dict(rows(run.table("dds.dm_orders"), "order_key", "id"))
    later = dt.datetime(2023, 3, 20)
    change = order("o3", "CLOSED", "r2", "u1", "2023-03-11 09:00:00", later)
    new = order("o7", "CLOSED", "r2", "u1", "2023-03-11 09:00:00", later)
    again = Run(
        run.store,
        {**run.sources, "orders": spark.createDataFrame([change, new], ORDER_ROW)},
        SETTINGS,
    )
    assert again.load_orders().loaded == 2
    again.load(LOADS["dds.dm_orders"])
    after = dict(rows(run.table("dds.dm_orders"), "order_key", "id"))
    assert after["o3"] == before["o3"]
    assert after["o7"] == max(before.values()) + 1
    status = run.table("dds.dm_orders").filter("order_key = 'o3'").first()["order_status"]
    assert status == "CLOSED"


def test_abort_refuses_the_batch(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.create(["dds.dm_deliveries"])
    batch = spark.createDataFrame(
        [("d1", 1, None, 1)],
        "delivery_id string, timestamp_id bigint, courier_id bigint, order_id bigint",
    )
    with pytest.raises(RejectedRows, match="null: courier_id"):
        store.upsert("dds.dm_deliveries", batch, on_fail="abort")
    assert store.read("dds.dm_deliveries").count() == 0


def test_number_forms_in_payments(spark):
    events = spark.createDataFrame(
        [
            (1, UPDATED, "bonus_transaction",
             payment("o1", ("p1", '"1.234565"', "2.0", "0.1", "7.9"), ("p2", "3", '"4"', "0", "-7.9"))),
        ],
        OUTBOX_ROW,
    )
    found = facts.payments(staging.bonus_events(events))
    assert rows(found, "product_source_id", "price", "count", "bonus_payment", "bonus_grant") == [
        ("p1", Decimal("1.23457"), 2, Decimal("0.10000"), Decimal("7.00000")),
        ("p2", Decimal("3.00000"), 4, Decimal("0.00000"), Decimal("-7.00000")),
    ]


def test_bad_date_is_rejected_not_lost(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.create(["dds.dm_timestamps"])
    staged = staging.order_documents(
        spark.createDataFrame([order("o1", "CLOSED", "r1", "u1", "not a date")], ORDER_ROW)
    )
    empty = spark.createDataFrame(
        [], "object_id string, object_value string, update_ts timestamp_ntz"
    )
    result = store.upsert(
        "dds.dm_timestamps", dimensions.timestamps(staged, empty), distinct=True
    )
    assert (result.loaded, result.rejected) == (0, 1)
    assert "null: ts" in store.rejected("dds.dm_timestamps").first()["reasons"]


def test_counts_of_every_load_add_up(loaded):
    _, results = loaded
    for result in results.values() if isinstance(results, dict) else results:
        total = result.rejected + result.loaded + result.superseded + result.skipped
        assert result.received == total, result


def test_documents_without_rows_are_set_aside(spark, tmp_path):
    """Broken payloads, menus and moments: refused with a reason, none lost."""
    store = Store(spark, str(tmp_path))
    store.create()
    good = payment("o1", ("p1", "10", "1", "0", "1"))
    outbox = [
        (1, UPDATED, "bonus_transaction", good),
        (2, UPDATED, "bonus_transaction", '{"order_id": "o1", "product_payments": "none"}'),
        (3, UPDATED, "bonus_transaction", '{"product_payments": []}'),
        (4, UPDATED, "bonus_transaction", "{"),
        (5, UPDATED, "bonus_transaction", '{"order_id": "o1", "product_payments": []}'),
    ]
    deliveries = [
        ("o1", "t", f"d{k}", "c1", "street", time, 5, Decimal(1), Decimal(0))
        for k, time in enumerate(("2023-03-30 10:00:00", "soon", None, "2022-01-01 10:00:00"))
    ]
    given = {
        **sources(spark),
        "outbox": spark.createDataFrame(outbox, OUTBOX_ROW),
        "order_restaurants": spark.createDataFrame(
            [("r1", "R", None, UPDATED), ("r2", "S", [], UPDATED)], RESTAURANT_ROW
        ),
        "orders": spark.createDataFrame([order("o1", "CLOSED", "r1", "u1", "some day")], ORDER_ROW),
        "api_deliveries": spark.createDataFrame(deliveries, DELIVERY_ROW),
    }
    run = Run(store, given, SETTINGS)
    staged = run.load_outbox()
    assert (staged.received, staged.rejected, staged.loaded) == (5, 1, 4)
    arrived = run.load_api_deliveries()
    assert (arrived.received, arrived.rejected, arrived.skipped) == (4, 2, 1) and arrived.loaded == 1
    run.load_order_restaurants()
    run.load_orders()
    wanted = {
        "dds.dm_products": [("r1", "array: menu")],
        "dds.dm_orders": [("o1", "time: date")],
        "dds.fct_product_sales": [("2", "array: product_payments"), ("3", "null: order_id")],
    }
    for name, found in wanted.items():
        result = run.load(LOADS[name])
        assert result.rejected == result.received == len(found)
        refused = store.rejected_documents(name)
        assert [(key, reasons[0]) for key, reasons in rows(refused, "source_key", "reasons")] == found


def test_first_load_looks_back_without_limit(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.create(["stg.deliverysystem_deliveries"])
    old = [("o1", "t", "d1", "c1", "street", "2020-01-01 10:00:00", 5, Decimal(1), Decimal(0))]
    run = Run(store, sources(spark, old), replace(SETTINGS, days=None))
    assert run.load_api_deliveries().loaded == 1
    assert Run(store, sources(spark, old), SETTINGS).load_api_deliveries().skipped == 1


def test_quoted_fraction_is_refused(spark):
    event = payment("o1", ("p1", "1", "1", "0", '"1.9"'), ("p2", "1", "1", "0", '" 2 "'), ("p3", "1", "1", "0", "1.9"))
    events = spark.createDataFrame([(1, UPDATED, "bonus_transaction", event)], OUTBOX_ROW)
    found = facts.payments(staging.bonus_events(events))
    assert rows(found, "product_source_id", "bonus_grant") == [("p1", None), ("p2", Decimal(2)), ("p3", Decimal(1))]
