"""Marts from increments: equal to the mart of the whole facts, whatever changed, and untouched where nothing did."""

import datetime as dt
import random
import re
import shutil
from dataclasses import replace

import pytest
from marketplace import SETTINGS

from larder.operators import quality
from larder.plans import marts
from larder.plans.rollups import DELIVERED, LEDGER, REPORT, SETTLED
from larder.plans.runs import LOADS, Run
from larder.sources.store import Store

ORDERS, SALES, DELIVERIES = "dds.dm_orders", "dds.fct_product_sales", "dds.fct_deliveries"
RESTAURANTS, TIMESTAMPS = "dds.dm_restaurants", "dds.dm_timestamps"
EVER, ENDED, SOON = dt.datetime(2099, 12, 31), dt.datetime(2023, 1, 1), dt.datetime(2023, 6, 1)
TABLES_USED = [RESTAURANTS, TIMESTAMPS, ORDERS, SALES, DELIVERIES, REPORT, LEDGER, "stg.srv_wf_settings"]
ROWS = {
    RESTAURANTS: "restaurant_id string, restaurant_name string, active_from timestamp_ntz, active_to timestamp_ntz",
    ORDERS: "order_key string, order_status string, user_id bigint, restaurant_id bigint, timestamp_id bigint",
    SALES: "product_id bigint, order_id bigint, count int, price decimal(19,5), total_sum decimal(19,5),"
    " bonus_payment decimal(19,5), bonus_grant decimal(19,5)",
    DELIVERIES: "delivery_id bigint, order_id bigint, courier_id bigint, address string, rate int,"
    " order_sum decimal(14,5), tip_sum decimal(14,5)",
}


class Shop:
    def __init__(self, spark, root):
        self.spark, self.store = spark, Store(spark, root, span=4, parts=2)
        self.settings = replace(SETTINGS, bounds={"ledger_year_after": 2021})

    def open(self):
        self.store.create(TABLES_USED)
        from larder.functions.calendar import calendar_parts

        moments = [(dt.datetime(2023, 1 + k % 2, 5 + k),) for k in range(4)]
        self.store.upsert(TIMESTAMPS, calendar_parts(self.spark.createDataFrame(moments, "ts timestamp_ntz")), distinct=True)
        ends = (EVER, EVER, ENDED, ENDED, SOON)
        self.put(RESTAURANTS, [(f"r{k}", f"R{k}", ENDED, end) for k, end in enumerate(ends)])

    def put(self, name, rows):
        whole = re.sub(r"decimal\([^)]*\)", "bigint", ROWS[name])
        self.store.upsert(name, quality.conform(self.spark.createDataFrame(rows, whole), _table(name).columns), foreign=False)

    def load(self, full=False, **settings):
        run = Run(self.store, {}, replace(self.settings, **settings))
        return {name: run.load(LOADS[name], full) for name in (REPORT, LEDGER)}

    def whole(self):
        read = self.store.read
        report = marts.settlement_report(read(ORDERS), read(SALES), read(TIMESTAMPS), read(RESTAURANTS), self.settings.as_of)
        ledger = marts.courier_ledger(read(DELIVERIES), read(ORDERS), read(TIMESTAMPS))
        return [found(quality.validate(rows, name, bounds=self.settings.bounds)[0]) for name, rows in ((REPORT, report), (LEDGER, ledger))]

    def marts(self):
        return [found(self.store.read(name).drop("id")) for name in (REPORT, LEDGER)]


def found(rows):
    return sorted(tuple(row) for row in rows.select(*sorted(rows.columns)).collect())


def sale(product, order, total):
    return (product, order, 1, total, total, 1, 0)


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("marts")
    shop = Shop(spark, str(root))
    shop.open()
    shop.put(ORDERS, [(f"o{k}", "CLOSED" if k % 5 else "COOKING", 1, k % 5 + 1, k % 4 + 1) for k in range(10)])
    shop.put(SALES, [sale(p, o, 10 * o + p) for o in range(1, 9) for p in range(o % 3)])
    shop.put(DELIVERIES, [(k, k, k % 3, "a", k % 5 + 1, 100 * k, k) for k in range(1, 11)])
    shop.load()
    return root


@pytest.fixture
def shop(spark, warehouse, tmp_path):
    """A copy of the loaded warehouse."""
    shutil.copytree(warehouse, tmp_path / "copy")
    return Shop(spark, str(tmp_path / "copy"))


def test_a_first_load_is_the_whole_mart(shop):
    assert shop.marts() == shop.whole()
    assert all(shop.marts())


def test_changed_moved_and_late_rows_give_the_mart_of_all(shop):
    shop.put(ORDERS, [("o1", "CLOSED", 1, 1, 4), ("o2", "COOKING", 1, 3, 3), ("o0", "CLOSED", 1, 2, 1)])  # other day, reopened, closed
    shop.put(SALES, [sale(0, 1, 99), sale(7, 4, 5), sale(8, 20, 5)])  # changed, late, of an order that is not there
    shop.put(DELIVERIES, [(1, 1, 2, "a", 1, 100, 1), (2, 5, 2, "a", 3, 200, 2), (12, 3, 1, "a", 5, 7, 1)])  # courier, order, new
    shop.load()
    assert shop.marts() == shop.whole()


def test_a_day_that_is_left_goes_and_one_that_is_refused_too(shop):
    days = {(row["restaurant_id"], row["settlement_date"]) for row in shop.store.read(REPORT).collect()}
    lone = shop.store.read(SETTLED.images).filter("with_sales = 1 AND restaurant_id = 2").first()
    key = shop.store.read(ORDERS).filter(f"id = {lone['order_id']}").first()["order_key"]
    shop.put(ORDERS, [(key, "CANCELLED", 1, 2, 1)])
    shop.put(SALES, [(0, 3, 1, 1, 1, 50, 0), *[(p, 3, 1, 1, 1, 50, 0) for p in (1, 2)]])  # more bonus than was paid
    shop.load()
    assert shop.marts() == shop.whole()
    assert ("2", lone["date"]) in days
    assert ("2", lone["date"]) not in {(row["restaurant_id"], row["settlement_date"]) for row in shop.store.read(REPORT).collect()}


def test_nothing_is_read_when_nothing_is_new(shop, monkeypatch):
    def refuse(self, table, *_, **__):
        assert not table.name.startswith(("dds.", "sum.", "cdm.")), table.name
        return plain(self, table, *_, **__)

    plain = Store._read
    monkeypatch.setattr(Store, "_read", refuse)
    assert [result.received for result in shop.load().values()] == [0, 0]


def test_only_touched_buckets_are_written_and_read(shop, monkeypatch):
    store, asked = shop.store, []
    before = {name: store.last_commit(_table(name)).buckets for name in (REPORT, SETTLED.totals, DELIVERED.totals)}
    plain = Store._read

    def watch(self, table, commit, only=None, kind="buckets"):
        if table.name == SALES:
            asked.append((only, len(commit.buckets)))
        return plain(self, table, commit, only, kind)

    shop.put(SALES, [sale(0, 2, 77)])
    monkeypatch.setattr(Store, "_read", watch)
    shop.load()
    assert asked and all(only is not None and len(only) < filled for only, filled in asked)
    for name, buckets in before.items():
        now = store.last_commit(_table(name)).buckets
        moved = [item for item, version in buckets.items() if now[item] != version]
        assert len(moved) == (name != DELIVERED.totals)
        assert name == REPORT or set(now) == set(buckets)


def _table(name):
    from larder.schemas import ALL_TABLES

    return ALL_TABLES[name]


def test_a_restaurant_whose_time_ends_keeps_its_rows_and_one_that_comes_gets_them(shop):
    before = shop.marts()[0]
    shop.load(as_of="2023-07-01 00:00:00")
    assert shop.marts()[0] == before
    shop.put(RESTAURANTS, [("r2", "New name", ENDED, EVER)])
    shop.settings = replace(shop.settings, as_of="2023-07-01 00:00:00")
    shop.load()
    kept = {row for row in before if "R4" in row}
    assert set(shop.marts()[0]) == set(shop.whole()[0]) | kept
    assert any("New name" in row for row in shop.marts()[0])


def test_a_load_that_broke_off_starts_anew(shop, monkeypatch):
    shop.put(SALES, [sale(0, 2, 77)])
    shop.put(DELIVERIES, [(1, 1, 2, "a", 1, 555, 1)])
    plain = Store.upsert

    def fail(self, name, *args, **kwargs):
        if name in (SETTLED.totals, LEDGER):
            raise OSError("gone")
        return plain(self, name, *args, **kwargs)

    for name in (REPORT, LEDGER):
        with monkeypatch.context() as patch:
            patch.setattr(Store, "upsert", fail)
            with pytest.raises(OSError):
                Run(shop.store, {}, shop.settings).load(LOADS[name])
    shop.load()
    assert shop.marts() == shop.whole()


def test_many_increments_end_as_one(shop):
    dice = random.Random(3)
    for _ in range(3):
        orders = dice.sample(range(12), 5)
        shop.put(ORDERS, [(f"o{k}", dice.choice(("CLOSED", "CLOSED", "COOKING")), 1, dice.randint(1, 5), dice.randint(1, 4)) for k in orders])
        lines = {(dice.randint(1, 3), dice.randint(1, 12)) for _ in range(6)}
        shop.put(SALES, [sale(p, o, dice.randint(1, 90)) for p, o in sorted(lines)])
        known = shop.store.read(ORDERS).count()
        shop.put(DELIVERIES, [(k, dice.randint(1, known), dice.randint(1, 3), "a", dice.randint(1, 5), 100, 1) for k in dice.sample(range(9), 4)])
        shop.load()
        assert shop.marts() == shop.whole()
