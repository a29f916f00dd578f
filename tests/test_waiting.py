"""Documents that wait for a parent: found by the new key, read once, let go afterwards."""

import datetime as dt
import shutil

import pytest
from marketplace import ORDER_ROW, SETTINGS, USER_ROW, order, sources

from larder.plans.runs import LOADS, Run
from larder.sources.store import Store

ORDERS, USERS = "dds.dm_orders", "dds.dm_users"
STAGED = "stg.ordersystem_orders"
LATER = dt.datetime(2023, 3, 20)
STEPS = (USERS, "dds.dm_restaurants", "dds.dm_timestamps", ORDERS)


def rows(df, *columns):
    return sorted(tuple(row) for row in df.select(*columns).collect())


def load(run):
    run.load_bonus_users(), run.load_order_users(), run.load_order_restaurants(), run.load_orders()
    return {name: run.load(LOADS[name]) for name in STEPS}


TABLES_USED = [
    "stg.bonussystem_users", "stg.ordersystem_users", "stg.ordersystem_restaurants", STAGED,
    "stg.deliverysystem_deliveries", "stg.srv_wf_settings", *STEPS,
]


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("loaded")
    store = Store(spark, str(root), span=3, parts=2)
    store.create(TABLES_USED)
    load(Run(store, sources(spark), SETTINGS))
    return root


@pytest.fixture
def run(spark, warehouse, tmp_path):
    """A copy of the loaded warehouse."""
    shutil.copytree(warehouse, tmp_path / "copy")
    return Run(Store(spark, str(tmp_path / "copy"), span=3, parts=2), sources(spark), SETTINGS)


def again(run, **changed):
    return Run(run.store, {**run.sources, **changed}, SETTINGS)


def test_what_lacks_a_parent_waits_for_the_first_one(run):
    assert rows(run.table("wait.dm_users"), "object_id", "parent_key") == [("u9", "u9")]
    assert rows(run.table("wait.dm_orders"), "object_id", "parent", "parent_key") == [
        ("o4", "dds.dm_timestamps", "2023-03-12 08:00:00"),  # unfinished: its moment is not kept
        ("o6", USERS, "u9"),
    ]


def test_nothing_is_read_when_nothing_is_new(run, monkeypatch):
    read = []
    plain = Store._read

    def watch(self, table, commit, only=None, kind="buckets"):
        read.append(table.name)
        return plain(self, table, commit, only, kind)

    monkeypatch.setattr(Store, "_read", watch)
    for name in (USERS, ORDERS):
        assert run.load(LOADS[name]).received == 0
    assert not [name for name in read if name.startswith(("stg.order", "stg.bonus", "dds.dm", "wait."))]


def test_a_late_account_wakes_its_user_and_the_users_orders(run, spark, monkeypatch):
    touched = []
    plain = Store.with_ids

    def watch(self, name, ids, at=None):
        touched.append((name, sorted(row["id"] for row in ids.select("id").collect())))
        return plain(self, name, ids, at)

    account = spark.createDataFrame([(4, "u9")], "id int, order_user_id string")
    staged = dict(rows(run.table(STAGED), "object_id", "id"))
    monkeypatch.setattr(Store, "with_ids", watch)
    results = load(again(run, users=account))
    assert results[USERS].loaded == 1
    assert results[ORDERS].received == 1 and results[ORDERS].loaded == 1
    assert (STAGED, [staged["o6"]]) in touched  # of the staged orders this one alone was asked for
    assert ("o6",) in rows(run.table(ORDERS), "order_key")
    assert rows(run.table("wait.dm_users"), "object_id") == []
    assert rows(run.table("wait.dm_orders"), "object_id") == [("o4",)]


def test_a_document_that_changes_waits_anew(run, spark):
    moved = [order("o6", "CLOSED", "r9", "u9", "2023-03-12 10:00:00", LATER), order("o8", "CLOSED", None, "u1", "2023-03-12 10:00:00", LATER)]
    load(again(run, orders=spark.createDataFrame(moved, ORDER_ROW)))
    # Still the user first; an order that names no restaurant can never be complete as it is.
    assert rows(run.table("wait.dm_orders"), "object_id", "parent_key") == [("o4", "2023-03-12 08:00:00"), ("o6", "u9")]
    late = spark.createDataFrame([(4, "u9")], "id int, order_user_id string")
    load(again(run, users=late))
    assert rows(run.table("wait.dm_orders"), "object_id", "parent_key") == [("o4", "2023-03-12 08:00:00"), ("o6", "r9")]
    fixed = [order("o6", "CLOSED", "r1", "u9", "2023-03-12 10:00:00", dt.datetime(2023, 3, 21))]
    load(again(run, orders=spark.createDataFrame(fixed, ORDER_ROW)))
    assert ("o6",) in rows(run.table(ORDERS), "order_key")


def test_a_failure_before_the_state_is_kept_loses_nothing(run, spark, monkeypatch):
    account = spark.createDataFrame([(4, "u9")], "id int, order_user_id string")
    late = again(run, users=account)
    late.load_bonus_users()
    with monkeypatch.context() as patch:
        patch.setattr("larder.plans.waiting.keep", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            late.load(LOADS[USERS])
    assert late.load(LOADS[USERS]).received == 1
    assert late.load(LOADS[ORDERS]).loaded == 1


def test_a_reader_keeps_its_commit_while_the_source_goes_on(run, spark):
    from larder.schemas import TABLES

    held = run.store.last_commit(TABLES[USERS])
    for k in range(3):
        change = spark.createDataFrame([("u1", f"name {k}", "l", dt.datetime(2023, 4, 1 + k))], USER_ROW)
        late = again(run, order_users=change)
        late.load_order_users(), late.load(LOADS[USERS])
    assert run.store.last_commit(TABLES[USERS]).version > held.version + 2
    assert run.store.changed_since(USERS, held.version, held).count() == 0


def test_a_warehouse_without_the_table_finds_all_that_wait(run, spark):
    from larder.session import delete_folder

    delete_folder(spark, f"{run.store.root}/commits/wait.dm_orders")
    account = spark.createDataFrame([(4, "u9")], "id int, order_user_id string")
    load(again(run, users=account))
    assert ("o6",) in rows(run.table(ORDERS), "order_key")
    assert rows(run.table("wait.dm_orders"), "object_id") == [("o4",)]


def test_removed_rows_leave_table_and_index(run, spark):
    store = run.store
    keys = spark.createDataFrame([("o1",), ("o2",), ("o3",), ("nothing",)], "order_key string")
    kept = [r for r in rows(run.table(ORDERS), "id", "order_key") if r[1] not in ("o1", "o2", "o3")]
    assert store.remove(ORDERS, keys) == 3
    assert rows(store.read(ORDERS), "id", "order_key") == kept
    assert store.remove(ORDERS, keys) == 0
    highest = max(r[0] for r in kept)
    run.load(LOADS[ORDERS], full=True)
    assert min(r[0] for r in rows(store.read(ORDERS), "id", "order_key") if r not in kept) > highest - 4
    store.remove(ORDERS, store.read(ORDERS).select("order_key"))
    assert store.empty(ORDERS) and store.read(ORDERS).count() == 0
