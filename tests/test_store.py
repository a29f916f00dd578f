import datetime as dt
import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from larder.operators.quality import RejectedRows
from larder.schemas import TABLES
from larder.sources import store as store_module
from larder.sources.state import ID, TS, LoadState
from larder.sources.store import SecondWriter, Store
from larder.streaming.increments import landed_page_stream, landing_stream, stream_upsert

USERS = "dds.dm_users"
USER = "user_id string, user_name string, user_login string"
EVENTS = "stg.bonussystem_events"
EVENT = "id int, event_ts timestamp_ntz, event_type string, event_value string"
AT = dt.datetime(2024, 1, 1)


def rows(df, *columns):
    return sorted(tuple(row) for row in (df.select(*columns) if columns else df).collect())


@pytest.fixture
def store(spark, tmp_path):
    made = Store(spark, str(tmp_path), span=10)
    made.create([USERS, EVENTS, "stg.srv_wf_settings", "stg.deliverysystem_couriers"])
    return made


def users(spark, *found):
    return spark.createDataFrame([(key, name, "l") for key, name in found], USER)


def test_set_based_conflict_refuses_everything(spark, store):
    store.upsert(USERS, users(spark, ("a", "1"), ("b", "1")))
    before = rows(store.read(USERS))
    with pytest.raises(RejectedRows, match="duplicate key: user_id"):
        store.upsert(USERS, users(spark, ("b", "2"), ("b", "3"), ("c", "1")), on_fail="abort")
    assert rows(store.read(USERS)) == before
    result = store.upsert(USERS, users(spark, ("b", "2"), ("b", "3"), ("c", "1")))
    assert (result.received, result.rejected, result.loaded) == (3, 2, 1)
    assert rows(store.rejected(USERS), "user_id", "user_name") == [("b", "2"), ("b", "3")]
    assert rows(store.read(USERS), "id", "user_id") == [(1, "a"), (2, "b"), (3, "c")]


def test_failed_write_leaves_the_old_version_and_can_be_repeated(spark, store, monkeypatch):
    store.upsert(USERS, users(spark, ("a", "1")), order=["user_name"])
    before = rows(store.read(USERS))

    def crash(*_):
        raise OSError("executor and driver are gone")

    with monkeypatch.context() as patch:
        patch.setattr(Store, "_commit", crash)
        with pytest.raises(OSError):
            store.upsert(USERS, users(spark, ("a", "2"), ("b", "1")), order=["user_name"])
    assert rows(store.read(USERS)) == before
    store.upsert(USERS, users(spark, ("a", "2"), ("b", "1")), order=["user_name"])
    assert rows(store.read(USERS), "id", "user_name") == [(1, "2"), (2, "1")]


def test_untouched_ranges_are_not_rewritten(spark, store):
    old = spark.createDataFrame([(1, AT, "t", "{}"), (11, AT, "t", "{}")], EVENT)
    store.upsert(EVENTS, old, order=["event_ts"])
    new = spark.createDataFrame([(1, AT, "t", "{}"), (12, AT, "t", "{}")], EVENT)
    result = store.upsert(EVENTS, new, order=["event_ts"])
    assert (result.loaded, result.changed) == (2, 1)
    assert store.last_commit(TABLES[EVENTS]).buckets == {0: 1, 1: 2}
    assert store.read(EVENTS).count() == 3


def test_matching_reads_the_index_parts_of_the_keys_alone(spark, store, monkeypatch):
    store.upsert(USERS, users(spark, *[(f"u{i:03d}", "1") for i in range(200)]))
    read = []
    plain = Store._read

    def watch(self, table, commit, only=None, kind="buckets"):
        frame = plain(self, table, commit, only, kind)
        read.append((kind, None if only is None else len(set(only)), frame.columns))
        return frame

    monkeypatch.setattr(Store, "_read", watch)
    assert store.upsert(USERS, users(spark, ("u007", "1"))).changed == 0
    assert read == [("keys", 1, ["user_id", "id", "row_hash"])]
    read.clear()
    assert store.upsert(USERS, users(spark, ("u007", "2"))).changed == 1
    assert [(kind, n) for kind, n, _ in read] == [("keys", 1), ("buckets", 1), ("keys", 1)]


def test_old_versions_go_and_saves_take_constant_time(spark, store):
    import os

    state = LoadState(store)
    for k in range(12):
        state.save("outbox", ID, k)
    table = TABLES["stg.srv_wf_settings"]
    assert state.get("outbox", ID) == 11 and store.last_commit(table).version == 12
    assert sorted(n for n in os.listdir(store._commits_path(table)) if n[0] != ".") == [
        f"{v:012d}.json" for v in (11, 12)
    ]
    assert len(os.listdir(store._data_path(table))) == 2
    # the version before the last can still be read
    before = store._read_commit(table, 11)
    assert store._read(table, before).count() == 1


def test_second_writer_is_refused(spark, store):
    store.upsert(USERS, users(spark, ("a", "1")))
    other = Store(spark, store.root)
    last = store.last_commit(TABLES[USERS])
    other.upsert(USERS, users(spark, ("b", "1")))
    with pytest.raises(SecondWriter):
        store._commit(TABLES[USERS], replace(last, version=last.version + 1))
    assert rows(store.read(USERS), "user_id") == [("a",), ("b",)]


def test_orphans_are_rejected(spark, store):
    store.create(["dds.dm_restaurants", "dds.dm_products"])
    end = dt.datetime(2099, 12, 31)
    place = "restaurant_id string, restaurant_name string, active_from timestamp_ntz, active_to timestamp_ntz"
    store.upsert("dds.dm_restaurants", spark.createDataFrame([("r", "R", AT, end)], place))
    kind = (
        "restaurant_id bigint, product_id string, product_name string, product_price double,"
        " active_from timestamp_ntz, active_to timestamp_ntz"
    )
    products = spark.createDataFrame([(1, "p", "P", 1.0, AT, end), (9, "q", "Q", 1.0, AT, end)], kind)
    result = store.upsert("dds.dm_products", products)
    assert (result.received, result.loaded, result.rejected) == (2, 1, 1)
    (bad,) = store.rejected("dds.dm_products").collect()
    assert bad["product_id"] == "q" and bad["reasons"] == ["foreign key: restaurant_id -> dds.dm_restaurants"]


def test_counts_add_up(spark, store):
    late = dt.datetime(2023, 1, 1)
    batch = spark.createDataFrame(
        [(1, AT, "t", "{}"), (1, late, "t", "{}"), (2, AT, "t", "{"), (3, AT, None, "{}"), (4, AT, "t", "[1]")], EVENT
    )
    result = store.upsert(EVENTS, batch, order=["event_ts"])
    assert (result.received, result.rejected, result.superseded, result.loaded) == (5, 2, 1, 2)
    reasons = {row["id"]: row["reasons"] for row in store.rejected(EVENTS).collect()}
    assert reasons == {2: ["json: event_value"], 3: ["null: event_type"]}


def test_late_rows_do_not_replace_newer_ones(spark, store):
    store.create(["stg.ordersystem_users"])
    kind = "object_id string, object_value string, update_ts timestamp_ntz"
    late = dt.datetime(2023, 1, 1)

    def put(newest, *found):
        return store.upsert(
            "stg.ordersystem_users", spark.createDataFrame(list(found), kind), order=["update_ts"], newest=newest
        )

    put(True, ("a", "1", AT), ("b", "1", late))
    result = put(True, ("a", "2", late), ("b", "2", AT))
    assert (result.received, result.loaded, result.superseded, result.changed) == (2, 1, 1, 1)
    assert rows(store.read("stg.ordersystem_users"), "object_id", "object_value") == [("a", "1"), ("b", "2")]
    put(False, ("a", "2", late))
    assert rows(store.read("stg.ordersystem_users"), "object_id", "object_value") == [("a", "2"), ("b", "2")]


def test_only_changed_rows_are_written(spark, store):
    everyone = [(f"u{i:02d}", "1") for i in range(40)]
    store.upsert(USERS, users(spark, *everyone))
    assert store.last_commit(TABLES[USERS]).buckets == {0: 1, 1: 1, 2: 1, 3: 1, 4: 1}
    assert store.upsert(USERS, users(spark, *everyone)).changed == 0
    assert store.last_commit(TABLES[USERS]).version == 1
    result = store.upsert(USERS, users(spark, ("u24", "2"), *everyone[25:], ("u99", "1")))
    assert (result.loaded, result.changed) == (17, 2)
    assert store.last_commit(TABLES[USERS]).buckets == {0: 1, 1: 1, 2: 2, 3: 1, 4: 2}
    found = store.read(USERS)
    assert sorted(row["id"] for row in found.collect()) == list(range(1, 42))
    assert rows(found.filter("user_name = '2'"), "id", "user_id") == [(25, "u24")]


def test_empty_batch_changes_nothing(spark, store):
    before = store.last_commit(TABLES[EVENTS])
    result = store.upsert(EVENTS, spark.createDataFrame([], EVENT), order=["event_ts"])
    assert (result.received, result.rejected, result.loaded, result.changed) == (0, 0, 0, 0)
    assert store.last_commit(TABLES[EVENTS]) == before


def test_span_stays_with_the_table(spark, store):
    store.upsert(USERS, users(spark, *[(f"u{i}", "1") for i in range(20)]))
    other = Store(spark, store.root, span=7)
    other.upsert(USERS, users(spark, *[(f"u{i}", "2") for i in range(10, 30)]))
    found = other.read(USERS)
    assert found.count() == 30
    assert rows(found.groupBy("user_name").count()) == [("1", 10), ("2", 20)]
    assert sorted(row["id"] for row in found.collect()) == list(range(1, 31))


def test_pinned_frames_are_removed(spark, store):
    import os

    from larder.session import session_folder

    folder = session_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.exists(folder) else set()
    store.upsert(USERS, users(spark, ("a", "1")))
    assert set(os.listdir(folder)) == before


def test_load_state(spark, store):
    state = LoadState(store)
    assert state.get("outbox", ID) == -1
    assert state.get("orders", TS) == "1900-01-01T00:00:00"
    batch = spark.createDataFrame([(3, AT, "t", "{}"), (7, AT, "t", "{}")], EVENT)
    loaded = store.upsert(EVENTS, batch, order=["event_ts"], watermark="id")
    state.advance("outbox", ID, loaded.watermark)
    state.save("orders", TS, "2024-01-01 00:00:00")
    nothing = store.upsert(EVENTS, batch.filter("id > 10"), order=["event_ts"], watermark="id")
    assert nothing.watermark is None
    state.advance("outbox", ID, nothing.watermark)
    assert state.get("outbox", ID) == 7
    assert state.get("orders", TS) == "2024-01-01 00:00:00"
    kept = {row["workflow_key"]: json.loads(row["workflow_settings"])
            for row in store.read("stg.srv_wf_settings").collect()}
    assert kept == {"outbox": {ID: 7}, "orders": {TS: "2024-01-01 00:00:00"}}


def test_lost_state_is_harmless(spark, store):
    """A crash between the data and the state only reads the same rows again."""
    batch = spark.createDataFrame([(3, AT, "t", "{}"), (7, AT, "t", "{}")], EVENT)
    store.upsert(EVENTS, batch, order=["event_ts"])
    before = rows(store.read(EVENTS))
    store.upsert(EVENTS, batch, order=["event_ts"])
    assert rows(store.read(EVENTS)) == before


def test_watermark_is_that_of_the_rows_read(spark, store, tmp_path):
    """Rows that arrive while a load is running are left to the next one."""
    source = str(tmp_path / "outbox")
    first = spark.createDataFrame([(1, AT, "t", "{}")], EVENT)
    first.write.parquet(source)
    batch = spark.read.schema(EVENT).parquet(source)
    result = store.upsert(EVENTS, batch, order=["event_ts"], watermark="id")
    late = spark.createDataFrame([(2, AT, "t", "{}")], EVENT)
    late.write.mode("append").parquet(source)
    assert result.watermark == "1"
    fresh = spark.read.schema(EVENT).parquet(source).filter("id > 1")
    assert store.upsert(EVENTS, fresh, order=["event_ts"], watermark="id").watermark == "2"


def test_stream_reads_every_file_once(spark, store, tmp_path):
    landing, position = str(tmp_path / "landing"), str(tmp_path / "position")
    row = f"{EVENT}, arrival int"

    def land(arrival, *found):
        spark.createDataFrame([(*event, arrival) for event in found], row).coalesce(1) \
            .write.mode("append").parquet(landing)

    def run():
        stream = landing_stream(spark, landing, row, files_per_batch=1)
        query = stream_upsert(stream, store, EVENTS, ["arrival"], position)
        query.awaitTermination()
        return sum(progress["numInputRows"] for progress in query.recentProgress)

    land(1, (1, AT, "draft", "{}"), (2, AT, "draft", "{}"))
    assert run() == 2
    land(2, (2, AT, "final", "{}"), (3, AT, "final", "{}"))
    assert run() == 2
    assert run() == 0
    assert rows(store.read(EVENTS), "id", "event_type") == [
        (1, "draft"), (2, "final"), (3, "final")
    ]


def test_stream_of_landed_pages(spark, store, tmp_path):
    from larder.plans.staging import named_documents

    landing = tmp_path / "pages"
    landing.mkdir()
    (landing / "0.json").write_text('[{"_id": "c1", "name": "Иван"}, {"_id": "c2", "name": "B"}]',
                                    encoding="utf-8")
    stream = landed_page_stream(spark, str(landing), "_id string, name string")
    stream_upsert(
        stream, store, "stg.deliverysystem_couriers", ["object_value"], str(tmp_path / "position"),
        stage=lambda batch: named_documents(batch, "2024-01-01 00:00:00"),
    ).awaitTermination()
    found = store.read("stg.deliverysystem_couriers")
    names = found.select(F.get_json_object("object_value", "$.name").alias("n"))
    assert rows(names) == [("B",), ("Иван",)]


def test_rows_are_kept_once_on_their_way_and_hashes_not_at_all(spark, store, monkeypatch):
    kept, pin = [], store_module.pin
    monkeypatch.setattr(store_module, "pin", lambda df: kept.append(df.columns) or pin(df))
    first = [(f"u{n}", f"name {n}") for n in range(50)]
    store.upsert(USERS, users(spark, *first), order=["user_login"])
    assert len(kept) == 1  # the rows with their reasons; numbering writes them in the order of their keys
    second = [("u7", "other"), ("u8", "name 8"), ("u99", "new")]
    result = store.upsert(USERS, users(spark, *second), order=["user_login"])
    assert (result.loaded, result.changed) == (3, 2)
    assert len(kept) == 3 and not any(store_module.HASH in columns for columns in kept)
    found = {row["user_id"]: (row["id"], row["user_name"]) for row in store.read(USERS).collect()}
    assert len(found) == 51 and found["u7"][1] == "other" and found["u8"][1] == "name 8" and found["u99"] == (51, "new")
    assert sorted(id for id, _ in found.values()) == list(range(1, 52))
    assert store.upsert(USERS, users(spark, *second), order=["user_login"]).changed == 0


def _shuffle_bytes(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).length() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_"))


def _many(spark, n, name):
    return spark.range(n).select(F.format_string("u%06d", "id").alias("user_id"), name.alias("user_name"), F.sha2(F.col("id").cast("string"), 256).alias("user_login"))


def test_an_upsert_leaves_no_shuffle_files_and_lets_go_of_what_it_has_read(spark, tmp_path, monkeypatch):
    import os

    from larder import session

    store = Store(spark, str(tmp_path), span=1000, parts=2)
    store.create([USERS])
    on_disk, laid_out = [], Store._laid_out

    def watch(self, *args, **kwargs):
        on_disk.append(len(os.listdir(session._scratch.get())))
        return laid_out(self, *args, **kwargs)

    monkeypatch.setattr(Store, "_laid_out", watch)
    before = _shuffle_bytes(spark)
    store.upsert(USERS, _many(spark, 3000, F.lit("a")), order=["user_login"])
    third = F.when(F.col("id") % 3 == 0, F.lit("b")).otherwise(F.lit("a"))
    result = store.upsert(USERS, _many(spark, 4000, third), order=["user_login"])
    assert (result.loaded, result.changed) == (4000, 2000)
    assert on_disk == [1, 2]  # the numbered rows; the new and changed rows, and the new ones with numbers
    assert _shuffle_bytes(spark) - before < 50_000  # counts per bucket; the rows themselves take 100,000 and more at a time


def test_large_merges_in_several_passes_give_the_same_table(spark, tmp_path, monkeypatch):
    def change(row):
        return F.when(F.col("id") % 4 == row, F.lit("b")).otherwise(F.lit("a"))

    found = []
    for size in (store_module.PASS_BYTES, 1):
        monkeypatch.setattr(store_module, "PASS_BYTES", size)
        read, plain = [], Store._read

        def watch(self, table, commit, only=None, kind="buckets"):
            if table.name == USERS and only is not None:
                read.append((kind, len(set(only))))
            return plain(self, table, commit, only, kind)

        store = Store(spark, str(tmp_path / str(size)), span=10, parts=4)
        store.create([USERS])
        store.upsert(USERS, _many(spark, 45, F.lit("a")))
        with monkeypatch.context() as patch:
            patch.setattr(Store, "_read", watch)
            result = store.upsert(USERS, _many(spark, 60, change(1)))
        assert (result.loaded, result.changed) == (60, 26)
        assert {n for _, n in read} == ({1} if size == 1 else {4, 6, 7} & {n for _, n in read})
        assert store.upsert(USERS, _many(spark, 60, change(1))).changed == 0
        assert store.remove(USERS, _many(spark, 60, change(1)).filter("user_name = 'b'").select("user_id")) == 15
        found.append((rows(store.read(USERS)), rows(store.with_keys(USERS, _many(spark, 60, F.lit("a"))), "id", "user_id"), store.last_commit(TABLES[USERS]).max_id))
    assert found[0] == found[1] and len(found[0][0]) == len(found[0][1]) == 45


def test_tables_with_longer_hashes_take_equal_rows_as_equal(spark, store, monkeypatch):
    with monkeypatch.context() as patch:
        patch.setattr(store_module, "HASH_BYTES", 32)
        store.upsert(USERS, users(spark, ("a", "1"), ("b", "1")))
    result = store.upsert(USERS, users(spark, ("a", "1"), ("b", "2")))
    assert (result.loaded, result.changed) == (2, 1)
    index = store._read(TABLES[USERS], store.last_commit(TABLES[USERS]), kind="keys")
    assert [len(row["row_hash"]) for row in index.orderBy("user_id").collect()][1] == 16


def test_lanes_that_remove_shuffle_files_leave_the_setting_as_it_was(spark):
    from larder.session import CLEANUP_SETTING, shuffles_removed

    before = spark.conf.get(CLEANUP_SETTING, None)
    first, second = shuffles_removed(spark), shuffles_removed(spark)
    first.__enter__(), second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(CLEANUP_SETTING) == "true"  # the second lane is still inside
    second.__exit__(None, None, None)
    assert spark.conf.get(CLEANUP_SETTING, None) == before
