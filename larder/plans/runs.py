"""One run of the warehouse: every load, in the order its inputs become ready."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from datetime import date
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.documents import documents_with, moment
from larder.operators import quality
from larder.plans import dimensions, facts, rollups, staging, waiting
from larder.plans.waiting import DOCUMENT_ID, Reference, Waiting, due
from larder.schemas import ALL_TABLES, TABLES
from larder.session import pin, scratch
from larder.sources.readers import after_id, after_ts, lookback
from larder.sources.state import ID, TS, LoadState
from larder.sources.store import Commit, LoadResult, Store


@dataclass(frozen=True)
class RunSettings:
    """What the clock and the operator decide; fixed for one run.

    ``bounds`` overrides limits of the table rules, ``on_fail`` is ``abort`` to
    refuse a batch with a broken rule instead of setting its rows aside.
    ``days`` is how far back deliveries are asked for: whole days before the
    run date, ``None`` for all, as after a pause or for a first load.
    """

    load_ts: str
    run_date: date
    as_of: str
    on_fail: str = "quarantine"
    match_restaurant: bool = False
    bounds: Mapping = field(default_factory=dict)
    days: int | None = 7


@dataclass(frozen=True)
class Load:
    """A batch for one table and how it is merged.

    ``broken`` are the documents that the batch has no rows of although they
    should give some.  With ``waiting``, ``look_up`` joins documents with their
    parents and ``rows`` makes the batch of what was found; the documents read
    are those that changed or whose parent has come, see ``plans/waiting.py``.
    ``roll_up`` gives the rows of groups that differ and the keys of rows to
    remove, see ``plans/rollups.py``; a group that the rules refuse now loses
    the row it had.
    """

    target: str
    build: Callable[["View"], DataFrame] | None = None
    order: tuple[str, ...] | None = None
    distinct: bool = False
    broken: Callable[["View"], DataFrame] | None = None
    waiting: Waiting | None = None
    look_up: Callable[["View", DataFrame], DataFrame] | None = None
    rows: Callable[[DataFrame], DataFrame] | None = None
    roll_up: Callable[["View"], tuple[DataFrame, DataFrame] | None] | None = None


class View:
    """What one load reads: whole tables, or what has changed in them since the load read them last."""

    def __init__(self, run: "Run", target: str, full: bool):
        self.run, self.target, self.full = run, target, full
        self.settings = run.settings
        self.read: dict[str, Commit] = {}
        self.since: dict[str, int] = {}
        self.own: tuple[str, ...] = ()
        self.moments: dict[str, str] = {}

    def table(self, name: str) -> DataFrame:
        return self.run.store.read(name, self.read.get(name))

    def _workflow(self, name: str) -> str:
        return f"{self.target} from {name}"

    def look(self, *names: str) -> None:
        """Fix up to which commit tables are read, and find up to which they were read before."""
        names = [name for name in names if name not in self.read]
        if names:
            self.read |= {name: self.run.store.last_commit(ALL_TABLES[name]) for name in names}
            found = self.run.state.get_all([self._workflow(name) for name in names], ID)
            self.since |= {name: -1 if self.full else found[self._workflow(name)] for name in names}

    def same(self, *names: str) -> bool:
        """Whether nothing was written to the tables since the last load of the target."""
        self.look(*names)
        return all(self.read[name].version == self.since[name] for name in names)

    def carry_on(self, own: Sequence[str], sources: Sequence[str]) -> None:
        """Go on from the tables the load itself has written, or start them anew.

        They are as the load left them if their versions are those it kept
        last; if not, a load broke off between two of them.  They start anew
        too if a source did.
        """
        store = self.run.store
        whole = all(store.exists(ALL_TABLES[name]) for name in own)
        if whole:
            self.look(*own, *sources)
            whole = self.same(*own) and all(self.read[name].created <= self.since[name] for name in sources)
        if not whole:
            store.create(own)
            self.full, self.read, self.since = True, {}, {}
            self.look(*sources)
        self.own = tuple(own)

    def moment(self, what: str, now: str) -> str:
        """The moment the last load of the target went by; the next one finds ``now``."""
        workflow = f"{self.target} {what}"
        before = self.run.state.get(workflow, TS)
        if before != now:
            self.moments[workflow] = now
        return before

    def changed(self, name: str) -> DataFrame:
        """Rows that are new or different since the last load of the target."""
        self.look(name)
        return self.run.store.changed_since(name, self.since[name], self.read[name])

    def due(self, waiting: Waiting) -> DataFrame | None:
        """Documents that changed or whose parent has come, ``None`` if there are none."""
        store = self.run.store
        if not store.exists(ALL_TABLES[waiting.table]):  # a warehouse from before: find all that wait
            store.create([waiting.table])
            self.full = True
        self.look(waiting.staged, *[one.parent for one in waiting.references])
        changed = None if self.same(waiting.staged) else self.changed(waiting.staged)
        if self.full or store.empty(waiting.table):
            return changed
        return due(store, waiting, self.since, self.read, changed)

    def done(self) -> None:
        """Keep up to which versions the load has read."""
        self.read |= {name: self.run.store.last_commit(ALL_TABLES[name]) for name in self.own}
        self.since = {**dict.fromkeys(self.own, -1), **self.since}
        if self.moments:
            self.run.state.save_all(self.moments, TS)
        moved = {self._workflow(n): c.version for n, c in self.read.items() if c.version != self.since[n]}
        if moved:
            self.run.state.save_all(moved, ID)


class Run:
    """Loads the layers of one store from source frames.

    ``sources`` maps ``ranks users outbox`` (bonus system), ``order_users
    order_restaurants orders`` (order system) and ``api_restaurants
    api_couriers api_deliveries`` (delivery service) to frames with the columns
    of those sources.
    """

    def __init__(self, store: Store, sources: Mapping[str, DataFrame], settings: RunSettings):
        self.store = store
        self.sources = sources
        self.settings = settings
        self.state = LoadState(store)

    def table(self, name: str) -> DataFrame:
        return self.store.read(name)

    # -- staging --------------------------------------------------------------

    def _stage(
        self, target: str, batch: DataFrame, order: list[str], watermark: str | None = None
    ) -> LoadResult:
        return self.store.upsert(
            target, batch, order=order, on_fail=self.settings.on_fail, watermark=watermark
        )

    def _stage_snapshot(
        self, source: str, target: str, workflow: str, make: Callable
    ) -> LoadResult:
        batch = make(self.sources[source])
        result = self._stage(target, batch, list(batch.columns))
        self.state.save(workflow, TS, self.settings.load_ts)
        return result

    def load_ranks(self) -> LoadResult:
        return self._stage_snapshot(
            "ranks", "stg.bonussystem_ranks", "bonus_system_ranks", staging.bonus_ranks
        )

    def load_bonus_users(self) -> LoadResult:
        return self._stage_snapshot(
            "users", "stg.bonussystem_users", "bonus_system_users", staging.bonus_users
        )

    def load_outbox(self) -> LoadResult:
        workflow = "bonus_system_outbox"
        fresh = after_id(self.sources["outbox"], self.state.get(workflow, ID))
        batch = staging.bonus_events(fresh)
        order = ["event_ts", "event_value", "event_type"]
        result = self._stage("stg.bonussystem_events", batch, order, "id")
        self.state.advance(workflow, ID, result.watermark)
        return result

    def _stage_changed(
        self, source: str, target: str, workflow: str, make: Callable
    ) -> LoadResult:
        fresh = after_ts(self.sources[source], self.state.get(workflow, TS))
        result = self._stage(target, make(fresh), ["update_ts", "object_value"], "update_ts")
        self.state.advance(workflow, TS, result.watermark)
        return result

    def load_order_restaurants(self) -> LoadResult:
        return self._stage_changed(
            "order_restaurants",
            "stg.ordersystem_restaurants",
            "order_system_restaurants",
            staging.restaurant_documents,
        )

    def load_order_users(self) -> LoadResult:
        return self._stage_changed(
            "order_users", "stg.ordersystem_users", "order_system_users", staging.user_documents
        )

    def load_orders(self) -> LoadResult:
        return self._stage_changed(
            "orders", "stg.ordersystem_orders", "order_system_orders", staging.order_documents
        )

    def load_api_restaurants(self) -> LoadResult:
        batch = staging.named_documents(self.sources["api_restaurants"], self.settings.load_ts)
        return self._stage("stg.deliverysystem_restaurants", batch, ["object_value"])

    def load_api_couriers(self) -> LoadResult:
        batch = staging.named_documents(self.sources["api_couriers"], self.settings.load_ts)
        return self._stage("stg.deliverysystem_couriers", batch, ["object_value"])

    def load_api_deliveries(self) -> LoadResult:
        """Deliveries of the last days (see ``RunSettings.days``); the latest one of an order wins.

        A delivery without a readable time is set aside, one outside of the
        days is counted as skipped.
        """
        rows = self.sources["api_deliveries"].withColumn("_at", moment("delivery_ts"))
        unread = staging.delivery_documents(rows.filter("_at IS NULL"), self.settings.load_ts)
        recent = rows.filter("_at IS NOT NULL")
        skipped = 0
        if self.settings.days is not None:
            chosen = lookback(recent, "_at", self.settings.run_date, self.settings.days)
            skipped, recent = recent.count() - chosen.count(), chosen
        batch = staging.delivery_documents(recent, self.settings.load_ts)
        ordered = batch.withColumn(
            "delivery_ts", moment(F.get_json_object("object_value", "$.delivery_ts"))
        ).withColumn("delivery_id", F.get_json_object("object_value", "$.delivery_id"))
        result = self.store.upsert(
            "stg.deliverysystem_deliveries",
            ordered,
            order=["delivery_ts", "delivery_id"],
            on_fail=self.settings.on_fail,
            broken=documents_with(unread, "object_id", "object_value", "time: delivery_ts"),
        )
        return replace(result, received=result.received + skipped, skipped=skipped)

    def stage(self) -> list[LoadResult]:
        """The three source systems side by side, the loads of each in turn."""
        return together(
            [self.load_ranks, self.load_bonus_users, self.load_outbox],
            [self.load_order_restaurants, self.load_order_users, self.load_orders],
            [self.load_api_restaurants, self.load_api_couriers, self.load_api_deliveries],
        )

    # -- dimensions, facts, marts ---------------------------------------------

    def load(self, load: Load, full: bool = False) -> LoadResult:
        """One load; dimensions read the staged documents that have changed, with ``full`` all of them."""
        view = View(self, load.target, full)
        with scratch(self.store.spark):
            return self._load(load, view)

    def _load(self, load: Load, view: View) -> LoadResult:
        found = None
        if load.roll_up:
            return self._roll_up(load, view)
        if load.waiting:
            documents = view.due(load.waiting)
            if documents is None:
                view.done()
                return LoadResult(load.target, 0, 0, 0, 0)
            found = pin(load.look_up(view, documents))
        result = self.store.upsert(
            load.target,
            load.rows(found) if load.waiting else load.build(view),
            order=list(load.order) if load.order else None,
            distinct=load.distinct,
            on_fail=self.settings.on_fail,
            bounds=dict(self.settings.bounds),
            broken=load.broken(view) if load.broken else None,
            foreign=False,  # the keys come from lookups in the parents
        )
        if load.waiting:
            waiting.keep(self.store, load.waiting, found)
        view.done()
        return result

    def _roll_up(self, load: Load, view: View) -> LoadResult:
        due, result = load.roll_up(view), LoadResult(load.target, 0, 0, 0, 0)
        if due is not None:
            rows, gone = pin(due[0]), due[1]
            _, refused = quality.validate(rows, load.target, bounds=dict(self.settings.bounds))
            if self.settings.on_fail == "abort":
                quality.refuse(refused, load.target)
            if not self.store.empty(load.target):
                self.store.remove(load.target, gone.unionByName(refused.select(*gone.columns)))
            result = self.store.upsert(
                load.target, rows, on_fail=self.settings.on_fail, bounds=dict(self.settings.bounds), foreign=False
            )
        view.done()
        return result

    def everything(self, full: bool = False) -> list[LoadResult]:
        """All loads, each after the tables it reads; row counts are kept in the store."""
        results = self.stage()
        for step in STEPS:
            results += together(*[[partial(self.load, LOADS[name], full)] for name in step])
        self.store.record(results, self.settings.load_ts)
        return results


def together(*lanes: list[Callable[[], LoadResult]]) -> list[LoadResult]:
    """Run lanes at the same time, so that small loads share the cluster."""
    with ThreadPoolExecutor(len(lanes)) as pool:
        running = [pool.submit(lambda lane=lane: [job() for job in lane]) for lane in lanes]
        return [result for lane in running for result in lane.result()]


# Loads of one step read only tables of earlier steps.
STEPS = (
    ("dds.dm_users", "dds.dm_restaurants", "dds.dm_timestamps", "dds.dm_couriers"),
    ("dds.dm_products", "dds.dm_orders"),
    ("dds.dm_deliveries", "dds.fct_product_sales"),
    ("dds.fct_deliveries", "cdm.dm_settlement_report"),
    ("cdm.dm_courier_ledger",),
)

_LOADS = (
    Load(
        "dds.dm_users",
        order=("update_ts",),
        waiting=Waiting(
            "stg.ordersystem_users",
            "wait.dm_users",
            (Reference("stg.bonussystem_users", "order_user_id", "user_id", "account"),),
        ),
        look_up=lambda run, documents: dimensions.users_and_accounts(
            documents, run.table("stg.bonussystem_users"), DOCUMENT_ID
        ),
        rows=lambda found: found.filter("account IS NOT NULL").select(
            "user_id", "user_name", "user_login", "update_ts"
        ),
    ),
    Load(
        "dds.dm_restaurants",
        lambda run: dimensions.restaurants(run.changed("stg.ordersystem_restaurants")),
        order=("active_from",),
    ),
    Load(
        "dds.dm_timestamps",
        lambda run: dimensions.timestamps(
            run.changed("stg.ordersystem_orders"), run.changed("stg.deliverysystem_deliveries")
        ),
        distinct=True,
    ),
    Load(
        "dds.dm_couriers",
        lambda run: dimensions.couriers(run.changed("stg.deliverysystem_couriers")),
        order=("active_from",),
    ),
    Load(
        "dds.dm_products",
        lambda run: dimensions.products(
            run.changed("stg.ordersystem_restaurants"), run.table("dds.dm_restaurants")
        ),
        broken=lambda run: dimensions.broken_menus(run.changed("stg.ordersystem_restaurants")),
    ),
    Load(
        "dds.dm_orders",
        waiting=Waiting(
            "stg.ordersystem_orders",
            "wait.dm_orders",
            (
                Reference("dds.dm_users", "user_id", "user_source_id", "user_id"),
                Reference("dds.dm_restaurants", "restaurant_id", "restaurant_source_id", "restaurant_id"),
                Reference("dds.dm_timestamps", "ts", "ts", "timestamp_id"),
            ),
        ),
        look_up=lambda run, documents: dimensions.orders_and_parents(
            documents,
            run.table("dds.dm_users"),
            run.table("dds.dm_restaurants"),
            run.table("dds.dm_timestamps"),
            DOCUMENT_ID,
        ),
        rows=dimensions.complete_orders,
        distinct=True,
        broken=lambda run: dimensions.broken_orders(run.changed("stg.ordersystem_orders")),
    ),
    Load(
        "dds.dm_deliveries",
        waiting=Waiting(
            "stg.deliverysystem_deliveries",
            "wait.dm_deliveries",
            (
                Reference("dds.dm_timestamps", "ts", "ts", "timestamp_id"),
                Reference("dds.dm_couriers", "courier_id", "courier_source_id", "courier_id"),
                Reference("dds.dm_orders", "order_key", "order_source_id", "order_id"),
            ),
        ),
        look_up=lambda run, documents: dimensions.deliveries_and_parents(
            documents,
            run.table("dds.dm_timestamps"),
            run.table("dds.dm_couriers"),
            run.table("dds.dm_orders"),
            DOCUMENT_ID,
        ),
        rows=lambda found: found.select(*dimensions.DELIVERY_ROW),  # the rules reject what lacks a parent
    ),
    Load(
        "dds.fct_product_sales",
        lambda run: facts.product_sales(
            run.table("stg.bonussystem_events"),
            run.table("dds.dm_products"),
            run.table("dds.dm_orders"),
            run.settings.match_restaurant,
        ),
        broken=lambda run: facts.broken_payments(run.table("stg.bonussystem_events")),
    ),
    Load(
        "dds.fct_deliveries",
        waiting=Waiting(
            "stg.deliverysystem_deliveries",
            "wait.fct_deliveries",
            (Reference("dds.dm_deliveries", "delivery_id", "delivery_source_id", "delivery_id"),),
        ),
        look_up=lambda run, documents: facts.named_deliveries(
            documents, run.table("dds.dm_deliveries"), DOCUMENT_ID
        ),
        rows=lambda found: found.drop("object_id", "staged_id", "delivery_source_id"),
    ),
    Load("cdm.dm_settlement_report", roll_up=rollups.settlement),
    Load("cdm.dm_courier_ledger", roll_up=rollups.ledger),
)

LOADS = {load.target: load for load in _LOADS}
