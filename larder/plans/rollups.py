"""The marts from what has changed: kept sums per group, and the rows of the groups that differ.

A load returns the mart rows to merge and the keys of rows to remove, or
nothing if no table it reads was written.  Groups that hold no order any more
lose their row.  Rows of a restaurant that is no longer active stay as they
were reported last.
"""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.operators.lookup import active_at
from larder.operators.rollup import Rollup, fold
from larder.plans import marts
from larder.plans.facts import CLOSED
from larder.session import pin

if TYPE_CHECKING:
    from larder.plans.runs import View

ORDERS, SALES, DELIVERIES = "dds.dm_orders", "dds.fct_product_sales", "dds.fct_deliveries"
RESTAURANTS, TIMESTAMPS = "dds.dm_restaurants", "dds.dm_timestamps"
REPORT, LEDGER = "cdm.dm_settlement_report", "cdm.dm_courier_ledger"

SETTLED = Rollup(
    "sum.settlement_orders",
    "sum.settlement_days",
    ("restaurant_id", "date"),
    ("orders", "with_sales", "total", "payment", "granted"),
)
DELIVERED = Rollup(
    "sum.courier_deliveries",
    "sum.courier_months",
    ("courier_id", "year", "month"),
    ("orders", "rated", "rate_sum", "total", "tips"),
)


def settlement(view: View) -> tuple[DataFrame, DataFrame] | None:
    """Report rows of the restaurants' days that differ, and of restaurants that changed or became active.

    A day with orders of restaurants that are not active has one row without a
    restaurant, which the rules set aside; it is made again, from all of them,
    when one of their groups on that day differs.
    """
    store, as_of = view.run.store, view.settings.as_of
    view.carry_on((SETTLED.images, SETTLED.totals), (ORDERS, SALES, RESTAURANTS))
    turned = _turned(view)
    if turned is None and view.same(ORDERS, SALES):
        return None
    restaurants = view.table(RESTAURANTS)
    active = active_at(restaurants, as_of).select(F.col("id").alias("restaurant_id"))
    groups = store.read(SETTLED.totals).limit(0)
    if not view.same(ORDERS, SALES):
        groups = fold(store, SETTLED, pin(_settled_orders(view))).select(*SETTLED.group, *SETTLED.sums)
    days = store.read(SETTLED.totals).select(*SETTLED.group, *SETTLED.sums)
    chosen = groups.filter("orders > 0").select(*days.columns)
    gone = groups.filter("orders = 0").select(*SETTLED.group)
    if view.full:
        keys = store.read(REPORT).select(F.col("restaurant_id").cast("bigint"), F.col("settlement_date").alias("date"))
        gone = keys.join(days, list(SETTLED.group), "left_anti")
    else:
        nameless = pin(chosen.join(active, "restaurant_id", "left_anti").select("date").distinct())
        if not nameless.isEmpty():
            chosen = chosen.unionByName(days.join(active, "restaurant_id", "left_anti").join(nameless, "date", "left_semi").select(*days.columns))
        if turned is not None:
            now = turned.join(active, "restaurant_id", "left_semi")
            chosen = chosen.unionByName(days.join(now, "restaurant_id", "left_semi").select(*days.columns))
        chosen = chosen.dropDuplicates(list(SETTLED.group))
    sold = F.col("with_sales") > 0
    by_day = chosen.select(
        *SETTLED.group,
        F.col("with_sales").alias("n"),
        *[F.when(sold, F.col(name)).alias(name) for name in ("total", "payment", "granted")],
    )
    return marts.report_rows(by_day, restaurants, as_of), gone.select(
        F.col("restaurant_id").cast("string").alias("restaurant_id"), F.col("date").alias("settlement_date")
    )


def _turned(view: View) -> DataFrame | None:
    """Restaurants that changed, or became active or inactive as time went on; ``None`` if there can be none."""
    before, now = view.moment("as of", view.settings.as_of), view.settings.as_of
    if view.same(RESTAURANTS) and before == now:
        return None
    changed = view.changed(RESTAURANTS).select("id")
    if before != now:
        end = F.col("active_to")
        then, today = (F.lit(at).cast("timestamp_ntz") for at in (before, now))
        changed = changed.union(view.table(RESTAURANTS).filter((end > then) != (end > today)).select("id"))
    return changed.distinct().select(F.col("id").alias("restaurant_id"))


def _settled_orders(view: View) -> DataFrame:
    """Per touched order its restaurant, day and sums; an order that is not closed counts nothing.

    Touched are orders that changed and those of changed sales.  The other
    sales of a touched order are found by the buckets in which its image says
    they are: a row never leaves its bucket.
    """
    store, sales_at = view.run.store, view.read[SALES]
    if view.full:
        orders, sales = view.table(ORDERS), view.table(SALES)
    else:
        fresh = pin(view.changed(SALES).select("order_id", store.bucket(SALES, sales_at).alias("bucket")))
        touched = pin(view.changed(ORDERS).select(F.col("id").alias("order_id")).union(fresh.select("order_id")).distinct())
        counted = store.with_keys(SETTLED.images, touched).select(F.explode("sale_buckets").alias("bucket"))
        buckets = fresh.select("bucket").union(counted).distinct().collect()  # at most one row per bucket
        sales = store.read(SALES, sales_at, only={row["bucket"] for row in buckets})
        sales = sales.join(touched, "order_id", "left_semi")
        orders = store.with_ids(ORDERS, touched.select(F.col("order_id").alias("id")), view.read[ORDERS])
    per_order = sales.groupBy("order_id").agg(
        F.sum("total_sum").alias("total"),
        F.sum("bonus_payment").alias("payment"),
        F.sum("bonus_grant").alias("granted"),
        F.array_sort(F.collect_set(store.bucket(SALES, sales_at))).alias("sale_buckets"),
    )
    days = view.table(TIMESTAMPS).select(F.col("id").alias("timestamp_id"), "date")
    closed = F.col("order_status") == CLOSED
    sold = closed & F.col("sale_buckets").isNotNull()
    rows = (
        orders.select(F.col("id").alias("order_id"), "order_status", "restaurant_id", "timestamp_id")
        .join(per_order, "order_id", "left")
        .join(days, "timestamp_id", "left")
    )
    return rows.select(
        "order_id",
        "restaurant_id",
        "date",
        closed.cast("bigint").alias("orders"),
        sold.cast("bigint").alias("with_sales"),
        *[F.when(sold, F.col(name)).otherwise(0).cast("decimal(29,5)").alias(name) for name in ("total", "payment", "granted")],
        F.coalesce("sale_buckets", F.array().cast("array<bigint>")).alias("sale_buckets"),
    )


def ledger(view: View) -> tuple[DataFrame, DataFrame] | None:
    """Ledger rows of the couriers' months that differ; the tiers are applied to the new sums."""
    store = view.run.store
    view.carry_on((DELIVERED.images, DELIVERED.totals), (DELIVERIES, ORDERS))
    if view.same(DELIVERIES, ORDERS):
        return None
    groups = fold(store, DELIVERED, pin(_delivered(view)))
    totals = groups.filter("orders > 0").select(
        *DELIVERED.group,
        F.col("orders").alias("order_count"),
        "total",
        F.when(F.col("rated") > 0, F.col("rate_sum").cast("double") / F.col("rated")).alias("rate_avg"),
        "tips",
    )
    names = {"courier_id": "string", "year": "int", "month": "int"}
    gone = groups.filter("orders = 0")
    if view.full:
        mart = store.read(LEDGER).select(
            F.col("courier_id").cast("bigint"), F.col("settlement_year").alias("year"), F.col("settlement_month").alias("month")
        )
        gone = mart.join(groups, list(DELIVERED.group), "left_anti")
    keys = [F.col(name).cast(kind).alias(f"settlement_{name}" if kind == "int" else name) for name, kind in names.items()]
    return marts.ledger_rows(totals), gone.select(*keys)


def _delivered(view: View) -> DataFrame:
    """Per touched delivery its courier, the month of its order and its amounts.

    Touched are deliveries that changed and those of changed orders, which are
    looked for in one narrow column of the images.
    """
    store, at = view.run.store, view.read[DELIVERIES]
    orders, facts = view.table(ORDERS), view.changed(DELIVERIES)
    if not view.full:
        if not view.same(ORDERS):
            moved = view.changed(ORDERS).select(F.col("id").alias("order_id"))
            counted = store.read(DELIVERED.images).join(moved, "order_id", "left_semi").select("delivery_id")
            others = store.with_keys(DELIVERIES, counted, at)
            facts = facts.unionByName(others.join(facts.select("delivery_id"), "delivery_id", "left_anti").select(*facts.columns))
        facts = pin(facts)
        orders = store.with_ids(ORDERS, facts.select(F.col("order_id").alias("id")).distinct(), view.read[ORDERS])
    moments = orders.select(F.col("id").alias("order_id"), "timestamp_id")
    months = view.table(TIMESTAMPS).select(F.col("id").alias("timestamp_id"), "year", "month")
    rate = F.col("rate").cast("bigint")
    return (
        facts.join(moments, "order_id", "left")
        .join(months, "timestamp_id", "left")
        .select(
            "delivery_id",
            "order_id",
            "courier_id",
            "year",
            "month",
            F.lit(1).cast("bigint").alias("orders"),
            rate.isNotNull().cast("bigint").alias("rated"),
            F.coalesce(rate, F.lit(0)).alias("rate_sum"),
            F.col("order_sum").cast("decimal(29,5)").alias("total"),
            F.col("tip_sum").cast("decimal(29,5)").alias("tips"),
        )
    )
