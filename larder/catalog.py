"""Every query over the test tables, each with an SQL statement of the same result."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder import demo, schemas
from larder.functions.calendar import calendar_parts
from larder.functions.documents import (
    document,
    moment,
    open_end,
    parsed,
    rounded_number,
    text,
    to_second,
    whole_number,
)
from larder.functions.money import tiered_pay
from larder.operators import merge, paging, quality
from larder.plans import dimensions, facts, marts
from larder.plans.runs import LOADS, Run, RunSettings
from larder.schemas import TABLES
from larder.session import pin, scratch_path
from larder.sources import readers, state
from larder.sources.store import Store
from larder.streaming.increments import landing_stream, stream_upsert

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


CATALOG: dict[str, Entry] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name together with its SQL."""

    def register(run: Query) -> Query:
        CATALOG[run.__name__] = Entry(run, sql.strip() if sql else None)
        return run

    return register


TEST_TABLES = (
    "region nation customer supplier part orders lineitem events"
    " documents embeddings pages benchmark labels conversations"
).split()

# Limits that fit the years of the test data.
REPORT_BOUNDS = {"settlement_after": "1995-06-30", "settlement_before": "2001-01-01"}
LEDGER_BOUNDS = {"ledger_year_after": 1995, "ledger_year_before": 2001}

# -- shared SQL ----------------------------------------------------------------

SUPPLIERS = "(SELECT count(*) FROM supplier)"

SALES = """
sales AS (
  SELECT l_orderkey AS order_id,
         CAST(CAST(l_quantity AS INTEGER) * CAST(l_extendedprice AS DECIMAL(14,2))
              AS DECIMAL(19,5)) AS total,
         CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(abs(l_discount) AS DECIMAL(4,2))
              AS DECIMAL(19,5)) AS payment,
         CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(abs(l_tax) AS DECIMAL(4,2))
              AS DECIMAL(19,5)) AS granted
  FROM lineitem)
"""


def settlement_sql(restaurants: str) -> str:
    return f"""
{SALES},
sums AS (
  SELECT r.s_suppkey AS rid, r.s_name AS restaurant_name,
         CAST(o.o_orderdate AS DATE) AS settlement_date,
         CAST(count(DISTINCT s.order_id) AS INTEGER) AS orders_count,
         CAST(sum(s.total) AS DECIMAL(29,5)) AS total,
         CAST(sum(s.payment) AS DECIMAL(29,5)) AS payment,
         CAST(sum(s.granted) AS DECIMAL(29,5)) AS granted
  FROM orders o
  LEFT JOIN sales s ON s.order_id = o.o_orderkey
  LEFT JOIN {restaurants} r ON r.s_suppkey = o.o_orderkey % {SUPPLIERS}
  WHERE o.o_orderstatus = 'F'
  GROUP BY 1, 2, 3),
report AS (
  SELECT CAST(rid AS VARCHAR) AS restaurant_id, restaurant_name, settlement_date, orders_count,
         CAST(total AS DECIMAL(14,2)) AS orders_total_sum,
         CAST(payment AS DECIMAL(14,2)) AS orders_bonus_payment_sum,
         CAST(granted AS DECIMAL(14,2)) AS orders_bonus_granted_sum,
         CAST(total * 0.25 AS DECIMAL(14,2)) AS order_processing_fee,
         CAST(total - total * 0.25 - payment AS DECIMAL(14,2)) AS restaurant_reward_sum
  FROM sums)
"""


NOT_IN_DEBT = "(SELECT * FROM supplier WHERE s_acctbal >= 0)"

REPORT_REASONS = """
concat_ws(', ',
  CASE WHEN restaurant_id IS NULL THEN 'null: restaurant_id' END,
  CASE WHEN restaurant_name IS NULL THEN 'null: restaurant_name' END,
  CASE WHEN orders_total_sum IS NULL THEN 'null: orders_total_sum' END,
  CASE WHEN orders_bonus_payment_sum IS NULL THEN 'null: orders_bonus_payment_sum' END,
  CASE WHEN orders_bonus_granted_sum IS NULL THEN 'null: orders_bonus_granted_sum' END,
  CASE WHEN order_processing_fee IS NULL THEN 'null: order_processing_fee' END,
  CASE WHEN restaurant_reward_sum IS NULL THEN 'null: restaurant_reward_sum' END,
  CASE WHEN NOT (settlement_date > DATE '1995-06-30' AND settlement_date < DATE '2001-01-01')
       THEN 'check: settlement_date_in_range' END,
  CASE WHEN restaurant_reward_sum < 0 THEN 'check: restaurant_reward_sum_not_negative' END)
"""

LEDGER = """
d AS (
  SELECT o_custkey AS courier_id, year(o_orderdate) AS y, month(o_orderdate) AS m,
         CAST(o_orderkey % 5 + 1 AS INTEGER) AS rate,
         CAST(CAST(o_totalprice AS DECIMAL(14,2)) * 0.01 AS DECIMAL(14,5)) AS order_sum,
         CAST(CAST(o_totalprice AS DECIMAL(14,2)) * 0.001 AS DECIMAL(14,5)) AS tip_sum
  FROM orders WHERE o_orderstatus = 'F'),
t AS (
  SELECT courier_id, y, m, count(*) AS n, CAST(sum(order_sum) AS DECIMAL(24,5)) AS total,
         avg(rate) AS rate_avg, CAST(sum(tip_sum) AS DECIMAL(24,5)) AS tips
  FROM d GROUP BY ALL),
p AS (
  SELECT *, CAST(CASE
    WHEN rate_avg < 4   THEN CASE WHEN total * 0.05 > 100 THEN total * 0.05 ELSE 100 END
    WHEN rate_avg < 4.5 THEN CASE WHEN total * 0.07 > 150 THEN total * 0.07 ELSE 150 END
    WHEN rate_avg < 4.9 THEN CASE WHEN total * 0.08 > 175 THEN total * 0.07 ELSE 175 END
    ELSE CASE WHEN total * 0.10 > 200 THEN total * 0.07 ELSE 200 END
  END AS DECIMAL(27,7)) AS pay FROM t)
"""

LEDGER_ROWS = f"""
WITH {LEDGER}
SELECT CAST(courier_id AS VARCHAR) AS courier_id,
       CAST(y AS INTEGER) AS settlement_year, CAST(m AS INTEGER) AS settlement_month,
       CAST(n AS INTEGER) AS order_count,
       CAST(total AS DECIMAL(14,5)) AS orders_total_sum,
       CAST(round(rate_avg) AS INTEGER) AS rate_avg,
       CAST(total * 0.25 AS DECIMAL(14,5)) AS order_processing_fee,
       CAST(pay AS DECIMAL(14,5)) AS courier_order_sum,
       CAST(tips AS DECIMAL(14,5)) AS courier_tips_sum,
       CAST((pay + tips) * 0.95 AS DECIMAL(14,5)) AS courier_reward_sum
FROM p
"""

DIM_USERS = """
dm_users AS (
  SELECT row_number() OVER (ORDER BY CAST(c_custkey AS VARCHAR)) AS id,
         CAST(c_custkey AS VARCHAR) AS user_id, c_name AS user_name, c_mktsegment AS user_login
  FROM customer WHERE c_custkey IN (SELECT user_id FROM events))
"""
DIM_RESTAURANTS = f"""
dm_restaurants AS (
  SELECT row_number() OVER (ORDER BY CAST(s_suppkey AS VARCHAR)) AS id,
         CAST(s_suppkey AS VARCHAR) AS restaurant_id, s_name AS restaurant_name,
         TIMESTAMP '{demo.LOAD_TS}' AS active_from, TIMESTAMP '2099-12-31 00:00:00' AS active_to
  FROM supplier)
"""
DIM_COURIERS = f"""
dm_couriers AS (
  SELECT row_number() OVER (ORDER BY CAST(c_custkey AS VARCHAR)) AS id,
         CAST(c_custkey AS VARCHAR) AS courier_id, c_name AS courier_name,
         TIMESTAMP '{demo.LOAD_TS}' AS active_from, TIMESTAMP '2099-12-31 00:00:00' AS active_to
  FROM customer)
"""
DIM_TIMESTAMPS = """
dm_timestamps AS (
  SELECT row_number() OVER (ORDER BY ts) AS id, ts FROM (
    SELECT o_orderdate AS ts FROM orders WHERE o_orderstatus IN ('F', 'P')
    UNION
    SELECT o_orderdate + INTERVAL 1 DAY FROM orders WHERE o_orderstatus = 'F'))
"""
DIM_PRODUCTS = f"""
dm_products AS (
  SELECT row_number() OVER (ORDER BY r.id, CAST(p.p_partkey AS VARCHAR)) AS id,
         r.id AS restaurant_id, CAST(p.p_partkey AS VARCHAR) AS product_id,
         p.p_name AS product_name, CAST(p.p_retailprice AS DECIMAL(14,2)) AS product_price,
         r.active_from, r.active_to
  FROM part p, range({demo.OFFERS}) AS s(step), dm_restaurants r
  WHERE r.restaurant_id = CAST((p.p_partkey + s.step) % {SUPPLIERS} AS VARCHAR))
"""
DIM_ORDERS = f"""
dm_orders AS (
  SELECT row_number() OVER (ORDER BY CAST(o.o_orderkey AS VARCHAR)) AS id,
         CAST(o.o_orderkey AS VARCHAR) AS order_key,
         CASE o.o_orderstatus WHEN 'F' THEN 'CLOSED' WHEN 'P' THEN 'CANCELLED'
              ELSE 'COOKING' END AS order_status,
         u.id AS user_id, r.id AS restaurant_id, t.id AS timestamp_id
  FROM orders o
  JOIN dm_users u ON u.user_id = CAST(o.o_custkey AS VARCHAR)
  JOIN dm_restaurants r ON r.restaurant_id = CAST(o.o_orderkey % {SUPPLIERS} AS VARCHAR)
  JOIN dm_timestamps t ON t.ts = o.o_orderdate)
"""
DIM_DELIVERIES = """
found_deliveries AS (
  SELECT 'd' || CAST(o.o_orderkey AS VARCHAR) AS delivery_id, t.id AS timestamp_id,
         c.id AS courier_id, k.id AS order_id
  FROM orders o
  LEFT JOIN dm_timestamps t ON t.ts = o.o_orderdate + INTERVAL 1 DAY
  LEFT JOIN dm_couriers c ON c.courier_id = CAST(o.o_custkey AS VARCHAR)
  LEFT JOIN dm_orders k ON k.order_key = CAST(o.o_orderkey AS VARCHAR)
  WHERE o.o_orderstatus = 'F'),
dm_deliveries AS (
  SELECT row_number() OVER (ORDER BY delivery_id) AS id, *
  FROM found_deliveries
  WHERE timestamp_id IS NOT NULL AND courier_id IS NOT NULL AND order_id IS NOT NULL)
"""
PAYMENTS = """
payments AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_source_id,
         CAST(l_partkey AS VARCHAR) AS product_source_id,
         CAST(l_quantity AS INTEGER) AS "count",
         CAST(CAST(l_extendedprice AS DECIMAL(14,2)) AS DECIMAL(19,5)) AS price,
         CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(abs(l_discount) AS DECIMAL(4,2))
              AS DECIMAL(19,5)) AS bonus_payment,
         CAST(trunc(CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(abs(l_tax) AS DECIMAL(4,2)))
              AS DECIMAL(19,5)) AS bonus_grant
  FROM lineitem WHERE l_returnflag <> 'R')
"""


def typed(df: DataFrame, name: str) -> DataFrame:
    """Rows in the types of their target table."""
    columns = {c: kind for c, kind in TABLES[name].columns.items() if c in df.columns}
    return quality.conform(df, columns).select(*columns)


def with_reasons(rejected: DataFrame) -> DataFrame:
    return rejected.withColumn(quality.REASONS, F.array_join(quality.REASONS, ", "))


# -- marts ---------------------------------------------------------------------


def _report(spark: SparkSession, sf_dir: str, restaurants: DataFrame) -> DataFrame:
    return marts.settlement_report(
        demo.orders(spark, sf_dir),
        demo.sales(spark, sf_dir),
        demo.timestamps(spark, sf_dir),
        restaurants,
        as_of=demo.AS_OF,
        closed_status=demo.CLOSED,
    )


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.courier_ledger(
        demo.deliveries(spark, sf_dir),
        demo.orders(spark, sf_dir),
        demo.timestamps(spark, sf_dir),
    )


@query(f"WITH {settlement_sql('supplier')} SELECT * FROM report")
def settlement_report(spark, sf_dir):
    report = _report(spark, sf_dir, demo.always_active(spark, sf_dir))
    return typed(report, "cdm.dm_settlement_report")


@query(f"WITH {settlement_sql(NOT_IN_DEBT)} SELECT * FROM report")
def settlement_active_only(spark, sf_dir):
    report = _report(spark, sf_dir, demo.restaurants(spark, sf_dir))
    return typed(report, "cdm.dm_settlement_report")


@query(f"WITH {settlement_sql(NOT_IN_DEBT)} SELECT * FROM report WHERE {REPORT_REASONS} = ''")
def settlement_valid(spark, sf_dir):
    report = _report(spark, sf_dir, demo.restaurants(spark, sf_dir))
    good, _ = quality.validate(report, "cdm.dm_settlement_report", bounds=REPORT_BOUNDS)
    return good


@query(
    f"WITH {settlement_sql(NOT_IN_DEBT)} SELECT *, {REPORT_REASONS} AS reasons"
    f" FROM report WHERE {REPORT_REASONS} <> ''"
)
def settlement_rejected(spark, sf_dir):
    report = _report(spark, sf_dir, demo.restaurants(spark, sf_dir))
    _, rejected = quality.validate(report, "cdm.dm_settlement_report", bounds=REPORT_BOUNDS)
    return with_reasons(rejected)


@query(LEDGER_ROWS)
def courier_ledger(spark, sf_dir):
    return typed(_ledger(spark, sf_dir), "cdm.dm_courier_ledger")


@query(f"SELECT * FROM ({LEDGER_ROWS}) WHERE settlement_year > 1995 AND settlement_year < 2001")
def courier_ledger_valid(spark, sf_dir):
    good, _ = quality.validate(
        _ledger(spark, sf_dir), "cdm.dm_courier_ledger", bounds=LEDGER_BOUNDS
    )
    return good


@query(
    f"SELECT courier_id, settlement_year, settlement_month,"
    f" 'check: settlement_year_in_range' AS reasons FROM ({LEDGER_ROWS})"
    f" WHERE settlement_year <= 1995 OR settlement_year >= 2001"
)
def courier_ledger_rejected(spark, sf_dir):
    _, rejected = quality.validate(
        _ledger(spark, sf_dir), "cdm.dm_courier_ledger", bounds=LEDGER_BOUNDS
    )
    return with_reasons(rejected).select(
        "courier_id", "settlement_year", "settlement_month", "reasons"
    )


@query(
    f"WITH {LEDGER} SELECT courier_id, CAST(y AS INTEGER) AS settlement_year,"
    f" CAST(m AS INTEGER) AS settlement_month, n AS order_count, rate_avg, pay FROM p"
)
def courier_tiers(spark, sf_dir):
    totals = marts.courier_totals(
        demo.deliveries(spark, sf_dir),
        demo.orders(spark, sf_dir),
        demo.timestamps(spark, sf_dir),
    )
    return totals.select(
        "courier_id",
        F.col("year").alias("settlement_year"),
        F.col("month").alias("settlement_month"),
        "order_count",
        "rate_avg",
        tiered_pay(F.col("rate_avg"), F.col("total")).alias("pay"),
    )


# -- dimensions ----------------------------------------------------------------


@query(f"WITH {DIM_USERS} SELECT * FROM dm_users")
def dim_users(spark, sf_dir):
    return demo.Market(spark, sf_dir).dm_users


@query(f"WITH {DIM_RESTAURANTS} SELECT * FROM dm_restaurants")
def dim_restaurants(spark, sf_dir):
    return demo.Market(spark, sf_dir).dm_restaurants


@query(f"WITH {DIM_COURIERS} SELECT * FROM dm_couriers")
def dim_couriers(spark, sf_dir):
    return demo.Market(spark, sf_dir).dm_couriers


@query("""
SELECT row_number() OVER (ORDER BY ts) AS id, ts, CAST(year(ts) AS INTEGER) AS year,
       CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
       strftime(ts, '%H:%M:%S') AS time, CAST(ts AS DATE) AS date
FROM (SELECT o_orderdate AS ts FROM orders WHERE o_orderstatus IN ('F', 'P')
      UNION
      SELECT CAST(date_trunc('second', ts) AS TIMESTAMP) FROM events)
""")
def dim_timestamps(spark, sf_dir):
    events = demo.table(spark, sf_dir, "events")
    arrivals = events.select(
        text("event_id").alias("object_id"),
        document(delivery_ts=text("ts")).alias("object_value"),
        F.col("ts").alias("update_ts"),
    )
    rows = dimensions.timestamps(demo.Market(spark, sf_dir).staged_orders, arrivals)
    return demo.numbered(rows, ["ts"])


@query(f"WITH {DIM_RESTAURANTS}, {DIM_PRODUCTS} SELECT * FROM dm_products")
def dim_products(spark, sf_dir):
    return demo.Market(spark, sf_dir).dm_products


@query(
    f"WITH {DIM_USERS}, {DIM_RESTAURANTS}, {DIM_TIMESTAMPS}, {DIM_ORDERS} SELECT * FROM dm_orders"
)
def dim_orders(spark, sf_dir):
    return demo.Market(spark, sf_dir).dm_orders


_DELIVERIES = (
    f"WITH {DIM_USERS}, {DIM_RESTAURANTS}, {DIM_TIMESTAMPS}, {DIM_ORDERS}, {DIM_COURIERS},"
    f" {DIM_DELIVERIES}"
)


@query(f"{_DELIVERIES} SELECT * FROM dm_deliveries")
def dim_deliveries(spark, sf_dir):
    return demo.Market(spark, sf_dir).dm_deliveries


@query(f"""
{_DELIVERIES}
SELECT 'timestamp_id' AS lookup, count_if(timestamp_id IS NULL)::BIGINT AS unresolved_rows
FROM found_deliveries
UNION ALL
SELECT 'courier_id', count_if(courier_id IS NULL)::BIGINT FROM found_deliveries
UNION ALL
SELECT 'order_id', count_if(order_id IS NULL)::BIGINT FROM found_deliveries
""")
def unresolved_deliveries(spark, sf_dir):
    found = demo.Market(spark, sf_dir).found_deliveries
    return quality.unresolved(found, ["timestamp_id", "courier_id", "order_id"])


# -- facts ---------------------------------------------------------------------

_SALES_CTES = (
    f"WITH {DIM_USERS}, {DIM_RESTAURANTS}, {DIM_TIMESTAMPS}, {DIM_ORDERS}, {DIM_PRODUCTS},"
    f" {PAYMENTS}"
)
_SALE_COLUMNS = (
    'p.id AS product_id, o.id AS order_id, s."count", s.price,'
    ' CAST(s."count" * s.price AS DECIMAL(19,5)) AS total_sum, s.bonus_payment, s.bonus_grant'
)


@query(f"""
{_SALES_CTES}
SELECT {_SALE_COLUMNS}
FROM payments s
JOIN dm_orders o ON o.order_key = s.order_source_id AND o.order_status = 'CLOSED'
JOIN dm_products p ON p.product_id = s.product_source_id
QUALIFY count(*) OVER (PARTITION BY p.id, o.id) > 1
""")
def fact_product_sales_conflicts(spark, sf_dir):
    """Sales whose order and product come several times; a load sets them aside."""
    market = demo.Market(spark, sf_dir)
    rows = facts.product_sales(market.staged_events, market.dm_products, market.dm_orders)
    batch = pin(typed(rows, "dds.fct_product_sales"))
    _, conflicts = merge.split_conflicts(batch, list(TABLES["dds.fct_product_sales"].key))
    return conflicts


@query(f"""
{_SALES_CTES}
SELECT {_SALE_COLUMNS}
FROM payments s
JOIN dm_orders o ON o.order_key = s.order_source_id AND o.order_status = 'CLOSED'
JOIN dm_products p ON p.product_id = s.product_source_id
QUALIFY count(*) OVER (PARTITION BY p.id, o.id) = 1
""")
def fact_product_sales(spark, sf_dir):
    return _unique_sales(demo.Market(spark, sf_dir))


@query(f"""
{_SALES_CTES}
SELECT {_SALE_COLUMNS}
FROM payments s
JOIN dm_orders o ON o.order_key = s.order_source_id AND o.order_status = 'CLOSED'
JOIN dm_products p ON p.product_id = s.product_source_id AND p.restaurant_id = o.restaurant_id
QUALIFY count(*) OVER (PARTITION BY p.id, o.id) = 1
""")
def fact_product_sales_matched(spark, sf_dir):
    return _unique_sales(demo.Market(spark, sf_dir), match_restaurant=True)


def _unique_sales(market: demo.Market, match_restaurant: bool = False) -> DataFrame:
    rows = facts.product_sales(
        market.staged_events, market.dm_products, market.dm_orders, match_restaurant
    )
    batch = pin(typed(rows, "dds.fct_product_sales"))
    good, _ = merge.split_conflicts(batch, list(TABLES["dds.fct_product_sales"].key))
    return good


@query(f"""
WITH {DIM_RESTAURANTS}, {DIM_PRODUCTS}, {PAYMENTS}
SELECT product_id, sale_lines, offers, sale_lines * offers AS matches
FROM (SELECT product_source_id, count(*) AS sale_lines FROM payments GROUP BY 1) s
JOIN (SELECT product_id, count(*) AS offers FROM dm_products GROUP BY 1) p
  ON p.product_id = s.product_source_id
""")
def fact_sales_fanout(spark, sf_dir):
    market = demo.Market(spark, sf_dir)
    offers = dimensions.products(market.staged_restaurants, market.dm_restaurants)
    return facts.sales_fanout(market.staged_events, offers)


@query(f"""
{_DELIVERIES}
SELECT k.id AS delivery_id, k.order_id, k.courier_id, o.o_orderpriority AS address,
       CAST(o.o_orderkey % 5 + 1 AS INTEGER) AS rate,
       CAST(CAST(o.o_totalprice AS DECIMAL(14,2)) * 0.01 AS DECIMAL(14,5)) AS order_sum,
       CAST(CAST(o.o_totalprice AS DECIMAL(14,2)) * 0.001 AS DECIMAL(14,5)) AS tip_sum
FROM orders o
LEFT JOIN dm_deliveries k ON k.delivery_id = 'd' || CAST(o.o_orderkey AS VARCHAR)
WHERE o.o_orderstatus = 'F'
""")
def fact_deliveries(spark, sf_dir):
    market = demo.Market(spark, sf_dir)
    rows = facts.deliveries(market.staged_deliveries, market.dm_deliveries)
    return typed(rows, "dds.fct_deliveries")


# -- reads ---------------------------------------------------------------------


@query("SELECT n_nationkey, n_name FROM nation")
def snapshot_load(spark, sf_dir):
    return readers.snapshot(demo.table(spark, sf_dir, "nation"), ["n_nationkey", "n_name"])


@query("""
SELECT event_id, ts, event_type, props FROM events
WHERE event_id > (SELECT max(event_id) FROM events WHERE ts < TIMESTAMP '2024-01-16')
""")
def increment_by_id(spark, sf_dir):
    events = demo.table(spark, sf_dir, "events")
    loaded = events.filter(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))
    watermark = state.batch_watermark(loaded, state.ID, "event_id").first()[0]
    return readers.after_id(events, int(watermark), "event_id").select(
        "event_id", "ts", "event_type", "props"
    )


@query("""
SELECT event_id, ts, event_type, props FROM events
WHERE ts > (SELECT max(ts) FROM events WHERE event_type = 'signup' AND ts < TIMESTAMP '2024-01-16')
""")
def increment_by_ts(spark, sf_dir):
    events = demo.table(spark, sf_dir, "events")
    loaded = events.filter(
        (F.col("event_type") == "signup")
        & (F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))
    )
    watermark = state.batch_watermark(loaded, state.TS, "ts").first()[0]
    return readers.after_ts(events, watermark, "ts").select(
        "event_id", "ts", "event_type", "props"
    )


@query("""
SELECT event_id, ts, event_type FROM events
WHERE ts >= TIMESTAMP '2024-01-13 00:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00'
""")
def lookback_window(spark, sf_dir):
    events = demo.table(spark, sf_dir, "events")
    return readers.lookback(events, "ts", dt.date(2024, 1, 20)).select(
        "event_id", "ts", "event_type"
    )


@query("""
SELECT p_partkey, p_name FROM part ORDER BY p_name, p_partkey LIMIT 50 OFFSET 100
""")
def page_slice(spark, sf_dir):
    parts = demo.table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return paging.page(parts, ["p_name", "p_partkey"], offset=100, limit=50)


@query("""
SELECT p_partkey, p_name, (n - 1) // 50 AS page_no, (n - 1) % 50 + 1 AS place
FROM (SELECT p_partkey, p_name, row_number() OVER (ORDER BY p_name, p_partkey) AS n FROM part)
""")
def pages_union(spark, sf_dir):
    """Pages of parts written as JSON arrays, one file each, and united by reading the folder."""
    parts = demo.table(spark, sf_dir, "part").select("p_partkey", "p_name")
    numbered = paging.pages(parts, ["p_name", "p_partkey"], 50)
    row = F.struct(F.col("place"), F.col("p_partkey"), F.col("p_name"), F.col("page_no"))
    arrays = numbered.groupBy("page_no").agg(F.to_json(F.sort_array(F.collect_list(row))).alias("value"))
    folder = scratch_path(spark, "pages")
    # A page is one row and one file. The files lie in one folder: the tasks that write and list them do not grow with the pages.
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(folder)
    schema = "place bigint, p_partkey bigint, p_name string, page_no bigint"
    found = readers.landed_pages(folder, schema).load(spark)
    return found.select("p_partkey", "p_name", "page_no", "place")


# -- documents -----------------------------------------------------------------


@query(f"""
SELECT CAST(o_orderkey AS VARCHAR) AS object_id, o_orderdate AS update_ts,
       CASE o_orderstatus WHEN 'F' THEN 'CLOSED' WHEN 'P' THEN 'CANCELLED'
            ELSE 'COOKING' END AS final_status,
       o_orderdate AS ordered_at, CAST(o_custkey AS VARCHAR) AS user_id,
       CAST(o_orderkey % {SUPPLIERS} AS VARCHAR) AS restaurant_id,
       1 AS items, CAST(o_orderkey AS VARCHAR) AS item_id, o_orderpriority AS item_name,
       CAST(o_totalprice AS DECIMAL(14,2)) AS item_price, 1 AS item_quantity,
       CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DECIMAL(19,5)) AS cost
FROM orders
""")
def document_roundtrip(spark, sf_dir):
    shape = (
        "cost decimal(19,5), " + schemas.ORDER + ", order_items"
        " array<struct<id string, name string, price string, quantity string>>"
    )
    docs = parsed(demo.Market(spark, sf_dir).staged_orders, "object_value", shape)
    item = F.col("doc.order_items")[0]
    return docs.select(
        "object_id",
        "update_ts",
        F.col("doc.final_status").alias("final_status"),
        to_second(moment("doc.date")).alias("ordered_at"),
        F.col("doc.user.id").alias("user_id"),
        F.col("doc.restaurant.id").alias("restaurant_id"),
        F.size("doc.order_items").alias("items"),
        item["id"].alias("item_id"),
        item["name"].alias("item_name"),
        item["price"].try_cast("decimal(14,2)").alias("item_price"),
        rounded_number(item["quantity"]).alias("item_quantity"),
        F.col("doc.cost").alias("cost"),
    )


@query(f"""
SELECT CAST((p_partkey + step) % {SUPPLIERS} AS VARCHAR) AS restaurant_source_id,
       CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
       CAST(CAST(p_retailprice AS DECIMAL(14,2)) AS DOUBLE) AS product_price,
       TIMESTAMP '{demo.LOAD_TS}' AS active_from, TIMESTAMP '2099-12-31 00:00:00' AS active_to
FROM part, range({demo.OFFERS}) AS s(step)
""")
def menu_items(spark, sf_dir):
    return dimensions.menu_items(demo.Market(spark, sf_dir).staged_restaurants)


@query("""
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       CAST(trunc(value) AS BIGINT) AS whole_value,
       CAST(round(CAST(value AS DECIMAL(18,4))) AS INTEGER) AS rounded_value,
       CAST(date_trunc('second', ts) AS TIMESTAMP) AS second
FROM events
""")
def json_fields(spark, sf_dir):
    docs = parsed(demo.table(spark, sf_dir, "events"), "props", "k string")
    return docs.select(
        "event_id",
        rounded_number(F.col("doc.k")).alias("k"),
        whole_number(F.col("value")).cast("bigint").alias("whole_value"),
        rounded_number(F.col("value").cast("decimal(18,4)")).alias("rounded_value"),
        to_second(F.col("ts")).alias("second"),
    )


# -- upserts and load state ----------------------------------------------------


@query("""
WITH last AS (
  SELECT user_id, event_type AS state, ts AS update_ts FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
SELECT c_custkey AS user_id, coalesce(state, c_mktsegment) AS state,
       coalesce(update_ts, TIMESTAMP '1900-01-01 00:00:00') AS update_ts
FROM customer LEFT JOIN last ON user_id = c_custkey
UNION ALL
SELECT user_id, state, update_ts FROM last WHERE user_id NOT IN (SELECT c_custkey FROM customer)
""")
def upsert_last_wins(spark, sf_dir):
    """All events, of which the last per user wins, into the customers."""
    current = demo.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_mktsegment").alias("state"),
        F.lit("1900-01-01").cast("timestamp_ntz").alias("update_ts"),
    )
    batch = demo.table(spark, sf_dir, "events").select(
        "user_id", F.col("event_type").alias("state"), F.col("ts").alias("update_ts"), "event_id"
    )
    last = merge.last_per_key(batch, ["user_id"], ["update_ts", "event_id"])
    return merge.merge_rows(current, last.drop("event_id"), ["user_id"])


@query("""
WITH known AS (
  SELECT row_number() OVER (ORDER BY user_id) AS id, user_id
  FROM (SELECT DISTINCT user_id FROM events))
SELECT id, c_custkey AS user_id, c_name AS name FROM customer JOIN known ON user_id = c_custkey
UNION ALL
SELECT (SELECT max(id) FROM known) + row_number() OVER (ORDER BY c_custkey), c_custkey, c_name
FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM known)
UNION ALL
SELECT id, user_id, NULL FROM known WHERE user_id NOT IN (SELECT c_custkey FROM customer)
""")
def upsert_keeps_ids(spark, sf_dir):
    """All customers into the numbered users of events: known ones keep their number."""
    seen = demo.table(spark, sf_dir, "events").select("user_id").distinct()
    current = demo.numbered(seen, ["user_id"]).withColumn("name", F.lit(None).cast("string"))
    batch = demo.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name")
    )
    result = merge.upsert(
        current.select("id", "user_id", "name"), batch, ["user_id"], ["name"], surrogate="id"
    )
    return result


@query("""
SELECT l_orderkey, l_partkey, count(*) AS copies FROM lineitem
GROUP BY 1, 2 HAVING count(*) > 1
""")
def upsert_conflicts(spark, sf_dir):
    lines = demo.table(spark, sf_dir, "lineitem")
    return merge.copies_per_key(lines, ["l_orderkey", "l_partkey"])


@query("""
SELECT event_type AS workflow_key, max(event_id) AS latest_loaded_id FROM events GROUP BY 1
""")
def checkpoint_max_id(spark, sf_dir):
    """Watermarks of one load per event type, as the store keeps them."""
    return _watermarks(spark, sf_dir, state.ID, "id").select(
        "workflow_key",
        F.get_json_object("workflow_settings", "$.latest_loaded_id")
        .cast("bigint")
        .alias("latest_loaded_id"),
    )


@query("""
SELECT event_type AS workflow_key, max(ts) AS latest_loaded_ts FROM events GROUP BY 1
""")
def checkpoint_max_ts(spark, sf_dir):
    return _watermarks(spark, sf_dir, state.TS, "event_ts").select(
        "workflow_key",
        moment(F.get_json_object("workflow_settings", "$.latest_loaded_ts")).alias(
            "latest_loaded_ts"
        ),
    )


@query("""
SELECT 'purchase' AS workflow_key, CAST(max(event_id) AS VARCHAR) AS value
FROM events WHERE event_type = 'purchase'
UNION ALL SELECT 'refund', '-1'
UNION ALL SELECT 'signup', CAST(max(event_id) AS VARCHAR) FROM events WHERE event_type = 'signup'
""")
def checkpoint_default(spark, sf_dir):
    """What a load is told to start after: the stored watermark, or the default where there is none."""
    settings = _watermarks(spark, sf_dir, state.ID, "id", ("purchase", "signup"))
    found = [
        state.settings_value(settings, workflow, state.ID)
        for workflow in ("purchase", "refund", "signup")
    ]
    return reduce(DataFrame.unionByName, found)


def _outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demo.table(spark, sf_dir, "events").select(
        F.col("event_id").cast("int").alias("id"),
        F.col("ts").alias("event_ts"),
        "event_type",
        F.col("props").alias("event_value"),
    )


def _watermarks(
    spark: SparkSession, sf_dir: str, kind: str, column: str, workflows: tuple[str, ...] | None = None
) -> DataFrame:
    """Loads of events, one workflow per type: the settings the store has afterwards."""
    store = fresh_store(spark, ["stg.bonussystem_events", "stg.srv_wf_settings"])
    states, outbox = state.LoadState(store), _outbox(spark, sf_dir)
    kinds = workflows or [r[0] for r in outbox.select("event_type").distinct().collect()]  # a few types
    for workflow in kinds:
        own = outbox.filter(F.col("event_type") == workflow)
        start = states.get(workflow, kind)
        above = readers.after_id(own, start, column) if kind == state.ID else readers.after_ts(own, start, column)
        result = store.upsert("stg.bonussystem_events", above, order=["event_ts"], watermark=column)
        states.advance(workflow, kind, result.watermark)
    return store.read("stg.srv_wf_settings")


# -- quality -------------------------------------------------------------------


@query("""
SELECT o_orderkey AS order_key, o_custkey AS user_id FROM orders
WHERE o_custkey NOT IN (SELECT user_id FROM events)
""")
def fk_violations(spark, sf_dir):
    orders = demo.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_key"), F.col("o_custkey").alias("user_id")
    )
    accounts = demo.table(spark, sf_dir, "events").select(F.col("user_id").alias("id")).distinct()
    return quality.orphans(orders, schemas.ForeignKey("user_id", "accounts"), accounts)


@query("""
SELECT doc_id, length(text) AS characters, 'length: text' AS reasons
FROM documents WHERE length(text) > 2048
""")
def length_violations(spark, sf_dir):
    documents = demo.table(spark, sf_dir, "documents")
    flagged = quality.flag(documents, quality.length_reasons({"text": 2048}))
    _, rejected = quality.split(flagged)
    return with_reasons(
        rejected.select("doc_id", F.length("text").cast("bigint").alias("characters"), "reasons")
    )


@query("""
SELECT l_orderkey, l_partkey, CAST(l_quantity AS INTEGER) AS quantity,
       CAST(CAST(l_quantity AS INTEGER) * CAST(l_extendedprice AS DECIMAL(14,2))
            AS DECIMAL(25,2)) AS total, 'overflow: total' AS reasons
FROM lineitem
WHERE CAST(l_quantity AS INTEGER) * CAST(l_extendedprice AS DECIMAL(14,2)) >= 999999.995
""")
def overflow_violations(spark, sf_dir):
    quantity = F.col("l_quantity").cast("int")
    totals = demo.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        quantity.alias("quantity"),
        (quantity * demo.money("l_extendedprice")).cast("decimal(25,2)").alias("total"),
    )
    flagged = quality.flag(totals, quality.overflow_reasons(totals, {"total": "decimal(8,2)"}))
    _, rejected = quality.split(flagged)
    return with_reasons(rejected)


_STAGED = {
    "stg.bonussystem_ranks": ("nation", "true"),
    "stg.bonussystem_users": ("events", "true"),
    "stg.bonussystem_events": ("events", "true"),
    "stg.ordersystem_restaurants": ("supplier", "true"),
    "stg.ordersystem_users": ("customer", "true"),
    "stg.ordersystem_orders": ("orders", "true"),
    "stg.deliverysystem_restaurants": ("supplier", "true"),
    "stg.deliverysystem_couriers": ("customer", "true"),
}


@query(" UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS received, CAST(0 AS BIGINT) AS rejected, count(*) AS loaded,"
    f" CAST(0 AS BIGINT) AS superseded, CAST(0 AS BIGINT) AS skipped, count(*) AS stored FROM {source}"
    for name, (source, _) in _STAGED.items()
) + """
UNION ALL
SELECT 'stg.deliverysystem_deliveries', count(*), 0, count(*) FILTER (recent), 0, count(*) FILTER (NOT recent),
       count(*) FILTER (recent)
FROM (SELECT o_orderdate + INTERVAL 1 DAY >= TIMESTAMP '1995-01-02' AND o_orderdate + INTERVAL 1 DAY < TIMESTAMP '1995-06-01'
             AS recent FROM orders WHERE o_orderstatus = 'F')
""")
def load_row_counts(spark, sf_dir):
    """The nine staging loads of a run, as the store has recorded them, next to what the tables hold."""
    run = staged_run(spark, sf_dir, run_date=dt.date(1995, 6, 1), days=150)
    run.store.record(run.stage(), demo.LOAD_TS)
    stored = [
        run.table(name).agg(F.lit(name).alias("_table"), F.count("*").alias("stored"))
        for name in (*_STAGED, "stg.deliverysystem_deliveries")
    ]
    loads = run.store.loads().join(reduce(DataFrame.unionByName, stored), F.col("table") == F.col("_table"))
    return loads.select(F.col("table").alias("table_name"), "received", "rejected", "loaded", "superseded", "skipped", "stored")


def fresh_store(spark: SparkSession, tables: list[str] | None = None) -> Store:
    store = Store(spark, scratch_path(spark, "warehouse"))
    store.create(tables) if tables else store.create()
    return store


def staged_run(spark: SparkSession, sf_dir: str, **settings) -> Run:
    """A run over the test tables, with an empty warehouse."""
    ranks = demo.table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("int").alias("id"),
        F.col("n_name").alias("name"),
        (F.col("n_nationkey") / 4).cast("decimal(19,5)").alias("bonus_percent"),
        (F.col("n_regionkey") * 100).cast("decimal(19,5)").alias("min_payment_threshold"),
    )
    at = (spark, sf_dir)
    sources = {
        "ranks": ranks,
        "users": demo.source_accounts(*at),
        "outbox": _outbox(*at),
        "order_users": demo.source_users(*at),
        "order_restaurants": demo.source_restaurants(*at),
        "orders": demo.source_orders(*at),
        "api_restaurants": demo.table(spark, sf_dir, "supplier").select(
            text("s_suppkey").alias("_id"), F.col("s_name").alias("name")
        ),
        "api_couriers": demo.source_couriers(*at),
        "api_deliveries": demo.source_deliveries(*at),
    }
    chosen = {"load_ts": demo.LOAD_TS, "run_date": dt.date(2024, 2, 1), "as_of": demo.AS_OF, **settings}
    return Run(fresh_store(spark), sources, RunSettings(**chosen))


# -- staging loads ---------------------------------------------------------------


@query("""
SELECT CAST(n_nationkey AS INTEGER) AS id, n_name AS name, CAST(n_nationkey / 4.0 AS DECIMAL(19,5)) AS bonus_percent,
       CAST(n_regionkey * 100 AS DECIMAL(19,5)) AS min_payment_threshold FROM nation
""")
def staged_ranks(spark, sf_dir):
    run = staged_run(spark, sf_dir)
    run.load_ranks()
    return run.table("stg.bonussystem_ranks")


@query("SELECT CAST(event_id AS INTEGER) AS id, CAST(user_id AS VARCHAR) AS order_user_id FROM events")
def staged_bonus_users(spark, sf_dir):
    run = staged_run(spark, sf_dir)
    run.load_bonus_users()
    return run.table("stg.bonussystem_users")


@query("SELECT CAST(event_id AS INTEGER) AS id, ts AS event_ts, event_type, props AS event_value FROM events")
def staged_outbox(spark, sf_dir):
    """Two increments: up to a watermark, and what lies above it."""
    run = staged_run(spark, sf_dir)
    outbox = run.sources["outbox"]
    middle = outbox.agg((F.max("id") / 2).cast("int").alias("id")).scalar()
    for given in (outbox.filter(F.col("id") <= middle), outbox):
        run.sources = {**run.sources, "outbox": given}
        run.load_outbox()
    return run.table("stg.bonussystem_events")


def _document_fields(run: Run, table: str, *fields: str) -> DataFrame:
    chosen = [F.get_json_object("object_value", f"$.{field}").alias(field.replace(".", "_")) for field in fields]
    return run.table(table).select("object_id", "update_ts", *chosen)


@query(f"""
SELECT workflow_key, '{demo.LOAD_TS}' AS loaded_at, stored_rows
FROM (SELECT 'bonus_system_ranks' AS workflow_key, count(*) AS stored_rows FROM nation
      UNION ALL SELECT 'bonus_system_users', count(*) FROM events)
""")
def load_times(spark, sf_dir):
    """The time of load that snapshots keep as their state, beside the rows they have stored."""
    run = staged_run(spark, sf_dir)
    run.load_ranks(), run.load_bonus_users()
    states = run.table("stg.srv_wf_settings")
    kept = {"bonus_system_ranks": "stg.bonussystem_ranks", "bonus_system_users": "stg.bonussystem_users"}
    shown = [
        state.settings_value(states, workflow, state.TS).withColumnRenamed("value", "loaded_at").join(
            run.table(name).groupBy(F.lit(workflow).alias("workflow_key")).agg(F.count("*").alias("stored_rows")),
            "workflow_key",
        )
        for workflow, name in kept.items()
    ]
    return shown[0].unionByName(shown[1])


@query("""
SELECT DISTINCT date_trunc('second', o_orderdate) AS ts, CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(month(o_orderdate) AS INTEGER) AS month, CAST(day(o_orderdate) AS INTEGER) AS day,
       CAST(o_orderdate AS DATE) AS date
FROM orders
""")
def equal_rows_upsert(spark, sf_dir):
    """A set-based load whose batch has one row per order: equal rows of a moment count as one."""
    store = fresh_store(spark, ["dds.dm_timestamps"])
    moments = demo.table(spark, sf_dir, "orders").select(to_second(F.col("o_orderdate")).alias("ts"))
    store.upsert("dds.dm_timestamps", calendar_parts(moments), distinct=True, bounds={"timestamp_year_from": 1900})
    return store.read("dds.dm_timestamps").select("ts", "year", "month", "day", "date")


@query(f"""
WITH {DIM_USERS}, {DIM_RESTAURANTS}, {DIM_TIMESTAMPS}, {DIM_ORDERS}
SELECT order_key, order_status FROM dm_orders
""")
def incremental_orders(spark, sf_dir):
    """Two increments up to the orders: the second brings the other half of the orders and users.

    Orders of users that come later are found again, all others are read once.
    """
    run = staged_run(spark, sf_dir, days=None, bounds={"timestamp_year_from": 1900})
    given = dict(run.sources)
    half = {
        "orders": given["orders"].filter(F.col("update_ts") < F.lit("1995-01-01").cast("timestamp_ntz")),
        "order_users": given["order_users"].filter(F.pmod(F.col("_id"), F.lit(2)) == 0),
    }
    wanted = ("dds.dm_users", "dds.dm_restaurants", "dds.dm_timestamps", "dds.dm_orders")
    for sources in ({**given, **half}, {**given, "order_users": given["order_users"].withColumn("update_ts", F.expr("update_ts + interval 1 day"))}):
        run.sources = sources
        for job in (run.load_bonus_users, run.load_order_users, run.load_order_restaurants, run.load_orders, run.load_api_deliveries):
            job()
        for name in wanted:
            run.load(LOADS[name])
    return run.table("dds.dm_orders").select("order_key", "order_status")


def _dated_orders(store: Store, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders for the warehouse with the keys that it has given to restaurants and moments; fills both dimensions."""
    orders = demo.table(spark, sf_dir, "orders")
    moments = orders.select(to_second(F.col("o_orderdate")).alias("ts"))
    store.upsert("dds.dm_timestamps", calendar_parts(moments), distinct=True, bounds=ALL_YEARS)
    suppliers = demo.restaurants(spark, sf_dir).withColumn("active_from", F.lit("2000-01-01").cast("timestamp_ntz"))
    store.upsert("dds.dm_restaurants", suppliers)
    restaurants = store.read("dds.dm_restaurants").select(F.col("id").alias("restaurant"), F.col("restaurant_id").alias("named"))
    times = store.read("dds.dm_timestamps").select(F.col("id").alias("timestamp"), "ts", F.col("date").alias("day"))
    rows = demo.orders(spark, sf_dir).join(orders.select(F.col("o_orderkey").alias("id"), to_second(F.col("o_orderdate")).alias("ts")), "id")
    status = F.when(F.col("order_status") == demo.CLOSED, facts.CLOSED).otherwise("COOKING")
    return rows.join(restaurants, text("restaurant_id") == F.col("named")).join(times, "ts").select(
        F.col("id").alias("number"), "order_key", status.alias("order_status"), "user_id",
        F.col("restaurant").alias("restaurant_id"), F.col("timestamp").alias("timestamp_id"),
    )


def _keyed(store: Store, rows: DataFrame) -> DataFrame:
    """Rows with the order keys of the warehouse in place of the order numbers of the test tables."""
    keys = store.read("dds.dm_orders").select(F.col("id").alias("order"), "order_key")
    return rows.join(keys, text("order_id") == F.col("order_key")).drop("order_id", "order_key").withColumnRenamed("order", "order_id")


def _numbered_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item as the sale of a product of its own: the lines of an order may name one product twice."""
    sales = demo.sales(spark, sf_dir)
    within = Window.partitionBy("order_id").orderBy(*[name for name in sales.columns if name != "order_id"])
    return pin(sales.withColumn("product_id", F.row_number().over(within).cast("bigint")))


ALL_YEARS = {"timestamp_year_from": 1900, "ledger_year_after": 1900, **REPORT_BOUNDS}


@query(f"WITH {settlement_sql(NOT_IN_DEBT)} SELECT * FROM report WHERE {REPORT_REASONS} = ''")
def incremental_settlement(spark, sf_dir):
    """Two increments of the report: orders that were open, elsewhere or on another day before, sales that changed or came late."""
    tables = ["dds.dm_restaurants", "dds.dm_timestamps", "dds.dm_orders", "dds.fct_product_sales", "cdm.dm_settlement_report", "stg.srv_wf_settings"]
    store = fresh_store(spark, tables)
    orders = pin(_dated_orders(store, spark, sf_dir))
    sales = _numbered_sales(spark, sf_dir)
    turn = F.col("number") % 5
    early_orders = (
        orders.withColumn("order_status", F.when(turn == 0, "COOKING").when(turn == 1, facts.CLOSED).otherwise(F.col("order_status")))
        .withColumn("restaurant_id", F.when(turn == 2, F.lit(1).cast("bigint")).otherwise(F.col("restaurant_id")))
        .withColumn("timestamp_id", F.when(turn == 3, F.lit(1).cast("bigint")).otherwise(F.col("timestamp_id")))
    )
    early_sales = sales.filter("product_id % 3 <> 0").withColumn("total_sum", F.expr("if(product_id % 2 = 0, total_sum + 1, total_sum)"))
    settings = RunSettings(demo.LOAD_TS, dt.date(2024, 2, 1), demo.AS_OF, bounds=ALL_YEARS)
    for some_orders, some_sales in ((early_orders, early_sales), (orders, sales)):
        store.upsert("dds.dm_orders", some_orders.drop("number"), foreign=False)
        store.upsert("dds.fct_product_sales", _keyed(store, some_sales), foreign=False)
        Run(store, {}, settings).load(LOADS["cdm.dm_settlement_report"])
    names = store.read("dds.dm_restaurants").select(text("id").alias("key"), F.col("restaurant_id").alias("named"))
    report = store.read("cdm.dm_settlement_report").drop("id")
    return report.join(names, F.col("key") == F.col("restaurant_id")).withColumn("restaurant_id", F.col("named")).drop("key", "named")


@query(LEDGER_ROWS)
def incremental_ledger(spark, sf_dir):
    """Two increments of the ledger: rates and couriers that change, orders of another month before, late deliveries."""
    tables = ["dds.dm_restaurants", "dds.dm_timestamps", "dds.dm_orders", "dds.fct_deliveries", "cdm.dm_courier_ledger", "stg.srv_wf_settings"]
    store = fresh_store(spark, tables)
    orders = pin(_dated_orders(store, spark, sf_dir))
    deliveries = demo.deliveries(spark, sf_dir)
    early_orders = orders.withColumn("timestamp_id", F.expr("if(number % 11 = 0, bigint(1), timestamp_id)"))
    number = F.col("delivery_id")
    early = (
        deliveries.filter(number % 7 != 0)
        .withColumn("rate", F.when(number % 3 == 0, 1).otherwise(F.col("rate")))
        .withColumn("courier_id", F.when(number % 5 == 0, F.col("courier_id") + 1).otherwise(F.col("courier_id")))
    )
    settings = RunSettings(demo.LOAD_TS, dt.date(2024, 2, 1), demo.AS_OF, bounds=ALL_YEARS)
    for some_orders, some in ((early_orders, early), (orders, deliveries)):
        store.upsert("dds.dm_orders", some_orders.drop("number"), foreign=False)
        store.upsert("dds.fct_deliveries", _keyed(store, some), foreign=False)
        Run(store, {}, settings).load(LOADS["cdm.dm_courier_ledger"])
    return store.read("cdm.dm_courier_ledger").drop("id")


@query(f"""
SELECT CAST(s_suppkey AS VARCHAR) AS object_id, TIMESTAMP '{demo.LOAD_TS}' AS update_ts, s_name AS name FROM supplier
""")
def staged_restaurants(spark, sf_dir):
    run = staged_run(spark, sf_dir)
    run.load_order_restaurants()
    return _document_fields(run, "stg.ordersystem_restaurants", "name")


@query(f"""
SELECT CAST(c_custkey AS VARCHAR) AS object_id, TIMESTAMP '{demo.LOAD_TS}' AS update_ts, c_name AS name,
       c_mktsegment AS login FROM customer
""")
def staged_users(spark, sf_dir):
    run = staged_run(spark, sf_dir)
    run.load_order_users()
    return _document_fields(run, "stg.ordersystem_users", "name", "login")


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS object_id, o_orderdate AS update_ts, CAST(o_custkey AS VARCHAR) AS user_id,
       CASE o_orderstatus WHEN 'F' THEN 'CLOSED' WHEN 'P' THEN 'CANCELLED' ELSE 'COOKING' END AS final_status
FROM orders
""")
def staged_orders(spark, sf_dir):
    """Two increments by the time of the last change."""
    run = staged_run(spark, sf_dir)
    orders = run.sources["orders"]
    early = F.col("update_ts") < F.lit("1995-01-01").cast("timestamp_ntz")
    for given in (orders.filter(early), orders):
        run.sources = {**run.sources, "orders": given}
        run.load_orders()
    return _document_fields(run, "stg.ordersystem_orders", "user.id", "final_status")


@query(f"""
SELECT CAST(s_suppkey AS VARCHAR) AS object_id, TIMESTAMP '{demo.LOAD_TS}' AS update_ts, s_name AS name FROM supplier
""")
def staged_api_restaurants(spark, sf_dir):
    run = staged_run(spark, sf_dir)
    run.load_api_restaurants()
    return _document_fields(run, "stg.deliverysystem_restaurants", "name")


@query(f"""
SELECT CAST(c_custkey AS VARCHAR) AS object_id, TIMESTAMP '{demo.LOAD_TS}' AS update_ts, c_name AS name FROM customer
""")
def staged_api_couriers(spark, sf_dir):
    run = staged_run(spark, sf_dir)
    run.load_api_couriers()
    return _document_fields(run, "stg.deliverysystem_couriers", "name")


@query(f"""
SELECT CAST(o_orderkey AS VARCHAR) AS object_id, TIMESTAMP '{demo.LOAD_TS}' AS update_ts,
       'd' || CAST(o_orderkey AS VARCHAR) AS delivery_id, CAST(o_custkey AS VARCHAR) AS courier_id
FROM orders WHERE o_orderstatus = 'F'
""")
def staged_deliveries(spark, sf_dir):
    """All deliveries: a first load looks back without limit."""
    run = staged_run(spark, sf_dir, days=None, bounds={"timestamp_year_from": 1900})
    run.load_api_deliveries()
    return _document_fields(run, "stg.deliverysystem_deliveries", "delivery_id", "courier_id")


@query("""
SELECT CASE WHEN o_orderkey % 7 = 0 THEN 'skipped' WHEN o_orderkey % 5 = 0 THEN 'rejected' ELSE 'loaded' END AS outcome,
       count(*) AS deliveries
FROM orders WHERE o_orderstatus = 'F' GROUP BY 1
""")
def rejected_deliveries(spark, sf_dir):
    """Deliveries of which some have no readable time and some are older than the days asked for: none is lost."""
    run = staged_run(spark, sf_dir)
    key = F.col("order_id").cast("bigint")
    time = (
        F.when(key % 7 == 0, "2023-05-01 10:00:00")
        .when(key % 5 == 0, F.when(key % 2 == 0, "yesterday"))
        .otherwise("2024-01-30 12:00:00")
    )
    given = run.sources["api_deliveries"].withColumn("delivery_ts", time)
    run.sources = {**run.sources, "api_deliveries": given}
    result = run.load_api_deliveries()
    table = "stg.deliverysystem_deliveries"
    kept = run.table(table).select(F.lit("loaded").alias("outcome"))
    refused = run.store.rejected_documents(table).select(F.lit("rejected").alias("outcome"))
    skipped = spark.range(result.skipped).select(F.lit("skipped").alias("outcome"))
    return kept.union(refused).union(skipped).groupBy("outcome").agg(F.count("*").alias("deliveries"))


@query("""
SELECT CAST(event_id AS VARCHAR) AS source_key, CASE event_id % 4 WHEN 0 THEN 'json: event_value'
       WHEN 1 THEN 'array: product_payments' ELSE 'null: order_id' END AS reason
FROM events WHERE event_id % 8 < 3
""")
def rejected_documents(spark, sf_dir):
    """Bonus transactions with a broken payload: not JSON (refused when staged), no list, no order (refused when read)."""
    run = staged_run(spark, sf_dir)
    line = F.struct(text("id").alias("product_id"), F.lit("1").alias("price"))
    payload = (
        F.when(F.col("id") % 8 == 0, F.concat(F.lit("{"), text("id")))
        .when(F.col("id") % 8 == 1, document(order_id=text("id"), product_payments=text("id")))
        .when(F.col("id") % 8 == 2, document(product_payments=F.array(line)))
        .otherwise(document(order_id=text("id"), product_payments=F.array(line)))
    )
    outbox = run.sources["outbox"].select("id", "event_ts", F.lit(facts.PAYMENT_EVENT).alias("event_type"), payload.alias("event_value"))
    run.sources = {**run.sources, "outbox": outbox}
    run.load_outbox()
    run.load(LOADS["dds.fct_product_sales"])
    staged = run.store.rejected("stg.bonussystem_events").select(text("id").alias("source_key"), "reasons")
    read = run.store.rejected_documents("dds.fct_product_sales").select("source_key", "reasons")
    return staged.union(read).select("source_key", F.array_join("reasons", "; ").alias("reason"))


@query("""
SELECT CAST(event_id AS VARCHAR) AS order_source_id,
       CASE event_id % 3 WHEN 0 THEN CAST(trunc(value) AS DECIMAL(19,5)) WHEN 1 THEN CAST(event_id AS DECIMAL(19,5)) END AS bonus_grant
FROM events
""")
def quoted_numbers(spark, sf_dir):
    """Grants as JSON numbers (cut), as quoted whole numbers, and as quoted fractions, which are none (NULL, so refused)."""
    grant = (
        F.when(F.col("id") % 3 == 0, F.format_string("%.2f", "value"))
        .when(F.col("id") % 3 == 1, F.concat(F.lit('"'), text("id"), F.lit('"')))
        .otherwise(F.concat(F.lit('"'), text("id"), F.lit('.5"')))
    )
    events = demo.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("ts").alias("event_ts"), F.floor(F.col("value") * 100).alias("hundredths"), "value"
    )
    events = events.withColumn("value", F.col("hundredths") / 100)
    payload = F.format_string('{"order_id": "%s", "product_payments": [{"product_id": "1", "price": "1", "bonus_grant": %s}]}', text("id"), grant)
    rows = events.select("event_ts", F.lit(facts.PAYMENT_EVENT).alias("event_type"), payload.alias("event_value"))
    return facts.payments(rows).select("order_source_id", "bonus_grant")


def staged_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document whose text comes back from its staged name: all texts are staged, whole."""
    docs = demo.table(spark, sf_dir, "documents")
    rows = docs.select(text("doc_id").alias("_id"), F.col("text").alias("name"), "doc_id", "lang", "text")
    run = staged_run(spark, sf_dir)
    run.sources = {**run.sources, "api_couriers": rows.select("_id", "name")}
    run.load_api_couriers()
    staged = run.table("stg.deliverysystem_couriers")
    raw = F.regexp_replace("object_value", "\\\\u[0-9a-f]{4}", "")
    back = parsed(staged, "object_value", schemas.NAMED).filter(raw == F.col("object_value"))
    same = back.join(rows, (F.col("object_id") == F.col("_id")) & F.col("doc.name").eqNullSafe(F.col("text")))
    return same.select("doc_id", "lang", F.length("doc.name").cast("bigint").alias("n_chars"))


@query("""
SELECT doc_id, lang, n_chars FROM documents
""")
def unicode_documents(spark, sf_dir):
    """Texts with letters of several languages as staged names: the JSON holds them as they are."""
    return staged_texts(spark, sf_dir)


# -- warehouse and stream ------------------------------------------------------


@query(f"""
SELECT row_number() OVER (ORDER BY CAST(s_suppkey AS VARCHAR)) AS id,
       CAST(s_suppkey AS VARCHAR) AS restaurant_id, s_name AS restaurant_name,
       CASE WHEN s_acctbal < 0 THEN TIMESTAMP '{demo.LOAD_TS}'
            ELSE TIMESTAMP '2024-01-01 00:00:00' END AS active_from,
       TIMESTAMP '2099-12-31 00:00:00' AS active_to
FROM supplier
UNION ALL
SELECT (SELECT count(*) FROM supplier)
       + row_number() OVER (ORDER BY 'n' || CAST(n_nationkey AS VARCHAR)),
       'n' || CAST(n_nationkey AS VARCHAR), n_name, TIMESTAMP '{demo.LOAD_TS}',
       TIMESTAMP '2099-12-31 00:00:00'
FROM nation
""")
def versioned_upsert(spark, sf_dir):
    """Two set-based upserts into a fresh warehouse table.

    The second brings all suppliers again, those in debt with a new start, and
    the nations as new rows.
    """
    name = "dds.dm_restaurants"
    suppliers = demo.table(spark, sf_dir, "supplier")
    nations = demo.table(spark, sf_dir, "nation").select(
        F.concat(F.lit("n"), text("n_nationkey")).alias("restaurant_id"),
        F.col("n_name").alias("restaurant_name"),
        F.lit(demo.LOAD_TS).cast("timestamp_ntz").alias("active_from"),
        open_end().alias("active_to"),
    )

    def restaurants(start):
        return suppliers.select(
            text("s_suppkey").alias("restaurant_id"),
            F.col("s_name").alias("restaurant_name"),
            start.cast("timestamp_ntz").alias("active_from"),
            open_end().alias("active_to"),
        )

    first = F.lit("2024-01-01 00:00:00")
    again = F.when(F.col("s_acctbal") < 0, F.lit(demo.LOAD_TS)).otherwise(first)
    store = Store(spark, scratch_path(spark, "warehouse"))
    store.create([name])
    store.upsert(name, restaurants(first))
    store.upsert(name, restaurants(again).unionByName(nations))
    return store.read(name)


_EVENT = "id int, event_ts timestamp_ntz, event_type string, event_value string"


@query("""
SELECT CAST(event_id AS INTEGER) AS id, ts AS event_ts,
       CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 'draft' ELSE event_type END AS event_type,
       props AS event_value
FROM events
""")
def stream_increment(spark, sf_dir):
    """Two landings, streamed one after the other into a fresh warehouse table.

    The first has all events as drafts, the second the final rows of the later
    half, which replace theirs.
    """
    folder = scratch_path(spark, "stream")
    landing, name = f"{folder}/landing", "stg.bonussystem_events"
    events = demo.table(spark, sf_dir, "events").select(
        F.col("event_id").cast("int").alias("id"),
        F.col("ts").alias("event_ts"),
        "event_type",
        F.col("props").alias("event_value"),
    )
    later = F.col("event_ts") >= F.lit("2024-01-16").cast("timestamp_ntz")
    drops = (
        events.withColumn("event_type", F.lit("draft")).withColumn("arrival", F.lit(1)),
        events.filter(later).withColumn("arrival", F.lit(2)),
    )
    store = Store(spark, f"{folder}/warehouse")
    store.create([name])
    for drop in drops:
        drop.write.mode("append").parquet(landing)
        stream = landing_stream(spark, landing, f"{_EVENT}, arrival int")
        running = stream_upsert(stream, store, name, ["arrival"], f"{folder}/stream-state")
        running.awaitTermination()
    return store.read(name)


@query("""
SELECT CAST(event_id AS VARCHAR) AS object_id, ts AS update_ts, event_type AS name FROM events
""")
def stream_out_of_order(spark, sf_dir):
    """Late files: rows of an earlier change come after the later ones, and do not replace them."""
    folder = scratch_path(spark, "stream")
    landing, name = f"{folder}/landing", "stg.ordersystem_users"
    rows = demo.table(spark, sf_dir, "events").select(
        text("event_id").alias("object_id"),
        document(name="event_type").alias("object_value"),
        F.col("ts").alias("update_ts"),
    )
    late = rows.select("object_id", document(name=F.lit("old")).alias("object_value"), F.expr("update_ts - interval 1 day").alias("update_ts"))
    store = Store(spark, f"{folder}/warehouse")
    store.create([name])
    for drop in (rows, late):
        drop.write.mode("append").parquet(landing)
        stream = landing_stream(spark, landing, "object_id string, object_value string, update_ts timestamp_ntz")
        stream_upsert(stream, store, name, ["update_ts", "object_value"], f"{folder}/stream-state").awaitTermination()
    return store.read(name).select("object_id", "update_ts", F.get_json_object("object_value", "$.name").alias("name"))


@query("""
SELECT CAST(p_partkey AS VARCHAR) AS product_id, 'foreign key: restaurant_id -> dds.dm_restaurants' AS reasons
FROM part WHERE p_partkey % 10 = 0
""")
def store_orphans(spark, sf_dir):
    """Products of which every tenth names a restaurant that the warehouse does not have."""
    store = fresh_store(spark, ["dds.dm_restaurants", "dds.dm_products"])
    suppliers = demo.table(spark, sf_dir, "supplier").select(
        text("s_suppkey").alias("restaurant_id"),
        F.col("s_name").alias("restaurant_name"),
        F.lit(demo.LOAD_TS).cast("timestamp_ntz").alias("active_from"),
        open_end().alias("active_to"),
    )
    store.upsert("dds.dm_restaurants", suppliers)
    known = F.lit(1).cast("bigint")
    products = demo.table(spark, sf_dir, "part").select(
        F.when(F.col("p_partkey") % 10 == 0, F.lit(-1).cast("bigint")).otherwise(known).alias("restaurant_id"),
        text("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        demo.money("p_retailprice").alias("product_price"),
        F.lit(demo.LOAD_TS).cast("timestamp_ntz").alias("active_from"),
        open_end().alias("active_to"),
    )
    store.upsert("dds.dm_products", products)
    return store.rejected("dds.dm_products").select("product_id", F.array_join("reasons", "; ").alias("reasons"))
