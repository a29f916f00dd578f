"""The marketplace seen in the test tables.

======================  =====================================================
concept                 test table
======================  =====================================================
user, bonus account     customer; user of an event
restaurant              supplier; an order's is chosen by its number
menu                    part, each offered by four suppliers
order                   orders; F is closed, P is cancelled, O is open
sale                    lineitem
courier, delivery       customer; closed orders
======================  =====================================================
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions.calendar import calendar_parts, second_number
from larder.functions.documents import document, open_end, text
from larder.operators import quality
from larder.operators.merge import last_per_key
from larder.operators.numbering import number_rows
from larder.plans import dimensions, staging
from larder.schemas import TABLES
from larder.session import pin

LOAD_TS = "2024-02-01 00:00:00"
AS_OF = "2024-06-01 00:00:00"
CLOSED = "F"  # status of a closed order in the test table
OFFERS = 4  # suppliers that offer a part


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_count(spark: SparkSession, sf_dir: str, name: str) -> Column:
    """The number of rows of a table as a scalar subquery."""
    return table(spark, sf_dir, name).agg(F.count("*").alias("n")).scalar()


def status() -> Column:
    return (
        F.when(F.col("o_orderstatus") == CLOSED, "CLOSED")
        .when(F.col("o_orderstatus") == "P", "CANCELLED")
        .otherwise("COOKING")
    )


def money(column: str) -> Column:
    return F.col(column).cast("decimal(14,2)")


def share(column: str) -> Column:
    """A rate of two decimals; the data has negative zeros."""
    return F.abs(F.col(column)).cast("decimal(4,2)")


# -- warehouse tables, keyed by the test tables' own numbers -------------------


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = row_count(spark, sf_dir, "supplier")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        text("o_orderkey").alias("order_key"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_custkey").alias("user_id"),
        F.pmod("o_orderkey", n).alias("restaurant_id"),
        second_number(F.col("o_orderdate")).alias("timestamp_id"),
    )


def timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("ts")).distinct()
    return calendar_parts(days).withColumn("id", second_number(F.col("ts")))


def restaurants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers; one with a debt is no longer active."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"),
        text("s_suppkey").alias("restaurant_id"),
        F.col("s_name").alias("restaurant_name"),
        F.when(F.col("s_acctbal") < 0, F.lit(LOAD_TS).cast("timestamp_ntz"))
        .otherwise(open_end())
        .alias("active_to"),
    )


def always_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    return restaurants(spark, sf_dir).withColumn("active_to", open_end())


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity = F.col("l_quantity").cast("int")
    price = money("l_extendedprice")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        quantity.alias("count"),
        price.cast("decimal(19,5)").alias("price"),
        (quantity * price).cast("decimal(19,5)").alias("total_sum"),
        (price * share("l_discount")).cast("decimal(19,5)").alias("bonus_payment"),
        (price * share("l_tax")).cast("decimal(19,5)").alias("bonus_grant"),
    )


def _delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed orders with the rate and the amounts of their delivery."""
    hundredth = F.lit("0.01").cast("decimal(2,2)")
    thousandth = F.lit("0.001").cast("decimal(3,3)")
    return (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_orderstatus") == CLOSED)
        .withColumn("rate", (F.pmod("o_orderkey", F.lit(5)) + 1).cast("int"))
        .withColumn("order_sum", (money("o_totalprice") * hundredth).cast("decimal(14,5)"))
        .withColumn("tip_sum", (money("o_totalprice") * thousandth).cast("decimal(14,5)"))
    )


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _delivered(spark, sf_dir).select(
        F.col("o_orderkey").alias("delivery_id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("courier_id"),
        F.col("o_orderpriority").alias("address"),
        "rate",
        "order_sum",
        "tip_sum",
    )


# -- source rows and staged documents -----------------------------------------


def source_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("login"),
        F.lit(LOAD_TS).cast("timestamp_ntz").alias("update_ts"),
    )


def source_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("int").alias("id"), text("user_id").alias("order_user_id")
    )


def source_restaurants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers with the parts they offer.

    A part is offered by four suppliers in a row, so a menu holds four times
    the parts per supplier, whatever the sales look like.
    """
    n = row_count(spark, sf_dir, "supplier")
    offers = (
        table(spark, sf_dir, "part")
        .withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(OFFERS - 1))))
        .select(
            F.pmod(F.col("p_partkey") + F.col("step"), n).alias("s_suppkey"),
            F.struct(
                F.col("p_partkey").alias("_id"),
                F.col("p_name").alias("name"),
                money("p_retailprice").alias("price"),
                F.col("p_type").alias("category"),
            ).alias("item"),
        )
    )
    menus = offers.groupBy("s_suppkey").agg(F.sort_array(F.collect_list("item")).alias("menu"))
    suppliers = table(spark, sf_dir, "supplier")
    # All menus together are as large as the offers: they are merged, not broadcast.
    return suppliers.join(menus.hint("merge"), "s_suppkey", "left").select(
        F.col("s_suppkey").alias("_id"),
        F.col("s_name").alias("name"),
        F.coalesce("menu", F.array().cast(menus.schema["menu"].dataType)).alias("menu"),
        F.lit(LOAD_TS).cast("timestamp_ntz").alias("update_ts"),
    )


def source_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = row_count(spark, sf_dir, "supplier")
    item = F.struct(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("name"),
        money("o_totalprice").alias("price"),
        F.lit(1).alias("quantity"),
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("_id"),
        F.lit(0).cast("decimal(19,5)").alias("bonus_grant"),
        F.lit(0).cast("decimal(19,5)").alias("bonus_payment"),
        money("o_totalprice").cast("decimal(19,5)").alias("cost"),
        F.col("o_orderdate").alias("date"),
        status().alias("final_status"),
        F.array(item).alias("order_items"),
        money("o_totalprice").cast("decimal(19,5)").alias("payment"),
        F.struct(F.pmod("o_orderkey", n).alias("id")).alias("restaurant"),
        F.array(
            F.struct(status().alias("status"), F.col("o_orderdate").alias("dttm"))
        ).alias("statuses"),
        F.struct(F.col("o_custkey").alias("id")).alias("user"),
        F.col("o_orderdate").alias("update_ts"),
    )


def source_couriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        text("c_custkey").alias("_id"), F.col("c_name").alias("name")
    )


def source_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed orders, brought on the day after the order."""
    arrived = F.col("o_orderdate") + F.expr("interval 1 day")
    return _delivered(spark, sf_dir).select(
        text("o_orderkey").alias("order_id"),
        text("o_orderdate").alias("order_ts"),
        F.concat(F.lit("d"), text("o_orderkey")).alias("delivery_id"),
        text("o_custkey").alias("courier_id"),
        F.col("o_orderpriority").alias("address"),
        text(arrived).alias("delivery_ts"),
        "rate",
        F.col("order_sum").alias("sum"),
        "tip_sum",
    )


def source_outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bonus transaction per line item; numbers are quoted, as in the source, but for the grant.

    The grant is a JSON number and loses its fraction; quoted, a fraction would be refused.
    """
    price = money("l_extendedprice")
    line = F.struct(
        text("l_partkey").alias("product_id"),
        text(price).alias("price"),
        text(F.col("l_quantity").cast("int")).alias("quantity"),
        text(price * share("l_discount")).alias("bonus_payment"),
        (price * share("l_tax")).alias("bonus_grant"),
    )
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("int").alias("id"),
        F.col("l_shipdate").alias("event_ts"),
        F.when(F.col("l_returnflag") == "R", "user_rank")
        .otherwise("bonus_transaction")
        .alias("event_type"),
        document(order_id=text("l_orderkey"), product_payments=F.array(line)).alias("event_value"),
    )


class Market:
    """Staged documents and numbered dimensions of one folder of test tables.

    Every table is made once per instance, however many others look it up.
    Documents that several loads read are pinned, as the staged tables they
    stand for would be.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.at = (spark, sf_dir)

    @cached_property
    def staged_users(self) -> DataFrame:
        return staging.user_documents(source_users(*self.at))

    @cached_property
    def staged_restaurants(self) -> DataFrame:
        return pin(staging.restaurant_documents(source_restaurants(*self.at)))

    @cached_property
    def staged_orders(self) -> DataFrame:
        return pin(staging.order_documents(source_orders(*self.at)))

    @cached_property
    def staged_couriers(self) -> DataFrame:
        return staging.named_documents(source_couriers(*self.at), LOAD_TS)

    @cached_property
    def staged_deliveries(self) -> DataFrame:
        return pin(staging.delivery_documents(source_deliveries(*self.at), LOAD_TS))

    @cached_property
    def staged_events(self) -> DataFrame:
        return staging.bonus_events(source_outbox(*self.at))

    @cached_property
    def dm_users(self) -> DataFrame:
        accounts = staging.bonus_users(source_accounts(*self.at))
        rows = dimensions.users(self.staged_users, accounts)
        last = last_per_key(rows, ["user_id"], ["update_ts"]).drop("update_ts")
        return numbered(last, ["user_id"])

    @cached_property
    def dm_restaurants(self) -> DataFrame:
        return numbered(dimensions.restaurants(self.staged_restaurants), ["restaurant_id"])

    @cached_property
    def dm_couriers(self) -> DataFrame:
        return numbered(dimensions.couriers(self.staged_couriers), ["courier_id"])

    @cached_property
    def dm_timestamps(self) -> DataFrame:
        return numbered(dimensions.timestamps(self.staged_orders, self.staged_deliveries), ["ts"])

    @cached_property
    def dm_products(self) -> DataFrame:
        rows = dimensions.products(self.staged_restaurants, self.dm_restaurants)
        typed = quality.conform(rows, TABLES["dds.dm_products"].columns)
        return numbered(typed, ["restaurant_id", "product_id"])

    @cached_property
    def dm_orders(self) -> DataFrame:
        rows = dimensions.orders(
            self.staged_orders, self.dm_users, self.dm_restaurants, self.dm_timestamps
        )
        return numbered(rows, ["order_key"])

    @cached_property
    def found_deliveries(self) -> DataFrame:
        return pin(
            dimensions.deliveries(
                self.staged_deliveries, self.dm_timestamps, self.dm_couriers, self.dm_orders
            )
        )

    @cached_property
    def dm_deliveries(self) -> DataFrame:
        """Deliveries with all lookups found; the rules reject the others."""
        good, _ = quality.validate(self.found_deliveries, "dds.dm_deliveries")
        return numbered(good, ["delivery_id"])


def numbered(rows: DataFrame, key: list[str]) -> DataFrame:
    """Rows with a surrogate key; pinned, since numbering reads them twice."""
    return number_rows(pin(rows), key)
