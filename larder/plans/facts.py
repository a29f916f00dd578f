"""Fact rows from staged documents, without surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder import schemas
from larder.functions.documents import documents_with, given_whole_number, parsed, rounded_number
from larder.operators.lookup import resolve
from larder.sources.readers import after_ts

# The event with the payments, the status of a completed order.
PAYMENT_EVENT = "bonus_transaction"
CLOSED = "CLOSED"


def payments(events: DataFrame) -> DataFrame:
    """One row per product payment of the bonus transactions."""
    chosen = after_ts(events, column="event_ts").filter(F.col("event_type") == PAYMENT_EVENT)
    docs = parsed(chosen, "event_value", schemas.PAYMENTS)
    lines = docs.filter("doc.order_id IS NOT NULL").select(
        F.col("doc.order_id").alias("order_source_id"),
        F.explode("doc.product_payments").alias("line"),
    )
    return lines.select(
        "order_source_id",
        F.col("line.product_id").alias("product_source_id"),
        F.col("line.price").try_cast("decimal(19,5)").alias("price"),
        rounded_number(F.col("line.quantity")).alias("count"),
        F.col("line.bonus_payment").try_cast("decimal(19,5)").alias("bonus_payment"),
        given_whole_number(F.col("line.bonus_grant")).cast("decimal(19,5)").alias("bonus_grant"),
    )


def broken_payments(events: DataFrame) -> DataFrame:
    """Bonus transactions without an order or without a list of payments; an empty list is one."""
    chosen = after_ts(events, column="event_ts").filter(F.col("event_type") == PAYMENT_EVENT)
    docs = parsed(chosen, "event_value", schemas.PAYMENTS)
    reason = F.when(F.col("doc.product_payments").isNull(), "array: product_payments").otherwise("null: order_id")
    lacking = docs.filter("doc.product_payments IS NULL OR doc.order_id IS NULL")
    return documents_with(lacking, "id", "event_value", reason)


def product_sales(
    events: DataFrame,
    dm_products: DataFrame,
    dm_orders: DataFrame,
    match_restaurant: bool = False,
) -> DataFrame:
    """Sales of closed orders.

    By default a sale matches every product with its product id, also those of
    other restaurants.  ``match_restaurant`` takes the restaurant of the order
    into account.
    """
    closed = dm_orders.filter(F.col("order_status") == CLOSED)
    taken = {"order_id": "id"}
    product_key = {"product_source_id": "product_id"}
    if match_restaurant:
        taken["order_restaurant"] = "restaurant_id"
        product_key["order_restaurant"] = "restaurant_id"
    # Orders first: sales of other orders are gone before products multiply rows.
    sales = resolve(payments(events), closed, {"order_source_id": "order_key"}, taken, large=True)
    sales = resolve(sales, dm_products, product_key, {"product_id": "id"}, large=True)
    return sales.select(
        "product_id",
        "order_id",
        "count",
        "price",
        (F.col("count") * F.col("price")).alias("total_sum"),
        "bonus_payment",
        "bonus_grant",
    )


def sales_fanout(events: DataFrame, dm_products: DataFrame) -> DataFrame:
    """Per product id: sales lines, restaurants that offer it, and matching rows.

    Counted on both sides before the join, so no pair of rows is built.
    """
    lines = payments(events).groupBy("product_source_id").agg(F.count("*").alias("sale_lines"))
    offers = dm_products.groupBy("product_id").agg(F.count("*").alias("offers")).hint("merge")
    both = lines.join(offers, lines["product_source_id"] == offers["product_id"])
    return both.select(
        "product_id", "sale_lines", "offers", (F.col("sale_lines") * F.col("offers")).alias("matches")
    )


def deliveries(staged: DataFrame, dm_deliveries: DataFrame) -> DataFrame:
    """Amounts and rate of every delivery with the keys of its dimension row."""
    return named_deliveries(staged, dm_deliveries).drop("delivery_source_id")


def named_deliveries(staged: DataFrame, dm_deliveries: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The same with the delivery that the document names; ``keep`` are further staged columns."""
    docs = parsed(after_ts(staged), "object_value", schemas.DELIVERY)
    found = docs.select(
        *map(F.expr, keep),
        F.col("doc.delivery_id").alias("delivery_source_id"),
        F.col("doc.address").alias("address"),
        rounded_number(F.col("doc.rate")).alias("rate"),
        F.col("doc.sum").try_cast("decimal(14,5)").alias("order_sum"),
        F.col("doc.tip_sum").try_cast("decimal(14,5)").alias("tip_sum"),
    )
    return resolve(
        found,
        dm_deliveries,
        {"delivery_source_id": "delivery_id"},
        {"delivery_id": "id", "order_id": "order_id", "courier_id": "courier_id"},
        "left",
    )
