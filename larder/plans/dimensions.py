"""Dimension rows from staged documents, without surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder import schemas
from larder.functions.calendar import calendar_parts
from larder.functions.documents import documents_with, moment, open_end, parsed, text, to_second
from larder.operators.lookup import resolve
from larder.sources.readers import FIRST_ID, after_id, after_ts

# Statuses of finished orders.
FINISHED = ("CANCELLED", "CLOSED")

USER_FIELDS = ("object_id AS user_id", "doc.name AS user_name", "doc.login AS user_login", "update_ts")


def users(order_users: DataFrame, bonus_users: DataFrame) -> DataFrame:
    """Order-system users that have a bonus account.

    Several accounts of one user collapse on the user's key, so the join is a
    test for existence; the accounts are reduced to their keys beforehand.
    """
    accounts = after_id(bonus_users, FIRST_ID).select("order_user_id").distinct()
    docs = parsed(after_ts(order_users), "object_value", schemas.USER)
    return docs.join(accounts, docs["object_id"] == accounts["order_user_id"], "left_semi").selectExpr(*USER_FIELDS)


def users_and_accounts(order_users: DataFrame, bonus_users: DataFrame, keep: Sequence[str]) -> DataFrame:
    """All users with their account, NULL if there is none; ``keep`` are further staged columns."""
    accounts = after_id(bonus_users, FIRST_ID).select(F.col("order_user_id").alias("account")).distinct()
    docs = parsed(after_ts(order_users), "object_value", schemas.USER).selectExpr(*keep, *USER_FIELDS)
    return docs.join(accounts, docs["user_id"] == accounts["account"], "left")


def _named(staged: DataFrame, prefix: str) -> DataFrame:
    docs = parsed(after_ts(staged), "object_value", schemas.NAMED)
    return docs.select(
        F.col("object_id").alias(f"{prefix}_id"),
        F.col("doc.name").alias(f"{prefix}_name"),
        F.col("update_ts").alias("active_from"),
        open_end().alias("active_to"),
    )


def restaurants(staged: DataFrame) -> DataFrame:
    return _named(staged, "restaurant")


def couriers(staged: DataFrame) -> DataFrame:
    return _named(staged, "courier")


def timestamps(orders: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Distinct seconds of finished orders and of deliveries, with their parts."""
    order_docs = parsed(after_ts(orders), "object_value", schemas.ORDER)
    delivery_docs = parsed(after_ts(deliveries), "object_value", schemas.DELIVERY)
    ordered = order_docs.filter(F.col("doc.final_status").isin(*FINISHED)).select(
        to_second(moment("doc.date")).alias("ts")
    )
    delivered = delivery_docs.select(to_second(moment("doc.delivery_ts")).alias("ts"))
    return calendar_parts(ordered.unionByName(delivered).distinct())


def menu_items(staged: DataFrame) -> DataFrame:
    """One row per entry of a restaurant's menu; an empty menu gives none."""
    docs = parsed(after_ts(staged), "object_value", schemas.MENU)
    entries = docs.select(
        F.col("object_id").alias("restaurant_source_id"),
        F.explode("doc.menu").alias("item"),
        F.col("update_ts").alias("active_from"),
    )
    return entries.select(
        "restaurant_source_id",
        text("item._id").alias("product_id"),
        F.col("item.name").alias("product_name"),
        # Prices pass through a float on their way to two decimals.
        F.col("item.price").try_cast("double").alias("product_price"),
        "active_from",
        open_end().alias("active_to"),
    )


def broken_menus(staged: DataFrame) -> DataFrame:
    """Restaurants whose document has no menu; an empty menu is one."""
    docs = parsed(after_ts(staged), "object_value", schemas.MENU)
    return documents_with(docs.filter("doc.menu IS NULL"), "object_id", "object_value", "array: menu")


def broken_orders(staged: DataFrame) -> DataFrame:
    """Orders without a readable moment."""
    docs = parsed(after_ts(staged), "object_value", schemas.ORDER)
    return documents_with(docs.filter(moment("doc.date").isNull()), "object_id", "object_value", "time: date")


def products(staged: DataFrame, dm_restaurants: DataFrame) -> DataFrame:
    """Menu entries with the key of their restaurant; unknown restaurants drop out."""
    return resolve(
        menu_items(staged),
        dm_restaurants,
        on={"restaurant_source_id": "restaurant_id"},
        take={"restaurant_id": "id"},
    ).drop("restaurant_source_id")


def orders(
    staged: DataFrame,
    dm_users: DataFrame,
    dm_restaurants: DataFrame,
    dm_timestamps: DataFrame,
) -> DataFrame:
    """Orders whose user, restaurant and moment are all known."""
    return complete_orders(orders_and_parents(staged, dm_users, dm_restaurants, dm_timestamps))


def complete_orders(found: DataFrame) -> DataFrame:
    """The rows of orders whose parents were all found."""
    known = found.filter("user_id IS NOT NULL AND restaurant_id IS NOT NULL AND timestamp_id IS NOT NULL")
    return known.select("order_key", "order_status", "user_id", "restaurant_id", "timestamp_id")


def orders_and_parents(
    staged: DataFrame,
    dm_users: DataFrame,
    dm_restaurants: DataFrame,
    dm_timestamps: DataFrame,
    keep: Sequence[str] = (),
) -> DataFrame:
    """All orders with the ids of their parents, NULL where a parent is unknown; ``keep`` are further staged columns."""
    docs = parsed(after_ts(staged), "object_value", schemas.ORDER)
    found = docs.select(
        *map(F.expr, keep),
        F.col("object_id").alias("order_key"),
        F.col("doc.final_status").alias("order_status"),
        F.col("doc.user.id").alias("user_source_id"),
        F.col("doc.restaurant.id").alias("restaurant_source_id"),
        to_second(moment("doc.date")).alias("ts"),
    )
    found = resolve(found, dm_users, {"user_source_id": "user_id"}, {"user_id": "id"}, "left")
    found = resolve(
        found, dm_restaurants, {"restaurant_source_id": "restaurant_id"}, {"restaurant_id": "id"}, "left"
    )
    return resolve(found, dm_timestamps, {"ts": "ts"}, {"timestamp_id": "id"}, "left")


DELIVERY_ROW = ("delivery_id", "timestamp_id", "courier_id", "order_id")


def deliveries(
    staged: DataFrame,
    dm_timestamps: DataFrame,
    dm_couriers: DataFrame,
    dm_orders: DataFrame,
) -> DataFrame:
    """All deliveries; a lookup without a match leaves NULL for the rules to reject."""
    return deliveries_and_parents(staged, dm_timestamps, dm_couriers, dm_orders).select(*DELIVERY_ROW)


def deliveries_and_parents(
    staged: DataFrame,
    dm_timestamps: DataFrame,
    dm_couriers: DataFrame,
    dm_orders: DataFrame,
    keep: Sequence[str] = (),
) -> DataFrame:
    """All deliveries with what they name and the ids found; ``keep`` are further staged columns."""
    docs = parsed(after_ts(staged), "object_value", schemas.DELIVERY)
    found = docs.select(
        *map(F.expr, keep),
        F.col("doc.delivery_id").alias("delivery_id"),
        F.col("doc.courier_id").alias("courier_source_id"),
        F.col("object_id").alias("order_source_id"),
        to_second(moment("doc.delivery_ts")).alias("ts"),
    )
    found = resolve(found, dm_timestamps, {"ts": "ts"}, {"timestamp_id": "id"}, "left")
    found = resolve(
        found, dm_couriers, {"courier_source_id": "courier_id"}, {"courier_id": "id"}, "left"
    )
    return resolve(found, dm_orders, {"order_source_id": "order_key"}, {"order_id": "id"}, "left")
