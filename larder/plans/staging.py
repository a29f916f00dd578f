"""Source rows as staged rows; payloads are kept as they are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.documents import document, rebuilt, text
from larder.sources.readers import snapshot


def bonus_ranks(ranks: DataFrame) -> DataFrame:
    return snapshot(ranks, ["id", "name", "bonus_percent", "min_payment_threshold"])


def bonus_users(users: DataFrame) -> DataFrame:
    return snapshot(users, ["id", "order_user_id"])


def bonus_events(outbox: DataFrame) -> DataFrame:
    return snapshot(outbox, ["id", "event_ts", "event_type", "event_value"])


def _staged(df: DataFrame, object_id: str, value: Column, update_ts: Column) -> DataFrame:
    return df.select(
        text(object_id).alias("object_id"),
        value.alias("object_value"),
        update_ts.cast("timestamp_ntz").alias("update_ts"),
    )


def user_documents(users: DataFrame) -> DataFrame:
    value = document(name="name", login="login")
    return _staged(users, "_id", value, F.col("update_ts"))


def restaurant_documents(restaurants: DataFrame) -> DataFrame:
    menu = rebuilt(
        "menu",
        _id=lambda item: text(item["_id"]),
        name=lambda item: item["name"],
        price=lambda item: text(item["price"]),
        category=lambda item: item["category"],
    )
    return _staged(restaurants, "_id", document(name="name", menu=menu), F.col("update_ts"))


def order_documents(orders: DataFrame) -> DataFrame:
    items = rebuilt(
        "order_items",
        id=lambda item: text(item["id"]),
        name=lambda item: item["name"],
        price=lambda item: text(item["price"]),
        quantity=lambda item: text(item["quantity"]),
    )
    statuses = rebuilt(
        "statuses",
        status=lambda item: item["status"],
        dttm=lambda item: text(item["dttm"]),
    )
    value = document(
        bonus_grant="bonus_grant",
        bonus_payment="bonus_payment",
        cost="cost",
        date=text("date"),
        final_status="final_status",
        order_items=items,
        payment="payment",
        restaurant=F.struct(text("restaurant.id").alias("id")),
        statuses=statuses,
        user=F.struct(text("user.id").alias("id")),
    )
    return _staged(orders, "_id", value, F.col("update_ts"))


def named_documents(rows: DataFrame, load_ts: str) -> DataFrame:
    """Restaurants and couriers of the delivery service; changed at load time."""
    return _staged(rows, "_id", document(name="name"), F.lit(load_ts))


def delivery_documents(deliveries: DataFrame, load_ts: str) -> DataFrame:
    """Deliveries, kept by the order they belong to."""
    fields = (
        "order_ts",
        "delivery_id",
        "courier_id",
        "address",
        "delivery_ts",
        "rate",
        "sum",
        "tip_sum",
    )
    value = document(**{name: name for name in fields})
    return _staged(deliveries, "order_id", value, F.lit(load_ts))
