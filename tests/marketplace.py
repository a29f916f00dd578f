"""Small hand-made sources with known results."""

from __future__ import annotations

import datetime as dt

from larder.plans.runs import RunSettings

UPDATED = dt.datetime(2023, 3, 1, 8, 0, 0)

ORDER_ROW = (
    "_id string, bonus_grant decimal(19,5), bonus_payment decimal(19,5), cost decimal(19,5),"
    " date string, final_status string,"
    " order_items array<struct<id string, name string, price string, quantity string>>,"
    " payment decimal(19,5), restaurant struct<id string>,"
    " statuses array<struct<status string, dttm string>>, user struct<id string>,"
    " update_ts timestamp_ntz"
)
RESTAURANT_ROW = (
    "_id string, name string, menu array<struct<_id string, name string, price string,"
    " category string>>, update_ts timestamp_ntz"
)
DELIVERY_ROW = (
    "order_id string, order_ts string, delivery_id string, courier_id string, address string,"
    " delivery_ts string, rate int, sum decimal(14,5), tip_sum decimal(14,5)"
)
USER_ROW = "_id string, name string, login string, update_ts timestamp_ntz"
OUTBOX_ROW = "id int, event_ts timestamp_ntz, event_type string, event_value string"

SETTINGS = RunSettings(
    load_ts="2023-04-01 00:00:00", run_date=dt.date(2023, 4, 1), as_of="2023-04-01 00:00:00"
)


def order(key, status, restaurant, user, date, updated=UPDATED):
    return (
        key, None, None, None, date, status,
        [("p1", "Борщ", "10", "1")], None, (restaurant,), [(status, date)], (user,), updated,
    )


def payment(order_id, *lines):
    items = ", ".join(
        f'{{"product_id": "{product}", "price": {price}, "quantity": {quantity},'
        f' "bonus_payment": {paid}, "bonus_grant": {granted}}}'
        for product, price, quantity, paid, granted in lines
    )
    return f'{{"order_id": "{order_id}", "product_payments": [{items}]}}'


def sources(spark, deliveries=()):
    at = dt.datetime(2023, 3, 12, 12, 0, 0)
    frame = spark.createDataFrame
    return {
        "ranks": frame(
            [(1, "bronze", None, None)],
            "id int, name string, bonus_percent decimal(19,5),"
            " min_payment_threshold decimal(19,5)",
        ).selectExpr(
            "id", "name", "1.5BD as bonus_percent", "100BD as min_payment_threshold"
        ),
        "users": frame([(1, "u1"), (2, "u2"), (3, "u1")], "id int, order_user_id string"),
        "outbox": frame(
            [
                (1, at, "bonus_transaction", payment("o1", ("p2", '"5.5"', '"2"', "1.25", "0"))),
                (2, at, "bonus_transaction", payment("o2", ("p1", "10", "1", "0", "1"))),
                (3, at, "bonus_transaction", payment("o3", ("p3", "7", "1", "0", "0"))),
                (4, at, "user_rank", payment("o1", ("p2", "5.5", "9", "0", "0"))),
                (5, at, "bonus_transaction", payment("o5")),
            ],
            OUTBOX_ROW,
        ),
        "order_users": frame(
            [
                ("u1", "Аня", "anya", UPDATED),
                ("u2", "O'Neil", "oneil", UPDATED),
                ("u9", "Nobody", "nobody", UPDATED),
            ],
            USER_ROW,
        ),
        "order_restaurants": frame(
            [
                ("r1", "Пельменная", [("p1", "Борщ", "10", "soup"), ("p2", "Чай", "5.50", "tea")],
                 UPDATED),
                ("r2", "Joe's", [("p3", "Cake", "7", "sweet"), ("p1", "Борщ", "11", "soup")],
                 UPDATED),
                ("r3", "Empty", [], UPDATED),
            ],
            RESTAURANT_ROW,
        ),
        "orders": frame(
            [
                order("o1", "CLOSED", "r1", "u1", "2023-03-10 10:00:00.900000"),
                order("o2", "CLOSED", "r1", "u2", "2023-03-10 12:00:00"),
                order("o3", "CANCELLED", "r2", "u1", "2023-03-11 09:00:00"),
                order("o4", "COOKING", "r2", "u2", "2023-03-12 08:00:00"),
                order("o5", "CLOSED", "r2", "u2", "2023-03-12 09:30:00"),
                order("o6", "CLOSED", "r1", "u9", "2023-03-12 10:00:00"),
            ],
            ORDER_ROW,
        ),
        "api_restaurants": frame([("r1", "Пельменная")], "_id string, name string"),
        "api_couriers": frame([("c1", "Иван"), ("c2", "Bob")], "_id string, name string"),
        "api_deliveries": frame(list(deliveries), DELIVERY_ROW),
    }
