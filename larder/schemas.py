"""Every warehouse table: columns, key and rules.

Types are Spark DDL names.  Columns are all NOT NULL.  ``checks`` are SQL
predicates that a row must not violate (NULL passes, as in a SQL CHECK); a
``{bound}`` placeholder takes its value from :data:`BOUNDS` or from the caller.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Limits on dates, periods and amounts.
BOUNDS = {
    "settlement_after": "2022-01-01",
    "settlement_before": "2500-01-01",
    "ledger_year_after": 2022,
    "ledger_year_before": 2500,
    "timestamp_year_from": 2022,
    "timestamp_year_before": 2500,
    "price_max": "999000000000.99",
}


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str = "id"


@dataclass(frozen=True)
class Table:
    name: str
    columns: dict[str, str]
    key: tuple[str, ...]
    surrogate: str | None = "id"
    lengths: dict[str, int] = field(default_factory=dict)
    checks: dict[str, str] = field(default_factory=dict)
    foreign: tuple[ForeignKey, ...] = ()
    json: tuple[str, ...] = ()

    @property
    def ddl(self) -> str:
        return ", ".join(f"{name} {kind}" for name, kind in self.columns.items())

    @property
    def payload(self) -> list[str]:
        """Columns a load provides: all but the surrogate key."""
        return [name for name in self.columns if name != self.surrogate]


def _at_least_zero(*columns: str) -> dict[str, str]:
    return {f"{column}_not_negative": f"{column} >= 0" for column in columns}


def _documents(name: str, id_length: int | None) -> Table:
    return Table(
        name,
        {
            "id": "bigint",
            "object_id": "string",
            "object_value": "string",
            "update_ts": "timestamp_ntz",
        },
        key=("object_id",),
        lengths={"object_id": id_length} if id_length else {},
        json=("object_value",),
    )


def _load_state(name: str) -> Table:
    return Table(
        name,
        {"id": "bigint", "workflow_key": "string", "workflow_settings": "string"},
        key=("workflow_key",),
        json=("workflow_settings",),
    )


_TABLES = [
    # staged copies of the sources
    Table(
        "stg.bonussystem_ranks",
        {
            "id": "int",
            "name": "string",
            "bonus_percent": "decimal(19,5)",
            "min_payment_threshold": "decimal(19,5)",
        },
        key=("id",),
        surrogate=None,
        lengths={"name": 2048},
    ),
    Table(
        "stg.bonussystem_users",
        {"id": "int", "order_user_id": "string"},
        key=("id",),
        surrogate=None,
    ),
    Table(
        "stg.bonussystem_events",
        {
            "id": "int",
            "event_ts": "timestamp_ntz",
            "event_type": "string",
            "event_value": "string",
        },
        key=("id",),
        surrogate=None,
        json=("event_value",),
    ),
    _documents("stg.ordersystem_users", 2048),
    _documents("stg.ordersystem_orders", 2048),
    _documents("stg.ordersystem_restaurants", 2048),
    _documents("stg.deliverysystem_restaurants", None),
    _documents("stg.deliverysystem_couriers", None),
    _documents("stg.deliverysystem_deliveries", None),
    _load_state("stg.srv_wf_settings"),
    # dimensions and facts
    Table(
        "dds.dm_users",
        {"id": "bigint", "user_id": "string", "user_name": "string", "user_login": "string"},
        key=("user_id",),
    ),
    Table(
        "dds.dm_restaurants",
        {
            "id": "bigint",
            "restaurant_id": "string",
            "restaurant_name": "string",
            "active_from": "timestamp_ntz",
            "active_to": "timestamp_ntz",
        },
        key=("restaurant_id",),
    ),
    Table(
        "dds.dm_couriers",
        {
            "id": "bigint",
            "courier_id": "string",
            "courier_name": "string",
            "active_from": "timestamp_ntz",
            "active_to": "timestamp_ntz",
        },
        key=("courier_id",),
    ),
    Table(
        "dds.dm_products",
        {
            "id": "bigint",
            "restaurant_id": "bigint",
            "product_id": "string",
            "product_name": "string",
            "product_price": "decimal(14,2)",
            "active_from": "timestamp_ntz",
            "active_to": "timestamp_ntz",
        },
        key=("restaurant_id", "product_id"),
        checks={
            "price_not_negative": "product_price >= 0",
            "price_within_limit": "product_price <= {price_max}",
        },
        foreign=(ForeignKey("restaurant_id", "dds.dm_restaurants"),),
    ),
    Table(
        "dds.dm_timestamps",
        {
            "id": "bigint",
            "ts": "timestamp_ntz",
            "year": "int",
            "month": "int",
            "day": "int",
            "time": "string",
            "date": "date",
        },
        key=("ts",),
        checks={
            "year_in_range": "year >= {timestamp_year_from} and year < {timestamp_year_before}",
            "month_in_range": "month between 1 and 12",
            "day_in_range": "day between 1 and 31",
        },
    ),
    Table(
        "dds.dm_orders",
        {
            "id": "bigint",
            "order_key": "string",
            "order_status": "string",
            "user_id": "bigint",
            "restaurant_id": "bigint",
            "timestamp_id": "bigint",
        },
        key=("order_key",),
        foreign=(
            ForeignKey("user_id", "dds.dm_users"),
            ForeignKey("restaurant_id", "dds.dm_restaurants"),
            ForeignKey("timestamp_id", "dds.dm_timestamps"),
        ),
    ),
    Table(
        "dds.dm_deliveries",
        {
            "id": "bigint",
            "delivery_id": "string",
            "timestamp_id": "bigint",
            "courier_id": "bigint",
            "order_id": "bigint",
        },
        key=("delivery_id",),
        foreign=(
            ForeignKey("timestamp_id", "dds.dm_timestamps"),
            ForeignKey("courier_id", "dds.dm_couriers"),
            ForeignKey("order_id", "dds.dm_orders"),
        ),
    ),
    Table(
        "dds.fct_product_sales",
        {
            "id": "bigint",
            "product_id": "bigint",
            "order_id": "bigint",
            "count": "int",
            "price": "decimal(19,5)",
            "total_sum": "decimal(19,5)",
            "bonus_payment": "decimal(19,5)",
            "bonus_grant": "decimal(19,5)",
        },
        key=("product_id", "order_id"),
        checks=_at_least_zero("count", "price", "total_sum", "bonus_payment", "bonus_grant"),
        foreign=(
            ForeignKey("product_id", "dds.dm_products"),
            ForeignKey("order_id", "dds.dm_orders"),
        ),
    ),
    Table(
        "dds.fct_deliveries",
        {
            "id": "bigint",
            "delivery_id": "bigint",
            "order_id": "bigint",
            "courier_id": "bigint",
            "address": "string",
            "rate": "int",
            "order_sum": "decimal(14,5)",
            "tip_sum": "decimal(14,5)",
        },
        key=("delivery_id",),
        checks=_at_least_zero("rate", "order_sum", "tip_sum"),
        foreign=(
            ForeignKey("order_id", "dds.dm_orders"),
            ForeignKey("courier_id", "dds.dm_couriers"),
            ForeignKey("delivery_id", "dds.dm_deliveries"),
        ),
    ),
    _load_state("dds.srv_wf_settings"),
    # marts
    Table(
        "cdm.dm_settlement_report",
        {
            "id": "bigint",
            "restaurant_id": "string",
            "restaurant_name": "string",
            "settlement_date": "date",
            "orders_count": "int",
            "orders_total_sum": "decimal(14,2)",
            "orders_bonus_payment_sum": "decimal(14,2)",
            "orders_bonus_granted_sum": "decimal(14,2)",
            "order_processing_fee": "decimal(14,2)",
            "restaurant_reward_sum": "decimal(14,2)",
        },
        key=("restaurant_id", "settlement_date"),
        lengths={"restaurant_id": 250, "restaurant_name": 250},
        checks={
            "settlement_date_in_range": (
                "settlement_date > date '{settlement_after}'"
                " and settlement_date < date '{settlement_before}'"
            ),
            **_at_least_zero(
                "orders_count",
                "orders_total_sum",
                "orders_bonus_payment_sum",
                "orders_bonus_granted_sum",
                "order_processing_fee",
                "restaurant_reward_sum",
            ),
        },
    ),
    Table(
        "cdm.dm_courier_ledger",
        {
            "id": "bigint",
            "courier_id": "string",
            "settlement_year": "int",
            "settlement_month": "int",
            "order_count": "int",
            "orders_total_sum": "decimal(14,5)",
            "rate_avg": "int",
            "order_processing_fee": "decimal(14,5)",
            "courier_order_sum": "decimal(14,5)",
            "courier_tips_sum": "decimal(14,5)",
            "courier_reward_sum": "decimal(14,5)",
        },
        key=("courier_id", "settlement_year", "settlement_month"),
        checks={
            "settlement_year_in_range": (
                "settlement_year > {ledger_year_after} and settlement_year < {ledger_year_before}"
            ),
            "settlement_month_in_range": "settlement_month > 0 and settlement_month <= 12",
            **_at_least_zero(
                "order_count",
                "orders_total_sum",
                "order_processing_fee",
                "courier_order_sum",
                "courier_tips_sum",
                "courier_reward_sum",
            ),
        },
    ),
]

TABLES = {table.name: table for table in _TABLES}


def _waiting(name: str) -> Table:
    """Documents that wait for the key of a parent, see ``plans/waiting.py``."""
    return Table(
        name,
        {"id": "bigint", "object_id": "string", "staged_id": "bigint", "parent": "string", "parent_key": "string"},
        key=("object_id",),
    )


def _rolled_up(images: str, totals: str, key: str, group: dict[str, str], sums: dict[str, str], more: dict[str, str]) -> list[Table]:
    """What a mart load has counted last and the sums per group, see ``operators/rollup.py``."""
    return [
        Table(images, {"id": "bigint", key: "bigint", **group, **sums, **more}, key=(key,)),
        Table(totals, {"id": "bigint", **group, **sums}, key=tuple(group)),
    ]


_SUM = "decimal(29,5)"

#: Tables of the loads themselves, made when a load first needs them.
WORKING_TABLES = {
    table.name: table
    for table in [
        _waiting("wait.dm_users"),
        _waiting("wait.dm_orders"),
        _waiting("wait.dm_deliveries"),
        _waiting("wait.fct_deliveries"),
        *_rolled_up(
            "sum.settlement_orders",
            "sum.settlement_days",
            "order_id",
            {"restaurant_id": "bigint", "date": "date"},
            {"orders": "bigint", "with_sales": "bigint", "total": _SUM, "payment": _SUM, "granted": _SUM},
            {"sale_buckets": "array<bigint>"},
        ),
        *_rolled_up(
            "sum.courier_deliveries",
            "sum.courier_months",
            "delivery_id",
            {"courier_id": "bigint", "year": "int", "month": "int"},
            {"orders": "bigint", "rated": "bigint", "rate_sum": "bigint", "total": _SUM, "tips": _SUM},
            {"order_id": "bigint"},
        ),
    ]
}

ALL_TABLES = {**TABLES, **WORKING_TABLES}

# Shapes of the staged JSON.  Only the fields a load reads are declared, so the
# parser skips the rest; numbers that may be quoted are strings, cast later.
NAMED = "name string"
USER = "name string, login string"
MENU = "menu array<struct<_id string, name string, price string, category string>>"
ORDER = "date string, final_status string, restaurant struct<id: string>, user struct<id: string>"
DELIVERY = (
    "delivery_id string, courier_id string, delivery_ts string, address string,"
    " rate string, sum string, tip_sum string"
)
PAYMENTS = (
    "order_id string, product_payments array<struct<product_id string, price string,"
    " quantity string, bonus_payment string, bonus_grant variant>>"
)
