"""Table rules as one pass over a batch: good rows, and rejected rows with reasons."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.operators.merge import copies_per_key
from larder.schemas import BOUNDS, TABLES, ForeignKey, Table

REASONS = "reasons"

#: A source document that gave no rows: its key and its text.
DOCUMENT = "source_key string, document string"


class RejectedRows(ValueError):
    """Raised in ``abort`` mode when a batch has rows that break a rule."""


def _limits(bounds: Mapping | None) -> dict:
    return {**BOUNDS, **(bounds or {})}


def check_reasons(table: Table, bounds: Mapping | None = None) -> list[Column]:
    limits = _limits(bounds)
    return [
        F.when(F.expr(f"not ({predicate.format(**limits)})"), F.lit(f"check: {name}"))
        for name, predicate in table.checks.items()
    ]


def length_reasons(lengths: Mapping[str, int]) -> list[Column]:
    return [
        F.when(F.length(name) > limit, F.lit(f"length: {name}")) for name, limit in lengths.items()
    ]


def json_reasons(columns: Iterable[str]) -> list[Column]:
    """Text that is no JSON, in columns that hold documents."""
    return [
        F.when(F.col(name).isNotNull() & F.try_parse_json(F.col(name)).isNull(), F.lit(f"json: {name}"))
        for name in columns
    ]


def _largest(kind: str) -> tuple[Decimal, Decimal]:
    """The values from which a number, rounded to ``kind``, no longer fits."""
    if kind == "int":
        half = Decimal("0.5")
        return Decimal(-(2**31)) - half, Decimal(2**31 - 1) + half
    precision, scale = (int(n) for n in kind.removeprefix("decimal(").rstrip(")").split(","))
    edge = Decimal(10) ** (precision - scale) - Decimal(5).scaleb(-scale - 1)
    return -edge, edge


def overflow_reasons(df: DataFrame, columns: Mapping[str, str]) -> list[Column]:
    """Numbers that do not fit the declared type, for columns that come in another type.

    Compared with the type's limits: a cast that fails costs an exception per row.
    """
    incoming = dict(df.dtypes)
    reasons = []
    for name, kind in columns.items():
        if incoming[name] == kind or not (kind == "int" or kind.startswith("decimal")):
            continue
        low, high = _largest(kind)
        outside = (F.col(name) <= F.lit(low)) | (F.col(name) >= F.lit(high))
        reasons.append(F.when(outside, F.lit(f"overflow: {name}")))
    return reasons


def flag(df: DataFrame, reasons: list[Column]) -> DataFrame:
    """Add the array of reasons that apply to a row."""
    return df.withColumn(REASONS, F.array_compact(F.array(*reasons)))


def conform(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Cast to the declared types; decimals are rounded half away from zero."""
    extra = [name for name in df.columns if name not in columns]
    casts = [
        F.col(name).try_cast(kind).alias(name) for name, kind in columns.items() if name in df.columns
    ]
    return df.select(*casts, *extra)


def flag_rows(df: DataFrame, table: Table | str, bounds: Mapping | None = None) -> DataFrame:
    """Row rules of a table: NOT NULL, CHECK, length, JSON and overflow, in one projection.

    Overflow is judged on the values as they come, the other rules after the
    casts, as a database does.
    """
    table = TABLES[table] if isinstance(table, str) else table
    kinds = {name: table.columns[name] for name in table.payload if name in df.columns}
    with_overflow = df.withColumn(
        "_overflow", F.array_compact(F.array(*overflow_reasons(df, kinds)).cast("array<string>"))
    )
    typed = conform(with_overflow, kinds)
    nulls = [
        F.when(
            F.col(name).isNull() & ~F.array_contains("_overflow", f"overflow: {name}"),
            F.lit(f"null: {name}"),
        )
        for name in kinds
    ]
    rules = nulls + check_reasons(table, bounds) + length_reasons(table.lengths)
    found = flag(typed, rules + json_reasons(name for name in table.json if name in kinds))
    return found.withColumn(REASONS, F.concat("_overflow", REASONS)).drop("_overflow")


def orphans(df: DataFrame, foreign: ForeignKey, parent: DataFrame) -> DataFrame:
    """Rows whose foreign key has no parent row (a NULL key is no violation)."""
    keys = parent.select(F.col(foreign.parent_column).alias(foreign.column))
    present = df.filter(F.col(foreign.column).isNotNull())
    return present.join(keys, foreign.column, "left_anti").select(*df.columns)


def flag_orphans(df: DataFrame, foreign: ForeignKey, parent: DataFrame) -> DataFrame:
    """Append a reason to the rows without a parent row."""
    keys = parent.select(
        F.col(foreign.parent_column).alias(foreign.column), F.lit(True).alias("_has_parent")
    )
    missing = F.col(foreign.column).isNotNull() & F.col("_has_parent").isNull()
    reason = F.when(
        missing, F.array(F.lit(f"foreign key: {foreign.column} -> {foreign.parent}"))
    ).otherwise(F.array().cast("array<string>"))
    return (
        df.join(keys, foreign.column, "left")
        .withColumn(REASONS, F.concat(REASONS, reason))
        .select(*df.columns)
    )


def flag_copies(df: DataFrame, key: list[str]) -> DataFrame:
    """Append a reason to all rows of a key that occurs more than once.

    The keys are counted with a map-side combine and joined back, so no task
    holds all rows of a hot key.
    """
    repeated = copies_per_key(df, key).withColumn("_repeated", F.lit(True)).drop("copies")
    reason = F.when(
        F.col("_repeated"), F.array(F.lit(f"duplicate key: {', '.join(key)}"))
    ).otherwise(F.array().cast("array<string>"))
    return (
        df.join(repeated, key, "left")
        .withColumn(REASONS, F.concat(REASONS, reason))
        .select(*df.columns)
    )


def split(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows without the reasons, and rejected rows with them."""
    bad = F.size(REASONS) > 0
    return flagged.filter(~bad).drop(REASONS), flagged.filter(bad)


def validate(
    df: DataFrame,
    table: Table | str,
    parents: Mapping[str, DataFrame] | None = None,
    unique: bool = False,
    bounds: Mapping | None = None,
    on_fail: str = "quarantine",
) -> tuple[DataFrame, DataFrame]:
    """Split a batch by the rules of its target table.

    ``parents`` holds the tables foreign keys point to; keys of other tables
    are not checked.  ``on_fail="abort"`` refuses the whole batch if any row
    breaks a rule.
    """
    table = TABLES[table] if isinstance(table, str) else table
    flagged = flag_rows(df, table, bounds)
    for foreign in table.foreign:
        if parents and foreign.parent in parents:
            flagged = flag_orphans(flagged, foreign, parents[foreign.parent])
    if unique:
        flagged = flag_copies(flagged, list(table.key))
    good, rejected = split(flagged)
    if on_fail == "abort":
        refuse(rejected, table.name)
    return good, rejected


def refuse(rejected: DataFrame, name: str) -> None:
    """Raise if there is any rejected row, naming the reasons and their counts."""
    counts = (
        rejected.select(F.explode(REASONS).alias("reason"))
        .groupBy("reason")
        .agg(F.count("*").alias("n"))
        .collect()  # one row per rule
    )
    if counts:
        listed = ", ".join(f"{row['reason']} ({row['n']})" for row in sorted(counts))
        raise RejectedRows(f"{name}: {listed}")


def unresolved(df: DataFrame, columns: list[str]) -> DataFrame:
    """How many rows lack each looked-up key."""
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    return counts.unpivot([], columns, "lookup", "unresolved_rows")
