"""Staged JSON documents: building, reading and flattening."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN_END = "2099-12-31 00:00:00"  # fixed value: end of an open validity


def text(column: str | Column) -> Column:
    """A value as text, whatever type the source has."""
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def document(**fields: Column | str) -> Column:
    """A JSON object; absent values stay as explicit nulls, text stays UTF-8."""
    parts = [
        (F.col(value) if isinstance(value, str) else value).alias(name)
        for name, value in fields.items()
    ]
    return F.to_json(F.struct(*parts), {"ignoreNullFields": "false"})


def rebuilt(array: str, **fields) -> Column:
    """An array of sub-documents with chosen fields, element order kept.

    Every field is a function of the element.
    """
    return F.transform(
        F.col(array),
        lambda item: F.struct(*[make(item).alias(name) for name, make in fields.items()]),
    )


def parsed(df: DataFrame, column: str, schema: str, into: str = "doc") -> DataFrame:
    """Add the document in ``column`` as a struct of the fields in ``schema``.

    The document goes through an explode of one element: predicates on its
    fields, such as the NOT NULL tests of later joins, then stay above it.
    Pushed below, each of them would parse the text once more.
    """
    return df.select("*", F.explode(F.array(F.from_json(F.col(column), schema))).alias(into))


def documents_with(df: DataFrame, key: str, value: str, reason: str | Column) -> DataFrame:
    """Documents that give no rows, with the reason; see ``quality.DOCUMENT``."""
    found = F.lit(reason) if isinstance(reason, str) else reason
    return df.select(text(key).alias("source_key"), F.col(value).alias("document"), F.array(found).alias("reasons"))


def whole_number(column: Column) -> Column:
    """A number without its fraction, cut towards zero."""
    return F.call_function("div", column.try_cast("decimal(27,9)"), F.lit(1))


def given_whole_number(column: Column) -> Column:
    """A whole number out of a JSON value kept as variant: a number is cut, quoted text must be whole (else NULL)."""
    plain = column.cast("string")
    quoted = F.schema_of_variant(column) == "STRING"
    whole = plain.rlike(r"^\s*[+-]?[0-9]+\s*$")
    return F.when(~quoted | whole, whole_number(plain))


def rounded_number(column: Column) -> Column:
    """A number rounded to an integer, halves away from zero."""
    return column.try_cast("decimal(10,0)").try_cast("int")


def moment(column: Column | str) -> Column:
    """ISO text as a timestamp; text that is no timestamp gives NULL."""
    return (F.col(column) if isinstance(column, str) else column).try_cast("timestamp_ntz")


def to_second(column: Column) -> Column:
    """A timestamp without its fraction of a second, in any session time zone.

    (date_trunc would pass through the session's zone, which has no name for
    the hour that is skipped in spring.)
    """
    fraction = F.date_part(F.lit("SECOND"), column) - F.second(column)
    zero = F.lit(0)
    return column - F.make_dt_interval(zero, zero, zero, fraction)


def open_end() -> Column:
    return F.lit(OPEN_END).cast("timestamp_ntz")
