"""Sorted pages of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.operators.numbering import number_rows


def page(df: DataFrame, order: list[str], offset: int, limit: int) -> DataFrame:
    """One page in ``order`` (end it with a unique column).

    For the first pages; every task keeps offset + limit rows.  To walk a whole
    table use :func:`pages`.
    """
    return df.orderBy(*order).offset(offset).limit(limit)


def pages(df: DataFrame, order: list[str], size: int) -> DataFrame:
    """All rows with the number of their page (from 0) and their place on it (from 1)."""
    numbered = number_rows(df, list(order), into="_n")
    at = F.col("_n") - 1
    return numbered.select(
        *df.columns,
        F.floor(at / F.lit(size)).alias("page_no"),
        (at % F.lit(size) + 1).alias("place"),
    )
