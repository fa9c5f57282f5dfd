"""Checks that a staged table must pass before it is published.

A check takes the staged rows and gives rows that say what is wrong; none if nothing is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pricetide.operators.conform import misfits
from pricetide.operators.dedupe import unique_violations

Check = Callable[[DataFrame], DataFrame]


def unique(*keys: str) -> Check:
    """No two rows share these keys."""

    def unique_keys(df: DataFrame) -> DataFrame:
        return unique_violations(df, keys)

    return unique_keys


def fits(schema: StructType) -> Check:
    """Every value has a place in the columns of ``schema``: none is lost, no text too long."""

    def fitting_values(df: DataFrame) -> DataFrame:
        return misfits(df, schema).where("n_lost + n_too_long > 0")

    return fitting_values


def filled(*columns: str) -> Check:
    """No nulls in these columns."""

    def filled_columns(df: DataFrame) -> DataFrame:
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null")) for c in columns]
        return counts.select(F.inline(F.array(*pairs))).where("n_null > 0")

    return filled_columns


def at_least(rows: int) -> Check:
    """As many rows as this, or more."""

    def enough_rows(df: DataFrame) -> DataFrame:
        return df.agg(F.count("*").alias("n_rows")).where(F.col("n_rows") < rows)

    return enough_rows
