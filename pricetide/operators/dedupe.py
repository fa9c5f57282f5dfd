"""Keyed dedupe with a stated survivor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ITEM_KEYS = ("snapshot_date", "item_id")
ARRIVAL = ("ord1", "ord2")


def keep_first(
    df: DataFrame,
    keys: Sequence[str] = ITEM_KEYS,
    order_by: Sequence[str | Column] = ARRIVAL,
) -> DataFrame:
    """One row per key: the first in ``order_by``, which must be total within a key.

    The ``rank = 1`` filter is planned as a group limit before the exchange, so
    each map task sends at most one row per key; a key that holds a third of the
    table costs one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def keep_last(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]
) -> DataFrame:
    """One row per key: the last in ``order_by``."""
    return keep_first(df, keys, [F.desc(c) if isinstance(c, str) else c.desc() for c in order_by])


def unique_violations(df: DataFrame, keys: Sequence[str] = ITEM_KEYS) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)


def require_unique(df: DataFrame, keys: Sequence[str] = ITEM_KEYS) -> DataFrame:
    """``df`` itself; raises if a key repeats, naming a few of them."""
    found = unique_violations(df, keys).take(5)
    if found:
        raise ValueError(f"keys {list(keys)} repeat: {found}")
    return df
