"""Rankings over any range of snapshots, from states that are kept for each snapshot.

A state holds what the six measures need and what can be added up: exact decimal sums and
counts, a maximum, and, since an item may come in many snapshots, the set of its items.
Sets are kept in segments by the hash of the item, so a maker of very many items is
many rows. A corrected snapshot replaces its own states; a ranking merges the states of
its dates and reads neither items nor bridges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricetide.functions.numeric import exact, max_exact

#: Parts of the item set of a group.
SEGMENTS = 64
MEANS = {"avg_discount": ("discount_pct", 2), "avg_sale_price": ("sale_price", 2),
         "avg_list_price": ("list_price", 2), "avg_rating": ("rating_pct", 1)}


def rank_states(joined: DataFrame, dims: Sequence[str]) -> DataFrame:
    """One row per snapshot and group: sums and counts of the measures, and the largest discount.

    ``joined`` has one row for each snapshot, group and item, with the item's measures.
    """
    sums = []
    for name, (column, _) in MEANS.items():
        value = exact(F.col(column))
        sums += [F.sum(value).cast("decimal(30,6)").alias(f"{name}_sum"), F.count(value).alias(f"{name}_n")]
    return joined.groupBy("snapshot_date", *dims).agg(*sums, F.max("discount_pct").alias("max_discount"))


def item_sets(joined: DataFrame, dims: Sequence[str], segments: int = SEGMENTS) -> DataFrame:
    """The items of each snapshot and group, in sorted sets, one row per segment of items."""
    segment = F.pmod(F.xxhash64("item_id"), F.lit(segments)).cast("int").alias("segment")
    items = F.array_sort(F.collect_set("item_id")).alias("items")
    return joined.groupBy("snapshot_date", *dims, segment).agg(items)


def _mean(name: str, places: int) -> Column:
    """The mean of merged sums, rounded as the mean of the rows is."""
    total, n = F.sum(f"{name}_sum").cast("decimal(30,6)"), F.sum(f"{name}_n").cast("decimal(12,0)")
    whole = F.when(n > 0, total / n).cast("decimal(32,10)")
    return F.round(whole, places).cast("double").alias(name)


def between(df: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """Snapshots of a range of dates, ends included; without an end it is open."""
    day = F.col("snapshot_date")
    if first is not None:
        df = df.filter(day >= F.lit(first).cast("date"))
    return df if last is None else df.filter(day <= F.lit(last).cast("date"))


def merged_ranking(states: DataFrame, sets: DataFrame, dims: Sequence[str]) -> DataFrame:
    """The six ranking measures of each group over all given snapshots.

    An item counts once, however many snapshots have it; the means are over all its rows.
    Sums, counts and maxima are merged as numbers. Items are counted within segments, which
    share none, and the counts are added up.
    """
    means = {name: _mean(name, places) for name, (_, places) in MEANS.items()}
    measures = states.groupBy(*dims).agg(
        means["avg_discount"], means["avg_sale_price"], means["avg_list_price"],
        max_exact(F.col("max_discount"), 2).alias("max_discount"), means["avg_rating"],
    )
    items = sets.select(*dims, "segment", F.explode("items").alias("item_id"))
    distinct = items.groupBy(*dims, "segment", "item_id").agg(F.count("*").alias("n"))
    counts = distinct.groupBy(*dims).agg(F.count("*").alias("n_items"))
    same = [F.col(f"c.{d}").eqNullSafe(F.col(f"m.{d}")) for d in dims]
    both = measures.alias("m").join(counts.alias("c"), same)
    rest = ("avg_discount", "avg_sale_price", "avg_list_price", "max_discount", "avg_rating")
    return both.select(*[F.col(f"m.{d}") for d in dims], "n_items", *rest)
