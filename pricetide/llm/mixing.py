"""Mixing sources to target weights by subset-sum budget fitting.

Per source the documents are counted by exact size. Of each size the same share is
taken, rounded down; what is left of the budget is filled with larger sizes first
and, when it is small, exactly by a bounded-knapsack table over the sizes still to
be had. The result says how many documents of each size are taken; a seeded hash
says which.

Only sizes and their counts meet in one task: a source with W words has at most
sqrt(2 W) different sizes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricetide.llm.store import stored
from pricetide.llm.words import pieces

#: What is left for the knapsack table: this many words, or a little more.
EXACT_WORDS = 4_096
#: Documents that are ranked together, about.
RANKED = 128


def fit_counts(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each size come to ``budget`` words, or as near below as possible."""
    order = np.argsort(sizes)
    sizes, counts = sizes[order].astype(np.int64), counts[order].astype(np.int64)
    counts = np.where(sizes > 0, counts, 0)
    total = int((sizes * counts).sum())
    if budget >= total:
        taken = counts.copy()
    else:
        taken = np.array([int(c) * budget // total for c in counts], np.int64)
        left = budget - int((sizes * taken).sum())
        for i in range(len(sizes) - 1, -1, -1):
            if left <= EXACT_WORDS:
                break
            if sizes[i]:
                more = int(min(counts[i] - taken[i], (left - EXACT_WORDS) // sizes[i]))
                taken[i] += more
                left -= more * int(sizes[i])
        for i, more in knapsack(sizes, counts - taken, left):
            taken[i] += more
    back = np.empty_like(taken)
    back[order] = taken
    return back


def knapsack(sizes: np.ndarray, spare: np.ndarray, budget: int) -> list[tuple[int, int]]:
    """(position, number) of a choice whose sum is the largest that is at most ``budget``."""
    reached = np.zeros(budget + 1, bool)
    reached[0] = True
    by = np.full(budget + 1, -1, np.int64)
    pieces: list[tuple[int, int]] = []
    for i in range(len(sizes)):
        size, n, many = int(sizes[i]), int(spare[i]), 1
        if not 0 < size <= budget:
            continue
        n = min(n, budget // size)
        while n > 0 and not reached[budget]:
            many = min(many, n)
            step = size * many
            new = np.flatnonzero(reached[: budget + 1 - step] & ~reached[step:]) + step
            reached[new] = True
            by[new] = len(pieces)
            pieces.append((i, many))
            n, many = n - many, many * 2
        if reached[budget]:
            break
    at, chosen = int(np.flatnonzero(reached)[-1]), []
    while at:
        i, many = pieces[by[at]]
        chosen.append((i, many))
        at -= int(sizes[i]) * many
    return chosen


def word_counts(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size) of every row: the words of the whole text, 0 for null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            # split() of bytes parts words at 0x20 and 0x09 to 0x0D, and nowhere else
            size = pa.array([len(t.split()) if t else 0 for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("source"), size], ["doc_id", "source", "size"]
            )

    slim = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), "text")
    return slim.mapInArrow(run, "doc_id long, source string, size long")


def key_of(source: Column) -> Column:
    """A source as a key that is never null."""
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source))


def targets(histogram: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """One row per source: (key, source_size, target).

    Sources in code-point order, null last, get the weights in turn and share
    ``share`` of all words. A target stops at ``most`` times its source; what that
    leaves goes to the others by weight. The sources that stop are those with the
    least cap per weight, so running sums over that order find them.
    """
    sources = histogram.groupBy("key", "source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(place, F.lit(len(weights))))
    cap = F.lit(most) * F.col("source_size")
    weighed = sources.withColumn("weight", weight).withColumn("cap", cap)
    ordered = Window.orderBy(F.col("cap") / F.col("weight"), "key")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(1))
    none = F.lit(0.0)
    filled = weighed.withColumn(
        "level",
        (
            F.lit(share) * F.sum("source_size").over(every)
            - F.coalesce(F.sum("cap").over(before), none)
        )
        / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), none)),
    )
    # The level rises with each source that stops below it, and falls from the first that does not.
    target = F.least(F.col("cap"), F.col("weight") * F.max("level").over(every))
    return filled.select("key", "source_size", target.alias("target"))


def plan(histogram: DataFrame, goals: DataFrame) -> DataFrame:
    """(key, size, n, source_size, target, base, extra): all documents ``base`` times, ``extra`` once more."""

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        whole, goal = int(pdf.source_size.iloc[0]), round(float(pdf.target.iloc[0]))
        base = goal // whole if whole else 0
        pdf["base"] = base
        pdf["extra"] = fit_counts(pdf["size"].to_numpy(), pdf["n"].to_numpy(), goal - base * whole)
        return pdf

    schema = "key string, size long, n long, source_size long, target double, base long, extra long"
    joined = histogram.drop("source").join(goals, "key").select("key", "size", "n", "source_size", "target")
    return joined.groupBy("key").applyInPandas(fit, schema)


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 0,
) -> DataFrame:
    """Per row: doc_id, source, size, source_size, target, times (how often the mix takes it), taken.

    Null texts have size 0, and documents of size 0 are taken ``base`` times at no
    cost. Null sources are one source. Rows with equal ids are ranked in an
    arbitrary order, which cannot be told from the result. A run on the same rows
    gives the same result.
    """
    sized = stored(word_counts(docs).withColumn("key", key_of(F.col("source"))), "sizes")
    histogram = sized.groupBy("key", "source", "size").agg(F.count("*").alias("n"))
    fitted = stored(plan(histogram, targets(histogram, weights, share, most)), "fit")
    drawn = sized.join(fitted, ["key", "size"]).withColumn("draw", F.xxhash64(F.lit(seed), "doc_id"))
    # Documents of one size are dealt into cells of about RANKED; cells are taken in order.
    cells = F.ceil(F.col("n") / F.lit(RANKED))
    cell = F.when((F.col("extra") > 0) & (F.col("extra") < F.col("n")), F.pmod("draw", cells))
    drawn = drawn.withColumn("cell", cell)
    whole = drawn.where("cell is null").withColumn("picked", F.col("extra") == F.col("n"))
    part = drawn.where("cell is not null")
    held = part.groupBy("key", "size", "cell").agg(F.count("*").alias("held"))
    running = Window.partitionBy("key", "size").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    held = held.withColumn("earlier", F.coalesce(F.sum("held").over(running), F.lit(0)))
    rank = F.row_number().over(Window.partitionBy("key", "size", "cell").orderBy("draw", "doc_id"))
    ranked = part.withColumn("rank", rank).join(held.drop("held"), ["key", "size", "cell"])
    ranked = ranked.withColumn("picked", F.col("rank") + F.col("earlier") <= F.col("extra"))
    columns = ["doc_id", "source", "size", "source_size", "target", "base", "picked"]
    both = whole.select(*columns).unionByName(ranked.select(*columns))
    times = (F.col("base") + F.when(F.col("picked") & (F.col("size") > 0), 1).otherwise(0)).alias("times")
    return both.select("doc_id", "source", "size", "source_size", "target", times).withColumn(
        "taken", F.col("size") * F.col("times")
    )


def mixed(docs: DataFrame, most: float = 2.0, **options) -> DataFrame:
    """The documents of the mix, with the columns they had; repeats are rows of their own.

    Rows without an id go by a hash of text and source instead. Among rows that
    share an id, those first in the order of a hash of the row are taken most often.
    """
    name = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text", "source"))
    steps = range(1, int(-(-most // 1)) + 1)
    times = mix(docs.select(name.alias("doc_id"), "source", "text"), most=most, **options)
    by_id = times.groupBy(F.col("doc_id").alias("__id")).agg(
        *[F.count_if(F.col("times") >= k).alias(f"__least{k}") for k in steps]
    )
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    same = Window.partitionBy("__id").orderBy("__hash")
    placed = docs.select(name.alias("__id"), F.xxhash64(row).alias("__hash"), row.alias("__row"))
    placed = placed.withColumn("__k", F.row_number().over(same)).join(by_id, "__id")
    n = sum((F.col("__k") <= F.col(f"__least{k}")).cast("int") for k in steps)
    copies = placed.where(n > 0).select(F.explode(F.array_repeat("__row", n)).alias("__row"))
    return copies.select("__row.*")
