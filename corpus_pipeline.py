"""A training corpus from raw documents: judged, deduplicated, decontaminated, mixed, sharded.

Every stage keeps the columns it is given, whatever they are called; only the last replaces
columns named ``slot`` and ``shard``. Rows with nulls in any column, empty and very long texts
and empty tables pass through all stages without an error; what becomes of them is said below.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pricetide.llm import lookup_shards, lsh_forest, mixing, suffix_automaton, weak_labels
from pricetide.llm.registry import SHARDS, SLOTS, table
from pricetide.llm.store import ship, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic or junk.

    Every row is judged by its whole text, repeated ones each; null and empty texts have no features
    and are judged by what the scorer says of nothing. Without labels the heuristics alone train it.
    """
    ship(spark)
    return weak_labels.keep(docs, weak_labels.fit(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies.

    Of rows with one id one stays. Texts without words, null ones among them, are copies of nothing and
    stay. A row without an id stays only where no row of its group has one.
    """
    ship(spark)
    return lsh_forest.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no more of the benchmark than the rule allows.

    Texts without words hold nothing and stay; repeated rows are judged alike; an empty benchmark,
    or one of empty items, removes nothing.
    """
    return suffix_automaton.remove(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources; a document taken twice is two rows.

    Null is a source of its own. Texts without words have size 0 and take no part of a target.
    """
    ship(spark)
    return mixing.mixed(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its slot and shard; rows with equal ids, null among them, share one."""
    return lookup_shards.place(docs, [str(i) for i in range(SHARDS)], SLOTS)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mix),
    ("sharding", sharding),
]
#: SQL cannot express the trained classifier nor the draw of the mix.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each reads what the one before it wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
