"""Queries of the operators for training data, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pricetide.llm import (
    best_position,
    column_bwt,
    edit_counts,
    lookup_shards,
    lsh_forest,
    mixing,
    nn_descent,
    oracle,
    stable_hash,
    stripes,
    suffix_automaton,
    token_frames,
    warc,
    weak_labels,
)
from pricetide.llm.store import ship

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
#: Shards and slots of the registered placement.
SHARDS, SLOTS = 32, 4093


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register
def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.near_duplicates(table(spark, sf_dir, "documents"))


def byte_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@register
def op2_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_frames.round_trip(table(spark, sf_dir, "documents"), byte_vocabulary(), end_id=2)


@register
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return lookup_shards.place(docs, [str(i) for i in range(SHARDS)], SLOTS)


@register
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


@register
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return column_bwt.without_repeats(table(spark, sf_dir, "documents"))


@register
def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stable_hash.near_duplicates(table(spark, sf_dir, "embeddings"))


@register
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_automaton.report(
        suffix_automaton.mark(docs, table(spark, sf_dir, "benchmark"))
    )


@register
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return weak_labels.classify(docs, weak_labels.fit(docs, table(spark, sf_dir, "labels")))


@register
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return edit_counts.counts_after_redaction(docs, byte_vocabulary())


@register
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken", "source", "times")


@register
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stripes.collocations(table(spark, sf_dir, "documents"))


@register
def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.nearest(table(spark, sf_dir, "embeddings"))


@register
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_position.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql(SHARDS, SLOTS)
