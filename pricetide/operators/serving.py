"""Queries over the serving tables: ordered reports, searches, KPIs, charts' data.

Every ordered report ends its sort with a name and an id. That makes ties
repeatable and gives the range exchange enough distinct keys to cut even where
one discount value holds much of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricetide.functions.text import (
    format_price,
    matches_like,
    matches_literal,
    matches_regex,
)
from pricetide.operators.gold import only_latest
from pricetide.schemas import TIER_ORDER

OFFER_REPORT = (
    "name",
    "store",
    "sale_price",
    "offer_currency",
    "ref_price",
    "ref_list_price",
    "ref_currency",
    "discount_pct",
    "rating_label",
    "rating_pct",
    "deal_tier",
    "savings",
    "snapshot_date",
)
RANK_REPORT = (
    "n_items",
    "avg_discount",
    "avg_sale_price",
    "avg_list_price",
    "max_discount",
    "avg_rating",
)
HISTORY_REPORT = (
    "snapshot_date",
    "sale_price",
    "list_price",
    "ref_price",
    "ref_currency",
    "discount_pct",
)
LATEST = "latest"


def of_snapshot(
    df: DataFrame, snapshot: str | None = LATEST, dates: DataFrame | None = None
) -> DataFrame:
    """Rows of the latest snapshot (of ``dates``, if given), of one date, or all (``None``)."""
    if snapshot is None:
        return df
    if snapshot == LATEST:
        return only_latest(df, dates=dates)
    return df.filter(F.col("snapshot_date") == F.lit(snapshot).cast("date"))


def best_offers(offers: DataFrame, snapshot: str | None = LATEST) -> DataFrame:
    """Offers by discount, largest first; an unknown discount comes before all."""
    return (
        of_snapshot(offers, snapshot)
        .select("item_id", *OFFER_REPORT)
        .orderBy(F.desc_nulls_first("discount_pct"), "name", "item_id", "snapshot_date")
    )


def top_tags(
    ranking: DataFrame,
    limit: int | None = None,
    snapshot: str | None = LATEST,
    dates: DataFrame | None = None,
) -> DataFrame:
    """Tag ranking by item count, whole or cut to the first ``limit``."""
    ordered = of_snapshot(ranking, snapshot, dates).orderBy(
        F.desc_nulls_first("n_items"), "tag_name", "tag_id", "snapshot_date"
    )
    ordered = ordered if limit is None else ordered.limit(limit)
    return ordered.select("tag_id", "tag_name", *RANK_REPORT)


def top_makers(
    ranking: DataFrame,
    limit: int | None = 20,
    snapshot: str | None = LATEST,
    dates: DataFrame | None = None,
) -> DataFrame:
    """Maker ranking by item count, cut to the first ``limit``."""
    ordered = of_snapshot(ranking, snapshot, dates).orderBy(
        F.desc_nulls_first("n_items"), "maker_name", "snapshot_date"
    )
    ordered = ordered if limit is None else ordered.limit(limit)
    return ordered.select("maker_name", *RANK_REPORT)


def history_for_name(history: DataFrame, text: str) -> DataFrame:
    """Price history of every item whose name contains ``text``, by date."""
    return (
        history.filter(matches_like(F.col("name"), text))
        .select("item_id", "name", *HISTORY_REPORT)
        .orderBy("snapshot_date", "name", "item_id")
    )


def history_for_item(history: DataFrame, item_id: int | str) -> DataFrame:
    """Price history of exactly one item, by date."""
    return (
        history.filter(F.col("item_id") == item_id)
        .select("item_id", "name", *HISTORY_REPORT)
        .orderBy("snapshot_date")
    )


def list_names(history: DataFrame) -> DataFrame:
    return history.select("name").distinct().orderBy("name")


def search_literal(names: DataFrame, text: str = "") -> DataFrame:
    """Names that contain ``text`` as it stands; an empty text filters nothing."""
    return names.filter(matches_literal(F.col("name"), text)) if text else names


def search_regex(offers: DataFrame, pattern: str = "") -> DataFrame:
    """Offers whose name matches ``pattern``; an empty pattern filters nothing."""
    return offers.filter(matches_regex(F.col("name"), pattern)) if pattern else offers


def tier_filter(offers: DataFrame, tiers: Sequence[str] = TIER_ORDER[:2]) -> DataFrame:
    """Offers of the chosen tiers; an empty choice filters nothing."""
    return offers.filter(F.col("deal_tier").isin(*tiers)) if tiers else offers


def shown(pattern: str = "", tiers: Sequence[str] = TIER_ORDER[:2]) -> Column:
    """Whether an offer passes the search and the tier choice."""
    passes = F.lit(True)
    if pattern:
        passes = passes & matches_regex(F.col("name"), pattern)
    if tiers:
        passes = passes & F.coalesce(F.col("deal_tier").isin(*tiers), F.lit(False))
    return passes


def filter_coverage(
    offers: DataFrame,
    pattern: str = "",
    tiers: Sequence[str] = TIER_ORDER[:2],
    by: Sequence[str] = (),
) -> DataFrame:
    """Offers shown, in total and hidden by the filters, in one pass."""
    passes = shown(pattern, tiers)
    return offers.groupBy(*by).agg(
        F.count_if(passes).alias("n_shown"),
        F.count("*").alias("n_total"),
        F.count_if(~passes).alias("n_hidden"),
    )


def kpis(offers: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Offer count, mean discount, mean rating and number of top-tier offers."""
    mean = lambda c: F.avg(F.col(c).cast("decimal(18,6)")).cast("double")
    return offers.groupBy(*by).agg(
        F.count("*").alias("n_offers"),
        mean("discount_pct").alias("avg_discount"),
        mean("rating_pct").alias("avg_rating"),
        F.count_if(F.col("deal_tier") == TIER_ORDER[0]).alias("n_top_tier"),
    )


def kpi_texts(kpi: DataFrame) -> DataFrame:
    """The KPI row as the dashboard prints it: one place and whole percent."""
    percent = lambda c, p: F.concat(
        F.round(F.col(c).cast("decimal(18,6)"), p).cast("string"), F.lit("%")
    )
    return kpi.withColumns(
        {"avg_discount": percent("avg_discount", 1), "avg_rating": percent("avg_rating", 0)}
    )


def snapshot_label(df: DataFrame) -> DataFrame:
    """Newest snapshot date as ``dd/MM/yyyy`` text."""
    newest = F.max(F.to_date("snapshot_date"))
    return df.agg(F.date_format(newest, "dd/MM/yyyy").alias("snapshot_label"))


def offer_display(offers: DataFrame) -> DataFrame:
    """Offer table as shown: prices as text, display columns only."""
    return offers.select(
        "name",
        "store",
        format_price(F.col("sale_price"), F.lit("USD")).alias("sale_text"),
        format_price(F.col("ref_price"), F.col("ref_currency")).alias("ref_text"),
        format_price(F.col("ref_list_price"), F.col("ref_currency")).alias("ref_list_text"),
        "discount_pct",
        "rating_label",
        "deal_tier",
    )


def history_display(history: DataFrame) -> DataFrame:
    """History table as shown."""
    return history.select(
        "snapshot_date",
        format_price(F.col("sale_price"), F.lit("USD")).alias("sale_text"),
        format_price(F.col("list_price"), F.lit("USD")).alias("list_text"),
        format_price(F.col("ref_price"), F.col("ref_currency")).alias("ref_text"),
        "ref_currency",
        "discount_pct",
    )


def tier_distribution(offers: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Offers per tier in the fixed tier order; tiers without offers are left out."""
    order = F.array_position(F.array(*[F.lit(t) for t in TIER_ORDER]), F.col("deal_tier"))
    return (
        offers.groupBy(*by, "deal_tier").agg(F.count("*").alias("n_offers")).orderBy(*by, order)
    )


def quadrant(offers: DataFrame, discount_line: float = 50, rating_line: float = 70) -> DataFrame:
    """Offers with both axes known and the quadrant they fall in.

    A value on a guide line counts as above it.
    """
    high_discount = F.col("discount_pct") >= discount_line
    high_rating = F.col("rating_pct") >= rating_line
    label = (
        F.when(high_discount & high_rating, "best_deal")
        .when(high_discount, "high_discount")
        .when(high_rating, "high_rating")
        .otherwise("low")
    )
    return offers.dropna(subset=["discount_pct", "rating_pct"]).select(
        "snapshot_date",
        "item_id",
        "name",
        "store",
        "discount_pct",
        "rating_pct",
        "deal_tier",
        label.alias("quadrant"),
    )


def history_series_info(history: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Whether a history has any reference price, and the currency it starts with.

    The currency is that of the first row in date order; blank if all are null.
    """
    first = F.min_by("ref_currency", F.struct("snapshot_date", F.col("item_id")))
    known = F.count("ref_currency") > 0
    return history.groupBy(*by).agg(
        (F.count("ref_price") > 0).alias("has_ref_price"),
        F.when(known, first).otherwise(F.lit("")).alias("series_currency"),
    )
