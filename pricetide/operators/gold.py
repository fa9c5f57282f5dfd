"""Price history, offers and rankings, from the Silver tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricetide.functions.numeric import avg_exact, finite, max_exact, round_half_up
from pricetide.operators.dedupe import ITEM_KEYS, keep_first
from pricetide.operators.silver import cleaned_makers, cleaned_tags, silver_items
from pricetide.schemas import LOWEST_TIER, OFFER_CURRENCY, TIERS, UNKNOWN_NAME

HISTORY_COLUMNS = (
    "item_id",
    "name",
    "sale_price",
    "list_price",
    "ref_price",
    "ref_currency",
    "discount_pct",
    "snapshot_date",
)
OFFER_COLUMNS = (
    "item_id",
    "name",
    "sale_price",
    "list_price",
    "offer_currency",
    "discount_pct",
    "rating_label",
    "rating_pct",
    "store",
    "ref_price",
    "ref_list_price",
    "ref_currency",
    "snapshot_date",
)
MEASURES = ("item_id", "discount_pct", "sale_price", "list_price", "rating_pct")


def _one_per_item(items: DataFrame, unique_items: bool, columns: Sequence[str]) -> DataFrame:
    """Dedupe unless the caller vouches for the key; ties go to the smallest row."""
    items = items.select(*columns)
    if unique_items:
        return items
    rest = [c for c in columns if c not in ITEM_KEYS]
    return keep_first(items, ITEM_KEYS, rest)


def price_history(items: DataFrame, unique_items: bool = False) -> DataFrame:
    """Prices and discount of each item and snapshot, to two places."""
    rounded = {
        c: round_half_up(F.col(c), 2)
        for c in ("sale_price", "list_price", "ref_price", "discount_pct")
    }
    return _one_per_item(items, unique_items, HISTORY_COLUMNS).withColumns(rounded)


def savings(
    ref_price: Column, sale_price: Column, ref_currency: Column, currency: str = OFFER_CURRENCY
) -> Column:
    """Reference minus sale price where both are in one currency, else null."""
    return F.when(ref_currency == currency, round_half_up(ref_price - sale_price, 2))


def deal_tier(
    discount: Column,
    tiers: Sequence[tuple[str, float]] = TIERS,
    lowest: str = LOWEST_TIER,
) -> Column:
    """First tier whose threshold the unrounded discount reaches; null and NaN are lowest."""
    discount = finite(discount)
    (label, threshold), *others = tiers
    tier = F.when(discount >= threshold, F.lit(label))
    for label, threshold in others:
        tier = tier.when(discount >= threshold, F.lit(label))
    return tier.otherwise(F.lit(lowest))


def offers(items: DataFrame, unique_items: bool = False) -> DataFrame:
    """Promotion view of each item and snapshot with savings and tier."""
    return _one_per_item(items, unique_items, OFFER_COLUMNS).withColumns(
        {
            "savings": savings(F.col("ref_price"), F.col("sale_price"), F.col("ref_currency")),
            "deal_tier": deal_tier(F.col("discount_pct")),
        }
    )


def join_makers(items: DataFrame, makers: DataFrame) -> DataFrame:
    """Item measures of each (snapshot, item, maker)."""
    return items.select("snapshot_date", *MEASURES).join(
        makers.select(*ITEM_KEYS, "maker_name"), list(ITEM_KEYS), "inner"
    )


def join_tags(items: DataFrame, tags: DataFrame) -> DataFrame:
    """Item measures of each (snapshot, item, tag)."""
    return items.select("snapshot_date", *MEASURES).join(
        tags.select(*ITEM_KEYS, "tag_id", "tag_name"), list(ITEM_KEYS), "inner"
    )


def rank_by(df: DataFrame, dims: Sequence[str], unique_items: bool = False) -> DataFrame:
    """The six ranking measures per group.

    With at most one row per item and group (``unique_items``) the distinct
    count is a plain count and the groups need one exchange of partial
    aggregates instead of one per item.
    """
    n_items = F.count("item_id") if unique_items else F.count_distinct("item_id")
    return df.groupBy(*dims).agg(
        n_items.alias("n_items"),
        avg_exact(F.col("discount_pct"), 2).alias("avg_discount"),
        avg_exact(F.col("sale_price"), 2).alias("avg_sale_price"),
        avg_exact(F.col("list_price"), 2).alias("avg_list_price"),
        max_exact(F.col("discount_pct"), 2).alias("max_discount"),
        avg_exact(F.col("rating_pct"), 1).alias("avg_rating"),
    )


def rank_makers(
    items: DataFrame,
    makers: DataFrame,
    unique_items: bool = False,
    unique_makers: bool = False,
) -> DataFrame:
    """Ranking per snapshot and maker from the two Silver tables."""
    facts = _one_per_item(items, unique_items, ("snapshot_date", *MEASURES))
    named = F.coalesce("maker_name", F.lit(UNKNOWN_NAME))
    bridge = makers.select(*ITEM_KEYS, named.alias("maker_name"))
    if not unique_makers:
        bridge = bridge.distinct()
    return rank_by(join_makers(facts, bridge), ("snapshot_date", "maker_name"), True)


def one_name_per_tag(tags: DataFrame) -> DataFrame:
    """One row per item and tag id: the smallest name survives."""
    return tags.groupBy(*ITEM_KEYS, "tag_id").agg(F.min("tag_name").alias("tag_name"))


def rank_tags(items: DataFrame, tags: DataFrame, unique_items: bool = False) -> DataFrame:
    """Ranking per snapshot, tag id and tag name from the two Silver tables."""
    facts = _one_per_item(items, unique_items, ("snapshot_date", *MEASURES))
    # Dealt by item first: the aggregate and the join then share that exchange.
    joined = join_tags(facts, one_name_per_tag(tags.repartition(*ITEM_KEYS)))
    return rank_by(joined, ("snapshot_date", "tag_id", "tag_name"), True)


def rank_makers_of_records(records: DataFrame) -> DataFrame:
    """``rank_makers`` straight from unique enriched records, without the self-join.

    Items and bridge of one record set meet on the key that made them, so
    exploding the kept list gives the same rows as joining the two tables.
    """
    items = silver_items(records, unique_records=True, keep=("makers",))
    rows = items.select(
        "snapshot_date", *MEASURES, F.explode(cleaned_makers(F.col("makers"))).alias("maker_name")
    )
    return rank_by(rows, ("snapshot_date", "maker_name"), True)


def rank_tags_of_records(records: DataFrame) -> DataFrame:
    """``rank_tags`` straight from unique enriched records, without the self-join."""
    items = silver_items(records, unique_records=True, keep=("tags",))
    # names ordered ascending, so the first struct of each id has the smallest name
    tags = F.array_sort(cleaned_tags(F.col("tags")))
    first_of_id = F.filter(
        tags,
        lambda t, i: (i == 0) | ~t["tag_id"].eqNullSafe(F.get(tags, i - 1)["tag_id"]),
    )
    rows = items.select("snapshot_date", *MEASURES, F.explode(first_of_id).alias("tag")).select(
        "snapshot_date", *MEASURES, "tag.tag_id", "tag.tag_name"
    )
    return rank_by(rows, ("snapshot_date", "tag_id", "tag_name"), True)


def latest_snapshot(df: DataFrame, key: str = "snapshot_date") -> DataFrame:
    """The newest snapshot date as one row; null for an empty table."""
    return df.agg(F.max(key).alias(key))


def only_latest(
    df: DataFrame, key: str = "snapshot_date", dates: DataFrame | None = None
) -> DataFrame:
    """Rows of the newest snapshot.

    The date is a scalar subquery, not a driver-side value: on a partitioned
    table it prunes directories at run time and an empty table stays empty.
    ``dates`` names a cheaper table to take the newest date from, where ``df``
    is computed and not stored.
    """
    source = df if dates is None else dates
    return df.filter(F.col(key) == latest_snapshot(source, key).scalar())
