"""Typed items and the two bridges, from enriched records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricetide.functions.numeric import finite, minor_to_major
from pricetide.functions.text import clean_name
from pricetide.operators.dedupe import ARRIVAL, ITEM_KEYS, keep_first
from pricetide.schemas import ACCEPTED_CURRENCIES, OFFER_CURRENCY

ITEM_COLUMNS = (
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
    "ref_discount_pct",
    "snapshot_date",
)
TEXT_CASTS = {
    "sale_price": "double",
    "list_price": "double",
    "discount": "double",
    "rating_pct": "int",
}


def typed_projection(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Text to numbers and nested price to flat columns; malformed text is null."""
    # each text is cast once, and the number is then looked at
    texts = ("sale_price", "list_price", "discount")
    numbers = records.withColumns({f"_{c}": F.col(c).try_cast("double") for c in texts})
    return numbers.select(
        "snapshot_date",
        "item_id",
        clean_name(F.col("name")).alias("name"),
        finite(F.col("_sale_price")).alias("sale_price"),
        finite(F.col("_list_price")).alias("list_price"),
        F.lit(OFFER_CURRENCY).alias("offer_currency"),
        finite(F.col("_discount")).alias("discount_pct"),
        "rating_label",
        F.col("rating_pct").try_cast("int").alias("rating_pct"),
        "store",
        minor_to_major(F.col("price.final")).alias("ref_price"),
        minor_to_major(F.col("price.initial")).alias("ref_list_price"),
        F.col("price.currency").alias("ref_currency"),
        finite(F.col("price.discount_percent")).alias("ref_discount_pct"),
        *keep,
    )


def cast_losses(df: DataFrame, casts: dict[str, str] = TEXT_CASTS) -> DataFrame:
    """How many texts of each column give no number, NaN and infinities included, in one pass."""
    number = lambda c, t: finite(F.col(c)) if t == "double" else F.col(c).try_cast(t)
    lost = [
        F.count_if(F.col(c).isNotNull() & number(c, t).isNull()).alias(c)
        for c, t in casts.items()
    ]
    counts = df.agg(*lost)
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_lost")) for c in casts]
    return counts.select(F.inline(F.array(*pairs)))


def quality_filter(
    items: DataFrame, currencies: Sequence[str] = ACCEPTED_CURRENCIES
) -> DataFrame:
    """Items with a key and an accepted reference currency; null currency is dropped."""
    return items.filter(F.col("item_id").isNotNull() & F.col("ref_currency").isin(*currencies))


def silver_items(
    records: DataFrame,
    processed_at: str | None = None,
    unique_records: bool = False,
    order_by: Sequence[str] = ARRIVAL,
    keep: Sequence[str] = (),
) -> DataFrame:
    """The item fact: typed, cleaned, filtered, one row per item and snapshot.

    Records written by ``enriched_records`` are already unique per item and
    snapshot; ``unique_records=True`` then skips the dedupe and the whole
    operator runs without a shuffle.
    """
    carried = () if unique_records else tuple(order_by)
    items = quality_filter(typed_projection(records, (*keep, *carried)))
    if not unique_records:
        items = keep_first(items, ITEM_KEYS, order_by)
    items = items.select(*ITEM_COLUMNS, *keep)
    return items if processed_at is None else stamp_processed(items, processed_at)


def stamp_processed(df: DataFrame, processed_at: str) -> DataFrame:
    return df.withColumn("processed_at", F.lit(processed_at).cast("timestamp"))


def cleaned_tags(tags: Column) -> Column:
    """Distinct ``(tag_id, tag_name)`` structs of one record."""
    return F.array_distinct(
        F.transform(
            tags,
            lambda t: F.struct(
                t["id"].try_cast("int").alias("tag_id"),
                clean_name(t["description"]).alias("tag_name"),
            ),
        )
    )


def cleaned_makers(makers: Column) -> Column:
    """Distinct maker names of one record."""
    return F.array_distinct(F.transform(makers, lambda m: clean_name(m)))


def tag_bridge(
    records: DataFrame, processed_at: str | None = None, unique_records: bool = False
) -> DataFrame:
    """``(snapshot, item, tag)`` rows of all records, whatever their currency.

    Repeats inside one record go before the rows are exploded; repeats across
    records only exist if records are not unique, and only then cost a shuffle.
    """
    rows = (
        records.filter(F.col("item_id").isNotNull())
        .select(*ITEM_KEYS, F.explode(cleaned_tags(F.col("tags"))).alias("tag"))
        .select("item_id", "tag.tag_id", "tag.tag_name", "snapshot_date")
    )
    rows = rows if unique_records else rows.distinct()
    return rows if processed_at is None else stamp_processed(rows, processed_at)


def maker_bridge(
    records: DataFrame, processed_at: str | None = None, unique_records: bool = False
) -> DataFrame:
    """``(snapshot, item, maker)`` rows of all records, whatever their currency."""
    rows = records.filter(F.col("item_id").isNotNull()).select(
        "item_id",
        F.explode(cleaned_makers(F.col("makers"))).alias("maker_name"),
        "snapshot_date",
    )
    rows = rows if unique_records else rows.distinct()
    return rows if processed_at is None else stamp_processed(rows, processed_at)
