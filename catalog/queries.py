"""Registered queries: each operator over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, TimestampType

from catalog import views
from pricetide.functions.numeric import minor_to_major
from pricetide.functions.text import clean_name, format_price
from pricetide.operators import conform as fit
from pricetide.operators import checks, dedupe, enrich, gold, lineage, serving, silver, states
from pricetide.schemas import (
    LANDED_DEAL_NAMES,
    LANDED_STORE_NAMES,
    SERVING_OFFERS,
    SERVING_PRICE_HISTORY,
)
from pricetide.session import fresh_path, option
from pricetide.sinks import buckets, clusters, lake, names
from pricetide.sources import landed, ledger, tables

Query = Callable[[SparkSession, str], DataFrame]
RUN = lineage.Run(
    run_id="run-1",
    ingested_at="2001-12-01 06:00:00",
    environment="test",
    sources=("deals", "details"),
)
PROCESSED_AT = "2001-12-01 07:00:00"
REGISTRY: dict[str, Query] = {}


def register(query: Query) -> Query:
    REGISTRY[query.__name__] = query
    return query


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, times and source lists as text, for the comparison."""
    shown = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, DecimalType):
            shown[f.name] = F.col(f.name).cast("double")
        elif isinstance(f.dataType, TimestampType):
            shown[f.name] = F.date_format(f.name, "yyyy-MM-dd HH:mm:ss")
        elif f.name == "sources":
            shown[f.name] = F.array_join(f.name, ",")
    return df.withColumns(shown) if shown else df


def records(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.enriched_records(
        views.deals(spark, sf), views.details(spark, sf), views.stores(spark, sf)
    )


def unlabelled(spark: SparkSession, sf: str, lookup: Callable[..., DataFrame] = enrich.lookup_details) -> DataFrame:
    """Records of the queries that never look at the store: no store join."""
    found = lookup(enrich.first_deals(views.deals(spark, sf)), views.details(spark, sf))
    return found.withColumn("store", F.lit(None).cast("string")).select(*enrich.RECORD_COLUMNS)


def items(spark: SparkSession, sf: str, labelled: bool = True) -> DataFrame:
    source = records if labelled else unlabelled
    return silver.silver_items(source(spark, sf), unique_records=True)


def item_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshots that have items. Dedupe does not change them, so none is done."""
    found = enrich.lookup_details(
        enrich.require_key(views.deals(spark, sf)), views.details(spark, sf)
    )
    return silver.quality_filter(
        found.select("snapshot_date", "item_id", F.col("price.currency").alias("ref_currency"))
    )


def history(spark: SparkSession, sf: str) -> DataFrame:
    return gold.price_history(items(spark, sf, labelled=False), unique_items=True)


def offers(spark: SparkSession, sf: str) -> DataFrame:
    return gold.offers(items(spark, sf), unique_items=True)


def serving_offers(spark: SparkSession, sf: str, labelled: bool = True) -> DataFrame:
    found = gold.offers(items(spark, sf, labelled), unique_items=True)
    return fit.conform(found, SERVING_OFFERS, strict=True)


def serving_history(spark: SparkSession, sf: str) -> DataFrame:
    return fit.conform(history(spark, sf), SERVING_PRICE_HISTORY, strict=True)


def offer_report(df: DataFrame) -> DataFrame:
    return plain(df.select("item_id", *serving.OFFER_REPORT))


# --- sources and sinks ---------------------------------------------------------


@register
def nested_envelope_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Envelopes of two records each, written as JSON and read back by schema."""
    record = landed.to_landed_record()
    day = F.col("snapshot_date").cast("string").alias("data_ingestao")
    execution = F.lit(RUN.run_id).alias("execution_id")
    envelopes = records(spark, sf).select(
        F.struct(day, execution).alias("metadata"), F.array(record, record).alias("dados")
    )
    path = fresh_path(spark, "envelopes")
    envelopes.write.json(path, compression="gzip")
    return landed.envelope_records(landed.read_envelopes(spark, path)).select(
        "item_id",
        "snapshot_date",
        "ord2",
        "name",
        "sale_price",
        "list_price",
        "discount",
        "rating_label",
        "rating_pct",
        "store",
        F.col("price.final").alias("final_minor"),
        F.col("price.currency").alias("currency"),
        F.get("tags", F.lit(0))["id"].alias("tag1_id"),
        F.get("tags", F.lit(1))["description"].alias("tag2_name"),
        F.get("makers", F.lit(1)).alias("maker2"),
    )


@register
def bronze_lineage(spark: SparkSession, sf: str) -> DataFrame:
    stamped = lineage.stamp_lineage(views.deals(spark, sf), RUN, "bronze_raw")
    root = fresh_path(spark, "bronze")
    lake.write_bronze(stamped, root)
    return plain(tables.read_table(spark, root, stamped.schema, "json"))


@register
def enriched_lineage(spark: SparkSession, sf: str) -> DataFrame:
    """Records stamped as the enriched layer, written and read back."""
    kept = ("snapshot_date", "item_id", "name", "sale_price", "rating_label", "store")
    stamped = lineage.stamp_lineage(records(spark, sf).select(*kept), RUN, "bronze_enriched")
    root = fresh_path(spark, "enriched")
    lake.write_bronze(stamped, root, fmt="parquet")
    return plain(tables.read_table(spark, root))


@register
def read_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    all_items = items(spark, sf)
    root = fresh_path(spark, "items")
    lake.replace_snapshots(all_items, root)
    return tables.read_snapshot(spark, root, "1998-06-01", all_items.schema)


@register
def snapshot_replace(spark: SparkSession, sf: str) -> DataFrame:
    """Write all snapshots, then redo those before 1998 with 1996 come out empty."""
    first = history(spark, sf)
    root = fresh_path(spark, "history")
    written = lake.replace_snapshots(first, root)
    redone = [d for d in written.snapshots if d.year < 1998]
    day = F.col("snapshot_date")
    second = first.filter((day < F.lit("1998-01-01").cast("date")) & (F.year(day) != 1996))
    whole = F.round(F.col("sale_price").cast("decimal(18,6)"), 0).cast("double")
    lake.replace_snapshots(second.withColumn("sale_price", whole), root, redone)
    return tables.read_table(spark, root, first.schema)


def replaced_history(spark: SparkSession, sf: str) -> tuple[DataFrame, str]:
    """A history and its table, of which some dates were replaced and some emptied since."""
    first = history(spark, sf)
    root = fresh_path(spark, "history")
    written = lake.replace_snapshots(first, root)
    redone = [d for d in written.snapshots if d.year < 1998]
    halved = first.filter(F.year("snapshot_date") == 1997).withColumn("sale_price", F.col("sale_price") / 2)
    lake.replace_snapshots(halved, root, redone)
    return first, root


@register
def read_version(spark: SparkSession, sf: str) -> DataFrame:
    """The first version of a table that was changed since."""
    first, root = replaced_history(spark, sf)
    return tables.read_table(spark, root, first.schema, version=1)


@register
def refused_write(spark: SparkSession, sf: str) -> DataFrame:
    """A table after a write whose staged rows repeat a key: as it was."""
    first = history(spark, sf)
    root = fresh_path(spark, "history")
    unique = checks.unique("item_id", "snapshot_date")
    lake.replace_snapshots(first, root, checks=[unique])
    kept = tables.read_table(spark, root, first.schema)
    try:
        lake.replace_snapshots(kept.unionByName(kept.withColumn("name", F.lit("again"))), root, checks=[unique])
    except lake.Refused:
        return tables.read_table(spark, root, first.schema)
    raise AssertionError("a repeated key was published")


@register
def conform_schema(spark: SparkSession, sf: str) -> DataFrame:
    return plain(serving_offers(spark, sf))


@register
def unique_violations(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe.unique_violations(views.deals(spark, sf))


@register
def csv_export(spark: SparkSession, sf: str) -> DataFrame:
    chosen = serving.tier_filter(serving_offers(spark, sf)).select(
        "item_id", *serving.OFFER_REPORT
    )
    path = fresh_path(spark, "csv")
    lake.export_csv(chosen, path)
    return plain(lake.read_csv_export(spark, path, chosen.schema))


@register
def map_detail_explode(spark: SparkSession, sf: str) -> DataFrame:
    """Details landed as ``{id: {success, data}}`` lines, read back as rows."""
    data = F.struct(
        "name",
        F.col("price").alias("price_overview"),
        F.col("tags").alias("genres"),
        F.col("makers").alias("developers"),
    )
    detail = F.struct("success", data.alias("data"))
    path = fresh_path(spark, "details")
    views.details(spark, sf).select(F.to_json(F.create_map("item_id", detail))).write.text(path)
    return landed.read_details(spark, path).select(
        "item_id",
        "success",
        "name",
        "price.currency",
        F.col("price.final").alias("final_minor"),
        F.col("price.initial").alias("initial_minor"),
        F.get("tags", F.lit(0))["id"].alias("tag1_id"),
        F.get("tags", F.lit(0))["description"].alias("tag1_name"),
        F.get("tags", F.lit(1))["id"].alias("tag2_id"),
        F.get("makers", F.lit(0)).alias("maker1"),
        F.get("makers", F.lit(1)).alias("maker2"),
    )


@register
def landed_deals(spark: SparkSession, sf: str) -> DataFrame:
    """Deals landed as JSON arrays of one page each, read back as rows."""
    record = F.struct(
        *[F.col(neutral).alias(name) for name, neutral in LANDED_DEAL_NAMES.items()]
    )
    page = F.floor(F.col("ord1") / 2048).alias("page")
    array = F.to_json(F.collect_list(record), {"ignoreNullFields": "false"}).alias("value")
    path = fresh_path(spark, "landed-deals")
    pages = views.deals(spark, sf).groupBy(page).agg(array)
    pages.write.partitionBy("page").text(path)
    return landed.read_deals(spark, path, lines=False).drop("ord1", "ord2")


@register
def quarantined_deals(spark: SparkSession, sf: str) -> DataFrame:
    """Deals landed as lines of which some are cut off: the text of those, set aside."""
    record = F.struct(*[F.col(neutral).alias(name) for name, neutral in LANDED_DEAL_NAMES.items()])
    cut = F.concat(F.lit('{"steamAppID":"'), F.coalesce("item_id", F.lit("")), F.lit('","storeID'))
    line = F.when(F.col("ord1") % 50 == 7, cut).otherwise(F.to_json(record))
    path = fresh_path(spark, "landed-lines")
    views.deals(spark, sf).select(line.alias("value")).write.text(path)
    root = fresh_path(spark, "deals")
    lake.replace_table(landed.read_deals(spark, path, keep_bad=True), root)
    return landed.unreadable(tables.read_table(spark, root), "deals").select("source", "text")


@register
def audit_with_unreadable(spark: SparkSession, sf: str) -> DataFrame:
    """The audit of deals of which some could not be read: all counts add up to those received."""
    text = F.when(F.col("ord1") % 50 == 7, F.lit("{"))
    return enrich.rejection_audit(views.deals(spark, sf).withColumn("corrupt", text), views.details(spark, sf))


@register
def ledger_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Deals that each of three runs finds pending: some files, those that come late, none."""
    root = fresh_path(spark, "landing")
    deals = views.deals(spark, sf).select(F.col("ord1"), "item_id", "store_id")
    counts = []
    for run, part in enumerate([F.col("ord1") % 3 != 0, F.col("ord1") % 3 == 0, F.lit(False)], 1):
        if run < 3:
            rows = deals.filter(part).select(
                F.col("item_id").alias("steamAppID"), F.coalesce("store_id", F.lit("none")).alias("storeID")
            )
            rows.write.mode("append").json(f"{root}/landed/deals")
        files = ledger.landed_files(spark, {"deals": f"{root}/landed/deals"})
        known = ledger.entered(spark, f"{root}/ledger", "2026-01-01")
        new = ledger.paths(ledger.pending(files, known).collect(), "deals")
        counts.append((run, landed.read_deals(spark, new).count() if new else 0))
        day = F.lit("2026-01-01").cast("date")
        lake.replace_snapshots(files.withColumn("snapshot_date", day), f"{root}/ledger", ["2026-01-01"])
    return spark.createDataFrame(counts, "run int, n_deals bigint")


@register
def landed_stores(spark: SparkSession, sf: str) -> DataFrame:
    """Store pairs landed as JSON lines, read back as rows."""
    columns = [
        F.col(neutral).cast("string").alias(name) for name, neutral in LANDED_STORE_NAMES.items()
    ]
    path = fresh_path(spark, "landed-stores")
    views.raw_stores(spark, sf).select(*columns).write.json(path)
    return landed.read_stores(spark, path).drop("ord1", "ord2")


@register
def misfits(spark: SparkSession, sf: str) -> DataFrame:
    """What the serving columns cannot hold, with odd ids, prices and names put in."""
    last = lambda n: F.right("item_id", F.lit(n))
    item, price, name = F.col("item_id"), F.col("sale_price"), F.col("name")
    odd = offers(spark, sf).withColumns(
        {
            "item_id": F.when(last(1) == "7", F.concat(item, F.lit("x"))).otherwise(item),
            "sale_price": F.when(last(1) == "3", price * 1e9).otherwise(price),
            "name": F.when(last(2) == "11", F.repeat(name, 40)).otherwise(name),
        }
    )
    return fit.misfits(odd, SERVING_OFFERS)


# --- enrichment ----------------------------------------------------------------


@register
def require_key(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.require_key(views.deals(spark, sf))


@register
def first_wins_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.first_deals(views.deals(spark, sf))


@register
def detail_lookup_join(spark: SparkSession, sf: str) -> DataFrame:
    deals = views.deals(spark, sf)
    found = enrich.lookup_details(enrich.first_deals(deals), views.details(spark, sf))
    return found.select(
        *deals.columns, "name", "price.currency", F.col("price.final").alias("final_minor")
    )


@register
def store_label_join(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.label_stores(views.deals(spark, sf), views.stores(spark, sf)).select(
        "ord1", "ord2", "item_id", "store_id", "snapshot_date", "store"
    )


@register
def store_dimension(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.store_dimension(views.raw_stores(spark, sf), ["ord1"])


@register
def store_label_default(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.label_stores(views.deals(spark, sf), enrich.default_stores(spark)).select(
        "ord1", "ord2", "item_id", "store_id", "snapshot_date", "store"
    )


@register
def rejection_audit(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.rejection_audit(views.deals(spark, sf), views.details(spark, sf))


@register
def run_manifest(spark: SparkSession, sf: str) -> DataFrame:
    audit = enrich.rejection_audit(views.deals(spark, sf), views.details(spark, sf))
    return plain(lineage.run_manifest(audit, RUN, "bronze_enriched"))


# --- silver ---------------------------------------------------------------------


@register
def silver_items(spark: SparkSession, sf: str) -> DataFrame:
    return plain(silver.silver_items(records(spark, sf), PROCESSED_AT, unique_records=True))


@register
def typed_projection(spark: SparkSession, sf: str) -> DataFrame:
    return silver.typed_projection(records(spark, sf))


@register
def cast_losses(spark: SparkSession, sf: str) -> DataFrame:
    return silver.cast_losses(views.deals(spark, sf))


@register
def minor_units(spark: SparkSession, sf: str) -> DataFrame:
    return views.details(spark, sf).select(
        "item_id",
        minor_to_major(F.col("price.final")).alias("ref_price"),
        minor_to_major(F.col("price.initial")).alias("ref_list_price"),
    )


@register
def clean_names(spark: SparkSession, sf: str) -> DataFrame:
    return views.flat_details(spark, sf).select(
        "item_id",
        clean_name(F.col("name")).alias("name"),
        clean_name(F.col("tag1_name")).alias("tag_name"),
        clean_name(F.col("maker2")).alias("maker_name"),
    )


REGISTRY["clean_name"] = REGISTRY.pop("clean_names")


@register
def quality_filter(spark: SparkSession, sf: str) -> DataFrame:
    typed = views.flat_details(spark, sf).select(
        "item_id", "name", F.col("currency").alias("ref_currency")
    )
    return silver.quality_filter(typed)


@register
def keyed_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """Last arrival per item and snapshot, null and empty keys included."""
    kept = dedupe.keep_last(views.deals(spark, sf), dedupe.ITEM_KEYS, dedupe.ARRIVAL)
    return kept.select("item_id", "snapshot_date", "store_id", "sale_price")


@register
def tag_bridge(spark: SparkSession, sf: str) -> DataFrame:
    return plain(silver.tag_bridge(unlabelled(spark, sf), PROCESSED_AT, unique_records=True))


@register
def maker_bridge(spark: SparkSession, sf: str) -> DataFrame:
    return plain(silver.maker_bridge(unlabelled(spark, sf), PROCESSED_AT, unique_records=True))


@register
def layer_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the three Silver tables, counted by the writes that make them."""
    root = fresh_path(spark, "silver")
    # more cells would be more files, fewer would fill the tasks less evenly
    cells = 5 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = enrich.records_by_date(
        views.deals(spark, sf), views.details(spark, sf), views.stores(spark, sf), cells
    )
    # deals are much wider than the lines they are read from: a task's fill its memory before they are sent
    splits = option(spark, "spark.sql.files.maxPartitionBytes", "32m", override=False)
    with option(spark, *enrich.JOIN_IN_CELLS), splits:
        lake.replace_snapshots(found, f"{root}/records", together=True)
    landed_records = tables.read_table(spark, f"{root}/records", found.schema)
    outputs = {
        "items": silver.silver_items(landed_records, unique_records=True),
        "tags": silver.tag_bridge(landed_records, unique_records=True),
        "makers": silver.maker_bridge(landed_records, unique_records=True),
    }
    # a file of records has one date, so rows need not be sent together once more
    counts = [
        (name, lake.replace_snapshots(df, f"{root}/{name}", spread=False).rows)
        for name, df in outputs.items()
    ]
    return spark.createDataFrame(counts, "layer string, n_rows bigint")


@register
def silver_items_repeated(spark: SparkSession, sf: str) -> DataFrame:
    """Records that arrive twice: the first of each item and snapshot survives."""
    once = records(spark, sf)
    again = once.withColumns({"ord2": F.col("ord2") + 100, "name": F.lit("again")})
    return silver.silver_items(once.unionByName(again), unique_records=False)


# --- joins and gold ---------------------------------------------------------------


@register
def history_repeated(spark: SparkSession, sf: str) -> DataFrame:
    """Items that are there twice: the smallest row survives."""
    once = items(spark, sf, labelled=False)
    again = once.withColumn("name", F.concat("name", F.lit("~")))
    return gold.price_history(once.unionByName(again), unique_items=False)


def silver_tables(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Items, tags and makers of records that are written once."""
    found = unlabelled(spark, sf)
    path = fresh_path(spark, "records")
    found.write.parquet(path)
    stored = spark.read.schema(found.schema).parquet(path)
    return (
        silver.silver_items(stored, unique_records=True),
        silver.tag_bridge(stored, unique_records=True),
        silver.maker_bridge(stored, unique_records=True),
    )


@register
def rank_makers_joined(spark: SparkSession, sf: str) -> DataFrame:
    """The ranking from the two Silver tables, as where only these are there."""
    facts, _, bridge = silver_tables(spark, sf)
    return gold.rank_makers(facts, bridge, unique_items=True, unique_makers=True)


@register
def rank_tags_joined(spark: SparkSession, sf: str) -> DataFrame:
    facts, bridge, _ = silver_tables(spark, sf)
    return gold.rank_tags(facts, bridge, unique_items=True)


def bucketed_records(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Records written in buckets by (snapshot, item), as the sides of a join."""
    root = f"{fresh_path(spark, 'buckets')}/records"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets.write_buckets(unlabelled(spark, sf, enrich.bring_details), root, buckets=parts)
    (sides,) = buckets.together(spark, [root, root])
    return sides


@register
def join_makers(spark: SparkSession, sf: str) -> DataFrame:
    facts, bridge = bucketed_records(spark, sf)
    return gold.join_makers(
        silver.silver_items(facts, unique_records=True), silver.maker_bridge(bridge, unique_records=True)
    )


@register
def join_tags(spark: SparkSession, sf: str) -> DataFrame:
    facts, bridge = bucketed_records(spark, sf)
    return gold.join_tags(
        silver.silver_items(facts, unique_records=True), silver.tag_bridge(bridge, unique_records=True)
    )


def ranges(spark: SparkSession, sf: str, joined: DataFrame, dims: list[str]) -> DataFrame:
    """The ranking over two years, from the states of each snapshot."""
    root = fresh_path(spark, "states")
    joined = joined.select("snapshot_date", *gold.MEASURES, *dims)
    joined.write.parquet(f"{root}/joined")
    kept = spark.read.schema(joined.schema).parquet(f"{root}/joined")
    lake.replace_snapshots(states.rank_states(kept, dims), f"{root}/states")
    lake.replace_snapshots(states.item_sets(kept, dims), f"{root}/sets")
    ends = ("1995-03-01", "1997-02-01")
    return states.merged_ranking(
        states.between(tables.read_table(spark, f"{root}/states"), *ends),
        states.between(tables.read_table(spark, f"{root}/sets"), *ends),
        dims,
    )


@register
def rank_makers_range(spark: SparkSession, sf: str) -> DataFrame:
    items = silver.silver_items(unlabelled(spark, sf), unique_records=True, keep=("makers",))
    maker = F.explode(silver.cleaned_makers(F.col("makers"))).alias("maker_name")
    return ranges(spark, sf, items.select("snapshot_date", *gold.MEASURES, maker), ["maker_name"])


@register
def rank_tags_range(spark: SparkSession, sf: str) -> DataFrame:
    items = silver.silver_items(unlabelled(spark, sf), unique_records=True, keep=("tags",))
    tag = F.explode(silver.cleaned_tags(F.col("tags"))).alias("tag")
    one = items.select("snapshot_date", *gold.MEASURES, tag).select("snapshot_date", *gold.MEASURES, "tag.*")
    named = one.groupBy("snapshot_date", *gold.MEASURES, "tag_id").agg(F.min("tag_name").alias("tag_name"))
    return ranges(spark, sf, named, ["tag_id", "tag_name"])


@register
def price_history(spark: SparkSession, sf: str) -> DataFrame:
    return history(spark, sf)


REGISTRY["offers"] = offers


@register
def savings(spark: SparkSession, sf: str) -> DataFrame:
    return gold.offers(items(spark, sf, labelled=False), unique_items=True).select(
        "item_id", "snapshot_date", "ref_currency", "savings"
    )


@register
def deal_tier(spark: SparkSession, sf: str) -> DataFrame:
    discount = F.col("discount").try_cast("double")
    return views.deals(spark, sf).select(
        "ord1",
        "ord2",
        "item_id",
        "snapshot_date",
        discount.alias("discount_pct"),
        gold.deal_tier(discount).alias("deal_tier"),
    )


@register
def rank_makers(spark: SparkSession, sf: str) -> DataFrame:
    return gold.rank_makers_of_records(unlabelled(spark, sf))


@register
def rank_tags(spark: SparkSession, sf: str) -> DataFrame:
    return gold.rank_tags_of_records(unlabelled(spark, sf))


@register
def latest_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return gold.only_latest(views.deals(spark, sf))


@register
def snapshot_label(spark: SparkSession, sf: str) -> DataFrame:
    return serving.snapshot_label(views.deals(spark, sf))


@register
def rank_aggregates(spark: SparkSession, sf: str) -> DataFrame:
    """The measures over groups in which items repeat: the count is distinct."""
    typed = views.deals(spark, sf).select(
        "snapshot_date",
        "store_id",
        "item_id",
        F.col("discount").try_cast("double").alias("discount_pct"),
        F.col("sale_price").try_cast("double").alias("sale_price"),
        F.col("list_price").try_cast("double").alias("list_price"),
        F.col("rating_pct").try_cast("int").alias("rating_pct"),
    )
    return gold.rank_by(typed, ("snapshot_date", "store_id"))


# --- serving ------------------------------------------------------------------------


@register
def best_offers(spark: SparkSession, sf: str) -> DataFrame:
    return plain(serving.best_offers(serving_offers(spark, sf), snapshot=None))


@register
def top_tags(spark: SparkSession, sf: str) -> DataFrame:
    return serving.top_tags(rank_tags(spark, sf), limit=15, dates=item_dates(spark, sf))


@register
def top_makers(spark: SparkSession, sf: str) -> DataFrame:
    return serving.top_makers(rank_makers(spark, sf), dates=item_dates(spark, sf))


@register
def all_tags(spark: SparkSession, sf: str) -> DataFrame:
    return serving.top_tags(rank_tags(spark, sf), limit=None, dates=item_dates(spark, sf))


@register
def first_makers(spark: SparkSession, sf: str) -> DataFrame:
    return serving.top_makers(rank_makers(spark, sf), limit=15, dates=item_dates(spark, sf))


@register
def search_accents(spark: SparkSession, sf: str) -> DataFrame:
    return serving.search_regex(views.accented(spark, sf), "^[a-zé]*É[a-z]* .*É")


@register
def kpi_texts(spark: SparkSession, sf: str) -> DataFrame:
    return serving.kpi_texts(
        serving.kpis(serving_offers(spark, sf, labelled=False), by=["snapshot_date"])
    )


@register
def history_for_name(spark: SparkSession, sf: str) -> DataFrame:
    return plain(serving.history_for_name(serving_history(spark, sf), "RED %g"))


@register
def history_for_item(spark: SparkSession, sf: str) -> DataFrame:
    return plain(serving.history_for_item(serving_history(spark, sf), 42))


@register
def history_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """The history of three items, from files clustered by item."""
    rows = history(spark, sf)
    root = fresh_path(spark, "clustered")
    clusters.write_clustered(rows, root)
    return clusters.lookup(spark, root, ["42", "777", "1000000"], schema=rows.schema)


def name_index(spark: SparkSession, sf: str) -> str:
    root = fresh_path(spark, "names")
    names.write_names(views.details(spark, sf).select(clean_name(F.col("name")).alias("name")), root)
    return root


@register
def names_like(spark: SparkSession, sf: str) -> DataFrame:
    return names.search_like(spark, name_index(spark, sf), "RED %idge").names


@register
def names_literal(spark: SparkSession, sf: str) -> DataFrame:
    return names.search_literal(spark, name_index(spark, sf), "D GIZ").names


@register
def names_regex(spark: SparkSession, sf: str) -> DataFrame:
    return names.search_regex(spark, name_index(spark, sf), "^[a-r].* gi[xz]mo").names


@register
def list_names(spark: SparkSession, sf: str) -> DataFrame:
    return serving.list_names(serving_history(spark, sf))


@register
def search_regex(spark: SparkSession, sf: str) -> DataFrame:
    return offer_report(serving.search_regex(serving_offers(spark, sf), "^(RED|blue) .*g"))


@register
def tier_filter(spark: SparkSession, sf: str) -> DataFrame:
    return offer_report(serving.tier_filter(serving_offers(spark, sf)))


@register
def filter_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return serving.filter_coverage(serving_offers(spark, sf, labelled=False), "ring", by=["snapshot_date"])


@register
def search_literal(spark: SparkSession, sf: str) -> DataFrame:
    return serving.search_literal(serving.list_names(serving_history(spark, sf)), "D G")


@register
def price_text(spark: SparkSession, sf: str) -> DataFrame:
    return views.details(spark, sf).select(
        "item_id",
        format_price(minor_to_major(F.col("price.final")), F.col("price.currency")).alias(
            "ref_text"
        ),
    )


REGISTRY["format_price"] = REGISTRY.pop("price_text")


@register
def offer_display(spark: SparkSession, sf: str) -> DataFrame:
    return plain(serving.offer_display(serving_offers(spark, sf)))


@register
def history_display(spark: SparkSession, sf: str) -> DataFrame:
    return plain(serving.history_display(serving_history(spark, sf)))


@register
def kpis(spark: SparkSession, sf: str) -> DataFrame:
    found = serving.kpis(serving_offers(spark, sf, labelled=False), by=["snapshot_date"])
    rounded = {
        c: F.round(F.col(c).cast("decimal(18,8)"), 6).cast("double")
        for c in ("avg_discount", "avg_rating")
    }
    return found.withColumns(rounded)


@register
def tier_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return serving.tier_distribution(serving_offers(spark, sf, labelled=False), by=["snapshot_date"])


@register
def quadrant(spark: SparkSession, sf: str) -> DataFrame:
    return plain(serving.quadrant(serving_offers(spark, sf)))


@register
def history_series_info(spark: SparkSession, sf: str) -> DataFrame:
    return serving.history_series_info(serving_history(spark, sf), by=["item_id"])
