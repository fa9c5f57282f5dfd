"""Physical plans: what must be in them, what must not, and what skew does."""

import re
from datetime import date

import pytest
from helpers import rows
from pyspark.sql import functions as F

from catalog import queries as q
from catalog import views
from pricetide.operators import enrich, gold, silver
from pricetide.sinks import lake
from pricetide.sources import tables

SF = "/root/testdata/sf0.001"
WRITERS = {
    "nested_envelope_roundtrip", "bronze_lineage", "read_snapshot", "snapshot_replace",
    "csv_export", "map_detail_explode", "layer_counts",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def run_plan(df):
    """The final adaptive plan, after running ``df``."""
    df.collect()
    return plan(df)


@pytest.mark.parametrize("key", sorted(set(q.REGISTRY) - WRITERS))
def test_no_python_no_cross_join_no_single_partition_window(spark, key):
    text = plan(q.REGISTRY[key](spark, SF))
    for node in ("Python", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text, node
    if "Window " in text:
        assert not re.search(r"Window \[.*windowspecdefinition\(ord", text)


def test_dedupe_cuts_groups_before_the_exchange(spark):
    text = plan(enrich.first_deals(views.deals(spark, SF)))
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_filter_on_the_snapshot_goes_below_the_dedupe(spark):
    first = enrich.first_deals(views.deals(spark, SF))
    text = plan(gold.only_latest(first, dates=views.deals(spark, SF)))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.index("Exchange hashpartitioning") < text.index("Subquery")


def test_ranking_reads_only_its_columns_and_shuffles_twice(spark):
    text = plan(q.rank_makers(spark, SF))
    assert text.count("Exchange hashpartitioning") == 2
    assert "l_tax" not in text and "s_name" not in text and "p_container" not in text


def test_top_k_is_not_a_full_sort(spark):
    text = plan(q.top_makers(spark, SF))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_silver_of_unique_records_does_not_shuffle(spark, tmp_path):
    lake.replace_snapshots(q.records(spark, SF), f"{tmp_path}/records")
    records = tables.read_table(spark, f"{tmp_path}/records")
    for df in (
        silver.silver_items(records, unique_records=True),
        silver.tag_bridge(records, unique_records=True),
        silver.maker_bridge(records, unique_records=True),
        gold.offers(silver.silver_items(records, unique_records=True), unique_items=True),
    ):
        assert "Exchange" not in plan(df)


def test_latest_snapshot_prunes_partitions_at_run_time(spark, tmp_path, capsys):
    lake.replace_snapshots(q.items(spark, SF), f"{tmp_path}/items")
    items = tables.read_table(spark, f"{tmp_path}/items")
    gold.only_latest(items).explain("formatted")
    shown = capsys.readouterr().out
    assert re.search(r"PartitionFilters: .*snapshot_date.*subquery", shown)
    assert "ReadSchema: struct<>" in shown


def test_default_stores_are_broadcast(spark):
    text = plan(enrich.label_stores(views.deals(spark, SF), enrich.default_stores(spark)))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_dedupe_and_lookup_per_snapshot_share_one_exchange(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    day = F.lit("1998-06-01").cast("date")
    deals = views.deals(spark, SF).withColumn("snapshot_date", day)
    details = views.details(spark, SF).withColumn("snapshot_date", day)
    found = enrich.lookup_details(enrich.first_deals(deals), details, enrich.ITEM_KEYS)
    # one for the deals, one for the details
    assert plan(found).count("Exchange hashpartitioning") == 2


# --- hot keys: a third of all rows in one key ---------------------------------------

DAY = date(2026, 1, 1)


@pytest.fixture
def skewed(conf):
    """Force shuffled joins and make small partitions count as skewed."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20KB")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.shuffle.partitions", "16")


def hot_deals(spark, n=30_000):
    """A third of the deals in one store and one item, a tenth without a store."""
    hot = F.col("id") % 3 == 0
    return spark.range(0, n, numPartitions=8).select(
        F.col("id").alias("ord1"),
        F.lit(0).alias("ord2"),
        F.when(hot, F.lit("hot")).otherwise((F.col("id") % 997).cast("string")).alias("item_id"),
        F.when(hot, F.lit("hot"))
        .when(F.col("id") % 10 == 1, F.lit(None))
        .otherwise((F.col("id") % 499).cast("string"))
        .alias("store_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("sale_price"),
        F.lit(DAY).alias("snapshot_date"),
    )


def test_hot_store_is_split_by_the_join(spark, skewed):
    stores = spark.range(500).select(
        F.when(F.col("id") == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias(
            "store_id"
        ),
        F.concat(F.lit("s"), "id").alias("store_name"),
    )
    labelled = enrich.label_stores(hot_deals(spark), stores)
    assert "SortMergeJoin(skew=true)" in run_plan(labelled)
    counts = dict(labelled.groupBy("store").count().collect())
    assert counts["s0"] == 10_000 and counts[None] == 2_000 and labelled.count() == 30_000


def test_hot_null_store_is_split_by_the_join(spark, skewed):
    stores = spark.range(500).select(
        F.col("id").cast("string").alias("store_id"), F.concat(F.lit("s"), "id").alias("store_name")
    )
    without = hot_deals(spark).withColumn("store_id", F.nullif("store_id", F.lit("hot")))
    labelled = enrich.label_stores(without, stores)
    assert "SortMergeJoin(skew=true)" in run_plan(labelled)
    assert labelled.where("store is null").count() == 12_000


def test_hot_item_leaves_each_task_as_one_row(spark):
    first = enrich.first_deals(hot_deals(spark))
    first.collect()
    assert first.count() == 998
    hot = first.filter("item_id = 'hot'").select("ord1")
    assert rows(hot) == [(0,)]


def test_hot_item_of_the_bridge_is_split_by_the_join(spark, skewed):
    items = spark.range(1000).select(
        F.when(F.col("id") == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias(
            "item_id"
        ),
        *[F.lit(1.0).alias(c) for c in ("discount_pct", "sale_price", "list_price")],
        F.lit(1).alias("rating_pct"),
        F.lit(DAY).alias("snapshot_date"),
    )
    makers = spark.range(0, 30_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .otherwise((F.col("id") % 997).cast("string"))
        .alias("item_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("maker_name"),
        F.lit(DAY).alias("snapshot_date"),
    )
    ranked = gold.rank_makers(items, makers, unique_items=True, unique_makers=True)
    assert "SortMergeJoin(skew=true)" in run_plan(ranked)


def test_audit_shuffles_counts_not_deals(spark):
    details = spark.range(998).select(
        F.col("id").cast("string").alias("item_id"), F.lit(True).alias("success")
    )
    audit = enrich.rejection_audit(hot_deals(spark), details)
    row = audit.drop("snapshot_date").first()
    assert tuple(row) == (30_000, 0, 30_000 - 998, 1, 997)
    # the deepest exchange carries partial counts
    text = plan(audit)
    assert "partial_count" in text[text.rindex("Exchange hashpartitioning") :]
