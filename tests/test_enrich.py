import pytest
from helpers import rows
from pyspark.sql import functions as F

from pricetide.operators import dedupe, enrich, lineage

DEAL = (
    "ord1 bigint, ord2 int, item_id string, store_id string, sale_price string, "
    "list_price string, discount string, rating_label string, rating_pct string, "
    "snapshot_date date"
)
DETAIL = (
    "item_id string, success boolean, name string, price struct<currency:string,initial:bigint,"
    "final:bigint,discount_percent:bigint>, tags array<struct<id:string,description:string>>, "
    "makers array<string>"
)


def deal(spark, *pairs, day="2026-01-01"):
    """Deals given as (item, store), in arrival order."""
    data = [(n, 0, i, s, "1.5", "2", "25", None, "80") for n, (i, s) in enumerate(pairs)]
    schema = DEAL.rsplit(",", 1)[0]
    return spark.createDataFrame(data, schema).withColumn("snapshot_date", F.lit(day).cast("date"))


def detail(spark, *pairs):
    return spark.createDataFrame([(i, ok, "n", None, None, None) for i, ok in pairs], DETAIL)


def test_null_and_empty_keys_are_dropped(spark):
    kept = enrich.require_key(deal(spark, (None, "1"), ("", "1"), (" ", "1"), ("7", "1")))
    assert [r.item_id for r in kept.orderBy("ord1").collect()] == [" ", "7"]


def test_first_arrival_wins_per_snapshot(spark):
    deals = deal(spark, ("7", "a"), ("7", "b"), ("8", "c")).unionAll(
        deal(spark, ("7", "z"), day="2026-01-02")
    )
    kept = enrich.first_deals(deals).select("snapshot_date", "item_id", "store_id")
    assert [r[1:] for r in rows(kept)] == [("7", "a"), ("8", "c"), ("7", "z")]


def test_order_of_second_arrival_column(spark):
    data = spark.createDataFrame([("k", 1, 9), ("k", 1, 2), ("k", 3, 1)], "k string, a int, b int")
    assert rows(dedupe.keep_first(data, ["k"], ["a", "b"])) == [("k", 1, 2)]
    assert rows(dedupe.keep_last(data, ["k"], ["a", "b"])) == [("k", 3, 1)]


def test_key_counts_as_seen_although_its_lookup_failed(spark):
    deals = deal(spark, ("7", "a"), ("7", "b"), ("8", "c"), (None, "d"), ("", "e"), ("9", "f"))
    details = detail(spark, ("7", False), ("8", True))
    found = enrich.lookup_details(enrich.first_deals(deals), details)
    assert [r.item_id for r in found.collect()] == ["8"]
    audit = enrich.rejection_audit(deals, details).drop("snapshot_date")
    # received, missing key, duplicate, lookup failed, accepted
    assert rows(audit) == [(6, 2, 1, 2, 1)]


def test_success_that_is_null_is_a_failure(spark):
    deals, details = deal(spark, ("7", "a")), detail(spark, ("7", None))
    assert enrich.lookup_details(deals, details).count() == 0
    assert rows(enrich.rejection_audit(deals, details).drop("snapshot_date")) == [(1, 0, 0, 1, 0)]


def test_audit_parts_sum_to_received(spark):
    from catalog import views

    sf = "/root/testdata/sf0.001"
    audit = enrich.rejection_audit(views.deals(spark, sf), views.details(spark, sf))
    parts = F.expr("n_missing_key + n_duplicate + n_lookup_failed + n_accepted")
    assert audit.filter(parts != F.col("n_received")).count() == 0
    assert audit.agg(F.sum("n_received")).first()[0] == 6000


def test_store_labels(spark):
    stores = spark.createDataFrame([("1", "One")], "store_id string, store_name string")
    deals = deal(spark, ("a", "1"), ("b", "2"), ("c", None), ("d", ""))
    labelled = enrich.label_stores(deals, stores).orderBy("item_id").select("store")
    assert [r.store for r in labelled.collect()] == ["One", "Loja 2", None, None]


def test_store_dimension_keeps_last_name(spark):
    raw = spark.createDataFrame(
        [(1, "old", 1), (1, "new", 2), (2, "x", 1)], "store_id int, store_name string, ord1 int"
    )
    assert rows(enrich.store_dimension(raw, ["ord1"])) == [("1", "new"), ("2", "x")]


def test_default_stores(spark):
    stores = enrich.default_stores(spark)
    assert stores.count() == 15
    assert stores.filter("store_id = '7'").first().store_name == "GOG"


def test_lineage_and_manifest(spark):
    run = lineage.Run("r1", "2026-01-01 06:00:00", sources=("a", "b"))
    audit = enrich.rejection_audit(deal(spark, ("7", "a"), ("8", "b")), detail(spark, ("7", True)))
    row = lineage.run_manifest(audit, run, "bronze_enriched", rejections=True).first()
    assert (row.n_offers_received, row.n_items_processed, row.n_records) == (2, 1, 1)
    assert row.n_lookup_failed == 1
    assert (row.layer, row.version, row.sources) == ("bronze_enriched", "1.0.0", ["a", "b"])


def test_unique_violations(spark):
    twice = deal(spark, ("7", "a"), ("7", "b"), ("8", "c"))
    found = dedupe.unique_violations(twice).select("item_id", "n_rows")
    assert rows(found) == [("7", 2)]
    with pytest.raises(ValueError, match="repeat"):
        dedupe.require_unique(twice)
    assert dedupe.require_unique(twice.filter("ord1 > 0")).count() == 2
