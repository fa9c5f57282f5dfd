"""What queries shuffle and write does not grow faster than their tables."""

from datetime import date
from pathlib import Path

import pytest
from helpers import rows
from pyspark.sql import functions as F

from catalog import queries
from pricetide.operators import dedupe, enrich, lineage
from pricetide.session import option
from pricetide.sinks import lake
from pricetide.sources import tables

RUN = lineage.Run("r", "2026-01-01 06:00:00")


@pytest.fixture
def small(spark, tmp_path):
    """The base tables of 40 parts, 3 suppliers and a line for each part and of three months."""
    part = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    parts = [(i, f"red blue green {i}", f"Brand#{i % 5}", "TIN", i % 9, 10.0 + i) for i in range(1, 41)]
    spark.createDataFrame(parts, part).write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(i, f"s{i}") for i in range(3)], "s_suppkey bigint, s_name string").write.parquet(
        f"{tmp_path}/supplier.parquet"
    )
    lines = spark.range(120).select(
        F.col("id").alias("l_orderkey"),
        (F.col("id") % 40 + 1).alias("l_partkey"),
        (F.col("id") % 3).alias("l_suppkey"),
        F.lit(1).alias("l_linenumber"),
        F.lit(2.0).alias("l_quantity"),
        F.lit(30.0).alias("l_extendedprice"),
        F.lit(0.1).alias("l_discount"),
        F.add_months(F.lit("1995-01-05").cast("date"), (F.col("id") % 3).cast("int")).cast("timestamp_ntz").alias("l_shipdate"),
    )
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def placed(monkeypatch, folder):
    """Queries write below ``folder``."""
    names = iter(range(1000))
    monkeypatch.setattr(queries, "fresh_path", lambda spark, label: f"{folder}/{label}-{next(names)}")


def test_bronze_json_is_gzipped_and_reads_the_same(spark, tmp_path):
    df = spark.createDataFrame(
        [("1", "é", None, date(2026, 1, 1)), (None, "", "x\n", date(2026, 1, 2))],
        "item_id string, name string, store string, snapshot_date date",
    )
    stamped = lineage.stamp_lineage(df, RUN, "bronze_raw")
    lake.write_bronze(stamped, f"{tmp_path}/t")
    files = [p for p in Path(f"{tmp_path}/t").rglob("part-*") if not p.name.startswith(".")]
    assert files and all(p.name.endswith(".json.gz") for p in files)
    names = stamped.columns
    assert rows(tables.read_table(spark, f"{tmp_path}/t", stamped.schema, "json").select(names)) == rows(stamped)


def test_envelopes_are_gzipped(spark, small, tmp_path, monkeypatch):
    placed(monkeypatch, tmp_path / "work")
    got = queries.nested_envelope_roundtrip(spark, small).count()
    assert got and got == 2 * queries.records(spark, small).count()
    files = list((tmp_path / "work").rglob("part-*"))
    assert files and all(p.name.endswith(".json.gz") for p in files)


DEALS = "item_id string, snapshot_date date, ord1 int, ord2 int, sale_price string"
DETAILS = "item_id string, success boolean, name string, price int, tags array<string>, makers array<string>"


def test_details_brought_to_deals_are_those_looked_up(spark):
    day = date(2026, 1, 1)
    deals = [("1", day, 1, 1, "a"), ("1", date(2026, 2, 1), 2, 1, "b"), ("2", day, 3, 1, "c"), ("3", day, 4, 1, "d")]
    deals += [("1", day, 5, 1, "later"), ("", day, 6, 1, "e"), (None, day, 7, 1, "f"), ("9", day, 8, 1, "g")]
    deals = spark.createDataFrame(deals, DEALS)
    found = [("1", True, "n", 1, ["t"], []), ("2", False, "m", 2, None, None), ("3", True, None, None, None, None)]
    details = spark.createDataFrame([*found, ("3", True, "twice", 3, [], None), (None, True, "x", 1, [], [])], DETAILS)
    first = enrich.first_deals(deals)
    expected = enrich.lookup_details(first, details)
    assert rows(enrich.bring_details(first, details).select(expected.columns)) == rows(expected)
    undated = spark.createDataFrame([("1", None, 9, 1, "h")], DEALS)
    kept = enrich.bring_details(enrich.first_deals(undated), details).collect()
    assert [(r.sale_price, r.snapshot_date) for r in kept] == [("h", None)]  # for the write to refuse


def test_records_for_buckets_are_not_shuffled_with_their_details(spark, small, conf, monkeypatch):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    taken = []
    monkeypatch.setattr(queries.buckets, "write_buckets", lambda df, root, buckets, **_: taken.append(df))
    monkeypatch.setattr(queries.buckets, "together", lambda spark, roots: [None])
    queries.bucketed_records(spark, small)
    plan = taken[0].repartition(n, *dedupe.ITEM_KEYS)._jdf.queryExecution().executedPlan()
    assert taken[0].count() > 0
    pending, exchanged = [plan], []
    while pending:
        node = pending.pop()
        if "Exchange" in node.nodeName():
            exchanged.append(node.output().mkString(","))
        pending += [node.children().apply(i) for i in range(node.children().size())]
    assert exchanged and not [o for o in exchanged if "sale_price" in o and "tags" in o]


def test_layers_are_written_without_sending_rows_of_a_date_together_again(spark, small, tmp_path, monkeypatch):
    placed(monkeypatch, tmp_path / "work")
    write, spreads = lake.replace_snapshots, {}

    def seen(df, root, *args, **options):
        spreads[root.rsplit("/", 1)[1]] = options.get("spread")
        return write(df, root, *args, **options)

    monkeypatch.setattr(queries.lake, "replace_snapshots", seen)
    counts = dict(queries.layer_counts(spark, small).collect())
    found = queries.records(spark, small)
    assert counts["items"] == queries.items(spark, small).count() > 0
    assert counts["makers"] == queries.silver.maker_bridge(found, unique_records=True).count()
    assert spreads == {"records": None, "items": False, "tags": False, "makers": False}


STAMPED = "ord1 int, ord2 int, item_id string, store_id string, snapshot_date date, " + ", ".join(
    f"{c} string" for c in ("sale_price", "list_price", "discount", "rating_label", "rating_pct")
)
NESTED = "item_id string, success boolean, name string, price int, tags array<string>, makers array<string>"


def stamped(spark, *keys):
    """Deals of (item, store, date), arriving in this order."""
    rows = [(i, 1, *key, f"p{i}", None, "", "g", "7") for i, key in enumerate(keys)]
    return spark.createDataFrame(rows, STAMPED)


def dimensions(spark):
    """Details and stores of which some have a null key, fail or come twice."""
    details = [("1", True, "n", 1, ["t"], []), ("2", False, "m", 2, [], []), ("4", None, "l", 3, None, None)]
    details += [("3", True, None, None, None, None), ("3", True, "twice", 3, [], None), (None, True, "x", 1, [], [])]
    stores = [("a", "A"), ("b", None), ("c", "C"), ("c", "again"), (None, "none"), ("", "empty")]
    return spark.createDataFrame(details, NESTED), spark.createDataFrame(stores, "store_id string, store_name string")


@pytest.mark.parametrize("threshold", ["-1", "10m"])
@pytest.mark.parametrize("cells", [1, 50])
def test_records_by_date_are_the_enriched_ones(spark, conf, cells, threshold):
    conf("spark.sql.autoBroadcastJoinThreshold", threshold)
    days = [date(2026, 1, 1), date(2026, 2, 1), date(2026, 3, 1)]
    keys = [(i, s, d) for d in days for s in ("a", "c", None, "x", "", "b") for i in ("1", "2", "3", "4", "9", "", None)]
    deals = stamped(spark, *keys, ("1", "b", date(2026, 4, 1)), ("3", "c", date(2026, 4, 1)), ("1", "c", date(2026, 5, 1)))
    # the arrival that is first is not the first of its task
    deals = deals.withColumn("ord1", -F.col("ord1")).withColumn("ord2", F.col("ord1") % 3)
    details, stores = dimensions(spark)
    expected = enrich.enriched_records(deals, details, stores)
    assert expected.count() > 10
    found = enrich.records_by_date(deals, details, stores, cells)
    assert found.columns == expected.columns
    assert rows(found) == rows(expected)
    with option(spark, *enrich.JOIN_IN_CELLS):
        assert rows(enrich.records_by_date(deals, details, stores, cells)) == rows(expected)


def test_undated_records_are_refused_if_they_have_details(spark, tmp_path):
    day, (details, stores) = date(2026, 1, 1), dimensions(spark)
    deals = stamped(spark, ("1", "a", day), ("1", "a", None), ("1", "b", None), ("3", "c", None), ("9", "a", None))
    n = enrich.enriched_records(deals, details, stores.dropDuplicates(["store_id"])).filter("snapshot_date is null").count()
    found = enrich.records_by_date(deals, details, stores, 20)
    assert n == 3
    with option(spark, *enrich.JOIN_IN_CELLS), pytest.raises(lake.Refused, match=f"{n} rows have no snapshot_date"):
        lake.replace_snapshots(found, f"{tmp_path}/t", together=True)
    failed = stamped(spark, ("1", "a", day), ("2", "a", None), ("9", "b", None), ("", "b", None))
    found = enrich.records_by_date(failed, details, stores, 20)
    assert lake.replace_snapshots(found, f"{tmp_path}/t", together=True).rows == 1


def test_layers_move_each_deal_once(spark, small, tmp_path, conf, monkeypatch):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.shuffle.partitions", "3")
    before = spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition")
    placed(monkeypatch, tmp_path / "work")
    write, plans = lake.replace_snapshots, {}

    def seen(df, root, *args, **options):
        conf("spark.sql.adaptive.enabled", "false")
        name = root.rsplit("/", 1)[1]
        # the writer's own sort and exchange included
        rows = df if options.get("together") or options.get("spread") is False else df.repartition("snapshot_date")
        plans[name] = rows.sortWithinPartitions("snapshot_date")._jdf.queryExecution().executedPlan()
        return write(df, root, *args, **options)

    monkeypatch.setattr(queries.lake, "replace_snapshots", seen)
    queries.layer_counts(spark, small)
    pending, exchanged, sorts = [plans["records"]], [], []
    while pending:
        node = pending.pop()
        if "Exchange" in node.nodeName():
            exchanged.append(node.output().mkString(","))
        if node.nodeName() == "Sort":
            sorts.append(node.output().mkString(","))
        pending += [node.children().apply(i) for i in range(node.children().size())]
    assert len([o for o in exchanged if "sale_price" in o]) == 1
    assert not [o for o in exchanged if "sale_price" in o and "tags" in o]
    assert len([o for o in sorts if "sale_price" in o]) == 1  # by the dedupe, after the exchange
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == before


def test_dates_have_parts_by_their_size(spark):
    days = [date(2026, 1, 1)] * 900 + [date(2026, 2, 1)] * 90 + [date(2026, 3, 1)] * 9 + [None] * 500
    deals = stamped(spark, *[(f"{i}", "a", d) for i, d in enumerate(days)])
    dealt = enrich.cells_of_dates(deals, 15)
    assert dealt.columns == [*deals.columns, enrich.PART]
    assert rows(dealt.drop(enrich.PART)) == rows(deals)
    parts = dict(dealt.groupBy("snapshot_date").agg(F.count_distinct(enrich.PART)).collect())
    assert parts == {date(2026, 1, 1): 10, date(2026, 2, 1): 1, date(2026, 3, 1): 1, None: 1}
    assert dealt.groupBy("item_id").agg(F.count_distinct(enrich.PART).alias("n")).filter("n > 1").isEmpty()
    assert enrich.cells_of_dates(deals.limit(0), 15).count() == 0


def test_an_option_is_as_before_afterwards(spark, conf):
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    conf(name, "true")
    with pytest.raises(ZeroDivisionError), option(spark, name, "false"):
        assert spark.conf.get(name) == "false"
        1 / 0
    assert spark.conf.get(name) == "true"
    with option(spark, name, "false", override=False):
        assert spark.conf.get(name) == "true"
    assert spark.conf.get(name) == "true"
    spark.conf.unset(name)
    with option(spark, name, "false", override=False):
        assert spark.conf.get(name) == "false"
    assert spark.conf.get(name, None) is None
