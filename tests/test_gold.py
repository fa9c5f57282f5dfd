from datetime import date

from helpers import rows
from pyspark.sql import functions as F

from catalog import queries as q
from pricetide.operators import gold, silver

SF = "/root/testdata/sf0.001"
ITEM = (
    "item_id string, discount_pct double, sale_price double, list_price double, rating_pct int, "
    "snapshot_date date"
)
DAY = date(2026, 1, 1)


def test_tiers(spark):
    given = [75.0, 74.996, 50.0, 49.99, 25.0, 24.9, 0.0, None]
    data = spark.createDataFrame([(x,) for x in given], "d double")
    assert [r[0] for r in data.select(gold.deal_tier(F.col("d"))).collect()] == [
        "EXCELENTE", "BOA", "BOA", "MEDIA", "MEDIA", "BAIXA", "BAIXA", "BAIXA",
    ]


def test_own_tiers(spark):
    tier = gold.deal_tier(F.col("id"), (("high", 2),), "low")
    assert [r[0] for r in spark.range(4).select(tier).collect()] == ["low", "low", "high", "high"]


def test_savings(spark):
    data = spark.createDataFrame(
        [(10.0, 9.995, "USD"), (5.0, 7.5, "USD"), (10.0, 1.0, "BRL"), (None, 1.0, "USD"),
         (1.0, 1.0, None)],
        "r double, s double, c string",
    )
    got = [r[0] for r in data.select(gold.savings(F.col("r"), F.col("s"), F.col("c"))).collect()]
    assert got == [0.01, -2.5, None, None, None]


def test_ranking_measures(spark):
    items = spark.createDataFrame(
        [("a", 10.0, 1.0, 2.0, 70, DAY), ("b", 15.005, 2.0, 3.0, None, DAY),
         ("c", None, 9.0, 9.0, 90, DAY)],
        ITEM,
    )
    makers = spark.createDataFrame(
        [("a", "m", DAY), ("a", "m", DAY), ("b", "m", DAY), ("b", None, DAY), ("x", "m", DAY)],
        "item_id string, maker_name string, snapshot_date date",
    )
    got = rows(gold.rank_makers(items, makers))
    assert got == [
        (DAY, "DESCONHECIDO", 1, 15.01, 2.0, 3.0, 15.01, None),
        (DAY, "m", 2, 12.5, 1.5, 2.5, 15.01, 70.0),
    ]


def test_tag_with_two_names_keeps_the_smallest_per_item(spark):
    items = spark.createDataFrame(
        [(i, 10.0, 1.0, 2.0, 70, DAY) for i in ("a", "b")], ITEM
    )
    tags = spark.createDataFrame(
        [("a", 1, "Action", DAY), ("a", 1, "ACTION", DAY), ("b", 1, "Action", DAY),
         ("b", None, "x", DAY)],
        "item_id string, tag_id int, tag_name string, snapshot_date date",
    )
    got = [r[1:4] for r in rows(gold.rank_tags(items, tags))]
    assert sorted(got, key=repr) == [(1, "ACTION", 1), (1, "Action", 1), (None, "x", 1)]


def test_rankings_of_records_equal_rankings_of_tables(spark):
    records = q.unlabelled(spark, SF)
    items = silver.silver_items(records)
    assert rows(gold.rank_makers(items, silver.maker_bridge(records))) == rows(
        gold.rank_makers_of_records(records)
    )
    assert rows(gold.rank_tags(items, silver.tag_bridge(records))) == rows(
        gold.rank_tags_of_records(records)
    )


def test_gold_dedupes_items_that_are_not_unique(spark):
    items = q.items(spark, SF)
    assert rows(gold.offers(items.unionAll(items))) == rows(gold.offers(items, unique_items=True))
    assert rows(gold.price_history(items.unionAll(items))) == rows(q.history(spark, SF))


def test_rank_by_counts_items_once(spark):
    items = spark.createDataFrame([("a", 1.0, 1.0, 1.0, 1, DAY)] * 3, ITEM)
    assert gold.rank_by(items, ["snapshot_date"]).first().n_items == 1


def test_ranking_counts_no_more_than_the_snapshot_has(spark):
    items = q.items(spark, SF).groupBy("snapshot_date").count()
    ranked = q.rank_makers(spark, SF).join(items, "snapshot_date")
    assert ranked.filter("n_items > count").count() == 0


def test_latest_snapshot(spark):
    data = spark.createDataFrame(
        [(1, date(2026, 1, 1)), (2, date(2026, 1, 3)), (3, date(2026, 1, 3))],
        "x int, snapshot_date date",
    )
    assert [r.x for r in gold.only_latest(data).orderBy("x").collect()] == [2, 3]
    empty = data.filter("x > 9")
    assert gold.only_latest(empty).count() == 0
    assert gold.latest_snapshot(empty).first()[0] is None
