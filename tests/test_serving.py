from datetime import date

import pytest
from helpers import rows
from pyspark.sql import functions as F

from catalog import queries as q
from pricetide.functions.text import format_price
from pricetide.operators import conform, serving
from pricetide.schemas import SERVING_OFFERS, SERVING_TABLES

SF = "/root/testdata/sf0.001"
NAMES = ["Doom (2016)", "DOOM Eternal", "50% off", "a.b", "axb", None]


@pytest.fixture
def named(spark):
    return spark.createDataFrame([(n, "BOA") for n in NAMES], "name string, deal_tier string")


def found(df):
    return sorted(r.name for r in df.collect())


def test_three_searches_mean_three_things(spark, named):
    assert found(serving.search_regex(named, "doom (2016)")) == []
    assert found(serving.search_literal(named, "doom (2016)")) == ["Doom (2016)"]
    assert found(serving.search_regex(named, "A.B")) == ["a.b", "axb"]
    assert found(serving.search_literal(named, "A.B")) == ["a.b"]
    assert found(serving.search_literal(named, "%")) == ["50% off"]
    with pytest.raises(Exception, match="(?i)regex|pattern|unclosed group"):
        serving.search_regex(named, "(").collect()


def test_empty_search_and_empty_choice_filter_nothing(named):
    assert serving.search_regex(named, "").count() == len(NAMES)
    assert serving.search_literal(named, "").count() == len(NAMES)
    assert serving.tier_filter(named, []).count() == len(NAMES)
    assert serving.tier_filter(named, ["MEDIA"]).count() == 0
    assert serving.tier_filter(named).count() == len(NAMES)


def history(spark, *data):
    return spark.createDataFrame(
        data,
        "item_id int, name string, snapshot_date date, sale_price double, list_price double, "
        "ref_price double, ref_currency string, discount_pct double",
    )


def test_like_search_has_live_wildcards_and_orders_by_date(spark):
    data = history(
        spark,
        (1, "Doom", date(2026, 1, 2), 1.0, 1.0, None, None, 1.0),
        (1, "Doom", date(2026, 1, 1), 1.0, 1.0, 2.0, "BRL", 1.0),
        (2, "Door", date(2026, 1, 3), 1.0, 1.0, None, None, 1.0),
    )
    dates = [r.snapshot_date.day for r in serving.history_for_name(data, "d_o").collect()]
    assert dates == [1, 2, 3]
    assert serving.history_for_item(data, 1).count() == 2
    info = serving.history_series_info(data, by=["item_id"])
    assert rows(info) == [(1, True, "BRL"), (2, False, "")]


def test_series_currency_is_that_of_the_first_row(spark):
    data = history(
        spark,
        (1, "a", date(2026, 1, 1), 1.0, 1.0, None, None, 1.0),
        (1, "a", date(2026, 1, 2), 1.0, 1.0, 2.0, "USD", 1.0),
    )
    assert rows(serving.history_series_info(data)) == [(True, None)]


def test_best_offers_order(spark):
    data = spark.createDataFrame(
        [(1, "b", 10.0), (2, "a", 10.0), (3, "c", None), (4, "d", 90.0)],
        "item_id int, name string, discount_pct double",
    )
    missing = [c for c in serving.OFFER_REPORT if c not in data.columns]
    data = data.withColumns(
        {c: F.lit(None).cast("string") for c in missing if c != "snapshot_date"}
    ).withColumn("snapshot_date", F.lit("2026-01-01").cast("date"))
    assert [r.item_id for r in serving.best_offers(data).collect()] == [3, 4, 2, 1]


def test_top_k_is_ordered_and_cut(spark):
    top = q.top_makers(spark, SF).collect()
    assert len(top) <= 20
    assert top == sorted(top, key=lambda r: (-r.n_items, r.maker_name))
    everything = serving.top_makers(q.rank_makers(spark, SF), limit=None, snapshot=None)
    assert everything.count() == q.rank_makers(spark, SF).count()


def test_one_given_snapshot(spark):
    ranked = q.rank_makers(spark, SF)
    one = serving.of_snapshot(ranked, "1998-06-01")
    assert {r.snapshot_date for r in one.select("snapshot_date").collect()} == {date(1998, 6, 1)}


def test_tier_distribution_order_and_absent_tiers(spark):
    data = spark.createDataFrame(
        [("BAIXA",), ("EXCELENTE",), ("BAIXA",), ("MEDIA",)], "deal_tier string"
    )
    assert [tuple(r) for r in serving.tier_distribution(data).collect()] == [
        ("EXCELENTE", 1), ("MEDIA", 1), ("BAIXA", 2),
    ]


def test_kpis_and_their_texts(spark):
    data = spark.createDataFrame(
        [(80.0, 90, "EXCELENTE"), (25.5, None, "MEDIA"), (None, 71, "BAIXA")],
        "discount_pct double, rating_pct int, deal_tier string",
    )
    kpi = serving.kpis(data)
    assert rows(kpi) == [(3, 52.75, 80.5, 1)]
    assert rows(serving.kpi_texts(kpi)) == [(3, "52.8%", "81%", 1)]
    assert rows(serving.kpis(data.filter("false"))) == [(0, None, None, 0)]


def test_filter_coverage(named):
    assert rows(serving.filter_coverage(named, "doom", ["BOA"])) == [(2, 6, 4)]
    assert rows(serving.filter_coverage(named, "", [])) == [(6, 6, 0)]


def test_price_text(spark):
    data = spark.createDataFrame(
        [(12.3, "BRL"), (12.345, "USD"), (None, "BRL"), (0.0, None), (-3.5, "EUR"),
         (float("nan"), "USD"), (1234567.0, "USD")],
        "v double, c string",
    )
    assert [r[0] for r in data.select(format_price(F.col("v"), F.col("c"))).collect()] == [
        "R$12.30", "$12.35", "—", "$0.00", "$-3.50", "—", "$1234567.00",
    ]


def test_quadrant_lines_and_nulls(spark):
    data = spark.createDataFrame(
        [(1, 50.0, 70), (2, 50.0, 69), (3, 49.9, 70), (4, 0.0, 0), (5, None, 90), (6, 90.0, None)],
        "item_id int, discount_pct double, rating_pct int",
    ).withColumns(
        {c: F.lit("x") for c in ("snapshot_date", "name", "store", "deal_tier")}
    )
    got = {r.item_id: r.quadrant for r in serving.quadrant(data).collect()}
    assert got == {1: "best_deal", 2: "high_discount", 3: "high_rating", 4: "low"}


def test_snapshot_label(spark):
    data = spark.createDataFrame([("2026-01-09",), ("2025-12-31",)], "snapshot_date string")
    assert rows(serving.snapshot_label(data)) == [("09/01/2026",)]


def test_conform_types_lengths_and_losses(spark):
    row = q.offers(spark, SF).limit(1)
    wide = row.withColumns(
        {
            "name": F.repeat(F.lit("x"), 256),
            "discount_pct": F.lit(1000.0),
            "item_id": F.lit("no number"),
            "sale_price": F.lit(1.005),
        }
    )
    fitted = conform.conform(wide, SERVING_OFFERS)
    assert [f.name for f in fitted.schema.fields] == [f.name for f in SERVING_OFFERS.fields]
    assert fitted.schema["discount_pct"].dataType.simpleString() == "decimal(5,2)"
    got = fitted.first()
    assert got.item_id is None and got.discount_pct is None and str(got.sale_price) == "1.01"
    bad = {
        r.column_name: (r.n_lost, r.n_too_long)
        for r in conform.misfits(wide, SERVING_OFFERS).collect()
        if r.n_lost or r.n_too_long
    }
    assert bad == {"name": (0, 1), "discount_pct": (1, 0), "item_id": (1, 0)}


def test_all_gold_tables_fit_their_serving_tables(spark):
    tables = {
        "price_history": q.history(spark, SF),
        "offers": q.offers(spark, SF),
        "rank_makers": q.rank_makers(spark, SF),
        "rank_tags": q.rank_tags(spark, SF),
    }
    for name, df in tables.items():
        misfit = conform.misfits(df, SERVING_TABLES[name]).filter("n_lost + n_too_long > 0")
        assert misfit.count() == 0, name


def test_strict_reads_stop_at_a_value_that_does_not_fit(spark):
    data = spark.createDataFrame([("12", 1e9)], "item_id string, sale_price double")
    schema = type(SERVING_OFFERS)([f for f in SERVING_OFFERS.fields if f.name in data.columns])
    assert rows(conform.conform(data, schema)) == [(12, None)]
    with pytest.raises(Exception, match="sale_price does not fit"):
        conform.conform(data, schema, strict=True).collect()


def test_search_folds_letters_beyond_ascii(spark):
    names = spark.createDataFrame([("POKÉMON",), ("pokémon",), ("pokemon",)], "name string")
    assert serving.search_regex(names, "pokémon").count() == 2
