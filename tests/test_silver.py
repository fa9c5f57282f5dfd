import pytest
from helpers import rows
from pyspark.sql import functions as F

from pricetide.functions.numeric import avg_exact, finite, max_exact, minor_to_major, round_half_up
from pricetide.functions.text import clean_name
from pricetide.operators import gold, silver
from pricetide.schemas import BRONZE_RECORDS

COLUMNS = [
    "item_id", "name", "price", "sale_price", "list_price", "discount", "rating_label",
    "rating_pct", "store", "tags", "makers", "snapshot_date", "ord1", "ord2",
]
SCHEMA = ", ".join(
    f"{f.name} {f.dataType.simpleString()}" for f in BRONZE_RECORDS.fields if f.name in COLUMNS
)


def records(spark, *changes):
    base = dict(
        item_id="7", name=" Doom ", price=("USD", 1999, 999, 50), sale_price="9.99",
        list_price="19.99", discount="50.0", rating_label="Mixed", rating_pct="80", store="One",
        tags=[("1", "Action")], makers=["id"],
    )
    names = [f.name for f in BRONZE_RECORDS.fields if f.name in base]
    schema = ", ".join(f"{n} {BRONZE_RECORDS[n].dataType.simpleString()}" for n in names)
    data = [tuple({**base, **c}[n] for n in names) for c in changes]
    frame = spark.createDataFrame(
        [(*d, n, 0) for n, d in enumerate(data)], f"{schema}, ord1 int, ord2 int"
    )
    return frame.withColumn("snapshot_date", F.lit("2026-01-01").cast("date"))


def test_typed_projection(spark):
    row = silver.typed_projection(records(spark, {})).first()
    assert (row.name, row.sale_price, row.list_price, row.discount_pct) == ("Doom", 9.99, 19.99, 50)
    assert (row.ref_price, row.ref_list_price, row.ref_currency) == (9.99, 19.99, "USD")
    assert (row.rating_pct, row.offer_currency, row.ref_discount_pct) == (80, "USD", 50.0)


def test_malformed_text_is_null_and_counted(spark):
    bad = records(spark, {"sale_price": "free", "rating_pct": "95.0"}, {"list_price": None})
    typed = silver.typed_projection(bad).orderBy(F.col("sale_price").isNotNull())
    assert typed.first().sale_price is None and typed.first().rating_pct is None
    assert dict(silver.cast_losses(bad).collect()) == {
        "sale_price": 1, "list_price": 0, "discount": 0, "rating_pct": 1,
    }


def test_name_cleaning(spark):
    names = spark.createDataFrame(
        [("  a ",), ("\tb ",), ("",), ("  ",), (None,)], "n string"
    ).select(clean_name(F.col("n")))
    assert [r[0] for r in names.collect()] == ["a", "\tb", "", "", "DESCONHECIDO"]


def test_currency_and_price_filters(spark):
    given = records(
        spark,
        {"item_id": "usd"},
        {"item_id": "brl", "price": ("BRL", 100, 50, 50)},
        {"item_id": "eur", "price": ("EUR", 100, 50, 50)},
        {"item_id": "none", "price": None},
        {"item_id": None},
    )
    kept = silver.silver_items(given)
    assert sorted(r.item_id for r in kept.collect()) == ["brl", "usd"]


def test_filter_comes_before_dedupe(spark):
    given = records(spark, {"price": ("EUR", 1, 1, 0), "name": "x"}, {"name": "y"}, {"name": "z"})
    kept = silver.silver_items(given)
    assert [r.name for r in kept.collect()] == ["y"]


def test_unique_records_give_the_same_items(spark):
    given = records(spark, {}, {"item_id": "8"})
    assert rows(silver.silver_items(given)) == rows(
        silver.silver_items(given, unique_records=True)
    )


def test_tag_bridge(spark):
    given = records(
        spark,
        {"item_id": "a", "tags": [("1", " Action"), ("1", "Action "), ("x", None)]},
        {"item_id": "b", "tags": []},
        {"item_id": "c", "tags": None},
        {"item_id": "d", "price": None, "tags": [("2", "Indie")]},
        {"item_id": "a", "tags": [("1", "Action"), ("1", "ACTION")]},
    )
    got = rows(silver.tag_bridge(given).drop("snapshot_date"))
    assert got == sorted(
        [("a", 1, "Action"), ("a", None, "DESCONHECIDO"), ("a", 1, "ACTION"), ("d", 2, "Indie")],
        key=repr,
    )


def test_maker_bridge(spark):
    given = records(
        spark,
        {"item_id": "a", "makers": ["id", " id ", None]},
        {"item_id": "b", "makers": []},
        {"item_id": "c", "makers": None},
    )
    got = rows(silver.maker_bridge(given, unique_records=True).drop("snapshot_date"))
    assert got == [("a", "DESCONHECIDO"), ("a", "id")]


def test_processing_stamp(spark):
    row = silver.silver_items(records(spark, {}), "2026-01-01 07:00:00").first()
    assert str(row.processed_at) == "2026-01-01 07:00:00"


def test_rounding(spark):
    data = spark.createDataFrame(
        [(1.005,), (0.285,), (-1.005,), (None,), (float("nan"),)], "x double"
    )
    assert [r[0] for r in data.select(round_half_up(F.col("x"), 2)).collect()] == [
        1.01, 0.29, -1.01, None, None,
    ]
    assert data.agg(max_exact(F.col("x"), 2)).first()[0] == 1.01
    assert data.agg(avg_exact(F.col("x"), 2)).first()[0] == 0.1


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_odd_numbers_are_null_or_whole_under_both_settings(spark, conf, ansi):
    conf("spark.sql.ansi.enabled", ansi)
    odd = ["1.0049999999", "NaN", "Infinity", "-Infinity", "1e13", "1e300", "x", None]
    data = spark.createDataFrame([(t,) for t in odd], "x string")
    rounded = [r[0] for r in data.select(round_half_up(F.col("x"), 2)).collect()]
    assert rounded == [1.0, None, None, None, 1e13, None, None, None]
    assert data.agg(avg_exact(F.col("x"), 2), max_exact(F.col("x"), 2)).first() == (5e12 + 0.5, 1e13)
    losses = silver.cast_losses(data.withColumnRenamed("x", "discount"), {"discount": "double"})
    assert losses.first().n_lost == 5
    tiers = data.select(gold.deal_tier(finite(F.col("x"))), gold.deal_tier(F.col("x").try_cast("double")))
    assert {tuple(r) for r in tiers.where("x in ('NaN', 'Infinity')").collect()} == {("BAIXA", "BAIXA")}


def test_minor_units(spark):
    data = spark.createDataFrame([(1999,), (0,), (5,), (None,)], "x bigint")
    assert [r[0] for r in data.select(minor_to_major(F.col("x"))).collect()] == [
        19.99, 0.0, 0.05, None,
    ]
