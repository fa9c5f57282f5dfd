"""Rankings merged from stored states, against the ranking of all rows."""

import pytest
from helpers import rows
from pyspark.sql import functions as F

from catalog import queries as q
from pricetide.operators import gold, silver, states
from pricetide.sinks import lake
from pricetide.sources import tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def joined(spark, tmp_path_factory):
    root = f"{tmp_path_factory.mktemp('s')}/j"
    records = q.unlabelled(spark, SF)
    items = silver.silver_items(records, unique_records=True)
    gold.join_makers(items, silver.maker_bridge(records, unique_records=True)).write.parquet(root)
    return spark.read.parquet(root)


@pytest.mark.parametrize("ends", [("1995-03-01", "1996-08-01"), (None, None), ("1997-01-01", None), ("2050-01-01", None)])
def test_merged_states_equal_the_ranking_of_the_rows(joined, ends):
    dims = ["maker_name"]
    merged = states.merged_ranking(
        states.between(states.rank_states(joined, dims), *ends), states.between(states.item_sets(joined, dims, 3), *ends), dims
    )
    direct = gold.rank_by(states.between(joined, *ends), dims)
    assert merged.columns == direct.columns
    assert rows(merged) == rows(direct)


def test_a_corrected_snapshot_replaces_its_states(spark, joined, tmp_path):
    dims = ["maker_name"]
    write = lambda df, name: lake.replace_snapshots(df, f"{tmp_path}/{name}")
    write(states.rank_states(joined, dims), "states")
    write(states.item_sets(joined, dims), "sets")
    day = "1996-05-01"
    fixed = joined.where(F.col("snapshot_date") == day).withColumn("sale_price", F.col("sale_price") / 3).where("item_id <> '42'")
    write(states.rank_states(fixed, dims), "states")
    write(states.item_sets(fixed, dims), "sets")
    whole = joined.where(F.col("snapshot_date") != day).unionByName(fixed)
    merged = states.merged_ranking(
        tables.read_table(spark, f"{tmp_path}/states"), tables.read_table(spark, f"{tmp_path}/sets"), dims
    )
    assert rows(merged) == rows(gold.rank_by(whole, dims))


def test_null_measures_and_groups(spark):
    joined = spark.createDataFrame(
        [("2026-01-01", None, "a", None, 1.5, None, None), ("2026-01-02", None, "a", 10.0, None, None, 7),
         ("2026-01-02", "m", "b", None, None, None, None)],
        "snapshot_date string, maker_name string, item_id string, discount_pct double, sale_price double, "
        "list_price double, rating_pct int",
    ).withColumn("snapshot_date", F.to_date("snapshot_date"))
    dims = ["maker_name"]
    merged = states.merged_ranking(states.rank_states(joined, dims), states.item_sets(joined, dims), dims)
    assert rows(merged) == rows(gold.rank_by(joined, dims))
