"""Publishing: what readers see when a write fails, is refused, races or is repeated."""

from concurrent.futures import ThreadPoolExecutor
from datetime import date

import pytest
from helpers import leaf, rows
from pyspark.sql import functions as F

from pricetide import manifest
from pricetide.operators import checks
from pricetide.sinks import buckets, lake
from pricetide.sources import tables

D1, D2, D3 = date(2026, 1, 1), date(2026, 1, 2), date(2026, 1, 3)
SCHEMA = "x int, t string, snapshot_date date"


@pytest.fixture
def base(spark):
    return spark.createDataFrame([(1, "a", D1), (2, None, D1), (3, "c", D2)], SCHEMA)


@pytest.fixture
def root(base, tmp_path):
    lake.replace_snapshots(base, f"{tmp_path}/t")
    return f"{tmp_path}/t"


def whole(spark, root, **options):
    return rows(tables.read_table(spark, root, **options))


def test_failure_between_write_and_publication_leaves_the_table(spark, base, root, monkeypatch):
    def fail(*_):
        raise OSError("the driver is lost here")

    monkeypatch.setattr(manifest.Files, "rename", fail)
    with pytest.raises(OSError):
        lake.replace_snapshots(base.withColumn("x", F.lit(9)), root, [D1, D2, D3])
    with pytest.raises(OSError):
        lake.clear_snapshots(spark, root, [D1, D2])
    monkeypatch.undo()
    assert whole(spark, root) == rows(base)
    # the repeat is not disturbed by what was left behind
    lake.replace_snapshots(base.withColumn("x", F.lit(9)), root)
    assert {r[0] for r in whole(spark, root)} == {9}


def test_failing_task_leaves_the_table(spark, base, root):
    bad = base.withColumn("x", F.when(F.col("x") == 3, F.raise_error(F.lit("no")).cast("int")).otherwise(F.col("x")))
    with pytest.raises(Exception, match="no"):
        lake.replace_snapshots(bad, root)
    assert whole(spark, root) == rows(base)


def test_emptied_and_replaced_dates_change_in_one_step(spark, base, root):
    lake.replace_snapshots(spark.createDataFrame([(9, "z", D3)], SCHEMA), root, [D1, D2])
    assert [manifest.numbers(manifest.Files(spark, root), root)] == [[1, 2]]
    assert whole(spark, root) == [(9, "z", D3)]
    assert whole(spark, root, version=1) == rows(base)
    assert rows(tables.read_snapshot(spark, root, [str(D1), str(D3)], version=1)) == rows(base.where(F.col("x") < 3))


def test_a_table_may_be_rewritten_from_itself(spark, base, root):
    again = tables.read_table(spark, root)
    lake.replace_snapshots(again.withColumn("x", F.col("x") * 10), root)
    assert {r[0] for r in whole(spark, root)} == {10, 20, 30}


def test_a_refused_write_is_not_shown(spark, base, root):
    twice = base.unionByName(base.withColumn("t", F.lit("long text")))
    with pytest.raises(lake.Refused, match="unique.*n_rows"):
        lake.replace_snapshots(twice, root, checks=[checks.unique("snapshot_date", "x")])
    assert whole(spark, root) == rows(base)
    with pytest.raises(lake.Refused, match="no snapshot_date"):
        lake.replace_snapshots(base.unionByName(spark.createDataFrame([(5, "e", None)], SCHEMA)), root)
    with pytest.raises(lake.Refused, match="x is int"):
        lake.replace_snapshots(spark.createDataFrame([("5", D3)], "x string, snapshot_date date"), root)
    assert whole(spark, root) == rows(base)
    # all dates replaced: the type may change
    lake.replace_snapshots(spark.createDataFrame([("5", D3)], "x string, snapshot_date date"), root, [D1, D2])
    assert whole(spark, root) == [("5", D3)]


def test_checks_see_staged_rows(spark, base, root):
    from pyspark.sql.types import IntegerType, StructField, StructType, VarcharType

    narrow = StructType([StructField("x", IntegerType()), StructField("t", VarcharType(3))])
    lake.replace_snapshots(base, root, checks=[checks.fits(narrow), checks.at_least(3)])
    with pytest.raises(lake.Refused, match="n_too_long"):
        lake.replace_snapshots(base.withColumn("t", F.lit("four")), root, checks=[checks.fits(narrow)])
    with pytest.raises(lake.Refused, match="n_rows"):
        lake.replace_snapshots(base, root, checks=[checks.at_least(4)])
    with pytest.raises(lake.Refused, match="n_null"):
        lake.replace_snapshots(base, root, checks=[checks.filled("x", "t")])


def test_writers_of_different_dates_do_not_lose_each_other(spark, tmp_path):
    days = [date(2026, 2, d) for d in range(1, 9)]
    one = lambda d: lake.replace_snapshots(spark.createDataFrame([(d.day, "w", d)], SCHEMA), f"{tmp_path}/t", [d])
    with ThreadPoolExecutor(8) as pool:
        versions = [w.version for w in pool.map(one, days)]
    assert sorted(versions) == list(range(1, 9))
    assert [r[0] for r in whole(spark, f"{tmp_path}/t")] == list(range(1, 9))


def test_snapshots_without_versions_are_taken_over(spark, base, tmp_path):
    root = f"{tmp_path}/old"
    base.write.partitionBy("snapshot_date").parquet(root)
    assert whole(spark, root, schema=base.schema) == rows(base)
    lake.replace_snapshots(spark.createDataFrame([(9, "z", D2)], SCHEMA), root)
    assert sorted(r[0] for r in whole(spark, root, schema=base.schema)) == [1, 2, 9]
    assert rows(tables.read_snapshot(spark, root, str(D1), base.schema)) == rows(base.where("x < 3"))


def test_new_columns_are_null_in_older_snapshots(spark, base, root):
    wider = spark.createDataFrame([(4, "d", 1.5, D3)], "x int, t string, y double, snapshot_date date")
    lake.replace_snapshots(wider, root)
    found = {r.x: r for r in tables.read_table(spark, root).collect()}
    assert found[4].y == 1.5 and found[1].y is None and found[3].t == "c"
    lake.replace_snapshots(base.drop("t"), root, [D1, D2])
    found = {r.x: r for r in tables.read_table(spark, root).collect()}
    assert found[1].t is None and found[4].t == "d"


def test_vacuum_keeps_what_versions_name(spark, base, root):
    old = leaf(spark, root, D1)
    for n in range(3):
        lake.replace_snapshots(base.where("x < 3").withColumn("x", F.lit(n)), root)
    assert manifest.vacuum(spark, root) == []  # all folders are young
    assert len(manifest.vacuum(spark, root, keep=1, older_than_s=0)) == 2
    assert sorted(r[0] for r in whole(spark, root)) == [2, 2, 3]
    files = manifest.Files(spark, root)
    assert manifest.numbers(files, root) == [4]
    # the first folder still holds the other date
    assert files.names(old) and len(files.names(f"{root}/data")) == 2


def test_unpartitioned_tables_are_replaced_in_one_step(spark, tmp_path, monkeypatch):
    root = f"{tmp_path}/stores"
    lake.replace_table(spark.createDataFrame([("1", "a")], "id string, name string"), root)
    monkeypatch.setattr(manifest, "current", manifest.current)
    with pytest.raises(lake.Refused, match="unique"):
        lake.replace_table(
            spark.createDataFrame([("1", "b"), ("1", "c")], "id string, name string"), root, [checks.unique("id")]
        )
    assert whole(spark, root) == [("1", "a")]
    lake.replace_table(spark.createDataFrame([("2", "b")], "id string, name string"), root)
    assert whole(spark, root) == [("2", "b")] and whole(spark, root, version=1) == [("1", "a")]


# --- buckets ------------------------------------------------------------------------


def facts(spark, n=500, days=(D1, D2)):
    day = F.when(F.col("id") % 2 == 0, F.lit(days[0])).otherwise(F.lit(days[1]))
    return spark.range(n).select(
        F.concat(F.lit("i"), (F.col("id") / 2).cast("int")).alias("item_id"), F.col("id").alias("v"), day.alias("snapshot_date")
    )


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_tables_join_without_an_exchange(spark, conf, tmp_path):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    a, b = f"{tmp_path}/a", f"{tmp_path}/b"
    names = facts(spark).select("snapshot_date", "item_id", F.explode(F.array(F.lit("p"), F.lit("q"))).alias("name"))
    assert buckets.write_buckets(facts(spark), a, buckets=4).rows == 500
    buckets.write_buckets(names, b, buckets=4)
    groups = list(buckets.together(spark, [a, b]))
    assert len(groups) == 1
    joined = groups[0][0].join(groups[0][1], ["snapshot_date", "item_id"])
    assert "Exchange" not in plan(joined) and "Bucketed: true" in plan(joined)
    assert rows(joined) == rows(facts(spark).join(names, ["snapshot_date", "item_id"]))
    assert len(tables.read_table(spark, a).inputFiles()) == 4


def test_replaced_snapshots_of_a_bucketed_table(spark, tmp_path):
    root, other = f"{tmp_path}/a", f"{tmp_path}/b"
    for where in (root, other):
        buckets.write_buckets(facts(spark), where, buckets=4)
    changed = facts(spark, days=(D2, D3)).withColumn("v", -F.col("v"))
    buckets.write_buckets(changed, root, [D2, D3], buckets=4)
    expected = rows(facts(spark).where(F.col("snapshot_date") == F.lit(D1)).unionByName(changed))
    assert whole(spark, root) == expected
    assert rows(tables.read_snapshot(spark, root, str(D2))) == rows(changed.where(F.col("snapshot_date") == F.lit(D2)))
    groups = [(a, b) for a, b in buckets.together(spark, [root, other])]
    assert len(groups) == 2  # D1 of one run, D2 of two
    join = lambda a, b: a.join(b.withColumnRenamed("v", "w"), ["snapshot_date", "item_id"])
    joined = buckets.joined(spark, [root, other], join)
    plain = tables.read_table(spark, root).join(
        tables.read_table(spark, other).withColumnRenamed("v", "w"), ["snapshot_date", "item_id"]
    )
    assert rows(joined) == rows(plain)
    assert buckets.joined(spark, [root, other], join, [str(D3)]) is None
    with pytest.raises(lake.Refused, match="other snapshots"):
        lake.replace_snapshots(changed.where(F.col("snapshot_date") == F.lit(D3)), root)
    assert whole(spark, root) == expected
    buckets.write_buckets(changed.limit(0), root, [D1, D2, D3], buckets=4)
    assert whole(spark, root) == []
