"""Lookups that read little: items by zones and filters, names by trigrams."""

from datetime import date, timedelta

import pytest
from helpers import leaf, rows
from pyspark.sql import functions as F

from pricetide.functions import text
from pricetide.sinks import clusters, lake, names
from pricetide.sources import tables

DAYS = [date(2026, 1, 1) + timedelta(n) for n in range(12)]


def history(spark, items=4000, days=DAYS):
    found = spark.range(items).crossJoin(spark.createDataFrame([(d,) for d in days], "snapshot_date date"))
    return found.select(
        F.format_string("i%05d", 2 * F.col("id")).alias("item_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("name"),
        (F.col("id") * 1.5).alias("sale_price"),
        "snapshot_date",
    )


def rows_read(df):
    """Rows that the scans of an executed plan gave, after the row groups they skipped."""
    df.collect()
    leaves, total = df._jdf.queryExecution().executedPlan().collectLeaves(), 0
    for i in range(leaves.size()):
        metrics = leaves.apply(i).metrics()
        if metrics.contains("numOutputRows"):
            total += metrics.apply("numOutputRows").value()
    return total


@pytest.fixture(scope="module")
def clustered(spark, tmp_path_factory):
    root = f"{tmp_path_factory.mktemp('c')}/history"
    written = clusters.write_clustered(history(spark), root, files=48, row_group=20_000, expected=200)
    assert written.rows == 48_000 and len(written.snapshots) == 12
    return root


def test_one_item_over_all_dates_reads_a_file_a_date(spark, clustered):
    whole = tables.read_table(spark, clustered)
    assert whole.count() == 48_000 and len(whole.inputFiles()) >= 48
    found = clusters.lookup(spark, clustered, ["i00842"])
    assert rows(found) == rows(whole.where("item_id = 'i00842'")) and found.count() == 12
    # one file a date, two where a cut goes through it
    assert 12 <= len(found.inputFiles()) <= 24
    assert rows_read(found) <= 48_000 / 10


def test_an_absent_item_reads_no_rows(spark, clustered):
    # between two items, so inside the bounds of a file: its Bloom filter or dictionary says no
    absent = clusters.lookup(spark, clustered, ["i00843"])
    assert 1 <= len(absent.inputFiles()) <= 24
    assert absent.count() == 0 and rows_read(absent) == 0
    outside = clusters.lookup(spark, clustered, ["j"])
    assert outside.count() == 0 and outside.inputFiles() == []


def test_several_items_and_some_dates(spark, clustered):
    whole = tables.read_table(spark, clustered)
    days = [str(DAYS[3]), str(DAYS[7])]
    found = clusters.lookup(spark, clustered, ["i00000", "i07998", "i00003"], snapshots=days)
    expected = whole.where(F.col("item_id").isin("i00000", "i07998") & F.col("snapshot_date").isin(DAYS[3], DAYS[7]))
    assert rows(found) == rows(expected) and found.count() == 4
    assert clusters.lookup(spark, clustered, []).count() == 0


def test_replaced_and_plain_snapshots_are_found_too(spark, tmp_path):
    root = f"{tmp_path}/h"
    clusters.write_clustered(history(spark, 200, DAYS[:3]), root, files=6)
    clusters.write_clustered(history(spark, 100, DAYS[1:2]).withColumn("sale_price", F.lit(0.0)), root, files=2)
    lake.replace_snapshots(history(spark, 50, DAYS[4:5]), root)
    whole = tables.read_table(spark, root)
    for item in ("i00010", "i00150", "i00398"):
        assert rows(clusters.lookup(spark, root, [item])) == rows(whole.where(F.col("item_id") == item))
    old = tmp_path / "old"
    history(spark, 20, DAYS[:2]).write.partitionBy("snapshot_date").parquet(str(old))
    assert clusters.lookup(spark, str(old), ["i00010"], schema=whole.schema).count() == 2
    lake.replace_snapshots(history(spark, 20, DAYS[2:3]), str(old))
    assert clusters.lookup(spark, str(old), ["i00010"], schema=whole.schema).count() == 3
    assert leaf(spark, str(old), DAYS[0]).endswith("old/snapshot_date=2026-01-01")


# --- names ---------------------------------------------------------------------------

NAMES = [
    "Red Green", "red greed", "INFRARED GLOW", "Écluse d'été", "ÉCLUSE D'ÉTÉ", "ab", "", "a%b_c", "100% red", "x(y)z[0]",
    "İstanbul nights", "ıstakoz", "Kelvin K scale", "ſtone age", "STONE AGE", "ΟΔΟΣ αβγ", "οδος", "tab\tname", "straße", "STRASSE",
    "back\\slash", "dots...", "plus+plus", "caret^", "q?mark", "日本語の名前", None,
]
LIKE = ["red", "RED %g", "r_d", "%", "", "\\%", "a\\%b\\_c", "écluse", "stone", "k scale", "istan", "ΟΔΟΣ", "strasse", "日本語", "nothing here", "d g%w"]
LITERAL = ["red", "RED G", "%", "", "100%", "écluse", "stone", "k s", "istan", "οδος", "ΟΔΟΣ", "[0]", "...", "\\s", "日本", "zzz"]
REGEX = ["red", "^(RED|blue) .*g", "gre+n", "gre*d", "infra(red)? glow", "stone", "STONE age$", "[gx]reed", "re{2}d", "kelvin k", "istan.ul",
         "istakoz", "a|b", "(?:red) green", "dots\\.", "écluse", "red.*glow", "nothing", "", "gr[e]ed", "x.y", "green|stone"]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    filler = [f"filler {n} thing number {n * 7919 % 1000}" for n in range(3000)]
    df = spark.createDataFrame([(n,) for n in NAMES + NAMES[:5] + filler], "name string")
    root = f"{tmp_path_factory.mktemp('n')}/names"
    assert names.write_names(df, root) == len(set(NAMES)) - 1 + len(set(filler))
    return root, df.distinct()


@pytest.mark.parametrize(
    ("search", "exact", "texts"),
    [(names.search_like, text.matches_like, LIKE), (names.search_literal, text.matches_literal, LITERAL),
     (names.search_regex, text.matches_regex, REGEX)],
)
def test_the_index_finds_what_the_exact_search_finds(spark, index, search, exact, texts):
    root, every = index
    every = [r.name for r in every.collect()]
    df = spark.createDataFrame([(n,) for n in every], "name string")
    for t in texts:
        found = search(spark, root, t).names
        assert rows(found) == rows(df.where(exact(F.col("name"), t))), t


def test_few_names_are_looked_at(spark, index):
    root, every = index
    found = names.search_like(spark, root, "infrared")
    assert len(found.grams) == names.USED and found.checked.count() == 1
    assert names.search_regex(spark, root, "number 79").checked.count() < 300
    assert names.search_literal(spark, root, "glow").checked.count() == 1
    # no trigram: all names
    short = names.search_literal(spark, root, "re")
    assert short.grams == () and short.checked.count() == every.count() - 1
    assert names.search_literal(spark, root, "no such name").checked.count() == 0


def test_runs_of_patterns():
    assert names.like_runs("RED %g_x\\%y") == ["RED ", "g", "x%y"]
    runs = lambda p: [r for r in names.regex_runs(p) if r]
    assert runs("^red.*gre+n$") == ["red", "gre", "n"]
    assert runs("gre*d glow") == ["gr", "d glow"] and runs("a{2,3}bcd") == ["bcd"]
    assert runs("(abc|def)ghi") == ["ghi"] and runs("abc|def") == [] and runs("ab[cd]ef") == ["ab", "ef"]
    assert runs("abc\\d") == runs("(?i)abc") == runs("abc(") == runs("[abc") == []
    assert runs("été") == ["t"] and runs("x[]a]y") == ["x", "y"]


def test_rows_of_found_names_and_a_new_index(spark, index, tmp_path):
    root, _ = index
    table = spark.createDataFrame([("Red Green", 1), ("red greed", 2), ("other", 3), ("Red Green", 4)], "name string, v int")
    found = names.with_names(table, names.search_literal(spark, root, "gree").names)
    assert sorted(r.v for r in found.collect()) == [1, 2, 4]
    own = f"{tmp_path}/n"
    names.write_names(table.select("name"), own)
    names.write_names(table.select("name").limit(0), own)
    assert names.search_like(spark, own, "red").names.count() == 0
    assert names.search_like(spark, own, "").names.count() == 0
