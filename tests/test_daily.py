"""The whole run over landed files, twice, on two dates."""

import json

import pytest
from helpers import rows
from pyspark.sql import functions as F

from pricetide import schemas
from pricetide.functions.text import natural_order
from pricetide.operators import gold
from pricetide.operators.lineage import Run
from pricetide.plans import daily
from pricetide.sinks import buckets, clusters, jdbc, lake
from pricetide.sources import tables
from test_sources import envelope, write


def landing(path, deals, details, stores):
    write(path / "deals/p1.json", deals)
    write(path / "stores/s.json", stores)
    write(path / "details/d.json", "\n".join(map(json.dumps, details)))
    return str(path)


def a_deal(item, store="1", sale="5.00", savings="80"):
    return {"steamAppID": item, "storeID": store, "salePrice": sale, "normalPrice": "25.00",
            "savings": savings, "steamRatingPercent": "90"}


def a_detail(item, name, currency="USD", tags=(("1", "Action"),), makers=("id",), success=True):
    price = currency and {"currency": currency, "initial": 2500, "final": 1000,
                          "discount_percent": 60}
    data = {"name": name, "price_overview": price, "developers": list(makers),
            "genres": [{"id": i, "description": d} for i, d in tags]}
    return {item: {"success": success, "data": data}}


DETAILS = [
    a_detail("7", " Doom "),
    a_detail("8", "Hades", "BRL", tags=(("1", "Action"), ("2", "Indie")), makers=("sg", "id")),
    a_detail("9", "Euro", "EUR"),
    a_detail("6", "Gone", success=False),
]
DEALS = [a_deal(None), a_deal(""), a_deal("7"), a_deal("7", sale="1.00"), a_deal("8", "99"),
         a_deal("9"), a_deal("6"), a_deal("5")]
STORES = [{"storeID": "1", "storeName": "old"}, {"storeID": 1, "storeName": "One"}]
AT = "2026-01-01 06:00:00"
LAYOUT = ["--arrays"]


def run_all(spark, where, root, day, **options):
    return [
        daily.run_bronze(spark, where, root, day, Run("r", AT, sources=("a",)), lines=False, **options),
        daily.run_silver(spark, root, [day], AT),
        daily.run_gold(spark, root, [day]),
    ]


def gold_rows(spark, root):
    return {
        name: rows(tables.read_table(spark, f"{root}/gold/{name}", schema))
        for name, schema in schemas.GOLD_TABLES.items()
    }


@pytest.fixture
def lake_root(spark, tmp_path):
    where = landing(tmp_path / "in", DEALS, DETAILS, STORES)
    root = f"{tmp_path}/lake"
    return where, root, run_all(spark, where, root, "2026-01-01")


def test_layers(spark, lake_root):
    _, root, counts = lake_root
    assert counts == [
        {"deals": 8, "records": 3},
        {"items": 2, "tags": 4, "makers": 4},
        {"price_history": 2, "offers": 2, "rank_makers": 2, "rank_tags": 2},
    ]
    offers = tables.read_table(spark, f"{root}/gold/offers", schemas.GOLD_TABLES["offers"])
    got = rows(offers.select("item_id", "name", "sale_price", "store", "savings", "deal_tier"))
    assert got == [
        ("7", "Doom", 5.0, "One", 5.0, "EXCELENTE"),
        ("8", "Hades", 5.0, "Loja 99", None, "EXCELENTE"),
    ]
    makers = tables.read_table(spark, f"{root}/gold/rank_makers", schemas.GOLD_TABLES["rank_makers"])
    assert rows(makers.select("maker_name", "n_items", "avg_rating")) == [
        ("id", 2, 90.0), ("sg", 1, 90.0),
    ]
    manifest = tables.read_table(spark, f"{root}/bronze/manifest", schemas.BRONZE_MANIFEST)
    got = manifest.select("n_offers_received", "n_missing_key", "n_duplicate", "n_lookup_failed",
                          "n_records")
    assert rows(got) == [(8, 2, 1, 2, 3)]


def test_repeat_and_second_date(spark, lake_root, tmp_path):
    where, root, _ = lake_root
    before = gold_rows(spark, root)
    run_all(spark, where, root, "2026-01-01")
    assert gold_rows(spark, root) == before
    run_all(spark, where, root, "2026-01-02", stores=False)
    after = gold_rows(spark, root)
    assert all(len(after[n]) == 2 * len(before[n]) for n in before)
    assert all(set(before[n]) <= set(after[n]) for n in before)
    offers = tables.read_snapshot(spark, f"{root}/gold/offers", "2026-01-02")
    assert {r.store for r in offers.collect()} == {"Steam", "Loja 99"}
    # a re-run in which nothing is accepted empties the date in every layer
    nothing = landing(tmp_path / "none", [a_deal("5")], DETAILS, STORES)
    run_all(spark, nothing, root, "2026-01-02")
    assert gold_rows(spark, root) == before


def test_load_takes_the_latest_snapshot_only(spark, lake_root, monkeypatch):
    where, root, _ = lake_root
    run_all(spark, where, root, "2026-01-02")
    loads = []
    monkeypatch.setattr(
        jdbc, "load_snapshots", lambda df, target, table, dates: loads.append(
            (table, df.columns, {str(r.snapshot_date) for r in df.collect()}, dates)
        )
    )
    target = jdbc.Target("jdbc:none")
    loaded = daily.run_load(spark, root, target, names={"offers": "fact_offers"})
    assert set(loaded) == set(schemas.SERVING_TABLES)
    assert [table for table, *_ in loads] == [
        "price_history", "fact_offers", "rank_makers", "rank_tags",
    ]
    for _, columns, dates, asked in loads:
        assert dates == {"2026-01-02"} and asked == ["2026-01-02"]
    daily.run_load(spark, root, target, ["2026-01-01"])
    assert {d for *_, dates in loads[4:] for d in dates} == {"2026-01-01"}


def test_load_stops_before_the_target_if_a_value_does_not_fit(spark, tmp_path, monkeypatch):
    long_name = a_detail("7", "x" * 300)
    where = landing(tmp_path / "in", [a_deal("7")], [long_name], STORES)
    run_all(spark, where, f"{tmp_path}/lake", "2026-01-01")
    monkeypatch.setattr(jdbc, "load_snapshots", lambda *a: pytest.fail("target was touched"))
    with pytest.raises(ValueError, match="n_too_long"):
        daily.run_load(spark, f"{tmp_path}/lake", jdbc.Target("jdbc:none"))


def test_existing_documents_are_taken_over(spark, tmp_path):
    record = {"steam_app_id": "7", "nome": "Doom", "preco_oferta": "5.0", "desconto": "80",
              "preco_steam": {"currency": "USD", "initial": 2500, "final": 1000},
              "desenvolvedores": ["id"]}
    for day in ("2026-01-01", "2026-01-02"):
        document = envelope(record, {**record, "nome": "later"}, {**record, "steam_app_id": ""})
        document["metadata"]["data_ingestao"] = day
        write(tmp_path / f"in/{day}.json", json.dumps(document, indent=4))
    root = f"{tmp_path}/lake"
    written = daily.import_envelopes(spark, f"{tmp_path}/in", root, Run("r", AT))
    assert written.rows == 2 and len(written.snapshots) == 2
    days = ["2026-01-01", "2026-01-02"]
    assert daily.run_silver(spark, root, days, AT) == {"items": 2, "tags": 0, "makers": 2}
    assert daily.run_gold(spark, root, days)["rank_makers"] == 2
    offers = tables.read_table(spark, f"{root}/gold/offers", schemas.GOLD_TABLES["offers"])
    assert rows(offers.select("name", "savings")) == [("Doom", 5.0), ("Doom", 5.0)]


def test_command_line(spark, lake_root, capsys, monkeypatch):
    _, root, _ = lake_root
    daily.main(["gold", "--root", root, "--snapshot", "2026-01-01", "--at", AT])
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["offers"] == 2


def test_command_line_takes_each_date_from_its_own_files(spark, tmp_path, capsys):
    for day, item in (("2026-01-01", "7"), ("2026-01-02", "8")):
        landing(tmp_path / f"in/{day}", [a_deal(item)], DETAILS, STORES)
    common = ["bronze", "--root", f"{tmp_path}/lake", "--at", AT, *LAYOUT]
    dates = ["--snapshot", "2026-01-01", "--snapshot", "2026-01-02"]
    with pytest.raises(SystemExit):
        daily.main([*common, *dates, "--landing", f"{tmp_path}/in/2026-01-01"])
    daily.main([*common, *dates, "--landing", f"{tmp_path}/in/{{day}}"])
    done = json.loads(capsys.readouterr().out.splitlines()[-1])
    assert done == {day: {"deals": 1, "records": 1} for day in ("2026-01-01", "2026-01-02")}
    found = tables.read_table(spark, f"{tmp_path}/lake/bronze/records", schemas.BRONZE_RECORDS)
    got = sorted((str(r.snapshot_date), r.item_id) for r in found.collect())
    assert got == [("2026-01-01", "7"), ("2026-01-02", "8")]


# --- bad records, late files, buckets ------------------------------------------------------


def days_of(spark, root, name, schema):
    return tables.read_table(spark, f"{root}/{name}", schema)


def test_bad_records_do_not_stop_the_day_and_are_counted(spark, tmp_path):
    lines = "\n".join([*map(json.dumps, DEALS), '{"steamAppID": "7"', "5"])
    where = tmp_path / "in"
    write(where / "deals/p.json", lines)
    write(where / "stores/s.json", "\n".join([*map(json.dumps, STORES), "{"]))
    write(where / "details/d.json", "\n".join([*map(json.dumps, DETAILS), '{"10": ']))
    root = f"{tmp_path}/lake"
    run = lambda **options: daily.run_bronze(spark, str(where), root, "2026-01-01", Run("r", AT), **options)
    assert run(bad_limit=4) == {"deals": 10, "records": 3, "unreadable": 4}
    aside = days_of(spark, root, "bronze/quarantine", schemas.QUARANTINE)
    assert sorted((r.source, r.text) for r in aside.collect()) == [
        ("deals", "5"), ("deals", '{"steamAppID": "7"'), ("details", '{"10": '), ("stores", "{"),
    ]
    assert all(r.file and r.run_id == "r" for r in aside.collect())
    (row,) = days_of(spark, root, "bronze/manifest", schemas.BRONZE_MANIFEST).collect()
    parts = (row.n_unreadable, row.n_missing_key, row.n_duplicate, row.n_lookup_failed, row.n_records)
    assert parts == (2, 2, 1, 2, 3) and sum(parts) == row.n_offers_received == 10
    before = rows(days_of(spark, root, "bronze/records", schemas.BRONZE_RECORDS))
    with pytest.raises(lake.Refused, match="4 records cannot be read, 3 may"):
        run(bad_limit=3)
    assert rows(days_of(spark, root, "bronze/records", schemas.BRONZE_RECORDS)) == before


def test_a_late_file_is_neither_skipped_nor_taken_twice(spark, tmp_path):
    where = landing(tmp_path / "in", DEALS, DETAILS, STORES)
    root = f"{tmp_path}/lake"
    run = lambda n: daily.run_bronze(
        spark, where, root, "2026-01-01", Run(f"r{n}", AT), lines=False, only_new=True
    )
    assert run(1) == {"deals": 8, "records": 3}
    assert run(2) == {"deals": 0, "records": 0}
    write(tmp_path / "in/deals/p0.json", [a_deal("7", sale="2.00"), a_deal("5")])
    assert run(3) == {"deals": 10, "records": 3}
    found = days_of(spark, root, "bronze/records", schemas.BRONZE_RECORDS)
    # the late file comes first by name: its deal is the first of the item
    assert {(r.item_id, r.sale_price) for r in found.collect()} == {("7", "2.00"), ("8", "5.00"), ("9", "5.00")}
    taken = days_of(spark, root, "bronze/ledger", schemas.LEDGER)
    assert sorted(r.path.rsplit("/", 1)[1] for r in taken.collect()) == ["d.json", "p0.json", "p1.json", "s.json"]
    assert {r.run_id for r in taken.collect()} == {"r3"}
    assert run(4) == {"deals": 0, "records": 0}
    (tmp_path / "in/deals/p0.json").unlink()
    assert run(5) == {"deals": 8, "records": 3}


def test_bucketed_silver_gives_the_same_gold(spark, lake_root, conf):
    _, root, _ = lake_root
    before = gold_rows(spark, root)
    other = f"{root}-b"
    daily.run_bronze(spark, root.removesuffix("/lake") + "/in", other, "2026-01-01", Run("r", AT, sources=("a",)), lines=False)
    assert daily.run_silver(spark, other, ["2026-01-01"], AT, buckets=3) == {"items": 2, "tags": 4, "makers": 4}
    daily.run_gold(spark, other, ["2026-01-01"])
    assert gold_rows(spark, other) == before
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    names = [f"{other}/silver/items", f"{other}/silver/makers"]
    ((items, makers),) = buckets.together(spark, names, schemas=[schemas.SILVER_ITEMS, schemas.SILVER_MAKERS])
    joined = gold.join_makers(items, makers)
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    ranked = gold.rank_makers(items, makers, unique_items=True, unique_makers=True)
    kept = days_of(spark, other, "gold/rank_makers", schemas.GOLD_TABLES["rank_makers"])
    assert rows(ranked.select(*kept.columns)) == rows(kept)


def test_undated_documents_are_set_aside(spark, tmp_path):
    good, bad = envelope({"steam_app_id": "7", "nome": "Doom"}), envelope({"steam_app_id": "8"})
    bad["metadata"]["data_ingestao"] = None
    write(tmp_path / "in/1.json", good)
    write(tmp_path / "in/2.json", bad)
    root = f"{tmp_path}/lake"
    assert daily.import_envelopes(spark, f"{tmp_path}/in", root, Run("r", AT), keep_bad=True).rows == 1
    aside = days_of(spark, root, "bronze/quarantine_envelopes", schemas.QUARANTINE)
    assert [(r.source, str(r.snapshot_date)) for r in aside.collect()] == [("envelopes", AT[:10])]
    with pytest.raises(Exception, match="envelope without a date"):
        daily.import_envelopes(spark, f"{tmp_path}/in", root, Run("r", AT))


def test_price_history_is_clustered_and_its_key_is_checked(spark, lake_root):
    _, root, _ = lake_root
    found = clusters.lookup(spark, f"{root}/gold/price_history", ["8"], schema=schemas.GOLD_TABLES["price_history"])
    assert [(r.item_id, r.name) for r in found.collect()] == [("8", "Hades")]
    items = tables.read_table(spark, f"{root}/silver/items", schemas.SILVER_ITEMS)
    lake.replace_snapshots(items.unionByName(items), f"{root}/silver/items")
    before = gold_rows(spark, root)["price_history"]
    with pytest.raises(lake.Refused, match="unique"):
        daily.run_gold(spark, root, ["2026-01-01"])
    assert gold_rows(spark, root)["price_history"] == before


def test_pages_arrive_by_their_numbers(spark, tmp_path):
    where = landing(tmp_path / "in", [a_deal("5")], DETAILS, STORES)
    write(tmp_path / "in/deals/page10.json", [a_deal("7", sale="10.00")])
    write(tmp_path / "in/deals/page9.json", [a_deal("7", sale="9.00")])
    write(tmp_path / "in/deals/page009b.json", [a_deal("8", sale="9.50")])
    root = f"{tmp_path}/lake"
    daily.run_bronze(spark, where, root, "2026-01-01", Run("r", AT), lines=False)
    found = days_of(spark, root, "bronze/records", schemas.BRONZE_RECORDS)
    assert {(r.item_id, r.sale_price) for r in found.collect()} == {("7", "9.00"), ("8", "9.50")}


def test_natural_order(spark):
    names = ["a10", "a9", "a9b", "a010", "b1", "a", "a1.10", "a1.9", "x" + "1" * 30, "x2"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    order = [r.name for r in df.orderBy(natural_order(F.col("name")), "name").collect()]
    assert order == ["a", "a1.9", "a1.10", "a9", "a9b", "a010", "a10", "b1", "x2", "x" + "1" * 30]
