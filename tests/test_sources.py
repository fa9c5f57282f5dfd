import json

import pytest
from helpers import rows
from pyspark.sql import functions as F

from pricetide.sources import landed, ledger

DEALS = [
    {"steamAppID": "7", "storeID": "1", "salePrice": "9.99", "normalPrice": "19.99",
     "savings": "50.025013", "steamRatingText": "Mixed", "steamRatingPercent": "80"},
    {"steamAppID": None, "storeID": "2", "salePrice": "1"},
    {"storeID": "3", "extra": {"ignored": True}},
]


def write(path, value):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(value if isinstance(value, str) else json.dumps(value), encoding="utf-8")


def test_deals_arrive_in_file_and_array_order(spark, tmp_path):
    write(tmp_path / "p2.json", DEALS[:1])
    write(tmp_path / "p1.json", DEALS)
    write(tmp_path / "p3.json", [])
    deals = landed.read_deals(spark, str(tmp_path), lines=False).orderBy("ord1", "ord2").collect()
    assert [(r.ord1[-7:], r.item_id) for r in deals] == [
        ("p1.json", "7"), ("p1.json", None), ("p1.json", None), ("p2.json", "7"),
    ]
    assert (deals[0].sale_price, deals[0].discount, deals[2].store_id) == ("9.99", "50.025013", "3")


@pytest.mark.parametrize("text", ['[{"steamAppID": "1"}, {"steamAppID": "2"}', '[{"steamAppID": "1"}, 5]'])
def test_a_damaged_file_stops_the_run(spark, tmp_path, text):
    write(tmp_path / "good.json", DEALS)
    write(tmp_path / "bad.json", text)
    with pytest.raises(Exception, match="(?i)malformed|JSON"):
        landed.read_deals(spark, str(tmp_path), lines=False).collect()


def test_the_last_envelope_by_time_wins_and_dates_are_required(spark, tmp_path):
    late, early = envelope({"steam_app_id": "7", "nome": "late"}), envelope({"steam_app_id": "7", "nome": "early"})
    late["metadata"] |= {"timestamp_ingestao": "2026-01-01T09:00:00", "execution_id": "a"}
    early["metadata"] |= {"timestamp_ingestao": "2026-01-01T06:00:00", "execution_id": "z"}
    write(tmp_path / "in/1.json", late)
    write(tmp_path / "in/2.json", early)
    got = landed.envelope_records(landed.read_envelopes(spark, f"{tmp_path}/in"))
    assert [r.name for r in got.orderBy("ord1", "ord2").collect()] == ["early", "late"]
    early["metadata"]["data_ingestao"] = "soon"
    write(tmp_path / "bad/1.json", early)
    with pytest.raises(Exception, match="envelope without a date: soon"):
        landed.envelope_records(landed.read_envelopes(spark, f"{tmp_path}/bad")).collect()


def test_deal_lines_keep_their_order_over_splits(spark, conf, tmp_path):
    conf("spark.sql.files.maxPartitionBytes", "4096")
    many = [{"steamAppID": str(n), "storeID": "1"} for n in range(2000)]
    write(tmp_path / "a.json", "\n".join(map(json.dumps, many)))
    write(tmp_path / "b.json", json.dumps(DEALS[0]))
    deals = landed.read_deals(spark, str(tmp_path), lines=True)
    assert deals.rdd.getNumPartitions() > 1
    got = [r.item_id for r in deals.orderBy("ord1", "ord2").collect()]
    assert got == [str(n) for n in range(2000)] + ["7"]


def test_pretty_printed_details_with_two_ids(spark, tmp_path):
    body = {
        "7": {"success": True, "data": {"name": "Doom", "price_overview": {
            "currency": "USD", "initial": 1999, "final": 999, "discount_percent": 50},
            "genres": [{"id": "1", "description": "Action"}, {"id": 2, "description": None}],
            "developers": ["id"]}},
        "8": {"success": False},
    }
    write(tmp_path / "d.json", json.dumps(body, indent=2))
    got = landed.read_details(spark, str(tmp_path), lines=False).orderBy("item_id").collect()
    assert [(r.item_id, r.success, r.name) for r in got] == [("7", True, "Doom"), ("8", False, None)]
    assert [(t.id, t.description) for t in got[0].tags] == [("1", "Action"), ("2", None)]
    assert got[0].price.final == 999 and got[1].price is None


def envelope(*records):
    return {
        "metadata": {"data_ingestao": "2026-01-01", "execution_id": "e1",
                     "fontes": ["a"], "total_registros": len(records)},
        "dados": list(records),
    }


def test_multi_line_envelope_with_all_prices_null(spark, tmp_path):
    record = {"steam_app_id": "7", "nome": "Doom", "preco_steam": None, "generos": None,
              "desenvolvedores": [], "preco_oferta": "1.5", "loja": None}
    write(tmp_path / "e.json", json.dumps(envelope(record, record), indent=4))
    envelopes = landed.read_envelopes(spark, str(tmp_path), multi_line=True)
    assert envelopes.first().metadata.total_registros == 2
    got = landed.envelope_records(envelopes)
    assert rows(got.select("item_id", "name", "ord2", "price.final", "sale_price")) == [
        ("7", "Doom", 0, None, "1.5"), ("7", "Doom", 1, None, "1.5"),
    ]
    assert str(got.first().snapshot_date) == "2026-01-01"


def test_empty_envelope_gives_no_records(spark, tmp_path):
    write(tmp_path / "e.json", envelope())
    assert landed.envelope_records(landed.read_envelopes(spark, str(tmp_path))).count() == 0


def test_store_ids_are_text(spark, tmp_path):
    write(tmp_path / "s.json", [{"storeID": 1, "storeName": "One"}])
    assert landed.read_stores(spark, str(tmp_path)).first().store_id == "1"


# --- records that cannot be read --------------------------------------------------------


def test_bad_lines_are_kept_with_their_text(spark, tmp_path):
    lines = [json.dumps(DEALS[0]), '{"steamAppID": "8"', "5", "", '"x"', json.dumps(DEALS[1]), '[{"steamAppID": "9"}]']
    write(tmp_path / "a.json", "\n".join(lines))
    found = landed.read_deals(spark, str(tmp_path), keep_bad=True).cache()
    assert [r.item_id for r in landed.readable(found).orderBy("ord1", "ord2").collect()] == ["7", None, "9"]
    bad = landed.unreadable(found, "deals").collect()
    assert sorted(r.text for r in bad) == ['"x"', "5", '{"steamAppID": "8"']
    assert all(r.file.endswith("a.json") and r.source == "deals" for r in bad)
    assert "corrupt" not in landed.read_deals(spark, str(tmp_path)).columns


def test_a_damaged_array_is_set_aside_whole(spark, tmp_path):
    write(tmp_path / "good.json", DEALS)
    write(tmp_path / "cut.json", '[{"steamAppID": "1"}, {"steamAppID": "2"}')
    write(tmp_path / "odd.json", '[{"steamAppID": "3"}, 5]')
    found = landed.read_deals(spark, str(tmp_path), lines=False, keep_bad=True).cache()
    assert landed.readable(found).count() == len(DEALS)
    assert sorted(r.file[-8:] for r in landed.unreadable(found, "deals").collect()) == ["cut.json", "odd.json"]


def test_bad_detail_maps_are_kept_with_their_text(spark, tmp_path):
    write(tmp_path / "d.json", "\n".join(['{"7": {"success": true}}', '{"8": ', "", "[]x", "{}", '{"9": 5}']))
    found = landed.read_details(spark, str(tmp_path), keep_bad=True).cache()
    assert sorted((r.item_id, r.success) for r in landed.readable(found).collect()) == [("7", True)]
    assert sorted(r.text for r in landed.unreadable(found, "details").collect()) == ["[]x", '{"8": ', '{"9": 5}']
    assert [r.item_id for r in landed.read_details(spark, str(tmp_path)).collect()] == ["7"]


def test_undated_envelopes_are_set_aside(spark, tmp_path):
    good, bad = envelope({"steam_app_id": "7"}), envelope({"steam_app_id": "8"})
    bad["metadata"]["data_ingestao"] = "soon"
    write(tmp_path / "in/1.json", good)
    write(tmp_path / "in/2.json", bad)
    envelopes = landed.read_envelopes(spark, f"{tmp_path}/in")
    assert [r.item_id for r in landed.envelope_records(envelopes, keep_bad=True).collect()] == ["7"]
    (row,) = landed.undated_envelopes(envelopes).collect()
    assert row.file.endswith("2.json") and json.loads(row.text)["dados"][0]["steam_app_id"] == "8"


# --- the ledger ---------------------------------------------------------------------------


def test_pending_files_are_new_late_or_rewritten_ones(spark, tmp_path):
    write(tmp_path / "deals/a.json", "1")
    write(tmp_path / "deals/day=1/b [x]*.json", "2")
    folders = {"deals": f"{tmp_path}/deals"}
    known = spark.createDataFrame(ledger.landed_files(spark, folders).collect(), ledger.FILES)
    assert known.count() == 2 and ledger.pending(ledger.landed_files(spark, folders), known).count() == 0
    write(tmp_path / "deals/c.json", "3")
    write(tmp_path / "deals/a.json", "11")
    found = ledger.landed_files(spark, folders)
    new = ledger.pending(found, known).collect()
    assert sorted(r.path[-6:] for r in new) == ["a.json", "c.json"]
    assert [r.size for r in ledger.gone(found, known).collect()] == [1]
    # names with pattern characters are read as they are
    text = spark.read.text(list(ledger.paths(found.collect(), "deals")))
    assert sorted(r.value for r in text.collect()) == ["11", "2", "3"]
    assert ledger.paths(new, "stores") == []


def test_nothing_is_entered_before_the_first_run(spark, tmp_path):
    found = ledger.entered(spark, f"{tmp_path}/ledger", "2026-01-01")
    assert found.count() == 0 and found.select(F.col("path"), F.col("modified")).columns == ["path", "modified"]
