"""The daily run, layer by layer: landed files -> bronze -> silver -> gold -> serving.

Each step reads written tables, replaces the given snapshots of its outputs and
returns the rows it wrote. Steps can be repeated in any order for any date.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetide import schemas
from pricetide.functions.text import natural_order
from pricetide.operators import checks, conform, dedupe, enrich, gold, lineage, silver
from pricetide.sinks import jdbc, lake
from pricetide.sinks.buckets import write_buckets
from pricetide.sinks.clusters import write_clustered
from pricetide.sources import landed, ledger, tables


def run_bronze(
    spark: SparkSession,
    landing: str,
    root: str,
    snapshot: str,
    run: lineage.Run,
    stores: bool = True,
    lines: bool = True,
    detail_lines: bool = True,
    bad_limit: int | None = None,
    only_new: bool = False,
) -> dict[str, int]:
    """Landed deals, stores and details of one snapshot to raw deals and records.

    ``stores=False`` is for a run whose store list could not be fetched: the
    fixed dimension takes its place. ``lines`` says deals and stores are JSON
    lines, ``detail_lines`` that details are one map per line, not per file.

    Records that cannot be read are set aside in ``bronze/quarantine`` with their text and
    file, and counted by the audit; more than ``bad_limit`` of them refuse the day.
    The files taken in are entered in ``bronze/ledger`` at the end. With ``only_new`` a run
    that finds all landed files there, unchanged, does nothing; any other run makes the
    snapshot anew from all its files, so none is skipped or counted twice.
    """
    day = F.lit(snapshot).cast("date")
    names = ("deals", "details", "stores") if stores else ("deals", "details")
    folders = {name: f"{landing}/{name}" for name in names}
    listed = ledger.landed_files(spark, folders).collect()
    files = spark.createDataFrame(listed, ledger.FILES)
    if only_new:
        known = ledger.entered(spark, f"{root}/bronze/ledger", snapshot)
        if ledger.pending(files, known).isEmpty() and ledger.gone(files, known).isEmpty():
            return {"deals": 0, "records": 0}
    # files arrive in the order of the numbers in their names: page 2 before page 10
    numbered = lambda df: df.withColumn("ord1", natural_order(F.col("ord1")))
    listing = lambda name: ledger.paths(listed, name) or folders[name]

    landed_deals = landed.read_deals(spark, listing("deals"), lines, keep_bad=True)
    stamped = lineage.stamp_lineage(landed_deals.withColumn("snapshot_date", day), run, "bronze_raw")
    raw = lake.write_bronze(stamped, f"{root}/bronze/deals", [snapshot])
    # Parsed once: records, audit and quarantine read what was written.
    all_deals = tables.read_snapshot(
        spark, f"{root}/bronze/deals", snapshot, stamped.schema, "json"
    ).select(*landed_deals.columns, "snapshot_date")
    deals = numbered(landed.readable(all_deals))
    bad = landed.unreadable(all_deals, "deals")

    # Dimensions are written first: the joins then see plain scans of known size,
    # which Spark broadcasts if small and splits on skew if not.
    if stores:
        pairs = landed.read_stores(spark, listing("stores"), lines, keep_bad=True)
        landed_stores = f"{root}/bronze/landed_stores/{snapshot}"
        lake.replace_table(pairs, landed_stores)
        pairs = tables.read_table(spark, landed_stores)
        bad = bad.unionByName(landed.unreadable(pairs, "stores"))
        labelled = enrich.store_dimension(numbered(landed.readable(pairs)), ["ord1", "ord2"])
        lake.replace_table(labelled, f"{root}/bronze/stores/{snapshot}")
        labels = tables.read_table(spark, f"{root}/bronze/stores/{snapshot}")
    else:
        labels = enrich.default_stores(spark)
    landed_details = f"{root}/bronze/landed_details/{snapshot}"
    lake.replace_table(landed.read_details(spark, listing("details"), detail_lines, keep_bad=True), landed_details)
    parsed = tables.read_table(spark, landed_details)
    bad = bad.unionByName(landed.unreadable(parsed, "details"))
    last = dedupe.keep_last(
        numbered(landed.readable(parsed)).withColumn("snapshot_date", day), dedupe.ITEM_KEYS, dedupe.ARRIVAL
    ).drop(*dedupe.ARRIVAL, "snapshot_date")
    lake.replace_table(last, f"{root}/bronze/details/{snapshot}")
    details = tables.read_table(spark, f"{root}/bronze/details/{snapshot}").withColumn("snapshot_date", day)

    aside = lineage.stamp_lineage(bad.withColumn("snapshot_date", day), run, "bronze_raw")
    n_bad = lake.replace_snapshots(aside, f"{root}/bronze/quarantine", [snapshot]).rows
    if bad_limit is not None and n_bad > bad_limit:
        raise lake.Refused(f"{snapshot}: {n_bad} records cannot be read, {bad_limit} may")

    records = enrich.enriched_records(deals, details, labels, on=dedupe.ITEM_KEYS)
    accepted = lake.write_bronze(
        lineage.stamp_lineage(records.drop(*dedupe.ARRIVAL), run, "bronze_enriched"),
        f"{root}/bronze/records",
        [snapshot],
        fmt="parquet",
    )
    audit = enrich.rejection_audit(all_deals, details, on=dedupe.ITEM_KEYS)
    manifest = lineage.run_manifest(audit, run, "bronze_enriched", rejections=True)
    lake.replace_snapshots(manifest, f"{root}/bronze/manifest", [snapshot])
    taken = lineage.stamp_lineage(files.withColumn("snapshot_date", day), run, "bronze_raw")
    lake.replace_snapshots(taken, f"{root}/bronze/ledger", [snapshot])
    return {"deals": raw.rows, "records": accepted.rows} | ({"unreadable": n_bad} if n_bad else {})


def import_envelopes(
    spark: SparkSession,
    path: str,
    root: str,
    run: lineage.Run,
    multi_line: bool = True,
    keep_bad: bool = False,
) -> lake.Written:
    """Take over existing enriched documents: each date they name is replaced.

    A document without a date stops the run, or with ``keep_bad`` goes to
    ``bronze/quarantine_envelopes`` under the date of the run.
    """
    envelopes = landed.read_envelopes(spark, path, multi_line)
    if keep_bad:
        day = F.to_date(F.lit(run.ingested_at))
        aside = landed.undated_envelopes(envelopes).withColumn("snapshot_date", day)
        stamped = lineage.stamp_lineage(aside, run, "bronze_enriched")
        lake.replace_snapshots(stamped, f"{root}/bronze/quarantine_envelopes", [run.ingested_at[:10]])
    found = landed.envelope_records(envelopes, keep_bad)
    records = enrich.first_deals(found).drop(*dedupe.ARRIVAL)
    stamped = lineage.stamp_lineage(records, run, "bronze_enriched")
    return lake.write_bronze(stamped, f"{root}/bronze/records", fmt="parquet")


def run_silver(
    spark: SparkSession,
    root: str,
    snapshots: Sequence[str],
    processed_at: str,
    buckets: int | None = None,
) -> dict[str, int]:
    """Records to items and bridges. Records are unique, so nothing is shuffled
    but the rows of a date towards its files.

    With ``buckets`` the tables are dealt by item instead, which costs one exchange each
    and spares those of every join of items and bridges.
    """
    records = tables.read_snapshot(
        spark, f"{root}/bronze/records", snapshots, schemas.BRONZE_RECORDS
    )
    outputs = {
        "items": silver.silver_items(records, processed_at, unique_records=True),
        "tags": silver.tag_bridge(records, processed_at, unique_records=True),
        "makers": silver.maker_bridge(records, processed_at, unique_records=True),
    }
    if buckets:
        return {
            name: write_buckets(df, f"{root}/silver/{name}", snapshots, buckets).rows
            for name, df in outputs.items()
        }
    return {
        name: lake.replace_snapshots(df, f"{root}/silver/{name}", snapshots).rows
        for name, df in outputs.items()
    }


def run_gold(spark: SparkSession, root: str, snapshots: Sequence[str]) -> dict[str, int]:
    """Silver items to price history and offers, records to the two rankings.

    Rankings of the records explode the kept lists: one exchange, and no join of
    items and bridge.
    """

    def read(name: str, schema) -> DataFrame:
        return tables.read_snapshot(spark, f"{root}/silver/{name}", snapshots, schema)

    items = read("items", schemas.SILVER_ITEMS)
    records = tables.read_snapshot(
        spark, f"{root}/bronze/records", snapshots, schemas.BRONZE_RECORDS
    )
    outputs = {
        "offers": gold.offers(items, unique_items=True),
        "rank_makers": gold.rank_makers_of_records(records),
        "rank_tags": gold.rank_tags_of_records(records),
    }
    written = {
        name: lake.replace_snapshots(df, f"{root}/gold/{name}", snapshots).rows
        for name, df in outputs.items()
    }
    # one item is looked up over all dates: its rows are kept together, and are one a date
    history = write_clustered(
        gold.price_history(items, unique_items=True),
        f"{root}/gold/price_history",
        snapshots,
        checks=[checks.unique(*schemas.UNIQUE_KEYS["price_history"])],
    )
    return {"price_history": history.rows} | written


def run_load(
    spark: SparkSession,
    root: str,
    target: jdbc.Target,
    snapshots: Sequence[str] | None = None,
    names: dict[str, str] | None = None,
) -> dict[str, list[str]]:
    """Load the given snapshots of the Gold tables, by default each table's latest.

    ``names`` maps a Gold table to its name at the target. A value that does not
    fit its serving column, or a repeated key, stops the load before the target
    is touched.
    """
    loaded = {}
    for name, serving in schemas.SERVING_TABLES.items():
        table = tables.read_table(spark, f"{root}/gold/{name}", schemas.GOLD_TABLES[name])
        dates = snapshots
        if dates is None:
            newest = gold.latest_snapshot(table).first()[0]
            dates = [] if newest is None else [str(newest)]
        if dates:
            wanted = tables.read_snapshot(
                spark, f"{root}/gold/{name}", dates, schemas.GOLD_TABLES[name]
            )
            fitted = conform.require_fit(wanted, serving)
            if name in schemas.UNIQUE_KEYS:
                dedupe.require_unique(fitted, schemas.UNIQUE_KEYS[name])
            jdbc.load_snapshots(fitted, target, (names or {}).get(name, name), dates)
        loaded[name] = list(dates)
    return loaded


def main(arguments: Sequence[str] | None = None) -> None:
    """The steps from the command line, for spark-submit."""
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("step", choices=["bronze", "envelopes", "silver", "gold", "load"])
    parser.add_argument("--root", required=True)
    parser.add_argument(
        "--snapshot", action="append", help="repeatable; for load the latest of each table if absent"
    )
    parser.add_argument("--at", required=True, help="time of the run, yyyy-MM-dd HH:mm:ss")
    parser.add_argument(
        "--landing",
        help="folder with deals, stores and details; {day} in it stands for the snapshot, and must "
        "be there for several snapshots. Files arrive in the order of their names, numbers as numbers",
    )
    parser.add_argument("--run-id", default="")
    parser.add_argument("--default-stores", action="store_true")
    parser.add_argument("--arrays", action="store_true", help="deals and stores are JSON arrays")
    parser.add_argument(
        "--detail-files", action="store_true", help="details are one map per file, not per line"
    )
    parser.add_argument("--bad-limit", type=int, help="unreadable records that a bronze day may have")
    parser.add_argument("--only-new", action="store_true", help="skip days whose landed files are all taken in")
    parser.add_argument("--buckets", type=int, help="deal the silver tables into buckets by item")
    parser.add_argument("--url")
    parser.add_argument("--driver", default=jdbc.Target.driver)
    parser.add_argument("--property", action="append", default=[], help="name=value for JDBC")
    given = parser.parse_args(arguments)
    if given.step in ("bronze", "silver", "gold") and not given.snapshot:
        parser.error("name a --snapshot")
    if given.step in ("bronze", "envelopes") and not given.landing:
        parser.error("name a --landing")
    if given.step == "bronze" and len(given.snapshot) > 1 and "{day}" not in given.landing:
        parser.error("several snapshots need {day} in --landing: each has files of its own")
    spark = SparkSession.builder.appName(f"pricetide-{given.step}").getOrCreate()
    if given.step == "bronze":
        run = lineage.Run(given.run_id, given.at, sources=("deals", "details"))
        done = {
            day: run_bronze(
                spark,
                given.landing.replace("{day}", day),
                given.root,
                day,
                run,
                stores=not given.default_stores,
                lines=not given.arrays,
                detail_lines=not given.detail_files,
                bad_limit=given.bad_limit,
                only_new=given.only_new,
            )
            for day in given.snapshot
        }
    elif given.step == "envelopes":
        run = lineage.Run(given.run_id, given.at, sources=("envelopes",))
        done = {"records": import_envelopes(spark, given.landing, given.root, run).rows}
    elif given.step == "silver":
        done = run_silver(spark, given.root, given.snapshot, given.at, given.buckets)
    elif given.step == "gold":
        done = run_gold(spark, given.root, given.snapshot)
    else:
        properties = dict(pair.split("=", 1) for pair in given.property)
        target = jdbc.Target(given.url, given.driver, properties)
        done = run_load(spark, given.root, target, given.snapshot)
    print(json.dumps(done))


if __name__ == "__main__":
    main()
