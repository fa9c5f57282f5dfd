"""Files clustered by item, so that the rows of one item are found without reading a table.

Within a snapshot rows are sorted by item over its files, and Parquet keeps bounds and a
Bloom filter of the items of each row group. What bounds each file is written beside the
files as a small table (zones). A lookup asks the zones which files may hold its items
and reads these; within a file, row groups are skipped by bounds and filters.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pricetide import manifest
from pricetide.sinks.lake import Check, Written, replace_snapshots
from pricetide.sources.tables import PARTITION, read_parts, read_table, with_date

#: Inside the folder of a write; a leading underscore hides it from scans of the folder.
ZONES = "_zones"


def write_clustered(
    df: DataFrame,
    root: str,
    snapshots: Iterable[str | date] = (),
    column: str = "item_id",
    files: int | None = None,
    row_group: int | None = None,
    expected: int = 1_000_000,
    checks: Iterable[Check] = (),
) -> Written:
    """Replace snapshots by files sorted by ``column``; published like any other write.

    One range exchange cuts the rows by date and item. ``files`` is how many pieces it
    makes of the whole write (by default as the session's settings say), ``row_group``
    the bytes of a row group, ``expected`` the distinct items a Bloom filter is made for.
    """
    keys = (PARTITION, column)
    dealt = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    options = {
        f"parquet.bloom.filter.enabled#{column}": "true",
        f"parquet.bloom.filter.expected.ndv#{column}": str(expected),
    }
    if row_group:
        options["parquet.block.size"] = str(row_group)
    return replace_snapshots(
        dealt.sortWithinPartitions(*keys),
        root,
        snapshots,
        spread=False,
        checks=checks,
        before=lambda staged, folder: _write_zones(staged, folder, column),
        **options,
    )


def _write_zones(staged: DataFrame, folder: str, column: str) -> None:
    """(snapshot, file, low, high, n_rows) of every file; nulls are outside of the bounds."""
    zones = staged.select(PARTITION, F.col("_metadata.file_path").alias("file"), F.col(column).alias("own"))
    bounds = [F.min("own").alias("low"), F.max("own").alias("high"), F.count("*").alias("n_rows")]
    zones.groupBy(PARTITION, "file").agg(*bounds).write.parquet(f"{folder}/{ZONES}")


def lookup(
    spark: SparkSession,
    root: str,
    values: Sequence[str],
    column: str = "item_id",
    schema: StructType | None = None,
    snapshots: Sequence[str] | None = None,
) -> DataFrame:
    """The rows of some items, over all or some snapshots.

    Parts that were written without zones are read whole and filtered.
    """
    found = manifest.current(spark, root)
    wanted = F.col(column).isin(*values)
    if found is None:
        rows = read_table(spark, root, schema)
        rows = rows if snapshots is None else rows.filter(F.col(PARTITION).cast("string").isin(*snapshots))
        return rows.filter(wanted)
    shown = with_date(schema) if schema is not None else found.struct()
    days = [d for d in found.parts if snapshots is None or d in snapshots]
    disk, plain, zoned = manifest.Files(spark, root), [], {}
    for d in days:
        run = "/".join(found.parts[d].split("/")[:2])
        if run not in zoned:
            zoned[run] = ZONES in disk.names(f"{root}/{run}")
        if not zoned[run]:
            plain.append(d)
    runs = [f"{root}/{run}/{ZONES}" for run, has in zoned.items() if has]
    kept = [d for d in days if d not in plain]
    files: list[str] = []
    if runs and values:
        inside = F.lit(False)
        for v in values:
            inside |= F.lit(v).between(F.col("low"), F.col("high"))
        named = {d: f"/{found.parts[d]}/" for d in kept}
        # file names of a few row groups for each date; never rows
        zones = spark.read.parquet(*runs).filter(inside & F.col(PARTITION).cast("string").isin(*kept))
        files = [r.file for r in zones.select("file", F.col(PARTITION).cast("string").alias("d")).collect() if named[r.d] in r.file]
    frames = []
    if files:
        reader = spark.read.schema(shown).option("basePath", f"{root}/{manifest.DATA}")
        frames.append(reader.parquet(*sorted(files)).select(*shown.names))
    if plain:
        frames.append(read_parts(spark, root, found, schema, plain))
    if not frames:
        return spark.createDataFrame([], shown)
    rows = frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1], allowMissingColumns=True)
    return rows.filter(wanted)
