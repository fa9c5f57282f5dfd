"""Readers of snapshot tables, partitioned by ``snapshot_date``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from pricetide import manifest
from pricetide.manifest import Manifest

PARTITION = "snapshot_date"


def with_date(schema: StructType, key: str = PARTITION) -> StructType:
    """``schema`` with the partition key last and typed DATE."""
    fields = [f for f in schema.fields if f.name != key]
    return StructType([*fields, StructField(key, DateType())])


def read_table(
    spark: SparkSession,
    root: str,
    schema: StructType | None = None,
    fmt: str = "parquet",
    version: int | None = None,
) -> DataFrame:
    """All snapshots of the table at ``root``, as its newest or a given version names them.

    A root without versions is read as it stands; the key comes from the directory names.
    """
    found = manifest.current(spark, root, version)
    if found is not None:
        return read_parts(spark, root, found, schema)
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(with_date(schema))
    return reader.load(root)


def read_parts(
    spark: SparkSession,
    root: str,
    found: Manifest,
    schema: StructType | None = None,
    dates: Sequence[str] | None = None,
) -> DataFrame:
    """What a version names, whole or of some dates; other folders are not even listed."""
    if manifest.WHOLE in found.parts:
        shown = schema or found.struct()
        return spark.read.format(found.fmt).schema(shown).load(f"{root}/{found.parts[manifest.WHOLE]}")
    shown = with_date(schema) if schema is not None else found.struct()
    if found.layout:
        return _dated_parts(spark, root, found, shown, dates)
    parts = [p for d, p in found.parts.items() if dates is None or d in dates]
    frames = []
    for base in (f"{root}/{manifest.DATA}", root):  # written by versions, or taken over
        own = [f"{root}/{p}" for p in parts if p.startswith(f"{manifest.DATA}/") == (base != root)]
        if own and shown is None:
            frames.append(spark.read.format(found.fmt).option("basePath", base).load(own).drop("run"))
        elif own:
            reader = spark.read.format(found.fmt).schema(shown).option("basePath", base)
            frames.append(reader.load(own).select(*shown.names))
    if not frames:
        return spark.createDataFrame([], shown or StructType([StructField(PARTITION, DateType())]))
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1], allowMissingColumns=True)


def _dated_parts(
    spark: SparkSession, root: str, found: Manifest, shown: StructType, dates: Sequence[str] | None
) -> DataFrame:
    """Snapshots that share folders, where the date is a column: a filter for each folder."""
    folders: dict[str, list[str]] = {}
    for d, p in found.parts.items():
        if dates is None or d in dates:
            folders.setdefault(p, []).append(d)
    if not folders:
        return spark.createDataFrame([], shown)
    reader = spark.read.schema(shown).option("basePath", f"{root}/{manifest.DATA}")
    rows = reader.parquet(*[f"{root}/{p}" for p in folders])
    wanted = F.lit(False)
    for folder, own in folders.items():
        run = folder.split("run=")[1]
        wanted |= (F.col("run") == run) & F.col(PARTITION).isin(*[F.lit(d).cast("date") for d in own])
    return rows.filter(wanted).select(*shown.names)


def read_snapshot(
    spark: SparkSession,
    root: str,
    snapshot: str | Sequence[str],
    schema: StructType | None = None,
    fmt: str = "parquet",
    version: int | None = None,
) -> DataFrame:
    """Given snapshots only; the version, or else the filter, prunes to their directories."""
    dates = [snapshot] if isinstance(snapshot, str) else [str(d) for d in snapshot]
    wanted = [F.lit(d).cast("date") for d in dates]
    found = manifest.current(spark, root, version)
    rows = read_table(spark, root, schema, fmt) if found is None else read_parts(spark, root, found, schema, dates)
    return rows.filter(F.col(PARTITION).isin(*wanted))
