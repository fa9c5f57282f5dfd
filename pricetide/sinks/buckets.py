"""Tables dealt into buckets by item, so that their joins move no rows.

A bucketed table holds the rows of one (snapshot, item) in the bucket that the hash of
these keys names, sorted by them. Two tables with the same buckets are joined bucket by
bucket, without an exchange. Versions name the folder of each snapshot, as for other
tables; snapshots written together share a folder, where the date is a column and its
sorted row groups are skipped by their bounds.

The layout of files is known to Spark only through a catalog entry. It is made when a
folder is written or read and dropped at once; the files and plans that use them stay.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pricetide import manifest
from pricetide.operators.dedupe import ITEM_KEYS
from pricetide.sinks.lake import Check, Refused, Written, audit, show_parts
from pricetide.sources.tables import PARTITION, with_date


def write_buckets(
    df: DataFrame,
    root: str,
    snapshots: Iterable[str | date] = (),
    buckets: int = 64,
    keys: Sequence[str] = ITEM_KEYS,
    checks: Iterable[Check] = (),
) -> Written:
    """Replace snapshots of a bucketed table: written, audited and published like others.

    The one exchange of the write deals the rows, each bucket to one task and file.
    """
    folder = manifest.new_folder()
    seen = Observation()
    counted = df.observe(
        seen,
        F.count("*").alias("rows"),
        F.collect_set(F.col(PARTITION).cast("string")).alias("dates"),
        F.count_if(F.col(PARTITION).isNull()).alias("undated"),
    )
    rows = counted.repartition(buckets, *keys)  # else every task would write a file a bucket
    name = _entry()
    try:
        writer = rows.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
        writer.option("path", f"{root}/{folder}").saveAsTable(name)
    finally:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    found = seen.get
    if found["undated"]:
        raise Refused(f"{found['undated']} rows have no {PARTITION}")
    dates = sorted(found["dates"])
    spark, where = df.sparkSession, f"{root}/{folder}"
    layout = {"buckets": buckets, "keys": list(keys)}
    audit(spark.read.schema(df.schema).parquet(where), checks, where)
    replaced = {*map(str, snapshots), *dates}
    after = show_parts(spark, root, dict.fromkeys(dates, folder), replaced, df.schema, "parquet", PARTITION, layout)
    return Written(found["rows"], tuple(date.fromisoformat(d) for d in dates), after.version)


def _entry() -> str:
    return f"buckets_{uuid.uuid4().hex}"


def scan(spark: SparkSession, folder: str, schema: StructType, layout: dict) -> DataFrame:
    """One folder of a bucketed table, as a scan that knows its buckets."""
    name, keys = _entry(), ", ".join(f"`{k}`" for k in layout["keys"])
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {layout['buckets']} BUCKETS"
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {by} LOCATION '{folder}'")
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def together(
    spark: SparkSession,
    roots: Sequence[str],
    snapshots: Sequence[str] | None = None,
    schemas: Sequence[StructType | None] | None = None,
) -> Iterator[tuple[DataFrame, ...]]:
    """The tables at ``roots``, for each group of snapshots that share a folder in all of them.

    Rows of different snapshots never join, so the union of the joins of these groups
    is the join of the tables. Snapshots that a table lacks come in no group.
    """
    found = [manifest.current(spark, root) for root in roots]
    if any(m is None for m in found):
        return
    shared = set.intersection(*[set(m.parts) for m in found])
    groups: dict[tuple[str, ...], list[str]] = {}
    for d in sorted(shared if snapshots is None else shared & set(snapshots)):
        groups.setdefault(tuple(m.parts[d] for m in found), []).append(d)
    for folders, dates in groups.items():
        scans = []
        for i, (root, m, folder) in enumerate(zip(roots, found, folders, strict=True)):
            schema = with_date(schemas[i]) if schemas and schemas[i] is not None else m.struct()
            wanted = [F.lit(d).cast("date") for d in dates]
            scans.append(scan(spark, f"{root}/{folder}", schema, m.layout).filter(F.col(PARTITION).isin(*wanted)))
        yield tuple(scans)


def joined(
    spark: SparkSession,
    roots: Sequence[str],
    join: Callable[..., DataFrame],
    snapshots: Sequence[str] | None = None,
    schemas: Sequence[StructType | None] | None = None,
) -> DataFrame | None:
    """``join`` of the tables, group by group without an exchange; None if they share no snapshot."""
    parts = [join(*sides) for sides in together(spark, roots, snapshots, schemas)]
    return functools.reduce(DataFrame.unionByName, parts) if parts else None
