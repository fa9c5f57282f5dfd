"""Writers of snapshot tables and files."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pricetide import manifest
from pricetide.manifest import Manifest
from pricetide.sources.tables import PARTITION


#: Rows that say what is wrong with a table; no rows if nothing is.
Check = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Written:
    """What a write put down, counted by the write itself, and the version that shows it."""

    rows: int
    snapshots: tuple[date, ...]
    version: int = 0


class Refused(ValueError):
    """A staged table did not pass its checks; what readers see is unchanged."""


def replace_snapshots(
    df: DataFrame,
    root: str,
    snapshots: Iterable[str | date] = (),
    fmt: str = "parquet",
    key: str = PARTITION,
    spread: bool | None = None,
    together: bool = False,
    checks: Iterable[Check] = (),
    before: Callable[[DataFrame, str], None] | None = None,
    **options,
) -> Written:
    """Replace whole snapshots of the table at ``root``; other dates stay.

    Every date in ``df`` is replaced. Dates named in ``snapshots`` that have no
    row in ``df`` are emptied. Write, audit, publish: the rows go to a folder no reader
    looks at, ``checks`` run on what was written there, and one rename then shows all
    dates at once. A write that fails, is refused or repeated leaves the table as it was;
    ``df`` may read the table itself. Rows without a date stop the write.

    ``spread`` sends the rows of one date together before writing: few files per
    date, and a date too large for one task is split by the adaptive rebalance.
    By default that shuffle is left out when exactly one snapshot is named,
    since then every task has one directory to write to, or when the rows of
    a date are said to be ``together`` in few tasks already. ``before`` may write more into
    the folder of the staged rows before they are published.
    """
    snapshots = [str(d) for d in snapshots]
    if spread is None:
        spread = len(snapshots) != 1 and not together
    rows = df.hint("rebalance", F.col(key)) if spread else df
    folder = manifest.new_folder()
    seen = Observation()
    metrics = [
        F.count("*").alias("rows"),
        F.collect_set(F.col(key).cast("string")).alias("dates"),
        F.count_if(F.col(key).isNull()).alias("undated"),
    ]
    rows.observe(seen, *metrics).write.format(fmt).options(**options).partitionBy(key).save(f"{root}/{folder}")
    found = seen.get
    if found["undated"]:
        raise Refused(f"{found['undated']} rows have no {key}")
    dates = sorted(found["dates"])
    schema = StructType([f for f in df.schema.fields if f.name != key] + [df.schema[key]])
    spark = df.sparkSession
    if dates:
        staged = spark.read.format(fmt).schema(schema).load(f"{root}/{folder}")
        audit(staged, checks, f"{root}/{folder}")
        if before is not None:
            before(staged, f"{root}/{folder}")
    after = show_parts(spark, root, {d: f"{folder}/{key}={d}" for d in dates}, {*snapshots, *dates}, schema, fmt, key)
    return Written(found["rows"], tuple(date.fromisoformat(d) for d in dates), after.version)


def audit(staged: DataFrame, checks: Iterable[Check], where: str) -> None:
    """Run the checks on staged rows; all that fail are named. The rows stay for a look until ``vacuum``."""
    problems = []
    for check in checks:
        found = check(staged).take(5)
        if found:
            problems.append(f"{getattr(check, '__name__', check)}: {[r.asDict() for r in found]}")
    if problems:
        raise Refused(f"{where} is not published: " + "; ".join(problems))


def show_parts(
    spark: SparkSession,
    root: str,
    parts: dict[str, str],
    replaced: set[str],
    schema: StructType,
    fmt: str,
    key: str,
    layout: dict | None = None,
) -> Manifest:
    """Show ``parts`` instead of the ``replaced`` ones, in one step."""

    def change(now: Manifest) -> Manifest:
        kept = {d: p for d, p in now.parts.items() if d not in replaced}
        shown = schema
        before = now.struct() if kept else None
        if before is not None:
            if now.fmt != fmt or now.layout != (layout or {}):
                raise Refused(f"{root} has other snapshots as {now.fmt} {now.layout}")
            for f in before.fields:
                if f.name not in schema.names:
                    shown = StructType([f, *shown.fields])
                elif schema[f.name].dataType != f.dataType:
                    raise Refused(f"{root}: {f.name} is {f.dataType.simpleString()} in other snapshots")
        return replace(now, schema=shown.json(), fmt=fmt, parts=kept | parts, layout=layout or {})

    return manifest.publish(spark, root, change, key)


def clear_snapshots(
    spark: SparkSession, root: str, snapshots: Iterable[str | date], key: str = PARTITION
) -> None:
    """Empty some dates, all in one step and without a job."""
    gone = {str(d) for d in snapshots}
    manifest.publish(
        spark, root, lambda now: replace(now, parts={d: p for d, p in now.parts.items() if d not in gone}), key
    )


def replace_snapshot(df: DataFrame, root: str, snapshot: str | date, **options) -> Written:
    """Make ``df`` the whole content of one date, also when it is empty."""
    stamped = df.withColumn(PARTITION, F.lit(str(snapshot)).cast("date"))
    return replace_snapshots(stamped, root, [snapshot], **options)


def write_bronze(
    df: DataFrame, root: str, snapshots: Iterable[str | date] = (), fmt: str = "json"
) -> Written:
    """Stamped rows by snapshot. As JSON a null field stays in the document, and files are gzipped:

    names and stamps repeat in every row. Such a file is read by one task; the write makes
    one for each of its tasks and dates.
    """
    options = {"ignoreNullFields": False, "compression": "gzip"} if fmt == "json" else {}
    return replace_snapshots(df, root, snapshots, fmt, **options)


def replace_table(df: DataFrame, root: str, checks: Iterable[Check] = ()) -> None:
    """Replace a table without snapshots, such as the store dimension, in one step."""
    folder = manifest.new_folder()
    df.write.parquet(f"{root}/{folder}")
    spark = df.sparkSession
    audit(spark.read.schema(df.schema).parquet(f"{root}/{folder}"), checks, f"{root}/{folder}")
    show_parts(spark, root, {manifest.WHOLE: folder}, {manifest.WHOLE}, df.schema, "parquet", PARTITION)


# quotes doubled as spreadsheets expect; spaces and tabs around a text are part of it
CSV_OPTIONS = {
    "header": True,
    "encoding": "UTF-8",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def export_csv(df: DataFrame, path: str) -> None:
    """Part files with a header; ``path`` must be new."""
    df.write.mode("errorifexists").options(**CSV_OPTIONS).csv(path)


def read_csv_export(
    spark: SparkSession, path: str, schema: StructType, multi_line: bool = False
) -> DataFrame:
    """Read an export back; ``multi_line`` if texts hold line breaks.

    CSV has no null: an empty text comes back as null.
    """
    reader = spark.read.schema(schema).options(**CSV_OPTIONS)
    return reader.option("multiLine", multi_line).csv(path)
