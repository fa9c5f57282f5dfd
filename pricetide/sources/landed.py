"""Readers of landed API responses.

One file is one response (or one page of it). Arrival order is the file name
followed by the position inside the file, so it does not depend on how Spark
packs files into tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pricetide.schemas import (
    LANDED_DEAL,
    LANDED_DEAL_NAMES,
    LANDED_DETAIL_MAP,
    LANDED_ENVELOPE,
    LANDED_RECORD,
    LANDED_RECORD_NAMES,
    LANDED_STORE,
    LANDED_STORE_NAMES,
)


def _renamed(prefix: str, names: dict[str, str]) -> list[Column]:
    return [F.col(f"{prefix}.{landed}").alias(neutral) for landed, neutral in names.items()]


def _position() -> Column:
    """Where a row stands in its file: row numbers rise within a block wherever it is read."""
    return F.struct(
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


#: Text of a record that could not be read; null for all others.
CORRUPT = "corrupt"
Paths = str | Sequence[str]


def _records(
    spark: SparkSession, path: Paths, record: StructType, names: dict[str, str], lines: bool, keep_bad: bool
) -> DataFrame:
    # A truncated file or an element that is no object stops the run, unless bad records
    # are kept: they would be gone without a count otherwise.
    reader = spark.read.option("multiLine", not lines)
    if keep_bad:
        reader = reader.schema(StructType([*record.fields]).add(CORRUPT, "string"))
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    else:
        reader = reader.schema(record).option("mode", "FAILFAST")
    rows = reader.json(path if isinstance(path, str) else list(path))
    columns = [F.col(landed).alias(neutral) for landed, neutral in names.items()]
    kept = [F.col(CORRUPT)] if keep_bad else []
    return rows.select(
        F.col("_metadata.file_path").alias("ord1"), _position().alias("ord2"), *columns, *kept
    )


def read_deals(spark: SparkSession, path: Paths, lines: bool = True, keep_bad: bool = False) -> DataFrame:
    """Deals from JSON lines (splittable), or from JSON-array responses, a file at a time.

    With ``keep_bad`` a line, or an array file, that cannot be read is a row with its text in ``corrupt``.
    """
    return _records(spark, path, LANDED_DEAL, LANDED_DEAL_NAMES, lines, keep_bad)


def read_stores(spark: SparkSession, path: Paths, lines: bool = True, keep_bad: bool = False) -> DataFrame:
    """Raw store pairs; ``store_dimension`` keeps the last name of each id."""
    return _records(spark, path, LANDED_STORE, LANDED_STORE_NAMES, lines, keep_bad)


def explode_detail_map(df: DataFrame, text: str = "value", keep_bad: bool = False) -> DataFrame:
    """Rows of a ``{id: {success, data}}`` text column, one row per id.

    The other columns of ``df`` stay on each row. With ``keep_bad`` a text that is no such
    map, but not blank, is a row with the text in ``corrupt``.
    """
    kept = [c for c in df.columns if c != text]
    parsed = df.select(*kept, F.from_json(F.col(text), LANDED_DETAIL_MAP).alias("_map"), F.col(text).alias("_text"))
    explode = F.explode_outer if keep_bad else F.explode
    rows = parsed.select(*kept, "_map", "_text", explode("_map").alias("item_id", "detail"))
    unread = F.col("_map").isNull() & (F.trim("_text") != "")
    if keep_bad:  # an empty map and a blank text give no rows
        rows = rows.filter(F.col("item_id").isNotNull() | unread)
    return rows.select(
        *kept,
        "item_id",
        F.coalesce("detail.success", F.lit(False)).alias("success"),
        F.col("detail.data.name").alias("name"),
        F.col("detail.data.price_overview").alias("price"),
        F.col("detail.data.genres").alias("tags"),
        F.col("detail.data.developers").alias("makers"),
        *([F.when(unread, F.col("_text")).alias(CORRUPT)] if keep_bad else []),
    )


def read_details(spark: SparkSession, path: Paths, lines: bool = True, keep_bad: bool = False) -> DataFrame:
    """Item details from one map per line, or from one map per file."""
    paths = path if isinstance(path, str) else list(path)
    text = spark.read.text(paths, wholetext=not lines).select(
        F.col("_metadata.file_path").alias("ord1"), _position().alias("ord2"), "value"
    )
    return explode_detail_map(text, keep_bad=keep_bad)


def readable(df: DataFrame) -> DataFrame:
    """The records that could be read, without the text column."""
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def unreadable(df: DataFrame, source: str) -> DataFrame:
    """(source, file, text) of the records that could not, of a table that was written.

    Spark does not read that column alone from raw JSON.
    """
    return df.filter(F.col(CORRUPT).isNotNull()).select(
        F.lit(source).alias("source"), F.col("ord1").alias("file"), F.col(CORRUPT).alias("text")
    )


def read_envelopes(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """``metadata`` and ``dados`` documents: one per line, or one per file."""
    return spark.read.schema(LANDED_ENVELOPE).option("multiLine", multi_line).json(path)


def undated_envelopes(envelopes: DataFrame) -> DataFrame:
    """(source, file, text) of the documents without a valid date, to be set aside."""
    return envelopes.filter(F.col("metadata.data_ingestao").try_cast("date").isNull()).select(
        F.lit("envelopes").alias("source"),
        F.col("_metadata.file_path").alias("file"),
        F.to_json(F.struct("metadata", "dados")).alias("text"),
    )


def envelope_records(envelopes: DataFrame, keep_bad: bool = False) -> DataFrame:
    """Records of the envelopes under neutral names; an empty envelope gives none.

    Arrival is the time of ingestion, then the execution id, which is random. A
    document without a valid date belongs to no snapshot and stops the run, unless
    ``keep_bad``: then it gives no records, and ``undated_envelopes`` has it.
    """
    text = F.col("metadata.data_ingestao")
    day = text.try_cast("date")
    if keep_bad:
        envelopes = envelopes.filter(day.isNotNull())
    missing = F.raise_error(F.concat(F.lit("envelope without a date: "), F.coalesce(text, F.lit("null"))))
    arrival = F.struct(F.col("metadata.timestamp_ingestao").alias("at"), F.col("metadata.execution_id").alias("run"))
    rows = envelopes.select(
        F.when(day.isNull(), missing.cast("date")).otherwise(day).alias("snapshot_date"),
        arrival.alias("ord1"),
        F.posexplode("dados").alias("ord2", "r"),
    )
    return rows.select("snapshot_date", "ord1", "ord2", *_renamed("r", LANDED_RECORD_NAMES))


def to_landed_record(prefix: str = "") -> Column:
    """Neutral record columns packed under their landed names."""
    dotted = f"{prefix}." if prefix else ""
    return F.struct(
        *[
            F.col(f"{dotted}{neutral}").cast(LANDED_RECORD[landed].dataType).alias(landed)
            for landed, neutral in LANDED_RECORD_NAMES.items()
        ]
    )
