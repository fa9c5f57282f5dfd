"""Load of the serving tables over JDBC.

Spark commits a JDBC write task by task, so a retried task can leave rows twice
and a failed job can leave half a snapshot. The load therefore fills a staging
table first and then, in one transaction of the target, deletes the snapshots
and inserts the staged rows, telling a retried task's copies apart from equal rows
by a number that each row got before it was written. A failed load changes nothing
but its own staging table, whose name no other load has.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetide.sources.tables import PARTITION

_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?")


@dataclass(frozen=True)
class Target:
    """Where to load. ``properties`` holds user and password."""

    url: str
    driver: str = "org.postgresql.Driver"
    properties: dict[str, str] = field(default_factory=dict, repr=False)
    batch_rows: int = 10_000
    connections: int = 16


#: Column of the staging table that numbers its rows.
ROW = "load_row"


def drop_statement(table: str) -> str:
    return f"DROP TABLE {identifier(table)}"


def identifier(name: str) -> str:
    """Names cannot be bound as parameters, so only plain ones are let through."""
    if not _IDENTIFIER.fullmatch(name):
        raise ValueError(f"not a plain table or column name: {name!r}")
    return name


def delete_statement(table: str, key: str = PARTITION) -> str:
    return f"DELETE FROM {identifier(table)} WHERE {identifier(key)} = ?"


def insert_statement(table: str, staging: str, columns: Sequence[str]) -> str:
    names = ", ".join(identifier(c) for c in columns)
    return (
        f"INSERT INTO {identifier(table)} ({names}) "
        f"SELECT {names} FROM (SELECT DISTINCT {ROW}, {names} FROM {identifier(staging)}) AS staged"
    )


def append_rows(df: DataFrame, target: Target, table: str, mode: str = "append") -> None:
    """Write rows in batches over at most ``target.connections`` connections."""
    (
        df.write.format("jdbc")
        .options(
            url=target.url,
            driver=target.driver,
            dbtable=identifier(table),
            batchsize=target.batch_rows,
            numPartitions=target.connections,
            **target.properties,
        )
        .mode(mode)
        .save()
    )


@contextmanager
def transaction(spark: SparkSession, target: Target) -> Iterator:
    """A JDBC connection that commits at the end and rolls back on any error."""
    jvm = spark.sparkContext._jvm
    loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
    properties = jvm.java.util.Properties()
    for name, value in target.properties.items():
        properties.setProperty(name, value)
    connection = loader.loadClass(target.driver).newInstance().connect(target.url, properties)
    connection.setAutoCommit(False)
    try:
        yield connection
        connection.commit()
    except BaseException:
        connection.rollback()
        raise
    finally:
        connection.close()


def _delete(spark: SparkSession, connection, table: str, snapshots: Iterable, key: str) -> None:
    statement = connection.prepareStatement(delete_statement(table, key))
    to_date = spark.sparkContext._jvm.java.sql.Date.valueOf
    for snapshot in snapshots:
        statement.setDate(1, to_date(str(snapshot)))
        statement.executeUpdate()
    statement.close()


def load_snapshots(
    df: DataFrame,
    target: Target,
    table: str,
    snapshots: Sequence[str | date],
    key: str = PARTITION,
) -> None:
    """Replace ``snapshots`` of ``table`` by the rows of ``df``, all or nothing."""
    spark, staging = df.sparkSession, f"{table}_staging_{uuid.uuid4().hex[:12]}"
    # The number is stable if the rows come in the same order again, as those of a stored table do.
    append_rows(df.withColumn(ROW, F.monotonically_increasing_id()), target, staging, mode="overwrite")
    with transaction(spark, target) as connection:
        _delete(spark, connection, table, snapshots, key)
        statement = connection.createStatement()
        statement.executeUpdate(insert_statement(table, staging, df.columns))
        statement.executeUpdate(drop_statement(staging))
        statement.close()
