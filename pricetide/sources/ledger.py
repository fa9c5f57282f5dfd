"""Which landed files a run has taken in: a table of path, size and modification time.

A run lists the landed files once, reads exactly those, and enters them after all it
made of them is published. A file that arrives meanwhile, or later, or that was written anew
under the same name, is not in the table and is pending for the next run.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetide import manifest
from pricetide.schemas import LEDGER
from pricetide.sources.tables import read_snapshot

FILE = ("path", "size", "modified")
FILES = "source string, path string, size long, modified timestamp"
_GLOB = re.compile(r"([\[\]{}*?\\])")


def landed_files(spark: SparkSession, folders: dict[str, str]) -> DataFrame:
    """(source, path, size, modified) of all files below the folder of each source; contents are not read."""
    frames = []
    for source, folder in folders.items():
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
        frames.append(
            files.select(
                F.lit(source).alias("source"),
                "path",
                F.col("length").alias("size"),
                F.col("modificationTime").alias("modified"),
            )
        )
    found = frames[0]
    for other in frames[1:]:
        found = found.unionByName(other)
    return found


def entered(spark: SparkSession, root: str, snapshot: str) -> DataFrame:
    """The files that earlier runs entered for a snapshot; none if there is no table yet."""
    if manifest.current(spark, root) is None:
        return spark.createDataFrame([], LEDGER)
    return read_snapshot(spark, root, snapshot, LEDGER)


def pending(files: DataFrame, known: DataFrame) -> DataFrame:
    """Files that are not in the table, or not in this state."""
    return files.join(known.select("source", *FILE), ["source", *FILE], "left_anti")


def gone(files: DataFrame, known: DataFrame) -> DataFrame:
    """Files that the table has and the folder no longer has in this state."""
    return known.select("source", *FILE).join(files, ["source", *FILE], "left_anti")


def paths(files: Iterable, source: str) -> Sequence[str]:
    """Paths of one source, of collected rows, for a reader that takes patterns."""
    return sorted(_GLOB.sub(r"\\\1", r.path) for r in files if r.source == source)

