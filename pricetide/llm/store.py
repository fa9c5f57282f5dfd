"""Intermediate tables and files in the folder that all executors share."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from pricetide.session import fresh_path, shared_folder

__all__ = ["fresh_path", "open_folder", "shared_folder", "ship", "stored"]
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the Python workers, once for each application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parents[2]
        folder = tempfile.mkdtemp(prefix="pricetide-")
        context.addPyFile(shutil.make_archive(f"{folder}/pricetide", "zip", root, "pricetide"))
        _shipped.add(context.applicationId)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written as Parquet and read again: cuts lineage, survives lost executors."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder, for code inside tasks."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)
