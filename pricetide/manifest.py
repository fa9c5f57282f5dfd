"""Which files make up a table: one small file per version, published by one rename.

Every write of a table goes to a folder of its own, ``data/run=...``, which no reader
looks at. A version is a JSON file ``_versions/<number>.json`` that names, for each
snapshot, the folder that holds it. It is written beside and renamed to the next free number;
that rename is the only step that readers see, and it fails if somebody else took the
number, in which case the change is applied anew to what they published. Old versions
stay readable until ``vacuum``.

The rename must be atomic and refuse an existing target, as on HDFS and POSIX file systems; on a
bare object store a table needs a single writer.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

VERSIONS, DATA = "_versions", "data"
#: The part of a table that has no snapshots.
WHOLE = ""
#: How often a publication may lose the race for a number.
ATTEMPTS = 50


@dataclass(frozen=True)
class Manifest:
    """One version: the folder of each snapshot below the root, and how to read them."""

    version: int = 0
    schema: str | None = None
    fmt: str = "parquet"
    parts: dict[str, str] = field(default_factory=dict)
    layout: dict[str, Any] = field(default_factory=dict)

    def struct(self) -> StructType | None:
        return self.schema and StructType.fromJson(json.loads(self.schema))


class Files:
    """The file system of a path, through the session's Hadoop configuration."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.gateway = spark.sparkContext._gateway
        self.fs = self.path(root).getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def names(self, folder: str) -> list[str]:
        """Names in a folder; none if it is not there."""
        path = self.path(folder)
        if not self.fs.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(path))

    def modified(self, name: str) -> float:
        return self.fs.getFileStatus(self.path(name)).getModificationTime() / 1000

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self.fs.create(self.path(name), False)
        stream.write(bytearray(text.encode()))
        stream.close()

    def rename(self, old: str, new: str) -> bool:
        """Rename unless ``new`` is there; whether it was done."""
        options = self.gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        source, target = self.path(old), self.path(new)
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        try:
            context.rename(self.fs.makeQualified(source), self.fs.makeQualified(target), options)
        except Exception:
            if self.fs.exists(target):
                return False
            raise
        return True

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


def numbers(files: Files, root: str) -> list[int]:
    names = files.names(f"{root}/{VERSIONS}")
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())


def current(spark: SparkSession, root: str, version: int | None = None) -> Manifest | None:
    """The newest version of a table, or a given one; None if it has none.

    Snapshot folders right below a root without versions are taken over as they are.
    """
    files = Files(spark, root)
    if version is None:
        found = numbers(files, root)
        if not found:
            return None
        version = found[-1]
    return Manifest(**json.loads(files.read(f"{root}/{VERSIONS}/{version:09d}.json")))


def _taken_over(files: Files, root: str, key: str) -> Manifest:
    plain = [n for n in files.names(root) if n.startswith(f"{key}=")]
    return Manifest(parts={n.removeprefix(f"{key}="): n for n in plain})


def new_folder() -> str:
    """A folder for one write, relative to the root."""
    return f"{DATA}/run=w{uuid.uuid4().hex}"


def publish(spark: SparkSession, root: str, change: Callable[[Manifest], Manifest], key: str) -> Manifest:
    """Make ``change(newest version)`` the newest version."""
    files = Files(spark, root)
    for _ in range(ATTEMPTS):
        now = current(spark, root) or _taken_over(files, root, key)
        after = replace(change(now), version=now.version + 1)
        staged = f"{root}/{VERSIONS}/.{uuid.uuid4().hex}"
        files.write(staged, json.dumps(after.__dict__))
        if files.rename(staged, f"{root}/{VERSIONS}/{after.version:09d}.json"):
            return after
        files.delete(staged)
    raise RuntimeError(f"{root}: other writers published {ATTEMPTS} times first")


def vacuum(spark: SparkSession, root: str, keep: int = 2, older_than_s: float = 86_400) -> list[str]:
    """Remove versions but the newest ``keep``, and folders that none of these names.

    Folders younger than ``older_than_s`` stay, as a writer may still fill them.
    """
    files = Files(spark, root)
    found = numbers(files, root)
    kept, old = found[-keep:], found[:-keep]
    used = {d.split("/")[1] for v in kept for d in current(spark, root, v).parts.values() if d.startswith(DATA)}
    plain = {d for v in kept for d in current(spark, root, v).parts.values() if not d.startswith(DATA)}
    before = {d for v in old for d in current(spark, root, v).parts.values() if not d.startswith(DATA)}
    limit = time.time() - older_than_s
    gone = [
        f"{DATA}/{n}"
        for n in files.names(f"{root}/{DATA}")
        if n not in used and files.modified(f"{root}/{DATA}/{n}") <= limit
    ]
    gone += sorted(before - plain)
    # versions first: a reader finds a version with all its folders, or no such version
    for v in old:
        files.delete(f"{root}/{VERSIONS}/{v:09d}.json")
    for name in gone:
        files.delete(f"{root}/{name}")
    return gone
