"""Near-duplicate vectors by p-stable hashing for the Euclidean distance.

Normalised vectors with a cosine of at least 0.9 are at most 0.447 apart. A hash is
a Gaussian projection, shifted and cut into steps of ``WIDTH``; ``hashes`` of them
make the bucket of a table, and there are as many tables as keep the chance to miss
a pair at the threshold under ``MISS``. More vectors get more hashes for a table, so
buckets of unrelated vectors stay small.

A pair is checked by its exact cosine in the first table that holds both, in place:
buckets are compared in blocks and give only the links per vector and a spanning
forest of the links found. Buckets over ``BLOCK`` members are dealt into groups, of
which every two meet in one block, so nothing is left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricetide.llm.components import components
from pricetide.llm.store import stored
from pricetide.llm.words import mix

WIDTH = 2.4
MISS = 1e-3
BLOCK = 1_024
LEAST_HASHES = 12


def meeting(distance: float, width: float = WIDTH) -> float:
    """The chance that two points at this distance get one value of a hash."""
    r = width / distance
    normal = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * normal - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def shape(rows: int, cosine: float) -> tuple[int, int]:
    """Hashes of a table and number of tables for so many vectors.

    A table has as many hashes as leave an unrelated (orthogonal) vector some four
    bucket mates.
    """
    apart = meeting(math.sqrt(2))
    hashes = max(LEAST_HASHES, math.ceil(math.log(max(rows, 1) / 4 + 1) / -math.log(apart)))
    near = meeting(math.sqrt(2 - 2 * cosine)) ** hashes
    return hashes, math.ceil(math.log(MISS) / math.log1p(-near))


class Tables:
    def __init__(self, size: int, hashes: int, tables: int, seed: int = 0) -> None:
        draw = np.random.Generator(np.random.PCG64(seed))
        self.hashes, self.tables = hashes, tables
        self.lines = draw.standard_normal((size, hashes * tables))
        self.shifts = draw.random(hashes * tables) * WIDTH

    def keys(self, unit: np.ndarray) -> np.ndarray:
        """(vectors, tables): the bucket in each table."""
        cells = np.floor((unit @ self.lines + self.shifts) / WIDTH).astype(np.int64).astype(np.uint64)
        cells = cells.reshape(len(unit), self.tables, self.hashes)
        h = np.broadcast_to(np.arange(self.tables, dtype=np.uint64), cells.shape[:2]).copy()
        for k in range(self.hashes):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + cells[:, :, k])
        return h.view(np.int64)


_known: dict[tuple, Tables] = {}


def tables_of(*shape_: int) -> Tables:
    if shape_ not in _known:
        _known.clear()
        _known[shape_] = Tables(*shape_)
    return _known[shape_]


def unit_of(data: bytes, size: int) -> np.ndarray:
    v = np.frombuffer(data, np.float64).reshape(-1, size)
    # the largest component first, so that no square leaves the range of doubles
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def vectors(df: DataFrame, name: str = "vec_id", values: str = "embedding") -> DataFrame:
    """(vec_id, data): doubles of every vector that can be linked; data is null for the others.

    Null, empty and zero vectors, and those with null or non-finite components, have no data.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = []
            for own in batch.column("own").to_pylist():
                v = None if not own or None in own else np.array(own, np.float64)
                good = v is not None and np.isfinite(v).all() and v.any()
                data.append(v.tobytes() if good else None)
            yield pa.RecordBatch.from_pydict({"vec_id": batch.column("vec_id"), "data": pa.array(data, pa.binary())})

    slim = df.select(F.col(name).cast("long").alias("vec_id"), F.col(values).cast("array<double>").alias("own"))
    return slim.mapInArrow(run, "vec_id long, data binary")


def _buckets(nodes: DataFrame, args: tuple[int, int, int, int]) -> DataFrame:
    """(key, node): the bucket of every vector in every table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = tables_of(*args)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                piece = batch.slice(at, 500)
                if not piece.num_rows:
                    continue
                keys = tables.keys(unit_of(b"".join(piece.column("data").to_pylist()), args[0]))
                ids = np.repeat(piece.column("node").to_numpy(zero_copy_only=False), keys.shape[1])
                number = np.tile(np.arange(keys.shape[1], dtype=np.int32), len(keys))
                yield pa.RecordBatch.from_pydict({"key": keys.ravel(), "number": number, "node": ids})

    return nodes.select("node", "data").mapInArrow(run, "key long, number int, node long")


def compare(
    unit: np.ndarray, keys: np.ndarray, weight: np.ndarray, number: int, split: int, cosine: float
) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Links of each vector found in this block, and a spanning forest of them.

    A link to a vector that stands for ``weight`` equal ones counts as often.
    """
    n, links = len(unit), np.zeros(len(unit), np.int64)
    parent = np.arange(n)
    forest: list[tuple[int, int]] = []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for at in range(0, n, 256):
        near = unit[at : at + 256] @ unit.T
        # within a rounding error of the threshold the sum is taken again, term by term
        i, j = np.nonzero(near >= cosine - 1e-9)
        ok = (i + at < split) & (j >= split) if split else i + at < j
        i, j = i[ok] + at, j[ok]
        for cut in range(0, len(i), 8192):
            a, b = i[cut : cut + 8192], j[cut : cut + 8192]
            own = (unit[a] * unit[b]).sum(1) >= cosine
            if number:
                own &= ~(keys[a, :number] == keys[b, :number]).any(1)
            a, b = a[own], b[own]
            np.add.at(links, a, weight[b])
            np.add.at(links, b, weight[a])
            for x, y in zip(a.tolist(), b.tolist(), strict=True):
                rx, ry = root(x), root(y)
                if rx != ry:
                    parent[rx] = ry
                    forest.append((x, y))
    return links, forest


def near_duplicates(
    df: DataFrame, cosine: float = 0.9, name: str = "vec_id", values: str = "embedding", seed: int = 0
) -> DataFrame:
    """Per row: vec_id, n_links (other rows linked directly), component_id, kept.

    Vectors of different lengths are never linked. Rows with equal vectors are one
    node that stands for them all. A row without an id counts as a link of others,
    but names no component.
    """
    from pricetide.llm.lsh_forest import grouped

    found = stored(vectors(df, name, values), "vectors")
    good = found.where("data is not null")
    equal = good.groupBy("data").agg(F.min("vec_id").alias("node"), F.count("*").alias("weight"))
    nodes = stored(equal.where("node is not null").select("data", "node", "weight"), "nodes")
    counts: DataFrame | None = None
    edges: DataFrame | None = None
    lengths = [r[0] for r in nodes.select(F.octet_length("data")).distinct().collect()]
    for length in sorted(lengths):  # as many as there are vector lengths: one, as a rule
        same = nodes.where(F.octet_length("data") == length)
        hashes, tables = shape(same.count(), cosine)
        args = (length // 8, hashes, tables, seed)
        members = _buckets(same, args)
        sizes = members.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
        sized = stored(members.join(sizes, "key"), "buckets")
        g = F.when(F.col("size") > BLOCK, F.ceil(F.col("size") / F.lit(BLOCK // 2))).otherwise(1).cast("int")
        dealt = sized.withColumn("g", g).withColumn("own", F.pmod(F.xxhash64("node"), F.col("g")).cast("int"))
        met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
        low, high = F.least("own", "other"), F.greatest("own", "other")
        side = F.when(low == high, 0).when(F.col("own") == low, 1).otherwise(2)
        placed = met.select("key", (low * F.col("g") + high).alias("block"), side.alias("side"), "number", "node")
        joined = placed.join(same, "node").repartition("key", "block").sortWithinPartitions("key", "block", "side", "node")

        def handle(batch: pa.RecordBatch, args=args) -> pa.RecordBatch | None:
            sides = batch.column("side").to_numpy(zero_copy_only=False)
            if sides[0] and sides[0] == sides[-1]:
                return None
            split = int(np.searchsorted(sides, 2)) if sides[0] or sides[-1] else 0
            unit = unit_of(b"".join(batch.column("data").to_pylist()), args[0])
            number = batch.column("number")[0].as_py()
            keys = tables_of(*args).keys(unit) if number else np.zeros((len(unit), 0), np.int64)
            weight = batch.column("weight").to_numpy(zero_copy_only=False)
            links, forest = compare(unit, keys, weight, number, split, cosine)
            used = np.flatnonzero(links)
            if not len(used):
                return None
            ids = batch.column("node").to_numpy(zero_copy_only=False)
            a, b = np.array(forest).T
            none = np.zeros(len(forest), np.int64)
            return pa.RecordBatch.from_pydict(
                {
                    "a": np.concatenate((ids[used], ids[a])),
                    "b": pa.array(np.concatenate((ids[used], ids[b])), pa.int64()),
                    "links": np.concatenate((links[used], none)),
                }
            )

        schema = "a long, b long, links long"
        hits = stored(joined.mapInArrow(lambda x, h=handle: grouped(h, x), schema), "hits")
        own = hits.where("a = b").groupBy("a").agg(F.sum("links").alias("links"))
        counts = own if counts is None else counts.unionByName(own)
        far = hits.where("a <> b").select("a", "b")
        edges = far if edges is None else edges.unionByName(far)
    if edges is None:
        alone = found.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
        return alone.withColumn("kept", F.lit(True))
    groups = (
        nodes.join(counts.withColumnRenamed("a", "node"), "node", "left")
        .join(components(edges), "node", "left")
        .select(
            "data",
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        )
    )
    rows = found.join(groups, "data", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(F.col("data").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull())
    return rows.withColumn("kept", kept)
