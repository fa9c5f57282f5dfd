"""Nearest neighbours by a graph that NN-descent builds, and greedy search on it.

Building. Every vector starts with neighbours from a few random partitions: vectors
are sorted by the sides of random hyperplanes on which they lie and compared within
windows of that order. Then neighbours of neighbours are joined round by round: every
node gathers a sample of its neighbours, new and old ones, in both directions; those
that meet there for the first time are compared, and each node keeps the nearest it has
heard of. The rounds end when few neighbours change.

Searching. A query enters at the nearest of a bounded sample of nodes and at its own
node, if it is a row. Each hop expands the nearest nodes of its beam that are not yet
expanded: their links are joined, unseen nodes are compared, and the nearest stay in the
beam. It ends when all of the beam is expanded. At last the whole beam is compared again
by the exact distance of the original vectors.

In graph and beam vectors stand as one byte a component, around a common centre: that
only decides which nodes are compared exactly. Equal vectors are one node, however many.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricetide.llm.stable_hash import vectors
from pricetide.llm.store import fresh_path, stored
from pricetide.llm.words import mix

#: Neighbours a node keeps, and links it takes back from nodes that have it as neighbour.
NEIGHBOURS, BACKWARD = 32, 32
#: Random partitions to start from, and vectors of a window.
PARTITIONS, WINDOW = 6, 2_048
#: New, and old, neighbours a node gathers of each direction in a round, and the nearest
#: that one meeting tells a node of.
SAMPLE, TOLD = 12, 6
#: Share of neighbours that change in the last round, and the most rounds.
SETTLED, ROUNDS = 0.05, 8
#: Nodes of a beam, nodes expanded in a hop, nodes to enter at, and their sample.
BEAM, EXPANDED, ENTRIES, PIVOTS = 256, 192, 16, 1_024
#: Least nodes, and queries, of a task: starting a Python task costs as much as these.
TASK_NODES, TASK_QUERIES = 1_024, 32

_DRAWS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_LISTS = "node long, ids array<long>, far array<float>, new array<boolean>"
_GRAPH = f"{_LISTS}, code binary, pick array<boolean>"


class Codes:
    """Vectors as a scale and signed bytes around a centre, one centre for each length.

    The sample that gives the centres is of bounded size.
    """

    def __init__(self, sample: list[tuple[int, bytes]]) -> None:
        found: dict[int, list[tuple[int, np.ndarray]]] = {}
        for node, data in sample:
            found.setdefault(len(data) // 8, []).append((node, np.frombuffer(data, np.float64)))
        #: the largest magnitude in the sample, so that no square leaves the range of floats
        self.unit = max((float(np.abs(v).max()) for own in found.values() for _, v in own), default=1.0)
        self.centre = {n: np.mean([v / self.unit for _, v in own], axis=0) for n, own in found.items()}
        self.nodes = {n: np.array([i for i, _ in own], np.int64) for n, own in found.items()}
        self.pivots = {n: decoded(self.encode(np.array([v for _, v in own]))) for n, own in found.items()}

    def encode(self, rows: np.ndarray) -> list[bytes]:
        centre = self.centre.get(rows.shape[1], 0.0)
        x = np.clip(rows / self.unit, -1e15, 1e15) - centre
        scale = np.abs(x).max(axis=1) / 127
        whole = np.rint(x / np.where(scale > 0, scale, 1)[:, None]).astype(np.int8)
        out = np.empty((len(rows), 4 + rows.shape[1]), np.uint8)
        out[:, :4] = scale.astype("<f4")[:, None].view(np.uint8)
        out[:, 4:] = whole.view(np.uint8)
        return [r.tobytes() for r in out]


def decoded(codes: list[bytes]) -> np.ndarray:
    raw = np.frombuffer(b"".join(codes), np.uint8).reshape(len(codes), -1)
    return raw[:, 4:].view(np.int8).astype(np.float32) * raw[:, :4].copy().view("<f4")


def matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and decoded vectors of each length in a column of codes."""
    codes = column.to_pylist()
    sizes = np.array([len(c) for c in codes])
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield rows, decoded([codes[i] for i in rows.tolist()])


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` and ``b`` (also in stacks)."""
    own = (a * a).sum(-1)[..., :, None] + (b * b).sum(-1)[..., None, :]
    return np.maximum(own - 2 * (a @ np.swapaxes(b, -1, -2)), 0)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...], rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Batches of a sorted partition that begin and end with a group of equal keys."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
        if size < rows:
            continue
        whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        same = np.ones(whole.num_rows, bool)
        for k in keys:
            own = whole.column(k).to_numpy(zero_copy_only=False)
            same &= own == own[-1]
        start = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if start:
            yield whole.slice(0, start)
        held, size = [whole.slice(start)], whole.num_rows - start
    if size:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _flat(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False)


def _lists(rows: np.ndarray, n: int, values: pa.Array) -> pa.Array:
    """``values`` as lists of ``n`` rows; ``rows`` rises."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(rows, np.arange(n + 1)), pa.int32()), values)


def _nearest(node: np.ndarray, ids: np.ndarray, far: np.ndarray, new: np.ndarray, keep: int) -> tuple[np.ndarray, ...]:
    """Of all (node, id) the ``keep`` nearest of each node, by distance; one met before is not new."""
    order = np.lexsort((new, ids, node))
    node, ids, far, new = node[order], ids[order], far[order], new[order]
    once = np.ones(len(node), bool)
    once[1:] = (node[1:] != node[:-1]) | (ids[1:] != ids[:-1])
    node, ids, far, new = node[once], ids[once], far[once], new[once]
    order = np.lexsort((ids, far, node))
    node, ids, far, new = node[order], ids[order], far[order], new[order]
    kept = _rank(node) < keep
    return node[kept], ids[kept], far[kept].astype(np.float32), new[kept]


def _rank(*keys: np.ndarray) -> np.ndarray:
    """Place of each row among the rows of equal keys; equal keys stand together."""
    n = len(keys[0])
    first = np.zeros(n, bool)
    first[:1] = True
    for k in keys:
        first[1:] |= k[1:] != k[:-1]
    starts = np.flatnonzero(first)
    return np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))


def _tasks(df: DataFrame, rows: int, least: int) -> DataFrame:
    """Neighbouring partitions joined where they are more than the rows are worth; order within each stays."""
    return df.coalesce(max(1, -(-rows // least)))


def _merged(rows: DataFrame, turn: int, count: int) -> DataFrame:
    """The nearest neighbours of each node, of all lists it has, and which of them meet in the next round.

    One row of each node has its code.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_groups(batches, ("node",)):
            sizes = batch.column("ids").value_lengths().to_numpy(zero_copy_only=False)
            every = batch.column("node").to_numpy(zero_copy_only=False)
            lists = (_flat(batch.column(c)) for c in ("ids", "far", "new"))
            node, ids, far, new = _nearest(np.repeat(every, sizes), *lists, NEIGHBOURS)
            new = new.astype(bool)
            drawn = mix(node.astype(np.uint64) * _DRAWS[0] + ids.astype(np.uint64) * _DRAWS[1] + np.uint64(turn))
            order = np.lexsort((drawn, new, node))
            pick = np.zeros(len(node), bool)
            pick[order] = _rank(node[order], new[order]) < SAMPLE
            coded = np.flatnonzero(batch.column("code").is_valid().to_numpy(zero_copy_only=False))
            coded = coded[np.argsort(every[coded])]
            own = every[coded]
            place = np.searchsorted(own, node)
            yield pa.RecordBatch.from_pydict(
                {
                    "node": own,
                    "ids": _lists(place, len(own), pa.array(ids)),
                    "far": _lists(place, len(own), pa.array(far)),
                    "new": _lists(place, len(own), pa.array(new)),
                    "code": batch.column("code").take(pa.array(coded)),
                    "pick": _lists(place, len(own), pa.array(pick)),
                }
            )

    dealt = rows.repartition("node").sortWithinPartitions("node")
    return _tasks(dealt, count, TASK_NODES).mapInArrow(run, _GRAPH)


def _starting(codes: DataFrame, count: int, seed: int) -> DataFrame:
    """Neighbours within the windows of random partitions."""
    depth = max(1, int(np.ceil(np.log2(max(2, count / WINDOW)))))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in matrices(batch.column("code")):
                part = batch.take(pa.array(rows))
                for p in range(PARTITIONS):
                    draw = np.random.Generator(np.random.PCG64([seed, p, x.shape[1]]))
                    sides = x @ draw.standard_normal((x.shape[1], depth + 1)).astype(np.float32)
                    cell = ((sides[:, :depth] > 0) << np.arange(depth)).sum(axis=1)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "part": pa.array(np.full(len(rows), p), pa.int32()),
                            "size": pa.array(np.full(len(rows), x.shape[1]), pa.int32()),
                            "cell": pa.array(cell, pa.int64()),
                            "side": pa.array(sides[:, depth], pa.float32()),
                            "node": part.column("node"),
                            "code": part.column("code"),
                        }
                    )

    def compared(window: pa.RecordBatch) -> pa.RecordBatch | None:
        ids = window.column("node").to_numpy(zero_copy_only=False)
        if len(ids) < 2:
            return None
        x = decoded(window.column("code").to_pylist())
        keep = min(NEIGHBOURS, len(ids) - 1)
        far, near = np.empty((len(ids), keep), np.float32), np.empty((len(ids), keep), np.int64)
        for at in range(0, len(ids), 512):
            d = squares(x[at : at + 512], x)
            d[np.arange(len(d)), np.arange(at, at + len(d))] = np.inf
            own = np.argpartition(d, keep - 1, axis=1)[:, :keep]
            near[at : at + 512], far[at : at + 512] = ids[own], np.take_along_axis(d, own, 1)
        rows = np.repeat(np.arange(len(ids)), keep)
        return pa.RecordBatch.from_pydict(
            {
                "node": ids,
                "ids": _lists(rows, len(ids), pa.array(near.ravel())),
                "far": _lists(rows, len(ids), pa.array(far.ravel())),
                "new": _lists(rows, len(ids), pa.array(np.ones(near.size, bool))),
            }
        )

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in itertools.chain(batches, [None]):
            held += [batch] if batch is not None and batch.num_rows else []
            if not held:
                continue
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            kind = (rows.column("part").to_numpy().astype(np.int64) << 32) + rows.column("size").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(kind)) + 1).tolist(), len(kind)]
            held = []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if b == len(kind) and batch is not None:  # may go on: its last window waits
                    start = a + max(0, (b - a) // WINDOW - 1) * WINDOW
                    held, b = [rows.slice(start)], start
                cuts = np.linspace(a, b, max(1, (b - a) // WINDOW) + 1).astype(int).tolist()
                for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                    found = compared(rows.slice(x, y - x))
                    if found is not None:
                        yield found

    dealt = codes.mapInArrow(cells, "part int, size int, cell long, side float, node long, code binary")
    order = ("part", "size", "cell", "side", "node")
    dealt = dealt.repartitionByRange(*order).sortWithinPartitions(*order)
    return _tasks(dealt, count * PARTITIONS, 4 * WINDOW).mapInArrow(windows, _LISTS)


def _met(gathered: DataFrame, count: int) -> DataFrame:
    """What nodes learn where they meet: lists of nearer neighbours. Rows stand together by node."""

    def flush(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        node, ids, far = (np.concatenate(c) for c in zip(*parts, strict=True))
        node, ids, far, new = _nearest(node, ids, far, np.ones(len(node), bool), NEIGHBOURS)
        own, place = np.unique(node, return_inverse=True)
        return pa.RecordBatch.from_pydict(
            {
                "node": own,
                "ids": _lists(place, len(own), pa.array(ids)),
                "far": _lists(place, len(own), pa.array(far)),
                "new": _lists(place, len(own), pa.array(new)),
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, ...]] = []
        held = 0
        for batch in whole_groups(batches, ("node",)):
            all_nodes, all_ids, all_new, all_bound = (
                batch.column(c).to_numpy(zero_copy_only=False) for c in ("node", "id", "new", "bound")
            )
            for rows, x in matrices(batch.column("code")):
                node, ids, new, bound = all_nodes[rows], all_ids[rows], all_new[rows], all_bound[rows]
                order = np.lexsort((~new.astype(bool), ids, node))
                once = np.ones(len(order), bool)
                once[1:] = (node[order][1:] != node[order][:-1]) | (ids[order][1:] != ids[order][:-1])
                order = order[once]
                node, ids, new, bound, x = node[order], ids[order], new[order], bound[order], x[order]
                starts = np.flatnonzero(np.diff(node, prepend=node[0] - 1))
                sizes = np.diff(np.append(starts, len(node)))
                for at in range(0, len(starts), 512):
                    s, n = starts[at : at + 512], sizes[at : at + 512]
                    wide = np.arange(n.max())
                    empty = wide >= n[:, None]
                    slot = np.where(empty, 0, s[:, None] + wide)
                    d = squares(x[slot], x[slot])
                    d[empty[:, None, :] | empty[:, :, None]] = np.inf
                    d[:, wide, wide] = np.inf
                    fresh = new[slot].astype(bool)
                    d[~(fresh[:, :, None] | fresh[:, None, :])] = np.inf
                    d[d >= bound[slot][:, :, None]] = np.inf
                    keep = min(TOLD, len(wide))
                    own = np.argpartition(d, keep - 1, axis=2)[:, :, :keep]
                    far = np.take_along_axis(d, own, 2)
                    g, i, j = np.nonzero(np.isfinite(far))
                    if len(g):
                        parts.append((ids[slot[g, i]], ids[slot[g, own[g, i, j]]], far[g, i, j]))
                        held += len(g)
                    if held > 1_000_000:
                        found, parts, held = flush(parts), [], 0
                        yield found
        if parts:
            yield flush(parts)

    return _tasks(gathered, count, TASK_NODES).mapInArrow(run, _LISTS)


def _round(graph: DataFrame, turn: int, count: int) -> DataFrame:
    """One round of joining neighbours of neighbours."""
    full = F.size("far") >= NEIGHBOURS
    bound = F.when(full, F.element_at("far", -1)).otherwise(F.lit(float("inf")).cast("float")).alias("bound")
    entry = F.explode(F.filter(F.arrays_zip("ids", "new", "pick"), lambda e: e["pick"]))
    picked = graph.select("node", "code", bound, entry.alias("e"))
    # a node asks for the codes of its neighbours, and sends its own to them
    asked = picked.select("node", F.col("e.ids").alias("id"), F.col("e.new").alias("new"))
    known = graph.select(F.col("node").alias("id"), "code", bound)
    forth = asked.join(known, "id").select("node", "id", "new", "code", "bound", F.lit(0).alias("side"))
    back = picked.select(
        F.col("e.ids").alias("node"), F.col("node").alias("id"), F.col("e.new").alias("new"), "code", "bound", F.lit(1).alias("side")
    )
    # a node that very many have as neighbour takes a sample of them
    order = ("side", F.xxhash64(F.lit(turn), "id", "node"))
    rank = F.row_number().over(Window.partitionBy("node").orderBy(*order))
    gathered = forth.unionByName(back).withColumn("rank", rank).where(F.col("rank") <= 4 * SAMPLE)
    # what is picked meets now: it is old from here on
    aged = F.zip_with("new", "pick", lambda n, p: n & ~p).alias("new")
    lists = graph.select("node", "ids", "far", aged, "code")
    told = _met(gathered, count)
    return stored(_merged(lists.unionByName(told, allowMissingColumns=True), turn + 1, count), "graph")


def graph_of(codes: DataFrame, seed: int = 0) -> DataFrame:
    """(node, ids, far, new, ..): the nearest neighbours found of every node of (node, code)."""
    count = codes.count()
    none = [F.array().cast(f"array<{t}>").alias(c) for c, t in (("ids", "long"), ("far", "float"), ("new", "boolean"))]
    start = codes.select("node", *none, "code").unionByName(_starting(codes, count, seed), allowMissingColumns=True)
    graph = stored(_merged(start, 0, count), "graph")
    for turn in range(ROUNDS):
        graph = _round(graph, turn, count)
        changed = graph.agg(F.sum(F.size(F.filter("new", lambda n: n)))).first()[0] or 0
        if changed <= SETTLED * NEIGHBOURS * count:
            break
    return graph


def links_of(graph: DataFrame) -> DataFrame:
    """(node, ids): neighbours, and the nearest nodes that have the node as neighbour."""
    forth = graph.select("node", F.inline(F.arrays_zip("ids", "far"))).withColumnRenamed("ids", "id")
    back = forth.select(F.col("id").alias("node"), F.col("node").alias("id"), "far")
    rank = F.row_number().over(Window.partitionBy("node").orderBy("far", "id"))
    back = back.withColumn("rank", rank).where(F.col("rank") <= BACKWARD)
    both = forth.select("node", "id").unionByName(back.select("node", "id"))
    return stored(both.groupBy("node").agg(F.collect_set("id").alias("ids")), "links")


_BEAMS = "q long, code binary, ids array<long>, far array<float>, done array<boolean>, ahead array<long>"


def _beam(q: int, code: bytes, ids: np.ndarray, far: np.ndarray, done: np.ndarray) -> dict:
    order = np.lexsort((ids, far))[:BEAM]
    ids, far, done = ids[order], far[order], done[order]
    ahead = np.flatnonzero(~done)[:EXPANDED]
    done = done.copy()
    done[ahead] = True
    return {"q": q, "code": code, "ids": ids, "far": far.astype(np.float32), "done": done, "ahead": ids[ahead]}


_BEAM_SCHEMA = pa.schema(
    [("q", pa.int64()), ("code", pa.binary()), ("ids", pa.list_(pa.int64())), ("far", pa.list_(pa.float32())),
     ("done", pa.list_(pa.bool_())), ("ahead", pa.list_(pa.int64()))]
)


def _entered(shared) -> Callable:
    """Beams of the nearest pivots and the own node of each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: Codes = shared.value
        for batch in batches:
            numbers, own = batch.column("q").to_pylist(), batch.column("node").to_pylist()
            beams = []
            for rows, x in matrices(batch.column("code")):
                pivots = codes.pivots.get(x.shape[1])
                for at, v in zip(rows.tolist(), x, strict=True):
                    ids, far = np.zeros(0, np.int64), np.zeros(0, np.float32)
                    if pivots is not None:
                        d = squares(v[None], pivots)[0]
                        near = np.argsort(d, kind="stable")[:ENTRIES]
                        ids, far = codes.nodes[x.shape[1]][near], d[near]
                    if own[at] is not None and own[at] not in ids:
                        ids, far = np.append(ids, own[at]), np.append(far, 0)
                    beams.append(_beam(numbers[at], batch.column("code")[at].as_py(), ids, far, np.zeros(len(ids), bool)))
            if beams:
                yield pa.RecordBatch.from_pylist(beams, _BEAM_SCHEMA)

    return run


def _unseen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the links of expanded nodes those that a query has not seen; (q, ids)."""
    for batch in whole_groups(batches, ("q",)):
        sizes = batch.column("ids").value_lengths().to_numpy(zero_copy_only=False)
        q = np.repeat(batch.column("q").to_numpy(zero_copy_only=False), sizes)
        seen = np.repeat(batch.column("seen").to_numpy(zero_copy_only=False), sizes).astype(bool)
        ids = _flat(batch.column("ids"))
        order = np.lexsort((~seen, ids, q))
        q, ids, seen = q[order], ids[order], seen[order]
        first = np.ones(len(q), bool)
        first[1:] = (q[1:] != q[:-1]) | (ids[1:] != ids[:-1])
        new = first & ~seen
        own, place = np.unique(q[new], return_inverse=True)
        if len(own):
            yield pa.RecordBatch.from_pydict({"q": own, "ids": _lists(place, len(own), pa.array(ids[new]))})


def _advanced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Beams with the nodes of this hop in them: rows with lists are beams, the others nodes."""
    for batch in whole_groups(batches, ("q",), 5_000):
        q = batch.column("q").to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(np.diff(q)) + 1).tolist(), len(q)]
        nodes = batch.column("node").fill_null(0).to_numpy(zero_copy_only=False)
        beams = []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            # the beam comes first: its node is null, and nulls sort first
            ids, far, done = (batch.column(c)[a].values.to_numpy(zero_copy_only=False) for c in ("ids", "far", "done"))
            code = batch.column("code")[a].as_py()
            if b - a > 1:
                x = decoded(batch.column("code").slice(a + 1, b - a - 1).to_pylist())
                ids = np.concatenate((ids, nodes[a + 1 : b]))
                far = np.concatenate((far, squares(decoded([code]), x)[0]))
                done = np.concatenate((done, np.zeros(b - a - 1, bool)))
            beams.append(_beam(int(q[a]), code, ids, far, done.astype(bool)))
        yield pa.RecordBatch.from_pylist(beams, _BEAM_SCHEMA)


def greedy(queries: DataFrame, links: DataFrame, codes: DataFrame, entries) -> DataFrame:
    """(q, ids): the final beam of each query of (q, node, code); node null if it is no row."""
    spark, count = queries.sparkSession, queries.count()
    folder = fresh_path(spark, "seen")
    beams = stored(queries.select("q", "node", "code").mapInArrow(_entered(entries), _BEAMS), "beams")
    beams.select("q", "ids").write.parquet(f"{folder}/hop=0")
    hop = 0
    while not beams.where(F.size("ahead") > 0).isEmpty():
        hop += 1
        ahead = beams.select("q", F.explode("ahead").alias("node"))
        asked = ahead.join(links, "node").select("q", "ids", F.lit(False).alias("seen"))
        seen = spark.read.schema("q long, ids array<long>").parquet(folder).select("q", "ids", F.lit(True).alias("seen"))
        dealt = asked.unionByName(seen).repartition("q").sortWithinPartitions("q")
        _tasks(dealt, count, TASK_QUERIES).mapInArrow(_unseen, "q long, ids array<long>").write.parquet(f"{folder}/hop={hop}")
        new = spark.read.schema("q long, ids array<long>").parquet(f"{folder}/hop={hop}")
        met = new.select("q", F.explode("ids").alias("node")).join(codes, "node")
        rows = beams.drop("ahead").withColumn("node", F.lit(None).cast("long")).unionByName(met, allowMissingColumns=True)
        dealt = rows.repartition("q").sortWithinPartitions("q", "node")
        beams = stored(_tasks(dealt, count, TASK_QUERIES).mapInArrow(_advanced, _BEAMS), "beams")
    return beams.select("q", "ids")


def _exact(k: int) -> Callable:
    """The ``k`` nearest of the compared nodes by the distance of the vectors: (q, node, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_groups(batches, ("q",), 2_000):
            q = batch.column("q").to_numpy(zero_copy_only=False)
            node = batch.column("node").to_numpy(zero_copy_only=False)
            score = np.empty(len(q))
            ours, theirs = batch.column("own").to_pylist(), batch.column("data").to_pylist()
            with np.errstate(over="ignore"):
                for i, (a, b) in enumerate(zip(ours, theirs, strict=True)):
                    d = np.frombuffer(a, np.float64) - np.frombuffer(b, np.float64)
                    score[i] = np.sqrt((d * d).sum())
            order = np.lexsort((score, q))
            _, starts, sizes = np.unique(q[order], return_index=True, return_counts=True)
            last = np.repeat(score[order][starts + np.minimum(sizes, k) - 1], sizes)
            order = order[score[order] <= last]  # ties with the last one stay
            yield pa.RecordBatch.from_pydict({"q": q[order], "node": node[order], "score": score[order]})

    return run


def nearest(
    df: DataFrame, k: int = 10, every: int = 100, name: str = "vec_id", values: str = "embedding", seed: int = 0
) -> DataFrame:
    """The ``k`` nearest rows found for each row whose id ``every`` divides.

    Columns query_id, rank, vec_id, score: Euclidean distance of the original vectors
    as doubles, ties to the smaller id; all candidates if there are fewer than ``k``.

    Rows without an id, and vectors that are null, empty, zero or hold null or
    non-finite components, take no part. Vectors of different lengths are no neighbours. A
    row that comes twice is one; rows of one id with different vectors are candidates
    each, but never for the id itself. An empty table gives no rows. Other columns
    are not read. Lists are approximate, scores are not.
    """
    spark = df.sparkSession
    rows = vectors(df, name, values).where("data is not null and vec_id is not null")
    rows = stored(rows.distinct(), "vectors")
    equal = rows.groupBy("data").agg(F.min("vec_id").alias("least"))
    # ids may stand for several vectors: a node has a number of its own
    nodes = stored(equal.withColumn("node", F.monotonically_increasing_id()), "nodes")
    sample = nodes.orderBy(F.xxhash64("data"), "data").limit(PIVOTS).select("node", "data").collect()
    entries = spark.sparkContext.broadcast(Codes([(r.node, bytes(r.data)) for r in sample]))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, out = batch.column("data").to_pylist(), [b""] * batch.num_rows
            sizes = np.array([len(d) for d in data])
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size).tolist()
                x = np.frombuffer(b"".join(data[i] for i in at), np.float64).reshape(len(at), -1)
                for i, code in zip(at, entries.value.encode(x), strict=True):
                    out[i] = code
            yield pa.RecordBatch.from_pydict({"node": batch.column("node"), "code": pa.array(out, pa.binary())})

    codes = stored(nodes.select("node", "data").mapInArrow(encoded, "node long, code binary"), "codes")
    links = links_of(graph_of(codes, seed))
    asked = rows.where(F.col("vec_id") % every == 0).join(nodes.select("data", "node"), "data")
    queries = stored(
        asked.join(codes, "node").select(F.monotonically_increasing_id().alias("q"), F.col("vec_id").alias("query_id"), "node", "code"),
        "queries",
    )
    beams = greedy(queries, links, codes, entries)
    plain = nodes.select("node", "data")
    found = beams.select("q", F.explode("ids").alias("node")).join(plain, "node")
    own = queries.join(plain, "node").select("q", F.col("data").alias("own"))
    scored = (
        found.join(own, "q")
        .repartition("q")
        .sortWithinPartitions("q", "node")
        .mapInArrow(_exact(k + 1), "q long, node long, score double")
    )
    first = F.row_number().over(Window.partitionBy("data").orderBy("vec_id"))
    members = rows.withColumn("rank", first).where(F.col("rank") <= k + 1).select("data", "vec_id")
    members = members.join(plain, "data").select("node", "vec_id")
    ids = queries.select("q", "query_id")
    answers = scored.join(members, "node").join(ids, "q").where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("q").orderBy("score", "vec_id"))
    ranked = answers.withColumn("rank", rank).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
