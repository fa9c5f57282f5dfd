"""Near-duplicate documents by an LSH forest over MinHash signatures.

A signature of ``VALUES`` minima is read in several orders. In each order documents
with a common prefix of a given depth stand together, which makes a region; all
members of a region are candidates for each other. Depth adapts to how crowded a
place is. In a region over ``REGION`` members one member is the pivot, and every other one is
compared with it first, so a group of n near copies costs n comparisons. Only if the
links found so far leave a crowded region in several pieces do its members go into
deeper and more orders, where members of one piece are not compared again; what is still
crowded there is compared in blocks, all members with those outside of the largest piece.
The regions that are not crowded, of both levels, and the blocks are compared together at the
end, when the pieces are known.

A pair at the threshold is missed by the first level with probability 5e-6: its 32 orders
share no value. The 96 orders of the second draw 7 of the same 128 values each and
depend on each other; there it is 4e-4 (``missed``).

Nothing emits pairs. A region task compares signatures in place; pairs that may
pass are given to the first order that holds them both, and only the documents
concerned come back with their full sets, to be compared exactly in that region.
What leaves it is a spanning forest of the confirmed links. Documents with equal
sets are one node throughout.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricetide.llm import components
from pricetide.llm.store import stored
from pricetide.llm.words import SPACE, mix, pieces, shingle_set, word_hashes

WIDTH = 5
VALUES = 128
REGION = 512
#: (depth, orders) of each level.
LEVELS = ((4, 32), (7, 96))
#: Tasks that the members of one pivot are dealt to.
SALTS = 32
#: Least similarity of signatures that is looked at: 4.5 deviations under the threshold.
MARGIN = 0.58

_DRAW = np.random.Generator(np.random.PCG64(19991231))
_FACTORS = _DRAW.integers(1, 2**63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TERMS = _DRAW.integers(1, 2**63, VALUES, dtype=np.uint64)


def orders(level: int) -> np.ndarray:
    """Positions of the signature that each order of a level begins with: (orders, depth)."""
    depth, n = LEVELS[level]
    if depth * n == VALUES:
        return np.arange(VALUES).reshape(n, depth)
    draw = np.random.Generator(np.random.PCG64(level))
    return np.array([draw.permutation(VALUES)[:depth] for _ in range(n)])


def missed(level: int, similarity: float = 0.75) -> float:
    """The chance that no order of a level holds a pair, over all signatures.

    Orders that share no values are independent. Others draw their values from the same
    signature: given how many of its values agree, each holds the pair or not by itself.
    """
    depth, n = LEVELS[level]
    if depth * n == VALUES:
        return (1 - similarity**depth) ** n
    total = 0.0
    for equal in range(VALUES + 1):
        chance = math.comb(VALUES, equal) * similarity**equal * (1 - similarity) ** (VALUES - equal)
        total += chance * (1 - math.comb(equal, depth) / math.comb(VALUES, depth)) ** n
    return total


def signature(shingles: np.ndarray) -> np.ndarray:
    least = np.full(VALUES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 2048):
        part = shingles[at : at + 2048, None] * _FACTORS + _TERMS
        np.minimum(least, part.min(axis=0), out=least)
    return (mix(least) & np.uint64(0xFFFF)).astype("<u2")


def shingles_of(text: bytes | None, width: int = WIDTH) -> np.ndarray:
    return shingle_set(word_hashes(text, SPACE), width) if text else np.zeros(0, np.uint64)


def pack(shingles: np.ndarray) -> bytes:
    return shingles.astype("<u8").tobytes()


def unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u8")


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets share ``percent`` of their union or more."""
    small, large = sorted((len(a), len(b)))
    if 100 * small < percent * large:
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (small + large - common)


def region_keys(signatures: np.ndarray, level: int) -> np.ndarray:
    """One key per document and order; the order's number, counted over all levels, is in the lowest byte."""
    places = orders(level)
    h = np.zeros((len(signatures), len(places)), np.uint64)
    for k in range(places.shape[1]):
        h = mix(h + signatures[:, places[:, k]].astype(np.uint64) + np.uint64(1 + level))
    first = sum(n for _, n in LEVELS[:level])
    return (h << np.uint64(8) | np.arange(first, first + len(places), dtype=np.uint64)).view(np.int64)


def equal_values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """In how many values each signature of ``a`` agrees with each of ``b``."""
    if len(a) * len(b) < 1 << 13:
        return (a[:, None, :] == b[None, :, :]).sum(2)
    columns, found = np.ascontiguousarray(b.T), np.zeros((len(a), len(b)), np.uint8)
    for k in range(VALUES):  # a value of all pairs at once: whole rows of small numbers
        found += (a[:, k, None] == columns[k]).view(np.uint8)
    return found


def candidates(
    signatures: np.ndarray, kin: np.ndarray, order: int, level: int, split: int = 0
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (i, j, equal values) of different pieces that may pass and that no earlier order holds.

    With ``split`` only pairs across that position count: the rest is another block's.
    """
    places, n = orders(level), len(signatures)
    least = int(MARGIN * VALUES)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    step = max(1, (1 << 16) // n)
    for at in range(0, split or n, step):
        part = signatures[at : min(at + step, split or n)]
        start = split or at  # pairs with earlier ones were seen from there
        same = equal_values(part, signatures[start:])
        i, j = np.nonzero(same >= least)
        counts, j = same[i, j], j + start
        ok = kin[i + at] != kin[j]
        if not split:
            ok &= i + at < j
        i, j, counts = i[ok], j[ok], counts[ok].astype(np.int64)
        for cut in range(0, len(i), 4096):
            a, b = i[cut : cut + 4096], j[cut : cut + 4096]
            equal = part[a] == signatures[b]
            own = np.ones(len(a), bool)
            for earlier in places[:order]:
                own &= ~equal[:, earlier].all(1)
            found.append((a[own] + at, b[own], counts[cut : cut + 4096][own]))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


# --- jobs ---------------------------------------------------------------------------------


def sketches(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_shingles, digest, signature); the last two are null for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            sets = [shingles_of(t, width) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "digest": pa.array(
                        [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()
                    ),
                    "signature": pa.array(
                        [signature(s).tobytes() if len(s) else None for s in sets], pa.binary()
                    ),
                }
            )

    slim = docs.select(F.col("doc_id").cast("long"), "text")
    return slim.mapInArrow(run, "doc_id long, n_shingles long, digest binary, signature binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, VALUES)


def memberships(nodes: DataFrame, level: int) -> DataFrame:
    """(key, node) for every order of the level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                piece = batch.slice(at, 1000)
                if not piece.num_rows:
                    continue
                keys = region_keys(_matrix(piece.column("signature")), level)
                ids = np.repeat(piece.column("node").to_numpy(zero_copy_only=False), keys.shape[1])
                yield pa.RecordBatch.from_pydict({"key": keys.ravel(), "node": ids})

    return nodes.select("node", "signature").mapInArrow(run, "key long, node long")


def regions(nodes: DataFrame, level: int) -> tuple[DataFrame, DataFrame]:
    """Members of regions of two or more as (key, block, side, node), and (key, node) of too large ones."""
    members = memberships(nodes, level)
    sizes = members.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    sized = stored(members.join(sizes, "key"), "regions")
    small = sized.where(F.col("size") <= REGION).select("key", F.lit(0).alias("block"), F.lit(0).alias("side"), "node")
    return small, sized.where(F.col("size") > REGION).select("key", "node")


def stars(crowded: DataFrame, docs: DataFrame, level: int, width: int, percent: int) -> DataFrame:
    """Links (a, b) of the members of crowded regions with the pivot of their region.

    The pivot is the member of least hash, so regions of one group of copies have one
    pivot in most orders, and a member is compared with it once.
    """

    def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            sets = [pack(shingles_of(t, width)) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {"pivot": batch.column("pivot"), "shingles": pa.array(sets, pa.binary())}
            )

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A pivot's set comes first, then the texts that are compared with it."""
        now, own = None, np.zeros(0, np.uint64)
        for batch in pieces(batches):
            a, b = [], []
            rows = (batch.column(c).to_pylist() for c in ("pivot", "node", "shingles"))
            texts = batch.column("text").cast(pa.binary())
            for at, (pivot, node, shingles) in enumerate(zip(*rows, strict=True)):
                if shingles is not None:
                    now, own = pivot, unpack(shingles)
                elif now == pivot and similar(own, shingles_of(texts[at].as_py(), width), percent):
                    a.append(pivot)
                    b.append(node)
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    draw = F.min(F.struct(F.xxhash64(F.lit(level), "node").alias("draw"), "node")).alias("least")
    pivots = crowded.groupBy("key").agg(draw).select("key", F.col("least.node").alias("pivot"))
    pairs = stored(crowded.join(pivots, "key").where("node <> pivot").select("node", "pivot").distinct(), "pairs")
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), "text")
    chosen = pairs.select("pivot").distinct()
    sets = texts.withColumnRenamed("node", "pivot").join(chosen, "pivot").select("pivot", "text")
    sets = sets.mapInArrow(full_sets, "pivot long, shingles binary")
    # the members of one pivot are many tasks' work, each with a copy of its set
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    first = sets.select("pivot", salts, F.lit(None).cast("long").alias("node"), "shingles", F.lit(None).cast("string").alias("text"))
    salt = F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int").alias("salt")
    rest = texts.join(pairs, "node").select("pivot", salt, "node", F.lit(None).cast("binary").alias("shingles"), "text")
    dealt = first.unionByName(rest).repartition("pivot", "salt").sortWithinPartitions("pivot", "salt", F.asc_nulls_first("node"))
    return dealt.mapInArrow(compared, "a long, b long")


def in_pieces(crowded: DataFrame, kin: DataFrame) -> DataFrame:
    """(key, node, kin) of the crowded regions that links leave in several pieces."""
    # a node is in as many regions as there are orders: it is looked up once
    nodes = crowded.groupBy("node").agg(F.collect_list("key").alias("keys"))
    named = nodes.join(kin, "node", "left").select("node", F.coalesce("component", "node").alias("kin"), "keys")
    marked = named.select(F.explode("keys").alias("key"), "node", "kin")
    pieces = marked.groupBy("key").agg(F.min("kin").alias("low"), F.max("kin").alias("high")).where("low <> high")
    return marked.join(pieces.select("key"), "key", "left_semi")


def blocks(members: DataFrame) -> DataFrame:
    """Crowded regions in blocks: (key, block, side, node).

    Members outside of a region's largest piece are cut into groups, and so are those of that
    piece. A block holds two groups, not both of the largest piece, so a few members of other
    pieces cost a few copies of the region.
    """
    sizes = members.groupBy("key", "kin").agg(F.count("*").alias("n"))
    regions_ = sizes.groupBy("key").agg(F.max(F.struct("n", "kin")).alias("top"), F.sum("n").alias("size"))
    some = lambda n: F.ceil(n / F.lit(REGION // 2)).cast("int")
    shape = regions_.select(
        "key", F.col("top.kin").alias("main"), some(F.col("size") - F.col("top.n")).alias("few"), some(F.col("top.n")).alias("many")
    )
    dealt = members.join(shape, "key")
    draw, main = F.xxhash64("node"), F.col("kin") == F.col("main")
    group = F.when(main, F.col("few") + F.pmod(draw, F.col("many"))).otherwise(F.pmod(draw, F.col("few"))).cast("int")
    last = F.when(main, F.col("few")).otherwise(F.col("few") + F.col("many")) - 1
    met = dealt.withColumn("own", group).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    # A block of a group with itself has one side, others have two.
    side = F.when(low == high, 0).when(F.col("own") == low, 1).otherwise(2)
    return met.select("key", (low * (F.col("few") + F.col("many")) + high).alias("block"), side.alias("side"), "node")


def grouped(handle: Callable, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Call ``handle`` with all rows of each (key, block) of a sorted partition."""
    held: list[pa.RecordBatch] = []

    def flush() -> Iterator[pa.RecordBatch]:
        if held:
            table = pa.Table.from_batches(held).combine_chunks()
            whole = table.to_batches()[0] if table.num_rows else None
            if whole is not None:
                yield from each(whole)

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keys, blocks = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "block"))
        edges = np.flatnonzero((keys[1:] != keys[:-1]) | (blocks[1:] != blocks[:-1])) + 1
        bounds = [0, *edges.tolist(), len(keys)]
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if b - a > 1:
                found = handle(batch.slice(a, b - a))
                if found is not None:
                    yield found

    for batch in batches:
        if not batch.num_rows:
            continue
        keys, blocks = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "block"))
        # Everything before the last group of the batch is complete.
        start = len(keys) - 1
        while start and keys[start - 1] == keys[-1] and blocks[start - 1] == blocks[-1]:
            start -= 1
        if start:
            held.append(batch.slice(0, start))
            yield from flush()
            held = [batch.slice(start)]
        elif held and (held[0].column("key")[0].as_py(), held[0].column("block")[0].as_py()) != (keys[0], blocks[0]):
            yield from flush()
            held = [batch]
        else:
            held.append(batch)
    yield from flush()


def _order_and_level(batch: pa.RecordBatch) -> tuple[int, int]:
    """(order, level) of a region."""
    order, level = batch.column("key")[0].as_py() & 0xFF, 0
    while order >= LEVELS[level][1]:
        order, level = order - LEVELS[level][1], level + 1
    return order, level


def _split(batch: pa.RecordBatch) -> int:
    """Rows are sorted by side: where side 2 begins, or 0 for a block of one side."""
    sides = batch.column("side").to_numpy(zero_copy_only=False)
    return int(np.searchsorted(sides, 2)) if sides[0] or sides[-1] else 0


def _one_sided(batch: pa.RecordBatch) -> bool:
    sides = batch.column("side").to_numpy(zero_copy_only=False)
    return bool(sides[0]) and sides[0] == sides[-1]


def active(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """Members of a region that have a candidate pair there."""

    def handle(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        if _one_sided(batch):
            return None
        signatures, kin = _matrix(batch.column("signature")), batch.column("kin").to_numpy(zero_copy_only=False)
        i, j, _ = candidates(signatures, kin, *_order_and_level(batch), _split(batch))
        if not len(i):
            return None
        used = pa.array(np.unique(np.concatenate((i, j))))
        return batch.select(["key", "block", "side", "node", "kin"]).take(used)

    joined = members.join(nodes.select("node", "signature", "kin"), "node")
    dealt = joined.select("key", "block", "side", "node", "kin", "signature").repartition("key", "block")
    return dealt.sortWithinPartitions("key", "block", "side", "node").mapInArrow(
        lambda batches: grouped(handle, batches), "key long, block int, side int, node long, kin long"
    )


def confirmed(found: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) of full sets, as a spanning forest of each region."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each document's set, computed once and repeated for its places."""
        for batch in pieces(batches):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            names = batch.column("node").to_pylist()
            rows, size = [], 0
            for name, text, places in zip(names, texts, batch.column("places").to_pylist(), strict=True):
                full = shingles_of(text, width)
                own = (name, signature(full).tobytes(), pack(full))
                rows += [(p["key"], p["block"], p["side"], *own, p["kin"]) for p in places]
                size += len(own[2]) * len(places)
                if size > 1 << 22:
                    yield _batch(rows)
                    rows, size = [], 0
            if rows:
                yield _batch(rows)

    def handle(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        if _one_sided(batch):
            return None
        signatures, kin = _matrix(batch.column("signature")), batch.column("kin").to_numpy(zero_copy_only=False)
        i, j, same = candidates(signatures, kin, *_order_and_level(batch), _split(batch))
        full = [unpack(s) for s in batch.column("shingles").to_pylist()]
        parent = list(range(len(full)))

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        links = []
        for k in np.argsort(-same, kind="stable").tolist():
            a, b = int(i[k]), int(j[k])
            ra, rb = root(a), root(b)
            if ra == rb:
                continue
            if similar(full[a], full[b], percent):
                parent[ra] = rb
                links.append((a, b))
        if not links:
            return None
        ids = batch.column("node").to_numpy(zero_copy_only=False)
        a, b = np.array(links).T
        return pa.RecordBatch.from_pydict({"a": ids[a], "b": ids[b]})

    places = found.groupBy("node").agg(F.collect_list(F.struct("key", "block", "side", "kin")).alias("places"))
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), "text")
    joined = texts.join(places, "node").select("node", "text", "places")
    schema = "key long, block int, side int, node long, signature binary, shingles binary, kin long"
    dealt = joined.mapInArrow(sets, schema).repartition("key", "block").sortWithinPartitions("key", "block", "side", "node")
    return dealt.mapInArrow(lambda batches: grouped(handle, batches), "a long, b long")


_PLACED = pa.schema(
    [
        ("key", pa.int64()),
        ("block", pa.int32()),
        ("side", pa.int32()),
        ("node", pa.int64()),
        ("signature", pa.binary()),
        ("shingles", pa.binary()),
        ("kin", pa.int64()),
    ]
)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, _PLACED, strict=True)], schema=_PLACED
    )


def as_links(kin: DataFrame) -> DataFrame:
    return kin.select(F.col("component").alias("a"), F.col("node").alias("b"))


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = 75) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept.

    Texts without words have an empty set and stand alone. Rows with equal ids and
    equal texts are one node. A row without an id joins the group of its text; it is
    kept only where no row of that text has an id, and then has no component.
    """
    made = stored(sketches(docs, width), "sketches")
    same = made.where("digest is not null and doc_id is not null").groupBy("digest")
    nodes = stored(same.agg(F.min("doc_id").alias("node"), F.first("signature").alias("signature")), "nodes")
    rest, compared = nodes, []
    kin = nodes.select("node", F.col("node").alias("component")).where(F.lit(False))
    for level in range(len(LEVELS)):
        small, crowded = regions(rest, level)
        compared.append(small)
        if crowded.isEmpty():
            break
        # the links of the levels before are in the pieces they made
        kin = components.stars(stars(crowded, docs, level, width, percent).unionByName(as_links(kin)))
        crowded = stored(in_pieces(crowded, kin), "pieces")
        if crowded.isEmpty():
            break
        if level + 1 < len(LEVELS):
            rest = stored(nodes.join(crowded.select("node").distinct(), "node"), "nodes")
        else:
            compared.append(blocks(crowded))
    marked = nodes.join(kin, "node", "left").select("node", "signature", F.coalesce("component", "node").alias("kin"))
    found = active(functools.reduce(DataFrame.unionByName, compared), marked)
    of_node = components.stars(confirmed(found, docs, width, percent).unionByName(as_links(kin)))
    groups = nodes.select("digest", "node").join(of_node, "node", "left")
    groups = groups.select("digest", F.coalesce("component", "node").alias("component_id"))
    rows = made.select("doc_id", "n_shingles", "digest").join(groups, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    named = rows.withColumn("component_id", component)
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    return named.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def deduplicated(docs: DataFrame, width: int = WIDTH, percent: int = 75) -> DataFrame:
    """One document of each group, with the columns they had; repeated rows of one id count once.

    Rows without an id go by a hash of their text, above all ids: they stay only in
    groups where no row has an id.
    """
    hashed = F.xxhash64("text").bitwiseAND(F.lit(2**62 - 1)).bitwiseOR(F.lit(2**62))
    name = F.coalesce(F.col("doc_id").cast("long"), hashed)
    found = near_duplicates(docs.select(name.alias("doc_id"), "text"), width, percent)
    kept = found.where("kept").select(F.col("doc_id").alias("__kept")).distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    packed = docs.select(name.alias("__id"), F.xxhash64(row).alias("__hash"), row.alias("__row"))
    joined = packed.join(kept, F.col("__id") == F.col("__kept"), "left_semi")
    one = Window.partitionBy("__id").orderBy("__hash")
    return joined.withColumn("__copy", F.row_number().over(one)).where("__copy = 1").select("__row.*")
