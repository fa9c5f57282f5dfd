"""Ranked search of documents for a set of items by the Best Position Algorithm.

Documents are dealt into shards of a bounded size. In a shard every term of the items
has an impact list: the documents that hold it, by falling impact, and the same by
document for direct accesses. An item reads its lists from the top. Each document met
is completed by direct accesses into all lists, which also mark the places where it
stands there. The best position of a list is the end of its unbroken run of marked
places. No unseen document can score more than the impacts that come next after the
best positions add up to, and this bound falls faster than that of the places read
last. A search stops when the bound is strictly below the score of the last place of
the result: an equal one might still come with a smaller id. The results of the shards
are merged by rank.

A first pass over the texts keeps, of every document, its length and the terms that an
item may use (by a bitmap of bounded size, so some others come along and find no item).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricetide.llm.store import stored
from pricetide.llm.words import LOWER, OTHER, prefix_sums, span_hashes

#: Documents of a shard and items of a block, on average: the group of one task.
SHARD_DOCS, BLOCK_ITEMS = 1 << 14, 1 << 10
#: Bits of the bitmap of item terms: 8 MiB.
SLOT_BITS = 26
#: Bytes of text that are worked on at once.
STRETCH = 1 << 22
#: Places that the first round reads of each list; every round reads twice as many.
FIRST_READ = 64


def _spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and slots of the terms of folded bytes."""
    edge = np.diff((~OTHER[data]).view(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    slots = span_hashes(prefix_sums(data), starts, ends) >> np.uint64(64 - SLOT_BITS)
    return starts, ends, slots.astype(np.int64)


def _texts_at(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes between starts and ends as one column."""
    sizes = ends - starts
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    at = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], sizes)
    flat = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[at]))]
    return pa.Array.from_buffers(pa.large_binary(), len(starts), flat)


def _pieces(text: bytes) -> Iterator[bytes]:
    """A text in stretches, cut where no term is."""
    at = 0
    while at < len(text):
        end = at + STRETCH
        if end < len(text):
            gaps = np.flatnonzero(OTHER[LOWER[np.frombuffer(text, np.uint8, offset=end)]])
            end = end + int(gaps[0]) if len(gaps) else len(text)
        yield text[at:end]
        at = end


def _counted(texts: list[bytes], wanted: np.ndarray | None) -> tuple[np.ndarray, list, pa.Array, np.ndarray, np.ndarray]:
    """Terms in each text; then text, term, slot and occurrences of the wanted ones."""
    data = LOWER[np.frombuffer(b"\n".join(texts), np.uint8)]
    begins = np.zeros(len(texts), np.int64)
    np.cumsum([len(t) + 1 for t in texts[:-1]], out=begins[1:])
    starts, ends, slots = _spans(data)
    row = np.searchsorted(begins, starts, side="right") - 1
    n = np.bincount(row, minlength=len(texts))
    if wanted is not None:
        hit = np.flatnonzero((wanted[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1)
        starts, ends, slots, row = starts[hit], ends[hit], slots[hit], row[hit]
    coded = _texts_at(data, starts, ends).dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.int64)
    size = max(1, len(coded.dictionary))
    pairs, first, times = np.unique(row * size + codes, return_index=True, return_counts=True)
    return n, pairs // size, coded.dictionary.take(pa.array(pairs % size)), slots[first], times


def _rows(texts: list[bytes], wanted: np.ndarray | None) -> dict[str, pa.Array]:
    """n, terms, times and slots of each text."""
    n, row, terms, slots, times = _counted(texts, wanted)
    offsets = pa.array(np.searchsorted(row, np.arange(len(texts) + 1)), pa.int32())
    lists = lambda v: pa.ListArray.from_arrays(offsets, v)
    return {
        "n": pa.array(n, pa.int64()),
        "terms": lists(terms.cast(pa.binary()).cast(pa.string())),
        "times": lists(pa.array(times, pa.int64())),
        "slots": lists(pa.array(slots, pa.int64())),
    }


def _one_row(text: bytes, wanted: np.ndarray | None) -> dict[str, pa.Array]:
    """The same of one text over a stretch, stretch by stretch."""
    n, times, slot = 0, {}, {}
    for piece in _pieces(text):
        own, _, terms, slots, counts = _counted([piece], wanted)
        n += int(own.sum())
        for t, s, c in zip(terms.to_pylist(), slots.tolist(), counts.tolist(), strict=True):
            times[t], slot[t] = times.get(t, 0) + c, s
    return {
        "n": pa.array([n], pa.int64()),
        "terms": pa.array([[t.decode() for t in times]], pa.list_(pa.string())),
        "times": pa.array([list(times.values())], pa.list_(pa.int64())),
        "slots": pa.array([[slot[t] for t in times]], pa.list_(pa.int64())),
    }


def _terms(shared=None):
    """(id, n, terms, times, slots) of each text; with a bitmap only of the terms it may hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = None
        if shared is not None:
            wanted = np.zeros(1 << (SLOT_BITS - 3), np.uint8)
            for at, bits in shared.value:
                wanted[at : at + len(bits)] = np.frombuffer(bits, np.uint8)
        for batch in batches:
            texts = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in batch.column("text")]
            ids, at = batch.column("id"), 0
            while at < len(texts):
                end, held = at, 0
                while end < len(texts) and (end == at or held + len(texts[end]) <= STRETCH):
                    held += len(texts[end])
                    end += 1
                found = _one_row(texts[at], wanted) if held > STRETCH else _rows(texts[at:end], wanted)
                yield pa.RecordBatch.from_pydict({"id": ids.slice(at, end - at), **found})
                at = end

    return run


def _kept_terms(df: DataFrame, name: str, label: str, shared=None) -> DataFrame:
    """A row number, the id, length and terms of each row, written once."""
    kind = df.schema[name].dataType.simpleString()
    slim = df.select(F.col(name).alias("id"), F.col("text").cast("string").alias("text"))
    found = slim.mapInArrow(
        _terms(shared), f"id {kind}, n long, terms array<string>, times array<long>, slots array<long>"
    )
    return stored(found.where("n > 0").withColumn("row", F.monotonically_increasing_id()), label)


def _bitmap(items: DataFrame) -> list[tuple[int, bytes]]:
    """Place and bytes of the parts of the bitmap of item terms; 2^SLOT_BITS bits at most."""
    slot = items.select(F.explode("slots").alias("slot")).select((F.col("slot") + 1).alias("slot"))
    parts = slot.groupBy(F.bitmap_bucket_number("slot").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")
    )
    return [((r.part - 1) * 4096, bytes(r.bits)) for r in parts.collect()]


class Shard:
    """The impact lists of the documents of one shard."""

    def __init__(self, docs: pa.Table) -> None:
        docs = docs.sort_by([("id", "ascending")]).combine_chunks()
        self.ids = docs.column("id")
        terms = docs.column("terms").combine_chunks()
        terms = terms.chunk(0) if isinstance(terms, pa.ChunkedArray) else terms
        coded = terms.flatten().dictionary_encode()
        code = coded.indices.to_numpy().astype(np.int64)
        sizes = terms.value_lengths().to_numpy(zero_copy_only=False)
        doc = np.repeat(np.arange(len(self.ids)), sizes)
        times = _flat(docs.column("times"))
        m = np.repeat(docs.column("m").to_numpy(), sizes)
        impact = 1_000_000_000 * times // (1_000 * times + 12 * m)
        self.term = {t: i for i, t in enumerate(coded.dictionary.to_pylist())}
        order = np.lexsort((doc, -impact, code))
        self.doc, self.impact = doc[order], impact[order]
        self.bounds = np.searchsorted(code[order], np.arange(len(self.term) + 1))
        # by document, for direct accesses: where it stands in the list by impact
        self.place = np.lexsort((self.doc, code[order]))
        self.by_doc = self.doc[self.place]

    def best(self, terms: list[str], weights: list[int], k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the first ``k`` places for weighted terms."""
        lists = [(self.term[t], w) for t, w in zip(terms, weights, strict=True) if w > 0 and t in self.term]
        spans = [(int(self.bounds[t]), int(self.bounds[t + 1])) for t, _ in lists]
        marked = [np.zeros(b - a, bool) for a, b in spans]
        position = [0] * len(lists)
        score = np.zeros(len(self.ids), np.int64)
        seen = np.zeros(len(self.ids), bool)
        met = np.zeros(0, np.int64)
        read = FIRST_READ
        while any(p < b - a for p, (a, b) in zip(position, spans, strict=True)):
            ahead = [self.doc[a + p : min(a + p + read, b)] for p, (a, b) in zip(position, spans, strict=True)]
            new = np.unique(np.concatenate(ahead))
            new = new[~seen[new]]
            seen[new] = True
            bound = 0
            for i, ((_, weight), (a, b)) in enumerate(zip(lists, spans, strict=True)):
                own = self.by_doc[a:b]
                at = np.minimum(np.searchsorted(own, new), b - a - 1)
                hit = own[at] == new
                place = self.place[a + at[hit]]
                score[new[hit]] += weight * self.impact[place]
                marked[i][place - a] = True
                rest = marked[i][position[i] :]
                if len(rest):
                    gap = int(rest.argmin())
                    position[i] += len(rest) if rest[gap] else gap
                if position[i] < b - a:
                    bound += weight * int(self.impact[a + position[i]])
            met = self._first(np.concatenate((met, new)), score, k)
            if len(met) == k and bound < score[met[-1]]:
                break
            read *= 2
        return met, score[met]

    @staticmethod
    def _first(docs: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
        docs = docs[score[docs] > 0]
        if len(docs) > 4 * k:
            least = np.partition(score[docs], len(docs) - k)[len(docs) - k]
            docs = docs[score[docs] >= least]
        return docs[np.lexsort((docs, -score[docs]))][:k]


def _flat(column: pa.ChunkedArray) -> np.ndarray:
    parts = [c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _search(k: int):
    def run(docs: pa.Table, items: pa.Table) -> pa.Table:
        rows, ids, scores = [], [], []
        if docs.num_rows and items.num_rows:
            shard = Shard(docs)
            for row, terms, weights in zip(
                *(items.column(c).to_pylist() for c in ("row", "terms", "weights")), strict=True
            ):
                met, score = shard.best(terms, weights, k)
                rows.append(np.full(len(met), row, np.int64))
                ids.append(met)
                scores.append(score)
        none = np.zeros(0, np.int64)
        found = docs.sort_by([("id", "ascending")]).column("id").take(pa.array(np.concatenate([none, *ids])))
        return pa.table(
            {
                "row": pa.array(np.concatenate([none, *rows])),
                "doc_id": found,
                "score": pa.array(np.concatenate([none, *scores])),
            }
        )

    return run


def search(docs: DataFrame, items: DataFrame, k: int = 20, name: str = "doc_id", item: str = "item_id") -> DataFrame:
    """The ``k`` documents of highest score above 0 for each item: item_id, rank, doc_id, score.

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII, with
    only A-Z folded. Equal scores rank by ascending id, rows without an id last. Every
    row is a document of its own, and every row of ``items`` an item of its own, also
    if ids repeat. Null and empty texts have no terms: such documents are not counted,
    such items get no rows. Empty tables give no rows. Texts of any length are read
    whole. Only ids and texts are read, whatever other columns there are.
    """
    spark = docs.sparkSession
    asked = _kept_terms(items, item, "items")
    shared = spark.sparkContext.broadcast(_bitmap(asked))
    found = _kept_terms(docs, name, "terms", shared)
    n_docs, length = found.agg(F.count("*"), F.sum("n")).first()
    n_docs, length = n_docs or 1, length or 1
    n_items = asked.count()

    wanted = asked.select("row", "id", F.inline(F.arrays_zip("terms", "times"))).withColumnsRenamed(
        {"terms": "term"}
    )
    df = found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    rare = F.lit(2 * n_docs + 2).cast("double") / (2 * F.col("df") + 1).cast("double")
    weight = F.floor(1000 * F.log(rare)).cast("long") * F.col("times")
    weighed = wanted.join(df, "term").select("row", "term", weight.alias("weight"))
    lists = weighed.groupBy("row").agg(F.collect_list(F.struct("term", "weight")).alias("own"))

    shards, blocks = -(-n_docs // SHARD_DOCS), max(1, -(-n_items // BLOCK_ITEMS))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    block = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    put = (
        lists.select("row", F.col("own.term").alias("terms"), F.col("own.weight").alias("weights"))
        .withColumn("block", block)
        .withColumn("shard", every(shards))
    )
    m = F.expr(f"CAST(75 + (CAST(25 AS DECIMAL(3,0)) * n * {n_docs}) div {length} AS BIGINT)")
    shard = F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")
    dealt = found.select("id", m.alias("m"), "terms", "times", shard.alias("shard")).withColumn(
        "block", every(blocks)
    )
    kind = found.schema["id"].dataType.simpleString()
    best = (
        dealt.groupBy("shard", "block")
        .cogroup(put.groupBy("shard", "block"))
        .applyInArrow(_search(k), f"row long, doc_id {kind}, score long")
    )
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = asked.select("row", F.col("id").alias("item_id"))
    return ranked.join(names, "row").select("item_id", "rank", "doc_id", "score")
