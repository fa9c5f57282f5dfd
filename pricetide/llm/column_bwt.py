"""Repeated byte strings across documents, by column-wise suffix construction.

A byte is removed if it lies in a string of ``length`` bytes that also starts
anywhere else. Three steps find these strings:

* Anchors. Of every window of ``length`` bytes the gram with the least hash is an
  anchor, so equal windows have equal grams at the same place. An anchor's fragment
  is what all windows with that gram can reach. Grams that occur once are dropped.
* Equal fragments repeat as a whole. They are counted, not compared.
* Different fragments around one gram are laid side by side, aligned at the gram, and
  their suffixes are built column by column from the right: every round inserts one
  symbol per fragment, which reorders the last suffixes stably by that symbol (the
  step of the collection's Burrows-Wheeler transform) and updates the common prefixes
  of neighbours. Columns lie in a temporary file that is read once, in sequence.
  A suffix with a neighbour of ``length`` common symbols starts a repeated string.

Whole-corpus construction, one column of all documents a round, would rewrite the
transform as often as the longest document has bytes; the anchors bound the columns.
Grams with more than ``GROUP`` different fragments are not put into one task: their
windows are cut into ranges, told apart by hashes of what all windows of a range
share, and only what is left is compared window by window, as counts.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricetide.llm.store import stored
from pricetide.llm.words import mix, prefix_sums, rolling, span_hashes

LENGTH = 200
GRAM = 64
GROUP = 256
#: Fragments that are built at once.
TOGETHER = 16_384
#: Windows of a range for large groups.
RANGE = 17
_STRETCH = 1 << 19
_PLACE = np.uint64((1 << 20) - 1)


def sliding_min(keys: np.ndarray, width: int) -> np.ndarray:
    n = len(keys) - width + 1
    padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    rows = padded.reshape(-1, width)
    left = np.minimum.accumulate(rows, axis=1).ravel()
    right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1 : width - 1 + n])


def anchors(text: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions, gram hashes and fragment hashes of the anchors of a text."""
    data = np.frombuffer(text, np.uint8)
    reach, n = length - gram, len(data)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for at in range(0, n - length + 1, _STRETCH):
        windows = min(_STRETCH, n - length + 1 - at)
        low, high = max(0, at - reach), min(n, at + windows + reach + length)
        sums = prefix_sums(data[low:high])
        raw = rolling(sums, at - low, windows + reach, gram)
        keys = (raw & ~_PLACE) | np.arange(len(raw), dtype=np.uint64)
        places = np.unique(sliding_min(keys, reach + 1) & _PLACE).astype(np.int64)
        pos = places + at
        begin, end = np.maximum(pos - reach, 0), np.minimum(pos + length, n)
        whole = span_hashes(sums, begin - low, end - low)
        grams = mix(raw[places] + np.uint64(gram))
        found.append((pos, grams, mix(whole + (pos - begin).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))))
    if not found:
        none = np.zeros(0, np.uint64)
        return none.astype(np.int64), none, none
    pos, grams, whole = (np.concatenate(x) for x in zip(*found, strict=True))
    pos, first = np.unique(pos, return_index=True)
    return pos, grams[first], whole[first]


def column_repeats(
    group: np.ndarray, fragments: list[bytes], lefts: np.ndarray, length: int = LENGTH, gram: int = GRAM
) -> tuple[np.ndarray, np.ndarray]:
    """For each fragment the first and last window start, from its gram, of a repeated string.

    ``group`` numbers the grams and ascends; ``lefts`` are the bytes before the gram.
    Fragments without a repeated string get a first start of 1.
    """
    n, reach = len(fragments), length - gram
    sizes = np.array([len(f) for f in fragments])
    first, last = np.ones(n, np.int64), np.full(n, -reach - 1, np.int64)
    with tempfile.TemporaryFile() as columns:
        # Column-major: the rightmost column comes first, absent symbols are 0 and told by the sizes.
        width = reach + length
        for at in range(0, width, 64):
            block = np.zeros((min(64, width - at), n), np.uint8)
            for i, f in enumerate(fragments):
                # columns at .. at + 63 counted from the right end of a full fragment
                hi = int(lefts[i]) + length - at
                part = np.frombuffer(f, np.uint8)[max(0, hi - len(block)) : max(0, min(hi, len(f)))][::-1]
                skip = max(0, hi - len(f))
                block[skip : skip + len(part), i] = part
            columns.write(block.tobytes())
        columns.seek(0)
        order, common = np.arange(n), np.zeros(n + 1, np.int64)
        rights = sizes - lefts
        for c in range(length - 1, -reach - 1, -1):
            symbols = np.frombuffer(columns.read(n), np.uint8)
            there = (c < rights) & (c >= -lefts)
            key = group * 257 + np.where(there, symbols.astype(np.int64) + 1, 0)
            new = np.argsort(key[order], kind="stable")
            # new[k] is the place in the old order of the k-th suffix of the new one
            order = order[new]
            a, b = new[:-1], new[1:]
            same = (key[order[1:]] == key[order[:-1]]) & there[order[1:]]
            grown = np.zeros(n + 1, np.int64)
            if same.any():
                a, b = a[same], b[same]
                ranges = np.column_stack((a + 1, b + 1)).ravel()
                least = np.minimum.reduceat(common, ranges)[::2]
                grown[1:n][same] = np.minimum(least + 1, length)
            common = grown
            if c <= 0:
                full = common >= length
                hit = order[full[:n] | full[1:]]
                first[hit] = c
                last[hit] = np.maximum(last[hit], c)
    return first, last


# --- jobs ----------------------------------------------------------------------------------


def _rows(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text): ``row`` tells documents apart; equal rows share it, which changes nothing."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc = F.col("doc_id").cast("long")
    return docs.select(F.xxhash64(doc, text).alias("row"), doc.alias("doc_id"), text.alias("text"))


def _anchor_table(rows: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def gathered() -> Iterator[pa.RecordBatch]:
            names, pos, grams, whole = (np.concatenate(x) for x in zip(*held, strict=True))
            for at in range(0, len(pos), 50_000):
                own = slice(at, at + 50_000)
                yield pa.RecordBatch.from_pydict(
                    {
                        "gram": grams[own].view(np.int64),
                        "whole": whole[own].view(np.int64),
                        "row": names[own],
                        "pos": pos[own].astype(np.int32),
                    }
                )

        for batch in batches:
            names = batch.column("row").to_pylist()
            for name, text in zip(names, batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                pos, grams, whole = anchors(text, length, gram)
                held.append((np.full(len(pos), name, np.int64), pos, grams, whole))
                size += len(pos)
                if size >= 50_000:
                    yield from gathered()
                    held.clear()
                    size = 0
        if held:
            yield from gathered()

    long = rows.where(F.octet_length("text") >= length).select("row", "text")
    return long.mapInArrow(run, "gram long, whole long, row long, pos int")


def _fragments(rows: DataFrame, wanted: DataFrame, length: int, gram: int) -> DataFrame:
    """(gram, large, row, pos, left, bytes) of the wanted anchors."""
    reach = length - gram
    kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def gathered() -> pa.RecordBatch:
            columns = [pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(columns, ["gram", "large", "row", "pos", "left", "bytes"])

        for batch in batches:
            names = batch.column("row").to_pylist()
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for name, text, places in zip(names, texts, batch.column("places").to_pylist(), strict=True):
                for p in places:
                    pos = p["pos"]
                    begin = max(0, pos - reach)
                    held.append((p["gram"], p["large"], name, pos, pos - begin, text[begin : pos + length]))
                if len(held) >= 10_000:
                    yield gathered()
                    held.clear()
        if held:
            yield gathered()

    places = wanted.groupBy("row").agg(F.collect_list(F.struct("gram", "large", "pos")).alias("places"))
    schema = "gram long, large boolean, row long, pos int, left int, bytes binary"
    return rows.select("row", "text").join(places, "row").mapInArrow(run, schema)


_HITS = "row long, start long, end long"


def _small_groups(fragments: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def build() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held)
            key = table.column("gram").to_numpy()
            group = np.concatenate(([0], np.cumsum(key[1:] != key[:-1])))
            lefts = table.column("left").to_numpy().astype(np.int64)
            first, last = column_repeats(group, table.column("bytes").to_pylist(), lefts, length, gram)
            hit = np.flatnonzero(first <= 0)
            pos = table.column("pos").to_numpy().astype(np.int64)
            yield pa.RecordBatch.from_pydict(
                {
                    "row": table.column("row").to_numpy()[hit],
                    "start": pos[hit] + first[hit],
                    "end": pos[hit] + last[hit] + length,
                }
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            if size >= TOGETHER:
                # The groups before the last one are complete, and so is the last if another begins.
                keys = np.concatenate([b.column("gram").to_numpy() for b in held])
                start = len(keys) - 1 if len(keys) else 0
                while start and keys[start - 1] == keys[-1]:
                    start -= 1
                if start:
                    table = pa.Table.from_batches(held)
                    held = table.slice(0, start).to_batches()
                    yield from build()
                    held = table.slice(start).to_batches()
                    size = len(keys) - start
            held.append(batch)
            size += batch.num_rows
        if held:
            yield from build()

    small = fragments.where(~F.col("large")).drop("large")
    return small.repartition("gram").sortWithinPartitions("gram", "row", "pos").mapInArrow(run, _HITS)


def _large_groups(fragments: DataFrame, length: int, gram: int) -> DataFrame:
    """The same for grams with many fragments, by counts of hashes alone.

    All windows of a range share a core. Ranges with equal cores and equal bytes
    repeat as a whole; those with equal cores and different bytes are compared by
    single windows.
    """
    reach = length - gram
    spans_ = [(a, min(a + RANGE - 1, 0)) for a in range(-reach, 1, RANGE)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            columns = [batch.column(c).to_pylist() for c in ("gram", "row", "pos", "left", "bytes")]
            for key, row, pos, left, own in zip(*columns, strict=True):
                sums = prefix_sums(np.frombuffer(own, np.uint8))
                starts = np.arange(0, len(own) - length + 1)
                hashes = span_hashes(sums, starts, starts + length)
                for k, (low, high) in enumerate(spans_):
                    # the windows of the range that the fragment has
                    a, b = max(low, -left), min(high, len(own) - length - left)
                    if a > b:
                        continue
                    core = span_hashes(sums, np.array([high + left]), np.array([low + left + length]))
                    mine = hashes[a + left : b + left + 1]
                    inner = mix(np.uint64(key & (2**64 - 1)) + core + np.uint64(k) * np.uint64(0x9E3779B97F4A7C15))
                    whole = mix(mine * np.arange(1, 2 * len(mine), 2, dtype=np.uint64)).sum()
                    rows.append((int(inner.view(np.int64)[0]), int(whole.view(np.int64)), row, pos, a, mine.view(np.int64)))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                ["core", "whole", "row", "pos", "first", "windows"],
            )

    # Places are counted from the gram, so one window of one text never meets itself
    # where the text has the gram twice.
    schema = "core long, whole long, row long, pos long, first long, windows array<long>"
    ranges = stored(fragments.where("large").mapInArrow(run, schema), "ranges")
    one = F.min(F.struct("row", "pos")).alias("one")
    key = ["core", "first", "whole"]
    whole = ranges.groupBy(*key).agg(F.count("*").alias("n"), one)
    equal = ranges.join(whole.where("n > 1").select(*key), key, "left_semi")
    begin = F.col("pos") + F.col("first")
    sure = equal.select("row", begin.alias("start"), (begin + F.size("windows") - 1 + length).alias("end"))
    different = whole.groupBy("core").agg(F.count("*").alias("k")).where("k > 1").select("core")
    single = whole.join(different, "core", "left_semi").select(*key, "one.row", "one.pos")
    left = ranges.join(single, [*key, "row", "pos"], "left_semi")
    windows = left.select("core", "row", "pos", "first", F.posexplode("windows").alias("k", "window"))
    windows = windows.select("core", "row", "pos", (F.col("first") + F.col("k")).alias("at"), "window")
    place = ["core", "at", "window"]
    repeated = windows.groupBy(*place).agg(F.count("*").alias("n")).where("n > 1").select(*place)
    start = F.col("pos") + F.col("at")
    hits = windows.join(repeated, place, "left_semi")
    return sure.unionByName(hits.select("row", start.alias("start"), (start + length).alias("end")))


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(row, start, end): stretches of bytes that are removed, overlapping and unordered."""
    rows = _rows(docs)
    reach = length - gram
    grams = _anchor_table(rows, length, gram).groupBy("gram").agg(F.count("*").alias("n")).where("n > 1")
    again = _anchor_table(rows, length, gram).join(grams.select("gram"), "gram", "left_semi")
    again = stored(again, "anchors")
    whole = again.groupBy("gram", "whole").agg(F.count("*").alias("n"), F.min(F.struct("row", "pos")).alias("one"))
    whole = stored(whole, "fragments")
    equal = again.join(whole.where("n > 1").select("gram", "whole"), ["gram", "whole"], "left_semi")
    # The end may lie beyond the text; it is cut to it later.
    begin = F.greatest(F.col("pos") - reach, F.lit(0))
    sure = equal.select("row", begin.cast("long").alias("start"), (F.col("pos") + length).cast("long").alias("end"))
    different = whole.groupBy("gram").agg(F.count("*").alias("k")).where("k > 1")
    wanted = whole.join(different, "gram").select(
        "gram", (F.col("k") > GROUP).alias("large"), F.col("one.row").alias("row"), F.col("one.pos").alias("pos")
    )
    fragments = stored(_fragments(rows, wanted, length, gram), "fragment-bytes")
    return sure.unionByName(_small_groups(fragments, length, gram)).unionByName(
        _large_groups(fragments, length, gram)
    )


def joined_spans(starts: list[int], ends: list[int], size: int) -> list[tuple[int, int]]:
    merged: list[list[int]] = []
    for a, b in sorted(zip(starts, ends, strict=True)):
        b = min(b, size)
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(b, merged[-1][1])
        elif a < b:
            merged.append([a, b])
    return [(a, b) for a, b in merged]


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, with_text: bool = False) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and with ``with_text`` the kept bytes.

    A null text is an empty one. Texts shorter than ``length`` lose nothing. Of
    repeated rows all lose what they repeat.
    """
    found = repeated_spans(docs, length, gram)
    spans_ = found.groupBy("row").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    joined = _rows(docs).join(spans_, "row", "left").select("doc_id", "text", "spans")
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text
    kinds = [pa.int64()] * 4 + [pa.string()] + [pa.binary()] * with_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for name, text, own in zip(
                batch.column("doc_id").to_pylist(), texts, batch.column("spans").to_pylist(), strict=True
            ):
                own = own or []
                gone = joined_spans([s["start"] for s in own], [s["end"] for s in own], len(text))
                edges = [0, *(x for s in gone for x in s), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                row = (name, len(text), len(text) - len(kept), len(gone), hashlib.sha256(kept).hexdigest())
                out.append((*row, kept) if with_text else row)
            columns = zip(*out, strict=True) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return joined.mapInArrow(run, schema + ", kept binary" * with_text)
