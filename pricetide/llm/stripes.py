"""Phrase collocations by the stripes pattern.

A stripe is the counter of the words that follow one prefix: every prefix of up to
three words keys a stripe, and stripes of the same prefix are merged entry by entry.
An entry is the count of a phrase one word longer, so the count of a prefix stands in
the stripe of the prefix without its last word, down to the empty prefix, whose stripe
counts all words. The largest entry of a stripe says whether a longer phrase swallows the
prefix. All numbers of a phrase are read from stripes.

Two passes over the texts:

1. Counting into slots. Runs of one to four words are hashed into a fixed number of
   slots, and the occurrences of each slot are added up. A run in a slot below the
   least count is rare for certain. What is kept is one bit per slot, of bounded
   size. A run that shares its slot is merely looked at in vain.
2. Stripes. Words are numbered by their bytes, not by hashes, within each stretch of
   text, so entries are exact; only runs whose slot passes become entries. A stripe is
   sent in segments by the hash of the next word, so the stripe of a very common word
   is merged in many tasks; a row holds many segments.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricetide.llm.nn_descent import whole_groups
from pricetide.llm.store import stored
from pricetide.llm.words import LOWER, mix, prefix_sums, span_hashes

LONGEST = 4
#: Bits of a slot number: 2^27 slots of each length, 16 MiB of bits each. More slots only
#: let fewer rare runs through to the second pass.
SLOT_BITS = 27
_LOW_BITS = 19  # slots of one merge group: 512 Ki counters
#: Segments of a stripe, by the words of its prefix; the empty one is dealt word by word.
SEGMENTS = (1 << 32, 8, 1, 1)
#: Parts that the segments of a language are dealt into. A task sends one row a part, and the
#: merged entries of one part are held by one task.
PARTS = 4_096
#: Bytes of text that are worked on at once; a text is cut only where a piece ends.
STRETCH = 1 << 22
#: Entries, and words, that a task holds to merge those of its stretches before they are sent.
HELD, KNOWN = 3_000_000, 1_000_000
UNKNOWN_LANG = "und"

_BREAK = np.zeros(256, bool)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_GAP = _BREAK.copy()
_GAP[list(b" \t")] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Words:
    """The words of a stretch: number, whether each is joined to the one before, and hashes."""

    def __init__(self, texts: list[bytes], langs: list[str]) -> None:
        data = LOWER[np.frombuffer(b"\n".join(texts), np.uint8)]
        inside = ~_GAP[data]
        edge = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        piece = np.cumsum(_BREAK[data], dtype=np.int32)[starts]
        self.joined = np.zeros(len(starts), bool)
        self.joined[1:] = piece[1:] == piece[:-1]
        offsets = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(ends - starts, out=offsets[1:])
        flat = pa.Array.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])]
        ).dictionary_encode()
        self.texts = flat.dictionary
        self.names = sorted(set(langs))
        place = {x: i for i, x in enumerate(self.names)}
        of_text = np.array([place[x] for x in langs], np.int64)
        begins = np.zeros(len(texts), np.int64)
        np.cumsum([len(t) + 1 for t in texts[:-1]], out=begins[1:])
        lang = of_text[np.searchsorted(begins, starts, side="right") - 1]
        # a word of two languages is two words from here on
        self.number = lang * max(1, len(self.texts)) + flat.indices.to_numpy().astype(np.int64)
        self.lang = lang
        _, bounds, letters = self.texts.buffers()
        bounds = np.frombuffer(bounds, np.int64)[self.texts.offset : self.texts.offset + len(self.texts) + 1]
        sums = prefix_sums(np.frombuffer(letters, np.uint8) if bounds[-1] else np.zeros(0, np.uint8))
        hashes = span_hashes(sums, bounds[:-1], bounds[1:])
        seeds = np.array([xxhash.xxh64_intdigest(x.encode()) for x in self.names], np.uint64)
        self.hashes = mix(np.add.outer(seeds, hashes).ravel())

    def lang_of(self, number: np.ndarray) -> np.ndarray:
        return number // max(1, len(self.texts))

    def runs(self, k: int) -> np.ndarray:
        """The places where a run of ``k`` words of one piece starts."""
        n = len(self.number) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        ok = np.ones(n, bool)
        for i in range(1, k):
            ok &= self.joined[i : i + n]
        return np.flatnonzero(ok)

    def run_hashes(self, places: np.ndarray, k: int) -> np.ndarray:
        h = np.full(len(places), np.uint64(k))
        for i in range(k):
            h = mix(h * _STEP + self.hashes[self.number[places + i]])
        return h

    def slots(self, places: np.ndarray, k: int) -> np.ndarray:
        return (self.run_hashes(places, k) >> np.uint64(64 - SLOT_BITS)).astype(np.uint32)


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    texts: list[bytes] = []
    langs: list[str] = []
    held = 0
    for batch in batches:
        for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist(), strict=True):
            own = text.as_buffer().to_pybytes() if text.is_valid else b""
            at = 0
            while at < len(own):
                end = at + STRETCH - held
                if end < len(own):  # up to the next end of a piece
                    found = np.flatnonzero(_BREAK[np.frombuffer(own, np.uint8, offset=end)])
                    end = end + int(found[0]) + 1 if len(found) else len(own)
                texts.append(own[at:end])
                langs.append(UNKNOWN_LANG if lang is None else lang)
                held += min(end, len(own)) - at
                at = end
                if held >= STRETCH:
                    yield Words(texts, langs)
                    texts, langs, held = [], [], 0
    if texts:
        yield Words(texts, langs)


def _slot_counts(least: int):
    """(k, part, low, n): how often each slot is met in a stretch, packed by parts of the slots."""
    edges = np.arange((1 << (SLOT_BITS - _LOW_BITS)) + 1, dtype=np.int64) << _LOW_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in _stretches(batches):
            for k in range(1, LONGEST + 1):
                slots, n = np.unique(words.slots(words.runs(k), k), return_counts=True)
                if not len(slots):
                    continue
                bounds = np.searchsorted(slots, edges)
                low = (slots & np.uint32((1 << _LOW_BITS) - 1)).astype(np.int64)
                n = np.minimum(n, least).astype(_counter(least))
                parts = np.flatnonzero(np.diff(bounds))
                cut = [(bounds[p], bounds[p + 1]) for p in parts.tolist()]
                yield pa.RecordBatch.from_pydict(
                    {
                        "k": pa.array([k] * len(parts), pa.int32()),
                        "part": pa.array(parts, pa.int32()),
                        "low": pa.array([_packed(low[a:b]) for a, b in cut], pa.binary()),
                        "n": pa.array([n[a:b].tobytes() for a, b in cut], pa.binary()),
                    }
                )

    return run


def _packed(rising: np.ndarray) -> bytes:
    """Steps between rising numbers, all first bytes first: most others are zero and compress well."""
    return np.diff(rising, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4"), dtype=np.int64)


def _counter(least: int) -> str:
    """Type of a count that need not go beyond the least one."""
    return "<u1" if least < 1 << 8 else "<u4"


def _passing(least: int):
    """(k, part, bits): the slots that are met often enough; counters of one part at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, counters = None, np.zeros(0, np.int64)

        def done() -> Iterator[pa.RecordBatch]:
            often = counters >= least
            if now is not None and often.any():
                bits = zlib.compress(np.packbits(often, bitorder="little").tobytes(), 1)
                yield pa.RecordBatch.from_pydict(
                    {"k": pa.array([now[0]], pa.int32()), "part": pa.array([now[1]], pa.int32()), "bits": [bits]}
                )

        for batch in batches:
            for k, part, low, n in zip(*(batch.column(c).to_pylist() for c in ("k", "part", "low", "n")), strict=True):
                if (k, part) != now:
                    yield from done()
                    now, counters = (k, part), np.zeros(1 << _LOW_BITS, np.int64)
                at = _unpacked(low)
                # saturating: what has reached the least count stays there
                counters[at] = np.minimum(counters[at] + np.frombuffer(n, _counter(least)), least)
        yield from done()

    return run


def passing_slots(docs: DataFrame, least: int) -> dict[tuple[int, int], bytes]:
    """Bits of the slots that runs of ``least`` or more occurrences fall into, by (k, part).

    Bounded by ``LONGEST`` times 2^SLOT_BITS bits, whatever the input.
    """
    counted = docs.select("text", "lang").mapInArrow(_slot_counts(least), "k int, part int, low binary, n binary")
    dealt = counted.repartition("k", "part").sortWithinPartitions("k", "part")
    found = dealt.mapInArrow(_passing(least), "k int, part int, bits binary")
    return {(r.k, r.part): bytes(r.bits) for r in found.collect()}


_known_bits: dict[str, list[np.ndarray]] = {}


def _bits_of(name: str, packed: dict[tuple[int, int], bytes]) -> list[np.ndarray]:
    """The bits of each length, unpacked once in each worker."""
    if name not in _known_bits:
        width = 1 << (_LOW_BITS - 3)
        found = [np.zeros(1 << (SLOT_BITS - 3), np.uint8) for _ in range(LONGEST + 1)]
        for (k, part), bits in packed.items():
            found[k][part * width : (part + 1) * width] = np.frombuffer(zlib.decompress(bits), np.uint8)
        _known_bits.clear()
        _known_bits[name] = found
    return _known_bits[name]


def _stripes_of(shared, name: str):
    """Stripes of the texts of a task: (key, lang, stripes of (prefix, next, n)).

    In the stripe of the empty prefix, next '' counts the words without an entry.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = _bits_of(name, shared.value)
        held = Entries()
        for words in _stretches(batches):
            held.add(words, bits)
            if held.full():
                yield from held.stripes()
                held = Entries()
        yield from held.stripes()

    return run


class Entries:
    """Entries of the texts of a task: words by numbers of the task, prefix and follower, and counts."""

    def __init__(self) -> None:
        self.number: dict[tuple[str, bytes], int] = {}
        self.langs: list[str] = []
        self.hashes: list[np.ndarray] = []
        self.rows: list[tuple[np.ndarray, np.ndarray]] = []
        self.size, self.merged_size = 0, 0

    def full(self) -> bool:
        if self.size > 2 * max(self.merged_size, HELD // 4):
            self._merge()
        return self.size > HELD or len(self.number) > KNOWN

    def add(self, words: Words, bits: list[np.ndarray]) -> None:
        n_words = len(words.number)
        often = np.zeros((LONGEST + 2, n_words + LONGEST), bool)
        for k in range(1, LONGEST + 1):
            places = words.runs(k)
            if k > 1:
                places = places[often[k - 1, places] & often[k - 1, places + 1]]
            slots = words.slots(places, k)
            hit = (bits[k][slots >> np.uint32(3)] >> (slots & np.uint32(7)).astype(np.uint8)) & 1
            often[k, places[hit == 1]] = True
        known = often[1, :n_words]
        used, n = np.unique(words.number[known], return_counts=True)
        own = np.full(len(words.hashes) + 1, -1, np.int32)
        own[used] = self._numbers(words, used)
        self._put([own[used]], n)
        rest = np.bincount(words.lang[~known], minlength=len(words.names))
        for lang in np.flatnonzero(rest).tolist():
            self._put([self._number(words.names[lang], b"", np.uint64(0))], rest[lang : lang + 1])
        number = np.append(words.number, np.zeros(LONGEST, np.int64))
        size = len(words.hashes) + 1
        key = number.copy()
        for k in range(1, LONGEST):
            places = np.flatnonzero(often[k + 1, :n_words])
            if not len(places):
                break
            # prefixes of k words, numbered anew: exact, and small enough to be joined to a word
            if k > 1:
                key[places] = key[places] * size + number[places + k - 1]
            _, first, prefix = np.unique(key[places], return_index=True, return_inverse=True)
            pairs, n = np.unique(prefix * size + number[places + k], return_counts=True)
            of = places[first][pairs // size]
            self._put([*(own[number[of + i]] for i in range(k)), own[pairs % size]], n)
            key[places] = prefix

    def _number(self, lang: str, text: bytes, hashed: np.uint64) -> np.ndarray:
        at = self.number.setdefault((lang, text), len(self.number))
        if at == len(self.langs):
            self.langs.append(lang)
            self.hashes.append(np.array([hashed], np.uint64))
        return np.array([at], np.int32)

    def _numbers(self, words: Words, used: np.ndarray) -> np.ndarray:
        texts = words.texts.take(pa.array(used % max(1, len(words.texts)))).to_pylist()
        langs = [words.names[i] for i in words.lang_of(used).tolist()]
        before = len(self.number)
        found = [self.number.setdefault(pair, len(self.number)) for pair in zip(langs, texts, strict=True)]
        new = [i for i, at in enumerate(found) if at >= before]
        self.langs += [langs[i] for i in new]
        self.hashes.append(words.hashes[used[new]] if new else np.zeros(0, np.uint64))
        return np.array(found, np.int32)

    def _put(self, columns: list[np.ndarray], n: np.ndarray) -> None:
        rows = np.full((len(n), LONGEST), -1, np.int32)
        for i, c in enumerate(columns):
            rows[:, i] = c
        self.rows.append((rows, n.astype(np.int64)))
        self.size += len(n)

    def _merge(self) -> tuple[np.ndarray, np.ndarray]:
        rows, n = (np.concatenate(c) for c in zip(*self.rows, strict=True))
        pair = (rows.astype(np.int64) + 1).astype(np.uint64)
        pair = pair[:, 0::2] << np.uint64(32) | pair[:, 1::2]
        order = np.lexsort((pair[:, 1], pair[:, 0]))
        pair = pair[order]
        first = np.ones(len(order), bool)
        first[1:] = (pair[1:] != pair[:-1]).any(axis=1)
        starts = np.flatnonzero(first)
        rows, n = rows[order[starts]], np.add.reduceat(n[order], starts)
        self.rows = [(rows, n)]
        self.size = self.merged_size = len(n)
        return rows, n

    def stripes(self) -> Iterator[pa.RecordBatch]:
        """One row for each language and part."""
        if not self.size:
            return
        rows, n = self._merge()
        hashes = np.concatenate(self.hashes)
        texts = pa.array([t for _, t in self.number], pa.large_binary()).cast(pa.large_string())
        langs, lang_of = np.unique(np.array(self.langs, object).astype(str), return_inverse=True)
        k = (rows >= 0).sum(axis=1) - 1
        follower = rows[np.arange(len(rows)), k]
        prefix = rows.copy()
        prefix[np.arange(len(rows)), k] = -1
        drawn = k.astype(np.uint64)
        for i in range(LONGEST - 1):
            own = prefix[:, i] >= 0
            drawn[own] = mix(drawn[own] * _STEP + hashes[prefix[own, i]])
        segment = hashes[follower] % np.array(SEGMENTS, np.uint64)[k]
        part = (mix(drawn + segment * _STEP) % np.uint64(PARTS)).astype(np.int64)
        lang = lang_of[follower]
        order = np.lexsort((prefix[:, 2], prefix[:, 1], prefix[:, 0], part, lang))
        prefix, follower, n, part, lang = prefix[order], follower[order], n[order], part[order], lang[order]
        row = np.ones(len(order), bool)
        row[1:] = (lang[1:] != lang[:-1]) | (part[1:] != part[:-1])
        head = row.copy()
        head[1:] |= (prefix[1:] != prefix[:-1]).any(axis=1)
        row, head = np.flatnonzero(row), np.flatnonzero(head)
        ends = np.append(head, len(order))
        at = np.append(np.searchsorted(head, row), len(head))
        seeds = np.array([xxhash.xxh64_intdigest(x.encode()) for x in langs.tolist()], np.uint64)
        keys = (seeds[lang[row]] & np.uint64((1 << 62) - 1)).astype(np.int64) // PARTS * PARTS + part[row]
        for x in range(0, len(row), 1 << 12):
            y = min(x + (1 << 12), len(row))
            a, b = at[x], at[y]  # stripes of these rows
            c, d = ends[a], ends[b]  # and their entries
            lists = pa.array(ends[a : b + 1] - c, pa.int32())
            inner = pa.StructArray.from_arrays(
                [
                    self._text(texts, prefix[head[a:b]]),
                    pa.ListArray.from_arrays(lists, texts.take(pa.array(follower[c:d])).cast(pa.string())),
                    pa.ListArray.from_arrays(lists, pa.array(n[c:d])),
                ],
                ["prefix", "next", "n"],
            )
            yield pa.RecordBatch.from_pydict(
                {
                    "key": pa.array(keys[x:y]),
                    "lang": pa.array(langs[lang[row[x:y]]].tolist(), pa.string()),
                    "stripes": pa.ListArray.from_arrays(pa.array(at[x : y + 1] - a, pa.int32()), inner),
                }
            )

    @staticmethod
    def _text(texts: pa.Array, prefix: np.ndarray) -> pa.Array:
        """Prefixes as texts, words apart by a space; the empty one is an empty text."""
        out = np.full(len(prefix), "", object)
        for k in range(1, LONGEST):
            own = np.flatnonzero((prefix >= 0).sum(axis=1) == k)
            if len(own):
                columns = [texts.take(pa.array(prefix[own, i])) for i in range(k)]
                joined = pc.binary_join_element_wise(*columns, pa.scalar(" ", pa.large_string())) if k > 1 else columns[0]
                out[own] = joined.to_numpy(zero_copy_only=False)
        return pa.array(out, pa.string())


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, prefix, next, n): stripes of equal prefixes merged entry by entry, part by part."""
    for batch in whole_groups(batches, ("key",), 4_000):
        stripes_ = batch.column("stripes")
        inner = stripes_.flatten()
        prefix, following, n = (inner.field(c) for c in ("prefix", "next", "n"))
        of_row = np.repeat(np.arange(batch.num_rows), stripes_.value_lengths().to_numpy(zero_copy_only=False))
        sizes = following.value_lengths().to_numpy(zero_copy_only=False)
        of_stripe = pa.array(np.repeat(np.arange(len(sizes)), sizes))
        flat = pa.table(
            {
                "lang": batch.column("lang").take(pa.array(np.repeat(of_row, sizes))).dictionary_encode(),
                "prefix": prefix.take(of_stripe).cast(pa.large_string()),
                "next": following.flatten().cast(pa.large_string()),
                "n": n.flatten(),
            }
        )
        found = flat.group_by(["lang", "prefix", "next"], use_threads=False).aggregate([("n", "sum")])
        for piece in found.to_batches(max_chunksize=1 << 14):
            columns = [piece.column(c).cast(pa.string()) for c in ("lang", "prefix", "next")]
            yield pa.RecordBatch.from_arrays([*columns, piece.column("n_sum")], ["lang", "prefix", "next", "n"])


def stripes(docs: DataFrame, least: int = 30) -> DataFrame:
    """(lang, prefix, next, n): the merged entries of all stripes.

    Entries of ``least`` or more occurrences are there and exact. The entry '' of the
    empty prefix counts the words without an entry, so its stripe adds up to all words.
    """
    bits = passing_slots(docs, least)
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    schema = "key long, lang string, stripes array<struct<prefix: string, next: array<string>, n: array<long>>>"
    own = docs.select("text", "lang").mapInArrow(_stripes_of(shared, uuid.uuid4().hex), schema)
    dealt = own.repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(_merged, "lang string, prefix string, next string, n long")


def _words(phrase: str) -> Column:
    return F.split(phrase, " ", -1)


def _part(words: Column, start: int | Column, length: int | Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(
    docs: DataFrame, least: int = 30, scale: int = 2_000_000, swallow: tuple[int, int] = (80, 100), top: int = 2_000
) -> DataFrame:
    """Per language the ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    A phrase of 2 to 4 words occurs ``a`` >= ``least`` times. Of its cuts into a first
    part (``l`` occurrences) and a rest (``r``) the one with the least
    ``scale * a div (l + r)`` counts. A phrase goes if a phrase one word longer keeps
    80 % of its occurrences; a still longer one then does so through those between.

    Null text is empty, null language is ``und``. Every row of ``docs`` counts, repeated
    ones again, whatever its id. Empty texts and tables give no rows. Texts of any length are read
    whole, in stretches cut at ends of pieces. Ties end at the phrase in byte order.
    Only the columns text and lang are read.
    """
    entries = stored(stripes(docs, least), "stripes")
    texts = entries.where("prefix = ''").groupBy("lang").agg(F.sum("n").alias("words"))
    phrase = F.when(F.col("prefix") == "", F.col("next")).otherwise(F.concat_ws(" ", "prefix", "next"))
    often = entries.where((F.col("next") != "") & (F.col("n") >= least)).select(
        "lang", "prefix", phrase.alias("phrase"), F.col("n").alias("a")
    )
    often = stored(often.withColumn("w", _words("phrase")), "phrases")
    counts = often.where(F.size("w") < LONGEST).select("lang", F.col("phrase").alias("part"), F.col("a").alias("f"))
    phrases = often.where(F.size("w") > 1).drop("prefix")

    cuts = phrases.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
    parted = cuts.select(
        "lang", "phrase", "a", "k",
        _part(F.col("w"), 1, F.col("k")).alias("head"),
        _part(F.col("w"), F.col("k") + 1, F.size("w") - F.col("k")).alias("rest"),
    )
    left = parted.join(counts.withColumnsRenamed({"part": "head", "f": "l"}), ["lang", "head"])
    both = left.join(counts.withColumnsRenamed({"part": "rest", "f": "r"}), ["lang", "rest"])
    # decimals: the product may pass 64 bits
    score = F.expr(f"CAST({scale} AS DECIMAL(18,0)) * CAST(a AS DECIMAL(19,0)) div CAST(l + r AS DECIMAL(20,0))")
    scored = both.withColumn("score", score).groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )

    inner = phrases.where(F.size("w") > 2)
    before = inner.select("lang", _part(F.col("w"), 2, F.size("w") - 1).alias("phrase"), F.col("a").alias("longest"))
    after = often.where("prefix <> ''").groupBy("lang", F.col("prefix").alias("phrase")).agg(F.max("a").alias("longest"))
    longer = before.unionByName(after).groupBy("lang", "phrase").agg(F.max("longest").alias("longer"))
    few, of = swallow
    gone = F.lit(of).cast("decimal(18,0)") * F.col("longer") >= F.lit(few).cast("decimal(18,0)") * F.col("a")
    alive = scored.join(longer, ["lang", "phrase"], "left").where(~F.coalesce(gone, F.lit(False)))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase"))
    ranked = alive.withColumn("rank", rank.cast("long")).where(F.col("rank") <= top)
    return ranked.join(texts, "lang").select(
        "lang", "rank", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"),
        F.col("words").alias("n"), F.col("cut.score").alias("score"),
    )
