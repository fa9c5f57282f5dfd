"""Benchmark decontamination with a generalised suffix automaton.

The automaton holds every run of words of every benchmark item. Training texts
are streamed through it word by word; at each word it knows the longest run
ending there that occurs in some item. Runs of ``window`` words, or of a whole
item that is shorter, are hits.

The items travel to the tasks in blocks of a checked number of words
(``block_words``), so the broadcast does not grow with the benchmark; more blocks
mean more passes over what the last one wrote.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricetide.llm.store import stored
from pricetide.llm.words import FOLD_ALNUM, pieces

WINDOW = 13
BLOCK_WORDS = 1_000_000


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(FOLD_ALNUM).split() if text else []


class Automaton:
    """Generalised suffix automaton over word numbers, with the hits each state stands for."""

    def __init__(self, items: list[list[bytes]], window: int) -> None:
        self.window = window
        self.number: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        ends: list[list[int]] = []
        for words in items:
            state, path = 0, []
            for w in words:
                state = self._extend(state, self.number.setdefault(w, len(self.number)))
                path.append(state)
            ends.append(path)
        self.least = min((min(len(x), window) for x in items if x), default=0)
        self._mark(items, ends)

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._split(last, c, q)
        new = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, c, q)
        return new

    def _split(self, p: int, c: int, q: int) -> int:
        clone = len(self.next)
        self.next.append(dict(self.next[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _mark(self, items: list[list[bytes]], ends: list[list[int]]) -> None:
        """For each state: the (run length, items) of the windows that end there."""
        window, link, length = self.window, self.link, self.length
        of_window: dict[int, set[int]] = {}
        short: dict[int, list[tuple[int, int]]] = {}
        for k, path in enumerate(ends):
            if 0 < len(path) < window:
                short.setdefault(self._at_length(path[-1], len(path)), []).append((len(path), k))
            for state in path[window - 1 :]:
                of_window.setdefault(self._at_length(state, window), set()).add(k)
        hits: list[tuple[tuple[int, frozenset[int]], ...]] = [()] * len(link)
        for state in sorted(range(1, len(link)), key=length.__getitem__):
            own = list(hits[link[state]])
            if state in of_window:
                own.append((window, frozenset(of_window[state])))
            for n in sorted({n for n, _ in short.get(state, ())}):
                own.append((n, frozenset(k for m, k in short[state] if m == n)))
            hits[state] = tuple(own)
        self.hits = hits
        self.first_hit = [min((n for n, _ in h), default=1 << 60) for h in hits]

    def _at_length(self, state: int, n: int) -> int:
        """The state of the last ``n`` words of the state's runs."""
        while self.length[self.link[state]] >= n:
            state = self.link[state]
        return state

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Hit stretches of the text as (start, end) and the items whose windows occur."""
        if len(words) < self.least or not self.least:
            return [], set()
        get = self.number.get
        ids = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        edges = np.flatnonzero(np.diff(np.concatenate(([False], ids >= 0, [False])).view(np.int8)))
        stretches, found = [], set()
        nxt, link, length, first = self.next, self.link, self.length, self.first_hit
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if b - a < self.least:
                continue
            state = matched = 0
            for i, c in enumerate(ids[a:b].tolist(), a + 1):
                to = nxt[state].get(c)
                while to is None:  # the word is known, so the root has it
                    state = link[state]
                    matched = length[state]
                    to = nxt[state].get(c)
                state = to
                matched += 1
                if matched >= first[state]:
                    for n, items in self.hits[state]:
                        if n <= matched:
                            stretches.append((i - n, i))
                            found |= items
        return stretches, found


_built: dict[str, Automaton] = {}


def _automaton(key: str, items: list[list[bytes]], window: int) -> Automaton:
    if key not in _built:
        _built.clear()
        _built[key] = Automaton(items, window)
    return _built[key]


def joined(stretches: list[tuple[int, int]]) -> list[list[int]]:
    merged: list[list[int]] = []
    for a, b in sorted(stretches):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(b, merged[-1][1])
        else:
            merged.append([a, b])
    return merged


_FOUND = pa.struct([("spans", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))])
_SPARK_FOUND = "struct<spans: array<bigint>, items: array<string>>"
MARKS = "__marks"


def _marker(items, names, key: str, window: int, text: str, marks: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _automaton(key, items.value, window)
        for batch in pieces(batches, text):
            texts = batch.column(text).cast(pa.binary()).to_pylist()
            before = batch.column(marks).to_pylist()
            made = []
            for words, old in zip(map(words_of, texts), before, strict=True):
                hits, which = machine.scan(words)
                if old:
                    hits += zip(old["spans"][::2], old["spans"][1::2], strict=True)
                made.append(
                    {
                        "spans": list(chain.from_iterable(joined(hits))),
                        "items": [names.value[k] for k in which] + (old["items"] if old else []),
                    }
                )
            at = batch.schema.get_field_index(marks)
            yield batch.set_column(at, pa.field(marks, _FOUND), pa.array(made, _FOUND))

    return run


def _passes(
    docs: DataFrame, benchmark: DataFrame, window: int, block_words: int, text: str, marks: str
) -> tuple[DataFrame, Callable]:
    """The documents marked with all blocks of items but the last, and the marker of that one."""
    spark = docs.sparkSession
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
        F.col("text").cast("binary").alias("text"),
        F.ceil(F.octet_length("text") / 2).alias("size"),  # no fewer than its words
    ).where("size > 0")
    total = items.agg(F.sum("size")).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    marked = docs.withColumn(marks, F.lit(None).cast(_SPARK_FOUND))
    for k in range(blocks):
        rows = items.where(block == k).select("item_id", "text").collect()
        sent = spark.sparkContext.broadcast([words_of(bytes(r.text)) for r in rows])
        names = spark.sparkContext.broadcast([r.item_id for r in rows])
        run = _marker(sent, names, os.urandom(8).hex(), window, text, marks)
        if k + 1 < blocks:
            marked = stored(marked.mapInArrow(run, marked.schema), "marks")
    return marked, run


def mark(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
    text: str = "text",
    marks: str = MARKS,
) -> DataFrame:
    """Add ``__marks``: hit stretches in words (start, end, start, ...) and the ids of the items.

    Null and empty texts have no words and no hits. Items without words have no
    windows. Item rows with equal id and text count as often as they occur. A null
    item id counts as the empty text.
    """
    marked, last = _passes(docs, benchmark, window, block_words, text, marks)
    return marked.mapInArrow(last, marked.schema)


def verdict(words: int, spans: list[int], share: int = 20) -> tuple[int, bool]:
    """Hit words, and whether they are at least one in ``share``."""
    hit = sum(spans[1::2]) - sum(spans[::2])
    return hit, hit > 0 and share * hit >= words


_DIGEST = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_hit", pa.int64()),
        ("n_items", pa.int64()),
        ("items_sha256", pa.string()),
        ("contaminated", pa.bool_()),
    ]
)


def report(marked: DataFrame, text: str = "text") -> DataFrame:
    """One row per document: its words, hit words, items, and whether it is contaminated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            texts = batch.column(text).cast(pa.binary()).to_pylist()
            rows = []
            for i, t, m in zip(
                batch.column("doc_id").to_pylist(), texts, batch.column(MARKS).to_pylist(), strict=True
            ):
                words = len(words_of(t))
                hit, bad = verdict(words, m["spans"])
                names = ",".join(sorted(m["items"])).encode()
                digest = hashlib.sha256(names).hexdigest()
                rows.append((i, words, hit, len(m["items"]), digest, bad))
            columns = zip(*rows, strict=True) if rows else [[]] * len(_DIGEST)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _DIGEST, strict=True)], schema=_DIGEST
            )

    slim = marked.select(F.col("doc_id").cast("long"), text, MARKS)
    return slim.mapInArrow(
        run,
        "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean",
    )


_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def cut(text: bytes, spans: list[int]) -> bytes:
    """The text without the words of the spans and what stands between them."""
    at = [m.span() for m in _WORD.finditer(text.lower() if text.isascii() else _fold(text))]
    kept, end = [], 0
    for a, b in zip(spans[::2], spans[1::2], strict=True):
        kept.append(text[end : at[a][0]])
        end = at[b - 1][1]
    return b"".join([*kept, text[end:]])


def _fold(text: bytes) -> bytes:
    return text.translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256)))


def remove(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    share: int = 20,
    spans_only: bool = False,
    block_words: int = BLOCK_WORDS,
    text: str = "text",
) -> DataFrame:
    """Clean documents, with the columns they had.

    By default contaminated documents go and all others stay as they are. With
    ``spans_only`` every document stays and loses its hit stretches instead.
    """
    name = MARKS
    while name in docs.columns:
        name += "_"
    marked, last = _passes(docs, benchmark, window, block_words, text, name)

    # marked and judged in one step: a step of its own would take one more Python worker for each core
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in last(batches):
            raw = batch.column(text)
            texts, marks = raw.cast(pa.binary()).to_pylist(), batch.column(name).to_pylist()
            at = batch.schema.get_field_index(text)
            names = [n for n in batch.schema.names if n != name]
            if spans_only:
                new = [cut(t, m["spans"]) if m["spans"] else t for t, m in zip(texts, marks, strict=True)]
                batch = batch.set_column(at, batch.schema.field(at), pa.array(new, pa.binary()).cast(raw.type))
            else:
                bad = [
                    bool(m["spans"]) and verdict(len(words_of(t)), m["spans"], share)[1]
                    for t, m in zip(texts, marks, strict=True)
                ]
                batch = batch.filter(pa.array([not x for x in bad], pa.bool_()))
            yield batch.select(names)

    return marked.mapInArrow(run, docs.schema)
