"""Token counts that follow edits without encoding texts again.

A document is kept as its pre-tokens (lengths and token counts). Runs of pre-tokens
are blocks, the leaves of a segment tree of characters and tokens. An edit finds its
block by the character sums, cuts a window that begins at the last pre-token the edit
cannot reach and ends where old and new pre-token boundaries meet again, encodes the
new pre-tokens of that window only, and updates the sums above the block.

A pre-token depends on its own characters and the two that follow (the look-ahead of
white space and the longest contraction), which is the boundary context.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 64
CONTEXT = 2
CACHED = 250_000
#: Fixed value: how byte-level vocabularies of this family cut text into pre-tokens.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
cut = regex.compile(PATTERN).findall

Edit = tuple[int, int, str]


class Counter:
    """Tokens of pre-tokens, remembering those met lately. Special tokens' strings are ordinary text."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.lately: dict[str, int] = {}
        self.before: dict[str, int] = {}

    def learn(self, pieces: Iterable[str]) -> None:
        if len(self.lately) > CACHED:
            self.before, self.lately = self.lately, {}
        new = set(pieces)
        new.difference_update(self.lately)
        known = {p: self.before[p] for p in new if p in self.before}
        self.lately |= known
        rest = list(new.difference(known))
        found = self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)
        self.lately.update((p, len(e.ids)) for p, e in zip(rest, found, strict=True))

    def __call__(self, pieces: list[str]) -> list[int]:
        """Counts of a few pieces, without turning the memory over."""
        new = [p for p in pieces if p not in self.lately]
        if new:
            found = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
            self.lately.update((p, len(e.ids)) for p, e in zip(new, found, strict=True))
        return list(map(self.lately.__getitem__, pieces))


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


class Tree:
    """Segment tree over blocks of pre-tokens: sums of characters and of tokens."""

    def __init__(self, text: str, lengths: np.ndarray, counts: np.ndarray) -> None:
        self._build(text, np.asarray(lengths, np.int64), np.asarray(counts, np.int64))
        self.encoded = 0

    def _build(self, text: str, lengths: np.ndarray, counts: np.ndarray) -> None:
        starts = np.arange(0, max(len(lengths), 1), BLOCK)
        n = len(starts)
        self.capacity = 1 << (n - 1).bit_length()
        self.chars = np.zeros(2 * self.capacity, np.int64)
        self.tokens = np.zeros(2 * self.capacity, np.int64)
        self.blocks: list[tuple[str, list[int], list[int]]] = []
        at = 0
        for i, a in enumerate(starts.tolist()):
            own, num = lengths[a : a + BLOCK], counts[a : a + BLOCK]
            size = int(own.sum())
            self.blocks.append((text[at : at + size], own.tolist(), num.tolist()))
            self.chars[self.capacity + i], self.tokens[self.capacity + i] = size, num.sum()
            at += size
        for i in range(self.capacity - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @property
    def total(self) -> int:
        return int(self.tokens[1])

    @property
    def text(self) -> str:
        return "".join(b[0] for b in self.blocks)

    def leaves(self) -> tuple[list[int], list[int]]:
        return [n for b in self.blocks for n in b[1]], [n for b in self.blocks for n in b[2]]

    def _locate(self, at: int) -> tuple[int, int]:
        """The block that holds the character, and the characters before the block."""
        i, before = 1, 0
        while i < self.capacity:
            i *= 2
            if at >= before + self.chars[i] and self.chars[i + 1]:
                before += int(self.chars[i])
                i += 1
        return i - self.capacity, before

    def _put(self, block: int, content: tuple[str, list[int], list[int]]) -> None:
        self.blocks[block] = content
        i = block + self.capacity
        self.chars[i], self.tokens[i] = len(content[0]), sum(content[2])
        while i > 1:
            i //= 2
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def edit(self, start: int, end: int, new: str, count: Callable[[list[str]], list[int]]) -> None:
        """Replace the characters from ``start`` to ``end`` of the present text."""
        size = int(self.chars[1])
        start = min(max(start, 0), size)
        end = min(max(end, start), size)
        low, base = self._locate(start)
        while low and (not self.blocks[low][1] or base + self.blocks[low][1][0] + CONTEXT > start):
            low -= 1
            base -= len(self.blocks[low][0])
        high, _ = self._locate(end)
        high = max(high, low)
        while True:
            text = "".join(b[0] for b in self.blocks[low : high + 1])
            lengths = [n for b in self.blocks[low : high + 1] for n in b[1]]
            counts = [n for b in self.blocks[low : high + 1] for n in b[2]]
            ends = np.cumsum(lengths, dtype=np.int64)
            a, b = start - base, end - base
            kept = int(np.searchsorted(ends, a - CONTEXT, "right"))
            at = int(ends[kept - 1]) if kept else 0
            tail = text[at:a] + new + text[b:]
            pieces = cut(tail)
            whole = high + 1 == len(self.blocks)
            shift = len(new) - (b - a)
            old_ends = {int(e): k for k, e in enumerate(ends)}
            stop, reached, resume = None, 0, len(lengths)
            for k, piece in enumerate(pieces):
                reached += len(piece)
                was = at + reached - shift
                if was >= b and was in old_ends and (whole or reached + CONTEXT <= len(tail)):
                    stop, resume = k + 1, old_ends[was] + 1
                    break
            if stop is not None or whole:
                break
            high += 1
        pieces = pieces[:stop]
        self.encoded += len(pieces)
        lengths = lengths[:kept] + [len(p) for p in pieces] + lengths[resume:]
        counts = counts[:kept] + count(pieces) + counts[resume:]
        self._put(low, (text[:at] + tail, lengths, counts))
        for k in range(low + 1, high + 1):
            if self.blocks[k][1]:
                self._put(k, ("", [], []))
        if len(lengths) > 8 * BLOCK:
            self._build(self.text, *map(np.array, self.leaves()))


# --- jobs ------------------------------------------------------------------------------


def build(docs: DataFrame, tokenizer: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, text, lengths, counts, kept columns): the pre-tokens of every whole text.

    A null text counts as an empty one: no pre-tokens, no tokens.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                piece = batch.slice(at, 1000)
                cuts = [cut(t) if t else [] for t in piece.column("text").to_pylist()]
                count.learn(p for c in cuts for p in c)
                get = count.lately.__getitem__
                sizes = [np.fromiter(map(len, c), "<u4", len(c)).tobytes() for c in cuts]
                counts = [np.fromiter(map(get, c), "<u4", len(c)).tobytes() for c in cuts]
                columns = [piece.column(c) for c in ("doc_id", "text", *keep)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(sizes, pa.binary()), pa.array(counts, pa.binary())],
                    ["doc_id", "text", *keep, "lengths", "counts"],
                )

    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields)
    return slim.mapInArrow(run, schema + ", lengths binary, counts binary")


EDITS = "array<struct<start: int, end: int, new: string>>"


def update(trees: DataFrame, tokenizer: str, edits: str = "edits") -> DataFrame:
    """Apply each row's edits (start, end, new text; positions of the text before all of them).

    Edits must not overlap; they are applied from the last to the first. Null or no
    edits leave the counts as they were. Returns doc_id, n_before, n_edits, n_tokens,
    n_pretokens, n_encoded (pre-tokens that were encoded for the edits), and the new
    text, lengths and counts.
    """
    schema = (
        "doc_id long, n_before long, n_edits long, n_tokens long, n_pretokens long, n_encoded long, "
        "text string, lengths binary, counts binary"
    )
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [pa.int64()] * 6 + [pa.string(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer)
        for batch in batches:
            rows = []
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "text", "lengths", "counts", edits)]
            for name, text, sizes, counts, own in zip(*columns, strict=True):
                before = np.frombuffer(counts, "<u4")
                n = int(before.sum())
                if not own:
                    rows.append((name, n, 0, n, len(before), 0, text, sizes, counts))
                    continue
                tree = Tree(text or "", np.frombuffer(sizes, "<u4"), before)
                for e in sorted(own, key=lambda e: (e["start"], e["end"]), reverse=True):
                    tree.edit(e["start"], e["end"], e["new"] or "", count)
                size, num = (np.array(x, "<u4") for x in tree.leaves())
                rows.append(
                    (name, n, len(own), tree.total, len(num), tree.encoded, tree.text, size.tobytes(), num.tobytes())
                )
            made = zip(*rows, strict=True) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(made, kinds, strict=True)], names)

    return trees.select("doc_id", "text", "lengths", "counts", edits).mapInArrow(run, schema)


_DOMAIN = regex.compile(r"[\w-]+(?:\.[\w-]+)+")
_NUMBER = regex.compile(r"(?<![\d.])(\d{1,3}(?:\.\d{1,3}){3})(?![\d.])|\+?\d[\d ()-]{7,}\d")


def redaction_edits(text: str | None) -> list[Edit]:
    """Edits that put [mail], [address] and [number] for personal data of these kinds."""
    found: list[Edit] = []
    at, done = (text or "").find("@"), 0
    while at >= 0:
        a = at
        while a > done and (text[a - 1].isalnum() or text[a - 1] in "_.+-"):
            a -= 1
        m = _DOMAIN.match(text, at + 1)
        if m and a < at:
            done = m.end()
            found.append((a, done, "[mail]"))
        at = text.find("@", max(done, at + 1))
    mails = [e[:2] for e in found]
    for m in _NUMBER.finditer(text or ""):
        a, b = m.span()
        k = bisect_left(mails, (b, b))  # mails do not overlap: the last before b decides
        if not k or mails[k - 1][1] <= a:
            found.append((a, b, "[address]" if m[1] else "[number]"))
    return sorted(found)


def with_redactions(docs: DataFrame) -> DataFrame:
    """Add ``edits``: mail addresses, network addresses and long numbers of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("new", pa.string())]))
        for batch in batches:
            found = [
                [{"start": a, "end": b, "new": new} for a, b, new in redaction_edits(t)]
                for t in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text"), pa.array(found, kind)], ["doc_id", "text", "edits"]
            )

    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return slim.mapInArrow(run, f"doc_id long, text string, edits {EDITS}")


def counts_after_redaction(docs: DataFrame, tokenizer: str, together: int = 250) -> DataFrame:
    """Token counts of every document before and after its redactions.

    The same as ``build``, ``with_redactions`` and ``update`` in one pass, so that
    neither texts nor trees travel between Python workers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, together):
                piece, rows = batch.slice(at, together), []
                texts = [t or "" for t in piece.column("text").to_pylist()]
                cuts = [cut(t) for t in texts]
                count.learn(p for c in cuts for p in c)
                get = count.lately.__getitem__
                for text, own in zip(texts, cuts, strict=True):
                    tokens = list(map(get, own))
                    edits = redaction_edits(text)
                    before = sum(tokens)
                    if not edits:
                        rows.append((before, 0, before, len(own), 0))
                        continue
                    tree = Tree(text, np.fromiter(map(len, own), np.int64, len(own)), np.array(tokens))
                    for a, b, new in reversed(edits):
                        tree.edit(a, b, new, count)
                    rows.append((before, len(edits), tree.total, len(tree.leaves()[0]), tree.encoded))
                columns = zip(*rows, strict=True) if rows else [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns)],
                    ["doc_id", "n_before", "n_edits", "n_tokens", "n_pretokens", "n_encoded"],
                )

    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return slim.mapInArrow(
        run, "doc_id long, n_before long, n_edits long, n_tokens long, n_pretokens long, n_encoded long"
    )
