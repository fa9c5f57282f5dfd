"""Token ids in files of independent zstandard frames with a trailing seek table.

A file holds, in this order:

* data frames, each a complete zstandard frame with the ids of whole documents as
  little-endian unsigned integers of 2 or 4 bytes;
* a skippable frame with the document index: id and number of ids of each document;
* the seek table of the public seekable format (a skippable frame too): compressed
  size, size and checksum (low 32 bits of XXH64) of each data frame, and a footer.

Any zstandard tool can decompress a whole file; a reader that wants some documents
reads the two tables at the end and decompresses only the frames that hold them.

Tasks write files of their own names and report them. Only reported files count,
so a task that is run twice leaves at most an unused file.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetide.llm.store import fresh_path, open_folder, stored

FRAME_BYTES = 1 << 18
CACHED_UNITS = 350_000
#: Characters of texts that are gathered at once.
STRETCH = 1 << 22
_SKIP_INDEX, _SKIP_SEEK, _SEEK_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
_INDEX = struct.Struct("<4sBxxxQ")
_ENTRY = np.dtype([("packed", "<u4"), ("size", "<u4"), ("check", "<u4")])
_FOOTER = struct.Struct("<IBI")

# --- encoding ----------------------------------------------------------------------

#: A space before text always begins a pre-token, if no space run is involved.
_SPACE_RUN = re.compile(r" (?=\s)")
_BETWEEN = re.compile(r"(?<=\S)(?= \S)")


class Encoder:
    """Ids of whole texts, with a bounded memory of units that were met before.

    A text is cut at spaces between two other characters that are no space. The
    tokenizer's own cuts always include these, so the units' ids joined are the
    text's ids. Texts with a special token's string go to the tokenizer whole.
    """

    def __init__(self, path: str, end_id: int) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if max(size, end_id + 1) <= 1 << 16 else "<u4")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.end = self._pack([end_id])
        # Words by what follows their space: those met lately, and those met before that.
        self.lately: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        if self.tokenizer.normalizer is not None:
            raise ValueError("texts can be cut only where the tokenizer does not rewrite them")

        # tokens that begin with a space, as a byte-level vocabulary writes it
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.opens = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.opens[[i for t, i in vocabulary.items() if t.startswith("Ġ")]] = True

    def _pack(self, ids: list[int]) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def _encode(self, units: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(units, add_special_tokens=False)
        return [self._pack(e.ids) for e in found]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of words with a space before each, many words in one call.

        The tokenizer cuts at each of these spaces, and a token begins with a space only
        there, so such tokens part the words. Should they not be as many as the words,
        each is encoded by itself.
        """
        found: list[bytes] = []
        blocks = [words[at : at + 512] for at in range(0, len(words), 512)]
        whole = ["".join([" " + w for w in b]) for b in blocks]
        for block, text, own in zip(blocks, whole, self.tokenizer.encode_batch_fast(whole, add_special_tokens=False), strict=True):
            ids = np.array(own.ids, np.int64)
            plain = len(ids) and ids.max() < len(self.opens) and not any(s in text for s in self.special)
            starts = np.flatnonzero(self.opens[ids]) if plain else ids[:0]
            if len(starts) != len(block) or starts[0]:
                found += self._encode([" " + w for w in block])
                continue
            data, width = ids.astype(self.dtype).tobytes(), self.dtype.itemsize
            ends = [*(starts * width).tolist(), len(data)]
            found += [data[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        return found

    def _units(self, wanted: list[str]) -> list[bytes]:
        """Ids of distinct units, each with a space before it; those met lately are remembered."""
        if len(self.lately) > CACHED_UNITS:
            self.before, self.lately = self.lately, {}
        lately, before = self.lately, self.before
        found = list(map(lately.get, wanted))
        missed = [i for i, ids in enumerate(found) if ids is None]
        new = []
        for i in missed:
            if (ids := before.get(wanted[i])) is not None:
                lately[wanted[i]] = ids
            else:
                new.append(wanted[i])
        odd = [u for u in new if not u or " " in u]
        lately.update(zip(odd, self._encode([" " + u for u in odd]), strict=True))
        words = [u for u in new if u and " " not in u] if odd else new
        lately.update(zip(words, self._encode_words(words), strict=True))
        for i in missed:
            found[i] = lately[wanted[i]]
        return found

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text and the end id, as bytes."""
        found: list[bytes] = [b""] * len(texts)
        plain: list[int] = []
        size = 0
        for at, text in enumerate(texts):
            text = text or ""
            if any(s in text for s in self.special):
                found[at] = self._encode([text])[0] + self.end
            elif _SPACE_RUN.search(text):
                head, *rest = _BETWEEN.split(text)
                rest = [u[1:] for u in rest]
                ids = dict(zip(wanted := list(set(rest)), self._units(wanted), strict=True))
                found[at] = self._encode([head])[0] + b"".join(map(ids.__getitem__, rest)) + self.end
            else:
                plain.append(at)
                size += len(text)
                if size > STRETCH:
                    self._encode_plain(texts, plain, found)
                    plain, size = [], 0
        if plain:
            self._encode_plain(texts, plain, found)
        return found

    def _encode_plain(self, texts: list[str | None], plain: list[int], found: list[bytes]) -> None:
        """Texts that are cut at every space: each distinct unit is looked up once, ids are gathered by number."""
        lists = pc.split_pattern(pa.array([texts[i] or "" for i in plain], pa.large_string()), " ")
        coded = lists.flatten().dictionary_encode()
        codes = coded.indices.to_numpy().astype(np.int64)
        offsets = lists.offsets.to_numpy()
        offsets = offsets - offsets[0]
        words = coded.dictionary.to_numpy(zero_copy_only=False)
        heads = words[codes[offsets[:-1]]].tolist()
        inner = np.ones(len(codes), bool)
        inner[offsets[:-1]] = False
        # codes are dense: those that occur are counted, not sorted
        there = np.bincount(codes[inner], minlength=len(coded.dictionary)) > 0
        used, numbers = np.flatnonzero(there), (np.cumsum(there) - 1)[codes[inner]]
        units = self._units(words[used].tolist())
        # units, then the head of every text, then the end id
        parts = [*units, *self._encode(heads), self.end]
        sizes = np.array([len(p) for p in parts], np.int64) // self.dtype.itemsize
        starts = np.cumsum(sizes) - sizes
        ids = np.frombuffer(b"".join(parts), self.dtype)
        n = len(plain)
        row = np.repeat(np.arange(n), np.diff(offsets))
        order = np.full(len(codes) + n, len(parts) - 1)  # an end id after every text
        place = np.arange(len(codes)) + row
        order[place[inner]] = numbers
        order[place[~inner]] = len(units) + np.arange(n)
        taken = sizes[order]
        ends = np.cumsum(taken)
        at = np.repeat(starts[order] - (ends - taken), taken) + np.arange(ends[-1])
        data = ids[at].tobytes()
        bounds = [0, *(ends[offsets[1:] + np.arange(n)] * self.dtype.itemsize).tolist()]
        for i, a, b in zip(plain, bounds[:-1], bounds[1:], strict=True):
            found[i] = data[a:b]


_encoders: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, end_id: int) -> Encoder:
    if (path, end_id) not in _encoders:
        _encoders[path, end_id] = Encoder(path, end_id)
    return _encoders[path, end_id]


# --- the format ----------------------------------------------------------------------


def write_file(out, docs: Iterable[tuple[int | None, bytes]], width: int, frame_bytes: int) -> tuple[int, int]:
    """Write the documents' packed ids; the numbers of documents and of ids."""
    packer = zstandard.ZstdCompressor(level=3, write_content_size=True)
    names, counts, entries, held, size = [], [], [], [], 0

    def flush() -> None:
        nonlocal held, size
        if size:
            raw = b"".join(held)
            packed = packer.compress(raw)
            out.write(packed)
            entries.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        held, size = [], 0

    for name, ids in docs:
        names.append(name)
        counts.append(len(ids) // width)
        held.append(ids)
        size += len(ids)
        if size >= frame_bytes:
            flush()
    flush()
    index = b"".join(
        (
            _INDEX.pack(b"TKF1", width, len(names)),
            np.array([n or 0 for n in names], "<i8").tobytes(),
            np.array([n is not None for n in names], "u1").tobytes(),
            np.array(counts, "<i8").tobytes(),
        )
    )
    index += struct.pack("<I", zlib.crc32(index))
    out.write(struct.pack("<II", _SKIP_INDEX, len(index)) + index)
    table = np.array(entries, _ENTRY).tobytes()
    out.write(struct.pack("<II", _SKIP_SEEK, len(table) + _FOOTER.size) + table)
    out.write(_FOOTER.pack(len(entries), 0x80, _SEEK_MAGIC))
    return len(names), sum(counts)


class TokenFile:
    """A file opened for reading single documents."""

    def __init__(self, source) -> None:
        self.source = source
        end = source.size()
        frames, flags, magic = _FOOTER.unpack(self._at(end - _FOOTER.size, _FOOTER.size))
        if magic != _SEEK_MAGIC or not flags & 0x80:
            raise ValueError("no seek table with checksums at the end of the file")
        table = end - _FOOTER.size - frames * _ENTRY.itemsize
        self.entries = np.frombuffer(self._at(table, frames * _ENTRY.itemsize), _ENTRY)
        self.frame_at = np.concatenate(([0], np.cumsum(self.entries["packed"], dtype=np.int64)))
        self.raw_at = np.concatenate(([0], np.cumsum(self.entries["size"], dtype=np.int64))).tolist()
        at = int(self.frame_at[-1])
        magic, length = struct.unpack("<II", self._at(at, 8))
        index = self._at(at + 8, length)
        if magic != _SKIP_INDEX or zlib.crc32(index[:-4]) != struct.unpack("<I", index[-4:])[0]:
            raise ValueError("the document index is damaged")
        kind, self.width, n = _INDEX.unpack_from(index)
        if kind != b"TKF1":
            raise ValueError("unknown kind of document index")
        ids = np.frombuffer(index, "<i8", n, _INDEX.size).tolist()
        there = np.frombuffer(index, "u1", n, _INDEX.size + 8 * n).tolist()
        self.doc_ids = [i if t else None for i, t in zip(ids, there, strict=True)]
        self.counts = np.frombuffer(index, "<i8", n, _INDEX.size + 9 * n)
        self.starts = np.concatenate(([0], np.cumsum(self.counts)))
        self.frames_read = 0
        self._frame, self._raw = -1, b""

    def _at(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def ids(self, k: int) -> np.ndarray:
        """The ids of the k-th document; documents have at least one id and lie in one frame."""
        if not self.counts[k]:
            return np.zeros(0, f"<u{self.width}")
        at = int(self.starts[k]) * self.width
        frame = bisect_right(self.raw_at, at) - 1
        if frame != self._frame:
            start, entry = int(self.frame_at[frame]), self.entries[frame]
            raw = zstandard.ZstdDecompressor().decompress(self._at(start, int(entry["packed"])))
            if len(raw) != entry["size"] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != entry["check"]:
                raise ValueError(f"frame {frame} does not match its checksum")
            self._frame, self._raw, self.frames_read = frame, raw, self.frames_read + 1
        return np.frombuffer(self._raw, f"<u{self.width}", int(self.counts[k]), at - self.raw_at[frame])


# --- jobs ------------------------------------------------------------------------------

MANIFEST = "part int, path string, n_docs long, n_tokens long"


def write(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, frame_bytes: int = FRAME_BYTES
) -> DataFrame:
    """Encode all texts and write them in ascending id order; the manifest, one row per file.

    A null text is an empty one: its ids are the end id alone. Null ids come first.
    Rows with equal ids stand side by side in an order that is not defined.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(tokenizer, end_id)
        part = TaskContext.get().partitionId()

        def rows():
            for batch in batches:
                for at in range(0, batch.num_rows, 1000):
                    piece = batch.slice(at, 1000)
                    yield from zip(
                        piece.column(0).to_pylist(), code.encode(piece.column(1).to_pylist()), strict=True
                    )

        it = rows()
        first = next(it, None)
        if first is None:
            return
        system, path = open_folder(folder)
        system.create_dir(path, recursive=True)
        name = f"{path}/{part:06d}-{uuid.uuid4().hex}.ids.zst"
        with system.open_output_stream(name, compression=None) as out:
            n, total = write_file(out, _chain(first, it), code.dtype.itemsize, frame_bytes)
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array([part], pa.int32()), "path": [name], "n_docs": [n], "n_tokens": [total]}
        )

    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    in_order = slim.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    return stored(in_order.mapInArrow(run, MANIFEST), "token-manifest")


def _chain(first, rest):
    yield first
    yield from rest


def read(spark: SparkSession, manifest: DataFrame, folder: str, each: Callable, schema: str) -> DataFrame:
    """Apply ``each(file, ids before the file)``, which yields record batches, to every file.

    The driver holds the manifest: a row for each file, not for each document.
    """
    files, before = [], 0
    for row in manifest.orderBy("part").collect():
        files.append((row.path, before))
        before += row.n_tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = open_folder(folder)
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with system.open_input_file(path) as source:
                    yield from each(TokenFile(source), start)

    listed = spark.createDataFrame(files, "path string, before long")
    return listed.repartition(max(1, len(files))).mapInArrow(run, schema)


def _digest(file: TokenFile, before: int) -> Iterator[pa.RecordBatch]:
    n = len(file.doc_ids)
    crc = [zlib.crc32(file.ids(k).astype("<u4").tobytes()) for k in range(n)]
    yield pa.RecordBatch.from_pydict(
        {
            "doc_id": pa.array(file.doc_ids, pa.int64()),
            "start": pa.array(before + file.starts[:-1], pa.int64()),
            "n_tokens": pa.array(file.counts, pa.int64()),
            "ids_crc32": pa.array(crc, pa.int64()),
        }
    )


def digest(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """What the files hold: per document its place, number of ids and their CRC-32."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return read(spark, manifest, folder, _digest, schema)


def lookup(spark: SparkSession, manifest: DataFrame, folder: str, wanted: Iterable[int]) -> DataFrame:
    """The ids of some documents, decompressing only the frames that hold them."""
    wanted = frozenset(wanted)

    def pick(file: TokenFile, _: int) -> Iterator[pa.RecordBatch]:
        at = [k for k, name in enumerate(file.doc_ids) if name in wanted]
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": pa.array([file.doc_ids[k] for k in at], pa.int64()),
                "ids": pa.array([file.ids(k).astype(np.int64) for k in at], pa.list_(pa.int64())),
            }
        )

    return read(spark, manifest, folder, pick, "doc_id long, ids array<long>")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 2, folder: str | None = None) -> DataFrame:
    """Write the files and report what reading them back gives. No documents, no files, no rows."""
    spark = docs.sparkSession
    folder = folder or fresh_path(spark, "tokens")
    return digest(spark, write(docs, folder, tokenizer, end_id), folder)
