"""Words of whole texts as byte spans and 64-bit hashes, computed with numpy.

Two word rules occur: runs of non-whitespace, and runs of letters and digits
(every byte from 0x80 counts as a letter). Both fold A-Z only, so they can work
on UTF-8 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BYTES = np.arange(256)
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
SPACE = (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13))
#: Bytes that part words of letters and digits, after A-Z are folded.
OTHER = (_BYTES < 48) | ((_BYTES > 57) & (_BYTES < 97)) | ((_BYTES > 122) & (_BYTES < 128))
#: The same as a translation: folds A-Z, turns everything that parts words into a space.
FOLD_ALNUM = bytes(32 if OTHER[LOWER[b]] else int(LOWER[b]) for b in range(256))

_DRAW = np.random.Generator(np.random.PCG64(20011201))
_CODE = _DRAW.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_LINKS = _DRAW.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Longest stretch that is hashed at once; longer texts are cut between words.
STRETCH = 1 << 22
#: Bytes of text that a task takes out of a batch at once; a longer text is taken alone.
PIECE = 1 << 20
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = PIECE) -> Iterator[pa.RecordBatch]:
    """All rows in their order, in slices of about ``most`` bytes of text.

    A batch of Spark is 10,000 rows however long their texts are. What is made of it at once, a worker keeps
    as long as it lives, and an executor has several workers.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text).cast(pa.binary())), 0).to_numpy(zero_copy_only=False)
        turn = np.cumsum(sizes, dtype=np.int64) // most
        for a, b in pairwise([0, *(np.flatnonzero(np.diff(turn)) + 1).tolist(), batch.num_rows]):
            yield batch.slice(a, b - a)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit value over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers_to(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums that give the hash of any stretch of at most STRETCH bytes."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_CODE[data] * _powers_to(len(data) + 1)[0][: len(data)], out=total[1:])
    return total


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    inverse = _powers_to(len(sums))[1]
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def rolling(sums: np.ndarray, at: int, n: int, width: int) -> np.ndarray:
    """Unmixed hashes of the stretches of ``width`` bytes at ``n`` places from ``at``."""
    inverse = _powers_to(len(sums))[1]
    return (sums[at + width : at + width + n] - sums[at : at + n]) * inverse[at : at + n]


def spans(data: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.zeros(len(data) + 2, np.int8)
    edges[1:-1] = ~parts[data]
    step = np.diff(edges)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def word_hashes(text: bytes, parts: np.ndarray = SPACE) -> np.ndarray:
    """One hash for each word of the text, in order."""
    data = LOWER[np.frombuffer(text, np.uint8)]
    found, at = [], 0
    while at < len(data):
        piece = data[at : at + STRETCH]
        if at + STRETCH < len(data):
            gaps = np.flatnonzero(parts[piece])
            if len(gaps):
                piece = piece[: gaps[-1] + 1]
            else:  # one word of over STRETCH bytes: up to its end
                more = np.flatnonzero(parts[data[at:]])
                piece = data[at : at + (more[0] if len(more) else len(data) - at)]
        found.append(span_hashes(prefix_sums(piece), *spans(piece, parts)))
        at += len(piece)
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def shingle_set(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``width`` words.

    Fewer words make one shingle of the whole sequence; no words make none.
    """
    if not len(words):
        return words
    n = max(1, len(words) - width + 1)
    k = min(width, len(words))
    sums = np.full(n, np.uint64(k))
    for i in range(k):
        sums = sums + words[i : i + n] * _LINKS[i]
    return np.unique(mix(sums))
