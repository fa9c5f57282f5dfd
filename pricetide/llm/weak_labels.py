"""Quality classifier from weak labels.

Heuristic labellers that overlap vote on a bounded sample of documents; expectation
maximisation estimates how often each is right, and the posterior of every document
trains a sparse linear scorer over hashed features. There are two questions, each
with its own labellers: is a text toxic, and is it junk (symbols, shouting,
repetition, tables). The scorer then reads every document whole.

The sample is the ``sample`` labelled documents that come first by a seeded hash
(all documents, if there are no labels). It is the only thing the driver holds, and
it is bounded by that parameter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricetide.llm.words import LOWER, OTHER, SPACE, mix, pieces, prefix_sums, span_hashes, spans, word_hashes

SAMPLE = 10_000
#: Insults that the word-list labeller looks for.
INSULTS = (
    "clown",
    "disgusting",
    "idiot",
    "loser",
    "moron",
    "pathetic",
    "scum",
    "stupid",
    "trash",
    "worthless",
)
SYMBOLS = b"#$%&*+<=>@[\\]^_`{|}~!"
#: Shares above which a heuristic votes for junk, in the order of ``shares``.
LIMITS = (0.05, 0.6, 0.2, 0.3, 0.15)
LEVELS = (0.0, 0.01, 0.03, 0.06, 0.1, 0.15, 0.2, 0.3, 0.45, 0.6, 0.8)

_IS_SYMBOL = np.isin(np.arange(256), np.frombuffer(SYMBOLS, np.uint8))
_IS_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_IS_LETTER = _IS_UPPER | ((np.arange(256) >= 97) & (np.arange(256) <= 122))
_IS_MARK = OTHER[LOWER] & ~SPACE


def hash_words(words: tuple[str, ...]) -> np.ndarray:
    return np.concatenate([word_hashes(w.encode(), OTHER) for w in words])


def shares(text: bytes) -> np.ndarray:
    """Shares of symbols, capitals, repeated words, words ending in two marks, words of marks only."""
    data = np.frombuffer(text, np.uint8)
    starts, ends = spans(data, SPACE)
    if not len(starts):
        return np.zeros(5)
    letters = np.count_nonzero(_IS_LETTER[data])
    marks = np.concatenate(([0], np.cumsum(_IS_MARK[data])))
    last = _IS_MARK[data[ends - 1]] & _IS_MARK[data[np.maximum(ends - 2, starts)]]
    words = word_hashes(text, SPACE)
    return np.array(
        [
            np.count_nonzero(_IS_SYMBOL[data]) / len(data),
            np.count_nonzero(_IS_UPPER[data]) / max(letters, 20),
            np.count_nonzero(words[1:] == words[:-1]) / max(len(words), 10),
            np.count_nonzero(last) / max(len(words), 5),
            np.count_nonzero(marks[ends] - marks[starts] == ends - starts) / max(len(words), 5),
        ]
    )


def features(text: bytes | None) -> np.ndarray:
    """Sorted hashes of the distinct words, and of the level that each share reaches."""
    if not text:
        return np.zeros(0, np.uint64)
    level = np.searchsorted(LEVELS, shares(text), "right")
    bins = mix(np.arange(5, dtype=np.uint64) * np.uint64(100) + level.astype(np.uint64))
    return np.unique(np.concatenate((word_hashes(text, OTHER), bins)))


def junk_votes(text: bytes | None) -> list[int]:
    return (shares(text or b"") > LIMITS).astype(int).tolist()


# --- label model -----------------------------------------------------------------------


def estimate(votes: np.ndarray, two_sided: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of yes per row, and each labeller's rates of 1 where the truth is yes and no.

    ``votes`` holds 1, 0, or -1 for silence. A one-sided labeller knows one kind of
    yes only, so its silence says nothing; a two-sided one also votes 0. Labellers
    are taken to err independently given the truth; priors keep rates off 0 and 1.
    """
    n, m = votes.shape
    asked, fired, denied = (votes >= 0) | ~two_sided, votes == 1, votes == 0
    hit, false = np.where(two_sided, 0.99, 0.7), np.where(two_sided, 0.01, 0.05)
    # Silence says nothing, so the rounds cannot tell the share of yes: it is that of the two-sided votes.
    share = (fired[:, two_sided].sum() + 1.0) / ((votes[:, two_sided] >= 0).sum() + 10.0)
    # Two-sided votes are trusted as if as many rows again had shown them right.
    prior, mean = np.where(two_sided, n + 5, 5), np.where(two_sided, 0.995, 0.7)
    posterior = np.full(n, share)
    for _ in range(rounds):
        gain = fired * np.log(hit / false) + denied * np.log((1 - hit) / (1 - false))
        odds = np.log(share / (1 - share)) + gain.sum(1)
        posterior = 1 / (1 + np.exp(-np.clip(odds, -60, 60)))
        p = posterior[:, None]
        hit = ((p * fired).sum(0) + prior * mean) / ((p * asked).sum(0) + prior)
        false = (((1 - p) * fired).sum(0) + 0.01 * prior) / (((1 - p) * asked).sum(0) + prior)
        hit, false = np.clip(hit, 1e-3, 1 - 1e-6), np.clip(false, np.where(two_sided, 1e-6, 0.01), 0.5)
    return posterior, hit, false


# --- scorer ------------------------------------------------------------------------------


@dataclass
class Scorer:
    """Weights of sorted hashed features for the questions (toxic, junk)."""

    keys: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def score(self, own: np.ndarray) -> np.ndarray:
        """Probabilities of toxic and junk for a text with these features."""
        at = np.searchsorted(self.keys, own)
        at = at[(at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] == own)]
        return 1 / (1 + np.exp(-(self.bias + self.weights[at].sum(0))))


def telling(rows: np.ndarray, columns: np.ndarray, width: int, posterior: np.ndarray) -> np.ndarray:
    """Which features say yes more often than chance among so many of them explains."""
    count = np.bincount(columns, minlength=width)
    yes = np.bincount(columns, posterior[rows], width)
    rate = float(np.clip(posterior.mean(), 1e-4, 0.5))
    far = (yes - count * rate) / np.sqrt(np.maximum(count, 1) * rate * (1 - rate))
    rivals = np.bincount(count)[count]
    always = (count > 1) & (yes > 0.97 * count) & (np.exp(np.log(rate) * count) * rivals < 0.02)
    return ((far > 6) & (yes > 0.9 * count) & (count >= 4)) | always


def train(
    rows: np.ndarray, columns: np.ndarray, n: int, width: int, target: np.ndarray, penalty: float = 0.05
) -> tuple[np.ndarray, float]:
    """Logistic regression on present features with an L1 penalty, by accelerated proximal gradient."""
    weights, bias, look, look_b, pace = np.zeros(width), 0.0, np.zeros(width), 0.0, 1.0
    most = np.bincount(rows, minlength=n).max(initial=0) + 1
    # The curvature is at most a quarter of ``most`` times the count of each feature.
    step = 4.0 / (most * np.maximum(np.bincount(columns, minlength=width), 1))
    for _ in range(600):
        p = 1 / (1 + np.exp(-np.clip(look_b + np.bincount(rows, look[columns], n), -60, 60)))
        error = p - target
        new = look - step * np.bincount(columns, error[rows], width)
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
        new_b = look_b - 4.0 / (most * n) * error.sum()
        pace, old = (1 + (1 + 4 * pace * pace) ** 0.5) / 2, pace
        turn = (old - 1) / pace
        look, look_b = new + turn * (new - weights), new_b + turn * (new_b - bias)
        weights, bias = new, new_b
    return weights, bias


def one_of_each(found: list[np.ndarray]) -> list[int]:
    """Positions of sample documents without those that share half their features with an earlier one.

    Candidates are documents with the same least hash; near copies have several in common.
    """
    gone: set[int] = set()
    for factor in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93):
        first: dict[int, int] = {}
        for i, own in enumerate(found):
            if i in gone or not len(own):
                continue
            j = first.setdefault(int((own * np.uint64(factor)).min()), i)
            if j != i:
                common = len(np.intersect1d(own, found[j], assume_unique=True))
                if 3 * common >= len(own) + len(found[j]):  # a Jaccard similarity of a half
                    gone.add(i)
    return [i for i in range(len(found)) if i not in gone]


def fit(docs: DataFrame, labels: DataFrame | None, sample: int = SAMPLE, seed: int = 0) -> Scorer:
    """Train on the sample. Labels are votes of one more labeller, which abstains where they are null.

    Of documents that share an id one text is looked at, so ``sample`` bounds what is
    collected; of labels that share one, the worse counts. Rows without an id are not sampled.
    Empty tables give a scorer that rejects nothing on its own.
    """
    order = F.xxhash64(F.lit(seed), "doc_id")
    known: dict[int, list[int]] = {}
    if labels is not None:
        chosen = labels.where("doc_id is not null").orderBy(order, "doc_id", "toxic", "quality").limit(sample)
        for r in chosen.select("doc_id", "toxic", "quality").collect():
            old = known.get(r.doc_id, [-1, -1])
            votes = (-1 if r.toxic is None else r.toxic, -1 if r.quality is None else 1 - r.quality)
            known[r.doc_id] = [max(x) for x in zip(old, votes, strict=True)]
    texts = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null")
    if known:
        # from Arrow: a list would be read by Python workers of its own in each executor
        ids = docs.sparkSession.createDataFrame(pa.table({"doc_id": pa.array(list(known), pa.int64())}))
        picked = texts.join(F.broadcast(ids), "doc_id", "left_semi")  # at most ``sample`` ids
    else:
        ids = texts.select("doc_id").distinct().orderBy(order, "doc_id").limit(sample)
        picked = texts.join(F.broadcast(ids), "doc_id", "left_semi")

    first = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text")
    picked = picked.withColumn("copy", F.row_number().over(first)).where("copy = 1").drop("copy")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            raw = batch.column("text").cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "votes": pa.array([junk_votes(t) for t in raw], pa.list_(pa.int64())),
                    "features": pa.array([features(t).tobytes() for t in raw], pa.binary()),
                }
            )

    got = picked.mapInArrow(run, "doc_id long, votes array<long>, features binary").collect()
    rows = sorted((r.doc_id, bytes(r.features), r.votes) for r in got)
    del got
    found = [np.frombuffer(f, np.uint64) for _, f, _ in rows]
    # Copies count once, else the words of one text that has many look telling.
    kept = one_of_each(found)
    return learn(
        [found[i] for i in kept],
        [rows[i][2] for i in kept],
        [known.get(rows[i][0], [-1, -1]) for i in kept],
    )


def learn(found: list[np.ndarray], junk: list[list[int]], known: list[list[int]]) -> Scorer:
    """The scorer of a sample: features, junk votes, and label votes (toxic, junk) of each document."""
    insults = np.unique(hash_words(INSULTS))
    bins = np.unique(mix(np.add.outer(np.arange(5) * 100, np.arange(len(LEVELS) + 1)).ravel().astype(np.uint64)))
    n = len(found)
    if not n:
        return Scorer(insults, np.tile([6.0, 0.0], (len(insults), 1)), np.array([-4.0, -4.0]))
    # Features that one document alone has cannot be told from chance: they go first.
    every, times = np.unique(np.concatenate(found), return_counts=True)
    vocabulary = np.unique(np.concatenate((every[times > 1], insults, bins)))
    del every, times
    own = [f[np.isin(f, vocabulary, assume_unique=True)] for f in found]
    rows = np.repeat(np.arange(n, dtype=np.int32), [len(f) for f in own])
    columns = np.searchsorted(vocabulary, np.concatenate(own)).astype(np.int32)
    width = len(vocabulary)
    is_insult, is_bin = np.isin(vocabulary, insults), np.isin(vocabulary, bins)
    label = np.array(known)
    listed = np.bincount(rows[is_insult[columns]], minlength=n)
    # Words that go with the labels make two more labellers, each from one half of the labelled rows.
    learned: list[np.ndarray] = []
    for half in (0, 1):
        use = (label[:, 0] >= 0) & (np.arange(n) % 2 == half)
        words = np.zeros(width, bool)
        if label[use, 0].sum(initial=0) > 0:
            mine = use[rows] & ~is_bin[columns]
            words = telling(rows[mine], columns[mine], width, np.maximum(label[:, 0], 0) * 1.0)
        learned.append(np.bincount(rows[words[columns]], minlength=n) > 0)
    heuristics = (np.column_stack((listed > 0, listed > 1, *learned)), np.array(junk) > 0)
    trained = []
    used = is_insult | is_bin
    for fires, votes in zip(heuristics, label.T, strict=True):
        table = np.column_stack((np.where(fires, 1, -1), votes))
        posterior, _, _ = estimate(table, np.arange(table.shape[1]) >= fires.shape[1])
        # Each question sees its own words; insults and levels serve both.
        allowed = is_insult | is_bin | telling(rows, columns, width, posterior)
        used = used | allowed
        place = np.cumsum(allowed) - 1
        mine = allowed[columns]
        few, bias = train(rows[mine], place[columns[mine]], n, int(allowed.sum()), posterior)
        weights = np.zeros(width)
        weights[allowed] = few
        trained.append((weights, bias))
    weights = np.column_stack([w for w, _ in trained])[used]
    return Scorer(vocabulary[used], weights, np.array([b for _, b in trained]))


def _scored(texts: list[bytes | None], scorer: Scorer) -> np.ndarray:
    return np.array([scorer.score(features(t)) for t in texts]).reshape(-1, 2)


def classify(docs: DataFrame, scorer: Scorer, limit: float = 0.5) -> DataFrame:
    """Per row: doc_id, p_toxic, p_junk, rejected. Null and empty texts have no features and stay."""
    sent = docs.sparkSession.sparkContext.broadcast(scorer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            p = _scored(batch.column("text").cast(pa.binary()).to_pylist(), sent.value)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "p_toxic": pa.array(p[:, 0]),
                    "p_junk": pa.array(p[:, 1]),
                    "rejected": pa.array((p > limit).any(1)),
                }
            )

    slim = docs.select(F.col("doc_id").cast("long"), "text")
    return slim.mapInArrow(run, "doc_id long, p_toxic double, p_junk double, rejected boolean")


def keep(docs: DataFrame, scorer: Scorer, limit: float = 0.5) -> DataFrame:
    """The documents that are not rejected, with their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(scorer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            p = _scored(batch.column("text").cast(pa.binary()).to_pylist(), sent.value)
            yield batch.filter(pa.array(~(p > limit).any(1)))

    return docs.mapInArrow(run, docs.schema)
