"""Ranked search by best positions, against scoring every document."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pricetide.llm import best_position

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_force(docs, items, k=20):
    """(item, rank, doc, score) of rows (id, text); ids may repeat."""
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    count, length = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in held:
            m = 75 + 25 * n * count // length
            score = 0
            for t, q in Counter(terms(text)).items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1)))
                    score += q * w * (10**9 * c[t] // (1000 * c[t] + 12 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        scored.sort(key=lambda s: s[:3])
        out += [(item, r, s[3], -s[0]) for r, s in enumerate(scored[:k], 1)]
    return sorted(out, key=repr)


def found(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id string, text string")
    # columns of any other name stay out of the way
    d, b = (x.withColumns({c: F.lit(1) for c in ("row", "id", "terms", "shard", "score")}) for x in (d, b))
    return sorted((tuple(r) for r in best_position.search(d, b, **options).collect()), key=repr)


def texts(draw, n, longest):
    words = [f"w{i}" for i in range(40)] + ["É", "é", "the", "THE", "日本", "x9"]
    weights = [1 / (i + 1) for i in range(len(words))]
    return [" -".join(draw.choices(words, weights, k=draw.randint(0, longest))) for _ in range(n)]


@pytest.mark.parametrize("shard", [1 << 14, 50])
def test_equal_to_scoring_everything(spark, monkeypatch, shard):
    monkeypatch.setattr(best_position, "SHARD_DOCS", shard)
    monkeypatch.setattr(best_position, "BLOCK_ITEMS", 7)
    draw = random.Random(5)
    docs = list(enumerate(texts(draw, 400, 60)))
    docs += [(1000 + i, docs[7][1]) for i in range(40)]  # ties over the last place
    docs += [(3, docs[9][1]), (None, docs[7][1]), (None, None), (2000, ""), (2001, "..."), (2002, "the " * 5000)]
    items = [(f"q{i}", t) for i, t in enumerate(texts(draw, 20, 12))]
    items += [("same", docs[7][1]), ("none", None), ("void", ""), ("unknown", "zzz"), (None, "w1 w1 w30")]
    got = found(spark, docs, items)
    assert got == brute_force(docs, items)
    assert found(spark, docs, items, k=3) == brute_force(docs, items, 3)


def test_empty_tables(spark):
    assert found(spark, [], [("a", "x")]) == []
    assert found(spark, [(1, "x")], []) == []
    assert found(spark, [(1, None)], [("a", "x")]) == []


def test_repeated_items_are_items_of_their_own(spark):
    docs, items = [(1, "a b"), (2, "b"), (3, "c"), (4, "c")], [("q", "a"), ("q", "b")]
    assert found(spark, docs, items) == brute_force(docs, items)


def test_texts_over_a_stretch(spark, monkeypatch):
    monkeypatch.setattr(best_position, "STRETCH", 16)
    text = "alpha beta, gamma alpha-delta éalpha"
    assert best_position._one_row(text.encode(), None)["n"].to_pylist() == [6]
    own = best_position._one_row(text.encode(), None)
    assert dict(zip(own["terms"][0].as_py(), own["times"][0].as_py(), strict=True)) == Counter(terms(text))


def test_a_search_stops_before_the_ends_of_its_lists():
    import pyarrow as pa

    n = 5000
    rare = [["rare"] if i < 20 else [] for i in range(n)]
    docs = pa.table(
        {
            "id": pa.array(range(n), pa.int64()),
            "m": pa.array([100 + i % 50 for i in range(n)], pa.int64()),
            "terms": pa.array([["common", *r] for r in rare], pa.list_(pa.string())),
            "times": pa.array([[1 + i % 3, *[5 for _ in r]] for i, r in enumerate(rare)], pa.list_(pa.int64())),
        }
    )
    shard = best_position.Shard(docs)
    reads = []
    places = shard.impact

    class Counting:
        def __getitem__(self, at):
            if isinstance(at, int):
                reads.append(at)
            return places[at]

    shard.impact = Counting()
    met, _ = shard.best(["common", "rare"], [5, 9000], 10)
    assert set(met.tolist()) <= set(range(20)) and len(reads) <= 2
