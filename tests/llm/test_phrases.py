"""Collocations by stripes, against counting every phrase."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pricetide.llm import stripes

BREAK, GAP = re.compile("[.,;:!?\n\x0b\x0c\r]"), re.compile("[ \t]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute_force(rows, least, top):
    n, f = Counter(), Counter()
    for lang, text in rows:
        for piece in BREAK.split(lower(text or "")):
            words = [w for w in GAP.split(piece) if w]
            n[lang or "und"] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f[lang or "und", tuple(words[i : i + k])] += 1
    found = {}
    for (lang, p), a in f.items():
        if len(p) < 2 or a < least:
            continue
        cuts = [(2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        found[lang, p] = (a, f[lang, p[:k]], f[lang, p[k:]], score)
    rows = []
    for (lang, p), (a, left, right, score) in found.items():
        inside = lambda q, p=p: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        longer = [b for (x, q), (b, *_) in found.items() if x == lang and len(q) > len(p) and inside(q)]
        if not any(100 * b >= 80 * a for b in longer):
            rows.append((lang, -score, -a, " ".join(p).encode(), left, right, n[lang]))
    rows.sort()
    out, rank = [], Counter()
    for lang, score, a, phrase, left, right, words in rows:
        rank[lang] += 1
        if rank[lang] <= top:
            out.append((lang, rank[lang], phrase.decode(), -a, left, right, words, -score))
    return sorted(out)


def found(df, **options):
    return sorted(tuple(r) for r in stripes.collocations(df, **options).collect())


def texts(seed, n, vocabulary):
    draw = random.Random(seed)
    words = [w for w in vocabulary for _ in range(draw.randint(1, 4))]
    gaps = [" ", " ", " ", "  ", "\t", ", ", ". ", "\n", "\x0b", " \x1c ", " "]
    for i in range(n):
        text = "".join(draw.choice(words) + draw.choice(gaps) for _ in range(draw.randint(0, 60)))
        yield draw.choice(["en", "de", None, "und"]), None if i % 17 == 3 else text


@pytest.mark.parametrize(("seed", "least"), [(1, 2), (2, 5), (3, 30)])
def test_all_phrases_and_numbers(spark, seed, least):
    rows = list(texts(seed, 120 * seed * seed, ["New", "york", "City", "of", "THE", "Écluse", "écluse", "ÉCLUSE", "a", "-", "日本"]))
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    got = found(df, least=least, top=150)
    assert got and got == brute_force(rows, least, 150)


def test_texts_are_cut_at_ends_of_pieces(monkeypatch):
    monkeypatch.setattr(stripes, "STRETCH", 40)
    rows = [("en", "in the end of the day. " * 9), ("en", "in the end of it all, in the end of the day"), ("en", "x")]
    batch = pa.RecordBatch.from_pydict({"lang": [r[0] for r in rows], "text": [r[1] for r in rows]})
    words = list(stripes._stretches(iter([batch])))
    assert len(words) >= 4 and sum(len(w.number) for w in words) == 9 * 6 + 12 + 1
    assert sum(int((~w.joined).sum()) for w in words) == 9 + 2 + 1  # pieces stay whole


def test_slots_that_are_shared_cost_time_only(spark, monkeypatch):
    rows = list(texts(7, 60, ["a", "b", "c"]))
    df = spark.createDataFrame(rows, "lang string, text string")
    assert found(df, least=3, top=50) == brute_force(rows, 3, 50)
    full = zlib.compress(b"\xff" * (1 << (stripes._LOW_BITS - 3)))
    parts = range(1 << (stripes.SLOT_BITS - stripes._LOW_BITS))
    everything = {(k, p): full for k in range(1, 5) for p in parts}
    monkeypatch.setattr(stripes, "passing_slots", lambda docs, least: everything)
    assert found(df, least=3, top=50) == brute_force(rows, 3, 50)


def test_odd_rows(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert found(empty) == []
    nothing = spark.createDataFrame([("en", None), ("en", ""), (None, " .. \t")], "lang string, text string")
    assert found(nothing) == []
    long = "alpha beta " * 40_000
    df = spark.createDataFrame([("en", long)], "lang string, text string").withColumns(
        {c: F.lit("x") for c in ("prefix", "n", "phrase", "rank", "segment")}
    )
    assert found(df, top=5) == brute_force([("en", long)], 30, 5)


def test_ties_end_at_the_phrase_in_byte_order(spark):
    rows = [("en", "z é. z é. é z. é z. a b. a b. ")]
    got = found(spark.createDataFrame(rows, "lang string, text string"), least=2)
    assert [r[2] for r in got] == [r[2] for r in brute_force(rows, 2, 99)]


def test_entries_of_many_stretches_are_merged_and_sent_in_parts(monkeypatch):
    monkeypatch.setattr(stripes, "STRETCH", 200)
    monkeypatch.setattr(stripes, "HELD", 60)
    rows = list(texts(11, 80, ["a", "b", "c", "ü", "dd"]))
    batch = pa.RecordBatch.from_pydict({"lang": [r[0] for r in rows], "text": [r[1] for r in rows]})
    every = [np.full(1 << (stripes.SLOT_BITS - 3), 255, np.uint8)] * (stripes.LONGEST + 1)
    sent, held, flushes = [], stripes.Entries(), 0
    for words in stripes._stretches(iter([batch])):
        held.add(words, every)
        if held.full():
            sent += list(held.stripes())
            held, flushes = stripes.Entries(), flushes + 1
    sent += list(held.stripes())
    assert flushes > 2
    whole = pa.Table.from_batches(sent).sort_by("key").combine_chunks().to_batches()
    got, per_key = Counter(), {}
    for out in stripes._merged(iter(whole)):
        for r in out.to_pylist():
            assert (r["lang"], r["prefix"], r["next"]) not in got  # one entry of each
            got[r["lang"], r["prefix"], r["next"]] += r["n"]
    for b in whole:
        for key, lang in zip(b.column("key").to_pylist(), b.column("lang").to_pylist(), strict=True):
            per_key.setdefault(key, set()).add(lang)
    assert all(len(langs) == 1 for langs in per_key.values())
    expected = Counter()
    for lang, text in rows:
        for piece in BREAK.split(lower(text or "")):
            words = [w for w in GAP.split(piece) if w]
            for i in range(len(words)):
                for k in range(min(4, len(words) - i)):
                    expected[lang or "und", " ".join(words[i : i + k]), words[i + k]] += 1
    assert got == expected
