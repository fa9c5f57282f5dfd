"""Near duplicates, repeated strings and vectors against brute force."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from pricetide.llm import column_bwt, lsh_forest, stable_hash
from pricetide.llm import components as links_
from pricetide.llm.components import components

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rooted(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def near_expected(rows):
    sets = {d: shingles(t) for d, t in rows}
    links = [
        (a, b)
        for a, b in itertools.combinations(sets, 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    top = rooted(sets, links)
    return sorted((d, len(sets[d]), top[d], top[d] == d) for d in sets)


def variants(seed):
    draw = random.Random(seed)
    texts = [None, "", " \t\n", "one", "ONE ", "a b c d", "a B c d", "Ünïcode Übung " * 3, "word " * 30_000]
    for _ in range(6):
        base = [draw.choice("abcdefghijklmnopqrstuvwxyz") * draw.randint(1, 3) + str(draw.randint(0, 400)) for _ in range(120)]
        for _ in range(12):
            own = list(base)
            for _ in range(draw.choice([0, 1, 2, 3, 4, 6, 9])):
                own[draw.randrange(len(own))] = f"new{draw.randint(0, 10**6)}"
            texts.append(" ".join(own))
    return texts


def test_components(spark):
    links = [(1, 2), (2, 3), (5, 4), (4, 6), (6, 5), (7, 7), (None, 3)] + [(i, i + 1) for i in range(100, 140)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 4} | {i: 100 for i in range(100, 141)}


def test_components_stop_at_stars(spark, monkeypatch):
    """No round is spent on finding that nothing changes."""
    rounds = []
    plain = links_._large_star
    monkeypatch.setattr(links_, "_large_star", lambda links: rounds.append(1) or plain(links))
    of = lambda rows: {r.node: r.component for r in components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert of([(1, n) for n in range(2, 9)] + [(20, 21)]) == {n: 1 for n in range(1, 9)} | {20: 20, 21: 20}
    assert not rounds
    assert of([(9, n) for n in range(1, 9)]) == {n: 1 for n in range(1, 10)}
    assert len(rounds) == 1
    assert of([]) == {} and len(rounds) == 1


def test_near_duplicates_equal_brute_force(docs_of):
    rows = list(enumerate(variants(1)))
    found = lsh_forest.near_duplicates(docs_of([t for _, t in rows])).collect()
    assert sorted(map(tuple, found)) == near_expected(rows)


def test_crowded_regions_go_deeper_and_into_blocks(docs_of, monkeypatch):
    monkeypatch.setattr(lsh_forest, "REGION", 4)
    rows = list(enumerate(variants(2)))
    found = lsh_forest.near_duplicates(docs_of([t for _, t in rows])).collect()
    assert sorted(map(tuple, found)) == near_expected(rows)


def test_regions_of_all_levels_and_blocks_are_compared_in_one_pass(docs_of, monkeypatch):
    monkeypatch.setattr(lsh_forest, "REGION", 4)
    passes, plain, dealt = [], lsh_forest.confirmed, []
    blocks = lsh_forest.blocks
    monkeypatch.setattr(lsh_forest, "confirmed", lambda *a: passes.append(1) or plain(*a))
    monkeypatch.setattr(lsh_forest, "blocks", lambda members: dealt.append(1) or blocks(members))
    rows = list(enumerate(variants(5)))
    found = lsh_forest.near_duplicates(docs_of([t for _, t in rows])).collect()
    assert sorted(map(tuple, found)) == near_expected(rows)
    assert dealt and len(passes) == 1


def test_orders_of_all_levels_have_keys_of_their_own():
    signatures = np.random.default_rng(1).integers(0, 9, (20, lsh_forest.VALUES)).astype("<u2")
    low = [set((lsh_forest.region_keys(signatures, level) & 0xFF).ravel().tolist()) for level in (0, 1)]
    assert [len(x) for x in low] == [n for _, n in lsh_forest.LEVELS] and not low[0] & low[1]


@pytest.mark.parametrize("n, split", [(2, 0), (40, 0), (40, 13), (400, 0), (400, 1), (400, 250)])
def test_candidates_look_at_the_pairs_of_their_block_only(monkeypatch, n, split):
    draw = np.random.default_rng(n + split)
    signatures = draw.integers(0, 60_000, (4, lsh_forest.VALUES))[draw.integers(0, 4, n)]
    other = draw.random((n, lsh_forest.VALUES)) < draw.random((n, 1)) * 0.4
    signatures = np.where(other, 7 * np.arange(n)[:, None], signatures).astype("<u2")
    kin, seen, plain = draw.integers(0, 5, n), [], lsh_forest.equal_values
    monkeypatch.setattr(lsh_forest, "equal_values", lambda a, b: seen.append(len(a) * len(b)) or plain(a, b))
    same = (signatures[:, None] == signatures[None]).sum(2)
    pairs = itertools.product(range(split), range(split, n)) if split else itertools.combinations(range(n), 2)
    places = lsh_forest.orders(1)[:3]
    wanted = {
        (a, b, same[a, b])
        for a, b in pairs
        if kin[a] != kin[b]
        and same[a, b] >= int(lsh_forest.MARGIN * lsh_forest.VALUES)
        and not any((signatures[a, p] == signatures[b, p]).all() for p in places)
    }
    found = list(zip(*lsh_forest.candidates(signatures, kin, 3, 1, split), strict=True))
    assert len(found) == len(wanted) and set(found) == wanted
    assert sum(seen) <= (split * (n - split) if split else n * n)


def test_near_duplicates_of_odd_rows(docs_of):
    rows = [(3, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (None, "alone"), (1, "A b c d e f")]
    found = lsh_forest.near_duplicates(docs_of(rows)).collect()
    assert sorted(map(tuple, found), key=str) == sorted(
        [(3, 2, 1, False), (3, 2, 1, False), (None, 2, 1, False), (None, 1, None, True), (1, 2, 1, True)], key=str
    )
    docs = docs_of(rows)
    assert lsh_forest.deduplicated(docs).columns == docs.columns
    assert sorted(str(r.doc_id) for r in lsh_forest.deduplicated(docs).collect()) == ["1", "None"]
    assert lsh_forest.near_duplicates(docs_of([])).collect() == []


def test_levels_miss_few_pairs():
    assert lsh_forest.missed(0) < 1e-5 and lsh_forest.missed(1) < 5e-4
    for level, (depth, n) in enumerate(lsh_forest.LEVELS):
        assert lsh_forest.orders(level).shape == (n, depth)
        assert all(len(set(o)) == depth for o in lsh_forest.orders(level).tolist())
    # pairs of signatures that agree in each value with the chance of 0.75
    draw = np.random.default_rng(5)
    equal = draw.random((100_000, lsh_forest.VALUES)) < 0.75
    held = np.zeros(len(equal), bool)
    for order in lsh_forest.orders(1):
        held |= equal[:, order].all(axis=1)
    assert abs((~held).mean() - lsh_forest.missed(1)) < 2e-4


def near_copies(n, seed=3):
    draw = random.Random(seed)
    base = [f"w{draw.randint(0, 10**6)}" for _ in range(200)]
    for i in range(n):
        own = list(base)
        for _ in range(draw.choice([1, 2])):
            own[draw.randrange(200)] = f"x{i}-{draw.randint(0, 10**6)}"
        yield " ".join(own)


def test_a_large_group_of_near_copies_costs_its_size(docs_of, monkeypatch):
    """Rows of the second level come only from regions in several pieces."""
    monkeypatch.setattr(lsh_forest, "REGION", 64)
    made = []
    plain = lsh_forest.active
    monkeypatch.setattr(lsh_forest, "active", lambda *a: made.append(plain(*a)) or made[-1])
    texts = [*near_copies(400), *variants(4)]
    found = lsh_forest.near_duplicates(docs_of(texts)).collect()
    assert sorted(map(tuple, found)) == near_expected(list(enumerate(texts)))
    assert sum(df.count() for df in made) < 4 * len(texts)


def test_blocks_hold_every_pair_but_those_of_the_largest_piece(spark, monkeypatch):
    monkeypatch.setattr(lsh_forest, "REGION", 8)
    rows = [(1, n, 0 if n < 40 else n) for n in range(51)] + [(2, n, n) for n in range(20)]
    met = {}
    for r in lsh_forest.blocks(spark.createDataFrame(rows, "key long, node long, kin long")).collect():
        met.setdefault((r.key, r.block), []).append((r.side, r.node))
    pairs = {}
    for (key, _), own in met.items():
        for (x, a), (y, b) in itertools.combinations(sorted(own), 2):
            if x == y == 0 or x != y:
                pairs[key, *sorted((a, b))] = pairs.get((key, *sorted((a, b))), 0) + 1
    wanted = {(1, a, b) for a, b in itertools.combinations(range(51), 2) if b >= 40}
    wanted |= {(2, a, b) for a, b in itertools.combinations(range(20), 2)}
    assert set(pairs) == wanted and set(pairs.values()) == {1}


def cut_expected(rows, length):
    seen = {}
    for _, t in rows:
        for s in range(len(t) - length + 1):
            seen[t[s : s + length]] = seen.get(t[s : s + length], 0) + 1
    out = []
    for d, t in rows:
        gone = bytearray(len(t))
        for s in range(len(t) - length + 1):
            if seen[t[s : s + length]] > 1:
                gone[s : s + length] = b"\1" * length
        n_spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        out.append((d, len(t), sum(gone), n_spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("group", [256, 2])
def test_repeats_equal_brute_force(docs_of, monkeypatch, group):
    monkeypatch.setattr(column_bwt, "GROUP", group)
    draw = random.Random(group)
    base = ["".join(draw.choice("abc") for _ in range(300)) for _ in range(3)]
    texts = ["", "x" * 19, "x" * 20, "x" * 21, "é" * 200, "ab" * 3_000, base[0], base[0]]
    for _ in range(150):
        parts = [draw.choice(base)[(a := draw.randint(0, 290)) : a + draw.randint(1, 60)] for _ in range(3)]
        texts.append("".join(p + draw.choice(["", "x", "yz"]) for p in parts))
    found = column_bwt.without_repeats(docs_of(texts), 20, 8).collect()
    assert sorted(map(tuple, found)) == cut_expected([(i, t.encode()) for i, t in enumerate(texts)], 20)


def test_repeats_of_odd_rows(docs_of):
    found = column_bwt.without_repeats(docs_of([None, (None, "a" * 300), (5, "b" * 300), (5, "b" * 300)]), with_text=True)
    rows = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found.collect())
    assert rows == [("0", 0, 0, 0, b""), ("5", 300, 300, 1, b""), ("5", 300, 300, 1, b""), ("None", 300, 300, 1, b"")]
    assert column_bwt.without_repeats(docs_of([])).collect() == []


def vectors(seed=0):
    draw = np.random.default_rng(seed)
    rows = []
    for _ in range(8):
        centre = draw.standard_normal(16)
        rows += [(centre + draw.standard_normal(16) * 0.08 * s).tolist() for s in range(6)]
    rows += [rows[3], rows[3], None, [], [0.0] * 16, [float("nan")] * 16, [None] + [1.0] * 15, [1e308] * 16, [1.0] * 16]
    return rows


@pytest.mark.parametrize("block", [1024, 4])
def test_vectors_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(stable_hash, "BLOCK", block)
    rows = vectors()
    df = spark.createDataFrame([(i, v, 1) for i, v in enumerate(rows)], "vec_id long, embedding array<double>, node int")
    unit = {}
    for i, v in enumerate(rows):
        if v and None not in v and np.isfinite(v).all() and any(v):
            u = np.array(v) / max(map(abs, v))
            unit[i] = u / np.linalg.norm(u)
    links = [(a, b) for a, b in itertools.combinations(unit, 2) if unit[a] @ unit[b] >= 0.9]
    top = rooted(range(len(rows)), links)
    n = {i: sum(i in p for p in links) for i in top}
    found = stable_hash.near_duplicates(df).collect()
    assert sorted(map(tuple, found)) == sorted((i, n[i], top[i], top[i] == i) for i in top)


def test_no_vectors(spark):
    df = spark.createDataFrame([(1, None)], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in stable_hash.near_duplicates(df).collect()] == [(1, 0, 1, True)]
    assert stable_hash.near_duplicates(df.limit(0)).collect() == []


def test_members_of_crowded_regions_are_looked_up_once_each(spark):
    rows = [(key, node) for key in range(32) for node in range(6) if key < 30 or node < 4]
    crowded = spark.createDataFrame([*rows, (99, 0), (99, 7)], "key long, node long")
    kin = spark.createDataFrame([(n, 0) for n in range(4)] + [(4, 4)], "node long, component long")
    found = lsh_forest.in_pieces(crowded, kin)
    got = sorted(map(tuple, found.collect()))
    piece = lambda n: 0 if n < 4 else n
    assert got == sorted([(k, n, piece(n)) for k, n in rows if k < 30] + [(99, 0, 0), (99, 7, 7)])
    plan = found._jdf.queryExecution().optimizedPlan()
    pending, inputs = [plan], []
    while pending:
        node = pending.pop()
        children = [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "Join" and "LeftOuter" in node.toString().splitlines()[0]:
            inputs.append("collect_list" in children[0].toString())
        pending += children
    assert inputs and all(inputs)  # a row a node, not a row for each of its regions
