"""Token files, archives, decontamination, counts, classifier, mixing, sharding, pipeline."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from catalog.compare import connect, difference
from pricetide.llm import edit_counts, lookup_shards, mixing, registry, suffix_automaton, token_frames, warc, weak_labels

SF = "/root/testdata/sf0.001"
ODD = [None, "", " ", "two  spaces", "tab\t end \n", " lead", "<|endoftext|> x", "Ü日本 'll don't", "long " * 20_000, "same", "same"]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(registry.byte_vocabulary())


def test_token_files(docs_of, tokenizer, tmp_path):
    rows = [(10 - i, t) for i, t in enumerate(ODD)] + [(None, "no id")]
    folder = f"file://{tmp_path}/ids"
    manifest = token_frames.write(docs_of(rows), folder, registry.byte_vocabulary(), 2, frame_bytes=64)
    found = token_frames.digest(manifest.sparkSession, manifest, folder).collect()
    expected, start = [], 0
    for name, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        expected.append((name, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, found), key=lambda r: r[1]) == expected
    one = token_frames.lookup(manifest.sparkSession, manifest, folder, [3]).collect()
    assert [(r.doc_id, r.ids) for r in one] == [(3, tokenizer.encode(ODD[7], add_special_tokens=False).ids + [2])]


def test_token_file_reads_only_what_is_asked_and_checks_it(tmp_path):
    path = tmp_path / "x.zst"
    docs = [(i, np.full(50, i, "<u2").tobytes()) for i in range(20)]
    with path.open("wb") as out:
        assert token_frames.write_file(out, docs, 2, 300) == (20, 1000)

    class Source:
        def __init__(self, data):
            self.data, self.at = data, 0

        def size(self):
            return len(self.data)

        def seek(self, at):
            self.at = at

        def read(self, n):
            return self.data[self.at : self.at + n]

    file = token_frames.TokenFile(Source(path.read_bytes()))
    assert file.ids(7).tolist() == [7] * 50 and file.frames_read == 1 and len(file.entries) == 7
    import zstandard

    whole = zstandard.ZstdDecompressor().decompressobj(read_across_frames=True).decompress(path.read_bytes())
    assert whole == b"".join(b for _, b in docs)
    damaged = bytearray(path.read_bytes())
    damaged[12] ^= 1
    with pytest.raises(Exception, match="checksum|rror"):
        token_frames.TokenFile(Source(bytes(damaged))).ids(0)


def test_no_token_files(docs_of):
    assert token_frames.round_trip(docs_of([]), registry.byte_vocabulary()).collect() == []


def test_archives(spark):
    bodies = [None, "", "a", "a", "long ü " * 5_000, "long ü " * 5_000, "<p>\r\n0\r\n\r\n</p>" * 700]
    pages = spark.createDataFrame([(i, f"http://x/{i}\r\nX: y", b, 1) for i, b in enumerate(bodies)], "page_id long, url string, html string, leader int")
    raw = [(b or "").encode() for b in bodies]
    expected = []
    for i, b in enumerate(raw):
        top = max(j for j, other in enumerate(raw) if other == b)
        digest = base64.b32encode(hashlib.sha1(b).digest()).decode()
        expected.append((i, len(b), digest, "response" if top == i else "revisit", None if top == i else top, None))
    assert sorted(map(tuple, warc.round_trip(pages).collect())) == expected
    assert warc.round_trip(pages.limit(0)).collect() == []


def test_archive_payloads_and_damage(spark, tmp_path):
    folder = f"file://{tmp_path}/warc"
    pages = spark.createDataFrame([(1, "u", "x" * 9_000), (None, None, "y")], "page_id long, url string, html string")
    records = warc.read_records(spark, warc.write(pages, folder, segment_bytes=1_000), folder)
    assert records.count() > 9
    found = warc.decode(warc.reassemble(records), with_payload=True).collect()
    assert {bytes(r.payload) for r in found} == {b"x" * 9_000, b"y"} and all(r.problem is None for r in found)
    damaged = warc.decode(warc.reassemble(records.where("number <> 4"))).collect()
    assert sorted(r.problem or "" for r in damaged) == ["", "segments are missing or repeated"]
    short = warc.decode(warc.reassemble(records.withColumn("total", F.col("total") + 1))).collect()
    assert all("total length" in r.problem for r in short)
    assert warc.unframe_chunks(b"3;x=y\r\nabc\r\n0\r\nTrailer: z\r\n\r\n") == b"abc"
    for bad in (b"5\r\nabc\r\n0\r\n\r\n", b"3\r\nabc"):
        with pytest.raises(ValueError):
            warc.unframe_chunks(bad)


def words(text):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(fold))


def contamination(docs, items, window):
    out = []
    for d, text in docs:
        w, hit, names = words(text), set(), []
        for name, item in items:
            x = words(item)
            n = min(len(x), window)
            own = {tuple(x[i : i + n]) for i in range(len(x) - n + 1)} if x else set()
            at = [i for i in range(len(w) - n + 1) if tuple(w[i : i + n]) in own] if n else []
            hit.update(p for i in at for p in range(i, i + n))
            names += [str(name)] if at else []
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(names), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


@pytest.mark.parametrize("block_words", [10**6, 40])
def test_decontamination_equals_brute_force(spark, docs_of, block_words):
    draw = random.Random(4)
    make = lambda n: " ".join(draw.choice(["a", "b", "C", "é", "x1"]) for _ in range(n))
    items = [(i, make(n)) for i, n in enumerate([1, 3, 4, 5, 6, 9, 14, 20, 7, 7])] + [(90, None), (91, "--"), (3, "a b é")]
    texts = [None, "", "?!", "a-b.C", "zzz " * 50_000] + [make(draw.randint(0, 60)) + " q " * draw.randint(0, 9) for _ in range(60)]
    bench = spark.createDataFrame([(*i, 0) for i in items], "item_id long, text string, key int")
    docs = docs_of(texts)
    found = suffix_automaton.report(suffix_automaton.mark(docs, bench, window=6, block_words=block_words)).collect()
    expected = contamination(list(enumerate(texts)), items, 6)
    assert sorted(map(tuple, found)) == expected
    clean = suffix_automaton.remove(docs.withColumn("__marks", F.lit(1)), bench, window=6, block_words=block_words)
    assert sorted(r.doc_id for r in clean.collect()) == [r[0] for r in expected if not r[5]]
    assert clean.columns == [*docs.columns, "__marks"]


def test_spans_are_cut_and_empty_tables_work(spark, docs_of):
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    cut = suffix_automaton.remove(docs_of(["Say: One, two THREE! And go."]), bench, spans_only=True)
    assert cut.first().text == "Say: ! And go."
    assert suffix_automaton.remove(docs_of([]), bench).collect() == []
    assert suffix_automaton.remove(docs_of(["one two three"]), bench.limit(0)).count() == 1


def test_edits_keep_counts(tokenizer):
    counter = edit_counts.counter(registry.byte_vocabulary())
    draw = random.Random(5)
    parts = [" ", "  ", "\n", "a", "'s", "'r", "e", "'", "Ü", "9", ".", " the", "l", "v", "日本"]
    make = lambda n: "".join(draw.choice(parts) for _ in range(n))
    for _ in range(300):
        text = make(draw.choice([0, 1, 10, 60, 700]))
        cut = edit_counts.cut(text)
        tree = edit_counts.Tree(text, np.array([len(p) for p in cut], int), np.array(counter(cut), int))
        for _ in range(4):
            a = draw.randint(0, len(text))
            b, new = min(len(text), a + draw.choice([0, 1, 2, 5, 40])), make(draw.choice([0, 1, 2, 5, 300]))
            tree.edit(a, b, new, counter)
            text = text[:a] + new + text[b:]
            assert tree.text == text and tree.leaves()[0] == [len(p) for p in edit_counts.cut(text)]
            assert tree.total == len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_an_edit_encodes_little():
    counter = edit_counts.counter(registry.byte_vocabulary())
    cut = edit_counts.cut("some words here " * 5_000)
    tree = edit_counts.Tree("".join(cut), [len(p) for p in cut], counter(cut))
    tree.edit(40_000, 40_003, "new", counter)
    assert tree.encoded < 12


def test_counts_after_redaction(docs_of, tokenizer):
    texts = [*ODD[:6], *ODD[7:], "write a.b+c@x-y.org or c@x.de. now", "at 10.0.0.1, call +1 (706) 555-3138", "@ a@ @b 1@2.3"]
    docs = docs_of(texts)
    found = {r.doc_id: r for r in edit_counts.counts_after_redaction(docs, registry.byte_vocabulary()).collect()}
    size = lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids)
    for i, text in enumerate(texts):
        new = text or ""
        for a, b, put in reversed(edit_counts.redaction_edits(text)):
            new = new[:a] + put + new[b:]
        assert (found[i].n_before, found[i].n_tokens) == (size(text or ""), size(new))
    assert [found[i].n_edits for i in range(len(texts) - 3, len(texts))] == [2, 2, 1]
    trees = edit_counts.build(edit_counts.with_redactions(docs), registry.byte_vocabulary(), keep=("edits",))
    again = edit_counts.update(trees, registry.byte_vocabulary()).select(*next(iter(found.values())).__fields__).collect()
    assert {r.doc_id: r for r in again} == found
    assert edit_counts.counts_after_redaction(docs_of([]), registry.byte_vocabulary()).collect() == []


def test_label_model_finds_the_good_labellers():
    draw = np.random.default_rng(0)
    truth = draw.random(4_000) < 0.2
    right = [(0.9, 0.01), (0.6, 0.02), (0.4, 0.05)]
    one = [np.where(draw.random(4_000) < np.where(truth, h, f), 1, -1) for h, f in right]
    both = np.where(draw.random(4_000) < 0.98, truth, ~truth).astype(int)
    posterior, hit, false = weak_labels.estimate(np.column_stack([*one, both]), np.array([False] * 3 + [True]))
    assert ((posterior > 0.5) == truth).mean() > 0.97
    assert false[0] < false[1] < false[2] and hit[0] > hit[2]


def test_classifier_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = registry.table(spark, sf, "documents"), registry.table(spark, sf, "labels")
    held_out = labels.where("doc_id % 3 = 0")
    scorer = weak_labels.fit(docs, labels.where("doc_id % 3 <> 0"))
    found = weak_labels.classify(docs, scorer).join(held_out, "doc_id").collect()
    junk = Counter((r.quality == 0, r.p_junk > 0.5) for r in found)
    assert junk[True, True] > 0.95 * (junk[True, True] + junk[True, False]) and junk[False, True] <= 2
    toxic = Counter((r.toxic == 1, r.p_toxic > 0.5) for r in found)
    assert toxic[True, True] > 0.75 * (toxic[True, True] + toxic[True, False])
    assert toxic[False, True] < 0.01 * toxic[False, False]


def test_classifier_of_odd_rows(spark, docs_of):
    docs = docs_of([*ODD, "you stupid clown", "plain text of some words"])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for given in (None, labels, spark.createDataFrame([(0, None, None), (3, 1, 0), (3, 1, 0)], labels.schema)):
        scorer = weak_labels.fit(docs, given)
        kept = weak_labels.keep(docs, scorer)
        assert kept.columns == docs.columns and kept.where("doc_id in (0, 1, 2, 12)").count() == 4
    assert weak_labels.classify(docs_of([]), weak_labels.fit(docs_of([]), labels)).collect() == []


def test_fitting_counts():
    draw = np.random.default_rng(1)
    for n in (1, 7, 300):
        sizes, counts = draw.choice(9_000, n, replace=False), draw.integers(1, 9, n)
        total = int((sizes * counts).sum())
        for budget in (0, 1, total // 3, total // 2 + 5, total, total + 9):
            taken = mixing.fit_counts(sizes, counts, budget)
            assert (taken >= 0).all() and (taken <= counts).all()
            left = min(budget, total) - int((sizes * taken).sum())
            assert 0 <= left <= (0 if n == 300 and budget > 5_000 else 9_000)
    assert mixing.knapsack(np.array([4, 6]), np.array([3, 2]), 14) in ([(0, 2), (1, 1)], [(1, 1), (0, 2)])


def filled(size):
    names = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None] * (None in size)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    stopped = {}
    while True:
        free = [s for s in names if s not in stopped]
        level = (1.5 * sum(size.values()) - sum(2 * size[s] for s in stopped)) / max(1, sum(weight[s] for s in free))
        over = [s for s in free if weight[s] * level > 2 * size[s]]
        if not over:
            return {s: 2 * size[s] if s in stopped else weight[s] * level for s in names}
        stopped |= dict.fromkeys(over)


def test_mix(docs_of):
    draw = random.Random(6)
    texts = [None, "", "a b"] + ["w " * draw.choice([1, 5, 40, 40, 300]) for _ in range(900)]
    sources = [draw.choice(["a", "b", "b", "Z", "é", None]) if i % 3 else "b" for i in range(len(texts))]
    rows = mixing.mix(docs_of(texts, sources)).collect()
    size = Counter()
    for t, s in zip(texts, sources, strict=True):
        size[s] += len((t or "").split())
    goal, taken = filled(size), Counter()
    for r in rows:
        assert r["size"] == len((texts[r.doc_id] or "").split()) and r.taken <= 2 * r["size"]
        assert r.source_size == size[r.source] and r.target == pytest.approx(goal[r.source])
        taken[r.source] += r.taken
    assert len(rows) == len(texts) and all(abs(taken[s] - goal[s]) <= 1 for s in goal)
    again = mixing.mix(docs_of(texts, sources).repartition(5)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    docs = docs_of(texts, sources)
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({r.doc_id: r.times for r in rows if r.times})


def test_mix_of_odd_rows(docs_of):
    rows = [(1, "a b"), (1, "a b"), (None, "c"), (2, "d e f")]
    assert mixing.mix(docs_of(rows)).count() == 4
    assert mixing.mixed(docs_of(rows)).count() >= 4
    assert mixing.mix(docs_of([])).collect() == [] and mixing.mixed(docs_of([])).collect() == []
    assert mixing.mix(docs_of([None, ""])).agg(F.sum("taken")).first()[0] == 0


def test_lookup_table():
    names = [f"s{i}" for i in range(10)]
    table = lookup_shards.fill_table(names, 1009)
    counts = Counter(table)
    assert max(counts.values()) - min(counts.values()) <= 1
    fewer = lookup_shards.fill_table(names[:-1], 1009)
    assert sum(a != b for a, b in zip(table, fewer, strict=True) if a != 9) < 0.25 * 1009
    for shards, slots in ((["a", "a"], 7), ([], 7), (["a"], 9), (["a"], 65_539)):
        with pytest.raises(ValueError):
            lookup_shards.fill_table(shards, slots)


def test_placement(docs_of, tmp_path):
    docs = docs_of([(None, "x"), (None, "y"), *enumerate("abcdef")]).withColumn("__at", F.lit(1))
    placed = lookup_shards.place(docs, ["a", "b", "c"], 101)
    assert placed.columns == [c for c in docs.columns if c != "shard"] + ["slot", "shard"]
    rows = placed.collect()
    assert len(rows) == 8 and len({r.shard for r in rows if r.doc_id is None}) == 1
    lookup_shards.write_shards(placed, f"{tmp_path}/out", files_per_shard=2)
    assert placed.sparkSession.read.parquet(f"{tmp_path}/out").count() == 8
    assert lookup_shards.place(docs_of([]), ["a"], 3).collect() == []
    plan = placed._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapIn" not in plan


def test_registered_queries(spark):
    found = entry.queries()
    assert [sum(k.startswith(f"op{n}_") for k in found) for n in range(1, 11)] == [1] * 10 and "pipeline" in found
    con = connect(SF)
    for key, sql in registry.oracle_sql().items():
        assert difference(found[key](spark, SF), con, sql) is None


def test_pipeline_stages_keep_their_promises(spark):
    docs = registry.table(spark, SF, "documents")
    names = docs.columns
    steps = [docs]
    for _, stage in corpus_pipeline.STAGES:
        steps.append(stage(spark, steps[-1], SF).cache())
    assert all(s.columns == names for s in steps[1:-1]) and steps[-1].columns == [*names, "slot", "shard"]
    good, kept, clean, mixed, placed = steps[1:]
    assert 0 < kept.count() <= good.count() <= docs.count()
    single = lsh_forest_rows(kept)
    assert single and all(single)
    bench = registry.table(spark, SF, "benchmark")
    judged = contamination([(r.doc_id, r.text) for r in kept.collect()], [tuple(r) for r in bench.select("item_id", "text").collect()], 13)
    assert sorted(r.doc_id for r in clean.collect()) == [r[0] for r in judged if not r[5]]
    assert mixed.select("doc_id").distinct().count() <= clean.count() and placed.count() == mixed.count()
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(r.doc_id for r in whole.collect()) == sorted(r.doc_id for r in placed.collect())


def lsh_forest_rows(docs):
    from pricetide.llm import lsh_forest

    return [r.kept for r in lsh_forest.near_duplicates(docs).collect()]


def test_words_of_a_batch_are_counted_not_sorted(monkeypatch):
    code = token_frames.Encoder(registry.byte_vocabulary(), 2)
    texts = ["a b a", "b", "", None, "two  spaces b", "c a c a", "a"]
    whole = [code._encode([t or ""])[0] + code.end for t in texts]

    def sorts(*_, **__):
        raise AssertionError("the words of a batch are sorted")

    monkeypatch.setattr(np, "unique", sorts)
    assert code.encode(texts) == whole
