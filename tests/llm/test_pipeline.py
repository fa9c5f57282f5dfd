"""The stages of the pipeline on odd rows, one by one and together."""

import pytest

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, __row string, shard int, kin long, key long"
WORDS = "the quick brown fox jumps over the lazy dog and runs through the wide green field until night falls on all of it"


def rows():
    odd = [
        (1, None, None, None), (2, "", "en", "a"), (3, " \t\n", "en", None), (None, WORDS + " unnamed", "en", "a"),
        (None, None, None, None), (4, "one", None, "b"), (5, "word " * 50_000, "en", "b"), (6, WORDS, "en", "a"),
        (6, WORDS, "en", "a"), (7, WORDS + " again", "en", "b"), (8, "été à l'école " * 40, "fr", None),
    ]
    many = [(100 + i, " ".join(f"w{(i * 31 + j * 7) % 997}" for j in range(60 + i)), "en", "ab"[i % 2]) for i in range(40)]
    return [(i, t, la, s, None if t is None else len(t), "x", 7, 5, 6) for i, t, la, s in odd + many]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables beside the documents; in the second place all are empty."""
    places = []
    for n, empty in enumerate((False, True)):
        place = f"{tmp_path_factory.mktemp('p')}/{n}"
        tables = {
            "documents": (rows(), SCHEMA),
            "labels": ([(i, None if i % 5 == 4 else i % 2, 0) for i in range(100, 140)] + [(6, None, 1), (None, 0, 1), (6, 1, None)],
                       "doc_id long, quality int, toxic int"),
            "benchmark": ([("q1", None), ("q2", ""), (None, "the the"), ("q3", " ".join(f"w{j}" for j in range(20)))],
                          "item_id string, text string"),
        }
        for name, (data, schema) in tables.items():
            spark.createDataFrame([] if empty else data, schema).write.parquet(f"{place}/{name}.parquet")
        places.append(place)
    return places


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_a_stage_takes_odd_rows(spark, folder, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    for place in folder:
        docs = spark.read.parquet(f"{place}/documents.parquet")
        found = stage(spark, docs, place)
        columns = [c for c in docs.columns if name != "sharding" or c not in ("slot", "shard")]
        columns += ["slot", "shard"] if name == "sharding" else []
        assert found.columns == columns
        got, given = found.collect(), docs.collect()
        assert {(r.doc_id, r.text) for r in got} <= {(r.doc_id, r.text) for r in given}
        if name in ("quality", "near_dedup", "decontamination") and given:
            kept = {(r.doc_id, r.text) for r in got}
            assert {(1, None), (2, ""), (3, " \t\n")} <= kept
        if name == "near_dedup" and given:
            assert sum(r.doc_id == 6 for r in got) == 1 and all(r.doc_id != 7 for r in got)
        if name == "sharding":
            assert len(got) == len(given)


def test_the_pipeline_takes_odd_rows_and_empty_tables(spark, folder):
    full, empty = folder
    found = corpus_pipeline.run(spark, full)
    assert found.count() > 0 and corpus_pipeline.run(spark, empty).count() == 0
