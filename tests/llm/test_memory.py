"""What a Python worker holds at once, and how many workers an executor needs."""

from types import SimpleNamespace

import pyarrow as pa
import pytest

from pricetide.llm import lsh_forest, mixing, suffix_automaton, weak_labels
from pricetide.llm.words import PIECE, pieces

LONG = "a few words of a text that goes on and on " * 500


def batch_of(texts):
    n = len(texts)
    return pa.RecordBatch.from_pydict(
        {"doc_id": pa.array(range(n), pa.int64()), "text": pa.array(texts, pa.string()), "source": pa.array(["s"] * n)}
    )


def function_of(spark, job):
    """The function that a job gives to ``mapInArrow``."""
    docs = SimpleNamespace(sparkSession=spark, schema=None, mapInArrow=lambda run, schema: run)
    docs.select = lambda *columns: docs
    return job(docs)


@pytest.mark.parametrize("texts", [[], [None, ""], [None] * 30, [LONG] * 3, ["x", LONG * 100, None, "y"] * 3, [LONG, "é"] * 200])
def test_pieces_hold_every_row_once(texts):
    batch = batch_of(texts)
    got = list(pieces(iter([batch, batch.slice(1)])))
    assert pa.Table.from_batches(got) == pa.Table.from_batches([batch, batch.slice(1)])
    for b in got:
        sizes = [len((t or "").encode()) for t in b.column("text").to_pylist()]
        assert sum(sizes) - max(sizes, default=0) <= PIECE


@pytest.mark.parametrize("name", ["keep", "sketches", "word_counts"])
def test_a_batch_of_long_texts_is_not_held_as_a_whole(spark, name):
    none = weak_labels.learn([], [], [])
    job = {"keep": lambda d: weak_labels.keep(d, none), "sketches": lsh_forest.sketches, "word_counts": mixing.word_counts}[name]
    found = [b.num_rows for b in function_of(spark, job)(iter([batch_of([LONG] * 300)]))]
    assert sum(found) == 300 and max(found) * len(LONG) <= 2 * PIECE


def test_decontamination_takes_one_python_step(spark, docs_of, capsys):
    items = spark.createDataFrame([("q", "a few words of a text that goes on and on")], "item_id string, text string")
    clean = suffix_automaton.remove(docs_of([LONG, "clean", None]), items)
    clean.explain()
    assert capsys.readouterr().out.count("MapInArrow") == 1
    assert sorted(r.doc_id for r in clean.collect()) == [1, 2]


def test_the_sample_is_not_read_by_python_workers(spark, docs_of, monkeypatch):
    """Rows from a list go through Python workers, on a cluster with a daemon of their own."""
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(4)], "doc_id long, quality int, toxic int")
    docs, made = docs_of(["one two", "three", None, "four"]), []
    create = type(spark).createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda s, data, *a, **k: made.append(data) or create(s, data, *a, **k))
    weak_labels.fit(docs, labels)
    assert made and not any(isinstance(data, list) for data in made)
