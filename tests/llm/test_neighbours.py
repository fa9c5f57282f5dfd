"""Nearest neighbours by NN-descent, against comparing everything."""

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from pricetide.llm import nn_descent

SCHEMA = "vec_id long, embedding array<double>"


def brute_force(rows, k=10, every=100):
    """Lists of (score, id) of each query; equal rows count once."""
    good = sorted({(i, tuple(v)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)})
    out = {}
    for i, v in good:
        if i % every:
            continue
        near = [(float(np.sqrt(((np.array(v) - np.array(w)) ** 2).sum())), j) for j, w in good if j != i and len(w) == len(v)]
        out[i] = sorted(near)[:k]
    return out


def found(df, **options):
    lists = {}
    for r in nn_descent.nearest(df, **options).orderBy("query_id", "rank").collect():
        lists.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r["rank"] == len(lists[r.query_id])
    return lists


def recall(got, expected):
    right = sum(len({i for _, i in got.get(q, [])} & {i for _, i in near}) for q, near in expected.items())
    return right / sum(len(near) for near in expected.values())


def test_all_neighbours_of_a_small_table_with_ties_and_copies(spark):
    draw = np.random.default_rng(3)
    rows = [(i, draw.normal(size=6).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[100][1]) for i in range(40)]  # copies of a query
    rows += [(2000 + i, rows[7][1]) for i in range(20)]
    rows += [rows[5], rows[100]]  # a row twice
    rows += [(400, None), (401, []), (402, [0.0] * 6), (403, [float("nan")] * 6), (404, [None] * 6), (None, rows[3][1])]
    rows += [(500 + i, [float(i), 1.0]) for i in range(5)]  # another length, fewer than ten
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("node", "data", "code", "rank", "q")})
    got, expected = found(df), brute_force(rows)
    assert got.keys() == expected.keys()
    for q, near in expected.items():
        assert [i for _, i in got[q]] == [i for _, i in near]
        np.testing.assert_allclose([s for s, _ in got[q]], [s for s, _ in near], rtol=1e-12, atol=1e-12)


def test_no_rows_and_one_row(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == {}
    assert found(spark.createDataFrame([(0, [1.0])], SCHEMA)) == {}
    assert found(spark.createDataFrame([(0, [1.0]), (1, [3.0])], SCHEMA)) == {0: [(2.0, 1)]}


@pytest.mark.parametrize("kind", ["clusters", "even"])
def test_recall_and_scores(spark, monkeypatch, kind):
    """Windows far smaller than the table, so that joins and search have to find the rest."""
    monkeypatch.setattr(nn_descent, "WINDOW", 256)
    draw = np.random.default_rng(4)
    v = draw.normal(size=(4000, 16))
    if kind == "clusters":  # tight ones far from each other and from the origin
        v = 50 + 10 * draw.normal(size=(40, 16))[draw.integers(0, 40, 4000)] + 0.2 * v
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    got, expected = found(spark.createDataFrame(rows, SCHEMA), every=50), brute_force(rows, every=50)
    assert recall(got, expected) >= 0.95
    for q, near in got.items():
        for score, i in near:
            np.testing.assert_allclose(score, np.linalg.norm(v[q] - v[i]), rtol=1e-12)


def test_recall_on_the_given_table(spark):
    path = "/root/testdata/sf0.1/embeddings.parquet"
    table = pq.read_table(path)
    v = np.array(table["embedding"].to_pylist(), np.float64)
    ids = table["vec_id"].to_numpy()
    got = found(spark.read.parquet(path))
    expected = {}
    for i in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((v - v[i]) ** 2).sum(1))
        d[i] = np.inf
        near = np.lexsort((ids, d))[:10]
        expected[int(ids[i])] = [(d[j], int(ids[j])) for j in near]
    assert recall(got, expected) >= 0.95
