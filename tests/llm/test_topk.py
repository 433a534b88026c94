import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fleetwarden.llm import products, topk


def brute(qid, q, cid, c, k):
    out = set()
    for i, v in zip(qid, q):
        found = sorted((-int(v @ w), int(j)) for j, w in zip(cid, c) if j != i)[:k]
        out |= {(int(i), j, -s) for s, j in found}
    return out


def top_products(qid, q, cid, c, k):
    """The search of one task, by vectors of whole numbers."""

    def block(ids, x):
        x = np.asarray(x, float)
        columns = {"id": pa.array(ids, pa.int64()), "v": x.tolist()}
        if products.levels(x.shape[1]):
            mean, spread = products.summary(x, products.levels(x.shape[1])[-1])
            columns |= {"mean": mean.tolist(), "spread": spread.tolist()}
        return products.Block(pa.table(columns), 1)

    least = np.full((len(qid), 1), products.LEAST)
    (row, _, ids, scores), _ = products.best_in_bands(block(qid, q), block(cid, c), None, least, np.full_like(least, products.MOST), k)
    return np.asarray(qid)[row], ids, scores


@pytest.mark.parametrize("seed,dim,n", [(1, 64, 900), (2, 3, 700), (3, 20, 30), (4, 1, 200)])
def test_exact(seed, dim, n, monkeypatch):
    monkeypatch.setattr(products, "STEP", 64)
    rng = np.random.default_rng(seed)
    c = rng.integers(-30, 30, (n, dim))
    c[n // 2 :] = c[rng.integers(0, n // 2, n - n // 2)]  # many ties
    cid = rng.permutation(n)
    q, qid = c[::7], cid[::7]
    got = top_products(qid, q, cid, c, 20)
    assert set(zip(*(x.tolist() for x in got))) == brute(qid, q, cid, c, 20)


def test_large_components_are_exact():
    big = np.array([[2**23, 2**23 - 1], [2**23 - 1, 2**23], [-(2**23), 1]], np.int64)
    got = top_products(np.array([0]), big[:1], np.arange(3), big, 5)
    assert list(zip(*(x.tolist() for x in got))) == [(0, 1, int(big[0] @ big[1])), (0, 2, int(big[0] @ big[2]))]


def test_large_negative_products_are_not_pruned(monkeypatch):
    monkeypatch.setattr(products, "STEP", 1)
    c = np.array([[2_000_000, 2_000_000], [2_000_000, 1_999_999], [2_000_001, 2_000_000]], np.int64)
    got = top_products(np.array([9]), np.array([[-1, -1]], np.int64), np.arange(3), c, 1)
    assert list(zip(*(x.tolist() for x in got))) == [(9, 1, -3_999_999)]


def test_finite_vectors_of_any_size_take_part(spark):
    rows = [(20, [1.0, 1.0]), (21, [300000.0, 1.0]), (22, [2.0, 1.0]), (40, [-1e300, 1.0]), (23, [1e13, 0.5])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in topk.top_k(vectors, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()]
    assert [g[2] for g in got if g[0] == 20] == [23, 21, 22, 40]
    assert got[0][3] == 64 * 64 * 10**13 + 64 * 32 and got[1][3] == 64 * 64 * 300_000 + 64 * 64
    assert got[3] == (20, 4, 40, -(2**63))
    assert {g[2] for g in got if g[0] == 40} == {20, 21, 22, 23}


def test_ties_of_equal_vectors_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 30)
    monkeypatch.setattr(topk, "QUERIES", 2)
    vectors = spark.createDataFrame([(i, [1.0, float(i % 2)]) for i in range(200)], "vec_id long, embedding array<double>")
    got = [tuple(r) for r in topk.top_k(vectors, F.col("vec_id") % 20 == 0).collect()]
    for q in range(0, 200, 20):
        assert sorted(g[1:3] for g in got if g[0] == q) == [(r + 1, i) for r, i in enumerate([i for i in range(40) if i != q][:20])]


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (1, [1.0, 0.5]), (2, [1.0, 0.5]), (20, [0.1, -0.2]), (3, None), (4, [None, 1.0]), (5, [nan, 1.0]),
            (6, [inf, 1.0]), (7, []), (8, [1.0]), (None, [1.0, 1.0]), (2, [1.0, 0.5])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "'x' AS v", "1 AS dim", "2 AS q")
    got = [tuple(r) for r in topk.top_k(vectors, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()]
    assert [g[:3] for g in got if g[0] == 0] == [(0, 1, 1), (0, 2, 2), (0, 3, 2), (0, 4, 20)]
    assert {g[2] for g in got if g[0] == 20} == {0, 1, 2}
    assert [g[3] for g in got if g[0] == 0][:1] == [64 * 64 + 32 * 32]
    assert topk.top_k(vectors.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert topk.top_k(vectors, F.lit(False)).count() == 0


def test_blocks(spark, sf, monkeypatch):
    from fleetwarden.llm.queries import QUERIES

    whole = {tuple(r) for r in QUERIES["op8_top_products"](spark, sf).collect()}
    monkeypatch.setattr(topk, "CANDIDATES", 100)
    monkeypatch.setattr(topk, "QUERIES", 9)
    assert whole == {tuple(r) for r in QUERIES["op8_top_products"](spark, sf).collect()}
