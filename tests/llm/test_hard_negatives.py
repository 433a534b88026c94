"""Hard negatives against a brute-force restatement; bounds against products."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fleetwarden.llm import hard_negatives, products
from fleetwarden.llm.queries import QUERIES

LEAST, MOST = -(2**63), 2**63 - 1


def exact(x, scale=256):
    return int(x) * scale if abs(x) >= 2**53 else math.floor(x * scale)


def brute(rows, positives=5, negatives=10):
    """Rows (id, label, vector), anchors divisible by 100 -> set of results."""
    ok = [r for r in rows if None not in r[:2] and r[2] is not None and all(x is not None and math.isfinite(x) for x in r[2])]
    ok = [(i, y, [exact(x) for x in v], v) for i, y, v in ok]
    out = set()
    for i in {r[0] for r in ok if r[0] % 100 == 0}:
        _, y, v, _ = min((r for r in ok if r[0] == i), key=lambda r: (len(r[2]), r[3], r[1]))
        score = lambda w: max(LEAST, min(MOST, sum(a * b for a, b in zip(v, w))))
        others = sorted((-score(w), j, z) for j, z, w, _ in ok if j != i and len(w) == len(v))
        for s, j, _ in [o for o in others if o[2] == y][:positives]:
            fit = [o for o in others if o[2] != y and 30 * -s <= 100 * -o[0] <= 90 * -s][:negatives]
            out |= {(i, j, n + 1, k, -s, -t) for n, (t, k, _) in enumerate(fit)}
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").selectExpr(
        "*", "1 AS dim", "2 AS id", "'x' AS anchor", "3 AS rank"
    )


def found(vectors):
    got = [tuple(r) for r in hard_negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0).collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("seed,dim,n,labels", [(1, 24, 700, 4), (2, 3, 500, 2), (3, 40, 300, 30), (4, 1, 250, 3)])
def test_against_brute_force(spark, monkeypatch, seed, dim, n, labels):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)) / math.sqrt(dim) + (1 if seed == 2 else 0.2)
    x[n // 2 :] = x[rng.integers(0, n // 2, n - n // 2)]  # many ties
    label = np.where(rng.random(n) < 0.34, 0, rng.integers(0, labels, n))
    rows = [(int(i), int(y), v.tolist()) for i, y, v in zip(rng.permutation(n) * 5, label, x)]
    vectors = frame(spark, rows)
    want = brute(rows)
    assert found(vectors) == want and len(want) > 20
    monkeypatch.setattr(hard_negatives, "ROWS", 90)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 7)
    assert found(vectors) == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 0.5]), (1, 1, [1.0, 0.5]), (2, 1, [0.9, 0.5]), (3, 2, [0.5, 0.4]), (4, 2, [0.5, 0.4]), (5, 3, [0.1, 0.1]),
        (6, 2, None), (7, 2, [None, 1.0]), (8, 2, [nan, 1.0]), (9, 2, [inf, 1.0]), (10, None, [1.0, 1.0]), (None, 2, [1.0, 1.0]),
        (11, 2, [1.0]), (100, 5, [0.0]), (12, 5, [0.3]), (13, 5, []), (200, 5, []), (14, 6, []), (3, 2, [0.5, 0.4]), (300, 4, [1.0, 1.0]),
        (400, 1, [-1.0, -0.5]), (0, 1, [1.0, 0.5]), (0, 2, [1.0, 0.6]),
    ]
    got = found(frame(spark, rows))
    assert got == {g for g in brute([r for r in rows])}
    assert any(g[0] == 200 and g[3] == 14 for g in got)
    assert found(frame(spark, rows).limit(0)) == set()
    assert found(frame(spark, rows).where("vec_id % 100 <> 0")) == set()


def test_components_of_any_size(spark):
    rows = [
        (0, 1, [3e5, 1.0]), (1, 1, [3e5, 2.0]), (2, 2, [2e5, 1.0]), (3, 2, [1.0, 1.0]), (4, 2, [-3e5, 1.0]),
        (100, 3, [1e12, 0.5]), (5, 3, [1e12, 7.0]), (6, 4, [5e11, 1.0]), (7, 4, [1e306, 1.0]), (8, 3, [-1e306, 1.0]),
    ]
    got = found(frame(spark, rows))
    assert got == brute(rows)
    assert {g[3] for g in got if g[0] == 0} >= {2}


def test_a_third_of_rows_equal_and_of_one_label(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ROWS", 50)
    rng = np.random.default_rng(8)
    rows = [(i, 1, [0.5, 0.5, 0.5]) for i in range(300)]
    rows += [(i, int(rng.integers(2, 5)), (rng.random(3) * 0.8).tolist()) for i in range(300, 800)]
    assert found(frame(spark, rows)) == brute(rows)


@pytest.mark.parametrize("dim", [1, 3, 9, 64, 70])
def test_summaries_bound_products(dim):
    rng = np.random.default_rng(dim)
    a, b = rng.normal(size=(40, dim)), rng.normal(size=(50, dim))
    levels = products.levels(dim)
    for at in levels:
        (am, asd), (bm, bsd) = (products.rooted(*products.summary(x, at), at, dim) for x in (a, b))
        assert (np.abs(a @ b.T - am @ bm.T) <= asd @ bsd.T + 1e-9).all()
        for one, other in zip(products.coarser(*products.summary(a, levels[-1]), levels[-1], at, dim), products.summary(a, at)):
            assert np.allclose(one, other)


def survived(x, label, turn):
    """Share of the pairs of different labels whose product is taken, for 40 anchors with a band each."""
    scale, dim = 256, x.shape[1]
    whole = np.floor(x * scale)
    mean, spread = products.summary(whole @ turn, products.levels(dim)[-1])
    table = pa.table({"id": np.arange(len(x)), "label": label, "v": x.tolist(), "mean": mean.tolist(), "spread": spread.tolist()})
    c, q = products.Block(table, scale), products.Block(table.slice(0, 40), scale)
    same = np.where(label[:40, None] == label[None, :], whole[:40] @ whole.T, -np.inf)
    np.fill_diagonal(same, -np.inf)
    top = np.sort(same, axis=1)[:, -5:].astype(int).tolist()
    (_, _, _, scores), n = products.best_in_bands(q, c, False, *hard_negatives._bands(top, 30, 90), 10)
    return n / int((label[:40, None] != label[None, :]).sum())


def test_bounds_prune_where_vectors_have_structure():
    rng = np.random.default_rng(4)
    n, dim = 4000, 64
    label = rng.integers(0, 10, n)
    # Energy that falls with the direction, as in learned embeddings, under a hidden rotation.
    x = rng.normal(size=(n, dim)) * 0.8 ** np.arange(dim) + rng.normal(size=(10, dim))[label] * 0.8 ** np.arange(dim)
    x = x @ np.linalg.qr(rng.normal(size=(dim, dim)))[0]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    turn = np.linalg.eigh(x[:2048].T @ x[:2048])[1][:, ::-1]
    assert survived(x, label, turn) < 0.3


def test_query_in_blocks(spark, sf, monkeypatch):
    whole = {tuple(r) for r in QUERIES["op12_hard_negatives"](spark, sf).collect()}
    monkeypatch.setattr(hard_negatives, "ROWS", 100)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 2)
    assert whole == {tuple(r) for r in QUERIES["op12_hard_negatives"](spark, sf).collect()}
