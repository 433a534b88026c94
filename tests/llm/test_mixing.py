import numpy as np
import pytest

from fleetwarden.llm import mixing
from fleetwarden.llm.queries import QUERIES


def plain_targets(sizes):
    """sizes by source in order -> targets, by sharing out again and again."""
    weights = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
    target, full, rest = [0.0] * len(sizes), set(), 1.5 * sum(sizes)
    while True:
        open_ = [i for i in range(len(sizes)) if i not in full]
        total = sum(weights[i] for i in open_)
        over = [i for i in open_ if rest * weights[i] / total >= 2 * sizes[i]]
        if not over:
            for i in open_:
                target[i] = rest * weights[i] / total
            return target
        for i in over:
            target[i] = 2.0 * sizes[i]
            rest -= target[i]
            full.add(i)


@pytest.mark.parametrize("sizes", [[10], [10, 10, 10], [1, 1000, 5], [100, 1, 1, 1, 900, 3, 3], [7, 0, 9], [5, 50, 500, 5000]])
def test_targets(spark, sizes):
    rows = [(chr(97 + i) if i < len(sizes) - 1 else None, s) for i, s in enumerate(sizes)]
    got = mixing.source_targets(spark.createDataFrame(rows, "source string, source_size long")).orderBy("rank").collect()
    assert [r.target for r in got] == pytest.approx(plain_targets(sizes))
    assert sum(r.target for r in got) == pytest.approx(1.5 * sum(sizes))


def test_flight_balances_and_keeps_chances():
    sizes = np.array([5, 9, 9, 14, 30, 2, 7, 7, 1, 22] * 30)
    chances = np.full(len(sizes), 0.3)
    taken = np.zeros(len(sizes))
    for seed in range(400):
        flown = mixing.fly(sizes, chances, np.random.default_rng(seed), land=False)
        assert ((flown > 0) & (flown < 1)).sum() <= 2
        assert flown.sum() == pytest.approx(chances.sum()) and flown @ sizes == pytest.approx(chances @ sizes)
        landed = mixing.fly(sizes, chances, np.random.default_rng(seed), land=True)
        assert set(landed) <= {0.0, 1.0} and abs(landed.sum() - chances.sum()) <= 1
        assert abs(landed @ sizes - chances @ sizes) <= 2 * sizes.max()
        taken += landed
    # Every unit is taken with its own chance: 400 draws of 0.3 lie within 5 deviations.
    assert np.abs(taken / 400 - 0.3).max() < 5 * (0.3 * 0.7 / 400) ** 0.5
    assert abs(taken.mean() / 400 - 0.3) < 0.005


def test_query(spark, sf):
    docs = {r.doc_id: (r.source, len((r.text or "").split())) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    first = QUERIES["op7_mix"](spark, sf).collect()
    assert sorted((r.doc_id, r.taken) for r in first) == sorted((r.doc_id, r.taken) for r in QUERIES["op7_mix"](spark, sf).collect())
    assert len(first) == len(docs) and all(0 <= r.taken <= 2 * r.size for r in first)
    sources = sorted({s for s, _ in docs.values()})
    sizes = [sum(r.size for r in first if r.source == s) for s in sources]
    want = plain_targets(sizes)
    for s, size, target in zip(sources, sizes, want):
        own = [r for r in first if r.source == s]
        assert {r.source_size for r in own} == {size} and own[0].target == pytest.approx(target)
        assert abs(sum(r.taken for r in own) - target) <= 2 * max(r.size for r in own)


def test_many_tasks_per_source(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 16)
    monkeypatch.setattr(mixing, "FAN", 3)
    rows = [(i, "w " * (1 + i * 7 % 23), "a" if i % 3 else "b") for i in range(900)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len(got) == 900
    for s in "ab":
        own = [r for r in got if r.source == s]
        assert abs(sum(r.size * r.copies for r in own) - own[0].target) <= 46


def test_odd_rows(spark):
    rows = [(1, None, None), (None, "a b", "x"), (2, "", "x"), (3, "a b c", None), (3, "a b c", None), (4, "w " * 300_000, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS copies", "2 AS _row")
    got = mixing.mix(docs).collect()
    assert sorted(r.size for r in got) == [0, 0, 2, 3, 3, 300_000]
    assert all(0 <= r.copies <= 2 for r in got)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    assert out.count() == sum(r.copies for r in got)
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.mixed_documents(docs.limit(0)).count() == 0


def test_large_ids_beside_a_null_id(spark):
    rows = [(None, "a b c", "x"), (2**62 + 1, "a b", "x"), (2**62 + 3, "a", "x"), (5, "a", "y")]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert {r.id for r in got.collect()} == {r[0] for r in rows} and got.schema["id"].dataType.simpleString() == "bigint"


def test_equal_rows_are_dealt_to_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 64)
    monkeypatch.setattr(mixing, "PIECE", 8)
    seen = spark.sparkContext.accumulator(0)
    largest = 200
    plain = mixing._flight

    def watched(level, last, seed):
        run = plain(level, last, seed)

        def inner(pdf):
            if pdf["n"].sum() > largest:
                seen.add(1)
            return run(pdf)

        return inner

    monkeypatch.setattr(mixing, "_flight", watched)
    rows = [(None, "a b c", "x")] * 3000 + [(i, "w " * (1 + i % 9), "x") for i in range(1000)] + [(i, "w w", "y") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows) and seen.value == 0
    for s in "xy":
        own = [r for r in got if r.source == s]
        assert abs(sum(r.size * r.copies for r in own) - own[0].target) <= 18
    count = lambda d: sorted((str(r.id), r.size, r.copies) for r in d)
    assert count(got) == count(mixing.mix(docs.repartition(3)).collect())
