"""Source divergence against a plain restatement with Python's whole numbers."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from fleetwarden.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=10):
    """Rows (text, lang, source) -> set of (lang, source, part, item, value, rank)."""
    rows = [tuple(x or "" for x in r) for r in rows]
    out = set()
    for lang in {r[1] for r in rows}:
        docs = [(r[2], Counter(TERM.findall(r[0].translate(LOWER)))) for r in rows if r[1] == lang]
        spread = Counter(t for _, c in docs for t in c)
        kept = sorted(t for t, n in spread.items() if n >= least)
        counts = {s: Counter() for s, _ in docs}
        for s, c in docs:
            counts[s].update({t: c[t] for t in kept if t in c})
        whole = sum(counts.values(), Counter())

        def share(of):
            total = sum(of.values())
            return {t: 1 + 1000000000 * (of[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p, q = {s: share(c) for s, c in counts.items()}, share(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in counts:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in counts if o != s]
            words = [(-f(p[s][t], q[t]), t.encode()) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(words)[:10])):
                out |= {(lang, s, part, item.decode(), -v, i + 1) for i, (v, item) in enumerate(found)}
    return out


def result(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def sample(n, seed):
    rng = random.Random(seed)
    words = ["the", "The", "of", "straße", "ÉTÉ", "été", "naïve", "x1y", "a-b", "漢字", "𐐀", "\x7f", "12", "don't", "\x00z"]
    rows = []
    for _ in range(n):
        text = "  ".join(rng.choices(words, k=rng.randint(0, 30))) if rng.random() > 0.1 else rng.choice([None, "", "123 !!"])
        rows.append((text, rng.choice(["en", "de", "", None]), rng.choice(["a", "b", "c", "Z", "é", None, ""])))
    return rows


@pytest.mark.parametrize("terms,pairs", [(4096, 4_000_000), (2, 9)])
def test_against_plain_restatement(spark, monkeypatch, terms, pairs):
    monkeypatch.setattr(divergence, "TERMS", terms)
    monkeypatch.setattr(divergence, "PAIRS", pairs)
    rows = sample(400, 7) + [("only here " * 3, "rare", "a"), (None, "rare", "b"), ("same " * 50, "en", "a")] + [("common row", "en", "hot")] * 200
    docs = spark.createDataFrame(rows, "text string, lang string, source string").selectExpr(
        "*", "1 AS term", "2 AS sources", "'x' AS value"
    )
    got = result(divergence.source_divergence(docs.repartition(5)))
    assert got == brute(rows)
    assert {g[0] for g in got} == {"en", "de", "", "rare"}
    assert ("rare", "a", "pair", "b", 0, 1) in got


def test_stripes_given_out_early_merge_to_the_same(monkeypatch):
    rows = [tuple(x or "" for x in r) for r in sample(120, 9)]
    batch = pa.table({"text": [r[0] for r in rows], "lang": [r[1] for r in rows], "source": [r[2] for r in rows]}).to_batches()
    whole = list(divergence.fold(iter(batch)))
    monkeypatch.setattr(divergence, "CELLS", 15)
    early = list(divergence.fold(iter(batch)))
    assert len(whole) == 1 and len(early) > 5
    ordered = pa.Table.from_batches(early).sort_by([("lang", "ascending"), ("term", "ascending")])

    def cells(table):
        return {(r["lang"], r["term"]): (r["documents"], dict(zip(r["sources"], r["counts"]))) for r in table.to_pylist()}

    merged = pa.Table.from_batches(list(divergence.merge(iter(ordered.to_batches(max_chunksize=7)))))
    assert merged.num_rows == len(cells(merged))
    assert cells(merged) == cells(pa.Table.from_batches(whole))
    few = pa.Table.from_batches(list(divergence.merge(iter(ordered.to_batches(max_chunksize=7)), 10)))
    assert cells(few) == {k: v for k, v in cells(merged).items() if v[0] >= 10 or k[1] == ""}


def test_shares_beyond_64_bits():
    counts = np.array([[9 * 10**12, 5], [0, 10**10]])
    got = divergence.shares(counts, [10**13, 10**10 + 7], 3)
    want = [[1 + 10**9 * (c + 2) // (t + 6) for c, t in zip(row, (10**13, 10**10 + 7))] for row in counts.tolist()]
    assert got.tolist() == want and got.dtype == np.int64
    assert divergence.divergence(np.array([10**9 + 1]), np.array([1])).tolist() == [(10**9) ** 2 // (10**9 + 2)]


def test_odd_tables(spark):
    schema = "text string, lang string, source string"
    assert divergence.source_divergence(spark.createDataFrame([], schema)).count() == 0
    assert divergence.source_divergence(spark.createDataFrame([(None, None, None)], schema)).count() == 0
    long = "word other " * 200_000
    rows = [(long, "en", "a")] * 10 + [("word", "en", "b")]
    assert result(divergence.source_divergence(spark.createDataFrame(rows, schema))) == brute(rows)
