"""The stages on the smallest tables, each against what its own input says."""

from collections import Counter

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from fleetwarden.llm.queries import QUERIES
from tests.llm.test_decontaminate import plain
from tests.llm.test_mixing import plain_targets
from tests.llm.test_near_dups import brute


@pytest.fixture(scope="module")
def steps(spark, sf, tmp_path_factory):
    """Each stage's input and output, through Parquet as in production."""
    folder, out = str(tmp_path_factory.mktemp("stages")), {}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(f"{folder}/{name}")
        result = spark.read.parquet(f"{folder}/{name}")
        out[name] = (docs, result)
        docs = result
    return out


def texts(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_columns(steps):
    for name, (before, after) in steps.items():
        assert after.columns == (before.columns if name != "shard" else [*before.columns, "shard", "slot"])


def test_language_keeps_everything_with_letters(steps):
    before, after = (Counter(texts(df)) for df in steps["language"])
    assert after <= before
    assert all(sum(c.isalpha() for c in t or "") < 20 for _, t in (before - after))


def test_one_document_of_each_group(steps):
    before, after = (texts(df) for df in steps["near_dedup"])
    assert sorted(i for i, _ in after) == sorted(set(brute(before).values()))


def test_no_benchmark_item_is_left(spark, sf, steps):
    before, after = (dict(texts(df)) for df in steps["decontaminate"])
    items = [plain(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    leaks = {i for i, t in before.items() if any(b in plain(t) for b in items)}
    assert not leaks & set(after)
    assert len(before) - len(after) <= len(leaks) + 2


def test_mix_meets_its_targets(steps):
    before, after = (df.collect() for df in steps["mix"])
    words = lambda r: len((r.text or "").split())
    sources = sorted({r.source for r in before})
    want = plain_targets([sum(words(r) for r in before if r.source == s) for s in sources])
    for s, target in zip(sources, want):
        largest = max(words(r) for r in before if r.source == s)
        assert abs(sum(words(r) for r in after if r.source == s) - target) <= 2 * largest
    assert max(Counter(r.doc_id for r in after).values()) <= 2


def test_shards(steps):
    before, after = (df.collect() for df in steps["shard"])
    assert Counter((r.doc_id, r.text) for r in before) == Counter((r.doc_id, r.text) for r in after)
    slots = {}
    for r in after:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(len(slots.get(s, ())) for s in range(40)) <= 1


def test_run_equals_the_stages(spark, sf, steps):
    got = Counter((r.doc_id, r.shard, r.slot) for r in corpus_pipeline.run(spark, sf).collect())
    assert got == Counter((r.doc_id, r.shard, r.slot) for r in steps["shard"][1].collect())


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert {"op1_url_lists", "op3_line_dedup", "op8_top_products", "op10_revisits"} <= set(oracle_sql())
