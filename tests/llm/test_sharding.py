import zlib

import pytest
from pyspark.sql import functions as F

from fleetwarden.llm import sharding
from fleetwarden.llm.queries import QUERIES


@pytest.mark.parametrize("rows", [1, 2, 3, 7, 40, 41, 100, 961, 1000, 1023, 1025, 10_000])
def test_permutation_and_its_inverse(spark, rows):
    got = (
        spark.range(rows)
        .withColumn("at", sharding.permuted(F.col("id"), F.lit(rows)))
        .withColumn("back", sharding.permuted(F.col("at"), F.lit(rows), back=True))
        .collect()
    )
    assert sorted(r["at"] for r in got) == list(range(rows))
    assert all(r["back"] == r["id"] for r in got)


def test_shards_and_slots(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = QUERIES["op6_shards"](spark, sf).collect()
    text = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    assert len(rows) == len(text) and {r.doc_id for r in rows} == set(text)
    assert all(r.size == len(text[r.doc_id]) + 16 and r.text_crc32 == zlib.crc32(text[r.doc_id]) for r in rows)
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    counts = [len(slots.get(s, ())) for s in range(40)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    # The order is another one than the numbers', and the number can be computed back from shard and slot.
    assert sum(r.shard == r.row_number % 40 for r in rows) < len(rows) / 4
    back = QUERIES["op6_shards"](spark, sf).withColumn(
        "n", sharding.row_number_of(F.col("shard"), F.col("slot"), F.lit(len(rows)))
    )
    assert back.where("n <> row_number").count() == 0


def test_does_not_depend_on_partitions(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    one = {(r.id, r.shard, r.slot) for r in sharding.assign_shards(docs).collect()}
    assert one == {(r.id, r.shard, r.slot) for r in sharding.assign_shards(docs.repartition(7)).collect()}


def test_odd_rows(spark):
    rows = [(1, "a", 9), (1, "a", 9), (None, None, 9), (None, None, 9), (2, "", 9), (3, "é" * 300_000, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int").withColumn("number", F.lit("x"))
    got = sharding.assign_shards(docs).collect()
    assert sorted(r.number for r in got) == list(range(6))
    assert sorted(r.bytes for r in got) == [0, 0, 0, 1, 1, 600_000]
    full = sharding.sharded_documents(docs)
    assert full.columns == ["doc_id", "text", "number", "shard", "slot"]
    assert full.where("number = 'x'").count() == 6
    assert sharding.assign_shards(docs.limit(0)).count() == 0


def test_equal_rows_are_numbered_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(sharding, "HOT_ROWS", 50)
    monkeypatch.setattr(sharding, "SLICES", 64)
    rows = [(7, "same", i) for i in range(900)] + [(None, None, i) for i in range(700)] + [(i, f"t{i}", i) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, extra long")
    numbers = lambda d: sharding.numbered(d, "doc_id", "text", slices=64)
    got = {(r.id, r.number) for r in numbers(docs).collect()}
    assert sorted(n for _, n in got) == list(range(len(rows)))
    # The two large groups lie behind all others, each without a gap, whatever the layout of the input.
    assert got == {(r.id, r.number) for r in numbers(docs.repartition(5)).collect()}
    assert all(i in (7, None) for i, n in got if n >= 600) and None not in {i for i, n in got if n < 600}
    nulls = [n for i, n in got if i is None]
    assert len(nulls) == 700 and max(nulls) - min(nulls) == 699
    full = sharding.sharded_documents(docs)
    assert full.count() == len(rows) and full.select("shard", "slot").distinct().count() == len(rows)
    assert sorted(r.extra for r in full.where("doc_id IS NULL").collect()) == list(range(700))


def plain_place(number, rows, seed):
    """The permutation written out with whole numbers, given the hash of a round."""
    a = next(k for k in range(1, rows + 2) if k * k >= rows)
    b = -(-rows // a)
    while True:
        left, right = number % a, number // a
        for i in range(1, sharding.ROUNDS + 1):
            if i % 2:
                left = (left + seed(i, right) % a) % a
            else:
                right = (right + seed(i, left) % b) % b
        number = right * a + left
        if number < rows:
            return number


@pytest.mark.parametrize("rows", [10, 103])
def test_permutation_against_a_plain_one(spark, rows):
    halves = spark.range(rows + 2).crossJoin(spark.range(1, sharding.ROUNDS + 1).withColumnRenamed("id", "i"))
    hashes = {
        (r.i, r.id): r.h for r in halves.withColumn("h", F.xxhash64(F.lit(sharding.SEED), F.col("i").cast("int"), "id")).collect()
    }
    got = spark.range(rows).withColumn("at", sharding.permuted(F.col("id"), F.lit(rows))).collect()
    assert [r["at"] for r in got] == [plain_place(r["id"], rows, lambda i, h: hashes[i, h]) for r in got]
