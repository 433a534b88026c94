import random
from collections import Counter

import numpy as np
import pytest
import regex

from fleetwarden.llm import near_dups as nd
from fleetwarden.llm.components import components
from fleetwarden.llm.queries import QUERIES

TOKEN = regex.compile(r"[\p{L}\p{M}\p{N}]+")


def bag(text):
    words = TOKEN.findall((text or "").lower())
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else None


def similarity(a, b):
    return sum((a & b).values()) / sum((a | b).values())


def brute(rows):
    """Rows (id, text) -> {id: smallest id that a chain of pairs at 0.8 or more reaches}."""
    bags, head = {i: bag(t) for i, t in rows}, {i: i for i, _ in rows}

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    holders = {}
    for i, b in bags.items():
        for s in b or ():
            holders.setdefault(s, []).append(i)
    for a, b in {(a, b) for v in holders.values() for a in v for b in v if a < b}:
        if similarity(bags[a], bags[b]) >= 0.8:
            x, y = find(a), find(b)
            head[max(x, y)] = min(x, y)
    return {i: find(i) for i in bags}


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(1)
    a = {i: int(rng.integers(1, 6)) for i in range(300)}
    b = a | {i: int(rng.integers(1, 9)) for i in range(60)} | {i: 2 for i in range(300, 330)}
    rows = [(n, k, w) for n, x in enumerate((a, b)) for k, w in x.items()]
    doc, key, weight = (np.array(x) for x in zip(*rows))
    want = similarity(Counter(a), Counter(b))
    signatures = [nd.bag_min_hash(doc, nd._mix(key.astype(np.uint64)), weight, 2, 160, seed=s) for s in range(40)]
    got = [float((s[0] == s[1]).mean()) for s in signatures]
    assert abs(np.mean(got) - want) < 4 * (want * (1 - want) / 160 / 40) ** 0.5


def test_signature_does_not_depend_on_company():
    rng = np.random.default_rng(2)
    key, weight = nd._mix(np.arange(50, dtype=np.uint64)), rng.integers(1, 9, 50)
    alone = nd.bag_min_hash(np.zeros(50, np.int64), key, weight, 1, 40)
    more = nd.bag_min_hash(np.repeat([0, 1], [50, 2]), np.append(key, key[:2]), np.append(weight, [1, 1]), 3, 40)
    assert (alone[0] == more[0]).all() and (more[2] == 0).all()


def test_tables_against_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r.doc_id: r.class_id for r in QUERIES["op5_near_duplicates"](spark, sf).collect()}
    assert got == brute(rows)


def near_copies(seed, n):
    """A large group of near copies that differ from each other too, with a few at the threshold and strangers."""
    draw = random.Random(seed)
    words = [f"w{draw.randrange(4000)}" for _ in range(120)]
    rows = []
    for i in range(n):
        own = list(words)
        for _ in range(draw.randrange(0, 5)):
            own[draw.randrange(len(own))] = f"x{draw.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    rows += [(n + i, " ".join(f"w{draw.randrange(4000)}" for _ in range(90))) for i in range(30)]
    rows += [(n + 30 + i, " ".join(words[:60] + [f"y{draw.randrange(10**6)}" for _ in range(60)])) for i in range(40)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_large_group_against_brute_force(spark, seed):
    rows = near_copies(seed, 150)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.id: r.class_id for r in nd.near_duplicates(docs).collect()} == brute(rows)


def test_odd_rows(spark):
    text = "one two three four five six seven"
    rows = [(1, None), (2, ""), (3, " . "), (4, text), (5, text.upper()), (6, text), (6, text), (7, "one two"), (8, "two"),
            (9, "One, two!"), (None, text), (10, "z " * 60_000), (11, "z " * 60_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS node", "2 AS label", "'q' AS a")
    got = Counter((r.id, r.class_id) for r in nd.near_duplicates(docs).collect())
    want = {(1, 1): 1, (2, 2): 1, (3, 3): 1, (4, 4): 1, (5, 4): 1, (6, 4): 2, (7, 7): 1, (8, 8): 1, (9, 7): 1, (None, 4): 1, (10, 10): 1, (11, 10): 1}
    assert got == want
    kept = nd.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 7, 8, 10]
    assert nd.near_duplicates(docs.limit(0)).count() == 0
    assert nd.without_near_duplicates(docs.limit(0)).count() == 0


def test_one_row_of_each_group_stays(spark):
    def copies(word):
        return [" ".join([f"{word}{i}" for i in range(60)] + [end]) for end in ("x", "y", "z")]

    unnamed, shared, mixed = copies("a"), copies("b"), copies("c")
    rows = [(None, t) for t in [*unnamed, unnamed[0]]] + [(5, shared[0]), (5, shared[1]), (9, shared[2])]
    rows += [(None, mixed[0]), (None, mixed[1]), (12, mixed[2])] + [(None, "alone one"), (None, "alone two"), (None, "alone two"), (None, None)]
    kept = nd.without_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter(r.text in unnamed for r in kept)[True] == 1
    assert [r.doc_id for r in kept if r.text in shared] == [5]
    assert [r.doc_id for r in kept if r.text in mixed] == [12]
    assert sorted(r.text or "" for r in kept if r.text not in unnamed + shared + mixed) == ["", "alone one", "alone two"]


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (7, 3), (200, 200)]
    got = {r.node: r.label for r in components(spark.createDataFrame(chain, "x long, y long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 103: 100}
    assert components(spark.createDataFrame([], "x long, y long")).count() == 0


def test_copies_without_ids_are_one_text(spark):
    one = [f"w{i}" for i in range(60)]
    near = " ".join([*one[:-1], "zz"])
    rows = [(None, " ".join(one))] * 200 + [(None, near)] * 200 + [(7, "x y z q r s"), (7, "x y z q r s"), (7, "other words here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    held = docs.selectExpr("coalesce(doc_id, xxhash64(text)) AS node", "xxhash64(text) AS a", "xxhash64(text, 1) AS b", "text")
    nodes = held.groupBy("node", "a", "b").count().withColumnRenamed("count", "copies")
    assert nd.texts_of_nodes(held, nodes).count() == 4
    got = nd.near_duplicates(docs).collect()
    first = [r for r in got if r["id"] is None]
    assert len({r["class_digest"] for r in first}) == 1 and all(r["class_id"] is None for r in first)
    assert len({r["digest"] for r in first if r["stays"]}) == 1


def test_query_marks_one_text_of_each_class(spark, tmp_path):
    words = [f"w{i}" for i in range(60)]
    text, near = " ".join(words), " ".join([*words[:-1], "end"])
    far = " ".join(reversed(words))
    rows = [(None, text), (None, near), (None, far), (None, far + " more"), (1, "one text of two under an id " + text[:40]), (1, "else")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op5_near_duplicates"](spark, str(tmp_path)).collect()
    classes = {}
    for r in got:
        classes.setdefault(r["class_digest"], []).append(r["is_representative"])
    assert sorted(map(sorted, classes.values())) == [[False, True], [False, True], [True], [True]]
