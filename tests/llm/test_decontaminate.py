import random

import numpy as np

from fleetwarden.llm import decontaminate as dc
from fleetwarden.llm.queries import QUERIES


def plain(text):
    """Characters as compared: lower case, one blank for other signs."""
    out = []
    for c in text:
        c = c.lower()[0] if c.isalnum() else " "
        if c != " " or not out or out[-1] != " ":
            out.append(c)
    return "".join(out)


def distance(passage, text):
    """Least edits between the passage and any part of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(passage):
        new = [i + 1]
        for j, x in enumerate(text):
            new.append(min(row[j] + (c != x), row[j + 1] + 1, new[-1] + 1))
        row = new
    return min(row)


def edited(draw, text, edits):
    out = list(text)
    for _ in range(edits):
        at = draw.randrange(len(out))
        kind = draw.randrange(3)
        if kind == 0:
            out[at] = draw.choice("abcdxyz")
        elif kind == 1:
            out.insert(at, draw.choice("abcdxyz"))
        else:
            del out[at]
    return "".join(out)


def test_search_equals_plain_alignment(spark, sf):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    index, draw, within = dc.Index(items), random.Random(5), 0
    for _ in range(30):
        k = draw.randrange(len(index.length))
        passage = "".join(map(chr, index.points[k]))
        text = "qq zz " * 6 + edited(draw, passage, draw.randrange(0, 9)) + " zz" * 9
        points = dc.normalised(text)[0]
        best = distance(passage, plain(text))
        found = [e for p, e, _, _ in dc.search(index, points) if p == k]
        assert (min(found) == best) if best <= index.budget[k] else not found
        within += best <= index.budget[k]
    assert 5 < within < 30


def test_digests_are_equal_for_equal_grams():
    points = np.array([1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 12], np.uint32)
    for q in (1, 2, 3, 7, 10):
        got = dc.gram_digests(points, q)
        grams = [tuple(points[i : i + q]) for i in range(len(points) - q + 1)]
        assert len(got) == len(grams) and len(set(got.tolist())) == len(set(grams))
        assert all((got[i] == got[j]) == (grams[i] == grams[j]) for i in range(len(grams)) for j in range(i))
    assert len(dc.gram_digests(points[:5], 10)) == 0


def test_query_finds_every_whole_item_and_nothing_else(spark, sf):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id) for r in QUERIES["op4_benchmark_hits"](spark, sf).collect()}
    whole = {(d, i) for d, t in docs.items() for i, b in items.items() if plain(b) in plain(t)}
    assert whole <= got
    passages = dc.Index(list(items.items()))
    for d, i in got - whole:
        own = [k for k in range(len(passages.item)) if passages.item[k] == i]
        assert any(distance("".join(map(chr, passages.points[k])), plain(docs[d])) <= passages.budget[k] for k in own)


ITEM = "It was the best of times it was the worst of times it was the age of wisdom it was the age of foolishness and belief"


def test_places_slices_blocks_and_odd_rows(spark, monkeypatch):
    filler = "lorem ipsum dolor sit amet consectetur " * 400
    rows = [(1, None), (2, ""), (3, "short"), (4, filler + ITEM.upper().replace(" ", " - ") + filler), (4, filler + ITEM),
            (5, filler), (6, ITEM[:60] + ITEM[61:]), (6, ITEM[:60] + ITEM[61:]), (None, ITEM)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS item_id", "'x' AS row_id")
    items = spark.createDataFrame([(7, ITEM), (7, ITEM), (8, "tiny"), (9, None), (None, "x")], "item_id long, text string")

    def hits(frame=docs):
        return {(r.row_id, r.item_id, r.edits, r.text_start) for r in dc.benchmark_hits(frame, items).collect()}

    want = {(4, 7, 0, len(filler)), (6, 7, 1, 0), (None, 7, 0, 0)}
    first = hits()
    assert {w[:2] for w in first} == {w[:2] for w in want} and (4, 7, 0, len(filler)) in first
    kept = dc.without_benchmark(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 5]
    monkeypatch.setattr(dc, "SLICE", 500)
    monkeypatch.setattr(dc, "BLOCK", 60)
    assert hits() == first
    assert hits(docs.limit(0)) == set()
    assert dc.benchmark_hits(docs, items.limit(0)).count() == 0
    assert dc.without_benchmark(docs, items.limit(0)).count() == len(rows)


def distances(passages, text):
    """distance() of passages of one length, side by side."""
    row = np.zeros((len(text) + 1, len(passages)), np.int64)
    for i in range(passages.shape[1]):
        new = np.full_like(row, i + 1)
        for j, x in enumerate(text):
            new[j + 1] = np.minimum(np.minimum(row[j] + (passages[:, i] != x), row[j + 1] + 1), new[j] + 1)
        row = new
    return row.min(axis=0)


LONG = ITEM + " it was the season of light and of darkness the spring of hope and the winter of despair we had all before us"


def test_quotes_count_wherever_they_start():
    index, least = dc.Index([(7, LONG)]), min(dc.LENGTHS)
    item, draw, within = plain(LONG), random.Random(3), 0
    assert least <= 80
    for at in range(len(item) - least + 1):
        text = "qq zz qq zz qqq" + item[at : at + least] + "q zz zz"
        found = dc.search(index, dc.normalised(text)[0])
        assert (at, 0, 15, 15 + least) in [(p - index.first[index.kind(p)], *more) for p, *more in found]
        if at % 15 == 0:
            points = dc.normalised("qq " * 3 + edited(draw, item[at : at + 105], draw.randrange(8)) + " zz" * 3)[0]
            best = np.concatenate([distances(np.stack([p for p in index.points if len(p) == n]), points) for n in dc.LENGTHS])
            found = {}
            for p, edits, _, _ in dc.search(index, points):
                found[p] = min(edits, found.get(p, 99))
            assert found == {p: e for p, e in enumerate(best.tolist()) if e <= index.budget[p]}
            within += 0 < len(found) and min(found.values()) > 0 or len(set(found.values())) > 1
    assert within > 2


def test_repeated_characters_and_chunks(monkeypatch):
    index, points = dc.Index([(1, "ab " * 50)]), dc.normalised("x" + "ab " * 90 + "y")[0]
    whole = sorted(set(dc.search(index, points)))
    assert {p for p, edits, _, _ in whole if edits == 0} == set(range(index.many))
    monkeypatch.setattr(dc, "CHUNK", 7)
    assert sorted(set(dc.search(index, points))) == whole


def test_short_items_are_found_as_they_are(spark, monkeypatch):
    asks, chinese = "What is the capital of France?", "中国的首都是哪一座城市呢。"
    items = spark.createDataFrame([(1, asks), (2, chinese), (3, "tiny"), (4, asks + " Paris"), (5, "¿Un día más?")], "item_id long, text string")
    texts = {
        1: "Q: WHAT is the capital of France", 2: "what is the capital of france's coast", 3: "somewhat is the capital of France?",
        4: "what is the capital of Frances", 5: "我问他中国的首都是哪一座城市呢他不知道", 6: "中国的首都是哪一座城市", 7: "tiny tiny un dia mas",
        8: "x" * 3 + " un día más", 9: "lorem ipsum " * 40 + asks + " Paris", 10: "lorem ipsum " * 40 + "some" + asks + "x " + "dolor " * 99,
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = {(1, 1, 3, 32), (2, 1, 0, 29), (5, 2, 3, 15), (8, 5, 4, 14), (9, 1, 480, 509)}

    def hits():
        found = dc.benchmark_hits(docs, items).collect()
        assert {(r.row_id, r.edits, r.passages) for r in found if r.item_id != 4} == {(d, 0, 1) for d in (1, 2, 5, 8, 9)}
        return {(r.row_id, r.item_id, r.text_start, r.text_end) for r in found if r.item_id != 4}

    assert hits() == want
    assert {r.doc_id for r in dc.without_benchmark(docs, items).collect()} & {1, 2, 3, 5, 6, 7, 8} == {3, 6, 7}
    for cut in (241, 484, 488):
        monkeypatch.setattr(dc, "SLICE", cut)
        assert hits() == want


def test_search_in_parts_finds_the_same(monkeypatch):
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abcde"), 4)) for _ in range(30)]
    item = " ".join(rng.choice(words, 200))
    quote = item[100:190]
    other = " ".join(rng.choice(words, 3000))
    text = other[:5000] + " " + quote + " " + other[5000:9000] + quote[:40] + "x" + quote[41:] + other[9000:]
    index = dc.Index([(1, item), (2, "zz " + quote + " zz")])
    points = dc.normalised(text)[0]
    whole = {(p, e) for p, e, _, _ in dc.search(index, points)}
    assert {e for _, e in whole} > {0, 1}
    for pairs in (500, 20):
        monkeypatch.setattr(dc, "PAIRS", pairs)
        found = dc.search(index, points)
        best = lambda hits: {p: min(e for q, e in hits if q == p) for p, _ in hits}
        assert best({(p, e) for p, e, _, _ in found}) == best(whole)


def test_an_item_that_repeats_itself(spark):
    item, text = "ab " * 4000, "so " + "ab " * 3000 + "it is"
    index = dc.Index([(1, item)])
    assert len(index.value) < 500 and index.same.sum() == len(index.same)
    # Passages from every place of the item are counted, though only the first ones are searched for.
    docs = spark.createDataFrame([(1, text), (2, "ab " * 20), (3, "a" * 50_000)], "doc_id long, text string")
    items = spark.createDataFrame([(1, item), (2, "a" * 30_000)], "item_id long, text string")
    got = {(r.row_id, r.item_id): r for r in dc.benchmark_hits(docs, items).collect()}
    assert set(got) == {(1, 1), (3, 2)}
    assert got[1, 1].passages == len(dc.normalised(item)[0]) - 75 + 1 and got[1, 1].edits == 0
    assert got[3, 2].passages == 30_000 - 75 + 1 and (got[3, 2].text_start, got[3, 2].text_end) == (0, 50_000)
