import hashlib
import time

import pytest
from pyspark.sql import DataFrameWriter

from fleetwarden.llm.line_dedup import drop_repeated_lines
from fleetwarden.llm.queries import QUERIES

BLANKS = " \t\n\x0b\f\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    """Rows (id, text) -> rows (id, lines, dropped, kept text)."""
    key = lambda line: line.strip(BLANKS).translate(LOWER)
    held = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                held.setdefault(key(line), set()).add(i)
    keeper = {k: max(x for x in ids if x is not None) for k, ids in held.items() if len(ids) >= 3}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in keeper or keeper[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


LONG = "a line of twenty one signs"
ROWS = [
    (1, f"{LONG}\nown\n{LONG.upper()}"),
    (2, f"x\n \t{LONG}\x0b\r\n"),
    (3, f"{LONG}\nshort\n{LONG}\nshort"),
    (3, f"{LONG}\nshort\n{LONG}\nshort"),
    (None, f"{LONG}\nnobody"),
    (4, "short\nshort"),
    (5, ""),
    (6, None),
    (7, "ÄÖÜ" * 10 + "\n" + "äöü" * 10),
    (8, "ÄÖÜ" * 10),
    (9, "ÄÖÜ" * 10),
    (10, "\n" * 2000 + LONG + "\n" + "w " * 200_000),
]


def test_against_brute_force(spark):
    got = drop_repeated_lines(spark.createDataFrame(ROWS, "doc_id long, text string"))
    rows = sorted(
        ((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in got.collect()), key=repr
    )
    assert rows == brute(ROWS)


def test_clashing_columns_and_empty_table(spark):
    docs = spark.createDataFrame(
        [(1, "t", "x", 5, 6, "y")], "doc_id long, text string, doc string, n_lines int, pos int, gone string"
    )
    got = drop_repeated_lines(docs)
    assert set(got.columns) == {"doc_id", "text", "doc", "n_lines", "pos", "gone", "n_dropped"}
    assert got.first().n_lines == 1 and got.first().gone == "y"
    assert drop_repeated_lines(docs.limit(0)).count() == 0


def test_query_digests(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = {(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in brute(docs)}
    got = QUERIES["op3_line_dedup"](spark, sf)
    assert {(r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in got.collect()} == want
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "bigint", "bigint", "string"]


@pytest.mark.parametrize("name", ["op3_line_dedup", "op1_url_lists", "op6_shards", "op10_revisits"])
def test_native_plans_hold_no_python(spark, sf, name, monkeypatch):
    plans, stage = [], DataFrameWriter.parquet
    told = lambda df: df._jdf.queryExecution().executedPlan().toString()
    # The plans of the tables that are written on the way count too.
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: plans.append(told(self._df)) or stage(self, *a, **k))
    plans.append(told(QUERIES[name](spark, sf)))
    assert len(plans) > 1 or name != "op10_revisits"
    assert not any(word in plan for plan in plans for word in ("Python", "Pandas", "Arrow"))


def test_a_text_of_many_lines_takes_time_in_proportion(spark):
    long = [f"line number {i} of a very long text" for i in range(60_000)]
    common = "a line that several documents hold"
    rows = [(1, "\n".join([common, *long, common])), (2, common), (3, common)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    start = time.time()
    got = {r["doc_id"]: r for r in drop_repeated_lines(docs).collect()}
    assert time.time() - start < 60
    assert got[1]["text"] == "\n".join(long) and got[1]["n_dropped"] == 2 and got[2]["text"] == "" and got[3]["text"] == common
