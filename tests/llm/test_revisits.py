import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fleetwarden.llm import revisits as rv

SCHEMA = "record_id string, url string, warc_date timestamp, kind string, status int, headers string, payload_digest string"


def at(minute):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)


@pytest.mark.parametrize(
    "url,want",
    [
        ("HTTP://www.Example.com:80/a/b/?utm_source=x&q=1&fbclid=2#top", "example.com/a/b?q=1"),
        ("https://user@example.com/a/b?q=1", "example.com/a/b?q=1"),
        ("example.com/A/?gclid=1", "example.com/A"),
        ("", ""),
        (None, ""),
    ],
)
def test_canonical_url(spark, url, want):
    frame = spark.createDataFrame([(url,)], "url string")
    assert frame.select(rv.canonical_url(F.col("url"))).first()[0] == want


STORED = 'Content-Type: text/html\r\nETag: "a"\r\nLast-Modified: monday\r\nContent-Length: 9\r\nX-Old: 1'


@pytest.mark.parametrize(
    "update,agree",
    [
        ('etag: "a"', True),
        ('ETag: W/"a"', True),
        ('ETag: "b"\r\nLast-Modified: monday', False),
        ("Last-Modified: monday", True),
        ("Last-Modified: tuesday", False),
        ("Date: now", False),
        (None, False),
    ],
)
def test_validators(spark, update, agree):
    frame = spark.createDataFrame([(STORED, update)], "s string, u string")
    assert frame.select(rv.validators_agree(F.col("s"), F.col("u"))).first()[0] is agree


def test_merging_and_odd_records(spark):
    update = 'ETag: "a"\r\nX-Old: 2\r\nContent-Length: 0\r\nConnection: close\r\nX-New: 3'
    rows = [("r0", "http://a.com/x", at(0), "response", 200, STORED, "d0"), ("r1", "http://a.com/x", at(10), "response", 404, STORED, "d1"),
            ("v0", "http://a.com/x", at(0), "revisit", 304, update, None), ("v1", "https://www.a.com/x/#f", at(20), "revisit", 304, update, None),
            ("v1", "https://www.a.com/x/#f", at(20), "revisit", 304, update, None), ("v2", None, at(20), "revisit", 304, None, "p"),
            ("v3", "http://a.com/x", None, "revisit", 304, update, None), ("r4", "http://a.com/x", None, "response", 200, STORED, "d4"),
            ("m", "http://a.com/x", at(5), "metadata", None, None, None), (None, "http://a.com/x", at(21), "revisit", None, 'ETag: "z"', "q")]
    records = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS slice", "2 AS at", "3 AS found", "'k' AS url_key")
    got = sorted(((r.record_id, r.outcome, r.refers_to, r.payload_digest) for r in rv.resolve_revisits(records).collect()), key=repr)
    assert got == sorted(
        [("v0", "orphan", None, None), ("v1", "resolved", "r0", "d0"), ("v1", "resolved", "r0", "d0"), ("v2", "orphan", None, "p"),
         ("v3", "orphan", None, None), (None, "mismatch", "r0", "q")],
        key=repr,
    )
    merged = [r.headers for r in rv.resolve_revisits(records).collect() if r.record_id == "v1"][0]
    assert merged.split("\r\n") == ["Content-Type: text/html", "Last-Modified: monday", "Content-Length: 9", 'ETag: "a"', "X-Old: 2", "X-New: 3"]
    assert rv.resolve_revisits(records.limit(0)).count() == 0


def test_one_url_over_many_slices(spark):
    draw = random.Random(7)
    rows = []
    for i in range(3000):
        url = "http://hot.com/" if i % 3 else f"http://{draw.randrange(50)}.com/"
        kind = draw.choice(["response", "revisit"])
        rows.append((f"{i:05d}", url, at(draw.randrange(900)), kind, 200 if kind == "response" else 304, f'ETag: "{draw.randrange(2)}"', f"p{i}"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.record_id: (r.outcome, r.refers_to) for r in rv.resolve_revisits(spark.createDataFrame(rows, SCHEMA)).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    full = [(r[1], r[2], r[0], r[5]) for r in rows if r[3] == "response"]
    for r in rows:
        if r[3] != "revisit":
            continue
        past = max(((t, i, h) for u, t, i, h in full if u == r[1] and t < r[2]), default=None)
        want = ("orphan", None) if past is None else ("resolved" if past[2] == r[5] else "mismatch", past[1])
        assert got[r[0]] == want
