import datetime as dt
import random

from fleetwarden.llm import url_lists as ul

D = dt.date
ENTRY = "list string, kind string, pattern string, verdict string, action string, entry_date date"


def entries(spark, rows):
    return spark.createDataFrame(rows, ENTRY)


def captures(spark, rows):
    return spark.createDataFrame([(i, u, t and dt.datetime(t.year, t.month, t.day, 12)) for i, u, t in rows], "id long, url string, fetched_at timestamp")


def test_intervals(spark):
    rows = [("a", "host", "h", "block", "add", D(2024, 1, 1)), ("a", "host", "h", "block", "remove", D(2024, 2, 1)),
            ("a", "host", "h", "allow", "add", D(2024, 3, 1)), ("a", "host", "g", "block", "add", D(2024, 1, 5)),
            ("a", "host", "g", "block", "remove", D(2024, 1, 5)), ("a", "host", None, "block", "add", D(2024, 1, 1)),
            ("a", "host", "h", "block", "add", None)]
    got = {tuple(r) for r in ul.list_intervals(entries(spark, rows)).collect()}
    assert got == {("a", "host", "h", "block", D(2024, 1, 1), D(2024, 2, 1)), ("a", "host", "h", "allow", D(2024, 3, 1), None)}


def test_edges_and_precedence(spark):
    rows = [("a", "domain", "example.com", "block", "add", D(2024, 1, 10)), ("a", "domain", "example.com", "block", "remove", D(2024, 2, 10)),
            ("b", "host", "ok.example.com", "allow", "add", D(2024, 1, 1)), ("c", "section", "ok.example.com/bad", "block", "add", D(2024, 1, 1)),
            ("d", "host", "ok.example.com", "block", "add", D(2024, 6, 1))]
    asked = [(1, "http://x.example.com/", D(2024, 1, 9)), (2, "http://x.example.com/", D(2024, 1, 10)), (3, "http://x.example.com/", D(2024, 2, 9)),
             (4, "http://x.example.com/", D(2024, 2, 10)), (5, "https://u@OK.example.com.:8080/bad/x?y#z", D(2024, 1, 20)),
             (6, "https://ok.example.com/good", D(2024, 1, 20)), (7, "https://ok.example.com", D(2024, 7, 1)), (8, None, D(2024, 1, 20)),
             (9, "https://ok.example.com", None), (10, "nonsense", D(2024, 1, 20)), (11, "http://notexample.com/", D(2024, 1, 20)),
             (12, "http://" + "a." * 400 + "example.com/", D(2024, 1, 20)), (2, "http://x.example.com/", D(2024, 1, 10))]
    got = ul.evaluate_captures(captures(spark, asked), entries(spark, rows)).collect()
    assert sorted((r.id, r.decision, r.n_active) for r in got) == [
        (1, "none", 0), (2, "block", 1), (2, "block", 1), (3, "block", 1), (4, "none", 0), (5, "block", 3), (6, "allow", 2),
        (7, "block", 2), (8, "none", 0), (9, "none", 0), (10, "none", 0), (11, "none", 0), (12, "none", 0),
    ]


def test_random_lists_against_brute_force(spark):
    draw = random.Random(3)
    hosts = ["a.com", "x.a.com", "y.x.a.com", "b.org", "www.b.org"]
    day = lambda: D(2024, 1, 1) + dt.timedelta(draw.randrange(40))
    rows = [(draw.choice("pq"), draw.choice(["domain", "host"]), draw.choice(hosts), draw.choice(["block", "allow"]), draw.choice(["add", "add", "remove"]), day()) for _ in range(120)]
    asked = [(i, f"http://{draw.choice(hosts)}/s/{i % 3}", day()) for i in range(300)]
    got = {r.id: (r.decision, r.n_active) for r in ul.evaluate_captures(captures(spark, asked), entries(spark, rows)).collect()}
    for i, url, when in asked:
        host, active = url.split("/")[2], []
        for name in "pq":
            for kind in ("domain", "host"):
                for pattern in hosts:
                    if host != pattern and not (kind == "domain" and host.endswith("." + pattern)):
                        continue
                    past = [(r[5], r[4], r[3]) for r in rows if r[:3] == (name, kind, pattern) and r[5] <= when]
                    if past and max(past)[1] == "add":
                        weight = 1000 if kind == "host" else pattern.count(".") + 1
                        active.append((-weight, max(past)[2] != "block", name, max(past)[2]))
        assert got[i] == (min(active)[3] if active else "none", len(active)), (url, when)


def test_clashing_columns_and_empty_tables(spark):
    asked = captures(spark, [(1, "http://a.com/", D(2024, 1, 1))]).selectExpr("*", "'x' AS list", "1 AS day", "2 AS a", "'k' AS kind", "3 AS top")
    got = ul.evaluate_captures(asked, entries(spark, []))
    row = got.first()
    assert row.decision == "none" and row.list is None and row.day == 1 and row.host == "a.com"
    assert ul.evaluate_captures(asked.limit(0), entries(spark, [("a", "host", "a.com", "block", "add", D(2024, 1, 1))])).count() == 0
