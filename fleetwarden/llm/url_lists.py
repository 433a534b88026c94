"""URL filters: dated list entries as validity intervals, met by captures through an as-of join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetwarden.llm.frames import body, digest, row_struct, with_outputs
from fleetwarden.session import staged

# Kinds of list entries, actions and verdicts.
DOMAIN, HOST, SECTION = "domain", "host", "section"
ADD, REMOVE = "add", "remove"
BLOCK, ALLOW, NONE = "block", "allow", "none"

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?"
#: Longest valid host name.
HOST_CHARS = 253


def url_host(url: Column) -> Column:
    """Lower-case host without a trailing dot; empty where the URL has no valid one."""
    host = F.rtrim(F.lower(F.regexp_extract(body(url), _SCHEME + r"([^/?#:@]*)", 1)), F.lit("."))
    return F.when(F.length(host) <= HOST_CHARS, host).otherwise("")


def url_section(url: Column) -> Column:
    """host/first path segment; empty where there is none."""
    first = F.regexp_extract(body(url), _SCHEME + r"[^/?#]*/([^/?#]+)", 1)
    return F.when((url_host(url) == "") | (first == ""), "").otherwise(F.concat(url_host(url), F.lit("/"), first))


def entry_keys(url: Column) -> Column:
    """All (kind, pattern, weight) that an entry can name to match the URL; a larger weight is more specific.

    A domain entry covers the host and everything below it, a host entry the host alone, a section entry one first
    path segment of a host. A host has 253 characters at most, which bounds the number of keys.
    """
    host, section = url_host(url), url_section(url)
    labels = F.split(host, r"\.")
    n = F.size(labels)
    key = lambda kind, pattern, weight: F.struct(
        F.lit(kind).alias("kind"), pattern.alias("pattern"), weight.cast("int").alias("weight")
    )
    domains = F.transform(
        F.sequence(F.lit(1), n), lambda i: key(DOMAIN, F.array_join(F.slice(labels, i, n), "."), n - i + 1)
    )
    own = F.array(key(HOST, host, F.lit(1000)), key(SECTION, section, F.lit(2000)))
    return F.filter(F.when(host == "", F.slice(own, 1, 0)).otherwise(F.concat(domains, own)), lambda k: k["pattern"] != "")


def list_intervals(entries: DataFrame) -> DataFrame:
    """Validity intervals (list, kind, pattern, verdict, valid_from, valid_to) of dated entries.

    entries has the columns list, kind, pattern, verdict, action and entry_date. An addition holds from its day
    until the day of the pattern's next entry on that list (open if there is none). Of several entries of one day a
    removal wins, then a block. Entries that lack any of these values are ignored.
    """
    names = ("list", "kind", "pattern", "verdict", "action", "entry_date")
    usable = entries.select(*names).na.drop()
    daily = usable.groupBy("list", "kind", "pattern", "entry_date").agg(
        F.max(F.struct("action", "verdict")).alias("last")
    )
    ahead = Window.partitionBy("list", "kind", "pattern").orderBy("entry_date")
    return (
        daily.withColumn("valid_to", F.lead("entry_date").over(ahead))
        .where(F.col("last.action") == ADD)
        .select("list", "kind", "pattern", F.col("last.verdict").alias("verdict"), F.col("entry_date").alias("valid_from"), "valid_to")
    )


def active_on(days: DataFrame, intervals: DataFrame) -> DataFrame:
    """As-of join: for every (kind, pattern, day) the entry that decides, and how many lists hold one on that day.

    Asked days and interval starts are laid in one order for each list and pattern; each day takes the latest start
    at or before it and checks its end. days is distinct, so a pattern has at most one row a calendar day and list,
    however many captures ask for it.
    """
    intervals = staged(intervals)
    listed = intervals.select("list", "kind", "pattern").distinct()
    asked = days.join(listed, ["kind", "pattern"]).select("list", "kind", "pattern", "day", F.lit(1).alias("asked"))
    starts = intervals.select(
        "list", "kind", "pattern", F.col("valid_from").alias("day"), F.lit(0).alias("asked"),
        F.struct("verdict", "valid_from", "valid_to").alias("entry"),
    )
    order = Window.partitionBy("list", "kind", "pattern").orderBy("day", "asked")
    found = (
        asked.unionByName(starts, allowMissingColumns=True)
        .withColumn("entry", F.last("entry", ignorenulls=True).over(order))
        .where((F.col("asked") == 1) & F.col("entry").isNotNull())
        .where(F.col("entry.valid_to").isNull() | (F.col("day") < F.col("entry.valid_to")))
    )
    # A block beats an allowance of the same pattern, then the first list by name decides.
    rank = F.struct((F.col("entry.verdict") != BLOCK).alias("r"), F.col("list").alias("l"))
    return found.groupBy("kind", "pattern", "day").agg(
        F.count(F.lit(1)).alias("lists"), F.min_by(F.struct("list", "entry"), rank).alias("best")
    )


def evaluate_captures(captures: DataFrame, entries: DataFrame, url_col: str = "url", time_col: str = "fetched_at") -> DataFrame:
    """captures with host, decision, n_active, and the deciding entry: list, kind, pattern, valid_from, valid_to.

    Every capture meets the entries active on its day (the date of time_col). The most specific pattern decides: a
    section before a host, a host before a longer and a shorter domain; without an active entry the decision is
    "none". A null or malformed URL and a null time meet nothing. Repeated captures get equal results. Empty lists
    give "none" throughout. Input columns with an output's name are replaced.

    Captures are reduced to distinct (pattern, day) before the as-of join, so a host that a third of them share
    takes one row a day there; what returns is joined on (pattern, day) and can be split where a day is hot.
    """
    url = F.col(url_col)
    rows = captures.select(
        row_struct(captures), url.alias("u"), F.col(time_col).cast("date").alias("day")
    )
    keyed = (
        rows.select("u", "day")
        .where(F.col("day").isNotNull())
        .select(digest("u", 1).alias("a"), digest("u", 2).alias("b"), "day", F.explode(entry_keys(F.col("u"))).alias("k"))
        .select("a", "b", "day", "k.*")
    )
    days = keyed.select("kind", "pattern", "day").distinct()
    active = staged(active_on(days, list_intervals(entries)))
    # Equal URLs of one day have equal results: each distinct pair is decided once.
    decided = staged(
        keyed.distinct()
        .join(active, ["kind", "pattern", "day"])
        .groupBy("a", "b", "day")
        .agg(
            F.sum("lists").alias("n"),
            F.max_by(F.struct("best", "kind", "pattern"), F.struct("weight", "pattern")).alias("top"),
        )
        .toDF("da", "db", "dday", "n", "top")
    )
    joined = rows.select("_row", "u", "day", digest("u", 1).alias("a"), digest("u", 2).alias("b")).join(
        decided, (F.col("a") == F.col("da")) & (F.col("b") == F.col("db")) & (F.col("day") == F.col("dday")), "left"
    )
    entry = F.col("top.best.entry")
    return with_outputs(
        joined,
        "_row",
        host=url_host(F.col("u")),
        decision=F.coalesce(entry["verdict"], F.lit(NONE)),
        n_active=F.coalesce("n", F.lit(0)).cast("long"),
        list=F.col("top.best.list"),
        kind=F.col("top.kind"),
        pattern=F.col("top.pattern"),
        valid_from=entry["valid_from"],
        valid_to=entry["valid_to"],
    )
