"""WARC: not-modified revisits resolved to the latest earlier full response of their canonical URL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetwarden.llm.frames import body
from fleetwarden.session import staged

# Record kinds, outcomes, and the header fields of a 304 that must not replace stored ones (connection
# management, and fields that describe the stored body).
RESPONSE, REVISIT = "response", "revisit"
RESOLVED, MISMATCH, ORPHAN = "resolved", "mismatch", "orphan"
NOT_MERGED = (
    "connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
    "proxy-authenticate", "proxy-authentication-info", "proxy-authorization", "proxy-connection", "te", "trailer",
    "transfer-encoding", "upgrade",
)
TRACKING = r"^(utm_[^=]*|fbclid|gclid)(=|$)"


def canonical_url(url: Column) -> Column:
    """Without scheme, credentials, www., default port, fragment, tracking parameters and trailing slash; host in lower case."""
    url = body(url)
    bare = F.regexp_replace(F.regexp_replace(url, r"#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_extract(bare, r"^([^/?]*)", 1)
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    terms = F.split(F.regexp_extract(bare, r"\?(.*)$", 1), "&")
    query = F.array_join(F.filter(terms, lambda t: (t != "") & ~t.rlike(TRACKING)), "&")
    host = F.regexp_replace(F.regexp_replace(F.lower(host), r"^.*@", ""), r":(80|443)$", "")
    host = F.regexp_replace(host, r"^www\.", "")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def header_lines(headers: Column) -> Column:
    return F.filter(F.split(body(headers), "\r?\n", -1), lambda line: line.contains(":"))


def _name(line: Column) -> Column:
    return F.lower(F.trim(F.substring_index(line, ":", 1)))


def header_value(headers: Column, name: str) -> Column:
    """The first value of a header; null where it is missing or empty."""
    found = F.get(F.filter(header_lines(headers), lambda line: _name(line) == name), F.lit(0))
    value = F.trim(F.regexp_replace(found, r"^[^:]*:", ""))
    return F.when(value != "", value)


def merged_headers(stored: Column, update: Column) -> Column:
    """The stored header, its fields replaced by those of the 304 that may; both keep their order."""
    new = F.filter(header_lines(update), lambda line: ~_name(line).isin(*NOT_MERGED))
    names = F.transform(new, _name)
    kept = F.filter(header_lines(stored), lambda line: ~F.array_contains(names, _name(line)))
    return F.array_join(F.concat(kept, new), "\r\n")


def validators_agree(stored: Column, update: Column) -> Column:
    """Whether the 304 speaks of the stored response.

    A strong entity tag must be equal, a weak one equal without its mark; without a tag the dates of last change must
    be equal; a 304 with neither fits a stored response with neither.
    """
    tag, own = header_value(update, "etag"), header_value(stored, "etag")
    date, own_date = header_value(update, "last-modified"), header_value(stored, "last-modified")
    weak = lambda t: F.regexp_replace(t, "^W/", "")
    same_tag = F.when(tag.startswith("W/"), weak(tag) == weak(own)).otherwise(tag == own)
    same = F.when(tag.isNotNull(), same_tag).when(date.isNotNull(), date == own_date).otherwise(
        own.isNull() & own_date.isNull()
    )
    return F.coalesce(same, F.lit(False))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Rows (record_id, url_key, outcome, refers_to, payload_digest, headers), one for each revisit record.

    records has the columns record_id, url, warc_date, kind, status, headers, payload_digest. A full response is a
    record of kind "response" with a status of 200 to 299. A revisit looks for the latest full response of its
    canonical URL that is strictly earlier (of several of one instant, the largest record_id). If their validators
    agree it is resolved: headers are the stored ones with the permitted fields of the 304 merged in, payload_digest
    is the stored one. Otherwise it is a mismatch (refers_to names the response that did not fit, the revisit keeps
    its own headers and digest), or an orphan where nothing is earlier. A null date is never earlier or later, a
    null URL is the URL "", null headers have no fields. Repeated records are resolved one by one; records of other
    kinds give no row. Extra columns are not read.

    Records are laid out once in the order of URL and date and written with the number of their slice. Windows span
    one URL inside one slice; the latest response of each slice is carried over to the URL's later slices. A URL with
    a third of all records is thus spread over a third of the slices.
    """
    response = (F.col("kind") == RESPONSE) & F.col("status").between(200, 299)
    rows = records.select(
        "record_id",
        canonical_url(F.col("url")).alias("url_key"),
        F.unix_micros(F.col("warc_date").cast("timestamp")).alias("at"),
        response.alias("full"),
        "headers",
        "payload_digest",
    ).where(F.col("full") | (records["kind"] == REVISIT))
    rows = staged(rows.repartitionByRange("url_key", "at").withColumn("slice", F.spark_partition_id()))
    stored = F.struct("at", "record_id", "headers", "payload_digest")
    own = F.when(F.col("full") & F.col("at").isNotNull(), stored)
    earlier = Window.partitionBy("slice", "url_key").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    inside = rows.withColumn("found", F.max(own).over(earlier)).where(~F.coalesce("full", F.lit(False)))
    ends = rows.groupBy("url_key", "slice").agg(F.max(own).alias("top"))
    past = Window.partitionBy("url_key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = staged(
        ends.select(F.col("url_key").alias("k"), F.col("slice").alias("s"), F.max("top").over(past).alias("carried")).where(
            "carried is not null"
        )
    )
    found = inside.join(carried, (F.col("url_key") == F.col("k")) & (F.col("slice") == F.col("s")), "left").withColumn(
        "found", F.when(F.col("at").isNotNull(), F.coalesce("found", "carried"))
    )
    agree = F.col("found").isNotNull() & validators_agree(F.col("found.headers"), F.col("headers"))
    return found.withColumn("agree", agree).select(
        "record_id",
        "url_key",
        F.when(F.col("agree"), RESOLVED).when(F.col("found").isNotNull(), MISMATCH).otherwise(ORPHAN).alias("outcome"),
        F.col("found.record_id").alias("refers_to"),
        F.when(F.col("agree"), F.col("found.payload_digest")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        F.when(F.col("agree"), merged_headers(F.col("found.headers"), F.col("headers"))).otherwise(F.col("headers")).alias("headers"),
    )
