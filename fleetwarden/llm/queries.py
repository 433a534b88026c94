"""The registered queries of the thirteen operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwarden.llm import (
    byte_bpe,
    decontaminate,
    divergence,
    hard_negatives,
    language,
    line_dedup,
    mixing,
    near_dups,
    revisits,
    sharding,
    token_counts,
    topk,
    url_lists,
)
from fleetwarden.llm.frames import body, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def number_of(text):
    """24 bits of a text's digest, as SQL computes them too."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 6), 16, 10).cast("int")


def page_captures(spark, sf):
    """pages as captures: each was fetched on a day of 2024 that its id gives."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") * 7919 % 366).cast("int"))
    return table(spark, sf, "pages").select("page_id", "url", day.cast("timestamp").alias("fetched_at"))


def page_list_entries(captures):
    """Dated list entries about the hosts, domains and sections of the captures; dates and verdicts come from digests."""
    url, start = F.col("url"), F.lit("2023-07-01").cast("date")
    entry = lambda list_, kind, verdict, action, date: F.struct(
        list_.alias("list"), F.lit(kind).alias("kind"), F.col("pattern"), verdict.alias("verdict"),
        F.lit(action).alias("action"), date.alias("entry_date"),
    )
    x = F.col("x")
    names = lambda pattern: (
        captures.select(pattern.alias("pattern")).where("pattern <> ''").distinct().withColumn("x", number_of(F.col("pattern")))
    )
    host_list = F.concat(F.lit("hosts"), (x % 3).cast("string"))
    first = F.date_add(start, x % 400)
    second = F.date_add(first, 30 + x % 90)
    verdict = F.when(x % 4 == 0, "allow").otherwise("block")
    hosts = names(url_lists.url_host(url)).select(
        F.explode(
            F.array(
                entry(host_list, "host", verdict, "add", first),
                entry(host_list, "host", verdict, "remove", second),
                entry(host_list, "host", F.lit("block"), "add", F.when(x % 2 == 0, F.date_add(second, F.lit(45)))),
            )
        ).alias("e")
    )
    begin = F.date_add(F.lit("2024-01-01").cast("date"), x % 300)
    domains = names(F.regexp_extract(url_lists.url_host(url), r"^[^.]*\.(.*\..*)$", 1)).select(
        F.explode(
            F.array(
                entry(F.lit("domains"), "domain", F.lit("block"), "add", begin),
                entry(F.lit("domains"), "domain", F.lit("block"), "remove", F.date_add(begin, x % 60)),
            )
        ).alias("e")
    )
    sections = (
        names(url_lists.url_section(url))
        .where(x % 5 == 0)
        .select(
            entry(
                F.lit("sections"), "section", F.when(x % 2 == 0, "allow").otherwise("block"), "add",
                F.date_add(F.lit("2024-02-01").cast("date"), x % 200),
            ).alias("e")
        )
    )
    return hosts.unionByName(domains).unionByName(sections).select("e.*")


@query
def op1_url_lists(spark, sf):
    """Rows of evaluate_captures for every page; a null url has no host and meets no entry."""
    captures = page_captures(spark, sf)
    return url_lists.evaluate_captures(captures, page_list_entries(captures)).drop("fetched_at")


@query
def op2_language(spark, sf):
    """Rows (doc_id, held_out, lang_pred, score) of every document; a text that is null or has no letter is `und`."""
    return language.identify(table(spark, sf, "documents")).withColumnRenamed("id", "doc_id")


@query
def op3_line_dedup(spark, sf):
    """Rows (doc_id, n_lines, n_dropped, kept_sha256) of every document; a null or empty text is one empty line."""
    kept = line_dedup.drop_repeated_lines(table(spark, sf, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode(body("text"), "UTF-8"), 256).alias("kept_sha256"))


@query
def op4_benchmark_hits(spark, sf):
    """Rows of benchmark_hits, one for each document and item that share a passage; null texts share none."""
    hits = decontaminate.benchmark_hits(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return hits.withColumnRenamed("row_id", "doc_id").drop("row_body")


@query
def op5_near_duplicates(spark, sf):
    """Rows (doc_id, class_id, is_representative, class_digest), one for each document: one text of a class represents it,
    also where ids are null or repeat."""
    rows = near_dups.near_duplicates(table(spark, sf, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "class_id", F.col("stays").alias("is_representative"), "class_digest")


@query
def op6_shards(spark, sf):
    """Rows (doc_id, size, text_crc32, law, shard, slot, grown_shard) of every document under the law `rows`; a null text has 0 bytes."""
    rows = sharding.assign_shards(table(spark, sf, "documents"))
    return rows.select(
        F.col("id").alias("doc_id"),
        (F.col("bytes") + 16).alias("size"),
        F.col("crc").alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("number").alias("row_number"),
    )


@query
def op7_mix(spark, sf):
    """Rows (doc_id, size, source_size, target, taken) of every document; a null text has size 0, null sources come last."""
    rows = mixing.mix(table(spark, sf, "documents"))
    return rows.select(
        F.col("id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).cast("long").alias("taken"),
        "source",
        "copies",
    )


@query
def op8_top_products(spark, sf):
    """Rows (query_id, rank, vec_id, score): the 20 best of every id divisible by 20, against all vectors."""
    return topk.top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op9_token_counts(spark, sf):
    """Rows (doc_id, n_bytes, n_tokens, over_limit) of every document; a null text is an empty one."""
    return token_counts.with_token_counts(table(spark, sf, "documents"))


def page_records(spark, sf):
    """pages as web records: two responses each and one or two revisits, with headers and times from digests."""
    pages = table(spark, sf, "pages").select(
        "page_id", "url", F.md5(body("html").cast("binary")).alias("h"), F.octet_length(body("html")).alias("size"),
        number_of(body("url")).alias("x"),
    )
    page, h, x = F.col("page_id"), F.col("h"), F.col("x")
    hours = lambda n: F.timestamp_micros((F.lit(1704067200) + (page * 131 % 5000 + n) * 3600) * 1000000)
    day = lambda n: F.concat(F.lit("Last-Modified: day "), ((page + n) % 366).cast("string"))
    tags = [F.concat(F.lit('ETag: "'), F.substring(h, 1, 16), F.lit('"')), F.concat(F.lit('ETag: W/"'), F.substring(h, 17, 16), F.lit('"'))]
    head = lambda *lines: F.concat_ws("\r\n", *[F.lit(v) if isinstance(v, str) else v for v in lines])
    stored = lambda n: head(
        "Content-Type: text/html", F.concat(F.lit("Content-Length: "), F.col("size").cast("string")), tags[n], day(n), "Cache-Control: max-age=60"
    )
    told = (
        F.when(x % 5 == 0, F.lit(None))
        .when(x % 5 == 1, 'ETag: "other"')
        .when(x % 5 == 2, day(0))
        .when(x % 150 <= 100, tags[0])
        .otherwise(tags[1])
    )
    update = head("Date: now", "Cache-Control: max-age=3600", "Content-Length: 0", "Connection: close", told)
    record = lambda n, kind, at, status, headers, payload: F.struct(
        F.concat(page.cast("string"), F.lit(f"-{n}")).alias("record_id"), F.lit(kind).alias("kind"), at.alias("warc_date"),
        status.cast("int").alias("status"), headers.alias("headers"), payload.alias("payload_digest"),
    )
    return pages.select(
        "url",
        F.explode(
            F.array(
                record(0, "response", hours(F.lit(0)), F.lit(200), stored(0), h),
                record(1, "response", hours(F.lit(100)), F.when(x % 7 == 0, 404).otherwise(200), stored(1), F.md5(F.concat(h, F.lit("1")).cast("binary"))),
                record(2, "revisit", hours(x % 150), F.lit(304), update, F.lit(None).cast("string")),
                record(3, "revisit", hours(-(x % 50)), F.lit(304), update, F.lit(None).cast("string")),
            )
        ).alias("r"),
    ).select("url", "r.*")


@query
def op10_revisits(spark, sf):
    """Rows of resolve_revisits for two revisits of every page; a page without url is a record of the empty url."""
    return revisits.resolve_revisits(page_records(spark, sf))


@query
def op13_byte_bpe(spark, sf):
    """Rows (doc_id, n_tokens, ids_sha256, decoded_sha256) of every document; a null text is an empty one."""
    encoded = byte_bpe.encode(table(spark, sf, "documents").select("doc_id", "text"))
    told = F.sha2(F.encode(F.array_join(F.col("ids").cast("array<string>"), ","), "UTF-8"), 256)
    rows = encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), told.alias("ids_sha256"), "ids")
    return byte_bpe.decode(rows).select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op11_divergence(spark, sf):
    """Rows (lang, source, part, item, value, rank) over every document; nulls read as ''."""
    return divergence.source_divergence(table(spark, sf, "documents"))


@query
def op12_hard_negatives(spark, sf):
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of the anchors with an id divisible
    by 100, against every vector; an id divisible by 7 has the next label."""
    number, label = F.col("vec_id"), F.col("label")
    moved = F.when(number % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.hard_negatives(table(spark, sf, "embeddings"), number % 100 == 0, moved)
