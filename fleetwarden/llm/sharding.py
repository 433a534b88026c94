"""Sharding by a Feistel permutation with cycle walking over global row numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetwarden.llm.frames import body, digest, row_struct, with_outputs
from fleetwarden.session import staged

SHARDS = 40
ROUNDS = 8
SEED = 20240607
#: Slices in which rows are numbered: at least so many, and one for each ROWS_A_SLICE rows.
SLICES = 4096
ROWS_A_SLICE = 50_000
#: A slice of more rows than this, and than four times the mean, is looked through for equal rows.
HOT_ROWS = 200_000
WALKS = 32


def _round(i: Column, half: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), i.cast("int"), half)


def _one_pass(v: Column, a: Column, b: Column, seed: int, rounds: int, back: bool) -> Column:
    """v = right * a + left; rounds change left and right in turn by a hash of the other one."""
    sign = -1 if back else 1
    order = F.sequence(F.lit(rounds), F.lit(1)) if back else F.sequence(F.lit(1), F.lit(rounds))
    start = F.struct((v % a).alias("l"), F.expr("0L").alias("r")).withField("r", F.floor(v / a).cast("long"))
    end = F.aggregate(
        order,
        start,
        lambda s, i: F.when(
            i % 2 == 1,
            F.struct(
                F.pmod(s["l"] + F.lit(sign) * F.pmod(_round(i, s["r"], seed), a), a).alias("l"), s["r"].alias("r")
            ),
        ).otherwise(
            F.struct(
                s["l"].alias("l"), F.pmod(s["r"] + F.lit(sign) * F.pmod(_round(i, s["l"], seed), b), b).alias("r")
            )
        ),
    )
    return end["r"] * a + end["l"]


def permuted(number: Column, rows: Column, seed: int = SEED, rounds: int = ROUNDS, back: bool = False) -> Column:
    """The place of a row number under a permutation of 0 .. rows - 1; back=True gives the number of a place.

    The halves count a = ceil(sqrt(rows)) and b = ceil(rows / a), so fewer than a of the a * b values lie outside;
    a value outside is passed on again until it lies inside. At most a walks are ever needed. Up to 1,024 rows the
    loop allows that many; beyond, a single pass leaves the range with a chance below 1/32, 32 passes in a row
    with less than 1e-48, and even then the query raises an error instead of giving a wrong place.
    """
    rows = rows.cast("long")
    a = F.ceil(F.sqrt(rows.cast("double"))).cast("long")
    b = F.ceil(rows / a).cast("long")
    walk = lambda v: _one_pass(v, a, b, seed, rounds, back)
    place = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALKS)),
        walk(number.cast("long")),
        lambda v, _: F.when(v >= rows, walk(v)).otherwise(v),
    )
    return F.when(place < rows, place).otherwise(F.raise_error(F.lit("cycle walking did not end; use another seed")))


def numbered(docs: DataFrame, id_col: str, text_col: str, slices: int = SLICES, rows_too: bool = False) -> DataFrame:
    """Rows (id, bytes, crc, number, total) with a dense global row number from 0; rows_too adds the row as _row.

    Rows are dealt to slices by a hash of id and text, numbered inside their slice in the order of id and text
    digests, and shifted by the counts of earlier slices; slices grow in number with the rows. A slice that is far
    above the mean holds many equal rows: those that fill more than half of what a slice may hold leave their slice,
    are stored once, get the numbers behind all other rows and are numbered in pieces. So no window spans more than a
    slice or a piece, the offsets are one row for each of them, and the number depends on the rows alone, not on
    files or partitions. Rows equal in id and text are interchangeable.
    """
    slices = max(slices, docs.count() // ROWS_A_SLICE)
    text = body(text_col)
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.octet_length(text).cast("long").alias("bytes"),
        F.crc32(F.encode(text, "UTF-8")).alias("crc"),
        digest(text).alias("body"),
        *([row_struct(docs)] if rows_too else []),
    ).withColumn("slice", F.pmod(F.xxhash64(F.lit(SEED), "id", "body"), F.lit(slices)).cast("int"))
    sizes = staged(rows.groupBy("slice").agg(F.count(F.lit(1)).alias("n")))
    mean, largest = sizes.agg(F.sum("n") / slices, F.max("n")).first()  # two numbers
    most = max(HOT_ROWS, int(4 * (mean or 0)))
    rows = rows.withColumn("piece", F.lit(0))
    sizes = sizes.withColumn("piece", F.lit(0))
    if (largest or 0) > most:
        rows, sizes = _hot_rows_apart(rows, sizes, slices, most)
    order = Window.orderBy("slice", "piece")
    offsets = sizes.select(
        "slice",
        "piece",
        F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("shift"),
        F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"),
    )
    inside = Window.partitionBy("slice", "piece").orderBy("id", "bytes", "crc", "body")
    number = (F.row_number().over(inside) - F.lit(1) + F.col("shift")).cast("long")
    # One row a slice or piece: their number bounds what is broadcast.
    placed = rows.join(F.broadcast(offsets), ["slice", "piece"]).withColumn("number", number)
    return placed.drop("shift", "slice", "piece", "body")


def _hot_rows_apart(rows: DataFrame, sizes: DataFrame, slices: int, most: int) -> tuple[DataFrame, DataFrame]:
    """rows and sizes with the groups of more than most / 2 equal rows moved to slices of their own, in pieces.

    Such a group lies in a slice of more than `most` rows or is left where it is. There are at most 2 * rows / most
    groups, no more than half as many as slices, so their list may be broadcast.
    """
    heavy = sizes.where(F.col("n") > most).select("slice")
    groups = (
        rows.join(F.broadcast(heavy), "slice", "left_semi")
        .groupBy("slice", "id", "bytes", "body")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > most // 2)
    )
    by_key = Window.orderBy("slice", "id", "bytes", "body")
    groups = staged(
        groups.select(
            F.col("slice").alias("old"),
            F.col("id").alias("g_id"),
            F.col("bytes").alias("g_bytes"),
            F.col("body").alias("g_body"),
            "n",
            (F.row_number().over(by_key) - 1 + slices).cast("int").alias("own"),
        )
    )
    same = (
        (F.col("slice") == F.col("old"))
        & F.col("id").eqNullSafe(F.col("g_id"))
        & (F.col("bytes") == F.col("g_bytes"))
        & (F.col("body") == F.col("g_body"))
    )
    rest = rows.join(F.broadcast(groups), same, "left_anti")
    # The piece comes from the place in the input, so the rows are written before anything is counted by it.
    hot = staged(
        rows.join(F.broadcast(groups), same)
        .withColumn(
            "piece",
            F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.ceil(F.col("n") * 2 / F.lit(most))).cast("int"),
        )
        .withColumn("slice", F.col("own"))
        .select(*rows.columns)
    )
    gone = groups.groupBy(F.col("old").alias("slice")).agg(F.sum("n").alias("gone"))
    left = sizes.join(gone, "slice", "left").select(
        "slice", "piece", (F.col("n") - F.coalesce("gone", F.lit(0))).alias("n")
    )
    return rest.unionByName(hot), left.unionByName(hot.groupBy("slice", "piece").agg(F.count(F.lit(1)).alias("n")))


def row_number_of(shard: Column, slot: Column, total: Column, shards: int = SHARDS, seed: int = SEED) -> Column:
    """The row number that lies in a slot of a shard."""
    return permuted(slot.cast("long") * shards + shard, total, seed, back=True)


def assign_shards(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, seed: int = SEED
) -> DataFrame:
    """One narrow row a document: id, bytes, crc, number, total, shard, slot.

    A null text counts as no bytes, a null id is an id like any other, equal rows get numbers of their own, and an
    empty table gives an empty table. Extra columns of docs are not read.
    """
    return _placed(numbered(docs, id_col, text_col), shards, seed)


def _placed(rows: DataFrame, shards: int, seed: int) -> DataFrame:
    at = permuted(F.col("number"), F.col("total"), seed)
    return (
        rows.withColumn("at", at)
        .withColumns({"shard": (F.col("at") % shards).cast("int"), "slot": F.floor(F.col("at") / shards).cast("long")})
        .drop("at")
    )


def sharded_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, seed: int = SEED
) -> DataFrame:
    """docs with shard and slot; input columns of these names are replaced. The texts are shuffled once."""
    placed = _placed(numbered(docs, id_col, text_col, rows_too=True), shards, seed)
    return with_outputs(placed, "_row", shard=F.col("shard"), slot=F.col("slot"))
