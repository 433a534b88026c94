"""Exact top-k inner products with multi-resolution segment statistics."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetwarden.llm import products
from fleetwarden.session import ship, staged

TOP = 20
SCALE = 64
#: Candidates and queries of one task.
CANDIDATES, QUERIES = 4096, 1024

STORED = "id long, dim int, v array<double>, asks boolean, mean array<double>, spread array<double>"
FOUND = "query_id long, vec_id long, score long"


def _search(k: int, scale: int):
    """The k best candidates of each query, from what the query already knows to be reached (`least`)."""

    def run(key: tuple, queries: pa.Table, candidates: pa.Table) -> pa.Table:
        found = [np.zeros(0, np.int64)] * 3
        if queries.num_rows and candidates.num_rows:
            q, c = products.Block(queries, scale), products.Block(candidates, scale)
            least = np.array(queries.column("least").to_pylist(), np.int64)[:, None]
            (row, _, ids, scores), _ = products.best_in_bands(q, c, None, least, np.full_like(least, products.MOST), k)
            found = [q.id[row], ids, scores]
        return pa.table({n: pa.array(x, pa.int64()) for n, x in zip(("query_id", "vec_id", "score"), found)})

    return run


def top_k(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = TOP,
    scale: int = SCALE,
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score) of the k largest inner products of floor(scale * x), exact; scale is a power of two.

    Vectors are turned to the directions of most energy and stored with the means and deviations of their segments, which
    bound all products coarse to fine; exact products are taken of the survivors. Queries and candidates are dealt into
    blocks by a hash of their ids, and every pair of blocks is one task: the stated query set meets all rows, block by
    block. The first block of candidates gives each query a score that its k-th best reaches, and all blocks start from
    it. A task returns k rows a query, and a window over (candidate blocks x k) rows a query ranks them. Block sizes
    bound a task whatever the table's size, and equal vectors have different ids, so no block is hot.

    Vectors that are null or empty or hold a null or non-finite component, and rows without an id take no part.
    Components of any size do: a score beyond 64 bits is the least or most that they hold. Only vectors of the same
    length are compared. Rows with a query's id are not its candidates. Where ids repeat, each row is a candidate, and the
    smallest vector of each length stands for the id as a query; a query of several lengths has its k best of all.
    Extra columns are not read.
    """
    ship(vectors.sparkSession)
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.size(vector_col).alias("dim"), F.col(vector_col).cast("array<double>").alias("v"), is_query.alias("asks")
    ).where(F.col("id").isNotNull() & products.takes_part(F.col("v")) & (F.col("dim") > 0))
    dim, turn = products.rotation(rows, "v", F.xxhash64("id"))
    stored = staged(rows.mapInArrow(products.with_summaries(scale, dim, turn), STORED))
    queries = staged(
        stored.where("asks").groupBy("id", "dim").agg(F.min(F.struct("v", "mean", "spread")).alias("q")).select("id", "dim", "q.*")
    )
    n, asked = stored.count(), queries.count()
    c_blocks, q_blocks = max(1, math.ceil(n / CANDIDATES)), max(1, math.ceil(asked / QUERIES))
    block = lambda seed, blocks: F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(blocks).cast("long"))
    every = lambda blocks: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    keys = ["dim", "q_block", "c_block"]

    def ranked(left: DataFrame, right: DataFrame) -> DataFrame:
        found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_search(k, scale), FOUND)
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    left = queries.withColumn("q_block", block(1, q_blocks))
    right = stored.drop("asks").withColumn("c_block", block(2, c_blocks)).withColumn("q_block", every(q_blocks))
    lowest = F.lit(products.LEAST).cast("long")
    start = ranked(left.select("*", lowest.alias("least"), F.lit(0).cast("long").alias("c_block")), right.where("c_block = 0"))
    start = staged(start.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("reached")))
    asks = left.join(start, "id", "left").select("*", F.coalesce("reached", lowest).alias("least"), every(c_blocks).alias("c_block"))
    return ranked(asks, right).select("query_id", F.col("rank").cast(T.IntegerType()).alias("rank"), "vec_id", "score")
