"""Hard negatives: rows of other labels whose score lies in a band below that of an anchor's positives.

Every vector is stored with the mean and deviation of its segments. In a task these bound all scores of a block of
anchors and a block of rows, segments are refined for the pairs that a coarser level leaves, and only what survives the
finest level is multiplied.
"""

from __future__ import annotations

import math
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetwarden.llm import products
from fleetwarden.session import ship, staged

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: The band, in hundredths of the positive's score.
LOW, HIGH = 30, 90
#: Anchors and rows of one task.
ANCHORS, ROWS = 512, 4096

STORED = "id long, label long, dim int, v array<double>, anchor boolean, mean array<double>, spread array<double>"
SCORED = "anchor long, band int, id long, score long"


def _task(same_label: bool, k: int, scale: int, low: int, high: int):
    def run(key: tuple, anchors: pa.Table, rows: pa.Table) -> pa.Table:
        found = [np.zeros(0, np.int64)] * 4
        if anchors.num_rows and rows.num_rows:
            q, c = products.Block(anchors, scale), products.Block(rows, scale)
            if same_label:
                least, most = np.full((len(q.id), 1), products.LEAST), np.full((len(q.id), 1), products.MOST)
            else:
                least, most = _bands(anchors.column("asked").to_pylist(), low, high)
            (row, *rest), _ = products.best_in_bands(q, c, same_label, least, most, k)
            found = [q.id[row], *rest]
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        return pa.table({n: pa.array(x, t) for n, x, t in zip(("anchor", "band", "id", "score"), found, kinds)})

    return run


def _bands(scores: list[list[int]], low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and most score of each band: low * positive <= 100 * negative <= high * positive; an empty one is (1, 0)."""
    width = max(map(len, scores))
    least, most = np.ones((len(scores), width), np.int64), np.zeros((len(scores), width), np.int64)
    for i, own in enumerate(scores):
        for j, s in enumerate(own):
            least[i, j], most[i, j] = -(-low * s // 100), high * s // 100
    return least, most


def _block(column: str, seed: int, blocks: int | Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), column), F.lit(blocks) if isinstance(blocks, int) else blocks)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column | str = "label",
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A score is the inner product of floor(scale * x), exact; scale is a power of two. An anchor's positives are its
    `positives` best other rows of its label, and each gets the `negatives` best rows of other labels with
    low * positive_score <= 100 * negative_score <= high * positive_score. Ties go to the smaller id.

    Rows with a null id, label or vector, or a component that is null or not finite, take no part. Components of any
    size do: products are then whole numbers of any size, and a score beyond 64 bits is the least or most that they
    hold. Vectors of different lengths are not compared; empty ones have score 0. Where ids repeat, each row is a
    candidate for other ids, and the smallest (length, vector, label) stands for the id as an anchor. A positive without a row
    in its band gives none. Empty tables give no rows. Extra columns are not read.

    Anchors and rows are dealt into blocks by a hash of their ids, and a task is a block of each: the stated anchors
    meet all rows. For positives, a label's rows are in its own blocks, as many as it has rows for. A task returns k
    rows for an anchor and band, so a window ranks blocks x k rows.
    """
    ship(vectors.sparkSession)
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        (F.col(label) if isinstance(label, str) else label).cast("long").alias("label"),
        F.size(vector_col).alias("dim"),
        F.col(vector_col).cast("array<double>").alias("v"),
        is_anchor.alias("anchor"),
    ).where(F.col("id").isNotNull() & F.col("label").isNotNull() & products.takes_part(F.col("v")))
    dim, turn = products.rotation(rows, "v", F.xxhash64("id"))
    stored = staged(rows.mapInArrow(products.with_summaries(scale, dim, turn), STORED))
    anchors = staged(
        stored.where("anchor").groupBy("id").agg(F.min(F.struct("dim", "v", "label", "mean", "spread")).alias("a")).select("id", "a.*")
    )
    stored = stored.drop("anchor")
    n, asked = stored.count(), anchors.count()
    a_blocks, c_blocks = max(1, math.ceil(asked / ANCHORS)), max(1, math.ceil(n / ROWS))
    task = lambda same, k: _task(same, k, scale, low, high)
    every = lambda blocks: F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))

    # Positives. Labels of more than one block are at most n / ROWS; the others share blocks by their hash.
    wide = stored.groupBy("label").count().where(F.col("count") > ROWS)
    wide = F.broadcast(wide.select("label", F.ceil(F.col("count") / ROWS).alias("own")))
    shelf = _block("label", 1, c_blocks).alias("shelf")
    own = F.coalesce("own", F.lit(1).cast("long"))
    left = anchors.join(wide, "label", "left").select(
        "id", "label", "dim", "v", "mean", "spread", _block("id", 2, a_blocks).alias("a_block"), shelf, every(own).alias("c_block")
    )
    right = stored.join(wide, "label", "left").select(
        "*", shelf, _block("id", 3, own).alias("c_block"), every(F.lit(a_blocks)).alias("a_block")
    )
    keys = ["dim", "a_block", "shelf", "c_block"]
    scored = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(task(True, positives), SCORED)
    best = Window.partitionBy("anchor").orderBy(F.col("score").desc(), "id")
    chosen = staged(scored.withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives))

    # Negatives. Bands are the positives' places.
    asks = chosen.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "score")))["score"].alias("asked"))
    left = anchors.join(asks, F.col("id") == F.col("anchor")).select(
        "id", "label", "dim", "v", "mean", "spread", "asked",
        _block("id", 2, a_blocks).alias("a_block"), every(F.lit(c_blocks)).alias("c_block"),
    )
    right = stored.select("*", _block("id", 3, c_blocks).alias("c_block"), every(F.lit(a_blocks)).alias("a_block"))
    keys = ["dim", "a_block", "c_block"]
    scored = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(task(False, negatives), SCORED)
    best = Window.partitionBy("anchor", "band").orderBy(F.col("score").desc(), "id")
    ranked = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    pairs = chosen.select("anchor", (F.col("place") - 1).alias("band"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return ranked.join(pairs, ["anchor", "band"]).select(
        F.col("anchor").alias("anchor_id"),
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
