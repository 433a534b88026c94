"""Mixing sources to target weights by cube-method balanced sampling."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetwarden.llm.frames import WORD, body, digest, repeated, row_key, row_struct, unpacked_row
from fleetwarden.session import ship, staged

# Fixed values of the mix.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
SEED = 20240607
#: Documents of one flight task, and how many tasks' remainders (two documents each at most) the next level joins.
CHUNK = 4096
FAN = 1024
#: Equal rows are dealt to the tasks in pieces of so many.
PIECE = 256
EDGE = 1e-9

FLOWN = "id string, source string, size long, source_size long, target double, base int, rank int, body long, chunk long, p double, n int"


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Target of each source by water filling, from rows (source, source_size).

    Sources in code point order, null last, weigh as `weights` says, in turn. With sources sorted by where they
    overflow, everything before the first one that does not overflow is full, and the rest divide what is left by
    weight. The windows span one row a source, which the sources' names bound, not the documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.array(*[F.lit(float(w)) for w in weights])
    rows = sizes.withColumn("rank", F.row_number().over(by_name)).withColumn(
        "weight", F.element_at(weight, F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1)
    )
    rows = rows.withColumn("most", F.col("source_size") * F.lit(most)).withColumn("brim", F.col("most") / F.col("weight"))
    filling = Window.orderBy("brim", "rank")
    everything = filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn(
        "level",
        (
            F.sum("source_size").over(everything) * F.lit(share)
            - F.coalesce(F.sum("most").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
        )
        / F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing)),
    )
    water = F.min_by(F.when(F.col("level") < F.col("brim"), F.col("level")), F.when(F.col("level") < F.col("brim"), F.struct("brim", "rank")))
    rows = rows.withColumn("water", water.over(everything))
    target = F.when(
        F.col("water").isNull() | (F.col("brim") <= F.col("water")), F.col("most")
    ).otherwise(F.col("weight") * F.col("water"))
    return rows.select("source", "rank", "source_size", target.alias("target"))


def _move(size: list, p: list, u: tuple, draw: float) -> None:
    """Move p along u to the edge of the unit cube, up or down so that no probability changes on average."""
    up = min((1 - x) / d if d > 0 else x / -d for x, d in zip(p, u) if d)
    down = min(x / d if d > 0 else (1 - x) / -d for x, d in zip(p, u) if d)
    step = up if draw * (up + down) < down else -down
    for i, d in enumerate(u):
        x = p[i] + step * d
        p[i] = 0.0 if x < EDGE else 1.0 if x > 1 - EDGE else x


def _null_vector(s: list) -> tuple:
    """A direction that changes neither the number nor the total size of three units (two, if their sizes agree)."""
    if len(s) == 2:
        return (1.0, -1.0)
    if s[0] == s[1]:
        return (1.0, -1.0, 0.0)
    u = (s[2] - s[1], s[0] - s[2], s[1] - s[0])
    top = max(map(abs, u))
    return tuple(x / top for x in u)


def fly(sizes: np.ndarray, chances: np.ndarray, draws: np.random.Generator, land: bool) -> np.ndarray:
    """Flight over units in the given order; at most two stay fractional, and land=True decides those too.

    Units with 0 or 1 are decided already. Landing gives up the total size first, then the count.
    """
    out, held = chances.astype(float), []
    for i in np.flatnonzero((out > 0) & (out < 1)):
        held.append(i)
        while len(held) == 3 or len(held) == 2 and sizes[held[0]] == sizes[held[1]]:
            s, p = [float(sizes[k]) for k in held], [out[k] for k in held]
            _move(s, p, _null_vector(s), draws.random())
            out[held] = p
            held = [k for k in held if 0 < out[k] < 1]
    if land and len(held) == 2:
        p = [out[k] for k in held]
        _move([], p, (1.0, -1.0), draws.random())
        out[held] = p
        held = [k for k in held if 0 < out[k] < 1]
    for k in held if land else ():
        out[k] = float(draws.random() < out[k])
    return out


def _flight(level: int, last: bool, seed: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        # A fixed order, large ones first, so that what is left over at the end tends to be small.
        pdf = pdf.loc[pdf.index.repeat(pdf["n"])].assign(n=1)
        pdf = pdf.sort_values(["size", "id", "body"], ascending=[False, True, True], kind="stable")
        draws = np.random.default_rng([seed, level, int(pdf["rank"].iloc[0]), int(pdf["chunk"].iloc[0])])
        return pdf.assign(p=fly(pdf["size"].to_numpy(), pdf["p"].to_numpy(), draws, last))

    return run


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: int = SEED,
) -> DataFrame:
    """Rows (id, source, size, source_size, target, body, copies): how often the mix takes each document.

    A source with target / size = r takes each document floor(r) times for certain, and once more with chance
    r - floor(r). The flight decides these chances in tasks of about CHUNK documents of one source; each leaves at
    most two undecided, which meet again FAN tasks at a time until each source has one task, and there they land. Of
    each source, the number of documents taken is then within one of its balance, and the words taken miss the
    target by less than two documents' words.

    A null text has size 0; documents of size 0 are taken floor(r) times. A null source is a source (the last one).
    Null ids and repeated rows are units of their own; equal rows are interchangeable. Empty input gives empty
    output. Extra columns are not read. The draws depend on the seed, the source's rank and the task's number.
    """
    ship(docs.sparkSession)
    text = body(text_col)
    # Equal rows are one row with a count until a task needs them, so copies of one row neither meet nor travel.
    rows = staged(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(source_col).alias("source"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
            digest(text).alias("body"),
        )
        .groupBy("id", "source", "size", "body")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    per_source = rows.groupBy("source").agg(
        F.sum(F.col("size") * F.col("rows")).alias("source_size"),
        F.sum(F.when(F.col("size") > 0, F.col("rows")).otherwise(0)).alias("units"),
    )
    per_source = staged(per_source)
    targets = source_targets(per_source.drop("units"), weights, share, most)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    targets = (
        targets.withColumn("ratio", F.least(ratio, F.lit(most)))
        .withColumn("base", F.floor("ratio").cast("int"))
        .withColumn("p", F.col("ratio") - F.col("base"))
    )
    chunks = targets.join(
        per_source.select(F.col("source").alias("s"), "units"), F.col("source").eqNullSafe(F.col("s"))
    ).select("source", "rank", "source_size", "target", "base", "p", F.ceil(F.col("units") / CHUNK).alias("chunks"))
    chunks = staged(chunks.withColumnsRenamed({"source": "s"}))
    pieces = rows.withColumn("piece", F.explode(F.sequence(F.lit(0), F.floor((F.col("rows") - 1) / PIECE))))
    drawn = pieces.join(chunks, F.col("source").eqNullSafe(F.col("s")), "left").select(
        F.col("id").cast("string").alias("id"),  # pandas would turn whole numbers beside a null into floats
        "source",
        "size",
        "source_size",
        "target",
        "base",
        "rank",
        "body",
        F.pmod(F.xxhash64(F.lit(seed), "id", "size", "body", "piece"), F.greatest("chunks", F.lit(1))).alias("chunk"),
        F.when((F.col("size") > 0) & F.col("p").between(EDGE, 1 - EDGE), F.col("p"))
        .when(F.col("p") > 1 - EDGE, 1.0)
        .otherwise(0.0)
        .alias("p"),
        F.least(F.lit(PIECE), F.col("rows") - F.col("piece") * PIECE).cast("int").alias("n"),
    )
    open_ = (F.col("p") > 0) & (F.col("p") < 1)
    single = F.explode(F.array_repeat(F.lit(1), F.col("n")))
    done, flying = [drawn.where(~open_).withColumn("n", single)], drawn.where(open_)
    left = chunks.agg(F.max("chunks")).first()[0] or 1  # one number: the tasks of the largest source
    level = 0
    while True:
        last = left <= 1
        flown = staged(flying.groupBy("rank", "chunk").applyInPandas(_flight(level, last, seed), FLOWN))
        done.append(flown.where(~open_))
        if last:
            break
        left, level = math.ceil(left / FAN), level + 1
        flying = flown.where(open_).withColumn("chunk", F.floor(F.col("chunk") / FAN).cast("long"))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.select(
        F.col("id").cast(rows.schema["id"].dataType).alias("id"), "source", "size", "source_size", "target", "body", (F.col("base") + F.col("p")).cast("int").alias("copies")
    )


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options
) -> DataFrame:
    """docs with each row repeated as often as the mix takes it, in docs' own columns.

    Rows that agree in id, source and text are repeats of one document; one of them stands for all their copies.
    """
    taken = mix(docs, id_col, text_col, source_col, **options)
    decided = staged(
        taken.select(*row_key("id", "source", "body"), "copies")
        .groupBy("k1", "k2")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("copies").alias("copies"))
    )
    key = row_key(F.col(id_col), F.col(source_col), digest(body(text_col)))
    return unpacked_row(repeated(docs.select(row_struct(docs), *key), decided), docs.columns)
