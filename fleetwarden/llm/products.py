"""Exact inner products of vectors of whole numbers, and bounds of them from segments' means and deviations."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST, MOST = -(2**63), 2**63 - 1
#: Rows whose directions of most energy give the rotation, and single components at the front of each level.
SAMPLE = 2048
LEVELS = (2, 8, 16, 32)
#: Rows of one step inside a task.
STEP = 1024


def takes_part(vector: Column) -> Column:
    """Neither null nor holding a null or a component that is not finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    return F.coalesce(vector.isNotNull() & F.forall(vector, finite), F.lit(False))


def matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    """Lists of one length as a matrix."""
    if not rows:
        return np.zeros((0, 0))
    return np.asarray(column.combine_chunks().flatten(), float).reshape(rows, len(column[0]))


class Whole:
    """Vectors floor(scale * x). As floats they are exact, as scale is a power of two; their products are while no
    component is large. Vectors with a large component are multiplied as whole numbers of any size."""

    def __init__(self, raw: np.ndarray, scale: int):
        self.raw, self.scale = raw, scale
        with np.errstate(over="ignore"):
            self.value = np.floor(raw * scale)
        self.large = np.abs(self.value).max(axis=1, initial=0) >= math.sqrt(2**53 / max(1, raw.shape[1]))

    def numbers(self, rows: np.ndarray) -> np.ndarray:
        exact = lambda x: int(x) * self.scale if abs(x) >= 2**53 else math.floor(x * self.scale)
        return np.array([[exact(x) for x in self.raw[r].tolist()] for r in rows], object).reshape(len(rows), -1)


def inner_products(a: Whole, rows: np.ndarray, b: Whole, columns: np.ndarray) -> np.ndarray:
    """Products of some rows of a with some of b; beyond 64 bits they are the least or the most that 64 bits hold."""
    plain_a, plain_b = ~a.large[rows], ~b.large[columns]
    out = np.zeros((len(rows), len(columns)), np.int64)
    out[np.ix_(plain_a, plain_b)] = (a.value[rows[plain_a]] @ b.value[columns[plain_b]].T).astype(np.int64)
    every = np.ones(len(columns), bool)
    for left, right in ((~plain_a, every), (plain_a, ~plain_b)):
        if left.any() and right.any():
            exact = a.numbers(rows[left]) @ b.numbers(columns[right]).T
            out[np.ix_(left, right)] = np.clip(exact, LEAST, MOST).astype(np.int64)
    return out


def edges(dim: int, singles: int) -> np.ndarray:
    """Where segments begin: so many single components, then segments that double; finer levels split coarser ones."""
    at = [*range(min(singles, dim))]
    while singles < dim:
        at.append(singles)
        singles *= 2
    return np.array(at or [0])


def levels(dim: int) -> list[np.ndarray]:
    return [edges(dim, s) for s in LEVELS if s < dim]


def summary(x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of every segment."""
    size = np.diff(at, append=x.shape[1])
    mean = np.add.reduceat(x, at, axis=1) / size
    off = x - np.repeat(mean, size, axis=1)
    return mean, np.sqrt(np.add.reduceat(off * off, at, axis=1) / size)


def coarser(mean: np.ndarray, spread: np.ndarray, fine: np.ndarray, coarse: np.ndarray, dim: int):
    """The summary of a coarser level from that of a finer one."""
    size, whole = np.diff(fine, append=dim), np.diff(coarse, append=dim)
    at = np.searchsorted(fine, coarse)
    up = np.add.reduceat(mean * size, at, axis=1) / whole
    off = (mean - np.repeat(up, np.diff(at, append=len(fine)), axis=1)) ** 2 + spread**2
    return up, np.sqrt(np.add.reduceat(off * size, at, axis=1) / whole)


def rooted(mean: np.ndarray, spread: np.ndarray, at: np.ndarray, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations times the roots of the segments' lengths: for two vectors the products of these rows bound
    their product: means' product plus or minus deviations' product."""
    root = np.sqrt(np.diff(at, append=dim))
    return mean * root, spread * root


def rotation(vectors: DataFrame, column: str, order: Column) -> tuple[int, np.ndarray | None]:
    """(length, orthogonal matrix): directions in the order of the energy that a bounded sample has in them.

    Any rotation keeps products, so the sample decides how soon bounds are tight and never a result. The matrix is for
    the sample's most frequent length.
    """
    sample = [r[0] for r in vectors.orderBy(order).limit(SAMPLE).select(column).collect()]
    common = Counter(len(x) for x in sample).most_common(1)
    dim = common[0][0] if common else 0
    if dim < 2:
        return dim, None
    x = np.array([v for v in sample if len(v) == dim], float)
    x /= np.maximum(np.abs(x).max(axis=1, keepdims=True), 1e-300)
    _, directions = np.linalg.eigh(x.T @ x)
    return dim, directions[:, ::-1].copy()


def best_of(rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k best of each row, ties to the smaller id."""
    order = np.lexsort((ids, ~scores, rows))
    rows = rows[order]
    keep = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
    return rows[keep], scores[order][keep], ids[order][keep]


class Block:
    """Rows of a task: ids, labels, whole numbers and, level by level, rooted means and deviations."""

    def __init__(self, table: pa.Table, scale: int):
        n = table.num_rows
        column = lambda c: np.asarray(table.column(c).combine_chunks())
        self.id, self.label = column("id"), column("label") if "label" in table.column_names else None
        self.whole = Whole(matrix(table.column("v"), n), scale)
        dim = self.whole.raw.shape[1]
        steps = levels(dim)
        self.levels = []
        if steps and n:
            mean, spread = (matrix(table.column(c), n) for c in ("mean", "spread"))
            for at in steps:
                own = (mean, spread) if at is steps[-1] else coarser(mean, spread, steps[-1], at, dim)
                self.levels.append(rooted(*own, at, dim))


def survivors(q: Block, c: Block, part: np.ndarray, alive: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Those of the pairs whose bounds leave a score from least to most possible, refined level by level."""
    exempt = q.whole.large[:, None] | c.whole.large[part][None, :]
    for (q_mean, q_spread), (c_mean, c_spread) in zip(q.levels, c.levels):
        lines = np.flatnonzero((alive & ~exempt).any(axis=1))
        if not len(lines):
            break
        middle, reach = q_mean[lines] @ c_mean[part].T, q_spread[lines] @ c_spread[part].T
        # Rounding goes with the vectors' lengths.
        size = np.linalg.norm(q.whole.value[lines], axis=1)[:, None] * np.linalg.norm(c.whole.value[part], axis=1)[None, :]
        reach += 1e-9 * np.where(exempt[lines], 0, size) + 1e-3
        inside = (middle + reach >= least[lines, None]) & (middle - reach <= most[lines, None])
        alive[lines] &= inside | exempt[lines]
    return alive


def best_in_bands(
    q: Block, c: Block, same_label: bool | None, low: np.ndarray, high: np.ndarray, k: int
) -> tuple[tuple[np.ndarray, ...], int]:
    """((anchor's row, band, id, score) of the k best rows of each anchor and band, number of exact products).

    low and high have a row for each anchor and a column for each band. Rows are of the anchor's label, or of others, or
    of any (None), and never have its id.
    """
    order = np.argsort(c.id, kind="stable")
    bands = low.shape[1]
    codes, scores, ids = (np.zeros(0, np.int64) for _ in range(3))
    need, made = low.copy(), 0
    for start in range(0, len(order), STEP):
        part = order[start : start + STEP]
        alive = q.id[:, None] != c.id[part][None, :]
        if same_label is not None:
            alive &= (q.label[:, None] == c.label[part][None, :]) == same_label
        # A band that is empty, or full of the highest score, asks nothing.
        alive &= (need <= high).any(axis=1)[:, None]
        alive = survivors(q, c, part, alive, need.min(axis=1), high.max(axis=1))
        lines, columns = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
        if not len(lines):
            continue
        exact = inner_products(q.whole, lines, c.whole, part[columns])
        made += int(alive.sum())
        fresh = [(codes, scores, ids)]
        for band in range(bands):
            fits = alive[np.ix_(lines, columns)] & (exact >= need[lines, band, None]) & (exact <= high[lines, band, None])
            if len(columns) > k:
                kth = np.partition(np.where(fits, exact, LEAST), len(columns) - k, axis=1)[:, len(columns) - k]
                fits &= exact >= kth[:, None]
            i, j = np.nonzero(fits)
            fresh.append((lines[i] * bands + band, exact[i, j], c.id[part[columns[j]]]))
        codes, scores, ids = best_of(*(np.concatenate(x) for x in zip(*fresh)), k)
        count = np.bincount(codes, minlength=need.size)
        full = np.flatnonzero(count >= k)
        last = scores[np.cumsum(count)[full] - 1]
        # Ids ascend, so a later row has to be better than the k-th, not equal.
        need.ravel()[full] = np.where(last < MOST, last + 1, last)
    return (codes // bands, codes % bands, ids, scores), made


def with_summaries(scale: int, dim: int, turn: np.ndarray | None):
    """For mapInArrow: adds mean and spread, each vector's segments at the finest level after the rotation, to rows with v and dim."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column("v")
            sizes = np.asarray(batch.column("dim"))
            means, spreads = [None] * len(v), [None] * len(v)
            for size in np.unique(sizes).tolist():
                at, rows = levels(size), np.flatnonzero(sizes == size)
                if not at:
                    continue
                whole = Whole(np.array(v.take(pa.array(rows)).to_pylist(), float), scale)
                x = np.where(whole.large[:, None], 0.0, whole.value)
                mean, spread = summary(x @ turn if size == dim and turn is not None else x, at[-1])
                for r, m, s in zip(rows.tolist(), mean, spread):
                    means[r], spreads[r] = m, s
            lists = [pa.array(x, pa.list_(pa.float64())) for x in (means, spreads)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *lists], names=[*batch.schema.names, "mean", "spread"])

    return run
