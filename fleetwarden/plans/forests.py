"""Forests of any depth, and forests as node arrays.

Passes over the whole table grow the upper levels, where nodes hold many rows. What is left of a subtree holds few rows,
so all of them go to one task, which grows it to the end. A finished forest is a table of nodes; scoring turns it into
arrays and moves a whole batch of rows down all trees level by level.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwarden.functions.draws import unit
from fleetwarden.session import new_folder, ship, staged

#: Rows of a leaf that one task may finish (about 50 bytes each); beyond, whole-table passes grow further levels first.
TASK_ROWS = 1_000_000
#: Edges between the codes of a feature, and bytes of counts that a task of such a pass holds.
EDGES, COUNTED_BYTES = 255, 1 << 26
#: Rows for each class from which a node's rows are counted by code, not sorted.
COUNTED_ROWS = 64
#: Nodes that a scoring task holds (about 100 bytes each).
MOST_NODES = 20_000_000

#: Nodes of a subtree that a task has grown have numbers from here on, but for its root.
LOW_NODES = 1 << 32

#: Nodes of a tree that are packed in one task, rows whose votes are one record, rows that walk down a tree together.
SHELF_NODES, SLICE, WALK = 500_000, 1 << 16, 1 << 14
#: A code that no row exceeds.
NO_CODE = 0xFFFF

PART = "tree int, shelf int, ids binary, step binary, leaf binary, shares binary"
NODES = "tree int, node bigint, feature int, threshold double, left bigint, right bigint, votes array<double>, rows bigint"
#: Rows of a shelf (some leaves of a tree), many in one record: the bytes of a column of each.
GROUPED = "tree int, shelf int, leaf binary, codes binary, label binary, weight binary, key binary"


def model_nodes(model) -> DataFrame:
    """The nodes (NODES) of a fitted tree or forest; a leaf has feature -1, votes are the weights of the classes."""
    spark = SparkSession.active()
    folder = new_folder(spark, "forest")
    model.write().save(folder)
    stored = spark.read.parquet(f"{folder}/data")
    if "nodeData" in stored.columns:
        stored = stored.select(F.col("treeID").alias("tree"), "nodeData.*")
    else:
        stored = stored.withColumn("tree", F.lit(0))
    return stored.select(
        F.col("tree").cast("int").alias("tree"),
        F.col("id").cast("bigint").alias("node"),
        F.col("split.featureIndex").alias("feature"),
        F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        F.col("leftChild").cast("bigint").alias("left"),
        F.col("rightChild").cast("bigint").alias("right"),
        F.col("impurityStats").alias("votes"),
        F.col("rawCount").alias("rows"),
    )


@dataclass
class NodeArrays:
    """A forest as arrays over all nodes; children are places in them, a leaf is its own child."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    votes: np.ndarray

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every row (down) and tree (across)."""
        at = np.repeat(self.roots[None, :], len(x), axis=0)
        row, tree = np.nonzero(self.feature[at] >= 0)
        while len(row):
            node = at[row, tree]
            down = np.where(x[row, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            at[row, tree] = down
            open_ = self.feature[down] >= 0
            row, tree = row[open_], tree[open_]
        return at

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Votes of all trees, each tree's adding up to one, summed tree after tree as the library does."""
        found, total = self.leaves(x), np.zeros((len(x), self.votes.shape[1]))
        for tree in range(found.shape[1]):
            total += self.votes[found[:, tree]]
        return total


def node_arrays(nodes: DataFrame) -> NodeArrays:
    """The table as arrays. A forest that every scoring task has to hold is bounded by MOST_NODES; a larger one is refused."""
    n = nodes.count()
    if n > MOST_NODES:
        raise ValueError(f"{n} nodes are more than a scoring task holds ({MOST_NODES}); raise rows a leaf or use fewer trees")
    held = nodes.orderBy("tree", "node").toArrow()
    column = lambda c: held.column(c).to_numpy()
    tree, node, feature = column("tree").astype(np.int64), column("node"), column("feature").astype(np.int32)
    numbers = np.unique(node)  # ids are sparse: a place among all ids keeps (tree, id) in 64 bits
    key = tree * len(numbers) + np.searchsorted(numbers, node)
    own = np.arange(n)

    def places(children: np.ndarray) -> np.ndarray:
        inner = feature >= 0
        found = own.copy()
        found[inner] = np.searchsorted(key, tree[inner] * len(numbers) + np.searchsorted(numbers, children[inner]))
        return found

    votes = held.column("votes").combine_chunks().flatten().to_numpy().reshape(n, -1)
    votes = votes / np.maximum(votes.sum(axis=1, keepdims=True), 1e-300)
    roots = np.flatnonzero(np.append(True, tree[1:] != tree[:-1])) if n else own
    threshold = np.nan_to_num(held.column("threshold").to_numpy().astype(float))
    return NodeArrays(roots, feature, threshold, places(column("left")), places(column("right")), votes)


def _chosen(key: np.ndarray, features: int, tried: int) -> np.ndarray:
    """The features that each node tries, in order; they follow from the node's key alone."""
    if tried >= features:
        return np.repeat(np.arange(features)[None, :], len(key), axis=0)
    draw = np.stack([unit(key, f) for f in range(features)], axis=1)
    return np.sort(np.argpartition(draw, tried, axis=1)[:, :tried], axis=1)


def _sorted_by(key: np.ndarray, count: int) -> np.ndarray:
    """The order by a key below count, equal ones as they came; short keys are sorted in passes over their bytes."""
    return np.argsort(key.astype(np.uint16) if count <= 1 << 16 else key, kind="stable")


def _in_order(node: np.ndarray, value: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The order by (node, value), equal ones as they came; node is in order already, with its starts, and value is a byte.

    256 nodes at a time have keys of two bytes.
    """
    key = (node.astype(np.uint16) << 8) | value
    ends = np.append(starts[256::256], len(node))
    return np.concatenate([lo + np.argsort(key[lo:hi], kind="stable") for lo, hi in zip(starts[::256], ends)])


def _splits(codes: np.ndarray, node: np.ndarray, label: np.ndarray, weight: np.ndarray, votes: np.ndarray, chosen: np.ndarray):
    """(gain, feature, code) of the best split of every node, from rows in the order of their nodes.

    Of equal gains the first feature and the lowest code win; gains are shares of a node's weight, to nine digits. Nodes
    of many rows count them by code, the others sort them; nodes of either kind best lie together.
    """
    count, classes = votes.shape
    starts = np.searchsorted(node, np.arange(count + 1))
    large = _is_large(np.diff(starts), classes)
    edges = [0, *(np.flatnonzero(large[1:] != large[:-1]) + 1).tolist(), count]
    found = []
    for a, b in zip(edges, edges[1:]):
        search, rows = _dense_splits if large[a:b].any() else _sparse_splits, slice(starts[a], starts[b])
        found.append(search(codes[rows], node[rows] - a, label[rows], weight[rows], votes[a:b], chosen[a:b]))
    return tuple(np.concatenate(parts) for parts in zip(*found))


def _is_large(rows: np.ndarray, classes: int) -> np.ndarray:
    return rows >= COUNTED_ROWS * classes


def _dense_splits(codes: np.ndarray, node: np.ndarray, label: np.ndarray, weight: np.ndarray, votes: np.ndarray, chosen: np.ndarray):
    """`_splits` by the weights of each node's codes and classes."""
    count, classes = votes.shape
    best, feature, code = np.zeros(count), np.zeros(count, np.int64), np.zeros(count, np.int64)
    size = np.bincount(node, minlength=count)
    flat, row = codes.reshape(-1), np.arange(len(node)) * codes.shape[1]
    cell = node * (256 * classes) + label
    for column in chosen.T:
        value = flat[row + np.repeat(column, size)]
        cells = np.bincount(cell + value * np.int64(classes), weight, count * 256 * classes).reshape(count, 256, classes)
        most, first = _cell_splits(cells, votes)
        better = most > best
        best[better], feature[better], code[better] = most[better], column[better], first[better]
    return best, feature, code


def _cell_splits(cells: np.ndarray, votes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(gain, code) of the best split of every node by one feature, from the weights of its codes and classes."""
    total, held = votes.sum(axis=1)[:, None], (votes * votes).sum(axis=1)[:, None]
    every, filled = np.arange(len(votes)), cells.any(axis=2)
    # A split lies after a code that has rows and is not the node's last.
    filled[every, 255 - filled[:, ::-1].argmax(axis=1)] = False
    low = np.cumsum(cells, axis=1)
    below, squares = low.sum(axis=2), np.einsum("nvc,nvc->nv", low, low)
    high = held - 2.0 * np.einsum("nvc,nc->nv", low, votes) + squares
    gain = squares / np.maximum(below, 1e-12) + high / np.maximum(total - below, 1e-12) - held / total
    gain = np.where(filled, np.round(gain / total, 9), -1.0)
    first = gain.argmax(axis=1)
    return gain[every, first], first


def _sparse_splits(codes: np.ndarray, node: np.ndarray, label: np.ndarray, weight: np.ndarray, votes: np.ndarray, chosen: np.ndarray):
    """`_splits` by sorting each node's rows: sums run over the rows of all nodes, so nodes of little weight should come
    first, where large ones cannot blur them."""
    count, classes = votes.shape
    total, held = votes.sum(axis=1), (votes * votes).sum(axis=1)
    best, feature, code = np.zeros(count), np.zeros(count, np.int64), np.zeros(count, np.int64)
    n = len(node)
    if not n:
        return best, feature, code
    size = np.bincount(node, minlength=count)
    starts = np.cumsum(size) - size
    last = np.append(node[1:] != node[:-1], True)
    flat, row = codes.reshape(-1), np.arange(n) * codes.shape[1]
    short = label.astype(np.uint8 if classes <= 256 else np.uint16)
    impure = held / total
    # By class and node, rows of one class of a node lie together whatever the feature.
    alike = np.bincount(label * np.int64(count) + node, minlength=classes * count)
    alike = alike[alike > 0]
    first_alike = np.cumsum(alike) - alike
    # Weights, and weights times what their class weighs in the node, as the two parts of one number.
    pair = weight + 1j * (weight * votes[node, label])

    def from_start(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # Running sums, and what they were before each node.
        sums = np.cumsum(x)
        return sums, np.where(starts > 0, sums[starts - 1], 0.0)

    for column in chosen.T:
        value = flat[row + np.repeat(column, size)]
        order = _in_order(node, value, starts)
        value = value[order]
        # A split lies after the last row of a value that is not the node's last.
        ends = np.flatnonzero((value[1:] != value[:-1]) & ~last[:-1])
        if not len(ends):
            continue
        pairs = pair[order]
        w = np.ascontiguousarray(pairs.real)
        # The weight of a row's own class that lies before it in its node.
        by = np.argsort(short[order], kind="stable")
        before = w[by]
        before = np.cumsum(before) - before
        before -= np.repeat(before[first_alike], alike)
        earlier = np.empty(n)
        earlier[by] = before
        # Squares of the classes' weights below and above a split, without a column for each class.
        squares, squares_0 = from_start(w * (2.0 * earlier + w))
        pairs, pairs_0 = from_start(pairs)
        at = node[ends]
        low = squares[ends] - squares_0[at]
        pairs = pairs[ends] - pairs_0[at]
        below = pairs.real
        high = held[at] - 2.0 * pairs.imag + low
        above = np.maximum(total[at] - below, 1e-12)
        share = low / np.maximum(below, 1e-12) + high / above
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        # Only what is within a rounding of a node's most is rounded.
        most, held_by = np.maximum.reduceat(share, first), at[first]
        near = np.flatnonzero(share >= np.repeat(most - 2e-9 * total[held_by], np.diff(np.append(first, len(at)))))
        gain = lambda share, i: np.round((share - impure[i]) / total[i], 9)
        most = gain(most, held_by)
        place = near[gain(share[near], at[near]) == np.repeat(most, np.bincount(np.searchsorted(held_by, at[near]), minlength=len(most)))]
        place = place[np.append(True, at[place[1:]] != at[place[:-1]])]
        better = most > best[held_by]
        place = place[better]
        found = at[place]
        best[found], feature[found], code[found] = most[better], column[found], value[ends[place]]
    return best, feature, code


def grow(
    codes: np.ndarray, node: np.ndarray, label: np.ndarray, weight: np.ndarray, classes: int, depth: np.ndarray, tried: int, key: np.ndarray
) -> dict[str, np.ndarray]:
    """Subtrees to the end, all of them level by level, on rows of coded features (a byte each).

    node numbers each row's root; depth and key are the levels that each root may have and its own number. A node takes
    the split of the most Gini gain among `tried` features and is a leaf when no split gains, one class is left or the
    depth is used up. Returns the nodes' feature (-1: leaf), code (rows with `code <= value` go left), left and right
    (places among the nodes, which begin with the roots), votes and rows.
    """
    levels: list[tuple] = []
    rows, made = np.arange(len(label)), len(depth)
    while len(depth):
        count = len(depth)
        votes = np.bincount(node * classes + label[rows], weight[rows], count * classes).reshape(count, classes)
        held = np.bincount(node, minlength=count)
        feature, code = np.full(count, -1), np.zeros(count, np.int64)
        left, right = np.full(count, -1), np.full(count, -1)
        open_ = np.flatnonzero((depth > 0) & ((votes > 0).sum(axis=1) > 1))
        open_ = open_[np.lexsort((votes[open_].sum(axis=1), _is_large(held[open_], classes)))]
        place = np.full(count, -1)
        place[open_] = np.arange(len(open_))
        stays = place[node] >= 0
        rows, node = rows[stays], place[node[stays]]
        order = _sorted_by(node, len(open_))
        rows, node = rows[order], node[order]
        gain, of_feature, of_code = _splits(codes.take(rows, axis=0), node, label[rows], weight[rows], votes[open_], _chosen(key[open_], codes.shape[1], tried))
        split = np.flatnonzero(gain > 0)
        chosen = open_[split]
        feature[chosen], code[chosen] = of_feature[split], of_code[split]
        left[chosen], right[chosen] = made + 2 * np.arange(len(split)), made + 2 * np.arange(len(split)) + 1
        levels.append((feature, code, left, right, votes, held))
        place = np.full(len(open_), -1)
        place[split] = 2 * np.arange(len(split))
        stays = place[node] >= 0
        rows, node = rows[stays], node[stays]
        goes = codes[rows, of_feature[node]] <= of_code[node]
        node = place[node] + ~goes
        depth, made = np.repeat(depth[chosen] - 1, 2), made + 2 * len(split)
        key = _child_keys(key[chosen])
    names = ("feature", "code", "left", "right", "votes", "rows")
    return {name: np.concatenate(parts) for name, parts in zip(names, zip(*levels))}


def _child_keys(key: np.ndarray) -> np.ndarray:
    """The keys of the left and right children of nodes."""
    return (unit(np.repeat(key, 2), 1 << 20) * 2.0**53).astype(np.int64) * 2 + np.tile([0, 1], len(key))


def _draws(key: np.ndarray, tree: int) -> np.ndarray:
    """How often each row is in a tree's bag: Poisson numbers of mean 1 that follow from row and tree, so that a task that
    runs again draws the same."""
    upto = np.cumsum([0.36787944117144233 / f for f in np.cumprod([1, 1, 2, 3, 4, 5, 6, 7, 8, 9])])
    return np.searchsorted(upto, unit(key, tree), "right")


def _codes(batch: pa.RecordBatch, edges: list[np.ndarray]) -> np.ndarray:
    """The features of a batch as places among the edges: a byte each, or two where a feature has more than 255 edges."""
    x, kind = _matrix(batch), np.uint8 if max(map(len, edges)) < 256 else np.uint16
    return np.stack([np.searchsorted(e, x[:, i], "left").astype(kind) for i, e in enumerate(edges)], axis=1)


@dataclass
class Open:
    """Where a tree's rows go on below the library's levels.

    `ends` are the numbers of the library's leaves, by their place; `splits` are those that passes have added since, each
    (node, feature, code, left, right) and parents first; `goes` has a place for every node in `numbers` (in order) at which
    rows are still needed.
    """

    ends: np.ndarray
    splits: list[tuple[int, int, int, int, int]]
    numbers: np.ndarray
    goes: np.ndarray

    def places(self, leaf: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the node, `goes`) of every row; -1 where it is needed no more."""
        node = self.ends[leaf]
        for split, feature, code, left, right in self.splits:
            at = np.flatnonzero(node == split)
            node[at] = np.where(codes[at, feature] <= code, left, right)
        if not len(self.numbers):
            return node, np.full(len(node), -1)
        place = np.minimum(np.searchsorted(self.numbers, node), len(self.numbers) - 1)
        return node, np.where(self.numbers[place] == node, self.goes[place], -1)


def _drawn(batch: pa.RecordBatch, edges: list[np.ndarray], trees: dict[int, Open], bagged: bool):
    """(tree, rows of the batch in its bag that are still needed, their nodes, where they go, weights), and codes, label, key."""
    n = batch.num_rows
    leaf = batch.column("leaf").flatten().to_numpy(zero_copy_only=False).reshape(n, -1).astype(np.int64)
    codes = _codes(batch, edges)
    label, weight = batch.column("label").to_numpy().astype(np.int32), batch.column("weight").to_numpy()
    key = batch.column("key").to_numpy()

    def drawn():
        for tree, open_ in trees.items():
            times = _draws(key, tree) if bagged else np.ones(n, np.int64)
            node, goes = open_.places(leaf[:, tree], codes)
            rows = np.flatnonzero((times > 0) & (goes >= 0))
            if len(rows):
                yield tree, rows, node[rows], goes[rows], weight[rows] * times[rows]

    return drawn(), codes, label, key


def _counted(edges: list[np.ndarray], trees: dict[int, Open], chosen: dict[int, np.ndarray], classes: int, bagged: bool):
    """Weights and rows of the large nodes of all trees by tried feature, code and class, a record for each node and task.

    `goes` counts a tree's large nodes; `chosen` has the features that each tries.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[np.ndarray]] = {}

        def records() -> pa.RecordBatch:
            part = TaskContext.get().partitionId()
            columns = [pa.array([k[0] for k in held], pa.int32()), pa.array([k[1] for k in held], pa.int64()), pa.array([part] * len(held), pa.int32())]
            blobs = [pa.array([v[i].tobytes() for v in held.values()], pa.binary()) for i in (0, 1)]
            return pa.RecordBatch.from_arrays(columns + blobs, names=["tree", "node", "part", "cells", "counts"])

        for batch in batches:
            if not batch.num_rows:
                continue
            drawn, codes, label, _ = _drawn(batch, edges, trees, bagged)
            for tree, rows, node, goes, weight in drawn:
                for place in np.unique(goes):
                    at = np.flatnonzero(goes == place)
                    features = chosen[tree][place]
                    cells, counts = held.setdefault(
                        (tree, int(node[at[0]])), [np.zeros((len(features), 256 * classes)), np.zeros((len(features), 256), np.int64)]
                    )
                    for i, feature in enumerate(features):
                        value = codes[rows[at], feature].astype(np.int64)
                        cells[i] += np.bincount(value * classes + label[rows[at]], weight[at], 256 * classes)
                        counts[i] += np.bincount(value, minlength=256)
            if sum(v[0].nbytes for v in held.values()) > COUNTED_BYTES:
                yield records()
                held.clear()
        if held:
            yield records()

    return run


def _summed(classes: int, chosen: dict[tuple[int, int], np.ndarray]):
    """The best split of a large node from what its tasks counted, and votes and rows of its two children."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        tree, node = (k.as_py() for k in key)
        table, features = table.sort_by("part"), chosen[tree, node]
        cells = sum(np.frombuffer(c).reshape(len(features), 256, classes) for c in table.column("cells").to_pylist())
        counts = sum(np.frombuffer(c, np.int64).reshape(len(features), 256) for c in table.column("counts").to_pylist())
        votes = cells[0].sum(axis=0)
        gain, code = _cell_splits(cells, np.repeat(votes[None, :], len(features), axis=0))
        best = int(gain.argmax())
        low, rows = cells[best][: code[best] + 1].sum(axis=0), int(counts[best][: code[best] + 1].sum())
        found = {"tree": tree, "node": node, "gain": gain[best], "feature": int(features[best]), "code": int(code[best])}
        found |= {"votes": votes.tolist(), "low": low.tolist(), "high": cells[best][code[best] + 1 :].sum(axis=0).tolist()}
        found |= {"rows_low": rows, "rows": int(counts[best].sum())}
        return pa.Table.from_pylist([found], schema=pa.schema(
            [("tree", pa.int32()), ("node", pa.int64()), ("gain", pa.float64()), ("feature", pa.int32()), ("code", pa.int32()), ("rows", pa.int64()),
             ("rows_low", pa.int64()), *((c, pa.list_(pa.float64())) for c in ("votes", "low", "high"))]
        ))

    return run


SPLIT = "tree int, node bigint, gain double, feature int, code int, rows bigint, rows_low bigint, votes array<double>, low array<double>, high array<double>"


def _coded(edges: list[np.ndarray], trees: dict[int, Open], bagged: bool):
    """Rows (features, leaf, label, weight, key) once for each tree whose bag has them and whose leaf is still open.

    `goes` is the shelf of an open leaf. Rows of a batch that go to one shelf are one record of GROUPED, so that what Spark
    sorts and sends are few records and not one for each row and tree.
    """
    names = [c.split()[0] for c in GROUPED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            drawn, codes, label, key = _drawn(batch, edges, trees, bagged)
            for tree, rows, node, shelf, weight in drawn:
                order = np.argsort(shelf, kind="stable")
                rows, shelf = rows[order], shelf[order]
                shelves, first = np.unique(shelf, return_index=True)
                columns = (node[order], codes[rows], label[rows], weight[order], key[rows])
                packed = [[np.ascontiguousarray(x).tobytes() for x in np.split(c, first[1:])] for c in columns]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(shelves), tree, np.int32)), pa.array(shelves.astype(np.int32)), *(pa.array(x, pa.binary()) for x in packed)],
                    names=names,
                )

    return run


def _shelved(rows: list[int], most: int) -> np.ndarray:
    """A shelf for each of a tree's open leaves, from their rows: shelves of much the same rows, about `most` each."""
    shelves = max(1, int(np.ceil(sum(rows) / most)))
    held, shelf = np.zeros(shelves), np.zeros(len(rows), np.int64)
    for i in np.argsort(rows, kind="stable")[::-1]:
        shelf[i] = held.argmin()
        held[shelf[i]] += rows[i]
    return shelf


def _bytes_of(table: pa.Table, column: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(column).to_pylist()), kind)


def _subtrees(edges: list[np.ndarray], classes: int, left_over: dict[tuple[int, int], tuple[int, int]], tried: int):
    flat = np.concatenate(edges)
    first = np.cumsum([0, *map(len, edges)])

    def run(key: tuple, table: pa.Table) -> pa.Table:
        tree = key[0].as_py()
        leaf, key_of, label = _bytes_of(table, "leaf", np.int64), _bytes_of(table, "key", np.int64), _bytes_of(table, "label", np.int32)
        codes, weight = _bytes_of(table, "codes", np.uint8).reshape(len(leaf), -1), _bytes_of(table, "weight", np.float64)
        # The same order whatever order the rows came in: the key follows from features and label.
        order = np.lexsort((weight, key_of, leaf))
        roots, root = np.unique(leaf[order], return_inverse=True)
        levels, keys = np.array([left_over[tree, i] for i in roots.tolist()], np.int64).T
        grown = grow(codes[order], root, label[order], weight[order], classes, levels, tried, keys)
        # A root takes its leaf's number; the others are numbered from their root's and their place.
        n, inner = len(grown["feature"]), grown["feature"] >= 0
        of_root = np.arange(n)
        for child in ("left", "right"):
            at = np.flatnonzero(inner)
            of_root[grown[child][at]] = at
        while (of_root >= len(roots)).any():
            of_root = of_root[of_root]
        number = np.where(np.arange(n) < len(roots), roots[of_root], ((roots[of_root] + 1) << 32) + np.arange(n))
        child = lambda c: np.where(inner, number[grown[c]], -1)
        threshold = flat[np.where(inner, first[grown["feature"]] + grown["code"], 0)]
        votes = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * classes), pa.array(grown["votes"].ravel()))
        return pa.table(
            {
                "tree": pa.array(np.full(n, tree, np.int32)),
                "node": pa.array(number),
                "feature": pa.array(grown["feature"].astype(np.int32)),
                "threshold": pa.array(threshold, mask=~inner),
                "left": pa.array(child("left")),
                "right": pa.array(child("right")),
                "votes": votes,
                "rows": pa.array(grown["rows"].astype(np.int64)),
            }
        )

    return run


def feature_edges(rows: DataFrame, size: int) -> list[np.ndarray]:
    """Up to EDGES values of each feature that part its rows evenly; rows of 256 codes are a byte a feature."""
    shares = [(i + 1) / (EDGES + 1) for i in range(EDGES)]
    found = rows.select(*[F.percentile_approx(F.get("features", F.lit(i)), shares, 10 * EDGES).alias(f"f{i}") for i in range(size)]).first()
    return [np.unique(np.array(e, float)) for e in found]


def fit_deep(rows: DataFrame, classifier, depth: int, tried: int | None = None, bagged: bool = True) -> DataFrame:
    """The nodes (NODES) of a forest of that depth, from rows with features, label and weight.

    `classifier` (a tree or forest) grows its own maxDepth of levels with passes over all rows. A leaf of more than TASK_ROWS
    rows is split by further passes, which count such leaves alone, until none is left. Then the rows of every leaf that is
    not pure meet in one task, once for each tree whose bag draws them, as one byte a feature, and the task grows the rest.
    A node's features follow from tree and path, and a row's draws from its values, so a repeated task returns the same
    subtrees.

    `with_deep_prediction` scores such a forest without any process that holds it.
    """
    spark = rows.sparkSession
    ship(spark)
    top_depth = classifier.getMaxDepth()
    model = classifier.copy({classifier.maxDepth: min(top_depth, depth)}).fit(rows)
    nodes = staged(model_nodes(model))
    if top_depth >= depth:
        return nodes
    size, classes = model.numFeatures, model.numClasses
    plain = rows.select(vector_to_array("features").alias("array"), "features", "label", "weight")
    model.setLeafCol("leaf")
    leaf = vector_to_array("leaf") if hasattr(model, "trees") else F.array("leaf")
    placed = model.transform(plain).select(
        F.col("array").alias("features"),
        leaf.cast("array<int>").alias("leaf"),
        F.col("label").cast("double").alias("label"),
        F.col("weight").cast("double").alias("weight"),
        F.xxhash64("array", "label").alias("key"),
    )
    placed = staged(placed)
    edges = feature_edges(placed, size)
    # The upper levels fit on the driver, as the model itself does: at most 2^levels nodes a tree.
    upper = nodes.select("tree", "node", "feature", "left", "right", "votes", "rows").orderBy("tree", "node").collect()
    count = max(r["tree"] for r in upper) + 1
    tried = tried or (size if count == 1 else int(np.ceil(np.sqrt(size))))
    seed = classifier.getSeed() & 0x7FFFFFFF
    trees: dict[int, Open] = {}
    # What may still be split, (tree, node): rows, levels left and key.
    left: dict[tuple[int, int], tuple[int, int, int]] = {}
    next_node: list[int] = []
    for tree in range(count):
        own = {r["node"]: r for r in upper if r["tree"] == tree}
        levels, stack = {0: 0}, [0]
        while stack:
            at = stack.pop()
            if own[at]["feature"] >= 0:
                for child in (own[at]["left"], own[at]["right"]):
                    levels[child] = levels[at] + 1
                    stack.append(child)
        ends = np.array([i for i in sorted(own) if own[i]["feature"] < 0], np.int64)
        keys = (unit(ends, seed + tree) * 2.0**53).astype(np.int64)
        for i, key in zip(ends.tolist(), keys.tolist()):
            if sum(v > 0 for v in own[i]["votes"]) > 1:
                left[tree, i] = (own[i]["rows"], depth - levels[i], key)
        trees[tree] = Open(ends, [], ends[:0], ends[:0])
        next_node.append(max(own) + 1)
    made: dict[tuple[int, int], tuple] = {}
    while large := sorted(k for k, (held, _, _) in left.items() if held > TASK_ROWS):
        _split_large(placed, edges, trees, left, next_node, made, large, classes, size, tried, bagged)
    groups = 0
    for tree, open_ in trees.items():
        numbers = sorted(i for t, i in left if t == tree)
        # A tree's leaves share tasks of about TASK_ROWS / 4 rows, which grow them side by side.
        shelf = _shelved([left[tree, i][0] for i in numbers], max(1, TASK_ROWS // 4))
        open_.numbers, open_.goes = np.array(numbers, np.int64), shelf
        groups += len(np.unique(shelf))
    left_over = {k: v[1:] for k, v in left.items()}
    grouped = _spread(placed.mapInArrow(_coded(edges, trees, bagged), GROUPED), groups, "tree", "shelf")
    grown = staged(grouped.groupBy("tree", "shelf").applyInArrow(_subtrees(edges, classes, left_over, tried), NODES))
    if made:
        added = spark.createDataFrame([(*k, *v) for k, v in made.items()], NODES)
        nodes = nodes.join(F.broadcast(added.select("tree", "node")), ["tree", "node"], "left_anti").unionByName(added)
    replaced = grown.where(F.col("node") < LOW_NODES).select("tree", "node")
    return staged(nodes.join(replaced, ["tree", "node"], "left_anti")).unionByName(grown)


def _split_large(placed, edges, trees, left, next_node, made, large, classes, size, tried, bagged) -> None:
    """One pass that splits every `large` node, or ends it. What comes to the driver is one row a node."""
    chosen = {k: _chosen(np.array([left[k][2]]), size, tried)[0] for k in large}
    some = {}
    for tree in dict.fromkeys(t for t, _ in large):
        numbers = np.array([i for t, i in large if t == tree], np.int64)
        some[tree] = Open(trees[tree].ends, trees[tree].splits, numbers, np.arange(len(numbers)))
    by_place = {t: [chosen[t, i] for i in o.numbers.tolist()] for t, o in some.items()}
    partials = placed.mapInArrow(_counted(edges, some, by_place, classes, bagged), "tree int, node bigint, part int, cells binary, counts binary")
    found = {(r["tree"], r["node"]): r for r in partials.groupBy("tree", "node").applyInArrow(_summed(classes, chosen), SPLIT).collect()}
    for k in large:
        tree, node = k
        _, levels, key = left.pop(k)
        r = found.get(k)
        if r is None or r["gain"] <= 0:
            continue
        low, high = next_node[tree], next_node[tree] + 1
        next_node[tree] += 2
        trees[tree].splits.append((node, r["feature"], r["code"], low, high))
        made[k] = (r["feature"], float(edges[r["feature"]][r["code"]]), low, high, r["votes"], r["rows"])
        child_keys = _child_keys(np.array([key])).tolist()
        for child, votes, rows, child_key in zip((low, high), (r["low"], r["high"]), (r["rows_low"], r["rows"] - r["rows_low"]), child_keys):
            made[tree, child] = (-1, None, -1, -1, votes, rows)
            if levels > 1 and sum(v > 0 for v in votes) > 1:
                left[tree, child] = (rows, levels - 1, child_key)


def _spread(df: DataFrame, groups: int, *key: str) -> DataFrame:
    """df in partitions by the key, so many that few of the cores' partitions hold several groups more than others."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(1, min(2 * groups, 16 * cores)), *key)


def with_prediction(df: DataFrame, forest: NodeArrays, features: str = "features", output: str = "prediction") -> DataFrame:
    """df with the class number that the forest gives its feature vector."""
    spark = df.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast(forest)  # bounded by MOST_NODES

    @F.pandas_udf("double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            x = np.stack(batch.to_numpy()).astype(float) if len(batch) else np.zeros((0, 1))
            yield pd.Series(held.value.scores(x).argmax(axis=1).astype(float) if len(batch) else [], dtype=float)

    return df.withColumn(output, predict(vector_to_array(features)))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _coded_rows(edges: list[np.ndarray]):
    """Rows (row, features), a record a batch: its first row, and all rows' numbers and codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                row, codes = batch.column("row").to_numpy(), _codes(batch, edges).astype(np.uint16)
                columns = [pa.array(row[:1]), *(pa.array([x.tobytes()], pa.binary()) for x in (row, codes))]
                yield pa.RecordBatch.from_arrays(columns, names=["first", "ids", "step"])

    return run


def _packed(edges: list[np.ndarray], classes: int):
    """The nodes of one shelf of a tree as PART: roots come first, the two children of a node lie side by side.

    A step is a node's left child, code and feature in one number; rows whose code is no larger go left, the others to the
    place after it. A leaf's step is to itself. `leaf` is its class if it has one, or a place among `shares` after that.
    """

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        node, feature, threshold = (table.column(c).to_numpy() for c in ("node", "feature", "threshold"))
        inner = np.flatnonzero(feature >= 0)
        left, right = (np.searchsorted(node, table.column(c).to_numpy()[inner]) for c in ("left", "right"))
        is_root = np.ones(len(node), bool)
        is_root[left] = is_root[right] = False
        roots = np.flatnonzero(is_root)
        place, pairs = np.empty(len(node), np.int64), len(roots) + 2 * np.arange(len(inner))
        place[roots], place[left], place[right] = np.arange(len(roots)), pairs, pairs + 1
        code = np.zeros(len(node), np.int64)
        for i, e in enumerate(edges):
            at = inner[feature[inner] == i]
            code[at] = np.searchsorted(e, threshold[at])
        step, leaf = (place << 32) | (NO_CODE << 16), np.zeros(len(node), np.int32)
        step[inner] = (pairs << 32) | (code[inner] << 16) | feature[inner]
        votes = table.column("votes").combine_chunks().flatten().to_numpy().reshape(len(node), -1)
        mixed = np.flatnonzero((feature < 0) & ((votes > 0).sum(axis=1) != 1))
        leaf[:] = votes.argmax(axis=1)
        leaf[mixed] = classes + np.arange(len(mixed))
        shares = votes[mixed] / np.maximum(votes[mixed].sum(axis=1, keepdims=True), 1e-300)
        order = np.empty(len(node), np.int64)
        order[place] = np.arange(len(node))
        # The upper levels tell the number of every node, others of their roots.
        ids = node[order] if key[1].as_py() < 0 else node[roots]
        blobs = [x.tobytes() for x in (ids, step[order], leaf[order], shares)]
        return pa.table({"tree": pa.array([key[0].as_py()], pa.int32()), "shelf": pa.array([key[1].as_py()], pa.int32())} | {
            name: pa.array([x], pa.binary()) for name, x in zip(("ids", "step", "leaf", "shares"), blobs)
        })

    return run


def _whole_tree(parts: list[dict], classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(step, leaf, shares) of a tree from its PARTs; its root is at 0. A leaf of the upper levels that is the root of a
    subtree steps to it."""
    parts = sorted(parts, key=lambda p: p["shelf"])
    steps, leaves, shares, ids, places, first, mixed = [], [], [np.eye(classes)], [], [], 0, classes
    for part in parts:
        step, leaf = np.frombuffer(part["step"], np.int64), np.frombuffer(part["leaf"], np.int32)
        own = np.frombuffer(part["shares"]).reshape(-1, classes)
        steps.append(step + (first << 32))
        leaves.append(np.where(leaf >= classes, leaf + (mixed - classes), leaf))
        shares.append(own)
        if part["shelf"] >= 0:
            ids.append(np.frombuffer(part["ids"], np.int64))
            places.append(first + np.arange(len(ids[-1])))
        first, mixed = first + len(step), mixed + len(own)
    step = np.concatenate(steps)
    if ids:
        roots, place = np.concatenate(ids), np.concatenate(places)
        upper = np.frombuffer(parts[0]["ids"], np.int64)
        order = np.argsort(roots)
        found = np.minimum(np.searchsorted(roots, upper, sorter=order), len(roots) - 1)
        goes_on = roots[order[found]] == upper
        step[: len(upper)][goes_on] = (place[order[found[goes_on]]] << 32) | (NO_CODE << 16)
    return step, np.concatenate(leaves), np.concatenate(shares)


def _ends(step: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Where the rows (codes) end that walk down a tree; rows that have ended are left out once they are half of those going."""
    flat, row, at = codes.reshape(-1), np.arange(len(codes)) * codes.shape[1], np.zeros(len(codes), np.int64)
    ends, going = at.copy(), np.arange(len(codes))
    while len(going):
        here = step.take(at)
        value = flat.take(row + (here & 0xFFFF))
        here >>= 16
        goes_right = value > here.astype(np.uint16)
        here >>= 16
        here += goes_right
        moved = here != at
        at = here
        if np.count_nonzero(moved) <= len(going) // 2:
            ends[going] = at
            going, row, at = going[moved], row[moved], at[moved]
    return ends


def _votes(classes: int, groups: int):
    """Votes of a group of trees for the rows of a block: a record for each SLICE of its rows, in the order of their numbers."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        tree = table.column("tree").to_numpy()
        rows = table.filter(pa.array(tree < 0))
        ids = _bytes_of(rows, "ids", np.int64)
        order = np.argsort(ids)
        ids, codes = ids[order], _bytes_of(rows, "step", np.uint16).reshape(len(ids), -1)[order] if len(ids) else ids
        total = np.zeros((len(ids), classes))
        starts = range(0, len(ids), SLICE)
        for i in np.unique(tree[tree >= 0]) if len(ids) else ():
            step, leaf, shares = _whole_tree(table.filter(pa.array(tree == i)).to_pylist(), classes)
            for a in range(0, len(ids), WALK):
                total[a : a + WALK] += shares[leaf[_ends(step, codes[a : a + WALK])]]
        n, (block, group) = len(starts), divmod(key[0].as_py(), groups)
        return pa.table(
            {
                "block": pa.array(np.full(n, block, np.int32)),
                "slice": pa.array(np.arange(n, dtype=np.int32)),
                "group": pa.array(np.full(n, group, np.int32)),
                "ids": pa.array([ids[a : a + SLICE].tobytes() for a in starts], pa.binary()),
                "votes": pa.array([total[a : a + SLICE].tobytes() for a in starts], pa.binary()),
            }
        )

    return run


def _elected(classes: int):
    """Row and class number of most votes from all groups of trees, for one slice of rows."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("group")
        row = np.frombuffer(table.column("ids")[0].as_py(), np.int64)
        total = _bytes_of(table, "votes", np.float64).reshape(table.num_rows, len(row), classes).sum(axis=0)
        return pa.table({"row": pa.array(row), "class": pa.array(np.round(total, 9).argmax(axis=1).astype(float))})

    return run


def with_deep_prediction(df: DataFrame, nodes: DataFrame, features: str = "features", output: str = "prediction") -> DataFrame:
    """df with the class number that a forest of `fit_deep` gives its feature vector; no process holds the forest.

    Nodes are packed in shelves (PART), and rows in batches of codes. A block of rows and a group of trees meet in a task,
    which holds one tree at a time as arrays: a row goes to a task once for each group and not for each tree, and a
    task's votes are summed before they leave it. Of equal sums (to nine digits) the first class wins.
    """
    spark = df.sparkSession
    ship(spark)
    kept = staged(df.withColumn("_row", F.monotonically_increasing_id()))
    rows = kept.select(F.col("_row").alias("row"), vector_to_array(features).alias("features"))
    # The edges of the codes are the forest's thresholds, which come from few edges a feature.
    of: dict[int, list[float]] = {}
    for r in nodes.where("feature >= 0").select("feature", "threshold").distinct().collect():
        of.setdefault(r["feature"], []).append(r["threshold"])
    edges = [np.sort(np.array(of.get(i, []), float)) for i in range(max(of, default=0) + 1)]
    if max(map(len, edges)) >= NO_CODE or len(edges) > NO_CODE:
        raise ValueError(f"{NO_CODE} or more thresholds of a feature")
    size = nodes.agg(F.count(F.lit(1)).alias("nodes"), F.countDistinct("tree").alias("trees"), F.max(F.size("votes")).alias("classes")).first()
    classes, trees = size["classes"], size["trees"]
    below = F.col("left") >= LOW_NODES
    columns = ["tree", "shelf", "node", "feature", "threshold", "left", "right", "votes"]
    top = nodes.where(F.col("node") < LOW_NODES).withColumns({"feature": F.when(below, -1).otherwise(F.col("feature")), "shelf": F.lit(-1).cast("bigint")})
    root = F.when(F.col("node") < LOW_NODES, F.col("node")).otherwise(F.shiftright("node", 32) - 1)
    shelves = int(np.ceil(size["nodes"] / trees / SHELF_NODES))
    deep = nodes.where((F.col("node") >= LOW_NODES) | below).withColumn("shelf", F.pmod(F.xxhash64(root), F.lit(shelves)))
    shelved = _spread(top.select(*columns).unionByName(deep.select(*columns)), trees * (shelves + 1), "tree", "shelf")
    parts = shelved.groupBy("tree", "shelf").applyInArrow(_packed(edges, classes), PART)
    # Blocks bound the rows of a task; groups of trees give all cores tasks.
    blocks = int(np.ceil(kept.count() * max(1.0, classes / 8) / TASK_ROWS)) or 1
    groups = min(trees, max(int(np.ceil(size["nodes"] / MOST_NODES)), int(np.ceil(4 * spark.sparkContext.defaultParallelism / blocks))))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    none = F.lit(None).cast("binary")
    batches = rows.mapInArrow(_coded_rows(edges), "first bigint, ids binary, step binary").select(
        F.pmod(F.xxhash64("first"), F.lit(blocks)).cast("int").alias("block"), each(groups).alias("group"),
        F.lit(-1).alias("tree"), F.lit(-1).alias("shelf"), "ids", "step", none.alias("leaf"), none.alias("shares"),
    )
    grouped = parts.select(each(blocks).alias("block"), F.pmod(F.col("tree"), F.lit(groups)).alias("group"), "*")
    met = batches.unionByName(grouped).select((F.col("block") * groups + F.col("group")).alias("task"), "*").drop("block", "group")
    met = met.repartitionById(blocks * groups, F.col("task")).groupBy("task")
    votes = met.applyInArrow(_votes(classes, groups), "block int, slice int, group int, ids binary, votes binary")
    best = votes.groupBy("block", "slice").applyInArrow(_elected(classes), "row bigint, class double")
    return kept.join(best.select(F.col("row").alias("_row"), F.col("class").alias(output)), "_row", "left").drop("_row")
