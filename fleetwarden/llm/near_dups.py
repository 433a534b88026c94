"""Near-duplicates by BagMinHash signatures, bands, and verified multiset overlap of word shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwarden.llm.components import components
from fleetwarden.llm.frames import arrow_batches, body, digest, repeated, row_key, row_struct, unpacked_row
from fleetwarden.session import ship, staged

WORDS = 5
SIMILARITY = 0.8
#: 32 bands of 5: a pair at similarity 0.8 misses all of them with a chance of 3 in a million, one at 0.3 meets in
#: one band in 13 cases.
BANDS, ROWS = 32, 5
SEED = 0x5EED
#: Words handled at once; bounds a task's memory whatever the batch holds.
SLICE = 200_000
#: Arrow batches of word digests; the default of 64 MB, held twice on its way, is much beside a small executor's heap.
BATCH = "8m"
#: Shingles of one block where a bucket is compared in blocks, and columns of one matrix product.
BLOCK, COLUMNS = 64_000, 4096

_TOKEN = r"[\p{L}\p{M}\p{N}]+"
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _nth(k: int) -> np.uint64:
    return np.uint64(k * int(_GOLD) % 2**64)


def _mix(x: np.ndarray) -> np.ndarray:
    """Fixed constants: the finaliser of the public splitmix64 generator."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _unit(x: np.ndarray) -> np.ndarray:
    """Hashes as numbers in (0, 1)."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def word_digests(text: Column) -> Column:
    """Digests of the words: runs of letters, marks and digits, in lower case."""
    return F.transform(F.regexp_extract_all(F.lower(text), F.lit(_TOKEN), F.lit(0)), lambda w: F.xxhash64(w))


def shingles(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(document number, digest) of all runs of `width` words; a shorter document is one run of what it has."""
    n = ends - starts
    runs = np.where(n > 0, np.maximum(n - width + 1, 1), 0)
    doc = np.repeat(np.arange(len(n)), runs)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(runs) - runs, runs) + starts[doc]
    value = np.zeros(len(doc), np.uint64)
    for k in range(width):
        there = at + k < ends[doc]
        word = words[np.minimum(at + k, max(len(words) - 1, 0))] if len(words) else value
        value = _mix(value * np.uint64(3) + np.where(there, word, np.uint64(0)) + _nth(k + 1))
    return doc, value


def counted(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted by document and digest: (document, digest, which occurrence it is from 0, how many there are)."""
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    first = np.flatnonzero(new)
    many = np.diff(np.append(first, len(doc)))
    return doc, value, np.arange(len(doc)) - np.repeat(first, many), np.repeat(many, many)


def bag_min_hash(
    doc: np.ndarray, value: np.ndarray, weight: np.ndarray, docs: int, size: int, seed: int = SEED
) -> np.ndarray:
    """Signatures (docs x size) of weighted sets: rows (doc, element, whole weight), each element once a document.

    The weight axis is cut at 1, 2, 4, 8 and so on. Every element has one Poisson process for each cell, of a rate
    that is the cell's length; its points carry a time, a height inside the cell and a component, all drawn from
    hashes of element, cell and point number, so that all documents see the same points. An element of weight w
    uses the points below w. Component i keeps the earliest such point, and two documents agree there with their
    weighted Jaccard similarity as chance, without bias. Each process runs in the order of time and stops at the
    latest minimum of its document, so most elements of a long document give one or two points.

    The cells are the levels of the hierarchy, but none is split from a parent's process: parts of a Poisson process in
    disjoint cells are independent, so each cell drawn by itself has the law of the split one. Points of the last cell
    that lie above w are thinned out; on average these are less than half of all points drawn.
    """
    best = np.full(docs * size, np.inf)
    which = np.zeros(docs * size, np.uint64)
    cells = np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64) + 1
    cell = np.arange(cells.sum()) - np.repeat(np.cumsum(cells) - cells, cells)
    value, doc, weight = (np.repeat(x, cells) for x in (value, doc, weight))
    low = np.where(cell == 0, 0.0, 2.0 ** (cell - 1))
    length = np.where(cell == 0, 1.0, low)
    state = _mix(value ^ _mix(cell.astype(np.uint64) * _GOLD + np.uint64(seed)))
    time, k = np.zeros(len(doc)), 0
    while len(doc):
        k += 1
        point = _mix(state + _nth(k))
        time = time - np.log(_unit(point)) / length
        draw = _mix(point + _GOLD)
        slot = doc * size + (draw % np.uint64(size)).astype(np.int64)
        inside = low + length * _unit(_mix(draw + _GOLD)) < weight
        slots, times, points = slot[inside], time[inside], point[inside]
        np.minimum.at(best, slots, times)
        won = times == best[slots]
        which[slots[won]] = points[won]
        busy, at = np.unique(doc, return_inverse=True)
        latest = best.reshape(docs, size)[busy].max(axis=1)
        on = time < latest[at]
        doc, state, time, low, length, weight = (x[on] for x in (doc, state, time, low, length, weight))
    return which.reshape(docs, size)


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    """One digest for each band of `rows` components."""
    bands = signatures.shape[1] // rows
    key = np.tile(_mix(np.arange(bands, dtype=np.uint64) + _GOLD), (len(signatures), 1))
    for r in range(rows):
        key = _mix(key * np.uint64(3) + signatures[:, r::rows][:, :bands])
    return key


def _ranges(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    words = batch.column("words")
    ends = np.cumsum(pc.fill_null(pc.list_value_length(words), 0).to_numpy().astype(np.int64))
    return words.flatten().to_numpy().view(np.uint64), ends


def _slices(ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about SLICE words."""
    at = 0
    while at < len(ends):
        first = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, first + SLICE, side="right")))
        yield at, to
        at = to


def _lists(flat: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def _signed(width: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, ends = _ranges(batch)
            starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
            for a, b in _slices(ends):
                doc, value = shingles(words, starts[a:b], ends[a:b], width)
                doc, value, nth, many = counted(doc, value)
                once = nth == 0
                signature = bag_min_hash(doc[once], value[once], many[once], b - a, bands * rows)
                held = (ends[a:b] > starts[a:b]).astype(np.int64)
                keys = band_keys(signature, rows)[held > 0]
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        part.column("a"),
                        part.column("b"),
                        pa.array(np.bincount(doc, minlength=b - a), pa.int64()),
                        _lists(np.ascontiguousarray(keys).reshape(-1), held * bands),
                    ],
                    names=["id", "a", "b", "n", "bands"],
                )

    return run


def _coded(width: int):
    """The multiset as a set: the i-th occurrence of a shingle has a digest of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, ends = _ranges(batch)
            starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
            for a, b in _slices(ends):
                doc, value, nth, _ = counted(*shingles(words, starts[a:b], ends[a:b], width))
                code = _mix(value + nth.astype(np.uint64) * _GOLD)
                yield pa.RecordBatch.from_arrays(
                    [batch.slice(a, b - a).column("node"), _lists(code, np.bincount(doc, minlength=b - a))],
                    names=["node", "set"],
                )

    return run


def _sets(texts: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """(node, set) of some nodes, from texts (node, text): their multisets of shingles, coded as sets."""
    needed = staged(nodes.select("node").distinct())
    coded = texts.join(needed, "node", "left_semi").select("node", word_digests(body("text")).alias("words"))
    return staged(coded.mapInArrow(_coded(width), "node long, set array<long>"))


def _verified(pairs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """pairs (x, y) with s, their multiset Jaccard similarity; texts (node, text) holds every node."""
    sets = _sets(texts, pairs.select(F.explode(F.array("x", "y")).alias("node")), width)
    both = pairs.join(sets.toDF("x", "sx"), "x").join(sets.toDF("y", "sy"), "y")
    shared = F.size(F.array_intersect("sx", "sy"))
    return (
        both.select("x", "y", (shared / (F.size("sx") + F.size("sy") - shared)).alias("s"))
        .groupBy("x", "y")
        .agg(F.max("s").alias("s"))
    )


def shared_counts(values: np.ndarray, owner: np.ndarray, left: np.ndarray, right: np.ndarray, rows: int) -> np.ndarray:
    """Sizes of the intersections of sets `left` with sets `right`; set `owner[i]` holds `values[i]`."""
    _, at, many = np.unique(values, return_inverse=True, return_counts=True)
    place = np.cumsum(many > 1) - 1
    held = many[at] > 1
    column, owner = place[at[held]], owner[held]
    out = np.zeros((len(left), len(right)))
    for start in range(0, int(place[-1]) + 1 if len(place) else 0, COLUMNS):
        inside = (column >= start) & (column < start + COLUMNS)
        matrix = np.zeros((rows, COLUMNS), np.float32)
        matrix[owner[inside], column[inside] - start] = 1
        out += matrix[left] @ matrix[right].T
    return out


def _joining_links(similarity: float):
    """Of one pair of blocks of a bucket: links that join parts which were apart, as a forest."""

    def run(table: pa.Table) -> pa.Table:
        node, part, block = (table.column(c).to_numpy() for c in ("node", "part", "block"))
        sets = table.column("set").combine_chunks()
        size = pc.list_value_length(sets).to_numpy().astype(np.int64)
        owner = np.repeat(np.arange(len(node)), size)
        left, right = np.flatnonzero(block == block.min()), np.flatnonzero(block == block.max())
        shared = shared_counts(sets.flatten().to_numpy(), owner, left, right, len(node))
        near = shared / (size[left][:, None] + size[right] - shared) >= similarity
        near &= part[left][:, None] != part[right]
        head: dict[int, int] = {}

        def top(x: int) -> int:
            while x in head:
                x = head[x]
            return x

        found = []
        for i, j in zip(*(x.tolist() for x in np.nonzero(near))):
            a, b = left[i], right[j]
            x, y = top(int(part[a])), top(int(part[b]))
            if x != y:
                head[x] = y
                found.append((int(node[a]), int(node[b])))
        return pa.table({"x": pa.array([f[0] for f in found], pa.int64()), "y": pa.array([f[1] for f in found], pa.int64())})

    return run


def _ordered(x: Column, y: Column) -> list[Column]:
    return [F.least(x, y).alias("x"), F.greatest(x, y).alias("y")]


def near_duplicate_links(texts: DataFrame, buckets: DataFrame, width: int, similarity: float) -> DataFrame:
    """Links (x, y) whose components are those of all pairs that meet in a bucket and reach the similarity.

    1. Every node is compared with the smallest and the largest node of each of its buckets. This joins nearly all.
    2. Buckets that still hold several components are compared in blocks of about BLOCK shingles: each pair of
       blocks is one task, which counts shared shingles by a matrix product and returns no pairs, only the links that
       join components that were apart. A bucket of n nodes makes n / block size copies of each of its rows.
    """
    ends = buckets.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi")
    members = staged(buckets.join(staged(ends), "key"))
    stars = (
        members.select(F.explode(F.array(F.struct("node", F.col("lo").alias("o")), F.struct("node", F.col("hi").alias("o")))).alias("p"))
        .select("p.*")
        .where("node <> o")
        .select(*_ordered(F.col("node"), F.col("o")))
        .distinct()
    )
    links = staged(_verified(staged(stars), texts, width).where(F.col("s") >= similarity).select("x", "y"))
    labelled = staged(
        members.join(components(links), "node", "left").select("key", "node", "n", F.coalesce("label", "node").alias("part"))
    )
    apart = (
        labelled.groupBy("key")
        .agg(F.min("part").alias("a"), F.max("part").alias("b"), F.sum("n").alias("shingles"))
        .where("a <> b")
        .select("key", F.greatest(F.ceil(F.col("shingles") / BLOCK), F.lit(1)).cast("long").alias("blocks"))
    )
    open_ = staged(labelled.join(staged(apart), "key").select("key", "node", "part", "blocks"))
    sets = _sets(texts, open_, width)
    dealt = (
        open_.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "part")
        .join(sets, "node")
    )
    more = staged(dealt.groupBy("key", "i", "j").applyInArrow(_joining_links(similarity), "x long, y long").distinct())
    return links.unionByName(more)


def texts_of_nodes(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, text) from rows (node, a, b, text) and nodes (node, copies): of rows that agree in node and text, one.

    Copies under one id, or without any, would else be compared copies x copies times. Only nodes with copies are grouped,
    and before the shuffle every task keeps one row of each.
    """
    many = staged(nodes.where("copies > 1").select("node").distinct())
    single = rows.join(many, "node", "left_anti").select("node", "text")
    grouped = rows.join(many, "node", "left_semi").groupBy("node", "a", "b").agg(F.first("text").alias("text"))
    return single.unionByName(staged(grouped.select("node", "text")))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WORDS,
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """Rows (id, digest, digest_b, class_id, class_digest, stays), one for each row of docs; class_id is the smallest id of
    its group, class_digest the digest of the row that stays, which also tells groups without any id apart.

    Documents are in one group if a chain of pairs joins them whose multisets of five-word shingles have a Jaccard
    similarity of 0.8 or more; words are runs of letters, marks and digits in lower case, and a text of fewer words
    is one shingle. Equal texts are one node from the start. Null, empty and wordless texts are alone (class_id =
    id). Rows that share an id are one document. Rows with a null id are grouped like others, and a group without
    any id has a null class_id. stays marks the row with the least (id, digest, digest_b) of each group, ids before
    null, and rows equal to it. Extra columns are not read; an empty table gives an empty table.
    """
    ship(docs.sparkSession)
    rows_ = docs.select(
        F.col(id_col).alias("id"), digest(body(text_col), 1).alias("a"), digest(body(text_col), 2).alias("b"), F.col(text_col).alias("text")
    )
    with arrow_batches(docs.sparkSession, BATCH):
        signed = rows_.select("id", "a", "b", word_digests(body("text")).alias("words")).mapInArrow(
            _signed(width, bands, rows), "id long, a long, b long, n long, bands array<long>"
        )
        nodes = staged(
            signed.where("n > 0")
            .groupBy("a", "b")
            .agg(
                F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("bands").alias("bands")
            )
            .select("a", "b", "id", "copies", F.coalesce("id", "a").alias("node"), "n", "bands")
        )
        buckets = nodes.select("node", "n", F.explode("bands").alias("key"))
        named = texts_of_nodes(rows_.select(F.coalesce("id", "a").alias("node"), "a", "b", "text"), nodes)
        links = near_duplicate_links(named, buckets, width, similarity)
    parts = components(links)
    grouped = nodes.join(parts, "node", "left").select("a", "b", "id", "copies", "label")
    heads = (
        grouped.where("label is not null")
        .groupBy("label")
        .agg(F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "a", "b")).alias("head"))
        .select("label", F.col("head.id").alias("head"), F.col("head.a").alias("head_a"), F.col("head.b").alias("head_b"))
    )
    chosen = F.col("label").isNull() | ((F.col("a") == F.col("head_a")) & (F.col("b") == F.col("head_b")))
    classes = staged(
        grouped.where("label is not null or copies > 1")
        .join(staged(heads), "label", "left")
        .select(
            "a",
            "b",
            F.coalesce("head", "id").alias("class_id"),
            F.coalesce("head_a", "a").alias("class_digest"),
            F.lit(True).alias("grouped"),
            chosen.alias("chosen"),
        )
    )
    keys = rows_.select("id", "a", "b")
    return keys.join(classes, ["a", "b"], "left").select(
        "id",
        F.col("a").alias("digest"),
        F.col("b").alias("digest_b"),
        F.when(F.col("grouped"), F.col("class_id")).otherwise(F.col("id")).alias("class_id"),
        F.coalesce("class_digest", "a").alias("class_digest"),
        (F.col("grouped").isNull() | (F.col("chosen") & F.col("id").eqNullSafe(F.col("class_id")))).alias("stays"),
    )


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs in their own columns, one row of each group: the one with the group's smallest id, if any row has one.

    Of rows that agree in id and text one stays. Rows that share an id and no near copy joins stay with each text.
    """
    classes = near_duplicates(docs, id_col, text_col, **options)
    stays = F.col("stays").cast("int")
    decided = staged(
        classes.select(*row_key("id", "digest", "digest_b"), stays.alias("stays"))
        .groupBy("k1", "k2")
        .agg(F.count(F.lit(1)).alias("n"), F.max("stays").alias("copies"))
    )
    key = row_key(F.col(id_col), digest(body(text_col), 1), digest(body(text_col), 2))
    return unpacked_row(repeated(docs.select(row_struct(docs), *key), decided), docs.columns)
