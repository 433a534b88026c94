"""Source divergence audit: how the words of each source differ from those of the others and of its language.

Tasks fold whole documents into hash stripes, term -> (documents, occurrences in each source), which they give out when
they hold many. Equal terms' stripes are merged, and the merged stripes give the divergences themselves.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetwarden.llm.frames import body
from fleetwarden.session import ship, staged

MIN_DOCUMENTS = 10
TOP = 10
#: Cells (term and source) that a task holds before it gives its stripes out; they are added up when so many times as
#: many have come.
CELLS, FRESH = 1_000_000, 3
#: Terms of one task of the divergences; more where a language has more sources.
TERMS = 4096
#: Pairs of sources whose sums one task holds.
PAIRS = 4_000_000
#: Numbers of a block of terms x sources.
BLOCK = 2_000_000
ONE = 1_000_000_000

# Fixed rule: a term is a run of characters outside the 7-bit ones that are no letters, with A-Z in lower case. In
# UTF-8 that is a run of a-z and bytes from 128 on.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

STRIPE = "lang string, term string, documents long, sources array<string>, counts array<long>"


def terms(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def _cells(row: np.ndarray, source: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Occurrences added up by (row, source), in that order."""
    width = int(source.max(initial=0)) + 1
    key = row * width + source
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return key[first] // width, key[first] % width, np.add.reduceat(count[order], first) if len(key) else count


def _batch(lang: pa.Array, term: pa.Array, documents: np.ndarray, names: pa.Array, cells: tuple) -> pa.RecordBatch:
    """Stripes as a batch, from cells with a row number."""
    row, source, count = cells
    offsets = pa.array(np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(documents))))).astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, x) for x in (names.take(pa.array(source)), pa.array(count, pa.int64()))]
    return pa.RecordBatch.from_arrays(
        [lang, term, pa.array(documents, pa.int64()), *lists], names=["lang", "term", "documents", "sources", "counts"]
    )


class Rows(dict):
    """The row of each term of a language; a new term gets the next row of all."""

    def __init__(self, lang: str, all_rows: list):
        super().__init__()
        self.lang, self.all_rows = lang, all_rows

    def __missing__(self, term: bytes) -> int:
        row = self[term] = len(self.all_rows)
        self.all_rows.append((self.lang, term))
        return row


class Stripes:
    """A task's stripes: a hash from term to row, and cells (row, source, occurrences), added up when many came."""

    def __init__(self):
        self.rows: list[tuple[str, bytes]] = []
        self.of_lang: dict[str, Rows] = {}
        self.sources: dict[str, int] = {}
        self.documents = np.zeros(0, np.int64)
        self.cells = tuple(np.zeros(0, np.int64) for _ in range(3))
        self.fresh: list[tuple[np.ndarray, int, np.ndarray]] = []
        self.size = 0

    def add(self, lang: str, source: str, found: dict[bytes, int]) -> None:
        row_of = self.of_lang.get(lang) or self.of_lang.setdefault(lang, Rows(lang, self.rows))
        code = self.sources.setdefault(source, len(self.sources))
        n = len(found) + 1
        rows = np.fromiter(map(row_of.__getitem__, [b"", *found]), np.int64, n)
        self.fresh.append((rows, code, np.fromiter([0, *found.values()], np.int64, n)))
        self.size += n

    def add_up(self) -> int:
        """How many cells there are."""
        row = np.concatenate([x[0] for x in self.fresh]) if self.fresh else np.zeros(0, np.int64)
        source = np.repeat([x[1] for x in self.fresh], [len(x[0]) for x in self.fresh]).astype(np.int64)
        count = np.concatenate([x[2] for x in self.fresh]) if self.fresh else row
        seen = np.bincount(row, minlength=len(self.rows))
        seen[: len(self.documents)] += self.documents
        self.documents, self.fresh = seen, []
        self.cells = _cells(*(np.concatenate(x) for x in zip(self.cells, (row, source, count))))
        self.size = len(self.cells[0])
        return self.size

    def given_out(self) -> pa.RecordBatch:
        self.add_up()
        langs, words = zip(*self.rows)
        term = pa.array(words, pa.binary()).cast(pa.string())
        return _batch(pa.array(langs, pa.string()), term, self.documents, pa.array(list(self.sources), pa.string()), self.cells)


def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stripes of a partition's documents. The stripe of the empty term has all sources of the language, with 0."""
    stripes = Stripes()
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary())
        for text, lang, source in zip(texts, batch.column("lang").to_pylist(), batch.column("source").to_pylist()):
            stripes.add(lang, source, Counter(terms(text.as_py())))
            # Only between documents: a document counts once for each of its terms.
            if stripes.size >= FRESH * CELLS and stripes.add_up() >= CELLS:
                yield stripes.given_out()
                stripes = Stripes()
    if stripes.rows:
        yield stripes.given_out()


def merge(batches: Iterator[pa.RecordBatch], min_documents: int = 0) -> Iterator[pa.RecordBatch]:
    """One stripe a key from stripes in the order of keys, without those of fewer documents; the empty term's all stay."""
    open_: pa.RecordBatch | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch] if open_ is None else [open_, batch]).combine_chunks().to_batches()[0]
        lang, term = table.column("lang"), table.column("term")
        both = [pc.equal(x.slice(1), x.slice(0, len(x) - 1)) for x in (lang, term)]
        new = np.append(True, ~pc.and_(*both).to_numpy(zero_copy_only=False))
        first = np.flatnonzero(new)
        run = np.cumsum(new) - 1
        documents = np.add.reduceat(table.column("documents").to_numpy(), first)
        stays = (documents >= min_documents) | (pc.equal(term, "").to_numpy(zero_copy_only=False)[first])
        stays[-1] = True  # it may go on in the next batch
        chosen = table.filter(pa.array(stays[run]))
        sources = chosen.column("sources")
        coded = pc.dictionary_encode(sources.flatten())
        row = np.repeat((np.cumsum(stays) - 1)[run[stays[run]]], pc.list_value_length(sources).to_numpy())
        at = pa.array(first[stays])
        done = _batch(
            lang.take(at),
            term.take(at),
            documents[stays],
            coded.dictionary,
            _cells(row, coded.indices.to_numpy().astype(np.int64), chosen.column("counts").flatten().to_numpy()),
        )
        open_ = done.slice(done.num_rows - 1)
        if done.num_rows > 1:
            yield done.slice(0, done.num_rows - 1)
    if open_ is not None and (open_.column("documents")[0].as_py() >= min_documents or open_.column("term")[0].as_py() == ""):
        yield open_


def shares(counts: np.ndarray, total, terms_kept: int) -> np.ndarray:
    """1 + floor(10^9 * (count + 2) / (total + 2 * terms)), exact: in 64 bits where these hold it, else in whole numbers
    of any size. `total` is a number or one a column."""
    under = np.asarray(np.asarray(total, object) + 2 * terms_kept)
    if counts.size and int(counts.max()) + 2 > (2**63 - 1) // ONE:
        return (1 + ONE * (counts.astype(object) + 2) // under).astype(np.int64)
    return 1 + ONE * (counts + 2) // under.astype(np.int64)


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)); both are at most 10^9 + 1, so 64 bits hold all of it."""
    return (p - q) ** 2 // (p + q)


PARTIAL = "lang string, source string, part string, item string, value long"


def _parts(key: tuple, stripes: pa.Table, profile: pa.Table) -> pa.Table:
    """Sums of pairs, and the best terms of each source, over the stripes of one chunk.

    The task has the sources first..last of its language as left sides, and all as right sides.
    """
    row = profile.slice(0, 1).to_pylist()[0]
    names, totals, kept = row["sources"], row["totals"], row["kept"]
    first, last = row["first"], row["last"]
    place = {s: i for i, s in enumerate(names)}
    words = stripes.column("term").to_pylist()
    lists = list(zip(stripes.column("sources").to_pylist(), stripes.column("counts").to_pylist()))
    sums = np.zeros((last - first, len(names)), np.int64)
    best: dict[int, list] = {}
    step = max(1, BLOCK // max(1, len(names)))
    for at in range(0, len(words), step):
        part = lists[at : at + step]
        counts = np.zeros((len(part), len(names)), np.int64)
        for i, (sources, n) in enumerate(part):
            counts[i, [place[s] for s in sources]] = n
        p = shares(counts, totals, kept)
        whole = counts.astype(object).sum(axis=1) if counts.max(initial=0) > 2**50 else counts.sum(axis=1)
        q = shares(np.asarray(whole)[:, None], sum(totals), kept)[:, 0]
        for source in range(first, last):
            sums[source - first] += divergence(p[:, source, None], p).sum(axis=0)
            over = np.flatnonzero((counts[:, source] > 0) & (p[:, source] > q))
            value = divergence(p[over, source], q[over])
            found = best.get(source, []) + [(-v, words[at + i].encode()) for v, i in zip(value.tolist(), over.tolist())]
            best[source] = sorted(found)[:TOP]
    rows = [("pair", a, names[b], int(sums[a - first, b])) for a in range(first, last) for b in range(len(names)) if a != b]
    rows += [("term", a, term.decode(), -v) for a, found in best.items() for v, term in found]
    return pa.table(
        {
            "lang": pa.array([row["lang"]] * len(rows), pa.string()),
            "source": pa.array([names[a] for _, a, _, _ in rows], pa.string()),
            "part": pa.array([r[0] for r in rows], pa.string()),
            "item": pa.array([r[2] for r in rows], pa.string()),
            "value": pa.array([r[3] for r in rows], pa.int64()),
        }
    )


def stripes(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_documents: int = 0
) -> DataFrame:
    """One row (lang, term, documents, sources, counts) for each term that so many documents of a language hold, and one
    with the empty term that lists the language's sources. Nulls read as ''. Other columns are not read."""
    ship(docs.sparkSession)
    rows = docs.select(
        body(docs[f"`{text_col}`"]).alias("text"), body(docs[f"`{lang_col}`"]).alias("lang"), body(docs[f"`{source_col}`"]).alias("source")
    )
    keys = ["lang", "term"]
    folded = rows.mapInArrow(fold, STRIPE).repartition(*keys).sortWithinPartitions(*keys)
    return folded.mapInArrow(lambda batches: merge(batches, min_documents), STRIPE)


def source_divergence(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_documents: int = MIN_DOCUMENTS,
) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): the divergence of each source from every other of its language
    ('pair', all of them), and its most typical terms against the language ('term', at most 10).

    Null text, language or source is ''. Repeated rows are documents of their own. A source without terms has share
    2 / (total + 2 * terms) of each; a language without a kept term has pairs of value 0 and no terms. Ties go to the
    smaller item by UTF-8. An empty table gives no rows. Extra columns are not read.

    What is shuffled are stripes: a term has one row for each time a task gave its stripes out, however often it
    occurs, and a stripe's length is the number of the language's sources. Chunks of terms then meet their language's
    sources; a chunk gives a sum for each pair and ten terms a source, so its output is no larger than its input.
    Languages of many sources are dealt out by left sides too.
    """
    merged = staged(stripes(docs, text_col, lang_col, source_col, min_documents))
    kept = merged.where(F.col("term") != "")
    # One row a language: its sources in order, their totals and the number of terms. Partial sums come first.
    named = merged.where(F.col("term") == "").select("lang", F.explode("sources").alias("source"))
    totals = (
        kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("c"))
        .groupBy("lang", F.col("c.sources").alias("source"))
        .agg(F.sum("c.counts").alias("total"))
    )
    group = (
        named.join(totals, ["lang", "source"], "left")
        .groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct("source", F.coalesce("total", F.lit(0)).alias("total")))).alias("g"))
    )
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
    n = F.size("g")
    profile = staged(
        group.join(sizes, "lang", "left").select(
            "lang",
            F.col("g.source").alias("sources"),
            F.col("g.total").alias("totals"),
            F.coalesce("kept", F.lit(0)).alias("kept"),
            F.ceil(F.coalesce("kept", F.lit(0)) / F.greatest(F.lit(TERMS), n)).cast("long").alias("chunks"),
            F.ceil(n.cast("double") * n / PAIRS).cast("int").alias("sides"),
        )
    )
    # Languages of one chunk and one side need no row here, so this table has at most one row for every TERMS kept terms
    # or PAIRS result rows.
    many = profile.where("chunks > 1 OR sides > 1").select("lang", "chunks", "sides")
    dealt = kept.join(F.broadcast(many), "lang", "left").select(
        "lang",
        "term",
        "sources",
        "counts",
        F.pmod(F.xxhash64("term"), F.coalesce("chunks", F.lit(1))).alias("chunk"),
        F.explode(F.sequence(F.lit(0), F.coalesce("sides", F.lit(1)) - 1)).alias("side"),
    )
    wide = (
        profile.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("chunks"), F.lit(1)) - 1)).alias("chunk"))
        .select("*", F.explode(F.sequence(F.lit(0), F.col("sides") - 1)).alias("side"))
        .withColumn("first", F.floor(F.col("side").cast("long") * F.size("sources") / F.col("sides")).cast("int"))
        .withColumn("last", F.floor((F.col("side").cast("long") + 1) * F.size("sources") / F.col("sides")).cast("int"))
        .select(F.col("lang"), F.col("chunk"), F.col("side"), "sources", "totals", "kept", "first", "last")
    )
    parts = dealt.groupBy("lang", "chunk", "side").cogroup(wide.groupBy("lang", "chunk", "side")).applyInArrow(_parts, PARTIAL)
    # A term is in one chunk, a pair has a sum from each.
    summed = parts.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    ranked = summed.withColumn("rank", F.row_number().over(order)).where((F.col("part") == "pair") | (F.col("rank") <= TOP))
    return ranked.select("lang", "source", "part", "item", "value", "rank")
