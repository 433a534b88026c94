"""Token counts of byte-level BPE: count each distinct pre-token once, then sum by documents' frequencies."""

from __future__ import annotations

import functools
import os
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwarden.session import ship, staged

#: Below this code point the plain pattern and the library's agree (a test goes through every one of them); a text
#: with any other letter is cut by the library itself.
PLAIN_BELOW = 0x530
#: Long texts are cut where white space follows something else, which always is a boundary between pre-tokens.
PIECE_CHARS = 1_000_000

BLOCKS = "row long, block long, n_bytes long, ids binary, counts binary, words array<string>"


def public_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.cache
def _plain() -> re.Pattern:
    def group(first: str) -> str:
        points = [c for c in range(PLAIN_BELOW) if unicodedata.category(chr(c))[0] == first]
        runs, at = [], 0
        while at < len(points):
            end = at
            while end + 1 < len(points) and points[end + 1] == points[end] + 1:
                end += 1
            runs.append(f"\\u{points[at]:04x}-\\u{points[end]:04x}")
            at = end + 1
        return "".join(runs)

    # Fixed value: the public pattern of byte-level BPE, with its two classes spelt out.
    letters, numbers = group("L"), group("N")
    # The four separators that Python counts as white space and Unicode does not.
    blank = "[\\t-\\r \\x85\\xa0]"
    other = f"[^\\t-\\r \\x85\\xa0{letters}{numbers}]"
    return re.compile(
        f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?{other}+|{blank}+(?={blank}|\\Z)|{blank}+"
    )


@functools.cache
def _far() -> re.Pattern:
    return re.compile(f"[^\\x00-\\u{PLAIN_BELOW - 1:04x}]")


@functools.cache
def _special(path: str) -> tuple[re.Pattern | None, frozenset]:
    """Special strings, which the library takes out of the text first, each as one token."""
    names = [t.content for t in _tokenizer(path).get_added_tokens_decoder().values()]
    names.sort(key=len, reverse=True)
    return (re.compile("|".join(map(re.escape, names))) if names else None), frozenset(names)


def pieces_of_text(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """The text in runs of about `size` characters that can be cut into pre-tokens one by one."""
    edge, at = re.compile(r"(?<=\S)(?=\s)"), 0
    while len(text) - at > size:
        cut = edge.search(text, at + size)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def pretoken_counts(text: str, path: str) -> Counter:
    """How often each pre-token occurs; special strings count as pre-tokens of their own."""
    found: Counter = Counter()
    special, _ = _special(path)
    parts = [text]
    if special and special.search(text):
        found.update(special.findall(text))
        parts = special.split(text)
    for part in parts:
        for piece in pieces_of_text(part):
            if _far().search(piece):
                cut = _tokenizer(path).pre_tokenizer.pre_tokenize_str
                found.update(piece[a:b] for a, b in _spans(cut(piece)))
            else:
                found.update(_plain().findall(piece))
    return found


def _spans(cut: list) -> list[tuple[int, int]]:
    return [span for _, span in cut]


def packed(values: np.ndarray) -> bytes:
    """Unsigned numbers in groups of 7 bits, low ones first, the high bit set where more follow."""
    out = np.zeros((len(values), 5), np.uint8)
    rest = values.astype(np.uint64)
    used = np.ones(len(values), np.int64)
    for k in range(5):
        out[:, k] = rest & 127
        rest >>= 7
        more = rest > 0
        out[more, k] |= 128
        used[more] += 1
    return out[np.arange(5) < used[:, None]].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return np.zeros(0, np.int64)
    ends = np.flatnonzero(raw < 128)
    starts = np.concatenate(([0], ends[:-1] + 1))
    place = np.arange(len(raw)) - np.repeat(starts, ends - starts + 1)
    return np.add.reduceat((raw & 127).astype(np.int64) << (7 * place), starts)


def _blocks(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for k, batch in enumerate(batches):
            number: dict[str, int] = {}
            ids, often = [], []
            for text in batch.column("text"):
                found = pretoken_counts(text.as_py() or "", path)
                ids.append(np.fromiter((number.setdefault(w, len(number)) for w in found), np.int32, len(found)))
                often.append(np.fromiter(found.values(), np.int32, len(found)))
            # Words that most documents hold get the small numbers, so that steps between numbers stay short.
            spread = np.bincount(np.concatenate(ids), minlength=len(number)) if number else np.zeros(0, np.int64)
            order = np.argsort(-spread, kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            for i, own in enumerate(ids):
                own = rank[own]
                at = np.argsort(own)
                ids[i], often[i] = packed(np.diff(own[at], prepend=0)), packed(often[i][at])
            words = pa.array(list(number), pa.string()).take(pa.array(order))
            n = len(ids)
            offsets = pa.array([0] * (n + 1) + [len(words)], pa.int32(), mask=np.arange(n + 2) < n)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([batch.column("row").cast(pa.int64()), pa.nulls(1, pa.int64())]),
                    pa.array(np.full(n + 1, (task << 32) + k), pa.int64()),
                    pa.concat_arrays([batch.column("n_bytes").cast(pa.int64()), pa.nulls(1, pa.int64())]),
                    pa.array([*ids, None], pa.binary()),
                    pa.array([*often, None], pa.binary()),
                    pa.ListArray.from_arrays(offsets, words),
                ],
                names=["row", "block", "n_bytes", "ids", "counts", "words"],
            )

    return run


def _pieces(path: str):
    """Counts for rows (block, pos, word) in the order of words: each run of a word is counted once.

    What goes back to a block is packed: places in steps, and a count for each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
        tokenizer, (_, special) = _tokenizer(path), _special(path)
        last, last_n = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            runs = pc.run_end_encode(batch.column("word"))
            words = runs.values.to_pylist()
            fresh = words[1:] if words[0] == last else words
            n = [1 if w in special else len(e.ids) for w, e in zip(fresh, tokenizer.encode_batch(fresh, add_special_tokens=False))]
            n = [last_n] * (len(words) - len(fresh)) + n
            last, last_n = words[-1], n[-1]
            n = np.repeat(n, np.diff(runs.run_ends.to_numpy(), prepend=0))
            block, pos = batch.column("block").to_numpy(), batch.column("pos").to_numpy().astype(np.int64)
            order = np.lexsort((pos, block))
            block, pos, n = block[order], pos[order], n[order]
            starts = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
            ends = np.append(starts[1:], len(block))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(block[starts], pa.int64()),
                    pa.array([packed(np.diff(pos[a:b], prepend=0)) for a, b in zip(starts, ends)], pa.binary()),
                    pa.array([packed(n[a:b]) for a, b in zip(starts, ends)], pa.binary()),
                ],
                names=["of", "at", "n"],
            )

    return run


def _sums(key: tuple, docs: pa.Table, words: pa.Table) -> pa.Table:
    """Inner products of one block: its documents' frequencies and its words' piece counts."""
    at = [np.cumsum(unpacked(x)) for x in words.column("at").to_pylist()]
    weight = np.zeros(max((int(x[-1]) + 1 for x in at), default=0), np.int64)
    for x, n in zip(at, words.column("n").to_pylist()):
        weight[x] = unpacked(n)
    total = [
        int(weight[np.cumsum(unpacked(i))] @ unpacked(c)) if i else 0
        for i, c in zip(docs.column("ids").to_pylist(), docs.column("counts").to_pylist())
    ]
    return pa.table(
        {"row": docs.column("row"), "n_bytes": docs.column("n_bytes"), "n_tokens": pa.array(total, pa.int64())}
    )


def count_tokens(docs: DataFrame, text_col: str, key_col: str, path: str | None = None) -> DataFrame:
    """Rows (key, n_bytes, n_tokens), one for each row of docs, as the tokenizers library counts.

    Each Arrow batch (64 MB of text at most) becomes a block: its distinct pre-tokens with numbers, and each
    document's frequencies as packed numbers. Equal pre-tokens of all blocks meet (one row a block, so the most
    frequent word has no more rows than there are blocks), each distinct one is counted once, and the counts return
    to their blocks, where they are joined to the documents' frequencies and summed. Token ids are dropped as soon as
    a pre-token is counted. What is shuffled are the blocks' word lists and packed numbers, not texts.

    A null text is empty: 0 bytes, 0 tokens. Ids may be null or repeat; every row counts. Special strings inside a
    text count one token each, the library's default. A text of any length is cut into runs that are safe to
    pre-tokenise alone; only a run without white space stays whole.
    """
    ship(docs.sparkSession)
    path = path or public_path()
    rows = docs.select(
        F.col(key_col).alias("row"), F.col(text_col).alias("text"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes")
    )
    blocks = staged(rows.mapInArrow(_blocks(path), BLOCKS))
    words = blocks.where(F.col("words").isNotNull()).select("block", F.posexplode("words").alias("pos", "word"))
    counted = (
        words.repartition("word").sortWithinPartitions("word").mapInArrow(_pieces(path), "of long, at binary, n binary")
    )
    own = blocks.where(F.col("words").isNull()).select("block", "row", "n_bytes", "ids", "counts")
    return (
        own.groupBy("block")
        .cogroup(counted.groupBy("of"))
        .applyInArrow(_sums, "row long, n_bytes long, n_tokens long")
        .withColumnRenamed("row", "key")
    )


def with_token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024, path: str | None = None) -> DataFrame:
    """Rows (id_col, n_bytes, n_tokens, over_limit); see count_tokens for nulls, repeats and long texts.

    Extra columns of docs are not read, so their names can't clash.
    """
    found = count_tokens(docs, text_col, id_col, path)
    return found.select(
        F.col("key").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
