"""Byte-level BPE: token ids with byte offsets, and their decoding.

Pre-tokens are found without a regular expression: every code point has a class, class and what follows give a symbol,
a symbol is a function between the states of a small automaton, and as composition is associative all states come from
one scan over whole batches of texts. The slices between boundaries go through a cache of merged pieces.
"""

from __future__ import annotations

import base64
import functools
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from fleetwarden.session import ship

#: Texts are scanned together until they have so many bytes; a longer text is scanned alone, still in one pass.
GROUP_BYTES = 1 << 20
#: Merged pieces that a worker remembers, and the longest piece it does so for.
REMEMBERED, REMEMBERED_BYTES = 200_000, 200
#: Pieces of more bytes are merged with a heap.
SHORT_PIECE = 64

OTHER, LETTER, NUMBER, WHITE, BLANK, QUOTE = range(6)
# Symbols: white space before white space or the end; the last white space of a run before something else, if it is
# not a blank, and if it is one (which belongs to what follows); a quote that can open an ending of one or two letters.
INNER, LAST, LEAD, IN_LETTERS, IN_NUMBERS, IN_OTHERS, ENDING1, ENDING2 = SYMBOLS = range(8)
# States: what the character before belongs to. FREE: whatever comes begins a pre-token.
FREE, SPACE, LEADING, LETTERS, NUMBERS, OTHERS, ONE_MORE, TWO_MORE = STATES = range(8)
#: Symbols of a text's first character.
FIRST = len(SYMBOLS)
# Letters that end a pre-token after a quote, alone and in pairs.
SINGLE, DOUBLE = "stmd", ("re", "ve", "ll")


def multi_path(name: str = "byte_bpe_multi_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def next_state(symbol: int, state: int) -> int:
    """The automaton."""
    if symbol >= FIRST:
        return next_state(symbol - FIRST, FREE)
    if state == TWO_MORE:
        return ONE_MORE
    if state == ONE_MORE or symbol == LAST:
        return FREE
    if symbol in (ENDING1, ENDING2) and state not in (OTHERS, LEADING):
        return ONE_MORE if symbol == ENDING1 else TWO_MORE
    return {INNER: SPACE, LEAD: LEADING, IN_LETTERS: LETTERS, IN_NUMBERS: NUMBERS}.get(symbol, OTHERS)


def begins(symbol: int, state: int) -> bool:
    """Whether a pre-token begins at a character, from its symbol and the state before."""
    if symbol >= FIRST:
        return True
    if state in (ONE_MORE, TWO_MORE):
        return False
    if symbol in (LAST, LEAD):
        return True
    goes_on = {INNER: (SPACE,), IN_LETTERS: (LETTERS, LEADING), IN_NUMBERS: (NUMBERS, LEADING)}
    return state not in goes_on.get(symbol, (OTHERS, LEADING))


@functools.cache
def _functions() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """(number of each symbol's function, composition of two numbers, state each leads to from FREE, begins, identity).

    All compositions of the symbols' functions are a small closed set, so a function is a number and composing is a
    lookup.
    """
    basic = [tuple(next_state(s, q) for q in STATES) for s in range(2 * FIRST)]
    known = list(dict.fromkeys([*basic, tuple(STATES)]))
    number = {f: i for i, f in enumerate(known)}
    at = 0
    while at < len(known):
        for g in basic:
            both = tuple(g[q] for q in known[at])
            if both not in number:
                number[both] = len(known)
                known.append(both)
        at += 1
    kind = np.uint8 if len(known) < 256 else np.uint16
    compose = np.array([[number[tuple(g[q] for q in f)] for g in known] for f in known], kind)
    opens = np.array([[begins(s, q) for q in STATES] for s in range(2 * FIRST)])
    return np.array([number[f] for f in basic], kind), compose, np.array([f[FREE] for f in known], np.uint8), opens, number[tuple(STATES)]


def scan(functions: np.ndarray, compose: np.ndarray, none: int) -> np.ndarray:
    """Compositions of all prefixes: columns of a grid side by side, then the columns' totals the same way."""
    n = len(functions)
    width = max(2, int(n**0.5)) if n > 64 else n
    columns = -(-n // width) if n else 0
    grid = np.full(columns * width, none, functions.dtype)
    grid[:n] = functions
    grid = np.ascontiguousarray(grid.reshape(columns, width).T)
    for j in range(1, width):
        grid[j] = compose[grid[j - 1], grid[j]]
    if columns > 1:
        before = scan(grid[-1], compose, none)[:-1]
        for j in range(width):
            grid[j, 1:] = compose[before, grid[j, 1:]]
    return grid.T.ravel()[:n]


@functools.cache
def code_point_classes() -> np.ndarray:
    """The class of every code point, as the engine of the tiktoken library sees letters, numbers and white space."""
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    of = np.zeros(0x110000, np.uint8)
    for class_, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (WHITE, r"\s+")):
        # What is not matched is left out of the encoding.
        engine = tiktoken.Encoding("classes", pat_str=pattern, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
        members = engine.decode_bytes(engine.encode_ordinary(every)).decode().encode("utf-32-le")
        of[np.frombuffer(members, np.uint32)] = class_
    of[ord(" ")], of[ord("'")] = BLANK, QUOTE
    return of


def symbols(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The symbol of every character of texts that lie one after another and begin at `starts` (ascending)."""
    class_ = code_point_classes()[points]
    white = (class_ == WHITE) | (class_ == BLANK)
    last = np.zeros(len(points), bool)
    last[starts[1:] - 1] = True
    last[-1] = True
    before_ink = np.append(~white[1:], False) & ~last
    out = np.choose(class_, [IN_OTHERS, IN_LETTERS, IN_NUMBERS, LAST, LEAD, IN_OTHERS]).astype(np.uint8)
    out[white & ~before_ink] = INNER
    quotes = np.flatnonzero(class_ == QUOTE)
    if len(quotes):
        ends = np.append(starts[1:], len(points))[np.searchsorted(starts, quotes, "right") - 1]
        padded = np.append(points, [0, 0])
        a, b = padded[quotes + 1], padded[quotes + 2]
        pair = np.zeros(len(quotes), bool)
        for x, y in DOUBLE:
            pair |= (a == ord(x)) & (b == ord(y))
        out[quotes[pair & (quotes + 2 < ends)]] = ENDING2
        out[quotes[np.isin(a, [ord(c) for c in SINGLE]) & (quotes + 1 < ends)]] = ENDING1
    out[starts] += FIRST
    return out


def pretoken_starts(data: bytes, text_starts: np.ndarray) -> np.ndarray:
    """Byte places where pre-tokens begin, in UTF-8 texts that lie one after another and begin at text_starts (bytes;
    ascending, none empty)."""
    if not data:
        return np.zeros(0, np.int64)
    points = np.frombuffer(data.decode().encode("utf-32-le"), np.uint32)
    place = None
    if len(points) < len(data):
        # The byte place of each character: bytes that do not continue one.
        place = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
        text_starts = np.searchsorted(place, text_starts)
    of_symbol, compose, from_free, opens, none = _functions()
    seen = symbols(points, text_starts)
    state = from_free[scan(of_symbol[seen], compose, none)]
    found = np.flatnonzero(opens[seen, np.append(np.uint8(FREE), state[:-1])])
    return found if place is None else place[found]


@functools.cache
def vocabulary(path: str) -> dict[bytes, int]:
    """Ranks of a file of lines `base64 rank`."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the pair of least rank is merged, the leftmost of several, until no pair has a rank."""
    if piece in ranks:
        return [ranks[piece]]
    if len(piece) > SHORT_PIECE:
        return _merged_long(piece, ranks)
    parts, none, rank = [piece[i : i + 1] for i in range(len(piece))], 1 << 32, ranks.get
    pairs = [rank(a + b, none) for a, b in zip(parts, parts[1:])]
    while pairs and (least := min(pairs)) < none:
        at = pairs.index(least)
        both = parts[at] + parts[at + 1]
        parts[at : at + 2] = [both]
        del pairs[at]
        if at:
            pairs[at - 1] = rank(parts[at - 1] + both, none)
        if at < len(pairs):
            pairs[at] = rank(both + parts[at + 1], none)
    return [ranks[p] for p in parts]


def _merged_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same in n log n: parts are linked by their ends, pairs wait in a heap as rank and place in one number."""
    n = len(piece)
    end = list(range(1, n + 1))  # where the part that begins here ends; 0 where none begins any more
    start = list(range(-1, n))  # where the part that ends here begins
    heap = [(r << 40) + i for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        rank, at = divmod(heapq.heappop(heap), 1 << 40)
        middle = end[at]
        if not middle or middle == n:
            continue
        stop = end[middle]
        if ranks.get(piece[at:stop]) != rank:
            continue
        end[at], end[middle], start[stop] = stop, 0, at
        if stop < n and (r := ranks.get(piece[at : end[stop]])) is not None:
            heapq.heappush(heap, (r << 40) + at)
        left = start[at]
        if left >= 0 and (r := ranks.get(piece[left:stop])) is not None:
            heapq.heappush(heap, (r << 40) + left)
    ids, at = [], 0
    while at < n:
        ids.append(ranks[piece[at : end[at]]])
        at = end[at]
    return ids


class Pieces(dict):
    """Merged pre-tokens as the bytes of their 32-bit ids; emptied when full."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, piece: bytes) -> bytes:
        ids = np.array(merged(piece, self.ranks), np.int32).tobytes()
        if len(piece) <= REMEMBERED_BYTES:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = ids
        return ids


@functools.cache
def _worker(path: str) -> tuple[Pieces, np.ndarray, np.ndarray, np.ndarray]:
    """A worker's cache and, by id, length and place of each token in one pool of bytes."""
    ranks = vocabulary(path)
    size = max(ranks.values(), default=-1) + 1
    tokens = [b""] * size
    for token, rank in ranks.items():
        tokens[rank] = token
    length = np.array([len(t) for t in tokens], np.int64)
    return Pieces(ranks), length, np.cumsum(length) - length, np.frombuffer(b"".join(tokens), np.uint8)


def encode_texts(texts: list[bytes], path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids of all texts, each token's end inside its text in bytes, number of tokens of each text)."""
    pieces, length, _, _ = _worker(path)
    sizes = np.array([len(t) for t in texts], np.int64)
    data, stops = b"".join(texts), np.cumsum(sizes)
    starts = pretoken_starts(data, (stops - sizes)[sizes > 0])
    edges = [*starts.tolist(), len(data)]
    slices = [data[a:b] for a, b in zip(edges, edges[1:])]
    ids = np.frombuffer(b"".join(map(pieces.__getitem__, slices)), np.int32)
    ends = np.cumsum(length[ids])
    upto = np.searchsorted(ends, stops, "right")
    counts = np.diff(upto, prepend=0)
    return ids, (ends - np.repeat(stops - sizes, counts)).astype(np.int32), counts


def decode_ids(ids: np.ndarray, path: str, block: int = 1 << 18) -> bytes:
    """The bytes of known ids: places in the pool come from running sums of lengths."""
    _, length, place, pool = _worker(path)
    out = []
    for at in range(0, len(ids), block):
        part = ids[at : at + block]
        sizes = length[part]
        ends = np.cumsum(sizes)
        out.append(pool[np.repeat(place[part] - (ends - sizes), sizes) + np.arange(ends[-1])].tobytes())
    return b"".join(out)


def _groups(sizes: np.ndarray) -> Iterator[slice]:
    """Runs of texts of about GROUP_BYTES."""
    at, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if total and total + size > GROUP_BYTES:
            yield slice(at, i)
            at, total = i, 0
        total += size
    if at < len(sizes):
        yield slice(at, len(sizes))


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))


def _encoder(path: str, text: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(text).cast(pa.large_binary()).fill_null(b"")
            for part in _groups(np.diff(np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1])):
                ids, ends, counts = encode_texts(column[part].to_pylist(), path)
                rows = batch.slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays(
                    [*[rows.column(n) for n in names], _lists(ids, counts), _lists(ends, counts)], names=[*names, "ids", "ends"]
                )

    return run


def encode(docs: DataFrame, text_col: str = "text", path: str | None = None) -> DataFrame:
    """docs without the text, plus ids (the tokens of the whole text, as the tiktoken library's encode_ordinary gives
    them) and ends (where each token ends in the text's UTF-8 bytes).

    Rows stay in their tasks: nothing is shuffled. A null text is an empty one and has empty lists. Strings of special
    tokens are ordinary text. A text of any length is one scan; its memory is about 12 bytes a character, and one
    pre-token without a boundary takes about 100 bytes a byte while it is merged. Every row counts, also repeated
    ones. Input columns named ids or ends give way; all others are passed on. path names the file of ranks on the
    executors.
    """
    ship(docs.sparkSession)
    kept = [f for f in docs.schema if f.name not in (text_col, "ids", "ends")]
    whole = T.ArrayType(T.IntegerType(), False)
    schema = T.StructType([*kept, T.StructField("ids", whole), T.StructField("ends", whole)])
    rows = docs.select(*[docs[f"`{f.name}`"] for f in kept], docs[f"`{text_col}`"])
    return rows.mapInArrow(_encoder(path or multi_path(), text_col, [f.name for f in kept]), schema)


def _decoder(path: str, ids: str, out: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, length, _, _ = _worker(path)
        for batch in batches:
            column = batch.column(ids)
            texts = []
            for i in range(len(column)):
                own = column[i].values
                if own is None or own.null_count:
                    texts.append(None)
                    continue
                own = own.to_numpy(zero_copy_only=False)
                known = len(own) == 0 or (own.min() >= 0 and own.max() < len(length) and length[own].min() > 0)
                texts.append(decode_ids(own, path) if known else None)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(texts, pa.binary())], names=[*names, out]
            )

    return run


def decode(rows: DataFrame, ids_col: str = "ids", out: str = "decoded", path: str | None = None) -> DataFrame:
    """rows without their ids, plus the bytes that these stand for (`out`, binary, as ids may cut a character).

    Null ids, and lists that hold a null or an id that the vocabulary has not, decode to null; no ids to no bytes. An
    input column named like `out` gives way; all others are passed on.
    """
    ship(rows.sparkSession)
    kept = [f for f in rows.schema if f.name not in (ids_col, out)]
    schema = T.StructType([*kept, T.StructField(out, T.BinaryType())])
    narrow = rows.select(*[rows[f"`{f.name}`"] for f in kept], rows[f"`{ids_col}`"])
    return narrow.mapInArrow(_decoder(path or multi_path(), ids_col, out, [f.name for f in kept]), schema)
