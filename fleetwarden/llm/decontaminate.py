"""Benchmark decontamination: q-gram counts in diagonal bands, verified by banded alignment."""

from __future__ import annotations

import copy
import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwarden.llm.characters import code_points, folded, squeezed
from fleetwarden.llm.frames import body, digest, row_struct
from fleetwarden.session import ship, staged

#: Lengths of passages, in characters after folding: about 13 words, and a longer one that may have more edits in one
#: place. Items below a length, down to SHORTEST, are one passage; still shorter ones down to Q are found as they are.
LENGTHS, SHORTEST = (75, 100), 32
#: Length of a q-gram and the edits that a passage may have, by its length.
Q, EDITS = 10, 0.06
#: Characters of benchmark text that are broadcast at once; a larger benchmark is searched in blocks of this size.
BLOCK = 1_000_000
#: Characters of documents handled at once.
SLICE = 400_000
#: Passages that are aligned at once.
CHUNK = 20_000
#: Shared q-grams, as pairs of a text place and an item place, that are looked at together.
PAIRS = 2_000_000

HITS = "row_id long, row_body long, item_id long, item_at int, same int, edits int, text_start long, text_end long"

#: Length of the q-gram that finds an item below SHORTEST; one of Q characters has a blank at each end at most.
_START = Q - 2
#: Scripts that write no blanks between words: Thai, Lao, Burmese, Khmer, Chinese, Japanese.
_UNSPACED = ((0xE00, 0xEFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0x312F), (0x31A0, 0x9FFF), (0xF900, 0xFAFF),
             (0xFF66, 0xFF9F), (0x1AFF0, 0x1B16F), (0x20000, 0x3FFFF))

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_FILTER = np.uint64(44)


def normalised(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points in lower case with one blank for each run of other signs, and their places in the text."""
    points = folded()[code_points(text)]
    at = np.flatnonzero(squeezed(points))
    return points[at], at


def edit_budget(length: int) -> int:
    """Edits a passage may have; never so many that the q-gram lemma promises no shared q-gram."""
    return max(0, min(int(EDITS * length), (length - Q) // Q))


def gram_digests(points: np.ndarray, q: int = Q) -> np.ndarray:
    """A 64-bit number for the q-gram that starts at each place, by doubling."""
    value, have, out, done = points.astype(np.uint64) + np.uint64(1), 1, None, 0
    left, power = q, _MULTIPLIER
    n = max(0, len(points) - q + 1)
    while left:
        if left & 1:
            part = value[done : done + n]
            out = part.copy() if out is None else out * power + part
            done += have
        left >>= 1
        if left:
            value = value[: len(value) - have] * power + value[have:] if len(value) > have else value[:0]
            have, power = have * 2, np.uint64((int(power) ** 2 + 2) % 2**64)
    return out ^ (out >> np.uint64(31)) if n else np.zeros(0, np.uint64)


def unspaced(points: np.ndarray) -> np.ndarray:
    """Which code points are of a script without blanks between words."""
    out = np.zeros(len(points), bool)
    for low, high in _UNSPACED:
        out |= (points >= low) & (points <= high)
    return out


def _expanded(start: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, value) of the ranges start, start + 1, ... of `many` values each."""
    owner = np.repeat(np.arange(len(many)), many)
    return owner, start[owner] + np.arange(len(owner)) - (np.cumsum(many) - many)[owner]


class ShortItems:
    """Benchmark items from Q to below SHORTEST characters, by their first q-gram."""

    def __init__(self, items: list[tuple[int, str]]):
        texts = [(item, normalised(text or "")[0]) for item, text in items]
        texts = [(item, points[int(points[0] == 32) : len(points) - int(points[-1] == 32)]) for item, points in texts if Q <= len(points) < SHORTEST]
        start = np.array([gram_digests(points, _START)[0] for _, points in texts], np.uint64)
        order = np.argsort(start, kind="stable")
        self.value, texts = start[order], [texts[i] for i in order.tolist()]
        self.ids = [item for item, _ in texts]
        self.size = np.array([len(points) for _, points in texts], np.int64)
        self.letters = np.zeros((len(texts), SHORTEST), np.uint32)
        for i, (_, points) in enumerate(texts):
            self.letters[i, : len(points)] = points
        self.seen = np.zeros(1 << (64 - int(_FILTER)), bool)
        self.seen[(self.value * _MULTIPLIER) >> _FILTER] = True

    def search(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, start, end) wherever an item stands without edits between ends of words."""
        if not self.ids or not len(points):
            return tuple(np.zeros(0, np.int64) for _ in range(3))
        value = gram_digests(points, _START)
        at = np.flatnonzero(self.seen[(value * _MULTIPLIER) >> _FILTER])
        low = np.searchsorted(self.value, value[at], side="left")
        owner, item = _expanded(low, np.searchsorted(self.value, value[at], side="right") - low)
        start, size = at[owner], self.size[item]
        text = np.concatenate([[32], points, np.full(SHORTEST + 1, 32)]).astype(np.uint32)
        text[text == 0] = 32
        same = np.ones(len(item), bool)
        for i in range(int(size.max(initial=0))):
            same &= (text[start + 1 + i] == self.letters[item, i]) | (i >= size)
        end = start + size
        for inner, outer in ((text[start + 1], text[start]), (text[end], text[end + 1])):
            same &= (outer == 32) | unspaced(outer) | unspaced(inner)
        return item[same], start[same], end[same]


class Index:
    """Passages of benchmark items, and where the items' q-grams occur.

    Passages are numbered through: for each item first those of one length, then those of the next, from every place.
    They are kept as ranges, not one by one. Of the places of an item that are followed by the same characters, as
    many as the longest passage has, the first stands for all: `same` has their number there and 0 at the others,
    `like` has the first one's place.
    Only q-grams of such first passages are kept, so an item that repeats itself is not longer than what it repeats.
    """

    def __init__(self, items: list[tuple[int, str]]):
        texts = [(item, normalised(text or "")[0]) for item, text in items]
        texts = [(item, points) for item, points in texts if len(points) >= SHORTEST]
        self.ids = [item for item, _ in texts]
        self.size = np.array([len(points) for _, points in texts], np.int64)
        self.offset = np.cumsum(self.size) - self.size
        self.letters = np.concatenate([points for _, points in texts]) if texts else np.zeros(0, np.uint32)
        # Ranges of passages: item, length, edits, and the number of the first.
        kinds = [(i, n) for i, size in enumerate(self.size.tolist()) for n in sorted({min(size, n) for n in LENGTHS})]
        self.of = np.array([i for i, _ in kinds], np.int64)
        self.long = np.array([n for _, n in kinds], np.int64)
        self.edits = np.array([edit_budget(n) for _, n in kinds], np.int64)
        many = self.size[self.of] - self.long + 1
        self.first = np.cumsum(many) - many
        self.many = int(many.sum())
        # The lemma: a passage of length m with k edits shares at least m - q + 1 - k q of its q-grams.
        self.least = self.long - Q + 1 - self.edits * Q
        grams = [gram_digests(points) for _, points in texts]
        owner = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
        self.same, self.like = np.ones(len(self.letters), np.int64), np.arange(len(self.letters))
        for offset, (_, points) in zip(self.offset.tolist(), texts):
            value = gram_digests(points, max(LENGTHS))
            _, head, of, many = np.unique(value, return_index=True, return_inverse=True, return_counts=True)
            self.same[offset : offset + len(value)] = 0
            self.same[offset + head] = many
            self.like[offset : offset + len(value)] = offset + head[of]
        edge = np.zeros(len(self.letters) + max(LENGTHS) + 1, np.int64)
        first = np.flatnonzero(self.same)
        edge[first] += 1
        edge[first + max(LENGTHS) - Q + 1] -= 1
        kept = np.flatnonzero(np.cumsum(edge)[self.offset[owner] + place]) if len(owner) else place
        value = np.concatenate(grams)[kept] if grams else np.zeros(0, np.uint64)
        owner, place = owner[kept], place[kept]
        self.low, self.high = 0, len(self.letters)
        order = np.argsort(value, kind="stable")
        self.value, self.owner, self.place = value[order], owner[order].astype(np.int64), place[order].astype(np.int64)
        self.seen = np.zeros(1 << (64 - int(_FILTER)), bool)
        self.seen[(self.value * _MULTIPLIER) >> _FILTER] = True
        self.width = int(self.edits.max(initial=0)) + 1

    def lookup(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text place, first row, rows) of every q-gram of the text that an item may have."""
        value = gram_digests(points)
        at = np.flatnonzero(self.seen[(value * _MULTIPLIER) >> _FILTER])
        low = np.searchsorted(self.value, value[at], side="left")
        return at, low, np.searchsorted(self.value, value[at], side="right") - low

    def halves(self) -> list[Index]:
        """Two indexes that hold the passages from each half of the places of this one, or none if it is short."""
        if self.high - self.low <= 4 * max(LENGTHS):
            return []
        middle, out = (self.low + self.high) // 2, []
        for low, high in ((self.low, middle), (middle, self.high)):
            part = copy.copy(self)
            part.low, part.high = low, high
            at = self.offset[self.owner] + self.place
            kept = (at >= low) & (at < high + max(LENGTHS))
            part.value, part.owner, part.place = self.value[kept], self.owner[kept], self.place[kept]
            out.append(part)
        return out

    def start(self, passage: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Where each passage begins in the characters of all items."""
        return self.offset[self.of[kind]] + passage - self.first[kind]

    def kind(self, passage: np.ndarray) -> np.ndarray:
        """The range that each passage is in."""
        return np.searchsorted(self.first, passage, side="right") - 1

    @functools.cached_property
    def _kinds(self) -> np.ndarray:
        return self.kind(np.arange(self.many))

    @functools.cached_property
    def item(self) -> list[int]:
        return [self.ids[i] for i in self.of[self._kinds].tolist()]

    @functools.cached_property
    def length(self) -> np.ndarray:
        return self.long[self._kinds]

    @functools.cached_property
    def budget(self) -> np.ndarray:
        return self.edits[self._kinds]

    @functools.cached_property
    def points(self) -> list[np.ndarray]:
        start = self.offset[self.of[self._kinds]] + np.arange(self.many) - self.first[self._kinds]
        return [self.letters[a : a + n] for a, n in zip(start.tolist(), self.length.tolist())]


def matches(index: Index, at: np.ndarray, low: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, diagonal, item place) of every q-gram that the text shares with an item, by item and diagonal.

    A diagonal is text place minus item place.
    """
    owner, row = _expanded(low, many)
    item, place = index.owner[row], index.place[row]
    diagonal = at[owner] - place
    order = np.lexsort((place, diagonal, item))
    return item[order], diagonal[order], place[order]


def candidates(index: Index, item: np.ndarray, diagonal: np.ndarray, place: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(passage, first diagonal) of every band with as many q-grams of the passage as its edit budget requires.

    Bands are 2 * width diagonals wide and start every `width` diagonals, with width above the largest budget, so an
    occurrence lies wholly inside one of them. About CHUNK passages come at once.
    """
    if not len(item):
        return
    band = diagonal // index.width
    offset = 1 - int(band.min())
    span = int(band.max()) + offset + 1
    key = item * span + band + offset
    key, place = np.concatenate([key, key - 1]), np.concatenate([place, place])
    # Bands with too few q-grams for any passage go first.
    fewest = np.full(len(index.size), 1 << 60, np.int64)
    np.minimum.at(fewest, index.of, index.least)
    bands, slot, shared = np.unique(key, return_inverse=True, return_counts=True)
    stays = (shared >= fewest[bands // span])[slot]
    slot, place = slot[stays], place[stays]
    order = np.lexsort((place, slot))
    slot, place = slot[order], place[order]
    for nth in range(len(LENGTHS)):
        # The range of passages of this length; an item that has fewer lengths is through.
        kind = np.searchsorted(index.of, bands[slot] // span, side="left") + nth
        known = kind < len(index.of)
        known[known] = index.of[kind[known]] == bands[slot[known]] // span
        mine, at, kind = slot[known], place[known], kind[known]
        last = np.arange(len(mine)) + index.least[kind] - 1
        enough = last < len(mine)
        last = np.minimum(last, max(0, len(mine) - 1))
        reach = index.long[kind] - Q
        if len(mine):
            enough &= (mine[last] == mine) & (at[last] - at <= reach)
        i = np.flatnonzero(enough)
        # Passages that hold this q-gram and the one that makes them enough; what the one before covers is left out.
        mine, kind, low, high = mine[i], kind[i], at[last[i]] - reach[i], at[i]
        low, high = np.maximum(low, 0), np.minimum(high, index.size[index.of[kind]] - index.long[kind])
        low[1:] = np.where(mine[1:] == mine[:-1], np.maximum(low[1:], high[:-1] + 1), low[1:])
        many = np.maximum(high - low + 1, 0)
        group = np.cumsum(many) // CHUNK
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
        for a, b in zip(cuts, cuts[1:]):
            owner, start = _expanded(low[a:b], many[a:b])
            if len(owner):
                yield index.first[kind[a:b]][owner] + start, ((bands[mine[a:b]] % span - offset) * index.width)[owner]


class _Runs:
    """Stretches in which text and item agree, from their shared q-grams."""

    def __init__(self, index: Index, item: np.ndarray, diagonal: np.ndarray, place: np.ndarray):
        new = np.ones(len(item), bool)
        new[1:] = (item[1:] != item[:-1]) | (diagonal[1:] != diagonal[:-1]) | (place[1:] != place[:-1] + 1)
        head = np.flatnonzero(new)
        end = place[np.append(head[1:], len(item)) - 1] + Q if len(item) else place
        longest = end - place[head] >= int(index.long.min(initial=1 << 60))
        head, self.end = head[longest], end[longest]
        self.least = int(diagonal[head].min(initial=0))
        self.span = int(diagonal[head].max(initial=0)) - self.least + 1
        self.size = int(index.size.max(initial=0)) + 1
        self.line = item[head] * self.span + diagonal[head] - self.least
        self.key = self.line * self.size + place[head]

    def hold(self, item: np.ndarray, diagonal: np.ndarray, place: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the item's characters from a place on are the text's on this diagonal."""
        if not len(self.key):
            return np.zeros(len(item), bool)
        line = item * self.span + diagonal - self.least
        at = np.searchsorted(self.key, line * self.size + place, side="right") - 1
        inside = (diagonal >= self.least) & (diagonal < self.least + self.span) & (at >= 0)
        return inside & (self.line[at] == line) & (self.end[at] >= place + length)


def align(index: Index, points: np.ndarray, passage: np.ndarray, diagonal: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(edits, start, end) of each candidate's best occurrence inside its band, by banded alignment.

    diagonal is text place minus passage place. The text around the occurrence is free. Cells are (place in the
    passage, diagonal); the band is widened by the budget on both sides. All candidates advance together, a passage
    place at a time.
    """
    side = index.width
    across = 4 * side + 1
    kind = index.kind(passage)
    n, length = len(passage), index.long[kind]
    from_ = index.start(passage, kind)
    text = points.astype(np.int64)
    column = diagonal[:, None] - side + np.arange(across)
    cost = np.zeros((n, across), np.int64)
    first = column.copy()  # where the occurrence starts in the text
    final, final_start = cost.copy(), first.copy()
    step = np.arange(across)
    for i in range(int(length.max(initial=0))):
        here = column + i
        inside = (here >= 0) & (here < len(text))
        letter = index.letters[np.minimum(from_ + i, len(index.letters) - 1)]
        same = inside & (text[np.clip(here, 0, len(text) - 1)] == letter[:, None])
        change = cost + ~same
        drop = np.full_like(cost, 1 << 30)
        drop[:, :-1] = cost[:, 1:] + 1
        start = np.where(drop < change, np.concatenate([first[:, 1:], first[:, -1:]], axis=1), first)
        new = np.minimum(change, drop)
        # Extra text characters: the cheapest cell to the left plus the distance.
        shifted = new - step
        best = np.minimum.accumulate(shifted, axis=1)
        source = np.maximum.accumulate(np.where(shifted == best, step, 0), axis=1)
        cost, first = best + step, np.take_along_axis(start, source, axis=1)
        done = length == i + 1
        final[done], final_start[done] = cost[done], first[done]
    if not n:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0, int)
    at = final.argmin(axis=1)
    rows = np.arange(n)
    return final[rows, at], np.maximum(final_start[rows, at], 0), np.minimum(column[rows, at] + length, len(text))


def occurrences(index: Index, points: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(passage, edits, start, end) of passages within their budget, some at once; a place may come twice.

    Of equal passages of an item the first comes. Where a band holds a passage without edits, its places are given by
    the stretches in which text and item agree; all other candidates are aligned. A text that shares more than PAIRS
    q-grams is searched in halves that overlap by a passage, a short one for half of the passages at a time.
    """
    if not index.many or not len(points):
        return
    found = index.lookup(points)
    if found[2].sum() > PAIRS:
        overlap = max(LENGTHS) + 4 * index.width + Q
        if len(points) > 8 * overlap:
            half = len(points) // 2
            yield from occurrences(index, points[: half + overlap])
            for passage, edits, start, end in occurrences(index, points[half:]):
                yield passage, edits, start + half, end + half
            return
        parts = index.halves()
        if parts:
            for part in parts:
                yield from occurrences(part, points)
            return
    item, diagonal, place = matches(index, *found)
    runs = _Runs(index, item, diagonal, place)
    for passage, band in candidates(index, item, diagonal, place):
        kind = index.kind(passage)
        first = index.same[index.start(passage, kind)] > 0
        passage, band, kind = passage[first], band[first], kind[first]
        owner, at, length = index.of[kind], passage - index.first[kind], index.long[kind]
        whole = np.zeros(len(passage), bool)
        for d in range(2 * index.width):
            exact = runs.hold(owner, band + d, at, length)
            whole |= exact
            if exact.any():
                start = (band + d + at)[exact]
                yield passage[exact], np.zeros(len(start), np.int64), start, start + length[exact]
        passage, band, at, kind = (x[~whole] for x in (passage, band, at, kind))
        edits, start, end = align(index, points, passage, band + at)
        good = edits <= index.edits[kind]
        yield passage[good], edits[good], start[good], end[good]


def search(index: Index, points: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(passage, edits, start, end) of passages within their budget, each of equal passages."""
    out = []
    for passage, edits, start, end in occurrences(index, points):
        at = index.start(passage, index.kind(passage))
        for p, e, a, b, place in zip(*(x.tolist() for x in (passage, edits, start, end, at))):
            out += [(p + other - place, e, a, b) for other in np.flatnonzero(index.like == place).tolist()]
    return out


def _scan(index: Index, short: ShortItems):
    overlap = max(LENGTHS) + 4 * index.width + Q

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            # Texts are joined by code points of no text until a slice is full; a longer text is cut with overlap.
            gap = np.zeros(overlap, np.uint32)
            held, size = [], 0

            def note(ids, slot, item, item_at, same, edits, start, end):
                """One row for each text, item and place in the item."""
                order = np.lexsort((item_at, item, slot))
                slot, item, item_at, same, edits, start, end = (x[order] for x in (slot, item, item_at, same, edits, start, end))
                new = np.ones(len(slot), bool)
                new[1:] = (slot[1:] != slot[:-1]) | (item[1:] != item[:-1]) | (item_at[1:] != item_at[:-1])
                head = np.flatnonzero(new)
                if not len(head):
                    return
                edits, start, end = np.minimum.reduceat(edits, head), np.minimum.reduceat(start, head), np.maximum.reduceat(end, head)
                for k, i, place, s, e, a, b in zip(*(x.tolist() for x in (slot[head], item[head], item_at[head], same[head], edits, start, end))):
                    row, p, at, _, _ = held[k]
                    a, b = max(0, a), min(len(p), b)
                    found.append((row, ids[i], place, s, e, int(at[a]), int(at[b - 1]) + 1))

            def flush():
                nonlocal held
                if len(held) > 1 and sum(int(index.lookup(p)[2].sum()) for _, p, *_ in held) > PAIRS:
                    # Texts that share much are searched one by one, so that a text's rows depend on it alone.
                    whole = held
                    for one in whole:
                        held = [one]
                        flush()
                elif held:
                    starts = np.cumsum([0] + [len(p) + overlap for _, p, *_ in held])
                    points = np.concatenate([x for _, p, *_ in held for x in (p, gap)])
                    for passage, edits, start, end in occurrences(index, points):
                        kind = index.kind(passage)
                        slot = np.searchsorted(starts, end - 1, side="right") - 1
                        same = index.same[index.start(passage, kind)]
                        note(index.ids, slot, index.of[kind], passage - index.first[kind], same, edits, start - starts[slot], end - starts[slot])
                    item, start, end = short.search(points)
                    slot = np.searchsorted(starts, start, side="right") - 1
                    start, end = start - starts[slot], end - starts[slot]
                    # At a cut the neighbour is not seen; the overlap shows the place whole in the other part.
                    size_, before, after = (np.array([h(x) for x in held]) for h in (lambda x: len(x[1]), lambda x: x[3], lambda x: x[4]))
                    seen = ~(before[slot] & (start == 0)) & ~(after[slot] & (end == size_[slot]))
                    none = np.zeros(int(seen.sum()), np.int64)
                    note(short.ids, slot[seen], item[seen], none, none + 1, none, start[seen], end[seen])
                held = []

            for i, text in enumerate(batch.column("text")):
                points, at = normalised(text.as_py() or "")
                for a in range(0, max(1, len(points)), SLICE):
                    part = points[a : a + SLICE + overlap]
                    if len(part):
                        held.append((i, part, at[a : a + SLICE + overlap], a > 0, a + SLICE + overlap < len(points)))
                        size += len(part)
                    if size >= SLICE:
                        flush()
                        size = 0
            flush()
            rows = pa.array([f[0] for f in found], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row_id").take(rows),
                    batch.column("row_body").take(rows),
                    *[pa.array([f[k] for f in found], t) for k, t in ((1, pa.int64()), (2, pa.int32()), (3, pa.int32()), (4, pa.int32()), (5, pa.int64()), (6, pa.int64()))],
                ],
                names=["row_id", "row_body", "item_id", "item_at", "same", "edits", "text_start", "text_end"],
            )

    return run


def benchmark_hits(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """Rows (row_id, row_body, item_id, passages, edits, text_start, text_end), one for each document and item that meet.

    Every 75 and every 100 characters of an item, from each of its characters on, are a passage; a document meets the
    item if one passage occurs with at most EDITS of its length in edits. So a quote counts wherever in the item it
    starts. Both sides are compared in lower case with one blank for each run of signs other than letters and digits.
    edits is the least of the passages found, passages the number of places in the item where they start, text_start
    and text_end (code points of the text) span what was found.

    Items of Q to below SHORTEST characters are found without edits, where they begin and end with words; scripts
    without blanks between words have such ends everywhere. Items with fewer than Q characters, null items and null
    or empty texts meet nothing. Repeated
    items and repeated rows are reported once for each id and text. The benchmark is measured first: up to BLOCK
    characters are broadcast as an index, a larger one goes through the documents in blocks of about BLOCK.
    Extra columns are not read.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("row_id"), digest(body(text_col)).alias("row_body"), F.col(text_col).alias("text"))
    texts = items.select(F.col(item_col).cast("long").alias("item"), F.col(item_text).alias("text")).where(F.col("text").isNotNull())
    chars = texts.agg(F.sum(F.char_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(chars / BLOCK))
    texts = texts.withColumn("block", F.pmod(F.xxhash64(F.lit(1), "item", "text"), F.lit(blocks)))
    found = None
    for block in range(blocks):
        held = [(r["item"], r["text"]) for r in texts.where(F.col("block") == block).select("item", "text").collect()]
        held.sort(key=repr)
        hits = rows.mapInArrow(_scan(Index(held), ShortItems(held)), HITS)
        found = hits if found is None else found.unionByName(hits)
    places = found.groupBy("row_id", "row_body", "item_id", "item_at").agg(
        F.max("same").alias("same"),
        F.min("edits").alias("edits"),
        F.min("text_start").alias("text_start"),
        F.max("text_end").alias("text_end"),
    )
    return places.groupBy("row_id", "row_body", "item_id").agg(
        F.sum("same").alias("passages"),
        F.min("edits").alias("edits"),
        F.min("text_start").alias("text_start"),
        F.max("text_end").alias("text_end"),
    )


def without_benchmark(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs in their own columns, without the documents that meet an item of the benchmark.

    Rows that agree in id and text go together. A null or empty text meets no item, so its row stays, and so do all rows
    where the benchmark is empty; null ids are ids, extra columns stay.
    """
    hits = staged(benchmark_hits(docs, items, id_col, text_col).select("row_id", "row_body").distinct())
    rows = docs.select(row_struct(docs), F.col(id_col).cast("long").alias("id"), digest(body(text_col)).alias("body"))
    clean = rows.join(hits, F.col("id").eqNullSafe(F.col("row_id")) & (F.col("body") == F.col("row_body")), "left_anti")
    return clean.select(*[F.col("_row")[c].alias(c) for c in docs.columns])
