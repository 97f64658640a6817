"""Repeated byte strings by the common-prefix interval tree of an enhanced suffix array.

Documents are cut into runs of window starts that share an anchor (``repeats``), so that equal strings meet in one shard. A shard's suffixes are
sorted by doubling the sorted prefix length; common-prefix lengths of neighbours come from the ranks of every doubling. A stack scan
over them visits the intervals of the common-prefix tree; an interval whose occurrences have different symbols to their left is
a maximal repeat, and is given out with all its occurrences. Intervals with equal left symbols are part of the interval one symbol longer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.arrays import BYTE_CODE, Text, prefix_sums
from tradewind.llm.repeats import removed, union

LENGTH, GRAM = 400, 128
#: Bytes of one shard's suffix array.
SHARD = 2 << 20
_NO_LEFT = 256


class SuffixArray:
    """Sorted suffixes of several strings that end apart; suffixes are compared up to their end.

    ``order`` holds the places that are asked for, sorted; ``common`` the common prefix of each with its predecessor (0 for the first).
    """

    def __init__(self, strings: list[bytes], counts: np.ndarray, least: int):
        sizes = np.array([len(s) for s in strings], np.int64)
        self.data = np.frombuffer(b"".join(strings), np.uint8)
        self.begin = np.cumsum(sizes) - sizes
        self.string = np.repeat(np.arange(len(strings)), sizes)
        n = len(self.data)
        within = np.arange(n) - self.begin[self.string]
        self.left_over = (sizes[self.string] - within).astype(np.int64)
        asked = within < np.asarray(counts)[self.string]
        self.ranks = self._ranks(int(sizes.max(initial=1)))
        at = np.flatnonzero(asked & (self.left_over >= least))
        last = self.ranks[max(self.ranks)]
        self.order = at[np.lexsort((self.left_over[at], last[at]))]
        self.common = self._common(least)
        self.left = np.full(n, _NO_LEFT, np.int64)
        self.left[1:] = np.where(within[1:] > 0, self.data[:-1].astype(np.int64), _NO_LEFT)

    def _ranks(self, depth: int) -> dict[int, np.ndarray]:
        """Rank of every suffix by its first 8, 16, ... symbols; the end of a string sorts before any symbol."""
        n = len(self.data)
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        self.head = np.zeros(n, np.uint64)
        for k in range(8):
            self.head = (self.head << np.uint64(8)) | np.where(self.left_over > k, padded[k : n + k], 0).astype(np.uint64)
        key, ranks, size = self.head, {}, 8
        while True:
            order = np.argsort(key)
            new = np.ones(n, bool)
            new[1:] = key[order[1:]] != key[order[:-1]]
            rank = np.empty(n, np.uint64)
            rank[order] = np.cumsum(new)
            ranks[size] = rank
            if size >= depth or new.all():
                return ranks
            after = np.zeros(n, np.uint64)
            after[: max(0, n - size)] = rank[size:]
            key = (rank << np.uint64(32)) | np.where(self.left_over > size, after, 0)
            size *= 2

    def _common(self, least: int) -> np.ndarray:
        """Common prefix of neighbours, from the longest doubling down to single symbols; exact where it is at least ``least``."""
        out = np.zeros(len(self.order), np.int64)
        if len(self.order) < 2:
            return out
        i, j = self.order[:-1], self.order[1:]
        room = np.minimum(self.left_over[i], self.left_over[j])
        length = np.zeros(len(i), np.int64)
        alive = np.arange(len(i))
        for size in sorted(self.ranks, reverse=True):
            for _ in range(1 + (size == max(self.ranks))):
                a, b, go = i[alive] + length[alive], j[alive] + length[alive], length[alive] < room[alive]
                same = alive[go][self.ranks[size][a[go]] == self.ranks[size][b[go]]]
                length[same] += size
        for size in (4, 2, 1):
            go = np.flatnonzero(length < room)
            shift = np.uint64(64 - 8 * size)
            same = go[(self.head[i[go] + length[go]] >> shift) == (self.head[j[go] + length[go]] >> shift)]
            length[same] += size
        out[1:] = np.minimum(length, room)
        return out

    def maximal_repeats(self, least: int) -> Iterator[tuple[int, int, int]]:
        """(length, from, to): occurrences order[from : to] of a string that cannot be made longer on either side for all of them."""
        joined = self.common >= least
        edges = np.flatnonzero(np.diff(np.concatenate([[0], joined.astype(np.int8), [0]])))
        starts, ends = edges[::2] - 1, edges[1::2]
        if not len(starts):
            return
        left = self.left[self.order]
        both = np.stack([starts, ends], axis=1).reshape(-1)
        padded = np.append(left, 0)
        low, high = np.minimum.reduceat(padded, both)[::2], np.maximum.reduceat(padded, both)[::2]
        # If all occurrences in a whole stretch follow the same symbol, the stretch one place to the left holds them.
        for k in np.flatnonzero((low != high) | (high == _NO_LEFT)):
            yield from self._scan(int(starts[k]), int(ends[k]), left)

    def _scan(self, start: int, end: int, left: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Stack scan of one stretch: each stack entry is an open interval (length, from, least and greatest left symbol)."""
        common = self.common[start:end].tolist()
        symbols = left[start:end].tolist()
        stack: list[list[int]] = []
        low = high = symbols[0]
        for k in range(1, len(common) + 1):
            now = common[k] if k < len(common) else 0
            opened = k - 1
            low = high = symbols[k - 1]
            while stack and stack[-1][0] > now:
                length, opened, least, most = stack.pop()
                low, high = min(low, least), max(high, most)
                if low != high or high == _NO_LEFT:
                    yield length, start + opened, start + k
            if now:
                if stack and stack[-1][0] == now:
                    stack[-1][2], stack[-1][3] = min(stack[-1][2], low), max(stack[-1][3], high)
                else:
                    stack.append([now, opened, low, high])


def covered(strings: list[bytes], ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches (string, from, to) that repeats of at least LENGTH bytes cover in each string."""
    array = SuffixArray(strings, counts, LENGTH)
    best = np.zeros(len(array.order), np.int64)
    for length, start, end in array.maximal_repeats(LENGTH):
        np.maximum(best[start:end], length, out=best[start:end])
    hit = np.flatnonzero(best)
    place = array.order[hit]
    string = array.string[place]
    if not len(hit):
        return string, place, place
    # One line of all strings: each keeps to its own stretch, so uniting the line unites every string.
    apart = string * 2
    start, end = union(place + apart, place + apart + best[hit])
    owner = np.searchsorted(array.begin + np.arange(len(strings)) * 2, start, "right") - 1
    base = array.begin[owner] + owner * 2
    return owner, start - base, end - base


def _symbols(text: Text):
    def stretch(row: int, start: int, end: int) -> bytes:
        base = int(text.offsets[row])
        return text.data[base + start : base + end].tobytes()

    return prefix_sums(BYTE_CODE[text.data]), text.offsets, stretch


def _digest(text: Text, first: np.ndarray, row: int, start: np.ndarray, end: np.ndarray) -> str:
    data = text.data[int(first[row]) : int(first[row + 1])]
    found, at = hashlib.sha256(), 0
    for a, b in zip(start.tolist(), end.tolist()):
        found.update(data[at:a].tobytes())
        at = b
    found.update(data[at:].tobytes())
    return found.hexdigest()


def without_repeats(docs: DataFrame, block: int = 2000) -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, n_spans, kept_sha256), one per row of ``docs``: bytes under a 400-byte string that also starts
    anywhere else, the same text included, are removed.

    A null text is empty. Every row counts as a document, so repeated rows remove each other; a null doc_id is kept as null.
    Other columns are ignored; an empty table gives no rows. Equal runs are told by 128 bits of hashes, all else by the bytes.
    """
    out = removed(docs, _symbols, _digest, covered, LENGTH, GRAM, earlier=False, shard=SHARD, block=block)
    return out.select("doc_id", F.col("size").alias("n_bytes"), "n_removed", "n_spans", F.col("kept").alias("kept_sha256"))
