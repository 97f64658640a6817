"""Word windows that an earlier document has, by a compressed FM-index per shard.

Texts are cut into runs of window starts that share an anchor (``repeats``), so that equal word sequences meet in one shard. The shard's word
sequences are indexed by their Burrows-Wheeler transform in a wavelet matrix over packed bits. Every sequence is streamed against the index by
backward search; a match ends where no other sequence continues it, and windows whose match reaches the full length with an occurrence in
a smaller doc_id are reported.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.arrays import U64, Text, mix, prefix_sums
from tradewind.llm.repeats import removed, union

LENGTH, GRAM = 50, 16
#: Bytes (8 a word) of one shard's index.
SHARD = 4 << 20


class WaveletMatrix:
    """Rank of any symbol at any place, in log2(alphabet) steps over bits packed 64 to a word with a count before each word."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        self.bits = max(1, int(alphabet - 1).bit_length())
        self.words, self.before, self.zeros = [], [], []
        now = symbols.astype(np.int64)
        n = len(now)
        for level in reversed(range(self.bits)):
            bit = (now >> level) & 1
            packed = np.packbits(np.concatenate([bit, np.zeros(-n % 64 + 64, np.int64)]).astype(np.uint8), bitorder="little").view("<u8")
            counts = np.bitwise_count(packed).astype(np.int64)
            self.words.append(packed)
            self.before.append((np.cumsum(counts) - counts).astype(np.int32))
            self.zeros.append(n - int(bit.sum()))
            now = np.concatenate([now[bit == 0], now[bit == 1]])
        # Where each symbol's stretch starts after the last level.
        self.base = self._descend(np.arange(alphabet), np.zeros(alphabet, np.int64))

    def _descend(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        for depth, level in enumerate(reversed(range(self.bits))):
            word = place >> 6
            inside = self.words[depth][word] & ((U64(1) << (place & 63).astype(U64)) - U64(1))
            ones = self.before[depth][word] + np.bitwise_count(inside)
            place = np.where((symbol >> level) & 1, self.zeros[depth] + ones, place - ones)
        return place

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before ``place``."""
        return self._descend(symbol, place) - self.base[symbol]


class FMIndex:
    """Backward search over several sequences of 64-bit codes; each sequence ends with a separator that no query holds."""

    def __init__(self, sequences: list[np.ndarray], depth: int):
        self.sizes = np.array([len(s) for s in sequences], np.int64)
        codes, ids = np.unique(np.concatenate(sequences), return_inverse=True)
        self.alphabet = len(codes) + 1
        total = int(self.sizes.sum()) + len(sequences)
        self.text = np.zeros(total, np.int64)
        self.begin = np.cumsum(self.sizes + 1) - (self.sizes + 1)
        inside = np.ones(total, bool)
        inside[self.begin + self.sizes] = False
        self.text[inside] = ids + 1
        self.sequence = np.repeat(np.arange(len(sequences)), self.sizes + 1)
        self.order = self._sorted(depth)
        self.transform = WaveletMatrix(self.text[self.order - 1], self.alphabet)
        counts = np.bincount(self.text, minlength=self.alphabet)
        self.first = np.cumsum(counts) - counts

    def _sorted(self, depth: int) -> np.ndarray:
        """Suffixes sorted up to their separator; equal ones keep their place, as backward search needs."""
        n = len(self.text)
        rank, size = self.text, 1
        left = (self.begin + self.sizes)[self.sequence] - np.arange(n)
        while True:
            after = np.zeros(n, np.int64)
            after[: max(0, n - size)] = rank[size:]
            key = (rank << 32) | np.where(left >= size, after, 0)
            order = np.argsort(key, kind="stable")
            new = np.ones(n, bool)
            new[1:] = key[order[1:]] != key[order[:-1]]
            size *= 2
            if new.all() or size >= depth:
                return order
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(new) - 1

    def back(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search: the range of suffixes that start with ``symbol`` and go on as those of [low, high)."""
        return self.first[symbol] + self.transform.rank(symbol, low), self.first[symbol] + self.transform.rank(symbol, high)


def matched(index: FMIndex, owner: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """For windows of the index's own text: whether they start in a sequence of a smaller owner than their own.

    All windows are searched side by side from their last word; a window drops out once only its own occurrence is left.
    """
    low, high = np.zeros(len(starts), np.int64), np.full(len(starts), len(index.text), np.int64)
    alive = np.arange(len(starts))
    for step in range(length - 1, -1, -1):
        low_now, high_now = index.back(index.text[starts[alive] + step], low[alive], high[alive])
        go = high_now - low_now > 1
        alive = alive[go]
        low[alive], high[alive] = low_now[go], high_now[go]
        if not len(alive):
            break
    out = np.zeros(len(starts), bool)
    if len(alive):
        ranges, which = np.unique(np.stack([low[alive], high[alive]], axis=1), axis=0, return_inverse=True)
        owners = np.append(owner[index.sequence[index.order]], 0)
        least = np.minimum.reduceat(owners, ranges.reshape(-1))[::2]
        out[alive] = least[which.reshape(-1)] < owner[index.sequence[starts[alive]]]
    return out


def covered(strings: list[bytes], ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches (sequence, from, to) under windows that also start in a sequence of a smaller id."""
    index = FMIndex([np.frombuffer(s, U64) for s in strings], 2 * LENGTH)
    within = np.arange(len(index.text)) - index.begin[index.sequence]
    starts = np.flatnonzero(within < np.asarray(counts)[index.sequence])
    hit = np.concatenate([starts[i : i + (1 << 17)][matched(index, ids, starts[i : i + (1 << 17)], LENGTH)] for i in range(0, len(starts), 1 << 17)] or [starts])
    if not len(hit):
        return hit, hit, hit
    # Separators keep the sequences apart in one line.
    start, end = union(hit, hit + LENGTH)
    owner = index.sequence[start]
    return owner, start - index.begin[owner], end - index.begin[owner]


def _symbols(text: Text):
    words = text.words()
    codes = mix(words.hash)
    text.cut = words

    def stretch(row: int, start: int, end: int) -> bytes:
        base = int(words.first[row])
        return codes[base + start : base + end].tobytes()

    return prefix_sums(codes), words.first, stretch


def _digest(text: Text, first: np.ndarray, row: int, start: np.ndarray, end: np.ndarray) -> str:
    words, base, last = text.cut, int(first[row]), int(first[row + 1])
    raw = text.data[int(text.offsets[row]) : int(text.offsets[row + 1])].tobytes()
    if not len(start):
        return hashlib.sha256(b" ".join(raw.split())).hexdigest()
    kept, at = [], base
    shift = int(text.offsets[row])
    for a, b in [*zip(start.tolist(), end.tolist()), (last - base, last - base)]:
        if at < base + a:
            kept += raw[int(words.start[at]) - shift : int(words.end[base + a - 1]) - shift].split()
        at = base + b
    return hashlib.sha256(b" ".join(kept)).hexdigest()


def without_earlier_passages(docs: DataFrame, block: int = 2000) -> DataFrame:
    """Rows (doc_id, n_words, n_removed, kept_sha256), one per row of ``docs``: words under a 50-word window that also starts in a document
    of a smaller doc_id are removed.

    Words are runs of other bytes than space and 0x09-0x0D, unchanged. A null text has none. Rows that repeat a doc_id do not remove each
    other; a null doc_id counts as the greatest. Other columns are ignored; an empty table gives no rows. Words are told by 64 bits of hash.
    """
    out = removed(docs, _symbols, _digest, covered, LENGTH, GRAM, earlier=True, shard=SHARD, block=block)
    return out.select("doc_id", F.col("size").alias("n_words"), "n_removed", F.col("kept").alias("kept_sha256"))
