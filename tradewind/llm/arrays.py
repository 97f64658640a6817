"""Vectorised text helpers used inside Arrow tasks, and written intermediates."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tradewind.session import intermediates

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def written(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder as compressed Parquet and read back, so lineage is cut and executors may be lost.

    Inside a :func:`tradewind.session.run_folder` the table goes with the run.
    """
    spark = df.sparkSession
    path = f"{intermediates(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix finalizer)."""
    with np.errstate(over="ignore"):
        x = x.astype(U64)
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[:1] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


class Powers:
    """Powers of an odd base modulo 2^64 and of its inverse, grown as needed."""

    def __init__(self, base: int = BASE):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.zeros(0, U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            self.up, self.down = _powers(size, self.base), _powers(size, self.inverse)
        return self.up[:n], self.down[:n]


POWERS = Powers()
BYTE_CODE = mix(np.arange(1, 257, dtype=U64))


def prefix_sums(codes: np.ndarray) -> np.ndarray:
    """Sums of codes[j] * BASE^j modulo 2^64 before each position (one more than codes)."""
    out = np.zeros(len(codes) + 1, U64)
    up, _ = POWERS.get(len(codes))
    np.cumsum(codes * up, out=out[1:])
    return out


def span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each span [start, end), independent of where it stands; the length is not part of it."""
    _, down = POWERS.get(len(sums))
    return mix((sums[end] - sums[start]) * down[start])


class Text:
    """Some rows' UTF-8 bytes in one array; ``offsets`` has one entry more than rows."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int):
        self.data, self.offsets, self.first, self.rows = data, offsets, first, len(offsets) - 1

    def words(self, lower: bool = False) -> Words:
        return Words(self, lower)


class Words:
    """Runs of bytes other than space and 0x09-0x0D, never across rows."""

    def __init__(self, text: Text, lower: bool):
        data = _LOWER[text.data] if lower else text.data
        solid = ~_SPACES[data]
        starts = solid.copy()
        starts[1:] &= ~solid[:-1]
        ends = solid.copy()
        ends[:-1] &= ~solid[1:]
        edges = text.offsets[1:-1]
        edges = edges[edges < len(data)]
        starts[edges] = solid[edges]
        ends[edges[edges > 0] - 1] = solid[edges[edges > 0] - 1]
        self.start = np.flatnonzero(starts)
        self.end = np.flatnonzero(ends) + 1
        self.hash = span_hashes(prefix_sums(BYTE_CODE[data]), self.start, self.end) + mix((self.end - self.start).astype(U64))
        #: Index of each row's first word, one entry more than rows.
        self.first = np.searchsorted(self.start, text.offsets)


def blocks(column: pa.Array | pa.ChunkedArray, size: int = 1 << 20) -> Iterator[Text]:
    """Cut a text column into runs of rows of about ``size`` bytes; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_binary())
    n = len(column)
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        last = int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1
        last = min(n, max(last, row + 1))
        yield Text(data[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row], row)
        row = last


def shingle_hashes(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words and their rows; a shorter row counts as one shingle, an empty one has none."""
    counts = np.diff(words.first)
    sums = prefix_sums(mix(words.hash))
    at = np.arange(len(words.hash))
    row = np.repeat(np.arange(len(counts)), counts)
    left = words.first[1:][row] - at
    keep = (left >= k) | ((counts[row] < k) & (at == words.first[:-1][row]))
    start, row = at[keep], row[keep]
    length = np.minimum(counts[row], k)
    return span_hashes(sums, start, start + length) + mix(length.astype(U64)), row


def unique_by_row(values: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each row, sorted by row and value."""
    order = np.lexsort((values, row))
    values, row = values[order], row[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
    return values[new], row[new]
