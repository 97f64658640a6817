"""Fill-in-the-middle: texts cut at two token boundaries and rearranged, with a learned index from token ranks to offsets.

A token is a run of ASCII letters or any other single code point. The byte offsets of all boundaries of a text are a rising
function of their rank; it is learned as line segments whose error is at most ``ERROR`` bytes, and the differences are stored in one
byte each. A cut is predicted from its rank by its segment and corrected by the stored difference, which is exact.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.arrays import Text, blocks

# Marks before the parts, and the names of the forms.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"

ERROR = 127


class RankIndex:
    """Values by rank for several rows: ``values`` holds each row's rising numbers one after another, ``first`` where rows begin.

    Fitting starts with one segment a row, a line through its ends, and halves segments until no difference exceeds ``error``; all
    segments of a round are measured together. Kept are a first position, a value and a slope per segment and a small difference per
    rank, not the values.
    """

    def __init__(self, values: np.ndarray, first: np.ndarray, error: int = ERROR):
        self.first = first
        self.differences = np.zeros(len(values), np.int8 if error <= 127 else np.int64)
        low, high = first[:-1][np.diff(first) > 0], first[1:][np.diff(first) > 0] - 1
        starts, bases, slopes = [], [], []
        while len(low):
            size = high - low + 1
            slope = (values[high] - values[low]) / np.maximum(high - low, 1)
            within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            at = np.repeat(low, size) + within
            difference = values[at] - (np.repeat(values[low], size) + np.rint(np.repeat(slope, size) * within).astype(np.int64))
            fits = np.maximum.reduceat(np.abs(difference), np.cumsum(size) - size) <= error
            kept = np.repeat(fits, size)
            self.differences[at[kept]] = difference[kept]
            starts.append(low[fits]), bases.append(values[low[fits]]), slopes.append(slope[fits])
            low, high = low[~fits], high[~fits]
            middle = (low + high) // 2
            low, high = np.concatenate([low, middle + 1]), np.concatenate([middle, high])
        empty = np.zeros(0, np.int64)
        starts = np.concatenate([empty, *starts])
        order = np.argsort(starts)
        self.starts = starts[order]
        self.bases = np.concatenate([empty, *bases])[order]
        self.slopes = np.concatenate([np.zeros(0), *slopes])[order]

    def predicted(self, row: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """What the line of a rank's segment says."""
        at = self.first[row] + rank
        segment = np.searchsorted(self.starts, at, "right") - 1
        return self.bases[segment] + np.rint(self.slopes[segment] * (at - self.starts[segment])).astype(np.int64)

    def value(self, row: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The exact value at each rank of a row."""
        return self.predicted(row, rank) + self.differences[self.first[row] + rank]


def boundaries(text: Text) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets of all token boundaries, a row's end included, one row after another; where rows begin (one entry more)."""
    data, offsets = text.data, text.offsets
    lower = data | 32
    letter = (lower >= 97) & (lower <= 122)
    begins = (data & 0xC0) != 0x80
    begins[1:] &= ~(letter[1:] & letter[:-1])
    heads = offsets[:-1][np.diff(offsets) > 0]
    begins[heads] = True
    tokens = np.flatnonzero(begins)
    before = np.searchsorted(tokens, offsets)
    first = before + np.arange(text.rows + 1)
    values = np.empty(len(tokens) + text.rows, np.int64)
    values[np.arange(len(tokens)) + np.repeat(np.arange(text.rows), np.diff(before))] = tokens
    values[first[1:] - 1] = offsets[1:]
    return values, first


def draws(doc_ids: list, seed: int) -> np.ndarray:
    """Four 32-bit numbers of each document, from the SHA-256 of the seed and its id; a missing id counts as nothing."""
    digests = b"".join(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).digest()[:16] for d in doc_ids)
    return np.frombuffer(digests, ">u4").astype(np.int64).reshape(-1, 4)


def fill_in_middle(text: Column, doc_id: Column, seed: int = 1, plain_from: int = 90, spm_below: int = 20) -> Column:
    """Struct (n tokens, form, prefix_chars, middle_chars, output) of each text; see :func:`infilled`."""

    @F.arrow_udf("struct<n: long, form: string, prefix_chars: long, middle_chars: long, output: string>")
    def run(texts: pa.Array, ids: pa.Array) -> pa.Array:
        n, forms, prefixes, middles, outputs = [], [], [], [], []
        names = ids.to_pylist()
        for part in blocks(texts):
            values, first = boundaries(part)
            index = RankIndex(values, first)
            tokens, row = np.diff(first) - 1, np.arange(part.rows)
            h = draws(names[part.first : part.first + part.rows], seed)
            cuts = np.sort(h[:, :2] % (tokens[:, None] + 1), axis=1)
            low, high = index.value(row, cuts[:, 0]), index.value(row, cuts[:, 1])
            chars = np.concatenate([[0], np.cumsum((part.data & 0xC0) != 0x80)])
            before, within = chars[low] - chars[part.offsets[:-1]], chars[high] - chars[low]
            data = part.data.tobytes()
            for i in range(part.rows):
                start, end = int(part.offsets[i]), int(part.offsets[i + 1])
                whole = data[start:end]
                if not whole or h[i, 2] % 100 >= plain_from or any(m in whole for m in (PREFIX, SUFFIX, MIDDLE)):
                    forms.append(PLAIN), prefixes.append(None), middles.append(None), outputs.append(whole)
                    continue
                a, b = int(low[i]) - start, int(high[i]) - start
                prefixes.append(int(before[i])), middles.append(int(within[i]))
                forms.append(SPM if h[i, 3] % 100 < spm_below else PSM)
                head, tail = PREFIX + whole[:a], SUFFIX + whole[b:]
                outputs.append((tail + head if forms[-1] == SPM else head + tail) + MIDDLE + whole[a:b])
            n += tokens.tolist()
        long = lambda v: pa.array(v, pa.int64())
        columns = [long(n), pa.array(forms, pa.string()), long(prefixes), long(middles), pa.array(outputs, pa.binary()).cast(pa.string())]
        return pa.StructArray.from_arrays(columns, ["n", "form", "prefix_chars", "middle_chars", "output"])

    return run(text.cast("string"), doc_id.cast("long"))


def restored(output: Column, form: Column) -> Column:
    """The text that was rearranged into ``output``; no mark stands in the parts, so they are told apart by the marks."""
    part = F.split(output, "<[PSM]>", -1)
    psm = F.concat(F.get(part, F.lit(1)), F.get(part, F.lit(3)), F.get(part, F.lit(2)))
    spm = F.concat(F.get(part, F.lit(2)), F.get(part, F.lit(3)), F.get(part, F.lit(1)))
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)


def infilled(docs: DataFrame, seed: int = 1, plain_from: int = 90, spm_below: int = 20) -> DataFrame:
    """Rows (doc_id, n, form, prefix_chars, middle_chars, output), one per row of ``docs`` (columns doc_id, text; others are ignored).

    The parts are prefix, middle and suffix, cut at two boundaries drawn from the seed and doc_id. ``psm`` and ``spm`` name the order in
    which they stand behind their marks; ``spm_below`` percent are of the second kind. From ``plain_from`` percent on, and for texts that
    are null, empty or hold a mark, the form is ``plain``: the output is the text (null: empty) and the sizes are null. A null doc_id draws
    like an empty one. Two equal cuts leave an empty middle; a text of one token may have all parts but one empty. Texts of any length
    are cut whole, repeated rows give repeated results, an empty table gives no rows. Rows are changed where they stand, without a shuffle.
    """
    doc_id = F.col("doc_id").cast("long")
    out = docs.select(doc_id.alias("doc_id"), fill_in_middle(F.col("text"), doc_id, seed, plain_from, spm_below).alias("f"))
    return out.select("doc_id", "f.*")
