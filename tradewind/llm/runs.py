"""Runs of window starts that share an anchor, chosen by content.

Every window of ``length`` symbols has an anchor: the gram of ``gram`` symbols with the least hash among those inside it (the first
of equals). Equal windows have equal anchors at the same place, wherever they stand, so they can meet by the anchor's
hash alone. Neighbouring windows mostly share their anchor; a run is a stretch of window starts that do.
"""

from __future__ import annotations

import numpy as np

from tradewind.llm.arrays import U64, mix, prefix_sums, span_hashes

_PLACE_BITS = 28


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` neighbours, in time independent of the width."""
    n = len(values) - width + 1
    if width == 1:
        return values
    padded = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    block = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(block, axis=1).reshape(-1)
    behind = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


class Runs:
    """The runs of one sequence of symbol codes: first and last window start, anchor hash, and a hash of the run's symbols.

    ``first`` and ``last`` count symbols from 0; the symbols of a run are [first, last + length).
    """

    def __init__(self, sums: np.ndarray, begin: int, end: int, length: int, gram: int):
        """``sums`` are prefix sums of a longer array of codes, in which the sequence stands at [begin, end)."""
        n = end - begin
        if n < length:
            self.first = self.last = np.zeros(0, np.int64)
            self.anchor = self.content = np.zeros(0, np.int64)
            return
        at = np.arange(begin, end - gram + 1)
        grams = span_hashes(sums, at, at + gram)
        places = np.arange(len(grams), dtype=U64)
        keys = (grams & ~U64((1 << _PLACE_BITS) - 1)) | places
        least = (sliding_minimum(keys, length - gram + 1) & U64((1 << _PLACE_BITS) - 1)).astype(np.int64)
        cut = np.flatnonzero(least[1:] != least[:-1]) + 1
        self.first = np.concatenate([[0], cut])
        self.last = np.concatenate([cut, [len(least)]]) - 1
        anchor = least[self.first]
        self.anchor = grams[anchor].view(np.int64)
        size = (self.last - self.first + length).astype(U64)
        content = span_hashes(sums, begin + self.first, begin + self.last + length)
        self.content = mix(content + mix(size) + mix((anchor - self.first).astype(U64) << U64(32))).view(np.int64)


def code_sums(codes: np.ndarray) -> np.ndarray:
    return prefix_sums(codes)
