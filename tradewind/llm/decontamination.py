"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact weighted verification.

Items and documents are runs of lower-cased words; features are their shingles of ``k`` words, weighted by rarity among the items.
For every item length, each window of that many words gets a 64-bit SimHash. The fingerprint is looked up in four 16-bit
indexes with all values within ``radius // 4`` bits, which by the pigeonhole principle finds every item fingerprint within ``radius``;
candidates are verified by the exact weighted Jaccard similarity of the two shingle multisets.

A window can reach the threshold only if shingles that occur in some item carry that share of its weight and
of the lightest item's weight; windows that do not are left out before they are fingerprinted, which loses nothing.

A benchmark beyond ``BLOCK_ITEMS`` or ``BLOCK_BYTES`` is searched in blocks, one after another, with the weights of the whole benchmark,
so the blocks change no result. A block knows the weights of its own shingles; those of other shingles in windows that
could match are looked up for the few texts that hold such windows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.arrays import U64, blocks, shingle_hashes, unique_by_row, written

BITS, INDEXES = 64, 4
WIDTH = BITS // INDEXES
#: Bounds of one block of items that is sent to the tasks: items, and bytes of their text.
BLOCK_ITEMS, BLOCK_BYTES = 10_000, 8 << 20

LEAKS = "array<struct<item_id: long, first_word: long, n_words: long, distance: int, similarity: double>>"
_LEAK = pa.struct([("item_id", pa.int64()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("distance", pa.int32()), ("similarity", pa.float64())])


def simhash(hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """64-bit SimHash of each row of features (windows, features)."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(*hashes.shape, 8), axis=-1, bitorder="little")
    votes = np.einsum("wf,wfb->wb", weights, bits.astype(np.float32) * 2 - 1)
    return np.packbits(votes > 0, axis=-1, bitorder="little").view("<u8")[:, 0]


@dataclass
class Items:
    """A block of benchmark items: ids and the shingle hashes of each."""

    ids: list[int]
    shingles: list[np.ndarray]
    lengths: np.ndarray
    k: int
    least: float
    radius: int
    #: Items of the whole benchmark, and sorted shingles with the number of its items that hold each; by default the block's own.
    total: int | None = None
    counts: tuple[np.ndarray, np.ndarray] | None = None

    @classmethod
    def of(cls, rows: list[tuple[int, str]], k: int, least: float, radius: int) -> Items:
        ids, shingles, lengths = [], [], []
        for text in blocks(pa.array([r[1] for r in rows], pa.string())):
            words = text.words(lower=True)
            values, row = shingle_hashes(words, k)
            edges = np.searchsorted(row, np.arange(text.rows + 1))
            for i, n in enumerate(np.diff(words.first)):
                if n:
                    ids.append(rows[text.first + i][0])
                    shingles.append(values[edges[i] : edges[i + 1]])
                    lengths.append(int(n))
        return cls(ids, shingles, np.array(lengths, np.int64), k, least, radius)

    @cached_property
    def own(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct shingles of the block's items, and how many of these hold each."""
        each = [np.unique(s) for s in self.shingles]
        return np.unique(np.concatenate(each) if each else np.zeros(0, U64), return_counts=True)

    @cached_property
    def vocabulary(self) -> tuple[np.ndarray, np.ndarray]:
        """Shingles and their weights; any other shingle weighs ``rare``."""
        values, counts = self.counts or self.own
        return values, (1 + np.log((self.total or len(self.ids)) / counts)).astype(np.float32)

    @cached_property
    def inside(self) -> np.ndarray:
        """Whether each shingle of the vocabulary occurs in an item of the block."""
        return np.isin(self.vocabulary[0], self.own[0])

    @cached_property
    def rare(self) -> float:
        return 1 + math.log(max(1, self.total or len(self.ids)))

    @cached_property
    def maybe(self) -> np.ndarray:
        """Bits of the shingles' low 22 bits, to skip most lookups."""
        bits = np.zeros(1 << 22, bool)
        bits[(self.vocabulary[0] & U64((1 << 22) - 1)).astype(np.int64)] = True
        return bits

    def weights(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weight of each shingle, and whether it occurs in an item."""
        known, weight = self.vocabulary
        found = np.zeros(len(values), bool)
        out = np.full(len(values), self.rare, np.float32)
        some = np.flatnonzero(self.maybe[(values & U64((1 << 22) - 1)).astype(np.int64)])
        if len(some) and len(known):
            at = np.minimum(np.searchsorted(known, values[some]), len(known) - 1)
            hit = known[at] == values[some]
            found[some[hit]] = self.inside[at[hit]]
            out[some[hit]] = weight[at[hit]]
        return out, found

    @cached_property
    def by_length(self) -> dict[int, Index]:
        return {int(n): Index(self, np.flatnonzero(self.lengths == n)) for n in np.unique(self.lengths)}


class Index:
    """Items of one length: fingerprints in four tables by 16 bits each."""

    def __init__(self, items: Items, members: np.ndarray):
        self.members = members
        hashes = np.stack([items.shingles[i] for i in members])
        weights = items.weights(hashes.reshape(-1))[0].reshape(hashes.shape)
        self.lightest = float(weights.sum(axis=1).min())
        self.prints = simhash(hashes, weights)
        self.near = items.radius // INDEXES
        self.tables = []
        for b in range(INDEXES):
            part = self._part(self.prints, b)
            order = np.argsort(part, kind="stable")
            values, first = np.unique(part[order], return_index=True)
            self.tables.append((order, values, np.append(first, len(order))))

    @cached_property
    def flips(self) -> np.ndarray:
        """All differences of a 16-bit value to those near it."""
        return np.array([sum(1 << i for i in c) for r in range(self.near + 1) for c in combinations(range(WIDTH), r)], np.int64)

    def _near(self, part: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (window, place in ``values``) that differ in few bits: by comparing all, or by looking up all near values where these are fewer."""
        if len(values) <= sum(math.comb(WIDTH, r) for r in range(self.near + 1)):
            return np.nonzero(np.bitwise_count(part[:, None] ^ values) <= self.near)
        wanted = part[:, None] ^ self.flips
        at = np.minimum(np.searchsorted(values, wanted), len(values) - 1)
        window, flip = np.nonzero(values[at] == wanted)
        return window, at[window, flip]

    @staticmethod
    def _part(prints: np.ndarray, b: int) -> np.ndarray:
        return ((prints >> U64(b * WIDTH)) & U64((1 << WIDTH) - 1)).astype(np.int64)

    def search(self, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs (window, item, distance) with a distance of at most ``radius``, each once."""
        pairs = []
        for b, (order, values, first) in enumerate(self.tables):
            for some in range(0, len(prints), 256):
                window, at = self._near(self._part(prints[some : some + 256], b), values)
                n = first[at + 1] - first[at]
                place = np.repeat(first[at], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                pairs.append((np.repeat(window + some, n), order[place]))
        window, item = (np.concatenate(x) for x in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 2
        both = np.unique(np.stack([window, item], axis=1).reshape(-1, 2), axis=0)
        distance = np.bitwise_count(prints[both[:, 0]] ^ self.prints[both[:, 1]])
        keep = distance <= radius
        return both[keep, 0], self.members[both[keep, 1]], distance[keep]


def weighted_similarity(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Weighted Jaccard similarity of two shingle multisets; equal shingles have equal weights."""
    values, which = np.unique(np.concatenate([a, b]), return_inverse=True)
    weight = np.zeros(len(values))
    weight[which] = np.concatenate([wa, wb])
    left = np.bincount(which[: len(a)], minlength=len(values))
    right = np.bincount(which[len(a) :], minlength=len(values))
    return float((np.minimum(left, right) * weight).sum() / (np.maximum(left, right) * weight).sum())


def _row_leaks(items: Items, words, shingles: np.ndarray, weight: np.ndarray, found: np.ndarray) -> list[dict]:
    """Best place of every item in one document, given the document's word shingles in order."""
    best: dict[int, dict] = {}
    known, total = (np.concatenate([[0], np.cumsum(x, dtype=np.float64)]) for x in (weight * found, weight))
    n_words = len(words)
    for length, index in items.by_length.items():
        start, features = _windows(items, index, length, n_words, known, total)
        if not len(start):
            continue
        at = start[:, None] + np.arange(features)
        for window, item, distance in zip(*index.search(simhash(shingles[at], weight[at]), items.radius)):
            own, other = at[window], items.shingles[item]
            s = weighted_similarity(shingles[own], weight[own], other, items.weights(other)[0])
            old = best.get(item)
            if s >= items.least and (old is None or s > old["similarity"]):
                best[item] = {"item_id": items.ids[item], "first_word": int(start[window]), "n_words": length, "distance": int(distance), "similarity": s}
    return [best[i] for i in sorted(best)]


def _windows(items: Items, index: Index, length: int, n_words: int, known: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, int]:
    """Starts of the windows of a text that can reach the threshold, and their shingles; from running weights of item shingles and of all."""
    features = max(1, length - items.k + 1)
    if length > n_words or len(known) - 1 < features or length < items.k <= n_words:
        return np.zeros(0, np.int64), features
    inside = known[features:] - known[:-features]
    need = items.least * np.maximum(total[features:] - total[:-features], index.lightest)
    return np.flatnonzero(inside >= need * (1 - 1e-6)), features


def _short_items(items: Items, words_hash: np.ndarray, row_leaks: list[dict]) -> list[dict]:
    """Items of fewer than k words, which are one shingle: found where all their words stand in a row."""
    from tradewind.llm.arrays import mix, prefix_sums, span_hashes

    sums = prefix_sums(mix(words_hash))
    for i in np.flatnonzero(items.lengths < items.k):
        n = int(items.lengths[i])
        if len(words_hash) < items.k or n > len(words_hash):
            continue  # a document this short is itself one shingle, compared above
        start = np.arange(len(words_hash) - n + 1)
        same = np.flatnonzero(span_hashes(sums, start, start + n) + mix(np.array([n], U64)) == items.shingles[i][0])
        if len(same):
            row_leaks.append({"item_id": items.ids[i], "first_word": int(same[0]), "n_words": n, "distance": 0, "similarity": 1.0})
    return row_leaks


def leaks(text: Column, items: Items) -> Column:
    """Array of the items that stand in a text: the best place of each, its fingerprint distance and similarity."""

    @F.arrow_udf(LEAKS)
    def run(column: pa.Array) -> pa.Array:
        out: list[list[dict]] = []
        has_short = bool((items.lengths < items.k).any())
        for part in blocks(column):
            words = part.words(lower=True)
            values, row = shingle_hashes(words, items.k)
            weight, found = items.weights(values)
            edges = np.searchsorted(row, np.arange(part.rows + 1))
            hits = np.concatenate([[0], np.cumsum(found)])[edges]
            for i in range(part.rows):
                own = slice(edges[i], edges[i + 1])
                hashes = words.hash[words.first[i] : words.first[i + 1]]
                got = _row_leaks(items, hashes, values[own], weight[own], found[own]) if hits[i + 1] > hits[i] else []
                out.append(_short_items(items, hashes, got) if has_short else got)
        return pa.array(out, pa.list_(_LEAK))

    return run.asNondeterministic()(text)


def _possible(items: Items):
    """Texts that could hold an item of the block if every shingle of no item in it weighed 1, the least weight there is.

    With the shingles in such windows that are unknown to the block; texts that hold no window and no short item are left out.
    """
    schema = pa.schema([("row", pa.int64()), ("text", pa.string()), ("unknown", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        has_short = bool((items.lengths < items.k).any())
        for batch in batches:
            rows = []
            ids, texts = batch.column(0), batch.column(1)
            for part in blocks(texts):
                words = part.words(lower=True)
                values, row = shingle_hashes(words, items.k)
                weight, found = items.weights(values)
                weight = np.where(found, weight, np.float32(1))
                edges = np.searchsorted(row, np.arange(part.rows + 1))
                hits = np.concatenate([[0], np.cumsum(found)])[edges]
                for i in range(part.rows):
                    own = slice(edges[i], edges[i + 1])
                    hashes = words.hash[words.first[i] : words.first[i + 1]]
                    marks = np.zeros(edges[i + 1] - edges[i] + 1, np.int64)
                    if hits[i + 1] > hits[i]:
                        known, total = (np.concatenate([[0], np.cumsum(x, dtype=np.float64)]) for x in (weight[own] * found[own], weight[own]))
                        for length, index in items.by_length.items():
                            start, features = _windows(items, index, length, len(hashes), known, total)
                            np.add.at(marks, start, 1)
                            np.add.at(marks, start + features, -1)
                    covered = np.cumsum(marks)[:-1] > 0
                    if covered.any() or has_short and _short_items(items, hashes, []):
                        unknown = np.unique(values[own][covered & ~found[own]])
                        rows.append((ids[part.first + i].as_py(), texts[part.first + i].as_py(), unknown.view(np.int64).tolist()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return run, "row long, text string, unknown array<long>"


def _item_shingles(k: int):
    """Distinct shingles of each item; the shingle is null in one more row of each item that has words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in blocks(batch.column(1)):
                values, row = unique_by_row(*shingle_hashes(text.words(lower=True), k))
                block = batch.column(0).slice(text.first, text.rows)
                full = np.unique(row)
                at = pa.array(np.concatenate([row, full]).astype(np.int64))
                shingle = pa.array([*values.view(np.int64).tolist(), *[None] * len(full)], pa.int64())
                yield pa.RecordBatch.from_arrays([block.take(at), shingle], names=["block", "shingle"])

    return run, "block int, shingle long"


def _counted(table: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Rows (shingle, n) as arrays, sorted by the unsigned shingle."""
    got = table.select("shingle", "n").toArrow()
    values, n = (got.column(c).to_numpy().astype(np.int64) for c in ("shingle", "n"))
    order = np.argsort(values.view(U64), kind="stable")
    return values.view(U64)[order], n[order]


def _rows_of(table: DataFrame) -> list[tuple[int, str]]:
    return sorted((r["item_id"], r["text"]) for r in table.collect())


def _leaks_by_block(texts: DataFrame, rows: DataFrame, n: int, k: int, least: float, radius: int) -> DataFrame:
    """Rows (row, leaks) of the texts that hold an item, one for each block that has any; ``texts`` is (row, text), written.

    One block is on the driver at a time, with its share of the frequencies; each block's hits are written before the next starts.
    """
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "items")
    rows = rows.select("item_id", "text", F.pmod(F.xxhash64("row"), F.lit(n)).cast("int").alias("block"))
    run, schema = _item_shingles(k)
    shingles = written(rows.select("block", "text").mapInArrow(run, schema), "item-shingles")
    total = shingles.where(F.col("shingle").isNull()).count()
    counts = written(shingles.where(F.col("shingle").isNotNull()).groupBy("shingle").agg(F.count(F.lit(1)).alias("n")), "frequencies")
    parts = []
    for b in range(n):
        items = Items.of(_rows_of(rows.where(F.col("block") == b)), k, least, radius)
        if not items.ids:
            continue
        own = shingles.where((F.col("block") == b) & F.col("shingle").isNotNull()).select("shingle").distinct()
        items.total, items.counts = total, _counted(counts.join(own, "shingle"))
        run, schema = _possible(items)
        possible = written(texts.mapInArrow(run, schema), "possible")
        # A shingle of one item weighs as much as one of none.
        more = possible.select(F.explode("unknown").alias("shingle")).distinct()
        values, seen = _counted(counts.where("n > 1").join(more, "shingle"))
        both, at = np.unique(np.concatenate([items.counts[0], values]), return_index=True)
        exact = Items(items.ids, items.shingles, items.lengths, k, least, radius, total, (both, np.concatenate([items.counts[1], seen])[at]))
        hits = possible.select("row", leaks(F.col("text"), exact).alias("leaks"))
        parts.append(written(hits.where(F.size("leaks") > 0), "leaks"))
    out = texts.sparkSession.createDataFrame([], f"row long, leaks {LEAKS}")
    for part in parts:
        out = out.union(part)
    return out


def _with_leaks(docs: DataFrame, benchmark: DataFrame, name: str, k: int = 5, least: float = 0.8, radius: int = 19, clean: bool = False) -> DataFrame:
    """``docs`` with the leaks of each text; with ``clean``, only rows that have none.

    Null and blank items match nothing; a repeated item is found under each of its ids.
    """
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    rows = rows.where(F.col("item_id").isNotNull() & F.col("text").isNotNull())
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    n = max(1, -(-size["n"] // BLOCK_ITEMS), -(-(size["b"] or 0) // BLOCK_BYTES))
    if n == 1:
        items = Items.of(_rows_of(rows), k, least, radius)
        found = docs.withColumn(name, leaks(F.col("text").cast("string"), items) if items.ids else F.array().cast(LEAKS))
        return found.where(F.size(name) == 0) if clean else found
    row = f"{name}row"
    docs = written(docs.withColumn(row, F.monotonically_increasing_id()), "texts")
    hits = _leaks_by_block(docs.select(F.col(row).alias("row"), F.col("text").cast("string").alias("text")), rows, n, k, least, radius)
    hits = hits.select(F.col("row").alias(row), F.col("leaks").alias(name))
    if clean:
        return docs.join(hits.select(row).distinct(), row, "left_anti")
    return docs.join(hits, row).drop(row)


def contaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """Rows (doc_id, item_id, first_word, n_words, distance, similarity): each item found in each document, at its best place.

    Two window and item shingle multisets match from a weighted Jaccard similarity of ``least`` (0.8) on. A null or blank text
    has no match; a document shorter than an item cannot hold it; of equally good places the first counts. Repeated rows give
    repeated results, extra columns are ignored, an empty table on either side gives no rows.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = _with_leaks(texts, benchmark, "leaks", **how)
    return found.select("doc_id", F.inline("leaks"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The rows of ``docs``, unchanged, in which no benchmark item is found."""
    name = "_leaks_"
    while any(c.startswith(name) for c in docs.columns):
        name += "_"
    return _with_leaks(docs, benchmark, name, clean=True, **how).select(*[F.col(f"`{c}`") for c in docs.columns])
