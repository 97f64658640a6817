"""MinHash near-duplicate groups: universal hash minima, banding, verification on full sets, star-contracted components.

1. Each document's distinct word shingles are reduced to minima under many universal hash functions.
2. Documents with equal sets are one class from here on, kept by a 128-bit digest of the set; copies cost nothing more.
3. Classes that share a band (some minima in a row) are joined to the band's least class, and the components of
   these candidate links are the groups inside which links can exist.
4. Groups are cut into blocks of bounded size by a hash, and each pair of blocks is one job that compares signatures
   first and full sets where signatures allow. A job returns only links that join parts not yet joined in it, never all
   links, so copies in thousands give thousands of rows.
5. Components of the confirmed links are the result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.arrays import U64, blocks, mix, shingle_hashes, unique_by_row, written
from tradewind.llm.components import components


class Plan:
    """How many minima: ``rows`` a band, and bands until a pair at the threshold is missed with probability ``miss``."""

    def __init__(self, percent: int, rows: int = 6, miss: float = 1e-6):
        self.percent, self.rows = percent, rows
        s = percent / 100
        self.bands = max(1, math.ceil(math.log(miss) / math.log(1 - s**rows))) if s < 1 else 1
        self.minima = self.rows * self.bands
        numbers = mix(np.arange(1, 2 * self.minima + 1, dtype=U64) + U64(7 << 32)).astype(np.uint32)
        self.factor, self.shift = numbers[: self.minima] | np.uint32(1), numbers[self.minima :]
        #: Signatures less alike than this belong to a pair below the threshold (five standard deviations).
        self.alike = s - 5 * math.sqrt(s * (1 - s) / self.minima)


def _minima(plan: Plan, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Least hash of each run of ``values`` under every function of the plan."""
    out = np.zeros((len(starts), plan.minima), np.uint32)
    small = (values >> U64(32)).astype(np.uint32)
    for i in range(plan.minima if len(starts) else 0):
        out[:, i] = np.minimum.reduceat(small * plan.factor[i] + plan.shift[i], starts)
    return out


def _binary(rows: int, sizes: np.ndarray, data: np.ndarray) -> pa.Array:
    offsets = np.zeros(rows + 1, np.int32)
    offsets[1:] = np.cumsum(sizes)
    return pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(offsets), pa.py_buffer(data.tobytes())])


def _signatures(plan: Plan, k: int):
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_a", pa.int64()), ("set_b", pa.int64()),
        ("bands", pa.list_(pa.int64())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in blocks(batch.column(1)):
                yield of(text, batch.column(0).slice(text.first, text.rows))

    def of(text, ids: pa.Array) -> pa.RecordBatch:
        values, row = unique_by_row(*shingle_hashes(text.words(lower=True), k))
        counts = np.bincount(row, minlength=text.rows)
        full = np.flatnonzero(counts)
        starts = np.concatenate([[0], np.cumsum(counts[full])[:-1]]).astype(np.int64)[: len(full)]
        digests = np.zeros((2, text.rows), U64)
        for i, salt in enumerate((0xA5A5, 0x5A5A5A)):
            if len(full):
                digests[i, full] = np.add.reduceat(mix(values ^ mix(np.array([salt]))), starts)
        minima = _minima(plan, values, starts)
        keys = np.zeros((len(full), plan.bands), U64)
        for b in range(plan.bands):
            key = np.full(len(full), b + 1, U64)
            for i in range(b * plan.rows, (b + 1) * plan.rows):
                key = mix(key ^ minima[:, i])
            keys[:, b] = key
        offsets = np.zeros(text.rows + 1, np.int32)
        offsets[1:] = np.cumsum(np.where(counts > 0, plan.bands, 0))
        return pa.RecordBatch.from_arrays(
            [
                ids.cast(pa.int64()), pa.array(counts.astype(np.int64)), pa.array(digests[0].view(np.int64)),
                pa.array(digests[1].view(np.int64)),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.reshape(-1).view(np.int64))),
            ],
            schema=schema,
        )

    return run, "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"


def _sets(plan: Plan, k: int):
    schema = pa.schema([("node", pa.int64()), ("grp", pa.int64()), ("parts", pa.int32()), ("minima", pa.binary()), ("shingles", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in blocks(batch.column(3)):
                values, row = unique_by_row(*shingle_hashes(text.words(lower=True), k))
                counts = np.bincount(row, minlength=text.rows)
                full = np.flatnonzero(counts)
                starts = np.concatenate([[0], np.cumsum(counts[full])[:-1]]).astype(np.int64)[: len(full)]
                low = (_minima(plan, values, starts) & np.uint32(255)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).slice(text.first, text.rows) for i in range(3)]
                    + [_binary(text.rows, (counts > 0) * plan.minima, low), _binary(text.rows, counts * 8, values)],
                    schema=schema,
                )

    return run, "node long, grp long, parts int, minima binary, shingles binary"


def _links(percent: int, alike: float):
    """Links of one job that join its parts; a job is one block with itself, or two blocks with each other."""

    def run(job: pd.DataFrame) -> pd.DataFrame:
        job = job.sort_values(["block", "node"], kind="stable")
        ids, side = job["node"].to_numpy(), (job["block"] != job["block"].iloc[0]).to_numpy()
        minima = np.stack([np.frombuffer(x, np.uint8) for x in job["minima"]])
        sets = [np.frombuffer(x, U64) for x in job["shingles"]]
        sizes = np.array([len(x) for x in sets])
        codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
        starts = np.concatenate([[0], np.cumsum(sizes)])
        root = list(range(len(ids)))
        part = np.arange(len(ids))
        mark = np.zeros(int(codes.max()) + 1 if len(codes) else 1, bool)
        two = bool(job["two"].iloc[0])
        out = []
        for i in range(len(ids) - 1):
            later = np.arange(i + 1, len(ids))
            ok = (part[later] != part[i]) & (100 * np.minimum(sizes[later], sizes[i]) >= percent * np.maximum(sizes[later], sizes[i]))
            if two:
                ok &= side[later] != side[i]
            later = later[ok]
            if len(later):
                later = later[(minima[later] == minima[i]).mean(axis=1) >= alike]
            if not len(later):
                continue
            mark[codes[starts[i] : starts[i + 1]]] = True
            for j in later:
                if part[j] == part[i]:
                    continue
                common = int(np.count_nonzero(mark[codes[starts[j] : starts[j + 1]]]))
                if 100 * common >= percent * (int(sizes[i]) + int(sizes[j]) - common):
                    out.append((ids[i], ids[j]))
                    part[part == part[j]] = part[i]
            mark[codes[starts[i] : starts[i + 1]]] = False
        return pd.DataFrame(out, columns=["u", "v"], dtype="int64")

    return run, "u long, v long"


def near_duplicate_groups(docs: DataFrame, percent: int = 80, k: int = 5, block: int = 512, rows: int = 6) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept), one per row of ``docs`` (columns doc_id and text).

    Two documents are linked when the Jaccard similarity of their distinct ``k``-word shingles (A-Z lower-cased) is at least ``percent``
    in a hundred; component_id is the least doc_id reachable over links, kept says that the document is that one.
    A null, empty or blank text has no shingles and is its own component. A row whose doc_id is null is linked with
    nothing and gets a null component and kept = false. Rows that repeat a doc_id are versions of one document
    and share its component. Other columns are ignored; an empty table gives no rows.
    """
    plan = Plan(percent, rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("_text"))
    run, schema = _signatures(plan, k)
    signed = written(texts.mapInArrow(run, schema), "signatures")

    same = ["set_a", "set_b", "n_shingles"]
    classes = signed.where("doc_id is not null and n_shingles > 0").groupBy(*same)
    classes = written(classes.agg(F.min("doc_id").alias("node"), F.min_by("bands", "doc_id").alias("bands")), "classes")

    banded = classes.select(F.explode("bands").alias("band"), F.col("node").alias("u"))
    stars = banded.groupBy("band").agg(F.min("u").alias("v"), F.max("u").alias("w")).where("v <> w").select("band", "v")
    candidates = components(banded.join(written(stars, "stars"), "band").where("u <> v").select("u", "v"))

    # Members of every group, its least class included, with the number of blocks the group is cut into.
    members = candidates.union(candidates.select(F.col("v").alias("u"), "v").distinct())
    sizes = members.groupBy("v").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("parts"))
    fetch = written(members.join(sizes, "v").select(F.col("u").alias("node"), F.col("v").alias("grp"), "parts"), "members")
    run, schema = _sets(plan, k)
    sets = texts.join(fetch, F.col("_id") == F.col("node")).select("node", "grp", "parts", "_text").mapInArrow(run, schema)
    placed = sets.withColumn("block", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    jobs = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "grp", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"),
        (F.col("block") != F.col("other")).alias("two"), "block", "node", "minima", "shingles",
    ).where(F.length("shingles") > 0)
    run, schema = _links(percent, plan.alike)
    found = components(jobs.groupBy("grp", "a", "b").applyInPandas(run, schema))

    least = classes.join(found.select(F.col("u").alias("node"), F.col("v").alias("least")), "node", "left").select(
        *same, F.coalesce("least", "node").alias("component_id")
    )
    linked = signed.where("n_shingles > 0").join(least, same, "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    )
    bare = signed.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.union(bare).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
