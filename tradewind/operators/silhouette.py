"""Euclidean silhouette: bounds on sums of distances first, pairs only where the bounds do not decide.

The points of each cluster fall into cells around shared pivots. For a cell with weight n, centre c and mean squared distance v to it, the
distances from any x add up to at least n |x - c| (a mean of norms is no less than the norm of the mean) and at most n sqrt(|x - c|^2 + v).
Summed over the cells of a cluster these bound a row's mean distance to it, in one pass and without a pair. They tell which cluster is the
nearest other one, and often which of several clusterings has the largest silhouette. What they leave open is summed
exactly, over blocks of rows and of the one or two clusters that each row still needs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.operators.kmeans import SEED, starting_candidates
from tradewind.session import materialize, workers_find_package

#: Pivots drawn a round; more of them make narrower bounds.
PIVOTS = 128
BLOCK_ROWS = 4096
_CHUNK = 1024

#: Labels of a chunk under each clustering: points and given labels to {clustering: labels}.
Labeller = Callable[[np.ndarray, np.ndarray], dict[int, np.ndarray]]


def _squares(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances, without the cancellation of the usual expansion."""
    out = np.zeros((len(x), len(centers)))
    for a, b in zip(x.T, centers.T):
        out += (a[:, None] - b) ** 2
    return out


@dataclass
class Cells:
    """The cells of one clustering: centre, mean squared distance to it, weight, and the place of its cluster in ``labels``."""

    labels: np.ndarray
    centers: np.ndarray
    spread: np.ndarray
    weight: np.ndarray
    owner: np.ndarray

    def sizes(self) -> np.ndarray:
        return np.bincount(self.owner, self.weight, len(self.labels))

    def bounds(self, x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest mean distance of each point to each cluster; to its own one without itself."""
        squares = _squares(x, self.centers)
        member = (self.owner[:, None] == np.arange(len(self.labels))).astype(float) * self.weight[:, None]
        count = np.broadcast_to(self.sizes(), (len(x), len(self.labels))).copy()
        count[np.arange(len(x)), own] -= 1
        count[count <= 0] = np.nan
        return (np.sqrt(squares) @ member) / count, (np.sqrt(squares + self.spread) @ member) / count


def _values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(b - a) / max(a, b); 0 for a row that is alone in its cluster or where all distances are 0."""
    largest = np.maximum(a, b)
    return np.divide(b - a, largest, out=np.zeros(len(a)), where=~np.isnan(a) & (largest > 0))


def _judged(cells: Cells, x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bounds of each point's silhouette, whether each other cluster may be its nearest, and whether it has cluster mates."""
    low, high = cells.bounds(x, own)
    rows = np.arange(len(x))
    a_low, a_high = low[rows, own], high[rows, own]
    low[rows, own] = high[rows, own] = np.inf
    least = high.min(axis=1)
    return _values(a_high, low.min(axis=1)), _values(a_low, least), low <= least[:, None], ~np.isnan(a_low)


def _chunks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Columns (id, x, weight, label) in chunks."""
    for batch in batches:
        ids, w, labels = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2, 3))
        x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
        for i in range(0, len(x), _CHUNK):
            yield ids[i : i + _CHUNK], x[i : i + _CHUNK], w[i : i + _CHUNK], labels[i : i + _CHUNK]


def _cells(points: DataFrame, pivots: np.ndarray, labeller: Labeller) -> dict[int, Cells]:
    """Cells of every clustering in one job. What reaches the driver is at most a row for each clustering, cluster and pivot."""
    d = pivots.shape[1]
    names = ["n", "squares", *[f"s{i}" for i in range(d)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Sums are taken around the pivots, so that cells far from the origin lose no digits.
        for _, x, w, given in _chunks(batches, d):
            cell = _squares(x, pivots).argmin(axis=1)
            off = x - pivots[cell]
            columns = np.stack([w, w * (off * off).sum(axis=1), *(off * w[:, None]).T], axis=1)
            for model, label in labeller(x, given).items():
                keys, at = np.unique(np.stack([label, cell], axis=1), axis=0, return_inverse=True)
                sums = np.stack([np.bincount(at.ravel(), c, len(keys)) for c in columns.T], axis=1)
                whole = [pa.array(np.full(len(keys), model)), pa.array(keys[:, 0].astype(np.int64)), pa.array(keys[:, 1].astype(np.int64))]
                yield pa.RecordBatch.from_arrays([*whole, *[pa.array(c) for c in sums.T]], names=["model", "label", "cell", *names])

    schema = "model long, label long, cell long, " + ", ".join(f"{c} double" for c in names)
    summed = points.mapInArrow(run, schema).groupBy("model", "label", "cell").agg(*[F.sum(c).alias(c) for c in names])
    rows = np.array([tuple(r) for r in summed.orderBy("model", "label", "cell").collect()], float).reshape(-1, d + 5)
    out = {}
    for model in np.unique(rows[:, 0]):
        own = rows[rows[:, 0] == model]
        labels, owner = np.unique(own[:, 1].astype(np.int64), return_inverse=True)
        mean = own[:, 5:] / own[:, 3:4]
        spread = np.maximum(own[:, 4] / own[:, 3] - (mean**2).sum(axis=1), 0)
        out[int(model)] = Cells(labels, pivots[own[:, 2].astype(int)] + mean, spread, own[:, 3], owner)
    return out


def _given(_: np.ndarray, labels: np.ndarray) -> dict[int, np.ndarray]:
    return {0: labels}


def _points(df: DataFrame, features: str, label: str, weight: str | None) -> DataFrame:
    """Distinct labelled vectors (id, x, weight, label), written once."""
    count = F.col(weight).cast("double") if weight else F.lit(1.0)
    vectors = df.select(F.col(features).cast("array<double>").alias("x"), count.alias("weight"), F.col(label).cast("long").alias("label"))
    counted = vectors.groupBy("x", "label").agg(F.sum("weight").alias("weight"))
    return materialize(counted.select(F.monotonically_increasing_id().alias("id"), "x", "weight", "label"), "labelled")


def _pivots(points: DataFrame, seed: int) -> np.ndarray | None:
    first = points.select(F.size("x").alias("d")).first()
    return None if first is None else starting_candidates(points.select("x", "weight"), PIVOTS, first["d"], seed)


@dataclass
class Silhouette:
    """Mean silhouette (None without rows or with fewer than two clusters), and how many pairs of vectors it took of how many there are."""

    value: float | None
    pairs: int
    all_pairs: int


def measure(df: DataFrame, features: str, label: str, weight: str | None = None, tolerance: float = 1e-7, block_rows: int = BLOCK_ROWS, seed: int = SEED) -> Silhouette:
    """Mean Euclidean silhouette to within ``tolerance``.

    ``weight`` is the number of rows that a row stands for. A row whose bounds differ by at most twice the tolerance takes their middle and
    forms no pair; with a tolerance of 0 every row is summed exactly. The number of clusters has to fit on the driver.
    """
    workers_find_package(df.sparkSession)
    points = _points(df, features, label, weight)
    pivots = _pivots(points, seed)
    if pivots is None:
        return Silhouette(None, 0, 0)
    d = pivots.shape[1]
    cells = _cells(points, pivots, _given)[0]
    counts = {r["label"]: r["n"] for r in points.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = sum(counts.values())
    if len(cells.labels) < 2:
        return Silhouette(None, 0, n * n)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x, w, given in _chunks(batches, d):
            own = np.searchsorted(cells.labels, given)
            low, high, open_, mates = _judged(cells, x, own)
            open_[np.arange(len(x)), own] = True
            open_[(high - low <= 2 * tolerance) | ~mates] = False
            row, cluster = np.nonzero(open_)
            ends = np.concatenate([[0], np.cumsum(open_.sum(axis=1))]).astype(np.int32)
            needs = pa.ListArray.from_arrays(pa.array(ends), pa.array(cluster.astype(np.int32)))
            vectors = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * d), pa.array(x.ravel()))
            columns = [pa.array(ids), pa.array(w), pa.array(own.astype(np.int32)), vectors, needs, pa.array((low + high) / 2)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "weight", "own", "x", "needs", "s"])

    judged = materialize(points.mapInArrow(judge, "id long, weight double, own int, x array<double>, needs array<int>, s double"), "bounds")
    settled = judged.where(F.size("needs") == 0).select("weight", "s")
    needed = judged.where(F.size("needs") > 0).select("id", "weight", "own", "x", F.explode("needs").alias("c"))
    open_counts = {r["c"]: r["n"] for r in needed.groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()}
    pairs = sum(m * counts[int(cells.labels[c])] for c, m in open_counts.items())
    if open_counts:
        settled = settled.unionByName(_exact(needed, judged, cells, open_counts, counts, block_rows))
    total, mass = settled.agg(F.sum(F.col("weight") * F.col("s")), F.sum("weight")).first()
    return Silhouette(total / mass, pairs, n * n)


def _exact(needed: DataFrame, judged: DataFrame, cells: Cells, open_counts: dict[int, int], counts: dict[int, int], block_rows: int) -> DataFrame:
    """Rows (weight, s) of the rows that need sums over whole clusters.

    Those who need a cluster, and its members, are hashed into blocks of bounded size; each pair of blocks is a task that returns one sum a row.
    """
    k = len(cells.labels)
    blocks = lambda sizes: F.array(*[F.lit(max(1, math.ceil(sizes.get(c, 0) / block_rows))) for c in range(k)])
    asking, members = blocks(open_counts), blocks({c: counts[int(label)] for c, label in enumerate(cells.labels)})
    of = lambda table, c: F.get(table, F.col(c))
    slot = lambda table, c: F.pmod(F.xxhash64("id"), of(table, c)).cast("int")
    every = lambda table, c: F.explode(F.sequence(F.lit(0), of(table, c) - 1))
    left = needed.select("c", slot(asking, "c").alias("i"), every(members, "c").alias("j"), "id", "x")
    right = judged.where(F.col("own").isin(list(open_counts))).select(
        F.col("own").alias("c"), every(asking, "own").alias("i"), slot(members, "own").alias("j"), F.col("x").alias("y"), F.col("weight").alias("w")
    )
    keys = ["c", "i", "j"]
    sums = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_sums, "id long, c int, total double")
    sums = sums.groupBy("id", "c").agg(F.sum("total").alias("total"))
    sizes = F.array(*[F.lit(float(s)) for s in cells.sizes()])
    is_own = F.col("c") == F.col("own")
    mean = F.col("total") / (of(sizes, "c") - is_own.cast("double"))
    rows = needed.select("id", "weight", "own").distinct().join(sums, "id").groupBy("id", "weight").agg(
        F.max(F.when(is_own, mean)).alias("a"), F.min(F.when(~is_own, mean)).alias("b")
    )
    largest = F.greatest("a", "b")
    return rows.select("weight", F.when(largest > 0, (F.col("b") - F.col("a")) / largest).otherwise(F.lit(0.0)).alias("s"))


def _sums(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    if left.empty or right.empty:
        return pd.DataFrame({"id": pd.Series(dtype="int64"), "c": pd.Series(dtype="int32"), "total": pd.Series(dtype="float64")})
    y, w = np.stack(right["y"].to_numpy()), right["w"].to_numpy()
    x = np.stack(left["x"].to_numpy())
    totals = np.concatenate([np.sqrt(_squares(x[i : i + _CHUNK], y)) @ w for i in range(0, len(x), _CHUNK)])
    return pd.DataFrame({"id": left["id"].to_numpy(), "c": left["c"].to_numpy(), "total": totals})


def silhouette(df: DataFrame, features: str, label: str, weight: str | None = None, tolerance: float = 1e-7) -> DataFrame:
    """One row with the mean Euclidean silhouette, see :func:`measure`."""
    found = measure(df, features, label, weight, tolerance)
    return df.sparkSession.createDataFrame([(found.value,)], "silhouette double")


def bounds_of_models(points: DataFrame, models: dict[int, list[list[float]]], seed: int = SEED) -> dict[int, tuple[float, float]]:
    """Least and greatest mean silhouette of several clusterings by nearest centroid, in two passes over ``points`` (x, weight)."""
    workers_find_package(points.sparkSession)
    rows = points.select(F.lit(0).cast("long").alias("id"), "x", "weight", F.lit(0).cast("long").alias("label"))
    pivots = _pivots(rows, seed)
    if pivots is None:
        return {}
    d = pivots.shape[1]
    centers = {m: np.array(c) for m, c in models.items()}

    def nearest(x: np.ndarray, _: np.ndarray) -> dict[int, np.ndarray]:
        return {m: _squares(x, c).argmin(axis=1) for m, c in centers.items()}

    cells = {m: c for m, c in _cells(rows, pivots, nearest).items() if len(c.labels) > 1}

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {m: np.zeros(3) for m in cells}
        for _, x, w, given in _chunks(batches, d):
            labels = nearest(x, given)
            for m, c in cells.items():
                low, high, _, _ = _judged(c, x, np.searchsorted(c.labels, labels[m]))
                totals[m] += [(w * low).sum(), (w * high).sum(), w.sum()]
        columns = zip(*[(m, *t) for m, t in totals.items()]) if totals else [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64(), *[pa.float64()] * 3])], names=["model", "low", "high", "n"])

    summed = rows.mapInArrow(judge, "model long, low double, high double, n double").groupBy("model").agg(*[F.sum(c).alias(c) for c in ("low", "high", "n")])
    return {r["model"]: (r["low"] / r["n"], r["high"] / r["n"]) for r in summed.collect() if r["n"]}
