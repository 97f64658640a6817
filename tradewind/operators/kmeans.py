"""k-means for several cluster numbers and starts at once.

All models that are not settled advance together: one job per iteration reads the
points once, each task assigns its points under every model, and returns one
row of sums per (model, cluster). Points stay spread as they are stored, and only
those sums reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.session import materialize, workers_find_package

# Seed, restarts and iterations of k-means.
SEED = 42
RESTARTS = 10
MAX_ITERATIONS = 300

#: A model is settled when the squared moves of its centroids add up to at most this share of the mean variance.
TOLERANCE = 1e-4
#: Rounds in which starting candidates are drawn, and how many a round for each cluster of each start.
ROUNDS = 5
OVERSAMPLING = 2
_CHUNK = 4096


@dataclass
class KMeansFit:
    """Centroids in ascending order, and the sum of squared distances to the nearest one."""

    centroids: list[list[float]]
    inertia: float


def weighted_points(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct vectors ``x`` with their number of rows ``weight``, written once.

    Fitting on them gives the same objective as fitting on all rows, and reads
    each repeated vector once per iteration.
    """
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).cast("double").alias("weight"))
    return materialize(counted.select(F.array(*[F.col(c).cast("double") for c in columns]).alias("x"), "weight"), "vectors")


def _plus_plus(points: np.ndarray, weight: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Starting centroids: each next one drawn by weight times squared distance to those before."""
    chosen = [points[rng.choice(len(points), p=weight / weight.sum())]]
    nearest = ((points - chosen[0]) ** 2).sum(axis=1)
    for _ in range(1, min(k, len(points))):
        share = weight * nearest
        total = share.sum()
        at = rng.choice(len(points), p=share / total) if total > 0 else rng.integers(len(points))
        chosen.append(points[at])
        nearest = np.minimum(nearest, ((points - chosen[-1]) ** 2).sum(axis=1))
    return np.stack(chosen)


def _vectors(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Points and weights in chunks that keep distance tables small."""
    for batch in batches:
        x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
        w = batch.column(1).to_numpy(zero_copy_only=False)
        for i in range(0, len(x), _CHUNK):
            yield x[i : i + _CHUNK], w[i : i + _CHUNK]


def _distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances (points, centers)."""
    table = (x * x).sum(axis=1)[:, None] - 2 * (x @ centers.T) + (centers * centers).sum(axis=1)
    return np.maximum(table, 0, out=table)


def uniform(x: np.ndarray, salt: int) -> np.ndarray:
    """A number in (0, 1) for each vector that depends on its values and the salt only."""
    h = np.full(len(x), salt + 1, np.uint64)
    with np.errstate(over="ignore"):
        for column in (x + 0.0).T:
            h = (h ^ np.ascontiguousarray(column).view(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
            h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(32)
    return ((h >> np.uint64(12)).astype(np.float64) + 0.5) / (1 << 52)


def _draw(candidates: np.ndarray, size: int, d: int, salt: int):
    """Each task's ``size`` winners of a race in which a point's speed is its weight times its squared distance to the candidates.

    The winners of all tasks together are a weighted sample without replacement; no total has to be known before.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, points = np.zeros(0), np.zeros((0, d))
        for x, w in _vectors(batches, d):
            share = w
            if len(candidates):
                nearest = _distances(x, candidates).min(axis=1)
                # Rounding leaves small distances between equal vectors.
                share = w * np.where(nearest > 1e-14 * (1 + (x * x).sum(axis=1)), nearest, 0)
            some = np.flatnonzero(share > 0)
            time = -np.log(uniform(x[some], salt)) / share[some]
            best, points = np.concatenate([best, time]), np.concatenate([points, x[some]])
            if len(best) > size:
                first = np.argpartition(best, size - 1)[:size]
                best, points = best[first], points[first]
        x = pa.ListArray.from_arrays(pa.array(np.arange(len(best) + 1, dtype=np.int32) * d), pa.array(points.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(best), x], names=["time", "x"])

    return run, "time double, x array<double>"


def starting_candidates(points: DataFrame, size: int, d: int, seed: int) -> np.ndarray:
    """About ``ROUNDS`` times ``size`` vectors that lie near all points: the first drawn by weight, later ones by distance to those before.

    Every round reads all points once, and ``size`` vectors reach the driver. Vectors are drawn by a hash of their values, so neither the
    number of points nor their partitioning changes the procedure; fewer distinct vectors than wanted are all taken.
    """
    candidates = np.zeros((0, d))
    for i in range(ROUNDS):
        run, schema = _draw(candidates, size, d, seed * 1000 + i)
        drawn = points.mapInArrow(run, schema).orderBy("time", "x").limit(size).collect()
        if not drawn:
            break
        candidates = np.concatenate([candidates, np.array([r["x"] for r in drawn])])
    return candidates


def _sums(models: dict[int, np.ndarray], d: int):
    schema = pa.schema(
        [("model", pa.int32()), ("cluster", pa.int32()), ("n", pa.float64()), ("cost", pa.float64())]
        + [(f"s{i}", pa.float64()) for i in range(d)]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {m: np.zeros((len(c), d + 2)) for m, c in models.items()}
        for x, w in _vectors(batches, d):
            for m, c in models.items():
                distance = _distances(x, c)
                label = distance.argmin(axis=1)
                cost = distance[np.arange(len(x)), label]
                rows = np.concatenate([w[:, None], (w * cost)[:, None], x * w[:, None]], axis=1)
                for i in range(d + 2):
                    totals[m][:, i] += np.bincount(label, rows[:, i], len(c))
        rows = [(m, i, *total) for m, t in totals.items() for i, total in enumerate(t.tolist()) if total[0]]
        columns = list(zip(*rows)) or [()] * len(schema)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run, ", ".join(f"{f.name} {'int' if f.type == pa.int32() else 'double'}" for f in schema)


def _assigned(points: DataFrame, models: dict[int, np.ndarray], d: int) -> dict[int, np.ndarray]:
    """Per model the sums (cluster, [weight, cost, coordinates …]) of the points nearest to each centroid, in one job."""
    run, schema = _sums(models, d)
    names = ["n", "cost", *[f"s{i}" for i in range(d)]]
    sums = points.mapInArrow(run, schema).groupBy("model", "cluster").agg(*[F.sum(c).alias(c) for c in names])
    out = {m: np.zeros((len(c), d + 2)) for m, c in models.items()}
    for r in sums.collect():
        out[r["model"]][r["cluster"]] = [r[c] for c in names]
    return out


def _moved(centers: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Mean of each cluster's points; a cluster without points stays."""
    after = centers.copy()
    full = sums[:, 0] > 0
    after[full] = sums[full, 2:] / sums[full, :1]
    return after


def _settle(x: np.ndarray, w: np.ndarray, centers: np.ndarray, least: float) -> np.ndarray:
    """Iterations over the candidates alone, on the driver, so that few over all points are left."""
    for _ in range(MAX_ITERATIONS):
        label = _distances(x, centers).argmin(axis=1)
        sums = np.stack([np.bincount(label, v, len(centers)) for v in [w, w, *(x * w[:, None]).T]], axis=1)
        after = _moved(centers, sums)
        move, centers = ((after - centers) ** 2).sum(), after
        if move <= least:
            break
    return centers


def fit_kmeans_all(points: DataFrame, numbers: list[int], restarts: int = RESTARTS, seed: int = SEED) -> dict[int, KMeansFit]:
    """Per cluster number, the best of several starts by inertia, on :func:`weighted_points`.

    The starts of all models come from one set of candidates drawn over all points (:func:`starting_candidates`) and weighted by the points
    nearest to each; every start is drawn from them and settled on them, which takes no job. A model is settled when the squared
    moves of its centroids add up to at most ``TOLERANCE`` times the mean variance. With fewer distinct vectors than clusters,
    there is one cluster per vector. No points, no models.
    """
    workers_find_package(points.sparkSession)
    first = points.select(F.size("x").alias("d")).first()
    if first is None:
        return {}
    d = first["d"]
    candidates = starting_candidates(points, OVERSAMPLING * max(numbers) * restarts, d, seed)
    near, around = (_assigned(points, {0: c}, d)[0] for c in (candidates, np.zeros((1, d))))
    weight = near[:, 0]
    n, squares = around[0, 0], around[0, 1]
    least = TOLERANCE * max(squares / n - ((around[0, 2:] / n) ** 2).sum(), 0) / d
    candidates, weight = candidates[weight > 0], weight[weight > 0]
    tasks = [(k, start) for k in numbers for start in range(restarts)]
    centers: dict[int, np.ndarray] = {}
    same: dict[tuple, int] = {}
    for i, (k, start) in enumerate(tasks):
        begun = _plus_plus(candidates, weight, k, np.random.default_rng([seed, k, start]))
        settled = _settle(candidates, weight, begun, least)
        # Starts that settle alike are one model.
        if same.setdefault((k, *np.round(np.sort(settled, axis=0), 6).ravel().tolist()), i) == i:
            centers[i] = settled
    moving = dict(centers)
    for _ in range(MAX_ITERATIONS):
        sums = _assigned(points, moving, d)
        after = {m: _moved(c, sums[m]) for m, c in moving.items()}
        centers.update(after)
        moving = {m: c for m, c in after.items() if ((c - moving[m]) ** 2).sum() > least}
        if not moving:
            break
    cost = {m: float(s[:, 1].sum()) for m, s in _assigned(points, centers, d).items()}
    best: dict[int, KMeansFit] = {}
    for i in centers:
        k = tasks[i][0]
        if k not in best or cost[i] < best[k].inertia:
            best[k] = KMeansFit(sorted(centers[i].tolist()), cost[i])
    return best


def fit_kmeans(points: DataFrame, k: int, restarts: int = RESTARTS, seed: int = SEED) -> KMeansFit:
    return fit_kmeans_all(points, [k], restarts, seed)[k]
