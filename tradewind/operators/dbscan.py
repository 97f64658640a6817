"""Density clustering.

Rows are dense when at least ``min_samples`` rows (themselves included) lie
within ``eps``. Dense rows within ``eps`` of each other share a cluster; other
rows join the first cluster that has a dense row within ``eps``, or are noise.

How the work is split:

* equal vectors are one point with a weight, so copies cost nothing;
* fine cells of side ``eps`` / sqrt(number of features) hold points that are all
  within ``eps`` of each other. A fine cell with ``min_samples`` rows is dense as
  a whole: its points are not counted and count as one node of the cluster graph;
* only the other points are counted, against coarse cells of side ``eps`` on the
  widest features and their neighbours, and only until they have ``min_samples``;
* inside a task points are halved to small boxes over all features, and compared
  with what lies within ``eps`` of their box;
* nodes (one point for each dense fine cell, and single dense points) are linked
  first. Only where a neighbourhood still holds several components are all of its
  dense points compared, and only across components;
* a cell with many points is split into blocks of bounded size, and a task sees
  one block of a cell beside one block of each neighbouring cell. Tasks return
  counts or links; pairs of points never leave them;
* links are joined to clusters by repeated star contraction, each round being
  written to the shared folder.
"""

from __future__ import annotations

import math
import sys
from functools import reduce
from itertools import product

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.operators.ranking import global_row_number
from tradewind.session import materialize

# Defaults of the method and of the segmentation run.
DEFAULT_EPS, DEFAULT_MIN_SAMPLES = 0.5, 5
RUN_EPS, RUN_MIN_SAMPLES = 0.8, 10

# Helpers of the task functions travel with them: tasks need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

GRID_FEATURES = 3
BLOCK_POINTS = 2000
#: Left points that are compared together with all right points near them.
LEAF_POINTS = 64
NOISE = -1


def dbscan(
    df: DataFrame,
    key: str,
    columns: list[str],
    eps: float = DEFAULT_EPS,
    min_samples: int = DEFAULT_MIN_SAMPLES,
    block_points: int = BLOCK_POINTS,
) -> DataFrame:
    """``key``, ``is_core`` and ``dbscan_cluster`` (0, 1, … by smallest core key; −1 for noise)."""
    points = _points(df, key, columns, eps, block_points)
    dense = F.col("fine_weight") >= min_samples
    counted = _neighbour_counts(points.where(~dense), points, eps, min_samples)
    core_flag = dense | F.coalesce(F.col("neighbours") >= min_samples, F.lit(False))
    flagged = points.join(counted, "vid", "left").withColumn("is_core", core_flag)
    flagged = materialize(flagged.withColumn("node", F.when(dense, F.col("fine_vid")).otherwise(F.col("vid"))), "core")
    core = flagged.where("is_core")

    near = connected_components(_core_links(core.where("vid = node"), flagged, eps)).select(
        F.col("vid").alias("node"), F.col("root").alias("part")
    )
    parts = materialize(core.join(near, "node", "left").withColumn("part", F.coalesce("part", "node")), "parts")
    joined = connected_components(_cross_links(parts, eps)).select(F.col("vid").alias("part"), "root")
    roots = parts.join(joined, "part", "left").select("vid", F.coalesce("root", "part").alias("root"))
    # A part's root is its least node, which may not be the least point of the cluster.
    smallest = roots.groupBy("root").agg(F.min("vid").alias("first"))
    numbers = global_row_number(smallest, ["first"], "number").select("root", (F.col("number") - 1).cast("int").alias("cluster"))
    labelled = materialize(roots.join(numbers, "root").select("vid", "cluster"), "clusters")
    border = _border_clusters(flagged, labelled, eps)
    clusters = labelled.unionByName(border)

    found = flagged.select("vid", "x", "is_core").join(clusters, "vid", "left")
    vector = F.array(*[F.col(c).cast("double") for c in columns])
    return df.select(key, vector.alias("x")).join(found, "x").select(
        key, "is_core", F.coalesce("cluster", F.lit(NOISE)).alias("dbscan_cluster")
    )


def _points(df: DataFrame, key: str, columns: list[str], eps: float, block_points: int) -> DataFrame:
    """Distinct vectors, numbered by their smallest key of any type, with weight, coarse cell, block, and fine cell's weight and first point."""
    vector = F.array(*[F.col(c).cast("double") for c in columns])
    points = df.groupBy(vector.alias("x")).agg(F.min(key).alias("_key"), F.count(F.lit(1)).alias("weight"))
    points = global_row_number(points, ["_key", "x"], "vid").drop("_key")
    ranges = df.agg(*[(F.max(c) - F.min(c)).cast("double").alias(c) for c in columns]).first()
    widest = sorted(range(len(columns)), key=lambda i: -(ranges[columns[i]] or 0.0))[:GRID_FEATURES]
    varying = [i for i in range(len(columns)) if ranges[columns[i]]]
    # Always three numbers, so that every cell has 27 neighbours; an unused one is 0.
    places = [F.floor(F.col("x")[i] / F.lit(eps)).cast("long") for i in widest]
    cell = F.array(*places, *[F.lit(0).cast("long")] * (GRID_FEATURES - len(places)))
    # A little less than the exact side, so that rounding cannot put two points further apart than eps into one cell.
    side = eps / math.sqrt(max(1, len(varying))) * (1 - 1e-9)
    fine = F.array(*[F.floor(F.col("x")[i] / F.lit(side)).cast("long") for i in varying]).cast("array<bigint>")
    points = materialize(points.withColumn("cell", cell).withColumn("fine", fine), "points")
    sizes = points.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / block_points).cast("int").alias("blocks"))
    inside = points.groupBy("fine").agg(F.sum("weight").alias("fine_weight"), F.min("vid").alias("fine_vid"))
    points = points.join(sizes, "cell").join(inside, "fine").drop("fine")
    return materialize(points.withColumn("block", F.pmod(F.xxhash64("vid"), F.col("blocks")).cast("int")), "points")


def _neighbouring(cell: Column) -> Column:
    offsets = [F.array(*[F.lit(o) for o in shift]) for shift in product((-1, 0, 1), repeat=GRID_FEATURES)]
    return F.array(*[F.zip_with(cell, shift, lambda a, b: a + b) for shift in offsets])


def _paired(left: DataFrame, right: DataFrame, everyone: DataFrame):
    """Group blocks of ``left`` with the blocks of ``right`` in neighbouring cells.

    A group is (cell, block of the cell, block number on the right), so both of
    its sides have a bounded number of points.
    """
    cells = everyone.groupBy("cell").agg(F.max("blocks").alias("blocks"))
    around = cells.select(
        F.col("cell").alias("home"), F.col("blocks").alias("home_blocks"),
        F.explode(_neighbouring(F.col("cell"))).alias("cell"),
    ).join(cells, "cell")
    # Cells are few compared with points: one row per non-empty cell and neighbour.
    reach = around.groupBy("home").agg(F.max("blocks").alias("reach")).withColumnRenamed("home", "cell")
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    a = left.join(reach, "cell").select(
        F.col("cell").alias("home"), F.col("block").alias("home_block"), numbers("reach").alias("other"), *_carried(left)
    )
    b = right.drop("blocks").join(around.drop("blocks"), "cell").select(
        F.col("home").alias("home"), numbers("home_blocks").alias("home_block"), F.col("block").alias("other"), *_carried(right)
    )
    keys = ["home", "home_block", "other"]
    return a.groupBy(*keys).cogroup(b.groupBy(*keys))


def _carried(df: DataFrame) -> list[Column]:
    """Columns a task needs, renamed to themselves so that both sides of a group differ."""
    return [F.col(c).alias(c) for c in ("vid", "x", "weight", "cluster", "part") if c in df.columns]


def _within(a: np.ndarray, b: np.ndarray, eps: float) -> np.ndarray:
    d2 = np.zeros((len(a), len(b)))
    for i in range(a.shape[1]):
        d2 += (a[:, i, None] - b[None, :, i]) ** 2
    return d2 <= eps * eps


def _vectors(df: pd.DataFrame) -> np.ndarray:
    return np.stack(df["x"].to_numpy())


def _leaves(a: np.ndarray, b: np.ndarray, eps: float):
    """Places of a few left points each, with those of the right points that may be within ``eps`` of one of them.

    The left side is halved at the middle of its widest feature until few points are left; right points further than ``eps`` from the box
    around a half are out for all of it. Every pair within ``eps`` is in exactly one leaf. A point with a value that is no number is near none.
    """
    todo = [(np.flatnonzero(np.isfinite(a).all(axis=1)), np.flatnonzero(np.isfinite(b).all(axis=1)))]
    while todo:
        left, right = todo.pop()
        if not len(left):
            continue
        low, high = a[left].min(axis=0), a[left].max(axis=0)
        y = b[right]
        off = np.maximum(np.maximum(low - y, y - high), 0)
        # A little more than the exact distance, so that rounding cannot lose a pair.
        right = right[(off * off).sum(axis=1) <= eps * eps * (1 + 1e-9)]
        if not len(right):
            continue
        if len(left) <= LEAF_POINTS:
            yield left, right
            continue
        order = np.argpartition(a[left, (high - low).argmax()], len(left) // 2)
        todo += [(left[order[: len(left) // 2]], right), (left[order[len(left) // 2 :]], right)]


def _empty(**columns: str) -> pd.DataFrame:
    return pd.DataFrame({name: pd.Series(dtype=kind) for name, kind in columns.items()})


def _neighbour_counts(some: DataFrame, points: DataFrame, eps: float, enough: int) -> DataFrame:
    """Rows within ``eps`` of each of some points: their number if it is less than ``enough``, else at least ``enough``."""

    def count(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return _empty(vid="int64", n="int64")
        return pd.DataFrame({"vid": left["vid"], "n": _counted(_vectors(left), _vectors(right), right["weight"].to_numpy(), eps, enough)})

    partial = _paired(some, points, points).applyInPandas(count, "vid long, n long")
    return partial.groupBy("vid").agg(F.sum("n").alias("neighbours"))


def _counted(a: np.ndarray, b: np.ndarray, weights: np.ndarray, eps: float, enough: int) -> np.ndarray:
    """Weight of the right points within ``eps`` of each left point; a point that has enough of them is not counted on.

    The right points of a leaf are taken from its middle outwards, so that points in dense places are done after the first of them.
    """
    total = np.zeros(len(a), dtype="int64")
    for left, right in _leaves(a, b, eps):
        middle = (a[left].min(axis=0) + a[left].max(axis=0)) / 2
        right = right[((b[right] - middle) ** 2).sum(axis=1).argsort()]
        for start in range(0, len(right), 256):
            part = right[start : start + 256]
            total[left] += _within(a[left], b[part], eps) @ weights[part]
            left = left[total[left] < enough]
            if not len(left):
                break
    return total


def _core_links(core: DataFrame, everyone: DataFrame, eps: float) -> DataFrame:
    """Links (larger, smaller) that connect dense points of a group as their distances do."""

    def link(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return _empty(u="int64", v="int64")
        ids, others = left["vid"].to_numpy(), right["vid"].to_numpy()
        a, b = _vectors(left), _vectors(right)
        near = [(i, j, _within(a[i], b[j], eps)) for i, j in _leaves(a, b, eps)]
        low, low_other = ids.copy(), others.copy()
        none = np.iinfo("int64").max
        while True:
            before = low.sum() + low_other.sum(), low.copy()
            for i, j, m in near:
                low_other[j] = np.minimum(low_other[j], np.where(m, low[i][:, None], none).min(axis=0))
                low[i] = np.minimum(low[i], np.where(m, low_other[j][None, :], none).min(axis=1))
            if np.array_equal(before[1], low) and before[0] == low.sum() + low_other.sum():
                break
        u, v = np.concatenate([ids, others]), np.concatenate([low, low_other])
        found = pd.DataFrame({"u": u, "v": v})
        return found[found["u"] != found["v"]].drop_duplicates()

    return _paired(core, core, everyone).applyInPandas(link, "u long, v long")


def _cross_links(parts: DataFrame, eps: float) -> DataFrame:
    """Links between the parts of dense points that come within ``eps``, where a neighbourhood holds several parts."""

    def link(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return _empty(u="int64", v="int64")
        a, b = left["part"].to_numpy(), right["part"].to_numpy()
        x, y = _vectors(left), _vectors(right)
        found = []
        for some, others in _leaves(x, y, eps):
            other = a[some][:, None] != b[others][None, :]
            if not other.any():
                continue
            i, j = np.nonzero(other & _within(x[some], y[others], eps))
            if len(i):
                found.append(np.unique(np.stack([a[some][i], b[others][j]], axis=1), axis=0))
        if not found:
            return _empty(u="int64", v="int64")
        return pd.DataFrame(np.unique(np.concatenate(found), axis=0), columns=["u", "v"])

    cells = parts.groupBy("cell").agg(F.min("part").alias("low"), F.max("part").alias("high"))
    around = cells.select(F.col("cell").alias("home"), F.explode(_neighbouring(F.col("cell"))).alias("cell")).join(cells, "cell")
    several = around.groupBy("home").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low < high")
    left = parts.join(several.select(F.col("home").alias("cell")), "cell", "left_semi")
    return _paired(left, parts, parts).applyInPandas(link, "u long, v long")


def _border_clusters(flagged: DataFrame, labelled: DataFrame, eps: float) -> DataFrame:
    """First cluster within reach of each point that is not dense."""

    def reach(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return _empty(vid="int64", cluster="int32")
        best, none = np.full(len(left), np.iinfo("int32").max, dtype="int32"), np.iinfo("int32").max
        clusters = right["cluster"].to_numpy().astype("int32")
        x, y = _vectors(left), _vectors(right)
        for some, others in _leaves(x, y, eps):
            # First clusters first: a point that meets one is done.
            others = others[clusters[others].argsort(kind="stable")]
            for start in range(0, len(others), 256):
                part = others[start : start + 256]
                met = np.where(_within(x[some], y[part], eps), clusters[part][None, :], none).min(axis=1)
                best[some] = met
                some = some[met == none]
                if not len(some):
                    break
        out = pd.DataFrame({"vid": left["vid"], "cluster": best})
        return out[out["cluster"] != none]

    others = flagged.where(~F.col("is_core"))
    core = flagged.where("is_core").join(labelled, "vid")
    partial = _paired(others, core, flagged).applyInPandas(reach, "vid long, cluster int")
    return partial.groupBy("vid").agg(F.min("cluster").alias("cluster"))


def connected_components(links: DataFrame) -> DataFrame:
    """(``vid``, ``root``): the smallest node reachable over links ``u``–``v``.

    Alternates two contractions: every node links its larger neighbours to its
    smallest one, then every node links its smaller neighbours to the smallest
    of them (Kiveris et al., "Connected Components in MapReduce and Beyond",
    2014). The number of rounds grows with the logarithm of the nodes.
    """
    links = materialize(
        links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "links"
    )
    state = _fingerprint(links)
    while True:
        links = materialize(_small_star(_large_star(links)), "links")
        previous, state = state, _fingerprint(links)
        if state == previous:
            return links.select(F.col("u").alias("vid"), F.col("v").alias("root"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    lowest = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = lowest.select("u", F.col("m").alias("v"))
    return reduce(DataFrame.unionByName, [moved, own]).distinct()


def _fingerprint(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)
