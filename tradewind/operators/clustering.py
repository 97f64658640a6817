"""Standardised features, k-means, and cluster evaluation."""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.operators.kmeans import RESTARTS, fit_kmeans_all, weighted_points
from tradewind.operators.silhouette import bounds_of_models, measure
from tradewind.operators.stats import median_impute
from tradewind.session import materialize
from tradewind.sources.schemas import FEATURE_COLUMNS

# Fixed value: cluster number used when none was found.
FALLBACK_K = 4

# Helpers of the task functions travel with them: tasks need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

VECTOR = "features"
#: Clusters that are carried together beside each row.
CLUSTER_BLOCK = 500


def feature_matrix(df: DataFrame, key: str, columns: list[str] = FEATURE_COLUMNS) -> DataFrame:
    """Key and numeric features, missing values filled with the column median."""
    return median_impute(df.select(key, *[F.col(c).cast("double").alias(c) for c in columns]), columns)


def scaling(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column; a constant column is divided by 1."""
    row = df.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    return {c: (row[f"m{i}"], row[f"s{i}"] or 1.0) for i, c in enumerate(columns)}


def z_name(column: str) -> str:
    return f"z_{column}"


def standardize(df: DataFrame, columns: list[str], stats: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """Add z-scores of the columns, with given or own mean and deviation."""
    stats = stats or scaling(df, columns)
    return df.withColumns({z_name(c): (F.col(c) - F.lit(stats[c][0])) / F.lit(stats[c][1]) for c in columns})


def assemble(df: DataFrame, columns: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol=VECTOR).transform(df)


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)


def kmeans_assign(df: DataFrame, features: Column, centroids: list[list[float]], name: str = "kmeans_cluster") -> DataFrame:
    """Nearest of the given centroids, the first one on ties."""
    choices = [
        F.struct(squared_distance(features, F.array(*[F.lit(float(v)) for v in c])).alias("d"), F.lit(i).alias("i"))
        for i, c in enumerate(centroids)
    ]
    return df.withColumn(name, F.array_min(F.array(*choices))["i"])


def cluster_statistics(df: DataFrame, features: str, label: str, weight: str | None = None) -> DataFrame:
    """Per cluster: rows, centroid, and the sum of squared norms."""
    vector, count = array_to_vector(F.col(features)), F.col(weight) if weight else F.lit(1.0)
    summary = Summarizer.metrics("mean", "normL2").summary(vector, count)
    grouped = df.groupBy(F.col(label).alias("label")).agg(F.sum(count).alias("n"), summary.alias("s"))
    norms = F.aggregate(vector_to_array("s.normL2"), F.lit(0.0), lambda total, x: total + x * x)
    return grouped.select("label", "n", vector_to_array("s.mean").alias("centroid"), norms.alias("norms"))


def with_centroid(df: DataFrame, features: str, label: str, fitted: bool = True) -> DataFrame:
    """Every row with its squared distance to the centroid of its cluster.

    A fitted number of clusters is one small row each, sent to every task, so that
    rows are not shuffled on a handful of keys; density clusters are joined.
    """
    centroids = cluster_statistics(df, features, label).select(F.col("label").alias(label), "centroid")
    return df.join(F.broadcast(centroids) if fitted else centroids, label).withColumn("d2", squared_distance(F.col(features), F.col("centroid")))


def inertia(df: DataFrame, features: str, label: str) -> DataFrame:
    """Sum of squared distances to the own centroid."""
    return with_centroid(df, features, label).agg(F.sum("d2").alias("inertia"))


def davies_bouldin(df: DataFrame, features: str, label: str) -> DataFrame:
    """Mean over clusters of the worst (spread + spread) / centroid distance.

    The pairwise part only sees one row per cluster, held in one array, so it is
    for fitted clusters, whose number is given. Clusters with one centroid are not
    compared; one cluster, or none, scores NULL.
    """
    spread = with_centroid(df, features, label).groupBy(label).agg(
        F.avg(F.sqrt("d2")).alias("s"), F.first("centroid").alias("c")
    )
    clusters = spread.agg(F.collect_list(F.struct(F.col(label).alias("l"), "s", "c")).alias("all"))
    worst = F.transform(
        "all",
        lambda a: F.array_max(
            F.transform(
                F.filter("all", lambda b: squared_distance(a["c"], b["c"]) > 0),
                lambda b: (a["s"] + b["s"]) / F.sqrt(squared_distance(a["c"], b["c"])),
            )
        ),
    )
    compared = F.filter(worst, lambda x: x.isNotNull())
    total = F.aggregate(compared, F.lit(0.0), lambda s, x: s + x)
    return clusters.select(F.try_divide(total, F.size(compared)).alias("davies_bouldin"))


def silhouette_squared(df: DataFrame, features: str, label: str, weight: str | None = None) -> DataFrame:
    """Mean silhouette on squared Euclidean distance, in time linear in the rows.

    ``weight`` is the number of rows that a row stands for.

    The mean squared distance of a row to a cluster follows from the cluster's
    size, centroid and sum of squared norms, so no pair of rows is formed.
    """
    clusters = materialize(cluster_statistics(df, features, label, weight), "clusters")
    blocks = max(1, math.ceil(clusters.count() / CLUSTER_BLOCK))
    clusters = clusters.withColumn("block", F.pmod(F.xxhash64("label"), F.lit(blocks)).cast("int"))
    table = clusters.groupBy("block").agg(F.collect_list(F.struct("label", "n", "centroid", "norms")).alias("clusters"))
    x = F.col(features)
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    count = F.col(weight) if weight else F.lit(1.0)
    rows = df.select(F.col(label).alias("label"), x.alias("x"), dot(x, x).alias("xx"), count.alias("w"))
    mean = lambda c: F.col("xx") - 2 * dot(F.col("x"), c["centroid"]) + c["norms"] / c["n"]
    means = F.transform("clusters", lambda c: F.struct(c["label"].alias("label"), c["n"].alias("n"), mean(c).alias("d")))
    own = F.filter("means", lambda m: m["label"] == F.col("label"))[0]
    other = F.array_min(F.transform(F.filter("means", lambda m: m["label"] != F.col("label")), lambda m: m["d"]))
    if blocks == 1:
        rows = rows.withColumn("clusters", table.select("clusters").scalar()).select("label", "w", means.alias("means"))
        rows = rows.select("w", own["n"].alias("n"), own["d"].alias("d"), other.alias("b"))
    else:
        # Every row sees the clusters block by block; what it keeps of a block is its own cluster and the nearest other.
        rows = rows.withColumn("id", F.monotonically_increasing_id())
        rows = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).join(table, "block")
        rows = rows.select("id", "label", "w", means.alias("means"))
        rows = rows.select("id", "w", F.get(F.filter("means", lambda m: m["label"] == F.col("label")), F.lit(0)).alias("own"), other.alias("b"))
        rows = rows.groupBy("id").agg(
            F.first("w").alias("w"), F.max("own.n").alias("n"), F.max("own.d").alias("d"), F.min("b").alias("b")
        )
    a = F.col("d") * F.col("n") / (F.col("n") - 1)
    rows = rows.select("w", "n", F.when(F.col("n") > 1, a).alias("a"), "b")
    return rows.agg(F.try_divide(F.sum(F.col("w") * _silhouette()), F.sum("w")).alias("silhouette_squared"))


def _silhouette() -> Column:
    """(b − a) / max(a, b), 0 for a cluster of one row."""
    largest = F.greatest("a", "b")
    return F.when((F.col("n") > 1) & (largest > 0), (F.col("b") - F.col("a")) / largest).otherwise(F.lit(0.0))


@dataclass
class KSearch:
    """Inertia and Euclidean silhouette, with its bounds, per tried cluster number, and the chosen one."""

    scores: DataFrame
    best_k: int


def find_optimal_k(df: DataFrame, columns: list[str], max_k: int = 8, restarts: int = RESTARTS) -> KSearch:
    """Try k = 2..max_k on standardised columns; the largest Euclidean silhouette wins, the smallest k on ties.

    All silhouettes are bounded together first. Only where bounds of several k overlap with those of the best are these measured exactly;
    for the others the middle of the bounds is given.
    """
    points = weighted_points(df, columns)
    fits = fit_kmeans_all(points, list(range(2, max_k + 1)), restarts)
    bounds = bounds_of_models(points, {k: fit.centroids for k, fit in fits.items()})
    least = max((low for low, _ in bounds.values()), default=0.0)
    contenders = [k for k, (_, high) in bounds.items() if high >= least]
    rows = []
    for k, fit in fits.items():
        low, high = bounds.get(k, (0.0, 0.0))
        value = (low + high) / 2
        if k in contenders and len(contenders) > 1:
            assigned = kmeans_assign(points, F.col("x"), fit.centroids, "cluster")
            value = low = high = measure(assigned, "x", "cluster", "weight").value
        rows.append((k, float(fit.inertia), value, low, high))
    best = max(rows, key=lambda r: (r[0] in contenders, r[2], -r[0]))[0] if rows else FALLBACK_K
    return KSearch(df.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double, silhouette_low double, silhouette_high double"), best)


def covariance_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Population covariance of every pair of columns, one aggregate over the data."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    row = df.agg(*[F.covar_pop(a, b).alias(f"p{i}") for i, (a, b) in enumerate(pairs)])
    entries = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"p{i}").alias("covariance"))
        for i, (a, b) in enumerate(pairs)
    ]
    return row.select(F.inline(F.array(*entries)))


@dataclass
class Projection:
    """Loadings of the principal components (one list per component) and their share of variance."""

    loadings: list[list[float]]
    explained: list[float]


def fit_pca(df: DataFrame, columns: list[str], k: int = 2) -> Projection:
    """Principal components of centred columns; the largest loading of each is positive."""
    model = PCA(k=k, inputCol=VECTOR, outputCol="pca").fit(assemble(df, columns))
    matrix = model.pc.toArray()
    loadings = []
    for i in range(k):
        component = matrix[:, i]
        sign = 1.0 if component[np.argmax(np.abs(component))] >= 0 else -1.0
        loadings.append([float(sign * v) for v in component])
    return Projection(loadings, [float(v) for v in model.explainedVariance.toArray()])


def project(df: DataFrame, columns: list[str], projection: Projection) -> DataFrame:
    """Add ``pca_1``, ``pca_2``, …"""
    out = {}
    for i, loading in enumerate(projection.loadings, start=1):
        terms = [F.col(c) * F.lit(w) for c, w in zip(columns, loading)]
        total = terms[0]
        for term in terms[1:]:
            total = total + term
        out[f"pca_{i}"] = total
    return df.withColumns(out)


def noise_report(df: DataFrame, features: str, label: str) -> DataFrame:
    """Clusters without noise, noise rows and percentage, squared silhouette of the clustered rows (NULL below two clusters)."""
    counts = df.agg(
        F.countDistinct(F.when(F.col(label) != -1, F.col(label))).alias("n_clusters"),
        F.count_if(F.col(label) == -1).alias("n_noise"),
        (F.try_divide(F.count_if(F.col(label) == -1), F.count(F.lit(1))) * 100).alias("noise_pct"),
    )
    scored = silhouette_squared(df.where(F.col(label) != -1), features, label).scalar()
    return counts.withColumn("silhouette_squared", F.when(F.col("n_clusters") > 1, scored))
