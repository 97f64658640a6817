"""The whole segmentation: features, cluster number, clusters, projection, labels, exports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.operators import clustering as cl
from tradewind.operators.dbscan import RUN_EPS, RUN_MIN_SAMPLES, dbscan
from tradewind.operators.kmeans import RESTARTS, fit_kmeans, weighted_points
from tradewind.operators.segments import segment_labels, segment_summary
from tradewind.session import materialize, run_folder
from tradewind.sources.models import SegmentationModel, bundle, predict_segment
from tradewind.sources.schemas import FEATURE_COLUMNS, SEGMENT_COLUMNS
from tradewind.sources.sinks import csv_export


@dataclass
class Segmentation:
    segments: DataFrame
    search: DataFrame
    model: SegmentationModel
    explained_variance: list[float]


def run_segmentation(
    features: DataFrame, key: str = "customer_sk", max_k: int = 8, k: int | None = None, restarts: int = RESTARTS
) -> Segmentation:
    """From RFM features to labelled segments.

    ``k`` skips the search for a cluster number. Intermediates are removed at
    the end; the segments stay in the shared folder.
    """
    spark = features.sparkSession
    with run_folder(spark):
        features = materialize(features, "rfm-features")
        matrix = materialize(cl.feature_matrix(features, key), "matrix")
        stats = cl.scaling(matrix, FEATURE_COLUMNS)
        z = [cl.z_name(c) for c in FEATURE_COLUMNS]
        scaled = materialize(cl.standardize(matrix, FEATURE_COLUMNS, stats), "scaled")

        if k is None:
            search = cl.find_optimal_k(scaled, z, max_k, restarts)
            scores, k = search.scores, search.best_k
        else:
            scores = spark.createDataFrame([], "k int, inertia double, silhouette double, silhouette_low double, silhouette_high double")
        kmeans = fit_kmeans(weighted_points(scaled, z), k, restarts)
        projection = cl.fit_pca(scaled, z)
        assigned = cl.kmeans_assign(scaled.select(F.array(*z).alias("x")), F.col("x"), kmeans.centroids, "cluster")
        quality = {
            "silhouette_squared": cl.silhouette_squared(assigned, "x", "cluster").first()[0],
            "davies_bouldin": cl.davies_bouldin(assigned, "x", "cluster").first()[0],
        }
        model = bundle(spark, FEATURE_COLUMNS, stats, kmeans, projection, quality, scaled.count())
        clusters = predict_segment(model, matrix).select(key, "kmeans_cluster", "pca_1", "pca_2")
        density = dbscan(scaled, key, z, RUN_EPS, RUN_MIN_SAMPLES).select(key, "dbscan_cluster")
        joined = materialize(features.join(clusters, key).join(density, key), "segments", keep=True)
    return Segmentation(segment_labels(joined), scores, model, projection.explained)


def project_centroids(model: SegmentationModel, features: list[str] = FEATURE_COLUMNS) -> DataFrame:
    """Centroids of the fitted clusters on the principal components."""
    names = [cl.z_name(c) for c in features]
    centers = model.metadata.select(F.explode("centroids").alias("c"))
    frame = centers.select(*[F.col("c")[i].alias(n) for i, n in enumerate(names)])
    return model.pipeline.stages[-1].transform(frame).select("kmeans_cluster", "pca_1", "pca_2")


def export_segments(segments: DataFrame, path: str) -> None:
    csv_export(segments, path, SEGMENT_COLUMNS)


def export_summary(segments: DataFrame, summary_path: str, labels_path: str) -> None:
    csv_export(segment_summary(segments), summary_path)
    csv_export(segments.select("customer_sk", "kmeans_cluster", "segment_label"), labels_path)


def segments_scan(spark, path: str) -> DataFrame:
    """Saved segments, with their numbers typed."""
    types = {
        "customer_sk": "bigint", "recency_days": "int", "frequency_orders": "bigint", "monetary_value": "decimal(38,2)",
        "avg_order_value": "double", "avg_review_score": "double", "customer_lifetime_days": "int", "rfm_score": "int",
        "kmeans_cluster": "int", "dbscan_cluster": "int", "pca_1": "double", "pca_2": "double",
    }
    rows = spark.read.option("header", True).option("escape", '"').csv(path)
    return rows.select(*[F.col(c).cast(types.get(c, "string")).alias(c) for c in rows.columns])
