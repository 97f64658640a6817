"""Saving, loading and applying a fitted segmentation."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, SparkSession

from tradewind.operators.clustering import Projection, z_name
from tradewind.operators.kmeans import KMeansFit


@dataclass
class SegmentationModel:
    """A pipeline from raw features to cluster and projection, and one row of metadata."""

    pipeline: PipelineModel
    metadata: DataFrame


def _select(*expressions: str) -> SQLTransformer:
    return SQLTransformer(statement=f"SELECT *, {', '.join(expressions)} FROM __THIS__")


def bundle(
    spark: SparkSession,
    columns: list[str],
    stats: dict[str, tuple[float, float]],
    kmeans: KMeansFit,
    projection: Projection,
    scores: dict[str, float],
    n_samples: int,
) -> SegmentationModel:
    """Scaler, nearest centroid and projection as one pipeline of SQL stages."""
    z = [z_name(c) for c in columns]
    scaler = _select(*[f"(CAST({c} AS DOUBLE) - {stats[c][0]!r}D) / {stats[c][1]!r}D AS {z_name(c)}" for c in columns])
    distances = [
        "struct(" + " + ".join(f"({n} - {v!r}D) * ({n} - {v!r}D)" for n, v in zip(z, center)) + f" AS d, {i} AS i)"
        for i, center in enumerate(kmeans.centroids)
    ]
    components = [
        " + ".join(f"{name} * {weight!r}D" for name, weight in zip(z, loading)) + f" AS pca_{i}"
        for i, loading in enumerate(projection.loadings, start=1)
    ]
    stages = [
        scaler,
        _select(f"array_min(array({', '.join(distances)})).i AS kmeans_cluster", *components),
    ]
    created = datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    row = (created, len(kmeans.centroids), n_samples, scores["silhouette_squared"], scores["davies_bouldin"], ",".join(columns), kmeans.centroids)
    metadata = spark.createDataFrame(
        [row],
        "created_date string, n_clusters int, n_samples long, silhouette_squared double, davies_bouldin_score double, feature_names string, centroids array<array<double>>",
    )
    return SegmentationModel(PipelineModel(stages), metadata)


def model_save(model: SegmentationModel, path: str) -> None:
    model.pipeline.write().overwrite().save(f"{path}/pipeline")
    model.metadata.write.mode("overwrite").json(f"{path}/metadata")


def model_load(spark: SparkSession, path: str) -> SegmentationModel:
    return SegmentationModel(PipelineModel.load(f"{path}/pipeline"), spark.read.json(f"{path}/metadata"))


def predict_segment(model: SegmentationModel, rows: DataFrame) -> DataFrame:
    """Cluster and projection of new rows that hold the raw features."""
    return model.pipeline.transform(rows)
