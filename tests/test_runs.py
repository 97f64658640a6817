"""The whole load into catalogue tables, and the whole segmentation, on the smallest test folder."""

import uuid

import pytest
from pyspark.sql import functions as F

from conformance.fixtures import STAGING, staging
from conformance.q_segments import features
from tradewind.plans import segmentation, warehouse
from tradewind.session import shared_folder
from tradewind.sources import models, sinks
from tradewind.sources.schemas import FEATURE_COLUMNS, LAYERS, SEGMENT_COLUMNS, WAREHOUSE

SF = "/root/testdata/sf0.001"


def test_load_into_catalogue(spark):
    prefix = f"t{uuid.uuid4().hex[:10]}_"
    for layer in LAYERS:
        spark.sql(f"CREATE DATABASE {prefix}{layer} LOCATION '{shared_folder(spark)}/{prefix}{layer}'")
    tables = staging(spark, SF)
    sources = {t: tables[t] for t in STAGING}
    loaded, summary = warehouse.run_warehouse(spark, sources, sinks.catalog_sink(spark, prefix))
    counts = {r["table_name"]: r["rows"] for r in summary.collect()}
    assert set(counts) == {t for layer in WAREHOUSE.values() for t in layer}
    for table, n in counts.items():
        assert loaded[table].count() == n > 0, table
    stored = spark.table(f"{prefix}facts.fact_order_items").schema
    assert [(f.name, f.dataType) for f in stored] == [(f.name, f.dataType) for f in WAREHOUSE["facts"]["fact_order_items"]]


@pytest.fixture(scope="module")
def run(spark):
    return segmentation.run_segmentation(features(spark, SF), max_k=3, restarts=2)


def test_segmentation_run(spark, run):
    rows = run.segments.select(*SEGMENT_COLUMNS)
    assert rows.count() == features(spark, SF).count()
    assert rows.where("segment_label IS NULL OR pca_1 IS NULL OR dbscan_cluster IS NULL").isEmpty()
    assert rows.groupBy("kmeans_cluster").agg(F.countDistinct("segment_label").alias("n")).where("n <> 1").isEmpty()
    assert [r["k"] for r in run.search.orderBy("k").collect()] == [2, 3]
    assert 0 < sum(run.explained_variance) <= 1


def test_saved_model_gives_the_same_segments(spark, run):
    path = f"{shared_folder(spark)}/model-{uuid.uuid4().hex}"
    models.model_save(run.model, path)
    again = models.predict_segment(models.model_load(spark, path), run.segments.select("customer_sk", *FEATURE_COLUMNS))
    both = again.select("customer_sk", F.col("kmeans_cluster").alias("k")).join(run.segments, "customer_sk")
    assert both.count() == run.segments.count() and both.where("k <> kmeans_cluster").isEmpty()
    centers = segmentation.project_centroids(run.model)
    assert centers.count() == run.segments.select("kmeans_cluster").distinct().count()
