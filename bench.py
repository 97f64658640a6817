"""Headline queries, timed; prints one JSON line.

Staging tables that are read several times are written first (``staging_load``),
then the star schema (``star_build``).
Builds (dimensions, facts, marts) are timed again on their own; reports read
the written star schema, as reports of a warehouse do.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "dim_date", "dim_customer", "dim_product", "dim_order_status", "fact_order_items", "fact_payments", "fact_reviews",
    "monthly_sales", "agg_product_performance", "rfm_features", "category_revenue_top", "geographic_sales",
    "category_satisfaction", "delivery_performance", "product_list", "sequence_compliance", "resequence_items",
    "missing_report", "check_unique_composite", "constraint_registry", "value_counts", "monthly_resample",
    "segment_profile", "segment_profile_medians", "silhouette_squared", "davies_bouldin", "pca_project", "kmeans_fit", "find_optimal_k", "dbscan", "segmentation_run", "warehouse_run",
]


def main() -> None:
    from conformance import load_all
    from conformance.fixtures import STAGING
    from conformance.registry import QUERIES
    from conformance.star import star
    from tradewind.session import local_session

    load_all()
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.range(1000).selectExpr("sum(id)").collect()
    timings: dict[str, float] = {}

    start = time.perf_counter()
    tables = star(spark, sf_dir)
    for name in STAGING:
        tables[name]
    timings["staging_load"] = round(time.perf_counter() - start, 3)
    start = time.perf_counter()
    for name in ("fact_order_items", "fact_payments", "fact_reviews", "dim_date", "agg_monthly_sales", "agg_product_performance"):
        tables[name]
    timings["star_build"] = round(time.perf_counter() - start, 3)

    names = sys.argv[1:] or HEADLINE
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
    total = round(sum(timings.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": timings,
                      "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
