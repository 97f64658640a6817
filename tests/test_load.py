"""The load with repeated keys and unresolved references, and reports over tables without rows."""

import uuid
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conformance.fixtures import STAGING, staging
from tradewind.operators import clustering, profiling, quality, relational, reports, stats
from tradewind.plans import marts, warehouse
from tradewind.session import shared_folder
from tradewind.sources import sinks

SF = "/root/testdata/sf0.001"
READ = {
    "dim_customer": "stg_customers", "dim_product": "stg_products", "dim_seller": "stg_sellers", "dim_order_status": "stg_orders",
    "fact_order_items": "stg_order_items", "fact_payments": "stg_payments", "fact_reviews": "stg_reviews",
}


def load(spark, sources):
    folder = f"{shared_folder(spark)}/load-{uuid.uuid4().hex}"
    tables, summary = warehouse.run_warehouse(spark, sources, sinks.folder_sink(folder))
    rejected = {t: spark.read.parquet(f"{folder}/rejected/{t}") for t in READ}
    return tables, {r["table_name"]: r for r in summary.collect()}, rejected


def revenue(tables):
    return tables["agg_monthly_sales"].agg(F.sum("total_revenue"), F.sum("total_items"), F.sum("total_orders")).first()


@pytest.fixture(scope="module")
def plain(spark):
    tables = staging(spark, SF)
    return load(spark, {t: tables[t] for t in STAGING})


def test_rows_read_are_rows_loaded_or_rejected(spark, plain):
    tables, summary, rejected = plain
    for table, source in READ.items():
        assert summary[source]["rows"] == summary[table]["rows"] + summary[table]["rejected"], table
        assert rejected[table].count() == summary[table]["rejected"]
        assert rejected[table].where("broken_rules = ''").isEmpty()
        assert "_row" not in tables[table].columns
    assert rejected["fact_order_items"].where("broken_rules LIKE '%not_null:seller_sk%' AND seller_id IS NULL").isEmpty()


def test_repeated_keys_do_not_multiply_revenue(spark, plain):
    tables = staging(spark, SF)
    sources = {t: tables[t] for t in STAGING}
    changed = {
        "stg_customers": {"customer_zip_code_prefix": F.lit("99999")},
        "stg_products": {"product_photos_qty": F.lit("9")},
        "stg_sellers": {"seller_zip_code_prefix": F.lit("99999")},
        "stg_orders": {"order_status": F.lit("canceled")},
    }
    for table, columns in changed.items():
        rows = sources[table]
        sources[table] = reduce(DataFrame.unionByName, [rows, rows, rows.withColumns(columns)])
    loaded, summary, rejected = load(spark, sources)
    assert revenue(loaded) == revenue(plain[0])
    for table, source in READ.items():
        assert summary[table]["rows"] == plain[1][table]["rows"], table
        assert summary[source]["rows"] == summary[table]["rows"] + summary[table]["rejected"], table
    for table, key in (("dim_customer", "customer_id"), ("dim_product", "product_id"), ("dim_seller", "seller_id"), ("dim_order_status", "order_id")):
        assert loaded[table].count() == loaded[table].select(key).distinct().count()
        assert not rejected[table].where(F.col("broken_rules").contains(f"unique:{key}")).isEmpty()


def test_append_refuses_repeats_inside_the_rows(spark):
    database = f"t{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{shared_folder(spark)}/{database}'")
    rows = spark.createDataFrame([(1, "a"), (2, "a")], "seller_sk long, seller_id string")
    with pytest.raises(ValueError, match="seller_id"):
        sinks.append_load(rows, database, "dim_seller")
    assert sinks.append_load(rows.limit(1), database, "dim_seller") == 1
    with pytest.raises(ValueError, match="existing"):
        sinks.append_load(rows.limit(1), database, "dim_seller")


def test_an_order_of_two_customers_counts_once(spark):
    dates = spark.createDataFrame([(20200105, "2020-01-05")], "date_key int, d string").select("date_key", F.to_date("d").alias("full_date"))
    customers = spark.createDataFrame([(1, "SP"), (2, "RJ")], "customer_sk long, customer_state string")
    items = spark.createDataFrame(
        [("o1", 1, 1, 20200105, 10.0, 1.0, 11.0), ("o1", 2, 1, 20200105, 5.0, 1.0, 6.0)],
        "order_id string, customer_sk long, product_sk long, order_date_key int, item_price double, freight_value double, total_item_value double",
    )
    mart = marts.monthly_sales(items, dates, customers).first()
    assert (mart["total_orders"], mart["unique_customers"], mart["total_items"], mart["sales_agg_sk"]) == (1, 2, 2, 202001)


def test_reports_over_tables_without_rows(spark):
    tables = staging(spark, SF)
    empty = {t: tables[t].limit(0) for t in STAGING}
    items, orders = empty["stg_order_items"], empty["stg_orders"]
    assert profiling.sequence_compliance(items).first()["compliance_rate"] is None
    assert reports.items_per_order_stats(items).first()["multi_item_pct"] is None
    references = profiling.referential_report({"items->orders": (items, "order_id", orders, "order_id")})
    assert all(r["passed"] for r in profiling.threshold_gate(empty, items, references).collect())
    assert profiling.profile_structure(empty).agg(F.sum("n_rows")).first()[0] == 0
    assert profiling.per_table(profiling.missing_report, empty).isEmpty()
    assert profiling.timestamp_progression(orders, "order_purchase_timestamp", "order_approved_at", "order_delivered_customer_date").first()[2] is None
    assert relational.duplicate_row_count(items).first()[0] == 0
    assert stats.value_counts(orders, "order_status").isEmpty() and stats.histogram(items, "price", 5).isEmpty()
    assert reports.item_position_distribution(items).isEmpty()
    assert quality.check_unique(orders, "stg_orders", ("order_id",)).isEmpty()
    vectors = spark.createDataFrame([], "x array<double>, label int")
    assert clustering.noise_report(vectors, "x", "label").first()["noise_pct"] is None
    assert clustering.davies_bouldin(vectors, "x", "label").first()[0] is None
    assert clustering.silhouette_squared(vectors, "x", "label").first()[0] is None


def test_clusters_with_one_centroid_are_not_compared(spark):
    rows = [([0.0], 0), ([2.0], 0), ([1.0], 1), ([1.0], 1), ([9.0], 2)]
    got = clustering.davies_bouldin(spark.createDataFrame(rows, "x array<double>, label int"), "x", "label").first()[0]
    assert got == pytest.approx((1 / 8 + 0 / 8 + 1 / 8) / 3)


def test_positions_beyond_the_tenth_are_reported(spark):
    items = spark.range(25).select(F.lit("o").alias("order_id"), (F.col("id") + 1).cast("int").alias("order_item_id"))
    assert reports.item_position_distribution(items).count() == 25
