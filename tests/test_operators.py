"""Versions, quality, sinks, reports and plans on small fixtures."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conformance.star import star
from tradewind.operators import profiling, quality, relational, reports, versions
from tradewind.plans import facts, marts, warehouse
from tradewind.session import shared_folder
from tradewind.sources import files

SF = "/root/testdata/sf0.001"


def test_scd2_unchanged_changed_new_vanished(spark):
    start, end, now = datetime(2020, 1, 1), datetime(2999, 12, 31), datetime(2021, 1, 1)
    schema = "k string, v int, record_hash string, effective_start_date timestamp_ntz, effective_end_date timestamp_ntz, is_current boolean"
    history = spark.createDataFrame(
        [("same", 1, "a", start, end, True), ("changed", 1, "a", start, end, True), ("gone", 1, "a", start, end, True),
         ("changed", 0, "z", datetime(2019, 1, 1), start, False)], schema)
    incoming = spark.createDataFrame([("same", 1, "a"), ("changed", 2, "b"), ("new", 9, "c")], "k string, v int, record_hash string")
    got = {tuple(r) for r in versions.scd2_apply(history, incoming, "k", F.lit(now).cast("timestamp_ntz")).collect()}
    assert got == {
        ("same", 1, "a", start, end, True), ("gone", 1, "a", start, end, True), ("changed", 1, "a", start, now, False),
        ("changed", 2, "b", now, end, True), ("new", 9, "c", now, end, True), ("changed", 0, "z", datetime(2019, 1, 1), start, False),
    }


def test_quarantine_keeps_every_row(spark):
    df = spark.createDataFrame([("SP", 1), ("UNKNOWN", 2), (None, 3)], "s string, id int")
    valid, rejected = quality.quarantine_split(df, [*quality.has_length(2, "s"), *quality.not_null("s")])
    assert [r["id"] for r in valid.collect()] == [1]
    assert {r["id"]: r["broken_rules"] for r in rejected.collect()} == {2: "length:s", 3: "not_null:s"}


def test_every_kind_of_rule(spark):
    df = spark.createDataFrame([(1, 5, "a", 2), (2, 0, "z", 9), (3, None, None, None)], "id int, n int, e string, m int")
    rules = [*quality.in_range(1, 5, "n"), *quality.one_of("e", "a"), *quality.ordered("m", "n"), *quality.not_null("n")]
    got = {(r["row_key"], r["rule"], r["value"]) for r in quality.check_rows(df, "t", rules, "id").collect()}
    assert got == {("2", "range:n", "0"), ("2", "enum:e", "z"), ("2", "row_order:m<=n", "9"), ("3", "not_null:n", None)}


def test_sequences(spark):
    orders = {"ok": [1, 2, 3], "gap": [1, 3], "late": [2, 3], "twice": [1, 1, 2], "single": [1]}
    df = spark.createDataFrame([(o, i) for o, ids in orders.items() for i in ids], "order_id string, order_item_id int")
    assert {r["order_id"] for r in profiling.sequence_gaps(df).collect()} == {"gap", "late", "twice"}
    assert {r["order_id"] for r in profiling.sequence_not_from_one(df).collect()} == {"late"}
    assert profiling.sequence_compliance(df).first()["compliant_orders"] == 1
    examples = sorted(tuple(r) for r in profiling.sequence_examples(df, [], 2).collect())
    assert examples == [("gap", 1, 1), ("gap", 3, 2), ("late", 2, 1), ("late", 3, 2)]


def test_latest_review_with_missing_time_and_tie(spark):
    rows = [("a", "2", None, 1), ("a", "1", datetime(2020, 1, 1), 2), ("b", "9", datetime(2020, 1, 1), 3), ("b", "8", datetime(2020, 1, 1), 4)]
    df = spark.createDataFrame(rows, "review_id string, order_id string, t timestamp_ntz, s int")
    got = {r["review_id"]: r["s"] for r in facts.latest_per_key(df, "review_id", "t", "order_id").collect()}
    assert got == {"a": 2, "b": 4}


def test_missing_source_counts_zero(spark):
    path = f"{shared_folder(spark)}/no-such-folder"
    loaded = dict(files.source_catalog(spark, path))
    assert set(loaded.values()) == {None} and len(loaded) == 8


def test_listing_limits_are_checked(spark):
    mart = star(spark, SF)["agg_monthly_sales"]
    with pytest.raises(ValueError):
        reports.recent_months(mart, limit=121)
    assert reports.recent_months(mart).count() == 12


def test_sample_is_stable_and_exact(spark):
    df = spark.range(5000)
    a = {r["id"] for r in relational.seeded_sample(df, "id", 700).collect()}
    b = {r["id"] for r in relational.seeded_sample(df.repartition(7), "id", 700).collect()}
    assert len(a) == 700 and a == b
    assert relational.seeded_sample(df, "id", 9000).count() == 5000


def test_keys_are_dense_and_marts_add_up(spark):
    s = star(spark, SF)
    for table, (key, _, _) in warehouse.KEYS.items():
        low, high, n = s[table].agg(F.min(key), F.max(key), F.count(key)).first()
        assert (low, high) == (1, n), table
    revenue = s["fact_order_items"].agg(F.sum("item_price")).first()[0]
    assert s["agg_monthly_sales"].agg(F.sum("total_revenue")).first()[0] == revenue
    metrics = marts.product_metrics(s["dim_product"], s["fact_order_items"], s["fact_reviews"], fanout=False)
    assert metrics.agg(F.sum("last_12_months_revenue")).first()[0] == revenue


def test_same_result_for_any_number_of_partitions(spark):
    s, seen = star(spark, SF), set()
    for n in ("1", "4", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        mart = marts.monthly_sales(s["fact_order_items"], s["dim_date"], s["dim_customer"]).drop("last_updated")
        seen.add(tuple(map(tuple, mart.orderBy("year_month").collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert len(seen) == 1


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_plans_stay_native(spark):
    s = star(spark, SF)
    plans = [
        warehouse.unkeyed("dim_order_status", s), warehouse.unkeyed("fact_order_items", s), warehouse.unkeyed("fact_reviews", s),
        marts.monthly_sales(s["fact_order_items"], s["dim_date"], s["dim_customer"]),
        marts.product_metrics(s["dim_product"], s["fact_order_items"], s["fact_reviews"]),
        reports.category_satisfaction(s["fact_reviews"], s["fact_order_items"], s["dim_product"]),
    ]
    for df in plans:
        plan = plan_of(df)
        assert "Python" not in plan and "ArrowEval" not in plan and "CartesianProduct" not in plan
        assert "Window" not in plan.replace("window", "") and "Expand" not in plan.split("== Physical Plan ==")[1].replace("isExpand", "")


def test_ranked_plan_has_no_window(spark):
    s = star(spark, SF)
    ranked = marts.with_rank(s["agg_product_performance"].drop("revenue_rank"), "last_12_months_revenue", "product_sk", "revenue_rank")
    assert "Window" not in plan_of(ranked)


def test_only_needed_columns_are_read(spark):
    s = star(spark, SF)
    plan = plan_of(reports.fact_totals(s["fact_order_items"]))
    assert "ReadSchema: struct<item_price:decimal(10,2),total_item_value:decimal(10,2)>" in plan
