"""A load of changes gives the tables of a whole load."""

import uuid

import pytest
from pyspark.sql import functions as F

from conformance.fixtures import STAGING, staging
from tradewind.operators.keys import KeyStore
from tradewind.plans import warehouse
from tradewind.plans.changes import changed_keys, run_changes
from tradewind.session import materialize, shared_folder
from tradewind.sources.publication import Publication, published
from tradewind.sources.sinks import folder_sink

SF = "/root/testdata/sf0.001"
TIMES = {"created_date", "updated_date", "last_updated", "load_timestamp", "effective_start_date"}


@pytest.fixture(scope="module")
def loaded(spark):
    """A first load: its folder, its key store and its sources."""
    folder = f"{shared_folder(spark)}/changes-{uuid.uuid4().hex}"
    sources = {t: materialize(staging(spark, SF)[t], t) for t in STAGING}
    keys = KeyStore(spark, f"{folder}-keys")
    with Publication(spark, folder) as sink:
        warehouse.run_warehouse(spark, sources, sink, keys=keys)
    return folder, keys, sources


def same_as_whole_load(spark, loaded, sources):
    """Load changes without publishing them, then the whole; returns the status and built rows of every table."""
    folder, keys, _ = loaded
    stored = published(spark, folder)
    sink = Publication(spark, folder)
    sink.__enter__()
    got, summary = run_changes(spark, stored, sources, sink, keys)
    other = f"{folder}-{uuid.uuid4().hex}"
    want, _ = warehouse.run_warehouse(spark, sources, folder_sink(other), keys=keys)
    plain = lambda df: df.select(*[F.col(c).cast("string") for c in df.columns if c not in TIMES])
    for table in want:
        a, b = plain(got[table]), plain(want[table])
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), table
    for layer, table in sink.written:
        if layer == "rejected":
            a, b = plain(spark.read.parquet(sink.written[layer, table].path)), plain(spark.read.parquet(f"{other}/rejected/{table}"))
            assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), table
    sink.discard()
    return {r["table_name"]: (r["status"], r["built"]) for r in summary.collect()}


def some(column, k, r=0):
    return f"CRC32(CAST({column} AS STRING)) % {k} = {r}"


def least(df, column):
    return df.agg(F.min(column)).first()[0]


def changed(df, condition, **columns):
    return df.withColumns({c: F.when(F.expr(condition), v).otherwise(F.col(c)).cast(df.schema[c].dataType) for c, v in columns.items()})


def test_changed_keys(spark):
    schema = "k string, v int, w string"
    before = spark.createDataFrame([("a", 1, None), ("b", 1, "x"), ("b", 1, "x"), (None, 1, "x"), ("c", None, "y"), ("e", 1, "")], schema)
    after = spark.createDataFrame([("b", 1, "x"), (None, 2, "x"), ("c", None, "y"), ("d", 1, "x"), ("e", 1, None)], schema)
    keys = lambda a, b: sorted(str(r[0]) for r in changed_keys(a, b, "k", ["v", "w"]).collect())
    assert keys(before, after) == ["None", "a", "b", "d", "e"]
    assert keys(after, after.repartition(3)) == [] and keys(before.limit(0), after.limit(0)) == []
    assert keys(before.where("k = 'a'"), before.where("k = 'a'").drop("w")) == []


def test_an_equal_delivery_changes_nothing(spark, loaded):
    folder, keys, sources = loaded
    sink = Publication(spark, folder)
    sink.__enter__()
    refused = {"stg_sellers": spark.createDataFrame([("sellers.csv", 3)], "file string, record long")}
    _, summary = run_changes(spark, published(spark, folder), {t: df.repartition(3) for t, df in sources.items()}, sink, keys, refused)
    assert summary.where("status <> 'unchanged'").isEmpty() and list(sink.written) == [("rejected", "stg_sellers")]
    sink.discard()


def test_one_corrected_price_touches_one_order(spark, loaded):
    sources = dict(loaded[2])
    order = least(sources["stg_order_items"], "order_id")
    sources["stg_order_items"] = changed(sources["stg_order_items"], f"order_id = '{order}'", price=F.col("price") + 1)
    lines = sources["stg_order_items"].where(F.col("order_id") == order)
    status = same_as_whole_load(spark, loaded, sources)
    assert status["fact_order_items"] == ("changed", lines.count()) and status["agg_monthly_sales"] == ("changed", 1)
    assert status["agg_product_performance"] == ("changed", lines.select("product_id").distinct().count())
    assert all(status[t][0] == "unchanged" for t in ("dim_customer", "dim_order_status", "fact_payments", "fact_reviews", "stg_orders"))


def test_many_changes_at_once(spark, loaded):
    s = dict(loaded[2])
    s["stg_customers"] = changed(s["stg_customers"].where("NOT " + some("customer_id", 9)), some("customer_id", 9, 1), customer_state=F.lit("RJ"))
    s["stg_sellers"] = s["stg_sellers"].where(F.col("seller_id") != least(s["stg_sellers"], "seller_id"))
    s["stg_products"] = changed(s["stg_products"], some("product_id", 11), product_id=F.concat(F.lit("new"), "product_id"))
    s["stg_product_categories"] = changed(
        s["stg_product_categories"], f"product_category_name = '{least(s['stg_products'], 'product_category_name')}'",
        product_category_name_english=F.lit("other"),
    )
    orders = changed(s["stg_orders"].where("NOT " + some("order_id", 13)), some("order_id", 13, 1), order_purchase_timestamp=F.lit("2031-05-06 07:08:09"))
    s["stg_orders"] = orders.unionAll(orders.where(some("order_id", 13, 2)).withColumn("order_status", F.lit("canceled")))
    items = s["stg_order_items"].where("NOT " + some("order_id", 17))
    s["stg_order_items"] = items.unionAll(items.where(some("order_id", 17, 1)))
    s["stg_payments"] = changed(s["stg_payments"], some("order_id", 19), order_id=F.lit(None))
    s["stg_reviews"] = changed(s["stg_reviews"], some("review_id", 8), review_score=F.lit(1)).where("NOT " + some("review_id", 8, 1))
    status = same_as_whole_load(spark, loaded, s)
    assert {t for t, v in status.items() if v[0] != "changed"} == set()


def test_a_source_that_comes_without_rows(spark, loaded):
    sources = dict(loaded[2])
    sources["stg_reviews"] = sources["stg_reviews"].limit(0)
    status = same_as_whole_load(spark, loaded, sources)
    assert status["fact_reviews"] == ("changed", 0) and status["fact_order_items"][0] == "unchanged"
