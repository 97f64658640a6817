"""Surrogate keys over several loads."""

import uuid

import pytest
from pyspark.sql import functions as F

from conformance.fixtures import STAGING, staging
from tradewind.operators.keys import KeyStore, stable_key
from tradewind.plans import warehouse
from tradewind.session import materialize, shared_folder
from tradewind.sources import sinks

SF = "/root/testdata/sf0.001"


@pytest.fixture
def store(spark):
    return KeyStore(spark, f"{shared_folder(spark)}/keys-{uuid.uuid4().hex}")


def load(spark, store, names):
    rows = spark.createDataFrame([(n, n.upper()) for n in names], "code string, label string")
    out, given = stable_key(rows, "sk", ["code"], store.known("t"))
    store.add("t", given)
    return {r["code"]: r["sk"] for r in out.collect()}


def test_known_keys_stay_and_new_ones_follow(spark, store):
    assert load(spark, store, ["b", "d", "f"]) == {"b": 1, "d": 2, "f": 3}
    assert load(spark, store, ["a", "b", "c", "d", "f"]) == {"b": 1, "d": 2, "f": 3, "a": 4, "c": 5}
    # A row that is gone keeps its key for the day it comes back, and nothing is given twice.
    assert load(spark, store, ["a", "e"]) == {"a": 4, "e": 6}
    assert load(spark, store, ["d", "e"]) == {"d": 2, "e": 6}
    assert load(spark, store, []) == {}


def test_copies_of_a_natural_key_are_told_apart(spark, store):
    def keyed(rows):
        df = materialize(spark.createDataFrame(rows, "k string, v int").withColumn("row", F.monotonically_increasing_id()), "rows")
        out, given = stable_key(df, "sk", ["k"], store.known("c"), ["v"], "row")
        store.add("c", given)
        return sorted((r["k"] or "", r["v"], r["sk"]) for r in out.collect())

    assert keyed([("x", 1), ("x", 1), ("y", 2), (None, 0)]) == [("", 0, 4), ("x", 1, 1), ("x", 1, 2), ("y", 2, 3)]
    assert keyed([("x", 1)] * 3 + [("x", 0), ("y", 2), (None, 0)]) == [("", 0, 4), ("x", 0, 5), ("x", 1, 1), ("x", 1, 2), ("x", 1, 6), ("y", 2, 3)]


def test_a_later_load_of_the_warehouse_keeps_every_key(spark, store):
    tables = {t: staging(spark, SF)[t] for t in STAGING}
    some = dict(tables)
    some["stg_customers"] = tables["stg_customers"].where("CAST(customer_id AS BIGINT) % 5 <> 2")
    some["stg_sellers"] = tables["stg_sellers"].where("CAST(seller_id AS BIGINT) % 4 <> 1")
    folders = [f"{shared_folder(spark)}/load-{uuid.uuid4().hex}" for _ in range(2)]
    first, _ = warehouse.run_warehouse(spark, some, sinks.folder_sink(folders[0]), keys=store)
    second, _ = warehouse.run_warehouse(spark, tables, sinks.folder_sink(folders[1]), keys=store)
    whole, _ = warehouse.run_warehouse(spark, tables, sinks.folder_sink(f"{folders[1]}-fresh"))
    for table, (key, natural, ties) in warehouse.KEYS.items():
        low, high, n, distinct = second[table].agg(F.min(key), F.max(key), F.count(key), F.countDistinct(key)).first()
        assert n == distinct == whole[table].count() and low == 1, table
        if table not in warehouse.REPEATING:
            kept = first[table].select(*natural, F.col(key).alias("before")).join(second[table], natural)
            assert kept.where(f"before <> {key}").isEmpty() and kept.count() == first[table].count(), table
            assert second[table].join(kept.select(*natural), natural, "left_anti").where(f"{key} <= {first[table].count()}").isEmpty(), table
    for table in ("fact_order_items", "fact_payments"):
        drop = [c for c in whole[table].columns if c.endswith(("_sk", "_date")) or c == "load_timestamp"]
        assert second[table].drop(*drop).exceptAll(whole[table].drop(*drop)).isEmpty(), table
    # A fact points at the same customer as in a load of its own.
    named = lambda t: t["fact_order_items"].join(t["dim_customer"].select("customer_sk", "customer_id"), "customer_sk").groupBy("customer_id").agg(F.count("*").alias("n"))
    assert named(second).exceptAll(named(whole)).isEmpty()
