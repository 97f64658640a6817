"""Loads that become visible in one step."""

import uuid

import pytest
from pyspark.sql import functions as F

from conformance.fixtures import STAGING, staging
from tradewind.plans import warehouse
from tradewind.session import shared_folder
from tradewind.sources.publication import Journal, Publication, published, recover, restore, retire
from tradewind.sources.schemas import LAYERS

SF = "/root/testdata/sf0.001"


@pytest.fixture
def place(spark):
    """A folder and a prefix of databases of its own."""
    prefix = f"p{uuid.uuid4().hex[:10]}_"
    for layer in LAYERS:
        spark.sql(f"CREATE DATABASE {prefix}{layer} LOCATION '{shared_folder(spark)}/{prefix}{layer}'")
    return f"{shared_folder(spark)}/{prefix}loads", prefix


def sellers(spark, *keys):
    return spark.createDataFrame([(k, f"s{k}") for k in keys], "seller_sk long, seller_id string").select(
        "*", *[F.lit(None).cast(t).alias(c) for c, t in (
            ("seller_zip_code_prefix", "string"), ("seller_city", "string"), ("seller_state", "string"), ("seller_region", "string"),
            ("record_hash", "string"), ("created_date", "timestamp"), ("updated_date", "timestamp"), ("is_active", "boolean"))],
    )


def seen(spark, place):
    """Keys by folder and by catalogue."""
    folder, prefix = place
    return (
        sorted(r[0] for r in published(spark, folder)["dimensions", "dim_seller"].select("seller_sk").collect()),
        sorted(r[0] for r in spark.table(f"{prefix}dimensions.dim_seller").select("seller_sk").collect()),
    )


def publish(spark, place, rows, table="dim_seller", layer="dimensions"):
    with Publication(spark, *place, catalogue=True) as sink:
        return sink(layer, table, rows)


def test_a_load_replaces_the_one_before(spark, place):
    publish(spark, place, sellers(spark, 1, 2))
    reader = published(spark, place[0])["dimensions", "dim_seller"]
    publish(spark, place, sellers(spark, 2, 3, 4))
    assert seen(spark, place) == ([2, 3, 4], [2, 3, 4])
    assert reader.count() == 2  # goes on with what it opened
    publish(spark, place, sellers(spark))
    assert seen(spark, place) == ([], [])


def test_an_error_inside_a_write_leaves_the_old_tables_whole(spark, place):
    with Publication(spark, *place, catalogue=True) as sink:
        sink("dimensions", "dim_seller", sellers(spark, 1, 2))
        sink("rejected", "dim_seller", sellers(spark, 9, 9))
    broken = sellers(spark, 3, 4, 5).withColumn("seller_id", F.when(F.col("seller_sk") < 5, "x").otherwise(F.raise_error(F.lit("disk gone"))))
    with pytest.raises(Exception, match="disk gone"):
        with Publication(spark, *place, catalogue=True) as sink:
            sink("rejected", "dim_seller", sellers(spark, 7))
            sink("dimensions", "dim_seller", broken)
    assert seen(spark, place) == ([1, 2], [1, 2])
    assert published(spark, place[0])["rejected", "dim_seller"].count() == 2
    assert Journal(spark, place[0]).numbers() == [1]


def test_tables_that_fail_their_check_are_not_published(spark, place):
    publish(spark, place, sellers(spark, 1))
    with pytest.raises(ValueError, match="repeat seller_sk"):
        publish(spark, place, sellers(spark, 5, 5))
    with pytest.raises(ValueError, match="3 rows were written, 2 are stored"):
        with Publication(spark, *place) as sink:
            rows, n = sink("dimensions", "dim_seller", sellers(spark, 1, 2, 3))
            version = sink.written["dimensions", "dim_seller"]
            sellers(spark, 1, 2).write.mode("overwrite").parquet(version.path)
    assert seen(spark, place) == ([1], [1])


def test_of_two_loads_at_once_the_later_is_refused(spark, place):
    first, second = Publication(spark, *place), Publication(spark, *place)
    with pytest.raises(RuntimeError, match="another run"):
        with second:
            with first:
                first("dimensions", "dim_seller", sellers(spark, 1))
            second("dimensions", "dim_seller", sellers(spark, 2))
    recover(spark, *place)
    assert seen(spark, place) == ([1], [1])


def test_interrupted_entries_do_not_count_and_pointers_are_finished(spark, place):
    folder, prefix = place
    publish(spark, place, sellers(spark, 1))
    journal = Journal(spark, folder)
    half = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(journal.path, f"{2:012d}")
    out = journal.files.create(half, False)
    out.write(b'{"layer": "dimensions", "tab')
    out.close()
    assert journal.latest().number == 1 and recover(spark, folder, prefix) == []
    with Publication(spark, folder, prefix) as sink:  # the driver is lost before the catalogue follows
        sink("dimensions", "dim_seller", sellers(spark, 1, 2))
    assert seen(spark, place) == ([1, 2], [1])
    assert recover(spark, folder, prefix) == [f"{prefix}dimensions.dim_seller"]
    assert recover(spark, folder, prefix) == [] and seen(spark, place) == ([1, 2], [1, 2])
    assert journal.latest().number == 3


def test_earlier_loads_come_back_and_old_ones_go(spark, place):
    folder, prefix = place
    for k in (1, 2, 3):
        publish(spark, place, sellers(spark, k))
    restore(spark, folder, 1)
    recover(spark, folder, prefix)
    assert seen(spark, place) == ([1], [1])
    assert retire(spark, folder, keep=2) == 1  # of loads 4 (= 1), 3, 2 and 1
    assert seen(spark, place) == ([1], [1])
    with pytest.raises(Exception):
        restore(spark, folder, 2)


def test_tables_a_load_does_not_write_stay_and_layouts_may_change(spark, place):
    folder, prefix = place
    publish(spark, place, sellers(spark, 1))
    publish(spark, place, spark.createDataFrame([("a",)], "seller_id string"), "stg_sellers", "staging")
    publish(spark, place, spark.createDataFrame([("a", 1)], "seller_id string, more int"), "stg_sellers", "staging")
    assert seen(spark, place) == ([1], [1])
    assert spark.table(f"{prefix}staging.stg_sellers").columns == ["seller_id", "more"]


def test_a_whole_load(spark, place):
    folder, prefix = place
    tables = staging(spark, SF)
    with Publication(spark, folder, prefix, catalogue=True) as sink:
        loaded, summary = warehouse.run_warehouse(spark, {t: tables[t] for t in STAGING}, sink)
        assert published(spark, folder) == {}
    for r in summary.collect():
        assert spark.table(f"{prefix}{r['layer']}.{r['table_name']}").count() == r["rows"], r["table_name"]
