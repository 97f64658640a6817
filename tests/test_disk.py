"""What a run leaves on disk while it goes on."""

import os
from urllib.parse import urlparse

from pyspark.sql import functions as F

from conformance.star import Star
from tradewind.session import materialize, shared_folder


def shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {name for name in (blocks.apply(i).name() for i in range(blocks.length())) if name.startswith("shuffle_")}


def test_a_written_table_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    rows = materialize(spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count())
    assert not shuffle_files(spark) - before
    assert sorted(r["count"] for r in rows.collect()) == [100] * 10


def test_a_table_of_the_star_leaves_no_intermediates(spark):
    folder = urlparse(shared_folder(spark)).path
    before = set(os.listdir(folder))
    tables = Star(spark, "/root/testdata/sf0.001")
    assert tables["fact_payments"].count() == 1816
    assert [name for name in set(os.listdir(folder)) - before if not name.startswith("star-")] == []
    assert tables["stg_payments"].columns[-1] == "record_hash"
