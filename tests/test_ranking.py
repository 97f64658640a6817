"""Ranks and quantiles against pandas and numpy, with one value on a third of the rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tradewind.operators import ranking


def skewed(spark, n=3000):
    value = F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise((F.col("id") * 7919 % 1009).cast("double"))
    return spark.range(n).select("id", value.alias("v"))


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_row_number_does_not_depend_on_partitions(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        got = ranking.global_row_number(skewed(spark), [F.desc("v"), F.asc("id")], "r").toPandas()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = got.sort_values(["v", "id"], ascending=[False, True])["r"].tolist()
    assert want == list(range(1, 3001))


def test_equal_rows_all_get_a_number(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"))
    got = ranking.surrogate_key(df, "sk", ["k"], unique=False).toPandas()
    assert sorted(got["sk"]) == list(range(1, 1001))
    assert got[got["k"] == 0]["sk"].max() == 500


def test_hot_value_is_spread_over_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = ranking.global_row_number(skewed(spark, 30000), ["v", "id"], "r")
        sizes = ranked.where("v = 7.0").groupBy(F.input_file_name()).count().toPandas()["count"]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) >= 3 and sizes.max() < 30000 / 4


PROBABILITIES = [0.0, 0.2, 0.25, 0.5, 0.77, 1.0]


def quantiles(df):
    return {r["probability"]: r["value"] for r in ranking.exact_quantiles(df, "v", PROBABILITIES).collect()}


def test_exact_quantiles(spark):
    df = skewed(spark)
    got, values = quantiles(df), df.toPandas()["v"]
    for p in PROBABILITIES:
        assert got[p] == pytest.approx(np.quantile(values, p))


@pytest.mark.parametrize("copies", [1, 100])
def test_exact_quantiles_are_the_same_for_every_partitioning(spark, copies):
    value = (F.rand(3) * 1e6).alias("v")
    once = spark.createDataFrame(spark.range(700).select(value).collect(), "v double")
    df = once.crossJoin(F.broadcast(spark.range(copies).select("id")))
    values = np.sort(df.toPandas()["v"].to_numpy())
    want = {}
    for p in PROBABILITIES:
        h = p * (len(values) - 1)
        a, b = values[int(np.floor(h))], values[int(np.ceil(h))]
        want[p] = a + (b - a) * (h - np.floor(h))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in (1, 8, 64):
            spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
            assert quantiles(df.repartition(partitions)) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_exact_quantiles_by_group(spark):
    df = skewed(spark).withColumn("g", F.col("id") % 3)
    got = ranking.exact_quantiles(df, "v", [0.5, 0.9], by=["g"]).toPandas()
    want = df.toPandas().groupby("g")["v"].quantile([0.5, 0.9])
    assert len(got) == 6
    for _, r in got.iterrows():
        assert r["value"] == pytest.approx(want[(r["g"], r["probability"])])


@pytest.mark.parametrize("n", [5, 6, 7, 11, 100, 399])
def test_rank_scores_equal_qcut(spark, n):
    df = spark.range(n).select("id", (F.col("id") % 4).alias("v"))
    got = ranking.score_by_rank(df, "v", "id", "s").orderBy("id").toPandas()
    want = pd.qcut(got.sort_values(["v", "id"])["v"].rank(method="first"), 5, labels=[1, 2, 3, 4, 5]).sort_index()
    assert got["s"].tolist() == want.astype(int).tolist()


def test_value_scores_equal_qcut_and_survive_ties(spark):
    df = spark.range(101).select("id", (F.col("id") * 37 % 101).alias("v"))
    got = ranking.score_by_value(df, "v", "s").toPandas()
    want = pd.qcut(got["v"], 5, labels=[5, 4, 3, 2, 1]).astype(int)
    assert got["s"].tolist() == want.tolist()
    same = ranking.score_by_value(spark.range(9).select(F.lit(4).alias("v")), "v", "s").toPandas()
    assert same["s"].tolist() == [5] * 9
