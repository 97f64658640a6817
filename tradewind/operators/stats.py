"""Column statistics: frequencies, describe, histograms, modes, medians."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.operators.ranking import exact_quantiles


def value_counts(df: DataFrame, column: str, dropna: bool = True) -> DataFrame:
    """Rows and percentage of all rows per value.

    The percentage refers to every row of ``df``, missing values included.
    """
    total = df.agg(F.count(F.lit(1))).scalar()
    counted = (df.dropna(subset=[column]) if dropna else df).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("percentage", F.col("n") / total * 100)


def top_values(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """The k most frequent values, smaller value first on ties."""
    return value_counts(df, column).orderBy(F.desc("n"), F.asc(column)).limit(k)


def mode_value(df: DataFrame, column: str, by: list[str] = ()) -> DataFrame:
    """Most frequent value, the smallest on ties."""
    counted = df.dropna(subset=[column]).groupBy(*by, column).agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("order"), F.col(column).alias("value"))).alias("best")
    return counted.groupBy(*by).agg(best).select(*by, F.col("best.value").alias("mode"), (-F.col("best.order")).alias("n"))


def long_values(df: DataFrame, columns: list[str], keep: list[str] = ()) -> DataFrame:
    """One row per (row, column): ``column_name``, ``value`` as double."""
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in columns]
    return df.select(*keep, F.inline(F.array(*pairs)))


def describe_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum per column."""
    values = long_values(df, columns)
    moments = values.groupBy("column_name").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = exact_quantiles(values, "value", [0.25, 0.5, 0.75], by=["column_name"])
    wide = quartiles.groupBy("column_name").agg(
        *[
            F.max(F.when(F.col("probability") == p, F.col("value"))).alias(name)
            for p, name in [(0.25, "q25"), (0.5, "q50"), (0.75, "q75")]
        ]
    )
    return moments.join(wide, "column_name", "left").select(
        "column_name", "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins between minimum and maximum, empty bins included.

    The last bin holds the maximum. Each row also carries the median of the
    column, the marker drawn into the histogram.
    """
    spark = df.sparkSession
    value = F.col(column).cast("double")
    low, high = df.agg(F.min(value), F.max(value)).first()
    if low is None:
        return spark.createDataFrame([], "bin int, low double, high double, n long, median double")
    width = (high - low) / bins or 1.0
    median = exact_quantiles(df, column, [0.5]).first()["value"]
    place = F.least(F.floor((value - low) / width), F.lit(bins - 1)).cast("int")
    counted = df.where(value.isNotNull()).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    frame = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return frame.join(F.broadcast(counted), "bin", "left").select(
        "bin",
        (F.lit(low) + F.col("bin") * width).alias("low"),
        (F.lit(low) + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
        F.lit(median).alias("median"),
    )


def median_impute(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULL and NaN in numeric columns become the column's exact median."""
    medians = {
        r["column_name"]: r["value"]
        for r in exact_quantiles(long_values(df, columns), "value", [0.5], by=["column_name"]).collect()
    }
    filled = {}
    for c in columns:
        value = F.col(c).cast("double")
        filled[c] = F.coalesce(F.when(~F.isnan(value), value), F.lit(medians.get(c)).cast("double"))
    return df.withColumns(filled)


def constant_impute(df: DataFrame, defaults: dict[str, float]) -> DataFrame:
    return df.na.fill(defaults)


def monthly_resample(df: DataFrame, time: str) -> DataFrame:
    """Rows per calendar month between the first and last month, empty months as 0."""
    month = F.trunc(F.col(time).cast("date"), "month")
    counted = df.where(F.col(time).isNotNull()).groupBy(month.alias("month_start")).agg(F.count(F.lit(1)).alias("n"))
    span = counted.agg(F.min("month_start").alias("a"), F.max("month_start").alias("b"))
    months = span.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 MONTH"))).alias("month_start"))
    return months.join(counted, "month_start", "left").select(
        "month_start", F.coalesce("n", F.lit(0)).alias("n")
    )
