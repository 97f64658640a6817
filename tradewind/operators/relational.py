"""Filters, samples, set operations and de-duplication."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.text import has_value

# Fixed value: order status that counts as a completed purchase.
DELIVERED = "delivered"


def valid_token_filter(df: DataFrame, column: str) -> DataFrame:
    """Rows whose text is present and not a missing-value token."""
    return df.where(has_value(column))


def delivered_orders(orders: DataFrame, status: str = "order_status", purchase: str = "order_purchase_timestamp") -> DataFrame:
    return orders.where((F.col(status) == DELIVERED) & F.col(purchase).isNotNull())


def current_version(df: DataFrame) -> DataFrame:
    return df.where("is_current")


def positive(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) > 0)


def optional_predicates(df: DataFrame, at_least: dict[str, object] = {}, at_most: dict[str, object] = {}) -> DataFrame:
    """Bounds whose value is None are left out; a NULL column value fails a bound."""
    for column, bound in at_least.items():
        if bound is not None:
            df = df.where(F.col(column) >= F.lit(bound))
    for column, bound in at_most.items():
        if bound is not None:
            df = df.where(F.col(column) <= F.lit(bound))
    return df


def label_contains(df: DataFrame, label: str, part: str) -> DataFrame:
    return df.where(F.col(label).contains(part))


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows chosen by a seeded hash of a unique key; the same rows every time, on any engine.

    The rows with the ``n`` smallest md5 values of ``seed:key`` are wanted. One pass over the key alone counts the rows by the first 16 bits;
    the counts tell the last of these ranges that is needed, so the sort gets ``n`` rows and the rest of one range.
    A key that is missing is hashed as an empty text; of equal keys any come first.
    """
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    hashed = df.withColumn("_hash", F.md5(name))
    counts = hashed.groupBy(F.substring("_hash", 1, 4).alias("range")).count().orderBy("range").collect()
    total, last = 0, ""
    for row in counts:
        total, last = total + row["count"], row["range"]
        if total >= n:
            break
    return hashed.where(F.substring("_hash", 1, 4) <= F.lit(last)).orderBy("_hash", key).limit(n).drop("_hash")


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the smallest in the given ascending order, NULLs first.

    A minimum over the sort values followed by the rest of the row; it is
    reduced before the shuffle, however many rows share a key.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(order)], *rest)
    return df.groupBy(*keys).agg(F.min(ranked).alias("_first")).select(
        *[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns]
    )


def duplicate_row_count(df: DataFrame) -> DataFrame:
    """How many rows repeat an earlier identical row."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"))


def key_set_difference(left: DataFrame, right: DataFrame, key: str, right_key: str | None = None) -> DataFrame:
    """Distinct non-null keys of ``left`` that ``right`` does not have."""
    return left.select(key).dropna().subtract(right.select(F.col(right_key or key).alias(key)))


def table_counts(tables: dict[str, DataFrame | None], layers: dict[str, str]) -> DataFrame:
    """Rows per table with its layer; a table that cannot be read counts 0."""
    present = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(layers[name]).alias("layer"), F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
        if df is not None
    ]
    counts = reduce(DataFrame.unionByName, present)
    absent = [(layers[name], name, 0) for name, df in tables.items() if df is None]
    if absent:
        spark = counts.sparkSession
        counts = counts.unionByName(spark.createDataFrame(absent, "layer string, table_name string, row_count long"))
    return counts


def layer_totals(counts: DataFrame) -> DataFrame:
    return counts.groupBy("layer").agg(
        F.count(F.lit(1)).alias("table_count"), F.sum("row_count").alias("row_count")
    )


def row_count_pivot(counts: DataFrame, tables: list[str]) -> DataFrame:
    """One row per layer, one column per table."""
    return counts.groupBy("layer").pivot("table_name", tables).agg(F.sum("row_count"))
