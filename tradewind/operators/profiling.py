"""Profiling and business-rule validation of source tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions.text import parse_timestamp
from tradewind.operators.ranking import global_row_number

# Thresholds of the load gate and the target compliance rate.
MAX_MISSING_PERCENT = 10.0
TARGET_COMPLIANCE = 95.0


def _missing(df: DataFrame, column: str):
    c = F.col(f"`{column}`")
    floating = isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType))
    return c.isNull() | F.isnan(c) if floating else c.isNull()


def _missing_counts(df: DataFrame) -> DataFrame:
    """One pass: rows and missing values per column, as rows."""
    counted = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(_missing(df, c)).alias(f"m{i}") for i, c in enumerate(df.columns)],
    )
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(f"m{i}").alias("missing")) for i, c in enumerate(df.columns)]
    return counted.select("total", F.inline(F.array(*pairs)))


def profile_structure(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, columns, columns per kind of type, and missing values of each table."""
    reports = []
    for name, df in tables.items():
        numeric = sum(isinstance(f.dataType, T.NumericType) for f in df.schema)
        textual = sum(isinstance(f.dataType, T.StringType) for f in df.schema)
        reports.append(
            _missing_counts(df).groupBy(F.lit(name).alias("table_name")).agg(
                F.max("total").alias("n_rows"),
                F.lit(len(df.columns)).alias("n_columns"),
                F.lit(numeric).alias("numeric_columns"),
                F.lit(textual).alias("text_columns"),
                F.sum("missing").alias("missing_values"),
            )
        )
    return reduce(DataFrame.unionByName, reports)


def missing_report(df: DataFrame) -> DataFrame:
    """Missing count and percentage of the columns that miss something."""
    return _missing_counts(df).where("missing > 0").select(
        "column_name", "missing", (F.col("missing") / F.col("total") * 100).alias("missing_pct")
    )


def per_table(report: Callable[[DataFrame], DataFrame], tables: dict[str, DataFrame]) -> DataFrame:
    """One of the column or row reports over every table, each named in ``table_name``."""
    parts = [report(df).select(F.lit(name).alias("table_name"), "*") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def key_uniqueness(df: DataFrame, columns: list[str] | None = None, approximate: bool = False) -> DataFrame:
    """Distinct values and their share of the rows, per identifier column.

    Exact counting goes through one row per (column, value); ``approximate``
    replaces it by a sketch.
    """
    columns = columns or [c for c in df.columns if "id" in c.lower()]
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
    values = df.select(F.inline(F.array(*pairs)))
    if approximate:
        counted = values.groupBy("column_name").agg(
            F.approx_count_distinct("value").alias("distinct_values"), F.count(F.lit(1)).alias("n_rows")
        )
    else:
        grouped = values.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("_n"))
        counted = grouped.groupBy("column_name").agg(
            F.count("value").alias("distinct_values"), F.sum("_n").alias("n_rows")
        )
    return counted.withColumn("uniqueness", F.col("distinct_values") / F.col("n_rows"))


def date_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if "date" in c.lower() or "time" in c.lower()]


def date_range_report(df: DataFrame) -> DataFrame:
    """Earliest and latest value of the date-like columns; texts that cannot be read are flagged."""
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in date_columns(df)]
    values = df.select(F.inline(F.array(*pairs)))
    parsed = F.col("value").try_cast("timestamp_ntz")
    return values.groupBy("column_name").agg(
        F.min(parsed).alias("first_time"),
        F.max(parsed).alias("last_time"),
        (F.count_if(F.col("value").isNotNull() & parsed.isNull()) > 0).alias("conversion_failed"),
    )


def referential_report(checks: dict[str, tuple[DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Number of distinct child keys without a parent, per relationship."""
    reports = []
    for name, (child, column, parent, parent_column) in checks.items():
        keys = child.select(F.col(column).alias("_k")).dropna().distinct()
        orphans = keys.join(parent.select(F.col(parent_column).alias("_k")), "_k", "left_anti")
        reports.append(orphans.agg(F.count(F.lit(1)).alias("orphaned_keys")).withColumn("relationship", F.lit(name)))
    return reduce(DataFrame.unionByName, reports).select("relationship", "orphaned_keys")


# Item numbering within an order


def order_sequences(items: DataFrame) -> DataFrame:
    """Per order: number of items, smallest, largest and distinct positions.

    Sorted positions equal 1..n exactly when the smallest is 1, the largest is
    n and all n are distinct, so no order's positions need to be gathered.
    Distinct positions are counted over one row per (order, position).
    """
    positions = items.groupBy("order_id", "order_item_id").agg(F.count(F.lit(1)).alias("_n"))
    return positions.groupBy("order_id").agg(
        F.sum("_n").alias("n_items"),
        F.min("order_item_id").alias("first_item"),
        F.max("order_item_id").alias("last_item"),
        F.count("order_item_id").alias("n_positions"),
    )


def _broken():
    n = F.col("n_items")
    return ~((F.col("first_item") == 1) & (F.col("last_item") == n) & (F.col("n_positions") == n))


def sequence_not_from_one(items: DataFrame) -> DataFrame:
    return order_sequences(items).where("first_item <> 1").select("order_id", "first_item")


def sequence_gaps(items: DataFrame) -> DataFrame:
    """Orders whose sorted positions are not 1..n."""
    return order_sequences(items).where(_broken()).select("order_id", "n_items")


def sequence_duplicates(items: DataFrame) -> DataFrame:
    """(order, position) pairs that occur more than once."""
    return items.groupBy("order_id", "order_item_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def sequence_examples(items: DataFrame, ties: list[str], k: int = 3) -> DataFrame:
    """The first k broken orders: the actual and the expected position of each of their items.

    One row per item in sorted order, so that a very long order is not gathered.
    """
    chosen = sequence_gaps(items).orderBy("order_id").limit(k).select("order_id")
    positions = items.select("order_id", "order_item_id", *ties).join(F.broadcast(chosen), "order_id", "left_semi")
    return resequence_items(positions, ties).select(
        "order_id", F.col("order_item_id").alias("actual"), F.col("corrected_item_id").alias("expected")
    )


def sequence_compliance(items: DataFrame) -> DataFrame:
    """Compliant orders = orders − broken − not starting at 1.

    An order that does not start at 1 is also broken and is subtracted twice;
    that is the published rule. ``integrity_pct`` counts each order once. Without
    orders the rates and ``meets_target`` are NULL.
    """
    report = order_sequences(items).agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count_if(_broken()).alias("orders_with_gaps"),
        F.count_if(F.col("first_item") != 1).alias("orders_not_from_one"),
    )
    compliant = F.col("total_orders") - F.col("orders_with_gaps") - F.col("orders_not_from_one")
    report = report.withColumn("compliant_orders", compliant)
    return report.withColumns(
        {
            "compliance_rate": F.try_divide("compliant_orders", "total_orders") * 100,
            "integrity_pct": F.try_divide(F.col("total_orders") - F.col("orders_with_gaps"), F.col("total_orders")) * 100,
        }
    ).withColumn("meets_target", F.col("compliance_rate") >= TARGET_COMPLIANCE)


def resequence_items(items: DataFrame, ties: list[str]) -> DataFrame:
    """Number the items of each order 1..n by position, then by ``ties``.

    Numbers come from a global rank minus the order's first rank, so an order
    with very many items is still spread over tasks.
    """
    order = [F.col(c).asc_nulls_last() for c in ["order_id", "order_item_id", *ties]]
    ranked = global_row_number(items, order, "_rank", unique=False)
    first = ranked.groupBy("order_id").agg(F.min("_rank").alias("_first"))
    return ranked.join(first, "order_id").select(
        *items.columns, (F.col("_rank") - F.col("_first") + 1).cast("int").alias("corrected_item_id")
    )


# Timestamps


def timestamp_quality(orders: DataFrame, columns: list[str]) -> DataFrame:
    """Valid and missing timestamps per column, and their range."""
    pairs = [F.struct(F.lit(c).alias("column_name"), parse_timestamp(c).alias("value")) for c in columns]
    values = orders.select(F.inline(F.array(*pairs)))
    report = values.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("total"),
        F.count("value").alias("valid"),
        F.min("value").alias("first_time"),
        F.max("value").alias("last_time"),
    )
    missing = F.col("total") - F.col("valid")
    return report.withColumns({"missing": missing, "missing_pct": missing / F.col("total") * 100})


def timestamp_progression(orders: DataFrame, first: str, second: str, third: str) -> DataFrame:
    """Among orders that have all three times: how many keep their order."""
    a, b, c = (parse_timestamp(x) for x in (first, second, third))
    present = a.isNotNull() & b.isNotNull() & c.isNotNull()
    report = orders.agg(
        F.count_if(present).alias("total_with_timestamps"), F.count_if(present & (a <= b) & (b <= c)).alias("valid_progression")
    )
    return report.withColumn(
        "progression_rate", F.try_divide(F.col("valid_progression"), F.col("total_with_timestamps")) * 100
    )


def threshold_gate(tables: dict[str, DataFrame], items: DataFrame, references: DataFrame) -> DataFrame:
    """Pass or fail of the three declared load thresholds, over all given tables.

    A table without rows misses nothing; without any table or reference the
    measured value is 0.
    """
    missing = reduce(
        DataFrame.unionByName, [_missing_counts(df).withColumn("table_name", F.lit(n)) for n, df in tables.items()]
    )
    worst = missing.agg(F.coalesce(F.max(F.try_divide("missing", "total") * 100), F.lit(0.0)).alias("measured"))
    gates = [
        ("max_missing_percentage", worst, MAX_MISSING_PERCENT),
        ("validate_order_sequence", sequence_gaps(items).agg(F.count(F.lit(1)).cast("double").alias("measured")), 0.0),
        ("enforce_referential_integrity", references.agg(F.coalesce(F.sum("orphaned_keys"), F.lit(0)).cast("double").alias("measured")), 0.0),
    ]
    return reduce(
        DataFrame.unionByName,
        [
            df.select(
                F.lit(name).alias("gate"), "measured", F.lit(limit).alias("allowed"),
                (F.col("measured") <= limit).alias("passed"),
            )
            for name, df, limit in gates
        ],
    )
