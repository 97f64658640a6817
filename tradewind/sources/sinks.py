"""Sinks: warehouse tables, exports, appended loads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.operators.quality import UNIQUE_KEYS, check_unique
from tradewind.session import write_parquet
from tradewind.sources.files import observed
from tradewind.sources.schemas import LAYERS, table_schema


def layer_namespaces(spark: SparkSession, prefix: str = "") -> list[str]:
    """Create the layer databases if they are missing."""
    names = [prefix + layer for layer in LAYERS]
    for name in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    return names


def overwrite_staging(df: DataFrame, database: str, table: str) -> int:
    """Replace table and layout."""
    counted, seen = observed(df, table)
    counted.write.mode("overwrite").option("overwriteSchema", "true").format("parquet").saveAsTable(f"{database}.{table}")
    return seen.get["rows"]


def truncate_load(df: DataFrame, database: str, table: str) -> int:
    """Replace all rows, keep the declared layout."""
    spark = df.sparkSession
    schema = table_schema(table)
    name = f"{database}.{table}"
    if not spark.catalog.tableExists(name):
        spark.createDataFrame([], schema).write.format("parquet").saveAsTable(name)
    counted, seen = observed(df.select(*[F.col(f.name).cast(f.dataType) for f in schema]), table)
    counted.write.insertInto(name, overwrite=True)
    return seen.get["rows"]


def append_load(df: DataFrame, database: str, table: str) -> int:
    """Append after checking that no declared key repeats, within the rows or with stored ones."""
    spark = df.sparkSession
    name = f"{database}.{table}"
    stored = spark.table(name) if spark.catalog.tableExists(name) else None
    for columns in UNIQUE_KEYS.get(table, []):
        keys = list(columns)
        if not set(keys) <= set(df.columns):
            continue
        if not check_unique(df, table, columns).isEmpty():
            raise ValueError(f"{name}: rows that repeat {', '.join(keys)}")
        if stored is not None and not df.select(*keys).join(stored.select(*keys), keys, "left_semi").isEmpty():
            raise ValueError(f"{name}: rows with existing {', '.join(keys)}")
    counted, seen = observed(df, table)
    counted.write.mode("append").format("parquet").saveAsTable(name)
    return seen.get["rows"]


def mart_load(df: DataFrame, database: str, table: str) -> int:
    """Replace the rows of a mart."""
    counted, seen = observed(df, table)
    counted.write.mode("overwrite").format("parquet").saveAsTable(f"{database}.{table}")
    return seen.get["rows"]


def folder_sink(folder: str) -> Callable[[str, str, DataFrame], tuple[DataFrame, int]]:
    """A sink for a warehouse run that writes ``folder/layer/table`` as Parquet."""

    def write(layer: str, table: str, rows: DataFrame) -> tuple[DataFrame, int]:
        path = f"{folder.rstrip('/')}/{layer}/{table}"
        counted, seen = observed(rows, table)
        write_parquet(counted, path, "overwrite")
        return rows.sparkSession.read.schema(rows.schema).parquet(path), seen.get["rows"]

    return write


def catalog_sink(spark: SparkSession, prefix: str = "") -> Callable[[str, str, DataFrame], tuple[DataFrame, int]]:
    """A sink for a warehouse run that loads catalogue tables."""
    layer_namespaces(spark, prefix)

    def write(layer: str, table: str, rows: DataFrame) -> tuple[DataFrame, int]:
        database = prefix + layer
        load = {"staging": overwrite_staging, "rejected": overwrite_staging, "marts": mart_load}.get(layer, truncate_load)
        n = load(rows, database, table)
        return spark.table(f"{database}.{table}"), n

    return write


def csv_export(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """Headered CSV files; quotes inside values are doubled."""
    out = df.select(*columns) if columns else df
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
