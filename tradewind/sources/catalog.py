"""Catalogue queries: tables, columns and stored sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_tables(spark: SparkSession, databases: list[str]) -> DataFrame:
    rows = [(db, t.name) for db in databases for t in spark.catalog.listTables(db) if not t.isTemporary]
    return spark.createDataFrame(rows, "layer string, table_name string")


def tables_per_layer(spark: SparkSession, databases: list[str]) -> DataFrame:
    return list_tables(spark, databases).groupBy("layer").agg(F.count(F.lit(1)).alias("table_count"))


def list_columns(spark: SparkSession, database: str, table: str) -> DataFrame:
    """Columns in declared order."""
    columns = spark.catalog.listColumns(f"{database}.{table}")
    rows = [(i, c.name, c.dataType) for i, c in enumerate(columns, start=1)]
    return spark.createDataFrame(rows, "position int, column_name string, data_type string")


def table_sizes(spark: SparkSession, databases: list[str]) -> DataFrame:
    """Stored bytes per table, as numbers; sums per layer are a plain GROUP BY."""
    rows = []
    for db in databases:
        for t in spark.catalog.listTables(db):
            if t.isTemporary:
                continue
            name = f"{db}.{t.name}"
            spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS NOSCAN")
            described = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Statistics'").first()
            size = int(described["data_type"].split()[0]) if described else 0
            rows.append((db, t.name, size))
    return spark.createDataFrame(rows, "layer string, table_name string, size_bytes long")
