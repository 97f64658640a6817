"""Register of queries with their expected results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conformance.ctes import expected

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
EXPECTED: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` states its expected result over the test tables."""

    def register(run: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: comparable(run(spark, sf_dir))
        if sql is not None:
            EXPECTED[name] = expected(sql)
        return run

    return register


def comparable(df: DataFrame) -> DataFrame:
    """Times as text and decimals as doubles, so that two engines print them alike.

    Load times are left out, since they differ from run to run.
    """
    out = []
    for field in df.schema:
        c = F.col(f"`{field.name}`")
        if field.name in ("created_date", "updated_date", "last_updated", "load_timestamp", "effective_start_date"):
            continue
        if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        out.append(c.alias(field.name))
    return df.select(*out)
