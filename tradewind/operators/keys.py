"""Surrogate keys that survive later loads: known natural keys keep their number, new ones are numbered after the greatest."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.operators.ranking import global_row_number
from tradewind.session import materialize, write_parquet

_COPY, _KNOWN = "_copy", "_known"


class KeyStore:
    """The keys ever given, by table: Parquet folders that are only added to, one folder a load.

    Keys are stored before the rows that carry them. A load that fails in between leaves keys behind that the next load finds and uses, so
    a key is never given twice.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def known(self, table: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.folder}/{table}/*")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def add(self, table: str, keys: DataFrame) -> None:
        if not keys.isEmpty():
            write_parquet(keys, f"{self.folder}/{table}/load-{uuid.uuid4().hex}")


def with_copy_number(df: DataFrame, columns: list[str], order: list[str]) -> DataFrame:
    """Number rows that agree in ``columns`` from 0, in ``order``, where ``columns`` and ``order`` together tell rows apart.

    Rows are ranked as a whole, and each group's least rank is subtracted, so a large group is never in one task.
    """
    rank = "_rank"
    ranked = materialize(global_row_number(df, [F.col(c).asc_nulls_last() for c in [*columns, *order]], rank), "copies")
    least = ranked.groupBy(*columns).agg(F.min(rank).alias("_least"), F.count(F.lit(1)).alias("_n"))
    repeated = least.where("_n > 1").select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(columns)], "_least")
    same = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(columns)]
    copy = F.coalesce(F.col(rank) - F.col("_least"), F.lit(0)).alias(_COPY)
    return ranked.join(repeated, _all(same), "left").select(*df.columns, copy)


def _all(conditions: list):
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def stable_key(
    df: DataFrame, name: str, natural_key: list[str], known: DataFrame | None, ties: list[str] = (), row: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows with their key first, and the keys that were given now.

    ``known`` holds the identity columns and ``name`` of earlier loads, as earlier calls gave them. The identity of a row is its natural key;
    where that may repeat, ``row`` names a frozen row number, and the identity is natural key, ``ties`` and the number of the copy. New
    rows are numbered in the order of their identity, after the greatest known key; a first load is numbered 1..n. A key that is not
    loaded any more is not given to another row; should its row come back, it has its key again.
    """
    columns = df.columns
    identity = list(natural_key)
    if row is not None:
        identity += [*ties, _COPY]
        df = with_copy_number(df, identity[:-1], [row])
    order = [F.col(c).asc_nulls_last() for c in identity]
    if known is None:
        fresh, old, start = df, None, 0
    else:
        given = known.select(*[F.col(c).alias(f"_i{i}") for i, c in enumerate(identity)], F.col(name).alias(_KNOWN))
        same = [F.col(c).eqNullSafe(F.col(f"_i{i}")) for i, c in enumerate(identity)]
        met = materialize(df.join(given, _all(same), "left").select(*df.columns, _KNOWN), "met")
        old, fresh = met.where(F.col(_KNOWN).isNotNull()), met.where(F.col(_KNOWN).isNull()).drop(_KNOWN)
        start = known.agg(F.max(name)).first()[0] or 0
    numbered = global_row_number(fresh, order, name).withColumn(name, F.col(name) + start)
    out = numbered.select(name, *columns)
    if old is not None:
        out = out.unionByName(old.select(F.col(_KNOWN).alias(name), *columns))
    return out, numbered.select(*identity, name)
