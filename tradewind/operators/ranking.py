"""Global ranks, surrogate keys and quantile scores without a one-task window.

A window without PARTITION BY sends every row to one task. Here rows are range
partitioned on the *whole* sort key (value and tie-break, so that one frequent
value is split over many partitions), sorted inside their partition, and
written once. The written partition number and row position are then fixed, and
a rank is position + rows in earlier partitions. The only thing that reaches
the driver is one count per partition.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.functions.text import as_column
from tradewind.session import materialize

_PART, _SEQ, _POS, _OFFSET = "_part", "_seq", "_pos", "_offset"
_ROW_BITS = (1 << 33) - 1


def with_row_position(df: DataFrame, name: str = _POS) -> DataFrame:
    """Give every row a unique number that no later retry can change."""
    return materialize(df.withColumn(name, F.monotonically_increasing_id()), "positions")


def global_row_number(
    df: DataFrame, order_by: list[Column | str], name: str = "row_number", unique: bool = True
) -> DataFrame:
    """Dense 1..n numbers in the order of ``order_by``.

    ``unique=False`` says that whole sort keys may repeat. Then a frozen row
    position is the last tie-break, so a large group of equal rows is still
    spread over partitions.
    """
    order = [as_column(c) for c in order_by]
    columns = df.columns
    if not unique:
        df = with_row_position(df)
        order.append(F.col(_POS))
    return _numbered(df, columns, order, name)[0]


def _numbered(df: DataFrame, columns: list[str], order: list[Column], name: str) -> tuple[DataFrame, int]:
    """The numbered rows, and how many there are."""
    ranged = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(_PART, F.spark_partition_id())
        .withColumn(_SEQ, F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)))
    )
    table = materialize(ranged.select(*columns, _PART, _SEQ), "ranked")
    offsets, total = _partition_offsets(table, F.count(F.lit(1)))
    return table.join(F.broadcast(offsets), _PART).select(
        *columns, (F.col(_OFFSET) + F.col(_SEQ) + 1).alias(name)
    ), total


def surrogate_key(df: DataFrame, name: str, natural_key: list[str], ties: list[str] = (), unique: bool = True) -> DataFrame:
    """Number rows 1..n in natural-key order and put the key first."""
    order = [F.col(c).asc_nulls_last() for c in [*natural_key, *ties]]
    keyed = global_row_number(df, order, name, unique=unique)
    return keyed.select(name, *df.columns)


def exact_quantiles(df: DataFrame, column: str, probabilities: list[float], by: list[str] = ()) -> DataFrame:
    """Exact quantiles with linear interpolation: columns ``by``, probability, value.

    Of n values, the quantile of p stands at h = p * (n - 1): with a and b the
    values at floor(h) and ceil(h), it is a + (b - a) * (h - floor(h)), whatever
    the size and partitioning of the input. Equal values are counted together,
    the counts are range partitioned, and only the partitions that hold a wanted
    position are looked at. NULL and NaN are ignored.
    """
    by = list(by)
    value = F.col(column).cast("double")
    data = df.select(*by, value.alias("_v")).where(value.isNotNull() & ~F.isnan(value))
    keys = by or ["_all"]
    if not by:
        data = data.withColumn("_all", F.lit(1))
    counted = data.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n"))
    ranged = counted.repartitionByRange(*keys, "_v").withColumn(_PART, F.spark_partition_id())
    table = materialize(ranged, "values")

    # One row per (group, partition): rows of the group in earlier partitions.
    earlier = Window.partitionBy(*keys).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    parts = table.groupBy(*keys, _PART).agg(F.sum("_n").alias("_size"))
    parts = parts.withColumn("_start", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))

    # The two positions between which each probability falls.
    positions = table.groupBy(*keys).agg(F.sum("_n").alias("_total")).withColumn(
        "probability", F.explode(F.array(*[F.lit(float(p)) for p in probabilities]))
    )
    positions = positions.withColumn("_h", F.col("probability") * (F.col("_total") - 1))
    hits = parts.join(positions, keys).where(
        (F.ceil("_h") >= F.col("_start")) & (F.floor("_h") < F.col("_start") + F.col("_size"))
    )

    # Running counts only inside the partitions that hold a wanted position.
    in_part = Window.partitionBy(*keys, _PART).orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    wanted = table.join(hits.select(*keys, _PART).distinct(), [*keys, _PART], "left_semi")
    first = F.col("_start") + F.coalesce(F.col("_before"), F.lit(0))
    located = wanted.withColumn("_before", F.sum("_n").over(in_part)).join(hits, [*keys, _PART])
    covers = lambda p: (p >= first) & (p < first + F.col("_n"))
    ends = (
        located.where(covers(F.floor("_h")) | covers(F.ceil("_h")))
        .groupBy(*keys, "probability", "_h")
        .agg(F.min("_v").alias("_a"), F.max("_v").alias("_b"))
    )
    between = F.col("_a") + (F.col("_b") - F.col("_a")) * (F.col("_h") - F.floor("_h"))
    return ends.select(*by, "probability", between.alias("value"))


def quantile_score_rank(rank: Column | str, total: Column | str, bins: int = 5) -> Column:
    """Score 1..bins of a 1..total rank, with bins closed on the right."""
    r, n = as_column(rank).cast("long"), as_column(total).cast("long")
    gaps = F.greatest(n - 1, F.lit(1))
    # Rounding up in whole numbers: a division in floating point can miss a bin edge.
    scaled = (r - 1) * bins + gaps - 1
    return F.greatest(F.lit(1), (scaled - F.pmod(scaled, gaps)) / gaps).cast("int")


def score_by_rank(df: DataFrame, column: str, tie: str, name: str, bins: int = 5) -> DataFrame:
    """Quantile score of a value whose ties are broken by a unique column.

    Only value and tie column are sorted and written; the score is joined back by the tie column.
    """
    narrow = df.select(tie, column)
    ranked, total = _numbered(narrow, narrow.columns, [F.col(column).asc_nulls_last(), F.col(tie).asc()], "_rank")
    scores = ranked.select(tie, quantile_score_rank("_rank", F.lit(total), bins).alias(name))
    return df.join(scores, tie).select(*df.columns, name)


def score_by_value(df: DataFrame, column: str, name: str, labels: list[int] = (5, 4, 3, 2, 1)) -> DataFrame:
    """Quantile score on the values themselves; equal values share a score.

    Where quantile edges coincide, a value goes to the lowest bin that holds it.
    """
    bins = len(labels)
    rows = exact_quantiles(df, column, [i / bins for i in range(1, bins)]).collect()
    edges = [r["value"] for r in sorted(rows, key=lambda r: r["probability"])]
    value = F.col(column)
    score = reduce(
        lambda chain, pair: chain.when(value <= F.lit(pair[0]), F.lit(pair[1])),
        list(zip(edges, labels))[1:],
        F.when(value <= F.lit(edges[0]), F.lit(labels[0])),
    )
    return df.withColumn(name, F.when(value.isNotNull(), score.otherwise(F.lit(labels[-1]))).cast("int"))


def _partition_offsets(table: DataFrame, size: Column) -> tuple[DataFrame, int]:
    """Rows in earlier partitions, one row per partition (bounded by their number), and rows in all."""
    sizes = sorted(table.groupBy(_PART).agg(size.alias("n")).collect())
    offsets, total = [], 0
    for part, n in sizes:
        offsets.append((part, total))
        total += n
    return table.sparkSession.createDataFrame(offsets, f"{_PART} int, {_OFFSET} long"), total
