"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.arrays import written


def _fingerprint(edges: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(h.cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _star(edges: DataFrame, both: bool) -> DataFrame:
    """Join neighbours to the least neighbour; ``both`` is the large star, which moves only larger neighbours.

    The least neighbour is an aggregate, reduced before the shuffle, so a hub is one row on its side of the join and the
    many rows on the other side may be split by adaptive execution.
    """
    if both:
        around = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        around = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    # A computed key hides that the aggregate is partitioned already: both sides are shuffled for the join, so a hub can be split.
    keyed = least.select((F.col("u") + F.lit(0)).alias("k"), "m")
    joined = around.join(keyed, F.col("u") == F.col("k"))
    if both:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        # The node itself is also moved to its least neighbour.
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Rows (u, v): every node that has an edge to a smaller node of its component, with the component's least node v.

    ``edges`` has long columns u and v; loops, repeated edges, both directions and an empty table are allowed, nulls are
    ignored. Nodes not named in the result are the least of their component. Each round is written, so a lost executor
    costs one round; the loop ends when a round changes nothing.
    """
    now = written(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "links"
    )
    seen = _fingerprint(now)
    while seen[0]:
        now = written(_star(_star(now, True), False), "links")
        found = _fingerprint(now)
        if found == seen:
            break
        seen = found
    return now
