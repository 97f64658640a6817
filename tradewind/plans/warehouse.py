"""The full load: staging → dimensions → facts → marts.

Every step writes its table before the next one reads it, so a lost executor
costs the running step only. A failing step raises; nothing is reported as
loaded that was not.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.operators.keys import KeyStore, stable_key
from tradewind.operators.quality import ROW_RULES
from tradewind.operators.ranking import surrogate_key
from tradewind.plans import dimensions, facts, marts
from tradewind.session import configure, materialize, run_folder

# Surrogate key, natural key and further tie columns of each numbered table.
KEYS: dict[str, tuple[str, list[str], list[str]]] = {
    "dim_customer": ("customer_sk", ["customer_id"], []),
    "dim_product": ("product_sk", ["product_id"], []),
    "dim_seller": ("seller_sk", ["seller_id"], []),
    "dim_order_status": ("order_status_sk", ["order_id"], []),
    "fact_order_items": (
        "order_item_sk",
        ["order_id", "order_item_id"],
        ["product_sk", "seller_sk", "item_price", "freight_value", "shipping_limit_date"],
    ),
    "fact_payments": ("payment_sk", ["order_id", "payment_sequential"], ["payment_type", "payment_value"]),
    "fact_reviews": ("review_sk", ["review_id"], []),
}

# Tables whose natural key may repeat; in all others one row is loaded for each.
REPEATING = {"fact_order_items", "fact_payments"}

_ROW = "_row"


def unkeyed(table: str, t: dict[str, DataFrame]) -> DataFrame:
    """Every candidate row of one dimension, fact or mart from the tables before it; unresolved keys are NULL."""
    builds: dict[str, Callable[[], DataFrame]] = {
        "dim_date": lambda: dimensions.build_dim_date(t),
        "dim_customer": lambda: dimensions.build_dim_customer(t["stg_customers"], keep_all=True),
        "dim_product": lambda: dimensions.build_dim_product(t["stg_products"], t["stg_product_categories"], keep_all=True),
        "dim_seller": lambda: dimensions.build_dim_seller(t["stg_sellers"], keep_all=True),
        "dim_order_status": lambda: dimensions.build_dim_order_status(t["stg_orders"], keep_all=True),
        "fact_order_items": lambda: facts.build_fact_order_items(
            t["stg_order_items"], t["stg_orders"], t["dim_customer"], t["dim_product"], t["dim_seller"],
            t["dim_order_status"], keep_unresolved=True,
        ),
        "fact_payments": lambda: facts.build_fact_payments(
            t["stg_payments"], t["stg_orders"], t["dim_order_status"], keep_unresolved=True
        ),
        "fact_reviews": lambda: facts.build_fact_reviews(
            t["stg_reviews"], t["stg_orders"], t["dim_customer"], t["dim_order_status"], keep_unresolved=True
        ),
        "agg_monthly_sales": lambda: marts.monthly_sales(t["fact_order_items"], t["dim_date"], t["dim_customer"]),
        "agg_product_performance": lambda: marts.product_performance(
            t["dim_product"], t["fact_order_items"], t["fact_reviews"]
        ),
    }
    return builds[table]()


def flagged_rows(table: str, rows: DataFrame) -> DataFrame:
    """Candidate rows with a frozen row number and the names of the rules they break.

    Rows are written once, so that loaded and rejected rows are two reads of one
    table. Of rows that share a natural key, the first is loaded: for reviews the
    latest, elsewhere a row that breaks no other rule before one that does, then
    by hash. The others break ``unique:<key>``. A row without its keys takes no
    part in that. Only keys that do repeat are joined back.
    """
    rules = ROW_RULES[table]
    rows = materialize(rows.withColumn(_ROW, F.monotonically_increasing_id()), table)
    broken = F.concat_ws(",", *[F.when(r.violated(), F.lit(r.name)) for r in rules])
    flagged = rows.withColumn("broken_rules", broken)
    if table not in KEYS or table in REPEATING:
        return flagged
    key = KEYS[table][1][0]
    needed = [r.column for r in rules if r.kind == "not_null" and (r.column == key or r.column.endswith("_sk"))]
    complete = reduce(Column.__and__, [F.col(c).isNotNull() for c in needed])
    if table == "fact_reviews":
        order = [facts.newest_first("review_creation_date"), F.col("order_id")]
    else:
        order = [F.col("broken_rules") != "", F.col("record_hash")]
    first = F.min(F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(order)], _ROW)).alias("_first")
    repeated = (
        flagged.where(complete).groupBy(key).agg(F.count(F.lit(1)).alias("_n"), first).where("_n > 1")
        .select(key, F.col(f"_first.{_ROW}").alias("_kept"))
    )
    later = complete & (F.col("_kept") != F.col(_ROW))
    names = F.concat_ws(",", F.when(F.col("broken_rules") != "", F.col("broken_rules")), F.when(later, F.lit(f"unique:{key}")))
    return flagged.join(repeated, key, "left").select(
        *[names.alias(c) if c == "broken_rules" else c for c in flagged.columns]
    )


def keyed(table: str, rows: DataFrame, keys: KeyStore | None = None) -> DataFrame:
    """Rows numbered in natural-key order; where that may repeat, the frozen row number is the last tie-break.

    With ``keys``, rows of earlier loads keep their number and the others are numbered after the greatest.
    """
    name, natural, ties = KEYS[table]
    if keys is None:
        return surrogate_key(rows, name, natural, [*ties, _ROW]).drop(_ROW)
    numbered, given = stable_key(rows, name, natural, keys.known(table), ties, _ROW if table in REPEATING else None)
    keys.add(table, given)
    return numbered.drop(_ROW)


# Build order of each layer.
STEPS = {
    "dimensions": ["dim_date", "dim_customer", "dim_product", "dim_seller", "dim_order_status"],
    "facts": ["fact_order_items", "fact_payments", "fact_reviews"],
    "marts": ["agg_monthly_sales", "agg_product_performance"],
}


def split_table(table: str, tables: dict[str, DataFrame], keys: KeyStore | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Loaded rows of one table, numbered where it has a surrogate key, and the rejected ones with ``broken_rules``."""
    rows = unkeyed(table, tables)
    if table not in ROW_RULES or table.startswith("agg_"):
        return rows, None
    flagged = flagged_rows(table, rows)
    valid = flagged.where("broken_rules = ''").drop("broken_rules", *facts.SOURCE_KEYS.get(table, []))
    return keyed(table, valid, keys) if table in KEYS else valid.drop(_ROW), flagged.where("broken_rules <> ''").drop(_ROW)


def build_table(table: str, tables: dict[str, DataFrame]) -> DataFrame:
    return split_table(table, tables)[0]


def rejected_rows(table: str, tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of one table that are not loaded, with the rules they break."""
    return flagged_rows(table, unkeyed(table, tables)).where("broken_rules <> ''").drop(_ROW)


def run_warehouse(
    spark: SparkSession,
    staging: dict[str, DataFrame | None],
    sink: Callable[[str, str, DataFrame], tuple[DataFrame, int]],
    refused: dict[str, DataFrame] | None = None,
    keys: KeyStore | None = None,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Build everything; returns the written tables and a summary of the steps.

    ``sink(layer, table, rows)`` writes a table and returns it as stored with
    its row count. Rows that are not loaded are written to the layer
    ``rejected`` with the rules they break: row rules, repeated natural keys,
    and, for facts, keys that no dimension row has (``not_null:<key>``). For each
    dimension and fact, source rows are loaded rows plus rejected rows. A source
    that is missing counts 0 rows, and the tables that need it are built from
    what is there or raise. Intermediates are removed at the end.
    """
    configure(spark)
    tables: dict[str, DataFrame] = {}
    summary: list[tuple[str, str, int, int, str]] = []
    for table, rows in staging.items():
        if rows is None:
            summary.append(("staging", table, 0, 0, "missing"))
            continue
        tables[table], n = sink("staging", table, rows)
        unread = sink("rejected", table, refused[table])[1] if refused and table in refused else 0
        summary.append(("staging", table, n, unread, "loaded"))
    with run_folder(spark):
        for layer, names in STEPS.items():
            for table in names:
                loaded, rejected = split_table(table, tables, keys)
                left_out = sink("rejected", table, rejected)[1] if rejected is not None else 0
                tables[table], n = sink(layer, table, loaded)
                summary.append((layer, table, n, left_out, "loaded"))
    return tables, spark.createDataFrame(
        summary, "layer string, table_name string, rows long, rejected long, status string"
    )


def load_summary(summary: DataFrame) -> DataFrame:
    """Tables, loaded rows and rejected rows per layer."""
    return summary.groupBy("layer").agg(
        F.count(F.lit(1)).alias("n_tables"), F.sum("rows").alias("total_rows"), F.sum("rejected").alias("rejected_rows")
    )
