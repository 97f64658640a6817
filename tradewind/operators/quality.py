"""Declared table constraints as data-quality operators.

A relational server would refuse a whole load over one bad row. Here a rule
yields violation rows ``(table_name, rule, row_key, value)``, and rows that
break a row-level rule can be set aside while the others are loaded.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VIOLATION_COLUMNS = ["table_name", "rule", "row_key", "value"]


@dataclass(frozen=True)
class Rule:
    """One row-level constraint; NULL passes everything but ``not_null``."""

    kind: str
    column: str
    low: float | None = None
    high: float | None = None
    values: tuple[str, ...] = ()
    other: str = ""

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.column}" + (f"<={self.other}" if self.kind == "row_order" else "")

    def violated(self) -> Column:
        c = F.col(self.column)
        if self.kind == "not_null":
            return c.isNull()
        if self.kind == "range":
            broken = F.lit(False)
            if self.low is not None:
                broken = broken | (c < F.lit(self.low))
            if self.high is not None:
                broken = broken | (c > F.lit(self.high))
        elif self.kind == "enum":
            broken = ~c.isin(list(self.values))
        elif self.kind == "length":
            broken = F.length(c) != F.lit(int(self.low))
        elif self.kind == "row_order":
            broken = c > F.col(self.other)
        else:
            raise ValueError(self.kind)
        return F.coalesce(broken, F.lit(False))


def not_null(*columns: str) -> list[Rule]:
    return [Rule("not_null", c) for c in columns]


def in_range(low: float | None, high: float | None, *columns: str) -> list[Rule]:
    return [Rule("range", c, low=low, high=high) for c in columns]


def one_of(column: str, *values: str) -> list[Rule]:
    return [Rule("enum", column, values=values)]


def has_length(n: int, column: str) -> list[Rule]:
    return [Rule("length", column, low=n)]


def ordered(first: str, second: str) -> list[Rule]:
    return [Rule("row_order", first, other=second)]


# The declared constraints of the warehouse tables.
ROW_RULES: dict[str, list[Rule]] = {
    "dim_date": [
        *not_null("full_date", "year", "quarter", "month", "day", "day_of_week", "month_name", "day_name",
                  "is_weekend", "is_holiday", "fiscal_year", "fiscal_quarter"),
        *in_range(1, 4, "quarter", "fiscal_quarter"),
        *in_range(1, 12, "month"),
        *in_range(1, 31, "day"),
        *in_range(1, 7, "day_of_week"),
        *in_range(1, 53, "week_of_year"),
    ],
    "dim_customer": [
        *not_null("customer_id", "customer_unique_id", "customer_city", "customer_state", "customer_region",
                  "record_hash"),
        *has_length(2, "customer_state"),
    ],
    "dim_product": [
        *not_null("product_id", "effective_start_date", "effective_end_date", "is_current", "record_hash"),
        *in_range(0, None, "product_name_lenght", "product_description_lenght", "product_photos_qty",
                  "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
                  "product_volume_cm3"),
        *one_of("product_size_category", "Small", "Medium", "Large", "Extra Large", "Unknown"),
        *ordered("effective_start_date", "effective_end_date"),
    ],
    "dim_seller": [
        *not_null("seller_id", "seller_city", "seller_state", "seller_region", "record_hash"),
        *has_length(2, "seller_state"),
    ],
    "dim_order_status": [
        *not_null("order_id", "order_status", "order_purchase_timestamp", "record_hash"),
        *in_range(0, None, "approval_delay_hours", "total_delivery_days"),
        *one_of("delivery_performance_category", "Early", "On Time", "Slightly Late", "Very Late", "Unknown"),
        *ordered("order_purchase_timestamp", "order_approved_at"),
        *ordered("order_purchase_timestamp", "order_estimated_delivery_date"),
        *one_of("order_status", "delivered", "shipped", "processing", "approved", "created", "invoiced", "canceled",
                "unavailable"),
    ],
    "fact_order_items": [
        *not_null("order_id", "order_item_id", "customer_sk", "product_sk", "seller_sk", "order_status_sk",
                  "item_price", "freight_value", "total_item_value"),
        *in_range(1, None, "order_item_id"),
        *in_range(0, None, "item_price", "freight_value", "total_item_value"),
    ],
    "fact_payments": [
        *not_null("order_id", "payment_sequential", "order_status_sk", "payment_installments", "payment_value",
                  "payment_type"),
        *in_range(1, None, "payment_sequential"),
        *in_range(0, None, "payment_installments", "payment_value"),
        *one_of("payment_type", "credit_card", "boleto", "voucher", "debit_card", "not_defined"),
    ],
    "fact_reviews": [
        *not_null("review_id", "order_id", "customer_sk", "order_status_sk", "review_score", "review_category"),
        *in_range(1, 5, "review_score"),
        *one_of("review_category", "Poor", "Fair", "Good", "Excellent", "Unknown"),
        *in_range(0, None, "response_time_hours"),
    ],
    "agg_monthly_sales": [
        *not_null("year_month", "year", "month", "month_name", "total_orders", "total_items", "total_revenue",
                  "total_freight", "unique_customers", "unique_products"),
        *in_range(1, 12, "month"),
        *in_range(0, None, "total_orders", "total_items", "total_revenue", "total_freight", "avg_order_value",
                  "avg_items_per_order", "unique_customers", "new_customers", "unique_products", "unique_states"),
    ],
    "agg_product_performance": [
        *not_null("product_sk"),
        *in_range(0, None, "last_12_months_revenue", "last_12_months_orders", "last_12_months_items", "avg_price",
                  "total_reviews"),
        *in_range(1, 5, "avg_review_score"),
        *in_range(1, None, "revenue_rank", "volume_rank"),
    ],
}

# Declared unique keys (surrogate primary keys included).
UNIQUE_KEYS: dict[str, list[tuple[str, ...]]] = {
    "dim_date": [("date_key",), ("full_date",)],
    "dim_customer": [("customer_sk",), ("customer_id",)],
    "dim_product": [("product_sk",), ("product_id", "is_current")],
    "dim_seller": [("seller_sk",), ("seller_id",)],
    "dim_order_status": [("order_status_sk",), ("order_id",)],
    "fact_order_items": [("order_item_sk",), ("order_id", "order_item_id")],
    "fact_payments": [("payment_sk",), ("order_id", "payment_sequential")],
    "fact_reviews": [("review_sk",), ("review_id",)],
    "agg_monthly_sales": [("sales_agg_sk",), ("year_month",)],
    "agg_product_performance": [("product_perf_sk",), ("product_sk",)],
}

# Declared references (child table, child column, parent table, parent column).
FOREIGN_KEYS: list[tuple[str, str, str, str]] = [
    ("fact_order_items", "customer_sk", "dim_customer", "customer_sk"),
    ("fact_order_items", "product_sk", "dim_product", "product_sk"),
    ("fact_order_items", "seller_sk", "dim_seller", "seller_sk"),
    ("fact_order_items", "order_status_sk", "dim_order_status", "order_status_sk"),
    ("fact_order_items", "order_date_key", "dim_date", "date_key"),
    ("fact_order_items", "shipping_date_key", "dim_date", "date_key"),
    ("fact_payments", "order_date_key", "dim_date", "date_key"),
    ("fact_payments", "order_status_sk", "dim_order_status", "order_status_sk"),
    ("fact_reviews", "customer_sk", "dim_customer", "customer_sk"),
    ("fact_reviews", "order_status_sk", "dim_order_status", "order_status_sk"),
    ("fact_reviews", "review_date_key", "dim_date", "date_key"),
    ("fact_reviews", "answer_date_key", "dim_date", "date_key"),
    ("agg_product_performance", "product_sk", "dim_product", "product_sk"),
]


def check_rows(df: DataFrame, table: str, rules: list[Rule], key: str) -> DataFrame:
    """Violations of all row-level rules in one pass over the table."""
    broken = [
        F.when(r.violated(), F.struct(F.lit(r.name).alias("rule"), F.col(r.column).cast("string").alias("value")))
        for r in rules
    ]
    if not rules:
        return df.sparkSession.createDataFrame([], ", ".join(f"{c} string" for c in VIOLATION_COLUMNS))
    hits = _with_broken_rules(df, rules).where("broken_rules <> ''").select(
        F.col(key).cast("string").alias("row_key"), F.inline(F.array(*broken))
    )
    return hits.where("rule IS NOT NULL").select(F.lit(table).alias("table_name"), "rule", "row_key", "value")


def _with_broken_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add the names of the broken rules, empty for a good row.

    The names go through a generator. A plain filter on them would be pushed
    below the projections that compute the checked columns, and would compute
    each of those again for every rule that mentions it.
    """
    names = F.concat_ws(",", *[F.when(r.violated(), F.lit(r.name)) for r in rules])
    return df.select(*df.columns, F.explode(F.array(names)).alias("broken_rules"))


def check_kind(df: DataFrame, table: str, kind: str, key: str) -> DataFrame:
    """Violations of the declared rules of one kind."""
    rules = [r for r in ROW_RULES[table] if r.kind == kind and r.column in df.columns]
    return check_rows(df, table, rules, key)


def check_unique(df: DataFrame, table: str, columns: tuple[str, ...]) -> DataFrame:
    """Repeated keys with their number of rows; a key with a NULL part passes."""
    text_key = F.concat_ws("|", *[F.col(c).cast("string") for c in columns])
    repeated = df.dropna(subset=list(columns)).groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return repeated.select(
        F.lit(table).alias("table_name"),
        F.lit("unique:" + ",".join(columns)).alias("rule"),
        text_key.alias("row_key"),
        F.col("_n").cast("string").alias("value"),
    )


def orphan_anti_join(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-null reference has no parent."""
    keys = parent.select(F.col(parent_column).alias(column))
    return child.where(F.col(column).isNotNull()).join(keys, column, "left_anti")


def check_foreign_key(
    child: DataFrame, child_name: str, column: str, parent: DataFrame, parent_column: str, key: str
) -> DataFrame:
    orphans = orphan_anti_join(child, column, parent, parent_column)
    return orphans.select(
        F.lit(child_name).alias("table_name"),
        F.lit(f"foreign_key:{column}").alias("rule"),
        F.col(key).cast("string").alias("row_key"),
        F.col(column).cast("string").alias("value"),
    )


def check_foreign_keys(tables: dict[str, DataFrame], keys: dict[str, str]) -> DataFrame:
    """Orphans of every declared reference between the given tables."""
    checks = [
        check_foreign_key(tables[child], child, column, tables[parent], parent_column, keys[child])
        for child, column, parent, parent_column in FOREIGN_KEYS
        if child in tables and parent in tables
    ]
    return reduce(DataFrame.unionByName, checks)


def quarantine_split(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass every rule, and the others with the rules they break."""
    rules = [r for r in rules if r.column in df.columns and (not r.other or r.other in df.columns)]
    checked = _with_broken_rules(df, rules)
    return checked.where("broken_rules = ''").drop("broken_rules"), checked.where("broken_rules <> ''")


def constraint_registry(spark: SparkSession) -> DataFrame:
    """Every declared reference."""
    rows = [(f"fk_{child}_{column}", *(child, column, parent, parent_column)) for child, column, parent, parent_column in FOREIGN_KEYS]
    return spark.createDataFrame(
        rows, "constraint_name string, table_name string, column_name string, references_table string, references_column string"
    )


def foreign_keys_per_table(spark: SparkSession) -> DataFrame:
    return constraint_registry(spark).groupBy("table_name").agg(F.count(F.lit(1)).alias("fk_count"))
