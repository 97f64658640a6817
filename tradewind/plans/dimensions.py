"""Dimension builds: staging rows to dimension rows without their surrogate key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions import calendar as cal
from tradewind.functions import retail, text
from tradewind.sources.schemas import DIMENSIONS

# The columns whose dates make up the date dimension.
DATE_SOURCES = {
    "stg_orders": ["order_purchase_timestamp", "order_approved_at", "order_delivered_customer_date"],
    "stg_reviews": ["review_creation_date", "review_answer_timestamp"],
    "stg_order_items": ["shipping_limit_date"],
}

ORDER_TIMES = [
    "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
    "order_delivered_customer_date", "order_estimated_delivery_date",
]


def date_union_distinct(staging: dict[str, DataFrame], sources: dict[str, list[str]] = DATE_SOURCES) -> DataFrame:
    """Distinct calendar dates of all listed columns.

    Each table is read once: its dates are collected per row in an array and
    exploded, and one distinct follows the union.
    """
    parts = []
    for table, columns in sources.items():
        dates = F.array(*[text.parse_date(c) for c in columns])
        parts.append(staging[table].select(F.explode(dates).alias("full_date")))
    return reduce(DataFrame.unionByName, parts).where("full_date IS NOT NULL").distinct()


def build_dim_date(staging: dict[str, DataFrame]) -> DataFrame:
    dates = date_union_distinct(staging)
    d = F.col("full_date")
    rows = dates.withColumns(
        {
            "date_key": cal.date_key(d),
            **cal.calendar_parts(d),
            **cal.calendar_names(d),
            "is_weekend": cal.is_weekend(d),
            "is_holiday": F.lit(False),
            "fiscal_year": cal.fiscal_year(d),
            "fiscal_quarter": cal.fiscal_quarter(d),
            **audit("created_date", "updated_date"),
        }
    )
    return declared(rows, "dim_date")


def build_dim_customer(customers: DataFrame, keep_all: bool = False) -> DataFrame:
    return _build_place_dimension(customers, "customer", ["customer_id", "customer_unique_id"], keep_all)


def build_dim_seller(sellers: DataFrame, keep_all: bool = False) -> DataFrame:
    return _build_place_dimension(sellers, "seller", ["seller_id"], keep_all)


def _build_place_dimension(staging: DataFrame, kind: str, ids: list[str], keep_all: bool) -> DataFrame:
    """Customers and sellers: cleaned city and state, derived region; ``keep_all`` keeps every source row."""
    staging = with_hash(staging) if keep_all else require_key(with_hash(staging), ids[0])
    city, state = f"{kind}_city", f"{kind}_state"
    cleaned = staging.select(
        *ids,
        f"{kind}_zip_code_prefix",
        text.clean_city(city).alias(city),
        text.clean_state(state).alias(state),
        "record_hash",
    )
    rows = (cleaned if keep_all else cleaned.distinct()).withColumns(
        {
            f"{kind}_region": retail.state_region(state),
            "is_active": F.lit(True),
            **audit("created_date", "updated_date"),
        }
    )
    return declared(rows, f"dim_{kind}")


def category_translation_join(products: DataFrame, categories: DataFrame) -> DataFrame:
    """English category name, else the original one, else ``Unknown``.

    A name with several translations takes the first in order, so that a product stays one row.
    """
    lookup = categories.groupBy(F.col("product_category_name").alias("_name")).agg(
        F.min("product_category_name_english").alias("_english")
    )
    joined = products.join(lookup, products["product_category_name"] == lookup["_name"], "left")
    return joined.withColumn(
        "product_category_english", text.coalesce_default("_english", "product_category_name")
    ).drop("_name", "_english")


def build_dim_product(products: DataFrame, categories: DataFrame, keep_all: bool = False) -> DataFrame:
    """Products with their English category, sizes and first version; ``keep_all`` keeps every source row."""
    products = with_hash(products) if keep_all else require_key(with_hash(products), "product_id")
    counts = ["product_name_lenght", "product_description_lenght", "product_photos_qty"]
    sizes = ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]
    cleaned = category_translation_join(products, categories).select(
        "product_id",
        text.coalesce_default("product_category_name").alias("product_category_name"),
        "product_category_english",
        *[text.parse_number(c).cast("int").alias(c) for c in counts],
        *[text.parse_number(c, "decimal(10,2)").alias(c) for c in sizes],
        "record_hash",
    )
    rows = (cleaned if keep_all else cleaned.distinct()).withColumn(
        "product_volume_cm3", retail.product_volume(*sizes[1:]).cast("decimal(15,2)")
    ).withColumns(
        {
            "product_size_category": retail.size_category("product_volume_cm3"),
            **version_columns(),
            **audit("created_date"),
        }
    )
    return declared(rows, "dim_product")


def build_dim_order_status(orders: DataFrame, impute: bool = True, keep_all: bool = False) -> DataFrame:
    """Order lifecycle with delay metrics.

    ``impute=True`` fills missing times first and measures elapsed 24-hour
    days. ``impute=False`` keeps them missing, subtracts calendar dates, and
    reports ``Unknown`` where a delay is not known. ``keep_all`` keeps every
    source row.
    """
    parsed = (with_hash(orders) if keep_all else require_key(with_hash(orders), "order_id")).select(
        "order_id", "order_status", *[text.parse_timestamp(c).alias(c) for c in ORDER_TIMES], "record_hash"
    )
    parsed = parsed if keep_all else parsed.distinct()
    purchase, approved, _, delivered, estimated = ORDER_TIMES
    if impute:
        times = parsed.withColumns(retail.fill_lifecycle(*ORDER_TIMES))
        known, day_mode, hour_mode = None, "floor", "truncate"
    else:
        times = parsed
        known = F.col(delivered).isNotNull() & F.col(estimated).isNotNull()
        day_mode, hour_mode = "calendar", "floor"
    measured = times.withColumns(
        {
            "approval_delay_hours": cal.elapsed_hours(approved, purchase, hour_mode),
            "delivery_delay_days": cal.elapsed_days(delivered, estimated, day_mode),
            "total_delivery_days": cal.elapsed_days(delivered, purchase, day_mode),
        }
    )
    rows = measured.withColumns(
        {
            "is_delivered_on_time": retail.on_time("delivery_delay_days", known),
            "delivery_performance_category": retail.delivery_category("delivery_delay_days", known),
            **audit("created_date", "updated_date"),
        }
    )
    return declared(rows, "dim_order_status")


def require_key(df: DataFrame, *keys: str) -> DataFrame:
    return df.dropna(subset=list(keys))


def with_hash(df: DataFrame) -> DataFrame:
    """Staging rows carry their hash; rows from elsewhere get one."""
    return df if "record_hash" in df.columns else df.withColumn("record_hash", text.record_hash(*df.columns))


def audit(*names: str) -> dict:
    return {name: F.current_timestamp() for name in names}


def version_columns() -> dict:
    """Validity window of a first or new version."""
    return {
        "effective_start_date": F.localtimestamp(),
        "effective_end_date": F.lit(retail.OPEN_END).cast("timestamp_ntz"),
        "is_current": F.lit(True),
    }


def declared(df: DataFrame, table: str) -> DataFrame:
    """Columns in declared order and type; the surrogate key may still be absent."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in DIMENSIONS[table] if f.name in df.columns])
