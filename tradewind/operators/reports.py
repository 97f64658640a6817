"""Reports over facts and marts: listings, summaries, KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions import calendar as cal
from tradewind.functions import retail
from tradewind.functions.text import money_text, rating_text
from tradewind.operators.relational import optional_predicates

# Largest allowed number of rows and default of each listing.
LISTING_LIMITS = {"months": (120, 12), "products": (500, 50), "top": (100, 10)}

_MONTH_COLUMNS = [
    "year_month", "year", "month", "month_name", "total_orders", "total_items", "total_revenue", "total_freight",
    "avg_order_value", "avg_items_per_order", "unique_customers", "unique_products", "unique_states",
]
_PRODUCT_COLUMNS = [
    "product_sk", "product_id", "product_category_name", "product_category_english", "last_12_months_revenue",
    "last_12_months_orders", "last_12_months_items", "avg_price", "avg_review_score", "total_reviews",
    "revenue_rank", "volume_rank",
]
_TOP_COLUMNS = [
    "product_sk", "product_id", "product_category_english", "last_12_months_revenue", "last_12_months_orders",
    "avg_price", "avg_review_score", "total_reviews",
]


def _checked(kind: str, limit: int | None) -> int:
    largest, default = LISTING_LIMITS[kind]
    n = default if limit is None else limit
    if not 1 <= n <= largest:
        raise ValueError(f"limit must be between 1 and {largest}")
    return n


def _mean(column: str, name: str | None = None):
    return (F.sum(F.col(column)).cast("double") / F.count(column)).alias(name or column)


# Monthly mart


def recent_months(mart: DataFrame, limit: int | None = None, min_year_month: int | None = None) -> DataFrame:
    n = _checked("months", limit)
    chosen = optional_predicates(mart, at_least={"year_month": min_year_month})
    return chosen.select(*_MONTH_COLUMNS).orderBy(F.desc("year_month")).limit(n)


def all_months(mart: DataFrame, newest_first: bool = True) -> DataFrame:
    order = F.desc("year_month") if newest_first else F.asc("year_month")
    return mart.select(*_MONTH_COLUMNS).orderBy(order)


def latest_month_row(mart: DataFrame) -> DataFrame:
    return mart.orderBy(F.desc("year_month")).limit(1)


def monthly_revenue_trend(mart: DataFrame) -> DataFrame:
    return mart.select("year_month", "total_revenue", "total_orders", "avg_order_value").orderBy(F.desc("year_month"))


def monthly_sales_summary(mart: DataFrame) -> DataFrame:
    return mart.agg(
        F.count(F.lit(1)).alias("total_months"),
        F.sum("total_orders").alias("total_orders"),
        F.sum("total_revenue").alias("total_revenue"),
        F.avg("avg_order_value").alias("avg_order_value"),
        F.max("unique_customers").alias("max_customers_per_month"),
        F.max("unique_products").alias("max_products_per_month"),
    )


def sales_kpis(mart: DataFrame) -> DataFrame:
    """Totals over all months beside the newest month's figures."""
    newest = lambda c: F.max_by(c, "year_month")
    kpis = mart.agg(
        F.sum("total_orders").alias("total_orders"),
        newest("total_orders").alias("latest_orders"),
        F.sum("total_revenue").alias("total_revenue"),
        newest("total_revenue").alias("latest_revenue"),
        F.avg("avg_order_value").alias("avg_order_value"),
        newest("avg_order_value").alias("latest_order_value"),
        F.sum("unique_customers").alias("unique_customers"),
        newest("unique_customers").alias("latest_customers"),
        F.max("unique_products").alias("unique_products"),
    )
    change = (F.col("latest_order_value") / F.col("avg_order_value") - 1) * 100
    return kpis.withColumn("order_value_change_pct", F.when(F.col("avg_order_value") > 0, change))


def freight_analysis(mart: DataFrame) -> DataFrame:
    return mart.select(
        "year_month",
        cal.month_label("year", "month").alias("date_label"),
        "total_freight",
        retail.freight_percent("total_freight", "total_revenue").alias("freight_pct"),
    ).orderBy("year_month")


# Product mart


def mart_dim_inner_join(mart: DataFrame, dim_product: DataFrame) -> DataFrame:
    names = dim_product.select("product_sk", "product_id", "product_category_name", "product_category_english")
    return mart.join(names, "product_sk").select(*_PRODUCT_COLUMNS)


def product_list(
    mart: DataFrame,
    dim_product: DataFrame,
    limit: int | None = None,
    max_revenue_rank: int | None = None,
    min_rating: float | None = None,
) -> DataFrame:
    """Products by revenue rank; the bounds are optional, an unrated product fails a rating bound."""
    n = _checked("products", limit)
    if min_rating is not None and not 0 <= min_rating <= 5:
        raise ValueError("min_rating must be between 0 and 5")
    chosen = optional_predicates(
        mart, at_least={"avg_review_score": min_rating}, at_most={"revenue_rank": max_revenue_rank}
    )
    return mart_dim_inner_join(chosen, dim_product).orderBy("revenue_rank").limit(n)


def top_by_revenue(mart: DataFrame, dim_product: DataFrame, limit: int | None = None) -> DataFrame:
    n = _checked("top", limit)
    return mart_dim_inner_join(mart, dim_product).orderBy("revenue_rank").select(*_TOP_COLUMNS).limit(n)


def top_by_orders(mart: DataFrame, dim_product: DataFrame, limit: int | None = None) -> DataFrame:
    """Ordered by the volume rank, that is by items."""
    n = _checked("top", limit)
    return mart_dim_inner_join(mart, dim_product).orderBy("volume_rank").select(*_TOP_COLUMNS).limit(n)


def top_ranked_products(mart: DataFrame, dim_product: DataFrame, rank: int = 50) -> DataFrame:
    return mart_dim_inner_join(mart.where(F.col("revenue_rank") <= rank), dim_product).orderBy("revenue_rank")


def rank_and_rating_filter(products: DataFrame, rank: int = 20, rating: float = 0.0) -> DataFrame:
    return products.where((F.col("revenue_rank") <= rank) & (F.col("avg_review_score") >= rating))


def nlargest(df: DataFrame, k: int, measure: str, tie: str) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(measure), F.asc(tie)).limit(k)


def product_summary(mart: DataFrame) -> DataFrame:
    return mart.agg(
        F.count(F.lit(1)).alias("total_products"),
        F.sum("last_12_months_revenue").alias("total_revenue"),
        F.sum("last_12_months_orders").alias("total_orders"),
        F.avg("avg_review_score").alias("avg_rating"),
        F.max("total_reviews").alias("max_reviews"),
        F.min("avg_price").alias("min_price"),
        F.max("avg_price").alias("max_price"),
    )


def product_kpis(products: DataFrame) -> DataFrame:
    return products.agg(
        F.count(F.lit(1)).alias("total_products"),
        F.sum("last_12_months_revenue").alias("total_revenue"),
        F.sum("last_12_months_orders").alias("total_orders"),
        F.avg("avg_review_score").alias("avg_rating"),
        F.sum("total_reviews").alias("total_reviews"),
    )


def rating_bins(products: DataFrame, rating: str = "avg_review_score") -> DataFrame:
    """Products per rating band (0,1], (1,2], … (4,5]; empty bands included."""
    spark = products.sparkSession
    band = F.ceil(F.col(rating)).cast("int")
    counted = products.where((F.col(rating) > 0) & (F.col(rating) <= 5)).groupBy(band.alias("band")).agg(
        F.count(F.lit(1)).alias("n")
    )
    bands = spark.range(1, 6).select(F.col("id").cast("int").alias("band"))
    label = F.concat(F.lit("("), (F.col("band") - 1).cast("string"), F.lit(","), F.col("band").cast("string"), F.lit("]"))
    return bands.join(F.broadcast(counted), "band", "left").select(
        label.alias("rating_range"), F.coalesce("n", F.lit(0)).alias("n")
    )


def revenue_per_order(products: DataFrame) -> DataFrame:
    return products.withColumn(
        "revenue_per_order", retail.revenue_per_order("last_12_months_revenue", "last_12_months_orders")
    )


# Headings of the product listing.
PRODUCT_HEADINGS = {
    "revenue_rank": "Rank",
    "product_category_english": "Product",
    "last_12_months_revenue": "Revenue (R$)",
    "last_12_months_orders": "Orders",
    "avg_price": "Avg Price (R$)",
    "avg_review_score": "Rating",
    "total_reviews": "Reviews",
}


def rename_columns(df: DataFrame, headings: dict[str, str]) -> DataFrame:
    return df.select(*headings).withColumnsRenamed(headings)


def product_display(products: DataFrame) -> DataFrame:
    """Product listing as shown: formatted money and ratings under headings."""
    shown = products.withColumns(
        {
            "last_12_months_revenue": money_text("last_12_months_revenue"),
            "avg_price": money_text("avg_price"),
            "avg_review_score": rating_text("avg_review_score"),
        }
    )
    return rename_columns(shown, PRODUCT_HEADINGS)


# Facts


def fact_totals(items: DataFrame) -> DataFrame:
    return items.agg(
        F.count(F.lit(1)).alias("n_items"),
        F.sum("item_price").alias("total_price"),
        F.sum("total_item_value").alias("total_value"),
    )


def _order_values(items: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct orders, revenue and mean item value per group.

    Items are reduced to one row per (group, order) first, so the distinct
    order count is a plain count and no group is gathered.
    """
    per_order = items.groupBy(*keys, "order_id").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("total_item_value").alias("_value")
    )
    return per_order.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("_value").alias("revenue"),
        (F.sum("_value").cast("double") / F.sum("_n")).alias("avg_order_value"),
    )


def category_revenue(items: DataFrame, dim_product: DataFrame) -> DataFrame:
    names = dim_product.where("is_current").select("product_sk", "product_category_english")
    return _order_values(items.join(names, "product_sk"), ["product_category_english"])


def category_revenue_top(items: DataFrame, dim_product: DataFrame, k: int = 10) -> DataFrame:
    ranked = category_revenue(items, dim_product).orderBy(F.desc("revenue"), F.asc("product_category_english"))
    return ranked.limit(k)


def geographic_sales(items: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """By state and region. Items are first reduced to (customer, order)."""
    per_order = items.groupBy("customer_sk", "order_id").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("total_item_value").alias("_value")
    )
    per_customer = per_order.groupBy("customer_sk").agg(
        F.count(F.lit(1)).alias("_orders"), F.sum("_n").alias("_n"), F.sum("_value").alias("_value")
    )
    places = dim_customer.select("customer_sk", "customer_state", "customer_region")
    return per_customer.join(places, "customer_sk").groupBy("customer_state", "customer_region").agg(
        F.sum("_orders").alias("total_orders"),
        F.sum("_value").alias("revenue"),
        (F.sum("_value").cast("double") / F.sum("_n")).alias("avg_order_value"),
    ).orderBy(F.desc("revenue"), F.asc("customer_state"))


def delivery_performance(dim_order_status: DataFrame) -> DataFrame:
    return dim_order_status.groupBy("delivery_performance_category").agg(
        F.count(F.lit(1)).alias("order_count"),
        F.avg("total_delivery_days").alias("avg_delivery_days"),
        F.avg("delivery_delay_days").alias("avg_delay_days"),
    ).orderBy(F.desc("order_count"))


def fact_fact_dim_join(reviews: DataFrame, items: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Every review beside every item of its order, with the product."""
    return (
        reviews.select("order_id", "review_id", "review_score")
        .join(items.select("order_id", "order_item_sk", "product_sk"), "order_id")
        .join(dim_product.where("is_current").select("product_sk", "product_category_english"), "product_sk")
    )


def category_satisfaction(
    reviews: DataFrame, items: DataFrame, dim_product: DataFrame, satisfied_from: int = 4, min_reviews: int = 10
) -> DataFrame:
    """Review figures per category over (review, item) pairs of an order.

    The pairs are counted as products of the order's review and item numbers
    instead of being joined row by row.
    """
    per_order = reviews.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("_reviews"),
        F.sum("review_score").alias("_score"),
        F.count_if(F.col("review_score") >= satisfied_from).alias("_satisfied"),
    )
    per_item = items.groupBy("order_id", "product_sk").agg(F.count(F.lit(1)).alias("_items"))
    names = dim_product.where("is_current").select("product_sk", "product_category_english")
    paired = per_item.join(per_order, "order_id").join(names, "product_sk")
    weighted = lambda c: F.sum(F.col("_items") * F.col(c))
    rated = paired.groupBy("product_category_english").agg(
        weighted("_reviews").alias("review_count"),
        (weighted("_score") / weighted("_reviews")).alias("avg_rating"),
        (weighted("_satisfied") / weighted("_reviews") * 100).alias("satisfaction_rate"),
    )
    return rated.where(F.col("review_count") >= min_reviews).orderBy(F.desc("avg_rating"))


# Staging-level metrics


def orders_by_year(orders: DataFrame, time: str) -> DataFrame:
    return orders.where(F.col(time).isNotNull()).groupBy(F.year(time).alias("order_year")).agg(
        F.count(F.lit(1)).alias("n"), F.min(time).alias("first_order"), F.max(time).alias("last_order")
    )


def payment_stats(payments: DataFrame, value: str = "payment_value") -> DataFrame:
    return payments.agg(
        F.count(F.lit(1)).alias("n_payments"),
        F.sum(value).alias("total"),
        _mean(value, "mean"),
        F.min(value).alias("smallest"),
        F.max(value).alias("largest"),
    )


def items_per_order_stats(items: DataFrame) -> DataFrame:
    per_order = items.groupBy("order_id").agg(F.count("order_item_id").alias("n"))
    return per_order.agg(
        F.avg("n").alias("mean_items"),
        F.max("n").alias("max_items"),
        F.count_if(F.col("n") > 1).alias("multi_item_orders"),
        (F.try_divide(F.count_if(F.col("n") > 1), F.count(F.lit(1))) * 100).alias("multi_item_pct"),
    )


def item_position_range(items: DataFrame) -> DataFrame:
    return items.agg(
        F.min("order_item_id").alias("smallest"),
        F.max("order_item_id").alias("largest"),
        F.countDistinct("order_item_id").alias("distinct_positions"),
    )


def item_position_distribution(items: DataFrame, k: int | None = None) -> DataFrame:
    """Rows per item position; with ``k`` the first k positions."""
    counted = items.groupBy("order_item_id").agg(F.count(F.lit(1)).alias("n"))
    return counted if k is None else counted.orderBy("order_item_id").limit(k)


def sample_rows(df: DataFrame, order: list[str], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)
