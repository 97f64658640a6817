"""Aggregate marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions import calendar as cal
from tradewind.functions import retail
from tradewind.operators.ranking import global_row_number
from tradewind.session import materialize
from tradewind.sources.schemas import MARTS


def fact_dim_left_join(items: DataFrame, dim_date: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Items with their calendar month and customer state; undated items drop out."""
    months = dim_date.where("full_date IS NOT NULL").select(
        F.col("date_key").alias("order_date_key"), cal.year_month("full_date").alias("year_month"),
        "year", "month", "month_name",
    )
    return items.join(months, "order_date_key").join(
        dim_customer.select("customer_sk", "customer_state"), "customer_sk", "left"
    )


def order_item_counts(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(F.count(F.lit(1)).alias("items_in_order"))


def monthly_sales(
    items: DataFrame, dim_date: DataFrame, dim_customer: DataFrame, count_new_customers: bool = False
) -> DataFrame:
    """Month grain: orders, items, revenue, freight, averages, distinct counts.

    Four distinct counts in one GROUP BY would copy every item four times.
    Instead items are reduced to (month, order, customer), then to
    (month, customer), where the state is looked up; products are reduced to
    (month, product). Every step has partial aggregates and no step ever holds
    a month in one task. The average is over items and revenue excludes
    freight. ``new_customers`` is 0 unless asked for; then it is the number of
    customers whose first month this is.
    """
    months = dim_date.where("full_date IS NOT NULL").select(
        F.col("date_key").alias("order_date_key"), cal.year_month("full_date").alias("year_month")
    )
    dated = items.join(months, "order_date_key")
    sums = ["n_items", "revenue", "freight", "total"]
    per_order = dated.groupBy("year_month", "order_id", "customer_sk").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.sum("item_price").alias("revenue"),
        F.sum("freight_value").alias("freight"),
        F.sum("total_item_value").alias("total"),
    )
    # Orders are counted apart from customers, so an order of two customers or months is counted as such.
    orders = per_order.groupBy("year_month", "order_id").agg(F.lit(1).alias("_one")).groupBy("year_month").agg(
        F.count("order_id").alias("total_orders")
    )
    per_customer = per_order.groupBy("year_month", "customer_sk").agg(*[F.sum(c).alias(c) for c in sums])
    if count_new_customers:
        first = per_customer.groupBy("customer_sk").agg(F.min("year_month").alias("first_month"))
        per_customer = per_customer.join(first, "customer_sk").withColumn(
            "is_new", (F.col("first_month") == F.col("year_month")).cast("int")
        )
    else:
        per_customer = per_customer.withColumn("is_new", F.lit(0))
    located = per_customer.join(dim_customer.select("customer_sk", "customer_state"), "customer_sk", "left")
    base = located.groupBy("year_month").agg(
        *[F.sum(c).alias(c) for c in sums],
        F.count("customer_sk").alias("unique_customers"),
        F.sum("is_new").alias("new_customers"),
        F.countDistinct("customer_state").alias("unique_states"),
    )
    products = dated.select("year_month", "product_sk").distinct().groupBy("year_month").agg(
        F.count("product_sk").alias("unique_products")
    )
    year, month = F.floor(F.col("year_month") / 100).cast("int"), F.pmod("year_month", F.lit(100))
    first_day = F.make_date(year, month, F.lit(1))
    rows = base.join(products, "year_month").join(orders, "year_month").select(
        # One row a month: as a key, the month itself is unique and stays the same in every load.
        F.col("year_month").cast("long").alias("sales_agg_sk"),
        "year_month",
        year.alias("year"),
        month.alias("month"),
        F.date_format(first_day, "MMMM").alias("month_name"),
        "total_orders",
        F.col("n_items").alias("total_items"),
        F.col("revenue").alias("total_revenue"),
        F.col("freight").alias("total_freight"),
        retail.safe_ratio("total", "n_items").alias("avg_order_value"),
        retail.safe_ratio("n_items", "total_orders", "decimal(10,2)").alias("avg_items_per_order"),
        "unique_customers",
        "new_customers",
        "unique_products",
        "unique_states",
        F.current_timestamp().alias("last_updated"),
    )
    return declared(rows, "agg_monthly_sales")


def _reviews_per_order(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_reviews"),
        F.count("review_score").alias("n_scores"),
        F.sum("review_score").alias("score_sum"),
    )


def _product_orders(items: DataFrame, reviews: DataFrame) -> DataFrame:
    """(product, order) rows with item sums and the order's review sums."""
    per_order = items.groupBy("product_sk", "order_id").agg(
        F.count(F.lit(1)).alias("n_items"), F.sum("item_price").alias("revenue")
    )
    zero = F.lit(0)
    return per_order.join(_reviews_per_order(reviews), "order_id", "left").withColumns(
        {c: F.coalesce(c, zero) for c in ["n_reviews", "n_scores", "score_sum"]}
    )


def product_metrics(dim_product: DataFrame, items: DataFrame, reviews: DataFrame, fanout: bool = True) -> DataFrame:
    """Revenue, orders, items, price and review figures of every current product.

    With ``fanout=True`` the figures are those of joining items to reviews on
    the order: an order with r reviews counts its items r times in sums and
    averages. They are computed from (product, order) rows with the number of
    copies as a weight, so the copies never exist, and no distinct count is
    needed: a (product, order) pair occurs once. With ``fanout=False`` each
    item counts once and each order's reviews count once per product.
    """
    copies = F.greatest("n_reviews", F.lit(1)) if fanout else F.lit(1)
    score_weight = F.col("n_items") if fanout else F.lit(1)
    measured = _product_orders(items, reviews).groupBy("product_sk").agg(
        F.sum(F.col("revenue") * copies).alias("revenue"),
        F.count(F.lit(1)).alias("orders"),
        F.sum("n_items").alias("items"),
        F.sum(F.col("n_items") * copies).alias("priced"),
        F.sum(F.col("score_sum") * score_weight).alias("score_sum"),
        F.sum(F.col("n_scores") * score_weight).alias("n_scores"),
        F.sum("n_reviews").alias("reviews"),
    )
    zero = F.lit(0)
    return dim_product.where("is_current").select("product_sk").join(measured, "product_sk", "left").select(
        "product_sk",
        F.coalesce(F.col("revenue").cast("decimal(38,2)"), F.lit(0).cast("decimal(38,2)")).alias("last_12_months_revenue"),
        F.coalesce("orders", zero).alias("last_12_months_orders"),
        F.coalesce("items", zero).alias("last_12_months_items"),
        F.coalesce(retail.safe_ratio("revenue", "priced"), F.lit(0.0)).alias("avg_price"),
        F.coalesce(retail.safe_ratio("score_sum", "n_scores"), F.lit(0.0)).alias("avg_review_score"),
        F.coalesce("reviews", zero).alias("total_reviews"),
    )


def dimension_preserving_join(dim_product: DataFrame, items: DataFrame, reviews: DataFrame) -> DataFrame:
    """Every current product with its items and their orders' reviews, row by row."""
    products = dim_product.where("is_current").select("product_sk", "product_id")
    lines = items.select("product_sk", "order_id", "order_item_id", "item_price")
    scores = reviews.select("order_id", "review_id", "review_score")
    return products.join(lines, "product_sk", "left").join(scores, "order_id", "left")


def with_rank(df: DataFrame, measure: str, tie: str, name: str) -> DataFrame:
    """Global rank by a measure, largest first, ties by a unique column."""
    return global_row_number(df, [F.col(measure).desc_nulls_last(), F.col(tie).asc()], name)


def recent_items(items: DataFrame, window_months: int | None) -> DataFrame:
    """Items ordered in the last months before the newest order; all if None."""
    if window_months is None:
        return items
    day = F.to_date(F.col("order_date_key").cast("string"), "yyyyMMdd")
    newest = items.agg(F.max("order_date_key")).first()[0]
    start = F.add_months(F.to_date(F.lit(str(newest)), "yyyyMMdd"), -window_months)
    return items.where(day > start)


def product_performance(
    dim_product: DataFrame,
    items: DataFrame,
    reviews: DataFrame,
    window_months: int | None = None,
    fanout: bool = True,
) -> DataFrame:
    """Product metrics with revenue and volume ranks; a zero rating becomes NULL."""
    return ranked_products(product_metrics(dim_product, recent_items(items, window_months), reviews, fanout))


def ranked_products(metrics: DataFrame) -> DataFrame:
    """The product mart from the metrics of all products."""
    metrics = materialize(metrics, "metrics")
    ranked = metrics
    for measure, name in [("last_12_months_revenue", "revenue_rank"), ("last_12_months_items", "volume_rank")]:
        ranked = ranked.join(with_rank(metrics.select("product_sk", measure), measure, "product_sk", name).drop(measure), "product_sk")
    rows = ranked.withColumns(
        {
            "product_perf_sk": F.col("product_sk"),  # one row per product
            "avg_review_score": retail.zero_to_null("avg_review_score"),
            "last_updated": F.current_timestamp(),
        }
    )
    return declared(rows, "agg_product_performance")


def declared(df: DataFrame, table: str) -> DataFrame:
    return df.select(*[_cast(f) for f in MARTS[table]])


def _cast(field) -> Column:
    return F.col(field.name).cast(field.dataType).alias(field.name)
