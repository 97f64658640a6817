"""Recency, frequency and monetary value of customers, and scores on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions import calendar as cal
from tradewind.functions import retail
from tradewind.operators.ranking import score_by_rank, score_by_value
from tradewind.operators.relational import delivered_orders, positive
from tradewind.session import materialize

# Review score of a customer without reviews; upper bounds of the value bands.
DEFAULT_REVIEW = 3.0
VALUE_BANDS = [(6, "Low Value"), (9, "Medium Value"), (12, "High Value"), (15, "VIP")]

_PLACE = ["customer_state", "customer_city", "customer_region"]


def customer_review_stats(reviews: DataFrame, key: str = "customer_sk") -> DataFrame:
    return reviews.groupBy(key).agg(
        (F.sum("review_score").cast("double") / F.count("review_score")).alias("avg_review_score"),
        F.count("review_id").alias("total_reviews"),
    )


def order_values(items: DataFrame, orders: DataFrame, payments: DataFrame) -> DataFrame:
    """One row per delivered order: item sums, payment sums and their numbers.

    The filter on orders and both reductions happen before any join, so a
    customer or an order with very many rows is small by the time it is joined.
    """
    delivered = delivered_orders(orders).select("order_status_sk", "order_purchase_timestamp")
    per_order = items.groupBy("order_id", "order_status_sk", "customer_sk").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.sum("total_item_value").alias("value"),
        F.sum("freight_value").alias("freight"),
    )
    paid = payments.groupBy("order_id").agg(F.count(F.lit(1)).alias("n_payments"), F.sum("payment_value").alias("paid"))
    return per_order.join(delivered, "order_status_sk").join(paid, "order_id", "left")


def inner_plus_optional_join(
    dim_customer: DataFrame, items: DataFrame, orders: DataFrame, payments: DataFrame
) -> DataFrame:
    """Item rows of delivered orders with customer and optional payments, row by row."""
    return (
        items.select("customer_sk", "order_id", "order_item_sk", "order_status_sk", "total_item_value")
        .join(dim_customer.select("customer_sk", "customer_unique_id"), "customer_sk")
        .join(delivered_orders(orders).select("order_status_sk", "order_purchase_timestamp"), "order_status_sk")
        .join(payments.select("order_id", "payment_sequential", "payment_value"), "order_id", "left")
    )


def rfm_metrics(
    dim_customer: DataFrame,
    items: DataFrame,
    orders: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
    reference_date: str,
    grain: str = "customer_sk",
    fanout: bool = True,
) -> DataFrame:
    """RFM metrics per customer as of an explicit date.

    With ``fanout=True`` the figures are those of joining items to payments on
    the order: an order's payments count once per item, and its items once per
    payment. They are computed from order rows with those numbers as weights.
    With ``fanout=False`` every payment and every item counts once.
    ``grain`` is the customer key of one order (``customer_sk``) or the person
    (``customer_unique_id``).
    """
    values = order_values(items, orders, payments)
    if grain != "customer_sk":
        values = values.join(dim_customer.select("customer_sk", grain), "customer_sk")
        reviews = reviews.join(dim_customer.select("customer_sk", grain), "customer_sk")
        first = F.min(F.struct("customer_sk", *_PLACE)).alias("_first")
        people = dim_customer.groupBy(grain).agg(first).select(grain, "_first.*")
    else:
        people = dim_customer.select("customer_sk", "customer_unique_id", *_PLACE)

    copies = F.greatest(F.coalesce("n_payments", F.lit(1)), F.lit(1)) if fanout else F.lit(1)
    payments_count = F.col("n_items") if fanout else F.lit(1)
    purchased = F.col("order_purchase_timestamp")
    summed = values.groupBy(grain).agg(
        F.min(purchased).alias("first_purchase_date"),
        F.max(purchased).alias("last_purchase_date"),
        F.count(F.lit(1)).alias("frequency_orders"),
        F.sum(F.col("paid") * payments_count).alias("_paid"),
        F.sum(F.col("value") * copies).alias("_value"),
        F.sum(F.col("freight") * copies).alias("total_freight"),
        F.sum(F.col("n_items") * copies).alias("total_items_purchased"),
    )
    reference = F.lit(reference_date).cast("timestamp_ntz")
    n = F.col("total_items_purchased")
    days = lambda end, start: (cal.elapsed_seconds(end, start) / 86400).cast("int")
    return (
        summed.join(people, grain)
        .join(customer_review_stats(reviews, grain), grain, "left")
        .select(
            "customer_sk",
            "customer_unique_id",
            *_PLACE,
            days(reference, F.col("last_purchase_date")).alias("recency_days"),
            "frequency_orders",
            F.coalesce("_paid", "_value").cast("decimal(38,2)").alias("monetary_value"),
            (F.col("_value").cast("double") / n).alias("avg_order_value"),
            F.col("total_freight").cast("decimal(38,2)").alias("total_freight"),
            (F.col("total_freight").cast("double") / n).alias("avg_freight_value"),
            "total_items_purchased",
            "first_purchase_date",
            "last_purchase_date",
            days(F.col("last_purchase_date"), F.col("first_purchase_date")).alias("customer_lifetime_days"),
            F.coalesce("avg_review_score", F.lit(DEFAULT_REVIEW)).alias("avg_review_score"),
            F.coalesce("total_reviews", F.lit(0)).alias("total_reviews"),
        )
    )


def purchase_rate(df: DataFrame) -> DataFrame:
    """Orders per day between first and last purchase, 0 for a single day."""
    return df.withColumn("purchase_frequency_rate", retail.safe_ratio("frequency_orders", "customer_lifetime_days"))


def rfm_extract(
    dim_customer: DataFrame,
    items: DataFrame,
    orders: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
    reference_date: str,
    grain: str = "customer_sk",
    fanout: bool = True,
) -> DataFrame:
    """Metrics and purchase rate of the customers with positive monetary value."""
    metrics = rfm_metrics(dim_customer, items, orders, payments, reviews, reference_date, grain, fanout)
    return positive(purchase_rate(metrics), "monetary_value")


def customer_value_band(df: DataFrame, score: str = "rfm_score") -> DataFrame:
    """Band of a total score; each band holds its upper bound, 0 is in none."""
    band = F.when(F.col(score) <= 0, None)
    for bound, name in VALUE_BANDS:
        band = band.when(F.col(score) <= bound, F.lit(name))
    return df.withColumn("customer_value", band)


def rfm_total_score(df: DataFrame) -> DataFrame:
    return df.withColumn("rfm_score", F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score"))


def rfm_features(rfm: DataFrame, tie: str = "customer_sk") -> DataFrame:
    """Quintile scores, total score and value band.

    The metrics are written once, since each score looks at all of them.
    """
    scored = score_by_value(materialize(rfm, "rfm"), "recency_days", "recency_score")
    scored = score_by_rank(scored, "frequency_orders", tie, "frequency_score")
    scored = score_by_rank(scored, "monetary_value", tie, "monetary_score")
    return customer_value_band(rfm_total_score(scored))
