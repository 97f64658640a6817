"""Fact builds: staging rows with dimension keys resolved, without their own key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions import calendar as cal
from tradewind.functions import retail, text
from tradewind.plans.dimensions import with_hash
from tradewind.sources.schemas import FACTS

# Keys of the source that a fact row replaces by dimension keys; candidate rows keep them, so that a rejected row can be traced.
SOURCE_KEYS = {"fact_order_items": ["product_id", "seller_id"]}

# Fixed value: payment type of a payment without one.
UNDEFINED_PAYMENT = "not_defined"


def order_lookup(
    orders: DataFrame, dim_order_status: DataFrame, dim_customer: DataFrame | None = None, how: str = "inner"
) -> DataFrame:
    """One row per order: its keys and purchase date key.

    Customers are resolved here, at order grain, so that the larger item,
    payment and review tables are shuffled on ``order_id`` only. Of source rows
    that repeat an order, the one that was loaded counts, so that an order is
    never looked up twice. ``how="left"`` keeps orders with unresolved keys.
    """
    status = dim_order_status.select("order_id", "order_status_sk", F.col("record_hash").alias("_loaded"))
    known = with_hash(orders).dropna(subset=["order_id"]).join(status, "order_id", how)
    other = F.coalesce(F.col("record_hash") != F.col("_loaded"), F.lit(True))
    first = F.min(F.struct(other, "record_hash", "customer_id", "order_purchase_timestamp", "order_status_sk"))
    lookup = known.groupBy("order_id").agg(first.alias("_o")).select(
        "order_id", "_o.customer_id", "_o.order_status_sk",
        cal.date_key(text.parse_date("_o.order_purchase_timestamp")).alias("order_date_key"),
    )
    if dim_customer is not None:
        lookup = lookup.join(dim_customer.select("customer_id", "customer_sk"), "customer_id", how)
    return lookup.drop("customer_id")


def star_key_resolution(
    items: DataFrame,
    orders: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    dim_seller: DataFrame,
    dim_order_status: DataFrame,
    keep_unresolved: bool = False,
) -> DataFrame:
    """Items with all four dimension keys; unresolved items are left out, or keep NULL keys.

    Only current product versions take part.
    """
    how = "left" if keep_unresolved else "inner"
    valid = items if keep_unresolved else items.dropna(subset=["order_id"]).where(F.col("order_item_id") > 0)
    current = dim_product.where("is_current").select("product_id", "product_sk")
    return (
        valid.join(order_lookup(orders, dim_order_status, dim_customer, how), "order_id", how)
        .join(current, "product_id", how)
        .join(dim_seller.select("seller_id", "seller_sk"), "seller_id", how)
    )


def build_fact_order_items(
    items: DataFrame,
    orders: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    dim_seller: DataFrame,
    dim_order_status: DataFrame,
    keep_unresolved: bool = False,
) -> DataFrame:
    # The time is parsed before the joins: they carry 8 bytes for it instead of its text, and its readers share one parse.
    parsed = items.withColumn("shipping_limit_date", text.parse_timestamp("shipping_limit_date"))
    resolved = star_key_resolution(
        parsed, orders, dim_customer, dim_product, dim_seller, dim_order_status, keep_unresolved
    )
    zero = F.lit(0).cast("decimal(10,2)")
    rows = resolved.withColumns(
        {
            "shipping_date_key": cal.date_key("shipping_limit_date"),
            "item_price": F.coalesce("price", zero),
            "freight_value": F.coalesce("freight_value", zero),
            "total_item_value": retail.item_total("price", "freight_value"),
            "created_date": F.current_timestamp(),
        }
    )
    return declared(rows, "fact_order_items", SOURCE_KEYS["fact_order_items"] if keep_unresolved else [])


def build_fact_payments(
    payments: DataFrame, orders: DataFrame, dim_order_status: DataFrame, keep_unresolved: bool = False
) -> DataFrame:
    how = "left" if keep_unresolved else "inner"
    keyed = payments if keep_unresolved else payments.dropna(subset=["order_id"])
    resolved = keyed.join(order_lookup(orders, dim_order_status, how=how), "order_id", how)
    rows = resolved.withColumns(
        {
            "payment_sequential": F.coalesce("payment_sequential", F.lit(1)),
            "payment_type": text.coalesce_default("payment_type", default=UNDEFINED_PAYMENT),
            "payment_installments": F.coalesce("payment_installments", F.lit(0)),
            "payment_value": F.coalesce("payment_value", F.lit(0)),
            "created_date": F.current_timestamp(),
        }
    )
    return declared(rows, "fact_payments")


def newest_first(column: str) -> Column:
    """Sort value: latest time first, missing last."""
    return F.coalesce(-F.unix_micros(F.col(column).cast("timestamp")), F.lit((1 << 63) - 1))


def latest_per_key(df: DataFrame, key: str, newest: str, tie: str) -> DataFrame:
    """One row per key: latest ``newest`` (missing last), then smallest ``tie``.

    A minimum over (age, tie, rest of the row) has partial aggregates, so one
    key with very many rows is reduced before the shuffle; a ranking window
    would bring all of them to one task.
    """
    rest = [c for c in df.columns if c not in (key, tie)]
    first = F.min(F.struct(newest_first(newest).alias("_age"), tie, *rest)).alias("_first")
    picked = df.groupBy(key).agg(first)
    return picked.select(*[F.col(c) if c == key else F.col(f"_first.{c}").alias(c) for c in df.columns])


def build_fact_reviews(
    reviews: DataFrame,
    orders: DataFrame,
    dim_customer: DataFrame,
    dim_order_status: DataFrame,
    hour_mode: str = "truncate",
    keep_unresolved: bool = False,
) -> DataFrame:
    """Reviews with their keys, the latest row of each review; ``keep_unresolved`` keeps every source row."""
    how = "left" if keep_unresolved else "inner"
    parsed = (reviews if keep_unresolved else reviews.dropna(subset=["review_id"])).withColumns(
        {c: text.parse_timestamp(c) for c in ["review_creation_date", "review_answer_timestamp"]}
    )
    lookup = order_lookup(orders, dim_order_status, dim_customer, how).drop("order_date_key")
    latest = parsed.join(lookup, "order_id", how).select(
        "review_id", "order_id", "review_creation_date", "review_answer_timestamp", "review_score",
        "review_comment_title", "review_comment_message", "customer_sk", "order_status_sk",
    )
    if not keep_unresolved:
        latest = latest_per_key(latest, "review_id", "review_creation_date", "order_id")
    rows = latest.withColumns(
        {
            "review_date_key": cal.date_key("review_creation_date"),
            "answer_date_key": cal.date_key("review_answer_timestamp"),
            "review_category": retail.review_category("review_score"),
            "review_score": F.coalesce("review_score", F.lit(0)),
            "response_time_hours": cal.elapsed_hours("review_answer_timestamp", "review_creation_date", hour_mode),
            "created_date": F.current_timestamp(),
        }
    )
    return declared(rows, "fact_reviews")


def declared(df: DataFrame, table: str, more: list[str] = ()) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in FACTS[table] if f.name in df.columns], *more)
