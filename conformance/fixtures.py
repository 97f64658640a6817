"""Source-shaped staging tables derived from the shared test tables.

The same derivations are written in SQL in ``conformance/ctes.py``. All rows of
the input tables take part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# State code by nation number.
UF = ["AC", "AL", "AM", "AP", "BA", "CE", "DF", "ES", "GO", "MA", "MG", "MS", "MT", "PA", "PB", "PE", "PI", "PR",
      "RJ", "RN", "RO", "RR", "RS", "SC", "SE", "SP", "TO"]

REFERENCE_DATE = "2001-12-31"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def read_spread(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table spread over all cores: the test files hold a single row group, which one task would read."""
    df, cores = read(spark, sf_dir, table), spark.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def text(c: Column) -> Column:
    return c.cast("string")


def _mod(c: Column, n: int) -> Column:
    return c % F.lit(n)


def _state(nation: Column) -> Column:
    return F.lower(F.element_at(F.array(*[F.lit(s) for s in UF]), nation.cast("int") + 1))


def stg_customers(spark: SparkSession, sf_dir: str, read=read) -> DataFrame:
    key = F.col("c_custkey")
    return read(spark, sf_dir, "customer").select(
        text(key).alias("customer_id"),
        F.concat(F.lit("u"), text(key - _mod(key, 2))).alias("customer_unique_id"),
        text(1000 + _mod(key, 90000)).alias("customer_zip_code_prefix"),
        F.when(_mod(key, 97) != 0, F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit("-d'oeste "))).alias("customer_city"),
        F.when(_mod(key, 89) != 0, F.concat(F.lit(" "), _state(F.col("c_nationkey")))).alias("customer_state"),
    )


def stg_sellers(spark: SparkSession, sf_dir: str, read=read) -> DataFrame:
    key = F.col("s_suppkey")
    return read(spark, sf_dir, "supplier").select(
        text(key).alias("seller_id"),
        text(1000 + _mod(key, 90000)).alias("seller_zip_code_prefix"),
        F.when(_mod(key, 97) != 0, F.concat(F.lit("  "), F.lower("s_name"), F.lit(" "))).alias("seller_city"),
        F.when(_mod(key, 89) != 0, F.concat(F.lit(" "), _state(F.col("s_nationkey")))).alias("seller_state"),
    )


def stg_products(spark: SparkSession, sf_dir: str, read=read) -> DataFrame:
    key = F.col("p_partkey")
    return read(spark, sf_dir, "part").select(
        text(key).alias("product_id"),
        F.when(_mod(key, 53) != 0, F.lower("p_type")).alias("product_category_name"),
        text(F.length("p_name")).alias("product_name_lenght"),
        text(_mod(key, 900)).alias("product_description_lenght"),
        text(_mod(key, 7)).alias("product_photos_qty"),
        text(F.col("p_retailprice").cast("decimal(10,2)")).alias("product_weight_g"),
        F.when(_mod(key, 61) == 0, F.lit("NaN")).otherwise(text(F.col("p_size"))).alias("product_length_cm"),
        text(1 + _mod(key, 40)).alias("product_height_cm"),
        text(1 + _mod(key, 37)).alias("product_width_cm"),
    )


def stg_product_categories(spark: SparkSession, sf_dir: str, read=read) -> DataFrame:
    """Translations of the categories that have one; the others use the fallback."""
    name = F.lower("p_type")
    english = (
        F.when(name == "economy", "Economy").when(name == "standard", "Standard")
        .when(name == "medium", "Medium range").when(name == "large", "Large")
    )
    return read(spark, sf_dir, "part").select(
        name.alias("product_category_name"), english.alias("product_category_name_english")
    ).where("product_category_name_english IS NOT NULL").distinct()


def _time_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def _later(c: Column, hours: Column) -> Column:
    return c + F.make_dt_interval(F.lit(0), hours.cast("int"))


def stg_orders(spark: SparkSession, sf_dir: str, read=read) -> DataFrame:
    k, t, status = F.col("o_orderkey"), F.col("o_orderdate"), F.col("o_orderstatus")
    nan, blank = F.lit("NaN"), F.lit("")
    delivered = F.when((status != "P") & (_mod(k, 23) != 0), _time_text(_later(t, 24 * (2 + _mod(k, 27)) + _mod(k, 24))))
    return read(spark, sf_dir, "orders").select(
        text(k).alias("order_id"),
        text(F.col("o_custkey")).alias("customer_id"),
        F.when(status == "F", "delivered").when(status == "O", "shipped").otherwise("processing").alias("order_status"),
        F.when(_mod(k, 499) == 7, nan).otherwise(_time_text(t)).alias("order_purchase_timestamp"),
        F.when(_mod(k, 17) == 0, blank).otherwise(_time_text(_later(t, _mod(k, 48)))).alias("order_approved_at"),
        F.when(_mod(k, 19) == 0, nan).otherwise(_time_text(_later(t, 48 + _mod(k, 72)))).alias("order_delivered_carrier_date"),
        delivered.alias("order_delivered_customer_date"),
        F.when(_mod(k, 11) == 0, blank).otherwise(_time_text(_later(t, F.lit(348)))).alias("order_estimated_delivery_date"),
    )


def stg_order_items(spark: SparkSession, sf_dir: str, read=read) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(10,2)")
    return read(spark, sf_dir, "lineitem").select(
        text(F.col("l_orderkey")).alias("order_id"),
        F.col("l_linenumber").cast("int").alias("order_item_id"),
        text(F.col("l_partkey")).alias("product_id"),
        text(F.col("l_suppkey")).alias("seller_id"),
        _time_text(F.col("l_shipdate")).alias("shipping_limit_date"),
        price.alias("price"),
        (price * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(10,2)").alias("freight_value"),
    )


def stg_payments(spark: SparkSession, sf_dir: str, read=read) -> DataFrame:
    """Every order is paid once; orders of medium priority pay a second, smaller voucher."""
    priority = F.substring("o_orderpriority", 1, 1)
    kind = (
        F.when(priority == "1", "credit_card").when(priority == "2", "boleto").when(priority == "3", "voucher")
        .when(priority == "5", "debit_card")
    )
    value = F.col("o_totalprice").cast("decimal(10,2)")
    first = F.struct(
        F.lit(1).alias("payment_sequential"), kind.alias("payment_type"),
        _mod(F.col("o_orderkey"), 10).cast("int").alias("payment_installments"), value.alias("payment_value"),
    )
    second = F.when(
        priority == "3",
        F.struct(
            F.lit(2).alias("payment_sequential"), F.lit("voucher").alias("payment_type"),
            F.lit(1).alias("payment_installments"), (value * F.lit("0.10").cast("decimal(3,2)")).cast("decimal(10,2)").alias("payment_value"),
        ),
    )
    return read(spark, sf_dir, "orders").select(
        text(F.col("o_orderkey")).alias("order_id"), F.inline(F.array_compact(F.array(first, second)))
    )


def stg_reviews(spark: SparkSession, sf_dir: str, read=read) -> DataFrame:
    """Orders that left processing are reviewed; urgent orders carry a further review.

    Some review ids repeat, as neighbouring keys share one.
    """
    k, t = F.col("o_orderkey"), F.col("o_orderdate")
    created = _later(t, 24 * _mod(k, 9))
    main = F.when(
        F.col("o_orderstatus") != "P",
        F.struct(
            F.concat(F.lit("r"), text(F.when(_mod(k, 10) == 1, k - 1).otherwise(k))).alias("review_id"),
            F.when(_mod(k, 101) != 0, 1 + _mod(7 * k, 5)).cast("int").alias("review_score"),
            _time_text(created).alias("review_creation_date"),
            F.when(_mod(k, 13) == 0, F.lit("NaN")).otherwise(_time_text(_later(created, _mod(k, 100)))).alias("review_answer_timestamp"),
        ),
    )
    further = F.when(
        F.col("o_orderpriority").startswith("1"),
        F.struct(
            F.concat(F.lit("x"), text(k)).alias("review_id"),
            (1 + _mod(k, 5)).cast("int").alias("review_score"),
            _time_text(t).alias("review_creation_date"),
            F.lit("").alias("review_answer_timestamp"),
        ),
    )
    rows = read(spark, sf_dir, "orders").select(
        text(k).alias("order_id"), F.inline(F.array_compact(F.array(main, further)))
    )
    return rows.select(
        "review_id", "order_id", "review_score",
        F.lit(None).cast("string").alias("review_comment_title"),
        F.concat(F.lit('said "'), F.col("review_id"), F.lit('"\nthanks')).alias("review_comment_message"),
        "review_creation_date", "review_answer_timestamp",
    )


STAGING = {
    f.__name__: f
    for f in [stg_customers, stg_products, stg_sellers, stg_orders, stg_order_items, stg_payments, stg_reviews,
              stg_product_categories]
}


class Staging(dict):
    """Staging tables by name, each derived when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir

    def __missing__(self, name: str) -> DataFrame:
        self[name] = STAGING[name](self.spark, self.sf_dir)
        return self[name]


def staging(spark: SparkSession, sf_dir: str) -> Staging:
    return Staging(spark, sf_dir)
