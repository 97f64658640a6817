"""Declared layouts of the source, dimension, fact and mart tables.

All names, types and column orders in this module are fixed values: they are
the data model that users of the warehouse query.
"""

from __future__ import annotations

from pyspark.sql import types as T

LAYERS = ["staging", "dimensions", "facts", "marts", "rejected"]


_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
    "boolean": T.BooleanType(), "date": T.DateType(), "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(), "decimal(10,2)": T.DecimalType(10, 2),
    "decimal(15,2)": T.DecimalType(15, 2), "decimal(38,2)": T.DecimalType(38, 2),
}


def _schema(text: str) -> T.StructType:
    """Layout from ``name type`` pairs; needs no running session."""
    pairs = [pair.split() for pair in text.replace(", ", ",\n").split(",\n")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Source columns. Files are read as text first; these are the typed targets.
# Timestamps stay text in staging because they may hold missing-value tokens.
STAGING = {
    "stg_customers": _schema("""customer_id string, customer_unique_id string, customer_zip_code_prefix string,
        customer_city string, customer_state string"""),
    "stg_products": _schema("""product_id string, product_category_name string, product_name_lenght string,
        product_description_lenght string, product_photos_qty string, product_weight_g string,
        product_length_cm string, product_height_cm string, product_width_cm string"""),
    "stg_sellers": _schema("""seller_id string, seller_zip_code_prefix string, seller_city string,
        seller_state string"""),
    "stg_orders": _schema("""order_id string, customer_id string, order_status string,
        order_purchase_timestamp string, order_approved_at string, order_delivered_carrier_date string,
        order_delivered_customer_date string, order_estimated_delivery_date string"""),
    "stg_order_items": _schema("""order_id string, order_item_id int, product_id string, seller_id string,
        shipping_limit_date string, price decimal(10,2), freight_value decimal(10,2)"""),
    "stg_payments": _schema("""order_id string, payment_sequential int, payment_type string,
        payment_installments int, payment_value decimal(10,2)"""),
    "stg_reviews": _schema("""review_id string, order_id string, review_score int, review_comment_title string,
        review_comment_message string, review_creation_date string, review_answer_timestamp string"""),
    "stg_product_categories": _schema("product_category_name string, product_category_name_english string"),
}

# Source file of each staging table, before an optional common prefix.
SOURCE_FILES = {
    "stg_customers": "customers_dataset.csv",
    "stg_products": "products_dataset.csv",
    "stg_sellers": "sellers_dataset.csv",
    "stg_orders": "orders_dataset.csv",
    "stg_order_items": "order_items_dataset.csv",
    "stg_payments": "order_payments_dataset.csv",
    "stg_reviews": "order_reviews_dataset.csv",
    "stg_product_categories": "product_category_name_translation.csv",
}

DIMENSIONS = {
    "dim_date": _schema("""date_key int, full_date date, year int, quarter int, month int, day int,
        day_of_week int, week_of_year int, month_name string, day_name string, is_weekend boolean,
        is_holiday boolean, fiscal_year int, fiscal_quarter int, created_date timestamp, updated_date timestamp"""),
    "dim_customer": _schema("""customer_sk bigint, customer_id string, customer_unique_id string,
        customer_zip_code_prefix string, customer_city string, customer_state string, customer_region string,
        record_hash string, created_date timestamp, updated_date timestamp, is_active boolean"""),
    "dim_product": _schema("""product_sk bigint, product_id string, product_category_name string,
        product_category_english string, product_name_lenght int, product_description_lenght int,
        product_photos_qty int, product_weight_g decimal(10,2), product_length_cm decimal(10,2),
        product_height_cm decimal(10,2), product_width_cm decimal(10,2), product_volume_cm3 decimal(15,2),
        product_size_category string, effective_start_date timestamp_ntz, effective_end_date timestamp_ntz,
        is_current boolean, record_hash string, created_date timestamp"""),
    "dim_seller": _schema("""seller_sk bigint, seller_id string, seller_zip_code_prefix string, seller_city string,
        seller_state string, seller_region string, record_hash string, created_date timestamp,
        updated_date timestamp, is_active boolean"""),
    "dim_order_status": _schema("""order_status_sk bigint, order_id string, order_status string,
        order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz,
        order_delivered_carrier_date timestamp_ntz, order_delivered_customer_date timestamp_ntz,
        order_estimated_delivery_date timestamp_ntz, approval_delay_hours int, delivery_delay_days int,
        total_delivery_days int, is_delivered_on_time boolean, delivery_performance_category string,
        record_hash string, created_date timestamp, updated_date timestamp"""),
}

FACTS = {
    "fact_order_items": _schema("""order_item_sk bigint, order_id string, order_item_id int, customer_sk bigint,
        product_sk bigint, seller_sk bigint, order_status_sk bigint, order_date_key int, shipping_date_key int,
        item_price decimal(10,2), freight_value decimal(10,2), total_item_value decimal(10,2),
        shipping_limit_date timestamp_ntz, created_date timestamp"""),
    "fact_payments": _schema("""payment_sk bigint, order_id string, payment_sequential int, order_date_key int,
        order_status_sk bigint, payment_installments int, payment_value decimal(10,2), payment_type string,
        created_date timestamp"""),
    "fact_reviews": _schema("""review_sk bigint, review_id string, order_id string, customer_sk bigint,
        order_status_sk bigint, review_date_key int, answer_date_key int, review_score int,
        review_comment_title string, review_comment_message string, review_creation_date timestamp_ntz,
        review_answer_timestamp timestamp_ntz, review_category string, response_time_hours int,
        created_date timestamp"""),
}

MARTS = {
    "agg_monthly_sales": _schema("""sales_agg_sk bigint, year_month int, year int, month int, month_name string, total_orders bigint,
        total_items bigint, total_revenue decimal(38,2), total_freight decimal(38,2), avg_order_value double,
        avg_items_per_order decimal(10,2), unique_customers bigint, new_customers bigint, unique_products bigint,
        unique_states bigint, last_updated timestamp"""),
    "agg_product_performance": _schema("""product_perf_sk bigint, product_sk bigint, last_12_months_revenue decimal(38,2),
        last_12_months_orders bigint, last_12_months_items bigint, avg_price double, avg_review_score double,
        total_reviews bigint, revenue_rank bigint, volume_rank bigint, last_updated timestamp"""),
}

# Columns of the exported segmentation result.
SEGMENT_COLUMNS = [
    "customer_sk", "customer_unique_id", "customer_state", "customer_region", "recency_days", "frequency_orders",
    "monetary_value", "avg_order_value", "avg_review_score", "customer_lifetime_days", "rfm_score", "customer_value",
    "kmeans_cluster", "dbscan_cluster", "segment_label", "pca_1", "pca_2",
]

# Features used for clustering.
FEATURE_COLUMNS = [
    "recency_days", "frequency_orders", "monetary_value", "avg_order_value", "avg_review_score",
    "purchase_frequency_rate", "customer_lifetime_days",
]

WAREHOUSE = {"staging": STAGING, "dimensions": DIMENSIONS, "facts": FACTS, "marts": MARTS}


def table_schema(table: str) -> T.StructType:
    for tables in WAREHOUSE.values():
        if table in tables:
            return tables[table]
    raise KeyError(table)
