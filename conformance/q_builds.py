"""Dimension, fact and mart builds."""

from __future__ import annotations

from conformance.registry import query
from conformance.star import star
from tradewind.plans import dimensions, facts, marts, warehouse

_MONTHLY = """SELECT sales_agg_sk, year_month, year, month, month_name, total_orders, total_items,
    CAST(total_revenue AS DOUBLE) AS total_revenue, CAST(total_freight AS DOUBLE) AS total_freight, avg_order_value,
    CAST(avg_items_per_order AS DOUBLE) AS avg_items_per_order, unique_customers, new_customers, unique_products,
    unique_states FROM agg_monthly_sales"""


@query("monthly_sales", _MONTHLY)
def monthly_sales(spark, sf_dir):
    s = star(spark, sf_dir)
    return marts.monthly_sales(s["fact_order_items"], s["dim_date"], s["dim_customer"])


@query("dim_date", "SELECT * REPLACE (CAST(full_date AS VARCHAR) AS full_date) FROM dim_date")
def dim_date(spark, sf_dir):
    return dimensions.build_dim_date(star(spark, sf_dir))


@query("dim_customer", "SELECT *, TRUE AS is_active FROM dim_customer")
def dim_customer(spark, sf_dir):
    return warehouse.build_table("dim_customer", star(spark, sf_dir))


@query("dim_seller", "SELECT *, TRUE AS is_active FROM dim_seller")
def dim_seller(spark, sf_dir):
    return warehouse.build_table("dim_seller", star(spark, sf_dir))


_SIZES = ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm", "product_volume_cm3"]


@query("dim_product", f"""SELECT * REPLACE ({', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in _SIZES)}),
    '2999-12-31 00:00:00' AS effective_end_date, TRUE AS is_current FROM dim_product""")
def dim_product(spark, sf_dir):
    return warehouse.build_table("dim_product", star(spark, sf_dir))


_TIMES = """CAST(purchased AS VARCHAR) AS order_purchase_timestamp, CAST(approved AS VARCHAR) AS order_approved_at,
    CAST(carried AS VARCHAR) AS order_delivered_carrier_date, CAST(delivered AS VARCHAR) AS order_delivered_customer_date,
    CAST(estimated AS VARCHAR) AS order_estimated_delivery_date"""


@query("dim_order_status", f"""SELECT order_status_sk, order_id, order_status, {_TIMES}, approval_delay_hours,
    delivery_delay_days, total_delivery_days, is_delivered_on_time, delivery_performance_category, record_hash
    FROM dim_order_status""")
def dim_order_status(spark, sf_dir):
    return warehouse.build_table("dim_order_status", star(spark, sf_dir))


_KNOWN = "delivered IS NOT NULL AND estimated IS NOT NULL"


@query("dim_order_status_raw", f"""
    SELECT order_id, order_status, record_hash, {_TIMES}, approval_delay_hours, delivery_delay_days, total_delivery_days,
           {_KNOWN} AND delivery_delay_days <= 0 AS is_delivered_on_time,
           CASE WHEN {_KNOWN} THEN CASE WHEN delivery_delay_days < -5 THEN 'Early' WHEN delivery_delay_days <= 0 THEN 'On Time'
                WHEN delivery_delay_days <= 5 THEN 'Slightly Late' ELSE 'Very Late' END
           ELSE 'Unknown' END AS delivery_performance_category
    FROM (SELECT *, COALESCE(CAST(floor(epoch(approved - purchased) / 3600) AS INTEGER), 0) AS approval_delay_hours,
                 COALESCE(CAST(CAST(delivered AS DATE) - CAST(estimated AS DATE) AS INTEGER), 0) AS delivery_delay_days,
                 COALESCE(CAST(CAST(delivered AS DATE) - CAST(purchased AS DATE) AS INTEGER), 0) AS total_delivery_days
          FROM order_times)""")
def dim_order_status_raw(spark, sf_dir):
    return dimensions.build_dim_order_status(star(spark, sf_dir)["stg_orders"], impute=False)


@query("fact_order_items", """SELECT * REPLACE (CAST(item_price AS DOUBLE) AS item_price, CAST(freight_value AS DOUBLE) AS freight_value,
    CAST(total_item_value AS DOUBLE) AS total_item_value, CAST(shipping_limit_date AS VARCHAR) AS shipping_limit_date)
    FROM fact_order_items""")
def fact_order_items(spark, sf_dir):
    return warehouse.build_table("fact_order_items", star(spark, sf_dir))


@query("fact_payments", "SELECT * REPLACE (CAST(payment_value AS DOUBLE) AS payment_value) FROM fact_payments")
def fact_payments(spark, sf_dir):
    return warehouse.build_table("fact_payments", star(spark, sf_dir))


@query("fact_reviews", """SELECT * REPLACE (CAST(review_creation_date AS VARCHAR) AS review_creation_date,
    CAST(review_answer_timestamp AS VARCHAR) AS review_answer_timestamp) FROM fact_reviews""")
def fact_reviews(spark, sf_dir):
    return warehouse.build_table("fact_reviews", star(spark, sf_dir))


@query("agg_product_performance", """SELECT * REPLACE (CAST(last_12_months_revenue AS DOUBLE) AS last_12_months_revenue)
    FROM agg_product_performance""")
def agg_product_performance(spark, sf_dir):
    return warehouse.build_table("agg_product_performance", star(spark, sf_dir))
