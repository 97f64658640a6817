"""Named SQL steps from the shared test tables to the star schema, for the expected results."""

from __future__ import annotations

import re

from conformance.fixtures import REFERENCE_DATE, UF

_UF = "[" + ", ".join(f"'{s}'" for s in UF) + "]"
_FMT = "'%Y-%m-%d %H:%M:%S'"


def capitalized(expr: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all(lower({expr}), '[\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+'), "
        "lambda w: upper(w[1]) || w[2:]), '')"
    )


def region(expr: str) -> str:
    return f"""CASE
        WHEN {expr} IN ('AC','AM','AP','PA','RO','RR','TO') THEN 'Norte'
        WHEN {expr} IN ('AL','BA','CE','MA','PB','PE','PI','RN','SE') THEN 'Nordeste'
        WHEN {expr} IN ('DF','GO','MS','MT') THEN 'Centro-Oeste'
        WHEN {expr} IN ('ES','MG','RJ','SP') THEN 'Sudeste'
        WHEN {expr} IN ('PR','RS','SC') THEN 'Sul' ELSE 'Unknown' END"""


def size_class(expr: str) -> str:
    return (
        f"CASE WHEN {expr} <= 1000 THEN 'Small' WHEN {expr} <= 10000 THEN 'Medium' "
        f"WHEN {expr} <= 50000 THEN 'Large' ELSE 'Extra Large' END"
    )


def stamp(expr: str) -> str:
    """Text to timestamp, missing-value tokens and bad text to NULL."""
    return f"TRY_CAST(NULLIF(NULLIF({expr}, ''), 'NaN') AS TIMESTAMP)"


def number(expr: str, to: str) -> str:
    return f"COALESCE(TRY_CAST(NULLIF(NULLIF({expr}, ''), 'NaN') AS {to}), 0)"


def day_key(expr: str) -> str:
    return f"CAST(strftime({expr}, '%Y%m%d') AS INTEGER)"


def delay_class(expr: str) -> str:
    return (
        f"CASE WHEN {expr} < -5 THEN 'Early' WHEN {expr} <= 0 THEN 'On Time' "
        f"WHEN {expr} <= 5 THEN 'Slightly Late' ELSE 'Very Late' END"
    )


def floor_days(end: str, start: str) -> str:
    return f"COALESCE(CAST(floor(epoch({end} - {start}) / 86400) AS INTEGER), 0)"


def trunc_hours(end: str, start: str) -> str:
    return f"COALESCE(CAST(trunc(epoch({end} - {start}) / 3600) AS INTEGER), 0)"


def _staged_hash(table: str, columns: str) -> str:
    texts = ", ".join(f"CAST({c.strip()} AS VARCHAR)" for c in columns.split(","))
    return f"md5(concat_ws('|', {texts}))"


_ORDER_COLUMNS = (
    "order_id, customer_id, order_status, order_purchase_timestamp, order_approved_at, "
    "order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date"
)
_PRODUCT_COLUMNS = (
    "product_id, product_category_name, product_name_lenght, product_description_lenght, product_photos_qty, "
    "product_weight_g, product_length_cm, product_height_cm, product_width_cm"
)

CTES: dict[str, str] = {
    "stg_customers": f"""
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
               'u' || CAST(c_custkey - c_custkey % 2 AS VARCHAR) AS customer_unique_id,
               CAST(1000 + c_custkey % 90000 AS VARCHAR) AS customer_zip_code_prefix,
               CASE WHEN c_custkey % 97 <> 0 THEN '  ' || lower(c_mktsegment) || '-d''oeste ' END AS customer_city,
               CASE WHEN c_custkey % 89 <> 0 THEN ' ' || lower({_UF}[c_nationkey + 1]) END AS customer_state
        FROM customer""",
    "stg_sellers": f"""
        SELECT CAST(s_suppkey AS VARCHAR) AS seller_id,
               CAST(1000 + s_suppkey % 90000 AS VARCHAR) AS seller_zip_code_prefix,
               CASE WHEN s_suppkey % 97 <> 0 THEN '  ' || lower(s_name) || ' ' END AS seller_city,
               CASE WHEN s_suppkey % 89 <> 0 THEN ' ' || lower({_UF}[s_nationkey + 1]) END AS seller_state
        FROM supplier""",
    "stg_products": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id,
               CASE WHEN p_partkey % 53 <> 0 THEN lower(p_type) END AS product_category_name,
               CAST(length(p_name) AS VARCHAR) AS product_name_lenght,
               CAST(p_partkey % 900 AS VARCHAR) AS product_description_lenght,
               CAST(p_partkey % 7 AS VARCHAR) AS product_photos_qty,
               CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS VARCHAR) AS product_weight_g,
               CASE WHEN p_partkey % 61 = 0 THEN 'NaN' ELSE CAST(p_size AS VARCHAR) END AS product_length_cm,
               CAST(1 + p_partkey % 40 AS VARCHAR) AS product_height_cm,
               CAST(1 + p_partkey % 37 AS VARCHAR) AS product_width_cm
        FROM part""",
    "stg_product_categories": """
        SELECT DISTINCT lower(p_type) AS product_category_name,
               CASE lower(p_type) WHEN 'economy' THEN 'Economy' WHEN 'standard' THEN 'Standard'
                    WHEN 'medium' THEN 'Medium range' WHEN 'large' THEN 'Large' END AS product_category_name_english
        FROM part WHERE lower(p_type) IN ('economy', 'standard', 'medium', 'large')""",
    "stg_orders": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
               CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'processing' END AS order_status,
               CASE WHEN o_orderkey % 499 = 7 THEN 'NaN' ELSE strftime(o_orderdate, {_FMT}) END AS order_purchase_timestamp,
               CASE WHEN o_orderkey % 17 = 0 THEN ''
                    ELSE strftime(o_orderdate + to_hours(o_orderkey % 48), {_FMT}) END AS order_approved_at,
               CASE WHEN o_orderkey % 19 = 0 THEN 'NaN'
                    ELSE strftime(o_orderdate + to_hours(48 + o_orderkey % 72), {_FMT}) END AS order_delivered_carrier_date,
               CASE WHEN o_orderstatus <> 'P' AND o_orderkey % 23 <> 0
                    THEN strftime(o_orderdate + to_hours(24 * (2 + o_orderkey % 27) + o_orderkey % 24), {_FMT})
               END AS order_delivered_customer_date,
               CASE WHEN o_orderkey % 11 = 0 THEN ''
                    ELSE strftime(o_orderdate + to_hours(348), {_FMT}) END AS order_estimated_delivery_date
        FROM orders""",
    "stg_order_items": f"""
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS INTEGER) AS order_item_id,
               CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
               strftime(l_shipdate, {_FMT}) AS shipping_limit_date,
               CAST(l_extendedprice AS DECIMAL(10,2)) AS price,
               CAST(CAST(l_extendedprice AS DECIMAL(10,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(10,2)) AS freight_value
        FROM lineitem""",
    "stg_payments": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, 1 AS payment_sequential,
               CASE left(o_orderpriority, 1) WHEN '1' THEN 'credit_card' WHEN '2' THEN 'boleto'
                    WHEN '3' THEN 'voucher' WHEN '5' THEN 'debit_card' END AS payment_type,
               CAST(o_orderkey % 10 AS INTEGER) AS payment_installments,
               CAST(o_totalprice AS DECIMAL(10,2)) AS payment_value
        FROM orders
        UNION ALL
        SELECT CAST(o_orderkey AS VARCHAR), 2, 'voucher', 1,
               CAST(CAST(o_totalprice AS DECIMAL(10,2)) * CAST(0.10 AS DECIMAL(3,2)) AS DECIMAL(10,2))
        FROM orders WHERE left(o_orderpriority, 1) = '3'""",
    "stg_reviews_short": f"""
        SELECT 'r' || CAST(CASE WHEN o_orderkey % 10 = 1 THEN o_orderkey - 1 ELSE o_orderkey END AS VARCHAR) AS review_id,
               CAST(o_orderkey AS VARCHAR) AS order_id,
               CASE WHEN o_orderkey % 101 <> 0 THEN CAST(1 + (7 * o_orderkey) % 5 AS INTEGER) END AS review_score,
               strftime(o_orderdate + to_hours(24 * (o_orderkey % 9)), {_FMT}) AS review_creation_date,
               CASE WHEN o_orderkey % 13 = 0 THEN 'NaN'
                    ELSE strftime(o_orderdate + to_hours(24 * (o_orderkey % 9) + o_orderkey % 100), {_FMT})
               END AS review_answer_timestamp
        FROM orders WHERE o_orderstatus <> 'P'
        UNION ALL
        SELECT 'x' || CAST(o_orderkey AS VARCHAR), CAST(o_orderkey AS VARCHAR), CAST(1 + o_orderkey % 5 AS INTEGER),
               strftime(o_orderdate, {_FMT}), ''
        FROM orders WHERE left(o_orderpriority, 1) = '1'""",
    "stg_reviews": """
        SELECT review_id, order_id, review_score, CAST(NULL AS VARCHAR) AS review_comment_title,
               'said "' || review_id || '"' || chr(10) || 'thanks' AS review_comment_message,
               review_creation_date, review_answer_timestamp
        FROM stg_reviews_short""",
    "source_dates": f"""
        SELECT DISTINCT CAST(t AS DATE) AS full_date FROM (
            SELECT {stamp('order_purchase_timestamp')} AS t FROM stg_orders
            UNION ALL SELECT {stamp('order_approved_at')} FROM stg_orders
            UNION ALL SELECT {stamp('order_delivered_customer_date')} FROM stg_orders
            UNION ALL SELECT {stamp('review_creation_date')} FROM stg_reviews
            UNION ALL SELECT {stamp('review_answer_timestamp')} FROM stg_reviews
            UNION ALL SELECT {stamp('shipping_limit_date')} FROM stg_order_items)
        WHERE t IS NOT NULL""",
    "dim_date": f"""
        SELECT {day_key('full_date')} AS date_key, full_date,
               CAST(year(full_date) AS INTEGER) AS year, CAST(quarter(full_date) AS INTEGER) AS quarter,
               CAST(month(full_date) AS INTEGER) AS month, CAST(day(full_date) AS INTEGER) AS day,
               CAST(isodow(full_date) AS INTEGER) AS day_of_week,
               CAST(weekofyear(full_date) AS INTEGER) AS week_of_year,
               monthname(full_date) AS month_name, dayname(full_date) AS day_name,
               isodow(full_date) >= 6 AS is_weekend, FALSE AS is_holiday,
               CAST(year(full_date) + CASE WHEN month(full_date) >= 7 THEN 1 ELSE 0 END AS INTEGER) AS fiscal_year,
               CAST((month(full_date) - 1) // 3 + 1 AS INTEGER) AS fiscal_quarter
        FROM source_dates""",
    "customer_rows": f"""
        SELECT customer_id, customer_unique_id, customer_zip_code_prefix,
               {capitalized("trim(COALESCE(customer_city, 'Unknown'))")} AS customer_city,
               upper(trim(COALESCE(customer_state, 'Unknown'))) AS customer_state,
               {_staged_hash('stg_customers', 'customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state')} AS record_hash
        FROM stg_customers""",
    "dim_customer": f"""
        SELECT row_number() OVER (ORDER BY customer_id) AS customer_sk, *,
               {region('customer_state')} AS customer_region
        FROM customer_rows WHERE length(customer_state) = 2""",
    "seller_rows": f"""
        SELECT seller_id, seller_zip_code_prefix, {capitalized("trim(COALESCE(seller_city, 'Unknown'))")} AS seller_city,
               upper(trim(COALESCE(seller_state, 'Unknown'))) AS seller_state,
               {_staged_hash('stg_sellers', 'seller_id, seller_zip_code_prefix, seller_city, seller_state')} AS record_hash
        FROM stg_sellers""",
    "dim_seller": f"""
        SELECT row_number() OVER (ORDER BY seller_id) AS seller_sk, *, {region('seller_state')} AS seller_region
        FROM seller_rows WHERE length(seller_state) = 2""",
    "product_rows": f"""
        SELECT p.product_id, COALESCE(p.product_category_name, 'Unknown') AS product_category_name,
               COALESCE(c.product_category_name_english, p.product_category_name, 'Unknown') AS product_category_english,
               {number('product_name_lenght', 'INTEGER')} AS product_name_lenght,
               {number('product_description_lenght', 'INTEGER')} AS product_description_lenght,
               {number('product_photos_qty', 'INTEGER')} AS product_photos_qty,
               {number('product_weight_g', 'DECIMAL(10,2)')} AS product_weight_g,
               {number('product_length_cm', 'DECIMAL(10,2)')} AS product_length_cm,
               {number('product_height_cm', 'DECIMAL(10,2)')} AS product_height_cm,
               {number('product_width_cm', 'DECIMAL(10,2)')} AS product_width_cm,
               {_staged_hash('p', ', '.join('p.' + c.strip() for c in _PRODUCT_COLUMNS.split(',')))} AS record_hash
        FROM stg_products p LEFT JOIN stg_product_categories c ON p.product_category_name = c.product_category_name""",
    "dim_product": f"""
        SELECT row_number() OVER (ORDER BY product_id) AS product_sk, *, {size_class('product_volume_cm3')} AS product_size_category
        FROM (SELECT *, CAST(CAST(product_length_cm AS DOUBLE) * CAST(product_height_cm AS DOUBLE) * CAST(product_width_cm AS DOUBLE)
                             AS DECIMAL(15,2)) AS product_volume_cm3
              FROM product_rows)""",
    "order_times": f"""
        SELECT order_id, order_status, {stamp('order_purchase_timestamp')} AS purchased, {stamp('order_approved_at')} AS approved,
               {stamp('order_delivered_carrier_date')} AS carried, {stamp('order_delivered_customer_date')} AS delivered,
               {stamp('order_estimated_delivery_date')} AS estimated,
               {_staged_hash('stg_orders', _ORDER_COLUMNS)} AS record_hash
        FROM stg_orders""",
    "order_filled": """
        SELECT order_id, order_status, purchased, record_hash,
               COALESCE(approved, base + to_hours(2)) AS approved,
               COALESCE(carried, COALESCE(approved, base + to_hours(2)) + to_days(2)) AS carried,
               COALESCE(delivered, estimated, base + to_days(10)) AS delivered,
               COALESCE(estimated, base + to_days(15)) AS estimated
        FROM (SELECT *, COALESCE(purchased, TIMESTAMP '2018-01-01') AS base FROM order_times)""",
    "order_measured": f"""
        SELECT *, {trunc_hours('approved', 'purchased')} AS approval_delay_hours,
               {floor_days('delivered', 'estimated')} AS delivery_delay_days,
               {floor_days('delivered', 'purchased')} AS total_delivery_days
        FROM order_filled""",
    "dim_order_status": f"""
        SELECT row_number() OVER (ORDER BY order_id) AS order_status_sk, *, delivery_delay_days <= 0 AS is_delivered_on_time,
               {delay_class('delivery_delay_days')} AS delivery_performance_category
        FROM order_measured
        WHERE purchased IS NOT NULL AND approval_delay_hours >= 0 AND total_delivery_days >= 0
          AND purchased <= approved AND purchased <= estimated""",
    "order_keys": f"""
        SELECT o.order_id, s.order_status_sk, c.customer_sk,
               {day_key(f"CAST({stamp('o.order_purchase_timestamp')} AS DATE)")} AS order_date_key
        FROM stg_orders o JOIN dim_order_status s USING (order_id) LEFT JOIN dim_customer c USING (customer_id)""",
    "fact_order_items": f"""
        SELECT row_number() OVER (ORDER BY order_id, order_item_id, product_sk, seller_sk, item_price, freight_value,
                                           shipping_limit_date) AS order_item_sk, *
        FROM (SELECT i.order_id, i.order_item_id, k.customer_sk, p.product_sk, s.seller_sk, k.order_status_sk, k.order_date_key,
                     {day_key(stamp('i.shipping_limit_date'))} AS shipping_date_key,
                     COALESCE(i.price, 0) AS item_price, COALESCE(i.freight_value, 0) AS freight_value,
                     CAST(COALESCE(i.price, 0) + COALESCE(i.freight_value, 0) AS DECIMAL(10,2)) AS total_item_value,
                     {stamp('i.shipping_limit_date')} AS shipping_limit_date
              FROM stg_order_items i JOIN order_keys k USING (order_id)
              JOIN dim_product p USING (product_id) JOIN dim_seller s USING (seller_id)
              WHERE i.order_item_id > 0 AND k.customer_sk IS NOT NULL)""",
    "fact_payments": """
        SELECT row_number() OVER (ORDER BY order_id, payment_sequential, payment_type, payment_value) AS payment_sk, *
        FROM (SELECT y.order_id, COALESCE(y.payment_sequential, 1) AS payment_sequential, k.order_date_key, k.order_status_sk,
                     COALESCE(y.payment_installments, 0) AS payment_installments, COALESCE(y.payment_value, 0) AS payment_value,
                     COALESCE(y.payment_type, 'not_defined') AS payment_type
              FROM stg_payments y JOIN order_keys k USING (order_id))""",
    "review_rows": f"""
        SELECT r.review_id, r.order_id, k.customer_sk, k.order_status_sk, r.review_score AS raw_score,
               r.review_comment_title, r.review_comment_message, {stamp('r.review_creation_date')} AS review_creation_date,
               {stamp('r.review_answer_timestamp')} AS review_answer_timestamp
        FROM stg_reviews r JOIN order_keys k USING (order_id)
        WHERE k.customer_sk IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY r.review_id
                                   ORDER BY {stamp('r.review_creation_date')} DESC NULLS LAST, r.order_id) = 1""",
    "review_measured": f"""
        SELECT review_id, order_id, customer_sk, order_status_sk, COALESCE(raw_score, 0) AS review_score,
               review_comment_title, review_comment_message, review_creation_date, review_answer_timestamp,
               {day_key('review_creation_date')} AS review_date_key, {day_key('review_answer_timestamp')} AS answer_date_key,
               CASE WHEN raw_score <= 2 THEN 'Poor' WHEN raw_score = 3 THEN 'Fair' WHEN raw_score = 4 THEN 'Good'
                    WHEN raw_score = 5 THEN 'Excellent' ELSE 'Unknown' END AS review_category,
               {trunc_hours('review_answer_timestamp', 'review_creation_date')} AS response_time_hours
        FROM review_rows""",
    "fact_reviews": """
        SELECT row_number() OVER (ORDER BY review_id) AS review_sk, *
        FROM review_measured WHERE review_score BETWEEN 1 AND 5 AND response_time_hours >= 0""",
    "agg_monthly_sales": """
        SELECT CAST(d.year * 100 + d.month AS BIGINT) AS sales_agg_sk, d.year * 100 + d.month AS year_month, d.year, d.month, d.month_name,
               count(DISTINCT f.order_id) AS total_orders, count(f.order_item_sk) AS total_items,
               sum(f.item_price) AS total_revenue, sum(f.freight_value) AS total_freight,
               CAST(sum(f.total_item_value) AS DOUBLE) / count(*) AS avg_order_value,
               CAST(CAST(count(*) AS DOUBLE) / count(DISTINCT f.order_id) AS DECIMAL(10,2)) AS avg_items_per_order,
               count(DISTINCT f.customer_sk) AS unique_customers, CAST(0 AS BIGINT) AS new_customers,
               count(DISTINCT f.product_sk) AS unique_products, count(DISTINCT c.customer_state) AS unique_states
        FROM fact_order_items f JOIN dim_date d ON f.order_date_key = d.date_key
        LEFT JOIN dim_customer c ON f.customer_sk = c.customer_sk
        GROUP BY d.year, d.month, d.month_name""",
    "product_fanout": """
        SELECT p.product_sk, COALESCE(sum(f.item_price), 0) AS last_12_months_revenue,
               count(DISTINCT f.order_id) AS last_12_months_orders, count(DISTINCT f.order_item_sk) AS last_12_months_items,
               COALESCE(CAST(sum(f.item_price) AS DOUBLE) / NULLIF(count(f.item_price), 0), 0) AS avg_price,
               COALESCE(CAST(sum(r.review_score) AS DOUBLE) / NULLIF(count(r.review_score), 0), 0) AS avg_review_score,
               count(DISTINCT r.review_sk) AS total_reviews
        FROM dim_product p LEFT JOIN fact_order_items f ON p.product_sk = f.product_sk
        LEFT JOIN fact_reviews r ON f.order_id = r.order_id
        GROUP BY p.product_sk""",
    "agg_product_performance": """
        SELECT product_sk AS product_perf_sk, * REPLACE (CASE WHEN avg_review_score > 0 THEN avg_review_score END AS avg_review_score),
               row_number() OVER (ORDER BY last_12_months_revenue DESC, product_sk) AS revenue_rank,
               row_number() OVER (ORDER BY last_12_months_items DESC, product_sk) AS volume_rank
        FROM product_fanout""",
    "rfm_lines": """
        SELECT c.customer_sk, c.customer_unique_id, c.customer_state, c.customer_city, c.customer_region,
               s.order_id, s.purchased, f.total_item_value, f.freight_value, y.payment_value
        FROM dim_customer c JOIN fact_order_items f ON c.customer_sk = f.customer_sk
        JOIN dim_order_status s ON f.order_status_sk = s.order_status_sk
        LEFT JOIN fact_payments y ON f.order_id = y.order_id
        WHERE s.order_status = 'delivered' AND s.purchased IS NOT NULL""",
    "review_stats": """
        SELECT customer_sk, CAST(sum(review_score) AS DOUBLE) / count(*) AS avg_review_score, count(review_id) AS total_reviews
        FROM fact_reviews GROUP BY customer_sk""",
    "rfm": f"""
        SELECT l.customer_sk, customer_unique_id, customer_state, customer_city, customer_region,
               CAST(trunc(epoch(TIMESTAMP '{REFERENCE_DATE}' - max(purchased)) / 86400) AS INTEGER) AS recency_days,
               count(DISTINCT order_id) AS frequency_orders,
               CAST(COALESCE(sum(payment_value), sum(total_item_value)) AS DOUBLE) AS monetary_value,
               CAST(sum(total_item_value) AS DOUBLE) / count(*) AS avg_order_value,
               CAST(sum(freight_value) AS DOUBLE) AS total_freight,
               CAST(sum(freight_value) AS DOUBLE) / count(*) AS avg_freight_value,
               count(order_id) AS total_items_purchased,
               min(purchased) AS first_purchase_date, max(purchased) AS last_purchase_date,
               CAST(trunc(epoch(max(purchased) - min(purchased)) / 86400) AS INTEGER) AS customer_lifetime_days,
               COALESCE(any_value(v.avg_review_score), 3.0) AS avg_review_score,
               COALESCE(any_value(v.total_reviews), 0) AS total_reviews
        FROM rfm_lines l LEFT JOIN review_stats v ON l.customer_sk = v.customer_sk
        GROUP BY ALL""",
    "rfm_data": """
        SELECT *, CASE WHEN customer_lifetime_days > 0 THEN CAST(frequency_orders AS DOUBLE) / customer_lifetime_days ELSE 0.0
                  END AS purchase_frequency_rate
        FROM rfm WHERE monetary_value > 0""",
    "rfm_edges": """
        SELECT quantile_cont(recency_days, [0.2, 0.4, 0.6, 0.8]) AS e, count(*) AS n FROM rfm_data""",
    "rfm_scores": """
        SELECT d.*,
               CASE WHEN recency_days <= e[1] THEN 5 WHEN recency_days <= e[2] THEN 4 WHEN recency_days <= e[3] THEN 3
                    WHEN recency_days <= e[4] THEN 2 ELSE 1 END AS recency_score,
               CAST(greatest(1, ((fr - 1) * 5 + n - 2) // (n - 1)) AS INTEGER) AS frequency_score,
               CAST(greatest(1, ((mr - 1) * 5 + n - 2) // (n - 1)) AS INTEGER) AS monetary_score
        FROM (SELECT *, row_number() OVER (ORDER BY frequency_orders, customer_sk) AS fr,
                     row_number() OVER (ORDER BY monetary_value, customer_sk) AS mr FROM rfm_data) d, rfm_edges""",
    "rfm_features": """
        SELECT * EXCLUDE (fr, mr), recency_score + frequency_score + monetary_score AS rfm_score,
               CASE WHEN recency_score + frequency_score + monetary_score <= 6 THEN 'Low Value'
                    WHEN recency_score + frequency_score + monetary_score <= 9 THEN 'Medium Value'
                    WHEN recency_score + frequency_score + monetary_score <= 12 THEN 'High Value'
                    ELSE 'VIP' END AS customer_value
        FROM rfm_scores""",
}

# Fixed centroids on the standardised features, so that cluster numbers are the same in both engines.
CENTROIDS = [
    [-0.6, 0.7, 0.5, 0.0, 0.1, 0.0, 0.6],
    [0.9, -0.8, -0.6, 0.0, 0.0, 0.2, -0.8],
    [0.0, 0.0, 0.0, 0.1, -1.2, 0.0, 0.0],
]
_FEATURES = [
    "recency_days", "frequency_orders", "monetary_value", "avg_order_value", "avg_review_score",
    "purchase_frequency_rate", "customer_lifetime_days",
]


def _squared(names: list[str], other: list[str]) -> str:
    return " + ".join(f"({a} - ({b})) * ({a} - ({b}))" for a, b in zip(names, other))


_Z = [f"z_{c}" for c in _FEATURES]
_D = [_squared(_Z, [repr(v) for v in center]) for center in CENTROIDS]
CTES["rfm_scaled"] = f"""
    SELECT f.*, {', '.join(f'({c} - m_{c}) / s_{c} AS z_{c}' for c in _FEATURES)}
    FROM rfm_features f, (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in _FEATURES)} FROM rfm_features)"""
CTES["segments"] = f"""
    SELECT * EXCLUDE (d0, d1, d2), CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END AS kmeans_cluster
    FROM (SELECT *, {', '.join(f'{d} AS d{i}' for i, d in enumerate(_D))} FROM rfm_scaled)"""
CTES["segment_means"] = """
    SELECT kmeans_cluster, count(*) AS customers, CAST(sum(recency_days) AS DOUBLE) / count(*) AS avg_recency,
           CAST(sum(frequency_orders) AS DOUBLE) / count(*) AS avg_frequency,
           CAST(sum(CAST(monetary_value AS DECIMAL(30,2))) AS DOUBLE) / count(*) AS avg_monetary,
           CAST(sum(CAST(monetary_value AS DECIMAL(30,2))) AS DOUBLE) AS total_revenue, avg(avg_review_score) AS avg_review
    FROM segments GROUP BY kmeans_cluster"""
CTES["vectors"] = "SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings"
CTES["vector_centroids"] = """
    SELECT label, list(m ORDER BY i) AS c FROM (
        SELECT label, i, avg(v) AS m FROM (SELECT label, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM vectors) GROUP BY label, i)
    GROUP BY label"""
CTES["vector_spread"] = """
    SELECT v.label, any_value(c.c) AS c, avg(list_distance(v.x, c.c)) AS s, sum(list_distance(v.x, c.c) * list_distance(v.x, c.c)) AS d2
    FROM vectors v JOIN vector_centroids c USING (label) GROUP BY v.label"""
CTES["dense_pairs"] = f"""
    SELECT a.customer_sk AS a, b.customer_sk AS b FROM rfm_scaled a JOIN rfm_scaled b
    ON {_squared(['a.' + z for z in _Z], ['b.' + z for z in _Z])} <= 0.8 * 0.8"""
CTES["dense_core"] = "SELECT a AS customer_sk FROM dense_pairs GROUP BY a HAVING count(*) >= 10"
# The least label of a component reaches every node of it over nodes that are greater.
CTES["dense_clusters"] = """
    SELECT customer_sk, dense_rank() OVER (ORDER BY root) - 1 AS cluster FROM (
        WITH RECURSIVE links AS (
            SELECT p.a, p.b FROM dense_pairs p JOIN dense_core x ON p.a = x.customer_sk JOIN dense_core y ON p.b = y.customer_sk WHERE p.a <> p.b),
        reached(root, node) AS (
            SELECT customer_sk, customer_sk FROM dense_core
            UNION SELECT r.root, l.b FROM reached r JOIN links l ON r.node = l.a WHERE l.b > r.root)
        SELECT node AS customer_sk, min(root) AS root FROM reached GROUP BY node)"""


def _component(matrix: str) -> str:
    """Dominant eigenvector of a one-row ``matrix(m)`` by power iteration, its largest loading positive, with its eigenvalue."""
    start = [1 / (i + 1) for i in range(len(_Z))]
    return f"""
    SELECT m, list_transform(v, lambda x: x * CASE WHEN list_max(v) >= -list_min(v) THEN 1 ELSE -1 END) AS v, size AS eigenvalue FROM (
        WITH RECURSIVE steps(i, m, v, size) AS (
            SELECT 0, m, {start}, CAST(1 AS DOUBLE) FROM {matrix}
            UNION ALL SELECT i + 1, m, list_transform(w, lambda x: x / sqrt(list_dot_product(w, w))), sqrt(list_dot_product(w, w))
            FROM (SELECT i, m, list_transform(m, lambda r: list_dot_product(r, v)) AS w FROM steps WHERE i < 3000))
        SELECT m, v, size FROM steps WHERE i = 3000)"""


CTES["covariances"] = f"""
    SELECT [{', '.join('[' + ', '.join(f'covar_pop({a}, {b})' for b in _Z) + ']' for a in _Z)}] AS m FROM rfm_scaled"""
CTES["component_1"] = _component("covariances")
CTES["deflated"] = """
    SELECT list_transform(m, lambda r, i: list_transform(r, lambda x, j: x - eigenvalue * v[i] * v[j])) AS m FROM component_1"""
CTES["component_2"] = _component("deflated")
CTES["projected"] = f"""
    SELECT s.customer_sk, list_dot_product([{', '.join('s.' + z for z in _Z)}], a.v) AS pca_1, list_dot_product([{', '.join('s.' + z for z in _Z)}], b.v) AS pca_2
    FROM rfm_scaled s, component_1 a, component_2 b"""

_NAME = re.compile(r"[a-z_0-9]+")


def expected(body: str) -> str:
    """``body`` with the steps it names, and the steps those name, in order."""
    ordered: list[str] = []

    def visit(sql: str) -> None:
        for name in dict.fromkeys(_NAME.findall(sql)):
            if name in CTES and name not in ordered and sql is not CTES[name]:
                visit(CTES[name])
                if name not in ordered:
                    ordered.append(name)

    visit(body)
    steps = ",\n".join(f"{name} AS MATERIALIZED ({CTES[name].strip()})" for name in ordered)
    return f"WITH {steps}\n{body}" if steps else body
