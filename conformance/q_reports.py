"""Aggregates, reports, rankings and listings over the star schema and its sources."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from conformance.fixtures import REFERENCE_DATE, STAGING, staging
from conformance.registry import query
from conformance.star import star
from tradewind.functions import text
from tradewind.operators import keys, ranking, reports, rfm, stats
from tradewind.plans import marts, warehouse
from tradewind.plans.changes import run_changes
from tradewind.session import materialize, shared_folder
from tradewind.sources.publication import Publication, published

_MONTH = """year_month, year, month, month_name, total_orders, total_items, CAST(total_revenue AS DOUBLE) AS total_revenue,
    CAST(total_freight AS DOUBLE) AS total_freight, avg_order_value, CAST(avg_items_per_order AS DOUBLE) AS avg_items_per_order,
    unique_customers, unique_products, unique_states"""
_PRODUCT = """m.product_sk, p.product_id, p.product_category_name, p.product_category_english,
    CAST(m.last_12_months_revenue AS DOUBLE) AS last_12_months_revenue, m.last_12_months_orders, m.last_12_months_items,
    m.avg_price, m.avg_review_score, m.total_reviews, m.revenue_rank, m.volume_rank
    FROM agg_product_performance m JOIN dim_product p USING (product_sk)"""
_TOP = """product_sk, product_id, product_category_english, last_12_months_revenue, last_12_months_orders, avg_price,
    avg_review_score, total_reviews"""


def _months(spark, sf_dir):
    return star(spark, sf_dir)["agg_monthly_sales"]


def _products(spark, sf_dir):
    s = star(spark, sf_dir)
    return s["agg_product_performance"], s["dim_product"]


def rounded(df, *columns, digits=6):
    """Means of floating values differ in the last bits with the order of rows."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


# Aggregates


@query("monthly_sales_new_customers", """
    SELECT year_month, count(*) AS unique_customers, count(*) FILTER (year_month = first_month) AS new_customers
    FROM (SELECT DISTINCT f.customer_sk, f.order_date_key // 100 AS year_month,
                 min(f.order_date_key // 100) OVER (PARTITION BY f.customer_sk) AS first_month
          FROM fact_order_items f WHERE f.order_date_key IS NOT NULL)
    GROUP BY year_month""")
def monthly_sales_new_customers(spark, sf_dir):
    s = star(spark, sf_dir)
    mart = marts.monthly_sales(s["fact_order_items"], s["dim_date"], s["dim_customer"], count_new_customers=True)
    return mart.select("year_month", "unique_customers", "new_customers")


@query("order_item_counts", "SELECT order_id, count(*) AS items_in_order FROM fact_order_items GROUP BY order_id")
def order_item_counts(spark, sf_dir):
    return marts.order_item_counts(star(spark, sf_dir)["fact_order_items"])


@query("product_metrics", "SELECT * REPLACE (CAST(last_12_months_revenue AS DOUBLE) AS last_12_months_revenue) FROM product_fanout")
def product_metrics(spark, sf_dir):
    s = star(spark, sf_dir)
    return marts.product_metrics(s["dim_product"], s["fact_order_items"], s["fact_reviews"])


@query("product_metrics_preagg", """
    WITH_ITEMS
    SELECT p.product_sk, CAST(COALESCE(i.revenue, 0) AS DOUBLE) AS last_12_months_revenue, COALESCE(i.orders, 0) AS last_12_months_orders,
           COALESCE(i.items, 0) AS last_12_months_items, COALESCE(CAST(i.revenue AS DOUBLE) / i.items, 0.0) AS avg_price,
           COALESCE(CAST(r.score AS DOUBLE) / r.n, 0.0) AS avg_review_score, COALESCE(r.n, 0) AS total_reviews
    FROM dim_product p
    LEFT JOIN (SELECT product_sk, sum(item_price) AS revenue, count(DISTINCT order_id) AS orders, count(*) AS items
               FROM fact_order_items GROUP BY product_sk) i USING (product_sk)
    LEFT JOIN (SELECT product_sk, sum(review_score) AS score, count(*) AS n
               FROM (SELECT DISTINCT product_sk, order_id FROM fact_order_items) JOIN fact_reviews USING (order_id)
               GROUP BY product_sk) r USING (product_sk)""".replace("WITH_ITEMS", ""))
def product_metrics_preagg(spark, sf_dir):
    s = star(spark, sf_dir)
    return marts.product_metrics(s["dim_product"], s["fact_order_items"], s["fact_reviews"], fanout=False)


@query("product_metrics_window", """
    SELECT p.product_sk, CAST(COALESCE(sum(f.item_price), 0) AS DOUBLE) AS last_12_months_revenue, count(f.order_item_sk) AS last_12_months_items
    FROM dim_product p LEFT JOIN (SELECT * FROM fact_order_items WHERE strptime(CAST(order_date_key AS VARCHAR), '%Y%m%d')
        > (SELECT strptime(CAST(max(order_date_key) AS VARCHAR), '%Y%m%d') - INTERVAL 12 MONTH FROM fact_order_items)) f USING (product_sk)
    GROUP BY p.product_sk""")
def product_metrics_window(spark, sf_dir):
    s = star(spark, sf_dir)
    recent = marts.recent_items(s["fact_order_items"], 12)
    metrics = marts.product_metrics(s["dim_product"], recent, s["fact_reviews"], fanout=False)
    return metrics.select("product_sk", "last_12_months_revenue", "last_12_months_items")


@query("monthly_sales_summary", """SELECT count(*) AS total_months, CAST(sum(total_orders) AS BIGINT) AS total_orders,
    CAST(sum(total_revenue) AS DOUBLE) AS total_revenue, round(avg(avg_order_value), 6) AS avg_order_value,
    max(unique_customers) AS max_customers_per_month, max(unique_products) AS max_products_per_month FROM agg_monthly_sales""")
def monthly_sales_summary(spark, sf_dir):
    return rounded(reports.monthly_sales_summary(_months(spark, sf_dir)), "avg_order_value")


@query("product_summary", """SELECT count(*) AS total_products, CAST(sum(last_12_months_revenue) AS DOUBLE) AS total_revenue,
    CAST(sum(last_12_months_orders) AS BIGINT) AS total_orders, round(avg(avg_review_score), 6) AS avg_rating, max(total_reviews) AS max_reviews,
    min(avg_price) AS min_price, max(avg_price) AS max_price FROM agg_product_performance""")
def product_summary(spark, sf_dir):
    return rounded(reports.product_summary(_products(spark, sf_dir)[0]), "avg_rating")


@query("customer_review_stats", "SELECT * FROM review_stats")
def customer_review_stats(spark, sf_dir):
    return rfm.customer_review_stats(star(spark, sf_dir)["fact_reviews"])


def _rfm_parts(spark, sf_dir):
    s = star(spark, sf_dir)
    return s["dim_customer"], s["fact_order_items"], s["dim_order_status"], s["fact_payments"], s["fact_reviews"], REFERENCE_DATE


_RFM_TEXT = """REPLACE (CAST(first_purchase_date AS VARCHAR) AS first_purchase_date, CAST(last_purchase_date AS VARCHAR) AS last_purchase_date)"""


@query("rfm_metrics", f"SELECT * {_RFM_TEXT} FROM rfm")
def rfm_metrics(spark, sf_dir):
    return rfm.rfm_metrics(*_rfm_parts(spark, sf_dir))


@query("rfm_metrics_preagg", f"""
    SELECT customer_sk, count(*) AS frequency_orders, CAST(COALESCE(sum(paid), sum(value)) AS DOUBLE) AS monetary_value,
           CAST(sum(n) AS BIGINT) AS total_items_purchased, CAST(sum(freight) AS DOUBLE) AS total_freight,
           CAST(sum(value) AS DOUBLE) / sum(n) AS avg_order_value,
           CAST(trunc(epoch(TIMESTAMP '{REFERENCE_DATE}' - max(purchased)) / 86400) AS INTEGER) AS recency_days
    FROM (SELECT f.customer_sk, f.order_id, any_value(s.purchased) AS purchased, count(*) AS n, sum(f.total_item_value) AS value,
                 sum(f.freight_value) AS freight
          FROM fact_order_items f JOIN dim_order_status s USING (order_status_sk) WHERE s.order_status = 'delivered' GROUP BY ALL)
    LEFT JOIN (SELECT order_id, sum(payment_value) AS paid FROM fact_payments GROUP BY order_id) USING (order_id)
    GROUP BY customer_sk""")
def rfm_metrics_preagg(spark, sf_dir):
    metrics = rfm.rfm_metrics(*_rfm_parts(spark, sf_dir), fanout=False)
    return metrics.select(
        "customer_sk", "frequency_orders", "monetary_value", "total_items_purchased", "total_freight", "avg_order_value", "recency_days"
    )


@query("rfm_metrics_person", """
    SELECT min(c.customer_sk) AS customer_sk, c.customer_unique_id, count(DISTINCT l.order_id) AS frequency_orders,
           CAST(COALESCE(sum(l.payment_value), sum(l.total_item_value)) AS DOUBLE) AS monetary_value, count(*) AS total_items_purchased
    FROM (SELECT customer_unique_id, min(customer_sk) AS customer_sk FROM dim_customer GROUP BY customer_unique_id) c
    JOIN rfm_lines l USING (customer_unique_id) GROUP BY c.customer_unique_id""")
def rfm_metrics_person(spark, sf_dir):
    metrics = rfm.rfm_metrics(*_rfm_parts(spark, sf_dir), grain="customer_unique_id")
    return metrics.select("customer_sk", "customer_unique_id", "frequency_orders", "monetary_value", "total_items_purchased")


@query("purchase_rate", "SELECT customer_sk, purchase_frequency_rate FROM rfm_data")
def purchase_rate(spark, sf_dir):
    return rfm.purchase_rate(rfm.rfm_metrics(*_rfm_parts(spark, sf_dir))).select("customer_sk", "purchase_frequency_rate")


@query("rfm_extract", f"SELECT * {_RFM_TEXT} FROM rfm_data")
def rfm_extract(spark, sf_dir):
    return rfm.rfm_extract(*_rfm_parts(spark, sf_dir))


@query("value_counts", "SELECT payment_type, count(*) AS n, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM stg_payments) * 100 AS percentage FROM stg_payments WHERE payment_type IS NOT NULL GROUP BY payment_type")
def value_counts(spark, sf_dir):
    return stats.value_counts(staging(spark, sf_dir)["stg_payments"], "payment_type")


@query("orders_by_year", """SELECT CAST(year(purchased) AS INTEGER) AS order_year, count(*) AS n, CAST(min(purchased) AS VARCHAR) AS first_order,
    CAST(max(purchased) AS VARCHAR) AS last_order FROM order_times WHERE purchased IS NOT NULL GROUP BY 1""")
def orders_by_year(spark, sf_dir):
    return reports.orders_by_year(_purchases(spark, sf_dir), "purchased")


def _purchases(spark, sf_dir):
    orders = staging(spark, sf_dir)["stg_orders"]
    return orders.select("order_id", text.parse_timestamp("order_purchase_timestamp").alias("purchased"))


@query("monthly_resample", """SELECT CAST(m.month_start AS VARCHAR) AS month_start, count(o.purchased) AS n
    FROM (SELECT CAST(unnest(generate_series(min(date_trunc('month', purchased)), max(date_trunc('month', purchased)), INTERVAL 1 MONTH)) AS DATE) AS month_start
          FROM order_times) m LEFT JOIN order_times o ON CAST(date_trunc('month', o.purchased) AS DATE) = m.month_start GROUP BY 1""")
def monthly_resample(spark, sf_dir):
    return stats.monthly_resample(_purchases(spark, sf_dir), "purchased")


@query("payment_stats", """SELECT count(*) AS n_payments, CAST(sum(payment_value) AS DOUBLE) AS total, CAST(sum(payment_value) AS DOUBLE) / count(*) AS mean,
    CAST(min(payment_value) AS DOUBLE) AS smallest, CAST(max(payment_value) AS DOUBLE) AS largest FROM stg_payments""")
def payment_stats(spark, sf_dir):
    return reports.payment_stats(staging(spark, sf_dir)["stg_payments"])


@query("items_per_order_stats", """SELECT CAST(sum(n) AS DOUBLE) / count(*) AS mean_items, max(n) AS max_items, count(*) FILTER (n > 1) AS multi_item_orders,
    CAST(count(*) FILTER (n > 1) AS DOUBLE) / count(*) * 100 AS multi_item_pct FROM (SELECT count(order_item_id) AS n FROM stg_order_items GROUP BY order_id)""")
def items_per_order_stats(spark, sf_dir):
    return reports.items_per_order_stats(staging(spark, sf_dir)["stg_order_items"])


@query("item_position_range", "SELECT min(order_item_id) AS smallest, max(order_item_id) AS largest, count(DISTINCT order_item_id) AS distinct_positions FROM stg_order_items")
def item_position_range(spark, sf_dir):
    return reports.item_position_range(staging(spark, sf_dir)["stg_order_items"])


@query("item_position_distribution", "SELECT order_item_id, count(*) AS n FROM stg_order_items GROUP BY 1")
def item_position_distribution(spark, sf_dir):
    return reports.item_position_distribution(staging(spark, sf_dir)["stg_order_items"])


_DESCRIBED = ["recency_days", "frequency_orders", "monetary_value", "rfm_score"]


@query("describe_numeric", " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
        CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, round(CAST(quantile_cont({c}, 0.25) AS DOUBLE), 6) AS q25,
        round(CAST(quantile_cont({c}, 0.5) AS DOUBLE), 6) AS q50, round(CAST(quantile_cont({c}, 0.75) AS DOUBLE), 6) AS q75 FROM rfm_features"""
    for c in _DESCRIBED))
def describe_numeric(spark, sf_dir):
    described = stats.describe_numeric(features(spark, sf_dir), _DESCRIBED)
    return rounded(described, "mean", "std", "q25", "q50", "q75")


def features(spark, sf_dir):
    return rfm.rfm_features(rfm.rfm_extract(*_rfm_parts(spark, sf_dir)))


def _histogram_sql(column: str, bins: int) -> str:
    return f"""
    SELECT CAST(b.bin AS INTEGER) AS bin, round(e.low + b.bin * e.width, 6) AS low, round(e.low + (b.bin + 1) * e.width, 6) AS high,
           count(v.x) AS n, round(any_value(e.median), 6) AS median
    FROM (SELECT unnest(range({bins})) AS bin) b,
         (SELECT CAST(min({column}) AS DOUBLE) AS low, (CAST(max({column}) AS DOUBLE) - CAST(min({column}) AS DOUBLE)) / {bins} AS width,
                 CAST(median({column}) AS DOUBLE) AS median FROM rfm_features) e
    LEFT JOIN (SELECT CAST({column} AS DOUBLE) AS x FROM rfm_features) v
           ON least(floor((v.x - e.low) / e.width), {bins - 1}) = b.bin
    GROUP BY b.bin, e.low, e.width"""


for _column, _bins in [("recency_days", 50), ("frequency_orders", 30), ("monetary_value", 50), ("rfm_score", 15)]:

    @query(f"histogram_{_column}", _histogram_sql(_column, _bins))
    def histogram(spark, sf_dir, column=_column, bins=_bins):
        return rounded(stats.histogram(features(spark, sf_dir), column, bins), "low", "high", "median")


@query("mode_value", """SELECT customer_state AS mode, count(*) AS n FROM stg_customers WHERE customer_state IS NOT NULL
    GROUP BY 1 ORDER BY n DESC, mode LIMIT 1""")
def mode_value(spark, sf_dir):
    return stats.mode_value(staging(spark, sf_dir)["stg_customers"], "customer_state")


@query("monthly_revenue_trend", "SELECT year_month, CAST(total_revenue AS DOUBLE) AS total_revenue, total_orders, avg_order_value FROM agg_monthly_sales")
def monthly_revenue_trend(spark, sf_dir):
    return reports.monthly_revenue_trend(_months(spark, sf_dir))


@query("category_revenue_top", """SELECT product_category_english, count(DISTINCT order_id) AS total_orders, CAST(sum(total_item_value) AS DOUBLE) AS revenue,
    CAST(sum(total_item_value) AS DOUBLE) / count(*) AS avg_order_value FROM fact_order_items JOIN dim_product USING (product_sk)
    GROUP BY 1 ORDER BY revenue DESC LIMIT 10""")
def category_revenue_top(spark, sf_dir):
    s = star(spark, sf_dir)
    return reports.category_revenue_top(s["fact_order_items"], s["dim_product"])


@query("geographic_sales", """SELECT customer_state, customer_region, count(DISTINCT order_id) AS total_orders, CAST(sum(total_item_value) AS DOUBLE) AS revenue,
    CAST(sum(total_item_value) AS DOUBLE) / count(*) AS avg_order_value FROM fact_order_items JOIN dim_customer USING (customer_sk) GROUP BY 1, 2""")
def geographic_sales(spark, sf_dir):
    s = star(spark, sf_dir)
    return reports.geographic_sales(s["fact_order_items"], s["dim_customer"])


@query("delivery_performance", """SELECT delivery_performance_category, count(*) AS order_count, CAST(sum(total_delivery_days) AS DOUBLE) / count(*) AS avg_delivery_days,
    CAST(sum(delivery_delay_days) AS DOUBLE) / count(*) AS avg_delay_days FROM dim_order_status GROUP BY 1""")
def delivery_performance(spark, sf_dir):
    return reports.delivery_performance(star(spark, sf_dir)["dim_order_status"])


@query("category_satisfaction", """SELECT product_category_english, count(*) AS review_count, CAST(sum(review_score) AS DOUBLE) / count(*) AS avg_rating,
    CAST(count(*) FILTER (review_score >= 4) AS DOUBLE) / count(*) * 100 AS satisfaction_rate
    FROM fact_reviews r JOIN fact_order_items f USING (order_id) JOIN dim_product p ON f.product_sk = p.product_sk GROUP BY 1 HAVING count(*) >= 10""")
def category_satisfaction(spark, sf_dir):
    s = star(spark, sf_dir)
    return reports.category_satisfaction(s["fact_reviews"], s["fact_order_items"], s["dim_product"])


@query("sales_kpis", """
    SELECT CAST(sum(total_orders) AS BIGINT) AS total_orders, arg_max(total_orders, year_month) AS latest_orders,
           CAST(sum(total_revenue) AS DOUBLE) AS total_revenue, CAST(arg_max(total_revenue, year_month) AS DOUBLE) AS latest_revenue,
           round(avg(avg_order_value), 6) AS avg_order_value, arg_max(avg_order_value, year_month) AS latest_order_value,
           CAST(sum(unique_customers) AS BIGINT) AS unique_customers, arg_max(unique_customers, year_month) AS latest_customers,
           max(unique_products) AS unique_products,
           round((arg_max(avg_order_value, year_month) / avg(avg_order_value) - 1) * 100, 6) AS order_value_change_pct
    FROM agg_monthly_sales""")
def sales_kpis(spark, sf_dir):
    return rounded(reports.sales_kpis(_months(spark, sf_dir)), "avg_order_value", "order_value_change_pct")


@query("product_kpis", """SELECT count(*) AS total_products, CAST(sum(last_12_months_revenue) AS DOUBLE) AS total_revenue,
    CAST(sum(last_12_months_orders) AS BIGINT) AS total_orders, round(avg(avg_review_score), 6) AS avg_rating,
    CAST(sum(total_reviews) AS BIGINT) AS total_reviews FROM agg_product_performance WHERE revenue_rank <= 50""")
def product_kpis(spark, sf_dir):
    return rounded(reports.product_kpis(reports.top_ranked_products(*_products(spark, sf_dir))), "avg_rating")


@query("rating_bins", """SELECT '(' || b || ',' || (b + 1) || ']' AS rating_range, count(m.product_sk) AS n
    FROM (SELECT unnest(range(5)) AS b) LEFT JOIN agg_product_performance m ON m.avg_review_score > b AND m.avg_review_score <= b + 1 GROUP BY b""")
def rating_bins(spark, sf_dir):
    return reports.rating_bins(_products(spark, sf_dir)[0])


@query("fact_totals", "SELECT count(*) AS n_items, CAST(sum(item_price) AS DOUBLE) AS total_price, CAST(sum(total_item_value) AS DOUBLE) AS total_value FROM fact_order_items")
def fact_totals(spark, sf_dir):
    return reports.fact_totals(star(spark, sf_dir)["fact_order_items"])


@query("freight_analysis", """SELECT year_month, strftime(make_date(year, month, 1), '%Y-%m') AS date_label, CAST(total_freight AS DOUBLE) AS total_freight,
    round(CAST(total_freight AS DOUBLE) / CAST(total_revenue AS DOUBLE) * 100, 2) AS freight_pct FROM agg_monthly_sales""")
def freight_analysis(spark, sf_dir):
    return reports.freight_analysis(_months(spark, sf_dir))


@query("product_display", """SELECT m.revenue_rank AS "Rank", p.product_category_english AS "Product",
    'R$ ' || format('{:,.2f}', CAST(m.last_12_months_revenue AS DOUBLE)) AS "Revenue (R$)", m.last_12_months_orders AS "Orders",
    'R$ ' || format('{:,.2f}', m.avg_price) AS "Avg Price (R$)", '⭐ ' || format('{:,.2f}', m.avg_review_score) AS "Rating", m.total_reviews AS "Reviews"
    FROM agg_product_performance m JOIN dim_product p USING (product_sk) WHERE m.revenue_rank <= 50""")
def product_display(spark, sf_dir):
    return reports.product_display(reports.top_ranked_products(*_products(spark, sf_dir)))


# Ranks and scores


@query("revenue_rank", "SELECT product_sk, revenue_rank FROM agg_product_performance")
def revenue_rank(spark, sf_dir):
    return marts.with_rank(_metrics(spark, sf_dir), "last_12_months_revenue", "product_sk", "revenue_rank").select("product_sk", "revenue_rank")


@query("volume_rank", "SELECT product_sk, volume_rank FROM agg_product_performance")
def volume_rank(spark, sf_dir):
    return marts.with_rank(_metrics(spark, sf_dir), "last_12_months_items", "product_sk", "volume_rank").select("product_sk", "volume_rank")


def _metrics(spark, sf_dir):
    s = star(spark, sf_dir)
    return marts.product_metrics(s["dim_product"], s["fact_order_items"], s["fact_reviews"])


@query("surrogate_key", """SELECT row_number() OVER (ORDER BY order_id, order_item_id, product_id, seller_id, shipping_limit_date, price) AS line_sk,
    order_id, order_item_id, product_id, seller_id FROM stg_order_items""")
def surrogate_key(spark, sf_dir):
    """Every line gets a key although (order, position) repeats."""
    items = staging(spark, sf_dir)["stg_order_items"]
    keyed = ranking.surrogate_key(
        items, "line_sk", ["order_id", "order_item_id"], ["product_id", "seller_id", "shipping_limit_date", "price"], unique=False
    )
    return keyed.select("line_sk", "order_id", "order_item_id", "product_id", "seller_id")


_LINE = ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price"]
_EARLIER = "CAST(order_id AS BIGINT) % 3 <> 1"


@query("surrogate_key_later_load", f"""SELECT CASE WHEN {_EARLIER} THEN 0 ELSE (SELECT count(*) FROM stg_order_items WHERE {_EARLIER}) END
        + row_number() OVER (PARTITION BY {_EARLIER} ORDER BY {', '.join(_LINE)}) AS line_sk, order_id, order_item_id, product_id
    FROM stg_order_items""")
def surrogate_key_later_load(spark, sf_dir):
    """A third of the orders comes later, in between: earlier lines keep their keys, the others follow."""
    items = materialize(staging(spark, sf_dir)["stg_order_items"].withColumn("row", F.monotonically_increasing_id()), "lines")
    store = keys.KeyStore(spark, f"{shared_folder(spark)}/keys-{uuid.uuid4().hex}")
    for rows in (items.where(_EARLIER), items):
        keyed, given = keys.stable_key(rows, "line_sk", _LINE[:2], store.known("lines"), _LINE[2:], "row")
        store.add("lines", given)
    return keyed.select("line_sk", "order_id", "order_item_id", "product_id")


@query("rank_first", "SELECT customer_sk, row_number() OVER (ORDER BY frequency_orders, customer_sk) AS rank FROM rfm_data")
def rank_first(spark, sf_dir):
    data = rfm.rfm_extract(*_rfm_parts(spark, sf_dir)).select("customer_sk", "frequency_orders")
    return ranking.global_row_number(data, ["frequency_orders", "customer_sk"], "rank").select("customer_sk", "rank")


@query("quantile_score_rank", "SELECT customer_sk, frequency_score, monetary_score FROM rfm_features")
def quantile_score_rank(spark, sf_dir):
    data = rfm.rfm_extract(*_rfm_parts(spark, sf_dir)).select("customer_sk", "frequency_orders", "monetary_value")
    scored = ranking.score_by_rank(data, "frequency_orders", "customer_sk", "frequency_score")
    return ranking.score_by_rank(scored, "monetary_value", "customer_sk", "monetary_score").select(
        "customer_sk", "frequency_score", "monetary_score"
    )


@query("quantile_score_value", "SELECT customer_sk, recency_score FROM rfm_features")
def quantile_score_value(spark, sf_dir):
    data = rfm.rfm_extract(*_rfm_parts(spark, sf_dir)).select("customer_sk", "recency_days")
    return ranking.score_by_value(data, "recency_days", "recency_score").select("customer_sk", "recency_score")


@query("rfm_total_score", "SELECT customer_sk, rfm_score FROM rfm_features")
def rfm_total_score(spark, sf_dir):
    return features(spark, sf_dir).select("customer_sk", "rfm_score")


@query("customer_value_band", "SELECT customer_sk, rfm_score, customer_value FROM rfm_features")
def customer_value_band(spark, sf_dir):
    return features(spark, sf_dir).select("customer_sk", "rfm_score", "customer_value")


@query("rfm_features", f"SELECT * {_RFM_TEXT} FROM rfm_features")
def rfm_features(spark, sf_dir):
    return features(spark, sf_dir)


# Listings


@query("recent_months", f"SELECT {_MONTH} FROM agg_monthly_sales WHERE year_month >= 199601 ORDER BY year_month DESC LIMIT 24")
def recent_months(spark, sf_dir):
    return reports.recent_months(_months(spark, sf_dir), limit=24, min_year_month=199601)


@query("product_list", f"SELECT {_PRODUCT} WHERE m.revenue_rank <= 200 AND m.avg_review_score >= 2.9 ORDER BY m.revenue_rank LIMIT 50")
def product_list(spark, sf_dir):
    return reports.product_list(*_products(spark, sf_dir), max_revenue_rank=200, min_rating=2.9)


@query("top_by_revenue", f"SELECT {_TOP} FROM (SELECT {_PRODUCT}) ORDER BY revenue_rank LIMIT 10")
def top_by_revenue(spark, sf_dir):
    return reports.top_by_revenue(*_products(spark, sf_dir))


@query("top_by_orders", f"SELECT {_TOP} FROM (SELECT {_PRODUCT}) ORDER BY volume_rank LIMIT 10")
def top_by_orders(spark, sf_dir):
    return reports.top_by_orders(*_products(spark, sf_dir))


@query("top50_products", f"SELECT {_PRODUCT} WHERE m.revenue_rank <= 50")
def top50_products(spark, sf_dir):
    return reports.top_ranked_products(*_products(spark, sf_dir))


@query("nlargest", f"SELECT {_TOP} FROM (SELECT {_PRODUCT}) ORDER BY last_12_months_orders DESC, product_sk LIMIT 10")
def nlargest(spark, sf_dir):
    products = reports.mart_dim_inner_join(*_products(spark, sf_dir))
    return reports.nlargest(products, 10, "last_12_months_orders", "product_sk").select(*[c.strip() for c in _TOP.split(",")])


@query("top_states", """SELECT customer_state, count(*) AS n, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM stg_customers) * 100 AS percentage
    FROM stg_customers WHERE customer_state IS NOT NULL GROUP BY 1 ORDER BY n DESC, customer_state LIMIT 10""")
def top_states(spark, sf_dir):
    return stats.top_values(staging(spark, sf_dir)["stg_customers"], "customer_state", 10)


@query("latest_month_row", f"SELECT sales_agg_sk, {_MONTH}, new_customers FROM agg_monthly_sales ORDER BY year_month DESC LIMIT 1")
def latest_month_row(spark, sf_dir):
    return reports.latest_month_row(_months(spark, sf_dir))


@query("all_months", f"SELECT {_MONTH} FROM agg_monthly_sales")
def all_months(spark, sf_dir):
    return reports.all_months(_months(spark, sf_dir))


@query("sample_rows", """SELECT order_id, CAST(item_price AS DOUBLE) AS item_price, CAST(freight_value AS DOUBLE) AS freight_value,
    CAST(total_item_value AS DOUBLE) AS total_item_value FROM fact_order_items ORDER BY order_item_sk LIMIT 5""")
def sample_rows(spark, sf_dir):
    items = star(spark, sf_dir)["fact_order_items"]
    return reports.sample_rows(items, ["order_item_sk"], 5).select("order_id", "item_price", "freight_value", "total_item_value")


# The whole load


_READ = {
    "dim_customer": "stg_customers", "dim_product": "stg_products", "dim_seller": "stg_sellers", "dim_order_status": "stg_orders",
    "fact_order_items": "stg_order_items", "fact_payments": "stg_payments", "fact_reviews": "stg_reviews",
}
_LAYER_TABLES = {
    "staging": ["stg_customers", "stg_products", "stg_sellers", "stg_orders", "stg_order_items", "stg_payments", "stg_reviews",
                "stg_product_categories"],
    **warehouse.STEPS,
}
_LOADED = " UNION ALL ".join(
    f"SELECT '{layer}' AS layer, '{t}' AS table_name, (SELECT count(*) FROM {t}) AS rows, "
    + (f"(SELECT count(*) FROM {_READ[t]}) - (SELECT count(*) FROM {t})" if t in _READ else "CAST(0 AS BIGINT)") + " AS rejected"
    for layer, names in _LAYER_TABLES.items() for t in names
)


@query("warehouse_run", _LOADED)
def warehouse_run(spark, sf_dir):
    """Rows read are rows loaded and rows rejected, for every table."""
    return run_load(spark, sf_dir).select("layer", "table_name", "rows", "rejected")


@query("load_summary", f"""SELECT layer, count(*) AS n_tables, CAST(sum(rows) AS BIGINT) AS total_rows, CAST(sum(rejected) AS BIGINT) AS rejected_rows
    FROM ({_LOADED}) GROUP BY layer""")
def load_summary(spark, sf_dir):
    return warehouse.load_summary(run_load(spark, sf_dir))


def run_load(spark, sf_dir):
    from conformance.fixtures import STAGING
    from conformance.q_sources import folder
    from tradewind.sources.sinks import folder_sink

    tables = staging(spark, sf_dir)
    _, summary = warehouse.run_warehouse(spark, {t: tables[t] for t in STAGING}, folder_sink(folder(spark, "warehouse")))
    return summary


@query("warehouse_changes", f"SELECT sales_agg_sk, new_customers, {_MONTH} FROM agg_monthly_sales")
def warehouse_changes(spark, sf_dir):
    """A load of other prices, states and orders, then the changes to the tables as they are: the mart of a whole load."""
    path, tables = f"{shared_folder(spark)}/changes-{uuid.uuid4().hex}", staging(spark, sf_dir)
    store = keys.KeyStore(spark, f"{path}-keys")
    now = {t: tables[t] for t in STAGING}
    third = lambda c: F.crc32(F.col(c).cast("string")) % 3 == 0
    before = now | {
        "stg_order_items": now["stg_order_items"].withColumn("price", F.when(third("order_id"), F.col("price") + 1).otherwise(F.col("price")).cast("decimal(10,2)")),
        "stg_customers": now["stg_customers"].withColumn("customer_state", F.when(third("customer_id"), "SP").otherwise(F.col("customer_state"))),
        "stg_orders": now["stg_orders"].where(~third("customer_id")),
    }
    with Publication(spark, path) as sink:
        warehouse.run_warehouse(spark, before, sink, keys=store)
    with Publication(spark, path) as sink:
        run_changes(spark, published(spark, path), now, sink, store)
    return published(spark, path)["marts", "agg_monthly_sales"]
