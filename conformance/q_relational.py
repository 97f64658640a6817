"""Projections, filters, joins, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from conformance.ctes import stamp
from conformance.fixtures import STAGING, read, staging
from conformance.q_sources import folder
from conformance.registry import query
from conformance.star import star
from tradewind.functions import text
from tradewind.operators import profiling, quality, relational, reports, rfm, segments, versions
from tradewind.plans import dimensions, facts, marts
from tradewind.sources import history
from tradewind.sources.schemas import DIMENSIONS

# Projection and filter


@query("project_final_columns", "SELECT seller_id, seller_zip_code_prefix, seller_city, seller_state, seller_region, record_hash, TRUE AS is_active FROM dim_seller")
def project_final_columns(spark, sf_dir):
    declared = [f.name for f in DIMENSIONS["dim_seller"] if f.name != "seller_sk"]
    return star(spark, sf_dir)["dim_seller"].select(*declared)


@query("rename_columns", """SELECT revenue_rank AS "Rank", last_12_months_orders AS "Orders", total_reviews AS "Reviews" FROM agg_product_performance""")
def rename_columns(spark, sf_dir):
    headings = {k: v for k, v in reports.PRODUCT_HEADINGS.items() if v in ("Rank", "Orders", "Reviews")}
    return reports.rename_columns(star(spark, sf_dir)["agg_product_performance"], headings)


@query("delivered_orders", "SELECT order_id, order_status_sk FROM dim_order_status WHERE order_status = 'delivered' AND purchased IS NOT NULL")
def delivered_orders(spark, sf_dir):
    return relational.delivered_orders(star(spark, sf_dir)["dim_order_status"]).select("order_id", "order_status_sk")


def _versions(spark, sf_dir):
    """Product history after a second load in which the brand numbers changed some sizes."""
    products = star(spark, sf_dir)["dim_product"].select("product_id", "product_size_category", "record_hash")
    history = products.withColumns(
        {
            "effective_start_date": F.lit("2001-01-01").cast("timestamp_ntz"),
            "effective_end_date": F.lit("2999-12-31").cast("timestamp_ntz"),
            "is_current": F.lit(True),
        }
    ).where("product_size_category <> 'Extra Large'")
    changed = F.col("product_size_category") == "Small"
    incoming = products.where("product_size_category <> 'Large'").withColumns(
        {
            "record_hash": F.when(changed, F.md5("record_hash")).otherwise(F.col("record_hash")),
            "product_size_category": F.when(changed, "Tiny").otherwise(F.col("product_size_category")),
        }
    )
    return history, incoming


_SCD2 = """(
    SELECT product_id, product_size_category, record_hash, '2001-01-01 00:00:00' AS effective_start_date,
           CASE WHEN product_size_category = 'Small' THEN '2002-01-01 00:00:00' ELSE '2999-12-31 00:00:00' END AS effective_end_date,
           product_size_category <> 'Small' AS is_current
    FROM dim_product WHERE product_size_category <> 'Extra Large'
    UNION ALL
    SELECT product_id, CASE WHEN product_size_category = 'Small' THEN 'Tiny' ELSE product_size_category END,
           CASE WHEN product_size_category = 'Small' THEN md5(record_hash) ELSE record_hash END,
           '2002-01-01 00:00:00', '2999-12-31 00:00:00', TRUE
    FROM dim_product WHERE product_size_category IN ('Small', 'Extra Large'))"""


@query("scd2_apply", f"SELECT * EXCLUDE (effective_start_date), effective_start_date AS valid_from FROM {_SCD2}")
def scd2_apply(spark, sf_dir):
    history, incoming = _versions(spark, sf_dir)
    as_of = F.lit("2002-01-01").cast("timestamp_ntz")
    return versions.scd2_apply(history, incoming, "product_id", as_of).withColumnRenamed("effective_start_date", "valid_from")


@query("current_version", f"SELECT product_id, product_size_category FROM {_SCD2} WHERE is_current")
def current_version(spark, sf_dir):
    history, incoming = _versions(spark, sf_dir)
    applied = versions.scd2_apply(history, incoming, "product_id", F.lit("2002-01-01").cast("timestamp_ntz"))
    return relational.current_version(applied).select("product_id", "product_size_category")


@query("scd1_apply", """SELECT product_id, CASE WHEN product_size_category = 'Small' THEN 'Tiny' ELSE product_size_category END AS product_size_category,
    CASE WHEN product_size_category = 'Small' THEN md5(record_hash) ELSE record_hash END AS record_hash FROM dim_product""")
def scd1_apply(spark, sf_dir):
    history, incoming = _versions(spark, sf_dir)
    return versions.scd1_apply(history.select(*incoming.columns), incoming, "product_id")


@query("scd2_merge", f"SELECT * EXCLUDE (effective_start_date), effective_start_date AS valid_from FROM {_SCD2}")
def scd2_merge(spark, sf_dir):
    """The same versions from a stored history of which only the touched buckets are rewritten."""
    rows, incoming = _versions(spark, sf_dir)
    stored = history.History.create(rows, folder(spark, "history"), "product_id")
    stored.append(incoming, F.lit("2002-01-01").cast("timestamp_ntz"))
    return stored.read().withColumnRenamed("effective_start_date", "valid_from")


@query("valid_at", f"""SELECT product_id, product_size_category FROM {_SCD2}
    WHERE effective_start_date <= '2001-07-01 00:00:00' AND effective_end_date > '2001-07-01 00:00:00'""")
def valid_at(spark, sf_dir):
    rows, incoming = _versions(spark, sf_dir)
    stored = history.History.create(rows, folder(spark, "history"), "product_id")
    stored.append(incoming, F.lit("2002-01-01").cast("timestamp_ntz"))
    return stored.at(F.lit("2001-07-01").cast("timestamp_ntz")).select("product_id", "product_size_category")


@query("scd1_merge", """SELECT product_id, CASE WHEN product_size_category = 'Small' THEN 'Tiny' ELSE product_size_category END AS product_size_category,
    CASE WHEN product_size_category = 'Small' THEN md5(record_hash) ELSE record_hash END AS record_hash FROM dim_product""")
def scd1_merge(spark, sf_dir):
    rows, incoming = _versions(spark, sf_dir)
    stored = history.History.create(rows.select(*incoming.columns), folder(spark, "history"), "product_id")
    stored.overwrite(incoming)
    return stored.read()


@query("positive_monetary", "SELECT customer_sk, monetary_value FROM rfm WHERE monetary_value > 0")
def positive_monetary(spark, sf_dir):
    return relational.positive(_metrics(star(spark, sf_dir)), "monetary_value").select("customer_sk", "monetary_value")


def _metrics(s):
    from conformance.fixtures import REFERENCE_DATE

    return rfm.rfm_metrics(
        s["dim_customer"], s["fact_order_items"], s["dim_order_status"], s["fact_payments"], s["fact_reviews"], REFERENCE_DATE
    )


@query("resolved_keys_only", "SELECT order_id, order_item_id, product_sk, customer_sk FROM fact_order_items")
def resolved_keys_only(spark, sf_dir):
    s = star(spark, sf_dir)
    return _star_keys(s).select("order_id", "order_item_id", "product_sk", "customer_sk")


def _star_keys(s):
    return facts.star_key_resolution(
        s["stg_order_items"], s["stg_orders"], s["dim_customer"], s["dim_product"], s["dim_seller"], s["dim_order_status"]
    )


@query("optional_predicates", "SELECT product_sk, revenue_rank FROM agg_product_performance WHERE revenue_rank <= 300 AND avg_review_score >= 3.0")
def optional_predicates(spark, sf_dir):
    mart = star(spark, sf_dir)["agg_product_performance"]
    chosen = relational.optional_predicates(
        mart, at_least={"avg_review_score": 3.0, "total_reviews": None}, at_most={"revenue_rank": 300}
    )
    return chosen.select("product_sk", "revenue_rank")


@query("rank_and_rating_filter", "SELECT product_sk, revenue_rank FROM agg_product_performance WHERE revenue_rank <= 40 AND avg_review_score >= 2.5")
def rank_and_rating_filter(spark, sf_dir):
    mart = star(spark, sf_dir)["agg_product_performance"]
    return reports.rank_and_rating_filter(mart, 40, 2.5).select("product_sk", "revenue_rank")


@query("segment_filter", "SELECT vec_id, label FROM embeddings WHERE label = 3")
def segment_filter(spark, sf_dir):
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "label")
    return segments.segment_filter(vectors.withColumnRenamed("label", segments.CLUSTER), 3).withColumnRenamed(segments.CLUSTER, "label")


@query("label_contains", "SELECT CAST(sum(CAST(c_acctbal AS DECIMAL(15,2))) AS DOUBLE) / count(*) AS mean_value FROM customer WHERE contains(c_mktsegment, 'BUILD')")
def label_contains(spark, sf_dir):
    rows = relational.label_contains(read(spark, sf_dir, "customer"), "c_mktsegment", "BUILD")
    value = F.col("c_acctbal").cast("decimal(15,2)")
    return rows.agg((F.sum(value).cast("double") / F.count(F.lit(1))).alias("mean_value"))


@query("seeded_sample", """SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice FROM orders
    ORDER BY md5('42:' || o_orderkey), o_orderkey LIMIT 1000""")
def seeded_sample(spark, sf_dir):
    return relational.seeded_sample(read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 1000)


# Joins


@query("category_translation_join", "SELECT product_id, product_category_english FROM dim_product")
def category_translation_join(spark, sf_dir):
    tables = staging(spark, sf_dir)
    joined = dimensions.category_translation_join(tables["stg_products"], tables["stg_product_categories"])
    return joined.select("product_id", "product_category_english")


@query("star_key_resolution", """SELECT order_id, order_item_id, customer_sk, product_sk, seller_sk, order_status_sk, order_date_key FROM fact_order_items""")
def star_key_resolution(spark, sf_dir):
    return _star_keys(star(spark, sf_dir)).select(
        "order_id", "order_item_id", "customer_sk", "product_sk", "seller_sk", "order_status_sk", "order_date_key"
    )


@query("conditional_left_join", f"""SELECT i.order_id, i.order_item_id, i.product_id, v.product_size_category AS size FROM stg_order_items i
    LEFT JOIN {_SCD2} v ON i.product_id = v.product_id AND v.is_current""")
def conditional_left_join(spark, sf_dir):
    history, incoming = _versions(spark, sf_dir)
    applied = versions.scd2_apply(history, incoming, "product_id", F.lit("2002-01-01").cast("timestamp_ntz"))
    current = relational.current_version(applied).select("product_id", F.col("product_size_category").alias("size"))
    items = staging(spark, sf_dir)["stg_order_items"].select("order_id", "order_item_id", "product_id")
    return items.join(current, "product_id", "left")


@query("payment_key_resolution", "SELECT order_id, order_status_sk, order_date_key, payment_sequential FROM fact_payments")
def payment_key_resolution(spark, sf_dir):
    s = star(spark, sf_dir)
    resolved = s["stg_payments"].join(facts.order_lookup(s["stg_orders"], s["dim_order_status"]), "order_id")
    return resolved.select("order_id", "order_status_sk", "order_date_key", "payment_sequential")


@query("review_key_resolution", """SELECT r.review_id, r.order_id, k.customer_sk, k.order_status_sk
    FROM stg_reviews r JOIN order_keys k USING (order_id) WHERE k.customer_sk IS NOT NULL""")
def review_key_resolution(spark, sf_dir):
    s = star(spark, sf_dir)
    lookup = facts.order_lookup(s["stg_orders"], s["dim_order_status"], s["dim_customer"])
    return s["stg_reviews"].join(lookup, "order_id").select("review_id", "order_id", "customer_sk", "order_status_sk")


@query("fact_dim_left_join", """SELECT f.order_item_sk, d.year * 100 + d.month AS year_month, d.month_name, c.customer_state
    FROM fact_order_items f LEFT JOIN dim_date d ON f.order_date_key = d.date_key
    LEFT JOIN dim_customer c ON f.customer_sk = c.customer_sk WHERE d.full_date IS NOT NULL""")
def fact_dim_left_join(spark, sf_dir):
    s = star(spark, sf_dir)
    joined = marts.fact_dim_left_join(s["fact_order_items"], s["dim_date"], s["dim_customer"])
    return joined.select("order_item_sk", "year_month", "month_name", "customer_state")


@query("dimension_preserving_join", """SELECT p.product_sk, p.product_id, f.order_id, f.order_item_id, CAST(f.item_price AS DOUBLE) AS item_price,
    r.review_id, r.review_score FROM dim_product p LEFT JOIN fact_order_items f ON p.product_sk = f.product_sk
    LEFT JOIN fact_reviews r ON f.order_id = r.order_id""")
def dimension_preserving_join(spark, sf_dir):
    s = star(spark, sf_dir)
    return marts.dimension_preserving_join(s["dim_product"], s["fact_order_items"], s["fact_reviews"])


@query("inner_plus_optional_join", """SELECT f.order_item_sk, f.order_id, c.customer_sk, c.customer_unique_id, s.order_status_sk,
    CAST(s.purchased AS VARCHAR) AS order_purchase_timestamp, CAST(f.total_item_value AS DOUBLE) AS total_item_value,
    y.payment_sequential, CAST(y.payment_value AS DOUBLE) AS payment_value
    FROM fact_order_items f JOIN dim_customer c USING (customer_sk) JOIN dim_order_status s USING (order_status_sk)
    LEFT JOIN fact_payments y ON f.order_id = y.order_id WHERE s.order_status = 'delivered'""")
def inner_plus_optional_join(spark, sf_dir):
    s = star(spark, sf_dir)
    return rfm.inner_plus_optional_join(s["dim_customer"], s["fact_order_items"], s["dim_order_status"], s["fact_payments"])


@query("join_preaggregate", "SELECT c.customer_sk, v.avg_review_score, v.total_reviews FROM dim_customer c LEFT JOIN review_stats v USING (customer_sk)")
def join_preaggregate(spark, sf_dir):
    s = star(spark, sf_dir)
    return s["dim_customer"].select("customer_sk").join(rfm.customer_review_stats(s["fact_reviews"]), "customer_sk", "left")


@query("mart_dim_inner_join", """SELECT m.* EXCLUDE (product_perf_sk) REPLACE (CAST(last_12_months_revenue AS DOUBLE) AS last_12_months_revenue),
    p.product_id, p.product_category_name, p.product_category_english FROM agg_product_performance m JOIN dim_product p USING (product_sk)""")
def mart_dim_inner_join(spark, sf_dir):
    s = star(spark, sf_dir)
    return reports.mart_dim_inner_join(s["agg_product_performance"], s["dim_product"])


@query("fact_fact_dim_join", """SELECT r.order_id, r.review_id, r.review_score, f.order_item_sk, f.product_sk, p.product_category_english
    FROM fact_reviews r JOIN fact_order_items f USING (order_id) JOIN dim_product p ON f.product_sk = p.product_sk""")
def fact_fact_dim_join(spark, sf_dir):
    s = star(spark, sf_dir)
    return reports.fact_fact_dim_join(s["fact_reviews"], s["fact_order_items"], s["dim_product"])


@query("orphan_anti_join", """SELECT i.order_id, count(*) AS n FROM stg_order_items i
    WHERE NOT EXISTS (SELECT 1 FROM dim_order_status s WHERE s.order_id = i.order_id) GROUP BY i.order_id""")
def orphan_anti_join(spark, sf_dir):
    """Items whose order was refused by the order dimension."""
    s = star(spark, sf_dir)
    orphans = quality.orphan_anti_join(s["stg_order_items"], "order_id", s["dim_order_status"], "order_id")
    return orphans.groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))


# Sets and duplicates


@query("date_union_distinct", "SELECT CAST(full_date AS VARCHAR) AS full_date FROM source_dates")
def date_union_distinct(spark, sf_dir):
    return dimensions.date_union_distinct(staging(spark, sf_dir))


_LAYER_TABLES = {
    "dimensions": ["dim_date", "dim_customer", "dim_product", "dim_seller", "dim_order_status"],
    "facts": ["fact_order_items", "fact_payments", "fact_reviews"],
    "marts": ["agg_monthly_sales", "agg_product_performance"],
}
_TABLE_COUNTS = " UNION ALL ".join(
    f"SELECT '{layer}' AS layer, '{t}' AS table_name, count(*) AS row_count FROM {t}"
    for layer, tables in _LAYER_TABLES.items() for t in tables
)


def _counts(spark, sf_dir):
    s = star(spark, sf_dir)
    layers = {t: layer for layer, tables in _LAYER_TABLES.items() for t in tables}
    return relational.table_counts({t: s[t] for t in layers}, layers)


@query("layer_count_union_all", f"SELECT layer, count(*) AS table_count, CAST(sum(row_count) AS BIGINT) AS row_count FROM ({_TABLE_COUNTS}) GROUP BY layer")
def layer_count_union_all(spark, sf_dir):
    return relational.layer_totals(_counts(spark, sf_dir))


@query("layer_row_counts", _TABLE_COUNTS)
def layer_row_counts(spark, sf_dir):
    return _counts(spark, sf_dir)


_ALL = [t for tables in _LAYER_TABLES.values() for t in tables]


@query("row_count_pivot", "SELECT layer, " + ", ".join(f"CAST(sum(row_count) FILTER (table_name = '{t}') AS BIGINT) AS {t}" for t in _ALL) + f" FROM ({_TABLE_COUNTS}) GROUP BY layer")
def row_count_pivot(spark, sf_dir):
    return relational.row_count_pivot(_counts(spark, sf_dir), _ALL)


@query("distinct_rows", "SELECT DISTINCT customer_unique_id, customer_state FROM stg_customers")
def distinct_rows(spark, sf_dir):
    return staging(spark, sf_dir)["stg_customers"].select("customer_unique_id", "customer_state").distinct()


@query("latest_per_key", f"""SELECT DISTINCT ON (review_id) review_id, order_id, review_score FROM stg_reviews
    ORDER BY review_id, {stamp('review_creation_date')} DESC NULLS LAST, order_id""")
def latest_per_key(spark, sf_dir):
    reviews = staging(spark, sf_dir)["stg_reviews"].select(
        "review_id", "order_id", "review_score", text.parse_timestamp("review_creation_date").alias("created")
    )
    return facts.latest_per_key(reviews, "review_id", "created", "order_id").drop("created")


@query("drop_duplicates_subset", """SELECT DISTINCT ON (l_orderkey, l_linenumber) l_orderkey, l_linenumber, l_partkey, l_suppkey
    FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey""")
def drop_duplicates_subset(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return relational.first_per_key(lines, ["l_orderkey", "l_linenumber"], [F.col("l_partkey"), F.col("l_suppkey")])


@query("duplicate_row_count", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {t})) AS duplicate_rows"
    for t in STAGING) + " UNION ALL SELECT 'item keys', CAST(COALESCE(sum(n - 1), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM stg_order_items GROUP BY order_id, order_item_id)")
def duplicate_row_count(spark, sf_dir):
    """Whole rows of every staging table, and the declared key of the items, which does repeat."""
    tables = staging(spark, sf_dir)
    counted = {t: tables[t] for t in STAGING} | {"item keys": tables["stg_order_items"].select("order_id", "order_item_id")}
    return profiling.per_table(relational.duplicate_row_count, counted)


@query("key_set_difference", "SELECT order_id FROM stg_orders EXCEPT SELECT order_id FROM stg_order_items")
def key_set_difference(spark, sf_dir):
    tables = staging(spark, sf_dir)
    return relational.key_set_difference(tables["stg_orders"], tables["stg_order_items"], "order_id")
