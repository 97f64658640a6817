"""Constraints, profiling and business-rule validation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conformance.ctes import stamp, trunc_hours
from conformance.fixtures import staging
from conformance.registry import query
from conformance.star import star
from tradewind.operators import profiling, quality
from tradewind.plans import dimensions, facts, warehouse

_STAR_TABLES = ["dim_date", "dim_customer", "dim_product", "dim_seller", "dim_order_status", "fact_order_items",
                "fact_payments", "fact_reviews", "agg_monthly_sales", "agg_product_performance"]


def _unchecked(spark, sf_dir):
    """Dimension rows as built, before bad rows are set aside."""
    tables = star(spark, sf_dir)
    return {
        "dim_customer": (dimensions.build_dim_customer(tables["stg_customers"]), "customer_id"),
        "dim_seller": (dimensions.build_dim_seller(tables["stg_sellers"]), "seller_id"),
        "dim_product": (dimensions.build_dim_product(tables["stg_products"], tables["stg_product_categories"]), "product_id"),
        "dim_order_status": (dimensions.build_dim_order_status(tables["stg_orders"]), "order_id"),
    }


def _union(frames):
    return reduce(DataFrame.unionByName, frames)


@query("check_not_null", """SELECT 'dim_order_status' AS table_name, 'not_null:order_purchase_timestamp' AS rule, order_id AS row_key,
    CAST(NULL AS VARCHAR) AS value FROM order_measured WHERE purchased IS NULL""")
def check_not_null(spark, sf_dir):
    return _union(quality.check_kind(df, name, "not_null", key) for name, (df, key) in _unchecked(spark, sf_dir).items())


@query("check_range", """SELECT 'fact_reviews' AS table_name, 'range:review_score' AS rule, review_id AS row_key, CAST(review_score AS VARCHAR) AS value
    FROM review_measured WHERE review_score NOT BETWEEN 1 AND 5""")
def check_range(spark, sf_dir):
    s = star(spark, sf_dir)
    reviews = facts.build_fact_reviews(s["stg_reviews"], s["stg_orders"], s["dim_customer"], s["dim_order_status"])
    checks = [quality.check_kind(reviews, "fact_reviews", "range", "review_id")]
    checks += [quality.check_kind(df, n, "range", k) for n, (df, k) in _unchecked(spark, sf_dir).items()]
    checks += [
        quality.check_kind(s[t], t, "range", warehouse.KEYS[t][0] if t in warehouse.KEYS else s[t].columns[0])
        for t in ("dim_date", "fact_order_items", "fact_payments", "agg_monthly_sales", "agg_product_performance")
    ]
    return _union(checks)


@query("check_enum", """SELECT 'stg_reviews' AS table_name, 'enum:review_score' AS rule, review_id || '/' || order_id AS row_key, CAST(review_score AS VARCHAR) AS value
    FROM stg_reviews WHERE review_score NOT IN (3, 4, 5)""")
def check_enum(spark, sf_dir):
    """The declared enumerations hold everywhere; an undeclared one finds rows."""
    s = star(spark, sf_dir)
    declared = [
        quality.check_kind(s[t], t, "enum", s[t].columns[0]) for t in ("dim_product", "dim_order_status", "fact_payments", "fact_reviews")
    ]
    reviews = s["stg_reviews"].select(
        F.concat("review_id", F.lit("/"), "order_id").alias("k"), F.col("review_score").cast("string").alias("review_score")
    )
    return _union([*declared, quality.check_rows(reviews, "stg_reviews", quality.one_of("review_score", "3", "4", "5"), "k")])


@query("check_length", """SELECT 'dim_customer' AS table_name, 'length:customer_state' AS rule, customer_id AS row_key, customer_state AS value FROM customer_rows WHERE length(customer_state) <> 2
    UNION ALL SELECT 'dim_seller', 'length:seller_state', seller_id, seller_state FROM seller_rows WHERE length(seller_state) <> 2""")
def check_length(spark, sf_dir):
    rows = _unchecked(spark, sf_dir)
    return _union(quality.check_kind(rows[t][0], t, "length", rows[t][1]) for t in ("dim_customer", "dim_seller"))


@query("check_unique", """SELECT 'stg_reviews' AS table_name, 'unique:review_id' AS rule, review_id AS row_key, CAST(count(*) AS VARCHAR) AS value
    FROM stg_reviews GROUP BY review_id HAVING count(*) > 1""")
def check_unique(spark, sf_dir):
    """Every single declared key is unique in the star schema; review ids repeat in the source."""
    s = star(spark, sf_dir)
    checks = [
        quality.check_unique(s[t], t, key) for t in _STAR_TABLES for key in quality.UNIQUE_KEYS[t] if len(key) == 1
    ]
    return _union([*checks, quality.check_unique(s["stg_reviews"], "stg_reviews", ("review_id",))])


@query("check_unique_composite", """SELECT 'fact_order_items' AS table_name, 'unique:order_id,order_item_id' AS rule, order_id || '|' || order_item_id AS row_key,
    CAST(count(*) AS VARCHAR) AS value FROM fact_order_items GROUP BY order_id, order_item_id HAVING count(*) > 1""")
def check_unique_composite(spark, sf_dir):
    s = star(spark, sf_dir)
    return _union(
        quality.check_unique(s[t], t, key) for t in _STAR_TABLES for key in quality.UNIQUE_KEYS[t] if len(key) > 1
    )


@query("check_foreign_key", """SELECT 'stg_order_items' AS table_name, 'foreign_key:order_id' AS rule, order_id || '/' || order_item_id || '/' || product_id AS row_key,
    order_id AS value FROM stg_order_items WHERE order_id NOT IN (SELECT order_id FROM dim_order_status)""")
def check_foreign_key(spark, sf_dir):
    """All declared references hold between loaded tables; source items of refused orders are orphans."""
    s = star(spark, sf_dir)
    tables = {t: s[t] for t in _STAR_TABLES}
    keys = {"fact_order_items": "order_item_sk", "fact_payments": "payment_sk", "fact_reviews": "review_sk", "agg_product_performance": "product_sk"}
    items = s["stg_order_items"].withColumn("k", F.concat_ws("/", "order_id", F.col("order_item_id").cast("string"), "product_id"))
    source = quality.check_foreign_key(items, "stg_order_items", "order_id", s["dim_order_status"], "order_id", "k")
    return quality.check_foreign_keys(tables, keys).unionByName(source)


@query("check_row_order", """SELECT 'stg_orders' AS table_name, 'row_order:estimated<=delivered' AS rule, order_id AS row_key, CAST(estimated AS VARCHAR) AS value
    FROM order_times WHERE estimated > delivered""")
def check_row_order(spark, sf_dir):
    """The declared time orders hold; estimated ≤ delivered is not declared and finds early deliveries."""
    rows = _unchecked(spark, sf_dir)
    declared = [quality.check_kind(rows[t][0], t, "row_order", rows[t][1]) for t in ("dim_product", "dim_order_status")]
    from tradewind.functions.text import parse_timestamp

    times = staging(spark, sf_dir)["stg_orders"].select(
        "order_id", parse_timestamp("order_estimated_delivery_date").alias("estimated"),
        parse_timestamp("order_delivered_customer_date").alias("delivered"),
    )
    return _union([*declared, quality.check_rows(times, "stg_orders", quality.ordered("estimated", "delivered"), "order_id")])


_FKS = [(f"fk_{a}_{b}", a, b, c, d) for a, b, c, d in quality.FOREIGN_KEYS]


_ORPHANS = " UNION ALL ".join(
    f"""SELECT '{name}' AS constraint_name, '{child}' AS table_name, '{column}' AS column_name, '{parent}' AS references_table, '{key}' AS references_column,
        (SELECT count(*) FROM {child} x WHERE x.{column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} y WHERE y.{key} = x.{column})) AS orphans"""
    for name, child, column, parent, key in _FKS)


@query("constraint_registry", _ORPHANS)
def constraint_registry(spark, sf_dir):
    """Every declared reference with its number of orphans in the loaded tables."""
    s = star(spark, sf_dir)
    orphans = _union(
        quality.orphan_anti_join(s[child], column, s[parent], parent_column).agg(F.count(F.lit(1)).alias("orphans")).select(
            F.lit(f"fk_{child}_{column}").alias("constraint_name"), "orphans"
        )
        for child, column, parent, parent_column in quality.FOREIGN_KEYS
    )
    return quality.constraint_registry(spark).join(orphans, "constraint_name")


@query("quarantine_split", """SELECT order_id, 'not_null:order_purchase_timestamp' AS broken_rules, TRUE AS rejected FROM order_measured WHERE purchased IS NULL
    UNION ALL SELECT order_id, '', FALSE FROM dim_order_status""")
def quarantine_split(spark, sf_dir):
    rows, _ = _unchecked(spark, sf_dir)["dim_order_status"]
    valid, rejected = quality.quarantine_split(rows, quality.ROW_RULES["dim_order_status"])
    return valid.select("order_id", F.lit("").alias("broken_rules"), F.lit(False).alias("rejected")).unionByName(
        rejected.select("order_id", "broken_rules", F.lit(True).alias("rejected"))
    )


_UNRESOLVED = "CASE WHEN {0} IS NULL THEN 'not_null:{0}' END"


@query("rejected_rows", f"""
    SELECT 'dim_customer' AS table_name, customer_id AS row_key, 'length:customer_state' AS broken_rules FROM customer_rows WHERE length(customer_state) <> 2
    UNION ALL SELECT 'dim_seller', seller_id, 'length:seller_state' FROM seller_rows WHERE length(seller_state) <> 2
    UNION ALL SELECT * FROM (SELECT 'dim_order_status', order_id, concat_ws(',',
            CASE WHEN purchased IS NULL THEN 'not_null:order_purchase_timestamp' END,
            CASE WHEN approval_delay_hours < 0 THEN 'range:approval_delay_hours' END, CASE WHEN total_delivery_days < 0 THEN 'range:total_delivery_days' END,
            CASE WHEN purchased > approved THEN 'row_order:order_purchase_timestamp<=order_approved_at' END,
            CASE WHEN purchased > estimated THEN 'row_order:order_purchase_timestamp<=order_estimated_delivery_date' END) AS broken
        FROM order_measured) WHERE broken <> ''
    UNION ALL SELECT * FROM (SELECT 'fact_order_items', i.order_id || '/' || order_item_id || '/' || i.product_id,
            concat_ws(',', {', '.join(_UNRESOLVED.format(k) for k in ('customer_sk', 'product_sk', 'seller_sk', 'order_status_sk'))}) AS broken
        FROM stg_order_items i LEFT JOIN stg_orders o ON i.order_id = o.order_id LEFT JOIN dim_customer c ON o.customer_id = c.customer_id
        LEFT JOIN dim_product p ON i.product_id = p.product_id LEFT JOIN dim_seller e ON i.seller_id = e.seller_id
        LEFT JOIN dim_order_status s ON i.order_id = s.order_id) WHERE broken <> ''
    UNION ALL SELECT 'fact_payments', order_id || '/' || payment_sequential, 'not_null:order_status_sk' FROM stg_payments
        WHERE order_id NOT IN (SELECT order_id FROM dim_order_status)
    UNION ALL SELECT * FROM (SELECT 'fact_reviews', review_id || '/' || order_id, concat_ws(',', {_UNRESOLVED.format('customer_sk')}, {_UNRESOLVED.format('order_status_sk')},
            CASE WHEN COALESCE(review_score, 0) NOT BETWEEN 1 AND 5 THEN 'range:review_score' END,
            CASE WHEN {trunc_hours('answered', 'created')} < 0 THEN 'range:response_time_hours' END,
            CASE WHEN complete AND row_number() OVER (PARTITION BY review_id, complete ORDER BY created DESC NULLS LAST, order_id) > 1 THEN 'unique:review_id' END) AS broken
        FROM (SELECT r.*, c.customer_sk, s.order_status_sk, c.customer_sk IS NOT NULL AND s.order_status_sk IS NOT NULL AS complete,
                     {stamp('r.review_creation_date')} AS created, {stamp('r.review_answer_timestamp')} AS answered
              FROM stg_reviews r LEFT JOIN stg_orders o ON r.order_id = o.order_id LEFT JOIN dim_customer c ON o.customer_id = c.customer_id
              LEFT JOIN dim_order_status s ON r.order_id = s.order_id)) WHERE broken <> ''""")
def rejected_rows(spark, sf_dir):
    """Every row that is not loaded, with the rules it breaks."""
    s = star(spark, sf_dir)
    keys = {
        "dim_customer": ["customer_id"], "dim_product": ["product_id"], "dim_seller": ["seller_id"], "dim_order_status": ["order_id"],
        "fact_order_items": ["order_id", "order_item_id", "product_id"], "fact_payments": ["order_id", "payment_sequential"],
        "fact_reviews": ["review_id", "order_id"],
    }
    parts = [
        warehouse.rejected_rows(t, s).select(F.lit(t).alias("table_name"), F.concat_ws("/", *[F.col(k).cast("string") for k in key]).alias("row_key"), "broken_rules")
        for t, key in keys.items()
    ]
    return _union(parts)


# Profiling

_COLUMNS = {
    "stg_customers": ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"],
    "stg_products": ["product_id", "product_category_name", "product_name_lenght", "product_description_lenght", "product_photos_qty",
                     "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"],
    "stg_sellers": ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
    "stg_orders": ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
                   "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date"],
    "stg_order_items": ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value"],
    "stg_payments": ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"],
    "stg_reviews": ["review_id", "order_id", "review_score", "review_comment_title", "review_comment_message",
                    "review_creation_date", "review_answer_timestamp"],
    "stg_product_categories": ["product_category_name", "product_category_name_english"],
}
_NUMERIC = {"stg_order_items": 3, "stg_payments": 3, "stg_reviews": 1}
_IDS = {t: [c for c in cols if "id" in c] for t, cols in _COLUMNS.items() if any("id" in c for c in cols)}
_DATES = {t: [c for c in cols if "date" in c or "time" in c] for t, cols in _COLUMNS.items() if any("date" in c or "time" in c for c in cols)}


def _tables(spark, sf_dir, names=_COLUMNS):
    tables = staging(spark, sf_dir)
    return {t: tables[t] for t in names}


def _nulls(table):
    return " + ".join(f"count(*) FILTER ({c} IS NULL)" for c in _COLUMNS[table])


@query("profile_structure", " UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, count(*) AS n_rows, {len(cols)} AS n_columns, {_NUMERIC.get(t, 0)} AS numeric_columns,
        {len(cols) - _NUMERIC.get(t, 0)} AS text_columns, CAST({_nulls(t)} AS BIGINT) AS missing_values FROM {t}""" for t, cols in _COLUMNS.items()))
def profile_structure(spark, sf_dir):
    return profiling.profile_structure(_tables(spark, sf_dir))


@query("missing_report", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS missing, CAST(count(*) FILTER ({c} IS NULL) AS DOUBLE) / count(*) * 100 AS missing_pct FROM {t}"
    for t, cols in _COLUMNS.items() for c in cols) + ") WHERE missing > 0")
def missing_report(spark, sf_dir):
    return profiling.per_table(profiling.missing_report, _tables(spark, sf_dir))


@query("key_uniqueness", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values, count(*) AS n_rows, CAST(count(DISTINCT {c}) AS DOUBLE) / count(*) AS uniqueness FROM {t}"
    for t, cols in _IDS.items() for c in cols))
def key_uniqueness(spark, sf_dir):
    return profiling.per_table(profiling.key_uniqueness, _tables(spark, sf_dir, _IDS))


@query("date_range_report", " UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, '{c}' AS column_name, CAST(min(TRY_CAST({c} AS TIMESTAMP)) AS VARCHAR) AS first_time, CAST(max(TRY_CAST({c} AS TIMESTAMP)) AS VARCHAR) AS last_time,
        count(*) FILTER ({c} IS NOT NULL AND TRY_CAST({c} AS TIMESTAMP) IS NULL) > 0 AS conversion_failed FROM {t}"""
    for t, cols in _DATES.items() for c in cols))
def date_range_report(spark, sf_dir):
    return profiling.per_table(profiling.date_range_report, _tables(spark, sf_dir, _DATES))


def _references(spark, sf_dir):
    s = star(spark, sf_dir)
    return profiling.referential_report(
        {
            "orders->customers": (s["stg_orders"], "customer_id", s["stg_customers"], "customer_id"),
            "items->orders": (s["stg_order_items"], "order_id", s["stg_orders"], "order_id"),
            "orders->items": (s["stg_orders"], "order_id", s["stg_order_items"], "order_id"),
            "items->loaded orders": (s["stg_order_items"], "order_id", s["dim_order_status"], "order_id"),
        }
    )


_REFERENCES = """SELECT 'orders->customers' AS relationship, count(*) AS orphaned_keys FROM (SELECT customer_id FROM stg_orders EXCEPT SELECT customer_id FROM stg_customers)
    UNION ALL SELECT 'items->orders', count(*) FROM (SELECT order_id FROM stg_order_items EXCEPT SELECT order_id FROM stg_orders)
    UNION ALL SELECT 'orders->items', count(*) FROM (SELECT order_id FROM stg_orders EXCEPT SELECT order_id FROM stg_order_items)
    UNION ALL SELECT 'items->loaded orders', count(*) FROM (SELECT order_id FROM stg_order_items EXCEPT SELECT order_id FROM dim_order_status)"""


@query("referential_report", _REFERENCES)
def referential_report(spark, sf_dir):
    return _references(spark, sf_dir)


def _items(spark, sf_dir):
    return star(spark, sf_dir)["stg_order_items"].drop("record_hash")


_SEQUENCES = """(SELECT order_id, count(*) AS n, min(order_item_id) AS lo, max(order_item_id) AS hi, count(DISTINCT order_item_id) AS d,
    string_agg(CAST(order_item_id AS VARCHAR), ',' ORDER BY order_item_id) AS actual FROM stg_order_items GROUP BY order_id)"""
_GAP = "actual <> (SELECT string_agg(CAST(i AS VARCHAR), ',' ORDER BY i) FROM range(1, n + 1) t(i))"


@query("sequence_starts_at_one", f"SELECT order_id, lo AS first_item FROM {_SEQUENCES} WHERE lo <> 1")
def sequence_starts_at_one(spark, sf_dir):
    return profiling.sequence_not_from_one(_items(spark, sf_dir))


@query("sequence_has_no_gaps", f"SELECT order_id, n AS n_items FROM {_SEQUENCES} WHERE {_GAP}")
def sequence_has_no_gaps(spark, sf_dir):
    return profiling.sequence_gaps(_items(spark, sf_dir))


@query("sequence_unique_pair", "SELECT order_id, order_item_id, count(*) AS n FROM stg_order_items GROUP BY 1, 2 HAVING count(*) > 1")
def sequence_unique_pair(spark, sf_dir):
    return profiling.sequence_duplicates(_items(spark, sf_dir))


@query("sequence_examples", f"""SELECT order_id, order_item_id AS actual, CAST(row_number() OVER (PARTITION BY order_id ORDER BY order_item_id) AS INTEGER) AS expected
    FROM stg_order_items WHERE order_id IN (SELECT order_id FROM {_SEQUENCES} WHERE {_GAP} ORDER BY order_id LIMIT 3)""")
def sequence_examples(spark, sf_dir):
    return profiling.sequence_examples(_items(spark, sf_dir), ["product_id"], 3)


@query("sequence_compliance", f"""
    SELECT *, CAST(compliant_orders AS DOUBLE) / total_orders * 100 AS compliance_rate,
           CAST(total_orders - orders_with_gaps AS DOUBLE) / total_orders * 100 AS integrity_pct,
           CAST(compliant_orders AS DOUBLE) / total_orders * 100 >= 95 AS meets_target
    FROM (SELECT *, total_orders - orders_with_gaps - orders_not_from_one AS compliant_orders
          FROM (SELECT count(*) AS total_orders, count(*) FILTER ({_GAP}) AS orders_with_gaps, count(*) FILTER (lo <> 1) AS orders_not_from_one
                FROM {_SEQUENCES}))""")
def sequence_compliance(spark, sf_dir):
    return profiling.sequence_compliance(_items(spark, sf_dir))


@query("resequence_items", """SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date, CAST(price AS DOUBLE) AS price,
    CAST(freight_value AS DOUBLE) AS freight_value, CAST(row_number() OVER (PARTITION BY order_id ORDER BY order_item_id, product_id, seller_id, shipping_limit_date, price, freight_value) AS INTEGER) AS corrected_item_id
    FROM stg_order_items""")
def resequence_items(spark, sf_dir):
    ties = ["product_id", "seller_id", "shipping_limit_date", "price", "freight_value"]
    return profiling.resequence_items(_items(spark, sf_dir), ties)


@query("timestamp_quality", " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(*) AS total, count({stamp(c)}) AS valid, count(*) - count({stamp(c)}) AS missing,
        CAST(count(*) - count({stamp(c)}) AS DOUBLE) / count(*) * 100 AS missing_pct, CAST(min({stamp(c)}) AS VARCHAR) AS first_time,
        CAST(max({stamp(c)}) AS VARCHAR) AS last_time FROM stg_orders""" for c in dimensions.ORDER_TIMES))
def timestamp_quality(spark, sf_dir):
    return profiling.timestamp_quality(staging(spark, sf_dir)["stg_orders"], dimensions.ORDER_TIMES)


@query("timestamp_progression", """SELECT count(*) AS total_with_timestamps, count(*) FILTER (purchased <= approved AND approved <= delivered) AS valid_progression,
    CAST(count(*) FILTER (purchased <= approved AND approved <= delivered) AS DOUBLE) / count(*) * 100 AS progression_rate
    FROM order_times WHERE purchased IS NOT NULL AND approved IS NOT NULL AND delivered IS NOT NULL""")
def timestamp_progression(spark, sf_dir):
    orders = staging(spark, sf_dir)["stg_orders"]
    return profiling.timestamp_progression(orders, "order_purchase_timestamp", "order_approved_at", "order_delivered_customer_date")


@query("threshold_gate", f"""
    SELECT 'max_missing_percentage' AS gate, m AS measured, 10.0::DOUBLE AS allowed, m <= 10 AS passed
    FROM (SELECT max(share) AS m FROM ({' UNION ALL '.join(f'SELECT CAST(count(*) FILTER ({c} IS NULL) AS DOUBLE) / count(*) * 100 AS share FROM {t}' for t, cols in _COLUMNS.items() for c in cols)}))
    UNION ALL SELECT 'validate_order_sequence', CAST(count(*) AS DOUBLE), 0.0, count(*) = 0 FROM {_SEQUENCES} WHERE {_GAP}
    UNION ALL SELECT 'enforce_referential_integrity', CAST(sum(orphaned_keys) AS DOUBLE), 0.0, sum(orphaned_keys) = 0 FROM ({_REFERENCES})""")
def threshold_gate(spark, sf_dir):
    tables = _tables(spark, sf_dir)
    return profiling.threshold_gate(tables, tables["stg_order_items"], _references(spark, sf_dir))
