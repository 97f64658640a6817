"""Cleaning and scalar expressions over source and dimension rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from conformance.ctes import capitalized, delay_class, floor_days, number, region, size_class, stamp, trunc_hours
from conformance.fixtures import staging
from conformance.registry import query
from conformance.star import star
from tradewind.functions import calendar as cal
from tradewind.functions import retail, text
from tradewind.operators import relational, stats
from tradewind.plans import dimensions

# Cleaning


@query("valid_token_filter", """SELECT order_id, order_approved_at FROM stg_orders
    WHERE order_approved_at IS NOT NULL AND order_approved_at NOT IN ('', 'NaN')""")
def valid_token_filter(spark, sf_dir):
    orders = staging(spark, sf_dir)["stg_orders"]
    return relational.valid_token_filter(orders, "order_approved_at").select("order_id", "order_approved_at")


@query("null_tokens", f"""SELECT order_id, NULLIF(NULLIF(order_approved_at, ''), 'NaN') AS approved_text,
    CAST({stamp('order_approved_at')} AS VARCHAR) AS approved FROM stg_orders""")
def null_tokens(spark, sf_dir):
    return staging(spark, sf_dir)["stg_orders"].select(
        "order_id", text.null_tokens("order_approved_at").alias("approved_text"),
        text.parse_timestamp("order_approved_at").alias("approved"),
    )


@query("nan_to_default", """SELECT product_id,
    CASE WHEN product_length_cm = 'NaN' THEN 0.0 ELSE CAST(product_length_cm AS DOUBLE) END AS length FROM stg_products""")
def nan_to_default(spark, sf_dir):
    length = F.col("product_length_cm").cast("double")
    return staging(spark, sf_dir)["stg_products"].select("product_id", text.nan_to_default(length).alias("length"))


@query("coalesce_default", """SELECT order_id, payment_sequential, COALESCE(payment_type, 'not_defined') AS payment_type FROM stg_payments""")
def coalesce_default(spark, sf_dir):
    return staging(spark, sf_dir)["stg_payments"].select(
        "order_id", "payment_sequential", text.coalesce_default("payment_type", default="not_defined").alias("payment_type")
    )


@query("clean_city", f"""SELECT customer_id, {capitalized("trim(COALESCE(customer_city, 'Unknown'))")} AS city FROM stg_customers""")
def clean_city(spark, sf_dir):
    return staging(spark, sf_dir)["stg_customers"].select("customer_id", text.clean_city("customer_city").alias("city"))


@query("clean_state", "SELECT customer_id, upper(trim(COALESCE(customer_state, 'Unknown'))) AS state FROM stg_customers")
def clean_state(spark, sf_dir):
    return staging(spark, sf_dir)["stg_customers"].select("customer_id", text.clean_state("customer_state").alias("state"))


@query("require_key", "SELECT order_id, review_id, review_score FROM stg_reviews WHERE review_score IS NOT NULL")
def require_key(spark, sf_dir):
    reviews = staging(spark, sf_dir)["stg_reviews"]
    return dimensions.require_key(reviews, "review_id", "review_score").select("order_id", "review_id", "review_score")


@query("parse_timestamp_permissive", f"""SELECT order_id, CAST({stamp('order_purchase_timestamp')} AS VARCHAR) AS purchased,
    CAST({stamp('order_delivered_carrier_date')} AS VARCHAR) AS carried FROM stg_orders""")
def parse_timestamp_permissive(spark, sf_dir):
    return staging(spark, sf_dir)["stg_orders"].select(
        "order_id", text.parse_timestamp("order_purchase_timestamp").alias("purchased"),
        text.parse_timestamp("order_delivered_carrier_date").alias("carried"),
    )


@query("parse_number_permissive", f"""SELECT product_id, {number('product_length_cm', 'DOUBLE')}::DOUBLE AS length,
    {number('product_weight_g', 'DOUBLE')}::DOUBLE AS weight FROM stg_products""")
def parse_number_permissive(spark, sf_dir):
    return staging(spark, sf_dir)["stg_products"].select(
        "product_id", text.parse_number("product_length_cm").alias("length"), text.parse_number("product_weight_g").alias("weight")
    )


@query("median_impute", """
    SELECT review_id, order_id, COALESCE(CAST(review_score AS DOUBLE), (SELECT median(review_score) FROM stg_reviews)) AS review_score
    FROM stg_reviews""")
def median_impute(spark, sf_dir):
    reviews = staging(spark, sf_dir)["stg_reviews"].select("review_id", "order_id", "review_score")
    return stats.median_impute(reviews, ["review_score"])


@query("constant_impute", "SELECT review_id, order_id, COALESCE(CAST(review_score AS DOUBLE), 3.0) AS review_score FROM stg_reviews")
def constant_impute(spark, sf_dir):
    reviews = staging(spark, sf_dir)["stg_reviews"].select("review_id", "order_id", F.col("review_score").cast("double"))
    return stats.constant_impute(reviews, {"review_score": 3.0})


@query("type_finalize", """SELECT year_month, CAST(total_orders AS BIGINT) AS total_orders, CAST(total_revenue AS DOUBLE) AS total_revenue,
    CAST(avg_items_per_order AS DOUBLE) AS avg_items_per_order FROM agg_monthly_sales""")
def type_finalize(spark, sf_dir):
    return star(spark, sf_dir)["agg_monthly_sales"].select("year_month", "total_orders", "total_revenue", "avg_items_per_order")


# Scalars


@query("state_region", f"""SELECT n_nationkey, ['AC','AL','AM','AP','BA','CE','DF','ES','GO','MA','MG','MS','MT','PA','PB','PE','PI','PR','RJ','RN','RO','RR','RS','SC','SE','SP','TO'][n_nationkey + 1] AS state,
    {region("['AC','AL','AM','AP','BA','CE','DF','ES','GO','MA','MG','MS','MT','PA','PB','PE','PI','PR','RJ','RN','RO','RR','RS','SC','SE','SP','TO'][n_nationkey + 1]")} AS region FROM nation""")
def state_region(spark, sf_dir):
    from conformance.fixtures import UF, read

    state = F.element_at(F.array(*[F.lit(s) for s in UF]), F.col("n_nationkey") + 1)
    return read(spark, sf_dir, "nation").select("n_nationkey", state.alias("state"), retail.state_region(state).alias("region"))


_L, _H, _W = (number(f"product_{c}_cm", "DECIMAL(10,2)") for c in ("length", "height", "width"))
_VOLUME = f"CAST(({_L}) AS DOUBLE) * CAST(({_H}) AS DOUBLE) * CAST(({_W}) AS DOUBLE)"


def _volume():
    sizes = [text.parse_number(f"product_{c}_cm") for c in ("length", "height", "width")]
    return retail.product_volume(*sizes)


@query("product_volume", f"SELECT product_id, {_VOLUME} AS volume FROM stg_products")
def product_volume(spark, sf_dir):
    return staging(spark, sf_dir)["stg_products"].select("product_id", _volume().alias("volume"))


@query("size_category", f"SELECT product_id, {size_class(_VOLUME)} AS size FROM stg_products")
def size_category(spark, sf_dir):
    return staging(spark, sf_dir)["stg_products"].select("product_id", retail.size_category(_volume()).alias("size"))


_STRICT = "TRY_CAST(NULLIF(product_length_cm, 'NaN') AS DOUBLE) * CAST(product_height_cm AS DOUBLE) * CAST(product_width_cm AS DOUBLE)"


@query("size_category_strict", f"""SELECT product_id, CASE WHEN {_STRICT} IS NULL THEN 'Unknown' ELSE {size_class(_STRICT)} END AS size
    FROM stg_products""")
def size_category_strict(spark, sf_dir):
    sizes = [text.null_tokens(f"product_{c}_cm").cast("double") for c in ("length", "height", "width")]
    return staging(spark, sf_dir)["stg_products"].select("product_id", retail.size_category_strict(*sizes).alias("size"))


@query("date_key", """SELECT l_orderkey, l_linenumber, CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS date_key FROM lineitem""")
def date_key(spark, sf_dir):
    from conformance.fixtures import read

    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", cal.date_key("l_shipdate").alias("date_key"))


@query("year_month", "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS year_month FROM orders")
def year_month(spark, sf_dir):
    from conformance.fixtures import read

    return read(spark, sf_dir, "orders").select("o_orderkey", cal.year_month("o_orderdate").alias("year_month"))


def _dates(spark, sf_dir):
    return dimensions.date_union_distinct(staging(spark, sf_dir))


@query("calendar_parts", """SELECT CAST(full_date AS VARCHAR) AS full_date, CAST(year(full_date) AS INTEGER) AS year,
    CAST(quarter(full_date) AS INTEGER) AS quarter, CAST(month(full_date) AS INTEGER) AS month, CAST(day(full_date) AS INTEGER) AS day,
    CAST(isodow(full_date) AS INTEGER) AS day_of_week, CAST(weekofyear(full_date) AS INTEGER) AS week_of_year FROM source_dates""")
def calendar_parts(spark, sf_dir):
    return _dates(spark, sf_dir).withColumns(cal.calendar_parts("full_date"))


@query("calendar_names", """SELECT CAST(full_date AS VARCHAR) AS full_date, monthname(full_date) AS month_name,
    dayname(full_date) AS day_name FROM source_dates""")
def calendar_names(spark, sf_dir):
    return _dates(spark, sf_dir).withColumns(cal.calendar_names("full_date"))


@query("weekend_flag", "SELECT CAST(full_date AS VARCHAR) AS full_date, isodow(full_date) >= 6 AS is_weekend, FALSE AS is_holiday FROM source_dates")
def weekend_flag(spark, sf_dir):
    return _dates(spark, sf_dir).withColumns({"is_weekend": cal.is_weekend("full_date"), "is_holiday": F.lit(False)})


@query("fiscal_calendar", "SELECT CAST(full_date AS VARCHAR) AS full_date, fiscal_year, fiscal_quarter FROM dim_date")
def fiscal_calendar(spark, sf_dir):
    return _dates(spark, sf_dir).withColumns(
        {"fiscal_year": cal.fiscal_year("full_date"), "fiscal_quarter": cal.fiscal_quarter("full_date")}
    )


def _times(spark, sf_dir):
    times = dimensions.ORDER_TIMES
    orders = staging(spark, sf_dir)["stg_orders"]
    return orders.select("order_id", "order_status", *[text.parse_timestamp(c).alias(c) for c in times])


def _filled(spark, sf_dir):
    return _times(spark, sf_dir).withColumns(retail.fill_lifecycle(*dimensions.ORDER_TIMES))


@query("impute_lifecycle_timestamps", """SELECT order_id, order_status, CAST(purchased AS VARCHAR) AS order_purchase_timestamp,
    CAST(approved AS VARCHAR) AS order_approved_at, CAST(carried AS VARCHAR) AS order_delivered_carrier_date,
    CAST(delivered AS VARCHAR) AS order_delivered_customer_date, CAST(estimated AS VARCHAR) AS order_estimated_delivery_date
    FROM order_filled""")
def impute_lifecycle_timestamps(spark, sf_dir):
    return _filled(spark, sf_dir)


@query("approval_delay_hours", f"SELECT order_id, {trunc_hours('approved', 'purchased')} AS hours FROM order_filled")
def approval_delay_hours(spark, sf_dir):
    return _filled(spark, sf_dir).select(
        "order_id", cal.elapsed_hours("order_approved_at", "order_purchase_timestamp").alias("hours")
    )


# Shipping dates often precede the order date here, so these differences are negative.
@query("approval_delay_hours_floor", """SELECT l_orderkey, l_linenumber, l_partkey,
    CAST(floor(epoch(l_shipdate + to_minutes(l_linenumber * 7) - o_orderdate) / 3600) AS INTEGER) AS hours_floor,
    CAST(trunc(epoch(l_shipdate + to_minutes(l_linenumber * 7) - o_orderdate) / 3600) AS INTEGER) AS hours_truncated
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def approval_delay_hours_floor(spark, sf_dir):
    lines = _shipped(spark, sf_dir)
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        cal.elapsed_hours("shipped", "o_orderdate", "floor").alias("hours_floor"),
        cal.elapsed_hours("shipped", "o_orderdate").alias("hours_truncated"),
    )


def _shipped(spark, sf_dir):
    from conformance.fixtures import read

    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    later = F.make_dt_interval(F.lit(0), F.lit(0), F.col("l_linenumber").cast("int") * 7)
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).withColumn("shipped", F.col("l_shipdate") + later)


@query("delivery_days", f"""SELECT order_id, {floor_days('delivered', 'estimated')} AS delay, {floor_days('delivered', 'purchased')} AS total
    FROM order_filled""")
def delivery_days(spark, sf_dir):
    return _filled(spark, sf_dir).select(
        "order_id",
        cal.elapsed_days("order_delivered_customer_date", "order_estimated_delivery_date").alias("delay"),
        cal.elapsed_days("order_delivered_customer_date", "order_purchase_timestamp").alias("total"),
    )


@query("delivery_days_calendar", """SELECT order_id,
    COALESCE(CAST(CAST(delivered AS DATE) - CAST(estimated AS DATE) AS INTEGER), 0) AS delay,
    COALESCE(CAST(CAST(delivered AS DATE) - CAST(purchased AS DATE) AS INTEGER), 0) AS total FROM order_times""")
def delivery_days_calendar(spark, sf_dir):
    return _times(spark, sf_dir).select(
        "order_id",
        cal.elapsed_days("order_delivered_customer_date", "order_estimated_delivery_date", "calendar").alias("delay"),
        cal.elapsed_days("order_delivered_customer_date", "order_purchase_timestamp", "calendar").alias("total"),
    )


def _delays(spark, sf_dir):
    known = F.col("order_delivered_customer_date").isNotNull() & F.col("order_estimated_delivery_date").isNotNull()
    return _times(spark, sf_dir).select(
        "order_id", cal.elapsed_days("order_delivered_customer_date", "order_estimated_delivery_date").alias("delay"), known.alias("known")
    )


_DELAYS = f"""(SELECT order_id, {floor_days('delivered', 'estimated')} AS delay,
    delivered IS NOT NULL AND estimated IS NOT NULL AS known FROM order_times)"""


@query("on_time_flag", f"SELECT order_id, delay <= 0 AS on_time, known AND delay <= 0 AS on_time_known FROM {_DELAYS}")
def on_time_flag(spark, sf_dir):
    return _delays(spark, sf_dir).select(
        "order_id", retail.on_time("delay").alias("on_time"), retail.on_time("delay", F.col("known")).alias("on_time_known")
    )


@query("delivery_category", f"""SELECT order_id, {delay_class('delay')} AS category,
    CASE WHEN known THEN {delay_class('delay')} ELSE 'Unknown' END AS category_known FROM {_DELAYS}""")
def delivery_category(spark, sf_dir):
    return _delays(spark, sf_dir).select(
        "order_id", retail.delivery_category("delay").alias("category"),
        retail.delivery_category("delay", F.col("known")).alias("category_known"),
    )


@query("review_category", """SELECT review_id, order_id, CASE WHEN review_score <= 2 THEN 'Poor' WHEN review_score = 3 THEN 'Fair'
    WHEN review_score = 4 THEN 'Good' WHEN review_score = 5 THEN 'Excellent' ELSE 'Unknown' END AS category FROM stg_reviews""")
def review_category(spark, sf_dir):
    return staging(spark, sf_dir)["stg_reviews"].select(
        "review_id", "order_id", retail.review_category("review_score").alias("category")
    )


@query("response_hours", f"""SELECT review_id, order_id, {trunc_hours(stamp('review_answer_timestamp'), stamp('review_creation_date'))} AS hours
    FROM stg_reviews""")
def response_hours(spark, sf_dir):
    reviews = staging(spark, sf_dir)["stg_reviews"]
    answered, created = text.parse_timestamp("review_answer_timestamp"), text.parse_timestamp("review_creation_date")
    return reviews.select("review_id", "order_id", cal.elapsed_hours(answered, created).alias("hours"))


@query("item_total", """SELECT order_id, order_item_id, product_id, CAST(CAST(price + freight_value AS DECIMAL(10,2)) AS DOUBLE) AS total
    FROM stg_order_items""")
def item_total(spark, sf_dir):
    return staging(spark, sf_dir)["stg_order_items"].select(
        "order_id", "order_item_id", "product_id", retail.item_total("price", "freight_value").alias("total")
    )


@query("safe_ratio", """SELECT product_id, CASE WHEN w > 0 THEN CAST(l AS DOUBLE) / w ELSE 0.0 END AS ratio,
    CASE WHEN p > 0 THEN CAST(l AS DOUBLE) / p ELSE 0.0 END AS ratio_zero
    FROM (SELECT product_id, CAST(product_description_lenght AS INTEGER) AS l, CAST(product_width_cm AS INTEGER) AS w,
                 CAST(product_photos_qty AS INTEGER) AS p FROM stg_products)""")
def safe_ratio(spark, sf_dir):
    products = staging(spark, sf_dir)["stg_products"]
    length, width, photos = (F.col(f"product_{c}").cast("int") for c in ("description_lenght", "width_cm", "photos_qty"))
    return products.select(
        "product_id", retail.safe_ratio(length, width).alias("ratio"), retail.safe_ratio(length, photos).alias("ratio_zero")
    )


@query("zero_to_null", "SELECT product_id, NULLIF(CAST(product_photos_qty AS INTEGER), 0) AS photos FROM stg_products")
def zero_to_null(spark, sf_dir):
    return staging(spark, sf_dir)["stg_products"].select(
        "product_id", retail.zero_to_null(F.col("product_photos_qty").cast("int")).alias("photos")
    )


@query("scd2_columns", "SELECT product_id, '2999-12-31 00:00:00' AS effective_end_date, TRUE AS is_current FROM stg_products")
def scd2_columns(spark, sf_dir):
    return staging(spark, sf_dir)["stg_products"].select("product_id").withColumns(dimensions.version_columns())


@query("audit_columns", "SELECT seller_id, TRUE AS is_active, TRUE AS in_order FROM stg_sellers")
def audit_columns(spark, sf_dir):
    rows = staging(spark, sf_dir)["stg_sellers"].withColumns({**dimensions.audit("created_date", "updated_date"), "is_active": F.lit(True)})
    return rows.select("seller_id", "is_active", (F.col("created_date") <= F.col("updated_date")).alias("in_order"))


@query("month_label", "SELECT year_month, strftime(make_date(year, month, 1), '%Y-%m') AS label FROM agg_monthly_sales")
def month_label(spark, sf_dir):
    return star(spark, sf_dir)["agg_monthly_sales"].select("year_month", cal.month_label("year", "month").alias("label"))


@query("freight_pct", """SELECT year_month, round(CAST(total_freight AS DOUBLE) / CAST(total_revenue AS DOUBLE) * 100, 2) AS freight_pct
    FROM agg_monthly_sales""")
def freight_pct(spark, sf_dir):
    return star(spark, sf_dir)["agg_monthly_sales"].select(
        "year_month", retail.freight_percent("total_freight", "total_revenue").alias("freight_pct")
    )


@query("revenue_per_order", """SELECT product_sk, CAST(last_12_months_revenue AS DOUBLE) / (last_12_months_orders + 1) AS revenue_per_order
    FROM agg_product_performance""")
def revenue_per_order(spark, sf_dir):
    return star(spark, sf_dir)["agg_product_performance"].select(
        "product_sk", retail.revenue_per_order("last_12_months_revenue", "last_12_months_orders").alias("revenue_per_order")
    )


@query("percent_of_total", """SELECT order_status, CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () * 100 AS pct FROM stg_orders GROUP BY order_status""")
def percent_of_total(spark, sf_dir):
    orders = staging(spark, sf_dir)["stg_orders"]
    total = orders.agg(F.count(F.lit(1))).scalar()
    return orders.groupBy("order_status").agg(F.count(F.lit(1)).alias("n")).select(
        "order_status", retail.percent("n", total).alias("pct")
    )


@query("display_format", """SELECT order_id, order_item_id, product_id, 'R$ ' || format('{:,.2f}', CAST(price AS DOUBLE)) AS price
    FROM stg_order_items""")
def display_format(spark, sf_dir):
    return staging(spark, sf_dir)["stg_order_items"].select(
        "order_id", "order_item_id", "product_id", text.money_text("price").alias("price")
    )


@query("review_decimal", "SELECT review_id, order_id, CAST(CAST(review_score AS DECIMAL(3,2)) AS DOUBLE) AS score FROM stg_reviews")
def review_decimal(spark, sf_dir):
    return staging(spark, sf_dir)["stg_reviews"].select(
        "review_id", "order_id", retail.review_decimal("review_score").alias("score")
    )


# SQL functions


@query("sql_function_region", f"SELECT customer_id, {region('upper(trim(customer_state))')} AS region FROM stg_customers")
def sql_function_region(spark, sf_dir):
    retail.register_sql_functions(spark)
    staging(spark, sf_dir)["stg_customers"].createOrReplaceTempView("stg_customers")
    return spark.sql("SELECT customer_id, get_brazilian_region(upper(trim(customer_state))) AS region FROM stg_customers")


@query("sql_function_size", f"""SELECT product_id, CASE WHEN {_STRICT} IS NULL THEN 'Unknown' ELSE {size_class(_STRICT)} END AS size
    FROM stg_products""")
def sql_function_size(spark, sf_dir):
    retail.register_sql_functions(spark)
    staging(spark, sf_dir)["stg_products"].createOrReplaceTempView("stg_products")
    return spark.sql(
        "SELECT product_id, get_product_size_category(CAST(nullif(product_length_cm, 'NaN') AS DOUBLE), "
        "CAST(product_height_cm AS DOUBLE), CAST(product_width_cm AS DOUBLE)) AS size FROM stg_products"
    )
