"""Sources and sinks: every table is written, read back and compared with its derivation."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from conformance.fixtures import STAGING, read, staging
from conformance.registry import query
from conformance.star import star
from tradewind.functions import text
from tradewind.operators import relational
from tradewind.sources import files, publication, sinks
from tradewind.sources.schemas import SOURCE_FILES
from tradewind.session import shared_folder

# A blank field of a text file is a missing value.
_REVIEWS = "SELECT * REPLACE (NULLIF(review_answer_timestamp, '') AS review_answer_timestamp) FROM stg_reviews"


def folder(spark, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


@query("csv_scan", _REVIEWS)
def csv_scan(spark, sf_dir):
    """Texts with line breaks, quotes and missing values survive the file."""
    path = folder(spark, "csv")
    reviews = staging(spark, sf_dir)["stg_reviews"]
    sinks.csv_export(reviews, path)
    return files.typed_staging(files.csv_scan(spark, path, reviews.columns), "stg_reviews")


def _written_sources(spark, sf_dir) -> str:
    path = folder(spark, "sources")
    tables = staging(spark, sf_dir)
    for table, name in SOURCE_FILES.items():
        sinks.csv_export(tables[table], f"{path}/shop_{name}")
    return path


_COUNTS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in SOURCE_FILES
)


@query("source_catalog", _COUNTS)
def source_catalog(spark, sf_dir):
    path = _written_sources(spark, sf_dir)
    loaded = dict(files.source_catalog(spark, path, prefix="shop_"))
    counts = relational.table_counts(loaded, {t: "staging" for t in loaded})
    return counts.select("table_name", F.col("row_count").alias("n"))


_DAMAGED = """SELECT *, CASE WHEN CAST(order_id AS BIGINT) % 7 = 3 THEN 'ragged' WHEN CAST(order_id AS BIGINT) % 11 = 5 THEN 'unreadable:price' ELSE '' END AS problem
    FROM stg_order_items"""


def _damaged_items(spark, sf_dir) -> str:
    """Items as CSV lines: some lack their last values, some have a price that is none."""
    path, items = folder(spark, "damaged"), staging(spark, sf_dir)["stg_order_items"]
    sinks.csv_export(items, path)
    header = ",".join(items.columns)
    lines = spark.read.text(path).where(F.col("value") != header)
    number = F.split("value", ",")[0].try_cast("bigint")
    short = F.regexp_replace("value", ",[^,]*,[^,]*$", "")
    words = F.regexp_replace("value", ",[^,]*(,[^,]*)$", ",ten$1")
    out = F.when(number % 7 == 3, short).when(number % 11 == 5, words).otherwise(F.col("value"))
    # Each line is one value below the header: a large file is read in splits and becomes several files, of which each needs one.
    plain = {"header": True, "quote": "", "sep": "\x01", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    lines.select(out.alias(header)).write.options(**plain).csv(f"{path}-lines")
    return f"{path}-lines"


@query("rejected_records", f"""SELECT problem, count(*) AS n FROM ({_DAMAGED}) WHERE problem <> '' GROUP BY problem
    UNION ALL SELECT 'staged', count(*) FROM ({_DAMAGED}) WHERE problem = ''""")
def rejected_records(spark, sf_dir):
    """Rows of the files are staged rows and rejected ones, by what is wrong with them."""
    staged, rejected = files.staged_records(spark, _damaged_items(spark, sf_dir), "stg_order_items")
    problems = rejected.groupBy("problem").agg(F.count(F.lit(1)).alias("n"))
    return problems.union(staged.agg(F.lit("staged"), F.count(F.lit(1))))


@query("standardize_columns", "SELECT s_suppkey AS supplier_key, s_name AS supplier_name, s_acctbal AS account_balance FROM supplier")
def standardize_columns(spark, sf_dir):
    supplier = read(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    return files.standardize_columns(supplier.toDF(" Supplier Key", '"SUPPLIER name"', "account balance "))


@query("load_metadata", "SELECT customer_id, 'customers_dataset.csv' AS source_file, record_hash FROM customer_rows")
def load_metadata(spark, sf_dir):
    customers = staging(spark, sf_dir)["stg_customers"]
    return files.with_load_metadata(customers, SOURCE_FILES["stg_customers"]).select("customer_id", "source_file", "record_hash")


@query("record_hash", """SELECT order_id, order_item_id, product_id,
    md5(concat_ws('|', order_id, CAST(order_item_id AS VARCHAR), product_id, seller_id, shipping_limit_date, CAST(price AS VARCHAR), CAST(freight_value AS VARCHAR))) AS separated,
    md5(concat(order_id, CAST(order_item_id AS VARCHAR), product_id, seller_id, shipping_limit_date, CAST(price AS VARCHAR), CAST(freight_value AS VARCHAR))) AS plain
    FROM stg_order_items""")
def record_hash(spark, sf_dir):
    items = staging(spark, sf_dir)["stg_order_items"]
    return items.select(
        "order_id", "order_item_id", "product_id", text.record_hash(*items.columns).alias("separated"),
        text.record_hash(*items.columns, separator="").alias("plain"),
    )


@query("coerce_schema", """SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS INTEGER) AS l_linenumber,
    CAST(CAST(l_quantity AS DECIMAL(15,2)) AS DOUBLE) AS l_quantity, CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS DOUBLE) AS l_extendedprice,
    CAST(CAST(l_discount AS DECIMAL(15,2)) AS DOUBLE) AS l_discount, CAST(CAST(l_tax AS DECIMAL(15,2)) AS DOUBLE) AS l_tax,
    l_returnflag, l_linestatus, CAST(l_shipdate AS VARCHAR) AS l_shipdate FROM lineitem""")
def coerce_schema(spark, sf_dir):
    return files.coerce_schema(read(spark, sf_dir, "lineitem"))


@query("table_scan", "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY l_returnflag")
def table_scan(spark, sf_dir):
    read(spark, sf_dir, "lineitem").createOrReplaceTempView("lineitem_scan")
    return files.table_scan(spark, "SELECT l_returnflag, count(*) AS n FROM lineitem_scan GROUP BY l_returnflag")


def _database(spark, layer: str) -> str:
    """A database of its own inside the shared folder."""
    name = f"t{uuid.uuid4().hex[:12]}_{layer}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{folder(spark, name)}'")
    return name


@query("overwrite_staging", "SELECT * FROM stg_sellers")
def overwrite_staging(spark, sf_dir):
    """The second write replaces rows and layout of the first."""
    database = _database(spark, "staging")
    tables = staging(spark, sf_dir)
    sinks.overwrite_staging(tables["stg_product_categories"], database, "stg_sellers")
    sinks.overwrite_staging(tables["stg_sellers"], database, "stg_sellers")
    return spark.table(f"{database}.stg_sellers")


@query("truncate_load", "SELECT *, TRUE AS is_active FROM dim_seller")
def truncate_load(spark, sf_dir):
    """Loading twice leaves one copy in the declared layout."""
    database = _database(spark, "dimensions")
    sellers = star(spark, sf_dir)["dim_seller"]
    for _ in range(2):
        sinks.truncate_load(sellers, database, "dim_seller")
    return spark.table(f"{database}.dim_seller")


@query("append_load", "SELECT seller_sk, seller_id FROM dim_seller")
def append_load(spark, sf_dir):
    """New keys are appended; a repeated load is refused."""
    database = _database(spark, "dimensions")
    sellers = star(spark, sf_dir)["dim_seller"].select("seller_sk", "seller_id")
    sinks.append_load(sellers, database, "dim_seller")
    try:
        sinks.append_load(sellers, database, "dim_seller")
    except ValueError:
        return spark.table(f"{database}.dim_seller")
    raise AssertionError("a repeated load was not refused")


@query("mart_load", "SELECT year_month, total_orders FROM agg_monthly_sales")
def mart_load(spark, sf_dir):
    database = _database(spark, "marts")
    mart = star(spark, sf_dir)["agg_monthly_sales"]
    for _ in range(2):
        sinks.mart_load(mart, database, "agg_monthly_sales")
    return spark.table(f"{database}.agg_monthly_sales").select("year_month", "total_orders")


@query("published_load", "SELECT *, TRUE AS is_active FROM dim_seller")
def published_load(spark, sf_dir):
    """A second load replaces the first in one step; a third one fails after it has written, and leaves the second whole."""
    path, name = folder(spark, "published"), f"t{uuid.uuid4().hex[:12]}_"
    spark.sql(f"CREATE DATABASE {name}dimensions LOCATION '{folder(spark, name)}'")
    sellers = star(spark, sf_dir)["dim_seller"]
    for rows in (sellers.where("seller_sk % 3 <> 0"), sellers):
        with publication.Publication(spark, path, name, catalogue=True) as sink:
            sink("dimensions", "dim_seller", rows)
    try:
        with publication.Publication(spark, path, name, catalogue=True) as sink:
            sink("dimensions", "dim_seller", sellers.unionAll(sellers))
    except ValueError:
        return spark.table(f"{name}dimensions.dim_seller")
    raise AssertionError("repeated keys were published")
