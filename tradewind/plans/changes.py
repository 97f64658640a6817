"""Loads that follow changes: a new delivery of the sources against the tables of the last load.

The difference of each staging table tells which natural keys changed. They are passed on: customers, products and sellers to the orders
that name them, orders to their items, payments and reviews, these to months and products of the marts. Only touched keys are built again,
by the same builds as in a whole load, and replace their rows; tables without a touched key are neither built nor written. The
result is what a whole load with the same key store gives, except for load times, which untouched rows keep.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.operators.keys import KeyStore
from tradewind.plans import marts, warehouse
from tradewind.session import configure, materialize, run_folder
from tradewind.sources.schemas import STAGING

# The key by which rows of a staging table are told to have changed.
SOURCE_KEY = {
    "stg_customers": "customer_id", "stg_products": "product_id", "stg_sellers": "seller_id", "stg_orders": "order_id",
    "stg_order_items": "order_id", "stg_payments": "order_id", "stg_reviews": "review_id", "stg_product_categories": "product_category_name",
}

_KEY = "_key"


def changed_keys(before: DataFrame, after: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Keys (``_key``) whose rows are not the same ones as often; a null key is a key.

    Rows are compared by a digest of ``columns`` that are there, told apart by name, so a missing column equals one of nulls. Counts are
    reduced before the shuffle: a key on a third of the rows is one row a digest.
    """

    def digests(df: DataFrame, sign: int) -> DataFrame:
        there = [c for c in columns if c in df.columns]
        return df.select(F.col(key).alias(_KEY), F.md5(F.to_json(F.struct(*sorted(there)))).alias("digest"), F.lit(sign).alias("n"))

    counts = digests(before, -1).union(digests(after, 1)).groupBy(_KEY, "digest").agg(F.sum("n").alias("n"))
    return counts.where("n <> 0").select(_KEY).distinct()


def of_keys(rows: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    return rows.join(keys, F.col(column).eqNullSafe(F.col(_KEY)), "left_semi")


def without_keys(rows: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    return rows.join(keys, F.col(column).eqNullSafe(F.col(_KEY)), "left_anti")


def _keys(*parts: tuple[DataFrame, str]) -> DataFrame:
    """The distinct values of columns of several tables as one written list of keys."""
    return materialize(reduce(DataFrame.union, [df.select(F.col(c).alias(_KEY)) for df, c in parts]).distinct(), "keys")


def _in_months(months: list[int], date_key: Column) -> Column:
    """A condition on the plain column, so that the scan skips files and row groups of other months."""
    return reduce(Column.__or__, [date_key.between(m * 100, m * 100 + 99) for m in months], F.lit(False))


class Changes:
    """One load. ``stored`` are the tables of the last one by (layer, table), ``tables`` those of this one by name."""

    def __init__(self, stored: dict[tuple[str, str], DataFrame], sink: Callable[[str, str, DataFrame], tuple[DataFrame, int]], keys: KeyStore):
        self.stored, self.sink, self.keys = stored, sink, keys
        self.tables: dict[str, DataFrame] = {}
        self.summary: list[tuple[str, str, int, str]] = []

    def before(self, table: str) -> DataFrame:
        return next(df for (layer, name), df in self.stored.items() if name == table and layer != "rejected")

    def both(self, table: str, keys: DataFrame, column: str) -> DataFrame:
        """Rows of the keys as they were and as they are."""
        names = [c for c in self.before(table).columns if c in self.tables[table].columns]
        return of_keys(self.before(table).select(*names), keys, column).union(of_keys(self.tables[table].select(*names), keys, column))

    def keep(self, layer: str, table: str) -> None:
        self.tables[table] = self.stored[layer, table]
        self.summary.append((layer, table, 0, "unchanged"))

    def put(self, layer: str, table: str, rows: DataFrame, built: int) -> None:
        self.tables[table], _ = self.sink(layer, table, rows)
        self.summary.append((layer, table, built, "changed"))

    def source(self, table: str, rows: DataFrame) -> DataFrame:
        """Changed keys of a staging table; it is written only if there are any."""
        found = materialize(changed_keys(self.stored["staging", table], rows, SOURCE_KEY[table], STAGING[table].names), "changed")
        n = found.count()
        self.put("staging", table, rows, n) if n else self.keep("staging", table)
        return found

    def refresh(self, layer: str, table: str, column: str, touched: DataFrame, **inputs: DataFrame) -> None:
        """Build the touched keys of a table from ``inputs`` and the other tables, and put them in place of their rows."""
        if touched.isEmpty():
            self.keep(layer, table)
            return
        loaded, rejected = warehouse.split_table(table, self.tables | inputs, self.keys)
        loaded = materialize(loaded, table)
        before = self.stored.get(("rejected", table))
        if rejected is not None:
            kept = rejected if before is None else without_keys(before, touched, column).unionByName(rejected)
            self.sink("rejected", table, kept)
        self.put(layer, table, without_keys(self.stored[layer, table], touched, column).unionByName(loaded), loaded.count())

    def renumbered(self, table: str, column: str, touched: DataFrame) -> DataFrame:
        """Those of the touched keys of a dimension that facts resolve in another way than before."""
        name = warehouse.KEYS[table][0]
        current = lambda df: of_keys(df.where("is_current") if "is_current" in df.columns else df, touched, column)
        return materialize(changed_keys(current(self.stored["dimensions", table]), current(self.tables[table]), column, [name]), "renumbered")


def run_changes(
    spark: SparkSession,
    stored: dict[tuple[str, str], DataFrame],
    staging: dict[str, DataFrame],
    sink: Callable[[str, str, DataFrame], tuple[DataFrame, int]],
    keys: KeyStore,
    refused: dict[str, DataFrame] | None = None,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Tables after a new delivery, and a summary (layer, table_name, built, status) with the number of rows or keys that were built.

    ``stored`` holds the last load as ``publication.published`` gives it, ``staging`` every source table as it is now, ``keys`` the store
    that the last load used. ``sink`` must leave the tables of the last load readable, as ``publication.Publication`` does. A row that
    is gone from the sources goes from the warehouse; an equal delivery changes nothing. A natural key without a value is one key.
    ``refused`` holds records of this delivery that could not be read; they replace those of the last one.
    """
    configure(spark)
    load = Changes(stored, sink, keys)
    with run_folder(spark):
        changed = {table: load.source(table, staging[table]) for table in STAGING}
        for table, records in (refused or {}).items():
            sink("rejected", table, records)
        if any(not changed[t].isEmpty() for t in ("stg_orders", "stg_order_items", "stg_reviews")):
            dates = materialize(warehouse.split_table("dim_date", load.tables, keys)[0], "dates")
            load.put("dimensions", "dim_date", dates, dates.count())
        else:
            load.keep("dimensions", "dim_date")
        t = load.tables

        translated = load.both("stg_products", changed["stg_product_categories"], "product_category_name")
        touched = {
            "dim_customer": changed["stg_customers"], "dim_seller": changed["stg_sellers"], "dim_order_status": changed["stg_orders"],
            "dim_product": _keys((changed["stg_products"], _KEY), (translated, "product_id")),
        }
        resolved = {}
        for table, source in (
            ("dim_customer", "stg_customers"), ("dim_product", "stg_products"), ("dim_seller", "stg_sellers"), ("dim_order_status", "stg_orders")
        ):
            column = warehouse.KEYS[table][1][0]
            load.refresh("dimensions", table, column, touched[table], **{source: of_keys(t[source], touched[table], column)})
            resolved[table] = load.renumbered(table, column, touched[table])

        moved = _keys((changed["stg_orders"], _KEY), (load.both("stg_orders", resolved["dim_customer"], "customer_id"), "order_id"))
        items = _keys(
            (moved, _KEY), (changed["stg_order_items"], _KEY),
            (load.both("stg_order_items", resolved["dim_product"], "product_id"), "order_id"),
            (load.both("stg_order_items", resolved["dim_seller"], "seller_id"), "order_id"),
        )
        load.refresh(
            "facts", "fact_order_items", "order_id", items,
            stg_order_items=of_keys(t["stg_order_items"], items, "order_id"), stg_orders=of_keys(t["stg_orders"], items, "order_id"),
        )
        payments = _keys((changed["stg_payments"], _KEY), (changed["stg_orders"], _KEY))
        load.refresh(
            "facts", "fact_payments", "order_id", payments,
            stg_payments=of_keys(t["stg_payments"], payments, "order_id"), stg_orders=of_keys(t["stg_orders"], payments, "order_id"),
        )
        # A review may stand on several orders, of which the latest counts: all its rows are taken again.
        reviews = _keys((changed["stg_reviews"], _KEY), (load.both("stg_reviews", moved, "order_id"), "review_id"))
        written = of_keys(t["stg_reviews"], reviews, "review_id")
        load.refresh(
            "facts", "fact_reviews", "review_id", reviews,
            stg_reviews=written, stg_orders=of_keys(t["stg_orders"], _keys((written, "order_id")), "order_id"),
        )
        _monthly(load, items, touched["dim_customer"])
        _products(load, items, reviews, resolved["dim_product"])
    return load.tables, spark.createDataFrame(load.summary, "layer string, table_name string, built long, status string")


def _monthly(load: Changes, items: DataFrame, customers: DataFrame) -> None:
    """Months of touched items, and of customers that moved to another state, are counted again from the items of these months."""
    t, table = load.tables, "agg_monthly_sales"
    old, new = (of_keys(df, customers, "customer_id") for df in (load.stored["dimensions", "dim_customer"], t["dim_customer"]))
    elsewhere = materialize(changed_keys(old, new, "customer_sk", ["customer_state"]), "elsewhere")
    dates = _keys(
        (load.both("fact_order_items", items, "order_id"), "order_date_key"), (of_keys(t["fact_order_items"], elsewhere, "customer_sk"), "order_date_key")
    )
    # As many as the calendar has months.
    months = [r[0] for r in dates.where(F.col(_KEY).isNotNull()).select(F.floor(F.col(_KEY) / 100).cast("int").alias("m")).distinct().collect()]
    if not months:
        load.keep("marts", table)
        return
    again = marts.monthly_sales(t["fact_order_items"].where(_in_months(months, F.col("order_date_key"))), t["dim_date"], t["dim_customer"])
    again = materialize(again, table)
    load.put("marts", table, load.stored["marts", table].where(~F.col("year_month").isin(months)).unionByName(again), again.count())


def _products(load: Changes, items: DataFrame, reviews: DataFrame, products: DataFrame) -> None:
    """Products of touched items and of orders with touched reviews are measured again; ranks are given anew to all."""
    t, table = load.tables, "agg_product_performance"
    scored = _keys((load.both("fact_reviews", reviews, "review_id"), "order_id"))
    touched = _keys(
        (load.both("fact_order_items", items, "order_id"), "product_sk"), (of_keys(t["fact_order_items"], scored, "order_id"), "product_sk"),
        (load.both("dim_product", products, "product_id"), "product_sk"),
    )
    if touched.isEmpty():
        load.keep("marts", table)
        return
    sold = materialize(of_keys(t["fact_order_items"], touched, "product_sk"), "sold")
    rated = of_keys(t["fact_reviews"], _keys((sold, "order_id")), "order_id")
    again = materialize(marts.product_metrics(of_keys(t["dim_product"], touched, "product_sk"), sold, rated), "again")
    kept = without_keys(load.stored["marts", table], touched, "product_sk").select(*again.columns)
    load.put("marts", table, marts.ranked_products(kept.unionByName(again)), again.count())
