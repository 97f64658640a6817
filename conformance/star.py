"""Staging and star schema of a test folder, for the queries of a session.

Tables of the star and the staging tables they read several times are written once. The others are derived where they are read, so a
query that needs three columns of the items makes no copy of them and hashes no row.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from conformance.fixtures import STAGING, read_spread
from tradewind.plans.dimensions import with_hash
from tradewind.plans.warehouse import STEPS, build_table
from tradewind.session import run_folder, shared_folder
from tradewind.sources.sinks import folder_sink

# Large staging tables that one build each reads.
DERIVED = {"stg_order_items", "stg_payments", "stg_reviews"}


class Star:
    """Tables by name; each is written to the shared folder when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.tables: dict[str, DataFrame] = {}
        self.sink = folder_sink(f"{shared_folder(spark)}/star-{uuid.uuid4().hex}")

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.tables:
            if name in STAGING:
                rows = with_hash(STAGING[name](self.spark, self.sf_dir, read_spread))
                self.tables[name] = rows if name in DERIVED else self.sink("staging", name, rows)[0]
            else:
                layer = next(layer for layer, names in STEPS.items() if name in names)
                # What the build of a table writes on the way goes with the build.
                with run_folder(self.spark):
                    self.tables[name], _ = self.sink(layer, name, build_table(name, self))
        return self.tables[name]


_stars: dict[tuple[str, str], Star] = {}


def star(spark: SparkSession, sf_dir: str) -> Star:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stars:
        _stars[key] = Star(spark, sf_dir)
    return _stars[key]
