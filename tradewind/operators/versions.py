"""Slowly changing dimensions: overwrite (type 1) and versioned rows (type 2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions import retail


def scd1_apply(current: DataFrame, incoming: DataFrame, key: str, hash_column: str = "record_hash") -> DataFrame:
    """Overwrite changed rows, add new ones, keep the rest.

    A row whose hash is unchanged keeps its stored values, audit times included.
    """
    columns = current.columns
    changed = F.col(f"c.{key}").isNull() | ~F.col(f"c.{hash_column}").eqNullSafe(F.col(f"i.{hash_column}"))
    use_incoming = F.col(f"i.{key}").isNotNull() & changed
    both = current.alias("c").join(incoming.alias("i"), F.col(f"c.{key}") == F.col(f"i.{key}"), "full_outer")
    created = {"created_date"} & set(columns)

    def pick(name: str) -> Column:
        if name in created:
            return F.coalesce(F.col(f"c.{name}"), F.col(f"i.{name}"))
        if name not in incoming.columns:
            return F.col(f"c.{name}")
        return F.when(use_incoming, F.col(f"i.{name}")).otherwise(F.col(f"c.{name}"))

    return both.select(*[pick(c).alias(c) for c in columns])


def scd2_apply(
    history: DataFrame, incoming: DataFrame, key: str, as_of: Column, hash_column: str = "record_hash"
) -> DataFrame:
    """Close changed versions and open new ones.

    ``history`` holds all versions with their validity window; ``incoming`` the
    business columns, key and hash of the present state. A key that is absent
    from ``incoming`` stays as it is. Expired versions are passed through.
    """
    business = [c for c in incoming.columns if c != key]
    current, expired = history.where("is_current"), history.where(~F.col("is_current"))
    both = current.alias("c").join(incoming.alias("i"), F.col(f"c.{key}") == F.col(f"i.{key}"), "full_outer")
    is_known, is_seen = F.col(f"c.{key}").isNotNull(), F.col(f"i.{key}").isNotNull()
    differs = is_known & is_seen & ~F.col(f"c.{hash_column}").eqNullSafe(F.col(f"i.{hash_column}"))

    stored = {c: F.col(f"c.{c}") for c in history.columns}
    closed = {**stored, "effective_end_date": as_of, "is_current": F.lit(False)}
    opened = {
        **{c: F.col(f"i.{c}") for c in [key, *business]},
        "effective_start_date": as_of,
        "effective_end_date": F.lit(retail.OPEN_END).cast("timestamp_ntz"),
        "is_current": F.lit(True),
    }

    def version(values: dict[str, Column]) -> Column:
        return F.struct(*[values[f.name].cast(f.dataType).alias(f.name) for f in history.schema])

    rows = F.array_compact(
        F.array(
            F.when(is_known & ~differs, version(stored)),
            F.when(differs, version(closed)),
            F.when(is_seen & (~is_known | differs), version(opened)),
        )
    )
    # inline turns one joined row into the one or two versions it leads to.
    return both.select(F.inline(rows)).unionByName(expired)
