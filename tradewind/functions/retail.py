"""Business expressions: regions, sizes, delivery, reviews, money."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tradewind.functions.calendar import days, hours
from tradewind.functions.text import UNKNOWN, as_column

# State codes of each region.
REGION_STATES = {
    "Norte": ["AC", "AM", "AP", "PA", "RO", "RR", "TO"],
    "Nordeste": ["AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"],
    "Centro-Oeste": ["DF", "GO", "MS", "MT"],
    "Sudeste": ["ES", "MG", "RJ", "SP"],
    "Sul": ["PR", "RS", "SC"],
}

# Upper volume bound (cm³, inclusive) of each size class.
SIZE_BOUNDS = [(1000, "Small"), (10000, "Medium"), (50000, "Large")]
SIZE_ABOVE = "Extra Large"

# Delivery classes by delay in days.
EARLY_BELOW = -5
DELIVERY_BOUNDS = [(0, "On Time"), (5, "Slightly Late")]
DELIVERY_EARLY = "Early"
DELIVERY_ABOVE = "Very Late"

# Review classes by score.
REVIEW_POOR_UP_TO = 2
REVIEW_CLASSES = {3: "Fair", 4: "Good", 5: "Excellent"}
REVIEW_POOR = "Poor"

# Offsets used to fill missing order timestamps.
FALLBACK_PURCHASE = datetime(2018, 1, 1)
APPROVED_AFTER_HOURS = 2
CARRIER_AFTER_DAYS = 2
DELIVERED_AFTER_DAYS = 10
ESTIMATED_AFTER_DAYS = 15

# Fixed value: end of validity of a current dimension version.
OPEN_END = datetime(2999, 12, 31)


def state_region(state: Column | str) -> Column:
    state = as_column(state)
    branches = [(state.isin(codes), region) for region, codes in REGION_STATES.items()]
    return _first_match(branches, UNKNOWN)


def product_volume(length: Column | str, height: Column | str, width: Column | str) -> Column:
    """Product of three sizes; a missing size counts as 0."""
    zero = F.lit(0)
    a, b, c = (F.coalesce(as_column(x), zero) for x in (length, height, width))
    return a * b * c


def size_category(volume: Column | str) -> Column:
    volume = F.coalesce(as_column(volume), F.lit(0))
    return _first_match([(volume <= bound, name) for bound, name in SIZE_BOUNDS], SIZE_ABOVE)


def size_category_strict(length: Column | str, height: Column | str, width: Column | str) -> Column:
    """Like :func:`size_category`, but any missing size gives ``Unknown``."""
    volume = as_column(length) * as_column(height) * as_column(width)
    return F.when(volume.isNull(), F.lit(UNKNOWN)).otherwise(size_category(volume))


def fill_lifecycle(
    purchase: str, approved: str, carrier: str, delivered: str, estimated: str
) -> dict[str, Column]:
    """Fill missing order timestamps from the ones before them.

    The fallback purchase time only feeds the others: a missing purchase time
    itself stays missing. A missing delivery takes the *unfilled* estimate.
    """
    base = F.coalesce(F.col(purchase), F.lit(FALLBACK_PURCHASE).cast("timestamp_ntz"))
    filled_approved = F.coalesce(F.col(approved), base + hours(APPROVED_AFTER_HOURS))
    return {
        purchase: F.col(purchase),
        approved: filled_approved,
        carrier: F.coalesce(F.col(carrier), filled_approved + days(CARRIER_AFTER_DAYS)),
        delivered: F.coalesce(F.col(delivered), F.col(estimated), base + days(DELIVERED_AFTER_DAYS)),
        estimated: F.coalesce(F.col(estimated), base + days(ESTIMATED_AFTER_DAYS)),
    }


def delivery_category(delay: Column | str, known: Column | None = None) -> Column:
    """Class of a delay in days; ``Unknown`` where ``known`` is false."""
    delay = as_column(delay)
    branches = [(delay < EARLY_BELOW, DELIVERY_EARLY)]
    branches += [(delay <= bound, name) for bound, name in DELIVERY_BOUNDS]
    category = _first_match(branches, DELIVERY_ABOVE)
    return category if known is None else F.when(known, category).otherwise(F.lit(UNKNOWN))


def on_time(delay: Column | str, known: Column | None = None) -> Column:
    flag = as_column(delay) <= 0
    return flag if known is None else F.coalesce(known & flag, F.lit(False))


def review_category(score: Column | str) -> Column:
    score = as_column(score)
    branches = [(score <= REVIEW_POOR_UP_TO, REVIEW_POOR)]
    branches += [(score == value, name) for value, name in REVIEW_CLASSES.items()]
    return _first_match(branches, UNKNOWN)


def item_total(price: Column | str, freight: Column | str) -> Column:
    zero = F.lit(0).cast("decimal(10,2)")
    return (F.coalesce(as_column(price), zero) + F.coalesce(as_column(freight), zero)).cast("decimal(10,2)")


def safe_ratio(part: Column | str, whole: Column | str, to: str | None = None) -> Column:
    """``part / whole``, 0 when the denominator is not positive."""
    part, whole = as_column(part), as_column(whole)
    ratio = part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))
    if to:
        ratio = ratio.cast(to)
    return F.when(whole > 0, ratio).otherwise(F.lit(0).cast(to or "double"))


def zero_to_null(c: Column | str) -> Column:
    c = as_column(c)
    return F.when(c > 0, c)


def percent(part: Column | str, whole: Column | str) -> Column:
    return as_column(part).cast("double") / as_column(whole).cast("double") * 100


def freight_percent(freight: Column | str, revenue: Column | str) -> Column:
    """Freight as a share of revenue in percent, two decimals."""
    share = as_column(freight).cast("double") / F.nullif(as_column(revenue).cast("double"), F.lit(0.0)) * 100
    return F.round(share, 2)


def revenue_per_order(revenue: Column | str, orders: Column | str) -> Column:
    return as_column(revenue).cast("double") / (as_column(orders) + 1)


def review_decimal(score: Column | str) -> Column:
    return as_column(score).cast("decimal(3,2)")


def register_sql_functions(spark: SparkSession) -> None:
    """Make the region and size rules callable from SQL text."""
    region = "\n".join(
        f"WHEN state IN ({', '.join(repr(s) for s in codes)}) THEN '{name}'" for name, codes in REGION_STATES.items()
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION get_brazilian_region(state STRING) RETURNS STRING "
        f"RETURN CASE {region} ELSE '{UNKNOWN}' END"
    )
    volume = "length_cm * height_cm * width_cm"
    sizes = "\n".join(f"WHEN {volume} <= {bound} THEN '{name}'" for bound, name in SIZE_BOUNDS)
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION get_product_size_category("
        "length_cm DOUBLE, height_cm DOUBLE, width_cm DOUBLE) RETURNS STRING "
        f"RETURN CASE WHEN {volume} IS NULL THEN '{UNKNOWN}' {sizes} ELSE '{SIZE_ABOVE}' END"
    )


def _first_match(branches: list[tuple[Column, str]], otherwise: str) -> Column:
    condition, value = branches[0]
    chain = F.when(condition, F.lit(value))
    for condition, value in branches[1:]:
        chain = chain.when(condition, F.lit(value))
    return chain.otherwise(F.lit(otherwise))
