"""Text, token and permissive-parse expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for "no value" in the sources.
MISSING_TOKENS = ["", "NaN"]

# Fixed value: default for a missing category, city or state.
UNKNOWN = "Unknown"

_WORDS = r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def has_value(c: Column | str) -> Column:
    """True when a text is present and is not a missing-value token."""
    c = as_column(c)
    return c.isNotNull() & ~c.isin(MISSING_TOKENS)


def null_tokens(c: Column | str) -> Column:
    """Missing-value tokens become NULL."""
    c = as_column(c)
    return F.when(~c.isin(MISSING_TOKENS), c)


def parse_timestamp(c: Column | str) -> Column:
    """Text to zone-free timestamp; anything unparsable becomes NULL."""
    return null_tokens(c).try_cast("timestamp_ntz")


def parse_date(c: Column | str) -> Column:
    return parse_timestamp(c).cast("date")


def parse_number(c: Column | str, to: str = "double", default: object = 0) -> Column:
    """Text to number; bad text, NaN and NULL become ``default``."""
    value = null_tokens(as_column(c).cast("string")).try_cast(to)
    return F.coalesce(value, F.lit(default).cast(to))


def nan_to_default(c: Column | str, default: object = 0) -> Column:
    """Floating NaN and NULL become ``default``."""
    c = as_column(c)
    return F.coalesce(F.when(~F.isnan(c), c), F.lit(default).cast("double"))


def coalesce_default(*choices: Column | str, default: object = UNKNOWN) -> Column:
    """First non-null choice, else the default."""
    return F.coalesce(*[as_column(c) for c in choices], F.lit(default))


def capitalize_words(c: Column | str) -> Column:
    """Upper-case the first letter after every non-alphanumeric character.

    Spark's own ``initcap`` only starts a word after whitespace, so a hyphen or
    an apostrophe would not start one.
    """
    pieces = F.regexp_extract_all(F.lower(as_column(c)), F.lit(_WORDS), F.lit(1))
    return F.array_join(
        F.transform(pieces, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), w.substr(F.lit(2), F.length(w)))),
        "",
    )


def clean_city(c: Column | str) -> Column:
    return capitalize_words(F.trim(coalesce_default(c)))


def clean_state(c: Column | str) -> Column:
    return F.upper(F.trim(coalesce_default(c)))


def standard_name(name: str) -> str:
    """Header text to column name: trimmed, lower case, unquoted, underscored."""
    return name.strip().lower().replace('"', "").replace(" ", "_")


def record_hash(*columns: str, separator: str = "|") -> Column:
    """MD5 over the non-null values of the given business columns.

    Load metadata must not be passed in, otherwise the hash changes on every
    load. ``separator=''`` gives the plain concatenation.
    """
    return F.md5(F.concat_ws(separator, *[F.col(c).cast("string") for c in columns]))


def money_text(c: Column | str, prefix: str = "R$ ") -> Column:
    """Thousands separators, two decimals and a currency prefix."""
    return F.concat(F.lit(prefix), F.format_number(as_column(c), 2))


def rating_text(c: Column | str, prefix: str = "⭐ ") -> Column:
    return F.concat(F.lit(prefix), F.format_number(as_column(c), 2))


def count_text(c: Column | str) -> Column:
    return F.format_number(as_column(c), 0)
