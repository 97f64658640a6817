"""Scans of source files and tables, and the metadata added on load."""

from __future__ import annotations

from collections.abc import Iterator

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions.text import has_value, record_hash, standard_name
from tradewind.sources.records import BAD, FILE, RECORD, csv_records
from tradewind.sources.schemas import SOURCE_FILES, STAGING

LOAD_COLUMNS = ["load_timestamp", "source_file", "record_hash"]

# Tables whose texts may hold line breaks.
FREE_TEXT_TABLES = {"stg_reviews"}

# Storage type by column kind (64-bit numbers keep their width).
_STORAGE_TYPES = [
    (T.LongType, "bigint"),
    (T.IntegralType, "int"),
    (T.FractionalType, "decimal(15,2)"),
    (T.TimestampType, "timestamp"),
    (T.TimestampNTZType, "timestamp_ntz"),
    (T.DateType, "timestamp_ntz"),
    (T.BooleanType, "boolean"),
]


def csv_scan(
    spark: SparkSession, path: str, columns: list[str] | None = None, multi_line: bool = True
) -> DataFrame:
    """Headered UTF-8 CSV read as text.

    With ``columns`` the layout is declared; without, only the header is looked
    at first. Large files are split between tasks, also where quoted values hold
    line breaks; ``multi_line=False`` says that none do, which spares the look at
    the quotes. A record with missing values is filled up with NULL, one with too
    many is cut; :func:`tradewind.sources.records.csv_records` tells them.
    """
    if multi_line:
        rows = csv_records(spark, path, columns)
        return rows.drop(FILE, RECORD, BAD)
    reader = spark.read.option("header", True).option("encoding", "UTF-8").option("escape", '"')
    if columns:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return reader.csv(path)


def standardize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[standard_name(c) for c in df.columns])


def with_load_metadata(df: DataFrame, source_file: str, separator: str = "|") -> DataFrame:
    """Add load time, source file name and the hash of the business columns."""
    return df.withColumns(
        {
            "load_timestamp": F.current_timestamp(),
            "source_file": F.lit(source_file),
            "record_hash": record_hash(*df.columns, separator=separator),
        }
    )


def coerce_schema(df: DataFrame) -> DataFrame:
    """Storage type per column kind; everything else is stored as text."""
    return df.select(*[F.col(f.name).cast(_storage_type(f.dataType)).alias(f.name) for f in df.schema])


def _storage_type(kind: T.DataType) -> str:
    return next((name for cls, name in _STORAGE_TYPES if isinstance(kind, cls)), "string")


def typed_staging(df: DataFrame, table: str) -> DataFrame:
    """Text columns to the declared staging types; unreadable values become NULL."""
    return df.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in STAGING[table]],
        *[c for c in df.columns if c in LOAD_COLUMNS],
    )


def table_scan(spark: SparkSession, query: str) -> DataFrame:
    """A table by name, or the rows of a SELECT."""
    return spark.sql(query) if " " in query.strip() else spark.table(query)


def source_path(folder: str, table: str, prefix: str = "", files: dict[str, str] | None = None) -> str:
    name = (files or {}).get(table, prefix + SOURCE_FILES[table])
    return f"{folder.rstrip('/')}/{name}"


def staged_records(spark: SparkSession, path: str, table: str) -> tuple[DataFrame, DataFrame]:
    """The records of a source in its staging types with load metadata, and those that can not be staged.

    A record is rejected as ``ragged`` if it has another number of values than the header, or an unclosed quote, and as
    ``unreadable:<column>`` if a value that is there can not be read in its declared type. Rejected rows are (source_file, record_number,
    problem, record): the file, the number of the record in it from 1, and its text. Every record is in one of the two.
    """
    raw = csv_records(spark, path)
    columns = [c for c in raw.columns if c not in (FILE, RECORD, BAD)]
    raw = raw.toDF(*[standard_name(c) for c in columns], FILE, RECORD, BAD)
    typed = [f for f in STAGING[table] if not isinstance(f.dataType, T.StringType)]
    unread = [F.when(has_value(f.name) & F.col(f.name).try_cast(f.dataType).isNull(), F.lit(f"unreadable:{f.name}")) for f in typed]
    problem = F.when(F.col(BAD).isNotNull(), F.lit("ragged")).otherwise(F.concat_ws(",", *unread) if unread else F.lit(""))
    told = raw.withColumn("_problem", problem)
    plain = told.where("_problem = ''").select(*[standard_name(c) for c in columns])
    staged = typed_staging(with_load_metadata(plain, path.rsplit("/", 1)[1]), table)
    text = F.coalesce(F.col(BAD), F.to_csv(F.struct(*[F.col(standard_name(c)) for c in columns])))
    rejected = told.where("_problem <> ''").select(
        F.col(FILE).alias("source_file"), F.col(RECORD).alias("record_number"), F.col("_problem").alias("problem"), text.alias("record")
    )
    return staged, rejected


def source_catalog(
    spark: SparkSession,
    folder: str,
    prefix: str = "",
    files: dict[str, str] | None = None,
    rejected: dict[str, DataFrame] | None = None,
    failed: dict[str, str] | None = None,
) -> Iterator[tuple[str, DataFrame | None]]:
    """Each staging table with its rows, or with None when its file is missing.

    With ``rejected``, only records that fit the layout are staged and the others are put there by table, see :func:`staged_records`;
    without it, records are filled up or cut and unreadable values become NULL. With ``failed``, a source that can not be read at all
    is noted there with the reason and counts as missing, so that it does not stop the others.
    """
    for table in STAGING:
        path = source_path(folder, table, prefix, files)
        try:
            if rejected is not None:
                rows, rejected[table] = staged_records(spark, path, table)
            else:
                raw = standardize_columns(csv_scan(spark, path, multi_line=table in FREE_TEXT_TABLES))
                rows = typed_staging(with_load_metadata(raw, path.rsplit("/", 1)[1]), table)
        except (PySparkException, Py4JJavaError) as error:
            missing = isinstance(error, AnalysisException) and error.getCondition() == "PATH_NOT_FOUND"
            if not missing and failed is None:
                raise
            if failed is not None:
                failed[table] = "missing" if missing else str(error).split("\n", 1)[0]
            yield table, None
            continue
        yield table, rows


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows while they are written instead of in a second pass."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation
