"""Session settings and the shared folder used for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_RUN: ContextVar[str | None] = ContextVar("run_folder", default=None)

_REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "16g") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tradewind")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`SETTINGS` to a session that was made elsewhere."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def workers_find_package(spark: SparkSession) -> None:
    """Put the folder of this package on the search path of Python workers that share this machine's files.

    Elsewhere the package is installed or sent along with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own; on a cluster a
    missing setting is an error, because a machine-local folder would lose
    intermediate tables together with the executor that wrote them.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tradewind-"))
    return context.getCheckpointDir().rstrip("/")


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """A folder for the intermediates of one run, removed when the run ends.

    What :func:`materialize` writes meanwhile goes there, unless it is kept.
    """
    path = f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"
    token = _RUN.set(path)
    try:
        yield path
    finally:
        _RUN.reset(token)
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def intermediates(spark: SparkSession) -> str:
    """The folder of the run that is going on, or the shared folder."""
    return _RUN.get() or shared_folder(spark)


def materialize(df: DataFrame, label: str = "table", keep: bool = False) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Inside a :func:`run_folder` the table is removed with the run; ``keep`` is
    for results that outlive it. Used wherever lineage has to be cut or a nondeterministic column (partition
    number, row position) has to be frozen. Parquet keeps column pruning,
    filter pushdown and true sizes for the readers, and survives executor loss.
    """
    spark = df.sparkSession
    folder = shared_folder(spark) if keep else intermediates(spark)
    path = f"{folder}/{label}-{uuid.uuid4().hex}"
    write_parquet(df, path)
    return spark.read.schema(df.schema).parquet(path)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write Parquet files; the shuffle files of the job are removed with its end.

    Otherwise they stay until the driver happens to collect its garbage, and a
    run of many steps holds the shuffles of all of them on disk.
    """
    spark = df.sparkSession
    before = spark.conf.get(_REMOVE_SHUFFLES, None)
    spark.conf.set(_REMOVE_SHUFFLES, "true")
    try:
        df.write.mode(mode).option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_REMOVE_SHUFFLES)
        else:
            spark.conf.set(_REMOVE_SHUFFLES, before)
