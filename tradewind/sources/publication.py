"""A whole load becomes visible in one step, or not at all.

Every table of a load is written to a folder of its own, counted and checked there. Then one small journal entry names all of them; it is
created exclusively, so of two loads that ran at the same time the later one is refused. Readers find tables by the newest complete
entry. Catalogue tables are pointed to the same folders afterwards; if that is interrupted, ``recover`` finishes it from the journal.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tradewind.operators.quality import UNIQUE_KEYS, check_unique
from tradewind.session import write_parquet
from tradewind.sources.files import observed
from tradewind.sources.schemas import WAREHOUSE

# Source keys that may repeat: of these tables only the surrogate key is checked.
_REPEATING = {"fact_order_items", "fact_payments"}
CHECKED_KEYS = {table: keys[:1] if table in _REPEATING else keys for table, keys in UNIQUE_KEYS.items()}


@dataclass(frozen=True)
class Version:
    """One written table of a load."""

    layer: str
    table: str
    path: str
    rows: int
    schema: str


@dataclass(frozen=True)
class Entry:
    """A published load: its number, and the version of every table that readers see from then on."""

    number: int
    versions: tuple[Version, ...]


class Journal:
    """Numbered entries in ``folder/_journal``; an entry counts once its last line is written."""

    _END = "published"

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/_journal")
        self.files = self.path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        """Numbers ever taken, those of interrupted entries included, newest first."""
        if not self.files.exists(self.path):
            return []
        names = [status.getPath().getName() for status in self.files.listStatus(self.path)]
        return sorted((int(name) for name in names if name.isdigit()), reverse=True)

    def read(self, number: int) -> Entry | None:
        rows = self.spark.read.text(f"{self.path.toString()}/{number:012d}", wholetext=True).collect()
        lines = rows[0][0].splitlines() if rows else []
        if not lines or lines[-1] != self._END:
            return None
        return Entry(number, tuple(Version(**json.loads(line)) for line in lines[:-1]))

    def entries(self):
        """Complete entries, newest first."""
        return (e for e in map(self.read, self.numbers()) if e is not None)

    def latest(self) -> Entry | None:
        return next(self.entries(), None)

    def add(self, number: int, versions: list[Version]) -> Entry:
        """Raises if the number is taken."""
        lines = [json.dumps(v.__dict__) for v in versions] + [self._END, ""]
        self.files.mkdirs(self.path)
        name = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path, f"{number:012d}")
        try:
            out = self.files.create(name, False)
        except Exception as error:
            if not self.files.exists(name):
                raise
            raise RuntimeError(f"load {number} was published by another run") from error
        try:
            out.write("\n".join(lines).encode())
        finally:
            out.close()
        return Entry(number, tuple(versions))


class Publication:
    """A sink for one load, as a context: leaving it publishes the tables, an error in it leaves what was published before.

    ``with Publication(spark, folder) as sink: run_warehouse(spark, staging, sink)``. Tables that the load does not write stay as they were
    published. With ``catalogue``, tables of the databases ``prefix + layer`` are pointed to the published folders; these databases
    must exist. A table without rows or with extra columns is published like any other; a declared layout is kept.
    """

    def __init__(self, spark: SparkSession, folder: str, prefix: str = "", catalogue: bool = False):
        self.spark, self.folder, self.prefix, self.catalogue = spark, folder.rstrip("/"), prefix, catalogue
        self.journal = Journal(spark, folder)
        self.written: dict[tuple[str, str], Version] = {}

    def __enter__(self) -> Publication:
        self.number = next(iter(self.journal.numbers()), 0) + 1
        self.load = f"{self.number:012d}-{uuid.uuid4().hex}"
        return self

    def __exit__(self, kind, error, trace) -> None:
        if kind is not None:
            self.discard()
            return
        try:
            entry = self.commit()
        except BaseException:
            self.discard()
            raise
        if self.catalogue:
            point(self.spark, entry, self.prefix)

    def __call__(self, layer: str, table: str, rows: DataFrame) -> tuple[DataFrame, int]:
        """Write one table of the load; it is seen by nobody but the caller yet."""
        declared = WAREHOUSE.get(layer, {}).get(table) if layer != "staging" else None
        if declared is not None:
            rows = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in declared])
        path = f"{self.folder}/{layer}/{table}/{self.load}"
        counted, seen = observed(rows, f"{layer}.{table}")
        write_parquet(counted, path)
        version = Version(layer, table, path, seen.get["rows"], rows.schema.json())
        self.written[layer, table] = version
        return stored(self.spark, version), version.rows

    def commit(self) -> Entry:
        """Check every written table, then make all of them the published ones."""
        for version in self.written.values():
            check(self.spark, version)
        before = self.journal.latest()
        kept = {(v.layer, v.table): v for v in before.versions} if before else {}
        return self.journal.add(self.number, list((kept | self.written).values()))

    def discard(self) -> None:
        """Remove what this load wrote, unless it has been published."""
        published = {v.path for e in self.journal.entries() for v in e.versions}
        for version in self.written.values():
            if version.path not in published:
                _remove(self.spark, version.path)
        self.written.clear()


def check(spark: SparkSession, version: Version) -> None:
    """Raises if a written table does not hold the rows that were sent to it, or repeats a declared key."""
    rows = stored(spark, version)
    found = rows.count()
    if found != version.rows:
        raise ValueError(f"{version.layer}.{version.table}: {version.rows} rows were written, {found} are stored")
    for columns in CHECKED_KEYS.get(version.table, []) if version.layer != "rejected" else []:
        if not check_unique(rows, version.table, columns).isEmpty():
            raise ValueError(f"{version.layer}.{version.table}: rows that repeat {', '.join(columns)}")


def stored(spark: SparkSession, version: Version) -> DataFrame:
    return spark.read.schema(_layout(version)).parquet(version.path)


def _layout(version: Version) -> StructType:
    return StructType.fromJson(json.loads(version.schema))


def published(spark: SparkSession, folder: str) -> dict[tuple[str, str], DataFrame]:
    """Tables of the newest published load by (layer, table); a reader that goes on with them is not touched by later loads."""
    entry = Journal(spark, folder).latest()
    return {(v.layer, v.table): stored(spark, v) for v in entry.versions} if entry else {}


def point(spark: SparkSession, entry: Entry, prefix: str = "") -> list[str]:
    """Point catalogue tables to the folders of an entry; returns the names that were moved. May be repeated.

    A changed layout of a staging or rejected table is a new table under the old name.
    """
    moved = []
    for v in entry.versions:
        name = f"{prefix}{v.layer}.{v.table}"
        layout = _layout(v)
        if spark.catalog.tableExists(name) and [(f.name, f.dataType) for f in spark.table(name).schema] != [(f.name, f.dataType) for f in layout]:
            spark.sql(f"DROP TABLE {name}")
        if not spark.catalog.tableExists(name):
            spark.catalog.createTable(name, path=v.path, source="parquet", schema=layout)
        elif location(spark, name) == _plain(spark, v.path):
            continue
        else:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{v.path}'")
        moved.append(name)
    return moved


def recover(spark: SparkSession, folder: str, prefix: str = "") -> list[str]:
    """Finish an interrupted publication: catalogue tables follow the newest complete entry."""
    entry = Journal(spark, folder).latest()
    return point(spark, entry, prefix) if entry else []


def restore(spark: SparkSession, folder: str, number: int) -> Entry:
    """Publish the tables of an earlier load again, as a new entry."""
    journal = Journal(spark, folder)
    entry = journal.read(number)
    if entry is None:
        raise ValueError(f"load {number} was not published")
    for version in entry.versions:
        check(spark, version)
    return journal.add(journal.numbers()[0] + 1, list(entry.versions))


def retire(spark: SparkSession, folder: str, keep: int = 2) -> int:
    """Remove versions that only entries before the newest ``keep`` name; returns their number. Entries that name them stay."""
    if keep < 1:
        raise ValueError("the newest load is always kept")
    entries = list(Journal(spark, folder).entries())
    needed = {v.path for e in entries[:keep] for v in e.versions}
    old = {v.path for e in entries[keep:] for v in e.versions} - needed
    return sum(_remove(spark, path) for path in sorted(old))


def location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
    return _plain(spark, rows[0]["data_type"])


def _plain(spark: SparkSession, path: str) -> str:
    """One spelling of a path, with its file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()


def _remove(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
