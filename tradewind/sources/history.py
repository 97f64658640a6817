"""Stored dimensions that are merged bucket by bucket.

Rows lie in buckets by a hash of their key. A merge compares narrow rows (key, hash) only in the buckets that the delivery reaches, reads whole
rows only in the buckets that change, and writes these anew in folders of their own; a journal entry then names the new set of folders.
Closed versions are never read or moved by a merge: each merge adds its own, so bytes written grow with the change, not with the history.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tradewind.operators.versions import scd1_apply, scd2_apply
from tradewind.session import materialize
from tradewind.sources.files import observed
from tradewind.sources.publication import Entry, Journal, Version, _remove

_CURRENT, _CLOSED, _LAYOUT = "current", "closed", "layout"


@dataclass(frozen=True)
class Merged:
    """What a merge did: keys that changed or are new, buckets and rows written, and the journal entry (None if nothing changed)."""

    keys: int
    buckets: int
    rows: int
    entry: int | None


class History:
    """A dimension in ``buckets`` buckets, made by :meth:`create` and opened by :meth:`open`.

    A bucket is the least that is rewritten: choose their number so that one holds some 100 MB. ``key`` is unique among current rows and never
    null; ``create`` and the merges raise on rows that break this, and nothing is stored. A table may be empty. Of two merges
    at once the later is refused, and a merge that fails leaves what was stored before.
    """

    def __init__(self, spark: SparkSession, folder: str, key: str, buckets: int, schema: StructType, hash_column: str = "record_hash"):
        self.spark, self.folder, self.key, self.buckets, self.schema = spark, folder.rstrip("/"), key, buckets, schema
        self.hash_column = hash_column
        self.journal = Journal(spark, folder)
        self.versioned = "is_current" in schema.fieldNames()

    @classmethod
    def create(cls, rows: DataFrame, folder: str, key: str, buckets: int = 64, hash_column: str = "record_hash") -> History:
        """Store a first state; with a column ``is_current`` it holds versions, otherwise one row per key."""
        if buckets < 1:
            raise ValueError("at least one bucket")
        if {"_state", "_bucket"} & set(rows.columns):
            raise ValueError("_state and _bucket name folders of the history")
        history = cls(rows.sparkSession, folder, key, buckets, rows.schema, hash_column)
        if history.journal.numbers():
            raise ValueError(f"{folder} holds a history")
        history.journal.files.mkdirs(history.journal.path.getParent().suffix("/_layout"))
        first = Version(_LAYOUT, f"{buckets}/{hash_column}/{key}", f"{history.folder}/_layout", 0, rows.schema.json())
        history._publish(1, rows, [first])
        return history

    @classmethod
    def open(cls, spark: SparkSession, folder: str) -> History:
        entry = Journal(spark, folder).latest()
        if entry is None:
            raise ValueError(f"{folder} holds no history")
        layout = next(v for v in entry.versions if v.layer == _LAYOUT)
        buckets, hash_column, key = layout.table.split("/", 2)
        return cls(spark, folder, key, int(buckets), StructType.fromJson(json.loads(layout.schema)), hash_column)

    def read(self) -> DataFrame:
        """All rows as of the newest merge; later merges do not touch a reader."""
        return self._rows([v for v in self._entry().versions if v.layer != _LAYOUT])

    def current(self) -> DataFrame:
        """The current row of every key; closed versions are not read."""
        return self._rows([v for v in self._entry().versions if v.layer == _CURRENT])

    def at(self, time: Column) -> DataFrame:
        """The versions that were valid at a time."""
        return self.read().where((F.col("effective_start_date") <= time) & (F.col("effective_end_date") > time))

    def overwrite(self, incoming: DataFrame) -> Merged:
        """Type 1: rows with another hash replace the stored ones, new keys are added; see :func:`scd1_apply`."""
        if self.versioned:
            raise ValueError("the history holds versions")
        return self._merge(incoming, lambda stored, changes: scd1_apply(stored, changes, self.key, self.hash_column))

    def append(self, incoming: DataFrame, as_of: Column) -> Merged:
        """Type 2: versions with another hash are closed and followed by new ones; see :func:`scd2_apply`."""
        if not self.versioned:
            raise ValueError("the history holds no versions")
        return self._merge(incoming, lambda stored, changes: scd2_apply(stored, changes, self.key, as_of, self.hash_column))

    def compact(self) -> int:
        """Put the closed versions of all merges into one folder; returns how many folders there were. ``retire`` removes the old ones."""
        entry = self._entry()
        closed = [v for v in entry.versions if v.layer == _CLOSED]
        if len(closed) > 1:
            kept = [v for v in entry.versions if v.layer != _CLOSED]
            self._publish(entry.number + 1, self._rows(closed), kept)
        return len(closed)

    def _entry(self) -> Entry:
        return self.journal.latest()

    def _rows(self, versions: list[Version]) -> DataFrame:
        if not versions:
            return self.spark.createDataFrame([], self.schema)
        # Folder names below a version are no columns.
        return self.spark.read.schema(self.schema).option("recursiveFileLookup", "true").parquet(*[v.path for v in versions])

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(f"`{self.key}`").cast(self.schema[self.key].dataType)), F.lit(self.buckets)).cast("int")

    def _merge(self, incoming: DataFrame, apply) -> Merged:
        before = self._entry()
        types = {f.name: f.dataType for f in self.schema}
        incoming = incoming.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) for c in incoming.columns if c in types])
        _refuse(incoming, self.key, "delivered")
        current = {int(v.table): v for v in before.versions if v.layer == _CURRENT}
        reached = {r[0] for r in incoming.select(self._bucket().alias("b")).distinct().collect()}
        stored = self._rows([current[b] for b in sorted(reached & current.keys())])
        narrow = stored.select(F.col(self.key).alias("_key"), F.col(self.hash_column).alias("_hash"), F.lit(True).alias("_known"))
        differs = F.col("_known").isNull() | ~F.col(self.hash_column).eqNullSafe(F.col("_hash"))
        changes = incoming.join(narrow, F.col(self.key) == F.col("_key"), "left").where(differs).select(*incoming.columns)
        # Frozen, since it decides twice: which buckets are opened, and what is put into them.
        changes = materialize(changes.withColumn("_bucket", self._bucket()), "changes")
        touched = {r["_bucket"]: r["count"] for r in changes.groupBy("_bucket").count().collect()}
        if not touched:
            return Merged(0, 0, 0, None)
        opened = self._rows([current[b] for b in sorted(touched.keys() & current.keys())])
        kept = [v for v in before.versions if not (v.layer == _CURRENT and int(v.table) in touched)]
        rows = self._publish(before.number + 1, apply(opened, changes.drop("_bucket")), kept)
        return Merged(sum(touched.values()), len(touched), rows, before.number + 1)

    def _publish(self, number: int, rows: DataFrame, kept: list[Version]) -> int:
        """Write rows by state and bucket, check what is stored, then name it together with ``kept``; returns the rows written."""
        load = f"{self.folder}/{number:012d}-{uuid.uuid4().hex}"
        state = F.when(F.col("is_current"), _CURRENT).otherwise(_CLOSED) if self.versioned else F.lit(_CURRENT)
        placed = rows.select(*self.schema.names).withColumns({"_state": state, "_bucket": self._bucket()})
        # Buckets of unique keys are put together where they are small and split where they are large.
        placed, seen = observed(placed.hint("rebalance", "_state", "_bucket"), "history")
        published = False
        try:
            placed.write.mode("errorifexists").partitionBy("_state", "_bucket").parquet(load)
            layout = StructType(list(self.schema.fields)).add("_state", "string").add("_bucket", "integer")
            written = self.spark.read.schema(layout).parquet(load)
            counts = {(r["_state"], r["_bucket"]): r["count"] for r in written.groupBy("_state", "_bucket").count().collect()}
            if sum(counts.values()) != seen.get["rows"]:
                raise ValueError(f"{seen.get['rows']} rows were written, {sum(counts.values())} are stored")
            _refuse(written.where(F.col("_state") == _CURRENT), self.key, "stored")
            schema = self.schema.json()
            added = [Version(_CURRENT, str(b), f"{load}/_state={s}/_bucket={b}", n, schema) for (s, b), n in sorted(counts.items()) if s == _CURRENT]
            closed = sum(n for (s, _), n in counts.items() if s == _CLOSED)
            if closed:
                added.append(Version(_CLOSED, str(number), f"{load}/_state={_CLOSED}", closed, schema))
            self.journal.add(number, [*kept, *added])
            published = True
        finally:
            if not published:
                _remove(self.spark, load)
        return sum(counts.values())


def _refuse(rows: DataFrame, key: str, what: str) -> None:
    column = F.col(f"`{key}`")
    wrong = rows.groupBy(column.alias("k")).count().where("k IS NULL OR count > 1").take(1)
    if wrong:
        raise ValueError(f"{what} rows repeat the key {key} or lack it: {wrong[0]['k']!r} stands {wrong[0]['count']} times")
