"""CSV records from files that are read by many tasks, also where quoted values hold line breaks.

A file is read as lines in splits, as Spark deals them out. Whether a split begins inside a quoted value depends on everything before it, so

1. each split is read under both assumptions; the result is whether it ends inside a value, and how many records end in it, for each;
2. these small functions are composed along each file, which gives every split its true beginning and its first record number;
3. splits are read again and cut into records; parts of the few records that cross splits are put together by file and place.

Records are parsed by Spark's own CSV parser. Lines end with a line feed, with or without a carriage return before it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradewind.session import materialize, workers_find_package

FILE, RECORD, BAD = "_file", "_record", "_bad"
_BLANK = ("", "\r")


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted value is open after a line, given whether one is open before it.

    A quote opens a value only as its first sign, two quotes inside one are a quote, and what follows a closing quote is plain up to the
    next comma.
    """
    at = 0
    while True:
        if inside:
            at = line.find('"', at)
            if at < 0:
                return True
            if line.startswith('"', at + 1):
                at += 2
                continue
            at = line.find(",", at + 1) + 1
            if at == 0:
                return False
        if line.startswith('"', at):
            at += 1
        else:
            at = line.find(',"', at) + 2
            if at == 1:
                return False
        inside = True


def _lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(path, lineSep="\n")
    place = [F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")]
    return lines.select(*place, F.col("_metadata.file_path").alias("name"), "value")


_SPLIT = pa.schema(
    [("file", pa.int64()), ("start", pa.int64()), ("name", pa.string())] + [(c, pa.int64()) for c in ("end_out", "end_in", "n_out", "n_in")]
)
_SPLIT_DDL = "file long, start long, name string, end_out long, end_in long, n_out long, n_in long"


def _runs(*columns: pa.Array) -> Iterator[tuple[int, int]]:
    """Stretches of a batch in which file and start stay the same."""
    if not len(columns[0]):
        return
    values = [c.to_numpy(zero_copy_only=False) for c in columns]
    change = np.flatnonzero(np.any([v[1:] != v[:-1] for v in values], axis=0)) + 1
    yield from zip([0, *change.tolist()], [*change.tolist(), len(columns[0])])


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per split: its end and its number of records for a beginning outside and inside a quoted value.

    Lines come as null where they are neither blank nor hold a quote; such a line is a record, or part of one.
    """

    def pack(split: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(split, _SPLIT)], schema=_SPLIT)

    now: list | None = None
    for batch in batches:
        file, start, name, line = batch.columns
        for a, b in _runs(file, start):
            key = (file[a].as_py(), start[a].as_py())
            if now is None or tuple(now[:2]) != key:
                if now is not None:
                    yield pack(now)
                now = [*key, name[a].as_py(), 0, 1, 0, 0]
            part = line.slice(a, b - a)
            marked = np.flatnonzero(pc.is_valid(part).to_numpy(zero_copy_only=False))
            before = 0
            for at, text in zip(marked.tolist(), part.drop_null().to_pylist()):
                for assumed in (0, 1):
                    inside = now[3 + assumed]
                    if not inside:
                        now[5 + assumed] += at - before
                    if text in _BLANK:
                        continue
                    now[3 + assumed] = after = int(ends_inside(text, bool(inside)))
                    now[5 + assumed] += not after
                before = at + 1
            for assumed in (0, 1):
                if not now[3 + assumed]:
                    now[5 + assumed] += b - a - before
    if now is not None:
        yield pack(now)


def _beginnings(splits: DataFrame) -> DataFrame:
    """Each split with whether it begins inside a value, the records ended before it in its file, and whether a record crosses its ends.

    A split swaps the two states, keeps them, or makes both one; only the last of that kind and the swaps after it matter. The window
    holds the splits of one file.
    """
    in_order = Window.partitionBy("file").orderBy("start")
    so_far, earlier = in_order.rowsBetween(Window.unboundedPreceding, 0), in_order.rowsBetween(Window.unboundedPreceding, -1)
    swap = ((F.col("end_out") == 1) & (F.col("end_in") == 0)).cast("long")
    turned = splits.withColumn("swaps", F.sum(swap).over(so_far))
    settled = F.when(F.col("end_out") == F.col("end_in"), F.pmod(F.col("end_out") + F.col("swaps"), F.lit(2)))
    turned = turned.withColumn("settled", settled)
    before = F.coalesce(F.last("settled", ignorenulls=True).over(earlier), F.lit(0)) + F.coalesce(F.sum(swap).over(earlier), F.lit(0))
    placed = turned.withColumn("inside", F.pmod(before, F.lit(2)) == 1)
    chosen = lambda c: F.when(F.col("inside"), F.col(f"{c}_in")).otherwise(F.col(f"{c}_out"))
    first = F.coalesce(F.sum(chosen("n")).over(earlier), F.lit(0))
    return placed.select("file", "start", "name", "inside", first.alias("first"), (F.col("inside") | (chosen("end") == 1)).alias("crossed"))


_RECORD_DDL = "file long, number long, text string"
_PIECE_DDL = "file long, start long, head boolean, number long, text string"
_RECORDS = pa.schema([("file", pa.int64()), ("number", pa.int64()), ("text", pa.string())])
_PIECES = pa.schema([("file", pa.int64()), ("start", pa.int64()), ("head", pa.bool_()), ("number", pa.int64()), ("text", pa.string())])


def _cut(pieces: bool):
    """Cut splits into records: those that lie in one split, or with ``pieces`` the parts of the others."""
    schema = _PIECES if pieces else _RECORDS

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        key = None
        held: list[str] | None = None
        head, number = True, 0
        for batch in batches:
            file, start, inside, first, lines = batch.columns
            out: list[tuple] = []
            for a, b in _runs(file, start):
                if key != (file[a].as_py(), start[a].as_py()):
                    if held and pieces:
                        out.append((*key, head, number + 1, "\n".join(held)))
                    key = (file[a].as_py(), start[a].as_py())
                    number = first[a].as_py()
                    held, head = ([], False) if inside[a].as_py() else (None, True)
                for line in lines.slice(a, b - a).to_pylist():
                    if held is None:
                        if line in _BLANK:
                            continue
                        if '"' in line and ends_inside(line, False):
                            held, head = [line], True
                            continue
                        number += 1
                        if not pieces:
                            out.append((key[0], number, line.removesuffix("\r")))
                        continue
                    held.append(line)
                    if ends_inside(line, True):
                        continue
                    number += 1
                    text = "\n".join(held).removesuffix("\r")
                    if head and not pieces:
                        out.append((key[0], number, text))
                    elif pieces and not head:
                        out.append((*key, False, number, text))
                    held = None
            yield out
        if held and pieces:
            yield [(*key, head, number + 1, "\n".join(held))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in rows(batches):
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


def _joined(pieces: DataFrame) -> DataFrame:
    """Records that cross splits: a head and the pieces after it in its file, up to the next head."""
    order = ["start", "head"]
    record = F.sum(F.col("head").cast("long")).over(Window.partitionBy("file").orderBy(*order))
    parts = F.array_sort(F.collect_list(F.struct(*order, "text")))
    grouped = pieces.withColumn("record", record).groupBy("file", "record").agg(F.max("number").alias("number"), parts.alias("parts"))
    return grouped.select("file", "number", F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("text"))


def _header(spark: SparkSession, path: str) -> list[str]:
    return spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path).columns


def csv_records(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Data records of headered UTF-8 CSV files as text columns, with file, number of the record in its file (from 1), and what is wrong.

    ``_bad`` is null, or the text of a record that has another number of values than there are columns, or whose last quote is never
    closed. Blank lines are no records. The splits are looked at at once, the records when they are asked for. Their number, which bounds what is
    broadcast, is that of the read tasks; should files or splits change in between, the read fails rather than return wrong rows.
    """
    workers_find_package(spark)
    columns = columns or _header(spark, path)
    lines = _lines(spark, path)
    value = F.col("value")
    marked = F.when(value.contains('"') | value.isin(*_BLANK), value)
    splits = _beginnings(lines.withColumn("value", marked).mapInArrow(_splits, _SPLIT_DDL))
    splits = materialize(splits, "splits")
    known = F.when(F.col("inside").isNotNull(), F.col("inside")).otherwise(F.raise_error(F.lit("files or splits changed while they were read")))
    placed = lines.select("file", "start", "value").join(F.broadcast(splits.drop("name")), ["file", "start"], "left")
    texts = placed.select("file", "start", known.alias("inside"), "first", "value").mapInArrow(_cut(False), _RECORD_DDL)
    if not splits.where("crossed").isEmpty():
        crossed = placed.where("crossed").select("file", "start", "inside", "first", "value")
        texts = texts.unionByName(_joined(crossed.mapInArrow(_cut(True), _PIECE_DDL)))
    names = splits.groupBy("file").agg(F.first("name").alias(FILE))
    parsed = texts.where("number > 1").join(F.broadcast(names), "file").select(_parsed(F.col("text"), columns).alias("r"), FILE, (F.col("number") - 1).alias(RECORD))
    return parsed.select(*[F.col("r")[c].alias(c) for c in columns], FILE, RECORD, F.col("r")[BAD].alias(BAD))


def _parsed(text: Column, columns: list[str]) -> Column:
    quoted = ", ".join("`" + c.replace("`", "``") + "` string" for c in [*columns, BAD])
    return F.from_csv(text, quoted, {"escape": '"', "multiLine": "true", "columnNameOfCorruptRecord": BAD})
