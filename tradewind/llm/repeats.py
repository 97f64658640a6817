"""Windows that stand in several places: what the byte and the word operator share.

1. A document's windows fall into runs that share a content-chosen anchor (see ``runs``); equal windows have equal anchors.
2. Anchors that stand once are done with. Where all runs of an anchor have one content, every window of them is repeated.
3. Runs of an anchor with differing contents may still share windows. One run of each content is fetched, and the contents
   that share an anchor are compared by the operator's own index, many small groups at a time, a large
   group in blocks and pairs of blocks.
4. The covered stretches come back to all runs of their content, and each document's stretches are united.

Counts are reduced before every shuffle; no step gathers the rows of an anchor, only blocks of its distinct contents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.arrays import Text, blocks, written
from tradewind.llm.runs import Runs

#: Distinct contents of one block, and symbols that are indexed together.
BLOCK = 2000
#: Shares in which the contents of a crowded anchor learn how many blocks it has.
SHARES = 64

#: Of a block of texts: prefix sums of symbol codes, each row's symbol offsets, and the bytes of stretches of one row.
Symbols = Callable[[Text], tuple[np.ndarray, np.ndarray, Callable[[int, int, int], bytes]]]
#: Of contents (bytes) with their document, window count and group: covered stretches (content, from, to) in symbols.
Compare = Callable[[list[bytes], np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]
#: Of one row: kept digest after removal of stretches [from, to) that are sorted and apart.
Digest = Callable[[Text, np.ndarray, int, np.ndarray, np.ndarray], str]

_RUN = "struct<anchor: long, content: long, first: long, windows: int>"
_HIT = pa.struct([("anchor", pa.int64()), ("content", pa.int64()), ("first", pa.int64()), ("windows", pa.int32())])


def _runs(symbols: Symbols, digest: Digest, length: int, gram: int):
    schema = pa.schema([("doc_id", pa.int64()), ("id0", pa.int64()), ("key", pa.int64()), ("size", pa.int64()), ("kept", pa.string()), ("runs", pa.list_(_HIT))])
    none = np.zeros(0, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in blocks(batch.column(3)):
                sums, first, _ = symbols(text)
                found = [Runs(sums, int(first[i]), int(first[i + 1]), length, gram) for i in range(text.rows)]
                offsets = np.zeros(text.rows + 1, np.int32)
                offsets[1:] = np.cumsum([len(r.first) for r in found])
                join = lambda parts: np.concatenate([*parts, none])
                hits = pa.StructArray.from_arrays(
                    [
                        pa.array(join(r.anchor for r in found)), pa.array(join(r.content for r in found)), pa.array(join(r.first for r in found)),
                        pa.array(join(r.last - r.first + 1 for r in found).astype(np.int32)),
                    ],
                    fields=list(_HIT),
                )
                kept = [digest(text, first, i, none, none) for i in range(text.rows)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).slice(text.first, text.rows) for i in range(3)]
                    + [pa.array(np.diff(first).astype(np.int64)), pa.array(kept, pa.string()), pa.ListArray.from_arrays(pa.array(offsets), hits)],
                    schema=schema,
                )

    return run, f"doc_id long, id0 long, key long, size long, kept string, runs array<{_RUN}>"


def _fetch(symbols: Symbols, length: int):
    """Symbols of the runs that stand for their content, out of each document's text."""
    schema = pa.schema([("anchor", pa.int64()), ("content", pa.int64()), ("id0", pa.int64()), ("windows", pa.int32()), ("symbols", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, wanted = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for text in blocks(batch.column(1)):
                sums, first, stretch = symbols(text)
                rows = [
                    (r["anchor"], r["content"], ids[text.first + i], r["windows"], stretch(i, r["first"], r["first"] + r["windows"] - 1 + length))
                    for i in range(text.rows)
                    for r in wanted[text.first + i] or ()
                ]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return run, "anchor long, content long, id0 long, windows int, symbols binary"


def _compared(compare: Compare, shard: int):
    """Rows sorted by job: whole jobs are put together until ``shard`` bytes, then compared at once; a content is in a shard once."""
    schema = pa.schema([("anchor", pa.int64()), ("content", pa.int64()), ("from", pa.int64()), ("to", pa.int64())])

    def ended(rows: list[dict]) -> pa.RecordBatch:
        which, start, end = compare([r["symbols"] for r in rows], np.array([r["id0"] for r in rows]), np.array([r["windows"] for r in rows]))
        anchor, content = (np.array([r[c] for r in rows], np.int64)[which] for c in ("anchor", "content"))
        return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (anchor, content, start, end)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        seen: set[tuple[int, int]] = set()
        size, job = 0, None
        for batch in batches:
            for row in batch.to_pylist():
                now = row["anchor"], row["a"], row["b"]
                if now != job and size >= shard:
                    yield ended(rows)
                    rows, size = [], 0
                    seen.clear()
                job = now
                if (row["anchor"], row["content"]) not in seen:
                    seen.add((row["anchor"], row["content"]))
                    rows.append(row)
                    size += len(row["symbols"])
        if rows:
            yield ended(rows)

    return run, "anchor long, content long, `from` long, `to` long"


def _united(symbols: Symbols, digest: Digest, length: int):
    schema = pa.schema([("doc_id", pa.int64()), ("size", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, more = batch.column(2), batch.column(3)
            for text in blocks(batch.column(1)):
                _, first, _ = symbols(text)
                rows = []
                for i in range(text.rows):
                    start, end = _union(spans[text.first + i].values, more[text.first + i].values)
                    rows.append((first[i + 1] - first[i], (end - start).sum(), len(start), digest(text, first, i, start, end)))
                out = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(text.first, text.rows)] + [pa.array(np.array(c, np.int64)) for c in out[:3]] + [pa.array(out[3], pa.string())],
                    schema=schema,
                )

    return run, "doc_id long, size long, n_removed long, n_spans long, kept string"


def _union(*parts: pa.StructArray | None) -> tuple[np.ndarray, np.ndarray]:
    """Stretches that touch or overlap as one; sorted and apart."""
    some = [(p.field(0).to_numpy(), p.field(1).to_numpy()) for p in parts if p is not None and len(p)]
    if not some:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start, end = (np.concatenate(x) for x in zip(*some))
    return union(start, end)


def union(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > reach[:-1]
    last = np.append(np.flatnonzero(new)[1:], len(start)) - 1
    return start[new], reach[last]


def _told(runs: DataFrame, contents: DataFrame, earlier: bool) -> DataFrame:
    """``runs`` with ``full`` (all its windows are removed) and ``stands`` (it stands for its content).

    A run in another document than its content's representative has an equal in a smaller doc_id, so only those in the same one need to meet
    it. The join takes the document as a key, and the many runs of one content are dealt over all tasks.
    """
    rep = contents.select("anchor", "content", F.col("rep.id0").alias("id0"), "n", "rep")
    elsewhere = F.col("rep").isNull()
    full = elsewhere if earlier else elsewhere | (F.col("n") > 1)
    stands = ~elsewhere & (F.struct("id0", "key", "first") == F.col("rep"))
    return runs.join(rep, ["anchor", "content", "id0"], "left").withColumn("full", full).withColumn("stands", stands).drop("n", "rep")


def _jobs(fetched: DataFrame, contents: DataFrame, block: int) -> DataFrame:
    """``fetched`` in jobs (anchor, a, b): the contents of an anchor in blocks ``a`` and ``b``; any two contents of an anchor share a job.

    Only an anchor with more than ``block`` contents has several blocks. Its number of them is repeated for every share, so that
    its contents meet it in many tasks.
    """
    crowded = contents.groupBy("anchor").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("parts")).where("parts > 1")
    crowded = crowded.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))
    dealt = fetched.withColumn("share", F.pmod(F.xxhash64("content"), F.lit(SHARES)).cast("int")).join(crowded, ["anchor", "share"], "left")
    # Seeded apart from the share: blocks and shares are independent.
    dealt = dealt.withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn("part", F.pmod(F.xxhash64("content", F.lit(1)), F.col("parts")).cast("int"))
    return dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "anchor", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"), "content", "id0", "windows", "symbols"
    )


def removed(
    docs: DataFrame, symbols: Symbols, digest: Digest, compare: Compare, length: int, gram: int, earlier: bool, shard: int, block: int = BLOCK
) -> DataFrame:
    """Rows (doc_id, size, n_removed, n_spans, kept), one per row of ``docs``.

    A window is removed if it also starts anywhere else; with ``earlier``, if it also starts in a document of a smaller doc_id.
    """
    doc_id = F.col("doc_id").cast("long")
    texts = docs.select(doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit((1 << 63) - 1).cast("long")).alias("id0"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # With the id, the hash names a document; repeated rows share it, and each counts as a document.
    texts = texts.select("doc_id", "id0", F.xxhash64("doc_id", "text").alias("key"), "text")
    run, schema = _runs(symbols, digest, length, gram)
    table = written(texts.mapInArrow(run, schema), "runs")
    each = table.select("id0", "key", F.inline("runs"))

    anchors = each.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("n"), F.min("content").alias("c0"), F.max("content").alias("c1"), F.min("id0").alias("least"), F.max("id0").alias("most")
    )
    anchors = anchors.where("least < most" if earlier else "n > 1").select("anchor", (F.col("c0") == F.col("c1")).alias("one"), "least")
    # Written first: read back, both sides of the join are plain shuffles, and the many runs of one anchor may be split.
    met = written(each.join(written(anchors, "anchors"), "anchor"), "met")

    # Contents of the anchors that have several: how often, and which run stands for them.
    contents = met.where("not one").groupBy("anchor", "content").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("id0", "key", "first")).alias("rep")
    )
    contents = written(contents, "contents")
    mixed = _told(met.where("not one").drop("one", "least"), contents, earlier)
    plain = (F.col("id0") > F.col("least")) if earlier else F.lit(True)
    state = met.where("one").select("id0", "key", "anchor", "content", "first", "windows", plain.alias("full"), F.lit(False).alias("stands")).union(
        mixed.select("id0", "key", "anchor", "content", "first", "windows", "full", "stands")
    )
    end = F.col("first") + F.col("windows") - 1 + length
    per_doc = state.groupBy("id0", "key").agg(
        F.collect_list(F.when(F.col("full"), F.struct(F.col("first").alias("from"), end.alias("to")))).alias("spans"),
        F.collect_set(F.when(F.col("stands"), F.struct("anchor", "content", "first", "windows"))).alias("wanted"),
    ).where((F.size("spans") > 0) | (F.size("wanted") > 0)).select(F.col("id0").alias("i"), F.col("key").alias("k"), "spans", "wanted")
    affected = texts.join(per_doc, (F.col("id0") == F.col("i")) & (F.col("key") == F.col("k"))).drop("i", "k")
    affected = written(affected, "affected")

    run, schema = _fetch(symbols, length)
    fetched = affected.where(F.size("wanted") > 0).select("id0", "text", "wanted").mapInArrow(run, schema)
    # A given number of partitions is not merged by size: comparing takes far longer than reading what it compares.
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    jobs = _jobs(fetched, contents, block).repartition(partitions, "anchor", "a", "b").sortWithinPartitions("anchor", "a", "b")
    run, schema = _compared(compare, shard)
    covered = written(jobs.mapInArrow(run, schema), "covered")

    open_runs = mixed.where("not full").select("id0", "key", "anchor", "content", "first")
    back = open_runs.join(covered, ["anchor", "content"]).groupBy("id0", "key").agg(
        F.collect_list(F.struct((F.col("first") + F.col("from")).alias("from"), (F.col("first") + F.col("to")).alias("to"))).alias("more")
    ).select(F.col("id0").alias("i"), F.col("key").alias("k"), "more")
    whole = affected.drop("wanted").join(back, (F.col("id0") == F.col("i")) & (F.col("key") == F.col("k")), "left").drop("i", "k")
    run, schema = _united(symbols, digest, length)
    changed = whole.where((F.size("spans") > 0) | F.col("more").isNotNull()).select("doc_id", "text", "spans", "more").mapInArrow(run, schema)
    touched = whole.where((F.size("spans") > 0) | F.col("more").isNotNull()).select("id0", "key").distinct()
    rest = table.select("doc_id", "id0", "key", "size", "kept").join(touched, ["id0", "key"], "left_anti")
    zero = F.lit(0).cast("long")
    return changed.union(rest.select("doc_id", "size", zero.alias("n_removed"), zero.alias("n_spans"), "kept"))
