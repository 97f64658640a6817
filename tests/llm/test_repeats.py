import hashlib
import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewind.llm import fm_index, suffix_repeats
from tradewind.llm.fm_index import FMIndex, WaveletMatrix, without_earlier_passages
from tradewind.llm.repeats import _jobs, _told
from tradewind.llm.runs import sliding_minimum
from tradewind.llm.suffix_repeats import SuffixArray, without_repeats

DOCS = "doc_id long, text string"


def passages(rng, n, unit):
    """Documents that share copies, long passages, passages within themselves, periodic stretches and near copies."""
    vocabulary = [f"w{i}" for i in range(60)] + ["é", "日本"]
    prose = lambda k: " ".join(rng.choices(vocabulary, k=k))
    shared = [prose(rng.randrange(unit // 2, 3 * unit)) for _ in range(6)]
    docs = []
    for i in range(n):
        parts = [prose(rng.randrange(0, unit)) for _ in range(rng.randrange(1, 4))]
        for _ in range(rng.randrange(0, 4)):
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(shared))
        if rng.random() < 0.15:
            parts.append("ab " * rng.randrange(unit, 3 * unit))
        if docs and rng.random() < 0.3:
            w = rng.choice(docs).split(" ")
            w[rng.randrange(len(w))] = "changed"
            parts = [" ".join(w)]
        docs.append(" ".join(parts))
    docs += ["", None, docs[0], "short", " \n", "x" * 3000]
    ids = rng.sample(range(-500, 5000), len(docs))
    return list(zip(ids, docs))


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def bytes_agree(spark, rows, **how):
    got = {r["doc_id"]: tuple(r)[1:] for r in without_repeats(spark.createDataFrame(rows, DOCS).repartition(7), **how).collect()}
    want = {d: (n, m, s, sha(kept)) for (d, _), (n, m, s, kept) in zip(rows, brute.without_repeats(rows, 400))}
    assert got == want
    return sum(w[1] for w in want.values())


def words_agree(spark, rows, **how):
    got = {r["doc_id"]: tuple(r)[1:] for r in without_earlier_passages(spark.createDataFrame(rows, DOCS).repartition(7), **how).collect()}
    want = {d: (n, m, sha(kept)) for (d, _), (n, m, kept) in zip(rows, brute.without_earlier(rows, 50))}
    assert got == want
    return sum(w[1] for w in want.values())


@pytest.mark.parametrize("width", [1, 2, 7, 40])
def test_sliding_minimum(width):
    x = np.random.default_rng(width).integers(0, 50, 40).astype(np.uint64)
    assert sliding_minimum(x, width).tolist() == [min(x[i : i + width]) for i in range(len(x) - width + 1)]


def test_maximal_repeats_against_all_pairs():
    rng = random.Random(4)
    for _ in range(60):
        strings = [bytes(rng.choices(b"\0ab", k=rng.randrange(1, 40))) for _ in range(4)]
        least = rng.randrange(2, 6)
        array = SuffixArray(strings, np.array([len(s) for s in strings]), least)
        text, found = array.data.tobytes(), {}
        for length, start, end in array.maximal_repeats(least):
            places = array.order[start:end]
            one = {text[p : p + length] for p in places}
            assert len(one) == 1
            found[one.pop()] = sorted(places.tolist())
        want = {}
        at = [(i, p) for i, s in enumerate(strings) for p in range(len(s))]
        for i, p in at:
            for n in range(least, len(strings[i]) - p + 1):
                x = strings[i][p : p + n]
                places = [(j, q) for j, q in at if strings[j][q : q + n] == x]
                if len(places) > 1:
                    befores = {strings[j][q - 1] if q else ("start", j) for j, q in places}
                    afters = {strings[j][q + n] if q + n < len(strings[j]) else ("end", j) for j, q in places}
                    edge = lambda s: len(s) > 1 or any(isinstance(c, tuple) for c in s)
                    if edge(befores) and edge(afters):
                        want[x] = sorted(int(array.begin[j]) + q for j, q in places)
        assert found == want


def test_wavelet_ranks_and_backward_search():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 37, 500)
    matrix = WaveletMatrix(x, 37)
    symbol, place = rng.integers(0, 37, 300), rng.integers(0, 501, 300)
    assert matrix.rank(symbol, place).tolist() == [int((x[:p] == s).sum()) for s, p in zip(symbol, place)]
    sequences = [rng.integers(0, 4, n).astype(np.uint64) for n in (30, 1, 17, 40, 30)]
    index = FMIndex(sequences, 128)
    lines = ["".join(map(str, s)) for s in sequences]
    for _ in range(200):
        pattern = rng.integers(0, 4, rng.integers(1, 6))
        low, high = np.array([0]), np.array([len(index.text)])
        for c in pattern[::-1]:
            low, high = index.back(np.array([c + 1]), low, high)
        p = "".join(map(str, pattern))
        assert high[0] - low[0] == sum(line[i:].startswith(p) for line in lines for i in range(len(line)))


@pytest.mark.parametrize("seed", [1, 2])
def test_bytes_against_all_strings(spark, seed):
    assert bytes_agree(spark, passages(random.Random(seed), 60, 130)) > 10_000


def test_bytes_in_small_blocks_and_shards(spark, monkeypatch):
    monkeypatch.setattr(suffix_repeats, "SHARD", 3000)
    assert bytes_agree(spark, passages(random.Random(7), 60, 130), block=3) > 10_000


@pytest.mark.parametrize("seed", [3, 4])
def test_words_against_all_windows(spark, seed):
    assert words_agree(spark, passages(random.Random(seed), 80, 60)) > 1000


def test_words_in_small_blocks_and_shards(spark, monkeypatch):
    monkeypatch.setattr(fm_index, "SHARD", 3000)
    assert words_agree(spark, passages(random.Random(8), 80, 60), block=3) > 1000


def test_whole_tables(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    bytes_agree(spark, rows)
    words_agree(spark, rows)


def test_odd_rows(spark):
    long = " ".join(f"v{i}" for i in range(300))
    rows = [(1, long), (1, long), (None, long), (2, "first " + long), (3, None)]
    df = spark.createDataFrame(rows, DOCS).withColumn("key", F.lit(1)).withColumn("anchor", F.lit("x"))
    got = sorted((r["doc_id"] or 0, r["n_removed"], r["n_bytes"]) for r in without_repeats(df).collect())
    n = len(long)
    assert got == [(0, n, n), (1, n, n), (1, n, n), (2, n, n + 6), (3, 0, 0)]
    got = sorted((r["doc_id"] or 0, r["n_removed"], r["n_words"]) for r in without_earlier_passages(df).collect())
    assert got == [(0, 300, 300), (1, 0, 300), (1, 0, 300), (2, 300, 301), (3, 0, 0)]
    empty = spark.createDataFrame([], DOCS)
    assert without_repeats(empty).collect() == [] and without_earlier_passages(empty).collect() == []


@pytest.mark.parametrize("earlier", [True, False])
def test_runs_of_one_content_are_dealt_over_tasks(spark, earlier):
    """One content in 4000 documents, twice in the first, and one that stands once."""
    rows = [(d, d * 7, 5, 6, 0, 3) for d in range(4000)] + [(0, 0, 5, 6, 90, 3), (1, 7, 5, 8, 40, 3)]
    runs = spark.createDataFrame(rows, "id0 long, key long, anchor long, content long, first long, windows int")
    contents = runs.groupBy("anchor", "content").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id0", "key", "first")).alias("rep"))
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = _told(runs, contents, earlier).withColumn("task", F.spark_partition_id()).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(got) == len(rows)
    assert {(r["id0"], r["first"]) for r in got if r["stands"]} == {(0, 0), (1, 40)}
    assert {(r["id0"], r["first"]) for r in got if not r["full"]} == ({(0, 0), (0, 90), (1, 40)} if earlier else {(1, 40)})
    tasks = [r["task"] for r in got]
    assert max(tasks.count(t) for t in set(tasks)) < len(rows) / 4


def test_contents_of_one_anchor_are_dealt_over_tasks(spark):
    """An anchor with 3000 contents and one with 3: all pairs of an anchor's contents share a job, no task gets most of them."""
    rows = [(5, c * 7919, c, 3, b"x") for c in range(3000)] + [(6, c, c, 3, b"y") for c in range(3)]
    fetched = spark.createDataFrame(rows, "anchor long, content long, id0 long, windows int, symbols binary")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = _jobs(fetched, fetched.select("anchor", "content"), 1000).withColumn("task", F.spark_partition_id()).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    jobs = {}
    for r in got:
        jobs.setdefault((r["anchor"], r["a"], r["b"]), []).append(r["content"])
    assert sorted(jobs) == [(5, 0, 0), (5, 0, 1), (5, 0, 2), (5, 1, 1), (5, 1, 2), (5, 2, 2), (6, 0, 0)]
    blocks = {a: set(c) for (n, a, b), c in jobs.items() if n == 5 and a == b}
    assert all(len(b) < 1200 for b in blocks.values()) and sum(len(b) for b in blocks.values()) == 3000
    assert all(sorted(c) == sorted(blocks[a] | blocks[b]) for (n, a, b), c in jobs.items() if n == 5)
    assert sorted(jobs[6, 0, 0]) == [0, 1, 2]
    tasks = [r["task"] for r in got]
    assert max(tasks.count(t) for t in set(tasks)) < len(got) / 4


def test_passages_of_over_fifty_words_below_400_bytes(spark):
    """Fifty words are not 400 bytes: the word operator takes the later copy, the byte operator none until the passage is 400 bytes long."""
    rng = random.Random(9)
    own = lambda k: " ".join(f"{rng.randrange(1 << 30):x}" for _ in range(k))
    short = " ".join(f"w{i:04}" for i in range(55))
    long = " ".join(f"w{i:04}" for i in range(100, 170))
    assert len(short) < 400 <= len(long)
    rows = [(1, f"{own(90)} a {short} b {own(9)}"), (2, f"{own(9)} c {short} d {own(90)}"), (3, f"{own(9)} a {long} b {own(9)}"), (4, f"{own(9)} c {long} d {own(9)}")]
    docs = spark.createDataFrame(rows, DOCS)
    assert {r["doc_id"]: r["n_removed"] for r in without_earlier_passages(docs).collect()} == {1: 0, 2: 55, 3: 0, 4: 70}
    assert {r["doc_id"]: r["n_removed"] for r in without_repeats(docs).collect()} == {1: 0, 2: 0, 3: len(long) + 2, 4: len(long) + 2}
