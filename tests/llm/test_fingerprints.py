import hashlib
import random
import re
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from tradewind.llm import fingerprints
from tradewind.llm.fingerprints import KMER, SKETCHES, TUPLE, fingerprinted, likeness, order_sketch, sketch

DOCS = "doc_id long, text string"


def check(got, rows):
    """All but the hash values: next documents, edits, equality of fingerprints of equal texts, ranges of the likenesses."""
    line = sorted(((d is not None, d or 0, t or "", d) for d, t in rows), key=lambda x: x[:2])
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    prints = {}
    for i, (_, _, text, d) in enumerate(line):
        after = line[(i + 1) % len(line)][2]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        sha = hashlib.sha256(edited.encode()).hexdigest()
        r = next(r for r in by[d] if r["edited_sha256"] == sha and r["n_chars"] == len(text))
        by[d].remove(r)
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        for t, p in ((text, r["fingerprint"]), (edited, r["edited_fingerprint"])):
            assert prints.setdefault(t, p) == p
        if text == after:
            assert r["near_next"] == 1
        if text == edited:
            assert r["near_edited"] == 1
    return prints


def test_whole_table_in_several_ranges(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "ROWS_PER_RANGE", 7)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = fingerprinted(docs).collect()
    prints = check(got, rows)
    long = [r for r in got if r["n_chars"] > 2000]
    mean = lambda c: sum(r[c] for r in long) / len(long)
    assert mean("near_edited") > 0.3 and mean("near_next") < 0.1
    assert len(set(prints.values())) > 0.95 * len(prints)


def spark_hash(*values):
    """Spark's xxhash64: one value after the other, each with the hash so far as the seed."""
    seed = 42
    for v in values:
        for x in v if isinstance(v, list) else [v]:
            raw = x.encode() if isinstance(x, str) else x if isinstance(x, bytes) else (x % 2**64).to_bytes(8, "little")
            seed = xxhash.xxh64(raw, seed=seed).intdigest()
    return seed - 2**64 if seed >= 2**63 else seed


def plain_sketch(text, k=KMER):
    """The method in plain Python."""
    words = [spark_hash(w) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    if not words:
        return []
    mask = (1 << 24) - 1
    grams = [spark_hash(*words[i : i + k]) for i in range(len(words) - k + 1)] or [spark_hash(words)]
    seen, elements = Counter(), []
    for i, g in enumerate(grams):
        elements.append(((spark_hash(g >> 24, seen[g >> 24].to_bytes(4, "little")) & ~mask) >> 24, i))
        seen[g >> 24] += 1
    out = []
    for bucket in range(-SKETCHES // 2, SKETCHES // 2):
        least = sorted(e for e in elements if e[0] >> (40 - 6) == bucket)[:TUPLE]
        if least:
            own = spark_hash([e[0] % (1 << 40) for e in sorted(least, key=lambda e: e[1])]) % (1 << 32)
            out.append(own | (bucket % SKETCHES) << 32)
    return out


def test_against_plain_python(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows += [(10**6, None), (10**6 + 1, "one"), (10**6 + 2, "a b " * 500)]
    df = spark.createDataFrame(rows, DOCS).select("text", sketch(F.col("text")).alias("s"))
    assert all(list(r["s"]) == plain_sketch(r["text"]) for r in df.collect())


def test_order_counts_but_plain_sets_are_equal(spark):
    rng = random.Random(1)
    w = [f"w{i}" for i in range(3000)]
    rng.shuffle(w)
    pairs = [" ".join(w[i : i + 30]) for i in range(0, 3000, 30)]
    moved = pairs[:]
    rng.shuffle(moved)
    texts = [("same", " ".join(pairs)), ("moved", " ".join(moved)), ("cut", " ".join(pairs[:-10]))]
    df = spark.createDataFrame([(n, " ".join(pairs), t) for n, t in texts], "n string, a string, b string")
    got = {r["n"]: r["x"] for r in df.select("n", likeness(sketch(F.col("a")), sketch(F.col("b"))).alias("x")).collect()}
    assert got["same"] == 1 and got["cut"] > 0.7 and 0.2 < got["moved"] < 0.75


def test_repeated_words_are_told_apart(spark):
    df = spark.createDataFrame([("a b " * n,) for n in (3, 30, 300, 30)], "t string")
    got = [tuple(r[0]) for r in df.select(sketch(F.col("t"))).collect()]
    assert got[1] == got[3] and len(set(got)) == 3 and len(got[2]) > len(got[0])


def test_odd_rows(spark):
    rows = [(5, None), (9, ""), (2, "one"), (7, "é" * 9), (3, "a b c d e f g h"), (None, "no id here"), (4, "x " * 40_000), (1, " \n "), (8, "日本語 テスト 文")]
    df = spark.createDataFrame(rows, DOCS).withColumn("part", F.lit(1)).withColumn("own", F.lit("o"))
    check(fingerprinted(df).collect(), rows)
    check(fingerprinted(spark.createDataFrame([(1, "only one text here")], DOCS)).collect(), [(1, "only one text here")])
    twice = [(1, "abc def ghi jkl"), (1, "abc def ghi jkl"), (2, "x y z")]
    assert len(fingerprinted(spark.createDataFrame(twice, DOCS)).collect()) == 3
    assert fingerprinted(spark.createDataFrame([], DOCS)).collect() == []


def test_short_texts_have_full_tuples_that_know_the_order(spark):
    rng = random.Random(2)
    pairs = []
    for n in (20, 40, 80, 130):
        for _ in range(25):
            w = [f"w{rng.randrange(10**6)}" for _ in range(n)]
            half = n // 2
            pairs.append((n, " ".join(w), " ".join(w[half:] + w[:half])))
    df = spark.createDataFrame(pairs, "n int, a string, b string")
    got = df.select("n", F.size(order_sketch(F.col("a"))).alias("size"), likeness(order_sketch(F.col("a")), order_sketch(F.col("b"))).alias("x")).collect()
    assert all(r["size"] == SKETCHES for r in got)
    # Two k-mers of different halves, every second tuple, change their order; a single k-mer has none.
    for n in (20, 40, 80, 130):
        own = [r["x"] for r in got if r["n"] == n]
        assert 0.3 < sum(own) / len(own) < 0.6, n


def test_sketches_of_long_texts_are_those_of_full_buckets(spark):
    rows = [(r["text"],) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows = [r for r in rows if len(r[0].split()) > 800 and max(map(len, r[0].split())) <= fingerprints.LONGEST and r[0].isascii()]
    rows = rows or [(" ".join(f"w{i * i % 997}" for i in range(3000)),)]
    for r in spark.createDataFrame(rows, "t string").select(sketch(F.col("t")).alias("a"), order_sketch(F.col("t")).alias("b")).collect():
        assert len(set(r["a"]) - set(r["b"])) <= 1


def test_texts_without_blanks(spark):
    rng = random.Random(3)
    signs = {"zh": "天地玄黃宇宙洪荒日月盈昃辰宿列張寒來暑往秋收冬藏閏餘成歲律呂調陽", "ja": "あいうえおかきくけこさしすせそカキクケコ日本語", "th": "กขคงจฉชซญดตถทธนบปผพฟมยรลวศสหอ", "token": "abcdefghijklmnopqrstuvwxyz0123456789"}
    rows = [(i, "".join(rng.choices(s, k=n))) for i, (s, n) in enumerate((s, n) for s in signs.values() for n in (100, 800))]
    got = fingerprinted(spark.createDataFrame(rows, DOCS)).collect()
    check(got, rows)
    assert all(0.25 < r["near_edited"] < 0.95 for r in got)
    assert all(r["near_next"] < 0.5 for r in got)
