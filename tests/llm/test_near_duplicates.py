import random

from brute import near_groups
from pyspark.sql import functions as F

from tradewind.llm.components import components
from tradewind.llm.near_duplicates import near_duplicate_groups

DOCS = "doc_id long, text string"


def edited(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
    return " ".join(w)


def check(spark, rows, percent=85, **more):
    got = {r["doc_id"]: r for r in near_duplicate_groups(spark.createDataFrame(rows, DOCS), percent, **more).collect()}
    want = near_groups(rows, percent)
    assert {d: (r["n_shingles"], r["component_id"]) for d, r in got.items()} == want
    assert all(r["kept"] == (d == r["component_id"]) for d, r in got.items())


def test_groups_against_all_pairs(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for g in range(12):
        base = " ".join(rng.choices(vocabulary, k=rng.randrange(30, 400)))
        for _ in range(rng.randrange(1, 14)):
            rows.append((rng.randrange(10**9), edited(rng, base, rng.randrange(0, 9))))
    rows += [(-3, "Two words"), (-2, "two WORDS"), (-1, "two words more"), (-9, ""), (-8, None), (-7, " \n\t")]
    check(spark, rows)


def test_one_large_group_in_several_blocks(spark):
    rng = random.Random(6)
    base = " ".join(rng.choices([f"w{i}" for i in range(900)], k=120))
    check(spark, [(i, edited(rng, base, rng.randrange(0, 5))) for i in range(150)], block=32)


def test_whole_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = near_groups(rows, 85)
    got = near_duplicate_groups(docs, 85).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want


def test_odd_rows(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "A B c d E f"), (3, "é" * 50_000 + " b")]
    df = spark.createDataFrame(rows, DOCS).withColumn("node", F.lit(0)).withColumn("component_id", F.lit("x"))
    got = sorted((r["doc_id"] or 0, r["component_id"] or 0, r["kept"]) for r in near_duplicate_groups(df).collect())
    assert got == [(0, 0, False), (1, 1, True), (1, 1, True), (2, 1, False), (3, 3, True)]
    assert near_duplicate_groups(spark.createDataFrame([], DOCS)).collect() == []


def test_components_of_paths_cycles_and_loops(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100), (210, 200), (200, 220), (220, 210), (None, 3)]
    got = {(r["u"], r["v"]) for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {(i, 0) for i in range(1, 41)} | {(210, 200), (220, 200)}
