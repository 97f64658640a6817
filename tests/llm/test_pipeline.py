import corpus_pipeline
from brute import near_groups, words
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(10**6, None, "en", "s", None), (10**6 + 1, "12 34", "en", "s", 5), (10**6 + 2, "", None, None, 0)], docs.schema)
    docs = docs.union(odd)
    columns = docs.columns
    results = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        results.append((name, before, docs))
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    by = {name: ({r["doc_id"]: r["text"] for r in a.collect()}, b) for name, a, b in results}

    before, after = by["language_id"]
    assert set(before) - {r["doc_id"] for r in after.collect()} == {10**6, 10**6 + 1, 10**6 + 2}
    before, after = by["near_dedup"]
    groups = near_groups(list(before.items()), 80)
    assert {r["doc_id"] for r in after.collect()} == {d for d, (_, least) in groups.items() if d == least}
    before, after = by["decontamination"]
    items = [" ".join(words(r["text"], True)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = {r["doc_id"] for r in after.collect()}
    held = {d for d, t in before.items() if any(f" {i} " in f" {' '.join(words(t, True))} " for i in items)}
    assert not held & kept and len(before) - len(kept) <= len(held) + 2
    before, after = by["pseudonymisation"]
    assert {r["doc_id"] for r in after.collect()} == set(before)
    pieces = results[-1][2]
    assert {r["doc_id"] for r in pieces.select("doc_id").distinct().collect()} == set(before)


def test_run(spark):
    got = corpus_pipeline.run(spark, SF)
    whole = got.groupBy("doc_id").agg(F.sum("length").alias("n"), F.first("doc_tokens").alias("m"))
    assert whole.count() > 100 and whole.where("n <> m").count() == 0
    assert got.where(F.size("ids") != F.col("length")).count() == 0 and got.agg(F.sum(F.size("ids"))).first()[0] > 0


def test_copies_without_an_id_or_with_the_same_one_are_copies(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(None, text), (5, text), (5, text), (None, text), (4, text + " eleven twelve"), (None, ""), (None, None), (7, "other words " * 9), (7, "quite another text of seven words"), (None, "x y z"), (None, "x y z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_row_", F.lit("clash")).withColumn("component_id", F.lit(0))
    kept = corpus_pipeline.near_dedup(spark, docs, SF)
    assert kept.columns == docs.columns
    got = sorted(map(repr, ((r["doc_id"], r["text"]) for r in kept.collect())))
    want = [(5, text), (4, text + " eleven twelve"), (None, ""), (None, None), *rows[7:9], (None, "x y z")]
    assert got == sorted(map(repr, want))
    assert corpus_pipeline.near_dedup(spark, docs.limit(0), SF).collect() == []
