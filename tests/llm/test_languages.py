import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tradewind.llm.arrays import blocks
from tradewind.llm.languages import Network, identified, pooled, predicted, segments, train

DOCS = "doc_id long, text string, lang string"


def test_gradients_against_differences():
    rng = np.random.default_rng(0)
    net = Network(["a", "b", "c"], hidden=3)
    for name in ("input", "state", "output", "bias"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    codes, target = rng.integers(0, 7, (4, 6)).astype(np.uint8), np.array([0, 2, 1, 1])
    weight = np.ones((4, 6), np.float32)
    weight[1, 4:] = 0
    _, grad = net.gradients(codes, target, weight)
    for name in grad:
        values = getattr(net, name)
        for _ in range(12):
            at = tuple(rng.integers(0, n) for n in values.shape)
            if name == "input":
                at = (at[0], int(codes[rng.integers(0, 4), rng.integers(0, 6)]), at[2])
            old, losses = values[at], []
            for step in (1e-3, -1e-3):
                values[at] = old + step
                losses.append(net.gradients(codes, target, weight)[0])
            values[at] = old
            assert abs((losses[0] - losses[1]) / 2e-3 - grad[name][at]) < 2e-3, name


def test_every_position_of_every_row_counts_once():
    text = next(blocks(pa.array(["ab" * 100, None, "", "x" * 64, "é"])))
    codes, filled, row = segments(text)
    assert np.bincount(row, weights=filled, minlength=5).tolist() == [200, 0, 0, 64, 2]
    p = pooled(Network(["a", "b"]), text)
    assert np.allclose(p.sum(axis=1), [1, 0, 0, 1, 1], atol=1e-5)


def test_held_out_accuracy_and_no_use_of_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    net = train(docs)
    got = predicted(docs, net).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert got[0] >= 0.98 and got[1] > 100
    blind = docs.select((F.col("doc_id") + 1).alias("doc_id"), "text", F.lit("xx").alias("lang"))
    same = predicted(blind, net).select((F.col("doc_id") - 1).alias("doc_id"), "lang_pred", "score")
    assert same.exceptAll(predicted(docs, net).select("doc_id", "lang_pred", "score")).count() == 0
    assert identified(docs, network=net).exceptAll(docs).count() == 0


def test_odd_rows(spark):
    rows = [(i, f"the cat of number {i} and a house", "en") for i in range(30)] + [(i, f"der hund und das haus nummer {i}", "de") for i in range(30, 60)]
    rows += [(100, None, "en"), (101, "", None), (102, "12 34 %%", "de"), (None, "the house", "en"), (3, rows[3][1], "en"), (104, "the cat " * 40_000, None)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("score", F.lit(1)).withColumn("_language_", F.lit("x"))
    net = train(docs, steps=150)
    got = predicted(docs, net).collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: r["lang_pred"] for r in got if r["doc_id"] in (100, 101, 102)} == {100: "und", 101: "und", 102: "und"}
    assert {r["lang_pred"] for r in got} <= {"en", "de", "und"} and all(0 <= r["score"] <= 1 for r in got)
    kept = identified(docs, network=net)
    assert kept.columns == docs.columns and kept.where("doc_id in (100, 101, 102)").count() == 0
    empty = spark.createDataFrame([], DOCS)
    assert predicted(empty).collect() == [] and identified(empty).collect() == []
    unlabelled = spark.createDataFrame([(1, "words", None)], DOCS)
    assert predicted(unlabelled).first()["lang_pred"] == "und"
    unlabelled = spark.createDataFrame([(1, "words", None), (2, "12", None), (3, None, None), (None, "more", None)], DOCS)
    assert sorted(r["text"] for r in identified(unlabelled).collect()) == ["more", "words"]


def test_every_label_is_learned(spark):
    rows = [(i, f"{chr(0x4E00 + i % 300) * 9} {i % 300}", f"l{i % 300}") for i in range(900)]
    assert len(train(spark.createDataFrame(rows, DOCS), steps=1).labels) == 300
