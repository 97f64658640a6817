import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tradewind.llm.arrays import blocks
from tradewind.llm.quality import CHUNK, STEP, WIDTH, Chunks, Network, _padded, scored, train

DOCS, LABELS = "doc_id long, text string", "doc_id long, quality int"
SF = "/root/testdata/sf0.01"


def plain_score(net, data):
    """One document's probability, place by place."""
    starts = [0]
    while starts[-1] + CHUNK < len(data):
        starts.append(starts[-1] + STEP)
    answers = []
    for s in starts:
        part = data[s : s + CHUNK]
        part = part + bytes(max(0, WIDTH - len(part)))
        answers.append(np.max([sum(net.filters[j, part[p + j]].astype(float) for j in range(WIDTH)) for p in range(len(part) - WIDTH + 1)], axis=0))
    h = np.tanh(answers)
    x = np.concatenate([h.max(axis=0), h.mean(axis=0)]) @ net.output + net.bias[0]
    return 1 / (1 + np.exp(-x))


def test_gradients_against_differences():
    rng = np.random.default_rng(0)
    net = Network(3)
    for name in ("filters", "output", "bias"):
        setattr(net, name, getattr(net, name).astype(np.float64) * 5)
    text = next(blocks(pa.array(["ab" * 300, "", "abc", "hello world " * 40, "b" * 256])))
    chunks = Chunks(text)
    size = chunks.end - chunks.start
    codes, target = _padded(text.data, chunks.start, size, CHUNK), np.array([1, 0, 1, 0, 1])
    _, grad = net.gradients(codes, size, chunks.first, target)
    for name in grad:
        values = getattr(net, name)
        for _ in range(20):
            at = tuple(rng.integers(0, n) for n in values.shape)
            if name == "filters":
                at = (at[0], int(rng.choice(list(b"ab helo\0"))), at[2])
            old, losses = values[at], []
            for step in (1e-5, -1e-5):
                values[at] = old + step
                losses.append(net.gradients(codes, size, chunks.first, target)[0])
            values[at] = old
            assert abs((losses[0] - losses[1]) / 2e-5 - grad[name][at]) < 1e-5, name


@pytest.mark.parametrize("size", [0, 1, 5, 6, 7, 255, 256, 257, 448, 449, 5000])
def test_chunks_overlap_and_cover_the_text(size):
    chunks = Chunks(next(blocks(pa.array(["x" * 10, "y" * size, "z"]))))
    mine = chunks.row == 1
    start, end = chunks.start[mine] - 10, chunks.end[mine] - 10
    assert start[0] == 0 and end[-1] == size and (start[1:] == start[:-1] + STEP).all() and (start[1:] < end[:-1]).all()
    assert len(start) == 1 or (end - start >= WIDTH).all()


def test_scores_equal_the_plain_sum():
    texts = ["", None, "a", "short", "exactly", "Zwölf Boxkämpfer jagen Viktor " * 30, "x" * 257, "y" * 448, "漢字" * 400]
    net = Network()
    net.filters *= 10
    for size in (1, 1 << 20):
        got = np.concatenate([net.scores(part) for part in blocks(pa.array(texts), size)])
        assert np.allclose(got, [plain_score(net, (t or "").encode()) for t in texts], atol=1e-4)


def test_held_out_accuracy_and_no_use_of_labels(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    net = train(docs, labels)
    rows = scored(docs, labels, network=net).join(labels, "doc_id").where("held_out").select("score", "predicted", "quality").collect()
    good, bad = [r["score"] for r in rows if r["quality"] == 1], [r["score"] for r in rows if r["quality"] == 0]
    assert len(good) > 40 and len(bad) > 5
    assert np.mean([[g > b for b in bad] for g in good]) >= 0.97
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) >= 0.95
    blind = docs.select((F.col("doc_id") + 1).alias("doc_id"), "text")
    same = scored(blind, labels, network=net).select((F.col("doc_id") - 1).alias("doc_id"), "score", "predicted")
    assert same.exceptAll(scored(docs, labels, network=net).select("doc_id", "score", "predicted")).count() == 0


def test_held_out_labels_are_not_learned_from(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    turned = labels.withColumn("quality", F.when(held_out, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = train(docs, labels, steps=5), train(docs, turned, steps=5)
    assert (a.filters == b.filters).all() and (a.bias == b.bias).all()


def test_odd_rows(spark):
    rows = [(i, f"some fine words, number {i}." if i % 2 else f"BUY!! NOW!! {i}$$$") for i in range(120)]
    rows += [(200, None), (201, ""), (202, "a"), (None, "words"), (3, rows[3][1]), (203, "plain words and more. " * 20_000)]
    labels = [(i, i % 2) for i in range(110)] + [(0, None), (None, 1), (1, 0), (1, 1), (999, 1)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("quality", F.lit("x")).withColumn("y", F.lit(0)).withColumn("score", F.lit(0))
    marks = spark.createDataFrame(labels, LABELS).withColumn("text", F.lit("clash"))
    got = scored(docs, marks).collect()
    assert sorted(r["doc_id"] or -1 for r in got) == sorted(r[0] or -1 for r in rows) and [r["held_out"] for r in got if r["doc_id"] is None] == [None]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    by_id = {r["doc_id"]: r["predicted"] for r in got}
    assert by_id[203] == 1 and np.mean([by_id[i] == i % 2 for i in range(120)]) > 0.9
    assert len({r["score"] for r in got if r["doc_id"] in (200, 201)}) == 1


def test_nothing_labelled_and_empty_tables(spark):
    docs, none = spark.createDataFrame([(1, "words"), (2, None)], DOCS), spark.createDataFrame([], LABELS)
    assert [(r["score"], r["predicted"]) for r in scored(docs, none).collect()] == [(0.5, 1)] * 2
    one_value = spark.createDataFrame([(i, 1) for i in range(9)], LABELS)
    assert all(0 <= r["score"] <= 1 for r in scored(docs, one_value).collect())
    assert scored(spark.createDataFrame([], DOCS), none).collect() == []
