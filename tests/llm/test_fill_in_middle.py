import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradewind.llm.arrays import blocks
from tradewind.llm.fill_in_middle import ERROR, RankIndex, boundaries, infilled, restored

DOCS = "doc_id long, text string"


def brute(doc_id, text):
    """The contract in plain Python: (n, form, prefix_chars, middle_chars, output)."""
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    low, high = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(units), "plain", None, None, text
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if h4 % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(deadline=None, max_examples=60)
@given(st.lists(st.lists(st.integers(0, 400), max_size=80), max_size=6), st.sampled_from([0, 1, 5, ERROR]))
def test_index_gives_every_value_and_predicts_within_its_error(steps, error):
    rows = [np.cumsum(s, dtype=np.int64) for s in steps]
    first = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
    values = np.concatenate([np.zeros(0, np.int64), *rows])
    index = RankIndex(values, first, error)
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    rank = np.arange(len(values)) - first[row]
    assert (index.value(row, rank) == values).all()
    assert (np.abs(index.predicted(row, rank) - values) <= error).all()


def test_even_steps_take_one_segment_and_uneven_ones_few():
    even = np.arange(0, 300_000, 3)
    assert len(RankIndex(even, np.array([0, len(even)])).starts) == 1
    text = ("word " * 20_000 + "." * 100_000 + "verylongword" * 30_000).encode().decode()
    values, first = boundaries(next(blocks(pa.array([text]), 1 << 30)))
    index = RankIndex(values, first)
    assert len(index.starts) < 40 and index.differences.dtype == np.int8
    assert (index.value(np.zeros(len(values), int), np.arange(len(values))) == values).all()


@settings(deadline=None, max_examples=60)
@given(st.lists(st.one_of(st.none(), st.text("aZé<>PSM \n漢𝄞_9", max_size=30)), max_size=6))
def test_boundaries_are_those_of_the_pattern(texts):
    for part in blocks(pa.array(texts, pa.string())):
        values, first = boundaries(part)
        for i in range(part.rows):
            text = texts[part.first + i] or ""
            ends = np.cumsum([0] + [len(u.encode()) for u in re.findall(r"[A-Za-z]+|[^A-Za-z]", text)])
            assert (values[first[i] : first[i + 1]] - part.offsets[i]).tolist() == ends.tolist()


@pytest.fixture(scope="module")
def rows():
    texts = [None, "", "a", "word", "é", "𝄞", "<P> in it", "a<S>", "<<M>", "<S", "<", "a < b <P", " \n\t", "x" * 100_000, "ab, cd. " * 60_000, "漢字かな交じり文" * 50]
    return [(7 * i + j, t) for i, t in enumerate(texts) for j in range(7)] + [(3, "repeated"), (3, "repeated"), (-5, "below zero, too")]


def test_against_plain_python_and_back(spark, rows):
    docs = spark.createDataFrame(rows, DOCS).withColumn("n", F.lit("clash")).withColumn("form", F.lit(1)).withColumn("f", F.lit(2))
    out = infilled(docs)
    got = out.withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    assert sorted(tuple(r)[:6] for r in got if r["form"] != "plain") == sorted((d, *brute(d, t)) for d, t in rows if brute(d, t)[1] != "plain")
    key = lambda r: (r[0], r[1], r[-1])
    assert sorted((tuple(r)[:6] for r in got), key=key) == sorted(((d, *brute(d, t)) for d, t in rows), key=key)
    assert sorted((r["doc_id"], r["back"]) for r in got) == sorted((d, t or "") for d, t in rows)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_missing_ids_and_empty_tables(spark):
    out = infilled(spark.createDataFrame([(None, "one two three"), (None, None)], DOCS))
    got = out.withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    assert sorted(r["back"] for r in got) == ["", "one two three"] and all(r["doc_id"] is None for r in got)
    assert infilled(spark.createDataFrame([], DOCS)).collect() == []


def test_rows_stay_where_they_are(spark):
    plan = infilled(spark.createDataFrame([(1, "a")], DOCS))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
