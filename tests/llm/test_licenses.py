import random
import re

from pyspark.sql import functions as F

from tradewind.llm.licenses import PHRASES, TEMPLATES, scanned

DOCS = "doc_id long, text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def base(text):
    w = WORD.findall((text or "").translate(LOWER))
    places = [(i, label) for phrase, label in PHRASES.items() for p in [phrase.split()] for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
    at = [i for i, _ in places]
    return len(w), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def check(got, rows):
    want = {d: base(t) for d, t in rows}
    for r in got:
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == want[r["doc_id"]]
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(","))) and 0 <= r["score"] <= 1
        assert (r["score"] > 0) == (r["labels"] != "") and r["labels"] == ",".join(sorted(set(r["labels"].split(","))))


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = scanned(docs).collect()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert len(got) == len(rows)
    check(got, rows)
    labels = {r["doc_id"]: r["labels"].split(",") for r in got}
    for d, t in rows:
        if "GNU General Public License, version 3" in t:
            assert "gpl-3" in labels[d]
        if not re.search("licen[cs]e|cc by|commons", t, re.I):
            assert labels[d] == [""]


def test_templates_with_small_edits(spark):
    rng = random.Random(2)
    rows, want = [], {}
    for i, (text, label) in enumerate(TEMPLATES.items()):
        w = text.split()
        for j in range(4):
            x = w[:]
            if j == 1 and len(w) > 12:
                del x[5]
            if j == 2 and len(w) > 12:
                x.insert(6, "indeed")
            if j == 3 and len(w) > 12:
                x[-1] = "other"
            noise = lambda: [f"n{rng.randrange(50)}" for _ in range(rng.randrange(0, 80))]
            rows.append((i * 10 + j, "  ".join([*noise(), *x, *noise()]).title()))
            want[i * 10 + j] = label
    got = {r["doc_id"]: r["labels"].split(",") for r in scanned(spark.createDataFrame(rows, DOCS)).collect()}
    assert all(want[d] in got[d] for d in want)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "under the"), (4, "Under-THE mit...License under the mit license"), (5, "cc by nc cc by nc cc"), (6, "é" * 10 + " CC BY-NC ñ"), (7, "w " * 50_000 + "Apache License, Version 2.0")]
    df = spark.createDataFrame(rows, DOCS).withColumn("label", F.lit(1)).withColumn("row", F.lit("r"))
    got = scanned(df).collect()
    assert len(got) == len(rows)
    check(got, rows)
    twice = spark.createDataFrame([(1, "cc by nc"), (1, "cc by nc"), (None, "cc by nc")], DOCS)
    assert [r["n_base"] for r in scanned(twice).collect()] == [1, 1, 1]
    assert scanned(spark.createDataFrame([], DOCS)).collect() == []


def test_whole_license_texts_as_templates(spark):
    long = [f"w{i}" for i in range(3000)]
    given = spark.createDataFrame(
        [(" ".join(long), "long"), (" ".join(long), "long"), ("V0, v1! V2 " + " ".join(f"v{i}" for i in range(3, 80)), "mid"), ("two words", "short"), (None, "none"), ("a b c d", None)],
        "words string, label string",
    )
    v = [f"v{i}" for i in range(80)]
    rows = [(1, " ".join(long)), (2, " ".join(v)), (3, " ".join(v[:64])), (4, " ".join(v[:60])), (5, "two words a b c d"), (6, " ".join(["x", *long[:1000], "y", "y", *long[1000:], *v]))]
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in scanned(spark.createDataFrame(rows, DOCS), templates=given).collect()}
    assert got == {1: ("long", 1.0), 2: ("mid", 1.0), 3: ("mid", 0.8), 4: ("", 0.0), 5: ("", 0.0), 6: ("long,mid", 1.0)}


def test_words_decide_where_hashes_are_equal(spark, monkeypatch):
    rows = [(1, "released under the mit license now"), (2, "words that no license has at all"), (3, ""), (4, "w " * 300 + "cc by nc"), (5, None)]
    docs = spark.createDataFrame(rows, DOCS)
    want = sorted(map(tuple, scanned(docs).collect()), key=str)
    monkeypatch.setattr(F, "xxhash64", lambda *columns: F.lit(5).cast("long"))
    assert sorted(map(tuple, scanned(docs).collect()), key=str) == want


def test_many_templates_are_joined_by_a_shuffle(spark, monkeypatch):
    from tradewind.llm import licenses

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    want = sorted(map(tuple, scanned(docs).collect()))
    monkeypatch.setattr(licenses, "BROADCAST_GRAMS", 0)
    assert sorted(map(tuple, scanned(docs).collect())) == want
