import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradewind.llm.arrays import blocks
from tradewind.llm.packing import Encoder, hilbert_key, packed

DOCS = "doc_id long, text string"


def test_hilbert_neighbours_touch():
    for dimensions, levels in ((2, 4), (3, 3), (4, 2)):
        grid = np.stack([g.reshape(-1) for g in np.meshgrid(*[np.arange(1 << levels)] * dimensions)], axis=1)
        keys = hilbert_key(grid, levels)
        assert sorted(keys) == list(range(len(grid)))
        line = grid[np.argsort(keys)]
        assert (np.abs(np.diff(line, axis=0)).sum(axis=1) == 1).all()


ODD = ["", " ", "  a", "a  b", "a \n b", "\n\nx y", " x", "x ", "x   ", "don't we'll", "a b  c", "日本 語", "1 2  33", "tab\t end", "a \t\tb", "ﬁ ñ é è", "<|endoftext|> a", "a b<|endoftext|>c  d <|endoftext|>", "<|endoftext| > x", "a \x1c b", "　 x"]


def reference_ids(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def encoded(encoder, texts):
    return [np.frombuffer(x, encoder.width).tolist() for part in blocks(pa.array(texts, pa.string())) for x in encoder.encode(part)]


ENCODER = Encoder(None)


def test_remembered_words_give_the_tokenizers_ids():
    import duckdb

    texts = ODD + [r[0] for r in duckdb.sql("select text from '/root/testdata/sf0.01/documents.parquet'").fetchall()]
    encoder = Encoder(None)
    for _ in range(2):
        assert encoded(encoder, [*texts, None]) == [*reference_ids(texts), []]


@settings(deadline=None, max_examples=200)
@given(st.lists(st.one_of(st.none(), st.text("ab'.5 \n\t\u00a0\u3000é漢\x1c\x85\u2003", max_size=25)), max_size=5))
def test_odd_spaces(texts):
    assert encoded(ENCODER, texts) == reference_ids(texts)


def test_a_special_token_in_a_text_is_one_id_and_memory_stays_bounded(monkeypatch):
    from tradewind.llm import packing

    monkeypatch.setattr(packing, "REMEMBERED", 50)
    encoder = Encoder(None)
    ids = lambda t: encoded(encoder, [t])[0]
    assert 50256 in ids("one <|endoftext|> two")
    for i in range(40):
        text = "the same words again " + " ".join(f"w{i}x{j}" for j in range(30))
        assert [ids(text)] == reference_ids([text])
        assert len(encoder.keys) < 120 and len(encoder.tokens) < 1000


def check(rows, pieces, length):
    want = sorted([[*ids, 1] for ids in reference_ids([t for _, t in rows])])
    by = {}
    for p in pieces:
        by.setdefault((p["doc_id"]), []).append(p)
    ids = {}
    for (d, _), line in zip(rows, reference_ids([t for _, t in rows])):
        ids.setdefault(d, []).append([*line, 1])
    for d, own in by.items():
        assert len({str(x) for x in ids[d]}) == 1 and sum(p["length"] for p in own) == sum(map(len, ids[d]))
        for p in own:
            part = np.array(ids[d][0][p["start"] : p["start"] + p["length"]], "<u4")
            assert p["doc_tokens"] == len(ids[d][0]) and p["ids_crc32"] == zlib.crc32(part.tobytes()) and len(part) == p["length"]
    sequences = {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    total = sum(map(len, want))
    assert len(sequences) == -(-total // length)
    for s, parts in sequences.items():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == (length if s < len(sequences) - 1 else total - length * (len(sequences) - 1))


def test_pieces(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check([(r["doc_id"], r["text"]) for r in docs.collect()], packed(docs).collect(), 2048)


def test_odd_rows(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100, None), (None, "x y"), (3, ODD[3]), (101, "word " * 30_000)]
    df = spark.createDataFrame(rows, DOCS).withColumn("row", F.lit(1)).withColumn("key", F.lit("k")).repartition(5)
    check(rows, packed(df, 64).collect(), 64)
    assert packed(spark.createDataFrame([], DOCS)).collect() == []


def test_neighbours_share_words(spark):
    rows = [(i, " ".join(f"{'ab'[i % 2]}{(i * 7 + j) % 9}" for j in range(60))) for i in range(200)]
    got = sorted(packed(spark.createDataFrame(rows, DOCS), 256).collect(), key=lambda p: (p["sequence_id"], p["offset"]))
    kinds = [p["doc_id"] % 2 for p in got if p["start"] == 0]
    assert sum(a != b for a, b in zip(kinds, kinds[1:])) < 40


def test_sequences_hold_the_token_ids(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100, None), (101, "word " * 3_000), (102, "日本語" * 400)]
    pieces = packed(spark.createDataFrame(rows, DOCS).repartition(3), 64).collect()
    line = [x for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])) for x in p["ids"]]
    want = {d: [*ids, 1] for (d, _), ids in zip(rows, reference_ids([t for _, t in rows]))}
    docs = sorted((p["sequence_id"], p["offset"], p["doc_id"]) for p in pieces if p["start"] == 0)
    assert line == [x for _, _, d in docs for x in want[d]] and len(docs) == len(rows)
    assert all(p["ids_crc32"] == zlib.crc32(np.array(p["ids"], "<u4").tobytes()) for p in pieces)
