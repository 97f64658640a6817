import random

import numpy as np
import pytest
from brute import words
from pyspark.sql import functions as F

from tradewind.llm import decontamination
from tradewind.llm.arrays import U64
from tradewind.llm.decontamination import Items, contaminated, decontaminated

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def similar(docs, items, k=5, least=0.8):
    """(doc_id, item_id) -> best weighted similarity of any window of the item's length, by plain counting."""
    import math
    from collections import Counter

    cut = lambda w: [tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    own = {i: words(t, True) for i, t in items if words(t, True)}
    grams = {i: cut(w) for i, w in own.items()}
    df = Counter(g for i in grams for g in set(grams[i]))
    weight = lambda g: 1 + math.log(len(own) / df.get(g, 1))
    out = {}
    for d, t in docs:
        w = words(t, True)
        for i, item in own.items():
            for p in range(len(w) - len(item) + 1):
                a, b = Counter(cut(w[p : p + len(item)])), Counter(grams[i])
                union = sum(weight(g) * n for g, n in (a | b).items())
                s = sum(weight(g) * n for g, n in (a & b).items()) / union
                if s >= least - 1e-9:
                    out[d, i] = max(s, out.get((d, i), 0))
    return out


def test_against_all_windows(spark):
    rng = random.Random(1)
    vocabulary = [f"W{i}" for i in range(300)]
    item_words = [rng.choices(vocabulary, k=rng.randrange(5, 40)) for _ in range(30)]
    item_words.append(item_words[0][:])
    items = [(i, " ".join(w)) for i, w in enumerate(item_words)] + [(90, "two words"), (91, ""), (92, None), (93, " \n")]
    docs = []
    for d in range(120):
        w = rng.choices(vocabulary, k=rng.randrange(0, 120))
        if rng.random() < 0.7:
            x = rng.choice(item_words)[:]
            for _ in range(rng.choice([0, 0, 0, 1, 2])):
                x[rng.choice([0, 1, -1, -2, rng.randrange(len(x))])] = "changed"
            at = rng.randrange(len(w) + 1)
            w[at:at] = [v.lower() for v in x]
        docs.append((d, " ".join(w)))
    docs += [(200, None), (201, ""), (202, "Two\twords"), (203, "here are two words in a longer text"), (204, items[3][1])]
    want = similar(docs, items)
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()}
    assert set(got) == set(want) and len(want) > 50
    assert all(abs(got[x] - want[x]) < 1e-5 for x in want)


@pytest.mark.parametrize("n", [60, 4000])
def test_index_finds_all_prints_within_the_radius(n):
    """With few items all values of an index are compared, with many the near ones are looked up."""
    rng = np.random.default_rng(2)
    items = Items.of([(i, " ".join(f"w{rng.integers(0, 50)}" for _ in range(12))) for i in range(n)], 5, 0.8, 19)
    index = items.by_length[12]
    prints = index.prints[rng.integers(0, n, 300)].copy()
    for i in range(300):
        for b in rng.choice(64, rng.integers(0, 30), replace=False):
            prints[i] ^= U64(1) << U64(b)
    distance = np.bitwise_count(prints[:, None] ^ index.prints[None, :])
    window, item, found = index.search(prints, 19)
    assert sorted(zip(window.tolist(), item.tolist())) == sorted((i, int(index.members[j])) for i, j in np.argwhere(distance <= 19))
    assert (found == distance[window, np.searchsorted(index.members, item)]).all()


def test_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    benchmark = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    found = contaminated(docs, benchmark)
    ids = {r["doc_id"] for r in found.collect()}
    texts = {r["doc_id"]: " ".join(words(r["text"], True)) for r in docs.collect()}
    items = [" ".join(words(r["text"], True)) for r in benchmark.collect()]
    assert {d for d, t in texts.items() if any(f" {i} " in f" {t} " for i in items)} <= ids
    odd = docs.withColumn("_leaks_", F.lit(1)).withColumn("item_id", F.lit(2))
    kept = decontaminated(odd, benchmark)
    assert kept.columns == odd.columns and kept.count() == docs.count() - len(ids)
    empty = spark.createDataFrame([], ITEMS)
    assert contaminated(docs, empty).collect() == [] and decontaminated(docs, empty).count() == docs.count()
    assert contaminated(spark.createDataFrame([], DOCS), benchmark).collect() == []


def test_blocks_change_no_result(spark, monkeypatch):
    rng = random.Random(4)
    common = [f"c{i}" for i in range(12)]
    item_words = [common[:8] + [f"i{i}_{j}" for j in range(rng.randrange(3, 12))] for i in range(40)]
    items = [(i, " ".join(w)) for i, w in enumerate(item_words)] + [(0, " ".join(item_words[0])), (50, "two words"), (51, None), (None, "no id here"), (52, " ")]
    docs = [(-1, None), (-2, ""), (-3, "here are two words in a longer text"), (-4, "two words")]
    for d in range(200):
        w = rng.choice(item_words)[:]
        # Some of the words that fill in stand in other items, in other blocks: their shingles weigh less than those of no item.
        for _ in range(rng.choice([0, 1, 1, 2])):
            at = rng.choice([0, len(w) - 1])
            w[at : at + 1] = rng.choice([["changed"], common[8:], rng.choice(item_words)[6:10]])
        docs.append((d // 2, " ".join([f"x{d}"] * rng.randrange(4) + common[: rng.randrange(9)] + w)))
    docs += docs[10:14]
    columns = ["doc_id", "item_id", "first_word", "n_words", "distance", "similarity"]
    df, bench = spark.createDataFrame(docs, DOCS).repartition(3).cache(), spark.createDataFrame(items, ITEMS)

    def run():
        found = sorted(tuple(r[c] for c in columns) for r in contaminated(df, bench).collect())
        return found, sorted(map(str, decontaminated(df, bench).collect()))

    whole, kept = run()
    assert len(whole) > 100 and kept and 0.8 <= min(r[5] for r in whole) < 0.9
    monkeypatch.setattr(decontamination, "BLOCK_ITEMS", 9)
    assert run() == (whole, kept)
