"""License scan by diagonal voting.

All rolling k-grams of a document's words are joined to the positions of the same k-grams in license templates. A hit votes for
its offset diagonal (position in the document less position in the template). Hashes bring words together, the words decide: a hit of other
words than the template's has no vote. Votes are the set of template positions, which is no longer than the template. Diagonals that are
neighbours are merged, which follows small insertions and omissions, and a merged span counts if its verified words cover enough of the template.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Phrases whose exact places are counted, with their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Well-known sentences of public licenses (lower case, words only) and the labels they stand for.
TEMPLATES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "released under the mit license": "mit",
    "licensed under the apache license version 2 0": "apache-2",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis": "apache-2",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "creative commons attribution noncommercial 4 0 international license": "cc-by-nc",
    "creative commons attribution 4 0 international license": "cc-by",
    "creative commons attribution sharealike 4 0 international license": "cc-by-sa",
    "licensed under the gnu general public license version 3": "gpl-3",
    "terms of the gnu general public license as published by the free software foundation either version 3": "gpl-3",
    "gnu general public license version 2": "gpl-2",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "redistribution and use in source and binary forms with or without modification are permitted provided that": "bsd",
    "this source code form is subject to the terms of the mozilla public license": "mpl-2",
    "this is free and unencumbered software released into the public domain": "unlicense",
}
K = 3
#: Template k-grams up to which they are sent to every task (some 50 MB); more are joined by a shuffle.
BROADCAST_GRAMS = 500_000
_WORD_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Rows of no license that keep documents without a hit; as many keys, so that none gathers all documents.
_SENTINELS = 1024


def words(text: Column) -> Column:
    """Words of a text: runs outside ASCII signs and blanks, A-Z lower-cased."""
    lowered = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(lowered, _WORD_GAP), lambda w: w != "")


def _grams(w: Column) -> Column:
    """(hash, words) of the k-grams of a word array; the array is named once, so it is computed once."""
    gram = lambda v, i: F.struct(
        F.xxhash64(*[v[i + j] for j in range(K)]).alias("gram"), F.concat_ws(" ", *[v[i + j] for j in range(K)]).alias("said")
    )
    return F.transform(
        F.array(w),
        lambda v: F.when(F.size(v) < K, F.array().cast("array<struct<gram: bigint, said: string>>")).otherwise(
            F.transform(F.sequence(F.lit(0), F.size(v) - K), lambda i: gram(v, i))
        ),
    )[0]


def _literals(spark: SparkSession, labels: dict[str, str]) -> DataFrame:
    """Rows (words, label) as literals of the plan, which need no Python worker."""
    rows = [F.struct(F.lit(text).alias("words"), F.lit(label).alias("label")) for text, label in labels.items()]
    return spark.range(1).select(F.inline(F.array(*rows)))


def public_templates(spark: SparkSession) -> DataFrame:
    """Rows (words, label) of :data:`TEMPLATES`."""
    return _literals(spark, TEMPLATES)


def _positions(templates: DataFrame) -> DataFrame:
    """Positions of all template k-grams, those of the phrases included."""
    spark = templates.sparkSession
    base = _literals(spark, PHRASES).withColumn("base", F.lit(True))
    given = templates.select(F.col("words").cast("string"), F.col("label").cast("string"), F.lit(False).alias("base"))
    frame = base.union(given.where("label IS NOT NULL").distinct()).select("label", "base", words(F.col("words")).alias("w"))
    # A template is named by what it says, so that its name does not depend on the order of rows.
    name = F.sha2(F.to_json(F.struct("base", "label", "w")), 256)
    frame = frame.select(name.alias("template"), "label", "base", F.size("w").alias("t_words"), F.posexplode(_grams(F.col("w"))).alias("t_pos", "g"))
    none = spark.range(_SENTINELS).select(
        F.lit("").alias("template"), F.lit(None).cast("string").alias("label"), F.lit(False).alias("base"), F.lit(0).alias("t_words"),
        F.lit(0).alias("t_pos"), F.col("id").alias("gram"), F.lit("").alias("t_said"),
    )
    return frame.select("template", "label", "base", "t_words", "t_pos", "g.gram", F.col("g.said").alias("t_said")).distinct().union(none)


def scanned(docs: DataFrame, least: float = 0.8, slack: int = 3, templates: DataFrame | None = None) -> DataFrame:
    """Rows (doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score), one per row of ``docs``.

    n_base counts the exact places of the phrases, first_word and last_word are their least and greatest start. A merged span adds its
    template's label from a share ``least`` of its words on, if it is not longer than one and a half templates; diagonals up to ``slack`` apart
    are merged. score is the greatest share that counted (1 for a phrase), else 0. Labels are distinct, sorted, comma-joined, and empty
    where there are none. A null text is empty; repeated rows and ids give a row each; other columns are ignored.

    ``templates`` are rows (words, label), cut into words like the documents; by default :func:`public_templates`. They may be whole license texts.
    One without a label, or of fewer than three words, is never found; repeated ones count once.
    """
    spark = docs.sparkSession
    targets = _positions(public_templates(spark) if templates is None else templates)
    if targets.limit(BROADCAST_GRAMS + 1).count() <= BROADCAST_GRAMS:
        targets = F.broadcast(targets)
    row = F.monotonically_increasing_id()
    cut = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row.alias("row"), words(F.col("text").cast("string")).alias("w"))
    # Element 0 meets a row of no license, so that documents without a hit stay.
    first = F.array(F.struct(F.pmod("row", F.lit(_SENTINELS)).cast("long").alias("gram"), F.lit("").alias("said")))
    both = F.transform(F.array(F.col("w")), lambda v: F.struct(F.size(v).cast("long").alias("n"), F.concat(first, _grams(v)).alias("g")))[0]
    cut = cut.select("doc_id", "row", both.alias("b"))
    hits = cut.select("doc_id", "row", F.col("b.n").alias("n_words"), F.posexplode("b.g").alias("at", "g"))
    hits = hits.select("doc_id", "row", "n_words", "at", "g.gram", "g.said").join(targets, "gram").where("said = t_said AND (at = 0) = (template = '')")
    keys = ["doc_id", "row", "n_words", "template", "label", "base", "t_words"]
    votes = hits.groupBy(*keys, (F.col("at") - 1 - F.col("t_pos")).alias("diagonal")).agg(F.collect_set("t_pos").alias("votes"))
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    part = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(order) > F.when(F.col("base"), 0).otherwise(slack)).cast("int"), F.lit(0))
    spans = votes.withColumn("new", part).withColumn("span", F.sum("new").over(order))
    # One position at a time, so that a span of many diagonals holds each position once.
    spans = spans.withColumn("vote", F.explode("votes")).groupBy(*keys, "span").agg(F.collect_set("vote").alias("votes"), F.min("diagonal").alias("start"), F.max("diagonal").alias("last"))
    # The template's words under the voting grams.
    covered = F.size(F.array_distinct(F.flatten(F.transform("votes", lambda p: F.sequence(p, p + (K - 1))))))
    share = F.when(F.col("t_words") > 0, covered / F.col("t_words")).otherwise(F.lit(0.0))
    spans = spans.withColumn("share", share).withColumn(
        "counts", F.when(F.col("base"), F.col("share") == 1).otherwise((F.col("share") >= least) & (F.col("last") - F.col("start") <= F.col("t_words") / 2))
    )
    place = F.col("counts") & F.col("base")
    labels = lambda which: F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")
    return spans.groupBy("row", "doc_id", "n_words").agg(
        F.count_if(place).alias("n_base"),
        F.min(F.when(place, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(place, F.col("start"))).cast("long").alias("last_word"),
        labels(place).alias("base_labels"),
        labels(F.col("counts")).alias("labels"),
        F.coalesce(F.max(F.when(F.col("counts"), F.col("share"))), F.lit(0.0)).alias("score"),
    ).drop("row")
