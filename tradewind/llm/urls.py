"""URL filter: host and path rules, and a character language-model ratio for what no rule covers.

Two smoothed variable-order Markov models are counted from the URLs that the rules accept and reject: the
probability of a character after its longest known context is interpolated with those after shorter ones (weights by the
number of different characters seen after a context). A URL's score is the mean difference of the two
log-likelihoods over its characters; the least score that is accepted is calibrated on labelled URLs kept out of the counts.
Everything is DataFrame expressions: n-grams are counted before any shuffle, each distinct n-gram is scored
once, and URLs add up the scores of theirs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.arrays import written

# Fixed values: (verdict, host, path). A rule fits its host and all subdomains where the path starts with its path.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
ORDER = 5
#: Up to this many distinct n-grams (about 30 bytes each) are sent to all executors; beyond, both sides are shuffled with a salt.
SENT_GRAMS, SALTS = 300_000, 16
#: Scores are calibrated in steps of this many nats, within 20 of zero.
STEP = 0.01
_START = "\u0002"


def host(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    after = _after_scheme(url)
    return F.translate(F.regexp_extract(after, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.char_length(url))).otherwise(F.lit(""))


def matching_rule(host_name: Column, url_path: Column, rules: list[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text and as verdict; nulls where none does."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))
    texts, verdicts = [], []
    for verdict, name, start in ordered:
        fits = ((host_name == name) | F.endswith(host_name, F.lit("." + name))) & F.startswith(url_path, F.lit(start))
        texts.append(F.when(fits, F.lit(name + start)))
        verdicts.append(F.when(fits, F.lit(verdict)))
    return F.coalesce(*texts, F.lit(None).cast("string")), F.coalesce(*verdicts, F.lit(None).cast("string"))


def _grams(base: DataFrame, *columns: str) -> DataFrame:
    """One row for each character of each URL: the character after its ORDER - 1 predecessors."""
    n = F.char_length("_url")
    padded = F.concat(F.lit(_START * (ORDER - 1)), F.col("_url"))
    every = base.where(n > 0).select(*columns, padded.alias("_padded"), n.alias("_n"))
    return every.select(*columns, F.explode(F.transform(F.sequence(F.lit(1), F.col("_n")), lambda i: F.substr("_padded", i, F.lit(ORDER)))).alias("gram"))


def _gram_scores(counts: DataFrame) -> DataFrame:
    """Log-likelihood difference of every distinct n-gram; ``counts`` has gram, a, r (times in accepted and rejected URLs)."""
    suffixes = F.transform(F.sequence(F.lit(1), F.lit(ORDER)), lambda k: F.struct(k.alias("k"), F.substring("gram", -k, k).alias("suffix")))
    pairs = written(counts.select("gram", "a", "r", F.inline(suffixes)), "suffixes")
    model = pairs.where("a + r > 0").groupBy("suffix").agg(F.sum("a").alias("na"), F.sum("r").alias("nr"))
    model = written(model.withColumn("context", F.expr("left(suffix, char_length(suffix) - 1)")), "model")
    contexts = model.groupBy("context").agg(
        F.sum("na").alias("ca"), F.count_if(F.col("na") > 0).alias("ta"), F.sum("nr").alias("cr"), F.count_if(F.col("nr") > 0).alias("tr")
    )
    joined = (
        pairs.select("gram", "k", "suffix", F.expr("left(suffix, char_length(suffix) - 1)").alias("context"))
        .join(model.drop("context"), "suffix", "left")
        .join(contexts, "context", "left")
        .na.fill(0, ["na", "nr", "ca", "ta", "cr", "tr"])
    )
    wide = joined.groupBy("gram").agg(
        *[F.max(F.when(F.col("k") == k, F.col(c))).alias(f"{c}{k}") for k in range(1, ORDER + 1) for c in ("na", "nr", "ca", "ta", "cr", "tr")]
    )

    def probability(n: str, c: str, t: str) -> Column:
        p = F.lit(1 / 256)
        for k in range(1, ORDER + 1):
            seen = F.col(f"{c}{k}") > 0
            p = F.when(seen, (F.col(f"{n}{k}") + F.col(f"{t}{k}") * p) / (F.col(f"{c}{k}") + F.col(f"{t}{k}"))).otherwise(p)
        return F.ln(p)

    return wide.select("gram", (probability("na", "ca", "ta") - probability("nr", "cr", "tr")).alias("ratio"))


def _threshold(scored: DataFrame) -> DataFrame:
    """One row: the score that best parts held-out accepted and rejected URLs (mean of both error shares); 0 where either is missing."""
    limit = 20
    bins = (
        scored.where("_fold = 0 and _label is not null and score is not null")
        .select(F.floor(F.greatest(F.lit(-limit), F.least(F.lit(limit), F.col("score"))) / STEP).alias("bin"), "_label")
        .groupBy("bin").agg(F.count_if("_label").alias("a"), F.count_if(~F.col("_label")).alias("r"))
    )
    # At most 2 * limit / STEP + 1 rows from here on.
    below = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cut = bins.select(
        "bin", F.coalesce(F.sum("a").over(below), F.lit(0)).alias("lost"), F.sum("a").over(whole).alias("all_a"),
        (F.sum("r").over(whole) - F.coalesce(F.sum("r").over(below), F.lit(0))).alias("let"), F.sum("r").over(whole).alias("all_r"),
    ).where("all_a > 0 and all_r > 0")
    error = F.col("lost") / F.col("all_a") + F.col("let") / F.col("all_r")
    best = cut.agg(F.min_by(F.col("bin") * F.lit(STEP), F.struct(error, F.abs("bin"), "bin")).alias("least"))
    return best.select(F.coalesce("least", F.lit(0.0)).alias("least"))


def judged(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """Rows (page_id, host, path, rule, verdict, score), one per row of ``pages``.

    The verdict is that of the longest fitting rule, otherwise ``allow`` from the calibrated score on. A null or empty URL has no
    characters and scores 0; without labelled URLs all score 0 and are allowed. Repeated rows and
    repeated or null ids give a row each; other columns are ignored; an empty table gives no rows.
    """
    url = F.col(f"`{url_column}`").cast("string")
    base = pages.select(F.col(f"`{id_column}`").alias(id_column), F.coalesce(url, F.lit("")).alias("_url"))
    base = base.select("*", host(F.col("_url")).alias("host"), path(F.col("_url")).alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    base = base.select(
        "*", rule.alias("rule"), verdict.alias("_verdict"), (verdict == "allow").alias("_label"),
        (F.conv(F.substring(F.md5(F.col("_url").cast("binary")), 1, 8), 16, 10).cast("long") % 5).alias("_fold"), F.monotonically_increasing_id().alias("_row"),
    )
    base = written(base, "urls")
    learned = F.col("_label").isNotNull() & (F.col("_fold") != 0)
    counts = _grams(base, "_label", "_fold").groupBy("gram").agg(
        F.count_if(learned & F.col("_label")).alias("a"), F.count_if(learned & ~F.col("_label")).alias("r")
    )
    ratios = written(_gram_scores(counts), "ratios")
    grams = _grams(base, "_row")
    if ratios.count() <= SENT_GRAMS:
        joined = grams.join(F.broadcast(ratios), "gram")
    else:
        salted = ratios.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = grams.withColumn("_salt", F.pmod("_row", F.lit(SALTS)).cast("int")).join(salted, ["gram", "_salt"])
    scores = joined.groupBy("_row").agg(F.avg("ratio").alias("score"))
    scored = written(base.join(scores, "_row", "left").withColumn("score", F.coalesce("score", F.lit(0.0))), "scored")
    least = _threshold(scored).scalar()
    method = F.when(F.col("score") >= least, F.lit("allow")).otherwise(F.lit("block"))
    return scored.select(id_column, "host", "path", "rule", F.coalesce("_verdict", method).alias("verdict"), F.round("score", 6).alias("score"))
