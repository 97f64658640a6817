import math
import re
from collections import Counter, defaultdict
from hashlib import md5

from pyspark.sql import functions as F

from tradewind.llm import urls
from tradewind.llm.urls import ORDER, RULES, STEP, judged

PAGES = "page_id long, url string"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3 :]
    name = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(name) :]).group()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in name), path


def fold(url):
    return int(md5(url.encode()).hexdigest()[:8], 16) % 5


def rule(host, path):
    fits = [r for r in RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    best = max(fits, key=lambda r: len(r[1] + r[2]), default=None)
    return (best[1] + best[2], best[0]) if best else (None, None)


def plain(rows):
    """The whole judgement in plain Python: counts, interpolated probabilities, calibration."""
    base = []
    for i, url in rows:
        host, path = parts(url)
        base.append((i, url or "", host, path, *rule(host, path)))
    counts = {True: defaultdict(Counter), False: defaultdict(Counter)}
    for _, url, _, _, _, verdict in base:
        if verdict and fold(url):
            padded = "\2" * (ORDER - 1) + url
            for p in range(ORDER - 1, len(padded)):
                for k in range(ORDER):
                    counts[verdict == "allow"][padded[p - k : p]][padded[p]] += 1

    def log_p(label, padded, p):
        value = 1 / 256
        for k in range(ORDER):
            seen = counts[label].get(padded[p - k : p])
            if seen:
                value = (seen[padded[p]] + len(seen) * value) / (seen.total() + len(seen))
        return math.log(value)

    def score(url):
        padded = "\2" * (ORDER - 1) + url
        each = [log_p(True, padded, p) - log_p(False, padded, p) for p in range(ORDER - 1, len(padded))]
        return sum(each) / len(each) if each else 0.0

    scored = [(*b, score(b[1])) for b in base]
    held = [(math.floor(max(-20, min(20, s)) / STEP), v == "allow") for _, u, _, _, _, v, s in scored if v and fold(u) == 0]
    accepted, rejected = sum(a for _, a in held), sum(not a for _, a in held)
    least = 0.0
    if accepted and rejected:
        errors = [(sum(a and x < b for x, a in held) / accepted + sum(not a and x >= b for x, a in held) / rejected, abs(b), b) for b in {x for x, _ in held}]
        least = min(errors)[2] * STEP
    return {i: (h, p, r, v or ("allow" if s >= least else "block"), s) for i, _, h, p, r, v, s in scored}, least


def compare(got, rows):
    want, least = plain(rows)
    assert len(got) == len(rows)
    for r in got:
        host, path, name, verdict, score = want[r["page_id"]]
        assert (r["host"], r["path"], r["rule"]) == (host, path, name)
        assert abs(r["score"] - score) < 1e-6
        if name or abs(score - least) > 1e-9:
            assert r["verdict"] == verdict


def test_whole_table_both_ways(spark, monkeypatch):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = [(r["page_id"], r["url"]) for r in pages.collect()]
    got = judged(pages).collect()
    compare(got, rows)
    monkeypatch.setattr(urls, "SENT_GRAMS", 0)
    again = {r["page_id"]: r for r in judged(pages).collect()}
    assert all(again[r["page_id"]]["verdict"] == r["verdict"] and abs(again[r["page_id"]]["score"] - r["score"]) < 2e-6 for r in got)


def test_odd_rows(spark):
    odd = [None, "", "no scheme", "x://", "HTTP://A.ÉX.NET/en", "https://example.net/en/x", "https://example.net/en", "ftp://badexample.net/en/", "a://org/fr/#x", "a://org?/fr/", "a://b.org/fr/\n2",
           "a://x.example.com/de/?q", "a://u:p@example.com:80/de/", "://net/", "a://b://net/", "a://net", "a://é/" + "p" * 20_000, "a://.net/x"]
    rows = list(enumerate(odd)) + [(1000 + i, f"http://h{i % 7}.example.{['net', 'org'][i % 2]}/fr/{i}") for i in range(60)]
    df = spark.createDataFrame(rows, PAGES).withColumn("host", F.lit("h")).withColumn("gram", F.lit(1)).withColumn("_url", F.lit("u"))
    compare(judged(df).collect(), rows)
    twice = spark.createDataFrame([(1, "a://net/"), (1, "a://net/"), (None, "a://x.org/fr/"), (None, None)], PAGES)
    assert sorted(((r["page_id"] or 0), r["verdict"]) for r in judged(twice).collect()) == [(0, "allow"), (0, "allow"), (1, "block"), (1, "block")]
    assert judged(spark.createDataFrame([], PAGES)).collect() == []
