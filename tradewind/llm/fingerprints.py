"""Order MinHash fingerprints of documents, as column expressions.

A document's k-mers of units are numbered by occurrence, so that repeats differ, and hashed. Units are words, and stretches of
``SPAN`` signs in words that are long or of a script without blanks. One hash serves all ``SKETCHES`` tuples, in place of independent
functions: it is cut into as many buckets, and a tuple is the ``TUPLE`` least hashes from its bucket's start on (going on in the next
buckets, and after the last in the first, where a bucket holds fewer), put back into text order and hashed. Tuples of two texts
agree where the same k-mers are minimal *and* stand in the same order, so moved text counts as edited, unlike in plain MinHash.

Hashes and positions share one 64-bit number (40 and 24 bits), so that arrays of plain numbers are sorted. All steps
are linear but for two sorts. Positions of a text beyond 16.7 million units are kept in steps of 2, 3, ... units.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.arrays import written

KMER, SKETCHES, TUPLE = 2, 64, 2
#: Words of more signs than LONGEST, or with a sign of a script without blanks, are taken by stretches of SPAN signs.
LONGEST, SPAN = 20, 4
_UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsTibetan}]"
_POSITION_BITS = 24
_POSITIONS = (1 << _POSITION_BITS) - 1
_BUCKET_SHIFT = 64 - SKETCHES.bit_length() + 1
#: Ranges of doc_id that are sorted apart: one for each so many rows, and at most RANGES x RANGES.
ROWS_PER_RANGE, RANGES = 1000, 64


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _long(n: int) -> Column:
    return F.lit(n).cast("long")


def _runs(keys: Column, n: Column) -> Column:
    """Starts of the runs of equal neighbours in an array of ``n`` elements."""
    return F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (keys[i] != F.get(keys, i - 1)))


def _numbered(packed: Column) -> Column:
    """Sorted (hash, position) numbers to (hash of hash and occurrence number, position) numbers."""

    def with_runs(s: Column) -> Column:
        n = F.size(s)
        hashes = F.transform(s, lambda x: F.shiftright(x, _POSITION_BITS))
        return let(hashes, lambda h: let(_runs(h, n), lambda st: F.zip_with(
            s,
            F.flatten(F.transform(st, lambda x, j: F.sequence(F.lit(0), F.coalesce(F.get(st, j + 1), n) - x - 1))),
            lambda x, occurrence: F.xxhash64(F.shiftright(x, _POSITION_BITS), occurrence).bitwiseAND(_long(~_POSITIONS)).bitwiseOR(x.bitwiseAND(_long(_POSITIONS))),
        )))

    return let(packed, with_runs)


def _tuple(least: Column) -> Column:
    """Hash of a tuple of (hash, position) numbers in text order."""
    # By position, which is turned to the front for the sort and then dropped.
    turned = F.transform(least, lambda v: F.shiftleft(v, 64 - _POSITION_BITS).bitwiseXOR(_long(-(1 << 63))).bitwiseOR(F.shiftrightunsigned(v, _POSITION_BITS)))
    kept = F.transform(F.array_sort(turned), lambda v: v.bitwiseAND(_long((1 << (64 - _POSITION_BITS)) - 1)))
    return F.xxhash64(kept).bitwiseAND(_long(0xFFFFFFFF))


def _tuples(elements: Column) -> Column:
    """Sorted (bucket and hash, position) numbers to one tuple hash for each bucket that has any, of its own k-mers only."""

    def with_runs(s: Column) -> Column:
        n = F.size(s)
        buckets = F.transform(s, lambda x: F.shiftright(x, _BUCKET_SHIFT))

        def of(st: Column) -> Column:
            def one(x: Column, j: Column) -> Column:
                least = F.slice(s, x + 1, F.least(_int(TUPLE), F.coalesce(F.get(st, j + 1), n) - x))
                return _tuple(least).bitwiseOR(F.shiftleft(F.shiftrightunsigned(s[x], _BUCKET_SHIFT), 32))

            return F.transform(st, one)

        return let(buckets, lambda b: let(_runs(b, n), of))

    return let(elements, with_runs)


def _full_tuples(elements: Column) -> Column:
    """Sorted (bucket and hash, position) numbers to one tuple hash for every bucket, of TUPLE k-mers where the text has as many."""
    half = SKETCHES // 2

    def with_runs(s: Column) -> Column:
        n = F.size(s)
        buckets = F.transform(s, lambda x: F.shiftright(x, _BUCKET_SHIFT).cast("int"))

        def from_start(x: Column, first: Column, last: Column) -> Column:
            """The tuple that begins at an element, for all buckets from ``first`` to ``last``."""
            around = F.transform(F.sequence(F.lit(0), F.least(_int(TUPLE), n) - 1), lambda i: s[(x + i) % n])
            number = lambda b: F.shiftleft(F.pmod(b, F.lit(SKETCHES)).cast("long"), 32)
            return let(_tuple(around), lambda v: F.transform(F.sequence(first, last), lambda b: v.bitwiseOR(number(b))))

        def of(b: Column) -> Column:
            def with_starts(st: Column) -> Column:
                own = F.transform(st, lambda x, j: from_start(x, F.when(j == 0, F.lit(-half)).otherwise(b[F.get(st, j - 1)] + 1), b[x]))
                after = F.when(b[n - 1] < half - 1, from_start(F.lit(0), b[n - 1] + 1, F.lit(half - 1))).otherwise(F.array().cast("array<bigint>"))
                return F.concat(F.flatten(own), after)

            return let(_runs(b, n), with_starts)

        return let(buckets, of)

    return let(elements, with_runs)


def _int(n: int) -> Column:
    return F.lit(n).cast("int")


def sketch(text: Column, k: int = KMER) -> Column:
    """Tuple hashes of the words of a text, one for each bucket that holds a k-mer, of the bucket's own k-mers; an array of longs.

    A text of fewer than ``k`` words is one k-mer; a text without words has an empty array. Words are runs of other signs than
    blanks (space and 0x09-0x0D), unchanged.
    """
    return let(F.transform(_words(text), lambda x: F.xxhash64(x)), lambda h: _sketch(h, k, _tuples))


def _words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _sketch(hashes: Column, k: int, tuples: Callable[[Column], Column]) -> Column:
    """Tuple hashes of a text from the hashes of its units."""

    def packed(h: Column) -> Column:
        whole = lambda i: F.xxhash64(*[h[i + j] for j in range(k)])
        # Positions of very long texts are halved until they fit, which keeps their order.
        place = lambda i: F.when(F.size(h) <= _POSITIONS, i).otherwise(F.floor(i / F.ceil(F.size(h) / _POSITIONS)).cast("int"))
        mask = lambda x, i: x.bitwiseAND(_long(~_POSITIONS)).bitwiseOR(i.cast("long").bitwiseAND(_long(_POSITIONS)))
        return F.when(F.size(h) >= k, F.transform(F.sequence(F.lit(0), F.size(h) - k), lambda i: mask(whole(i), place(i)))).otherwise(
            F.array(mask(F.xxhash64(h), F.lit(0)))
        )

    elements = _numbered(F.sort_array(packed(hashes)))
    return F.when(F.size(hashes) == 0, F.array().cast("array<bigint>")).otherwise(tuples(F.sort_array(elements)))


def _units(text: Column) -> Column:
    """Hashes of a text's units: a word each, or in words that are long or written without blanks one for each sign, of the SPAN signs from there."""

    def stretches(w: Column) -> Column:
        return let(F.transform(F.split(w, ""), lambda c: F.xxhash64(c)), lambda h: F.transform(h, lambda c, i: F.xxhash64(F.slice(h, i + 1, SPAN))))

    by_sign = lambda w: (F.char_length(w) > LONGEST) | w.rlike(_UNSPACED)
    of_words = lambda words: F.flatten(F.transform(words, lambda w: F.when(by_sign(w), stretches(w)).otherwise(F.array(F.xxhash64(w)))))
    whole = F.coalesce(text, F.lit(""))
    any_such = whole.rlike(_UNSPACED) | whole.rlike(rf"[^\x20\x09-\x0D]{{{LONGEST + 1}}}")
    return let(_words(text), lambda words: F.when(any_such, of_words(words)).otherwise(F.transform(words, lambda w: F.xxhash64(w))))


def order_sketch(text: Column, k: int = KMER) -> Column:
    """Tuple hashes of a text, one for each of the SKETCHES buckets, in bucket order; an array of longs.

    Every tuple holds TUPLE k-mers of units, if the text has as many. A text of fewer than ``k`` units is one k-mer; a text without
    words has an empty array.
    """
    return let(_units(text), lambda h: _sketch(h, k, _full_tuples))


def as_text(tuples: Column) -> Column:
    """A fingerprint as text: its tuples in hexadecimal."""
    return F.array_join(F.transform(tuples, lambda x: F.lower(F.hex(x))), "-")


def likeness(a: Column, b: Column) -> Column:
    """Share of buckets with equal tuples, of those that either text fills; 1 for two empty fingerprints."""
    bucket = lambda v: F.transform(v, lambda x: F.shiftrightunsigned(x, 32))
    filled = F.size(F.array_union(bucket(a), bucket(b)))
    return F.when(filled == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / filled)


def _range(doc_id: Column, cuts: list[int]) -> Column:
    """Number of cuts below doc_id, found in two steps of at most RANGES comparisons."""
    fine = [cuts[i : i + RANGES] for i in range(0, len(cuts), RANGES)] or [[]]
    below = lambda some: F.size(F.filter(some, lambda c: c < doc_id))
    array = lambda values: F.array(*[_long(v) for v in values]).cast("array<bigint>")
    step = below(array([part[-1] for part in fine[:-1]]))
    return let(step, lambda s: s * RANGES + below(F.get(F.array(*[array(part) for part in fine]), s))).cast("int")


def fingerprinted(docs: DataFrame, k: int = KMER) -> DataFrame:
    """Rows (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next), one per row of ``docs``.

    The edited text has its last floor(n_chars / 4) code points replaced by the first as many (or all) of the next document's
    text, in the order of doc_id (null first; rows of one doc_id by their text); after the last comes the first, and a single row is its own next.
    A null text is empty. Other columns are ignored; an empty table gives no rows.

    Documents are dealt out once, by ranges of doc_id of bounded size; the last of a range takes its neighbour from the
    table of each range's first document.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = base.count()
    parts = min(RANGES * RANGES, max(1, n // ROWS_PER_RANGE))
    found = base.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)] or [0.5], 20_000)).first()[0] or []
    cuts = sorted(set(found)) if parts > 1 else []
    rank = F.struct(F.col("doc_id").isNotNull(), "doc_id", F.xxhash64("text").alias("h"), F.sha2("text", 256).alias("s"))
    ranged = base.withColumn("part", F.coalesce(_range(F.col("doc_id"), cuts), F.lit(0)))

    # The first document of each range, and whose range comes before it: at most RANGES x RANGES rows.
    firsts = ranged.select("part", rank.alias("rank")).groupBy("part").agg(F.min("rank").alias("rank"))
    order = Window.orderBy("part")
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = firsts.select(F.coalesce(F.lag("part").over(order), F.last("part").over(everything)).alias("after"), "rank")
    firsts = written(firsts, "firsts")
    texts = ranged.select("text", rank.alias("own")).join(F.broadcast(firsts), F.col("own").eqNullSafe(F.col("rank")))
    firsts = written(texts.select("after", "text").dropDuplicates(["after"]), "first-texts")
    firsts = firsts.select("after", F.col("text").alias("first_text"), order_sketch(F.col("text"), k).alias("first_sketch"))

    dealt = ranged.select("doc_id", "text", "part", order_sketch(F.col("text"), k).alias("own"))
    order = Window.partitionBy("part").orderBy(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.sha2("text", 256))
    dealt = dealt.withColumn("next_text", F.lead("text").over(order)).withColumn("next", F.lead("own").over(order))
    dealt = dealt.join(firsts, F.col("part") == F.col("after"), "left").select(
        "doc_id", "text", "own", F.coalesce("next_text", "first_text").alias("next_text"), F.coalesce("next", "first_sketch").alias("next")
    )
    size = F.char_length("text")
    cut = F.floor(size / 4).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), size - cut), F.substr("next_text", F.lit(1), cut))
    dealt = dealt.select("doc_id", size.cast("long").alias("n_chars"), "own", "next", edited.alias("edited"))
    dealt = dealt.select("*", order_sketch(F.col("edited"), k).alias("other"))
    return dealt.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("other")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("other")).alias("near_edited"),
        likeness(F.col("own"), F.col("next")).alias("near_next"),
    )
