"""Operator 7: one-permutation MinHash fingerprints, in DataFrame functions only.

Every five-word shingle is hashed once. The low bits of the hash name a bin, the rest is the value; each
bin keeps its smallest value. An empty bin takes the value of another one by optimal densification: it
probes the bins in an order drawn from its own number until one is filled. Of each bin the low eight bits
of the value are stored. Two bins agree by chance once in 256, which the likeness corrects for.

Defined cases: a null text is empty; a text without words has the empty fingerprint, alike (1.0) only to
another empty one; fewer than five words are one shingle; equal texts have equal fingerprints; long texts
are hashed whole; repeated rows stay; null ids come last in the chain of documents; other columns are not
carried.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seriesmill.llm.common import WORD_SEPARATORS, texts

BINS, BITS, WORDS = 256, 8, 5
#: Documents per range of ids; ranges at most.
RANGE_ROWS, MAX_RANGES = 5_000, 2_000


def shingle_hashes(text: Column, words: int = WORDS) -> Column:
    """One 64-bit hash per shingle of lower-cased words; no words, no hash."""
    split = F.filter(F.split(F.lower(text), WORD_SEPARATORS), lambda w: w != "")

    def hashes(ws: Column) -> Column:
        n = F.size(ws)
        starts = F.when(n > 0, F.sequence(F.lit(1), F.greatest(n - (words - 1), F.lit(1)))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.xxhash64(F.slice(ws, i, words)))

    return _let(split, hashes)


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once: a one-element array is its binding."""
    return F.transform(F.array(value), body)[0]


def bin_minima(hashes: Column, bins: int = BINS) -> Column:
    """Map from bin to its smallest value. Sorting by (bin, value) puts the smallest of each bin first."""
    width = bins.bit_length() - 1
    rotated = F.array_sort(F.transform(hashes, lambda h: F.shiftleft(h, 64 - width).bitwiseOR(F.shiftrightunsigned(h, width))))
    bin_of = lambda x: F.shiftrightunsigned(x, 64 - width).cast("int")

    def firsts(s: Column) -> Column:
        return F.filter(s, lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get(s, i - 1))))

    return _let(_let(rotated, firsts), lambda f: F.map_from_arrays(F.transform(f, bin_of), F.transform(f, lambda x: x.bitwiseAND((1 << (64 - width)) - 1))))


def probe_orders(bins: int = BINS) -> list[tuple[int, int]]:
    """Start and odd step of the walk of each bin; an odd step visits all bins, as their number is a power of two."""
    rng = random.Random(bins)
    return [(rng.randrange(bins), 2 * rng.randrange(bins // 2) + 1) for _ in range(bins)]


def densified(minima: Column, bins: int = BINS) -> Column:
    """The value of every bin: its own, or that of the first filled bin on its walk."""
    orders = F.array(*[F.struct(F.lit(i).alias("bin"), F.lit(a).alias("a"), F.lit(s).alias("s")) for i, (a, s) in enumerate(probe_orders(bins))])
    def fill(m: Column) -> Column:
        own = F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: F.try_element_at(m, i))

        def probe(v: Column) -> Column:
            def walk(o: Column) -> Column:
                at = lambda k: F.get(v, (o.a + o.s * k) % bins)
                early = [F.get(v, o.bin), *[at(F.lit(k)) for k in range(8)]]
                rest = F.aggregate(F.sequence(F.lit(8), F.lit(bins - 1)), F.lit(None).cast("bigint"), lambda acc, k: F.coalesce(acc, at(k)))
                return F.coalesce(*early, rest)

            return F.transform(orders, walk)

        return _let(own, probe)

    return _let(minima, fill)


def low_bits(text: Column, bins: int = BINS) -> Column:
    """The stored low bits of each bin as numbers; no element for a text without words."""
    bits = lambda v: v.bitwiseAND((1 << BITS) - 1).cast("smallint")
    return _let(bin_minima(shingle_hashes(text), bins), lambda m: F.when(F.size(m) == 0, F.array().cast("array<smallint>")).otherwise(F.transform(densified(m, bins), bits)))


def packed(values: Column) -> Column:
    """Stored bits as one hexadecimal text, two digits a bin; the empty text for no bins."""
    digits = F.array(*[F.lit(f"{b:02x}") for b in range(1 << BITS)])
    return F.array_join(F.transform(values, lambda v: F.get(digits, v.cast("int"))), "")


def fingerprint(text: Column, bins: int = BINS) -> Column:
    """The fingerprint of a text."""
    return packed(low_bits(text, bins))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of the shingle sets behind two arrays of stored bits: share of equal bins, freed of
    chance agreement, within 0 and 1."""
    same = F.size(F.filter(a, lambda v, i: v == F.get(b, i)))
    chance = 1.0 / (1 << BITS)
    raw = (same / F.size(a) - chance) / (1.0 - chance)
    both, none = (F.size(a) == 0) & (F.size(b) == 0), (F.size(a) == 0) | (F.size(b) == 0)
    return F.when(both, 1.0).when(none, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw)))


def _with_borders(docs: DataFrame) -> DataFrame:
    """(doc_id, text, range, border): ranges of ids, each with a copy of the first document of the range that follows it.

    Bounds come from an approximate quantile, so they are ids of the table and no range is empty.
    """
    spark = docs.sparkSession
    n, least = docs.agg(F.count("doc_id"), F.min("doc_id")).first()
    ranges = max(1, min(MAX_RANGES, n // RANGE_ROWS))
    at = [i / ranges for i in range(1, ranges)] or [0.5]
    cuts = sorted({int(b) for b in docs.agg(F.percentile_approx("doc_id", at, 10_000)).first()[0] or []} - {least})
    bound = F.array(*[F.lit(c).cast("bigint") for c in cuts]).cast("array<bigint>")
    ranged = docs.withColumn("range", F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(F.size(F.filter(bound, lambda b: b <= F.col("doc_id")))))
    # The first in descending order; of equal ids the largest text.
    firsts = ranged.groupBy("range").agg(F.max(F.struct("doc_id", "text")).alias("first"))
    filled = [r["range"] for r in ranged.select("range").distinct().collect()]  # at most MAX_RANGES + 1
    after = {r: min((x for x in filled if x > r), default=min(filled)) for r in filled}
    pairs = spark.createDataFrame(list(after.items()), "range int, to int")
    borders = firsts.join(F.broadcast(pairs), "range").select("first.doc_id", "first.text", F.col("to").alias("range"), F.lit(True).alias("border"))
    return ranged.select("doc_id", "text", "range", F.lit(False).alias("border")).union(borders)


def with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next), a row per document.

    ``edited`` is the text with its second half replaced by the beginning of the next document in descending doc_id
    (after the last: the first; equal ids by descending text). Fingerprints of the texts are made once, before the one
    shuffle, and travel along as numbers.
    """
    own = texts(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    marked = _with_borders(own).withColumn("bits", low_bits(F.col("text")))
    order = Window.partitionBy("range").orderBy("border", F.col("doc_id").desc_nulls_last(), F.col("text").desc())
    nexts = [F.lead(c).over(order).alias(f"next_{c}") for c in ("text", "bits")]
    chained = marked.select("*", *nexts).where(~F.col("border"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - half), F.substr("next_text", F.lit(1), half))
    out = chained.select("doc_id", n.cast("bigint").alias("n_chars"), edited.alias("edited"), "bits", "next_bits")
    out = out.withColumn("edited_bits", low_bits(F.col("edited")))
    return out.select(
        "doc_id",
        "n_chars",
        "edited",
        packed(F.col("bits")).alias("fingerprint"),
        packed(F.col("edited_bits")).alias("edited_fingerprint"),
        likeness(F.col("bits"), F.col("edited_bits")).alias("near_edited"),
        likeness(F.col("bits"), F.col("next_bits")).alias("near_next"),
    )


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint), a row per document."""
    return texts(docs, id_col, text_col).select("doc_id", fingerprint(F.coalesce("text", F.lit(""))).alias("fingerprint"))
