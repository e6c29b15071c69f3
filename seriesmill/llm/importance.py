"""Operator 13: importance resampling towards a target distribution, over hashed n-grams.

A document becomes its words joined by one space, and is scanned once: the CRC of every prefix that ends
with a word is kept. CRCs are linear over GF(2), crc(AB) = shift(crc(A), len(B)) ^ crc(B), so the CRC of any
run of words comes from two prefixes: the shifted CRC of what stands before it cancels. No n-gram is cut out
or hashed by itself, whatever the range of n.

The hashed counts of all documents and of all target texts give a gain per bucket; the weight of a document is
the floored mean of its gains; adding Gumbel noise and taking the highest scores draws without replacement.

Defined cases: a null or wordless text has no feature and weight 0; long texts are scanned whole; rows with equal
ids are separate rows with equal noise; a null id has the noise of the empty id and loses ties; empty documents
give no row; an empty target gives every bucket t = 0; other columns are not carried.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesmill.llm.common import BatchWriter, groups_of, rows_in, stored, texts, tidy_task
from seriesmill.operators.long_series import numbered

#: Reflected polynomial of CRC-32 (fixed value).
POLYNOMIAL = 0xEDB88320
#: Shifts by fewer bytes than this have tables of their own; longer ones are composed of powers of two.
DIRECT = 64
#: A-Z in lower case, digits, a-z and bytes of other characters as they are; everything else separates words.
LETTERS = bytes(b | 0x20 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
TOKENS = re.compile(rb" ?[^ ]+")


# --- CRCs of n-grams from prefixes ---------------------------------------------------------------


def _through(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A linear map of 32-bit values, given by what it makes of each byte at each place."""
    return table[0][values & 255] ^ table[1][values >> 8 & 255] ^ table[2][values >> 16 & 255] ^ table[3][values >> 24]


@functools.cache
def byte_steps() -> np.ndarray:
    """What a register becomes when a zero byte goes through it, by its lowest byte."""
    out = np.arange(256, dtype="u4")
    for _ in range(8):
        out = np.where(out & 1, out >> 1 ^ np.uint32(POLYNOMIAL), out >> 1).astype("u4")
    return out


@functools.cache
def shifts() -> tuple[np.ndarray, list[np.ndarray]]:
    """Tables of the maps that append n zero bytes: for each n below ``DIRECT``, and for the powers of two."""
    places = np.arange(256, dtype="u4")[None, :] << np.array([[0], [8], [16], [24]], "u4")
    one = byte_steps()[places & 255] ^ places >> 8
    direct = [places]
    for _ in range(1, DIRECT):
        direct.append(_through(one, direct[-1]))
    powers = [one]
    for _ in range(1, 40):
        powers.append(_through(powers[-1], powers[-1]))
    return np.stack(direct), powers


def shifted(crcs: np.ndarray, n_bytes: np.ndarray) -> np.ndarray:
    """The CRC of each text followed by so many zero bytes, without the conditioning that CRC-32 adds at both ends."""
    direct, powers = shifts()
    short = n_bytes < DIRECT
    n = np.where(short, n_bytes, 0)
    out = direct[n, 0, crcs & 255] ^ direct[n, 1, crcs >> 8 & 255] ^ direct[n, 2, crcs >> 16 & 255] ^ direct[n, 3, crcs >> 24]
    if not short.all():
        far = np.flatnonzero(~short)
        values, left = crcs[far], n_bytes[far]
        for k in range(int(left.max()).bit_length()):
            has = left >> k & 1 == 1
            values[has] = _through(powers[k], values[has])
        out[far] = values
    return out


class Prefixes:
    """Running CRCs of some documents: one per word, at its end, in ``crcs``; byte ``starts`` and ``stops`` of each word."""

    def __init__(self, some: list[str | None]):
        crcs, widths, counts = [], [], []
        for text in some:
            tokens = TOKENS.findall(b" ".join((text or "").encode().translate(LETTERS).split()))
            counts.append(len(tokens))
            crcs.extend(accumulate(tokens[1:], _on, initial=crc32(tokens[0])) if tokens else ())
            widths.extend(map(len, tokens))
        self.counts = np.array(counts, "i8")
        self.crcs = np.array(crcs, "u4")
        first = np.cumsum(self.counts) - self.counts
        self.nth = np.arange(len(self.crcs)) - np.repeat(first, self.counts)
        self.left = np.repeat(self.counts, self.counts) - self.nth
        self.stops = np.cumsum(np.array(widths, "i8"))
        self.starts = np.concatenate([[0], self.stops[:-1]]) + (self.nth > 0)
        # Before a word stands the prefix of the word before it and one space; before the first one nothing.
        before = np.concatenate([np.zeros(1, "u4"), self.crcs[:-1]]) if len(self.crcs) else self.crcs
        register = ~before
        spaced = ~(byte_steps()[(register ^ np.uint32(32)) & 255] ^ register >> 8)
        self.before = np.where(self.nth > 0, spaced, np.uint32(0)).astype("u4")

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """CRCs of all runs of ``n`` words, and the document of each."""
        at = np.flatnonzero(self.left >= n)
        last = at + n - 1
        owner = np.repeat(np.arange(len(self.counts)), np.maximum(self.counts - n + 1, 0))
        return self.crcs[last] ^ shifted(self.before[at], self.stops[last] - self.starts[at]), owner


def _on(crc: int, token: bytes) -> int:
    return crc32(token, crc)


# --- on Spark ------------------------------------------------------------------------------------

FEATURES = "doc_id bigint, n_words bigint, features binary"


def hashed_features(docs: DataFrame, longest: int = 1, buckets: int = 10_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, features): the bucket of every run of 1 to ``longest`` words, repeats included, as packed numbers."""
    kind = _kind(buckets)
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("features", pa.binary())])

    def run(batches):
        out = BatchWriter(schema)
        for group in groups_of(rows_in(batches)):
            prefixes = Prefixes([text for _, text in group])
            parts = [[] for _ in group]
            for n in range(1, longest + 1):
                crcs, owner = prefixes.grams(n)
                found = (crcs % np.uint32(buckets)).astype(kind)
                stops = np.searchsorted(owner, np.arange(len(group)), side="right").tolist()
                for part, a, b in zip(parts, [0, *stops], stops):
                    part.append(found[a:b].tobytes())
            for (doc_id, _), n, part in zip(group, prefixes.counts.tolist(), parts):
                data = b"".join(part)
                out.add(len(data), doc_id, n, data)
                if out.full():
                    yield out.take()
        if out.size:
            yield out.take()

    return texts(docs, id_col, text_col).mapInArrow(tidy_task(run), FEATURES)


def _kind(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def bucket_counts(features: DataFrame, buckets: int = 10_000) -> DataFrame:
    """(bucket, n): one count vector per task, added up; at most ``buckets`` rows leave each task."""
    kind = _kind(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, "i8")
        for batch in batches:
            for data in batch.column(0):
                total += np.bincount(np.frombuffer(data.as_buffer(), kind), minlength=buckets) if data.is_valid else 0
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    return features.select("features").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs_counts: DataFrame, target_counts: DataFrame, buckets: int = 10_000) -> np.ndarray:
    """The floored gain of every bucket. The driver sees two vectors of ``buckets`` numbers, whatever the data."""
    s, t = np.zeros(buckets), np.zeros(buckets)
    for vector, counts in ((s, docs_counts), (t, target_counts)):
        for row in counts.collect():
            vector[row.bucket] = row.n
    ratio = ((t + 1.0) * (s.sum() + buckets)) / ((s + 1.0) * (t.sum() + buckets))
    return np.floor(1000.0 * np.log(ratio)).astype("i8")


def weights(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight): floored mean of the gains of each document."""
    kind = _kind(len(gain))
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "n_words", "n_features", "weight")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, weight = [], []
            for data in batch.column(2):
                own = np.frombuffer(data.as_buffer(), kind)
                n.append(len(own))
                weight.append(int(gain[own].sum()) // len(own) if len(own) else 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(weight, pa.int64())], schema=schema)

    return features.select("doc_id", "n_words", "features").mapInArrow(run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def noise(seed: int):
    """Floored Gumbel noise in thousandths, from a hash of the seed and the id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")


def drawn(scored: DataFrame, percent: int, least_words: int) -> DataFrame:
    """Adds ``rank``: 1, 2, 3, ... by falling score for the drawn ones, null for the others.

    ``scored`` is *stored*. Counts per score (whole numbers in a narrow range, so a small table) give the score of the
    last one drawn; only rows that reach it are sorted, by ranges, and numbered along the sort.
    """
    eligible = scored.where(F.col("n_words") >= least_words)
    per_score = stored(eligible.groupBy("score").agg(F.count(F.lit(1)).alias("n")), "scores")
    wanted = percent * (per_score.agg(F.sum("n")).first()[0] or 0) // 100
    upto = F.sum("n").over(Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0))
    last = per_score.withColumn("upto", upto).where(F.col("upto") >= max(wanted, 1)).agg(F.max("score")).first()[0]
    none = F.lit(None).cast("bigint")
    if wanted == 0:
        return scored.withColumn("rank", none)
    high = (F.col("n_words") >= least_words) & (F.col("score") >= last)
    order = scored.where(high).withColumns({"_down": -F.col("score"), "_no_id": F.col("doc_id").isNull()})
    top = numbered(order, [], ["_down", "_no_id", "doc_id"])
    rank = F.when(F.col("_pos") < wanted, (F.col("_pos") + 1).cast("bigint"))
    return scored.where(~high).withColumn("rank", none).unionByName(top.withColumn("rank", rank).select(*scored.columns, "rank"))


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, longest: int = 1, buckets: int = 10_000, seed: int = 2024,
             id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank): every document, with its place among those drawn towards ``target``."""
    own = stored(hashed_features(docs, longest, buckets, id_col, text_col), "features")
    aim = hashed_features(target.select(F.lit(0).alias("doc_id"), F.col(target_col).alias("text")), longest, buckets)
    gain = gains(bucket_counts(own, buckets), bucket_counts(aim, buckets), buckets)
    scored = weights(own, gain).withColumn("score", F.col("weight") + noise(seed))
    return drawn(stored(scored, "scored"), percent, least_words)
