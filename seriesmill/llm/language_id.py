"""Operator 5: language identification by error-correcting output codes.

Every language has a codeword of bits. One binary classifier per bit, over hashed character n-grams,
says on which side of the bit a text lies; the codeword with the smallest loss, weighted by how well
each bit separates the training texts, is the language. When the runner-up is close the prediction is
flagged as ambiguous.

Training is one pass: n-gram counts per language over all labelled texts (a fixed table of buckets per
language), from which the weight of an n-gram for a bit is the log ratio of its smoothed rates on both
sides. No text is sampled and none leaves its task.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; long texts are read whole;
no labelled text at all: everything is ``und``; one language: all other texts are that language; rows with
equal or null ids stay separate rows; ties go to the first language in alphabetical order; other columns
are not carried.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from seriesmill.llm.common import rows_in, texts, tidy_task

UNKNOWN = "und"
BUCKETS = 1 << 15
ORDERS = (1, 2, 3, 4)
#: A runner-up with so little more loss than the winner makes a prediction ambiguous.
AMBIGUOUS = 0.02
LETTER = regex.compile(r"\p{L}")


def codewords(n: int, bits_per_language: int = 4) -> np.ndarray:
    """(n, bits) of +1/-1. Up to 7 languages all splits of the set, beyond that seeded random ones, all columns different."""
    if n < 2:
        return np.ones((n, 1))
    if n <= 7:
        columns = [(1, *c) for c in itertools.product((1, -1), repeat=n - 1) if -1 in c]
        return np.array(columns, float).T
    rng = np.random.default_rng(n)
    columns = set()
    while len(columns) < bits_per_language * n:
        half = tuple(rng.permutation([1] * (n // 2) + [-1] * (n - n // 2)).tolist())
        columns.add(half)
    return np.array(sorted(columns), float).T


def gram_buckets(text: str) -> np.ndarray:
    """Hash bucket of every n-gram of letters and blanks; anything else is a blank, runs of blanks count once."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), "<u4").astype("u8")
    # Letters of any script: ASCII ones by range, others by being outside ASCII punctuation and Latin signs.
    letter = ((points >= 97) & (points <= 122)) | (points >= 0xAA)
    points = np.where(letter, points, 32)
    points = np.concatenate([[32], points, [32]]).astype("u8")
    points = points[np.concatenate([[True], (points[1:] != 32) | (points[:-1] != 32)])]
    out, code = [], np.zeros(len(points), "u8")
    for order in range(1, max(ORDERS) + 1):
        code = code[: len(points) - order + 1] * np.uint64(0x100000001B3) + points[order - 1 :]
        if order in ORDERS:
            mixed = (code ^ (code >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(order)
            out.append((mixed >> np.uint64(40)) % np.uint64(BUCKETS))
    return np.concatenate(out).astype("i8")


@dataclass
class CodeModel:
    languages: list[str]
    words: np.ndarray  # (languages, bits)
    weights: np.ndarray  # (buckets, bits)
    trust: np.ndarray  # (bits,): how far apart the two sides lie on the training counts

    def bits(self, text: str) -> np.ndarray:
        """Mean evidence of the n-grams of a text for each bit."""
        counts = np.bincount(gram_buckets(text), minlength=BUCKETS)
        return counts @ self.weights / max(1, counts.sum())

    def predict(self, text: str | None) -> tuple[str, float, float, bool]:
        """Language, score in 0..1, lead of the winner in loss, ambiguity."""
        if text is None or not self.languages or not LETTER.search(text):
            return UNKNOWN, 0.0, 0.0, False
        if len(self.languages) == 1:
            return self.languages[0], 1.0, 1.0, False
        # Logistic loss of each bit, on the scale on which the training sides lie at +1 and -1.
        loss = (np.log1p(np.exp(-2.0 * self.words * (self.bits(text) / self.trust))) * self.trust).sum(1) / self.trust.sum()
        order = np.argsort(loss, kind="stable")
        lead = float(loss[order[1]] - loss[order[0]])
        share = np.exp(-8.0 * (loss - loss[order[0]]))
        return self.languages[order[0]], float(share[order[0]] / share.sum()), lead, lead < AMBIGUOUS


def gram_counts(labelled: DataFrame) -> DataFrame:
    """(lang, counts): n-gram counts of each language from (lang, text). Tasks send one table per language they saw."""
    schema = pa.schema([("lang", pa.string()), ("counts", pa.binary())])

    def run(batches):
        totals: dict[str, np.ndarray] = {}
        for lang, text in rows_in(batches):
            if text and LETTER.search(text):
                have = totals.setdefault(lang, np.zeros(BUCKETS, "i8"))
                have += np.bincount(gram_buckets(text), minlength=BUCKETS)
        if totals:
            yield pa.RecordBatch.from_arrays([pa.array(list(totals)), pa.array([v.tobytes() for v in totals.values()], pa.binary())], schema=schema)

    return labelled.select("lang", "text").mapInArrow(tidy_task(run), "lang string, counts binary")


def train(labelled: DataFrame) -> CodeModel:
    """Fit on all rows of (lang, text) with both set. The driver gets one count per language and bucket."""
    def add(pdf):
        total = sum(np.frombuffer(c, "<i8") for c in pdf["counts"])
        return pdf.iloc[:1].assign(counts=[total.tobytes()])

    parts = gram_counts(labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()))
    # Two steps, so that no task adds the tables of all tasks.
    parts = parts.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(64))).groupBy("lang", "salt").applyInPandas(lambda p: add(p)[["lang", "counts"]], "lang string, counts binary")
    rows = sorted(parts.groupBy("lang").applyInPandas(lambda p: add(p)[["lang", "counts"]], "lang string, counts binary").collect())
    return fit_counts([r["lang"] for r in rows], [np.frombuffer(r["counts"], "<i8") for r in rows])


def fit_counts(languages: list[str], counts: list[np.ndarray]) -> CodeModel:
    words = codewords(len(languages))
    if len(languages) < 2:
        return CodeModel(languages, words, np.zeros((BUCKETS, 1)), np.ones(1))
    rates = np.array([(c + 0.5) / (c.sum() + 0.5 * BUCKETS) for c in counts])
    weights = np.empty((BUCKETS, words.shape[1]))
    for b in range(words.shape[1]):
        side = words[:, b] > 0
        weights[:, b] = np.log(rates[side].mean(0) / rates[~side].mean(0))
    evidence = rates @ weights  # mean evidence of each language for each bit
    trust = np.abs(evidence * words).mean(0)
    return CodeModel(languages, words, weights, np.maximum(trust, 1e-9))


def with_language(docs: DataFrame, model: CodeModel, text_col: str = "text", out_col: str = "language") -> DataFrame:
    """``docs`` with a column (lang_pred, score, margin, ambiguous) more, row by row; all other columns pass through.

    The model travels with the tasks: a few megabytes per ten languages, whatever the number of documents.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kinds = [("lang_pred", pa.string()), ("score", pa.float64()), ("margin", pa.float64()), ("ambiguous", pa.bool_())]
    schema = StructType([*docs.schema.fields, StructField(out_col, StructType.fromDDL("lang_pred string, score double, margin double, ambiguous boolean"))])

    def run(batches):
        own = shared.value
        for batch in batches:
            found = [own.predict(t.as_py()) for t in batch.column(text_col)]
            columns = [pa.array([f[k] for f in found], type=kind) for k, (_, kind) in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.StructArray.from_arrays(columns, [n for n, _ in kinds])], [*batch.schema.names, out_col])

    return docs.mapInArrow(tidy_task(run), schema)


def predict(docs: DataFrame, model: CodeModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, margin, ambiguous), a row per document."""
    return with_language(texts(docs, id_col, text_col), model).select("doc_id", "language.*")


def held_out(id_col: str = "doc_id"):
    """crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))
