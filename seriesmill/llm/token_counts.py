"""Operator 9: exact token counts at every prefix, by dynamic programming.

The encoding of a prefix is the encoding of a shorter prefix plus one symbol that fits next to
the last one, so one walk over a text gives the count of all its prefixes. They are stored as one
small step per character; counts, budgets and cuts are then sums over the steps.

Defined cases: a null text is empty; an empty text has 0 tokens and no step; long texts are walked
whole, chunk by chunk; rows with equal or null ids stay separate rows; other columns are not carried.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from operator import sub

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.common import BatchWriter, ChunkMemo, groups_of, rows_in, texts, tidy_task, worker_cache
from seriesmill.llm.pieces import SPACE, PieceModel

#: Characters of chunks (and 16 per chunk) that a worker remembers; about 180 MB with the results.
MEMO = 20_000_000
TABLE = "doc_id bigint, n_bytes bigint, n_chars bigint, n_tokens bigint, cut_chars bigint, steps binary"


class PrefixCounter:
    def __init__(self, data: bytes):
        self.model = PieceModel(data)
        if not self.model.plain:
            raise ValueError("prefix counts need a normaliser that only marks spaces")
        self.seen = ChunkMemo(lambda chunks: map(self._chunk, chunks), MEMO)

    def _chunk(self, chunk: str) -> bytes:
        counts = self.model.walk(chunk)[0]
        return array("h", map(sub, counts[1:], counts)).tobytes()

    def steps_all(self, some: list[str]) -> Iterator[np.ndarray]:
        """Change of the token count with each character, for each text."""
        model = self.model
        cut = [model.chunks.findall(SPACE * (model.dummy_prefix and t != "") + t.replace(" ", SPACE)) for t in some]
        self.seen.learn(set().union(*cut))
        for chunks in cut:
            out = np.frombuffer(b"".join([self.seen[c] for c in chunks]), "<i2")
            if model.dummy_prefix and len(out):  # an empty prefix has no mark: it comes with the first character
                out = np.concatenate([[out[0] + out[1]], out[2:]]).astype("<i2")
            yield out


def longest_within(steps: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix with at most ``budget`` tokens."""
    within = np.flatnonzero(np.cumsum(steps, dtype="i8") <= budget)
    return int(within[-1]) + 1 if len(within) else 0


def prefix_table(docs: DataFrame, model_file: str, budget: int, keep_steps: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_chars, n_tokens, cut_chars, steps): counts of the whole text, the longest prefix
    within ``budget`` tokens, and the stored steps (little-endian 16-bit; null if not kept). No shuffle.
    """
    data = open(model_file, "rb").read()
    schema = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in ("n_bytes", "n_chars", "n_tokens", "cut_chars")], ("steps", pa.binary())])

    def run(batches):
        counter = worker_cache(f"prefixes-{hash(data)}", lambda: PrefixCounter(data))
        out = BatchWriter(schema)
        for group in groups_of(rows_in(batches)):
            some = [text or "" for _, text in group]
            for (doc_id, _), text, steps in zip(group, some, counter.steps_all(some)):
                n = int(steps.sum(dtype="i8"))
                cut = len(text) if n <= budget else longest_within(steps, budget)
                out.add(2 * len(steps), doc_id, len(text.encode()), len(text), n, cut, steps.tobytes() if keep_steps else None)
                if out.full():
                    yield out.take()
        if out.size:
            yield out.take()

    return texts(docs, id_col, text_col).mapInArrow(tidy_task(run), TABLE)


def tokens_before(table: DataFrame, chars_col: str, out_col: str = "tokens") -> DataFrame:
    """Adds the token count of the first ``chars_col`` characters, from the stored steps alone."""

    @F.pandas_udf("bigint")
    def upto(steps, chars):
        return (chars * 0).add([int(np.frombuffer(s, "<i2")[: max(0, int(c))].sum(dtype="i8")) for s, c in zip(steps, chars)])

    return table.withColumn(out_col, upto("steps", F.coalesce(F.col(chars_col).cast("bigint"), F.lit(0))))


def cut_to(table: DataFrame, budget: int, out_col: str = "cut") -> DataFrame:
    """Adds the length of the longest prefix within another budget, from the stored steps alone."""

    @F.pandas_udf("bigint")
    def cut(steps):
        return steps.map(lambda s: longest_within(np.frombuffer(s, "<i2"), budget)).astype("int64")

    return table.withColumn(out_col, cut("steps"))
