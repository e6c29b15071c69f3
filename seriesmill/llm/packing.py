"""Operator 2: packing by minimum bin slack.

Texts become token ids and are cut at multiples of the window; what is left of each is a piece
shorter than the window. Windows are planned on the *counts* of piece lengths, of which there are
fewer than the window is long: a bitset subset-sum over the lengths still there, with their counts,
finds the multiset that comes closest to capacity; counts are backtracked; the multiset is taken as
often as the counts allow. Pieces then find their window by their rank among pieces of equal length,
so no task, group or driver holds more than one count per length.

Defined cases: a null text is empty; an empty text is a piece that holds the end id alone; a long text
gives one piece per full window and the rest; equal rows are packed as separate rows; the order among
pieces of equal length is that of the stored pieces; an empty table gives no row; other columns are not
carried. Null ids stay null.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seriesmill.llm.common import BatchWriter, groups_of, rows_in, stored, texts, tidy_task, worker_cache

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, part bigint, nth bigint, ids array<int>"
#: The split pattern of byte-level BPE files of this format (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


# --- token ids ---------------------------------------------------------------------------------


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in such a file: printable ones for themselves, the others from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class ByteTokens:
    """Ids of a byte-level BPE vocabulary file whose ids are merge ranks."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        self.special = set(special)
        self.file = data.decode()
        self.core = tiktoken.Encoding("pieces", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.slow = None

    def ids(self, text: str) -> np.ndarray:
        try:
            return self.core.encode_to_numpy(text, allowed_special=self.special).astype("<u4")
        except BaseException as error:  # the splitter gives up on millions of blanks in a row; interrupts pass
            if isinstance(error, (KeyboardInterrupt, SystemExit, GeneratorExit)):
                raise
            if self.slow is None:
                from tokenizers import Tokenizer

                self.slow = Tokenizer.from_str(self.file)
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, "<u4")


def cut_pieces(docs: DataFrame, vocabulary_file: str, window: int = 1024, end_id: int = 0, keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of every text: full windows first, then the rest. ``part`` and ``nth`` number the pieces of equal length."""
    data = open(vocabulary_file, "rb").read()
    names = [f.split()[0] for f in PIECES.split(", ")]
    schema = pa.schema([(n, pa.int64() if n != "ids" else pa.list_(pa.int32())) for n in names])

    def run(batches):
        tokens = worker_cache(f"bytes-{hash(data)}", lambda: ByteTokens(data))
        part, nth = TaskContext.get().partitionId(), np.zeros(window + 1, "i8")
        out = BatchWriter(schema)
        for group in groups_of(rows_in(batches)):
            for doc_id, text in group:
                ids = np.append(tokens.ids(text or ""), np.array([end_id], "<u4"))
                for start in range(0, len(ids), window):
                    piece = ids[start : start + window]
                    n = len(piece)
                    out.add(80 + 4 * n * keep_ids, doc_id, start, n, zlib.crc32(piece.tobytes()), len(ids), part, int(nth[n]), piece.astype("i4") if keep_ids else None)
                    nth[n] += 1
                if out.full():
                    yield out.take()
        if out.size:
            yield out.take()

    return texts(docs, id_col, text_col).mapInArrow(tidy_task(run), PIECES)


# --- the plan on counts ------------------------------------------------------------------------


def closest_fill(counts: Mapping[int, int], capacity: int, must: int) -> dict[int, int]:
    """The multiset of lengths, with ``must`` in it, whose sum is closest to capacity from below.

    Reachable sums are the set bits of one integer; a count c enters in binary parts 1, 2, 4, ..., rest,
    so each length costs log c shifts. Bits kept before each part tell, backwards, which parts were used.
    """
    full = (1 << (capacity + 1)) - 1
    reach, steps = 1 << must, []
    for length in sorted(counts, reverse=True):
        left = min(counts[length] - (length == must), (capacity - must) // length)
        part = 1
        while left > 0 and not reach >> capacity & 1:
            take = min(part, left)
            steps.append((length, take, reach))
            reach |= reach << (length * take) & full
            left, part = left - take, part * 2
    total = reach.bit_length() - 1
    used = {must: 1}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            total -= length * take
            used[length] = used.get(length, 0) + take
    return used


def plan_windows(counts: Mapping[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """(multiset, repeats): windows for all pieces, each as full as what is left allows. Longest length first."""
    left = {k: c for k, c in counts.items() if c > 0}
    plan = []
    while left:
        fill = closest_fill(left, capacity, max(left))
        times = min(left[k] // c for k, c in fill.items())
        plan.append((fill, times))
        for k, c in fill.items():
            left[k] -= c * times
            if not left[k]:
                del left[k]
    return plan


def slots(plan: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, ranks, first window, copies per window, offset of the first copy) of each length in each entry."""
    taken: dict[int, int] = {}
    window, out = 0, []
    for fill, times in plan:
        at = 0
        for length in sorted(fill, reverse=True):
            copies = fill[length]
            first = taken.get(length, 0)
            out.append((length, first, copies * times, window, copies, at))
            taken[length] = first + copies * times
            at += length * copies
        window += times
    return out


# --- on Spark ----------------------------------------------------------------------------------


def pack(pieces: DataFrame, window: int = 1024) -> DataFrame:
    """Adds (sequence_id, offset) to *stored* pieces with (length, part, nth).

    The driver sees one count per length; the plan goes back as a table whose size the window bounds
    (at most a few entries per length). Ranks come from counts per (part, length), not from a sort.
    """
    spark = pieces.sparkSession
    per_part = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = slots(plan_windows(counts, window))
    entries = spark.createDataFrame(table, "length bigint, first_rank bigint, ranks bigint, window bigint, copies bigint, at bigint")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = per_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    # A length is used by few entries, so each piece carries them and looks its own up.
    by_length = entries.groupBy("length").agg(F.array_sort(F.collect_list(F.struct("first_rank", "ranks", "window", "copies", "at"))).alias("entries"))
    ranked = pieces.join(base, ["length", "part"]).withColumn("rank", F.col("base") + F.col("nth")).join(F.broadcast(by_length), "length")
    own = F.filter("entries", lambda e: (e.first_rank <= F.col("rank")) & (F.col("rank") < e.first_rank + e.ranks))[0]
    k = F.col("rank") - F.col("own.first_rank")
    return ranked.withColumn("own", own).select(
        *[c for c in pieces.columns if c not in ("part", "nth")],
        (F.col("own.window") + F.floor(k / F.col("own.copies"))).cast("bigint").alias("sequence_id"),
        (F.col("own.at") + F.col("length") * (k % F.col("own.copies"))).cast("bigint").alias("offset"),
    )


def pack_documents(docs: DataFrame, vocabulary_file: str, window: int = 1024, end_id: int = 0, keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Cut, store and pack: (doc_id, start, length, ids_crc32, doc_tokens[, ids], sequence_id, offset), a row per piece."""
    pieces = stored(cut_pieces(docs, vocabulary_file, window, end_id, keep_ids, id_col, text_col), "pieces")
    packed = pack(pieces, window)
    return packed if keep_ids else packed.drop("ids")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed windows themselves, from pieces that kept their ids."""
    rows = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(rows, lambda r: r.ids)).alias("ids"))
