"""Operator 1: offset-preserving sentencepiece encoding, and decoding.

Every text goes through the compiled character map by longest prefix; each character of the
normal form remembers the source bytes it came from, and each piece gets the byte span of its
characters. Of the byte pieces that stand for one character the last carries the span.

Defined cases: a null text is empty; an empty text has no piece (only the end id, if asked for);
the end id has an empty span at the end of the text; long texts are encoded whole, chunk by
chunk; rows with equal or null ids stay separate rows; other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.common import BatchWriter, ChunkMemo, groups_of, rows_in, texts, tidy_task, worker_cache
from seriesmill.llm.piece_batches import BatchMerger
from seriesmill.llm.pieces import NORMAL, SPACE, PieceModel

#: Characters of chunks (and 16 per chunk) that a worker remembers; about 180 MB with the results.
MEMO = 20_000_000
ENCODED = "doc_id bigint, ids array<int>, begins array<int>, ends array<int>"


class SpanEncoder:
    """Encodes whole texts; chunks seen before come from a bounded memo."""

    def __init__(self, data: bytes):
        self.model = model = PieceModel(data)
        self.seen = ChunkMemo(BatchMerger(model).ids_of, MEMO)
        # Characters of the normal form behind each id; byte pieces are looked at separately.
        self.width = np.array([len(p) if t == NORMAL else 1 for p, t in zip(model.pieces, model.types)], "i4")
        self.byte = np.array([model.byte_of[i][0] if i in model.byte_of else -1 for i in range(len(model.pieces))], "i2")

    def ends(self, ids: np.ndarray) -> np.ndarray:
        """Characters of the normal form up to and with each piece. Of the bytes of a character the last one ends it."""
        width, byte = self.width[ids], self.byte[ids]
        if (byte >= 0).any():
            goes_on = np.append((byte[1:] >= 0x80) & (byte[1:] < 0xC0), False)
            width = np.where((byte >= 0) & goes_on, 0, width)
        return np.cumsum(width)

    def normal(self, text: str) -> str:
        model = self.model
        if not model.plain:
            return model.normalise(text)[0]
        return SPACE * (model.dummy_prefix and text != "") + text.replace(" ", SPACE)

    def edges(self, text: str, normal: str) -> tuple[np.ndarray, np.ndarray]:
        """Source byte at which each character of the normal form begins, and at which it ends (from the one before the first)."""
        model = self.model
        if model.plain:
            points = np.frombuffer(text.encode("utf-32-le"), "<u4")
            width = 1 + (points > 0x7F).astype("i4") + (points > 0x7FF) + (points > 0xFFFF)
            edge = np.zeros(len(normal) + 1, "<i4")
            np.cumsum(width, out=edge[len(normal) - len(text) + 1 :])
            return edge, edge
        _, begins, ends = model.normalise(text)
        first, stop = (begins[0], ends[-1]) if begins else (0, 0)
        return np.array([*begins, stop], "<i4"), np.maximum.accumulate(np.array([first, *ends], "<i4"))

    def encode_all(self, some: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Ids, begin bytes and end bytes of each text."""
        normals = [self.normal(t) for t in some]
        cut = [self.model.chunks.findall(n) for n in normals]
        self.seen.learn(set().union(*cut))
        for text, normal, chunks in zip(some, normals, cut):
            if not chunks:
                yield (np.zeros(0, "<i4"),) * 3
                continue
            begin_at, end_at = self.edges(text, normal)
            ids = np.frombuffer(b"".join(map(self.seen.__getitem__, chunks)), "<i4")
            ends = self.ends(ids)
            # A piece starts where the one before it ends.
            starts = np.concatenate([[0], ends[:-1]])
            begins = begin_at[starts]
            yield ids, begins, np.maximum(end_at[ends], begins)


def _encoder(data: bytes) -> SpanEncoder:
    return worker_cache(f"spans-{hash(data)}", lambda: SpanEncoder(data))


def encode_decode(docs: DataFrame, model_file: str, add_end: bool = True, decoded: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, begins, ends[, decoded]): ids of the whole text, source byte span of each, the text made from the ids.

    One pass in the tasks, no shuffle; output batches hold a few megabytes whatever the length of the texts.
    """
    data = open(model_file, "rb").read()
    kinds = [("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("begins", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32()))]
    schema = pa.schema(kinds + [("decoded", pa.string())] * decoded)

    def run(batches):
        encoder = _encoder(data)
        model = encoder.model
        out = BatchWriter(schema)
        for group in groups_of(rows_in(batches)):
            some = [text or "" for _, text in group]
            for (doc_id, _), text, (ids, begins, ends) in zip(group, some, encoder.encode_all(some)):
                if add_end:
                    stop = np.int32(len(text.encode()))
                    ids, begins, ends = np.append(ids, np.int32(model.eos)), np.append(begins, stop), np.append(ends, stop)
                out.add(12 * len(ids) + len(text), doc_id, ids, begins, ends, *([decode_ids(model, ids)] * decoded))
                if out.full():
                    yield out.take()
        if out.size:
            yield out.take()

    return texts(docs, id_col, text_col).mapInArrow(tidy_task(run), ENCODED + ", decoded string" * decoded)


def decode_ids(model: PieceModel, ids: np.ndarray) -> str:
    """The text of ids, piece by piece through a table of byte strings."""
    table = model.__dict__.get("surfaces")
    if table is None:
        table = model.surfaces = [
            model.byte_of[i] if i in model.byte_of else b"" if t == 3 else " ⁇ ".encode() if t == 2 else p.replace(SPACE, " ").encode()
            for i, (p, t) in enumerate(zip(model.pieces, model.types))
        ]
    if len(ids) == 0:
        return ""
    raw = b"".join([table[i] for i in ids.tolist()])
    first = next((int(i) for i in ids if model.types[i] != 3), None)
    if first is not None and model.dummy_prefix and model.types[first] == 1 and raw[:1] == b" ":
        raw = raw[1:]
    return raw.decode("utf-8", errors="replace")


def decode(encoded: DataFrame, model_file: str, ids_col: str = "ids", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, text): the text of each array of ids; null ids give an empty text."""
    data = open(model_file, "rb").read()
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches):
        model = _encoder(data).model
        out = BatchWriter(schema)
        for batch in batches:
            for i in range(batch.num_rows):
                ids = batch.column(1)[i].values
                text = decode_ids(model, ids.to_numpy()) if ids is not None else ""
                out.add(len(text), batch.column(0)[i].as_py(), text)
                if out.full():
                    yield out.take()
        if out.size:
            yield out.take()

    return encoded.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(ids_col).cast("array<int>")).mapInArrow(tidy_task(run), "doc_id bigint, text string")
