"""Operator 11: alignment of the tokens of two vocabularies over the same bytes.

A byte-level vocabulary (A) and a sentencepiece one (B) both cut the bytes of a space and the text. Offsets at
which tokens of both end cut the tokens into groups; the last A and the last B token of a group end together and
are linked. A table from A ids to the B id of the same bytes recognises the groups that are one and the same piece
of text on both sides: those are kept as A ids and counted in one vector per task. Only links of other groups are
kept as pairs, counted per task and added up by a shuffle of pairs.

Size of the pair table: two linked tokens end at the same byte, so one is a suffix of the other. A token has at most
as many suffixes as bytes, so there are fewer different pairs than bytes in both vocabularies, whatever the corpus.

Defined cases: a null or empty text has no tokens, nor has one whose tokens do not give back its bytes (a text that
holds the mark of the sentencepiece format): zero counts and no group; long texts are aligned whole; rows with equal
or null ids stay separate rows, each counted; an empty table gives no row; other columns are not carried.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.common import BatchWriter, groups_of, rows_in, texts, tidy_task, worker_cache
from seriesmill.llm.packing import ByteTokens, _byte_letters
from seriesmill.llm.pieces import BYTE, NORMAL, SPACE, PieceModel
from seriesmill.llm.sentencepiece_spans import SpanEncoder

#: Characters that are aligned together; one longer text is a group by itself.
TOGETHER = 1_000_000
COMMA, BAR, SEMICOLON, NEWLINE = b",|;\n"


class Surfaces:
    """The bytes of every id of a vocabulary, one after the other."""

    def __init__(self, surfaces: list[bytes]):
        self.widths = np.array([len(s) for s in surfaces], "i8")
        self.begins = np.cumsum(self.widths) - self.widths
        self.flat = np.frombuffer(b"".join(surfaces), "u1")
        # Decimal digits of each id, zero bytes before them.
        places = len(str(max(1, len(surfaces) - 1)))
        ids = np.arange(len(surfaces))[:, None] // 10 ** np.arange(places - 1, -1, -1)
        self.digits = np.where((ids > 0) | (np.arange(places) == places - 1), ids % 10 + 48, 0).astype("u1")

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of a sequence of ids."""
        widths = self.widths[ids]
        shift = self.begins[ids] - (np.cumsum(widths) - widths)
        return self.flat[np.arange(int(widths.sum())) + np.repeat(shift, widths)]


def byte_surfaces(data: bytes) -> list[bytes]:
    """Of a byte-level vocabulary file: letters of its tokens back to bytes; added tokens as they are written."""
    spec, letters = json.loads(data), _byte_letters()
    added = {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
    vocabulary = {i: bytes(letters[c] for c in t) for t, i in spec["model"]["vocab"].items() if i not in added} | added
    return [vocabulary.get(i, b"") for i in range(max(vocabulary) + 1)]


def piece_surfaces(data: bytes) -> list[bytes]:
    """Of a sentencepiece model: pieces with spaces for their marks, byte pieces as their byte, control pieces empty."""
    model = PieceModel(data)
    return [
        model.byte_of[i] if kind == BYTE else piece.replace(SPACE, " ").encode() if kind == NORMAL else b""
        for i, (piece, kind) in enumerate(zip(model.pieces, model.types))
    ]


def same_bytes(data_a: bytes, data_b: bytes) -> np.ndarray:
    """For every A id the normal piece of B with the same bytes, -1 where there is none."""
    kinds = PieceModel(data_b).types
    of = {s: i for i, s in enumerate(piece_surfaces(data_b)) if kinds[i] == NORMAL}
    return np.array([of.get(s, -1) if s else -1 for s in byte_surfaces(data_a)], "i4")


class Aligned:
    """Tokens of some texts, text after text, with the groups that common ends make of them."""

    def __init__(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, left: Surfaces, right: Surfaces):
        self.a, self.b, self.n_a, self.n_b, self.left, self.right = a, b, n_a, n_b, left, right
        a_ends, b_ends = np.cumsum(left.widths[a]), np.cumsum(right.widths[b])
        size = int(a_ends[-1]) + 1 if len(a) else 1
        at_a, at_b = np.zeros(size, bool), np.zeros(size, bool)
        at_a[a_ends] = at_b[b_ends] = True
        self.last_a, self.last_b = at_b[a_ends], at_a[b_ends]
        self.ia, self.ib = np.flatnonzero(self.last_a), np.flatnonzero(self.last_b)
        upto = np.searchsorted(self.ia, np.cumsum(n_a) - 1, side="right") if len(a) else np.zeros(len(n_a), "i8")
        self.upto = np.where(np.cumsum(n_a) > 0, upto, 0)  # groups up to the end of each text

    def links(self, same: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A and B id of each group's link, and whether the group is one token of the same bytes on both sides."""
        a, b = self.a[self.ia], self.b[self.ib]
        alone = (np.diff(self.ia, prepend=-1) == 1) & (np.diff(self.ib, prepend=-1) == 1)
        return a, b, alone & (same[a] == b)

    def written(self) -> list[str]:
        """The groups of each text as ``a1,a2|b1;a3|b2,b3``."""
        per_text = ["" for _ in self.n_a]
        if not len(self.a):
            return per_text
        group_a, group_b = (np.cumsum(last) - last for last in (self.last_a, self.last_b))
        row_a = np.arange(len(self.a)) + np.concatenate([[0], self.ib + 1])[group_a]
        row_b = np.arange(len(self.b)) + (self.ia + 1)[group_b]
        wide_a, wide_b = self.left.digits.shape[1], self.right.digits.shape[1]
        out = np.zeros((len(self.a) + len(self.b), max(wide_a, wide_b) + 1), "u1")
        out[row_a, -1 - wide_a : -1], out[row_b, -1 - wide_b : -1] = self.left.digits[self.a], self.right.digits[self.b]
        out[row_a, -1] = np.where(self.last_a, BAR, COMMA)
        out[row_b, -1] = np.where(self.last_b, SEMICOLON, COMMA)
        filled = np.flatnonzero(self.n_b)
        out[row_b[np.cumsum(self.n_b)[filled] - 1], -1] = NEWLINE
        flat = out.ravel()
        for k, line in zip(filled.tolist(), flat[flat != 0].tobytes().decode("ascii").split("\n")):
            per_text[k] = line
        return per_text


class Aligner:
    """Both encoders with their tables, as one worker keeps them."""

    def __init__(self, data_a: bytes, data_b: bytes):
        self.left, self.right = Surfaces(byte_surfaces(data_a)), Surfaces(piece_surfaces(data_b))
        self.same = same_bytes(data_a, data_b)
        self.bytes_side, self.piece_side = ByteTokens(data_a), SpanEncoder(data_b)
        self.slow = None

    def byte_ids(self, text: str) -> np.ndarray:
        """Ids of A; strings of special tokens are plain text."""
        try:
            return self.bytes_side.core.encode_to_numpy(text, allowed_special=set(), disallowed_special=()).astype("i4")
        except BaseException as error:  # the splitter gives up on millions of blanks in a row
            if type(error).__name__ != "PanicException":
                raise
            if self.slow is None:
                from tokenizers import Tokenizer

                self.slow = Tokenizer.from_str(self.bytes_side.file)
                self.slow.encode_special_tokens = True
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, "i4")

    def piece_ids(self, some: list[str]) -> list[np.ndarray]:
        cut = [self.piece_side.model.chunks.findall(self.piece_side.normal(t)) for t in some]
        seen = self.piece_side.seen
        seen.learn(set().union(*cut))
        return [np.frombuffer(b"".join(map(seen.__getitem__, chunks)), "<i4") for chunks in cut]

    def align(self, some: list[str]) -> Aligned:
        none = np.zeros(0, "i4")
        a = [self.byte_ids(" " + t) if t else none for t in some]
        b = [ids if t else none for t, ids in zip(some, self.piece_ids(some))]
        whole = "".join([" " + t for t in some if t]).encode()
        if not all(self._gives(whole, table, ids) for table, ids in ((self.left, a), (self.right, b))):
            for k, t in enumerate(some):
                own = (" " + t).encode() if t else b""
                if not (self._gives(own, self.left, [a[k]]) and self._gives(own, self.right, [b[k]])):
                    a[k] = b[k] = none
        n_a, n_b = (np.array([len(x) for x in ids], "i8") for ids in (a, b))
        return Aligned(np.concatenate([none, *a]), np.concatenate([none, *b]), n_a, n_b, self.left, self.right)

    @staticmethod
    def _gives(data: bytes, table: Surfaces, ids: list[np.ndarray]) -> bool:
        return np.array_equal(table.joined(np.concatenate([np.zeros(0, "i4"), *ids])), np.frombuffer(data, "u1"))


# --- on Spark ------------------------------------------------------------------------------------

ALIGNED = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups string, own binary, other binary"


class Codes:
    """How links are packed: A ids of identical tokens, and a * (size of B) + b for the other pairs."""

    def __init__(self, file_a: str, file_b: str):
        self.data_a, self.data_b = open(file_a, "rb").read(), open(file_b, "rb").read()
        self.same = same_bytes(self.data_a, self.data_b)
        surfaces_a, surfaces_b = byte_surfaces(self.data_a), piece_surfaces(self.data_b)
        self.n_a, self.n_b = len(surfaces_a), len(surfaces_b)
        self.most_pairs = sum(map(len, surfaces_a)) + sum(map(len, surfaces_b))
        self.own = "<u2" if self.n_a <= 1 << 16 else "<u4"
        self.other = "<u4" if self.n_a * self.n_b <= 1 << 32 else "<u8"


def aligned_tokens(docs: DataFrame, codes: Codes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, groups, own, other) of every text: token and group counts, the groups written out,
    the links between identical tokens as packed A ids, and the other links as packed pairs. One pass, no shuffle."""
    data_a, data_b, n_b, own_kind, other_kind = codes.data_a, codes.data_b, codes.n_b, codes.own, codes.other
    schema = pa.schema([*[(c, pa.int64()) for c in ("doc_id", "n_a", "n_b", "n_groups")], ("groups", pa.string()), ("own", pa.binary()), ("other", pa.binary())])

    def run(batches):
        aligner = worker_cache(f"aligner-{hash((data_a, data_b))}", lambda: Aligner(data_a, data_b))
        out = BatchWriter(schema)
        for group in groups_of(rows_in(batches), TOGETHER):
            found = aligner.align([text or "" for _, text in group])
            a, b, alone = found.links(aligner.same)
            pairs = a.astype("i8") * n_b + b
            written, start = found.written(), 0
            for (doc_id, _), n, m, stop, groups in zip(group, found.n_a.tolist(), found.n_b.tolist(), found.upto.tolist(), written):
                is_own = alone[start:stop]
                own, other = a[start:stop][is_own].astype(own_kind).tobytes(), pairs[start:stop][~is_own].astype(other_kind).tobytes()
                out.add(len(groups) + len(own) + len(other), doc_id, n, m, stop - start, groups, own, other)
                start = stop
                if out.full():
                    yield out.take()
        if out.size:
            yield out.take()

    return texts(docs, id_col, text_col).mapInArrow(tidy_task(run), ALIGNED)


def _unpacked(value: pa.Scalar, kind: str) -> np.ndarray:
    data = value.as_buffer()
    return np.frombuffer(data, kind) if data is not None else np.zeros(0, kind)


def identical_counts(aligned: DataFrame, codes: Codes) -> DataFrame:
    """(a_id, n): links between identical tokens, from one vector over the vocabulary per task."""
    n_a, kind = codes.n_a, codes.own

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_a, "i8")
        for batch in batches:
            for value in batch.column(0):
                total += np.bincount(_unpacked(value, kind), minlength=n_a)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["a_id", "n"])

    return aligned.select("own").mapInArrow(run, "a_id bigint, n bigint").groupBy("a_id").agg(F.sum("n").alias("n"))


def irregular_counts(aligned: DataFrame, codes: Codes) -> DataFrame:
    """(pair, n): the other links, counted in each task first."""
    kind = codes.other

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts = np.zeros(0, "i8"), np.zeros(0, "i8")
        for batch in batches:
            found, n = np.unique(np.concatenate([np.zeros(0, kind), *[_unpacked(v, kind) for v in batch.column(0)]]), return_counts=True)
            both, where = np.unique(np.concatenate([pairs, found.astype("i8")]), return_inverse=True)
            pairs, counts = both, np.bincount(where, np.concatenate([counts, n]), len(both)).astype("i8")
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], names=["pair", "n"])

    return aligned.select("other").mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))


def pair_counts(aligned: DataFrame, codes: Codes) -> DataFrame:
    """(a_id, b_id, n): how often each pair of ids is linked in all texts."""
    spark = aligned.sparkSession
    twin = spark.createDataFrame([(i, int(b)) for i, b in enumerate(codes.same) if b >= 0], "a_id bigint, b_id bigint")
    own = identical_counts(aligned, codes).join(twin, "a_id").select("a_id", "b_id", "n")
    size = F.lit(codes.n_b)
    other = irregular_counts(aligned, codes)
    return own.unionByName(other.select(F.floor(F.col("pair") / size).alias("a_id"), (F.col("pair") % size).alias("b_id"), "n"))


def with_links(aligned: DataFrame, pairs: DataFrame, codes: Codes) -> DataFrame:
    """Adds n_links, n_best and count_sum: the links of each text, those whose count is the highest of their B id, and
    the sum of their counts. ``pairs`` is checked against its bound before it goes to the tasks."""
    table = pairs.select("a_id", "b_id", "n").toArrow()
    if table.num_rows > codes.most_pairs:
        raise ValueError("more pairs than one vocabulary's suffixes in the other: not counts of linked tokens")
    a, b, n = (table.column(c).to_numpy() for c in range(3))
    best = np.zeros(codes.n_b, "i8")
    np.maximum.at(best, b, n)
    twin = codes.same[a] == b
    own_n, own_best = np.zeros(codes.n_a, "i8"), np.zeros(codes.n_a, bool)
    own_n[a[twin]], own_best[a[twin]] = n[twin], n[twin] == best[b[twin]]
    keys = a * codes.n_b + b
    order = np.argsort(keys)
    keys, counts, tops = keys[order], n[order], (n == best[b])[order]
    tables = aligned.sparkSession.sparkContext.broadcast((own_n, own_best, keys, counts, tops))
    own_kind, other_kind = codes.own, codes.other
    kept = [c for c in aligned.columns if c not in ("own", "other", "groups")]
    added = ["n_links", "n_best", "count_sum"]
    types = {f.name: f.dataType.simpleString() for f in aligned.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_n, own_best, keys, counts, tops = tables.value
        for batch in batches:
            rows = []
            for one, two in zip(batch.column("own"), batch.column("other")):
                own, other = _unpacked(one, own_kind), np.searchsorted(keys, _unpacked(two, other_kind))
                rows.append((len(own) + len(other), int(own_best[own].sum()) + int(tops[other].sum()), int(own_n[own].sum()) + int(counts[other].sum())))
            numbers = np.array(rows, "i8").reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *[pa.array(numbers[:, k]) for k in range(3)]], names=kept + added)

    schema = ", ".join([f"`{c}` {types[c]}" for c in kept] + [f"{c} bigint" for c in added])
    return aligned.select(*kept, "own", "other").mapInArrow(run, schema)
