"""All merges of many chunks at once: each step does the best merge of every chunk with numpy."""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np

from seriesmill.llm.pieces import PieceModel

#: Longer chunks, and those with characters outside the vocabulary, are merged one by one.
LONGEST = 40
ROWS = 20_000
NONE = np.int32(2**31 - 1)


class PairTable:
    """Hash table from pairs of codes to what they merge into; a second table takes the collisions of the first."""

    def __init__(self, pairs: dict[tuple[int, int], int], codes: int):
        self.codes = np.int64(codes)
        keys = np.array([a * codes + b for a, b in pairs], "i8")
        values = np.array(list(pairs.values()), "i4")
        self.bits = max(12, len(keys).bit_length() + 4)
        self.tables = []
        seed = 1
        while len(keys):
            factor = np.uint64((0x9E3779B97F4A7C15 * (2 * seed + 1)) % 2**64 | 1)
            slot = self._slots(keys, factor)
            _, first = np.unique(slot, return_index=True)
            held_keys, held = np.full(1 << self.bits, -1, "i8"), np.full(1 << self.bits, -1, "i4")
            held_keys[slot[first]], held[slot[first]] = keys[first], values[first]
            self.tables.append((factor, held_keys, held))
            rest = np.ones(len(keys), bool)
            rest[first] = False
            keys, values, seed = keys[rest], values[rest], seed + 1

    def _slots(self, keys: np.ndarray, factor: np.uint64) -> np.ndarray:
        return ((keys.view("u8") * factor) >> np.uint64(64 - self.bits)).astype("i8")

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merged code, -1 where two codes do not merge."""
        keys = np.ascontiguousarray(left, "i8") * self.codes + right
        out = np.full(keys.shape, -1, "i4")
        for factor, held_keys, held in self.tables:
            slot = self._slots(keys, factor)
            np.copyto(out, held[slot], where=held_keys[slot] == keys)
        return out


class BatchMerger:
    def __init__(self, model: PieceModel):
        self.model = model
        code = dict(model.ids)
        for piece in model.rank:  # characters that only occur inside pieces
            for ch in piece:
                code.setdefault(ch, len(model.pieces) + len(code))
        self.blank = max(code.values(), default=0) + 1
        pairs = {(code[p[:k]], code[p[k:]]): code[p] for p in model.rank for k in range(1, len(p)) if p[:k] in code and p[k:] in code}
        self.table = PairTable(pairs, self.blank + 1)
        order = {s: k for k, s in enumerate(sorted(set(model.rank.values())))}
        self.rank = np.full(self.blank + 2, NONE, "i4")
        for piece, score in model.rank.items():
            self.rank[code[piece]] = order[score]
        self.rank[-1] = NONE  # what -1 points to: no merge
        self.of_char = np.full(0x110000, -1, "i4")
        for piece, c in code.items():
            if len(piece) == 1:
                self.of_char[ord(piece)] = c
        self.known = len(model.pieces)

    def ids_of(self, chunks: list[str]) -> Iterator[bytes]:
        """Ids of each chunk as little-endian 32-bit numbers, in the order of the chunks."""
        out: list[bytes | None] = [None] * len(chunks)
        by_size = sorted((k for k, c in enumerate(chunks) if len(c) <= LONGEST), key=lambda k: len(chunks[k]))
        for at in range(0, len(by_size), ROWS):
            some = by_size[at : at + ROWS]
            for k, ids in zip(some, self._merge([chunks[k] for k in some])):
                out[k] = ids
        for k, ids in enumerate(out):
            if ids is None:
                out[k] = array("i", [i for s in self.model.merge(chunks[k]) for i in self.model.symbol_ids(s)]).tobytes()
        return iter(out)

    def _merge(self, chunks: list[str]) -> Iterator[bytes | None]:
        sizes = np.array([len(c) for c in chunks])
        width = int(sizes.max()) + 1
        inside = np.arange(width) < sizes[:, None]
        codes = np.full((len(chunks), width), self.blank, "i4")
        codes[inside] = self.of_char[np.frombuffer("".join(chunks).encode("utf-32-le"), "<u4")]
        strange = (codes < 0).any(1)
        codes[strange] = self.blank
        done = codes.copy()
        rows = np.flatnonzero(~strange)
        codes = codes[rows]
        merged = self.table.get(codes[:, :-1], codes[:, 1:])
        ranks = self.rank[merged]
        columns = np.arange(width)[None, :]
        while len(rows):
            at = ranks.argmin(1)  # the leftmost of equals
            line = np.arange(len(rows))
            go = ranks[line, at] < NONE
            if not go.all():
                done[rows[~go]] = _padded(codes[~go], done.shape[1], self.blank)
                rows, codes, merged, ranks, at = rows[go], codes[go], merged[go], ranks[go], at[go]
                line = line[: len(rows)]
                if not len(rows):
                    break
            codes[line, at] = merged[line, at]
            # The right one of the pair goes, and with it the place between the two.
            keep = columns[:, : codes.shape[1] - 1]
            codes = np.take_along_axis(codes, keep + (keep > at[:, None]), 1)
            keep = keep[:, :-1]
            gone = keep + (keep >= at[:, None])
            merged, ranks = np.take_along_axis(merged, gone, 1), np.take_along_axis(ranks, gone, 1)
            last = codes.shape[1] - 1
            for side in (at - 1, at):  # its new neighbours
                ok = np.flatnonzero((side >= 0) & (side < last))
                where = side[ok]
                new = self.table.get(codes[ok, where], codes[ok, where + 1])
                merged[ok, where], ranks[ok, where] = new, self.rank[new]
        filled = done != self.blank
        counts = filled.sum(1)
        # Codes of characters without a piece of their own become bytes: one by one.
        strange |= ((done >= self.known) & filled).any(1)
        data = done[filled].astype("<i4").tobytes()
        ends = (4 * np.cumsum(counts)).tolist()
        start = 0
        for end, odd in zip(ends, strange.tolist()):
            yield None if odd else data[start:end]
            start = end


def _padded(codes: np.ndarray, width: int, blank: int) -> np.ndarray:
    out = np.full((len(codes), width), blank, "i4")
    out[:, : codes.shape[1]] = codes
    return out
