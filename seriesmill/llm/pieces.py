"""A sentencepiece BPE model in plain Python: normaliser with source alignment, merges, prefix counts.

The model file is read as it is (protocol buffer fields of the public format).
Supported: BPE models with normal, control, unknown and byte pieces.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterator

SPACE = "▁"
# Piece types and field numbers of the public model format (fixed values).
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
LEAF_BIT, LABEL_MASK, VALUE_MASK = 1 << 8, (1 << 31) | 0xFF, (1 << 31) - 1


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of one protocol buffer message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield key >> 3, data[at : at + size]
        at += size


class CharMap:
    """The compiled character map: a double-array trie over UTF-8 bytes and the replacement strings.

    ``match`` finds the longest key that starts at a byte position. Empty bytes: nothing is replaced.
    """

    def __init__(self, blob: bytes):
        self.units: tuple[int, ...] = ()
        self.strings = b""
        if blob:
            (size,) = struct.unpack_from("<I", blob)
            self.units = struct.unpack_from(f"<{size // 4}I", blob, 4)
            self.strings = blob[4 + size :]

    def match(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """(bytes used, replacement) of the longest key at ``at``; None if no key matches."""
        if not self.units:
            return None
        found = None
        pos = self._offset(self.units[0])
        for end in range(at, len(data)):
            node = pos ^ data[end]
            if node >= len(self.units) or self.units[node] & LABEL_MASK != data[end]:
                break
            pos = node ^ self._offset(self.units[node])
            if self.units[node] & LEAF_BIT:
                found = end + 1 - at, self.units[pos] & VALUE_MASK
        if found is None:
            return None
        start = found[1]
        return found[0], self.strings[start : self.strings.index(b"\0", start)]

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & (1 << 9)) >> 6)


class PieceModel:
    """Encoder, decoder and prefix counter of one model."""

    def __init__(self, data: bytes):
        self.pieces: list[str] = []
        self.types: list[int] = []
        self.rank: dict[str, float] = {}
        trainer, spec = {}, {}
        for number, value in fields(data):
            if number == 1:
                piece = dict(fields(value))
                text, kind = piece[1].decode(), piece.get(3, NORMAL)
                if kind == NORMAL:
                    self.rank[text] = -struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
                self.pieces.append(text)
                self.types.append(kind)
            elif number == 2:
                trainer = dict(fields(value))
            elif number == 3:
                spec = dict(fields(value))
        if trainer.get(3, 1) != 2 or {USER_DEFINED, UNUSED} & set(self.types):
            raise ValueError("only BPE models without user-defined or unused pieces are supported")
        self.charmap = CharMap(spec.get(2, b""))
        self.dummy_prefix, self.squeeze, self.escape = (bool(spec.get(k, 1)) for k in (3, 4, 5))
        self.byte_fallback = bool(trainer.get(35, 0))
        self.ids = {p: i for i, (p, t) in enumerate(zip(self.pieces, self.types)) if t == NORMAL}
        self.bytes_ids = {int(p[3:5], 16): i for i, (p, t) in enumerate(zip(self.pieces, self.types)) if t == BYTE}
        self.byte_of = {i: bytes([b]) for b, i in self.bytes_ids.items()}
        self.unk, self.eos = self.types.index(UNKNOWN), trainer.get(42, 2)
        # Sizes that pieces with given last three (or two) characters can have, longest first.
        sizes: dict[str, set[int]] = {}
        for p in self.rank:
            sizes.setdefault(p[-3:], {1}).add(len(p))
        for tail, known in sizes.items():
            if tail[-2:] in self.rank:
                known.add(2)
        self.sizes = {k: tuple(sorted(v, reverse=True)) for k, v in sizes.items() if len(k) > 1}
        self._walked: tuple[str, list[int], list[str]] = "", [0], [""]
        # No piece reaches from other text into a following space or across a line feed:
        # such places cut the text into chunks that encode independently.
        whole = any(SPACE in p.lstrip(SPACE) for p in self.rank)
        line = "" if any("\n" in p for p in self.rank) else "\n"
        self.chunks = re.compile(r"(?s).+" if whole else f"{SPACE}*[^{SPACE}{line}]+|{SPACE}+" + (r"|\n" if line else ""))
        self._fits: dict[tuple[str, str], bool] = {}

    @property
    def plain(self) -> bool:
        """The normaliser only marks spaces, so a prefix of a text has a prefix as its normal form."""
        return not self.charmap.units and not self.squeeze and self.escape

    # --- normalisation -------------------------------------------------------------------------

    def normalise(self, text: str) -> tuple[str, list[int], list[int]]:
        """The normal form and, for each of its characters, begin and end byte of its source."""
        data = text.encode()
        parts: list[tuple[str, int, int]] = []
        at = 0
        while at < len(data):
            hit = self.charmap.match(data, at)
            if hit is None:
                lead = data[at]
                used = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                parts.append((data[at : at + used].decode(), at, at + used))
            else:
                used = hit[0]
                parts.append((hit[1].decode(), at, at + used))
            at += used
        if self.squeeze:
            parts = self._squeezed(parts)
        mark = SPACE if self.escape else " "
        out, begins, ends = [], [], []
        if self.dummy_prefix and parts:
            start = parts[0][1]
            out, begins, ends = [mark], [start], [start]
        for chars, b, e in parts:
            for k, ch in enumerate(chars):
                out.append(mark if ch == " " else ch)
                begins.append(b)
                # The source of a replacement counts once, with its last character.
                ends.append(e if k == len(chars) - 1 else b)
        return "".join(out), begins, ends

    @staticmethod
    def _squeezed(parts):
        kept, after_space = [], True
        for chars, b, e in parts:
            while after_space and chars.startswith(" "):
                chars = chars[1:]
            if chars:
                kept.append((chars, b, e))
                after_space = chars.endswith(" ")
        while kept and kept[-1][0].endswith(" "):
            chars, b, e = kept.pop()
            if chars.rstrip(" "):
                kept.append((chars.rstrip(" "), b, e))
        return kept

    # --- merges --------------------------------------------------------------------------------

    def merge(self, chunk: str) -> list[str]:
        """Symbols of a chunk after all merges: best score first, leftmost of equals."""
        if len(chunk) > 48:
            return self._merge_long(chunk)
        rank, symbols = self.rank.get, list(chunk)
        scores = [rank(a + b) for a, b in zip(symbols, symbols[1:])]
        while True:
            best, where = None, -1
            for i, s in enumerate(scores):
                if s is not None and (best is None or s < best):
                    best, where = s, i
            if best is None:
                return symbols
            symbols[where : where + 2] = [symbols[where] + symbols[where + 1]]
            del scores[where]
            if where:
                scores[where - 1] = rank(symbols[where - 1] + symbols[where])
            if where < len(scores):
                scores[where] = rank(symbols[where] + symbols[where + 1])

    def _merge_long(self, chunk: str) -> list[str]:
        rank, n = self.rank.get, len(chunk)
        symbols, after, before = list(chunk), list(range(1, n + 1)), list(range(-1, n - 1))
        queue: list = []

        def offer(i: int):
            j = after[i]
            if j < n and (s := rank(symbols[i] + symbols[j])) is not None:
                heapq.heappush(queue, (s, i, symbols[i], symbols[j]))

        for i in range(n - 1):
            offer(i)
        while queue:
            _, i, left, right = heapq.heappop(queue)
            j = after[i] if symbols[i] is not None else n
            if j >= n or symbols[i] != left or symbols[j] != right:
                continue
            symbols[i], symbols[j] = left + right, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [s for s in symbols if s is not None]

    def symbol_ids(self, symbol: str) -> list[int]:
        """One id, or the byte pieces of a character outside the vocabulary."""
        found = self.ids.get(symbol)
        if found is not None:
            return [found]
        if not self.byte_fallback:
            return [self.unk]
        return [self.bytes_ids[b] for b in symbol.encode()]

    # --- prefix counts -------------------------------------------------------------------------

    def fits(self, left: str, right: str) -> bool:
        """Both stay as they are side by side (no left one: the symbol stays whole alone).

        A split is the encoding iff all its neighbours fit: the first merge across a border would need
        only the two symbols at that border, and would take place between them alone as well.
        """
        key = left, right
        known = self._fits.get(key)
        if known is None:
            if len(self._fits) > 400_000:
                self._fits.clear()
            known = self._fits[key] = self.merge(left + right) == ([left, right] if left else [right])
        return known

    def walk(self, chunk: str) -> tuple[list[int], list[str]]:
        """Token count and last symbol of every prefix of a chunk (from 0), by dynamic programming.

        The encoding of a prefix is the encoding of a shorter prefix plus one symbol that fits its last one.
        What it shares with the chunk before is not computed again, so chunks come cheapest in sorted order.
        """
        before, counts, last = self._walked
        shared, most = 0, min(len(before), len(chunk))
        while shared < most and before[shared] == chunk[shared]:
            shared += 1
        del counts[shared + 1 :], last[shared + 1 :]
        rank, sizes, fits = self.rank, self.sizes, self._fits
        for end in range(shared + 1, len(chunk) + 1):
            tail = chunk[end - 3 : end] if end > 2 else chunk[:end]
            for size in sizes.get(tail) or sizes.get(tail[1:], (1,)):
                start = end - size
                if start < 0:
                    continue
                symbol = chunk[start:end]
                if size > 1 and symbol not in rank:
                    continue
                fit = fits.get((last[start], symbol))
                if fit if fit is not None else self.fits(last[start], symbol):
                    counts.append(counts[start] + (1 if symbol in rank or not self.byte_fallback else len(symbol.encode())))
                    last.append(symbol)
                    break
        self._walked = chunk, counts, last
        return counts, last

    # --- decoding ------------------------------------------------------------------------------

    def decode(self, ids) -> str:
        """Text of ids; control pieces are silent, broken byte runs give replacement characters."""
        out, run = [], []

        def flush():
            if run:
                out.append(b"".join(run).decode("utf-8", errors="replace"))
                run.clear()

        first = True
        for i in ids:
            kind = self.types[i]
            if kind == BYTE:
                run.append(self.byte_of[i])
                first = False
                continue
            if kind == CONTROL:
                continue
            flush()
            piece = " ⁇ " if kind == UNKNOWN else self.pieces[i]
            if first and self.dummy_prefix and piece.startswith(SPACE):
                piece = piece[1:]
            first = False
            out.append(piece.replace(SPACE, " "))
        flush()
        return "".join(out)
