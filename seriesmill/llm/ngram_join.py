"""Operator 4: n-gram Jaccard join by T-occurrence search.

Documents with the same shingle set are one set. Shingles are counted in cells, equal parts of the hash
range: most occur in one set only and can never be shared. The others get inverted lists, ordered from
rare to frequent; a set has to look only into the lists of its first ``n - ceil(0.8 n) + 1`` shingles in
that order, as two linked sets always meet there (prefix filtering).

* Short lists (up to ``SHORT`` sets) are heap-merged per set; a candidate must occur often enough for the
  required overlap to be within reach of what both sets hold after the last list in which they meet. Candidates
  are then compared by binary search.
* Long lists are never paired up. Sets that meet only there (large groups of near copies) are linked to
  one hub per family of lists; what does not fall into one component that way is searched block against
  block with DivideSkip, so every missing link is still found.

A shingle that is hot within a task is marked there and goes round its cell; a cell gets at most ``SHORT``
entries of a shingle from each flush. Hashes have 64 bits (48 and the cell number in transit): two different shingles of one pair of
documents coincide with a chance below 1e-6.

Defined cases: a null or wordless text has an empty set, linked with nothing; fewer than five words are
one shingle; long texts are taken whole; rows with equal ids are separate texts and each has its row; a
null id is never a component id unless all ids of the component are null; an empty table gives no row;
other columns are not carried.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seriesmill.llm.common import BatchWriter, give_back, rows_in, stored, texts, tidy_task, worker_cache
from seriesmill.llm.components import components

WORDS = 5
#: Required similarity as a fraction.
NUMERATOR, DENOMINATOR = 80, 100
SHORT = 64
FLUSH_VALUES = 700_000
CELL_VALUES = 3_000_000
#: At least 2**6 cells, so that small inputs spread over cores too; at most 2**26, enough for 200 TB of text.
LEAST_BITS, MOST_BITS = 6, 26
BLOCK = 256
GOLDEN, MIX_A, MIX_B = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


# --- sets --------------------------------------------------------------------------------------


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 120_000:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, hashes: dict[bytes, int], words: int = WORDS) -> np.ndarray:
    """Sorted hashes of the distinct shingles. Bytes split at exactly the blanks of the definition and lower-case A-Z only."""
    found = (text or "").encode().lower().split()
    if not found:
        return np.zeros(0, "u8")
    h = np.fromiter(map(hashes.__getitem__, found), "u8", len(found))
    size = min(words, len(h))
    out = _mix(h[: len(h) - size + 1] + np.uint64(size))
    for k in range(1, size):
        out = _mix(out * GOLDEN + h[k : len(h) - size + 1 + k])
    return np.unique(out)


def set_key(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def document_sets(docs: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, key, n): the set of every document by its digest, and its size."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("key", pa.binary()), ("n", pa.int64())])

    def run(batches):
        hashes = worker_cache("words", WordHashes)
        out = BatchWriter(schema)
        for batch in batches:
            for (doc_id, text), text_key in zip(rows_in([batch]), batch.column(2)):
                values = shingle_set(text, hashes, words)
                out.add(40, doc_id, text_key.as_py(), set_key(values), len(values))
            if out.full():
                yield out.take()
        if out.size:
            yield out.take()

    own = texts(docs, id_col, text_col).withColumn("text_key", F.xxhash64("text"))
    return own.mapInArrow(tidy_task(run), "doc_id bigint, text_key bigint, key binary, n bigint")


# --- cells: which shingles are shared, by how many sets ------------------------------------------


def _squeeze(values: np.ndarray) -> bytes:
    """The low 48 bits of each value."""
    return np.ascontiguousarray(values.astype("<u8").view("<u2").reshape(-1, 4)[:, :3]).tobytes()


def _unsqueeze(data: np.ndarray, cell: int, bits: int) -> np.ndarray:
    out = np.zeros((len(data) // 6, 4), "<u2")
    out[:, :3] = data.view("<u2").reshape(-1, 3)
    return out.view("<u8").ravel() | np.uint64(cell << (64 - bits))


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal values."""
    starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, "i8")
    return starts, np.diff(np.append(starts, len(values)))


def _norm(values: np.ndarray, bits: int) -> np.ndarray:
    """What is left of a hash after transit: the bits of the cell number and the low 48."""
    keep = np.uint64(((1 << bits) - 1) << (64 - bits) | (1 << 48) - 1)
    return values & keep


CELL = "cell bigint, sets binary, sizes binary, counts binary, vals binary, hot binary"


def cell_rows(docs: DataFrame, bits: int, words: int = WORDS) -> DataFrame:
    """(cell, sets, sizes, counts, vals, hot): for each flush of a task one row per cell with the shingles of its sets, set
    after set. Shingles in over ``SHORT`` sets of the flush are only marked there (``hot``); with their sets they go into
    a row of their own, whose cell is negative and belongs to this flush alone."""
    schema = pa.schema([("cell", pa.int64()), *[(c, pa.binary()) for c in ("sets", "sizes", "counts", "vals", "hot")]])

    def flush(held: dict[bytes, np.ndarray], number: int) -> Iterator[pa.RecordBatch]:
        keys = np.frombuffer(b"".join(held), "V16")
        sizes = np.array([len(v) for v in held.values()], "<i8")
        values = _norm(np.concatenate(list(held.values())), bits)
        owner = np.repeat(np.arange(len(keys), dtype="i4"), sizes)
        ordered = np.sort(values)
        starts, lengths = _runs(ordered)
        hot = ordered[starts[lengths > SHORT]]
        del ordered
        out = BatchWriter(schema)

        def add(cell: int, values: bytes, owner: np.ndarray, marks: bytes) -> None:
            first, count = _runs(owner)
            own = owner[first]
            out.add(len(values) + 32 * len(own), cell, keys[own].tobytes(), sizes[own].tobytes(), count.astype("<i4").tobytes(), values, marks)

        if len(hot):
            is_hot = _among(values, hot)
            add(-number, values[is_hot].tobytes(), owner[is_hot], b"")
            values, owner = values[~is_hot], owner[~is_hot]
        cells, hot_cells = ((v >> np.uint64(64 - bits)).astype("u2" if bits <= 16 else "u4") for v in (values, hot))
        order = np.argsort(cells, kind="stable")  # set after set within a cell
        values, owner, cells = values[order], owner[order], cells[order]
        for cell in np.union1d(cells, hot_cells).tolist():
            lo, hi = np.searchsorted(cells, cell), np.searchsorted(cells, cell, side="right")
            add(cell, _squeeze(values[lo:hi]), owner[lo:hi], _squeeze(hot[hot_cells == cell]))
            if out.full():
                yield out.take()
        if out.size:
            yield out.take()

    def run(batches):
        hashes = worker_cache("words", WordHashes)
        held: dict[bytes, np.ndarray] = {}
        size, number = 0, TaskContext.get().partitionId() << 24
        for _, text in rows_in(batches):
            values = shingle_set(text, hashes, words)
            if len(values) and (key := set_key(values)) not in held:
                held[key] = values
                size += len(values)
                if size >= FLUSH_VALUES:
                    number += 1
                    yield from flush(held, number)
                    held, size = {}, 0
        if held:
            yield from flush(held, number + 1)

    return docs.select(F.lit(0).cast("bigint"), "text").mapInArrow(tidy_task(run), CELL)


def _among(values: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Which values are in the sorted ``some``."""
    if not len(some):
        return np.zeros(len(values), bool)
    return some[np.minimum(np.searchsorted(some, values), len(some) - 1)] == values


def _bytes_of(column: pa.ChunkedArray) -> np.ndarray:
    """All bytes of a binary column, one value after the other, without making Python objects."""
    parts = []
    for chunk in column.chunks:
        _, offsets, data = chunk.buffers()
        ends = np.frombuffer(offsets, "<i4")[chunk.offset : chunk.offset + len(chunk) + 1]
        if data is not None and len(chunk):
            parts.append(np.frombuffer(data, "u1")[ends[0] : ends[-1]])
    return np.concatenate(parts) if len(parts) > 1 else parts[0] if parts else np.zeros(0, "u1")


def _binary(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary column whose values are cut from ``data`` at the byte positions ``ends`` (the first is 0)."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype("<i4")), pa.py_buffer(np.ascontiguousarray(data))])


SHARED = pa.schema([("key", pa.binary()), ("n", pa.int64()), ("vals", pa.binary()), ("dfs", pa.binary())])


def shared_in_cell(cell: int, rows: pa.Table, bits: int) -> pa.Table:
    """(key, n, vals, dfs) for each set with shared shingles in the cell; df 0 marks a shingle of a long list."""
    keys, sizes, counts = (_bytes_of(rows.column(c)).view(t) for c, t in (("sets", "V16"), ("sizes", "<i8"), ("counts", "<i4")))
    data = _bytes_of(rows.column("vals"))
    owner = np.repeat(np.arange(len(keys), dtype="i4"), counts)
    if cell < 0:  # marked in their task already
        values, df = data.view("<u8"), np.zeros(len(owner), "<u2")
    else:
        values = _unsqueeze(data, cell, bits)
        hot = np.unique(_unsqueeze(_bytes_of(rows.column("hot")), cell, bits))
        kept = np.zeros(len(keys), bool)
        kept[np.unique(keys, return_index=True)[1]] = True  # a set that came with several flushes counts once
        use = kept[owner]
        values, owner = values[use], owner[use]
        order = np.argsort(values, kind="stable")
        values, owner = values[order], owner[order]
        del order, use, data
        _, lengths = _runs(values)
        times = np.repeat(np.minimum(lengths, SHORT + 1).astype("<u2"), lengths)
        times[_among(values, hot)] = SHORT + 1
        use = times > 1
        values, owner, times = values[use], owner[use], times[use]
        df = np.where(times > SHORT, 0, times).astype("<u2")
        order = np.argsort(owner, kind="stable")
        values, owner, df = values[order], owner[order], df[order]
    starts, _ = _runs(owner)
    own = owner[starts]
    ends = np.append(starts, len(owner))
    return pa.table([_binary(keys[own], 16 * np.arange(len(own) + 1)), pa.array(sizes[own]), _binary(values, 8 * ends), _binary(df, 2 * ends)], schema=SHARED)


def least_overlap(a: int, b: int) -> int:
    """The smallest intersection with 100 * i >= 80 * (a + b - i)."""
    return -(-NUMERATOR * (a + b) // (NUMERATOR + DENOMINATOR))


def prefix_size(n: int) -> int:
    return n - -(-NUMERATOR * n // DENOMINATOR) + 1


def survivors(cells: DataFrame) -> DataFrame:
    """(key, n, shared, short, long): sets that may be linked. ``shared``: sorted shared shingles; ``short`` and ``long``:
    the shingles of its prefix that have short and long lists. A set whose prefix is all its own is gone."""
    parts = cells.groupBy("key").agg(F.max("n").alias("n"), F.collect_set(F.struct("vals", "dfs")).alias("parts"))
    schema = pa.schema([("key", pa.binary()), ("n", pa.int64()), ("shared", pa.binary()), ("short", pa.list_(pa.int64())), ("long", pa.list_(pa.int64()))])

    def run(batches):
        out = BatchWriter(schema)
        for batch in batches:
            for i in range(batch.num_rows):
                key, n, found = (batch.column(c)[i].as_py() for c in range(3))
                values, at = np.unique(np.frombuffer(b"".join([p["vals"] for p in found]), "<u8"), return_index=True)
                df = np.frombuffer(b"".join([p["dfs"] for p in found]), "<u2").astype("i8")[at]
                room = prefix_size(n) - (n - len(values))
                if room <= 0:
                    continue
                df[df == 0] = SHORT + 1  # long ones come last
                head = np.lexsort((values, df))[:room]
                is_long = df[head] > SHORT
                signed = values[head].view("i8")
                out.add(8 * len(values) + 16 * room, key, n, values.tobytes(), signed[~is_long], signed[is_long])
                if out.full():
                    yield out.take()
        if out.size:
            yield out.take()

    return parts.mapInArrow(tidy_task(run), "key binary, n bigint, shared binary, short array<bigint>, long array<bigint>")


# --- candidates ----------------------------------------------------------------------------------


def merge_lists(me: tuple[int, bytes], lists: list[list[tuple]], left_out: int | None = None) -> list[bytes]:
    """Heap-merge of the sorted short lists of one set: those after it in (size, key) order that occur often enough.

    ``left_out``: how many shingles the set could share with any other besides the merged lists. Without it, entries have a
    third field: how many the two could still share after the shingle of the list; the least one counts.
    """
    out, last, times = [], None, 0

    def close():
        if last is None or last[:2] <= me or DENOMINATOR * me[0] < NUMERATOR * last[0]:
            return
        if times + (last[2] if left_out is None else left_out) >= least_overlap(me[0], last[0]):
            out.append(last[1])

    for entry in heapq.merge(*lists):
        if last is not None and entry[:2] == last[:2]:
            times += 1  # the first entry of a set has the least third field
            continue
        close()
        last, times = entry, 1
    close()
    return out


def short_candidates(alive: DataFrame) -> DataFrame:
    """(x, y): pairs that meet often enough in short lists.

    Lists hold prefixes only, so a list without a set says nothing about its shingle. But prefixes are the first shingles of
    one order: up to the last list in which two sets meet, they share just the lists they meet in, and after it at most
    the shared shingles that the one with fewer has left (``after``).
    """
    after = (F.octet_length("shared") / 8 - 1).cast("int")
    rows = alive.select("key", "n", after.alias("after"), F.posexplode("short").alias("pos", "val")).select("val", "key", "n", (F.col("after") - F.col("pos")).alias("after"))
    lists = rows.groupBy("val").agg(F.array_sort(F.collect_list(F.struct("n", "key", "after"))).alias("members")).where(F.size("members") > 1)
    mine = lists.select(F.explode("members").alias("me"), "members")
    mine = mine.groupBy("me.key", "me.n").agg(F.collect_list(F.struct(F.col("me.after").alias("after"), "members")).alias("lists"))
    schema = pa.schema([("x", pa.binary()), ("y", pa.binary())])

    def run(batches):
        out = BatchWriter(schema)
        for batch in batches:
            for i in range(batch.num_rows):
                key, n, lists = (batch.column(c)[i].as_py() for c in range(3))
                reach = [[(m["n"], m["key"], min(m["after"], one["after"])) for m in one["members"]] for one in lists]
                for other in merge_lists((n, key), reach):
                    out.add(32, key, other)
                if out.full():
                    yield out.take()
        if out.size:
            yield out.take()

    return mine.mapInArrow(tidy_task(run), "x binary, y binary")


def families(alive: DataFrame) -> DataFrame:
    """(hub, band, key): sets that meet in long lists of one band of sizes, with the smallest set of the list.

    Linked sets differ in size by a quarter at most, so they share one of two neighbouring bands.
    """
    band = F.floor(F.log(F.col("n")) / float(np.log(DENOMINATOR / NUMERATOR)) + 1e-9).cast("int")
    rows = alive.where(F.size("long") > 0).select("key", "n", F.explode("long").alias("val"), band.alias("b"))
    rows = rows.select("key", "n", "val", F.explode(F.array(F.col("b") - 1, F.col("b"))).alias("band"))
    # Stored before the join, so that adaptive execution can split a list with very many sets.
    hubs = stored(rows.groupBy("val", "band").agg(F.min(F.struct("n", "key")).alias("hub")), "hubs")
    return rows.join(hubs, ["val", "band"]).select(F.col("hub.key").alias("hub"), "band", "key").distinct()


def verified(pairs: DataFrame, alive: DataFrame) -> DataFrame:
    """(a, b): the pairs that reach the required overlap; shingles of one set are looked up in the other by binary search."""
    xs = alive.select(F.col("key").alias("x"), F.col("n").alias("nx"), F.col("shared").alias("sx"))
    ys = alive.select(F.col("key").alias("y"), F.col("n").alias("ny"), F.col("shared").alias("sy"))
    full = pairs.distinct().join(xs, "x").join(ys, "y").where((DENOMINATOR * F.col("nx") >= NUMERATOR * F.col("ny")) & (DENOMINATOR * F.col("ny") >= NUMERATOR * F.col("nx")))
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def run(batches):
        out = BatchWriter(schema)
        for batch in batches:
            for i in range(batch.num_rows):
                x, y, nx, ny, sx, sy = (batch.column(c)[i].as_py() for c in range(6))
                a, b = np.frombuffer(sx, "<u8"), np.frombuffer(sy, "<u8")
                if len(a) and len(b) and int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum()) >= least_overlap(nx, ny):
                    out.add(32, x, y)
            if out.full():
                yield out.take()
        if out.size:
            yield out.take()

    return full.select("x", "y", "nx", "ny", "sx", "sy").mapInArrow(tidy_task(run), "a binary, b binary")


class DivideSkip:
    """Inverted lists of a block of sets."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray):
        self.sizes = sizes
        values = np.concatenate(sets) if sets else np.zeros(0, "u8")
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.argsort(values, kind="stable")
        self.owner = owner[order]
        ordered = values[order]
        self.starts, self.lengths = _runs(ordered)
        self.values = ordered[self.starts]

    def search(self, query: np.ndarray, n: int) -> np.ndarray:
        """Members of the block that share enough with the query of size ``n``: the longest lists are kept aside, the
        short ones merged, members that can still reach the overlap are looked up in the lists kept aside."""
        if not len(self.values) or not len(query):
            return np.zeros(0, "i8")
        at = np.minimum(np.searchsorted(self.values, query), len(self.values) - 1)
        at = at[self.values[at] == query]
        need = np.array([least_overlap(n, m) for m in self.sizes.tolist()])
        fits = (DENOMINATOR * n >= NUMERATOR * self.sizes) & (DENOMINATOR * self.sizes >= NUMERATOR * n)
        if not fits.any():
            return np.zeros(0, "i8")
        at = at[np.argsort(self.lengths[at], kind="stable")]
        # The heuristic of the method: the more the overlap asks for, the more lists may be left to probing.
        aside = min(len(at), int(need[fits].min() / (0.0085 * np.log2(max(2, self.lengths.max())) + 1)) - 1) if len(at) else 0
        short, long = (at[: len(at) - aside], at[len(at) - aside :]) if aside > 0 else (at, at[:0])
        merged = [self.owner[self.starts[k] : self.starts[k] + self.lengths[k]] for k in short.tolist()]
        times = np.bincount(np.concatenate(merged), minlength=len(self.sizes)) if merged else np.zeros(len(self.sizes), "i8")
        alive = np.flatnonzero(fits & (times + len(long) >= need))
        for k in long.tolist():
            if not len(alive):
                break
            one = self.owner[self.starts[k] : self.starts[k] + self.lengths[k]]  # ascending
            where = np.minimum(np.searchsorted(one, alive), len(one) - 1)
            times[alive] += one[where] == alive
        return alive[times[alive] >= need[alive]]


def open_links(family: DataFrame, roots: DataFrame, alive: DataFrame) -> DataFrame:
    """(a, b): links inside families between sets that are not yet in one component.

    Per family the largest component stays; every other member is searched against the whole family, in blocks of
    bounded size. A task keeps only links that join components for it.
    """
    root = F.coalesce("root", "key").alias("root")
    placed = family.join(roots.withColumnRenamed("node", "key"), "key", "left").select("hub", "band", "key", root)
    per_root = placed.groupBy("hub", "band", "root").agg(F.count(F.lit(1)).alias("c"))
    tops = per_root.groupBy("hub", "band").agg(F.max(F.struct("c", "root")).alias("top"), F.count(F.lit(1)).alias("roots"), F.sum("c").alias("size")).where("roots > 1")
    tops = tops.select("hub", "band", F.col("top.root").alias("top"), F.ceil(F.col("size") / BLOCK).alias("blocks"), F.ceil((F.col("size") - F.col("top.c")) / BLOCK).alias("chunks"))
    tops = stored(tops, "tops")
    todo = placed.join(tops, ["hub", "band"]).join(alive.select("key", "n", "shared"), "key")
    block = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    chunk = F.pmod(F.xxhash64("key", F.lit(3)), F.col("chunks")).cast("int")
    columns = ["hub", "band", "block", "chunk", "asks", "key", "root", "n", "shared"]
    index = todo.withColumn("block", block).withColumn("chunk", F.explode(F.sequence(F.lit(0), (F.col("chunks") - 1).cast("int")))).withColumn("asks", F.lit(False))
    asks = todo.where("root <> top").withColumn("chunk", chunk).withColumn("block", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int")))).withColumn("asks", F.lit(True))

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        asks, held = rows[rows["asks"]], rows[~rows["asks"]]
        lists = DivideSkip([np.frombuffer(s, "<u8") for s in held["shared"]], held["n"].to_numpy("i8"))
        keys, own = held["key"].tolist(), held["root"].tolist()
        lead: dict[bytes, bytes] = {}

        def top(r: bytes) -> bytes:
            while lead.get(r, r) != r:
                r = lead[r]
            return r

        out = []
        for key, mine, n, shared in zip(asks["key"], asks["root"], asks["n"], asks["shared"]):
            for k in lists.search(np.frombuffer(shared, "<u8"), int(n)).tolist():
                a, b = top(mine), top(own[k])
                if a != b:
                    lead[a] = b
                    out.append((key, keys[k]))
        return pd.DataFrame(out, columns=["a", "b"])

    both = index.select(columns).union(asks.select(columns))
    return both.groupBy("hub", "band", "block", "chunk").applyInPandas(search, "a binary, b binary")


def link_sets(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(node, root): components of linked sets with more than one set, over stored intermediate tables."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(MOST_BITS, max(LEAST_BITS, (size // 6 // CELL_VALUES).bit_length()))

    def in_cell(rows: pa.Table) -> pa.Table:
        try:
            return shared_in_cell(rows.column("cell")[0].as_py(), rows, bits)
        finally:
            give_back()

    cells = cell_rows(docs, bits, words).groupBy("cell").applyInArrow(in_cell, "key binary, n bigint, vals binary, dfs binary")
    alive = stored(survivors(cells), "sets")
    family = stored(families(alive), "families")
    stars = family.where("key <> hub").select(F.col("hub").alias("x"), F.col("key").alias("y"))
    links = stored(verified(short_candidates(alive).union(stars), alive), "verified")
    roots = components(links)
    more = stored(open_links(family, roots, alive), "open")
    if more.isEmpty():
        return roots
    return components(reduce(DataFrame.union, [links, more]))


def near_duplicates(docs: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id, component), a row per document: the hash of its text, the size of its
    set, the smallest id its links reach, and the key of the component (null for an empty set)."""
    own = texts(docs, id_col, text_col)
    sets = stored(document_sets(own, words), "documents")
    roots = link_sets(own, words)
    filled = sets.where("n > 0")
    per_key = filled.groupBy("key").agg(F.min("doc_id").alias("least"))
    rooted = per_key.join(roots.withColumnRenamed("node", "key"), "key", "left").select("key", "least", F.coalesce("root", "key").alias("component"))
    per_root = stored(rooted.groupBy("component").agg(F.min("least").alias("component_id")), "names")
    names = rooted.join(per_root, "component").select("key", "component_id", "component")
    linked = filled.join(names, "key").select("doc_id", "text_key", F.col("n").alias("n_shingles"), "component_id", "component")
    alone = sets.where("n = 0").select("doc_id", "text_key", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(None).cast("binary").alias("component"))
    return linked.union(alone)


def one_of_each(docs: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component, that of the smallest id (then text hash); all columns kept. Rows with an
    empty set are linked with nothing and stay."""
    found = near_duplicates(docs, words, id_col, text_col)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    best = found.where("component IS NOT NULL").groupBy("component").agg(F.min(order).alias("b")).select("b.doc_id", "b.text_key")
    empty = found.where("component IS NULL").select("doc_id", "text_key")
    keep = best.withColumn("__once", F.lit(True)).union(empty.distinct().withColumn("__once", F.lit(False)))
    keep = keep.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "__once")
    joined = docs.join(keep, docs[id_col].cast("bigint").eqNullSafe(F.col("__id")) & F.xxhash64(docs[text_col].cast("string")).eqNullSafe(F.col("__key")))
    # Repeated rows: the first of equal ones.
    nth = F.row_number().over(Window.partitionBy("__id", "__key").orderBy(F.lit(1)))
    return joined.withColumn("__nth", nth).where(~F.col("__once") | (F.col("__nth") == 1)).select(*docs.columns)
