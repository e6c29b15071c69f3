"""Operator 12: SimHash near-duplicates by Golay-code fuzzy hashing.

The fingerprint of a text has a bit per place of its shingle hashes: set if over half of them have it. Two
fingerprints are linked if at most four of the 64 bits differ. The bits are cut into three segments, each padded to a
word of the binary Golay code of length 23. Every such word is within three bits of exactly one codeword; the indices
of the codewords that a word and its one-bit neighbours decode to, one or six, are its keys: words that differ in two
bits or less have a neighbour in common, so they share a key.

Pigeonhole: of four errors in three segments, either one segment has none and another two at most (the first is
compared as it is, the second by its keys), or no segment has more than two (all three by their keys). Distinct
fingerprints meet at equal keys, where they are compared. Copies collapse before that.

Large groups of different fingerprints at one key: a group leaves only links that hang its members together, never
all pairs. Keys that are frequent within a task are marked there, and groups of more than ``GROUP`` are not compared:
their members go round the keys. Two fingerprints differ in at most four bits exactly if some word is within two bits
of both, so each writes the 2,081 words around it, and those around one word are linked. No word has more than 2,081.

Defined cases: a null or wordless text has fingerprint zero and is linked like any other; fewer words than a shingle
are one shingle; long texts are taken whole; rows with equal ids are separate rows; a null id is no component id
unless all ids of the component are null; an empty table gives no row; other columns are not carried.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.common import BatchWriter, rows_in, stored, texts, tidy_task
from seriesmill.llm.components import components

WORDS = 4
SEED = 42
DISTANCE = 4
#: (lowest bit, bits) of the three segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Generator polynomial of the binary Golay code of length 23 with 12 message bits (fixed value).
GENERATOR = 0b110001110101
#: Fingerprints whose keys are made together; keys that more than ``HOT`` of them have are marked.
TOGETHER, HOT = 16_384, 256
#: Largest group that is compared within itself.
GROUP = 4_096
#: Rows of a sorted partition that are looked at together.
ROWS = 200_000


# --- fingerprints --------------------------------------------------------------------------------

BITS = np.unpackbits(np.arange(256, dtype="u1")[:, None], axis=1).astype("i8")


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The majority of each bit over all shingles, repeats included; bytes split at exactly the blanks of the definition."""
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    size = min(words, len(found))
    joined, widths = b" ".join(found), np.fromiter(map(len, found), "i8", len(found))
    stops = np.cumsum(widths + 1) - 1
    begins, ends = (stops - widths)[: len(found) - size + 1], stops[size - 1 :]
    digest, counts, n = xxhash.xxh64_digest, np.zeros((8, 256), "i8"), len(begins)
    for at in range(0, n, 100_000):
        hashes = [digest(joined[a:b], SEED) for a, b in zip(begins[at : at + 100_000].tolist(), ends[at : at + 100_000].tolist())]
        places = np.frombuffer(b"".join(hashes), "u1").reshape(-1, 8) + 256 * np.arange(8)
        counts += np.bincount(places.ravel(), minlength=2048).reshape(8, 256)
    bits = np.concatenate([row @ BITS for row in counts]) * 2 > n
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): the fingerprint of every text as a signed 64-bit number."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches):
        out = BatchWriter(schema)
        for doc_id, text in rows_in(batches):
            value = fingerprint(text, words)
            out.add(16, doc_id, value - (1 << 64) if value >> 63 else value)
            if out.full():
                yield out.take()
        if out.size:
            yield out.take()

    return texts(docs, id_col, text_col).mapInArrow(tidy_task(run), "doc_id bigint, fp bigint")


# --- keys ----------------------------------------------------------------------------------------


@functools.cache
def golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Remainders of the upper 12 bits; for every syndrome what turns a word into the codewords that it and its one-bit
    neighbours decode to, six places, and how many of those are in use."""
    remainder = np.arange(1 << 12, dtype="i8") << 11
    for bit in range(22, 10, -1):
        remainder = np.where(remainder >> bit & 1, remainder ^ GENERATOR << (bit - 11), remainder)
    syndrome = lambda w: w & 2047 ^ remainder[w >> 11]
    errors = np.array([sum(1 << b for b in c) for n in range(4) for c in combinations(range(23), n)], "i8")
    leader = np.zeros(2048, "i8")
    leader[syndrome(errors)] = errors
    flips = np.concatenate([[0], 1 << np.arange(23, dtype="i8")])
    s = np.arange(2048)
    found = np.sort(flips ^ leader[s[:, None] ^ syndrome(flips)], axis=1)
    table, used = np.zeros((2048, 6), "i8"), np.zeros(2048, "i8")
    for k in range(2048):
        some = np.unique(found[k])
        used[k] = len(some)
        table[k, : len(some)] = some
        table[k, len(some) :] = some[0]
    return remainder, table, used


def indices(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The six places of keys of each 23-bit word, and which are in use."""
    remainder, table, used = golay()
    s = words & 2047 ^ remainder[words >> 11]
    return (words[:, None] ^ table[s]) >> 11, np.arange(6) < used[s][:, None]


def keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, row of its fingerprint) for unsigned fingerprints, each key of a fingerprint once."""
    parts = [(fps >> np.uint64(low) & np.uint64((1 << width) - 1)).astype("i8") for low, width in SEGMENTS]
    near = [indices(p) for p in parts]
    rows, out, owner = np.arange(len(fps)), [], []

    def add(tag: int, values: np.ndarray, valid: np.ndarray):
        out.append((values | tag << 40)[valid])
        owner.append(np.broadcast_to(rows.reshape(-1, *[1] * (values.ndim - 1)), values.shape)[valid])

    for i in range(3):
        for j in range(3):
            if i != j:
                add(3 * i + j, parts[i][:, None] << 12 | near[j][0], near[j][1])
    (a, in_a), (b, in_b), (c, in_c) = near
    add(9, a[:, :, None, None] << 24 | b[:, None, :, None] << 12 | c[:, None, None, :], in_a[:, :, None, None] & in_b[:, None, :, None] & in_c[:, None, None, :])
    return np.concatenate(out), np.concatenate(owner)


def dealt(distinct: DataFrame, per_task: int) -> DataFrame:
    """The ``fp`` column over enough tasks: rows are few and small before they are multiplied, so sizes would make too few."""
    tasks = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return distinct.select("fp").repartition(max(tasks, -(-distinct.count() // per_task)), "fp")


KEYED = pa.schema([("key", pa.int64()), ("fp", pa.int64()), ("hot", pa.bool_())])


def keyed(distinct: DataFrame) -> DataFrame:
    """(key, fp, hot): all keys of all fingerprints. Of a key that is hot among fingerprints at hand one row stays, marked;
    the fingerprints behind it come once more each, marked, under a key of their own (negative)."""

    def some(fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        key, owner = keys(fps.view("u8"))
        order = np.argsort(key, kind="stable")
        key, fp = key[order], fps[owner[order]]
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        sizes = np.diff(np.append(starts, len(key)))
        hot = np.repeat(sizes > HOT, sizes)
        marks = starts[sizes > HOT]
        loose = np.unique(fp[hot])
        key = np.concatenate([key[~hot], key[marks], -1 - (loose & (1 << 62) - 1)])
        fp, flag = np.concatenate([fp[~hot], fp[marks], loose]), np.concatenate([np.zeros(int((~hot).sum()), bool), np.ones(len(marks) + len(loose), bool)])
        for at in range(0, len(key), ROWS):
            yield pa.RecordBatch.from_arrays([pa.array(x[at : at + ROWS]) for x in (key, fp, flag)], schema=KEYED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy())
            n += batch.num_rows
            if n >= TOGETHER:
                fps = np.concatenate(held)
                for at in range(0, n - n % TOGETHER, TOGETHER):
                    yield from some(fps[at : at + TOGETHER])
                held, n = [fps[n - n % TOGETHER :]], n % TOGETHER
        if n:
            yield from some(np.concatenate(held))

    return dealt(distinct, 2 * TOGETHER).mapInArrow(tidy_task(run), "key bigint, fp bigint, hot boolean")


# --- links ---------------------------------------------------------------------------------------


def close(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a.view("u8") ^ b.view("u8")) <= DISTANCE


def forest(members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that hang together what is linked among the members: every member is reached once."""
    left, right, rest = [], [], members
    while len(rest) > 1:
        front, rest = rest[:1], rest[1:]
        while len(front) and len(rest):
            near = close(np.broadcast_to(front[:1], rest.shape).copy(), rest)
            left.append(np.full(int(near.sum()), front[0])), right.append(rest[near])
            front, rest = np.concatenate([front[1:], rest[near]]), rest[~near]
    none = np.zeros(0, "i8")
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def links_among(key: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links within groups of equal keys; rows come group after group. All members are compared with the first of their
    group at once; only groups in which that leaves some unlinked are looked at one by one."""
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    sizes = np.diff(np.append(starts, len(key)))
    first = np.repeat(fp[starts], sizes)
    near = close(first, fp)
    left, right = [first[near & (first != fp)]], [fp[near & (first != fp)]]
    missed = sizes - np.add.reduceat(near.astype("i8"), starts)
    for k in np.flatnonzero((missed > 0) & (sizes > 2)).tolist():
        members = np.unique(fp[starts[k] : starts[k] + sizes[k]])
        if len(members) <= 256 and not np.triu(np.bitwise_count(members.view("u8")[:, None] ^ members.view("u8")[None, :]) <= DISTANCE, 1).any():
            continue
        a, b = forest(members)
        left.append(a), right.append(b)
    pairs = np.unique(np.stack([np.concatenate(left), np.concatenate(right)], 1), axis=0)
    return pairs[:, 0], pairs[:, 1]


LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("open", pa.bool_())])


def _whole_groups(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[list[np.ndarray], bool]]:
    """Columns of consecutive whole groups of equal first columns; a group above ``limit`` rows comes in parts by itself (flag)."""
    held, n, over = [], 0, None
    for batch in batches:
        held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        n += batch.num_rows
        if n < ROWS:
            continue
        columns = [np.concatenate(c) for c in zip(*held)]
        if over is not None:
            upto = int(np.searchsorted(columns[0], over, side="right"))
            if upto:
                yield [c[:upto] for c in columns], True
            columns, over = [c[upto:] for c in columns], over if upto == n else None
        cut = int(np.searchsorted(columns[0], columns[0][-1])) if len(columns[0]) else 0
        if cut:
            yield [c[:cut] for c in columns], False
        if len(columns[0]) - cut > limit:
            over = columns[0][-1]
            yield [c[cut:] for c in columns], True
            cut = len(columns[0])
        held, n = [[c[cut:] for c in columns]], len(columns[0]) - cut
    if n:
        columns = [np.concatenate(c) for c in zip(*held)]
        upto = int(np.searchsorted(columns[0], over, side="right")) if over is not None else 0
        if upto:
            yield [c[:upto] for c in columns], True
        if upto < len(columns[0]):
            yield [c[upto:] for c in columns], False


def linked(rows: DataFrame, group: int = GROUP) -> DataFrame:
    """(a, b, open): links between fingerprints that share a key; ``open`` rows name fingerprints of large groups (b = a)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (key, fp, hot), whole in _whole_groups(batches, group):
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            sizes = np.diff(np.append(starts, len(key)))
            large = np.repeat(np.logical_or.reduceat(hot, starts) | (sizes > group), sizes) | whole
            alone = np.repeat(sizes, sizes) == 1
            a, b = links_among(key[~large & ~alone], fp[~large & ~alone]) if (~large & ~alone).any() else (key[:0], key[:0])
            loose = np.unique(fp[large])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([a, loose])), pa.array(np.concatenate([b, loose])), pa.array(np.arange(len(a) + len(loose)) >= len(a))], schema=LINKS)

    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(tidy_task(run), "a bigint, b bigint, open boolean")


def ball(bits: int = 64, radius: int = DISTANCE // 2) -> np.ndarray:
    """What turns a word into all words within ``radius`` bits."""
    return np.array([sum(1 << b for b in c) for n in range(radius + 1) for c in combinations(range(bits), n)], "u8")


def linked_around(loose: DataFrame) -> DataFrame:
    """(a, b): links among fingerprints by the words around them. Fingerprints around one word are linked without a look."""
    masks = ball()

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy().view("u8")
            for at in range(0, len(fps), 64):
                some = fps[at : at + 64]
                words = (some[:, None] ^ masks).ravel()
                yield pa.RecordBatch.from_arrays([pa.array(words.view("i8")), pa.array(np.repeat(some, len(masks)).view("i8"))], names=["word", "fp"])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (word, fp), _ in _whole_groups(batches, len(masks)):
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            first = np.repeat(fp[starts], np.diff(np.append(starts, len(word))))
            found = np.unique(np.stack([first, fp], 1)[first != fp], axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

    words = dealt(loose, TOGETHER // 16).mapInArrow(around, "word bigint, fp bigint")
    return words.repartition("word").sortWithinPartitions("word").mapInArrow(tidy_task(pairs), "a bigint, b bigint")


def link_fingerprints(distinct: DataFrame, group: int = GROUP) -> DataFrame:
    """(node, root): components of more than one fingerprint, from a *stored* table of distinct ones."""
    found = stored(linked(keyed(distinct), group), "golay-links")
    links = found.where("not open").select("a", "b")
    loose = stored(found.where("open").select(F.col("a").alias("fp")).distinct(), "golay-open")
    if not loose.isEmpty():
        links = links.union(stored(linked_around(loose).distinct(), "golay-around"))
    return components(links)


def near_duplicates(docs: DataFrame, words: int = WORDS, group: int = GROUP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id), a row per document: its fingerprint and the smallest id that its links reach."""
    own = stored(fingerprints(docs, words, id_col, text_col), "fingerprints")
    per_fp = stored(own.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = link_fingerprints(per_fp, group)
    rooted = stored(per_fp.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "rooted")
    # Both sides of each join come straight from an exchange, so that adaptive execution can split a hot value.
    per_root = stored(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "names")
    names = stored(rooted.join(per_root, "root").select("fp", "component_id"), "components")
    return own.join(names, "fp").select("doc_id", "fp", "component_id")
