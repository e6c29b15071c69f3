"""Shared helpers of the operators: inputs, intermediate tables, worker caches."""

from __future__ import annotations

import ctypes
import functools
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.session import fresh_path

#: Whitespace between words wherever an operator works on word shingles.
WORD_SEPARATORS = r"[\x20\x09-\x0D]+"


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) of any document table; other columns are left behind, so their names cannot clash."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read again: cuts lineage, survives lost executors, computes once."""
    spark: SparkSession = df.sparkSession
    path = fresh_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def worker_cache(key: str, make):
    """A value kept by the Python worker process between its tasks, such as a loaded vocabulary. The latest one only: a reused
    worker shall not hold what earlier stages needed."""
    kept = sys.__dict__.setdefault("_seriesmill_worker_cache", {})
    if key not in kept:
        kept.clear()
        kept[key] = make()
    return kept[key]


class ChunkMemo(dict):
    """Results per chunk of text. ``learn`` gets the missing ones, in sorted order and all at once from ``make_all``, and starts
    over when it is full."""

    def __init__(self, make_all, limit: int):
        super().__init__()
        self.make_all, self.limit, self.size = make_all, limit, 0

    def learn(self, chunks: set[str]) -> None:
        missing = {c for c in chunks if c not in self}
        weight = sum(map(len, missing)) + 16 * len(missing)
        if self.size and self.size + weight > self.limit:
            self.clear()
            self.size, missing = 0, chunks
            weight = sum(map(len, missing)) + 16 * len(missing)
        self.size += weight
        ordered = sorted(missing)
        self.update(zip(ordered, self.make_all(ordered)))


def give_back() -> None:
    """Return freed memory to the system: workers are reused, and what one task leaves would add to the next one's need."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # other C libraries have no such call
        pass


def tidy_task(run):
    """Wraps the function of a task over batches: whatever happens, its memory is given back at the end."""

    @functools.wraps(run)
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def rows_in(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(doc_id, text) one by one; a batch is never turned into Python objects as a whole."""
    for batch in batches:
        ids, values = batch.column(0), batch.column(1)
        for i in range(batch.num_rows):
            yield ids[i].as_py(), values[i].as_py()


def groups_of(rows: Iterator[tuple], characters: int = 2_000_000) -> Iterator[list[tuple]]:
    """Consecutive rows with about so many characters of text together; one longer text is a group by itself."""
    group, size = [], 0
    for row in rows:
        group.append(row)
        size += len(row[1] or "") + 16
        if size >= characters:
            yield group
            group, size = [], 0
    if group:
        yield group


class BatchWriter:
    """Collects rows as columns and gives a record batch whenever ``limit`` units of size are reached."""

    def __init__(self, schema: pa.Schema, limit: int = 4_000_000):
        self.schema, self.limit = schema, limit
        self.reset()

    def reset(self):
        self.columns = [[] for _ in self.schema]
        self.size = 0

    def add(self, size: int, *values):
        for column, value in zip(self.columns, values):
            column.append(value)
        self.size += size + 64

    def full(self) -> bool:
        return self.size >= self.limit

    def take(self) -> pa.RecordBatch:
        arrays = [pa.array(c, type=f.type) for c, f in zip(self.columns, self.schema)]
        self.reset()
        return pa.RecordBatch.from_arrays(arrays, schema=self.schema)
