"""Operator 6: line dedup with a log-template tree.

Lines are parsed by a tree of fixed depth: number of tokens, then the leading tokens, where a token with a
digit is a variable field. In a leaf, lines whose tokens agree in enough places share a template; places
where they differ become variable fields. A template that recurs in many documents is dropped from
all of them but the first, so that a group of copies leaves one. Different surroundings can be asked for besides
(``min_around``); inner lines of a notice have the same neighbours everywhere, so the queries do without.

Leaves with fewer lines than a template needs are set aside by counting hashes, before any text moves.
The others are parsed as sorted streams of their distinct lines; a task holds the templates of one leaf.

Defined cases: a null or empty text has no line; blank lines are never dropped; a line's template does not
depend on partitioning (distinct lines are taken in order); equal texts count as one document; rows with
equal id and text are treated alike; rows with a null id are kept as the first of their template only if
there is no other; an empty table gives no row; other columns are not carried by ``dropped_lines``.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.common import BatchWriter, rows_in, stored, texts, tidy_task

#: Documents in which a template must recur.
MIN_DOCS = 10
#: Surroundings in which it must recur in the queries: lines inside a notice have one only.
MIN_AROUND = 1
LEADING = 3
#: Share of places in which a line must agree with a template.
SIMILAR = 0.7
FIELD = "<*>"


DIGIT = re.compile("[0-9]")
LINES = "doc_id bigint, text_key bigint, line_no int, leaf bigint, around bigint, masked string"


def masked_tokens(line: str) -> list[str]:
    """Tokens of a line between blanks; one with a digit is a variable field."""
    tokens = line.split()
    return [FIELD if DIGIT.search(t) else t for t in tokens] if DIGIT.search(line) else tokens


def _hash(text: str) -> int:
    value = xxhash.xxh64_intdigest(text)
    return value - (1 << 64) if value >> 63 else value


def leaf_of(tokens: list[str], leading: int) -> int:
    """The leaf of the tree: number of tokens, then the leading ones."""
    return _hash(f"{len(tokens)} {' '.join(tokens[:leading])}")


def leaf_sizes(docs: DataFrame, leading: int = LEADING) -> DataFrame:
    """(leaf, n): lines per leaf and batch, so that little leaves the tasks."""
    schema = pa.schema([("leaf", pa.int64()), ("n", pa.int64())])

    def run(batches):
        for batch in batches:
            seen = Counter()
            for _, text in rows_in([batch]):
                for line in (text or "").split("\n"):
                    if tokens := masked_tokens(line):
                        seen[leaf_of(tokens, leading)] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(tidy_task(run), "leaf bigint, n bigint")


def lines_of(docs: DataFrame, leading: int = LEADING) -> DataFrame:
    """(doc_id, text_key, line_no, leaf, around, masked): every line that holds a token, with its leaf and a hash of the lines
    before and after it."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("line_no", pa.int32()), ("leaf", pa.int64()), ("around", pa.int64()), ("masked", pa.string())])

    def run(batches):
        out = BatchWriter(schema)
        for batch in batches:
            keys = batch.column(2)
            for i, (doc_id, text) in enumerate(rows_in([batch])):
                if not text:
                    continue
                lines, key = text.split("\n"), keys[i].as_py()
                for k, line in enumerate(lines):
                    if tokens := masked_tokens(line):
                        before, after = "\n" + lines[k - 1] if k else "", "\n" + lines[k + 1] if k + 1 < len(lines) else ""
                        out.add(len(line), doc_id, key, k, leaf_of(tokens, leading), _hash(f"{before}\n\n{after}"), " ".join(tokens))
                if out.full():
                    yield out.take()
        if out.size:
            yield out.take()

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")).mapInArrow(tidy_task(run), LINES)


def agreement(template: list[str], tokens: list[str]) -> float:
    """Share of places with the same token; a field agrees with a field only."""
    return sum(map(str.__eq__, template, tokens)) / len(tokens)


class Leaf:
    """Templates of one leaf, found line by line."""

    def __init__(self, similar: float = SIMILAR):
        self.similar, self.templates = similar, []

    def place(self, tokens: list[str]) -> int:
        """Number of the best template, which takes the line in; a new one if none is similar enough."""
        best, which = self.similar, -1
        for k, template in enumerate(self.templates):
            value = agreement(template, tokens)
            if value > best or value == best and which < 0:
                best, which = value, k
        if which < 0:
            self.templates.append(list(tokens))
            return len(self.templates) - 1
        self.templates[which] = [a if a == b else FIELD for a, b in zip(self.templates[which], tokens)]
        return which


def templates(distinct: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """(leaf, masked, template_no) from distinct (leaf, masked): sorted streams, one leaf after the other."""
    schema = pa.schema([("leaf", pa.int64()), ("masked", pa.string()), ("template_no", pa.int32())])

    def run(batches):
        out = BatchWriter(schema)
        current, leaf = None, None
        for batch in batches:
            for key, masked in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if leaf is None or key != current:
                    current, leaf = key, Leaf(similar)
                out.add(len(masked), key, masked, leaf.place(masked.split(" ")))
            if out.full():
                yield out.take()
        if out.size:
            yield out.take()

    ordered = distinct.select("leaf", "masked").repartition("leaf").sortWithinPartitions("leaf", "masked")
    return ordered.mapInArrow(tidy_task(run), "leaf bigint, masked string, template_no int")


def dropped_lines(docs: DataFrame, min_docs: int = MIN_DOCS, leading: int = LEADING, similar: float = SIMILAR, id_col: str = "doc_id", text_col: str = "text", min_around: int | None = None) -> DataFrame:
    """(doc_id, text_key, line_no, leaf, template_no, n_docs): the lines to drop. ``min_around``: different pairs of neighbour
    lines asked for besides documents; as many as those unless given."""
    own = texts(docs, id_col, text_col)
    # Stored, so that the planner knows its size and sends it to the lines only while that is small.
    heavy = stored(leaf_sizes(own, leading).groupBy("leaf").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs).select("leaf"), "leaves")
    some = stored(lines_of(own, leading).join(heavy, "leaf", "left_semi"), "lines")
    found = templates(some.groupBy("leaf", "masked").agg(F.count(F.lit(1)).alias("n")), similar)
    placed = stored(some.join(found, ["leaf", "masked"]).select("doc_id", "text_key", "line_no", "leaf", "template_no", "around"), "placed")
    keys = ["leaf", "template_no"]
    many = placed.groupBy(*keys, "text_key").agg(F.min("doc_id").alias("least")).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_docs"), F.min("least").alias("kept_doc"))
    many = many.where(F.col("n_docs") >= min_docs)
    if (min_around := min_docs if min_around is None else min_around) > 1:
        wide = placed.groupBy(*keys, "around").agg(F.lit(1).alias("x")).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_around"))
        many = many.join(wide.where(F.col("n_around") >= min_around), keys)
    recurring = stored(many, "recurring")
    out = placed.join(recurring, keys).where(~F.col("doc_id").eqNullSafe(F.col("kept_doc")))
    return out.select("doc_id", "text_key", "line_no", "leaf", "template_no", "n_docs")


def without_lines(docs: DataFrame, dropped: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the dropped lines taken out of their texts, all columns kept; untouched texts stay as they are."""
    per_doc = dropped.distinct().groupBy("doc_id", "text_key").agg(F.collect_set("line_no").alias("__gone")).select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "__gone")
    text: Column = docs[text_col]
    joined = docs.join(per_doc, docs[id_col].cast("bigint").eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__key")), "left")
    kept = F.array_join(F.filter(F.split(text, "\n", -1), lambda x, i: ~F.array_contains("__gone", i)), "\n")
    changed = F.when(F.col("__gone").isNull(), text).otherwise(kept)
    return joined.select(*[changed.alias(c) if c == text_col else docs[c] for c in docs.columns])
