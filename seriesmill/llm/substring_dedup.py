"""Operator 8: substring dedup by hashing units of text.

A text is cut into units where its own content says so: at line ends, at ends of sentences and clauses of any script, and
after every word of ``LONG_WORD`` characters or more or with a 3 or 7 at its end, at the latest after 12 words (24 characters of a script without blanks). So a
passage falls into the same units wherever it stands, in the middle of a sentence too, but for a few words at its ends.
A unit is lower-cased and its blanks are collapsed. A place is a unit together with the next one; of all places with one digest the
earliest by (doc_id, place) stays. Consecutive repeats of a document form a run; runs of at least ``min_words`` words are taken out, and
reported with their place in the original text. Shorter runs are chance or common phrases and stay. Two characters of a script without
blanks count as a word. Every unit stays in the first document that has it.

Digests are counted with map-side sums, so only repeated ones meet their places; none of the steps depends on how often a place
occurs, and nothing is held per digest but its first place. A digest has 64 bits: a run of ``MIN_WORDS`` words has two places at least,
so a wrong one needs several collisions in a row.

Defined cases: a null or empty text has no unit; units without a word do not count; a run has two units or more; a place that repeats
within its own document is a repeat too; rows with equal id are separate texts, in the order of the stored
units; null ids come last; very long texts are cut whole; an empty table gives no row; other columns are not
carried by ``repeated_runs``.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seriesmill.llm.common import rows_in, stored, texts, tidy_task

MIN_WORDS = 25
#: A word of so many characters ends its unit: about one word in five.
LONG_WORD = 9
#: Blanks but the line end, ends of sentences and clauses, and scripts that part no words: insides of character classes, as Python and SQL read them.
BLANK = r"\x09\x0B-\x0D\x1C-\x20" + "\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
ENDS = r".!?;|\n" + "。！？｡؟।॥…、，"
WIDE = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003134f"
NARROW = f"[^{BLANK}{ENDS}{WIDE}]"
#: Last character of a word that does not end its unit: numbers are cut too, though they are short.
INNER = f"[^{BLANK}{ENDS}{WIDE}37]"
#: Up to eleven short words, then one word of any length or 24 wide characters, then all blanks and ends.
UNIT_PATTERN = f"[{BLANK}]*(?:{NARROW}{{0,{LONG_WORD - 2}}}{INNER}[{BLANK}]+){{0,11}}(?:[{WIDE}]{{1,24}}|{NARROW}*)[{BLANK}{ENDS}]*"
EDGE_PATTERN = f"^[{BLANK}{ENDS}]+|[{BLANK}{ENDS}]+$"
UNIT, EDGE, WIDE_ONES = re.compile(UNIT_PATTERN), re.compile(EDGE_PATTERN), re.compile(f"[{WIDE}]")
PLACES = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("text_key", pa.int64())] + [(c, pa.int32()) for c in ("place", "start", "length", "words", "next_words")] + [("h", pa.int64())])
#: Places of an output batch, about.
BATCH = 65_536


def places_of(text: str) -> list[tuple[int, int, int, int, int]]:
    """(start, length, words, words of the next unit, digest) of every unit with a word and its next one; the length is that of both."""
    found = []
    for m in UNIT.finditer(text):
        if norm := " ".join(EDGE.sub("", m[0]).lower().split()):
            words = norm.count(" ") + 1
            found.append((m.start(), m.end(), words if norm.isascii() else words + len(WIDE_ONES.findall(norm)) // 2, norm))
    return [(a, end - a, w, v, xxhash.xxh3_64_intdigest(f"{x}\n{y}")) for (a, _, w, x), (_, end, v, y) in zip(found, found[1:])]


def units(docs: DataFrame) -> DataFrame:
    """Rows of ``PLACES``: every unit with a word and its next one, by their digest. Places count units with a word only, so blank
    ones do not part a run."""

    def batch_of(columns):
        *small, digests = columns
        arrays = [pa.array(c, type=f.type) for c, f in zip(small, PLACES)]
        return pa.RecordBatch.from_arrays([*arrays, pa.array(np.array(digests, np.uint64).view(np.int64))], schema=PLACES)

    def run(batches):
        columns = [[] for _ in PLACES]
        for batch in batches:
            rows, keys = batch.column(2), batch.column(3)
            for i, (doc_id, text) in enumerate(rows_in([batch])):
                if not text or not (places := places_of(text)):
                    continue
                n = len(places)
                for column, values in zip(columns, ([rows[i].as_py()] * n, [doc_id] * n, [keys[i].as_py()] * n, range(n), *zip(*places))):
                    column.extend(values)
                if len(columns[0]) >= BATCH:
                    yield batch_of(columns)
                    columns = [[] for _ in PLACES]
        if columns[0]:
            yield batch_of(columns)

    numbered = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"), F.xxhash64("text").alias("text_key"))
    return numbered.mapInArrow(tidy_task(run), ", ".join(f"{f.name} {'bigint' if f.type == pa.int64() else 'int'}" for f in PLACES))


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, nth, start, length, n_units, n_words, kept_doc_id): the runs to take out, in code points of the text.

    ``nth`` numbers the rows with equal id and text; ``kept_doc_id`` is the document that keeps the first place of the run.
    """
    all_units = stored(units(texts(docs, id_col, text_col)), "units")
    # Sums are stored before they are joined: then both sides of a join come straight from an exchange, and adaptive
    # execution can split a digest that has very many places.
    often = stored(all_units.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "often")
    some = stored(all_units.drop("text_key").join(often, "h", "left_semi"), "repeated")
    # Null ids last: a flag before the id.
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "place")
    firsts = stored(some.groupBy("h").agg(F.min(rank).alias("first")), "firsts")
    repeats = some.join(firsts, "h").where((F.col("row") != F.col("first.row")) | (F.col("place") != F.col("first.place")))
    in_row = Window.partitionBy("row").orderBy("place")
    islands = repeats.withColumn("island", F.col("place") - F.row_number().over(in_row))
    runs = islands.groupBy("row", "island").agg(
        F.min("start").alias("start"),
        F.max(F.col("start") + F.col("length")).alias("end"),
        (F.count(F.lit(1)) + 1).alias("n_units"),
        (F.sum("words") + F.max(F.struct("place", "next_words")).getField("next_words")).alias("n_words"),
        F.min(F.struct("place", "first.doc_id")).getField("doc_id").alias("kept_doc_id"),
    )
    runs = stored(runs.where(F.col("n_words") >= min_words).drop("island"), "runs")
    # Rows with equal id and text are numbered, so that each of them can be told apart by its content.
    heads = all_units.where("place = 0").select("row", "doc_id", "text_key")
    same = ["text_key", F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("no_id")]
    with_run = heads.join(runs.select("row").distinct(), "row", "left_semi").select(*same).distinct()
    copies = heads.select("row", "doc_id", *same).join(with_run, ["text_key", "id", "no_id"], "left_semi")
    nth = copies.withColumn("nth", F.row_number().over(Window.partitionBy("text_key", "id", "no_id").orderBy("row"))).select("row", "doc_id", "text_key", "nth")
    return runs.join(nth, "row").select("doc_id", "text_key", "nth", F.col("start").cast("bigint"), (F.col("end") - F.col("start")).cast("bigint").alias("length"), "n_units", "n_words", "kept_doc_id")


def without_runs(docs: DataFrame, runs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the runs cut out of their texts, all columns kept; untouched texts stay as they are. Columns whose names begin
    with ``__run_`` are the operator's own."""
    keys = ["__run_id", "__run_no_id", "__run_key"]

    def keyed(id_value, key):
        return [F.coalesce(id_value, F.lit(0)).alias(keys[0]), id_value.isNull().alias(keys[1]), key.alias(keys[2])]

    cuts = F.array_sort(F.collect_list(F.struct("start", "length"))).alias("cuts")
    per_row = runs.groupBy("doc_id", "text_key", "nth").agg(cuts)
    per_text = per_row.groupBy(*keyed(F.col("doc_id"), F.col("text_key"))).agg(F.map_from_entries(F.collect_list(F.struct("nth", "cuts"))).alias("__run_cuts"))
    # Empty texts have no run; they stay out of the join, where they would all have one key.
    blank = docs[text_col].isNull() | (docs[text_col] == "")
    own = docs.where(~blank).select("*", *keyed(docs[id_col].cast("bigint"), F.xxhash64(docs[text_col])))
    # Join and numbers need the same keys, so one exchange of the texts serves both.
    joined = own.join(per_text, keys, "left").withColumn("__run_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(1))))
    mine = joined.withColumn("__run_cuts", F.col("__run_cuts")[F.col("__run_nth")])
    text = F.col(text_col)
    # Between the runs: from the end of one to the start of the next.
    starts = F.concat(F.array(F.lit(0)), F.transform("__run_cuts", lambda r: (r.start + r.length).cast("int")))
    stops = F.concat(F.transform("__run_cuts", lambda r: r.start.cast("int")), F.array(F.length(text)))
    kept = F.array_join(F.zip_with(starts, stops, lambda a, b: F.substr(text, a + 1, b - a)), "")
    changed = F.when(F.col("__run_cuts").isNull(), text).otherwise(kept)
    return mine.select(*[changed.alias(c) if c == text_col else F.col(c) for c in docs.columns]).unionByName(docs.where(blank))
