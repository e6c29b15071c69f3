"""Many phrases in one pass per text: an Aho-Corasick automaton, whatever the number of phrases.

Each task builds the automaton once from the list and walks every text a single time; overlapping phrases and all their
places are found. Case is ignored as Spark's ``lower`` does it; places count characters of the lower-cased text. The list
travels with the tasks, so its size is checked. Works on streams too. Few phrases are as well served by
``cleaning.keyword_alerts``, which gives the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters of all phrases together that travel with the tasks.
MOST_CHARACTERS = 20_000_000


def automaton(phrases: Sequence[str]) -> ahocorasick.Automaton:
    """Finds (index of the last character, numbers of the phrases); phrases that differ in case only share an entry."""
    numbers: dict[str, list[int]] = {}
    for n, phrase in enumerate(phrases):
        if phrase:
            numbers.setdefault(phrase.lower(), []).append(n)
    out = ahocorasick.Automaton()
    for phrase, ns in numbers.items():
        out.add_word(phrase, (len(phrase), ns))
    out.make_automaton()
    return out


def _checked(phrases: Sequence[str]) -> list[str]:
    phrases = list(phrases)
    if sum(map(len, phrases)) > MOST_CHARACTERS:
        raise ValueError(f"more than {MOST_CHARACTERS} characters of phrases: give them in parts")
    return phrases


def _hits(machine: ahocorasick.Automaton, text: str | None) -> Iterator[tuple[int, int, int]]:
    """(phrase number, begin, length) of every place in a text."""
    if text and len(machine):
        for last, (length, numbers) in machine.iter(text):
            for n in numbers:
                yield n, last + 1 - length, length


def phrase_alerts(df: DataFrame, phrases: Sequence[str], text: str = "text") -> DataFrame:
    """Rows whose text contains one of the phrases, with all of them in ``matched``, in the order of the list."""
    phrases, columns = _checked(phrases), list(df.columns)
    schema = T.StructType([*df.schema.fields, T.StructField("matched", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(phrases)
        for batch in batches:
            low = batch.column("_low")
            found = [sorted({n for n, _, _ in _hits(machine, low[i].as_py())}) for i in range(batch.num_rows)]
            keep = pa.array([bool(f) for f in found], pa.bool_())
            matched = pa.array([",".join(phrases[n] for n in f) for f in found if f], pa.string())
            kept = batch.select(columns).filter(keep)
            yield pa.RecordBatch.from_arrays([*kept.columns, matched], names=[*columns, "matched"])

    return df.withColumn("_low", F.lower(F.col(text))).mapInArrow(run, schema)


def phrase_places(df: DataFrame, phrases: Sequence[str], keys: Sequence[str], text: str = "text") -> DataFrame:
    """(keys, phrase, begin, length): every place of every phrase, overlapping ones too."""
    phrases, keys = _checked(phrases), list(keys)
    types = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(phrases)
        for batch in batches:
            low, rows, names, begins, lengths = batch.column("_low"), [], [], [], []
            for i in range(batch.num_rows):
                for n, begin, length in _hits(machine, low[i].as_py()):
                    rows.append(i), names.append(phrases[n]), begins.append(begin), lengths.append(length)
            taken = batch.select(keys).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(names, pa.string()), pa.array(begins, pa.int64()), pa.array(lengths, pa.int64())], names=[*keys, "phrase", "begin", "length"])

    return df.select(*keys, F.lower(F.col(text)).alias("_low")).mapInArrow(run, f"{types}, phrase string, begin bigint, length bigint")
