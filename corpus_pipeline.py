"""A training-data pipeline over ``documents``, stage by stage; belongs to the package ``seriesmill.llm``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import seriesmill
from seriesmill.llm import language_id, line_templates, ngram_join, packing, queries, substring_dedup
from seriesmill.llm.common import stored
from seriesmill.sources.tables import table

cloudpickle.register_pickle_by_value(seriesmill)

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _measured(docs: DataFrame) -> DataFrame:
    """Texts that lost all they had go; lengths follow the texts."""
    left = docs.where(F.col("text").isNull() | (F.btrim("text", F.lit(" \t\r\n")) != ""))
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; a missing ``lang`` is filled in. No letter, or ambiguous: out."""
    model = language_id.train(docs.where(~language_id.held_out()))
    marked = language_id.with_language(docs, model, out_col="__p")
    kept = marked.where((F.col("__p.lang_pred") != language_id.UNKNOWN) & ~F.col("__p.ambiguous"))
    return kept.withColumn("lang", F.coalesce("lang", "__p.lang_pred")).select(*docs.columns)


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates are gone from all documents but the first."""
    return _measured(line_templates.without_lines(docs, line_templates.dropped_lines(docs, min_around=line_templates.MIN_AROUND)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return ngram_join.one_of_each(docs)


def drop_repeated_runs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds are cut out."""
    return _measured(substring_dedup.without_runs(docs, substring_dedup.repeated_runs(docs)))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all texts left, with their window and place."""
    return packing.pack_documents(docs, public_tokenizers.path(queries.BYTE_VOCABULARY), queries.WINDOW)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("line_dedup", drop_recurring_lines),
    ("ngram_join", drop_near_duplicates),
    ("substring_dedup", drop_repeated_runs),
    ("packing", pack_windows),
]

#: Language models, templates, components and packing have no SQL form; tests/llm holds the brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; each result is stored and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
