"""Registry of named queries over the star-schema tables and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is the same result in SQL over the same tables."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


def tidy(df: DataFrame, digits: int = 6, exact: Sequence[str] = ()) -> DataFrame:
    """Round computed doubles and widen counters, so results compare across engines.

    Columns named in ``exact`` come from integer sums and are left as they are.
    """
    out = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType) and f.name not in exact:
            out[f.name] = F.round(f.name, digits) + F.lit(0.0)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            out[f.name] = F.col(f.name).cast("bigint")
    return df.withColumns(out) if out else df
