"""Joins of series and dimensions. No hints: Spark picks the strategy from sizes it has measured."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesmill.operators.cleaning import nonzero


def align(a: DataFrame, b: DataFrame, on: Sequence[str] = ("date",), value: str = "value") -> DataFrame:
    """Two series side by side on common dates; a zero or missing right value drops the point."""
    left = a.select(*on, F.col(value).alias("x"))
    right = b.select(*on, F.col(value).alias("y")).filter(nonzero("y"))
    return left.join(right, list(on), "inner")


def align_metrics(df: DataFrame, a: Column, b: Column, on: Sequence[str], value: str = "value") -> DataFrame:
    """Like ``align`` when both series sit in one table: one pass and one exchange instead of a self join."""
    g = df.filter(a | b).groupBy(*on).agg(F.max(F.when(a, F.col(value))).alias("x"), F.max(F.when(b, F.col(value))).alias("y"))
    return g.filter(F.col("x").isNotNull() & nonzero("y"))


def spread(aligned: DataFrame) -> DataFrame:
    return aligned.withColumn("spread", F.col("x") - F.col("y"))


def label_codes(df: DataFrame, dim: DataFrame, code: str = "code", out: str = "label") -> DataFrame:
    """Code to label, ``Unknown (code)`` where the dimension has none."""
    d = dim.select(F.col("code").alias(code), F.col("label").alias(out))
    unknown = F.concat(F.lit("Unknown ("), F.col(code).cast("string"), F.lit(")"))
    return df.join(d, code, "left").withColumn(out, F.coalesce(F.col(out), unknown))


def ordered_lookup(df: DataFrame, order_df: DataFrame, on: str = "entity") -> DataFrame:
    """Rows of a fixed display list with their position; list entries without a row are skipped."""
    return order_df.join(df, on, "inner")


def latest_pair(df: DataFrame, a: Column, b: Column, keys: Sequence[str], value: str = "value", date: str = "date") -> DataFrame:
    """Latest value of each of two series with spread and ratio, in one mergeable aggregate."""
    v, d = F.col(value), F.col(date)
    ok = v.isNotNull()
    g = df.filter(a | b).groupBy(*keys).agg(
        F.max_by(F.when(a, v), F.when(a & ok, d)).alias("a"),
        F.max(F.when(a & ok, d)).alias("a_date"),
        F.max_by(F.when(b, v), F.when(b & ok, d)).alias("b"),
        F.max(F.when(b & ok, d)).alias("b_date"),
    )
    return g.withColumns({"spread": F.col("a") - F.col("b"), "ratio": F.try_divide(F.col("a"), F.col("b"))})


def convert_stacked(rows: DataFrame, divisor: float, key: str, value: str = "value", date: str = "date", rate: str = "rate") -> DataFrame:
    """value x rate / divisor with the rate in force on the date, for values and rates that come as rows of one table, each
    with the other column null: no join at all.

    For values at calendar grain, as every row of a key enters one window; ``as_of.as_of_join`` is for any other.
    """
    w = Window.partitionBy(key).orderBy(F.col(date), F.col(rate).isNull()).rowsBetween(Window.unboundedPreceding, 0)
    known = rows.withColumn(rate, F.last(rate, ignorenulls=True).over(w)).filter(F.col(value).isNotNull())
    return known.withColumn("converted", F.col(value) * F.col(rate) / divisor)


def unpivot(df: DataFrame, ids: Sequence[str], cols: Sequence[str], name: str = "series", value: str = "value") -> DataFrame:
    return df.unpivot(list(ids), list(cols), name, value)


def target_vs_factors(panel: DataFrame, y: str, xs: Sequence[str], keys: Sequence[str] = ("panel_id", "date")) -> DataFrame:
    return unpivot(panel, [*keys, y], xs, "factor", "x")


def compare_betas(a: DataFrame, b: DataFrame, on: Sequence[str] = ("panel_id", "term")) -> DataFrame:
    """Two coefficient tables per term with the difference a - b."""
    j = a.select(*on, F.col("coef").alias("coef_a")).join(b.select(*on, F.col("coef").alias("coef_b")), list(on))
    return j.withColumn("delta", F.col("coef_a") - F.col("coef_b"))


def union_latest(dfs: Sequence[DataFrame], keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Union of several loads in which a later load wins per key."""
    tagged = [d.select(*keys, *values).withColumn("load", F.lit(i)) for i, d in enumerate(dfs)]
    u = tagged[0]
    for d in tagged[1:]:
        u = u.unionByName(d)
    return latest_load(u, keys, values)


def latest_load(df: DataFrame, keys: Sequence[str], values: Sequence[str], load: str = "load") -> DataFrame:
    """Of rows that carry the number of their load, the latest per key, by a mergeable aggregate."""
    return df.groupBy(*keys).agg(*[F.max_by(v, load).alias(v) for v in values], F.max(load).cast("bigint").alias("load"))
