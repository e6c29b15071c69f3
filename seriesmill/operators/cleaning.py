"""Projections, filters and predicates."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.functions.scalars import nan_to
from seriesmill.functions.windows import join_back


def select_factors(df: DataFrame, names: Sequence[str], keys: Sequence[str] = ("panel_id", "date")) -> DataFrame:
    return df.select(*keys, *names)


def drop_incomplete(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep rows in which every series has a number; NaN counts as missing."""
    return df.withColumns({c: nan_to(c, None) for c in cols}).na.drop("any", subset=list(cols))


def clean_values(df: DataFrame, value: str = "value") -> DataFrame:
    """Rows whose value is a number; empty texts, dashes and ``NaN`` are none."""
    return df.withColumn(value, nan_to(F.col(value).try_cast("double"), None)).filter(F.col(value).isNotNull())


def filter_metric(df: DataFrame, suffix: str, col: str) -> DataFrame:
    return df.filter(F.col(col).endswith(suffix))


def min_points(df: DataFrame, n: int, keys: Sequence[str] = ("series_id",), value: str = "value") -> DataFrame:
    """Keep the rows of series with at least ``n`` available points; the counts are joined back."""
    counts = df.groupBy(*keys).agg(F.count(value).alias("points")).filter(F.col("points") >= n)
    return join_back(df, counts, keys)


def value_at(df: DataFrame, date: str, value: str = "value", keys: Sequence[str] = ("series_id",)) -> DataFrame:
    """Value on a fixed reference date, null where the series has none."""
    at = F.max(F.when(F.col("date") == F.lit(date).cast("date"), F.col(value)))
    return df.groupBy(*keys).agg(at.alias("base_value"))


def cutoff(span: str, as_of: str) -> dt.date | None:
    """First date of a look-back such as ``1y`` or ``3y``; None for ``all``."""
    if span == "all":
        return None
    day, years = dt.date.fromisoformat(as_of), int(span.removesuffix("y"))
    try:
        return day.replace(year=day.year - years)
    except ValueError:
        return day.replace(year=day.year - years, day=28)


def filter_range(df: DataFrame, span: str, as_of: str, date: str = "date") -> DataFrame:
    """Look-back filter against a literal, so it can reach the scan."""
    start = cutoff(span, as_of)
    return df if start is None else df.filter(F.col(date) >= F.lit(start))


def exclude(df: DataFrame, name: str, col: str = "entity") -> DataFrame:
    return df.filter(F.col(col) != name)


def select_view(df: DataFrame, entity: str | None, metrics: Sequence[str], total: str) -> DataFrame:
    """All entities for one metric (the total left out), or one entity for several metrics."""
    picked = df.filter(F.col("metric").isin(list(metrics)))
    return exclude(picked, total) if entity is None else picked.filter(F.col("entity") == entity)


def get_series(df: DataFrame, entity: str, metric: str) -> DataFrame:
    return df.filter((F.col("entity") == entity) & (F.col("metric") == metric))


def nonzero(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.isNotNull() & (c != 0)


def in_session(ts: Column | str, weekdays: Sequence[int] = (1, 2, 3, 4, 5), hours: tuple[int, int] = (13, 20)) -> Column:
    """Weekday (Monday = 1) and inclusive hour range of a UTC wall clock."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return (F.weekday(ts) + 1).isin(list(weekdays)) & F.hour(ts).between(*hours)


def first_of_month(ts: Column | str) -> Column:
    return F.dayofmonth(F.col(ts) if isinstance(ts, str) else ts) == 1


def is_selected(eps: float = 1e-6) -> Column:
    """Whether a factor stays, by its standardised coefficient: the raw one depends on the factor's unit. Null: no."""
    return F.coalesce(F.abs("coef_std") > eps, F.lit(False))


def selected(coef: DataFrame, eps: float = 1e-6) -> DataFrame:
    """Factors with a weight; the intercept is no factor."""
    return coef.filter((F.col("term") != "intercept") & is_selected(eps))


def dropped(coef: DataFrame, eps: float = 1e-6) -> DataFrame:
    """Factors without one: the complement of ``selected`` over the factors."""
    return coef.filter((F.col("term") != "intercept") & ~is_selected(eps))


def zone(price: Column, lower: Column, upper: Column) -> Column:
    return F.when(price > upper, "above").when(price < lower, "below").otherwise("in")


def threshold_rule(df: DataFrame, rules: DataFrame, key: str = "asset", price: str = "price") -> DataFrame:
    """Rows outside the band of their asset; rows inside it are silent. Works on streams too.

    ``rules`` is an ordinary join side: Spark broadcasts it while its size
    statistics stay below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles beyond.
    """
    z = zone(F.col(price), F.col("lower"), F.col("upper"))
    return df.join(rules, key).withColumn("alert", z).filter("alert <> 'in'").drop("lower", "upper")


def keyword_alerts(df: DataFrame, words: Sequence[str], text: str = "text") -> DataFrame:
    """Rows whose text contains one of the phrases, ignoring case. Reads the whole text.

    The lambda binds the lower-cased text, so it is made once per row and not once per phrase.
    """

    def hits(low: Column) -> Column:
        return F.concat_ws(",", *[F.when(F.contains(low, F.lit(w.lower())), F.lit(w)) for w in words])

    matched = F.transform(F.array(F.lower(F.col(text))), hits)[0]
    return df.withColumn("matched", matched).filter(F.col("matched") != "")
