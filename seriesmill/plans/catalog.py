"""All registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seriesmill.functions import windows as W
from seriesmill.operators.cleaning import drop_incomplete
from seriesmill.operators.signals import rich_cheap
from seriesmill.plans import landed, panels, quotes, series  # noqa: F401  (they register their queries)
from seriesmill.plans.registry import ORACLES, QUERIES, tidy
from seriesmill.sources import tables as S

__all__ = ["ORACLES", "QUERIES", "flagship"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices to log returns, static regression, rich/cheap signal, at month grain."""
    cols = ["y", *S.FACTORS]
    prices = S.price_panel(spark, sf_dir, "month")
    rets = drop_incomplete(W.log_return(prices, cols, ("panel_id",)), cols)
    return tidy(rich_cheap(rets, "y", S.FACTORS, 12, 24))
