"""Static dimensions. Codes, labels and display order of the source systems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Industry codes of the labor survey, in the order they are listed there.
INDUSTRY_CODES = [
    ("100", "Mining & Logging"),
    ("200", "Construction"),
    ("300", "Manufacturing"),
    ("400", "Trade, Transport & Utilities"),
    ("510", "Information"),
    ("520", "Finance & Insurance"),
    ("530", "Real Estate"),
    ("540", "Prof & Business Services"),
    ("600", "Education & Health Services"),
    ("700", "Leisure & Hospitality"),
    ("810", "Other Services"),
    ("900", "Government"),
    ("000", "Total Nonfarm"),
]

# Metric codes of the labor survey.
METRIC_CODES = [
    ("JOL", "Job Openings"),
    ("QUL", "Quits"),
    ("HIL", "Hires"),
    ("LDL", "Layoffs & Discharges"),
    ("TSL", "Total Separations"),
]

# Display order of the industries, the total first.
INDUSTRY_ORDER = [
    "Total Nonfarm",
    "Education & Health Services",
    "Leisure & Hospitality",
    "Trade, Transport & Utilities",
    "Prof & Business Services",
    "Government",
    "Manufacturing",
    "Finance & Insurance",
    "Construction",
    "Information",
    "Real Estate",
    "Mining & Logging",
    "Other Services",
]

# Quote tickers in display order (ticker, name, category, format).
TICKERS = [
    ("^GSPC", "S&P 500", "EQUITIES", "price"),
    ("^IXIC", "Nasdaq", "EQUITIES", "price"),
    ("DX-Y.NYB", "DXY", "FX", "price"),
    ("BRL=X", "USD/BRL", "FX", "price"),
    ("^TNX", "US 10Y Yield", "RATES", "pct"),
    ("^VIX", "VIX", "VOLATILITY", "price"),
    ("GC=F", "Gold (XAU)", "COMMODITIES", "price"),
    ("CL=F", "Oil WTI", "COMMODITIES", "price"),
]


def industries(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(INDUSTRY_CODES, "code string, label string")


def metrics(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(METRIC_CODES, "code string, label string")


def display_order(spark: SparkSession, names: list[str] = INDUSTRY_ORDER) -> DataFrame:
    """The list as rows with an explicit position, so order survives any shuffle."""
    return spark.createDataFrame(list(enumerate(names, 1)), "ord int, entity string")


def tickers(spark: SparkSession) -> DataFrame:
    rows = [(i, *t) for i, t in enumerate(TICKERS, 1)]
    return spark.createDataFrame(rows, "ord int, ticker string, name string, category string, fmt string")
