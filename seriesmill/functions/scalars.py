"""Scalar functions. All are Catalyst expressions; none leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def period_month(c: Column | str) -> Column:
    """``M01`` to 1; anything unparseable to null."""
    return F.replace(_c(c), F.lit("M"), F.lit("")).try_cast("int")


def month_start(year: Column | str, month: Column | str) -> Column:
    """First of the month; null for a month outside 1-12 (annual averages come as month 13)."""
    y, m = _c(year), _c(month)
    return F.when(m.between(1, 12), F.make_date(y, m, F.lit(1)))


def id_part(c: Column | str, pos: int, length: int) -> Column:
    return F.substring(_c(c), pos, length)


def series_key(a: Column | str, b: Column | str) -> Column:
    return F.concat_ws("|", _c(a), _c(b))


def map_default(m: Column, key: Column, default: Column) -> Column:
    return F.coalesce(F.try_element_at(m, key), default)


def fmt_date(c: Column | str, pattern: str = "yyyy-MM-dd") -> Column:
    return F.date_format(_c(c), pattern)


def as_of_text(ts: Column) -> Column:
    """Report time stamp; pass ``F.current_timestamp()`` for now, in the session zone (UTC)."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm"), F.lit(" UTC"))


def time_until(ts: Column | str, as_of: Column) -> Column:
    """Whole days, hours and minutes left, and ``done`` once nothing is left."""
    left = F.unix_timestamp(_c(ts).cast("timestamp")) - F.unix_timestamp(as_of.cast("timestamp"))
    running = left > 0

    def part(unit: int, cycle: int | None) -> Column:
        whole = F.floor(left / unit)
        return F.when(running, F.pmod(whole, F.lit(cycle)) if cycle else whole).otherwise(F.lit(0)).cast("bigint")

    return F.struct(
        part(86400, None).alias("days"),
        part(3600, 24).alias("hours"),
        part(60, 60).alias("minutes"),
        (~running).alias("done"),
    )


def to_zone(ts: Column | str, target: str, source: str = "UTC") -> Column:
    """Wall clock of ``target`` for a zone-less wall clock of ``source``."""
    return F.convert_timezone(F.lit(source), F.lit(target), _c(ts))


def log_grid(lo_exp: float, hi_exp: float, n: int) -> Column:
    """``n`` points from 10**lo_exp to 10**hi_exp, evenly spaced in the exponent."""
    step = (hi_exp - lo_exp) / (n - 1)
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.pow(F.lit(10.0), F.lit(lo_exp) + i * F.lit(step)))


def round_to(c: Column | str, k: int, half_even: bool = False) -> Column:
    return (F.bround if half_even else F.round)(_c(c), k)


def fmt_signed(c: Column | str, decimals: int = 2, suffix: str = "%") -> Column:
    pct = suffix.replace("%", "%%")
    return F.format_string(f"%+.{decimals}f{pct}", _c(c).cast("double"))


def fmt_grouped(c: Column | str, decimals: int = 2) -> Column:
    return F.format_string(f"%,.{decimals}f", _c(c).cast("double"))


def fmt_adaptive(c: Column | str) -> Column:
    """Four decimals below 0.01 in size, two otherwise."""
    v = _c(c).cast("double")
    return F.when(F.abs(v) < 0.01, F.format_string("%.4f", v)).otherwise(F.format_string("%.2f", v))


def direction(c: Column | str) -> Column:
    v = _c(c)
    return F.when(v > 0, "up").when(v < 0, "down").when(v == 0, "flat")


def positive_class(c: Column | str) -> Column:
    """Two-way class in which no change counts as positive."""
    return F.when(_c(c) >= 0, "positive").otherwise("negative")


def fmt_quote(price: Column | str, fmt: Column | str) -> Column:
    """Yield with a percent sign; prices from 1000 on with digit grouping."""
    p = _c(price).cast("double")
    return (
        F.when(_c(fmt) == "pct", F.format_string("%.2f%%", p))
        .when(p >= 1000, F.format_string("%,.2f", p))
        .otherwise(F.format_string("%.2f", p))
    )


def pad_right(c: Column | str, width: int) -> Column:
    """Pad only: longer text is kept whole."""
    return F.rpad(_c(c), F.greatest(F.length(_c(c)), F.lit(width)), F.lit(" "))


def pad_left(c: Column | str, width: int) -> Column:
    return F.lpad(_c(c), F.greatest(F.length(_c(c)), F.lit(width)), F.lit(" "))


def truncate(c: Column | str, n: int = 40) -> Column:
    return F.left(_c(c), F.lit(n))


def nan_to(c: Column | str, default: float | None = 0.0) -> Column:
    d = F.lit(default).cast("double")
    return F.coalesce(F.nanvl(_c(c), F.lit(None).cast("double")), d)


def clamp(c: Column | str, lo: float, hi: float) -> Column:
    return F.least(F.greatest(_c(c), F.lit(lo)), F.lit(hi))


def verdict(z: Column | str) -> Column:
    """Rich/cheap class of a z-score. Bounds are strict; missing counts as 0."""
    v = nan_to(z)
    return (
        F.when(v > 2, "EXPENSIVE")
        .when(v > 1, "SLIGHTLY EXPENSIVE")
        .when(v < -2, "CHEAP")
        .when(v < -1, "SLIGHTLY CHEAP")
        .otherwise("FAIR VALUE")
    )


def join_names(names: Column) -> Column:
    """Array of names to one text, ``None`` when there are none."""
    return F.coalesce(F.nullif(F.array_join(names, ", "), F.lit("")), F.lit("None"))
