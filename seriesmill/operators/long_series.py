"""Ordered computations on sequences without a bound, such as the ticks of one asset.

A plain window over ``asset`` would send every tick of that asset to one task.
Here the rows are sorted once by (keys, order); Spark's range exchange splits that
order evenly, also inside a single key or a single time bucket. Rows are numbered
along the order and cut into chunks of equal length, so every task gets the same
share whatever the keys look like:

* frames of ``n`` rows: each chunk also gets copies of the ``n - 1`` rows before it;
* running sums and maxima: running values inside a chunk plus the total of the
  key's earlier chunks, of which there is one row per (key, chunk).

The numbering must be the same for every branch that reads it, so the sorted rows
are checkpointed once, in the cluster's shared folder. Lost executors re-read it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesmill.operators.cleaning import zone
from seriesmill.session import shared_folder

ROWS_PER_CHUNK = 1_000_000


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add ``_pos``, the position of each row in the order of (keys, order)."""
    shared_folder(df.sparkSession)
    ids = df.orderBy(*keys, *order).withColumn("_id", F.monotonically_increasing_id()).checkpoint()
    # The id holds the partition number in its upper 31 bits and the row number below.
    part = F.shiftright("_id", 33)
    sizes = ids.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_part", before.alias("_before"))
    # One row per partition of the sort: bounded by the partition count, so safe to broadcast.
    pos = F.col("_before") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return ids.withColumn("_part", part).join(F.broadcast(offsets), "_part").withColumn("_pos", pos).drop("_id", "_part", "_before")


def chunked(df: DataFrame, keys, order, halo: int = 0, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Cut the order into chunks: ``_chunk``, ``_pos`` and ``_own`` (false for a copied row)."""
    size = max(rows_per_chunk, halo, 1)
    home = F.floor(F.col("_pos") / size)
    rows = numbered(df, keys, order).withColumn("_home", home)
    if halo:
        late = F.col("_pos") % size >= size - halo
        targets = F.when(late, F.array(F.col("_home"), F.col("_home") + 1)).otherwise(F.array(F.col("_home")))
        rows = rows.withColumn("_chunk", F.explode(targets))
    else:
        rows = rows.withColumn("_chunk", F.col("_home"))
    return rows.withColumn("_own", F.col("_chunk") == F.col("_home")).drop("_home")


def _by_chunk(keys: Sequence[str]):
    return Window.partitionBy("_chunk", *keys).orderBy("_pos")


_INTERNAL = ("_chunk", "_pos", "_own")


def with_previous(df: DataFrame, col: str, keys, order, out: str = "prev", rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """The value of ``col`` on the row before, per key."""
    c = chunked(df, keys, order, halo=1, rows_per_chunk=rows_per_chunk)
    return c.withColumn(out, F.lag(col).over(_by_chunk(keys))).filter("_own").drop(*_INTERNAL)


def long_pct_change(df: DataFrame, value: str, keys, order, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    d = with_previous(df, value, keys, order, "_prev", rows_per_chunk)
    return d.withColumn("pct", F.try_divide((F.col(value) - F.col("_prev")) * 100, F.col("_prev"))).drop("_prev")


def long_running(df: DataFrame, value: str, keys, order, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Running sum (null as 0), running maximum and drawdown along each key."""
    c = chunked(df, keys, order, rows_per_chunk=rows_per_chunk)
    v = F.coalesce(F.col(value), F.lit(0).cast(df.schema[value].dataType))
    upto = _by_chunk(keys).rowsBetween(Window.unboundedPreceding, 0)
    inside = c.withColumns({"_sum": F.sum(v).over(upto), "_max": F.max(value).over(upto)})
    totals = c.groupBy("_chunk", *keys).agg(F.sum(v).alias("_s"), F.max(value).alias("_m"))
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select("_chunk", *keys, F.sum("_s").over(earlier).alias("_cs"), F.max("_m").over(earlier).alias("_cm"))
    j = inside.join(carry, ["_chunk", *keys])
    zero = F.lit(0).cast(df.schema[value].dataType)
    out = j.withColumns({"cum": F.col("_sum") + F.coalesce(F.col("_cs"), zero), "running_max": F.greatest("_max", "_cm")})
    out = out.withColumn("drawdown", F.try_divide(F.col(value), F.col("running_max")) - 1)
    return out.drop("_sum", "_max", "_cs", "_cm", *_INTERNAL)


def entered(z: Column, prev: Column) -> Column:
    """A crossing: outside the band now, and in another zone before (inside, when there is no before)."""
    return (z != "in") & (z != F.coalesce(prev, F.lit("in")))


def crossings(ticks: DataFrame, rules: DataFrame, keys=("asset",), order=("ts", "event_id"), price: str = "price",
              rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Ticks on which an asset crosses out of its band (tick by tick)."""
    z = ticks.join(rules, list(keys)).withColumn("alert", zone(F.col(price), F.col("lower"), F.col("upper")))
    p = with_previous(z.drop("lower", "upper"), "alert", keys, order, "_prev", rows_per_chunk)
    return p.filter(entered(F.col("alert"), F.col("_prev"))).drop("_prev")
