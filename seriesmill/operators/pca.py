"""Principal components per panel from its correlation matrix."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.functions.windows import join_back
from seriesmill.operators.regression import KEYS, complete, full_matrix, gram, packed, standardise


_ROW = T.ArrayType(T.DoubleType())


@F.pandas_udf(T.StructType().add("share", _ROW).add("loadings", T.ArrayType(_ROW)))
def eigen(n: pd.Series, upper: pd.Series) -> pd.DataFrame:
    """Components of a batch of panels, largest first; the largest loading of each is positive."""
    if len(n) == 0:
        return pd.DataFrame(columns=["share", "loadings"])
    u = np.array(upper.tolist(), float)
    k = int((np.sqrt(8 * u.shape[1] + 1) - 1) / 2)
    s = full_matrix(u, k)
    d = np.sqrt(np.einsum("nii->ni", s))
    d[d == 0] = 1.0
    val, vec = np.linalg.eigh(s / d[:, :, None] / d[:, None, :])
    val, vec = np.maximum(val[:, ::-1], 0.0), vec[:, :, ::-1]
    top = np.take_along_axis(vec, np.abs(vec).argmax(1)[:, None, :], 1)
    vec = vec * np.where(top < 0, -1.0, 1.0)
    share = val / val.sum(1, keepdims=True) * 100
    return pd.DataFrame({"share": share.tolist(), "loadings": np.swapaxes(vec, 1, 2).tolist()})


def pca_fit(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """(keys, share[], loadings[pc][series])"""
    _, upper = packed(cols)
    g = gram(df, cols, keys).select(*keys, eigen(F.col("n"), upper).alias("e"))
    return g.select(*keys, "e.share", "e.loadings")


def explained(fit: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """(keys, pc, share, cum_share) in percent."""
    s = fit.select(*keys, F.posexplode("share").alias("pc", "share")).withColumn("pc", F.col("pc") + 1)
    w = Window.partitionBy(*keys).orderBy("pc").rowsBetween(Window.unboundedPreceding, 0)
    return s.withColumn("cum_share", F.sum("share").over(w))


def loadings(fit: DataFrame, cols: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """(keys, pc, series, loading)"""
    p = fit.select(*keys, F.posexplode("loadings").alias("pc", "l"))
    names = F.array(*[F.lit(c) for c in cols])
    return p.select(*keys, (F.col("pc") + 1).alias("pc"), F.inline(F.arrays_zip(names.alias("series"), F.col("l"))).alias("series", "loading"))


def scores(df: DataFrame, fit: DataFrame, cols: Sequence[str], keys: Sequence[str] = KEYS, order: str = "date") -> DataFrame:
    """(keys, date, pc1..): standardised rows projected on the components, in the JVM."""
    z = join_back(standardise(df.filter(complete(cols)), cols, keys), fit.select(*keys, "loadings"), keys)

    def project(pc: int):
        out = F.lit(0.0)
        for i, c in enumerate(cols):
            out = out + F.col(c) * F.col("loadings")[pc][i]
        return out.alias(f"pc{pc + 1}")

    return z.select(*keys, order, *[project(i) for i in range(len(cols))])
