"""Bins and quantile labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scan import quantiles


def fd_bins(df: DataFrame, column: str, max_bins: int = 10) -> DataFrame:
    """One row ``bins``: Freedman-Diaconis count within 2..max; sqrt(n) if the middle half is one value; 1 if all are."""
    s = quantiles(df, {column: [0.25, 0.75]}).select(F.col(column).alias("q")).crossJoin(df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"), F.count(column).alias("n")))
    width = 2 * (F.col("q")[1] - F.col("q")[0]) / F.pow(F.col("n"), F.lit(1 / 3))
    raw = F.when(width > 0, F.ceil((F.col("hi") - F.col("lo")) / width)).otherwise(F.ceil(F.sqrt("n")))
    bins = F.when(F.col("n") == 0, 1).when(F.col("hi") == F.col("lo"), 1).otherwise(F.greatest(F.lit(2), F.least(F.lit(max_bins), raw)))
    return s.select(bins.cast("int").alias("bins"))


def _edges(df: DataFrame, column: str, bins: int, distinct: bool) -> DataFrame:
    cuts = quantiles(df, {column: [i / bins for i in range(bins + 1)]})
    return cuts.select((F.array_distinct(column) if distinct else F.col(column)).alias("_e"))


def bucket(x: Column, edges: Column) -> Column:
    """Bin from 1, right-closed, the lowest edge included."""
    return F.greatest(F.lit(1), F.size(F.filter(edges, lambda e: e < x)))


def quantile_range(df: DataFrame, column: str, bins: int = 5, style: str = "range", out: str | None = None) -> DataFrame:
    """Quantile label of each value.

    ``range``: ``lo-hi``; ``q``: ``Q1 (<=hi)``, ``Qi (lo-hi)``, ``Unknown`` for nulls or
    a single value; ``q5``: ``Qi`` with edges as they are, nulls in Q1.
    """
    out = out or f"{column}_range"
    edged = df.crossJoin(F.broadcast(_edges(df, column, bins, style != "q5")))
    x, e = F.col(column), F.col("_e")
    b = bucket(x, e)
    text = lambda c: c.cast("int").cast("string")
    lo, hi = text(F.get(e, b - 1)), text(F.get(e, b))
    if style == "q5":
        label = F.concat(F.lit("Q"), F.coalesce(F.least(F.lit(bins), b), F.lit(1)).cast("string"))
    elif style == "q":
        label = F.when(x.isNull() | (F.size(e) < 2), "Unknown").when(b == 1, F.concat(F.lit("Q1 (<="), hi, F.lit(")"))).otherwise(F.concat(F.lit("Q"), b.cast("string"), F.lit(" ("), lo, F.lit("-"), hi, F.lit(")")))
    else:
        label = F.when(x.isNull(), None).when(F.size(e) < 2, text(e[0])).otherwise(F.concat_ws("-", lo, hi))
    return edged.withColumn(out, label).drop("_e")


def equal_width(df: DataFrame, column: str, bins: int = 5, out: str = "bin") -> DataFrame:
    """Bins of one width, right-closed, from 1."""
    s = df.agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    x = F.when(F.col("_hi") == F.col("_lo"), 1).otherwise(F.greatest(F.lit(1), F.ceil((F.col(column) - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * bins)))
    return df.crossJoin(F.broadcast(s)).withColumn(out, F.when(F.col(column).isNotNull(), x).cast("int")).drop("_lo", "_hi")


def risk_level(df: DataFrame, score: str, threshold: float, out: str = "level") -> DataFrame:
    """critical, high, medium, low: at the threshold or more, at the 90th or 80th percentile or more, below."""
    q = quantiles(df, {score: [0.8, 0.9]}).select(F.get(score, F.lit(0)).alias("_q80"), F.get(score, F.lit(1)).alias("_q90"))
    level = F.when(F.col(score) >= threshold, "critical").when(F.col(score) >= F.col("_q90"), "high").when(F.col(score) >= F.col("_q80"), "medium").otherwise("low")
    return df.crossJoin(F.broadcast(q)).withColumn(out, level).drop("_q80", "_q90")


def level_from_decile(decile: Column) -> Column:
    return F.when(decile.isNull(), "unknown").when(decile <= 3, "low").when(decile <= 7, "medium").otherwise("high")


def scale_to(df: DataFrame, column: str, top: float = 3.0, out: str = "scaled") -> DataFrame:
    """Min-max to 0..top rounded to two digits; the middle if all values are equal."""
    s = df.agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    x = F.when(F.col("_hi") == F.col("_lo"), top / 2).otherwise(F.round((F.col(column) - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * top, 2))
    return df.crossJoin(F.broadcast(s)).withColumn(out, x).drop("_lo", "_hi")


def winsorize_upper(df: DataFrame, column: str, q: float) -> DataFrame:
    s = quantiles(df, {column: [q]}).select(F.get(column, F.lit(0)).alias("_q"))
    return df.crossJoin(F.broadcast(s)).withColumn(column, F.least(F.col(column), F.col("_q"))).drop("_q")
