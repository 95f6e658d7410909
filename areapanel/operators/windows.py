"""Leak-free windows over series of areas."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scan import averages, lookup, scan


def prior_rows_sum(df: DataFrame, value: str, rows: int, keys: list[str], order: str, out: str, min_rows: int = 1, lag: int = 1) -> DataFrame:
    """Sum over the ``rows`` rows that end ``lag`` rows before; null with fewer than ``min_rows`` of them."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-(rows + lag - 1), -lag)
    total = F.sum(value).over(w)
    return df.withColumn(out, F.when(F.count(value).over(w) >= min_rows, total))


def rolling_sum(df: DataFrame, value: str, rows: int, keys: list[str], order: str, out: str) -> DataFrame:
    """Sum over the row itself and the ``rows`` - 1 before."""
    return df.withColumn(out, F.sum(value).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(-(rows - 1), 0)))


def prior_value(df: DataFrame, value: str, keys: list[str], order: str, out: str, default=0) -> DataFrame:
    return df.withColumn(out, F.lag(value, 1, default).over(Window.partitionBy(*keys).orderBy(order)))


def prior_days_sum(df: DataFrame, value: str, days: int, keys: list[str], date: str, out: str) -> DataFrame:
    """Sum over the ``days`` calendar days before the row's date; 0 if there are none."""
    w = Window.partitionBy(*keys).orderBy(F.unix_date(date)).rangeBetween(-days, -1)
    return df.withColumn(out, F.coalesce(F.sum(value).over(w), F.lit(0)))


def ema(df: DataFrame, value: str, alphas: list[float], keys: list[str], order: str) -> DataFrame:
    """Exponential moving averages (first value, then a*x + (1-a)*previous), as ``ema_<alpha>``.

    Null values leave the average as it was; before the first value it is null.
    Rows are dealt to ranges of (keys, order), so one long series may lie in many
    tasks; see :func:`averages`.
    """
    rows = df.select(*keys, order, F.col(value).cast("double").alias(value))
    return averages(rows, keys, [order], value, {f"ema_{a:g}".replace(".", "_"): a for a in alphas})


def running_totals(df: DataFrame, score: str, totals: dict[str, str], descending: bool = False, buckets: int | None = None) -> DataFrame:
    """Adds, by name, the sums of columns over all rows whose score comes before or equals the row's.

    Scores are one row each.  Ranges (``buckets``) of the sampled order are the tasks, so
    outliers, infinities and close scores change nothing.  Nulls are the least
    and NaN the greatest score, as in sorting.
    """
    return scan(df, [], [F.desc(score) if descending else F.asc(score)], {n: (F.col(c), "sum") for n, c in totals.items()}, ranges=buckets)


#: A key or score with more than one in so many of all rows is broadcast, so at most so many are.
HOT = 4096


def decile(df: DataFrame, score: str, tie: str, out: str = "decile", bins: int = 10, keys: list[str] = ()) -> DataFrame:
    """Equal-count bins of the rank by (score, tie) with exact integer edges; within ``keys``, if there are any.

    Rows without a score stay, have no bin and don't count; null keys are one
    key.  Ranks are running counts over ranges of (keys, score, tie): neither a
    hot key nor a score that many rows share meets in one task.
    """
    keys = list(keys)
    ranked = scan(df, keys, [F.asc(score), tie], {"_r": (F.col(score).isNotNull(), "sum")})
    total = ranked.agg(F.count(score).alias("_n"))
    if keys:
        sizes = ranked.groupBy(*keys).agg(F.count(score).alias("_n")).crossJoin(F.broadcast(total.withColumnRenamed("_n", "_all")))
        ranked = lookup(ranked, sizes, keys, F.col("_n") * HOT > F.col("_all")).drop("_all")
    else:
        ranked = ranked.crossJoin(F.broadcast(total))
    value = F.when(F.col("_n") == 1, F.lit(1)).otherwise(F.greatest(F.lit(1), F.expr(f"cast((({bins} * (_r - 1)) + (_n - 2)) div greatest(_n - 1, 1) as int)")))
    return ranked.withColumn(out, F.when(F.col(score).isNotNull(), value)).select(*df.columns, out)


def rank_pct(df: DataFrame, score: str, out: str = "rank_pct") -> DataFrame:
    """Average rank over the number of rows; ranks are running totals of the counts of distinct scores, hot scores are joined by broadcast."""
    per = df.groupBy(score).agg(F.count(F.lit(1)).alias("_c")).where(F.col(score).isNotNull())
    ranked = running_totals(per, score, {"_t": "_c"})
    ranked = ranked.crossJoin(F.broadcast(ranked.agg(F.sum("_c").alias("_n"))))
    pct = (F.col("_t") - F.col("_c") + (F.col("_c") + 1) / 2) / F.col("_n")
    return lookup(df, ranked.select(score, pct.alias(out), "_c", "_n"), [score], F.col("_c") * HOT > F.col("_n")).drop("_c", "_n")


def top_k_per_group(df: DataFrame, keys: list[str], order: list, k: int, out: str = "rank") -> DataFrame:
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(out) <= k)


def share(df: DataFrame, value: str, keys: list[str], out: str = "share") -> DataFrame:
    return df.withColumn(out, F.col(value) / F.sum(value).over(Window.partitionBy(*keys)))


def lead_targets(df: DataFrame, value: str, horizons: list[int], keys: list[str], order: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumns({f"{value}_h{h}": F.lead(value, h).over(w) for h in horizons})


def last_lag(df: DataFrame, value: str, keys: list[str], order: str, lag: int = 1) -> DataFrame:
    """The value ``lag`` rows before each series' last row."""
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("_l", F.lag(value, lag).over(w)).groupBy(*keys).agg(F.max_by("_l", order).alias(f"{value}_lag{lag}"))


def recent_mean(df: DataFrame, value: str, rows: int, keys: list[str], order: list[str]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= rows).groupBy(*keys).agg(F.avg(value).alias(f"{value}_recent_mean"))


def curve_summary(df: DataFrame, k: str, score: str, eps: float = 0.001, window: int = 3) -> DataFrame:
    """Of a score by number of features: gain of each step, the best so far, and whether the last steps gain less than ``eps``."""
    w = Window.orderBy(k)
    gained = df.withColumn("gain", F.col(score) - F.lag(score).over(w)).withColumn("best", F.max(score).over(w))
    return gained.withColumn("plateau", (F.max("gain").over(w.rowsBetween(-(window - 1), 0)) < eps) & (F.count("gain").over(w.rowsBetween(-(window - 1), 0)) >= window))
