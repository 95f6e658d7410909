"""Metrics, splits and leak checks, without a global sort of rows.

Curves are running totals over the counts of each distinct score; no task gets
all scores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scan import quantiles, scan
from .windows import running_totals


def classification_metrics(df: DataFrame, score: str = "score", label: str = "label", threshold: float = 0.5) -> DataFrame:
    """accuracy, precision, recall, f1 (0 where undefined), log_loss, brier."""
    p, y = F.col(score) >= threshold, F.col(label) == 1
    c = df.agg(F.count_if(p & y).alias("tp"), F.count_if(p & ~y).alias("fp"), F.count_if(~p & y).alias("fn"), F.count(F.lit(1)).alias("n"), F.avg(F.when(y, -F.log(F.greatest(F.col(score), F.lit(1e-15)))).otherwise(-F.log(F.greatest(1 - F.col(score), F.lit(1e-15))))).alias("log_loss"), F.avg(F.pow(F.col(label) - F.col(score), 2)).alias("brier"))
    zero = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    out = c.withColumns({"accuracy": F.try_divide(F.col("n") - F.col("fp") - F.col("fn"), F.col("n")), "precision": zero(F.col("tp"), F.col("tp") + F.col("fp")), "recall": zero(F.col("tp"), F.col("tp") + F.col("fn"))})
    return out.withColumn("f1", zero(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))).select("accuracy", "precision", "recall", "f1", "log_loss", "brier")


def score_curve(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """By distinct score, descending: tp, fp, and the totals."""
    per = df.groupBy(score).agg(F.sum(label).cast("double").alias("p"), F.count(F.lit(1)).alias("c"))
    total = per.agg(F.sum("p").alias("positives"), F.sum("c").alias("rows"))
    curve = running_totals(per, score, {"tp": "p", "upto": "c"}, descending=True)
    return curve.withColumn("fp", F.col("upto") - F.col("tp")).drop("upto").crossJoin(F.broadcast(total))


def average_precision(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    c = score_curve(df, score, label)
    return c.agg(F.sum(F.try_divide(F.col("p"), F.col("positives")) * F.col("tp") / (F.col("tp") + F.col("fp"))).alias("average_precision"))


def roc_auc(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Mann-Whitney: share of (positive, negative) pairs in order, ties half."""
    c = score_curve(df, score, label).withColumn("neg", F.col("c") - F.col("p"))
    return c.agg(F.try_divide(F.sum(F.col("neg") * (F.col("tp") - F.col("p") / 2)), F.max("positives") * (F.max("rows") - F.max("positives"))).alias("roc_auc"))


def best_threshold(df: DataFrame, beta: float = 1.0, score: str = "score", label: str = "label") -> DataFrame:
    """The score with the greatest F-beta (the greatest such score): ``threshold``, ``f_beta``."""
    c = score_curve(df, score, label)
    p, r = F.col("tp") / (F.col("tp") + F.col("fp")), F.try_divide(F.col("tp"), F.col("positives"))
    f = F.coalesce(F.try_divide((1 + beta**2) * p * r, beta**2 * p + r), F.lit(0.0))
    return c.select(F.struct(F.round(f, 12).alias("f_beta"), F.col(score).alias("threshold")).alias("x")).agg(F.max("x").alias("x")).select("x.threshold", "x.f_beta")


def precision_at_k(df: DataFrame, k: int, tie: str, score: str = "score", label: str = "label") -> DataFrame:
    return df.orderBy(F.desc(score), tie).limit(k).agg(F.avg(label).alias("precision_at_k"))


def oot_split(df: DataFrame, horizon_days: int, date: str = "date") -> DataFrame:
    """``split``: test for the last days, train before."""
    hi = df.agg(F.max(date).alias("_hi"))
    return df.crossJoin(F.broadcast(hi)).withColumn("split", F.when(F.col(date) > F.date_sub("_hi", horizon_days), "test").otherwise("train")).drop("_hi")


def quantile_split(df: DataFrame, q: float = 0.8, ts: str = "ts") -> DataFrame:
    seconds = df.select(F.unix_timestamp(F.col(ts).cast("timestamp")).alias("_s"))
    cut = quantiles(seconds, {"_s": [q]}).select(F.get("_s", F.lit(0)).alias("_cut"))
    return df.crossJoin(F.broadcast(cut)).withColumn("split", F.when(F.unix_timestamp(F.col(ts).cast("timestamp")) > F.col("_cut"), "test").otherwise("train")).drop("_cut")


def time_folds(df: DataFrame, k: int, date: str = "date") -> DataFrame:
    """``fold`` 0..k by date: k + 1 runs of distinct dates; fold 0 is only trained on."""
    days = df.select(date).distinct().withColumn("fold", F.ntile(k + 1).over(Window.orderBy(date)) - 1)
    return df.join(F.broadcast(days), date)


def stratified_split(df: DataFrame, label: str, fraction: float, seed: int, key: str) -> DataFrame:
    """``split``: the rows of each class with the least hash are the test; the same ones each time."""
    h = F.xxhash64(F.col(key), F.lit(seed))
    return df.withColumn("split", F.when(F.pmod(h, F.lit(1_000_000)) < int(fraction * 1_000_000), "test").otherwise("train"))


def stratified_folds(df: DataFrame, label: str, k: int, key: str) -> DataFrame:
    return df.withColumn("fold", F.pmod(F.xxhash64(F.col(key), F.col(label)), F.lit(k)).cast("int"))


def class_weight(df: DataFrame, label: str = "label") -> DataFrame:
    """``n_positive``, ``n_negative``, ``weight`` of a positive row."""
    c = df.agg(F.count_if(F.col(label) == 1).alias("n_positive"), F.count_if(F.col(label) == 0).alias("n_negative"))
    return c.withColumn("weight", F.coalesce(F.try_divide("n_negative", "n_positive"), F.lit(1.0)))


def find_leaky(df: DataFrame, columns: list[str], label: str = "label", threshold: float = 0.995, min_rows: int = 30) -> DataFrame:
    """``column``, ``abs_corr``, ``auc``, ``leaky``: columns that alone tell the label.  A column's values are ranked in ranges."""
    corr = df.agg(*[F.struct(F.abs(F.corr(F.col(c).cast("double"), F.col(label).cast("double"))).alias("r"), F.count(c).alias("n")).alias(c) for c in columns])
    corr = corr.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}.r").alias("abs_corr"), F.col(f"{c}.n").alias("n")) for c in columns])).alias("x")).select("x.*")
    long = df.select(F.col(label).alias("_y"), *[F.col(c).cast("double").alias(c) for c in columns]).unpivot("_y", columns, "column", "v").where("v is not null")
    per = long.groupBy("column", "v").agg(F.sum("_y").cast("double").alias("p"), F.count(F.lit(1)).alias("c"))
    below = scan(per, ["column"], ["v"], {"_upto": (F.col("c") - F.col("p"), "sum")}).withColumn("b", F.col("_upto") - (F.col("c") - F.col("p")))
    auc = below.groupBy("column").agg(F.try_divide(F.sum(F.col("p") * (F.col("b") + (F.col("c") - F.col("p")) / 2)), F.sum("p") * (F.sum("c") - F.sum("p"))).alias("auc"))
    out = corr.join(auc, "column", "left")
    strong = (F.coalesce("abs_corr", F.lit(0.0)) >= threshold) | (F.coalesce(F.greatest(F.col("auc"), 1 - F.col("auc")), F.lit(0.0)) >= threshold) & (F.col("n") >= min_rows)
    return out.select("column", "abs_corr", "auc", strong.alias("leaky"))


def collapse_importance(df: DataFrame, feature: str = "feature", importance: str = "importance") -> DataFrame:
    """Importances of one-hot columns (``name=value``) added up by source column, ranked."""
    base = df.groupBy(F.split(F.col(feature), "=")[0].alias("column")).agg(F.sum(importance).alias("importance"))
    return base.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("importance"), "column")))


def canonical_importance(df: DataFrame, feature: str, value: str) -> DataFrame:
    """Non-negative shares that add up to 1."""
    per = df.groupBy(F.trim(F.col(feature)).alias("feature")).agg(F.sum(F.greatest(F.col(value).cast("double"), F.lit(0.0))).alias("v"))
    return per.crossJoin(F.broadcast(per.agg(F.sum("v").alias("_t")))).select("feature", F.coalesce(F.try_divide("v", "_t"), F.lit(0.0)).alias("importance"))


