"""Joins that add columns and keep rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrich(df: DataFrame, side: DataFrame, keys: list[str], how: str = "left", null_safe: bool = False) -> DataFrame:
    """Left equi-join; null keys match nulls only if asked for."""
    if not null_safe:
        return df.join(side, keys, how)
    renamed = side.withColumnsRenamed({k: f"_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return df.join(renamed, on, how).drop(*[f"_{k}" for k in keys])


def enrich_calendar(df: DataFrame, side: DataFrame, values: list[str], keys: list[str]) -> DataFrame:
    """Medians of the side by calendar keys."""
    return df.join(side.groupBy(*keys).agg(*[F.median(v).alias(v) for v in values]), keys, "left")


def enrich_fallback(df: DataFrame, side: DataFrame, values: list[str], levels: list[list[str]], per_row: bool = False) -> DataFrame:
    """Means of the side at the first level of keys that both have; row by row through all levels if ``per_row``."""
    usable = [k for k in levels if all(c in df.columns and c in side.columns for c in k)]
    if not per_row:
        usable = usable[:1]
    out = df
    for i, keys in enumerate(usable):
        out = out.join(side.groupBy(*keys).agg(*[F.avg(v).alias(f"_{v}{i}") for v in values]), keys, "left")
    for v in values:
        out = out.withColumn(v, F.coalesce(*[f"_{v}{i}" for i in range(len(usable))]) if usable else F.lit(None).cast("double"))
    return out.drop(*[f"_{v}{i}" for v in values for i in range(len(usable))])


def duplicate_keys(side: DataFrame, keys: list[str]) -> DataFrame:
    return side.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def enrich_static(df: DataFrame, dim: DataFrame, keys: list[str], keep: str = "rows", check: bool = True) -> DataFrame:
    """Many-to-one join with a dimension; raises if the dimension repeats a key (``check`` runs a job while the plan is made).

    No hint: Spark broadcasts the dimension if its size allows.  ``keep="areas"`` keeps every row of the dimension.
    """
    if check and duplicate_keys(dim, keys).limit(1).count():
        raise ValueError(f"the dimension repeats keys {keys}")
    return df.join(dim, keys, "right" if keep == "areas" else "left")


def merge_summaries(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return a.join(b, keys, "full")


def restrict_to(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    return df.join(keys, on, "left_semi")


def match_report(df: DataFrame, side: DataFrame, keys: list[str]) -> DataFrame:
    """One row: ``n``, ``matched``, ``match_rate``."""
    known = side.select(*keys).distinct().withColumn("_hit", F.lit(1))
    return df.join(known, keys, "left").agg(F.count(F.lit(1)).alias("n"), F.count("_hit").alias("matched")).withColumn("match_rate", F.try_divide("matched", "n"))


def unmatched(df: DataFrame, side: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(side, keys, "left_anti")


def attach_label(events: DataFrame, labels: DataFrame, keys: list[str], label: str = "label") -> DataFrame:
    """A key is labelled 1 if any of its label rows is."""
    return events.join(labels.groupBy(*keys).agg(F.max(label).alias(label)), keys, "left")


def merge_on(main: DataFrame, addon: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Left join after dropping columns that ``main`` has and keeping the first addon row of each key by ``order``."""
    from .project import dedupe, trim_overlap

    return main.join(trim_overlap(main, dedupe(addon, keys, order, "first"), keys), keys, "left")


def lookup_fallback(df: DataFrame, fine: DataFrame, coarse: DataFrame, fine_keys: list[str], coarse_keys: list[str], value: str, default: float) -> DataFrame:
    """The fine value, else the coarse one, else the default."""
    out = df.join(fine.select(*fine_keys, F.col(value).alias("_f")), fine_keys, "left").join(coarse.select(*coarse_keys, F.col(value).alias("_c")), coarse_keys, "left")
    return out.withColumn(value, F.coalesce("_f", "_c", F.lit(default))).drop("_f", "_c")


def join_hierarchical(df: DataFrame, side: DataFrame, key: str, value: str, length: int | None = None) -> DataFrame:
    """Sum the side over keys cut to the usual length of the frame's keys (or ``length``), and join."""
    if length is None:
        sized = side.crossJoin(F.broadcast(df.agg(F.mode(F.length(key), True).alias("_len"))))
        cut = sized.withColumn(key, F.left(F.col(key), F.col("_len")))
    else:
        cut = side.withColumn(key, F.left(F.col(key), F.lit(length)))
    return df.join(cut.groupBy(key).agg(F.sum(value).alias(value)), key, "left")


def backfill_column(df: DataFrame, side: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Fill an empty or null text from the side."""
    out = df.join(side.select(*keys, F.col(column).alias("_b")), keys, "left")
    return out.withColumn(column, F.when(F.length(F.trim(column)) > 0, F.col(column)).otherwise(F.col("_b"))).drop("_b")


def attach_scores(df: DataFrame, scores: DataFrame, keys: list[str], names: tuple[str, ...] = ("proba", "prob", "p", "y_pred_proba", "risk_score")) -> DataFrame:
    """Scores by key, under the name ``score``: the first of ``names`` that is there, else the only other column."""
    from .project import resolve_column

    column = resolve_column(scores, list(names)) or next(c for c in scores.columns if c not in keys)
    return df.join(scores.select(*keys, F.col(column).cast("double").alias("score")), keys, "left")
