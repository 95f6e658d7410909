"""The cleaning step between the assembled panel and the models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import title, to_flag, to_num
from .aggregate import externals_score, group_rare
from .scan import quantiles
from .windows import prior_days_sum

#: What stands for a distance that isn't known, and for its class where the column has none at all.
FAR, FAR_CLASS = 9999.0, 3


def _whole(col: Column, default: int = 0) -> Column:
    return F.round(to_num(col, default)).cast("long")


def near_repeats(df: DataFrame, days: tuple[int, ...] = (7, 14), count: str = "event_count", area: str = "area_id", date: str = "date", category: str = "category_grouped") -> DataFrame:
    """Adds ``nr_<n>d``: events of the row's area and category in the n days before its date (0 if there are none).

    Events are counted by area, category and day first; rows of a day share its sums.
    """
    keys = [area, category]
    daily = df.where(F.col(date).isNotNull()).groupBy(*keys, date).agg(F.sum(count).alias("_n"))
    for n in days:
        daily = prior_days_sum(daily, "_n", n, keys, date, f"nr_{n}d")
    names = [f"nr_{n}d" for n in days]
    side = daily.select(*[F.col(c).alias(f"_{c}") for c in (*keys, date)], *[F.col(c).cast("double").alias(c) for c in names])
    same = F.col(area).eqNullSafe(F.col(f"_{area}")) & F.col(category).eqNullSafe(F.col(f"_{category}")) & (F.col(date) == F.col(f"_{date}"))
    return df.join(side, same, "left").drop(*[f"_{c}" for c in (*keys, date)]).fillna(0.0, subset=names)


def clean_panel(
    df: DataFrame,
    counts: list[str] = (),
    amounts: list[str] = (),
    flags: list[str] = (),
    distances: list[str] = (),
    ranges: list[str] = (),
    distance_ranges: list[str] = (),
    medians: list[str] = (),
    kinds: list[str] = (),
    externals: dict[str, list[str]] | None = None,
    categories: tuple[str, ...] = ("category", "subcategory"),
    area: str = "area_id",
    date: str = "date",
    count: str = "event_count",
    label: str = "label",
    min_share: float = 0.01,
    min_count: int = 200,
    days: tuple[int, ...] = (7, 14),
) -> DataFrame:
    """The assembled panel as the models take it; columns that the frame lacks are passed over.

    - ``area``: the digits of the key; ``date``: a day.
    - ``categories``: trimmed, in title case, with ``<name>_grouped`` in which rare values (under ``min_share`` of the
      rows or ``min_count``) are ``Other``.
    - ``counts``, ``ranges``: whole numbers, 0 where there is none; ``amounts``: numbers, 0 where there is none;
      ``flags``: 1 for words of truth, else 0.
    - ``distances``: 9999 where unknown; ``distance_ranges``: the greatest class (3 without any).
    - ``medians``: the median; ``kinds``: ``None`` for null and empty text.
    - ``count`` is made from ``label`` where it isn't there; ``nr_<n>d`` are events of area and category in the ``days``
      before (:func:`near_repeats`).
    - ``externals``: category -> columns whose mean, nulls aside, is ``externals_score`` (0 without any).

    Rows stay, whatever they lack.  Medians and greatest classes come as one row; rare values by their counts.
    """
    there = lambda names: [c for c in names if c in df.columns]
    out = df
    if area in df.columns:
        out = out.withColumn(area, F.nullif(F.regexp_extract(F.col(area).cast("string"), r"(\d+)", 1), F.lit("")))
    if date in df.columns:
        out = out.withColumn(date, F.try_to_timestamp(F.col(date).cast("string")).cast("date"))
    if count not in df.columns and label in df.columns:
        out = out.withColumn(count, _whole(F.col(label)))
    new = {c: _whole(F.col(c)) for c in (*there(counts), *there(ranges))}
    new |= {c: to_num(F.col(c), 0.0) for c in there(amounts)} | {c: F.coalesce(to_flag(F.col(c)), F.lit(0)) for c in there(flags)}
    new |= {c: to_num(F.col(c), FAR) for c in there(distances)} | {c: to_num(F.col(c)) for c in (*there(distance_ranges), *there(medians))}
    new |= {c: F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), F.lit("None")) for c in there(kinds)}
    out = out.withColumns(new) if new else out
    if classes := there(distance_ranges):
        most = out.agg(*[F.coalesce(F.floor(F.max(c)), F.lit(FAR_CLASS)).alias(f"_{c}") for c in classes])
        out = out.crossJoin(F.broadcast(most)).withColumns({c: F.round(F.coalesce(F.col(c), F.col(f"_{c}"))).cast("long") for c in classes}).drop(*[f"_{c}" for c in classes])
    if middles := there(medians):
        middle = quantiles(out, {c: [0.5] for c in middles}).select(*[F.coalesce(F.get(c, F.lit(0)), F.lit(0.0)).alias(f"_{c}") for c in middles])
        out = out.crossJoin(F.broadcast(middle)).withColumns({c: F.coalesce(F.col(c), F.col(f"_{c}")) for c in middles}).drop(*[f"_{c}" for c in middles])
    for c in there(categories):
        out = group_rare(out.withColumn(c, title(F.col(c).cast("string"))), c, min_share, min_count)
    kind = next((c for c in (*[f"{x}_grouped" for x in categories], *categories) if c in out.columns), None)
    if kind and {area, date, count} <= set(out.columns):
        out = near_repeats(out, days, count, area, date, kind)
    if kind and externals:
        out = externals_score(out, {k: there(v) for k, v in externals.items() if there(v)}, kind).fillna(0.0, subset=["externals_score"])
    return out
