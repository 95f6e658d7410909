"""Baselines, calibrated scores and risk tables.

Scores describe what was recorded.  Recording is uneven, so an area's score is
not a measure of what happens there, and a list made from it repeats where
people looked before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import clip, logit, poisson_any, sigmoid
from ..shared import save
from .aggregate import category_share
from .binning import equal_width, quantile_range, risk_level
from .enrich import lookup_fallback
from .project import dedupe
from .scan import quantiles
from .spatial import count_within
from .windows import decile, rank_pct, top_k_per_group


def poisson_baseline(events: DataFrame, window_days: int | None = None, area: str = "area_id", hour: str = "hour", date: str = "date") -> tuple[DataFrame, DataFrame]:
    """Events a day and chance of any, by (area, hour) and by hour (mean over areas), over the trailing window."""
    from .project import last_days

    recent = last_days(events, window_days, date) if window_days else events
    sizes = recent.agg(F.countDistinct(date).alias("_d"), F.countDistinct(area).alias("_a"))
    fine = recent.groupBy(area, hour).agg(F.count(F.lit(1)).alias("n")).crossJoin(F.broadcast(sizes)).withColumn("rate", F.col("n") / F.col("_d"))
    coarse = recent.groupBy(hour).agg(F.count(F.lit(1)).alias("n")).crossJoin(F.broadcast(sizes)).withColumn("rate", F.col("n") / F.col("_d") / F.col("_a"))
    return tuple(x.withColumn("p_base", poisson_any(F.col("rate"))).drop("_d", "_a") for x in (fine, coarse))


def calibrate(df: DataFrame, score: str, mode: str = "raw", temperature: float = 1.0, power: float = 1.0, winsor: float | None = None, low: float = 0.0, high: float = 1.0) -> DataFrame:
    """``raw``, ``temp``, ``power``, ``temp_power`` or ``rank``; then the upper winsor quantile, then the clip."""
    out = df
    if mode == "rank":
        out = rank_pct(out, score, "_rank").withColumn(score, F.col("_rank")).drop("_rank")
    if "temp" in mode:
        out = out.withColumn(score, sigmoid(logit(F.col(score)) / temperature))
    if "power" in mode:
        out = out.withColumn(score, F.pow(score, F.lit(power)))
    if winsor is not None:
        from .binning import winsorize_upper

        out = winsorize_upper(out, score, winsor)
    return out.withColumn(score, clip(F.col(score), low, high))


def expected_count(df: DataFrame, fine: DataFrame, coarse: DataFrame, score: str = "score", low: float = 0.2, high: float = 3.0) -> DataFrame:
    """Base rate times the clipped ratio of the score to the base chance; (area, hour), then hour, then 0."""
    out = df
    for value in ("rate", "p_base"):
        out = lookup_fallback(out, fine, coarse, ["area_id", "hour"], ["hour"], value, 0.0)
    return out.withColumn("expected_count", F.col("rate") * clip(F.coalesce(F.try_divide(F.col(score), F.col("p_base")), F.lit(1.0)), low, high))


def shrink_to_base(score: Column, base: Column, alpha: float = 0.7) -> Column:
    return alpha * score + (1 - alpha) * base


def rescale(x: Column, low: float = 0.05, high: float = 0.95) -> Column:
    return low + (high - low) * x


def top_category_risk(df: DataFrame, events: DataFrame, keys: list[str], k: int = 3, rate: str = "expected_count") -> DataFrame:
    """For each row its k likeliest categories: expected number (rate times share) and chance of any."""
    shares = category_share(events, keys).withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("n"), "category"))).where(F.col("rank") <= k)
    joined = df.join(shares.select(*keys, "category", "share", "rank"), keys)
    return joined.withColumn("category_expected", F.col(rate) * F.col("share")).withColumn("category_chance", poisson_any(F.col("category_expected")))


def hourly_risk(scored: DataFrame, events: DataFrame, threshold: float, tie: str = "event_id") -> DataFrame:
    """One row for each (area, date, hour), the last scored: calibrated score, level, decile, expected count."""
    last = dedupe(scored, ["area_id", "date", "hour"], [tie])
    fine, coarse = poisson_baseline(events)
    ranked = decile(risk_level(calibrate(last, "score", low=0.0, high=1.0), "score", threshold), "score", tie)
    return expected_count(ranked, fine, coarse)


def daily_level(score: Column, threshold: float, q80: Column, q90: Column) -> Column:
    """critical and high need the threshold (0.8 of it) and the 90th (80th) percentile; medium needs half the threshold."""
    return F.when(score >= F.greatest(F.lit(threshold), q90), "critical").when(score >= F.greatest(F.lit(0.8 * threshold), q80), "high").when(score >= 0.5 * threshold, "medium").otherwise("low")


def daily_risk(hourly: DataFrame, threshold: float, types: DataFrame | None = None, k: int = 3) -> DataFrame:
    """A row for each area and day of an hourly risk table (``area_id``, ``date``, ``score``, ``expected_count``).

    ``any_score``: chance of any event in the day (to twelve digits, so that the
    order of its factors doesn't matter); ``expected_count`` of the day; ``level``
    (:func:`daily_level`); ``decile``.  With ``types`` (``area_id``, ``date``,
    ``category``, ``category_expected``: what is expected of the commonest
    categories of each hour) also ``top1`` to ``topk`` of the day by their sums,
    with ``_expected`` and the ``_chance`` of any; null where a day has fewer.
    """
    p = clip(F.coalesce(F.col("score"), F.lit(0.0)), 0.0, 1.0)
    daily = hourly.groupBy("area_id", "date").agg(F.round(1 - F.product(1 - p), 12).alias("any_score"), F.sum("expected_count").alias("expected_count"))
    q = quantiles(daily, {"any_score": [0.8, 0.9]}).select(F.get("any_score", F.lit(0)).alias("_q80"), F.get("any_score", F.lit(1)).alias("_q90"))
    levels = daily.crossJoin(F.broadcast(q)).withColumn("level", daily_level(F.col("any_score"), threshold, F.col("_q80"), F.col("_q90"))).drop("_q80", "_q90")
    out = decile(levels.withColumn("_tie", F.concat_ws("|", "area_id", F.col("date").cast("string"))), "any_score", "_tie").drop("_tie")
    if types is None:
        return out
    keys = ["area_id", "date"]
    sums = types.where("category <> ''").groupBy(*keys, "category").agg(F.sum("category_expected").alias("_e"))
    ranked = top_k_per_group(sums, keys, [F.desc(F.round("_e", 12)), F.asc("category")], k)
    pick = lambda i, c: F.max(F.when(F.col("rank") == i, c))
    wide = ranked.groupBy(*keys).agg(*[x for i in range(1, k + 1) for x in (pick(i, F.col("category")).alias(f"top{i}"), pick(i, F.col("_e")).alias(f"top{i}_expected"), pick(i, poisson_any(F.col("_e"))).alias(f"top{i}_chance"))])
    return out.join(wide, keys, "left")


def place_features(places: DataFrame, type_risk: DataFrame, areas: DataFrame, radii: list[float] = (), bins: int = 5, none: str = "No_POI") -> DataFrame:
    """What lies in and around each area: a row for each of ``areas`` (``area_id``, ``lat``, ``lon``).

    ``places``: ``poi_id``, ``area_id``, ``poi_type``, ``lat``, ``lon``; ``type_risk``:
    ``poi_type``, ``risk`` (a type without one has 0).  In the area: ``poi_count``,
    ``poi_risk`` (sum), ``poi_type`` (the commonest, the least of those; ``none``
    without any), and the ranges ``poi_count_range``, ``poi_risk_range`` (by
    quantile) and ``poi_count_class`` (of equal width).  Around its middle:
    ``within_<r>`` places and ``sum_<r>`` of their risks.
    """
    rated = places.join(type_risk.select("poi_type", F.col("risk").cast("double").alias("_risk")), "poi_type", "left").fillna(0.0, subset=["_risk"])
    kinds = rated.where(F.col("poi_type").isNotNull() & (F.col("poi_type") != "")).groupBy("area_id", "poi_type").agg(F.count(F.lit(1)).alias("_n"))
    commonest = kinds.groupBy("area_id").agg(F.min(F.struct((-F.col("_n")).alias("_n"), "poi_type")).alias("_m")).select("area_id", F.col("_m.poi_type").alias("poi_type"))
    inside = rated.groupBy("area_id").agg(F.count(F.lit(1)).alias("poi_count"), F.sum("_risk").alias("poi_risk"))
    out = areas.select("area_id").join(inside, "area_id", "left").fillna(0, subset=["poi_count", "poi_risk"]).join(commonest, "area_id", "left").fillna(none, subset=["poi_type"])
    out = save(out, "place-features")
    out = quantile_range(quantile_range(out, "poi_count", bins), "poi_risk", bins)
    out = equal_width(out, "poi_count", bins, "poi_count_class")
    if radii:
        there = rated.select(F.col("poi_id").alias("dst_id"), F.col("lat").alias("dst_lat"), F.col("lon").alias("dst_lon"), "_risk")
        around = count_within(areas.select(F.col("area_id").alias("src_id"), "lat", "lon"), there, list(radii), "_risk")
        out = out.join(around.withColumnRenamed("src_id", "area_id"), "area_id")
    return out


def reason_codes(df: DataFrame, rules: list[tuple[str, str, float]], most: int = 5, out: str = "reasons") -> DataFrame:
    """Texts of the rules that hold, in order, at most ``most``: (column, text, factor); a column must exceed factor x its median, or be below for a negative factor."""
    columns = list(dict.fromkeys(c for c, _, _ in rules))
    medians = quantiles(df, {c: [0.5] for c in columns}).select(*[F.get(c, F.lit(0)).alias(f"_{c}") for c in columns])
    codes = [F.when(F.col(c) > f * F.col(f"_{c}") if f > 0 else F.col(c) < -f * F.col(f"_{c}"), F.lit(t)) for c, t, f in rules]
    text = F.array_join(F.slice(F.filter(F.array(*codes), lambda x: x.isNotNull()), 1, most), "; ")
    return df.crossJoin(F.broadcast(medians)).withColumn(out, text).drop(*[f"_{c}" for c in columns])


def spatial_target_encode(train: DataFrame, edges: DataFrame, m: float = 50.0, label: str = "label", area: str = "area_id") -> DataFrame:
    """(own positives + m x mean + neighbours' positives) / (own rows + m + neighbours' rows), by area; fit it on training folds only."""
    own = train.groupBy(area).agg(F.sum(label).alias("y"), F.count(F.lit(1)).alias("n"))
    near = edges.join(own.select(F.col(area).alias("neighbor"), "y", "n"), "neighbor").groupBy(area).agg(F.sum("y").alias("_y"), F.sum("n").alias("_n"))
    mean = train.agg(F.avg(label).alias("_m"))
    joined = own.join(near, area, "left").crossJoin(F.broadcast(mean)).fillna(0, subset=["_y", "_n"])
    return joined.select(area, ((F.col("y") + m * F.col("_m") + F.col("_y")) / (F.col("n") + m + F.col("_n"))).alias("encoded"))
