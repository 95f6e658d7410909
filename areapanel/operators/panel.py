"""Zero-filled panels of areas and time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import is_between_hours, is_night, is_weekend, season

SEASONS = ("Winter", "Spring", "Summer", "Fall")


def _values(spark: SparkSession, name: str, values) -> DataFrame:
    """A row for each value, in one partition: cross joins multiply partitions."""
    return spark.range(0, 1, 1, 1).select(F.explode(F.array(*map(F.lit, values))).alias(name))


def calendar_panel(events: DataFrame, threshold: int = 6, area: str = "area_id", ts: str = "ts") -> DataFrame:
    """Area x season x weekday x hour (672 rows for each area), with ``event_count`` and ``label`` (count >= threshold)."""
    keyed = events.select(area, season(F.to_date(ts)).alias("season"), F.weekday(ts).alias("day_of_week"), F.hour(ts).alias("hour")).dropna()
    names = F.array(*map(F.lit, SEASONS))
    slot = (F.array_position(names, F.col("season")) - 1) * 168 + F.col("day_of_week") * 24 + F.col("hour")
    counts = keyed.groupBy(area, slot.cast("int").alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    # An area has at most 672 counts; its rows are unfolded from them, so that the grid is neither shuffled nor joined.
    by_area = counts.groupBy(area).agg(F.map_from_entries(F.collect_list(F.struct("slot", "n"))).alias("n"))
    rows = by_area.select(area, "n", F.explode(F.sequence(F.lit(0), F.lit(671))).alias("slot"))
    out = rows.select(
        area,
        F.get(names, F.expr("slot div 168").cast("int")).alias("season"),
        F.expr("slot div 24 % 7").cast("int").alias("day_of_week"),
        F.expr("slot % 24").cast("int").alias("hour"),
        F.coalesce(F.try_element_at("n", F.col("slot")), F.lit(0)).alias("event_count"),
    )
    return out.withColumn("label", (F.col("event_count") >= threshold).cast("int"))


def _filled(grid: DataFrame, counts: DataFrame, keys: list[str], threshold: int) -> DataFrame:
    out = grid.join(counts, keys, "left").withColumn("event_count", F.coalesce("event_count", F.lit(0)))
    return out.withColumn("label", (F.col("event_count") >= threshold).cast("int"))


def _dates(events: DataFrame, date: str, start: str | None, end: str | None, min_days: int = 0) -> DataFrame:
    bounds = events.agg(F.min(date).alias("lo"), F.max(date).alias("hi"))
    lo = F.lit(start).cast("date") if start else F.least(F.col("lo"), F.date_sub("hi", min_days - 1)) if min_days else F.col("lo")
    hi = F.lit(end).cast("date") if end else F.col("hi")
    return bounds.select(F.explode(F.sequence(lo, hi)).alias(date))


def hourly_panel(events: DataFrame, start: str | None = None, end: str | None = None, area: str = "area_id", ts: str = "ts") -> DataFrame:
    """Date x area x hour with ``event_count`` and ``label`` (any event)."""
    keyed = events.select(area, F.to_date(ts).alias("date"), F.hour(ts).alias("hour")).dropna()
    counts = keyed.groupBy(area, "date", "hour").agg(F.count(F.lit(1)).alias("event_count"))
    # One row for each day: small whatever the number of events.
    days = _dates(keyed, "date", start, end).crossJoin(_values(events.sparkSession, "hour", range(24)))
    return _filled(keyed.select(area).distinct().crossJoin(F.broadcast(days)), counts, [area, "date", "hour"], 1)


def daily_panel(events: DataFrame, min_days: int = 0, area: str = "area_id", ts: str = "ts") -> DataFrame:
    """Area x date over the days observed, at least the last ``min_days``, with ``event_count`` and ``label``."""
    keyed = events.select(area, F.to_date(ts).alias("date")).dropna()
    counts = keyed.groupBy(area, "date").agg(F.count(F.lit(1)).alias("event_count"))
    return _filled(keyed.select(area).distinct().crossJoin(F.broadcast(_dates(keyed, "date", None, None, min_days))), counts, [area, "date"], 1)


def densify(df: DataFrame, keys: list[str], date: str, values: list[str]) -> DataFrame:
    """Every date of each key's span; missing values 0."""
    spans = df.groupBy(*keys).agg(F.explode(F.sequence(F.min(date), F.max(date))).alias(date))
    return spans.join(df, [*keys, date], "left").fillna(0, subset=values)


def densify_dates(df: DataFrame, date: str = "date") -> DataFrame:
    return _dates(df, date, None, None).join(df, date, "left")


def fill_prev_year_week(df: DataFrame, values: list[str], date: str = "date") -> DataFrame:
    """Nulls from the mean of the same ISO week of the ISO year before, where that has values."""
    from ..functions.calendar import iso_year

    keyed = df.withColumns({"_y": iso_year(F.col(date)), "_w": F.weekofyear(date)})
    means = keyed.groupBy((F.col("_y") + 1).alias("_y"), "_w").agg(*[F.avg(v).alias(f"_{v}") for v in values])
    return keyed.join(means, ["_y", "_w"], "left").withColumns({v: F.coalesce(F.col(v).cast("double"), f"_{v}") for v in values}).drop("_y", "_w", *[f"_{v}" for v in values])


def missing_dates(df: DataFrame, end: str | None = None, date: str = "date", start: str | None = None) -> DataFrame:
    """Dates from ``start`` (or the first) to ``end`` (or the last) that the data lacks."""
    return _dates(df, date, start, end).join(df.select(date).distinct(), date, "left_anti")


def daily_base(df: DataFrame, candidates: list[str], keys: list[str]) -> DataFrame:
    """Sum of the first candidate that the frame has, else the number of rows."""
    found = next((c for c in candidates if c in df.columns), None)
    return df.groupBy(*keys).agg((F.sum(found) if found else F.count(F.lit(1))).cast("long").alias("base"))


def with_calendar(df: DataFrame, ts: str) -> DataFrame:
    """Calendar features of a future timestamp."""
    day, hour = F.to_date(ts), F.hour(ts)
    return df.withColumns({"date": day, "hour": hour, "day_of_week": F.weekday(day), "month": F.month(day), "season": season(day), "is_weekend": is_weekend(day), "is_night": is_night(hour), "is_business_hour": is_between_hours(hour, 8, 18)})


def future_grid(train: DataFrame, hours: int, static: list[str], lags: list[str], area: str = "area_id", ts: str = "ts", start: str = "after") -> DataFrame:
    """``hours`` hours for each area after the last observed one (or from it), with mean statics and last lags."""
    first = 1 if start == "after" else 0
    steps = train.agg(F.date_trunc("hour", F.max(ts)).alias("last")).select(F.explode(F.sequence(F.lit(first), F.lit(first + hours - 1))).alias("horizon"), "last")
    slots = steps.select(F.timestamp_add("HOUR", F.col("horizon"), F.col("last")).alias(ts), "horizon")
    areas = train.groupBy(area).agg(*[F.avg(c).alias(c) for c in static], *[F.max_by(c, ts).alias(c) for c in lags])
    return with_calendar(areas.crossJoin(F.broadcast(slots)), ts)
