"""Calendar parts and flags of dates and timestamps."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def season(day: Column) -> Column:
    m = F.month(day)
    return F.when(m.isin(12, 1, 2), "Winter").when(m.isin(3, 4, 5), "Spring").when(m.isin(6, 7, 8), "Summer").when(m.isNotNull(), "Fall")


def is_weekend(day: Column) -> Column:
    return (F.weekday(day) >= 5).cast("int")


def is_night(hour: Column, start: int = 22, end: int = 5) -> Column:
    return ((hour >= start) | (hour <= end)).cast("int")


def is_between_hours(hour: Column, start: int, end: int, day: Column | None = None) -> Column:
    """1 from ``start`` to ``end`` inclusive; on weekdays only if ``day`` is given."""
    inside = (hour >= start) & (hour <= end)
    return (inside if day is None else inside & (F.weekday(day) < 5)).cast("int")


def iso_year(day: Column) -> Column:
    """Year of the Thursday of the day's week."""
    return F.year(F.date_add(day, 3 - F.weekday(day)))


def calendar_parts(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Add date, time text, hour, weekday (Monday 0), month, year, ISO year and week, season and flags."""
    t = F.col(ts).cast("timestamp_ntz")
    day, hour = F.to_date(t), F.hour(t)
    return df.withColumns(
        {
            "date": day, "time": F.date_format(t, "HH:mm:ss"), "hour": hour, "day_of_week": F.weekday(day), "month": F.month(day),
            "year": F.year(day), "iso_year": iso_year(day), "iso_week": F.weekofyear(day), "season": season(day), "is_weekend": is_weekend(day),
            "is_night": is_night(hour), "is_school_hour": is_between_hours(hour, 8, 15), "is_business_hour": is_between_hours(hour, 9, 17, day),
        }
    )


def to_local(ts: Column, zone: str) -> Column:
    """Wall-clock time in ``zone`` of a UTC time."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts.cast("timestamp_ntz"))


def _nth_weekday(year: int, month: int, weekday: int, n: int) -> date:
    """The nth (from 1, or -1 for the last) given weekday of a month."""
    if n < 0:
        last = date(year + month // 12, month % 12 + 1, 1) - timedelta(days=1)
        return last - timedelta(days=(last.weekday() - weekday) % 7)
    first = date(year, month, 1)
    return first + timedelta(days=(weekday - first.weekday()) % 7 + 7 * (n - 1))


def us_federal_holidays(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """Dimension of US federal holidays, with the observed day of those that fall on a weekend: ``date``, ``holiday``."""
    rows = set()
    for year in range(first_year, last_year + 2):
        fixed = [(1, 1, "New Year"), (7, 4, "Independence Day"), (11, 11, "Veterans Day"), (12, 25, "Christmas")]
        if year >= 2021:
            fixed.append((6, 19, "Juneteenth"))
        for month, day, name in fixed:
            d = date(year, month, day)
            rows.add((d, name))
            if d.weekday() >= 5:
                rows.add((d + timedelta(days=-1 if d.weekday() == 5 else 1), f"{name} (observed)"))
        moving = [(1, 0, 3, "Martin Luther King Day"), (2, 0, 3, "Washington's Birthday"), (5, 0, -1, "Memorial Day"), (9, 0, 1, "Labor Day"), (10, 0, 2, "Columbus Day"), (11, 3, 4, "Thanksgiving")]
        rows |= {(_nth_weekday(year, month, weekday, n), name) for month, weekday, n, name in moving}
    kept = sorted(r for r in rows if first_year <= r[0].year <= last_year)
    return spark.createDataFrame(kept, "date date, holiday string")


def with_holiday(df: DataFrame, day: str = "date", first_year: int = 1990, last_year: int = 2040) -> DataFrame:
    """Add ``is_holiday``; the dimension has a dozen rows for each year and is broadcast."""
    days = us_federal_holidays(df.sparkSession, first_year, last_year).select(F.col("date").alias("_holiday")).distinct()
    return df.join(F.broadcast(days), F.col(day) == F.col("_holiday"), "left").withColumn("is_holiday", F.col("_holiday").isNotNull().cast("int")).drop("_holiday")
