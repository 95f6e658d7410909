"""Forecast grids and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import hour_key
from ..functions.numbers import poisson_any
from .binning import level_from_decile
from .panel import with_calendar
from .risk import reason_codes
from .topk import fill_topk, top_share
from .windows import decile

#: Steps: (count, unit, hours between steps).
HORIZONS = {"24h": (24, 1), "7d": (56, 3), "365d": (365, 24)}


def forecast_grid(profile: DataFrame, last: DataFrame, horizon: str, area: str = "area_id", start: str = "after") -> DataFrame:
    """Each area's profile at the slots of a horizon: 24 hours, 7 days by 3 hours, 365 days at noon.

    ``last`` has one row with ``last``, the last observed time; slots begin
    after it, or at it.
    """
    n, hours = HORIZONS[horizon]
    first = F.date_trunc("hour", "last") if horizon != "365d" else F.timestamp_add("HOUR", F.lit(12), F.date_trunc("day", "last"))
    skip = 1 if start == "after" else 0
    slots = last.select(F.explode(F.sequence(F.lit(skip), F.lit(n - 1 + skip))).alias("step"), first.alias("first")).select(F.timestamp_add("HOUR", F.col("step") * hours, F.col("first")).alias("ts"), "step")
    return with_calendar(profile.crossJoin(F.broadcast(slots)), "ts")


def forecast_tables(scored: DataFrame, score: str = "score", expected: str = "poisson") -> DataFrame:
    """Decile, level and expected number of each slot (the rate whose chance of any event is the score, or the score)."""
    out = decile(scored.withColumn("_tie", F.concat_ws("|", "area_id", F.col("ts").cast("string"))), score, "_tie").drop("_tie")
    rate = -F.log(F.greatest(1 - F.col(score), F.lit(1e-9))) if expected == "poisson" else F.col(score)
    return out.withColumn("level", level_from_decile(F.col("decile"))).withColumn("expected_count", rate)


def baseline_score(grid: DataFrame, events: DataFrame, days: int, keys: list[str]) -> DataFrame:
    """Chance of any event at a slot, from the mean number at the same keys."""
    rate = events.groupBy(*keys).agg((F.count(F.lit(1)) / days).alias("_r"))
    return grid.join(rate, keys, "left").withColumn("score", poisson_any(F.coalesce("_r", F.lit(0.0)))).drop("_r")


#: Of each table: how many categories it names, and the keys by which their shares are looked up.
TABLES = {"24h": (3, ["area_id", "hour"]), "7d": (3, ["area_id"]), "365d": (5, ["area_id"])}


def rolled_up(scored: DataFrame, horizon: str, means: list[str] = ()) -> DataFrame:
    """A horizon's slots as its table has them: hours; 3-hour bins (``hour`` is the first); days.  Mean score and ``means``, summed expectation."""
    keys = {"24h": ["area_id", "date", "hour"], "7d": ["area_id", "date", "hour"], "365d": ["area_id", "date"]}[horizon]
    binned = scored.withColumn("hour", hour_key(F.col("hour"))) if horizon == "7d" else scored
    return binned.groupBy(*keys).agg(F.avg("score").alias("score"), F.sum("expected_count").alias("expected_count"), *[F.avg(c).alias(c) for c in means])


def detailed_tables(scored: dict[str, DataFrame], events: DataFrame, rules: list[tuple[str, str, float]] = (), most: int = 5) -> dict[str, DataFrame]:
    """The forecast tables: 24 hours by hour, 7 days by 3 hours, 365 days by day.

    ``scored``: horizon -> slots with ``area_id``, ``date``, ``hour``, ``score``,
    ``expected_count`` and the columns of ``rules``; ``events`` are the past ones
    (``area_id``, ``hour``, ``category``).  Each table has the mean ``score`` and
    summed ``expected_count`` of its slots, ``decile`` and ``level`` by rank among
    all of them, ``top``: its likeliest categories (3, 3 and 5) as an array of
    category, share, chance (score x share) and expected (expectation x share),
    and ``reasons``: the texts of the rules that hold against the medians of the
    table, five at most.  Shares are those of area and hour, of the area
    otherwise; where it has no events those of all areas.
    """
    columns = list(dict.fromkeys(c for c, _, _ in rules))
    out = {}
    for horizon, slots in scored.items():
        k, keys = TABLES[horizon]
        table = rolled_up(slots, horizon, columns)
        if rules:
            table = reason_codes(table, list(rules), most)
        tie = F.concat_ws("|", *[F.col(c).cast("string") for c in ("area_id", "date", "hour") if c in table.columns])
        table = decile(table.withColumn("_tie", tie).withColumn("_s", F.round("score", 12)), "_s", "_tie").drop("_tie", "_s")
        table = table.withColumn("level", level_from_decile(F.col("decile")))
        overall = top_share(events.withColumn("_all", F.lit(1)), ["_all"], k)
        filled = fill_topk(table, top_share(events, keys, k), overall, keys)
        named = lambda x: F.struct(x["category"].alias("category"), x["share"].alias("share"), (F.col("score") * x["share"]).alias("chance"), (F.col("expected_count") * x["share"]).alias("expected"))
        out[horizon] = filled.withColumn("top", F.transform("top", named))
    return out


def top_types(forecast: DataFrame, k: int, category: str = "category", value: str = "expected") -> DataFrame:
    """The k categories with the greatest totals: ``category``, ``total``.  Rows are one for each category, not a column."""
    sums = forecast.groupBy(category).agg(F.sum(value).cast("double").alias("total"))
    return sums.orderBy(F.desc("total"), category).limit(k)
