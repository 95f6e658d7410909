"""Counts, shares, modes, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import hour_key
from ..functions.numbers import percent_text, title
from .scan import quantiles


def call_summary(calls: DataFrame, area: str = "area_id", ts: str = "ts") -> DataFrame:
    """Calls by area, date and 3-hour bin, with the day's total."""
    bins = calls.groupBy(area, F.to_date(ts).alias("date"), hour_key(F.hour(ts)).alias("hr_key")).agg(F.count(F.lit(1)).alias("bin_count"))
    return bins.withColumn("day_count", F.sum("bin_count").over(Window.partitionBy(area, "date")))


def daily_counts(df: DataFrame, area: str = "area_id", date: str = "date", count: str | None = None) -> DataFrame:
    """Rows, or the sum of an existing count, by area and date."""
    return df.groupBy(area, date).agg((F.sum(count) if count else F.count(F.lit(1))).alias("n"))


def rollup_by_name(df: DataFrame, keys: list[str]) -> DataFrame:
    """Columns named like counts are summed, like distances minimised, others averaged."""
    aggs = []
    for c, kind in df.dtypes:
        if c in keys or kind == "string":
            continue
        f = F.sum if "count" in c or "within" in c else F.min if "distance" in c else F.avg
        aggs.append(f(c).alias(c))
    return df.groupBy(*keys).agg(*aggs)


def mode_or(df: DataFrame, keys: list[str], column: str, default: str) -> DataFrame:
    """The most frequent value (the least of those that tie), or the default."""
    counts = df.where(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count(F.lit(1)).alias("n"))
    best = counts.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("n"), column))).where("_r = 1")
    return df.select(*keys).distinct().join(best.select(*keys, column), keys, "left").withColumn(column, F.coalesce(column, F.lit(default)))


def category_share(df: DataFrame, keys: list[str], category: str = "category") -> DataFrame:
    counts = df.groupBy(*keys, category).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(*keys)))


def category_mix(df: DataFrame, keys: list[str], k: int = 3, category: str = "category") -> DataFrame:
    """The k largest shares as text: ``Theft(47%), ...``."""
    ranked = category_share(df, keys, category).withColumn("r", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("n"), category))).where(F.col("r") <= k)
    text = F.concat(title(F.col(category)), F.lit("("), percent_text(F.col("share")), F.lit(")"))
    return ranked.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", text.alias("t")))), lambda x: x["t"]), ", ").alias("category_mix"))


def seasonal_baseline(df: DataFrame, score: str, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(score).alias("mean"), F.percentile(score, 0.9).alias("p90"), F.count(score).alias("n"))


def report_by(df: DataFrame, keys: list[str], score: str, label: str, extras: list[str] = ()) -> DataFrame:
    aggs = [F.avg(score).alias("mean_score"), F.sum(score).alias("sum_score"), F.count(F.lit(1)).alias("n"), F.sum(label).alias("positives")]
    return df.groupBy(*keys).agg(*aggs, *[F.avg(c).alias(f"mean_{c}") for c in extras]).withColumn("rate", F.try_divide("positives", "n"))


def report_by_dims(df: DataFrame, dims: list[str], score: str) -> DataFrame:
    """The same measure over several single dimensions, stacked: ``dimension``, ``member``, ``n``, ``mean_score``."""
    view = df.select(*[F.col(d).cast("string").alias(d) for d in dims], F.col(score).alias("score"))
    sets = view.groupingSets([[F.col(d)] for d in dims], *[F.col(d) for d in dims]).agg(F.count(F.lit(1)).alias("n"), F.avg("score").alias("mean_score"), *[F.grouping(d).alias(f"_{d}") for d in dims])
    pick = lambda value: F.coalesce(*[F.when(F.col(f"_{d}") == 0, value(d)) for d in dims])
    return sets.select(pick(F.lit).alias("dimension"), pick(F.col).alias("member"), "n", "mean_score")


def top_categories(df: DataFrame, k: int = 3, category: str = "category", hour: str = "hour", date: str = "date") -> DataFrame:
    """The k commonest categories overall (hour null) and for each hour, with share and the period."""
    view = df.select(category, hour, date)
    counts = view.groupingSets([[F.col(category)], [F.col(category), F.col(hour)]], F.col(category), F.col(hour)).agg(F.count(F.lit(1)).alias("n"), F.grouping(hour).alias("g"))
    w = Window.partitionBy("g", hour)
    ranked = counts.withColumn("share", F.col("n") / F.sum("n").over(w)).withColumn("rank", F.row_number().over(w.orderBy(F.desc("n"), category))).where(F.col("rank") <= k)
    return ranked.crossJoin(F.broadcast(view.agg(F.min(date).alias("first_date"), F.max(date).alias("last_date")))).drop("g")


def daily_from_hourly(df: DataFrame, keys: list[str], score: str = "score") -> DataFrame:
    """Chance of at least one event in the day, and expected number, from hourly chances."""
    return df.groupBy(*keys).agg((1 - F.product(1 - F.col(score))).alias("any_score"), F.sum(score).alias("sum_score"), F.avg(score).alias("mean_score"))


def rollup_forecast(df: DataFrame, keys: list[str], score: str, count: str, category: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(score).alias("mean_score"), F.sum(count).alias("sum_count"), F.max(score).alias("max_score"), F.mode(category, True).alias("top_category"))


def area_profile(df: DataFrame, numeric: list[str], categorical: list[str], area: str = "area_id") -> DataFrame:
    return df.groupBy(area).agg(*[F.avg(c).alias(c) for c in numeric], *[F.mode(c, True).alias(c) for c in categorical])


def area_label(df: DataFrame, label: str, area: str = "area_id") -> DataFrame:
    """1 if the area ever had a positive row.  It looks at the whole history, so it is not a training label."""
    return df.groupBy(area).agg(F.max(label).alias(label))


def value_distribution(df: DataFrame, column: str) -> DataFrame:
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.crossJoin(F.broadcast(counts.agg(F.sum("n").alias("_t")))).withColumn("percent", 100.0 * F.col("n") / F.col("_t")).drop("_t")


def group_rare(df: DataFrame, column: str, min_share: float = 0.01, min_count: int = 200, other: str = "Other") -> DataFrame:
    """Values under the share or the count become ``other``, in ``<column>_grouped``."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("_t"))
    kept = counts.crossJoin(F.broadcast(total)).where((F.col("_n") >= min_count) & (F.col("_n") >= min_share * F.col("_t"))).select(column, F.lit(True).alias("_keep"))
    return df.join(kept, column, "left").withColumn(f"{column}_grouped", F.when(F.col("_keep"), F.col(column)).otherwise(F.lit(other))).drop("_keep")


def impute(df: DataFrame, numeric: list[str], categorical: list[str], counts: list[str] = ()) -> DataFrame:
    """Medians, modes (the least of the commonest values) and zeros for nulls; neither gathers a column's values in one task."""
    out = df
    if numeric:
        out = out.crossJoin(F.broadcast(quantiles(df, {c: [0.5] for c in numeric}).select(*[F.get(c, F.lit(0)).alias(f"_{c}") for c in numeric])))
    for c in categorical:
        seen = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
        out = out.crossJoin(F.broadcast(seen.agg(F.min(F.struct((-F.col("_n")).alias("_m"), F.col(c)))[c].alias(f"_{c}"))))
    out = out.withColumns({c: F.coalesce(F.col(c), F.col(f"_{c}")) for c in (*numeric, *categorical)})
    return out.drop(*[f"_{c}" for c in (*numeric, *categorical)]).fillna(0, subset=list(counts))


def profile(df: DataFrame, id_col: str, date: str, recent: str, days: int = 45) -> DataFrame:
    """One row: rows, dates, repeated ids, and null rate of a column over the last days."""
    latest = df.crossJoin(F.broadcast(df.agg(F.max(date).alias("_hi"))))
    new = F.col(date) > F.date_sub("_hi", days)
    return latest.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"), F.min(date).alias("first_date"), F.max(date).alias("last_date"), F.countDistinct(date).alias("n_dates"), (F.count(id_col) - F.countDistinct(id_col)).alias("repeated_ids"), F.avg(F.when(new, F.col(recent).isNull().cast("double"))).alias("recent_null_rate"))


def externals_score(df: DataFrame, by_category: dict[str, list[str]], category: str = "category") -> DataFrame:
    """Mean of the columns that matter for the row's category, nulls aside."""
    case = None
    for name, columns in by_category.items():
        values = F.filter(F.array(*[F.col(c).cast("double") for c in columns]), lambda x: x.isNotNull())
        mean = F.try_divide(F.aggregate(values, F.lit(0.0), lambda a, x: a + x), F.size(values))
        case = F.when(F.col(category) == name, mean) if case is None else case.when(F.col(category) == name, mean)
    return df.withColumn("externals_score", case)
