"""Projections, filters, typing."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import to_flag


def resolve_column(df: DataFrame, candidates: list[str], contains: str | None = None) -> str | None:
    """First candidate that the frame has, whatever the case; else the first column that matches ``contains``."""
    lower = {c.lower(): c for c in reversed(df.columns)}
    for c in candidates:
        if c.lower() in lower:
            return lower[c.lower()]
    return next((c for c in df.columns if contains and re.search(contains, c, re.I)), None)


def choose_densest(df: DataFrame, candidates: list[str]) -> DataFrame:
    """One row: ``column`` and ``n`` of the candidate with the most values (the first of those that tie)."""
    counts = df.agg(*[F.count(c).alias(c) for c in candidates])
    pairs = F.array(*[F.struct(F.col(c).alias("n"), F.lit(-i).alias("i"), F.lit(c).alias("c")) for i, c in enumerate(candidates)])
    return counts.select(F.array_max(pairs).alias("best")).select(F.col("best.c").alias("column"), F.col("best.n").alias("n"))


def alias_columns(df: DataFrame, names: dict[str, list[str]]) -> DataFrame:
    """Rename the first column found of each list of aliases to its canonical name."""
    found = {resolve_column(df, aliases): name for name, aliases in names.items()}
    return df.withColumnsRenamed({old: new for old, new in found.items() if old})


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Word characters only; names that then clash get ``_dupN``."""
    seen: dict[str, int] = {}
    names = []
    for c in df.columns:
        name = re.sub(r"\W+", "_", c).strip("_") or "col"
        seen[name] = seen.get(name, -1) + 1
        names.append(f"{name}_dup{seen[name]}" if seen[name] else name)
    return df.toDF(*names)


def coalesce_suffixes(df: DataFrame, names: list[str], suffixes: tuple[str, ...] = ("_x", "_y")) -> DataFrame:
    """``name`` from ``name``, ``name_x``, ``name_y``, the first that is not null."""
    for name in names:
        twins = [c for c in (name, *(name + s for s in suffixes)) if c in df.columns]
        if twins:
            df = df.withColumn(name, F.coalesce(*twins)).drop(*[c for c in twins if c != name])
    return df


def project(df: DataFrame, columns: list[str], fill_missing: bool = True, kind: str = "string") -> DataFrame:
    """Columns in order; missing ones as nulls, or left out."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(kind).alias(c) for c in columns if fill_missing or c in df.columns])


def drop_denied(df: DataFrame, exact: tuple[str, ...] = (), suffixes: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*[c for c in df.columns if c not in exact and not c.endswith(tuple(suffixes) or ("\0",))])


def drop_by_pattern(df: DataFrame, pattern: str) -> DataFrame:
    return df.select(*[c for c in df.columns if not re.search(pattern, c, re.I)])


def trim_overlap(main: DataFrame, addon: DataFrame, keys: list[str]) -> DataFrame:
    """``addon`` without the columns that ``main`` has, keys aside."""
    return addon.drop(*[c for c in addon.columns if c in main.columns and c not in keys])


def bbox_filter(df: DataFrame, south: float, west: float, north: float, east: float, lat: str = "lat", lon: str = "lon") -> DataFrame:
    return df.where(F.col(lat).between(south, north) & F.col(lon).between(west, east))


def drop_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.dropna(subset=[k for k in keys if k in df.columns])


def _latest(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.max(column).alias("_latest"))


def last_days(df: DataFrame, days: int, date: str = "date", anchor: str | None = None) -> DataFrame:
    """The ``days`` days up to the latest date of the data, or up to ``anchor`` (a literal date), which pushes down."""
    if anchor:
        return df.where(F.col(date).between(F.date_sub(F.lit(anchor).cast("date"), days - 1), F.lit(anchor).cast("date")))
    return df.crossJoin(F.broadcast(_latest(df, date))).where(F.col(date) > F.date_sub("_latest", days)).drop("_latest")


def last_hours(df: DataFrame, hours: int, ts: str = "ts") -> DataFrame:
    return df.crossJoin(F.broadcast(_latest(df, ts))).where(F.col(ts) >= F.col("_latest") - F.expr(f"INTERVAL {hours} HOURS")).drop("_latest")


def adaptive_window(df: DataFrame, steps: list[int], min_positive: int, date: str = "date", label: str = "label") -> DataFrame:
    """The shortest of the trailing windows (days) that has enough positives, else the longest."""
    latest = df.crossJoin(F.broadcast(_latest(df, date)))
    counts = latest.agg(F.max("_latest").alias("_latest"), *[F.count_if((F.col(label) > 0) & (F.col(date) > F.date_sub("_latest", n))).alias(f"_{n}") for n in steps])
    days = F.coalesce(*[F.when(F.col(f"_{n}") >= min_positive, n) for n in steps], F.lit(steps[-1]))
    return df.crossJoin(F.broadcast(counts.select("_latest", days.alias("_days")))).where(F.datediff("_latest", date) < F.col("_days")).drop("_latest", "_days")


def parse_key_date(col: Column) -> Column:
    """Timestamp of ``YYYYMMDD`` or ``YYYYMMDDHH``, with any separators."""
    digits = F.regexp_replace(col.cast("string"), r"[^0-9]", "")
    return F.when(F.length(digits) == 8, F.try_to_timestamp(digits, F.lit("yyyyMMdd"))).when(F.length(digits) == 10, F.try_to_timestamp(digits, F.lit("yyyyMMddHH")))


def normalize_date(df: DataFrame, out: str = "date") -> DataFrame:
    """A date from ``datetime``, ``date`` or year, month and day columns, whichever there is; null if it can't be read."""
    source = resolve_column(df, ["datetime", "date", "day_date"])
    if source:
        return df.withColumn(out, F.to_date(F.coalesce(F.try_to_timestamp(F.col(source).cast("string")), parse_key_date(F.col(source)))))
    y, m, d = (F.col(resolve_column(df, [n])).try_cast("int") for n in ("year", "month", "day"))
    text = F.concat_ws("-", F.lpad(y.cast("string"), 4, "0"), F.lpad(m.cast("string"), 2, "0"), F.lpad(d.cast("string"), 2, "0"))
    return df.withColumn(out, F.to_date(F.try_to_timestamp(text, F.lit("yyyy-MM-dd"))))


def ensure_time_keys(df: DataFrame) -> DataFrame:
    """``date``, ``hour`` and ``hr_key`` from a timestamp, a date with an hour, an hour label, or a bin."""
    from ..functions.keys import hour_key, parse_hour_label

    ts = resolve_column(df, ["datetime", "ts", "event_ts"])
    if ts:
        df = df.withColumns({"date": F.to_date(ts), "hour": F.hour(ts)})
    else:
        hour = resolve_column(df, ["hour", "event_hour"])
        label = resolve_column(df, ["hour_range"])
        key = resolve_column(df, ["hr_key"])
        value = F.col(hour).cast("int") if hour else parse_hour_label(label) if label else F.col(key).cast("int")
        df = df.withColumns({"date": F.to_date("date"), "hour": value})
    return df.withColumn("hr_key", hour_key("hour"))


def profile_columns(df: DataFrame, share: float = 0.8) -> DataFrame:
    """For each column: ``column``, ``n``, ``numeric_share``, ``label_share`` (``Qn`` labels), ``kind``; one pass."""
    text = {c: F.col(c).cast("string") for c in df.columns}
    wide = df.agg(*[F.struct(F.count(t).alias("n"), F.avg(F.when(t.isNotNull(), t.try_cast("double").isNotNull().cast("double"))).alias("numeric_share"), F.avg(F.when(t.isNotNull(), t.rlike(r"^\s*[Qq][0-9]").cast("double"))).alias("label_share")).alias(c) for c, t in text.items()])
    long = wide.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`.n").alias("n"), F.col(f"`{c}`.numeric_share").alias("numeric_share"), F.col(f"`{c}`.label_share").alias("label_share")) for c in df.columns])).alias("x")).select("x.*")
    return long.withColumn("kind", F.when(F.col("label_share") > 0.6, "categorical").when(F.col("numeric_share") >= share, "numeric").otherwise("categorical"))


def feature_lists(df: DataFrame, exclude: tuple[str, ...] = ()) -> dict[str, list[str]]:
    """Columns by kind: ``count`` (numeric, named like a count), ``numeric``, ``categorical``."""
    out: dict[str, list[str]] = {"count": [], "numeric": [], "categorical": []}
    for c, kind in df.dtypes:
        if c in exclude:
            continue
        numeric = kind in ("int", "bigint", "smallint", "tinyint", "float", "double") or kind.startswith("decimal")
        out["count" if numeric and re.search(r"count|_n$|^n_|sum", c, re.I) else "numeric" if numeric else "categorical"].append(c)
    return out


def constant_columns(df: DataFrame) -> DataFrame:
    """``column`` and ``n_distinct`` of the columns with at most one value; one pass that compares the least and the greatest."""
    wide = df.agg(*[F.struct(F.min(F.col(c).cast("string")).alias("lo"), F.max(F.col(c).cast("string")).alias("hi")).alias(c) for c in df.columns])
    long = wide.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`.lo").alias("lo"), F.col(f"`{c}`.hi").alias("hi")) for c in df.columns])).alias("x")).select("x.*")
    return long.where(F.col("lo").eqNullSafe(F.col("hi"))).select("column", F.when(F.col("lo").isNull(), 0).otherwise(1).alias("n_distinct"))


def drop_constant(df: DataFrame) -> DataFrame:
    """Without constant and all-null columns; the driver sees one row for each such column, by a job that runs while the plan is made."""
    return df.drop(*[r.column for r in constant_columns(df).collect()])


def fill_typed(df: DataFrame, number: float = 0, text: str = "unknown") -> DataFrame:
    lists = feature_lists(df)
    return df.fillna(number, subset=lists["count"] + lists["numeric"]).fillna(text, subset=[c for c, k in df.dtypes if k == "string"])


def stamp(df: DataFrame, **columns) -> DataFrame:
    return df.withColumns({k: F.lit(v) for k, v in columns.items()})


def select_features(df: DataFrame, chosen: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*dict.fromkeys(c for c in (*keep, *chosen) if c in df.columns))


def flags(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: to_flag(F.col(c)) for c in columns})


def compact_types(df: DataFrame) -> DataFrame:
    """Integers in the narrowest type that holds their values; the driver sees one row of bounds, by a job that runs while the plan is made."""
    whole = [c for c, k in df.dtypes if k in ("int", "bigint", "smallint")]
    if not whole:
        return df
    row = df.agg(*[F.min(c).alias(f"{c}_lo") for c in whole], *[F.max(c).alias(f"{c}_hi") for c in whole]).first()
    for c in whole:
        lo, hi = row[f"{c}_lo"], row[f"{c}_hi"]
        if lo is not None:
            kind = next(k for k, bits in (("tinyint", 7), ("smallint", 15), ("int", 31), ("bigint", 63)) if -(1 << bits) <= lo and hi < 1 << bits)
            df = df.withColumn(c, F.col(c).cast(kind))
    return df


def dedupe(df: DataFrame, keys: list[str], order: list[str], keep: str = "last") -> DataFrame:
    """One row for each key, the first or last by ``order``; ties need more order columns."""
    by = [F.desc(c) if keep == "last" else F.asc(c) for c in order]
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*by))).where("_n = 1").drop("_n")
