"""Top-k lists and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .project import dedupe, last_days
from .scan import scan
from .windows import top_k_per_group


def top_k(df: DataFrame, order: list, k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def top_slots(df: DataFrame, k: int, score: str = "score", date: str = "date", slot: str = "hour", tie: str = "area_id") -> DataFrame:
    """The k best areas of each hour slot on the latest date."""
    return top_k_per_group(last_days(df, 1, date), [slot], [F.desc(score), F.asc(tie)], k)


def top_categories_wide(df: DataFrame, keys: list[str], k: int = 3, category: str = "category", missing: str = "") -> DataFrame:
    """The k commonest categories of each key as columns ``top1..k`` with their counts, padded."""
    counts = df.groupBy(*keys, category).agg(F.count(F.lit(1)).alias("n"))
    ranked = top_k_per_group(counts, keys, [F.desc("n"), F.asc(category)], k)
    wide = [F.coalesce(F.max(F.when(F.col("rank") == i, F.col(category))), F.lit(missing)).alias(f"top{i}") for i in range(1, k + 1)]
    return ranked.groupBy(*keys).agg(*wide, *[F.coalesce(F.max(F.when(F.col("rank") == i, F.col("n"))), F.lit(0)).alias(f"top{i}_n") for i in range(1, k + 1)])


def pivot_ranked(df: DataFrame, keys: list[str], value: str, k: int = 3, rank: str = "rank") -> DataFrame:
    wide = df.groupBy(*keys).pivot(rank, list(range(1, k + 1))).agg(F.first(value))
    return wide.withColumnsRenamed({str(i): f"{value}_{i}" for i in range(1, k + 1)})


def top_columns(df: DataFrame, columns: list[str], k: int) -> DataFrame:
    """The k columns with the greatest totals: ``column``, ``total``."""
    sums = df.agg(*[F.sum(c).cast("double").alias(c) for c in columns])
    return sums.unpivot([], columns, "column", "total").orderBy(F.desc("total"), "column").limit(k)


def top_share(df: DataFrame, keys: list[str], k: int = 3, category: str = "category") -> DataFrame:
    """The k largest shares of each key packed as an array of (category, share)."""
    counts = df.groupBy(*keys, category).agg(F.count(F.lit(1)).alias("n")).withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(*keys)))
    ranked = top_k_per_group(counts, keys, [F.desc("n"), F.asc(category)], k)
    return ranked.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", category, "share"))), lambda x: F.struct(x[category].alias("category"), x["share"].alias("share"))).alias("top"))


def fill_topk(df: DataFrame, shares: DataFrame, overall: DataFrame, keys: list[str]) -> DataFrame:
    """Packed shares of the key, else those of all rows (``overall``, one row with ``top``)."""
    return df.join(shares, keys, "left").crossJoin(F.broadcast(overall.select(F.col("top").alias("_o")))).withColumn("top", F.coalesce("top", "_o")).drop("_o")


def sample_n(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """At most n rows, the same ones each time."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(n)


def union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def upsert(base: DataFrame, inc: DataFrame, keys: list[str], order: list[str], date: str | None = None, retain_days: int | None = None) -> DataFrame:
    """Both, the latest row of each key by ``order``, and the last days only if asked."""
    merged = dedupe(union_all([base, inc]), keys, order, "last")
    return last_days(merged, retain_days, date) if retain_days else merged


def overlap(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b).agg(F.count(F.lit(1)).alias("overlap"))


def vocab(frames: list[DataFrame], column: str) -> DataFrame:
    return union_all([f.select(F.col(column).alias("value")) for f in frames]).where("value is not null").distinct()


def assign_ids(values: DataFrame, existing: DataFrame) -> DataFrame:
    """Ids of a vocabulary (``value``): existing ones stay, new values follow the greatest in order, numbered in ranges."""
    new = scan(values.join(existing, "value", "left_anti"), [], ["value"], {"_n": (F.lit(1), "sum")})
    start = existing.agg(F.coalesce(F.max("id"), F.lit(-1)).alias("_m"))
    return existing.select("value", F.col("id").cast("long").alias("id")).unionByName(new.crossJoin(F.broadcast(start)).select("value", (F.col("_m") + F.col("_n")).cast("long").alias("id")))
