"""Exact copies of texts: frequent digests are settled by broadcast, the others by an ordinary shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import save

#: Counters of the Misra-Gries summary.  Spark's items sketch keeps a map of the next power of two above 4/3 of them
#: and errs by at most 3.5 / map of all rows, so whatever holds over 7 / 16,384 of the rows (0.043%) is among its items.
COUNTERS = 8192
#: At most so many winners are broadcast, about 200 bytes each.
WINNERS = 4096


def digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row: ``id``, ``text_sha256``, ``size`` and ``check`` (its length and another hash), ``row`` (a number of its own).

    This is the only pass over the texts; it is written to the shared folder, about 60 bytes a row.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = df.select(F.col(id_col).alias("id"), text.alias("t"))
    rows = rows.select("id", F.sha2("t", 256).alias("text_sha256"), F.octet_length("t").alias("size"), F.xxhash64("t").alias("check"), F.monotonically_increasing_id().alias("row"))
    return save(rows, "exact-digests")


def frequent(rows: DataFrame, counters: int = COUNTERS, most: int = WINNERS) -> DataFrame:
    """The winners among the digests: counted exactly, ``group_size``, ``keep_id`` and ``keep_row`` of each; at most ``most`` rows.

    A Misra-Gries summary is made in each task and merged; what it names is only
    a guess, so every candidate is counted again over all rows, and wins if it
    occurs more than once and its rows agree in length and in a second hash.
    """
    summary = rows.agg(F.expr(f"approx_top_k(text_sha256, {most}, {counters})").alias("top"))
    names = summary.select(F.explode("top.item").alias("text_sha256"))
    mine = rows.join(F.broadcast(names), "text_sha256", "left_semi")  # at most ``most`` names
    same = (F.min("size") == F.max("size")) & (F.min("check") == F.max("check"))
    won = mine.groupBy("text_sha256").agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("id", "row")).alias("keep"), same.alias("same"))
    return won.where("same and group_size > 1").select("text_sha256", "group_size", F.col("keep.id").alias("keep_id"), F.col("keep.row").alias("keep_row"))


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS, most: int = WINNERS) -> DataFrame:
    """One row per row of ``df``: ``id_col``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when their bytes are.  Of equal texts the row with the
    largest id stays (null is the smallest); of rows that share that id one
    stays.  Rows of frequent digests are marked where they lie, by a broadcast of
    at most ``most`` winners; only the digests of the others are shuffled, and
    none of those can hold more than about 0.043% of the rows (for the default
    ``counters``, as far as ``most`` reaches), so no group of copies meets in one
    task.  Texts are never shuffled.

    Null texts count as empty; empty texts are copies of each other.  Texts are
    hashed whole, however long.  Other columns are ignored, whatever their
    names.  An empty table gives an empty result.
    """
    rows = digests(df, id_col, text_col)
    winners = save(frequent(rows, counters, most), "exact-winners")
    hot = rows.join(F.broadcast(winners), "text_sha256").select("id", "row", "text_sha256", "group_size", "keep_id", "keep_row")
    group = Window.partitionBy("text_sha256", "size", "check")
    best = F.max(F.struct("id", "row")).over(group)
    cold = rows.join(F.broadcast(winners.select("text_sha256")), "text_sha256", "left_anti")
    cold = cold.select("id", "row", "text_sha256", F.count(F.lit(1)).over(group).alias("group_size"), best.alias("keep")).select("id", "row", "text_sha256", "group_size", F.col("keep.id").alias("keep_id"), F.col("keep.row").alias("keep_row"))
    return hot.unionByName(cold).select(F.col("id").alias(id_col), "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256")


def without_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS, most: int = WINNERS) -> DataFrame:
    """The rows of ``df`` that :func:`exact_dedup` keeps, with all their columns, whatever their names.

    Of rows that share id and text one stays, whichever it is where their other columns differ.
    """
    names = [f"c{k}" for k in range(len(df.columns))]  # no name can clash
    numbered, id_, text = df.toDF(*names), names[df.columns.index(id_col)], names[df.columns.index(text_col)]
    decided = exact_dedup(numbered, id_, text, counters, most).select(F.col(id_).alias("_id"), F.col("text_sha256").alias("_digest"), "kept")
    stays = save(decided.groupBy("_id", "_digest").agg(F.bool_or("kept").alias("kept"), F.count(F.lit(1)).alias("n")).where("kept").drop("kept"), "exact-kept")
    rows = numbered.withColumns({"_id": F.col(id_), "_digest": F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary"), 256)}).alias("r")
    match = F.expr("r._id <=> s._id and r._digest = s._digest")
    once = rows.join(stays.where("n = 1").alias("s"), match, "left_semi")
    more = rows.join(stays.where("n > 1").alias("s"), match, "left_semi").dropDuplicates(["_id", "_digest"])
    return once.unionByName(more).select(*names).toDF(*df.columns)
