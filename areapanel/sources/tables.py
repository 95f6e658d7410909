"""Tables in and out: CSV, Parquet, GeoJSON, stop feeds, landed pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GEOMETRY = "struct<type:string,coordinates:string>"


def read_table(spark: SparkSession, path: str, schema: str | None = None, columns: list[str] | None = None) -> DataFrame:
    """CSV (also gzipped) or Parquet by suffix; only ``columns`` that exist are read.

    Without a schema CSV columns are strings, so keys keep their leading zeros.
    """
    if path.rstrip("/").endswith((".csv", ".csv.gz", ".txt")):
        reader = spark.read.option("header", True)
        df = (reader.schema(schema) if schema else reader).csv(path)
    else:
        df = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    return df.select(*[c for c in columns if c in df.columns]) if columns else df


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_first(spark: SparkSession, paths: list[str], newest: bool = False, **options) -> DataFrame:
    """The first of the paths that exists, or the one changed last."""
    found = [p for p in paths if exists(spark, p)]
    if not found:
        raise FileNotFoundError(f"none of {paths}")

    def changed(path: str) -> int:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).getModificationTime()

    return read_table(spark, max(found, key=changed) if newest else found[0], **options)


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """Features of a FeatureCollection or of lines of features: ``properties`` (a map), ``geometry_type``, ``coordinates`` (JSON)."""
    feature = "struct<properties:map<string,string>,geometry:" + GEOMETRY + ">"
    raw = spark.read.text(path, wholetext=True)
    whole = F.from_json("value", f"struct<features:array<{feature}>>")["features"]
    lines = F.transform(F.filter(F.split("value", "\n"), lambda x: F.trim(x) != ""), lambda x: F.from_json(x, feature))
    f = raw.select(F.explode(F.coalesce(whole, lines)).alias("f"))
    return f.select("f.properties", F.col("f.geometry.type").alias("geometry_type"), F.col("f.geometry.coordinates").alias("coordinates"))


def polygon_edges(features: DataFrame, key: str) -> DataFrame:
    """Edge table of polygons and multipolygons: ``area_id, ring, seq, x1, y1, x2, y2``."""
    nested = F.when(F.col("geometry_type") == "Polygon", F.array(F.from_json("coordinates", "array<array<array<double>>>"))).otherwise(F.from_json("coordinates", "array<array<array<array<double>>>>"))
    rings = features.where("geometry_type in ('Polygon', 'MultiPolygon')").select(F.element_at("properties", key).alias("area_id"), F.posexplode(F.flatten(nested)).alias("ring", "p"))
    steps = rings.select("area_id", "ring", "p", F.explode(F.sequence(F.lit(0), F.size("p") - 2)).alias("seq"))
    return steps.select("area_id", "ring", "seq", F.col("p")[F.col("seq")][0].alias("x1"), F.col("p")[F.col("seq")][1].alias("y1"), F.col("p")[F.col("seq") + 1][0].alias("x2"), F.col("p")[F.col("seq") + 1][1].alias("y2"))


def read_gtfs_stops(spark: SparkSession, folder: str) -> DataFrame:
    """``stops.txt`` of an unpacked feed, with repaired headers."""
    df = spark.read.option("header", True).csv(f"{folder.rstrip('/')}/stops.txt")
    df = df.toDF(*[c.replace("﻿", "").strip().strip('"').lower() for c in df.columns])
    return df.withColumns({c: F.col(c).try_cast("double") for c in ("stop_lat", "stop_lon") if c in df.columns})


def csv_to_parquet(spark: SparkSession, src: str, dst: str, compression: str = "zstd", infer: bool = True, row_group_bytes: int = 128 << 20) -> None:
    """A folder of CSV files to Parquet; rows that can't be parsed keep what can."""
    df = spark.read.option("header", True).option("mode", "PERMISSIVE").option("inferSchema", infer).csv(src)
    df.write.mode("overwrite").option("compression", compression).option("parquet.block.size", row_group_bytes).parquet(dst)


def write_panel(df: DataFrame, path: str, date: str = "date", mode: str = "skip") -> None:
    """Months as partitions; ``skip`` leaves months that exist, ``overwrite`` replaces only the months of the data."""
    spark = df.sparkSession
    out = df.withColumn("year_month", F.date_format(date, "yyyy-MM"))
    if mode == "skip" and exists(spark, path):
        there = spark.read.parquet(path).select("year_month").distinct()
        out = out.join(there, "year_month", "left_anti")
        out.write.mode("append").partitionBy("year_month").parquet(path)
    else:
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year_month").parquet(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Spark's commit protocol makes the files appear at once, or not at all."""
    writer = df.write.mode(mode)
    (writer.option("header", True) if fmt == "csv" else writer).format(fmt).save(path)


def write_json_row(df: DataFrame, path: str) -> None:
    """A small side output as one JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def write_report(tables: dict[str, DataFrame], path: str, fmt: str = "parquet") -> None:
    for name, df in tables.items():
        write_table(df, f"{path.rstrip('/')}/{name}", fmt)


def write_manifest(spark: SparkSession, rows: list[dict], path: str) -> DataFrame:
    """Append a run's rows to the manifest; returns all of it, columns aligned by name."""
    new = spark.createDataFrame(rows)
    new.write.mode("append").json(path)
    return spark.read.json(path)


def read_landing(spark: SparkSession, folder: str, fmt: str = "json") -> DataFrame:
    """Landed pages (arrays or lines) as one table, with the file each row came from."""
    df = spark.read.option("multiLine", fmt == "json").json(folder) if fmt in ("json", "jsonl") else spark.read.option("header", True).csv(folder)
    return df.withColumn("source_file", F.col("_metadata.file_name"))
