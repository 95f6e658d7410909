"""Counts, dedupe and upserts over streams.  Each takes a streaming or a batch frame with ``ts`` as a timestamp."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.project import dedupe
from ..operators.topk import upsert


def tumbling_counts(events: DataFrame, window: str = "3 hours", late: str = "1 hour", area: str = "area_id") -> DataFrame:
    """Events by area and window.  A window closes, and its state goes, when the watermark passes its end; rows that come later are dropped."""
    counts = events.withWatermark("ts", late).groupBy(area, F.window("ts", window)).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(area, F.col("window.start").alias("start"), F.col("window.end").alias("end"), "n")


def sliding_counts(events: DataFrame, window: str = "6 hours", slide: str = "1 hour", late: str = "1 hour", area: str = "area_id") -> DataFrame:
    """Events by area and overlapping window; a late row still counts in those of its windows that are open."""
    counts = events.withWatermark("ts", late).groupBy(area, F.window("ts", window, slide)).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(area, F.col("window.start").alias("start"), F.col("window.end").alias("end"), "n")


def once_by_id(events: DataFrame, key: str = "event_id", late: str = "1 hour") -> DataFrame:
    """The first arrival of each id; repeats that come within ``late`` of it, across restarts, are dropped."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark([key])


def replay(batches: list[DataFrame], source: str, start) -> None:
    """Land batches one after the other in the folder ``source`` and let a stream take up each before the next.

    ``start()`` begins a query over the folder with ``availableNow`` and its own
    checkpoint, so every batch is a restart.  At the end it is started once more
    with nothing to read.
    """
    for batch in batches:
        batch.write.mode("append").parquet(source)
        start().awaitTermination()
    start().awaitTermination()


def append_to(stream: DataFrame, path: str, checkpoint: str):
    """Write a stream's final rows: those that no later row can change, each once, whatever restarts there are."""
    return stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(path)


def upsert_stream(stream: DataFrame, base_path: str, keys: list[str], order: list[str], checkpoint: str, buckets: int = 64):
    """A writer that merges each micro-batch into a table, the latest row of each key by ``order``.

    The table lies in ``buckets`` folders by key.  A batch reads and writes only
    those that its keys fall into, in a folder of its own number.  The version is
    made by its manifest, a small file that names the folder of every bucket and
    appears whole by a rename: readers see the version before or after, and a
    batch that comes again after that is done already.  The last two manifests
    stay, for readers at work; what only older ones name is deleted.  So a
    batch's cost does not grow with the table's age, and there are never more
    version folders than buckets and two.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        known = _manifests(spark, base_path)
        if number in known:
            return
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        batch = batch.persist()
        try:
            touched = [r.b for r in batch.select(bucket.alias("b")).distinct().collect()]  # at most ``buckets``
            if not touched:
                return
            now = _manifest(spark, base_path, max(known)) if known else {}
            before = _read(spark, base_path, {b: v for b, v in now.items() if b in touched})
            merged = dedupe(batch, keys, order) if before is None else upsert(before, batch, keys, order)
            merged.withColumn("_bucket", bucket).repartition("_bucket").write.partitionBy("_bucket").mode("overwrite").parquet(f"{base_path}/version={number}")
            _commit(spark, base_path, number, now | dict.fromkeys(touched, number))
        finally:
            batch.unpersist()
        _vacuum(spark, base_path, [*known, number])

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)


def _path(spark, name: str):
    """A path and its file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _manifests(spark, base_path: str) -> list[int]:
    """Numbers of the versions that have a manifest, ascending; at most three lie there at any time."""
    path, fs = _path(spark, f"{base_path}/manifests")
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def _manifest(spark, base_path: str, number: int) -> dict[int, int]:
    """Of each bucket, the version in whose folder it lies."""
    path, fs = _path(spark, f"{base_path}/manifests/{number:020d}.json")
    stream = fs.open(path)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return {int(b): v for b, v in json.loads(text).items()}


def _commit(spark, base_path: str, number: int, buckets: dict[int, int]) -> None:
    final, fs = _path(spark, f"{base_path}/manifests/{number:020d}.json")
    draft, _ = _path(spark, f"{base_path}/manifests/_{number:020d}.draft")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(json.dumps(buckets, sort_keys=True).encode()))
    finally:
        out.close()
    if not fs.rename(draft, final):
        raise OSError(f"could not commit version {number} of {base_path}")


def _vacuum(spark, base_path: str, numbers: list[int]) -> None:
    """Delete what only manifests before the last two name, and then those manifests."""
    *old, before, last = [None, *numbers] if len(numbers) == 1 else numbers
    kept = {(v, b) for n in (before, last) if n is not None for b, v in _manifest(spark, base_path, n).items()}
    for n in old:
        gone = {(v, b) for b, v in _manifest(spark, base_path, n).items()} - kept
        for v in {v for v, _ in gone}:
            whole = all(v != w for w, _ in kept)
            for name in [f"version={v}"] if whole else [f"version={v}/_bucket={b}" for w, b in gone if w == v]:
                path, fs = _path(spark, f"{base_path}/{name}")
                fs.delete(path, True)
        path, fs = _path(spark, f"{base_path}/manifests/{n:020d}.json")
        fs.delete(path, False)


def _read(spark, base_path: str, versions: dict[int, int]) -> DataFrame | None:
    paths = [f"{base_path}/version={v}/_bucket={b}" for b, v in sorted(versions.items())]
    return spark.read.parquet(*paths) if paths else None


def current(spark, base_path: str, below: int | None = None) -> DataFrame | None:
    """The last version (below a batch number) of an upserted table, or None."""
    numbers = [n for n in _manifests(spark, base_path) if below is None or n < below]
    return _read(spark, base_path, _manifest(spark, base_path, numbers[-1])) if numbers else None
