"""Tables in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_RUNS: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and all executors share.

    The cluster names it in ``spark.checkpoint.dir``.  Only a session on one
    machine (tests, a laptop) may leave that unset; it gets a temporary folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = f"file://{tempfile.mkdtemp(prefix='areapanel-')}"
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def new_path(spark: SparkSession, name: str) -> str:
    return f"{_RUNS[-1] if _RUNS else shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and read it back.

    This cuts the lineage: what follows survives the loss of any executor and
    never recomputes ``df``.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_saved(*tables: DataFrame) -> None:
    """Delete the files of tables made by :func:`save` once nothing reads them any more."""
    for df in tables:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            _delete(df.sparkSession, folder)


@contextmanager
def run_folder(spark: SparkSession):
    """Everything saved inside the ``with`` block goes to one folder, deleted at its end.

    Results must be written elsewhere before that: frames that are made inside
    read from the folder.
    """
    path = new_path(spark, "run")
    _RUNS.append(path)
    try:
        yield path
    finally:
        _RUNS.remove(path)
        _delete(spark, path)
