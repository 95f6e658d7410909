"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import drop_saved, new_path, run_folder, save, shared_dir  # noqa: F401


def finite_vector(col) -> "F.Column":
    """True where an array is not null, not empty and holds finite numbers only."""
    bad = F.exists(col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return col.isNotNull() & (F.size(col) > 0) & F.coalesce(~bad, F.lit(False))


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Smallest vertex that each vertex reaches: columns ``id``, ``component_id``.

    ``edges`` holds undirected pairs of longs (self-loops, repeats and either
    direction allowed; rows with a null end are ignored).  Vertices that no edge
    names are not returned.  Every round takes the least label among the
    neighbours and then the label of that label, so a chain of length n needs
    about log n rounds.  Neighbours are only ever aggregated by ``min``, which
    combines before the shuffle, so a vertex with a third of all edges does no
    harm.  Each round is written to the shared folder.
    """
    pairs = edges.select(F.col(src).cast("long").alias("u"), F.col(dst).cast("long").alias("v")).where("u is not null and v is not null")
    both = save(pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "cc-edges")
    labels = save(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("l")), "cc-labels")
    while True:
        near = both.join(labels.select(F.col("u").alias("v"), "l"), "v").groupBy("u").agg(F.min("l").alias("m"))
        step = labels.join(near, "u").select("u", F.least("l", "m").alias("n"), "l")
        jump = step.join(labels.select(F.col("u").alias("n"), F.col("l").alias("j")), "n")
        new = save(jump.select("u", F.least("n", "j").alias("n"), "l"), "cc-labels")
        changed = new.where("n <> l").limit(1).count()
        drop_saved(labels)
        labels = new.select("u", F.col("n").alias("l"))
        if not changed:
            drop_saved(both)
            return labels.select(F.col("u").alias("id"), F.col("l").alias("component_id"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
