"""Embedding near-dedup with randomised-rotation binary codes."""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, finite_vector, save

TILE = 2048
RECOMPUTE = 1 << 16


@lru_cache(maxsize=8)
def rotation(dim: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix, the same on every executor."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by the largest component first, so that squares stay finite."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def encode(x: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign codes of the rotated unit vectors, and their correction factors.

    The code stands for the unit vector ``s / sqrt(dim)`` with s the signs; the
    factor is its inner product with the rotated vector.
    """
    o = unit_rows(x) @ rotation(x.shape[1], seed)
    return np.packbits(o > 0, axis=1), np.abs(o).sum(axis=1) / math.sqrt(x.shape[1])


def estimate(codes: np.ndarray, factors: np.ndarray, rotated: np.ndarray) -> np.ndarray:
    """Unbiased estimates of the cosines between coded rows and rotated unit vectors."""
    dim = rotated.shape[1]
    signs = np.unpackbits(codes, axis=1, count=dim).astype(np.float32) * 2 - 1
    return (signs @ rotated.T.astype(np.float32)) / (factors[:, None] * math.sqrt(dim))


def lower_limit(factors: np.ndarray, dim: int, threshold: float, epsilon: float | None) -> np.ndarray:
    """Least estimate that a pair at ``threshold`` can have.

    With c the cosine and f the factor, the estimate is c plus an error of at
    most sqrt(1-c^2) * sqrt(1-f^2) / f, whatever the rotation.  ``epsilon``
    replaces this certain bound by ``epsilon`` standard deviations of the
    error under a random rotation, if that is less.
    """
    width = np.sqrt(np.maximum(0, 1 - factors**2)) / factors
    if epsilon is not None and dim > 1:
        width = np.minimum(width, epsilon * width / math.sqrt(dim - 1))
    return threshold - math.sqrt(max(0.0, 1 - threshold**2)) * width - 1e-4


def _merge(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    while True:
        least = np.minimum(labels[i], labels[j])
        if (labels[i] == least).all() and (labels[j] == least).all():
            return labels
        for side in (i, j):
            np.minimum.at(labels, labels[side], least)  # only the label's own row, to which its others follow
        while not (labels == (labels := labels[labels])).all():
            pass


def _cell(threshold: float, seed: int, epsilon: float | None):
    """Compare the rows of two blocks of one group (or of one block with itself)."""

    def compare(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        lo, hi = key[-2].as_py(), key[-1].as_py()
        block = t["block"].to_numpy()
        t = t.take(pa.array(np.argsort(block, kind="stable")))
        block, rep, copies = (t[c].to_numpy() for c in ("block", "rep", "copies"))
        x = t["vec"].combine_chunks().flatten().to_numpy().reshape(len(rep), -1)
        unit = unit_rows(x)
        rotated = (unit @ rotation(x.shape[1], seed)).astype(np.float32)
        codes = np.frombuffer(b"".join(t["code"].to_pylist()), dtype=np.uint8).reshape(len(rep), -1)
        factors = t["factor"].to_numpy()
        limit = lower_limit(factors, x.shape[1], threshold, epsilon)
        split = int((block == lo).sum())
        links, labels = np.zeros(len(rep), dtype=np.int64), np.arange(len(rep))
        right = range(0, len(rep), TILE) if lo == hi else range(split, len(rep), TILE)
        for a in range(0, split, TILE):
            a_end = min(a + TILE, split)
            for b in right:
                if lo == hi and b < a:
                    continue
                b_end = min(b + TILE, len(rep))
                near = estimate(codes[a:a_end], factors[a:a_end], rotated[b:b_end]) >= limit[a:a_end, None]
                if a == b:
                    near = np.triu(near, 1)
                rows, cols = np.nonzero(near)
                for k in range(0, len(rows), RECOMPUTE):
                    i, j = rows[k : k + RECOMPUTE] + a, cols[k : k + RECOMPUTE] + b
                    hit = np.einsum("ij,ij->i", unit[i], unit[j]) >= threshold
                    i, j = i[hit], j[hit]
                    np.add.at(links, i, copies[j])
                    np.add.at(links, j, copies[i])
                    labels = _merge(labels, i, j)
        root = np.full(len(rep), np.iinfo(np.int64).max)
        np.minimum.at(root, labels, rep)
        keep = links > 0
        return pa.table({"rep": rep[keep], "links": links[keep], "root": root[labels][keep]})

    return compare


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", group_col: str = "label", threshold: float = 0.98, seed: int = 42, epsilon: float | None = None, block_rows: int = 1024) -> DataFrame:
    """Links of cosine >= ``threshold`` within a group, and the components they form.

    One row per input row: ``id_col``, ``n_links`` (other rows linked directly),
    ``component_id`` (least id reachable, itself included), ``kept``.

    Method: every vector is turned by one random rotation and stored as its sign
    bits with a correction factor.  The code of one side and the rotated vector
    of the other give an unbiased estimate of their cosine; pairs whose
    confidence interval reaches the threshold are computed again in double
    precision, and only that decides.  The default interval is certain, so no
    link is lost.  Exact copies are compared once and counted by multiplicity.
    A group of n different vectors is cut into about sqrt(n / ``block_rows``)
    blocks, and every pair of blocks is a task of its own, so a group with a
    third of all rows spreads over as many tasks as it needs.

    Null group, null or empty vector, a null or non-finite component, or an
    all-zero vector: no links, own component.  Vectors of different lengths
    never link.  Rows that repeat an id count as vectors of their own.  Rows
    with a null id are left out.  An empty table gives an empty result.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(group_col).cast("string").alias("grp"), F.col(vec_col).cast("array<double>").alias("vec")).where("id is not null")
    usable = finite_vector(F.col("vec")) & F.exists("vec", lambda x: x != 0) & F.col("grp").isNotNull()
    reps = rows.where(usable).groupBy("grp", "vec").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")).withColumn("dim", F.size("vec"))

    def code(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            codes, factors = [b""] * len(dims), np.zeros(len(dims))
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                x = batch.column("vec").take(pa.array(at)).flatten().to_numpy().reshape(len(at), dim)
                packed, factors[at] = encode(x, seed)
                for k, row in zip(at, packed, strict=True):
                    codes[k] = row.tobytes()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.binary()), pa.array(factors)], [*batch.schema.names, "code", "factor"])

    coded = save(reps.mapInArrow(code, "grp string, vec array<double>, rep long, copies long, dim int, code binary, factor double"), "embed-codes")
    sizes = coded.groupBy("grp", "dim").count().withColumn("blocks", F.greatest(F.ceil(F.sqrt(F.col("count") / block_rows)), F.ceil(F.col("count") / (block_rows * 256))).cast("int")).drop("count")
    cells = (
        coded.join(sizes, ["grp", "dim"])
        .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})
    )
    found = save(cells.select("grp", "dim", "lo", "hi", "block", "rep", "copies", "vec", "code", "factor").groupBy("grp", "dim", "lo", "hi").applyInArrow(_cell(threshold, seed, epsilon), "rep long, links long, root long"), "embed-links")
    components = connected_components(found.select(F.col("rep").alias("src"), F.col("root").alias("dst"))).withColumnRenamed("id", "rep")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = coded.select("grp", "vec", "rep", "copies").join(links, "rep", "left").join(components, "rep", "left")
    own = F.col("id")
    return (
        rows.withColumn("vec", F.when(usable, F.col("vec")))
        .join(classes, ["grp", "vec"], "left")
        .select(
            own.alias(id_col),
            F.when(F.col("rep").isNull(), 0).otherwise(F.col("copies") - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("n_links"),
            F.coalesce("component_id", "rep", own).alias("component_id"),
            (F.coalesce("component_id", "rep", own) == own).alias("kept"),
        )
    )
