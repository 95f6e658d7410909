"""Running totals and exact order statistics that no key, value or outlier can gather in one task.

Rows are dealt to ranges of the whole sort order, whose bounds Spark samples from
the rows, so a hot key or score is split by what comes after it in the order.
Each range adds up its own rows; what it must add from those before it is folded
from a row or two for each range.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from ..shared import save

FOLDS = {"sum": np.add, "xor": np.bitwise_xor}
WHOLE = {"boolean", "tinyint", "smallint", "int", "bigint"}


def _same(a, b) -> bool:
    return a == b or (isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b))


def _changes(columns: list[pa.Array], before: list | None) -> np.ndarray:
    """True where a row's key is another than that of the row before; nulls are equal, and so are NaNs."""
    n = len(columns[0]) if columns else 0
    out = np.zeros(n, dtype=bool)
    for k, c in enumerate(columns):
        here, there = c.slice(1), c.slice(0, max(0, n - 1))
        differ = pc.fill_null(pc.not_equal(here, there), False).to_numpy(zero_copy_only=False)
        if pa.types.is_floating(c.type):
            nan = pc.fill_null(pc.is_nan(c), False).to_numpy(zero_copy_only=False)
            differ &= ~(nan[1:] & nan[:-1])
        null = c.is_null().to_numpy(zero_copy_only=False)
        out[1:] |= differ | (null[1:] != null[:-1])
        if n:
            out[0] |= before is None or not _same(before[k], c[0].as_py())
    return out


class Running:
    """Folds of columns over a sorted stream of batches, begun anew at every new key."""

    def __init__(self, keys: list[str], values: list[str], folds: list[np.ufunc]):
        self.keys, self.values, self.folds = keys, values, folds
        self.key, self.carry, self.started = None, None, 0

    def step(self, batch: pa.RecordBatch) -> tuple[list[np.ndarray], np.ndarray]:
        """The folds at each row, and whether the row is of the stream's first key."""
        columns = [batch.column(k) for k in self.keys]
        new = _changes(columns, self.key) if columns else np.zeros(batch.num_rows, dtype=bool)
        if not self.started and len(new):
            new[0] = True
        run = np.cumsum(new)  # 0: goes on from the batch before
        starts = np.flatnonzero(new)
        out, last = [], []
        for k, (name, fold) in enumerate(zip(self.values, self.folds, strict=True)):
            x = batch.column(name)
            v = pc.fill_null(x, 0).to_numpy(zero_copy_only=False)
            total = fold.accumulate(v)
            gone = np.zeros(len(starts) + 1, dtype=v.dtype)  # what each run must leave out
            gone[1:] = np.where(starts > 0, total[np.maximum(starts - 1, 0)], 0)
            total = total - gone[run] if fold is np.add else total ^ gone[run]
            if self.carry is not None:
                total = np.where(run == 0, fold(total, self.carry[k]), total)
            out.append(total)
            last.append(total[-1])
        first = run + self.started <= 1
        self.started += int(run[-1])
        self.carry, self.key = last, [c[-1].as_py() for c in columns]
        return out, first


def _pass(df: DataFrame, keys: list[str], order: list, begin, added: dict[str, str], drop: list[str], name: str, ranges: int | None = None) -> DataFrame:
    """Deal rows to ranges of the order and let one :class:`Running` or the like step through each; the rows are saved.

    ``begin()`` makes an object whose ``step(batch)`` returns the added columns
    and whether each row is of the range's first key.  ``_scan_part`` numbers the
    ranges; ``_scan_head`` and ``_scan_last`` mark their ends.
    """
    if keys or order:
        df = df.repartitionByRange(*([ranges] if ranges else []), *keys, *order).sortWithinPartitions(*keys, *order)
    df = df.withColumn("_scan_part", F.spark_partition_id())
    kept = [f for f in df.schema.fields if f.name not in drop]
    kinds = {"long": LongType(), "double": DoubleType()}
    flags = ["_scan_first", "_scan_head", "_scan_last"]
    schema = StructType([*kept, *(StructField(n, kinds[t]) for n, t in added.items()), *(StructField(f, BooleanType()) for f in flags)])

    def run(batches):
        at, held, head = begin(), None, True
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                yield held
            columns, first = at.step(batch)
            marks = [np.zeros(batch.num_rows, dtype=bool), np.zeros(batch.num_rows, dtype=bool)]
            marks[0][0], head = head, False
            held = pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), *map(pa.array, (*columns, first, *marks))], names=schema.names)
        if held is not None:
            last = np.zeros(held.num_rows, dtype=bool)
            last[-1] = True
            yield held.set_column(held.num_columns - 1, "_scan_last", pa.array(last))

    return save(df.mapInArrow(run, schema), name)


def scan(df: DataFrame, keys: list[str], order: list, totals: dict[str, tuple[Column, str]], name: str = "scan", ranges: int | None = None) -> DataFrame:
    """Adds, by name, folds (``sum`` or ``xor``) of columns over the rows of the same keys that come before or are the row.

    ``totals``: name -> (numeric column, fold); integers give longs, others doubles.
    Nulls count as 0; null keys are one key.  Rows that are equal in ``order``
    come one after the other in no set order.  The ordered rows are written to
    the shared folder while the plan is made, so a task never holds more than
    its range, and a key's rows may lie in many ranges (``ranges``; by default as
    many as Spark shuffles to).  Columns that begin with ``_scan_`` are the function's own.
    """
    typed = df.withColumns({f"_scan_{n}": c for n, (c, _) in totals.items()})
    kinds = {n: "long" if typed.schema[f"_scan_{n}"].dataType.simpleString() in WHOLE else "double" for n in totals}
    typed = typed.withColumns({f"_scan_{n}": F.col(f"_scan_{n}").cast(kinds[n]) for n in totals})
    names, at = list(totals), [f"_scan_{n}" for n in totals]
    folds = [f for _, f in totals.values()]
    done = _pass(typed, keys, order, lambda: Running(keys, at, [FOLDS[f] for f in folds]), kinds, at, name, ranges)
    offsets = _offsets(done, keys, names, folds)
    if offsets:
        more = df.sparkSession.createDataFrame(offsets, "_scan_part int, " + ", ".join(f"_scan_{n} {kinds[n]}" for n in names))
        done = done.join(F.broadcast(more), "_scan_part", "left")  # a row for each range
        zero = {n: F.when(F.col("_scan_first"), F.coalesce(F.col(f"_scan_{n}"), F.lit(0).cast(kinds[n]))).otherwise(F.lit(0).cast(kinds[n])) for n in names}
        done = done.withColumns({n: F.col(n) + zero[n] if f == "sum" else F.col(n).bitwiseXOR(zero[n]) for n, f in zip(names, folds, strict=True)})
    return done.select(*df.columns, *names)


def _offsets(done: DataFrame, keys: list[str], names: list[str], folds: list[str]) -> list[tuple]:
    """What the first key of each range has from the ranges before it; one or two rows of each range come to the driver."""
    ends = done.where("_scan_head or _scan_last").select("_scan_part", "_scan_head", "_scan_last", "_scan_first", *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], *[F.col(n).alias(f"_sum{i}") for i, n in enumerate(names)]).collect()
    ends.sort(key=lambda r: (r["_scan_part"], not r["_scan_head"]))
    out, before, open_ = [], None, [0] * len(names)
    for r in ends:
        key = [r[f"_key{i}"] for i in range(len(keys))]
        if r["_scan_head"]:
            goes_on = before is not None and all(map(_same, before, key))
            offset = open_ if goes_on else [0] * len(names)
            if goes_on:
                out.append((r["_scan_part"], *offset))
        if r["_scan_last"]:
            own = [r[f"_sum{i}"] for i in range(len(names))]
            open_ = [(a + b if f == "sum" else a ^ b) for a, b, f in zip(own, offset, folds, strict=True)] if r["_scan_first"] else own
            before = key
    return out


class Averaging:
    """Exponential averages over a sorted stream of batches.

    A step is an affine map of the average before it; the maps of a batch are
    composed by doubling distances, so nothing walks the rows one by one.  Beside
    the averages: the number of values of the series so far, and its first one.
    """

    def __init__(self, keys: list[str], value: str, alphas: list[float]):
        self.keys, self.value, self.alphas = keys, value, alphas
        self.key, self.last, self.count, self.first, self.started = None, None, 0, None, 0

    def step(self, batch: pa.RecordBatch) -> tuple[list[pa.Array], np.ndarray]:
        columns = [batch.column(k) for k in self.keys]
        n = batch.num_rows
        new = _changes(columns, self.key) if columns else np.zeros(n, dtype=bool)
        if not self.started:
            new[0] = True
        run = np.cumsum(new)
        x = batch.column(self.value)
        there = x.is_valid().to_numpy(zero_copy_only=False)
        v = pc.fill_null(x, 0.0).to_numpy(zero_copy_only=False)
        many = np.cumsum(there)
        starts = np.flatnonzero(new)
        gone = np.zeros(len(starts) + 1, dtype=np.int64)
        gone[1:] = many[starts] - there[starts]
        count = many - gone[run] + np.where(run == 0, self.count, 0)
        begins = there & (count == 1)
        at = np.maximum.accumulate(np.where(begins, np.arange(n), -1))  # where the row's series had its first value
        begun = np.where(at >= 0, v[at], 0.0 if self.first is None else self.first)
        out = []
        for k, alpha in enumerate(self.alphas):
            a = np.where(there, np.where(begins, 0.0, 1.0 - alpha), 1.0)
            b = np.where(there, np.where(begins, v, alpha * v), 0.0)
            a[new & ~there] = 0.0  # nothing passes from one series to the next
            if run[0] == 0 and self.last is not None:
                b[0] += a[0] * self.last[k] if a[0] else 0.0
            width = 1
            while width < n:
                b[width:] = b[width:] + np.where(a[width:] == 0.0, 0.0, a[width:] * b[:-width])  # NaN and infinity stay in their series
                a[width:] = a[width:] * a[:-width]
                width *= 2
            out.append(b)
        self.key, self.last, self.count, self.first = [c[-1].as_py() for c in columns], [b[-1] for b in out], int(count[-1]), float(begun[-1])
        self.started, first = self.started + int(run[-1]), run + self.started <= 1
        none = count == 0
        return [*(pa.array(b, mask=none) for b in out), pa.array(count), pa.array(begun, mask=none)], first


def averages(df: DataFrame, keys: list[str], order: list, value: str, alphas: dict[str, float], name: str = "averages") -> DataFrame:
    """Adds, by name, the exponential average of each row's series: the first value, then alpha x value + (1 - alpha) x the one before.

    Nulls leave it as it was; it is null before the first value.  A series may
    lie in many ranges: with the average e that the ranges before hand on, and x
    the first of a range's k values so far, (1 - alpha)^k (e - x) is missing from
    what the range has made of its own rows.
    """
    typed = df.withColumn("_scan_x", F.col(value).cast("double"))
    names, rates = list(alphas), list(alphas.values())
    added = {n: "double" for n in names} | {"_scan_count": "long", "_scan_begun": "double"}
    done = _pass(typed, keys, order, lambda: Averaging(keys, "_scan_x", rates), added, ["_scan_x"], name)
    ends = done.where("_scan_head or _scan_last").select("_scan_part", "_scan_head", "_scan_last", "_scan_first", "_scan_count", "_scan_begun", *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], *[F.col(n).alias(f"_e{i}") for i, n in enumerate(names)]).collect()
    handed, before, open_ = [], None, None
    for r in sorted(ends, key=lambda r: (r["_scan_part"], not r["_scan_head"])):
        key = [r[f"_key{i}"] for i in range(len(keys))]
        if r["_scan_head"]:
            given = open_ if before is not None and all(map(_same, before, key)) else None
            if given is not None:
                handed.append((r["_scan_part"], *given))
        if r["_scan_last"]:
            own = [r[f"_e{i}"] for i in range(len(names))] if r["_scan_count"] else None
            if r["_scan_first"] and given is not None:
                k, x = r["_scan_count"], r["_scan_begun"]
                own = given if own is None else [e + (1 - a) ** k * (g - x) for e, a, g in zip(own, rates, given, strict=True)]
            before, open_ = key, own
    if handed:
        more = df.sparkSession.createDataFrame(handed, "_scan_part int, " + ", ".join(f"_scan_{n} double" for n in names))
        done = done.join(F.broadcast(more), "_scan_part", "left")  # a row for each range
        late = {n: F.coalesce(F.col(n) + F.pow(F.lit(1.0 - a), F.col("_scan_count")) * (F.col(f"_scan_{n}") - F.col("_scan_begun")), F.col(f"_scan_{n}"), F.col(n)) for n, a in alphas.items()}
        done = done.withColumns({n: F.when(F.col("_scan_first"), late[n]).otherwise(F.col(n)) for n in names})
    return done.select(*df.columns, *names)


def quantiles(df: DataFrame, wanted: dict[str, list[float]], name: str = "quantiles") -> DataFrame:
    """One row: for each column the exact percentiles at the given shares, an array of doubles (null where it has no value).

    The same numbers as ``percentile``: linear between neighbours, nulls left
    out, NaN the greatest.  Values are counted first, so repeated values cost
    nothing, and ranked in ranges of the sampled order; no task holds all values.
    """
    columns = list(wanted)
    values = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("_c"), F.col(c).cast("double").alias("_x")) for i, c in enumerate(columns)])).alias("v")).select("v.*")
    per = values.where("_x is not null").groupBy("_c", "_x").agg(F.count(F.lit(1)).alias("_n"))
    ranked = scan(per, ["_c"], ["_x"], {"_upto": (F.col("_n"), "sum")}, name)
    sizes = ranked.groupBy().agg(*[F.coalesce(F.max(F.when(F.col("_c") == i, F.col("_upto"))), F.lit(0)).alias(f"_s{i}") for i in range(len(columns))])
    at = ranked.crossJoin(F.broadcast(sizes))  # one row

    def value_at(i: int, rank: Column) -> Column:
        return F.max(F.when((F.col("_c") == i) & (F.col("_upto") - F.col("_n") <= rank) & (rank < F.col("_upto")), F.col("_x")))

    found, out = [], []
    for i, c in enumerate(columns):
        pair = []
        for k, q in enumerate(wanted[c]):
            pos = F.lit(float(q)) * (F.col(f"_s{i}") - 1)
            found += [value_at(i, F.floor(pos)).alias(f"_a{i}_{k}"), value_at(i, F.ceil(pos)).alias(f"_b{i}_{k}")]
            a, b = F.col(f"_a{i}_{k}"), F.col(f"_b{i}_{k}")
            pair.append(F.when(F.floor(pos) == F.ceil(pos), a).when(a == b, a).otherwise((F.ceil(pos) - pos) * a + (pos - F.floor(pos)) * b))
        out.append(F.when(F.col(f"_s{i}") > 0, F.array(*pair)).alias(c))
    return at.agg(*found).crossJoin(F.broadcast(sizes)).select(*out)


def lookup(rows: DataFrame, table: DataFrame, on: list[str], hot: Column) -> DataFrame:
    """Left join with a table of one row for each key, nulls equal; keys marked ``hot`` are broadcast, the others shuffled.

    The caller sees to it that only a bounded number of keys can be hot (those
    that hold more than a set share of the rows).
    """
    news = [c for c in table.columns if c not in on]
    same = lambda t: F.expr(" and ".join(f"l.`{c}` <=> {t}.`{c}`" for c in on))
    often, seldom = table.where(hot), table.where(~F.coalesce(hot, F.lit(False)))
    marked = rows.alias("l").join(F.broadcast(often.withColumn("_hot", F.lit(True))).alias("h"), same("h"), "left").select("l.*", *[F.col(f"h.`{c}`") for c in news], F.col("h._hot"))
    usual = marked.where("_hot is null").drop(*news, "_hot").alias("l").join(seldom.alias("s"), same("s"), "left").select("l.*", *[F.col(f"s.`{c}`") for c in news])
    return marked.where("_hot").drop("_hot").unionByName(usual)
