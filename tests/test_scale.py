"""What no task may gather whole: ranks, percentiles, averages, numbers, nearest rows; and contact and distance of polygons."""

import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from areapanel import shared
from areapanel.operators import aggregate, binning, evaluate, ml, risk, scan, spatial, topk, windows


@pytest.fixture
def ranges(spark):
    """Many small ranges, so that keys and series lie in several of them."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled", "true"), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[0])
    spark.conf.set("spark.sql.shuffle.partitions", before[1])


def saved_ranges(monkeypatch):
    """Sizes of the ranges that each scan has made."""
    sizes = []

    def keep(df, name):
        done = shared.save(df, name)
        sizes.append(sorted(r["count"] for r in done.groupBy("_scan_part").count().collect()))
        return done

    monkeypatch.setattr(scan, "save", keep)
    return sizes


def test_scan_folds_by_key(spark, ranges):
    rnd = random.Random(4)
    rows = [(rnd.choice(["hot"] * 6 + ["b", None, "c"]), rnd.choice([math.nan, None, 1.0, rnd.random()]), i, rnd.choice([None, 1, 2])) for i in range(1500)]
    df = spark.createDataFrame(rows, "k string, s double, i long, v int")
    got = {r.i: (r.t, r.x, r.d) for r in scan.scan(df, ["k"], ["s", "i"], {"t": (F.col("v"), "sum"), "x": (F.xxhash64("i"), "xor"), "d": (F.col("v") / 2, "sum")}).collect()}
    hashes = {r.i: r.h for r in df.select("i", F.xxhash64("i").alias("h")).collect()}
    order = lambda r: (r[1] is not None, r[1] is not None and math.isnan(r[1]), 0.0 if r[1] is None or math.isnan(r[1]) else r[1], r[2])
    for key in {r[0] for r in rows}:
        t = x = 0
        for r in sorted((r for r in rows if r[0] == key), key=order):
            t, x = t + (r[3] or 0), x ^ hashes[r[2]]
            assert got[r[2]] == (t, x, t / 2)


def test_scan_of_nothing_and_without_order(spark):
    df = spark.range(5).select(F.col("id").alias("v"))
    assert scan.scan(df.where("false"), [], ["v"], {"n": (F.lit(1), "sum")}).collect() == []
    assert sorted(r.n for r in scan.scan(df.coalesce(1), [], [], {"n": (F.lit(1), "sum")}).collect()) == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("kind", ["outlier", "infinite", "one score", "nulls"])
def test_ranges_stay_even(spark, ranges, monkeypatch, kind):
    sizes = saved_ranges(monkeypatch)
    rnd = random.Random(5)
    score = {"outlier": lambda i: 1e9 if i == 7 else rnd.random(), "infinite": lambda i: [math.inf, -math.inf, math.nan][i] if i < 3 else rnd.random(), "one score": lambda i: 0.5, "nulls": lambda i: None if i % 3 else rnd.random()}[kind]
    rows = [(i, score(i)) for i in range(2001)]
    out = windows.decile(spark.createDataFrame(rows, "id long, score double"), "score", "id").collect()
    assert len(out) == 2001
    known = sorted((r for r in rows if r[1] is not None), key=lambda r: (math.isnan(r[1]), r[1] if not math.isnan(r[1]) else 0, r[0]))
    n = len(known)
    want = {i: max(1, (10 * k + n - 2) // (n - 1)) for k, (i, _) in enumerate(known)}
    assert {r.id: r.decile for r in out} == {i: want.get(i) for i, _ in rows}
    assert len(sizes[0]) == 7 and sizes[0][-1] <= 2.5 * 2001 / 7


def test_decile_keeps_null_scores_and_keys(spark):
    df = spark.createDataFrame([(1, "a", 0.1), (2, "a", None), (3, None, 0.3), (4, "a", 0.2), (5, None, None)], "id int, k string, score double")
    assert {r.id: r.decile for r in windows.decile(df, "score", "id").collect()} == {1: 1, 4: 5, 3: 10, 2: None, 5: None}
    assert {r.id: r.decile for r in windows.decile(df, "score", "id", keys=["k"]).collect()} == {1: 1, 4: 10, 3: 1, 2: None, 5: None}


def test_rank_pct_of_hot_scores(spark):
    df = spark.createDataFrame([(i, 0.5 if i < 50 else None if i > 95 else float(i)) for i in range(100)], "id int, score double")
    got = {r.id: r.rank_pct for r in windows.rank_pct(df, "score").collect()}
    assert got[3] == pytest.approx(25.5 / 96) and got[95] == 1.0 and got[99] is None and len(got) == 100


@pytest.mark.parametrize("n", [0, 1, 2, 5000])
def test_quantiles_are_percentiles(spark, ranges, monkeypatch, n):
    sizes = saved_ranges(monkeypatch)
    rnd = random.Random(n)
    df = spark.createDataFrame([(rnd.choice([None, 1.5, rnd.gauss(0, 1), rnd.expovariate(1) * 1e6]), i % 7) for i in range(n)], "x double, i int")
    shares = [0.0, 0.1, 0.25, 0.5, 0.777, 0.9, 1.0]
    got = scan.quantiles(df, {"x": shares, "i": shares}).first()
    want = df.agg(*[F.percentile(c, F.array(*map(F.lit, shares))).alias(c) for c in ("x", "i")]).first()
    assert tuple(got) == tuple(want)
    if n == 5000:
        assert sizes[0][-1] <= 2.5 * sum(sizes[0]) / 7


def test_users_of_quantiles(spark):
    values = [float(x) for x in [3, 1, 4, 1, 5, 9, 2, 6, 5, 3, 5]]
    df = spark.createDataFrame([(i, x if i != 4 else None, "ab"[i % 2] if i else None) for i, x in enumerate(values)], "id int, x double, c string")
    known = [x for i, x in enumerate(values) if i != 4]
    filled = {r.id: (r.x, r.c) for r in aggregate.impute(df, ["x"], ["c"]).collect()}
    assert filled[4][0] == statistics.median(known) and filled[0][1] == "a"
    assert max(r.x for r in binning.winsorize_upper(df, "x", 0.9).where("x is not null").collect()) == pytest.approx(np.percentile(known, 90))
    q80, q90 = np.percentile(known, [80, 90])
    assert {r.id: r.level for r in binning.risk_level(df, "x", 100.0).where("x is not null").collect()} == {i: "high" if x >= q90 else "medium" if x >= q80 else "low" for i, x in enumerate(values) if i != 4}
    assert {r.reasons for r in risk.reason_codes(df, [("x", "much", 1.5)]).where("x > 6").collect()} == {"much"}
    assert binning.fd_bins(df.where("false"), "x").first().bins == 1


def test_averages_over_many_ranges(spark, ranges, monkeypatch):
    sizes = saved_ranges(monkeypatch)
    rnd = random.Random(6)
    rows = [(k, t, None if rnd.random() < 0.2 or (k == "late" and t < 30) else rnd.gauss(0, 1)) for k, n in (("hot", 3000), ("late", 50), ("none", 4), (None, 40)) for t in range(n)]
    rows = [(k, t, None if k == "none" else x) for k, t, x in rows]
    got = {(r.k, r.t): (r.ema_0_3, r.ema_0_9) for r in windows.ema(spark.createDataFrame(rows, "k string, t int, x double"), "x", [0.3, 0.9], ["k"], "t").collect()}
    assert len(got) == len(rows) and len(sizes[0]) == 7 and sizes[0][-1] < 1200  # one series in several tasks
    at, last = "?", None
    for k, t, x in rows:
        if k != at:
            at, last = k, [None, None]
        if x is not None:
            last = [x if e is None else a * x + (1 - a) * e for a, e in zip((0.3, 0.9), last, strict=True)]
        for a, b in zip(got[k, t], last, strict=True):
            assert (a is None and b is None) or a == pytest.approx(b, abs=1e-9)


def test_averages_of_odd_values_stay_in_their_series(spark):
    rows = [("a", 1, math.nan), ("a", 2, 1.0), ("b", 1, 2.0), ("b", 2, math.inf), ("c", 1, None), ("c", 2, 3.0), ("d", 1, 4.0)]
    got = {(r.k, r.t): r.ema_0_5 for r in windows.ema(spark.createDataFrame(rows, "k string, t int, x double"), "x", [0.5], ["k"], "t").collect()}
    assert math.isnan(got["a", 2]) and got["b", 1] == 2.0 and got["b", 2] == math.inf and got["c", 1] is None and got["c", 2] == 3.0 and got["d", 1] == 4.0


def test_curves_with_far_scores(spark):
    rnd = random.Random(8)
    rows = [(rnd.choice([1e9, -1e9, 0.5, rnd.random()]), int(rnd.random() < 0.4)) for _ in range(400)]
    df = spark.createDataFrame(rows, "score double, label int")
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    auc = sum((p > q) + (p == q) / 2 for p in pos for q in neg) / len(pos) / len(neg)
    assert evaluate.roc_auc(df).first()[0] == pytest.approx(auc)


def test_ids_and_shuffles_by_ranges(spark, ranges):
    values = spark.createDataFrame([(f"v{i:04d}",) for i in range(300)], "value string")
    old = spark.createDataFrame([("v0003", 7), ("x", 2)], "value string, id long")
    got = {r.value: r.id for r in topk.assign_ids(values, old).collect()}
    assert got["v0003"] == 7 and got["x"] == 2
    assert [got[v] for v in sorted(set(got) - {"v0003", "x"})] == list(range(8, 307))
    df = spark.range(200).select("id", (F.col("id") * 2).alias("x"))
    out = ml.shuffled(df, "x", 3, "id").collect()
    assert sorted(r.x for r in out) == [2 * i for i in range(200)] and sorted(r.id for r in out) == list(range(200))
    assert all(r.x != 2 * r.id for r in out) and out[0].asDict().keys() == {"id", "x"}
    assert [r.x for r in ml.shuffled(df.limit(1), "x", 3, "id").collect()] == [0]


def haversine(a, b, c, d):
    a, b, c, d = map(math.radians, (a, b, c, d))
    return 2 * 6_371_000 * math.asin(math.sqrt(math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2))


@pytest.mark.parametrize("metric", ["haversine", "webmercator"])
def test_nearest_of_dense_and_far_rows(spark, metric):
    """A dense cluster, copies of one place, and sources on the other side of the globe."""
    rnd = random.Random(9)
    dst = [(i, 37.7 + rnd.gauss(0, 0.01), -122.4 + rnd.gauss(0, 0.01)) for i in range(400)] + [(400 + i, 10.0, 179.99) for i in range(150)] + [(600 + i, rnd.uniform(-80, 80), rnd.uniform(-180, 180)) for i in range(50)] + [(900, None, 1.0)]
    src = [(i, 37.7 + rnd.gauss(0, 0.02), -122.4 + rnd.gauss(0, 0.02)) for i in range(40)] + [(100 + i, rnd.uniform(-84, 84), rnd.uniform(-180, 180)) for i in range(40)] + [(200, 10.0, -179.99), (201, None, 3.0), (202, -37.7, 57.6)]
    s, d = spark.createDataFrame(src, "src_id int, lat double, lon double"), spark.createDataFrame(dst, "dst_id int, dst_lat double, dst_lon double")
    plain, deep = (sorted(map(tuple, spatial.nearest(s, d, metric, most=m, leaf=8).collect())) for m in (10_000, 5))
    assert plain == deep and len(plain) == len(src)


def test_pyramid_opens_few_cells(spark, monkeypatch):
    """Far sources meet a bounded number of cells at each level, not the cluster."""
    opened = []

    def keep(df, name):
        done = shared.save(df, name)
        if name == "nearest-frontier":
            opened.append(done.count())
        return done

    monkeypatch.setattr(spatial, "save", keep)
    rnd = random.Random(10)
    d = spark.createDataFrame([(i, 37.7 + rnd.random(), -122.4 + rnd.random()) for i in range(20_000)], "dst_id int, dst_lat double, dst_lon double")
    s = spark.createDataFrame([(i, rnd.uniform(-60, 20), rnd.uniform(0, 90)) for i in range(50)], "src_id int, lat double, lon double")
    got = {r.src_id: r.distance for r in spatial.nearest(s, d).collect()}
    rows, places = s.collect(), [(r.dst_lat, r.dst_lon) for r in d.collect()]
    for r in rows[:5]:
        assert got[r.src_id] == pytest.approx(min(haversine(r.lat, r.lon, *p) for p in places), abs=0.06)
    assert max(opened) <= 50 * 40  # of about 1,000 leaves


def ring(name, points):
    return [(name, *a, *b) for a, b in zip(points, points[1:] + points[:1], strict=True)]


def square(name, x, y, side):
    return ring(name, [(x, y), (x + side, y), (x + side, y + side), (x, y + side)])


EDGES = "area_id string, x1 double, y1 double, x2 double, y2 double"


def test_contact_without_common_corners(spark):
    edges = square("big", 0.0, 0.0, 1.0) + square("on side", 1.0, 0.3, 0.2) + square("corner", -0.5, -0.5, 0.5) + square("apart", 1.3, 0.0, 0.1) + square("inside", 0.4, 0.4, 0.1) + square("across", 0.9, 0.8, 0.4)
    edges += ring("tip", [(0.5, 1.0), (0.6, 1.4), (0.4, 1.4)]) + ring("near tip", [(0.2, 1.0 + 1e-6), (0.25, 1.3), (0.15, 1.3)])
    got = {(r.area_id, r.neighbor) for r in spatial.build_adjacency(spark.createDataFrame(edges, EDGES), cell=0.07).collect()}
    want = {("big", x) for x in ("on side", "corner", "across", "tip")}
    assert got == want | {(b, a) for a, b in want}


def test_contact_equals_brute_force(spark):
    """Bricks of random widths: T-junctions everywhere, turned so that no side is straight."""
    rnd = random.Random(11)
    turn = lambda x, y: (x * math.cos(0.3) - y * math.sin(0.3), x * math.sin(0.3) + y * math.cos(0.3))
    bricks = []
    for row in range(6):
        x = 0.0
        while x < 0.3:
            w = rnd.uniform(0.02, 0.09)
            bricks.append((f"{row}-{x:.4f}", x, row * 0.03, w))
            x += w
    edges = [e for n, x, y, w in bricks for e in ring(n, [turn(x, y), turn(x + w, y), turn(x + w, y + 0.03), turn(x, y + 0.03)])]
    got = {(r.area_id, r.neighbor) for r in spatial.build_adjacency(spark.createDataFrame(edges, EDGES), cell=0.02).collect()}
    meet = lambda a, b: a[1] <= b[1] + b[3] + 1e-12 and b[1] <= a[1] + a[3] + 1e-12 and a[2] <= b[2] + 0.03 + 1e-12 and b[2] <= a[2] + 0.03 + 1e-12
    assert got == {(a[0], b[0]) for a in bricks for b in bricks if a[0] != b[0] and meet(a, b)}


@pytest.mark.parametrize("at", [(0.0, 0.0), (64.0, 20.0), (-37.0, -122.0)])
def test_distance_to_the_boundary(spark, at):
    rnd = random.Random(12)
    edges = []
    for k in range(8):
        y, x = at[0] + rnd.uniform(0, 0.02), at[1] + rnd.uniform(0, 0.04)
        edges += ring(f"a{k}", [(x + rnd.uniform(0, 0.01), y + rnd.uniform(0, 0.004)) for _ in range(4)])
    points = [(i, at[0] + rnd.uniform(-0.01, 0.03), at[1] + rnd.uniform(-0.02, 0.06)) for i in range(150)] + [(999, None, 0.0)]
    got = {r.point_id: (r.area_id, r.distance) for r in spatial.nearest_area(spark.createDataFrame(points, "point_id int, lat double, lon double"), spark.createDataFrame(edges, EDGES), 300.0).collect()}
    metres = math.pi * 6_371_000 / 180
    want = {}
    for i, lat, lon in points[:-1]:
        best = []
        for name, *e in edges:
            ax, ay, bx, by = [(v - (lon, lat)[k % 2]) * metres * (math.cos(math.radians(lat)), 1)[k % 2] for k, v in enumerate(e)]
            t = max(0.0, min(1.0, -(ax * (bx - ax) + ay * (by - ay)) / max(1e-300, (bx - ax) ** 2 + (by - ay) ** 2)))
            best.append((math.hypot(ax + t * (bx - ax), ay + t * (by - ay)), name))
        d, name = min((round(d, 1), n) for d, n in best)
        if min(best)[0] <= 300.0:
            want[i] = (name, d)
    assert got.keys() == want.keys() and 10 < len(want) < 150
    assert all(got[i][1] == pytest.approx(want[i][1], abs=0.11) for i in want)
    assert sum(got[i][0] == want[i][0] for i in want) >= len(want) - 2


def test_fallback_has_a_limit(spark):
    edges = spark.createDataFrame(square("a", 0.0, 0.0, 0.01) + square("b", 0.02, 0.0, 0.01), EDGES)
    points = spark.createDataFrame([(1, 0.005, 0.005), (2, 0.005, 0.0101), (3, 0.005, 0.0199), (4, 0.5, 0.5), (5, None, 0.0)], "point_id int, lat double, lon double")
    assert {r.point_id: r.area_id for r in spatial.tag_areas(points, edges, max_distance=50.0).collect()} == {1: "a", 2: "a", 3: "b", 4: None, 5: None}


def test_run_folder_is_deleted(spark):
    with shared.run_folder(spark) as path:
        done = shared.save(spark.range(3).toDF("v"), "t")
        assert f"/{path.rsplit('/', 1)[1]}/" in done.inputFiles()[0]
        assert done.count() == 3
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    assert not jvm.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jvm)
