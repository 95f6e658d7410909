"""Centroids to a fraction of a millimetre; nearest rows and counts of rows that share places."""

import math

import numpy as np
from pyspark.sql import functions as F

from areapanel import shared
from areapanel.operators import spatial
from areapanel.plans import QUERIES

EDGES = "area_id string, x1 double, y1 double, x2 double, y2 double"


def box(name, w, s, e, n):
    return [(name, w, s, e, s), (name, e, s, e, n), (name, e, n, w, n), (name, w, n, w, s)]


def test_centroids_keep_their_digits(spark):
    cells = {f"cell_{r}_{c}": (-122.51 + c / 100, 37.70 + r / 100, -122.51 + (c + 1) / 100, 37.70 + (r + 1) / 100) for r in range(10) for c in range(12)}
    got = {r.area_id: (r.lon, r.lat) for r in spatial.centroids(spark.createDataFrame([e for k, v in cells.items() for e in box(k, *v)], EDGES)).collect()}
    assert all(math.dist(got[k], ((w + e) / 2, (s + n) / 2)) < 1e-12 for k, (w, s, e, n) in cells.items())
    flat = [("line", 0.0, 0.0, 0.04, 0.0), ("line", 0.04, 0.0, 0.0, 0.0), ("dot", 5.0, 6.0, 5.0, 6.0)]
    assert {r.area_id: (r.lon, r.lat) for r in spatial.centroids(spark.createDataFrame(flat, EDGES)).collect()} == {"line": (0.02, 0.0), "dot": (5.0, 6.0)}
    # 18462.9640 m and 18462.9646 m are one distance to a digit: the least area
    edges = spark.createDataFrame([e for k, v in cells.items() if k in ("cell_8_0", "cell_9_0") for e in box(k, *v)], EDGES)
    point = spark.createDataFrame([(1, 37.78981371, -122.71501371000001)], "point_id int, lat double, lon double")
    assert [tuple(r) for r in spatial.tag_areas(point, edges, nearest_fallback=True).collect()] == [(1, "cell_8_0")]


def haversine(a, b, c, d):
    a, b, c, d = map(np.radians, (a, b, c, d))
    return 2 * 6_371_000 * np.arcsin(np.sqrt(np.sin((c - a) / 2) ** 2 + np.cos(a) * np.cos(c) * np.sin((d - b) / 2) ** 2))


def saved_rows(monkeypatch):
    """Rows of the tables that are saved from now on, by name."""
    rows = {}

    def keep(df, name):
        done = shared.save(df, name)
        rows.setdefault(name, []).append(done.count())
        return done

    monkeypatch.setattr(spatial, "save", keep)
    return rows


def test_nearest_searches_each_place_once(spark, monkeypatch):
    rows = saved_rows(monkeypatch)
    src = spark.range(20_000).select(F.col("id").alias("src_id"), (F.col("id") % 7 / 10.0).alias("lat"), (F.col("id") % 11 / 10.0).alias("lon"))
    dst = spark.range(900).select(F.col("id").alias("dst_id"), (F.col("id") % 9 / 10.0 + 0.013).alias("dst_lat"), (F.col("id") % 10 / 10.0).alias("dst_lon"))
    odd = spark.createDataFrame([(30_000, None, 1.0), (30_001, float("nan"), 1.0), (30_002, 0.1, float("inf")), (30_003, -0.0, 0.0)], "src_id long, lat double, lon double")
    nowhere = spark.createDataFrame([(-1, 0.1, None), (-2, float("nan"), 0.1)], "dst_id long, dst_lat double, dst_lon double")
    first, places = {}, [(i, i % 9 / 10 + 0.013, i % 10 / 10) for i in range(90)]
    for a, b in {(i % 7, i % 11) for i in range(77)}:
        first[a, b] = min((round(float(haversine(a / 10, b / 10, y, x)), 1), i) for i, y, x in places)
    want = {i: first[i % 7, i % 11] for i in range(20_000)} | {30_000: (None, None), 30_001: (None, None), 30_002: (None, None), 30_003: first[0, 0]}
    for k in ({}, {"pairs": 1}):  # all pairs of places; the pyramid
        got = {r.src_id: (r.distance, r.dst_id) for r in spatial.nearest(src.unionByName(odd), dst.unionByName(nowhere), **k).collect()}
        assert got == want
    assert rows["nearest-sources"] == [77, 77] and rows["nearest-destinations"] == [90]


def test_nearest_compares_no_product_of_many_places(spark, monkeypatch):
    rows, n = saved_rows(monkeypatch), 4_000
    rnd = np.random.default_rng(5)
    a, b = (np.round(rnd.uniform((37.7, -122.5), (37.8, -122.4), (n, 2)), 9) for _ in range(2))
    src = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(a)], "src_id int, lat double, lon double")
    dst = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(b)], "dst_id int, dst_lat double, dst_lon double")
    got = {r.src_id: r.distance for r in spatial.nearest_distance(src, dst).collect()}
    assert all(abs(got[i] - haversine(*a[i], b[:, 0], b[:, 1]).min()) < 0.051 for i in range(n))
    assert rows["nearest-frontier"] and sum(rows["nearest-frontier"]) * 64 < n * n / 2


def test_mercator_searches_each_place_once(spark, monkeypatch):
    rows = saved_rows(monkeypatch)
    flat = lambda lat, lon: (6378137 * math.radians(lon), 6378137 * math.log(math.tan(math.pi / 4 + math.radians(lat) / 2)))
    a, b = [(i % 40 / 20, i % 41 / 20) for i in range(1640)], [(i % 30 / 15 + 0.007, i % 31 / 15) for i in range(930)]
    pole = [(-1, -90.0, 0.3)]  # no place in the plane: it must not hide the others
    src = spark.createDataFrame([(i, *a[i % 1640]) for i in range(4000)] + [(9000, -90.0, 0.3)], "src_id int, lat double, lon double")
    dst = spark.createDataFrame([(i, *b[i % 930]) for i in range(2000)] + pole, "dst_id int, dst_lat double, dst_lon double")
    there = np.array([flat(*q) for q in b])
    want = [np.hypot(*(there - flat(*p)).T).min() for p in a]
    for k in ({}, {"pairs": 1}):
        got = {r.src_id: r.distance for r in spatial.nearest_distance(src, dst, "webmercator", **k).collect()}
        assert got.pop(9000) is None and all(abs(got[i] - want[i % 1640]) < 0.051 for i in range(4000))
    assert rows["nearest-sources"] == [1640, 1640] and rows["nearest-destinations"] == [930]


def test_counts_of_rows_that_share_places(spark):
    a, b = [(i % 12 / 100, i % 13 / 100) for i in range(156)], [(i % 12 / 100 + 0.001, i % 14 / 100) for i in range(84)]
    src = spark.range(2000).select(F.col("id").alias("src_id"), (F.col("id") % 12 / 100.0).alias("lat"), (F.col("id") % 13 / 100.0).alias("lon")).unionByName(spark.createDataFrame([(5000, None, 0.1), (5001, float("nan"), 0.1)], "src_id long, lat double, lon double"))
    dst = spark.range(700).select(F.col("id").alias("dst_id"), (F.col("id") % 12 / 100.0 + 0.001).alias("dst_lat"), (F.col("id") % 14 / 100.0).alias("dst_lon"), F.when(F.col("id") % 3 > 0, F.col("id")).cast("decimal(9,2)").alias("w"))
    out = spatial.count_within(src, dst, [1500, 3000.5], "w")
    assert dict(out.dtypes) | {"src_id": "bigint"} == {"src_id": "bigint", "within_1500": "bigint", "within_3000_5": "bigint", "sum_1500": "decimal(19,2)", "sum_3000_5": "decimal(19,2)"}
    lat, lon, w = *(np.array([b[i % 84][k] for i in range(700)]) for k in (0, 1)), np.array([i if i % 3 else 0 for i in range(700)])
    want = {}
    for p in a:
        near = [haversine(*p, lat, lon) <= r for r in (1500, 3000.5)]
        want[p] = (*(int(x.sum()) for x in near), *(int(w[x].sum()) for x in near))
    got = {r.src_id: tuple(map(int, r[1:])) for r in out.collect()}
    assert got == {i: want[a[i % 156]] for i in range(2000)} | {5000: (0, 0, 0, 0), 5001: (0, 0, 0, 0)}


def city(spark, folder, events, suppliers, first=0):
    spark.range(events).selectExpr("id as event_id", "timestamp'2024-01-01' as ts", "id % 9 as user_id", "'view' as event_type", "1.0D as value", "'{}' as props").write.parquet(f"{folder}/events.parquet")
    spark.range(first, first + suppliers).selectExpr("id as s_suppkey", "'x' as s_name", "cast(id % 5 as int) as s_nationkey", "id % 11 + 0.25D as s_acctbal").write.parquet(f"{folder}/supplier.parquet")
    place = lambda n: np.array([(37.70 + i * 7919 % 1000 / 10000, -122.51 + i * 104729 % 1200 / 10000) for i in n])
    a, b = place(range(min(events, 6000))), place(range(first, first + suppliers))
    return np.array([haversine(*p, b[:, 0], b[:, 1]) for p in a])


def test_counts_within_a_radius_of_zero(spark, tmp_path):
    """Where three of four events share a place with a supplier the radius is 0."""
    d = city(spark, tmp_path, 6000, 9000)
    assert np.quantile(d.min(1).round(1), 0.75) == 0
    got = {r.src_id: r.n for r in QUERIES["g08_count_within_p75"](spark, str(tmp_path)).collect()}
    assert got == dict(enumerate((d < 1e-3).sum(1).tolist()))


def test_near_flags_search_each_place_once(spark, tmp_path, monkeypatch):
    rows, d = saved_rows(monkeypatch), city(spark, tmp_path, 30_000, 700, 41)
    near = d.min(1).round(1) <= 300
    assert 0.1 < near.mean() < 0.9
    got = {r.src_id: r.is_near for r in QUERIES["g15_near_flag"](spark, str(tmp_path)).collect()}
    assert got == {i: int(near[i % 6000]) for i in range(30_000)}
    assert rows["nearest-sources"] == [6000]


def test_counts_join_places(spark, tmp_path, monkeypatch):
    joined, plain = [], spatial.near_pairs
    monkeypatch.setattr(spatial, "near_pairs", lambda src, dst, *a: joined.append((src.count(), dst.count())) or plain(src, dst, *a))
    d = city(spark, tmp_path, 30_000, 12_000)
    out = {r.src_id: tuple(r[1:]) for r in QUERIES["g06_g07_count_within"](spark, str(tmp_path)).collect()}
    weight = np.arange(12_000) % 11 + 0.25
    want = [(*(int((x <= r).sum()) for r in (300, 600)), *(float(weight[x <= r].sum()) for r in (300, 600))) for x in d]
    assert len(out) == 30_000 and all(out[i] == want[i % 6000] for i in range(30_000))
    assert joined == [(6000, 6000)]
