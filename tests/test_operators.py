"""Small frames for traps and edges."""

import datetime as dt
import json
import math
import random

import pytest
from pyspark.sql import functions as F

from areapanel.functions import calendar, keys, numbers
from areapanel.operators import aggregate, binning, enrich, evaluate, ml, panel, project, spatial, topk, windows
from areapanel.sources import tables
from areapanel.streaming import jobs

D = dt.date


def one(df):
    return tuple(df.first())


def test_keys(spark):
    df = spark.createDataFrame([("06075010101",), ("6075010101",), ("060750101011",), ("1400000US06075010101",), ("6.0750101e9",), ("abc",), (None,)], "k string")
    got = [r[0] for r in df.select(keys.normalize_key("k", 11)).collect()]
    assert got == ["06075010101", "06075010101", "06075010101", "00001400000", "00000000006", None, None]
    assert [r[0] for r in df.select(keys.normalize_key("k", 11, mode="all_digits", side="right")).collect()][3] == "06075010101"
    assert [r[0] for r in df.select(keys.normalize_key("k", 11, mode="number")).collect()][4] == "06075010100"


def test_hour_labels(spark):
    df = spark.createDataFrame([("21-24", 21), ("21-00", 21), ("9 - 12", 9), ("21–24", 21), ("x", None), (None, None)], "t string, want int")
    assert all(r.got == r.want for r in df.withColumn("got", keys.parse_hour_label("t")).collect())


def test_holidays(spark):
    days = {r.date for r in calendar.us_federal_holidays(spark, 2022, 2023).collect()}
    assert {D(2022, 12, 26), D(2022, 6, 20), D(2023, 11, 23), D(2023, 1, 2), D(2023, 5, 29)} <= days


def test_windows_stay_in_their_area(spark):
    df = spark.createDataFrame([("a", D(2024, 1, 1), 1), ("a", D(2024, 1, 2), 2), ("a", D(2024, 1, 5), 4), ("b", D(2024, 1, 3), 8)], "area_id string, date date, n int")
    rows = windows.prior_rows_sum(df, "n", 3, ["area_id"], "date", "p")
    assert {(r.area_id, r.date.day): r.p for r in rows.collect()} == {("a", 1): None, ("a", 2): 1, ("a", 5): 3, ("b", 3): None}
    days = windows.prior_days_sum(df, "n", 3, ["area_id"], "date", "p")
    assert {(r.area_id, r.date.day): r.p for r in days.collect()} == {("a", 1): 0, ("a", 2): 1, ("a", 5): 2, ("b", 3): 0}
    dense = panel.densify(df, ["area_id"], "date", ["n"])
    assert dense.count() == 6 and dense.where("n = 0").count() == 2


def test_no_leak_from_later_days(spark):
    base = [("a", D(2024, 1, k), k) for k in range(1, 10)]
    before = windows.prior_rows_sum(spark.createDataFrame(base, "area_id string, date date, n int"), "n", 3, ["area_id"], "date", "p").where("date <= '2024-01-05'")
    changed = [(a, d, n * 100 if d.day >= 5 else n) for a, d, n in base]
    after = windows.prior_rows_sum(spark.createDataFrame(changed, "area_id string, date date, n int"), "n", 3, ["area_id"], "date", "p").where("date <= '2024-01-05'")
    assert [r.p for r in before.orderBy("date").collect()] == [r.p for r in after.orderBy("date").collect()]


def test_decile_edges(spark):
    for n in (1, 2, 7, 10, 11, 119):
        df = spark.createDataFrame([(float(i // 2), i) for i in range(n)], "s double, k int")
        got = sorted(r.decile for r in windows.decile(df, "s", "k").collect())
        assert got[0] == 1 and got[-1] == (10 if n > 1 else 1) and len(got) == n


def test_polygon_with_a_hole(spark):
    def ring(area, pts):
        return [(area, *a, *b) for a, b in zip(pts, pts[1:] + pts[:1])]

    edges = spark.createDataFrame(ring("A", [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]) + ring("A", [(0.4, 0.4), (0.6, 0.4), (0.6, 0.6), (0.4, 0.6)]) + ring("B", [(1.0, 0.0), (2.0, 0.0), (2.0, 1.0), (1.0, 1.0)]), "area_id string, x1 double, y1 double, x2 double, y2 double")
    pts = spark.createDataFrame([(1, 0.2, 0.2), (2, 0.5, 0.5), (3, 0.5, 1.5), (4, 5.0, 5.0)], "point_id int, lat double, lon double")
    assert {r.point_id: r.area_id for r in spatial.tag_areas(pts, edges, 0.1).collect()} == {1: "A", 2: None, 3: "B", 4: None}
    assert {tuple(r) for r in spatial.build_adjacency(edges).collect()} == {("A", "B"), ("B", "A")}


def test_radius_across_a_cell_border(spark):
    src = spark.createDataFrame([(1, 37.7, -122.5)], "src_id int, lat double, lon double")
    dst = spark.createDataFrame([(1, 37.7 + 299 / 111194.9, -122.5), (2, 37.7 - 301 / 111194.9, -122.5)], "dst_id int, dst_lat double, dst_lon double")
    assert one(spatial.count_within(src, dst, [300, 302])) == (1, 1, 2)
    few = spatial.nearest_distance(src, dst)
    many = spatial.nearest_distance(src, dst, most=1)
    assert one(few) == one(many)


def test_bins(spark):
    same = spark.createDataFrame([(5.0,)] * 4 + [(None,)], "x double")
    assert one(binning.fd_bins(same, "x")) == (1,)
    assert {r.x_range for r in binning.quantile_range(same, "x", style="q").collect()} == {"Unknown"}
    assert {r.bin for r in binning.equal_width(same, "x").collect()} == {1, None}
    assert {r.scaled for r in binning.scale_to(same, "x").collect()} == {1.5}


def test_metrics_of_edges(spark):
    for scores, auc in (([0.1, 0.2, 0.8, 0.9], 1.0), ([0.9, 0.8, 0.2, 0.1], 0.0), ([0.5] * 4, 0.5)):
        df = spark.createDataFrame(list(zip([0, 0, 1, 1], scores)), "label int, score double")
        assert one(evaluate.roc_auc(df)) == (auc,)
    none = spark.createDataFrame([(1, 0.5)], "label int, score double")
    assert one(evaluate.roc_auc(none)) == (None,)
    assert one(evaluate.class_weight(none)) == (1, 0, 0.0)


def test_join_traps(spark):
    a = spark.createDataFrame([(None, 1), ("k", 2)], "k string, v int")
    b = spark.createDataFrame([(None, 10), ("k", 20)], "k string, w int")
    assert enrich.enrich(a, b, ["k"]).where("k is null").first().w is None
    assert enrich.enrich(a, b, ["k"], null_safe=True).where("k is null").first().w == 10
    with pytest.raises(ValueError):
        enrich.enrich_static(a, b.union(b), ["k"])


def test_upsert_keeps_last_and_retention(spark):
    base = spark.createDataFrame([("a", D(2024, 1, 1), 1, 0), ("b", D(2024, 1, 9), 1, 0)], "k string, date date, n int, v int")
    inc = spark.createDataFrame([("b", D(2024, 1, 9), 7, 1)], "k string, date date, n int, v int")
    assert [tuple(r)[0::2] for r in topk.upsert(base, inc, ["k"], ["v"], "date", 5).collect()] == [("b", 7)]


def test_text_and_percent(spark):
    df = spark.createDataFrame([(0.125,), (0.135,), (0.5,)], "x double")
    assert [r[0] for r in df.select(numbers.percent_text(F.col("x"))).collect()] == ["12%", "14%", "50%"]
    assert one(spark.range(1).select(numbers.to_num(F.lit(" 1,234.5 ")), numbers.to_flag(F.lit("Evet")), numbers.finite(F.lit(float("inf"))))) == (1234.5, 1, None)


def test_empty_frames(spark):
    e = spark.createDataFrame([], "event_id long, area_id string, ts timestamp_ntz, date date, hour int, category string, value double")
    assert panel.daily_panel(e).count() == 0
    assert aggregate.call_summary(e).count() == 0
    assert aggregate.category_mix(e, ["area_id"]).count() == 0
    assert windows.decile(e, "value", "event_id").count() == 0
    assert binning.quantile_range(e, "value").count() == 0
    assert project.adaptive_window(e.withColumn("label", F.lit(1)), [1, 2], 1).count() == 0


def test_sources(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,v\n007,1\n,2\n")
    assert [r.k for r in tables.read_table(spark, str(tmp_path / "a.csv"), columns=["k", "z"]).collect()] == ["007", None]
    feature = '{"type":"Feature","properties":{"GEOID":"1"},"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}}'
    (tmp_path / "c.geojson").write_text('{"type":"FeatureCollection","features":[%s]}' % feature)
    (tmp_path / "l.geojson").write_text(feature + "\n" + feature.replace('"1"', '"2"') + "\n")
    assert tables.polygon_edges(tables.read_geojson(spark, str(tmp_path / "c.geojson")), "GEOID").count() == 3
    assert {r[0]["GEOID"] for r in tables.read_geojson(spark, str(tmp_path / "l.geojson")).collect()} == {"1", "2"}
    (tmp_path / "gtfs").mkdir()
    (tmp_path / "gtfs" / "stops.txt").write_text("stop_id, stop_lat ,stop_lon\n1,37.5,-122\n")
    assert tables.read_gtfs_stops(spark, str(tmp_path / "gtfs")).first().stop_lat == 37.5
    df = spark.createDataFrame([(D(2024, 1, 1), 1), (D(2024, 2, 1), 2)], "date date, n int")
    path = str(tmp_path / "panel")
    tables.write_panel(df, path)
    tables.write_panel(df.withColumn("n", F.lit(9)), path)
    assert sorted(r.n for r in spark.read.parquet(path).collect()) == [1, 2]
    tables.write_panel(df.where("n = 2").withColumn("n", F.lit(9)), path, mode="overwrite")
    assert sorted(r.n for r in spark.read.parquet(path).collect()) == [1, 9]
    with pytest.raises(FileNotFoundError):
        tables.read_first(spark, [str(tmp_path / "none")])
    assert tables.read_first(spark, [str(tmp_path / "none"), path]).count() == 2


def haversine_m(a, b):
    (p, x), (q, y) = ((math.radians(v) for v in c) for c in (a, b))
    return 2 * 6371000.0 * math.asin(math.sqrt(min(1.0, math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin((y - x) / 2) ** 2)))


@pytest.mark.parametrize("lat, lon, spread, radius", [(72, 10, 0.05, 1000), (-72, 179.99, 0.05, 1500), (89.9, 0, 180, 9000), (0, -179.999, 0.02, 800), (37.7, -122.4, 0.02, 500), (10, 20, 60, 3_000_000)])
def test_near_pairs_at_every_latitude(spark, lat, lon, spread, radius):
    rnd = random.Random(3)
    place = lambda: (min(90.0, max(-90.0, lat + rnd.uniform(-0.03, 0.03) * (1 if spread <= 1 or lat > 80 else 500))), (lon + rnd.uniform(-spread, spread) + 180) % 360 - 180)
    a, b = [place() for _ in range(90)], [place() for _ in range(90)]
    src = spark.createDataFrame([(i, *p) for i, p in enumerate(a)] + [(900, None, 1.0)], "src_id int, lat double, lon double")
    dst = spark.createDataFrame([(i, *p) for i, p in enumerate(b)] + [(901, 1.0, None)], "dst_id int, dst_lat double, dst_lon double")
    got = sorted((r.src_id, r.dst_id) for r in spatial.near_pairs(src, dst, radius).collect())
    want = sorted((i, j) for i, p in enumerate(a) for j, q in enumerate(b) if haversine_m(p, q) <= radius)
    assert got == want and want


@pytest.mark.parametrize("metric", ["haversine", "webmercator"])
def test_nearest_either_way(spark, metric):
    rnd = random.Random(4)
    src = spark.createDataFrame([(i, rnd.uniform(-80, 80), rnd.uniform(-180, 180)) for i in range(60)] + [(900, None, 1.0), (901, 5.0, None)], "src_id int, lat double, lon double")
    dst = spark.createDataFrame([(i, rnd.uniform(-80, 80), rnd.uniform(-180, 180)) for i in range(50)] + [(70, 3.0, 3.0), (71, 3.0, 3.0), (72, None, 3.0)], "dst_id int, dst_lat double, dst_lon double")
    small, large = (sorted(map(tuple, spatial.nearest(src, dst, metric, most=m).collect())) for m in (1000, 5))
    assert small == large and len(small) == 62 and [r for r in small if r[1] is None] == [(900, None, None), (901, None, None)]
    nothing = dst.where("false")
    assert {r.distance for r in spatial.nearest_distance(src, nothing).collect()} == {None}


def test_nearest_fallback(spark):
    square = lambda name, x, y: [(name, x, y, x + 1, y), (name, x + 1, y, x + 1, y + 1), (name, x + 1, y + 1, x, y + 1), (name, x, y + 1, x, y)]
    edges = spark.createDataFrame([(n, *map(float, e)) for n, *e in square("a", 0, 0) + square("b", 5, 0)], "area_id string, x1 double, y1 double, x2 double, y2 double")
    points = spark.createDataFrame([(1, 0.5, 0.5), (2, 0.5, 2.0), (3, 0.5, 4.0), (4, None, 1.0)], "point_id int, lat double, lon double")
    tagged = lambda **k: {r.point_id: r.area_id for r in spatial.tag_areas(points, edges, cell=0.5, **k).collect()}
    assert tagged() == {1: "a", 2: None, 3: None, 4: None}
    assert tagged(nearest_fallback=True) == {1: "a", 2: "a", 3: "b", 4: None}


def test_columns_by_name_and_type(spark):
    df = spark.createDataFrame([(1, 300, 1 << 40, None, "x")], "`a b` int, `a-b` int, big long, none int, lat_GEO string")
    assert project.sanitize_columns(df).columns == ["a_b", "a_b_dup1", "big", "none", "lat_GEO"]
    assert project.drop_by_pattern(df, "geo$|^none$").columns == ["a b", "a-b", "big"]
    assert project.select_features(df, ["big", "gone", "a b"], ("none", "big")).columns == ["none", "big", "a b"]
    assert dict(project.compact_types(project.sanitize_columns(df)).dtypes) == {"a_b": "tinyint", "a_b_dup1": "smallint", "big": "bigint", "none": "int", "lat_GEO": "string"}
    many = spark.range(500).withColumnRenamed("id", "k")
    one, two = (sorted(r.k for r in topk.sample_n(many.repartition(n), 50, 1, "k").collect()) for n in (2, 5))
    assert one == two and len(one) == 50 and topk.sample_n(many, 900, 1, "k").count() == 500


def test_side_outputs(spark, tmp_path):
    tables.write_json_row(spark.createDataFrame([(3, 0.5)], "k int, threshold double"), f"{tmp_path}/best")
    assert [tuple(r) for r in spark.read.json(f"{tmp_path}/best").select("k", "threshold").collect()] == [(3, 0.5)]
    tables.write_manifest(spark, [{"run": "a", "rows": 1}], f"{tmp_path}/manifest")
    rows = tables.write_manifest(spark, [{"run": "b", "rows": 2, "note": "x"}], f"{tmp_path}/manifest")
    assert sorted((r.run, r.rows, r.note) for r in rows.collect()) == [("a", 1, None), ("b", 2, "x")]
    (tmp_path / "pages").mkdir()
    for name, page in (("1.json", [{"id": 1}, {"id": 2}]), ("2.json", [{"id": 3, "more": "y"}])):
        (tmp_path / "pages" / name).write_text(json.dumps(page, indent=1))
    got = tables.read_landing(spark, f"{tmp_path}/pages")
    assert sorted((r.id, r.more, r.source_file) for r in got.collect()) == [(1, None, "1.json"), (2, None, "1.json"), (3, "y", "2.json")]


@pytest.fixture(scope="module")
def signal(spark):
    """Rows whose label follows ``x`` and nothing else."""
    rnd = random.Random(5)
    day = dt.date(2024, 1, 1)
    rows = []
    for i in range(600):
        x, noise, other = rnd.random(), rnd.random(), rnd.random()
        rows.append((i % 12, day + dt.timedelta(i // 12), x, noise, other, int(x + rnd.gauss(0, 0.05) > 0.6)))
    return spark.createDataFrame(rows, "area_id int, date date, x double, noise double, other double, label int").cache()


def test_stack_finds_the_signal_and_survives_saving(spark, signal, tmp_path):
    stages = ml.preprocessor(["x", "noise"], ["other"], [])
    models = {k: v for k, v in ml.base_models().items() if k in ("lr", "rf", "gbt")}
    stack = ml.fit_stack(signal, stages, models, 2, ["area_id", "date"])
    scored = stack.score(signal)
    m = ml.model_metrics(scored).first().asDict()
    assert m["roc_auc"] > 0.95 and m["average_precision"] > 0.9 and 0 < stack.threshold < 1
    assert scored.count() == 600 and scored.where("score < 0 or score > 1 or score is null").count() == 0
    stack.save(f"{tmp_path}/stack")
    again = ml.Stack.load(f"{tmp_path}/stack", list(models), stack.threshold)
    one, two = (sorted((r.area_id, r.date, round(r.score, 9)) for r in s.score(signal).collect()) for s in (stack, again))
    assert one == two
    losses = ml.permutation_importance(stack.score, signal, ["x", "noise"], "x", repeats=1)
    assert losses[0][0] == "x" and losses[0][1] > 0.2 > abs(losses[1][1])


def test_selection(spark, signal):
    ranked, chosen = ml.supervised_rank(signal, ["noise", "x", "other"], ["area_id", "date"], trees=10)
    assert ranked[0][0] == "x" and abs(sum(v for _, v in ranked) - 1) < 0.01 and chosen[0] == "x" and len(chosen) <= 3
    names = [c for c, _ in ranked]
    gain = lambda df, some: {1: 0.5, 2: 0.9, 3: 0.9}[len(some)]
    assert ml.forward_select(signal, names, gain) == [(1, 0.5), (2, 0.9), (3, 0.9)]
    assert ml.select_k(signal, names, gain, range(1, 10)) == (2, 0.9)
    groups = signal.withColumn("x", F.round("x") * 10)
    assert ml.unsupervised_rank(groups, ["x", "noise"])[0][0] == "x"


def test_types_and_horizons(spark, signal):
    facts = signal.withColumn("category", F.when(F.col("x") > 0.5, "high").otherwise("low")).withColumn("score", F.lit(0.4))
    out = ml.type_risk(ml.type_model(facts, ["x", "noise"]), facts)
    assert out.where(F.abs(F.col("risk_high") + F.col("risk_low") - 0.4) > 1e-6).count() == 0
    assert out.where((F.col("risk_high") > F.col("risk_low")) != (F.col("category") == "high")).count() < 60
    led = signal.withColumn("ahead", F.col("label"))
    models = ml.horizon_models(led, ["x", "noise"], [1, 7], ["area_id"], "date")
    scored = ml.score_horizons(led, models, ["x", "noise"], ["area_id", "date"])
    assert scored.count() == 1200 and {r.horizon for r in scored.select("horizon").distinct().collect()} == {1, 7}
    assert scored.where("score < 0 or score > 1").count() == 0


def test_stratified_split(spark, signal):
    s = evaluate.stratified_split(signal.withColumn("k", F.monotonically_increasing_id()), "label", 0.25, 3, "k")
    shares = {r.label: r.share for r in s.groupBy("label").agg(F.avg((F.col("split") == "test").cast("int")).alias("share")).collect()}
    assert set(shares) == {0, 1} and all(0.15 < v < 0.35 for v in shares.values())


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_in_ranges(spark, descending):
    rnd = random.Random(3)
    some = [None, math.nan, math.inf, -math.inf, 0.0, 1e300, 5.0]
    for scores in ([], [2.5], some, some[:2], [rnd.lognormvariate(0, 3) for _ in range(500)], [rnd.random() for _ in range(500)] + [None, math.nan]):
        rows = [(x, rnd.randint(0, 9), 1) for x in scores]
        place = lambda x: (-1, 0.0) if x is None else (1, 0.0) if math.isnan(x) else (0, x)
        df = spark.createDataFrame(rows, "s double, p long, c long")
        got = windows.running_totals(df, "s", {"sp": "p", "sc": "c"}, descending, buckets=16).collect()
        assert len(got) == len(rows)
        for r in got:
            upto = [x for x in rows if (place(x[0]) >= place(r.s) if descending else place(x[0]) <= place(r.s))]
            assert (r.sp, r.sc) == (sum(x[1] for x in upto), len(upto))


def test_ema_of_gaps(spark):
    values = {"a": [None, 2.0, None, 4.0, 1.0], "b": [3.0], "c": [None]}
    df = spark.createDataFrame([(k, i, v) for k, vs in values.items() for i, v in enumerate(vs)], "k string, i int, v double")
    got = {(r.k, r.i): r for r in windows.ema(df, "v", [0.3, 1.0], ["k"], "i").collect()}
    assert len(got) == 7
    for k, vs in values.items():
        last = None
        for i, v in enumerate(vs):
            last = last if v is None else v if last is None else 0.3 * v + 0.7 * last
            r = got[k, i]
            assert r.v == v and (r.ema_0_3 is None if last is None else abs(r.ema_0_3 - last) < 1e-12)
    assert windows.ema(df.limit(0), "v", [0.5], ["k"], "i").count() == 0


def test_upsert_stream_rewrites_touched_buckets(spark, tmp_path):
    rnd, want = random.Random(5), {}
    table, log = f"{tmp_path}/table", f"{tmp_path}/log"
    for turn in range(5):
        rows = [(rnd.randint(0, 40), 100 * turn + k) for k in range(6 if turn else 60)]
        for k, n in rows:
            want[k] = max(n, want.get(k, n))
        spark.createDataFrame(rows, "k int, n int").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema("k int, n int").parquet(f"{tmp_path}/in")
        jobs.upsert_stream(stream, table, ["k"], ["n"], log, buckets=8).trigger(availableNow=True).start().awaitTermination()
        now = jobs.current(spark, table)
        assert now.columns == ["k", "n"] and {r.k: r.n for r in now.collect()} == want and now.count() == len(want)
    kept = [b.name for v in (tmp_path / "table").iterdir() for b in v.iterdir() if b.name.startswith("_bucket=")]
    assert max(kept.count(b) for b in kept) == 2
    assert jobs.current(spark, table, 0) is None
