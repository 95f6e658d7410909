"""Risk tables, evaluation, models, forecasts, sources, streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numbers
from ..operators import aggregate, binning, clean, evaluate, forecast, ml, panel, project, risk, spatial, topk, windows
from ..shared import new_path, save
from ..sources import tables
from ..streaming import jobs
from .features import _HAV, _dst, _src
from .registry import CE, DP, ED, EV, PO, cell_edges, dated, events, pois, query, rounded, table, user_edges

# --- risk ------------------------------------------------------------------------------------------------------

_BASE = "dd AS (SELECT count(DISTINCT date) AS d, count(DISTINCT area_id) AS a FROM ev), fine AS (SELECT area_id, hour, count(*) / any_value(d) AS rate FROM ev, dd GROUP BY area_id, hour), coarse AS (SELECT hour, count(*) / any_value(d) / any_value(a) AS rate FROM ev, dd GROUP BY hour)"


@query(f"WITH {EV}, {_BASE} SELECT area_id, hour, round(rate, 9) AS rate, round(1 - exp(-rate), 9) AS p_base FROM fine UNION ALL SELECT 'all', hour, round(rate, 9), round(1 - exp(-rate), 9) FROM coarse")
def r01_poisson_baseline(spark, d):
    fine, coarse = risk.poisson_baseline(events(spark, d))
    return rounded(fine.select("area_id", "hour", "rate", "p_base").unionByName(coarse.select(F.lit("all").alias("area_id"), "hour", "rate", "p_base")), 9)


@query(f"WITH {EV}, l AS (SELECT event_id, least(greatest(score, 1e-9::DOUBLE), 1 - 1e-9::DOUBLE) AS p FROM ev), t AS (SELECT event_id, power(1 / (1 + exp(-ln(p / (1 - p)) / 1.5::DOUBLE)), 1.2::DOUBLE) AS s FROM l) SELECT event_id, round(least(greatest(least(s, (SELECT quantile_cont(s, 0.99) FROM t)), 0.01::DOUBLE), 0.99::DOUBLE), 6) AS score FROM t")
def r02_calibrate(spark, d):
    return rounded(risk.calibrate(events(spark, d).select("event_id", "score"), "score", "temp_power", 1.5, 1.2, 0.99, 0.01, 0.99))


_EXP = "coalesce(f.rate, c.rate, 0) * least(greatest(coalesce(score / nullif(1 - exp(-coalesce(f.rate, c.rate, 0)), 0), 1), 0.2::DOUBLE), 3.0::DOUBLE)"


@query(f"WITH {EV}, {_BASE} SELECT event_id, round({_EXP}, 6) AS expected_count FROM ev LEFT JOIN fine f ON f.area_id = ev.area_id AND f.hour = ev.hour LEFT JOIN coarse c ON c.hour = ev.hour")
def r03_expected_count(spark, d):
    e = events(spark, d)
    return rounded(risk.expected_count(e, *risk.poisson_baseline(e)).select("event_id", "expected_count"))


@query(f"WITH {EV}, {_BASE}, m AS (SELECT event_id, 0.7::DOUBLE * score + 0.3::DOUBLE * (1 - exp(-rate)) AS s FROM ev JOIN fine USING (area_id, hour)) SELECT event_id, round(s, 6) AS shrunk, round(0.05::DOUBLE + 0.9::DOUBLE * (rank() OVER (ORDER BY round(s, 9)) + (count(*) OVER (PARTITION BY round(s, 9)) - 1) / 2.0) / count(*) OVER (), 6) AS rescaled FROM m")
def r04_shrink_to_base(spark, d):
    e = events(spark, d)
    fine, _ = risk.poisson_baseline(e)
    s = e.join(fine.select("area_id", "hour", "p_base"), ["area_id", "hour"]).select("event_id", risk.shrink_to_base(F.col("score"), F.col("p_base")).alias("shrunk"))
    ranked = windows.rank_pct(s.withColumn("_s", F.round("shrunk", 9)), "_s", "r")
    return rounded(ranked.select("event_id", "shrunk", risk.rescale(F.col("r")).alias("rescaled")))


@query(f"WITH {EV}, r AS (SELECT area_id, hour, count(*) / 30.0::DOUBLE AS rate FROM ev GROUP BY ALL), c AS (SELECT area_id, category, count(*) AS n FROM ev GROUP BY ALL), s AS (SELECT *, n / sum(n) OVER (PARTITION BY area_id) AS share, CAST(row_number() OVER (PARTITION BY area_id ORDER BY n DESC, category) AS INTEGER) AS rank FROM c) SELECT area_id, hour, rank, category, round(rate * share, 6) AS category_expected, round(1 - exp(-rate * share), 6) AS category_chance FROM r JOIN s USING (area_id) WHERE rank <= 3")
def r05_top_category_risk(spark, d):
    e = events(spark, d)
    r = e.groupBy("area_id", "hour").agg((F.count(F.lit(1)) / 30.0).alias("expected_count"))
    return rounded(risk.top_category_risk(r, e, ["area_id"]).select("area_id", "hour", "rank", "category", "category_expected", "category_chance"))


_HOURLY = f"""{EV}, {_BASE}, h AS (SELECT area_id, date, hour, arg_max(score, event_id) AS score, max(event_id) AS event_id FROM ev GROUP BY area_id, date, hour), q AS (SELECT quantile_cont(score, 0.8) AS a, quantile_cont(score, 0.9) AS b FROM h),
 r AS (SELECT *, row_number() OVER (ORDER BY score, event_id) AS k, count(*) OVER () AS n FROM h)"""


@dated(f"WITH {_HOURLY} SELECT r.area_id, date, r.hour, round(score, 6) AS score, CASE WHEN score >= 0.66 THEN 'critical' WHEN score >= b THEN 'high' WHEN score >= a THEN 'medium' ELSE 'low' END AS level, CAST(greatest(1, (10 * (k - 1) + n - 2) // (n - 1)) AS INTEGER) AS decile, round({_EXP}, 6) AS expected_count FROM r CROSS JOIN q LEFT JOIN fine f ON f.area_id = r.area_id AND f.hour = r.hour LEFT JOIN coarse c ON c.hour = r.hour")
def r06_hourly_risk(spark, d):
    e = events(spark, d)
    return rounded(risk.hourly_risk(e.select("event_id", "area_id", "date", "hour", "score"), e, 0.66).select("area_id", "date", "hour", "score", "level", "decile", "expected_count"))


@dated(f"WITH {EV}, x AS (SELECT area_id, date, round(1 - product(1 - score), 12) AS s, sum(score) AS t FROM ev GROUP BY ALL), q AS (SELECT quantile_cont(s, 0.8) AS a, quantile_cont(s, 0.9) AS b FROM x) SELECT area_id, date, round(s, 6) AS any_score, round(t, 6) AS sum_score, CASE WHEN s >= 0.97 THEN 'critical' WHEN s >= b THEN 'high' WHEN s >= a THEN 'medium' ELSE 'low' END AS level FROM x, q")
def r07_daily_risk(spark, d):
    x = aggregate.daily_from_hourly(events(spark, d), ["area_id", "date"]).withColumn("any_score", F.round("any_score", 12))
    return rounded(binning.risk_level(x, "any_score", 0.97).select("area_id", "date", "any_score", "sum_score", "level"))


@query(f"WITH {_HOURLY}, t AS (SELECT area_id, hour, score, CAST(row_number() OVER (PARTITION BY hour ORDER BY score DESC, area_id) AS INTEGER) AS rank FROM h WHERE date = (SELECT max(date) FROM h)) SELECT area_id, hour, round(score, 6) AS score, rank FROM t WHERE rank <= 50")
def r08_priority_list(spark, d):
    e = events(spark, d)
    hourly = risk.hourly_risk(e.select("event_id", "area_id", "date", "hour", "score"), e, 0.66)
    return rounded(topk.top_slots(hourly, 50).select("area_id", "hour", "score", "rank"))


@query(f"WITH {EV}, {PO}, c AS (SELECT poi_id, any_value(poi_type) AS poi_type, count(CASE WHEN {_HAV('po', 'ev')} <= 300 THEN 1 END) AS n FROM po CROSS JOIN ev GROUP BY poi_id), t AS (SELECT poi_type, avg(n) AS m FROM c GROUP BY ALL) SELECT poi_type, round((m - min(m) OVER ()) / (max(m) OVER () - min(m) OVER ()) * 3, 2) AS risk FROM t")
def r09_poi_type_risk(spark, d):
    p = _dst(spark, d).select(F.col("dst_id").alias("src_id"), F.col("dst_lat").alias("lat"), F.col("dst_lon").alias("lon"), "poi_type")
    e = _src(spark, d).select(F.col("src_id").alias("dst_id"), F.col("lat").alias("dst_lat"), F.col("lon").alias("dst_lon"))
    n = spatial.count_within(p, e, [300]).join(p.select("src_id", "poi_type"), "src_id").groupBy("poi_type").agg(F.avg("within_300").alias("m"))
    return rounded(binning.scale_to(n, "m").select("poi_type", F.col("scaled").alias("risk")), 2)


_RANGE = "CASE WHEN len({e}) < 2 THEN CAST(CAST(trunc({e}[1]) AS INTEGER) AS VARCHAR) ELSE CAST(CAST(trunc({e}[{b}]) AS INTEGER) AS VARCHAR) || '-' || CAST(CAST(trunc({e}[{b} + 1]) AS INTEGER) AS VARCHAR) END".format
_EDGES = "list_sort(list_distinct(quantile_cont({c}, [0, 0.2, 0.4, 0.6, 0.8, 1.0])))".format
_BIN = "greatest(1, len(list_filter({e}, lambda x: x < {c})))".format


@dated(f"""WITH {_HOURLY}, x AS (SELECT r.area_id, date, r.hour, score, {_EXP} AS e FROM r LEFT JOIN fine f ON f.area_id = r.area_id AND f.hour = r.hour LEFT JOIN coarse c ON c.hour = r.hour),
 ct AS (SELECT area_id, category, count(*) AS n FROM ev GROUP BY ALL), sh AS (SELECT *, n / sum(n) OVER (PARTITION BY area_id) AS share, row_number() OVER (PARTITION BY area_id ORDER BY n DESC, category) AS place FROM ct),
 ts AS (SELECT area_id, date, category, sum(e * share) AS lam FROM x JOIN sh USING (area_id) WHERE place <= 3 GROUP BY ALL), tr AS (SELECT *, row_number() OVER (PARTITION BY area_id, date ORDER BY round(lam, 12) DESC, category) AS k FROM ts),
 w AS (SELECT area_id, date, max(CASE WHEN k = 1 THEN category END) AS top1, max(CASE WHEN k = 1 THEN lam END) AS l1, max(CASE WHEN k = 2 THEN category END) AS top2, max(CASE WHEN k = 2 THEN lam END) AS l2, max(CASE WHEN k = 3 THEN category END) AS top3, max(CASE WHEN k = 3 THEN lam END) AS l3 FROM tr GROUP BY ALL),
 dy AS (SELECT area_id, date, round(1 - product(1 - score), 12) AS s, sum(e) AS e FROM x GROUP BY ALL), qd AS (SELECT quantile_cont(s, 0.8) AS a, quantile_cont(s, 0.9) AS b FROM dy), rk AS (SELECT *, row_number() OVER (ORDER BY s, area_id || '|' || CAST(date AS VARCHAR)) AS k, count(*) OVER () AS n FROM dy)
 SELECT area_id, date, round(s, 6) AS any_score, round(e, 6) AS expected_count, CASE WHEN s >= greatest(0.66::DOUBLE, qd.b) THEN 'critical' WHEN s >= greatest(0.8::DOUBLE * 0.66::DOUBLE, qd.a) THEN 'high' WHEN s >= 0.33::DOUBLE THEN 'medium' ELSE 'low' END AS level, CAST(greatest(1, (10 * (k - 1) + n - 2) // (n - 1)) AS INTEGER) AS decile,
 top1, round(l1, 6) AS top1_expected, round(1 - exp(-l1), 6) AS top1_chance, top2, round(l2, 6) AS top2_expected, round(1 - exp(-l2), 6) AS top2_chance, top3, round(l3, 6) AS top3_expected, round(1 - exp(-l3), 6) AS top3_chance
 FROM rk CROSS JOIN qd LEFT JOIN w USING (area_id, date)""")
def r07_daily_risk_table(spark, d):
    """The hourly risk table rolled up to days: level, decile, and the day's three likeliest categories."""
    e = events(spark, d)
    hourly = risk.hourly_risk(e.select("event_id", "area_id", "date", "hour", "score"), e, 0.66)
    types = risk.top_category_risk(hourly, e, ["area_id"])
    return rounded(risk.daily_risk(hourly, 0.66, types))


@query(f"""WITH {EV}, {PO}, tr AS (SELECT poi_type, avg(weight) AS risk FROM po WHERE CAST(poi_type AS INTEGER) % 5 > 0 GROUP BY poi_type),
 ar AS (SELECT 'cell_' || r || '_' || c AS area_id, 37.70::DOUBLE + r * 0.01::DOUBLE + 0.005::DOUBLE AS lat, -122.51::DOUBLE + c * 0.01::DOUBLE + 0.005::DOUBLE AS lon FROM range(10) x(r) CROSS JOIN range(12) y(c)),
 pl AS (SELECT po.*, 'cell_' || CAST(floor((lat - 37.70::DOUBLE) * 100 + 1e-9) AS INTEGER) || '_' || CAST(floor((lon + 122.51::DOUBLE) * 100 + 1e-9) AS INTEGER) AS area_id, coalesce(risk, 0) AS risk FROM po LEFT JOIN tr USING (poi_type)),
 ins AS (SELECT area_id, count(*) AS n, sum(risk) AS s FROM pl GROUP BY area_id), md AS (SELECT area_id, arg_min(poi_type, (-n, poi_type)) AS kind FROM (SELECT area_id, poi_type, count(*) AS n FROM pl GROUP BY ALL) GROUP BY area_id),
 b AS (SELECT ar.area_id, coalesce(n, 0) AS n, coalesce(s, 0) AS s, coalesce(kind, 'No_POI') AS kind FROM ar LEFT JOIN ins USING (area_id) LEFT JOIN md USING (area_id)),
 e AS (SELECT {_EDGES(c="n")} AS en, {_EDGES(c="s")} AS es, min(n) AS lo, max(n) AS hi FROM b),
 rd AS (SELECT ar.area_id, count(CASE WHEN {_HAV('ar', 'pl')} <= 300 THEN 1 END) AS within_300, count(CASE WHEN {_HAV('ar', 'pl')} <= 900 THEN 1 END) AS within_900, coalesce(sum(CASE WHEN {_HAV('ar', 'pl')} <= 300 THEN risk END), 0) AS sum_300, coalesce(sum(CASE WHEN {_HAV('ar', 'pl')} <= 900 THEN risk END), 0) AS sum_900 FROM ar CROSS JOIN pl GROUP BY ar.area_id)
 SELECT area_id, n AS poi_count, round(s, 4) AS poi_risk, kind AS poi_type, {_RANGE(e="en", b=_BIN(e="en", c="n"))} AS poi_count_range, {_RANGE(e="es", b=_BIN(e="es", c="s"))} AS poi_risk_range, CASE WHEN hi = lo THEN 1 ELSE CAST(greatest(1, ceil((n - lo) / (hi - lo) * 5)) AS INTEGER) END AS poi_count_class,
 within_300, within_900, round(sum_300, 4) AS sum_300, round(sum_900, 4) AS sum_900 FROM b CROSS JOIN e JOIN rd USING (area_id)""")
def r10_place_features(spark, d):
    """Square areas: places in them, the commonest type, ranges, and what lies within two radii of their middles."""
    p = table(spark, d, "supplier").select(F.col("s_suppkey").alias("poi_id")).join(pois(spark, d), "poi_id")
    name = lambda r, c: F.concat_ws("_", F.lit("cell"), r, c)
    cell = lambda c, low: F.floor((F.col(c) - low) * 100 + 1e-9).cast("int")
    places = p.withColumn("area_id", name(cell("lat", 37.70), cell("lon", -122.51)))
    grid = spark.range(0, 120, 1, 1).select((F.col("id") / 12).cast("int").alias("r"), (F.col("id") % 12).cast("int").alias("c"))
    areas = grid.select(name(F.col("r"), F.col("c")).alias("area_id"), (F.lit(37.70) + F.col("r") * F.lit(0.01) + 0.005).alias("lat"), (F.lit(-122.51) + F.col("c") * F.lit(0.01) + 0.005).alias("lon"))
    ratings = p.where(F.col("poi_type").cast("int") % 5 > 0).groupBy("poi_type").agg(F.avg("weight").alias("risk"))
    return rounded(risk.place_features(places, ratings, areas, [300, 900]), 4)


@query(f"WITH {EV}, {PO}, a AS (SELECT area_id, avg(lat) AS lat, avg(lon) AS lon FROM ev GROUP BY area_id) SELECT area_id, count(CASE WHEN {_HAV('a', 'po')} <= 500 THEN 1 END) AS poi_count, round(coalesce(sum(CASE WHEN {_HAV('a', 'po')} <= 500 THEN weight END), 0), 4) AS poi_risk FROM a CROSS JOIN po GROUP BY area_id")
def r10_poi_features(spark, d):
    a = spatial.event_centroids(events(spark, d)).withColumnRenamed("area_id", "src_id")
    return rounded(spatial.count_within(a, _dst(spark, d), [500], "weight").select(F.col("src_id").alias("area_id"), F.col("within_500").alias("poi_count"), F.col("sum_500").alias("poi_risk")), 4)


@query(f"WITH {EV}, {PO}, a AS (SELECT area_id, avg(lat) AS lat, avg(lon) AS lon FROM ev GROUP BY area_id), n AS (SELECT area_id, round(min({_HAV('a', 'po')}), 1) AS distance FROM a CROSS JOIN po GROUP BY area_id), e AS (SELECT list_sort(list_distinct(quantile_cont(distance, [0, 0.2, 0.4, 0.6, 0.8, 1.0]))) AS e FROM n), b AS (SELECT area_id, distance, e, greatest(1, len(list_filter(e, lambda x: x < distance))) AS b FROM n, e) SELECT area_id, distance, CAST(CAST(trunc(e[b]) AS INTEGER) AS VARCHAR) || '-' || CAST(CAST(trunc(e[b + 1]) AS INTEGER) AS VARCHAR) AS distance_range FROM b")
def r11_r12_proximity_features(spark, d):
    a = spatial.event_centroids(events(spark, d)).withColumnRenamed("area_id", "src_id")
    return binning.quantile_range(spatial.nearest_distance(a, _dst(spark, d)), "distance").withColumnRenamed("src_id", "area_id")


@query(f"WITH {EV}, a AS (SELECT area_id, avg(value) AS v, count(*) AS n FROM ev GROUP BY ALL), m AS (SELECT median(v) AS v, median(n) AS n FROM a) SELECT area_id, CASE WHEN a.v > m.v AND a.n > 1.1 * m.n THEN 'high value; many events' WHEN a.v > m.v THEN 'high value' WHEN a.n > 1.1 * m.n THEN 'many events' ELSE '' END AS reasons FROM a, m")
def r13_reason_codes(spark, d):
    a = events(spark, d).groupBy("area_id").agg(F.avg("value").alias("v"), F.count(F.lit(1)).alias("n"))
    return risk.reason_codes(a, [("v", "high value", 1.0), ("n", "many events", 1.1)]).select("area_id", "reasons")


@dated(f"WITH {EV}, c AS (SELECT upper(left(category, 1)) || substr(category, 2) AS category, area_id, date, count(*) AS n FROM ev GROUP BY ALL), k AS (SELECT category, sum(n) AS t FROM c GROUP BY ALL) SELECT area_id, date, CASE WHEN t >= 0.2 * (SELECT sum(t) FROM k) AND t >= 100 THEN c.category ELSE 'Other' END AS category, CAST(sum(n) AS BIGINT) AS n FROM c JOIN k USING (category) GROUP BY ALL")
def r14_clean_panel(spark, d):
    e = events(spark, d).withColumn("category", numbers.title(F.col("category")))
    return aggregate.group_rare(e, "category", 0.2, 100).groupBy("area_id", "date", F.col("category_grouped").alias("category")).agg(F.count(F.lit(1)).alias("n"))


#: Rows as they come from files: keys with words around them, spaced and shouted categories, numbers and truth as text.
_RAW = """raw AS (SELECT event_id, 'SF ' || area_id || ' x' AS area_id, CAST(date AS VARCHAR) AS date, ' ' || upper(category) || ' ' AS category, CASE WHEN event_id % 5 > 0 THEN event_id % 4 || '.6' END AS event_count,
 CASE event_id % 6 WHEN 0 THEN 'Yes' WHEN 1 THEN 'no' WHEN 2 THEN 'TRUE' WHEN 3 THEN ' evet ' WHEN 4 THEN 'maybe' END AS is_near, CASE WHEN event_id % 7 > 0 THEN CAST(value AS VARCHAR) ELSE 'n/a' END AS distance, CASE WHEN event_id % 3 > 0 THEN CAST(event_id % 5 AS VARCHAR) END AS distance_range,
 CASE WHEN event_id % 2 > 0 THEN CAST(value AS VARCHAR) END AS population, CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE category END AS kind FROM ev WHERE category <> 'error' OR event_id % 20 = 0)"""


@dated(f"""WITH {EV}, {_RAW}, c AS (SELECT event_id, regexp_extract(area_id, '[0-9]+') AS area_id, CAST(date AS DATE) AS date, upper(left(trim(category), 1)) || lower(substr(trim(category), 2)) AS category, CAST(round(coalesce(CAST(event_count AS DOUBLE), 0)) AS BIGINT) AS event_count,
 CASE WHEN event_id % 6 IN (0, 2, 3) THEN 1 ELSE 0 END AS is_near, coalesce(TRY_CAST(distance AS DOUBLE), 9999) AS distance, coalesce(CAST(distance_range AS BIGINT), (SELECT max(CAST(distance_range AS BIGINT)) FROM raw)) AS distance_range, coalesce(CAST(population AS DOUBLE), (SELECT median(CAST(population AS DOUBLE)) FROM raw)) AS population, coalesce(nullif(kind, ''), 'None') AS kind FROM raw),
 k AS (SELECT category, count(*) AS t FROM c GROUP BY ALL), g AS (SELECT c.*, CASE WHEN t >= 0.1::DOUBLE * (SELECT sum(t) FROM k) AND t >= 50 THEN category ELSE 'Other' END AS category_grouped FROM c JOIN k USING (category)),
 y AS (SELECT area_id, category_grouped, date, sum(event_count) AS n FROM g GROUP BY ALL),
 z AS (SELECT a.area_id, a.category_grouped, a.date, coalesce(sum(CASE WHEN b.date >= a.date - 7 THEN b.n END), 0) AS nr_7d, coalesce(sum(b.n), 0) AS nr_14d FROM y a LEFT JOIN y b ON b.area_id = a.area_id AND b.category_grouped = a.category_grouped AND b.date BETWEEN a.date - 14 AND a.date - 1 GROUP BY ALL)
 SELECT event_id, g.area_id, g.date, category, g.category_grouped, event_count, is_near, distance, distance_range, population, kind, CAST(nr_7d AS DOUBLE) AS nr_7d, CAST(nr_14d AS DOUBLE) AS nr_14d, CASE g.category_grouped WHEN 'Click' THEN round((distance + event_count) / 2, 6) WHEN 'View' THEN round(population, 6) ELSE 0 END AS externals_score FROM g JOIN z USING (area_id, category_grouped, date)""")
def r14_clean_rows(spark, d):
    """The whole cleaning step over rows as files have them."""
    e, k = events(spark, d), F.col("event_id")
    raw = e.where("category <> 'error' or event_id % 20 = 0").select(
        "event_id", F.concat(F.lit("SF "), "area_id", F.lit(" x")).alias("area_id"), F.col("date").cast("string").alias("date"), F.concat(F.lit(" "), F.upper("category"), F.lit(" ")).alias("category"),
        F.when(k % 5 > 0, F.concat((k % 4).cast("string"), F.lit(".6"))).alias("event_count"), F.when(k % 6 == 0, "Yes").when(k % 6 == 1, "no").when(k % 6 == 2, "TRUE").when(k % 6 == 3, " evet ").when(k % 6 == 4, "maybe").alias("is_near"),
        F.when(k % 7 > 0, F.col("value").cast("string")).otherwise("n/a").alias("distance"), F.when(k % 3 > 0, (k % 5).cast("string")).alias("distance_range"), F.when(k % 2 > 0, F.col("value").cast("string")).alias("population"),
        F.when(k % 4 == 0, "").when(k % 4 > 1, F.col("category")).alias("kind"),
    )
    out = clean.clean_panel(raw, counts=["event_count"], flags=["is_near"], distances=["distance"], distance_ranges=["distance_range"], medians=["population"], kinds=["kind"], externals={"Click": ["distance", "event_count"], "View": ["population"]}, min_share=0.1, min_count=50)
    return out.withColumn("externals_score", F.round("externals_score", 6) + F.lit(0.0))


@dated(f"WITH {DP}, {ED}, p AS (SELECT area_id, date, event_count, label, CAST(sum(event_count) OVER (PARTITION BY area_id ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS BIGINT) AS prior_7 FROM dp), s AS (SELECT ed.area_id, date, sum(event_count) AS neighbor_event_count FROM ed JOIN dp ON dp.area_id = ed.neighbor GROUP BY ALL), v AS (SELECT area_id, avg(value) AS mean_value FROM ev GROUP BY ALL) SELECT p.area_id, p.date, p.event_count, p.label, p.prior_7, CAST(neighbor_event_count AS BIGINT) AS neighbor_event_count, round(mean_value, 6) AS mean_value FROM p LEFT JOIN s ON s.area_id = p.area_id AND s.date = p.date LEFT JOIN v ON v.area_id = p.area_id")
def r15_assemble_features(spark, d):
    from ..operators import enrich

    p = panel.daily_panel(events(spark, d))
    base = windows.prior_rows_sum(p, "event_count", 7, ["area_id"], "date", "prior_7")
    near = spatial.neighbor_sum(user_edges(spark, d), p, "event_count", ["date"])
    means = events(spark, d).groupBy("area_id").agg(F.avg("value").alias("mean_value"))
    return rounded(enrich.merge_on(enrich.enrich(base, near, ["area_id", "date"]), means, ["area_id"], ["mean_value"]))


@dated(f"WITH {EV} SELECT DISTINCT area_id, date, hour, 0.5::DOUBLE AS score FROM ev")
def r16_scoring_view(spark, d):
    return events(spark, d).select("area_id", "date", "hour", F.lit(0.5).alias("score")).distinct()


# --- evaluation and SQL-able model operators -------------------------------------------------------------------


@query(f"WITH {EV}, c AS (SELECT sum(CASE WHEN score >= 0.6 AND label = 1 THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN score >= 0.6 AND label = 0 THEN 1 ELSE 0 END) AS fp, sum(CASE WHEN score < 0.6 AND label = 1 THEN 1 ELSE 0 END) AS fn, count(*) AS n, avg(CASE WHEN label = 1 THEN -ln(greatest(score, 1e-15::DOUBLE)) ELSE -ln(greatest(1 - score, 1e-15::DOUBLE)) END) AS ll, avg(power(label - score, 2)) AS br FROM ev) SELECT round((n - fp - fn) / n, 6) AS accuracy, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1, round(ll, 6) AS log_loss, round(br, 6) AS brier FROM c")
def v01_v02_v03_metrics(spark, d):
    return rounded(evaluate.classification_metrics(events(spark, d), threshold=0.6))


#: A score that doesn't tell the label fully.
_NOISY = "round(score * 0.7 + (event_id % 97) / 97.0::DOUBLE * 0.3, 3)"


def _noisy(spark, d):
    return events(spark, d).withColumn("score", F.round(F.col("score") * 0.7 + (F.col("event_id") % 97) / 97.0 * 0.3, 3))


_CURVE = f"{EV}, p AS (SELECT {_NOISY} AS s, sum(label) AS p, count(*) AS c FROM ev GROUP BY ALL), w AS (SELECT s, p, c, sum(p) OVER (ORDER BY s DESC) AS tp, sum(c) OVER (ORDER BY s DESC) AS k, sum(p) OVER () AS pos, sum(c) OVER () AS n FROM p)"


@query(f"WITH {_CURVE} SELECT round(sum(p / pos * tp / k), 6) AS average_precision FROM w")
def v04_average_precision(spark, d):
    return rounded(evaluate.average_precision(_noisy(spark, d)))


@query(f"WITH {EV}, r AS (SELECT label, rank() OVER (ORDER BY {_NOISY}) + (count(*) OVER (PARTITION BY {_NOISY}) - 1) / 2.0 AS r FROM ev) SELECT round((sum(CASE WHEN label = 1 THEN r END) - sum(label) * (sum(label) + 1) / 2.0) / (sum(label) * (count(*) - sum(label))), 6) AS roc_auc FROM r")
def v05_roc_auc(spark, d):
    return rounded(evaluate.roc_auc(_noisy(spark, d)))


@query(f"WITH {_CURVE} SELECT s AS threshold, round(f, 6) AS f_beta FROM (SELECT s, round(2 * tp / (k + pos), 12) AS f FROM w) ORDER BY f DESC, s DESC LIMIT 1")
def v06_best_threshold(spark, d):
    return rounded(evaluate.best_threshold(_noisy(spark, d)))


@query(f"WITH {EV} SELECT round(avg(label), 6) AS precision_at_k FROM (SELECT label FROM ev ORDER BY {_NOISY} DESC, event_id LIMIT 500)")
def v07_precision_at_k(spark, d):
    return rounded(evaluate.precision_at_k(_noisy(spark, d), 500, "event_id"))


@query(f"WITH {EV}, {ED}, o AS (SELECT area_id, sum(label) AS y, count(*) AS n FROM ev GROUP BY ALL), x AS (SELECT ed.area_id, sum(y) AS y2, sum(n) AS n2 FROM ed JOIN o ON o.area_id = ed.neighbor GROUP BY ALL) SELECT area_id, round((y + 50 * (SELECT avg(label) FROM ev) + coalesce(y2, 0)) / (n + 50 + coalesce(n2, 0)), 6) AS encoded FROM o LEFT JOIN x USING (area_id)")
def m02_spatial_target_encode(spark, d):
    return rounded(risk.spatial_target_encode(events(spark, d), user_edges(spark, d)))


@query(f"WITH {EV}, x AS (SELECT label, value, CAST(hour AS DOUBLE) AS hour, CAST(label * 2 AS DOUBLE) AS copy FROM ev), l AS (SELECT label, 'value' AS \"column\", value AS v FROM x UNION ALL SELECT label, 'hour', hour FROM x UNION ALL SELECT label, 'copy', copy FROM x), r AS (SELECT *, rank() OVER (PARTITION BY \"column\" ORDER BY v) + (count(*) OVER (PARTITION BY \"column\", v) - 1) / 2.0 AS r FROM l), a AS (SELECT \"column\", abs(corr(v, label)) AS c, (sum(CASE WHEN label = 1 THEN r END) - sum(label) * (sum(label) + 1) / 2.0) / (sum(label) * (count(*) - sum(label))) AS auc FROM r GROUP BY ALL) SELECT \"column\", round(c, 6) AS abs_corr, round(auc, 6) AS auc, c >= 0.995 OR greatest(auc, 1 - auc) >= 0.995 AS leaky FROM a")
def m03_find_leaky(spark, d):
    return rounded(evaluate.find_leaky(events(spark, d).withColumn("copy", F.col("label") * 2), ["value", "hour", "copy"]))


@query(f"WITH {EV}, f AS (SELECT date, ntile(4) OVER (ORDER BY date) - 1 AS fold FROM (SELECT DISTINCT date FROM ev)) SELECT event_id, CAST(fold AS INTEGER) AS fold FROM ev JOIN f USING (date)")
def m05_time_folds(spark, d):
    return evaluate.time_folds(events(spark, d), 3).select("event_id", "fold")


@query(f"WITH {EV} SELECT event_id, CASE WHEN date > (SELECT max(date) FROM ev) - INTERVAL 5 DAY THEN 'test' ELSE 'train' END AS split FROM ev")
def m10_oot_split(spark, d):
    return evaluate.oot_split(events(spark, d), 5).select("event_id", "split")


@query("WITH x AS (SELECT o_orderkey, epoch(o_orderdate) AS t FROM orders) SELECT o_orderkey, CASE WHEN t > (SELECT quantile_cont(t, 0.8) FROM x) THEN 'test' ELSE 'train' END AS split FROM x")
def m11_quantile_split(spark, d):
    return evaluate.quantile_split(table(spark, d, "orders"), 0.8, "o_orderdate").select("o_orderkey", "split")


@query("WITH x AS (SELECT 'p_brand' AS c, sum(p_size) AS v FROM part UNION ALL SELECT 'p_type', sum(p_retailprice) FROM part) SELECT c AS \"column\", round(v, 4) AS importance, CAST(row_number() OVER (ORDER BY v DESC, c) AS INTEGER) AS rank FROM x")
def m13_collapse_importance(spark, d):
    p = table(spark, d, "part")
    hot = p.groupBy(F.concat(F.lit("p_brand="), "p_brand").alias("feature")).agg(F.sum("p_size").cast("double").alias("importance")).unionByName(p.groupBy(F.concat(F.lit("p_type="), "p_type").alias("feature")).agg(F.sum("p_retailprice").alias("importance")))
    return rounded(evaluate.collapse_importance(hot), 4)


@query(f"WITH {EV} SELECT sum(label)::BIGINT AS n_positive, (count(*) - sum(label))::BIGINT AS n_negative, round((count(*) - sum(label)) / sum(label), 6) AS weight FROM ev")
def m18_class_weight(spark, d):
    return rounded(evaluate.class_weight(events(spark, d)))


@query("WITH x AS (SELECT p_brand AS feature, greatest(sum(p_size) - 1000, 0) AS v FROM part GROUP BY ALL) SELECT feature, round(coalesce(v / nullif((SELECT sum(v) FROM x), 0), 0), 6) AS importance FROM x")
def m21_canonical_importance(spark, d):
    x = table(spark, d, "part").groupBy("p_brand").agg((F.sum("p_size") - 1000).alias("v"))
    return rounded(evaluate.canonical_importance(x, "p_brand", "v"))


@query()
def m22_stratified_split(spark, d):
    s = evaluate.stratified_split(events(spark, d), "label", 0.2, 7, "event_id")
    return s.groupBy("label", "split").agg(F.count(F.lit(1)).alias("n"))


def _training(spark, d):
    p = windows.prior_rows_sum(panel.daily_panel(events(spark, d)), "event_count", 3, ["area_id"], "date", "prior_3")
    p = windows.prior_rows_sum(p, "event_count", 7, ["area_id"], "date", "prior_7").fillna(0, subset=["prior_3", "prior_7"])
    return p.withColumns({"dow": F.weekday("date").cast("double"), "area_n": F.col("area_id").cast("double"), "prior_3": F.col("prior_3").cast("double"), "prior_7": F.col("prior_7").cast("double")})


@query()
def m01_m06_m09_stack(spark, d):
    """All learners over three expanding folds, the better of two meta models, threshold; saved, loaded, and the whole panel scored and decided."""
    stages = ml.preprocessor(["prior_3", "prior_7"], ["dow"], [])
    train = _training(spark, d)
    path = _folder(spark)
    ml.fit_stack(train, stages, ml.base_models(), 3, ["area_id", "date"], metas=ml.meta_models()).save(path)
    return rounded(ml.Stack.load(path).decide(train).select("area_id", "date", "label", "score", "predicted"))


def _precision_of(df, columns):
    """Average precision of a logistic model of some columns on the fifth of rows that it was not fitted on."""
    data = df.withColumn("_fold", F.pmod(F.xxhash64("area_id", "date"), F.lit(5)))
    stages = [*ml.preprocessor(list(columns), [], []), ml.base_models()["lr"].copy({}).setLabelCol("label")]
    model = ml.Pipeline(stages=stages).fit(data.where("_fold > 0"))
    scored = ml._score(model.transform(data.where("_fold = 0")), "score")
    return round(evaluate.average_precision(scored).first()[0] or 0.0, 9)


@query()
def m12_permutation_importance(spark, d):
    """Loss of average precision of a fitted model when each of its columns is shuffled, the mean of five times."""
    train = save(_training(spark, d).withColumn("row", F.concat_ws("|", "area_id", F.col("date").cast("string"))), "importance-rows")
    columns = ["prior_7", "dow"]
    model = ml.Pipeline(stages=[*ml.preprocessor(columns, [], []), ml.base_models()["lr"].copy({}).setLabelCol("label")]).fit(train)
    rows = ml.permutation_importance(lambda df: ml._score(model.transform(df), "score"), train, columns, "row")
    return spark.createDataFrame(rows, "feature string, importance double")


@query()
def m14_m15_selection(spark, d):
    """Precision of the first k of the ranked features, and the k that is selected."""
    train = save(_training(spark, d), "selection-rows")
    ranked = ["prior_7", "prior_3", "dow", "area_n"]
    steps = ml.forward_select(train, ranked, _precision_of)
    best, _ = ml.select_k(train, ranked, lambda _, some: dict(steps)[len(some)], range(1, 5))
    return spark.createDataFrame([(k, ranked[k - 1], v, k == best) for k, v in steps], "k int, feature string, average_precision double, selected boolean")


@query()
def m16_unsupervised_rank(spark, d):
    rows = ml.unsupervised_rank(_training(spark, d), ["prior_3", "prior_7", "dow"])
    return spark.createDataFrame(rows, "feature string, importance double")


@query()
def m17_supervised_rank(spark, d):
    rows, chosen = ml.supervised_rank(_training(spark, d), ["prior_3", "prior_7", "dow", "area_n"], ["area_id", "date"])
    return spark.createDataFrame([(c, v, c in chosen) for c, v in rows], "feature string, importance double, selected boolean")


@query()
def m19_type_risk(spark, d):
    e = events(spark, d).select("event_id", "category", F.col("hour").cast("double").alias("hour"), "value", "score")
    return rounded(ml.type_risk(ml.type_model(e, ["hour", "value"]), e).drop("hour", "value", "category"))


@query()
def m20_h06_horizons(spark, d):
    train = _training(spark, d)
    models = ml.horizon_models(train, ["prior_3", "prior_7", "dow"], [1, 7], ["area_id"], "date")
    return rounded(ml.score_horizons(train, models, ["prior_3", "prior_7", "dow"], ["area_id", "date"]))


# --- forecasts -------------------------------------------------------------------------------------------------

_SLOT = "SELECT CAST(k AS INTEGER) AS step, {first} + k * INTERVAL {hours} HOUR AS ts FROM range(1, {n} + 1) r(k)".format
_FIRST = {"24h": "date_trunc('hour', (SELECT max(ts) FROM ev))", "7d": "date_trunc('hour', (SELECT max(ts) FROM ev))", "365d": "date_trunc('day', (SELECT max(ts) FROM ev)) + INTERVAL 12 HOUR"}


def _grid_sql(horizon):
    n, hours = forecast.HORIZONS[horizon]
    return f"{EV}, a AS (SELECT area_id, avg(value) AS value FROM ev GROUP BY area_id), t AS ({_SLOT(first=_FIRST[horizon], hours=hours, n=n)}), g AS (SELECT area_id, value, step, ts, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week FROM a CROSS JOIN t)"


def _grid(spark, d, horizon):
    e = events(spark, d)
    return forecast.forecast_grid(e.groupBy("area_id").agg(F.avg("value").alias("value")), e.agg(F.max("ts").alias("last")), horizon)


@query(f"WITH {_grid_sql('7d')} SELECT area_id, round(value, 6) AS value, step, ts, hour, day_of_week FROM g", ("ts",))
def h01_forecast_grid(spark, d):
    return rounded(_grid(spark, d, "7d").select("area_id", "value", "step", "ts", "hour", "day_of_week"))


@query(f"WITH {_grid_sql('365d')} SELECT area_id, step, ts, hour, day_of_week FROM g", ("ts",))
def h02_daily_grid(spark, d):
    return _grid(spark, d, "365d").select("area_id", "step", "ts", "hour", "day_of_week")


@query(f"WITH {_grid_sql('24h')}, r AS (SELECT area_id, hour, count(*) / 30.0::DOUBLE AS r FROM ev GROUP BY ALL), s AS (SELECT g.area_id, g.ts, 1 - exp(-coalesce(r.r, 0)) AS score FROM g LEFT JOIN r ON r.area_id = g.area_id AND r.hour = g.hour), k AS (SELECT *, row_number() OVER (ORDER BY score, area_id || '|' || CAST(ts AS VARCHAR)) AS k, count(*) OVER () AS n FROM s), dt AS (SELECT *, CAST(greatest(1, (10 * (k - 1) + n - 2) // (n - 1)) AS INTEGER) AS decile FROM k) SELECT area_id, ts, round(score, 6) AS score, decile, CASE WHEN decile <= 3 THEN 'low' WHEN decile <= 7 THEN 'medium' ELSE 'high' END AS level, round(-ln(greatest(1 - score, 1e-9::DOUBLE)), 6) AS expected_count FROM dt", ("ts",))
def h03_forecast_tables(spark, d):
    g = forecast.baseline_score(_grid(spark, d, "24h"), events(spark, d), 30, ["area_id", "hour"])
    return rounded(forecast.forecast_tables(g).select("area_id", "ts", "score", "decile", "level", "expected_count"))


@dated(f"WITH {_grid_sql('7d')}, r AS (SELECT area_id, hour, count(*) / 30.0::DOUBLE AS r FROM ev GROUP BY ALL), s AS (SELECT g.area_id, CAST(g.ts AS DATE) AS date, 1 - exp(-coalesce(r.r, 0)) AS score FROM g LEFT JOIN r ON r.area_id = g.area_id AND r.hour = g.hour) SELECT area_id, date, round(avg(score), 6) AS mean_score FROM s GROUP BY ALL")
def h04_score_horizon(spark, d):
    g = forecast.baseline_score(_grid(spark, d, "7d"), events(spark, d), 30, ["area_id", "hour"])
    return rounded(g.groupBy("area_id", F.to_date("ts").alias("date")).agg(F.avg("score").alias("mean_score")))


def _table_sql(horizon, keys, k):
    """A forecast table in SQL: scores by the mean number at area and hour, shares by ``keys``, reasons by value."""
    slot = {"24h": "g.hour", "7d": "g.hour // 3 * 3", "365d": "NULL"}[horizon]
    on = " AND ".join(f"sh.{c} = t.{c}" for c in keys)
    names = ", ".join(keys)
    return f"""(WITH {_grid_sql(horizon)}, r AS (SELECT area_id, hour, count(*) / 30.0::DOUBLE AS r FROM ev GROUP BY ALL),
 s AS (SELECT g.area_id, CAST(g.ts AS DATE) AS date, CAST({slot} AS INTEGER) AS hour, g.value, 1 - exp(-coalesce(r.r, 0)) AS score FROM g LEFT JOIN r ON r.area_id = g.area_id AND r.hour = g.hour),
 tb AS (SELECT area_id, date, hour, avg(score) AS score, sum(score) AS e, avg(value) AS value FROM s GROUP BY ALL), md AS (SELECT median(value) AS v FROM tb),
 k AS (SELECT *, row_number() OVER (ORDER BY round(score, 12), concat_ws('|', area_id, CAST(date AS VARCHAR), CAST(hour AS VARCHAR))) AS k, count(*) OVER () AS n FROM tb), dc AS (SELECT *, CAST(greatest(1, (10 * (k - 1) + n - 2) // (n - 1)) AS INTEGER) AS decile FROM k),
 ct AS (SELECT {names}, category, count(*) AS n FROM ev GROUP BY ALL), pl AS (SELECT *, n / sum(n) OVER (PARTITION BY {names}) AS share, row_number() OVER (PARTITION BY {names} ORDER BY n DESC, category) AS place FROM ct),
 sh AS (SELECT {names}, list(category ORDER BY place) AS c, list(share ORDER BY place) AS p FROM pl WHERE place <= {k} GROUP BY {names}),
 al AS (SELECT list(category ORDER BY n DESC, category) AS c, list(n / t ORDER BY n DESC, category) AS p FROM (SELECT category, count(*) AS n, sum(count(*)) OVER () AS t FROM ev GROUP BY category ORDER BY n DESC, category LIMIT {k}))
 SELECT '{horizon}' AS horizon, t.area_id, date, t.hour, round(score, 6) AS score, round(e, 6) AS expected_count, decile, CASE WHEN decile <= 3 THEN 'low' WHEN decile <= 7 THEN 'medium' ELSE 'high' END AS level, array_to_string(coalesce(sh.c, al.c), ';') AS categories, round(coalesce(sh.p, al.p)[1] * score, 6) AS top1_chance, round(coalesce(sh.p, al.p)[1] * e, 6) AS top1_expected,
 concat_ws('; ', CASE WHEN value > 1.1::DOUBLE * md.v THEN 'high value' END, CASE WHEN value < 0.9::DOUBLE * md.v THEN 'low value' END) AS reasons FROM dc t CROSS JOIN md CROSS JOIN al LEFT JOIN sh ON {on})"""


def _detailed(spark, d):
    e = events(spark, d)
    scored = {h: forecast.baseline_score(_grid(spark, d, h), e, 30, ["area_id", "hour"]).withColumn("expected_count", F.col("score")) for h in forecast.HORIZONS}
    return forecast.detailed_tables(scored, e, [("value", "high value", 1.1), ("value", "low value", -0.9)])


@dated(" UNION ALL ".join(f"SELECT * FROM {_table_sql(h, keys, k)}" for h, (k, keys) in forecast.TABLES.items()))
def h03_detailed_tables(spark, d):
    """All three forecast tables with their categories and reasons, one after the other."""
    parts = []
    for horizon, t in _detailed(spark, d).items():
        hour = F.col("hour") if "hour" in t.columns else F.lit(None)
        names, first = F.array_join(F.transform("top", lambda x: x["category"]), ";"), F.col("top")[0]
        parts.append(t.select(F.lit(horizon).alias("horizon"), "area_id", "date", hour.cast("int").alias("hour"), "score", "expected_count", "decile", "level", names.alias("categories"), first["chance"].alias("top1_chance"), first["expected"].alias("top1_expected"), "reasons"))
    return rounded(topk.union_all(parts))


@query('SELECT event_type AS "column", round(sum(value), 4) AS total FROM events GROUP BY ALL ORDER BY total DESC, "column" LIMIT 3')
def h05_top_types(spark, d):
    top = forecast.top_types(events(spark, d), 3, value="value")
    return rounded(top.select(F.col("category").alias("column"), "total"), 4)


# --- sources and sinks -----------------------------------------------------------------------------------------


def _folder(spark) -> str:
    """A new folder that all executors share."""
    return new_path(spark, "tables")


@query("SELECT o_orderkey, o_totalprice FROM orders")
def s02_s04_read_pruned(spark, d):
    return tables.read_table(spark, f"{d.rstrip('/')}/orders.parquet", columns=["o_orderkey", "o_totalprice", "absent"])


@query("SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority FROM orders")
def s01_s07_csv_round_trip(spark, d):
    path = _folder(spark)
    tables.write_table(table(spark, d, "orders").select("o_orderkey", "o_orderpriority"), f"{path}/orders.csv", "csv")
    return tables.read_table(spark, f"{path}/orders.csv")


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS year_month FROM orders")
def s08_write_panel(spark, d):
    path = f"{_folder(spark)}/panel"
    o = table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("date"))
    tables.write_panel(o.where("o_orderkey % 2 = 0"), path, mode="overwrite")
    tables.write_panel(o, path, mode="overwrite")
    return spark.read.parquet(path).select("o_orderkey", F.date_format("date", "yyyy-MM").alias("year_month"))


@query("SELECT 'category' AS report, category AS member, n FROM (SELECT event_type AS category, count(*) AS n FROM events GROUP BY ALL) UNION ALL SELECT 'hour', CAST(hour(ts) AS VARCHAR), count(*) FROM events GROUP BY ALL")
def s12_write_report(spark, d):
    e, path = events(spark, d), f"{_folder(spark)}/report"
    parts = {"category": e.groupBy(F.col("category").alias("member")), "hour": e.groupBy(F.col("hour").cast("string").alias("member"))}
    tables.write_report({k: g.agg(F.count(F.lit(1)).alias("n")) for k, g in parts.items()}, path)
    return topk.union_all([spark.read.parquet(f"{path}/{k}").select(F.lit(k).alias("report"), "member", "n") for k in parts])


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 0")
def s03_read_newest(spark, d):
    """Of two candidates the one written last; a third doesn't exist."""
    path, o = _folder(spark), table(spark, d, "orders").select("o_orderkey")
    for name, rest in (("old", 1), ("new", 0)):
        tables.write_table(o.where(F.pmod("o_orderkey", F.lit(3)) == rest), f"{path}/{name}")
    return tables.read_first(spark, [f"{path}/none", f"{path}/old", f"{path}/new"], newest=True)


@query(f"WITH {EV}, {CE} SELECT area_id, 0 AS ring, i AS seq, round(CASE WHEN i IN (0, 3) THEN w ELSE e END, 6) AS x1, round(CASE WHEN i < 2 THEN s ELSE n END, 6) AS y1, round(CASE WHEN i < 2 THEN e ELSE w END, 6) AS x2, round(CASE WHEN i IN (1, 2) THEN n ELSE s END, 6) AS y2 FROM box CROSS JOIN (SELECT CAST(i AS INTEGER) AS i FROM range(4) r(i)) k")
def s05_geojson_edges(spark, d):
    """Areas written as lines of GeoJSON features, read back as edges of polygons."""
    e = cell_edges(spark, d).where("seq = 0").select("area_id", F.col("x1").alias("w"), F.col("y1").alias("s"), F.col("x2").alias("e"), (F.col("y1") + 0.01).alias("n"))
    ring = F.array(*[F.array(a, b) for a, b in (("w", "s"), ("e", "s"), ("e", "n"), ("w", "n"), ("w", "s"))])
    feature = F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct("area_id").alias("properties"), F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry")))
    path = _folder(spark)
    e.select(feature.alias("value")).write.text(path)
    return rounded(tables.polygon_edges(tables.read_geojson(spark, path), "area_id"))


@query(f"WITH {PO} SELECT CAST(poi_id AS VARCHAR) AS stop_id, round(lat, 6) AS stop_lat, round(lon, 6) AS stop_lon FROM po")
def s06_gtfs_stops(spark, d):
    path = _folder(spark)
    tables.write_table(pois(spark, d).select(F.col("poi_id").alias("Stop_ID"), F.col("lat").alias(" stop_lat"), F.col("lon").alias("stop_lon ")), f"{path}/stops.txt", "csv")
    return rounded(tables.read_gtfs_stops(spark, path))


@query("SELECT o_orderkey, o_custkey, o_orderkey % 100 AS small, o_orderstatus FROM orders")
def s10_compact_types(spark, d):
    """Narrow types written and read back: the same values."""
    path, o = _folder(spark), table(spark, d, "orders")
    tables.write_table(project.compact_types(o.select("o_orderkey", "o_custkey", (F.col("o_orderkey") % 100).alias("small"), "o_orderstatus")), path)
    return tables.read_table(spark, path)


@query(f"WITH {EV} SELECT category, count(*) AS n, round(max(value), 6) AS greatest FROM ev GROUP BY ALL")
def s11_json_output(spark, d):
    path = _folder(spark)
    tables.write_json_row(events(spark, d).groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("greatest")), path)
    return rounded(spark.read.schema("category string, n long, greatest double").json(path))


@query(f"WITH {EV} SELECT 'rows' AS step, category AS name, count(*) AS n FROM ev GROUP BY ALL UNION ALL SELECT 'areas', category, count(DISTINCT area_id) FROM ev GROUP BY ALL")
def s13_run_manifest(spark, d):
    """Two runs' metrics of each category, appended to one manifest."""
    path, by = _folder(spark), events(spark, d).groupBy(F.col("category").alias("name"))
    for step, measure in (("rows", F.count(F.lit(1))), ("areas", F.countDistinct("area_id"))):
        out = tables.write_manifest(spark, [{"step": step, **r.asDict()} for r in by.agg(measure.alias("n")).collect()], path)
    return out.select("step", "name", "n")


@query("SELECT event_id, event_type, round(value, 6) AS value FROM events")
def s14_landed_pages(spark, d):
    """Events landed as pages of JSON lines, read as one table with the page that each row came from."""
    path = _folder(spark)
    table(spark, d, "events").select("event_id", "event_type", "value").repartition(3).write.json(path)
    landed = tables.read_landing(spark, path, "jsonl")
    return rounded(landed.where("source_file is not null").select("event_id", "event_type", "value"))


# --- streams ---------------------------------------------------------------------------------------------------


#: Four arrivals by time; every 7th event comes one arrival late, every 13th comes again with the next.
_BATCH = "CAST(floor(4 * epoch(ts - lo) / (epoch(hi - lo) + 1)) AS INTEGER)"
_ARRIVALS = f"""ar AS (SELECT ev.*, {_BATCH} + CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END AS batch FROM ev CROSS JOIN (SELECT min(ts) AS lo, max(ts) AS hi FROM ev)
 UNION ALL SELECT ev.*, {_BATCH} + 1 FROM ev CROSS JOIN (SELECT min(ts) AS lo, max(ts) AS hi FROM ev) WHERE event_id % 13 = 0),
 wm AS (SELECT b AS batch, (SELECT max(ts) FROM ar WHERE batch < b) - INTERVAL 1 HOUR AS mark FROM range(6) r(b))"""


def _replayed(spark, d, make):
    """What a stream has written after all arrivals, each after a restart, and one restart more."""
    e = events(spark, d).select("event_id", "area_id", F.col("ts").cast("timestamp").alias("ts"), "category")
    ends = e.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    seconds = lambda c: F.unix_micros(c) / 1e6
    at = F.floor(4 * (seconds(F.col("ts")) - seconds(F.col("lo"))) / (seconds(F.col("hi")) - seconds(F.col("lo")) + 1)).cast("int")
    rows = e.crossJoin(F.broadcast(ends)).withColumn("batch", at).drop("lo", "hi")
    rows = rows.withColumn("batch", F.col("batch") + (F.col("event_id") % 7 == 0).cast("int")).unionByName(rows.where("event_id % 13 = 0").withColumn("batch", F.col("batch") + 1))
    path = _folder(spark)
    live = lambda: make(spark.readStream.schema(e.schema).parquet(f"{path}/in"))
    jobs.replay([rows.where(F.col("batch") == k).drop("batch") for k in range(5)], f"{path}/in", lambda: jobs.append_to(live(), f"{path}/out", f"{path}/checkpoint"))
    return spark.read.schema(live().schema).parquet(f"{path}/out")


@query(f"WITH {EV}, {_ARRIVALS} SELECT area_id, strftime(time_bucket(INTERVAL 3 HOUR, ts), '%Y-%m-%d %H') AS start, count(*) AS n FROM ar JOIN wm USING (batch) WHERE (mark IS NULL OR time_bucket(INTERVAL 3 HOUR, ts) + INTERVAL 3 HOUR > mark) AND time_bucket(INTERVAL 3 HOUR, ts) + INTERVAL 3 HOUR <= (SELECT max(mark) FROM wm) GROUP BY ALL")
def st1_tumbling_counts(spark, d):
    """Rows that come after their window has closed are dropped; windows that are open at the end aren't written yet."""
    return _replayed(spark, d, jobs.tumbling_counts).select("area_id", F.date_format("start", "yyyy-MM-dd HH").alias("start"), "n")


@query("SELECT event_id, event_type AS category FROM events")
def st2_once_by_id(spark, d):
    """Late and repeated rows over five restarts: every event once."""
    return _replayed(spark, d, lambda s: jobs.once_by_id(s, late="3650 days")).select("event_id", "category")


@query("WITH e AS (SELECT lpad(CAST(user_id AS VARCHAR), 11, '0') AS area_id, max(event_id) AS event_id FROM events GROUP BY ALL) SELECT * FROM e")
def st3_upsert(spark, d):
    """Five batches into a table of versions, some of them twice."""
    e = events(spark, d).select("area_id", "event_id")
    path = _folder(spark)
    stream = lambda: spark.readStream.schema(e.schema).parquet(f"{path}/in")
    start = lambda: jobs.upsert_stream(stream(), f"{path}/table", ["area_id"], ["event_id"], f"{path}/checkpoint").trigger(availableNow=True).start()
    jobs.replay([e.where(F.pmod(F.xxhash64("event_id"), F.lit(5)) == k) for k in range(5)], f"{path}/in", start)
    return jobs.current(spark, f"{path}/table")


@query(f"WITH {EV}, {_ARRIVALS}, w AS (SELECT category, batch, time_bucket(INTERVAL 1 HOUR, ts) - k * INTERVAL 1 HOUR AS start FROM ar CROSS JOIN range(6) r(k)) SELECT category, strftime(start, '%Y-%m-%d %H') AS start, count(*) AS n FROM w JOIN wm USING (batch) WHERE (mark IS NULL OR start + INTERVAL 6 HOUR > mark) AND start + INTERVAL 6 HOUR <= (SELECT max(mark) FROM wm) GROUP BY ALL")
def st4_sliding_counts(spark, d):
    return _replayed(spark, d, lambda s: jobs.sliding_counts(s, area="category")).select("category", F.date_format("start", "yyyy-MM-dd HH").alias("start"), "n")
