"""Panels, windows, top-k, sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import panel, project, topk, windows
from .registry import DP, ED, EV, dated, events, query, rounded, table, user_edges


def _daily(spark, d):
    return panel.daily_panel(events(spark, d))


@dated(f"WITH {DP}, w AS (SELECT area_id, date, event_count, label, {', '.join(f'sum(event_count) OVER (PARTITION BY area_id ORDER BY date ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) AS prior_{n}' for n in (1, 3, 7))} FROM dp) SELECT area_id, date, CAST(event_count AS BIGINT) AS event_count, label, CAST(prior_1 AS BIGINT) AS prior_1, CAST(prior_3 AS BIGINT) AS prior_3, CAST(prior_7 AS BIGINT) AS prior_7 FROM w")
def w01_prior_rows_sum(spark, d):
    df = _daily(spark, d)
    for n in (1, 3, 7):
        df = windows.prior_rows_sum(df, "event_count", n, ["area_id"], "date", f"prior_{n}")
    return df


@dated(f"WITH {EV}, b AS (SELECT area_id, date, hour // 3 * 3 AS hr_key, count(*) AS n FROM ev GROUP BY ALL) SELECT area_id, date, CAST(hr_key AS INTEGER) AS hr_key, n, CAST(sum(n) OVER (PARTITION BY area_id, hr_key ORDER BY date ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS BIGINT) AS prior_3 FROM b")
def w02_prior_rows_sum_by_bin(spark, d):
    from ..operators.aggregate import call_summary

    b = call_summary(events(spark, d)).select("area_id", "date", "hr_key", F.col("bin_count").alias("n"))
    return windows.prior_rows_sum(b, "n", 3, ["area_id", "hr_key"], "date", "prior_3")


@dated(f"WITH {DP}, {ED}, s AS (SELECT ed.area_id, date, sum(event_count) AS neighbor_event_count FROM ed JOIN dp ON dp.area_id = ed.neighbor GROUP BY ALL) SELECT area_id, date, CAST(neighbor_event_count AS BIGINT) AS neighbor_event_count, CAST(sum(neighbor_event_count) OVER (PARTITION BY area_id ORDER BY date ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS BIGINT) AS prior_3 FROM s")
def w03_prior_neighbor_sum(spark, d):
    from ..operators.spatial import neighbor_sum

    s = neighbor_sum(user_edges(spark, d), _daily(spark, d), "event_count", ["date"])
    return windows.prior_rows_sum(s, "neighbor_event_count", 3, ["area_id"], "date", "prior_3")


@dated(f"WITH {DP} SELECT area_id, date, CAST(lag(event_count, 1, 0) OVER (PARTITION BY area_id ORDER BY date) AS BIGINT) AS before FROM dp")
def w04_prior_value(spark, d):
    return windows.prior_value(_daily(spark, d), "event_count", ["area_id"], "date", "before").select("area_id", "date", F.col("before").cast("long").alias("before"))


@dated(f"WITH {DP} SELECT area_id, date, CAST(sum(event_count) OVER (PARTITION BY area_id ORDER BY date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS BIGINT) AS rolling_3 FROM dp")
def w05_rolling_sum(spark, d):
    return windows.rolling_sum(_daily(spark, d), "event_count", 3, ["area_id"], "date", "rolling_3").select("area_id", "date", "rolling_3")


@dated(f"WITH {DP} SELECT area_id, date, CAST(CASE WHEN count(*) OVER w >= 7 THEN sum(event_count) OVER w ELSE 0 END AS BIGINT) AS full_7 FROM dp WINDOW w AS (PARTITION BY area_id ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)")
def w06_full_window_sum(spark, d):
    return windows.prior_rows_sum(_daily(spark, d), "event_count", 7, ["area_id"], "date", "full_7", min_rows=7).select("area_id", "date", F.coalesce("full_7", F.lit(0)).alias("full_7"))


@dated(f"WITH {EV}, c AS (SELECT area_id, category, date, count(*) AS n FROM ev GROUP BY ALL) SELECT area_id, category, date, n, CAST(coalesce(sum(n) OVER (PARTITION BY area_id, category ORDER BY date RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING), 0) AS BIGINT) AS days_7 FROM c")
def w07_prior_days_sum(spark, d):
    c = events(spark, d).groupBy("area_id", "category", "date").agg(F.count(F.lit(1)).alias("n"))
    return windows.prior_days_sum(c, "n", 7, ["area_id", "category"], "date", "days_7")


@query(f"WITH {EV} SELECT area_id, count(*) AS n FROM ev WHERE date > (SELECT max(date) FROM ev) - INTERVAL 5 DAY GROUP BY area_id")
def w08_recent_counts(spark, d):
    return project.last_days(events(spark, d), 5).groupBy("area_id").agg(F.count(F.lit(1)).alias("n"))


@dated(f"""WITH RECURSIVE {DP}, s AS (SELECT area_id, date, CAST(event_count AS DOUBLE) AS v, row_number() OVER (PARTITION BY area_id ORDER BY date) AS i FROM dp),
 r AS (SELECT area_id, date, v, i, v AS e3, v AS e6 FROM s WHERE i = 1 UNION ALL SELECT s.area_id, s.date, s.v, s.i, 0.3::DOUBLE * s.v + 0.7::DOUBLE * r.e3, 0.6::DOUBLE * s.v + 0.4::DOUBLE * r.e6 FROM r JOIN s ON s.area_id = r.area_id AND s.i = r.i + 1)
 SELECT area_id, date, round(v, 6) AS event_count, round(e3, 6) AS ema_0_3, round(e6, 6) AS ema_0_6 FROM r""")
def w09_ema(spark, d):
    return rounded(windows.ema(_daily(spark, d), "event_count", [0.3, 0.6], ["area_id"], "date"))


@query(f"WITH {EV}, r AS (SELECT event_id, row_number() OVER (ORDER BY score, event_id) AS r, count(*) OVER () AS n FROM ev) SELECT event_id, CAST(greatest(1, (10 * (r - 1) + n - 2) // (n - 1)) AS INTEGER) AS decile FROM r")
def w10_decile(spark, d):
    return windows.decile(events(spark, d).select("event_id", "score"), "score", "event_id").select("event_id", "decile")


@query(f"WITH {EV} SELECT event_id, round((rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0) / count(*) OVER (), 6) AS rank_pct FROM ev")
def w11_rank_pct(spark, d):
    return rounded(windows.rank_pct(events(spark, d).select("event_id", "score"), "score").select("event_id", "rank_pct"))


@query(f"WITH {EV}, r AS (SELECT area_id, event_id, value, CAST(row_number() OVER (PARTITION BY area_id ORDER BY value DESC, event_id) AS INTEGER) AS rank FROM ev) SELECT * FROM r WHERE rank <= 3")
def w12_top_k_per_group(spark, d):
    return windows.top_k_per_group(events(spark, d).select("area_id", "event_id", "value"), ["area_id"], [F.desc("value"), F.asc("event_id")], 3)


@query(f"WITH {EV}, c AS (SELECT area_id, category, count(*) AS n FROM ev GROUP BY ALL) SELECT area_id, category, n, round(n / sum(n) OVER (PARTITION BY area_id), 6) AS share FROM c")
def w13_share(spark, d):
    c = events(spark, d).groupBy("area_id", "category").agg(F.count(F.lit(1)).alias("n"))
    return rounded(windows.share(c, "n", ["area_id"]))


@dated(f"WITH {DP} SELECT area_id, date, lead(label, 1) OVER w AS label_h1, lead(label, 7) OVER w AS label_h7 FROM dp WINDOW w AS (PARTITION BY area_id ORDER BY date)")
def w14_lead_targets(spark, d):
    return windows.lead_targets(_daily(spark, d), "label", [1, 7], ["area_id"], "date").select("area_id", "date", "label_h1", "label_h7")


@query(f"WITH {DP}, l AS (SELECT area_id, date, lag(event_count, 1) OVER (PARTITION BY area_id ORDER BY date) AS p FROM dp) SELECT area_id, CAST(arg_max(p, date) AS BIGINT) AS event_count_lag1 FROM l GROUP BY area_id")
def w15_last_lag(spark, d):
    return windows.last_lag(_daily(spark, d), "event_count", ["area_id"], "date")


@query(f"WITH {EV}, r AS (SELECT area_id, value, row_number() OVER (PARTITION BY area_id ORDER BY ts DESC, event_id DESC) AS n FROM ev) SELECT area_id, round(avg(value), 6) AS value_recent_mean FROM r WHERE n <= 168 GROUP BY area_id")
def w16_recent_mean(spark, d):
    return rounded(windows.recent_mean(events(spark, d), "value", 168, ["area_id"], ["ts", "event_id"]))


@query(f"WITH {EV}, c AS (SELECT CAST(date_diff('day', DATE '2024-01-01', date) AS BIGINT) AS k, avg(score) AS score FROM ev GROUP BY ALL), g AS (SELECT k, score, score - lag(score) OVER (ORDER BY k) AS gain, max(score) OVER (ORDER BY k) AS best FROM c) SELECT k, round(score, 6) AS score, round(gain, 6) AS gain, round(best, 6) AS best, (max(gain) OVER w < 0.001) AND (count(gain) OVER w >= 3) AS plateau FROM g WINDOW w AS (ORDER BY k ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)")
def w17_curve_summary(spark, d):
    c = events(spark, d).groupBy(F.datediff("date", F.lit("2024-01-01").cast("date")).cast("long").alias("k")).agg(F.avg("score").alias("score"))
    return rounded(windows.curve_summary(c, "k", "score"))


@query(f"""WITH {EV}, k AS (SELECT area_id, CASE WHEN month(date) IN (12, 1, 2) THEN 'Winter' WHEN month(date) <= 5 THEN 'Spring' WHEN month(date) <= 8 THEN 'Summer' ELSE 'Fall' END AS season, CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, hour FROM ev),
 g AS (SELECT area_id, season, CAST(dow AS INTEGER) AS day_of_week, CAST(h AS INTEGER) AS hour FROM (SELECT DISTINCT area_id FROM k) CROSS JOIN (VALUES ('Winter'), ('Spring'), ('Summer'), ('Fall')) s(season) CROSS JOIN range(7) t(dow) CROSS JOIN range(24) u(h))
 SELECT g.*, coalesce(n, 0) AS event_count, CAST(coalesce(n, 0) >= 6 AS INTEGER) AS label FROM g LEFT JOIN (SELECT *, count(*) AS n FROM k GROUP BY ALL) c USING (area_id, season, day_of_week, hour)""")
def n01_calendar_panel(spark, d):
    return panel.calendar_panel(events(spark, d))


@dated(f"""WITH {EV} SELECT a.area_id, dd.date, CAST(h AS INTEGER) AS hour, coalesce(n, 0) AS event_count, CAST(coalesce(n, 0) >= 1 AS INTEGER) AS label FROM (SELECT DISTINCT area_id FROM ev) a
 CROSS JOIN (SELECT CAST(unnest(generate_series(DATE '2024-01-10', DATE '2024-01-16', INTERVAL 1 DAY)) AS DATE) AS date) dd CROSS JOIN range(24) t(h) LEFT JOIN (SELECT area_id, date, hour, count(*) AS n FROM ev GROUP BY ALL) c ON c.area_id = a.area_id AND c.date = dd.date AND c.hour = h""")
def n02_hourly_panel(spark, d):
    return panel.hourly_panel(events(spark, d), "2024-01-10", "2024-01-16")


@dated(f"WITH {DP.replace('generate_series(min(date)', 'generate_series(least(min(date), max(date) - 59)')} SELECT area_id, date, event_count, label FROM dp")
def n03_daily_panel(spark, d):
    return panel.daily_panel(events(spark, d), 60)


@dated(f"WITH {EV}, c AS (SELECT area_id, category, date, count(*) AS n FROM ev GROUP BY ALL), m AS (SELECT area_id, category, min(date) AS lo, max(date) AS hi FROM c GROUP BY ALL), s AS (SELECT area_id, category, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM m) SELECT s.*, coalesce(n, 0) AS n FROM s LEFT JOIN c USING (area_id, category, date)")
def n04_densify(spark, d):
    c = events(spark, d).groupBy("area_id", "category", "date").agg(F.count(F.lit(1)).alias("n"))
    return panel.densify(c, ["area_id", "category"], "date", ["n"])


def _weather(spark, d):
    o = table(spark, d, "orders")
    return o.groupBy(F.to_date("o_orderdate").alias("date")).agg(F.max("o_totalprice").alias("tmax"), F.min("o_totalprice").alias("tmin"), F.count(F.lit(1)).alias("n")).where("n % 3 > 0")


WE = "we AS (SELECT * FROM (SELECT CAST(o_orderdate AS DATE) AS date, max(o_totalprice) AS tmax, min(o_totalprice) AS tmin, count(*) AS n FROM orders GROUP BY ALL) WHERE n % 3 > 0)"


@dated(f"WITH {WE}, s AS (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM we) SELECT s.date, tmax, tmin FROM s LEFT JOIN we USING (date)")
def n05_densify_dates(spark, d):
    return panel.densify_dates(_weather(spark, d)).select("date", "tmax", "tmin")


@dated(f"""WITH {WE}, s AS (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM we), f AS (SELECT s.date, tmax, isoyear(s.date) AS y, weekofyear(s.date) AS w FROM s LEFT JOIN we USING (date)),
 m AS (SELECT y + 1 AS y, w, avg(tmax) AS a FROM f GROUP BY ALL) SELECT f.date, round(coalesce(f.tmax, m.a), 6) AS tmax FROM f LEFT JOIN m USING (y, w)""")
def n06_fill_prev_year_week(spark, d):
    return rounded(panel.fill_prev_year_week(panel.densify_dates(_weather(spark, d)).select("date", "tmax"), ["tmax"]))


@dated(f"WITH {WE} SELECT date FROM (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM we) WHERE date NOT IN (SELECT date FROM we)")
def n07_missing_dates(spark, d):
    return panel.missing_dates(_weather(spark, d))


@dated(f"WITH {EV} SELECT area_id, date, CAST(sum(label) AS BIGINT) AS base FROM ev GROUP BY ALL")
def n08_daily_base(spark, d):
    return panel.daily_base(events(spark, d), ["event_count", "label"], ["area_id", "date"])


@query(f"""WITH {EV}, a AS (SELECT area_id, round(avg(value), 6) AS value, arg_max(label, ts) AS label FROM ev GROUP BY area_id), t AS (SELECT CAST(h AS INTEGER) AS horizon, date_trunc('hour', (SELECT max(ts) FROM ev)) + h * INTERVAL 1 HOUR AS ts FROM range(1, 25) r(h))
 SELECT area_id, value, label, horizon, ts, CAST(ts AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week, CAST(month(ts) AS INTEGER) AS month,
 CASE WHEN month(ts) IN (12, 1, 2) THEN 'Winter' WHEN month(ts) <= 5 THEN 'Spring' WHEN month(ts) <= 8 THEN 'Summer' ELSE 'Fall' END AS season, CAST(isodow(ts) >= 6 AS INTEGER) AS is_weekend, CAST(hour(ts) >= 22 OR hour(ts) <= 5 AS INTEGER) AS is_night, CAST(hour(ts) BETWEEN 8 AND 18 AS INTEGER) AS is_business_hour FROM a CROSS JOIN t""", ("date", "ts"))
def n09_future_grid(spark, d):
    return rounded(panel.future_grid(events(spark, d), 24, ["value"], ["label"]))


@query(f"WITH {EV} SELECT area_id, arg_max(event_id, (ts, event_id)) AS event_id FROM ev GROUP BY area_id")
def t02_dedupe_last(spark, d):
    return project.dedupe(events(spark, d), ["area_id"], ["ts", "event_id"]).select("area_id", "event_id")


@query(f"WITH {EV} SELECT DISTINCT area_id, category FROM ev")
def t03_distinct(spark, d):
    return events(spark, d).select("area_id", "category").distinct()


@query(f"WITH {EV} SELECT event_id, value FROM ev ORDER BY value DESC, event_id LIMIT 20")
def t04_top_k(spark, d):
    return topk.top_k(events(spark, d).select("event_id", "value"), [F.desc("value"), F.asc("event_id")], 20)


@dated(f"WITH {EV}, s AS (SELECT area_id, date, hour, avg(score) AS score FROM ev GROUP BY ALL), r AS (SELECT area_id, date, hour, round(score, 6) AS score, CAST(row_number() OVER (PARTITION BY hour ORDER BY score DESC, area_id) AS INTEGER) AS rank FROM s WHERE date = (SELECT max(date) FROM s)) SELECT * FROM r WHERE rank <= 5")
def t05_top_slots(spark, d):
    s = events(spark, d).groupBy("area_id", "date", "hour").agg(F.avg("score").alias("score"))
    return rounded(topk.top_slots(s, 5))


_WIDE = f"""WITH {EV}, c AS (SELECT area_id, category, count(*) AS n FROM ev GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY area_id ORDER BY n DESC, category) AS rank FROM c)
 SELECT area_id, {', '.join(f"coalesce(max(CASE WHEN rank = {i} THEN category END), '') AS top{i}, coalesce(max(CASE WHEN rank = {i} THEN n END), 0) AS top{i}_n" for i in (1, 2, 3))} FROM r WHERE rank <= 3 GROUP BY area_id"""


@query(_WIDE)
def t06_top_categories_wide(spark, d):
    return topk.top_categories_wide(events(spark, d), ["area_id"])


@query(f"WITH {EV}, c AS (SELECT area_id, category, count(*) AS n FROM ev GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY area_id ORDER BY n DESC, category) AS rank FROM c) SELECT area_id, {', '.join(f'max(CASE WHEN rank = {i} THEN category END) AS category_{i}' for i in (1, 2, 3))} FROM r WHERE rank <= 3 GROUP BY area_id")
def t07_pivot_ranked(spark, d):
    c = events(spark, d).groupBy("area_id", "category").agg(F.count(F.lit(1)).alias("n"))
    return topk.pivot_ranked(windows.top_k_per_group(c, ["area_id"], [F.desc("n"), F.asc("category")], 3), ["area_id"], "category")


@query('SELECT "column", round(total, 2) AS total FROM (SELECT sum(l_quantity) AS l_quantity, sum(l_extendedprice) AS l_extendedprice, sum(l_discount) AS l_discount, sum(l_tax) AS l_tax FROM lineitem) UNPIVOT (total FOR "column" IN (l_quantity, l_extendedprice, l_discount, l_tax)) ORDER BY total DESC, "column" LIMIT 2')
def t08_top_columns(spark, d):
    return rounded(topk.top_columns(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], 2), 2)


@query(f"""WITH {EV}, c AS (SELECT area_id, category, count(*) AS n FROM ev GROUP BY ALL), s AS (SELECT *, n / sum(n) OVER (PARTITION BY area_id) AS share, row_number() OVER (PARTITION BY area_id ORDER BY n DESC, category) AS rank FROM c)
 SELECT area_id, string_agg(category || ':' || CAST(CAST(round(share * 10000) AS INTEGER) AS VARCHAR), ',' ORDER BY rank) AS top FROM s WHERE rank <= 3 GROUP BY area_id""")
def t09_top_share(spark, d):
    top = topk.top_share(events(spark, d), ["area_id"])
    return top.select("area_id", F.array_join(F.transform("top", lambda x: F.concat_ws(":", x["category"], F.round(x["share"] * 10000).cast("int").cast("string"))), ",").alias("top"))


@query(f"WITH {EV} SELECT event_id, area_id, NULL::DOUBLE AS extra FROM ev WHERE category = 'click' UNION ALL SELECT event_id, area_id, value FROM ev WHERE category = 'view'")
def u01_union_all(spark, d):
    e = events(spark, d)
    return topk.union_all([e.where("category = 'click'").select("event_id", "area_id"), e.where("category = 'view'").select("event_id", "area_id", F.col("value").alias("extra"))])


@dated(f"""WITH {EV}, b AS (SELECT area_id, date, count(*) AS n, 0 AS v FROM ev WHERE date <= DATE '2024-01-20' GROUP BY ALL), i AS (SELECT area_id, date, count(*) * 10 AS n, 1 AS v FROM ev WHERE date >= DATE '2024-01-15' GROUP BY ALL), u AS (SELECT * FROM b UNION ALL SELECT * FROM i),
 l AS (SELECT area_id, date, arg_max(n, v) AS n FROM u GROUP BY ALL) SELECT area_id, date, n FROM l WHERE date > (SELECT max(date) FROM l) - INTERVAL 14 DAY""")
def u02_upsert(spark, d):
    e = events(spark, d)
    daily = e.groupBy("area_id", "date").agg(F.count(F.lit(1)).alias("n"))
    base = daily.where("date <= DATE'2024-01-20'").withColumn("v", F.lit(0))
    inc = daily.where("date >= DATE'2024-01-15'").select("area_id", "date", (F.col("n") * 10).alias("n"), F.lit(1).alias("v"))
    return topk.upsert(base, inc, ["area_id", "date"], ["v"], "date", 14).select("area_id", "date", "n")


@query(f"WITH {EV} SELECT count(*) AS overlap FROM (SELECT area_id FROM ev WHERE date < DATE '2024-01-05' INTERSECT SELECT area_id FROM ev WHERE date > DATE '2024-01-25')")
def u03_overlap(spark, d):
    e = events(spark, d)
    return topk.overlap(e.where("date < DATE'2024-01-05'").select("area_id"), e.where("date > DATE'2024-01-25'").select("area_id"))


@query("SELECT event_type AS value FROM events UNION SELECT o_orderstatus FROM orders UNION SELECT c_mktsegment FROM customer")
def u04_vocab(spark, d):
    return topk.vocab([table(spark, d, "events").select(F.col("event_type").alias("x")), table(spark, d, "orders").select(F.col("o_orderstatus").alias("x")), table(spark, d, "customer").select(F.col("c_mktsegment").alias("x"))], "x")


@dated(f"WITH {EV} SELECT area_id, date FROM (SELECT DISTINCT area_id, date FROM ev) EXCEPT SELECT area_id, date FROM ev WHERE category = 'click'")
def u05_difference(spark, d):
    e = events(spark, d)
    return e.select("area_id", "date").subtract(e.where("category = 'click'").select("area_id", "date"))


@query("WITH x AS (SELECT DISTINCT p_type AS value FROM part), old AS (SELECT value, row_number() OVER (ORDER BY value DESC) - 1 AS id FROM x WHERE value < 'M'), nw AS (SELECT value, (SELECT coalesce(max(id), -1) FROM old) + row_number() OVER (ORDER BY value) AS id FROM x WHERE value NOT IN (SELECT value FROM old)) SELECT value, CAST(id AS BIGINT) AS id FROM old UNION ALL SELECT value, CAST(id AS BIGINT) FROM nw")
def u06_assign_ids(spark, d):
    from pyspark.sql import Window

    x = table(spark, d, "part").select(F.col("p_type").alias("value")).distinct()
    old = x.where("value < 'M'").withColumn("id", F.row_number().over(Window.orderBy(F.desc("value"))) - 1)
    return topk.assign_ids(x, old)
