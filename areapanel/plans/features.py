"""Typing, keys, joins, spatial features, aggregates, bins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar, keys, numbers
from ..operators import aggregate, binning, enrich, project, scan, spatial
from .registry import CE, ED, EV, PO, cell_edges, dated, events, pois, query, rounded, table, user_edges

# --- functions -------------------------------------------------------------------------------------------------


@query("""SELECT user_id AS id, lpad(left(regexp_extract('140' || user_id || 'US' || user_id, '([0-9]+)', 1), 6), 6, '0') AS first_run, lpad(right(regexp_replace('140' || user_id || 'US' || user_id, '[^0-9]', '', 'g'), 5), 5, '0') AS all_digits,
 lpad(CAST(user_id AS VARCHAR), 11, '0') AS padded FROM (SELECT DISTINCT user_id FROM events)""")
def f01_normalize_key(spark, d):
    ids = table(spark, d, "events").select(F.col("user_id").alias("id")).distinct()
    raw = F.concat(F.lit("140"), F.col("id").cast("string"), F.lit("US"), F.col("id").cast("string"))
    return ids.select("id", keys.normalize_key(raw, 6).alias("first_run"), keys.normalize_key(raw, 5, "right", "all_digits").alias("all_digits"), keys.normalize_key("id", 11, mode="pad_only").alias("padded"))


@query("SELECT CAST(mode(l) AS INTEGER) AS key_length FROM (SELECT length(CAST(o_orderkey AS VARCHAR)) AS l FROM orders)")
def f02_longest_common_length(spark, d):
    return table(spark, d, "orders").agg(keys.longest_common_length(F.col("o_orderkey").cast("string")).alias("key_length"))


@query(f"""WITH {EV} SELECT event_id, CAST(hour // 3 * 3 AS INTEGER) AS hr_key, lpad(CAST(hour // 3 * 3 AS VARCHAR), 2, '0') || '-' || lpad(CAST(hour // 3 * 3 + 3 AS VARCHAR), 2, '0') AS label24,
 lpad(CAST(hour // 3 * 3 AS VARCHAR), 2, '0') || '-' || lpad(CAST((hour // 3 * 3 + 3) % 24 AS VARCHAR), 2, '0') AS label00, lpad(CAST(hour AS VARCHAR), 2, '0') || '-' || lpad(CAST((hour + 1) % 24 AS VARCHAR), 2, '0') AS hourly FROM ev""")
def f03_hour_bins(spark, d):
    k = keys.hour_key("hour")
    return events(spark, d).select("event_id", k.alias("hr_key"), keys.hour_label(k).alias("label24"), keys.hour_label(k, style="00").alias("label00"), keys.hour_label("hour", 1, "00").alias("hourly"))


@query(f"WITH {EV}, t AS (SELECT event_id, CASE event_id % 3 WHEN 0 THEN hour || '–' || (hour + 1) WHEN 1 THEN ' ' || hour || ' - ' || (hour + 1) ELSE 'x' || hour END AS label, hour FROM ev) SELECT event_id, label, CASE WHEN event_id % 3 < 2 THEN hour END AS parsed FROM t")
def f04_parse_hour_label(spark, d):
    h, n = F.col("hour").cast("string"), (F.col("hour") + 1).cast("string")
    label = F.when(F.col("event_id") % 3 == 0, F.concat(h, F.lit("–"), n)).when(F.col("event_id") % 3 == 1, F.concat(F.lit(" "), h, F.lit(" - "), n)).otherwise(F.concat(F.lit("x"), h))
    return events(spark, d).select("event_id", label.alias("label")).withColumn("parsed", keys.parse_hour_label("label"))


_SEASON = "CASE WHEN month({0}) IN (12, 1, 2) THEN 'Winter' WHEN month({0}) <= 5 THEN 'Spring' WHEN month({0}) <= 8 THEN 'Summer' ELSE 'Fall' END".format


@dated(f"""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, strftime(o_orderdate, '%H:%M:%S') AS time, CAST(hour(o_orderdate) AS INTEGER) AS hour, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS day_of_week, CAST(month(o_orderdate) AS INTEGER) AS month, CAST(year(o_orderdate) AS INTEGER) AS year,
 CAST(isoyear(o_orderdate) AS INTEGER) AS iso_year, CAST(weekofyear(o_orderdate) AS INTEGER) AS iso_week, {_SEASON('o_orderdate')} AS season, CAST(isodow(o_orderdate) >= 6 AS INTEGER) AS is_weekend, CAST(hour(o_orderdate) >= 22 OR hour(o_orderdate) <= 5 AS INTEGER) AS is_night,
 CAST(hour(o_orderdate) BETWEEN 8 AND 15 AS INTEGER) AS is_school_hour, CAST(hour(o_orderdate) BETWEEN 9 AND 17 AND isodow(o_orderdate) < 6 AS INTEGER) AS is_business_hour FROM orders""")
def f05_calendar_parts(spark, d):
    return calendar.calendar_parts(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate").drop("o_orderdate")


@query("SELECT event_id, strftime(ts - INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS local, strftime(date_trunc('hour', ts - INTERVAL 8 HOUR), '%Y-%m-%d %H') AS slot FROM events")
def f06_local_time(spark, d):
    # The events lie in January, when the zone is eight hours behind.
    local = calendar.to_local(F.col("ts"), "America/Los_Angeles")
    return table(spark, d, "events").select("event_id", F.date_format(local, "yyyy-MM-dd HH:mm:ss").alias("local"), F.date_format(F.date_trunc("hour", local), "yyyy-MM-dd HH").alias("slot"))


@query(f"SELECT o_orderkey, {_SEASON('o_orderdate')} AS season, CAST(month(o_orderdate) IN (11, 12, 1, 2, 3) AS INTEGER) AS is_wet FROM orders")
def f07_season(spark, d):
    return table(spark, d, "orders").select("o_orderkey", calendar.season(F.to_date("o_orderdate")).alias("season"), F.month("o_orderdate").isin(11, 12, 1, 2, 3).cast("int").alias("is_wet"))


@query(f"WITH {EV} SELECT event_id, CAST(isodow(date) >= 6 AS INTEGER) AS is_weekend, CAST(hour >= 22 OR hour <= 5 AS INTEGER) AS is_night, CAST(hour BETWEEN 7 AND 16 AS INTEGER) AS is_school_hour, CAST(hour BETWEEN 9 AND 17 AND isodow(date) < 6 AS INTEGER) AS is_business_hour FROM ev")
def f08_time_flags(spark, d):
    h, day = F.col("hour"), F.col("date")
    return events(spark, d).select("event_id", calendar.is_weekend(day).alias("is_weekend"), calendar.is_night(h).alias("is_night"), calendar.is_between_hours(h, 7, 16).alias("is_school_hour"), calendar.is_between_hours(h, 9, 17, day).alias("is_business_hour"))


@dated("""WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date FROM orders), f AS (SELECT *, isodow(date) AS w, month(date) AS m, day(date) AS k, month(date + 1) AS m1, day(date + 1) AS k1, month(date - 1) AS m0, day(date - 1) AS k0, year(date) AS y FROM o)
 SELECT o_orderkey, date, CAST((m = 1 AND k = 1) OR (m = 7 AND k = 4) OR (m = 11 AND k = 11) OR (m = 12 AND k = 25)
 OR (w = 5 AND ((m1 = 1 AND k1 = 1) OR (m1 = 7 AND k1 = 4) OR (m1 = 11 AND k1 = 11) OR (m1 = 12 AND k1 = 25))) OR (w = 1 AND ((m0 = 1 AND k0 = 1) OR (m0 = 7 AND k0 = 4) OR (m0 = 11 AND k0 = 11) OR (m0 = 12 AND k0 = 25)))
 OR (y >= 2021 AND ((m = 6 AND k = 19) OR (w = 5 AND m1 = 6 AND k1 = 19) OR (w = 1 AND m0 = 6 AND k0 = 19)))
 OR (w = 1 AND m IN (1, 2) AND k BETWEEN 15 AND 21) OR (w = 1 AND m = 5 AND k >= 25) OR (w = 1 AND m = 9 AND k <= 7) OR (w = 1 AND m = 10 AND k BETWEEN 8 AND 14) OR (w = 4 AND m = 11 AND k BETWEEN 22 AND 28) AS INTEGER) AS is_holiday FROM f""")
def f09_holidays(spark, d):
    return calendar.with_holiday(table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("date")))


@dated("WITH w AS (SELECT CAST(o_orderdate AS DATE) AS date, max(o_totalprice) / 10000 AS tmax, min(o_totalprice) / 10000 AS tmin, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS prcp FROM orders GROUP BY ALL) SELECT date, round(tmax - tmin, 6) AS temp_range, CAST(prcp > 0 AS INTEGER) AS is_rainy, CAST(tmax > 25 AS INTEGER) AS is_hot_day, CAST(tmax >= 30 AS INTEGER) AS is_hot FROM w")
def f10_weather_flags(spark, d):
    w = table(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("date")).agg((F.max("o_totalprice") / 10000).alias("tmax"), (F.min("o_totalprice") / 10000).alias("tmin"), F.count_if(F.col("o_orderstatus") == "F").alias("prcp"))
    return rounded(w.select("date", (F.col("tmax") - F.col("tmin")).alias("temp_range"), (F.col("prcp") > 0).cast("int").alias("is_rainy"), (F.col("tmax") > 25).cast("int").alias("is_hot_day"), (F.col("tmax") >= 30).cast("int").alias("is_hot")))


@query(f"WITH {EV} SELECT event_id, CASE WHEN event_id % 2 = 0 THEN CAST(event_id AS VARCHAR) ELSE strftime(ts, '%Y%m%d%H%M%S') || '_' || format('{{:.6f}}', round(lat, 6)) || '_' || format('{{:.6f}}', round(lon, 6)) END AS id FROM ev")
def f11_synthetic_id(spark, d):
    own = F.when(F.col("event_id") % 2 == 0, F.col("event_id"))
    return events(spark, d).select("event_id", numbers.synthetic_id([own], F.col("ts"), F.col("lat"), F.col("lon")).alias("id"))


@query("SELECT DISTINCT p_type, upper(left(p_type, 1)) || lower(substr(p_type, 2)) AS title FROM part")
def f12_title(spark, d):
    return table(spark, d, "part").select("p_type", numbers.title(F.concat(F.lit("  "), "p_type")).alias("title")).distinct()


@query("SELECT p_partkey, CAST(CAST(round_even(CAST(p_size AS DOUBLE) / 80 * 100, 0) AS INTEGER) AS VARCHAR) || '%' AS share FROM part")
def f13_percent_text(spark, d):
    return table(spark, d, "part").select("p_partkey", numbers.percent_text(F.col("p_size").cast("double") / 80).alias("share"))


@query(f"WITH {EV} SELECT event_id, round(2 * 6371000.0::DOUBLE * asin(sqrt(least(1.0::DOUBLE, power(sin(radians(37.77::DOUBLE - lat) / 2), 2) + cos(radians(lat)) * cos(radians(37.77::DOUBLE)) * power(sin(radians(-122.42::DOUBLE - lon) / 2), 2)))), 3) AS haversine_m, round(6378137.0::DOUBLE * radians(lon), 3) AS x, round(6378137.0::DOUBLE * ln(tan(pi() / 4 + radians(lat) / 2)), 3) AS y FROM ev")
def f14_distances(spark, d):
    e = events(spark, d)
    return rounded(e.select("event_id", numbers.haversine(F.col("lat"), F.col("lon"), F.lit(37.77), F.lit(-122.42)).alias("haversine_m"), numbers.mercator_x(F.col("lon")).alias("x"), numbers.mercator_y(F.col("lat")).alias("y")), 3)


@query(f"WITH {EV}, c AS (SELECT event_id, least(greatest(score, 1e-9::DOUBLE), 1 - 1e-9::DOUBLE) AS p FROM ev) SELECT event_id, round(ln(p / (1 - p)), 6) AS logit, round(1 / (1 + exp(-ln(p / (1 - p)) / 2)), 6) AS tempered, round(power(p, 1.5::DOUBLE), 6) AS powered, round(least(greatest(p, 0.2::DOUBLE), 0.8::DOUBLE), 6) AS clipped FROM c")
def f15_score_functions(spark, d):
    s = F.col("score")
    return rounded(events(spark, d).select("event_id", numbers.logit(s).alias("logit"), numbers.sigmoid(numbers.logit(s) / 2).alias("tempered"), F.pow(numbers.clip(s, 1e-9, 1 - 1e-9), F.lit(1.5)).alias("powered"), numbers.clip(s, 0.2, 0.8).alias("clipped")))


@query(f"WITH {EV} SELECT area_id, round(1 - exp(-count(*) / 30.0::DOUBLE), 6) AS p FROM ev GROUP BY area_id")
def f16_poisson(spark, d):
    return rounded(events(spark, d).groupBy("area_id").agg((F.count(F.lit(1)) / 30.0).alias("r")).select("area_id", numbers.poisson_any(F.col("r")).alias("p")))


@query("SELECT p_partkey, CASE WHEN p_size % 5 > 0 THEN CAST(p_size % 5 AS INTEGER) END AS q, p_size / 10.0::DOUBLE AS number, 'a–b' AS dashes FROM part")
def f17_f18_f19_text_repair(spark, d):
    p = table(spark, d, "part")
    label = F.when(F.col("p_size") % 5 > 0, F.concat(F.lit("Q"), (F.col("p_size") % 5).cast("string"), F.lit(" (<=3)"))).otherwise("none")
    literal = F.concat(F.lit("[ "), (F.col("p_size") / 10.0).cast("string"), F.lit("]"))
    return p.select("p_partkey", numbers.quantile_of_label(label).alias("q"), numbers.list_number(literal).alias("number"), numbers.repair_dashes(F.lit("aâ€“b")).alias("dashes"))


@query("SELECT p_partkey, round((p_retailprice - min(p_retailprice) OVER ()) / (max(p_retailprice) OVER () - min(p_retailprice) OVER ()) * 3, 2) AS scaled FROM part")
def f20_scale(spark, d):
    return rounded(binning.scale_to(table(spark, d, "part"), "p_retailprice").select("p_partkey", "scaled"), 2)


@query("SELECT s_suppkey, round(least(s_acctbal, (SELECT quantile_cont(s_acctbal, 0.9) FROM supplier)), 6) AS s_acctbal FROM supplier")
def f21_winsorize(spark, d):
    return rounded(binning.winsorize_upper(table(spark, d, "supplier"), "s_acctbal", 0.9).select("s_suppkey", "s_acctbal"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_discount > 0.05 THEN l_discount ELSE 9999.0::DOUBLE END AS distance FROM lineitem")
def f22_sentinel(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.coalesce(F.when(F.col("l_discount") > 0.05, F.col("l_discount")), F.lit(9999.0)).alias("distance"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def f23_json_access(spark, d):
    return table(spark, d, "events").select("event_id", F.element_at(F.from_json("props", "map<string,int>"), "k").alias("k"))


# --- projections and typing ------------------------------------------------------------------------------------


@query("SELECT \"column\", n FROM (SELECT 'a' AS \"column\", count(CASE WHEN l_discount > 0.05 THEN 1 END) AS n, 0 AS i FROM lineitem UNION ALL SELECT 'b', count(CASE WHEN l_tax > 0.02 THEN 1 END), 1 FROM lineitem) ORDER BY n DESC, i LIMIT 1")
def p02_choose_densest(spark, d):
    li = table(spark, d, "lineitem").select(F.when(F.col("l_discount") > 0.05, F.col("l_shipdate")).alias("a"), F.when(F.col("l_tax") > 0.02, F.col("l_shipdate")).alias("b"))
    return project.choose_densest(li, ["a", "b"])


@query("SELECT n_nationkey AS id, n_name AS name FROM nation")
def p03_alias_columns(spark, d):
    return project.alias_columns(table(spark, d, "nation"), {"id": ["key", "N_NATIONKEY"], "name": ["n_name"]}).select("id", "name")


@query("SELECT n_nationkey, coalesce(CASE WHEN n_nationkey % 2 = 0 THEN n_name END, 'other') AS name FROM nation")
def p05_coalesce_suffixes(spark, d):
    n = table(spark, d, "nation").select("n_nationkey", F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")).alias("name_x"), F.lit("other").alias("name_y"))
    return project.coalesce_suffixes(n, ["name"])


@query("SELECT n_name, NULL::VARCHAR AS missing, n_nationkey FROM nation")
def p06_project(spark, d):
    return project.project(table(spark, d, "nation"), ["n_name", "missing", "n_nationkey"])


@query("SELECT r_regionkey FROM region")
def p07_drop_denied(spark, d):
    return project.drop_denied(table(spark, d, "region").withColumn("a_x", F.lit(1)), ("r_name",), ("_x",))


@query("SELECT n_nationkey, n_name, n_regionkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def p08_trim_overlap(spark, d):
    n = table(spark, d, "nation")
    r = table(spark, d, "region").select(F.col("r_regionkey").alias("n_regionkey"), F.lit("x").alias("n_name"), "r_name")
    return n.join(project.trim_overlap(n, r, ["n_regionkey"]), "n_regionkey")


@query(f"WITH {EV} SELECT event_id FROM ev WHERE lat BETWEEN 37.72 AND 37.75 AND lon BETWEEN -122.48 AND -122.42")
def p09_bbox_filter(spark, d):
    return project.bbox_filter(events(spark, d), 37.72, -122.48, 37.75, -122.42).select("event_id")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F'")
def p10_drop_null_keys(spark, d):
    return project.drop_null_keys(table(spark, d, "orders").withColumn("k", F.when(F.col("o_orderstatus") != "F", F.lit(1))), ["k", "absent"]).select("o_orderkey")


@query(f"WITH {EV} SELECT event_id FROM ev WHERE date > (SELECT max(date) FROM ev) - INTERVAL 7 DAY")
def p11_last_days(spark, d):
    return project.last_days(events(spark, d), 7).select("event_id")


@query(f"WITH {EV} SELECT event_id FROM ev WHERE ts >= (SELECT max(ts) FROM ev) - INTERVAL 48 HOUR")
def p12_last_hours(spark, d):
    return project.last_hours(events(spark, d), 48).select("event_id")


@query(f"WITH {EV}, m AS (SELECT max(date) AS hi FROM ev), c AS (SELECT sum(CASE WHEN label > 0 AND date > hi - INTERVAL 2 DAY THEN 1 ELSE 0 END) AS a, sum(CASE WHEN label > 0 AND date > hi - INTERVAL 5 DAY THEN 1 ELSE 0 END) AS b FROM ev, m) SELECT event_id FROM ev, m, c WHERE date_diff('day', date, hi) < CASE WHEN a >= 300 THEN 2 WHEN b >= 300 THEN 5 ELSE 10 END")
def p13_adaptive_window(spark, d):
    return project.adaptive_window(events(spark, d), [2, 5, 10], 300).select("event_id")


@query("SELECT c_custkey FROM customer WHERE c_mktsegment LIKE '%MACH%'")
def p14_substring_filter(spark, d):
    return table(spark, d, "customer").where(F.col("c_mktsegment").contains("MACH")).select("c_custkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW')")
def p15_exclude(spark, d):
    return table(spark, d, "orders").where(~F.col("o_orderpriority").isin("1-URGENT", "5-LOW")).select("o_orderkey")


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_retailprice ELSE -1.0::DOUBLE END AS number FROM part")
def p16_to_num(spark, d):
    text = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit(" "), F.format_number("p_retailprice", 4))).otherwise("n/a")
    return rounded(table(spark, d, "part").select("p_partkey", numbers.to_num(text, -1.0).alias("number")))


@dated("SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN CAST(o_orderdate AS DATE) END AS date FROM orders")
def p17_normalize_date(spark, d):
    text = F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "yyyyMMdd")).otherwise("soon")
    return project.normalize_date(table(spark, d, "orders").select("o_orderkey", text.alias("datetime"))).select("o_orderkey", "date")


@query("SELECT event_id, strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS slot FROM events")
def p18_parse_key_date(spark, d):
    return table(spark, d, "events").select("event_id", F.date_format(project.parse_key_date(F.date_format("ts", "yyyyMMddHH")), "yyyy-MM-dd HH").alias("slot"))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN NULL ELSE 1 END AS flag FROM orders")
def p19_to_flag(spark, d):
    word = F.when(F.col("o_orderstatus") == "F", " No ").when(F.col("o_orderstatus") == "O", "maybe").otherwise("YES")
    return table(spark, d, "orders").select("o_orderkey", numbers.to_flag(word).alias("flag"))


@query("SELECT 'p_brand' AS \"column\", count(p_brand) AS n, 0.0::DOUBLE AS numeric_share, 0.0::DOUBLE AS label_share, 'categorical' AS kind FROM part UNION ALL SELECT 'p_size', count(p_size), 1.0::DOUBLE, 0.0::DOUBLE, 'numeric' FROM part")
def p20_profile_columns(spark, d):
    return rounded(project.profile_columns(table(spark, d, "part").select("p_brand", "p_size")))


@query("SELECT 'one' AS \"column\", 1 AS n_distinct UNION ALL SELECT 'none', 0")
def p22_constant_columns(spark, d):
    return project.constant_columns(table(spark, d, "lineitem").select("l_quantity", "l_returnflag", F.lit(7).alias("one"), F.lit(None).cast("string").alias("none")))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_totalprice END AS price, CASE WHEN o_orderstatus = 'F' THEN 'unknown' ELSE o_orderpriority END AS priority FROM orders")
def p24_fill_typed(spark, d):
    f = F.col("o_orderstatus") == "F"
    return project.fill_typed(table(spark, d, "orders").select("o_orderkey", F.when(~f, F.col("o_totalprice")).alias("price"), F.when(~f, F.col("o_orderpriority")).alias("priority")))


@query("SELECT n_nationkey, '2024-01-31' AS snapshot FROM nation")
def p25_stamp(spark, d):
    return project.stamp(table(spark, d, "nation").select("n_nationkey"), snapshot="2024-01-31")


@dated(f"WITH {EV} SELECT event_id, date, hour, CAST(hour // 3 * 3 AS INTEGER) AS hr_key FROM ev")
def p26_ensure_time_keys(spark, d):
    e = events(spark, d).select("event_id", F.col("date").cast("string").alias("date"), keys.hour_label("hour", 1).alias("hour_range"))
    return project.ensure_time_keys(e).select("event_id", "date", "hour", "hr_key")


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_tax > 0.02 THEN l_tax END AS x FROM lineitem")
def p27_finite(spark, d):
    x = F.when(F.col("l_tax") > 0.02, F.col("l_tax")).when(F.col("l_tax") > 0.01, F.lit(float("inf"))).otherwise(F.lit(float("nan")))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", numbers.finite(x).alias("x"))


# --- joins -----------------------------------------------------------------------------------------------------


def _calls(spark, d):
    return aggregate.call_summary(events(spark, d).where("category = 'click'")).select("area_id", "date", "hr_key", F.col("bin_count").alias("calls"))


CA = "ca AS (SELECT area_id, date, CAST(hour // 3 * 3 AS INTEGER) AS hr_key, count(*) AS calls FROM ev WHERE category = 'click' GROUP BY ALL)"


def _keyed(spark, d):
    return events(spark, d).select("event_id", "area_id", "date", keys.hour_key("hour").alias("hr_key"))


@query(f"WITH {EV}, {CA} SELECT event_id, calls FROM ev LEFT JOIN ca ON ca.area_id = ev.area_id AND ca.date = ev.date AND ca.hr_key = ev.hour // 3 * 3")
def j01_enrich(spark, d):
    return enrich.enrich(_keyed(spark, d), _calls(spark, d), ["area_id", "date", "hr_key"]).select("event_id", "calls")


@query(f"WITH {EV}, {CA}, m AS (SELECT area_id, hr_key, isodow(date) - 1 AS dow, median(calls) AS calls FROM ca GROUP BY ALL) SELECT event_id, CAST(calls AS DOUBLE) AS calls FROM ev LEFT JOIN m ON m.area_id = ev.area_id AND m.hr_key = ev.hour // 3 * 3 AND dow = isodow(ev.date) - 1")
def j02_enrich_calendar(spark, d):
    dow = {"dow": F.weekday("date")}
    return enrich.enrich_calendar(_keyed(spark, d).withColumns(dow), _calls(spark, d).withColumns(dow), ["calls"], ["area_id", "hr_key", "dow"]).select("event_id", "calls")


@query(f"WITH {EV}, {CA}, a AS (SELECT area_id, date, hr_key, avg(calls) AS c FROM ca GROUP BY ALL), b AS (SELECT area_id, hr_key, avg(calls) AS c FROM ca GROUP BY ALL), e AS (SELECT area_id, avg(calls) AS c FROM ca GROUP BY ALL) SELECT event_id, round(coalesce(a.c, b.c, e.c), 6) AS calls FROM ev LEFT JOIN a ON a.area_id = ev.area_id AND a.date = ev.date AND a.hr_key = ev.hour // 3 * 3 LEFT JOIN b ON b.area_id = ev.area_id AND b.hr_key = ev.hour // 3 * 3 LEFT JOIN e ON e.area_id = ev.area_id")
def j03_enrich_fallback(spark, d):
    return rounded(enrich.enrich_fallback(_keyed(spark, d), _calls(spark, d), ["calls"], [["area_id", "date", "hr_key"], ["area_id", "hr_key"], ["area_id"]], per_row=True).select("event_id", "calls"))


@query("SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def j04_enrich_static(spark, d):
    return enrich.enrich_static(table(spark, d, "customer").withColumnRenamed("c_nationkey", "n_nationkey"), table(spark, d, "nation"), ["n_nationkey"]).select("c_custkey", "n_name")


@query("SELECT n_nationkey, count(s_suppkey) AS n FROM supplier RIGHT JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL")
def j05_keep_areas(spark, d):
    s = table(spark, d, "supplier").withColumnRenamed("s_nationkey", "n_nationkey")
    return enrich.enrich_static(s, table(spark, d, "nation"), ["n_nationkey"], keep="areas").groupBy("n_nationkey").agg(F.count("s_suppkey").alias("n"))


@query("SELECT coalesce(a.k, b.k) AS nation, a.n AS customers, b.n AS suppliers FROM (SELECT c_nationkey AS k, count(*) AS n FROM customer WHERE c_acctbal > 5000 GROUP BY ALL) a FULL JOIN (SELECT s_nationkey AS k, count(*) AS n FROM supplier WHERE s_acctbal > 5000 GROUP BY ALL) b ON a.k = b.k")
def j06_merge_summaries(spark, d):
    a = table(spark, d, "customer").where("c_acctbal > 5000").groupBy(F.col("c_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("customers"))
    b = table(spark, d, "supplier").where("s_acctbal > 5000").groupBy(F.col("s_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("suppliers"))
    return enrich.merge_summaries(a, b, ["nation"])


@query("SELECT c_custkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)")
def j08_restrict_to(spark, d):
    return enrich.restrict_to(table(spark, d, "customer").withColumnRenamed("c_nationkey", "n_nationkey"), table(spark, d, "nation").where("n_regionkey = 1"), ["n_nationkey"]).select("c_custkey")


@query("WITH k AS (SELECT DISTINCT o_custkey FROM orders) SELECT count(*) AS n, count(k.o_custkey) AS matched, round(count(k.o_custkey) / count(*), 6) AS match_rate FROM customer LEFT JOIN k ON c_custkey = o_custkey")
def j09_match_report(spark, d):
    return rounded(enrich.match_report(table(spark, d, "customer"), table(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"]))


@query("SELECT c_custkey, c_name FROM customer ANTI JOIN (SELECT o_custkey FROM orders WHERE o_custkey % 3 = 0) o ON o_custkey = c_custkey")
def j09_unmatched(spark, d):
    return enrich.unmatched(table(spark, d, "customer"), table(spark, d, "orders").where("o_custkey % 3 = 0").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"]).select("c_custkey", "c_name")


@query('SELECT o_orderkey AS o_key, o_custkey AS o_key_dup1, round(o_totalprice, 4) AS total FROM orders')
def p04_sanitize_columns(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("o key"), F.col("o_custkey").alias("o-key"), F.round("o_totalprice", 4).alias("total ($)"))
    return project.sanitize_columns(o)


@query("SELECT o_orderstatus, round(o_totalprice, 4) AS o_totalprice FROM orders")
def p23_drop_by_pattern(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.round("o_totalprice", 4).alias("o_totalprice"))
    return project.drop_by_pattern(o, "key$")


@query("SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders")
def p28_select_features(spark, d):
    return project.select_features(table(spark, d, "orders"), ["o_orderpriority", "absent", "o_orderstatus"], keep=("o_orderkey",))


@query(f"WITH {EV} SELECT e.event_id, l.label FROM ev e LEFT JOIN (SELECT area_id, date, max(label) AS label FROM ev GROUP BY ALL) l ON l.area_id = e.area_id AND l.date = e.date")
def j10_attach_label(spark, d):
    e = events(spark, d)
    return enrich.attach_label(e.drop("label"), e.select("area_id", "date", "label"), ["area_id", "date"]).select("event_id", "label")


@query(f"WITH {EV}, a AS (SELECT area_id, min(value) AS best FROM ev GROUP BY ALL) SELECT event_id, best FROM ev JOIN a USING (area_id)")
def j11_merge_on_area(spark, d):
    e = events(spark, d)
    return enrich.merge_on(e, e.select("area_id", F.col("value").alias("best"), "lat"), ["area_id"], ["best"]).select("event_id", "best")


@query(f"WITH {EV}, a AS (SELECT area_id, date, hour, min(value) AS best FROM ev GROUP BY ALL) SELECT event_id, best FROM ev JOIN a USING (area_id, date, hour)")
def j12_merge_on_area_time(spark, d):
    e = events(spark, d)
    k = ["area_id", "date", "hour"]
    return enrich.merge_on(e, e.select(*k, F.col("value").alias("best"), "lat"), k, ["best"]).select("event_id", "best")


@query(f"WITH {EV}, f AS (SELECT area_id, hour, avg(value) AS v FROM ev WHERE category = 'view' GROUP BY ALL), c AS (SELECT hour, avg(value) AS v FROM ev WHERE category = 'view' AND hour < 20 GROUP BY ALL) SELECT event_id, round(coalesce(f.v, c.v, 0), 6) AS rate FROM ev LEFT JOIN f ON f.area_id = ev.area_id AND f.hour = ev.hour LEFT JOIN c ON c.hour = ev.hour")
def j13_lookup_fallback(spark, d):
    e = events(spark, d)
    v = e.where("category = 'view'")
    fine, coarse = (v.groupBy("area_id", "hour").agg(F.avg("value").alias("rate")), v.where("hour < 20").groupBy("hour").agg(F.avg("value").alias("rate")))
    return rounded(enrich.lookup_fallback(e, fine, coarse, ["area_id", "hour"], ["hour"], "rate", 0.0).select("event_id", "rate"))


@query("WITH s AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS k, c_acctbal FROM customer), a AS (SELECT DISTINCT left(k, 4) AS area FROM s) SELECT area, round(p, 2) AS population FROM a JOIN (SELECT left(k, 4) AS area, sum(c_acctbal) AS p FROM s GROUP BY ALL) USING (area)")
def j14_join_hierarchical(spark, d):
    s = table(spark, d, "customer").select(F.lpad(F.col("c_custkey").cast("string"), 6, "0").alias("area"), F.col("c_acctbal").alias("population"))
    return rounded(enrich.join_hierarchical(s.select(F.left("area", F.lit(4)).alias("area")).distinct(), s, "area", "population"), 2)


@query(f"WITH {EV}, g AS (SELECT area_id, max(category) AS category FROM ev GROUP BY ALL) SELECT event_id, CASE WHEN event_id % 4 > 0 THEN ev.category ELSE g.category END AS category FROM ev JOIN g USING (area_id)")
def j17_backfill_column(spark, d):
    e = events(spark, d)
    empty = e.select("event_id", "area_id", F.when(F.col("event_id") % 4 > 0, F.col("category")).otherwise(" ").alias("category"))
    return enrich.backfill_column(empty, e.groupBy("area_id").agg(F.max("category").alias("category")), ["area_id"], "category").select("event_id", "category")


@query(f"WITH {EV} SELECT event_id, round(score, 6) AS score FROM ev")
def s15_attach_scores(spark, d):
    e = events(spark, d)
    return rounded(enrich.attach_scores(e.select("event_id"), e.select("event_id", F.col("score").alias("prob")), ["event_id"]))


# --- spatial ---------------------------------------------------------------------------------------------------


@query(f"WITH {EV}, {CE} SELECT event_id AS point_id, min(i.area_id) AS area_id FROM ev LEFT JOIN (SELECT event_id AS h, ce.area_id FROM ev JOIN ce ON (y1 > lat) <> (y2 > lat) AND lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1 GROUP BY ALL HAVING count(*) % 2 = 1) i ON h = event_id GROUP BY event_id")
def g01_tag_areas(spark, d):
    return spatial.tag_areas(events(spark, d).select(F.col("event_id").alias("point_id"), "lat", "lon"), cell_edges(spark, d))


_HAV = "2 * 6371000.0::DOUBLE * asin(sqrt(least(1.0::DOUBLE, power(sin(radians({1}.lat - {0}.lat) / 2), 2) + cos(radians({0}.lat)) * cos(radians({1}.lat)) * power(sin(radians({1}.lon - {0}.lon) / 2), 2))))".format
_MOVED = "pt AS (SELECT event_id, lat + CASE WHEN event_id % 5 = 0 THEN 0.20037193::DOUBLE ELSE 0.00041371::DOUBLE END AS lat, lon - CASE WHEN event_id % 7 = 0 THEN 0.30041371::DOUBLE ELSE 0.00037193::DOUBLE END AS lon FROM ev)"


@query(f"WITH {EV}, {CE}, {_MOVED}, m AS (SELECT area_id, (s + n) / 2 AS lat, (w + e) / 2 AS lon FROM box), i AS (SELECT event_id, min(area_id) AS area_id FROM (SELECT event_id, ce.area_id FROM pt JOIN ce ON (y1 > lat) <> (y2 > lat) AND lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1 GROUP BY ALL HAVING count(*) % 2 = 1) GROUP BY event_id), o AS (SELECT event_id, round({_HAV('pt', 'm')}, 1) AS dist, m.area_id FROM pt ANTI JOIN i USING (event_id) CROSS JOIN m), f AS (SELECT event_id, area_id FROM o QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY dist, area_id) = 1) SELECT pt.event_id AS point_id, coalesce(i.area_id, f.area_id) AS area_id FROM pt LEFT JOIN i USING (event_id) LEFT JOIN f USING (event_id)")
def g02_nearest_fallback(spark, d):
    e = events(spark, d)
    moved = e.select(F.col("event_id").alias("point_id"), (F.col("lat") + F.when(F.col("event_id") % 5 == 0, 0.20037193).otherwise(0.00041371)).alias("lat"), (F.col("lon") - F.when(F.col("event_id") % 7 == 0, 0.30041371).otherwise(0.00037193)).alias("lon"))
    return spatial.tag_areas(moved, cell_edges(spark, d), nearest_fallback=True)


@query("SELECT event_id, round(37.7::DOUBLE + event_id % 100 / 1000.0::DOUBLE, 6) AS lat, round(-122.5::DOUBLE + event_id % 70 / 1000.0::DOUBLE, 6) AS lon FROM events")
def g03_extract_point(spark, d):
    lat, lon = F.round(37.7 + F.col("event_id") % 100 / 1000.0, 6), F.round(-122.5 + F.col("event_id") % 70 / 1000.0, 6)
    a, b, k = lat.cast("string"), lon.cast("string"), F.col("event_id") % 4
    text = F.when(k == 1, F.concat(F.lit('{"type": "Point", "coordinates": ['), b, F.lit(", "), a, F.lit("]}"))).when(k == 2, F.concat(F.lit("POINT ("), b, F.lit(" "), a, F.lit(")"))).when(k == 3, F.concat(b, F.lit(", "), a))
    e = table(spark, d, "events").select("event_id", F.when(k == 0, a).alias("latitude"), F.when(k == 0, b).alias("longitude"), text.alias("location"))
    return rounded(spatial.extract_point(e).select("event_id", "lat", "lon"))




def _src(spark, d):
    return events(spark, d).select(F.col("event_id").alias("src_id"), "lat", "lon")


def _dst(spark, d):
    return pois(spark, d).select(F.col("poi_id").alias("dst_id"), F.col("lat").alias("dst_lat"), F.col("lon").alias("dst_lon"), "weight", "poi_type")


@query(f"WITH {EV}, {PO} SELECT event_id AS src_id, round(min({_HAV('ev', 'po')}), 1) AS distance FROM ev CROSS JOIN po GROUP BY event_id")
def g04_nearest_distance(spark, d):
    return spatial.nearest_distance(_src(spark, d), _dst(spark, d))


@query(f"WITH {EV}, {PO} SELECT event_id AS src_id, round(min(sqrt(power(6378137.0::DOUBLE * radians(ev.lon - po.lon), 2) + power(6378137.0::DOUBLE * (ln(tan(pi() / 4 + radians(ev.lat) / 2)) - ln(tan(pi() / 4 + radians(po.lat) / 2))), 2))), 1) AS distance FROM ev CROSS JOIN po GROUP BY event_id")
def g05_nearest_mercator(spark, d):
    return spatial.nearest_distance(_src(spark, d), _dst(spark, d), "webmercator")


@query(f"WITH {EV}, {PO}, p AS (SELECT event_id, weight, {_HAV('ev', 'po')} AS dist FROM ev CROSS JOIN po) SELECT event_id AS src_id, count(CASE WHEN dist <= 300 THEN 1 END) AS within_300, count(CASE WHEN dist <= 600 THEN 1 END) AS within_600, round(coalesce(sum(CASE WHEN dist <= 300 THEN weight END), 0), 4) AS sum_300, round(coalesce(sum(CASE WHEN dist <= 600 THEN weight END), 0), 4) AS sum_600 FROM p GROUP BY event_id")
def g06_g07_count_within(spark, d):
    return rounded(spatial.count_within(_src(spark, d), _dst(spark, d), [300, 600], "weight"), 4)


@query(f"WITH {EV}, {PO}, n AS (SELECT event_id, min({_HAV('ev', 'po')}) AS dist FROM ev CROSS JOIN po GROUP BY event_id), r AS (SELECT quantile_cont(round(dist, 1), 0.75) AS r FROM n) SELECT event_id AS src_id, count(CASE WHEN {_HAV('ev', 'po')} <= r THEN 1 END) AS n FROM ev CROSS JOIN po CROSS JOIN r GROUP BY event_id")
def g08_count_within_p75(spark, d):
    src, dst = _src(spark, d), _dst(spark, d)
    radius = scan.quantiles(spatial.nearest_distance(src, dst), {"distance": [0.75]}).first()[0][0]
    return spatial.count_within(src, dst, [radius]).toDF("src_id", "n")


@dated(f"WITH {EV}, {ED}, c AS (SELECT area_id, date, count(*) AS n FROM ev GROUP BY ALL) SELECT ed.area_id, date, CAST(sum(n) AS BIGINT) AS neighbor_n FROM ed JOIN c ON c.area_id = ed.neighbor GROUP BY ALL")
def g09_neighbor_sum(spark, d):
    return spatial.neighbor_sum(user_edges(spark, d), aggregate.daily_counts(events(spark, d)), "n", ["date"])


@query(f"WITH {EV}, {CE} SELECT a.area_id, b.area_id AS neighbor FROM cells x JOIN cells y ON abs(x.r - y.r) <= 1 AND abs(x.c - y.c) <= 1 AND (x.r, x.c) <> (y.r, y.c) JOIN box a ON a.area_id = 'cell_' || x.r || '_' || x.c JOIN box b ON b.area_id = 'cell_' || y.r || '_' || y.c")
def g10_build_adjacency(spark, d):
    e = cell_edges(spark, d).withColumns({c: F.round(c, 6) for c in ("x1", "y1", "x2", "y2")})
    return spatial.build_adjacency(e)


@query(f"WITH {EV}, {CE}, y AS (SELECT r, c, c * 0.01::DOUBLE + r % 2 * 0.005::DOUBLE AS x FROM cells) SELECT 'cell_' || a.r || '_' || a.c AS area_id, 'cell_' || b.r || '_' || b.c AS neighbor FROM y a JOIN y b ON (a.r, a.c) <> (b.r, b.c) AND abs(a.r - b.r) <= 1 AND abs(a.x - b.x) <= 0.01::DOUBLE + 1e-9")
def g10_bricks(spark, d):
    """Rows of areas set off by half a side: most neighbours share part of a side and no corner."""
    odd = F.split("area_id", "_")[1].cast("int") % 2 * 0.005
    return spatial.build_adjacency(cell_edges(spark, d).withColumns({"x1": F.col("x1") + odd, "x2": F.col("x2") + odd}))


_OFF = "sqrt(pow(greatest(box.w - lon, lon - box.e, 0.0) * cos(radians(lat)), 2) + pow(greatest(box.s - lat, lat - box.n, 0.0), 2)) * pi() * 6371000 / 180"


@query(f"WITH {EV}, {CE}, o AS (SELECT event_id, lat + 0.000031::DOUBLE AS lat, lon + 0.000043::DOUBLE AS lon FROM ev), p AS (SELECT event_id, area, min(d) AS d FROM (SELECT event_id, box.area_id AS area, {_OFF} AS d FROM o CROSS JOIN box JOIN cells ON box.area_id = 'cell_' || r || '_' || c WHERE (r + c) % 2 = 0) GROUP BY ALL), n AS (SELECT event_id, arg_min(area, (round(d, 1), area)) AS area FROM p WHERE d <= 300 GROUP BY event_id) SELECT event_id AS point_id, area AS area_id FROM ev LEFT JOIN n USING (event_id)")
def g02_nearest_boundary(spark, d):
    """Every other cell is an area; points elsewhere get the area whose boundary is nearest, within 300 m.

    Points are moved off the grid of their coordinates, so that none lies on a corner of two areas.
    """
    part = F.split("area_id", "_")
    edges = cell_edges(spark, d).where((part[1].cast("int") + part[2].cast("int")) % 2 == 0)
    return spatial.tag_areas(events(spark, d).select(F.col("event_id").alias("point_id"), (F.col("lat") + 0.000031).alias("lat"), (F.col("lon") + 0.000043).alias("lon")), edges, max_distance=300.0)


@query(f"WITH {EV}, {CE}, m AS (SELECT area_id, (s + n) / 2 AS lat, (w + e) / 2 AS lon FROM box) SELECT a.area_id, b.area_id AS neighbor FROM m a JOIN m b ON a.area_id <> b.area_id AND {_HAV('a', 'b')} <= 1300")
def g11_radius_adjacency(spark, d):
    return spatial.radius_adjacency(spatial.centroids(cell_edges(spark, d)), 1300)


@query(f"WITH {EV}, {CE} SELECT area_id, round((s + n) / 2, 6) AS lat, round((w + e) / 2, 6) AS lon FROM box")
def g12_centroids(spark, d):
    return rounded(spatial.centroids(cell_edges(spark, d)))


@query(f"WITH {EV} SELECT area_id, round(avg(lat), 6) AS lat, round(avg(lon), 6) AS lon FROM ev GROUP BY area_id")
def g13_event_centroids(spark, d):
    return rounded(spatial.event_centroids(events(spark, d)))


@query(f"WITH {EV}, k AS (SELECT area_id, 1.0::DOUBLE AS lat, 2.0::DOUBLE AS lon FROM (SELECT DISTINCT area_id FROM ev) WHERE CAST(area_id AS INTEGER) % 2 = 0), x AS (SELECT event_id, area_id, CASE WHEN event_id % 3 > 0 THEN lat END AS lat, CASE WHEN event_id % 3 > 0 THEN lon END AS lon FROM ev) SELECT event_id, round(coalesce(x.lat, k.lat, avg(x.lat) OVER w), 9) AS lat, round(coalesce(x.lon, k.lon, avg(x.lon) OVER w), 9) AS lon FROM x LEFT JOIN k USING (area_id) WINDOW w AS (PARTITION BY x.area_id)")
def g14_fill_coords(spark, d):
    e = events(spark, d)
    known = e.select("area_id").distinct().where(F.col("area_id").cast("int") % 2 == 0).select("area_id", F.lit(1.0).alias("lat"), F.lit(2.0).alias("lon"))
    some = e.select("event_id", "area_id", *[F.when(F.col("event_id") % 3 > 0, F.col(c)).alias(c) for c in ("lat", "lon")])
    return rounded(spatial.fill_coords(some, known).select("event_id", "lat", "lon"), 9)


@query(f"WITH {EV}, {PO} SELECT event_id AS src_id, CAST(round(min({_HAV('ev', 'po')}), 1) <= 300 AS INTEGER) AS is_near FROM ev CROSS JOIN po GROUP BY event_id")
def g15_near_flag(spark, d):
    return spatial.nearest_distance(_src(spark, d), _dst(spark, d)).select("src_id", (F.col("distance") <= 300).cast("int").alias("is_near"))


@query("WITH k AS (SELECT DISTINCT lpad(CAST(o_custkey AS VARCHAR), 5, '0') AS key FROM orders), l AS (SELECT DISTINCT right('99' || lpad(CAST(c_custkey AS VARCHAR), 5, '0'), 5) AS key FROM customer) SELECT 'customers' AS layer, 'right' AS side, count(*) AS overlap FROM k JOIN l USING (key)")
def g16_best_key_overlap(spark, d):
    k = table(spark, d, "orders").select(F.lpad(F.col("o_custkey").cast("string"), 5, "0").alias("key"))
    c = table(spark, d, "customer").select(F.concat(F.lit("99"), F.lpad(F.col("c_custkey").cast("string"), 5, "0")).alias("key"))
    return spatial.best_key_overlap(k, {"customers": c}, 5)


@query("SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'amenity' WHEN 1 THEN 'shop' END AS poi_category, CASE WHEN p_size % 3 < 2 THEN p_type END AS poi_subcategory, p_name AS poi_name FROM part")
def g17_poi_category(spark, d):
    key = F.when(F.col("p_size") % 3 == 0, "amenity").when(F.col("p_size") % 3 == 1, "shop").otherwise("office")
    tags = F.to_json(F.map_from_arrays(F.array(key, F.lit("name")), F.array("p_type", "p_name")))
    return spatial.poi_category(table(spark, d, "part").select("p_partkey", tags.alias("tags"))).drop("tags")


# --- aggregates ------------------------------------------------------------------------------------------------


@dated(f"WITH {EV}, b AS (SELECT area_id, date, CAST(hour // 3 * 3 AS INTEGER) AS hr_key, count(*) AS bin_count FROM ev GROUP BY ALL) SELECT *, CAST(sum(bin_count) OVER (PARTITION BY area_id, date) AS BIGINT) AS day_count FROM b")
def a01_call_summary(spark, d):
    return aggregate.call_summary(events(spark, d))


@dated(f"WITH {EV} SELECT area_id, date, count(*) AS n FROM ev GROUP BY ALL")
def a02_resum(spark, d):
    return aggregate.daily_counts(aggregate.call_summary(events(spark, d)), count="bin_count")


@dated(f"WITH {EV} SELECT area_id, date, count(*) AS n FROM ev GROUP BY ALL")
def a03_daily_counts(spark, d):
    return aggregate.daily_counts(events(spark, d))


@query(f"WITH {EV} SELECT area_id, CAST(isodow(date) - 1 AS INTEGER) AS dow, hour, round(avg(lat), 6) AS lat, round(avg(lon), 6) AS lon, round(avg(value), 6) AS value, count(*) AS n FROM ev GROUP BY ALL")
def a04_calendar_stats(spark, d):
    return rounded(events(spark, d).groupBy("area_id", F.weekday("date").alias("dow"), "hour").agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"), F.avg("value").alias("value"), F.count(F.lit(1)).alias("n")))


@query(f"WITH {EV} SELECT area_id, CAST(hour // 3 * 3 AS INTEGER) AS hr_key, round(median(value), 6) AS value FROM ev GROUP BY ALL")
def a05_median(spark, d):
    return rounded(events(spark, d).groupBy("area_id", keys.hour_key("hour").alias("hr_key")).agg(F.median("value").alias("value")))


@query("SELECT l_orderkey, CAST(sum(l_linenumber) AS BIGINT) AS line_count, min(l_quantity) AS distance_m, round(avg(l_tax), 6) AS l_tax FROM lineitem GROUP BY ALL")
def a06_rollup_by_name(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("line_count"), F.col("l_quantity").alias("distance_m"), "l_tax")
    return rounded(aggregate.rollup_by_name(li, ["l_orderkey"]))


@query(f"WITH {EV} SELECT date_part('hour', ts) AS h, count(DISTINCT area_id) AS areas, count(DISTINCT category) AS categories FROM ev GROUP BY ALL")
def a07_count_distinct(spark, d):
    return events(spark, d).groupBy(F.col("hour").cast("long").alias("h")).agg(F.countDistinct("area_id").alias("areas"), F.countDistinct("category").alias("categories"))


@query(f"WITH {EV}, c AS (SELECT area_id, category, count(*) AS n FROM ev WHERE value > 90 GROUP BY ALL), b AS (SELECT area_id, category, row_number() OVER (PARTITION BY area_id ORDER BY n DESC, category) AS r FROM c) SELECT a.area_id, coalesce(category, 'none') AS category FROM (SELECT DISTINCT area_id FROM ev) a LEFT JOIN b ON b.area_id = a.area_id AND r = 1")
def a08_mode_or(spark, d):
    e = events(spark, d).select("area_id", F.when(F.col("value") > 90, F.col("category")).alias("category"))
    return aggregate.mode_or(e, ["area_id"], "category", "none")


@query(f"WITH {EV}, c AS (SELECT area_id, category, count(*) AS n FROM ev GROUP BY ALL), s AS (SELECT *, n / sum(n) OVER (PARTITION BY area_id) AS share, row_number() OVER (PARTITION BY area_id ORDER BY n DESC, category) AS r FROM c) SELECT area_id, string_agg(upper(left(category, 1)) || substr(category, 2) || '(' || CAST(round_even(share * 100, 0) AS INTEGER) || '%)', ', ' ORDER BY r) AS category_mix FROM s WHERE r <= 3 GROUP BY area_id")
def a09_category_mix(spark, d):
    return aggregate.category_mix(events(spark, d), ["area_id"])


@query(f"WITH {EV}, c AS (SELECT hour, category, count(*) AS n FROM ev GROUP BY ALL) SELECT hour, category, n, round(n / sum(n) OVER (PARTITION BY hour), 6) AS share FROM c")
def a10_category_share(spark, d):
    return rounded(aggregate.category_share(events(spark, d), ["hour"]))


@query(f"WITH {EV} SELECT area_id, {_SEASON('date')} AS season, hour, round(avg(score), 6) AS mean, round(quantile_cont(score, 0.9), 6) AS p90, count(score) AS n FROM ev GROUP BY ALL")
def a11_seasonal_baseline(spark, d):
    return rounded(aggregate.seasonal_baseline(events(spark, d).withColumn("season", calendar.season(F.col("date"))), "score", ["area_id", "season", "hour"]))


@query(f"WITH {EV} SELECT area_id, round(avg(score), 6) AS mean_score, round(sum(score), 6) AS sum_score, count(*) AS n, CAST(sum(label) AS BIGINT) AS positives, round(avg(value), 6) AS mean_value, round(sum(label) / count(*), 6) AS rate FROM ev GROUP BY ALL")
def a12_report_by(spark, d):
    return rounded(aggregate.report_by(events(spark, d), ["area_id"], "score", "label", ["value"]))


@query(f"WITH {EV} SELECT 'hour' AS dimension, CAST(hour AS VARCHAR) AS member, count(*) AS n, round(avg(score), 6) AS mean_score FROM ev GROUP BY ALL UNION ALL SELECT 'category', category, count(*), round(avg(score), 6) FROM ev GROUP BY ALL")
def a13_report_by_dims(spark, d):
    return rounded(aggregate.report_by_dims(events(spark, d), ["hour", "category"], "score"))


@query(f"WITH {EV} SELECT category, round(avg(score), 6) AS mean_score, round(sum(score), 6) AS sum_score, count(*) AS n, CAST(sum(label) AS BIGINT) AS positives, round(sum(label) / count(*), 6) AS rate FROM ev GROUP BY ALL")
def a14_report_by_category(spark, d):
    return rounded(aggregate.report_by(events(spark, d), ["category"], "score", "label"))


@query(f"WITH {EV}, c AS (SELECT category, hour, count(*) AS n FROM ev GROUP BY ALL UNION ALL SELECT category, NULL, count(*) FROM ev GROUP BY ALL), s AS (SELECT *, n / sum(n) OVER (PARTITION BY hour) AS share, CAST(row_number() OVER (PARTITION BY hour ORDER BY n DESC, category) AS INTEGER) AS rank FROM c) SELECT category, hour, n, round(share, 6) AS share, rank, CAST((SELECT min(date) FROM ev) AS VARCHAR) AS first_date, CAST((SELECT max(date) FROM ev) AS VARCHAR) AS last_date FROM s WHERE rank <= 3")
def a15_top_categories(spark, d):
    return rounded(aggregate.top_categories(events(spark, d)).withColumns({c: F.col(c).cast("string") for c in ("first_date", "last_date")}))


@dated(f"WITH {EV} SELECT area_id, date, round(1 - product(1 - score), 6) AS any_score, round(sum(score), 6) AS sum_score, round(avg(score), 6) AS mean_score FROM ev GROUP BY ALL")
def a16_a17_daily_from_hourly(spark, d):
    return rounded(aggregate.daily_from_hourly(events(spark, d), ["area_id", "date"]))


@dated(f"WITH {EV}, c AS (SELECT area_id, date, category, count(*) AS n FROM ev GROUP BY ALL), m AS (SELECT area_id, date, arg_min(category, (-n, category)) AS top_category FROM c GROUP BY ALL) SELECT area_id, date, round(avg(score), 6) AS mean_score, round(sum(value), 6) AS sum_count, round(max(score), 6) AS max_score, any_value(top_category) AS top_category FROM ev JOIN m USING (area_id, date) GROUP BY ALL")
def a18_rollup_forecast(spark, d):
    return rounded(aggregate.rollup_forecast(events(spark, d), ["area_id", "date"], "score", "value", "category"))


@query(f"WITH {EV}, c AS (SELECT area_id, category, count(*) AS n FROM ev GROUP BY ALL), m AS (SELECT area_id, arg_min(category, (-n, category)) AS category FROM c GROUP BY ALL) SELECT area_id, round(avg(value), 9) AS value, round(avg(score), 9) AS score, any_value(m.category) AS category FROM ev JOIN m USING (area_id) GROUP BY area_id")
def a19_area_profile(spark, d):
    return rounded(aggregate.area_profile(events(spark, d), ["value", "score"], ["category"]), 9)


@query(f"WITH {EV} SELECT area_id, max(label) AS label FROM ev GROUP BY area_id")
def a20_area_label(spark, d):
    return aggregate.area_label(events(spark, d), "label")


@query("SELECT o_orderpriority, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 6) AS percent FROM orders GROUP BY ALL")
def a21_value_distribution(spark, d):
    return rounded(aggregate.value_distribution(table(spark, d, "orders"), "o_orderpriority"))


@query("WITH c AS (SELECT p_brand, count(*) AS n, sum(count(*)) OVER () AS t FROM part GROUP BY ALL) SELECT p_partkey, CASE WHEN n >= 50 AND n >= 0.04 * t THEN p_brand ELSE 'Other' END AS p_brand_grouped FROM part JOIN c USING (p_brand)")
def a22_group_rare(spark, d):
    return aggregate.group_rare(table(spark, d, "part"), "p_brand", 0.04, 50).select("p_partkey", "p_brand_grouped")


@query("WITH x AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 0 THEN o_totalprice END AS price, CASE WHEN o_orderkey % 7 > 0 THEN o_orderpriority END AS priority FROM orders), p AS (SELECT priority, count(*) AS n FROM x WHERE priority IS NOT NULL GROUP BY ALL) SELECT o_orderkey, round(coalesce(price, (SELECT median(price) FROM x)), 6) AS price, coalesce(priority, (SELECT arg_min(priority, (-n, priority)) FROM p)) AS priority FROM x")
def a23_impute(spark, d):
    x = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 5 > 0, F.col("o_totalprice")).alias("price"), F.when(F.col("o_orderkey") % 7 > 0, F.col("o_orderpriority")).alias("priority"))
    return rounded(aggregate.impute(x, ["price"], ["priority"]))


@query("SELECT CAST(isoyear(o_orderdate) AS INTEGER) AS iso_year, CAST(weekofyear(o_orderdate) AS INTEGER) AS iso_week, round(avg(o_totalprice), 9) AS mean FROM orders GROUP BY ALL")
def a24_weekly_mean(spark, d):
    o = table(spark, d, "orders")
    return rounded(o.groupBy(calendar.iso_year(F.to_date("o_orderdate")).alias("iso_year"), F.weekofyear("o_orderdate").alias("iso_week")).agg(F.avg("o_totalprice").alias("mean")), 9)


@query(f"WITH {EV} SELECT count(*) AS n_rows, 4 AS n_columns, CAST(min(date) AS VARCHAR) AS first_date, CAST(max(date) AS VARCHAR) AS last_date, count(DISTINCT date) AS n_dates, count(event_id) - count(DISTINCT event_id) AS repeated_ids, round(avg(CASE WHEN date > (SELECT max(date) FROM ev) - INTERVAL 10 DAY THEN CASE WHEN value > 90 THEN 1.0 ELSE 0.0 END END), 6) AS recent_null_rate FROM ev")
def a25_profile(spark, d):
    e = events(spark, d).select("event_id", "area_id", "date", F.when(F.col("value") <= 90, F.col("value")).alias("x"))
    return rounded(aggregate.profile(e, "event_id", "date", "x", 10).withColumns({c: F.col(c).cast("string") for c in ("first_date", "last_date")}))


@query("SELECT n_regionkey, count(*) AS areas, round(sum(c_acctbal), 2) AS population FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL")
def a27_population(spark, d):
    c = table(spark, d, "customer").withColumn("text", F.format_number("c_acctbal", 2))
    joined = c.join(table(spark, d, "nation"), c.c_nationkey == F.col("n_nationkey"))
    return rounded(joined.groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("areas"), F.sum(numbers.to_num(F.col("text"))).alias("population")), 2)


@query(f"WITH {EV} SELECT event_id, round(CASE category WHEN 'click' THEN (value + hour) / 2 WHEN 'view' THEN value END, 6) AS externals_score FROM ev")
def a28_externals_score(spark, d):
    e = events(spark, d).withColumn("none", F.lit(None).cast("double"))
    return rounded(aggregate.externals_score(e, {"click": ["value", "hour"], "view": ["value", "none"]}).select("event_id", "externals_score"))


@dated(f"WITH {EV} SELECT area_id, date, CAST(hour // 3 * 3 AS INTEGER) AS hr_key, round(avg(score), 6) AS score FROM ev GROUP BY ALL")
def a29_mean_score(spark, d):
    return rounded(events(spark, d).groupBy("area_id", "date", keys.hour_key("hour").alias("hr_key")).agg(F.avg("score").alias("score")))


# --- bins ------------------------------------------------------------------------------------------------------


@query("WITH s AS (SELECT quantile_cont(s_acctbal, 0.25) AS a, quantile_cont(s_acctbal, 0.75) AS b, min(s_acctbal) AS lo, max(s_acctbal) AS hi, count(*) AS n FROM supplier) SELECT CAST(greatest(2, least(10, ceil((hi - lo) / (2 * (b - a) / power(n, 1.0::DOUBLE / 3))))) AS INTEGER) AS bins FROM s")
def b01_fd_bins(spark, d):
    return binning.fd_bins(table(spark, d, "supplier"), "s_acctbal")


_EDGES = "e AS (SELECT list_sort(list_distinct(quantile_cont(p_retailprice, [0, 0.2, 0.4, 0.6, 0.8, 1.0]))) AS e FROM part), b AS (SELECT p_partkey, e, greatest(1, len(list_filter(e, lambda x: x < p_retailprice))) AS b FROM part, e)"
_INT = "CAST(CAST(trunc({}) AS INTEGER) AS VARCHAR)".format


@query(f"WITH {_EDGES} SELECT p_partkey, {_INT('e[b]')} || '-' || {_INT('e[b + 1]')} AS p_retailprice_range FROM b")
def b02_quantile_range(spark, d):
    return binning.quantile_range(table(spark, d, "part"), "p_retailprice").select("p_partkey", "p_retailprice_range")


@query(f"WITH {_EDGES} SELECT p_partkey, CASE WHEN b = 1 THEN 'Q1 (<=' || {_INT('e[2]')} || ')' ELSE 'Q' || b || ' (' || {_INT('e[b]')} || '-' || {_INT('e[b + 1]')} || ')' END AS p_retailprice_range FROM b")
def b03_quantile_q(spark, d):
    return binning.quantile_range(table(spark, d, "part"), "p_retailprice", style="q").select("p_partkey", "p_retailprice_range")


@query("WITH e AS (SELECT quantile_cont(CAST(p_size AS DOUBLE), [0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS e FROM part) SELECT p_partkey, 'Q' || least(5, greatest(1, len(list_filter(e, lambda x: x < p_size)))) AS p_size_range FROM part, e")
def b04_quintile(spark, d):
    return binning.quantile_range(table(spark, d, "part"), "p_size", style="q5").select("p_partkey", "p_size_range")


@query("SELECT p_partkey, CAST(greatest(1, ceil((p_retailprice - min(p_retailprice) OVER ()) / (max(p_retailprice) OVER () - min(p_retailprice) OVER ()) * 5)) AS INTEGER) AS bin FROM part")
def b05_equal_width(spark, d):
    return binning.equal_width(table(spark, d, "part"), "p_retailprice").select("p_partkey", "bin")


@query(f"WITH {EV}, q AS (SELECT quantile_cont(score, 0.8) AS a, quantile_cont(score, 0.9) AS b FROM ev) SELECT event_id, CASE WHEN score >= 0.66 THEN 'critical' WHEN score >= b THEN 'high' WHEN score >= a THEN 'medium' ELSE 'low' END AS level FROM ev, q")
def b06_risk_level(spark, d):
    return binning.risk_level(events(spark, d), "score", 0.66).select("event_id", "level")


@query(f"WITH {EV}, r AS (SELECT event_id, row_number() OVER (ORDER BY score, event_id) AS r, count(*) OVER () AS n FROM ev), t AS (SELECT event_id, greatest(1, (10 * (r - 1) + n - 2) // (n - 1)) AS k FROM r) SELECT event_id, CASE WHEN k <= 3 THEN 'low' WHEN k <= 7 THEN 'medium' ELSE 'high' END AS level FROM t")
def b07_level_from_decile(spark, d):
    from ..operators.windows import decile

    return decile(events(spark, d).select("event_id", "score"), "score", "event_id").select("event_id", binning.level_from_decile(F.col("decile")).alias("level"))
