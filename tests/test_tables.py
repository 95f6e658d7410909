"""The cleaning step, risk and forecast tables on odd rows, and the saved stack."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from areapanel.operators import clean, forecast, ml, risk

DAY = dt.date(2024, 1, 1)


def test_cleaning_odd_rows(spark):
    rows = [
        ("SF 0123", "2024-01-01", " theft ", "2.5", "Evet", "", None, "7", ""), ("0123", "2024-01-03", "THEFT", None, None, "x", "2", None, None), ("0123", "2024-01-09", "theft", "1,000", "no", "3.5", None, "9", "Bar"),
        (None, "never", None, "junk", "junk", None, "1", "8", "Bar"), ("none", None, "rare", "1", "1", "5", None, None, "Bar"),
    ]
    df = spark.createDataFrame(rows, "area_id string, date string, category string, event_count string, near string, distance string, class string, population string, kind string")
    out = clean.clean_panel(df, counts=["event_count", "absent"], flags=["near"], distances=["distance"], distance_ranges=["class"], medians=["population"], kinds=["kind"], externals={"Theft": ["distance", "absent"]}, min_share=0.5, min_count=2)
    got = {(r.area_id, str(r.date)): r for r in out.collect()}
    assert out.count() == 5 and len(got) == 4 and "absent" not in out.columns  # two rows have neither key nor day
    one, three, nine = (got["0123", f"2024-01-0{k}"] for k in (1, 3, 9))
    assert (one.event_count, one.near, one.distance, one["class"], one.population, one.kind, one.category, one.category_grouped) == (3, 1, 9999.0, 2, 7.0, "None", "Theft", "Theft")
    assert (three.event_count, three.population, three.nr_7d, three.nr_14d, three.distance) == (0, 8.0, 3.0, 3.0, 9999.0)
    assert (nine.event_count, nine.nr_7d, nine.nr_14d, nine.externals_score) == (1000, 0.0, 3.0, 3.5)
    assert {r.category_grouped for r in out.where("date is null").collect()} == {"Other"} and {r.nr_7d for r in out.where("date is null").collect()} == {0.0}


def test_cleaning_takes_what_there_is(spark):
    df = spark.createDataFrame([("1", 1), ("2", None)], "area_id string, label int")
    assert sorted(map(tuple, clean.clean_panel(df).collect())) == [("1", 1, 1), ("2", None, 0)]
    nothing = spark.createDataFrame([], "area_id string, date string, category string, label int, class string, population string")
    assert clean.clean_panel(nothing, distance_ranges=["class"], medians=["population"]).collect() == []
    blank = spark.createDataFrame([("1", None, None)], "area_id string, class string, population string")
    assert clean.clean_panel(blank, distance_ranges=["class"], medians=["population"]).first()[1:] == (3, 0.0)


def test_daily_risk(spark):
    hours = [("a", DAY, 0.5, 1.0), ("a", DAY, 0.5, 0.5), ("b", DAY, None, 0.1), ("c", DAY, 1.5, 2.0)]
    types = [("a", DAY, "x", 0.3), ("a", DAY, "y", 0.2), ("a", DAY, "y", 0.2), ("a", DAY, "", 9.0)]
    out = risk.daily_risk(spark.createDataFrame(hours, "area_id string, date date, score double, expected_count double"), 0.6, spark.createDataFrame(types, "area_id string, date date, category string, category_expected double"))
    got = {r.area_id: r for r in out.collect()}
    assert (got["a"].any_score, got["a"].expected_count, got["a"].top1, got["a"].top2, got["a"].top3) == (0.75, 1.5, "y", "x", None)
    assert got["a"].top1_chance == pytest.approx(1 - math.exp(-0.4)) and got["a"].top1_expected == pytest.approx(0.4)
    assert (got["b"].any_score, got["b"].level, got["b"].top1) == (0.0, "low", None)
    assert (got["c"].any_score, got["c"].level, got["c"].decile) == (1.0, "critical", 10)


def test_features_of_places(spark):
    areas = spark.createDataFrame([("a", 0.0, 0.0), ("b", 1.0, 1.0)], "area_id string, lat double, lon double")
    places = [(1, "a", "bar", 0.0, 0.001), (2, "a", "bank", 0.0, 0.0), (3, "a", None, 0.0, 0.0), (4, "a", "", 0.0, 0.0), (5, None, "bar", 0.0, 0.0)]
    p = spark.createDataFrame(places, "poi_id int, area_id string, poi_type string, lat double, lon double")
    ratings = spark.createDataFrame([("bar", 2.0)], "poi_type string, risk double")
    got = {r.area_id: r for r in risk.place_features(p, ratings, areas, [50, 500]).collect()}
    assert (got["a"].poi_count, got["a"].poi_risk, got["a"].poi_type, got["a"].within_50, got["a"].within_500, got["a"].sum_500) == (4, 2.0, "bank", 4, 5, 4.0)
    assert (got["b"].poi_count, got["b"].poi_type, got["b"].within_500) == (0, "No_POI", 0)


def test_forecast_tables_fall_back_to_all_areas(spark):
    at = lambda h: (DAY, h)
    slots = spark.createDataFrame([(a, *at(h), s, s, v) for a, h, s, v in [("a", 0, 0.2, 1.0), ("a", 1, 0.4, 1.0), ("a", 3, 0.1, 1.0), ("new", 0, 0.5, 9.0)]], "area_id string, date date, hour int, score double, expected_count double, value double")
    past = spark.createDataFrame([("a", 0, "x"), ("a", 0, "y"), ("a", 0, "y"), ("a", 5, "z"), ("b", 0, "x"), ("b", 0, "x")], "area_id string, hour int, category string")
    out = forecast.detailed_tables({"24h": slots, "7d": slots, "365d": slots}, past, [("value", "much", 1.5)])
    first = {(r.area_id, r.hour): r for r in out["24h"].collect()}
    assert [(x.category, round(x.share, 3)) for x in first["a", 0].top] == [("y", 0.667), ("x", 0.333)]
    assert [x.category for x in first["new", 0].top] == ["x", "y", "z"] and first["new", 0].top[0].chance == pytest.approx(0.25)
    assert first["new", 0].reasons == "much" and first["a", 1].reasons == "" and [x.category for x in first["a", 1].top] == ["x", "y", "z"]
    bins = {(r.area_id, r.hour): (round(r.score, 6), round(r.expected_count, 6)) for r in out["7d"].collect()}
    assert bins == {("a", 0): (0.3, 0.6), ("a", 3): (0.1, 0.1), ("new", 0): (0.5, 0.5)}
    days = {r.area_id: r for r in out["365d"].collect()}
    assert round(days["a"].expected_count, 6) == 0.7 and days["new"].level == "high" and "hour" not in out["365d"].columns
    totals = out["365d"].select(F.explode("top").alias("t")).select("t.*")
    assert [r.category for r in forecast.top_types(totals, 2).collect()] == ["y", "x"]


def test_saved_stack_keeps_its_threshold(spark, tmp_path):
    rows = [(f"a{k % 5}", DAY + dt.timedelta(days=k // 5), float(k % 7), int(k % 7 > 3)) for k in range(200)]
    df = spark.createDataFrame(rows, "area_id string, date date, x double, label int")
    models = {k: v for k, v in ml.base_models().items() if k in ("lr", "svc")}
    stack = ml.fit_stack(df, ml.preprocessor([], ["x"], []), models, 3, ["area_id", "date"])
    stack.save(f"{tmp_path}/stack")
    kept = ml.Stack.load(f"{tmp_path}/stack")
    assert kept.threshold == stack.threshold and list(kept.models) == list(models)
    a, b = ({(r.area_id, r.date): r.predicted for r in s.decide(df).collect()} for s in (stack, kept))
    assert a == b and sum(a[f"a{k % 5}", DAY + dt.timedelta(days=k // 5)] == rows[k][3] for k in range(200)) == 200


def test_better_meta_learner_is_taken(spark):
    """Labels that no line through the scores can part: trees win; where a line does, the first of those that tie."""
    rows = [(k, (k % 20) / 20, float(k % 7), int(5 <= k % 20 < 15)) for k in range(800)]
    oof = spark.createDataFrame(rows, "row int, p_a double, p_b double, label int")
    ranked = ml.evaluate_meta(oof, ml.meta_models(), ["row"])
    assert [r["meta"] for r in ranked] == ["gbt", "lr"] and ranked[0]["average_precision"] > 0.99 > 0.8 > ranked[1]["average_precision"]
    easy = oof.withColumn("label", (F.col("p_a") > 0.5).cast("int"))
    assert [r["meta"] for r in ml.evaluate_meta(easy, ml.meta_models(), ["row"])] == ["lr", "gbt"]
    model = ml.fit_meta(oof, learner=ml.meta_models()["gbt"])
    assert ml._score(model.transform(oof), "score").where("(score > 0.5) = (label = 1)").count() == 800
