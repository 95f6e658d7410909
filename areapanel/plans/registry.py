"""Where queries register, and the roles that the driver's tables play."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(sql: str | None = None, text: tuple[str, ...] = ()):
    """Register a query under its function's name; ``sql`` gives the same rows in DuckDB.

    Columns in ``text`` (dates, times) are compared as text, on both sides.
    """

    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(spark, sf_dir).withColumns({c: F.col(c).cast("string") for c in text})

        QUERIES[f.__name__] = run if text else f
        if sql is not None:
            casts = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in text)
            ORACLE_SQL[f.__name__] = f"SELECT * REPLACE ({casts}) FROM ({sql})" if text else sql
        return f

    return add


def dated(sql: str | None = None):
    """:func:`query` for results with a ``date``."""
    return query(sql, ("date",))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c, kind in df.dtypes if kind == "double"})


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with area, place, category, label and score."""
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id", F.lpad(F.col("user_id").cast("string"), 11, "0").alias("area_id"), "ts", F.to_date("ts").alias("date"), F.hour("ts").alias("hour"),
        F.col("event_type").alias("category"), "value", "props",
        (37.70 + ((F.col("event_id") * 7919) % 1000) / 10000.0).alias("lat"), (-122.51 + ((F.col("event_id") * 104729) % 1200) / 10000.0).alias("lon"),
        (F.col("value") > 50).cast("int").alias("label"), (F.col("value") / (F.col("value") + 50)).alias("score"),
    )


EV = """ev AS (SELECT event_id, lpad(CAST(user_id AS VARCHAR), 11, '0') AS area_id, ts, CAST(ts AS DATE) AS date, CAST(extract('hour' FROM ts) AS INTEGER) AS hour,
 event_type AS category, value, props, 37.70::DOUBLE + ((event_id * 7919) % 1000) / 10000.0::DOUBLE AS lat, -122.51::DOUBLE + ((event_id * 104729) % 1200) / 10000.0::DOUBLE AS lon,
 CAST(value > 50 AS INTEGER) AS label, value / (value + 50) AS score FROM events)"""

#: Zero-filled daily panel over the observed days.
DP = EV + """, dp AS (SELECT a.area_id, d.date, coalesce(c.n, 0) AS event_count, CAST(coalesce(c.n, 0) >= 1 AS INTEGER) AS label
 FROM (SELECT DISTINCT area_id FROM ev) a CROSS JOIN (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM ev) d
 LEFT JOIN (SELECT area_id, date, count(*) AS n FROM ev GROUP BY ALL) c ON a.area_id = c.area_id AND d.date = c.date)"""


def pois(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_suppkey").alias("poi_id"), F.col("s_nationkey").cast("string").alias("poi_type"), F.col("s_acctbal").alias("weight"),
        (37.70 + ((F.col("s_suppkey") * 7919) % 1000) / 10000.0).alias("lat"), (-122.51 + ((F.col("s_suppkey") * 104729) % 1200) / 10000.0).alias("lon"),
    )


PO = """po AS (SELECT s_suppkey AS poi_id, CAST(s_nationkey AS VARCHAR) AS poi_type, s_acctbal AS weight,
 37.70::DOUBLE + ((s_suppkey * 7919) % 1000) / 10000.0::DOUBLE AS lat, -122.51::DOUBLE + ((s_suppkey * 104729) % 1200) / 10000.0::DOUBLE AS lon FROM supplier)"""


def user_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas of users u and u + 1 are neighbours, both ways."""
    ids = table(spark, sf_dir, "events").select("user_id").distinct()
    key = lambda c: F.lpad(c.cast("string"), 11, "0")
    up = ids.join(ids.select((F.col("user_id") - 1).alias("user_id")), "user_id", "left_semi").select(key(F.col("user_id")).alias("a"), key(F.col("user_id") + 1).alias("b"))
    return up.select(F.col("a").alias("area_id"), F.col("b").alias("neighbor")).unionByName(up.select(F.col("b").alias("area_id"), F.col("a").alias("neighbor")))


ED = """ids AS (SELECT DISTINCT user_id FROM events), up AS (SELECT lpad(CAST(x.user_id AS VARCHAR), 11, '0') AS a, lpad(CAST(y.user_id AS VARCHAR), 11, '0') AS b FROM ids x JOIN ids y ON y.user_id = x.user_id + 1),
 ed AS (SELECT a AS area_id, b AS neighbor FROM up UNION ALL SELECT b, a FROM up)"""


def cell_edges(spark: SparkSession, sf_dir: str, rows: int = 10, columns: int = 12) -> DataFrame:
    """Square areas of 0.01 degrees over the box of the events, one for each cell in which there is an event."""
    e = events(spark, sf_dir)
    cells = e.select(F.floor((F.col("lat") - 37.70) * 100 + 1e-9).cast("int").alias("r"), F.floor((F.col("lon") + 122.51) * 100 + 1e-9).cast("int").alias("c")).distinct()
    s, w = F.lit(37.70) + F.col("r") / 100.0, F.lit(-122.51) + F.col("c") / 100.0
    n, e_ = F.lit(37.70) + (F.col("r") + 1) / 100.0, F.lit(-122.51) + (F.col("c") + 1) / 100.0
    sides = F.array(*[F.struct(F.lit(i).alias("seq"), a.alias("x1"), b.alias("y1"), c.alias("x2"), d.alias("y2")) for i, (a, b, c, d) in enumerate([(w, s, e_, s), (e_, s, e_, n), (e_, n, w, n), (w, n, w, s)])])
    return cells.select(F.concat_ws("_", F.lit("cell"), "r", "c").alias("area_id"), F.explode(sides).alias("x")).select("area_id", "x.*")


CE = """cells AS (SELECT DISTINCT CAST(floor((lat - 37.70::DOUBLE) * 100 + 1e-9) AS INTEGER) AS r, CAST(floor((lon + 122.51::DOUBLE) * 100 + 1e-9) AS INTEGER) AS c FROM ev),
 box AS (SELECT 'cell_' || r || '_' || c AS area_id, 37.70::DOUBLE + r / 100.0::DOUBLE AS s, -122.51::DOUBLE + c / 100.0::DOUBLE AS w, 37.70::DOUBLE + (r + 1) / 100.0::DOUBLE AS n, -122.51::DOUBLE + (c + 1) / 100.0::DOUBLE AS e FROM cells),
 ce AS (SELECT area_id, w AS x1, s AS y1, e AS x2, s AS y2 FROM box UNION ALL SELECT area_id, e, s, e, n FROM box UNION ALL SELECT area_id, e, n, w, n FROM box UNION ALL SELECT area_id, w, n, w, s FROM box)"""
