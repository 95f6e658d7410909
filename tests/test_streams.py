"""Late rows, restarts and the table of versions."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from areapanel.streaming import jobs

SCHEMA = "event_id int, area_id string, ts timestamp"


def at(hour: float) -> datetime:
    return datetime(2024, 1, 1) + timedelta(hours=hour)


@pytest.fixture
def stream(spark, tmp_path):
    """Land batches of (id, hour), restart the stream after each, and return what each restart has written."""

    def run(make, batches):
        written = []
        source = f"{tmp_path}/in"

        def live():
            return make(spark.readStream.schema(SCHEMA).parquet(source))

        def start():
            return jobs.append_to(live(), f"{tmp_path}/out", f"{tmp_path}/log")

        for batch in batches:
            if batch is not None:
                spark.createDataFrame([(i, "a", at(h)) for i, h in batch], SCHEMA).coalesce(1).write.mode("append").parquet(source)
            start().awaitTermination()
            written.append(sorted(map(tuple, spark.read.schema(live().schema).parquet(f"{tmp_path}/out").collect())))
        return written

    return run


def test_late_rows_by_window(stream):
    batches = [[(1, 0.5), (2, 1.0), (3, 4.2)], [(4, 2.9), (5, 8.0)], [(6, 3.5), (7, 6.5), (8, 8.5)], [(9, 20.0)], None]
    counts = lambda rows: [(r[1].hour, r[3]) for r in rows]
    first, second, third, fourth, again = (counts(x) for x in stream(jobs.tumbling_counts, batches))
    assert first == [(0, 2)]  # the watermark stands at 3.2: the window from 0 is closed
    assert second == [(0, 2), (3, 1)]  # row 4 came too late for it
    assert third == second  # row 6 as well, the watermark stood at 7; row 7's window is open until 9
    assert fourth == [(0, 2), (3, 1), (6, 3)]
    assert again == fourth  # a restart without rows writes nothing twice; the window of hour 20 is open


def test_late_rows_by_overlapping_window(stream):
    """A late row counts only in those of its windows that are still open."""
    batches = [[(1, 5.5), (2, 8.0)], [(3, 5.2)], [(4, 30.0)]]
    counts = {r[1].hour + 24 * (r[1].day - 1): r[3] for r in stream(lambda s: jobs.sliding_counts(s, "4 hours", "2 hours"), batches)[-1]}
    assert counts == {2: 1, 4: 2, 6: 1, 8: 1}


def test_repeats_within_and_beyond_the_watermark(stream):
    batches = [[(1, 1.0), (1, 1.0), (2, 1.5)], [(1, 1.0), (3, 2.0)], [(4, 50.0)], [(2, 1.5), (4, 50.0), (5, 50.5)], None]
    got = [[r[0] for r in x] for x in stream(lambda s: jobs.once_by_id(s, late="10 hours"), batches)]
    assert got == [[1, 2], [1, 2, 3], [1, 2, 3, 4], [1, 2, 3, 4, 5], [1, 2, 3, 4, 5]]


class Sink:
    """Calls what a writer gives to foreachBatch."""

    def __init__(self):
        self.writeStream = self

    def foreachBatch(self, merge):  # noqa: N802
        self.merge = merge
        return self

    def option(self, *_):
        return self


def writer(table, buckets):
    sink = Sink()
    jobs.upsert_stream(sink, table, ["k"], ["n"], "unused", buckets=buckets)
    return sink.merge


def test_versions_do_not_pile_up(spark, tmp_path):
    table, want = f"{tmp_path}/table", {}
    merge = writer(table, 3)
    for n in range(30):
        rows = [(k, 10 * n + k) for k in ({n % 7, (n * n) % 11} if n % 10 else range(20))]
        want |= dict(rows)
        merge(spark.createDataFrame(rows, "k int, n int"), n)
        assert len(list((tmp_path / "table").glob("version=*"))) <= 3 + 2
        assert len(list((tmp_path / "table" / "manifests").glob("*.json"))) <= 2
    assert {r.k: r.n for r in jobs.current(spark, table).collect()} == want
    assert {r.k: r.n for r in jobs.current(spark, table, 29).collect()} != want  # the version before is there still


def test_batches_that_come_again(spark, tmp_path, monkeypatch):
    table = f"{tmp_path}/table"
    merge = writer(table, 4)
    batch = lambda n: spark.createDataFrame([(k, n) for k in range(8)], "k int, n int")
    merge(batch(0), 0)
    merge(batch(1), 1)
    files = sorted(p.name for p in (tmp_path / "table").rglob("*.parquet"))
    merge(batch(1), 1)  # committed already
    assert sorted(p.name for p in (tmp_path / "table").rglob("*.parquet")) == files
    with monkeypatch.context() as m:
        m.setattr(jobs, "_commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            merge(batch(2), 2)
    assert {r.n for r in jobs.current(spark, table).collect()} == {1}  # written, but no version yet
    assert not spark.sparkContext._jsc.getPersistentRDDs()
    merge(batch(2), 2)
    assert {r.n for r in jobs.current(spark, table).collect()} == {2}
    merge(batch(3).where("false"), 3)
    assert jobs.current(spark, table).count() == 8 and jobs.current(spark, f"{tmp_path}/none") is None


def test_replay_restarts_after_each_batch(spark, tmp_path):
    starts = []
    e = spark.range(10).select(F.col("id").cast("int").alias("event_id"), F.lit("a").alias("area_id"), F.lit(at(1)).cast("timestamp").alias("ts"))

    def start():
        starts.append(1)
        return jobs.append_to(jobs.once_by_id(spark.readStream.schema(e.schema).parquet(f"{tmp_path}/in")), f"{tmp_path}/out", f"{tmp_path}/log")

    jobs.replay([e.where("event_id < 5"), e], f"{tmp_path}/in", start)
    assert len(starts) == 3 and sorted(r.event_id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == list(range(10))
