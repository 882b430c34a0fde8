"""Streams over several micro-batches give what one batch gives."""

import pytest
from pyspark.sql import functions as F

from weft.streaming import live

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def split(spark, tmp_path_factory):
    """The events in five files by time, of which a micro-batch reads one."""
    folder = str(tmp_path_factory.mktemp("events"))
    events = spark.read.parquet(f"{SF}/events.parquet")
    edges = [r[0] for r in events.select(F.expr("percentile_disc(0.2) within group (order by event_id)")).collect()][0]
    for i in range(5):
        events.filter(F.least(F.floor(F.col("event_id") / (edges + 1)), F.lit(4)) == i).coalesce(1).write.mode("append").parquet(folder)
    return lambda: live.event_columns(spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder)), live.event_columns(events)


def same(a, b):
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.select(*a.columns).collect()))


@pytest.mark.parametrize("name", ["timers", "heartbeats", "retries", "fold_activities", "signals", "decision_polls"])
def test_batches(spark, split, name):
    stream, _ = split
    f = getattr(live, name)
    same(f(stream()), f(live.event_stream(spark, SF)))


def test_sessions(spark, split):
    stream, batch = split
    got = live.sessions(stream(), batch, "6 hours")
    assert got.count() == got.select("u", "start_us").distinct().count()
    windows = batch.groupBy("u", F.session_window("ts", "6 hours").alias("w")).agg(F.count("*").alias("n"))
    same(got, windows.select("u", F.unix_micros("w.start").alias("start_us"), F.unix_micros("w.end").alias("end_us"), "n"))


def test_complete_mode_is_the_last_batch(split):
    stream, batch = split
    same(live.drained(stream().groupBy("et").agg(F.count("*").alias("n")), "complete"), batch.groupBy("et").agg(F.count("*").alias("n")))
