"""Sources that fetch window after window, read as Spark data sources."""

import sys
from datetime import datetime, timedelta

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from flowtally.functions.clock import instant
from flowtally.operators.collect import CollectRules
from flowtally.plans.pipeline import plan
from flowtally.plans.settings import Settings
from flowtally.sources.registry import SOURCES
from flowtally.sources.windows import data_source, landed_days, read_windows, register_windows, windows

cloudpickle.register_pickle_by_value(sys.modules[__name__])
NOW = datetime(2024, 1, 31)


def each_hour(gte, lt, conditions):
    """A document at the beginning of what is fetched and one each further half hour; it tells
    the bounds and conditions it was fetched with."""
    at = gte
    while at < lt:
        note = f"{gte:%d %H:%M}/{lt:%d %H:%M}/" + ",".join(sorted(type(c).__name__ for c in conditions))
        yield {"timestamp": at, "SrcIP": "10.0.0.1", "DstIP": "8.8.8.8", "message": note}
        at += timedelta(minutes=30)


def read(spark, start, end=0, unit="h"):
    return read_windows(spark, data_source("each_hour", each_hour), CollectRules(now=NOW, start=start, end=end, unit=unit))


def test_windows_are_partitions(spark):
    assert [(w.gte.hour, w.lt.hour) for w in windows(NOW, 4, 2, "h")] == [(21, 22), (20, 21)]
    frame = read(spark, 4, 2)
    assert frame.count() == 4 and frame.rdd.getNumPartitions() == 2
    assert {row.message for row in frame.collect()} == {"30 21:00/30 22:00/", "30 20:00/30 21:00/"}
    assert frame.where("DstPort IS NULL").count() == 4
    assert read(spark, 2, unit="d").count() == 96


def test_time_bounds_prune_and_cut_windows(spark, capsys):
    frame = read(spark, 24)
    at = instant(NOW - timedelta(hours=3, minutes=30), "timestamp_ntz")
    cut = frame.where((F.col("timestamp") >= at) & (F.col("timestamp") < instant(NOW - timedelta(hours=1), "timestamp_ntz")))
    assert sorted(row.message[:11] for row in cut.collect()) == ["30 20:30/30", "30 21:00/30", "30 21:00/30", "30 22:00/30", "30 22:00/30"]
    assert cut.rdd.getNumPartitions() == 3
    cut.explain("formatted")
    text = capsys.readouterr().out
    assert "PushedFilters: [GreaterThanOrEqual(timestamp,2024-01-30T20:30), LessThan(timestamp,2024-01-30T23:00)]" in text
    for test, times in ((F.col("timestamp") > at, 7), (F.col("timestamp") <= at, 42), (F.col("timestamp") == at, 1), (F.col("timestamp") == instant(NOW, "timestamp_ntz"), 0)):
        assert frame.where(test).count() == times


def test_other_conditions_reach_the_fetch_and_still_hold(spark):
    rows = read(spark, 1).where("SrcIP = '10.0.0.1' AND streams IS NULL").collect()
    assert len(rows) == 2 and "EqualTo" in rows[0].message
    assert read(spark, 1).where("SrcIP = '10.0.0.2'").count() == 0


def test_bad_options(spark):
    source = data_source("bad", each_hour)
    spark.dataSource.register(source)
    for options, said in (({}, "now, start, unit"), ({"now": "2024-01-31", "start": 1, "unit": "w"}, "'w'"), ({"now": "2024-01-31", "start": 1, "end": 1, "unit": "h"}, "greater")):
        with pytest.raises(Exception, match=said):
            spark.read.format("bad").options(**options).load().collect()


def test_as_the_source_of_a_pipeline(spark):
    register_windows("hourly")(each_hour)
    try:
        settings = Settings(source="hourly", now=NOW)
        rows = plan(spark, [{"collect": {"start": 2}}, "trim", "aggregate"], settings=settings).frame.collect()
        assert [(row.DstIP, row["count"]) for row in rows] == [("8.8.8.8", 4)]
    finally:
        del SOURCES["hourly"]


def test_landed_days(spark, tmp_path):
    rows = [(NOW - timedelta(hours=h), f"10.0.0.{h % 3}", None if h % 5 else "s1") for h in range(1, 73)]
    frame = spark.createDataFrame(rows, "timestamp timestamp_ntz, SrcIP string, streams string")
    frame.withColumn("day", F.to_date("timestamp")).write.partitionBy("day").parquet(f"{tmp_path}/logs")
    source = data_source("days", landed_days(f"{tmp_path}/logs", frame.columns), "timestamp timestamp_ntz, SrcIP string, streams string")
    read_all = read_windows(spark, source, CollectRules(now=NOW, start=4, unit="d"))
    assert sorted(map(tuple, read_all.collect()), key=str) == sorted(rows, key=str)
    some = read_all.where("streams = 's1' AND SrcIP IN ('10.0.0.1', '10.0.0.2') AND SrcIP <> '10.0.0.2' AND startswith(SrcIP, '10')")
    assert sorted(row.timestamp for row in some.collect()) == sorted(t for t, s, x in rows if x == "s1" and s == "10.0.0.1")
