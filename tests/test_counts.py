"""Stored counts by period, and labels on a stream."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from flowtally.operators.aggregate import aggregate
from flowtally.operators.split import with_label_from, with_label_on_stream
from flowtally.sources.countstore import CountStore
from flowtally.streaming.counts import landed

DAY = datetime(2024, 1, 30)


def logs(spark, *hours):
    rows = [(DAY + timedelta(hours=h, minutes=i), f"10.0.0.{i % 2}", None if i == 2 else "8.8.8.8") for h, n in hours for i in range(n)]
    return spark.createDataFrame(rows, "timestamp timestamp_ntz, SrcIP string, DstIP string")


def counted(frame):
    return sorted((row.SrcIP, row.DstIP, row["count"]) for row in frame.collect())


def test_periods_replace_themselves(spark, tmp_path):
    store = CountStore(spark, f"{tmp_path}/counts")
    every = logs(spark, (0, 4), (1, 3), (5, 1), (23, 2))
    store.land(every, DAY, DAY + timedelta(days=1))
    assert store.periods() == [f"2024-01-30-{h}" for h in ("00", "01", "05", "23")]
    assert counted(store.read()) == counted(aggregate(every))
    # The same again, an hour with other rows, and an hour that has none any more.
    store.land(every, DAY, DAY + timedelta(days=1))
    assert counted(store.read()) == counted(aggregate(every))
    store.land(logs(spark, (1, 9), (7, 5)), DAY + timedelta(hours=1), DAY + timedelta(hours=6))
    assert store.periods() == [f"2024-01-30-{h}" for h in ("00", "01", "23")]
    assert counted(store.read()) == counted(aggregate(logs(spark, (0, 4), (1, 9), (23, 2))))
    assert counted(store.read(min_count=5)) == [row for row in counted(store.read()) if row[2] >= 5]


def test_only_the_periods_asked_for_are_read(spark, tmp_path, capsys):
    store = CountStore(spark, f"{tmp_path}/counts")
    store.land(logs(spark, (0, 4), (1, 3), (2, 2)), DAY, DAY + timedelta(hours=3))
    part = store.read(DAY + timedelta(hours=1), DAY + timedelta(hours=2))
    assert counted(part) == counted(aggregate(logs(spark, (1, 3))))
    part.explain("formatted")
    assert "PartitionFilters: [isnotnull(period" in capsys.readouterr().out


def test_days_and_odd_input(spark, tmp_path):
    store = CountStore(spark, f"{tmp_path}/days", "d")
    with pytest.raises(ValueError, match="beginning"):
        store.land(logs(spark, (0, 1)), DAY + timedelta(hours=1), DAY + timedelta(days=1))
    with pytest.raises(ValueError, match="Unsupported unit"):
        CountStore(spark, f"{tmp_path}/weeks", "w")
    with pytest.raises(ValueError, match="Nothing"):
        store.read()
    no_time = logs(spark, (0, 2)).withColumn("timestamp", F.lit(None).cast("timestamp_ntz"))
    store.land(logs(spark, (0, 4), (23, 3)).union(no_time), DAY, DAY + timedelta(days=2))
    assert store.periods() == ["2024-01-30"] and counted(store.read()) == counted(aggregate(logs(spark, (0, 4), (23, 3))))
    store.land(logs(spark, (0, 4)).limit(0), DAY, DAY + timedelta(days=1))
    assert store.periods() == []


def test_a_hot_period_is_split_over_tasks(spark, tmp_path):
    many = spark.range(300_000).selectExpr("TIMESTAMP_NTZ'2024-01-30 00:10:00' AS timestamp", "CAST(uuid() AS string) AS SrcIP")
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m", "spark.sql.files.maxPartitionBytes": "2m", "spark.sql.files.openCostInBytes": "1m"}
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        CountStore(spark, f"{tmp_path}/hot").land(many, DAY, DAY + timedelta(hours=1))
    finally:
        for name in small:
            spark.conf.unset(name)
    assert len(list((tmp_path / "hot" / "period=2024-01-30-00").glob("*.parquet"))) > 1


NETWORKS = [(0, "10.2.82.0/25", "low half"), (1, "10.2.0.0/16", "wide"), (2, "10.2.82.0/24", "never"), (3, "0.0.0.0/1", "most"), (4, "bad", "bad")]


def test_labels_on_a_stream_equal_those_of_a_table(spark, frame, tmp_path):
    sources = ["10.2.82.5", " 10.2.82.5 ", "10.2.82.200", "10.3.0.1", "200.1.1.1", "", None, "::1", "10.2.82.5", *["10.2.82.9"] * 50]
    rows = frame("n, SrcIP", [(str(i), source) for i, source in enumerate(sources)])
    rows.repartition(3).write.parquet(f"{tmp_path}/in")
    networks = spark.createDataFrame(NETWORKS, "position int, network string, label string")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    landed(with_label_on_stream(stream, networks), f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    got = {row.n: (row.SrcIP, row.subnet) for row in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert len(got) == len(sources)
    assert got == {row.n: (row.SrcIP, row.subnet) for row in with_label_from(rows, networks).collect()}
    assert got["0"][1] == "low half" and got["3"][1] == "most" and got["4"][1] == "other"


def test_streams_that_cannot_be_labelled(spark, frame):
    networks = spark.createDataFrame(NETWORKS, "position int, network string, label string")
    for columns, said in (("DstIP", "SrcIP"), ("SrcIP, key", "key")):
        with pytest.raises(ValueError, match=said):
            with_label_on_stream(frame(columns, []), networks)
