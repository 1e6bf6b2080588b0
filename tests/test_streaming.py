import pytest

from flowtally.operators.aggregate import aggregate, ordered
from flowtally.operators.trim import trim
from flowtally.sources.tables import READ_OPTIONS, read_csv, text_schema
from flowtally.streaming.counts import partial_counts, read_counts, running_counts, trimmed

COLUMNS = ["timestamp", "SrcIP", "DstIP", "DstPort", "message"]


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()

    def land(name, rows):
        (folder / name).write_text(",".join(COLUMNS) + "\n" + "".join(",".join(row) + "\n" for row in rows), "utf-8")

    for i in range(5):
        land(f"{i}.csv", [(f"t{j}", "10.0.0.1" if j % 3 else "10.0.0.2", f"8.8.8.{j % 4}", "" if j % 2 else "443", "m") for j in range(i * 7, i * 7 + 20)])
    return folder, land


def stream(spark, folder):
    return spark.readStream.options(**READ_OPTIONS).schema(text_schema(COLUMNS)).option("maxFilesPerTrigger", 2).csv(str(folder))


def batch(spark, folder):
    return read_csv(spark, str(folder), COLUMNS)


def test_counts_per_batch_add_up_also_after_a_restart(spark, landing, tmp_path):
    folder, land = landing
    out, state = str(tmp_path / "counts"), str(tmp_path / "state")
    partial_counts(stream(spark, folder), out, state).awaitTermination()
    assert len(list((tmp_path / "counts").glob("batch=*"))) == 3
    assert ordered(read_counts(spark, out)).collect() == ordered(aggregate(batch(spark, folder))).collect()
    land("late.csv", [("t", "10.0.0.9", "8.8.8.8", "1", "m")] * 4)
    partial_counts(stream(spark, folder), out, state).awaitTermination()
    assert ordered(read_counts(spark, out)).collect() == ordered(aggregate(batch(spark, folder))).collect()
    assert ordered(read_counts(spark, out, 4)).collect() == ordered(aggregate(batch(spark, folder), 4)).collect()


def test_running_counts(spark, landing, tmp_path):
    folder, _ = landing
    query = (
        running_counts(stream(spark, folder))
        .writeStream.outputMode("complete").format("memory").queryName("running")
        .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert ordered(spark.table("running")).collect() == ordered(aggregate(batch(spark, folder))).collect()


def test_trimmed_stream(spark, landing, tmp_path):
    folder, _ = landing
    trimmed(stream(spark, folder).fillna(""), str(tmp_path / "rows"), str(tmp_path / "state")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "rows"))
    assert got.columns == ["SrcIP", "DstIP", "DstPort"]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, trim(batch(spark, folder)).collect()))


def test_streams_of_the_queries_come_in_several_batches(spark, tmp_path):
    from workload.queries import LANDED_FILES, event_stream

    stream = event_stream(spark, str(tmp_path), "/root/testdata/sf0.001", "connections")
    partial_counts(stream, str(tmp_path / "counts"), str(tmp_path / "state")).awaitTermination()
    assert len(list((tmp_path / "counts").glob("batch=*"))) == LANDED_FILES // 2
