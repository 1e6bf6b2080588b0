import csv
import io

import pandas as pd
import pytest
from pyspark.sql import functions as F

from flowtally.functions.networks import parse_networks
from flowtally.operators.merge import merge_frames
from flowtally.operators.split import with_label, with_slice
from flowtally.operators.trim import trim
from flowtally.sources.tables import Head, heads, merge_files, read_csv, write_csv, write_split
from datetime import datetime

COLLECTED = "timestamp,SrcIP,DstIP,DstPort,ac_action,ac_rule_name,url_domain,url_path\n"


def rows(frame):
    return sorted(tuple(row) for row in frame.collect())


def text_of(folder):
    """All parts under a folder as one CSV text with one header."""
    parts = [path.read_text("utf-8") for path in sorted(folder.rglob("part-*.csv"))]
    heads = {part.split("\n", 1)[0] for part in parts}
    assert len(heads) == 1
    return heads.pop() + "\n" + "".join(part.split("\n", 1)[1] for part in parts)


def test_everything_is_text_and_na_is_data(spark, tmp_path):
    (tmp_path / "a.csv").write_text(COLLECTED + 't1,10.0.0.1,8.8.8.8,0443,allow,NA,"",/ x \n\nt2,10.0.0.1,8.8.8.8,,deny,NULL\n', "utf-8")
    frame = read_csv(spark, str(tmp_path / "a.csv"))
    assert set(dict(frame.dtypes).values()) == {"string"}
    assert rows(frame) == [
        ("t1", "10.0.0.1", "8.8.8.8", "0443", "allow", "NA", "", "/ x "),
        ("t2", "10.0.0.1", "8.8.8.8", "", "deny", "NULL", "", ""),
    ]


def test_rows_of_wrong_length_can_be_refused(spark, tmp_path):
    (tmp_path / "long.csv").write_text("a,b\n1,2\n1,2,3\n", "utf-8")
    (tmp_path / "short.csv").write_text("a,b\n1\n", "utf-8")
    for multiline in (True, False):
        with pytest.raises(Exception, match="more than 2 fields"):
            read_csv(spark, str(tmp_path / "long.csv"), multiline=multiline).collect()
        with pytest.raises(Exception, match="more than 2 fields"):
            read_csv(spark, str(tmp_path / "long.csv"), multiline=multiline).select("b").collect()
    assert rows(read_csv(spark, str(tmp_path / "short.csv"))) == [("1", "")]
    with pytest.raises(Exception):
        read_csv(spark, str(tmp_path / "short.csv"), mode="FAILFAST").collect()


def test_written_text_equals_minimal_quoting(spark, tmp_path):
    values = ["plain", "a,b", 'say "x"', " lead", "trail ", "", "NA", "two\nlines", "#hash", "back\\slash", "tab\t", "é", "a;b", "'q'"]
    data = [(str(i).zfill(2), value, "z") for i, value in enumerate(values)]
    write_csv(spark.createDataFrame(data, "k string, v string, z string").coalesce(1), str(tmp_path / "out"))
    expected = io.StringIO()
    pd.DataFrame(data, columns=["k", "v", "z"]).to_csv(expected, index=False)
    assert text_of(tmp_path / "out") == expected.getvalue()
    assert rows(read_csv(spark, str(tmp_path / "out"))) == sorted(data)


def test_header_of_an_empty_result(spark, tmp_path):
    write_csv(spark.createDataFrame([], "a string, b string").coalesce(1), str(tmp_path / "out"))
    assert text_of(tmp_path / "out") == "a,b\n"


def test_merge_by_position_and_by_name(spark, tmp_path):
    texts = {"empty": "", "head": "X,Y\n", "one": "SrcIP,DstIP\n10.0.0.1,8.8.8.8\n10.0.0.1,8.8.8.8\n", "two": "DstIP,extra,SrcIP\n1.1.1.1,e,10.0.0.2\n"}
    paths = {}
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_text(text, "utf-8")
        paths[name] = str(tmp_path / f"{name}.csv")
    named = merge_files(spark, list(paths.values()))
    assert named.columns == ["SrcIP", "DstIP"]
    assert rows(named) == [("10.0.0.1", "8.8.8.8"), ("10.0.0.1", "8.8.8.8"), ("10.0.0.2", "1.1.1.1")]
    placed = merge_files(spark, [paths["empty"], paths["head"], paths["one"]], how="position")
    assert placed.columns == ["X", "Y"] and placed.count() == 2
    with pytest.raises(ValueError, match="non-empty"):
        merge_files(spark, [paths["empty"]])
    with pytest.raises(ValueError, match="non-empty"):
        merge_files(spark, [paths["head"]])


def test_first_file_with_rows_leads_even_behind_an_equal_header(spark, tmp_path):
    for name, text in {"a": "p,q\n", "b": "q,r\n1,2\n", "c": "p,q\n3,4\n"}.items():
        (tmp_path / name).write_text(text, "utf-8")
    merged = merge_files(spark, [str(tmp_path / name) for name in "abc"])
    assert merged.columns == ["q", "r"] and rows(merged) == [("1", "2"), ("4", "")]


def test_merge_frames(frame):
    a, b = frame("p, q", [("1", "2")]), frame("q, r", [("3", "4")])
    assert rows(merge_frames([None, frame("z", []), a, b])) == [("", "3"), ("1", "2")]
    assert rows(merge_frames([a, b], how="position")) == [("1", "2"), ("3", "4")]
    with pytest.raises(ValueError):
        merge_frames([None])


def test_trim_keeps_order_of_the_rest(frame):
    given = frame("timestamp, SrcIP, extra, SrcPort, source, message, DstIP", [("t", "a", "x", "1", "s", "m", "b")])
    assert trim(given).columns == ["SrcIP", "extra", "DstIP"]
    assert trim(trim(given)).columns == ["SrcIP", "extra", "DstIP"]


def test_split_sink(spark, frame, tmp_path):
    data = [("10.2.83.10", "8.8.8.8", "2"), ("10.2.83.200", "1.1.1.1", "1"), ("9.9.9.9", "2.2.2.2", "1"), ("10.2.83.11", "8.8.8.8", "10")]
    counted = frame("SrcIP, DstIP, count", data).withColumn("count", F.col("count").cast("bigint"))
    labelled = with_label(counted, parse_networks(["10.2.83.0/25", "10.2.83.128/25"]))
    write_split(with_slice(labelled, datetime(2026, 7, 28, 12, 10), 5, 0, "d"), str(tmp_path / "out"))
    folders = {path.name: path for path in (tmp_path / "out").iterdir() if path.is_dir()}
    tail = "__2026-07-23__2026-07-28__time-12-10.csv"
    assert set(folders) == {f"slice=aggregation_{label}{tail}" for label in ("10.2.83.0-25", "10.2.83.128-25", "other")}
    first = list(csv.reader(io.StringIO(text_of(folders[f"slice=aggregation_10.2.83.0-25{tail}"]))))
    assert first == [["SrcIP", "DstIP", "count"], ["10.2.83.11", "8.8.8.8", "10"], ["10.2.83.10", "8.8.8.8", "2"]]
    assert "9.9.9.9" in text_of(folders[f"slice=aggregation_other{tail}"])


def test_a_large_subnet_is_written_by_several_tasks(spark, tmp_path):
    frame = spark.range(0, 4000, 1, 8).selectExpr("'10.0.0.1' AS SrcIP", "'8.8.8.8' AS DstIP", "'s' AS slice", "'x' AS subnet")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_split(frame, str(tmp_path / "out"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = list((tmp_path / "out").rglob("part-*.csv"))
    assert len(parts) > 1
    assert sum(len(path.read_text().splitlines()) - 1 for path in parts) == 4000


def test_split_needs_the_source_column(frame):
    with pytest.raises(ValueError, match="SrcIP"):
        with_label(frame("a", []), [])


# -- looking at many inputs --------------------------------------------------------


def test_heads_of_inputs(spark, tmp_path):
    import gzip

    texts = {
        "plain": "a,b\n1,2\n", "empty": "", "header": "a,b\n", "blank": "\n\n a,b\r\n\r\n\n", "quoted": '"a\nx","b""c"\n', "unnamed": "a,,a\n1,2,3",
        "no_end": "a,b", "long": "a," + "b" * 200_000 + "\n" + "\n" * 70_000 + "1,2\n", "open": '"a,b\n1,2\n', "letters": "ä,б\né,中\n",
    }
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    with gzip.open(tmp_path / "packed.gz", "wt") as packed:
        packed.write("a,b\n1,2\n")
    folder = tmp_path / "folder"
    folder.mkdir()
    for name, text in (("part-0", ""), ("part-1", "x,y\n"), ("part-2", "z\n9\n"), ("_SUCCESS", "q\n"), (".part.crc", "q\n")):
        (folder / name).write_text(text)
    names = [*texts, "packed.gz", "folder", "folder/part-[12]"]
    found = dict(zip(names, heads(spark, [f"{tmp_path}/{name}" for name in names])))
    assert found["plain"] == Head(("a", "b"), True) == found["packed.gz"]
    assert found["empty"] == Head((), False)
    assert found["header"] == Head(("a", "b"), False) == found["no_end"]
    assert found["blank"].has_rows is False and len(found["blank"].names) == 2
    assert found["quoted"] == Head(("a\nx", 'b"c'), False)
    assert found["unnamed"].has_rows and list(found["unnamed"].names) == spark.read.option("header", True).csv(f"{tmp_path}/unnamed").columns
    assert found["long"].has_rows and len(found["long"].names[1]) == 200_000
    assert found["letters"] == Head(("ä", "б"), True)
    assert found["folder"] == Head(("x", "y"), True) == found["folder/part-[12]"]
    with pytest.raises(FileNotFoundError):
        heads(spark, [f"{tmp_path}/nowhere"])


def test_many_files_take_no_job_to_merge(spark, tmp_path):
    for i in range(500):
        columns = ["a", "b"] if i % 2 else ["b", "c"]
        (tmp_path / f"{i:03d}").write_text(",".join(columns) + "\n" + ("" if i < 3 else f"{i},x\n"))
    paths = [f"{tmp_path}/{i:03d}" for i in range(500)]
    group = "merge-many"
    spark.sparkContext.setJobGroup(group, group)
    try:
        merged = {how: merge_files(spark, paths, how, multiline=False) for how in ("name", "position")}
        # Spark lists many paths with a job of its own: one for each scan, whatever the number of files.
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) <= 3
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert merged["name"].columns == ["a", "b"] and merged["position"].columns == ["b", "c"]
    rows = sorted(map(tuple, merged["name"].collect()))
    assert rows == sorted((str(i), "x") if i % 2 else ("", str(i)) for i in range(3, 500))
    assert merged["position"].count() == 497
