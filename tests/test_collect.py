from datetime import date, datetime

import pytest

from flowtally.operators import diagnose
from flowtally.operators.collect import CollectRules, collect, collect_sorted
from flowtally.schema import COLLECT_COLUMNS
from flowtally.sources.logstore import LogStore
from flowtally.sources.registry import get_source, register_source

NOW = datetime(2026, 7, 28, 12)
DOCUMENTS = """{"timestamp":"2026-07-28T11:30:00.000Z","SrcIP":"10.2.83.133","DstIP":"8.8.8.8","DstPort":443,"streams":["a","sid"]}
{"timestamp":"2026-07-28T11:20:00.000Z","SrcIP":"10.3.139.3","DstIP":"8.8.8.8","DstPort":443,"streams":"sid"}
{"timestamp":"2026-07-28T10:59:59.999Z","SrcIP":"10.3.139.3","DstIP":"1.1.1.1","streams":["sid"]}
{"timestamp":"2026-07-28T12:00:00.000Z","SrcIP":"10.3.139.3","DstIP":"1.1.1.1","streams":["sid"]}
{"timestamp":"2026-07-28T11:10:00.000Z","SrcIP":"10.3.139.3","DstIP":"192.168.1.1","streams":["sid"]}
{"timestamp":"2026-07-28T11:10:00.000Z","SrcIP":"10.3.139.3","DstIP":"2001:db8::1","streams":["sid"]}
{"timestamp":"2026-07-28T11:10:00.000Z","SrcIP":"10.3.139.3","DstIP":"","streams":["sid"]}
{"timestamp":"2026-07-28T11:10:00.000Z","SrcIP":"10.3.139.3","streams":["sid"]}
{"timestamp":"2026-07-28T11:10:00.000Z","SrcIP":"9.9.9.9","DstIP":"8.8.8.8","streams":["other"]}
{"timestamp":"2026-07-28T11:00:00.000Z","SrcIP":"9.9.9.9","DstIP":"8.8.4.4","streams":["sid"]}
"""


@pytest.fixture
def store(tmp_path):
    (tmp_path / "logs.json").write_text(DOCUMENTS, "utf-8")
    return LogStore(str(tmp_path / "logs.json"), "json")


def sources(frame):
    return sorted(row.SrcIP for row in frame.collect())


def test_selected_rows_and_columns(spark, store):
    got = collect_sorted(store.read(spark), CollectRules(NOW, start=2, stream_id="sid"))
    assert got.columns == COLLECT_COLUMNS
    assert [(row.SrcIP, row.DstIP, row.DstPort, row.url_path) for row in got.collect()] == [
        ("9.9.9.9", "8.8.4.4", "", ""),
        ("10.3.139.3", "8.8.8.8", "443", ""),
        ("10.2.83.133", "8.8.8.8", "443", ""),
        ("10.3.139.3", "1.1.1.1", "", ""),
    ]
    assert sources(store.collect(spark, CollectRules(NOW, stream_id="sid"))) == ["10.2.83.133", "10.3.139.3", "9.9.9.9"]


@pytest.mark.parametrize(
    "listed, cidrs, mode, expected",
    [
        (["10.2.83.133"], [], "or", ["10.2.83.133"]),
        ([], ["10.3.139.0/24"], "or", ["10.3.139.3"]),
        (["10.2.83.133"], ["10.3.139.0/24"], "or", ["10.2.83.133", "10.3.139.3"]),
        (["10.2.83.133"], ["10.3.139.0/24"], "and", []),
        (["10.2.83.133", "10.3.139.3"], ["10.3.139.0/25"], "and", ["10.3.139.3"]),
        ([], ["8.0.0.0/7"], "or", ["9.9.9.9"]),
        ([], ["2001:db8::/32"], "or", []),
    ],
)
def test_source_filters(spark, store, listed, cidrs, mode, expected):
    rules = CollectRules(NOW, stream_id="sid", allowlist=listed, cidrs=cidrs, match_mode=mode)
    assert sources(store.collect(spark, rules)) == expected


def test_bad_rules(spark, store):
    with pytest.raises(ValueError, match="greater"):
        store.collect(spark, CollectRules(NOW, start=0))
    with pytest.raises(ValueError, match="match mode"):
        store.collect(spark, CollectRules(NOW, match_mode="xor"))


def test_days_outside_the_range_are_pruned(spark, tmp_path):
    days = spark.sql("SELECT date'2026-07-20' + CAST(id AS INT) AS day, '10.0.0.1' AS SrcIP, '8.8.8.8' AS DstIP, "
                     "timestamp'2026-07-20 13:00:00' + make_interval(0,0,0,CAST(id AS INT)) AS timestamp FROM range(10)")  # fmt: skip
    days.write.partitionBy("day").parquet(str(tmp_path / "logs"))
    got = LogStore(str(tmp_path / "logs"), date_column="day").collect(spark, CollectRules(NOW, start=2, unit="d"))
    assert got.count() == 2
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and str(date(2026, 7, 26)) in plan


def test_registry(spark, store):
    register_source("landed")(store)
    assert get_source("landed")(spark, CollectRules(NOW, stream_id="sid")).count() == 3
    with pytest.raises(ValueError, match="Unknown source 'nope'.*landed"):
        get_source("nope")


def test_diagnosis(spark, store):
    rules = CollectRules(NOW, start=1, stream_id="sid", cidrs=["10.9.0.0/16"])
    ladder = {row.clauses: row.rows for row in diagnose.filter_ladder(store.read(spark), rules).collect()}
    assert ladder == {
        "all": 10, "full": 0, "without source filter": 6, "without stream filter": 7, "time range only": 8, "stream only": 9,
    }
    fields = {row.field: (row.present, row.rows) for row in diagnose.field_presence(store.read(spark), ["DstIP", "dst"]).collect()}
    assert fields == {"DstIP": (True, 9), "dst": (False, 0)}
    assert diagnose.newest(store.read(spark)).first().newest == "2026-07-28T12:00:00.000Z"
    assert diagnose.sample_document(store.read(spark)).count() == 1
