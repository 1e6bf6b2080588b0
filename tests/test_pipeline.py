from datetime import datetime

import pytest

from flowtally.operators.collect import CollectRules
from flowtally.operators.resolvers import from_results, register_resolver
from flowtally.plans.pipeline import load_steps, parse_steps, plan, run_pipeline
from flowtally.plans.settings import Settings
from flowtally.sources.cachestore import CacheStore
from flowtally.sources.registry import register_source
from flowtally.sources.tables import read_csv
from pyspark.sql import functions as F

RAW = """DstPort,SrcIP,DstIP,timestamp,ac_rule_name,ac_action,message,url_domain,SrcPort
993,10.7.0.4,151.101.1.6,2031-05-01 08:00:00,mail,allow,x,mail.example,4001
993,10.7.0.4,151.101.1.6,2031-05-01 08:00:09,mail,allow,y,mail.example,4002
22,10.7.0.9,185.15.59.2,2031-05-01 08:01:00,,deny,z,,4003
993,10.7.0.4,151.101.1.6,2031-05-01 09:30:00,mail,allow,,mail.example,4004
8443,10.7.0.9,185.15.59.2,2031-05-01 09:31:00,NA,allow,,api.example,4005
"""
MAIL = ("10.7.0.4", "151.101.1.6", "993", "allow", "mail.example", "mail", "3")
NOW = datetime(2031, 5, 2, 6, 45)


@pytest.fixture
def raw(tmp_path):
    (tmp_path / "raw.csv").write_text(RAW, "utf-8")
    return str(tmp_path / "raw.csv")


@pytest.fixture(autouse=True)
def plugins(spark):
    register_resolver("same")(
        lambda tables, **options: from_results(
            lambda keys: keys.select("key", F.lit("IS").alias("country"), F.lit("64500").alias("asn"), F.lit("GEYSER").alias("asn_descr"), F.lit("Desk").alias("contacts"))
        )
    )
    asked: list[CollectRules] = []

    def source(spark, rules):
        asked.append(rules)
        row = ("2031-05-01", "10.7.0.4", "151.101.1.6", "993", "allow", "mail", "mail.example", "/in")
        names = "timestamp,SrcIP,DstIP,DstPort,ac_action,ac_rule_name,url_domain,url_path".split(",")
        return spark.createDataFrame([row, row], ", ".join(f"{n} string" for n in names))

    register_source("fixed")(source)
    return asked


def written(spark, folder):
    return sorted(tuple(row) for row in read_csv(spark, str(folder)).collect())


@pytest.mark.parametrize(
    "steps, message",
    [
        ("trim", "list of at least one"),
        (None, "list of at least one"),
        ([], "list of at least one"),
        (["shuffle"], "no step 'shuffle'"),
        ([{"trim": None, "merge": None}], "Not a step"),
        ([["trim"]], "Not a step"),
        ([{"collect": "soon"}], "option: value"),
        ([{"resolve": {"resolvers": "rdap", "zz": 1}}], "no option resolvers, zz"),
        ([{"trim": {"columns": []}}], "it has none"),
        ([{"collect": {"time_unit": "fortnight"}}], "time_unit: 'fortnight' is none of"),
        ([{"collect": {"end": 2.5}}], "no whole number"),
        ([{"collect": {"start": None}}], "whole number is needed"),
        ([{"collect": {"start": 1, "end": 3}}], "collect"),
        ([{"collect": {"source": "nowhere"}}], "nowhere"),
        ([{"aggregate": {"min_count": True}}], "no whole number"),
        ([{"resolve": {"cache": 1}}], "neither true nor false"),
        ([{"resolve": {"key_column": None}}], "text is needed"),
        ([{"merge": {"inputs": None}}], "list of paths"),
        ([{"merge": {"inputs": "one.csv"}}], "list of paths"),
        ([{"merge": {"how": "rows"}}], "none of name, position"),
        ([{"merge": {}}], "nothing to merge"),
        (["aggregate"], "no input"),
    ],
)
def test_what_cannot_run_is_refused(spark, steps, message):
    with pytest.raises(ValueError, match=message):
        plan(spark, steps)


def test_options_and_overrides():
    first, second = parse_steps(["trim", {"aggregate": {"min_count": 5}}], {"min_count": "7", "start": 9, "resolver": "x"})
    assert first.options == {}
    assert second.name == "aggregate" and (second.options["min_count"], second.options["start"]) == (7, 9)
    plain = parse_steps([{"aggregate": None}])[0].options
    assert plain == {"min_count": None, "out_dir": None, "start": 1, "end": 0, "time_unit": "h"}


def test_steps_from_yaml(tmp_path):
    (tmp_path / "p.yaml").write_text("- merge: {inputs: [a.csv], how: position}\n- aggregate\n")
    assert load_steps(str(tmp_path / "p.yaml")) == [{"merge": {"inputs": ["a.csv"], "how": "position"}}, "aggregate"]


def test_trim_and_aggregate(spark, raw, tmp_path):
    assert run_pipeline(spark, ["trim", {"aggregate": {"min_count": 2}}], str(tmp_path / "out"), raw) == 1
    assert written(spark, tmp_path / "out") == [MAIL]
    assert run_pipeline(spark, ["aggregate"], str(tmp_path / "o2"), raw, overrides={"min_count": 3}) == 1
    assert run_pipeline(spark, ["aggregate"], str(tmp_path / "o3"), raw, settings=Settings(min_count=2)) == 1


def test_collect_ignores_the_input_and_gets_the_rules(spark, raw, tmp_path, plugins):
    settings = Settings(source="fixed", now=NOW, stream_id="edge", cidrs=["10.7.0.0/24"])
    steps = [{"collect": {"start": 3, "end": 1, "time_unit": "d"}}, "trim", "aggregate"]
    assert run_pipeline(spark, steps, str(tmp_path / "out"), raw, settings=settings) == 1
    got = plugins[0]
    assert (got.start, got.end, got.unit, got.now, got.stream_id) == (3, 1, "d", NOW, "edge")


def jobs(spark):
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup("watched"))


@pytest.mark.parametrize(
    "steps, output, message",
    [
        (["aggregate", "resolve"], None, "Nowhere to write"),
        (["aggregate", {"resolve": {"resolver": "nobody"}}], "out", "nobody"),
        (["trim", {"collect": {"source": "nowhere"}}, "resolve"], "out", "nowhere"),
        (["resolve", {"aggregate": {"out_dir": "x"}}], None, "needs networks"),
    ],
)
def test_a_refused_run_leaves_nothing_behind(spark, raw, tmp_path, monkeypatch, steps, output, message):
    monkeypatch.setattr("flowtally.session.shared_folder", lambda spark: str(tmp_path / "shared"))
    store = CacheStore(spark, str(tmp_path / "cache"))
    settings = Settings(resolver="same", cache=store, now=NOW)
    spark.sparkContext.setJobGroup("watched", "")
    try:
        with pytest.raises(ValueError, match=message):
            run_pipeline(spark, steps, output and str(tmp_path / output), raw, settings=settings)
        assert jobs(spark) == 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not (tmp_path / "shared").exists() and not (tmp_path / "cache").exists() and not (tmp_path / "out").exists()


def test_a_missing_key_column_is_found_before_any_lookup(spark, raw, tmp_path, monkeypatch):
    monkeypatch.setattr("flowtally.session.shared_folder", lambda spark: str(tmp_path / "shared"))
    steps = ["resolve", "aggregate", {"resolve": {"key_column": "message"}}]
    with pytest.raises(ValueError, match="no column 'message'"):
        run_pipeline(spark, steps, str(tmp_path / "out"), raw, settings=Settings(resolver="same", now=NOW))
    assert not (tmp_path / "shared").exists()


def test_merge_aligns_every_part_to_the_first_with_rows(spark, frame, tmp_path):
    for name, text in {"two": "A,B\n4,5\n", "three": "A,B,C\n7,8,9\n", "head": "Z,A\n"}.items():
        (tmp_path / name).write_text(text, "utf-8")
    files = {name: str(tmp_path / name) for name in ("two", "three", "head")}

    def merged(given, *names, **options):
        steps = [{"merge": {"inputs": [files[name] for name in names], **options}}]
        done = plan(spark, steps, given).frame
        return done.columns, sorted(map(tuple, done.collect()))

    running = frame("A, B, C", [("1", "2", "3")])
    assert merged(running, "two", "three") == (["A", "B", "C"], [("1", "2", "3"), ("4", "5", ""), ("7", "8", "9")])
    assert merged(running, "head") == (["A", "B", "C"], [("1", "2", "3")])
    assert merged(running.limit(0), "head", "two", "three") == (["A", "B"], [("4", "5"), ("7", "8")])
    assert merged(frame("X, Y", [("1", "2")]), "two", how="position") == (["X", "Y"], [("1", "2"), ("4", "5")])
    assert merged(None, "three", "two", multiline=False) == (["A", "B", "C"], [("4", "5", ""), ("7", "8", "9")])
    with pytest.raises(Exception):
        merged(None, "three", "two", how="position", mode="FAILFAST")


def test_a_count_that_no_step_made_is_text(spark, tmp_path):
    lines = ["DstIP,count,message", "151.101.1.6,0007,a", "185.15.59.2,3.7,b", "151.101.1.6,n/a,c", ",,d"]
    (tmp_path / "in.csv").write_text("\n".join(lines) + "\n", "utf-8")
    source = str(tmp_path / "in.csv")
    settings = Settings(resolver="same", cidrs=["10.0.0.0/8"], now=NOW)
    assert run_pipeline(spark, ["trim"], str(tmp_path / "a"), source) == 4
    counts = ["", "0007", "3.7", "n/a"]
    assert sorted(row[1] for row in written(spark, tmp_path / "a")) == counts
    assert run_pipeline(spark, ["trim", "resolve"], str(tmp_path / "b"), source, settings=settings) == 4
    assert sorted(row[1] for row in written(spark, tmp_path / "b")) == counts


def test_split_holds_what_later_steps_add(spark, raw, tmp_path):
    settings = Settings(resolver="same", cidrs=["10.7.0.4"], now=NOW)
    out = str(tmp_path / "split")
    assert run_pipeline(spark, ["trim", {"aggregate": {"out_dir": out}}, "resolve"], str(tmp_path / "no"), raw, settings=settings) == 3
    assert not (tmp_path / "no").exists()
    folders = sorted(p.name for p in (tmp_path / "split").iterdir() if p.is_dir())
    assert [name.split("__")[0] for name in folders] == ["slice=aggregation_10.7.0.4-32", "slice=aggregation_other"]
    assert written(spark, tmp_path / "split" / folders[0]) == [(*MAIL, "IS", "64500", "GEYSER", "Desk")]


def test_cache_of_a_run(spark, raw, tmp_path):
    store = CacheStore(spark, str(tmp_path / "cache"))
    settings = Settings(resolver="same", cache=store, now=NOW)
    run_pipeline(spark, ["aggregate", "resolve"], str(tmp_path / "a"), raw, settings=settings)
    assert store.read().count() == 2
    run_pipeline(spark, ["aggregate", "resolve"], str(tmp_path / "b"), raw, overrides={"cache": False}, settings=settings)
    assert written(spark, tmp_path / "a") == written(spark, tmp_path / "b")
    assert len(list((tmp_path / "cache").iterdir())) == 1


def test_stage_tables_of_a_run_are_removed(spark, raw, tmp_path, monkeypatch):
    monkeypatch.setattr("flowtally.session.shared_folder", lambda spark: str(tmp_path / "shared"))
    settings = Settings(resolver="same", now=NOW)
    assert run_pipeline(spark, ["aggregate", "resolve"], str(tmp_path / "a"), raw, settings=settings) == 3
    assert list((tmp_path / "shared").iterdir()) == []
    assert plan(spark, ["resolve"], read_csv(spark, raw), settings=settings).frame.count() == 5
    assert len(list((tmp_path / "shared").iterdir())) == 3
