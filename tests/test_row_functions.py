"""Lookups by a Python function and counters of a run."""

import sys
import threading
import time
from datetime import datetime

import pytest
from pyspark import cloudpickle

from flowtally.operators.counters import RunCounters
from flowtally.operators.resolve import resolve
from flowtally.operators.resolvers import RESOLVERS, Resolver, chain, first_filled, get_resolver
from flowtally.operators.rowfunction import from_function, register_function
from flowtally.plans.pipeline import plan, run_pipeline
from flowtally.plans.settings import Settings
from flowtally.sources.cachestore import CacheStore, empty_cache
from flowtally.sources.registry import register_source

NOW = datetime(2024, 1, 31)
cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks cannot import this file


def known(key):
    if key.startswith("bad"):
        raise RuntimeError(f"cannot ask for {key}")
    if key == "odd":
        return ["no mapping"]
    return None if key == "none" else {"country": key.upper(), "asn": 7, "contacts": None, "further": 1}


def asked(frame, step, *keys):
    rows = Resolver("x", step).step(frame("key", [(k,) for k in keys]).selectExpr("*", "key <> 'unwanted' AS wanted"))
    return {row.key: row for row in rows.collect()}


def test_each_key_fails_alone(frame):
    found = asked(frame, from_function(known), "a", "bad1", "none", "odd", "unwanted", "b")
    assert found["a"].answer.asDict() == {"country": "A", "asn": "7", "asn_descr": "", "contacts": "", "expires": ""}
    assert found["b"].answer.country == "B" and found["a"].error is None
    assert found["bad1"].answer is None and found["bad1"].error == "RuntimeError: cannot ask for bad1"
    assert found["none"].answer is None and found["none"].error is None
    assert found["odd"].answer is None and found["odd"].error.startswith("AttributeError")
    assert found["unwanted"].answer is None and found["unwanted"].error is None


def test_failures_inside_a_cascade_and_a_chain(frame):
    second = from_function(lambda key: {"country": "second", "asn": "2"})
    for together in (first_filled, chain):
        found = asked(frame, lambda rows, t=together: t(rows, [from_function(known), second]), "a", "bad", "none")
        assert found["bad"].answer.country == "second" and found["bad"].error == "RuntimeError: cannot ask for bad"
        assert found["none"].answer.country == "second" and found["a"].answer.country == "A"


def test_no_more_calls_at_once_than_workers(frame, tmp_path):
    path = str(tmp_path)

    def slow(key):
        open(f"{path}/{key}-{threading.get_ident()}", "w").close()
        time.sleep(0.02)
        return {"country": key}

    rows = frame("key", [(f"k{i}",) for i in range(40)]).coalesce(1).selectExpr("*", "true AS wanted")
    assert from_function(slow, workers=2)(rows).where("answer.country = key").count() == 40
    assert len({one.name.split("-")[1] for one in tmp_path.iterdir()}) <= 2
    with pytest.raises(ValueError):
        from_function(slow, workers=0)


def test_failed_answers_are_not_cached_and_others_are(spark, frame):
    rows = frame("DstIP", [("a",), ("a",), ("bad",), ("none",), ("",)])
    counters = RunCounters()
    got = resolve(rows, Resolver("known", from_function(known)), cache=empty_cache(spark), now=NOW, counters=counters)
    assert {row.key for row in got.fresh.collect()} == {"known:v1:a"}
    assert counters.get() == {"resolve": {"keys": 3, "key_rows": 4, "hits": 0, "misses": 3, "failed": 1}}
    assert sorted((row.DstIP, row.country) for row in got.rows.collect()) == [("", ""), ("a", "A"), ("a", "A"), ("bad", ""), ("none", "")]
    again = RunCounters()
    resolve(rows, Resolver("known", from_function(known)), cache=got.fresh, now=NOW, counters=again)
    assert again.get()["resolve"]["hits"] == 1 and again.get()["resolve"]["failed"] == 1


def test_registered_functions(frame):
    register_function("mine", workers=1)(known)
    try:
        assert asked(frame, get_resolver("mine", workers=4).step, "a", "bad")["a"].answer.asn == "7"
        with pytest.raises(ValueError, match="worker"):
            get_resolver("mine", workers=0)
    finally:
        del RESOLVERS["mine"]


# -- counters ----------------------------------------------------------------------


def jobs(spark, action):
    group = f"jobs-{time.monotonic_ns()}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        action()
        time.sleep(0.5)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


STEPS = [{"collect": {"start": 3, "time_unit": "d"}}, "trim", {"aggregate": {"min_count": 2}}, "resolve"]


def counting_settings(spark, **more):
    days = {"2024-01-30 10:00:00": 5, "2024-01-29 23:00:00": 3, "2024-01-28 01:00:00": 2, "2024-01-20 00:00:00": 4}
    rows = [(day, f"10.0.0.{i % 2}", f"8.8.8.{i}", "443") for day, n in days.items() for i in range(n)]
    logs = spark.createDataFrame(rows, "timestamp string, SrcIP string, DstIP string, DstPort string").withColumnRenamed("timestamp", "t")
    from flowtally.operators.collect import collect

    register_source("counted")(lambda spark, rules: collect(logs.selectExpr("CAST(t AS timestamp) AS timestamp", "* EXCEPT (t)"), rules))
    return Settings(source="counted", resolver="known", now=NOW, **more)


@pytest.fixture
def with_known():
    register_function("known")(lambda key: known("bad" if key.endswith("1") else key))
    yield
    del RESOLVERS["known"]


def test_counters_of_a_run_equal_separate_counts(spark, tmp_path, with_known):
    settings = counting_settings(spark, cache=CacheStore(spark, f"{tmp_path}/cache"))
    counters = RunCounters()
    assert run_pipeline(spark, STEPS, f"{tmp_path}/out", settings=settings, counters=counters) == 3
    assert counters.get() == {
        "collect": {"rows": 10, "window0": 5, "window1": 3, "window2": 2},
        "aggregate": {"groups_kept": 3, "groups_dropped": 2, "rows_kept": 8, "rows_dropped": 2},
        "resolve": {"keys": 3, "key_rows": 3, "hits": 0, "misses": 3, "failed": 1},
    }
    again = RunCounters()
    run_pipeline(spark, STEPS, f"{tmp_path}/again", settings=settings, counters=again)
    assert again.get()["resolve"] == {"keys": 3, "key_rows": 3, "hits": 2, "misses": 1, "failed": 1}


def test_counters_take_no_further_job(spark, tmp_path, with_known):
    settings = counting_settings(spark)
    for number, steps in enumerate((STEPS, STEPS[:3], STEPS[:1])):
        runs = []
        for one in (None, RunCounters(), None):
            out = f"{tmp_path}/{number}-{len(runs)}"
            runs.append(jobs(spark, lambda: run_pipeline(spark, steps, out, settings=settings, counters=one)))
        assert runs[1] == runs[2], runs


def test_counters_of_nothing(spark, with_known):
    settings = counting_settings(spark)
    counters = RunCounters()
    plan(spark, [{"collect": {"start": 9, "end": 8, "time_unit": "d"}}, {"aggregate": {}}, "resolve"], settings=settings, counters=counters)
    assert counters.get()["collect"] == {"rows": 0, "window8": 0}
    assert set(counters.get()["aggregate"].values()) == {0} and set(counters.get()["resolve"].values()) == {0}
