"""What the plans must look like to hold at scale."""

import re
import time

import pytest
from pyspark.sql import functions as F

from flowtally.operators.aggregate import aggregate
from flowtally.operators.collect import CollectRules, collect, select_rows
from flowtally.operators.resolvers import get_resolver
from workload.queries import QUERIES, RULES, tables
from workload.views import view

SF = "/root/testdata/sf0.001"


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def explained(frame, capsys):
    capsys.readouterr()
    frame.explain("formatted")
    return capsys.readouterr().out


@pytest.fixture
def large(spark):
    """Plan as for tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_collect_pushes_filters_and_prunes_columns(spark, tmp_path, capsys):
    logs = view(spark, SF, "connections")
    logs.write.parquet(str(tmp_path / "logs"))
    counted = aggregate(collect(spark.read.parquet(str(tmp_path / "logs")), RULES))
    text, plan = explained(counted, capsys), plan_of(counted)
    pushed = re.search(r"PushedFilters: (.*)", text).group(1)
    for part in ("GreaterThanOrEqual(timestamp", "LessThan(timestamp", "EqualTo(streams,s1)", "GreaterThanOrEqual(SrcIP,10.2.82.)", "LessThan(SrcIP,10.2.84.33:)"):
        assert part in pushed
    schema = re.search(r"ReadSchema: (.*)", text).group(1)
    assert "message" not in schema and "url_path" not in schema and "SrcPort" not in schema
    assert plan.count("Exchange") == 1 and "partial_count" in plan


def test_collect_alone_does_not_shuffle(spark):
    assert "Exchange" not in plan_of(select_rows(view(spark, SF, "connections"), RULES))


@pytest.mark.parametrize("count", [1, 300, 1500])
def test_long_source_lists_keep_a_small_hint(spark, tmp_path, capsys, count):
    view(spark, SF, "connections").write.parquet(str(tmp_path / "logs"))
    listed = [f"10.{100 + i // 250}.{i % 250}.9" for i in range(count)]
    rules = CollectRules(now=RULES.now, start=20, end=2, unit="d", allowlist=listed, cidrs=[f"{a}/28" for a in listed])
    begin = time.monotonic()
    rows = collect(spark.read.parquet(str(tmp_path / "logs")), rules)
    text = explained(rows, capsys)
    assert time.monotonic() - begin < 5
    pushed = re.search(r"PushedFilters: (.*)", text).group(1)
    assert "GreaterThanOrEqual(SrcIP,10.100." in pushed and len(pushed) < 500
    assert rows.count() == 0


def test_a_cascade_shuffles_the_keys_once(large):
    keys = view(large, SF, "hosts").select("key")
    plan = plan_of(get_resolver("rdap", tables(large, SF)).answers(keys))
    assert plan.count("Exchange") == 4  # the keys and three response tables
    assert plan.count("SortMergeJoin") == 3


def test_the_default_chain_reads_its_keys_once(large):
    keys = view(large, SF, "connections").select(F.col("DstIP").alias("key")).where("key <> ''").distinct()
    plan = plan_of(get_resolver("default", tables(large, SF)).answers(keys))
    assert len(re.findall(r"FileScan parquet \[event_id", plan)) == 1
    # One shuffle of the keys and one of the narrow prefixes; the wide ones are grouped that way.
    assert plan.count("hashpartitioning(_wide") <= 2 and plan.count("hashpartitioning(_narrow") == 0


# Reads a source that a user wrote in Python, which is its point.
USER_SOURCES = {"window_source"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairwise_joins(large, name):
    plan = plan_of(QUERIES[name](large, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert ("Python" in plan) == (name in USER_SOURCES)
