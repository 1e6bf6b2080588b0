"""Every registered query against its SQL, over whole tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from check import comparable
from workload import views
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, database, name):
    frame = contract.queries()[name](spark, SF)
    rows = [tuple(row) for row in frame.collect()]
    if name in contract.oracle_sql():
        result = database.execute(contract.oracle_sql()[name])
        names = [column[0] for column in result.description]
        assert sorted(names) == sorted(frame.columns)
        assert comparable(rows, frame.columns) == comparable(result.fetchall(), names)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_sorted_queries_are_in_order(spark):
    rows = contract.queries()["aggregate_sorted"](spark, SF).collect()
    assert rows == sorted(rows, key=lambda r: (-r["count"], r.ac_action, r.SrcIP, r.DstIP, r.DstPort, r.url_domain, r.ac_rule_name))
    stamps = [row.timestamp for row in contract.queries()["collect_sorted"](spark, SF).collect()]
    days = [stamp[:10] for stamp in stamps]
    assert days == sorted(days, reverse=True)
    assert all(a <= b for a, b, da, db in zip(stamps, stamps[1:], days, days[1:]) if da == db)


def test_punycode_column(spark):
    rows = contract.queries()["domain_ascii"](spark, SF).collect()
    assert all(row["query"] == row.domain.strip().lower().encode("idna").decode() for row in rows if not row.domain.strip().endswith("."))


def test_queries_make_only_the_responses_they_read(spark):
    views._loaded.clear()
    QUERIES["whois_cascade"](spark, SF)
    made = {place[-1] for place in views._loaded}
    assert {"whois_raw", "domain_raw", "hosts"} <= made
    assert not made & {"geo_blocks", "rdap_raw", "rdap_aggregator_raw", "rdap_bootstrap_raw", "service_location_raw"}
    # Responses are made where their owners lie: nothing is shuffled for them.
    assert {"rdap_raw", "rdap_aggregator_raw", "rdap_bootstrap_raw", "whois_raw"} <= set(views.ROW_BY_ROW)
