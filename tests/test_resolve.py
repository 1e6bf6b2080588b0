import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from flowtally.operators import cache as caching
from flowtally.operators.resolve import Resolution, resolve, resolve_counters, resolve_keys
from flowtally.operators.resolvers import (
    Resolver,
    chain,
    first_filled,
    from_results,
    get_resolver,
    register_resolver,
)
from flowtally.schema import RESOLVE_COLUMNS
from flowtally.sources.cachestore import CacheStore, empty_cache

NOW = datetime(2024, 1, 31)


def named(keys):
    """Answers made from the key, by a Python function over Arrow batches."""

    def rows(batches):
        for batch in batches:
            batch["country"] = "Country-" + batch["key"]
            batch["asn"], batch["asn_descr"], batch["contacts"] = "AS-" + batch["key"], "D", "C"
            yield batch[["key", "country", "asn", "asn_descr", "contacts"]]

    return keys.mapInPandas(rows, "key string, country string, asn string, asn_descr string, contacts string")


NAMED = Resolver("named", from_results(named))


def provider(spark, **answers):
    """A step with fixed answers; keys asked but unknown get none."""
    rows = [(key, *[fields.get(n, "") for n in [*RESOLVE_COLUMNS, "expires"]]) for key, fields in answers.items()]
    table = spark.createDataFrame(rows, "key string, " + ", ".join(f"{n} string" for n in [*RESOLVE_COLUMNS, "expires"]))
    return from_results(lambda keys: keys.join(table, "key"))


def answered(spark, step, *keys):
    frame = spark.createDataFrame([(k,) for k in keys], "key string")
    return {row.key: tuple(row)[1:] for row in Resolver("x", step).answers(frame).collect()}


AGGREGATED = [("10.2.83.129", "8.8.8.8", "3"), ("10.2.83.130", " 8.8.8.8\t", "2"), ("10.2.83.129", "2.2.2.2", "1"), ("x", "", "1"), ("y", None, "1")]


def test_enrichment(frame):
    rows = frame("SrcIP, DstIP, count", AGGREGATED)
    got = resolve(rows, NAMED)
    assert got.rows.columns == ["SrcIP", "DstIP", "count", *RESOLVE_COLUMNS]
    result = {row.SrcIP + str(row.DstIP): row for row in got.rows.collect()}
    assert len(result) == 5
    assert result["10.2.83.130 8.8.8.8\t"].country == "Country-8.8.8.8"
    assert result["x"].country == "" and result["yNone"].asn == ""
    assert {row.key: row.key_rows for row in got.answers.collect()} == {"8.8.8.8": 2, "2.2.2.2": 1}


def test_second_run_changes_nothing_and_asks_nothing(frame):
    once = resolve(frame("SrcIP, DstIP, count", AGGREGATED[:3]), NAMED).rows
    again = resolve(once, Resolver("never", from_results(lambda keys: keys.withColumn("country", F.raise_error("asked")))))
    assert again.answers.count() == 0
    assert sorted(map(tuple, again.rows.collect())) == sorted(map(tuple, once.collect()))
    forced = resolve(once, Resolver("empty", from_results(lambda keys: keys.limit(0))), skip_already_enriched=False)
    assert {row.country for row in forced.rows.collect()} == {""}


def test_partly_filled_rows_are_overwritten_also_with_nothing(spark, frame):
    rows = frame("DstIP, country, asn, asn_descr, contacts", [("1.1.1.1", "Old", "", " ", ""), ("2.2.2.2", "Old", "1", "D", "C"), ("", "Old", "", "", "")])
    got = resolve(rows, Resolver("x", provider(spark, **{"1.1.1.1": {"asn": "7"}}))).rows
    assert sorted(map(tuple, got.collect())) == [("", "Old", "", "", ""), ("1.1.1.1", "", "7", "", ""), ("2.2.2.2", "Old", "1", "D", "C")]


def test_no_rows_and_no_key_column(frame):
    assert resolve(frame("DstIP, a", []), NAMED).rows.columns == ["DstIP", "a", *RESOLVE_COLUMNS]
    assert resolve(frame("DstIP, a", []), NAMED).rows.count() == 0
    with pytest.raises(ValueError, match="DstIP"):
        resolve(frame("a", []), NAMED)
    with pytest.raises(ValueError, match="now"):
        resolve(frame("DstIP", []), NAMED, cache=frame("a", []))


def test_hot_key_with_many_rows(spark):
    rows = spark.range(2000).selectExpr("CASE WHEN id % 3 = 0 THEN '8.8.8.8' ELSE '1.1.' || (id % 7) || '.1' END AS DstIP", "id")
    got = resolve(rows, NAMED).rows
    assert got.count() == 2000 and got.where("country <> 'Country-' || DstIP").count() == 0


# -- cache -------------------------------------------------------------------------


def test_answers_are_cached_and_served(spark, frame, tmp_path):
    store = CacheStore(spark, str(tmp_path / "deep" / "cache"))
    rows = frame("DstIP", [("1.1.1.1",), ("1.1.1.1",), ("2.2.2.2",), ("9.9.9.9",)])
    fixed = {"1.1.1.1": {"country": "RU", "expires": "2024-02-10"}, "2.2.2.2": {"country": "RU"}, "9.9.9.9": {"expires": "2024-02-10"}}
    first = resolve(rows, Resolver("fix", provider(spark, **fixed)), cache=store.read(), now=NOW)
    store.append(first.fresh)
    stored = {row.key: (row.country, row.contacts, row.expires_at) for row in store.read().collect()}
    assert stored == {
        "fix:v1:1.1.1.1": ("RU", "", datetime(2024, 2, 11)),
        "fix:v1:2.2.2.2": ("RU", "", datetime(2024, 2, 1)),
    }
    nobody = Resolver("fix", from_results(lambda keys: keys.limit(0)))
    second = resolve(rows.limit(3), nobody, cache=store.read(), now=NOW)
    assert {row.country for row in second.rows.collect()} == {"RU"}
    assert {row.cached for row in second.answers.collect()} == {True} and second.fresh.count() == 0
    later = resolve(rows, nobody, cache=store.read(), now=datetime(2024, 2, 1))
    assert {row.key: row.cached for row in later.answers.collect()} == {"1.1.1.1": True, "2.2.2.2": False, "9.9.9.9": False}
    other = resolve(rows, Resolver("other", nobody.step), cache=store.read(), now=NOW)
    assert not any(row.cached for row in other.answers.collect())


def entries(spark, *rows):
    return spark.createDataFrame([(key, country, "", "", "", at) for key, country, at in rows], empty_cache(spark).schema)


def test_upsert(spark):
    soon = NOW + timedelta(days=1)
    old = entries(spark, ("a", "old", soon + timedelta(days=9)), ("b", "old", soon), ("gone", "old", NOW))
    new = entries(spark, ("a", "new", soon), ("c", "new", soon), ("dead", "new", NOW - timedelta(days=1)))
    got = {row.key: row.country for row in caching.upsert(old, new, NOW).collect()}
    assert got == {"a": "new", "b": "old", "c": "new"}


def test_versions_and_broken_caches(spark, tmp_path):
    store = CacheStore(spark, str(tmp_path / "cache"))
    assert store.read().count() == 0
    for n in range(4):
        store.append(entries(spark, (str(n % 3), f"c{n}", NOW + timedelta(days=n))))
        assert store.read().count() == n + 1
    (tmp_path / "cache" / "v=9").mkdir()
    live = {row.key: row.cached.country for row in caching.live_entries(store.read().withColumn("key", F.concat(F.lit("x:v1:"), "key")), "x", NOW).collect()}
    assert live == {"0": "c3", "1": "c1", "2": "c2"}
    store.compact(NOW)
    assert {(row.key, row.country) for row in store.read().collect()} == {("0", "c3"), ("1", "c1"), ("2", "c2")}
    assert sorted(p.name for p in (tmp_path / "cache").iterdir()) == ["v=5", "v=9"]
    blocked = CacheStore(spark, "/dev/null/nope")
    assert blocked.read().count() == 0
    blocked.append(entries(spark, ("a", "x", NOW)))


def test_counters(spark, frame):
    cache = entries(spark, ("named:v1:1.1.1.1", "x", NOW + timedelta(days=1)), ("named:v1:2.2.2.2", "x", NOW))
    rows = frame("DstIP", [("1.1.1.1",), ("1.1.1.1",), ("2.2.2.2",), ("",)])
    assert tuple(resolve_counters(rows, cache, NAMED, NOW).first()) == (4, 3, 2, 1, 1)


# -- resolvers -----------------------------------------------------------------------


def test_chain_takes_the_first_filled_field(spark):
    geo = provider(spark, a={"country": "Iceland"})
    rdap = provider(
        spark,
        a={"country": "IS", "asn": "64510", "asn_descr": "GEYSER", "contacts": "Geyser Desk"},
        b={"country": "FO", "expires": "2024-03-01"},
    )
    whois = provider(spark, a={"expires": "2030-01-01"}, b={"country": "XX", "asn": "9", "expires": "2031-01-01"}, c={"contacts": "Quay"})
    assert answered(spark, lambda frame: chain(frame, [geo, rdap, whois]), "a", "b", "c", "d") == {
        "a": ("Iceland", "64510", "GEYSER", "Geyser Desk", ""),  # complete, so the last one is not asked
        "b": ("FO", "9", "", "", "2024-03-01"),
        "c": ("", "", "", "Quay", ""),
        "d": ("", "", "", "", ""),
    }


def test_tiers_replace_as_a_whole(spark):
    tiers = [
        provider(spark, a={"country": "US"}, c={"expires": "x"}),
        provider(spark, a={"asn": "1"}, b={"contacts": "B"}, c={"asn": "1"}),
        provider(spark, b={"country": "BB"}, d={"country": "DD"}),
    ]
    assert answered(spark, lambda frame: first_filled(frame, tiers), "a", "b", "c", "d") == {
        "a": ("US", "", "", "", ""), "b": ("", "", "", "B", ""), "c": ("", "", "", "", "x"), "d": ("DD", "", "", "", ""),
    }


def test_registered_cascade_and_switches(spark, frame):
    tables = {
        "rdap": frame("key, json", [("a", "{}"), ("b", '{"asn":"1"}')]),
        "rdap_aggregator": frame("key, json", [("a", json.dumps({"success": True, "data": {"country": "RU"}})), ("b", json.dumps({"success": True, "data": {"country": "RU"}}))]),
        "rdap_bootstrap": frame("key, json", [("a", '{"network":{"country":"XX"}}'), ("c", '{"network":{"country":"AU"}}')]),
    }

    def countries(**options):
        return {k: v[0] for k, v in answered(spark, get_resolver("rdap", tables, **options).step, "a", "b", "c").items()}

    assert countries() == {"a": "RU", "b": "", "c": "AU"}
    assert countries(aggregator=False) == {"a": "XX", "b": "", "c": "AU"}
    assert countries(aggregator=False, bootstrap=False) == {"a": "", "b": "", "c": ""}


def test_domain_tier(spark, frame):
    tables = {"whois": frame("key, json", [("pier.su", '{"asn":"1"}')]), "domain_whois": frame("key, json", [("pier.ru", "org: Pier"), ("pier.su", "org: SU")])}
    on = answered(spark, get_resolver("whois", tables, domain_whois=True).step, "Pier.ru.", "pier.su", "8.8.8.8")
    assert on == {"Pier.ru.": ("", "", "", "Pier", ""), "pier.su": ("", "1", "", "", ""), "8.8.8.8": ("", "", "", "", "")}
    off = answered(spark, get_resolver("whois", tables).step, "Pier.ru.")
    assert off == {"Pier.ru.": ("", "", "", "", "")}


def test_nothing_configured_and_unknown_names(spark):
    for name in ("geo", "rdap", "whois", "service", "default"):
        assert answered(spark, get_resolver(name).step, "8.8.8.8") == {"8.8.8.8": ("",) * 5}
    register_resolver("mine")(lambda tables, **options: NAMED.step)
    assert answered(spark, get_resolver("mine").step, "k")["k"][0] == "Country-k"
    with pytest.raises(ValueError, match="Unknown resolver 'nope'.*default.*mine"):
        get_resolver("nope")


def test_repeated_responses_do_not_multiply_rows(spark, frame):
    tables = {"whois": frame("key, json", [("a", '{"asn":"1"}'), ("a", '{"asn":"2"}')])}
    result: Resolution = resolve(frame("DstIP", [("a",), ("a",)]), get_resolver("whois", tables))
    assert [row.asn for row in result.rows.collect()] == ["2", "2"]
    dated = [("a", '{"asn":"9"}', "2024-01-01"), ("a", '{"asn":"3"}', "2024-02-01"), ("a", '{"asn":"1"}', "2024-02-01")]
    newest = resolve(frame("DstIP", [("a",)]), get_resolver("whois", {"whois": frame("key, json, fetched_at", dated)}))
    assert [row.asn for row in newest.rows.collect()] == ["3"]
    assert resolve_keys(frame("DstIP", [("a",), ("a",)])).count() == 1
