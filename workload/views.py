"""Connections, networks, provider responses and a cache, derived from the given tables.

Each text is valid unchanged in Spark and in DuckDB. The tables hold no addresses, so
addresses are made from customer and event numbers; all views grow with the tables.
"""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from flowtally.session import stage

NOW = datetime(2024, 1, 31)


def address(customer: str, host: str) -> str:
    """Host ``host`` in the /24 that belongs to customer number ``customer``."""
    number = f"({customer})"
    octets = [f"150 + floor({number} / 65536)", f"floor({number} / 256) % 256", f"{number} % 256", host]
    return " || '.' || ".join(f"CAST(CAST({octet} AS BIGINT) AS STRING)" for octet in octets)


CUSTOMER = "user_id * 10 + event_id % 10"
HOST = "event_id % 16 * 16"

VIEWS: dict[str, str] = {}

# Private, IPv6, unparseable, empty, NULL, leading-zero and excepted destinations on purpose.
VIEWS["connections"] = f"""
SELECT event_id, ts AS timestamp,
  '10.2.' || CAST(82 + user_id % 3 AS STRING) || '.' || CAST(user_id % 16 * 16 + event_id % 2 AS STRING) AS SrcIP,
  CASE event_id % 22
    WHEN 0 THEN '192.168.1.' || CAST(event_id % 256 AS STRING)
    WHEN 1 THEN '2001:db8::' || CAST(event_id % 10 AS STRING)
    WHEN 2 THEN 'not-an-ip'
    WHEN 3 THEN ''
    WHEN 4 THEN CAST(NULL AS STRING)
    WHEN 5 THEN '8.8.8.8'
    WHEN 6 THEN '1.1.1.1'
    WHEN 7 THEN '192.0.0.9'
    WHEN 8 THEN '010.1.1.1'
    ELSE {address(CUSTOMER, HOST)}
  END AS DstIP,
  CASE event_id % 4 WHEN 0 THEN '443' WHEN 1 THEN '80' WHEN 2 THEN '53' ELSE '' END AS DstPort,
  CASE WHEN event_type = 'error' THEN 'deny' ELSE 'allow' END AS ac_action,
  CASE WHEN event_id % 5 = 0 THEN 'NA' ELSE 'rule' || CAST(event_id % 2 AS STRING) END AS ac_rule_name,
  CASE WHEN event_id % 3 = 0 THEN '' WHEN event_id % 3 = 1 THEN 'example.org' ELSE 'vk.ru' END AS url_domain,
  '/' || event_type AS url_path,
  CAST(1024 + event_id % 50000 AS STRING) AS SrcPort,
  'fw' || CAST(event_id % 2 AS STRING) AS source,
  props AS message,
  's' || CAST(event_id % 2 AS STRING) AS streams
FROM events"""

# Partly enriched rows, keys with white space and without text.
VIEWS["half_enriched"] = """
SELECT event_id, CASE WHEN event_id % 7 = 0 THEN ' ' || DstIP || ' ' ELSE DstIP END AS DstIP,
  CASE WHEN event_id % 4 < 2 THEN 'Old' ELSE '' END AS country,
  CASE WHEN event_id % 4 = 1 THEN '1' ELSE '' END AS asn,
  CASE WHEN event_id % 4 = 1 THEN 'OLD' WHEN event_id % 4 = 2 THEN ' ' ELSE '' END AS asn_descr,
  CASE WHEN event_id % 4 = 1 THEN 'Old contact' ELSE '' END AS contacts
FROM connections"""

VIEWS["hosts"] = f"""
SELECT DISTINCT {address(CUSTOMER, HOST)} AS key, {CUSTOMER} AS custkey FROM events"""

VIEWS["owners"] = """
SELECT hosts.key, hosts.custkey, c_name, c_mktsegment, c_acctbal, n_name, n_nationkey
FROM hosts JOIN customer ON c_custkey = custkey JOIN nation ON n_nationkey = c_nationkey"""

# Nested prefixes: a wide block per region, /16 per nation, /24 and /25 per customer.
VIEWS["geo_blocks"] = f"""
SELECT CAST(8 * (r_regionkey + 1) AS STRING) || '.0.0.0/' || CAST(6 + r_regionkey AS STRING) AS network,
  r_name AS country FROM region
UNION ALL
SELECT '150.' || CAST(n_nationkey AS STRING) || '.0.0/16', n_name FROM nation
UNION ALL
SELECT {address("c_custkey", "0")} || '/24', n_name FROM customer JOIN nation ON n_nationkey = c_nationkey
WHERE c_mktsegment <> 'HOUSEHOLD'
UNION ALL
SELECT {address("s_suppkey", "128")} || '/25', 'Half of ' || n_name FROM supplier JOIN nation ON n_nationkey = s_nationkey"""

# Networks of very different size over the sources; the first listed one counts.
VIEWS["source_networks"] = """
SELECT CAST(s_suppkey AS INT) AS position,
  '10.2.' || CAST(80 + s_suppkey % 6 AS STRING) || '.' || CAST(s_suppkey * 48 % 256 AS STRING) || '/'
    || CAST(22 + s_suppkey % 9 AS STRING) AS network,
  'net' || CAST(s_suppkey AS STRING) AS label
FROM supplier"""

# Lists of any length: as many addresses as there are customers, some of them sources.
VIEWS["source_addresses"] = """
SELECT '10.2.' || CAST(82 + c_custkey % 5 AS STRING) || '.' || CAST(c_custkey * 48 % 256 AS STRING) AS address FROM customer"""
VIEWS["narrow_networks"] = """
SELECT network FROM source_networks WHERE CAST(split_part(network, '/', 2) AS INT) >= 27"""

VIEWS["rdap_raw"] = """
SELECT key, CASE c_mktsegment
  WHEN 'AUTOMOBILE' THEN '{"asn":"' || CAST(64512 + n_nationkey AS STRING) || '","asn_description":" ' || n_name
    || '-AS ","asn_country_code":"' || substr(n_name, 1, 2)
    || '","network":{"country":"ZZ","events":[{"action":"last changed","timestamp":"2024-02-11"},'
    || '{"action":"Expiration","timestamp":"' || CASE WHEN custkey % 2 = 0 THEN '2024-03-01' ELSE '2023-03-01' END
    || '"}]},"objects":{"A":{"contact":{"name":"' || c_name || '"}},"B":{"contact":{"name":" ' || n_name
    || ' NOC "}},"C":{"contact":{"name":"' || c_name || '"}},"D":{"roles":["technical"]},"E":{"contact":{"name":"  "}},"F":"text"}}'
  WHEN 'BUILDING' THEN '{"asn":' || CASE WHEN custkey % 3 = 0 THEN '0' ELSE CAST(64512 + n_nationkey AS STRING) END
    || ',"asn_description":' || CASE custkey % 4 WHEN 0 THEN 'false' WHEN 1 THEN '"0"' ELSE 'null' END
    || ',"asn_country_code":' || CASE WHEN custkey % 3 = 0 THEN 'false' ELSE '""' END || ',"network":{"country":"'
    || substr(n_name, 1, 2) || '"},"objects":[{"contact":{"name":"' || c_name || '"}},{"contact":{"name":"Abuse"}},"text"]}'
  WHEN 'FURNITURE' THEN '{}'
  ELSE '{"asn":' END AS json
FROM owners WHERE c_mktsegment <> 'HOUSEHOLD'"""

VIEWS["rdap_aggregator_raw"] = """
SELECT key, '{"success":' || CASE WHEN c_acctbal > 4000 THEN 'true' ELSE 'false' END || ',"data":{"country":'
  || CASE WHEN custkey % 7 = 0 THEN '0' ELSE '"' || substr(n_name, 1, 2) || '"' END || ',"entities":[{"vcardArray":["vcard",[["version",{},"text","4.0"],["fn",{},"text","'
  || c_name || '"]]],"entities":[{"vcardArray":["vcard",[["fn",{},"text","' || n_name
  || ' NOC"]]],"entities":[{"vcardArray":["vcard",[["fn",{},"text","Desk ' || CAST(custkey AS STRING)
  || '"]]]}]}]},{"vcardArray":["vcard",[["fn",{},"text","' || c_name
  || '"]]]}],"events":[{"eventAction":"registration","eventDate":"2020-01-01"},{"eventAction":"expiration","eventDate":"2024-04-01"}]}}' AS json
FROM owners"""

VIEWS["rdap_bootstrap_raw"] = """
SELECT key, '{"network":{"country":"BB"},"objects":{"X":{"contact":{"name":"Boot ' || n_name || '"}}}}' AS json
FROM owners WHERE c_acctbal > 0"""

VIEWS["whois_raw"] = """
SELECT key, '{"asn":' || CASE WHEN custkey % 5 = 0 THEN 'false' ELSE '"' || CAST(65000 + n_nationkey AS STRING) || '"' END
  || ',"asn_description":"W-' || n_name || '","nets":[{"country":"' || substr(n_name, 1, 2) || '","description":"' || c_name || chr(92) || 'nSecond line"},{"country":"XX","name":"'
  || c_name || '"},{"description":' || CASE custkey % 3 WHEN 0 THEN '0' WHEN 1 THEN 'false' ELSE '""' END
  || ',"name":"' || n_name || '"},{"description":null,"name":' || CASE WHEN custkey % 2 = 0 THEN '0' ELSE '"0"' END || '}]}' AS json
FROM owners WHERE c_acctbal > 1000
UNION ALL
SELECT key, '{"asn":"","nets":[]}' FROM owners WHERE c_acctbal <= 1000"""

# Domains in and outside the served zones, in several spellings.
VIEWS["domains"] = """
SELECT c_custkey AS custkey, c_name, CASE c_mktsegment
    WHEN 'AUTOMOBILE' THEN 'Shop' || CAST(c_custkey AS STRING) || '.RU.'
    WHEN 'BUILDING' THEN ' shop' || CAST(c_custkey AS STRING) || '.su '
    WHEN 'FURNITURE' THEN 'shop' || CAST(c_custkey AS STRING) || '.xn--p1ai'
    WHEN 'HOUSEHOLD' THEN 'магазин' || CAST(c_custkey AS STRING) || '.рф'
    ELSE 'shop' || CAST(c_custkey AS STRING) || '.example.com' END AS domain
FROM customer"""

VIEWS["domain_raw"] = """
SELECT CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'shop' || CAST(c_custkey AS STRING) || '.ru'
    WHEN 'BUILDING' THEN 'shop' || CAST(c_custkey AS STRING) || '.su'
    ELSE 'shop' || CAST(c_custkey AS STRING) || '.xn--p1ai' END AS key,
  '% registry' || chr(10) || 'domain:  SHOP' || CAST(c_custkey AS STRING) || chr(10) || chr(10)
    || 'nserver:  ns1.' || c_name || '.' || chr(13) || chr(10) || 'ORG:   ' || c_name || ': Trade' || chr(10)
    || 'registrar:  ' || c_mktsegment || '-REG' || chr(10) || 'nserver: ns1.' || c_name || '.' || chr(10)
    || 'nserver: ns2.' || c_name || '.' || chr(10) || 'person:' || chr(10) || 'no separator here' || chr(10)
    || 'paid-till:  2024-0' || CAST(1 + c_custkey % 9 AS STRING) || '-15T21:00:00Z' || chr(10) || 'paid-till: 2030-01-01' AS json
FROM customer WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE')"""

VIEWS["service_location_raw"] = """
SELECT key, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Bad gateway' ELSE '{"country":{"name":"' || n_name || '"}}' END AS json
FROM owners"""

VIEWS["service_registration_raw"] = """
SELECT key, CASE WHEN c_mktsegment = 'BUILDING' THEN '<html>' ELSE '{"ip_whois":{"asn":'
  || CASE WHEN custkey % 5 = 0 THEN 'false' ELSE '"AS' || CAST(n_nationkey AS STRING) || '"' END
  || ',"asn_description":' || CASE WHEN custkey % 4 = 0 THEN '0' ELSE '"' || n_name || '"' END || ',"objects":{"A":{"contact":{"name":"' || c_name || '"}},"B":{"contact":{}},"C":{"contact":{"name":"'
  || n_name || '"}}}}}' END AS json
FROM owners WHERE c_mktsegment <> 'HOUSEHOLD'"""

# A third of the entries has expired, another resolver's ones must not be served.
VIEWS["resolve_cache"] = """
SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN 'rdap:v1:' ELSE 'default:v1:' END || key AS key,
  n_name AS country, CAST(n_nationkey AS STRING) AS asn, 'CACHED' AS asn_descr, c_name AS contacts,
  CASE WHEN c_acctbal > 3000 THEN TIMESTAMP '2024-02-01 00:00:00' ELSE TIMESTAMP '2024-01-31 00:00:00' END AS expires_at
FROM owners WHERE c_acctbal > 0"""

# Date texts as registries write them, and some that are none.
VIEWS["date_texts"] = """
SELECT event_id, CASE event_id % 9
    WHEN 0 THEN '2024-0' || CAST(1 + event_id % 9 AS STRING) || '-11T21:00:00Z'
    WHEN 1 THEN '2024-02-' || CAST(10 + event_id % 19 AS STRING)
    WHEN 2 THEN '2024.03.0' || CAST(1 + event_id % 9 AS STRING)
    WHEN 3 THEN '2024040' || CAST(1 + event_id % 9 AS STRING)
    WHEN 4 THEN 'nonsense'
    WHEN 5 THEN ''
    WHEN 6 THEN CAST(NULL AS STRING)
    WHEN 7 THEN ' 2025-01-0' || CAST(1 + event_id % 9 AS STRING) || ' 10:30:00+03:00 '
    ELSE CAST(2020 + event_id % 8 AS STRING) || '-02-30' END AS text
FROM events"""


def sources(name: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"(?:FROM|JOIN) (\w+)", VIEWS.get(name, ""))))


def needed(*names: str) -> list[str]:
    """The tables and views behind the names, each after what it is made from."""
    found: list[str] = []
    for name in names:
        found += [one for one in [*needed(*sources(name)), name] if one not in found]
    return found


# Views that stand for stored tables: they are written once per session and folder, as
# several files. Those made row by row of other stored views lie in as many files as these.
STORED = [name for name in VIEWS if name.endswith("_raw")] + ["geo_blocks", "resolve_cache", "hosts", "owners"]

ROW_BY_ROW = [name for name in STORED if sources(name) == ["owners"]]

_loaded: dict[tuple, DataFrame] = {}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, or a view over the tables in ``sf_dir``."""
    place = (spark.sparkContext.applicationId, id(spark), sf_dir, name)
    if place not in _loaded:
        if name not in VIEWS:
            _loaded[place] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        else:
            for source in sources(name):
                view(spark, sf_dir, source)
            for source in sources(name):
                view(spark, sf_dir, source).createOrReplaceTempView(source)
            frame = spark.sql(VIEWS[name])
            if name in STORED and name not in ROW_BY_ROW:
                frame = frame.repartition(spark.sparkContext.defaultParallelism)
            _loaded[place] = stage(frame, name) if name in STORED else frame
    return _loaded[place]


def ctes(*names: str) -> str:
    """The views as the WITH list of an SQL text."""
    return ", ".join(f"{one} AS ({VIEWS[one]})" for one in needed(*names) if one in VIEWS)
