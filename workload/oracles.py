"""The same results as plain SQL for DuckDB, over the same tables and views."""

from __future__ import annotations

from workload.queries import ALLOWLIST, NETWORKS
from workload.views import ctes

ORACLES: dict[str, str] = {}

NOW = "TIMESTAMP '2024-01-31 00:00:00'"
GROUP = ["SrcIP", "DstIP", "DstPort", "ac_action", "url_domain", "ac_rule_name"]
COLLECTED = ["timestamp", "SrcIP", "DstIP", "DstPort", "ac_action", "ac_rule_name", "url_domain", "url_path"]
COLUMNS = ["country", "asn", "asn_descr", "contacts"]
OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"

# (low, high) of the private blocks and of the public addresses inside them.
PRIVATE = [
    ("0.0.0.0", "0.255.255.255"),
    ("10.0.0.0", "10.255.255.255"),
    ("127.0.0.0", "127.255.255.255"),
    ("169.254.0.0", "169.254.255.255"),
    ("172.16.0.0", "172.31.255.255"),
    ("192.0.0.0", "192.0.0.8"),
    ("192.0.0.11", "192.0.0.255"),
    ("192.0.2.0", "192.0.2.255"),
    ("192.168.0.0", "192.168.255.255"),
    ("198.18.0.0", "198.19.255.255"),
    ("198.51.100.0", "198.51.100.255"),
    ("203.0.113.0", "203.0.113.255"),
    ("240.0.0.0", "255.255.255.255"),
]


def number(text: str) -> str:
    """Address text to number; only for valid addresses."""
    parts = [f"CAST(split_part({text}, '.', {i}) AS BIGINT) * {256 ** (4 - i)}" for i in range(1, 5)]
    return "(" + " + ".join(parts) + ")"


def valid(text: str) -> str:
    return f"coalesce(regexp_full_match({text}, '{OCTET}([.]{OCTET}){{3}}'), false)"


def inside(text: str, ranges: list[tuple[str, str]]) -> str:
    tests = " OR ".join(f"{number(text)} BETWEEN {number(repr(low))} AND {number(repr(high))}" for low, high in ranges)
    return f"(CASE WHEN {valid(text)} THEN ({tests}) ELSE false END)"


def ranges(networks) -> list[tuple[str, str]]:
    def dotted(value: int) -> str:
        return ".".join(str(value >> shift & 255) for shift in (24, 16, 8, 0))

    return [(dotted(net.low), dotted(net.high)) for net in networks]


def listed(values) -> str:
    return ", ".join(repr(value) for value in values)


def over(views: list[str], body: str, *more: str) -> str:
    """``body`` over views and further ``name AS (...)`` items."""
    names = ", ".join(part for part in [ctes(*views), *more] if part)
    return f"WITH {names} {body}" if names else body


def logs(body: str) -> str:
    return over(["connections"], body)


def label(networks) -> str:
    cases = " ".join(
        f"WHEN {inside('trim(SrcIP)', [span])} THEN '{net.label}'" for net, span in zip(networks, ranges(networks), strict=True)
    )
    return f"(CASE {cases} ELSE 'other' END)"


def filled(names: list[str]) -> str:
    return ", ".join(f"coalesce({name}, '') AS {name}" for name in names)


def counted(source: str, keys: list[str], having: str = "") -> str:
    return f"SELECT {filled(keys)}, count(*) AS count FROM {source} GROUP BY ALL {having}"


PUBLIC = f"{valid('SrcIP')} AND {valid('DstIP')} AND NOT {inside('DstIP', PRIVATE)}"
IN_RANGE = f"timestamp >= {NOW} - INTERVAL 20 DAY AND timestamp < {NOW} - INTERVAL 2 DAY"
LISTED = f"SrcIP IN ({listed(ALLOWLIST)})"
SOURCE = f"({LISTED} OR {inside('SrcIP', ranges(NETWORKS[:2]))})"
COLLECT = f"""SELECT coalesce(CAST(timestamp AS VARCHAR), '') AS timestamp, {filled(COLLECTED[1:])} FROM connections
  WHERE {IN_RANGE} AND streams = 's1' AND SrcIP <> '' AND DstIP <> '' AND {SOURCE} AND {PUBLIC}"""

# -- scans, filters, projections ---------------------------------------------------

ORACLES["collect"] = ORACLES["collect_sorted"] = ORACLES["window_source"] = logs(COLLECT)
ORACLES["time_range"] = logs(f"SELECT event_id FROM connections WHERE {IN_RANGE}")
ORACLES["stream_filter"] = logs(
    """SELECT event_id, 'one' AS field FROM connections WHERE streams = 's1'
    UNION ALL SELECT event_id, 'many' FROM connections WHERE list_contains([streams, source], 'fw0')"""
)
ORACLES["exists_filter"] = logs("SELECT event_id, DstIP FROM connections WHERE SrcIP <> '' AND DstIP <> ''")
ORACLES["valid_ipv4"] = logs(
    f"""SELECT event_id, DstIP, {valid('DstIP')} AS valid,
    CASE WHEN {valid('DstIP')} THEN {number('DstIP')} END AS number FROM connections"""
)
ORACLES["public_dst"] = logs(
    f"SELECT event_id, DstIP, {inside('DstIP', PRIVATE)} AS private FROM connections WHERE {valid('DstIP')} AND {valid('SrcIP')}"
)
ORACLES["src_allowlist"] = logs(f"SELECT event_id, SrcIP FROM connections WHERE {LISTED}")
ORACLES["src_cidr"] = logs(f"SELECT event_id, SrcIP FROM connections WHERE {inside('SrcIP', ranges(NETWORKS))}")
ORACLES["src_match_or"] = logs(
    f"SELECT event_id, SrcIP FROM connections WHERE {LISTED} OR {inside('SrcIP', ranges(NETWORKS[:1]))}"
)
ORACLES["src_match_and"] = logs(
    f"SELECT event_id, SrcIP FROM connections WHERE {LISTED} AND {inside('SrcIP', ranges(NETWORKS[:1]))}"
)
LARGE = f"""spans AS (SELECT {number("split_part(network, '/', 1)")} AS base,
    CAST(pow(2, 32 - CAST(split_part(network, '/', 2) AS BIGINT)) AS BIGINT) AS size FROM narrow_networks)"""
INSIDE = f"""inside AS (SELECT DISTINCT SrcIP FROM (SELECT DISTINCT SrcIP FROM connections)
    JOIN spans ON {number('SrcIP')} >= base - base % size AND {number('SrcIP')} < base - base % size + size)"""
ORACLES["src_large_lists"] = over(
    ["connections", "source_addresses", "narrow_networks"],
    """SELECT 'or' AS mode, event_id, SrcIP FROM connections
      WHERE SrcIP IN (SELECT address FROM source_addresses) OR SrcIP IN (SELECT SrcIP FROM inside)
    UNION ALL SELECT 'and', event_id, SrcIP FROM connections
      WHERE SrcIP IN (SELECT address FROM source_addresses) AND SrcIP IN (SELECT SrcIP FROM inside)""",
    LARGE,
    INSIDE,
)
ORACLES["log_store"] = logs(COLLECT)
ORACLES["prefix_prefilter"] = logs(
    f"""SELECT SrcIP, count(*) FILTER (WHERE SrcIP LIKE '10.2.82.%') AS coarse,
    count(*) FILTER (WHERE {inside('SrcIP', ranges(NETWORKS[:1]))}) AS exact FROM connections GROUP BY SrcIP"""
)
ORACLES["trim"] = ORACLES["stream_trim"] = logs(
    "SELECT event_id, SrcIP, DstIP, DstPort, ac_action, ac_rule_name, url_domain, url_path, streams FROM connections"
)

# -- subnets -----------------------------------------------------------------------

ORACLES["subnet_label"] = logs(f"SELECT event_id, SrcIP, {label(NETWORKS)} AS subnet FROM connections")
ORACLES["subnet_label_table"] = over(
    ["connections", "source_networks"],
    """SELECT event_id, c.SrcIP, coalesce(label, 'other') AS subnet
    FROM connections c LEFT JOIN labels USING (SrcIP)""",
    f"""spans AS (SELECT position, label, {number("split_part(network, '/', 1)")} AS base,
      CAST(pow(2, 32 - CAST(split_part(network, '/', 2) AS BIGINT)) AS BIGINT) AS size FROM source_networks)""",
    f"""labels AS (SELECT SrcIP, min_by(label, position) AS label FROM (SELECT DISTINCT SrcIP FROM connections) s
      JOIN spans ON {number('SrcIP')} >= base - base % size AND {number('SrcIP')} < base - base % size + size GROUP BY SrcIP)""",
)
ORACLES["slice_name"] = logs(
    f"""SELECT 'aggregation_' || {label(NETWORKS)} || '__2024-01-26__2024-01-31__time-00-00.csv' AS slice, count(*) AS rows
    FROM connections GROUP BY ALL"""
)
ORACLES["split_counts"] = over(
    ["connections"],
    f"SELECT {label(NETWORKS)} AS subnet, count(*) AS rows FROM groups GROUP BY ALL",
    f"groups AS ({counted(f'({COLLECT})', GROUP)})",
)

# -- aggregation -------------------------------------------------------------------

ORACLES["aggregate"] = logs(counted("connections", GROUP))
for same in ("aggregate_sorted", "aggregate_merge", "aggregate_stored", "stream_aggregate"):
    ORACLES[same] = ORACLES["aggregate"]
ORACLES["aggregate_partial"] = ORACLES["aggregate_two_phase"] = logs(
    counted("connections", ["SrcIP", "DstIP", "ac_action"])
)
ORACLES["min_count"] = logs(counted("connections", ["SrcIP", "DstIP"], "HAVING count(*) >= 3"))
ORACLES["min_count_report"] = over(
    ["connections"],
    """SELECT count(*) FILTER (WHERE count >= 3) AS groups_kept, count(*) FILTER (WHERE count < 3) AS groups_dropped,
    CAST(coalesce(sum(count) FILTER (WHERE count >= 3), 0) AS BIGINT) AS rows_kept,
    CAST(coalesce(sum(count) FILTER (WHERE count < 3), 0) AS BIGINT) AS rows_dropped FROM groups""",
    f"groups AS ({counted('connections', ['SrcIP', 'DstIP'])})",
)

# -- merge -------------------------------------------------------------------------

ORACLES["merge_positional"] = logs(
    """SELECT SrcIP, DstIP, ac_action FROM connections WHERE ac_action = 'deny'
    UNION ALL SELECT DstIP, SrcIP, ac_action FROM connections WHERE ac_action = 'allow'"""
)
ORACLES["merge_by_name"] = logs(
    """SELECT SrcIP, DstIP, ac_action FROM connections WHERE ac_action = 'deny'
    UNION ALL SELECT DstIP, '', ac_action FROM connections WHERE ac_action = 'allow'"""
)

MERGED_PARTS = {
    "a": ["SrcIP", "DstIP", "ac_action"],
    "b": ["DstIP", "SrcIP", "url_domain"],
    "c": ["ac_action", "DstPort", "SrcIP"],
}


def merged_part(number: int, names: list[str]) -> str:
    columns = ", ".join(f"coalesce({name}, '') AS {new}" for name, new in zip(names, MERGED_PARTS["a"], strict=True))
    return f"SELECT {columns} FROM connections WHERE event_id % 3 = {number}"


BY_NAME = [["SrcIP", "DstIP", "ac_action"], ["SrcIP", "DstIP", "NULL"], ["SrcIP", "NULL", "ac_action"]]
ORACLES["pipeline_merged"] = logs(
    " UNION ALL ".join(
        f"SELECT '{how}' AS how, SrcIP, DstIP, ac_action, count(*) AS count FROM ("
        + " UNION ALL ".join(merged_part(number, names) for number, names in enumerate(parts))
        + ") GROUP BY ALL"
        for how, parts in (("name", BY_NAME), ("position", list(MERGED_PARTS.values())))
    )
)

# -- time --------------------------------------------------------------------------

ORACLES["time_expr"] = """SELECT event_id,
  CASE WHEN event_id % 30 = 0 THEN 'now' ELSE 'now-' || (event_id % 30) || 'h' END AS expr,
  ts - to_days(CAST(event_id % 30 AS INTEGER)) AS days_back, ts - to_hours(event_id % 30) AS hours_back FROM events"""
ORACLES["time_windows"] = """
SELECT event_id, 'now-' || (k + 1) || 'h' AS gte_expr, CASE WHEN k = 0 THEN 'now' ELSE 'now-' || k || 'h' END AS lt_expr,
  CAST(k + 1 AS INTEGER) AS from_value, CAST(k AS INTEGER) AS to_value
FROM events JOIN (SELECT range AS k FROM range(0, 7)) ON k >= event_id % 4 AND k < user_id % 7"""
ORACLES["window_counts"] = f"""
SELECT CAST((date_diff('microsecond', ts, {NOW}) - 1) // 3600000000 AS BIGINT) AS window_no, count(*) AS rows
FROM events GROUP BY ALL"""

PARSED = """parsed AS (SELECT event_id, CASE event_id % 9
    WHEN 0 THEN strptime(text, '%Y-%m-%dT%H:%M:%SZ')
    WHEN 1 THEN strptime(text, '%Y-%m-%d')
    WHEN 2 THEN strptime(text, '%Y.%m.%d')
    WHEN 3 THEN strptime(text, '%Y%m%d')
    WHEN 7 THEN strptime(substr(trim(text), 1, 19), '%Y-%m-%d %H:%M:%S') - INTERVAL 3 HOUR
    ELSE NULL END AS moment FROM date_texts)"""
EXPIRY = f"CASE WHEN {{0}} + INTERVAL 1 DAY > {NOW} AND {{0}} + INTERVAL 1 DAY <= {NOW} + INTERVAL 366 DAY THEN {{0}} + INTERVAL 1 DAY ELSE TIMESTAMP '2024-02-01' END"
ORACLES["date_parse"] = over(["date_texts"], "SELECT event_id, moment AS parsed FROM parsed", PARSED)
ORACLES["cache_expiry"] = over(
    ["date_texts"], f"SELECT event_id, {EXPIRY.format('moment')} AS expires_at FROM parsed", PARSED
)

# -- answers of each provider --------------------------------------------------------


def ordered_names(names: str) -> str:
    """Non-blank names, each once, in order, joined."""
    kept = f"list_filter(list_transform({names}, lambda x: trim(coalesce(x, ''))), lambda x: x <> '')"
    return f"coalesce(array_to_string(list_filter({kept}, lambda x, i: list_position({kept}, x) = i), '; '), '')"


def readable(source: str) -> str:
    return f"(SELECT key, CASE WHEN json_valid(json) THEN CAST(json AS JSON) END AS j FROM {source})"


def meant(path: str, source: str = "j") -> str:
    """Text of a value that is not zero, false or null; the text '0' is one."""
    value = f"json_extract_string({source}, '{path}')"
    nothing = f"""json_type({source}, '{path}') = 'BOOLEAN' AND {value} = 'false'
      OR json_type({source}, '{path}') IN ('BIGINT', 'UBIGINT', 'DOUBLE') AND TRY_CAST({value} AS DOUBLE) = 0"""
    return f"CASE WHEN {nothing} THEN '' ELSE coalesce({value}, '') END"


def text_at(path: str, source: str = "j") -> str:
    return f"trim({meant(path, source)})"


def object_names(root: str, source: str = "j") -> str:
    entries = f"""CASE json_type({source}, '{root}')
      WHEN 'OBJECT' THEN list_transform(json_keys({source}, '{root}'),
        lambda k: json_extract_string({source}, '{root}."' || k || '".contact.name'))
      WHEN 'ARRAY' THEN list_transform(json_extract({source}, '{root}[*]'), lambda e: json_extract_string(e, '$.contact.name'))
      ELSE NULL END"""
    return ordered_names(entries)


def event_date(root: str, action: str, date: str) -> str:
    ends = f"""list_filter(json_extract(j, '{root}[*]'),
      lambda e: lower(json_extract_string(e, '$.{action}')) = 'expiration')"""
    return f"trim(coalesce(json_extract_string({ends}[1], '$.{date}'), ''))"


def rdap_sql(source: str) -> str:
    return f"""SELECT key,
      coalesce(nullif({text_at('$.asn_country_code')}, ''), {text_at('$.network.country')}) AS country,
      {text_at('$.asn')} AS asn, {text_at('$.asn_description')} AS asn_descr,
      {object_names('$.objects')} AS contacts, {event_date('$.network.events', 'action', 'timestamp')} AS expires
    FROM {readable(source)}"""


CARD_NAME = "list_filter(json_extract({0}, '$.vcardArray[1][*]'), lambda p: json_extract_string(p, '$[0]') = 'fn')[1]"


def card_name(entity: str) -> str:
    return f"json_extract_string({CARD_NAME.format(entity)}, '$[3]')"


WALK = f"""walk AS (
  WITH RECURSIVE nodes AS (
    SELECT key, [i] AS place, json_extract(j, '$.data.entities[' || (i - 1) || ']') AS node
    FROM {readable('rdap_aggregator_raw')}, generate_series(1, CAST(json_array_length(j, '$.data.entities') AS BIGINT)) AS s(i)
    UNION ALL
    SELECT key, list_append(place, i), json_extract(node, '$.entities[' || (i - 1) || ']')
    FROM nodes, generate_series(1, CAST(json_array_length(node, '$.entities') AS BIGINT)) AS s(i)
  ) SELECT key, list({card_name('node')} ORDER BY place) AS names FROM nodes GROUP BY key)"""
AGGREGATOR = f"""aggregator AS (SELECT key, CASE WHEN ok THEN {text_at('$.data.country')} ELSE '' END AS country,
  '' AS asn, '' AS asn_descr, CASE WHEN ok THEN {ordered_names('names')} ELSE '' END AS contacts,
  CASE WHEN ok THEN {event_date('$.data.events', 'eventAction', 'eventDate')} ELSE '' END AS expires
  FROM (SELECT *, json_extract_string(j, '$.success') = 'true' AS ok FROM {readable('rdap_aggregator_raw')}) LEFT JOIN walk USING (key))"""
NET_LINES = f"""list_transform(json_extract(j, '$.nets[*]'), lambda n: trim(split_part(trim(coalesce(
  nullif({meant('$.description', 'n')}, ''), {meant('$.name', 'n')})), chr(10), 1)))"""
WHOIS = f"""whois AS (SELECT key, {text_at('$.nets[0].country')} AS country, {text_at('$.asn')} AS asn,
  {text_at('$.asn_description')} AS asn_descr, {ordered_names(NET_LINES)} AS contacts, '' AS expires
  FROM {readable('whois_raw')})"""
RDAP = f"rdap AS ({rdap_sql('rdap_raw')})"
BOOTSTRAP = f"bootstrap AS ({rdap_sql('rdap_bootstrap_raw')})"

ORACLES["rdap_extract"] = over(["rdap_raw"], "SELECT * FROM rdap", RDAP)
ORACLES["rdap_contacts"] = over(["rdap_raw"], "SELECT key, contacts FROM rdap", RDAP)
ORACLES["rdap_expires"] = over(["rdap_raw"], "SELECT key, expires FROM rdap", RDAP)
ORACLES["rdapss_extract"] = over(["rdap_aggregator_raw"], "SELECT * FROM aggregator", WALK, AGGREGATOR)
ORACLES["vcard_fn"] = over(
    ["rdap_aggregator_raw"],
    f"""SELECT key, CAST(i AS INTEGER) AS place, {card_name("json_extract(j, '$.data.entities[' || i || ']')")} AS name
    FROM {readable('rdap_aggregator_raw')}, generate_series(0, CAST(json_array_length(j, '$.data.entities') AS BIGINT) - 1) AS s(i)""",
)
ORACLES["rdap_entities"] = over(
    ["rdap_aggregator_raw"], f"SELECT key, {ordered_names('names')} AS contacts FROM walk", WALK
)
ORACLES["whois_extract"] = over(["whois_raw"], "SELECT * FROM whois", WHOIS)

# -- domain WHOIS ------------------------------------------------------------------

ORACLES["tci_domain_keys"] = over(
    ["domains"],
    "SELECT custkey, regexp_matches(rtrim(lower(trim(domain)), '.'), '[.](ru|su|рф|дети|tatar|xn--p1ai|xn--d1acj3b)$') AS served FROM domains",
)
# After the digits punycode writes the same letters, whatever the digits are.
ENDINGS = [f"магазин{'1' * n}".encode("idna").decode().removeprefix("xn--" + "1" * n) for n in range(1, 13)]
ORACLES["domain_ascii"] = over(
    ["domains"],
    f"""SELECT custkey, domain, CASE WHEN domain LIKE 'магазин%' THEN 'xn--' || custkey
      || [{listed(ENDINGS)}][length(CAST(custkey AS VARCHAR))] || '.xn--p1ai' ELSE lower(trim(domain)) END AS query FROM domains""",
)
TEXT_LINES = """list_filter(list_transform(string_split_regex(json, '\\r\\n|\\n'), lambda l: trim(l)),
  lambda l: l NOT LIKE '[%]%' AND NOT starts_with(l, '%') AND contains(l, ':'))"""
FIELDS = f"""fields AS (SELECT key, list_filter(list_transform({TEXT_LINES}, lambda l: {{
    'f': lower(trim(split_part(l, ':', 1))), 'v': trim(substr(l, position(':' IN l) + 1))}}), lambda p: p.v <> '') AS pairs
  FROM domain_raw)"""


def values_of(name: str) -> str:
    return f"list_transform(list_filter(pairs, lambda p: p.f = '{name}'), lambda p: p.v)"


CONTACT_FIELDS = f"list_concat({values_of('org')}, list_concat({values_of('registrar')}, {values_of('nserver')}))"
DOMAIN = f"""domain_found AS (SELECT key, '' AS country, '' AS asn, '' AS asn_descr,
  {ordered_names(CONTACT_FIELDS)} AS contacts, coalesce({values_of('paid-till')}[1], '') AS expires FROM fields)"""
ORACLES["tci_extract"] = over(["domain_raw"], "SELECT * FROM domain_found", FIELDS, DOMAIN)

# -- lookup service ----------------------------------------------------------------

ORACLES["service_extract"] = over(
    ["hosts", "service_location_raw", "service_registration_raw"],
    f"""SELECT h.key, coalesce(json_extract_string(l.j, '$.country.name'), '') AS country,
      {meant('$.ip_whois.asn', 'r.j')} AS asn,
      {meant('$.ip_whois.asn_description', 'r.j')} AS asn_descr,
      {object_names('$.ip_whois.objects', 'r.j')} AS contacts
    FROM hosts h LEFT JOIN {readable('service_location_raw')} l USING (key)
      LEFT JOIN {readable('service_registration_raw')} r USING (key)""",
)

# -- cascades ----------------------------------------------------------------------

FIELD_NAMES = [*COLUMNS, "expires"]


def any_of(alias: str) -> str:
    return "(" + " OR ".join(f"coalesce({alias}.{name}, '') <> ''" for name in FIELD_NAMES) + ")"


def pick(aliases: list[str]) -> str:
    """Every field from the first alias with anything in it."""

    def field(name: str) -> str:
        cases = " ".join(f"WHEN {any_of(alias)} THEN {alias}.{name}" for alias in aliases)
        return f"coalesce(CASE {cases} END, '') AS {name}"

    return ", ".join(field(name) for name in FIELD_NAMES)


CASCADE_VIEWS = ["rdap_raw", "rdap_aggregator_raw", "rdap_bootstrap_raw"]
CASCADE_CTES = [RDAP, WALK, AGGREGATOR, BOOTSTRAP]


def cascade(keys: str) -> str:
    return f"""SELECT k.key, {pick(['p', 'a', 'b'])} FROM {keys} k LEFT JOIN rdap p USING (key)
      LEFT JOIN aggregator a USING (key) LEFT JOIN bootstrap b USING (key)"""


ORACLES["whois_cascade"] = over(
    ["domains", "hosts", "whois_raw", "domain_raw"],
    f"""SELECT k.key, {pick(['w', 'd'])} FROM (SELECT domain AS key FROM domains UNION ALL SELECT key FROM hosts) k
      LEFT JOIN whois w USING (key) LEFT JOIN domain_found d ON d.key = rtrim(lower(trim(k.key)), '.')""",
    WHOIS,
    FIELDS,
    DOMAIN,
)
ORACLES["rdap_cascade"] = over(["hosts", *CASCADE_VIEWS], cascade("hosts"), *CASCADE_CTES)
ORACLES["cache_write"] = over(
    ["hosts", *CASCADE_VIEWS],
    f"""SELECT 'rdap:v1:' || key AS key, country, asn, asn_descr, contacts,
      {EXPIRY.format("CASE WHEN expires <> '' THEN strptime(expires, '%Y-%m-%d') END")} AS expires_at
    FROM ({cascade('hosts')}) WHERE country || asn || asn_descr || contacts <> ''""",
    *CASCADE_CTES,
)

BLOCKS = f"""blocks AS (SELECT country, CAST(split_part(network, '/', 2) AS BIGINT) AS length,
    base - base % CAST(pow(2, 32 - CAST(split_part(network, '/', 2) AS BIGINT)) AS BIGINT) AS low,
    CAST(pow(2, 32 - CAST(split_part(network, '/', 2) AS BIGINT)) AS BIGINT) AS size
  FROM (SELECT *, {number("split_part(network, '/', 1)")} AS base FROM geo_blocks))"""


def geo(keys: str) -> str:
    return f"""SELECT key, max_by(country, length) AS country
      FROM (SELECT key, {number('key')} AS ip FROM {keys} WHERE {valid('key')}) JOIN blocks ON ip >= low AND ip < low + size
      GROUP BY key"""


DESTINATIONS = "(SELECT DISTINCT trim(DstIP) AS key FROM connections WHERE trim(DstIP) <> '')"
ORACLES["geo_lookup"] = over(
    ["connections", "geo_blocks"],
    f"SELECT key, coalesce(country, '') AS country FROM {DESTINATIONS} LEFT JOIN ({geo(DESTINATIONS)}) USING (key)",
    BLOCKS,
)

DEFAULT_VIEWS = [*CASCADE_VIEWS, "whois_raw", "geo_blocks"]
DEFAULT_CTES = [*CASCADE_CTES, WHOIS, BLOCKS]


def default_chain(keys: str) -> str:
    """Geo, then registry, then WHOIS; WHOIS only where a column is still empty."""
    merged = ", ".join(
        f"coalesce(nullif(g.{n}, ''), nullif(r.{n}, ''), nullif(w.{n}, ''), '') AS {n}"
        if n == "country"
        else f"coalesce(nullif(r.{n}, ''), nullif(w.{n}, ''), '') AS {n}"
        for n in FIELD_NAMES
    )
    return f"""SELECT k.key, {merged} FROM {keys} k LEFT JOIN ({geo(keys)}) g USING (key)
      LEFT JOIN ({cascade(keys)}) r USING (key) LEFT JOIN whois w USING (key)"""


ORACLES["resolve_default"] = over(["hosts", *DEFAULT_VIEWS], default_chain("hosts"), *DEFAULT_CTES)

# -- resolve -----------------------------------------------------------------------

ENRICHED = "(" + " AND ".join(f"trim({name}) <> ''" for name in COLUMNS) + ")"
PENDING_KEYS = f"""SELECT trim(DstIP) AS key, count(*) AS key_rows FROM half_enriched
  WHERE NOT {ENRICHED} AND trim(DstIP) <> '' GROUP BY 1"""
LIVE = f"""live AS (SELECT substr(key, 12) AS key, country, asn, asn_descr, contacts FROM resolve_cache
  WHERE starts_with(key, 'default:v1:') AND expires_at > {NOW})"""


def joined_back(answers: str) -> str:
    fields = ", ".join(
        f"CASE WHEN NOT {ENRICHED.replace('trim(', 'trim(t.')} AND trim(t.DstIP) <> '' THEN coalesce(a.{n}, '') ELSE t.{n} END AS {n}"
        for n in COLUMNS
    )
    return f"SELECT event_id, DstIP, {fields} FROM half_enriched t LEFT JOIN {answers} a ON a.key = trim(t.DstIP)"


ORACLES["resolve_keys"] = over(["half_enriched"], PENDING_KEYS)
ORACLES["resolve_pending"] = over(["half_enriched"], f"SELECT event_id, NOT {ENRICHED} AS pending FROM half_enriched")
ORACLES["resolve_join"] = over(
    ["half_enriched", "owners"],
    joined_back("(SELECT key, n_name AS country, '' AS asn, CASE WHEN key IS NULL THEN '' ELSE 'D' END AS asn_descr, c_name AS contacts FROM owners)"),
)
ORACLES["cache_hits"] = over(
    ["hosts", "resolve_cache"], "SELECT key, country, asn, asn_descr, contacts FROM hosts JOIN live USING (key)", LIVE
)
ORACLES["cache_misses"] = over(
    ["hosts", "resolve_cache"], "SELECT key FROM hosts WHERE key NOT IN (SELECT key FROM live)", LIVE
)
ORACLES["resolve_counters"] = over(
    ["half_enriched", "resolve_cache"],
    """SELECT (SELECT count(*) FROM half_enriched) AS total_rows, CAST(sum(key_rows) AS BIGINT) AS pending_rows,
      count(*) AS unique_keys, count(live.key) AS cache_hits, count(*) - count(live.key) AS cache_misses
    FROM asked LEFT JOIN live USING (key)""",
    LIVE,
    f"asked AS ({PENDING_KEYS})",
)
ORACLES["cache_upsert"] = over(
    ["owners", "resolve_cache"],
    f"""SELECT * FROM fresh UNION ALL SELECT * FROM resolve_cache
    WHERE key NOT IN (SELECT key FROM fresh) AND expires_at > {NOW}""",
    """fresh AS (SELECT 'default:v1:' || key AS key, 'New' AS country, '' AS asn, '' AS asn_descr, '' AS contacts,
      TIMESTAMP '2024-05-06 00:00:00' AS expires_at FROM owners WHERE c_mktsegment <> 'FURNITURE')""",
)
ASKED = f"asked AS ({PENDING_KEYS})"
MISSED = "missed AS (SELECT key FROM asked WHERE key NOT IN (SELECT key FROM live))"
ORACLES["resolve"] = over(
    ["half_enriched", "resolve_cache", *DEFAULT_VIEWS],
    joined_back(
        f"(SELECT * FROM live UNION ALL SELECT key, country, asn, asn_descr, contacts FROM ({default_chain('missed')}))"
    ),
    LIVE,
    ASKED,
    MISSED,
    *DEFAULT_CTES,
)
ORACLES["resolve_twice"] = over(
    ["half_enriched", *DEFAULT_VIEWS], joined_back(f"({default_chain('asked')})"), ASKED, *DEFAULT_CTES
)

# -- pipelines and diagnosis -------------------------------------------------------

PIPELINE_ROWS = f"""(SELECT * FROM connections WHERE timestamp >= {NOW} - INTERVAL 20 DAY AND timestamp < {NOW}
  AND SrcIP <> '' AND DstIP <> '' AND {PUBLIC})"""
PIPELINE = counted(PIPELINE_ROWS, GROUP, "HAVING count(*) >= 2")
ORACLES["pipeline_flagship"] = logs(PIPELINE)
ORACLES["pipeline_resolved"] = over(
    ["connections", *DEFAULT_VIEWS],
    f"SELECT groups.*, {filled(COLUMNS)} FROM groups LEFT JOIN ({default_chain('wanted')}) a ON a.key = DstIP",
    f"groups AS ({PIPELINE})",
    "wanted AS (SELECT DISTINCT DstIP AS key FROM groups)",
    *DEFAULT_CTES,
)
ON_SOURCE = "(SrcIP LIKE '10.2.82.%' OR SrcIP LIKE '10.2.83.%' OR " + LISTED + ")"
LAYERS = [
    ("all", "true"),
    ("full", f"{IN_RANGE} AND SrcIP IS NOT NULL AND DstIP IS NOT NULL AND streams = 's1' AND {ON_SOURCE}"),
    ("without source filter", f"{IN_RANGE} AND SrcIP IS NOT NULL AND DstIP IS NOT NULL AND streams = 's1'"),
    ("without stream filter", f"{IN_RANGE} AND SrcIP IS NOT NULL AND DstIP IS NOT NULL"),
    ("time range only", IN_RANGE),
    ("stream only", "streams = 's1'"),
]
ORACLES["diag_ladder"] = logs(
    " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS layer, '{name}' AS clauses, count(*) FILTER (WHERE {test}) AS rows FROM connections"
        for i, (name, test) in enumerate(LAYERS)
    )
)
ORACLES["diag_fields"] = logs(
    " UNION ALL ".join(
        f"SELECT '{name}' AS field, true AS present, count({name}) AS rows FROM connections"
        for name in ("timestamp", "SrcIP", "DstIP", "streams")
    )
    + " UNION ALL SELECT 'dst_ip', false, 0"
)
ORACLES["diag_newest"] = "SELECT max(ts) AS newest FROM events"

# -- row functions and counters of a run --------------------------------------------------

ORACLES["resolve_function"] = over(
    ["hosts"],
    f"""SELECT key, country, asn, asn_descr, '' AS contacts, error,
      CASE WHEN country <> '' THEN CASE WHEN third % 2 = 1 THEN {NOW} + INTERVAL 16 DAY ELSE TIMESTAMP '2024-02-01' END END AS expires_at
    FROM (SELECT key, third,
        CASE WHEN silent THEN '' ELSE 'C' || second END AS country,
        CASE WHEN silent THEN '' ELSE CAST(second * 256 + third AS VARCHAR) END AS asn,
        CASE WHEN silent OR last % 32 <> 0 THEN '' ELSE 'net ' || first || '.' || second END AS asn_descr,
        CASE WHEN last % 48 = 0 THEN 'ConnectionError: no route to ' || key END AS error FROM parts)""",
    """parts AS (SELECT key, o[1] AS first, o[2] AS second, o[3] AS third, o[4] AS last, o[4] % 48 = 0 OR o[4] % 80 = 16 AS silent
      FROM (SELECT key, list_transform(string_split(key, '.'), lambda x: CAST(x AS INT)) AS o FROM hosts))""",
)
SEEN_ROWS = f"""(SELECT * FROM connections WHERE timestamp >= {NOW} - INTERVAL 20 DAY AND timestamp < {NOW} - INTERVAL 2 DAY
  AND SrcIP <> '' AND DstIP <> '' AND {PUBLIC})"""
ORACLES["pipeline_counters"] = over(
    ["connections", "resolve_cache"],
    """SELECT 'collect' AS step, 'rows' AS counter, count(*) AS value FROM seen
    UNION ALL SELECT 'collect', 'window' || k, (SELECT count(*) FROM seen WHERE number = k) FROM range(2, 20) AS r(k)
    UNION ALL SELECT 'aggregate', 'groups_kept', count(*) FROM groups WHERE n >= 2
    UNION ALL SELECT 'aggregate', 'groups_dropped', count(*) FROM groups WHERE n < 2
    UNION ALL SELECT 'aggregate', 'rows_kept', CAST(coalesce(sum(n), 0) AS BIGINT) FROM groups WHERE n >= 2
    UNION ALL SELECT 'aggregate', 'rows_dropped', CAST(coalesce(sum(n), 0) AS BIGINT) FROM groups WHERE n < 2
    UNION ALL SELECT 'resolve', 'keys', count(*) FROM asked
    UNION ALL SELECT 'resolve', 'key_rows', CAST(coalesce(sum(rows), 0) AS BIGINT) FROM asked
    UNION ALL SELECT 'resolve', 'hits', count(live.key) FROM asked LEFT JOIN live USING (key)
    UNION ALL SELECT 'resolve', 'misses', count(*) - count(live.key) FROM asked LEFT JOIN live USING (key)
    UNION ALL SELECT 'resolve', 'failed', 0""",
    LIVE,
    f"""seen AS (SELECT *, (date_diff('microsecond', timestamp, {NOW}) - 1) // 86400000000 AS number FROM {SEEN_ROWS})""",
    f"groups AS (SELECT {', '.join(GROUP)}, count(*) AS n FROM seen GROUP BY ALL)",
    "asked AS (SELECT DstIP AS key, count(*) AS rows FROM groups WHERE n >= 2 GROUP BY 1)",
)

# -- labels on a stream ------------------------------------------------------------------------

ORACLES["stream_label"] = ORACLES["subnet_label_table"]

# -- a cache laid out by key ---------------------------------------------------------------------

ORACLES["cache_buckets"] = over(
    ["hosts", "resolve_cache"],
    """SELECT layout, key, country, asn, asn_descr, contacts FROM hosts JOIN newest USING (key),
      (VALUES ('versions'), ('compacted')) AS l(layout)""",
    f"""newest AS (SELECT substr(key, 12) AS key, CASE WHEN asn > '2' THEN 'Later' ELSE country END AS country, asn, asn_descr, contacts
      FROM resolve_cache WHERE starts_with(key, 'default:v1:') AND (asn > '2' OR expires_at > {NOW}))""",
)
