"""The results of some operators as plain SQL for DuckDB, over the same tables.

Fingerprints (XXH64), compression, trained models and quotation trees have no SQL form;
their queries are tested against brute force instead.
"""

from __future__ import annotations

from flowtally.llm import decontaminate, lexical, linededup, mixing, sharding, suffixdedup

ORACLES: dict[str, str] = {}

# -- mixing: the whole schedule by recursion, a slot at a time --------------------------------

ORACLES["op1_mixing"] = f"""
WITH RECURSIVE keyed AS (SELECT doc_id, text, source, coalesce('=' || source, 'missing') AS src FROM documents),
numbered AS (SELECT *, row_number() OVER (PARTITION BY src
    ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), md5(coalesce(text, ''))) - 1 AS number FROM keyed),
counts AS (SELECT src, count(*) AS total FROM keyed GROUP BY src),
parts AS (SELECT src, CAST(row_number() OVER (ORDER BY src) AS BIGINT) AS i, (total + {mixing.BLOCK - 1}) // {mixing.BLOCK} AS blocks,
    greatest(CAST(round(pow(total, {mixing.TEMPERATURE}) / sum(pow(total, {mixing.TEMPERATURE})) OVER () * {mixing.PARTS}) AS BIGINT), 1) AS parts
  FROM counts),
whole AS (SELECT CAST(sum(parts) AS HUGEINT) AS slots, list(CAST(parts AS HUGEINT) ORDER BY i) AS p FROM parts),
latest AS (SELECT max((blocks * slots + parts - 1) // parts) AS latest FROM parts, whole),
edf AS (
  SELECT CAST(-1 AS BIGINT) AS slot, list_transform(p, lambda x: CAST(0 AS BIGINT)) AS given, CAST(NULL AS BIGINT) AS i, CAST(NULL AS BIGINT) AS turn,
    slots, p FROM whole
  UNION ALL
  SELECT slot, list_transform(range(1, len(p) + 1), lambda k: given[k] + CAST(k = i AS BIGINT)), i, given[i], slots, p
  FROM (SELECT slot + 1 AS slot, given, slots, p, list_min(list_transform(
      list_filter(range(1, len(p) + 1), lambda k: given[k] * slots // p[k] <= slot + 1),
      lambda k: {{'d': ((given[k] + 1) * slots + p[k] - 1) // p[k], 'k': k}})).k AS i
    FROM edf, latest WHERE slot + 1 < latest)
),
turns AS (SELECT src, blocks, turn, slot FROM edf JOIN parts USING (i)),
length AS (SELECT max(slot) + 1 AS length FROM turns WHERE turn = blocks - 1),
places AS (SELECT src, slot, turn // blocks AS epoch, turn % blocks AS block FROM turns, length WHERE slot < length)
SELECT doc_id, source, epoch, block, slot, slot * {mixing.BLOCK} + number % {mixing.BLOCK} AS position
FROM places JOIN numbered ON numbered.src = places.src AND number // {mixing.BLOCK} = block"""

# -- line spread -----------------------------------------------------------------------------


def _normal(line: str) -> str:
    return f"trim(regexp_replace({line}, '[ \\t\\r]+', ' ', 'g'), ' ')"


ORACLES["op3_linededup"] = f"""
WITH lines AS (SELECT source, unnest(string_split(text, chr(10))) AS line FROM documents),
boilerplate AS (SELECT {_normal('line')} AS line FROM lines GROUP BY 1
  HAVING {_normal('line')} <> '' AND count(DISTINCT source) >= {linededup.MIN_SITES}),
bad AS (SELECT coalesce(list(line), []) AS bad FROM boilerplate),
kept AS (SELECT doc_id, string_split(text, chr(10)) AS every,
    list_filter(string_split(text, chr(10)), lambda x: NOT list_contains(bad, {_normal('x')})) AS rest FROM documents, bad)
SELECT doc_id, coalesce(len(every), 0) AS n_lines, coalesce(len(every) - len(rest), 0) AS n_removed,
  length(array_to_string(rest, chr(10))) AS n_chars, md5(array_to_string(rest, chr(10))) AS clean_md5 FROM kept"""

# -- repeated passages: every string of 50 bytes ----------------------------------------------

_N = suffixdedup.LENGTH
ORACLES["op4_suffixdedup"] = f"""
WITH bytes AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
strings AS (SELECT r, doc_id, x.k AS k, x.s AS s FROM (SELECT r, doc_id, unnest(list_transform(
    range(0, octet_length(b) - {_N - 1}), lambda k: {{'k': k, 's': array_slice(b, k + 1, k + {_N})}})) AS x FROM bytes)),
again AS (SELECT r, k FROM (SELECT r, k, doc_id, min(doc_id) OVER (PARTITION BY s) AS first FROM strings) WHERE first < doc_id),
runs AS (SELECT r, min(k) AS low, max(k) + {_N} AS high FROM (
    SELECT r, k, sum(new) OVER (PARTITION BY r ORDER BY k) AS run FROM (
      SELECT r, k, CAST(k > coalesce(lag(k) OVER (PARTITION BY r ORDER BY k), -{_N + 1}) + {_N} AS INT) AS new FROM again))
  GROUP BY r, run),
spans AS (SELECT r, list({{'low': low, 'high': high}} ORDER BY low) AS spans, sum(high - low) AS n_removed, count(*) AS n_spans FROM runs GROUP BY r),
ends AS (SELECT r, doc_id, b, octet_length(b) AS n, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    list_concat([0], coalesce(list_transform(spans, lambda x: x.high), [])) AS starts,
    list_concat(coalesce(list_transform(spans, lambda x: x.low), []), [octet_length(b)]) AS stops
  FROM bytes LEFT JOIN spans USING (r))
SELECT doc_id, n AS n_bytes, CAST(n_removed AS BIGINT) AS n_removed, CAST(n_spans AS BIGINT) AS n_spans,
  sha256(unhex(array_to_string(list_transform(range(1, len(starts) + 1),
    lambda i: CASE WHEN stops[i] > starts[i] THEN hex(array_slice(b, starts[i] + 1, stops[i])) ELSE '' END), ''))) AS kept_sha256 FROM ends"""

# -- decontamination: windows as joined words ---------------------------------------------------

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + ", '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
ORACLES["op6_decontaminate"] = f"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
windows AS (SELECT DISTINCT item, n, s FROM (SELECT item, least({decontaminate.WINDOW}, len(w)) AS n, unnest(list_transform(
    range(0, len(w) - least({decontaminate.WINDOW}, len(w)) + 1),
    lambda k: array_to_string(w[k + 1 : k + least({decontaminate.WINDOW}, len(w))], ' '))) AS s FROM items WHERE len(w) > 0)),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
found AS (SELECT r, k, n, item FROM (SELECT r, n, x.k AS k, x.s AS s FROM (
    SELECT r, n, unnest(list_transform(range(0, len(w) - n + 1), lambda k: {{'k': k, 's': array_to_string(w[k + 1 : k + n], ' ')}})) AS x
    FROM docs, (SELECT DISTINCT n FROM windows))) JOIN windows USING (n, s)),
hits AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS place FROM found) GROUP BY r),
owners AS (SELECT r, list(DISTINCT item ORDER BY item) AS items FROM found GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(items), 0) AS n_items,
  sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN owners USING (r)"""

# -- sharding: all draws of each level, the smallest wins -----------------------------------------


def _crc_table() -> list[int]:
    table = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    return table


_ALL_ONES = 0xFFFFFFFF
_CRC = f"""xor(CAST({_ALL_ONES} AS BIGINT), list_reduce(list_prepend(CAST({_ALL_ONES} AS BIGINT),
    list_transform(range(0, length(h) // 2), lambda k: CAST('0x' || substr(h, 2 * k + 1, 2) AS BIGINT))),
    lambda c, b: xor(c >> 8, crc[xor(c & 255, b) + 1])))"""


def _descent(name: str, leaves: list[sharding.Leaf]) -> str:
    """CTEs ``name`` with the shard of each key."""
    rows = ", ".join(f"('{region}', '{rack}', 'shard{shard}', {weight})" for region, rack, shard, weight in leaves)
    draw = "-ln((CAST(CAST('0x' || substr(md5(key || '/' || {0}), 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0) / w"

    def level(made: str, child: str, source: str, on: str) -> str:
        kept = ", ".join(c for c in ("key", "region", "rack") if c in source.split("|")[1].split(","))
        return f"""{name}_{made} AS (SELECT {kept}, arg_min(child, draw) AS {made} FROM (
            SELECT {kept}, child, {draw.format('child')} AS draw FROM {source.split('|')[0]}
            JOIN (SELECT {on or "1 AS one"}, {child} AS child, sum(weight) AS w FROM {name}_tree GROUP BY ALL) t {"USING (" + on + ")" if on else "ON true"})
          GROUP BY ALL)"""

    return ", ".join(
        [
            f"{name}_tree(region, rack, shard, weight) AS (VALUES {rows})",
            level("region", "region", "keys|key", ""),
            level("rack", "rack", f"{name}_region|key,region", "region"),
            level("shard", "shard", f"{name}_rack|key,rack", "rack"),
        ]
    )


ORACLES["op9_sharding"] = f"""
WITH table_of AS (SELECT {_crc_table()} AS crc),
rows AS (SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), 'null') AS key, hex(encode(coalesce(text, ''))) AS h FROM documents),
sized AS (SELECT doc_id, key, CAST(length(h) // 2 + {sharding.OVERHEAD} AS BIGINT) AS size, {_CRC} AS text_crc32 FROM rows, table_of),
keys AS (SELECT DISTINCT key FROM rows),
{_descent("now", sharding.tree())}, {_descent("more", sharding.grown(sharding.tree()))},
placed AS (SELECT sized.*, CAST(substr(n.shard, 6) AS INT) AS shard, CAST(substr(m.shard, 6) AS INT) AS grown_shard
  FROM sized JOIN now_shard n USING (key) JOIN more_shard m USING (key))
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY md5(key), text_crc32, size) - 1 AS slot, grown_shard FROM placed"""

# -- ranked lexical search: every document that shares a term with an item is scored -----------------

_TERMS = "regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + ", '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
ORACLES["op13_search"] = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
totals AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM docs WHERE len(w) > 0),
items AS (SELECT row_number() OVER () AS q, item_id, {_TERMS} AS w FROM benchmark),
wanted AS (SELECT q, term, count(*) AS repeats FROM (SELECT q, unnest(w) AS term FROM items) GROUP BY q, term),
postings AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM docs)
  WHERE term IN (SELECT term FROM wanted) GROUP BY r, term),
weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS weight
  FROM postings, totals GROUP BY term, n_docs),
sizes AS (SELECT r, doc_id, 100 - 75 + (75 * len(w) * n_docs) // n_terms AS m FROM docs, totals WHERE len(w) > 0),
scores AS (SELECT q, r, CAST(sum(repeats * weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM wanted JOIN postings USING (term) JOIN weights USING (term) JOIN sizes USING (r) GROUP BY q, r),
ranked AS (SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS FIRST) AS rank
  FROM scores JOIN sizes USING (r) WHERE score > 0)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM ranked JOIN items USING (q) WHERE rank <= {lexical.TOP}"""
