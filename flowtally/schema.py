"""Column vocabulary shared by every operator. All data columns are strings."""

from __future__ import annotations

# Names, order and version are part of the data contract.
COLLECT_COLUMNS = [
    "timestamp",
    "SrcIP",
    "DstIP",
    "DstPort",
    "ac_action",
    "ac_rule_name",
    "url_domain",
    "url_path",
]
DROP_COLUMNS = ["timestamp", "SrcPort", "source", "message"]
GROUP_COLUMNS = ["SrcIP", "DstIP", "DstPort", "ac_action", "url_domain", "ac_rule_name"]
# The last two only break ties, so that the order is total.
ORDER_COLUMNS = ["ac_action", "SrcIP", "DstIP", "DstPort", "url_domain", "ac_rule_name"]
RESOLVE_COLUMNS = ["country", "asn", "asn_descr", "contacts"]
RESOLVE_VERSION = "v1"
DEFAULT_KEY_COLUMN = "DstIP"

# What a resolver answers for one key: the four columns and a hint for the cache.
ANSWER_FIELDS = RESOLVE_COLUMNS + ["expires"]
ANSWER_TYPE = "struct<" + ",".join(f"{name}:string" for name in ANSWER_FIELDS) + ">"

CACHE_SCHEMA = (
    "key string, country string, asn string, asn_descr string, contacts string, expires_at timestamp"
)

# Fields of a landed log document besides the collected ones.
LOG_EXTRA_FIELDS = ["SrcPort", "source", "message"]
STREAM_FIELD = "streams"


def present(columns: list[str], wanted: list[str]) -> list[str]:
    """The wanted names that exist, in wanted order (names are case-sensitive)."""
    have = set(columns)
    return [name for name in wanted if name in have]
