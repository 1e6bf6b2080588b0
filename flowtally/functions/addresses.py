"""IPv4 expressions.

An address test is one anchored pattern over the text, so a filter stays one small
expression however many networks it names, and stays inside whole-stage code
generation. The number of an address is only needed where addresses are joined.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowtally.functions.networks import Network, ipv4_only, parse_networks
from flowtally.functions.text import clean

OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4 = rf"\A{OCTET}(?:\.{OCTET}){{3}}\z"

# Blocks that are not globally reachable, and the addresses in them that are.
PRIVATE_NETWORKS = [
    "0.0.0.0/8",
    "10.0.0.0/8",
    "127.0.0.0/8",
    "169.254.0.0/16",
    "172.16.0.0/12",
    "192.0.0.0/24",
    "192.0.0.170/31",
    "192.0.2.0/24",
    "192.168.0.0/16",
    "198.18.0.0/15",
    "198.51.100.0/24",
    "203.0.113.0/24",
    "240.0.0.0/4",
    "255.255.255.255/32",
]
PRIVATE_EXCEPTIONS = ["192.0.0.9/32", "192.0.0.10/32"]

OTHER_LABEL = "other"


def network_pattern(network: Network) -> str:
    """Exactly the well-formed addresses of an IPv4 network: octets the prefix fixes are
    literal, the one it cuts is a choice, the others are free."""
    octets = []
    for shift in (24, 16, 8, 0):
        low, high = network.low >> shift & 255, network.high >> shift & 255
        if (low, high) == (0, 255):
            octets.append(OCTET)
        else:
            octets.append("(?:" + "|".join(map(str, range(low, high + 1))) + ")")
    return r"\.".join(octets)


def is_ipv4(text: Column) -> Column:
    """Four decimal octets without leading zeros, spaces or a trailing newline."""
    return F.coalesce(text.rlike(IPV4), F.lit(False))


def ipv4_number(text: Column) -> Column:
    """The address as 0 … 2³²-1, NULL where it is not an IPv4 address."""
    octet = [F.split_part(text, F.lit("."), F.lit(i)).try_cast("bigint") for i in range(1, 5)]
    number = ((octet[0] * 256 + octet[1]) * 256 + octet[2]) * 256 + octet[3]
    return F.when(is_ipv4(text), number)


def in_networks(text: Column, networks: Sequence[Network]) -> Column:
    """A well-formed address inside any network; for the lists of a configuration."""
    patterns = [network_pattern(net) for net in ipv4_only(networks)]
    if not patterns:
        return F.lit(False)
    return F.coalesce(text.rlike(rf"\A(?:{'|'.join(patterns)})\z"), F.lit(False))


def starts_in_networks(text: Column, networks: Sequence[Network]) -> Column:
    """Coarse test implied by membership: the text starts with the octets a network fixes."""
    prefixes = dict.fromkeys(net.octets for net in ipv4_only(networks))
    if not prefixes:
        return F.lit(False)
    choice = "|".join(prefix.replace(".", r"\.") for prefix in prefixes)
    return F.coalesce(text.rlike(rf"\A(?:{choice})"), F.lit(False))


def starts_between(text: Column, prefixes: Sequence[str]) -> Column:
    """Implied by starting with, or being, one of the prefixes: one range of texts, which
    reaches the scan whatever their number. A colon sorts behind all that addresses hold."""
    return (text >= min(prefixes)) & (text < max(prefix + ":" for prefix in prefixes))


def is_private(text: Column) -> Column:
    """An address that is not globally reachable; False for anything else."""
    return in_networks(text, parse_networks(PRIVATE_NETWORKS)) & ~in_networks(
        text, parse_networks(PRIVATE_EXCEPTIONS)
    )


def subnet_label(text: Column, networks: Sequence[Network]) -> Column:
    """Label of the first listed network holding the address, else ``other``. White
    space around the address does not count."""
    listed = [{"low": net.low, "high": net.high, "label": net.label} for net in ipv4_only(networks)]
    # One constant, so that the expression is as flat for thousands of networks as for one.
    table = F.from_json(F.lit(json.dumps(listed)), "array<struct<low: bigint, high: bigint, label: string>>")
    number = F.array(ipv4_number(clean(text)))
    first = F.transform(
        number, lambda n: F.get(F.filter(table, lambda net: (n >= net["low"]) & (n <= net["high"])), F.lit(0))["label"]
    )
    return F.coalesce(F.get(first, F.lit(0)), F.lit(OTHER_LABEL))
