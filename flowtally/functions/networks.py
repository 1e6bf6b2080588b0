"""Network lists from the configuration (driver side, small)."""

from __future__ import annotations

import ipaddress
from collections.abc import Iterable
from dataclasses import dataclass


@dataclass(frozen=True)
class Network:
    text: str
    version: int
    low: int
    high: int
    length: int

    @property
    def label(self) -> str:
        """File-name safe: ``10.2.83.0/24`` becomes ``10.2.83.0-24``."""
        return self.text.replace("/", "-")

    @property
    def octets(self) -> str:
        """Longest dotted prefix that every address of the network starts with."""
        whole = self.length // 8
        if whole == 4:
            return self.text.split("/")[0]
        return "".join(part + "." for part in self.text.split(".")[:whole])


def parse_networks(values: Iterable[str]) -> list[Network]:
    """Networks in listed order, each once. Host bits are masked, a bare address is
    a single-address network, blanks are skipped, anything else raises ValueError."""
    parsed = (ipaddress.ip_network(text, strict=False) for text in map(str.strip, values) if text)
    return [
        Network(
            text=str(net),
            version=net.version,
            low=int(net.network_address),
            high=int(net.broadcast_address),
            length=net.prefixlen,
        )
        for net in dict.fromkeys(parsed)
    ]


def ipv4_only(networks: Iterable[Network]) -> list[Network]:
    """An IPv4 address is never inside an IPv6 network."""
    return [net for net in networks if net.version == 4]
