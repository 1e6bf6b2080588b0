import ipaddress
import random

import pytest

from flowtally.functions.addresses import (
    in_networks,
    ipv4_number,
    is_ipv4,
    is_private,
    starts_in_networks,
    subnet_label,
)
from flowtally.functions.networks import ipv4_only, parse_networks

ODD = ["", "1.2.3", "1.2.3.4.5", "1.2.3.4\n", " 1.2.3.4", "01.2.3.4", "256.1.1.1", "1.2.3.-4", "::1", "a.b.c.d", None, "1.2.3.4/32", "١.2.3.4"]


def addresses(count, seed=1):
    rng = random.Random(seed)
    edges = [net for text in ("10.0.0.0/8", "172.16.0.0/12", "192.0.0.0/24", "192.0.0.170/31", "198.18.0.0/15", "100.64.0.0/10", "224.0.0.0/4", "240.0.0.0/4", "169.254.0.0/16", "0.0.0.0/8", "192.0.2.0/24", "203.0.113.0/24") for net in [ipaddress.ip_network(text)]]
    picked = [str(ipaddress.ip_address(rng.getrandbits(32))) for _ in range(count)]
    for net in edges:
        low, high = int(net.network_address), int(net.broadcast_address)
        picked += [str(ipaddress.ip_address(n)) for n in (low - 1, low, low + 9, low + 10, low + 11, high, high + 1) if 0 <= n < 2**32]
    return picked


def parsed(text):
    try:
        value = ipaddress.ip_address(text)
    except ValueError:
        return None
    return value if value.version == 4 else None


def test_ipv4_validity_and_number(column):
    texts = addresses(300) + ODD
    expected = [parsed(text) for text in texts]
    assert column(is_ipv4, texts) == [value is not None for value in expected]
    assert column(ipv4_number, texts) == [None if value is None else int(value) for value in expected]


def test_private_addresses(column):
    texts = addresses(2000) + ["192.0.0.9", "192.0.0.10", "192.0.0.11", "255.255.255.255", "8.8.8.8"] + ODD
    expected = [value is not None and value.is_private for value in map(parsed, texts)]
    assert column(is_private, texts) == expected


@pytest.mark.parametrize("seed", [3, 4])
def test_membership_of_random_networks(column, seed):
    rng = random.Random(seed)
    nets = parse_networks(f"{ipaddress.ip_address(rng.getrandbits(32))}/{length}" for length in range(0, 33, 3) if length)
    inside = [str(ipaddress.ip_address(rng.randint(net.low, net.high))) for net in nets for _ in range(10)]
    texts = inside + addresses(300, seed) + ODD
    real = [ipaddress.ip_network(net.text) for net in nets]
    expected = [value is not None and any(value in net for net in real) for value in map(parsed, texts)]
    assert column(lambda x: in_networks(x, nets), texts) == expected
    coarse = column(lambda x: starts_in_networks(x, nets), texts)
    assert all(c for c, e in zip(coarse, expected) if e)


def test_parse_networks():
    nets = parse_networks([" 10.2.83.0/24 ", "", "10.2.83.5/24", "10.0.0.1", "10.2.83.0/25", "2001:db8::/32"])
    assert [net.text for net in nets] == ["10.2.83.0/24", "10.0.0.1/32", "10.2.83.0/25", "2001:db8::/32"]
    assert [net.label for net in nets][:2] == ["10.2.83.0-24", "10.0.0.1-32"]
    assert len(ipv4_only(nets)) == 3
    with pytest.raises(ValueError):
        parse_networks(["nope"])


def test_octet_prefixes():
    nets = parse_networks(["10.2.83.0/24", "10.2.83.0/25", "10.8.0.0/16", "10.0.0.1/32", "0.0.0.0/5"])
    assert [net.octets for net in nets] == ["10.2.83.", "10.2.83.", "10.8.", "10.0.0.1", ""]


def test_first_listed_network_gives_the_label(column):
    nets = parse_networks(["10.2.83.0/25", "10.2.83.0/24", "2001:db8::/32"])
    texts = ["10.2.83.10", "10.2.83.200", "9.9.9.9", " 10.2.83.10　", "bad", "", None, "2001:db8::1"]
    assert column(lambda x: subnet_label(x, nets), texts) == [
        "10.2.83.0-25", "10.2.83.0-24", "other", "10.2.83.0-25", "other", "other", "other", "other",
    ]
