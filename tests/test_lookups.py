import ipaddress
import random

import pytest

from pyspark.sql import functions as F

from flowtally.functions.networks import parse_networks
from flowtally.operators.attach import attach, key_counts
from flowtally.operators.prefixes import parse_prefixes, with_best_prefix
from flowtally.operators.split import with_label, with_label_from


def skewed(spark, rows=3000):
    """A third of the rows share one key, a third have none."""
    return spark.range(rows).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN NULL ELSE 'k' || (id % 50) END AS k"
    )


def lookup_of(rows):
    return key_counts(rows, F.col("k")).withColumn("found", F.concat(F.lit("v-"), "key"))


def test_same_rows_as_a_plain_join(spark):
    rows = skewed(spark)
    got = attach(rows, lookup_of(rows), F.col("k"))
    expected = rows.join(lookup_of(rows).drop("key_rows"), F.col("k") == F.col("key"), "left").drop("key")
    assert got.columns == ["id", "k", "found"]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


FORCED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
}


@pytest.fixture
def shuffled(spark):
    """Joins by shuffle, and small partitions that count as skewed."""
    before = {name: spark.conf.get(name, None) for name in FORCED}
    for name, value in FORCED.items():
        spark.conf.set(name, value)
    yield spark
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_a_hot_key_is_spread_and_keyless_rows_too(shuffled):
    rows = skewed(shuffled, 30000).repartition(8)
    got = attach(rows, lookup_of(rows), F.col("k")).withColumn("p", F.spark_partition_id())
    largest = {}
    for row in got.groupBy("k", "p").count().collect():
        kind = "hot" if row.k == "hot" else "none" if row.k is None else "cold"
        largest.setdefault(kind, []).append(row["count"])
    assert sum(largest["hot"]) == sum(largest["none"]) == 10000
    assert max(largest["hot"]) < 5000 and max(largest["none"]) < 2500


def test_many_hot_keys(shuffled):
    rows = shuffled.range(48000).selectExpr("id", "'k' || (id % 12000) AS k")
    got = attach(rows, lookup_of(rows), F.col("k"))
    assert got.count() == 48000
    assert got.where("found IS NULL OR found <> 'v-' || k").count() == 0


def random_networks(rng, count):
    return [f"{ipaddress.ip_address(rng.getrandbits(32))}/{rng.choice([0, 1, 5, 8, 9, 12, 15, 16, 17, 20, 24, 25, 28, 31, 32])}" for _ in range(count)]


def test_longest_prefix_against_brute_force(spark):
    rng = random.Random(5)
    texts = list(dict.fromkeys(str(ipaddress.ip_network(t, strict=False)) for t in random_networks(rng, 400)))
    texts = [t for t in texts if not t.endswith("/0")]
    nets = [ipaddress.ip_network(t) for t in texts]
    keys = [str(net[rng.randrange(net.num_addresses)]) for net in nets for _ in range(3)]
    keys = list(dict.fromkeys(keys + [str(ipaddress.ip_address(rng.getrandbits(32))) for _ in range(200)] + ["bad", "::1"]))
    table = spark.createDataFrame([(t, "c-" + t) for t in [*texts, "junk", "1.2.3.4/33"]], "network string, country string")
    got = with_best_prefix(
        spark.createDataFrame([(k,) for k in keys], "key string"), parse_prefixes(table), -F.col("length"), F.col("country")
    )

    def expected(key):
        try:
            held = [net for net in nets if ipaddress.ip_address(key) in net]
        except ValueError:
            held = []
        return "c-" + str(max(held, key=lambda net: net.prefixlen)) if held else None

    assert {row.key: row.value for row in got.collect()} == {k: expected(k) for k in keys}


def test_many_networks_label_like_few(spark):
    rng = random.Random(6)
    nets = parse_networks([*random_networks(rng, 60), "10.0.0.0/8", "10.1.0.0/16"])
    texts = [str(ipaddress.ip_address(rng.randint(net.low, net.high))) for net in nets for _ in range(3)] + [" 10.1.2.3 ", "", None, "bad"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, SrcIP string")
    table = spark.createDataFrame([(i, n.text, n.label) for i, n in enumerate(nets)], "position int, network string, label string")
    few = {row.i: row.subnet for row in with_label(rows, nets).collect()}
    assert {row.i: row.subnet for row in with_label_from(rows, table).collect()} == few
    unused = parse_networks(f"{i >> 8 & 255}.{i & 255}.255.254" for i in range(1, 6000))
    unused = [net for net in unused if all(net.low != int(ipaddress.ip_address(t.strip())) for t in texts if t and t.count(".") == 3)]
    for count in (1, 64, 65, 5000):
        got = {row.i: row.subnet for row in with_label(rows, nets + unused[:count]).collect()}
        assert got == few
