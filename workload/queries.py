"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtally.functions import clock
from flowtally.functions.addresses import in_networks, ipv4_number, is_ipv4, is_private, starts_in_networks
from flowtally.functions.dates import cache_expiry, parse_date
from flowtally.functions.networks import parse_networks
from flowtally.functions.responses import (
    ascii_domain,
    domain_query,
    entity_contacts,
    expiration,
    json_array,
    object_contacts,
    vcard_name,
)
from flowtally.functions.text import clean
from flowtally.operators import answers, cache, diagnose, filters, merge
from flowtally.operators.aggregate import aggregate, merge_counts, ordered, threshold_report
from flowtally.operators.collect import CollectRules, collect, collect_sorted
from flowtally.operators.counters import RunCounters
from flowtally.operators.resolve import (
    is_pending,
    join_back,
    look_up,
    resolve,
    resolve_counters,
    resolve_keys,
)
from flowtally.operators.resolvers import Resolver, get_resolver
from flowtally.operators.rowfunction import from_function
from flowtally.operators.split import split_counts, with_label, with_label_from, with_label_on_stream, with_slice
from flowtally.operators.trim import trim
from flowtally.plans.pipeline import plan
from flowtally.plans.settings import Settings
from flowtally.session import configure, shared_folder, stage
from flowtally.sources.bucketcache import BucketCacheStore
from flowtally.sources.cachestore import CacheStore
from flowtally.sources.countstore import CountStore
from flowtally.sources.logstore import LogStore
from flowtally.sources.registry import register_source
from flowtally.sources.tables import write_csv
from flowtally.sources.windows import DOCUMENT, data_source, landed_days, read_windows
from flowtally.streaming.counts import landed, partial_counts, read_counts, trimmed
from workload.views import NOW, VIEWS, view

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CIDRS = ["10.2.82.0/25", "10.2.83.0/24", "10.2.82.0/24", "10.2.84.128/25"]
NETWORKS = parse_networks(CIDRS)
ALLOWLIST = ["10.2.82.16", "10.2.84.33", "10.2.83.225"]
RULES = CollectRules(now=NOW, start=20, end=2, unit="d", stream_id="s1", allowlist=ALLOWLIST, cidrs=CIDRS[:2])
ANSWER = ["country", "asn", "asn_descr", "contacts"]


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)

    QUERIES[function.__name__] = run
    return function


def answer_columns(frame: DataFrame, *keys: str) -> DataFrame:
    fields = [F.coalesce(F.col("answer")[name], F.lit("")).alias(name) for name in [*ANSWER, "expires"]]
    return frame.select(*keys, *fields)


def tables(spark: SparkSession, sf_dir: str, resolver: str) -> dict[str, DataFrame]:
    """The response tables a resolver reads; those of other resolvers are not made."""
    names = {
        "geo_blocks": "geo_blocks",
        "rdap": "rdap_raw",
        "rdap_aggregator": "rdap_aggregator_raw",
        "rdap_bootstrap": "rdap_bootstrap_raw",
        "whois": "whois_raw",
        "domain_whois": "domain_raw",
        "service_location": "service_location_raw",
        "service_registration": "service_registration_raw",
    }
    return {name: view(spark, sf_dir, names[name]) for name in READS[resolver]}


RDAP = ["rdap", "rdap_aggregator", "rdap_bootstrap"]
READS = {
    "geo": ["geo_blocks"],
    "rdap": RDAP,
    "whois": ["whois", "domain_whois"],
    "service": ["service_location", "service_registration"],
    "default": ["geo_blocks", *RDAP, "whois"],
}

# The response views hold one row per key.
UNIQUE = ["rdap", "rdap_aggregator", "rdap_bootstrap", "whois", "service_location", "service_registration"]

# -- scans, filters, projections ---------------------------------------------------


@query
def collect_rows(spark, sf_dir):
    return collect(view(spark, sf_dir, "connections"), RULES)


QUERIES["collect"] = QUERIES.pop("collect_rows")


@query
def time_range(spark, sf_dir):
    logs = view(spark, sf_dir, "connections")
    return logs.where(filters.in_time_range(logs, NOW, 20, 2, "d")).select("event_id")


@query
def stream_filter(spark, sf_dir):
    logs = view(spark, sf_dir, "connections")
    many = logs.withColumn("streams", F.array("streams", "source"))
    one = logs.where(filters.in_stream(logs, "s1")).select("event_id", F.lit("one").alias("field"))
    return one.unionAll(many.where(filters.in_stream(many, "fw0")).select("event_id", F.lit("many").alias("field")))


@query
def exists_filter(spark, sf_dir):
    return view(spark, sf_dir, "connections").where(filters.exists("SrcIP", "DstIP")).select("event_id", "DstIP")


@query
def valid_ipv4(spark, sf_dir):
    logs = view(spark, sf_dir, "connections")
    return logs.select("event_id", "DstIP", is_ipv4(F.col("DstIP")).alias("valid"), ipv4_number(F.col("DstIP")).alias("number"))


@query
def public_dst(spark, sf_dir):
    logs = view(spark, sf_dir, "connections").where(filters.both_ipv4())
    return logs.select("event_id", "DstIP", is_private(F.col("DstIP")).alias("private"))


@query
def src_allowlist(spark, sf_dir):
    return view(spark, sf_dir, "connections").where(filters.source_match(ALLOWLIST, [])).select("event_id", "SrcIP")


@query
def src_cidr(spark, sf_dir):
    inside = in_networks(F.col("SrcIP"), NETWORKS)
    return view(spark, sf_dir, "connections").where(inside).select("event_id", "SrcIP")


@query
def src_match_or(spark, sf_dir):
    match = filters.source_match(ALLOWLIST, NETWORKS[:1], "or")
    return view(spark, sf_dir, "connections").where(match).select("event_id", "SrcIP")


@query
def src_match_and(spark, sf_dir):
    match = filters.source_match(ALLOWLIST, NETWORKS[:1], "and")
    return view(spark, sf_dir, "connections").where(match).select("event_id", "SrcIP")


@query
def src_large_lists(spark, sf_dir):
    logs = view(spark, sf_dir, "connections").select("event_id", "SrcIP")
    lists = view(spark, sf_dir, "source_addresses"), view(spark, sf_dir, "narrow_networks")
    either, both = (filters.in_source_tables(logs, *lists, mode=mode) for mode in ("or", "and"))
    named = [frame.select(F.lit(mode).alias("mode"), "event_id", "SrcIP") for mode, frame in (("or", either), ("and", both))]
    return named[0].unionAll(named[1])


@query
def log_store(spark, sf_dir):
    """Collect from landed logs, partitioned by day."""
    home = f"{shared_folder(spark)}/flowtally-logs-{uuid4().hex}"
    landed = view(spark, sf_dir, "connections").withColumn("day", F.to_date("timestamp"))
    landed.repartition("day").write.partitionBy("day").parquet(home)
    return LogStore(home, "parquet", date_column="day")(spark, RULES)


@query
def window_source(spark, sf_dir):
    """Collect through a Python data source that fetches window after window of landed logs."""
    home = f"{shared_folder(spark)}/flowtally-windows-{uuid4().hex}"
    columns = [part.split()[0] for part in DOCUMENT.split(", ")]
    logs = view(spark, sf_dir, "connections").select(F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), *columns[1:])
    logs.withColumn("day", F.to_date("timestamp")).repartition("day").write.partitionBy("day").parquet(home)
    return collect(read_windows(spark, data_source("flowtally_landed", landed_days(home, columns)), RULES), RULES)


@query
def prefix_prefilter(spark, sf_dir):
    coarse = starts_in_networks(F.col("SrcIP"), NETWORKS[:1])
    exact = in_networks(F.col("SrcIP"), NETWORKS[:1])
    logs = view(spark, sf_dir, "connections")
    return logs.groupBy("SrcIP").agg(F.count_if(coarse).alias("coarse"), F.count_if(coarse & exact).alias("exact"))


@query
def trim_columns(spark, sf_dir):
    return trim(view(spark, sf_dir, "connections"))


QUERIES["trim"] = QUERIES.pop("trim_columns")


@query
def collect_order(spark, sf_dir):
    return collect_sorted(view(spark, sf_dir, "connections"), RULES)


QUERIES["collect_sorted"] = QUERIES.pop("collect_order")

# -- subnets -----------------------------------------------------------------------


@query
def subnet_label(spark, sf_dir):
    return with_label(view(spark, sf_dir, "connections"), NETWORKS).select("event_id", "SrcIP", "subnet")


@query
def subnet_label_table(spark, sf_dir):
    logs = view(spark, sf_dir, "connections").select("event_id", "SrcIP")
    return with_label_from(logs, view(spark, sf_dir, "source_networks")).select("event_id", "SrcIP", "subnet")


@query
def slice_name(spark, sf_dir):
    labelled = with_label(view(spark, sf_dir, "connections"), NETWORKS)
    return with_slice(labelled, NOW, 5, 0, "d").groupBy("slice").agg(F.count(F.lit(1)).alias("rows"))


@query
def split_report(spark, sf_dir):
    return split_counts(with_label(aggregate(collect(view(spark, sf_dir, "connections"), RULES)), NETWORKS))


QUERIES["split_counts"] = QUERIES.pop("split_report")

# -- aggregation -------------------------------------------------------------------


@query
def count_groups(spark, sf_dir):
    return aggregate(view(spark, sf_dir, "connections"))


QUERIES["aggregate"] = QUERIES.pop("count_groups")


@query
def aggregate_partial(spark, sf_dir):
    return aggregate(view(spark, sf_dir, "connections").drop("DstPort", "ac_rule_name", "url_domain"))


@query
def aggregate_two_phase(spark, sf_dir):
    logs = view(spark, sf_dir, "connections")
    chunks = logs.withColumn("chunk", F.dayofmonth("timestamp"))
    keys = ["SrcIP", "DstIP", "ac_action"]
    partial = chunks.groupBy("chunk", *keys).agg(F.count(F.lit(1)).alias("count"))
    return merge_counts(partial.drop("chunk"))


@query
def aggregate_merge(spark, sf_dir):
    logs = view(spark, sf_dir, "connections")
    old = aggregate(logs.where(F.col("timestamp") < clock.instant(clock.shift_now(NOW, 10, "d"), "timestamp_ntz")))
    new = aggregate(logs.where(F.col("timestamp") >= clock.instant(clock.shift_now(NOW, 10, "d"), "timestamp_ntz")))
    return merge_counts(old.unionByName(new))


@query
def aggregate_stored(spark, sf_dir):
    """All connections landed by the day, two days of them again in part and then as a whole, added up."""
    logs = view(spark, sf_dir, "connections")
    store = CountStore(spark, f"{shared_folder(spark)}/flowtally-counts-{uuid4().hex}", "d")
    # The events lie in the thirty days before NOW; the second landing lacks rows, the third mends it.
    first, middle, last = (clock.shift_now(NOW, days, "d") for days in (31, 2, -1))
    store.land(logs, first, last)
    store.land(logs.where("event_id % 2 = 0"), middle, last)
    store.land(logs, middle, last)
    return store.read()


@query
def aggregate_sorted(spark, sf_dir):
    return ordered(aggregate(view(spark, sf_dir, "connections")))


@query
def min_count(spark, sf_dir):
    return aggregate(view(spark, sf_dir, "connections").select("SrcIP", "DstIP"), min_count=3)


@query
def min_count_report(spark, sf_dir):
    return threshold_report(aggregate(view(spark, sf_dir, "connections").select("SrcIP", "DstIP")), 3)


# -- merge -------------------------------------------------------------------------


def merge_inputs(spark, sf_dir):
    logs = view(spark, sf_dir, "connections").select("event_id", "SrcIP", "DstIP", "ac_action")
    first = logs.where("ac_action = 'deny'").select("SrcIP", "DstIP", "ac_action")
    second = logs.where("ac_action = 'allow'").select(F.col("DstIP").alias("SrcIP"), F.col("SrcIP").alias("extra"), "ac_action")
    return first, second


@query
def merge_positional(spark, sf_dir):
    return merge.merge_frames(list(merge_inputs(spark, sf_dir)), how="position")


@query
def merge_by_name(spark, sf_dir):
    first, second = merge_inputs(spark, sf_dir)
    return merge.merge_frames([first.where("SrcIP IS NULL"), first, second], how="name")


# -- time --------------------------------------------------------------------------


@query
def time_expr(spark, sf_dir):
    events = view(spark, sf_dir, "events").withColumn("back", (F.col("event_id") % 30).cast("int"))
    return events.select(
        "event_id",
        clock.time_expression(F.col("back"), "h").alias("expr"),
        clock.shifted(F.col("ts"), F.col("back"), "d").alias("days_back"),
        clock.shifted(F.col("ts"), F.col("back"), "h").alias("hours_back"),
    )


@query
def time_windows(spark, sf_dir):
    events = view(spark, sf_dir, "events").select(
        "event_id", (F.col("user_id") % 7).cast("int").alias("start"), (F.col("event_id") % 4).cast("int").alias("end")
    )
    return events.select("event_id", F.inline(clock.time_windows(F.col("start"), F.col("end"), "h")))


@query
def window_counts(spark, sf_dir):
    numbered = view(spark, sf_dir, "connections").select(clock.window_number(F.col("timestamp"), NOW, "h").alias("window_no"))
    return numbered.groupBy("window_no").agg(F.count(F.lit(1)).alias("rows"))


@query
def date_parse(spark, sf_dir):
    return view(spark, sf_dir, "date_texts").select("event_id", parse_date(F.col("text")).cast("timestamp_ntz").alias("parsed"))


@query
def expiry(spark, sf_dir):
    return view(spark, sf_dir, "date_texts").select(
        "event_id", cache_expiry(F.col("text"), NOW).cast("timestamp_ntz").alias("expires_at")
    )


QUERIES["cache_expiry"] = QUERIES.pop("expiry")

# -- resolve -----------------------------------------------------------------------


@query
def keys_to_resolve(spark, sf_dir):
    return resolve_keys(view(spark, sf_dir, "half_enriched"))


QUERIES["resolve_keys"] = QUERIES.pop("keys_to_resolve")


@query
def resolve_pending(spark, sf_dir):
    return view(spark, sf_dir, "half_enriched").select("event_id", is_pending().alias("pending"))


@query
def resolve_join(spark, sf_dir):
    rows = view(spark, sf_dir, "half_enriched")
    owners = view(spark, sf_dir, "owners").select(
        "key", F.col("n_name").alias("country"), F.lit("").alias("asn"), F.lit("D").alias("asn_descr"), F.col("c_name").alias("contacts")
    )
    return join_back(rows, resolve_keys(rows).join(owners, "key", "left"))


@query
def hits(spark, sf_dir):
    keys = view(spark, sf_dir, "hosts").select("key")
    return cache.cache_hits(keys, view(spark, sf_dir, "resolve_cache"), "default", NOW)


QUERIES["cache_hits"] = QUERIES.pop("hits")


@query
def cache_buckets(spark, sf_dir):
    """Hits of all hosts in a cache laid out by key: two versions of it, and the same compacted."""
    store = BucketCacheStore(spark, f"{shared_folder(spark)}/flowtally-buckets-{uuid4().hex}", 16)
    known = view(spark, sf_dir, "resolve_cache")
    store.append(known)
    # A later run knew better for some keys, and longer.
    store.append(known.where("asn > '2'").withColumns({"country": F.lit("Later"), "expires_at": F.col("expires_at") + F.expr("INTERVAL 9 DAYS")}))
    keys = view(spark, sf_dir, "hosts").select("key")
    before = stage(cache.cache_hits(keys, store.read(), "default", NOW), "bucket-hits")
    store.compact(NOW)
    after = cache.cache_hits(keys, store.read(), "default", NOW)
    return before.select(F.lit("versions").alias("layout"), "*").unionAll(after.select(F.lit("compacted").alias("layout"), "*"))


@query
def misses(spark, sf_dir):
    keys = view(spark, sf_dir, "hosts").select("key")
    return cache.cache_misses(keys, view(spark, sf_dir, "resolve_cache"), "default", NOW)


QUERIES["cache_misses"] = QUERIES.pop("misses")


@query
def cache_write(spark, sf_dir):
    asked = get_resolver("rdap", tables(spark, sf_dir, "rdap")).answers(view(spark, sf_dir, "hosts").select("key"))
    fresh = cache.new_entries(asked, "rdap", NOW)
    return fresh.withColumn("expires_at", F.col("expires_at").cast("timestamp_ntz"))


@query
def cache_upsert(spark, sf_dir):
    owners = view(spark, sf_dir, "owners").where("c_mktsegment <> 'FURNITURE'")
    fresh = cache.new_entries(
        owners.select(
            "key",
            F.lit("New").alias("country"),
            *[F.lit("").alias(name) for name in ("asn", "asn_descr", "contacts")],
            F.lit("2024-05-05").alias("expires"),
        ),
        "default",
        NOW,
    )
    merged = cache.upsert(view(spark, sf_dir, "resolve_cache"), fresh, NOW)
    return merged.withColumn("expires_at", F.col("expires_at").cast("timestamp_ntz"))


@query
def counters(spark, sf_dir):
    return resolve_counters(
        view(spark, sf_dir, "half_enriched"), view(spark, sf_dir, "resolve_cache"), get_resolver("default"), NOW
    )


QUERIES["resolve_counters"] = QUERIES.pop("counters")


@query
def resolve_rows(spark, sf_dir):
    rows = view(spark, sf_dir, "half_enriched")
    known = view(spark, sf_dir, "resolve_cache")
    return resolve(rows, get_resolver("default", tables(spark, sf_dir, "default"), UNIQUE), cache=known, now=NOW).rows


QUERIES["resolve"] = QUERIES.pop("resolve_rows")


@query
def resolve_twice(spark, sf_dir):
    rows = view(spark, sf_dir, "half_enriched")
    resolver = get_resolver("default", tables(spark, sf_dir, "default"))
    once = resolve(rows, resolver).rows
    return resolve(stage(once, "once"), resolver).rows


@query
def resolve_function(spark, sf_dir):
    """All hosts through a row function, and until when each answer is to be cached."""

    def owner_of(key: str) -> dict | None:
        """A lookup that fails for some addresses, knows nothing of others and little of the rest."""
        first, second, third, last = map(int, key.split("."))
        if last % 48 == 0:
            raise ConnectionError(f"no route to {key}")
        if last % 80 == 16:
            return None
        found = {"country": f"C{second}", "asn": second * 256 + third, "contacts": None, "expires": "2024-02-15" if third % 2 else None}
        return found if last % 32 else {**found, "asn_descr": f"net {first}.{second}"}

    hosts = view(spark, sf_dir, "hosts").select("key").withColumn("key_rows", F.lit(1))
    asked = stage(look_up(hosts, Resolver("owner", from_function(owner_of)), None, NOW), "function-answers")
    fresh = cache.new_entries(asked, "owner", NOW).select(
        F.expr("substring(key, 10)").alias("key"), F.col("expires_at").cast("timestamp_ntz").alias("expires_at")
    )
    return asked.join(fresh, "key", "left").select("key", *ANSWER, "error", "expires_at")


# -- providers ---------------------------------------------------------------------


@query
def geo_lookup(spark, sf_dir):
    keys = view(spark, sf_dir, "connections").select(clean(F.col("DstIP")).alias("key")).where("key <> ''").distinct()
    return get_resolver("geo", tables(spark, sf_dir, "geo")).answers(keys).select("key", "country")


@query
def rdap_extract(spark, sf_dir):
    return answer_columns(answers.rdap_answers(view(spark, sf_dir, "rdap_raw"), "json"), "key")


@query
def rdap_contacts(spark, sf_dir):
    objects = F.get_json_object("json", "$.objects")
    return view(spark, sf_dir, "rdap_raw").select("key", object_contacts(objects).alias("contacts"))


@query
def rdap_expires(spark, sf_dir):
    events = F.get_json_object("json", "$.network.events")
    return view(spark, sf_dir, "rdap_raw").select("key", expiration(events, "action", "timestamp").alias("expires"))


@query
def rdapss_extract(spark, sf_dir):
    return answer_columns(answers.aggregator_answers(view(spark, sf_dir, "rdap_aggregator_raw"), "json"), "key")


@query
def vcard_fn(spark, sf_dir):
    entities = json_array(F.get_json_object("json", "$.data.entities"))
    cards = view(spark, sf_dir, "rdap_aggregator_raw").select("key", F.posexplode(entities).alias("place", "entity"))
    return cards.select("key", "place", vcard_name(F.get_json_object("entity", "$.vcardArray")).alias("name"))


@query
def rdap_entities(spark, sf_dir):
    entities = F.get_json_object("json", "$.data.entities")
    return view(spark, sf_dir, "rdap_aggregator_raw").select("key", entity_contacts(entities).alias("contacts"))


@query
def rdap_cascade(spark, sf_dir):
    return get_resolver("rdap", tables(spark, sf_dir, "rdap")).answers(view(spark, sf_dir, "hosts").select("key"))


@query
def whois_extract(spark, sf_dir):
    return answer_columns(answers.whois_answers(view(spark, sf_dir, "whois_raw"), "json"), "key")


@query
def tci_domain_keys(spark, sf_dir):
    domains = view(spark, sf_dir, "domains")
    return domains.select("custkey", domain_query(F.col("domain")).isNotNull().alias("served"))


@query
def domain_ascii(spark, sf_dir):
    domains = view(spark, sf_dir, "domains")
    return domains.select("custkey", "domain", ascii_domain(F.lower(clean(F.col("domain")))).alias("query"))


@query
def tci_extract(spark, sf_dir):
    return answer_columns(answers.domain_answers(view(spark, sf_dir, "domain_raw"), "json"), "key")


@query
def whois_cascade(spark, sf_dir):
    keys = view(spark, sf_dir, "domains").select(F.col("domain").alias("key"))
    whois = get_resolver("whois", tables(spark, sf_dir, "whois"), domain_whois=True)
    return whois.answers(keys.unionAll(view(spark, sf_dir, "hosts").select("key")))


@query
def service_extract(spark, sf_dir):
    return get_resolver("service", tables(spark, sf_dir, "service")).answers(view(spark, sf_dir, "hosts").select("key")).drop("expires")


@query
def resolve_default(spark, sf_dir):
    resolver = get_resolver("default", tables(spark, sf_dir, "default"), UNIQUE)
    return look_up(view(spark, sf_dir, "hosts").select("key"), resolver, None, NOW).drop("cached", "error")


# -- streaming ---------------------------------------------------------------------


LANDED_FILES = 8


def event_stream(spark: SparkSession, home: str, sf_dir: str, view_name: str) -> DataFrame:
    """All events, landed as several files that are read in micro-batches of two."""
    events = view(spark, sf_dir, "events")
    events.repartition(LANDED_FILES).write.parquet(f"{home}/events")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2)
    stream.parquet(f"{home}/events").createOrReplaceTempView("events")
    return spark.sql(VIEWS[view_name])


@query
def stream_aggregate(spark, sf_dir):
    home = stream_home(spark)
    partial_counts(event_stream(spark, home, sf_dir, "connections"), f"{home}/counts", f"{home}/state").awaitTermination()
    return read_counts(spark, f"{home}/counts")


@query
def stream_trim(spark, sf_dir):
    home = stream_home(spark)
    trimmed(event_stream(spark, home, sf_dir, "connections"), f"{home}/rows", f"{home}/state").awaitTermination()
    return spark.read.parquet(f"{home}/rows")


@query
def stream_label(spark, sf_dir):
    """Every connection of a stream with the label of its source's network, from a table of networks."""
    home = stream_home(spark)
    networks = view(spark, sf_dir, "source_networks")
    labelled = with_label_on_stream(event_stream(spark, home, sf_dir, "connections").select("event_id", "SrcIP"), networks)
    landed(labelled, f"{home}/rows", f"{home}/state").awaitTermination()
    return spark.read.parquet(f"{home}/rows")


def stream_home(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/flowtally-stream-{uuid4().hex}"


# -- pipelines and diagnosis -------------------------------------------------------


def pipeline_settings(spark, sf_dir, **more) -> Settings:
    register_source("connections")(lambda spark, rules: collect(view(spark, sf_dir, "connections"), rules))
    return Settings(source="connections", now=NOW, **more)


@query
def pipeline_flagship(spark, sf_dir):
    settings = pipeline_settings(spark, sf_dir)
    steps = [{"collect": {"start": 20, "end": 0, "time_unit": "d"}}, "trim", {"aggregate": {"min_count": 2}}]
    return ordered(plan(spark, steps, settings=settings).frame)


@query
def pipeline_resolved(spark, sf_dir):
    responses = tables(spark, sf_dir, "default")
    settings = pipeline_settings(spark, sf_dir, tables=responses, resolver_options={"unique": UNIQUE})
    steps = [{"collect": {"start": 20, "time_unit": "d"}}, "trim", {"aggregate": {"min_count": 2}}, "resolve"]
    return ordered(plan(spark, steps, settings=settings).frame)


@query
def pipeline_counters(spark, sf_dir):
    """What the steps of a run counted on the way: one row for each counter."""
    store = CacheStore(spark, f"{shared_folder(spark)}/flowtally-cache-{uuid4().hex}")
    store.append(view(spark, sf_dir, "resolve_cache"))
    settings = pipeline_settings(spark, sf_dir, cache=store, tables=tables(spark, sf_dir, "default"), resolver_options={"unique": UNIQUE})
    steps = [{"collect": {"start": 20, "end": 2, "time_unit": "d"}}, "trim", {"aggregate": {"min_count": 2}}, "resolve"]
    counters = RunCounters()
    plan(spark, steps, settings=settings, counters=counters)
    rows = [(step, name, value) for step, found in counters.get().items() for name, value in found.items()]
    return spark.createDataFrame(rows, "step string, counter string, value bigint")


@query
def pipeline_merged(spark, sf_dir):
    """Three CSV inputs with different columns, aligned by name and taken by position."""
    home = f"{shared_folder(spark)}/flowtally-merge-{uuid4().hex}"
    logs = view(spark, sf_dir, "connections")
    parts = {"a": ["SrcIP", "DstIP", "ac_action"], "b": ["DstIP", "SrcIP", "url_domain"], "c": ["ac_action", "DstPort", "SrcIP"]}
    for number, (name, columns) in enumerate(parts.items()):
        write_csv(logs.where(F.col("event_id") % 3 == number).select(columns), f"{home}/{name}")
    inputs = [f"{home}/{name}" for name in parts]
    done = []
    for how in ("name", "position"):
        steps = [{"merge": {"inputs": inputs, "how": how, "multiline": False}}, "aggregate"]
        done.append(plan(spark, steps, settings=Settings(now=NOW)).frame.select(F.lit(how).alias("how"), "*"))
    return done[0].unionByName(done[1])


@query
def diag_ladder(spark, sf_dir):
    return diagnose.filter_ladder(view(spark, sf_dir, "connections"), RULES)


@query
def diag_fields(spark, sf_dir):
    return diagnose.field_presence(view(spark, sf_dir, "connections"), ["timestamp", "SrcIP", "DstIP", "streams", "dst_ip"])


@query
def diag_newest(spark, sf_dir):
    return diagnose.newest(view(spark, sf_dir, "connections"))
