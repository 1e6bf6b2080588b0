"""Resolvers: where the answer for a key comes from.

A resolver is a DataFrame-to-DataFrame step. It gets one row per key with a boolean
``wanted`` and adds the struct column ``answer`` (NULL where nothing was asked or
found), keeping all rows and columns. The steps of a cascade are therefore one chain
of left joins on ``key``: the keys are shuffled once, and no step is planned twice.

Raw responses come as tables, however they were fetched. Join conditions hold the
``wanted`` flag, so that a later tier is only asked for what is still open.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtally.functions.responses import answer, domain_query, no_answer
from flowtally.functions.text import clean, filled
from flowtally.operators.answers import (
    aggregator_answers,
    domain_answers,
    rdap_answers,
    service_answers,
    whois_answers,
)
from flowtally.operators.prefixes import parse_prefixes, with_best_prefix
from flowtally.schema import ANSWER_FIELDS, RESOLVE_COLUMNS
from flowtally.session import stage

Step = Callable[[DataFrame], DataFrame]
# Column in which a step that can fail for a key leaves the reason; kept by all steps.
ERROR = "error"
Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Resolver:
    """A named step. ``rebuild`` makes the same step over the responses of some keys."""

    name: str
    step: Step
    rebuild: Callable[[DataFrame], Step] | None = None

    def answers(self, keys: DataFrame) -> DataFrame:
        """Ask for every key: ``keys`` plus the answer fields as text columns."""
        asked = self.step(keys.withColumn("wanted", F.lit(True)))
        return asked.selectExpr(
            *keys.columns, *[f"coalesce(answer.{name}, '') AS {name}" for name in ANSWER_FIELDS]
        )

    def among(self, keys: DataFrame) -> Resolver:
        """The resolver over only the responses ``keys`` can ask for. Worth it for stored
        keys: when they are few, the responses of all others are dropped in the scan's
        own stage, before anything is shuffled."""
        return self if self.rebuild is None else Resolver(self.name, self.rebuild(keys))


# -- building blocks ---------------------------------------------------------------


def silent(frame: DataFrame) -> DataFrame:
    """The step of a provider that is not configured."""
    return frame.withColumn("answer", no_answer())


# Column of a response table that tells when a response was fetched.
FETCHED = "fetched_at"


UNIQUE_COLUMNS = ["_asked", "response"]


def declared_unique(table: DataFrame, key: str = "key", body: str = "json") -> DataFrame:
    """A response table known to hold one row per key: nothing is grouped or sorted."""
    return table.select(F.col(key).alias("_asked"), F.col(body).alias("response"))


def one_response(table: DataFrame, key: str = "key", body: str = "json") -> DataFrame:
    """One response per key: the newest, if the table tells by ``fetched_at``; of equally
    new ones the greatest text. The grouping leaves the table partitioned by key, which the
    join on key then uses."""
    if table.columns == UNIQUE_COLUMNS:
        return table
    best = F.max(F.struct(FETCHED, body))[body] if FETCHED in table.columns else F.max(body)
    return table.groupBy(F.col(key).alias("_asked")).agg(best.alias("response"))


def ask(frame: DataFrame, table: DataFrame, extract: Step, key: Column | None = None) -> DataFrame:
    """Left join the responses for the wanted rows and extract their answers."""
    question = F.col("key") if key is None else key
    joined = frame.join(one_response(table), (question == F.col("_asked")) & F.col("wanted"), "left")
    return extract(joined).drop("_asked", "response")


def first_filled(frame: DataFrame, tiers: Sequence[Step]) -> DataFrame:
    """Ask tier after tier for the keys without any answer so far. An answer counts as
    a whole: fields of different tiers are never mixed."""
    texts = ", ".join(f"_whole.{name}" for name in ANSWER_FIELDS)
    still_open = F.expr(f"_asked_first AND concat_ws('', {texts}) = ''")
    state = frame.withColumns({"_asked_first": F.col("wanted"), "_whole": no_answer()})
    for tier in tiers:
        asked = tier(state.withColumn("wanted", still_open))
        state = asked.withColumn("_whole", F.coalesce("answer", "_whole")).drop("answer")
    return state.withColumn("wanted", F.col("_asked_first")).withColumnRenamed("_whole", "answer").drop("_asked_first")


def chain(frame: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """Merge providers field by field, earlier ones first. A key with all four columns
    filled is not asked further, and only asked providers can give the expiry hint."""
    complete = " AND ".join(f"coalesce(_merged.{name}, '') <> ''" for name in RESOLVE_COLUMNS)
    fields = ", ".join(
        f"'{name}', coalesce(nullif(_merged.{name}, ''), answer.{name})" for name in ANSWER_FIELDS
    )
    incomplete, merged = F.expr(f"_asked_all AND NOT ({complete})"), F.expr(f"named_struct({fields})")
    state = frame.withColumns({"_asked_all": F.col("wanted"), "_merged": no_answer()})
    for step in steps:
        asked = step(state.withColumn("wanted", incomplete))
        state = asked.withColumn("_merged", merged).drop("answer")
    return state.withColumn("wanted", F.col("_asked_all")).withColumnRenamed("_merged", "answer").drop("_asked_all")


def from_results(function: Callable[[DataFrame], DataFrame]) -> Step:
    """Step of a function that maps a DataFrame of keys to at most one row per key with
    any of the answer fields. For a plain Python function see ``rowfunction``. The
    keys so far are staged, because they are read twice: to ask and to join back."""

    def step(frame: DataFrame) -> DataFrame:
        frame = stage(frame, "asked")
        found = function(frame.where("wanted").select("key"))
        fields = [
            (filled(F.col(name)) if name in found.columns else F.lit("")).alias(name) for name in ANSWER_FIELDS
        ]
        answers = found.select(F.col("key").alias("_asked"), F.struct(*fields).alias("answer"))
        return frame.join(answers, (F.col("key") == F.col("_asked")) & F.col("wanted"), "left").drop("_asked")

    return step


# -- providers ---------------------------------------------------------------------


def geo_step(blocks: DataFrame | None) -> Step:
    """Country of the longest prefix holding the address, from a table
    ``(network, country)``."""
    if blocks is None:
        return silent

    def step(frame: DataFrame) -> DataFrame:
        located = with_best_prefix(
            frame, parse_prefixes(blocks), -F.col("length"), clean(F.col("country")), "_country"
        )
        found = F.when(F.col("wanted") & F.col("_country").isNotNull(), answer(country=F.col("_country")))
        return located.withColumn("answer", found).drop("_country")

    return step


def rdap_step(
    primary: DataFrame | None, aggregator: DataFrame | None = None, bootstrap: DataFrame | None = None
) -> Step:
    """Registry data, then an aggregator, then the bootstrap registry."""
    tiers: list[Step] = []
    for table, extract in ((primary, rdap_answers), (aggregator, aggregator_answers), (bootstrap, rdap_answers)):
        if table is not None:
            tiers.append(lambda frame, table=table, extract=extract: ask(frame, table, extract))
    return lambda frame: first_filled(frame, tiers)


def whois_step(primary: DataFrame | None, domains: DataFrame | None = None) -> Step:
    """Address WHOIS, then (for domain keys) the registry of their zone."""
    tiers: list[Step] = []
    if primary is not None:
        tiers.append(lambda frame: ask(frame, primary, whois_answers))
    if domains is not None:
        tiers.append(lambda frame: ask_domains(frame, domains))
    return lambda frame: first_filled(frame, tiers)


def ask_domains(frame: DataFrame, domains: DataFrame) -> DataFrame:
    """Keys outside the zones keep their own text as question, so that they stay spread
    over the tasks, but are not wanted."""
    asked = frame.withColumns({"_domain": domain_query(F.col("key")), "_wished": F.col("wanted")}).withColumn(
        "wanted", F.col("wanted") & F.col("_domain").isNotNull()
    )
    found = ask(asked, domains, domain_answers, F.coalesce("_domain", "key"))
    return found.withColumn("wanted", F.col("_wished")).drop("_domain", "_wished")


def service_step(location: DataFrame | None, registration: DataFrame | None) -> Step:
    def step(frame: DataFrame) -> DataFrame:
        joined = frame
        for table, name in ((location, "_location"), (registration, "_registration")):
            if table is None:
                joined = joined.withColumn(name, F.lit(None).cast("string"))
                continue
            replies = one_response(table).withColumnRenamed("response", name)
            joined = joined.join(
                replies, (F.col("key") == F.col("_asked")) & F.col("wanted"), "left"
            ).drop("_asked")
        return service_answers(joined, "_location", "_registration").drop("_location", "_registration")

    return step


# -- registry ----------------------------------------------------------------------

Factory = Callable[..., Step]
RESOLVERS: dict[str, Factory] = {}
# Response tables whose ``key`` is the lookup key itself.
KEYED_TABLES = [
    "rdap",
    "rdap_aggregator",
    "rdap_bootstrap",
    "whois",
    "service_location",
    "service_registration",
]


def register_resolver(name: str) -> Callable[[Factory], Factory]:
    """Register ``factory(tables, **options) -> step`` under a name."""

    def register(factory: Factory) -> Factory:
        RESOLVERS[name] = factory
        return factory

    return register


def get_resolver(name: str, tables: Tables | None = None, unique: Collection[str] = (), **options) -> Resolver:
    """The resolver over response tables. ``unique`` names those that hold one response per
    key, for instance because repeats were dropped when they were landed; a repeat in such a
    table would repeat rows."""
    if name not in RESOLVERS:
        known = ", ".join(sorted(RESOLVERS)) or "<none registered>"
        raise ValueError(f"Unknown resolver '{name}'. Available resolvers: {known}")
    tables, factory = dict(tables or {}), RESOLVERS[name]

    def build(given: Tables) -> Step:
        return factory({one: declared_unique(rows) if one in unique else rows for one, rows in given.items()}, **options)

    def rebuild(keys: DataFrame) -> Step:
        asked = keys.select("key")
        some = {
            table: rows.join(asked, "key", "left_semi") if table in KEYED_TABLES else rows
            for table, rows in tables.items()
        }
        return build(some)

    return Resolver(name, build(tables), rebuild)


@register_resolver("geo")
def _geo(tables: Tables, **_options) -> Step:
    return geo_step(tables.get("geo_blocks"))


@register_resolver("rdap")
def _rdap(tables: Tables, aggregator: bool = True, bootstrap: bool = True, **_options) -> Step:
    return rdap_step(
        tables.get("rdap"),
        tables.get("rdap_aggregator") if aggregator else None,
        tables.get("rdap_bootstrap") if bootstrap else None,
    )


@register_resolver("whois")
def _whois(tables: Tables, domain_whois: bool = False, **_options) -> Step:
    return whois_step(tables.get("whois"), tables.get("domain_whois") if domain_whois else None)


@register_resolver("service")
def _service(tables: Tables, **_options) -> Step:
    return service_step(tables.get("service_location"), tables.get("service_registration"))


@register_resolver("default")
def _default(tables: Tables, **options) -> Step:
    steps = [RESOLVERS[name](tables, **options) for name in ("geo", "rdap", "whois")]
    return lambda frame: chain(frame, steps)
