"""Turn raw provider responses into answers.

Each function adds a struct column ``answer`` of ``ANSWER_FIELDS`` (text, never NULL)
made from a response column. A response that cannot be read gives a NULL answer.
Parsed parts are columns of their own, so every response is parsed once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtally.functions.responses import (
    DOUBTFUL,
    DOMAIN_CONTACTS,
    EMPTY_JSON,
    answer,
    entity_contacts,
    expiration,
    json_array,
    json_fields,
    json_object,
    object_contacts,
    says_something,
)
from flowtally.functions.text import blank_to_null, clean, filled, joined_names, lines, strip


def rdap_answers(frame: DataFrame, response: str = "response") -> DataFrame:
    """Registration data as an address lookup returns it."""
    parsed = frame.withColumn(
        "_data", json_fields(F.col(response), "asn", "asn_description", "asn_country_code", "network", "objects")
    ).withColumn("_network", json_fields(F.col("_data.network"), "country", "events"))
    data, network = F.col("_data"), F.col("_network")

    def meant(field: str) -> Column:
        return clean(says_something(data[field], F.col(response), f"$.{field}"))

    found = answer(
        country=F.coalesce(
            blank_to_null(meant("asn_country_code")),
            clean(says_something(network["country"], data["network"], "$.country")),
        ),
        asn=meant("asn"),
        asn_descr=meant("asn_description"),
        contacts=object_contacts(data["objects"]),
        expires=expiration(network["events"], "action", "timestamp"),
    )
    return parsed.withColumn("answer", F.when(data.isNotNull(), found)).drop("_data", "_network")


def aggregator_answers(frame: DataFrame, response: str = "response") -> DataFrame:
    """An aggregator wraps the registry's own object; it never knows the network number."""
    parsed = frame.withColumn("_reply", json_fields(F.col(response), "success", "data")).withColumn(
        "_data", json_fields(F.col("_reply.data"), "country", "entities", "events")
    )
    data = F.col("_data")
    success = ~filled(F.col("_reply.success")).isin(*EMPTY_JSON)
    found = answer(
        country=clean(says_something(data["country"], F.col("_reply.data"), "$.country")),
        contacts=entity_contacts(data["entities"]),
        expires=expiration(data["events"], "eventAction", "eventDate"),
    )
    return parsed.withColumn("answer", F.when(success & data.isNotNull(), found)).drop("_reply", "_data")


def whois_answers(frame: DataFrame, response: str = "response") -> DataFrame:
    """Registration data of the networks an address lies in, the first one's country."""
    shape = "struct<description:string,name:string>"
    # The texts of the networks, and their fields: one parse where every network is an object,
    # network by network where one is not.
    parsed = (
        frame.withColumn("_data", json_fields(F.col(response), "asn", "asn_description", "nets"))
        .withColumn("_nets", json_array(F.col("_data.nets")))
        .withColumn("_fields", F.from_json(F.when(F.col("_nets").isNotNull(), F.col("_data.nets")), f"array<{shape}>"))
        .withColumn(
            "_fields",
            F.when(F.size("_fields") == F.size("_nets"), F.col("_fields")).otherwise(
                F.transform("_nets", lambda net: F.from_json(json_object(net), shape))
            ),
        )
    )

    def name(net: Column) -> Column:
        text, field = net["_nets"], net["_fields"]
        # Only doubtful values are looked up in the text of their network.
        described, named = (filled(field[one]) for one in ("description", "name"))
        plain = F.when(described != "", described).otherwise(named)
        looked_up = F.coalesce(
            blank_to_null(says_something(described, text, "$.description")), says_something(named, text, "$.name")
        )
        return F.when(described.rlike(DOUBTFUL) | named.rlike(DOUBTFUL), looked_up).otherwise(plain)

    objects = F.filter(F.arrays_zip("_nets", "_fields"), lambda net: F.ltrim(net["_nets"]).startswith("{"))
    parsed = parsed.withColumn("_texts", F.transform(objects, name)).drop("_fields")
    data = F.col("_data")
    first, response_text = F.get("_nets", F.lit(0)), F.col(response)
    first_lines = F.transform("_texts", lambda text: strip(F.get(lines(strip(text)), F.lit(0))))
    found = answer(
        country=clean(says_something(F.get_json_object(json_object(first), "$.country"), first, "$.country")),
        asn=clean(says_something(data["asn"], response_text, "$.asn")),
        asn_descr=clean(says_something(data["asn_description"], response_text, "$.asn_description")),
        contacts=filled(joined_names(first_lines)),
    )
    # A name of white space only has no first line; such a response counts as failed.
    broken = F.exists("_texts", lambda text: (text != "") & (strip(text) == ""))
    readable = data.isNotNull() & ~F.coalesce(broken, F.lit(False))
    return parsed.withColumn("answer", F.when(readable, found)).drop("_data", "_nets", "_texts")


def domain_answers(frame: DataFrame, response: str = "response") -> DataFrame:
    """Domain registry text: ``field: value`` lines; comments start with ``%``."""
    useful = F.filter(
        F.transform(lines(F.col(response)), strip),
        lambda line: ~line.startswith("%") & line.contains(":"),
    )
    pairs = F.transform(
        useful,
        lambda line: F.struct(
            F.lower(strip(F.substring_index(line, ":", 1))).alias("field"),
            strip(F.substr(line, F.instr(line, ":") + 1)).alias("value"),
        ),
    )
    parsed = frame.withColumn("_pairs", F.filter(pairs, lambda pair: pair["value"] != ""))

    def values(field: str):
        return F.filter("_pairs", lambda pair: pair["field"] == field)["value"]

    found = answer(
        contacts=filled(joined_names(F.concat(*[values(field) for field in DOMAIN_CONTACTS]))),
        expires=filled(F.get(values("paid-till"), F.lit(0))),
    )
    return parsed.withColumn("answer", F.when(filled(F.col(response)) != "", found)).drop("_pairs")


def service_answers(
    frame: DataFrame, location: str = "location", registration: str = "registration"
) -> DataFrame:
    """A lookup service with separate location and registration replies, which fail
    independently of each other."""
    registered = json_fields(F.get_json_object(json_object(F.col(registration)), "$.ip_whois"), "asn", "asn_description", "objects")
    parsed = frame.withColumn("_whois", registered)
    whois = F.col("_whois")
    found = answer(
        country=says_something(
            F.get_json_object(json_object(F.col(location)), "$.country.name"), F.col(location), "$.country.name"
        ),
        asn=says_something(whois["asn"], F.col(registration), "$.ip_whois.asn"),
        asn_descr=says_something(whois["asn_description"], F.col(registration), "$.ip_whois.asn_description"),
        contacts=object_contacts(whois["objects"]),
    )
    return parsed.withColumn("answer", found).drop("_whois")
