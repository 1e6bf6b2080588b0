"""Pieces of raw provider responses (JSON or text), as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowtally.functions.text import clean, filled, joined_names, strip
from flowtally.schema import ANSWER_FIELDS, ANSWER_TYPE

# JSON texts that count as "nothing".
EMPTY_JSON = ["", "null", "false", "0", "0.0", '""', "[]", "{}"]


def answer(**fields: Column) -> Column:
    return F.struct(*[fields.get(name, F.lit("")).alias(name) for name in ANSWER_FIELDS])


def no_answer() -> Column:
    return F.lit(None).cast(ANSWER_TYPE)


def json_object(text: Column) -> Column:
    """The text where it looks like a JSON object."""
    return F.when(text.rlike(r"\A\s*\{"), text)


def json_fields(text: Column, *names: str) -> Column:
    """Top-level fields as text, nested ones as JSON text, in one parse."""
    return F.from_json(json_object(text), ", ".join(f"{name} string" for name in names))


def json_array(text: Column) -> Column:
    return F.from_json(F.when(F.ltrim(text).startswith("["), text), "array<string>")


def json_text(text: Column, path: str) -> Column:
    return F.coalesce(F.get_json_object(text, path), F.lit(""))


def json_document(text: Column) -> Column:
    """The parsed object, which keeps the kinds of its values; NULL where there is none."""
    return F.try_parse_json(json_object(text))


# Texts of JSON values that may say nothing, depending on their kind.
DOUBTFUL = r"\A(?:-?0+(?:\.0*)?(?:[eE][+-]?[0-9]+)?|false|\[\]|\{\})\z"


def says_something(text: Column, document: Column, path: str) -> Column:
    """``text`` of the value at ``path`` of the JSON text ``document``, empty where it is
    missing or says nothing: ``0``, ``false``, ``null`` or something empty. The text ``"0"`` is
    a value like any other, so the kind of a doubtful value is looked up in the document;
    of all others, which are nearly all, no more is parsed than the text they came from."""
    text = filled(text)
    value = F.try_variant_get(json_document(document), path, "variant")
    return F.when(text.rlike(DOUBTFUL) & (F.coalesce(F.schema_of_variant(value), F.lit("VOID")) != "STRING"), F.lit("")).otherwise(text)


# -- registration data (RDAP) ------------------------------------------------------


def object_contacts(objects: Column) -> Column:
    """``contact.name`` of every entry of a map or list, in document order."""
    entries = F.coalesce(F.map_values(F.from_json(objects, "map<string,string>")), json_array(objects))
    names = F.transform(entries, lambda entry: strip(json_text(entry, "$.contact.name")))
    return filled(joined_names(names))


def vcard_name(vcard: Column) -> Column:
    """Value of the first ``fn`` property of ``["vcard", [[name, params, type, value], …]]``."""

    def name(card: Column) -> Column:
        listed = F.get(card, F.lit(1))
        # One parse where every property is a list; property by property where one is not.
        properties = F.coalesce(
            F.from_json(listed, "array<array<string>>"), F.transform(json_array(listed), json_array)
        )
        named = F.filter(properties, lambda p: (F.size(p) >= 4) & (F.get(p, F.lit(0)) == "fn"))
        value = clean(F.get(F.get(named, F.lit(0)), F.lit(3)))
        return F.when((F.size(card) == 2) & listed.startswith("["), value).otherwise(F.lit(""))

    return F.get(F.transform(F.array(json_array(vcard)), name), F.lit(0))


def nesting(text: Column, keys: Column) -> Column:
    """How deep objects of a JSON text can lie inside lists at most; ``keys`` bounds it too.

    A list of objects takes two brackets. Strings go first, since they may hold brackets."""
    brackets = F.regexp_replace(F.regexp_replace(text, r'"(?:[^"\\]|\\.)*+"', ""), r"[^\[\]{}]", "")
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(state: Column, sign: Column) -> Column:
        now = state["now"] + F.when(sign.isin("[", "{"), 1).otherwise(-1)
        return F.struct(now.alias("now"), F.greatest(state["most"], now).alias("most"))

    deepest = F.aggregate(F.split(brackets, ""), start, step, lambda state: F.ceil((state["most"] + 1) / 2).cast("int"))
    return F.when(keys <= 3, keys).otherwise(F.least(keys, deepest))


def entity_contacts(entities: Column) -> Column:
    """vCard names of an entity list and of all entities nested in it, parents first.

    A round opens the lists inside the entities found by the round before, and nothing else.
    There are no more rounds than the text nests deep, because each copies what was found so
    far. Places in the tree put the names of all rounds in document order.
    """
    shape = "struct<vcardArray:string,entities:string>"
    named = "struct<place:array<int>,name:string,inside:string>"

    def opened(text: Column, above: Column) -> Column:
        # One parse where every entity is an object; entity by entity where one is not.
        items = F.coalesce(
            F.from_json(F.when(F.ltrim(text).startswith("["), text), f"array<{shape}>"),
            F.transform(
                F.filter(json_array(text), lambda item: F.ltrim(item).startswith("{")),
                lambda item: F.from_json(item, shape),
            ),
            F.array().cast(f"array<{shape}>"),
        )
        return F.transform(
            items,
            lambda item, i: F.struct(
                F.concat(above, F.array(i)).alias("place"), vcard_name(item["vcardArray"]).alias("name"), item["entities"].alias("inside")
            ),
        )

    def next_round(state: Column, _round: Column) -> Column:
        open_lists = F.filter(state["found"], lambda one: one["inside"].isNotNull())
        inner = F.flatten(F.transform(open_lists, lambda one: opened(one["inside"], one["place"])))
        more = F.struct(F.array_append(state["rounds"], state["found"]).alias("rounds"), inner.alias("found"))
        return F.when(F.size(state["found"]) == 0, state).otherwise(more)

    depth = nesting(filled(entities), F.regexp_count(filled(entities), F.lit('"entities"')))
    rounds = F.slice(F.sequence(F.lit(0), depth), F.lit(2), depth)
    first = F.struct(
        F.array().cast(f"array<array<{named}>>").alias("rounds"), opened(entities, F.array().cast("array<int>")).cast(f"array<{named}>").alias("found")
    )

    def in_order(state: Column) -> Column:
        every = F.array_append(state["rounds"], state["found"])
        return F.when(F.size(state["rounds"]) == 0, state["found"]).otherwise(F.array_sort(F.flatten(every)))["name"]

    return filled(joined_names(F.aggregate(rounds, first, next_round, in_order)))


def expiration(events: Column, action: str, date: str) -> Column:
    """Date of the first event whose action is ``expiration``."""
    ends = F.filter(json_array(events), lambda event: F.lower(json_text(event, f"$.{action}")) == "expiration")
    return clean(F.get_json_object(F.get(ends, F.lit(0)), f"$.{date}"))


# -- domain WHOIS ------------------------------------------------------------------

# Zones served by the domain registry, and the fields that name contacts.
DOMAIN_ZONES = [".ru", ".su", ".рф", ".дети", ".tatar", ".xn--p1ai", ".xn--d1acj3b"]
DOMAIN_CONTACTS = ["org", "registrar", "nserver"]


def domain_query(key: Column) -> Column:
    """The domain to ask the registry for, NULL when the key is outside its zones."""
    domain = F.rtrim(F.lower(clean(key)), F.lit("."))
    served = F.lit(False)
    for zone in DOMAIN_ZONES:
        served = served | domain.endswith(zone)
    return F.when(served, ascii_domain(domain))


def ascii_domain(domain: Column) -> Column:
    """Punycode for an internationalised name, unchanged where there is none."""
    allow_unassigned = F.lit(1)
    encoded = F.try_reflect(F.lit("java.net.IDN"), F.lit("toASCII"), domain, allow_unassigned)
    return F.when(domain.rlike(r"[^\x00-\x7f]"), F.coalesce(encoded, domain)).otherwise(domain)
