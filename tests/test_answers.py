import json
import random
import time

from flowtally.functions.responses import ascii_domain, domain_query, entity_contacts, object_contacts, vcard_name
from flowtally.operators import answers
from flowtally.functions.text import WHITESPACE, lines, strip


def ask(frame, function, *responses):
    rows = frame("i, response", [(str(i), text) for i, text in enumerate(responses)]).coalesce(1)
    return [row.answer and row.answer.asDict() for row in function(rows).sort("i").collect()]


def full(**fields):
    return {**dict.fromkeys(["country", "asn", "asn_descr", "contacts", "expires"], ""), **fields}


def test_white_space_rules(column):
    texts = [f"{WHITESPACE}a b{WHITESPACE}", "\x1cx ", "", None]
    assert column(strip, texts) == [text and text.strip() if text is not None else None for text in texts]
    broken = "a\r\nb\nc\x0bd\x0ce\x1cf\x1dg\x1eh\x85i j k\rl"
    assert column(lines, [broken])[0] == broken.splitlines()


def test_rdap(frame):
    carrier = {
        "asn": 64500, "asn_description": " FJORD-TRANSIT ", "asn_country_code": "NO", "query": "198.51.100.7",
        "objects": {
            "H1": {"contact": {"name": "Fjord Transit Desk"}, "roles": ["abuse"]},
            "H2": {"contact": {"name": " Harbour Hosting "}},
            "H3": {"contact": {"name": "Fjord Transit Desk"}},
            "H4": {"contact": None},
            "H5": ["no", "object"],
        },
    }
    network = {"asn": "64501", "asn_country_code": None, "network": {"country": "IS", "events": [
        {"action": "registration", "timestamp": "2001-02-03"}, {"action": "Expiration", "timestamp": " 2031-04-05 "},
        {"action": "expiration", "timestamp": "2032-01-01"}]}}
    got = ask(frame, answers.rdap_answers, json.dumps(carrier), json.dumps(network), "{}", "[]", "", None, '{"asn":"1",')
    assert got[0] == full(asn="64500", asn_descr="FJORD-TRANSIT", country="NO", contacts="Fjord Transit Desk; Harbour Hosting")
    assert got[1] == full(asn="64501", country="IS", expires="2031-04-05")
    assert all(one is None or one == full() for one in got[2:])


def test_values_that_say_nothing(frame):
    nothing = [0, 0.0, False, None, "", [], {}]
    texts = [json.dumps({"asn": v, "asn_description": v, "asn_country_code": v, "network": {"country": "IS"}}) for v in nothing]
    assert ask(frame, answers.rdap_answers, *texts) == [full(country="IS")] * len(nothing)
    assert ask(frame, answers.rdap_answers, '{"asn":"0","asn_country_code":"false"}') == [full(asn="0", country="false")]
    whois = json.dumps({"asn": 0, "asn_description": False, "nets": [{"country": 0, "description": 0, "name": "Quay"}, {"description": False, "name": 0}]})
    assert ask(frame, answers.whois_answers, whois) == [full(contacts="Quay")]
    assert ask(frame, answers.aggregator_answers, '{"success":1,"data":{"country":false}}') == [full()]
    rows = frame("i, location, registration", [("0", '{"country":{"name":0}}', '{"ip_whois":{"asn":0,"asn_description":false}}')])
    assert answers.service_answers(rows).first().answer.asDict() == full()


def test_object_contacts_shapes(column):
    texts = [
        json.dumps([{"contact": {"name": "Ines"}}, 7, {"contact": {"name": "Olaf"}}, {"contact": {"name": "Ines"}}, "text", None]),
        json.dumps({"A": {"contact": {"name": "\t"}}, "B": {"contact": {"name": "Quay"}}, "C": {"contact": []}}),
        "{}", "[]", None, '"text"', "text",
    ]
    assert column(object_contacts, texts) == ["Ines; Olaf", "Quay", "", "", "", "", ""]


def test_vcard_name(column):
    texts = ['["vcard", [["fn", {}, "text", "X"]]]', None, '["vcard", []]', '"nope"', '["vcard", [["fn", {}, "text"], ["fn", {}, "text", " Y "]]]', '["vcard"]']
    assert column(vcard_name, texts) == ["X", "", "", "", "Y", ""]


def card(name):
    return ["vcard", [["version", {}, "text", "4.0"], ["fn", {}, "text", name]]]


def test_aggregator(frame):
    data = {"country": "FO", "handle": "ISLE-1", "entities": [
        {"vcardArray": card("Isle Admin"), "entities": [{"vcardArray": card("Isle Night Shift"), "entities": ["text"]}]},
        {"vcardArray": card("Isle Admin")}, 5], "events": [{"eventAction": "expiration", "eventDate": "2030-06-07"}]}
    texts = [{"success": True, "data": data}, {"success": False, "data": data}, {"success": True, "data": {}}, {"success": True}]
    got = ask(frame, answers.aggregator_answers, *map(json.dumps, texts))
    assert got == [full(country="FO", contacts="Isle Admin; Isle Night Shift", expires="2030-06-07"), None, full(), None]


def test_entities_nested_to_any_depth_parents_first(frame):
    inner = {"vcardArray": card("depth 40")}
    for depth in range(39, 0, -1):
        inner = {"entities": [inner, {"vcardArray": card(f"after {depth}")}], "vcardArray": card(f"depth {depth}")}
    response = {"success": 1, "data": {"entities": [inner, "junk", {"handle": "no card"}]}}
    contacts = ask(frame, answers.aggregator_answers, json.dumps(response))[0]["contacts"].split("; ")
    assert contacts == [f"depth {i}" for i in range(1, 41)] + [f"after {i}" for i in range(39, 0, -1)]


def test_whois(frame):
    response = {"asn": "64502", "asn_description": "QUAYSIDE", "nets": [
        {"country": "SE", "description": "Quayside Networks\r\nPier 4\nLager 2", "name": "QN-1"}, "text",
        {"country": "DK", "description": "Quayside Networks"}, {"description": "", "name": "QN-BACKUP"}, {"name": None}, {}]}
    blank = {"asn": "1", "nets": [{"description": " \n "}]}
    got = ask(frame, answers.whois_answers, json.dumps(response), json.dumps(blank), '{"asn":"","nets":[]}')
    assert got[0] == full(asn="64502", asn_descr="QUAYSIDE", country="SE", contacts="Quayside Networks; QN-BACKUP")
    assert got[1] is None and got[2] == full()


def test_domain_whois(frame):
    text = """% comment: not a field
%
domain:  LIGHTHOUSE.RU
nserver: a.lighthouse.example.
ORG:\tLighthouse: Lamps & Sons
registrar: LAMP-REG
nserver: a.lighthouse.example.
state:  REGISTERED
paid-till:  2033-03-04T05:06:07Z
paid-till:  2044-01-01
"""
    got = ask(frame, answers.domain_answers, text, "", "nserver: b\nORG : a: b\norg:\nnserver:  b ", None)
    names = "Lighthouse: Lamps & Sons; LAMP-REG; a.lighthouse.example."
    assert got[0] == full(contacts=names, expires="2033-03-04T05:06:07Z")
    assert got[1] is None and got[2] == full(contacts="a: b; b") and got[3] is None


def test_domain_keys(column):
    keys = ["pier.ru", " PIER.RU. ", "пример.рф", "example.com", "ru", "8.8.8.8", "", None, "САЙТ.ДЕТИ"]
    assert column(domain_query, keys) == [
        "pier.ru", "pier.ru", "пример.рф".encode("idna").decode(), None, None, None, None, None, "сайт.дети".encode("idna").decode(),
    ]


def test_punycode_like_the_idna_codec(column):
    names = ["bücher.ru", "straße.ru", "пример.рф", "a..рф", "x" * 64 + "я.рф", "日本。ru", "ёлка.xn--p1ai", "plain.ru", "ａｂｃ.ru"]

    def codec(name):
        try:
            return name.encode("idna").decode("ascii")
        except UnicodeError:
            return name

    assert column(ascii_domain, names) == [codec(name) for name in names]


def test_service_replies_fail_independently(frame):
    geo, whois = '{"country":{"name":"US"}}', '{"ip_whois":{"asn":"AS1","asn_description":"D","objects":{"A":{"contact":{"name":"N"}}}}}'
    rows = frame("i, location, registration", [("0", geo, whois), ("1", geo, "<html>"), ("2", None, whois), ("3", "{}", "{}")])
    got = [row.answer.asDict() for row in answers.service_answers(rows).sort("i").collect()]
    named = full(asn="AS1", asn_descr="D", contacts="N")
    assert got == [{**named, "country": "US"}, full(country="US"), named, full()]


# -- many and deep entities --------------------------------------------------------


def entity(name, *inside):
    return {"vcardArray": ["vcard", [["fn", {}, "text", name]]], "entities": list(inside)}


def walked(entities):
    names = []
    for one in entities:
        names += [one["vcardArray"][1][0][3], *walked(one["entities"])]
    return names


def test_entities_of_any_form_come_parents_first(column):
    rng = random.Random(8)

    def tree(depth):
        number = rng.randrange(10**6)
        return entity(f'n{number} [{{"entities":', *[tree(depth - 1) for _ in range(rng.randrange(4) if depth else 0)])

    forests = [[tree(rng.randrange(6)) for _ in range(rng.randrange(5))] for _ in range(30)]
    chain = entity("last")
    for number in range(80):
        chain = entity(f"up{number}", chain)
    forests.append([entity("first"), chain])
    assert column(entity_contacts, [json.dumps(forest) for forest in forests]) == ["; ".join(dict.fromkeys(walked(forest))) for forest in forests]


def test_time_of_many_entities_follows_their_number(column):
    def seconds(n):
        text = json.dumps([entity(f"n{i}", entity(f"m{i}")) for i in range(n)])
        begin = time.perf_counter()
        assert column(entity_contacts, [text])[0].count(";") == 2 * n - 1
        return time.perf_counter() - begin

    seconds(10)
    assert seconds(8000) < 2.5 * seconds(4000) + 1


def test_whois_networks_are_parsed_once(frame):
    nets = [None, {"description": "0", "name": 0}, {"description": 0, "name": "0"}, {"description": False, "name": {}}, {"description": {"a": 1}}]
    expected = full(asn="1", contacts='0; {"a":1}')
    # The text among the objects is what takes the networks apart one by one.
    got = ask(frame, answers.whois_answers, *[json.dumps({"asn": "1", "nets": [*nets, *more]}) for more in ([], ["text"])])
    assert got == [expected, expected]
    plan = answers.whois_answers(frame("i, response", [])).selectExpr("answer")._jdf.queryExecution().analyzed().toString()
    assert plan.count("from_json") == 4
