import pytest

from flowtally.operators.aggregate import aggregate, merge_counts, ordered, threshold_report

COLUMNS = "SrcIP, DstIP, DstPort, ac_action, ac_rule_name, url_domain, url_path"
# Six groups with counts 3, 2, 2, 1, 1, 1.
ROWS = [
    ("10.2.83.10", "8.8.8.8", "443", "allow", "r1", "google.com", "/a"),
    ("10.2.83.10", "8.8.8.8", "443", "allow", "r1", "google.com", "/b"),
    ("10.2.83.10", "8.8.8.8", "443", "allow", "r1", "google.com", "/c"),
    ("10.2.83.9", "1.1.1.1", "53", "deny", "NA", "", "/"),
    ("10.2.83.9", "1.1.1.1", "53", "deny", "NA", "", "/"),
    ("10.2.83.10", "1.1.1.1", "53", "deny", "NA", "", "/"),
    ("10.2.83.10", "1.1.1.1", "53", "deny", "NA", None, "/"),
    ("10.2.83.9", "8.8.8.8", "", "allow", "r1", "", "/"),
    ("10.2.83.9", "8.8.8.8", "80", "allow", "r1", "", "/"),
    ("10.2.83.9", "8.8.8.8", "443", "allow", "r1", "", "/"),
]


def test_counts_and_order(frame):
    got = [tuple(row) for row in ordered(aggregate(frame(COLUMNS, ROWS))).collect()]
    assert got == [
        ("10.2.83.10", "8.8.8.8", "443", "allow", "google.com", "r1", 3),
        ("10.2.83.10", "1.1.1.1", "53", "deny", "", "NA", 2),
        ("10.2.83.9", "1.1.1.1", "53", "deny", "", "NA", 2),
        ("10.2.83.9", "8.8.8.8", "", "allow", "", "r1", 1),
        ("10.2.83.9", "8.8.8.8", "443", "allow", "", "r1", 1),
        ("10.2.83.9", "8.8.8.8", "80", "allow", "", "r1", 1),
    ]


@pytest.mark.parametrize("size", [1, 3, 7])
def test_any_chunking_gives_the_same_counts(frame, size):
    whole = aggregate(frame(COLUMNS, ROWS))
    chunks = [aggregate(frame(COLUMNS, ROWS[i : i + size])) for i in range(0, len(ROWS), size)]
    joined = chunks[0]
    for chunk in chunks[1:]:
        joined = joined.unionByName(chunk)
    assert ordered(merge_counts(joined)).collect() == ordered(whole).collect()
    assert ordered(merge_counts(joined, 2)).collect() == ordered(aggregate(frame(COLUMNS, ROWS), 2)).collect()


def test_only_present_columns_group(frame):
    given = frame("DstIP, SrcIP, count", [("a", "b", "7"), ("a", "b", "9")])
    assert [row.asDict() for row in aggregate(given).collect()] == [{"SrcIP": "b", "DstIP": "a", "count": 2}]
    with pytest.raises(ValueError, match="group by"):
        aggregate(frame("srcip, count", []))


def test_counts_read_back_from_text_are_added_up(frame):
    assert merge_counts(frame("SrcIP, count", [("a", "7"), ("a", "9")])).first()["count"] == 16


def test_threshold(frame):
    counted = aggregate(frame(COLUMNS, ROWS))
    assert aggregate(frame(COLUMNS, ROWS), 2).count() == 3
    assert aggregate(frame(COLUMNS, ROWS), 0).count() == 6
    assert tuple(threshold_report(counted, 2).first()) == (3, 3, 7, 3)


def test_no_rows(frame):
    assert aggregate(frame(COLUMNS, [])).columns[-1] == "count" and aggregate(frame(COLUMNS, [])).count() == 0
