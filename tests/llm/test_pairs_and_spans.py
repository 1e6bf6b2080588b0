"""Near-duplicates, repeated passages and decontamination against brute force."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import xxhash
from pyspark.sql import functions as F

from flowtally.llm import decontaminate, nearcopies, simhash, suffixdedup
from flowtally.llm.components import components
from flowtally.llm.fmindex import FMIndex, suffix_array
from flowtally.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def documents(spark, rows):
    """Rows ``(doc_id, text)`` beside columns that operators use inside."""
    listed = [(i, text, "u", "first_id", 1) for i, text in rows]
    return spark.createDataFrame(listed, "doc_id bigint, text string, key string, bits string, n int")


def some_texts(rng, count):
    pool = ["lamp", "quay", "Fjord", "sea", "ärger", "net", "rope", "tar"]
    texts = [" ".join(rng.choice(pool) for _ in range(rng.choice([0, 1, 3, 4, 30, 80]))) for _ in range(count)]
    for _ in range(count):
        words = rng.choice(texts).split(" ")
        words[rng.randrange(len(words))] = rng.choice(pool)
        texts.append(" ".join(words))
    return [*texts, "", " \t ", texts[0], texts[0], "a" * 300]


# -- components and fingerprints ---------------------------------------------------------


def groups_of(pairs):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in parent}


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(3)
    pairs = {
        "chain": [(i, i + 1) for i in range(60)],
        "star": [(50, i) for i in range(40)] + [(7, 7)],
        "random": [(rng.randrange(-40, 40), rng.randrange(-40, 40)) for _ in range(50)] * 2,
        "none": [(5, 5)],
    }[shape]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "u bigint, v bigint")).collect()}
    assert got == groups_of([p for p in pairs if p[0] != p[1]])


def expected_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", low) if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def test_fingerprint(monkeypatch):
    texts = [*some_texts(random.Random(1), 30), None, "A\x0bB\x0cc d e f"]
    assert [simhash.fingerprint(t and t.encode()) for t in texts] == [expected_fingerprint(t) for t in texts]
    monkeypatch.setattr(simhash, "SLICE", 7)
    assert [simhash.fingerprint(t and t.encode()) for t in texts] == [expected_fingerprint(t) for t in texts]


@pytest.mark.parametrize("tile", [2048, 16, 3])
def test_every_link_within_the_radius_is_found(spark, tile):
    rng = random.Random(tile)
    centres = [rng.getrandbits(64) for _ in range(12)]
    prints = set(centres)
    for centre in centres:  # clouds of close fingerprints, and chains of them
        for _ in range(25):
            prints.add(centre := centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 7))))
    prints = np.array(sorted(prints), np.uint64)
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 4
    pairs = [(int(a), int(b)) for a, b in prints.view(np.int64)[np.argwhere(np.triu(near, 1))]]
    frame = spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "bits bigint")
    units = simhash._units(frame, 4, tile).repartition("key", "a", "b").sortWithinPartitions("key", "a", "b")
    links = units.mapInArrow(simhash._link_batches(4), "u bigint, v bigint")
    got = {r.node: r.root for r in components(links).collect()}
    assert got == groups_of(pairs)


def test_near_duplicates_edge_cases(spark):
    rows = [(5, None), (3, ""), (9, "   "), (4, "x"), (4, "x"), (None, "x"), (7, "one two three four five six"), (7, "one two three four five six")]
    got = sorted(simhash.near_duplicates(documents(spark, rows)).collect(), key=repr)
    assert {(r.doc_id, r.component_id) for r in got} == {(5, 3), (3, 3), (9, 3), (4, 4), (None, 4), (7, 7)} and len(got) == 8
    assert simhash.near_duplicates(documents(spark, [])).count() == 0
    kept = simhash.keep_first(documents(spark, rows))
    assert kept.columns == ["doc_id", "text", "key", "bits", "n"]
    assert sorted(kept.select("doc_id").collect(), key=repr) == sorted([(3,), (4,), (7,), (None,)], key=repr)


def test_simhash_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    prints = {d.doc_id: expected_fingerprint(d.text) for d in docs}
    ids = sorted(prints)
    links = [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    group = groups_of(links)
    expected = {(i, f"{prints[i]:016x}", group.get(i, i)) for i in ids}
    assert {tuple(r) for r in QUERIES["op8_simhash"](spark, SF).collect()} == expected


# -- near copies -------------------------------------------------------------------------


def shingles_of(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def similarity_of(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("tile", [nearcopies.TILE, 400])
def test_planted_near_copies_go_and_others_stay(spark, tile):
    rng = random.Random(6)
    pool = ["".join(rng.choices("abcdefghij", k=4)) for _ in range(3000)]
    rows = []
    for base in range(60):  # copies of falling similarity, from about 0.97 to 0.6
        words = rng.choices(pool, k=rng.choice([100, 300]))
        rows.append((10 * base, " ".join(words)))
        for k in range(1, 6):
            copy = list(words)
            for at in rng.sample(range(len(words)), max(1, len(words) * k // 100)):
                copy[at] = rng.choice(pool)
            rows.append((10 * base + k, " ".join(copy)))
    sets = {i: shingles_of(t) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and similarity_of(sets[a], sets[b]) >= 0.8]
    planted = [(a, b) for a, b in links if similarity_of(sets[a], sets[b]) <= 0.95]
    assert len(planted) > 60 and len(links) < sum(1 for a in sets for b in sets if a < b and a // 10 == b // 10)
    group = groups_of(links)
    got = {r.doc_id: r.component_id for r in nearcopies.near_copies(documents(spark, rows), tile=tile).collect()}
    assert got == {i: group.get(i, i) for i in sets}
    kept = {r.doc_id for r in simhash.keep_first(documents(spark, rows)).collect()}
    assert kept == {i for i in sets if group.get(i, i) == i}


def test_fingerprints_find_near_copies_that_share_no_band(spark):
    rng = random.Random(10990)
    words = [f"{rng.getrandbits(32):x}" for _ in range(40)]
    copy = list(words)
    for at in (10, 25):
        copy[at] = f"{rng.getrandbits(32):x}"
    one, two = (nearcopies.shingles(" ".join(text).encode()) for text in (words, copy))
    assert not (nearcopies.band_keys(one) == nearcopies.band_keys(two)).any()
    assert (nearcopies.set_fingerprint(one) ^ nearcopies.set_fingerprint(two)).bit_count() == 3
    rows = [(1, " ".join(words)), (2, " ".join(copy)), (3, "quite another text of some words")]
    assert 0.5 < similarity_of(shingles_of(rows[0][1]), shingles_of(rows[1][1])) < 0.6
    kept = {s: sorted(r.doc_id for r in simhash.keep_first(documents(spark, rows), s).collect()) for s in (0.5, 0.6)}
    assert kept == {0.5: [1, 3], 0.6: [1, 2, 3]}


# -- repeated passages -------------------------------------------------------------------


def expected_removal(rows):
    first = {}
    for i, text in rows:
        data = (text or "").encode()
        for k in range(len(data) - 49):
            if i is not None:
                first[data[k : k + 50]] = min(first.get(data[k : k + 50], i), i)
    out = []
    for i, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for k in range(len(data) - 49):
            known = first.get(data[k : k + 50])
            if known is not None and (i is None or known < i):
                gone[k : k + 50] = True
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = int((gone[1:] < gone[:-1]).sum())
        out.append((i, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize(
    "options", [{}, {"chunk": 700, "bucket": 3000, "batch": 200}, {"chunk": 1500, "bucket": 2000, "crowded": 0}, {"crowded": 1, "chunk": 400}]
)
def test_repeated_passages_against_brute_force(spark, monkeypatch, options):
    rng = random.Random(11)
    alphabet = "abcdefgh ä☃"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.choice([0, 10, 49, 50, 51, 200, 900]))) for _ in range(25)]
    passages = ["".join(rng.choice(alphabet) for _ in range(n)) for n in (48, 49, 50, 51, 74, 75, 120)]
    for n in range(60):
        base = rng.choice(texts)
        cut = rng.randrange(len(base) + 1)
        texts.append(base[:cut] + rng.choice(passages) + base[cut + rng.choice([0, 0, 1, 30]) :])
    texts += ["a" * 500, "a" * 60 + "b", "ab" * 200, texts[3], texts[3]]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[40]), (None, texts[30]), (None, texts[30]), (500, None), (501, "")]
    rng.shuffle(rows)
    got = suffixdedup.repeated_passages(documents(spark, rows).repartition(3), **options)
    assert sorted(map(tuple, got.collect()), key=repr) == expected_removal(rows)


def sent_to_buckets(chunks, buckets, crowded):
    """Bytes of runs that each bucket gets from chunks of ``(ids, texts)``."""
    read, marks = [], []
    for number, (ids, texts) in enumerate(chunks):
        read.append((np.array(ids), np.array([len(t) for t in texts]), np.frombuffer(b"".join(texts), np.uint8)))
        batch = pa.RecordBatch.from_pydict({"chunk": [number], "data": [suffixdedup._packed(*read[-1])]})
        marks += suffixdedup._mark_batches(buckets)(iter([batch]))
    table, answers = pa.Table.from_batches(marks), [[] for _ in chunks]
    for bucket in set(table.column("bucket").to_pylist()):
        answer = suffixdedup._answer_marks(crowded)(table.filter(pc.equal(table.column("bucket"), bucket)))
        for row in answer.to_pylist():
            answers[row["chunk"]].append(row)
    sizes = np.zeros(buckets, np.int64)
    for data, replies in zip(read, answers):
        sent = suffixdedup._Sent(*data, replies, buckets)
        np.add.at(sizes, sent.bucket[sent.sample], sent.count[sent.sample] + suffixdedup.LENGTH - 1)
    return sizes


def test_a_phrase_in_every_document_is_spread():
    rng = random.Random(8)
    phrase = b"the very same words of forty or more bytes stand here"[:44]
    letters = bytes(range(97, 123))

    def text():
        return bytes(rng.choices(letters, k=40)) + phrase + bytes(rng.choices(letters, k=40))

    copy = text()  # copies are one run for each chunk, however many they are
    chunks = [([c * 1000 + i for i in range(200)], [text() if i % 2 else copy for i in range(200)]) for c in range(8)]
    whole, split = (sent_to_buckets(chunks, 64, crowded) for crowded in (1 << 30, 50))
    assert whole.max() > 0.3 * whole.sum()
    assert split.max() < 0.05 * split.sum()
    runs = suffixdedup.Runs(np.frombuffer(copy * 20, np.uint8), np.full(20, len(copy)))
    assert suffixdedup._different(runs, np.zeros(len(runs.first), np.int64), 1).tolist() == [len(runs.first) // 20]


def test_slices_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(suffixdedup, "SLICE", 64)
    rng = random.Random(2)
    data = np.array([rng.randrange(97, 100) for _ in range(2000)], np.uint8)
    runs = suffixdedup.Runs(data, np.array([700, 30, 0, 1270]))
    starts = np.concatenate([np.arange(a, a + n) for a, n in zip(runs.first, runs.count)])
    assert sorted(starts) == [*range(0, 651), *range(730, 730 + 1221)]
    assert runs.count.max() <= suffixdedup.STARTS and set(runs.doc) == {0, 3}


def test_rolled_hashes_tell_strings_apart():
    x = suffixdedup._RANDOM[np.frombuffer(b"abcabcabcabdabcabcabc", np.uint8)]
    for length in (1, 2, 3, 5, 7, 12):
        hashes = suffixdedup._rolled(x, length)
        texts = [b"abcabcabcabdabcabcabc"[i : i + length] for i in range(21 - length + 1)]
        assert len(hashes) == len(texts)
        assert {(a == b) for a, b in zip(np.equal.outer(hashes, hashes).ravel(), (x == y for x in texts for y in texts))} == {True}


def test_levels_stay_few_and_know_the_smallest():
    rng = np.random.default_rng(5)
    levels, known = suffixdedup.Levels(), {}
    for doc in range(64):
        keys = np.unique(rng.integers(0, 500, 40, np.uint64))
        expected = [known.get(int(k), suffixdedup.NO_ID) for k in keys]
        assert levels.smallest(keys).tolist() == expected
        levels.add(keys, np.full(len(keys), doc))
        for k in keys.tolist():
            known.setdefault(k, doc)
        assert len(levels.levels) <= 10


def test_passages_of_nothing(spark):
    assert suffixdedup.repeated_passages(documents(spark, [])).count() == 0
    got = suffixdedup.repeated_passages(documents(spark, [(2, "q" * 60), (1, "q" * 55)]), texts=True).collect()
    assert {(r.doc_id, r.kept, r.n_spans) for r in got} == {(1, b"q" * 55, 0), (2, b"", 1)}


def test_passages_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = QUERIES["op4_suffixdedup"](spark, SF).collect()
    assert sorted(map(tuple, got), key=repr) == expected_removal(rows)


# -- decontamination ---------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(4))
def test_fm_index_against_brute_force(seed):
    rng = np.random.default_rng(seed)
    text = rng.integers(1, 5, 300)
    text[100:180] = text[10:90]
    assert suffix_array(text).tolist() == sorted(range(300), key=lambda i: text[i:].tolist())
    index = FMIndex(text, 3)
    patterns = np.array([text[i : i + 4] for i in range(0, 296, 7)] + [[4, 4, 4, 4], [7, 7, 7, 7]])
    low, high = index.search(patterns)
    for pattern, a, b in zip(patterns, low, high):
        found = sorted(index.locate(np.arange(a, b)).tolist())
        assert found == [i for i in range(297) if (text[i : i + 4] == pattern).all()]


def test_spans_merge():
    starts, ends = decontaminate.merged_spans(np.array([5, 1, 9, 3, 20]), np.array([8, 4, 10, 5, 30]))
    assert list(zip(starts, ends)) == [(1, 8), (9, 10), (20, 30)]


ITEMS = [(1, "one two three four five six seven eight nine ten eleven twelve"), (2, "Short ITEM"), (3, ""), (4, None), (5, "... !!"), (6, "short item"), (None, "lost words here")]


def found_in(spark, texts, items=ITEMS, **options):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, spans string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    rows = decontaminate.contamination(docs, bench).collect()
    return {r.doc_id: (r.n_words, [(s.start, s.end) for s in r.spans], r.items) for r in rows}


TEXTS = [
    "zero One-two, three four FIVE six seven eight nine ten! end",
    "one two three four five six seven eight nine",
    "a short-item short item b",
    None,
    "",
    "lost words\nhere " + "ten eleven twelve",
    "one two three four five six seven eight nine ten eleven twelve " * 2,
]
FOUND = {
    0: (12, [(1, 11)], ["1"]),
    1: (9, [], []),
    2: (6, [(1, 5)], ["2", "6"]),
    3: (0, [], []),
    4: (0, [], []),
    5: (6, [(0, 3)], ["null"]),
    6: (24, [(0, 24)], ["1"]),
}


def test_contamination_cases(spark):
    assert found_in(spark, TEXTS) == FOUND
    assert found_in(spark, []) == {}
    assert found_in(spark, TEXTS[:2], []) == {0: (12, [], []), 1: (9, [], [])}


@pytest.mark.parametrize("limits", [{"SHARD": 3}, {"BLOCK_CHARS": 40}])
def test_contamination_in_parts(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(decontaminate, name, value)
    if "BLOCK_CHARS" in limits:
        blocks = decontaminate.benchmark_blocks
        monkeypatch.setattr(decontaminate, "benchmark_blocks", lambda bench, _size: blocks(bench, 40))
    assert found_in(spark, [*TEXTS, TEXTS[0]]) == {**FOUND, 7: FOUND[0]}


def test_cleaning_cuts_passages_and_keeps_the_rest(spark):
    docs = spark.createDataFrame([(i, t, "en", len(t or "")) for i, t in enumerate(TEXTS)], "doc_id bigint, text string, lang string, n_chars bigint")
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = {r.doc_id: (r.text, r.n_chars) for r in decontaminate.cleaned(docs, bench).collect()}
    assert got == {0: ("zero ! end", 10), 1: (TEXTS[1], len(TEXTS[1])), 2: ("a  b", 4), 3: (None, 0), 4: ("", 0), 5: (" ten eleven twelve", 18)}


def test_cleaned_text_has_no_passage_left(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    before = decontaminate.contamination(docs, bench).where(F.size("spans") > 0).count()
    clean = decontaminate.cleaned(docs, bench)
    assert before > 0 and clean.count() <= docs.count()
    assert docs.join(decontaminate.contamination(docs, bench).where(F.size("spans") == 0), "doc_id").count() <= clean.count()


def test_blocks_of_the_benchmark_change_nothing(spark):
    """Crossing windows, repeated and missing ids, words that would meet across a cut."""
    rng = random.Random(17)
    vocabulary = [f"w{i}" for i in range(30)]
    chain = [rng.choice(vocabulary) for _ in range(400)]
    items = [(rng.choice([None, i, i % 5]), " ".join(chain[a : a + rng.randrange(3, 25)])) for i, a in enumerate(range(0, 380, 7))]
    items += [(90, "w1 w2"), (91, None), (92, ""), (93, "w3 w4")]
    texts = []
    for i in range(60):
        a = rng.randrange(380)
        texts.append(f"{' '.join(chain[a : a + rng.randrange(40)])}, W{i % 30} w1 x{i} w2 {' '.join(chain[i * 3 : i * 3 + 12])} w3, w4")
    rows = [(rng.choice([None, 1, 2, i]), t, "en", len(t or ""), 3) for i, t in enumerate([*texts, *texts[:9], None, ""])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, n_chars bigint, row int").repartition(3)
    bench = spark.createDataFrame(items, "item_id bigint, text string")

    def found(block_chars):
        listed = decontaminate.contamination(docs, bench, block_chars=block_chars).collect()
        return sorted(((r.doc_id, r.n_words, [tuple(s) for s in r.spans], r.items) for r in listed), key=repr)

    def clean(block_chars):
        frame = decontaminate.cleaned(docs, bench, block_chars=block_chars)
        assert frame.schema == docs.schema
        return sorted(map(tuple, frame.collect()), key=repr)

    assert len(list(decontaminate.benchmark_blocks(bench, 200))) > 10
    assert found(200) == found(1 << 20) and any(r[2] for r in found(200))
    assert clean(200) == clean(1 << 20) and len(clean(200)) > 0
    assert decontaminate.cleaned(docs.limit(0), bench, block_chars=200).count() == 0
