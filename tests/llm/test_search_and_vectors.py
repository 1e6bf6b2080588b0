"""Personal data, embedding whitening and ranked search."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from flowtally.llm import lexical, personal, whitening
from flowtally.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"

# -- personal data -------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    return personal.train(personal.labelled_texts())


def plain_base(text):
    """The contract's patterns as they are written, each in a search of its own."""
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits[::-1])]
        if 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0:
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def test_base_patterns_against_plain_ones():
    rng = random.Random(3)
    pieces = ["a", "b.c", "@", ".", "-", "1", "25", "256", "0255", "+", " ", "(", ")", "é", "4111111111111111", "x@y.z", "1.2.3.4", "+49 30 1234567", "%", "_"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 14)))
        assert personal.base_spans(text) == plain_base(text), text
    assert personal.base_spans("") == []


def test_long_runs_take_no_longer_than_they_are():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" + " " * 300_000, "a@" * 100_000, "+1 " * 100_000):
        personal.base_spans(text)


def test_stretches_are_apart_and_hold_every_mark():
    rng = random.Random(5)
    for _ in range(500):
        text = " ".join(rng.choice(["ab", "c", "7", "x@y", "dot", "éé", "9-9"]) if rng.random() < 0.5 else "word" for _ in range(rng.randrange(30)))
        last = -1
        covered = set()
        for a, b in personal.stretches(text):
            assert a > last
            last = b
            covered.update(range(a, b))
        assert all(i in covered for i, c in enumerate(text) if c in "79@")


def best_by_trying(emissions, follow):
    """The best labels by keeping every way's score, a token at a time."""
    ways = {0: (0.0, [])}
    for row in emissions:
        ways = {k: max(((s + follow[j, k] + row[k], [*path, k]) for j, (s, path) in ways.items()), key=lambda x: x[0]) for k in range(len(row))}
    return max(((s + follow[j, 0], path) for j, (s, path) in ways.items()), key=lambda x: x[0])[1]


@pytest.mark.parametrize("block", [1, 2, 5, 64])
def test_viterbi_in_blocks(model, block):
    rng = np.random.default_rng(block)
    starts = np.array([0, 1, 3, 20, 21])
    emissions = rng.normal(size=(60, personal.LABELS))
    expected = [k for a, b in zip(starts, [*starts[1:], 60]) for k in best_by_trying(emissions[a:b], model.follow)]
    assert personal.viterbi(emissions, starts, model.follow, block).tolist() == expected


def test_found_in_texts_not_trained_on(model):
    rows = personal.labelled_texts(6, seed=77)
    found = personal.added_spans([t for t, _ in rows], [[] for _ in rows], model)
    truth = [{(a, personal.KINDS.index(k), b) for k, a, b in spans} for _, spans in rows]
    right = sum(len(t & set(f)) for t, f in zip(truth, found))
    assert right / sum(map(len, truth)) > 0.8
    assert right / sum(map(len, found)) > 0.9


def test_what_the_patterns_miss(model):
    texts = ["phone (555) 123-4567 und", "12 4111111111111111 ou", "write to jane [at] example [dot] com now", "from 2001:db8:1:2:3:4:5:6 port 22", "on 2024-05-17 at 12:30, ou", ""]
    base = [personal.base_spans(t) for t in texts]
    added = personal.added_spans(texts, base, model)
    listed = [[(personal.KINDS[k], t[a:b]) for a, k, b in spans] for t, spans in zip(texts, added)]
    assert listed == [
        [("phone", "(555) 123-4567")], [("card", "4111111111111111")], [("email", "jane [at] example [dot] com")], [("ip", "2001:db8:1:2:3:4:5:6")], [], []
    ]


def test_personal_query_and_odd_rows(spark, model):
    rows = [(1, "x a@b.co y", "u"), (1, "x a@b.co y", "u"), (None, "call +49 30 1234567", "u"), (2, None, "u"), (3, "", None), (4, "né 1.2.3.4 " + "ab " * 50_000, "u")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, spans string")
    got = sorted(map(tuple, personal.report(personal.find(docs, model)).collect()), key=repr)
    empty = hashlib.sha256(b"").hexdigest()

    def row(doc_id, counts, spans):
        return (doc_id, *counts, hashlib.sha256(spans.encode()).hexdigest(), spans)

    assert got == sorted(
        [row(1, (1, 0, 0, 0), "email:2:8"), row(1, (1, 0, 0, 0), "email:2:8"), row(None, (0, 0, 0, 1), "phone:5:19"), (2, 0, 0, 0, 0, empty, ""), (3, 0, 0, 0, 0, empty, ""),
         row(4, (0, 1, 0, 0), "ip:3:10")], key=repr,
    )
    assert personal.report(personal.find(docs.limit(0), model)).collect() == []
    replaced = {r.text for r in personal.redacted(docs.where("doc_id = 1 OR doc_id IS NULL"), model).collect()}
    assert replaced == {"x [email] y", "call [phone]"}


def test_personal_query_counts(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op11_personal"](spark, SF).collect():
        base = plain_base(texts[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == kind for _, k, _ in base) for kind in range(4))
        assert r.base_sha256 == personal.digest(base)
        listed = r.spans.split(",") if r.spans else []
        assert {f"{personal.KINDS[k]}:{a}:{b}" for a, k, b in base} <= set(listed)


def test_a_model_of_nothing(spark):
    empty = personal.fit(personal.examples(spark).limit(0))
    assert personal.added_spans(["call (555) 123-4567"], [[]], empty) == [[]]


# -- whitening -------------------------------------------------------------------------------


def expected_whitening(vectors, weights=None, components=16):
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    fit, copies = np.unique(x, axis=0, return_counts=True)
    w = copies if weights == "copies" else np.ones(len(fit), np.int64)
    n, s = int(w.sum()), (fit * w[:, None]).sum(0)
    z = (fit * n - s) / n
    v = (z * w[:, None]).T @ z / n
    e, axes = np.linalg.eigh(v)
    e, axes = e[::-1][:components], axes[:, ::-1][:, :components]
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for row in x]
    return n, deviation, (x * n - s) / n @ axes / np.sqrt(e), e / np.trace(v)


@pytest.mark.parametrize("weigh", [False, True])
def test_whitening_against_numpy(spark, weigh):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(40, 6)) * [5, 4, 3, 2, 1, 0.5]
    vectors = [base[i].tolist() for i in [*range(40), *[0] * 30, 1, 1]]
    rows = [(i, v, "a", 7) for i, v in enumerate(vectors)]
    odd = [(100, None, "a", 7), (101, [1.0, None, 0.0, 0.0, 0.0, 0.0], "a", 7), (102, [float("nan")] * 6, "a", 7), (103, [float("inf")] + [0.0] * 5, "a", 7), (104, [], "a", 7)]
    frame = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<double>, x string, copies int")
    got = whitening.whiten(frame, weigh, 4).toPandas().sort_values(["vec_id", "component"])
    n, deviation, z, share = expected_whitening(vectors, "copies" if weigh else None, 4)
    assert len(got) == 4 * len(vectors) and set(got.n) == {n} and got.component.tolist() == [1, 2, 3, 4] * len(vectors)
    assert got.deviation.tolist() == [d for d in deviation for _ in range(4)]
    mine = got.whitened.to_numpy().reshape(-1, 4)
    signs = np.sign((mine * z).sum(0))
    assert np.allclose(mine * signs, z, rtol=1e-9, atol=1e-9) and np.allclose(got.explained.to_numpy().reshape(-1, 4), share, rtol=1e-9)
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-9


def test_whitening_of_odd_tables(spark):
    kind = "vec_id bigint, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], kind)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], kind)).collect() == []
    # A space for each length; one direction only has variance; ids may be missing or repeated.
    rows = [(None, [0.0, 0.0]), (5, [1.0, 1.0]), (5, [2.0, 2.0]), (6, [3.0]), (7, [5.0]), (8, [1e30])]
    got = whitening.whiten(spark.createDataFrame(rows, kind)).toPandas()
    two, one = got[got.n == 3], got[got.vec_id.isin([6, 7])]
    assert len(two) == 6 and set(two.component) == {1} and len(one) == 2
    assert sorted(two.whitened.round(6)) == sorted([-1.224745, 0.0, 1.224745] + [*one.whitened.round(6), *got[got.vec_id == 8].whitened.round(6)])
    assert got[got.vec_id == 8].deviation.isna().all()


def test_whitening_query(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas().sort_values("vec_id")
    got = QUERIES["op12_whitening"](spark, SF).toPandas().sort_values(["vec_id", "component"])
    n, deviation, z, share = expected_whitening(rows.embedding.tolist())
    mine = got.whitened.to_numpy().reshape(len(rows), 16)
    assert np.allclose(np.abs(mine), np.abs(z), rtol=1e-7, atol=1e-9)
    assert got.deviation.tolist()[::16] == deviation and got.identity_error.iloc[0] < 1e-9


# -- ranked search -----------------------------------------------------------------------------


def plain_terms(text):
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def expected_ranking(docs, items, top):
    counted = [(doc_id, Counter(plain_terms(text))) for doc_id, text in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, length = len(counted), sum(c.total() for _, c in counted)
    holding = Counter(t for _, c in counted for t in c)
    rows = []
    for item_id, text in items:
        scored = []
        for doc_id, c in counted:
            m = 25 + 75 * c.total() * n_docs // length
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in plain_terms(text) if t in c
            )
            if score > 0:
                scored.append((-score, doc_id is not None, doc_id or 0, doc_id))
        rows += [(item_id, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scored)[:top], 1)]
    return sorted(rows, key=repr)


def some_documents(rng, n):
    words = ["Alpha", "beta", "Ünder", "ünder", "ß", "42", "x_y", "中文", "end."] + [f"w{i}" for i in range(60)]
    rows = [(rng.randrange(3 * n), " ".join(words[int(rng.paretovariate(0.6)) % len(words)] for _ in range(rng.randrange(1, 40)))) for _ in range(n)]
    return [*rows, *rows[:7], (None, "alpha beta w1"), (None, "w1 w2"), (1, None), (2, ""), (3, " ... "), (4, "w1 " * 400_000 + "w7")]


@pytest.mark.parametrize("shard,block_chars", [(50, 100), (1 << 21, 4 << 20)])
def test_search_against_all_scores(spark, shard, block_chars):
    rng = random.Random(shard)
    docs = some_documents(rng, 200)
    items = [(i, " ".join(rng.choice(docs[:200])[1].split()[:15])) for i in range(12)] + [(3, "W7 w7 w7"), (None, "alpha, BETA"), (20, None), (21, ""), (22, "nowhere")]
    made = spark.createDataFrame([(*d, "c", 1) for d in docs], "doc_id bigint, text string, terms string, n int").repartition(3)
    wanted = spark.createDataFrame([(*i, 2) for i in items], "item_id bigint, text string, score int")
    got = lexical.search(made, wanted, 5, block_chars, shard)
    assert sorted(map(tuple, got.collect()), key=repr) == expected_ranking(docs, items, 5)


def test_search_in_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert lexical.search(docs.limit(0), items).collect() == []
    assert lexical.search(docs, items.limit(0)).collect() == []
    assert lexical.search(docs.where("false"), items.where("false")).collect() == []


def test_best_positions_stop_early():
    """A short list that ends lets reading stop before the long one is read, with a right result."""
    rng = np.random.default_rng(6)
    n = 50_000
    rare = np.sort(rng.choice(n, 20, replace=False))
    holders = np.concatenate([np.arange(n), rare])
    order = np.argsort(holders, kind="stable")
    terms = np.concatenate([np.zeros(n, int), np.ones(20, int)])[order]
    index = lexical.Shard(rng.integers(30, 300, n), holders[order], terms, np.ones(n + 20, np.int64), 2)
    weights = np.array([100, 9000])
    docs, scores, depth = index.best(np.array([0, 1]), weights, 10)
    every = np.zeros(n, np.int64)
    np.add.at(every, index.doc, weights[np.repeat([0, 1], [n, 20])] * index.impact)
    assert sorted(scores)[-10:] == sorted(every)[-10:] and depth < 1000
    assert set(np.flatnonzero(every >= np.sort(every)[-10])) <= set(docs.tolist())


def test_best_position_is_deeper_than_the_last_read():
    """Direct accesses mark positions that reading has not come to: two lists of the same order."""
    n = 5000
    holders = np.repeat(np.arange(n), 2)
    index = lexical.Shard(np.arange(n) + 26, holders, np.tile([0, 1], n), np.ones(2 * n, np.int64), 2)
    _, _, depth = index.best(np.array([0, 1]), np.array([5, 5]), 10)
    assert depth == lexical.FIRST_DEPTH
