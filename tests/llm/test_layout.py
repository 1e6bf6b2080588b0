"""Mixing, sharding, quotation linking and the pipeline."""

import hashlib
import heapq
import math
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from flowtally.llm import decontaminate, mixing, quotes, sharding, toxicity
from flowtally.llm.common import start_positions
from flowtally.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def documents(spark, rows):
    """Rows ``(doc_id, text, source)`` beside columns that operators use inside."""
    listed = [(*row, 1, "x", "y", 2) for row in rows]
    return spark.createDataFrame(listed, "doc_id bigint, text string, source string, slot int, src string, bucket string, shard int")


def spread(doc_id):
    return hashlib.md5(("null" if doc_id is None else str(doc_id)).encode()).hexdigest()


def test_positions_within_groups(spark):
    rng = random.Random(1)
    rows = [(rng.choice("abbb"), rng.randrange(5), rng.randrange(100), rng.randrange(9)) for _ in range(300)]
    frame = spark.createDataFrame(rows, "g string, b int, o int, s int")
    expected = []
    for group in "ab":
        at = 0
        for n, row in enumerate(sorted(r for r in rows if r[0] == group)):
            expected.append((*row, n, at))
            at += row[3]
    numbered = start_positions(start_positions(frame, ["g"], "b", ["o", "s"], "n"), ["g"], "b", ["o", "s", "n"], "at", "s")
    got = sorted(map(tuple, numbered.select("g", "b", "o", "s", "n", "at").collect()))
    assert got == sorted(expected)


# -- mixing ------------------------------------------------------------------------------


def expected_mixture(rows, weights, block, slots):
    sources = defaultdict(list)
    for doc_id, text, source in rows:
        sources["missing" if source is None else f"={source}"].append((spread(doc_id), hashlib.md5((text or "").encode()).hexdigest(), doc_id))
    names = sorted(s for s in sources if s in weights)
    total = sum(weights[s] for s in names)
    parts = [max(1, math.floor(weights[s] / total * slots + 0.5)) for s in names]
    q, blocks = sum(parts), [-(-len(sources[s]) // block) for s in names]
    for name in names:
        sources[name].sort()
    given, out, t = [0] * len(names), [], 0
    while any(g < b for g, b in zip(given, blocks)):
        ready = [((given[i] + 1) * q + parts[i] - 1) // parts[i] for i in range(len(names))]
        i = min((d, i) for i, d in enumerate(ready) if given[i] * q // parts[i] <= t)[1]
        assert all(abs(given[k] - parts[k] * t / q) < 1 for k in range(len(names)))
        epoch, b = divmod(given[i], blocks[i])
        for n, (_, _, doc_id) in enumerate(sources[names[i]][b * block : (b + 1) * block]):
            out.append((doc_id, names[i], epoch, b, t, t * block + n))
        given[i], t = given[i] + 1, t + 1
    return out


@pytest.mark.parametrize(
    "block, slots, given, segment",
    [
        (1, 10, None, 1 << 17),
        (3, 7, None, 2),
        (4, 1000, {"a": 1, "b": 5, None: 2, "zz": 9}, 3),
        (2, 12, {"c": 3}, 1),
        (1, mixing.PARTS, {"a": 1, "b": 0.11, None: 0.04, "c": 0.37}, 8),
        (1, mixing.PARTS, None, 1 << 17),
    ],
)
def test_mixing_against_a_simulation(spark, block, slots, given, segment):
    rng = random.Random(block)
    rows = [(i, f"t{i}", rng.choice(["a", "a", "a", "a", "b", "c", None])) for i in range(70)] + [(3, "t3", "a"), (3, "t3", "a"), (None, None, "b")]
    counts = defaultdict(int)
    for *_, source in rows:
        counts["missing" if source is None else f"={source}"] += 1
    weights = {s: n**mixing.TEMPERATURE for s, n in counts.items()}
    if given is not None:
        weights = {"missing" if s is None else f"={s}": w for s, w in given.items()}
    got = mixing.mix(documents(spark, rows), given, block, slots, segment)
    found = [(r.row.doc_id, r.src, r.epoch, r.block, r.slot, r.position) for r in got.collect()]
    assert sorted(found, key=repr) == sorted(expected_mixture(rows, weights, block, slots), key=repr)
    if given is None:
        assert {r[0] for r in found} == {r[0] for r in rows}


def test_mixture_comes_in_order_with_its_columns(spark):
    rows = [(i, "t", f"s{i % 4}") for i in range(200)]
    got = mixing.mixed(documents(spark, rows))
    assert got.columns == documents(spark, []).columns and {r.doc_id for r in got.collect()} == set(range(200))
    order = [(r.doc_id, r.epoch) for r in mixing.mix(documents(spark, rows)).select("row.doc_id", "epoch", "position").orderBy("position").collect()]
    assert [r.doc_id for r in got.collect()] == [i for i, _ in order]


def test_mixing_nothing_and_many_sources(spark):
    assert mixing.mixed(documents(spark, [])).count() == 0
    assert mixing.mixed(documents(spark, [(1, "t", "s")]), {"other": 1.0}).count() == 0
    rows = [(i, "t", f"s{i % 2100}") for i in range(2300)]  # once 2,000 sources were the limit
    got = mixing.mix(documents(spark, rows), None, 1).select("row.doc_id", "src", "slot", "length").collect()
    assert {r.doc_id for r in got} == set(range(2300)) and sorted(r.slot for r in got) == list(range(got[0].length))


def whole_schedule(totals, block, slots):
    """Earliest deadline first from slot 0 to the end, by exact integers."""
    names = sorted(totals)
    weights = [totals[s] ** mixing.TEMPERATURE for s in names]
    parts = [max(1, math.floor(w / sum(weights) * slots + 0.5)) for w in weights]
    q, given, out = sum(parts), [0] * len(names), []
    blocks = [-(-totals[s] // block) for s in names]
    waiting, ready = [(0, i) for i in range(len(names))], []
    while any(g < b for g, b in zip(given, blocks)):
        while waiting and waiting[0][0] <= len(out):
            i = heapq.heappop(waiting)[1]
            heapq.heappush(ready, (-((given[i] + 1) * q // -parts[i]), i))
        i = heapq.heappop(ready)[1]
        out.append((names[i], given[i], len(out)))
        given[i] += 1
        heapq.heappush(waiting, (given[i] * q // parts[i], i))
    return out


@pytest.mark.parametrize("segment", [100, 1 << 17])
@pytest.mark.parametrize("hot, mid, small", [(90_000, 5, 40), (30_000, 60, 2), (3_000, 1, 0)])
def test_segments_join_into_one_schedule_within_a_block(spark, segment, hot, mid, small):
    totals = {"=hot": hot, **{f"=mid{i}": 2_000 + 37 * i for i in range(mid)}, **{f"=small{i}": 20 + i for i in range(small)}}
    counts = spark.createDataFrame(list(totals.items()), "src string, total bigint")
    got = sorted(mixing.schedule(counts, segment=segment).select("slot", "src", "turn").collect())
    assert [(r.src, r.turn, r.slot) for r in got] == whole_schedule(totals, mixing.BLOCK, mixing.PARTS)
    weights = {s: n**mixing.TEMPERATURE for s, n in totals.items()}
    total, given = sum(weights.values()), defaultdict(int)
    for t, r in enumerate(got, 1):
        given[r.src] += 1
        if t % 97 == 0 or t == len(got):
            assert all(abs(given[s] - t * weights[s] / total) < 1 for s in totals)
    assert all(given[s] * mixing.BLOCK >= totals[s] for s in totals)


def test_mixture_follows_the_weights_themselves(spark):
    # Of 1000 slots, the small sources would get one each: 14 times their share.
    weights = {"hot": 1.0, **{f"s{i}": 0.00002 for i in range(40)}}
    docs = documents(spark, [(i, "t", "hot") for i in range(6000)] + [(10_000 + i, "t", f"s{i}") for i in range(40)])
    places = mixing.mix(docs, weights, 1).select("slot", "src", "length").collect()
    slots, length = sorted((r.slot, r.src) for r in places), places[0].length
    assert [s for s, _ in slots] == list(range(length))
    total = sum(weights.values())
    for source, weight in weights.items():
        assert abs(sum(src == f"={source}" for _, src in slots) - length * weight / total) < 1
    assert len({src for _, src in slots}) == 41
    assert mixing.mixed(docs, weights).count() > 6000


# -- sharding ----------------------------------------------------------------------------


def expected_shard(doc_id, leaves):
    key = "null" if doc_id is None else str(doc_id)

    def pick(weights):
        def draw(name):
            u = (int(hashlib.md5(f"{key}/{name}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
            return -math.log(u) / weights[name], name

        return min(map(draw, weights))[1]

    def sums(level, inside):
        out = defaultdict(float)
        for leaf in leaves:
            if inside(leaf) and leaf[3] > 0:
                out[f"shard{leaf[2]}" if level == 2 else leaf[level]] += leaf[3]
        return out

    region = pick(sums(0, lambda leaf: True))
    rack = pick(sums(1, lambda leaf: leaf[0] == region))
    return int(pick(sums(2, lambda leaf: leaf[1] == rack))[5:])


def test_shards_against_a_simulation(spark):
    rows = [(i, "tä" * (i % 5), "s") for i in range(400)] + [(7, "tä" * 2, "s"), (7, "other", "s"), (None, None, None), (None, "", None)]
    got = sharding.sharded(documents(spark, rows)).collect()
    leaves = sharding.tree()
    assert all((r.shard, r.grown_shard) == (expected_shard(r.doc_id, leaves), expected_shard(r.doc_id, sharding.grown(leaves))) for r in got)
    sizes = sorted((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, t, _ in rows)
    assert sorted((r.size, r.text_crc32) for r in got) == sizes
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.law == "key" and r.grown_shard in (r.shard, 40)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.sharded(documents(spark, [])).count() == 0


def test_a_change_of_weight_moves_rows_only_into_or_out_of_its_subtree(spark):
    leaves = sharding.tree(16)
    ids = spark.range(3000).select(F.col("id").cast("string").alias("k"))

    def placed(tree):
        return {r.k: r.s for r in ids.select("k", sharding.shard_of(F.col("k"), tree).alias("s")).collect()}

    before = placed(leaves)
    heavy = placed([(*leaf[:3], 3.0) if leaf[2] == 5 else leaf for leaf in leaves])
    light = placed([(*leaf[:3], 0.0) if leaf[2] == 5 else leaf for leaf in leaves])
    region = {s: leaf[0] for leaf in leaves for s in [leaf[2]]}
    for k, s in before.items():
        # Outside the region of shard 5 rows stay, or move between the region and outside.
        assert heavy[k] == s or region[heavy[k]] == region[5]
        assert light[k] == s or region[s] == region[5]
    share = sum(s == 5 for s in heavy.values()) / 3000
    assert abs(share - 3 / 18) < 0.03 and 5 not in light.values()
    with pytest.raises(ValueError):
        sharding.shard_of(F.lit("x"), [("r", "k", 0, 0.0)])


# -- quotations --------------------------------------------------------------------------


def test_quotes_are_linked_and_removed(spark):
    first = "Shall we meet at the quay on Monday?\nBring the long rope."
    second = "> Shall we meet  at the QUAY on monday?\n\nYes, at nine in the morning."
    third = "On Sunday, Ada wrote:\n> > Shall we meet at the quay on Monday?\n>\n> Yes, at nine in the morning.\nNine is too early for me."
    fourth = ">> Yes, at nine in the morning.\n> Nine is too early for me.\nThen ten."
    rows = [
        (1, 0, "user", first), (1, 1, "user", second), (1, 2, "user", third), (1, 3, "user", fourth),
        (1, 4, "user", "> nobody ever wrote this line\nMine."), (1, 5, "user", "> Then ten.\nToo short a quote."),
        (2, 0, "user", "> Bring the long rope.\nAnother conversation."), (2, 1, "user", None), (2, 2, "user", ""),
        (2, None, "user", "No turn at all here"), (None, 0, "user", "Nine is too early for me."), (2, 2, "user", ""),
        (3, 4, "user", "> see you there then\nx"), (3, 9, "user", "See you there then"),
    ]
    frame = spark.createDataFrame([(*r, "z") for r in rows], "conv_id bigint, turn bigint, role string, text string, own string")
    listed = quotes.linked(frame).collect()
    got = {(r.conv_id, r.turn): (r.text, r.reply_to, r.thread, r.n_passages, r.max_level) for r in listed}
    assert len(listed) == len(rows)
    assert got[1, 0] == (first, None, 0, 0, 0)
    assert got[1, 1] == ("Yes, at nine in the morning.", 0, 0, 1, 1)
    assert got[1, 2] == ("Nine is too early for me.", 1, 0, 2, 2)
    assert got[1, 3] == ("Then ten.", 2, 0, 2, 2)
    assert got[1, 4] == ("Mine.", None, 4, 1, 1) and got[1, 5] == ("Too short a quote.", 3, 0, 1, 1)
    assert got[2, 0] == ("Another conversation.", None, 0, 1, 1)
    assert got[2, 1] == (None, None, 1, 0, 0) and got[2, None][2] is None
    assert got[3, 4][1] is None and got[3, 9][1] is None  # only earlier turns are answered
    order = [(r.thread, r.turn) for r in listed if r.conv_id == 1]
    assert order == sorted(order)
    assert quotes.linked(frame.limit(0)).count() == 0


def test_plain_conversations_keep_their_turns(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet").collect()
    got = QUERIES["op10_quotes"](spark, SF).collect()
    assert sorted((r.conv_id, r.turn, r.role, r.text) for r in got) == sorted((r.conv_id, r.turn, r.role, "\n".join(line.strip(" ") for line in r.text.split("\n")).strip()) for r in rows)
    assert [(r.conv_id, r.turn) for r in got] == sorted((r.conv_id, r.turn) for r in rows)


# -- pipeline ----------------------------------------------------------------------------


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("labels", "benchmark"))
    score = {r.doc_id: r.score for r in toxicity.scores(docs, toxicity.fit(docs, labels)).collect()}
    clean = {r.doc_id: r for r in docs.collect() if score[r.doc_id] < 0.3}
    sets = {}
    for i, r in clean.items():
        words = re.findall("[^ \t\n\v\f\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text))
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()

    def alike(a, b):
        return len(a & b) >= 0.8 * len(a | b) if a and b else not a and not b

    group = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and alike(sets[a], sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(group[a], group[b])
            changed |= group[a] != group[b]
            group[a] = group[b] = low
    left = {i: r for i, r in clean.items() if group[i] == i}
    items = decontaminate.phrases([(str(r.item_id), r.text) for r in bench.collect()])
    windows = {tuple(row.tolist()) for rows in items.by_length.values() for row in rows}
    texts = {}
    for i, r in left.items():
        words = [items.vocabulary.get(w, 2) for w in decontaminate.words(r.text.encode())]
        hit = {k + j for n in items.by_length for k in range(len(words) - n + 1) if tuple(words[k : k + n]) in windows for j in range(n)}
        spans = [(k, next(e for e in range(k, len(words) + 1) if e not in hit)) for k in sorted(hit) if k - 1 not in hit]
        texts[i] = decontaminate.cut_words(r.text, spans)
    places = expected_mixture(
        [(i, t, left[i].source) for i, t in texts.items() if decontaminate.words(t.encode())],
        defaultdict(int, {f"={s}": n**mixing.TEMPERATURE for s, n in count_by(left[i].source for i, t in texts.items() if decontaminate.words(t.encode())).items()}),
        mixing.BLOCK,
        mixing.PARTS,  # the stage follows the weights themselves
    )
    leaves = sharding.tree()
    expected = sorted((i, len(texts[i].encode()) + 16, zlib.crc32(texts[i].encode()), expected_shard(i, leaves)) for i, *_ in places)
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.size, r.text_crc32, r.shard) for r in got) == expected
    assert corpus_pipeline.ORACLE_SQL is None and [n for n, _ in corpus_pipeline.STAGES][0] == "toxicity"


def count_by(values):
    out = defaultdict(int)
    for v in values:
        out[v] += 1
    return out


def test_the_last_stage_takes_odd_tables(spark):
    rows = [(1, None, None, None, None, 9), (None, "", None, None, 3, 9), (2, "w " * 20000, "en", "s", 40000, 9), (2, "w " * 20000, "en", "s", 40000, 9)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, shard int"
    _, step = corpus_pipeline.STAGES[-1]
    got = step(spark, spark.createDataFrame(rows, schema), SF).collect()
    assert sorted((r.doc_id or 0, r.size, r.text_crc32) for r in got) == [(0, 16, 0), (1, 16, 0), *[(2, 40016, zlib.crc32(("w " * 20000).encode()))] * 2]
    assert all(0 <= r.shard < 40 and r.law == "key" for r in got)
    assert step(spark, spark.createDataFrame([], schema), SF).count() == 0


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES) - 1))
def test_stages_take_odd_tables(spark, stage):
    rows = [(1, None, None, None, None, "z"), (None, "", None, None, 3, "z"), (2, "w " * 20000, "en", "s", 40000, "z"), (2, "w " * 20000, "en", "s", 40000, "z")]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string"
    _, step = corpus_pipeline.STAGES[stage]
    for given in (rows, []):
        out = step(spark, spark.createDataFrame(given, schema), SF)
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "row"]
        assert out.count() >= bool(given)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_against_their_sql(spark, name):
    from pathlib import Path

    import duckdb

    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    result = con.execute(ORACLES[name])
    names = [c[0] for c in result.description]
    frame = QUERIES[name](spark, SF)
    assert sorted(names) == sorted(frame.columns)
    assert sorted(map(tuple, frame.select(*names).collect()), key=repr) == sorted(result.fetchall(), key=repr)


def test_core_operators_run_no_python_in_tasks(spark):
    for name in ("op1_mixing", "op3_linededup", "op9_sharding", "op10_quotes"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan


# -- generated threads ---------------------------------------------------------------------


def plain_threads(messages):
    """reply_to by the rule as it is written, from the structure the messages were made with."""
    squeeze = lambda t: " ".join(t.lower().split())
    replies = {}
    for conv in {c for c, *_ in messages}:
        earliest = {}
        for c, turn, own, _ in sorted((m for m in messages if m[0] == conv), key=lambda m: m[1]):
            for text in ["\n".join(own), *own]:
                if squeeze(text):
                    earliest.setdefault(squeeze(text), turn)
        for c, turn, _, passages in (m for m in messages if m[0] == conv):
            found = defaultdict(dict)
            for level, lines in passages:
                for text in {squeeze(" ".join(lines)), *map(squeeze, lines)} - {""}:
                    if earliest.get(text, turn) < turn:
                        found[level, earliest[text]].setdefault(level, []).append(len(text.split(" ")))
            best = max(((-level, sum(map(sum, words.values())), source) for (level, source), words in found.items()), default=None)
            replies[conv, turn] = best and best[2]
    return replies


def test_quotes_of_generated_threads(spark):
    rng = random.Random(21)
    words = ["rope", "quay", "sea", "at", "nine", "漢字のような文", "Да", "ok", "the tide", "x" * 30]
    messages, rows = [], []
    for conv in range(60):
        lines_of, used = {}, set()
        for turn in range(rng.randrange(1, 12)):
            own = [f"{' '.join(rng.choice(words) for _ in range(rng.randrange(1, 5)))} {conv}-{turn}-{k}" if rng.random() < 0.8 else f"ok{conv}.{turn}.{k}" for k in range(rng.randrange(1, 4))]
            passages, text = [], []
            for level in rng.sample([1, 2, 3], rng.randrange(3)) if turn else []:
                source = rng.randrange(turn)
                quoted = lines_of[source] if rng.random() < 0.8 else ["never written by anyone"]
                passages.append((level, quoted))
                text += [f"On day {turn}, someone wrote:"] * (rng.random() < 0.3)
                text += ["> " * level + (line.upper() if rng.random() < 0.2 and line.isascii() else f"  {line}  ") for line in quoted]
            lines_of[turn] = own
            messages.append((conv, turn, own, passages))
            rows.append((conv, turn, "user", "\n".join([*text, *own])))
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(4)
    expected = plain_threads(messages)
    got = {(r.conv_id, r.turn): r for r in quotes.linked(frame).collect()}
    assert {k: r.reply_to for k, r in got.items()} == expected
    assert sum(v is not None for v in expected.values()) > 100
    for (conv, turn), r in got.items():
        first = turn
        tied = {turn}
        while True:
            more = {a for (c, a), b in expected.items() if c == conv and b is not None and (a in tied or b in tied)}
            more |= {expected[conv, a] for a in tied if expected[conv, a] is not None}
            if more <= tied:
                break
            tied |= more
        assert r.thread == min(tied | {first})


def test_a_conversation_named_missing_is_no_missing_one(spark):
    rows = [("missing", 0, "user", "hello there"), (None, 1, "user", "> hello there\nhi"), ("missing", 2, "user", "> hello there\nho")]
    got = {(r.conv_id, r.turn): r.reply_to for r in quotes.linked(spark.createDataFrame(rows, "conv_id string, turn bigint, role string, text string")).collect()}
    assert got == {("missing", 0): None, (None, 1): None, ("missing", 2): 0}
