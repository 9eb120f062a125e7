"""Runs, names, leaks and mixing against brute force, with their edge cases."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from turnloom.llm.fmindex import FMIndex, WaveletMatrix, suffix_array
from turnloom.llm.leaks import aligned, leaks, removal_spans
from turnloom.llm.mixing import invert, largest_exact, mixture, placed, plan, pour, reached, tilts
from turnloom.llm.names import LINKAGE, UNIT, agreement, average_linkage, clustered, components, entities, entity_pairs, parse_form, score, similar_pairs, top_partners
from turnloom.llm.runs import BOUNDARY, _distance, collapse_runs, one_slip, segment, speaker_runs


def test_segmentation_is_the_cheapest():
    rnd = random.Random(4)
    pool = ["anderson", "andersen", "andersn", "anderrson", "bob", "bobby", None]

    def price(keys, cuts):
        total = 0.0
        for a, b in zip(cuts, cuts[1:]):
            part = keys[a:b]
            total += BOUNDARY + min(sum(_distance(k, r) for k in part) for r in set(part))
        return total

    for _ in range(150):
        keys = [rnd.choice(pool) for _ in range(rnd.randrange(1, 8))]
        got = segment(keys)
        assert sorted(p for a, b, _ in got for p in range(a, b)) == [i for i, k in enumerate(keys) if k is not None]
        for live, group in itertools.groupby(range(len(keys)), key=lambda i: keys[i] is not None):
            idx = list(group)
            if live:
                part = keys[idx[0] : idx[-1] + 1]
                n = len(part)
                best = min(price(part, [0, *c, n]) for k in range(n) for c in itertools.combinations(range(1, n), k))
                mine = [a - idx[0] for a, b, _ in got if idx[0] <= a <= idx[-1]] + [n]
                assert price(part, mine) == pytest.approx(best)


def test_slips():
    assert one_slip("abcd", "abdc") and one_slip("abcd", "abcde") and one_slip("abcd", "abd") and one_slip("abcd", "abxd")
    assert not one_slip("abcd", "badc") and not one_slip("abcd", "ab")


def test_runs_across_cells(spark):
    rows = [("e", p, "anderson" if p != 57 else "andersn", p) for p in range(0, 400, 3)] + [("e", 500, None, 1), ("e", 501, "anderson", 2), (None, 1, "x", 1), ("e", None, "x", 1)]
    df = spark.createDataFrame(rows, "entity string, pos long, key string, second long")
    for cell in (10, 64, 10_000):
        got = {(r.first_pos, r.last_pos, r.n) for r in collapse_runs(df, cell).collect()}
        assert got == {(0, 399, 134), (501, 501, 1)}


def test_runs_are_the_same_wherever_cells_end(spark):
    rnd = random.Random(12)
    pool = ["anderson", "andersen", "andersn", "anderrson", "abcd", "dbca", "al", "bl", "bob", None]
    rows, at = [], {}
    for e in range(12):
        p = 0
        for _ in range(60):
            p += rnd.choice([1, 1, 1, 2, 30])
            rows.append((f"e{e}", p, rnd.choice(pool[:3] if rnd.random() < 0.6 else pool), rnd.choice([p * 7, None])))
            at.setdefault(f"e{e}", []).append(rows[-1])
    df = spark.createDataFrame(rows, "entity string, pos long, key string, second long")
    want = {(e, x[a][1], x[b - 1][1], b - a, x[a][3], x[b - 1][3], rep) for e, x in at.items() for a, b, rep in segment([r[2] for r in x])}
    for cell in (1, 7, 1024):
        got = [(r.entity, r.first_pos, r.last_pos, r.n, r.first_s, r.last_s, r.rep) for r in collapse_runs(df, cell).collect()]
        assert set(got) == want and len(got) == len(want), cell


def test_tied_positions_stay_apart_at_any_size(spark):
    tied = [("e", 5, "anderson", 0), ("e", 5, "bob", 1), ("e", 6, "bob", 2), ("far", -9, "carol", 0), ("far", 1, "carol", 1)]
    want = [("e", 5, 5, 1, "anderson"), ("e", 5, 6, 2, "bob"), ("far", -9, 1, 2, "carol")]
    for more, also in ([], []), ([("z", 1023, "dora", 0), ("z", 1024, "dora", 1), ("z", 5000, "dora", 2)], [("z", 1023, 5000, 3, "dora")]):
        df = spark.createDataFrame(tied + more, "entity string, pos long, key string, second long")
        assert sorted((r.entity, r.first_pos, r.last_pos, r.n, r.rep) for r in collapse_runs(df).collect()) == want + also


def test_speaker_runs(spark):
    rows = [("1", "g", 0, "Ann Robson", "23:59:00", 1), ("1", "g", 0, "Ann Robson", "23:59:00", 2), ("2", "g", 4, "ANN ROBSN (Guest)", "00:01:00", 1), ("3", "g", 5, "unknown", "00:02:00", 1), ("4", "g", 6, "Clip - Ann Robson", "00:03:00", 1), ("5", "g", None, "Ann Robson", "00:03:00", 1), ("6", None, 1, None, None, 1)]
    df = spark.createDataFrame(rows, "dialogue_id string, group_id string, order_index int, speaker string, broadcast_time string, loaded_at int")
    got = {(r.first_order, r.last_order, r.n_turns, r.duration_s) for r in speaker_runs(df).collect()}
    assert got == {(0, 4, 2, 120), (6, 6, 1, 0)}
    assert speaker_runs(df.limit(0)).count() == 0


def test_fm_index_finds_all():
    rnd = np.random.default_rng(1)
    text = np.concatenate((rnd.integers(1, 5, 400), np.tile([1, 2, 3], 60), [0]))
    assert [tuple(text[i:]) for i in suffix_array(text)] == sorted(tuple(text[i:]) for i in range(len(text)))
    fm = FMIndex(text, 5)
    pats = np.array(list(itertools.product(range(1, 5), repeat=3)))
    lo, hi = fm.search(pats)
    for p, a, b in zip(pats, lo, hi):
        want = [i for i in range(len(text) - 2) if tuple(text[i : i + 3]) == tuple(p)]
        assert sorted(fm.locate(np.arange(a, b)).tolist()) == want
    wm = WaveletMatrix(text, 3)
    at = np.arange(len(text))
    assert (wm.access(at)[0] == text).all() and (wm.rank(np.full(5, 3), np.array([0, 1, 50, 400, len(text)])) == [(text[:k] == 3).sum() for k in (0, 1, 50, 400, len(text))]).all()


WORDS = [f"w{i}" for i in range(4000)]


def test_leaks_match_what_was_planted(spark):
    rnd = random.Random(9)
    stock = "answer using only the text below"
    items = [(i, (stock + ". " if i % 2 else "") + " ".join(rnd.sample(WORDS, 30))) for i in range(12)]
    docs, want = [], set()
    for d in range(60):
        body = rnd.choices(WORDS, k=120)
        kind = d % 5
        it, words = d % 12, items[d % 12][1].replace(stock + ". ", "").split()
        if kind == 0:  # whole, with markup and case
            body[50:50] = [w.upper() if k % 3 else f"[[{w}]]<br/>" for k, w in enumerate(words)]
        elif kind == 1:  # half, with changed words
            part = words[5:23]
            part[6] = part[12] = "zzz"
            body[10:10] = part
        elif kind == 2:  # a few words in a row, and the stock instruction
            body[10:10] = stock.split() + words[3:9]
        if kind < 2:
            want.add((it, d))
        docs.append((d, " ".join(body)))
    docs += [(900, None), (901, ""), (902, "x")]
    dd = spark.createDataFrame(docs, "doc_id long, text string")
    ii = spark.createDataFrame([*items, (99, None), (98, "too short"), (97, ""), (96, " -- ")], "item_id long, text string")
    found = leaks(dd, ii)
    assert {(r.item_id, r.doc_id) for r in found.collect()} == want
    spans = {r.doc_id: (r.start_pos, r.end_pos) for r in removal_spans(found).collect()}
    text = dict(docs)
    for it, d in want:
        s, e = spans[d]
        assert dict(items)[it].split()[-8].lower() in text[d][s:e].lower() or d % 5 == 1
    assert leaks(dd, ii.limit(0)).count() == 0 and leaks(dd.limit(0), ii).count() == 0


def test_no_case_is_lost_before_the_alignment(spark):
    rnd = random.Random(21)
    pool = WORDS[:150]  # common words, so that phrases are shared by many items and documents
    items = [(i, " ".join(rnd.choices(pool, k=rnd.randrange(6, 40)))) for i in range(25)]
    docs = []
    for d in range(60):
        body = rnd.choices(pool, k=200)
        words = items[d % 25][1].split()
        for k in range(2, len(words), 3):
            words[k] = "zzz"  # every third word changed
        if d % 2:
            body[60:60] = words
        docs.append((d, " ".join(body)))
    found = {(r.item_id, r.doc_id): r.words for r in leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    vocab = {w: k for k, w in enumerate([*pool, "zzz"])}
    number = lambda t: np.array([vocab[w] for w in t.split()])
    want = {}
    for i, t in items:
        x = number(t)
        for d, b in docs:
            n = aligned(x, number(b))[0]
            if n >= max(5, -(-len(x) * 2 // 5)):
                want[i, d] = n
    assert found == want and len(want) > 20


def test_shared_passages_are_no_stock(spark):
    rnd = random.Random(3)
    stock, passage, copy = "Read the passage and choose the best answer. ", rnd.sample(WORDS[:2000], 40), rnd.sample(WORDS[2000:], 40)
    asked = [(i, stock + " ".join(passage) + f". {q} is meant here?") for i, q in enumerate(("Who", "What", "Where", "When"))]
    copies = [(10, " ".join(copy)), (11, " ".join(copy)), (12, " ".join(copy[:30]) + " changed at the end")]
    other = [(20 + i, stock + " ".join(rnd.sample(WORDS, 30))) for i in range(4)]
    docs = [(1, "before it " + " ".join(passage) + " after it"), (2, " ".join(copy[:30])), (3, stock + "and no more")]
    found = leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(asked + copies + other, "item_id long, text string"))
    rows = {(r.item_id, r.doc_id): r.of_words for r in found.collect()}
    assert set(rows) == {(i, 1) for i in range(4)} | {(i, 2) for i in (10, 11, 12)}
    assert {rows[i, 1] for i in range(4)} == {44} and rows[10, 2] == rows[11, 2] == 40


def test_pouring():
    s = [dict(source="a", target_share=0.5, tokens=100, max_repeats=1), dict(source="b", target_share=0.3, tokens=1000, max_repeats=2), dict(source="c", target_share=0.2, tokens=0, max_repeats=9)]
    assert largest_exact(s) == pytest.approx(160)
    assert pour(s, 160) == pytest.approx({"a": 100, "b": 60, "c": 0})
    assert pour(s, 1000) == pytest.approx({"a": 100, "b": 900, "c": 0})
    d = pour(s, 160)
    k, total = tilts(d), sum(d.values())
    assert sum(k[x] * d[x] / total for x in d) == pytest.approx(0)


def test_positions_invert_the_schedule(spark):
    df = spark.createDataFrame([(c / 10, k) for c in range(11) for k in (-0.5, 0.0, 0.5)], "c double, k double").withColumn("t", invert(F.col("c"), F.col("k")))
    for r in df.collect():
        assert (1 - r.k) * r.t + r.k * r.t**2 == pytest.approx(r.c)


def test_mixture(spark):
    docs = [(i, f"some words number {i} " * (1 + i % 7), "big" if i % 4 else "small") for i in range(400)] + [(900, None, "big"), (901, "x", None), (902, "y", "other")]
    targets = spark.createDataFrame([("big", 0.5, 1), ("small", 0.5, 3), ("none", 0.0, 1)], "source string, target_share double, max_repeats int")
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = mixture(df, targets).collect()
    assert [r.position for r in rows] == sorted(r.position for r in rows) and all(0 <= r.position <= 1 for r in rows)
    count = {}
    for r in rows:
        count[r.doc_id] = count.get(r.doc_id, 0) + 1
    assert max(count.values()) <= 3 and not {900, 901, 902} & set(count)
    rep = {r.source: r for r in reached(df, targets).collect()}
    assert rep["big"].actual_share == pytest.approx(0.5, abs=0.02) and rep["small"].most_copies == 3
    assert rep["other"].mixed_tokens == 0 and rep[None].mixed_tokens == 0 and rep["none"].target_share == 0.0
    tok = spark.createDataFrame([(i, "a", 10) for i in range(100)], "doc_id long, source string, n_tokens long")
    half = plan(tok, spark.createDataFrame([("a", 1.0, 2)], "source string, target_share double, max_repeats int"), total=500.0)
    for b in (1, 7):
        assert placed(tok, half, b).count() == 50
    assert mixture(df.limit(0), targets).count() == 0


def test_name_parts():
    assert parse_form("Clip - Ann Lee Robson (Guest):")[1] == ["ann", "lee", "robson"]
    assert parse_form("Robson, Ann")[1:] == (["ann", "robson"], "", True)
    assert parse_form("AnnRobson")[1] == ["ann", "robson"] and parse_form("Elizabeth “Liz” Robson")[2] == "liz"
    for nobody in ("Unknown", "Crowd", " ", None, "(Guest)", "..."):
        assert parse_form(nobody) is None
    p = lambda f, m, last, n="": ("person", f, m, last, n)
    assert agreement(p("liz", "", "robson"), p("elizabeth", "", "robson")) == 1.0
    assert agreement(p("e.", "", "robson"), p("elizabeth", "", "robson")) == 0.9
    assert agreement(p("ann", "", "robson"), p("elizabeth", "", "robson")) == -1.0
    assert agreement(("org", "board roe water", "", "", ""), ("org", "bd roe water", "", "", "")) == 0.9


def test_entities(spark):
    a = ["Elizabeth Robson", "Liz Robson", "ROBSON Elizabeth", "Robson, E.", "Elizabeth Robsn", "Elizabeth A. Robson", "Host / Elizabeth Robson"]
    b = ["Tariq Robson", "T. Robson", "Tariq  Robson", "Tariq Robson (Clip)"]
    c = ["The Roe Water Board", "Roe Water Board", "Water Board of Roe", "Roe's Water Board", "RoeWaterBoard", "Roe Wat. Board"]
    more = [f"{f} {s}" for f in ("Tariq", "Elizabeth", "Anselm", "Muriel") for s in ("Klenning", "Fostwick", "Garroway")]
    forms = [*a, *b, *c, "Unknown", "Crowd", " ", *more]
    df = spark.createDataFrame([(i, f, 1) for i, f in enumerate(forms)] + [(999, None, 1)], "name_id long, name_form string, entity int")
    got = {}
    for r in entities(df).collect():
        got.setdefault(r.entity, set()).add(forms[r.name_id])
    groups = list(got.values())
    assert set(a) in groups and set(b) in groups and set(c) in groups
    pairs = {(r.name_id_a, r.name_id_b) for r in entity_pairs(entities(df)).collect()}
    assert len(pairs) == 21 + 6 + 15 and all(x < y for x, y in pairs)
    assert entities(df.limit(0)).count() == 0


def test_similarity_join_is_exact(spark):
    rnd = random.Random(2)
    vec = {}
    for n in range(60):
        g = rnd.sample(range(25), 6)
        w = [rnd.random() + 0.1 for _ in g]
        norm = sum(x * x for x in w) ** 0.5
        vec[n] = {str(k): x / norm for k, x in zip(g, w)}
    rows = [(n, g, sum(g in v for v in vec.values()), w) for n, v in vec.items() for g, w in v.items()]
    df = spark.createDataFrame(rows, "node long, g string, df long, w double")
    for t in (0.3, 0.6):
        want = {(a, b) for a in vec for b in vec if a < b and sum(x * vec[b].get(g, 0) for g, x in vec[a].items()) >= t}
        for posting in (2048, 3):
            got = [(r.a, r.b) for r in similar_pairs(df, t, posting).collect()]
            assert set(got) == want and len(got) == len(want)


def test_linkage_is_average_linkage(spark):
    rnd = random.Random(6)
    n = 14
    s = {(a, b): rnd.choice([-UNIT, 0, rnd.randrange(UNIT), rnd.randrange(UNIT)]) for a in range(n) for b in range(a + 1, n)}
    clusters = [{i} for i in range(n)]
    avg = lambda x, y: sum(s[min(p, q), max(p, q)] for p in x for q in y) / (len(x) * len(y))
    while len(clusters) > 1:
        x, y = max(itertools.combinations(clusters, 2), key=lambda c: avg(*c))
        if avg(x, y) < LINKAGE * UNIT:
            break
        clusters = [c for c in clusters if c not in (x, y)] + [x | y]
    nodes = spark.createDataFrame([(i,) for i in range(n)], "node long")
    links = spark.createDataFrame([(a, b, v) for (a, b), v in s.items() if v], "a long, b long, s long")
    for found in (average_linkage(nodes, links), clustered(nodes, links), clustered(nodes, links, most=3)):
        got = {}
        for r in found.collect():
            got.setdefault(r.cluster, set()).add(r.node)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, clusters))


def test_components_by_task_or_by_joins_are_the_same(spark):
    rnd = random.Random(11)
    links = {}
    for c in range(30):  # chains and knots of several sizes
        for _ in range(rnd.randrange(1, 12)):
            a, b = sorted(rnd.sample(range(c * 10, c * 10 + 8), 2))
            links[a, b] = rnd.choice([-UNIT, UNIT // 2, UNIT // 2, UNIT])
    links[5, 25] = -UNIT
    df = spark.createDataFrame([(a, b, v) for (a, b), v in links.items()], "a long, b long, s long")
    nodes = spark.range(300).withColumnRenamed("id", "node")
    near = {}
    for (a, b), v in links.items():
        if v > 0:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    want = {}
    for x in near:
        seen, todo = {x}, [x]
        while todo:
            for y in near[todo.pop()] - seen:
                seen.add(y)
                todo.append(y)
        want[x] = min(seen)
    assert {r.node: r.comp for r in components(df.filter("s > 0")).collect()} == want
    whole, parts = ({(r.node, r.cluster) for r in clustered(nodes, df, most=m).collect()} for m in (10_000, 0))
    assert whole == parts and len(whole) == 300


def test_top_partners_lose_no_pair(spark):
    rows = [(a, b, round(1 - (a * 7 + b * 3) % 11 / 20, 3)) for a in range(9) for b in range(a + 1, 9)]
    pairs = spark.createDataFrame(rows, "a long, b long, cosine double")
    for n in (1, 3, 50):
        best, rest = top_partners(pairs, n)
        got, left = {(r.a, r.b) for r in best.collect()}, {(r.a, r.b) for r in rest.collect()}
        assert not got & left and got | left == {(a, b) for a, b, _ in rows}
        for x in range(9):
            mine = sorted((-c, a + b - x) for a, b, c in rows if x in (a, b))[:n]
            assert {tuple(sorted((x, y))) for _, y in mine} <= got


def test_short_forms():
    p = lambda f: ("person", f, "", "robson", "")
    assert agreement(p("m."), p("peggy")) == 0.9 and agreement(p("mar."), p("peggy")) == 0.9 and agreement(p("p."), p("peggy")) == 0.9
    assert agreement(p("peeggy"), p("margaret")) == 0.9 and agreement(p("t."), p("peggy")) == -1.0
    assert score(0.6, 1.0) == 800_000 and score(0.99, 0.0) == 0 and score(0.9, -1.0) == -UNIT
