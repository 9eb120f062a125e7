"""Sessions, timestamps and row checks against brute force, with their edge cases."""

import datetime as dt
import itertools
import random
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from turnloom.operators.rowcheck import clean_rows, row_errors
from turnloom.operators.sessions import double_pointers, sessions
from turnloom.operators.timestamps import _step, clip_moments, viterbi_choice


def brute_sessions(rows, gap):
    out, by = set(), {}
    for k, t in rows:
        if k is not None and t is not None:
            by.setdefault(k, set()).add(t)
    for k, ts in by.items():
        ts = sorted(ts)
        run = [ts[0]]
        for t in ts[1:]:
            if t - run[-1] > gap:
                out.add((k, run[0], run[-1], len(run)))
                run = []
            run.append(t)
        out.add((k, run[0], run[-1], len(run)))
    return out


@pytest.mark.parametrize("gap", [300, 1])
def test_sessions_match_a_loop(spark, gap):
    rnd = random.Random(gap)
    rows = [(rnd.choice(["a", "b", None]), rnd.randrange(-20_000, 60_000)) for _ in range(400)] + [("hot", t * 250) for t in range(500)] + [("a", None)]
    got = sessions(spark.createDataFrame(rows, "key string, t long"), "key", "t", gap)
    assert {(r.key, r.start, r.end, r.n_events) for r in got.collect()} == brute_sessions(rows, gap)


def test_sessions_of_nothing(spark):
    assert sessions(spark.createDataFrame([], "u long, t long"), "u", "t").count() == 0


def test_pointers_find_the_root_of_a_long_chain(spark):
    chain = spark.createDataFrame([(1, i, max(0, i - 1)) for i in range(100)], "key long, node long, parent long")
    assert {r.root for r in double_pointers(chain).collect()} == {0}


CHANNELS = [(1, "A (One)", "Europe/London", "dmy"), (2, "B (Two)", "America/New_York", "mdy")]


def moments(spark, rows):
    clips = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "clip_id long, broadcast_date string, broadcast_time string, channel_name string")
    ch = spark.createDataFrame(CHANNELS, "channel_id long, channel_name string, home_zone string, date_order string")
    return {r.clip_id: r for r in clip_moments(clips, ch).collect()}


def test_moments(spark):
    utc = lambda *x: int(dt.datetime(*x, tzinfo=dt.timezone.utc).timestamp())
    cases = [
        (("03/04/2025", "1:05 PM", "A (One)"), utc(2025, 4, 3, 12, 5)),
        (("03/04/2025", "1:05 PM", "b  (two)"), utc(2025, 3, 4, 18, 5)),
        (("2025-07-01", "8:03 PM GMT", " A (ONE)"), utc(2025, 7, 1, 20, 3)),
        (("1. Juni 2025", "14:00:00 +0200", "A (One)"), utc(2025, 6, 1, 12)),
        (("5 août 2025", "3.02am", "A (One)"), utc(2025, 8, 5, 2, 2)),
        (("Mon, March 3, 2025", "1819h", "B (Two)"), utc(2025, 3, 3, 23, 19)),
        (("20250101", "1736865840960", "A (One)"), 1736865840),
        (("2025-01-02", "2025-01-02T03:04:05Z", "B (Two)"), utc(2025, 1, 2, 3, 4, 5)),
        (("2025-01-02", "9:00 AM EST", "B (Two)"), utc(2025, 1, 2, 14)),
        (("2025-07-02", "9:00 AM ET", "B (Two)"), utc(2025, 7, 2, 13)),
        (("2025-03-30", "01:30:00", "A (One)"), None),  # never
        (("2025-10-26", "01:30:00", "A (One)"), None),  # twice
        (("31/02/25", "10:00", "A (One)"), None),
        (("2025-01-02", "13:05 PM", "A (One)"), None),
        (("2025-01-02", "25:10", "A (One)"), None),
        (("2025-01-02", "0:30 AM", "A (One)"), None),
        ((None, "10:00", "A (One)"), None),
        (("2025-01-02", "  ", "A (One)"), None),
    ]
    got = moments(spark, [c[0] for c in cases])
    for i, (text, want) in enumerate(cases):
        one = got[i].utc if got[i].n_moments == 1 else None
        assert one == want, text
    assert got[11].n_moments == 2 and got[11].utc is not None
    assert got[10].no_moment == "skipped_by_clock_change" and got[13].no_moment == "no_time" and got[12].no_moment == "no_date"


def test_every_home_wall_time_round_trips(spark):
    zone, start = ZoneInfo("Europe/London"), dt.datetime(2025, 10, 25, tzinfo=dt.timezone.utc)
    at = [start + dt.timedelta(minutes=37 * i) for i in range(80)]
    rows = [((x.astimezone(zone)).strftime("%Y-%m-%d"), x.astimezone(zone).strftime("%H:%M"), "A (One)") for x in at]
    got = moments(spark, rows)
    for i, x in enumerate(at):
        if got[i].n_moments == 1:
            assert got[i].utc == int(x.timestamp())
        else:
            assert dt.datetime(2025, 10, 26, tzinfo=dt.timezone.utc) <= x < dt.datetime(2025, 10, 26, 2, tzinfo=dt.timezone.utc)


def test_viterbi_is_the_cheapest_path(spark):
    rnd = random.Random(7)
    rows, chains = [], {}
    for src in "xyz":
        chain = []
        for p in range(14):
            c = [(rnd.choice("fgh"), 1000 * p + rnd.randrange(-3000, 3000)) for _ in range(rnd.choice([1, 2, 2, 3]))]
            chain.append(c)
            rows.append((src, p, c))
        chains[src] = chain
    df = spark.createDataFrame(rows, "src string, pos long, readings array<struct<fmt:string,utc:long>>")
    for block in (4, 1000):
        got = {(r.src, r.pos): (r.format, r.utc) for r in viterbi_choice(df, "src", "pos", block=block).collect()}
        for src, chain in chains.items():
            named = [[{"fmt": f, "utc": u} for f, u in c] for c in chain]
            price = lambda path: sum(_step([named[i][a]], [named[i + 1][b]])[0, 0] for i, (a, b) in enumerate(zip(path, path[1:])))  # noqa: B023, E731
            best = min(price(p) for p in itertools.product(*[range(len(c)) for c in chain]))
            mine = [chain[p].index(got[src, p]) for p in range(14)]
            assert price(mine) == pytest.approx(best)


def test_rows_that_fail(spark):
    good = '2025-01-02,9:00 AM,Title,A (One),some text'
    lines = {
        "Broadcast Date,Broadcast Time": "header", good: None, "﻿" + good + "\r": None, '"2025-01-02","9:00 AM",,"A (One)","a ""quoted"" word, and\nmore"': None,
        '2025-01-02,9:00 AM,T,"A (One)"x,text': "quoting", '2025-01-02,9:00 AM,T,A,"no end': "quoting", 'a,b,c,d,say \\"no\\" more': "quoting", '2025-01-02,9:00 AM,T,A,text "x': "quoting",
        "2025-01-02,9:00 AM,T": "column_count", "2025-01-02,9:00 AM,T,A,b,c": "column_count", "": "column_count",
        "31/02/25,9:00 AM,T,A (One),text": "value", "2025-01-02,13:05 PM,T,A (One),text": "value", '2025-01-02,9:00 AM,T,A (One)," "': "value", "13/25/2025,9:00,T,Nowhere,text": "value",
        "25/12/2025,9:00,T,Nowhere,text": None,
    }
    raw = spark.createDataFrame([(i, "f", 1 if v == "header" else i + 2, k) for i, (k, v) in enumerate(lines.items())] + [(99, "f", 50, None)], "raw_id long, file_name string, line_no int, raw_line string")
    ch = spark.createDataFrame(CHANNELS, "channel_id long, channel_name string, home_zone string, date_order string")
    got = {r.raw_id: r.reason for r in row_errors(raw, ch).collect()}
    want = {i: v for i, v in enumerate(lines.values()) if v not in (None, "header")} | {99: "column_count"}
    assert got == want
    clean = clean_rows(raw, ch)
    assert clean.filter("raw_id = 3").first().plain_text == 'a "quoted" word, and\nmore'
    assert {r.raw_id for r in clean.select("raw_id").collect()} == {i for i, v in enumerate(lines.values()) if v is None}
    assert row_errors(raw.limit(0), ch).count() == 0
    odd = [(i, "f", 2, f'2025-01-02,9:00 AM,"T, {x}",A (One),"one, {x}two{x}"') for i, x in enumerate(("\x1f", "\x1f\x1e", "\x1f\x1e\ue000", "\ue000", "\ue000" * 9))]
    loaded = clean_rows(spark.createDataFrame(odd, "raw_id long, file_name string, line_no int, raw_line string"), ch).orderBy("raw_id").collect()
    assert [r.plain_text for r in loaded] == [x[3].split(',"')[-1][:-1] for x in odd] and [r.program_title for r in loaded] == [x[3].split('"')[1] for x in odd]


def test_few_values_are_worked_out_once_and_many_row_by_row(spark):
    from turnloom.runtime import by_value

    df = spark.createDataFrame([(i, i % 5 if i % 7 else None, "x") for i in range(60)], "id long, a long, b string")
    add = lambda d: d.withColumn("c", F.coalesce(F.col("a"), F.lit(-1)) * 2)
    want = sorted(map(tuple, add(df).collect()))
    for most in (100, 3):
        assert sorted(map(tuple, by_value(df, ["a", "b"], add, most).select("id", "a", "b", "c").collect())) == want


def test_extra_columns_that_clash(spark):
    clips = spark.createDataFrame([(1, "2025-01-02", "10:00", "A (One)", 5, "x")], "clip_id long, broadcast_date string, broadcast_time string, channel_name string, channel_id int, utc string")
    ch = spark.createDataFrame(CHANNELS, "channel_id long, channel_name string, home_zone string, date_order string")
    r = clip_moments(clips, ch).select("channel_id", "utc", F.lit(1)).first()
    assert (r.channel_id, r.utc) == (1, 1735812000)


def test_names_of_long_texts_are_tagged():
    from turnloom.inference.stages import capital_tagger

    for n in (0, 1, 447, 479, 480, 509, 510, 511, 512, 513, 1400):
        (tokens, labels), = capital_tagger(["word " * n + "Ann Robson spoke " + "word " * 600 + "Tom Lee"])
        assert len(tokens) == len(labels) == n + 605
        assert [i for i, x in enumerate(labels) if x == "B-PER"] == [n, n + 603] and [i for i, x in enumerate(labels) if x == "I-PER"] == [n + 1, n + 604]
