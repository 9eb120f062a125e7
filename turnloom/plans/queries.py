"""One query per operator of the engine, over the driver's tables, with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnloom.functions import ids, units
from turnloom.functions.text import clamp01, is_blank, null_if_empty, ws_trim
from turnloom.operators import ingest, people, relational, state, stitching, verdicts, windows
from turnloom.runtime import read
from turnloom.schemas import migrate
from turnloom.sources.sinks import numbered_final

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


# Shared pieces of the twins.
_WS = r"[\s\x{A0}]+"
TRIM = lambda c: f"regexp_replace({c}, '^[\\s\\x{{A0}}\\x{{200B}}\\x{{FEFF}}]+|[\\s\\x{{A0}}\\x{{200B}}\\x{{FEFF}}]+$', '', 'g')"
LATEST = "d AS (SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY dialogue_id ORDER BY loaded_at DESC) k FROM dialogues) WHERE k = 1)"
SOD = lambda c: f"(CASE WHEN regexp_full_match({c}, '\\d{{2}}:\\d{{2}}:\\d{{2}}') THEN CAST(substr({c},1,2) AS INT)*3600 + CAST(substr({c},4,2) AS INT)*60 + CAST(substr({c},7,2) AS INT) END)"
WINDOWED = f"""{LATEST},
g AS (SELECT *, {SOD('broadcast_time')} AS sod FROM "grouped" WHERE group_id IN (SELECT group_id FROM d)),
g1 AS (SELECT *, CASE WHEN sod - lag(sod) OVER w <= 300 THEN 0 WHEN lag(group_id) OVER w IS NULL THEN 1 WHEN sod - lag(sod) OVER w > 300 THEN 1 ELSE 1 END AS nw,
  row_number() OVER w AS pos FROM g WINDOW w AS (PARTITION BY broadcast_date, channel_name ORDER BY broadcast_time, group_id)),
win AS (SELECT *, CAST(sum(nw) OVER (PARTITION BY broadcast_date, channel_name ORDER BY broadcast_time, group_id) AS BIGINT) AS win FROM g1),
t AS (SELECT w.broadcast_date, w.channel_name, w.win, w.group_id, w.pos, w.broadcast_time, coalesce(d.order_index,-1) AS oi, d.dialogue_id, d.dialogue, d.speaker
  FROM win w JOIN d ON d.group_id = w.group_id)"""
CLIPS = f"""c0 AS (SELECT *, row_number() OVER (PARTITION BY broadcast_date, broadcast_time, channel_name ORDER BY clip_id) k FROM clips),
c1 AS (SELECT clip_id AS ord, {TRIM('broadcast_date')} AS broadcast_date, {TRIM('broadcast_time')} AS broadcast_time, {TRIM('program_title')} AS program_title,
  {TRIM('channel_name')} AS channel_name, {TRIM('plain_text')} AS plain_text FROM c0 WHERE k = 1),
c2 AS (SELECT *, CAST(coalesce(CASE WHEN length(broadcast_date)=10 THEN coalesce(try_strptime(broadcast_date,'%Y-%m-%d'), try_strptime(broadcast_date,'%Y/%m/%d')) END,
  CASE WHEN length(broadcast_date)=8 THEN try_strptime(broadcast_date,'%Y%m%d') END) AS DATE) AS bdate,
  nullif(regexp_extract(broadcast_time, '(\\d{{1,2}}:\\d{{2}}\\s(?:AM|PM))', 1), '') AS ct FROM c1),
c3 AS (SELECT *, TRY_CAST(split_part(ct, ':', 1) AS INT) AS h, TRY_CAST(regexp_extract(ct, ':(\\d+)', 1) AS INT) AS m FROM c2),
c AS (SELECT ord, bdate, program_title, channel_name, plain_text, broadcast_time,
  CASE WHEN h BETWEEN 1 AND 12 AND m <= 59 THEN (h % 12 + CASE WHEN ct LIKE '%PM' THEN 12 ELSE 0 END)*3600 + m*60 END AS sod FROM c3)"""
KEPT = f"""{CLIPS},
s AS (SELECT *, {SOD('start_time')} AS a, {SOD('end_time')} AS b FROM news_schedule),
k AS (SELECT c.*, CASE WHEN bdate IS NOT NULL THEN dayname(bdate) END AS dn FROM c),
kept AS (SELECT * FROM k WHERE bdate IS NULL OR sod IS NULL
  OR NOT EXISTS (SELECT 1 FROM s WHERE s.day_name = k.dn AND s.channel_name = k.channel_name)
  OR EXISTS (SELECT 1 FROM s WHERE s.day_name = k.dn AND s.channel_name = k.channel_name AND k.sod BETWEEN s.a AND s.b))"""
GROUPS = lambda gap: f"""{CLIPS},
i0 AS (SELECT * FROM c WHERE bdate IS NOT NULL AND channel_name IS NOT NULL AND sod IS NOT NULL),
i1 AS (SELECT *, CASE WHEN sod - lag(sod) OVER w <= {gap} THEN 0 ELSE 1 END AS nw FROM i0 WINDOW w AS (PARTITION BY channel_name, bdate ORDER BY sod, ord)),
i2 AS (SELECT *, sum(nw) OVER (PARTITION BY channel_name, bdate ORDER BY sod, ord) AS island FROM i1),
i3 AS (SELECT *, (row_number() OVER (PARTITION BY channel_name, bdate, island ORDER BY sod, ord) - 1) // 5 AS part FROM i2),
mg AS (SELECT channel_name, bdate, min(sod) AS sod, first(program_title ORDER BY sod, ord) AS program_title, count(*) AS n_clips,
  coalesce(string_agg(plain_text, ' ' ORDER BY sod, ord), '') AS plain_text FROM i3 GROUP BY channel_name, bdate, island, part)"""  # noqa: E731
CLOCK = lambda c: f"(lpad(CAST({c}//3600 AS VARCHAR),2,'0')||':'||lpad(CAST(({c}%3600)//60 AS VARCHAR),2,'0')||':'||lpad(CAST({c}%60 AS VARCHAR),2,'0'))"
UUID = lambda key, ns="6ba7b8109dad11d180b400c04fd430c8": (
    f"(SELECT substr(h,1,8)||'-'||substr(h,9,4)||'-5'||substr(h,14,3)||'-'||substr('89ab', (instr('0123456789abcdef', substr(h,17,1))-1)%4+1, 1)||substr(h,18,3)||'-'||substr(h,21,12) "
    f"FROM (SELECT sha1(unhex('{ns}') || encode({key})) AS h))"
)
GAP = 1800  # seconds; minute gaps of the sample hardly ever fill a group


def VOC(src: str, name: str, text: str) -> str:  # noqa: N802
    """CTEs ``vq, vc``: ``src`` with ``voc``, whether the name stands in the text only where it is addressed."""
    n, piece, after = TRIM(name), TRIM("q[i]"), TRIM("q[i+1]")
    x = f"(CASE WHEN {piece} <> '' THEN right({piece}, 1) WHEN i > 1 THEN right(vn, 1) ELSE '' END)"
    y = f"(CASE WHEN {after} <> '' THEN left({after}, 1) WHEN i + 1 < len(q) THEN left(vn, 1) ELSE '' END)"
    ok = f"(({x} = ',' AND {y} IN ('','.','!','?',',')) OR ({x} IN ('','.','!','?') AND {y} = ','))"
    quoted = "regexp_replace(vn, '([\\\\.\\[\\]{}()*+?^$|\\-])', '\\\\\\1', 'g')"
    return (
        f"vp AS (SELECT *, {n} AS vn FROM {src}), vq AS (SELECT *, regexp_split_to_array({text}, '(?i)\\b'||{quoted}||'\\b') AS q FROM vp), "
        f"vc AS (SELECT * EXCLUDE (q, vn), coalesce(vn <> '' AND len(q) > 1 AND list_bool_and(list_transform(range(1, len(q)), lambda i: {ok})), false) AS voc FROM vq)"
    )


# Sentence pieces of punctuated groups: a segment begins at a speaker mark and between a question and what is none.
_SENTENCES = f"string_split(regexp_replace({TRIM('p')}, '([.!?])[\\s\\x{{A0}}]+', '\\1'||chr(1), 'g'), chr(1))"
PIECES = lambda over: f"""s00 AS (SELECT *, {over} AS v FROM "grouped" WHERE punctuation_source IS NOT NULL),
s0 AS (SELECT group_id, program_id, broadcast_time, v, unnest(string_split(plain_text, CASE WHEN v THEN ' >> ' ELSE '>>' END)) AS p, generate_subscripts(string_split(plain_text, CASE WHEN v THEN ' >> ' ELSE '>>' END), 1) AS i FROM s00),
s1 AS (SELECT group_id, program_id, broadcast_time, i, v, unnest({_SENTENCES}) AS u, generate_subscripts({_SENTENCES}, 1) AS j FROM s0 WHERE {TRIM('p')} <> ''),
s11 AS (SELECT *, CASE WHEN v THEN split_part(u, chr(10), 1) ELSE u END AS x FROM s1),
s2 AS (SELECT *, CASE WHEN lag(i) OVER w IS DISTINCT FROM i OR (ends_with(lag(x) OVER w, '?') AND NOT ends_with(x, '?')) THEN 1 ELSE 0 END AS b FROM s11 WINDOW w AS (PARTITION BY group_id ORDER BY i, j)),
s3 AS (SELECT *, sum(b) OVER (PARTITION BY group_id ORDER BY i, j) AS k FROM s2),
sg AS (SELECT group_id, CAST(k - 1 AS INT) AS order_index, first(program_id) AS program_id, first(broadcast_time) AS broadcast_time, {TRIM("regexp_replace(string_agg(u, ' ' ORDER BY i, j), '^>>[\\s]*', '')")} AS text FROM s3 GROUP BY group_id, k)"""  # noqa: E731
INTRO = lambda c: f"nullif(regexp_extract({c}, '\\b(?:I''m|I am|this is|my name is|joined by|here is|over to|thank you,?)\\s+([A-Z][\\p{{L}}\\p{{N}}_''-]+(?: [A-Z][\\p{{L}}\\p{{N}}_''-]+)?)', 1), '')"
# What the rule provider answers for lines (t) of one chunk in order: the last name introduced speaks.
ATTRIBUTED = lambda src, part, order: f"""a1 AS (SELECT *, {INTRO('t')} AS m FROM {src}),
a2 AS (SELECT *, last_value(m IGNORE NULLS) OVER (PARTITION BY {part} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS known FROM a1),
a3 AS (SELECT *, coalesce(m, known, 'Unknown') AS sp, CASE WHEN m IS NOT NULL THEN 0.9::DOUBLE WHEN known IS NOT NULL THEN 0.6 ELSE 0.2 END AS conf FROM a2)"""  # noqa: E731


def _date():
    return F.col("bdate").cast("string").alias("bdate")


def _clips(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "clips").withColumnRenamed("clip_id", "ord").drop("received_at")


def _clean(spark: SparkSession, sf: str) -> DataFrame:
    once = ingest.dedup_keep_first(_clips(spark, sf), ["broadcast_date", "broadcast_time", "channel_name"], "ord")
    return ingest.trim_strings(once).withColumns({"bdate": ingest.parse_date(F.col("broadcast_date")), "sod": ingest.seconds_12h(F.col("broadcast_time"))})


def _dialogues(spark: SparkSession, sf: str) -> DataFrame:
    return windows.latest(read(spark, sf, "dialogues"))


def _windowed(spark: SparkSession, sf: str) -> DataFrame:
    return windows.gap_windows(windows.groups_with_dialogues(read(spark, sf, "grouped"), _dialogues(spark, sf)))


def _merged(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.merged_groups(_clean(spark, sf), GAP)


@query("SELECT clip_id, broadcast_date, broadcast_time, channel_name FROM (SELECT *, row_number() OVER (PARTITION BY broadcast_date, broadcast_time, channel_name ORDER BY clip_id) k FROM clips) WHERE k = 1")
def dedup_keep_first(spark, sf):
    d = ingest.dedup_keep_first(_clips(spark, sf), ["broadcast_date", "broadcast_time", "channel_name"], "ord")
    return d.select(F.col("ord").alias("clip_id"), "broadcast_date", "broadcast_time", "channel_name")


@query(f"WITH {CLIPS} SELECT ord AS clip_id, broadcast_time AS time_text, sod FROM c")
def parse_time_12h(spark, sf):
    return _clean(spark, sf).select(F.col("ord").alias("clip_id"), F.col("broadcast_time").alias("time_text"), "sod")


@query(f"WITH {CLIPS} SELECT ord AS clip_id, CAST(bdate AS VARCHAR) AS bdate, CASE WHEN bdate IS NOT NULL THEN dayname(bdate) END AS dname FROM c")
def parse_date_day_name(spark, sf):
    return _clean(spark, sf).select(F.col("ord").alias("clip_id"), _date(), ingest.day_name(F.col("bdate")).alias("dname"))


@query(f"SELECT clip_id, {TRIM('channel_name')} AS channel_name, {TRIM('plain_text')} AS plain_text FROM clips")
def trim_columns(spark, sf):
    return ingest.trim_strings(read(spark, sf, "clips").select("clip_id", "channel_name", "plain_text"))


@query(f"WITH {KEPT} SELECT ord AS clip_id, CAST(bdate AS VARCHAR) AS bdate, sod, channel_name FROM kept")
def schedule_filter(spark, sf):
    k = ingest.schedule_filter(_clean(spark, sf), read(spark, sf, "news_schedule"))
    return k.select(F.col("ord").alias("clip_id"), _date(), "sod", "channel_name")


@query(f"WITH {KEPT}, h AS (SELECT k.ord, s.start_time, s.end_time, row_number() OVER (PARTITION BY k.ord ORDER BY s.sched_ord) AS r FROM k JOIN s ON s.day_name=k.dn AND s.channel_name=k.channel_name AND k.sod BETWEEN s.a AND s.b) SELECT k.ord AS clip_id, h.start_time, h.end_time FROM k LEFT JOIN h ON h.ord=k.ord AND h.r=1")
def schedule_first_window(spark, sf):
    return ingest.first_window(_clean(spark, sf), read(spark, sf, "news_schedule")).select(F.col("ord").alias("clip_id"), "start_time", "end_time")


@query(f"WITH {KEPT} SELECT ord AS clip_id, channel_name, CAST(bdate AS VARCHAR) AS bdate, sod FROM kept ORDER BY channel_name NULLS LAST, kept.bdate NULLS LAST, sod NULLS LAST, ord LIMIT 100")
def top_n_sorted(spark, sf):
    got = ingest.ingest(_clips(spark, sf), read(spark, sf, "news_schedule"), limit=100)
    return got.select(F.col("ord").alias("clip_id"), "channel_name", _date(), "sod")


@query(f"WITH {GROUPS(GAP)} SELECT channel_name, CAST(bdate AS VARCHAR) AS bdate, sod, program_title, n_clips, plain_text FROM mg")
def capped_groups(spark, sf):
    return _merged(spark, sf).select("channel_name", _date(), "sod", "program_title", "n_clips", "plain_text")


@query(f"WITH {GROUPS(GAP)}, q AS (SELECT strftime(bdate,'%Y-%m-%d')||' 00:00:00|'||channel_name||'|'||{CLOCK('sod')}||'|'||plain_text AS key FROM mg) SELECT key, {UUID('key')} AS group_id FROM q")
def group_ids(spark, sf):
    m = _merged(spark, sf)
    d, t = F.date_format("bdate", "yyyy-MM-dd"), ingest.clock_text(F.col("sod"))
    key = F.concat_ws("|", F.concat(d, F.lit(" 00:00:00")), "channel_name", t, "plain_text")
    return m.select(key.alias("key"), ids.group_id(d, F.col("channel_name"), t, F.col("plain_text")).alias("group_id"))


@query(f"WITH {GROUPS(GAP)}, s AS (SELECT *, {SOD('start_time')} AS a, {SOD('end_time')} AS b FROM news_schedule), p AS (SELECT mg.channel_name, bdate, sod, (SELECT first(s.start_time||'|'||s.end_time ORDER BY sched_ord) FROM s WHERE s.day_name=dayname(bdate) AND s.channel_name=mg.channel_name AND sod BETWEEN s.a AND s.b) AS w FROM mg), q AS (SELECT channel_name, bdate, sod, strftime(bdate,'%Y-%m-%d')||'|'||channel_name||coalesce('|'||w,'') AS key FROM p) SELECT channel_name, CAST(bdate AS VARCHAR) AS bdate, sod, {UUID('key')} AS program_id FROM q")
def program_ids(spark, sf):
    m = ingest.first_window(_merged(spark, sf), read(spark, sf, "news_schedule"))
    return m.select("channel_name", _date(), "sod", ids.program_id(F.date_format("bdate", "yyyy-MM-dd"), F.col("channel_name"), F.col("start_time"), F.col("end_time")).alias("program_id"))


@query(f"WITH seg AS (SELECT group_id||'|'||order_index AS k, 'blocked-attribute::'||group_id AS b, segment_id FROM segments) SELECT segment_id, {UUID('k')} AS child_id, {UUID('b', '6ba7b8119dad11d180b400c04fd430c8')} AS blocked_id FROM seg")
def child_ids(spark, sf):
    s = read(spark, sf, "segments")
    return s.select("segment_id", ids.child_id(F.col("group_id"), F.col("order_index")).alias("child_id"), ids.blocked_id(F.col("group_id")).alias("blocked_id"))


@query(f"WITH {WINDOWED} SELECT broadcast_date, channel_name, win, first(broadcast_time ORDER BY pos) AS start_time, last(broadcast_time ORDER BY pos) AS end_time, (last(sod ORDER BY pos)-first(sod ORDER BY pos))/60.0::DOUBLE AS duration_min, count(*) AS n_groups FROM win GROUP BY 1,2,3")
def gap_windows(spark, sf):
    return windows.window_bounds(_windowed(spark, sf))


@query(f"WITH {WINDOWED}, c AS (SELECT broadcast_date, channel_name, win, program_title, count(*) n, min(pos) p FROM win GROUP BY 1,2,3,4) SELECT broadcast_date, channel_name, win, program_title FROM (SELECT *, row_number() OVER (PARTITION BY broadcast_date, channel_name, win ORDER BY n DESC, p) k FROM c) WHERE k = 1")
def window_title_mode(spark, sf):
    return windows.title_mode(_windowed(spark, sf))


_SPEAKERS = f"sp AS (SELECT broadcast_date, channel_name, win, {TRIM('speaker')} AS s, min(pos*1000000.0+oi) AS ignore, min((pos, oi, dialogue_id)) AS f FROM t WHERE {TRIM('speaker')} <> '' GROUP BY 1,2,3,4), spk AS (SELECT broadcast_date, channel_name, win, string_agg(s, ', ' ORDER BY f) AS speakers FROM sp GROUP BY 1,2,3)"
_STITCHED = "sg AS (SELECT broadcast_date, channel_name, win, pos, min(broadcast_time) AS bt, coalesce(string_agg(dialogue, ' ' ORDER BY oi, dialogue_id) FILTER (dialogue <> ''), '') AS tx, count(*) AS n FROM t GROUP BY 1,2,3,4), st AS (SELECT broadcast_date, channel_name, win, string_agg('['||bt||'] '||tx, chr(10)||chr(10) ORDER BY pos) AS stitched_dialogue, CAST(sum(n) AS BIGINT) AS n_segments FROM sg GROUP BY 1,2,3)"
_DIARIZED = "r1 AS (SELECT *, CASE WHEN row_number() OVER w = 1 OR speaker IS DISTINCT FROM lag(speaker) OVER w THEN 1 ELSE 0 END AS nr FROM t WINDOW w AS (PARTITION BY broadcast_date, channel_name, win ORDER BY pos, oi, dialogue_id)), r2 AS (SELECT *, sum(nr) OVER (PARTITION BY broadcast_date, channel_name, win ORDER BY pos, oi, dialogue_id) AS run FROM r1), r3 AS (SELECT broadcast_date, channel_name, win, run, speaker, coalesce(string_agg(dialogue, ' ' ORDER BY pos, oi, dialogue_id) FILTER (dialogue <> ''), '') AS tx FROM r2 GROUP BY 1,2,3,4,5), di AS (SELECT broadcast_date, channel_name, win, string_agg('**Speaker ( '||coalesce(speaker,'None')||' )** : '||tx, chr(10)||chr(10) ORDER BY run) AS diarized_dialogue FROM r3 GROUP BY 1,2,3)"


def _listed(spark, sf):
    d = windows.turns_by_group(_dialogues(spark, sf))
    return windows.listed(windows.gap_windows(read(spark, sf, "grouped").join(d, "group_id")))


@query(f"WITH {WINDOWED}, {_SPEAKERS}, a AS (SELECT DISTINCT broadcast_date, channel_name, win FROM t) SELECT a.broadcast_date, a.channel_name, a.win, coalesce(speakers,'') AS speakers FROM a LEFT JOIN spk USING (broadcast_date, channel_name, win)")
def window_speakers(spark, sf):
    return _listed(spark, sf).select(*windows.KEY, windows.speakers_of(windows.all_turns(F.col("g"))).alias("speakers"))


@query(f"WITH {WINDOWED}, {_STITCHED} SELECT broadcast_date, channel_name, win, stitched_dialogue FROM st")
def stitched_text(spark, sf):
    return _listed(spark, sf).select(*windows.KEY, windows.stitched_of(F.col("g")).alias("stitched_dialogue"))


@query(f"WITH {WINDOWED}, {_DIARIZED} SELECT broadcast_date, channel_name, win, diarized_dialogue FROM di")
def diarized_runs(spark, sf):
    return _listed(spark, sf).select(*windows.KEY, windows.diarized_of(windows.all_turns(F.col("g"))).alias("diarized_dialogue"))


@query(f"""WITH {WINDOWED}, {_SPEAKERS}, {_STITCHED}, {_DIARIZED},
b AS (SELECT broadcast_date, channel_name, win, first(broadcast_time ORDER BY pos)||' - '||last(broadcast_time ORDER BY pos) AS broadcast_time, (last(sod ORDER BY pos)-first(sod ORDER BY pos))/60.0::DOUBLE AS duration_min FROM win GROUP BY 1,2,3),
c AS (SELECT broadcast_date, channel_name, win, program_title, count(*) n, min(pos) p FROM win GROUP BY 1,2,3,4),
m AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY broadcast_date, channel_name, win ORDER BY n DESC, p) k FROM c) WHERE k = 1)
SELECT m.program_title, channel_name, broadcast_date, b.broadcast_time, b.duration_min, st.n_segments, coalesce(spk.speakers,'') AS speakers, st.stitched_dialogue, di.diarized_dialogue
FROM b JOIN m USING (broadcast_date, channel_name, win) JOIN st USING (broadcast_date, channel_name, win) JOIN di USING (broadcast_date, channel_name, win) LEFT JOIN spk USING (broadcast_date, channel_name, win)""")
def final_windows(spark, sf):
    return windows.final_windows(read(spark, sf, "grouped"), _dialogues(spark, sf))


@query(f"WITH {LATEST} SELECT group_id, first(dialogue_id ORDER BY coalesce(order_index,-1), dialogue_id) AS first_id, last(dialogue_id ORDER BY coalesce(order_index,-1), dialogue_id) AS last_id, count(*) AS n_turns FROM d GROUP BY 1")
def boundary_rows(spark, sf):
    b = stitching.boundary_rows(_dialogues(spark, sf))
    return b.select("group_id", F.col("first")["dialogue_id"].alias("first_id"), F.col("last")["dialogue_id"].alias("last_id"), "n_turns")


_STITCH = f"""{LATEST},
e AS (SELECT group_id, first(dialogue_id ORDER BY coalesce(order_index,-1), dialogue_id) AS fid, last(dialogue_id ORDER BY coalesce(order_index,-1), dialogue_id) AS lid, count(*) AS n FROM d GROUP BY 1),
q AS (SELECT g.broadcast_date, g.channel_name, g.broadcast_time, g.group_id, e.n, e.lid, f.dialogue_id AS fid, lower({TRIM("coalesce(l.speaker,'')")}) AS ls, lower({TRIM("coalesce(f.speaker,'')")}) AS fs
  FROM "grouped" g LEFT JOIN e USING (group_id) LEFT JOIN d l ON l.dialogue_id = e.lid LEFT JOIN d f ON f.dialogue_id = e.fid),
q1 AS (SELECT *, lead(fs) OVER w AS nfs, lead(fid) OVER w AS nfid FROM q WINDOW w AS (PARTITION BY broadcast_date, channel_name ORDER BY broadcast_time, group_id)),
q2 AS (SELECT *, coalesce(ls = nfs AND ls NOT IN ('','unknown'), false) AS m FROM q1),
q3 AS (SELECT *, m AND coalesce(n = 1, false) AND coalesce(lag(m) OVER (PARTITION BY broadcast_date, channel_name ORDER BY broadcast_time, group_id), false) AS ch FROM q2),
q4 AS (SELECT *, sum(CASE WHEN ch THEN 0 ELSE 1 END) OVER (PARTITION BY broadcast_date, channel_name ORDER BY broadcast_time, group_id) AS run FROM q3),
q5 AS (SELECT *, row_number() OVER (PARTITION BY broadcast_date, channel_name, run ORDER BY broadcast_time, group_id) AS pl FROM q4),
mg AS (SELECT lid AS target, nfid AS source FROM q5 WHERE m AND pl % 2 = 1)"""


@query(f"WITH {_STITCH} SELECT d.dialogue_id, d.group_id, d.speaker, CASE WHEN s.dialogue_id IS NULL THEN d.dialogue ELSE regexp_replace(d.dialogue, '[\\s\\x{{A0}}]+$', '')||' '||regexp_replace(s.dialogue, '^[\\s\\x{{A0}}]+', '') END AS dialogue FROM d LEFT JOIN mg ON mg.target = d.dialogue_id LEFT JOIN d s ON s.dialogue_id = mg.source WHERE d.dialogue_id NOT IN (SELECT source FROM mg)")
def stitch_boundaries(spark, sf):
    return stitching.stitch(read(spark, sf, "grouped"), _dialogues(spark, sf)).select("dialogue_id", "group_id", "speaker", "dialogue")


@query(f"""WITH {LATEST} SELECT g.broadcast_date AS "Broadcast Date", d.broadcast_time AS "Broadcast Time", g.program_title AS "Program Title", g.channel_name AS "Channel Name", d.dialogue AS "Dialogue", d.speaker AS "Speaker", d.role AS "Role", d.confidence_score AS "Confidence Score", coalesce(d.block_status, g.block_status) AS "Block Status", d.order_index AS "Order Index" FROM d JOIN "grouped" g USING (group_id)""")
def dialogue_export(spark, sf):
    return relational.dialogue_export(_dialogues(spark, sf), read(spark, sf, "grouped"))


@query(f"""WITH {LATEST} SELECT d.dialogue_id, d.group_id, d.confidence_score, g.channel_name, g.plain_text FROM d JOIN "grouped" g USING (group_id) WHERE (d.confidence_score IS NULL OR d.confidence_score < 0.9) AND d.verification_score IS NULL AND d.block_status IS NULL""")
def low_confidence(spark, sf):
    v = verdicts.verification_candidates(_dialogues(spark, sf), read(spark, sf, "grouped"))
    return v.select("dialogue_id", "group_id", "confidence_score", "channel_name", "plain_text")


_VERDICTS = "v AS (SELECT dialogue_id, CASE WHEN instr('0123', substr(dialogue_id,2,1))>0 THEN '' ELSE coalesce(role,'') END AS v_speaker, role AS v_role, confidence_score AS v_score FROM d WHERE instr('01234567', substr(dialogue_id,1,1))>0)"
_CHOSEN = f"CASE WHEN has AND {TRIM('v_speaker')} <> '' THEN {TRIM('v_speaker')} ELSE speaker END"


def _verdicts(d: DataFrame) -> DataFrame:
    """Synthetic verdicts for the turns whose id begins with 0 to 7: the role stands in for a verified speaker in half
    of them, the others name nobody."""
    some = d.filter(F.instr(F.lit("01234567"), F.substring("dialogue_id", 1, 1)) > 0)
    speaker = F.when(F.instr(F.lit("0123"), F.substring("dialogue_id", 2, 1)) > 0, "").otherwise(F.coalesce("role", F.lit("")))
    return some.select("dialogue_id", speaker.alias("v_speaker"), F.col("role").alias("v_role"), F.col("confidence_score").alias("v_score"), F.lit(0.5).alias("v_prior"), F.col("note").alias("v_reason"))


@query(f"""WITH {LATEST}, {_VERDICTS}, j AS (SELECT d.*, v.dialogue_id IS NOT NULL AS has, v.v_speaker, v.v_role, v.v_score FROM d LEFT JOIN v USING (dialogue_id)), k AS (SELECT *, {_CHOSEN} AS sp FROM j), {VOC('k', "coalesce(sp, '')", 'dialogue')}
SELECT dialogue_id, sp AS speaker, CASE WHEN has AND sp IS DISTINCT FROM speaker THEN v_role ELSE role END AS role, has AND sp IS DISTINCT FROM speaker AS corrected, CASE WHEN NOT has THEN verification_score WHEN v_score > 0.5 AND voc THEN 0.5 ELSE v_score END AS verification_score FROM vc""")
def verification_apply(spark, sf):
    """Every turn after the synthetic verdicts, with its score."""
    d = _dialogues(spark, sf)
    return verdicts.apply_verification(d, _verdicts(d)).select("dialogue_id", "speaker", "role", "corrected", "verification_score")


@query("""SELECT group_id, CASE WHEN status='RELEVANT' THEN 'kept' WHEN length(plain_text) % 100 / 100.0 >= 0.8 THEN 'dropped' ELSE 'uncertain' END AS outcome FROM "grouped" """)
def relevance_decision(spark, sf):
    g = read(spark, sf, "grouped")
    rel, conf = F.col("status") == "RELEVANT", F.length("plain_text") % 100 / 100.0
    return g.select("group_id", verdicts.relevance_outcome(rel, conf).alias("outcome"))


@query("""SELECT group_id, CASE WHEN size_label = 'OVER' THEN 'over' ELSE 'under' END AS route FROM "grouped" """)
def size_routing(spark, sf):
    g = read(spark, sf, "grouped").select("group_id", "size_label")
    return verdicts.over(g).withColumn("route", F.lit("over")).unionByName(verdicts.under(g).withColumn("route", F.lit("under"))).select("group_id", "route")


@query("SELECT segment_id, group_id, CAST((row_number() OVER w - 1)//2 AS INT) AS chunk, CAST((row_number() OVER w - 1)%2 + 1 AS INT) AS idx FROM segments WINDOW w AS (PARTITION BY group_id ORDER BY order_index, segment_id)")
def fixed_batches(spark, sf):
    return verdicts.chunked(read(spark, sf, "segments"), "group_id", ["order_index", "segment_id"], 2).select("segment_id", "group_id", "chunk", "idx")


@query("""WITH a AS (SELECT group_id, plain_text, string_split(plain_text, ' >> ') AS p FROM "grouped"), b AS (SELECT group_id, plain_text, unnest(p) AS x, generate_subscripts(p,1) AS i FROM a),
c AS (SELECT group_id, i, CASE WHEN i > 1 AND NOT starts_with(%s, '>>') THEN '>> '||%s ELSE %s END AS y FROM b WHERE %s <> ''),
d AS (SELECT group_id, i, string_split(regexp_replace(y, '([.!?])[\\s\\x{A0}]+', '\\1'||chr(1), 'g'), chr(1)) AS q FROM c), e AS (SELECT group_id, i, unnest(q) AS u, generate_subscripts(q,1) AS j FROM d),
f AS (SELECT group_id, i, j, %s AS u FROM e WHERE %s <> '')
SELECT g.group_id, CAST(coalesce(k, 0) AS BIGINT) AS order_index, coalesce(f2.u, %s) AS unit FROM "grouped" g LEFT JOIN (SELECT group_id, u, row_number() OVER (PARTITION BY group_id ORDER BY i, j) - 1 AS k FROM f) f2 USING (group_id)"""
       % (TRIM("x"), TRIM("x"), TRIM("x"), TRIM("x"), TRIM("u"), TRIM("u"), TRIM("g.plain_text")))
def sentence_units(spark, sf):
    g = read(spark, sf, "grouped").select("group_id", F.posexplode(units.sentence_units(F.col("plain_text"))).alias("order_index", "unit"))
    return g.select("group_id", F.col("order_index").cast("bigint").alias("order_index"), "unit")


@query("SELECT group_id, string_agg('['||(k)||'] '||text, chr(10) ORDER BY k) AS block FROM (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY order_index, segment_id) AS k FROM segments) GROUP BY 1")
def numbered_block(spark, sf):
    rows = F.array_sort(F.collect_list(F.struct("order_index", "segment_id", "text")))
    g = read(spark, sf, "segments").groupBy("group_id").agg(rows.alias("s"))
    return g.select("group_id", units.numbered_block(F.transform("s", lambda x: x["text"])).alias("block"))


@query("""WITH x AS (SELECT group_id, order_index, length(text) AS n FROM segments), r AS (SELECT group_id, n % 9 - 1 AS a, n % 7 + order_index AS b FROM x),
c AS (SELECT group_id, greatest(1, least(least(a, b), 8)) AS s, greatest(1, least(greatest(a, b), 8)) AS e FROM r),
m AS (SELECT *, coalesce(max(e) OVER (PARTITION BY group_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS reach FROM c),
k AS (SELECT group_id, reach + 1 AS s, e, row_number() OVER (PARTITION BY group_id ORDER BY s, e) AS i, count(*) OVER (PARTITION BY group_id) AS n FROM m WHERE e > reach)
SELECT group_id, CAST(i - 1 AS INT) AS order_index, s AS start_unit, CASE WHEN i = n THEN 8 ELSE e END AS end_unit FROM k""")
def range_repair(spark, sf):
    """Ranges made from segment lengths, repaired to tile each group's units; tested against a plain loop."""
    g = read(spark, sf, "segments").groupBy("group_id").agg(F.array_sort(F.collect_list(F.struct("order_index", F.length("text").alias("n")))).alias("s"))
    made = F.transform("s", lambda x: F.struct((x["n"] % 9 - 1).cast("int").alias("s"), (x["n"] % 7 + x["order_index"]).cast("int").alias("e")))
    fixed = g.select("group_id", units.repair_ranges(made, F.lit(8)).alias("r"))
    return fixed.select("group_id", F.posexplode("r").alias("order_index", "x")).select("group_id", "order_index", F.col("x")["s"].alias("start_unit"), F.col("x")["e"].alias("end_unit"))


@query("""WITH RECURSIVE p AS (SELECT doc_id, unnest(x) AS t, generate_subscripts(x, 1) AS i FROM (SELECT doc_id, string_split(regexp_replace(text, '\\n+', ' >> ', 'g'), ' >> ') AS x FROM documents)),
r AS (SELECT doc_id, i, 0 AS chunk, length(t) + 4 AS size, length(t) + 4 AS own FROM p WHERE i = 1
UNION ALL SELECT p.doc_id, p.i, CASE WHEN r.size + length(p.t) + 4 > 800 THEN r.chunk + 1 ELSE r.chunk END, CASE WHEN r.size + length(p.t) + 4 > 800 THEN length(p.t) + 4 ELSE r.size + length(p.t) + 4 END, length(p.t) + 4 FROM r JOIN p ON p.doc_id = r.doc_id AND p.i = r.i + 1)
SELECT doc_id, chunk, CAST(sum(own) - 4 AS INT) AS n_chars FROM r GROUP BY 1, 2""")
def chunk_pack(spark, sf):
    """Documents' lines packed to at most 800 characters; tested against a plain loop."""
    d = read(spark, sf, "documents").select("doc_id", F.regexp_replace("text", "\n+", " >> ").alias("t"))
    return d.select("doc_id", F.posexplode(units.pack_chunks(F.col("t"), 800)).alias("chunk", "piece")).select("doc_id", "chunk", F.length("piece").alias("n_chars"))


_FIRST = f"regexp_extract({TRIM('speaker')}, '^[^\\s\\x{{A0}}]+')"


@query(f"WITH {LATEST}, x AS (SELECT dialogue_id, {_FIRST} AS f, CASE WHEN length(dialogue) % 2 = 0 THEN 'Thank you, '||{_FIRST}||'. '||dialogue ELSE {_FIRST}||' said: '||dialogue END AS t FROM d WHERE {TRIM('speaker')} <> ''), {VOC('x', 'f', 't')} SELECT dialogue_id, voc AS vocative FROM vc")
def vocative_flag(spark, sf):
    """Turns that only address their speaker's first name, in made-up texts of two kinds."""
    d = _dialogues(spark, sf).filter(~is_blank(F.col("speaker")))
    first = F.element_at(F.split(ws_trim(F.col("speaker")), r"(?U)[\s\u00a0]+"), 1)
    called = F.when(F.length("dialogue") % 2 == 0, F.concat(F.lit("Thank you, "), first, F.lit(". "), "dialogue")).otherwise(F.concat(first, F.lit(" said: "), "dialogue"))
    return d.select("dialogue_id", units.only_vocative(first, called).alias("vocative"))


@query(f"WITH {LATEST} SELECT dialogue_id, CASE WHEN confidence_score IS NULL THEN NULL ELSE greatest(0.0, least(1.0, confidence_score * 2 - 0.5)) END AS score FROM d")
def confidence_cap(spark, sf):
    return _dialogues(spark, sf).select("dialogue_id", clamp01(F.col("confidence_score") * 2 - 0.5).alias("score"))


@query("""SELECT group_id, plain_text FROM "grouped" g WHERE NOT EXISTS (SELECT 1 FROM segments s WHERE s.group_id = g.group_id) AND program_title IS NOT NULL""")
def insert_if_absent(spark, sf):
    g, s = read(spark, sf, "grouped"), read(spark, sf, "segments").select("group_id").distinct()
    return state.insert_if_absent(g, s, "grouped").select("group_id", "plain_text")


@query(f"""WITH {LATEST}, u AS (SELECT coalesce(speaker_type,'none') AS stage, length(dialogue) AS tokens_in, length(dialogue)//3 AS cached, length(dialogue)//2 AS tokens_out FROM d) SELECT stage, count(*) AS calls, CAST(sum(tokens_in) AS BIGINT) AS tokens_in, CAST(sum(cached) AS BIGINT) AS cached, CAST(sum(tokens_out) AS BIGINT) AS tokens_out, round(sum(((tokens_in-cached)*0.25::DOUBLE + cached*0.25::DOUBLE*0.25::DOUBLE + tokens_out*1.5::DOUBLE)/1000000), 6) AS cost FROM u GROUP BY 1""")
def cost_rollup(spark, sf):
    n = F.length("dialogue").cast("bigint")
    u = _dialogues(spark, sf).select(F.coalesce("speaker_type", F.lit("none")).alias("stage"), n.alias("tokens_in"), F.floor(n / 3).alias("cached"), F.floor(n / 2).alias("tokens_out"))
    return state.cost_rollup(u).withColumn("cost", F.round("cost", 6))


@query("""SELECT status, coalesce(block_status,'none') AS block, count(*) AS n FROM "grouped" GROUP BY 1,2""")
def status_counts(spark, sf):
    o = read(spark, sf, "grouped").select(F.col("status").alias("stage"), F.coalesce("block_status", F.lit("none")).alias("outcome"))
    return state.outcome_counts(o).select(F.col("stage").alias("status"), F.col("outcome").alias("block"), F.col("count").alias("n"))


@query("""SELECT group_id FROM "grouped" WHERE status='PUNCTUATED' AND size_label IS NULL""")
def uncounted_groups(spark, sf):
    return state.uncounted(read(spark, sf, "grouped")).select("group_id")


@query("""SELECT group_id, status FROM "grouped" WHERE status = 'SEGMENTED'""")
def status_scan(spark, sf):
    return state.by_status(read(spark, sf, "grouped"), "SEGMENTED").select("group_id", "status")


@query("""SELECT group_id, plain_text FROM "grouped" WHERE group_id IN (SELECT group_id FROM person_bio WHERE role = 'Guest')""")
def plain_text_by_ids(spark, sf):
    return relational.texts_of(read(spark, sf, "grouped"), read(spark, sf, "person_bio").filter("role = 'Guest'"))


@query("""SELECT segment_id, group_id, order_index, text FROM segments WHERE group_id IN (SELECT group_id FROM "grouped" WHERE status = 'SEGMENTED')""")
def segments_of_groups(spark, sf):
    return relational.segments_of(read(spark, sf, "segments"), read(spark, sf, "grouped").filter("status = 'SEGMENTED'")).select("segment_id", "group_id", "order_index", "text")


@query("""SELECT group_id FROM "grouped" WHERE %s <> '' """ % TRIM("plain_text"))
def drop_blank(spark, sf):
    return state.drop_blank(read(spark, sf, "grouped"), "plain_text").select("group_id")


@query("SELECT segment_id, CASE WHEN length(text)/2 < 0.4*length(text) THEN 'x' WHEN length(text) % 3 * 20 < 0.4*length(text) THEN 'too_short' END AS error FROM segments")
def punctuation_guard(spark, sf):
    s = read(spark, sf, "segments")
    made = F.rpad(F.lit(""), F.length("text") % 3 * 20, "x")
    return s.select("segment_id", state.length_guard(F.col("text"), made).alias("error"))


@query("SELECT group_id, string_agg(CASE WHEN coalesce(broadcast_time,'') <> '' THEN '['||broadcast_time||'] ' ELSE '' END || trim(coalesce(text,'')), chr(10) ORDER BY order_index, segment_id) AS block, count(*) AS n_segments FROM segments GROUP BY 1")
def segment_blocks(spark, sf):
    return relational.segment_lists(read(spark, sf, "segments")).select("group_id", F.col("n_segments").cast("bigint").alias("n_segments"), "block")


@query(f"""WITH p AS (SELECT group_id, lower({TRIM('person')}) AS k, first({TRIM("coalesce(role,'')")} ORDER BY row_id) AS r FROM person_bio WHERE {TRIM('person')} <> '' GROUP BY 1,2), {LATEST},
e AS (SELECT *, lower({TRIM("regexp_replace(speaker, '\\s*\\([Cc][Ll][Ii][Pp]\\)\\s*$', '')")}) AS k FROM d) SELECT e.dialogue_id, e.speaker, CASE WHEN p.k IS NOT NULL THEN nullif(p.r,'') ELSE CASE e.k WHEN 'news anchor' THEN 'Anchor' WHEN 'interviewee' THEN 'Interviewee' WHEN 'guest' THEN 'Guest' WHEN 'reporter' THEN 'Reporter' END END AS resolved_role FROM e LEFT JOIN p ON p.group_id=e.group_id AND p.k=e.k""")
def role_lookup(spark, sf):
    return people.resolve_roles(_dialogues(spark, sf), read(spark, sf, "person_bio"))


@query(f"SELECT group_id, string_agg('- Person: '||{TRIM(chr(99)+'oalesce(person,'+chr(39)*2+')')}||' | Role: '||{TRIM('coalesce(role,'+chr(39)+'Unknown'+chr(39)+')')}||' | Context: '||{TRIM('coalesce(context_of_mention,'+chr(39)+'Unknown'+chr(39)+')')}, chr(10) ORDER BY row_id) AS people FROM person_bio GROUP BY 1")
def people_list(spark, sf):
    return people.people_lists(read(spark, sf, "person_bio"))


@query(f"WITH a AS (SELECT group_id, {TRIM('person')} AS p, min(row_id) AS f FROM person_bio WHERE {TRIM('person')} <> '' GROUP BY 1,2), g AS (SELECT DISTINCT group_id FROM person_bio) SELECT g.group_id, coalesce((SELECT string_agg(p, ', ' ORDER BY f) FROM a WHERE a.group_id = g.group_id), '') AS names FROM g")
def ordered_names(spark, sf):
    return people.distinct_names(read(spark, sf, "person_bio"))


@query("SELECT count(DISTINCT group_id) AS n_groups, count(*) AS n_rows FROM person_bio")
def distinct_groups(spark, sf):
    return read(spark, sf, "person_bio").agg(F.countDistinct("group_id").alias("n_groups"), F.count("*").alias("n_rows"))


@query("SELECT b.row_id, b.group_id, b.person FROM person_bio b WHERE b.group_id IN (SELECT group_id FROM segments)")
def persons_of_groups(spark, sf):
    return read(spark, sf, "person_bio").join(read(spark, sf, "segments").select("group_id").distinct(), "group_id", "left_semi").select("row_id", "group_id", "person")


@query(f"WITH e AS (SELECT DISTINCT group_id, {TRIM('person')} AS person FROM person_bio WHERE person IS NOT NULL), a AS (SELECT group_id, lower({TRIM('person')}) AS k, last(role ORDER BY row_id) AS role FROM person_bio WHERE role IS NOT NULL GROUP BY 1,2) SELECT e.group_id, e.person, a.role FROM e LEFT JOIN a ON a.group_id=e.group_id AND a.k=lower(e.person)")
def ner_role_join(spark, sf):
    b = read(spark, sf, "person_bio")
    e = b.filter("person is not null").select("group_id", ws_trim(F.col("person")).alias("person")).distinct()
    a = b.filter("role is not null").select("group_id", "person", "role", F.col("context_of_mention").alias("context"), F.col("row_id").alias("seq"))
    return people.join_roles(e, a).select("group_id", "person", "role")


@query("""SELECT group_id FROM "grouped" WHERE status LIKE 'FAILED%' AND block_status IS NULL AND group_id NOT IN (SELECT group_id FROM segments)""")
def failed_left(spark, sf):
    g = read(spark, sf, "grouped")
    return relational.failed_left(g.filter("status like 'FAILED%'"), read(spark, sf, "segments"), g.filter("block_status is not null")).select("group_id")


@query(f"""WITH {LATEST}, l AS (SELECT group_id, max(CASE WHEN order_index IS NULL THEN -1 ELSE order_index END) AS mx FROM d GROUP BY 1) SELECT g.group_id, CASE WHEN mx IS NULL THEN status WHEN mx % 2 = 0 THEN 'ATTRIBUTED' ELSE 'FAILED ATTRIBUTION' END AS status FROM "grouped" g LEFT JOIN l USING (group_id)""")
def status_update(spark, sf):
    """Statuses derived from append-only outcomes: the one of the highest attempt holds."""
    d = _dialogues(spark, sf).select("group_id", F.coalesce("order_index", F.lit(-1)).alias("attempt"))
    o = d.withColumn("status", F.when(F.col("attempt") % 2 == 0, "ATTRIBUTED").otherwise("FAILED ATTRIBUTION"))
    return state.set_status(read(spark, sf, "grouped"), o).select("group_id", "status")


@query(f"""WITH {LATEST} SELECT dialogue_id, CASE WHEN group_id IN (SELECT group_id FROM "grouped" WHERE block_status IS NOT NULL) THEN 'BLOCKED_VERIFICATION' ELSE block_status END AS block_status FROM d""")
def block_dialogues(spark, sf):
    b = read(spark, sf, "grouped").filter("block_status is not null").select("group_id", F.lit("BLOCKED_VERIFICATION").alias("block"))
    return state.set_block(_dialogues(spark, sf), b).select("dialogue_id", "block_status")


@query(f"""WITH {LATEST} SELECT dialogue_id, group_id, CAST(row_number() OVER (PARTITION BY group_id ORDER BY coalesce(order_index,-1)//3, dialogue_id) - 1 AS INT) AS order_index FROM d""")
def turns_concat(spark, sf):
    t = _dialogues(spark, sf).select("dialogue_id", "group_id", F.floor(F.coalesce("order_index", F.lit(-1)) / 3).alias("chunk"), F.col("dialogue_id").alias("turn"))
    t = t.withColumn("chunk", F.when(F.col("chunk") < 0, 0).otherwise(F.col("chunk")))
    return relational.continuous_order(t).select("dialogue_id", "group_id", "order_index")


@query(f"""WITH {LATEST} SELECT dialogue_id, nullif(speaker,'') AS speaker, nullif(role,'') AS role, nullif(note,'') AS note FROM d""")
def null_if_empty_fields(spark, sf):
    return _dialogues(spark, sf).select("dialogue_id", *[null_if_empty(F.col(c)).alias(c) for c in ("speaker", "role", "note")])


@query(f"""WITH {LATEST} SELECT dialogue_id, upper({TRIM('speaker')}) AS speaker FROM d WHERE {TRIM('speaker')} <> '' AND upper({TRIM('speaker')}) <> 'UNKNOWN'""")
def known_speakers(spark, sf):
    name = F.upper(ws_trim(F.col("speaker")))
    return _dialogues(spark, sf).filter(~is_blank(F.col("speaker")) & (name != "UNKNOWN")).select("dialogue_id", name.alias("speaker"))


_NUM = lambda c: f"CASE WHEN {c} IS NULL THEN 'n/a' ELSE printf('%.2f', {c}) END"


@query(f"""WITH {LATEST}, {_VERDICTS}, a AS (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY order_index NULLS FIRST, dialogue_id) AS n FROM d WHERE (confidence_score IS NULL OR confidence_score < 0.9) AND verification_score IS NULL AND block_status IS NULL),
j AS (SELECT a.*, v.dialogue_id IS NOT NULL AS has, v.v_speaker, v.v_role, v.v_score FROM a LEFT JOIN v USING (dialogue_id)), k AS (SELECT *, {_CHOSEN} AS sp FROM j), {VOC('k', "coalesce(sp, '')", 'dialogue')},
o AS (SELECT *, CASE WHEN NOT has THEN 'NO VERDICT' WHEN sp IS DISTINCT FROM speaker THEN 'CORRECTED' ELSE 'confirmed' END AS oc, coalesce(nullif(coalesce(v_role, ''), ''), 'n/a') AS r, CASE WHEN has THEN 0.5 ELSE confidence_score END AS prior, CASE WHEN has THEN CASE WHEN v_score > 0.5 AND voc THEN 0.5 ELSE v_score END END AS sc, CASE WHEN has THEN coalesce(nullif(note, ''), '(none provided)') ELSE '(none provided)' END AS why FROM vc),
b AS (SELECT group_id, n, '['||n||'] dialogue_id='||dialogue_id||chr(10)||'    DIALOGUE:          '||coalesce(dialogue, 'None')||chr(10)||'    CURRENT SPEAKER:   '||coalesce(speaker, 'None')||chr(10)||'    VERIFIED SPEAKER:  '||coalesce(sp, 'None')||'   ('||oc||')'||chr(10)||'    VERIFIED ROLE:     '||r||CASE WHEN oc = 'CORRECTED' THEN '' ELSE ' (not written; speaker unchanged)' END||chr(10)||'    PRIOR CONFIDENCE:  '||{_NUM('prior')}||chr(10)||'    VERIFICATION:      '||{_NUM('sc')}||chr(10)||'    REASONING:         '||why AS block FROM o)
SELECT group_id, repeat('=', 80)||chr(10)||'GROUP: '||group_id||chr(10)||repeat('=', 80)||chr(10)||chr(10)||string_agg(block, chr(10)||chr(10) ORDER BY n)||chr(10) AS report FROM b GROUP BY group_id""")
def verification_report(spark, sf):
    """The text report of the unsure turns under the synthetic verdicts, group by group."""
    d = _dialogues(spark, sf)
    return verdicts.report(d, _verdicts(d))


def _provider_groups(spark, sf):
    return read(spark, sf, "grouped")


_HITS = " + ".join(f"CAST(contains(b, '{w}') AS INT)" for w in ("minister", "government", "police", "court", "council", "election", "union", "budget", "school", "hospital"))


@query(f"""WITH x AS (SELECT group_id, lower(coalesce(plain_text, '')) AS b FROM "grouped"), y AS (SELECT group_id, {_HITS} AS h, len(regexp_extract_all(b, '[^\\s\\x{{A0}}]+')) AS w FROM x),
z AS (SELECT group_id, h > 0 AS is_relevant, CASE WHEN h > 1 OR w < 3 THEN 0.95::DOUBLE WHEN h > 0 THEN 0.85 ELSE 0.5 END AS confidence FROM y)
SELECT *, CASE WHEN is_relevant THEN 'kept' WHEN confidence >= 0.8 THEN 'dropped' ELSE 'uncertain' END AS outcome, CASE WHEN NOT is_relevant AND confidence >= 0.8 THEN 'NOT RELEVANT' ELSE 'RELEVANT' END AS status FROM z""")
def stage_relevance(spark, sf):
    from turnloom.inference import stages
    from turnloom.inference.provider import RuleProvider

    return stages.relevance(_provider_groups(spark, sf), RuleProvider(), per_minute=1e9)


_RESTORED = f"(CASE WHEN {TRIM('p')} = '' THEN '' ELSE (SELECT upper(left(y, 1))||substr(y, 2)||CASE WHEN right(y, 1) IN ('.','!','?','…') THEN '' ELSE '.' END FROM (SELECT CASE WHEN {TRIM('p')} = upper({TRIM('p')}) AND {TRIM('p')} <> lower({TRIM('p')}) THEN lower({TRIM('p')}) ELSE {TRIM('p')} END AS y)) END)"


@query(f"""WITH a AS (SELECT group_id, plain_text, unnest(string_split(plain_text, ' >> ')) AS p, generate_subscripts(string_split(plain_text, ' >> '), 1) AS i FROM "grouped" WHERE punctuation_source IS NULL AND {TRIM('plain_text')} <> ''),
b AS (SELECT group_id, first(plain_text) AS w, trim(string_agg({_RESTORED}, ' >> ' ORDER BY i)) AS text FROM a GROUP BY group_id)
SELECT group_id, text, 'llm' AS source, CASE WHEN length(text) < 0.4 * length(w) THEN 'too_short' ELSE 'ok' END AS outcome FROM b""")
def stage_punctuation(spark, sf):
    from turnloom.inference import stages
    from turnloom.inference.provider import RuleProvider

    raw = _provider_groups(spark, sf).filter("punctuation_source is null")
    return stages.punctuation(raw, RuleProvider(), per_minute=1e9)


@query(r"""SELECT *, CASE WHEN tokens > 1000 THEN 'OVER' ELSE 'UNDER' END AS size_label FROM (SELECT group_id, len(regexp_extract_all(plain_text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]'))::BIGINT AS tokens FROM "grouped" WHERE plain_text IS NOT NULL)""")
def stage_count(spark, sf):
    from turnloom.inference import stages
    from turnloom.inference.provider import RuleProvider

    return stages.token_counts(_provider_groups(spark, sf), RuleProvider())


@query(f"WITH {PIECES("coalesce(size_label = 'OVER', false)")}, q AS (SELECT *, group_id||'|'||order_index AS key FROM sg) SELECT {UUID('key')} AS segment_id, group_id, program_id, broadcast_time, order_index, text FROM q")
def stage_segmentation(spark, sf):
    from turnloom.inference import stages
    from turnloom.inference.provider import RuleProvider

    g = _provider_groups(spark, sf).filter("punctuation_source is not null")
    return stages.segment_rows(stages.segmentation(g, RuleProvider(), per_minute=1e9), g)


@query(f"""WITH l AS (SELECT group_id, CAST((row_number() OVER (PARTITION BY group_id ORDER BY order_index, segment_id) - 1)//40 AS INT) AS chunk, order_index, segment_id, text FROM segments),
l1 AS (SELECT group_id, chunk, order_index, segment_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS li FROM l), l2 AS (SELECT *, {TRIM('x')} AS t FROM l1 WHERE {TRIM('x')} <> ''),
{ATTRIBUTED('l2', 'group_id, chunk', 'order_index, segment_id, li')}, {VOC('a3', 'sp', 't')},
i AS (SELECT group_id, min(program_id) AS program_id, min(broadcast_time) AS broadcast_time FROM segments GROUP BY 1), k AS (SELECT vc.*, CAST(row_number() OVER (PARTITION BY group_id ORDER BY chunk, order_index, segment_id, li) - 1 AS INT) AS oi FROM vc),
q AS (SELECT k.*, i.program_id, i.broadcast_time, k.group_id||'|'||oi AS key FROM k JOIN i USING (group_id))
SELECT {UUID('key')} AS dialogue_id, group_id, program_id, broadcast_time, t AS dialogue, sp AS speaker, CASE WHEN m IS NOT NULL THEN 'Guest' END AS role, CASE WHEN conf > 0.5 AND voc THEN 0.5 ELSE conf END AS confidence_score, CAST(NULL AS DOUBLE) AS verification_score,
CAST(NULL AS VARCHAR) AS block_status, oi AS order_index, CASE WHEN starts_with(t, 'Clip - ') THEN 'clip' ELSE 'live' END AS speaker_type, CAST(NULL AS VARCHAR) AS note, 'ok' AS outcome FROM q""")
def stage_attribution(spark, sf):
    from turnloom.inference import stages
    from turnloom.inference.provider import RuleProvider

    return stages.attribution(read(spark, sf, "segments"), RuleProvider(), per_minute=1e9)


@query(f"""WITH {LATEST} SELECT d.dialogue_id, coalesce(d.speaker, '') AS v_speaker, '' AS v_role, CASE WHEN coalesce(d.speaker, '') = '' THEN 0.3 ELSE 0.7::DOUBLE END AS v_score, 0.5::DOUBLE AS v_prior, 'no evidence against' AS v_reason
FROM d JOIN "grouped" g USING (group_id) WHERE (d.confidence_score IS NULL OR d.confidence_score < 0.9) AND d.verification_score IS NULL AND d.block_status IS NULL""")
def stage_verification(spark, sf):
    from turnloom.inference import stages
    from turnloom.inference.provider import RuleProvider

    return stages.verification(_dialogues(spark, sf), _provider_groups(spark, sf), RuleProvider(), per_minute=1e9)


@query(f"SELECT DISTINCT group_id, {TRIM('person')} AS person, 'Guest' AS role, 'named' AS context FROM person_bio WHERE {TRIM('person')} <> ''")
def stage_name_roles(spark, sf):
    from turnloom.inference import stages
    from turnloom.inference.provider import RuleProvider

    names = read(spark, sf, "person_bio").filter("person is not null").select("group_id", ws_trim(F.col("person")).alias("person")).filter("person <> ''").distinct()
    return stages.name_roles(names, RuleProvider(), per_minute=1e9)


@query("""WITH t AS (SELECT row_id, unnest(regexp_extract_all(plain_text, '[\\p{L}\\p{M}\\p{N}_]+|[^\\p{L}\\p{M}\\p{N}_\\s\\x{A0}]')) AS w, generate_subscripts(regexp_extract_all(plain_text, '[\\p{L}\\p{M}\\p{N}_]+|[^\\p{L}\\p{M}\\p{N}_\\s\\x{A0}]'), 1) AS i FROM person_bio),
c AS (SELECT *, i - row_number() OVER (PARTITION BY row_id ORDER BY i) AS run FROM t WHERE regexp_full_match(w, '\\p{Lu}[^\\p{Lu}]*\\p{Ll}[^\\p{Lu}]*')),
k AS (SELECT *, row_number() OVER (PARTITION BY row_id, run ORDER BY i) AS place, count(*) OVER (PARTITION BY row_id, run) AS n FROM c),
m AS (SELECT row_id, run, min(i) AS f, string_agg(w, ' ' ORDER BY i) AS name FROM k WHERE place <= n // 2 * 2 GROUP BY 1, 2), o AS (SELECT row_id, name, min(f) AS f FROM m GROUP BY 1, 2), l AS (SELECT row_id, string_agg(name, ', ' ORDER BY f) AS names FROM o GROUP BY 1)
SELECT b.row_id AS key, coalesce(l.names, '') AS names FROM person_bio b LEFT JOIN l USING (row_id)""")
def stage_names(spark, sf):
    from turnloom.inference import stages

    t = stages.token_labels(read(spark, sf, "person_bio").select(F.col("row_id").alias("key"), F.col("plain_text").alias("text")), stages.capital_tagger)
    return t.select("key", F.array_join(people.name_spans(F.col("tokens"), F.col("labels")), ", ").alias("names"))


@query(f"""WITH {PIECES('true')}, w0 AS (SELECT group_id, unnest(string_split(replace(plain_text, ' >> ', chr(10)), chr(10))) AS x, generate_subscripts(string_split(replace(plain_text, ' >> ', chr(10)), chr(10)), 1) AS li FROM "grouped" WHERE punctuation_source IS NOT NULL AND {TRIM('plain_text')} <> ''),
w1 AS (SELECT group_id, li, {TRIM("regexp_replace(x, '^[[]\\d:]+[]] ', '')")} AS t FROM w0), w2 AS (SELECT * FROM w1 WHERE t <> ''), {ATTRIBUTED('w2', 'group_id', 'li')}, {VOC('a3', 'sp', TRIM("regexp_replace(t, '^>>\\s*', '')"))},
w3 AS (SELECT group_id, CAST(row_number() OVER (PARTITION BY group_id ORDER BY li) - 1 AS INT) AS order_index, sp AS speaker, {TRIM("regexp_replace(t, '^>>\\s*', '')")} AS text, CASE WHEN conf > 0.5 AND voc THEN 0.5 ELSE conf END AS confidence FROM vc)
SELECT *, 'whole' AS form FROM w3 WHERE text <> '' UNION ALL SELECT group_id, order_index, 'Unknown', text, 0.2::DOUBLE, 'indexed' FROM sg""")
def stage_diarization(spark, sf):
    from turnloom.inference import stages
    from turnloom.inference.provider import RuleProvider

    g = _provider_groups(spark, sf).filter("punctuation_source is not null")
    whole = stages.diarization(g, RuleProvider(), per_minute=1e9).withColumn("form", F.lit("whole"))
    return whole.unionByName(stages.diarization(g, RuleProvider(), indexed=True, per_minute=1e9).withColumn("form", F.lit("indexed")))


# Further forms and operators, each with its twin.


@query(f"WITH {GROUPS(60)} SELECT channel_name, CAST(bdate AS VARCHAR) AS bdate, sod, program_title, n_clips, plain_text FROM mg")
def capped_groups_minute(spark, sf):
    """The capped groups at the pipeline's own gap of a minute."""
    return ingest.merged_groups(_clean(spark, sf)).select("channel_name", _date(), "sod", "program_title", "n_clips", "plain_text")


def _batches(size: int) -> str:
    return f"SELECT group_id, CAST((row_number() OVER w - 1)//{size} AS INT) AS chunk, CAST((row_number() OVER w - 1)%{size} + 1 AS INT) AS idx FROM \"grouped\" WINDOW w AS (PARTITION BY status ORDER BY group_id)"


def _chunked(spark, sf, size: int) -> DataFrame:
    return verdicts.chunked(read(spark, sf, "grouped").select("group_id", "status"), "status", ["group_id"], size).select("group_id", "chunk", "idx")


@query(_batches(verdicts.RELEVANCE_BATCH))
def relevance_batches(spark, sf):
    return _chunked(spark, sf, verdicts.RELEVANCE_BATCH)


@query(_batches(verdicts.NAME_BATCH))
def name_batches(spark, sf):
    return _chunked(spark, sf, verdicts.NAME_BATCH)


@query(_batches(verdicts.ATTRIBUTION_CHUNK))
def attribution_batches(spark, sf):
    return _chunked(spark, sf, verdicts.ATTRIBUTION_CHUNK)


@query("""SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT group_id) AS BIGINT) AS n_groups, CAST(10 AS INT) AS largest FROM "grouped" """)
def numbered_batches(spark, sf):
    """Rows, distinct rows and the largest batch of the numbering of unkeyed rows."""
    b = verdicts.numbered_batches(read(spark, sf, "grouped").select("group_id", "plain_text"), ["group_id"], 10)
    return b.agg(F.count("*").alias("n_rows"), F.count_distinct(F.struct("bucket", "batch", "idx")).alias("n_groups"), F.max("idx").alias("largest"))


@query("""WITH e AS (SELECT segment_id, group_id, row_number() OVER (PARTITION BY group_id ORDER BY order_index, segment_id) AS idx, length(text) AS n FROM segments),
v AS (SELECT group_id, (idx + 1)//2 AS idx, n, idx AS seq FROM e), l AS (SELECT group_id, idx, last(n ORDER BY seq) AS n FROM v GROUP BY 1, 2)
SELECT e.segment_id, l.n AS verdict FROM e LEFT JOIN l ON l.group_id = e.group_id AND l.idx = e.idx""")
def verdict_join(spark, sf):
    """Entries with their verdict by place: of two for one place the later holds, entries past the verdicts have none."""
    e = verdicts.chunked(read(spark, sf, "segments"), "group_id", ["order_index", "segment_id"], 1_000_000)
    v = e.select("group_id", F.floor((F.col("idx") + 1) / 2).cast("int").alias("idx"), F.length("text").alias("n"), F.col("idx").alias("seq"))
    return verdicts.join_verdicts(e.select("segment_id", "group_id", "idx"), v, ["group_id", "idx"]).select("segment_id", F.col("v")["n"].cast("bigint").alias("verdict"))


def _half(key: str) -> str:
    return f"instr('01234567', substr({key}, 1, 1)) > 0"


@query(f"SELECT segment_id, group_id, order_index, text FROM segments WHERE NOT ({_half('segment_id')})")
def insert_segments(spark, sf):
    """Segments that are not there yet, where half of them are."""
    t = read(spark, sf, "segments")
    return state.insert_if_absent(t, t.filter(_half("segment_id")), "segments").select("segment_id", "group_id", "order_index", "text")


@query(f"WITH {LATEST} SELECT dialogue_id, group_id, dialogue, order_index FROM d WHERE NOT ({_half('dialogue_id')}) AND group_id IS NOT NULL AND dialogue IS NOT NULL")
def insert_dialogues(spark, sf):
    t = _dialogues(spark, sf)
    return state.insert_if_absent(t, t.filter(_half("dialogue_id")), "dialogues").select("dialogue_id", "group_id", "dialogue", "order_index")


@query(f"SELECT row_id, group_id, person FROM person_bio WHERE NOT ({_half('row_id')})")
def insert_persons(spark, sf):
    t = read(spark, sf, "person_bio")
    return state.insert_if_absent(t, t.filter(_half("row_id")), "person_bio").select("row_id", "group_id", "person")


@query("""SELECT group_id, CASE WHEN punctuation_source IS NULL THEN upper(plain_text) ELSE plain_text END AS plain_text, coalesce(punctuation_source, 'local') AS punctuation_source, plain_text AS raw_text FROM "grouped" """)
def punctuated_text(spark, sf):
    """Groups with new text and source where there is one; the text before is kept."""
    g = read(spark, sf, "grouped").select("group_id", "plain_text", "punctuation_source")
    new = g.filter("punctuation_source is null").select("group_id", F.upper("plain_text").alias("text"), F.lit("local").alias("source"))
    return state.set_text(g, new)


@query("""SELECT group_id, CASE WHEN status = 'PUNCTUATED' THEN CASE WHEN length(plain_text) > 1000 THEN 'OVER' ELSE 'UNDER' END ELSE size_label END AS size_label FROM "grouped" """)
def size_update(spark, sf):
    """Size labels from counts (here of characters) of the groups counted, others as they were."""
    g = read(spark, sf, "grouped")
    c = g.filter("status = 'PUNCTUATED'").select("group_id", verdicts.size_label(F.length("plain_text")).alias("size_label"))
    return state.set_size(g, c).select("group_id", "size_label")


@query(f"""SELECT segment_id, {TRIM("regexp_replace(text, '\\x{60}', '', 'g')")} AS body FROM segments""")
def fenced_answers(spark, sf):
    """Answers without the code fence around them, in three forms of fence."""
    body = ws_trim(F.translate("text", "`", ""))
    k = F.col("order_index") % 3
    t = F.when(k == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).when(k == 1, F.concat(F.lit(" ```\n"), body, F.lit(" ```\n"))).otherwise(body)
    return read(spark, sf, "segments").select("segment_id", units.fence_strip(t).alias("body"))


@query(f"""SELECT group_id, {UUID("'blocked-diarize::'||group_id", '6ba7b8119dad11d180b400c04fd430c8')} AS blocked_id FROM "grouped" """)
def blocked_diarize_ids(spark, sf):
    return read(spark, sf, "grouped").select("group_id", ids.blocked_id(F.col("group_id"), "diarize").alias("blocked_id"))


@query("""SELECT group_id, broadcast_date, broadcast_time, program_title, channel_name, plain_text, program_id, CAST(NULL AS VARCHAR) AS status, CAST(NULL AS VARCHAR) AS size_label, CAST(NULL AS VARCHAR) AS block_status, CAST(NULL AS VARCHAR) AS punctuation_source FROM "grouped" """)
def migrated_groups(spark, sf):
    """A table of an older form brought to the present one: new columns as nulls, columns dropped since left out."""
    old = read(spark, sf, "grouped").drop("status", "size_label", "block_status", "punctuation_source").withColumn("n_segments", F.lit(1))
    return migrate(old, "grouped")


@query("""SELECT sched_ord, day_name, channel_name, start_time, end_time, CAST(substr(start_time,1,2) AS INT)*3600 + CAST(substr(start_time,4,2) AS INT)*60 + CAST(substr(start_time,7,2) AS INT) AS start_s, CAST(substr(end_time,1,2) AS INT)*3600 + CAST(substr(end_time,4,2) AS INT)*60 + CAST(substr(end_time,7,2) AS INT) AS end_s FROM news_schedule""")
def schedule_scan(spark, sf):
    return ingest.schedule(read(spark, sf, "news_schedule"))


@query(f"WITH {LATEST}, a AS (SELECT dialogue_id, group_id, row_number() OVER (PARTITION BY group_id ORDER BY order_index NULLS FIRST, dialogue_id) AS k FROM d WHERE (confidence_score IS NULL OR confidence_score < 0.9) AND verification_score IS NULL AND block_status IS NULL) SELECT group_id, string_agg(dialogue_id, ',' ORDER BY k) AS asked FROM a GROUP BY group_id")
def unsure_by_group(spark, sf):
    """The turns to verify, gathered by group in order."""
    d = verdicts.low_confidence(_dialogues(spark, sf)).groupBy("group_id").agg(F.array_sort(F.collect_list(F.struct("order_index", "dialogue_id"))).alias("t"))
    return d.select("group_id", F.array_join(F.transform("t", lambda x: x["dialogue_id"]), ",").alias("asked"))


_FINAL = SQL["final_windows"]


@query(f"SELECT row_number() OVER (ORDER BY broadcast_date NULLS FIRST, channel_name NULLS FIRST, broadcast_time NULLS FIRST, program_title NULLS FIRST, stitched_dialogue NULLS FIRST) AS window_id, program_title, channel_name, broadcast_date, broadcast_time, n_segments FROM ({_FINAL})")
def final_export(spark, sf):
    """The window table in export order, numbered from 1."""
    return numbered_final(windows.final_windows(read(spark, sf, "grouped"), _dialogues(spark, sf))).select("window_id", "program_title", "channel_name", "broadcast_date", "broadcast_time", "n_segments")
