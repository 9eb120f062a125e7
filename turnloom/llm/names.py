"""Variant spellings of names typed by people (problem 4).

Forms are cleaned of what surrounds a name and cut into parts; equal cleaned names become one node. Nodes are
vectors of character trigrams weighted by rarity. A sparse similarity join finds the pairs above a cosine threshold
by prefix filtering: the ``TOP`` best partners of every node first, then whatever pairs nodes with more partners have
beyond, so that no link is lost. A pair's score is its cosine, raised by name parts that agree and turned to
``CONFLICT`` by parts that contradict it. Nodes are grouped by average linkage of the scores, run as rounds of
reciprocal nearest neighbours: within one task for a component of a bounded number of links, over the table of links
for larger ones, to the same result.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnloom.runtime import cut, parallelism

COSINE = 0.40  # pairs below are no candidates
TOP = 50  # partners of a name that the join ranks; those beyond are joined as well, unranked
POSTING = 2048  # names of one gram that meet in one task; a commoner gram is split
COMPONENT = 5_000  # links that one task solves; larger components are solved by joins
UNIT = 1_000_000  # scores are summed as whole numbers of this part, whatever the order
TAIL = 0.5  # share of the threshold that the grams left out of the join may weigh
FIRST_SHARE = 0.6  # weight of a person's first name beside the surname
LINKAGE = 0.18  # average score between groups that are merged
CONFLICT = -1.0

# Notes and titles around names, labels that name nobody, words of organisations, nicknames.
NOTES = "clip host anchor guest reporter interviewee presenter narrator caller voice live studio via correspondent voiceover newsreader"
TITLES = "mr mrs ms miss mx dr prof professor sir dame lord lady rev reverend fr cllr councillor capt captain col gen lt maj sgt hon judge justice sen senator rep gov president minister mp"
NOBODY = (
    "unknown unidentified crowd audience voiceover narrator newsreader announcer speaker anchor reporter host guest caller man woman male "
    "female all everyone unison presenter interviewer interviewee moderator operator various none null na n/a tbc tbd anonymous clip voice people"
)
ORGANISATIONS = (
    "board trust union authority group council service services company department ministry agency association bank club college "
    "committee commission church foundation fund hospital institute league office party police press school society university "
    "energy water health rail harbour teachers county federation corporation"
)
NICKNAMES = (
    "abigail:abby,gail alexander:alex,sandy,al,alec,xander alexandra:alex,sandra,sandy andrew:andy,drew anthony:tony barbara:barb,babs benjamin:ben,benny,benji "
    "catherine:cathy,kate,cat,katie charles:charlie,chuck christopher:chris,kit,topher daniel:dan,danny david:dave,davy deborah:deb,debs,debbie dorothy:dot,dottie "
    "edward:ed,eddie,ted,ned eleanor:ellie,nell elizabeth:liz,lizzie,beth,betty,eliza,lisa emily:em,emmy florence:flo,florrie francis:frank,fran frederick:fred,freddie,freddy,fritz "
    "george:geordie gerald:gerry,jerry gregory:greg,gregg harold:harry,hal henry:harry,hank isabella:bella,izzy jacob:jake james:jim,jimmy,jamie jennifer:jen,jenny "
    "john:jack,johnny joseph:joe,joey josephine:jo,josie,josey joshua:josh judith:judy katherine:kate,kathy,kat,katie,kitty kenneth:ken,kenny lawrence:larry,laurie leonard:len,lenny,leo "
    "lucinda:lucy,cindy margaret:peggy,maggie,meg,madge,marge,peg martin:marty matthew:matt michael:mick,mike,mickey,mikey nicholas:nick,nicky,nico,klaus pamela:pam patricia:pat,patty,tricia patrick:pat,paddy "
    "peter:pete philip:phil,pip philippa:pippa,pip,phil rebecca:becky,becca,bex richard:rick,dick,rich,richie robert:bob,bobby,rob,robbie,bert ronald:ron,ronnie samuel:sam,sammy samantha:sam sarah:sally,sadie "
    "stephen:steve,stevie susan:sue,susie suzanne:sue susannah:sue,susie,suki,anna theodore:ted,teddy,theo thomas:tom,tommy timothy:tim victoria:vicky,vic,tori vincent:vince,vinny william:bill,billy,will,willie,liam "
    "yolanda:yoli zachary:zach,zack"
)

_NOTE_SET, _TITLE_SET, _NOBODY_SET, _ORG_SET = (frozenset(x.split()) for x in (NOTES, TITLES, NOBODY, ORGANISATIONS))
_NICK: dict[str, frozenset] = {}
_SHORT: dict[str, tuple] = {}
for _entry in NICKNAMES.split():
    _full, _, _short = _entry.partition(":")
    _SHORT[_full] = tuple(_short.split(","))
    for _s in _SHORT[_full]:
        _NICK[_s] = _NICK.get(_s, frozenset()) | {_full}
_KNOWN = frozenset(_NICK) | frozenset(_SHORT)

_BRACKETS = re.compile(r"\([^()]*\)|\[[^\[\]]*\]|\{[^{}]*\}|<[^<>]*>|♪+|>>+")
_LEADING = re.compile(r"^\s*([^\W\d_]+(?: [^\W\d_]+)?)\s*(?:\s[-–—|:]|/)\s+(?=\S)")
_TRAILING = re.compile(r"\s+[-–—/|]\s+([^\W\d_]+)\s*$")
_CAMEL = re.compile(r"(?<=[^\W\d_A-Z])(?=[A-ZÀ-Þ])")
_NICK_QUOTE = re.compile(r"[“\"'‘]\s*([^\W\d_]+)\s*[”\"'’](?=\s|$)")
_TOKEN = re.compile(r"[^\W_]+(?:'[^\W_]+)*\.?")


def _fold(s: str) -> str:
    """Lower case without accents; a closing -ie or -ey is written -y, which typists mix."""
    s = unicodedata.normalize("NFKD", s)
    s = "".join(c for c in s if not unicodedata.combining(c)).lower()
    return re.sub(r"(?<=[^\W\d_]{3})(?:ie|ey)\b", "y", s)


def parse_form(form: str | None) -> tuple[str, list[str], str, bool] | None:
    """``(kind, parts, nickname, comma)`` of a typed form, null if it names nobody.

    ``kind`` is ``person`` or ``org``; parts keep a closing point where the form abbreviates. With a comma the
    parts come in spoken order already.
    """
    s = re.sub(r"\s+", " ", _BRACKETS.sub(" ", form or "")).strip().strip(":;,").strip()
    for pattern in (_LEADING, _TRAILING):
        m = pattern.search(s)
        if m and m[1].lower() in _NOTE_SET | _TITLE_SET | _NOBODY_SET:
            s = (s[: m.start()] + " " + s[m.end() :]).strip()
    nick = ""
    m = _NICK_QUOTE.search(s)
    if m:
        nick = _fold(m[1])
        s = (s[: m.start()] + " " + s[m.end() :]).strip()
    s = _CAMEL.sub(" ", s) if " " not in s.strip() else s
    comma = False
    if s.count(",") == 1:
        a, b = (x.strip() for x in s.split(","))
        if a and b and _fold(b).strip(".") not in _TITLE_SET | _NOTE_SET:
            s, comma = f"{b} {a}", True
    s = _fold(s).replace("-", " ").replace("’", "'")
    parts = [t[:-2] if t.endswith("'s") else t for t in _TOKEN.findall(s)]
    while parts and parts[0].rstrip(".") in _TITLE_SET and len(parts) > 1:
        parts = parts[1:]
    bare = [p.rstrip(".") for p in parts]
    if not parts or all(b in _NOBODY_SET or b.isdigit() for b in bare) or not any(len(b) > 1 for b in bare):
        return None
    org = sum(b in _ORG_SET for b in bare) >= 1 and len(bare) >= 2
    if org:
        parts = [p for p in parts if p not in ("the", "of", "for", "and", "s")]
        return "org", parts, "", comma
    if len(parts[-1]) > 5:
        parts[-1] = parts[-1].rstrip(".")
    return "person", parts, nick, comma


def _osa1(a: str, b: str) -> bool:
    if a == b:
        return True
    la, lb = len(a), len(b)
    if abs(la - lb) > 1 or min(la, lb) < 3:
        return False
    i = 0
    while i < la and i < lb and a[i] == b[i]:
        i += 1
    if la == lb:
        return a[i + 1 :] == b[i + 1 :] or (a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :])
    return a[i + 1 :] == b[i:] if la > lb else a[i:] == b[i + 1 :]


def _near2(a: str, b: str) -> bool:
    """Two slips apart at most: too close to call a conflict."""
    if _osa1(a, b):
        return True
    if min(len(a), len(b)) < 5 or abs(len(a) - len(b)) > 2:
        return False
    prev = list(range(len(b) + 1))
    before: list[int] = []
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            v = min(prev[j] + 1, row[-1] + 1, prev[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, before[j - 2] + 1)
            row.append(v)
        before, prev = prev, row
    return prev[-1] <= 2


def _first_agrees(a: str, b: str) -> float:
    """1 same first name, 0.9 an initial or short form, 0 open, CONFLICT different."""
    x, y = a.rstrip("."), b.rstrip(".")
    if not x or not y:
        return 0.0
    if x == y:
        return 1.0
    if len(x) > len(y):
        x, y, a, b = y, x, b, a
    xs, ys = _NICK.get(x, frozenset()) | {x}, _NICK.get(y, frozenset()) | {y}
    if len(x) == 1:  # of the name as written or of the one it is short for
        return 0.9 if any(q[0] == x for q in ys) else CONFLICT
    if a.endswith("."):
        if any(q.startswith(x) for q in ys):
            return 0.9
        return 0.4 if _osa1(x, y[: len(x)]) and x[0] == y[0] else CONFLICT if all(q[0] != x[0] for q in ys) else 0.0
    if xs & ys:
        return 1.0
    if any(_osa1(p, q) for p in xs for q in ys if len(p) > 2 and len(q) > 2):
        return 0.9
    if any(p not in _KNOWN and len(p) > 3 and any(_osa1(p, q) for r in s for q in _SHORT.get(r, ()) if len(q) > 3) for p, s in ((x, ys), (y, xs))):
        return 0.9  # a short form with a slip
    if any(_near2(p, q) for p in xs for q in ys):
        return 0.0
    return CONFLICT


def _skeleton(short: str, word: str) -> bool:
    """``short`` is the word with its vowels (and some other letters) left out, as in Bd, Grp, Svc."""
    if not 2 <= len(short) <= len(word) // 2 + 1 or short[0] != word[0] or re.search("[aeiou.]", short):
        return False
    rest = iter(word)
    return all(c in rest for c in short)


def agreement(a: tuple, b: tuple) -> float:
    """How far two cleaned names agree: 1 the same, 0 open, ``CONFLICT`` different people or bodies.

    A name is ``(kind, first, middle, last, nickname)``; for bodies ``first`` holds all parts.
    """
    if a[0] != b[0]:
        return CONFLICT
    if a[0] == "org":
        p, q = a[1].split(" "), b[1].split(" ")
        if len(p) != len(q):
            return CONFLICT
        rest, score = list(q), 1.0
        for x in sorted(p, key=len, reverse=True):
            hit = next((y for y in rest if x == y), None) or next((y for y in rest if _osa1(x, y) and len(x) > 3), None)
            if hit is None:
                hit = next((y for y in rest if _skeleton(x, y) or _skeleton(y, x)), None)
            if hit is None:
                hit = next((y for y in rest if (x.endswith(".") and y.startswith(x[:-1])) or (y.endswith(".") and x.startswith(y[:-1]))), None)
            if hit is None:
                return CONFLICT
            score = min(score, 1.0 if hit == x else 0.9)
            rest.remove(hit)
        return score
    if a[3] != b[3] and not (_osa1(a[3], b[3]) and min(len(a[3]), len(b[3])) > 4):
        return 0.0 if _near2(a[3], b[3]) else CONFLICT
    last = 1.0 if a[3] == b[3] else 0.9
    first = _first_agrees(a[1], b[1])
    for x, y in ((a[4], b[1]), (b[4], a[1])):
        if x and first < 0.9:
            first = max(first, _first_agrees(x, y))
    if first <= 0:
        return first
    if a[2] and b[2]:
        m = [_first_agrees(x, y) for x, y in zip(a[2].split(" "), b[2].split(" "))]
        if min(m) == CONFLICT:
            return CONFLICT
    return min(first, last)


def score(cosine: float, agreed: float) -> int:
    """The score of a pair in ``UNIT``: the mean of its cosine and of how far its parts agree; a conflict counts as such,
    and a pair whose parts leave it open counts nothing, however near in letters."""
    return round(UNIT * (CONFLICT if agreed < 0 else (cosine + agreed) / 2 if agreed else 0.0))


_PARSED = "name_id bigint, kind string, parts array<string>, nick string, comma boolean"


def parsed_forms(forms: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(i, *p) for i, f in zip(b["name_id"], b["name_form"]) if (p := parse_form(f)) is not None]
            yield pd.DataFrame(rows, columns=["name_id", "kind", "parts", "nick", "comma"])

    return forms.select("name_id", "name_form").mapInPandas(run, _PARSED)


def cleaned_names(forms: DataFrame) -> DataFrame:
    """``name_id, kind, first, middle, last, nick``. Which end of a name is the surname is told by the corpus: how
    many different partners a word has at either end of all names."""
    p = cut(parsed_forms(forms))
    ends = p.filter("kind = 'person' and size(parts) >= 2").select(F.element_at("parts", 1).alias("a"), F.element_at("parts", -1).alias("z"))
    front = ends.groupBy(F.col("a").alias("w")).agg(F.countDistinct("z").alias("f"))
    back = ends.groupBy(F.col("z").alias("w")).agg(F.countDistinct("a").alias("l"))
    stat = _join(front, back, "w", "full").select("w", F.coalesce("f", F.lit(0)).alias("f"), F.coalesce("l", F.lit(0)).alias("l"))
    # A word is a surname rather than a first name by the share of its standings at the end.
    sa = stat.select(F.col("w").alias("a"), F.log((F.col("l") + 0.1) / (F.col("f") + 0.1)).alias("la"))
    sz = stat.select(F.col("w").alias("z"), F.log((F.col("l") + 0.1) / (F.col("f") + 0.1)).alias("lz"))
    two = _join(_join(p.withColumns({"a": F.element_at("parts", 1), "z": F.element_at("parts", -1)}), sa, "a", "left"), sz, "z", "left")
    turned = (F.col("kind") == "person") & (F.size("parts") == 2) & ~F.col("comma") & (F.length("z") > 1) & (F.coalesce("la", F.lit(0.0)) > F.coalesce("lz", F.lit(0.0)))
    many = F.size("parts") >= 2
    org = F.col("kind") == "org"
    first = F.when(org, F.array_join(F.array_sort("parts"), " ")).when(~many, F.lit("")).when(turned, F.col("z")).otherwise(F.col("a"))
    last = F.when(org, F.lit("")).when(turned, F.col("a")).otherwise(F.col("z"))
    middle = F.when(org | (F.size("parts") < 3), F.lit("")).otherwise(F.array_join(F.slice("parts", 2, F.greatest(F.size("parts") - 2, F.lit(1))), " "))
    return two.select("name_id", "kind", first.alias("first"), middle.alias("middle"), F.rtrim(last).alias("last"), "nick")


def trigrams(nodes: DataFrame) -> DataFrame:
    """``node, g, w``: unit vectors of distinct character trigrams, weighted by rarity over all nodes."""

    def grams(text: Column, share: float) -> Column:
        words = F.filter(F.split(text, r"[ .]+"), lambda x: x != "")
        padded = F.transform(words, lambda x: F.concat(F.lit("^"), x, F.lit("$")))
        cut3 = F.transform(padded, lambda x: F.transform(F.sequence(F.lit(1), F.greatest(F.length(x) - 2, F.lit(1))), lambda i: x.substr(i, F.lit(3))))
        return F.transform(F.array_distinct(F.flatten(cut3)), lambda g: F.struct(g.alias("g"), F.lit(share).alias("share")))

    # What tells people apart from others of their first name weighs more than the first name.
    person = F.col("kind") == "person"
    both = F.concat(grams(F.col("last"), 1.0), F.when(person, grams(F.col("first"), FIRST_SHARE)).otherwise(grams(F.col("first"), 1.0)))
    flat = nodes.select("node", F.inline(both)).groupBy("node", "g").agg(F.max("share").alias("share"))
    df = flat.groupBy("g").agg(F.count("*").alias("df")).filter("df > 1")  # a gram of one node supports no link
    total = float(nodes.count())
    weighted = cut(_join(flat, df, "g").withColumn("raw", F.col("share") * (F.log(F.lit(total) / F.col("df")) + 0.1)))
    norm = weighted.groupBy("node").agg(F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("norm"))
    return _join(weighted, norm, "node").select("node", "g", "df", (F.col("raw") / F.col("norm")).alias("w"))


def _join(x: DataFrame, y: DataFrame, on, how: str = "inner") -> DataFrame:
    """A join by shuffle: neither side passes through the driver."""
    return x.join(y.hint("merge"), on, how)


def similar_pairs(vectors: DataFrame, threshold: float = COSINE, posting: int = POSTING) -> DataFrame:
    """``a, b, cosine`` of every pair of nodes with at least ``threshold``: exact, by prefix filtering.

    A vector's grams are ordered from the rarest; once those left weigh less than a part of the threshold together,
    only the grams before are joined. A pair's products there plus the most that the rest can add bound its cosine;
    products over the whole vectors are summed for the pairs that can still reach the threshold. The names of a
    common gram are dealt into parts of about ``posting``, each of which meets all of them in a task of its own.
    """
    w = Window.partitionBy("node").orderBy(F.desc("df"), F.desc("g"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    ranked = vectors.withColumn("norm", norm)
    kept = F.col("norm") >= TAIL * threshold - 1e-9
    tail = F.coalesce(F.max(F.when(~kept, F.col("norm"))).over(Window.partitionBy("node")), F.lit(0.0))
    parts = F.ceil(F.col("df") / posting).cast("int")
    prefix = cut(ranked.withColumn("tail", tail).filter(kept).select("node", "g", "w", "tail", parts.alias("parts")))
    a = prefix.select(F.col("node").alias("a"), "g", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"), F.col("w").alias("wa"), F.col("tail").alias("ta"))
    b = prefix.select(F.col("node").alias("b"), "g", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("w").alias("wb"), F.col("tail").alias("tb"))
    # What the grams left out can add is at most the larger tail, so most chance meetings end here.
    met = _join(a, b, ["g", "part"]).filter("a < b").groupBy("a", "b")
    met = met.agg(F.sum(F.col("wa") * F.col("wb")).alias("sum"), F.max(F.greatest("ta", "tb")).alias("rest"))
    pairs = met.filter(F.col("sum") + F.col("rest") >= threshold - 1e-9).select("a", "b")
    whole = cut(vectors.groupBy("node").agg(F.map_from_entries(F.collect_list(F.struct("g", "w"))).alias("v")))  # one name's grams
    both = _join(_join(pairs, whole.select(F.col("node").alias("a"), F.col("v").alias("va")), "a"), whole.select(F.col("node").alias("b"), F.col("v").alias("vb")), "b")
    dot = F.aggregate(F.map_entries("va"), F.lit(0.0), lambda s, e: s + e["value"] * F.coalesce(F.try_element_at(F.col("vb"), e["key"]), F.lit(0.0)))
    return both.select("a", "b", dot.alias("cosine")).filter(F.col("cosine") >= threshold)


def top_partners(pairs: DataFrame, n: int = TOP) -> tuple[DataFrame, DataFrame]:
    """The pairs that are among the ``n`` best of either end, and the rest; equal cosines are ranked by number."""
    ways = pairs.select("a", "b", "cosine").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "cosine"))
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("cosine"), "b"))
    best = ways.withColumn("rank", rank).filter(F.col("rank") <= n).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "cosine")
    best = cut(best.groupBy("a", "b").agg(F.first("cosine").alias("cosine")))
    return best, _join(pairs, best.select("a", "b"), ["a", "b"], "left_anti")


def components(links: DataFrame) -> DataFrame:
    """``node, comp`` of the nodes of ``a, b``: the smallest node that each is connected with.

    Every round takes the least label of a node's neighbours and then that label's own, so labels travel twice as far
    each time.
    """
    edges = cut(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    now = cut(edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("comp")))
    while True:
        near = _join(edges, now.select(F.col("node").alias("b"), "comp"), "b").groupBy("a").agg(F.min("comp").alias("m"))
        hooked = _join(now, near.withColumnRenamed("a", "node"), "node").select("node", "comp", F.least("comp", "m").alias("to"))
        target = hooked.select(F.col("node").alias("to"), F.col("to").alias("further"))
        step = cut(_join(hooked, target, "to").select("node", "further", (F.col("further") != F.col("comp")).alias("moved")))
        now = step.select("node", F.col("further").alias("comp"))
        if step.filter("moved").isEmpty():
            return now


def _best_value(s: Column, na: Column, nb: Column) -> Column:
    """Average score of two groups as a whole number, the same in the JVM and in Python."""
    return F.floor(s / (na * nb) * 1000 + 0.5)


def average_linkage(nodes: DataFrame, links: DataFrame, least: float = LINKAGE) -> DataFrame:
    """``node, cluster`` by average linkage over ``a, b, s`` (scores in ``UNIT``; pairs without a link count 0).

    Rounds of reciprocal nearest neighbours give the same tree as merging one pair after another; ties go to the
    smaller cluster number. Only links and sizes are shuffled.
    """
    size = nodes.select(F.col("node").alias("c")).withColumn("n", F.lit(1).cast("long"))
    member = cut(nodes.select("node", F.col("node").alias("cluster")))
    edges = cut(links.select("a", "b", "s").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"), "s")))
    while True:
        sized = _join(_join(edges, size.select(F.col("c").alias("a"), F.col("n").alias("na")), "a"), size.select(F.col("c").alias("b"), F.col("n").alias("nb")), "b")
        avg = sized.withColumn("v", _best_value(F.col("s"), F.col("na"), F.col("nb"))).filter(F.col("v") >= least * UNIT * 1000)
        key = F.struct("v", -F.least("a", "b"), -F.greatest("a", "b"))
        best = avg.groupBy("a").agg(F.max_by("b", key).alias("b"))
        mutual = _join(best, best.select(F.col("a").alias("b"), F.col("b").alias("a")), ["a", "b"]).filter("a < b")
        merges = cut(mutual.select(F.col("b").alias("c"), F.col("a").alias("into")))
        if merges.isEmpty():
            return member
        goes = lambda df, col: _join(df, merges.select(F.col("c").alias(col), F.col("into").alias("to")), col, "left").withColumn(col, F.coalesce("to", col)).drop("to")
        member = cut(goes(member, "cluster"))
        edges = cut(goes(goes(edges, "a"), "b").filter("a <> b").groupBy("a", "b").agg(F.sum("s").alias("s")))
        size = cut(goes(size, "c").groupBy("c").agg(F.sum("n").alias("n")))


def link_component(links: list[tuple[int, int, int]], least: float = LINKAGE) -> dict[int, int]:
    """What :func:`average_linkage` does, for the links of one component within a task."""
    near: dict[int, dict[int, int]] = {}
    for a, b, s in links:
        near.setdefault(a, {})[b] = s
        near.setdefault(b, {})[a] = s
    size, cluster = dict.fromkeys(near, 1), {x: x for x in near}
    floor = least * UNIT * 1000
    while True:
        best = {}
        for a, others in near.items():
            top = None
            for b, s in others.items():
                v = math.floor(s / (size[a] * size[b]) * 1000 + 0.5)
                key = (v, -min(a, b), -max(a, b))
                if v >= floor and (top is None or key > top[0]):
                    top = key, b
            if top:
                best[a] = top[1]
        merges = {b: a for a, b in best.items() if a < b and best.get(b) == a}
        if not merges:
            return cluster
        cluster = {x: merges.get(c, c) for x, c in cluster.items()}
        joined: dict[int, dict[int, int]] = {}
        for a, others in near.items():
            into = joined.setdefault(merges.get(a, a), {})
            for b, s in others.items():
                b = merges.get(b, b)
                if b != merges.get(a, a):
                    into[b] = into.get(b, 0) + s
        for b, a in merges.items():
            size[a] += size.pop(b)
        near = joined


def clustered(nodes: DataFrame, links: DataFrame, least: float = LINKAGE, most: int = COMPONENT) -> DataFrame:
    """``node, cluster`` by average linkage. No group is merged across components of the positive links, so each
    component is solved by itself: in a task if it has ``most`` links at most, else by joins."""
    comp = components(links.filter("s > 0"))
    at = lambda s: comp.select(F.col("node").alias(s), F.col("comp").alias(f"c{s}"))
    inside = cut(_join(_join(links, at("a"), "a"), at("b"), "b").filter("ca = cb").select(F.col("ca").alias("comp"), "a", "b", "s"))
    size = inside.groupBy("comp").agg(F.count("*").alias("n"))
    sized = cut(_join(inside, size, "comp"))

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, held = None, []

        def close() -> list[tuple[int, int]]:
            return list(link_component(held, least).items()) if held else []

        for t in batches:
            done: list[tuple[int, int]] = []
            for c, a, b, s in zip(t["comp"].tolist(), t["a"].tolist(), t["b"].tolist(), t["s"].tolist()):
                if c != here:
                    done += close()
                    here, held = c, []
                held.append((a, b, s))
            yield pd.DataFrame(done, columns=["node", "cluster"])
        yield pd.DataFrame(close(), columns=["node", "cluster"])

    laid = sized.filter(F.col("n") <= most).repartition(parallelism(nodes.sparkSession), "comp").sortWithinPartitions("comp")
    found = laid.select("comp", "a", "b", "s").mapInPandas(solve, "node bigint, cluster bigint")
    large = sized.filter(F.col("n") > most)
    if not large.isEmpty():
        ends = large.select(F.col("a").alias("node")).unionByName(large.select(F.col("b").alias("node"))).distinct()
        found = found.unionByName(average_linkage(ends, large, least))
    return _join(nodes.select("node"), found, "node", "left").select("node", F.coalesce("cluster", "node").alias("cluster"))


def entities(forms: DataFrame) -> DataFrame:
    """``name_id, entity`` of every form that names someone; forms of one entity share a number.

    Null, blank and nobody's labels are left out. A surname alone joins an entity only where one entity has it.
    """
    names = cleaned_names(forms)
    cols = ["kind", "first", "middle", "last", "nick"]
    keyed = cut(names.withColumn("node", F.xxhash64(*cols)))
    nodes = keyed.groupBy("node").agg(*[F.min(c).alias(c) for c in cols])
    nodes = cut(nodes)
    named = nodes.filter("kind = 'org' or first <> ''")
    best, rest = top_partners(cut(similar_pairs(cut(trigrams(named)))))
    part = lambda s: named.select(F.col("node").alias(s), F.struct(*cols).alias(f"n{s}"))
    wide = _join(_join(best.unionByName(rest), part("a"), "a"), part("b"), "b")

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            s = [score(c, agreement(tuple(x[k] for k in cols), tuple(y[k] for k in cols))) for c, x, y in zip(t["cosine"], t["na"], t["nb"])]
            out = t[["a", "b"]].assign(s=s)
            yield out[out["s"] != 0]

    links = cut(wide.select("a", "b", "cosine", "na", "nb").mapInPandas(judge, "a bigint, b bigint, s bigint"))
    groups = cut(clustered(named, links))
    # Surnames alone: joined where all groups with that surname are one.
    alone = nodes.filter("kind = 'person' and first = ''").select(F.col("node").alias("lone"), "last")
    owners = _join(groups, nodes, "node").filter("kind = 'person'").groupBy("last").agg(F.min("cluster").alias("lo"), F.max("cluster").alias("hi"))
    placed = _join(alone, owners, "last", "left").select(F.col("lone").alias("node"), F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(F.col("lone")).alias("cluster"))
    every = groups.unionByName(placed)
    return _join(keyed, every, "node").select("name_id", F.col("cluster").alias("entity"))


def entity_pairs(found: DataFrame) -> DataFrame:
    """``name_id_a, name_id_b``: each pair of forms of one entity, smaller id first."""
    x = found.select("entity", F.col("name_id").alias("name_id_a"))
    y = found.select("entity", F.col("name_id").alias("name_id_b"))
    return _join(x, y, "entity").filter("name_id_a < name_id_b").select("name_id_a", "name_id_b")
