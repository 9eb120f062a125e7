"""Speech transcripts into clean speaker turns (problem 7), by a parsing-expression grammar.

    Transcript <- Item*
    Item       <- Label / Talk / Stamp / Voice / Bracket / Marker / Abbreviation / Note / Word / Char
    Label      <- Heading &{the table of names says that it names a speaker}
    Heading    <- (Word '.'? ','? Blank)? Word Role? ':' &(Space / End)
    Talk       <- (!Label Plain)+
    Stamp      <- '[' Clock ']' / '(' Clock ')' / '<' Clock '>' / Clock with seconds
    Note       <- '[' NoteBody* ']' / '(' ... ')' / '{' ... '}' / '<' ... '>' / '*' ... '*' / music
    NoteBody   <- Note / any other character than the closing one

    Names      <- (Voice / Bracketed / Heading / Other)*

A text is parsed by ``Names`` first: its headings and the names in brackets fill the table of names, which settles
what is a label where a surname follows the last word of talk. The tree of ``Transcript`` is then folded into turns:
labels open turns, words are gathered, stamps and notes fall away; hesitation sounds and comma-set empty phrases are
dropped from the words. Rows are independent of each other, so the work is one pass over partitions.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnloom.llm.peg import Node, choice, guard, nested, rx, seq, star

# Hesitation sounds, empty phrases, sound words and words that never name a speaker.
HESITATIONS = r"(?:u+h*m+|u+h+|e+r+m*|a+h+|e+h+|h+m+|m{2,}|mm+-?h+m+|u+h-?hu+h|u+h-?u+h)"
PHRASES = ("sort of", "kind of", "you know", "i mean", "you see", "i guess", "like", "well", "basically", "actually", "so to speak")
SOUNDS = frozenset(
    "music applause laughter laughs laughing coughs coughing cheers cheering sighs static sirens siren noise silence "
    "crosstalk inaudible unintelligible indistinct clapping crying sobbing whispers shouts booing bell rings phone "
    "door rain wind playing singing chatter gunfire explosion beep pause break".split()
)
NOT_NAMES = frozenset(
    "a an and are as at be but by can do for from had has have he her here his how i if in is it its just me my no not "
    "now of on one or our she so that the their them then there these they thing things this those to up us was we were "
    "what when where which who why will with you your point question answer fact problem issue following case news "
    "example note time warning way idea truth story message rule".split()
)

_W = r"\p{L}[\p{L}\p{M}'’\-]*"
_N = r"\p{L}[\p{L}\p{M}'’\-]*+"
_CLOCK = r"\d{1,3}:\d{2}(?::\d{2})?(?:[.,]\d{1,3})?|\d{1,3}h\d{1,2}m(?:\d{1,2}s)?|\d{1,3}m\d{1,2}s"

_stamp = choice(
    guard("[(<", rx("stamp", rf"\[\s*(?:{_CLOCK})\s*\]|\(\s*(?:{_CLOCK})\s*\)|<\s*(?:{_CLOCK})\s*>")),
    guard("0123456789", rx("stamp", r"\d{1,2}:\d{2}:\d{2}(?:[.,]\d{1,3})?(?![\w:])")),
)
_marker = guard(">", rx("marker", r">>+"))
_abbrev = guard("(", rx("abbrev", r"\((?=[^()\s]*\p{Lu})[\p{Lu}\d&.\-]{2,7}\)"))
_voice = guard("<", rx("voice", r"<v[ .][^<>\n]{1,80}>"))
_bracket_name = guard("[", rx("bracket", rf"\[\s*{_W}\.?,?(?: {_W}\.?){{0,3}}\s*\]:?"))
_word = rx("word", r"[^\s\[\](){}<>*♪♫♬]+")
_char = rx("char", r"(?s).")


LINE = 300  # a longer annotation, or one over several lines, holds no label


def _closing(text: str, sign: str, pos: int, state: dict) -> int:
    """Where ``sign`` stands next from ``pos`` on, -1 if nowhere; places are gathered once a text."""
    places = state.setdefault(("closing", sign), None)
    if places is None:
        places = state["closing", sign] = [m.start() for m in re.finditer(sign, text)]
    i = bisect_right(places, pos - 1)
    return places[i] if i < len(places) else -1


def _spans_speech(text: str, pos: int, end: int, state: dict) -> bool:
    """A long annotation or one of several lines would hold a speaker's label or marker: its sign was never closed."""
    if end - pos <= LINE and text.find("\n", pos, end) < 0:
        return False
    i = bisect_right(state["starts"], pos)
    return (i < len(state["starts"]) and state["starts"][i] < end) or text.find(">>", pos, end) >= 0


def _note_rule(opening: str, closing: str):
    other = rx("inner", rf"[^{regex.escape(opening + closing)}\[\](){{}}<>]+|[^{regex.escape(closing)}]")
    whole = seq("note", rx("open", regex.escape(opening)), star("body", choice(nested(lambda: _note), other)), rx("close", regex.escape(closing)))

    def closes(text: str, pos: int, state: dict) -> Node | None:
        n = whole(text, pos, state) if _closing(text, re.escape(closing), pos + 1, state) >= 0 else None
        return n if n and not _spans_speech(text, pos, n.end, state) else None

    return guard(opening, closes)


def _paired(opening: str, sign: str, body: str, otherwise: str = ""):
    """A note from ``opening`` to the next ``sign``, if what lies between is all ``body``; else what ``otherwise`` matches."""
    within, alone = regex.compile(body), regex.compile(otherwise) if otherwise else None

    def rule(text: str, pos: int, state: dict) -> Node | None:
        m = alone and alone.match(text, pos)
        if m and m.end() > pos + 1:
            return Node("note", pos, m.end())
        end = _closing(text, sign, pos + 1, state)
        inner = within.match(text, pos + 1) if end > pos + 1 else None
        if inner and inner.end() == end and not _spans_speech(text, pos, end, state):
            return Node("note", pos, end + 1)
        return Node("note", pos, m.end()) if m else None

    return guard(opening, rule)


_music = _paired("♪♫♬", "[♪♫♬]", r"[^♪♫♬<\[({>]+", r"[♪♫♬]+")
_starred = _paired("*", r"\*", r"[^*]+")
_angle = _paired("<", ">", r"[^<>]+")
_note = choice(_note_rule("[", "]"), _note_rule("(", ")"), _note_rule("{", "}"), _angle, _starred, _music)
_memo_note = nested(lambda: _note)


#: A heading is sought from where a word begins; ``Talk`` runs up to the next one.
_HEAD = rf"(?<![\p{{L}}\p{{M}}])(?<!\p{{L}}['’\-])(?:(?P<one>{_N})(?P<mark>\.?,?)[ \u00a0])?(?P<two>{_N})(?P<role>\s*(?:\([^()\n]{{1,40}}\))?\s?):(?=\s|$)"
_heading_of = regex.compile(_HEAD, regex.V1)
_MAY_NAME = re.compile(r":|\[|<v")


def _heading(text: str, pos: int, state: dict) -> Node | None:
    m = _heading_of.match(text, pos)
    if m is None:
        return None
    first = m["one"] + m["mark"] if m["one"] is not None else None
    return Node("heading", pos, m.end(), value=[m["two"]] if first is None else [first, m["two"]])


def _label(text: str, pos: int, state: dict) -> Node | None:
    """A heading that the table of names takes for a speaker's."""
    name = state["labels"].get(pos)
    n = _heading(text, pos, state) if name else None
    return Node("label", pos, n.end, value=name) if n else None


def _bracket_label(text: str, pos: int, state: dict) -> Node | None:
    n = _bracket_name(text, pos, state)
    if n is None:
        return None
    inside = text[pos + 1 : n.end].rstrip(":").rstrip("]").strip()
    name = _name_of(inside)
    words = [w.lower() for w in regex.findall(_W, inside)]
    if name is None or any(w in SOUNDS or w in NOT_NAMES for w in words):
        return None
    title = all(w[0].isupper() and (len(w) == 1 or not w.isupper()) for w in regex.findall(_W, inside))
    return Node("label", pos, n.end, value=name) if title or name[1] in state["surnames"] else None


def _voice_label(text: str, pos: int, state: dict) -> Node | None:
    n = _voice(text, pos, state)
    return Node("label", pos, n.end, value=_name_of(text[pos + 3 : n.end - 1].strip())) if n else None


_plain = regex.compile(r"[^\[\](){}<>*♪♫♬\d]+")


def _talk(text: str, pos: int, state: dict) -> Node | None:
    """Plain words up to the next character that can open something else, or the next label."""
    m = _plain.match(text, pos)
    if m is None:
        return None
    i = bisect_right(state["starts"], pos)
    stop = state["starts"][i] if i < len(state["starts"]) else len(text)
    return Node("word", pos, min(m.end(), stop))


TRANSCRIPT = star("transcript", choice(_label, _talk, _stamp, _voice_label, _bracket_label, _marker, _abbrev, _memo_note, _word, _char))

_bracketed = guard("<[", rx("named", r"<v[ .][^<>\n]{1,80}>|\[(?:\p{Lu}[\p{L}'’.\-]*,? ?){1,3}\]"))
_opens_name = regex.compile(r"<v[ .][^<>\n]{1,80}>|\[(?:\p{Lu}[\p{L}'’.\-]*,? ?){1,3}\]", regex.V1)


def _next_heading(text: str, pos: int) -> int:
    """Where the next heading begins from ``pos`` on, -1 if nowhere. It ends in a colon, so only the two words (and what
    is said of their role) before each colon are tried."""
    at = pos
    while (c := text.find(":", at)) >= 0:
        if text[c + 1 : c + 2].isspace() or c + 1 == len(text):
            part = text[at:c].rstrip()
            if part.endswith(")") and (k := part.rfind("(")) >= 0:
                part = part[:k].rstrip()
            words = part.rsplit(None, 2)
            m = _heading_of.search(text, at + (len(part) - len(part.lstrip()) + len(words[0]) if len(words) == 3 else 0), c + 2)
            if m and m.end() == c + 1:
                return m.start()
        at = c + 1
    return -1


def _other(text: str, pos: int, state: dict) -> Node | None:
    """Whatever stands before the next name."""
    m = _opens_name.search(text, pos + 1)
    ends = [x for x in (_next_heading(text, pos + 1), m.start() if m else -1) if x >= 0]
    return Node("other", pos, min(ends, default=len(text)))


NAMES = star("names", choice(_bracketed, _heading, _other))


_HES = re.compile(rf"(?<![\w'’\-])(?=[uerahmUERAHM])(?:{HESITATIONS})(?![\w'’]|-\w)", re.I)
_PHRASE = re.compile(rf"(?:(?<=[,.!?;:…])|^)\s*(?:{'|'.join(PHRASES)})\s*(?=,)", re.I)
_SPOKEN = re.compile(r"\S*[^\W_]\S*")
_SPACE, _BEFORE_MARK, _COMMAS = re.compile(r"\s+"), re.compile(r"\s+([,.!?;:])"), re.compile(r",(?:\s*,)+")
_IN_BRACKETS, _ENDS_CLOCK = re.compile(r"\([^()]*\)"), re.compile(r"\d:\d\d[\d.:]*\s*$")
_PREVIOUS = regex.compile(rf"({_W})[,;]?\s*$", regex.V1)


def _name_of(label: str) -> tuple[str, str] | None:
    """``(first or initial or '', surname)`` in lower case of a label's name part."""
    s = _IN_BRACKETS.sub("", label).strip(" .:-").lower()
    s = _SPACE.sub(" ", s)
    if not s:
        return None
    if "," in s:
        last, _, first = s.partition(",")
        return first.strip(" ."), last.strip(" .")
    first, _, last = s.rpartition(" ")
    return first.strip(" ."), last.strip(" .")


def _plausible(words: list[str]) -> bool:
    return not any(w.lower() in NOT_NAMES or w.lower() in SOUNDS for w in words)


def _shape(w: str) -> str:
    if w.isupper() and len(w) > 1:
        return "U"
    return "T" if w[0].isupper() else "l"


def _stands_alone(text: str, start: int) -> bool:
    """Nothing, a line's end, a marker, a note, a stamp or a sentence's end comes before ``start``."""
    k = start
    while k and text[k - 1].isspace():
        k -= 1
        if text[k] == "\n":
            return True
    return not k or text[k - 1] in ">])}♪*.!?" or _ENDS_CLOCK.search(text[max(0, k - 16) : k]) is not None


def table_of_names(text: str) -> tuple[dict, set]:
    """Which headings of ``text`` are labels, ``{start: (first, surname)}``, and the surnames met.

    A heading of two words is told from one of a surname after the last word of talk by what else the text says:
    names that stand alone (at a line's start, after ``>>``, a stamp or a note), names in brackets, and words
    whose letter case differs from the talk before them.
    """
    found, full, surnames = [], {}, set()
    if not _MAY_NAME.search(text):
        return {}, surnames
    for k in NAMES(text, 0, {}).kids:
        if k.name == "named":
            n = _name_of(text[k.start + (3 if text[k.start] == "<" else 1) : k.end - 1])
            if n and _plausible(n[0].split() + [n[1]]):
                surnames.add(n[1])
                if len(n[0]) > 1:
                    full.setdefault(n[1], []).append(n[0])
        elif k.name == "heading":
            prev = _PREVIOUS.search(text[max(0, k.start - 60) : k.start])
            found.append((k.start, k.end, k.value, _stands_alone(text, k.start), prev[1] if prev else ""))
    sure, loose = [], []
    for start, end, parts, hard, prev in found:
        if len(parts) == 2 and _plausible(parts):
            comma = parts[0].endswith(",")
            initial = len(parts[0].rstrip(".,")) == 1 or len(parts[1].rstrip(".")) == 1
            a, b = _shape(parts[0]), _shape(parts[1])
            if comma or (initial and (hard or a in "TU")) or (a == b and (hard or a in "TU" and prev and _shape(prev) != a)) or (a == b == "T"):
                sure.append((start, end, _name_of(" ".join(parts))))
                continue
        if len(parts) == 1 and _plausible(parts) and hard:
            sure.append((start, end, _name_of(parts[0])))
            continue
        loose.append((start, end, parts))
    for _, _, n in sure:
        surnames.add(n[1])
        if len(n[0]) > 1:
            full.setdefault(n[1], []).append(n[0])
    labels = {s: n for s, _, n in sure}
    for start, end, parts in loose:
        last = parts[-1].strip(".,").lower()
        if len(parts) == 2:
            first = parts[0].strip(".,").lower()
            if first in full.get(last, ()):
                labels[start] = (first, last)
                continue
            if last in surnames or (last not in NOT_NAMES and first in NOT_NAMES and _shape(parts[1]) != "l"):
                labels[start + len(parts[0]) + 1] = ("", last)
                surnames.add(last)
                continue
            if _plausible(parts):
                labels[start] = (first, last)
                surnames.add(last)
                full.setdefault(last, []).append(first)
        elif last in surnames or (_plausible(parts) and _shape(parts[0]) != "l"):
            labels[start] = ("", last)
            surnames.add(last)
    return labels, surnames


def clean_words(text: str) -> tuple[str, int, bool]:
    """Drop hesitations and comma-set phrases: ``(clean text, words, anything dropped)``."""
    out, n = _HES.subn("", text)
    k, total = 1, n
    while k:
        out, k = _PHRASE.subn("", out)
        total += k
    words = _SPOKEN.findall(out)
    clean = _BEFORE_MARK.sub(r"\1", _SPACE.sub(" ", out)).strip(" ,")
    clean = _COMMAS.sub(",", clean)
    return clean, len(words), total > 0


def parse_turns(text: str | None) -> tuple[list[tuple[str, str, int]], bool]:
    """Turns ``(speaker, words, word count)`` of a transcript in order, and whether anything was removed.

    Turns without words are dropped; null and blank texts have none. Neighbouring stretches of one speaker are
    one turn. Speech without a label at the start, or after a bare marker, is by ``unknown``.
    """
    if not text or not text.strip():
        return [], False
    labels, surnames = table_of_names(text)
    state = {"labels": labels, "surnames": surnames, "starts": sorted(labels)}
    tree = TRANSCRIPT(text, 0, state)
    firsts: dict[str, list[str]] = {}
    for k in tree.kids:
        if k.name == "label" and k.value and len(k.value[0]) > 1:
            seen = firsts.setdefault(k.value[1], [])
            if k.value[0] not in seen:
                seen.append(k.value[0])

    def who(v: tuple[str, str] | None) -> str:
        if v is None:
            return "unknown"
        first, last = v
        if len(first) <= 1:
            options = [f for f in firsts.get(last, ()) if f.startswith(first)]
            first = options[0] if options else first
        return f"{first} {last}".strip()

    turns: list[list] = []
    removed, speaker, pending, bare = False, "unknown", [], False
    for k in tree.kids:
        if k.name == "label":
            turns.append([speaker, pending])
            speaker, pending, removed = who(k.value), [], True
        elif k.name == "marker":
            turns.append([speaker, pending])
            speaker, pending, removed = "unknown", [], True
        elif k.name in ("stamp", "note"):
            removed = True
            pending.append(" ")
        else:
            pending.append(text[k.start : k.end])
    turns.append([speaker, pending])
    merged: list[list] = []
    for s, p in turns:
        piece = "".join(p)
        if not piece.strip():
            continue
        if merged and merged[-1][0] == s:
            merged[-1][1] += "\n" + piece
        else:
            merged.append([s, piece])
    out = []
    for s, piece in merged:
        clean, n, dropped = clean_words(piece)
        removed = removed or dropped
        if n:
            out.append((s, clean, n))
    return out, removed


_NOTE_AROUND = regex.compile(r"\([^()]*\)|\[[^\[\]]*\]|\{[^{}]*\}|<[^<>]*>|♪+|>>+")
_PREFIX = regex.compile(r"^\p{L}[\p{L} ]{1,20}? ?(?:\s[-–—/|]|/)\s+(?=\S)")


def speaker_name(s: str | None) -> str:
    """The name within a typed speaker, in lower case: notes around it and a closing mark are dropped."""
    s = _SPACE.sub(" ", _NOTE_AROUND.sub(" ", s or "")).strip()
    s = _PREFIX.sub("", s).strip().rstrip(":").strip().lower()
    if s.endswith(".") and len(regex.split(r"[ .\-]", s.rstrip("."))[-1]) > 4:
        s = s.rstrip(".").strip()
    return s or "unknown"


_TURNS = "row_key string, turn_no bigint, speaker string, utterance string, n_words bigint"


def transcript_turns(df: DataFrame, key: str, text: str) -> DataFrame:
    """Turns of labelled transcripts: ``row_key, turn_no, speaker, utterance, n_words``, numbered from 0."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, i, s, u, n) for k, t in zip(b["k"], b["t"]) for i, (s, u, n) in enumerate(parse_turns(t)[0])]
            yield pd.DataFrame(rows, columns=["row_key", "turn_no", "speaker", "utterance", "n_words"])

    return df.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInPandas(run, _TURNS)


def clean_dialogues(df: DataFrame, key: str, text: str, speaker: str, version: str) -> DataFrame:
    """One clean turn per dialogue from which something was removed and words are left.

    Rows delivered again (same ``key``) count once, the latest ``version`` holding.
    """
    latest = df.groupBy(F.col(key).alias("k")).agg(F.max_by(F.struct(F.col(text).alias("t"), F.col(speaker).alias("s")), F.struct(version, text)).alias("v"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for k, t, s in zip(b["k"], b["t"], b["s"]):
                turns, removed = parse_turns(t)
                if removed and turns:
                    rows.append((k, 0, speaker_name(s), " ".join(u for _, u, _ in turns), sum(n for _, _, n in turns)))
            yield pd.DataFrame(rows, columns=["row_key", "turn_no", "speaker", "utterance", "n_words"])

    return latest.select("k", "v.t", "v.s").mapInPandas(run, _TURNS)
