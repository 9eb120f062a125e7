"""Sentence boundaries across languages and scripts (problem 2), by cascading rule tables.

Every place that could end a sentence is met with the rules of its language, top to bottom: a rule is a pair of
patterns, one for the text that ends there and one for the text that begins there, and says break or no break.
The first rule whose two patterns fit decides. Tables cascade: the language's own rules come first, then those
of its script. Line breaks and speaker marks always end a sentence; places within a closed quotation or bracket
are never asked. Rows are independent, so the work is one pass over partitions without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Abbreviations by language. "always" never ends a sentence before a capital; "number" not before
# a digit; "inner" may end one, so only a small letter after it keeps the sentence going (the default).
ALWAYS = {
    "en": "Mr Mrs Ms Mx Dr Prof Rev Hon Gen Col Maj Capt Lt Sgt Cpl Cmdr Adm Gov Sen Rep Pres St Mt Ft Messrs Fr Ven "
    "vs cf viz e.g i.e approx c ca al Bro No Nos vol vols fig figs p pp sec ch ed eds art para",
    "de": "Dr Prof Hr Fr Frl St Nr Str Mio Mrd Tsd ca bzw evtl ggf inkl exkl vgl Abs Art Bd Kap S z d h u a o B i "
    "sog bspw Dipl Ing Hbf Jh geb gest Mag",
    "fr": "M MM Mme Mmes Mlle Dr Pr Prof St Ste Mgr Me art chap fig vol p pp no env cf av apr J.-C",
    "es": "Sr Sra Srta Sres D Dª Dña Dr Dra Dres Prof Profa Lic Ing Arq Ud Uds Vd Vds Mons Fr Excmo Gral Cnel Av Avda C núm n art cap fig pág págs vol p pp ej aprox",
    "it": "Sig Sigg Sig.ra Sig.na Dott Dott.ssa Dr Prof Prof.ssa Avv Ing Arch Geom On Rag S SS Mons Cav Gen Col art cap fig pag pagg vol p pp n cfr es ca",
    "pt": "Sr Sra Srs Srta D Dr Dra Drs Prof Profa Eng Arq Exmo Exma V Gen Cel Av R art cap fig pág págs vol p pp n núm ex aprox",
    "nl": "Dhr dhr Mevr mevr Mw mw Mej Dr Drs Ir Ing Mr Prof St Ds Gen Kol Nr art afb blz hfst pag vol p pp nl bijv bv incl excl ca vgl resp tel",
}
# Titles that stand before a name in any of the languages, for texts that give no sign of theirs.
TITLES = "Sra Srta Dra Dott Avv Sig Mme Mlle Hr Frl Dhr Mevr Mw Profa Drs"
NUMBER = {
    "en": "Jan Feb Mar Apr Jun Jul Aug Sep Sept Oct Nov Dec No Nos",
    "de": "Jan Feb Apr Aug Sept Okt Nov Dez",
    "fr": "janv févr avr juil sept oct nov déc",
    "es": "ene feb mar abr jun jul ago sept oct nov dic núm pág",
    "it": "gen febbr mar apr magg giu lug ag sett ott nov dic n pag",
    "pt": "jan fev mar abr jun jul ago set out nov dez núm pág",
    "nl": "jan feb mrt apr jun jul aug sept okt nov dec nr blz",
}
WEEKDAY_OR_MONTH = (
    "(?:Mon|Tues|Wednes|Thurs|Fri|Satur|Sun)day|January|February|March|April|May|June|July|August|September|"
    "October|November|December|Eastern|Pacific|Central|GMT|UTC|BST|CET|ET|EST|EDT"
)
_HINTS = {
    "en": "the of and to in is was for with that on at",
    "de": "der die das und ist von mit den dem ein eine wurde nicht am wer bei",
    "fr": "le la les et est de du des une un dans pour que près reste",
    "es": "el la los las y de del que en un una con por para es fue pero según",
    "it": "il lo la gli di che un una per con del della dei nel nella non è sono",
    "pt": "os um uma não com para dos das ao pelo pela que de da em foi mas são",
    "nl": "het een van de en op voor niet zijn met dat ook aan bij werd naar",
}

_CLOSE = "\"'”’“»›)\\]」』）】》〉"
_OPEN = "\"'“‘„«‹(\\[「『（【《〈¿¡"


def _words(spec: str) -> str:
    return "|".join(re.escape(w) for w in spec.split())


def _table(lang: str, more: str = "") -> list[tuple[bool, str, str]]:
    rows = []
    if lang == "en":
        rows += [
            (False, r"\b[ap]\.m\.$", rf"\s+(?:{WEEKDAY_OR_MONTH})\b"),
            (False, r"\b(?:Jr|Sr|Bros|Inc|Ltd|Co|Corp|Esq)\.$", r"\s+[a-z,]"),
        ]
    if lang == "de":
        rows += [
            (False, r"(?:^|[\s(])\d{1,2}\.$", r"\s+[A-ZÄÖÜ]\w+"),  # ordinals: 3. Bezirk, 22. Juni
            (False, r"\b[a-zäöü]\.$", r"\s+[A-Za-zäöü]\."),
        ]
    rows += [
        (False, rf"(?:^|[\s({_OPEN}’'])(?:{_words(f"{ALWAYS[lang]} {more}")})\.$", r"\s*\S"),
        (False, rf"(?:^|[\s(])(?:{_words(NUMBER[lang])})\.$", r"\s+\d"),
        (False, rf"(?:^|[\s({_OPEN}.\-])[A-ZÀ-Þ]\.$", r"\s*[A-ZÀ-Þ]"),  # initials
    ]
    return rows


_LATIN = [
    (False, r"\w[.]$", r"\w"),  # decimals, addresses, versions: nothing between the mark and the next sign
    (False, r"", r"\s*[,;:%]"),
    (True, rf"[.!?…][{_CLOSE}]*$", rf"\s+[{_OPEN}]*\s*(?:[A-ZÀ-ÞĀ-ž0-9]|$)"),
    (True, rf"[.!?…][{_CLOSE}]*$", r"\s*$"),
    (True, rf"[.!?…][{_CLOSE}]*$", r"\s+[^\sa-zà-ÿ]*[^\x00-ɏ]"),
    (True, rf"[.!?…][{_CLOSE}]*$", rf"\s+[{_OPEN}–—-]+\s*[A-ZÀ-Þ]"),
]
_UNCASED = [
    (False, r"\d[.．]$", r"\d"),
    (True, rf"[.!?؟۔।॥…][{_CLOSE}]*$", r"\s+\S|\s*$"),
    (True, rf"[।॥؟۔][{_CLOSE}]*$", r"\S"),
]
TABLES: dict[str, list[tuple[bool, str, str]]] = {
    **{k: _table(k) + _LATIN for k in ALWAYS},
    "xx": _table("en", TITLES) + _LATIN,  # Latin letters without a sign of their language
    "ru": [
        (False, r"(?:^|[\s(«])(?:ул|пл|пр|им|проф|акад|доц|стр|рис|тыс|млн|млрд|руб|др|см|ср|гр|тов|о|с|т\.\s?е|т\.\s?н|т\.\s?к)\.$", r"\s*\S"),
        (False, r"(?<![\d\w])(?<!\d\s)г\.$", r"\s*[А-ЯЁ]"),  # a town; after a number it is a year, which may end a sentence
        (False, r"(?:^|[\s(«])[А-ЯЁ]\.$", r"\s*[А-ЯЁ]"),
        (False, r"\w\.$", r"\w"),
        (False, r"", r"\s*[,;:%]"),
        (True, rf"[.!?…][{_CLOSE}]*$", rf"\s+[{_OPEN}–—-]*\s*(?:[А-ЯЁA-Z0-9]|$)|\s*$"),
    ],
    "ar": [(False, r"(?:^|[\s(«])[ء-ي]{1,2}\.$", r"\s*\S"), *_UNCASED],
    "hi": [(False, r"(?:^|[\s(\"'])(?:डॉ|श्री|प्रो|कु|पं|सुश्री|[क-ह])\.$", r"\s*\S"), *_UNCASED],
    "ja": [
        (False, r"\d[．.]$", r"\d"),
        (False, r"…$", r"[^\s]"),
        (False, rf"[{_CLOSE}]$", r"\s*(?:と|って|という|など|の|を|は|が|に|、|，)"),
        (True, rf"[。！？!?｡][{_CLOSE}]*$", r""),
        (True, rf"[.．…][{_CLOSE}]*$", r"\s+\S|\s*$"),
    ],
    "zh": [
        (False, r"\d[．.]$", r"\d"),
        (False, r"…$", r"[^\s]"),
        (False, rf"[”’」』）)»\"]$", r"\s*[^\s“‘「『（(«\"]"),  # a quotation carried on
        (True, rf"[。！？!?｡][{_CLOSE}]*$", r""),
        (True, rf"[.．…][{_CLOSE}]*$", r"\s+\S|\s*$"),
    ],
    "th": [
        (False, r"[\d๐-๙]$", r"\s"),
        (False, r"$", r"\s+[\d๐-๙]"),
        (False, r"(?:^|\s)\S{1,3}\.$", r"\s*\S"),
        (True, r"[฀-๿][!?]*$", r"\s+[฀-๿]"),
        (True, rf"[.!?…][{_CLOSE}]*$", r"\s+\S|\s*$"),
    ],
}
_COMPILED = {k: [(b, re.compile(x), re.compile(y)) for b, x, y in v] for k, v in TABLES.items()}

LONGEST = 48  # characters before a mark that a rule may look at: longer than any abbreviation; what follows is seen whole

_UNIT = re.compile(r">>+|[\n\r\u2028\u2029\u0085\v\f]+")
_PLACES = re.compile(rf"[.!?…。！？｡．।॥؟۔]+[{_CLOSE}]*")
_THAI_PLACES = re.compile(rf"[.!?…]+[{_CLOSE}]*|(?<=\S)(?=\s)")
_PAIRS = {"“": "”", "‘": "’", "„": "“”", "«": "»", "‹": "›", "(": ")", "[": "]", "「": "」", "『": "』", "（": "）", "【": "】", "《": "》", "〈": "〉"}
_SIGNS = re.compile(r"[\"“”„«»‹›()\[\]「」『』（）【】《》〈〉]")
_WORD = re.compile(r"[^\W\d_]+")
_SCRIPTS = (
    ("th", re.compile("[฀-๿]")), ("ja", re.compile("[぀-ヿ]")), ("zh", re.compile("[㐀-鿿]")),
    ("hi", re.compile("[ऀ-෿]")), ("ar", re.compile("[֐-ࣿ]")), ("ru", re.compile("[Ѐ-ӿ]")),
)
_HINT_SETS = {k: frozenset(v.split()) for k, v in _HINTS.items()}


def language_of(unit: str) -> str:
    """The rule table for a stretch of text: its main script, and for Latin letters the commonest small words."""
    letters = _WORD.findall(unit)
    total = sum(map(len, letters))
    for lang, pattern in _SCRIPTS:
        n = len(pattern.findall(unit))
        if n and (n * 3 >= total or lang == "ja" and n * 8 >= total):
            return lang
    score = {k: sum(w.lower() in s for w in letters) for k, s in _HINT_SETS.items()}
    best = max(score, key=score.get)
    return best if score[best] else "xx"


def enclosed(unit: str) -> list[tuple[int, int]]:
    """Closed quotations and brackets, outermost, as ``(start, end)``. Signs without a partner enclose nothing."""
    stack, spans = [], []
    for m in _SIGNS.finditer(unit):
        c, i = m[0], m.start()
        if c == '"':
            if stack and any(s[0] == '"' for s in stack):
                while stack[-1][0] != '"':
                    stack.pop()
                spans.append((stack.pop()[1], i + 1))
            elif i + 1 < len(unit) and not unit[i + 1].isspace():
                stack.append((c, i))
            continue
        hit = next((k for k in range(len(stack) - 1, -1, -1) if c in _PAIRS.get(stack[k][0], "")), None)
        if hit is not None:
            start = stack[hit][1]
            del stack[hit:]
            spans.append((start, i + 1))
        elif c in _PAIRS:
            stack.append((c, i))
    spans.sort()
    out: list[tuple[int, int]] = []
    for s, e in spans:
        if not out or s >= out[-1][1]:
            out.append((s, e))
    return out


def _breaks(unit: str) -> list[int]:
    lang = language_of(unit)
    rules = _COMPILED[lang]
    inside = enclosed(unit)
    k, cuts = 0, []
    for m in (_THAI_PLACES if lang == "th" else _PLACES).finditer(unit):
        at = m.end()
        while k < len(inside) and inside[k][1] < at:
            k += 1
        if k < len(inside) and inside[k][0] < at < inside[k][1]:
            # A closing sign may have been taken in with the mark inside the quotation.
            continue
        first = max(0, m.start() - LONGEST)
        for brk, left, right in rules:
            if left.search(unit, first, at) and right.match(unit, at):
                if brk:
                    cuts.append(at)
                break
    return cuts


def sentences(text: str | None) -> list[tuple[int, int]]:
    """``(start, length)`` in code points of each sentence; null, empty and blank texts have none."""
    out: list[tuple[int, int]] = []
    if not text:
        return out

    def add(a: int, b: int) -> None:
        while a < b and (text[a].isspace() or text[a] in "\u200b\ufeff"):
            a += 1
        while b > a and (text[b - 1].isspace() or text[b - 1] in "\u200b\ufeff"):
            b -= 1
        if b > a:
            out.append((a, b - a))

    at = 0
    for m in [*_UNIT.finditer(text), None]:
        end = m.start() if m else len(text)
        if end > at:
            unit, last = text[at:end], 0
            for c in _breaks(unit):
                add(at + last, at + c)
                last = c
            add(at + last, end)
        at = m.end() if m else end
    return out


def split_sentences(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row per sentence: ``row_key, start_pos, n_chars, sentence``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, s, n, t[s : s + n]) for k, t in zip(b["k"], b["t"]) for s, n in sentences(t)]
            yield pd.DataFrame(rows, columns=["row_key", "start_pos", "n_chars", "sentence"])

    return df.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInPandas(run, "row_key string, start_pos bigint, n_chars bigint, sentence string")
