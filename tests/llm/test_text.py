"""Sentences, turns and residue: rules on hand-written texts and edge cases."""

import pytest

from turnloom.llm.residue import residue
from turnloom.llm.sentences import language_of, sentences, split_sentences
from turnloom.llm.turns import clean_dialogues, parse_turns, speaker_name, transcript_turns


def cut(t):
    return [t[s : s + n] for s, n in sentences(t)]


@pytest.mark.parametrize(
    "want",
    [
        ["Dr. Ann Lee paid 3.5 million, i.e. not much.", "She left at 7 p.m. Friday with J. B. Roe.", "It shut at 2 p.m.", "See No. 4, vol. 2."],
        ['"We will not go. We cannot," said Ann.', '"It was only a mill."', "Really?!", "I thought ... well, no."],
        ["The river (lost in the flood. Found again) still runs.", "Seats for “Old! The Mill?” sold out.", "And then …"],
        ["Die Mühle kostet z. B. 6,1 Mio. Euro, d. h. mehr.", "Am 22. Juni war es offen.", "„Das geht nicht. Nie“, sagte Frau Dr. Roe."],
        ["« On verra. Rien ne presse », répond la mairie.", "Faut-il fermer la digue de Roe ?", "M. Roe reste, selon l'art. 20."],
        ["उत्तर का पुल 1960 से बंद है।", "डॉ. वरुण ने 5.8 लाख दिए।", '"हम नहीं जाएँगे। यह पुल हमारा है," एक महिला ने कहा।'],
        ["قال د. سالم: «لن نغادر. هذا قرارنا» أمام الجسر.", "متى يفتح السوق؟"],
        ["El Sr. Gómez y la Dra. Ruiz llegaron.", "Viven en la Avda. Mayor, núm. 4.", "¿Quién lo dijo?"],
        ["Il Sig. Rossi e la Dott.ssa Verdi sono qui.", "Non è del Prof. Neri."],
        ["O Sr. Silva e a Dra. Costa não vieram.", "Foi para a Av. Central com uma pasta."],
        ["Dhr. Jansen en mevr. De Wit zijn niet bij Prof. Bakker.", "Dat is ook zo."],
        ["Он живёт в г. Москва на ул. Ленина.", "Это было в 1999 г.", "Потом приехал А. С. Пушкин.", "Вот и всё!"],
        ["Mr." + " " * 60 + "Lee paid.", "He left the house."],
        ["ค่าใช้จ่ายเพิ่มขึ้น 4.3 เท่าในปีนี้", "สะพานเก่าเปิดเมื่อปี 2535 และปิดไปนานแล้ว"],
    ],
)
def test_sentences_joined_by_spaces_come_apart(want):
    assert cut(" ".join(want)) == want


@pytest.mark.parametrize("want", [["他说：“车站不能关。我们不走！”然后离开了。", "大家都在等……等着消息。", "增长了8.1%，多。"], ["「港は閉めません。もう決めました。」と係員は答えた。", "費用は4．8倍になった。", "なんと大きな駅だ！"]])
def test_sentences_of_scripts_without_spaces(want):
    assert cut("".join(want)) == want


def test_breaks_and_marks():
    assert cut("one two\nthree >> Four. five>>六。七。") == ["one two", "three", "Four. five", "六。", "七。"]
    for t in (None, "", " \n ", ">> >>"):
        assert sentences(t) == []
    assert language_of("Die alte Mühle ist leer") == "de"


def test_long_texts_and_exact_offsets(spark):
    t = "One two. " * 30_000
    assert len(sentences(t)) == 30_000
    assert len(sentences('"' * 5000 + "(" * 5000)) >= 1
    df = spark.createDataFrame([("a", "𝒳 yes. No way."), ("b", None), ("a", "")], "k string, t string")
    assert {(r.row_key, r.start_pos, r.n_chars) for r in split_sentences(df, "k", "t").collect()} == {("a", 0, 6), ("a", 7, 7)}


def test_turns():
    t = (
        "we begin [00:01] >> ANN LEE: um, the mill [applause] is, you know, shut tonight LEE: at 10:15 the Rail Board (NRB) says\n"
        "Bob Roe (GUEST): (coughs) here is the thing: er, no. <v Ann Lee> ♪ la la ♪ yes >> and more"
    )
    got, removed = parse_turns(t)
    assert removed
    assert [(s, n) for s, _, n in got] == [("unknown", 2), ("ann lee", 12), ("bob roe", 5), ("ann lee", 1), ("unknown", 2)]
    assert got[1][1].startswith("the mill is, shut tonight")


def test_turn_edges(spark):
    assert parse_turns(None) == ([], False) and parse_turns(" \n") == ([], False)
    assert parse_turns("plain words only")[1] is False
    assert parse_turns("her era is over, it is a sort of tax") == ([("unknown", "her era is over, it is a sort of tax", 10)], False)
    assert parse_turns("[[[[" * 3000)[0] == []
    assert parse_turns("(a (b) c) word")[0] == [("unknown", "word", 1)]
    df = spark.createDataFrame([("g", "Ann Bee: (x)"), ("h", None)], "k string, t string")
    assert transcript_turns(df, "k", "t").count() == 0


def test_headings_are_parsed_by_the_grammar():
    said = lambda t: [(s, n) for s, _, n in parse_turns(t)[0]]
    assert said("ANN LEE: the mill LEE: is shut Lee (GUEST): at 10:15 today") == [("ann lee", 7)]
    assert said("Ann Lee: so we asked him\nTom O'Brien (the mayor): no way") == [("ann lee", 4), ("tom o'brien", 2)]
    assert said("Lee, Ann: one two E. Roe : three") == [("ann lee", 2), ("e roe", 1)]
    assert said("word: " * 2000 + "end")[-1][1] >= 1 and said("a-" * 20_000 + "b: c") and said("Ann Lee:" + " " * 5000 + "hi") == [("ann lee", 1)]
    deep = "(" * 70 + "x" + ")" * 70 + " word"
    assert said(deep)[-1][0] == "unknown"


def test_speaker_names():
    want = {" Ann  Lee ": "ann lee", "Clip - Ann Lee": "ann lee", "Host / Ann Lee": "ann lee", "Ann Lee (Guest)": "ann lee", "Bob Robson.": "bob robson", "Bob Robson:": "bob robson", "Water Bd Tr.": "water bd tr.", "Robson, B.": "robson, b.", None: "unknown", " ": "unknown"}
    assert {k: speaker_name(k) for k in want} == want


def test_dialogues_count_once(spark):
    rows = [("1", "um, yes", "A B", 1), ("1", "um, yes", "A B", 2), ("2", "nothing here", "C", 1), ("3", "[noise]", "C", 1), ("4", None, None, 1)]
    df = spark.createDataFrame(rows, "k string, t string, s string, v int")
    assert [(r.row_key, r.speaker, r.n_words) for r in clean_dialogues(df, "k", "t", "s", "v").collect()] == [("1", "a b", 1)]


REAL = "The mill of Roe was built in 1900 and is the oldest of the county, with a wheel that turns to this day for the people who visit it in summer."


def test_residue(spark):
    texts = {
        1: ("'''Roe''' is a mill near [INSERT TITLE].", True), 2: (REAL + " Its length is {title} km.", True), 3: (REAL + " See <nowiki>{{{name}}}</nowiki> and <code>%NAME%</code>.", False),
        4: ("Home · Help\nError 404: page not found\nRoe mill", True), 5: (REAL + '\nOnce it showed "error 503" to all.', False), 6: ("Please enable JavaScript to read this page.", True),
        7: ("== History ==\nVelor dulis amet. Ornatis ferra novum.", True), 8: ("Write something about the subject.", True), 9: ("#REDIRECT [[Error 404]]", False), 10: ("", False), 11: (None, False),
        12: ("bob woz ere bob woz ere", False), 13: ("{{Infobox\n| name = Roe\n| population =\n}}\n" + REAL, False), 14: (REAL + " It is in {{{year|}}}.", True),
    }
    rows = [(i, t, "h", 100 + i, "Roe mill") for i, (t, _) in texts.items()] + [(200 + i, f"Home · Help\n{REAL} {i}", "h", 300 + i, "x") for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, page_id long, page_title string")
    assert {r.doc_id for r in residue(df).collect()} == {i for i, (_, bad) in texts.items() if bad}
    assert residue(df.limit(0)).count() == 0


def test_marked_titles_are_no_content(spark):
    texts = {1: ("'''Steithwaite'''\nText goes here.\n== Heading ==", True), 2: ("[[Steithwaite]]\nText goes here.", True), 3: ("''[[Steith|Steithwaite]]''\nText goes here.", True), 4: ("'''Steithwaite''' is a town.\nText goes here.", False)}
    df = spark.createDataFrame([(i, t, "web", i, "Steithwaite") for i, (t, _) in texts.items()], "doc_id long, text string, source string, page_id long, page_title string")
    assert {r.doc_id for r in residue(df).collect()} == {i for i, (_, bad) in texts.items() if bad}


def test_long_lines_are_judged(spark):
    lorem = "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore et dolore magna aliqua. Ut enim ad minim veniam, quis nostrud exercitation ullamco laboris nisi ut aliquip ex ea commodo consequat. Duis aute irure dolor in reprehenderit in voluptate velit esse cillum dolore eu fugiat nulla pariatur. Excepteur sint occaecat cupidatat non proident, sunt in culpa qui officia deserunt mollit anim id est laborum."
    error = "Something went wrong while we were loading the page that you asked for at this address. The service is down for maintenance and could not be reached in the time that we allow for it, which happens now and then. The request has been denied for now, so please go back to where you came from and try again later."
    scripts = "To read this page in full you need to enable JavaScript in the settings of the browser that you are using now. As long as scripts are switched off or JavaScript is not activated, nothing of what this page holds can be shown to you at all. Enable scripts and load it again, please."
    notice = "All of the text of this site is free to be read, copied and changed by anyone, in part or as a whole, as long as the source is named and the same is allowed to others. The names of the sites that belong to us are marks of ours and may be used with leave in writing only, as the terms say."
    long_real = "The mill was built in 1901 for the wool of the valley and it stood for ninety years beside the river. " * 4 + "A survey says that the plans were not found."
    texts = {1: (lorem, True), 2: (error, True), 3: (scripts, True), 4: (f"{notice}\nError 404: page not found", True), 5: (long_real, False), 6: (f"{error}\n{long_real}", False), 7: (notice, False)}
    rows = [(i, t, "web", i, "x") for i, (t, _) in texts.items()] + [(20 + i, f"{notice}\n{REAL} {i}", "web", 20 + i, "x") for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, page_id long, page_title string")
    assert {r.doc_id for r in residue(df).collect()} == {i for i, (_, bad) in texts.items() if bad}


def test_annotations_of_any_length():
    words = "and the river runs down to the sea " * 20
    for a, b in (("♪ ", " ♪"), ("[", "]"), ("(", ")"), ("{", "}"), ("*", "*"), ("<i ", ">"), ("[", "\nand on]"), ("♪ ", "\nla ♪")):
        assert parse_turns(f"Ann Robson: Good day. {a}{words}{b} Thank you.")[0] == [("ann robson", "Good day. Thank you.", 4)]
    never = f"Ann Robson: Good (day.\nTom Lee: {words}\nAnn Robson: Thank) you."
    assert [t[0] for t in parse_turns(never)[0]] == ["ann robson", "tom lee", "ann robson"]


def test_furniture_is_a_share_of_the_pages(spark):
    for pages, out in ((100, {1}), (900, set())):
        rows = [(1, "Error 404: page not found\n* [[Theiarmoor]]", "web", 1, "x")] + [(i, f"* [[Theiarmoor]]\n{REAL}" if i < 4 else f"{REAL} {i}", "web", i, "x") for i in range(2, pages)]
        df = spark.createDataFrame(rows, "doc_id long, text string, source string, page_id long, page_title string")
        assert {r.doc_id for r in residue(df).collect()} == out
