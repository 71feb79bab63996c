"""Problems 1, 2, 3, 6, 7, 8 and 10 on small fixtures: brute force, round trips, held-out accuracy and edge cases."""

import random

import numpy as np
import pytest

from skriftverk.llm import boilerplate, encoding, personal, quality, repetition, sentences, tokens
from skriftverk.llm.common import words

ODD = [(1, None), (2, ""), (3, " \n​"), (4, "ord"), (5, "å" * 200_000), (6, "a b c d e " * 30_000), (7, "😀 \x00 �"), (7, "😀 \x00 �")]
SCHEMA = "doc_id long, text string, document_class string, i int, t string, words string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, None, 1, "x", "y") for i, t in ODD], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


# --- 8 -----------------------------------------------------------------------------------------------------------------
def test_tokens_as_the_library():
    import tiktoken

    e = tokens.encoder(tokens.DEFAULT_VOCABULARY)
    ref = tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=e.ranks, special_tokens={})
    rng = random.Random(3)
    pieces = ["hej", " världen", "  ", "\n\n", "!'s", "'ll", "12345", " 99", "日本語", "\xa0", "<|endoftext|>", "…", "ǻ", "😀", "\t", "ab" * 400, "_"]
    for _ in range(300):
        t = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 30)))
        assert e.encode(t) == ref.encode_ordinary(t)
        assert e.decode(e.encode(t)) == t
    assert any(len(e.fragments(x.encode())) > 1 for x in ("!?)(§§", "日本語日本語"))


def test_tokens_edges(odd, none):
    got = tokens.encode_corpus(odd).collect()
    assert len(got) == len(ODD) and [r["ids"] for r in sorted(got, key=lambda r: r["doc_id"])[:2]] == [[], []]
    assert tokens.encode_corpus(none).count() == 0


# --- 6 -----------------------------------------------------------------------------------------------------------------
def brute_repeated(t, k=5):
    w, seen, cov = words(t), set(), set()
    for i in range(len(w) - k + 1):
        g = tuple(w[i : i + k])
        if g in seen:
            cov.update(range(i, i + k))
        seen.add(g)
    return len(cov)


def test_repetition_brute_force(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 60))) for _ in range(300)] + ["a " * 77]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in repetition.repetition_stats(df).collect():
        assert r["repeated_words"] == brute_repeated(texts[r["doc_id"]])
    assert {r["doc_id"]: r["longest_repeat"] for r in repetition.repetition_stats(df).collect()}[300] == 76


def test_repetition_edges(odd, none):
    got = {r["doc_id"]: r for r in repetition.repetition_stats(odd).collect()}
    assert got[1]["share"] == 0 == got[3]["words"] and got[6]["repeated_words"] == 149_995
    assert [r[0] for r in repetition.repetitive(odd).collect()] == [6]
    assert repetition.repetitive(none).count() == 0


# --- 10 ----------------------------------------------------------------------------------------------------------------
CASES = [
    ["Enl. § 2 st. 1 gäller det fr.o.m. den 5 maj. ", "Det kostar ca 5,1 milj. kr per år."],
    ["Hon flyttade till nr 74. ", "Version 5.8.8 väger 52.710 g, d.v.s. mer."],
    ["”Kom hit!” ropade hon. ", "”Vi går.” ", "Sen gick de."],
    ["Han köpte (till slut!) en båt. ", "(Detta gäller inte alla.) ", "Ny mening."],
    ["Om hamnen\n\n", "Vad?! ", "Sidan a.example/lin.html visar den.\n", "– Vi går, sade hon."],
    ["Das 16. Jahrhundert war ruhig. ", "Am 14. März kam z. B. der Chor."],
    ["Dr. Oatfennel paid approx. 4.96 coins, i.e. too much. ", "It starts at 9 p.m. on the floor. ", "He paused ... and left. ", "It was lost... ", "We left."],
    ["「北の橋はどこ？」と聞いた。", "港は『測った。』と書いた。"],
    ["“北桥在哪里？”他问道。", "他说：“我们忘记了。”", "早春时，关闭了！"],
    ["क्या वह मापती है? ", "डॉ. की सलाह पर देखे।"],
    ["هل باعت؟ ", "طوله 7.352 متر كما قال د. من المجلس."],
    ["โรงสีเก่าลืมแผนที่ 129 ชิ้น ", "คณะกรรมการพบนาฬิกา"],
    ["Γιατί έβαψε; ", "Η χορωδία ήρθε."],
    ["det kostar mer. ", "enligt planen gick vi. ", "ta lampor, hjul m.m. till huset, båtar osv. ", "det märks."],
]


@pytest.mark.parametrize("units", CASES)
def test_sentences(units):
    t = "".join(units)
    at = [sum(map(len, units[:i])) for i in range(len(units))]
    assert sentences.unit_starts([t])[0] == at


def test_wrapped_lines():
    t = "Enligt den nya planen i Ulvås lånade grannen flera gamla båtar från\nGåsvik utanför byn. Den s.k.\nregeln gäller fortfarande i hela bygden sedan i våras, säger alla."
    assert sentences.unit_starts([t])[0] == [0, t.index("Den s.k.")]


def test_chunks_do_not_matter():
    texts = ["".join(u) for u in CASES] * 7
    assert all(sentences.unit_starts(texts, c) == sentences.unit_starts(texts, 256) for c in (1, 2, 13, 5000))


def test_sentences_edges(odd, none):
    got = sentences.sentence_units(odd).collect()
    assert {r["doc_id"] for r in got} == {4, 5, 6, 7} and sentences.sentence_units(none).count() == 0


# --- 3 -----------------------------------------------------------------------------------------------------------------
NAMES = personal.Names({"ylva", "kaj", "birk"}, {"ljungtjäder", "barkstråke", "barktjäder", "ljungstråke"})


def found(t):
    return [(k, t[a:b]) for a, b, k in personal.spans(t, NAMES)]


def test_personal_spans():
    assert found("Kontakt: Ylva Ljungtjäder, 070-174 06 17, ylva_l (at) post.ronnbyn.example") == [("name", "Ylva Ljungtjäder"), ("phone", "070-174 06 17"), ("email", "ylva_l (at) post.ronnbyn.example")]
    assert found("Undertecknad Barkstråke, Kaj, 811025-9879, bosatt Ljungbygränd 88, 3 tr") == [("name", "Barkstråke, Kaj"), ("id_number", "811025-9879"), ("address", "Ljungbygränd 88")]
    assert found("K. Barkstråke bor på Övre Säldal 249, 805 48 Ärtskär.") == [("name", "K. Barkstråke"), ("address", "Övre Säldal 249, 805 48 Ärtskär")]
    assert found("enligt ylva ljungtjäder") == [("name", "ylva ljungtjäder")]
    assert found("Wir wohnen in der Weberstr. 71a. Pick it up at 55 Thimble Yard.") == [("address", "Weberstr. 71a"), ("address", "55 Thimble Yard")]


def test_personal_negatives():
    for t in ("Org.nr 594961-8708 står här.", "Ärende 811025-9879 avslutades.", "Väg 58 stängs, kör riksväg 21.", "Hr. Barkstråke kom.", "Ylva och Kaj kom.", "Spinnarväg är lång.",
              "Följ @posten eller köp 3 st @ 70 kr.", "Bolaget Kvarnås och Barkstråke & Söner AB", "ISBN 978-91-7028-803-X", "2018-02-01 17:37:18,507", "Pnr 811025-9878", "lagerplats 53"):
        assert found(t) == [], t


def test_checks():
    assert personal.luhn("8110259879") and personal.swedish_id("198110259879") and not personal.swedish_id("8113259879")
    assert personal.swedish_id("8110859878"[:-1] + next(c for c in "0123456789" if personal.luhn("811085987" + c)))
    assert personal.finnish_id("131052308", "T") and not personal.finnish_id("131052308", "U")
    assert personal.mod97("GB82 WEST 1234 5698 7654 32")


def test_personal_edges(spark, odd, none):
    given = spark.createDataFrame([("Ylva",), (None,), (" KAJ ",)], "name string")
    rows = [(i, f"Kontakt: {g} {s}", None, 1, "x", "y") for i, (g, s) in enumerate([("Ylva", "Ljungtjäder"), ("Kaj", "Ljungtjäder"), ("Birk", "Ljungtjäder"), ("Birk", "Ljungtjäder")])]
    docs = spark.createDataFrame(rows, SCHEMA).union(odd)
    names = personal.learn_names(docs, given)
    assert names.given == {"ylva", "kaj", "birk"} and names.surnames == {"ljungtjäder"}
    got = personal.find_personal(docs, names).collect()
    assert len(got) == 4 and all(r["kind"] == "name" and r["start_pos"] == 9 for r in got)
    m = {r["doc_id"]: r["masked"] for r in personal.masked(docs.filter("doc_id < 1 or doc_id = 2"), names).collect()}
    assert m[0] == "Kontakt: [NAME]"
    assert personal.find_personal(none, personal.learn_names(none, given)).count() == 0


# --- 1 -----------------------------------------------------------------------------------------------------------------
def test_garbled_round_trip(spark):
    clean = ["Varför sålde fågelbåten många kvällar på övervåningen i Älvås?", "Färjeklubben målade båtar från Åkerby.", "Γιατί η βιβλιοθήκη πούλησε", "北の橋を見つけた。図書館が聞いた", "Vi gick hem."]
    bad = {
        10: clean[0].encode().decode("cp1252"), 11: clean[1].encode("cp1252").decode("mac_roman"), 12: clean[0].encode("cp850").decode("cp437").translate(encoding.SEVEN_BIT),
        13: clean[1].encode().decode("cp437"), 14: clean[2].encode("cp1253").decode("latin_1"), 15: clean[3].encode().decode("latin_1"), 16: "Han sade â€œhejâ€\x9d igen.",
    }
    quiet = {20: "Bokstaven å ser ut som ”Ã¥” ibland.", 21: "if (x[i] || {a: 1}) { return f|r; }", 22: "NÃO HÁ PÃO", 23: "Här är allt rätt", 24: "f&ouml;r m&aring;nga"}
    rows = [(i, t) for k, t in enumerate(clean) for i in (k, k + 100, k + 200)] + list(bad.items()) + list(quiet.items()) + [(30, "f�r alla"), (31, None), (32, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r[0] for r in encoding.garbled_ids(df).collect()} == {*bad, 30}
    out = {r["doc_id"]: r["restored"] for r in encoding.restored(df).collect()}
    assert [out[i] for i in (10, 11, 12, 13, 14, 15)] == [clean[i] for i in (0, 1, 0, 1, 2, 3)] and out[16] == "Han sade “hej” igen."


def test_garbled_edges(odd, none):
    assert encoding.garbled_ids(odd).count() == 0 and encoding.garbled_ids(none).count() == 0


# --- 7 -----------------------------------------------------------------------------------------------------------------
def test_types(spark, odd, none):
    rng = random.Random(2)
    subj, verb, obj = ["hon", "grannen", "den gamla föreningen", "en man"], ["köpte", "målade", "sålde inte"], ["en båt i hamnen", "det gamla huset", "några frusna lampor"]
    prose = [" ".join(f"{rng.choice(subj).capitalize()} {rng.choice(verb)} {rng.choice(obj)} när det var kväll, och det vet alla." for _ in range(6)) for _ in range(200)]
    lists = ["\n".join(f"{rng.randint(1, 9)} dl {rng.choice(['kustmattor', 'frusna torvskor', 'kvarnbrev'])}" for _ in range(12)) for _ in range(30)]
    tables = ["\n".join(f"Kvarnby;skor;{rng.randint(1, 999)};{rng.randint(1, 99)}.5;J" for _ in range(10)) for _ in range(30)]
    noise = [" ".join("".join(rng.choice("bcdfghjklmnpqrstvwxzåö") for _ in range(rng.randint(3, 9))) for _ in range(60)) for _ in range(30)]
    rows = [(i, t, "article" if i < 200 else "unknown") for i, t in enumerate(prose + lists + tables + noise)]
    df = spark.createDataFrame(rows, "doc_id long, text string, document_class string")
    assert {r[0] for r in quality.not_prose(df).collect()} == set(range(200, 290))
    assert quality.text_types(none).count() == 0 and quality.not_prose(none).count() == 0
    assert {r[0] for r in quality.text_types(odd).collect()} == {6}
    stats = {r["doc_id"]: r for r in quality.text_statistics(odd).collect()}
    assert stats[1]["words"] == 0 == stats[3]["words"]


# --- 2 -----------------------------------------------------------------------------------------------------------------
def page(rng, k):
    word = lambda: rng.choice(["kvarn", "båt", "hus", "gran", "torv"]) + rng.choice(["laget", "planen", "museet"])
    sent = lambda: f"Enligt {word()} köpte {word()} en gammal {word()} i byn, och det vet alla som bor där."
    top = [("div", "Hem | Nyheter | Sport"), ("div", f"Av redaktionen, {rng.randint(1, 28)}/3 2009")]
    body = [("h1", f"{word().capitalize()} fick en ny {word()} i våras")] + [("p", sent()) for _ in range(rng.randint(2, 5))]
    end = [("div", "Dela på sociala medier"), ("h3", "Mest läst"), *[("li", f'<a href="/{i}">{word().capitalize()}</a>') for i in range(4)], ("div", "© 2012 Bladet")]
    markup = "<html><head><title>x</title></head><body>" + "".join(f"<{t}>{x}</{t}>" for t, x in top + body + end) + "</body></html>"
    return markup, "\n".join(x for _, x in body), len(top), len(body)


def test_main_body_held_out(spark):
    rng = random.Random(5)
    gold = [(f"g{i}", "https://x/a", *page(rng, i)[:2]) for i in range(25)]
    g = spark.createDataFrame([*gold, ("n", None, None, None), ("e", "", "<p>x", "")], "id string, url string, html string, text string")
    model = boilerplate.fitted(g)
    assert np.array_equal(model.trans, boilerplate.fitted(g).trans)
    rows, want = [], set()
    for i in range(40):
        markup, _, top, body = page(rng, i)
        blocks = [b[0] for b in boilerplate.leaf_blocks(markup)]
        text = "\n".join(["", *blocks, " "])
        rows.append((i, text, [markup, None, markup[: len(markup) // 2]][i % 3], None))
        want |= {(i, 1 + j) for j in range(len(blocks)) if not top <= j < top + body}
    df = spark.createDataFrame(rows + [(90, None, "<p>x", None), (91, " \n ", None, None)], "page_id long, text string, html string, url string")
    got = {tuple(r) for r in boilerplate.boilerplate_lines(df, model).collect()}
    assert len(got ^ want) <= 0.03 * len(want)
    bodies = {r["page_id"]: r["body"] for r in boilerplate.main_bodies(df, model).collect()}
    assert bodies[90] is None and bodies[91] == "" and boilerplate.boilerplate_lines(df.limit(0), model).count() == 0


def test_chain_gradient_fits():
    m = boilerplate.Chain().fit([[[1], [2], [1]], [[1], [2], [2]]], [np.array([0, 1, 3]), np.array([0, 1, 1])], 80)
    assert [list(y) for y in m.viterbi([[[1], [2], [1]], [[2]]])][0] == [0, 1, 3]


# --- 7: other scripts --------------------------------------------------------------------------------------------------
def test_types_of_other_scripts(spark):
    rng = random.Random(4)
    some = {"ru": "комиссия библиотека мельница доски ящики мука", "zh": "图书馆 黑麦粉 旧地图 委员会 铜屋顶", "hi": "पुस्तकालय पुराना नक्शा लकड़ी घड़ी", "th": "แผนที่ กล่องไม้ นาฬิกา คณะกรรมการ", "ar": "المكتبة الخريطة الصندوق الساعة", "el": "μουσείο χάρτες κιβώτια φούρνος"}
    rows, want = [], {}

    def add(text, kind, cls="unknown"):
        want[len(rows)] = kind
        rows.append((len(rows), text, cls))

    for _ in range(100):
        add("Hon köpte en båt i hamnen när det var kväll, och det vet alla som bor där. " * 5, "prose", "article")
    for lang, ws in some.items():
        w = lambda ws=ws.split(): rng.choice(ws)
        gap, comma, stop = ("", "，", "。") if lang == "zh" else (" ", ", ", " " if lang == "th" else "। " if lang == "hi" else ". ")
        for cls in ("article", None):
            add("".join(gap.join(w() for _ in range(7)) + comma + gap.join(w() for _ in range(6)) + stop for _ in range(8)), "prose", cls)
        lines = "\n".join(w() for _ in range(14))
        cells = "\n".join(f"{w()};{w()};{rng.randint(1, 999)};{rng.randint(1, 99)}.5;1" for _ in range(10))
        add(lines, "list")
        add(cells, "table")
        add(lines.encode().decode("latin_1"), "list")
        add(cells.encode().decode("latin_1"), "table")
        add(("、" if lang == "zh" else ", ").join(w() for _ in range(60)), "list")
    add("\n".join(" ".join(str(rng.randint(1, 99999)) for _ in range(6)) for _ in range(10)), "table")
    df = spark.createDataFrame(rows, "doc_id long, text string, document_class string")
    got = {r["doc_id"]: r["type"] for r in quality.text_types(df).collect()}
    assert got == want
    assert quality.statistics("12 345 6 78 90")[quality._NAMES.index("other_script")] == 0
