"""No lengths, widths or switches at which the operators of problems 1, 2, 3 and 10 do less."""

import textwrap

import pytest

from skriftverk.llm import boilerplate, encoding, personal, sentences


def test_long_words_are_restored(spark):
    word = "räksmörgåsfabriksförening" * 12
    bad = word.encode().decode("cp1252")
    df = spark.createDataFrame([(1, f"Här står {word} i rad."), (2, f"Här står {bad} i rad."), (3, "å" * 100_000)], "doc_id long, text string")
    got = {r["doc_id"]: r["restored"] for r in encoding.restored(df).collect()}
    assert got == {2: f"Här står {word} i rad."}


@pytest.mark.parametrize("hidden", [0, 11, 13, 40, 300])
def test_alignment_beyond_hidden_blocks(hidden):
    lines = [f"Rad {i} av den synliga texten med några ord till." for i in range(40)]
    page = "".join(f"<div>Dold rad {i}</div>" for i in range(hidden)) + "<main>" + "".join(f"<p>{x}</p>" for x in lines) + "</main>"
    blocks = boilerplate.leaf_blocks(page)
    assert boilerplate.aligned(lines, blocks) == list(range(hidden, hidden + 40))
    gap = page.replace("<p>Rad 20 ", "".join(f"<i>x</i><div>Mer dolt {i}</div>" for i in range(hidden)) + "<p>Rad 20 ")
    assert all(k >= 0 for k in boilerplate.aligned(lines, boilerplate.leaf_blocks(gap)))


def test_title_after_long_head():
    head = "<style>" + "a{b:c}" * 6000 + "</style><title>En rubrik som är lång nog</title>"
    lines = ["Hem", "En rubrik som är lång nog", "Text"]
    assert boilerplate.headline_marks(lines, head, None) == {1}


def test_end_tags_far_up():
    page = "<main class=yttre>" + "<div>" * 40 + "djupt" + "</main><p>efter</p>"
    assert boilerplate.leaf_blocks(page)[-1][2] == ""


def test_accounts_of_any_country():
    n = personal.Names({"anna"}, {"ek"})
    for iban in ("DK50 0040 0440 1162 43", "FR14 2004 1010 0505 0001 3M02 606", "SE45 5000 0000 0583 9825 7466"):
        assert personal.spans(f"Insättning till IBAN {iban} senast fredag.", n) == []
    assert personal.spans("Ring 070-123 45 67 eller Anna Ek.", n) == [(5, 18, "phone"), (25, 32, "name")]
    far = "ring" + " " * 60 + "på " + " " * 50 + "0701234567"
    assert personal._near(far, far.index("0")) == ["ring", "på"]
    assert personal.spans("Bo på Storgatan 5" + " " * 70 + ", 123 45 Kvarnby.", n)[0][2] == "address"


def test_short_surnames_are_learned(spark):
    texts = [f"{g} {s} kom hem. Sedan gick {g} {s} ut." for g in ("Anna", "Erik", "Karin") for s in ("Ek", "Alm", "Dal")]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    given = spark.createDataFrame([("anna", 1), ("Erik", 1), ("KARIN", 1)], "name string, n_listed int")
    names = personal.learn_names(df, given)
    assert {"ek", "alm", "dal"} <= names.surnames


@pytest.mark.parametrize("width", [30, 60, 89, 90, 91, 96, 120, 160, 1000])
def test_units_do_not_depend_on_the_width(width):
    t = "Den gamla kvarnen vid ån har stått stilla i många år, men nu ska den byggas om till museum för hela bygden. " * 3
    t += "Pengarna kommer från kommunen och från en lång rad företag i trakten. Målet är att öppna redan till sommaren, säger ordföranden. Snart börjar taket läggas om."
    wrapped = "\n".join(textwrap.wrap(t, width))
    assert len(sentences.unit_starts([wrapped])[0]) == 6
    assert len(sentences.unit_starts([wrapped + "\n\n" + "x" * 125 + " y."])[0]) == 7
