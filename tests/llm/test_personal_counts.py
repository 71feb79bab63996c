"""Problem 3: the lexicon of names is counted over the whole corpus, however it is split."""

import pytest

from skriftverk.llm import personal


@pytest.fixture(scope="module")
def given(spark):
    return spark.createDataFrame([("Ylva",), ("Kaj",)], "name string")


def learned(spark, given, texts, parts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartitionByRange(parts, "doc_id")
    names = personal.learn_names(docs, given)
    return names.given, names.surnames


def test_lexicon_of_any_split(spark, given):
    names = [f"Kontakt: {g} Ljungtjäder" for g in ("Ylva", "Kaj", "Birk", "Birk", "Kommunen", "Kommunen")]
    other = ["Nu svarar Kommunen igen."] * 30
    want = {"ylva", "kaj", "birk"}, {"ljungtjäder"}
    for parts in (1, 3, 36):
        assert learned(spark, given, names + other, parts) == want


def test_surname_in_proportion(spark, given):
    names = ["Kontakt: Ylva Ljungtjäder", "Kontakt: Kaj Ljungtjäder", "Kontakt: Ylva Kommunen", "Kontakt: Kaj Kommunen"]
    other = ["Nu svarar Kommunen igen."] * 30 + ["Sedan kom Dr. Ljungtjäder och A. Ljungtjäder hit."] * 30
    for parts in (1, 8):
        assert learned(spark, given, names + other, parts)[1] == {"ljungtjäder"}
