"""Problem 1: garbled texts that are more frequent than their clean words."""

from skriftverk.llm import encoding


def test_garbled_more_frequent_than_clean(spark):
    clean = ["Varför sålde fågelbåten många kvällar på övervåningen?", "Γιατί η βιβλιοθήκη πούλησε", "Новая комиссия осторожно измерила ящики"]
    bad = [clean[0].encode().decode("cp1252"), clean[1].encode("cp1253").decode("latin_1"), clean[2].encode().decode("cp1251", "ignore"), clean[0].translate(encoding.SEVEN_BIT)]
    rows = list(enumerate(clean)) + [(100 * k + 100 + i, f"{t} {i}" if i % 2 else t) for k, t in enumerate(bad) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r[0] for r in encoding.garbled_ids(df).collect()} == {i for i, _ in rows if i >= 100}
    out = {r["doc_id"]: r["restored"] for r in encoding.restored(df).collect()}
    assert out[100] == clean[0] and out[200] == clean[1] and out[400] == clean[0]


def test_words_of_another_spelling_stay(spark):
    """A word that is one itself is no garbled form of a rarer one, and copies of the rarer one's text do not count."""
    texts = ["Eles são assim.", "Elas são boas.", "Os dois são altos."] + ["Un săo vechi."] * 10
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert ("são", "cp1250>cp1252") in set(encoding.garbled_forms("săo"))
    assert encoding.garbled_ids(df).filter("doc_id < 3").count() == 0
