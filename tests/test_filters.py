import pytest
from pyspark.sql import functions as F

from skriftverk.functions.text import is_upper, lines, safe_name, strip, tokens
from skriftverk.operators.classify import discussion_score, document_class
from skriftverk.operators.filters import id_contains, is_html_page, long_enough, quality_measures, quality_reason, valid_utf8
from skriftverk.operators.language import best_language, language_filter, language_scores


def one(spark, value, col, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(col.alias("y")).first()[0]


@pytest.mark.parametrize("text", ["", " ", "a\r\nb c\n", "\xa0x\x1c", "å\x85b\x0bc", "a😀b\n\nc", "\n"])
def test_strings_as_python(spark, text):
    assert one(spark, text, lines(F.col("x"))) == text.splitlines()
    assert one(spark, text, tokens(F.col("x"))) == text.split()
    assert one(spark, text, strip(F.col("x"))) == text.strip()


@pytest.mark.parametrize("text", ["ABC", "ABc", "1", "", "ÅÄÖ 1", "å"])
def test_is_upper(spark, text):
    assert one(spark, text, is_upper(F.col("x"))) == text.isupper()


def test_safe_name(spark):
    assert one(spark, "Våt & 1-2", safe_name(F.col("x"))) == "Våt___1_2"


def test_valid_utf8(spark):
    assert one(spark, bytearray(b"a\xffb"), valid_utf8(F.col("x")), "binary") == "a�b"


@pytest.mark.parametrize(
    "url,page,keep",
    [("https://x/a.PDF", "<html>", False), ("https://x/a.pdf?x=1", "<DIV>", True), (None, "<body>", True), ("https://x", "text", False), ("https://x", None, False)],
)
def test_only_html(spark, url, page, keep):
    df = spark.createDataFrame([(url, page)], "u string, p string")
    assert df.filter(is_html_page(F.col("u"), F.col("p"))).count() == int(keep)


def reason(spark, text, cls="article"):
    return quality_measures(spark.createDataFrame([(text, cls)], "text string, document_class string")).select(quality_reason().alias("r")).first()[0]


def test_quality_rules(spark):
    good = "det är en bra dag för oss och vi går i skogen med våra hundar som alla tycker om att springa runt"
    assert reason(spark, good) is None
    assert reason(spark, None) == "no lines" == reason(spark, "")
    assert reason(spark, " ".join(good.split()[:19])) == "fewer than 20 words"
    assert reason(spark, "sten " * 20) == "few stop words (0)"
    assert reason(spark, "och " * 3 + "sten " * 17) is None  # exactly 0.15
    assert reason(spark, "och sten " * 10 + "д" * 6) == "foreign script"
    assert reason(spark, "och sten! " * 12 + "!!!!!!") == "special characters"
    assert reason(spark, "och sten i en bygd " * 6 + "&" * 5) == "menu symbols"
    assert reason(spark, good + "\na\nb") == "short lines"
    assert reason(spark, "x", "discussion") is None
    assert reason(spark, "x", None) == "fewer than 20 words"


@pytest.mark.parametrize("n,cls,keep", [(150, "article", False), (151, None, True), (71, "discussion", True), (70, "discussion", False)])
def test_length_gate(spark, n, cls, keep):
    df = spark.createDataFrame([("x" * n, cls)], "t string, c string")
    assert df.filter(long_enough(F.col("t"), F.col("c"))).count() == int(keep)


def test_ids(spark):
    df = spark.createDataFrame([("urn:uuid:AB-1",), (None,)], "id string")
    assert df.filter(id_contains(F.col("id"), "ab")).count() == 0
    assert df.filter(id_contains(F.col("id"), "URN:uuid:ab", normalize=True)).count() == 1


def test_classes(spark):
    rows = [
        ("https://x/nyheter/forum", "", ""), ("https://x/NYHETER/1", "", ""), (None, "a skrev: b citat:", ""), ("", "ord " * 151 + "." * 6, ""), ("", "kort", None), ("", " citat:", "<div class=postbody>"),
    ]
    df = spark.createDataFrame(rows, "u string, t string, h string")
    got = [r[0] for r in df.select(document_class(F.col("u"), F.col("t"), F.col("h"))).collect()]
    assert got == ["discussion", "article", "discussion", "article", "unknown", "discussion"]
    assert df.select(discussion_score(F.col("t"), F.col("h"))).collect()[5][0] == 4


def test_language(spark):
    df = spark.createDataFrame([("det är en sten och vi har den med oss",), ("the house is on the hill and it was old",), ("",), (None,)], "text string")
    got = [r[0] for r in language_scores(df).select(best_language()).collect()]
    assert got[:2] == ["sv", "en"] and got[2] is None and got[3] is None
    assert language_filter(df).count() == 1
