import random

from pyspark.sql import functions as F

from skriftverk.operators import evaluate, html
from skriftverk.plans import pipeline

PAGE = """<html><head><meta property="og:title" content=" Titel "></head><body><div class="widget"><table><tr><td>bort</td></tr></table></div>
<div class="data-table"><table><tr><th>Ort</th><th>Antal</th></tr><tr><td>Kvarnby</td><td>12<table><tr><td>inre</td></tr></table></td></tr></table></div>
<table><tr><td>nav: hem</td></tr></table><figure><table><tr><td>Figur ett</td></tr></table></figure>
<div id="comments">kommentar</div><p>Brödtext <b>fet</b>.</body></html>"""


def test_preprocess():
    page, title, tables = html.preprocessed(PAGE)
    assert title == "Titel" and [t["id"] for t in tables] == [1, 2]
    assert "XYZ_TABLE_BLOCK_1_XYZ" in page and "data-table" not in page and "<figure" not in page and "kommentar" not in page and "nav: hem" in page
    assert tables[0]["markdown"].splitlines()[:2] == ["| Ort | Antal |", "|---|---|"]


def test_broken_markup():
    assert html.text_lines("<p>a<p>b</i><li>c<li>d<div class=menu>x") == ["a", "b", "c", "d"]
    assert html.text_lines("<script>x</script>&aring;<br>b<nav>n</nav>") == ["å", "b"]
    assert html.text_lines("<div" * 3000) is not None and html.text_lines("<b>" * 5000 + "x") == ["x"]


def test_unparsable(spark):
    rows = [("1", "https://x/nyheter/1", "<html><body><p>Text <![foo bar]> mer"), ("2", "https://x/nyheter/2", "<html><body><p>" + "ord i en lång rad " * 20)]
    df = spark.createDataFrame(rows, "id string, url string, html string")
    for dense in (False, True):
        out = {r["id"]: r["filter_reason"] for r in pipeline.run(df, [pipeline.classify(), pipeline.extract(dense=dense)]).collect()}
        assert out == {"1": "extractor: broken HTML: AssertionError", "2": None}
    assert {r["id"]: r["extracted"] is None for r in html.simple_text(df).collect()} == {"1": True, "2": False}


def test_running_text_is_the_native_one(spark):
    rng = random.Random(2)
    parts = ["Rubrik", "home page", "en rad text som är lång", "slut.", "Namn:", "HELA RADEN", "  ", "ÅÄÖ", "fråga?", "liten rad", "Köp nu", "x", "1 2", "Svar :"]
    rows = [(i, [rng.choice(parts) for _ in range(rng.randint(0, 9))]) for i in range(200)]
    df = spark.createDataFrame(rows, "i int, x array<string>").withColumn("k", html.clean_lines(F.col("x")))
    assert all(r["j"] == html.running_text(r["x"]) for r in df.select("x", html.joined_lines(F.col("k")).alias("j")).collect())


def test_rejected_rows_are_not_worked_on(spark):
    df = spark.createDataFrame([("1", "https://x/a.pdf", "<html><![foo bar]>")], "id string, url string, html string")
    r = pipeline.run(df, pipeline.production()).first()
    assert r["filter_reason"] == "dropped by html" and not r["text"]


def test_lines(spark):
    def joined(xs):
        df = spark.createDataFrame([(xs,)], "x array<string>").withColumn("k", html.clean_lines(F.col("x")))
        return df.select(html.joined_lines(F.col("k"))).first()[0]

    assert joined(["Rubrik", "En rad text som är lång", "slut.", "Ny"]) == "Rubrik En rad text som är lång slut.\nNy"
    assert joined(["home page", "tre små ord", "Svar:", "Namn:", "HELA RADEN", "med flera ord i rad"]) == "Namn:\nHELA RADEN med flera ord i rad"
    assert joined([]) == ""


def test_link_tables(spark):
    t = "array<struct<id:int,markdown:string,placeholder:string>>"
    rows = [("a XYZ_TABLE_BLOCK_1_XYZ b", [(1, "|m|", "XYZ_TABLE_BLOCK_1_XYZ"), (2, "|n|", "XYZ_TABLE_BLOCK_2_XYZ")], "Titel"), ("a", [], "Titel"), ("", None, None)]
    df = spark.createDataFrame(rows, f"t string, tables {t}, og string")
    got = [r[0] for r in df.select(html.link_tables(F.col("t"), F.col("tables"), F.col("og"))).collect()]
    assert got[0] == "Titel\n\na \n\n|m|\n\n b\n\n### Bilagor (Tabeller)\n\n|n|" and got[1:] == ["a", ""]


def test_dense():
    body = "<div><a href=1>länk ett två tre fyra fem sex sju åtta</a></div><h2>Rubrik</h2><p>Det här är en lång mening som hör till texten.</p>"
    assert html.dense_text(body) == "Rubrik\nDet här är en lång mening som hör till texten."


def test_rouge_and_diff(spark):
    df = spark.createDataFrame([(1, "a a b", "a b b c"), (2, None, "x"), (3, "", "")], "id long, got string, gold string")
    r = {x["id"]: x for x in evaluate.rouge1(df, "id", "got", "gold").collect()}
    assert abs(r[1]["rouge1"] - 2 * (2 / 3) * 0.5 / (2 / 3 + 0.5)) < 1e-9 and r[2]["rouge1"] == 0 == r[3]["rouge1"]
    d = {x["id"]: x for x in evaluate.word_diff(df, "id", "got", "gold").collect()}
    assert d[1]["missing"] == ["b", "c"] and d[1]["extra"] == ["a"] and d[3]["missing"] == []


def test_gold_lookup(spark):
    docs = spark.createDataFrame([(1, "URN:uuid:Ab1"), (2, "zz"), (3, "")], "n long, id string")
    gold = spark.createDataFrame([("ab", "near"), ("ab1", "same"), ("", "all")], "id string, text string")
    assert {r["n"]: r["gold_text"] for r in evaluate.gold_lookup(docs, gold).collect()} == {1: "same", 2: None, 3: None}


def test_pipeline_reasons(spark):
    body = "<p>" + "Det är en lång och fin dag för oss alla i byn, och vi går till kvarnen som ligger vid sjön. " * 4 + "</p>"
    long = f"<html><body>{body}</body></html>"
    rows = [("1", "https://x/nyheter/1", long, "gold text"), ("2", "https://x/a.pdf", long, ""), ("3", None, "<html><p>kort", None), ("4", "x", "ingen sida", "g")]
    gold = spark.createDataFrame(rows, "id string, url string, html string, text string")
    out = {r["id"]: r["filter_reason"] for r in pipeline.run(gold.drop("text"), [pipeline.only_html(), pipeline.classify(), pipeline.extract(), pipeline.language()]).collect()}
    assert out == {"1": None, "2": "dropped by html", "3": "extractor: text too short", "4": "dropped by html"}
    r = pipeline.evaluate(gold, [pipeline.Experiment("a", [pipeline.only_html(), pipeline.classify(), pipeline.extract(), pipeline.custom("long", lambda d: F.length("text") > 10)])])
    t = pipeline.experiment_table(r).first()
    assert (t["saved"], t["discarded"], t["recall"], t["precision"]) == (1, 3, "50.0%", "100.0%")
