from pyspark.sql import functions as F

from skriftverk.operators import dedup, minhash, pii
from skriftverk.operators.components import connected_components
from skriftverk.operators.repetition import NGRAM_COLUMNS, line_repetition, ngram_repetition, ngram_shares, repetition_reason


def test_exact(spark):
    rows = [(1, "a", 2), (2, " a\n", 1), (3, None, 1), (4, "", 1), (5, "b", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, part int")
    kept, removed = dedup.exact_dedup(df, order=["part"])
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == [2, 3, 5]
    assert sorted(r[0] for r in removed.select("doc_id").collect()) == [1, 4]
    again = dedup.exact_dedup(kept, order=["part"])[1]
    assert again.count() == 0


def test_hot_text(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"))
    kept, removed = dedup.exact_dedup(df)
    assert kept.count() == 2001 and removed.count() == 999
    assert kept.filter("text = 'hot'").first()["doc_id"] == 0


def test_unseen_and_sketch(spark):
    old = spark.createDataFrame([("a",), ("b",)], "text string").select(dedup.content_key(F.col("text")).alias("key"))
    new = spark.createDataFrame([(1, "a"), (2, "c"), (3, "c"), (4, "d")], "doc_id long, text string")
    assert sorted(r[0] for r in dedup.unseen(new, old).select("doc_id").collect()) == [2, 4]
    sketch = dedup.BloomSketch(1000, 0.001).add_all(old)
    keyed = new.withColumn("key", dedup.content_key(F.col("text")))
    assert sorted(r[0] for r in sketch.missing(keyed, "key").select("doc_id").collect()) == [2, 3, 4]
    assert sum(str(i) in sketch for i in range(2000)) < 5


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (7, 7), (None, 3)]
    got = {r[0]: r[1] for r in connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert {got[i] for i in range(1, 61)} == {1} and got[101] == 100 and 7 in got
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_minhash(spark):
    base = [f"w{i}" for i in range(120)]
    near = base[:118] + ["x", "y"]
    far = [f"v{i}" for i in range(120)]
    rows = [(5, " ".join(base)), (3, " ".join(near)), (9, " ".join(far)), (1, "w0 w1 w2"), (2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept, removed = minhash.near_dedup(df)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 9]
    assert [r["doc_id"] for r in removed.collect()] == [5]


def test_repetition(spark):
    s = dict(zip(NGRAM_COLUMNS, ngram_shares("a b c d e a b c d e")))
    assert s["dup_5"] == 0.5 and s["dup_6"] == 0 and s["top_2"] == 0.4
    assert ngram_shares(None) == [0.0] * 9 == ngram_shares("")
    df = spark.createDataFrame([(1, "x\nx\nx\ny"), (2, "a\n\na"), (3, None), (4, "fin text utan upprepning")], "doc_id long, text string")
    r = {x["doc_id"]: x for x in ngram_repetition(line_repetition(df)).select("*", repetition_reason().alias("reason")).collect()}
    assert r[1]["dup_line_share"] == 0.5 and r[1]["reason"] == "dup_line_share"
    assert r[2]["dup_paragraph_share"] == 0.5 and r[3]["reason"] is None and r[4]["reason"] is None


def test_contact_data(spark):
    t = "Ring 070-123 45 67 eller +46 70 123 45 67, skriv a@b.se. Storgatan 5, 123 45 Ort. Pris 123 45 kr."
    df = spark.createDataFrame([(t, "article"), (None, None)], "t string, c string")
    assert df.select(*(pii.distinct_matches(F.col("t"), p) for p in pii.PATTERNS.values())).first()[:] == (2, 1, 1, 1)
    m = df.select(pii.masked(F.col("t"))).first()[0]
    assert "[EPOST]" in m and "[TELEFONNUMMER]" in m and "[ADRESS] [POSTNUMMER] Ort" in m and "123 45 kr" in m
    assert df.select(pii.within_budget(F.col("t"), F.col("c"))).collect()[1][0]
