"""Problem 9: paraphrases wherever they stand in a document."""

import random

import numpy as np

from skriftverk.llm.leakage import lcs_length, lcs_lengths, leaks
from skriftverk.llm.queries import p9_leaks


def test_paraphrase_after_a_quotation(spark, tmp_path):
    rng = random.Random(8)
    other = lambda n: [f"d{rng.randint(0, 900)}" for _ in range(n)]
    items = [[f"i{rng.randint(0, 5000)}" for _ in range(40)] for _ in range(6)]
    docs = []
    for q in items:
        near = [x for i, x in enumerate(q) if i % 10]
        new = [x if i % 4 else f"n{i}" for i, x in enumerate(q)]  # a new word in each window
        docs += [other(45) + q[5:14] + other(100) + near + other(20), other(60) + new + other(30)]
    spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, " ".join(q)) for i, q in enumerate(items)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]): r["lcs"] for r in p9_leaks(spark, str(tmp_path)).collect()}
    assert set(got) == {(i, i // 2) for i in range(len(docs))}
    assert all(got[i, i // 2] >= (0.75, 0.9)[i % 2 == 0] for i in range(len(docs)))


def test_best_of_the_places(spark):
    """An exact part at one place, the whole item in other words at another one."""
    q = [f"i{k}" for k in range(40)]
    d = ["x"] * 50 + q[10:22] + ["y"] * 100 + [w for k, w in enumerate(q) if k % 10] + ["z"] * 50
    docs, items = spark.createDataFrame([(1, " ".join(d))], "doc_id long, text string"), spark.createDataFrame([(1, " ".join(q))], "item_id long, text string")
    r = leaks(docs, items, cosine=0.75, known=5, paraphrases=True, bits=4, tables=4).collect()
    assert len(r) == 1 and r[0]["exact"] and r[0]["run"] >= 12 and r[0]["lcs"] == 0.9


def test_lcs_of_rows():
    rng = np.random.default_rng(3)
    a, rows = rng.integers(0, 6, 30), rng.integers(0, 6, (20, 40))
    assert lcs_lengths(a, rows).tolist() == [lcs_length(a, r) for r in rows]
