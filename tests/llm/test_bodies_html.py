"""Problem 2: bodies of pages without text, and blocks and titles that stand far away."""

import random

from skriftverk.llm import boilerplate

from .test_text import page


def test_bodies_from_html(spark):
    rng = random.Random(5)
    gold = [(f"g{i}", "https://x/a", *page(rng, i)[:2]) for i in range(25)]
    model = boilerplate.fitted(spark.createDataFrame(gold, "id string, url string, html string, text string"))
    rows, want = [], {}
    for i in range(12):
        markup, main, _, _ = page(rng, i)
        rows.append((i, (None, "", " \n ")[i % 3], markup, None))
        want[i] = main
    rows += [(90, None, None, None), (91, " ", None, None), (92, None, "", None)]
    df = spark.createDataFrame(rows, "page_id long, text string, html string, url string")
    got = {r["page_id"]: r["body"] for r in boilerplate.main_bodies(df, model).collect()}
    assert sum(got[i] == want[i] for i in want) >= 11
    assert got[90] is None and got[91] == "" and got[92] is None
    assert boilerplate.boilerplate_lines(df, model).count() == 0


def test_alignment_beyond_hidden_blocks():
    blocks = [(x, "p", "", 0.0) for x in ["Hem", *(f"dold {i}" for i in range(40)), "Rubriken", "Första raden", "Andra raden"]]
    assert boilerplate.aligned(["Hem", "Rubriken", "Första raden", "Andra raden"], blocks) == [0, 41, 42, 43]
    assert boilerplate.aligned(["Hem", "Andra raden", "dold 0", "dold 1"], blocks) == [0, -1, 1, 2]


def test_title_after_a_long_head():
    html = "<html><head><style>" + "a{}" * 10_000 + "</style><title>Kvarnen fick ett nytt hjul</title></head></html>"
    assert boilerplate.headline_marks(["Hem", "Kvarnen fick ett nytt hjul"], html, None) == {1}
