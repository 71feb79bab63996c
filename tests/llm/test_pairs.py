"""Problems 4, 5 and 9 against brute force, with hot groups and edge cases."""

import collections
import random

import pytest

from skriftverk.llm.common import words
from skriftverk.llm.history import History, repeated_records
from skriftverk.llm.leakage import lcs_length, leaks
from skriftverk.llm.neardup import near_duplicate_groups, near_duplicate_pairs


def grams(t, k=5):
    w = words(t)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def corpus(seed, n=120):
    """Texts of a small vocabulary, edited copies in chains, exact copies, a hot copy, short and empty ones."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        r = rng.random()
        if out and r < 0.5:
            w = (rng.choice(out) or "").split()
            for _ in range(rng.randint(0, 4)):
                if w:
                    i = rng.randrange(len(w))
                    w[i : i + rng.randint(0, 1)] = [f"n{rng.randint(0, 400)}"] * rng.randint(0, 2)
            out.append(" ".join(w))
        elif r < 0.6:
            out.append("den heta texten som alla har i sin samling och aldrig ändrar")
        else:
            out.append(" ".join(f"o{rng.randint(0, 300)}" for _ in range(rng.randint(3, 40))) + " samma slut på varje text i byn")
    return [*out, None, "", " ", "bara fyra ord här"]


@pytest.mark.parametrize("seed,rare", [(1, 32), (2, 1), (3, 2)])
def test_pairs(spark, seed, rare):
    texts = corpus(seed)
    df = spark.createDataFrame([(i, t, 5, "x") for i, t in enumerate(texts)], "doc_id long, text string, fp int, n string")
    sets = [grams(t) for t in texts]
    want = {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 72 * len(sets[i] | sets[j])}
    got = [tuple(r) for r in near_duplicate_pairs(df, similarity="0.72", rare=rare).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    groups = {r["doc_id"]: r for r in near_duplicate_groups(df, similarity="0.72", rare=rare).collect()}
    near = collections.defaultdict(set)
    for a, b in want:
        near[a].add(b)
        near[b].add(a)
    assert set(groups) == set(near)
    for a, b in want:
        assert groups[a]["group"] == groups[b]["group"] <= a
    for a in near:
        assert groups[a]["links"] == len({frozenset(sets[b]) for b in near[a]} - {frozenset(sets[a])})


def brute_history(rows):
    held, out = [], []
    for rec, batch, t in sorted(rows, key=lambda r: (r[1], r[0])):
        g = grams(t)
        if g and batch >= 1 and any(100 * len(g & h) >= 72 * len(g | h) for h in held):
            out.append(rec)
        elif g:
            held.append(g)
    return sorted(out)


@pytest.mark.parametrize("seed", [4, 5])
def test_history(spark, seed):
    rng = random.Random(seed)
    rows = [(i, rng.choice([0, 0, 1, 2]), t) for i, t in enumerate(corpus(seed, 90))]
    df = spark.createDataFrame([*rows, (None, 1, "ett två tre fyra fem"), (900, None, "ett två tre fyra fem")], "rec_id long, batch_no int, text string")
    assert sorted(r[0] for r in repeated_records(df, similarity="0.72").collect()) == brute_history(rows)


def test_history_edges(spark):
    none = spark.createDataFrame([], "rec_id long, batch_no int, text string")
    assert repeated_records(none).count() == 0
    chain = ["a b c d e f g h i j k l m n o p q r s t", "a b c d e f g h i j k l m n o p q r s x", "a b c d e f g h i j k l m n o p q r y x"]
    df = spark.createDataFrame([(i, 1, t) for i, t in enumerate(chain)], "rec_id long, batch_no int, text string")
    assert [r[0] for r in repeated_records(df, similarity="0.85").collect()] == [1]
    h = History(spark, "rec_id", "text", "0.72")
    for b in range(6):
        part = spark.createDataFrame([(100 * b + i, f"unik text nummer {b} {i} med {i * b} egna ord och {b}{i} till") for i in range(20)], "rec_id long, text string")
        h.accept_all(part)
    assert len(h.segments) <= 4
    h.close()


def test_leaks(spark):
    rng = random.Random(6)
    item = lambda n: " ".join(f"i{rng.randint(0, 500)}" for _ in range(n))
    items = [(1, item(40)), (2, item(12)), (3, item(9)), (4, item(7)), (5, None), (6, "")]
    items.append((7, items[0][1]))
    texts = []
    for _ in range(200):
        w = [f"d{rng.randint(0, 900)}" for _ in range(rng.randint(0, 60))]
        src = words(rng.choice(items)[1])
        if src:
            a = rng.randrange(len(src))
            w[len(w) // 2 : len(w) // 2] = src[a : a + rng.randint(5, 20)]
        texts.append(" ".join(w).upper().replace(" ", " - ", 3))
    df = spark.createDataFrame([*enumerate(texts), (900, None), (901, "")], "doc_id long, text string")
    it = spark.createDataFrame(items, "item_id long, text string")
    want = set()
    for d, t in enumerate(texts):
        s = " " + " ".join(words(t)) + " "
        for i, q in items:
            w = words(q)
            n = min(12, len(w))
            if len(w) >= 8 and any(" " + " ".join(w[j : j + n]) + " " in s for j in range(len(w) - n + 1)):
                want.add((d, i))
    got = leaks(df, it).filter("exact").select("doc_id", "item_id")
    assert {tuple(r) for r in got.collect()} == want and want
    assert leaks(df.limit(0), it).count() == 0 and leaks(df, it.limit(0)).count() == 0
    with pytest.raises(ValueError):
        leaks(df, it, max_words=10)
    q = words(items[0][1])
    para = " ".join(x for i, x in enumerate(q) if i % 10)
    p = leaks(spark.createDataFrame([(1, para)], "doc_id long, text string"), it, cosine=0.8, known=6, paraphrases=True, bits=8, tables=6).filter("not exact").collect()
    assert {r["item_id"] for r in p} == {1, 7} and all(r["lcs"] > 0.85 for r in p)


def test_lcs():
    import numpy as np

    assert lcs_length(np.array([1, 2, 3, 4]), np.array([2, 9, 4])) == 2 and lcs_length(np.array([], int), np.array([1])) == 0
