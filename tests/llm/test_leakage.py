import random

import numpy as np
from pyspark.sql import functions as F

from siltstone.llm import leakage

WORDS = [f"{a}{b}" for a in ("data", "stream", "model", "queue", "price", "cloud", "graph", "shift", "table", "event") for b in ("er", "ing", "age", "ory", "ful", "ish", "ment", "able", "less", "ward", "ism", "dom")]
ITEM = "item_id bigint, item_text string, answer string"


def text(rnd, n):
    return [rnd.choice(WORDS) + str(rnd.randrange(60)) for _ in range(n)]


def cases(seed=3):
    rnd = random.Random(seed)
    items = {i: text(rnd, 110) for i in range(12)}
    docs, want = {}, set()

    def add(words, *hits):
        d = len(docs)
        docs[d] = words if isinstance(words, str) else " ".join(words)
        want.update((d, i) for i in hits)

    for i, w in items.items():
        add(text(rnd, 30) + w[10:52] + text(rnd, 60), i)  # forty-two words within other text
        add(text(rnd, 30) + w[10:40] + text(rnd, 60))  # thirty words
        r = w[20:64]
        for k in (4, 15, 26, 37):
            r[k] = "half-finished"
        add(text(rnd, 25) + r + text(rnd, 9), i)  # single words replaced by a compound
        add("<p>" + "</p>\n<li>".join(x.upper() + "​!" for x in w[:50]) + "</li>", i)  # markup, case, marks
        add(" ".join(w[5:60]).replace("a", "а").replace("e", "é"), i)  # look-alikes
        s = list(w[:60])
        rnd.shuffle(s)
        add(s)  # another order
        b = w[30:76]
        for k in range(0, 46, 5):
            b[k] = "other"
        add(b)  # two in ten replaced
        add(text(rnd, 400))
    add(items[0][:50] + items[1][40:100], 0, 1)
    return items, docs, want


def run(spark, items, docs, **kw):
    i = spark.createDataFrame([(k, v if v is None or isinstance(v, str) else " ".join(v), "x") for k, v in items.items()], ITEM)
    d = spark.createDataFrame([(k, v, 1) for k, v in docs.items()], "doc_id bigint, text string, item_id int").repartition(3)
    return {(r.doc_id, r.item_id) for r in leakage.leaks(d, i, **kw).collect()}


def test_planted_passages(spark):
    # exact alignment lets nothing else through; words drawn at random are the hardest corpus for a low rank
    items, docs, want = cases()
    got = run(spark, items, docs)
    assert got <= want and len(got) >= 0.95 * len(want)


def test_retrieval_recall_against_brute_force(spark):
    # every pair that exact alignment accepts must come through the latent candidates
    items, docs, _ = cases(seed=8)
    exact = {(d, i) for d, t in docs.items() for i, w in items.items() if leakage.run_length(leakage.codes(" ".join(w)), leakage.codes(t), leakage.weights(" ".join(w)))}
    got = run(spark, items, docs)
    assert len(got & exact) >= 0.9 * len(exact) and got <= exact


def test_odd_rows(spark):
    rnd = random.Random(2)
    w = text(rnd, 60)
    long = " ".join(text(rnd, 20000) + w + text(rnd, 20000))
    docs = {1: None, 2: "", 3: " ", 4: long, 5: " ".join(w)}
    assert run(spark, {1: w, 2: None, 3: "", 4: "too short"}, docs) == {(4, 1), (5, 1)}
    assert run(spark, {}, docs) == set()
    assert run(spark, {1: w}, {}) == set()
    twice = spark.createDataFrame([(5, " ".join(w))] * 3, "doc_id bigint, text string")
    assert leakage.leaks(twice, spark.createDataFrame([(1, " ".join(w), "x")], ITEM)).count() == 1


def test_items_in_blocks(spark):
    """However small the blocks of items are, the result is the same."""
    import random

    rnd = random.Random(11)
    items = {i: " ".join(f"w{rnd.randrange(4000)}" for _ in range(60)) for i in range(5)}
    docs = {i: f"before {t} after" for i, t in items.items()} | {9: "nothing of it"}
    assert run(spark, docs, items, block=2) == run(spark, docs, items) == {(i, i) for i in items}


def test_long_runs_with_one_word_replaced():
    """A passage of 300 words with one replaced is one run, wherever the word stands."""
    for at in (150, 250):
        a = np.arange(300, dtype=np.uint32)
        b = a.copy()
        b[at] = 9999
        assert leakage.run_length(a, b, np.ones(300, np.int64)) == 300


def test_answers(spark):
    docs = spark.createDataFrame([(1, "they said Senior, of course"), (2, "seniority")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "t", "senior"), (2, "t", None)], ITEM)
    found = spark.createDataFrame([(1, 1), (2, 1), (1, 2)], "doc_id bigint, item_id bigint").withColumn("run_words", F.lit(1)).withColumn("cosine", F.lit(1.0))
    got = {(r.doc_id, r.item_id): r.answer_in_text for r in leakage.answers(found, docs, items).collect()}
    assert got == {(1, 1): True, (2, 1): False, (1, 2): False}


def test_run_length_by_brute_force():
    rnd = random.Random(5)
    for _ in range(40):
        a = [rnd.randrange(10**6) for _ in range(70)]
        b = [rnd.randrange(10**6) for _ in range(10)] + a[5:65] + [rnd.randrange(10**6) for _ in range(10)]
        miss = [k for k in range(60) if rnd.random() < 0.08]
        for k in miss:
            b[10 + k] = -k - 1
        hit = [k not in miss for k in range(60)]
        want = 0
        for s in range(60):
            for e in range(s + 1, 61):
                seg = hit[s:e]
                # blocks of at least two words, single misses between them
                ok = seg[0] and seg[-1] and seg.count(False) * 10 <= len(seg) and not any(not x and not y for x, y in zip(seg, seg[1:], strict=False))
                runs = "".join("#" if x else "." for x in seg).split(".")
                if ok and all(len(r) >= 2 for r in runs):
                    want = max(want, e - s)
        got = leakage.run_length(np.array(a, np.uint32), np.array([x & 0xFFFFFFFF for x in b], np.uint32), np.ones(70, np.int64), 1)
        assert got == want
