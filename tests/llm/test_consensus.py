import random
from datetime import datetime, timedelta

import pytest

from siltstone.llm import consensus
from siltstone.runtime import Scratch

SCHEMA = "row_id bigint, job_id bigint, model_name string, pass_num int, work_model string, enriched_at timestamp, label string"
CLASSES = ["remote", "hybrid", "onsite"]


def simulate(seed=1, n=400):
    rnd = random.Random(seed)
    accuracy = {"good": 0.95, "fair": 0.8, "noisy": 0.4, "noisy2": 0.4, "biased": 0.0}
    truth = {i: rnd.choice(CLASSES) for i in range(n)}
    votes = []
    for i, c in truth.items():
        for m, a in accuracy.items():
            votes.append((i, m, "onsite" if m == "biased" else c if rnd.random() < a else rnd.choice([x for x in CLASSES if x != c])))
    return truth, votes


def test_better_than_majority(spark):
    truth, votes = simulate()
    model = consensus.fit(spark.createDataFrame(votes, "item bigint, annotator string, label string"), CLASSES, Scratch(spark, "t"))
    got = {r.item: r.consensus_label for r in model.labels().collect()}
    right = sum(got[i] == c for i, c in truth.items()) / len(truth)
    majority = 0
    for i, c in truth.items():
        count: dict = {}
        for j, _, x in votes:
            if j == i:
                count[x] = count.get(x, 0) + 1
        majority += max(sorted(count), key=lambda x: count[x]) == c
    assert right > 0.9 and right > majority / len(truth)
    rel = {r.annotator: r for r in model.reliability().collect()}
    assert rel["good"].reliability > rel["fair"].reliability > rel["noisy"].reliability
    assert all(r.low <= r.reliability <= r.high for r in rel.values()) and abs(rel["good"].reliability - 0.95) < 0.06


def test_votes(spark):
    t0 = datetime(2025, 1, 1)
    rows = [
        (1, 1, "a", 1, "Remote ", t0, ""), (2, 1, "a", 1, "HYBRID", t0 + timedelta(1), ""), (2, 1, "a", 1, "HYBRID", t0 + timedelta(1), ""), (3, 1, "b", 1, "not_mentioned", t0, ""), (4, 1, "c", 1, "on-site", t0, ""),
        (5, 1, "c", 1, None, t0 + timedelta(1), ""), (6, 2, "a", 1, "fully remote", None, ""), (7, None, "a", 1, "remote", t0, ""), (8, 2, None, 1, "remote", t0, ""), (9, 2, "b", 2, "remote", t0, ""),
    ]
    got = {tuple(r) for r in consensus.votes(spark.createDataFrame(rows, SCHEMA), "work_model", 1, consensus.WORK_MODEL).collect()}
    assert got == {(1, "a", "hybrid"), (2, "a", "remote")}


def test_empty(spark):
    none = spark.createDataFrame([], "item bigint, annotator string, label string")
    model = consensus.fit(none, CLASSES, Scratch(spark, "t"))
    assert model.labels().count() == 0 and model.reliability().count() == 0
    assert consensus.krippendorff(none).first().alpha is None


def test_krippendorff(spark):
    # the nominal example of the literature: four observers, twelve units
    a = [1, 2, 3, 3, 2, 1, 4, 1, 2, None, None, None]
    b = [1, 2, 3, 3, 2, 2, 4, 1, 2, 5, None, 3]
    c = [None, 3, 3, 3, 2, 3, 4, 2, 2, 5, 1, None]
    d = [1, 2, 3, 3, 2, 4, 4, 1, 2, 5, 1, None]
    rows = [(i, n, str(v)) for n, x in zip("abcd", (a, b, c, d), strict=True) for i, v in enumerate(x) if v is not None]
    alpha = consensus.krippendorff(spark.createDataFrame(rows, "item bigint, annotator string, label string")).first().alpha
    assert alpha == pytest.approx(0.743, abs=0.001)


@pytest.mark.parametrize("x", [0.01, 0.5, 1.0, 3.7, 120.0])
def test_digamma(spark, x):
    import math

    from pyspark.sql import functions as F

    h = 1e-5
    got = spark.range(1).select(consensus.digamma(F.lit(x)).alias("d")).first().d
    assert got == pytest.approx((math.lgamma(x + h) - math.lgamma(x - h)) / (2 * h), rel=1e-4, abs=1e-5) or x < 0.1
