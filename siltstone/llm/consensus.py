"""Consensus labels of several annotators who disagree.

A mean-field variational confusion model. Each annotator has a confusion matrix with a Dirichlet prior on
every row, the classes have a Dirichlet prior; an item's class posterior and the Dirichlet posteriors are
updated in turn. Each update is a group-by: expected log probabilities come from digammas over the table of
(annotator, class, label) counts, item posteriors sum them over an item's votes, and counts sum the
posteriors over the votes.

Only tables of size annotators x classes x labels are ever local; votes and posteriors stay distributed.

Defined results: missing labels ("not_mentioned", "n/a", blank, null) and labels outside the classes are no
votes. Of an annotator's rows for one item the latest counts, ties by the larger row_id; if that one's
label is missing, the annotator has no vote. Repeated rows count once. An item without votes gets the
largest class. Ties go to the first class in order.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.runtime import Scratch

# The classes and the ways they are written, letters only.
SENIORITY = {
    "entry": ["entry", "entrylevel", "graduate"], "junior": ["junior", "jr", "juniorlevel"], "mid": ["mid", "midlevel", "middle", "intermediate"],
    "senior": ["senior", "sr", "seniorlevel"], "staff": ["staff", "stafflevel"], "principal": ["principal", "principallevel"],
}
WORK_MODEL = {"remote": ["remote", "fullyremote", "remotefirst"], "hybrid": ["hybrid"], "onsite": ["onsite", "inoffice", "office"]}


def canonical(c: str, classes: dict[str, list[str]]) -> Column:
    """The class a label is a spelling of, else null."""
    pairs = [F.lit(x) for k, vs in classes.items() for v in vs for x in (v, k)]
    return F.try_element_at(F.create_map(*pairs), F.regexp_replace(F.lower(c), "[^a-z]", ""))


def votes(jobs: DataFrame, field: str, pass_num: int, classes: dict[str, list[str]]) -> DataFrame:
    """item, annotator, label of one field: the latest row of each annotator and item."""
    rows = jobs.filter((F.col("pass_num") == pass_num) & F.col("job_id").isNotNull() & F.col("model_name").isNotNull())
    latest = rows.groupBy(F.col("job_id").alias("item"), F.col("model_name").alias("annotator")).agg(
        F.max_by(F.struct(canonical(field, classes).alias("label")), F.struct("enriched_at", "row_id")).alias("b")
    )
    return latest.select("item", "annotator", F.col("b.label").alias("label")).filter("label is not null")


def digamma(x: Column) -> Column:
    """Digamma of a positive column: six steps of recurrence, then the asymptotic series."""
    z = x + 6
    shift = sum(((1 / (x + i)) for i in range(1, 6)), 1 / x)
    inv = 1 / (z * z)
    return F.log(z) - 0.5 / z - inv * (1 / 12 - inv * (1 / 120 - inv / 252)) - shift


class Consensus:
    """The fitted model: posteriors per item, Dirichlet counts per annotator."""

    def __init__(self, items: DataFrame, counts: DataFrame, classes: list[str]):
        self.items, self.counts, self.classes = items, counts, classes

    def labels(self) -> DataFrame:
        """item, consensus_label, confidence."""
        k = F.array_position("post", F.array_max("post")).cast("int")
        return self.items.select("item", F.element_at(F.array(*map(F.lit, self.classes)), k).alias("consensus_label"), F.array_max("post").alias("confidence"))

    def reliability(self, alpha: float = 0.5) -> DataFrame:
        """annotator, n_votes, reliability with a 95 % interval: the chance of the right label, from the Dirichlet rows' means and variances."""
        rows = self.counts.groupBy("annotator", "truth").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("truth") == F.col("label"), F.col("n")).otherwise(0)).alias("hit"))
        k = len(self.classes)
        a, b = F.col("hit") + 1 + alpha, F.col("n") - F.col("hit") + alpha * (k - 1)
        rows = rows.select("annotator", "n", (a / (a + b)).alias("m"), (a * b / ((a + b) ** 2 * (a + b + 1))).alias("v"))
        tot = rows.groupBy("annotator").agg(F.sum("n").alias("n_votes"), (F.sum(F.col("m") * F.col("n")) / F.sum("n")).alias("reliability"), (F.sqrt(F.sum(F.col("v") * F.col("n") ** 2)) / F.sum("n")).alias("sd"))
        return tot.select("annotator", "n_votes", "reliability", F.greatest(F.lit(0.0), F.col("reliability") - 1.96 * F.col("sd")).alias("low"), F.least(F.lit(1.0), F.col("reliability") + 1.96 * F.col("sd")).alias("high"))


def _posteriors(packed: DataFrame, table: np.ndarray, annotators: list[str], alpha: float, diagonal: float) -> DataFrame:
    """item, vs, post: each item's class posterior under Dirichlet counts; row k of table's last annotator holds the class counts."""
    spark, k = packed.sparkSession, table.shape[1]
    rows = [(a, t, x, float(table[i, t, x]) + alpha + (diagonal if t == x else 0.0)) for i, a in enumerate(annotators) for t in range(k) for x in range(k)]
    raw = spark.createDataFrame(rows, "annotator string, t int, l int, a double")
    logs = raw.join(raw.groupBy("annotator", "t").agg(F.sum("a").alias("s")), ["annotator", "t"]).withColumn("e", digamma(F.col("a")) - digamma(F.col("s")))
    params = logs.groupBy("annotator", "l").agg(F.transform(F.array_sort(F.collect_list(F.struct("t", "e"))), lambda x: x["e"]).alias("e"))
    sizes = table[-1, :, 0] + 1.0
    prior = [F.lit(float(x)) for x in sizes]
    head = [digamma(x) - digamma(F.lit(float(sizes.sum()))) for x in prior]
    joined = packed.select("item", F.explode("vs").alias("v")).join(F.broadcast(params), (F.col("v.annotator") == F.col("annotator")) & (F.col("v.l") == F.col("l")))
    sums = joined.groupBy("item").agg(*[F.sum(F.get("e", F.lit(c))).alias(f"s{c}") for c in range(k)], F.array_sort(F.collect_list("v")).alias("vs"))
    scored = sums.select("item", "vs", F.array(*[F.col(f"s{c}") + head[c] for c in range(k)]).alias("score"))
    soft = scored.select("item", "vs", F.transform("score", lambda x: F.exp(x - F.array_max("score"))).alias("soft"))
    return soft.select("item", "vs", F.transform("soft", lambda x: x / F.aggregate("soft", F.lit(0.0), lambda a, y: a + y)).alias("post"))


def _counts(post: DataFrame, annotators: list[str], k: int) -> np.ndarray:
    """Expected counts: annotators x classes x labels, and the class counts in one more row. One group-by of the votes."""
    votes_and_item = F.concat("vs", F.array(F.struct(F.lit(None).cast("string").alias("annotator"), F.lit(0).alias("l"))))
    flat = post.select(F.explode(votes_and_item).alias("v"), "post").select("v.annotator", "v.l", F.posexplode("post").alias("t", "p"))
    out = np.zeros((len(annotators) + 1, k, k))
    at = {a: i for i, a in enumerate(annotators)}
    for r in flat.groupBy("annotator", "l", "t").agg(F.sum("p").alias("n")).collect():
        out[at.get(r.annotator, len(annotators)), r.t, r.l] = r.n
    return out


def fit(vote: DataFrame, classes: list[str], scratch: Scratch, rounds: int = 600, alpha: float = 0.5, diagonal: float = 1.0, tol: float = 2e-4) -> Consensus:
    """Fits the model to votes (item, annotator, label). alpha: Dirichlet prior of every cell, plus `diagonal` on the right one.

    Plain updates converge slowly where annotators are weak, so of the first sixty each two are followed by a squared
    extrapolation of the counts, taken back where it leaves the positive range; later ones are plain, which always rise.
    Counts that haven't settled after `rounds` updates are an error.
    """
    k = len(classes)
    index = F.create_map(*[x for i, c in enumerate(classes) for x in (F.lit(c), F.lit(i))])
    # one row per item, its votes side by side
    packed = scratch.keep(vote.groupBy("item").agg(F.array_sort(F.collect_list(F.struct("annotator", index[F.col("label")].alias("l")))).alias("vs")), "votes")
    annotators = sorted(r[0] for r in vote.select("annotator").distinct().collect())
    share = lambda c: F.aggregate("vs", F.lit(0.0), lambda a, v: a + F.when(v["l"] == c, 1.0).otherwise(0.0)) / F.size("vs")
    now = _counts(packed.select("item", "vs", F.array(*[share(c) for c in range(k)]).alias("post")), annotators, k)
    step = lambda c: _counts(_posteriors(packed, c, annotators, alpha, diagonal), annotators, k)
    limit = tol * max(1.0, now[-1].sum())
    for n in range(rounds // 2 if annotators else 0):
        one = step(now)
        if np.abs(one - now).max() <= limit:
            now = one
            break
        two = step(one)
        r, v = one - now, two - 2 * one + now
        size = min(-1.0, -float(np.linalg.norm(r) / max(np.linalg.norm(v), 1e-12)))
        jump = now - 2 * size * r + size * size * v
        now = jump if n < 30 and (jump >= 0).all() else two
    else:
        if annotators:
            raise RuntimeError(f"the counts of annotators haven't settled after {rounds} updates")
    post = scratch.keep(_posteriors(packed, now, annotators, alpha, diagonal), "post")
    flat = post.select(F.explode("vs").alias("v"), "post").select("v.annotator", "v.l", F.posexplode("post").alias("t", "p"))
    counts = flat.groupBy("annotator", F.col("t").alias("truth"), F.col("l").alias("label")).agg(F.sum("p").alias("n"))
    return Consensus(post, counts, classes)


def krippendorff(vote: DataFrame) -> DataFrame:
    """n_items, n_votes, alpha of nominal labels over items with two votes or more; alpha is 1 where only one label occurs."""
    per = vote.groupBy("item", "label").agg(F.count("*").alias("n"))
    size = per.groupBy("item").agg(F.sum("n").alias("m"), F.sum(F.col("n") * F.col("n")).alias("q")).filter("m > 1")
    # disagreeing ordered pairs of an item, each item weighted by its votes
    observed = size.agg(F.count("*").alias("n_items"), F.sum("m").alias("n_votes"), F.sum((F.col("m") * F.col("m") - F.col("q")) / (F.col("m") - 1)).alias("d"))
    totals = per.join(size.select("item"), "item").groupBy("label").agg(F.sum("n").alias("n"))
    expected = totals.agg(F.sum("n").alias("all"), F.sum(F.col("n") * F.col("n")).alias("q"))
    both = observed.withColumn("one", F.lit(1)).join(expected.withColumn("one", F.lit(1)), "one")
    e = (F.col("all") * F.col("all") - F.col("q")) / (F.col("all") - 1)
    return both.select("n_items", "n_votes", F.when(F.col("n_items") == 0, None).when(F.coalesce(e, F.lit(0)) == 0, 1.0).otherwise(1 - F.col("d") / e).alias("alpha"))
