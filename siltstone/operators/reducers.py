"""Consensus reducers over a long table of answers (keys, model, value): one row per key.

All work on any number of models by group-bys; only free-text similarity needs Python. Null answers are
outliers of every reducer but the list one, where they count as empty lists. Ties go to the smallest value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.text import likeness

AGREE = 0.6


def _outliers(cond: Column) -> Column:
    return F.array_sort(F.collect_list(F.when(cond, F.col("model"))))


def categorical(long: DataFrame, keys: list[str]) -> DataFrame:
    """consensus_value (null without consensus), mode, agreement_rate, entropy, n_models, is_consensus, outliers (all that
    differ from the mode), distribution of the values; all null: rate 0, no consensus and all are outliers."""
    counts = long.filter("value is not null").groupBy(*keys, "value").agg(F.count("*").alias("n"))
    top = counts.groupBy(*keys).agg(F.sum("n").alias("valid"), F.max("n").alias("best"), F.collect_list(F.struct("n", "value")).alias("all"))
    share = lambda x: x["n"] / F.col("valid")
    entropy = F.aggregate("all", F.lit(0.0), lambda a, x: a - share(x) * F.log2(share(x)))
    winner = F.array_min(F.transform(F.filter("all", lambda x: x["n"] == F.col("best")), lambda x: x["value"]))
    shares = F.map_from_entries(F.transform(F.array_sort(F.transform("all", lambda x: F.struct(x["value"], x["n"]))), lambda x: F.struct(x["value"], x["n"])))
    top = top.select(*keys, winner.alias("mode"), shares.alias("distribution"), (F.col("best") / F.col("valid")).alias("agreement_rate"), entropy.alias("entropy"))
    joined = long.join(top, keys, "left")
    out = joined.groupBy(*keys).agg(
        F.first("mode").alias("mode"), F.first("distribution").alias("distribution"), F.coalesce(F.first("agreement_rate"), F.lit(0.0)).alias("agreement_rate"), F.coalesce(F.first("entropy"), F.lit(0.0)).alias("entropy"),
        F.count("*").alias("n_models"), _outliers(F.col("value").isNull() | F.col("mode").isNull() | (F.col("value") != F.col("mode"))).alias("outliers"),
    )
    out = out.withColumn("is_consensus", F.col("agreement_rate") >= AGREE)
    return out.withColumn("consensus_value", F.when(F.col("is_consensus"), F.col("mode")))


def numeric(long: DataFrame, keys: list[str], cv_limit: float = 0.15, z_limit: float = 2.0) -> DataFrame:
    """consensus_value (the median, null without consensus), mean, median, population std, cv, outliers beyond z_limit; consensus where cv <= cv_limit and at most one is null.
    One value has std 0; a zero mean has cv 0; all null is consensus on null."""
    stat = long.groupBy(*keys).agg(F.avg("value").alias("mean_value"), F.median("value").alias("median_value"), F.coalesce(F.stddev_pop("value"), F.lit(0.0)).alias("std"), F.sum(F.col("value").isNull().cast("int")).alias("n_null"), F.count("*").alias("n_models"))
    stat = stat.withColumn("cv", F.when(F.coalesce(F.col("mean_value"), F.lit(0.0)) == 0, 0.0).otherwise(F.col("std") / F.col("mean_value")))
    joined = long.join(stat, keys)
    z = F.when(F.col("std") > 0, F.abs(F.col("value") - F.col("mean_value")) / F.col("std")).otherwise(0.0)
    out = joined.groupBy(*keys, "mean_value", "median_value", "std", "cv", "n_null", "n_models").agg(_outliers((F.col("n_null") < F.col("n_models")) & (F.col("value").isNull() | (z > z_limit))).alias("outliers"))
    out = out.withColumn("is_consensus", (F.col("n_null") == F.col("n_models")) | ((F.col("cv") <= cv_limit) & (F.col("n_null") <= 1)))
    return out.withColumn("consensus_value", F.when(F.col("is_consensus"), F.col("median_value")))


def boolean(long: DataFrame, keys: list[str]) -> DataFrame:
    """consensus_value (true wins a tie, null without consensus), agreement_rate, outliers (all that differ from the more
    frequent value), is_consensus; all null: rate 0 and all are outliers."""
    c = long.groupBy(*keys).agg(F.count_if(F.col("value")).alias("n_true"), F.count_if(~F.col("value")).alias("n_false"), F.count("*").alias("n_models"))
    said = F.col("n_true") + F.col("n_false") > 0
    c = c.withColumn("mode", F.when(said, F.col("n_true") >= F.col("n_false"))).withColumn("agreement_rate", F.when(said, F.greatest("n_true", "n_false") / (F.col("n_true") + F.col("n_false"))).otherwise(0.0))
    out = long.join(c, keys).groupBy(*keys, "mode", "agreement_rate", "n_models", "n_true", "n_false").agg(_outliers(F.col("value").isNull() | (F.col("value") != F.col("mode"))).alias("outliers"))
    out = out.withColumn("is_consensus", F.col("agreement_rate") >= AGREE)
    return out.withColumn("consensus_value", F.when(F.col("is_consensus"), F.col("mode")))


def lists(long: DataFrame, keys: list[str], keep: float = 0.5) -> DataFrame:
    """consensus_items (in at least `keep` of all models' sets), n_union, n_common (in all non-empty sets), avg_jaccard over
    pairs of models (two empty sets are alike), avg_core_agreement: how much of the consensus the models hold."""
    sets = long.select(*keys, "model", F.array_sort(F.array_distinct(F.filter(F.transform(F.coalesce("value", F.array()), lambda x: F.lower(F.trim(x))), lambda x: x != ""))).alias("s"))
    flat = sets.select(*keys, F.explode("s").alias("item")).groupBy(*keys, "item").agg(F.count("*").alias("n"))
    size = sets.groupBy(*keys).agg(F.count("*").alias("n_models"), F.sum((F.size("s") > 0).cast("int")).alias("n_filled"))
    items = flat.join(size, keys).groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.when(F.col("n") >= keep * F.col("n_models"), F.col("item")))).alias("consensus_items"), F.count("*").alias("n_union"), F.count_if(F.col("n") == F.col("n_filled")).alias("n_common")
    )
    a, b = sets.alias("a"), sets.alias("b")
    on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    both = F.size(F.array_union("a.s", "b.s"))
    # pairs of models on one key: as many as models squared, not rows
    pair = a.join(b, [*on, F.col("a.model") < F.col("b.model")]).groupBy(*[F.col(f"a.{k}").alias(k) for k in keys]).agg(F.avg(F.when(both == 0, 1.0).otherwise(F.size(F.array_intersect("a.s", "b.s")) / both)).alias("avg_jaccard"))
    base = size.join(items, keys, "left").join(pair, keys, "left")
    base = base.select(*keys, "n_models", "n_filled", F.coalesce("consensus_items", F.array().cast("array<string>")).alias("consensus_items"), F.coalesce("n_union", F.lit(0)).alias("n_union"), F.coalesce("n_common", F.lit(0)).alias("n_common"), F.coalesce("avg_jaccard", F.lit(1.0)).alias("avg_jaccard"))
    core = F.when(F.size("consensus_items") > 0, F.size(F.array_intersect("s", "consensus_items")) / F.size("consensus_items")).otherwise(F.when(F.col("n_filled") == 0, 1.0).otherwise(0.0))
    out = sets.join(base, keys).groupBy(*keys, "n_models", "n_filled", "consensus_items", "n_union", "n_common", "avg_jaccard").agg(F.avg(core).alias("avg_core_agreement"), _outliers((F.size("consensus_items") > 0) & (core < AGREE)).alias("outliers"))
    return out.withColumn("is_consensus", (F.col("n_filled") == 0) | ((F.col("avg_core_agreement") >= AGREE) & (F.size("consensus_items") > 0))).drop("n_filled")


def strings(long: DataFrame, keys: list[str], alike: float = 0.85) -> DataFrame:
    """consensus_value (the smallest text), avg_similarity over pairs of lower-case texts, is_consensus. A single text is
    consensus with similarity 0; blank texts are none."""
    texts = long.withColumn("t", F.nullif(F.lower(F.trim("value")), F.lit(""))).filter("t is not null")
    distinct = texts.groupBy(*keys, "t").agg(F.count("*").alias("n"))
    a, b = distinct.alias("a"), distinct.alias("b")
    on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    cross = a.join(b, [*on, F.col("a.t") < F.col("b.t")]).select(*[F.col(f"a.{k}").alias(k) for k in keys], (F.col("a.n") * F.col("b.n")).alias("w"), likeness("a.t", "b.t").alias("sim"))
    diff = cross.groupBy(*keys).agg(F.sum(F.col("w") * F.col("sim")).alias("s"))
    same = distinct.groupBy(*keys).agg(F.sum("n").alias("m"), F.count("*").alias("n_distinct"), F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("eq"), F.min("t").alias("consensus_value"))
    out = same.join(diff, keys, "left").withColumn("avg_similarity", F.when(F.col("m") < 2, 0.0).otherwise((F.col("eq") + F.coalesce("s", F.lit(0.0))) / (F.col("m") * (F.col("m") - 1) / 2)))
    return out.select(*keys, F.col("m").alias("n_texts"), "n_distinct", "consensus_value", "avg_similarity", ((F.col("n_distinct") == 1) | (F.col("avg_similarity") >= alike)).alias("is_consensus"))


def weighted(long: DataFrame, keys: list[str], default: float = 0.5) -> DataFrame:
    """Needs a confidence column. The value with most answers wins, then by mean confidence, then the smallest."""
    v = long.filter("value is not null").groupBy(*keys, "value").agg(F.count("*").alias("n"), F.avg(F.coalesce("confidence", F.lit(default))).alias("c"))
    tot = v.groupBy(*keys).agg(F.sum("n").alias("valid"), F.max(F.struct("n", "c")).alias("b"))
    best = v.join(tot, keys).filter((F.col("n") == F.col("b.n")) & (F.col("c") == F.col("b.c"))).groupBy(*keys).agg(F.min("value").alias("consensus_value"), F.first("c").alias("weighted_confidence"), (F.first("n") / F.first("valid")).alias("agreement_rate"))
    return best.withColumn("is_consensus", F.col("agreement_rate") >= AGREE)


def null_verdict(long: DataFrame, keys: list[str]) -> DataFrame:
    """all_null, majority_null, minority_null or no_null."""
    c = long.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(F.col("value").isNull()).alias("z"))
    return c.select(*keys, F.when(F.col("z") == F.col("n"), "all_null").when(F.col("z") * 2 > F.col("n"), "majority_null").when(F.col("z") > 0, "minority_null").otherwise("no_null").alias("verdict"))
