"""Gold tables: dimensions, fact, bridge, quality checks, and the term classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def dim_date(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per day."""
    d = F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("full_date")
    wd = F.weekday("full_date") + 1
    return spark.range(1).select(d).select(
        F.date_format("full_date", "yyyyMMdd").cast("int").alias("date_key"), "full_date", F.year("full_date").alias("year"), F.quarter("full_date").alias("quarter"), F.month("full_date").alias("month"), wd.alias("day_of_week"), (wd > 5).alias("is_weekend")
    )


def fact_postings(silver: DataFrame) -> DataFrame:
    """One row per posting record with surrogate keys; missing members map to "unknown"."""
    u = lambda c: F.coalesce(c, F.lit("unknown"))
    return silver.select(
        "record_id", F.date_format("ingested_at", "yyyyMMdd").cast("int").alias("date_key"), F.md5(u(F.trim("company_id"))).alias("company_key"), F.md5(F.concat_ws("|", u(F.col("job_location")), u(F.col("country_code")))).alias("location_key"),
        F.round("salary_min", 2).cast("decimal(12,2)").cast("string").alias("salary_min"), F.coalesce(F.array_size("skills_canonical"), F.lit(0)).alias("n_skills"),
    )


def skill_bridge(silver: DataFrame) -> DataFrame:
    """One row per posting and distinct skill, in order."""
    return silver.select("record_id", F.posexplode(F.array_sort(F.array_distinct("skills_canonical"))).alias("p", "skill")).select("record_id", "skill", (F.col("p") + 1).alias("position"))


def quality(silver: DataFrame, companies: DataFrame) -> DataFrame:
    """Rows that break each rule; unique keys are counted by a group-by, not gathered."""
    one = silver.agg(F.count_if(F.col("salary_min") > F.col("salary_max")).alias("salary_order"), F.count_if(F.col("ingested_at") > F.lit("2026-01-01").cast("timestamp")).alias("future_ingest"))
    a = one.unpivot([], ["salary_order", "future_ingest"], "rule", "n_bad")
    b = silver.groupBy("record_id").agg((F.count("*") - 1).alias("x")).agg(F.lit("unique_key").alias("rule"), F.sum("x").alias("n_bad"))
    c = silver.select(F.trim("company_id").alias("company_id")).filter("company_id is not null").join(companies.select("company_id"), "company_id", "left_anti").agg(F.lit("company_missing").alias("rule"), F.count("*").alias("n_bad"))
    return a.unionByName(b).unionByName(c)


def profile_changes(versions: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """Slowly changing dimension: spans of equal values per key."""
    w = W.partitionBy(key).orderBy(at)
    v = versions.withColumn("_prev", F.lag(value).over(w)).filter(F.col("_prev").isNull() | (F.col("_prev") != F.col(value)))
    return v.select(key, value, F.col(at).alias("effective_start"), F.lead(at).over(w).alias("effective_end"))


def term_scores(silver: DataFrame) -> DataFrame:
    """(term, n, tech_prob): a balanced logistic regression on hashed character n-grams of two to five letters, trained
    on the tagged skills against other words of titles, applied to every distinct word."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import IDF, HashingTF

    skills = silver.select(F.explode("skills_canonical").alias("term")).filter("term is not null").groupBy("term").agg(F.count("*").alias("n")).withColumn("label", F.lit(1.0))
    words = silver.select(F.explode(F.regexp_extract_all(F.lower("job_title"), F.lit("([a-z]{3,})"), 1)).alias("term")).groupBy("term").agg(F.count("*").alias("n")).withColumn("label", F.lit(0.0))
    terms = skills.unionByName(words.join(skills.select("term"), "term", "left_anti"))
    padded = F.concat(F.lit(" "), F.col("term"), F.lit(" "))
    grams = F.flatten(F.array(*[F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(padded) - n + 1)), lambda i, n=n: F.substring(padded, i, F.lit(n))) for n in (2, 3, 4, 5)]))
    hashed = HashingTF(inputCol="grams", outputCol="tf", numFeatures=4096).transform(terms.withColumn("grams", grams))
    tfidf = IDF(inputCol="tf", outputCol="features").fit(hashed).transform(hashed)
    share = tfidf.agg(F.avg("label")).first()[0] or 0.5
    weighted = tfidf.withColumn("w", F.when(F.col("label") == 1, 1 - share).otherwise(share))
    model = LogisticRegression(maxIter=20, regParam=0.01, weightCol="w").fit(weighted)
    from pyspark.ml.functions import vector_to_array

    return model.transform(tfidf).select("term", "n", F.round(F.get(vector_to_array("probability"), F.lit(1)), 4).alias("tech_prob"))


def enum_dimension(df: DataFrame, field: str) -> DataFrame:
    """(key, value): the distinct values of a field with few values, numbered in order."""
    v = df.select(F.col(field).alias("value")).filter("value is not null").distinct()
    return v.select(F.row_number().over(W.orderBy("value")).alias("key"), "value")


def dim_location(silver: DataFrame) -> DataFrame:
    """One row per place and country."""
    u = lambda c: F.coalesce(F.col(c), F.lit("unknown"))
    d = silver.select(u("job_location").alias("job_location"), u("country_code").alias("country_code")).distinct()
    return d.select(F.md5(F.concat_ws("|", "job_location", "country_code")).alias("location_key"), "job_location", "country_code", F.get(F.split("job_location", ","), F.lit(0)).alias("city"))


def dim_time(spark: SparkSession) -> DataFrame:
    """One row per hour."""
    h = F.col("id").cast("int")
    part = F.when(h < 6, "night").when(h < 12, "morning").when(h < 18, "afternoon").otherwise("evening")
    return spark.range(24).select(h.alias("hour"), part.alias("part_of_day"), h.between(9, 17).alias("is_business"))


def clusters(vectors: DataFrame, k: int, seed: int = 7) -> DataFrame:
    """(vec_id, cluster) by k-means over unit vectors; null and empty vectors are left out."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import Normalizer
    from pyspark.ml.functions import array_to_vector

    rows = vectors.filter(F.size("embedding") > 0).select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("raw"))
    unit = Normalizer(inputCol="raw", outputCol="features").transform(rows)
    return KMeans(k=k, seed=seed, maxIter=20).fit(unit).transform(unit).select("vec_id", F.col("prediction").alias("cluster"))


def pearson(df: DataFrame, a: str, b: str) -> DataFrame:
    """r, n and the two-sided p-value by the normal limit of Fisher's transformation; null where r can't be told."""
    s = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).agg(F.corr(a, b).alias("r"), F.count("*").alias("n"))
    z = F.abs(F.atanh("r")) * F.sqrt(F.greatest(F.col("n") - 3, F.lit(0)))
    # complementary error function of z / sqrt(2), a rational approximation good to 1.2e-7
    x = z / 2**0.5
    t = 1 / (1 + 0.5 * x)
    poly = F.lit(0.17087277)
    for c in (-0.82215223, 1.48851587, -1.13520398, 0.27886807, -0.18628806, 0.09678418, 0.37409196, 1.00002368, -1.26551223):
        poly = poly * t + c
    return s.select(F.round("r", 6).alias("r"), "n", F.when(F.abs("r") < 1, F.round(t * F.exp(-x * x + poly), 9)).alias("p_value"))
