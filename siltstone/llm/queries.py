"""The queries of the operators on documents, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import consensus, history, leakage, packing, pii
from siltstone.operators.units import posting_key
from siltstone.runtime import Scratch, table

FIELDS = {"work_model": (1, consensus.WORK_MODEL), "seniority_level": (2, consensus.SENIORITY)}


def _fit(spark: SparkSession, d: str, field: str) -> tuple[consensus.Consensus, DataFrame, DataFrame]:
    jobs = table(spark, d, "enriched_jobs")
    pass_num, classes = FIELDS[field]
    scratch = Scratch(spark, f"consensus-{field}")
    vote = scratch.keep(consensus.votes(jobs, field, pass_num, classes), "vote")
    return consensus.fit(vote, list(classes), scratch), vote, jobs


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    out = None
    for field in FIELDS:
        model, _, jobs = _fit(spark, d, field)
        usual = model.items.select(F.posexplode("post").alias("k", "p")).groupBy("k").agg(F.sum("p").alias("n")).orderBy(F.desc("n"), "k").first()
        every = jobs.filter("job_id is not null").select("job_id").distinct().join(model.labels().withColumnRenamed("item", "job_id"), "job_id", "left")
        label = F.coalesce("consensus_label", F.lit(model.classes[usual.k if usual else 0]))
        part = every.select("job_id", F.lit(field).alias("field_name"), label.alias("consensus_label"))
        out = part if out is None else out.unionByName(part)
    return out


def p7_reliability(spark: SparkSession, d: str) -> DataFrame:
    parts = [_fit(spark, d, f)[0].reliability().withColumn("field_name", F.lit(f)) for f in FIELDS]
    return parts[0].unionByName(parts[1])


def p7_agreement(spark: SparkSession, d: str) -> DataFrame:
    jobs = table(spark, d, "enriched_jobs")
    parts = [consensus.krippendorff(consensus.votes(jobs, f, *FIELDS[f])).withColumn("field_name", F.lit(f)) for f in FIELDS]
    return parts[0].unionByName(parts[1])


def _packed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    specs = table(spark, d, "packing_specs")
    scratch = Scratch(spark, "packing")
    sizes = scratch.keep(packing.token_counts(table(spark, d, "documents")), "sizes")
    return packing.pack(sizes, specs, scratch), specs


def p8_pack(spark: SparkSession, d: str) -> DataFrame:
    return _packed(spark, d)[0]


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill(*_packed(spark, d))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaks(table(spark, d, "documents"), table(spark, d, "eval_items")).select("doc_id", "item_id")


def p9_report(spark: SparkSession, d: str) -> DataFrame:
    docs, items = table(spark, d, "documents"), table(spark, d, "eval_items")
    return leakage.answers(leakage.leaks(docs, items), docs, items)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return history.duplicates(table(spark, d, "silver_postings"), "job_description_text", posting_key())


def p4_postings(spark: SparkSession, d: str) -> DataFrame:
    return p4_found(spark, d).groupBy("kept_record_id").agg(F.count("*").alias("n_repeats"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return pii.details(table(spark, d, "documents"))


def p10_redacted(spark: SparkSession, d: str) -> DataFrame:
    return pii.redacted(table(spark, d, "documents"))


QUERIES = {f.__name__: f for f in (p4_found, p4_postings, p7_found, p7_reliability, p7_agreement, p8_pack, p8_fill, p9_found, p9_report, p10_found, p10_redacted)}
ORACLE: dict[str, str] = {}
