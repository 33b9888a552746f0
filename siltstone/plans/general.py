"""The queries of the general data-preparation operators: p1, p2, p3, p5 and p6."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators import drift, instants, nested, once, units
from siltstone.runtime import Scratch, table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return units.yearly_usd(table(spark, d, "silver_postings"), table(spark, d, "fx_rates"), table(spark, d, "pay_periods"))[0]


def p1_notations(spark: SparkSession, d: str) -> DataFrame:
    return units.yearly_usd(table(spark, d, "silver_postings"), table(spark, d, "fx_rates"), table(spark, d, "pay_periods"))[1]


def _instants(spark: SparkSession, d: str) -> DataFrame:
    feeds = table(spark, d, "source_feeds")
    silver = instants.normalise_fields(table(spark, d, "silver_postings"), "record_id", ["scraped_at", "job_posted_datetime"], feeds)
    return silver.unionByName(instants.normalise_fields(table(spark, d, "bronze_records"), "bronze_id", ["ts_text"], feeds))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _instants(spark, d).filter("utc_us is not null").select("record_id", "field_name", "utc_us")


def p2_coverage(spark: SparkSession, d: str) -> DataFrame:
    shape = F.regexp_replace(F.regexp_replace("text", "[0-9]+", "9"), "[A-Za-z_]+", "A")
    return _instants(spark, d).groupBy("field_name", shape.alias("shape")).agg(F.count("*").alias("n_rows"), F.count("utc_us").alias("n_instants"))


def _messages(spark: SparkSession, d: str) -> once.MessageStore:
    return once.run_batches(table(spark, d, "company_messages"), table(spark, d, "companies"), Scratch(spark, "once").root)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _messages(spark, d).surplus()


def p3_winners(spark: SparkSession, d: str) -> DataFrame:
    return _messages(spark, d).winners().select("delivery_id", "message_key", "received_at")


def _schemas(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    scratch = Scratch(spark, "drift")
    lines = scratch.keep(drift.entries(table(spark, d, "enriched_feed")), "entries")
    schemas = scratch.keep(drift.file_schemas(lines), "schemas")
    return lines, schemas, scratch.keep(drift.changes(schemas), "changes")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _schemas(spark, d)[2].select("file_id", "field_name", "change_kind")


def p5_unified(spark: SparkSession, d: str) -> DataFrame:
    lines, schemas, found = _schemas(spark, d)
    return drift.unified(lines, drift.canonical_names(found, schemas))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return nested.pass_items(table(spark, d, "pass_results"), Scratch(spark, "nested"))


def p6_skills(spark: SparkSession, d: str) -> DataFrame:
    rows = nested.grouped(table(spark, d, "pass_results"), "pass_file_id", "payload", nested.PASS_ARRAYS, r"must_have_skills\[\](?:\.[^\[\]]*)?$")
    out = nested.pivot(rows, "result.extraction.skills_classified.must_have_skills[]", {"skill": "skill", "years": "years"})
    return out.select(F.col("record_id").alias("pass_file_id"), F.element_at("ordinals", -1).alias("pos"), "skill", "years")


def p6_tables(spark: SparkSession, d: str) -> DataFrame:
    """The flat tables that the records come out as: one row per repeated ancestor, with its parent, rows and columns."""
    rows = Scratch(spark, "nested").keep(nested.grouped(table(spark, d, "pass_results"), "pass_file_id", "payload", nested.PASS_ARRAYS), "grouped")
    one = rows.groupBy("grp").agg(F.count("*").alias("n_rows"), F.count_distinct("record_id").alias("n_records"))
    leaves = rows.select("grp", F.explode(F.map_keys("fields")).alias("leaf")).groupBy("grp").agg(F.count_distinct("leaf").alias("n_columns"))
    parent = F.regexp_replace(F.regexp_replace("grp", r"\[\]$", ""), r"[^\[\]]*$", "")
    return one.join(leaves, "grp", "left").select("grp", parent.alias("parent"), "n_rows", "n_records", F.coalesce("n_columns", F.lit(0)).alias("n_columns"))


QUERIES = {f.__name__: f for f in (p1_found, p1_notations, p2_found, p2_coverage, p3_found, p3_winners, p5_found, p5_unified, p6_found, p6_skills, p6_tables)}
ORACLE = {
    "p3_found": """with m as (select delivery_id, received_at, regexp_replace(trim(company_id), '\\.0$', '') as cid, regexp_extract(lower(company_url), '/company/([^/?#]+)', 1) as slug, epoch_us(try_cast(first_seen_at as timestamptz)) as moment from company_messages),
  c as (select company_id, regexp_extract(lower(linkedin_url), '/company/([^/?#]+)', 1) as slug from companies), k as (select m.delivery_id, m.received_at, m.moment, coalesce(m.cid, c.company_id, m.slug) as co from m left join c on c.slug = m.slug)
  select delivery_id from (select delivery_id, row_number() over (partition by co, moment order by received_at, delivery_id) as rn from k) where rn > 1""",
}
