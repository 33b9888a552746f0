"""The calls of a query service as functions that give tables: jobs, statistics, comparisons, skills, search, pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltstone.operators import gold
from siltstone.plans.registry import Tables, query


def conditions(filters: dict) -> Column:
    """A filter of a dict: plain values are equal, {"contains"}, {"starts_with"}, {"min"}, {"max"} and {"has_all"} as they say."""
    out = []
    for name, want in filters.items():
        c = F.col(name)
        if not isinstance(want, dict):
            out.append(c == want)
            continue
        out += [c.contains(want["contains"])] if "contains" in want else []
        out += [c.startswith(want["starts_with"])] if "starts_with" in want else []
        out += [c >= want["min"]] if "min" in want else []
        out += [c <= want["max"]] if "max" in want else []
        out += [F.array_contains(c, x) for x in want.get("has_all", [])]
    return reduce(lambda a, b: a & b, out, F.lit(True))


def search_jobs(silver: DataFrame, filters: dict, after: int | None, size: int) -> DataFrame:
    """A page of matching postings by keyset: the rows after an id, one more than a page where there is another."""
    df = silver.filter(conditions(filters))
    df = df.filter(F.col("record_id") > after) if after is not None else df
    return df.orderBy("record_id").limit(size + 1)


def compare_models(jobs: DataFrame, job_id: int) -> DataFrame:
    """The models' answers for one job, side by side."""
    return jobs.filter(F.col("job_id") == job_id).groupBy("model_name").agg(F.max("work_model").alias("work_model"), F.max("seniority_level").alias("seniority_level"), F.sum("tokens").alias("tokens"))


def jobs_with_skill(silver: DataFrame, skill: str) -> DataFrame:
    """Postings that ask for a skill."""
    return silver.filter(F.array_contains("skills_canonical", skill)).select("record_id", "job_title", "company_name")


@query("select record_id, job_title from silver_postings where country_code = 'DE' and job_title like '%Engineer%' and job_num_applicants >= 3 and record_id > 100 order by record_id limit 26")
def api_search(t: Tables) -> DataFrame:
    """API-02, SRT-11."""
    return search_jobs(t.silver_postings, {"country_code": "DE", "job_title": {"contains": "Engineer"}, "job_num_applicants": {"min": 3}}, 100, 25).select("record_id", "job_title")


@query("select model_name, max(work_model) as work_model, max(seniority_level) as seniority_level, sum(tokens)::bigint as tokens from enriched_jobs where job_id = (select min(job_id) from enriched_jobs) group by 1")
def api_compare_models(t: Tables) -> DataFrame:
    """API-01."""
    first = t.enriched_jobs.agg(F.min("job_id")).first()[0]
    return compare_models(t.enriched_jobs, first if first is not None else -1)


@query("select record_id, job_title, company_name from silver_postings where list_contains(skills_canonical, 'kafka')")
def api_jobs_with_skill(t: Tables) -> DataFrame:
    """API-01."""
    return jobs_with_skill(t.silver_postings, "kafka")


@query("""with s as (select strftime(ingested_at, '%Y-%m') as month, unnest(skills_canonical) as skill from silver_postings), c as (select month, skill, count(*) as n from s group by 1, 2), r as (select *, n - lag(n) over (partition by skill order by month) as change from c)
  select month, skill, n, change from (select *, row_number() over (partition by month order by change desc, skill) as rn from r where change is not null) where rn <= 5""")
def api_trending_skills(t: Tables) -> DataFrame:
    """API-02: the five skills that grew most each month."""
    c = t.silver_postings.select(F.date_format("ingested_at", "yyyy-MM").alias("month"), F.explode("skills_canonical").alias("skill")).groupBy("month", "skill").agg(F.count("*").alias("n"))
    r = c.withColumn("change", F.col("n") - F.lag("n").over(W.partitionBy("skill").orderBy("month"))).filter("change is not null")
    return r.withColumn("rn", F.row_number().over(W.partitionBy("month").orderBy(F.desc("change"), "skill"))).filter("rn <= 5").drop("rn")


@query("""select c.company_id, c.company_name, count(*) as n_postings, count(distinct s.job_location) as n_locations, round(100.0 * count(s.salary_min) / count(*), 4) as pay_stated from companies c join silver_postings s on trim(s.company_id) = c.company_id group by 1, 2""")
def api_company_insights(t: Tables) -> DataFrame:
    """API-02."""
    s = t.silver_postings.filter("company_id is not null").withColumn("company_id", F.trim("company_id"))
    a = s.groupBy("company_id").agg(F.count("*").alias("n_postings"), F.count_distinct("job_location").alias("n_locations"), F.round(100.0 * F.count("salary_min") / F.count("*"), 4).alias("pay_stated"))
    return a.join(t.companies.select("company_id", "company_name"), "company_id").select("company_id", "company_name", "n_postings", "n_locations", "pay_stated")


@query("select row_number() over (order by v) as key, v as value from (select distinct job_seniority_level as v from silver_postings where job_seniority_level is not null)")
def gld_dim_seniority(t: Tables) -> DataFrame:
    """Gold: a static dimension; its members are the few values of a field."""
    return gold.enum_dimension(t.silver_postings, "job_seniority_level")


@query("select md5(coalesce(job_location, 'unknown') || '|' || coalesce(country_code, 'unknown')) as location_key, coalesce(job_location, 'unknown') as job_location, coalesce(country_code, 'unknown') as country_code, split_part(coalesce(job_location, 'unknown'), ',', 1) as city from (select distinct job_location, country_code from silver_postings)")
def gld_dim_location(t: Tables) -> DataFrame:
    """Gold: locations with the keys of the fact."""
    return gold.dim_location(t.silver_postings)


@query("select h as hour, case when h < 6 then 'night' when h < 12 then 'morning' when h < 18 then 'afternoon' else 'evening' end as part_of_day, h between 9 and 17 as is_business from (select unnest(range(0, 24))::int as h)")
def gld_dim_time(t: Tables) -> DataFrame:
    """Gold: hours of a day."""
    return gold.dim_time(t.spark)


@query("select record_id, row_id, field, answer from (select s.record_id, e.row_id, unnest(['work_model', 'seniority_level']) as field, unnest([e.work_model, e.seniority_level]) as answer from silver_postings s join enriched_jobs e on s.job_posting_id = e.job_id::varchar) where answer is not null")
def gld_answers_long(t: Tables) -> DataFrame:
    """Gold: answers as entity, attribute and value."""
    e = t.enriched_jobs.withColumn("job_posting_id", F.col("job_id").cast("string"))
    return t.silver_postings.select("record_id", "job_posting_id").join(e, "job_posting_id").unpivot(["record_id", "row_id"], ["work_model", "seniority_level"], "field", "answer").filter("answer is not null")


@query()
def ml_clusters(t: Tables) -> DataFrame:
    """ML-02: k-means over embeddings, seeded; cluster ids have no SQL."""
    return gold.clusters(t.embeddings, 8)


@query()
def agg_pearson_p(t: Tables) -> DataFrame:
    """AGG-33: Pearson's r with its two-sided p-value."""
    return gold.pearson(t.enriched_jobs, "tokens", "cost_usd")
