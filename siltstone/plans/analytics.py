"""Analytics over Silver and enriched jobs: top-k reports, salary and trend statistics, consensus, agreement, text statistics, gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltstone.operators import gold, reducers
from siltstone.plans.registry import Tables, query

KEY = ["job_id"]

LATEST = """latest as (select * from (select *, row_number() over (partition by job_id, model_name, pass_num order by enriched_at desc, row_id desc) as rn from enriched_jobs) where rn = 1)"""


def latest(t: Tables) -> DataFrame:
    """The newest row of each job, model and pass."""
    e = t.enriched_jobs
    row = F.struct(*e.columns)
    return e.groupBy("job_id", "model_name", "pass_num").agg(F.max_by(row, F.struct("enriched_at", "row_id")).alias("r")).select("r.*")


def answers(t: Tables, pass_num: int, value) -> DataFrame:
    """Long answers of one field: job_id, model, value."""
    return latest(t).filter(F.col("pass_num") == pass_num).select("job_id", F.col("model_name").alias("model"), value.alias("value"))


@query("""with s as (select unnest(skills_canonical) as skill from silver_postings), n as (select count(*) as total from silver_postings) select skill, count(*) as n_jobs, round(count(*) * 100.0 / max(total), 1) as pct from s, n group by 1 order by n_jobs desc, skill limit 20""")
def agg_top_skills(t: Tables) -> DataFrame:
    """AGG-01, JOI-11, JOI-12, SRT-01: the most wanted skills with their share of all postings."""
    total = t.silver_postings.agg(F.count("*").alias("total")).first()["total"]
    s = t.silver_postings.select(F.explode("skills_canonical").alias("skill")).groupBy("skill").agg(F.count("*").alias("n_jobs"))
    return s.select("skill", "n_jobs", F.round(F.col("n_jobs") * 100.0 / total, 1).alias("pct")).orderBy(F.desc("n_jobs"), "skill").limit(20)


@query("""with m(family, skill) as (values ('languages','python'),('languages','scala'),('languages','java'),('languages','rust'),('languages','sql'),('processing','spark'),('processing','flink'),('processing','kafka'),('platform','docker'),('platform','kubernetes'),('platform','terraform'))
  select coalesce(family, 'unknown') as family, count(*) as n from (select unnest(skills_canonical) as skill from silver_postings) left join m using (skill) group by 1""")
def agg_skills_by_family(t: Tables) -> DataFrame:
    """AGG-02, JOI-07: family lookup with a default."""
    fam = {"languages": ["python", "scala", "java", "rust", "sql"], "processing": ["spark", "flink", "kafka"], "platform": ["docker", "kubernetes", "terraform"]}
    m = F.create_map(*[F.lit(x) for f, ss in fam.items() for s in ss for x in (s, f)])
    s = t.silver_postings.select(F.explode("skills_canonical").alias("skill"))
    return s.groupBy(F.coalesce(F.try_element_at(m, F.col("skill")), F.lit("unknown")).alias("family")).agg(F.count("*").alias("n"))


@query("select job_location, country_code, count(*) as n from silver_postings where job_location is not null group by 1, 2 order by n desc, job_location, country_code limit 50")
def agg_jobs_by_location(t: Tables) -> DataFrame:
    """AGG-03."""
    return t.silver_postings.filter("job_location is not null").groupBy("job_location", "country_code").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "job_location", F.asc_nulls_last("country_code")).limit(50)


@query("""select job_seniority_level, salary_currency, count(*) as n, round(avg(salary_min), 2) as avg_min, round(min(salary_min), 2) as lowest, round(max(salary_max), 2) as highest from silver_postings where salary_min is not null and salary_currency in ('USD','EUR','GBP') group by 1, 2""")
def agg_salary_stats(t: Tables) -> DataFrame:
    """AGG-04."""
    s = t.silver_postings.filter(F.col("salary_min").isNotNull() & F.col("salary_currency").isin("USD", "EUR", "GBP"))
    return s.groupBy("job_seniority_level", "salary_currency").agg(F.count("*").alias("n"), F.round(F.avg("salary_min"), 2).alias("avg_min"), F.round(F.min("salary_min"), 2).alias("lowest"), F.round(F.max("salary_max"), 2).alias("highest"))


@query("select cast(ingested_at as date) as day, count(*) as n from silver_postings group by 1 order by 1 desc limit 30")
def agg_daily_trend(t: Tables) -> DataFrame:
    """AGG-05."""
    return t.silver_postings.groupBy(F.to_date("ingested_at").alias("day")).agg(F.count("*").alias("n")).orderBy(F.desc("day")).limit(30)


@query("""select company_name, count(*) as n, array_to_string(list_sort(list(distinct job_seniority_level) filter (where job_seniority_level is not null)), '|') as levels from silver_postings where company_name is not null group by 1 order by n desc, company_name limit 30""")
def agg_top_companies(t: Tables) -> DataFrame:
    """AGG-06."""
    s = t.silver_postings.filter("company_name is not null").groupBy("company_name").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("job_seniority_level")), "|").alias("levels"))
    return s.orderBy(F.desc("n"), "company_name").limit(30)


@query("select job_id, job_title, company_name, count(distinct model_name) as n_models from enriched_jobs where pass_num = 1 group by 1, 2, 3")
def agg_jobs(t: Tables) -> DataFrame:
    """AGG-07, FIL-05."""
    return t.enriched_jobs.filter("pass_num = 1").groupBy("job_id", "job_title", "company_name").agg(F.count_distinct("model_name").alias("n_models"))


@query("select count(*) as n_rows, count(distinct job_id) as n_jobs, array_to_string(list_sort(list(distinct model_name)), '|') as models, count(distinct pass_num) as n_passes from enriched_jobs")
def agg_stats(t: Tables) -> DataFrame:
    """AGG-08."""
    return t.enriched_jobs.agg(F.count("*").alias("n_rows"), F.count_distinct("job_id").alias("n_jobs"), F.array_join(F.array_sort(F.collect_set("model_name")), "|").alias("models"), F.count_distinct("pass_num").alias("n_passes"))


@query("""with s as (select lower(trim(x)) as skill from (select unnest(from_json(must_have_skills_json, '["VARCHAR"]')) as x from enriched_jobs where must_have_skills_json is not null)) select skill, count(*) as n, (select count(distinct skill) from s) as n_unique, (select count(*) from s) as n_all from s group by 1""")
def agg_hard_skills(t: Tables) -> DataFrame:
    """AGG-09, AGG-10, JSN-02."""
    s = t.enriched_jobs.select(F.explode(F.from_json("must_have_skills_json", "array<string>")).alias("x")).groupBy(F.lower(F.trim("x")).alias("skill")).agg(F.count("*").alias("n"))
    tot = s.agg(F.count("*").alias("n_unique"), F.sum("n").alias("n_all")).first()
    return s.select("skill", "n", F.lit(tot.n_unique).cast("bigint").alias("n_unique"), F.lit(tot.n_all or 0).cast("bigint").alias("n_all"))


@query("select pass_num, count(*) as n, sum(tokens) as tokens, round(avg(tokens), 3) as avg_tokens, round(sum(cost_usd) / count(distinct job_id), 6) as cost_per_job from enriched_jobs group by 1")
def agg_passes(t: Tables) -> DataFrame:
    """AGG-11, AGG-43."""
    return t.enriched_jobs.groupBy("pass_num").agg(F.count("*").alias("n"), F.sum("tokens").alias("tokens"), F.round(F.avg("tokens"), 3).alias("avg_tokens"), F.round(F.sum("cost_usd") / F.count_distinct("job_id"), 6).alias("cost_per_job"))


@query(f"""with {LATEST}, a as (select job_id, model_name as model, lower(trim(work_model)) as value from latest where pass_num = 1), c as (select job_id, value, count(*) as n from a where value is not null group by 1, 2),
  b as (select job_id, max(n) as best, sum(n) as valid, -sum(n::double / v * log2(n::double / v)) as entropy from (select *, sum(n) over (partition by job_id) as v from c) group by 1), m as (select c.job_id, min(value) as consensus_value from c join b using (job_id) where n = best group by 1)
  select a.job_id, case when coalesce(any_value(best::double / valid), 0) >= 0.6 then any_value(m.consensus_value) end as consensus_value, round(coalesce(any_value(best::double / valid), 0), 6) as agreement_rate, round(coalesce(any_value(entropy), 0) + 0.0, 6) as entropy, count(*) as n_models,
  array_to_string(coalesce(list_sort(list(model) filter (where value is null or value <> m.consensus_value)), []), '|') as outliers, coalesce(any_value(best::double / valid), 0) >= 0.6 as is_consensus from a left join b using (job_id) left join m using (job_id) group by 1""")
def red_categorical(t: Tables) -> DataFrame:
    """AGG-12."""
    r = reducers.categorical(answers(t, 1, F.lower(F.trim("work_model"))), KEY)
    return r.select("job_id", "consensus_value", F.round("agreement_rate", 6).alias("agreement_rate"), F.round("entropy", 6).alias("entropy"), "n_models", F.array_join("outliers", "|").alias("outliers"), "is_consensus")


@query(f"""with {LATEST}, a as (select job_id, model_name as model, tokens::double as value from latest where pass_num = 1), s as (select job_id, avg(value) as m, median(value) as med, coalesce(stddev_pop(value), 0) as sd, count(*) filter (where value is null) as z, count(*) as n from a group by 1)
  select job_id, round(m, 4) as mean_value, round(med, 4) as median_value, round(any_value(sd), 4) as std, round(case when coalesce(m, 0) = 0 then 0 else any_value(sd) / m end, 6) as cv, n as n_models, array_to_string(coalesce(list_sort(list(model) filter (where z < n and (value is null or (sd > 0 and abs(value - m) / sd > 2)))), []), '|') as outliers,
  case when any_value(z) < n and (case when coalesce(m, 0) = 0 then 0 else any_value(sd) / m end) <= 0.15 and any_value(z) <= 1 then round(med, 4) end as consensus_value,
  any_value(z) = n or ((case when coalesce(m, 0) = 0 then 0 else any_value(sd) / m end) <= 0.15 and any_value(z) <= 1) as is_consensus from a join s using (job_id) group by job_id, m, med, n""")
def red_numeric(t: Tables) -> DataFrame:
    """AGG-13, WIN-08."""
    r = reducers.numeric(answers(t, 1, F.col("tokens").cast("double")), KEY)
    return r.select("job_id", F.round("mean_value", 4).alias("mean_value"), F.round("median_value", 4).alias("median_value"), F.round("std", 4).alias("std"), F.round("cv", 6).alias("cv"), "n_models", F.array_join("outliers", "|").alias("outliers"), F.round("consensus_value", 4).alias("consensus_value"), "is_consensus")


@query(f"""with {LATEST}, a as (select job_id, model_name as model, internal_mobility_mentioned as value from latest where pass_num = 2), c as (select job_id, count(*) filter (where value) as y, count(*) filter (where not value) as f, count(*) as n_models from a group by 1),
  d as (select *, case when y + f > 0 then y >= f end as cv, case when y + f > 0 then greatest(y, f)::double / (y + f) else 0 end as r from c)
  select job_id, case when r >= 0.6 then cv end as consensus_value, round(r, 6) as agreement_rate, n_models, array_to_string(coalesce(list_sort(list(model) filter (where value is null or value <> cv)), []), '|') as outliers, r >= 0.6 as is_consensus from a join d using (job_id) group by job_id, cv, r, n_models""")
def red_boolean(t: Tables) -> DataFrame:
    """AGG-14."""
    r = reducers.boolean(answers(t, 2, F.col("internal_mobility_mentioned")), KEY)
    return r.select("job_id", "consensus_value", F.round("agreement_rate", 6).alias("agreement_rate"), "n_models", F.array_join("outliers", "|").alias("outliers"), "is_consensus")


@query(f"""with {LATEST}, a as (select job_id, model_name as model, list_sort(list_distinct(list_filter(list_transform(coalesce(from_json(must_have_skills_json, '["VARCHAR"]'), []), lambda x: lower(trim(x))), lambda x: x <> ''))) as s from latest where pass_num = 1),
  n as (select job_id, count(*) as n_models, count(*) filter (where len(s) > 0) as filled from a group by 1), i as (select job_id, item, count(*) as c from (select job_id, unnest(s) as item from a) group by 1, 2),
  k as (select i.job_id, coalesce(list_sort(list(item) filter (where c >= 0.5 * n_models)), []) as items, count(*) as n_union, count(*) filter (where c = filled) as n_common from i join n using (job_id) group by 1),
  p as (select x.job_id, avg(case when len(x.s) + len(y.s) = 0 then 1.0 else len(list_intersect(x.s, y.s))::double / len(list_distinct(list_concat(x.s, y.s))) end) as jac from a x join a y on x.job_id = y.job_id and x.model < y.model group by 1)
  select job_id, n_models, array_to_string(coalesce(items, []), '|') as consensus_items, coalesce(n_union, 0) as n_union, coalesce(n_common, 0) as n_common, round(coalesce(jac, 1), 6) as avg_jaccard,
  round(avg(case when len(coalesce(items, [])) > 0 then len(list_intersect(s, items))::double / len(items) when filled = 0 then 1 else 0 end), 6) as avg_core_agreement from a join n using (job_id) left join k using (job_id) left join p using (job_id) group by job_id, n_models, items, n_union, n_common, jac""")
def red_lists(t: Tables) -> DataFrame:
    """AGG-15, SET-05, JOI-10."""
    r = reducers.lists(answers(t, 1, F.from_json("must_have_skills_json", "array<string>")), KEY)
    return r.select("job_id", "n_models", F.array_join("consensus_items", "|").alias("consensus_items"), "n_union", "n_common", F.round("avg_jaccard", 6).alias("avg_jaccard"), F.round("avg_core_agreement", 6).alias("avg_core_agreement"))


@query()
def red_strings(t: Tables) -> DataFrame:
    """AGG-16, STR-12: Ratcliff-Obershelp similarity has no SQL."""
    r = reducers.strings(answers(t, 1, F.col("job_location")), KEY)
    return r.withColumn("avg_similarity", F.round("avg_similarity", 6))


@query(f"""with {LATEST}, a as (select job_id, lower(trim(seniority_level)) as value, (tokens % 100) / 100.0 as confidence from latest where pass_num = 2), v as (select job_id, value, count(*) as n, avg(coalesce(confidence, 0.5)) as c from a where value is not null group by 1, 2),
  r as (select *, row_number() over (partition by job_id order by n desc, round(c, 9) desc, value) as rn, sum(n) over (partition by job_id) as valid from v) select job_id, value as consensus_value, round(n::double / valid, 6) as agreement_rate, n::double / valid >= 0.6 as is_consensus from r where rn = 1""")
def red_weighted(t: Tables) -> DataFrame:
    """AGG-17, AGG-52: count first, then mean confidence."""
    long = latest(t).filter("pass_num = 2").select("job_id", F.col("model_name").alias("model"), F.lower(F.trim("seniority_level")).alias("value"), ((F.col("tokens") % 100) / 100.0).alias("confidence"))
    r = reducers.weighted(long, KEY)
    return r.select("job_id", "consensus_value", F.round("agreement_rate", 6).alias("agreement_rate"), "is_consensus")


@query(f"""with {LATEST}, a as (select job_id, skill_inflation_detected as value from latest where pass_num = 2) select job_id, case when count(value) = 0 then 'all_null' when (count(*) - count(value)) * 2 > count(*) then 'majority_null' when count(value) < count(*) then 'minority_null' else 'no_null' end as verdict from a group by 1""")
def red_nulls(t: Tables) -> DataFrame:
    """AGG-18."""
    return reducers.null_verdict(answers(t, 2, F.col("skill_inflation_detected")), KEY)


AGREE = f"""{LATEST}, a as (select job_id, 'work_model' as field, model_name as model, lower(trim(work_model)) as value from latest where pass_num = 1 union all select job_id, 'seniority_level', model_name, lower(trim(seniority_level)) from latest where pass_num = 2),
  c as (select job_id, field, value, count(*) as n from a where value is not null group by 1, 2, 3), b as (select job_id, field, max(n) as best, sum(n) as valid from c group by 1, 2), m as (select c.job_id, c.field, min(value) as mode from c join b using (job_id, field) where n = best group by 1, 2),
  e as (select a.*, m.mode, coalesce(best::double / valid, 0) as rate from a left join b using (job_id, field) left join m using (job_id, field))"""


def agreement(t: Tables) -> DataFrame:
    """AGG-19: every model's answer beside its field's consensus: job_id, field, model, value, mode, rate."""
    l = latest(t)  # noqa: E741
    a = l.filter("pass_num = 1").select("job_id", F.lit("work_model").alias("field"), F.col("model_name").alias("model"), F.lower(F.trim("work_model")).alias("value"))
    a = a.unionByName(l.filter("pass_num = 2").select("job_id", F.lit("seniority_level").alias("field"), F.col("model_name").alias("model"), F.lower(F.trim("seniority_level")).alias("value")))
    r = reducers.categorical(a, ["job_id", "field"]).select("job_id", "field", "mode", F.col("agreement_rate").alias("rate"))
    return a.join(r, ["job_id", "field"])


@query(f"""with {AGREE} select model, count(*) as n_fields, count(*) filter (where value = mode and rate >= 0.6) as n_matches, round(avg(case when value is null or value <> mode then 1.0 else 0.0 end), 6) as outlier_rate,
  round((avg(case when value = mode and rate >= 0.6 then 1.0 else 0.0 end) * 0.6 + (1 - avg(case when value is null or value <> mode then 1.0 else 0.0 end)) * 0.4) * 100, 4) as score from e group by 1""")
def agg_model_performance(t: Tables) -> DataFrame:
    """AGG-20, AGG-22, AGG-31: matches, outliers and score per model."""
    e = agreement(t)
    hit = F.coalesce((F.col("value") == F.col("mode")) & (F.col("rate") >= 0.6), F.lit(False)).cast("int")
    out = F.coalesce(F.col("value").isNull() | (F.col("value") != F.col("mode")), F.lit(False)).cast("int")
    return e.groupBy("model").agg(F.count("*").alias("n_fields"), F.sum(hit).alias("n_matches"), F.round(F.avg(out), 6).alias("outlier_rate"), F.round((F.avg(hit) * 0.6 + (1 - F.avg(out)) * 0.4) * 100, 4).alias("score"))


@query(f"""with {AGREE}, f as (select distinct job_id, field, rate from e) select field, count(*) as n, count(*) filter (where rate >= 0.6) as n_consensus, round(avg(rate), 6) as avg_rate, case when avg(rate) >= 0.9 then 'Low' when avg(rate) >= 0.7 then 'Medium' else 'High' end as gap, round(count(*)::double / sum(count(*)) over (), 6) as weight from f group by 1""")
def agg_by_field(t: Tables) -> DataFrame:
    """AGG-23, AGG-26, AGG-32, FIL-13."""
    f = agreement(t).select("job_id", "field", "rate").distinct().groupBy("field").agg(F.count("*").alias("n"), F.count_if(F.col("rate") >= 0.6).alias("n_consensus"), F.avg("rate").alias("r"))
    total = F.sum("n").over(W.partitionBy())
    return f.select("field", "n", "n_consensus", F.round("r", 6).alias("avg_rate"), F.when(F.col("r") >= 0.9, "Low").when(F.col("r") >= 0.7, "Medium").otherwise("High").alias("gap"), F.round(F.col("n") / total, 6).alias("weight"))


@query(f"""with {AGREE} select job_id, round(avg(rate), 6) as overall_rate, round(max(case when field = 'work_model' then rate end), 6) as pass1_rate, round(max(case when field = 'seniority_level' then rate end), 6) as pass2_rate, array_to_string(coalesce(list_sort(list(field) filter (where rate < 0.5)), []), '|') as disagreements from (select distinct job_id, field, rate from e) group by 1""")
def agg_job_consensus(t: Tables) -> DataFrame:
    """AGG-21, AGG-27."""
    f = agreement(t).select("job_id", "field", "rate").distinct()
    of = lambda x: F.round(F.max(F.when(F.col("field") == x, F.col("rate"))), 6)
    return f.groupBy("job_id").agg(F.round(F.avg("rate"), 6).alias("overall_rate"), of("work_model").alias("pass1_rate"), of("seniority_level").alias("pass2_rate"), F.array_join(F.array_sort(F.collect_list(F.when(F.col("rate") < 0.5, F.col("field")))), "|").alias("disagreements"))


@query(f"""with {AGREE} select model, round(avg(case when field = 'work_model' then case when value = mode then 1.0 else 0.0 end end), 6) as work_model, round(avg(case when field = 'seniority_level' then case when value = mode then 1.0 else 0.0 end end), 6) as seniority_level from e where rate >= 0.6 and value is not null group by 1""")
def agg_fit_matrix(t: Tables) -> DataFrame:
    """AGG-24: model by field."""
    e = agreement(t).filter("rate >= 0.6 and value is not null").withColumn("hit", (F.col("value") == F.col("mode")).cast("int"))
    m = e.groupBy("model").pivot("field", ["work_model", "seniority_level"]).agg(F.avg("hit"))
    return m.select("model", F.round("work_model", 6).alias("work_model"), F.round("seniority_level", 6).alias("seniority_level"))


@query(f"""with {AGREE}, s as (select field, model, avg(case when value = mode and rate >= 0.6 then 1.0 else 0.0 end) as r from e group by 1, 2), k as (select *, row_number() over (partition by field order by round(r, 9) desc, model) as rn from s) select field, model as best_model, round(r, 6) as rate from k where rn = 1""")
def agg_best_model(t: Tables) -> DataFrame:
    """AGG-25, SRT-10: the best per field, ties by name."""
    hit = F.coalesce((F.col("value") == F.col("mode")) & (F.col("rate") >= 0.6), F.lit(False)).cast("int")
    s = agreement(t).groupBy("field", "model").agg(F.avg(hit).alias("r"))
    best = s.groupBy("field").agg(F.max(F.round("r", 9)).alias("top"))
    return s.join(best, "field").filter(F.round("r", 9) == F.col("top")).groupBy("field").agg(F.min("model").alias("best_model"), F.round(F.max("r"), 6).alias("rate"))


@query(f"""with {AGREE}, j as (select job_id, model, avg(case when value = mode then 1.0 else 0.0 end) as r from e group by 1, 2) select model, count(*) as n_jobs, round(avg(r), 6) as macro_rate from j group by 1""")
def agg_macro_performance(t: Tables) -> DataFrame:
    """AGG-28: the mean of each job's rate."""
    j = agreement(t).groupBy("job_id", "model").agg(F.avg(F.coalesce(F.col("value") == F.col("mode"), F.lit(False)).cast("int")).alias("r"))
    return j.groupBy("model").agg(F.count("*").alias("n_jobs"), F.round(F.avg("r"), 6).alias("macro_rate"))


@query(f"""with {AGREE}, o as (select field, model, count(*) as n from e where value is null or value <> mode group by 1, 2), k as (select *, row_number() over (partition by field order by n desc, model) as rn from o) select field, model as common_outlier, n from k where rn = 1""")
def agg_common_outlier(t: Tables) -> DataFrame:
    """AGG-29."""
    o = agreement(t).filter("value is null or value <> mode").groupBy("field", "model").agg(F.count("*").alias("n"))
    top = o.groupBy("field").agg(F.max("n").alias("n"))
    return o.join(top, ["field", "n"]).groupBy("field", "n").agg(F.min("model").alias("common_outlier")).select("field", "common_outlier", "n")


@query(f"""with {AGREE} select x.model as model_a, y.model as model_b, count(*) as n_both, round(avg(case when x.value = y.value then 1.0 else 0.0 end), 6) as agree from e x join e y on x.job_id = y.job_id and x.field = y.field and x.model < y.model group by 1, 2""")
def agg_agreement_matrix(t: Tables) -> DataFrame:
    """AGG-30, JOI-10: pairs of models; as many pairs per job as models squared."""
    e = agreement(t).select("job_id", "field", "model", "value")
    a, b = e.alias("a"), e.alias("b")
    j = a.join(b, (F.col("a.job_id") == F.col("b.job_id")) & (F.col("a.field") == F.col("b.field")) & (F.col("a.model") < F.col("b.model")))
    return j.groupBy(F.col("a.model").alias("model_a"), F.col("b.model").alias("model_b")).agg(F.count("*").alias("n_both"), F.round(F.avg(F.coalesce(F.col("a.value") == F.col("b.value"), F.lit(False)).cast("int")), 6).alias("agree"))


@query("select round(corr(tokens, cost_usd), 6) as r, count(*) as n from enriched_jobs where tokens is not null and cost_usd is not null")
def agg_pearson(t: Tables) -> DataFrame:
    """AGG-33."""
    return t.enriched_jobs.filter("tokens is not null and cost_usd is not null").agg(F.round(F.corr("tokens", "cost_usd"), 6).alias("r"), F.count("*").alias("n"))


@query("select round(avg(n), 6) as mean_n, median(n) as median_n, min(n) as min_n, max(n) as max_n, round(stddev_samp(n), 6) as sd, round(100.0 * count(*) filter (where n > 0) / count(*), 4) as coverage from (select coalesce(len(skills_canonical), 0)::int as n from silver_postings)")
def agg_skills_per_posting(t: Tables) -> DataFrame:
    """AGG-34, AGG-40."""
    s = t.silver_postings.select(F.coalesce(F.array_size("skills_canonical"), F.lit(0)).alias("n"))
    return s.agg(F.round(F.avg("n"), 6).alias("mean_n"), F.median("n").alias("median_n"), F.min("n").alias("min_n"), F.max("n").alias("max_n"), F.round(F.stddev_samp("n"), 6).alias("sd"), F.round(100.0 * F.count_if(F.col("n") > 0) / F.count("*"), 4).alias("coverage"))


@query("""with s as (select record_id, unnest(skills_canonical) as s from silver_postings) select a.s as skill_a, b.s as skill_b, count(*) as n from s a join s b on a.record_id = b.record_id and a.s < b.s group by 1, 2 order by n desc, 1, 2 limit 15""")
def agg_skill_pairs(t: Tables) -> DataFrame:
    """AGG-35: pairs within each row's short list, without a self-join."""
    s = F.array_sort(F.array_distinct("skills_canonical"))
    pairs = F.flatten(F.transform(s, lambda x: F.transform(F.filter(s, lambda y: y > x), lambda y: F.struct(x.alias("skill_a"), y.alias("skill_b")))))
    return t.silver_postings.select(F.explode(pairs).alias("p")).groupBy("p.skill_a", "p.skill_b").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "skill_a", "skill_b").limit(15)


@query("""with s as (select distinct record_id, unnest(skills_canonical) as s from silver_postings), f as (select s from s group by 1 having count(*) >= 5), g as (select s.* from s join f using (s)) select a.s || '+' || b.s || '+' || c.s || '+' || d.s || '+' || e.s as combo, count(*) as n from g a join g b on a.record_id = b.record_id and a.s < b.s join g c on c.record_id = a.record_id and b.s < c.s
  join g d on d.record_id = a.record_id and c.s < d.s join g e on e.record_id = a.record_id and d.s < e.s group by 1 order by n desc, combo limit 10""")
def agg_skill_fives(t: Tables) -> DataFrame:
    """AGG-36: groups of five within a row, of skills that are frequent enough to matter."""
    rows = t.silver_postings.select("record_id", F.explode(F.array_distinct("skills_canonical")).alias("s"))
    often = rows.groupBy("s").agg(F.count("*").alias("n")).filter("n >= 5").select("s")
    sets = rows.join(often, "s").groupBy("record_id").agg(F.array_sort(F.collect_list("s")).alias("s")).filter("size(s) >= 5")
    combos = F.transform("s", lambda x: F.array(x))
    for _ in range(4):
        prev = combos
        combos = F.flatten(F.transform(prev, lambda c: F.transform(F.filter("s", lambda y: y > F.element_at(c, -1)), lambda y: F.concat(c, F.array(y)))))
    return sets.select(F.explode(combos).alias("c")).groupBy(F.array_join("c", "+").alias("combo")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "combo").limit(10)


TFIDF = """w as (select record_id, unnest(regexp_extract_all(lower(job_title), '[a-z0-9]+')) as term from silver_postings where job_title is not null), l as (select record_id, count(*) as len from w group by 1), c as (select record_id, term, count(*) as n from w group by 1, 2), d as (select term, count(*) as df, sum(n) as n_all from c group by 1), k as (select count(*) as docs from l)"""


@query(f"""with {TFIDF} select c.term, any_value(df) as df, any_value(n_all)::bigint as n, round(sum(c.n::double / len * ln(docs::double / df)), 5) as tfidf from c join l using (record_id) join d using (term), k group by 1""")
def agg_tfidf(t: Tables) -> DataFrame:
    """AGG-37: term frequency times inverse document frequency, summed over documents."""
    w = t.silver_postings.filter("job_title is not null").select("record_id", F.regexp_extract_all(F.lower("job_title"), F.lit("([a-z0-9]+)"), 1).alias("w")).filter("size(w) > 0")
    docs = w.count()
    c = w.select("record_id", F.size("w").alias("len"), F.explode("w").alias("term")).groupBy("record_id", "len", "term").agg(F.count("*").alias("n"))
    d = c.groupBy("term").agg(F.count("*").alias("df"), F.sum("n").alias("n"), F.sum(F.col("n") / F.col("len")).alias("tf"))
    return d.select("term", "df", "n", F.round(F.col("tf") * F.log(F.lit(float(docs)) / F.col("df")), 5).alias("tfidf"))


@query(f"""with {TFIDF}, i as (select term, ln((1 + docs)::double / (1 + df)) + 1 as idf from d, k where df >= 2 and df <= 0.8 * docs), x as (select c.record_id, term, c.n * idf as v from c join i using (term)), z as (select record_id, sqrt(sum(v * v)) as norm from x group by 1) select term, round(sum(v / norm), 4) as weight, count(*) as n_docs from x join z using (record_id) group by 1""")
def agg_tfidf_normed(t: Tables) -> DataFrame:
    """AGG-38, AGG-39: smoothed weights, document-normed, with bounds on document frequency."""
    w = t.silver_postings.filter("job_title is not null").select("record_id", F.regexp_extract_all(F.lower("job_title"), F.lit("([a-z0-9]+)"), 1).alias("w")).filter("size(w) > 0")
    docs = w.count()
    c = w.select("record_id", F.explode("w").alias("term")).groupBy("record_id", "term").agg(F.count("*").alias("n"))
    i = c.groupBy("term").agg(F.count("*").alias("df")).filter((F.col("df") >= 2) & (F.col("df") <= 0.8 * docs)).select("term", (F.log(F.lit(1.0 + docs) / (1 + F.col("df"))) + 1).alias("idf"))
    x = c.join(i, "term").select("record_id", "term", (F.col("n") * F.col("idf")).alias("v"))
    z = x.groupBy("record_id").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm"))
    return x.join(z, "record_id").groupBy("term").agg(F.round(F.sum(F.col("v") / F.col("norm")), 4).alias("weight"), F.count("*").alias("n_docs"))


@query("select 'company_id' as field, round(100.0 * count(company_id) / count(*), 4) as pct from silver_postings union all select 'salary_min', round(100.0 * count(salary_min) / count(*), 4) from silver_postings union all select 'job_location', round(100.0 * count(job_location) / count(*), 4) from silver_postings union all select 'job_summary', round(100.0 * count(job_summary) / count(*), 4) from silver_postings")
def agg_coverage(t: Tables) -> DataFrame:
    """AGG-42: shares of filled fields, in one pass."""
    cols = ["company_id", "salary_min", "job_location", "job_summary"]
    one = t.silver_postings.agg(*[F.round(100.0 * F.count(c) / F.count("*"), 4).alias(c) for c in cols])
    return one.unpivot([], cols, "field", "pct")


@query("select cast(max(written_at) as date) as newest, count(*) as n, count(*) filter (where json_valid(payload)) as n_success, count(*) filter (where not json_valid(payload)) as n_failed from pass_results")
def agg_batch_status(t: Tables) -> DataFrame:
    """AGG-44, AGG-46."""
    ok = F.try_parse_json("payload").isNotNull()
    return t.pass_results.agg(F.to_date(F.max("written_at")).alias("newest"), F.count("*").alias("n"), F.count_if(ok).alias("n_success"), F.count_if(~ok).alias("n_failed"))


@query("""select country_code, salary_currency, count(*) as n, round(quantile_cont(salary_min, 0.1), 3) as p10, round(quantile_cont(salary_min, 0.25), 3) as p25, round(quantile_cont(salary_min, 0.5), 3) as p50, round(quantile_cont(salary_min, 0.75), 3) as p75, round(quantile_cont(salary_min, 0.9), 3) as p90 from silver_postings where salary_min is not null and salary_period = 'yearly' group by 1, 2""")
def agg_salary_benchmark(t: Tables) -> DataFrame:
    """AGG-47."""
    s = t.silver_postings.filter("salary_min is not null and salary_period = 'yearly'").groupBy("country_code", "salary_currency").agg(F.count("*").alias("n"), F.percentile("salary_min", F.array(*map(F.lit, (0.1, 0.25, 0.5, 0.75, 0.9)))).alias("p"))
    return s.select("country_code", "salary_currency", "n", *[F.round(F.get("p", F.lit(i)), 3).alias(f"p{q}") for i, q in enumerate((10, 25, 50, 75, 90))])


@query("""with s as (select cast(date_trunc('week', ingested_at) as date) as week, unnest(skills_canonical) as skill from silver_postings), c as (select week, skill, count(*) as n from s group by 1, 2) select week, skill, n, rank() over (partition by week order by n desc) as demand_rank, (n - sum(n) over (partition by skill order by week range between interval 28 days preceding and interval 28 days preceding))::bigint as growth_4 from c""")
def agg_skill_demand(t: Tables) -> DataFrame:
    """AGG-48, AGG-49: weekly demand, its rank, and growth against four weeks before, null where there was none."""
    c = t.silver_postings.select(F.to_date(F.date_trunc("week", "ingested_at")).alias("week"), F.explode("skills_canonical").alias("skill")).groupBy("week", "skill").agg(F.count("*").alias("n"))
    return c.select("week", "skill", "n", F.rank().over(W.partitionBy("week").orderBy(F.desc("n"))).alias("demand_rank"), (F.col("n") - F.sum("n").over(W.partitionBy("skill").orderBy(F.unix_date("week")).rangeBetween(-28, -28))).alias("growth_4"))


@query("""with h as (select hour(ingested_at) as hour, isodow(ingested_at) as dow, count(*) as n from silver_postings group by 1, 2) select hour, dow, n, round(100.0 * n / sum(n) over (), 5) as pct, ntile(5) over (order by n desc, hour, dow) as fifth from h""")
def agg_posting_hours(t: Tables) -> DataFrame:
    """AGG-50: at most 168 rows are ranked together."""
    h = t.silver_postings.groupBy(F.hour("ingested_at").alias("hour"), (F.weekday("ingested_at") + 1).alias("dow")).agg(F.count("*").alias("n"))
    return h.select("hour", "dow", "n", F.round(100.0 * F.col("n") / F.sum("n").over(W.partitionBy()), 5).alias("pct"), F.ntile(5).over(W.orderBy(F.desc("n"), "hour", "dow")).alias("fifth"))


@query("select record_id from (select record_id, unnest(skills_canonical) as s from silver_postings) where s in ('python', 'sql', 'spark') group by 1 having count(distinct s) = 3")
def agg_skill_combo(t: Tables) -> DataFrame:
    """AGG-51: rows that have all of three skills."""
    return t.silver_postings.filter(F.size(F.array_intersect("skills_canonical", F.array(*map(F.lit, ("python", "sql", "spark"))))) == 3).select("record_id")


@query("""select strftime(ingested_at, '%Y-%m') as month, count(*) as n, count(distinct company_id) as n_companies, round(100.0 * count(salary_min) / count(*), 4) as transparency, round(count(*)::double / greatest(1, count(distinct company_id)), 4) as per_company from silver_postings group by 1""")
def agg_kpis(t: Tables) -> DataFrame:
    """AGG-53."""
    return t.silver_postings.groupBy(F.date_format("ingested_at", "yyyy-MM").alias("month")).agg(F.count("*").alias("n"), F.count_distinct("company_id").alias("n_companies"), F.round(100.0 * F.count("salary_min") / F.count("*"), 4).alias("transparency"), F.round(F.count("*") / F.greatest(F.lit(1), F.count_distinct("company_id")), 4).alias("per_company"))


@query("""select file_id, round(avg(c), 3) as avg_confidence, count(*) filter (where c < 0.5) as n_low from (select file_id, unnest([try_cast(payload->>'$.growth_path_clarity.confidence' as double), try_cast(payload->>'$.internal_mobility_mentioned.confidence' as double), try_cast(payload->>'$.career_tracks_json.confidence' as double)]) as c from enriched_feed) where c > 0 group by 1""")
def agg_confidence(t: Tables) -> DataFrame:
    """AGG-54."""
    c = F.array(*[F.get_json_object("payload", f"$.{f}.confidence").try_cast("double") for f in ("growth_path_clarity", "internal_mobility_mentioned", "career_tracks_json")])
    e = t.enriched_feed.select("file_id", F.explode(c).alias("c")).filter("c > 0")
    return e.groupBy("file_id").agg(F.round(F.avg("c"), 3).alias("avg_confidence"), F.count_if(F.col("c") < 0.5).alias("n_low"))


@query("select strftime(d, '%Y%m%d')::int as date_key, cast(d as date) as full_date, year(d) as year, quarter(d) as quarter, month(d) as month, isodow(d) as day_of_week, isodow(d) > 5 as is_weekend from (select unnest(generate_series(timestamp '2024-10-01', timestamp '2025-12-31', interval 1 day)) as d)")
def gld_dim_date(t: Tables) -> DataFrame:
    """Gold: the date dimension."""
    return gold.dim_date(t.spark, "2024-10-01", "2025-12-31")


@query("select record_id, strftime(ingested_at, '%Y%m%d')::int as date_key, md5(coalesce(trim(company_id), 'unknown')) as company_key, md5(coalesce(job_location, 'unknown') || '|' || coalesce(country_code, 'unknown')) as location_key, round(salary_min, 2)::decimal(12,2)::varchar as salary_min, len(coalesce(skills_canonical, []))::int as n_skills from silver_postings")
def gld_fact(t: Tables) -> DataFrame:
    """Gold: the fact table."""
    return gold.fact_postings(t.silver_postings)


@query("select record_id, s as skill, row_number() over (partition by record_id order by s) as position from (select distinct record_id, unnest(skills_canonical) as s from silver_postings)")
def gld_skill_bridge(t: Tables) -> DataFrame:
    """Gold: the bridge of postings and skills."""
    return gold.skill_bridge(t.silver_postings)


@query("""select f.month, c.country_code, count(*) as n from (select strftime(ingested_at, '%Y-%m') as month, trim(company_id) as company_id from silver_postings) f join companies c on c.company_id = f.company_id group by 1, 2""")
def joi_star(t: Tables) -> DataFrame:
    """JOI-14: the fact with a dimension, aggregated before the join."""
    f = t.silver_postings.groupBy(F.date_format("ingested_at", "yyyy-MM").alias("month"), F.trim("company_id").alias("company_id")).agg(F.count("*").alias("n"))
    return f.join(t.companies.select("company_id", "country_code"), "company_id").groupBy("month", "country_code").agg(F.sum("n").alias("n"))


@query("""select 'salary_order' as rule, count(*) filter (where salary_min > salary_max) as n_bad from silver_postings union all select 'future_ingest', count(*) filter (where ingested_at > timestamp '2026-01-01') from silver_postings union all select 'unique_key', count(*) - count(distinct record_id) from silver_postings union all select 'company_missing', count(*) filter (where trim(s.company_id) is not null and c.company_id is null) from silver_postings s left join companies c on c.company_id = trim(s.company_id)""")
def gld_quality(t: Tables) -> DataFrame:
    """Gold: quality checks."""
    return gold.quality(t.silver_postings, t.companies)


@query("select l.job_location, w.work_model from (select distinct job_location from silver_postings where job_location is not null) l, (values ('remote'), ('hybrid'), ('onsite')) w(work_model)")
def joi_cross(t: Tables) -> DataFrame:
    """JOI-13: every location with every work model, by exploding a fixed list."""
    return t.silver_postings.filter("job_location is not null").select("job_location").distinct().select("job_location", F.explode(F.array(*map(F.lit, ("remote", "hybrid", "onsite")))).alias("work_model"))


@query("""select row_id, case lower(trim(work_model)) when 'on-site' then 'onsite' when 'on_site' then 'onsite' when 'on site' then 'onsite' when 'fully remote' then 'remote' else lower(trim(work_model)) end as work_model from enriched_jobs where pass_num = 1""")
def joi_synonyms(t: Tables) -> DataFrame:
    """JOI-08, STR-03: synonyms by a map, else the value itself."""
    m = F.create_map(*[F.lit(x) for kv in {"on-site": "onsite", "on_site": "onsite", "on site": "onsite", "fully remote": "remote"}.items() for x in kv])
    v = F.lower(F.trim("work_model"))
    return t.enriched_jobs.filter("pass_num = 1").select("row_id", F.coalesce(F.try_element_at(m, v), v).alias("work_model"))


@query("""with v as (select vec_id, label, embedding from embeddings), n as (select vec_id, label, sqrt(list_sum(list_transform(embedding, lambda x: x::double * x::double))) as norm from v) select label, count(*) as n, round(avg(norm), 4) as avg_norm from n group by 1""")
def ml_embedding_norms(t: Tables) -> DataFrame:
    """ML-02: vector arithmetic on arrays."""
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    return t.embeddings.groupBy("label").agg(F.count("*").alias("n"), F.round(F.avg(norm), 4).alias("avg_norm"))


@query()
def ml_term_classes(t: Tables) -> DataFrame:
    """ML-01: a logistic model on character n-grams that tells technical terms from others; scores every word."""
    return gold.term_scores(t.silver_postings)


@query("""select l_returnflag, l_linestatus, round(sum(l_quantity), 2) as sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue, count(*) as n from lineitem where l_shipdate <= timestamp '1998-09-02' group by 1, 2""")
def tpc_pricing_summary(t: Tables) -> DataFrame:
    """A scan with pushed filter and pruned columns, aggregated map-side."""
    bound = F.expr("timestamp_ntz'1998-09-02 00:00:00'") if dict(t.lineitem.dtypes)["l_shipdate"] == "timestamp_ntz" else F.expr("timestamp'1998-09-02 00:00:00'")
    return t.lineitem.filter(F.col("l_shipdate") <= bound).groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count("*").alias("n"))


@query("""select user_id, window_start, n from (select user_id, strftime(time_bucket(interval 1 day, ts), '%Y-%m-%d') as window_start, count(*) as n from events group by 1, 2)""")
def stm_daily_windows(t: Tables) -> DataFrame:
    """STM-01 in batch: tumbling windows of the event stream."""
    return t.events.groupBy("user_id", F.window("ts", "1 day").alias("w")).agg(F.count("*").alias("n")).select("user_id", F.date_format("w.start", "yyyy-MM-dd").alias("window_start"), "n")


@query(f"""with {AGREE} select model, field, case field when 'work_model' then 1 else 2 end as pass_num, count(*) as n, count(*) filter (where value is null or value <> mode) as n_outliers from e group by 1, 2""")
def agg_outliers(t: Tables) -> DataFrame:
    """AGG-31: outliers by model, field and pass."""
    e = agreement(t)
    out = F.coalesce(F.col("value").isNull() | (F.col("value") != F.col("mode")), F.lit(False))
    return e.groupBy("model", "field").agg(F.count("*").alias("n"), F.count_if(out).alias("n_outliers")).withColumn("pass_num", F.when(F.col("field") == "work_model", 1).otherwise(2))


@query(f"""with {AGREE}, f as (select distinct job_id, field, rate from e), j as (select job_id, avg(rate) as r from f group by 1) select case when r >= 0.8 then 'high' when r >= 0.6 then 'medium' else 'low' end as level, count(*) as n_jobs, round(avg(r), 6) as mean_rate, round(min(r), 6) as least_rate, round(max(r), 6) as most_rate from j group by 1""")
def agg_consensus_levels(t: Tables) -> DataFrame:
    """AGG-27: the distribution of jobs' consensus rates."""
    j = agreement(t).select("job_id", "field", "rate").distinct().groupBy("job_id").agg(F.avg("rate").alias("r"))
    level = F.when(F.col("r") >= 0.8, "high").when(F.col("r") >= 0.6, "medium").otherwise("low")
    return j.groupBy(level.alias("level")).agg(F.count("*").alias("n_jobs"), F.round(F.avg("r"), 6).alias("mean_rate"), F.round(F.min("r"), 6).alias("least_rate"), F.round(F.max("r"), 6).alias("most_rate"))


@query("""with w as (select record_id, list_filter(regexp_split_to_array(trim(regexp_replace(lower(job_title), '[^a-z0-9]+', ' ', 'g')), ' '), lambda x: x not in ('the', 'and', 'of', 'for', 'in', 'a', 'to', 'with', '')) as w from silver_postings where job_title is not null),
  n as (select unnest(range(1, 6)) as n), g as (select distinct record_id, n.n, unnest(list_transform(range(1, len(w) - n.n + 2), lambda i: array_to_string(w[i:i + n.n - 1], ' '))) as gram from w, n where len(w) >= n.n),
  d as (select n, gram, count(*) as n_docs from g group by 1, 2), t as (select count(*) as docs from w), s as (select n, gram, n_docs, round(ln((1 + docs)::double / (1 + n_docs)) + 1, 6) as idf from d, t), r as (select *, row_number() over (partition by n order by n_docs desc, gram) as rank_in_n from s where idf between 1.5 and 5.0)
  select n, gram, n_docs, idf, rank_in_n from r where rank_in_n <= 40""")
def win_top_ngrams(t: Tables) -> DataFrame:
    """WIN-07, AGG-38, AGG-39, STR-06: runs of one to five words without stop words, within a band of document frequency, the top forty of each length."""
    words = F.filter(F.split(F.trim(F.regexp_replace(F.lower("job_title"), "[^a-z0-9]+", " ")), " "), lambda x: ~x.isin("the", "and", "of", "for", "in", "a", "to", "with", ""))
    s = t.silver_postings.filter("job_title is not null").select(words.alias("w"))
    docs = s.count()
    runs = lambda n: F.when(F.size("w") >= n, F.transform(F.array_distinct(F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.array_join(F.slice("w", i, n), " "))), lambda g: F.struct(F.lit(n).cast("bigint").alias("n"), g.alias("gram"))))
    every = F.flatten(F.array_compact(F.array(*[runs(n) for n in range(1, 6)])))
    d = s.select(F.inline(every)).groupBy("n", "gram").agg(F.count("*").alias("n_docs")).withColumn("idf", F.round(F.log(F.lit(1.0 + docs) / (1 + F.col("n_docs"))) + 1, 6)).filter("idf between 1.5 and 5.0")
    return d.withColumn("rank_in_n", F.row_number().over(W.partitionBy("n").orderBy(F.desc("n_docs"), "gram")).cast("bigint")).filter("rank_in_n <= 40")


@query("""with s as (select pass_file_id, json_extract_string(payload, '$.metadata.model_id') as model, json_extract_string(payload, '$.metadata.job_posting_id') as job, written_at from pass_results where json_valid(payload)) select model, job, count(*) as n_files, max(written_at) as newest from s group by 1, 2""")
def src_model_outputs(t: Tables) -> DataFrame:
    """SRC-17, SRC-18: model outputs by job and model, with the metadata that is there."""
    g = lambda p: F.get_json_object("payload", p)
    s = t.pass_results.filter(F.try_parse_json("payload").isNotNull()).select(g("$.metadata.model_id").alias("model"), g("$.metadata.job_posting_id").alias("job"), "written_at")
    return s.groupBy("model", "job").agg(F.count("*").alias("n_files"), F.max("written_at").alias("newest"))


@query("""with g as (select country_code, count(*) as n from silver_postings group by 1), s as (select *, (sum(n) over ())::bigint as total, count(*) over () as n_groups from g) select country_code, n, total, n_groups from s order by n desc, country_code limit 3""")
def srt_slice(t: Tables) -> DataFrame:
    """SRT-03, SRT-08, SRT-09: a slice of sorted groups; the totals are of all groups and not computed anew."""
    g = t.silver_postings.groupBy("country_code").agg(F.count("*").alias("n"))
    w = W.partitionBy()  # over one row per country
    return g.select("country_code", "n", F.sum("n").over(w).alias("total"), F.count("*").over(w).alias("n_groups")).orderBy(F.desc("n"), F.asc_nulls_last("country_code")).limit(3)
