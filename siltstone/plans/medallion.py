"""Bronze to Silver: scans, projections, coercions, filters, key joins, deduplication and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltstone.functions import coerce, flatten as flat, text
from siltstone.functions.json_repair import repair_json
from siltstone.functions.skills import DEFAULT, detect, flatten, match_terms
from siltstone.plans.registry import Tables, query

PID = r"regexp_replace(trim(job_posting_id), '^urn:boards:jobPosting:', '')"


@query("select source_system, count(*) filter (where job_posting_id is not null) as n_valid, count(*) filter (where job_posting_id is null) as n_error from bronze_records group by 1")
def src_error_split(t: Tables) -> DataFrame:
    """SRC-01, FIL-01: valid rows have a posting id, the rest are crawl errors."""
    return t.bronze_records.groupBy("source_system").agg(F.count("job_posting_id").alias("n_valid"), F.count_if(F.col("job_posting_id").isNull()).alias("n_error"))


@query("select bronze_id, error_code, md5(coalesce(input_url, '')) as url_key from bronze_records where job_posting_id is null")
def fil_crawl_errors(t: Tables) -> DataFrame:
    """FIL-01: the error partition."""
    return t.bronze_records.filter("job_posting_id is null").select("bronze_id", "error_code", F.md5(F.coalesce("input_url", F.lit(""))).alias("url_key"))


@query("""select bronze_id, trim(job_posting_id) as job_posting_id, trim(company_name) as company_name, base_salary.min_amount as salary_min, base_salary.max_amount as salary_max,
  base_salary.currency as salary_currency, base_salary.payment_period as salary_period, try_cast(trim(company_id) as double)::bigint as company_number from bronze_records where job_posting_id is not null""")
def prj_bronze_to_silver(t: Tables) -> DataFrame:
    """PRJ-01, PRJ-05, PRJ-19: one projection with nested access and safe casts."""
    return t.bronze_records.filter("job_posting_id is not null").select(
        "bronze_id", F.trim("job_posting_id").alias("job_posting_id"), F.trim("company_name").alias("company_name"), F.col("base_salary.min_amount").alias("salary_min"), F.col("base_salary.max_amount").alias("salary_max"),
        F.col("base_salary.currency").alias("salary_currency"), F.col("base_salary.payment_period").alias("salary_period"), coerce.whole(F.trim("company_id")).alias("company_number"),
    )


@query("select doc_id, trim(regexp_replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '[ \\t\\n\\f\\r]+', ' ', 'g')) as clean_text from documents")
def prj_html_to_text(t: Tables) -> DataFrame:
    """PRJ-03."""
    return t.documents.select("doc_id", text.html_to_text(F.col("text")).alias("clean_text"))


@query("""select record_id, strftime(ingested_at, '%Y') as year, strftime(ingested_at, '%m') as month, strftime(ingested_at, '%d') as day, strftime(ingested_at, '%H') as hour from silver_postings""")
def prj_partition_columns(t: Tables) -> DataFrame:
    """PRJ-04, PRJ-28: zero-padded partition columns."""
    ts = F.col("ingested_at")
    return t.silver_postings.select("record_id", *[F.lpad(f(ts).cast("string"), n, "0").alias(c) for c, f, n in (("year", F.year, 4), ("month", F.month, 2), ("day", F.dayofmonth, 2), ("hour", F.hour, 2))])


@query("""select line_id, case json_type(payload, '$.internal_mobility_mentioned') when 'BOOLEAN' then (payload->>'$.internal_mobility_mentioned') = 'true'
  when 'VARCHAR' then lower(trim(payload->>'$.internal_mobility_mentioned')) in ('true', 'yes', '1') when 'UBIGINT' then (payload->>'$.internal_mobility_mentioned') <> '0'
  when 'BIGINT' then (payload->>'$.internal_mobility_mentioned') <> '0' when 'OBJECT' then true when 'ARRAY' then json_array_length(payload, '$.internal_mobility_mentioned') > 0 end as mentioned from enriched_feed""")
def prj_loose_bool(t: Tables) -> DataFrame:
    """PRJ-12: polymorphic values read for their truth."""
    v = F.variant_get(F.try_parse_json("payload"), "$.internal_mobility_mentioned", "variant")
    return t.enriched_feed.select("line_id", coerce.loose_bool(F.to_json(v)).alias("mentioned"))


@query("""select line_id, case payload->>'$.skill_inflation_detected' when 'true' then true when 'false' then false end as strict_flag from enriched_feed""")
def prj_strict_bool(t: Tables) -> DataFrame:
    """PRJ-09."""
    return t.enriched_feed.select("line_id", coerce.strict_bool(F.get_json_object("payload", "$.skill_inflation_detected")).alias("strict_flag"))


@query("""select line_id, coalesce(try_cast(payload->>'$.growth_path_clarity.confidence' as double), -1) as confidence, coalesce(payload->>'$.growth_path_clarity.value', payload->>'$.growth_path_clarity') as clarity from enriched_feed""")
def prj_poly_object(t: Tables) -> DataFrame:
    """PRJ-08, PRJ-10, JSN-01: a value, or the value within an object."""
    g = lambda p: F.get_json_object("payload", p)
    return t.enriched_feed.select("line_id", F.coalesce(g("$.growth_path_clarity.confidence").try_cast("double"), F.lit(-1.0)).alias("confidence"), F.coalesce(g("$.growth_path_clarity.value"), g("$.growth_path_clarity")).alias("clarity"))


@query("""select row_id, len(list_filter(list_transform(case when starts_with(trim(career_tracks_json), '[') then from_json(career_tracks_json, '["VARCHAR"]') else string_split(career_tracks_json, ',') end, lambda x: trim(x)), lambda x: x is not null and x <> '')) as n_tracks,
  array_to_string(list_filter(list_transform(case when starts_with(trim(career_tracks_json), '[') then from_json(career_tracks_json, '["VARCHAR"]') else string_split(career_tracks_json, ',') end, lambda x: trim(x)), lambda x: x is not null and x <> ''), '|') as tracks from enriched_jobs where career_tracks_json is not null""")
def prj_get_array(t: Tables) -> DataFrame:
    """PRJ-15: JSON arrays and comma lists alike."""
    got = coerce.items(F.col("career_tracks_json"))
    return t.enriched_jobs.filter("career_tracks_json is not null").select("row_id", F.size(got).cast("bigint").alias("n_tracks"), F.array_join(got, "|").alias("tracks"))


@query("select record_id, try_cast(nullif(trim(translate(salary_currency, ',$€£', '')), '') as double) as as_number, nullif(trim(salary_currency), '') as as_text from silver_postings where salary_currency is not null")
def prj_number_text(t: Tables) -> DataFrame:
    """PRJ-13, PRJ-14."""
    c = F.col("salary_currency")
    return t.silver_postings.filter(c.isNotNull()).select("record_id", coerce.number(c).alias("as_number"), coerce.text(c).alias("as_text"))


@query("""select company_id, company_name, country_code, try_cast(replace(regexp_extract(company_size, '^([0-9,]+)', 1), ',', '') as int) as size_from, followers, case when founded_year is not null then 2025 - founded_year end as age_years,
  followers >= 10000 as is_popular, headquarters is not null and country_code is not null as has_place, regexp_extract(linkedin_url, '/company/([^/?]+)', 1) as slug from companies""")
def prj_company(t: Tables) -> DataFrame:
    """PRJ-24: the company projection with derived values."""
    return t.companies.select(
        "company_id", "company_name", "country_code", F.replace(F.regexp_extract("company_size", "^([0-9,]+)", 1), F.lit(","), F.lit("")).try_cast("int").alias("size_from"), "followers",
        (F.lit(2025) - F.col("founded_year")).alias("age_years"), (F.col("followers") >= 10000).alias("is_popular"), (F.col("headquarters").isNotNull() & F.col("country_code").isNotNull()).alias("has_place"),
        F.regexp_extract("linkedin_url", "/company/([^/?]+)", 1).alias("slug"),
    )


@query("select doc_id, case when length(coalesce(text, 'N/A')) > 300 then left(coalesce(text, 'N/A'), 300) || '... [TRUNCATED]' else coalesce(text, 'N/A') end as prompt_text from documents")
def prj_prompt(t: Tables) -> DataFrame:
    """PRJ-29: default and truncation of prompt parts."""
    return t.documents.select("doc_id", coerce.prompt(F.col("text"), 300).alias("prompt_text"))


@query("""select model_name, replace(split_part(model_name, ':', 1), '.', '-') as short_name, sum(tokens) as tokens, round(sum(tokens / 1000.0 * case when model_name like '%mini%' then 0.0002 when model_name like '%-4b' then 0.0001 else 0.0006 end), 6) as list_cost, round(sum(cost_usd), 4) as cost_usd from enriched_jobs group by 1, 2""")
def prj_model_cost(t: Tables) -> DataFrame:
    """PRJ-26, PRJ-32: short names and price lookup with a default."""
    price = F.when(F.col("model_name").contains("mini"), 0.0002).when(F.col("model_name").endswith("-4b"), 0.0001).otherwise(0.0006)
    return t.enriched_jobs.groupBy("model_name", coerce.short_model(F.col("model_name")).alias("short_name")).agg(F.sum("tokens").alias("tokens"), F.round(F.sum(F.col("tokens") / 1000.0 * price), 6).alias("list_cost"), F.round(F.sum("cost_usd"), 4).alias("cost_usd"))


@query("select source_system, lower(replace(source_system, ' ', '-')) || '-' || lower(country_code) as source_id, format('https://{}.example/jobs?country={}', source_system, country_code) as url from source_feeds")
def prj_source_url(t: Tables) -> DataFrame:
    """PRJ-30."""
    return t.source_feeds.select("source_system", F.concat_ws("-", F.lower(F.replace("source_system", F.lit(" "), F.lit("-"))), F.lower("country_code")).alias("source_id"), F.format_string("https://%s.example/jobs?country=%s", "source_system", "country_code").alias("url"))


@query("""select row_id, coalesce(work_model, '-') as work_model, coalesce(seniority_level, '-') as seniority, case when internal_mobility_mentioned then 'Yes' when not internal_mobility_mentioned then 'No' else '-' end as mobility from enriched_jobs""")
def prj_comparison(t: Tables) -> DataFrame:
    """PRJ-33."""
    return t.enriched_jobs.select("row_id", F.coalesce("work_model", F.lit("-")).alias("work_model"), F.coalesce("seniority_level", F.lit("-")).alias("seniority"), F.when(F.col("internal_mobility_mentioned"), "Yes").when(~F.col("internal_mobility_mentioned"), "No").otherwise("-").alias("mobility"))


@query("""select job_id, model_name, pass_num, work_model, seniority_level from (select job_id, model_name, 1 as pass_num, work_model, null as seniority_level from enriched_jobs where pass_num = 1
  union all select job_id, model_name, 2, null, seniority_level from enriched_jobs where pass_num = 2)""")
def set_union_passes(t: Tables) -> DataFrame:
    """PRJ-07, SET-02: passes united by name, missing columns null."""
    e = t.enriched_jobs
    one = e.filter("pass_num = 1").select("job_id", "model_name", F.lit(1).alias("pass_num"), "work_model")
    two = e.filter("pass_num = 2").select("job_id", "model_name", F.lit(2).alias("pass_num"), "seniority_level")
    return one.unionByName(two, allowMissingColumns=True).select("job_id", "model_name", "pass_num", "work_model", "seniority_level")


@query("select cast(ingested_at as date) as day, count(*) as n from silver_postings where cast(ingested_at as date) between date '2025-02-01' and date '2025-03-31' group by 1")
def fil_date_range(t: Tables) -> DataFrame:
    """FIL-02, FIL-04: a range of days, pushed down as instants."""
    s = t.silver_postings.filter("ingested_at >= timestamp_ntz'2025-02-01 00:00:00' and ingested_at < timestamp_ntz'2025-04-01 00:00:00'" if dict(t.silver_postings.dtypes)["ingested_at"] == "timestamp_ntz" else "ingested_at >= timestamp'2025-02-01 00:00:00' and ingested_at < timestamp'2025-04-01 00:00:00'")
    return s.groupBy(F.to_date("ingested_at").alias("day")).agg(F.count("*").alias("n"))


@query("select record_id from silver_postings where cast(ingested_at as date) >= (select max(cast(ingested_at as date)) from silver_postings) - interval 30 day")
def fil_lookback(t: Tables) -> DataFrame:
    """FIL-06: the last thirty days before the newest."""
    s = t.silver_postings
    newest = s.agg(F.max(F.to_date("ingested_at"))).first()[0]  # one value
    return s.filter(F.to_date("ingested_at") >= F.date_sub(F.lit(newest).cast("date"), 30)).select("record_id")


@query("select delivery_id from company_messages where coalesce(company_id, company_url) is not null and msg_source = 'job_ingestion'")
def fil_has_company(t: Tables) -> DataFrame:
    """FIL-07, FIL-14."""
    return t.company_messages.filter(F.coalesce("company_id", "company_url").isNotNull() & (F.col("msg_source") == "job_ingestion")).select("delivery_id")


@query("select company_id, (snapshot_date + interval 180 day)::date as next_refresh, followers is null or date '2025-12-15' >= (snapshot_date + interval 180 day)::date as needs_refresh from companies")
def fil_needs_refresh(t: Tables) -> DataFrame:
    """FIL-09, STM-05: refresh after 180 days, or where the fetch gave nothing."""
    due = F.date_add("snapshot_date", 180)
    return t.companies.select("company_id", due.alias("next_refresh"), (F.col("followers").isNull() | (F.lit("2025-12-15").cast("date") >= due)).alias("needs_refresh"))


@query("""with p as (select job_id, model_name, max(case when pass_num = 1 then 1 else 0 end) as p1, max(case when pass_num = 2 then 1 else 0 end) as p2 from enriched_jobs group by 1, 2)
  select job_id, model_name, p1 = 1 as may_run_pass2, p1 = 1 and p2 = 1 as may_run_pass3 from p""")
def fil_pass_gate(t: Tables) -> DataFrame:
    """FIL-10: a pass needs those before it."""
    p = t.enriched_jobs.groupBy("job_id", "model_name").agg(F.max((F.col("pass_num") == 1).cast("int")).alias("p1"), F.max((F.col("pass_num") == 2).cast("int")).alias("p2"))
    return p.select("job_id", "model_name", (F.col("p1") == 1).alias("may_run_pass2"), ((F.col("p1") == 1) & (F.col("p2") == 1)).alias("may_run_pass3"))


@query("""select 'work_model' as field, count(*) filter (where pass_num = 1) as n_rows, count(*) filter (where pass_num = 1 and work_model is not null and lower(trim(work_model)) not in ('', '-', '[]', 'not_mentioned', 'none', 'n/a')) as n_populated from enriched_jobs
  union all select 'seniority_level', count(*) filter (where pass_num = 2), count(*) filter (where pass_num = 2 and seniority_level is not null and lower(trim(seniority_level)) not in ('', '-', '[]', 'not_mentioned', 'none', 'n/a')) from enriched_jobs""")
def fil_populated(t: Tables) -> DataFrame:
    """FIL-12, AGG-42."""
    e = t.enriched_jobs
    one = lambda f, p: e.filter(F.col("pass_num") == p).agg(F.lit(f).alias("field"), F.count("*").alias("n_rows"), F.count_if(coerce.populated(F.col(f))).alias("n_populated"))
    return one("work_model", 1).unionByName(one("seniority_level", 2))


@query("select record_id from silver_postings where regexp_matches(job_summary, '(?i)(^|[^A-Za-z0-9_])pipelines([^A-Za-z0-9_]|$)') and regexp_matches(job_summary, '(?i)(^|[^A-Za-z0-9_])team([^A-Za-z0-9_]|$)')")
def fil_all_words(t: Tables) -> DataFrame:
    """FIL-16."""
    return t.silver_postings.filter(text.has_words(F.col("job_summary"), ["pipelines", "team"])).select("record_id")


@query("select record_id, country_code, job_title from silver_postings where country_code = 'US' and contains(job_title, 'Engineer') and starts_with(job_title, 'Senior') and list_has_all(skills_canonical, ['python', 'sql']) and job_num_applicants >= 5")
def fil_where_builder(t: Tables) -> DataFrame:
    """FIL-17: equality, containment, prefix, bound and array conditions."""
    c = F.col
    cond = (c("country_code") == "US") & c("job_title").contains("Engineer") & c("job_title").startswith("Senior") & (c("job_num_applicants") >= 5)
    for s in ("python", "sql"):
        cond = cond & F.array_contains("skills_canonical", s)
    return t.silver_postings.filter(cond).select("record_id", "country_code", "job_title")


@query("""select row_id, array_to_string(list_filter([case when pass_num not in (1, 2, 3) then 'bad pass' end, case when tokens < 0 or tokens is null then 'bad tokens' end, case when pass_num = 1 and work_model is null then 'no work model' end,
  case when pass_num = 2 and seniority_level is null then 'no seniority' end, case when cost_usd < 0 then 'bad cost' end], lambda x: x is not null), '; ') as errors from enriched_jobs""")
def fil_validators(t: Tables) -> DataFrame:
    """FIL-18: all rule violations of a row."""
    c = F.col
    rules = [(~c("pass_num").isin(1, 2, 3), "bad pass"), ((c("tokens") < 0) | c("tokens").isNull(), "bad tokens"), ((c("pass_num") == 1) & c("work_model").isNull(), "no work model"), ((c("pass_num") == 2) & c("seniority_level").isNull(), "no seniority"), (c("cost_usd") < 0, "bad cost")]
    return t.enriched_jobs.select("row_id", F.concat_ws("; ", *[F.when(r, m) for r, m in rules]).alias("errors"))


@query("""select distinct strftime(ingested_at, '%Y-%m-%d') as day from silver_postings where strftime(ingested_at, '%Y-%m-%d') not in (select strftime(written_at, '%Y-%m-%d') from pass_results where written_at is not null)""")
def joi_partition_diff(t: Tables) -> DataFrame:
    """JOI-01, SET-04, SET-07: partitions of one layer that the next lacks."""
    day = lambda df, c: df.select(F.date_format(c, "yyyy-MM-dd").alias("day")).distinct()
    return day(t.silver_postings, "ingested_at").join(day(t.pass_results, "written_at"), "day", "left_anti")


@query("""select distinct strftime(ingested_at, '%Y-%m-%d') as day from silver_postings where strftime(ingested_at, '%Y-%m-%d') in (select strftime(written_at, '%Y-%m-%d') from pass_results)""")
def joi_partition_common(t: Tables) -> DataFrame:
    """JOI-03."""
    day = lambda df, c: df.select(F.date_format(c, "yyyy-MM-dd").alias("day")).distinct()
    return day(t.silver_postings, "ingested_at").join(day(t.pass_results, "written_at"), "day", "left_semi")


@query("select bronze_id from bronze_records b where not exists (select 1 from silver_postings s where s.job_posting_id = b.job_posting_id)")
def joi_unprocessed(t: Tables) -> DataFrame:
    """JOI-02: rows whose id was never processed; null ids survive."""
    return t.bronze_records.join(t.silver_postings.select("job_posting_id").distinct(), "job_posting_id", "left_anti").select("bronze_id")


@query("""select e.row_id, coalesce(s.source_system, 'linkedin') as source_system from enriched_jobs e left join (select job_posting_id, min(source_system) as source_system from silver_postings group by 1) s on s.job_posting_id = cast(e.job_id as varchar)""")
def joi_source_lookup(t: Tables) -> DataFrame:
    """JOI-04: a lookup with a default."""
    s = t.silver_postings.groupBy("job_posting_id").agg(F.min("source_system").alias("source_system"))
    e = t.enriched_jobs.withColumn("job_posting_id", F.col("job_id").cast("string"))
    return e.join(s, "job_posting_id", "left").select("row_id", F.coalesce("source_system", F.lit("linkedin")).alias("source_system"))


@query("""with a as (select job_id, model_name, max(work_model) as work_model from enriched_jobs where pass_num = 1 group by 1, 2), b as (select job_id, model_name, max(seniority_level) as seniority_level from enriched_jobs where pass_num = 2 group by 1, 2)
  select a.job_id, a.model_name, a.work_model, b.seniority_level from a left join b on a.job_id = b.job_id and a.model_name = b.model_name""")
def joi_passes(t: Tables) -> DataFrame:
    """JOI-05: pass 1 required, pass 2 optional."""
    e, on = t.enriched_jobs, ["job_id", "model_name"]
    a = e.filter("pass_num = 1").groupBy(*on).agg(F.max("work_model").alias("work_model"))
    return a.join(e.filter("pass_num = 2").groupBy(*on).agg(F.max("seniority_level").alias("seniority_level")), on, "left")


@query("""with c as (select company_id, company_name from companies) select s.record_id, c.company_name as directory_name from silver_postings s join c on c.company_id = s.company_id""")
def joi_company_bucket(t: Tables) -> DataFrame:
    """JOI-06, STR-09: companies looked up by bucket and id."""
    c = t.companies.select(text.bucket(F.col("company_id")).alias("b"), "company_id", F.col("company_name").alias("directory_name"))
    s = t.silver_postings.filter("company_id is not null").select(text.bucket(F.col("company_id")).alias("b"), "company_id", "record_id")
    return s.join(F.broadcast(c), ["b", "company_id"]).select("record_id", "directory_name")


_TERMS = ", ".join(f"('{f}', '{c}', '{x}')" for f, _, c, x in flatten(DEFAULT))


@query(f"""with d(family, canonical, term) as (values {_TERMS}), j as (select record_id, ' ' || regexp_replace(lower(coalesce(job_title, '') || ' ' || coalesce(job_description_text, '')), '[^a-z0-9_]+', ' ', 'g') || ' ' as w from silver_postings)
  select distinct record_id, canonical, family from j join d on contains(j.w, ' ' || d.term || ' ')""")
def joi_skill_terms(t: Tables) -> DataFrame:
    """JOI-09, STR-01 in SQL: texts joined with the catalog's terms by word."""
    s = t.silver_postings.select("record_id", F.concat_ws(" ", F.coalesce("job_title", F.lit("")), F.coalesce("job_description_text", F.lit(""))).alias("body"))
    dim = t.spark.createDataFrame([(f, c, x) for f, _, c, x in flatten(DEFAULT)], "family string, canonical string, term string")
    return match_terms(s, "record_id", "body", dim)


@query(f"""with d(family, canonical, term) as (values {_TERMS}), j as (select record_id, ' ' || regexp_replace(lower(coalesce(job_title, '') || ' ' || coalesce(job_description_text, '')), '[^a-z0-9_]+', ' ', 'g') || ' ' as w from silver_postings),
  h as (select distinct record_id, canonical, family from j join d on contains(j.w, ' ' || d.term || ' '))
  select j.record_id, coalesce(array_to_string(list_sort(list(distinct canonical) filter (where canonical is not null)), ','), '') as skills, coalesce(array_to_string(list_sort(list(distinct family) filter (where family is not null)), ','), '') as families from j left join h using (record_id) group by 1""")
def str_skill_detection(t: Tables) -> DataFrame:
    """STR-01, UDF-01, PRJ-06: sorted distinct finds per posting, Arrow batches."""
    s = detect(t.silver_postings.select("record_id", "job_title", "job_description_text"), "job_title", "job_description_text")
    return s.select("record_id", F.array_join("skills_canonical", ",").alias("skills"), F.array_join("skills_families", ",").alias("families"))


@query(f"with d(family, canonical, term) as (values {_TERMS}) select family, count(distinct canonical) as n_skills, count(*) as n_terms from d group by 1")
def agg_catalog(t: Tables) -> DataFrame:
    """STR-02, AGG-41: the catalog by family."""
    dim = t.spark.createDataFrame([(f, c, x) for f, _, c, x in flatten(DEFAULT)], "family string, canonical string, term string")
    return dim.groupBy("family").agg(F.count_distinct("canonical").alias("n_skills"), F.count("*").alias("n_terms"))


@query("""select job_posting_id, record_id from (select job_posting_id, record_id, row_number() over (partition by job_posting_id order by ingested_at desc nulls last, record_id desc) as rn from silver_postings where job_posting_id is not null) where rn = 1
  union all select job_posting_id, record_id from silver_postings where job_posting_id is null""")
def win_latest_wins(t: Tables) -> DataFrame:
    """WIN-01, WIN-02, SET-03: the newest row per id, null ids as they are. max_by pre-aggregates, so a hot id needs no sort."""
    s = t.silver_postings
    kept = s.filter("job_posting_id is not null").groupBy("job_posting_id").agg(F.max(F.struct("ingested_at", "record_id")).alias("m")).select("job_posting_id", "m.record_id")
    return kept.unionByName(s.filter("job_posting_id is null").select("job_posting_id", "record_id"))


@query("""select k, delivery_id from (select coalesce(company_id, company_url) as k, delivery_id, row_number() over (partition by coalesce(company_id, company_url) order by received_at, delivery_id) as rn from company_messages) where rn = 1""")
def win_first_occurrence(t: Tables) -> DataFrame:
    """WIN-03, WIN-04: the first arrival per key."""
    m = t.company_messages.withColumn("k", F.coalesce("company_id", "company_url"))
    return m.groupBy("k").agg(F.min(F.struct("received_at", "delivery_id")).alias("m")).select("k", "m.delivery_id")


@query("""with m as (select cast(ingested_at as date) as day, country_code, count(*) as n from silver_postings group by 1, 2), r as (select *, row_number() over (partition by country_code order by n desc, day) as rn from m) select country_code, day, n from r where rn <= 3""")
def win_top_days(t: Tables) -> DataFrame:
    """WIN-06: the top three per group, ranked over aggregated days."""
    m = t.silver_postings.groupBy(F.to_date("ingested_at").alias("day"), "country_code").agg(F.count("*").alias("n"))
    return m.withColumn("rn", F.row_number().over(W.partitionBy("country_code").orderBy(F.desc("n"), "day"))).filter("rn <= 3").select("country_code", "day", "n")


@query("""with m as (select country_code, strftime(ingested_at, '%Y-%m') as month, count(*) as n from silver_postings group by 1, 2) select country_code, month, n, lag(n) over (partition by country_code order by month) as prev_n, n - lag(n) over (partition by country_code order by month) as change,
  rank() over (partition by month order by n desc) as rank_in_month from m""")
def win_month_trend(t: Tables) -> DataFrame:
    """WIN-09, WIN-11: month over month and rank."""
    m = t.silver_postings.groupBy("country_code", F.date_format("ingested_at", "yyyy-MM").alias("month")).agg(F.count("*").alias("n"))
    prev = F.lag("n").over(W.partitionBy("country_code").orderBy("month"))
    return m.select("country_code", "month", "n", prev.alias("prev_n"), (F.col("n") - prev).alias("change"), F.rank().over(W.partitionBy("month").orderBy(F.desc("n"))).alias("rank_in_month"))


@query("""with c as (select trim(company_id) as company_id, company_name, ingested_at, record_id, lag(company_name) over (partition by trim(company_id) order by ingested_at, record_id) as prev from silver_postings where company_id is not null and company_name is not null),
  v as (select company_id, company_name, ingested_at, record_id from c where prev is null or prev <> company_name)
  select company_id, company_name, strftime(ingested_at, '%Y-%m-%d %H:%M:%S') as effective_start, strftime(lead(ingested_at) over (partition by company_id order by ingested_at, record_id), '%Y-%m-%d %H:%M:%S') as effective_end, lead(ingested_at) over (partition by company_id order by ingested_at, record_id) is null as is_current from v""")
def win_scd2(t: Tables) -> DataFrame:
    """WIN-10: versions of a company's name with their spans."""
    s = t.silver_postings.filter("company_id is not null and company_name is not null").select(F.trim("company_id").alias("company_id"), "company_name", "ingested_at", "record_id")
    w = W.partitionBy("company_id").orderBy("ingested_at", "record_id")
    v = s.withColumn("prev", F.lag("company_name").over(w)).filter("prev is null or prev <> company_name")
    nxt, fmt = F.lead("ingested_at").over(w), "yyyy-MM-dd HH:mm:ss"
    return v.select("company_id", "company_name", F.date_format("ingested_at", fmt).alias("effective_start"), F.date_format(nxt, fmt).alias("effective_end"), nxt.isNull().alias("is_current"))


@query("""with d as (select cast(ingested_at as date) as day, count(*) as n from silver_postings group by 1), c as (select day, n, sum(n) over (order by day rows between unbounded preceding and current row) - n as before from d) select day, n from c where before < 500""")
def srt_until_enough(t: Tables) -> DataFrame:
    """SRT-06: oldest partitions until there are enough rows, over one row per day."""
    d = t.silver_postings.groupBy(F.to_date("ingested_at").alias("day")).agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.orderBy("day").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return d.withColumn("before", before).filter("before < 500").select("day", "n")


@query("select company_id, company_name from companies order by company_id limit 21 offset 40")
def srt_page(t: Tables) -> DataFrame:
    """SRT-02, SRT-11: a page and one row more, which tells whether there is another."""
    return t.companies.select("company_id", "company_name").orderBy("company_id").offset(40).limit(21)


@query("select cast(ingested_at as date) as day, count(*) as n from silver_postings group by 1 order by 1 limit 10")
def srt_oldest(t: Tables) -> DataFrame:
    """SRT-04."""
    return t.silver_postings.groupBy(F.to_date("ingested_at").alias("day")).agg(F.count("*").alias("n")).orderBy("day").limit(10)


@query("select cast(ingested_at as date) as day, count(*) as n from silver_postings group by 1 order by 1 desc limit 10")
def srt_newest(t: Tables) -> DataFrame:
    """SRT-05, SRC-25."""
    return t.silver_postings.groupBy(F.to_date("ingested_at").alias("day")).agg(F.count("*").alias("n")).orderBy(F.desc("day")).limit(10)


@query("""with w as (select distinct unnest(regexp_extract_all(lower(job_summary), '[a-z]{4,}')) as term from silver_postings where job_summary is not null), s as (select distinct unnest(skills_canonical) as term from silver_postings) select term from s where term not in (select term from w)""")
def set_new_terms(t: Tables) -> DataFrame:
    """SET-06: terms that the other side lacks."""
    w = t.silver_postings.select(F.explode(F.regexp_extract_all(F.lower("job_summary"), F.lit("([a-z]{4,})"), 1)).alias("term")).distinct()
    return t.silver_postings.select(F.explode("skills_canonical").alias("term")).distinct().join(w, "term", "left_anti")


@query("select company_id, (('0x' || substr(md5(company_id), 1, 8))::bigint % 50 * 46 * 46 * 46 + ('0x' || substr(md5(company_id), 9, 8))::bigint % 50 * 46 * 46 + ('0x' || substr(md5(company_id), 17, 8))::bigint % 50 * 46 + ('0x' || substr(md5(company_id), 25, 8))::bigint) % 50 as bucket, substr(md5(linkedin_url), 1, 16) as url_key from companies")
def str_bucket(t: Tables) -> DataFrame:
    """STR-09, STR-10."""
    return t.companies.select("company_id", text.bucket(F.col("company_id")).cast("bigint").alias("bucket"), text.short_key(F.col("linkedin_url")).alias("url_key"))


@query("""select job_title, trim(regexp_replace(regexp_replace(lower(job_title), '\\b(senior|sr\\.?|junior|jr\\.?|lead|staff|principal|graduate|entry-level|mid-level)(\\s|$)', '', 'g'), '\\s+', ' ', 'g')) as normal_title, count(*) as n from silver_postings group by 1, 2""")
def str_normal_title(t: Tables) -> DataFrame:
    """STR-15."""
    return t.silver_postings.groupBy("job_title", text.normal_title(F.col("job_title")).alias("normal_title")).agg(F.count("*").alias("n"))


@query("""select g as bigram, count(*) as n from (select unnest(list_transform(range(1, len(w)), lambda i: w[i] || '_' || w[i + 1])) as g from (select list_filter(regexp_split_to_array(regexp_replace(lower(job_title), '[^a-z0-9_\\s-]', ' ', 'g'), '\\s+'), lambda x: length(x) > 2) as w from silver_postings where job_title is not null) where len(w) > 1) group by 1""")
def str_bigrams(t: Tables) -> DataFrame:
    """STR-04, STR-05."""
    return t.silver_postings.filter("job_title is not null").select(F.explode(text.ngrams(text.words(F.col("job_title")), 2)).alias("bigram")).groupBy("bigram").agg(F.count("*").alias("n"))


@query("""select doc_kind, case when text is null then 'other' when contains(lower(text), 'stipend') or contains(lower(text), 'bonus') then 'pay' when contains(lower(text), 'hiring manager') or contains(lower(text), 'recruiter') then 'contact' when contains(lower(text), 'pipeline') then 'data' else 'other' end as category, count(*) as n from documents group by 1, 2""")
def str_category(t: Tables) -> DataFrame:
    """STR-13."""
    kinds = {"pay": ["stipend", "bonus"], "contact": ["hiring manager", "recruiter"], "data": ["pipeline"]}
    return t.documents.groupBy("doc_kind", text.category(F.col("text"), kinds).alias("category")).agg(F.count("*").alias("n"))


@query("select company_id, md5('{\"company_name\":\"' || company_name || '\",\"linkedin_url\":\"' || linkedin_url || '\"}') as content_id from companies where company_name is not null")
def str_content_id(t: Tables) -> DataFrame:
    """STR-11: a key of a row's content in sorted order."""
    return t.companies.filter("company_name is not null").select("company_id", text.content_key("linkedin_url", "company_name").alias("content_id"))


@query("select pass_file_id, json_valid(payload) as is_object from pass_results")
def jsn_repair(t: Tables) -> DataFrame:
    """JSN-03: model answers recovered where they can be; here a payload is an object or broken off beyond repair."""
    return t.pass_results.select("pass_file_id", repair_json("payload").alias("r")).select("pass_file_id", F.col("r.object").isNotNull().alias("is_object"))


@query("select pass_file_id, payload->>'$.metadata.model_id' as model_id, payload->>'$.result.pass1_success' as success, payload->>'$.result.extraction.benefits_structured.equity_mentioned' as equity from pass_results where json_valid(payload)")
def jsn_flatten(t: Tables) -> DataFrame:
    """PRJ-16, PRJ-25, JSN-01: deep paths as columns."""
    g = lambda p: F.get_json_object("payload", p)
    return t.pass_results.filter(F.try_parse_json("payload").isNotNull()).select("pass_file_id", g("$.metadata.model_id").alias("model_id"), g("$.result.pass1_success").alias("success"), g("$.result.extraction.benefits_structured.equity_mentioned").alias("equity"))


@query("select day, hour from (select unnest(generate_series(timestamp '2025-01-01', timestamp '2025-01-03 23:00:00', interval 1 hour)) as ts), lateral (select strftime(ts, '%Y-%m-%d') as day, strftime(ts, '%H') as hour)")
def dat_hours(t: Tables) -> DataFrame:
    """Date sequences: every partition of a span of hours."""
    s = t.spark.sql("select explode(sequence(timestamp_ntz'2025-01-01 00:00:00', timestamp_ntz'2025-01-03 23:00:00', interval 1 hour)) as ts")
    return s.select(F.date_format("ts", "yyyy-MM-dd").alias("day"), F.date_format("ts", "HH").alias("hour"))


@query("select k, v from (select unnest(string_split('year=2025/month=01/day=09/hour=04', '/')) as p), lateral (select split_part(p, '=', 1) as k, split_part(p, '=', 2) as v)")
def src_partition_key(t: Tables) -> DataFrame:
    """SRC-10: a partition key as a map."""
    return t.spark.range(1).select(F.explode(F.str_to_map(F.lit("year=2025/month=01/day=09/hour=04"), F.lit("/"), F.lit("="))).alias("k", "v"))


@query("""select company_id, snapshot_date, company_name from (select *, row_number() over (partition by country_code order by snapshot_date desc, company_id desc) as rn from companies where country_code is not null) where rn = 1""")
def win_latest_snapshot(t: Tables) -> DataFrame:
    """WIN-05: the latest snapshot per group."""
    b = t.companies.filter("country_code is not null").groupBy("country_code").agg(F.max(F.struct("snapshot_date", "company_id", "company_name")).alias("b"))
    return b.select("b.company_id", "b.snapshot_date", "b.company_name")


@query("select batch_index, 12 as total_batches, count(*) as n from (select (row_number() over (order by company_id) - 1) // 20 as batch_index from companies) group by 1")
def snk_fan_out(t: Tables) -> DataFrame:
    """SNK-09, SNK-10, AGG-45: ids in numbered batches of twenty."""
    from siltstone.sources.sinks import fan_out

    return fan_out(t.companies.select("company_id"), "company_id", 20).select(F.col("batch_index").cast("bigint"), F.col("total_batches").cast("int"), F.size("ids").cast("bigint").alias("n"))


def _flat_sql(spec: dict[str, str], section: str, prefix: str) -> str:
    """SQL of a section's columns: plain values of the extraction pass, or values with confidence, evidence and source."""
    out = []
    for g, f, kind in flat.names(spec):
        p = f"$.result.{section}.{g}.{f}"
        text = f"nullif(trim(json_extract_string(payload, '{p}')), '')"
        if prefix != "ext_":
            value = f"nullif(trim(json_extract_string(payload, '{p}.value')), '')"
            out += [f"{value} as {prefix}{f}", f"try_cast(json_extract_string(payload, '{p}.confidence') as double) as {prefix}{f}_confidence"]
            out += [f"nullif(trim(json_extract_string(payload, '{p}.{k}')), '') as {prefix}{f}_{k}" for k in ("evidence", "source")]
        elif kind == "boolean":
            out.append(f"case lower({text}) when 'true' then true when 'yes' then true when '1' then true when 'false' then false when 'no' then false when '0' then false end as ext_{f}")
        elif kind == "double":
            out.append(f"try_cast(nullif(trim(translate({text}, ',$€£', '')), '') as double) as ext_{f}")
        elif kind == "string":
            out.append(f"{text} as ext_{f}")
        else:
            listed = f"case when {text} like '[%' then from_json({text}, '[\"VARCHAR\"]') else string_split({text}, ',') end"
            out.append(f"list_filter(list_transform({listed}, lambda x: trim(x)), lambda x: x is not null and x <> '') as ext_{f}")
    return ", ".join(out)


def _section(name: str):
    return F.get_json_object("payload", f"$.result.{name}")


@query(f"select pass_file_id, {_flat_sql(flat.EXTRACTION, 'extraction', 'ext_')} from pass_results where json_valid(payload)")
def prj_ext(t: Tables) -> DataFrame:
    """PRJ-16: the extraction pass as flat columns."""
    return t.pass_results.filter(F.try_parse_json("payload").isNotNull()).select("pass_file_id", *flat.extraction(_section("extraction")))


@query(f"select pass_file_id, {_flat_sql(flat.INFERENCE, 'inference', 'inf_')} from pass_results where json_valid(payload)")
def prj_inf(t: Tables) -> DataFrame:
    """PRJ-17: the inference pass as a hundred flat columns."""
    return t.pass_results.filter(F.try_parse_json("payload").isNotNull()).select("pass_file_id", *flat.inference(_section("inference")))


_SUMMARY = ", ".join(f"json_extract_string(payload, '$.result.summary.{f}') as anl_{f}" for f in flat.SUMMARY.split())


@query(f"select pass_file_id, {_flat_sql(flat.ANALYSIS, 'analysis', 'anl_')}, {_SUMMARY} from pass_results where json_valid(payload)")
def prj_anl(t: Tables) -> DataFrame:
    """PRJ-18: the analysis pass and its summary as 124 flat columns."""
    return t.pass_results.filter(F.try_parse_json("payload").isNotNull()).select("pass_file_id", *flat.analysis(_section("analysis"), _section("summary")))


@query("""select job_id, model_name, pass_num, cost_usd from enriched_jobs where lower(coalesce(case pass_num when 1 then work_model when 2 then seniority_level end, 'pending')) in ('pending', 'in_progress', 'failed')""")
def fil_not_completed(t: Tables) -> DataFrame:
    """FIL-08: rows whose state isn't completed; a missing answer is pending."""
    state = F.lower(F.coalesce(F.when(F.col("pass_num") == 1, F.col("work_model")).when(F.col("pass_num") == 2, F.col("seniority_level")), F.lit("pending")))
    return t.enriched_jobs.filter(state.isin("pending", "in_progress", "failed")).select("job_id", "model_name", "pass_num", "cost_usd")


@query("""with n as (select max(received_at) as now from company_messages) select delivery_id, received_at < now - interval 30 minute or receive_count >= 3 as is_orphaned from company_messages, n""")
def fil_orphaned(t: Tables) -> DataFrame:
    """FIL-11, STM-07: locks held longer than half an hour, or by a holder that has ended."""
    from siltstone.streaming.micro_batches import is_orphaned

    now = t.company_messages.agg(F.max("received_at")).first()[0]  # one value
    return t.company_messages.select("delivery_id", is_orphaned(F.col("received_at"), F.lit(now), F.col("receive_count") >= 3).alias("is_orphaned"))


@query("""with w as (select distinct lower(trim(job_title)) as term from silver_postings where job_title is not null) select term, regexp_matches(term, '^[0-9.,%$€£ ]+$') or regexp_matches(term, '\\b(years?|months?|benefits?|salary|team|company|office)\\b') or length(regexp_replace(term, '[^a-z]', '', 'g')) < 2
  or len(list_filter(string_split(term, ' '), lambda x: x not in ('work', 'working', 'good', 'strong', 'great', 'experience', 'skills', 'ability', 'knowledge'))) = 0 as is_generic from w""")
def fil_non_tech(t: Tables) -> DataFrame:
    """FIL-15: terms that are probably no technology: figures, words of the trade of hiring, or generic words only."""
    return t.silver_postings.filter("job_title is not null").select(F.lower(F.trim("job_title")).alias("term")).distinct().select("term", text.probably_non_tech(F.col("term")).alias("is_generic"))


@query("""with p as (select pass_file_id, unnest(from_json(json_extract(payload, '$.result.extraction.skills_classified.must_have_soft_skills'), '["VARCHAR"]')) as skill from pass_results where json_valid(payload))
  select lower(trim(skill)) as skill, count(*) as n from p group by 1""")
def agg_soft_skills(t: Tables) -> DataFrame:
    """AGG-10: soft skills counted straight from the answers' JSON."""
    c = F.get_json_object("payload", "$.result.extraction.skills_classified.must_have_soft_skills")
    p = t.pass_results.filter(F.try_parse_json("payload").isNotNull()).select(F.explode(F.from_json(c, "array<string>")).alias("skill"))
    return p.groupBy(F.lower(F.trim("skill")).alias("skill")).agg(F.count("*").alias("n"))
