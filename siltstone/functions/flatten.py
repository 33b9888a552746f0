"""Model answers of the three passes as flat columns.

Each section of an answer is JSON text of groups of fields. A section becomes one projection: ext_* columns hold plain
values; inf_* and anl_* fields come in four columns, the value and its _confidence, _evidence and _source. All columns
are always there, null where the section, the group or the field is missing or of another kind.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone.functions import coerce

# Groups and fields of the extraction pass; ? is a flag, # a number, * a list, all else text.
EXTRACTION = {
    "compensation": "salary_disclosed? salary_min# salary_max# salary_currency salary_period salary_text_raw hourly_rate_min# hourly_rate_max# hourly_rate_currency hourly_rate_text_raw",
    "work_authorization": "visa_sponsorship_stated work_auth_text citizenship_text security_clearance_stated",
    "work_model": "work_model_stated location_restriction_text employment_type_stated",
    "contract_details": "contract_type contract_duration_months# contract_duration_text extension_possible conversion_to_fte start_date start_date_text probation_period_text",
    "contractor_rates": "pay_type daily_rate_min# daily_rate_max# daily_rate_currency daily_rate_text_raw rate_negotiable overtime_paid",
    "skills_classified": "must_have_hard_skills* nice_to_have_hard_skills* must_have_soft_skills* nice_to_have_soft_skills* certifications_mentioned* years_experience_min# years_experience_max# years_experience_text "
    "education_level education_area education_requirement education_text_raw education_stated llm_genai_mentioned? feature_store_mentioned?",
    "geographic_restrictions": "geo_restriction_type allowed_countries* excluded_countries* us_state_restrictions* residency_requirement",
    "benefits_structured": "benefits_mentioned* equity_mentioned? learning_budget_mentioned? conference_budget_mentioned? hardware_choice_mentioned? pto_policy",
    "context": "team_info_text company_description_text",
}
# Groups and fields of the inference pass.
INFERENCE = {
    "seniority_and_role": "seniority_level job_family sub_specialty leadership_expectation",
    "stack_and_cloud": "primary_cloud secondary_clouds processing_paradigm orchestrator_category storage_layer",
    "geo_and_work_model": "remote_restriction timezone_focus relocation_required",
    "visa_and_authorization": "h1b_friendly opt_cpt_friendly citizenship_required",
    "contract_and_compensation": "w2_vs_1099 benefits_level",
    "career_development": "growth_path_clarity mentorship_signals promotion_path_mentioned internal_mobility_mentioned career_tracks_available",
    "requirements_classification": "requirement_strictness scope_definition skill_inflation_detected",
}
# Groups and fields of the analysis pass, and its summary's plain fields.
ANALYSIS = {
    "company_maturity": "data_maturity_score data_maturity_level maturity_signals",
    "red_flags_and_role_quality": "scope_creep_score overtime_risk_score role_clarity overall_red_flag_score",
    "stakeholders_and_leadership": "reporting_structure_clarity manager_level_inferred team_growth_velocity team_composition reporting_structure cross_functional_embedded",
    "tech_culture": "work_life_balance_score growth_opportunities_score tech_culture_score",
    "tech_culture_assessment": "tech_culture_signals dev_practices_mentioned innovation_signals tech_debt_awareness",
    "ai_ml_integration": "ai_integration_level ml_tools_expected",
    "competition_and_timing": "hiring_urgency competition_level",
    "company_context": "company_stage_inferred hiring_velocity team_size_signals funding_stage_signals role_creation_type",
}
SUMMARY = "strengths concerns best_fit_for red_flags_to_probe negotiation_leverage overall_assessment recommendation_score recommendation_confidence"

KINDS = {"?": "boolean", "#": "double", "*": "array<string>"}


def names(spec: dict[str, str]) -> list[tuple[str, str, str]]:
    """(group, field, kind) of a specification."""
    return [(g, f.rstrip("?#*"), KINDS.get(f[-1], "string")) for g, fs in spec.items() for f in fs.split()]


def members(c: Column) -> Column:
    """The members of JSON text that is an object, each as text; null otherwise."""
    return F.when(F.ltrim(c).startswith("{"), F.from_json(c, "map<string,string>"))


def listed(c: Column) -> Column:
    """A JSON array's or a comma list's non-blank texts."""
    return F.when(c.isNotNull(), coerce.items(c))


def plain(c: Column, kind: str) -> Column:
    """A field's text as a value of a kind."""
    return {"boolean": coerce.loose_bool, "double": coerce.number, "array<string>": listed, "string": coerce.text}[kind](c)


def extraction(section: Column) -> list[Column]:
    """ext_* columns of the extraction section."""
    groups = members(section)
    of = {g: members(F.try_element_at(groups, F.lit(g))) for g in EXTRACTION}
    return [plain(F.try_element_at(of[g], F.lit(f)), kind).alias(f"ext_{f}") for g, f, kind in names(EXTRACTION)]


def _graded(section: Column, spec: dict[str, str], prefix: str) -> list[Column]:
    groups = members(section)
    of = {g: members(F.try_element_at(groups, F.lit(g))) for g in spec}
    out = []
    for g, f, _ in names(spec):
        field = members(F.try_element_at(of[g], F.lit(f)))
        get = lambda k: F.try_element_at(field, F.lit(k))  # noqa: B023, E731
        value = F.trim(get("value"))
        value = F.when(value.startswith("["), F.to_json(coerce.items(value))).otherwise(F.nullif(value, F.lit("")))
        out += [value.alias(prefix + f), get("confidence").try_cast("double").alias(f"{prefix}{f}_confidence"), coerce.text(get("evidence")).alias(f"{prefix}{f}_evidence"), coerce.text(get("source")).alias(f"{prefix}{f}_source")]
    return out


def inference(section: Column) -> list[Column]:
    """inf_* columns of the inference section, four a field; lists and objects as JSON text."""
    return _graded(section, INFERENCE, "inf_")


def analysis(section: Column, summary: Column) -> list[Column]:
    """anl_* columns of the analysis section, four a field, and of its summary, one a field."""
    plain_ones = members(summary)
    return _graded(section, ANALYSIS, "anl_") + [F.try_element_at(plain_ones, F.lit(f)).alias(f"anl_{f}") for f in SUMMARY.split()]
