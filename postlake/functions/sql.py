"""The scalar operators as temporary SQL functions; Catalyst inlines them."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .. import reference as ref
from .text import skill_pattern


def _quoted(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _rules(column: str, rules, default: str) -> str:
    cases = " ".join(f"WHEN {' OR '.join(f'contains({column}, {_quoted(w)})' for w in words)} THEN {_quoted(name)}" for name, words in rules)
    return f"CASE {cases} ELSE {default} END"


def register_functions(spark: SparkSession) -> None:
    """classify_work_mode, classify_employment_type, seniority_of, normalize_location (a struct of city and governorate),
    parse_salary (a struct of min, max, currency and period), parse_experience (a struct of min and max), extract_skills,
    and the parts of these: normalize_city, normalize_governorate, salary_period, experience_min and salary_numbers; each
    of one string."""
    low = "lower(coalesce(t, ''))"
    west = "translate(coalesce(t, ''), '٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹', '01234567890123456789')"
    numbers = f"transform(regexp_extract_all(replace({west}, ',', ''), '([0-9.]+)', 1), x -> try_cast(x AS DOUBLE))"
    years = f"filter(transform(regexp_extract_all({west}, '([0-9]+)', 1), x -> try_cast(x AS INT)), x -> x <= 50)"
    none, bad = f"trim({low}) IN ('', 'n/a', 'confidential')", f"exists({numbers}, x -> x IS NULL)"
    low_end, high_end = f"get({numbers}, 0)", f"coalesce(get({numbers}, 1), get({numbers}, 0))"
    city = _rules(low, [(c, (w,)) for w, c, _ in ref.LOCATIONS], "'Unknown'")
    governorate = _rules(low, [(g, (w,)) for w, _, g in ref.LOCATIONS], "'Egypt'")
    period = _rules(low, ref.SALARY_PERIODS, "NULL")
    skills = ", ".join(f"CASE WHEN {low} RLIKE {_quoted(skill_pattern(w))} THEN {_quoted(n)} END" for n, _, w in ref.SKILLS)
    bodies = {
        "classify_work_mode": ("STRING", _rules(low, ref.WORK_MODES, "'on-site'")),
        "classify_employment_type": ("STRING", _rules(low, ref.EMPLOYMENT_TYPES, "'full-time'")),
        "seniority_of": ("STRING", _rules(low, ref.SENIORITIES, "'Unspecified'")),
        "normalize_city": ("STRING", city),
        "normalize_governorate": ("STRING", governorate),
        "salary_period": ("STRING", period),
        "salary_numbers": ("ARRAY<DOUBLE>", numbers),
        "experience_min": ("INT", f"get({years}, 0)"),
        "parse_experience": ("STRUCT<min: INT, max: INT>", f"named_struct('min', get({years}, 0), 'max', get({years}, 1))"),
        "parse_salary": (
            "STRUCT<min: DOUBLE, max: DOUBLE, currency: STRING, period: STRING>",
            f"named_struct('min', CASE WHEN NOT ({none}) AND NOT {bad} THEN {low_end} END, 'max', CASE WHEN NOT ({none}) AND NOT {bad} THEN {high_end} END, "
            f"'currency', CASE WHEN contains({low}, '$') OR contains({low}, 'usd') THEN 'USD' ELSE 'EGP' END, 'period', CASE WHEN NOT ({none}) THEN {period} END)",
        ),
        "normalize_location": ("STRUCT<city: STRING, governorate: STRING>", f"named_struct('city', {city}, 'governorate', {governorate})"),
        "extract_skills": ("ARRAY<STRING>", f"array_compact(array({skills}))"),
    }
    for name, (kind, body) in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(t STRING) RETURNS {kind} RETURN {body}")
