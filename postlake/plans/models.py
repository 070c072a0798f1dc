"""Staging and intermediate models over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.parse import salary_mid
from ..functions.text import seniority


def stg_job_postings(fact: DataFrame) -> DataFrame:
    """The 26 columns of a posting; keys of dimensions are their natural ones (a company's with its version)."""
    c = F.col
    return fact.select(
        "job_key", "job_hash", "source_job_id", "source_name", "company_clean", "company_version", "location_key", "category_name", "posted_date", "scraped_date", "title_clean", "title_raw", "salary_min", "salary_max",
        salary_mid(c("salary_min"), c("salary_max")).alias("salary_mid"), "salary_currency", "salary_period", "experience_years_min", "experience_years_max", F.coalesce("is_remote", F.lit(False)).alias("is_remote"),
        F.coalesce("work_mode", F.lit("on-site")).alias("work_mode"), F.coalesce("employment_type", F.lit("full-time")).alias("employment_type"), seniority(c("title_clean")).alias("seniority"), "job_url", "run_id",
        "first_seen_at", "last_loaded_at",
    )


def stg_company(dim: DataFrame) -> DataFrame:
    """All versions."""
    return dim.select("company_clean", F.col("version").alias("company_version"), F.col("company_clean").alias("company_name"), "company_raw", "valid_from", "valid_to", "is_current")


def stg_location(dim: DataFrame, governorates: DataFrame) -> DataFrame:
    return dim.select("location_key", F.col("location_city").alias("city"), F.col("location_gov").alias("governorate")).join(governorates.select("governorate", "region"), "governorate", "left")


def stg_job_category(dim: DataFrame) -> DataFrame:
    return dim.select("category_key", "category_name")


def stg_skill(dim: DataFrame) -> DataFrame:
    return dim.select("skill_name", "skill_category")


def stg_source(dim: DataFrame) -> DataFrame:
    return dim.select("source_name", "display_name", "base_url")


def stg_date(dim: DataFrame) -> DataFrame:
    return dim.select("date_key", "full_date", "year", "quarter", "month", "month_name", "day", "day_of_week", "day_name", "week_of_year", "is_weekend")


def int_job_enriched(gold: dict[str, DataFrame]) -> DataFrame:
    """Postings with their dimensions: 28 columns.  Seed tables are small by construction; the planner chooses for the others."""
    date = stg_date(gold["dim_date"]).select(
        F.col("full_date").alias("posted_date"), F.col("year").alias("posted_year"), F.col("quarter").alias("posted_quarter"), F.col("month").alias("posted_month"), F.col("month_name").alias("posted_month_name"), F.col("week_of_year").alias("posted_week"),
    )
    company = stg_company(gold["dim_company"]).select("company_clean", "company_version", "company_name")
    source = stg_source(gold["dim_source"]).select("source_name", F.col("display_name").alias("source_display"))
    jobs = stg_job_postings(gold["fact_job_postings"]).withColumnRenamed("category_name", "_category")
    out = (
        jobs.join(stg_job_category(gold["dim_job_category"]).select("category_name"), F.col("_category") == F.col("category_name"), "left").join(company, ["company_clean", "company_version"], "left")
        .join(stg_location(gold["dim_location"], gold["ref_governorate"]), "location_key", "left").join(source, "source_name", "left").join(date, "posted_date", "left")
    )
    return out.select(
        "job_key", "job_hash", "title_clean", "seniority", "category_name", "company_name", "city", "governorate", "region", "source_name", "source_display", "salary_min", "salary_max", "salary_mid", "salary_currency",
        "experience_years_min", "experience_years_max", "is_remote", "work_mode", "employment_type", "posted_date", "posted_year", "posted_quarter", "posted_month", "posted_month_name", "posted_week", "job_url", "first_seen_at",
    )


def int_job_skills(gold: dict[str, DataFrame], enriched: DataFrame) -> DataFrame:
    """A row per link of a posting to a skill of the dimension; links have the dimension's spelling."""
    jobs = enriched.select("job_key", "category_name", "governorate", "region", "seniority", "work_mode")
    return gold["bridge_job_skill"].join(stg_skill(gold["dim_skill"]), "skill_name").join(jobs, "job_key").select("job_key", "skill_name", "skill_category", "category_name", "governorate", "region", "seniority", "work_mode")
