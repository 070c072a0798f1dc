"""Raw records to standardised ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import parse, text


def clean_records(raw: DataFrame, html: bool = True, also: tuple[str, ...] = ()) -> DataFrame:
    """The 24 standardised columns and clean_error: null, or why the record can't be used.  ``also`` names columns that stay."""
    c = F.col
    title = text.strip_title_noise(c("title"), html)
    staged = raw.withColumns({
        "title_clean": title, "company_clean": text.company_clean(c("company"), html), "_place": text.normalize_location(F.coalesce(c("location"), F.lit(""))),
        "_salary": parse.parse_salary(c("salary")), "_years": parse.parse_experience(c("experience")), "_posted": parse.parse_posted_date(c("posted_at_raw"), c("scraped_at")),
        "skills": text.extract_skills(c("title"), c("description"), c("industry"), c("experience")), "work_mode": text.classify_work_mode(c("title"), c("description"), c("location")),
        "employment_type": text.classify_employment_type(c("title"), c("description"), c("experience")),
    })
    error = F.when(c("_salary.error"), "salary isn't a number").when(c("_posted.error"), "posting or scrape date can't be read")
    extra = [x for x in ("_file", "_ordinal") if x in raw.columns]
    return staged.select(
        "job_id", text.job_hash(c("title_clean"), c("company_clean"), c("_place.city")).alias("job_hash"), c("title").alias("title_raw"), "title_clean", c("company").alias("company_raw"), "company_clean",
        c("location").alias("location_raw"), c("_place.city").alias("location_city"), c("_place.governorate").alias("location_gov"), c("_salary.min").alias("salary_min"), c("_salary.max").alias("salary_max"),
        c("_salary.currency").alias("salary_currency"), c("_salary.period").alias("salary_period"), c("_years.min").alias("experience_years_min"), c("_years.max").alias("experience_years_max"),
        "skills", "work_mode", "employment_type", "source", "job_url", "scraped_at", c("_posted.value").alias("posted_at"), "run_id", text.is_remote(c("work_mode")).alias("is_remote"),
        error.alias("clean_error"), *extra, *also,
    )


def split_rejects(cleaned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable records, and rejected ones with their reason."""
    return cleaned.where("clean_error is null").drop("clean_error"), cleaned.where("clean_error is not null")
