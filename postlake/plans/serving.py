"""Filtered, sorted pages of marts, and small roll-ups of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import month_label
from .marts import ORDERS, sort_keys


def page_bounds(limit: int, skip: int) -> tuple[int, int]:
    if not 1 <= limit <= 1000 or skip < 0:
        raise ValueError("limit must be between 1 and 1000, skip at least 0")
    return limit, skip


def serve(mart: DataFrame, order: list[str], contains: dict[str, str | None] | None = None, equal: dict[str, object] | None = None, limit: int = 100, skip: int = 0) -> DataFrame:
    """Rows whose columns contain the given texts in any case (% and _ are wildcards) and equal the given values; empty
    conditions don't count.  The order keys reach the mart's grain, so pages are stable."""
    limit, skip = page_bounds(limit, skip)
    for c, v in (contains or {}).items():
        if v:
            mart = mart.where(F.col(c).ilike(f"%{v}%"))
    for c, v in (equal or {}).items():
        if v:
            mart = mart.where(F.col(c) == v)
    mart = mart.orderBy(*sort_keys(order))
    return (mart.offset(skip) if skip else mart).limit(limit)


def serve_salary_intelligence(mart, category=None, seniority=None, governorate=None, limit=100, skip=0) -> DataFrame:
    order = mart.withColumn("_none", F.col("postings_with_salary").isNull())
    return serve(order, ["_none", "-postings_with_salary", *ORDERS["salary_intelligence"]], {"category_name": category, "seniority": seniority, "governorate": governorate}, None, limit, skip).drop("_none")


def serve_in_demand_roles(mart, limit=100, skip=0) -> DataFrame:
    return serve(mart, ["demand_rank", "category_name"], None, None, limit, skip)


def serve_company_insights(mart, governorate=None, limit=100, skip=0) -> DataFrame:
    return serve(mart, ["hiring_rank", "company_name"], {"top_governorate": governorate}, None, limit, skip)


def serve_geographic_distribution(mart, region=None, limit=100, skip=0) -> DataFrame:
    return serve(mart, ORDERS["geographic_distribution"], {"region": region}, None, limit, skip)


def serve_skill_demand(mart, category=None, limit=100, skip=0) -> DataFrame:
    return serve(mart, ["overall_skill_rank", "skill_name", "category_name", "skill_category"], {"category_name": category}, None, limit, skip)


def serve_hiring_trends(mart, category=None, year=None, limit=500, skip=0) -> DataFrame:
    return serve(mart, ["year", "month", "category_name"], {"category_name": category}, {"year": year}, limit, skip)


def serve_work_mode_breakdown(mart, facet=None, limit=100, skip=0) -> DataFrame:
    return serve(mart, ["-postings", "facet", "value"], {"facet": facet}, None, limit, skip)


def other_last(df: DataFrame, column: str, *then: Column, other: str = "Other") -> DataFrame:
    return df.orderBy(F.coalesce(F.col(column) == other, F.lit(False)), *then)


def user_sort(df: DataFrame, column: str, descending: bool, *tie: str) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(column) if descending else F.asc_nulls_last(column), *tie)


def top_governorates(geo: DataFrame, n: int = 15) -> DataFrame:
    return geo.groupBy(F.coalesce("governorate", F.lit("Unknown")).alias("governorate")).agg(F.sum("postings").alias("postings")).orderBy(F.desc("postings"), "governorate").limit(n)


def top_skills(skills: DataFrame, n: int = 15) -> DataFrame:
    return skills.groupBy("skill_name").agg(F.sum("postings").alias("postings")).orderBy(F.desc("postings"), "skill_name").limit(n)


def salary_by_category(salary: DataFrame, n: int = 12) -> DataFrame:
    """The n largest unweighted means of the groups' means, a null counted as 0; Other is moved to the end."""
    out = salary.groupBy("category_name").agg((F.sum(F.coalesce(F.col("avg_salary_mid").cast("double"), F.lit(0.0))) / F.count("*")).alias("mean"))
    top = out.select("category_name", F.round("mean", 0).alias("avg_salary")).orderBy(F.desc("avg_salary"), "category_name").limit(n)
    return other_last(top, "category_name", F.desc("avg_salary"), F.asc("category_name"))


def trend_pivot(trends: DataFrame, categories: list[str]) -> DataFrame:
    """A row per month in order of time, with its label, and a column per category."""
    made = trends.groupBy("year", "month", "month_name").pivot("category_name", categories).agg(F.sum("postings"))
    return made.select("year", "month", month_label(F.col("month_name"), F.col("year")).alias("label"), *[F.col(f"`{c}`") for c in categories]).orderBy("year", "month")


def overview_kpis(roles: DataFrame, breakdown: DataFrame) -> DataFrame:
    """One row: all postings, the role with most (Other only if alone), percent remote and full-time."""
    rows = roles.select("postings", "category_name").unionByName(breakdown.select("facet", "value", F.col("share_pct").cast("double").alias("share_pct")), allowMissingColumns=True)
    pct = lambda facet, value: F.coalesce(F.max(F.when((F.col("facet") == facet) & (F.col("value") == value), F.col("share_pct"))), F.lit(0.0))
    rank = F.when(F.col("postings").isNotNull(), F.struct((F.col("category_name") != "Other").cast("int"), F.col("postings")))
    return rows.agg(
        F.sum("postings").alias("total_postings"), F.max_by("category_name", rank).alias("top_role"), pct("work_mode", "remote").alias("remote_pct"), pct("employment_type", "full-time").alias("full_time_pct"),
    )


def distinct_options(df: DataFrame, column: str) -> DataFrame:
    return other_last(df.where(F.col(column).isNotNull()).select(column).distinct(), column, F.asc(column))


def salary_headline(jobs: DataFrame) -> DataFrame:
    both = jobs.where("salary_min is not null and salary_max is not null")
    return both.agg(F.count("*").alias("n"), F.round(F.avg("salary_mid"), 0).alias("mean"), F.min("salary_min").alias("low"), F.max("salary_max").alias("high"))


def layer_volumes(layers: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in layers.items():
        row = df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("layer"), "n_rows")
        out = row if out is None else out.unionByName(row)
    return out


def source_volumes(layers: dict[str, DataFrame], column: str = "source") -> DataFrame:
    """Rows per layer and source."""
    out = None
    for name, df in layers.items():
        row = df.groupBy(F.col(column).alias("source")).agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("layer"), "source", "n_rows")
        out = row if out is None else out.unionByName(row)
    return out
