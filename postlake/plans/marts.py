"""The marts, as functions of the enriched postings.  Windows without partitions run over the few rows of an aggregate."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.parse import ratio, share



def _mean(c: str) -> Column:
    return F.round(F.avg(c), 0)


def _remote() -> Column:
    return F.count_if(F.col("is_remote"))


def _mode(c: str) -> Column:
    """The most frequent value; of equals the smallest."""
    return F.mode(c, deterministic=True)


def in_demand_roles(jobs: DataFrame) -> DataFrame:
    return ranked_roles(jobs.groupBy("category_name").agg(F.count("*").alias("postings"), F.count_distinct("company_name").alias("hiring_companies"), _mean("salary_mid").alias("avg_salary_mid"), _remote().alias("remote_postings")))


def ranked_roles(out: DataFrame) -> DataFrame:
    return out.withColumns({
        "demand_share_pct": share(F.col("postings"), F.sum("postings").over(Window.partitionBy())), "postings_per_company": ratio(F.col("postings"), F.col("hiring_companies")),
        "demand_rank": F.rank().over(Window.orderBy(F.desc("postings"))),
    })


def medians(df: DataFrame, keys: list[str], value: str, times: str | None = None) -> DataFrame:
    """(keys, median) of the non-null numbers of each group, as doubles, found by counting.  ``times`` names the column that
    tells how often a row's number occurs, once without it.

    Rows are counted per group and number.  Numbers lie in ranges (an eighth of a doubling each); the ranges' counts tell
    in which the middle positions are, and running sums inside of these tell at which numbers.  Whatever the size of a
    group, no task has more than a range's distinct numbers, and nothing is buffered."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v")).agg((F.sum(times) if times else F.count("*")).alias("_n"))
    v = F.col("_v").cast("double")
    counts = counts.withColumn("_range", (F.signum(v) * F.floor(F.log2(F.abs(v) + 1) * 8)).cast("int"))
    group, inside = Window.partitionBy(*keys), Window.partitionBy(*keys, "_range")
    ranges = counts.groupBy(*keys, "_range").agg(F.sum("_n").alias("_m"))
    ranges = ranges.withColumn("_upto", F.sum("_m").over(group.orderBy("_range"))).withColumn("_all", F.sum("_m").over(group))
    low, high = F.expr("(_all - 1) div 2"), F.expr("_all div 2")
    ranges = ranges.where((F.col("_upto") > low) & (F.col("_upto") - F.col("_m") <= high))
    ranges = ranges.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_range").alias("_r"), (F.col("_upto") - F.col("_m")).alias("_before"), "_all")
    same = F.col("_range") == F.col("_r")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    placed = counts.join(ranges, same).withColumn("_upto", F.col("_before") + F.sum("_n").over(inside.orderBy("_v")))
    holds = lambda at: (F.col("_upto") > at) & (F.col("_upto") - F.col("_n") <= at)
    middle = lambda at: F.max(F.when(holds(at), F.col("_v"))).cast("double")
    return placed.groupBy(*keys).agg(((middle(low) + middle(high)) / 2).alias("median"))


def salary_intelligence(jobs: DataFrame) -> DataFrame:
    keys, paid = ["category_name", "seniority", "governorate"], jobs.where("salary_mid is not null")
    out = paid.groupBy(*keys).agg(
        F.count("*").alias("postings_with_salary"), F.round(F.min("salary_min"), 0).alias("salary_floor"), _mean("salary_min").alias("avg_salary_min"), _mean("salary_mid").alias("avg_salary_mid"),
        _mean("salary_max").alias("avg_salary_max"), F.round(F.max("salary_max"), 0).alias("salary_ceiling"), F.max("salary_currency").alias("currency"),
    )
    return with_medians(out, medians(paid, keys, "salary_mid"))


def with_medians(out: DataFrame, middle: DataFrame) -> DataFrame:
    """The mart of salaries with the medians of its groups before the currency, its last column."""
    keys = out.columns[:3]
    middle = middle.select(*[F.col(k).alias(f"_m{k}") for k in keys], F.bround("median", 0).alias("median_salary_mid"))
    same = functools.reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_m{k}")) for k in keys])
    columns = [*out.columns[:-1], "median_salary_mid", "currency"]
    return out.join(middle, same).select(*columns)


def skill_demand(job_skills: DataFrame) -> DataFrame:
    """All rows of a skill share a rank; the next skill's rank counts these rows."""
    return ranked_skills(job_skills.groupBy("skill_name", "skill_category", "category_name").agg(F.count_distinct("job_key").alias("postings")))


def ranked_skills(out: DataFrame) -> DataFrame:
    out = out.withColumn("total_postings", F.sum("postings").over(Window.partitionBy("skill_name")))
    return out.withColumn("overall_skill_rank", F.rank().over(Window.orderBy(F.desc("total_postings"), "skill_name")))


def company_insights(jobs: DataFrame) -> DataFrame:
    out = jobs.groupBy("company_name").agg(
        F.count("*").alias("postings"), F.count_distinct("category_name").alias("distinct_categories"), F.count_distinct("governorate").alias("distinct_governorates"), _mean("salary_mid").alias("avg_salary_mid"),
        _remote().alias("remote_postings"), _mode("category_name").alias("top_category"), _mode("governorate").alias("top_governorate"),
    )
    return ranked_companies(out)


def ranked_companies(out: DataFrame) -> DataFrame:
    # A rank needs only how many companies have more postings: count these per number of postings, not per company.
    levels = out.groupBy("postings").agg(F.count("*").alias("n"))
    ranks = levels.select("postings", (F.coalesce(F.sum("n").over(Window.orderBy(F.desc("postings")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + 1).cast("int").alias("hiring_rank"))
    return out.join(ranks, "postings").select(*out.columns, "hiring_rank")


def geographic_distribution(jobs: DataFrame) -> DataFrame:
    return shared_places(jobs.groupBy("region", "governorate").agg(
        F.count("*").alias("postings"), F.count_distinct("city").alias("cities"), F.count_distinct("company_name").alias("hiring_companies"), _mean("salary_mid").alias("avg_salary_mid"), _remote().alias("remote_postings")))


def shared_places(out: DataFrame) -> DataFrame:
    return out.withColumn("postings_share_pct", share(F.col("postings"), F.sum("postings").over(Window.partitionBy())))


def hiring_trends(jobs: DataFrame) -> DataFrame:
    return jobs.where("posted_date is not null").groupBy(F.col("posted_year").alias("year"), F.col("posted_month").alias("month"), F.col("posted_month_name").alias("month_name"), "category_name").agg(
        F.count("*").alias("postings"), F.count_distinct("company_name").alias("hiring_companies"), _mean("salary_mid").alias("avg_salary_mid"))


def work_mode_breakdown(jobs: DataFrame) -> DataFrame:
    """Both facets in one pass over the postings."""
    facets = F.array(*[F.struct(F.lit(f).alias("facet"), F.col(f).alias("value")) for f in ("work_mode", "employment_type")])
    return shared_facets(jobs.select(F.explode(facets).alias("f")).groupBy("f.facet", "f.value").agg(F.count("*").alias("postings")))


def shared_facets(out: DataFrame) -> DataFrame:
    return out.withColumn("share_pct", share(F.col("postings"), F.sum("postings").over(Window.partitionBy("facet"))))


#: Order of each mart where it leaves the library, up to its whole grain.
ORDERS = {
    "in_demand_roles": ["-postings", "category_name"], "salary_intelligence": ["category_name", "seniority", "governorate"], "skill_demand": ["-total_postings", "skill_name", "-postings", "category_name"],
    "company_insights": ["-postings", "company_name"], "geographic_distribution": ["-postings", "region", "governorate"], "hiring_trends": ["year", "month", "-postings", "category_name"],
    "work_mode_breakdown": ["facet", "-postings", "value"],
}


def sort_keys(keys: list[str]) -> list[Column]:
    """Nulls last when ascending, first when descending (marked by -)."""
    return [F.desc_nulls_first(k[1:]) if k[0] == "-" else F.asc_nulls_last(k) for k in keys]


def all_marts(jobs: DataFrame, job_skills: DataFrame) -> dict[str, DataFrame]:
    return {
        "in_demand_roles": in_demand_roles(jobs), "salary_intelligence": salary_intelligence(jobs), "skill_demand": skill_demand(job_skills), "company_insights": company_insights(jobs),
        "geographic_distribution": geographic_distribution(jobs), "hiring_trends": hiring_trends(jobs), "work_mode_breakdown": work_mode_breakdown(jobs),
    }
