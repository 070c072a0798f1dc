"""One aggregate of the postings from which all marts are rolled up.

``base`` makes the enriched postings once: of several grains, what they read of a posting is written, each grain is counted
from that by its own few keys, a posting once per link for skills, and the base is written (``kept``).  Rows of equal keys are counted and summed in each
task before the shuffle, so that a company or category with a third of all postings costs a row per task.  The grains
are the least from which the marts' distinct counts, modes and medians are exact:

* ``demand``: year, month, category, company: in_demand_roles, hiring_trends, company_insights
* ``place``: region, governorate, city, company: geographic_distribution, company_insights
* ``salary``: category, seniority, governorate, middle of the salary, currency, where there is a salary: salary_intelligence
* ``mode``: work mode, employment type: work_mode_breakdown
* ``skill``: skill, its category, the posting's category: skill_demand

Counts, sums and extremes of bases of different postings add up to the base of all of them (``merged``), so a base per day
or load can be kept and the marts made anew without a look at older postings.  Changed postings need the bases of their part
made again.  Each mart equals its namesake in ``marts``; only the precision of decimals may differ.

Null keys are groups of their own and aren't counted as distinct values; repeated postings count as often as they occur,
links of a posting to a skill once.  Without postings the base and all marts are empty.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import files
from . import marts

GRAINS = {
    "demand": ("dated", "posted_year", "posted_month", "posted_month_name", "category_name", "company_name"), "place": ("region", "governorate", "city", "company_name"),
    "salary": ("category_name", "seniority", "governorate", "salary_mid", "salary_currency"), "mode": ("work_mode", "employment_type"), "skill": ("skill_name", "skill_category", "category_name"),
}
_KEYS = tuple(dict.fromkeys(k for keys in GRAINS.values() for k in keys))
_PAY = ("salary_min", "salary_mid", "salary_max")
_SUMS = ("n", "remote", *[f"{kind}_{c}" for c in _PAY for kind in ("n", "sum")])


def base(jobs: DataFrame, job_skills: DataFrame | None = None, grains: tuple[str, ...] = tuple(GRAINS)) -> DataFrame:
    """(grain, keys, measures) of ``int_job_enriched``.  ``job_skills`` has job_key, skill_name and skill_category, as
    ``int_job_skills``; without it, or where its postings aren't among ``jobs``, there are no rows of skills."""
    with_skills = job_skills is not None and "skill" in grains
    rows = jobs.withColumn("dated", F.col("posted_date").isNotNull())
    kinds = {f.name: f.dataType for f in rows.schema} | ({f.name: f.dataType for f in job_skills.schema if f.name.startswith("skill_")} if with_skills else {"skill_name": "string", "skill_category": "string"})

    own = [g for g in grains if g != "skill"]
    if not own and not with_skills:
        raise ValueError("rows of skills need job_skills")
    read = dict.fromkeys([*(k for g in grains for k in GRAINS[g] if k in kinds and not k.startswith("skill_")), "is_remote", *_PAY, *(["job_key"] if with_skills else [])])
    rows = rows.select(*read)
    if len(own) + with_skills > 1:
        rows = files.kept(rows, "lattice-postings")
    measures = [F.count("*").alias("n"), F.count_if("is_remote").alias("remote")]
    for c in _PAY:
        measures += [F.count(c).alias(f"n_{c}"), F.sum(c).alias(f"sum_{c}")]
    measures += [F.min("salary_min").alias("least_salary_min"), F.max("salary_max").alias("most_salary_max")]

    def counted(grain: str, of: DataFrame) -> DataFrame:
        keys = [(F.col(k) if k in GRAINS[grain] else F.lit(None)).cast(kinds[k]).alias(k) for k in _KEYS]
        return of.groupBy(*GRAINS[grain]).agg(*measures).select(F.lit(grain).alias("grain"), *keys, *_SUMS, "least_salary_min", "most_salary_max")

    parts = [counted(g, rows.where("salary_mid is not null") if g == "salary" else rows) for g in own]
    if with_skills:
        parts.append(counted("skill", rows.join(job_skills.select("job_key", "skill_name", "skill_category").distinct(), "job_key")))
    return kept(functools.reduce(DataFrame.unionByName, parts)) if len(parts) > 1 else parts[0]


def merged(*bases: DataFrame) -> DataFrame:
    """The base of all postings, of bases of parts that share no posting."""
    rows = functools.reduce(DataFrame.unionByName, bases)
    kinds = {f.name: f.dataType for f in rows.schema}
    out = rows.groupBy("grain", *_KEYS).agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in _SUMS], F.min("least_salary_min").alias("least_salary_min"), F.max("most_salary_max").alias("most_salary_max"))
    return out.select(*rows.columns)


def kept(rows: DataFrame, path: str | None = None) -> DataFrame:
    """A base as Parquet with a folder per grain, of which a mart reads only its own; without a path in a new folder of the
    shared one."""
    path = path or files.scratch(rows.sparkSession, "lattice")
    rows.write.partitionBy("grain").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path).select(*rows.columns)  # columns of folders come last


def _mean(c: str) -> Column:
    return F.round(F.sum(f"sum_{c}") / F.nullif(F.sum(f"n_{c}"), F.lit(0)), 0)


def _grain(rows: DataFrame, grain: str) -> DataFrame:
    return rows.where(F.col("grain") == grain)


def _summed(rows: DataFrame, *keys: str) -> DataFrame:
    """Postings, remote ones and middles of salaries per group of the keys, in the base's columns."""
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("n", "remote", "n_salary_mid", "sum_salary_mid")])


def _postings() -> Column:
    return F.sum("n").alias("postings")


def _mid() -> Column:
    return _mean("salary_mid").alias("avg_salary_mid")


def _remote() -> Column:
    return F.sum("remote").alias("remote_postings")


def in_demand_roles(rows: DataFrame) -> DataFrame:
    pairs = _summed(_grain(rows, "demand"), "category_name", "company_name")
    return marts.ranked_roles(pairs.groupBy("category_name").agg(_postings(), F.count("company_name").alias("hiring_companies"), _mid(), _remote()))


def hiring_trends(rows: DataFrame) -> DataFrame:
    """The grain itself: a row of the base is a company of the group."""
    return _grain(rows, "demand").where("dated").groupBy(F.col("posted_year").alias("year"), F.col("posted_month").alias("month"), F.col("posted_month_name").alias("month_name"), "category_name").agg(
        _postings(), F.count("company_name").alias("hiring_companies"), _mid())


def _most(value: str) -> Column:
    """The most frequent value of the groups' rows, each of which is a value; of equals the smallest."""
    return F.min_by(value, F.when(F.col(value).isNotNull(), F.struct((-F.col("n")).alias("n"), F.col(value).alias("v"))))


def company_insights(rows: DataFrame) -> DataFrame:
    by_category = _summed(_grain(rows, "demand"), "company_name", "category_name").groupBy("company_name").agg(
        _postings(), F.count("category_name").alias("distinct_categories"), _mid(), _remote(), _most("category_name").alias("top_category"))
    by_place = _summed(_grain(rows, "place"), "company_name", "governorate").groupBy(F.col("company_name").alias("_name")).agg(
        F.count("governorate").alias("distinct_governorates"), _most("governorate").alias("top_governorate"))
    out = by_category.join(by_place, F.col("company_name").eqNullSafe(F.col("_name")))
    return marts.ranked_companies(out.select("company_name", "postings", "distinct_categories", "distinct_governorates", "avg_salary_mid", "remote_postings", "top_category", "top_governorate"))


def geographic_distribution(rows: DataFrame) -> DataFrame:
    """Cities and companies of a governorate are told apart by two marks of its rows: each is summed up on its own, then both
    together."""
    place = _grain(rows, "place")
    keys = ("region", "governorate")
    kinds = F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).cast("string").alias("value")) for c in ("city", "company_name")])
    values = place.select(*keys, F.explode(kinds).alias("v"), "n", "remote", "n_salary_mid", "sum_salary_mid")
    values = _summed(values, *keys, "v").withColumn("city", F.when(F.col("v.kind") == "city", F.col("v.value"))).withColumn("company", F.when(F.col("v.kind") == "company_name", F.col("v.value")))
    once = F.col("v.kind") == "city"  # a posting has a row of each kind
    for c in ("n", "remote", "n_salary_mid", "sum_salary_mid"):
        values = values.withColumn(c, F.when(once, F.col(c)))
    return marts.shared_places(values.groupBy(*keys).agg(_postings(), F.count("city").alias("cities"), F.count("company").alias("hiring_companies"), _mid(), _remote()))


def salary_intelligence(rows: DataFrame) -> DataFrame:
    keys, paid = ["category_name", "seniority", "governorate"], _grain(rows, "salary")
    out = paid.groupBy(*keys).agg(
        F.sum("n").alias("postings_with_salary"), F.round(F.min("least_salary_min"), 0).alias("salary_floor"), _mean("salary_min").alias("avg_salary_min"), _mean("salary_mid").alias("avg_salary_mid"),
        _mean("salary_max").alias("avg_salary_max"), F.round(F.max("most_salary_max"), 0).alias("salary_ceiling"), F.max("salary_currency").alias("currency"),
    )
    return marts.with_medians(out, marts.medians(paid, keys, "salary_mid", "n"))


def work_mode_breakdown(rows: DataFrame) -> DataFrame:
    facets = F.array(*[F.struct(F.lit(f).alias("facet"), F.col(f).alias("value")) for f in ("work_mode", "employment_type")])
    return marts.shared_facets(_grain(rows, "mode").select(F.explode(facets).alias("f"), "n").groupBy("f.facet", "f.value").agg(_postings()))


def skill_demand(rows: DataFrame) -> DataFrame:
    return marts.ranked_skills(_grain(rows, "skill").groupBy("skill_name", "skill_category", "category_name").agg(_postings()))


#: The grains that a mart is rolled up from.
NEEDS = {
    "in_demand_roles": ("demand",), "salary_intelligence": ("salary",), "skill_demand": ("skill",), "company_insights": ("demand", "place"), "geographic_distribution": ("place",), "hiring_trends": ("demand",),
    "work_mode_breakdown": ("mode",),
}


ROLL_UPS = {m.__name__: m for m in (in_demand_roles, salary_intelligence, skill_demand, company_insights, geographic_distribution, hiring_trends, work_mode_breakdown)}


def all_marts(rows: DataFrame) -> dict[str, DataFrame]:
    """All marts of a base, best of one that is ``kept``."""
    return {name: roll_up(rows) for name, roll_up in ROLL_UPS.items()}
