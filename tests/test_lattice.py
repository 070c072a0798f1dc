"""Marts of one base against the marts made one by one."""

import random

import pytest
from pyspark.sql import functions as F

from postlake.plans import lattice, marts
from tests.test_queries import rows_of

JOBS = (
    "job_key long, category_name string, company_name string, region string, governorate string, city string, seniority string, salary_min decimal(12,2), salary_mid decimal(14,2), salary_max decimal(12,2), "
    "salary_currency string, is_remote boolean, posted_date date, posted_year int, posted_month int, posted_month_name string, work_mode string, employment_type string"
)
SKILLS = "job_key long, skill_name string, skill_category string, category_name string"


def tables(spark, n, seed):
    """Postings with nulls in any column, one company and category of a third of them, ties; skills, some repeated, some of no
    posting."""
    rng = random.Random(seed)
    some = lambda *values: rng.choice([None, *values, *values])
    jobs, skills = [], []
    for k in range(n):
        hot = rng.random() < 0.35
        category, company = ("hot", "Hot") if hot else (some("a", "b"), some(*(f"c{i}" for i in range(n // 4 + 1))))
        low = rng.choice([None, rng.randint(1, 9) * 1000 + rng.choice([0, 0.5])])
        high = rng.choice([None, (low or 500) * 2])
        mid = (low + high) / 2 if low and high else low or high
        day = rng.choice([None, f"202{rng.randint(3, 4)}-0{rng.randint(1, 3)}-11"])
        when = (int(day[:4]), int(day[5:7]), "m" + day[5:7]) if day and rng.random() < 0.9 else (None, None, None)
        jobs.append((k, category, company, some("r"), some("g", "h"), some("x", "y", "z"), some("Senior"), low, mid, high, some("EGP", "USD"), rng.choice([None, True, False]), day, *when, some("on-site", "remote"), some("full-time")))
        skills += [(k, some("SQL", "Go", "Rust"), some("s"), category) for _ in range(rng.randint(0, 3))]
    jobs_rows = spark.createDataFrame(jobs and [tuple(str(v) if 7 <= i <= 9 and v is not None else v for i, v in enumerate(r)) for r in jobs], JOBS.replace("decimal(12,2)", "string").replace("decimal(14,2)", "string").replace("posted_date date", "posted_date string"))
    kinds = {"salary_min": "decimal(12,2)", "salary_mid": "decimal(14,2)", "salary_max": "decimal(12,2)", "posted_date": "date"}
    return jobs_rows.withColumns({c: F.col(c).cast(k) for c, k in kinds.items()}), spark.createDataFrame(skills, SKILLS)


def same(got, want):
    assert list(got) == ["in_demand_roles", "salary_intelligence", "skill_demand", "company_insights", "geographic_distribution", "hiring_trends", "work_mode_breakdown"] and set(got) == set(want)
    for name in want:
        assert got[name].columns == want[name].columns, name
        assert rows_of(got[name].collect()) == rows_of(want[name].collect()), name


@pytest.mark.parametrize("n, seed", [(0, 1), (1, 2), (60, 3), (400, 4)])
def test_marts_of_a_base(spark, tmp_path, n, seed):
    jobs, skills = tables(spark, n, seed)
    same(lattice.all_marts(lattice.kept(lattice.base(jobs, skills), str(tmp_path / "base"))), marts.all_marts(jobs, skills))


def test_bases_add_up(spark, tmp_path):
    """Bases of parts, merged in two steps, are the base of the whole, and give its marts."""
    jobs, skills = tables(spark, 150, 7)
    part = F.col("job_key") % 3
    bases = [lattice.kept(lattice.base(jobs.where(part == k), skills), str(tmp_path / f"day={k}")) for k in range(3)]
    out = lattice.merged(lattice.merged(bases[0], bases[1]), bases[2])
    whole = lattice.base(jobs, skills)
    assert out.schema.simpleString() == whole.schema.simpleString()
    assert rows_of(out.collect()) == rows_of(whole.collect())
    same(lattice.all_marts(out), marts.all_marts(jobs, skills))


def test_the_postings_are_scanned_once(spark, tmp_path):
    """One scan for all seven marts; a mart of the kept base reads its own grain's files only."""
    jobs, skills = tables(spark, 80, 5)
    jobs.write.parquet(str(tmp_path / "jobs"))
    jobs = spark.read.parquet(str(tmp_path / "jobs"))
    made = lattice.base(jobs, skills)
    assert made._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan  # rows are counted by hashing before the shuffle
    kept = lattice.kept(made, str(tmp_path / "base"))
    files = lattice.in_demand_roles(kept).inputFiles()
    scanned = lattice.in_demand_roles(kept)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(grain" in scanned and "(grain" in scanned
    assert files and any("grain=skill" in f for f in kept.inputFiles())


def test_parts_of_a_base(spark):
    """Only the grains that are asked for; without links no skills, and nothing to make of skills alone."""
    jobs, _ = tables(spark, 30, 6)
    assert {r.grain for r in lattice.base(jobs, None, ("mode", "place")).collect()} == {"mode", "place"}
    assert {r.grain for r in lattice.base(jobs).collect()} == {"demand", "place", "salary", "mode"}
    with pytest.raises(ValueError):
        lattice.base(jobs, None, ("skill",))
