"""The jobs end to end on small fixtures."""

import json

import pytest
from pyspark.sql import functions as F

from postlake.operators import contract, load, quality, scd
from postlake.plans import marts, models, serving
from postlake.sources import files, pages
from postlake.streaming import incremental

def as_of():
    return F.lit("2026-06-08").cast("date")



def record(**more):
    base = {"job_id": "1", "title": "Senior Data Engineer", "company": "Acme", "location": "Maadi, Cairo", "salary": "EGP 10,000 - 20,000", "description": "Python and SQL", "experience": "3-5 years", "posted_at_raw": "2 days ago",
            "industry": "IT", "job_url": "https://x/1", "source": "wuzzuf", "scraped_at": "2026-06-07T10:00:00", "run_id": "r1"}
    return base | more


def write(root, name, rows):
    folder = root / "wuzzuf" / "2026-06-07"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps(rows), encoding="utf-8")


def test_bronze_to_marts(spark, tmp_path):
    raw = tmp_path / "raw"
    write(raw, "a.json", [record(), record(job_id="2", title="QA Tester", company="Beta", salary="Competitive."), record(job_id="3", title="", company="", job_url="")])
    write(raw, "b.json", [record(job_id="4", title="Data Analyst", company="Acme", job_url="ftp://x")])
    (raw / "wuzzuf" / "2026-06-07" / "broken.json").write_text("[{")
    bronze = files.scan_bronze(spark, str(raw))
    assert bronze.where("_broken").count() == 1
    valid, failed, rejected = incremental.clean_batch(bronze, as_of())
    assert [r.job_id for r in valid.collect()] == ["1"]
    assert sorted((r.job_id or "", r.clean_error) for r in rejected.collect()) == [("", "the file isn't an array of records"), ("2", "salary isn't a number"), ("3", "record has neither title nor company")]
    assert {r.job_id: r.validation_errors for r in failed.collect()} == {"4": "Invalid job_url format"}
    row = valid.first()
    assert (row.title_clean, row.location_gov, row.posted_at, row.skills, row.salary_min, row.experience_years_min) == ("Senior Data Engineer", "Cairo", "2026-06-05", ["Python", "SQL"], 10000.0, 3)

    at, day = F.lit("2026-06-08 00:00:00").cast("timestamp"), F.lit("2026-06-08").cast("date")
    valid.write.parquet(str(tmp_path / "silver"))
    silver = spark.read.parquet(str(tmp_path / "silver"))
    gold = load.save(load.load(load.empty_gold(spark), silver, day, at), str(tmp_path / "gold" / "v=1"))
    forced = load.load(gold, silver, day, at, reload=True)
    for g in (gold, forced):
        assert {t: g[t].count() for t in ("fact_job_postings", "bridge_job_skill", "dim_company", "etl_load_log")} == {"fact_job_postings": 1, "bridge_job_skill": 2, "dim_company": 1, "etl_load_log": 1}
    assert load.load(gold, silver, day, at)["fact_job_postings"].count() == 1
    jobs = models.int_job_enriched(gold)
    assert jobs.select("region", "seniority", "posted_year").first() == ("Greater Cairo", "Senior", 2026)
    made = marts.all_marts(jobs, models.int_job_skills(gold, jobs))
    assert {k: m.count() for k, m in made.items()} == {"in_demand_roles": 1, "salary_intelligence": 1, "skill_demand": 2, "company_insights": 1, "geographic_distribution": 1, "hiring_trends": 1, "work_mode_breakdown": 2}


def test_incremental_runs(spark, tmp_path):
    raw, out = tmp_path / "raw", {k: str(tmp_path / k) for k in ("silver", "quarantine", "rejects", "checkpoint")}
    write(raw, "a.json", [record()])
    run = lambda: incremental.incremental_clean(spark, str(raw), out["silver"], out["quarantine"], out["rejects"], out["checkpoint"], as_of())
    run()
    run()
    assert spark.read.parquet(out["silver"]).count() == 1
    write(raw, "b.json", [record(job_id="9", company="Gamma")])
    run()
    assert sorted(r.job_id for r in spark.read.parquet(out["silver"]).collect()) == ["1", "9"]


def test_versions(spark):
    rows = spark.createDataFrame([("Fawry", "Fawry", 1), ("Fawry", "Fawry for Banking Technology", 2), ("Fawry", "Fawry", 3)], "company_clean string, company_raw string, n int")
    dim, keyed = scd.scd2_dimension(rows, "company_clean", "company_raw", ["n"], F.lit("2026-06-08").cast("date"))
    assert [(r.version, r.is_current) for r in dim.orderBy("version").collect()] == [(1, False), (2, False), (3, True)]
    assert [r.version for r in keyed.orderBy("n").collect()] == [1, 2, 3]
    same, _ = scd.scd2_dimension(rows.where("n = 3"), "company_clean", "company_raw", ["n"], F.lit("2026-06-09").cast("date"), dim)
    assert same.count() == 3 and same.where("is_current").first().version == 3
    new, _ = scd.scd2_dimension(rows.where("n = 2"), "company_clean", "company_raw", ["n"], F.lit("2026-06-09").cast("date"), dim)
    assert [(r.version, r.is_current) for r in new.orderBy("version").collect()] == [(1, False), (2, False), (3, False), (4, True)]


def test_skill_rank_counts_rows(spark):
    totals = [(".NET", 1, 4), ("Flutter", 1, 4), ("Laravel", 1, 3), ("Oracle", 1, 3), ("Angular", 1, 2), ("Java", 2, 1), ("Python", 2, 1)]
    rows, k = [], 0
    for name, cats, n in totals:
        for c in range(cats):
            for _ in range(n):
                rows.append((name, "x", f"c{c}", k))
                k += 1
    out = marts.skill_demand(spark.createDataFrame(rows, "skill_name string, skill_category string, category_name string, job_key int"))
    assert sorted(r.overall_skill_rank for r in out.collect()) == [1, 2, 3, 4, 5, 6, 6, 8, 8]


def test_shares(spark):
    jobs = [("Other", f"c{k % 75}", k) for k in range(107)] + [("Rest", "d", 200 + k) for k in range(44)]
    df = spark.createDataFrame(jobs, "category_name string, company_name string, k int").withColumns({"salary_mid": F.lit(1).cast("decimal(12,2)"), "is_remote": F.lit(False)})
    row = marts.in_demand_roles(df).where("category_name = 'Other'").first()
    assert (float(row.demand_share_pct), float(row.postings_per_company)) == (70.86, 1.43)


def test_validation_messages(spark):
    base = {c: "x" for c in ("job_id", "job_hash", "title_clean", "company_clean", "location_city", "location_gov", "source", "scraped_at", "run_id")} | {"job_url": "http://x", "posted_at": "2026-06-07", "salary_min": 5.0, "salary_max": 10.0}
    changes = [{"title_clean": " "}, {"job_url": ""}, {"posted_at": ""}, {"posted_at": "2026-06-09"}, {"salary_min": 10.0, "salary_max": 5.0}, {}]
    df = spark.createDataFrame([{**base, **c, "k": k} for k, c in enumerate(changes)])
    got = [r[1] for r in df.select("k", quality.validation_errors(as_of())).orderBy("k").collect()]
    assert got == [["Missing required field: title_clean"], ["Missing required field: job_url", "Invalid job_url format"], ["Missing required field: posted_at", "Invalid date format in posted_at"],
                   ["Posted date is in the future"], ["salary_max is less than salary_min"], []]


def test_pages(spark):
    listing = '<h2 class="css-193uk2c"><a href="/j/1">Dev &amp; Ops</a></h2><h2 class="css-193uk2c">Second</h2><a class="css-ipsyv7"> Acme </a>'
    df = spark.createDataFrame([(1, listing), (2, None), (3, "<p>none")], "page_id long, html string")
    got = pages.parse_listing_pages(df, "wuzzuf").orderBy("page_id", "ordinal").collect()
    assert [(r.title, r.company, r.location, r.job_url, r.source) for r in got] == [("Dev & Ops", "Acme", "", "https://wuzzuf.net/j/1", "wuzzuf"), ("Second", "", "", "", "wuzzuf")]
    assert pages.parse_listing_pages(df, "bayt").count() == pages.parse_listing_pages(df, "forasna").count() == 0
    html = "<h2>Job Description</h2><style>x</style><p>Do <b>things</b></p><h3>Other</h3><p>no</p><div><h4> Skills And Tools </h4><ul><li>a<li>b</ul></div><p>nor this</p><h2>JOB REQUIREMENTS</h2><p>no</p>"
    df = spark.createDataFrame([(1, html), (2, None)], "page_id long, html string")
    assert [r.sections for r in pages.extract_sections(df).orderBy("page_id").collect()] == ["Do things a b", ""]
    assert len(pages.sections_of("<h2>Job Description</h2><p>" + "x" * 3000)) == 2500


def test_paging_bounds(spark):
    df = spark.range(5).withColumnRenamed("id", "n")
    assert [r.n for r in serving.serve(df, ["n"], limit=2, skip=2).collect()] == [2, 3]
    for limit, skip in ((0, 0), (1001, 0), (1, -1)):
        with pytest.raises(ValueError, match="limit"):
            serving.page_bounds(limit, skip)


def test_contract(spark):
    df = contract.to_contract(spark.createDataFrame([(" Dev ", None, "", "nan")], "title string, company string, location string, salary string"))
    row = df.first()
    assert (row.title, row.company, row.location, row.salary, len(df.columns)) == ("Dev", "N/A", "N/A", "", 13)
    seen = contract.add_seen(df, df.select("source", "job_id").limit(0))
    assert contract.drop_seen(df, seen).count() == 0 and contract.drop_seen(df, seen, incremental=False).count() == 1


def test_versions_over_parts(spark):
    """A frequent key, a null key and null values against a walk over the rows; a load that goes on from the last version."""
    rows = [(("hot" if k % 4 else None) if k % 3 else "b", ["x", None, "y", "x"][(k * k // 7) % 4], k // 9, k) for k in range(120)]
    df = spark.createDataFrame(rows, "company string, raw string, file int, n int")
    want, last = {}, {"hot": (1, "x")}
    counts = {"hot": 1}
    for company, raw, _, n in rows:
        if company not in last or last[company][1] != raw:
            counts[company] = counts.get(company, 0) + 1
            last[company] = (counts[company], raw)
        want[n] = counts[company]
    old = spark.createDataFrame([("hot", "x", None, None, True, 1)], "company string, raw string, valid_from date, valid_to date, is_current boolean, version int")
    dim, keyed = scd.scd2_dimension(df, "company", "raw", ["file", "n"], as_of(), old)
    assert {r.n: r.version for r in keyed.where("company is not null").collect()} == {n: v for n, v in want.items() if rows[n][0] is not None}
    assert {r.company: r.version for r in dim.where("is_current").collect()} == counts
    assert dim.count() == sum(counts.values())
    plain = {r.n: r.version for r in scd.versions(df.where("company is null"), "company", "raw", ["file", "n"]).collect()}
    assert plain == {n: v for n, v in want.items() if rows[n][0] is None}


def test_csv_rows_and_spelling_of_skills(spark, tmp_path):
    """CSV rows, with a byte order mark: an empty list of skills is none, a missing column means those of the title."""
    names = ["job_id", "job_hash", "title_raw", "title_clean", "company_raw", "company_clean", "location_raw", "location_city", "location_gov", "salary_min", "salary_max", "salary_currency", "experience_years_min", "experience_years_max",
             "is_remote", "source", "job_url", "scraped_at", "posted_at", "run_id"]
    row = ["1", "h1", "Python Dev", "Python Dev", "Acme", "Acme", "x", "Cairo", "Cairo", "5", "", "EGP", "2.0", "", "true", "s", "https://x", "2024-01-02", "2024-01-01", "r"]
    day, at = F.lit("2024-01-03").cast("date"), F.lit("2024-01-03 00:00:00").cast("timestamp")
    for folder, more, value in (("listed", ["skills"], "PYTHON|python| Zig |zig"), ("empty", ["skills"], ""), ("missing", [], None)):
        (tmp_path / folder).mkdir()
        line = ",".join([*row, *([value] if more else [])])
        (tmp_path / folder / "a.csv").write_text("\ufeff" + ",".join([*names, *more]) + "\n" + line + "\n", encoding="utf-8")
        silver = files.scan_silver_csv(spark, str(tmp_path / folder), tuple(names))
        gold = load.load(load.empty_gold(spark), silver, day, at)
        want = {"listed": ["Python", "Zig"], "empty": [], "missing": ["Python"]}[folder]
        assert sorted(r.skill_name for r in gold["bridge_job_skill"].collect()) == want
        assert gold["bridge_job_skill"].join(gold["dim_skill"], "skill_name").count() == len(want)
        fact = gold["fact_job_postings"].first()
        assert (float(fact.salary_min), fact.salary_max, fact.experience_years_min, fact.is_remote, fact.category_name) == (5.0, None, 2, True, "Other")
    with pytest.raises(ValueError, match="missing columns: nothing"):
        files.scan_silver_csv(spark, str(tmp_path / "listed"), ("nothing",))


def test_preview(spark):
    assert files.preview(spark.range(30)).count() == 10 and files.preview(spark.range(3), 5).count() == 3


def test_run_log(spark):
    runs = spark.createDataFrame([("a", "1", "out", None, None), ("a", "2", "out", None, None), ("b", "3", None, "switched off", None), ("c", "4", None, None, "timeout")], "source string, run_id string, output string, skipped string, error string")
    records = spark.createDataFrame([("a", "1"), ("a", "1")], "source string, run_id string")
    got = {r.run_id: (r.status, r.records, r.output, r.detail) for r in files.ingestion_log(records, runs, F.lit("t")).collect()}
    assert got == {"1": ("ok", 2, "out", ""), "2": ("empty", 0, None, ""), "3": ("skipped", 0, None, "switched off"), "4": ("error", 0, None, "timeout")}


def test_reports_of_batches(spark, tmp_path):
    raw, out = tmp_path / "raw", {k: str(tmp_path / k) for k in ("silver", "quarantine", "rejects", "checkpoint", "report")}
    write(raw, "a.json", [record(), record(job_id="2", job_url="ftp://x"), record(job_id="3", salary="1.2.3")])
    incremental.incremental_clean(spark, str(raw), out["silver"], out["quarantine"], out["rejects"], out["checkpoint"], as_of(), out["report"])
    got = {r._file is None: (r.records, r.valid, r.quarantined) for r in spark.read.schema("_file string, records bigint, valid bigint, quarantined bigint").json(f"{out['report']}/batch=0").collect()}
    assert got == {True: (3, 1, 2), False: (3, 1, 2)}
