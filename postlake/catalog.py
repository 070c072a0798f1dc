"""Queries of the library over the driver's tables, and their SQL.

``orders`` with customer, nation and region stand for postings, as a star schema: company is the customer, governorate the
nation, city and employment type the market segment, category the priority, work mode the status; titles go round a fixed
list.  Line items stand for the skills of postings, events for versions, runs and arrivals.  The queries of raw and cleaned
records, models and loads are in ``catalog_layers``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import reference as ref
from .functions import parse, text
from .operators import contract, load, quality, scd
from .plans import lattice, marts, models, serving
from .sources import files as file_source
from .streaming import incremental


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates as strings."""
    kinds = {T.DecimalType: "double", T.DateType: "string"}
    return df.select(*[F.col(f.name).cast(kinds[type(f.dataType)]).alias(f.name) if type(f.dataType) in kinds else F.col(f.name) for f in df.schema])


def star_schema(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The tables as a star schema: a fact per order, with the dimensions that the orders name."""
    o, c, n, r = (_table(spark, sf_dir, t) for t in ("orders", "customer", "nation", "region"))
    key, price = F.col("o_orderkey"), F.col("o_totalprice").cast("decimal(12,2)")
    title = F.element_at(F.array(*[F.lit(t) for t in ref.TITLES]), (key % len(ref.TITLES)).cast("int") + 1)
    places = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey).select("c_custkey", "c_name", "c_mktsegment", "n_name")  # 25 nations
    salary_min = F.when(key % 3 != 0, price)
    salary_max = F.when(key % 7 != 0, (salary_min * F.lit("1.2").cast("decimal(2,1)")).cast("decimal(12,2)"))
    none = lambda kind: F.lit(None).cast(kind)
    fact = o.join(places, o.o_custkey == places.c_custkey).select(
        key.alias("job_key"), F.md5(key.cast("string")).alias("job_hash"), key.cast("string").alias("source_job_id"), F.concat(F.lit("src"), (key % 4).cast("string")).alias("source_name"), F.col("c_name").alias("company_clean"),
        F.lit(1).alias("company_version"), load.surrogate_key(F.col("c_mktsegment"), F.col("n_name")).alias("location_key"), F.col("o_orderpriority").alias("category_name"), F.col("o_orderdate").cast("date").alias("posted_date"),
        F.col("o_orderdate").cast("date").alias("scraped_date"), title.alias("title_raw"), title.alias("title_clean"), salary_min.alias("salary_min"), salary_max.alias("salary_max"),
        F.when(key % 11 == 0, "USD").otherwise("EGP").alias("salary_currency"), none("string").alias("salary_period"), (key % 10).cast("short").alias("experience_years_min"), none("short").alias("experience_years_max"),
        F.when(key % 5 != 0, F.col("o_orderstatus") == "F").alias("is_remote"), F.when(key % 13 != 0, F.col("o_orderstatus")).alias("work_mode"), F.when(key % 17 != 0, F.col("c_mktsegment")).alias("employment_type"),
        F.concat(F.lit("https://x/"), key.cast("string")).alias("job_url"), F.lit("run").alias("run_id"), F.col("o_orderdate").cast("timestamp").alias("first_seen_at"), F.col("o_orderdate").cast("timestamp").alias("last_loaded_at"),
    )
    names = places.select(F.col("c_mktsegment").alias("location_city"), F.col("n_name").alias("location_gov")).distinct()
    return {
        "fact_job_postings": fact, "ref_governorate": n.join(r, n.n_regionkey == r.r_regionkey).select(F.col("n_name").alias("governorate"), F.col("r_name").alias("region")),
        "dim_company": c.select(F.col("c_name").alias("company_clean"), F.upper("c_name").alias("company_raw"), F.lit(1).alias("version"), F.lit("2024-01-01").cast("date").alias("valid_from"), none("date").alias("valid_to"), F.lit(True).alias("is_current")),
        "dim_location": names.withColumn("location_key", load.surrogate_key(F.col("location_city"), F.col("location_gov"))),
        "dim_source": spark.createDataFrame([(f"src{k}", f"Source {k}", f"https://src{k}") for k in range(4)], "source_name string, display_name string, base_url string"),
        "dim_job_category": o.select(F.col("o_orderpriority").alias("category_name")).distinct().withColumn("category_key", F.substring("category_name", 1, 1).cast("int")),
        "dim_date": load.upsert_date(None, o.select(F.col("o_orderdate").cast("date").alias("d"))),
        "dim_skill": _table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("skill_name")).agg(F.min("p_type").alias("skill_category")),
        "bridge_job_skill": _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("job_key"), "l_partkey").join(_table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")).select("job_key", F.col("p_brand").alias("skill_name")).distinct(),
    }


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enriched postings of the star schema."""
    return models.int_job_enriched(star_schema(spark, sf_dir)).withColumn("title", F.col("title_clean"))


def skill_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links dealt by posting among a fixed number of tasks: their rows are so alike that what Spark takes for one task's share,
    by compressed bytes, would be millions of them, which are then hashed in memory."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bridge = _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("job_key"), "l_partkey").repartition(tasks, "job_key").distinct()
    part = _table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("skill_name"), F.col("p_type").alias("skill_category"))
    return bridge.join(part, bridge.l_partkey == part.p_partkey).repartition(tasks, "job_key")


def job_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skill_links(spark, sf_dir).join(postings(spark, sf_dir).select("job_key", "category_name"), "job_key")


_TITLE_LIST = "[" + ", ".join("'" + t + "'" for t in ref.TITLES) + "]"

_SENIORITY_SQL = "CASE " + " ".join(f"WHEN {' OR '.join(f'contains(lower(title), {w!r})' for w in words)} THEN {name!r}" for name, words in ref.SENIORITIES) + " ELSE 'Unspecified' END"

POSTINGS = f"""
    p0 AS (SELECT o_orderkey AS job_key, {_TITLE_LIST}[o_orderkey % {len(ref.TITLES)} + 1] AS title, c_name AS company_name, n_name AS governorate, r_name AS region, c_mktsegment AS city, o_orderpriority AS category_name,
        CASE WHEN o_orderkey % 13 <> 0 THEN o_orderstatus ELSE 'on-site' END AS work_mode, CASE WHEN o_orderkey % 17 <> 0 THEN c_mktsegment ELSE 'full-time' END AS employment_type,
        o_orderkey % 5 <> 0 AND o_orderstatus = 'F' AS is_remote, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_totalprice AS DECIMAL(12,2)) END AS salary_min,
        CASE WHEN o_orderkey % 11 = 0 THEN 'USD' ELSE 'EGP' END AS salary_currency, CAST(o_orderdate AS DATE) AS posted_date, CAST(o_orderkey % 10 AS SMALLINT) AS experience_years_min
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
    p1 AS (SELECT *, CASE WHEN job_key % 7 <> 0 THEN CAST(salary_min * 1.2 AS DECIMAL(12,2)) END AS salary_max, {_SENIORITY_SQL} AS seniority FROM p0),
    postings AS (SELECT *, CASE WHEN salary_min IS NOT NULL AND salary_max IS NOT NULL THEN CAST(round(CAST(salary_min + salary_max AS DECIMAL(18,3)) * 0.5, 2) AS DECIMAL(14,2)) ELSE coalesce(salary_min, salary_max) END AS salary_mid,
        year(posted_date) AS posted_year, month(posted_date) AS posted_month, monthname(posted_date) AS posted_month_name FROM p1)"""

MEAN = "CAST(round(avg({0})) AS DOUBLE)"
M = MEAN.format("salary_mid")

MART_SQL = {
    "in_demand_roles": f"""SELECT *, CAST(round(100.0 * postings / sum(postings) OVER (), 2) AS DOUBLE) AS demand_share_pct, CAST(round(postings / hiring_companies, 2) AS DOUBLE) AS postings_per_company, rank() OVER (ORDER BY postings DESC) AS demand_rank
        FROM (SELECT category_name, count(*) AS postings, count(DISTINCT company_name) AS hiring_companies, {M} AS avg_salary_mid, count_if(is_remote) AS remote_postings FROM postings GROUP BY category_name)""",
    "salary_intelligence": f"""SELECT category_name, seniority, governorate, count(*) AS postings_with_salary, CAST(round(min(salary_min)) AS DOUBLE) AS salary_floor, {MEAN.format("salary_min")} AS avg_salary_min, {M} AS avg_salary_mid,
        {MEAN.format("salary_max")} AS avg_salary_max, CAST(round(max(salary_max)) AS DOUBLE) AS salary_ceiling, round_even(quantile_cont(CAST(salary_mid AS DOUBLE), 0.5), 0) AS median_salary_mid, max(salary_currency) AS currency
        FROM postings WHERE salary_mid IS NOT NULL GROUP BY category_name, seniority, governorate""",
    "company_insights": f"""SELECT company_name, count(*) AS postings, count(DISTINCT category_name) AS distinct_categories, count(DISTINCT governorate) AS distinct_governorates, {M} AS avg_salary_mid, count_if(is_remote) AS remote_postings,
        mode(category_name ORDER BY category_name) AS top_category, mode(governorate ORDER BY governorate) AS top_governorate, rank() OVER (ORDER BY count(*) DESC) AS hiring_rank FROM postings GROUP BY company_name""",
    "geographic_distribution": f"""SELECT region, governorate, count(*) AS postings, count(DISTINCT city) AS cities, count(DISTINCT company_name) AS hiring_companies, {M} AS avg_salary_mid, count_if(is_remote) AS remote_postings,
        CAST(round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS DOUBLE) AS postings_share_pct FROM postings GROUP BY region, governorate""",
    "hiring_trends": f"""SELECT posted_year AS year, posted_month AS month, posted_month_name AS month_name, category_name, count(*) AS postings, count(DISTINCT company_name) AS hiring_companies, {M} AS avg_salary_mid
        FROM postings WHERE posted_date IS NOT NULL GROUP BY posted_year, posted_month, posted_month_name, category_name""",
    "work_mode_breakdown": """SELECT *, CAST(round(100.0 * postings / sum(postings) OVER (PARTITION BY facet), 2) AS DOUBLE) AS share_pct FROM (
        SELECT 'work_mode' AS facet, work_mode AS value, count(*) AS postings FROM postings GROUP BY 2 UNION ALL SELECT 'employment_type', employment_type, count(*) FROM postings GROUP BY 2)""",
    "skill_demand": """SELECT *, rank() OVER (ORDER BY total_postings DESC, skill_name) AS overall_skill_rank FROM (
        SELECT *, CAST(sum(postings) OVER (PARTITION BY skill_name) AS BIGINT) AS total_postings FROM (
        SELECT p_brand AS skill_name, p_type AS skill_category, category_name, count(DISTINCT job_key) AS postings
        FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) JOIN part ON l_partkey = p_partkey JOIN postings ON job_key = l_orderkey GROUP BY 1, 2, 3))""",
}

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(sql: str | None = None, name: str | None = None):
    def add(f):
        QUERIES[name or f.__name__] = f
        if sql:
            ORACLE_SQL[name or f.__name__] = sql
        return f

    return add


def _add_marts() -> None:
    for mart, sql in MART_SQL.items():
        make = getattr(marts, mart)
        of = job_skills if mart == "skill_demand" else postings
        query(f"WITH {POSTINGS} {sql}", f"mart_{mart}")(lambda s, d, make=make, of=of: plain(make(of(s, d))))
        query(f"WITH {POSTINGS} {sql}", f"lattice_{mart}")(lambda s, d, mart=mart: plain(lattice.ROLL_UPS[mart](_lattice(s, d, lattice.NEEDS[mart]))))


def _lattice(spark: SparkSession, sf_dir: str, grains: tuple[str, ...]) -> DataFrame:
    """The base of the postings with those grains."""
    return lattice.base(postings(spark, sf_dir), skill_links(spark, sf_dir) if "skill" in grains else None, grains)


_add_marts()


def _mart(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES[f"mart_{name}"](spark, sf_dir)


def _served(name: str, order: str, where: str = "TRUE", tail: str = "LIMIT 100") -> str:
    return f"WITH {POSTINGS}, mart AS ({MART_SQL[name]}) SELECT * FROM mart WHERE {where} ORDER BY {order} {tail}"


@query(_served("salary_intelligence", "postings_with_salary DESC NULLS LAST, category_name, seniority, governorate", "seniority ILIKE '%sen%' AND governorate ILIKE '%1%'", "LIMIT 50 OFFSET 3"))
def serve_salary_intelligence(s, d):
    return serving.serve_salary_intelligence(_mart("salary_intelligence", s, d), None, "sen", "1", 50, 3)


@query(_served("in_demand_roles", "demand_rank, category_name"))
def serve_in_demand_roles(s, d):
    return serving.serve_in_demand_roles(_mart("in_demand_roles", s, d))


@query(_served("company_insights", "hiring_rank, company_name", "top_governorate ILIKE '%1%'"))
def serve_company_insights(s, d):
    return serving.serve_company_insights(_mart("company_insights", s, d), "1")


@query(_served("geographic_distribution", "postings DESC, region, governorate", "region ILIKE '%a%'"))
def serve_geographic_distribution(s, d):
    return serving.serve_geographic_distribution(_mart("geographic_distribution", s, d), "a")


@query(_served("skill_demand", "overall_skill_rank, skill_name, category_name, skill_category", "category_name ILIKE '%high%'"))
def serve_skill_demand(s, d):
    return serving.serve_skill_demand(_mart("skill_demand", s, d), "high")


@query(_served("hiring_trends", "year, month, category_name", "year = 1996", "LIMIT 500"))
def serve_hiring_trends(s, d):
    return serving.serve_hiring_trends(_mart("hiring_trends", s, d), None, 1996)


@query(_served("work_mode_breakdown", "postings DESC, facet, value", "facet ILIKE '%mode%'"))
def serve_work_mode_breakdown(s, d):
    return serving.serve_work_mode_breakdown(_mart("work_mode_breakdown", s, d), "mode")


@query(f"WITH {POSTINGS}, mart AS ({MART_SQL['geographic_distribution']}) SELECT coalesce(governorate, 'Unknown') AS governorate, CAST(sum(postings) AS BIGINT) AS postings FROM mart GROUP BY 1 ORDER BY postings DESC, 1 LIMIT 15")
def rollup_top_governorates(s, d):
    return serving.top_governorates(_mart("geographic_distribution", s, d))


@query(f"WITH {POSTINGS}, mart AS ({MART_SQL['skill_demand']}) SELECT skill_name, CAST(sum(postings) AS BIGINT) AS postings FROM mart GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15")
def rollup_top_skills(s, d):
    return serving.top_skills(_mart("skill_demand", s, d))


@query(f"WITH {POSTINGS}, mart AS ({MART_SQL['salary_intelligence']}) SELECT category_name, round(sum(coalesce(avg_salary_mid, 0)) / count(*)) AS avg_salary FROM mart GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 12")
def rollup_salary_by_category(s, d):
    return serving.salary_by_category(_mart("salary_intelligence", s, d))


_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(f"WITH {POSTINGS} SELECT posted_year AS year, posted_month AS month, left(any_value(posted_month_name), 3) || ' ' || CAST(posted_year AS VARCHAR) AS label, " + ", ".join(f"CAST(nullif(count_if(category_name = '{p}'), 0) AS BIGINT) AS \"{p}\"" for p in _PRIORITIES) + " FROM postings GROUP BY 1, 2")
def rollup_trend_pivot(s, d):
    return serving.trend_pivot(_mart("hiring_trends", s, d), _PRIORITIES)


@query(f"""WITH {POSTINGS}, r AS ({MART_SQL['in_demand_roles']}), b AS ({MART_SQL['work_mode_breakdown']})
    SELECT CAST((SELECT sum(postings) FROM r) AS BIGINT) AS total_postings, (SELECT category_name FROM r ORDER BY category_name = 'Other', postings DESC LIMIT 1) AS top_role,
    coalesce((SELECT share_pct FROM b WHERE facet = 'work_mode' AND value = 'F'), 0) AS remote_pct, coalesce((SELECT share_pct FROM b WHERE facet = 'employment_type' AND value = 'BUILDING'), 0) AS full_time_pct""")
def rollup_overview_kpis(s, d):
    b = _mart("work_mode_breakdown", s, d).replace({"F": "remote", "BUILDING": "full-time"}, subset=["value"])
    return serving.overview_kpis(_mart("in_demand_roles", s, d), b)


@query("SELECT DISTINCT n_name FROM nation")
def rollup_distinct_options(s, d):
    return serving.distinct_options(_table(s, d, "nation"), "n_name")


@query(f"WITH {POSTINGS} SELECT count(*) AS n, CAST(round(avg(salary_mid)) AS DOUBLE) AS mean, CAST(min(salary_min) AS DOUBLE) AS low, CAST(max(salary_max) AS DOUBLE) AS high FROM postings WHERE salary_min IS NOT NULL AND salary_max IS NOT NULL")
def rollup_salary_headline(s, d):
    return plain(serving.salary_headline(postings(s, d)))


@query("SELECT 'orders' AS layer, count(*) AS n_rows FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'events', count(*) FROM events")
def rollup_stage_volumes(s, d):
    return serving.layer_volumes({t: _table(s, d, t) for t in ("orders", "lineitem", "events")})


@query(f"WITH {POSTINGS} SELECT company_name, postings, avg_salary_mid FROM ({MART_SQL['company_insights']}) ORDER BY avg_salary_mid DESC NULLS LAST, company_name LIMIT 20")
def rollup_user_sort(s, d):
    return serving.user_sort(_mart("company_insights", s, d).select("company_name", "postings", "avg_salary_mid"), "avg_salary_mid", True, "company_name").limit(20)


# Scalar operators.

_STRIP = r"regexp_replace({0}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"


def _clean_sql(c: str) -> str:
    kept = rf"regexp_replace({c}, '[^\p{{L}}\p{{N}}_\s\p{{Z}}.()/,\-]', '', 'g')"
    return _STRIP.format(rf"regexp_replace({kept}, '[\s\p{{Z}}]+', ' ', 'g')")


@query(rf"SELECT doc_id, {_clean_sql('text')} AS cleaned FROM documents")
def text_clean(s, d):
    return _table(s, d, "documents").select("doc_id", text.clean_text(F.col("text"), html=False).alias("cleaned"))


_LABELLED = "CASE doc_id % 4 WHEN 0 THEN 'Urgent Hiring: Remote ' WHEN 1 THEN 'Senior (A) [x] ' WHEN 2 THEN 'HYBRID immediate ' ELSE '' END || text"


def _labelled(s, d):
    head = F.when(F.col("doc_id") % 4 == 0, "Urgent Hiring: Remote ").when(F.col("doc_id") % 4 == 1, "Senior (A) [x] ").when(F.col("doc_id") % 4 == 2, "HYBRID immediate ").otherwise("")
    return _table(s, d, "documents").select("doc_id", F.concat(head, "text").alias("t"))


def _noise_sql(c: str) -> str:
    c = rf"regexp_replace(regexp_replace({c}, '\([^\n]*\)', '', 'g'), '\[[^\n]*\]', '', 'g')"
    for w in ref.TITLE_NOISE:
        c = f"regexp_replace({c}, '(?i){w}', '', 'g')"
    return _clean_sql(c)


@query(f"SELECT doc_id, {_noise_sql('t')} AS title FROM (SELECT doc_id, {_LABELLED} AS t FROM documents)")
def text_strip_title_noise(s, d):
    return _labelled(s, d).select("doc_id", text.strip_title_noise(F.col("t"), html=False).alias("title"))


def _rules_sql(c: str, rules, default: str) -> str:
    return "CASE " + " ".join(f"WHEN {' OR '.join(f'contains({c}, ' + chr(39) + w + chr(39) + ')' for w in words)} THEN '{name}'" for name, words in rules) + f" ELSE {default} END"


@query(f"SELECT doc_id, {_rules_sql('lower(t)', ref.WORK_MODES, repr('on-site'))} AS work_mode, {_rules_sql('lower(t)', ref.EMPLOYMENT_TYPES, repr('full-time'))} AS employment_type FROM (SELECT doc_id, {_LABELLED} || CASE doc_id % 5 WHEN 0 THEN ' intern' WHEN 1 THEN ' part time' WHEN 2 THEN ' عقد' ELSE '' END AS t FROM documents)")
def text_classify(s, d):
    more = F.when(F.col("doc_id") % 5 == 0, " intern").when(F.col("doc_id") % 5 == 1, " part time").when(F.col("doc_id") % 5 == 2, " عقد").otherwise("")
    t = F.concat("t", more)
    return _labelled(s, d).select("doc_id", text.classify_work_mode(t).alias("work_mode"), text.classify_employment_type(t).alias("employment_type"))


def _skill_sql(words) -> str:
    alternatives = []
    for w in words:
        quoted = "".join(ch if ch.isalnum() or ch == " " else "\\" + ch for ch in w)
        alternatives.append(f"(^|[^a-z0-9]){quoted}" + ("" if w in ref.OPEN_ENDED else "($|[^a-z0-9])"))
    return "|".join(alternatives)


@query(f"WITH {POSTINGS} SELECT job_key, array_to_string(list_filter([" + ", ".join(f"CASE WHEN regexp_matches(lower(title || ' ' || skill_text), '{_skill_sql(w)}') THEN '{n}' END" for n, _, w in ref.SKILLS) + "], lambda x: x IS NOT NULL), '|') AS skills FROM (SELECT *, CASE job_key % 5 WHEN 0 THEN 'C++/C#, SQL and Go' WHEN 1 THEN 'PostgreSQL, Spring Boot' WHEN 2 THEN 'REST; good k8s' ELSE '' END AS skill_text FROM postings)")
def text_extract_skills(s, d):
    more = F.when(F.col("job_key") % 5 == 0, "C++/C#, SQL and Go").when(F.col("job_key") % 5 == 1, "PostgreSQL, Spring Boot").when(F.col("job_key") % 5 == 2, "REST; good k8s").otherwise("")
    return postings(s, d).select("job_key", F.array_join(text.extract_skills(F.col("title"), more), "|").alias("skills"))


_SCORES = ", ".join("{'score': " + " + ".join(f"CAST(contains(lower(title), '{w}') AS INT)" for w in words) + f", 'rank': {-k}, 'name': '{n}'" + "}" for k, (n, words) in enumerate(ref.CATEGORIES) if words)


@query(f"WITH {POSTINGS} SELECT job_key, CASE WHEN b.score > 0 THEN b.name ELSE 'Other' END AS category, seniority FROM (SELECT job_key, seniority, list_max([{_SCORES}]) AS b FROM postings)")
def text_categorize(s, d):
    return postings(s, d).select("job_key", text.categorize(F.col("title")).alias("category"), "seniority")


@query(f"WITH {POSTINGS} SELECT job_key, md5(lower(trim(title)) || '|' || lower(trim(company_name)) || '|' || lower(trim(city))) AS job_hash, md5(title || '-' || company_name || '-' || city) AS job_id, "
       "CASE WHEN length(company_name) > 16 THEN left(company_name, 14) || '…' ELSE company_name END AS label, left(posted_month_name, 3) || ' ' || CAST(posted_year AS VARCHAR) AS month_label FROM postings")  # fmt: skip
def text_hashes_and_labels(s, d):
    return postings(s, d).select("job_key", text.job_hash(F.col("title"), F.col("company_name"), F.col("city")).alias("job_hash"), contract.job_id(F.col("title"), F.col("company_name"), F.col("city")).alias("job_id"),
        text.short_label(F.col("company_name"), 16, 14).alias("label"), text.month_label(F.col("posted_month_name"), F.col("posted_year")).alias("month_label"))


_PLACES = ["Maadi, Cairo", "New Cairo,Cairo,Egypt", "السادس من اكتوبر، الجيزة", "مدينة السادات، المنوفية", "Port Said", "", "10th of Ramadan City", "مدينة نصر"]


@query("SELECT c_custkey, " + _rules_sql("lower(loc)", [(c, (w,)) for w, c, _ in ref.LOCATIONS], "'Unknown'") + " AS city, " + _rules_sql("lower(loc)", [(g, (w,)) for w, _, g in ref.LOCATIONS], "'Egypt'") + " AS governorate FROM (SELECT c_custkey, [" + ", ".join(f"'{p}'" for p in _PLACES) + "][c_custkey % 8 + 1] AS loc FROM customer)")
def text_normalize_location(s, d):
    loc = F.element_at(F.array(*[F.lit(p) for p in _PLACES]), (F.col("c_custkey") % 8).cast("int") + 1)
    place = text.normalize_location(loc)
    return _table(s, d, "customer").select("c_custkey", place["city"].alias("city"), place["governorate"].alias("governorate"))


@query("""SELECT o_orderkey, n[1] AS salary_min, coalesce(n[2], n[1]) AS salary_max, CASE WHEN contains(t, '$') THEN 'USD' ELSE 'EGP' END AS currency,
    CASE WHEN contains(t, 'hour') THEN 'hourly' WHEN contains(t, 'month') THEN 'monthly' END AS period FROM (
    SELECT o_orderkey, t, list_transform(regexp_extract_all(replace(t, ',', ''), '[0-9.]+'), lambda x: CAST(x AS DOUBLE)) AS n FROM (
    SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'egp ' || CAST(o_orderkey AS VARCHAR) || ' - ' || CAST(o_orderkey + 500 AS VARCHAR) || ' / month' WHEN 2 THEN '$1,' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') || '.5 hourly'
    ELSE 'negotiable' END AS t FROM orders))""")  # fmt: skip
def parse_salary(s, d):
    k = F.col("o_orderkey")
    t = F.when(k % 4 == 0, "").when(k % 4 == 1, F.concat(F.lit("EGP "), k.cast("string"), F.lit(" - "), (k + 500).cast("string"), F.lit(" / month"))).when(k % 4 == 2, F.concat(F.lit("$1,"), F.lpad((k % 1000).cast("string"), 3, "0"), F.lit(".5 hourly"))).otherwise("Negotiable")
    p = parse.parse_salary(t)
    return _table(s, d, "orders").select("o_orderkey", p["min"].alias("salary_min"), p["max"].alias("salary_max"), p["currency"].alias("currency"), p["period"].alias("period"))


@query("SELECT o_orderkey, y[1] AS years_min, y[2] AS years_max FROM (SELECT o_orderkey, list_filter(list_transform(regexp_extract_all(CAST(o_orderkey % 60 AS VARCHAR) || ' - ' || CAST(o_orderkey % 15 AS VARCHAR) || ' yrs since 2024', '[0-9]+'), lambda x: CAST(x AS INT)), lambda x: x <= 50) AS y FROM orders)")
def parse_experience(s, d):
    k = F.col("o_orderkey")
    p = parse.parse_experience(F.concat((k % 60).cast("string"), F.lit(" - "), (k % 15).cast("string"), F.lit(" yrs since 2024")))
    return _table(s, d, "orders").select("o_orderkey", p["min"].alias("years_min"), p["max"].alias("years_max"))


@query("""SELECT o_orderkey, strftime(CASE o_orderkey % 4 WHEN 0 THEN CAST(o_orderdate AS TIMESTAMP) - to_days(CAST(o_orderkey % 40 AS INT)) WHEN 1 THEN CAST(o_orderdate AS TIMESTAMP) - to_hours(CAST(o_orderkey % 40 AS INT))
    WHEN 2 THEN CAST(o_orderdate AS TIMESTAMP) - to_days(CAST(30 * (o_orderkey % 5) AS INT)) ELSE CAST(o_orderdate AS TIMESTAMP) END, '%Y-%m-%d') AS posted_at FROM orders""")
def parse_posted_date(s, d):
    k = F.col("o_orderkey")
    t = F.when(k % 4 == 0, F.concat((k % 40).cast("string"), F.lit(" days ago"))).when(k % 4 == 1, F.concat((k % 40).cast("string"), F.lit(" hours ago"))).when(k % 4 == 2, F.concat((k % 5).cast("string"), F.lit(" months ago"))).otherwise("just now")
    at = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    return _table(s, d, "orders").select("o_orderkey", parse.parse_posted_date(t, at)["value"].alias("posted_at"))


@query("SELECT DISTINCT year(x) * 10000 + month(x) * 100 + day(x) AS date_key, CAST(x AS VARCHAR) AS full_date, year(x) AS year, quarter(x) AS quarter, month(x) AS month, monthname(x) AS month_name, day(x) AS day, isodow(x) AS day_of_week, dayname(x) AS day_name, week(x) AS week_of_year, isodow(x) IN (5, 6) AS is_weekend "
       "FROM (SELECT CAST(o_orderdate AS DATE) AS x FROM orders UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem)")  # fmt: skip
def date_dimension(s, d):
    dates = _table(s, d, "orders").select(F.col("o_orderdate").cast("date").alias("a"), F.lit(None).cast("date").alias("b")).unionByName(_table(s, d, "lineitem").select(F.lit(None).cast("date").alias("a"), F.col("l_shipdate").cast("date").alias("b")))
    return plain(load.upsert_date(None, dates))


@query("""SELECT event_id, CASE WHEN t IN ('', 'nan', 'none', 'null') THEN NULL ELSE TRY_CAST(t AS DOUBLE) END AS num, CAST(trunc(CASE WHEN t IN ('', 'nan', 'none', 'null') THEN NULL ELSE TRY_CAST(t AS DOUBLE) END) AS INT) AS whole,
    t IN ('1', 'yes', 'true', 't') AS flag FROM (SELECT event_id, ['1', 'yes', 'nan', '', '12.7', 'abc', 't'][event_id % 7 + 1] AS t FROM events)""")
def lenient_casts(s, d):
    t = F.element_at(F.array(*[F.lit(x) for x in ("1", "yes", "nan", "", "12.7", "abc", "t")]), (F.col("event_id") % 7).cast("int") + 1)
    return _table(s, d, "events").select("event_id", parse.to_num(t).alias("num"), parse.to_int(t).alias("whole"), parse.to_bool(t).alias("flag"))


@query("SELECT doc_id, array_to_string(list_filter([CASE WHEN e = 0 THEN 'missing field: job_url' END, CASE WHEN e = 1 THEN 'record has neither title nor company' END], lambda x: x IS NOT NULL), '|') AS violations FROM (SELECT doc_id, doc_id % 3 AS e FROM documents)")
def contract_check(s, d):
    docs = _table(s, d, "documents")
    raw = docs.select("doc_id", *[F.when((F.col("doc_id") % 3 == 0) & F.lit(c == "job_url"), F.lit(None).cast("string")).when((F.col("doc_id") % 3 == 1) & F.lit(c in ("title", "company")), "N/A").otherwise("x").alias(c) for c in ref.CONTRACT_FIELDS])
    return raw.select("doc_id", F.array_join(contract.contract_violations(raw), "|").alias("violations"))


@query("SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN CAST(o_orderkey AS VARCHAR) || ' - 9 EGP / monthly' ELSE '9' END AS salary FROM orders")
def format_salary(s, d):
    k = F.col("o_orderkey")
    low = F.when(k % 3 == 1, k)
    high = F.when(k % 3 != 0, F.lit(9))
    return _table(s, d, "orders").select("o_orderkey", contract.format_salary(low, high, F.when(k % 3 != 2, "EGP"), F.when(k % 3 != 2, "monthly")).alias("salary"))


# Keys, versions, loads.


@query("SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1")
def keep_first(s, d):
    return contract.keep_first(_table(s, d, "events").select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["ts", "event_id"]).drop("ts")


@query("SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def dedupe_last_wins(s, d):
    return contract.keep_last(_table(s, d, "events").select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["ts", "event_id"]).drop("ts")


@query("SELECT user_id, event_id FROM events WHERE (user_id, event_type) NOT IN (SELECT user_id, event_type FROM events WHERE ts < TIMESTAMP '2024-01-08')")
def drop_seen(s, d):
    events = _table(s, d, "events")
    seen = events.where(F.col("ts") < F.lit("2024-01-08").cast("timestamp_ntz"))
    return contract.drop_seen(events.select("user_id", "event_type", "event_id"), seen, ["user_id", "event_type"]).select("user_id", "event_id")


_VERSIONS = """v AS (SELECT *, CAST(sum(CASE WHEN prev IS DISTINCT FROM event_type OR first THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INT) AS version FROM (
    SELECT user_id, event_id, ts, event_type, lag(event_type) OVER w AS prev, row_number() OVER w = 1 AS first FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)))"""


@query(f"WITH {_VERSIONS} SELECT user_id, version, any_value(event_type) AS event_type, version = max(version) OVER (PARTITION BY user_id) AS is_current FROM v GROUP BY user_id, version")
def scd2_dimension(s, d):
    rows = _table(s, d, "events").select("user_id", "event_type", "ts", "event_id")
    dim, _ = scd.scd2_dimension(rows, "user_id", "event_type", ["ts", "event_id"], F.lit("2024-02-01").cast("date"), part=F.to_date("ts"))
    return dim.select("user_id", "version", "event_type", "is_current")


@query(f"WITH {_VERSIONS} SELECT event_id, version FROM v")
def scd2_fact_versions(s, d):
    return scd.versions(_table(s, d, "events").select("user_id", "event_type", "ts", "event_id"), "user_id", "event_type", ["ts", "event_id"], F.to_date("ts")).select("event_id", "version")


@query("""SELECT c_custkey, c_mktsegment, CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to, is_current FROM (
    SELECT c_custkey, c_mktsegment, DATE '2024-01-01' AS valid_from, CASE WHEN c_custkey % 5 = 0 THEN DATE '2024-02-01' END AS valid_to, c_custkey % 5 <> 0 AS is_current FROM customer WHERE c_custkey % 3 <> 0
    UNION ALL SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'NEW' ELSE c_mktsegment END, DATE '2024-02-01', NULL, TRUE FROM customer WHERE c_custkey % 3 = 0 OR c_custkey % 5 = 0)""")
def snapshot(s, d):
    c = _table(s, d, "customer").select("c_custkey", "c_mktsegment")
    old = c.where("c_custkey % 3 <> 0").withColumns({"valid_from": F.lit("2024-01-01").cast("date"), "valid_to": F.lit(None).cast("date"), "is_current": F.lit(True)})
    new = c.withColumn("c_mktsegment", F.when(F.col("c_custkey") % 5 == 0, "NEW").otherwise(F.col("c_mktsegment")))
    return plain(scd.snapshot(old, new, "c_custkey", ["c_mktsegment"], F.lit("2024-02-01").cast("date")))


_UPSERT = """SELECT coalesce(o.o_orderkey, n.o_orderkey) AS o_orderkey, coalesce(n.status, o.status) AS status, coalesce(o.first_seen, n.first_seen) AS first_seen,
    CASE WHEN o.o_orderkey IS NULL THEN 'inserted' WHEN n.o_orderkey IS NULL THEN 'kept' ELSE 'updated' END AS _change
    FROM (SELECT o_orderkey, 'old' || o_orderstatus AS status, 1 AS first_seen FROM orders WHERE o_orderkey % 3 <> 1) o FULL JOIN (SELECT o_orderkey, o_orderstatus AS status, 2 AS first_seen FROM orders WHERE o_orderkey % 3 <> 0) n ON o.o_orderkey = n.o_orderkey"""


@query(_UPSERT)
def upsert_fact(s, d):
    o = _table(s, d, "orders")
    old = o.where("o_orderkey % 3 <> 1").select("o_orderkey", F.concat(F.lit("old"), "o_orderstatus").alias("status"), F.lit(1).alias("first_seen"))
    new = o.where("o_orderkey % 3 <> 0").select("o_orderkey", F.col("o_orderstatus").alias("status"), F.lit(2).alias("first_seen"))
    return load.upsert_fact(old, new, "o_orderkey", ("first_seen",))


@query("SELECT l_orderkey, l_partkey FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem WHERE l_orderkey % 3 = 0 UNION ALL SELECT DISTINCT l_orderkey, l_partkey + 1 FROM lineitem WHERE l_orderkey % 3 <> 0)")
def replace_by_key(s, d):
    links = _table(s, d, "lineitem").select("l_orderkey", "l_partkey")
    new = links.where("l_orderkey % 3 <> 0").select("l_orderkey", (F.col("l_partkey") + 1).alias("l_partkey"))
    return load.replace_by_key(links.where("l_orderkey % 3 <> 1").distinct(), new, new, ["l_orderkey"])


@query("SELECT DISTINCT c_mktsegment, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def upsert_dim_location(s, d):
    rows = _table(s, d, "customer").join(_table(s, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_mktsegment").alias("location_city"), F.col("n_name").alias("location_gov"))
    gold = load.empty_gold(s)
    dim, _ = load.upsert_location(gold["dim_location"], gold["ref_governorate"], rows)
    return dim.select(F.col("location_city").alias("c_mktsegment"), F.col("location_gov").alias("n_name"))


# Quality.


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 1")
def quality_unique(s, d):
    return quality.not_unique(_table(s, d, "orders"), "o_custkey")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey <> 3)")
def quality_relationships(s, d):
    """Orders of customers that a dimension without one nation lacks."""
    return quality.orphans(_table(s, d, "orders"), "o_custkey", _table(s, d, "customer").where("c_nationkey <> 3"), "c_custkey").select("o_orderkey", "o_custkey")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('F', 'O')")
def quality_accepted_values(s, d):
    return quality.not_accepted(_table(s, d, "orders"), "o_orderstatus", ["F", "O"]).select("o_orderkey", "o_orderstatus")


@query("""SELECT 'not_null' AS check_name, 'o_orderkey' AS column_name, count(*) AS violations FROM orders WHERE o_orderkey IS NULL UNION ALL
    SELECT 'range', 'l_tax', count(*) FROM lineitem WHERE l_tax < l_discount UNION ALL SELECT 'relationships', 'l_orderkey', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 0)""")
def quality_suite(s, d):
    o, li = _table(s, d, "orders"), _table(s, d, "lineitem")
    return quality.dq_suite([
        ("not_null", "o_orderkey", quality.is_null(o, "o_orderkey")), ("range", "l_tax", quality.out_of_range(li, "l_discount", "l_tax")),
        ("relationships", "l_orderkey", quality.orphans(li, "l_orderkey", o.where("o_orderkey % 2 = 0"), "o_orderkey")),
    ])


@query("""SELECT 'positive' AS check_name, 'l_quantity' AS column_name, count(*) FILTER (l_quantity > 25) AS violations FROM lineitem UNION ALL SELECT 'range', 'l_tax', count(*) FILTER (l_tax < l_discount) FROM lineitem
    UNION ALL SELECT 'accepted', 'l_returnflag', count(*) FILTER (l_returnflag NOT IN ('A', 'N')) FROM lineitem""")
def quality_table_checks(s, d):
    """Three checks in one scan."""
    return quality.table_checks(_table(s, d, "lineitem"), [("positive", "l_quantity", F.col("l_quantity") > 25), ("range", "l_tax", F.col("l_tax") < F.col("l_discount")), ("accepted", "l_returnflag", ~F.col("l_returnflag").isin("A", "N"))])


@query("SELECT count(*) AS written, count(*) FILTER (o_totalprice > 100000) AS large, count(*) FILTER (o_orderstatus = 'F') AS done, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders")
def quality_written_with_checks(s, d):
    """Counts taken while a table is written, beside a sum over what was written."""
    path = file_source.scratch(s, "checked")
    seen = quality.written_with_checks(_table(s, d, "orders"), path, [("large", "o_totalprice", F.col("o_totalprice") > 100000), ("done", "o_orderstatus", F.col("o_orderstatus") == "F")])
    return s.read.parquet(path).agg(F.sum("o_orderkey").alias("keys")).select(F.lit(seen["rows"]).cast("long").alias("written"), *[F.lit(seen[k]).cast("long").alias(k) for k in ("large", "done")], "keys")


@query("SELECT avg(CAST(event_type = 'click' AS INT)) AS coverage FROM events")
def quality_coverage(s, d):
    return quality.coverage(_table(s, d, "events"), F.col("event_type") == "click")


@query("""SELECT o_orderkey, array_to_string(list_filter([CASE WHEN o_orderkey % 5 = 0 THEN 'Missing required field: title_clean' END, CASE WHEN o_orderkey % 7 = 0 THEN 'Missing required field: job_url' END,
    CASE WHEN CAST(o_orderdate AS DATE) > DATE '1996-01-01' THEN 'Posted date is in the future' END, CASE WHEN o_orderkey % 3 = 0 THEN 'salary_max is less than salary_min' END, CASE WHEN o_orderkey % 7 = 0 THEN 'Invalid job_url format' END], lambda x: x IS NOT NULL), '|') AS errors FROM orders""")
def quality_validate_row(s, d):
    k = F.col("o_orderkey")
    rows = _table(s, d, "orders").select("o_orderkey", *[F.lit("x").alias(c) for c in ref.REQUIRED_FIELDS if c not in ("title_clean", "job_url", "posted_at")], F.when(k % 5 == 0, "").otherwise("t").alias("title_clean"),
        F.when(k % 7 == 0, "").otherwise("https://x").alias("job_url"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("posted_at"), F.lit(5.0).alias("salary_min"), F.when(k % 3 == 0, 4.0).otherwise(6.0).alias("salary_max"))
    return rows.select("o_orderkey", F.array_join(quality.validation_errors(F.lit("1996-01-01").cast("date")), "|").alias("errors"))


# Files and streams.


@query("SELECT CAST(o_orderkey AS VARCHAR) AS job_id, CAST(i AS INT) AS _ordinal, o_orderkey % 10 = 7 AS _broken, o_orderpriority AS title, 'src' || CAST(o_orderkey % 4 AS VARCHAR) AS source, '2024-01-02' AS _date "
       "FROM (SELECT *, unnest([0, 1]) AS i FROM orders WHERE o_orderkey % 10 <> 7) UNION ALL "
       "SELECT NULL, NULL, TRUE, NULL, 'src' || CAST(o_orderkey % 4 AS VARCHAR), '2024-01-02' FROM orders WHERE o_orderkey % 10 = 7")  # fmt: skip
def parse_bronze(s, d):
    """A raw file of two records per order; every tenth is cut off."""
    key = F.col("o_orderkey").cast("string")
    record = F.struct(key.alias("job_id"), F.col("o_orderpriority").alias("title"))
    value = F.to_json(F.array(record, record))
    value = F.when(F.col("o_orderkey") % 10 == 7, "[{").otherwise(value)
    path = F.concat(F.lit("raw/src"), (F.col("o_orderkey") % 4).cast("string"), F.lit("/2024-01-02/jobs_"), key, F.lit(".json"))
    return file_source.parse_bronze(_table(s, d, "orders").select(value.alias("value"), path.alias("_file"))).select("job_id", "_ordinal", "_broken", "title", "source", "_date")


@query("SELECT o_orderkey, o_orderpriority AS _file FROM orders WHERE o_orderpriority NOT IN (SELECT o_orderpriority FROM orders WHERE o_orderpriority < '3')")
def new_files_only(s, d):
    rows = _table(s, d, "orders").select("o_orderkey", F.col("o_orderpriority").alias("_file"))
    log = rows.where(F.col("_file") < "3").select(F.col("_file").alias("file_path"))
    return file_source.new_files_only(rows, log).select("o_orderkey", "_file")


@query("SELECT o_orderpriority AS _file, count(*) AS records, count(*) FILTER (o_totalprice > 100000) AS valid, count(*) FILTER (NOT o_totalprice > 100000) AS quarantined FROM orders GROUP BY ROLLUP (o_orderpriority)")
def run_report(s, d):
    return file_source.run_report(_table(s, d, "orders").select(F.col("o_orderpriority").alias("_file"), (F.col("o_totalprice") > 100000).alias("is_valid")))


@query("WITH dim AS (SELECT DISTINCT lower(p_type) AS skill_name FROM part WHERE p_type < 'M') SELECT skill_name FROM dim UNION ALL "
       "SELECT DISTINCT p_type FROM part WHERE lower(p_type) NOT IN (SELECT skill_name FROM dim)")  # fmt: skip
def upsert_dim_skill(s, d):
    part = _table(s, d, "part")
    dim = part.where("p_type < 'M'").select(F.lower("p_type").alias("skill_name")).distinct()
    return load.upsert_skill(dim, part.select(F.array("p_type").alias("skills")))


@query("SELECT DISTINCT event_type AS source, CAST(user_id AS VARCHAR) AS job_id FROM events")
def stream_drop_seen(s, d):
    """Ids per source over two incremental runs of the file source, the second with the files that came after the first."""
    events = _table(s, d, "events").select(F.col("event_type").alias("source"), F.col("user_id").cast("string").alias("job_id"), (F.col("event_id") % 2).alias("run"))
    root = file_source.scratch(s, "stream")
    for run in (0, 1):
        events.where(F.col("run") == run).drop("run").write.mode("append").parquet(f"{root}/in")
        fresh = s.readStream.schema("source string, job_id string").parquet(f"{root}/in")
        incremental.run_available(incremental.drop_seen_stream(fresh), f"{root}/state", lambda df, n: df.write.mode("overwrite").parquet(f"{root}/out/batch={n}"))
    return s.read.parquet(f"{root}/out").select("source", "job_id")


@query("SELECT event_type AS source, CAST(user_id AS VARCHAR) AS job_id, event_id AS first_event FROM events QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id % 3, event_id) = 1")
def stream_seen_table(s, d):
    """First records of ids over three runs, with the ids of earlier runs in a table; the last run is repeated."""
    events = _table(s, d, "events").select(F.col("event_type").alias("source"), F.col("user_id").cast("string").alias("job_id"), "event_id", (F.col("event_id") % 3).alias("run"))
    root = file_source.scratch(s, "seen")
    seen = incremental.SeenTable(f"{root}/ids", ["source", "job_id"], buckets=8)
    for number in (0, 1, 2, 2):
        fresh = seen.fresh(events.where(F.col("run") == number), number, ["event_id"])
        fresh.write.mode("overwrite").parquet(f"{root}/out/batch={number}")
        seen.add(s.read.parquet(f"{root}/out/batch={number}"), number)
    return s.read.parquet(f"{root}/out").select("source", "job_id", F.col("event_id").alias("first_event"))
