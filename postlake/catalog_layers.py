"""Queries of the layers over the driver's tables, and their SQL: stored pages and raw files, contract, cleaning, gates, sinks,
staging and intermediate models, and the load of standardised rows."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import reference as ref
from .catalog import M, MART_SQL, POSTINGS, _clean_sql, _noise_sql, _rules_sql, _skill_sql, _table, _VERSIONS, job_skills, plain, postings, query, skill_links, star_schema
from .functions import sql, text
from .operators import clean, contract, load, quality, scd
from .operators.store import Store
from .plans import lattice, marts, models, serving
from .sources import files, pages
from .streaming import incremental


def _texts(*values: str) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _pick(key: str, values: tuple[str, ...]):
    """The value at the key's place in a list that goes round."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.col(key) % len(values)).cast("int") + 1)


def _rows_sql(columns: dict[str, str], source: str = "orders") -> str:
    return "SELECT " + ", ".join(f"{v} AS {k}" for k, v in columns.items()) + f" FROM {source}"


# Stored pages.


def _key():
    return F.col("o_orderkey").cast("string")


def _pages(s: SparkSession, d: str, *parts) -> DataFrame:
    """A page per order, put together from strings and columns.  A few MB of orders, which Spark reads in a task or two, give
    some hundred times as much html: they are dealt out first."""
    html = F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    orders = _table(s, d, "orders").repartition(int(s.conf.get("spark.sql.shuffle.partitions")), "o_orderkey")
    return orders.select(F.col("o_orderkey").alias("page_id"), html.alias("html"))


@query("SELECT o_orderkey AS page_id, CAST(i AS INT) AS ordinal, CASE i WHEN 0 THEN 'Dev & ' || o_orderpriority ELSE 'Second' END AS title, CASE i WHEN 0 THEN 'C' || CAST(o_custkey AS VARCHAR) ELSE '' END AS company, "
       "CASE i WHEN 0 THEN o_orderstatus ELSE '' END AS location, CASE i WHEN 0 THEN 'https://wuzzuf.net/j/' || CAST(o_orderkey AS VARCHAR) ELSE '' END AS job_url FROM orders, (SELECT unnest([0, 1]) AS i)")  # fmt: skip
def parse_listing_wuzzuf(s, d):
    """Lists by position: two titles, one company and one location."""
    df = _pages(s, d, '<div><h2 class="css-193uk2c x"><a href="/j/', _key(), '">Dev &amp; ', F.col("o_orderpriority"), '</a></h2><a class="css-ipsyv7">C', F.col("o_custkey").cast("string"), '</a><span class="css-16x61xq"> ',
                F.col("o_orderstatus"), ' </span><br><h2 class="css-193uk2c">Second</h2></div>')
    return pages.parse_listing_pages(df, "wuzzuf").select("page_id", "ordinal", "title", "company", "location", "job_url")


@query("SELECT o_orderkey AS page_id, CAST(0 AS INT) AS ordinal, 'T' || o_orderpriority AS title, 'C' || CAST(o_custkey AS VARCHAR) AS company, o_orderstatus || ', Egypt' AS location, 'a b' AS description, 'EGP 5' AS salary, "
       "'Mid - 3 years' AS experience, '2 days ago' AS posted_at_raw, CASE WHEN o_orderkey % 2 = 0 THEN 'https://www.bayt.com/' ELSE 'http://z/' END || CAST(o_orderkey AS VARCHAR) AS job_url FROM orders")  # fmt: skip
def parse_listing_bayt(s, d):
    """Cards, of which one without an address fails."""
    href = F.when(F.col("o_orderkey") % 2 == 0, "/").otherwise("http://z/")
    df = _pages(s, d, '<ul><li class="has-pointer-d a"><h2><a href="', href, _key(), '">T', F.col("o_orderpriority"), '</a></h2><div class="job-company-location-wrapper"><i><a>not</a></i><b>C', F.col("o_custkey").cast("string"),
                '</b></div><div class="t-mute t-small"><a class="t-mute">', F.col("o_orderstatus"), '</a><a class="t-mute">Egypt</a></div><div class="jb-descr">Summary: <p>a</p><p>b</p></div><dt class="jb-label-salary">EGP 5',
                '<dt class="jb-label-careerlevel">Mid · 3 years</dt><div class="jb-date"><span>2 days ago</span></div><li class="has-pointer-d"><h2><a>no address</a></h2></ul>')
    return pages.parse_listing_pages(df, "bayt").drop("source")


@query("SELECT o_orderkey AS page_id, CAST(0 AS INT) AS ordinal, 'T' || o_orderpriority AS title, 'C' || CAST(o_custkey AS VARCHAR) AS company, o_orderstatus AS location, '9000' AS salary, "
       "CASE o_orderkey % 3 WHEN 0 THEN 'https://forasna.com' WHEN 1 THEN 'https://forasna.com/x' ELSE 'http://y' END AS job_url FROM orders")  # fmt: skip
def parse_listing_forasna(s, d):
    """The other places of a field where the first is missing; a salary by its heading."""
    href = F.when(F.col("o_orderkey") % 3 == 0, "").when(F.col("o_orderkey") % 3 == 1, "/x").otherwise("http://y")
    title = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("<span>T"), "o_orderpriority", F.lit("</span>"))).otherwise(F.concat(F.lit("T"), "o_orderpriority"))
    df = _pages(s, d, '<div class="result-wrp"><h2 class="job-title"><a href="', href, '">', title, '</a></h2><span class="company-name">C', F.col("o_custkey").cast("string"),
                '</span><div class="location-mobile"><span class="location"><span>', F.col("o_orderstatus"), '</span></span></div><div class="job-details"><span class="job-details__title">x</span><span>no</span></div>'
                '<div class="job-details"><span class="job-details__title">الراتب</span><span>9000</span></div></div>')  # fmt: skip
    return pages.parse_listing_pages(df, "forasna").select("page_id", "ordinal", "title", "company", "location", "salary", "job_url")


_BAYT_PAGE = ('<ul><li class="has-pointer-d"><h2><a href="/', '">T', '</a></h2><div class="job-company-location-wrapper"><b>C', '</b></div></li><li class="has-pointer-d"><h2><a href="/x">Second</a></h2></li></ul>')


@query("SELECT o_orderkey AS page_id, CAST(i AS INT) AS ordinal, CASE i WHEN 0 THEN 'T' || o_orderpriority ELSE 'Second' END AS title, CASE i WHEN 0 THEN 'C' || CAST(o_custkey AS VARCHAR) ELSE '' END AS company, 'https://www.bayt.com/' || CASE i WHEN 0 THEN CAST(o_orderkey AS VARCHAR) ELSE 'x' END AS job_url, 'bayt' AS source "
       "FROM orders, (SELECT unnest([0, 1]) AS i)")  # fmt: skip
def parse_listing_sql(s, d):
    """A listing parsed by a table function in SQL."""
    pages.register_table_functions(s)
    a, b, c, e = _BAYT_PAGE
    _pages(s, d, a, _key(), b, F.col("o_orderpriority"), c, F.col("o_custkey").cast("string"), e).createOrReplaceTempView("postlake_pages")
    return s.sql("SELECT page_id, l.ordinal, l.title, l.company, l.job_url, l.source FROM postlake_pages, LATERAL parse_listing(html, 'bayt') l")


@query("SELECT o_orderkey AS page_id, 'Do ' || o_orderpriority AS sections FROM orders")
def extract_sections_sql(s, d):
    pages.register_table_functions(s)
    _pages(s, d, "<h2>Job Description</h2><p>Do ", F.col("o_orderpriority"), "</p>").createOrReplaceTempView("postlake_section_pages")
    return s.sql("SELECT page_id, x.sections FROM postlake_section_pages, LATERAL extract_sections(html) x")


_ROLES = ("Software", "Sales", "Data Entry")


@query(f"SELECT page_id, ordinal, title, company, location, salary, industry, job_url, source FROM (SELECT o_orderkey AS page_id, CAST(0 AS INT) AS ordinal, 'Job ' || o_orderpriority AS title, 'C' || CAST(o_custkey AS VARCHAR) AS company, o_orderstatus AS location, "
       f"CASE WHEN o_orderkey % 2 = 0 THEN '5 - 9 EGP' ELSE '5' END AS salary, {_texts(*_ROLES)}[o_orderkey % 3 + 1] AS industry, 'https://www.jobzella.com' AS job_url, 'jobzella' AS source FROM orders) "
       "WHERE " + " OR ".join(f"contains(lower(title || ' ' || industry), '{w}')" for w in ref.TECH_WORDS))  # fmt: skip
def parse_embedded_json(s, d):
    """Technical jobs of a script in the page."""
    even = F.col("o_orderkey") % 2 == 0
    job = F.struct(
        F.struct(F.concat(F.lit("Job "), "o_orderpriority").alias("name")).alias("position"), F.struct(_pick("o_orderkey", _ROLES).alias("name")).alias("jobRole"), F.struct(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("title")).alias("company"),
        F.col("o_orderstatus").alias("location"), F.lit(5).alias("min_salary"), F.when(even, 9).alias("max_salary"), F.when(even, "EGP").alias("currency"),
    )
    body = F.to_json(F.struct(F.struct(F.struct(F.array(job).alias("jobs")).alias("pageProps")).alias("props")))
    return pages.parse_embedded_json(_pages(s, d, '<html><script id="__NEXT_DATA__" type="application/json">', body, "</script></html>"))


@query("SELECT o_orderkey AS page_id, CASE WHEN o_orderkey % 2 = 0 THEN 'Do ' || o_orderpriority || ' and more list' ELSE '' END AS sections FROM orders")
def extract_sections(s, d):
    """What stands beside a heading of exactly that text, up to the next heading; other case is another heading."""
    heading = F.when(F.col("o_orderkey") % 2 == 0, "Job Description").otherwise("job description")
    df = _pages(s, d, "<div><h2>", heading, "</h2><style>p{}</style><p>Do ", F.col("o_orderpriority"), " <b>and</b> more</p><ul><li>list</li></ul><h3>Other</h3><p>no</p></div><p>nor this</p>")
    return pages.extract_sections(df)


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN '<' || coalesce(text, '') ELSE 'a & b' || coalesce(text, '') END AS stripped FROM (SELECT doc_id, replace(replace(text, '<', ''), '&', '') AS text FROM documents)")
def text_strip_html(s, d):
    """Fragments lose tags and their references are decoded; a text with < alone stays."""
    body = F.coalesce(F.replace(F.replace("text", F.lit("<"), F.lit("")), F.lit("&"), F.lit("")), F.lit(""))
    body = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("<"), F.replace(body, F.lit(">"), F.lit("")))).otherwise(F.concat(F.lit("<p class='x'>a &amp; b</p>"), body))
    return _table(s, d, "documents").select("doc_id", text.strip_html(body).alias("stripped"))


# Raw files, sinks and logs.


def _raw(s: SparkSession, d: str) -> DataFrame:
    """Records with the contract's fields, made of orders."""
    key = F.col("o_orderkey").cast("string")
    made = {"job_id": key, "title": F.col("o_orderpriority"), "company": F.concat(F.lit("C"), F.col("o_custkey").cast("string")), "location": F.lit("Maadi, Cairo"), "source": F.concat(F.lit("src"), (F.col("o_orderkey") % 4).cast("string")), "run_id": F.lit("r1")}
    return _table(s, d, "orders").select(*[made.get(c, F.lit("x")).alias(c) for c in ref.CONTRACT_FIELDS])


@query("SELECT CAST(o_orderkey AS VARCHAR) AS job_id, o_orderpriority AS title, 'src' || CAST(o_orderkey % 4 AS VARCHAR) AS source, '2024-01-02' AS scrape_date FROM orders")
def sink_bronze(s, d):
    """Written as JSON under source and date, and read back."""
    root = files.scratch(s, "bronze")
    files.write_bronze(_raw(s, d).withColumn("scrape_date", F.lit("2024-01-02")), root)
    return s.read.json(root).select("job_id", "title", "source", F.col("scrape_date").cast("string").alias("scrape_date"))


@query("SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'quarantine' ELSE 'silver' END AS layer, 'src' || CAST(o_orderkey % 4 AS VARCHAR) AS source, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY 1, 2")
def sink_layers(s, d):
    """Valid and failed rows in two trees; without failed rows there is one."""
    root = files.scratch(s, "layers")
    rows = _raw(s, d)
    bad = F.col("job_id").cast("long") % 3 == 0
    files.write_layers(rows.where(~bad), rows.where(bad), f"{root}/silver", f"{root}/quarantine")
    read = [s.read.parquet(f"{root}/{layer}").select(F.lit(layer).alias("layer"), "source", "job_id") for layer in ("silver", "quarantine")]
    return read[0].unionByName(read[1]).groupBy("layer", "source").agg(F.count("*").alias("n"), F.sum(F.col("job_id").cast("long")).alias("keys"))


@query("SELECT o_orderpriority AS _file, count(*) AS records, count(*) FILTER (o_totalprice > 100000) AS valid, count(*) FILTER (NOT o_totalprice > 100000) AS quarantined FROM orders GROUP BY ROLLUP (o_orderpriority)")
def sink_run_report(s, d):
    """The report as JSON lines, read back."""
    path = files.scratch(s, "report")
    files.write_run_report(_table(s, d, "orders").select(F.col("o_orderpriority").alias("_file"), (F.col("o_totalprice") > 100000).alias("is_valid")), path)
    return s.read.schema("_file string, records bigint, valid bigint, quarantined bigint").json(path)


@query("""SELECT src AS source, 'r' || CAST(k AS VARCHAR) AS run_id, CASE WHEN k = 4 THEN 'error' WHEN k = 3 THEN 'skipped' WHEN n > 0 THEN 'ok' ELSE 'empty' END AS status, n AS records, CASE WHEN n > 0 THEN 'out' END AS output,
    CASE k WHEN 4 THEN 'timeout' WHEN 3 THEN 'off' ELSE '' END AS detail FROM (SELECT k, src, count(o_orderkey) AS n FROM (SELECT unnest([0, 1, 2, 3, 4]) AS k, 'src' AS src) LEFT JOIN orders ON o_orderkey % 2 = k GROUP BY k, src)""")  # fmt: skip
def sink_ingestion_log(s, d):
    """A line per run: with records, without, skipped, failed; appended as JSON in two calls."""
    path = files.scratch(s, "ingestion-log")
    runs = s.createDataFrame([("src", f"r{k}", "out", "off" if k == 3 else None, "timeout" if k == 4 else None) for k in range(5)], "source string, run_id string, output string, skipped string, error string")
    records = _table(s, d, "orders").select(F.lit("src").alias("source"), F.concat(F.lit("r"), (F.col("o_orderkey") % 2).cast("string")).alias("run_id"))
    for part in ("run_id < 'r2'", "run_id >= 'r2'"):
        files.append_ingestion_log(files.ingestion_log(records, runs.where(part), F.lit("2024-01-02T00:00:00")), path)
    return s.read.schema("source string, run_id string, status string, records bigint, output string, detail string").json(path)


@query(f"WITH {POSTINGS} SELECT category_name, count(*) AS postings, count(DISTINCT company_name) AS hiring_companies, {M} AS avg_salary_mid FROM postings GROUP BY category_name")
def sink_export_csv(s, d):
    """A mart as one CSV file with a header, read back."""
    path = files.scratch(s, "mart-csv")
    mart = plain(marts.in_demand_roles(postings(s, d))).select("category_name", "postings", "hiring_companies", "avg_salary_mid")
    files.export_csv(mart, path)
    return s.read.option("header", True).schema(mart.schema).csv(path)


@query("SELECT 'view' AS kind, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders UNION ALL SELECT 'table', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM orders WHERE o_orderkey % 2 = 0")
def sink_materialize(s, d):
    """Models as views, marts as tables."""
    orders, root = _table(s, d, "orders").select("o_orderkey"), files.scratch(s, "marts")
    files.materialize({"postlake_orders_view": orders})
    files.materialize({"even": orders.where("o_orderkey % 2 = 0")}, root)
    count = lambda df, kind: df.agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys")).select(F.lit(kind).alias("kind"), "n", "keys")
    return count(s.table("postlake_orders_view"), "view").unionByName(count(s.read.parquet(f"{root}/even"), "table"))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS job_id, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderpriority || ', \"a\"' || chr(10) || 'b' END AS title, '007' AS salary_min FROM orders")
def scan_silver_csv(s, d):
    """CSV with quotes, line ends and empty fields: strings stay what they are."""
    root = files.scratch(s, "silver-csv")
    key = F.col("o_orderkey")
    rows = _table(s, d, "orders").select(key.cast("string").alias("job_id"), F.when(key % 3 == 0, "").otherwise(F.concat("o_orderpriority", F.lit(', "a"\nb'))).alias("title"), F.lit("007").alias("salary_min"))
    rows.write.option("header", True).option("escape", '"').option("emptyValue", "").csv(f"{root}/a/b")
    return files.scan_silver_csv(s, root, ("job_id", "title")).select("job_id", "title", "salary_min")


@query("SELECT o_orderpriority AS layer, 'src' || CAST(o_orderkey % 4 AS VARCHAR) AS source, count(*) AS n_rows FROM orders GROUP BY 1, 2")
def rollup_source_volumes(s, d):
    rows = _table(s, d, "orders").withColumn("source", F.concat(F.lit("src"), (F.col("o_orderkey") % 4).cast("string")))
    return serving.source_volumes({p: rows.where(F.col("o_orderpriority") == p) for p in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")})


@query("SELECT CAST(o_orderkey AS VARCHAR) AS job_id, CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS INT) AS _ordinal, FALSE AS _broken, o_orderpriority || ' {\"[' AS title, 'src' AS source, '2024-01-02' AS _date FROM orders")
def scan_large_bronze(s, d):
    """One array of all orders in one file, read in chunks of 64 kB."""
    root = files.scratch(s, "large")
    record = F.to_json(F.struct(F.col("o_orderkey").cast("string").alias("job_id"), F.concat("o_orderpriority", F.lit(' {"[')).alias("title")))
    lines = _table(s, d, "orders").select(F.lit(1).alias("k"), "o_orderkey", F.concat(record, F.lit(",")).alias("value"))
    ends = s.createDataFrame([(0, 0, "["), (2, 0, '{"job_id": "last"}]')], "k int, o_orderkey bigint, value string")
    lines.unionByName(ends).repartition(1).sortWithinPartitions("k", "o_orderkey").select("value").write.text(f"{root}/text")
    from_name, to = s._jvm.org.apache.hadoop.fs.Path(f"{root}/text"), s._jvm.org.apache.hadoop.fs.Path(f"{root}/raw/src/2024-01-02/all.json")
    fs = to.getFileSystem(s._jsc.hadoopConfiguration())
    fs.mkdirs(to.getParent())
    fs.rename(next(f.getPath() for f in fs.listStatus(from_name) if f.getPath().getName().startswith("part-")), to)
    return files.scan_large_bronze(s, f"{root}/raw", 1 << 16).where("job_id <> 'last'").select("job_id", "_ordinal", "_broken", "title", "source", "_date")


# The contract.

_DIRTY = ("  Dev ", "nan", "", "NaN", "QA")


@query("SELECT o_orderkey, CASE WHEN t IN ('nan', '', 'NaN') THEN 'N/A' ELSE trim(t) END AS title, 'C' AS company, 'N/A' AS location, CASE WHEN t IN ('nan', 'NaN') THEN '' ELSE trim(t) END AS salary, '' AS description, "
       f"md5(CASE WHEN t IN ('nan', '', 'NaN') THEN 'N/A' ELSE trim(t) END || '-C-N/A') AS job_id, 13 AS n_columns FROM (SELECT o_orderkey, {_texts(*_DIRTY)}[o_orderkey % 5 + 1] AS t FROM orders)")  # fmt: skip
def to_contract(s, d):
    t = _pick("o_orderkey", _DIRTY)
    raw = _table(s, d, "orders").select(F.col("o_orderkey").alias("_ordinal"), t.alias("title"), F.lit(" C ").alias("company"), F.lit(None).cast("string").alias("location"), t.alias("salary"))
    out = contract.to_contract(raw)
    return out.select(F.col("_ordinal").alias("o_orderkey"), "title", "company", "location", "salary", "description", "job_id", F.lit(len(out.columns) - 1).alias("n_columns"))


@query("SELECT doc_id, lang FROM documents WHERE " + " OR ".join(f"contains(lower(coalesce(text, '') || ' ' || lang), '{w}')" for w in ref.TECH_WORDS))
def tech_only(s, d):
    docs = _table(s, d, "documents").select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("title"), F.col("lang").alias("industry"))
    return contract.tech_only(docs).select("doc_id", "lang")


@query("SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS place FROM events QUALIFY place <= 300")
def cap_rows(s, d):
    """The first rows in order of arrival (a limit is what this operator is)."""
    rows = contract.cap_rows(_table(s, d, "events").select("event_id", "ts"), 300, ["ts", "event_id"])
    return rows.select("event_id", F.expr("row_number() OVER (ORDER BY ts, event_id)").alias("place"))


@query("SELECT o_orderkey, o_orderpriority AS title, 'indeed' AS source, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey AS VARCHAR) || ' - 9 EGP / yearly' ELSE '9' END AS salary, '2-3' AS experience, 'IT' AS industry, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS posted_at_raw FROM orders")
def row_to_record(s, d):
    even, key = F.col("o_orderkey") % 2 == 0, F.col("o_orderkey").cast("string")
    rows = _table(s, d, "orders").select(
        F.col("o_orderpriority").alias("title"), F.lit("C").alias("company"), F.lit("Cairo").alias("location"), F.when(even, key).alias("min_amount"), F.lit("9").alias("max_amount"), F.when(even, "EGP").alias("currency"),
        F.when(even, "yearly").alias("interval"), F.lit("d").alias("description"), F.lit("2-3").alias("experience_range"), F.col("o_orderdate").cast("date").alias("date_posted"), F.lit("IT").alias("company_industry"), key.alias("job_url"), F.lit("t").alias("scraped_at"), F.lit("r").alias("run_id"),
    )
    return contract.row_to_record(rows, "indeed").select(F.col("job_url").cast("long").alias("o_orderkey"), "title", "source", "salary", "experience", "industry", "posted_at_raw")


@query("SELECT 'a' AS source, CAST(o_orderkey AS VARCHAR) AS job_id, NULL AS extra FROM orders UNION ALL SELECT 'b', CAST(c_custkey AS VARCHAR), c_name FROM customer")
def union_sources(s, d):
    a = _table(s, d, "orders").select(F.lit("a").alias("source"), F.col("o_orderkey").cast("string").alias("job_id"))
    return contract.union_sources(a, _table(s, d, "customer").select(F.col("c_custkey").cast("string").alias("job_id"), F.lit("b").alias("source"), F.col("c_name").alias("extra")))


@query("SELECT user_id AS run_id, event_type AS source, min(event_id) AS first_event FROM (SELECT *, min(ts) OVER w AS first_ts FROM events WINDOW w AS (PARTITION BY user_id, event_type)) WHERE ts = first_ts GROUP BY user_id, event_type")
def dedupe_within_run(s, d):
    rows = _table(s, d, "events").select(F.col("user_id").alias("run_id"), F.col("event_type").alias("source"), F.lit("j").alias("job_id"), F.col("ts").alias("_file"), F.col("event_id").alias("_ordinal"))
    return contract.dedupe_within_run(rows).select("run_id", "source", F.col("_ordinal").alias("first_event"))


# Scalar operators that the other queries leave out.

_COMPANIES = (" Acme  GmbH ", "", "###", "N/A", "R&D @ Home", "<b>Bold</b> Co")


@query(f"SELECT c_custkey, {_texts('Acme GmbH', 'Confidential', 'Confidential', 'N/A', 'RD Home', 'Bold Co')}[c_custkey % 6 + 1] AS company FROM customer")
def text_company_clean(s, d):
    return _table(s, d, "customer").select("c_custkey", text.company_clean(_pick("c_custkey", _COMPANIES)).alias("company"))


_LISTS = ("Python| sql ||SQL|python|Go", "", " | ", "c++", "A|b|a|B|c")


@query(f"SELECT c_custkey, {_texts('Python,sql,Go', '', '', 'c++', 'A,b,c')}[c_custkey % 5 + 1] AS skills FROM customer")
def text_split_skills(s, d):
    return _table(s, d, "customer").select("c_custkey", F.array_join(text.split_skills(_pick("c_custkey", _LISTS)), ",").alias("skills"))


@query(f"WITH {POSTINGS} SELECT job_key, array_to_string(list_filter([" + ", ".join(f"CASE WHEN regexp_matches(lower(title), '(^|[^a-z0-9]){''.join(c if c.isalnum() or c == ' ' else chr(92) + c for c in n.lower())}($|[^a-z0-9])') THEN '{n}' END" for n, *_ in ref.SKILLS)
       + "], lambda x: x IS NOT NULL), '|') AS skills FROM postings")
def text_detect_skills_in_title(s, d):
    return postings(s, d).select("job_key", F.array_join(text.detect_skills_in_title(F.col("title"), [n for n, *_ in ref.SKILLS]), "|").alias("skills"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'unknown' ELSE lower(c_mktsegment) END AS source, CASE WHEN c_custkey % 2 = 0 THEN 'a b c' ELSE c_name END AS label, lower(c_mktsegment) = 'machinery' AS is_remote FROM customer")
def text_sources_and_labels(s, d):
    odd = F.col("c_custkey") % 3 == 0
    source = text.normalize_source(F.when(~odd, F.concat(F.lit(" "), "c_mktsegment", F.lit(" "))))
    label = text.display_label(F.when(F.col("c_custkey") % 2 == 0, "a_b-c").otherwise(F.col("c_name")))
    mode = F.when(F.col("c_mktsegment") == "MACHINERY", "remote").otherwise("hybrid")
    return _table(s, d, "customer").select("c_custkey", source.alias("source"), label.alias("label"), text.is_remote(mode).alias("is_remote"))


_SALARIES = ("EGP 1,500 - 2,500 / month", "$20 hourly", "n/a", "1.2.3", "", "٥٠٠ EGP/yr")


@query(f"SELECT c_custkey, ['hybrid', 'remote', 'on-site'][c_custkey % 3 + 1] AS mode, ['Maadi/Cairo', 'Giza/Giza', 'Unknown/Egypt'][c_custkey % 3 + 1] AS place, [1500.0, 20.0, NULL, NULL, NULL, 500.0][c_custkey % 6 + 1] AS low, [2500.0, 20.0, NULL, NULL, NULL, 500.0][c_custkey % 6 + 1] AS high, "
       "CASE WHEN c_custkey % 6 = 1 THEN 'USD' ELSE 'EGP' END AS currency, CASE c_custkey % 6 WHEN 0 THEN 'monthly' WHEN 1 THEN 'hourly' WHEN 5 THEN 'yearly' END AS period, CASE WHEN c_custkey % 60 <= 50 THEN c_custkey % 60 END AS years, ['Python|SQL', '', 'Go'][c_custkey % 3 + 1] AS skills FROM "
       "customer")  # fmt: skip
def sql_functions(s, d):
    """The scalar operators, called from SQL."""
    sql.register_functions(s)
    rows = _table(s, d, "customer").select("c_custkey", _pick("c_custkey", ("Hybrid", "wfh", "office")).alias("a"), _pick("c_custkey", ("maadi", "Giza!", "Luxor")).alias("b"), _pick("c_custkey", _SALARIES).alias("c"), _pick("c_custkey", ("python and sql", "no", "Go")).alias("e"))
    return rows.selectExpr(
        "c_custkey", "classify_work_mode(a) AS mode", "concat_ws('/', normalize_location(b).city, normalize_location(b).governorate) AS place", "parse_salary(c).min AS low", "parse_salary(c).max AS high", "parse_salary(c).currency AS currency",
        "parse_salary(c).period AS period", "CAST(parse_experience(concat(cast(c_custkey % 60 AS string), ' - 70 years')).min AS BIGINT) AS years", "array_join(extract_skills(e), '|') AS skills",
    )


# Cleaning and gates.

_CITY = ("Maadi, Cairo", "Port Said", "")
_YEARS = ("3 - 5 years, internship", "", "10+ years")


def _records(s: SparkSession, d: str) -> DataFrame:
    """Raw records with all fields in use: markup, entities, salaries, years, dates relative to the scrape, some broken."""
    key = F.col("job_key")
    salary = F.when(key % 4 == 0, "").when(key % 4 == 1, F.concat(F.lit("EGP "), key.cast("string"), F.lit(" - 90,000 / month"))).when(key % 4 == 2, "$1500 hourly").otherwise("1.2.3")
    posted = F.when(key % 5 == 0, "2 days ago").when(key % 5 == 1, "2024-05-06T10:00:00").when(key % 5 == 2, "today").otherwise("")
    return postings(s, d).select(
        "job_key", key.cast("string").alias("job_id"), F.concat(F.lit("<b>Urgent</b> "), "title", F.lit(" [x] &amp; co")).alias("title"), F.concat(F.lit(" "), "company_name", F.lit(" ")).alias("company"), _pick("job_key", _CITY).alias("location"),
        salary.alias("salary"), F.when(key % 3 == 0, "We use Python, C++ and SQL; hybrid").otherwise("").alias("description"), _pick("job_key", _YEARS).alias("experience"), posted.alias("posted_at_raw"), F.when(key % 7 == 0, "Docker").otherwise("").alias("industry"),
        F.lit("https://x").alias("job_url"), F.lit("src").alias("source"), F.date_format("posted_date", "yyyy-MM-dd'T'01:00:00").alias("scraped_at"), F.lit("run").alias("run_id"),
    )


_SKILL_BLOB = "lower(title_raw || CASE WHEN d <> '' THEN ' ' || d ELSE '' END || CASE WHEN ind <> '' THEN ' ' || ind ELSE '' END || CASE WHEN ex <> '' THEN ' ' || ex ELSE '' END)"
_CLEANED = f"""{POSTINGS}, raw0 AS (SELECT job_key, CAST(job_key AS VARCHAR) AS job_id, '<b>Urgent</b> ' || title || ' [x] &amp; co' AS title_raw, {_noise_sql("'Urgent ' || title || '  & co'")} AS title_clean, ' ' || company_name || ' ' AS company_raw,
        {_clean_sql('company_name')} AS company_clean, {_texts(*_CITY)}[job_key % 3 + 1] AS location_raw, ['Maadi', 'Unknown', 'Unknown'][job_key % 3 + 1] AS location_city, ['Cairo', 'Egypt', 'Egypt'][job_key % 3 + 1] AS location_gov,
        CASE WHEN job_key % 3 = 0 THEN 'We use Python, C++ and SQL; hybrid' ELSE '' END AS d, CASE WHEN job_key % 7 = 0 THEN 'Docker' ELSE '' END AS ind, {_texts(*_YEARS)}[job_key % 3 + 1] AS ex, posted_date FROM postings),
    raw AS (SELECT *, CASE job_key % 4 WHEN 1 THEN CAST(job_key AS DOUBLE) WHEN 2 THEN 1500 END AS salary_min, CASE job_key % 4 WHEN 1 THEN 90000.0 WHEN 2 THEN 1500 END AS salary_max, CASE WHEN job_key % 4 = 2 THEN 'USD' ELSE 'EGP' END AS salary_currency,
        CASE job_key % 4 WHEN 1 THEN 'monthly' WHEN 2 THEN 'hourly' END AS salary_period, [3, NULL, 10][job_key % 3 + 1] AS experience_years_min, [5, NULL, NULL][job_key % 3 + 1] AS experience_years_max,
        array_to_string(list_filter([{", ".join(f"CASE WHEN regexp_matches({_SKILL_BLOB}, '{_skill_sql(w)}') THEN '{n}' END" for n, _, w in ref.SKILLS)}], lambda x: x IS NOT NULL), '|') AS skills,
        {_rules_sql("lower(title_raw || ' ' || d || ' ' || location_raw)", ref.WORK_MODES, repr('on-site'))} AS work_mode, {_rules_sql("lower(title_raw || ' ' || d || ' ' || ex)", ref.EMPLOYMENT_TYPES, repr('full-time'))} AS employment_type,
        CASE job_key % 5 WHEN 0 THEN CAST(posted_date - 2 AS VARCHAR) WHEN 1 THEN '2024-05-06' WHEN 2 THEN NULL ELSE CAST(posted_date AS VARCHAR) END AS posted_at,
        CASE WHEN job_key % 4 = 3 THEN 'salary isn''t a number' WHEN job_key % 5 = 2 THEN 'posting or scrape date can''t be read' END AS clean_error FROM raw0),
    cleaned AS (SELECT job_key, job_id, md5(lower(title_clean) || '|' || lower(company_clean) || '|' || lower(location_city)) AS job_hash, title_raw, title_clean, company_raw, company_clean, location_raw, location_city, location_gov, salary_min, salary_max, salary_currency, salary_period,
        experience_years_min, experience_years_max, skills, work_mode, employment_type, 'src' AS source, 'https://x' AS job_url, strftime(posted_date, '%Y-%m-%d') || 'T01:00:00' AS scraped_at, posted_at, 'run' AS run_id, work_mode = 'remote' AS is_remote, clean_error FROM raw)"""


@query(f"WITH {_CLEANED} SELECT * EXCLUDE (job_key) FROM cleaned")
def clean_records(s, d):
    """All 24 columns, and what is wrong with a record."""
    return clean.clean_records(_records(s, d)).withColumn("skills", F.array_join("skills", "|"))


@query(f"WITH {_CLEANED} SELECT CASE WHEN clean_error IS NULL THEN 'usable' ELSE clean_error END AS outcome, count(*) AS n, CAST(sum(job_key) AS BIGINT) AS keys FROM cleaned GROUP BY 1")
def split_rejects(s, d):
    usable, rejected = clean.split_rejects(clean.clean_records(_records(s, d), html=False))
    both = usable.select(F.lit("usable").alias("outcome"), "job_id").unionByName(rejected.select(F.col("clean_error").alias("outcome"), "job_id"))
    return both.groupBy("outcome").agg(F.count("*").alias("n"), F.sum(F.col("job_id").cast("long")).alias("keys"))


@query("""SELECT o_orderkey, nullif(array_to_string(list_filter([CASE WHEN o_orderkey % 5 = 0 THEN 'Missing required field: title_clean' END, CASE WHEN CAST(o_orderdate AS DATE) > DATE '1996-01-01' THEN 'Posted date is in the future' END,
    CASE WHEN o_orderkey % 7 = 0 THEN 'Invalid job_url format' END], lambda x: x IS NOT NULL), '|'), '') AS validation_errors FROM orders""")  # fmt: skip
def quality_gate(s, d):
    """Valid rows without errors, and the others with theirs."""
    k = F.col("o_orderkey")
    rows = _table(s, d, "orders").select("o_orderkey", *[F.lit("x").alias(c) for c in ref.REQUIRED_FIELDS if c not in ("title_clean", "job_url", "posted_at")], F.when(k % 5 != 0, "t").alias("title_clean"),
        F.when(k % 7 == 0, "ftp://x").otherwise("https://x").alias("job_url"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("posted_at"), F.lit(5.0).alias("salary_min"), F.lit(None).cast("double").alias("salary_max"))
    valid, failed = quality.quality_gate(rows, F.lit("1996-01-01").cast("date"))
    return valid.select("o_orderkey", F.lit(None).cast("string").alias("validation_errors")).unionByName(failed.select("o_orderkey", "validation_errors"))


@query(f"WITH {_VERSIONS}, d AS (SELECT user_id, version, version = max(version) OVER (PARTITION BY user_id) OR user_id % 3 = 0 AS is_current FROM (SELECT DISTINCT user_id, version FROM v)) "
       "SELECT user_id, count(*) AS n FROM d WHERE is_current GROUP BY user_id HAVING count(*) > 1")  # fmt: skip
def quality_single_current(s, d):
    """Keys with several current versions, of a dimension in which a third of the keys never closed one."""
    rows = _table(s, d, "events").select("user_id", "event_type", "ts", "event_id")
    dim, _ = scd.scd2_dimension(rows, "user_id", "event_type", ["ts", "event_id"], F.lit("2024-02-01").cast("date"), part=F.to_date("ts"))
    return quality.not_single_current(dim.withColumn("is_current", F.col("is_current") | (F.col("user_id") % 3 == 0)), "user_id")


@query("SELECT count(DISTINCT o_orderstatus) AS n_values, count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) AS unknown_values FROM orders")
def quality_facet_values(s, d):
    return quality.facet_values(_table(s, d, "orders"), "o_orderstatus", ["F", "O"])


@query("SELECT CASE WHEN o_orderkey % 10 = 7 THEN 'the file isn''t an array of records' WHEN o_orderkey % 10 = 3 THEN 'record has neither title nor company' WHEN o_orderkey % 10 = 5 THEN 'salary isn''t a number' WHEN o_orderkey % 10 = 9 THEN 'Invalid job_url format' ELSE 'valid' END AS outcome, "
       "count(*) AS n FROM orders GROUP BY 1")  # fmt: skip
def clean_batch(s, d):
    """A file of one record per order: each ends as valid, quarantined or rejected, with the reason."""
    k = F.col("o_orderkey") % 10
    made = {"job_id": F.col("o_orderkey").cast("string"), "title": F.when(k == 3, "").otherwise("Data Engineer"), "company": F.when(k == 3, "N/A").otherwise("Acme"), "salary": F.when(k == 5, "1.2.3").otherwise("EGP 5"),
            "job_url": F.when(k == 9, "ftp://x").otherwise("https://x"), "scraped_at": F.lit("2024-01-02T00:00:00"), "posted_at_raw": F.lit("1 day ago"), "source": F.lit("src"), "run_id": F.lit("r")}
    record = F.to_json(F.array(F.struct(*[made.get(c, F.lit("x")).alias(c) for c in ref.CONTRACT_FIELDS])))
    value = F.when(k == 7, "[{").otherwise(record)
    path = F.concat(F.lit("raw/src/2024-01-02/"), F.col("o_orderkey").cast("string"), F.lit(".json"))
    checked = incremental.checked_batch(files.parse_bronze(_table(s, d, "orders").select(value.alias("value"), path.alias("_file"))), F.lit("2024-06-01").cast("date"))
    every = checked.select(F.coalesce("clean_error", F.nullif("validation_errors", F.lit("")), F.lit("valid")).alias("outcome"))
    return every.groupBy("outcome").agg(F.count("*").alias("n"))


# Seeds, staging and intermediate models.

_GOVERNORATES = "(VALUES " + ", ".join(f"('{g}', '{r}')" for g, r in ref.GOVERNORATES) + ") t(governorate, region)"


@query(f"SELECT governorate, region FROM {_GOVERNORATES} UNION ALL SELECT DISTINCT n_name, 'Unknown' FROM nation WHERE n_name NOT IN (SELECT governorate FROM {_GOVERNORATES})")
def reseed_governorates(s, d):
    """Seeds again over a table that has more: rows that are there stay."""
    have = _table(s, d, "nation").select(F.col("n_name").alias("governorate"), F.lit("Unknown").alias("region"))
    return ref.reseed(ref.seed_reference(s)["ref_governorate"], have, "governorate", update=False)


@query("SELECT source_name, display_name FROM (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b, _ in ref.SOURCES) + ") t(source_name, display_name) UNION ALL SELECT DISTINCT lower(c_mktsegment), c_mktsegment FROM customer")
def reseed_sources(s, d):
    """Sources that loads have added, with a seeded one under an old name: reseeding puts the seed's in its place."""
    seeds = ref.seed_reference(s)["dim_source"]
    added = load.upsert_source(seeds.withColumn("display_name", F.lit("old")), _table(s, d, "customer").select(F.concat(F.lit(" "), "c_mktsegment").alias("source")))
    return ref.reseed(added, seeds, "source_name", update=True).select("source_name", F.trim("display_name").alias("display_name"))


@query("SELECT count(*) AS n_names, count(*) AS n_keys, 0 AS n_null FROM (SELECT DISTINCT c_mktsegment, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey)")
def surrogate_keys(s, d):
    """A key per natural key, the same whenever it is made."""
    both = _table(s, d, "customer").join(_table(s, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_mktsegment", "n_name").distinct()
    keyed = both.select("c_mktsegment", "n_name", load.surrogate_key(F.col("c_mktsegment"), F.col("n_name")).alias("k"))
    again = keyed.where(load.surrogate_key(F.col("c_mktsegment"), F.col("n_name")) == F.col("k"))
    return again.agg(F.count("*").alias("n_names"), F.count_distinct("k").alias("n_keys"), F.count_if(F.col("k").isNull()).cast("int").alias("n_null"))


@query(f"WITH {POSTINGS} SELECT job_key, md5(CAST(job_key AS VARCHAR)) AS job_hash, title AS title_clean, company_name AS company_clean, category_name, salary_min, salary_max, salary_mid, salary_currency, is_remote, work_mode, employment_type, seniority, CAST(posted_date AS VARCHAR) AS posted_date, 27 AS n_columns FROM postings")
def stg_job_postings(s, d):
    """Postings with middle, defaults and seniority (a company's key has its version as a second column)."""
    out = models.stg_job_postings(star_schema(s, d)["fact_job_postings"])
    return out.select("job_key", "job_hash", "title_clean", "company_clean", "category_name", "salary_min", "salary_max", "salary_mid", "salary_currency", "is_remote", "work_mode", "employment_type", "seniority", F.col("posted_date").cast("string"), F.lit(len(out.columns)).alias("n_columns"))


@query("SELECT c_name AS company_name, upper(c_name) AS company_raw, CAST(1 AS INT) AS company_version, '2024-01-01' AS valid_from, CAST(NULL AS VARCHAR) AS valid_to, TRUE AS is_current FROM customer")
def stg_company(s, d):
    return plain(models.stg_company(star_schema(s, d)["dim_company"])).drop("company_clean")


@query("SELECT DISTINCT c_mktsegment AS city, n_name AS governorate, CASE WHEN n_nationkey % 5 <> 0 THEN r_name END AS region FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def stg_location(s, d):
    """Locations of governorates that the seeds lack have no region."""
    gold = star_schema(s, d)
    known = gold["ref_governorate"].join(_table(s, d, "nation").where("n_nationkey % 5 <> 0").select(F.col("n_name").alias("governorate")), "governorate", "left_semi")
    return models.stg_location(gold["dim_location"], known).select("city", "governorate", "region")


@query("SELECT 'category' AS model, o_orderpriority AS name, left(o_orderpriority, 1) AS detail FROM (SELECT DISTINCT o_orderpriority FROM orders) UNION ALL SELECT 'skill', p_brand, min(p_type) FROM part GROUP BY p_brand "
       "UNION ALL SELECT 'source', 'src' || k, 'https://src' || k FROM (SELECT unnest(['0', '1', '2', '3']) AS k)")  # fmt: skip
def stg_dimensions(s, d):
    """Categories, skills and sources."""
    gold = star_schema(s, d)
    named = lambda model, df, name, detail: df.select(F.lit(model).alias("model"), F.col(name).alias("name"), F.col(detail).cast("string").alias("detail"))
    parts = [named("category", models.stg_job_category(gold["dim_job_category"]), "category_name", "category_key"), named("skill", models.stg_skill(gold["dim_skill"]), "skill_name", "skill_category"), named("source", models.stg_source(gold["dim_source"]), "source_name", "base_url")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("SELECT DISTINCT year(x) * 10000 + month(x) * 100 + day(x) AS date_key, CAST(x AS VARCHAR) AS full_date, CAST(quarter(x) AS SMALLINT) AS quarter, CAST(week(x) AS SMALLINT) AS week_of_year FROM (SELECT CAST(o_orderdate AS DATE) AS x FROM orders)")
def stg_date(s, d):
    return plain(models.stg_date(star_schema(s, d)["dim_date"])).select("date_key", "full_date", "quarter", "week_of_year")


@query(f"WITH {POSTINGS} SELECT job_key, md5(CAST(job_key AS VARCHAR)) AS job_hash, title AS title_clean, seniority, category_name, company_name, city, governorate, region, 'src' || CAST(job_key % 4 AS VARCHAR) AS source_name, 'Source ' || CAST(job_key % 4 AS VARCHAR) AS source_display, "
       "salary_min, salary_max, salary_mid, salary_currency, experience_years_min, CAST(NULL AS SMALLINT) AS experience_years_max, is_remote, work_mode, employment_type, CAST(posted_date AS VARCHAR) AS posted_date, CAST(posted_year AS SMALLINT) AS posted_year, CAST(quarter(posted_date) AS SMALLINT) AS posted_quarter, "
       "CAST(posted_month AS SMALLINT) AS posted_month, posted_month_name, CAST(week(posted_date) AS SMALLINT) AS posted_week, 'https://x/' || CAST(job_key AS VARCHAR) AS job_url FROM postings")  # fmt: skip
def int_job_enriched(s, d):
    out = models.int_job_enriched(star_schema(s, d)).drop("first_seen_at")
    return out.withColumn("posted_date", F.col("posted_date").cast("string"))


@query(f"WITH {POSTINGS}, skills AS (SELECT p_brand AS skill_name, min(p_type) AS skill_category FROM part GROUP BY p_brand) SELECT job_key, skill_name, skill_category, category_name, governorate, region, seniority, work_mode "
       "FROM (SELECT DISTINCT l_orderkey AS job_key, p_brand AS skill_name FROM lineitem JOIN part ON l_partkey = p_partkey) JOIN skills USING (skill_name) JOIN postings USING (job_key)")  # fmt: skip
def int_job_skills(s, d):
    gold = star_schema(s, d)
    return models.int_job_skills(gold, models.int_job_enriched(gold))


# Orders of marts and pages, as row numbers: rows alone are compared as a set.


def _placed(df: DataFrame) -> DataFrame:
    """All rows of a sorted table with their place from 1: ranges of a sort are numbered each, and begin with the number of
    rows in those before."""
    df.withColumn("_at", F.monotonically_increasing_id()).write.parquet(path := files.scratch(df.sparkSession, "placed"))
    rows = df.sparkSession.read.parquet(path).withColumn("_range", F.shiftright("_at", 33))
    ranges = rows.groupBy("_range").agg(F.count("*").alias("_n"))
    before = ranges.select("_range", F.coalesce(F.expr("sum(_n) OVER (ORDER BY _range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"), F.lit(0)).alias("_before"))
    return rows.join(F.broadcast(before), "_range").withColumn("place", F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1).drop("_at", "_range", "_before")  # a row per range is broadcast


_ORDER_SQL = {
    "in_demand_roles": "postings DESC, category_name", "salary_intelligence": "category_name, seniority, governorate", "company_insights": "postings DESC, company_name", "geographic_distribution": "postings DESC, region, governorate",
    "hiring_trends": "year, month, postings DESC, category_name", "work_mode_breakdown": "facet, postings DESC, value", "skill_demand": "total_postings DESC, skill_name, postings DESC, category_name, skill_category",
}
_GRAIN = {
    "in_demand_roles": "category_name", "salary_intelligence": "category_name || seniority || governorate", "company_insights": "company_name", "geographic_distribution": "region || governorate", "hiring_trends": "CAST(year AS VARCHAR) || '/' || CAST(month AS VARCHAR) || category_name",
    "work_mode_breakdown": "facet || value", "skill_demand": "skill_name || category_name || skill_category",
}


@query(f"WITH {POSTINGS}, " + ", ".join(f"m{k} AS ({MART_SQL[m]})" for k, m in enumerate(_ORDER_SQL)) + " "
       + " UNION ALL ".join(f"SELECT '{m}' AS mart, grain, place FROM (SELECT {_GRAIN[m]} AS grain, row_number() OVER (ORDER BY {o}) AS place FROM m{k})" for k, (m, o) in enumerate(_ORDER_SQL.items())))
def mart_orders(s, d):
    """The place of each row of each mart in its order."""
    gold = star_schema(s, d)
    jobs = models.int_job_enriched(gold)
    made, out = marts.all_marts(jobs, job_skills(s, d)), None
    for name in _ORDER_SQL:
        keys = [*marts.ORDERS[name], *(["skill_category"] if name == "skill_demand" else [])]
        grain = F.expr(_GRAIN[name].replace("VARCHAR", "STRING"))
        part = _placed(made[name].orderBy(*marts.sort_keys(keys))).select(F.lit(name).alias("mart"), grain.alias("grain"), "place")
        out = part if out is None else out.unionByName(part)
    return out


_TALL = {m: (*("postings_with_salary" if m == "salary_intelligence" else "postings", "hiring_companies" if m in ("in_demand_roles", "geographic_distribution", "hiring_trends") else "NULL"), "NULL" if m in ("work_mode_breakdown", "skill_demand") else "avg_salary_mid") for m in _ORDER_SQL}
_TALL_SQL = f"WITH {POSTINGS}, " + ", ".join(f"m{k} AS ({MART_SQL[m]})" for k, m in enumerate(_ORDER_SQL)) + " " + " UNION ALL ".join(
    f"SELECT '{m}' AS mart, {_GRAIN[m]} AS grain, CAST({n} AS BIGINT) AS n, CAST({c} AS BIGINT) AS companies, CAST({a} AS DOUBLE) AS mean FROM m{k}" for k, (m, (n, c, a)) in enumerate(_TALL.items()))


def _tall(made: dict) -> DataFrame:
    """The rows of all marts with what most of them count."""
    parts = [made[m].select(F.lit(m).alias("mart"), *[F.expr(e).cast(kind).alias(c) for e, kind, c in ((_GRAIN[m].replace("VARCHAR", "STRING"), "string", "grain"), (n, "bigint", "n"), (k, "bigint", "companies"), (a, "double", "mean"))]) for m, (n, k, a) in _TALL.items()]
    return functools.reduce(DataFrame.unionByName, parts)


@query(_TALL_SQL)
def lattice_all_marts(s, d):
    """All marts of one stored base: one scan of the postings."""
    return _tall(lattice.all_marts(lattice.base(postings(s, d), skill_links(s, d))))


@query(_TALL_SQL)
def lattice_merged_marts(s, d):
    """All marts of two bases, of the postings before 1995 and of the others, merged."""
    jobs, links = postings(s, d), skill_links(s, d)
    early = F.coalesce(F.col("posted_date") < "1995-01-01", F.lit(False))
    bases = [lattice.base(jobs.where(part), links) for part in (early, ~early)]
    return _tall(lattice.all_marts(lattice.kept(lattice.merged(*bases))))


@query("SELECT o_orderpriority AS category, row_number() OVER (ORDER BY o_orderpriority = '1-URGENT', n DESC, o_orderpriority) AS place, n FROM (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1)")
def serve_other_last(s, d):
    """One value, here 1-URGENT, moved to the end."""
    counts = _table(s, d, "orders").groupBy(F.col("o_orderpriority").alias("category")).agg(F.count("*").alias("n"))
    return _placed(serving.other_last(counts, "category", F.desc("n"), F.asc("category"), other="1-URGENT"))


@query("SELECT o_orderkey, place FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 41 AS place FROM orders) WHERE place BETWEEN 1 AND 1000")
def serve_page_bounds(s, d):
    """The largest page, from an offset; sizes and offsets out of bounds are refused."""
    orders = _table(s, d, "orders").select("o_orderkey", "o_totalprice")
    for limit, skip in ((0, 0), (1001, 0), (5, -1)):
        try:
            serving.serve(orders, ["-o_totalprice", "o_orderkey"], limit=limit, skip=skip)
        except ValueError:
            continue
        raise AssertionError("such a page is to be refused")
    return _placed(serving.serve(orders, ["-o_totalprice", "o_orderkey"], limit=1000, skip=41)).select("o_orderkey", "place")


# The load.

_TITLES_OF = ("Senior Data Engineer", "QA Tester", "Python and SQL Developer", "Bookkeeper")


def _silver(s: SparkSession, d: str) -> DataFrame:
    """Standardised rows, all strings as in CSV files, in four files; postings come again under one hash, companies change
    their raw name, skills are written in any case, and some rows have no hash."""
    k = F.col("o_orderkey")
    title, company, city = _pick("o_orderkey", _TITLES_OF), F.concat(F.lit("C"), (F.col("o_custkey") % 40).cast("string")), F.concat(F.lit("T"), (k % 5).cast("string"))
    made = {
        "job_id": k.cast("string"), "job_hash": F.when(k % 50 == 0, "").otherwise(text.job_hash(title, company, city)), "title_raw": title, "title_clean": F.when(k % 9 == 0, "").otherwise(title),
        "company_raw": F.when(k % 11 == 0, "").otherwise(F.when(F.col("o_totalprice") > 300000, F.upper(F.concat(company, F.lit(" inc")))).otherwise(company)), "company_clean": company, "location_raw": F.lit("x"), "location_city": city,
        "location_gov": F.when(k % 2 == 0, "Cairo").otherwise("Atlantis"), "salary_min": F.when(k % 3 == 0, "").otherwise((k % 1000).cast("string")), "salary_max": F.lit("nan"), "salary_currency": F.lit("EGP"), "experience_years_min": F.lit("3.0"), "experience_years_max": F.lit(""),
        "is_remote": F.when(k % 2 == 0, "True").otherwise("no"), "source": F.lit(" SRC "), "job_url": F.lit("https://x"), "scraped_at": F.lit("2024-01-02T00:00:00"), "posted_at": F.date_format("o_orderdate", "yyyy-MM-dd"), "run_id": F.lit("r"),
        "skills": F.when(k % 3 == 0, "").when(k % 3 == 1, "python|SQL|sql| Rust ").otherwise("rust|Excel"),
    }
    orders = _table(s, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate").repartition(int(s.conf.get("spark.sql.shuffle.partitions")), "o_orderkey")  # one file with few row groups is read by few tasks
    return orders.select(*[c.alias(n) for n, c in made.items()], F.concat(F.lit("f"), (k % 4).cast("string")).alias("_file"), k.alias("_ordinal"))


def _silver_sql(steps: str) -> str:
    """The load file by file: ``steps`` numbers the files' loads (step, f), in the order in which they happen."""
    return f"""s0 AS (SELECT *, {_texts(*_TITLES_OF)}[o_orderkey % 4 + 1] AS title, 'C' || CAST(o_custkey % 40 AS VARCHAR) AS company, 'T' || CAST(o_orderkey % 5 AS VARCHAR) AS city, o_orderkey % 4 AS f FROM orders),
    s1 AS (SELECT *, md5(lower(title) || '|' || lower(company) || '|' || lower(city)) AS job_hash, CASE WHEN o_orderkey % 11 = 0 THEN company WHEN o_totalprice > 300000 THEN upper(company || ' inc') ELSE company END AS raw,
        CASE o_orderkey % 3 WHEN 0 THEN [] WHEN 1 THEN ['Python', 'SQL', 'Rust'] ELSE ['rust', 'Excel'] END AS named, CASE WHEN o_orderkey % 2 = 0 THEN 'Cairo' ELSE 'Atlantis' END AS gov FROM s0 WHERE o_orderkey % 50 <> 0),
    steps AS ({steps}),
    runs AS (SELECT step, s1.* FROM s1 JOIN steps USING (f)),
    changes AS (SELECT *, CASE WHEN lag(raw) OVER w IS DISTINCT FROM raw THEN 1 ELSE 0 END AS opens FROM runs WINDOW w AS (PARTITION BY company ORDER BY step, o_orderkey)),
    versioned AS (SELECT *, sum(opens) OVER (PARTITION BY company ORDER BY step, o_orderkey) AS version FROM changes),
    in_step AS (SELECT *, row_number() OVER (PARTITION BY job_hash ORDER BY step) AS nth FROM (SELECT * FROM versioned QUALIFY row_number() OVER (PARTITION BY job_hash, step ORDER BY o_orderkey DESC) = 1)),
    firsts AS (SELECT job_hash, CAST(o_orderkey AS VARCHAR) AS source_job_id, step AS first_step FROM in_step WHERE nth = 1),
    last AS (SELECT * FROM in_step QUALIFY step = max(step) OVER (PARTITION BY job_hash)),
    spelling AS (SELECT lower(x) AS low, arg_min(x, (step, o_orderkey)) AS name FROM (SELECT step, o_orderkey, unnest(named) AS x FROM runs) GROUP BY 1)"""


_EACH = "SELECT step, f FROM (SELECT f, unnest([f + 1, f + 5]) AS step FROM (SELECT unnest([0, 1, 2, 3]) AS f))"
_ONCE = "SELECT f + 1 AS step, f FROM (SELECT unnest([0, 1, 2, 3]) AS f)"
_SEED_SKILLS = "(VALUES " + ", ".join(f"('{n}')" for n, *_ in ref.SKILLS) + ") seeds(skill_name)"


@query(f"""WITH {_silver_sql(_EACH)} SELECT job_hash, source_job_id, title AS title_clean, company AS company_clean, CAST(version AS INT) AS company_version, raw AS company_raw, city, gov AS governorate,
    CASE WHEN o_orderkey % 2 = 0 THEN 'Greater Cairo' ELSE 'Unknown' END AS region, ['Data Engineering', 'QA & Testing', 'Other', 'Other'][o_orderkey % 4 + 1] AS category_name, 'src' AS source_name, CAST(CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey % 1000 END AS DECIMAL(12,2)) AS salary_min,
    CAST(3 AS SMALLINT) AS experience_years_min, o_orderkey % 2 = 0 AS is_remote, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS posted_date,
    array_to_string(list_sort(list_transform(named, lambda x: CASE WHEN lower(x) = 'rust' THEN rust ELSE x END)), '|') AS skills FROM last JOIN firsts USING (job_hash), (SELECT name AS rust FROM spelling WHERE low = 'rust')""")  # fmt: skip
def load_job(s, d):
    """Two loads of two files each, the second given all four, and a reload of all: facts with their dimensions and skills."""
    gold = loaded(s, d)
    fact = models.stg_job_postings(gold["fact_job_postings"])
    skills = models.stg_skill(gold["dim_skill"]).join(gold["bridge_job_skill"], "skill_name").groupBy("job_key").agg(F.array_join(F.array_sort(F.collect_list("skill_name")), "|").alias("skills"))
    company = models.stg_company(gold["dim_company"]).select("company_clean", "company_version", "company_raw")
    out = fact.join(company, ["company_clean", "company_version"]).join(models.stg_location(gold["dim_location"], gold["ref_governorate"]), "location_key").join(skills, "job_key", "left")
    return out.select(
        "job_hash", "source_job_id", "title_clean", "company_clean", "company_version", "company_raw", "city", "governorate", "region", "category_name", "source_name", "salary_min", "experience_years_min", "is_remote", F.col("posted_date").cast("string"), F.coalesce("skills", F.lit("")).alias("skills"),
    )


def _files_of(s: SparkSession) -> DataFrame:
    """The files of a load; the last has no rows."""
    return s.createDataFrame([(f"f{k}",) for k in range(5)], "_file string")


def loaded(s: SparkSession, d: str) -> dict[str, DataFrame]:
    """Three loads, each committed to a store."""
    silver = _silver(s, d)
    silver.write.parquet(path := files.scratch(s, "silver"))
    silver = s.read.schema(silver.schema).parquet(path)
    gold = Store(s, files.scratch(s, "gold"), bits=3)
    for run, (part, reload) in enumerate(((silver.where("_file < 'f2'"), False), (silver, False), (silver, True))):
        at = F.lit(f"2024-03-0{run + 1} 00:00:00").cast("timestamp")
        load.load_into(gold, part, at.cast("date"), at, reload, _files_of(s).where("_file < 'f2'") if run == 0 else _files_of(s))
    return gold.tables()


@query(f"""WITH {_silver_sql(_EACH)}, n AS (SELECT f, count(*) AS n FROM s0 GROUP BY f), u AS (SELECT f, count(*) AS u FROM in_step WHERE step > 4 GROUP BY f)
    SELECT 'f' || CAST(f AS VARCHAR) AS file_path, n AS rows_in_file, CAST(0 AS BIGINT) AS rows_inserted, coalesce(u, 0) AS rows_updated FROM n LEFT JOIN u USING (f) UNION ALL SELECT 'f4', 0, 0, 0""")  # fmt: skip
def load_log(s, d):
    """The log after the reload: every file's last load inserted nothing; rows without a hash count, and a file without rows has
    a line."""
    return loaded(s, d)["etl_load_log"].select("file_path", "rows_in_file", "rows_inserted", "rows_updated")


@query(f"""WITH {_silver_sql(_ONCE)}, n AS (SELECT f, count(*) AS n FROM s0 GROUP BY f), u AS (SELECT f, count(*) FILTER (nth = 1) AS i, count(*) FILTER (nth > 1) AS u FROM in_step GROUP BY f),
    days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS x FROM s1 UNION SELECT DATE '2024-01-02')
    SELECT 'fact' AS part, job_hash AS name, source_job_id || '/' || CAST(o_orderkey AS VARCHAR) || '/' || CAST(version AS VARCHAR) AS detail FROM (SELECT * FROM last JOIN firsts USING (job_hash))
    UNION ALL SELECT DISTINCT 'location', city || '/' || gov, '' FROM s1 UNION ALL SELECT 'date', CAST(x AS VARCHAR), CAST(year(x) * 10000 + month(x) * 100 + day(x) AS VARCHAR) FROM days
    UNION ALL SELECT 'company', company, CAST(version AS VARCHAR) || '/' || any_value(raw) FROM versioned GROUP BY company, version
    UNION ALL SELECT 'skill', skill_name, '' FROM {_SEED_SKILLS} UNION ALL SELECT 'skill', name, '' FROM spelling WHERE low NOT IN (SELECT lower(skill_name) FROM {_SEED_SKILLS})
    UNION ALL SELECT 'log', 'f' || CAST(f AS VARCHAR), CAST(n AS VARCHAR) || '/' || CAST(coalesce(i, 0) AS VARCHAR) || '/' || CAST(coalesce(u, 0) AS VARCHAR) FROM n LEFT JOIN u USING (f) UNION ALL SELECT 'log', 'f4', '0/0/0'""")  # fmt: skip
def load_batch_equals_single_loads(s, d):
    """One load of five files, against SQL that loads them one by one: facts (first id, last run id and company version),
    dimensions of all rows, and the log."""
    at = F.lit("2024-03-01 00:00:00").cast("timestamp")
    silver = _silver(s, d).withColumn("run_id", F.col("job_id"))
    gold = load.load(load.empty_gold(s), silver, at.cast("date"), at, files=_files_of(s))
    part = lambda name, df, key, detail: df.select(F.lit(name).alias("part"), key.alias("name"), detail.alias("detail"))
    slashed = lambda *c: F.concat_ws("/", *[F.col(x).cast("string") for x in c])
    parts = [
        part("fact", gold["fact_job_postings"], F.col("job_hash"), slashed("source_job_id", "run_id", "company_version")), part("location", gold["dim_location"], slashed("location_city", "location_gov"), F.lit("")),
        part("date", gold["dim_date"], F.col("full_date").cast("string"), F.col("date_key").cast("string")), part("company", gold["dim_company"], F.col("company_clean"), slashed("version", "company_raw")),
        part("skill", gold["dim_skill"], F.col("skill_name"), F.lit("")), part("log", gold["etl_load_log"], F.col("file_path"), slashed("rows_in_file", "rows_inserted", "rows_updated")),
    ]
    return functools.reduce(DataFrame.unionByName, parts)


@query(r"""WITH names AS (SELECT DISTINCT lower(p_type) AS name FROM part UNION SELECT DISTINCT lower(p_name) FROM part UNION SELECT DISTINCT lower(split_part(p_name, ' ', 1)) FROM part UNION SELECT 'c++' UNION SELECT 'مهندس'),
    titles AS (SELECT c_custkey, lower(c_name || ' ' || title) AS title FROM (SELECT p_partkey AS c_custkey, p_name AS c_name, p_type || CASE p_partkey % 4 WHEN 0 THEN '/C++' WHEN 1 THEN '2' WHEN 2 THEN ' مهندسون' ELSE '' END AS title FROM part))
    SELECT c_custkey AS p_partkey, name AS skill FROM titles JOIN names ON regexp_matches(title, '(^|[^a-z0-9])' || regexp_replace(name, '([!-/:-@\[-`{-~])', '\\\1', 'g') || '($|[^a-z0-9])')""")  # fmt: skip
def detect_dimension_skills(s, d):
    """Names of a dimension (of several words, with signs, of another script) in titles, by a join."""
    part = _table(s, d, "part")
    names = part.select(F.col("p_type").alias("skill_name")).union(part.select("p_name")).union(part.select(F.split_part("p_name", F.lit(" "), F.lit(1)))).union(s.createDataFrame([("C++",), ("مهندس",)], "skill_name string"))
    names = names.select(F.lower("skill_name").alias("skill_name")).distinct()
    end = F.when(F.col("p_partkey") % 4 == 0, "/C++").when(F.col("p_partkey") % 4 == 1, "2").when(F.col("p_partkey") % 4 == 2, " مهندسون").otherwise("")
    titles = part.select("p_partkey", F.concat("p_name", F.lit(" "), "p_type", end).alias("title"))
    return titles.join(load.detect_skills(titles, names), "title").select("p_partkey", F.explode("skills").alias("skill"))
