"""Hand-computed tables of the scalar operators."""

import pytest
from pyspark.sql import functions as F

from postlake import reference as ref
from postlake.functions import parse, text
from postlake.operators import contract


def apply(spark, expr, values, *more):
    rows = [(i, v, *more) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, t string" + "".join(f", m{k} string" for k in range(len(more))))
    return [r.out for r in df.select("i", expr.alias("out")).orderBy("i").collect()]


@pytest.mark.parametrize(
    ("function", "cases"),
    [
        (text.clean_text, {"C# / C++ Developer": "C / C Developer", "Data & AI  Engineer": "Data AI Engineer", "<b>QA</b> Lead": "QA Lead", "A < B": "A B", "مهندس بيانات": "مهندس بيانات", None: "", "": "", "a b": "a b"}),
        (text.strip_title_noise, {"Senior Data Engineer (Airflow, dbt)": "Senior Data Engineer", "Urgent Hiring: Remote Go Dev": "Go Dev", "(A) keep (B)": "", "Remotely managed QA": "ly managed QA"}),
        (text.company_clean, {None: "Confidential", "   ": "Confidential", "###": "Confidential", "N/A": "N/A"}),
        (text.seniority, {"Senior Intern": "Senior", "Team Leader": "Senior", "Internal Auditor": "Junior", "Mid-level Dev": "Mid", "Data Analyst": "Unspecified"}),
        (text.categorize, {"Full Stack MERN Developer": "Full Stack Development", "QA Automation Engineer": "QA & Testing", "React Native Developer": "Frontend Development", "Linux Administrator": "UI/UX Design", "Accountant": "Other"}),
        (text.classify_work_mode, {"Hybrid / Remote dev": "hybrid", "wfh": "remote", "عن بعد": "remote", "": "on-site", None: "on-site"}),
        (text.classify_employment_type, {"International Sales": "internship", "Part time contract": "part-time", "Freelancer": "freelance", "temporary": "contract", "": "full-time"}),
        (parse.parse_salary_period, {"20 - 30 usd / hourly": "hourly", "egp/yr": "yearly", "x / month": "monthly", "daily": "daily", "": None}),
        (parse.to_num, {"5d": None, "NaN": None, " 7.5 ": 7.5, "": None, None: None}),
    ],
)
def test_strings(spark, function, cases):
    assert apply(spark, function(F.col("t")), list(cases)) == list(cases.values())


def test_location(spark):
    cases = {"Maadi, Cairo": ("Maadi", "Cairo"), "New Cairo,Cairo,Egypt": ("New Cairo", "Cairo"), "السادس من اكتوبر، الجيزة": ("Giza", "Giza"), "مدينة السادات، المنوفية": ("Unknown", "Egypt"), "Port Said": ("Unknown", "Egypt"), "": ("Unknown", "Egypt")}
    assert [tuple(x) for x in apply(spark, text.normalize_location(F.col("t")), list(cases))] == list(cases.values())


def test_skills(spark):
    cases = {
        "Senior Java & JavaScript dev, C++/C#, .NET, node.js": ["Java", "JavaScript", "C#", "C++", ".NET", "Node.js"],
        "Strong SQL and Excel skills, build dashboards in Power BI and Tableau.": ["SQL", "Tableau", "Power BI", "Excel"],
        "PostgreSQL": ["PostgreSQL"], "good category": [], "rest of the team": ["REST API"],
    }
    assert apply(spark, text.extract_skills(F.col("t")), list(cases)) == list(cases.values())
    assert apply(spark, text.split_skills(F.col("t")), ["Python| sql ||SQL|python|Go", None]) == [["Python", "sql", "Go"], []]


def test_salary(spark):
    cases = {
        "EGP 15,000 - 25,000": (15000, 25000, "EGP", None, False), "$1500 - $2500": (1500, 2500, "USD", None, False), "EGP 20,000 / month": (20000, 20000, "EGP", "monthly", False),
        "10K - 15K EGP/yr": (10, 15, "EGP", "yearly", False), "20 - 30 USD / hourly": (20, 30, "USD", "hourly", False), "175 - 500 دولار امريكي": (175, 500, "EGP", None, False),
        "N/A": (None, None, "EGP", None, False), "": (None, None, "EGP", None, False), "الراتب غير معلن": (None, None, "EGP", None, False), "Competitive.": (None, None, "EGP", None, True), "٥٠٠": (500, 500, "EGP", None, False),
    }
    assert [tuple(x) for x in apply(spark, parse.parse_salary(F.col("t")), list(cases))] == list(cases.values())


def test_experience(spark):
    cases = {"5 - 15 Years": (5, 15), "3+ years": (3, None), "Since 2024, 2-4 yrs": (2, 4), "Senior": (None, None), None: (None, None)}
    assert [tuple(x) for x in apply(spark, parse.parse_experience(F.col("t")), list(cases))] == list(cases.values())


def test_posted_date(spark):
    cases = {
        "2 hours ago": "2026-06-06", "3 days ago": "2026-06-04", "1 week ago": "2026-05-31", "2 months ago": "2026-04-08", "2026-06-01T08:00:00": "2026-06-01", "2026-13-45": "2026-13-45",
        "": "2026-06-07", "just now": "2026-06-07", "yesterday": None, "today": None, "a month ago": None,
    }
    out = apply(spark, parse.parse_posted_date(F.col("t"), F.col("m0")), list(cases), "2026-06-07T01:30:00")
    assert [x.value for x in out] == list(cases.values())
    assert [x.error for x in out] == [v is None for v in cases.values()]
    assert [tuple(x) for x in apply(spark, parse.parse_posted_date(F.col("t"), F.col("m0")), ["x"], "")] == [("", False)]


def test_salary_mid_and_dates(spark):
    df = spark.sql("SELECT CAST(a AS DECIMAL(12,2)) a, CAST(b AS DECIMAL(12,2)) b FROM VALUES (100, 201), (NULL, 5), (NULL, NULL) t(a, b)")
    assert [None if r[0] is None else float(r[0]) for r in df.select(parse.salary_mid(F.col("a"), F.col("b"))).collect()] == [150.5, 5.0, None]
    row = spark.sql("SELECT DATE '2026-06-07' d").select(*parse.date_attributes(F.col("d"))).first()
    assert (row.date_key, row.quarter, row.month_name, row.day_of_week, row.day_name, row.week_of_year, row.is_weekend) == (20260607, 2, "June", 7, "Sunday", 23, False)


def test_format_salary(spark):
    df = spark.createDataFrame([("15000", "20000", "EGP", "monthly"), (None, "900", None, None), (None, None, "EGP", None)], "a string, b string, c string, d string")
    out = [r[0] for r in df.select(contract.format_salary(*[F.col(x) for x in "abcd"])).collect()]
    assert out == ["15000 - 20000 EGP / monthly", "900", ""]


def test_sql_functions(spark):
    from postlake.functions.sql import register_functions

    register_functions(spark)
    row = spark.sql("SELECT classify_work_mode('wfh') a, normalize_city('Maadi') b, extract_skills('Go and SQL') c, experience_min('3+ years') d, salary_numbers('1,500 - 2') e").first()
    assert (row.a, row.b, row.c, row.d, row.e) == ("remote", "Maadi", ["Go", "SQL"], 3, [1500.0, 2.0])


def test_lexicons_in_one_pass(spark):
    """Skills, places and categories of random texts, against a search for each word of a lexicon."""
    import random
    import re

    rng = random.Random(8)
    bits = [w for _, _, ws in ref.SKILLS for w in ws] + [w for w, _, _ in ref.LOCATIONS] + [w for _, ws in ref.CATEGORIES for w in ws] + ["x", "1", "/", ".", "é", "ا", "c", "java"]
    texts = sorted({rng.choice(["", " ", "-"]).join(rng.choices(bits, k=rng.randint(0, 7))) for _ in range(1500)})
    texts = [t.upper() if k % 5 == 0 else t for k, t in enumerate(texts)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", text.extract_skills(F.col("t")).alias("skills"), text.normalize_location(F.col("t")).alias("place"), text.categorize(F.col("t")).alias("category")).collect()
    named = lambda w, low: re.search(r"(?<![a-z0-9])" + re.escape(w.lower()) + ("" if w in ref.OPEN_ENDED else r"(?![a-z0-9])"), low)
    for r in got:
        low = r.t.lower()
        assert r.skills == [n for n, _, ws in ref.SKILLS if any(named(w, low) for w in ws)], r.t
        assert tuple(r.place) == next(((c, g) for w, c, g in ref.LOCATIONS if w in low), ("Unknown", "Egypt")), r.t
        scores = [(sum(w in low for w in ws), n) for n, ws in ref.CATEGORIES if ws]
        best = max(s for s, _ in scores)
        assert r.category == (next(n for s, n in scores if s == best) if best else "Other"), r.t


def test_fragments_in_place_and_parsed(spark):
    """Plain tags and common references are handled without the parser; the outcome is the parser's."""
    import random

    rng = random.Random(9)
    bits = ["<b>", "</b>", "<br/>", "<p class=x>", '<a href="y>z">', "<script>", "</script>", "<title>", "</title>", "&amp;", "&lt;", "&amp;lt;", "&gt", "&nbsp;", "&#39;", "<", ">", "&", "a", " ", "\n", "<!-- x -->", "<!x>", "<?y>", "</ b>", "<B >", "<i\tq>", "é", "<1>", "<titles>"]
    texts = sorted({"".join(rng.choices(bits, k=rng.randint(0, 8))) for _ in range(2000)})
    got = spark.createDataFrame([(t,) for t in [*texts, None]], "t string").select("t", text.strip_html(F.col("t")).alias("out")).collect()
    for r in got:
        assert r.out == (text._html_text(r.t) if r.t and "<" in r.t and ">" in r.t else r.t), r.t
