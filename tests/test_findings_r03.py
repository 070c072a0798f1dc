"""Cases of the third round's findings."""

import random

import pytest
from pyspark.sql import functions as F

from postlake import catalog, catalog_layers  # noqa: F401
from postlake.functions import parse
from postlake.sources import pages


def _dump(e):
    return e.tag, e.attrs, [x if isinstance(x, str) else _dump(x) for x in e.inside]


def test_plain_pages_are_read_as_the_parser_reads_them(monkeypatch):
    plain = ['<li class="has-pointer-d a">', "</li>", "<h2>", "</h2>", '<A HREF="/x">', "</a>", "T & b", "&amp;", "<br/>", "<br>", "<p>", "</p >", '<dt class="jb-label-salary">', " x ", "الراتب", "<span/>", ">"]
    other = ["<!-- c -->", "<script>a<b</script>", "<a href='q'>", '<a href="a&amp;b">', "<x", "< ", "<title>", "</div class=x>"]
    draw = random.Random(7)
    for k in range(1500):
        html = "".join(draw.choice(plain + other * (k % 2)) for _ in range(draw.randint(0, 25)))
        assert _dump(pages.page_of(html)) == _dump(pages.parsed_page(html)), html
        e, p = pages.page_of(html), pages.parsed_page(html)
        assert [[y.tag for y in x.elements()] for x in e.elements()] == [[y.tag for y in x.elements()] for x in p.elements()]
    monkeypatch.setattr(pages, "parsed_page", lambda html: pytest.fail("a plain page went to the parser"))
    pages.page_of("".join(plain))


@pytest.mark.parametrize("name", ["parse_listing_wuzzuf", "parse_listing_bayt", "parse_listing_forasna", "parse_listing_sql"])
def test_pages_of_one_file_are_dealt_out(spark, small, name):
    plan = catalog.QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "ArrowEvalPythonUDTF" not in plan


def _plan(df, stage="optimizedPlan"):
    return getattr(df._jdf.queryExecution(), stage)().toString()


def test_a_batch_is_read_and_cleaned_once(spark, small):
    assert _plan(catalog.QUERIES["clean_batch"](spark, small)).count("Relation [") == 1


def test_parts_of_a_batch(spark):
    from postlake.sources.files import parse_bronze
    from postlake.streaming import incremental

    values = ["[{", '[{"title": "", "company": "N/A", "job_id": "2", "job_url": "u"}]', '[{"title": "QA", "company": "A", "salary": "1.2.3"}]']
    files = spark.createDataFrame([(v, f"raw/src/2024-01-02/{k}.json") for k, v in enumerate(values)], "value string, _file string")
    valid, failed, rejected = incremental.clean_batch(parse_bronze(files), F.lit("2024-06-01").cast("date"))
    assert valid.count() == failed.count() == 0 and "validation_errors" in failed.columns and "validation_errors" not in rejected.columns
    a, b, c = rejected.orderBy("_file").collect()
    assert (a.clean_error, a.source, a.job_id, a._ordinal, a.title_clean) == ("the file isn't an array of records", "src", None, None, None)
    assert (b.clean_error, b.source, b.job_id, b._ordinal, b.job_url, b.title_clean, b.work_mode) == ("record has neither title nor company", "src", "2", 0, "u", None, None)
    assert (c.clean_error, c.title_clean, c.work_mode) == ("salary isn't a number", "QA", "on-site")


def test_a_salary_and_a_date_are_stripped_once(spark):
    df = spark.range(1).select(parse.parse_salary(F.col("id").cast("string")).alias("s"))
    assert _plan(df, "analyzed").count("regexp_replace") == 1
    df = spark.range(1).select(parse.parse_posted_date(F.col("id").cast("string"), F.lit("x")).alias("s"))
    assert _plan(df, "analyzed").count("regexp_replace") == 2


def test_chunks_of_an_array_are_dealt_out(spark):
    from postlake.sources import arrays

    files = spark.createDataFrame([("f", 100)], "path string, length bigint")
    assert _plan(arrays.split_arrays(files), "executedPlan").count("REPARTITION_BY_NUM") >= 2


@pytest.mark.parametrize("name", ["mart_skill_demand", "lattice_skill_demand"])
def test_links_are_dealt_by_posting(spark, small, name):
    assert _plan(catalog.QUERIES[name](spark, small), "executedPlan").count("REPARTITION_BY_NUM") >= 1


def test_counts_are_passed_on_in_small_batches(monkeypatch):
    import pyarrow as pa

    from postlake.llm import divergence

    monkeypatch.setattr(divergence, "BATCH", 7, raising=False)
    texts = [" ".join(f"w{chr(97 + k % 26)}{chr(97 + j % 26)}" for j in range(40)) for k in range(50)]
    batch = pa.record_batch({"lang": ["en"] * 50, "source": ["s"] * 50, "text": texts})
    out = list(divergence._counter(10_000)(iter([batch])))
    assert max(b.num_rows for b in out) <= 7 and sum(sum(b.column("n").to_pylist()) for b in out) == 2000
    parts = [divergence.count_terms(*[batch.column(c) for c in ("lang", "source", "text")])] * 2
    assert divergence._merged(parts).num_rows > 0 and not parts


def test_last_rows_and_first_names_are_found_by_hashing(spark):
    """no task sorts whole rows (in memory) to find the last of each posting, or the first of few names."""
    from postlake.operators import load

    rows = spark.createDataFrame([("h", "f1", 2, "old", " S "), ("h", "f1", 1, "older", "s"), ("h", "f2", 0, "new", "t"), ("", "f2", 1, "none", "t")], "job_hash string, _file string, _ordinal long, job_id string, source string")
    assert {(r._file, r.job_id) for r in load.dedupe_last_wins(rows).collect()} == {("f1", "old"), ("f2", "new")}
    assert "SortAggregate" not in _plan(load.dedupe_last_wins(rows), "executedPlan")
    dim = spark.createDataFrame([], "source_name string, display_name string")
    named = load.upsert_source(dim, rows, ["_file", "_ordinal"])
    assert {(r.source_name, r.display_name) for r in named.collect()} == {("s", "s"), ("t", "t")}
    assert _plan(load.first_values(rows, "source", F.lower("source"), ["_file", "_ordinal"]), "executedPlan").split("SortAggregate")[-1].count("HashAggregate") == 2


def test_grains_are_counted_by_their_own_keys(spark, small, monkeypatch):
    """a posting isn't multiplied into wide rows of all grains' keys; what grains read of it is written once."""
    made, lattice = [], catalog.lattice
    monkeypatch.setattr(lattice, "kept", lambda rows, path=None: made.append(rows) or rows)
    lattice.base(catalog.postings(spark, small), catalog.skill_links(spark, small))
    assert len(made) == 1 and "Generate explode" not in _plan(made[0]) and not any("orders" in f for f in made[0].inputFiles())
