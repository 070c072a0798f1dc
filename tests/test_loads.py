"""Loads of several files, versions of a store, skills of a dimension and versions of frequent keys."""

import random
import re

import pytest
from pyspark.sql import functions as F

from postlake.operators import load, scd, store

DAY, AT = "2024-03-01", "2024-03-01 00:00:00"
NAMES = ["job_id", "job_hash", "title_raw", "title_clean", "company_raw", "company_clean", "location_raw", "location_city", "location_gov", "salary_min", "salary_max", "salary_currency", "experience_years_min", "experience_years_max",
         "is_remote", "source", "job_url", "scraped_at", "posted_at", "run_id", "skills", "_file", "_ordinal"]
SILVER = ", ".join(f"{n} {'long' if n == '_ordinal' else 'string'}" for n in NAMES)


def row(file, ordinal, **more):
    base = dict.fromkeys(NAMES, "x") | {"title_clean": "Data Engineer", "company_raw": "Acme", "company_clean": "Acme", "salary_min": "5", "salary_max": "", "is_remote": "true", "scraped_at": "2024-01-02", "posted_at": "2024-01-01", "experience_years_min": "", "experience_years_max": "", "skills": ""}
    return tuple((base | {"_file": file, "_ordinal": ordinal} | more)[n] for n in NAMES)


def frame(spark, rows):
    return spark.createDataFrame(rows, SILVER)


def names_of(spark, *files):
    return spark.createDataFrame([(f,) for f in files], "_file string")


def at():
    return F.lit(DAY).cast("date"), F.lit(AT).cast("timestamp")


def rows_of(gold):
    return {t: sorted(map(repr, df.select(*sorted(df.columns)).collect())) for t, df in gold.items()}


def random_files(seed, n_files=4):
    rng = random.Random(seed)
    out = {}
    for f in range(n_files):
        out[f"f{f}"] = [
            row(f"f{f}", k, job_id=f"id{rng.randrange(50)}", job_hash=rng.choice(["", "nan", *[f"h{j}" for j in range(12)]]), title_clean=rng.choice(["Rust Dev", "C++ and sql", "", "nothing"]), company_clean=rng.choice(["A", "B", "", "C"]),
                company_raw=rng.choice(["A", "A inc", ""]), location_city=rng.choice(["Maadi", "Nowhere", ""]), location_gov=rng.choice(["Cairo", "Mars", ""]), posted_at=rng.choice(["2024-01-01", "2024-02-02", "bad", ""]), source=rng.choice(["s", " S ", "t"]),
                skills=rng.choice([None, "", "rust|SQL", "Rust", "zig|ZIG"]), salary_min=rng.choice(["", "7", "n/a"]), run_id=f"r{k}")
            for k in range(rng.randrange(0, 25))
        ]
    return out


@pytest.mark.parametrize("seed", range(2))
def test_batch_equals_single_loads(spark, tmp_path, seed):
    """A load of n files gives what n loads of one file give, also a reload, also with files without rows."""
    made = random_files(seed)
    made["f9"] = []
    every = frame(spark, [r for rows in made.values() for r in rows])
    start = load.empty_gold(spark)
    # Detection looks at the dimension as it is when a load begins: all single loads here belong to one run.
    single = start
    for run, name in enumerate(sorted(made)):
        step = load.load({**single, "dim_skill": single["dim_skill"]}, frame(spark, made[name]), *at(), files=names_of(spark, name))
        single = load.save(step, str(tmp_path / f"single{run}"))
    batch = load.save(load.load(start, every, *at(), files=names_of(spark, *made)), str(tmp_path / "batch"))
    got, want = rows_of(batch), rows_of(single)
    learnt = {"zig", "rust"}  # skills that an earlier file has taught are detected in titles by later single loads only
    for t in got:
        if t != "bridge_job_skill":
            assert got[t] == want[t], t
    assert set(got["bridge_job_skill"]) <= set(want["bridge_job_skill"])
    assert all(any(s in x.lower() for s in learnt) for x in set(want["bridge_job_skill"]) - set(got["bridge_job_skill"]))
    again = load.load(batch, every, *at(), reload=True, files=names_of(spark, *made))
    log = {r.file_path: (r.rows_in_file, r.rows_inserted, r.rows_updated) for r in again["etl_load_log"].collect()}
    hashes = {f: {r[1] for r in rows} - {"", "nan"} for f, rows in made.items()}
    assert log == {f: (len(rows), 0, len(hashes[f])) for f, rows in made.items()}


def test_kept_columns_and_dimensions_of_superseded_rows(spark):
    """The first file gives what is kept on update; rows that a later file supersedes still feed the dimensions and the log."""
    rows = [row("f1", 0, job_id="first", job_hash="h", location_city="Maadi", posted_at="2024-01-01", skills="Rust"), row("f2", 0, job_id="second", job_hash="h", location_city="Giza", posted_at="2024-02-01", skills="SQL"), row("f3", 0, job_hash="")]
    gold = load.load(load.empty_gold(spark), frame(spark, rows), *at())
    fact = gold["fact_job_postings"].first()
    assert (fact.source_job_id, str(fact.posted_date)) == ("first", "2024-02-01")
    assert {(r.file_path, r.rows_in_file, r.rows_inserted, r.rows_updated) for r in gold["etl_load_log"].collect()} == {("f1", 1, 1, 0), ("f2", 1, 0, 1), ("f3", 1, 0, 0)}
    assert {r.location_city for r in gold["dim_location"].collect()} == {"Maadi", "Giza"}
    assert {str(r.full_date) for r in gold["dim_date"].collect()} == {"2024-01-01", "2024-02-01", "2024-01-02"}
    assert "Rust" in {r.skill_name for r in gold["dim_skill"].collect()}
    assert [r.skill_name for r in gold["bridge_job_skill"].collect()] == ["SQL"]


def parquet_files(root):
    return {str(p.relative_to(root)) for p in (root / "tables").rglob("*.parquet")}


def test_only_touched_ranges_are_written(spark, tmp_path):
    """A load whose postings are all in one range leaves the files of the others; the outcome is that of the whole merge."""
    s = store.Store(spark, str(tmp_path / "gold"), bits=3)
    first = frame(spark, [row("f1", k, job_hash=f"h{k}", job_id=str(k), skills="SQL|Rust") for k in range(300)])
    v2 = load.load_into(s, first, *at())
    assert v2.number == 2 and len(v2.ranges["fact_job_postings"]) == 8
    before, old = parquet_files(tmp_path / "gold"), {r.job_hash: r.range for r in s.table(v2, "fact_job_postings").select("job_hash", store.range_of(F.col("job_key"), 3).alias("range")).collect()}
    chosen = sorted(h for h, r in old.items() if r == 5)[:3]
    second = frame(spark, [row("f2", k, job_hash=h, job_id="new", title_clean="Changed", skills="Go") for k, h in enumerate(chosen)])
    whole = rows_of(load.load(s.tables(v2), second, *at()))
    v3 = load.load_into(s, second, *at())
    assert rows_of(s.tables(v3)) == whole
    for t in store.RANGED:
        assert {r for r, c in v3.ranges[t].items() if c != v2.ranges[t][r]} == {5}
        assert s.touched(v3, t, s.table(v3, "fact_job_postings").where(F.col("job_hash").isin(chosen))) == [5]
    assert before <= parquet_files(tmp_path / "gold")
    scanned = s.table(v3, "fact_job_postings", [5]).inputFiles()
    assert scanned and all("_range=5" in f for f in scanned)
    with pytest.raises(ValueError, match="outside"):
        s.commit(v3, {"bridge_job_skill": s.table(v3, "bridge_job_skill")}, {"bridge_job_skill": [5]})
    removed = s.vacuum(keep=1)
    assert removed and rows_of(s.tables()) == whole and s.numbers() == [3]
    assert s.vacuum(keep=1) == []


def test_a_killed_load_leaves_the_last_version(spark, tmp_path, monkeypatch):
    """A load that ends between two tables commits nothing; repeated, it gives what it would have given."""
    s = store.Store(spark, str(tmp_path / "gold"), bits=2)
    load.load_into(s, frame(spark, [row("f1", k, job_hash=f"h{k}") for k in range(20)]), *at())
    before = rows_of(s.tables())
    more = frame(spark, [row("f2", k, job_hash=f"h{k}", title_clean="Later", company_raw="Acme inc", skills="Zig") for k in range(10, 40)])
    want = rows_of(load.load(s.tables(), more, *at()))

    class Killed(Exception):
        pass

    kill = lambda self, new: (_ for _ in ()).throw(Killed())
    with monkeypatch.context() as m:  # all tables are written, the list isn't
        m.setattr(store.Store, "_publish", kill)
        with pytest.raises(Killed):
            load.load_into(s, more, *at())
    assert rows_of(store.Store(spark, str(tmp_path / "gold")).tables()) == before
    orphaned = parquet_files(tmp_path / "gold")
    real = store.range_of
    with monkeypatch.context() as m:  # some tables are written

        def failing(key, bits):
            if bits and len(calls) > 1:
                raise Killed()
            calls.append(bits)
            return real(key, bits)

        calls = [0, 0]
        m.setattr(store, "range_of", failing)
        with pytest.raises(Killed):
            s.commit(s.version(), s.tables())
    assert rows_of(s.tables()) == before and s.version().number == 2
    load.load_into(s, more, *at())
    assert rows_of(s.tables()) == want and s.version().number == 3
    removed = s.vacuum(keep=2)
    assert removed and not (orphaned & parquet_files(tmp_path / "gold")) - {f for f in orphaned if (tmp_path / "gold" / f).exists()}
    assert rows_of(s.tables()) == want and rows_of(s.tables(s.version(2))) == before


def test_two_runs_from_one_version(spark, tmp_path):
    s = store.Store(spark, str(tmp_path / "gold"))
    base = s.commit(s.version(), load.empty_gold(spark))
    s.commit(base, {"dim_skill": s.table(base, "dim_skill").limit(1)})
    with pytest.raises(RuntimeError, match="another run"):
        s.commit(base, {"dim_skill": s.table(base, "dim_skill").limit(2)})
    assert s.table(s.version(), "dim_skill").count() == 1 and s.numbers() == [1, 2]


def test_skills_learnt_by_an_earlier_load(spark):
    day, now = at()
    gold = load.load(load.empty_gold(spark), frame(spark, [row("f1", 0, job_hash="a", skills="Quantum Basket-Weaving|بايثون")]), day, now)
    titles = {"b": "Senior quantum basket-weaving expert", "c": "quantum  basket-weaving", "d": "xquantum basket-weaving", "e": "مطور بايثون", "f": "C++ dev"}
    gold = load.load(gold, frame(spark, [row("f2", k, job_hash=h, title_clean=t, skills=None) for k, (h, t) in enumerate(titles.items())]), day, now)
    found = gold["bridge_job_skill"].join(gold["fact_job_postings"], "job_key").select("job_hash", "skill_name").collect()
    assert {(r.job_hash, r.skill_name) for r in found} == {("a", "Quantum Basket-Weaving"), ("a", "بايثون"), ("b", "Quantum Basket-Weaving"), ("e", "بايثون"), ("f", "C++")}


def test_detection_by_brute_force(spark):
    rng = random.Random(3)
    parts = ["c", "c++", "go", "node.js", "rest api", "sql", "é", "日本", "#", "a1", "(x)", "\\e", "İ"]
    names = sorted({rng.choice(["", " "]).join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(60)})
    titles = sorted({rng.choice(["", " ", "/"]).join(rng.choices([*parts, "golang", "x"], k=rng.randint(0, 8))) for _ in range(300)})
    got = load.detect_skills(spark.createDataFrame([(t,) for t in [*titles, *titles, None]], "title string"), spark.createDataFrame([(n,) for n in names], "skill_name string"))
    got = {(r.title, n) for r in got.collect() for n in r.skills}
    lower = lambda x: x.replace("İ", "i̇").lower()
    want = {(t, n) for t in titles for n in names if re.search(r"(?<![a-z0-9])" + re.escape(lower(n)) + r"(?![a-z0-9])", lower(t))}
    assert got == want and len(want) > 100
    assert load.detect_skills(spark.createDataFrame([("t",)], "title string"), spark.createDataFrame([], "skill_name string")).count() == 0


def test_one_key_over_many_blocks(spark):
    """All rows are of one key and one file: blocks share them, and versions are those of a walk over the rows."""
    rng = random.Random(4)
    values = [rng.choice(["x", "y", None]) for _ in range(2000)]
    df = spark.createDataFrame([("k" if k % 50 else "other", v, 0, k) for k, v in enumerate(values)], "key string, raw string, file int, n int").repartition(7)
    coalesce = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        blocks = scd.in_blocks(df, "key", ["file", "n"]).where("key = 'k'").groupBy("_part").count().collect()
        assert len(blocks) == 4 and max(r["count"] for r in blocks) < 1000
        got = {r.n: r.version for r in scd.versions(df, "key", "raw", ["file", "n"]).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    want, last = {}, {}
    for k, v in enumerate(values):
        key = "k" if k % 50 else "other"
        version, before = last.get(key, (0, object()))
        last[key] = (version + (version == 0 or v != before), v)
        want[k] = last[key][0]
    assert got == want
