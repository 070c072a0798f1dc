"""Standardised rows into the star schema.  Tables are DataFrames; each operator returns the new version of a table."""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import reference as ref
from ..functions import parse, text
from ..sources.files import kept
from .scd import scd2_places
from .store import RANGED, Store, Version

OPTIONAL = {"skills": "array<string>", "work_mode": "string", "employment_type": "string", "salary_period": "string"}

#: Versions of companies are counted in blocks of 2 ** BLOCK places of a file.
BLOCK = 20

KEPT_ON_UPDATE = ("job_key", "source_job_id", "first_seen_at")


def surrogate_key(*natural: Column) -> Column:
    """A number that depends on the natural key alone."""
    return F.xxhash64(*natural)


def require_columns(df: DataFrame) -> DataFrame:
    """Raises if one of the columns that a load needs is missing; adds the optional ones as nulls."""
    needed = {"job_id", "job_hash", "title_raw", "title_clean", "company_raw", "company_clean", "location_city", "location_gov", "salary_min", "salary_max", "salary_currency",
              "experience_years_min", "experience_years_max", "is_remote", "source", "job_url", "scraped_at", "posted_at", "run_id", "location_raw"}
    if missing := sorted(needed - set(df.columns)):
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.withColumns({c: F.lit(None).cast(t) for c, t in OPTIONAL.items() if c not in df.columns})


def append_new(dim: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """The dimension with the incoming rows whose key it lacks."""
    return dim.unionByName(incoming.dropDuplicates(keys).join(dim.select(*keys), keys, "left_anti"), allowMissingColumns=True)


def upsert_location(dim: DataFrame, governorates: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(dim_location, ref_governorate): unknown governorates are added with the region Unknown."""
    new = rows.select("location_city", "location_gov").distinct()
    govs = append_new(governorates, new.select(F.col("location_gov").alias("governorate"), F.lit("Unknown").alias("region")), ["governorate"])
    return append_new(dim, new.withColumn("location_key", surrogate_key(F.col("location_city"), F.col("location_gov"))), ["location_city", "location_gov"]), govs


def first_values(rows: DataFrame, value: str, key: Column, order: list[str], after: list[str] = []) -> DataFrame:  # noqa: B006
    """(_key, value): of the values with one key (which the value alone gives) the first along ``order`` and ``after``; the
    least without an order.  Values are found by hashing, with the least of the order's last column (a number), before any
    row is sorted."""
    held = [*order[:-1], *after]
    seen = rows.groupBy(value, *held).agg(F.min(order[-1]).alias(order[-1])) if order else rows.select(value).distinct()
    return seen.groupBy(key.alias("_key")).agg((F.min_by(value, F.struct(*order, *after)) if order else F.min(value)).alias(value))


def upsert_skill(dim: DataFrame, rows: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Unseen skills without a category; case doesn't matter.  Of several spellings that come at once, the first along
    ``order`` (and in the list) stays, else the least."""
    named = rows.select(F.posexplode("skills").alias("_place", "skill_name"), *(order or []))
    new = first_values(named, "skill_name", F.lower("skill_name"), order or [], ["_place"] if order else [])
    known = dim.select(F.lower("skill_name").alias("_key"))
    return dim.unionByName(new.join(known, "_key", "left_anti").select("skill_name"), allowMissingColumns=True)


def upsert_date(dim: DataFrame | None, dates: DataFrame) -> DataFrame:
    """``dates`` has one date column per kind of date."""
    names = dates.columns
    every = dates.select(F.explode(F.array(*names)).alias("d")).where("d is not null").distinct().select(*parse.date_attributes(F.col("d")))
    return every if dim is None else append_new(dim, every, ["date_key"])


def upsert_source(dim: DataFrame, rows: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Unseen sources; of the names that come at once, the first along ``order`` is displayed, else the least."""
    new = first_values(rows.select(F.col("source").alias("display_name"), *(order or [])), "display_name", text.normalize_source(F.col("display_name")), order or [])
    return append_new(dim, new.select(F.col("_key").alias("source_name"), "display_name"), ["source_name"])


def upsert_fact(old: DataFrame, new: DataFrame, key: str = "job_hash", kept: tuple[str, ...] = KEPT_ON_UPDATE) -> DataFrame:
    """Rows of both; where both have a key, the new row but for the kept columns.  ``_change`` tells inserted, updated or kept."""
    o, n = old.withColumn("_old", F.lit(True)).alias("o"), new.withColumn("_new", F.lit(True)).alias("n")
    joined = o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    columns = []
    for c in old.columns:
        if c == key or c in kept:
            columns.append(F.coalesce(f"o.{c}", f"n.{c}").alias(c))
        else:
            columns.append(F.when(F.col("n._new"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c))
    change = F.when(F.col("o._old").isNull(), "inserted").when(F.col("n._new").isNull(), "kept").otherwise("updated")
    return joined.select(*columns, change.alias("_change"))


def replace_by_key(old: DataFrame, new: DataFrame, touched: DataFrame, keys: list[str]) -> DataFrame:
    """Old rows of untouched keys and the distinct new rows."""
    return old.join(touched.select(*keys).distinct(), keys, "left_anti").unionByName(new.distinct())


def last_places(rows: DataFrame) -> DataFrame:
    """(job_hash, _file, _ordinal) of the last row of each posting in each file, found by hashing: no row is carried along."""
    return rows.where(F.length("job_hash") > 0).groupBy("job_hash", "_file").agg(F.max("_ordinal").alias("_ordinal"))


def rows_at(rows: DataFrame, places: DataFrame) -> DataFrame:
    """The rows at (job_hash, _file, _ordinal)."""
    at = ["job_hash", "_file", "_ordinal"]
    named = places.select(*[F.col(c).alias(f"_at_{c}") for c in at])
    return rows.join(named, functools.reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_at_{c}")) for c in at])).select(*rows.columns)


def dedupe_last_wins(rows: DataFrame) -> DataFrame:
    """The last row of each posting in each file; rows without a hash are left out."""
    return rows_at(rows, last_places(rows))


def listed_skills(df: DataFrame) -> Column:
    """Skills that standardised rows list, in an array or between | signs: an empty list is none; null where the column is
    missing."""
    if df.schema["skills"].dataType.typeName() != "string":
        return F.col("skills")
    return F.when(F.col("skills").isNotNull(), text.split_skills(F.col("skills")))


def _runs_of(n: int) -> Column:
    """(_n, _gram) of all runs of n words of a title, or of -n characters if n is negative."""
    count = F.size("_words") - n + 1 if n > 0 else F.length("_title") + n + 1
    run = (lambda i: F.array_join(F.slice("_words", i, n), " ")) if n > 0 else (lambda i: F.substring(F.col("_title"), i, F.lit(-n)))
    runs = F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda i: F.struct(F.lit(n).alias("_n"), run(i).alias("_gram")))
    return F.when(count > 0, runs).otherwise(F.array().cast("array<struct<_n:int,_gram:string>>"))


def detect_skills(titles: DataFrame, dim: DataFrame) -> DataFrame:
    """(title, skills) of distinct titles that name a skill of the dimension, with no more of either than one join apart.

    A name is found where it isn't within a longer run of a-z and 0-9, so its words are whole words of the title: titles'
    runs of as many words as names have are joined with the names' words.  Names without such a word (of other scripts,
    or signs) are found as runs of as many characters.  What joins is then looked for with its borders and signs."""
    words = lambda c: F.regexp_extract_all(c, F.lit("[a-z0-9]+"), F.lit(0))
    names = dim.select("skill_name", F.lower("skill_name").alias("_low")).where("_low <> ''").withColumn("_words", words(F.col("_low")))
    names = names.withColumn("_n", F.when(F.size("_words") > 0, F.size("_words")).otherwise(-F.length("_low")))
    names = names.withColumn("_gram", F.when(F.col("_n") > 0, F.array_join("_words", " ")).otherwise(F.col("_low")))
    names = names.withColumn("_pattern", F.concat(F.lit("(?<![a-z0-9])"), F.regexp_replace("_low", r"([^a-z0-9 ])", r"\\$1"), F.lit("(?![a-z0-9])")))
    sizes = [r[0] for r in names.select("_n").distinct().collect()]  # how many words (or characters) names have: as many numbers as the longest has
    low = F.lower(F.coalesce("title", F.lit("")))
    texts = titles.select("title").distinct().withColumn("_title", low).withColumn("_words", words(low))
    if not sizes:
        return texts.select("title", F.array().cast("array<string>").alias("skills")).limit(0)
    grams = F.concat(*[_runs_of(n) for n in sizes])
    found = texts.select("title", "_title", F.explode(F.array_distinct(grams)).alias("g")).select("title", "_title", "g.*").join(names.select("_n", "_gram", "skill_name", "_pattern"), ["_n", "_gram"])
    return found.where(F.expr("_title RLIKE _pattern")).groupBy("title").agg(F.collect_set("skill_name").alias("skills"))


def skill_links(skills: DataFrame, dim: DataFrame) -> DataFrame:
    """(job_key, skill_name) for rows of job_key and skills, in the dimension's spelling, whatever the row's case."""
    links = skills.select("job_key", F.explode("skills").alias("skill")).select("job_key", F.lower("skill").alias("_low")).distinct()
    return links.join(dim.select("skill_name", F.lower("skill_name").alias("_low")), "_low").select("job_key", "skill_name").distinct()


def empty_gold(spark) -> dict[str, DataFrame]:
    """A star schema with the seeds only."""
    seeds = ref.seed_reference(spark)
    frame = lambda schema: spark.createDataFrame([], schema)
    return {
        **seeds, "dim_location": frame("location_city string, location_gov string, location_key bigint"),
        "dim_company": frame("company_clean string, company_raw string, valid_from date, valid_to date, is_current boolean, version int"),
        "dim_date": frame("date_key int, full_date date, year short, quarter short, month short, month_name string, day short, day_of_week short, day_name string, week_of_year short, is_weekend boolean"),
        "fact_job_postings": frame(
            "job_key bigint, job_hash string, source_job_id string, source_name string, company_clean string, company_version int, location_key bigint, category_name string, posted_date date, scraped_date date,"
            " title_raw string, title_clean string, salary_min decimal(12,2), salary_max decimal(12,2), salary_currency string, salary_period string, experience_years_min short, experience_years_max short,"
            " is_remote boolean, work_mode string, employment_type string, job_url string, run_id string, first_seen_at timestamp, last_loaded_at timestamp"),
        "bridge_job_skill": frame("job_key bigint, skill_name string"),
        "etl_load_log": frame("file_path string, rows_in_file bigint, rows_inserted bigint, rows_updated bigint, loaded_at timestamp"),
    }


def new_rows(silver: DataFrame, log: DataFrame, reload: bool) -> DataFrame:
    """Rows of files that the log doesn't name, with the defaults of a load.  Rows without a hash stay, with a null one."""
    rows = require_columns(silver)
    if not reload:
        rows = rows.join(log.select(F.col("file_path").alias("_file")), "_file", "left_anti")
    company, title = parse.clean_str(F.col("company_clean"), "Unknown"), parse.clean_str(F.col("title_clean"))
    return rows.withColumns({
        "job_hash": parse.clean_str(F.col("job_hash")), "company_clean": company, "company_raw": F.coalesce(parse.clean_str(F.col("company_raw")), company),
        "location_city": parse.clean_str(F.col("location_city"), "Unknown"), "location_gov": parse.clean_str(F.col("location_gov"), "Egypt"),
        "title_clean": F.coalesce(title, parse.clean_str(F.col("title_raw"))), "_listed": listed_skills(rows),
        "_posted": parse.date_of(F.col("posted_at")), "_scraped": parse.date_of(F.col("scraped_at")), "_source": text.normalize_source(F.col("source")),
    })


@dataclass
class Incoming:
    """What the files of one load come to, whatever they meet: the dimensions after them, a row per posting (``facts``, with
    the kept columns of the first file that has it and the others of the last), its skills, the rows of a posting and file
    (``per_file``: job_hash, _file, _first), and rows per file."""

    dims: dict[str, DataFrame]
    facts: DataFrame
    skills: DataFrame
    per_file: DataFrame
    in_file: DataFrame


def fold_files(gold: dict[str, DataFrame], silver: DataFrame, load_date: Column, loaded_at: Column, reload: bool = False, files: DataFrame | None = None) -> Incoming:
    """The ordered fold over the files of a load.

    Files count in the order of their names, rows in that of the file.  All rows with a hash feed the dimensions.  Of a
    posting's rows in one file the last counts.  ``files`` (_file) names files that may have no rows."""
    rows = kept(new_rows(silver, gold["etl_load_log"], reload), "load-rows")
    in_file = rows.groupBy(F.col("_file").alias("file_path")).agg(F.count("*").alias("rows_in_file"))
    if files is not None:
        named = files.select(F.col("_file").alias("file_path")).distinct()
        if not reload:
            named = named.join(gold["etl_load_log"].select("file_path"), "file_path", "left_anti")
        in_file = named.join(in_file, "file_path", "full_outer").na.fill(0, ["rows_in_file"])
    usable = rows.where("job_hash is not null")
    order = ["_file", "_ordinal"]
    block = F.struct("_file", F.shiftright("_ordinal", BLOCK))
    company, versions = scd2_places(usable.select("company_clean", "company_raw", *order), "company_clean", "company_raw", order, load_date, gold["dim_company"], block)
    locations, governorates = upsert_location(gold["dim_location"], gold["ref_governorate"], usable)
    skills = upsert_skill(gold["dim_skill"], usable.select(*order, F.col("_listed").alias("skills")), order)
    skills = kept(skills, "load-skills")
    dims = {
        "ref_governorate": governorates, "dim_location": locations, "dim_company": company, "dim_skill": skills,
        "dim_source": upsert_source(gold["dim_source"], usable, order), "dim_date": upsert_date(gold["dim_date"], usable.select("_posted", "_scraped")),
    }
    of = Window.partitionBy("job_hash")  # a row per file
    per_file = last_places(usable)
    per_file = kept(per_file.select("*", (F.min("_file").over(of) == F.col("_file")).alias("_first"), (F.max("_file").over(of) == F.col("_file")).alias("_final")), "load-places")
    earlier = rows_at(usable.select("job_hash", *order, "job_id"), per_file.where("_first and not _final")).select("job_hash", F.struct("job_id").alias("_earlier"))
    last = kept(rows_at(usable, per_file.where("_final")).withColumn("job_key", surrogate_key(F.col("job_hash"))), "load-last-rows")
    last = last.join(earlier, "job_hash", "left").withColumn("_first_id", F.when(F.col("_earlier").isNotNull(), F.col("_earlier.job_id")).otherwise(F.col("job_id")))
    last = kept(last.drop("_earlier").join(versions, ["company_clean", *order]), "load-versioned-rows")
    named = detect_skills(last.where("_listed is null").select(F.col("title_clean").alias("title")), gold["dim_skill"])
    listed = last.where("_listed is not null").select("job_key", F.col("_listed").alias("skills"))
    listed = listed.unionByName(last.where("_listed is null").select("job_key", F.col("title_clean").alias("title")).join(named, "title").select("job_key", "skills"))
    fact = last.select(
        "job_key", "job_hash", parse.clean_str(F.col("_first_id")).alias("source_job_id"), F.col("_source").alias("source_name"), "company_clean", F.col("version").alias("company_version"),
        surrogate_key(F.col("location_city"), F.col("location_gov")).alias("location_key"), text.categorize(F.col("title_clean")).alias("category_name"), F.col("_posted").alias("posted_date"), F.col("_scraped").alias("scraped_date"),
        "title_raw", "title_clean", parse.to_num(F.col("salary_min")).cast("decimal(12,2)").alias("salary_min"), parse.to_num(F.col("salary_max")).cast("decimal(12,2)").alias("salary_max"),
        parse.clean_str(F.col("salary_currency")).alias("salary_currency"), parse.clean_str(F.col("salary_period")).alias("salary_period"),
        parse.to_int(F.col("experience_years_min")).cast("short").alias("experience_years_min"), parse.to_int(F.col("experience_years_max")).cast("short").alias("experience_years_max"), parse.to_bool(F.col("is_remote")).alias("is_remote"),
        parse.clean_str(F.col("work_mode")).alias("work_mode"), parse.clean_str(F.col("employment_type")).alias("employment_type"), "job_url", "run_id", loaded_at.alias("first_seen_at"), loaded_at.alias("last_loaded_at"),
    )
    return Incoming(dims, fact, listed, per_file.select("job_hash", "_file", "_first"), in_file)


def log_rows(incoming: Incoming, changes: DataFrame, loaded_at: Column) -> DataFrame:
    """A row per file, also of files without a usable row.  ``changes`` has job_hash and _change: a new posting is inserted by
    the first of its files and updated by the others."""
    inserts = (F.col("_change") == "inserted") & F.col("_first")
    counts = incoming.per_file.join(changes, "job_hash").groupBy(F.col("_file").alias("file_path")).agg(F.count_if(inserts).alias("rows_inserted"), F.count_if(~inserts).alias("rows_updated"))
    return incoming.in_file.join(counts, "file_path", "left").na.fill(0, ["rows_inserted", "rows_updated"]).withColumn("loaded_at", loaded_at)


def _met(incoming: Incoming, fact: DataFrame, bridge: DataFrame, log: DataFrame, loaded_at: Column) -> dict[str, DataFrame]:
    """Facts, links and log after a load, of the old rows that are given."""
    merged = kept(upsert_fact(fact, incoming.facts), "load-merged-rows")
    links = skill_links(incoming.skills, incoming.dims["dim_skill"])
    new_log = log_rows(incoming, merged.where("_change <> 'kept'").select("job_hash", "_change"), loaded_at)
    return {
        "fact_job_postings": merged.drop("_change"), "bridge_job_skill": replace_by_key(bridge, links, incoming.facts, ["job_key"]), "etl_load_log": replace_by_key(log, new_log, new_log, ["file_path"]),
    }


def load(gold: dict[str, DataFrame], silver: DataFrame, load_date: Column, loaded_at: Column, reload: bool = False, files: DataFrame | None = None) -> dict[str, DataFrame]:
    """One load of standardised rows with _file and _ordinal (typed, or strings as CSV files have them); files in the load
    log are skipped unless ``reload``.  A load of several files gives what loads of one file after the other give."""
    incoming = fold_files(gold, silver, load_date, loaded_at, reload, files)
    return {**gold, **incoming.dims, **_met(incoming, gold["fact_job_postings"], gold["bridge_job_skill"], gold["etl_load_log"], loaded_at)}


def load_into(store: Store, silver: DataFrame, load_date: Column, loaded_at: Column, reload: bool = False, files: DataFrame | None = None) -> Version:
    """The same as a commit to a store, which is begun with the seeds if it is empty.  Only ranges of facts and links that
    have a posting of the load are read and written; everything is committed at once or not at all."""
    base = store.version()
    if not base.number:
        base = store.commit(base, empty_gold(store.spark))
    gold = store.tables(base)
    incoming = fold_files(gold, silver, load_date, loaded_at, reload, files)
    ranges = {t: store.touched(base, t, incoming.facts) for t in RANGED}
    old = {t: store.table(base, t, ranges[t]) for t in RANGED}
    after = _met(incoming, old["fact_job_postings"], old["bridge_job_skill"], gold["etl_load_log"], loaded_at)
    return store.commit(base, {**incoming.dims, **after}, ranges)


def save(gold: dict[str, DataFrame], root: str) -> dict[str, DataFrame]:
    """Writes the tables as one version (a folder that isn't there yet) and reads them back, so that a load starts from
    files and not from the plans of earlier loads."""
    for name, df in gold.items():
        df.write.parquet(f"{root}/{name}")
    return {name: df.sparkSession.read.schema(df.schema).parquet(f"{root}/{name}") for name, df in gold.items()}
