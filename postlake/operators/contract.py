"""Raw records: coercion, identity, checks, first-wins deduplication and the seen set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import reference as ref
from ..functions.text import bound, is_tech, strip


def as_str(c: Column) -> Column:
    """Stripped string; null and NaN are empty."""
    return bound(strip(c.cast("string")), lambda s: F.coalesce(F.when(F.lower(s) != "nan", s), F.lit("")))


def job_id(title: Column, company: Column, location: Column) -> Column:
    return F.md5(F.concat_ws("-", title, company, location))


def to_contract(df: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """The 13 fields, as strings, in their order; blank title, company and location become N/A.  Missing columns are
    blank; without a job_id column the id is made of title, company and location.  ``also`` names columns that stay."""
    have = {c: as_str(F.col(c)) if c in df.columns else F.lit("") for c in ref.CONTRACT_FIELDS}
    for c in ("title", "company", "location"):
        have[c] = bound(have[c], lambda s: F.when(s == "", "N/A").otherwise(s))
    if "job_id" not in df.columns:
        have["job_id"] = job_id(have["title"], have["company"], have["location"])
    extra = [c for c in ("_file", "_ordinal") if c in df.columns]
    return df.select(*[have[c].alias(c) for c in ref.CONTRACT_FIELDS], *extra, *also)


def format_salary(low: Column, high: Column, currency: Column, interval: Column) -> Column:
    lo, hi, cur, per = (as_str(c) for c in (low, high, currency, interval))
    body = F.when((lo != "") & (hi != ""), F.concat_ws(" - ", lo, hi)).otherwise(F.concat(lo, hi))
    full = F.concat(body, F.when(cur != "", F.concat(F.lit(" "), cur)).otherwise(""), F.when(per != "", F.concat(F.lit(" / "), per)).otherwise(""))
    return F.when(body == "", "").otherwise(full)


def contract_violations(df: DataFrame) -> Column:
    """Messages; a field that is null counts as missing."""
    missing = [F.when(F.col(c).isNull() if c in df.columns else F.lit(True), F.lit(f"missing field: {c}")) for c in ref.CONTRACT_FIELDS]
    empty = lambda c: F.coalesce(F.col(c), F.lit("")).isin("", "N/A")
    neither = F.when(empty("title") & empty("company"), F.lit("record has neither title nor company")) if {"title", "company"} <= set(df.columns) else F.lit(None).cast("string")
    return F.array_compact(F.array(*missing, neither))


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key; a partial minimum per task precedes the shuffle."""
    return _keep(df, keys, F.min_by, order)


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return _keep(df, keys, F.max_by, order)


def _keep(df: DataFrame, keys: list[str], pick, order: list[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias("_row")).select(*[c if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def dedupe_within_run(df: DataFrame) -> DataFrame:
    return keep_first(df, ["run_id", "source", "job_id"], ["_file", "_ordinal"])


def drop_seen(df: DataFrame, seen: DataFrame, keys: list[str] = ["source", "job_id"], incremental: bool = True) -> DataFrame:  # noqa: B006
    return df.join(seen.select(*keys).distinct(), keys, "left_anti") if incremental else df


def add_seen(df: DataFrame, seen: DataFrame, keys: list[str] = ["source", "job_id"]) -> DataFrame:  # noqa: B006
    new = df.select(*keys).distinct()
    return seen.select(*keys).unionByName(new.join(seen.select(*keys), keys, "left_anti"))


def tech_only(df: DataFrame) -> DataFrame:
    return df.where(is_tech(F.col("title"), F.col("industry")))


def cap_rows(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first n rows in arrival order."""
    return df.orderBy(*order).limit(n)


def row_to_record(df: DataFrame, source: str) -> DataFrame:
    """A provider's table with salary columns as contract records."""
    named = df.select(
        F.col("title"), F.col("company"), F.col("location"), format_salary(F.col("min_amount"), F.col("max_amount"), F.col("currency"), F.col("interval")).alias("salary"),
        F.col("description"), F.col("experience_range").alias("experience"), F.col("date_posted").cast("string").alias("posted_at_raw"), F.col("company_industry").alias("industry"),
        F.col("job_url"), F.lit(source).alias("source"), F.col("scraped_at"), F.col("run_id"),
    )
    return to_contract(named)


def union_sources(*tables: DataFrame) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out
