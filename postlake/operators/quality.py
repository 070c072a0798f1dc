"""Row checks with quarantine, and table checks that return what violates them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .. import reference as ref
from ..functions.text import strip


def validation_errors(as_of: Column, fields: tuple[str, ...] = ref.REQUIRED_FIELDS) -> Column:
    """Messages for a standardised row, in order."""
    blank = lambda c: F.coalesce(strip(F.col(c).cast("string")), F.lit("")) == ""
    posted = F.when(F.col("posted_at").rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(F.col("posted_at"), "yyyy-M-d"))
    checks = [F.when(blank(c), F.lit(f"Missing required field: {c}")) for c in fields]
    checks += [
        F.when(posted > as_of, F.lit("Posted date is in the future")), F.when(posted.isNull(), F.lit("Invalid date format in posted_at")),
        F.when(F.col("salary_max") < F.col("salary_min"), F.lit("salary_max is less than salary_min")),
        F.when(~F.coalesce(F.col("job_url").startswith("http"), F.lit(False)), F.lit("Invalid job_url format")),
    ]
    return F.array_compact(F.array(*checks))


def quality_gate(df: DataFrame, as_of: Column) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and the others with their errors joined by |."""
    checked = df.withColumn("validation_errors", validation_errors(as_of))
    return checked.where(F.size("validation_errors") == 0).drop("validation_errors"), checked.where(F.size("validation_errors") > 0).withColumn("validation_errors", F.array_join("validation_errors", "|"))


def not_unique(df: DataFrame, *keys: str) -> DataFrame:
    return df.where(F.col(keys[0]).isNotNull()).groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def is_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def not_accepted(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(values))


def orphans(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).join(parent.select(F.col(parent_column).alias(column)), column, "left_anti")


def out_of_range(df: DataFrame, low: str, high: str) -> DataFrame:
    return df.where(F.col(high) < F.col(low))


def not_single_current(df: DataFrame, key: str) -> DataFrame:
    return not_unique(df.where("is_current"), key)


def coverage(df: DataFrame, condition: Column) -> DataFrame:
    """Share of rows for which it holds."""
    return df.agg(F.avg(F.coalesce(condition, F.lit(False)).cast("int")).alias("coverage"))


def facet_values(df: DataFrame, column: str, vocabulary: list[str]) -> DataFrame:
    return df.agg(F.count_distinct(column).alias("n_values"), F.count_if(~F.col(column).isin(vocabulary)).alias("unknown_values"))


def dq_suite(checks: list[tuple[str, str, DataFrame]]) -> DataFrame:
    """(check, column, violations) for a list of named violation tables."""
    out = None
    for name, column, bad in checks:
        row = bad.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check_name"), F.lit(column).alias("column_name"), "violations")
        out = row if out is None else out.unionByName(row)
    return out


def table_checks(df: DataFrame, checks: list[tuple[str, str, Column]]) -> DataFrame:
    """(check_name, column_name, violations) of conditions on single rows: all checks of a table in one scan of it."""
    counted = df.agg(*[F.count_if(condition).alias(f"_{k}") for k, (_, _, condition) in enumerate(checks)])
    rows = F.array(*[F.struct(F.lit(name).alias("check_name"), F.lit(column).alias("column_name"), F.col(f"_{k}").alias("violations")) for k, (name, column, _) in enumerate(checks)])
    return counted.select(F.explode(rows).alias("c")).select("c.*")


def written_with_checks(df: DataFrame, path: str, checks: list[tuple[str, str, Column]], mode: str = "errorifexists") -> dict[str, int]:
    """Writes a table and counts in passing: its rows and, by check name, the rows that a condition holds for.  What was
    written isn't read again."""
    seen = Observation("checks")
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(condition).alias(name) for name, _, condition in checks]).write.mode(mode).parquet(path)
    return dict(seen.get)
