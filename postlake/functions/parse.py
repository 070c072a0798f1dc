"""Column expressions on numbers and dates in strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import reference as ref
from .text import bound, first_match, strip


def western_digits(c: Column) -> Column:
    """Arabic-Indic digits as 0-9."""
    return F.translate(c, "٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹", "01234567890123456789")


def parse_salary_period(c: Column) -> Column:
    return first_match(F.lower(c), ref.SALARY_PERIODS, F.lit(None).cast("string"))


def parse_salary(c: Column) -> Column:
    """struct(min, max, currency, period, error): error if a run of digits and points isn't a number."""

    def parsed(low: Column) -> Column:
        none = low.isin("", "n/a", "confidential")
        runs = F.when(~none, F.regexp_extract_all(F.replace(western_digits(low), F.lit(","), F.lit("")), F.lit(r"([\d.]+)"), 1))
        numbers = F.transform(runs, lambda x: x.try_cast("double"))
        usd = ~none & (low.contains("$") | low.contains("usd"))
        period = F.when(~none, parse_salary_period(low))

        def ends(n: Column) -> Column:
            bad = F.coalesce(F.exists(n, lambda x: x.isNull()), F.lit(False))
            high = F.coalesce(F.get(n, F.lit(1)), F.get(n, F.lit(0)))
            return F.struct(F.when(~bad, F.get(n, F.lit(0))).alias("min"), F.when(~bad, high).alias("max"), F.when(usd, "USD").otherwise("EGP").alias("currency"), period.alias("period"), bad.alias("error"))

        return bound(numbers, ends)

    return bound(F.lower(strip(F.coalesce(c, F.lit("")))), parsed)


def parse_experience(c: Column) -> Column:
    """struct(min, max) of the first two numbers up to 50."""
    runs = F.transform(F.regexp_extract_all(western_digits(F.coalesce(c, F.lit(""))), F.lit(r"(\d+)"), 1), lambda x: x.try_cast("int"))
    years = F.filter(runs, lambda x: x <= 50)
    return F.struct(F.get(years, F.lit(0)).alias("min"), F.get(years, F.lit(1)).alias("max"))


def parse_posted_date(c: Column, scraped_at: Column) -> Column:
    """struct(value, error).  A leading ISO date as it is; n hours, days, weeks or months (of 30 days) before the scrape;
    else its date.  Error: such a word without a number, or a scrape time that isn't ISO."""
    at = F.coalesce(strip(scraped_at.cast("string")), F.lit(""))
    low = F.lower(strip(western_digits(F.coalesce(c, F.lit("")))))

    def parsed(x: Column) -> Column:
        low, at = x["low"], x["at"]
        ts = F.try_to_timestamp(F.replace(at, F.lit("T"), F.lit(" "))).cast("timestamp_ntz")
        n = F.regexp_extract(low, r"(\d+)", 1).try_cast("int")
        unit = F.when(low.contains("hour"), "h").when(low.contains("day"), "d").when(low.contains("week"), "w").when(low.contains("month"), "m")
        return bound(F.struct(at.alias("at"), F.regexp_extract(low, r"^(\d{4}-\d{2}-\d{2})", 1).alias("iso"), ts.alias("ts"), n.alias("n"), unit.alias("unit")), dated)

    def dated(x: Column) -> Column:
        at, iso, ts, n, unit = (x[k] for k in ("at", "iso", "ts", "n", "unit"))
        hours = n * F.when(unit == "h", 1).when(unit == "d", 24).when(unit == "w", 168).when(unit == "m", 720)
        bad = (iso == "") & (at != "") & (ts.isNull() | (unit.isNotNull() & n.isNull()))
        value = F.when(at == "", F.when(iso != "", iso).otherwise("")).when(iso != "", iso).otherwise(
            F.date_format(F.when(hours.isNotNull(), ts - F.make_dt_interval(hours=hours)).otherwise(ts), "yyyy-MM-dd")
        )
        return F.struct(F.when(~bad, value).alias("value"), F.coalesce(bad, F.lit(False)).alias("error"))

    return bound(F.struct(low.alias("low"), at.alias("at")), parsed)


def _filled(c: Column) -> Column:
    s = strip(c.cast("string"))
    return F.when(~F.lower(s).isin("", "nan", "none", "null"), s)


def to_num(c: Column) -> Column:
    s = _filled(c)
    return F.when(s.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), s.try_cast("double"))


def to_int(c: Column) -> Column:
    return to_num(c).try_cast("int")


def to_bool(c: Column) -> Column:
    return F.coalesce(F.lower(strip(c.cast("string"))).isin("true", "1", "yes", "t"), F.lit(False))


def clean_str(c: Column, default: str | None = None) -> Column:
    return bound(strip(c.cast("string")), lambda s: F.when(F.coalesce(F.lower(s), F.lit("")).isin("", "nan"), F.lit(default)).otherwise(s))


def date_of(c: Column) -> Column:
    return F.try_to_date(F.substring(c.cast("string"), 1, 10), "yyyy-MM-dd")


def date_key(d: Column) -> Column:
    return F.year(d) * 10000 + F.month(d) * 100 + F.day(d)


def date_attributes(d: Column) -> list[Column]:
    dow = F.weekday(d) + 1
    return [
        date_key(d).alias("date_key"), d.alias("full_date"), F.year(d).cast("short").alias("year"), F.quarter(d).cast("short").alias("quarter"),
        F.month(d).cast("short").alias("month"), F.date_format(d, "MMMM").alias("month_name"), F.day(d).cast("short").alias("day"),
        dow.cast("short").alias("day_of_week"), F.date_format(d, "EEEE").alias("day_name"), F.weekofyear(d).cast("short").alias("week_of_year"), dow.isin(5, 6).alias("is_weekend"),
    ]


def salary_mid(low: Column, high: Column) -> Column:
    return F.when(low.isNotNull() & high.isNotNull(), F.round((low + high) / 2, 2)).otherwise(F.coalesce(low, high))


def share(part: Column, total: Column) -> Column:
    """Percent with two digits, in decimals."""
    return F.round(F.lit(100).cast("decimal(5,1)") * part.cast("decimal(18,0)") / F.when(total != 0, total).cast("decimal(18,0)"), 2)


def ratio(a: Column, b: Column) -> Column:
    return F.round(a.cast("decimal(18,0)") / F.when(b != 0, b).cast("decimal(18,0)"), 2)
