"""Slowly changing dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.files import kept


def in_blocks(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Rows with ``_part``: blocks of about equal numbers of rows, which never fall along key and order, so that a frequent
    key has many.  The blocks are ranges that Spark samples: what is made of them is to be written, as a second sample may
    differ."""
    return rows.repartitionByRange(key, *order).withColumn("_part", F.spark_partition_id())


def _numbered(rows: DataFrame, key: str, tracked: str, order: list[str], part: Column | None, base: Column) -> DataFrame:
    """Rows with ``version`` (from the key's base on), ``_changed`` (1 where a version opens) and ``_last`` (the key's last
    version).

    A segmented scan: the rows of a key and a part are summed up as (first value, last value, changes between), these are
    scanned in the order of the parts, and each part begins with what those before it come to.  ``part`` never falls
    along ``order``; without it rows are dealt into blocks, so that no task has more than a block, whatever a key's share."""
    marked = in_blocks(rows, key, order) if part is None else rows.withColumn("_part", part)
    inside = Window.partitionBy(key, "_part").orderBy(*order)
    marked = marked.withColumns({"_begins": F.row_number().over(inside) == 1, "_ends": F.lead(F.lit(True)).over(inside).isNull(), "_inner": (~F.col(tracked).eqNullSafe(F.lag(tracked).over(inside))).cast("int")})
    marked = marked.withColumn("_inner", F.when(F.col("_begins"), 0).otherwise(F.col("_inner")))
    marked = kept(marked.withColumn("_within", F.sum("_inner").over(inside.rowsBetween(Window.unboundedPreceding, 0)).cast("int")), "version-parts")
    # A part's first and last row tell what it comes to; the rows between aren't sorted again.
    edges = marked.where(F.col("_begins") | F.col("_ends") | (base > 0))
    parts = edges.groupBy(key, "_part").agg(
        F.max(F.when(F.col("_begins"), F.struct(tracked)))[tracked].alias("_first"), F.max(F.when(F.col("_ends"), F.struct(tracked)))[tracked].alias("_end"), F.max("_within").alias("_all"), F.max(base).alias("_before"),
    )
    across, every = Window.partitionBy(key).orderBy("_part"), Window.partitionBy(key)
    opens = (F.row_number().over(across) == 1) | ~F.col("_first").eqNullSafe(F.lag("_end").over(across))
    parts = parts.withColumn("_opens", opens.cast("int")).withColumn("_upto", F.sum(F.col("_opens") + F.col("_all")).over(across) + F.greatest(F.max("_before").over(every) - 1, F.lit(0)))
    parts = kept(parts.select(F.col(key).alias("_k"), F.col("_part").alias("_p"), "_opens", (F.col("_upto") - F.col("_all")).alias("_start"), F.max("_upto").over(every).cast("int").alias("_last")), "version-starts")
    joined = marked.join(parts, marked[key].eqNullSafe(parts["_k"]) & marked["_part"].eqNullSafe(parts["_p"]))
    out = joined.withColumn("version", (F.col("_start") + F.col("_within")).cast("int")).withColumn("_changed", F.when(F.col("_begins"), F.col("_opens")).otherwise(F.col("_inner")))
    return out.drop("_part", "_inner", "_begins", "_ends", "_within", "_k", "_p", "_opens", "_start")


def versions(rows: DataFrame, key: str, tracked: str, order: list[str], part: Column | None = None) -> DataFrame:
    """Rows with ``version``, counted from 1 per key: a row whose tracked value differs from the one before opens the next.
    ``part`` (else blocks of rows) must not fall along ``order``, such as the day of a time."""
    return _numbered(rows, key, tracked, order, part, F.lit(0)).drop("_changed", "_last")


def scd2_dimension(
    rows: DataFrame, key: str, tracked: str, order: list[str], load_date: Column, current: DataFrame | None = None, part: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(dimension, rows with their version); see ``scd2_places``."""
    dim, places = scd2_places(rows, key, tracked, order, load_date, current, part)
    return dim, rows.join(places, [key, *order], "left")


def scd2_places(
    rows: DataFrame, key: str, tracked: str, order: list[str], load_date: Column, current: DataFrame | None = None, part: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(dimension, (key, order, version) of each row).  ``current`` has key, tracked, valid_from, valid_to, is_current, version of earlier
    loads.  Versions that this load closes and opens get ``load_date``.  ``part`` is as in ``versions``."""
    incoming = rows.select(key, tracked, F.struct(*order).alias("_at"), (F.lit(0) if part is None else part).alias("_of"), F.lit(1).alias("_new"), F.lit(0).alias("_base"), F.lit(None).cast("date").alias("_from"))
    if current is not None:
        none = lambda c: F.lit(None).cast(incoming.schema[c].dataType).alias(c)
        last = current.where("is_current").select(key, tracked, none("_at"), none("_of"), F.lit(0).alias("_new"), F.col("version").alias("_base"), F.col("valid_from").alias("_from"))
        incoming = incoming.unionByName(last)
    marked = _numbered(incoming, key, tracked, ["_new", "_at"], None if part is None else F.struct("_new", "_of"), F.col("_base"))
    ends = F.col("version") < F.col("_last")
    dim = marked.where("_changed = 1").select(
        key, tracked, F.coalesce("_from", load_date).alias("valid_from"), F.when(ends, load_date).alias("valid_to"), (~ends).alias("is_current"), "version",
    )
    if current is not None:
        dim = current.where("not is_current").select(*dim.columns).unionByName(dim).unionByName(
            current.where("is_current").select(*dim.columns).join(dim.select(key).distinct(), key, "left_anti"))
    return dim, marked.where("_new = 1").select(key, *[F.col(f"_at.{c}").alias(c) for c in order], "version")


def snapshot(old: DataFrame, new: DataFrame, key: str, tracked: list[str], load_date: Column) -> DataFrame:
    """Check-strategy snapshot: rows whose tracked columns changed are closed and opened anew, new keys are opened, keys that are
    gone stay as they are.  ``old`` has valid_from, valid_to and is_current besides."""
    now = old.where("is_current")
    joined = now.alias("o").join(new.select(key, *tracked).alias("n"), F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    same = F.lit(True)
    for c in tracked:
        same = same & F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}"))
    changed = F.col(f"o.{key}").isNotNull() & F.col(f"n.{key}").isNotNull() & ~same
    opens = F.col(f"n.{key}").isNotNull() & (F.col(f"o.{key}").isNull() | changed)
    version = lambda side, start, end, current: F.struct(F.col(f"{side}.{key}").alias(key), *[F.col(f"{side}.{c}").alias(c) for c in tracked], start.alias("valid_from"), end.alias("valid_to"), current.alias("is_current"))
    kept = F.when(F.col(f"o.{key}").isNotNull(), version("o", F.col("o.valid_from"), F.when(changed, load_date).otherwise(F.col("o.valid_to")), ~changed))
    opened = F.when(opens, version("n", load_date, F.lit(None).cast("date"), F.lit(True)))
    out = joined.select(F.explode(F.array_compact(F.array(kept, opened))).alias("v")).select("v.*")
    return old.where("not is_current").select(*out.columns).unionByName(out)
