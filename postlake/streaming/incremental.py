"""Incremental runs: each handles the files that are new since the last, with the checkpoint as the record of what is done."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import clean_records
from ..operators.contract import contract_violations, keep_first, to_contract
from ..operators.quality import validation_errors
from ..sources.files import parse_bronze, write_run_report


def stream_bronze(spark: SparkSession, root: str) -> DataFrame:
    """Raw records of files as they appear."""
    files = spark.readStream.format("text").option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").schema("value string").load(root)
    return parse_bronze(files.select("value", F.col("_metadata.file_path").alias("_file")))


def drop_seen_stream(records: DataFrame) -> DataFrame:
    """The first record of each source and id over all runs; the ids are the query's state."""
    return records.dropDuplicates(["source", "job_id"])


class SeenTable:
    """Ids that earlier batches have had, as a table in buckets of their hash: what a stream remembers is on disk, and its
    memory doesn't grow with the number of ids.

    A batch is compared with the ids of the batches before it alone, and those of its buckets; its own are written under its
    number.  So a batch that is repeated, whether or not its ids were written, gives the same rows again."""

    def __init__(self, path: str, keys: list[str], buckets: int = 64) -> None:
        self.path, self.keys, self.buckets = path, keys, buckets

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def ids(self, spark: SparkSession, number: int) -> DataFrame:
        """The ids of the batches before that number: keys, bucket and batch."""
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            return spark.createDataFrame([], ", ".join([*(f"{k} string" for k in self.keys), "bucket int, batch bigint"]))
        return spark.read.parquet(self.path).where(F.col("batch") < number)

    def fresh(self, rows: DataFrame, number: int, order: list[str]) -> DataFrame:
        """The first row along ``order`` of each id that no earlier batch has had."""
        firsts = keep_first(rows, self.keys, order).withColumn("_bucket", self._bucket())
        old = self.ids(rows.sparkSession, number)
        touched = [r[0] for r in firsts.select("_bucket").distinct().collect()]  # as many numbers as there are buckets
        old = old.where(F.col("bucket").isin(touched)).select(*[F.col(k).alias(f"_seen_{k}") for k in self.keys], F.col("bucket").alias("_seen_bucket"))
        same = F.col("_bucket") == F.col("_seen_bucket")
        for k in self.keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_seen_{k}"))
        return firsts.join(old, same, "left_anti").drop("_bucket")

    def add(self, fresh: DataFrame, number: int) -> None:
        """Writes a batch's new ids; a repeated batch replaces its own."""
        ids = fresh.select(*self.keys).distinct().withColumn("bucket", self._bucket())
        ids.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/batch={number}")


def run_available(df: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> None:
    """Handles what is new in one or more batches, then stops."""
    df.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def checked_batch(raw: DataFrame, as_of) -> DataFrame:
    """Each raw record once, standardised, with clean_error (what breaks the contract, or can't be read; null if nothing) and
    validation_errors (joined by |, '' if none; null where there is a clean_error).  A broken file is one record.  Records
    that broke the contract have its fields alone, broken files their source."""
    records = to_contract(raw.withColumn("_given_source", F.col("source")), ("_broken", "_given_source"))
    breach = F.array_join(contract_violations(records), "|")
    why = F.when(F.col("_broken"), "the file isn't an array of records").when(breach != "", breach)
    cleaned = clean_records(records.withColumn("_why", why), also=("_broken", "_given_source", "_why"))

    def held(c: str):
        if c == "clean_error":
            return F.coalesce("_why", c)
        if c == "source":
            return F.when(F.col("_broken"), F.col("_given_source")).otherwise(F.col(c))
        if c == "_file":
            return F.col(c)
        return F.when(~F.col("_broken") if c in records.columns else F.col("_why").isNull(), F.col(c))

    names = [c for c in cleaned.columns if c not in ("_broken", "_given_source", "_why")]
    checked = cleaned.select(*[held(c).alias(c) for c in names])
    return checked.withColumn("validation_errors", F.when(F.col("clean_error").isNull(), F.array_join(validation_errors(as_of), "|")))


def outcomes(checked: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(valid, quarantined, rejected) of checked records."""
    usable = checked.where("clean_error is null").drop("clean_error")
    return usable.where("validation_errors = ''").drop("validation_errors"), usable.where("validation_errors <> ''"), checked.where("clean_error is not null").drop("validation_errors")


def clean_batch(raw: DataFrame, as_of) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(valid, quarantined, rejected) of raw records.  Each record is in one of the three; a broken file is one rejected
    record.  Rejected ones have clean_error: what breaks the contract, or can't be read."""
    return outcomes(checked_batch(raw, as_of))


def incremental_clean(spark: SparkSession, raw: str, silver: str, quarantine: str, rejects: str, checkpoint: str, as_of, report: str | None = None) -> None:
    """New raw files to standardised rows, with a report of each batch.  A batch writes under its number, so that a repeated
    batch replaces itself."""

    def handle(batch: DataFrame, number: int) -> None:
        checked = checked_batch(batch, as_of).persist()  # cleaned once, written thrice
        parts = outcomes(checked)
        for df, root in zip(parts, (silver, quarantine, rejects), strict=True):
            df.write.mode("overwrite").parquet(f"{root}/batch={number}")
        if report:
            valid, failed, rejected = (df.select("_file", F.lit(k == 0).alias("is_valid")) for k, df in enumerate(parts))
            write_run_report(valid.unionByName(failed).unionByName(rejected), f"{report}/batch={number}")
        checked.unpersist()

    run_available(stream_bronze(spark, raw), checkpoint, handle)
