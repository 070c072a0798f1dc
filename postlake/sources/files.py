"""Reading and writing of the layers' files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import reference as ref
from .arrays import split_arrays

RECORD = T.StructType([T.StructField(c, T.StringType()) for c in ref.CONTRACT_FIELDS])


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder's name in the folder that the cluster shares (``spark.checkpoint.dir``).  Only where that is unset and
    the master is local, as in tests, a temporary one."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir isn't set: intermediate tables need a folder that all executors share")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}" if shared else f"{tempfile.mkdtemp(prefix='spark-scratch-')}/{label}"


def kept(df: DataFrame, label: str) -> DataFrame:
    """Written once and read back, as several tables are made of it; the planner then knows its size."""
    df.write.parquet(path := scratch(df.sparkSession, label))
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scan_bronze(spark: SparkSession, root: str) -> DataFrame:
    """Raw records of root/<source>/<date>/*.json with source, _date, _file and _ordinal; a broken file gives a row whose
    ``_broken`` is true and whose fields are null."""
    text = spark.read.option("pathGlobFilter", "*.json").option("recursiveFileLookup", True).text(root, wholetext=True)
    return parse_bronze(text.select("value", F.col("_metadata.file_path").alias("_file")))


def scan_large_bronze(spark: SparkSession, root: str, chunk_bytes: int = 32 << 20) -> DataFrame:
    """As ``scan_bronze``, for files of any size: an array is read by as many tasks as it has chunks.  Of a broken file the
    objects before the break are rows, beside the one whose ``_broken`` is true; an object that can't be read is a row of
    its own whose ``_broken`` is true."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").option("recursiveFileLookup", True).load(root).select("path", "length")
    corrupt = T.StructType([*RECORD, T.StructField("_corrupt", T.StringType())])
    rows = split_arrays(files, chunk_bytes).withColumn("r", F.from_json("record", corrupt, {"columnNameOfCorruptRecord": "_corrupt"}))
    rows = rows.select("_file", F.col("_ordinal").cast("int").alias("_ordinal"), (F.col("_broken") | F.col("r._corrupt").isNotNull()).alias("_broken"), *[F.col(f"r.{c}").alias(c) for c in RECORD.names])
    return _with_places(rows)


def parse_bronze(files: DataFrame) -> DataFrame:
    """The same for a table of whole files: value and _file."""
    parsed = files.withColumn("_records", F.from_json("value", T.ArrayType(RECORD))).withColumn("_broken", F.col("_records").isNull())
    rows = parsed.select("_file", "_broken", F.posexplode_outer("_records").alias("_ordinal", "r")).select("_file", "_ordinal", "_broken", "r.*")
    return _with_places(rows)


def _with_places(rows: DataFrame) -> DataFrame:
    """Source and date from the file's folders, the source only where the record has none."""
    return rows.withColumns({"_source_dir": F.regexp_extract("_file", r"/([^/]+)/([^/]+)/[^/]+$", 1), "_date": F.regexp_extract("_file", r"/([^/]+)/([^/]+)/[^/]+$", 2)}).withColumn("source", F.coalesce("source", "_source_dir")).drop("_source_dir")


def scan_silver_csv(spark: SparkSession, root: str, needed: tuple[str, ...] = ()) -> DataFrame:
    """Rows of root/**/*.csv with _file and _ordinal (their order in the file); all columns are strings, and empty ones stay
    empty.  Names come from the header, without a byte order mark; files of one call have the same header.  Raises if one
    of the needed columns is missing."""
    options = {"header": True, "recursiveFileLookup": True, "pathGlobFilter": "*.csv", "nullValue": "\u0000", "emptyValue": "", "multiLine": True, "escape": '"'}
    df = spark.read.options(**options).csv(root)
    names = [c.lstrip("\ufeff") for c in df.columns]
    if missing := sorted(set(needed) - set(names)):
        raise ValueError(f"missing columns: {', '.join(missing)}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    df = spark.read.schema(schema).options(**options, enforceSchema=True).csv(root)
    return df.withColumn("_file", F.col("_metadata.file_path")).withColumn("_ordinal", F.monotonically_increasing_id()).na.fill("", names)


def file_names(spark: SparkSession, root: str, pattern: str = "*.csv") -> DataFrame:
    """_file of all files under a folder, also of those without rows; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return files.select(F.col("path").alias("_file"))


def new_files_only(rows: DataFrame, log: DataFrame, reload: bool = False) -> DataFrame:
    """Rows of files that the log doesn't name."""
    return rows if reload else rows.join(log.select(F.col("file_path").alias("_file")).distinct(), "_file", "left_anti")


def write_bronze(df: DataFrame, root: str) -> None:
    df.write.mode("append").partitionBy("source", "scrape_date").json(root)


def write_layers(valid: DataFrame, failed: DataFrame, silver: str, quarantine: str, keys: tuple[str, ...] = ("source",)) -> None:
    valid.write.mode("append").partitionBy(*keys).parquet(silver)
    if not failed.isEmpty():
        failed.write.mode("append").partitionBy(*keys).parquet(quarantine)


def run_report(checked: DataFrame, file_col: str = "_file", valid_col: str = "is_valid") -> DataFrame:
    """Records, valid and quarantined per file, and in the row without a file of all files."""
    return checked.rollup(file_col).agg(F.count("*").alias("records"), F.count_if(F.col(valid_col)).alias("valid"), F.count_if(~F.col(valid_col)).alias("quarantined"))


def ingestion_log(records: DataFrame, runs: DataFrame, at) -> DataFrame:
    """A line per run, also per run without records.  ``runs`` has source, run_id, output, and skipped and error: a run's
    reason for not having run, and for having failed; ``records`` are what was written."""
    counts = records.groupBy("source", "run_id").agg(F.count("*").alias("records"))
    out = runs.join(counts, ["source", "run_id"], "left").withColumn("records", F.coalesce("records", F.lit(0)))
    status = F.when(F.col("error").isNotNull(), "error").when(F.col("skipped").isNotNull(), "skipped").when(F.col("records") > 0, "ok").otherwise("empty")
    return out.select(
        at.alias("timestamp"), "source", "run_id", status.alias("status"), "records", F.when(F.col("records") > 0, F.col("output")).alias("output"), F.coalesce("error", "skipped", F.lit("")).alias("detail"),
    )


def append_ingestion_log(log: DataFrame, path: str) -> None:
    log.write.mode("append").json(path)


def write_run_report(checked: DataFrame, path: str, file_col: str = "_file", valid_col: str = "is_valid") -> None:
    """The report as JSON lines: one per file, and one without a file for all of them."""
    run_report(checked, file_col, valid_col).coalesce(1).write.mode("overwrite").json(path)


def export_csv(df: DataFrame, path: str) -> None:
    """A small table as one file with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    return df.limit(n)


def materialize(tables: dict[str, DataFrame], root: str | None = None) -> None:
    """Views, or Parquet tables where a folder is given."""
    for name, df in tables.items():
        if root is None:
            df.createOrReplaceTempView(name)
        else:
            df.write.mode("overwrite").parquet(f"{root}/{name}")
