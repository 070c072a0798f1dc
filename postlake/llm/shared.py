"""Tables and files that every executor and the driver can see."""

from __future__ import annotations

import os
import tempfile
import uuid

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``.  Only where that is unset and the master is local, so that driver and
    executors are one process, a temporary folder; on a cluster it must be set."""
    known = spark.conf.get("spark.checkpoint.dir", None)
    if known:
        return known.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir isn't set: intermediate tables need a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="spark-shared-")
        spark.sparkContext.setCheckpointDir(_own[app])
    return _own[app]


def new_folder(spark: SparkSession, label: str) -> str:
    """A name in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str, compression: str = "snappy", options: dict[str, str] | None = None) -> DataFrame:
    """Writes the rows as Parquet into the shared folder and reads them back: what follows doesn't depend on
    executors that may be lost."""
    path = new_folder(df.sparkSession, label)
    df.write.options(**(options or {})).parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of two short columns that a broadcast may have.
BROADCAST_ROWS = 4_000_000


def attached(rows: DataFrame, marks: DataFrame, key: str, how: str, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``rows`` joined with a table of marks (key and a short column).  Up to ``limit`` marks are broadcast, so that rows
    with their texts stay where they are; more are joined by sorting both."""
    return rows.join(marks.hint("broadcast" if marks.count() <= limit else "merge"), key, how)


def tasks_for(spark: SparkSession, n_bytes: int, at_most: int = 64 << 20) -> int:
    """Tasks among which so many bytes are dealt: as many as the session's shuffles have, and more where a task would get
    over ``at_most`` bytes."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // at_most))


def files(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder or file, as tasks open it.  Hadoop's names of object stores are pyarrow's s3 and abfs."""
    scheme, sep, rest = uri.partition("://")
    uri = {"s3a": "s3", "s3n": "s3", "abfss": "abfs"}.get(scheme, scheme) + sep + rest
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), os.path.abspath(uri)
    return pafs.FileSystem.from_uri(uri.replace("file:/", "file:///") if uri.startswith("file:/") and not uri.startswith("file://") else uri)


def put(uri: str, write) -> None:
    """Calls write(stream) on a file that gets its name only when it is complete; a repeated task replaces it."""
    fs, path = files(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    partial = f"{path}.{uuid.uuid4().hex}"
    with fs.open_output_stream(partial, compression=None) as out:
        write(out)
    fs.move(partial, path)


def uniform(*keys: Column, seed: int) -> Column:
    """A number in (0, 1) that depends on the keys and the seed alone."""
    h = F.xxhash64(F.lit(seed), *[k.cast("string") for k in keys])
    return (F.pmod(h, F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
