"""A star schema in a folder: versions that are committed whole, and large tables in ranges of their key.

``root/tables/<table>/commit=<id>/`` holds files, ``root/versions/<n>.json`` says which of them make up version n.  A
commit writes its files under an id of its own, then the list, and gives the list its number by one rename that fails if
the number is taken.  What a killed run leaves isn't in any list: readers don't see it, the next run starts from the last
version, and ``vacuum`` removes it.  Two runs that started from one version can't both commit.

Tables with ranges have ``2 ** bits`` of them by the upper bits of a 64-bit key.  A commit replaces the ranges that it was
given and keeps the files of all others; a reader that knows its keys opens only their ranges.
"""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Tables that are laid out by ranges, with their key.
RANGED = {"fact_job_postings": "job_key", "bridge_job_skill": "job_key"}


def range_of(key: Column, bits: int) -> Column:
    """The range of a 64-bit key: ranges rise with the key taken as unsigned."""
    return F.shiftrightunsigned(key, 64 - bits).cast("int") if bits else F.lit(0)


@dataclass
class Version:
    """A committed version: for each table its schema and the folders that hold it, by range where it has ranges."""

    number: int = 0
    schemas: dict[str, str] = field(default_factory=dict)
    whole: dict[str, str] = field(default_factory=dict)
    bits: dict[str, int] = field(default_factory=dict)
    ranges: dict[str, dict[int, str]] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps({"schemas": self.schemas, "whole": self.whole, "bits": self.bits, "ranges": self.ranges})

    @classmethod
    def from_json(cls, number: int, text: str) -> Version:
        d = json.loads(text)
        return cls(number, d["schemas"], d["whole"], d["bits"], {t: {int(r): c for r, c in parts.items()} for t, parts in d["ranges"].items()})


class Store:
    def __init__(self, spark: SparkSession, root: str, bits: int = 8):
        """``bits`` is the number of bits of ranges that tables get when they are first written."""
        self.spark, self.root, self.first_bits = spark, root.rstrip("/"), bits
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path(self.root).getFileSystem(self._conf)

    # Files of the folder, by Hadoop's own interface, as the folder may be in any store.

    def _names(self, folder: str) -> list[str]:
        path = self._path(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(path)] if self._fs.exists(path) else []

    def _read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def numbers(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self._names(f"{self.root}/versions") if n.endswith(".json"))

    def version(self, number: int | None = None) -> Version:
        """The version of that number, else the last; number 0 is the empty one."""
        number = max(self.numbers(), default=0) if number is None else number
        return Version.from_json(number, self._read(f"{self.root}/versions/{number}.json")) if number else Version()

    # Reading.

    def table(self, version: Version, name: str, ranges: list[int] | None = None) -> DataFrame:
        """A table of a version; of a table with ranges, only those given."""
        schema = T._parse_datatype_json_string(version.schemas[name])
        if name in version.whole:
            return self.spark.read.schema(schema).parquet(f"{self.root}/tables/{name}/commit={version.whole[name]}")
        parts = version.ranges[name]
        folders = [f"{self.root}/tables/{name}/commit={c}/_range={r}" for r, c in sorted(parts.items()) if ranges is None or r in set(ranges)]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def tables(self, version: Version | None = None) -> dict[str, DataFrame]:
        version = version or self.version()
        return {name: self.table(version, name) for name in version.schemas}

    def touched(self, version: Version, name: str, keys: DataFrame) -> list[int]:
        """Ranges of a table that keys (a column named as the table's key) are in; at most 2 ** bits numbers."""
        bits = version.bits.get(name, self.first_bits)
        return sorted(r[0] for r in keys.select(range_of(F.col(RANGED[name]), bits).alias("r")).distinct().collect())

    # Writing.

    def commit(self, base: Version, changes: dict[str, DataFrame], ranges: dict[str, list[int]] | None = None) -> Version:
        """The next version: ``changes`` replace their tables or, of tables named in ``ranges``, those ranges (which then
        hold the given rows alone).  Raises if another run has committed since ``base``."""
        commit, new = uuid.uuid4().hex, Version(base.number + 1, dict(base.schemas), dict(base.whole), dict(base.bits), {t: dict(p) for t, p in base.ranges.items()})
        folder = lambda name: f"{self.root}/tables/{name}/commit={commit}"

        def write(name: str) -> None:
            df = changes[name]
            if name not in RANGED:
                df.write.parquet(folder(name))
                return
            placed = df.withColumn("_range", range_of(F.col(RANGED[name]), new.bits[name]))
            placed.repartition("_range").sortWithinPartitions("_range", RANGED[name]).write.partitionBy("_range").parquet(folder(name))

        for name, df in changes.items():
            new.schemas[name] = base.schemas.get(name) or df.schema.json()
            if name in RANGED:
                new.bits.setdefault(name, self.first_bits)
            else:
                new.whole[name] = commit
        with ThreadPoolExecutor(4) as pool:  # tables are written side by side: most are small
            list(pool.map(inheritable_thread_target(self.spark)(write), changes))
        for name in RANGED.keys() & changes.keys():
            written = {int(n.removeprefix("_range=")) for n in self._names(folder(name)) if n.startswith("_range=")}
            replaced = set(ranges[name]) if ranges and name in ranges else set(new.ranges.get(name, {})) | written
            if written - replaced:
                raise ValueError(f"{name}: rows outside of the ranges to be replaced")
            new.ranges[name] = {**{r: c for r, c in new.ranges.get(name, {}).items() if r not in replaced}, **{r: commit for r in written}}
        self._publish(new)
        return new

    def _publish(self, new: Version) -> None:
        folder = f"{self.root}/versions"
        self._fs.mkdirs(self._path(folder))
        partial, final = self._path(f"{folder}/.{uuid.uuid4().hex}"), self._path(f"{folder}/{new.number}.json")
        stream = self._fs.create(partial, False)
        stream.write(bytearray(new.to_json().encode()))
        stream.close()
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self._conf) if final.toUri().getScheme() else self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._conf)
        none = self.spark._jvm.org.apache.hadoop.fs.Options.Rename.NONE
        options = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = none
        try:
            context.rename(partial, final, options)
        except Exception as e:
            self._fs.delete(partial, False)
            if self._fs.exists(final):
                raise RuntimeError(f"version {new.number} was committed by another run") from e
            raise

    def vacuum(self, keep: int = 2) -> list[str]:
        """Removes the lists before the last ``keep`` versions, and all files that no list names.  Not to be called while a
        load runs.  Returns the folders that were removed."""
        numbers = self.numbers()
        for n in numbers[:-keep]:
            self._fs.delete(self._path(f"{self.root}/versions/{n}.json"), False)
        live: dict[str, set[str]] = {}
        for n in numbers[-keep:]:
            v = self.version(n)
            for t, c in v.whole.items():
                live.setdefault(t, set()).add(f"commit={c}")
            for t, parts in v.ranges.items():
                live.setdefault(t, set()).update(f"commit={c}/_range={r}" for r, c in parts.items())
        removed = []
        for t in self._names(f"{self.root}/tables"):
            for commit in self._names(f"{self.root}/tables/{t}"):
                have = live.get(t, set())
                if commit in have:
                    continue
                inner = [f"{commit}/{r}" for r in self._names(f"{self.root}/tables/{t}/{commit}") if r.startswith("_range=")]
                gone = [r for r in inner if r not in have] if any(r in have for r in inner) else [commit]
                for folder in gone:
                    self._fs.delete(self._path(f"{self.root}/tables/{t}/{folder}"), True)
                    removed.append(f"{t}/{folder}")
        return removed
