"""Large JSON arrays of objects, read by several tasks.

A file is cut into chunks of bytes, wherever they fall.  Whether a chunk begins in a string, and how deep, depends on all
before it; but what a chunk does to that is a small summary for each of the three states it may begin in (outside of
strings, in one, after a backslash in one), and summaries are composed in the order of the chunks.  Then each chunk knows
its state and how many objects begin before it, and gives the objects that begin in it, reading on over its end for the
last one.  Ordinals are those of the whole array.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OUTSIDE, INSIDE, ESCAPED = 0, 1, 2

_SUMMARY = "_file string, at bigint, size bigint, ends array<int>, depths array<int>, begins array<map<int,bigint>>, first string"
_STATES = "_file string, at bigint, size bigint, state int, depth int, base bigint, broken boolean"
_RECORDS = "_file string, _ordinal bigint, _broken boolean, record string"


def open_file(uri: str) -> pa.NativeFile:
    """A file for reading at any place, as tasks open it."""
    scheme, sep, rest = uri.partition("://")
    if not sep:
        return pafs.LocalFileSystem().open_input_file(uri.removeprefix("file:"))
    if scheme == "file":
        return pafs.LocalFileSystem().open_input_file(rest)
    fs, path = pafs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3", "abfss": "abfs"}.get(scheme, scheme) + sep + rest)
    return fs.open_input_file(path)


def structure(data: bytes, state: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(bytes, which of them are outside of strings, depth before each as from 0, the state at the end)."""
    b = np.frombuffer(data, dtype=np.uint8)
    slash = b == 0x5C
    # The length of the run of backslashes that ends before each byte; a state of ESCAPED is one before the first.
    index = np.arange(len(b))
    last_other = np.maximum.accumulate(np.where(slash, -1, index)) if len(b) else index
    run_here = index - last_other + np.where((last_other < 0) & (state == ESCAPED), 1, 0)  # with the byte itself
    before = np.empty(len(b), dtype=np.int64)
    if len(b):
        before[0] = state == ESCAPED
        before[1:] = run_here[:-1]
    quote = (b == 0x22) & (before % 2 == 0)
    inside = (np.cumsum(quote) - quote + (state != OUTSIDE)) % 2 == 1
    out = ~inside & ~quote
    step = (out & ((b == 0x7B) | (b == 0x5B))).astype(np.int64) - (out & ((b == 0x7D) | (b == 0x5D)))
    depth = np.cumsum(step) - step
    ends_inside = bool(len(b)) and (int(quote.sum()) + (state != OUTSIDE)) % 2 == 1
    end = state if not len(b) else OUTSIDE if not ends_inside else ESCAPED if run_here[-1] % 2 == 1 and slash[-1] else INSIDE
    return b, out, depth, end


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            with open_file(r["_file"]) as f:
                data = f.read_at(r["size"], r["at"])
            ends, depths, begins = [], [], []
            for state in (OUTSIDE, INSIDE, ESCAPED):
                b, out, depth, end = structure(data, state)
                ends.append(end)
                step = int((out & ((b == 0x7B) | (b == 0x5B))).sum()) - int((out & ((b == 0x7D) | (b == 0x5D))).sum())
                depths.append(step)
                values, counts = np.unique(depth[out & (b == 0x7B)], return_counts=True)
                begins.append(list(zip(values.tolist(), counts.tolist(), strict=True)))
            first = data.lstrip(b"\xef\xbb\xbf \t\r\n")[:1].decode("latin-1")
            schema = pa.schema([("_file", pa.string()), ("at", pa.int64()), ("size", pa.int64()), ("ends", pa.list_(pa.int32())), ("depths", pa.list_(pa.int32())), ("begins", pa.list_(pa.map_(pa.int32(), pa.int64()))), ("first", pa.string())])
            yield pa.RecordBatch.from_pylist([{**{k: r[k] for k in ("_file", "at", "size")}, "ends": ends, "depths": depths, "begins": begins, "first": first}], schema)


def _compose(key: tuple, chunks: pa.Table) -> pa.Table:
    """Each chunk's state, depth and number of objects before it; whether the file is a whole array."""
    state, depth, base, out, begun = OUTSIDE, 0, 0, [], ""
    rows = sorted(chunks.to_pylist(), key=lambda r: r["at"])
    for r in rows:
        begun = begun or r["first"]
        out.append({"_file": r["_file"], "at": r["at"], "size": r["size"], "state": state, "depth": depth, "base": base})
        base += dict(r["begins"][state]).get(1 - depth, 0)
        depth, state = depth + r["depths"][state], r["ends"][state]
    broken = state != OUTSIDE or depth != 0 or begun != "["
    schema = pa.schema([("_file", pa.string()), ("at", pa.int64()), ("size", pa.int64()), ("state", pa.int32()), ("depth", pa.int32()), ("base", pa.int64()), ("broken", pa.bool_())])
    return pa.Table.from_pylist([{**r, "broken": broken} for r in out], schema)


def _records(ahead: int):
    """The objects that begin in a chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                made: list[dict] = []
                with open_file(r["_file"]) as f:
                    length, more = f.size(), ahead
                    data = f.read_at(r["size"], r["at"])
                    while True:
                        b, out, depth, _ = structure(data, r["state"])
                        depth = depth + r["depth"]
                        starts = np.flatnonzero(out & (b == 0x7B) & (depth == 1))
                        starts = starts[starts < r["size"]]
                        ends = np.flatnonzero(out & (b == 0x7D) & (depth == 2)) + 1
                        if not len(starts) or (len(ends) and ends[-1] > starts[-1]) or r["at"] + len(data) >= length:
                            break
                        data, more = data + f.read_at(more, r["at"] + len(data)), 2 * more
                places = np.searchsorted(ends, starts, side="right")
                for k, (s, p) in enumerate(zip(starts.tolist(), places.tolist(), strict=True)):
                    whole = p < len(ends)
                    made.append({"_file": r["_file"], "_ordinal": r["base"] + k, "_broken": not whole, "record": data[s : int(ends[p])].decode("utf-8", "replace") if whole else None})
                schema = pa.schema([("_file", pa.string()), ("_ordinal", pa.int64()), ("_broken", pa.bool_()), ("record", pa.string())])
                for a in range(0, len(made), 10_000):
                    yield pa.RecordBatch.from_pylist(made[a : a + 10_000], schema)

    return run


def split_arrays(files: DataFrame, chunk_bytes: int = 32 << 20, ahead: int = 1 << 16) -> DataFrame:
    """(_file, _ordinal, _broken, record) of files (path and length): the text of each object of their arrays.

    A file that isn't a whole array (it ends early, or doesn't begin as one) has a row without ordinal and record whose
    _broken is true, beside the objects before the break.  Spark doesn't list files without a byte."""
    files = files.select(F.col("path").alias("_file"), F.col("length").cast("long").alias("length"))
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(chunk_bytes).cast("long")))
    chunks = files.select("_file", starts.alias("at"), "length").select("_file", "at", F.least(F.lit(chunk_bytes), F.col("length") - F.col("at")).cast("long").alias("size"))
    # Chunks are rows of some bytes that stand for much: without a number, Spark would put thousands of them into one task.
    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = lambda df: df.repartition(tasks, "_file", "at")
    states = spread(chunks).mapInArrow(_summaries, _SUMMARY).groupBy("_file").applyInArrow(_compose, _STATES)
    records = spread(states).drop("broken").mapInArrow(_records(ahead), _RECORDS)
    broken = states.where("broken").select("_file").distinct().select("_file", F.lit(None).cast("long").alias("_ordinal"), F.lit(True).alias("_broken"), F.lit(None).cast("string").alias("record"))
    return records.where("not _broken").unionByName(broken)
