"""Exact deduplication by Grace hashing.

1. Each task puts its records into an open-addressing table that compares complete contents, and writes one partial
   record per distinct content to spill files in the shared folder (content, hash, row count, largest id, ids).  A
   content that a third of all rows share is so reduced to a record per flushed table.  A table is flushed when its
   contents, entries and ids have ``table_bytes``; so many rows of one short text, or of none, fill no task's memory.
2. Spill files are dealt into buckets by bits of the hash.  A bucket with more bytes than ``bucket_bytes`` is dealt again
   by further bits, until each fits or holds a single hash, of which one content at a time is kept.
3. Each bucket goes through an open-addressing table again; the result names, for each partial record, its group.
   Ids never pass through a bucket: they are unfolded from the partial records afterwards.

Null texts count as empty.  Texts of any length are compared whole; a text over ``table_bytes`` is flushed at once.
Repeated rows each get their own result row; if several rows of the kept content have the largest id, all of them are
marked kept.  A null id is never the largest, unless all ids of the group are null.  Ids may be numbers or strings; the
largest string is the last one in the order of its UTF-8 bytes.  An empty table gives no rows.  Other columns of the
documents, also those named like the ones made here, are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .shared import stored, tasks_for

#: Bytes of distinct content that a bucket's table holds.
BUCKET_BYTES = 16 << 20
#: Bytes of contents, entries and ids that a task's first table holds before it is written out.
TABLE_BYTES = 24 << 20
#: Bytes that an entry and an id take besides the content, about.
ENTRY_BYTES, ID_BYTES = 200, 40
#: Hash bits by which an oversize bucket is dealt again.
SPLIT_BITS = 3


def _schemas(kind: T.DataType) -> tuple[T.StructType, T.StructType]:
    """Of partial records and of their groups, for ids of a kind."""
    of = lambda *fields: T.StructType([T.StructField(n, t) for n, t in fields])
    long, string = T.LongType(), T.StringType()
    partial = of(("partial_id", string), ("hash", long), ("content", T.BinaryType()), ("n_bytes", long), ("n_rows", long), ("max_id", kind), ("ids", T.ArrayType(kind)))
    return partial, of(("partial_id", string), ("keep_id", kind), ("group_size", long), ("text_sha256", string))


class ContentTable:
    """Open addressing with linear probing; entries are equal only if their whole contents are."""

    def __init__(self) -> None:
        self.slots = np.full(1024, -1, dtype=np.int64)
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.n_bytes = 0

    def entry(self, h: int, content: bytes) -> tuple[int, bool]:
        """The content's number, and whether it is new."""
        mask = len(self.slots) - 1
        at = h & mask
        while (k := int(self.slots[at])) >= 0:
            if self.hashes[k] == h and self.contents[k] == content:
                return k, False
            at = (at + 1) & mask
        self.slots[at] = k = len(self.hashes)
        self.hashes.append(h)
        self.contents.append(content)
        self.n_bytes += len(content)
        if 2 * len(self.hashes) > len(self.slots):
            self._grow()
        return k, True

    def _grow(self) -> None:
        self.slots = np.full(2 * len(self.slots), -1, dtype=np.int64)
        mask = len(self.slots) - 1
        for k, h in enumerate(self.hashes):
            at = h & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = k


def _partials(schema: pa.Schema, table_bytes: int):
    """Step 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, flushed = TaskContext.get(), 0
        table, ids, held = ContentTable(), [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            low, size = 0, 0
            for k in range(len(ids)):
                size += len(table.contents[k]) + ID_BYTES * len(ids[k])
                if size > 4 << 20 or k == len(ids) - 1:
                    own, contents = ids[low : k + 1], table.contents[low : k + 1]
                    columns = [
                        [f"{task.partitionId()}-{task.taskAttemptId()}-{flushed}-{j}" for j in range(low, k + 1)], np.array(table.hashes[low : k + 1], dtype=np.uint64).view(np.int64), contents,
                        [len(x) for x in contents], [len(x) for x in own], [max((y for y in x if y is not None), default=None) for x in own], own,
                    ]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
                    low, size = k + 1, 0

        for batch in batches:
            for doc, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                content = content or b""
                k, new = table.entry(xxhash.xxh3_64_intdigest(content), content)
                if new:
                    ids.append([])
                    held += len(content) + ENTRY_BYTES
                ids[k].append(doc)
                held += ID_BYTES + (len(doc) if isinstance(doc, str) else 0)
                if held > table_bytes:
                    yield from flush()
                    table, ids, held, flushed = ContentTable(), [], 0, flushed + 1
        yield from flush()

    return run


def _groups(schema: pa.Schema):
    """Step 3: rows come bucket by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, rows, members, bucket = ContentTable(), [], [], None

        def flush() -> Iterator[pa.RecordBatch]:
            if members:
                digests = [hashlib.sha256(c).hexdigest() for c in table.contents]
                columns = [[p for p, _ in members], [rows[k][0] for _, k in members], [rows[k][1] for _, k in members], [digests[k] for _, k in members]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("bucket", "partial_id", "hash", "content", "n_rows", "max_id")]
            for own, partial, h, content, n, largest in zip(*columns, strict=True):
                if own != bucket:
                    yield from flush()
                    table, rows, members, bucket = ContentTable(), [], [], own
                k, new = table.entry(h & 0xFFFFFFFFFFFFFFFF, content)
                if new:
                    rows.append([largest, n])
                else:
                    known = rows[k]
                    known[0] = largest if known[0] is None else known[0] if largest is None else max(known[0], largest)
                    known[1] += n
                members.append((partial, k))
        yield from flush()

    return run


def _buckets(parts: DataFrame, total: int, bucket_bytes: int) -> DataFrame:
    """Step 2: the partial records, which have ``total`` bytes, with the path of their bucket."""
    bits = max(0, int(2 * total // bucket_bytes)).bit_length()
    out = parts.withColumn("depth", F.lit(bits))
    prefix = lambda depth: F.expr(f"concat({depth}, ':', if({depth} = 0, 0L, shiftrightunsigned(hash, 64 - {depth})))")
    out = out.withColumn("bucket", prefix("depth"))
    while bits < 60:
        over = (
            out.groupBy("bucket").agg(F.sum(F.col("n_bytes") + ENTRY_BYTES).alias("held"), F.min("hash").alias("low"), F.max("hash").alias("high"))
            .where((F.col("held") > bucket_bytes) & (F.col("low") != F.col("high"))).select("bucket", F.lit(True).alias("over"))
        )
        if over.isEmpty():
            break
        bits += SPLIT_BITS
        out = out.join(stored(over, "oversize-buckets"), "bucket", "left")
        out = out.withColumn("depth", F.when(F.col("over"), F.col("depth") + SPLIT_BITS).otherwise(F.col("depth")))
        out = out.withColumn("bucket", prefix("depth")).drop("over")
    return out


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per document: ``id_col``, keep_id, group_size, kept, text_sha256."""
    partial, group = _schemas(docs.schema[id_col].dataType)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("content"))
    parts = stored(rows.mapInArrow(_partials(to_arrow_schema(partial), table_bytes), partial), "dedup-spill")
    total = parts.agg(F.sum(F.col("n_bytes") + ENTRY_BYTES)).first()[0] or 0
    dealt = _buckets(parts.select("partial_id", "hash", "content", "n_bytes", "n_rows", "max_id"), total, bucket_bytes)
    dealt = dealt.select("bucket", "partial_id", "hash", "content", "n_rows", "max_id").repartition(tasks_for(docs.sparkSession, total), "bucket").sortWithinPartitions("bucket")
    groups = dealt.mapInArrow(_groups(to_arrow_schema(group)), group)
    found = parts.select("partial_id", "ids").join(groups, "partial_id").withColumn("id", F.explode("ids"))
    return found.select(
        F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )
