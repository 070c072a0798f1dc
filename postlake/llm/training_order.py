"""Token shards in training order.

Documents are encoded, followed by an end token each, joined within a task and cut into sequences of ``length`` ids; the
task's last sequence is filled up with end tokens.  A sequence's number is its place in the order of tasks; a keyed
Feistel permutation, with cycle-walking to stay below the number of sequences, maps it to its global slot, so every slot
is taken once and any slot can be computed without a table.  Sequences are dealt by ranges of slots, sorted, and written
as shards of ``per_shard`` slots of fixed stride (``length`` little-endian 16-bit ids), so slot s is at a known place of
a known file and reading can resume anywhere.

A sequence's number, and so the order of training, depends on how Spark splits the documents' files into tasks: the same
files under the same session settings give the same shards, another split gives another order of the same tokens.

Null and empty texts give an end token only; texts of any length are encoded whole and cut.  No documents give no shards.
Repeated rows are encoded each time.  Ids may be null and of any type.  A vocabulary that 16 bits don't hold is refused.
Other columns, also those named like the ones made here, are not looked at.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .shared import files, new_folder, put, stored

LENGTH = 2048
PER_SHARD = 2048
ROUNDS = 4
#: The table of sequences is written once and read once: larger pages, so that matches reach further back.
PACKED = {"parquet.compression.codec.zstd.level": "6", "parquet.page.size": str(8 << 20)}

_U = np.uint64

def _columns(kind: str, *names: str) -> str:
    """A schema of these columns, for ids of a kind."""
    known = {"part": "int", "seq": "bigint", "n_tokens": "int", "doc_ids": f"array<{kind}>", "data": "binary", "slot": "bigint", "shard": "int", "byte_offset": "bigint"}
    return ", ".join(f"{n} {known[n]}" for n in names)


def permute(index: np.ndarray, n: int, key: int, rounds: int = ROUNDS) -> np.ndarray:
    """Slots of these numbers below n: a balanced Feistel network on the least even number of bits that holds n,
    repeated while the outcome isn't below n."""
    half = max(1, -(-max(1, (n - 1).bit_length()) // 2))
    mask = _U((1 << half) - 1)
    keys = np.random.SeedSequence(key).generate_state(rounds, np.uint64)
    out = np.asarray(index, dtype=_U).copy()
    todo = np.arange(len(out))
    with np.errstate(over="ignore"):
        while len(todo):
            x = out[todo]
            left, right = x >> _U(half), x & mask
            for k in keys:
                f = (right ^ k) * _U(0x9E3779B97F4A7C15)
                f ^= f >> _U(32)
                f *= _U(0xD6E8FEB86659FD93)
                f ^= f >> _U(29)
                left, right = right, left ^ (f & mask)
            out[todo] = (left << _U(half)) | right
            todo = todo[out[todo] >= _U(n)]
    return out.astype(np.int64)


def encoder(path: str):
    """Ids of a text by the rank file of a byte-level vocabulary, without special tokens; the id after the last is free."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    if len(ranks) >= 1 << 16:
        raise ValueError(f"{len(ranks)} ids and an end token don't fit into 16 bits")
    return encoding.encode_ordinary, len(ranks)


def _sequences(path: str, length: int, kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, end = encoder(path)
        part, seq = TaskContext.get().partitionId(), 0
        ids: list[np.ndarray] = []
        docs: list[tuple[object, int]] = []  # document and where it begins
        held = 0

        def cut(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal ids, docs, held, seq
            tokens = np.concatenate(ids) if ids else np.zeros(0, dtype="<u2")
            whole = len(tokens) // length + (last and len(tokens) % length > 0)
            filled = np.concatenate([tokens, np.full(max(0, whole * length - len(tokens)), end, dtype="<u2")])
            begins = [b for _, b in docs]
            rows = []
            for k in range(whole):
                a, b = k * length, (k + 1) * length
                low, high = int(np.searchsorted(begins, a, side="right")) - 1, int(np.searchsorted(begins, b))
                rows.append((part, seq, min(length, len(tokens) - a), [d for d, _ in docs[max(0, low) : high]], filled[a:b].tobytes()))
                seq += 1
            if rows:
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int32(), pa.list_(kind), pa.binary()), strict=True)], names=["part", "seq", "n_tokens", "doc_ids", "data"])
            done = whole * length
            ids = [tokens[done:]] if done < len(tokens) else []
            held = max(0, len(tokens) - done)
            docs = [(d, max(0, b - done)) for i, (d, b) in enumerate(docs) if (docs[i + 1][1] if i + 1 < len(docs) else len(tokens)) > done]

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                docs.append((doc, held))
                ids.append(np.array([*encode(text or ""), end], dtype="<u2"))
                held += len(ids[-1])
                if held >= 256 * length:
                    yield from cut(False)
        yield from cut(True)

    return run


def _slots(n: int, key: int, per_shard: int):
    """Slots of numbered sequences, whose data is packed for the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            slots = permute(batch.column(0).to_numpy(zero_copy_only=False), n, key)
            packed = pa.array([packer.compress(x) for x in batch.column(5).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array((slots // per_shard).astype(np.int32)), *(batch.column(k) for k in range(1, 5)), packed], names=["slot", "shard", "part", "seq", "n_tokens", "doc_ids", "data"])

    return run


def shard_file(folder: str, shard: int) -> str:
    return f"{folder}/shard-{shard:08d}.bin"


def _write(folder: str, length: int, per_shard: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by slot; a shard's rows are all in one task."""
        unpacker = zstandard.ZstdDecompressor()
        held: list[pa.RecordBatch] = []

        def rows() -> Iterator[tuple[int, pa.RecordBatch]]:
            for batch in batches:
                shards = batch.column("shard").to_numpy()
                edges = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
                for a, b in zip(edges[:-1], edges[1:], strict=True):
                    if b > a:
                        yield int(shards[a]), batch.slice(a, b - a)

        def finish(shard: int) -> Iterator[pa.RecordBatch]:
            put(shard_file(folder, shard), lambda out: [out.write(unpacker.decompress(x, 2 * length)) for b in held for x in b.column("data").to_pylist()])
            for b in held:
                at = (b.column("slot").to_numpy() - shard * per_shard) * 2 * length
                yield pa.RecordBatch.from_arrays([*(b.column(n) for n in ("slot", "shard")), pa.array(at), *(b.column(n) for n in ("part", "seq", "n_tokens", "doc_ids"))], names=["slot", "shard", "byte_offset", "part", "seq", "n_tokens", "doc_ids"])

        open_shard = None
        for shard, rows_of in rows():
            if shard != open_shard and held:
                yield from finish(open_shard)
                held = []
            open_shard = shard
            held.append(rows_of)
        if held:
            yield from finish(open_shard)

    return run


def training_shards(
    docs: DataFrame, tokenizer_path: str, folder: str | None = None, length: int = LENGTH, per_shard: int = PER_SHARD, key: int = 2024,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Writes the shards; one row per sequence: slot, shard, byte_offset, part, seq, n_tokens (without filling), doc_ids."""
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "token-shards")
    kind = docs.schema[id_col].dataType
    encoder(tokenizer_path)  # a vocabulary that doesn't fit is refused here, not in a task
    made = docs.select(id_col, text_col).mapInArrow(_sequences(tokenizer_path, length, to_arrow_type(kind)), _columns(kind.simpleString(), "part", "seq", "n_tokens", "doc_ids", "data"))
    sequences = stored(made, "sequences", "zstd", PACKED)
    counts = {r.part: r.n for r in sequences.groupBy("part").agg(F.count("*").alias("n")).collect()}  # a row per task
    offsets, total = [], 0
    for part in sorted(counts):
        offsets.append((part, total))
        total += counts[part]
    schema = _columns(kind.simpleString(), "slot", "shard", "part", "seq", "n_tokens", "doc_ids", "data")
    index = _columns(kind.simpleString(), "slot", "shard", "byte_offset", "part", "seq", "n_tokens", "doc_ids")
    if not total:
        return spark.createDataFrame([], index).withColumn("folder", F.lit(folder))
    starts = spark.createDataFrame(offsets, T.StructType([T.StructField("part", T.IntegerType()), T.StructField("start", T.LongType())]))
    numbered = sequences.join(F.broadcast(starts), "part").select((F.col("start") + F.col("seq")).alias("number"), "part", "seq", "n_tokens", "doc_ids", "data")
    shards = -(-total // per_shard)
    tasks = min(shards, 8 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    task = F.floor(F.col("shard").cast("long") * tasks / shards).cast("int")  # a range of shards each
    dealt = numbered.mapInArrow(_slots(total, key, per_shard), schema).repartitionById(tasks, task).sortWithinPartitions("slot")
    return stored(dealt.mapInArrow(_write(folder, length, per_shard), index), "shard-index").withColumn("folder", F.lit(folder))


def read_from(folder: str, slot: int, count: int, length: int = LENGTH, per_shard: int = PER_SHARD) -> Iterator[np.ndarray]:
    """Sequences from this slot on, by seeking."""
    while count > 0:
        shard, inside = divmod(slot, per_shard)
        fs, path = files(shard_file(folder, shard))
        take = min(count, per_shard - inside)
        with fs.open_input_file(path) as f:
            f.seek(inside * 2 * length)
            data = f.read(take * 2 * length)
        if not data:
            return
        yield from np.frombuffer(data, dtype="<u2").reshape(-1, length)
        slot, count = slot + take, count - take
