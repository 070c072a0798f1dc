"""Token counts by way of a cache of digests.

A count belongs to the digest of a content and the digest of the tokenizer (its file and library version).  Documents
are reduced to digests; those without a stored count are misses, of which each distinct content is encoded once, and the
counts are appended to the cache before they are joined to the documents.

Texts are encoded by the tokenizer's own library.  Where the tokenizer's file says that white space is removed before
words are split (its first rule keeps the matches of WORDS only), a text's count is the sum over its runs without white
space; a task keeps the counts of runs that it has met and encodes each new one once.  For all other tokenizers, and with
``whole=True``, whole texts are encoded.

Null texts count as empty: 0 bytes, 0 tokens.  Repeated rows, and rows of one id, each get a row; equal texts share one
count.  Texts are counted whole.  An empty table gives no rows and leaves the cache as it is.  Columns besides the id and
the text aren't read, whatever their names.
"""

from __future__ import annotations

import hashlib
import importlib.metadata
import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import attached, shared_dir, stored, tasks_for

#: Runs whose counts a task keeps; when there are more, it starts anew.
MEMO_RUNS = 400_000

#: A splitting rule whose matches hold no white space.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_MISS = "digest binary, text string"


def tokenizer_digest(path: str) -> str:
    """Of the file and the version of the library that reads it."""
    with open(path, "rb") as f:
        data = hashlib.sha256(f.read())
    data.update(importlib.metadata.version("sentencepiece" if path.endswith(".model") else "tokenizers").encode())
    return data.hexdigest()


def batch_counter(path: str) -> Callable[[list[str]], list[int]]:
    """Token counts of texts, special tokens not added, nothing truncated or padded."""
    if path.endswith(".model"):
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in processor.encode(texts, num_threads=1)]
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(x.ids) for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def removes_space(path: str) -> bool:
    """Whether the tokenizer's file is known to remove white space before it splits words."""
    if path.endswith(".model"):
        return False
    with open(path, encoding="utf-8") as f:
        rule = json.load(f).get("pre_tokenizer") or {}
    first = (rule.get("pretokenizers") or [{}])[0] if rule.get("type") == "Sequence" else rule
    return first.get("type") == "Split" and first["behavior"] == "Removed" and first["invert"] and first["pattern"].get("Regex") == WORDS


class RunCounter:
    """Counts of texts as sums over their runs between spaces, tabs and line ends."""

    def __init__(self, count: Callable[[list[str]], list[int]], memo_runs: int = MEMO_RUNS):
        self.count, self.memo_runs, self.known = count, memo_runs, {}

    def __call__(self, texts: list[str]) -> list[int]:
        split = [t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for t in texts]
        if len(self.known) > self.memo_runs:
            self.known = {}
        known = self.known
        new = list({r for runs in split for r in runs if r not in known})
        for a in range(0, len(new), 20_000):
            part = new[a : a + 20_000]
            known.update(zip(part, self.count(part), strict=True))
        get = known.__getitem__
        return [sum(map(get, runs)) for runs in split]


def _local_firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drops contents that the task has already passed on."""
    seen: set[bytes] = set()
    for batch in batches:
        digests = batch.column(0).to_pylist()
        keep = []
        for d in digests:
            keep.append(d not in seen)
            seen.add(d)
        if len(seen) > 1_000_000:
            seen.clear()
        if any(keep):
            yield batch.filter(pa.array(keep))


_counters: dict[tuple[str, bool], Callable[[list[str]], list[int]]] = {}


def counter(path: str, whole: bool) -> Callable[[list[str]], list[int]]:
    """One per tokenizer and Python worker: the file is read once, and runs met by one task are known to the next."""
    if (path, whole) not in _counters:
        count = batch_counter(path)
        _counters[path, whole] = RunCounter(count) if not whole and removes_space(path) else count
    return _counters[path, whole]


def _encode(path: str, whole: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path, whole)
        seen: set[bytes] = set()
        for batch in batches:
            out: dict[bytes, int] = {}
            digests, texts = batch.column(0).to_pylist(), batch.column(1)
            new = [i for i, d in enumerate(digests) if d not in seen and not seen.add(d)]
            for a in range(0, len(new), 500):
                part = new[a : a + 500]
                out.update(zip([digests[i] for i in part], count(texts.take(pa.array(part)).to_pylist()), strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(out.keys(), pa.binary()), pa.array(out.values(), pa.int64())], names=["digest", "n_tokens"])

    return run


def fill_cache(docs: DataFrame, tokenizer_path: str, cache_path: str | None = None, text_col: str = "text", whole: bool = False) -> DataFrame:
    """Encodes each distinct content that has no stored count, appends the counts and returns the cache's (digest, n_tokens).

    The cache is looked up by a join of digests; where it has counts, texts of misses alone go on."""
    spark = docs.sparkSession
    version = tokenizer_digest(tokenizer_path)
    cache_path = cache_path or f"{shared_dir(spark)}/token-counts-{version}"
    schema = "digest binary, n_tokens bigint, tokenizer string"
    spark.createDataFrame([], schema).write.mode("append").parquet(cache_path)

    def cache() -> DataFrame:
        known = spark.read.schema(schema).parquet(cache_path).where(F.col("tokenizer") == version)
        return known.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))

    misses = _keyed(docs, text_col).select("digest", "text")
    old = cache()
    if not old.isEmpty():
        missing = stored(misses.select("digest").distinct().join(old.select("digest"), "digest", "left_anti"), "missing-digests")
        misses = attached(misses, missing, "digest", "left_semi")  # with few misses, texts stay where they are
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    misses = misses.mapInArrow(_local_firsts, _MISS).repartition(tasks_for(spark, total), "digest")
    counted = misses.mapInArrow(_encode(tokenizer_path, whole), "digest binary, n_tokens bigint")
    counted.withColumn("tokenizer", F.lit(version)).write.mode("append").parquet(cache_path)
    return cache()


def _keyed(docs: DataFrame, text_col: str, *columns: str) -> DataFrame:
    return docs.select(*columns, F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("digest", F.unhex(F.sha2("text", 256)))


def token_counts(
    docs: DataFrame, tokenizer_path: str, cache_path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
    limit: int = 2048, whole: bool = False,
) -> DataFrame:
    """One row per document: ``id_col``, n_bytes, n_tokens, over_limit.  ``cache_path`` is a folder that stays between
    runs; without it, the cache is in the shared folder under the tokenizer's digest."""
    counts = stored(fill_cache(docs, tokenizer_path, cache_path, text_col, whole), "token-counts-of-digests")  # as a table, so that AQE can split a digest that many documents have
    rows = _keyed(docs, text_col, id_col).select(id_col, "digest", F.octet_length("text").cast("long").alias("n_bytes"))
    return rows.join(counts, "digest").select(id_col, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
