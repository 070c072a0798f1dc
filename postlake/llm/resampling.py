"""Importance resampling towards a target corpus with hashed n-gram models.

Texts are cut into runs of letters and digits and runs of other signs, lower-cased; features are hashed unigrams and
bigrams, where a word that follows itself gives the same feature whatever the word.  Target model: the documents that
the labels call good.  Raw model: all documents.  Both are counts over ``buckets`` hash buckets with add-one smoothing,
gathered over whole texts.  A document's log weight is the sum of log(target/raw) over its features; it gets
log weight + Gumbel noise as its key, and the k largest keys are selected.  k, unless given, is the number of documents
that the models expect to belong to the target: the sum of min(1, share * weight), where share is the target's share of
the labelled documents.  Which documents are good is told to the tasks that read texts by a broadcast of their ids, as
long as these are at most ``broadcast_rows``; texts are not shuffled.

Null and empty texts have no features: log weight 0.  Texts of any length are counted and weighed whole.  Repeated rows
each count and get a row; their noise, and so their key, is the same.  Rows without an id are never in the target and
share their noise.  A label that occurs twice counts once in the target model.  An empty table gives no rows.  Other
columns, also those named like the ones made here, are not looked at.  Documents that tie with the last selected one in key and id are
selected too.  The noise depends on the id and the seed only.  Without labelled target rows nothing can be told apart:
all weights are 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import BROADCAST_ROWS, attached, stored, uniform
from .words import byte_classes, chunks, mix, words_of

BUCKETS = 10_000

_U = np.uint64


def features(texts: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features, and the text each belongs to."""
    words = words_of(texts, byte_classes("mixed"))
    h, doc = words.hashes, words.doc
    one = (h % _U(buckets)).astype(np.int64)
    if len(h) < 2:
        return one, doc
    a, b = h[:-1], h[1:]
    with np.errstate(over="ignore"):
        two = mix(np.where(a == b, _U(0x5851F42D4C957F2D), a * _U(3) + b))
    same = doc[:-1] == doc[1:]
    return np.concatenate([one, (two[same] % _U(buckets)).astype(np.int64)]), np.concatenate([doc, doc[1:][same]])


def _count(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, buckets), dtype=np.int64)
        for batch in batches:
            texts = [x or b"" for x in batch.column(0).to_pylist()]
            target = np.array([bool(x) for x in batch.column(1).to_pylist()], dtype=np.int64)
            for a, b in chunks(texts):
                at, doc = features(texts[a:b], buckets)
                kind = target[a:b][doc]
                total[0] += np.bincount(at[kind == 0], minlength=buckets)
                total[1] += np.bincount(at[kind == 1], minlength=buckets)
        at = np.flatnonzero(total.any(axis=0))
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[0][at]), pa.array(total[1][at])], names=["bucket", "other", "target"])

    return run


def _weigh(table: np.ndarray, buckets: int):
    """Log weights of id, text and further columns; the text goes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x or b"" for x in batch.column(1).to_pylist()]
            out = np.zeros(len(texts))
            for a, b in chunks(texts):
                at, doc = features(texts[a:b], buckets)
                out[a:b] = np.bincount(doc, weights=table[at], minlength=b - a)
            kept = range(2, batch.num_columns)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out), *(batch.column(k) for k in kept)], names=["id", "log_weight", *(batch.schema.names[k] for k in kept)])

    return run


def log_weights(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", buckets: int = BUCKETS, broadcast_rows: int = BROADCAST_ROWS, whole: bool = False) -> tuple[DataFrame, float]:
    """(id, log_weight) per document row, with ``whole`` also the row as a struct named row, and the target's share of the
    labelled documents."""
    text = F.col(text_col).cast("binary").alias("text")
    target = labels.where(F.col(label_col) == 1).select(F.col(id_col).alias("id")).where("id is not null").distinct().withColumn("target", F.lit(True))
    marked = attached(docs.select(F.col(id_col).alias("id"), text), target, "id", "left", broadcast_rows).select("text", "target")
    counts = marked.mapInArrow(_count(buckets), "bucket bigint, other bigint, target bigint").groupBy("bucket").agg(F.sum("other").alias("other"), F.sum("target").alias("target"))
    table = np.zeros((2, buckets))
    for row in counts.collect():  # at most one row per bucket
        table[0][row.bucket], table[1][row.bucket] = row.target + row.other, row.target
    known = labels.agg(F.count_if(F.col(label_col) == 1).alias("good"), F.count(label_col).alias("all")).first()
    model = table + 1
    ratio = np.log(model[1] / model[1].sum()) - np.log(model[0] / model[0].sum()) if table[1].any() else np.zeros(buckets)
    rows = docs.select(F.col(id_col).alias("id"), text, *([F.struct(*docs.columns).alias("row")] if whole else []))
    schema = T.StructType([rows.schema["id"], T.StructField("log_weight", T.DoubleType()), *rows.schema.fields[2:]])
    weights = rows.mapInArrow(_weigh(ratio, buckets), schema)
    return weights, (known.good / known.all if known.all else 1.0)


def cut_of_largest(keys: DataFrame, k: int, bins: int = 1000, few: int = 5000) -> tuple[float, object] | None:
    """The k-th largest (key, id) of a table, None if it has no more than k rows.  Each round counts rows in bins of the
    range that holds it; only the last bin, of at most ``few`` distinct pairs, is looked at row by row."""
    low, high, total = keys.agg(F.min("key"), F.max("key"), F.count("key")).first()
    if total <= k:
        return None
    if k <= 0:
        return float("inf"), None
    above = 0
    while True:
        width = (high - low) / bins
        inside = keys.where(F.col("key").between(low, high))
        if width <= 0 or low + width <= low:
            break
        bin_of = F.least(F.lit(bins - 1), F.floor((F.col("key") - low) / width))
        counts = sorted(inside.groupBy(bin_of.alias("bin")).agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")).collect(), key=lambda r: -r.bin)
        for row in counts:
            if above + row.n >= k:
                break
            above += row.n
        narrowed = (row.low, row.high) != (low, high)
        low, high = row.low, row.high
        if row.n <= few or not narrowed:
            break
    last = keys.where(F.col("key").between(low, high)).groupBy("key", "id").agg(F.count("*").alias("n")).orderBy(F.desc("key"), F.desc("id"))
    for row in last.toLocalIterator() if low == high else last.collect():
        above += row.n
        if above >= k:
            return row.key, row.id
    raise AssertionError("the k-th key is inside the last bin")


def _resampled(docs: DataFrame, labels: DataFrame, k: int | None, seed: int, whole: bool, *args) -> DataFrame:
    """log_weights with key and selected."""
    weights, share = log_weights(docs, labels, *args, whole=whole)
    noise = -F.log(-F.log(uniform(F.coalesce(F.col("id").cast("string"), F.lit("")), seed=seed)))
    keyed = stored(weights.withColumn("key", F.col("log_weight") + noise), "importance-keys")
    if k is None:
        expected = F.least(F.lit(1.0), share * F.exp(F.least(F.col("log_weight"), F.lit(700.0))))
        k = round(keyed.agg(F.sum(expected)).first()[0] or 0)
    cut = cut_of_largest(keyed.select("id", "key"), k)
    chosen = F.lit(True) if cut is None else (F.col("key") > cut[0]) | ((F.col("key") == cut[0]) & F.coalesce(F.col("id") >= F.lit(cut[1]), F.lit(cut[1] is None)))
    return keyed.withColumn("selected", chosen)


def importance_resample(
    docs: DataFrame, labels: DataFrame, k: int | None = None, seed: int = 7, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", buckets: int = BUCKETS,
) -> DataFrame:
    """One row per document row: ``id_col``, log_weight, key, selected."""
    return _resampled(docs, labels, k, seed, False, id_col, text_col, label_col, buckets).select(F.col("id").alias(id_col), "log_weight", "key", "selected")


def selected_rows(
    docs: DataFrame, labels: DataFrame, k: int | None = None, seed: int = 7, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", buckets: int = BUCKETS,
) -> DataFrame:
    """The document rows that are selected, with their columns; each row is judged by its own text."""
    return _resampled(docs, labels, k, seed, True, id_col, text_col, label_col, buckets).where("selected").select("row.*")
