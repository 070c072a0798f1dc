"""Benchmark decontamination: words of training documents that lie in a window of some benchmark item.

Texts are lower-cased (A-Z) and cut into runs of 0-9, a-z and non-ASCII characters.  A benchmark window is ``size``
consecutive words of an item; an item of fewer words, but not none, is one window.

Up to ``broadcast_bytes`` of benchmark text, the hashes of all windows, with the words they stand for, are one broadcast;
a pass over the documents' rolling hashes finds possible hits, and each is verified word by word.  A larger benchmark is
never held whole: a bit map of fixed size of the windows' hashes is broadcast, the documents' windows that it lets
through are joined with the benchmark's windows by their words, and what was found is added to the documents.

Null and empty texts have no words: nothing is hit.  Texts of any length are read whole.  Repeated item ids count once.
Items without an id hit like others: together they are one item in n_items, the null in hit_items, and add no name to
items_sha256.  Repeated document rows each get their own result row.  An empty benchmark hits nothing, an empty table
gives no rows.  Other columns of the documents are kept as they are; result columns replace columns of the same name.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import stored
from .words import byte_classes, chunks, window_hashes, words_of

#: Bytes of benchmark text whose windows are broadcast; they take about six times as much memory.
BROADCAST_BYTES = 16 << 20
#: Bits of the map that stands for a larger benchmark, and the segments in which it is put together.
MAP_BITS, SEGMENTS = 27, 1024
#: Parts into which the candidates of a window are dealt.
SALTS = 16

_ALNUM = byte_classes("alnum")
_SPANS = "array<struct<start:bigint,end:bigint>>"
_MADE = ["n_words", "hit_spans", "hit_items", "n_hit", "n_items", "items_sha256", "contaminated"]


class WindowSet:
    """Sorted hashes of benchmark windows by length, with the words to verify a hit."""

    def __init__(self, items: list[tuple[str | None, str | None]], size: int):
        self.items = [item for item, _ in items]
        self.words = words_of([(t or "").encode() for _, t in items], _ALNUM)
        counts = np.diff(self.words.first)
        self.sizes: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # hashes, first words
        for n in np.unique(np.minimum(counts[counts > 0], size)).tolist():
            hashes, at = window_hashes(self.words, n)
            own = counts[self.words.doc[at]]
            own = own >= size if n == size else own == n
            order = np.argsort(hashes[own], kind="stable")
            self.sizes[n] = hashes[own][order], at[own][order]

    def found(self, texts: list[bytes]) -> Iterator[tuple[int, int, int, list[str | None]]]:
        """Text, first word, length and items of each window of the texts that is one of the benchmark's."""
        words = words_of(texts, _ALNUM)
        for n, (known, where) in self.sizes.items():
            hashes, at = window_hashes(words, n)
            place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            for k in np.flatnonzero(known[place] == hashes).tolist():
                i, doc = int(at[k]), int(words.doc[at[k]])
                text = words.raw(i, i + n)
                same = []
                for p in where[place[k] : np.searchsorted(known, hashes[k], side="right")].tolist():
                    if self.words.raw(p, p + n) == text:
                        same.append(self.items[self.words.doc[p]])
                if same:
                    yield doc, i - int(words.first[doc]), n, same


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted ranges without overlap."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _n_words(texts: list[bytes]) -> list[int]:
    return [n for a, b in chunks(texts) for n in np.diff(words_of(texts[a:b], _ALNUM).first).tolist()]


def _with(batch: pa.RecordBatch, new: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(new[f.name], f.type) if f.name in new else batch.column(f.name).cast(f.type) for f in schema], schema=schema)


def _scan(windows, schema: pa.Schema, text_col: str):
    """Adds n_words, hit_spans and hit_items; ``windows`` is the broadcast set."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x or b"" for x in batch.column(text_col).cast(pa.binary()).to_pylist()]
            ranges: dict[int, list[tuple[int, int]]] = defaultdict(list)
            items: dict[int, set[str | None]] = defaultdict(set)
            for a, b in chunks(texts):
                for k, begin, n, same in windows.value.found(texts[a:b]):
                    ranges[a + k].append((begin, begin + n))
                    items[a + k].update(same)
            spans = [[{"start": s, "end": e} for s, e in merged(ranges[k])] if k in ranges else None for k in range(len(texts))]
            names = [sorted(items[k], key=lambda x: (x is None, x or "")) if k in items else None for k in range(len(texts))]
            yield _with(batch, {"n_words": _n_words(texts), "hit_spans": spans, "hit_items": names}, schema)

    return scan


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - MAP_BITS)).astype(np.int64)


def _windows_of_items(size: int):
    """n, gram and item of every window; with them, the slot of its hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in chunks([(t or "").encode() for t in texts]):
                windows = WindowSet(list(zip(names[a:b], texts[a:b], strict=True)), size)
                for n, (hashes, at) in windows.sizes.items():
                    grams = [b" ".join(windows.words.raw(i, i + n)) for i in at.tolist()]
                    own = [windows.items[windows.words.doc[i]] for i in at.tolist()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([n] * len(own), pa.int32()), pa.array(grams, pa.binary()), pa.array(own, pa.string()), pa.array(_slots(hashes))], names=["n", "gram", "item", "slot"])

    return run


def _segment_map(table: pa.Table) -> pa.Table:
    width = (1 << MAP_BITS) // SEGMENTS
    bits = np.zeros(width, dtype=bool)
    bits[table.column("slot").to_numpy() % width] = True
    return pa.table({"segment": table.column("segment")[:1], "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})


def _candidates(sent, sizes: list[int], schema: pa.Schema, text_col: str):
    """Adds a key of the row, n_words and the windows that the map lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, task, k = sent.value, uuid.uuid4().hex, 0
        for batch in batches:
            texts = [x or b"" for x in batch.column(text_col).cast(pa.binary()).to_pylist()]
            found: list[list] = [[] for _ in texts]
            for a, b in chunks(texts):
                words = words_of(texts[a:b], _ALNUM)
                for n in sizes:
                    hashes, at = window_hashes(words, n)
                    slots = _slots(hashes)
                    for i in at[((bits[slots >> 3] >> (7 - (slots & 7)).astype(np.uint8)) & 1) > 0].tolist():
                        doc = int(words.doc[i])
                        found[a + doc].append({"begin": i - int(words.first[doc]), "n": n, "gram": b" ".join(words.raw(i, i + n))})
            rows = [f"{task}-{k + j}" for j in range(len(texts))]
            k += len(texts)
            yield _with(batch, {"_row": rows, "n_words": _n_words(texts), "_found": found}, schema)

    return run


def _merge_spans(spans: Column) -> Column:
    """Sorted spans without overlap; the same as ``merged``."""
    grown = lambda done, x: F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], x["end"]).alias("end"))))
    apart = lambda done, x: (F.size(done) == 0) | (F.element_at(done, -1)["end"] < x["start"])
    return F.aggregate(F.array_sort(spans), F.array().cast(_SPANS), lambda done, x: F.when(apart(done, x), F.array_append(done, x)).otherwise(grown(done, x)))


def _joined_hits(docs: DataFrame, items: DataFrame, size: int, text_col: str, kept: list[T.StructField]) -> DataFrame:
    """The way of a benchmark that is too large for a broadcast."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    windows = stored(items.mapInArrow(_windows_of_items(size), "n int, gram binary, item string, slot bigint").distinct(), "benchmark-windows")
    sizes = sorted(r.n for r in windows.select("n").distinct().collect())  # at most ``size`` rows
    width = (1 << MAP_BITS) // SEGMENTS
    parts = windows.select("slot", F.floor(F.col("slot") / width).cast("int").alias("segment")).distinct().groupBy("segment").applyInArrow(_segment_map, "segment int, bits binary")
    bits = np.zeros((SEGMENTS, width // 8), dtype=np.uint8)
    for row in parts.collect():  # SEGMENTS rows of fixed size
        bits[row.segment] = np.frombuffer(row.bits, dtype=np.uint8)
    sent = spark.sparkContext.broadcast(bits.reshape(-1))
    found = T.ArrayType(T.StructType([T.StructField("begin", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("gram", T.BinaryType())]))
    schema = T.StructType([*kept, T.StructField("_row", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("_found", found)])
    marked = stored(docs.mapInArrow(_candidates(sent, sizes, to_arrow_schema(schema), text_col), schema), "benchmark-candidates")
    asked = marked.select("_row", F.explode("_found").alias("f")).select("_row", "f.begin", "f.n", "f.gram", F.pmod(F.xxhash64("_row"), F.lit(SALTS)).alias("salt"))
    known = windows.select("n", "gram", "item", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    hits = asked.join(known, ["n", "gram", "salt"])
    span = F.struct(F.col("begin").alias("start"), (F.col("begin") + F.col("n")).alias("end"))
    name = F.struct("item")  # collecting leaves out nulls, but not structs of null
    of_row = hits.groupBy("_row").agg(F.collect_set(span).alias("spans"), F.collect_set(name).alias("items"))
    of_row = of_row.select("_row", _merge_spans(F.col("spans")).alias("hit_spans"), F.array_sort(F.col("items.item")).alias("hit_items"))
    return marked.join(of_row, "_row", "left").select(*[f.name for f in kept], "n_words", "hit_spans", "hit_items")


def contamination(
    docs: DataFrame, benchmark: DataFrame, size: int = 10, text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The documents with n_words, hit_spans (ranges of word numbers), hit_items, n_hit, n_items, items_sha256 and
    contaminated."""
    from pyspark.sql.pandas.types import to_arrow_schema

    docs = docs.drop(*_MADE, "_row", "_found")
    kept = [T.StructField(f.name, f.dataType, True) for f in docs.schema]
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text")).where(F.octet_length("text") > 0)
    if (items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0) <= broadcast_bytes:
        windows = WindowSet([(r.item, r.text) for r in items.collect()], size)  # the bytes were counted above
        spans = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
        schema = T.StructType([*kept, T.StructField("n_words", T.LongType()), T.StructField("hit_spans", spans), T.StructField("hit_items", T.ArrayType(T.StringType()))])
        found = docs.mapInArrow(_scan(docs.sparkSession.sparkContext.broadcast(windows), to_arrow_schema(schema), text_col), schema)
    else:
        found = _joined_hits(docs, items, size, text_col, kept)
    n_hit = F.aggregate(F.coalesce("hit_spans", F.array().cast(_SPANS)), F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    names = F.coalesce("hit_items", F.array().cast("array<string>"))
    return found.withColumns({
        "n_hit": n_hit, "n_items": F.size(names).cast("long"),
        "items_sha256": F.sha2(F.array_join(F.array_sort(names), ","), 256), "contaminated": n_hit > 0,
    })


def without_spans(text: str | None, spans: list[tuple[int, int]], min_words: int = 0) -> str | None:
    """The text without the hit words and what stands between them; None if fewer than ``min_words`` words stay."""
    if text is None or not spans:
        return text
    raw = text.encode()
    words = words_of([raw], byte_classes("alnum"))
    parts, at = [], 0
    for a, b in spans:
        parts.append(raw[at : int(words.starts[a])])
        at = int(words.ends[b - 1])
    parts.append(raw[at:])
    left = len(words.starts) - sum(b - a for a, b in spans)
    return None if left < min_words else b"".join(parts).decode()


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, mode: str = "documents", size: int = 10, text_col: str = "text", min_words: int = 1
) -> DataFrame:
    """``documents``: the documents without any hit.  ``spans``: all documents, hit words cut out of their texts; documents
    left with fewer than ``min_words`` words are dropped.  The columns are those of the input."""
    found = contamination(docs, benchmark, size, text_col)
    if mode == "documents":
        return found.where("not contaminated").select(*[found[c] for c in docs.columns])
    if mode != "spans":
        raise ValueError("mode is 'documents' or 'spans'")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[(x["start"], x["end"]) for x in s or []] for s in batch.column("hit_spans").to_pylist()]
            texts = [without_spans(t, s, min_words) for t, s in zip(batch.column(text_col).to_pylist(), spans, strict=True)]
            keep = pa.array([not s or t is not None for t, s in zip(texts, spans, strict=True)])
            place = batch.schema.get_field_index(text_col)
            yield batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type)).filter(keep)

    return found.mapInArrow(cut, found.schema).select(*docs.columns)
