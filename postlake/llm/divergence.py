"""How far the words of sources are from those of their language, and from each other.

Terms are runs of letters (A-Z in lower case, and all characters over 0x7F).  A language keeps the terms that occur in at
least ``least`` of its documents.  Each (language, source) group, and each language, gives a kept term the share
``p = 1 + floor(SCALE * (n + 5) / (N + 5 * V))``: n occurrences, N those of all V kept terms.

1. Tasks split their texts with Arrow's compute functions, encode terms as dictionary codes and count them by hash
   grouping, first per document and then per group, so that one row per task, group and term is shuffled.
2. Counts are merged per group and term, document counts per language and term; totals per group.
3. Kept terms are dealt into shards of a language by hash.  A shard is a matrix of its terms and the language's sources;
   it gives the sum of differences for each pair of sources, and each source's foremost terms.  No shard depends on
   another, and none grows with a group's share of the documents.  Sums are added up; foremost terms are ranked again.

All numbers are whole (64 bits, the division in three steps of 1000), so the outcome doesn't depend on how rows are dealt.

Null text, language and source count as ''.  Groups without kept terms have the share of zero occurrences, languages
without kept terms differences of 0 and no terms.  Repeated rows count each time.  Equal values are ranked by the bytes of
the item.  Texts are read whole; an empty table gives no rows; columns besides text, lang and source aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

SCALE = 1_000_000_000
SMOOTHING = 5

#: What stands between terms, as Arrow's regular expressions have it.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"

#: Bytes of texts that are split at once; a longer text is split alone.
PART = 8 << 20

#: Rows of counts that a task holds before it passes them on.
HELD = 1_000_000

#: Rows of counts in a batch that a task passes on.
BATCH = 20_000

#: Rows of kept counts in a shard, about, and cells of a matrix that are held at once.
SHARD, CELLS = 500_000, 2_000_000

_COUNTS = "lang string, source string, term string, n bigint, docs bigint"


# Counting.


def _ranges(lengths: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    begin, held = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if i > begin and held + n > limit:
            yield begin, i
            begin, held = i, 0
        held += n
    if begin < len(lengths):
        yield begin, len(lengths)


def count_terms(lang: pa.Array, source: pa.Array, text: pa.Array) -> pa.Table:
    """lang, source, term, n, docs of some documents; columns without nulls."""
    lists = pc.split_pattern_regex(pc.ascii_lower(text), pattern=BETWEEN)
    doc, term = pc.list_parent_indices(lists), pc.list_flatten(lists)
    full = pc.not_equal(term, "")
    doc, coded = doc.filter(full), term.filter(full).dictionary_encode()
    per_doc = pa.table({"doc": doc, "code": coded.indices}).group_by(["doc", "code"], use_threads=False).aggregate([("code", "count")])
    at = per_doc.column("doc")
    # Groups as one code each, so that the second grouping has numbers for keys.
    langs, sources = lang.dictionary_encode(), source.dictionary_encode()
    group = pc.add(pc.multiply(langs.indices.cast(pa.int64()), max(len(sources.dictionary), 1)), sources.indices.cast(pa.int64()))
    per_group = pa.table({"group": group.take(at), "code": per_doc.column("code"), "n": per_doc.column("code_count")}).group_by(["group", "code"], use_threads=False).aggregate([("n", "sum"), ("n", "count")])
    group = per_group.column("group")
    k = max(len(sources.dictionary), 1)
    which = pc.divide(group, k)
    out = {
        "lang": langs.dictionary.take(which), "source": sources.dictionary.take(pc.subtract(group, pc.multiply(which, k))),
        "term": coded.dictionary.take(per_group.column("code")), "n": per_group.column("n_sum"), "docs": per_group.column("n_count"),
    }
    return pa.table(out)


def _merged(parts: list[pa.Table]) -> pa.Table:
    """Counts of several tables added up."""
    both = pa.concat_tables(parts)
    parts.clear()  # the caller's: no more than one copy is held
    coded = {c: pc.dictionary_encode(both.column(c)).combine_chunks() for c in ("lang", "source", "term")}
    table = pa.table({**{c: a.indices for c, a in coded.items()}, "n": both.column("n"), "docs": both.column("docs")})
    del both
    out = table.group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return pa.table({**{c: a.dictionary.take(out.column(c)) for c, a in coded.items()}, "n": out.column("n_sum"), "docs": out.column("docs_sum")})


def _counter(limit: int):
    """Batches of lang, source and text to counts; a task adds up what it has, and passes it on when that is much, in batches
    of which the executor holds one at a time outside its heap."""

    def passed(table: pa.Table) -> Iterator[pa.RecordBatch]:
        for a in range(0, table.num_rows, BATCH):
            yield from table.slice(a, BATCH).combine_chunks().cast(_SCHEMA).to_batches()
        pa.default_memory_pool().release_unused()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            lang, source, text = batch.columns
            for a, b in _ranges(pc.binary_length(text).to_numpy(zero_copy_only=False), PART):
                part = count_terms(lang.slice(a, b - a), source.slice(a, b - a), text.slice(a, b - a))
                held.append(part)
                rows += part.num_rows
                if rows > limit:
                    held = [_merged(held)]
                    pa.default_memory_pool().release_unused()
                    rows = held[0].num_rows
                if rows > limit // 2 and len(held) == 1:  # adding up didn't help much
                    yield from passed(held[0])
                    held, rows = [], 0
        if held:
            yield from passed(_merged(held))

    return run


_SCHEMA = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


# Shares.


def shares(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """``1 + floor(SCALE * (n + SMOOTHING) / total)`` in whole numbers, for totals up to 9e15."""
    total = np.maximum(np.asarray(total, dtype=np.int64), 1)
    whole, rest = np.divmod(np.asarray(n, dtype=np.int64) + SMOOTHING, total)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + digits
    return whole + 1


_PARTIAL = "part string, lang string, source string, item string, value bigint"


def _shard(top: int, cells: int):
    """(lang, shard) with counts (source, term, n, in_lang) and groups (source, total: N + 5 V of the group, lang_total) to the
    shard's sums of each pair of sources, the lesser one first, and each source's foremost terms."""

    def run(key: tuple, counts: pa.Table, groups: pa.Table) -> pa.Table:
        groups = groups.sort_by("source")
        sources, total = groups.column("source").to_pylist(), groups.column("total").to_numpy()
        size, lang_total = len(sources), groups.column("lang_total")[0].as_py()
        sums = np.zeros((size, size), dtype=np.int64)
        best: list[pa.Table] = []
        if counts.num_rows:
            counts = counts.combine_chunks()
            where = pc.index_in(counts.column("source"), groups.column("source").combine_chunks()).combine_chunks().to_numpy(zero_copy_only=False)
            coded = pc.dictionary_encode(counts.column("term")).combine_chunks()
            code, n, in_lang = coded.indices.to_numpy(), counts.column("n").to_numpy(), counts.column("in_lang").to_numpy()
            order = np.argsort(code, kind="stable")
            where, code, n, in_lang = where[order], code[order], n[order], in_lang[order]
            n_terms, width = len(coded.dictionary), max(cells // size, 1)
            for low in range(0, n_terms, width):
                high = min(low + width, n_terms)
                a, b = np.searchsorted(code, [low, high])
                matrix = np.zeros((size, high - low), dtype=np.int64)
                matrix[where[a:b], code[a:b] - low] = n[a:b]
                matrix = shares(matrix, total[:, None])
                for k in range(size - 1):
                    sums[k, k + 1 :] += np.abs(matrix[k + 1 :] - matrix[k]).sum(axis=1)
            p, q = shares(n, total[where]), shares(in_lang, np.full(len(n), lang_total))
            up = np.flatnonzero(p > q)
            found = pa.table({"source": where[up], "value": (p - q)[up], "item": coded.dictionary.take(pa.array(code[up]))})
            found = found.sort_by([("source", "ascending"), ("value", "descending"), ("item", "ascending")])
            place = found.column("source").to_numpy()
            first = np.searchsorted(place, np.arange(size))
            found = found.filter(pa.array(np.arange(len(place)) - first[place] < top))
            best.append(found)
        x, y = np.triu_indices(size, 1)
        names, lang = pa.array(sources, pa.string()), key[0].as_py()
        out = [(["pair"] * len(x), names.take(pa.array(x)), names.take(pa.array(y)), pa.array(sums[x, y]))]
        for t in best:
            out.append((["term"] * t.num_rows, names.take(t.column("source").combine_chunks()), t.column("item"), t.column("value")))
        schema = pa.schema([("part", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])
        return pa.concat_tables([pa.table([pa.array(kind, pa.string()), pa.array([lang] * len(kind), pa.string()), source, item, value], schema=schema) for kind, source, item, value in out])

    return run


def source_divergence(docs: DataFrame, least: int = 30, top: int = 50, shard_rows: int = SHARD, cells: int = CELLS, held_rows: int = HELD) -> DataFrame:
    """lang, source, part (pair or term), item, value and rank.  ``pair``: each other source of the language with the summed
    differences of shares; ``term``: the ``top`` terms whose share in the group is most above that in the language."""
    full = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counts = stored(full.mapInArrow(_counter(held_rows), _COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "term-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("in_lang"), F.sum("docs").alias("_docs")).where(F.col("_docs") >= least).drop("_docs")
    kept = stored(counts.drop("docs").join(kept, ["lang", "term"]), "kept-terms")
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("_n"))
    langs = kept.groupBy("lang").agg(F.sum("n").alias("_in_lang"), F.count_distinct("term").alias("_v"), F.count("*").alias("_rows"))
    v = F.coalesce("_v", F.lit(0)) * SMOOTHING
    groups = full.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    shards = F.ceil(F.coalesce("_rows", F.lit(0)) / F.lit(shard_rows)).cast("int") + 1
    groups = stored(groups.select("lang", "source", (F.coalesce("_n", F.lit(0)) + v).alias("total"), (F.coalesce("_in_lang", F.lit(0)) + v).alias("lang_total"), shards.alias("_shards")), "term-groups")
    dealt = kept.join(groups.groupBy("lang").agg(F.max("_shards").alias("_of")), "lang").withColumn("shard", F.pmod(F.xxhash64("term"), F.col("_of")).cast("int"))
    dealt = dealt.select("lang", "source", "term", "n", "in_lang", "shard")
    copies = groups.select(F.col("lang").alias("lang_"), F.col("source").alias("source_"), "total", "lang_total", F.explode(F.sequence(F.lit(0), F.col("_shards") - 1)).alias("shard_")).toDF("lang", "source", "total", "lang_total", "shard")
    partial = dealt.groupBy("lang", "shard").cogroup(copies.groupBy("lang", "shard")).applyInArrow(_shard(top, cells), _PARTIAL)
    partial = stored(partial, "term-shards")
    sums = partial.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    ends = F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))).alias("e")
    pairs = sums.select("lang", ends, "value").select("lang", "e.source", F.lit("pair").alias("part"), "e.item", "value")
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))).alias("rank")
    terms = partial.where("part = 'term'").select("lang", "source", "part", "item", "value", place).where(F.col("rank") <= top)
    return pairs.select("*", place).unionByName(terms)
