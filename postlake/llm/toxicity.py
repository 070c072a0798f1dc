"""Toxicity by class-conditional Kneser-Ney models of how words are spelled.

Two models of the bytes of a word, one learnt from toxic, one from ordinary labelled documents: the highest order (six
bytes, the start of the word counts as bytes) uses the class's own counts with absolute discounting; lower orders are
shared by both classes and are estimated from continuation counts, the numbers of different bytes that come before a
string, as in Kneser-Ney smoothing.  A rare or unseen expression so falls back on counts that don't depend on the class.
What is compared is the difference of the two log-likelihoods, normalised by length: per word, over windows of words and
over the whole text; a logistic function of these differences is the score.

One training document in ``CALIBRATION``, chosen by hash, is kept from the models, and the logistic function is fitted
to these (at most ``fit_rows`` of them): differences of documents that the models were learnt from are far too large.
Counts run over the whole texts of all other training documents, which a broadcast of the labels marks as long as these
are few enough; texts are not shuffled.  The counts hold every string under itself, so they grow with the number of
different strings.  Up to ``model_strings`` of them are broadcast.  Larger models stay tables: the words of the corpus,
each once, are joined with them, and documents with the words' differences.

Null and empty texts, and texts without words, have the differences 0 and get the score that follows from these.  Texts
of any length are read whole.  If the training rows lack one of the classes, all scores are 0; if only those kept from
the models lack one, the function is fitted to all training rows.  Repeated document rows each get a row; repeated labels
count as often as they occur, and labels without an id or a value not at all.  A row without an id is not held out and
has no label.  An empty table gives no rows.  Other columns, also those named like the ones made here, are not looked at.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import BROADCAST_ROWS, attached, stored
from .words import byte_classes, chunks, words_of

ORDER = 6
DISCOUNT = 0.75
#: Words of a window.
WINDOW = 8
FIT_ROWS = 50_000
CALIBRATION = 5
#: Different words whose mean difference is a feature.
TOP_WORDS = 3
#: Different strings of ORDER bytes of a model that is broadcast; each takes some 60 bytes with what belongs to it.
MODEL_STRINGS = 8_000_000
#: Parts into which the documents of a word are dealt.
SALTS = 16
#: Chosen from these and two more (the largest word, two windows) by the log loss of five-fold cross-validation over the
#: training rows of sf0.1 that are kept from the models; held-out rows had no part in it.
FEATURES = ("words", "peak", "mean")

_U = np.uint64
_CLASSES = byte_classes("alnum")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def _ends(lengths: np.ndarray) -> np.ndarray:
    out = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def spelled(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of each word the string of ORDER bytes that ends there, as a number (0 stands before a word), and
    the word's index."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    data = np.frombuffer(b"".join(words), dtype=np.uint8).astype(_U)
    word = np.repeat(np.arange(len(words)), lengths)
    place = np.arange(len(data)) - _ends(lengths)[:-1][word]
    out = data.copy()
    for back in range(1, ORDER):
        before = np.zeros(len(data), dtype=_U)
        before[back:] = data[:-back]
        before[place < back] = 0
        out |= before << _U(8 * back)
    return out, word


def tail(grams: np.ndarray, order: int) -> np.ndarray:
    """The last ``order`` bytes."""
    return grams & _U((1 << (8 * order)) - 1)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words with their numbers in toxic and in ordinary texts."""
    held: list[Counter] = [Counter(), Counter()]

    def flush() -> Iterator[pa.RecordBatch]:
        for kind, counts in enumerate(held):
            if counts:
                n = pa.array(counts.values(), pa.int64())
                zero = pa.array(np.zeros(len(counts), dtype=np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()), n if kind else zero, zero if kind else n], names=["word", "toxic", "ordinary"])
                counts.clear()

    for batch in batches:
        texts, kinds = [x or b"" for x in batch.column(0).to_pylist()], batch.column(1).to_pylist()
        for a, b in chunks(texts):
            words = words_of(texts[a:b], _CLASSES)
            toxic = np.array(kinds[a:b], dtype=bool)[words.doc]
            for kind in (0, 1):
                own = np.flatnonzero(toxic == bool(kind))
                _, first, n = np.unique(words.hashes[own], return_index=True, return_counts=True)
                data = words.buffer.tobytes().lower()
                for i, c in zip(own[first].tolist(), n.tolist(), strict=True):
                    held[kind][data[words.starts[i] : words.ends[i]]] += c
        if len(held[0]) + len(held[1]) > 300_000:
            yield from flush()
    yield from flush()


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Strings of ORDER bytes with their counts in each class."""
    for batch in batches:
        words = batch.column(0).to_pylist()
        toxic, ordinary = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (1, 2))
        for a in range(0, len(words), 50_000):
            grams, word = spelled(words[a : a + 50_000])
            own, inverse = np.unique(grams, return_inverse=True)
            t, o = (np.bincount(inverse, weights=c[a : a + 50_000][word], minlength=len(own)).astype(np.int64) for c in (toxic, ordinary))
            yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(t), pa.array(o)], names=["gram", "toxic", "ordinary"])


class Table:
    """Numbers by string: the strings in order, and a row of numbers for each kind of number."""

    def __init__(self, keys: np.ndarray, *rows: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.rows = keys[order], [row[order] for row in rows]

    def __call__(self, keys: np.ndarray) -> list[np.ndarray]:
        """The numbers of these strings, 0 for unknown ones."""
        if not len(self.keys):
            return [np.zeros(len(keys), dtype=np.int64) for _ in self.rows]
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        known = self.keys[at] == keys
        return [np.where(known, row[at], 0) for row in self.rows]


class SpellingModels:
    """``top`` has the counts of strings of ORDER bytes in ordinary and in toxic texts; ``context`` those of their contexts
    and the numbers of different continuations, by class.  ``low`` and ``low_context`` have for each lower order the
    continuation counts of strings, and for contexts their sums and the numbers of strings."""

    def __init__(self, top: Table, context: Table, low: dict[int, Table], low_context: dict[int, Table]):
        self.top, self.context, self.low, self.low_context = top, context, low, low_context

    def ratios(self, words: list[bytes]) -> np.ndarray:
        """log p(word | toxic) - log p(word | ordinary)."""
        every, word = spelled(words)
        grams, inverse = np.unique(every, return_inverse=True)
        shared = np.full(len(grams), 1 / 256)
        for order in range(1, ORDER):
            g = tail(grams, order)
            (count,), (n, kinds) = self.low[order](g), self.low_context[order](g >> _U(8))
            some = np.maximum(n, 1)
            own = np.maximum(count - DISCOUNT, 0) / some + DISCOUNT * kinds / some * shared
            shared = np.where(n > 0, own, shared)
        logs = []
        counts, contexts = self.top(grams), self.context(grams >> _U(8))
        for kind in (0, 1):
            n, kinds = contexts[kind], contexts[2 + kind]
            some = np.maximum(n, 1)
            own = np.maximum(counts[kind] - DISCOUNT, 0) / some + DISCOUNT * kinds / some * shared
            logs.append(np.log(np.where(n > 0, np.maximum(own, 1e-12), np.maximum(shared, 1e-12))))
        return np.bincount(word, weights=(logs[1] - logs[0])[inverse], minlength=len(words))


@dataclass
class Counts:
    """The models as tables: top (gram, toxic, ordinary), context (gram, n and kinds by class), low (order, gram, n) and
    low_context (order, gram, n, kinds)."""

    top: DataFrame
    context: DataFrame
    low: DataFrame
    low_context: DataFrame

    def models(self) -> SpellingModels:
        """The same in memory, for a broadcast."""

        def columns(df: DataFrame) -> list[np.ndarray]:
            return [c.to_numpy() for c in df.toArrow().columns]

        gram, ordinary, toxic = columns(self.top.select("gram", "ordinary", "toxic"))
        context, *by_class = columns(self.context.select("gram", "n_ordinary", "n_toxic", "kinds_ordinary", "kinds_toxic"))
        order, low, n = columns(self.low.select("order", "gram", "n"))
        of, held, n_held, kinds = columns(self.low_context.select("order", "gram", "n", "kinds"))
        orders = range(1, ORDER)
        return SpellingModels(
            Table(gram.view(_U), ordinary, toxic), Table(context.view(_U), *by_class), {k: Table(low[order == k].view(_U), n[order == k]) for k in orders},
            {k: Table(held[of == k].view(_U), n_held[of == k], kinds[of == k]) for k in orders},
        )


def learn(train: DataFrame) -> Counts:
    """``train`` has text (binary) and toxic (boolean)."""
    words = train.select("text", "toxic").mapInArrow(_word_counts, "word binary, toxic bigint, ordinary bigint")
    words = stored(words.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")), "words")
    grams = words.mapInArrow(_gram_counts, "gram bigint, toxic bigint, ordinary bigint")
    top = stored(grams.groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")), "grams")
    before = F.shiftrightunsigned("gram", 8).alias("gram")
    context = top.groupBy(before).agg(
        F.sum("ordinary").alias("n_ordinary"), F.sum("toxic").alias("n_toxic"), F.count_if(F.col("ordinary") > 0).alias("kinds_ordinary"), F.count_if(F.col("toxic") > 0).alias("kinds_toxic")
    )
    last = lambda c, n: F.expr(f"{c} & (shiftleft(1L, 8 * ({n})) - 1L)")
    longer = top.select(F.explode(F.sequence(F.lit(1), F.lit(ORDER - 1))).alias("order"), "gram").select("order", last("gram", "order + 1").alias("longer")).distinct()
    low = stored(longer.groupBy("order", last("longer", "order").alias("gram")).agg(F.count("*").alias("n")), "continuations")
    return Counts(top, context, low, low.groupBy("order", before).agg(F.sum("n").alias("n"), F.count("*").alias("kinds")))


def differences(ratio: np.ndarray, word: np.ndarray) -> tuple[float, ...]:
    """FEATURES of a text from its words' differences and numbers (one for each different word): the mean of the TOP_WORDS
    largest of different words (0 for missing ones), the largest difference per word in a window of WINDOW words, and the
    difference per word of the whole text."""
    size = min(WINDOW, len(ratio))
    total = np.concatenate([[0.0], np.cumsum(ratio)])
    largest = np.sort(ratio[np.unique(word, return_index=True)[1]])[-TOP_WORDS:]
    return largest.sum() / TOP_WORDS, float(((total[size:] - total[:-size]) / size).max()), total[-1] / len(ratio)


def text_features(model: SpellingModels, texts: list[bytes]) -> np.ndarray:
    """FEATURES of each text."""
    words = words_of(texts, _CLASSES)
    out = np.zeros((len(texts), len(FEATURES)))
    if not len(words.hashes):
        return out
    _, first, inverse = np.unique(words.hashes, return_index=True, return_inverse=True)
    data = words.buffer.tobytes().lower()
    ratio = model.ratios([data[words.starts[i] : words.ends[i]] for i in first.tolist()])[inverse]
    for k in range(len(texts)):
        a, b = int(words.first[k]), int(words.first[k + 1])
        if a < b:
            out[k] = differences(ratio[a:b], inverse[a:b])
    return out


def _score(broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = broadcast.value
        for batch in batches:
            texts = [x or b"" for x in batch.column(1).to_pylist()]
            parts = [text_features(model, texts[a:b]) for a, b in chunks(texts)]
            values = np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(values[:, k]) for k in range(len(FEATURES)))], names=["id", *FEATURES])

    return run


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A key of the row, its id, and the places of each of its words; a row without words has the null word."""
    task, k = uuid.uuid4().hex, 0
    for batch in batches:
        ids, texts = batch.column(0), [x or b"" for x in batch.column(1).to_pylist()]
        for a, b in chunks(texts):
            words = words_of(texts[a:b], _CLASSES)
            data = words.buffer.tobytes().lower()
            at, names, places = [], [], []
            for doc in range(b - a):
                held: dict[bytes, list[int]] = {}
                for place, i in enumerate(range(int(words.first[doc]), int(words.first[doc + 1]))):
                    held.setdefault(data[words.starts[i] : words.ends[i]], []).append(place)
                at += [a + doc] * max(1, len(held))
                names += list(held) or [None]
                places += list(held.values()) or [[]]
            rows = pa.array([f"{task}-{k + i}" for i in at])
            yield pa.RecordBatch.from_arrays([rows, ids.take(pa.array(at, pa.int64())), pa.array(names, pa.binary()), pa.array(places, pa.list_(pa.int32()))], names=["row", "id", "word", "places"])
        k += len(texts)


def _strings_of_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = batch.column(0).to_pylist()
        for a in range(0, len(words), 50_000):
            grams, word = spelled(words[a : a + 50_000])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(a + word)), pa.array(grams.view(np.int64))], names=["word", "gram"])


def _differences_of_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = np.zeros((batch.num_rows, len(FEATURES)))
        for k, words in enumerate(batch.column(1).to_pylist()):
            words = [w for w in words if w["ratio"] is not None]
            if words:
                place = np.concatenate([w["places"] for w in words])
                of = np.repeat(np.arange(len(words)), [len(w["places"]) for w in words])[np.argsort(place)]
                out[k] = differences(np.array([w["ratio"] for w in words])[of], of)
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(out[:, k]) for k in range(len(FEATURES)))], names=["id", *FEATURES])


def word_ratios(counts: Counts, words: DataFrame) -> DataFrame:
    """(word, ratio) for a table of different words; the same as ``SpellingModels.ratios``, by joins."""
    spelt = stored(words.mapInArrow(_strings_of_words, "word binary, gram bigint"), "strings-of-words")
    discount, shared = F.lit(DISCOUNT), F.lit(1 / 256)
    at = spelt.select("gram").distinct()
    smoothed = lambda count, n, kinds, below: F.greatest(F.coalesce(count, F.lit(0)) - discount, F.lit(0.0)) / n + discount * kinds / n * below
    at = at.withColumn("shared", shared)
    for k in range(1, ORDER):
        own = counts.low.where(F.col("order") == k).select(F.col("gram").alias("_g"), F.col("n").alias("_count"))
        held = counts.low_context.where(F.col("order") == k).select(F.col("gram").alias("_h"), F.col("n").alias("_n"), F.col("kinds").alias("_kinds"))
        g = F.col("gram").bitwiseAND(F.lit((1 << (8 * k)) - 1))
        at = at.join(own, g == F.col("_g"), "left").join(held, F.shiftrightunsigned(g, 8) == F.col("_h"), "left")
        at = at.select("gram", F.when(F.col("_n") > 0, smoothed(F.col("_count"), F.col("_n"), F.col("_kinds"), F.col("shared"))).otherwise(F.col("shared")).alias("shared"))
    at = at.join(counts.top, "gram", "left").join(counts.context.withColumnRenamed("gram", "_h"), F.shiftrightunsigned("gram", 8) == F.col("_h"), "left")
    log = lambda kind: F.log(F.greatest(F.lit(1e-12), F.when(F.col(f"n_{kind}") > 0, smoothed(F.col(kind), F.col(f"n_{kind}"), F.col(f"kinds_{kind}"), F.col("shared"))).otherwise(F.col("shared"))))
    ratios = at.select("gram", (log("toxic") - log("ordinary")).alias("ratio"))
    return spelt.join(ratios, "gram").groupBy("word").agg(F.sum("ratio").alias("ratio"))


def _joined_features(rows: DataFrame, counts: Counts, kind: str) -> DataFrame:
    """FEATURES by joins, for models that are too large for a broadcast."""
    placed = stored(rows.mapInArrow(_places, f"row string, id {kind}, word binary, places array<int>"), "words-of-documents")
    ratios = word_ratios(counts, placed.where("word is not null").select("word").distinct())
    dealt = ratios.select("word", "ratio", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    joined = placed.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS))).join(dealt, ["word", "salt"], "left")
    held = joined.groupBy("row").agg(F.first("id").alias("id"), F.collect_list(F.struct("ratio", "places")).alias("words"))
    return held.select("id", "words").mapInArrow(_differences_of_rows, f"id {kind}, " + ", ".join(f"{f} double" for f in FEATURES))


def fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50, penalty: float = 1e-3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights (the last is the intercept), means and scales, by Newton's method with a ridge penalty."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        ridge = penalty * len(x) * np.array([*[1.0] * (len(w) - 1), 0.0])
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge + 1e-9), z.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w, mean, scale


def _at_most(found: DataFrame, known: DataFrame, fit_rows: int) -> pd.DataFrame:
    """Features and labels of about ``fit_rows`` labelled documents, chosen by hash, and never more than twice as many."""
    part = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(min(1.0, fit_rows / max(1, known.count())) * (1 << 30))
    return found.join(known.where(part), "id").select(*FEATURES, "toxic").limit(2 * fit_rows).toPandas()


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    limit: float = 0.3, fit_rows: int = FIT_ROWS, model_strings: int = MODEL_STRINGS, broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """One row per document: ``id_col``, held_out, score, predicted.  Labels of held-out documents aren't used."""
    held_out = F.coalesce(F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    known = labels.select(F.col(id_col).alias("id"), (F.col(label_col) == 1).alias("toxic")).where(F.col("id").isNotNull() & F.col("toxic").isNotNull() & ~held_out)
    kept = F.pmod(F.xxhash64("id", F.lit("calibration")), F.lit(CALIBRATION)) == 0
    counts = learn(attached(rows, known.where(~kept), "id", "inner", broadcast_rows))
    kind = docs.schema[id_col].dataType.simpleString()
    if counts.top.count() <= model_strings:
        sent = docs.sparkSession.sparkContext.broadcast(counts.models())
        found = rows.mapInArrow(_score(sent), f"id {kind}, " + ", ".join(f"{f} double" for f in FEATURES))
    else:
        found = _joined_features(rows, counts, kind)
    found = stored(found, "toxicity-features")
    sample = _at_most(found, known.where(kept), fit_rows)
    if sample["toxic"].nunique() < 2:
        sample = _at_most(found, known, fit_rows)
    score = F.lit(0.0)
    if sample["toxic"].nunique() == 2:
        w, mean, scale = fit_logistic(sample[list(FEATURES)].to_numpy(), sample["toxic"].to_numpy().astype(float))
        line = F.lit(float(w[-1]))
        for k, f in enumerate(FEATURES):
            line = line + float(w[k]) * ((F.col(f) - float(mean[k])) / float(scale[k]))
        score = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), line))))
    return found.select(F.col("id").alias(id_col), held_out.alias("held_out"), score.alias("score"), (score >= limit).cast("int").alias("predicted"))
