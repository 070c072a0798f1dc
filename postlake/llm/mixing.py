"""Mixing to target weights by iterative proportional fitting, with DataFrame functions only.

Documents are grouped into cells of source, language and topic.  The cells' token weights are raked: each step scales
them so that one marginal meets its target, until all three do.  The raked weight of a cell over its tokens is the rate
of its documents.  Rates times one factor, and at most 1, are the documents' probabilities: the factor is that at which
the expected tokens are the ``share`` of all tokens that the caller wants.  A document is sampled if a number made of its
id and the seed is below its probability.  Where the cap of 1 holds (mix_capped), a cell has less than its target, and
the others have more: ``mixture`` tells by how much each value's expected share differs from the raked one.

Targets are tables of a dimension's values and shares; without one, they are the marginal's own shares to the power
``temper``, scaled to one.  Targets that no weights of the cells that there are can meet don't converge; the weights of
the last sweep are then used and mix_converged is false in every row.

The topic is a column, if one is named, else learnt: words of at least seven letters that are in 0.05 to 20 % of the
documents are ranked by residual IDF, which is high for words that occur often where they occur at all, and a text's topic
is the first of the ``topics`` best that it contains.  Counts are made over all whole texts; documents are then read once
more for their tokens and topics, twice if texts are returned.

Missing values of the three dimensions are a value of their own.  Null and empty texts have no tokens and no topic; texts of
any length are counted whole.  A cell without tokens keeps the rate 1 (before the common factor), as does a value that the
given targets don't mention: it keeps its share.  Of words of equal rank the first in order comes first.  Repeated rows
share their fate, because the draw depends on the id and the seed; so do all rows without an id that are of one cell.  An
empty table gives no rows.  Other columns stay as they are; columns of the made names are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored, uniform

DIMENSIONS = ("source", "lang", "topic")
#: Cells that are raked in one task; more are raked by windows over several.
ONE_TASK_CELLS = 100_000
#: Words that stand for topics.
TOPICS = 24

_NONE = "\u0000none"


def _long_words(text: Column) -> Column:
    """Runs of at least seven letters (a-z and whatever isn't ASCII), lower-cased."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"([^\x00-\x60\x7B-\x7F]{7,})"), 1)


def topic_words(docs: DataFrame, text_col: str = "text", topics: int = TOPICS, least: float = 0.0005, most: float = 0.2) -> list[str]:
    """The words with the highest residual IDF, log(1 - exp(-occurrences / documents)) - log(share of documents)."""
    words = docs.select(F.coalesce(_long_words(F.col(text_col)), F.array().cast("array<string>")).alias("w"))
    # An occurrence is a word; a document of it is the word with a blank before it; a document is an empty string.
    marks = F.concat(F.array(F.lit("")), "w", F.transform(F.array_distinct("w"), lambda x: F.concat(F.lit(" "), x)))
    counts = words.select(F.explode(marks).alias("m")).groupBy("m").agg(F.count("*").alias("n"))
    counts = counts.groupBy(F.ltrim("m").alias("word")).agg(F.max(F.when(F.col("m").startswith(" "), F.col("n"))).alias("df"), F.max(F.when(~F.col("m").startswith(" "), F.col("n"))).alias("cf"))
    counts = stored(counts, "word-counts")
    total = counts.where("word = ''").agg(F.max("cf")).first()[0] or 0
    if not total:
        return []
    rank = F.log(1 - F.exp(-F.col("cf") / float(total))) - F.log(F.col("df") / float(total))
    found = counts.where((F.col("df") >= max(2.0, least * total)) & (F.col("df") <= most * total) & (F.col("word") != ""))
    return [r.word for r in found.orderBy(F.desc(rank), "word").limit(topics).collect()]


def topic_of(text: Column, words: list[str]) -> Column:
    """The first of the words that the text contains."""
    if not words:
        return F.lit(None).cast("string")
    return F.get(F.array_intersect(F.array(*[F.lit(w) for w in words]), _long_words(text)), F.lit(0))


def tokens_of(text: Column) -> Column:
    """Words between ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def with_targets(cells: DataFrame, targets: dict[str, DataFrame] | None, temper: float) -> DataFrame:
    """Cells with t_<dimension>: the share that the dimension's value shall have."""
    total = Window.partitionBy()
    for d in DIMENSIONS:
        own = cells.groupBy(d).agg(F.sum("tokens").alias("own")).withColumn("own", F.col("own") / F.sum("own").over(total))
        if targets and d in targets:
            given = targets[d].select(F.coalesce(F.col(d).cast("string"), F.lit(_NONE)).alias(d), F.col("share").cast("double").alias("given"))
            own = own.join(given, d, "left").withColumn("goal", F.coalesce("given", "own"))
        else:
            own = own.withColumn("goal", F.when(F.col("own") > 0, F.pow("own", F.lit(temper))).otherwise(0.0))
        own = own.select(d, (F.col("goal") / F.sum("goal").over(total)).alias(f"t_{d}"))
        cells = cells.join(own, d)
    return cells


def rake(cells: DataFrame, sweeps: int = 60, tolerance: float = 1e-7, at_once: int = 6) -> tuple[DataFrame, bool]:
    """``cells`` has the dimensions, tokens and t_<dimension>; (the cells with weight, a share of 1; whether all marginals
    are within ``tolerance`` of their targets).

    Up to ONE_TASK_CELLS cells are raked by windows in one task.  More stay where they are: a step sums up weights per
    value, with partial sums in each task, and joins the sums, a row per value, to the cells."""
    cells = stored(cells, "cells")
    totals = cells.agg(F.count("*").alias("n"), F.sum("tokens").alias("tokens")).first()
    few = totals.n <= ONE_TASK_CELLS
    held = _held_by_window if few else _held_by_sums
    out = (cells.coalesce(1) if few else cells).withColumn("weight", F.col("tokens") / F.lit(float(totals.tokens or 1)))
    for _ in range(0, sweeps, at_once if few else 1):
        for _ in range(at_once if few else 1):
            for d in DIMENSIONS:
                out = held(out, d).withColumn("weight", F.when(F.col("held") > 0, F.col("weight") * F.col(f"t_{d}") / F.col("held")).otherwise(F.lit(0.0))).drop("held")
        out = out.withColumn("gap", F.lit(0.0))
        for d in DIMENSIONS:
            out = held(out, d).withColumn("gap", F.greatest("gap", F.abs(F.col("held") - F.col(f"t_{d}")))).drop("held")
        out = stored(out, "raked-cells")
        gap = out.agg(F.max("gap")).first()[0]
        out = out.drop("gap")
        if gap is None or gap < tolerance:
            return out, True
        out = out.coalesce(1) if few else out
    return out, False


def _held_by_window(cells: DataFrame, d: str) -> DataFrame:
    return cells.withColumn("held", F.sum("weight").over(Window.partitionBy(d)))


def _held_by_sums(cells: DataFrame, d: str) -> DataFrame:
    return cells.join(cells.groupBy(d).agg(F.sum("weight").alias("held")), d)


MADE = ("mix_topic", "mix_tokens", "mix_rate", "mix_probability", "mix_capped", "mix_sampled", "mix_converged")


def calibrated(
    docs: DataFrame, share: float, targets: dict[str, DataFrame] | None = None, temper: float = 0.9, seed: int = 11,
    id_col: str = "doc_id", text_col: str = "text", topic_col: str | None = None, topics: int = TOPICS, columns: list[str] | None = None,
) -> DataFrame:
    """All document rows with mix_topic, mix_tokens, mix_rate, mix_probability, mix_capped, mix_sampled and mix_converged.
    ``share`` is the part of all tokens that is wanted, above 0 and at most 1 (at 1 nothing can be left out).  ``targets``
    has a table for source, lang or topic, with the column of that name and share.  ``columns`` names the documents' columns
    that are returned, else all are."""
    if not 0 < share <= 1:
        raise ValueError("share is above 0 and at most 1")
    kept = [c for c in (docs.columns if columns is None else columns) if c not in MADE]
    topic = F.col(topic_col) if topic_col else topic_of(F.col(text_col), topic_words(docs, text_col, topics))
    dimensions = {"mix_source": F.col("source"), "mix_lang": F.col("lang"), "mix_topic": topic}
    made = [F.coalesce(c.cast("string"), F.lit(_NONE)).alias(n) for n, c in dimensions.items()]
    draw = uniform(F.coalesce(F.col(id_col).cast("string"), F.lit("")), seed=seed).alias("mix_draw")
    keyed = docs.select(*[F.col(c) for c in kept], *made, tokens_of(F.col(text_col)).alias("mix_tokens"), draw)
    if text_col not in kept:
        keyed = stored(keyed, "tokens-and-topics")  # with texts, making tokens and topics twice is less than a copy of all texts
    cells = keyed.groupBy(*[F.col(f"mix_{d}").alias(d) for d in DIMENSIONS]).agg(F.sum("mix_tokens").alias("tokens"))
    raked, converged = rake(with_targets(stored(cells, "token-cells"), targets, temper))
    total = raked.agg(F.sum("tokens")).first()[0] or 0
    rates = raked.select(*[F.col(d).alias(f"mix_{d}") for d in DIMENSIONS], "tokens", F.when(F.col("tokens") > 0, F.col("weight") * total / F.col("tokens")).otherwise(1.0).alias("mix_rate"))
    rates = stored(rates, "rates")
    factor = _factor(rates, share, total)
    cell_rates = rates.drop("tokens")
    if rates.count() <= ONE_TASK_CELLS:
        cell_rates = F.broadcast(cell_rates)
    out = keyed.join(cell_rates, [f"mix_{d}" for d in DIMENSIONS], "left").withColumn("mix_probability", F.least(F.lit(1.0), F.col("mix_rate") * factor))
    out = out.withColumns({"mix_capped": F.col("mix_rate") * factor > 1, "mix_sampled": F.col("mix_draw") < F.col("mix_probability"), "mix_converged": F.lit(converged)})
    return out.select(*kept, *MADE)


#: Factors that one pass over the cells tries, and passes.
_TRIED, _PASSES = 64, 6


def _factor(rates: DataFrame, share: float, total: int) -> float:
    """The factor at which the cells' expected tokens are that share of all: each pass tries factors between the two that
    the last one left, all of them in one aggregate."""
    ends = rates.where("mix_rate > 0 AND tokens > 0").agg(F.min("mix_rate").alias("least"), F.max("mix_rate").alias("most")).first()
    if not ends.least or not total:
        return share
    low, high = 0.0, 1.0 / ends.least
    if share >= 1:
        return high
    for _ in range(_PASSES):
        tried = [low + (high - low) * k / _TRIED for k in range(1, _TRIED)]
        kept = rates.agg(*[F.sum(F.col("tokens") * F.least(F.lit(1.0), F.col("mix_rate") * f)).alias(f"k{k}") for k, f in enumerate(tried)]).first()
        below = sum(k < share * total for k in kept)
        low, high = ([low, *tried][below], [*tried, high][below])
    return (low + high) / 2


def mixture(mixed: DataFrame) -> DataFrame:
    """What a mixture comes to: for each value of source, lang and topic its raked share, the share of expected tokens (they
    differ by what the cap of 1 shifts) and that of sampled tokens.  Of ``calibrated``'s rows with source and lang."""
    values = F.array(*[F.struct(F.lit(d).alias("dimension"), c.cast("string").alias("value")) for d, c in (("source", F.col("source")), ("lang", F.col("lang")), ("topic", F.col("mix_topic")))])
    tokens = F.col("mix_tokens")
    out = mixed.select(F.explode(values).alias("v"), tokens, (tokens * F.col("mix_rate")).alias("raked"), (tokens * F.col("mix_probability")).alias("expected"), F.when(F.col("mix_sampled"), tokens).otherwise(0).alias("sampled"))
    out = out.groupBy("v.dimension", "v.value").agg(*[F.sum(c).cast("double").alias(c) for c in ("raked", "expected", "sampled")])
    whole = out.groupBy("dimension").agg(*[F.sum(c).alias(f"all_{c}") for c in ("raked", "expected", "sampled")])
    return out.join(F.broadcast(whole), "dimension").select("dimension", "value", *[(F.col(c) / F.col(f"all_{c}")).alias(f"{c}_share") for c in ("raked", "expected", "sampled")])  # three rows are broadcast
