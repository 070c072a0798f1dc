"""A training-data pipeline over ``documents``: five operators, each applied to what the one before it kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again before the
next.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from postlake.llm.decontamination import decontaminate
from postlake.llm.mixing import calibrated
from postlake.llm.ngram_join import one_of_each
from postlake.llm.resampling import selected_rows
from postlake.llm.shared import stored
from postlake.llm.training_order import training_shards


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Document rows that importance resampling selects, each by its own text.

    Null and empty texts have the weight of a text that tells nothing, and are kept or not by their noise.  Repeated rows
    share their noise and stay or go together; rows of one id with different texts are judged apart.  Rows that tie with
    the last selected one in key and id stay.  Without labels all stay; an empty table gives none."""
    return selected_rows(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of similar documents: that with the least id, null being the last.

    Texts without words are similar to nothing and stay, one row of each id and text.  Of repeated rows one stays; rows of
    one id with different texts are documents of their own.  An empty table gives none."""
    return one_of_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Document rows without a window of any benchmark item, items without an id included.

    Null and empty texts have no words and stay, as do repeated rows.  With an empty benchmark all stay."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), "documents")


#: Part of the tokens that the mixture keeps.
MIX_SHARE = 0.9


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Document rows sampled by probabilities raked to tempered shares of source, language and learnt topic, so that
    MIX_SHARE of the tokens are expected to stay.

    Null sources, languages and topics are a value of their own.  Texts without tokens are sampled with the rate of a
    group of average weight.  Repeated rows, and rows without an id of one group, share their draw."""
    return calibrated(docs, MIX_SHARE, columns=docs.columns).where("mix_sampled").select(*docs.columns)


def write_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards in training order; a row per sequence, with the ids of the documents in it.

    Null and empty texts are an end token; repeated rows are encoded each time; an empty table gives no shards."""
    return training_shards(docs, public_tokenizers.path("byte_bpe_50k.tiktoken")).drop("folder")


STAGES = [
    ("quality", select_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("training_order", write_shards),
]

#: Hashed models and sampling noise have no SQL; tests/llm/test_pipeline.py holds each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
