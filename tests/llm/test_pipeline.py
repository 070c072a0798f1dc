"""What each stage of the pipeline keeps, against plain versions on small documents."""

import importlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from postlake.llm import mixing, training_order
from postlake.llm.resampling import importance_resample
from postlake.llm.shared import uniform

from test_operators import brute_components, rake_plainly


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with copies, junk, benchmark passages, nulls, repeated rows and rows that share an id."""
    rng = np.random.default_rng(12)
    words = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(300)]
    plain = lambda n: " ".join(rng.choice(words, n))
    texts = [plain(int(rng.integers(20, 80))) for _ in range(60)]
    texts += [t + " end" for t in texts[:12]] + ["### $$$ " * 20 + str(k) for k in range(20)]
    passage = " ".join(f"bench{k}" for k in range(12))
    texts += [f"{plain(30)} {passage} {plain(5)}" for _ in range(4)] + [None, "", texts[0]]
    rows = [(k, t, ["en", "de", None][k % 3], f"s{k % 4}", 0) for k, t in enumerate(texts)]
    rows += [rows[5], (7, plain(40), "en", "s0", 0), (None, plain(40), "en", "s1", 0), (None, plain(40), None, None, None)]
    root = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(2).write.parquet(f"{root}/documents.parquet")
    labels = [(k, int(not (t or "").startswith("#")), 0) for k, t in enumerate(texts) if k % 2 == 0]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([("a", passage), (None, None)], "item_id string, text string").write.parquet(f"{root}/benchmark.parquet")
    return root


def rows_of(df):
    return Counter((r.doc_id, r.text, r.lang, r.source) for r in df.collect())


def test_quality_keeps_what_is_selected(spark, folder):
    stage = dict(importlib.import_module("corpus_pipeline").STAGES)["quality"]
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    kept = rows_of(stage(spark, docs, folder))
    every = rows_of(docs)
    assert not kept - every  # a row at most as often as it occurs
    chosen = Counter((r.doc_id, r.selected) for r in importance_resample(docs, labels).collect())
    assert Counter(k[0] for k in kept.elements()) == Counter({i: n for (i, yes), n in chosen.items() if yes})
    assert not any((k[1] or "").startswith("#") for k in kept) and sum(kept.values()) > 15


def test_near_duplicates_keep_one_of_each(spark, folder):
    stage = dict(importlib.import_module("corpus_pipeline").STAGES)["near_duplicates"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
    group = [c for _, c in brute_components([t for _, t, _, _ in rows])]
    kept = rows_of(stage(spark, docs, folder))
    alone = {i for i, (_, t, _, _) in enumerate(rows) if not (t or "").split()}
    wanted = {}
    for i, row in enumerate(rows):
        wanted.setdefault(("alone", row[0], row[1]) if i in alone else group[i], []).append(row)
    assert sum(kept.values()) == len(wanted)
    for members in wanted.values():
        ids = [m[0] for m in members if m[0] is not None]
        assert sum(kept[m] for m in set(members)) == 1
        assert not ids or any(kept[m] for m in members if m[0] == min(ids))


def test_decontamination_drops_documents_with_a_passage(spark, folder):
    stage = dict(importlib.import_module("corpus_pipeline").STAGES)["decontamination"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    want = Counter({k: n for k, n in rows_of(docs).items() if "bench3 bench4" not in (k[1] or "")})
    assert rows_of(stage(spark, docs, folder)) == want


def test_mixing_samples_by_raked_probabilities(spark, folder):
    stage = dict(importlib.import_module("corpus_pipeline").STAGES)["mixing"]
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumn("draw", uniform(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), seed=11))
    rows = docs.collect()
    assert mixing.topic_words(docs) == []  # no words of seven letters, so there is one topic
    plain = [(r.source or mixing._NONE, r.lang or mixing._NONE, "", len((r.text or "").split())) for r in rows]
    goals = []
    for d in range(3):
        own = Counter()
        for *cell, n in plain:
            own[cell[d]] += n
        goal = {v: (n / sum(own.values())) ** 0.9 for v, n in own.items()}
        goals.append({v: g / sum(goal.values()) for v, g in goal.items()})
    share = importlib.import_module("corpus_pipeline").MIX_SHARE
    want = Counter((r.doc_id, r.text, r.lang, r.source) for r, p in zip(rows, rake_plainly(plain, goals, share), strict=True) if r.draw < p)
    assert rows_of(stage(spark, docs.drop("draw"), folder)) == want


def test_shards_hold_every_token(spark, folder):
    stages = importlib.import_module("corpus_pipeline").STAGES
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = stages[-1][1](spark, docs, folder).collect()
    encode, _ = training_order.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    assert sum(r.n_tokens for r in out) == sum(len(encode(r.text or "")) + 1 for r in docs.collect())
    assert sorted(r.slot for r in out) == list(range(len(out)))


def test_stages_one_after_the_other(spark, folder):
    """run() is the stages applied to what the one before kept, and ends with the kept documents' tokens."""
    pipeline = importlib.import_module("corpus_pipeline")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in pipeline.STAGES[:-1]:
        kept = stage(spark, docs, folder)
        assert kept.columns == docs.columns
        kept.write.parquet(path := f"{folder}/kept-{kept.columns[0]}-{_}")
        docs = spark.read.parquet(path)
    encode, _ = training_order.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    want = [(r.doc_id, len(encode(r.text or "")) + 1) for r in docs.collect()]
    got = pipeline.run(spark, folder).collect()
    assert sum(r.n_tokens for r in got) == sum(n for _, n in want)
    assert {d for r in got for d in r.doc_ids} == {d for d, _ in want}
