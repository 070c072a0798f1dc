"""Nulls, empty tables, repeated rows and clashing columns, for each operator and each stage of the pipeline."""

import hashlib
import importlib
import zlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from postlake.llm import queries, token_counts, training_order
from postlake.llm.decontamination import contamination

CLASHING = ("rid", "id", "key", "n", "part", "label", "bucket", "kept", "target", "score", "mix_topic", "selected", "word", "block", "slot", "component_id", "contaminated")
COUNTED = {"op5_training_order", "op13_source_divergence", "pipeline"}


def clashing(df):
    return df.withColumns({c: F.lit("z") for c in CLASHING})


def documents(spark):
    words = " ".join(f"w{k}" for k in range(60))
    rows = [
        (1, words, "en", "a", 9), (2, words, None, None, None), (2, words, None, None, None), (3, None, "en", "a", 0), (4, "", "de", None, 0), (5, "long " * 200_000, "en", "b", 1),
        (None, "no id here", "en", "a", 1), (None, None, None, None, None), (6, "You utter £$%& fool é", "en", "b", 2), (7, words + " end", "en", "a", 3),
    ]
    return clashing(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))


def tables(spark, folder, empty=False):
    made = {
        "documents": documents(spark),
        "pages": clashing(spark.createDataFrame([(1, "u", "<p>One two</p>"), (2, None, None), (3, "u", ""), (1, "u", "<p>One two</p>"), (None, None, "<p>x" * 50)], "page_id long, url string, html string")),
        "benchmark": clashing(spark.createDataFrame([(1, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11"), (None, "no id here"), (2, None), (3, "")], "item_id long, text string")),
        "labels": clashing(spark.createDataFrame([(1, 1, 0), (2, None, None), (5, 0, 0), (6, 0, 1), (7, 1, None), (None, 1, 1), (6, 0, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")),
    }
    for name, df in made.items():
        (df.limit(0) if empty else df).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def filled(spark, tmp_path_factory):
    return tables(spark, tmp_path_factory.mktemp("edges") / "filled")


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return tables(spark, tmp_path_factory.mktemp("edges") / "empty", empty=True)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_empty_tables(spark, empty, name):
    assert queries.QUERIES[name](spark, empty).collect() == []


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_nulls_and_clashing_columns(spark, filled, name):
    rows = queries.QUERIES[name](spark, filled).collect()
    if name not in COUNTED:
        assert len(rows) == (5 if name in ("op1_warc", "op2_html_extraction") else 10)


def test_values_of_edges(spark, filled):
    """What each case of ``documents`` and ``pages`` gives, not only that it gives a row."""
    run = lambda name, *columns: Counter(tuple(r) for r in queries.QUERIES[name](spark, filled).select(*columns).collect())
    big = "<p>x" * 50
    pages = run("op1_warc", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert pages == Counter([(1, 14, digest("<p>One two</p>"), "response", None)] * 2 + [(k, 0, digest(""), "response", None) for k in (2, 3)] + [(None, 200, digest(big), "response", None)])
    assert run("op2_html_extraction", "page_id", "text", "n_chars") == Counter([(1, "One two", 7)] * 2 + [(2, "", 0), (3, "", 0), (None, "\n".join("x" * 50), 99)])
    assert run("op3_ngram_jaccard_join", "doc_id", "n_shingles", "component_id") == Counter(
        [(1, 56, 1), (2, 56, 1), (2, 56, 1), (7, 57, 1), (3, 0, 3), (4, 0, 4), (5, 1, 5), (None, 1, None), (None, 0, None), (6, 1, 6)])
    assert run("op4_exact_dedup", "doc_id", "keep_id", "group_size", "kept") == Counter(
        [(1, 2, 3, False), (2, 2, 3, True), (2, 2, 3, True), (3, 4, 3, False), (4, 4, 3, True), (None, 4, 3, False), (5, 5, 1, True), (None, None, 1, True), (6, 6, 1, True), (7, 7, 1, True)])
    texts = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{filled}/documents.parquet").collect()]
    tokens = token_counts.batch_counter(public_tokenizers.path("word_bpe_49k.json"))([t for _, t in texts])
    assert run("op6_token_counts", "doc_id", "n_bytes", "n_tokens", "over_limit") == Counter((i, len(t.encode()), n, n > 2048) for (i, t), n in zip(texts, tokens, strict=True))
    encode, _ = training_order.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    shards = queries.QUERIES["op5_training_order"](spark, filled).collect()
    assert sum(r.n_tokens for r in shards) == sum(len(encode(t)) + 1 for _, t in texts) and {d for r in shards for d in r.doc_ids} == {i for i, _ in texts}
    weights = queries.QUERIES["op7_quality_resampling"](spark, filled).collect()
    assert sum(r.log_weight == 0 for r in weights) >= 3 and len({r.key for r in weights if r.doc_id == 2}) == 1
    mixed = queries.QUERIES["op8_mixing"](spark, filled).collect()
    assert Counter((r.doc_id, r.mix_tokens) for r in mixed) == Counter((i, len(t.split())) for i, t in texts)
    assert all(0 < r.mix_probability <= 1 for r in mixed) and len({r.mix_sampled for r in mixed if r.doc_id == 2}) == 1
    hits = run("op9_decontamination", "doc_id", "n_words", "n_hit", "n_items", "contaminated")
    assert hits == Counter([(1, 60, 11, 1, True), (2, 60, 11, 1, True), (2, 60, 11, 1, True), (7, 61, 11, 1, True), (3, 0, 0, 0, False), (4, 0, 0, 0, False), (None, 0, 0, 0, False), (5, 200_000, 0, 0, False), (None, 3, 3, 1, True), (6, 5, 0, 0, False)])
    scores = queries.QUERIES["op10_toxicity"](spark, filled).collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in scores)
    assert len({r.score for r in scores if r.doc_id in (3, 4)}) == 1 and len({r.score for r in scores if r.doc_id == 2}) == 1
    leaves = queries.QUERIES["op11_merkle_manifest"](spark, filled).collect()
    assert len({r.leaf for r in leaves}) == 9 and len({r.root for r in leaves}) == 1 and all(r.verified for r in leaves)  # one row is there twice, no text has a line end
    assert Counter(r.doc_id for r in leaves) == Counter(i for i, _ in texts) and len({r.subroot for r in leaves}) == 3
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    ids = [(i, pieces.encode(t, add_eos=True)) for i, t in texts]
    assert run("op12_sentencepiece", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == Counter((i, len(x), digest(" ".join(map(str, x))), digest(pieces.decode(x))) for i, x in ids)
    assert run("op13_source_divergence", "lang", "source", "part", "item", "value", "rank") == Counter([("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)])


def test_benchmark_items_without_id(spark, filled, tmp_path):
    import duckdb

    got = [r for r in queries.QUERIES["op9_decontamination"](spark, filled).collect() if r.doc_id is None]
    assert sorted((r.n_words, r.n_hit, r.n_items, r.contaminated) for r in got) == [(0, 0, 0, False), (3, 3, 1, True)]
    items = [(None, "no id here"), (None, "other words here"), (7, "no id here"), (8, None)]
    docs = [(1, "so no id here"), (2, "other words here, no id here"), (3, "nothing"), (4, "other words here"), (5, None)]
    spark.createDataFrame(items, "item_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(docs, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    want = sorted(con.execute(queries.ORACLE_SQL["op9_decontamination"]).fetchall())
    assert sorted(tuple(r) for r in queries.QUERIES["op9_decontamination"](spark, str(tmp_path)).collect()) == want
    made = contamination(spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/benchmark.parquet"), broadcast_bytes=1)
    assert sorted(tuple(r) for r in made.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()) == want


def test_stages_return_the_columns_of_documents(spark, filled):
    pipeline = importlib.import_module("corpus_pipeline")
    docs = spark.read.parquet(f"{filled}/documents.parquet")
    for _, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs, filled).columns == docs.columns


def test_toxicity_without_held_out_labels(spark):
    from postlake.llm.toxicity import toxicity_scores

    bad = ["you vile grommish troll", "what a grommish lot of snarf", "snarf off now"]
    texts = [f"plain words about item {k} and weather" + (f" {bad[k % 3]}" if k % 5 == 0 else "") for k in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 5 == 0)) for k in range(400)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity_scores(docs, labels).collect()}
    held = {k for k in range(400) if zlib.crc32(str(k).encode()) % 4 == 2}
    assert {k for k, r in got.items() if r.held_out} == held
    assert all(got[k].predicted == int(k % 5 == 0) for k in held)
    turned = labels.withColumn("toxic", F.when(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r.doc_id: r.score for r in toxicity_scores(docs, turned).collect()}
    assert again == pytest.approx({k: r.score for k, r in got.items()})
