"""The operators as queries over the tables of a folder, and their SQL where there is such."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontamination import contamination
from .divergence import source_divergence
from .exact_dedup import exact_groups
from .html_text import extract_main_text
from .merkle import merkle_manifest
from .mixing import calibrated
from .ngram_join import similar_components
from .pieces import piece_digests
from .resampling import importance_resample
from .shared import new_folder
from .token_counts import fill_cache, token_counts
from .toxicity import toxicity_scores
from .training_order import training_shards
from .warc import read_archives, write_archives


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as archives and read back."""
    return read_archives(write_archives(_table(spark, sf_dir, "pages"), least=100)).drop("url")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of pages."""
    return extract_main_text(_table(spark, sf_dir, "pages"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked by their shingles."""
    return similar_components(_table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts."""
    return exact_groups(_table(spark, sf_dir, "documents"))


def op5_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token shards of all documents in training order; a row per sequence."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return training_shards(_table(spark, sf_dir, "documents"), path).drop("folder")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of documents, from a cache of this run's own: half of the contents are counted first, as an earlier run
    would have, so that the counts of all documents come from stored ones and from misses, whatever ran before."""
    docs, path, cache = _table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), new_folder(spark, "token-counts")
    fill_cache(docs.where(F.crc32(F.coalesce("text", F.lit(""))) % 2 == 0), path, cache)
    return token_counts(docs, path, cache)


def op7_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their importance weights and whether they are selected."""
    return importance_resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


#: Shares of tokens by language; other languages keep theirs, before all are scaled to one.
LANGUAGES = (("en", 0.55), ("de", 0.15), ("es", 0.15), ("fr", 0.15))


def op8_mixing(spark: SparkSession, sf_dir: str, languages: tuple[tuple[str, float], ...] = LANGUAGES, temper: float = 0.7, share: float = 0.6) -> DataFrame:
    """Documents with their sampling probabilities after raking to a share of all tokens: given shares of languages, tempered
    ones of sources and learnt topics."""
    targets = {"lang": spark.createDataFrame(list(languages), "lang string, share double")}
    return calibrated(_table(spark, sf_dir, "documents"), share, targets, temper, columns=["doc_id", "source", "lang"])


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of benchmark windows in documents."""
    found = contamination(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of documents."""
    return toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves, roots and proofs of documents; half of them are checked after their line ends were taken out."""
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return merkle_manifest(_table(spark, sf_dir, "documents"), tampered, F.replace("text", F.lit("\n"), F.lit("")))[0]


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of documents' ids and of what these decode to."""
    return piece_digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of each language against each other, and their foremost terms."""
    return source_divergence(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of corpus_pipeline.py one after the other."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_warc, op2_html_extraction, op3_ngram_jaccard_join, op4_exact_dedup, op5_training_order, op6_token_counts, op7_quality_resampling, op8_mixing, op9_decontamination, op10_toxicity, op11_merkle_manifest, op12_sentencepiece, op13_source_divergence, pipeline)}

ORACLE_SQL = {
    "op1_warc": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
        d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
        f AS (SELECT payload_digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
        SELECT d.page_id, CAST(d.payload_bytes AS BIGINT) AS payload_bytes, d.payload_digest,
               CASE WHEN d.page_id > f.first_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN d.page_id > f.first_id THEN f.first_id END AS refers_to
        FROM d LEFT JOIN f USING (payload_digest)""",
    "op3_ngram_jaccard_join": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
        s AS (
            SELECT DISTINCT doc_id, shingle FROM (
                SELECT doc_id, unnest(list_transform(range(1, greatest(len(words) - 4, 1) + 1), lambda i: array_to_string(words[i:i + 4], ' '))) AS shingle
                FROM w WHERE len(words) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS both_have FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        links AS (SELECT x, y FROM common JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * both_have >= 80 * (nx.n + ny.n - both_have)),
        reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.other)
        SELECT r.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(r.other) AS component_id
        FROM reach r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id""",
    "op4_exact_dedup": """
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, sha256(text) AS text_sha256
        FROM t WINDOW g AS (PARTITION BY text)""",
    "op9_decontamination": r"""
        WITH dw AS (
            SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM documents),
        bw AS (
            SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM benchmark),
        win AS (
            SELECT DISTINCT item_id, least(len(words), 10) AS size, array_to_string(words[i:i + 9], ' ') AS gram
            FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM bw WHERE len(words) > 0)),
        sizes AS (SELECT DISTINCT size FROM win),
        spots AS (
            SELECT doc_id, size, i, array_to_string(words[i:i + size - 1], ' ') AS gram
            FROM (SELECT doc_id, size, words, unnest(range(1, len(words) - size + 2)) AS i FROM dw, sizes WHERE len(words) >= size)),
        hits AS (SELECT spots.doc_id, spots.i, spots.size, win.item_id FROM spots JOIN win ON win.size = spots.size AND win.gram = spots.gram),
        words_hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM (SELECT DISTINCT doc_id, i, size FROM hits)) GROUP BY doc_id),
        items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
        SELECT dw.doc_id, CAST(len(dw.words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
               sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM dw LEFT JOIN words_hit USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op11_merkle_manifest": r"""
        WITH RECURSIVE
        fields AS (
            SELECT doc_id, source, text,
                   list_transform([CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR)], lambda x: CASE WHEN x IS NULL THEN '-' ELSE octet_length(encode(x)) || ':' || x END) AS head
            FROM documents),
        seeds AS (SELECT unnest(range(256)) AS b),
        steps(b, k, v) AS (SELECT b, 0, b FROM seeds UNION ALL SELECT b, k + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM steps WHERE k < 8),
        crc_table AS (SELECT list(v ORDER BY b) AS t FROM steps WHERE k = 8),
        crc AS (
            SELECT doc_id, xor(list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
                   lambda c, b: xor(c // 256, t[(xor(c, b) % 256) + 1])), 4294967295) AS crc
            FROM documents, crc_table),
        leaves AS (
            SELECT doc_id, source, sha256(array_to_string(head, '') || CASE WHEN text IS NULL THEN '-' ELSE octet_length(encode(text)) || ':' || text END) AS leaf,
                   sha256(array_to_string(head, '') || CASE WHEN text IS NULL THEN '-' WHEN crc % 2 = 0 THEN octet_length(encode(replace(text, chr(10), ''))) || ':' || replace(text, chr(10), '')
                          ELSE octet_length(encode(text)) || ':' || text END) AS checked
            FROM fields JOIN crc USING (doc_id)),
        levels(source, k, nodes) AS (
            SELECT source, 0, list(leaf ORDER BY doc_id) FROM leaves GROUP BY source
            UNION ALL
            SELECT source, k + 1, list_transform(range(0, len(nodes), 3), lambda i: sha256(array_to_string(nodes[i + 1:i + 3], ''))) FROM levels WHERE len(nodes) > 1),
        subroots AS (SELECT source, nodes[1] AS subroot FROM levels WHERE len(nodes) = 1),
        tops(k, nodes) AS (
            SELECT 0, list(subroot ORDER BY source NULLS FIRST) FROM subroots
            UNION ALL
            SELECT k + 1, list_transform(range(0, len(nodes), 3), lambda i: sha256(array_to_string(nodes[i + 1:i + 3], ''))) FROM tops WHERE len(nodes) > 1),
        root AS (SELECT nodes[1] AS root FROM tops WHERE len(nodes) = 1),
        heights AS (SELECT source, max(k) AS h FROM levels GROUP BY source),
        every AS (
            SELECT source, k, nodes FROM levels WHERE len(nodes) > 1
            UNION ALL SELECT s.source, h.h + t.k, t.nodes FROM (SELECT source FROM subroots) s JOIN heights h ON h.source IS NOT DISTINCT FROM s.source, tops t WHERE len(t.nodes) > 1),
        ranks AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place FROM subroots),
        steps_of AS (
            SELECT l.doc_id, e.k, e.nodes, CASE WHEN e.k < h.h THEN l.i // CAST(pow(3, e.k) AS BIGINT) ELSE r.place // CAST(pow(3, e.k - h.h) AS BIGINT) END AS j
            FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i FROM leaves) l
            JOIN heights h ON h.source IS NOT DISTINCT FROM l.source JOIN ranks r ON r.source IS NOT DISTINCT FROM l.source JOIN every e ON e.source IS NOT DISTINCT FROM l.source),
        sides AS (SELECT doc_id, k, array_to_string(nodes[j - j % 3 + 1:j], '') AS lhs, array_to_string(nodes[j + 2:j - j % 3 + 3], '') AS rhs FROM steps_of),
        paths AS (SELECT doc_id, list({'l': lhs, 'r': rhs} ORDER BY k) AS path, string_agg(lhs || rhs, '' ORDER BY k) AS joined FROM sides GROUP BY doc_id),
        folds(doc_id, k, h) AS (
            SELECT doc_id, 0, checked FROM leaves
            UNION ALL SELECT f.doc_id, f.k + 1, sha256(path[f.k + 1].l || f.h || path[f.k + 1].r) FROM folds f JOIN paths p ON p.doc_id = f.doc_id WHERE f.k < len(path))
        SELECT l.doc_id, l.leaf, s.subroot, root.root, sha256(coalesce(p.joined, '')) AS proof_sha256, f.h AS folded_root, f.h = root.root AS verified
        FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source LEFT JOIN paths p ON p.doc_id = l.doc_id
        JOIN folds f ON f.doc_id = l.doc_id AND f.k = coalesce(len(p.path), 0), root""",
    "op13_source_divergence": r"""
        WITH docs AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
        words AS (SELECT doc_id, lang, source, unnest(list_filter(string_split_regex(text, '[\x00-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS term FROM docs),
        kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT doc_id) >= 30),
        sizes AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
        groups AS (SELECT DISTINCT lang, source FROM docs),
        counts AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term),
        totals AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY lang, source),
        shares AS (
            SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (coalesce(t.total, 0) + 5 * s.v)::HUGEINT AS p,
                   1 + (1000000000::HUGEINT * (k.n + 5)) // (s.total + 5 * s.v)::HUGEINT AS q
            FROM groups g JOIN kept k ON k.lang = g.lang JOIN sizes s ON s.lang = g.lang LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
            LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source),
        pairs AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(CAST(sum(abs(x.p - y.p)) AS BIGINT), 0) AS value
            FROM groups a JOIN groups b ON b.lang = a.lang AND b.source <> a.source
            LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
            GROUP BY a.lang, a.source, b.source),
        terms AS (SELECT lang, source, 'term' AS part, term AS item, CAST(p - q AS BIGINT) AS value FROM shares WHERE n > 0 AND p > q)
        SELECT *, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INT) AS rank FROM pairs
        UNION ALL
        SELECT *, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INT) AS rank FROM terms QUALIFY rank <= 50""",
}
