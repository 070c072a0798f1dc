"""The Merkle manifest, SentencePiece ids and the audit of sources, against brute force and the library."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from postlake.llm import divergence, merkle, pieces

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def plain_levels(nodes):
    out = [nodes]
    while len(nodes) > 1:
        nodes = [sha("".join(nodes[a : a + 3])) for a in range(0, len(nodes), 3)]
        out.append(nodes)
    return out


def plain_path(levels, j):
    out = []
    for level in levels[:-1]:
        a = j - j % 3
        out.append((level[a:j], level[j + 1 : a + 3]))
        j //= 3
    return out


def plain_manifest(rows):
    """(doc_id, leaf, subroot, root, proof, folded root, verified) of rows, with everything in memory."""
    leaf = lambda i, t, l, s, n: sha("".join(map(field, (i, s, l, n, t))))
    trees = defaultdict(list)
    for i, t, l, s, n in rows:
        changed = t.replace("\n", "") if t is not None and i is not None and zlib.crc32(str(i).encode()) % 2 == 0 else t
        trees[s].append((i, leaf(i, t, l, s, n), leaf(i, changed, l, s, n)))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    made = {}
    for s in order:
        trees[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        made[s] = plain_levels([x[1] for x in trees[s]])
    top = plain_levels([made[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for j, (i, own, other) in enumerate(trees[s]):
            path = plain_path(made[s], j) + plain_path(top, k)
            folded = other
            for left, right in path:
                folded = sha("".join([*left, folded, *right]))
            out.append((i, own, made[s][-1][0], top[-1][0], sha("".join("".join(a + b) for a, b in path)), folded, folded == top[-1][0]))
    return sorted(out, key=repr)


def manifest_of(spark, rows, levels=6):
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return merkle.merkle_manifest(docs, tampered, F.replace("text", F.lit("\n"), F.lit("")), levels)


def test_positions_are_postorder():
    for n in [*range(1, 41), 81, 100, 243]:
        log = []

        def walk(level, index, n=n, log=log):
            if level:
                for child in range(3 * index, min(3 * index + 3, -(-n // 3 ** (level - 1)))):
                    walk(level - 1, child)
            log.append((level, index))

        top = merkle.height(n)
        walk(top, 0)
        assert len(log) == merkle.size(n, top)
        for place, (level, index) in enumerate(log):
            assert merkle.position(level, index, n, top) == place


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_manifest_against_brute_force(spark, levels):
    """Runs of 3, 9 and 729 leaves: up to six strata, trees of one leaf, null and repeated rows."""
    rng = random.Random(levels)
    n = 1600 if levels == 6 else 150
    rows = [(k, rng.choice(["a\nb", "x", None, "", "é\n"]) if k % 3 else f"t\n{k}", rng.choice(["en", None]), "big", k) for k in range(n)]
    rows += [(n + k, f"s{k}\n", "de", rng.choice([None, "", "a", "Ä", "z", "big"]), None) for k in range(60)]
    rows += [(n + 60, "alone\n", "de", "one", 1), (None, "no\nid", "en", "a", 2), (None, None, None, None, None), (3, "again\n", "en", "a", 3), (3, "again\n", "en", "a", 3)]
    out, low, high = manifest_of(spark, rows, levels)
    want = plain_manifest(rows)
    assert sorted((tuple(r) for r in out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=repr) == want
    assert any(not w[-1] for w in want) and any(w[-1] for w in want)
    if levels == 2:
        # One leaf's proof, read from the logs.
        ours = sorted(((r[0], f) for r in [x for x in rows if x[3] == "big"] for f in [sha("".join(map(field, (r[0], r[3], r[2], r[4], r[1]))))]), key=lambda x: x[0])
        levels_of_big = plain_levels([f for _, f in ours])
        for j in (0, 80, len(ours) - 1):
            assert merkle.proof(low, "=big", j) == [("".join(a), "".join(b)) for a, b in plain_path(levels_of_big, j)]
        with pytest.raises(KeyError):
            merkle.proof(low, "=big", 10_000)
        # Runs of the log have their place in the whole tree's postorder.
        firsts = {r.block: r.first for r in low.log(0).where("tree = '=big'").collect()}
        top = merkle.height(len(ours))
        assert all(firsts[b] == merkle.position(0, 9 * b, len(ours), top) for b in firsts)


def test_manifest_notices_any_change(spark):
    rows = [(k, f"line\n{k}", "en", f"s{k % 3}", k) for k in range(30)]
    roots = {manifest_of(spark, r)[0].first().root for r in (rows, rows[:-1], [*rows[:-1], (29, "line\n29", "en", "s2", 30)], [*rows[:-1], (29, "line\n29", None, "s2", 29)])}
    assert len(roots) == 4


# SentencePiece.

PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    return pieces.Codec(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)


def same(both, texts):
    codec, library = both
    for text, (ids, n, decoded) in zip(texts, codec.texts(texts), strict=True):
        want = library.encode(text, add_eos=True)
        assert (ids, n) == (" ".join(map(str, want)), len(want)), text[:100]
        assert decoded == library.decode(want), text[:100]


def test_pieces_of_edges(both):
    same(both, ["", " ", "  ", " a", "  a b", "a  ", "a\nb", "\n\n a", "▁x", "a▁▁ b", "<s>a</s>", "<unk> <0x0A>", "\x00a", "日本 語\U0001f600", "﻿a", "​", "é", "\r\n\t", "٣٤ 123", "  x"])


def test_pieces_of_runs(both):
    """Runs of spaces are pieces of one rank, merged from the left; runs of other characters have ranks of their own."""
    same(both, [a + " " * n + b for n in [*range(1, 70), 500, 5000] for a in ("", "x") for b in ("", "the", "\n")])
    same(both, [c * n for c in "a=-#0é日" for n in (1, 2, 3, 7, 64, 1000)])


@pytest.mark.parametrize("alphabet", ["abcdefghijklmnopqrstuvwxyz", "etaoinshr ", "aab", "=-*#/ ", "0123456789 .,", "abc日本éñ \n", "АаБбВвГгд ", "_()[]{};:<>= \t\n"])
def test_pieces_of_random_texts(both, alphabet):
    rng = random.Random(alphabet)
    same(both, ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 300))) for _ in range(150)])


def test_pieces_whose_merges_cross(both):
    """Texts of pieces that make, with a neighbour, a piece of a lesser rank: such merges come before others of their word."""
    model = both[0].model
    early = [p for p, e in zip(model.pieces, model.early, strict=False) if e]
    rng = random.Random(5)
    assert len(early) > 1000
    same(both, ["".join(rng.choice(early) for _ in range(rng.randint(0, 40))) for _ in range(500)])


def test_pieces_of_long_words_and_memory(both, monkeypatch):
    rng = random.Random(6)
    monkeypatch.setattr(pieces, "MEMO_WORDS", 50)
    monkeypatch.setattr(pieces, "BATCH_CHARS", 1000)
    codec = pieces.Codec(PIECES)
    for _ in range(3):
        same((codec, both[1]), ["".join(rng.choice("abcdefgh") for _ in range(50_000)), " ".join(str(k) for k in range(300)), "x" * 200_000])
    assert codec.encode("hello there") == both[1].encode("hello there", add_eos=True)


def test_decoding_of_any_ids(both):
    codec, library = both
    rng = random.Random(7)
    for _ in range(300):
        ids = [rng.choice([rng.randrange(3, 259), rng.randrange(259, 32_000), 2]) for _ in range(rng.randint(0, 12))]
        assert codec.decode(ids) == library.decode(ids), ids


def test_pieces_of_documents(spark, both, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").unionByName(spark.createDataFrame([(-1, None, None, None, None)], DOCS), allowMissingColumns=True)
    rows = docs.select("doc_id", "text").collect()
    want = set()
    for r in rows:
        ids = both[1].encode(r.text or "", add_eos=True)
        want.add((r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(both[1].decode(ids))))
    assert {tuple(r) for r in pieces.piece_digests(docs, PIECES).collect()} == want
    got = pieces.encoded(docs.select("doc_id", "text", F.lit("z").alias("ids_of")), PIECES)
    assert got.columns == ["doc_id", "ids_of", "ids", "decoded"]
    assert {(r.doc_id, len(r.ids), sha(" ".join(map(str, r.ids))), sha(r.decoded)) for r in got.collect()} == want


def test_other_models_are_refused(tmp_path):
    with open(PIECES, "rb") as f:
        data = f.read()
    at = data.rindex(b"identity")
    (tmp_path / "other.model").write_bytes(data[: at + 8] + data[at + 8 :].replace(b"\x20\x00", b"\x20\x01", 1))
    with pytest.raises(ValueError, match="white space"):
        pieces.Model.read(str(tmp_path / "other.model"))


# Sources.


def plain_divergence(rows, least, top):
    words, df, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, _ in rows:
        lang, source = lang or "", source or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        groups.add((lang, source))
        words[lang, source].update(terms)
        df[lang].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in df[lang].items() if n >= least]
        sources = sorted(s for g, s in groups if g == lang)
        share = lambda counts: {t: 1 + 10**9 * (counts[t] + 5) // (sum(counts[x] for x in kept) + 5 * len(kept)) for t in kept}
        p = {s: share(words[lang, s]) for s in sources}
        q = share(sum((words[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if words[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(found[:most])]
    return sorted(out)


@pytest.mark.parametrize("shard_rows,cells,held", [(500_000, 2_000_000, 1_000_000), (7, 10, 20)])
def test_divergence_against_brute_force(spark, shard_rows, cells, held):
    rng = random.Random(1)
    words = ["the", "The", "cat", "dog", "été", "ÉTÉ", "日本", "x", "y1z", "rare", "tie", "Tie", "a_b", "c-d"]
    rows = [(k, " ".join(rng.choices(words, weights=[5 + (k % 3) * j for j in range(len(words))], k=rng.randint(0, 30))), rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", "", None, "é"]), 0) for k in range(300)]
    rows += [(1000, None, "en", "empty", 0), (1001, "", "xx", "a", 0), (1002, "alone", "xx", "b", 0), (1003, "the\x00the\x7fthe", "en", "a", 0), (1003, "the\x00the\x7fthe", "en", "a", 0), (1004, "long " * 50_000, "en", "a", 0)]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    got = sorted(tuple(r) for r in divergence.source_divergence(docs, 10, 3, shard_rows, cells, held).select("lang", "source", "part", "item", "value", "rank").collect())
    want = plain_divergence(rows, 10, 3)
    assert got == want
    assert {r[:2] for r in got if r[2] == "pair"} >= {("en", "empty"), ("xx", "a"), ("", "")} and any(r[4] == 0 for r in got)


def test_shares_are_exact():
    rng = np.random.default_rng(2)
    n, total = rng.integers(0, 10**14, 2000), rng.integers(1, 9 * 10**15, 2000)
    n = np.minimum(n, np.maximum(total - 5, 0))
    assert divergence.shares(n, total).tolist() == [1 + 10**9 * (a + 5) // t for a, t in zip(n.tolist(), total.tolist(), strict=True)]
