"""Operators against brute force, round trips and planted cases."""

import hashlib
import io
import math
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from postlake.llm import decontamination, exact_dedup, html_text, mixing, ngram_join, resampling, token_counts, toxicity, training_order, warc


def table(spark, texts, first=0):
    return spark.createDataFrame([(first + k, t, "s", "en", 0) for k, t in enumerate(texts)], "doc_id long, text string, source string, lang string, n_chars long")


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(texts):
    sets = [shingles(t) for t in texts]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    return [(len(s), c) for s, c in zip(sets, label, strict=True)]


def near_copies():
    rng = np.random.default_rng(3)
    words = [f"w{k}" for k in range(400)]
    texts = [None, "", "  ", "one two", "ONE two", "one two three four five"]
    for _ in range(12):
        base = list(rng.choice(words, size=int(rng.integers(30, 120))))
        for _ in range(int(rng.integers(1, 6))):
            copy = list(base)
            for _ in range(int(rng.integers(0, 5))):
                copy[int(rng.integers(len(copy)))] = "x%d" % rng.integers(1000)
            texts.append(" ".join(copy))
    return texts + [texts[-1]]


@pytest.mark.parametrize("tile_bytes", [1 << 24, 3000])
def test_join_against_brute_force(spark, tile_bytes):
    texts = near_copies()
    got = ngram_join.similar_components(table(spark, texts), tile_bytes=tile_bytes).orderBy("doc_id").collect()
    assert [(r.n_shingles, r.component_id) for r in got] == brute_components(texts)


@pytest.mark.parametrize("tile_bytes", [6000, 40_000])
def test_large_groups_in_small_tiles(spark, tile_bytes):
    """Copies that drift away from one text: neighbours are similar, the ends aren't; tiles hold a few sets each."""
    rng = np.random.default_rng(11)
    texts = []
    for start in range(3):
        words = [f"g{start}x{k}" for k in range(90)]
        for step in range(25):
            texts.append(" ".join(words))
            words[int(rng.integers(90))] = f"new{start}y{step}"
            if step == 12:
                words[20:50] = [f"cut{start}z{k}" for k in range(30)]
    order = rng.permutation(len(texts))
    texts = [texts[k] for k in order]
    got = ngram_join.similar_components(table(spark, texts), tile_bytes=tile_bytes).orderBy("doc_id").collect()
    assert [(r.n_shingles, r.component_id) for r in got] == brute_components(texts)


def test_labels_count_as_connected():
    sets = [np.arange(20, dtype=np.uint64) + np.uint64(k) for k in range(3)]
    assert ngram_join.tree_links([1, 2, 3], sets, [20] * 3, labels=[1, 1, 1]) == []
    assert {frozenset(x) for x in ngram_join.tree_links([1, 2, 3], sets, [20] * 3, labels=[1, 1, 3])} & {frozenset((1, 3)), frozenset((2, 3))}


def test_tree_finds_all_links():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 60, size=int(rng.integers(20, 60))).astype(np.uint64)) for _ in range(60)]
    tree = ngram_join.PrefixTree(sets, np.array([len(s) for s in sets]))
    for k, s in enumerate(sets):
        want = {j for j, o in enumerate(sets) if j != k and 9 * len(np.intersect1d(s, o)) >= 4 * (len(s) + len(o))}
        flags = tree.order != k
        assert {int(tree.order[leaf]) for leaf in tree.partners(s, len(s), flags)} == want


def test_one_row_of_each_component(spark):
    near, other = " ".join(f"w{k}" for k in range(60)), " ".join(f"v{k}" for k in range(60))
    rows = [(1, near), (1, near), (2, near + " end"), (2, other), (None, "start " + near), (None, "null id"), (None, "null id"), (3, None), (3, None), (None, None), (4, other + " end"), (4, near + " stop"), (5, "alone")]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, place int")
    got = ngram_join.one_of_each(docs)
    assert got.columns == docs.columns
    want = [(1, near), (2, other), (None, "null id"), (3, None), (None, None), (5, "alone")]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted(want, key=repr)
    once = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    assert sorted(r.doc_id for r in ngram_join.one_of_each(once).collect())[0] == 1


def test_exact_groups(spark):
    texts = [None, "", "a", "A", "a ", "a", "b" * 5000, "b" * 5000] + ["hot"] * 50 + [f"t{k}" for k in range(200)]
    got = {r.doc_id: r for r in exact_dedup.exact_groups(table(spark, texts), bucket_bytes=200).collect()}
    by = {}
    for k, t in enumerate(texts):
        by.setdefault(t or "", []).append(k)
    for t, ids in by.items():
        for i in ids:
            assert (got[i].keep_id, got[i].group_size, got[i].kept, got[i].text_sha256) == (max(ids), len(ids), i == max(ids), hashlib.sha256(t.encode()).hexdigest())


def test_archives(spark):
    big = "<p>" + "é" * 80 + "</p>"
    rows = [(3, "u", big), (1, None, big), (2, "u\n", None), (4, "u", "small"), (5, "u", "small"), (6, "u", "x" * 300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in warc.read_archives(warc.write_archives(pages)).collect()}
    assert {k: (r.record_type, r.refers_to, r.payload_bytes) for k, r in got.items()} == {
        1: ("response", None, 167), 3: ("revisit", 1, 167), 2: ("response", None, 0), 4: ("response", None, 5), 5: ("response", None, 5), 6: ("response", None, 300)}
    data = warc.archive_bytes_of([(1, "u", "response", b"abc" * 50, hashlib.sha256(b"abc" * 50).hexdigest(), 150, None)] * 3)
    assert [warc.read_record(x)[:2] for x in warc.records(io.BytesIO(data))] == [(1, 150)] * 3
    for broken in (data[:-3], data[:6], data.replace(data[-20:], b"\0" * 20)):
        with pytest.raises(warc.ArchiveError):
            [warc.read_record(x) for x in warc.records(io.BytesIO(broken))]
    with pytest.raises(warc.ArchiveError):
        warc.parse_record(b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <a>\r\nWARC-Date: x\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n")


def test_main_text():
    page = '<html><head><title>t</title></head><body><header><p>top</p></header><nav><ul><li>menu</li></ul></nav><div class="cookie-notice">ok?</div><article><h1>Head &amp; line</h1><p>One  <b>bold</b>\nword.<p>Be.<form>q</form><aside>side</aside><div id="comments"><p>reader</p></div></article><footer>f</footer></body>'
    assert html_text.main_text(page) == "Head & line\nOne bold word.\nBe."
    assert html_text.main_text(None) == html_text.main_text("") == ""


def test_main_text_of_wrapped_pages():
    article = "<article><h1>Title</h1><p>Some words of the article.</p></article>"
    for names in ("layout has-sidebar", "no-sidebar", "widget-area", "page-with-menu"):
        assert html_text.main_text(f'<body><div class="{names}">{article}<div class="sidebar">side</div></div></body>') == "Title\nSome words of the article."
        assert html_text.main_text(f'<body><div class="{names}"><p>Some words of the page.</p></div><div class="ad">buy</div></body>') == "Some words of the page."
    for head in ("<head><title>t</title><body>", "<head><meta charset=x><title>t</title>", "<html><head><style>b{}</style><body class=x>"):
        assert html_text.main_text(head + article) == "Title\nSome words of the article."
    assert html_text.main_text("<head><title>t</title>Plain words.") == "Plain words."
    deep = "<b>" * 12_000 + "<aside>side</aside><nav>menu</nav><script>x</script>"
    assert html_text.main_text(f"<body><article><p>Before.</p><div>{deep}</div><p>After.</p></article>") == "Before.\nAfter."


def test_main_text_by_ratios():
    menu = "".join(f'<div><a href="/{k}">Link {k}</a></div>' for k in range(8))
    plain = "".join(f"<div><span>Item</span> <span>{k}</span></div>" for k in range(8))
    texts = ["A title", *(f"Paragraph {k} has " + "quite a few words " * 12 + "in it." for k in range(4)), "Short.", "The last of them " * 15 + "ends."]
    body = f"<h2>{texts[0]}</h2>" + "".join(f"<p>{t}</p>" for t in texts[1:])
    for page in (f"<body><div>{menu}</div><div>{body}</div><div>{menu}</div></body>", f"{plain}{menu}<div>{body}</div>{menu}{plain}", f"<body>{body}</body>"):
        got = html_text.main_text(page, 0.5).split("\n")
        assert got == texts
        got = html_text.main_text(page).split("\n")
        assert [t for t in got if t in texts] == texts and not any(t.startswith("Link") for t in got)
    alone = "lonely words " * 15 + "end."
    page = f"<body>{plain}<div>{alone}</div>{plain}{menu}{body}</body>"
    assert html_text.main_text(page, 0.5).split("\n") == [alone, *texts] and alone not in html_text.main_text(page, 4.0)
    assert html_text.main_text(f"<body>{menu}<div>{alone}</div><div>Few.</div><div>{alone}</div>{menu}</body>", 0.5).split("\n") == [alone, "Few.", alone]
    assert html_text.threshold([1.0, 1.0, 9.0, 9.0]) == 5.0
    long = "".join(f"<div>{'unmarked block of text ' * 40}</div>" for _ in range(9))
    short = "<article><h1>Title</h1><p>Few <b>words</b>.</p><p>Be.</p></article>"
    assert html_text.main_text(f"<body>{short}{menu}{menu}{long}</body>") == "Title\nFew words.\nBe."
    assert html_text.main_text(f"<body><article>{body}{menu}{menu}</article></body>").split("\n")[: len(texts)] == texts
    assert html_text.main_text(f"<body><article>{body}{menu}{menu}</article></body>", 0.5).split("\n") == texts


def test_permutation_and_shards(spark):
    for n in (1, 2, 7, 1000):
        assert sorted(training_order.permute(np.arange(n), n, 5).tolist()) == list(range(n))
    texts = ["hello world " * 40, None, "", "tail"] + [f"text number {k} " * (k % 9) for k in range(60)]
    out = training_order.training_shards(table(spark, texts), public_tokenizers.path("byte_bpe_50k.tiktoken"), length=32, per_shard=8)
    rows = out.collect()
    folder = rows[0].folder
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    read = list(training_order.read_from(folder, 0, len(rows), 32, 8))
    assert len(read) == len(rows) and all((a == b).all() for a, b in zip(read[5:], training_order.read_from(folder, 5, len(rows) - 5, 32, 8), strict=True))
    encode, end = training_order.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    ordered = sorted(rows, key=lambda r: (r.part, r.seq))
    stream = np.concatenate([read[r.slot][: r.n_tokens] for r in ordered]).tolist()
    want = Counter(tuple([*encode(t or ""), end]) for t in texts)
    have, piece = Counter(), []
    for x in stream:
        piece.append(x)
        if x == end:
            have[tuple(piece)] += 1
            piece = []
    assert have == want


def test_token_counts(spark, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = [None, "", "It's  A\ttest x", "<|endoftext|> a<|startoftext|>b", "é É ΣΑΣ 12345 don't 'S", "çñß ###!! | x", "same", "same"]
    want = token_counts.batch_counter(path)([t or "" for t in texts])
    cache = str(tmp_path / "cache")
    for _ in range(2):
        got = token_counts.token_counts(table(spark, texts), path, cache).orderBy("doc_id").collect()
        assert [r.n_tokens for r in got] == want
        assert [r.n_bytes for r in got] == [len((t or "").encode()) for t in texts]
    assert spark.read.parquet(cache).count() == 6  # distinct contents; null and empty are one


def test_token_counts_of_a_tokenizer_that_keeps_space(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert token_counts.removes_space(public_tokenizers.path("word_bpe_49k.json")) and not token_counts.removes_space(path)
    texts = ["a word  and\n\nmore\ttext", " ", "", "end of it "]
    got = token_counts.token_counts(table(spark, texts), path).orderBy("doc_id").collect()
    assert [r.n_tokens for r in got] == token_counts.batch_counter(path)(texts)


def test_resampling(spark):
    texts = [f"good plain words number {k}" for k in range(60)] + ["bad### stuff### %d###" % k for k in range(20)] + [None, ""]
    labels = spark.createDataFrame([(k, int(k < 60)) for k in range(80)], "doc_id long, quality int")
    got = {r.doc_id: r for r in resampling.importance_resample(table(spark, texts), labels, buckets=300).collect()}
    assert sum(got[k].selected for k in range(60)) >= 58 and not any(got[k].selected for k in range(60, 80))
    keys = spark.createDataFrame([(k, float(k % 7)) for k in range(100)], "id long, key double")
    order = sorted(((k % 7, k) for k in range(100)), reverse=True)
    for k in (1, 13, 50, 99):
        assert resampling.cut_of_largest(keys, k, bins=3, few=4) == order[k - 1]
    assert resampling.cut_of_largest(keys, 100) is None


def test_spelling_models_by_brute_force(spark):
    """Kneser-Ney probabilities from plain counts: the top order by class, lower ones by the different bytes before."""
    texts = [(b"a vile grommish troll troll", True), (b"plain words about weather, vile weather", False), (b"x", True), (b"words", False)]
    counts = toxicity.learn(spark.createDataFrame(texts, "text binary, toxic boolean"))
    model = counts.models()
    order, discount = toxicity.ORDER, toxicity.DISCOUNT
    top, words = Counter(), {}
    for text, toxic in texts:
        for w in re.findall(rb"[a-z]+", text):
            words.setdefault(w, []).append(toxic)
    strings = lambda w, n: [(b"\0" * (n - 1) + w)[k : k + n] for k in range(len(w))]
    for w, kinds in words.items():
        for g in strings(w, order):
            top.update((toxic, g) for toxic in kinds)
    low = Counter(g[1:] for n in range(1, order) for g in {x for w in words for x in strings(w, n + 1)})

    def estimate(counts, g, below):
        after = [c for h, c in counts.items() if len(h) == len(g) and h[:-1] == g[:-1]]
        if not after:
            return below
        return (max(counts[g] - discount, 0) + discount * len(after) * below) / sum(after)

    def log_p(w, toxic):
        total = 0.0
        own = Counter({g: c for (kind, g), c in top.items() if kind == toxic})
        for g in strings(w, order):
            p = 1 / 256
            for n in range(1, order):
                p = estimate(low, g[-n:], p)
            total += math.log(max(estimate(own, g, p), 1e-12))
        return total

    seen = {g[:-1] for g in low if len(g) == 3}  # shared probabilities after a known context sum to one
    for h in sorted(seen)[:5]:
        p = [1 / 256] * 256
        for n in range(1, 4):
            p = [estimate(low, (h + bytes([b]))[-n:], p[b]) for b in range(256)]
        assert sum(p) == pytest.approx(1.0)
    asked = [b"troll", b"weather", b"vile", b"grom", b"unknown", b"x", b"q"]
    want = [log_p(w, True) - log_p(w, False) for w in asked]
    assert model.ratios(asked) == pytest.approx(want)
    joined = {bytes(r.word): r.ratio for r in toxicity.word_ratios(counts, spark.createDataFrame([(w,) for w in asked], "word binary")).collect()}
    assert [joined[w] for w in asked] == pytest.approx(want)


def test_toxicity_by_broadcast_and_by_joins(spark):
    rng = np.random.default_rng(3)
    made = ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(400)]
    texts = [" ".join(rng.choice(made[:300], 12)) + (f" {made[300 + k % 100]}" if k % 5 == 0 else "") for k in range(300)] + [None, "", "..."]
    labels = spark.createDataFrame([(k, int(k % 5 == 0)) for k in range(300)] + [(None, 1), (7, None)], "doc_id long, toxic int")
    docs = table(spark, texts).unionByName(table(spark, texts[:3]))  # repeated rows
    ways = ({}, {"model_strings": 0}, {"broadcast_rows": 0})
    got = [sorted((r.doc_id, r.held_out, round(r.score, 9), r.predicted) for r in toxicity.toxicity_scores(docs, labels, **w).collect()) for w in ways]
    assert got[0] == got[1] == got[2] and len(got[0]) == 306
    assert len({s for k, _, s, _ in got[0] if k >= 300}) == 1


def test_mixing_against_numpy(spark):
    rng = np.random.default_rng(1)
    rows = [(k, "w " * int(rng.integers(1, 9)), f"s{rng.integers(3)}", f"l{rng.integers(2)}", f"t{rng.integers(2)}") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, topic string")
    got = mixing.calibrated(docs, 0.5, temper=0.5, topic_col="topic").collect()
    for c in ("source", "lang", "topic"):
        own, raked = Counter(), Counter()
        for r in got:
            own[r[c]] += r.mix_tokens
            raked[r[c]] += r.mix_tokens * r.mix_rate
        total = sum(own.values())
        goal = {v: (n / total) ** 0.5 for v, n in own.items()}
        for v in own:
            assert raked[v] / total == pytest.approx(goal[v] / sum(goal.values()), abs=1e-5)
    assert sum(r.mix_tokens * r.mix_probability for r in got) == pytest.approx(0.5 * sum(r.mix_tokens for r in got), rel=1e-6)


def test_contamination_in_blocks(spark):
    items = spark.createDataFrame([(1, "A b c d e f g h i j k"), (10, "short one"), (2, None), (3, "")], "item_id long, text string")
    docs = table(spark, ["x A-b c d e f g h i J k! y", "a short one", None, "a b c d e f g h i", "short, ONE short one"])
    for limit in (1, 1 << 20):
        got = decontamination.contamination(docs, items, broadcast_bytes=limit).orderBy("doc_id").collect()
        assert [(r.n_words, r.n_hit, r.n_items) for r in got] == [(13, 11, 1), (3, 2, 1), (0, 0, 0), (9, 0, 0), (4, 4, 1)]
        assert got[1].items_sha256 == hashlib.sha256(b"10").hexdigest()
    assert [r.text for r in decontamination.decontaminate(docs, items, "spans").orderBy("doc_id").collect()][0] == "x ! y"
    assert [r.doc_id for r in decontamination.decontaminate(docs, items).orderBy("doc_id").collect()] == [2, 3]


def test_token_counts_take_each_stored_digest_once(spark, tmp_path):
    path, cache = public_tokenizers.path("word_bpe_49k.json"), str(tmp_path / "cache")
    docs = table(spark, ["one two", "one two", None, "three"])
    first = token_counts.token_counts(docs, path, cache).orderBy("doc_id").collect()
    twice = spark.read.parquet(cache).collect()
    spark.createDataFrame(twice, "digest binary, n_tokens bigint, tokenizer string").write.mode("append").parquet(cache)
    assert token_counts.token_counts(docs, path, cache).orderBy("doc_id").collect() == first
    assert spark.read.parquet(cache).count() == 2 * len(twice)  # nothing was encoded again


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_token_counts_equal_the_library_on_whole_documents(spark, small, name):
    path = public_tokenizers.path(name)
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    want = dict(zip(texts, token_counts.batch_counter(path)(list(texts.values())), strict=True))
    assert {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs, path).collect()} == want


def test_large_benchmarks_are_joined(spark):
    """Both ways on a benchmark with repeated and null ids and items of many lengths, against a plain search."""
    rng = np.random.default_rng(2)
    words = [f"w{k}" for k in range(30)]
    items = [(None if k % 7 == 0 else k % 20, " ".join(rng.choice(words, int(rng.integers(1, 40))))) for k in range(60)]
    texts = [" ".join(rng.choice(words, 50)) for _ in range(20)] + [f"x {t} y {u}" for (_, t), (_, u) in zip(items, items[1:], strict=False)]
    docs = table(spark, texts)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = []
    for k, t in enumerate(texts):
        own, hit, named = t.split(), set(), set()
        for item, u in items:
            other = u.split()
            n = min(10, len(other))
            for g in {tuple(other[i : i + n]) for i in range(len(other) - n + 1)}:
                for i in range(len(own) - n + 1):
                    if tuple(own[i : i + n]) == g:
                        hit.update(range(i, i + n))
                        named.add(item)
        names = ",".join(sorted(str(i) for i in named if i is not None))
        want.append((k, len(own), len(hit), len(named), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    for limit in (1, 1 << 20):
        got = decontamination.contamination(docs, benchmark, broadcast_bytes=limit).orderBy("doc_id")
        assert [tuple(r) for r in got.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()] == want


def test_exact_groups_of_many_small_rows(spark):
    """A million rows without text: tables are flushed by their ids, and ids may be strings."""
    docs = spark.range(1_000_000).select(F.concat(F.lit("u-"), F.format_string("%07d", "id")).alias("doc_id"), F.when(F.col("id") % 2 == 0, "").alias("text"))
    got = exact_dedup.exact_groups(docs, table_bytes=1 << 20, bucket_bytes=1 << 20)
    row = got.groupBy("keep_id", "group_size", "text_sha256").agg(F.count("*").alias("n"), F.count_if("kept").alias("kept")).collect()
    assert [tuple(r) for r in row] == [("u-0999999", 1_000_000, hashlib.sha256(b"").hexdigest(), 1_000_000, 1)]


@pytest.mark.parametrize("limit", [0, 1000])
def test_importance_weights_by_brute_force(spark, limit):
    """Counts over all texts, add-one smoothing and sums of logs, with and without a broadcast of the target's ids."""
    rng = np.random.default_rng(4)
    words = ["alpha", "beta", "Gamma", "###", "delta", "x1", "a-b"]
    texts = [" ".join(rng.choice(words, int(rng.integers(0, 30)))) for _ in range(60)] + [None, "same same same"]
    good = {k for k in range(0, 60, 3)}
    labels = spark.createDataFrame([(k, int(k in good)) for k in range(0, 60, 2)] + [(k, 1) for k in good] + [(None, 1), (4, None)], "doc_id long, quality int")
    target = {r.doc_id for r in labels.where("quality = 1").collect()}
    buckets = 50

    def parts(text):
        return resampling.features([(text or "").encode()], buckets)[0].tolist()

    counts = np.ones((2, buckets))
    for k, t in enumerate(texts):
        for b in parts(t):
            counts[0][b] += 1
            counts[1][b] += k in target
    logs = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    weights, share = resampling.log_weights(table(spark, texts), labels, buckets=buckets, broadcast_rows=limit)
    assert {r.id: r.log_weight for r in weights.collect()} == pytest.approx({k: sum(logs[b] for b in parts(t)) for k, t in enumerate(texts)})
    known = [r.quality for r in labels.where("quality is not null").collect()]
    assert share == pytest.approx(sum(known) / len(known))


def test_main_text_of_several_containers():
    words = "several words of a paragraph that goes on " * 4 + "end."
    assert html_text.main_text(f"<main><h1>Title</h1><article><p>{words}</p></article></main>") == f"Title\n{words}"
    two = f"<body><article><h1>One</h1><p>{words}</p></article><article><h1>Two</h1><p>{words}</p></article></body>"
    assert html_text.main_text(two) == f"One\n{words}\nTwo\n{words}"
    menu = "".join(f'<div><a href="/{k}">Link {k}</a></div>' for k in range(6))
    assert html_text.main_text(f"<body><div>Home News Sport</div>{menu}<div><p>{words}</p><p>Short.</p></div>{menu}</body>", 0.5) == f"{words}\nShort."
    assert html_text.main_text(f'<article><p>{words}</p><section class="comments"><article class="comment-body"><p>{words}</p></article></section></article>') == words
    assert html_text.main_text(f'<main><article><p>{words}</p></article><div id="comments"><article><p>{words} me</p></article></div></main>') == words
    for name in ("layout with-sidebar", "related-work", "has-menu", "ad-free", "adjacent"):
        assert html_text.main_text(f'<article><p>{words}</p><div class="{name}"><p>Few.</p></div></article>') == f"{words}\nFew."
    for name in ("left-sidebar", "cookie-notice", "adBanner", "x share", "post-comments", "ad_slot-3"):
        assert html_text.main_text(f'<article><p>{words}</p><div class="{name}"><p>Few.</p></div></article>') == words
    deep = "<b>" * 10_001
    assert html_text.main_text(f"<article>{deep}text<nav>MENU LEAK</nav></article>") == "text"


def test_ratios_smoothing_and_threshold_by_brute_force():
    rng = np.random.default_rng(8)
    for n in (1, 2, 9, 60):
        values = rng.gamma(1.0, 20.0, n)
        for sigma in (0.5, 2.0, 4.0):
            got = html_text.smoothed(values.tolist(), sigma)
            reach = math.ceil(3 * sigma)
            for i in range(n):
                w = {j: math.exp(-((i - j) ** 2) / (2 * sigma**2)) for j in range(n) if abs(i - j) <= reach}
                assert got[i] == pytest.approx(sum(w[j] * values[j] for j in w) / sum(w.values()))
        t = html_text.threshold(values.tolist(), 1000)
        if n > 1:
            low, high = values[values < t], values[values >= t]
            assert t == pytest.approx((low.mean() + high.mean()) / 2)
    page = "<body><div><p>ab <b>cd</b> ef</p><p>x<a href=/>link</a></p><ul><li>y</li></ul></div></body>"
    parser = html_text.Lines()
    parser.feed(page)
    parser.close()
    events = re.findall(r"<(/?)(\w+)[^>]*>|([^<]+)", page)
    want, tags, line = [], 0, None
    for end, tag, data in events:  # a block's tag begins a line; tags before a line's first text are that line's
        if tag:
            tags += 1
            if tag in html_text._BLOCK:
                if line:
                    line[1] += tags
                    tags = 0
                line = None
        elif line is None:
            line = [data, tags]
            want.append(line)
            tags = 0
        else:
            line[0] += data
            line[1] += tags
            tags = 0
    assert [(text, n) for _, text, n, _, _ in parser.page_lines()] == [(t.strip(), n) for t, n in want]


@pytest.mark.parametrize("kind", ["pool", "dense", "mixed"])
def test_tree_links_by_brute_force(kind):
    """Components of random sets: unlike ones that share first shingles, ones drawn from few shingles, and near copies."""
    rng = np.random.default_rng(9)
    sets, sizes = [], []
    for k in range(150):
        n = int(rng.integers(1, 70))
        if kind == "pool":
            s = np.concatenate([rng.integers(0, 12, 3), 1000 + rng.integers(0, 1 << 20, n)])
        elif kind == "dense":
            s = rng.integers(0, 60, n)
        else:
            s = sets[int(rng.integers(len(sets)))].copy() if k % 3 and sets else rng.integers(0, 400, n)
            s[rng.random(len(s)) < 0.06] = 500 + k
        sets.append(np.unique(s).astype(np.uint32))
        sizes.append(len(sets[-1]) + int(rng.integers(0, 3)))  # some shingles of no other set
    label = list(range(150))
    for i in range(150):
        for j in range(i):
            if 9 * len(np.intersect1d(sets[i], sets[j])) >= 4 * (sizes[i] + sizes[j]):
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    got = list(range(150))
    links = ngram_join.tree_links(list(range(150)), sets, sizes)
    for i, j in links:
        assert 9 * len(np.intersect1d(sets[i], sets[j])) >= 4 * (sizes[i] + sizes[j])
        a, b = sorted((got[i], got[j]))
        got = [a if x == b else x for x in got]
    assert got == label


def test_join_of_frequent_shingles_and_string_ids(spark, monkeypatch):
    """Shingles past the ranges, groups dealt by keys, and ids that aren't numbers."""
    monkeypatch.setattr(ngram_join, "HOT_DOCUMENTS", 3)
    monkeypatch.setattr(ngram_join, "HOT_IN_CHUNK", 2)
    texts = near_copies() + ["a passage of ten words that very many documents have " + " ".join(f"q{k}x{i}" for i in range(k)) for k in range(30)]
    want = brute_components(texts)
    for tile_bytes in (1 << 22, 4000):
        got = ngram_join.similar_components(table(spark, texts), tile_bytes=tile_bytes).orderBy("doc_id").collect()
        assert [(r.n_shingles, r.component_id) for r in got] == want
    named = table(spark, texts).withColumn("doc_id", F.format_string("u-%03d", "doc_id"))
    got = ngram_join.similar_components(named).orderBy("doc_id").collect()
    assert [(r.n_shingles, r.component_id) for r in got] == [(n, f"u-{c:03d}") for n, c in want]


def rake_plainly(rows, goals, share, sweeps=500):
    """Probabilities of (source, lang, topic, tokens) rows, by raking cells one after the other."""
    cells = Counter()
    for *cell, n in rows:
        cells[tuple(cell)] += n
    total = sum(cells.values())
    weight = {c: n / total for c, n in cells.items()}
    for _ in range(sweeps):
        for d, goal in enumerate(goals):
            held = Counter()
            for c, w in weight.items():
                held[c[d]] += w
            weight = {c: w * goal[c[d]] / held[c[d]] if held[c[d]] > 0 else 0.0 for c, w in weight.items()}
    rate = {c: weight[c] * total / n if n else 1.0 for c, n in cells.items()}
    low, high = 0.0, 1 / min(r for c, r in rate.items() if r > 0 and cells[c])
    for _ in range(200):
        factor = (low + high) / 2
        low, high = (factor, high) if sum(n * min(1.0, rate[c] * factor) for c, n in cells.items()) < share * total else (low, factor)
    return [min(1.0, rate[tuple(cell)] * high) for *cell, _ in rows]


@pytest.mark.parametrize(("share", "cells"), [(0.3, 100_000), (0.9, 100_000), (0.9, 2)])
def test_all_probabilities_of_mixing_by_brute_force(spark, monkeypatch, share, cells):
    """Also with cells raked by sums that are joined, and with rates that the cap of 1 holds down."""
    monkeypatch.setattr(mixing, "ONE_TASK_CELLS", cells)
    rng = np.random.default_rng(6)
    rows = [(k, "w " * int(rng.integers(0, 9)), f"s{rng.integers(3)}", ["x", "y", None][int(rng.integers(3))], f"t{rng.integers(4)}") for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, topic string")
    none = mixing._NONE
    plain = [(s, l or none, t, len(x.split())) for _, x, s, l, t in rows]
    own = [Counter() for _ in range(3)]
    for *cell, n in plain:
        for d in range(3):
            own[d][cell[d]] += n
    total = sum(own[0].values())
    given = {"x": 0.7, "y": 0.2}  # null isn't mentioned: it keeps its share
    langs = {v: given.get(v, n / total) for v, n in own[1].items()}
    goals = [{v: (n / total) ** 0.5 for v, n in own[0].items()}, langs, {v: (n / total) ** 0.5 for v, n in own[2].items()}]
    goals = [{v: g / sum(goal.values()) for v, g in goal.items()} for goal in goals]
    targets = {"lang": spark.createDataFrame(list(given.items()), "lang string, share double")}
    got = mixing.calibrated(docs, share, targets, temper=0.5, topic_col="topic").orderBy("doc_id").collect()
    assert [r.mix_probability for r in got] == pytest.approx(rake_plainly(plain, goals, share), abs=1e-5)
    assert all(r.mix_converged for r in got)
    assert any(r.mix_capped for r in got) == (share == 0.9) and all(r.mix_probability == 1 for r in got if r.mix_capped)
    report = {(r.dimension, r.value): r for r in mixing.mixture(mixing.calibrated(docs, share, targets, temper=0.5, topic_col="topic")).collect()}
    raked = {("lang", None if v == none else v): g for v, g in goals[1].items()} | {("source", v): g for v, g in goals[0].items()}
    assert {k: r.raked_share for k, r in report.items() if k in raked} == pytest.approx(raked, abs=1e-5)
    expected = sum(r.mix_tokens * r.mix_probability for r in got)
    assert report["source", "s1"].expected_share == pytest.approx(sum(r.mix_tokens * r.mix_probability for r in got if r.source == "s1") / expected)


def test_impossible_targets_and_shares(spark):
    impossible = {"source": spark.createDataFrame([("a", 0.5), ("b", 0.5)], "source string, share double"), "lang": spark.createDataFrame([("x", 0.9), ("y", 0.1)], "lang string, share double")}
    two = spark.createDataFrame([(1, "w w", "a", "x"), (2, "w w", "b", "y")], "doc_id long, text string, source string, lang string")
    assert [r.mix_converged for r in mixing.calibrated(two, 0.5, impossible).collect()] == [False, False]
    for share in (0, 1.5):
        with pytest.raises(ValueError, match="share"):
            mixing.calibrated(two, share)
    assert all(r.mix_sampled for r in mixing.calibrated(two, 1.0).collect())



def test_topics_by_brute_force(spark):
    rng = np.random.default_rng(7)
    vocabulary = ["rainfall", "mountain", "harbours", "Symphony", "ordinary", "strasse", "größerer"]
    texts = [" ".join([vocabulary[k % 4]] * int(rng.integers(3, 9)) + list(rng.choice(vocabulary[4:], 3)) + ["short", "x1234567y"]) for k in range(60)] + [None, "", "tiny words"]
    find = lambda t: re.findall(r"[^\x00-\x60\x7B-\x7F]{7,}", (t or "").lower())
    cf, df = Counter(), Counter()
    for t in texts:
        cf.update(find(t))
        df.update(set(find(t)))
    n = len(texts)
    rank = {w: math.log(1 - math.exp(-cf[w] / n)) - math.log(df[w] / n) for w in df if 2 <= df[w] <= 0.5 * n}
    want = sorted(rank, key=lambda w: (-rank[w], w))[:3]
    docs = table(spark, texts)
    assert mixing.topic_words(docs, topics=3, most=0.5) == want
    got = docs.select(mixing.topic_of(F.col("text"), want)).collect()
    assert [r[0] for r in got] == [next((w for w in want if w in find(t)), None) for t in texts]


def test_archives_refuse_what_does_not_fit(spark, tmp_path):
    digest = hashlib.sha256(b"x" * 200).hexdigest()
    whole = warc.record(1, "u", "revisit", b"", digest, 200, 2)
    assert warc.read_record(whole) == (1, 200, digest, "revisit", 2, "u")
    broken = [
        whole.replace(b"Content-Length: 200", b"X-Length: 200"), whole.replace(b"Content-Length: 200", b"Content-Length: -20"), whole.replace(b"Content-Length: 200", "Content-Length: \u00b2\u00b2".encode()[:19]),
        whole.replace(b"WARC-Date", "WARC-D\u00e4te".encode()), whole.replace(b"WARC-Target-URI: u", b"WARC-Target-URI: \xff"), whole.replace(b"WARC-Target-URI: u", b"WARC-Type: response"),
        whole.replace(b"<urn:page:1>", b"<urn:uuid:1>"), whole.replace(b"WARC-Refers-To", b"WARC-Elsewhere"),
    ]
    for data in broken:
        with pytest.raises(warc.ArchiveError):
            warc.read_record(data)
    uri = str(tmp_path / "lone.warc.zst")
    with open(uri, "wb") as f:
        f.write(warc.archive_bytes_of([(1, "u", "revisit", b"", digest, 200, 2)]))
    with pytest.raises(Exception, match="no response with the digest of the revisit 1"):
        warc.read_archives(spark.createDataFrame([(uri, 1)], "uri string, n_records bigint")).collect()


def test_string_ids(spark):
    pages = spark.createDataFrame([("b/1", "u", "p" * 150), ("a none", "u", "p" * 150), (None, "u", "p" * 150), ("none", None, "x")], "page_id string, url string, html string")
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.read_archives(warc.write_archives(pages), "string").collect()}
    assert got == {"a none": ("response", None), "b/1": ("revisit", "a none"), None: ("revisit", "a none"), "none": ("response", None)}
    docs = spark.createDataFrame([("u-1", "one two"), ("u-2", "one two"), (None, "three")], "doc_id string, text string")
    assert {(r.doc_id, r.keep_id, r.kept) for r in exact_dedup.exact_groups(docs).collect()} == {("u-1", "u-2", False), ("u-2", "u-2", True), (None, None, True)}
    rows = training_order.training_shards(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), length=4).collect()
    assert {d for r in rows for d in r.doc_ids} == {"u-1", "u-2", None}


def test_main_text_drops_notices_at_any_length():
    """Reader comments and notices longer than the article; pages without article; comments as articles."""
    long = "<p>" + "a long comment of a reader about it. " * 10 + "</p>"
    body = "<h1>Title</h1><p>short</p>"
    for notice in (f"<div class=comments>{long}{long}</div>", f"<div id=comments>{long}{long}</div>", f'<div class="cookie-notice">{long}</div>', f"<div id=comments><article>{long}</article></div>", f"<form>{long}</form>", f"<noscript>{long}</noscript>"):
        assert html_text.main_text(f"<body><article>{body}{notice}</article></body>") == "Title\nshort"
        assert html_text.main_text(f"<body>{body}{notice}</body>") == "Title\nshort"
    assert html_text.main_text(f"<body><div class=comments>{long}</div></body>") == ""


def test_main_text_in_wrappers_of_any_kind():
    article = "<h1>Title</h1><p>The article has a paragraph of some length, and it goes on.</p><p>And another one of the same kind follows it here.</p>"
    want = html_text.main_text(f"<body><article>{article}</article></body>")
    assert want.count("\n") == 2
    for a, b in (("<form id=aspnetForm>", "</form>"), ("<noscript>", "</noscript>"), ("<dialog open>", "</dialog>"), ("<object>", "</object>"), ("<div class='content-sidebar-wrap'>", "</div>"), ("<form><div class=widget>", "</div></form>")):
        assert html_text.main_text(f"<body>{a}<article>{article}</article>{b}</body>") == want, a
        assert html_text.main_text(f"<body>{a}{article}{b}</body>") == want, a
    assert html_text.main_text("<body><form><label>Name</label><input><label>Word</label></form></body>") == ""


def test_main_text_of_blocks_at_any_depth():
    deep = "<p>" + "<b><i>" * 30 + "A paragraph that is deep in its markup, far below its block." + "</i></b>" * 30 + "</p>"
    shallow = "<p>A paragraph of about the same length that is not deep at all.</p>"
    assert html_text.main_text(f"<body><div class=x>{shallow * 3}{deep}</div></body>").count("\n") == 3


def test_main_text_of_unfinished_tags_in_bounded_time():
    import time

    for page in ("<a href='" * 100_000, "<p>x</p>" + "<a href='" * 50_001 + ">", "<b " * 100_000, "<!--" * 100_000, '<a b="' * 80_001 + "</a>", "<!--" * 100_000 + ">", "</a " * 100_000):
        began = time.time()
        html_text.main_text(page)
        assert time.time() - began < 30, page[:20]
    data = "<img src='data:" + "A" * 100_000 + "'>"
    assert html_text.main_text(f"<article><p>before</p>{data * 40}<p>after</p></article>") == "before\nafter"


def test_second_step_looks_counts_up(spark, tmp_path):
    """A cache that half of the contents are in: the other half is encoded, all counts are the library's."""
    texts = [f"text number {k % 40} of some" for k in range(120)] + [None, ""]
    docs, path, cache = table(spark, texts), public_tokenizers.path("word_bpe_49k.json"), str(tmp_path / "cache")
    token_counts.fill_cache(docs.where("doc_id % 40 < 20"), path, cache)
    assert spark.read.parquet(cache).count() == 21
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs, path, cache).collect()}
    assert got == dict(enumerate(token_counts.batch_counter(path)([t or "" for t in texts])))
    assert spark.read.parquet(cache).count() == 41
