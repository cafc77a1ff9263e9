"""Nulls, empty and very long texts, ties and repeated rows, empty tables and clashing columns; models by slow versions."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers as public
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import brute
from depreco.llm import boosting, bpe_count, decontaminate, licenses, near_dedup, quality_cnn, quality_rules, toxicity, url_rules
from depreco.llm import words as W

DOCS = "doc_id long, text string"
CLASH = ("row", "n", "score", "kept", "grade", "item_id", "n_words", "text_key", "seed", "license", "k", "size", "n_bytes")


def docs_of(spark, rows):
    return spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("clash") for c in CLASH})


def test_whole_scores_of_the_network_match_a_slow_version():
    """From bytes to the probability, window by window and chunk by chunk."""
    rng = np.random.default_rng(1)
    net = quality_cnn._start(rng)
    texts = ["", "a", "x" * 127, "y" * 128, "words and *** words " * 40, "é你" * 100]

    def slow(text):
        data = text.encode()
        half, width = quality_cnn.HALF, quality_cnn.WIDTH
        n = -(-(len(data) + width) // half)
        windows = []
        for p in range(n * half):
            act = net.bias.copy()
            for j in range(width):
                if p + j < len(data):
                    act += net.vectors[data[p + j]] @ net.filters[j]
            windows.append(act if p < len(data) else np.full(quality_cnn.FILTERS, -1e9))
        chunks = [np.maximum(np.max(windows[i * half : (i + 2) * half], axis=0), 0) for i in range(max(1, n - 1))]
        x = np.concatenate([np.max(chunks, 0), np.mean(chunks, 0), np.min(chunks, 0)])
        hidden = np.maximum(x @ net.dense + net.dense_bias, 0)
        return 1 / (1 + np.exp(-(hidden @ net.out + net.out_bias[0])))

    got = [p for _, _, block in W.blocks(pa.array(texts), limit=200) for p in quality_cnn.score(net, quality_cnn.tables(net), block)]
    assert np.allclose(got, [slow(t) for t in texts], atol=1e-5)


def test_gradients_of_all_parameters_are_right():
    rng = np.random.default_rng(2)
    net = quality_cnn._start(rng)
    block = next(W.blocks(pa.array(["some words here " * 30, "x", "other *** words " * 9])))[2]
    y = np.array([1.0, 0.0, 1.0])

    def loss(n):
        code, first = quality_cnn.layout(block)
        p, _ = quality_cnn.head(n, quality_cnn.pooled(quality_cnn.half_maxima(code, quality_cnn.tables(n)), first)[0])
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    got = quality_cnn._gradients(net, block, y)
    for k, name in enumerate(net._fields):
        flat, own = net[k].reshape(-1), got[k].reshape(-1)
        largest = np.argsort(-np.abs(own))[:4]  # byte vectors that no text holds have none
        for i in largest:
            step = np.zeros_like(flat)
            step[i] = 1e-3
            up, down = (net._replace(**{name: (flat + s * step).reshape(net[k].shape)}) for s in (1, -1))
            assert abs((loss(up) - loss(down)) / 2e-3 - own[i]) < 2e-3 + 0.02 * abs(own[i]), name


def test_trees_walked_node_by_node():
    rng = np.random.default_rng(3)
    x = rng.random((400, len(quality_rules.FEATURES)))
    y = (x[:, 0] + x[:, 5] + 0.2 * rng.random(400) > 1.1).astype(float)
    trees = boosting.fit(x, y, quality_rules.TREND)

    def slow(row):
        total = trees.base
        for node in trees.roots:
            while trees.left[node] != node:
                node = trees.left[node] if row[trees.feature[node]] <= trees.threshold[node] else trees.right[node]
            total += trees.value[node]
        return 1 / (1 + np.exp(-total))

    edge = np.concatenate([x, np.where(rng.random((50, x.shape[1])) < 0.3, trees.threshold[trees.roots[0]], rng.random((50, x.shape[1])))])
    assert len(trees.roots) > 5 and np.allclose(boosting.predict(trees, edge), [slow(r) for r in edge])


def test_token_counts_of_long_texts_and_clashing_columns(spark):
    vocabulary = str(public.path("word_bpe_49k.json"))
    library = Tokenizer.from_file(vocabulary)
    long = " ".join(f"Word{i % 977} x" for i in range(20_000))  # over two runs of PIECE_CHARS
    rows = [(1, long), (2, "z" * 70_000), (None, "a b"), (3, None), (3, None)]
    got = bpe_count.token_counts(docs_of(spark, rows), vocabulary).collect()
    assert len(long) > 2 * bpe_count.PIECE_CHARS
    want = sorted((i or 0, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 2048) for r in got)


def test_rules_and_toxicity_on_odd_rows(spark):
    rng = np.random.default_rng(5)
    trees = boosting.fit(rng.random((200, 11)), (rng.random(200) > 0.5).astype(float), quality_rules.TREND)
    long = "some words of a long text\n" * 20_000
    rows = [(1, long), (2, "short"), (2, "short"), (None, None), (3, "")]
    docs = docs_of(spark, rows)
    got = quality_rules.quality_rules(docs, trees).collect()
    assert len(got) == 5 and sorted(r.n_words for r in got) == [0, 0, 1, 1, 120_000]
    assert len({tuple(r) for r in got if r.doc_id == 2}) == 1
    assert [(r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got if r.doc_id == 1] == [brute.base_counts(long)]
    assert quality_rules.quality_rules(docs.limit(0), trees).count() == 0
    (_, _, block), = W.blocks(pa.array(["moron"]))
    model = toxicity.Severity(toxicity._terms(block)[0][:1], np.array([3.0]), np.array([1.0, 2.0, 3.0]))
    got = toxicity.toxicity(docs_of(spark, [*rows, (4, long + "moron"), (4, long + "moron")]), model).collect()
    assert len(got) == 7 and {r.doc_id for r in got if r.toxic} == {4} and len({r.severity for r in got if r.doc_id != 4}) == 1
    assert toxicity.toxicity(docs.limit(0), model).count() == 0
    nothing = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert not len(toxicity.train(docs, nothing).terms) and not len(quality_rules.train(docs.limit(0), nothing).roots)


def test_a_long_text_is_compared_and_tiled_whole(spark):
    rng = random.Random(6)
    filler = lambda n: " ".join(f"f{rng.randrange(10**6)}" for _ in range(n))
    item = filler(30)
    long = f"{filler(60_000)} {item} {filler(10)}"
    docs = docs_of(spark, [(1, long), (2, long + " tail"), (None, long), (3, filler(100)), (4, None)])
    bench = spark.createDataFrame([(7, item), (8, None), (7, item)], "item_id long, text string")
    found = decontaminate.contaminations(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1, 7), (2, 7), (None, 7)}
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(docs).collect()}
    assert got[1] == (len(brute.shingle_set(long)), 1, True) and got[2][1:] == (1, False) and got[None][1:] == (None, True)


def test_licenses_of_long_texts_and_null_ids(spark):
    notice = licenses.TEMPLATES[1][1]
    long = " ".join(f"w{i}" for i in range(30_000)) + " " + notice
    got = licenses.licenses(docs_of(spark, [(None, long), (1, notice), (1, notice), (2, None)])).collect()
    assert sorted((r.doc_id or 0, r.license) for r in got) == [(0, "Apache-2.0"), (1, "Apache-2.0")]


def test_repeated_and_equal_urls_are_judged_alike(spark):
    urls = ["https://a.example.com/en/spam/x"] * 5 + ["https://www.example.com/en/fine/y"] * 5 + ["ftp://q.org/spam"] * 3 + [None, None, ""]
    pages = spark.createDataFrame([(i % 4 or None, u) for i, u in enumerate(urls)], "page_id long, url string").withColumns({c: F.lit("clash") for c in ("items", "token", "item", "need", "own")})
    got = url_rules.judge(pages).collect()
    assert len(got) == len(urls) and len({(r.host, r.path, r.verdict, str(r.mined)) for r in got if r.host == "q.org"}) == 1
    assert {r.verdict for r in got if not r.host} == {"allow"}


def test_items_of_common_words_and_a_full_bitmap_lose_no_pair(spark, monkeypatch):
    """Few words, so seeds are on very many texts and the bitmap lets most runs through; every cover is found."""
    rng = random.Random(9)
    say = lambda n: [f"w{rng.randrange(6)}" for _ in range(n)]
    items = [say(n) for n in (3, 8, 8, 15, 25, 40)]
    texts = [say(rng.randrange(2, 60)) for _ in range(60)]
    for i, item in enumerate(items):  # parts of items, in another order
        for share in (0.4, 0.5, 0.7, 1.0):
            cut = item[: max(1, round(share * len(item)))]
            texts.append([f"x{i}", *cut[len(cut) // 2 :], "y", *cut[: len(cut) // 2], *say(3)])
    monkeypatch.setattr(decontaminate, "BITMAP_BITS", (6, 7))
    docs = docs_of(spark, [(i, " ".join(t)) for i, t in enumerate(texts)]).repartition(5)
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.n_covered for r in decontaminate.contaminations(docs, bench).collect()}
    want = {}
    for d, t in enumerate(texts):
        for i, item in enumerate(items):
            covered = sum(x[2] for x in brute.tiles(item, t, decontaminate.MIN_TILE))
            if 2 * covered >= len(item):
                want[d, i] = covered
    assert got == want and len(want) > 20
