"""The corpus operators on small tables, against brute force, the tokenizer library and edge cases."""

from __future__ import annotations

import random
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from depreco.llm import bpe_count, decontaminate, hyperminhash, licenses, line_dedup, mixing, near_dedup, quality_cnn, quality_rules, text_stats, toxicity, url_rules
from depreco.llm import words as W
from depreco.llm.components import components
from depreco.llm.store import Scratch

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"
ODD = [None, "", " \t\n", "one", "one two three four", "a b c d e", "A B C D E", "x\u00a0y\x0b\x0cz", "\u4f60\u597d \u0130stanbul \u03a3\u03a3", "*** $$$ ||| <>", "\n\n\n", "w " * 5000]


def docs_of(spark, texts, ids=None, sources=None):
    n = len(texts)
    rows = [((ids or range(n))[i], texts[i], "en", (sources or ["s"] * n)[i], len(texts[i] or "")) for i in range(n)]
    return spark.createDataFrame(rows, DOCS)


def words_of(rng, n, size=400):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


@pytest.fixture(scope="module")
def copies():
    """Texts with exact copies, near copies around the threshold, chains and short texts."""
    rng = random.Random(3)
    out = list(ODD)
    for n in (4, 6, 9, 20, 60, 150, 230, 400):
        base = words_of(rng, n)
        out += [" ".join(base)] * 2
        for edits in (1, 2, 3, 5, 9):
            new = list(base)
            for _ in range(edits):
                new[rng.randrange(n)] = f"e{rng.randrange(10**6)}"
            out.append(" ".join(new))
            base = new if rng.random() < 0.5 else base  # some form chains
    return out


# --- helpers -------------------------------------------------------------------------------------


def test_words_and_shingles_match_brute_force():
    texts = ODD + ["Tail word", "  lead"]
    found = []
    for lo, hi, block in W.blocks(pa.array(texts), limit=16):
        found += [len(s) for s in W.shingle_sets(block)]
        w = W.words(block)
        for i in range(lo, hi):
            k = i - lo
            raw = [block.data[a:b].tobytes().decode() for a, b in zip(w.start[w.first[k] : w.first[k + 1]], w.end[w.first[k] : w.first[k + 1]], strict=True)]
            assert raw == brute.words(texts[i], lower=False)
    assert found == [len(brute.shingle_set(t)) for t in texts]


def test_registers_estimate_similarity_without_bias():
    rng = np.random.default_rng(1)
    for n in (120, 1000):
        errors = []
        for _ in range(60):
            shared, a, b = (rng.integers(0, 2**64, m, dtype=np.uint64) for m in (n, n // 6, n // 6))
            x, y = (np.unique(np.concatenate([shared, z])) for z in (a, b))
            true = n / (n + n // 6 * 2)
            for (way, r), (_, s) in zip(hyperminhash.registers(x), hyperminhash.registers(y), strict=True):
                errors.append(hyperminhash.jaccard_estimate(r, s) - true)
                assert set(hyperminhash.band_keys(way, r)) & set(hyperminhash.band_keys(way, s))
        assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_every_similar_size_pair_shares_a_way():
    for b in range(1, 600):
        for a in range(-(-3 * b // 4), b + 1):
            assert b <= hyperminhash.EVERY_MAX or a >= hyperminhash.SPLIT_MIN, (a, b)


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(100, 120)]
    star = [(7, i) for i in range(8, 40)]
    links = spark.createDataFrame([*chain, *star, (7, 7), (60, 50), (50, 60), (8, 7)], "a long, b long")
    got = {r.node: r.label for r in components(links, Scratch(spark)).collect()}
    assert got == {**{i: 100 for i in range(100, 121)}, **{i: 7 for i in range(7, 40)}, 50: 50, 60: 50}
    assert components(links.limit(0), Scratch(spark)).count() == 0


# --- 1 -------------------------------------------------------------------------------------------


def test_near_duplicates_match_brute_force(spark, copies):
    docs = docs_of(spark, copies, ids=list(range(100, 100 + len(copies))))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(docs).collect()}
    assert got == brute.near_duplicates([(100 + i, t) for i, t in enumerate(copies)])


def test_hot_copies_and_empty_texts_meet_their_classes(spark, copies):
    """A third of all rows one text, a third without words; some of either have null ids."""
    n = len(copies)
    texts = copies + [copies[-1]] * n + ["", None, " "] * (n // 3)
    ids = [*range(100, 100 + 2 * n - 2), None, None, *range(900, 900 + 3 * (n // 3) - 2), None, None]
    docs = docs_of(spark, texts, ids=ids).repartition(6)
    found = near_dedup.near_duplicates(docs).collect()
    assert len(found) == len(texts)
    want = brute.near_duplicates([(i, t) for i, t in zip(ids, texts, strict=True) if i is not None])
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found if r.doc_id is not None} == want
    assert all(r.component_id is None and r.kept for r in found if r.doc_id is None)
    # in the join of all rows only the classes' own side is small
    assert sum(r.component_id == want[100 + n - 1][1] for r in found) > n


def test_near_duplicates_in_cut_buckets(spark, copies, monkeypatch):
    """Buckets larger than a cell, blocks and request batches give the same result."""
    rng = random.Random(5)
    base = words_of(rng, 80, 10**6)
    texts = []
    for i in range(120):  # one large group around the threshold
        new = list(base)
        for j in rng.sample(range(80), 1 + i % 4):
            new[j] = f"e{i}_{j}"
        texts.append(" ".join(new))
    want = brute.near_duplicates(list(enumerate(texts)))
    assert len({c for _, c, _ in want.values()}) < 120
    monkeypatch.setattr(near_dedup, "CELL", 16)
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    monkeypatch.setattr(near_dedup, "REQUESTS", 4)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(docs_of(spark, texts)).collect()}
    assert got == want


def test_near_duplicates_edge_rows(spark):
    t = " ".join(f"v{i}" for i in range(30))
    docs = docs_of(spark, [t, t, t, None, "", t], ids=[5, 5, None, 6, 7, 3]).withColumn("rep", F.lit(1)).withColumn("key", F.lit("x")).withColumn("bl", F.lit(2))
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_dedup.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(5, 3, False), (5, 3, False), (None, None, True), (6, 6, True), (7, 7, True), (3, 3, True)], key=str)
    left = near_dedup.deduplicate(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted([3, 6, 7, None], key=str)
    assert near_dedup.near_duplicates(docs.limit(0)).count() == 0
    twice = docs_of(spark, [t, t, "an other text", t], ids=[4, 4, 4, 2])
    assert sorted(tuple(r)[:2] for r in near_dedup.deduplicate(twice).collect()) == [(2, t), (4, "an other text")]


# --- 2 -------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary():
    from public_tokenizers import path

    return str(path("word_bpe_49k.json"))


def test_token_counts_match_the_library(vocabulary):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary)
    with open(vocabulary, "rb") as f:
        counter = bpe_count.Counter(f.read())
    rng = random.Random(8)
    alphabet = "abcdeé\u0301ßÇÀ İΣς你好🙂12٣ⅷ'’.,!? \t\n\u00a0\u2003\u1680\x1c\x85<|>#ﬁÅ가각ก"
    texts = [t or "" for t in ODD] + ["don't we'll I'M it's", "a<|endoftext|>b<|startoftext|><|endoftext|>", "<|endoftext", "x" * 5000, "ab" * 3000 + "!", unicodedata.normalize("NFD", "Éléphant ñandú Å")]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(1500)]
    for t in texts:
        assert counter.count(t) == len(library.encode(t, add_special_tokens=False).ids), repr(t)


def test_token_counts_of_documents(spark, vocabulary):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r for r in bpe_count.token_counts(docs, vocabulary).collect()}
    for r in docs.collect():
        n = len(library.encode(r.text, add_special_tokens=False).ids)
        assert tuple(got[r.doc_id]) == (r.doc_id, len(r.text.encode()), n, n > 2048)
    odd = bpe_count.token_counts(docs_of(spark, [None, ""], ids=[1, None]), vocabulary).collect()
    assert [tuple(r) for r in odd] == [(1, 0, 0, False), (None, 0, 0, False)]
    assert bpe_count.token_counts(docs.limit(0), vocabulary).count() == 0


# --- 3, 5, 6 -------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def labelled_docs(spark):
    d = "/root/testdata/sf0.1"
    return spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")


@pytest.fixture(scope="module")
def network(labelled_docs):
    return quality_cnn.train(*labelled_docs)


def held_out(result, labels, label):
    from depreco.llm.samples import fold

    return result.join(labels.filter(fold() == 1), "doc_id").select("doc_id", label, *[c for c in result.columns if c != "doc_id"]).toPandas()


def test_classifier_on_held_out_labels(spark, labelled_docs, network):
    docs, labels = labelled_docs
    got = held_out(quality_cnn.quality_scores(docs, network), labels, "quality")
    assert got.held_out.all() and got.score.between(0, 1).all()
    assert ((got.score >= 0.5) == got.predicted).all()
    assert (got.predicted == got.quality).mean() > 0.98
    assert got.predicted[got.quality == 1].mean() > 0.99


def test_classifier_edges(spark, network):
    long = "Ordinary words of a sentence that goes on. " * 20_000
    docs = docs_of(spark, [None, "", "é" * 3, long, long], ids=[1, None, 3, 4, 4]).withColumn("score", F.lit("clash")).withColumn("held_out", F.lit(0))
    got = quality_cnn.quality_scores(docs, network).collect()
    assert len(got) == 5 and got[0].score == got[1].score and got[3].score == got[4].score
    assert all(0 <= r.score <= 1 for r in got)
    kept = quality_cnn.quality_filter(docs, network)
    assert kept.schema == docs.schema and kept.count() == sum(r.score >= 0.5 for r in got)
    assert quality_cnn.quality_scores(docs.limit(0), network).count() == 0
    none = quality_cnn.train(docs, spark.createDataFrame([], LABELS))
    assert quality_cnn.quality_scores(docs, none).filter("score = 0.5").count() == 5


def test_chunks_cover_every_byte(network):
    """Moving a marked passage anywhere in a text changes the pooled activations there."""
    t = quality_cnn.tables(network)
    for n in (1, 127, 128, 129, 500):
        text = W.Texts(np.frombuffer(b"a" * n, np.uint8), np.array([0, n]))
        code, first = quality_cnn.layout(text)
        left, right, begin = quality_cnn.chunk_rows(first)
        assert set(left) | set(right) == set(range(first[-1])) and first[-1] * quality_cnn.HALF >= n
        slow = [sum(t[j][code[p + j]] for j in range(quality_cnn.WIDTH)) for p in range(n)]
        assert np.allclose(quality_cnn.half_maxima(code, t).max(0), np.max(slow, axis=0), atol=1e-4)


def test_base_counts_match_brute_force():
    texts = ODD + ["a b c a b c a b", "l\nl\n\nl \nl", "#*$%&|<> é#", "x x x x x", "same\r\nsame\r\nother"]
    names = [text_stats.COUNTS.index(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    got = []
    for _, _, block in W.blocks(pa.array(texts), limit=40):
        got += [tuple(int(x) for x in r) for r in text_stats.counts(block)[:, names]]
    assert got == [brute.base_counts(t) for t in texts]


def test_quality_rules(spark, labelled_docs):
    docs, labels = labelled_docs
    trees = quality_rules.train(docs, labels)
    got = held_out(quality_rules.quality_rules(docs, trees), labels, "quality")
    assert ((got.n_words < 50) | (100 * got.n_repeat_words > 50 * got.n_words)).eq(got.base_failed).all()
    passed = got[~got.base_failed]
    assert (passed.kept == passed.quality).mean() > 0.98 and passed.kept[passed.quality == 1].mean() > 0.99
    assert not got.kept[got.base_failed].any()
    texts = dict(docs.select("doc_id", "text").limit(300).collect())
    small = quality_rules.quality_rules(docs.filter(F.col("doc_id").isin(list(texts))), trees).collect()
    for r in small:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.base_counts(texts[r.doc_id])
    # Monotone: raising a constrained feature never raises the score.
    x = quality_rules.features(quality_rules.stats_of(list(texts.values())))
    for f in np.flatnonzero(quality_rules.TREND == -1):
        last = np.full(len(x), np.inf)
        for v in np.linspace(0, 1, 30):
            now = x.copy()
            now[:, f] = v
            p = quality_rules.predict(trees, now)
            assert (p <= last + 1e-12).all()
            last = p
    edge = quality_rules.quality_rules(docs_of(spark, [None, ""], ids=[None, 2]).withColumn("kept", F.lit(9)), trees).collect()
    assert all(r.base_failed and not r.kept and r.n_words == 0 for r in edge)


def test_toxicity(spark, labelled_docs):
    docs, labels = labelled_docs
    model = toxicity.train(docs, labels)
    assert (np.diff(model.cuts) > 0).all()
    got = held_out(toxicity.toxicity(docs, model), labels.filter("quality = 1").drop("toxic"), "quality")
    known = {r.doc_id: r.toxic for r in labels.collect()}
    truth = got.doc_id.map(known)
    assert got.toxic[truth == 1].mean() > 0.9
    assert got.toxic[truth == 0].mean() < 0.005
    assert got.severity.between(0, toxicity.GRADES - 1).all()
    p = toxicity.probabilities(model.cuts, np.linspace(-5, 40, 50))
    assert np.allclose(p.sum(1), 1) and (np.diff(p @ np.arange(toxicity.GRADES)) >= 0).all()
    edge = toxicity.toxicity(docs_of(spark, [None, "", "idiot scum trash moron"], ids=[None, 2, 3]).withColumn("grade", F.lit("c")), model).collect()
    assert [r.toxic for r in edge] == [False, False, True] and edge[0].severity == edge[1].severity
    none = toxicity.train(docs, spark.createDataFrame([], LABELS))
    assert toxicity.toxicity(docs_of(spark, ["idiot"]), none).first().toxic is False


# --- 4 -------------------------------------------------------------------------------------------


def test_mix_meets_targets(spark):
    rng = random.Random(4)
    texts = [" ".join(words_of(rng, rng.randrange(1, 60))) for _ in range(600)]
    sources = [rng.choice(["b", "a", "a", "a", None, "c", "\u00e9"]) for _ in texts]
    docs = docs_of(spark, texts, sources=sources)
    got = mixing.mix_sources(docs).toPandas()
    size = got["size"]
    assert (size == [len(brute.words(texts[i])) for i in got.doc_id]).all()
    assert (got.taken == got.epochs * size).all() and (got.taken <= 2 * size).all()
    per = got.assign(source=got.source.fillna("~")).groupby("source").agg(size=("size", "sum"), source_size=("source_size", "first"), target=("target", "first"), taken=("taken", "sum"))
    assert (per["size"] == per.source_size).all()
    assert abs(per.target.sum() - 1.5 * per["size"].sum()) < 1e-6 and (per.target <= 2 * per["size"] + 1e-9).all()
    assert ((per.taken - per.target).abs() <= 30).all()  # half a document
    # Weights 3, 1, 2 by code point, null last; shares hold where the cap doesn't.
    order = ["a", "b", "c", "\u00e9", "~"]
    rate = [per.target[s] / w for s, w in zip(order, [3, 1, 2, 3, 1], strict=True)]
    free = [r for s, r in zip(order, rate, strict=True) if per.target[s] < 2 * per["size"][s] - 1e-9]
    assert free and max(free) - min(free) < 1e-6 and all(r <= max(free) + 1e-9 for r in rate)
    again = mixing.mix_sources(docs.repartition(7)).toPandas()
    assert sorted(zip(got.doc_id, got.taken, strict=True)) == sorted(zip(again.doc_id, again.taken, strict=True))


def test_mix_edges(spark):
    docs = docs_of(spark, [None, "", "a b c", "a b c", "d"], ids=[1, 2, 3, 3, None], sources=["x", "x", "y", "y", None]).withColumn("size", F.lit("clash")).withColumn("target", F.lit(0))
    got = mixing.mix_sources(docs).collect()
    assert len(got) == 5 and all(r.taken <= 2 * r["size"] for r in got)
    assert mixing.mix_sources(docs.limit(0)).count() == 0


def test_hot_ids_and_equal_rows_meet_targets(spark, monkeypatch):
    """One id and one whole row, each on a third of a source's rows; long texts among them; reruns agree."""
    monkeypatch.setattr(mixing, "RUN", 16)
    rng = random.Random(8)
    rows = []
    for s in ("a", "b", None):
        rows += [(7, " ".join(words_of(rng, rng.randrange(5, 40))), s) for _ in range(100)]
        rows += [(9, "the very same row of nine words, every time", s)] * 100
        rows += [(1000 + len(rows) + i, " ".join(words_of(rng, 20)), s) for i in range(100)]
    rows += [(1, "long " * 3_000, "long"), (2, "w", "long")]
    docs = spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows], DOCS)
    got = mixing.mix_sources(docs).toPandas()
    assert len(got) == len(rows)
    per = got.assign(source=got.source.fillna("~")).groupby("source").agg(target=("target", "first"), taken=("taken", "sum"))
    assert ((per.taken - per.target).abs().drop("long") <= 20).all()  # half a document
    same = got[(got.doc_id == 9) & (got.source == "b")]
    assert len(same) == 100 and same.epochs.nunique() == 2
    again = mixing.mix_sources(docs.repartition(9)).toPandas()
    key = lambda d: sorted(zip(d.doc_id, d.source.fillna("~"), d["size"], d.taken, strict=True))
    assert key(got) == key(again)


# --- 7 -------------------------------------------------------------------------------------------


def test_tiles_match_brute_force():
    rng = random.Random(6)
    for _ in range(150):
        item = words_of(rng, rng.randrange(0, 25), 12)
        text = words_of(rng, rng.randrange(0, 30), 12)
        if rng.random() < 0.7 and len(item) > 6:
            cut = rng.randrange(3, len(item) - 2)
            text = [*text[:5], *item[cut:], *text[5:9], *item[:cut], *text[9:]]
        h = {w: np.uint64(hash(w) & (2**64 - 1)) for w in {*item, *text}}
        a, b = (np.array([h[w] for w in s], np.uint64) for s in (item, text))
        got = decontaminate.tile(a, b)
        want = brute.tiles(item, text, decontaminate.MIN_TILE)
        assert sum(t[2] for t in got) == sum(t[2] for t in want), (item, text)
        assert sorted(t[2] for t in got) == sorted(t[2] for t in want)


def test_contamination(spark):
    rng = random.Random(9)
    items = [" ".join(words_of(rng, n, 5000)) for n in (20, 30, 40, 3, 12)] + [None, ""]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)] + [(77, items[0])], "item_id long, text string")
    filler = lambda n: " ".join(f"f{rng.randrange(10**6)}" for _ in range(n))
    half = items[1].split()
    moved = " ".join([*half[20:], filler(7), *half[10:20], filler(2), *half[:10]])
    texts = [
        f"{filler(30)} {items[0].upper()}\n{filler(9)}",  # whole
        f"{filler(5)} {moved} {filler(40)}",  # in another order
        f"{filler(9)} {' '.join(items[2].split()[:15])} {filler(9)}",  # 15 of 40 words: below the threshold
        filler(200), None, "", items[3], " ".join(f"{a} {filler(1)}" for a in half),
    ]
    docs = docs_of(spark, texts + [texts[0]], ids=[*range(len(texts)), 0]).withColumn("item_id", F.lit("clash")).withColumn("seed", F.lit(1))
    found = decontaminate.contaminations(docs, bench)
    got = sorted((r.doc_id, r.item_id, r.n_covered) for r in found.collect())
    assert got == sorted([(0, 0, 20), (0, 0, 20), (0, 77, 20), (0, 77, 20), (1, 1, 30), (6, 3, 3)])
    brute_found = set()
    for d, t in enumerate(texts):
        for i, s in enumerate(items):
            ws = brute.words(s)
            if ws and 2 * sum(x[2] for x in brute.tiles(ws, brute.words(t), 4)) >= len(ws):
                brute_found.add((d, i))
    assert {(d, i) for d, i, _ in got if i != 77} == brute_found
    left = decontaminate.decontaminate(docs, bench)
    assert left.schema == docs.schema and sorted(r.doc_id for r in left.collect()) == [2, 3, 4, 5, 7]
    assert decontaminate.contaminations(docs, bench.limit(0)).count() == 0
    assert decontaminate.contaminations(docs.limit(0), bench).count() == 0


# --- 8 -------------------------------------------------------------------------------------------


def judged_by_list(host, path):
    best = None
    for what, of, under in url_rules.RULES:
        if (host == of or host.endswith("." + of)) and path.startswith(under) and (best is None or len(of + under) > len(best[0])):
            best = (of + under, what)
    return best


def test_url_parts_and_fixed_rules(spark):
    urls = [
        "https://www.Example.COM/en/a?x=1#t", "http://example.com/en/", "http://example.com/en", "https://a.net/es/1", "https://net/fr/x", "http://x.network/es/",
        "https://b.com", "https://b.com?x=/en/", "ftp://User@Host.NET:80/fr/#a?b", "no scheme/com/", None, "", "a://b://c/d", "://com/", "http://example.com/en/x?y://z",
    ]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string").withColumn("host", F.lit(1)).withColumn("verdict", F.lit(2))
    got = {r.page_id: r for r in url_rules.judge(pages).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        u = u or ""
        rest = u.split("://", 1)[1] if "://" in u else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, tail = rest[:cut].translate(brute._FOLD), rest[cut:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
        assert (got[i].host, got[i].path) == (host, path), u
        best = judged_by_list(host, path)
        assert got[i].rule == (best[0] if best else None)
        assert not best or got[i].verdict == best[1]
        assert got[i].verdict in ("allow", "block")
    assert url_rules.judge(pages.limit(0)).count() == 0


def test_mined_url_rules_match_brute_force(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    support, confidence = 0.02, 0.8
    got = url_rules.judge(pages, support=support, confidence=confidence).collect()
    rows = url_rules.parts(pages).select("page_id", url_rules.tokens(F.col("host"), F.col("path"), F.col("rest")).alias("items")).collect()
    items = {r.page_id: frozenset(r["items"]) for r in rows}
    judged = [(items[r.page_id], r.verdict) for r in got if r.rule]

    def grown(rest, have, n):
        """Itemsets that at least ``support`` of the judged URLs share, with their holders."""
        for i, t in enumerate(rest):
            held = [j for j in n if t in judged[j][0]]
            if len(held) >= support * len(judged):
                yield have | {t}, held
                yield from grown(rest[i + 1 :], have | {t}, held)

    rules = []
    for need, held in grown(sorted({t for s, _ in judged for t in s}), frozenset(), range(len(judged))):
        for v in ("allow", "block"):
            both = sum(judged[j][1] == v for j in held)
            if both >= support * len(judged) and both >= confidence * len(held):
                rules.append((need, v, both / len(held), both / len(judged)))
    assert rules
    for r in got:
        if not r.rule:
            fits = [x for x in rules if x[0] <= items[r.page_id]]
            best = min(fits, key=lambda x: (-x[2], -len(x[0]), -x[3], x[1] != "block", sorted(x[0])), default=None)
            assert r.verdict == (best[1] if best else "allow")
            assert r.mined == (sorted(best[0]) if best else None)


@pytest.mark.parametrize("copies", [1, 40])
def test_a_long_judged_url_is_a_few_items(spark, copies):
    """60 tokens of one URL, alone and on a third of the rows; URLs that share some of its tokens follow its verdict."""
    names = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60)]
    urls = ["https://a.example.com/en/" + "/".join(names)] * copies  # blocked by the list
    urls += [f"https://www.example.com/en/{c}" for c in "abcdefghijklmnopqrst"] * 4  # allowed
    open_ = ["ftp://b.example.org/" + "/".join(names[:17]), "ftp://b.example.org/" + names[59], "ftp://b.example.org/none"]
    got = url_rules.judge(spark.createDataFrame(list(enumerate(urls + open_)), "page_id long, url string")).collect()
    by_id = {r.page_id: r for r in got}
    n = len(urls)
    assert len(got) == n + 3 and (by_id[0].verdict, by_id[copies].verdict) == ("block", "allow")
    assert by_id[n].verdict == "block" and by_id[n].mined == ["h:example", *sorted(f"p:{w}" for w in names[:17])]
    assert by_id[n + 1].verdict == "block" and by_id[n + 1].mined == ["h:example", f"p:{names[59]}"]


def test_tokens_of_the_same_urls_share_an_item(spark):
    sets = [["a", "b", "c"], ["a", "b"], ["d"], ["a", "b", "c"], ["c", "d"]]
    judged = spark.createDataFrame([(s, "allow") for s in sets], "items array<string>, verdict string")
    got = {r.token: r.item for r in url_rules.items_of(judged).collect()}
    assert got == {"a": "a", "b": "a", "c": "c", "d": "d"}


# --- 9, 10 ---------------------------------------------------------------------------------------


def test_line_dedup_matches_brute_force(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "a", "b", None]), "\n".join(rng.choice(["menu", " menu\t", "foot", "", "  ", f"own {i}", "rare"]) for _ in range(rng.randrange(1, 7)))) for i in range(200)]
    rows += [("a", None), ("a", ""), ("solo", "menu\nx"), ("b", "menu"), ("b", "menu")]
    docs = docs_of(spark, [t for _, t in rows], sources=[h for h, _ in rows]).withColumn("host", F.lit("clash")).withColumn("lines", F.lit(1)).withColumn("kept", F.lit(0))
    found = line_dedup.line_dedup(docs, percent=10, least_pages=3).collect()
    got = {r["row"].doc_id: (r.text, r.n_lines, r.n_dropped) for r in found}
    want = brute.line_dedup(rows, 10, 3)
    whole = {r["row"].doc_id for r in found if r.left_whole}
    assert whole and all(not got[i][2] for i in whole)
    assert [got[i] for i in range(len(rows))] == want
    assert any(n for _, _, n in want)
    assert line_dedup.line_dedup(docs.limit(0)).count() == 0


def test_lines_of_two_pages_and_of_just_the_ratio(spark):
    """Two pages are enough to repeat a line; a line on just the bound of pages stays; long texts are taken whole."""
    rows = [("two", "foot\na"), ("two", "foot\nb")]
    rows += [("even", f"own {i}" + ("\nat" if i < 10 else "") + ("\nover" if i < 11 else "")) for i in range(100)]
    rows += [("long", "\n".join(f"line {i}" for i in range(40_000)) + "\nfoot"), ("long", "x\nfoot")]
    docs = docs_of(spark, [t for _, t in rows], sources=[h for h, _ in rows])
    got = {r["row"].doc_id: (r.text, r.n_lines, r.n_dropped) for r in line_dedup.line_dedup(docs, percent=10).collect()}
    assert [got[i] for i in range(len(rows))] == brute.line_dedup(rows, 10, 2)
    assert got[0][0] == "a" and got[2][0] == "own 0\nat" and got[102][1:] == (40_001, 1)


def test_license_scan(spark):
    filler = lambda n, s: " ".join(f"f{s}x{i}" for i in range(n))
    texts = [
        f"{filler(333, 1)}\nLicensed under the Apache License, Version 2.0.", "All rights RESERVED!", "all rights were reserved", None, "",
        f"{filler(50, 2)} Permission is hereby granted, free of charge, to any person obtaining some copy of this software and associated documentation files. {filler(9, 3)} released under the MIT-License",
        "licensed under cc by-nc 4 0", filler(400, 4),
    ]
    docs = docs_of(spark, [*texts, texts[1]], ids=[*range(len(texts)), 1]).withColumn("license", F.lit("clash")).withColumn("k", F.lit(0))
    got = {(r.doc_id, r.license): (r.n_shingles, r.n_found) for r in licenses.licenses(docs).collect()}
    assert got == {(0, "Apache-2.0"): (4, 4), (1, "All-Rights-Reserved"): (1, 1), (5, "MIT"): (1, 1), (6, "CC-BY-NC-4.0"): (3, 3)}
    assert licenses.licenses(docs.limit(0)).count() == 0
