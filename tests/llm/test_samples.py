"""Training samples are bounded in rows, not only in ids, and a text's length plays no part in them."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa

import brute
from depreco.llm import quality_cnn, quality_rules, toxicity
from depreco.llm.samples import fold, labelled, picked
from depreco.llm.words import blocks


def test_repeated_ids_give_one_row_each(spark):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1]
    hot = ids[0]
    rows = [(i, f"text {i}") for i in ids] + [(hot, f"hot {k % 50}") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    got = labelled(docs, labels, "quality", {0: 100, 1: 100})
    assert len(got) == len(ids)
    assert {t for t, _ in got} >= {f"text {i}" for i in ids[1:]}
    assert labelled(docs.repartition(3), labels, "quality", {0: 100, 1: 100}) == got
    assert sum(y for _, y in labelled(docs, labels, "quality", {0: 5, 1: 5})) == 5


def learned_ids(n):
    return [i for i in range(3 * n) if zlib.crc32(str(i).encode()) % 3 != 1][:n]


def test_only_long_texts_carry_a_label(spark):
    """Texts of over 64 KB, which alone are bad or toxic, are learned from."""
    ids = learned_ids(40)
    long = " ".join(["idiot scum moron $$$ ### ***"] * 2600)
    fine = " ".join(f"plain word{i}" for i in range(60))
    texts = [(i, long + f" {i}" if k < 12 else f"{fine} {i}") for k, i in enumerate(ids)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(k >= 12), int(k < 12)) for k, i in enumerate(ids)], "doc_id long, quality int, toxic int")
    assert len(long) > 65_536 and len(labelled(docs, labels, "quality", {0: 100, 1: 100})) == 40
    trees = quality_rules.train(docs, labels)
    assert {r.doc_id: r.score >= 0.5 for r in quality_rules.quality_rules(docs, trees).collect()} == {i: k >= 12 for k, i in enumerate(ids)}
    model = toxicity.train(docs, labels)
    assert {r.doc_id: r.toxic for r in toxicity.toxicity(docs, model).collect()} == {i: k < 12 for k, i in enumerate(ids)}


def test_the_byte_bound_takes_rows_in_hash_order(spark):
    ids = learned_ids(30)
    docs = spark.createDataFrame([(i, f"{i:04d}" * (1 + k % 5)) for k, i in enumerate(ids)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in ids], "doc_id long, quality int")
    rows = sorted(picked(docs, labels, "quality", {1: 100}).collect(), key=lambda r: (r._place, r._id))
    want, total = [], 0
    for r in rows:
        total += len(r._text)
        want += [r._text] * (total <= 150)
    got = labelled(docs, labels, "quality", {1: 100}, most_bytes=150)
    assert sorted(t for t, _ in got) == sorted(want) and 0 < len(want) < 30 and max(map(len, want)) == 20
    assert labelled(docs, labels, "quality", {1: 100}, most_bytes=3) == []


def test_a_null_id_is_in_some_fold(spark):
    r = spark.createDataFrame([(None,)], "doc_id long").select(fold().alias("f")).first()
    assert r.f == zlib.crc32(b"") % 3
    net = quality_cnn.fit([])
    docs = spark.createDataFrame([(None, "x")], "doc_id long, text string")
    assert quality_cnn.quality_scores(docs, net).first().held_out is not None


def slow_terms(text):
    """Terms of one text in plain Python: runs of ASCII letters and digits or other bytes, and their stems."""
    out, run = [], b""
    for b in [*(text or "").encode(), 32]:
        c = bytes([b])
        if c.isalnum() and b < 128 or b >= 128:
            run += c.lower() if b < 128 else c
        elif run:
            out += [run] + [b"stem " + run[:k] for k in toxicity.STEMS if len(run) > k]
            run = b""
    return out


def test_term_counts_and_chosen_terms_match_a_slow_version(spark):
    rng = np.random.default_rng(4)
    words = ["moron", "morons", "scumbag", "table", "Chair", "été", "x1", "window", "lamp", "a"]
    ids = learned_ids(120)
    texts = [" ".join(rng.choice(words[3:], 6)) + (" " + rng.choice(words[:3]) if k % 3 == 0 else "") for k in range(120)]
    rows = spark.createDataFrame([(i, int(k % 3 == 0), 0, t) for k, (i, t) in enumerate(zip(ids, texts, strict=True))], "_id long, _label int, _place long, _text string").repartition(5)
    code = {}
    for t in {x for t in texts for x in t.split()}:
        (_, _, block), = blocks(pa.array([t]))
        h, _ = toxicity._terms(block)
        code |= dict(zip(slow_terms(t), h.tolist(), strict=True)) if len(slow_terms(t)) == len(h) else {}
    want = {}
    for k, t in enumerate(texts):
        for term in set(slow_terms(t)):
            yes, no = want.get(code[term], (0, 0))
            want[code[term]] = (yes + (k % 3 == 0), no + (k % 3 != 0))
    got = {np.int64(r.term).astype(np.uint64).item(): (r.yes, r.no) for r in toxicity.term_counts(rows).collect()}
    assert got == want
    chosen = set(toxicity.choose_terms(rows).tolist())
    n1, n0 = 40, 80
    for term, (yes, no) in want.items():
        share = (yes + no) / (n1 + n0)
        z = (yes / n1 - no / n0) / np.sqrt(max(share * (1 - share), 1e-9) * (1 / n1 + 1 / n0))
        assert (term in chosen) == (yes >= toxicity.LEAST_TEXTS and z >= toxicity.LEAST_Z and yes >= toxicity.LEAST_SHARE * (yes + no))
    assert code[b"moron"] in chosen or code[b"stem moro"] in chosen
    terms = toxicity.choose_terms(rows)
    sparse = {r._id: dict(zip([terms[c].item() for c in r.cols], r.counts, strict=True)) for r in toxicity.sparse_rows(rows, terms).collect()}
    for i, t in zip(ids, texts, strict=True):
        held = [code[x] for x in slow_terms(t) if code[x] in chosen]
        assert sparse[i] == {h: held.count(h) for h in held}


def test_severity_matches_the_formula(spark):
    """Expected grade of single texts, worked out term by term."""
    terms = ["moron", "scum", "idiot"]
    code = []
    for t in terms:
        (_, _, block), = blocks(pa.array([t]))
        code.append(toxicity._terms(block)[0][0])
    order = np.argsort(code)
    weight, cuts = np.array([1.5, 0.5, 2.0]), np.array([1.0, 2.0, 4.0])
    model = toxicity.Severity(np.array(code)[order], weight[order], cuts)
    texts = ["", "moron", "moron moron scum", "idiot IDIOT idiot table", None]
    got = {r.doc_id: r for r in toxicity.toxicity(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()}
    for i, t in enumerate(texts):
        held = brute.words(t)
        eta = sum(w * (1 + np.log(held.count(x))) for x, w in zip(terms, weight, strict=True) if x in held)
        below = [1 / (1 + np.exp(-(c - eta))) for c in cuts]
        p = np.diff([0, *below, 1])
        assert abs(got[i].severity - (p * np.arange(4)).sum()) < 1e-9 and got[i].grade == p.argmax() and got[i].toxic == (p[0] < 0.5)
