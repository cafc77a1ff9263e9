"""Operator 11: the gram bound against every edit, whole results against a slow version."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import brute
from depreco.llm import spelling as S


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def slow_groups(n: dict[str, int], times: int = 2) -> dict[str, tuple]:
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= times * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (n[w], len(near[w]), form[w], n[form[w]] if form[w] else None, root)
    return out


def slow_words(rows, drop_every=97) -> Counter:
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(brute._FOLD)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % drop_every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                found[run] += 1
    return found


def edits(rng, word, letters):
    i, c = rng.randrange(len(word) + 1), rng.choice(letters)
    kind = rng.randrange(3)
    return word[:i] + c + word[i:] if kind == 0 else word[: max(0, i - 1)] + word[i:] if kind == 1 else word[: max(0, i - 1)] + c + word[i:]


def dictionary(words, least):
    found = Counter(w[p : p + q] for w in words for q in range(S.QMIN, S.QMAX) for p in range(len(w) - q + 1))
    return {g: n for g, n in found.items() if n > least}


@pytest.mark.parametrize(("letters", "least"), [("ab", 3), ("ab", 40), ("abc", 0), ("abcde", 5), ("abcdefghij", 2), ("abcde", 10**6)])
def test_every_pair_one_edit_apart_shares_a_list(letters, least):
    rng = random.Random(least)
    words = ["".join(rng.choices(letters, k=rng.randrange(5, 22))) for _ in range(150)]
    frequent = dictionary(words, least)
    tried = 0
    for _ in range(8000):
        a = rng.choice(words)
        b = edits(rng, a, letters)
        if len(b) < 5 or a == b:
            continue
        a, b = sorted((a, b), key=lambda w: (len(w), w))
        tried += 1
        assert set(S.keys(a, frequent, 5)[0]) & set(S.keys(b, frequent, 5)[1]), (a, b)
    assert tried > 4000


def test_bound_leaves_a_gram_and_counts_what_edits_change():
    rng = random.Random(7)
    for _ in range(1500):
        words = ["".join(rng.choices("abc", k=rng.randrange(5, 15))) for _ in range(12)]
        frequent = dictionary(words, rng.choice([0, 2, 6]))
        a = words[0]
        longest = S.longest_gram(len(a))
        grams = S.cut(a, longest, frequent)
        bound = S.affected(grams, len(a), longest)
        assert bound < len(grams) and grams[0][0] == 0 and grams[-1][1] == len(a)
        i, c = rng.randrange(len(a)), rng.choice("abcd")
        b = a[:i] + c + a[i + 1 :]
        if b != a:
            kept = {(p, a[p:e]) for p, e in grams} & {(p, b[p:e]) for p, e in S.cut(b, longest, frequent)}
            assert len(grams) - len(kept) <= bound


def test_lists_of_common_grams_are_not_read():
    words = [f"{c}{d}ment" for c in "bcdfg" for d in "aeiou"]
    frequent = dictionary(words, 10)
    for w in words:
        found = S.probes(w, S.longest_gram(len(w)), frequent)
        assert len(found) < len(S.cut(w, S.longest_gram(len(w)), frequent)) + 1
        assert [frequent.get(g, 0) for _, _, g in found] == sorted(frequent.get(g, 0) for _, _, g in found)


@pytest.mark.parametrize("least", [100, 4])
def test_groups_match_the_slow_version(spark, monkeypatch, least):
    monkeypatch.setattr(S, "FREQUENT", least)
    rng = random.Random(11)
    n: dict[str, int] = {}
    for _ in range(120):
        w = "".join(rng.choices(["ba", "en", "ti", "on", "s", "é", "aa"], k=rng.randrange(3, 7)))
        for _ in range(4):
            if len(w) >= 5:
                n[w] = rng.choice([1, 2, 3, 4, 6, 12, 50])
            w = edits(rng, w, "abenté")
    n |= {"x" * 4000: 3, "x" * 4001: 9, "x" * 2000 + "y" + "x" * 1999: 4}
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    got = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in S.spelling_groups(words).collect()}
    want = slow_groups(n)
    assert got == want
    assert any(v[4] != v[2] and v[2] for v in want.values()) and any(v[1] > 3 for v in want.values())


def test_words_match_the_slow_version(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows += [(None, None), (5, ""), (None, "Encore ENCORE encore Étude étude"), (7, "word" * 30_000), (7, "repeat repeat"), (7, "repeat repeat"), (8, "İstanbul naïve x×y Łukasz")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("word", "run", "h", "id", "n")})
    got = {r.word: r.n for r in S.word_counts(S.occurrences(docs, drop_every=5), 1).collect()}
    assert got == slow_words(rows, 5)
    assert {r.word: r.n for r in S.word_counts(S.occurrences(docs)).collect()} == {w: n for w, n in slow_words(rows).items() if n >= 3}


def test_a_long_chain_of_forms_has_one_root(spark):
    rows = [("a" * 30 + "b" * i, 2**i) for i in range(20)]
    got = {r.word: (r.form, r.root) for r in S.spelling_groups(spark.createDataFrame(rows, "word string, n long")).collect()}
    assert {root for _, root in got.values()} == {rows[-1][0]} and got[rows[0][0]][0] == rows[1][0]


def test_equal_counts_take_the_first_in_code_point_order(spark):
    rows = [("abcde", 1), ("abcdz", 2), ("abcdé", 2), ("abcdea", 2), ("zzzzz", 5), (None, 3), ("abc", 9)]
    got = {r.word: r for r in S.spelling_groups(spark.createDataFrame(rows, "word string, n long")).collect()}
    assert set(got) == {"abcde", "abcdz", "abcdé", "abcdea", "zzzzz"}
    assert (got["abcde"].form, got["abcde"].n_near, got["abcdz"].form, got["zzzzz"].n_near) == ("abcdea", 3, None, 0)


def test_empty_words_and_clashing_columns(spark):
    words = spark.createDataFrame([("abcde", 1), ("abcdef", 2)], "word string, n long").withColumns({c: F.lit("x") for c in ("key", "a", "b", "n_a", "letters", "first", "form", "root")})
    assert {r.word: r.form for r in S.spelling_groups(words).collect()} == {"abcde": "abcdef", "abcdef": None}
    assert S.spelling_groups(words.limit(0)).count() == 0
    with pytest.raises(ValueError):
        S.spelling_groups(words, least_length=4)
