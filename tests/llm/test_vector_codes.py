"""Operator 12: the transform and the search against plain arithmetic, whole results against a slow version."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from depreco.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<float>, label int"


def slow(rows, parts=8, entries=16, rounds=6):
    """(vec_id, label, code, error, label_error, sha) in plain Python."""
    kept = [(i, [math.floor(4096 * np.float32(x).item()) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    size = -(-max(len(v) for _, v, _ in kept) // parts)
    kept = [(i, v + [0] * (parts * size - len(v)), label) for i, v, label in kept]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0))[:entries]
    cut = lambda v, p: v[p * size : (p + 1) * size]
    books = [[cut(v, p) for _, v, _ in first] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for _, v, _ in kept:
                groups.setdefault(near(cut(v, p), books[p])[1], []).append(cut(v, p))
            for k, own in groups.items():
                books[p][k] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    out, totals = [], {}
    for i, v, label in kept:
        found = [near(cut(v, p), books[p]) for p in range(parts)]
        out.append((i, label, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
        totals[label] = totals.get(label, 0) + out[-1][3]
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return [(*r, totals[r[1]], sha) for r in out]


def results(df):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[1] is None, r[1] or 0)
    return sorted([(r.vec_id, r.label, r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect()], key=key)


def compare(spark, rows, schema=SCHEMA):
    want = slow(rows)
    got = results(V.compress(spark.createDataFrame(rows, schema).repartition(5)))
    assert got == sorted(want, key=lambda r: (r[0] is None, r[0] or 0, r[2], r[1] is None, r[1] or 0))
    return got


@pytest.mark.parametrize("size", [1, 2, 3, 5, 8, 13, 16])
def test_transform_keeps_distances_and_sequency(size):
    rng = np.random.default_rng(size)
    a, b = rng.integers(-9000, 9000, (2, 40, size))
    length = 1 << max(0, size - 1).bit_length()
    assert (((V.walsh(a) - V.walsh(b)) ** 2).sum(1) == length * ((a - b) ** 2).sum(1)).all()
    signs = V.walsh(np.eye(length, dtype=np.int64)).T
    assert [int((r[1:] != r[:-1]).sum()) for r in signs] == list(range(length))


@pytest.mark.parametrize("size", [1, 3, 8, 16])
def test_nearest_entry_matches_full_search(size):
    rng = np.random.default_rng(size + 1)
    for spread in (2, 50, 9000):  # the small spreads give many ties
        x, e = rng.integers(-spread, spread, (500, size)), rng.integers(-spread, spread, (16, size))
        e[7] = e[3]
        full = ((x[:, None] - e[None]) ** 2).sum(2)
        at, distance = V.nearest(x, e)
        assert (at == full.argmin(1)).all() and (distance == full.min(1)).all()


def test_compress_matches_the_slow_version(spark):
    rng = random.Random(1)
    rows = [(i * 7 % 400, [rng.gauss(0, 1) for _ in range(24)], rng.choice([None, 1, 2, 3])) for i in range(400)]
    assert len({r[2] for r in compare(spark, rows)}) > 50


def test_the_given_table_matches_the_slow_version(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    compare(spark, rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-2, 2) for _ in range(16)], 1) for i in range(20)]
    rows += [(30, None, 1), (31, [1.0, None] * 8, 1), (32, [nan] * 16, 1), (33, [1.0] * 15 + [-inf], 1), (1, rows[1][1], 1), (1, rows[1][1], 1)]
    rows += [(None, [0.5] * 16, None), (40, [], 2), (41, [0.25] * 3, 2), (42, [-1e-9] * 16, 2)]
    got = compare(spark, rows)
    assert len(got) == 26 and {r[0] for r in got}.isdisjoint({30, 31, 32, 33})


def test_few_and_equal_and_uneven_vectors(spark):
    compare(spark, [(2, [0.1] * 13, None), (1, [0.2] * 13, None)])
    compare(spark, [(i, [1.5, -1.5] * 8, i % 2) for i in range(100)])
    compare(spark, [(1, [], 1), (2, [], 1)])


def test_empty_table_and_clashing_columns(spark):
    clash = spark.createDataFrame([(1, [0.5] * 8, 1)], SCHEMA).withColumns({c: F.lit("x") for c in ("n", "vec", "packed", "code", "error", "salt", "label_error")})
    assert V.compress(clash).count() == 1
    assert V.compress(clash.limit(0)).count() == 0
    assert V.compress(clash.withColumn("embedding", F.lit(None).cast("array<float>"))).count() == 0


def test_too_large_components_are_refused(spark):
    with pytest.raises(Exception, match="too large"):
        V.compress(spark.createDataFrame([(1, [1e30] * 8, 1)], SCHEMA)).collect()


def test_decoded_vectors_are_the_entries(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(16)], 0) for i in range(60)]
    vectors = V.integers(spark.createDataFrame(rows, SCHEMA))
    books = V.fit(vectors)
    coded = V.encode(vectors, books)
    got = {r.vec_id: r.vector for r in V.decode(coded, books).collect()}
    errors = {r.vec_id: r.error for r in coded.collect()}
    for i, v, _ in rows:
        own = [math.floor(4096 * np.float32(x).item()) for x in v]
        assert sum((a - round(4096 * b)) ** 2 for a, b in zip(own, got[i], strict=True)) == errors[i]
