"""The corpus pipeline against a brute-force version, on odd rows, and the queries against their SQL."""

from __future__ import annotations

import os

import brute
import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from depreco.llm import catalog, quality_cnn
from depreco.llm import words as W

SF = "/root/testdata/sf0.001"


def test_stages_are_the_five():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_copies", "benchmarks", "mix"]


def test_pipeline_matches_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [r.asDict() for r in docs.collect()]
    bench = [brute.words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    net = quality_cnn.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    t = quality_cnn.tables(net)
    score = {}
    for lo, hi, block in W.blocks(pa.array([r["text"] for r in rows])):
        score |= dict(zip([r["doc_id"] for r in rows[lo:hi]], quality_cnn.score(net, t, block), strict=True))

    def by_hand(name, rows):
        if name == "quality":
            return [r for r in rows if score[r["doc_id"]] >= 0.5]
        if name == "lines":
            found = brute.near_duplicates([(r["doc_id"], r["text"]) for r in rows])
            out = brute.line_dedup([(r["source"], r["text"]) for r in rows], 1, 2, [found[r["doc_id"]][1] for r in rows])
            return [{**r, "text": text, "n_chars": len(text) if n else r["n_chars"]} for r, (text, _, n) in zip(rows, out, strict=True)]
        if name == "near_copies":
            found = brute.near_duplicates([(r["doc_id"], r["text"]) for r in rows])
            return [r for r in rows if found[r["doc_id"]][2]]
        leaks = lambda r: any(2 * sum(x[2] for x in brute.tiles(b, brute.words(r["text"]), 4)) >= len(b) for b in near(b_of(r)))
        return [r for r in rows if not leaks(r)]

    def b_of(r):
        return set(zip(*[brute.words(r["text"])[k:] for k in range(4)], strict=False))

    def near(grams):  # only items that share a run of four words can be tiled
        return [b for b in bench if any(tuple(b[i : i + 4]) in grams for i in range(len(b) - 3))]

    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = str(tmp_path / name)
        stage(spark, docs, SF).write.parquet(at)
        docs = spark.read.parquet(at)
        rows = by_hand(name, rows)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        key = lambda r: r["doc_id"]
        assert sorted((r.asDict() for r in docs.collect()), key=key) == sorted(rows, key=key), name
    got = corpus_pipeline.run(spark, SF).toPandas()
    assert sorted(got.doc_id) == sorted(r["doc_id"] for r in rows)
    assert (got["size"] == got.doc_id.map({r["doc_id"]: len(brute.words(r["text"])) for r in rows})).all()
    per = got.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), most=("size", "max"))
    assert ((per.taken - per.target).abs() <= per.most / 2 + 1e-6).all()
    assert (got.taken <= 2 * got["size"]).all()


def test_stages_take_odd_rows(spark):
    """Nulls in every column, empty and repeated rows, clashing extra columns, and an empty table."""
    long = "some words to read " * 30_000
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (2, None, "en", None, None), (3, long, None, "a", 1), (3, long, None, "a", 1), (None, "x\ny", "en", "b", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for c in ("row", "host", "lines", "kept", "text_key", "item_id", "size", "place", "score", "id", "_leak"):
        docs = docs.withColumn(c, F.lit("clash"))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "mix":
            assert out.columns == docs.columns, name
        n = out.count()
        assert n == {"quality": n, "lines": 6, "near_copies": 5, "benchmarks": 6, "mix": 6}[name], name
        assert stage(spark, docs.limit(0), SF).count() == 0, name


@pytest.mark.parametrize("name", list(catalog.ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(catalog.ORACLES[name])
    columns = [d[0] for d in want.description]
    df = catalog.QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    clean = lambda v: round(float(v), 6) if isinstance(v, (float, np.floating)) else v
    got = sorted((tuple(clean(r[c]) for c in columns) for r in df.collect()), key=str)
    assert got == sorted((tuple(map(clean, r)) for r in want.fetchall()), key=str)


def test_no_local_checkpoint_in_the_sources():
    folder = os.path.dirname(catalog.__file__)
    for f in os.listdir(folder):
        if f.endswith(".py"):
            with open(f"{folder}/{f}") as source:
                assert "localCheckpoint" not in source.read(), f
