"""Quality rules: gradient-boosted trees over document statistics, behind two fixed base rules.

Statistics are counted over every whole text (:mod:`depreco.llm.text_stats`); the trees are trained on
the driver from the statistics of a bounded sample of labelled rows, counted in tasks, and travel to the tasks
as flat node arrays. Some
trends are fixed by constraint: more symbols, repeated lines, repeated words, shouting marks or capitals
never raise a score.

A null or empty text has no words: all counts are 0 and it fails the base rules. Rows are scored
independently, so repeated rows get equal results; a null id stays null; texts of any length are counted whole; an
empty table gives an empty result. Without usable labels the
trees are empty and every row that passes the base rules is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .boosting import Trees, fit, predict
from .samples import picked
from .store import ship
from .text_stats import COUNTS, counts
from .words import blocks

PER_CLASS = {0: 3000, 1: 6000}  # most labelled rows of each label value used for training
MIN_WORDS = 50
REPEAT_PERCENT = 50

#: (feature, trend): -1 means that a rise never raises the score.
FEATURES = (
    ("symbols", -1), ("repeated_lines", -1), ("repeated_words", -1), ("shouts", -1), ("capitals", -1),
    ("distinct_words", 0), ("word_length", 0), ("digits", 0), ("marks", 0), ("line_length", 0), ("length", 0),
)
TREND = np.array([t for _, t in FEATURES])


def features(stats: np.ndarray) -> np.ndarray:
    """FEATURES from rows of COUNTS."""
    c = {name: stats[:, i].astype(float) for i, name in enumerate(COUNTS)}
    word, char, line = (np.maximum(c[k], 1) for k in ("n_words", "word_chars", "n_lines"))
    return np.stack([
        c["n_symbols"] / char, c["n_dup_lines"] / line, c["n_repeat_words"] / word, c["n_bangs"] / char, c["n_upper"] / char,
        c["n_distinct_words"] / word, c["word_chars"] / word, c["n_digits"] / char, c["n_marks"] / char, c["n_words"] / line, np.log1p(c["n_words"]),
    ], axis=1)


def stats_of(texts: list[str]) -> np.ndarray:
    column = pa.array(texts, pa.string())
    return np.concatenate([counts(t) for _, _, t in blocks(column)] or [np.zeros((0, len(COUNTS)), np.int64)])


def train(docs: DataFrame, labels: DataFrame, per_class: dict[int, int] = PER_CLASS) -> Trees:
    """Trees from the labels. No text comes to the driver, only the counts of each sampled row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, texts in blocks(batch.column(2)):
                made = pa.array(list(counts(texts)), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), made], names=["_id", "_label", "stats"])

    rows = picked(docs, labels, "quality", per_class)
    schema = T.StructType([rows.schema["_id"], rows.schema["_label"], T.StructField("stats", T.ArrayType(T.LongType()))])
    found = sorted(rows.select("_id", "_label", "_text").mapInArrow(run, schema).collect(), key=lambda r: r._id)
    stats = np.array([r.stats for r in found], np.int64).reshape(len(found), len(COUNTS))
    return fit(features(stats), np.array([r._label for r in found], float), TREND)


def quality_rules(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, the counts, score, base_failed, kept) of each row; one pass, no shuffle."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, texts in blocks(batch.column(1)):
                stats = counts(texts)
                col = dict(zip(COUNTS, stats.T, strict=True))
                score = predict(trees, features(stats))
                failed = (col["n_words"] < MIN_WORDS) | (100 * col["n_repeat_words"] > REPEAT_PERCENT * col["n_words"])
                out = [batch.column(0).slice(lo, hi - lo)]
                out += [pa.array(np.ascontiguousarray(col[c])) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
                out += [pa.array(score), pa.array(failed), pa.array(~failed & (score >= 0.5))]
                yield pa.RecordBatch.from_arrays(out, names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score", "base_failed", "kept"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, score double, base_failed boolean, kept boolean")
