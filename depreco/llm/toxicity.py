"""Toxicity as a severity grade: cumulative-link ordinal regression on sparse word features.

Grades run from 0 (not toxic) to 3. The labels say only toxic or not, so the grades of toxic training
texts are set from the texts: terms that occur in toxic texts far more often than chance allows are
found first, and toxic texts are cut into thirds by how many such terms they hold. The regression
``P(grade <= k) = sigmoid(cut[k] - w . x)`` shares one weight vector ``w`` across the ordered cuts; the
result is the expected grade. Features are ``1 + log(count)`` of each chosen term that a whole text holds.

Terms are runs of ASCII letters and digits or non-ASCII bytes, A-Z folded, and their first 4 to 8
bytes, which stand for a stem with any ending. A null or empty text has no
terms: its severity is that of ``x = 0``. Rows are scored independently, so repeated rows get equal
results; a null id stays null; texts of any length are read whole; an empty table gives an empty result. Without toxic labels no terms are chosen and nothing is flagged.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .samples import picked
from .store import ship
from .words import LOWER, U64, Texts, blocks, mix, words

PER_CLASS = {0: 6000, 1: 3000}  # most labelled rows of each label value used for training
GRADES = 4
LEAST_TEXTS = 4  # toxic training texts that must hold a term
LEAST_Z = 5.0  # standard errors by which a term's share of toxic texts exceeds the rest's
LEAST_SHARE = 0.9  # of the training texts that hold a term, the least share that is toxic
MOST_TERMS = 1000

STEMS = (4, 5, 6, 7, 8)
_STEM = {size: mix(np.array([size], np.uint64)) for size in STEMS}

_BREAKS = np.ones(256, bool)
_BREAKS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


class Severity(NamedTuple):
    terms: np.ndarray  # sorted hashes
    weight: np.ndarray
    cuts: np.ndarray


def _terms(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text index) of every term."""
    w = words(texts, breaks=_BREAKS)
    text = np.repeat(np.arange(len(texts.at) - 1), np.diff(w.first))
    hashes, owners = [w.hash], [text]
    for size in STEMS:
        longer = np.flatnonzero(w.end - w.start > size)
        folded = LOWER[texts.data[w.start[longer, None] + np.arange(size)]].astype(np.uint64)
        hashes.append(mix((folded << (U64(8) * np.arange(size, dtype=np.uint64))).sum(axis=1, dtype=np.uint64) + _STEM[size]))
        owners.append(text[longer])
    return np.concatenate(hashes), np.concatenate(owners)


def _matrix(hashes: np.ndarray, text: np.ndarray, n: int, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows (text, term, count) of the chosen terms."""
    if not len(terms) or not len(hashes):
        none = np.zeros(0, np.int64)
        return none, none, none
    at = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
    hit = terms[at] == hashes
    cell, count = np.unique(text[hit] * len(terms) + at[hit], return_counts=True)
    return cell // len(terms), cell % len(terms), count


def probabilities(cuts: np.ndarray, eta: np.ndarray) -> np.ndarray:
    """P(grade = k) by row for the linear score ``eta``."""
    below = 1 / (1 + np.exp(-np.clip(cuts[None, :] - eta[:, None], -40, 40)))
    edges = np.concatenate([np.zeros((len(eta), 1)), below, np.ones((len(eta), 1))], axis=1)
    return np.diff(edges, axis=1)


def _distinct(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes with each text's repeats left out, and their owners."""
    order = np.lexsort((hashes, owner))
    h, t = hashes[order], owner[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    return h[first], t[first]


def term_counts(rows: DataFrame) -> DataFrame:
    """(term, yes, no): in how many toxic and in how many other texts of the sample each term is.

    Tasks count what they hold, Spark adds the counts up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column(0).to_numpy(zero_copy_only=False) == 1
            for lo, hi, texts in blocks(batch.column(1)):
                terms, owner = _distinct(*_terms(texts))
                known, at = np.unique(terms, return_inverse=True)
                yes = np.bincount(at, toxic[lo:hi][owner], len(known)).astype(np.int64)
                every = np.bincount(at, minlength=len(known))
                yield pa.RecordBatch.from_arrays([pa.array(known.view(np.int64)), pa.array(yes), pa.array(every - yes)], names=["term", "yes", "no"])

    found = rows.select("_label", "_text").mapInArrow(run, "term long, yes long, no long")
    return found.groupBy("term").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))


def choose_terms(rows: DataFrame) -> np.ndarray:
    """Sorted hashes of the terms whose share of toxic texts stands out: the MOST_TERMS best at most."""
    by_label = {r._label: r["count"] for r in rows.groupBy("_label").count().collect()}
    n1, n0 = by_label.get(1, 0), by_label.get(0, 0)
    if not n1 or not n0:
        return np.zeros(0, np.uint64)
    yes, both = F.col("yes"), F.col("yes") + F.col("no")
    share = both / (n1 + n0)
    z = (yes / n1 - F.col("no") / n0) / F.sqrt(F.greatest(share * (1 - share), F.lit(1e-9)) * (1 / n1 + 1 / n0))
    good = term_counts(rows).filter(yes >= LEAST_TEXTS).withColumn("z", z).filter((F.col("z") >= LEAST_Z) & (yes >= LEAST_SHARE * both))
    best = good.orderBy(F.desc("z"), "term").limit(MOST_TERMS).select("term").collect()
    return np.sort(np.array([r.term for r in best], np.int64).view(np.uint64))


def sparse_rows(rows: DataFrame, terms: np.ndarray) -> DataFrame:
    """(_id, _label, cols, counts): which of the chosen terms each text of the sample holds, and how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, texts in blocks(batch.column(2)):
                row, col, count = _matrix(*_terms(texts), hi - lo, terms)
                at = pa.array(np.searchsorted(row, np.arange(hi - lo + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(at, pa.array(x.astype(np.int32))) for x in (col, count)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), *lists], names=["_id", "_label", "cols", "counts"])

    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType([rows.schema["_id"], rows.schema["_label"], T.StructField("cols", ints), T.StructField("counts", ints)])
    return rows.select("_id", "_label", "_text").mapInArrow(run, schema)


def fit(
    terms: np.ndarray, row: np.ndarray, col: np.ndarray, count: np.ndarray, toxic: np.ndarray, steps: int = 300, rate: float = 0.1, decay: float = 1e-4
) -> Severity:
    """The regression from sparse rows (text, term, count) and the texts' labels."""
    if not len(terms):
        return Severity(terms, np.zeros(0), 30.0 + np.arange(GRADES - 1))
    value = 1 + np.log(count)
    n = len(toxic)
    held = np.bincount(row, count, n)
    grade = np.zeros(n, int)
    thirds = np.quantile(held[toxic == 1], [1 / 3, 2 / 3])
    grade[toxic == 1] = 1 + np.searchsorted(thirds, held[toxic == 1], "left")

    # Full-batch Adam on the negative log-likelihood; cuts are kept in order by their log gaps.
    w, first, gaps = np.zeros(len(terms)), 1.0, np.zeros(GRADES - 2)
    state = [np.zeros(len(terms) + 1 + GRADES - 2) for _ in range(2)]
    one_hot = np.eye(GRADES)[grade]
    for step in range(1, steps + 1):
        cuts = first + np.concatenate([[0], np.cumsum(np.exp(gaps))])
        eta = np.bincount(row, value * w[col], n)
        below = 1 / (1 + np.exp(-np.clip(cuts[None, :] - eta[:, None], -40, 40)))
        p = np.maximum((probabilities(cuts, eta) * one_hot).sum(1), 1e-12)
        slope = below * (1 - below)
        # d log p / d cut[k]: the upper cut of the row's grade raises p, the lower one lowers it.
        d_cut = slope * (one_hot[:, :-1] - one_hot[:, 1:]) / p[:, None]
        d_eta = -d_cut.sum(1)
        g_cut = -d_cut.mean(0)
        g_w = -np.bincount(col, value * d_eta[row], len(terms)) / n + decay * w
        g_gap = np.array([g_cut[k + 1 :].sum() for k in range(GRADES - 2)]) * np.exp(gaps)
        g = np.concatenate([g_w, [g_cut.sum()], g_gap])
        state[0] = 0.9 * state[0] + 0.1 * g
        state[1] = 0.999 * state[1] + 0.001 * g * g
        move = rate * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.999**step)) + 1e-8)
        w, first, gaps = w - move[: len(w)], first - move[len(w)], gaps - move[len(w) + 1 :]
    return Severity(terms, w, first + np.concatenate([[0], np.cumsum(np.exp(gaps))]))


def train(docs: DataFrame, labels: DataFrame, per_class: dict[int, int] = PER_CLASS) -> Severity:
    """The model from the labels. No text comes to the driver: terms are counted on Spark, and of each sampled row its
    counts of the chosen terms are collected, at most MOST_TERMS numbers."""
    rows = picked(docs, labels, "toxic", per_class)
    terms = choose_terms(rows)
    found = sorted(sparse_rows(rows, terms).collect(), key=lambda r: r._id) if len(terms) else []
    row = np.repeat(np.arange(len(found)), [len(r.cols) for r in found])
    col, count = (np.array([x for r in found for x in r[c]], np.int64) for c in ("cols", "counts"))
    return fit(terms, row, col, count, np.array([r._label for r in found], int))


def toxicity(docs: DataFrame, model: Severity, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, severity, grade, toxic) of each row: the expected grade, the likeliest one, and whether
    a grade above 0 is likelier than grade 0. One pass, no shuffle."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, texts in blocks(batch.column(1)):
                row, col, count = _matrix(*_terms(texts), hi - lo, model.terms)
                p = probabilities(model.cuts, np.bincount(row, (1 + np.log(count)) * model.weight[col], hi - lo))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(p @ np.arange(GRADES)), pa.array(p.argmax(1), pa.int32()), pa.array(p[:, 0] < 0.5)],
                    names=["doc_id", "severity", "grade", "toxic"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, severity double, grade int, toxic boolean")
