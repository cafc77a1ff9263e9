"""Quality classifier: a byte-level convolutional network in numpy.

Every byte has a learned vector; filters of WIDTH bytes run over the whole text. Their activations are
max-pooled over chunks of 2 * HALF positions that overlap by half and cover the text from end to end,
so a text of any length gives a list of chunk vectors. Their largest, mean and smallest values feed a
small dense layer and one logistic unit: junk anywhere shows in the largest, monotony in the smallest.

Scoring adds up rows of precomputed tables (filter weights times byte vectors), a run of texts at a
time. Training is plain back-propagation with Adam on the driver, over a bounded sample of labelled
rows (:mod:`depreco.llm.samples`), with a fixed seed.

A null text is the empty text; an empty text has one chunk of zeros and gets the score the network
gives that. Rows are scored independently, so repeated rows get equal results; a null id stays null.
Without labels of both values all scores are the share of label 1, or 0.5 without any.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .samples import fold, labelled
from .store import ship
from .words import Texts, blocks

PER_CLASS = {0: 1200, 1: 2400}  # most labelled rows of each label value used for training
FILTERS, WIDTH, VECTOR, HALF, HIDDEN = 16, 6, 8, 128, 16
PAD = 256
CLOSED = np.float32(-1e4)  # table entry that rules out windows which begin past the text's end


class Network(NamedTuple):
    vectors: np.ndarray  # 256 x VECTOR
    filters: np.ndarray  # WIDTH x VECTOR x FILTERS
    bias: np.ndarray  # FILTERS
    dense: np.ndarray  # 3 FILTERS x HIDDEN
    dense_bias: np.ndarray
    out: np.ndarray  # HIDDEN
    out_bias: np.ndarray  # 1


def tables(net: Network) -> np.ndarray:
    """WIDTH x 257 x FILTERS: what a byte at each place of a window adds to each filter."""
    t = np.einsum("bv,wvf->wbf", net.vectors, net.filters).astype(np.float32)
    t[0] += net.bias.astype(np.float32)
    pad = np.zeros((WIDTH, 1, t.shape[2]), np.float32)
    pad[0] = CLOSED
    return np.concatenate([t, pad], axis=1)


def layout(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts, each padded to a whole number of halves, and where each text's halves begin."""
    size = np.diff(texts.at)
    halves = -(-(size + WIDTH) // HALF)
    first = np.concatenate([[0], np.cumsum(halves)])
    code = np.full(first[-1] * HALF + WIDTH, PAD, np.int64)
    into = np.repeat(first[:-1] * HALF - texts.at[:-1], size) + np.arange(len(texts.data))
    code[into] = texts.data
    return code, first


def half_maxima(code: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Largest activation of each filter in each half."""
    n = (len(code) - WIDTH) // HALF
    out = np.empty((n, t.shape[2]), np.float32)
    step = 256
    for lo in range(0, n, step):
        hi = min(n, lo + step)
        at, size = lo * HALF, (hi - lo) * HALF
        total = t[0][code[at : at + size]]
        for j in range(1, WIDTH):
            total += t[j][code[at + j : at + j + size]]
        out[lo:hi] = total.reshape(hi - lo, HALF, -1).max(axis=1)
    return out


def chunk_rows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every chunk the two halves it joins (the same one twice where a text has only one), and where
    each text's chunks begin."""
    halves = np.diff(first)
    chunks = np.maximum(halves - 1, 1)
    begin = np.concatenate([[0], np.cumsum(chunks)])
    left = np.repeat(first[:-1], chunks) + np.arange(begin[-1]) - np.repeat(begin[:-1], chunks)
    right = np.minimum(left + 1, np.repeat(first[1:] - 1, chunks))
    return left, right, begin


def pooled(halves: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple]:
    left, right, begin = chunk_rows(first)
    chunk = np.maximum(np.maximum(halves[left], halves[right]), 0)
    top = np.maximum.reduceat(chunk, begin[:-1])
    low = np.minimum.reduceat(chunk, begin[:-1])
    mean = np.add.reduceat(chunk, begin[:-1]) / np.diff(begin)[:, None]
    return np.concatenate([top, mean, low], axis=1), chunk, (left, right, begin)


def head(net: Network, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hidden = np.maximum(x @ net.dense + net.dense_bias, 0)
    z = hidden @ net.out + net.out_bias[0]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30))), hidden


def score(net: Network, t: np.ndarray, texts: Texts) -> np.ndarray:
    code, first = layout(texts)
    x, _, _ = pooled(half_maxima(code, t), first)
    return head(net, x)[0]


def _start(rng: np.random.Generator) -> Network:
    return Network(
        rng.normal(0, 0.5, (256, VECTOR)), rng.normal(0, (WIDTH * VECTOR) ** -0.5 * 2, (WIDTH, VECTOR, FILTERS)), np.zeros(FILTERS),
        rng.normal(0, 0.2, (3 * FILTERS, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.3, HIDDEN), np.zeros(1),
    )


def _gradients(net: Network, texts: Texts, y: np.ndarray) -> list[np.ndarray]:
    code, first = layout(texts)
    t = tables(net)
    n = first[-1]
    # Forward, with the place of each half's largest activation.
    at = np.empty((n, FILTERS), np.int64)
    halves = np.empty((n, FILTERS), np.float32)
    for lo in range(0, n, 256):
        hi = min(n, lo + 256)
        begin, size = lo * HALF, (hi - lo) * HALF
        act = t[0][code[begin : begin + size]]
        for j in range(1, WIDTH):
            act += t[j][code[begin + j : begin + j + size]]
        act = act.reshape(hi - lo, HALF, FILTERS)
        best = act.argmax(axis=1)
        halves[lo:hi] = np.take_along_axis(act, best[:, None, :], 1)[:, 0]
        at[lo:hi] = best + (np.arange(lo, hi) * HALF)[:, None]
    x, chunk, (left, right, begin) = pooled(halves, first)
    p, hidden = head(net, x)
    # Backward.
    dz = (p - y) / len(y)
    d_out, d_out_bias = hidden.T @ dz, np.array([dz.sum()])
    dh = np.outer(dz, net.out) * (hidden > 0)
    d_dense, d_dense_bias = x.T @ dh, dh.sum(0)
    dx = dh @ net.dense.T
    d_top, d_mean, d_low = dx[:, :FILTERS], dx[:, FILTERS : 2 * FILTERS], dx[:, 2 * FILTERS :]
    count = np.diff(begin)
    owner = np.repeat(np.arange(len(count)), count)
    d_chunk = (d_mean / count[:, None])[owner]
    for best, d in ((x[:, :FILTERS], d_top), (x[:, 2 * FILTERS :], d_low)):
        hit = chunk == best[owner]
        share = np.add.reduceat(hit, begin[:-1])
        d_chunk += hit * (d / share)[owner]
    d_chunk *= chunk > 0
    from_left = halves[left] >= halves[right]
    d_half = np.zeros_like(halves, dtype=float)
    np.add.at(d_half, left, d_chunk * from_left)
    np.add.at(d_half, right, d_chunk * ~from_left)
    d_table = np.zeros((WIDTH, 257, FILTERS))
    filters = np.broadcast_to(np.arange(FILTERS), at.shape)
    for j in range(WIDTH):
        np.add.at(d_table[j], (code[at + j], filters), d_half)
    d_table = d_table[:, :256]
    d_vectors = np.einsum("wbf,wvf->bv", d_table, net.filters)
    d_filters = np.einsum("wbf,bv->wvf", d_table, net.vectors)
    return [d_vectors, d_filters, d_half.sum(0), d_dense, d_dense_bias, d_out, d_out_bias]


def fit(rows: list[tuple[str, int]], epochs: int = 14, batch: int = 48, rate: float = 0.01, seed: int = 5) -> Network:
    rng = np.random.default_rng(seed)
    net = _start(rng)
    y = np.array([v for _, v in rows], float)
    if not len(y) or y.min() == y.max():
        share = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
        return net._replace(out=np.zeros(HIDDEN), out_bias=np.array([np.log(share / (1 - share))]))
    # Texts of like length share a batch, so a batch's work is bounded by its bytes.
    column = pa.array([t for t, _ in rows], pa.string())
    m = [np.zeros_like(a) for a in net]
    v = [np.zeros_like(a) for a in net]
    step, total = 0, epochs * -(-len(rows) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for lo in range(0, len(rows), batch):
            pick = order[lo : lo + batch]
            part = column.take(pa.array(pick))
            (_, _, texts), *more = blocks(part, 1 << 40)
            assert not more
            g = _gradients(net, texts, y[pick])
            step += 1
            now = rate * (1 - step / (total + 1)) ** 0.5
            moved = []
            for k, (a, d) in enumerate(zip(net, g, strict=True)):
                m[k] = 0.9 * m[k] + 0.1 * d
                v[k] = 0.999 * v[k] + 0.001 * d * d
                moved.append(a - now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8))
            net = Network(*moved)
    return net


def train(docs: DataFrame, labels: DataFrame, per_class: dict[int, int] = PER_CLASS) -> Network:
    return fit(labelled(docs, labels, "quality", per_class))


def quality_scores(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row; one pass, no shuffle."""
    ship(docs.sparkSession)
    t = tables(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, texts in blocks(batch.column(2)):
                p = score(net, t, texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (fold(id_col) == 1).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def quality_filter(docs: DataFrame, net: Network, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score is at least ``least``, all columns unchanged."""
    ship(docs.sparkSession)
    t = tables(net)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, texts in blocks(batch.column(at)):
                yield batch.slice(lo, hi - lo).filter(pa.array(score(net, t, texts) >= least))

    return docs.mapInArrow(run, docs.schema)
