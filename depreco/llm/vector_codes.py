"""Compression of vectors to short codes: one index for each of a vector's parts, by integer arithmetic alone.

Components become integers; each part position has a small codebook, fitted by rounds of assignment and
floored means. The nearest entry is found under an integer Walsh-Hadamard transform of the part and the
entries, both padded with zeros to a power of two: the transform is orthogonal up to its length, so the
sum of squared differences over all coefficients is exactly that length times the squared distance. The
coefficients are summed up in the order of their sequency, the slow ones first, as they hold most of the
difference; an entry whose sum so far exceeds the whole sum of another is dropped. There is no
floating point after the first floor, so results do not hang on the order of rows or on partitions.

A round is one pass over the vectors: each task sums the parts of each entry, Spark adds those sums up, and
the driver holds the codebooks only, whose size is a matter of the parameters and not of the data.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import Scratch

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
BLOCK_ROWS = 4096  # vectors that a task compares with the entries at a time
SALTS = 16  # a label's rows are dealt over so many keys


def sequency_order(length: int) -> np.ndarray:
    """Rows of the Hadamard matrix of that power of two, by their number of sign changes."""
    signs = np.ones((1, 1), np.int64)
    while len(signs) < length:
        signs = np.block([[signs, signs], [signs, -signs]])
    return np.argsort((signs[:, 1:] != signs[:, :-1]).sum(1), kind="stable")


def walsh(rows: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of integer rows padded with zeros, coefficients in the order of their sequency."""
    n, size = rows.shape
    length = 1 << max(0, size - 1).bit_length()
    out = np.zeros((n, length), np.int64)
    out[:, :size] = rows
    half = 1
    while half < length:
        pairs = out.reshape(n, -1, 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(n, length)
        half *= 2
    return out[:, sequency_order(length)]


def nearest(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of each row's nearest entry, ties to the lower index.

    A quarter of the coefficients ranks the entries of each row; the first of them is summed in full. The others
    go on coefficient by coefficient, as long as they can still be nearer, or as near with a lower index."""
    x, e = walsh(rows), walsh(entries)
    length = x.shape[1]
    first = max(1, length // 4)
    sums = ((x[:, None, :first] - e[None, :, :first]) ** 2).sum(2)
    best_at = sums.argmin(1)
    best = sums[np.arange(len(x)), best_at] + ((x[:, first:] - e[best_at, first:]) ** 2).sum(1)

    def alive(sums, row, at):
        return (sums < best[row]) | ((sums == best[row]) & (at < best_at[row]))

    row, at = np.indices(sums.shape).reshape(2, -1)
    left = np.flatnonzero(alive(sums.ravel(), row, at))  # the best itself is not among them: it is no lower than its own index
    left = left[at[left] != best_at[row[left]]]
    row, at, sums = row[left], at[left], sums.ravel()[left]
    for k in range(first, length):
        sums = sums + (x[row, k] - e[at, k]) ** 2
        left = alive(sums, row, at)
        row, at, sums = row[left], at[left], sums[left]
        if not len(row):
            break
    order = np.lexsort((at, sums, row))  # all that are left beat the best
    row, at, sums = row[order], at[order], sums[order]
    heads = np.flatnonzero(np.diff(row, prepend=-1))
    best_at[row[heads]], best[row[heads]] = at[heads], sums[heads]
    return best_at, best // length


def _matrix(column: pa.Array, size: int, parts: int) -> np.ndarray:
    """(vectors, parts, size of a part) from the packed vectors; shorter ones are padded with zeros."""
    out = np.zeros((len(column), parts * size), np.int64)
    for i, packed in enumerate(column):
        own = np.frombuffer(packed.as_buffer(), "<i8")
        out[i, : len(own)] = own
    return out.reshape(len(column), parts, size)


def _assigned(column: pa.Array, books: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each block of rows and each part: (first row, the matrix, indices, distances), both of shape (rows, parts)."""
    parts, _, size = books.shape
    for lo in range(0, len(column), BLOCK_ROWS):
        rows = _matrix(column.slice(lo, BLOCK_ROWS), size, parts)
        found = [nearest(rows[:, p], books[p]) for p in range(parts)]
        yield lo, rows, np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)


def integers(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", scale: int = SCALE) -> DataFrame:
    """(vec_id, label, n, packed): floor(scale * component) as packed 64-bit integers, of every vector that is not
    null and holds no null, NaN or infinity.

    A component so large that a squared distance could leave 64 bits is an error (``ValueError``): up to
    2**62 / (4 * padded length of the whole vector squared) is allowed for its square, some thousands for a thousand components."""
    label = rows.schema[label_col].dataType
    plain = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vec_col).cast("array<double>").alias("vec"))
    plain = plain.filter(F.col("vec").isNotNull() & F.forall("vec", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf")))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            ends = lists.offsets.to_numpy()
            values = np.floor(lists.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]] * scale)
            longest = max(1, int(np.diff(ends).max(initial=0)))
            if len(values) and 4 * np.abs(values).max() ** 2 * (2.0 * longest) ** 2 >= 2.0**62:
                raise ValueError("a component is too large for exact 64-bit distances")
            packed = pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer((8 * (ends - ends[0])).astype(np.int32).tobytes()), pa.py_buffer(values.astype("<i8").tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.diff(ends).astype(np.int64)), packed], names=["vec_id", "label", "n", "packed"])

    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("label", label), T.StructField("n", T.LongType()), T.StructField("packed", T.BinaryType())])
    return plain.mapInArrow(run, schema)


def fit(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (parts, entries, size of a part) of what :func:`integers` gives.

    They begin as the parts of the vectors of the ``entries`` smallest ids (null ids last; of equal ids the smaller vector
    first), fewer if there are fewer vectors. Vectors of unlike or uneven length count as padded with zeros."""
    longest = vectors.agg(F.max("n")).head()[0] or 0
    size = -(-longest // parts)
    first = vectors.orderBy(F.asc_nulls_last("vec_id"), "packed").limit(entries).select("packed").collect()
    books = _matrix(pa.array([bytes(r.packed) for r in first], pa.binary()), size, parts).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        for r in _sums(vectors, books).collect():
            books[r.part, r.entry] = [int(s) // r.n for s in r.sums]
    return books


def _sums(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """(part, entry, n, sums): how many parts each entry is nearest to, and their sums by component."""
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        sums, counts = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            for _, rows, index, _ in _assigned(batch.column(0), books):
                for p in range(len(books)):
                    np.add.at(sums[p], index[:, p], rows[:, p])
                    counts[p] += np.bincount(index[:, p], minlength=len(counts[p]))
        part, entry = np.nonzero(counts)
        made = [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(counts[part, entry]), pa.array(list(sums[part, entry]), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(made, names=["part", "entry", "n", "sums"])

    own = vectors.select("packed").mapInArrow(run, "part int, entry int, n long, sums array<long>")
    total = [F.sum(F.col("sums")[k].cast("decimal(38,0)")) for k in range(books.shape[2])]
    return own.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*total).cast("array<decimal(38,0)>").alias("sums"))


def encode(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error): two hex digits for each part's entry, and the squared distances summed over the parts."""
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, rows, index, distance in _assigned(batch.column(2), shared.value):
                codes = [bytes(x).hex() for x in index.astype(np.uint8)]
                own = batch.slice(lo, len(rows))
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.array(codes, pa.string()), pa.array(distance.sum(1))], names=["vec_id", "label", "code", "error"])

    schema = T.StructType([vectors.schema["vec_id"], vectors.schema["label"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    return vectors.select("vec_id", "label", "packed").mapInArrow(run, schema)


def decode(codes: DataFrame, books: np.ndarray, scale: int = SCALE, id_col: str = "vec_id", code_col: str = "code") -> DataFrame:
    """(vec_id, vector) of each code: its entries laid end to end, divided by ``scale``. A null code gives a null."""
    entries = [F.array(*[F.array(*[F.lit(float(v) / scale) for v in entry]).cast("array<double>") for entry in book]) for book in books]
    parts = [book[F.conv(F.substring(code_col, 2 * p + 1, 2), 16, 10).cast("int")] for p, book in enumerate(entries)]
    return codes.select(F.col(id_col).cast("long").alias("vec_id"), F.when(F.col(code_col).isNotNull(), F.flatten(F.array(*parts))).alias("vector"))


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(
    rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256) of every vector that :func:`integers` keeps.

    ``label_error`` is the error summed over all rows of the label, nulls being one label. Repeated rows are coded and
    summed each; a null id stays null; other columns are not read. No vectors give no rows. The packed vectors are written
    once and read by each round; a label's sum goes back to its rows by a salted key, so a label that most rows
    share is dealt over many tasks."""
    scratch = Scratch(rows.sparkSession)
    vectors = scratch.keep(integers(rows, id_col, vec_col, label_col, scale))
    books = fit(vectors, parts, entries, rounds)
    coded = scratch.keep(encode(vectors, books))
    totals = scratch.keep(coded.groupBy("label").agg(F.sum("error").alias("label_error")))
    salt = F.pmod(F.xxhash64("vec_id", "code", "error"), F.lit(SALTS)).cast("int")
    dealt = totals.select(F.col("label").alias("_label"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    joined = coded.withColumn("salt", salt).join(dealt, F.col("label").eqNullSafe(F.col("_label")) & (F.col("salt") == F.col("_salt")))
    return scratch.finish(joined.select("vec_id", "label", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")))
