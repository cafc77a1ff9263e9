"""Near-duplicate detection with HyperMinHash registers, banding and verification on full sets.

A text's set holds the hashes of its distinct five-word shingles (lower-cased words; a text of one to
four words has its whole sequence as its only shingle; a text without words, or a null, has none and
is linked with nothing). Two texts are linked when ``100 * |A & B| >= 75 * |A | B|``.

1. ``sketches``: one pass over the texts gives each row its set size, a 128-bit fingerprint of its set
   and its HyperMinHash registers (:mod:`depreco.llm.hyperminhash`). Rows with equal sets form a class
   before anything else, so exact copies, however many, count once from here on.
2. ``crowded``: bands of four registers are counted per bucket (partial aggregates) and only buckets
   that hold two classes or more go on.
3. Star links: each class against the smallest class of each of its buckets, after the
   collision-corrected estimate. Verified links give components.
4. Cross links: in buckets that still hold several components, all pairs between *different*
   components, so a large group of copies, joined in step 3, costs nothing here. Registers are
   compared inside a task, in cells of bounded size: a larger bucket is cut into blocks and each pair
   of blocks is a cell. A pair that shares several bands is taken in the first only, so the candidates
   that are gathered for a class in a block are at most the classes of that block.
5. ``verify``: every pair that passes the estimate is checked on the full sets. The sets of
   about 256 classes with common bucket mates travel as a block, and each other class's set is sent
   once to each block it has candidates in; blocks with many requests are replicated over salts.

Joins with texts, sets, registers or band rows are sort-merge joins whatever their size: those tables
grow with the corpus, so none of them may be broadcast, and hot keys are split at run time. Classes of copies that hold
a large part of all rows are few by that very size; these alone are broadcast, to their own rows.

No pairs are dropped: bands miss a pair of similarity 0.75 once in four million (see hyperminhash),
and the exact check has the last word.

Texts are compared whole, of any length. Rows with a null id take no part in linking: their component is
null and they are kept. Empty tables give an empty result; other columns are carried or not read. Repeated rows
share their class; ``deduplicate`` keeps one of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import hyperminhash as hmh
from .components import components
from .store import Scratch
from .words import U64, blocks, mix, shingle_sets

SHINGLE_WORDS = 5
PERCENT = 75
HOT_SHARE = 200  # a class of more than 1 / HOT_SHARE of all rows is hot; there are fewer than HOT_SHARE of them
CELL = 2048  # members of a bucket whose registers one task compares with one another
BLOCK = 256  # classes whose sets travel together
REQUESTS = 512  # requests a copy of a block answers

_SKETCH = "doc_id long, text_key long, n_shingles long, f1 long, f2 long, regs binary"


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, texts in blocks(batch.column(1)):
            size, f1, f2, regs = [], [], [], []
            for s in shingle_sets(texts, SHINGLE_WORDS):
                size.append(len(s))
                f1.append(mix(s).sum(dtype=np.uint64))
                f2.append(np.bitwise_xor.reduce(mix(s ^ U64(0x5851F42D4C957F2D))) if len(s) else U64(0))
                regs.append(b"".join(r.tobytes() for _, r in hmh.registers(s)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), pa.array(size, pa.int64()),
                 pa.array(np.array(f1, np.uint64).view(np.int64)), pa.array(np.array(f2, np.uint64).view(np.int64)), pa.array(regs, pa.binary())],
                names=["doc_id", "text_key", "n_shingles", "f1", "f2", "regs"],
            )


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, n_shingles, f1, f2, regs) of each row; regs is empty for an empty set."""
    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"), F.xxhash64(F.col(text_col).cast("string"))).mapInArrow(_sketch, _SKETCH)


def _ways(size: int, regs: bytes) -> list[tuple[int, np.ndarray]]:
    """The registers of a class by way, from the bytes that ``_sketch`` wrote."""
    all_ = np.frombuffer(regs, np.uint16).reshape(-1, hmh.REGISTERS)
    names = ([0] if size <= hmh.EVERY_MAX else []) + ([1] if size >= hmh.SPLIT_MIN else [])
    return list(zip(names, all_, strict=True))


def _band_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 2000):
            part = batch.slice(lo, 2000)
            keys, n = [], []
            for size, regs in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                own = [hmh.band_keys(way, r) for way, r in _ways(size, regs)]
                keys += own
                n.append(sum(map(len, own)))
            cid = np.repeat(part.column(0).to_numpy(), n)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(cid)], names=["key", "cid"])


def crowded(classes: DataFrame) -> DataFrame:
    """(key, cid, rep): the band rows in buckets of two classes or more, with the smallest class."""
    rows = classes.select("cid", "n_shingles", "regs").mapInArrow(_band_rows, "key long, cid long")
    heads = rows.groupBy("key").agg(F.min("cid").alias("rep"), F.count("*").alias("n")).filter("n > 1").drop("n")
    return rows.join(heads.hint("merge"), "key")


def _estimated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x, xn, xr, y, yn, yr = (batch.column(c).to_pylist() for c in ("x", "xn", "xr", "y", "yn", "yr"))
        keep = []
        for i in range(len(x)):
            mine, other = dict(_ways(xn[i], xr[i])), dict(_ways(yn[i], yr[i]))
            keep.append(any(hmh.jaccard_estimate(mine[w], other[w]) >= hmh.LEAST_ESTIMATE for w in mine.keys() & other.keys()))
        yield pa.RecordBatch.from_arrays([batch.column("x"), batch.column("y")], names=["x", "y"]).filter(pa.array(keep, pa.bool_()))


def estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (x, y) whose estimate does not rule the link out."""
    x = classes.select(F.col("cid").alias("x"), F.col("n_shingles").alias("xn"), F.col("regs").alias("xr"))
    y = classes.select(F.col("cid").alias("y"), F.col("n_shingles").alias("yn"), F.col("regs").alias("yr"))
    near = F.expr(f"100 * least(xn, yn) >= {PERCENT} * greatest(xn, yn)")
    return pairs.join(x.hint("merge"), "x").join(y.hint("merge"), "y").filter(near).select("x", "xn", "xr", "y", "yn", "yr").mapInArrow(_estimated, "x long, y long")


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, texts in blocks(batch.column(1)):
            f1, data = [], []
            for s in shingle_sets(texts, SHINGLE_WORDS):
                f1.append(mix(s).sum(dtype=np.uint64))
                data.append(s.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), pa.array(np.array(f1, np.uint64).view(np.int64)), pa.array(data, pa.binary())],
                names=["cid", "f1", "data"],
            )


def full_sets(docs: DataFrame, members: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(cid, data): the whole shingle set of each class in ``members`` (cid, doc_id), once."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = texts.join(members.hint("merge"), "doc_id").select("cid", "text").mapInArrow(_set_rows, "cid long, f1 long, data binary")
    return rows.filter("cid = f1").select("cid", "data").dropDuplicates(["cid"])


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by block and kind: first the block's sets, then requests, each with its own set."""
    block, known = None, {}
    for batch in batches:
        a, b = [], []
        rows = zip(*(batch.column(c).to_pylist() for c in ("bl", "bc", "salt", "kind", "cid", "ys")), strict=True)
        data = batch.column("data")
        for i, (bl, bc, salt, kind, cid, ys) in enumerate(rows):
            if (bl, bc, salt) != block:
                block, known = (bl, bc, salt), {}
            own = np.frombuffer(data[i].as_buffer(), np.uint64)
            if not kind:
                known[cid] = own.copy()
                continue
            others = [(y, known[y]) for y in ys]
            sizes = np.array([len(s) for _, s in others])
            at = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            every = np.concatenate([s for _, s in others])
            found = own[np.minimum(np.searchsorted(own, every), len(own) - 1)] == every
            both = np.add.reduceat(found.astype(np.int64), at)
            linked = 100 * both >= PERCENT * (sizes + len(own) - both)
            for k in np.flatnonzero(linked):
                a.append(cid)
                b.append(others[k][0])
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def verify(requests: DataFrame, placed: DataFrame, sets: DataFrame) -> DataFrame:
    """The links (a, b) among ``requests`` (x, bl, bc, ys): class x against classes ys of block (bl, bc).

    ``placed`` (cid, bl, bc) says which block a class belongs to."""
    load = requests.groupBy("bl", "bc").agg(F.ceil(F.count("*") / REQUESTS).cast("int").alias("copies"))
    own = placed.join(load, ["bl", "bc"]).join(sets.hint("merge"), "cid")
    own = own.select("bl", "bc", F.explode(F.expr("sequence(0, copies - 1)")).alias("salt"), F.lit(0).alias("kind"), "cid", F.lit(None).cast("array<long>").alias("ys"), "data")
    asked = requests.join(load, ["bl", "bc"]).join(sets.withColumnRenamed("cid", "x").hint("merge"), "x")
    asked = asked.select("bl", "bc", F.expr("cast(pmod(xxhash64(x), copies) as int)").alias("salt"), F.lit(1).alias("kind"), F.col("x").alias("cid"), "ys", "data")
    rows = own.unionByName(asked).repartition("bl", "bc", "salt").sortWithinPartitions("bl", "bc", "salt", "kind")
    return rows.mapInArrow(_answer, "a long, b long")


def _cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (key, cell); gives (x, bl, bc, ys) of pairs of one cell between components."""
    names = ("key", "c0", "c1", "c2", "cid", "label", "bl", "bc", "side", "n_shingles", "regs")
    held: list[tuple] = []

    def requests() -> Iterator[tuple]:
        key, c0, _, _ = held[0][:4]
        cid = np.array([r[4] for r in held])
        label = np.array([r[5] for r in held])
        side = np.array([r[8] for r in held])
        size = np.array([r[9] for r in held])
        ways = [_ways(r[9], r[10]) for r in held]
        way, band = next((w, int(np.flatnonzero(hmh.band_keys(w, regs).view(np.int64) == key)[0])) for w, regs in ways[0] if key in hmh.band_keys(w, regs).view(np.int64))
        regs = np.stack([dict(w)[way] for w in ways])
        keys = hmh.bands(regs)
        for i in range(len(held)):
            # Components that differ; each pair once: from the smaller side, or the larger class.
            other = (label != label[i]) & ((cid < cid[i]) if c0 != 1 else (side > side[i]))
            other &= 100 * np.minimum(size, size[i]) >= PERCENT * np.maximum(size, size[i])
            at = np.flatnonzero(other)
            if band and len(at):
                at = at[~(keys[at, :band] == keys[i, :band]).any(axis=1)]
            if len(at):
                at = at[hmh.jaccard_estimate(regs[at], regs[i]) >= hmh.LEAST_ESTIMATE]
            to: dict[tuple, list[int]] = {}
            for k in at:
                to.setdefault((held[k][6], held[k][7]), []).append(int(cid[k]))
            for (bl, bc), ys in to.items():
                yield int(cid[i]), bl, bc, ys

    def table(found: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], t) for k, t in enumerate(kinds)], names=["x", "bl", "bc", "ys"])

    found: list[tuple] = []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            if held and held[0][:4] != row[:4]:
                found += requests()
                held = []
                if len(found) > 2000:
                    yield table(found)
                    found = []
            held.append(row)
    if held:
        found += requests()
    yield table(found)


def cross_requests(rows: DataFrame, classes: DataFrame, placed: DataFrame) -> DataFrame:
    """(x, bl, bc, ys): candidate pairs between different components in the buckets of ``rows``.

    A bucket of up to CELL members is one cell. A larger one is cut by class into blocks of about
    CELL / 2; the component with the most members there is never compared with itself, so its blocks
    meet the blocks of the rest (cells 1), and the rest's blocks meet one another (cells 0 and 2)."""
    at = rows.select("key", "cid").join(placed, "cid")
    parts = at.groupBy("key", "label").agg(F.count("*").alias("n"))
    heads = parts.groupBy("key").agg(F.sum("n").alias("total"), F.max("n").alias("most"), F.max_by("label", F.struct("n", "label")).alias("major"), F.count("*").alias("kinds"))
    half = CELL // 2
    heads = heads.filter("kinds > 1").select(
        "key", "major", (F.col("total") <= CELL).alias("whole"),
        F.ceil(F.col("most") / half).cast("int").alias("na"), F.ceil((F.col("total") - F.col("most")) / half).cast("int").alias("nm"),
    )
    slot = "cast(pmod(xxhash64(cid), if(label = major, na, nm)) as int)"
    cells = f"""
        case when whole then array(struct(0 as c0, 0 as c1, 0 as c2, 0 as side))
             when label = major then transform(sequence(0, nm - 1), j -> struct(1 as c0, {slot} as c1, j as c2, 1 as side))
             else concat(
                 transform(sequence(0, na - 1), i -> struct(1 as c0, i as c1, {slot} as c2, 0 as side)),
                 transform(sequence(0, nm - 1), j -> struct(if(j = {slot}, 0, 2) as c0, least(j, {slot}) as c1, greatest(j, {slot}) as c2, if(j < {slot}, 1, 0) as side)))
        end"""
    dealt = at.join(heads, "key").select("key", "cid", "label", "bl", "bc", F.expr(f"inline({cells})"))
    dealt = dealt.join(classes.select("cid", "n_shingles", "regs").hint("merge"), "cid").repartition("key", "c0", "c1", "c2").sortWithinPartitions("key", "c0", "c1", "c2", "cid")
    return dealt.mapInArrow(_cross, "x long, bl long, bc int, ys array<long>")


def _place(near: DataFrame, labels: DataFrame) -> DataFrame:
    """(cid, label, bl, bc) of each class in ``near``: its component, and the block its set travels in.

    Classes that share their smallest bucket mate lie together, in blocks of about BLOCK classes, so the
    candidates of one class are in few blocks."""
    own = near.groupBy("cid").agg(F.min("rep").alias("bl"))
    size = own.groupBy("bl").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    own = own.join(size, "bl").select("cid", "bl", F.expr("cast(pmod(xxhash64(cid), parts) as int)").alias("bc"))
    return own.join(labels.withColumnRenamed("node", "cid"), "cid", "left").select("cid", F.coalesce("label", "cid").alias("label"), "bl", "bc")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, text_key) for each row of ``docs``.

    ``text_key`` is the text's 64-bit hash. ``component_id`` is the smallest id among the rows reachable over links, the row itself included;
    ``kept`` says that it is the row's own id. A null id gives a null component and is kept."""
    scratch = Scratch(docs.sparkSession)
    rows = scratch.keep(sketches(docs, id_col, text_col))
    named = rows.filter("n_shingles > 0 and doc_id is not null")
    # One row for each class; the smallest id stands for it when its text is needed again.
    first = named.groupBy("f1", "f2").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("regs").alias("regs"), F.count(F.lit(1)).alias("n_rows"))
    classes = scratch.keep(first.withColumnRenamed("f1", "cid"))
    near = scratch.keep(crowded(classes))
    members = scratch.keep(near.select("cid").distinct().join(classes.select("cid", "doc_id"), "cid"))
    sets = scratch.keep(full_sets(docs, members, id_col, text_col))

    stars = estimated(near.filter("cid <> rep").select(F.col("cid").alias("x"), F.col("rep").alias("y")).distinct(), classes)
    alone = members.select("cid", F.col("cid").alias("bl"), F.lit(0).alias("bc"))
    stars = scratch.keep(stars.select("x", F.col("y").alias("bl"), F.lit(0).alias("bc"), F.array("y").alias("ys")))
    links = scratch.keep(verify(stars, alone, sets))
    placed = scratch.keep(_place(near, components(links, scratch)))
    asked = cross_requests(near, classes, placed).groupBy("x", "bl", "bc").agg(F.flatten(F.collect_list("ys")).alias("ys"))
    links = scratch.keep(links.union(verify(scratch.keep(asked), placed, sets)))

    label = components(links, scratch)
    label = classes.select("cid", "doc_id").join(label.withColumnRenamed("node", "cid"), "cid").select("cid", "label", "doc_id")
    smallest = label.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    label = label.join(smallest, "label").select(F.col("cid").alias("f1"), "doc_id", F.col("component_id").alias("linked"))
    own = classes.select(F.col("cid").alias("f1"), "f2", "doc_id", "n_rows").join(label, ["f1", "doc_id"], "left")
    own = scratch.keep(own.select("f1", "f2", "n_rows", F.coalesce("linked", "doc_id").alias("class_id")))
    # Back to the rows. Fewer than HOT_SHARE classes can hold over that part of all rows: their rows meet them where they
    # are. Rows without a set meet none. So no task gets more of the others than a class of that size.
    hot = F.col("n_rows") * HOT_SHARE > rows.count()
    slim = rows.select("doc_id", "text_key", "n_shingles", "f1", "f2").filter("n_shingles > 0")
    large = F.broadcast(own.filter(hot).drop("n_rows"))
    apart = slim.join(large.drop("class_id"), ["f1", "f2"], "left_anti").join(own.filter(~hot).drop("n_rows").hint("merge"), ["f1", "f2"], "left")
    met = slim.join(large, ["f1", "f2"]).unionByName(apart)
    out = met.select("doc_id", "text_key", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("class_id")).alias("component_id"))
    out = out.unionByName(rows.filter("n_shingles = 0").select("doc_id", "text_key", "n_shingles", F.col("doc_id").alias("component_id")))
    return scratch.finish(out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"), "text_key"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept: one of each group of near duplicates, all columns unchanged.

    Repeated rows (equal id and text) count once. Rows with a null id all stay. The texts are shuffled
    once, to meet the slim table of kept rows; dropping repeats needs no further shuffle."""
    found = near_duplicates(docs, id_col, text_col).filter("kept and doc_id is not null")
    found = found.select(F.col("doc_id").alias("_kept_id"), F.col("text_key").alias("_kept_key")).distinct()
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("key"))
    kept = rows.filter("id is not null").join(found.hint("merge"), F.expr("id = _kept_id and key = _kept_key"), "left_semi")
    turn = F.row_number().over(Window.partitionBy("id", "key").orderBy("key"))
    kept = kept.withColumn("turn", turn).filter("turn = 1").select("row.*")
    return kept.unionByName(rows.filter("id is null").select("row.*"))
