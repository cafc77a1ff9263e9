"""Benchmark decontamination by greedy string tiling.

1. ``seeds``: every run of MIN_TILE words of the benchmark items is a seed. Texts are read once; their
   runs pass a bitmap of the seeds first, of about BITMAP_SHARE bits a seed, between two fixed bounds, so it is safe
   to send to every task (beyond the upper one a larger benchmark only lets more runs through). A pair of
   text and item needs a number of shared seeds for the cover that is asked for, so an item's commonest seeds,
   fewer than that number, are not needed to find it: pairs are found by the others, and go on when they share
   enough seeds of all.
2. ``tile``: for each such pair, the longest match of words that are not yet marked in either is marked,
   again and again, until none of MIN_TILE words is left. Matches of a length are found with running
   Karp-Rabin hashes of all unmarked windows; the longest length by bisection. A word is marked once, so
   tiles never overlap, and passages in another order are found as well.
3. A text is contaminated by an item when the tiles cover at least PERCENT of the item's words.

Words are lower-cased (A-Z). An item of fewer than MIN_TILE words is one tile, its whole sequence. Items
without words match nothing. A null or empty text matches nothing; repeated rows are found each, but
share one comparison; a null id is compared by its text like any other. A text of any length is compared whole.
An item of one word is contained in every text with that word: leave such items out of the benchmark where that is
not wanted. Empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import Scratch, ship
from .words import U64, Texts, blocks, windows, words

MIN_TILE = 4
PERCENT = 50
BITMAP_BITS = (22, 28)  # least and most, as powers of two
BITMAP_SHARE = 32

_ROLL = U64(0x9E3779B97F4A7C15)


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item_key, n_words, seed) of every run of every item."""
    for batch in batches:
        for lo, hi, texts in blocks(batch.column(1)):
            w = words(texts)
            code, at = windows(w, MIN_TILE, whole_short=True)
            owner = np.repeat(np.arange(hi - lo), np.diff(at))
            keys = batch.column(0).slice(lo, hi - lo).take(pa.array(owner))
            yield pa.RecordBatch.from_arrays([keys, pa.array(np.diff(w.first)[owner]), pa.array(code.view(np.int64))], names=["item_key", "n_words", "seed"])


def _sequences(texts: Texts) -> list[np.ndarray]:
    w = words(texts)
    return [w.hash[w.first[i] : w.first[i + 1]] for i in range(len(texts.at) - 1)]


def _matches(a: np.ndarray, b: np.ndarray, free_a: np.ndarray, free_b: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Running Karp-Rabin hashes of the windows of ``size`` unmarked words: (hash, start) in a and b."""
    out = []
    for seq, free in ((a, free_a), (b, free_b)):
        n = len(seq) - size + 1
        if n <= 0:
            out += [np.zeros(0, np.uint64), np.zeros(0, np.int64)]
            continue
        marked = np.concatenate([[0], np.cumsum(~free)])
        start = np.flatnonzero(marked[size:] == marked[:-size])
        # Prefix sums of word * base ** -place: a window's sum, scaled back, does not depend on its place.
        place = _places(len(seq))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(seq * place[0][: len(seq)], dtype=np.uint64)])
        out += [(total[start + size] - total[start]) * place[1][start], start]
    return tuple(out)


_kept_places: list[np.ndarray] = []


def _places(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base's inverse and of the base, modulo 2**64."""
    if not _kept_places or len(_kept_places[0]) < n:
        size = max(n, 4096)
        back = np.full(size, U64(pow(int(_ROLL), -1, 1 << 64)))
        ahead = np.full(size, _ROLL)
        back[0] = ahead[0] = 1
        _kept_places[:] = [np.cumprod(back, dtype=np.uint64), np.cumprod(ahead, dtype=np.uint64)]
    return _kept_places[0], _kept_places[1]


def tile(item: np.ndarray, text: np.ndarray, least: int = MIN_TILE) -> list[tuple[int, int, int]]:
    """(start in item, start in text, length) of the tiles, longest first.

    Ties of length go to the first place in the text, then in the item."""
    least = min(least, len(item))
    free_i, free_t = np.ones(len(item), bool), np.ones(len(text), bool)
    tiles: list[tuple[int, int, int]] = []
    if not least:
        return tiles

    def common(size: int):
        hi, at_i, ht, at_t = _matches(item, text, free_i, free_t, size)
        hit = np.isin(ht, hi)
        return hi, at_i, ht[hit], at_t[hit]

    most = min(len(item), len(text))
    while most >= least:
        low, high = least - 1, most  # a match of length low exists, or low is too short
        while low < high:
            middle = (low + high + 1) // 2
            if len(common(middle)[2]):
                low = middle
            else:
                high = middle - 1
        if low < least:
            break
        hi, at_i, ht, at_t = common(low)
        starts: dict[int, list[int]] = {}
        for h, i in zip(hi.tolist(), at_i.tolist(), strict=True):
            starts.setdefault(h, []).append(i)
        for h, t in zip(ht.tolist(), at_t.tolist(), strict=True):
            if not free_t[t : t + low].all():
                continue
            i = next((i for i in starts[h] if free_i[i : i + low].all()), None)
            if i is None:
                continue
            free_i[i : i + low] = False
            free_t[t : t + low] = False
            tiles.append((i, t, low))
        most = low - 1  # every free match of this length is marked now
    return tiles


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (text_key, text, item_key, item): the tiles' cover."""
    for batch in batches:
        key, total, covered, count = [], [], [], []
        last, seq = None, np.zeros(0, np.uint64)
        for i in range(batch.num_rows):
            k = batch.column(0)[i].as_py()
            if k != last:
                (_, _, texts), *_ = blocks(batch.column(1).slice(i, 1))
                last, seq = k, _sequences(texts)[0]
            (_, _, texts), *_ = blocks(batch.column(3).slice(i, 1))
            item = _sequences(texts)[0]
            tiles = tile(item, seq)
            key.append(k)
            total.append(len(item))
            covered.append(sum(t[2] for t in tiles))
            count.append(len(tiles))
        yield pa.RecordBatch.from_arrays(
            [pa.array(key, pa.int64()), batch.column(2), *(pa.array(c, pa.int64()) for c in (total, covered, count))],
            names=["text_key", "item_key", "n_words", "n_covered", "n_tiles"],
        )


def contaminations(
    docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, text_key, item_id, n_words, n_covered, n_tiles): one row for each document and item whose
    tiles cover at least ``percent`` of the item's words. ``text_key`` is the text's 64-bit hash."""
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark)
    item = F.coalesce(F.col(item_text_col).cast("string"), F.lit(""))
    named = benchmark.select(F.col(item_col).alias("item_id"), F.xxhash64(item).alias("item_key"), item.alias("item"))
    items = named.select("item_key", "item").distinct()
    seeds = items.mapInArrow(_item_words, "item_key long, n_words long, seed long")
    seeds = scratch.keep(seeds.groupBy("item_key", "n_words", "seed").agg(F.count("*").alias("times")))
    bits = 1 << min(max(BITMAP_BITS[0], (BITMAP_SHARE * seeds.count()).bit_length()), BITMAP_BITS[1])
    # At most 2 ** BITMAP_BITS[1] / 64 pairs of numbers come to the driver, whatever the benchmark's size.
    slot = F.pmod("seed", F.lit(bits))
    packed = seeds.select(F.shiftright(slot, 6).alias("at"), F.expr(f"shiftleft(1L, cast(pmod(seed, {bits}) & 63 as int))").alias("bit"))
    filled = packed.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    bitmap = np.zeros(bits // 64, np.int64)
    bitmap[filled["at"].to_numpy()] = filled["bits"].to_numpy()
    sent = spark.sparkContext.broadcast(bitmap.view(np.uint8))

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(text_key, seed) of the runs of MIN_TILE words that pass the bitmap, once for each text."""
        flags = sent.value
        for batch in batches:
            for lo, hi, texts in blocks(batch.column(1)):
                code, at = windows(words(texts), MIN_TILE, whole_short=True)
                # Shorter items are looked up by all shorter runs as well.
                every, owner = [code], [np.repeat(np.arange(hi - lo), np.diff(at))]
                for k in range(1, MIN_TILE):
                    short, first = windows(words(texts), k, whole_short=False)
                    every.append(short)
                    owner.append(np.repeat(np.arange(hi - lo), np.diff(first)))
                code, owner = np.concatenate(every), np.concatenate(owner)
                place = code & U64(bits - 1)
                hit = (flags[place >> U64(3)] >> (place & U64(7)).astype(np.uint8)) & 1 == 1
                pair = np.unique(np.stack([owner[hit].astype(np.uint64), code[hit]]), axis=1)
                keys = batch.column(0).slice(lo, hi - lo).take(pa.array(pair[0].astype(np.int64)))
                yield pa.RecordBatch.from_arrays([keys, pa.array(pair[1].view(np.int64))], names=["text_key", "seed"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    found = scratch.keep(rows.select("text_key", "text").mapInArrow(likely, "text_key long, seed long").distinct())
    # A tile of L words holds L - MIN_TILE + 1 >= L / MIN_TILE runs, so a cover of c words needs c / MIN_TILE.
    enough = lambda n: n * (100 * MIN_TILE) >= F.col("n_words") * percent
    ranked = seeds.join(found.groupBy("seed").agg(F.count(F.lit(1)).alias("n_texts")), "seed")
    commoner = F.sum("times").over(Window.partitionBy("item_key").orderBy(F.desc("n_texts"), "seed"))
    probes = ranked.withColumn("upto", commoner).filter(enough(F.col("upto"))).select("item_key", "seed")
    met = found.join(probes, "seed").select("text_key", "item_key").distinct()
    shared = met.join(found, "text_key").join(seeds, ["item_key", "seed"]).groupBy("text_key", "item_key", "n_words").agg(F.sum("times").alias("shared"))
    pairs = scratch.keep(shared.filter(enough(F.col("shared"))).select("text_key", "item_key"))
    # Only texts with a candidate are fetched again, each once.
    wanted = rows.select("text_key", "text").join(pairs.select("text_key").distinct(), "text_key", "left_semi")
    texts = scratch.keep(wanted.groupBy("text_key").agg(F.first("text").alias("text")))
    both = texts.join(pairs, "text_key").join(items, "item_key")
    covers = both.select("text_key", "text", "item_key", "item").mapInArrow(_compare, "text_key long, item_key long, n_words long, n_covered long, n_tiles long")
    leaks = covers.filter(F.col("n_covered") * 100 >= F.col("n_words") * percent)
    leaks = scratch.keep(leaks.join(named.select("item_id", "item_key").distinct(), "item_key"))
    return scratch.finish(rows.select("doc_id", "text_key").join(leaks, "text_key").select("doc_id", "text_key", "item_id", "n_words", "n_covered", "n_tiles"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that no benchmark item contaminates, all columns unchanged."""
    leaks = contaminations(docs, benchmark, percent, id_col, text_col).select(F.col("text_key").alias("_leak")).distinct()
    key = F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit("")))
    return docs.join(leaks, key == leaks["_leak"], "left_anti")
