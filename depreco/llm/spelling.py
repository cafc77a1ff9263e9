"""Spelling variants: words one edit apart, found by an index of variable-length grams.

A word is cut into overlapping grams: from each place the shortest gram that is not frequent, of
QMIN letters up to a bound, less those inside an earlier one. The dictionary of frequent grams is pruned by
its counts: common letter pairs grow into longer, rarer grams, and what is rare is never listed.
A word's affected-gram bound is the most grams that one edit can change: those over the edited place, and a
shorter one that begins right behind it, which a gram grown across the place may swallow. All others stay, at the
same distance from the word's begin or end. So of a pair one edit apart, each word keeps all its grams but as many
as its bound, and the rarest gram that both keep is among the bound + 1 rarest of either: only these lists are read,
the lists of the commoner grams never are. Pairs that meet in a list are verified by edit distance.

The longest gram for words of m letters is (m - 1) / 2 letters, so at least one gram outlives any edit and no
pair is missed. Words of m and of m + 1 letters are cut by the same bound when they are compared, so a word is cut
twice, as the shorter and as the longer one of a pair.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import Scratch

#: The letters of a word, and those that are lower-cased.
LETTERS = "a-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

LEAST_LENGTH, LEAST_COUNT, DROP_EVERY, TIMES = 5, 3, 97, 2

QMIN, QMAX = 2, 7  # letters of a gram
FREQUENT = 100  # a gram that more places hold is frequent and grows
GRAMS = 50_000  # frequent grams of one length at most: the bound rises with the vocabulary, so the dictionary stays this small
COUNTED = 400_000  # grams that a task counts before it hands them on


def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", drop_every: int = DROP_EVERY, least_length: int = LEAST_LENGTH) -> DataFrame:
    """(word) for each run of letters of the whole texts, A-Z lower-cased, that has ``least_length`` letters or more.

    Where ``drop_every`` divides h, the crc32 of ``<id>:<run>``, the run's letter h % length is left out first: misspellings that
    are the same in every run of the query. A null text has no words; a null id counts as empty text. Repeated
    rows count each. All by built-in functions."""
    text = F.translate(F.col(text_col).cast("string"), UPPER, LOWER)
    runs = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(text, F.lit(f"[{LETTERS}]+"), F.lit(0))).alias("run"),
    ).filter(F.char_length("run") >= least_length)
    h = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    words = runs.select("run", h.alias("h")).select(F.when(F.col("h") % drop_every == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.filter(F.char_length("word") >= least_length)


def word_counts(words: DataFrame, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words that occur ``least_count`` times or more, counted over all rows."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count)


def gram_dictionary(words: DataFrame) -> dict[str, int]:
    """Frequent grams of QMIN to QMAX - 1 letters with their counts over the distinct words.

    A gram is frequent if more than ``max(FREQUENT, letters of all words / GRAMS)`` places hold it. Hence at most GRAMS
    of each length are, whatever the vocabulary, and with a gram all its parts are. Counted on Spark."""
    letters = words.agg(F.sum(F.char_length("word"))).head()[0] or 0
    least = max(FREQUENT, letters // GRAMS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()

        def counted() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], names=["gram", "n"])
            found.clear()
            return out

        for batch in batches:
            for word in batch.column(0).to_pylist():
                for q in range(QMIN, QMAX):
                    found.update([word[p : p + q] for p in range(len(word) - q + 1)])
                if len(found) >= COUNTED:
                    yield counted()
        yield counted()

    counts = words.select("word").mapInArrow(run, "gram string, n long")
    frequent = counts.groupBy("gram").agg(F.sum("n").alias("n")).filter(F.col("n") > least)
    return {r.gram: r.n for r in frequent.collect()}


def longest_gram(length: int) -> int:
    """Bound on the grams of words of so many letters, and of those with a letter more that they are compared with."""
    return min(QMAX, (length - 1) // 2)


def cut(word: str, longest: int, frequent: dict[str, int]) -> list[tuple[int, int]]:
    """Begin and end of the word's grams."""
    out, reach, n = [], 0, len(word)
    for p in range(n - QMIN + 1):
        end, top = p + QMIN, min(n, p + longest)
        while end < top and word[p:end] in frequent:
            end += 1
        if end > reach:
            out.append((p, end))
            reach = end
    return out


def affected(grams: list[tuple[int, int]], length: int, longest: int) -> int:
    """The most of the grams that one edit can change."""
    steps = [0] * (length + 1)
    for p, end in grams:
        steps[p - 1 if p and end - p < longest else p] += 1
        steps[end] -= 1
    most = now = 0
    for s in steps:
        now += s
        most = max(most, now)
    return most


def probes(word: str, longest: int, frequent: dict[str, int]) -> list[tuple[int, int, str]]:
    """The affected bound + 1 rarest grams, as (begin, end, gram): by their count in the dictionary (unlisted ones first),
    then by letters, then by place."""
    grams = cut(word, longest, frequent)
    ranked = sorted((frequent.get(word[p:e], 0), word[p:e], p, e) for p, e in grams)
    return [(p, e, g) for _, g, p, e in ranked[: affected(grams, len(word), longest) + 1]]


def keys(word: str, frequent: dict[str, int], least_length: int) -> tuple[list[str], list[str]]:
    """Lists that the word is in as the first and as the second one of a pair.

    ``=``: pairs of equal length, by the gram's place. ``<`` and ``>``: pairs of a word with one of a letter more, by
    the gram's distance from the begin and from the end."""
    n = len(word)
    own = probes(word, longest_gram(n), frequent)
    equal = [f"={n}:{p}:{g}" for p, _, g in own]
    sides = lambda m, found: [k for p, e, g in found for k in (f"<{m}:{p}:{g}", f">{m}:{n - e}:{g}")]
    longer = sides(n - 1, probes(word, longest_gram(n - 1), frequent)) if n > least_length else []
    return equal + sides(n, own), equal + longer


def gram_index(words: DataFrame, least_length: int = LEAST_LENGTH) -> DataFrame:
    """(word, n, letters, first, second): the word's lists (:func:`keys`) and its letters as bits."""
    shared = words.sparkSession.sparkContext.broadcast(gram_dictionary(words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = shared.value
        for batch in batches:
            own = batch.column(0).to_pylist()
            lists = [keys(w, frequent, least_length) for w in own]
            letters = [sum(1 << b for b in {ord(c) % 63 for c in w}) for w in own]
            first, second = (pa.array([x[i] for x in lists], pa.list_(pa.string())) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(letters, pa.int64()), first, second], names=["word", "n", "letters", "first", "second"])

    return words.select("word", "n").mapInArrow(run, "word string, n long, letters long, first array<string>, second array<string>")


def near_pairs(index: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b): each pair of words one edit apart once, the shorter first, then by letters.

    The lists are joined by hash of their key. An edit changes two letters of a word's set at most, which is looked
    at before the edit distance. A pair may meet in several lists; equal rows are merged by Spark."""
    side = lambda at, s: index.select(F.explode(at).alias("key"), F.col("word").alias(s), F.col("n").alias(f"n_{s}"), F.col("letters").alias(f"l_{s}")).withColumn("key", F.xxhash64("key"))
    met = side("first", "a").join(side("second", "b"), "key").filter(
        (F.bit_count(F.col("l_a").bitwiseXOR(F.col("l_b"))) <= 2)
        & ((F.char_length("a") < F.char_length("b")) | (F.col("a") < F.col("b")))
        & (F.levenshtein("a", "b", 1) == 1)
    )
    return met.select("a", "n_a", "b", "n_b").distinct()


def spelling_groups(words: DataFrame, times: int = TIMES, least_length: int = LEAST_LENGTH) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for each of the distinct ``words`` (word, n).

    Near are two words that differ by exactly one inserted, deleted or replaced code point; ``n_near`` counts a word's. Its
    form is the near word of largest n (ties: the first in code-point order), if that has ``times`` its n or more, else
    null; ``root`` follows the forms to the last. Words of fewer than ``least_length`` (5 at least) letters or of null word
    are no words. No words give no rows; a word of any length is cut and compared whole. Other columns are not read.

    Forms grow by the factor ``times``, so chains are short; they are followed by doubling, a join for each power of two."""
    if least_length < 2 * QMIN + 1 or times < 2:
        raise ValueError("words of 5 letters and a factor of 2 at least")
    scratch = Scratch(words.sparkSession)
    known = words.select(F.col("word").cast("string").alias("word"), F.col("n").cast("long").alias("n")).filter(F.char_length("word") >= least_length)
    known = scratch.keep(known)
    pairs = scratch.keep(near_pairs(scratch.keep(gram_index(known, least_length))))
    ways = pairs.select(F.col("a").alias("word"), F.struct((-F.col("n_b")).alias("n"), F.col("b").alias("near")).alias("to"))
    ways = ways.union(pairs.select(F.col("b").alias("word"), F.struct((-F.col("n_a")).alias("n"), F.col("a").alias("near")).alias("to")))
    best = ways.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min("to").alias("to"))
    good = -F.col("to.n") >= F.col("n") * times
    linked = scratch.keep(
        known.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(good, F.col("to.near")).alias("form"), F.when(good, -F.col("to.n")).alias("form_n"),
        )
    )
    roots = scratch.keep(linked.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        moved = scratch.keep(roots.join(ahead, "root", "left").select("word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved")))
        roots = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            break
    return scratch.finish(linked.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")))
