"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame operations only.

Every source gets a target of words: its weight's share of the mix, but at most ``cap`` times its own
size, what is cut off being shared again by weight among the rest. A target of e whole sizes and a rest
is met by e complete epochs and a sample without replacement for the rest: each document draws the key
``-ln(u) / w`` (u: a uniform hash of its id, its text and its number among equal rows, w: its quality weight), the source is sorted by key, and
documents are taken up to the prefix sum that comes nearest to the rest.

No source is ever sorted in one task. Keys are cut into nested equal-width bins; sums per bin (partial
aggregates) show which bin the budget ends in, and only that bin is cut again, LEVELS times, until the
cut is one key. Whether a document is taken is then a comparison with its source's cut.

Rows that share an id draw apart by their texts, and equal rows by their number: they are counted, not sorted, and a
count is dealt out again in runs of RUN rows. So a hot id, or one row many times over, is cut like any other rows.

Defined results: a null text has size 0, and so takes 0; a null source is a source, the last; a null id
counts as empty text in the draw; a text of any length is counted whole; an empty table gives an empty result.
Reruns agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import Scratch

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
LEVELS = 4  # of 12 bits each, which name one key of 48
SYMBOLS = "#*$%&|<>"
RUN = 50_000  # equal rows that one task numbers


def sized(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(doc_id, source, size, place): place is the key's rank scale, 48 bits of 1 - exp(-key).

    The quality weight is 0.1 plus 0.9 of the share of the text's characters that are no markup symbols."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), text.alias("text"))
    chars = F.greatest(F.char_length("text"), F.lit(1))
    weight = 0.1 + 0.9 * F.char_length(F.translate("text", SYMBOLS, "")) / chars
    same = rows.select(
        "doc_id", "source", F.md5(F.col("text").cast("binary")).alias("text_key"), weight.alias("weight"),
        F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"),
    ).groupBy("doc_id", "source", "text_key", "weight", "size").agg(F.count(F.lit(1)).alias("n"))
    runs = same.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / RUN)))).repartition("text_key", "doc_id", "run")
    number = F.explode(F.sequence(F.col("run") * RUN, F.least(F.col("n"), (F.col("run") + 1) * RUN) - 1))
    each = runs.select("doc_id", "source", "text_key", "weight", "size", number.alias("number"))
    draw = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text_key", F.col("number").cast("string")).cast("binary"))
    uniform = (F.conv(F.substring(draw, 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))
    # 1 - exp(-(-ln u) / w) = 1 - u ** (1 / w): smaller keys first.
    place = F.floor((1 - F.pow(uniform, 1 / F.col("weight"))) * float(1 << 48)).cast("long")
    return each.select("doc_id", "source", "size", place.alias("place"))


def targets(rows: DataFrame, scratch: Scratch, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """(source, source_size, target): one row for each source.

    Sources are ranked by code point, null last, and take the weights in turn. At a common rate r a
    source gets ``min(cap * size, r * weight)``; r is raised until the targets add up, each time from
    the sums over the sources below their caps (two numbers come to the driver), so it takes at most as
    many rounds as there are sources, in practice a few."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int")).cast("double")
    sizes = scratch.keep(sizes.withColumn("weight", weight).withColumn("most", (F.col("source_size") * cap).cast("double")))
    want = share * (sizes.agg(F.sum("source_size")).first()[0] or 0)
    rate = 0.0
    while True:
        full = F.col("weight") * rate >= F.col("most")
        capped, free = sizes.agg(F.sum(F.when(full, F.col("most"))), F.sum(F.when(~full, F.col("weight")))).first()
        raised = (want - (capped or 0.0)) / free if free else rate
        if raised <= rate:
            return sizes.select("source", "source_size", F.least(F.col("most"), F.col("weight") * rate).alias("target"))
        rate = raised


def cuts(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, cut) for each row of ``budgets`` (source, rest): documents whose place is at most ``cut``
    are sampled. Their sizes come as near to ``rest`` as whole documents in key order can."""
    bits = 48 // LEVELS
    # prefix: the leading bits of the place found so far; before: the sizes of all smaller places.
    found = budgets.filter("rest > 0").select("source", "rest", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("before"))
    for level in range(LEVELS):
        left = 48 - bits * level
        top = found.select(F.col("source").alias("_source"), "rest", "prefix", "before")
        inside = rows.join(top, F.col("source").eqNullSafe(F.col("_source")) & (F.shiftright("place", left) == F.col("prefix")))
        bins = inside.groupBy("source", "rest", "before", F.shiftright("place", left - bits).alias("bin")).agg(F.sum("size").alias("held"))
        running = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        bins = bins.withColumn("upto", F.col("before") + F.sum("held").over(running))
        found = bins.filter("upto >= rest and upto - held < rest").select("source", "rest", F.col("bin").alias("prefix"), (F.col("upto") - F.col("held")).alias("before"), "held")
    nearer = F.col("before") + F.col("held") - F.col("rest") <= F.col("rest") - F.col("before")
    return found.select("source", F.when(nearer, F.col("prefix")).otherwise(F.col("prefix") - 1).alias("cut"))


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
    weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, epochs, taken) of each row: ``epochs`` is how often the
    mix takes the document, ``taken`` the words that makes."""
    scratch = Scratch(docs.sparkSession)
    rows = scratch.keep(sized(docs, id_col, source_col, text_col))
    goals = scratch.keep(targets(rows, scratch, weights, share, cap))
    size = F.greatest(F.col("source_size"), F.lit(1))
    budgets = goals.withColumn("whole", F.floor(F.col("target") / size).cast("long")).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    budgets = scratch.keep(budgets)
    cut = scratch.keep(cuts(rows, budgets)).select(F.col("source").alias("_cut_source"), "cut")
    plan = budgets.join(cut, F.col("source").eqNullSafe(F.col("_cut_source")), "left")
    plan = plan.select(F.col("source").alias("_source"), "source_size", "target", "whole", F.coalesce("cut", F.lit(-1)).alias("cut"))
    out = rows.join(plan, F.col("source").eqNullSafe(F.col("_source")))
    epochs = F.col("whole") + F.when(F.col("place") <= F.col("cut"), 1).otherwise(0)
    return scratch.finish(out.select("doc_id", "source", "size", "source_size", "target", epochs.alias("epochs"), (F.col("size") * epochs).alias("taken")))
