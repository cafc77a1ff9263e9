"""Line deduplication by site-relative frequency, in DataFrame operations only.

Pages are grouped by host. For each line the number of the host's pages that hold it is divided by the
host's page total; lines above ``percent`` of the pages (and on at least ``least_pages``, two, as a line on one page
is no repeat) are boilerplate of that host and are dropped from its pages, whatever other hosts do with them.

A line is compared without surrounding white space; blank lines are neither counted nor dropped, and a
line counts once per page however often it stands there. A page that would lose all its lines is a copy
of other pages rather than content with boilerplate around it: it is left whole, for near-duplicate
detection to judge, and ``left_whole`` marks it. Texts are taken whole, of any length. Null hosts form one group; a null text has no lines and stays null; repeated rows
are pages of their own. An empty table gives an empty result.

Copies of one page are no evidence of boilerplate. With ``classes``, the near-duplicate classes of the
rows, pages are counted by class: a line that only the members of one class share is on one page, however
many they are, and the host's total counts each class once. A row whose class is null is its own.

Counting is one aggregate with a map-side part over (host, line hash): a hot host's very common lines
shrink to one row per task before the shuffle. By class, distinct (host, line hash, class) are dealt out
first, so a hot line is spread over its classes; only line hashes, not texts, meet the classes. What comes
back to the pages is one array of line hashes per host. Each of its lines is on over ``percent`` of the host's pages, so it holds at most
``100 / percent`` times a page's mean number of lines; the join is left to the planner, which broadcasts
it where its size allows and else splits hot hosts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import once
from .store import Scratch

PERCENT = 1
LEAST_PAGES = 2
BLANK = " \t\x0b\x0c\r"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _code(line: Column) -> Column:
    return F.xxhash64(F.btrim(line, F.lit(BLANK)))


def _held(text: Column) -> Column:
    return F.array_distinct(F.transform(F.filter(_lines(text), lambda x: F.btrim(x, F.lit(BLANK)) != ""), _code))


def classed(docs: DataFrame, classes: DataFrame, host_col: str, text_col: str, id_col: str) -> DataFrame:
    """(host, class, held) of each row: ``held`` has the hashes of its lines."""
    text = F.col(text_col).cast("string")
    pages = docs.select(F.col(host_col).alias("host"), F.col(id_col).cast("long").alias("_id"), F.xxhash64(text).alias("_key"), _held(text).alias("held"))
    known = classes.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.col("component_id").alias("class"))
    known = known.filter("class is not null").dropDuplicates(["_id", "_key"])
    return pages.join(known.hint("merge"), ["_id", "_key"], "left").select("host", "class", "held")


def boilerplate(docs: DataFrame, host_col: str, text_col: str, percent: int, least_pages: int, classes: DataFrame | None = None, id_col: str = "doc_id") -> DataFrame:
    """(host, lines): the hashes of each host's boilerplate lines."""
    if classes is None:
        pages = docs.select(F.col(host_col).alias("host"), _held(F.col(text_col).cast("string")).alias("held"))
        number = F.count("*")
    else:
        pages = Scratch(docs.sparkSession).keep(classed(docs, classes, host_col, text_col, id_col))
        number = F.count_distinct("class") + F.count(F.when(F.col("class").isNull(), 1))
    totals = pages.groupBy("host").agg(number.alias("total"))
    lines = pages.withColumn("line", F.explode("held")).drop("held")
    counts = lines.groupBy("host", "line").agg(number.alias("pages")).filter(F.col("pages") >= least_pages)
    common = counts.join(totals.withColumnRenamed("host", "_host"), F.col("host").eqNullSafe(F.col("_host"))).filter(F.col("pages") * 100 > F.col("total") * percent)
    return common.groupBy("host").agg(F.collect_list("line").alias("lines"))


def line_dedup(
    docs: DataFrame, host_col: str = "source", text_col: str = "text", percent: int = PERCENT, least_pages: int = LEAST_PAGES,
    classes: DataFrame | None = None, id_col: str = "doc_id",
) -> DataFrame:
    """One row for each row of ``docs``: its columns in the struct ``row``, the text without boilerplate
    lines in ``text``, its line total in ``n_lines``, the lines dropped in ``n_dropped``, and in ``left_whole`` whether it
kept lines over the ratio as it has no others.

    ``classes`` is what :func:`depreco.llm.near_dedup.near_duplicates` gives for ``docs``; without it every row is a page."""
    # Written first: the join is then planned from the table's real size.
    common = Scratch(docs.sparkSession).keep(boilerplate(docs, host_col, text_col, percent, least_pages, classes, id_col))
    common = common.select(F.col("host").alias("_host"), "lines")
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(host_col).alias("host"), F.col(text_col).cast("string").alias("text"))
    rows = rows.join(common, F.col("host").eqNullSafe(F.col("_host")), "left")
    blank = lambda x: F.btrim(x, F.lit(BLANK)) == ""
    kept = F.filter("every", lambda x: blank(x) | ~F.array_contains(F.col("lines"), _code(x)))
    rows = once(rows, every=_lines(F.col("text")))
    rows = once(rows, rest=F.when(F.col("lines").isNull(), F.col("every")).otherwise(kept))
    rows = rows.withColumn("kept", F.when(F.exists("rest", lambda x: ~blank(x)), F.col("rest")).otherwise(F.col("every")))
    return rows.select(
        "row",
        F.when(F.size("kept") == F.size("every"), F.col("text")).otherwise(F.array_join("kept", "\n")).alias("text"),
        F.coalesce(F.size("every"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("every") - F.size("kept"), F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce(F.size("kept") > F.size("rest"), F.lit(False)).alias("left_whole"),
    )
