"""DOM-01: hierarchical schedule assignment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEVELS = ("Category", "SubcatGroup", "Make")
CLASS = ["CategoryId", "SubcategoryId", "MakeId"]


def assign_schedules(rows: DataFrame, schedules: DataFrame) -> DataFrame:
    """Attach every schedule mapped at the row's Category, (Category, Subcategory) or
    (Category, Subcategory, Make). Bag semantics: a row lands in each matching schedule.

    One pass over ``rows``: each row is expanded to its three level keys and joined once to
    the map. Keys compare null-safe, so a missing id matches a missing id. Callers aggregate
    facts to the taxonomy first, so what is expanded has class grain and a category's key
    meets few rows however many facts the category has. Returns ``rows``'s columns plus
    ``Schedule``.
    """
    m = schedules.where(F.col("Level2").isin(*LEVELS)).selectExpr(
        "Schedule",
        "Level2 AS _ml",
        "CategoryId AS _mc",
        "CASE WHEN Level2 <> 'Category' THEN CAST(SubcategoryId AS INT) END AS _ms",
        "CASE WHEN Level2 = 'Make' THEN CAST(MakeId AS INT) END AS _mm",
    )
    # the three level keys of a row; unused levels are NULL on both sides
    keys = F.expr(
        "explode(array("
        "named_struct('l', 'Category', 'c', CategoryId, 's', CAST(NULL AS INT), 'm', CAST(NULL AS INT)),"
        "named_struct('l', 'SubcatGroup', 'c', CategoryId, 's', CAST(SubcategoryId AS INT), 'm', CAST(NULL AS INT)),"
        "named_struct('l', 'Make', 'c', CategoryId, 's', CAST(SubcategoryId AS INT), 'm', CAST(MakeId AS INT))))"
    )
    cols = rows.columns
    f = rows.select(*cols, keys.alias("_k"))
    cond = F.expr("_k.l = _ml AND _k.c <=> _mc AND _k.s <=> _ms AND _k.m <=> _mm")
    return f.join(m, cond).select(*cols, "Schedule")


def closure(classes: DataFrame, schedules: DataFrame) -> DataFrame:
    """(class, schedules): every schedule that a class reads at any level, as an array, with repeats where several
    map rows give it. Built at class grain, however often a class occurs in ``classes``."""
    found = assign_schedules(classes.select(*CLASS).distinct(), schedules)
    return found.groupBy(*CLASS).agg(F.collect_list("Schedule").alias("schedules"))


def _same_class(renamed: str):
    same = F.lit(True)
    for c in CLASS:
        same = same & F.col(c).eqNullSafe(F.col(f"{renamed}{c}"))
    return same


def assign_by_closure(rows: DataFrame, closed: DataFrame) -> DataFrame:
    """As :func:`assign_schedules`, from the closure of the rows' classes: one equi-join on the class, and no
    row is expanded but to the schedules that it has."""
    side = closed.select(*[F.col(c).alias(f"_{c}") for c in CLASS], "schedules")
    return rows.join(side, _same_class("_")).select(*rows.columns, F.explode("schedules").alias("Schedule"))


def with_lists(rows: DataFrame, lists: DataFrame) -> DataFrame:
    """Rows of the (class, AgeMonths) that ``lists`` holds, with its column ``list``.

    ``lists`` is a written table of pruned cells, so the planner knows its size: while it is small it is broadcast and the
    rows stay where they are; beyond that both sides are shuffled on the class and the age."""
    side = lists.select(*[F.col(c).alias(f"_{c}") for c in (*CLASS, "AgeMonths")], "list")
    return rows.join(side, (F.col("AgeMonths") == F.col("_AgeMonths")) & _same_class("_")).select(*rows.columns, "list")
