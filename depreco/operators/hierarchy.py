"""Taxonomy inheritance and the global value (DOM-09, DOM-10).

A class takes its own schedule's factor, else its subcategory parent's own factor, else its
category parent's own factor, else the global value: the mean factor of category-level
output classes in the global list. Everything runs on class-grain tables (bounded by the
taxonomy), joined by id; the global value is a one-row-per-kind aggregate.

The output map has one row per class (``sources.maps.schedule_outputs``), so a class has one
row per factor family here and stays one row. Factor families (decay, worst / best, retail /
auction) go through one set of joins together, in long format with a ``kind`` column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depreco.config import Params

KIND = "kind"


def _with_kind(df: DataFrame) -> DataFrame:
    return df if KIND in df.columns else df.withColumn(KIND, F.lit(""))


def class_factors(sched_factors: DataFrame, outputs: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Output classes whose schedule carries a factor row (possibly NULL), with their parent ids."""
    sf = _with_kind(sched_factors).select(KIND, "Schedule", "factor")
    j = sf.join(outputs.select("ClassificationId", "Schedule", "Level2"), "Schedule")
    return j.join(taxonomy.select("ClassificationId", "CategoryId", "CS_ClassId", "C_ClassId"), "ClassificationId")


def global_value(start: DataFrame, p: Params) -> DataFrame:
    """Per kind: mean non-null factor over category-level classes of the global list.
    A family without such classes has no row (its global value is missing)."""
    sel = _with_kind(start).where(
        F.col("CategoryId").isin(*p.global_list) & (F.col("Level2") == "Category") & F.col("factor").isNotNull()
    )
    return sel.groupBy(KIND).agg(F.avg("factor").alias("glob"))


def inherit_from(start: DataFrame, p: Params) -> DataFrame:
    """(kind, ClassificationId, factor, CS_ClassId, C_ClassId, resolved_from) from class_factors."""
    start = _with_kind(start)
    own = start.where(F.col("factor").isNotNull()).groupBy(KIND, "ClassificationId").agg(F.max("factor").alias("factor"))
    cs = own.select(F.col(KIND).alias("_cs_k"), F.col("ClassificationId").alias("_cs_id"), F.col("factor").alias("_cs_f"))
    c = own.select(F.col(KIND).alias("_c_k"), F.col("ClassificationId").alias("_c_id"), F.col("factor").alias("_c_f"))
    # One row per factor family (five at most): broadcast.
    glob = F.broadcast(global_value(start, p))
    j = (
        start.join(cs, (F.col(KIND) == cs._cs_k) & (F.col("CS_ClassId") == cs._cs_id), "left")
        .join(c, (F.col(KIND) == c._c_k) & (F.col("C_ClassId") == c._c_id), "left")
        .join(glob, KIND, "left")
    )
    resolved = (
        F.when(F.col("factor").isNotNull(), "own")
        .when(F.col("_cs_f").isNotNull(), "subcategory")
        .when(F.col("_c_f").isNotNull(), "category")
        .otherwise("global")
    )
    return j.select(
        KIND, "ClassificationId", F.coalesce("factor", "_cs_f", "_c_f", "glob").alias("factor"),
        "CS_ClassId", "C_ClassId", resolved.alias("resolved_from"),
    )


def inherit(sched_factors: DataFrame, outputs: DataFrame, taxonomy: DataFrame, p: Params) -> DataFrame:
    return inherit_from(class_factors(sched_factors, outputs, taxonomy), p)


def by_class(inherited: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """One row per class: each family's factor in the column that ``kinds`` names, NULL where the
    family has no row, and ``has_<column>`` saying whether it has one."""
    cols = []
    for name, kind in kinds.items():
        mine = F.col(KIND) == kind
        cols += [F.max(F.when(mine, F.col("factor"))).alias(name), F.max(mine).alias(f"has_{name}")]
    return inherited.groupBy("ClassificationId").agg(*cols)
