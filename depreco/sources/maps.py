"""Schedule maps (SRC-10..13): which taxonomy nodes feed a schedule, and which classes read it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depreco.config import Params

# Column and marker names of the map sheets.
IN_DROPPED = ["ClassificationId", "Plot", "CategoryName", "SubcategoryName", "MakeName", "CSMM", "ValidSchedule"]
OUT_COLUMNS = ["ClassificationId", "Schedule", "SubcategoryId", "SubcategoryName", "Level2", "Plot"]
BORROW_TYPE = "RetailBorrowAuction"
BORROW_MARKER = " RbA "


def schedule_inputs(in_map: DataFrame, in_borrow_map: DataFrame, p: Params) -> DataFrame:
    """Input side: country rows of ``In`` plus retail-borrows-auction rows of ``InR``."""
    own = in_map.where(F.col("Country") == p.country).drop(*IN_DROPPED, "CanadaPlots")
    borrowed = (
        in_borrow_map.where(F.col("Country") == p.country)
        .drop(*IN_DROPPED, "CheckJoin")
        .where(F.col("BorrowType") == BORROW_TYPE)
        .drop("BorrowSchedule", "BorrowType")
    )
    return own.unionByName(borrowed).select("Country", "Schedule", "Level2", "CategoryId", "SubcategoryId", "MakeId")


def schedule_outputs(out_map: DataFrame, out_borrow_map: DataFrame, p: Params) -> DataFrame:
    """Output side: the schedule each class reads (``Out`` plus ``OutR`` rows with the marker).

    One row per class. A class that is mapped more than once reads the schedule of its own map
    before a borrowed one, then the first by name; of equal schedules the first by level and the other
    columns, missing values first, so the choice is the same in every run. ``mapped`` counts its rows, and the
    reconciliation checks report the rows that were dropped."""
    own = out_map.where(F.col("Country") == p.country).select(*OUT_COLUMNS, F.lit(0).alias("_borrowed"))
    borrowed = out_borrow_map.where(
        (F.col("Country") == p.country) & F.col("Schedule").contains(BORROW_MARKER)
    ).select(*OUT_COLUMNS, F.lit(1).alias("_borrowed"))
    rest = [c for c in OUT_COLUMNS if c != "ClassificationId"]
    first = F.min_by(F.struct(*rest), F.struct("_borrowed", "Schedule", "Level2", "SubcategoryId", "SubcategoryName", "Plot"))
    out = own.unionByName(borrowed).groupBy("ClassificationId").agg(first.alias("r"), F.count(F.lit(1)).alias("mapped"))
    return out.select("ClassificationId", *[f"r.{c}" for c in rest], "mapped")
