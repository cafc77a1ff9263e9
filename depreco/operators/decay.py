"""Decay factor: outlier removal and a log-linear fit per schedule (DOM-02..04).

Scale design. Within one run every cost row of a model year has the same age (ages are
measured at the effective date, so they are whole years apart). The fact is reduced once,
by a partial/final aggregate, to (category, subcategory, make, age) cells: counts, sums and
within-cell squares combine exactly. Only these class-grain cells are expanded to their
levels and joined to the schedule map, so a category that holds a third of all rows is a
few cells. The standard-deviation filter, the fit with intercept, the hat values and the
mean Cook's distance are exact functions of the cell sums.

Single rows are looked at once more, and only where it may matter. A row's Cook's distance grows with its
squared residual, which is convex in y, so a class cell holds an influential row only if its least or its
largest y is one. The cells that pass are a short written list, which each row of their classes and ages
meets; where no cell passes the facts are not read again. The influential rows' sums are taken off the cell
sums. No window spans a schedule's rows; nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from depreco.config import Params
from depreco.functions import age_years_4dp, clamp, safe_div
from depreco.operators import outliers
from depreco.operators.assign import CLASS, assign_by_closure, assign_schedules, closure, with_lists

# Leverage this close to 1 is treated as exactly 1 (Cook's distance undefined).
HAT_ONE_TOL = 1e-9


def regression_input(cost_rows: DataFrame, p: Params) -> DataFrame:
    """Cost rows in the age band with an in-band ratio, reduced to the fit's columns.

    Both filters are properties of the row, so they run before anything is aggregated."""
    keep = F.col("Age").between(p.cost_age_low, p.cost_age_high) & (F.col("Flag") == "inUse")
    return cost_rows.where(keep).select(
        "CategoryId", "SubcategoryId", "MakeId", "AgeMonths", F.col("Age").alias("x"),
        F.log(F.col("CostRatio")).alias("y"), F.col("CostRatio").alias("r"),
    )


def regression_rows(slim: DataFrame, keep) -> DataFrame:
    """:func:`regression_input`'s rows, written by ``keep``. The fit and the ratio filters read them several times; the
    facts are read, joined and filtered once. ``y`` is the logarithm of ``r`` and is taken again where it is read."""
    return keep(slim.drop("y")).select(*[F.log("r").alias("y") if c == "y" else c for c in slim.columns])


def class_cells(slim: DataFrame) -> DataFrame:
    """(class, AgeMonths) -> n, sum(y), within-cell sum of squares of y and its range: the only pass over all rows."""
    n = F.count(F.lit(1))
    return slim.groupBy(*CLASS, "AgeMonths").agg(
        n.alias("n"), F.sum("y").alias("sy"), (F.var_pop("y") * n).alias("ss"),
        F.max("x").alias("x"), F.min("y").alias("y_min"), F.max("y").alias("y_max"),
    )


def merge_cells(cells: DataFrame) -> DataFrame:
    """(Schedule, AgeMonths) cells from the class cells of the schedule's classes."""
    between = F.sum(F.col("sy") * F.col("sy") / F.col("n")) - F.sum("sy") * F.sum("sy") / F.sum("n")
    return cells.groupBy("Schedule", "AgeMonths").agg(
        F.sum("n").alias("n"), F.sum("sy").alias("sy"), (F.sum("ss") + between).alias("ss")
    ).withColumn("x", age_years_4dp("AgeMonths"))


def age_cells(slim: DataFrame, schedules: DataFrame) -> DataFrame:
    return merge_cells(assign_schedules(class_cells(slim), schedules))


def sd_filter_cells(cells: DataFrame, k: float) -> DataFrame:
    """WN-01 on cells: keep ages within mean +- k*sd (sample sd over rows) of the schedule.

    Computed on whole months, so equal ages give sd exactly 0 and keep their rows; a
    one-row schedule has no sd and is dropped. The window runs on the cell table.
    """
    w = Window.partitionBy("Schedule")
    c = cells.withColumns(
        {"N_in": F.sum("n").over(w), "_snm": F.sum(F.col("n") * F.col("AgeMonths")).over(w)}
    )
    c = c.withColumn("mean_m", F.col("_snm") / F.col("N_in"))
    c = c.withColumn("_dev", F.col("n") * (F.col("AgeMonths") - F.col("mean_m")) ** 2)
    c = c.withColumn("sd_m", F.sqrt(safe_div(F.sum("_dev").over(w), F.col("N_in") - 1)))
    lo = F.col("mean_m") - F.lit(k) * F.col("sd_m")
    hi = F.col("mean_m") + F.lit(k) * F.col("sd_m")
    keep = (F.col("AgeMonths") <= hi) & (F.col("AgeMonths") >= lo)
    return c.withColumn("keep", F.coalesce(keep, F.lit(False))).drop("_snm", "_dev")


def fit_cells(kept: DataFrame, p: Params) -> DataFrame:
    """Fit ln(ratio) = a + b*age per schedule from cell sums; per cell: leverage and the
    squared-error sum; per schedule: s^2 and the Cook's threshold.

    Degenerate cases: a single age -> intercept-only fit (p = 1, h = 1/n);
    s^2 = 0 or h = 1 -> the distance is undefined (NULL) for those rows.
    """
    w = Window.partitionBy("Schedule")
    c = kept.withColumns(
        {
            "n_tot": F.sum("n").over(w),
            "n_cells": F.count(F.lit(1)).over(w),
            "_sx": F.sum(F.col("n") * F.col("x")).over(w),
            "_sy": F.sum("sy").over(w),
            "_snm": F.sum(F.col("n") * F.col("AgeMonths")).over(w),
        }
    )
    c = c.withColumns(
        {
            "xbar": F.col("_sx") / F.col("n_tot"),
            "ybar": F.col("_sy") / F.col("n_tot"),
            "dx": (F.col("AgeMonths") - F.col("_snm") / F.col("n_tot")) / 12.0,
        }
    )
    c = c.withColumns(
        {
            "_sxx": F.sum(F.col("n") * F.col("dx") ** 2).over(w),
            "_sxy": F.sum(F.col("dx") * (F.col("sy") - F.col("n") * F.col("ybar"))).over(w),
        }
    )
    single = F.col("n_cells") == 1
    c = c.withColumns(
        {
            "b": F.when(single, F.lit(0.0)).otherwise(F.col("_sxy") / F.col("_sxx")),
            "k": F.when(single, F.lit(1)).otherwise(F.lit(2)),
            "h": F.lit(1.0) / F.col("n_tot") + F.when(single, F.lit(0.0)).otherwise(F.col("dx") ** 2 / F.col("_sxx")),
        }
    )
    c = c.withColumn("a", F.col("ybar") - F.col("b") * F.col("xbar"))
    c = c.withColumn(
        "sse_c", F.col("ss") + F.col("n") * (F.col("sy") / F.col("n") - F.col("a") - F.col("b") * F.col("x")) ** 2
    )
    c = c.withColumn("s2", F.sum("sse_c").over(w) / (F.col("n_tot") - F.col("k")))
    lev = F.when(
        (F.lit(1.0) - F.col("h") > HAT_ONE_TOL) & (F.col("s2") > 0),
        F.col("h") / (F.lit(1.0) - F.col("h")) ** 2 / (F.col("k") * F.col("s2")),
    )
    c = c.withColumn("lev", lev)
    c = c.withColumns(
        {
            "_dsum": F.sum(F.col("lev") * F.col("sse_c")).over(w),
            "_dn": F.sum(F.when(F.col("lev").isNotNull(), F.col("n")).otherwise(0)).over(w),
        }
    )
    c = c.withColumn("mean_cooks", safe_div(F.col("_dsum"), F.col("_dn")))
    return c.select(
        "Schedule", "AgeMonths", "x", "n", "n_tot", "a", "b", "s2", "lev", "mean_cooks",
        (F.lit(p.cook_multiplier) * F.col("mean_cooks")).alias("threshold"),
    )


def fitted_cells(cells: DataFrame, p: Params) -> DataFrame:
    """Kept cells with their schedule's fit, for schedules of ``min_fit_rows`` rows or more."""
    total = F.sum("n").over(Window.partitionBy("Schedule"))
    return fit_cells(cells.withColumn("_rows", total).where(F.col("_rows") >= p.min_fit_rows).drop("_rows"), p)


_DISTANCE = "power({y} - {f}a - {f}b * x, 2) * {f}lev > {f}threshold"


def influential_cells(classes: DataFrame, closed: DataFrame, fitted: DataFrame, bounds: DataFrame | None = None) -> DataFrame:
    """(class, AgeMonths, list): the fits in which the cell's least or largest y is beyond the Cook threshold.

    With ``bounds`` on the ratio the fit's rows are those within them, so the range of y is cut to theirs."""
    j = assign_by_closure(classes.select(*CLASS, "AgeMonths", "x", "y_min", "y_max"), closed).join(
        fitted.where(F.col("lev").isNotNull()).select("Schedule", "AgeMonths", "a", "b", "lev", "threshold"), ["Schedule", "AgeMonths"]
    )
    fit = ["Schedule", "a", "b", "lev", "threshold"]
    if bounds is not None:
        j = j.join(bounds, ["Schedule", "AgeMonths"])
        fit += ["lo", "hi"]
    beyond = F.expr(f"({_DISTANCE.format(y='y_min', f='')}) OR ({_DISTANCE.format(y='y_max', f='')})")
    return j.where(beyond).groupBy(*CLASS, "AgeMonths").agg(F.collect_list(F.struct(*fit)).alias("list"))


def influential_rows(slim: DataFrame, cells: DataFrame, bounded: bool = False) -> DataFrame:
    """(Schedule, x, y) of the rows beyond their schedule's Cook threshold, from the cells that may hold one."""
    test = _DISTANCE.format(y="y", f="f.") + (" AND r BETWEEN f.lo AND f.hi" if bounded else "")
    hit = F.explode(F.expr(f"filter(list, f -> {test})"))
    return with_lists(slim, cells).select("x", "y", hit.alias("f")).select("f.Schedule", "x", "y")


def decay_table(cells: DataFrame, fitted: DataFrame, influential: DataFrame, p: Params) -> DataFrame:
    """Per schedule of the regression input: rows used, Cook's diagnostics and the factor
    ``exp(target_age * sum(xy)/sum(x^2))`` of the through-origin fit on non-influential rows.
    Schedules under ``min_fit_rows`` rows get factor 0 and n 0 (or NULL, ``small_group='null'``)."""
    out = influential.groupBy("Schedule").agg(
        F.sum(F.col("x") * F.col("y")).alias("xy_out"), F.sum(F.col("x") * F.col("x")).alias("xx_out"), F.count(F.lit(1)).alias("n_out")
    )
    sums = cells.groupBy("Schedule").agg(
        F.sum("n").alias("rows_in"), F.sum(F.col("x") * F.col("sy")).alias("xy"), F.sum(F.col("n") * F.col("x") * F.col("x")).alias("xx")
    )
    diag = fitted.groupBy("Schedule").agg(
        F.first("a").alias("intercept"), F.first("b").alias("slope"), F.first("s2").alias("s2"), F.first("mean_cooks").alias("mean_cooks")
    )
    j = sums.join(out, "Schedule", "left").join(diag, "Schedule", "left")
    big = F.col("rows_in") >= p.min_fit_rows
    n_out = F.coalesce("n_out", F.lit(0))
    slope0 = safe_div(F.col("xy") - F.coalesce("xy_out", F.lit(0.0)), F.col("xx") - F.coalesce("xx_out", F.lit(0.0)))
    small_value = F.lit(0.0) if p.small_group == "zero" else F.lit(None).cast("double")
    return j.select(
        "Schedule", "rows_in", F.when(big, F.col("rows_in") - n_out).otherwise(F.lit(0)).cast("long").alias("n"),
        F.when(big, n_out).alias("n_influential"), "intercept", "slope", "s2", "mean_cooks",
        F.when(big, F.exp(F.lit(p.target_age) * slope0)).otherwise(small_value).alias("factor"),
    )


def decay_fit(slim: DataFrame, schedules: DataFrame, p: Params, keep=lambda df: df) -> DataFrame:
    """The decay table of regression rows ``slim``; ``keep`` writes a small table that several
    steps read and returns it.

    ``p.outlier`` names a further filter on the ratio (:mod:`depreco.operators.outliers`); ``age`` has none."""
    classes = keep(class_cells(slim))
    closed = keep(closure(classes, schedules))
    cells = keep(sd_filter_cells(merge_cells(assign_by_closure(classes, closed)), p.sd_multiplier).where("keep"))
    bounds = None
    if p.outlier != "age":
        cells, bounds = outliers.ratio_filter(slim, closed, cells, p, keep)
    fitted = keep(fitted_cells(cells, p))
    listed = keep(influential_cells(classes, closed, fitted, bounds))
    if listed.isEmpty():  # nothing to read again
        slim = slim.limit(0)
    return decay_table(cells, fitted, influential_rows(slim, listed, bounds is not None), p)


def capped_decay(decay: DataFrame, p: Params) -> DataFrame:
    return decay.select("Schedule", "n", "factor", clamp(F.col("factor"), p.resid_low, p.resid_high).alias("cap_factor"))


def decay_by_class(capped: DataFrame, outputs: DataFrame, p: Params) -> DataFrame:
    """JN-10: every output class with its schedule's capped decay factor (NULL if none)."""
    j = outputs.select("ClassificationId", "Schedule").join(capped.select("Schedule", "cap_factor"), "Schedule", "left")
    return j.select(F.lit(p.market_code).alias("MarketCode"), "ClassificationId", F.col("cap_factor").alias("ResidSF"))
