"""Optional filters on the cost ratio behind the age filter: mean +- k*sd per schedule, or the quartile
fences of each (schedule, age).

Schedules overlap, and a fact is never expanded to them before it is aggregated. Means and deviations
combine from class cells. Quartiles don't, so they are selected in nested bins: counts per bin combine, the
bin that holds a wanted position is cut into bins again, between its least and its largest value, and so on
until the bin is a single value. A level multiplies the resolution by BINS; only the first one looks at all rows,
at class grain.

Either filter gives two bounds on the ratio. What lies outside is found like the influential rows: only class
cells whose range of ratios leaves the bounds are read again, and what is found is taken off the cells' sums.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from depreco.config import Params
from depreco.operators.assign import CLASS, assign_by_closure, with_lists

MODES = ("age", "ratio_sd", "iqr")
BINS = 512
GROUP = ["Schedule", "AgeMonths"]
SPAN = ["lo", "hi"]


def ratio_cells(slim: DataFrame) -> DataFrame:
    """(class, AgeMonths) -> rows, sum, squares within the cell and range of the ratio ``r``."""
    n = F.count(F.lit(1))
    return slim.groupBy(*CLASS, "AgeMonths").agg(
        n.alias("n"), F.sum("r").alias("sr"), (F.var_pop("r") * n).alias("ssr"), F.min("r").alias("r_min"), F.max("r").alias("r_max")
    )


def sd_bounds(ratios: DataFrame, kept: DataFrame, k: float) -> DataFrame:
    """(Schedule, AgeMonths, lo, hi): mean +- k*sd of the ratio over the schedule's rows of all kept ages.

    One row has no deviation, so it has no bounds (NULL) and is dropped; equal ratios have the deviation 0."""
    cells = ratios.join(kept.select(*GROUP), GROUP, "left_semi")
    n, s = F.sum("n"), F.sum("sr")
    square = F.sum("ssr") + F.sum(F.col("sr") * F.col("sr") / F.col("n")) - s * s / n
    by = cells.groupBy("Schedule").agg(n.alias("n"), (s / n).alias("mean"), square.alias("square"), F.min("r_min").alias("least"), F.max("r_max").alias("most"))
    sd = F.sqrt(F.greatest(F.lit(0.0), F.col("square")) / (F.col("n") - 1))
    same, one = F.col("least") == F.col("most"), F.col("n") == 1
    bound = lambda sign: F.when(one, F.lit(None)).when(same, F.col("least")).otherwise(F.col("mean") + F.lit(sign * k) * sd)
    return kept.select(*GROUP).join(by.select("Schedule", bound(-1).alias("lo"), bound(1).alias("hi")), "Schedule").select(*GROUP, *SPAN)


def _choose(bins: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bin of each wanted position, as its new span, and the position in it."""
    upto = F.sum("n").over(Window.partitionBy(*GROUP, *SPAN).orderBy("bin"))
    found = bins.withColumn("upto", upto).join(wanted, [*GROUP, *SPAN]).where((F.col("at") < F.col("upto")) & (F.col("at") >= F.col("upto") - F.col("n")))
    return found.select(*GROUP, "k", "part", (F.col("at") - F.col("upto") + F.col("n")).alias("at"), F.col("least").alias("lo"), F.col("most").alias("hi"))


def _bin(low, high):
    return F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor((F.col("r") - low) / (high - low) * BINS).cast("int")))


def quantiles(slim: DataFrame, ratios: DataFrame, closed: DataFrame, kept: DataFrame, p: Params, points: tuple[float, ...], keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(Schedule, AgeMonths, q0, q1, ...) exact quantiles of the ratio, linear between the two neighbouring positions.

    ``ratios``: the class cells with their schedules; ``kept``: the groups that are asked for."""
    n, least, most = F.count(F.lit(1)).alias("n"), F.min("r").alias("least"), F.max("r").alias("most")
    low, high = (F.lit(float(b[0] + b[1] * a)) for b, a in ((p.band_low, p.cost_age_low), (p.band_high, p.cost_age_high)))
    first = keep(slim.groupBy(*CLASS, "AgeMonths", _bin(low, high).alias("bin")).agg(n, least, most))
    all_, none = F.lit(float("inf")), F.lit(float("-inf"))
    bins = assign_by_closure(first, closed).groupBy(*GROUP, "bin").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"))
    bins = keep(bins.join(kept.select(*GROUP), GROUP, "left_semi").withColumns({"lo": none, "hi": all_}))
    total = bins.groupBy(*GROUP, *SPAN).agg(F.sum("n").alias("rows"))
    places = []
    for k, q in enumerate(points):
        h = (F.col("rows") - 1) * F.lit(q)
        for step in (0, 1):
            at = F.least(F.floor(h) + step, F.col("rows") - 1)
            places.append(F.struct(F.lit(k).alias("k"), F.lit(step).alias("part"), at.alias("at"), (h - F.floor(h)).alias("weight")))
    asked = keep(total.select(*GROUP, *SPAN, F.explode(F.array(*places)).alias("q")).select(*GROUP, *SPAN, "q.*"))
    wanted = keep(_choose(bins, asked))
    while not (open_ := wanted.where("lo < hi")).isEmpty():
        spans = open_.select(*GROUP, *SPAN).distinct()
        inside = ratios.join(spans, GROUP).where((F.col("r_min") <= F.col("hi")) & (F.col("r_max") >= F.col("lo")))
        rows = with_lists(slim, keep(_lists(inside))).select("AgeMonths", "r", F.explode(F.expr("filter(list, b -> r BETWEEN b.lo AND b.hi)")).alias("b"))
        hits = rows.select("b.*", "AgeMonths", "r").withColumn("bin", _bin(F.col("lo"), F.col("hi")))
        bins = hits.groupBy(*GROUP, *SPAN, "bin").agg(n, least, most)
        wanted = keep(wanted.where("lo = hi").unionByName(_choose(bins, open_)))
    found = wanted.select(*GROUP, "k", "part", "lo").join(asked.select(*GROUP, "k", "part", "weight"), [*GROUP, "k", "part"])
    of = lambda c, k, part: F.max(F.when((F.col("k") == k) & (F.col("part") == part), F.col(c)))
    return found.groupBy(*GROUP).agg(*[(of("lo", k, 0) + (of("lo", k, 1) - of("lo", k, 0)) * of("weight", k, 1)).alias(f"q{k}") for k in range(len(points))])


def iqr_bounds(quartiles: DataFrame, k: float) -> DataFrame:
    """(Schedule, AgeMonths, lo, hi) from the first and the third quartile."""
    spread = F.lit(k) * (F.col("q1") - F.col("q0"))
    return quartiles.select(*GROUP, (F.col("q0") - spread).alias("lo"), (F.col("q1") + spread).alias("hi"))


def _lists(spans: DataFrame) -> DataFrame:
    """Per class and age the schedules with their bounds."""
    return spans.groupBy(*CLASS, "AgeMonths").agg(F.collect_list(F.struct("Schedule", *SPAN)).alias("list"))


def outside(slim: DataFrame, ratios: DataFrame, bounds: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(Schedule, AgeMonths) -> n, sy, ss of the rows beyond the bounds, read from the class cells whose range leaves them."""
    leaving = keep(_lists(ratios.join(bounds, GROUP).where("r_min < lo OR r_max > hi OR lo IS NULL")))
    rows = with_lists(slim, leaving).select("AgeMonths", "y", F.explode(F.expr("filter(list, b -> b.lo IS NULL OR r < b.lo OR r > b.hi)")).alias("b"))
    n = F.count(F.lit(1))
    return rows.select("b.Schedule", "AgeMonths", "y").groupBy(*GROUP).agg(n.alias("n_off"), F.sum("y").alias("sy_off"), (F.var_pop("y") * n).alias("ss_off"))


def without(cells: DataFrame, off: DataFrame) -> DataFrame:
    """The cells less the rows outside; a cell that loses all its rows goes."""
    left = F.col("n") - F.col("n_off")
    sy = F.col("sy") - F.col("sy_off")
    moment = F.col("ss") + F.col("sy") ** 2 / F.col("n") - F.col("ss_off") - F.col("sy_off") ** 2 / F.col("n_off")
    touched = F.col("n_off").isNotNull()
    new = {"n": left, "sy": sy, "ss": F.greatest(F.lit(0.0), moment - sy**2 / left)}
    j = cells.join(off, GROUP, "left").where(~touched | (left > 0))
    return j.select(*[F.when(touched, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in cells.columns])


def ratio_filter(slim: DataFrame, closed: DataFrame, cells: DataFrame, p: Params, keep: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(cells without the rows beyond the bounds, the bounds) by ``p.outlier``."""
    ratios = keep(assign_by_closure(ratio_cells(slim), closed))
    if p.outlier == "ratio_sd":
        bounds = sd_bounds(ratios, cells, p.ratio_multiplier)
    elif p.outlier == "iqr":
        bounds = iqr_bounds(quantiles(slim, ratios, closed, cells, p, (0.25, 0.75), keep), p.ratio_multiplier)
    else:
        raise ValueError(f"outlier is one of {MODES}")
    bounds = keep(bounds)
    return keep(without(cells, outside(slim, ratios, bounds, keep))), bounds
