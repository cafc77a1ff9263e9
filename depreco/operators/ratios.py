"""Economic factors: period ratios, best-period pick, recency and auction ratios (DOM-05..08).

Retail. The three comparables extracts (recession year, rolling 12 months, candidate best
years) are one scan: sales are reduced by a single partial/final aggregate to class cells,
which are then tagged with every period they belong to, assigned to their schedules and
merged to the small "retail cells" table. All retail branches (worst, best per year, recency) read those cells, so the fact
is shuffled once and only as pre-aggregated rows.

The weighted average of per-extract-group means, sum(Units*SPCost)/sum(Units), is the plain
mean at sale grain, so cells keep (units, sum of ratios).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depreco.config import Params
from depreco.functions import greatest_na, least_na, mean_na, safe_div
from depreco.operators.assign import assign_schedules
from depreco.sources import extracts as X

RECESSION, CURRENT, BEST = "recession", "current", "best"


# -- retail cells ---------------------------------------------------------------------------
def class_cells(comparables: DataFrame, p: Params) -> DataFrame:
    """(class, SaleYear, ModelYear, yearAge, current, recent) -> units, sum of SalePrice/Cost: the only
    pass over the sales, one partial/final aggregate. The years that the periods can fall in are a
    conjunct of their own, so a table partitioned by sale year is pruned."""
    rec, cur, best = X.recession_period(p), X.current_period(p), X.best_period(p)
    start, end = p.current_window
    years = sorted({p.recession_year, *range(min(p.best_years), max(p.best_years) + 1), *range(start.year, end.year + 1)})
    rows = X.retail_rows(comparables.where(F.col("SaleYear").isin(*years) & (rec | cur | best)), p)
    recent = cur & F.col("SaleMonth").isin(*[F.lit(d) for d in p.recent_month_ends])
    return rows.groupBy(
        "CategoryId", "SubcategoryId", "MakeId", "SaleYear", "ModelYear", "yearAge", cur.alias("current"), recent.alias("recent")
    ).agg(F.count(F.lit(1)).alias("units"), F.sum("SPCost").alias("s"))


def retail_cells(comparables: DataFrame, schedules: DataFrame, p: Params) -> DataFrame:
    """(Schedule, period, SaleYear, ModelYear, yearAge, recent) -> units, sum of SalePrice/Cost.

    Class cells are tagged with every period they belong to and assigned. SaleYear is kept for
    the best-year period only; ModelYear and the recent-month flag for the current period only."""
    null_i = F.lit(None).cast("int")

    def tag(name: str, sy, my, recent):
        return F.struct(F.lit(name).alias("period"), sy.alias("sy"), my.alias("my"), recent.alias("recent"))

    tags = F.array(
        F.when(X.recession_period(p), tag(RECESSION, null_i, null_i, F.lit(False))),
        F.when(F.col("current"), tag(CURRENT, null_i, F.col("ModelYear"), F.col("recent"))),
        F.when(X.best_period(p), tag(BEST, F.col("SaleYear"), null_i, F.lit(False))),
    )
    cells = class_cells(comparables, p).select(
        "CategoryId", "SubcategoryId", "MakeId", "yearAge", "units", "s", F.explode(F.array_compact(tags)).alias("t")
    )
    return assign_schedules(cells, schedules).groupBy(
        "Schedule", F.col("t.period").alias("period"), F.col("t.sy").alias("SaleYear"),
        F.col("t.my").alias("ModelYear"), "yearAge", F.col("t.recent").alias("recent"),
    ).agg(F.sum("units").alias("units"), F.sum("s").alias("s"))


def rollup(cells: DataFrame, period: str, keys: list[str]) -> DataFrame:
    """AG-03: total units and unit-weighted mean ratio at ``keys``."""
    return cells.where(F.col("period") == period).groupBy(*keys).agg(
        F.sum("units").alias("totalunits"), (F.sum("s") / F.sum("units")).alias("avg")
    )


# -- DOM-05 ---------------------------------------------------------------------------------
def period_ratio(a: DataFrame, b: DataFrame, join_keys: list[str], group_keys: list[str], p: Params,
                 a_name: str = "a", b_name: str = "b") -> DataFrame:
    """Reliability-weighted ratio of period ``a`` to period ``b``.

    Per bucket: ratio = avg_a / avg_b, weight = min(n_a, n_b) * (n_a + n_b) (the mean of the
    minima in the original weight cancels in sum(w*r)/sum(w)); kept when both sides hold more
    than ``num_threshold`` units in total."""
    aa = a.select(*[c for c in a.columns if c not in ("totalunits", "avg")],
                  F.col("totalunits").alias("_na"), F.col("avg").alias("_aa"))
    bb = b.select(*join_keys, F.col("totalunits").alias("_nb"), F.col("avg").alias("_ab"))
    j = aa.join(bb, join_keys)
    ratio = safe_div(F.col("_aa"), F.col("_ab"))
    w = F.least(F.col("_na"), F.col("_nb")) * (F.col("_na") + F.col("_nb"))
    out = j.groupBy(*group_keys).agg(
        safe_div(F.sum(w * ratio), F.sum(w)).alias("factor"),
        F.sum("_na").alias(f"{a_name}_n"), F.sum("_nb").alias(f"{b_name}_n"),
    )
    thr = p.num_threshold
    return out.where((F.col(f"{a_name}_n") > thr) & (F.col(f"{b_name}_n") > thr))


def worst_retail_ratio(cells: DataFrame, p: Params) -> DataFrame:
    rec = rollup(cells, RECESSION, ["Schedule", "yearAge"])
    cur = rollup(cells, CURRENT, ["Schedule", "yearAge"])
    return period_ratio(rec, cur, ["Schedule", "yearAge"], ["Schedule"], p, "recession", "current")


def best_retail_ratio(cells: DataFrame, p: Params) -> DataFrame:
    """Per (Schedule, SaleYear) of the candidate years: best-year / current ratio."""
    best = rollup(cells, BEST, ["Schedule", "SaleYear", "yearAge"]).where(F.col("SaleYear").isin(*p.best_years))
    cur = rollup(cells, CURRENT, ["Schedule", "yearAge"])
    return period_ratio(best, cur, ["Schedule", "yearAge"], ["Schedule", "SaleYear"], p, "best", "current")


# -- DOM-06 ---------------------------------------------------------------------------------
def best_year_pick(per_year: DataFrame) -> DataFrame:
    """Max factor per schedule; ties go to the latest year. ``year`` is the chosen year."""
    cand = per_year.where(F.col("factor").isNotNull())
    best = F.max_by(F.struct("factor", "best_n", "current_n", "SaleYear"), F.struct("factor", "SaleYear"))
    return cand.groupBy("Schedule").agg(best.alias("b")).select(
        "Schedule", "b.factor", "b.best_n", "b.current_n", F.col("b.SaleYear").alias("year")
    )


# -- DOM-07 ---------------------------------------------------------------------------------
def recency_factor(cells: DataFrame, p: Params) -> DataFrame:
    """12-month mean ratio depreciated by half a year over the recent-months mean, weighted
    over model years, shrunk toward 1 for thin data and banded."""
    g = cells.where(F.col("period") == CURRENT).groupBy("Schedule", "ModelYear").agg(
        F.sum("units").alias("totalunits"), F.sum("s").alias("s_all"),
        F.sum(F.when(F.col("recent"), F.col("units"))).alias("units_recent"),
        F.sum(F.when(F.col("recent"), F.col("s"))).alias("s_recent"),
    ).where(F.col("units_recent") > 0)
    avg12 = F.col("s_all") / F.col("totalunits")
    avg_recent = F.col("s_recent") / F.col("units_recent")
    depr = avg12 * F.lit(p.monthly_decay ** p.halfyear_shift)
    factor = safe_div(depr, avg_recent)
    w = F.least(F.col("totalunits"), F.col("units_recent")) * (F.col("totalunits") + F.col("units_recent"))
    per = g.groupBy("Schedule").agg(
        safe_div(F.sum(factor * w), F.sum(w)).alias("raw"), F.sum("units_recent").alias("n")
    )
    thr, band = float(p.num_threshold), p.recency_band
    n, v0 = F.col("n"), F.col("raw")
    v1 = F.when(n > thr, v0).otherwise(((F.lit(thr) - n) + n * v0) / thr)
    lo = ((F.lit(thr) - n) + n * (1.0 - band)) / thr
    hi = ((F.lit(thr) - n) + n * (1.0 + band)) / thr
    rec = F.when(v1 < 1, greatest_na(lo, v1)).otherwise(least_na(hi, v1))
    return per.select("Schedule", "n", "raw", v1.alias("shrunk"), rec.alias("recency"))


def recency_by_class(recency: DataFrame, outputs: DataFrame) -> DataFrame:
    """Every output class with its schedule's recency factor; 1 where there is none."""
    j = outputs.select("ClassificationId", "Schedule").join(recency.select("Schedule", "recency"), "Schedule", "left")
    return j.select("ClassificationId", F.coalesce(F.col("recency"), F.lit(1.0)).alias("recency"))


# -- DOM-08 ---------------------------------------------------------------------------------
def auction_means(extracts: DataFrame, schedules: DataFrame) -> DataFrame:
    """Per (period, Schedule, PublishYear): mean of class FLV and FMV percentages and their ratio.
    A missing percentage makes the mean missing (no silent skipping)."""
    slim = extracts.select("period", "CategoryId", "SubcategoryId", "MakeId", "PublishYear", "AvgFlv", "AvgFmv")
    g = assign_schedules(slim, schedules).groupBy("period", "Schedule", "PublishYear").agg(
        mean_na("AvgFlv").alias("mean_flv"), mean_na("AvgFmv").alias("mean_fmv")
    )
    return g.withColumn("ratio", safe_div(F.col("mean_flv"), F.col("mean_fmv")))


def worst_auction_ratio(recession: DataFrame, current: DataFrame, p: Params) -> DataFrame:
    now = current.select("Schedule", F.col("ratio").alias("now"))
    j = recession.select("Schedule", "ratio").join(now, "Schedule")
    return j.select("Schedule", least_na(F.lit(p.worst_cap), safe_div(F.col("ratio"), F.col("now"))).alias("factor"))


def best_auction_ratio(best: DataFrame, current: DataFrame, p: Params) -> DataFrame:
    now = current.select("Schedule", F.col("ratio").alias("now"))
    j = best.select("Schedule", "PublishYear", "ratio").join(now, "Schedule")
    return j.select("Schedule", "PublishYear", greatest_na(F.lit(p.best_cap), safe_div(F.col("ratio"), F.col("now"))).alias("factor"))


def best_auction_for_pick(best_auc: DataFrame, retail_pick: DataFrame) -> DataFrame:
    """JN-16: the auction ratio of the year the retail side picked."""
    pick = retail_pick.select("Schedule", "year")
    j = pick.join(best_auc, (pick.Schedule == best_auc.Schedule) & (pick.year == best_auc.PublishYear))
    return j.select(pick.Schedule, best_auc.factor)


def on_schedule_list(factors: DataFrame, schedule_list: DataFrame) -> DataFrame:
    """JN-11: every schedule of the list, with its factor or NULL."""
    return schedule_list.select("Schedule").join(factors.select("Schedule", "factor"), "Schedule", "left")
