"""Registered queries: one Spark DataFrame builder and one DuckDB oracle per operator.

Every builder takes ``(spark, sf_dir)`` and derives the logical inputs from the driver's tables
(``depreco.sources.fixtures``). The queries of a run's later stages execute the run's written stages
while they are built; what they return is lazy. Computed doubles are rounded to 6 places on both
sides so results compare exactly across engines.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depreco.config import FIXTURE_PARAMS as P
from depreco.functions import r6
from depreco.operators import decay as D
from depreco.operators import publish as PB
from depreco.operators import ratios as R
from depreco.operators import outliers as OU
from depreco.operators.assign import CLASS as CLASS_IDS
from depreco.operators.assign import assign_by_closure, closure
from depreco.plans import oracle as O
from depreco.plans.pipeline import Run
from depreco.sources import extracts as X
from depreco.sources import fixtures as FX
from depreco.sources import maps as M

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

NAMES = ["CategoryId", "CategoryName", "SubcategoryId", "SubcategoryName", "MakeId", "MakeName"]
CLASS = ["ClassificationId", *NAMES]

#: An as-of date whose month before has a 30th and whose month before that has no such day left over:
#: the day-preserving step back does not land on a month's end.
CLAMPED = P.with_(as_of=date(2001, 5, 15))


def register(name: str, oracle: str, as_of: date = P.as_of, points: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        ORACLES[name] = O.query(oracle, as_of, points)
        return fn

    return deco


def _round(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: r6(c) for c in cols})


def cost_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.cost_extract(FX.cost_assets(spark, sf_dir), P)


def schedules_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.schedule_inputs(FX.in_map(spark, sf_dir), FX.in_borrow_map(spark, sf_dir), P)


def stages(spark: SparkSession, sf_dir: str, p=P) -> Run:
    return Run(FX.load_inputs(spark, sf_dir, p), p)


def full_run(spark: SparkSession, sf_dir: str) -> Run:
    """A run whose three fact passes are materialized side by side (for class-level stages)."""
    return stages(spark, sf_dir).prepare()


# -- sources and their filters (SRC-01..13) --------------------------------------------------------
COST_COLS = ["CustomerAssetId", "CustomerId", "CustomerName", "EquipNo", *NAMES, "ModelId", "ModelName",
             "ModelYear", "AcquisitionDate", "Cost"]


@register("cost_assets_filtered", f"SELECT {', '.join(COST_COLS)}, {O.r6('CurrentABCostUSNA', 'CostRatio')}, Age, Flag FROM costs")
def q_cost_assets_filtered(spark, sf_dir):
    return _round(cost_rows(spark, sf_dir).select(*COST_COLS, "CurrentABCostUSNA", "CostRatio", "Age", "Flag"), ["CurrentABCostUSNA", "CostRatio"])


@register("ratio_band_flag", f"""
SELECT CategoryId, ModelYear, Flag, count(*) AS n, r6(avg(CostRatio)) AS avg_ratio, r6(min(CostRatio)) AS min_ratio, r6(max(CostRatio)) AS max_ratio
FROM costs WHERE Age BETWEEN {P.cost_age_low} AND {P.cost_age_high} GROUP BY CategoryId, ModelYear, Flag""")
def q_ratio_band_flag(spark, sf_dir):
    c = cost_rows(spark, sf_dir).where(F.col("Age").between(P.cost_age_low, P.cost_age_high))
    return c.groupBy("CategoryId", "ModelYear", "Flag").agg(
        F.count(F.lit(1)).alias("n"), r6(F.avg("CostRatio")).alias("avg_ratio"),
        r6(F.min("CostRatio")).alias("min_ratio"), r6(F.max("CostRatio")).alias("max_ratio"),
    )


def _sales_sql(keys: str, where: str) -> str:
    return f"SELECT {O.NAMES}, {keys}, r6(avg(ratio)) AS SPCost, count(*) AS Units FROM sales WHERE {where} GROUP BY {O.NAMES}, {keys}"


@register("retail_recession_agg", _sales_sql("ModelYear, yearAge", f"SaleYear = {P.recession_year}"))
def q_retail_recession(spark, sf_dir):
    return _round(X.retail_recession(FX.comparables(spark, sf_dir), P), ["SPCost"])


@register("retail_current_agg", _sales_sql("ModelYear, SaleMonth, yearAge", "in_year"))
def q_retail_current(spark, sf_dir):
    return _round(X.retail_current(FX.comparables(spark, sf_dir), P), ["SPCost"])


@register("retail_best_agg", _sales_sql("SaleYear, ModelYear, yearAge", f"SaleYear IN ({', '.join(map(str, P.best_years))})"))
def q_retail_best(spark, sf_dir):
    return _round(X.retail_best(FX.comparables(spark, sf_dir), P), ["SPCost"])


def _values_sql(period: str) -> str:
    return f"SELECT {O.CLASS}, PublishYear, ModelYear, {O.r6('AvgFlv', 'AvgFmv')} FROM value_means WHERE period = '{period}'"


def _values(df: DataFrame) -> DataFrame:
    return _round(df.select(*CLASS, "PublishYear", "ModelYear", "AvgFlv", "AvgFmv"), ["AvgFlv", "AvgFmv"])


@register("auction_recession_agg", _values_sql("recession"))
def q_auction_recession(spark, sf_dir):
    return _values(X.auction_recession(FX.class_values(spark, sf_dir), P))


@register("auction_current_agg", _values_sql("current"))
def q_auction_current(spark, sf_dir):
    return _values(X.auction_current(FX.class_values_in_progress(spark, sf_dir, P), P))


@register("auction_best_agg", _values_sql("best"))
def q_auction_best(spark, sf_dir):
    return _values(X.auction_best(FX.class_values(spark, sf_dir), P))


@register("taxonomy_parents", "SELECT * FROM taxonomy")
def q_taxonomy_parents(spark, sf_dir):
    return X.taxonomy_parents(FX.classifications(spark, sf_dir), P)


LAST_MONTH = ["ResidSf", "RetailEconSfBest", "RetailEconSfWorst", "AuctionEconSfBest", "AuctionEconSfWorst"]


@register("last_month_lookup", f"SELECT * REPLACE ({O.r6(*LAST_MONTH)}) FROM previous")
def q_last_month(spark, sf_dir):
    return _round(X.last_month(FX.last_month_factors(spark, sf_dir, P), P), LAST_MONTH)


@register("schedule_maps", "SELECT * FROM feeds")
def q_schedule_maps(spark, sf_dir):
    return schedules_in(spark, sf_dir)


@register("schedule_outputs", "SELECT * FROM readers")
def q_schedule_outputs(spark, sf_dir):
    return M.schedule_outputs(FX.out_map(spark, sf_dir), FX.out_borrow_map(spark, sf_dir), P)


# -- schedule assignment (DOM-01) --------------------------------------------------------------------
@register("schedule_assignment", f"SELECT Schedule, CustomerAssetId, ModelYear, Age, {O.r6('CostRatio')}, Flag FROM scheduled_costs")
def q_schedule_assignment(spark, sf_dir):
    rows, run = cost_rows(spark, sf_dir), stages(spark, sf_dir)
    a = assign_by_closure(rows, run.keep(closure(rows.select(*CLASS_IDS), run.schedules)))
    return a.select("Schedule", "CustomerAssetId", "ModelYear", "Age", r6("CostRatio").alias("CostRatio"), "Flag")


# -- outlier removal and the decay factor (DOM-02..04) -------------------------------------------------
SD_TEST_K = 1.2


@register("age_sd_filter", f"""
SELECT Schedule, count(*) AS rows_in, count(*) FILTER (abs(AgeMonths - mid) <= {SD_TEST_K} * spread) AS rows_kept,
       r6(max(mid)) AS mean_months, r6(max(spread)) AS sd_months FROM aged GROUP BY Schedule""")
def q_age_sd_filter(spark, sf_dir):
    slim = D.regression_input(cost_rows(spark, sf_dir), P)
    cells = D.sd_filter_cells(D.age_cells(slim, schedules_in(spark, sf_dir)), SD_TEST_K)
    return cells.groupBy("Schedule").agg(
        F.first("N_in").alias("rows_in"),
        F.sum(F.when(F.col("keep"), F.col("n")).otherwise(0)).alias("rows_kept"),
        r6(F.first("mean_m")).alias("mean_months"), r6(F.first("sd_m")).alias("sd_months"),
    )


@register("cooks_distance", """
SELECT Schedule, max(n) AS n, r6(max(intercept)) AS intercept, r6(max(slope)) AS slope, r6(max(s2)) AS s2,
       r6(max(mean_cook)) AS mean_cooks, count(*) FILTER (far) AS n_influential FROM judged GROUP BY Schedule""")
def q_cooks_distance(spark, sf_dir):
    d = stages(spark, sf_dir).decay.where(F.col("rows_in") >= P.min_fit_rows)
    cols = ["intercept", "slope", "s2", "mean_cooks"]
    return _round(d.select("Schedule", F.col("rows_in").alias("n"), *cols, "n_influential"), cols)


@register("decay_factor", f"SELECT Schedule, rows_in, n, {O.r6('factor')} FROM decay")
def q_decay_factor(spark, sf_dir):
    return _round(stages(spark, sf_dir).decay.select("Schedule", "rows_in", "n", "factor"), ["factor"])


# Multipliers at which the filters drop rows of the fixtures.
RATIO_SD = P.with_(outlier="ratio_sd", ratio_multiplier=1.5)
RATIO_IQR = P.with_(outlier="iqr", ratio_multiplier=0.5)


def _decay_with(p):
    return lambda spark, sf_dir: _round(
        stages(spark, sf_dir, p).decay.select("Schedule", "rows_in", "n", F.coalesce("n_influential", F.lit(0)).alias("n_influential"), "factor"), ["factor"]
    )


for _name, _p in (("decay_factor_ratio_sd", RATIO_SD), ("decay_factor_iqr", RATIO_IQR)):
    register(_name, f"""SELECT d.Schedule, d.rows_in, d.n, coalesce(f.n, 0) AS n_influential, {O.r6('d.factor').replace('AS d.factor', 'AS factor')}
    FROM decay d LEFT JOIN (SELECT Schedule, count(*) AS n FROM judged WHERE far GROUP BY Schedule) f ON f.Schedule = d.Schedule""",
             points=O.ratio_points(_p.outlier, _p.ratio_multiplier))(_decay_with(_p))


@register("ratio_quartiles", f"SELECT Schedule, AgeMonths, n, {O.r6('low', 'high')} FROM quartiles")
def q_ratio_quartiles(spark, sf_dir):
    run = stages(spark, sf_dir)
    slim = run.regression_rows
    classes = run.keep(D.class_cells(slim))
    closed = run.keep(closure(classes, run.schedules))
    cells = run.keep(D.sd_filter_cells(D.merge_cells(assign_by_closure(classes, closed)), P.sd_multiplier).where("keep"))
    ratios = run.keep(assign_by_closure(OU.ratio_cells(slim), closed))
    found = OU.quantiles(slim, ratios, closed, cells, P, (0.25, 0.75), run.keep)
    return _round(cells.select("Schedule", "AgeMonths", "n").join(found, ["Schedule", "AgeMonths"]).select("Schedule", "AgeMonths", "n", F.col("q0").alias("low"), F.col("q1").alias("high")), ["low", "high"])


@register("decay_by_class", f"SELECT '{P.market_code}' AS MarketCode, o.ClassificationId, r6(d.capped) AS ResidSF FROM readers o LEFT JOIN decay d ON d.Schedule = o.Schedule")
def q_decay_by_class(spark, sf_dir):
    return _round(stages(spark, sf_dir).decay_class, ["ResidSF"])


# -- economic factors (DOM-05..08) ---------------------------------------------------------------------
@register("weighted_rollup", "SELECT period, Schedule, SaleYear, yearAge, units AS totalunits, r6(mean) AS avg FROM buckets")
def q_weighted_rollup(spark, sf_dir):
    cells = stages(spark, sf_dir).retail_cells
    none = F.lit(None).cast("int").alias("SaleYear")
    parts = [
        R.rollup(cells, name, ["Schedule", "SaleYear", "yearAge"] if name == R.BEST else ["Schedule", "yearAge"])
        .select(F.lit(name).alias("period"), "Schedule", "SaleYear" if name == R.BEST else none, "yearAge", "totalunits", r6("avg").alias("avg"))
        for name in (R.RECESSION, R.CURRENT, R.BEST)
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("worst_retail_ratio", f"SELECT Schedule, {O.r6('factor')}, n AS recession_n, current_n FROM compared WHERE period = 'recession'")
def q_worst_retail_ratio(spark, sf_dir):
    return _round(stages(spark, sf_dir).worst_retail_ratio, ["factor"])


@register("best_retail_ratio", f"SELECT Schedule, SaleYear, {O.r6('factor')}, n AS best_n, current_n FROM compared WHERE period = 'best'")
def q_best_retail_ratio(spark, sf_dir):
    return _round(stages(spark, sf_dir).best_retail_ratio, ["factor"])


@register("best_year_pick", f"SELECT Schedule, {O.r6('factor')}, best_n, current_n, year FROM chosen")
def q_best_year_pick(spark, sf_dir):
    return _round(stages(spark, sf_dir).best_year_pick, ["factor"])


RECENCY = ["raw", "shrunk", "recency"]


@register("recency_factor", f"SELECT Schedule, n, {O.r6(*RECENCY)} FROM recency")
def q_recency_factor(spark, sf_dir):
    return _round(stages(spark, sf_dir).recency, RECENCY)


@register("recency_factor_clamped", f"SELECT Schedule, n, {O.r6(*RECENCY)} FROM recency", CLAMPED.as_of)
def q_recency_factor_clamped(spark, sf_dir):
    return _round(stages(spark, sf_dir, CLAMPED).recency, RECENCY)


@register("schedule_list_outer", f"SELECT Schedule, {O.r6('factor')} FROM families WHERE kind = 'worst_retail'")
def q_schedule_list_outer(spark, sf_dir):
    return _round(full_run(spark, sf_dir).worst_out, ["factor"])


@register("recency_by_class", f"SELECT ClassificationId, {O.r6('recency')} FROM class_recency")
def q_recency_by_class(spark, sf_dir):
    return _round(stages(spark, sf_dir).recency_class, ["recency"])


AUCTION = ["mean_flv", "mean_fmv", "ratio"]


@register("auction_ratio", f"SELECT period, Schedule, PublishYear, {O.r6(*AUCTION)} FROM auction")
def q_auction_ratio(spark, sf_dir):
    return _round(stages(spark, sf_dir).auction_means, AUCTION)


# -- inheritance and publication (DOM-09..18) -------------------------------------------------------------
@register("global_value", f"SELECT kind, r6(value) AS glob FROM overall")
def q_global_value(spark, sf_dir):
    return _round(full_run(spark, sf_dir).globals, ["glob"])


@register("inherit_factor", f"SELECT ClassificationId, {O.r6('factor')}, resolved_from FROM resolved WHERE kind = 'worst_retail'")
def q_inherit_factor(spark, sf_dir):
    return _round(full_run(spark, sf_dir).worst_class.select("ClassificationId", "factor", "resolved_from"), ["factor"])


@register("retail_worst", "SELECT ClassificationId, r6(worst) AS SFWorstRetail FROM retail")
def q_retail_worst(spark, sf_dir):
    return _round(full_run(spark, sf_dir).worst_retail, ["SFWorstRetail"])


@register("retail_best", "SELECT ClassificationId, r6(best) AS SFBestRetail FROM retail")
def q_retail_best(spark, sf_dir):
    return _round(full_run(spark, sf_dir).best_retail, ["SFBestRetail"])


@register("auction_worst", f"SELECT ClassificationId, {O.r6('SFWorstAuction')} FROM sheet WHERE auctioned")
def q_auction_worst(spark, sf_dir):
    return _round(full_run(spark, sf_dir).worst_auction, ["SFWorstAuction"])


@register("auction_best", f"SELECT ClassificationId, {O.r6('SFBestAuction')} FROM sheet")
def q_auction_best(spark, sf_dir):
    return _round(full_run(spark, sf_dir).best_auction, ["SFBestAuction"])


FACTOR_SQL = f"SELECT MarketCode, ClassificationId, {O.r6(*PB.FACTORS)}"


@register("factor_assembly", f"{FACTOR_SQL} FROM sheet")
def q_factor_assembly(spark, sf_dir):
    return _round(full_run(spark, sf_dir).assembled, PB.FACTORS)


@register("global_row", f"{FACTOR_SQL} FROM top")
def q_global_row(spark, sf_dir):
    return _round(full_run(spark, sf_dir).global_row, PB.FACTORS)


@register("gap_enforced", f"{FACTOR_SQL} FROM spread")
def q_gap_enforced(spark, sf_dir):
    return _round(full_run(spark, sf_dir).gapped, PB.FACTORS)


LAST_COLS = ["Residlm", "RetailEconSfBest", "RetailEconSfWorst", "AuctionEconSfBest", "AuctionEconSfWorst"]


@register("mom_limited", f"{FACTOR_SQL}, {O.r6(*LAST_COLS)} FROM published")
def q_mom_limited(spark, sf_dir):
    s = full_run(spark, sf_dir).limited
    return _round(s.select("MarketCode", "ClassificationId", *PB.FACTORS, *LAST_COLS), PB.FACTORS + LAST_COLS)


@register("mom_delta", """
SELECT MarketCode, ClassificationId, r6(ResidSF / nullif(Residlm, 0) - 1) AS MoMResid, r6(SFBestRetail - RetailEconSfBest) AS MoMBestRet,
       r6(SFWorstRetail - RetailEconSfWorst) AS MoMWorstRet, r6(SFBestAuction - AuctionEconSfBest) AS MoMBestAuc,
       r6(SFWorstAuction - AuctionEconSfWorst) AS MoMWorstAuc FROM published""")
def q_mom_delta(spark, sf_dir):
    s = full_run(spark, sf_dir).review
    return _round(s.select("MarketCode", "ClassificationId", *PB.DELTAS), list(PB.DELTAS))


@register("reconciliation_checks", """
SELECT *, lhs = rhs AS ok FROM (
  SELECT unnest(['decay_vs_best_retail', 'decay_vs_worst_retail', 'decay_vs_best_auction']) AS "check",
         (SELECT count(*) FROM readers) AS lhs, (SELECT count(*) FROM retail) AS rhs
  UNION ALL SELECT 'decay_vs_worst_auction', (SELECT count(*) FROM readers), (SELECT count(*) FROM sheet WHERE auctioned)
  UNION ALL SELECT 'classes_mapped_once', (SELECT CAST(sum(mapped) AS BIGINT) FROM readers), (SELECT count(*) FROM readers)
  UNION ALL SELECT 'classes_in_taxonomy', (SELECT count(*) FROM readers), (SELECT count(*) FROM readers o WHERE ClassificationId IN (SELECT ClassificationId FROM taxonomy))
  UNION ALL SELECT 'schedules_known', (SELECT count(*) FROM readers), (SELECT count(*) FROM readers o WHERE Schedule IN (SELECT Schedule FROM feeds))
  UNION ALL SELECT 'unique_MarketCode_ClassificationId', (SELECT count(DISTINCT (MarketCode, ClassificationId)) FROM published), (SELECT count(*) FROM published)) c""")
def q_reconciliation_checks(spark, sf_dir):
    return full_run(spark, sf_dir).checks


@register("map_orphans", """
SELECT ClassificationId, Schedule, ClassificationId IN (SELECT ClassificationId FROM taxonomy) AS in_taxonomy, Schedule IN (SELECT Schedule FROM feeds) AS schedule_known
FROM readers WHERE ClassificationId NOT IN (SELECT ClassificationId FROM taxonomy) OR Schedule NOT IN (SELECT Schedule FROM feeds)""")
def q_map_orphans(spark, sf_dir):
    return stages(spark, sf_dir).integrity.where(~F.col("in_taxonomy") | ~F.col("schedule_known"))


@register("published_factors", f"{FACTOR_SQL} FROM published")
def q_published_factors(spark, sf_dir):
    return _round(full_run(spark, sf_dir).upload, PB.FACTORS)
