"""Row filters and derived columns of the nine source extracts.

Each function takes the raw relation and returns a lazy DataFrame. Predicates are native
Column expressions on source columns, so Catalyst pushes the simple ones into the Parquet
scan and prunes unused columns. Date bounds are literals computed from ``Params.as_of``.
String flags are compared case-insensitively (the source database collation is).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depreco.config import Params
from depreco.functions import age_months, age_years, age_years_4dp, safe_div, year_age

CLASS_KEYS = ["ClassificationId", "CategoryId", "CategoryName", "SubcategoryId", "SubcategoryName", "MakeId", "MakeName"]
NAME_KEYS = ["CategoryId", "CategoryName", "SubcategoryId", "SubcategoryName", "MakeId", "MakeName"]


def _ieq(c: str, value: str) -> Column:
    """Case-insensitive equality; a one-letter flag as a plain list, which reaches the scan."""
    if len(value) == 1:
        return F.col(c).isin(value.lower(), value.upper())
    return F.lower(F.col(c)) == value.lower()


def taxonomy_exclusions(p: Params, with_composite: bool = True) -> Column:
    """Category / make exclusion lists and the composite model rule.

    ``NOT IN`` drops NULL ids too (three-valued logic), exactly as the SQL did.
    """
    cond = ~F.col("CategoryId").isin(*p.excluded_categories) & ~F.col("MakeId").isin(*p.excluded_makes)
    if with_composite:
        composite = (
            F.col("SubcategoryId").isin(*p.composite_subcategories)
            & (F.col("MakeId") == p.composite_make)
            & ~F.col("ModelName").ilike(f"{p.composite_model_prefix}%")
        )
        cond = cond & ~composite
    return cond


# -- SRC-01: asset costs ------------------------------------------------------------------------
def cost_extract(cost_assets: DataFrame, p: Params) -> DataFrame:
    """Purchased-new assets of the last 144 months with cost ratio, age and band flag (DOM-02)."""
    start, end = p.cost_window
    eff = p.effective_date
    customer_rule = (F.col("CustomerId") == p.excluded_customer) & (
        F.col("EquipNo").ilike(f"{p.excluded_equipno_prefix}%") | F.col("EquipNo").ilike(f"%{p.excluded_equipno_suffix}")
    )
    rows = cost_assets.where(
        _ieq("IsUsedForABCostUSNA", "Y")
        & _ieq("IsPurchasedUsed", "N")
        & taxonomy_exclusions(p)
        & (F.col("AcquisitionDate") > F.lit(start))
        & (F.col("AcquisitionDate") <= F.lit(end))
        & F.col("CurrentABCostUSNA").isNotNull()
        & (F.col("Cost") > p.min_asset_cost)
        & ~customer_rule
    )
    months = age_months(eff, "ModelYear")
    rows = rows.withColumns(
        {"CostRatio": safe_div(F.col("CurrentABCostUSNA"), F.col("Cost")), "AgeMonths": months}
    )
    return rows.select(
        "CustomerAssetId", "CustomerId", "CustomerName", "EquipNo", *NAME_KEYS, "ModelId", "ModelName",
        "ModelYear", "AcquisitionDate", "Cost", "CurrentABCostUSNA", "CostRatio",
        age_years_4dp("AgeMonths").alias("Age"),
        band_flag(F.col("CostRatio"), age_years("AgeMonths"), p).alias("Flag"),
        "AgeMonths",
    )


def band_flag(ratio: Column, age: Column, p: Params) -> Column:
    """DOM-02: 'inUse' when low_a + low_b*age <= ratio <= high_a + high_b*age, else 'EcxRegr'."""
    (la, lb), (ha, hb) = p.band_low, p.band_high
    out = (ratio > F.lit(ha) + F.lit(hb) * age) | (ratio < F.lit(la) + F.lit(lb) * age)
    return F.when(out, F.lit("EcxRegr")).otherwise(F.lit("inUse"))


# -- SRC-02..04: retail comparables ---------------------------------------------------------------
def retail_rows(comparables: DataFrame, p: Params) -> DataFrame:
    """Retail sales passing the common age / ratio / cost / taxonomy rules (any period)."""
    lo, hi = p.retail_age_open
    ca_lo, ca_hi = p.cost_to_ab_band
    pm_lo, pm_hi = p.price_to_m1_band
    m = age_months("SaleDate", "ModelYear")
    cost_ab = safe_div(F.col("Cost"), F.col("CurrentABCostUSNA"))
    price_m1 = safe_div(F.col("SalePrice"), F.col("M1PrecedingFmv"))
    price_cost = safe_div(F.col("SalePrice"), F.col("Cost"))
    rows = comparables.where(
        _ieq("saletype", "retail")
        & _ieq("IsUsedForComparablesUSNA", "y")
        & (m > lo * 12)
        & (m < hi * 12)
        & (cost_ab < ca_hi) & (cost_ab > ca_lo)
        & (price_m1 < pm_hi) & (price_m1 > pm_lo)
        & (price_cost < p.max_price_to_cost)
        & (F.col("Cost") > p.min_comparable_cost)
        & taxonomy_exclusions(p)
    )
    return rows.withColumns({"yearAge": year_age(m), "SPCost": price_cost, "SaleMonth": F.last_day("SaleDate")})


def recession_period(p: Params) -> Column:
    return F.col("SaleYear") == p.recession_year


def current_period(p: Params) -> Column:
    start, end = p.current_window
    return (F.col("SaleDate") > F.lit(start)) & (F.col("SaleDate") <= F.lit(end))


def best_period(p: Params) -> Column:
    return F.col("SaleYear").between(min(p.best_years), max(p.best_years))


def _retail_agg(rows: DataFrame, keys: list) -> DataFrame:
    return rows.groupBy(*keys).agg(F.avg("SPCost").alias("SPCost"), F.count(F.lit(1)).alias("Units"))


def retail_recession(comparables: DataFrame, p: Params) -> DataFrame:
    rows = retail_rows(comparables, p).where(recession_period(p))
    return _retail_agg(rows, [*NAME_KEYS, "ModelYear", "yearAge"])


def retail_current(comparables: DataFrame, p: Params) -> DataFrame:
    rows = retail_rows(comparables, p).where(current_period(p))
    return _retail_agg(rows, [*NAME_KEYS, "ModelYear", "SaleMonth", "yearAge"])


def retail_best(comparables: DataFrame, p: Params) -> DataFrame:
    rows = retail_rows(comparables, p).where(best_period(p))
    return _retail_agg(rows, [*NAME_KEYS, "SaleYear", "ModelYear", "yearAge"])


# -- SRC-05..07: published and in-progress schedule values ----------------------------------------
def auction_rows(values: DataFrame, p: Params) -> DataFrame:
    lo, hi = p.auction_age_band
    return values.where(
        F.col("ModelId").isNull()
        & F.col("ModelYear").between(F.col("PublishYear") - hi, F.col("PublishYear") - lo)
        & taxonomy_exclusions(p, with_composite=False)
    )


def _auction_agg(rows: DataFrame, keys: list) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.avg("FlvSchedulePercentage").alias("AvgFlv"), F.avg("FmvSchedulePercentage").alias("AvgFmv")
    )


def auction_recession(class_values: DataFrame, p: Params) -> DataFrame:
    start, end = p.recession_publish_window
    rows = auction_rows(class_values.where(F.col("AppraisalBookPublishDate").between(F.lit(start), F.lit(end))), p)
    return _auction_agg(rows, [*CLASS_KEYS, "PublishYear", "ModelYear"])


def auction_best(class_values: DataFrame, p: Params) -> DataFrame:
    rows = auction_rows(class_values.where(F.col("PublishYear").between(min(p.best_years), max(p.best_years))), p)
    return _auction_agg(rows, [*CLASS_KEYS, "PublishYear", "ModelYear"])


def auction_published(class_values: DataFrame, p: Params) -> DataFrame:
    """The recession and best-year extracts from one scan: (period, class, PublishYear, ModelYear, means).

    Each period's mean is a conditional aggregate over the same groups; groups are split by period
    after the aggregation."""
    start, end = p.recession_publish_window
    recession = F.col("AppraisalBookPublishDate").between(F.lit(start), F.lit(end))
    best = F.col("PublishYear").between(min(p.best_years), max(p.best_years))
    rows = auction_rows(class_values.where(recession | best), p)

    def means(name: str, inside: Column):
        return F.when(F.count(F.when(inside, 1)) > 0, F.struct(
            F.lit(name).alias("period"), F.avg(F.when(inside, F.col("FlvSchedulePercentage"))).alias("AvgFlv"),
            F.avg(F.when(inside, F.col("FmvSchedulePercentage"))).alias("AvgFmv"),
        ))

    both = F.array(means("recession", recession), means("best", best))
    g = rows.groupBy(*CLASS_KEYS, "PublishYear", "ModelYear").agg(F.array_compact(both).alias("m"))
    return g.select(*CLASS_KEYS, "PublishYear", "ModelYear", F.explode("m").alias("m")).select(
        "m.period", *CLASS_KEYS, "PublishYear", "ModelYear", "m.AvgFlv", "m.AvgFmv"
    )


def auction_current(in_progress: DataFrame, p: Params) -> DataFrame:
    """Values being prepared for the coming issue; the publish year is the effective month's and
    the model-year band follows the calendar year of ``as_of`` (they differ in January)."""
    my_lo, my_hi = p.current_model_years
    rows = in_progress.where(
        F.col("ModelId").isNull()
        & F.col("ModelYear").between(my_lo, my_hi)
        & taxonomy_exclusions(p, with_composite=False)
    )
    agg = _auction_agg(rows, [*CLASS_KEYS, "ModelYear"])
    return agg.select(*CLASS_KEYS, F.lit(p.current_publish_year).alias("PublishYear"), "ModelYear", "AvgFlv", "AvgFmv")


# -- SRC-08 + DOM-16: taxonomy with parent ids -------------------------------------------------
def taxonomy_parents(classifications: DataFrame, p: Params) -> DataFrame:
    """Every class above model level with the id of its subcategory (CS) and category (C) class."""
    cs = classifications.where(F.col("MakeId").isNull() & F.col("SubcategoryId").isNotNull()).select(
        F.col("ClassificationId").alias("CS_ClassId"), F.col("CategoryId").alias("_cs_cat"),
        F.col("SubcategoryId").alias("_cs_sub"),
    )
    c = classifications.where(F.col("SubcategoryId").isNull() & F.col("CategoryId").isNotNull()).select(
        F.col("ClassificationId").alias("C_ClassId"), F.col("CategoryId").alias("_c_cat"),
    )
    excluded = F.col("CategoryId").isin(*p.taxonomy_excluded_categories) | F.col("CategoryName").ilike(
        f"{p.taxonomy_excluded_name_prefix}%"
    )
    bic = classifications.where(F.col("ModelId").isNull() & ~excluded)
    out = bic.join(
        cs, (bic.CategoryId == cs._cs_cat) & (bic.SubcategoryId == cs._cs_sub), "left"
    ).join(c, F.col("CategoryId") == c._c_cat, "left")
    return out.select(*CLASS_KEYS, "CS_ClassId", "C_ClassId")


# -- SRC-09: last month's published factors --------------------------------------------------------
def last_month(factors: DataFrame, p: Params) -> DataFrame:
    return factors.where(F.col("AppraisalBookPublishDate") == F.lit(p.last_month_date)).select(
        "MarketCode", "ClassificationId", *NAME_KEYS, "ResidSf", "RetailEconSfBest", "RetailEconSfWorst",
        "AuctionEconSfBest", "AuctionEconSfWorst", "AppraisalBookIssueID", "AppraisalBookPublishDate",
    )
