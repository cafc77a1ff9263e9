"""Every predicate of the extracts and rules rejects or changes something on the sf0.01 fixtures, so a
green comparison with the oracle says something about it."""

import pytest
from pyspark.sql import functions as F

from depreco.config import FIXTURE_PARAMS as P
from depreco.operators import decay as D
from depreco.plans.pipeline import Run
from depreco.sources import extracts as X
from depreco.sources import fixtures as FX

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def run(spark):
    r = Run(FX.load_inputs(spark, SF, P), P).prepare()
    yield r
    r.close()


def some(df, condition) -> bool:
    return not df.where(condition).limit(1).isEmpty()


def test_cost_filters(run):
    c = run.inputs.cost_assets
    start, end = P.cost_window
    customer = (F.col("CustomerId") == P.excluded_customer)
    rejects = {
        "category": F.col("CategoryId").isin(*P.excluded_categories), "make": F.col("MakeId").isin(*P.excluded_makes),
        "no subcategory": F.col("SubcategoryId").isNull(), "flag": F.col("IsUsedForABCostUSNA") == "N", "used": F.col("IsPurchasedUsed") == "Y",
        "before": F.col("AcquisitionDate") <= F.lit(start), "after": F.col("AcquisitionDate") > F.lit(end), "null cost": F.col("CurrentABCostUSNA").isNull(),
        "small cost": F.col("Cost") <= P.min_asset_cost, "prefix": customer & F.col("EquipNo").ilike(f"{P.excluded_equipno_prefix}%"),
        "suffix": customer & F.col("EquipNo").ilike(f"%{P.excluded_equipno_suffix}"),
    }
    assert [k for k, v in rejects.items() if not some(c, v)] == []


def test_sale_and_taxonomy_filters(run):
    assert some(run.inputs.comparables, F.col("Cost") <= P.min_comparable_cost)
    k = run.inputs.classifications
    assert some(k, F.col("CategoryName").startswith(P.taxonomy_excluded_name_prefix))
    assert some(k, F.col("CategoryId").isin(*P.taxonomy_excluded_categories))


def test_missing_percentages_make_means_missing(run):
    assert some(X.auction_published(run.inputs.class_values, P), F.col("AvgFlv").isNull())
    assert some(run.auction_means, F.col("ratio").isNull())


def test_age_filter_drops_rows(run):
    slim = D.regression_input(X.cost_extract(run.inputs.cost_assets, P), P)
    assert some(D.sd_filter_cells(D.age_cells(slim, run.schedules), P.sd_multiplier), ~F.col("keep"))


def test_missing_ids_are_assigned(run):
    slim = D.regression_input(X.cost_extract(run.inputs.cost_assets, P), P)
    assert some(D.age_cells(slim, run.schedules), F.col("Schedule") == "CS none")


def test_recency_band_moves_factors(run):
    assert some(run.recency, F.abs(F.col("recency") - F.col("shrunk")) > 1e-9)


def test_classes_mapped_twice_occur(run):
    assert some(run.outputs, F.col("mapped") > 1)
    checks = {r.check: r.ok for r in run.checks.collect()}
    assert checks["classes_mapped_once"] is False and checks["unique_MarketCode_ClassificationId"] is True
