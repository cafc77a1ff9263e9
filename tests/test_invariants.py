"""Invariants of a full run on the sf0.01 tables (every inheritance branch and both sides of
each threshold occur there)."""

import pytest
from pyspark.sql import functions as F

from depreco.config import FIXTURE_PARAMS as P
from depreco.plans.pipeline import Run
from depreco.sources import fixtures as FX

SF = "/root/testdata/sf0.01"
EPS = 1e-12


@pytest.fixture(scope="module")
def run(spark):
    r = Run(FX.load_inputs(spark, SF, P), P).prepare()
    yield r
    r.close()


def _count(df, cond):
    return df.where(cond).count()


def test_caps(run):
    r = run.decay_class
    assert _count(r, (F.col("ResidSF") < P.resid_low) | (F.col("ResidSF") > P.resid_high)) == 0
    assert _count(run.worst_retail, F.col("SFWorstRetail") > P.worst_cap) == 0
    assert _count(run.best_retail, F.col("SFBestRetail") < P.best_cap) == 0


def test_gap_holds_before_limiter(run):
    g = run.gapped
    assert _count(g, F.col("SFWorstRetail") > F.col("SFBestRetail") - P.econ_gap + EPS) == 0
    assert _count(g, F.col("SFWorstAuction") > F.col("SFBestAuction") - P.econ_gap + EPS) == 0


def test_limiter_bound(run):
    s = run.review
    pairs = [("ResidSF", "Residlm"), ("SFBestRetail", "RetailEconSfBest"), ("SFWorstRetail", "RetailEconSfWorst"),
             ("SFBestAuction", "AuctionEconSfBest"), ("SFWorstAuction", "AuctionEconSfWorst")]
    for cur, last in pairs:
        assert _count(s, F.abs(F.col(cur) - F.col(last)) > P.mom_cap + EPS) == 0, cur
    # classes without a last-month value keep the current value, and some classes have one
    assert _count(s, F.col("Residlm").isNotNull()) > 0


def test_one_row_per_key_and_row_conservation(run):
    up = run.upload
    assert up.groupBy("MarketCode", "ClassificationId").count().where("count > 1").count() == 0
    n_out = run.outputs.count()
    assert run.decay_class.count() == n_out
    assert run.worst_retail.count() == n_out and run.best_retail.count() == n_out
    assert up.count() == n_out + 1  # plus the global row
    assert _count(up, F.col("ClassificationId") == P.global_class_id) == 1


def test_decay_row_accounting(run):
    d = run.decay.where(F.col("rows_in") >= P.min_fit_rows)
    assert _count(d, F.col("n") + F.col("n_influential") != F.col("rows_in")) == 0
    assert _count(d, F.col("n_influential") > 0) > 0
    small = run.decay.where(F.col("rows_in") < P.min_fit_rows)
    assert _count(small, (F.col("factor") != 0.0) | (F.col("n") != 0)) == 0


def test_inheritance_paths_all_occur(run):
    got = {r.resolved_from for r in run.worst_class.select("resolved_from").distinct().collect()}
    assert got == {"own", "subcategory", "category", "global"}
