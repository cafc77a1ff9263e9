"""Physical plan shape of the fact passes and the tail (the scale properties the design relies on)."""

import re

import pytest

from depreco.config import FIXTURE_PARAMS as P
from depreco.operators import decay as D
from depreco.operators import ratios as R
from depreco.operators.assign import assign_by_closure, closure
from depreco.plans.catalog import QUERIES
from depreco.plans.pipeline import Run
from depreco.session import RunTables
from depreco.sources import extracts as X
from depreco.sources import fixtures as FX
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def scans(df, table: str) -> int:
    return len(re.findall(rf"FileScan parquet .*{table}\.parquet", plan(df)))


@pytest.fixture(scope="module")
def run(spark):
    r = Run(FX.load_inputs(spark, SF_SMALL, P), P)
    yield r
    r.close()


def slim(run):
    return D.regression_input(X.cost_extract(run.inputs.cost_assets, P), P)


@pytest.mark.parametrize("cells", ["decay", "retail"])
def test_facts_are_aggregated_before_anything_is_expanded(run, cells):
    df = D.class_cells(slim(run)) if cells == "decay" else R.class_cells(run.inputs.comparables, P)
    p = plan(df)
    assert scans(df, "lineitem") == 1
    assert "Generate" not in p and "Window" not in p and "Join" in p  # the joins are the fixtures' own
    assert "partial_count" in p and "partial_sum" in p  # map-side combine before the shuffle


def test_assignment_meets_cells_only(run):
    """Below every Generate (the expansion to levels) there is an Aggregate over the fact."""
    for df in (D.age_cells(slim(run), run.schedules), R.retail_cells(run.inputs.comparables, run.schedules, P)):
        lines = optimized(df).split("\n")
        first = max(i for i, x in enumerate(lines) if "Generate" in x)
        assert any("Aggregate" in x for x in lines[first:])


def test_second_decay_pass_reads_pruned_cells_without_shuffling_facts(run):
    rows = slim(run)
    classes = run.keep(D.class_cells(rows))
    closed = run.keep(closure(classes, run.schedules))
    assert "lineitem" not in plan(D.merge_cells(assign_by_closure(classes, closed)))  # everything else comes from the written cells
    cells = run.keep(D.sd_filter_cells(D.merge_cells(assign_by_closure(classes, closed)), P.sd_multiplier).where("keep"))
    fitted = run.keep(D.fitted_cells(cells, P))
    listed = run.keep(D.influential_cells(classes, closed, fitted))
    assert 0 < listed.count() < classes.count()
    df = D.influential_rows(rows, listed)
    p = plan(df)
    assert scans(df, "lineitem") == 1 and "distinct" not in p.lower()
    assert "BroadcastExchange" in p and not re.search(r"(?<!Broadcast)Exchange ", p)  # the facts stay where they are
    top = optimized(df).split("\n")[:4]
    assert any("Generate explode(filter(" in x for x in top)


def test_no_second_pass_where_no_cell_can_hold_an_influential_row(run):
    kept = []

    def keep(df):
        kept.append(df)
        return run.keep(df)

    df = D.decay_fit(slim(run), run.schedules, P.with_(cook_multiplier=1e9), keep)
    assert scans(df, "lineitem") == 0
    assert sum(scans(k, "lineitem") for k in kept) == 1


@pytest.mark.parametrize("outlier", ["ratio_sd", "iqr"])
def test_ratio_filters_read_the_facts_once(spark, outlier):
    """The passes after the first read the written rows of the fit: with the filter that leaves rows out and with Cook's."""
    params = P.with_(outlier=outlier, ratio_multiplier=0.5)
    r = Run(FX.load_inputs(spark, SF_SMALL, params), params)
    kept, write = [], r._tables.keep
    r._tables.keep = lambda df: kept.append(df) or write(df)
    assert scans(r.decay, "lineitem") == 0
    assert sum(scans(k, "lineitem") for k in kept) == 1
    r.close()


def test_written_regression_rows_are_the_rows(run):
    rows = slim(run)
    got = run.regression_rows
    assert got.columns == rows.columns and scans(got, "lineitem") == 0
    assert rows.count() > 0 and got.exceptAll(rows).isEmpty() and rows.exceptAll(got).isEmpty()


def test_raw_rows_meet_the_closure_unexpanded(run):
    rows = X.cost_extract(run.inputs.cost_assets, P)
    closed = run.keep(closure(rows, run.schedules))
    p = optimized(assign_by_closure(rows, closed))
    assert "named_struct" not in p and "Category" in p and p.count("Generate") == 1 and "explode(schedules" in p


def test_published_values_are_scanned_once(run):
    assert scans(X.auction_published(run.inputs.class_values, P), "lineitem") == 1


def test_no_hint_but_the_five_global_values(run):
    p = run.upload._jdf.queryExecution().analyzed().toString() + run.inherited._jdf.queryExecution().analyzed().toString()
    assert p.count("strategy=broadcast") <= 1


def test_tail_is_short(run):
    p = plan(run.upload)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert len(re.findall(r"\bExchange\b", p)) < 10


def test_pushdown_into_scan(run):
    p = plan(X.cost_extract(run.inputs.cost_assets, P))
    line = next(x for x in p.split("\n") if "FileScan" in x and "lineitem" in x)
    assert "l_extendedprice" not in line and "l_shipdate" not in line  # unused columns are pruned
    assert re.search(r"PushedFilters: \[[^]]*IsNotNull\(l_", line)


def test_flags_and_years_reach_a_table_scan(spark, tmp_path):
    FX.load_inputs(spark, SF_SMALL, P).comparables.write.partitionBy("SaleYear").parquet(str(tmp_path / "c"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    p = plan(R.class_cells(spark.read.parquet(str(tmp_path / "c")), P))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert re.search(r"PartitionFilters: \[[^]]*SaleYear#\d+ IN \(", p)
    assert re.search(r"PushedFilters: \[[^]]*In\(IsUsedForComparablesUSNA, \[[Yy],[Yy]\]\)", p)


def test_same_factors_without_automatic_broadcasts(spark, run):
    want = sorted(map(tuple, run.upload.collect()), key=str)
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = "spark.sql.adaptive.autoBroadcastJoinThreshold"
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set(adaptive, "-1")
    try:
        other = Run(FX.load_inputs(spark, SF_SMALL, P), P)
        got = sorted(map(tuple, other.upload.collect()), key=str)
        assert "SortMergeJoin" in plan(other.limited)
        other.close()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
        spark.conf.unset(adaptive)
    close = lambda a, b: a == b or abs(a - b) < 1e-9
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert all((x is None) == (y is None) and (x is None or isinstance(x, str) or close(x, y)) for x, y in zip(a, b, strict=True))


def test_quartiles_read_the_facts_once(spark, monkeypatch):
    kept, write = [], RunTables.keep
    monkeypatch.setattr(RunTables, "keep", lambda self, df: kept.append(df) or write(self, df))
    df = QUERIES["ratio_quartiles"](spark, SF_SMALL)
    assert df.count() > 0 and scans(df, "lineitem") == 0
    assert sum(scans(k, "lineitem") for k in kept) == 1


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_fact_passes_are_short_enough_to_compile(spark, run, broadcast):
    """The JVM interprets a method of more than 8000 bytes of bytecode, which makes a pass over the facts ten times slower."""
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        fresh = FX.load_inputs(spark, SF_SMALL, P)
        rows = D.regression_input(X.cost_extract(fresh.cost_assets, P), P)
        passes = [rows.drop("y"), D.class_cells(rows), R.class_cells(fresh.comparables, P), X.auction_published(fresh.class_values, P), X.auction_current(fresh.class_values_in_progress, P)]
        for df in passes:
            text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
            sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
            assert sizes and max(sizes) < 8000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
