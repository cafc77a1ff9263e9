"""Hand-computed micro-tables for the domain operators (FIXTURES.md section 4)."""


import numpy as np
import pytest
from pyspark.sql import functions as F

from depreco.config import FIXTURE_PARAMS as P
from depreco.operators import decay as D
from depreco.operators import hierarchy as H
from depreco.operators import publish as PB
from depreco.operators import ratios as R
from depreco.operators import outliers as OU
from depreco.operators.assign import assign_by_closure, assign_schedules, closure
from depreco.session import RunTables
from depreco.sources import maps as M
from tests.conftest import rows

MAP_SCHEMA = "Schedule string, Level2 string, CategoryId int, SubcategoryId int, MakeId int"


def test_assignment_bag_semantics_and_null_keys(spark):
    m = spark.createDataFrame(
        [("C1", "Category", 1, 99, 99), ("CS1", "SubcatGroup", 1, 10, 99), ("M1", "Make", 1, 10, 5),
         ("CSnull", "SubcatGroup", 2, None, None), ("X", "Other", 1, 10, 5)],
        MAP_SCHEMA,
    )
    f = spark.createDataFrame([(1, 1, 10, 5), (2, 1, 11, 5), (3, 2, None, 7), (4, None, None, None)],
                              "id int, CategoryId int, SubcategoryId int, MakeId int")
    got = sorted((r.id, r.Schedule) for r in assign_schedules(f, m).collect())
    # row 1 lands in three schedules; NULL subcategory matches NULL (V2); unknown level ignored
    assert got == [(1, "C1"), (1, "CS1"), (1, "M1"), (2, "C1"), (3, "CSnull")]


def test_closure_gives_what_assignment_gives(spark):
    m = spark.createDataFrame(
        [("C1", "Category", 1, 99, 99), ("C1", "SubcatGroup", 1, 10, 99), ("M1", "Make", 1, 10, 5), ("CSnull", "SubcatGroup", 2, None, None), ("X", "Other", 1, 10, 5)],
        MAP_SCHEMA,
    )
    f = spark.createDataFrame([(1, 1, 10, 5), (2, 1, 11, 5), (3, 2, None, 7), (4, None, None, None), (5, 1, 10, 5)], "id int, CategoryId int, SubcategoryId int, MakeId int")
    closed = closure(f, m)
    assert closed.count() == 3  # a row for each class that reads a schedule
    got = assign_by_closure(f, closed)
    assert got.columns == [*f.columns, "Schedule"]
    assert sorted(map(str, got.collect())) == sorted(map(str, assign_schedules(f, m).collect()))
    assert sorted(r.Schedule for r in got.where("id = 5").collect()) == ["C1", "C1", "M1"]  # one schedule by two levels: twice


def test_map_integrity_names_orphans(spark):
    outputs = spark.createDataFrame([(1, "A"), (2, "B"), (3, "A"), (4, None)], "ClassificationId int, Schedule string")
    taxonomy = spark.createDataFrame([(1,), (1,), (2,), (4,)], "ClassificationId int")
    feeds = spark.createDataFrame([("A",), ("A",)], "Schedule string")
    found = PB.map_integrity(outputs, taxonomy, feeds)
    assert {(r.ClassificationId, r.in_taxonomy, r.schedule_known) for r in found.collect()} == {(1, True, True), (2, True, False), (3, False, True), (4, True, False)}
    assert {r.check: (r.lhs, r.rhs, r.ok) for r in PB.integrity_checks(found).collect()} == {"classes_in_taxonomy": (4, 3, False), "schedules_known": (4, 2, False)}


def test_a_class_mapped_twice_to_one_schedule_has_one_choice(spark):
    cols = "Country string, ClassificationId int, Schedule string, SubcategoryId int, SubcategoryName string, Level2 string, Plot string"
    twins = [("USA", 1, "A", 5, "s", "Make", "Y"), ("USA", 1, "A", 5, "s", "Category", "Y"), ("USA", 1, "A", 4, "s", "Category", "Y"), ("USA", 1, "A", None, "t", "Category", "N"), ("USA", 1, "B", None, None, None, None)]
    none = spark.createDataFrame([], cols)
    for order in (twins, twins[::-1], twins[2:] + twins[:2]):
        [r] = M.schedule_outputs(spark.createDataFrame(order, cols), none, P).collect()
        assert (r.Schedule, r.Level2, r.SubcategoryId, r.SubcategoryName, r.mapped) == ("A", "Category", None, "t", 5)


def _age4(m):
    return float(np.round(m * 2500 / 3)) / 10000.0


def _regression_rows(spark, xs, ys, category=1):
    """Regression rows of two makes of one category; the schedule is mapped at category level."""
    data = [(category, 10 * category, 1 + i % 2, int(round(x * 12)), _age4(int(round(x * 12))), float(y)) for i, (x, y) in enumerate(zip(xs, ys))]
    return spark.createDataFrame(data, "CategoryId int, SubcategoryId int, MakeId int, AgeMonths int, x double, y double")


def _category_schedules(spark):
    return spark.createDataFrame([("S", "Category", 1, None, None), ("T", "Category", 2, None, None)], MAP_SCHEMA)


def _fit(spark, rows_, p=P):
    tables = RunTables(spark)
    out = {r.Schedule: r for r in D.decay_fit(rows_, _category_schedules(spark), p, tables.keep).collect()}
    tables.close()
    return out


def test_cooks_distance_matches_hat_matrix(spark):
    # cook_40: 40 points on a noisy log line with one gross outlier. As in a real run, all ages
    # share the effective month, so they are whole years apart (k + 1/12, rounded to 4 places).
    rng = np.random.default_rng(7)
    months = 12 * rng.integers(2, 10, size=40) + 1
    x = np.array([_age4(m) for m in months])
    y = 0.02 * x + rng.normal(0, 0.01, 40)
    y[5] += 0.4
    df = _regression_rows(spark, x, y)
    # NumPy: OLS with intercept, hat values, Cook's distance, drop > 20 * mean, refit through origin
    X = np.column_stack([np.ones_like(x), x])
    H_ = X @ np.linalg.inv(X.T @ X) @ X.T
    h = np.diag(H_)
    beta = np.linalg.lstsq(X, y, rcond=None)[0]
    e = y - X @ beta
    s2 = (e @ e) / (len(x) - 2)
    cook = e ** 2 / (2 * s2) * h / (1 - h) ** 2
    keep = ~(cook > 20 * cook.mean())
    slope0 = (x[keep] @ y[keep]) / (x[keep] @ x[keep])
    out = _fit(spark, df, P.with_(sd_multiplier=10.0))["S"]
    assert out.n_influential == int((~keep).sum()) >= 1
    assert out.slope == pytest.approx(beta[1], rel=1e-9)
    assert out.intercept == pytest.approx(beta[0], rel=1e-9)
    assert out.s2 == pytest.approx(s2, rel=1e-9)
    assert out.mean_cooks == pytest.approx(cook.mean(), rel=1e-9)
    assert out.factor == pytest.approx(np.exp(8 * slope0), rel=1e-12)
    assert out.n == int(keep.sum())


def test_single_age_group_is_intercept_only(spark):
    # same_age_30: Sxx = 0 -> p = 1, h = 1/n; nothing is dropped for a constant error pattern
    y = np.linspace(0.1, 0.2, 30)
    df = _regression_rows(spark, [5.0] * 30, y)
    out = _fit(spark, df)["S"]
    assert out.slope == 0.0 and out.intercept == pytest.approx(y.mean())
    e = y - y.mean()
    assert out.s2 == pytest.approx((e @ e) / 29)
    assert out.factor == pytest.approx(np.exp(8 * (5 * y.sum()) / (25 * 30)))


def test_small_and_one_row_groups(spark):
    # one_row_group: sd undefined -> the row is dropped (V8); under 30 rows -> factor 0, n 0 (K2)
    df = _regression_rows(spark, [4.0] + [4.0, 5.0, 6.0] * 5, [0.1] + [0.1, 0.12, 0.13] * 5)
    one = _regression_rows(spark, [4.0], [0.1], 2)
    out = _fit(spark, df.unionByName(one))
    assert "T" not in out
    assert out["S"].factor == 0.0 and out["S"].n == 0 and out["S"].rows_in == 16
    assert _fit(spark, df, P.with_(small_group="null"))["S"].factor is None


def test_sd_filter_keeps_equal_ages(spark):
    cells = D.age_cells(_regression_rows(spark, [5.0] * 10 + [9.0], [0.1] * 11), _category_schedules(spark))
    got = {r.AgeMonths: r.keep for r in D.sd_filter_cells(cells, 1.2).collect()}
    assert got == {60: True, 108: False}


def _ratio_rows(spark, seed, n, values=None):
    """Rows of two makes at ages 2 to 9, in a category schedule that overlaps a schedule of one make."""
    rng = np.random.default_rng(seed)
    r = rng.choice(values, n) if values else np.exp(rng.normal(0.1, 0.08, n)).clip(0.79, 1.45)
    months = 12 * rng.integers(2, 10, n) + 1
    data = [(1, 10, int(k), int(m), _age4(int(m)), float(np.log(x)), float(x)) for k, m, x in zip(rng.integers(1, 3, n), months, r, strict=True)]
    rows_ = spark.createDataFrame(data, "CategoryId int, SubcategoryId int, MakeId int, AgeMonths int, x double, y double, r double")
    return rows_, data, spark.createDataFrame([("S", "Category", 1, None, None), ("M", "Make", 1, 10, 2)], MAP_SCHEMA)


def _in_schedule(name, data):
    return [d for d in data if name == "S" or d[2] == 2]


@pytest.fixture
def keep(spark):
    tables = RunTables(spark)
    yield tables.keep
    tables.close()


@pytest.mark.parametrize(("values", "bins"), [(None, 512), (None, 16), ([1.0, 1.1, 1.3], 2), ([1.2], 512)])
def test_quantiles_of_overlapping_groups_are_exact(spark, monkeypatch, keep, values, bins):
    monkeypatch.setattr(OU, "BINS", bins)
    slim, data, schedules = _ratio_rows(spark, 3, 700, values)
    slim = keep(slim)
    classes = keep(D.class_cells(slim))
    closed = keep(closure(classes, schedules))
    cells = keep(D.merge_cells(assign_by_closure(classes, closed)))
    ratios = keep(assign_by_closure(OU.ratio_cells(slim), closed))
    points = (0.25, 0.5, 0.75, 1.0)
    got = {(q.Schedule, q.AgeMonths): q for q in OU.quantiles(slim, ratios, closed, cells, P, points, keep).collect()}
    assert len(got) == cells.count() == 16
    for (name, age), q in got.items():
        own = [d[6] for d in _in_schedule(name, data) if d[3] == age]
        assert [q[f"q{k}"] for k in range(4)] == pytest.approx(np.quantile(own, points), rel=1e-14)


@pytest.mark.parametrize(("mode", "k"), [("ratio_sd", 1.5), ("iqr", 0.5), ("iqr", 50.0)])
def test_ratio_filters_match_numpy(spark, keep, mode, k):
    slim, data, schedules = _ratio_rows(spark, 5, 600)
    slim = keep(slim)
    p = P.with_(sd_multiplier=10.0, ratio_multiplier=k, outlier=mode)
    got = {r.Schedule: r for r in D.decay_fit(slim, schedules, p, keep).collect()}
    for name in ("S", "M"):
        own = np.array([d[3:] for d in _in_schedule(name, data)])
        keep = np.zeros(len(own), bool)
        for age in np.unique(own[:, 0]):
            group = own[:, 0] == age if mode == "iqr" else np.ones(len(own), bool)
            r = own[group, 3]
            if mode == "iqr":
                q1, q3 = np.quantile(r, [0.25, 0.75])
                lo, hi = q1 - k * (q3 - q1), q3 + k * (q3 - q1)
            else:
                lo, hi = r.mean() - k * r.std(ddof=1), r.mean() + k * r.std(ddof=1)
            keep |= group & (own[:, 3] >= lo) & (own[:, 3] <= hi)
        x, y = own[keep, 1], own[keep, 2]
        assert k > 10 or 0 < (~keep).sum() < len(own)
        X = np.column_stack([np.ones_like(x), x])
        beta = np.linalg.lstsq(X, y, rcond=None)[0]
        e = y - X @ beta
        s2 = e @ e / (len(x) - 2)
        h = np.diag(X @ np.linalg.inv(X.T @ X) @ X.T)
        cook = e**2 / (2 * s2) * h / (1 - h) ** 2
        far = cook > 20 * cook.mean()
        out = got[name]
        assert (out.rows_in, out.n_influential) == (keep.sum(), far.sum())
        assert out.s2 == pytest.approx(s2, rel=1e-9)
        assert out.factor == pytest.approx(np.exp(8 * (x[~far] @ y[~far]) / (x[~far] @ x[~far])), rel=1e-11)


def test_unknown_outlier_mode_is_an_error(spark):
    slim, _, schedules = _ratio_rows(spark, 5, 50)
    with pytest.raises(ValueError, match="outlier"):
        D.decay_fit(slim, schedules, P.with_(outlier="none"))


def test_best_year_pick_ties_go_to_latest_year(spark):
    # tie_years: equal factors in 1998 and 2000, a NULL factor is ignored (V10)
    df = spark.createDataFrame(
        [("S", 1998, 1.1, 30, 40), ("S", 2000, 1.1, 25, 40), ("S", 1999, None, 50, 40), ("T", 1999, None, 50, 40)],
        "Schedule string, SaleYear int, factor double, best_n long, current_n long",
    )
    got = rows(R.best_year_pick(df))
    assert got == [{"Schedule": "S", "factor": 1.1, "best_n": 25, "current_n": 40, "year": 2000}]


def test_period_ratio_weights(spark):
    a = spark.createDataFrame([("S", 4, 10, 0.5), ("S", 5, 30, 0.6)], "Schedule string, yearAge int, totalunits long, avg double")
    b = spark.createDataFrame([("S", 4, 10, 0.4), ("S", 5, 5, 0.5)], "Schedule string, yearAge int, totalunits long, avg double")
    out = R.period_ratio(a, b, ["Schedule", "yearAge"], ["Schedule"], P).collect()
    assert out == []  # the b side holds 15 units: both sides must exceed 20
    b2 = b.withColumn("totalunits", F.col("totalunits") + 10)
    r = R.period_ratio(a, b2, ["Schedule", "yearAge"], ["Schedule"], P).collect()[0]
    # reference weights: (min/mean(min)) * sum
    mins, sums, ratios = np.array([10, 15]), np.array([30, 45]), np.array([0.5 / 0.4, 0.6 / 0.5])
    w = mins / mins.mean() * sums
    assert r.factor == pytest.approx((w * ratios).sum() / w.sum(), rel=1e-12)


def test_inheritance_paths(spark):
    # inherit_4: own, subcategory parent, category parent, global, and a class absent from the taxonomy
    tax = spark.createDataFrame(
        [(101, 1, None, 101), (1011, 1, 1011, 101), (101101, 1, 1011, 101), (101102, 1, 1012, 101),
         (1012, 1, 1012, 101), (102, 2, None, 102), (102101, 2, 1021, 102)],
        "ClassificationId int, CategoryId int, CS_ClassId int, C_ClassId int",
    )
    out_map = spark.createDataFrame(
        [(101, "C1", "Category"), (1011, "CS1", "SubcatGroup"), (101101, "M1", "Make"), (101102, "M2", "Make"),
         (1012, "CS2", "SubcatGroup"), (102, "C2", "Category"), (102101, "M3", "Make"), (999, "M4", "Make")],
        "ClassificationId int, Schedule string, Level2 string",
    )
    f = spark.createDataFrame(
        [("C1", 1.2), ("CS1", 1.1), ("M1", None), ("M2", None), ("CS2", None), ("C2", None), ("M3", None),
         ("M4", 2.0)],
        "Schedule string, factor double",
    )
    got = {r.ClassificationId: (r.factor, r.resolved_from) for r in H.inherit(f, out_map, tax, P.with_(global_list=(1, 2))).collect()}
    assert got == {
        101: (1.2, "own"), 1011: (1.1, "own"), 101101: (1.1, "subcategory"), 101102: (1.2, "category"),
        1012: (1.2, "category"), 102: (1.2, "global"), 102101: (1.2, "global"),
    }


def test_mom_limit_gap_and_global_row(spark):
    df = spark.createDataFrame(
        [(None, 1.10), (1.10, 1.11), (1.10, 1.20), (1.10, 1.00), (1.10, None)], "last double, cur double"
    )
    got = [r.v for r in df.select(PB.mom_limit_col("last", "cur", 0.02).alias("v")).collect()]
    assert got == [1.10, 1.11, pytest.approx(1.12), pytest.approx(1.08), None]
    g = spark.createDataFrame([(1.0, 0.95, 1.2, 1.0)], "SFBestRetail double, SFWorstRetail double, SFBestAuction double, SFWorstAuction double")
    r = PB.enforce_gap(g, P).collect()[0]
    assert r.SFWorstRetail == pytest.approx(0.85) and r.SFWorstAuction == 1.0
    globs = spark.createDataFrame([("decay", 1.5), ("best_retail", 1.1)], "kind string, glob double")
    kinds = {"ResidSF": "decay", "SFBestRetail": "best_retail", "SFWorstRetail": "worst_retail",
             "SFBestAuction": "best_auction", "SFWorstAuction": "worst_auction"}
    row = PB.global_row(globs, kinds, P).collect()
    assert len(row) == 1 and row[0].ResidSF == 1.25 and row[0].SFBestRetail == 1.1 and row[0].SFWorstRetail is None
    assert row[0].ClassificationId == 1


def test_recency_band(spark):
    # n <= threshold: shrink toward 1 by n/20, band 1 +- 0.2 n/20; n > threshold keeps widening (K11)
    cells = spark.createDataFrame(
        [("S", "current", None, 2000, 5, False, 10, 10.0), ("S", "current", None, 2000, 5, True, 5, 3.0)],
        "Schedule string, period string, SaleYear int, ModelYear int, yearAge int, recent boolean, units long, s double",
    )
    r = R.recency_factor(cells, P).collect()[0]
    avg12, avg_recent = 13.0 / 15, 3.0 / 5
    v0 = avg12 * 0.99 ** 5.5 / avg_recent
    v1 = ((20 - 5) + 5 * v0) / 20
    assert r.n == 5 and r.raw == pytest.approx(v0) and r.shrunk == pytest.approx(v1)
    assert r.recency == pytest.approx(min((15 + 5 * 1.2) / 20, v1))


def test_cells_merge_exactly(spark):
    """Schedule cells from class cells equal those of the rows taken together."""
    rng = np.random.default_rng(3)
    y = rng.normal(0.2, 0.05, 200)
    df = _regression_rows(spark, 2 + rng.integers(0, 4, 200), y)
    got = {r.AgeMonths: r for r in D.age_cells(df, _category_schedules(spark)).collect()}
    for months, part in df.toPandas().groupby("AgeMonths").y:
        r = got[months]
        assert r.n == len(part) and r.sy == pytest.approx(part.sum()) and r.ss == pytest.approx(((part - part.mean()) ** 2).sum())


def test_one_row_per_mapped_class(spark):
    """A class mapped twice reads its own map first, then the first schedule by name, and stays one row
    through inheritance."""
    cols = "Country string, ClassificationId int, Schedule string, SubcategoryId int, SubcategoryName string, Level2 string, Plot string"
    own = spark.createDataFrame([("USA", 101101, "M b", 10, "x", "Make", "Y"), ("USA", 101101, "M a", 10, "x", "Make", "Y"), ("USA", 101, "C", None, None, "Category", "Y")], cols)
    lent = spark.createDataFrame([("USA", 101101, "A RbA 1", 10, "x", "Make", "Y"), ("USA", 7, "B RbA 1", 10, "x", "Make", "Y"), ("USA", 7, "other", 10, "x", "Make", "Y")], cols)
    out = M.schedule_outputs(own, lent, P)
    got = {r.ClassificationId: (r.Schedule, r.mapped) for r in out.collect()}
    assert got == {101101: ("M a", 3), 101: ("C", 1), 7: ("B RbA 1", 1)}
    tax = spark.createDataFrame([(101, 1, None, 101), (101101, 1, None, 101)], "ClassificationId int, CategoryId int, CS_ClassId int, C_ClassId int")
    f = spark.createDataFrame([("C", 1.2), ("M a", 1.1), ("M b", None), ("A RbA 1", 1.4)], "Schedule string, factor double")
    res = sorted((r.ClassificationId, r.factor, r.resolved_from) for r in H.inherit(f, out, tax, P).collect())
    assert res == [(101, 1.2, "own"), (101101, 1.1, "own")]
