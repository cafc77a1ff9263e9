from datetime import date

from pyspark.sql import functions as F

from depreco.config import FIXTURE_PARAMS, Params, minus_one_month_clamped, written_best_years, shift_month_end
from depreco.functions import age_months, age_years_4dp, clamp, greatest_na, least_na, mean_na, safe_div, year_age


def test_least_greatest_propagate_null(spark):
    # V1: the row (NULL, 1) must give NULL, unlike Spark's least/greatest.
    df = spark.createDataFrame([(None, 1.0), (2.0, 1.0), (1.0, None)], "a double, b double")
    out = df.select(least_na("a", "b").alias("lo"), greatest_na("a", "b").alias("hi"),
                    F.least("a", "b").alias("spark_lo")).collect()
    assert [(r.lo, r.hi) for r in out] == [(None, None), (1.0, 2.0), (None, None)]
    assert out[0].spark_lo == 1.0  # the built-in skips NULL: that is why the helpers exist


def test_clamp(spark):
    df = spark.createDataFrame([(0.5,), (1.1,), (3.0,), (None,)], "x double")
    got = [r.c for r in df.select(clamp("x", 1.02, 1.25).alias("c")).collect()]
    assert got == [1.02, 1.1, 1.25, None]


def test_mean_na_and_safe_div(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0), ("b", 4.0)], "g string, x double")
    got = {r.g: r.m for r in df.groupBy("g").agg(mean_na("x").alias("m")).collect()}
    assert got == {"a": None, "b": 3.0}  # V3
    z = spark.createDataFrame([(1.0, 0.0), (1.0, None), (3.0, 2.0)], "a double, b double")
    assert [r.q for r in z.select(safe_div("a", "b").alias("q")).collect()] == [None, None, 1.5]  # V7


def test_year_age_rounds_half_away_from_zero(spark):
    # SC-05 / V6: months from the model-year midpoint; x.5 years round up.
    df = spark.createDataFrame(
        [(date(2009, 12, 1), 2001), (date(2009, 1, 15), 2001), (date(2009, 6, 30), 2001), (date(2009, 7, 1), 2000)],
        "d date, my int",
    )
    out = df.select(age_months("d", "my").alias("m")).select("m", year_age("m").alias("ya"),
                                                            age_years_4dp("m").alias("age")).collect()
    assert [(r.m, r.ya) for r in out] == [(102, 9), (91, 8), (96, 8), (109, 9)]
    assert [r.age for r in out] == [8.5, 7.5833, 8.0, 9.0833]


def test_calendar_bounds():
    p = FIXTURE_PARAMS
    assert p.effective_date == date(2001, 7, 31)
    assert p.cost_window == (date(1989, 7, 31), date(2001, 7, 31))
    assert p.current_window == (date(2000, 7, 31), date(2001, 7, 31))
    assert p.last_month_date == date(2001, 6, 30)
    assert p.recent_month_ends == (date(2001, 6, 30), date(2001, 7, 31))
    assert p.current_model_years == (1991, 1998)


def test_recent_months_clamped_vs_month_end():
    # K5: 2020-03-15 -> publish 2020-02-29; clamped subtraction gives 2020-01-29.
    p = Params(as_of=date(2020, 3, 15))
    assert p.effective_date == date(2020, 2, 29)
    assert p.recent_month_ends == (date(2020, 1, 29), date(2020, 2, 29))
    assert p.with_(recent_months="month_end").recent_month_ends == (date(2020, 1, 31), date(2020, 2, 29))
    p = Params(as_of=date(2020, 4, 15))
    assert p.recent_month_ends == (date(2020, 2, 29), date(2020, 3, 31))
    assert minus_one_month_clamped(date(2020, 4, 30)) == date(2020, 3, 30)
    assert shift_month_end(date(2020, 3, 15), -145) == date(2008, 2, 29)


def test_written_best_years():
    assert written_best_years(date(2020, 6, 23)) == (2015, 2016, 2017, 2018, 2019)
    assert written_best_years(date(2020, 7, 1)) == (2015, 2016, 2017, 2018, 2019, 2020)
