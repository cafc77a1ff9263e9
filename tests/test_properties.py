"""Property tests: the column helpers against plain-Python statements of the rules."""

from hypothesis import given, settings
from hypothesis import strategies as st

from depreco.functions import clamp, greatest_na, least_na
from depreco.operators.publish import mom_limit_col

val = st.one_of(st.none(), st.floats(min_value=-5, max_value=5, allow_nan=False))


def r_pmin(*xs):
    return None if any(x is None for x in xs) else min(xs)


def r_pmax(*xs):
    return None if any(x is None for x in xs) else max(xs)


def r_mom(last, cur, cap):
    return cur if last is None else r_pmin(last + cap, r_pmax(last - cap, cur))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(val, val, val), min_size=1, max_size=40))
def test_helpers_match_r_semantics(spark, rows):
    df = spark.createDataFrame(rows, "a double, b double, c double")
    out = df.select(
        least_na("a", "b", "c").alias("lo"), greatest_na("a", "b", "c").alias("hi"),
        clamp("a", 1.02, 1.25).alias("cl"), mom_limit_col("a", "b", 0.02).alias("mom"),
    ).collect()
    for (a, b, c), r in zip(rows, out):
        assert r.lo == r_pmin(a, b, c)
        assert r.hi == r_pmax(a, b, c)
        assert r.cl == r_pmax(1.02, r_pmin(1.25, a))
        assert r.mom == r_mom(a, b, 0.02)
