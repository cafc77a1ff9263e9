"""NULL-propagating column helpers.

Spark's ``least``/``greatest``/``avg`` skip NULLs. The business rules treat a missing
factor as "unknown", so a comparison or mean over a missing value stays missing.
All helpers are plain Catalyst expressions (codegen friendly, no UDF).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(x) -> Column:
    """Column as is, a string as a column name, anything else as a literal."""
    if isinstance(x, Column):
        return x
    return F.col(x) if isinstance(x, str) else F.lit(x)


def any_null(*cols) -> Column:
    return reduce(lambda a, b: a | b, [_col(c).isNull() for c in cols])


def least_na(*cols) -> Column:
    """``least`` that returns NULL when any argument is NULL."""
    cs = [_col(c) for c in cols]
    return F.when(any_null(*cs), F.lit(None)).otherwise(F.least(*cs))


def greatest_na(*cols) -> Column:
    """``greatest`` that returns NULL when any argument is NULL."""
    cs = [_col(c) for c in cols]
    return F.when(any_null(*cs), F.lit(None)).otherwise(F.greatest(*cs))


def clamp(x, lo: float, hi: float) -> Column:
    """``max(lo, min(hi, x))``, NULL stays NULL."""
    return greatest_na(F.lit(float(lo)), least_na(F.lit(float(hi)), _col(x)))


def mean_na(x) -> Column:
    """Aggregate mean that is NULL when any input of the group is NULL."""
    x = _col(x)
    return F.when(F.count(F.lit(1)) == F.count(x), F.avg(x))


def safe_div(a, b) -> Column:
    """Division that yields NULL for a zero or NULL divisor (never raises)."""
    return F.try_divide(_col(a), _col(b))


# Added before rounding so a value sitting on a half-way point (e.g. a mean of 2-decimal
# ratios over 32 rows) rounds the same way whatever its last-bit error in either engine.
TIE_NUDGE = 1e-11


def r6(x) -> Column:
    """Round a double to 6 decimals (stable output for cross-engine comparison)."""
    return F.round(_col(x) + F.lit(TIE_NUDGE), 6)
