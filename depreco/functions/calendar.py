"""Age arithmetic on whole months.

Ages are anchored at mid-year of the model year: age = year(d) - model_year + (month(d) - 6)/12.
Working in integer months keeps every comparison exact in any engine; the fractional-year
forms are derived from the integer.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def age_months(d, model_year) -> Column:
    """Whole months from the model-year midpoint to date ``d`` (a column or a python date)."""
    my = F.col(model_year) if isinstance(model_year, str) else model_year
    if isinstance(d, date):
        return (F.lit(d.year) - my) * 12 + F.lit(d.month - 6)
    dc = F.col(d) if isinstance(d, str) else d
    return (F.year(dc) - my) * 12 + F.month(dc) - 6


def age_years_4dp(months) -> Column:
    """Age in years rounded to 4 decimals, computed as integer / 10000 (exact)."""
    m = F.col(months) if isinstance(months, str) else months
    return F.round(m * 2500 / 3.0) / 10000.0


def age_years(months) -> Column:
    m = F.col(months) if isinstance(months, str) else months
    return m / 12.0


def year_age(months) -> Column:
    """Age rounded half away from zero to whole years (valid for non-negative ages)."""
    m = F.col(months) if isinstance(months, str) else months
    return F.floor((m + 6) / 12).cast("int")
