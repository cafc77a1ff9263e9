from depreco.functions.calendar import age_months, age_years, age_years_4dp, year_age
from depreco.functions.nulls import any_null, clamp, greatest_na, least_na, mean_na, r6, safe_div

__all__ = [
    "age_months",
    "age_years",
    "age_years_4dp",
    "year_age",
    "any_null",
    "clamp",
    "greatest_na",
    "least_na",
    "mean_na",
    "r6",
    "safe_div",
]
