"""Run parameters and the calendar bounds derived from an explicit as-of date.

Every clock read of the original batch ("today", "last month end") is replaced by
``Params.as_of`` so a run is reproducible and can be replayed for any month.
"""

from __future__ import annotations

import calendar
from dataclasses import dataclass, replace
from datetime import date


def month_end(year: int, month: int) -> date:
    return date(year, month, calendar.monthrange(year, month)[1])


def shift_month_end(d: date, months: int) -> date:
    """Last day of the month ``months`` away from ``d``'s month."""
    idx = d.year * 12 + (d.month - 1) + months
    return month_end(idx // 12, idx % 12 + 1)


def minus_one_month_clamped(d: date) -> date:
    """Same day one month earlier, clamped to that month's length.

    This is calendar month subtraction without snapping to month end:
    2001-07-31 -> 2001-06-30 but 2020-04-30 -> 2020-03-30.
    """
    idx = d.year * 12 + (d.month - 1) - 1
    y, m = idx // 12, idx % 12 + 1
    return date(y, m, min(d.day, calendar.monthrange(y, m)[1]))


# ---------------------------------------------------------------------------
# Fixed values of the production configuration (must equal the original batch).
# ---------------------------------------------------------------------------
PROD_EXCLUDED_CATEGORIES = (220, 1948, 18, 4, 1949, 234, 21, 31, 2733, 2706, 2718, 2692, 2724, 2674, 2700, 2708)
PROD_EXCLUDED_MAKES = (58137, 78)
PROD_COMPOSITE_SUBCATEGORIES = (2806, 2808, 2001, 2636)
PROD_COMPOSITE_MAKE = 31
PROD_COMPOSITE_MODEL_PREFIX = "XQ"
PROD_TAXONOMY_EXCLUDED_CATEGORIES = (220, 1948, 21)
PROD_TAXONOMY_EXCLUDED_NAME_PREFIX = "DO NOT USE"
PROD_GLOBAL_LIST = (313, 6, 2509, 15, 29, 315, 360, 451, 316, 362)
PROD_RECESSION_YEAR = 2009
PROD_BEST_YEARS = (2016, 2017, 2018)


@dataclass(frozen=True)
class Params:
    """Settings of a run. The defaults are fixed values of the production configuration."""

    as_of: date = date(2020, 6, 23)
    country: str = "USA"
    market_code: str = "USNA"
    # outlier handling and regression
    sd_multiplier: float = 3.0
    target_age: float = 8.0
    min_fit_rows: int = 30
    cook_multiplier: float = 20.0
    cost_age_low: float = 2.0
    cost_age_high: float = 10.0
    cost_history_months: int = 144
    small_group: str = "zero"  # 'zero' (as the original) or 'null'
    outlier: str = "age"  # 'age' (as the original), or with a filter on the ratio as well: 'ratio_sd', 'iqr'
    ratio_multiplier: float = 3.0  # of that filter: standard deviations, or interquartile ranges beyond the quartiles
    # economic factors
    num_threshold: int = 20
    halfyear_shift: float = 5.5
    monthly_decay: float = 0.99
    recent_months: str = "clamped"  # 'clamped' (as the original) or 'month_end'
    recency_band: float = 0.2
    # caps
    mom_cap: float = 0.02
    resid_low: float = 1.02
    resid_high: float = 1.25
    worst_cap: float = 0.98
    best_cap: float = 1.03
    econ_gap: float = 0.15
    global_class_id: int = 1
    # source filters
    excluded_categories: tuple = PROD_EXCLUDED_CATEGORIES
    excluded_makes: tuple = PROD_EXCLUDED_MAKES
    composite_subcategories: tuple = PROD_COMPOSITE_SUBCATEGORIES
    composite_make: int = PROD_COMPOSITE_MAKE
    composite_model_prefix: str = PROD_COMPOSITE_MODEL_PREFIX
    excluded_customer: int = 178
    excluded_equipno_prefix: str = "N"
    excluded_equipno_suffix: str = "NF"
    taxonomy_excluded_categories: tuple = PROD_TAXONOMY_EXCLUDED_CATEGORIES
    taxonomy_excluded_name_prefix: str = PROD_TAXONOMY_EXCLUDED_NAME_PREFIX
    global_list: tuple = PROD_GLOBAL_LIST
    recession_year: int = PROD_RECESSION_YEAR
    best_years: tuple = PROD_BEST_YEARS
    # band flag: in use when low_a + low_b*age <= ratio <= high_a + high_b*age
    band_low: tuple = (0.75, 0.015)
    band_high: tuple = (1.25, 0.125)
    # comparables filters
    retail_age_open: tuple = (3, 10)  # exclusive, years
    cost_to_ab_band: tuple = (0.5, 2.0)
    price_to_m1_band: tuple = (0.6, 1.4)
    max_price_to_cost: float = 1.0
    min_comparable_cost: float = 5.0
    min_asset_cost: float = 10.0
    auction_age_band: tuple = (3, 10)  # ModelYear between PublishYear-10 and PublishYear-3

    # -- calendar -----------------------------------------------------------
    @property
    def effective_date(self) -> date:
        """Publish date: last day of the month before ``as_of``."""
        return shift_month_end(self.as_of, -1)

    @property
    def cost_window(self) -> tuple[date, date]:
        """Half-open acquisition window (start, end]."""
        return shift_month_end(self.as_of, -(self.cost_history_months + 1)), self.effective_date

    @property
    def current_window(self) -> tuple[date, date]:
        """Half-open rolling 12-month sale window (start, end]."""
        return shift_month_end(self.as_of, -13), self.effective_date

    @property
    def recession_publish_window(self) -> tuple[date, date]:
        return date(self.recession_year, 3, 31), date(self.recession_year, 12, 31)

    @property
    def last_month_date(self) -> date:
        return shift_month_end(self.as_of, -2)

    @property
    def recent_month_ends(self) -> tuple[date, date]:
        pub = self.effective_date
        if self.recent_months == "month_end":
            return shift_month_end(pub, -1), pub
        return minus_one_month_clamped(pub), pub

    @property
    def current_publish_year(self) -> int:
        return self.effective_date.year

    @property
    def current_model_years(self) -> tuple[int, int]:
        lo, hi = self.auction_age_band
        return self.as_of.year - hi, self.as_of.year - lo

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)


def written_best_years(as_of: date, first_year: int = 2015) -> tuple:
    """Candidate best years as the written business rule states them:
    from ``first_year`` to this year once June has passed, else to last year."""
    last = as_of.year if as_of.month > 6 else as_of.year - 1
    return tuple(range(first_year, last + 1))


# ---------------------------------------------------------------------------
# Fixed values of the fixture configuration used against the driver's tables.
# ---------------------------------------------------------------------------
FIXTURE_PARAMS = Params(
    as_of=date(2001, 8, 15),
    excluded_categories=(6,),
    excluded_makes=(25,),
    composite_subcategories=(11,),
    composite_make=3,
    composite_model_prefix="red",
    taxonomy_excluded_categories=(6,),
    global_list=(1, 2, 3, 4, 5),
    recession_year=1996,
    best_years=(1998, 1999, 2000),
)
