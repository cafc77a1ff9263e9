"""Factor assembly and publication rules (DOM-11..15, 17, 18).

All inputs here are class-grain tables (one row per output class); the factors of a class are
brought together once (``class_table``) and the rules after that are column arithmetic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depreco.config import Params
from depreco.functions import clamp, greatest_na, least_na, safe_div

#: Column names of the published tables.
FACTORS = ["ResidSF", "SFBestRetail", "SFWorstRetail", "SFBestAuction", "SFWorstAuction"]
LAST_MONTH_COLUMNS = {
    "ResidSF": "Residlm",
    "SFBestRetail": "RetailEconSfBest",
    "SFWorstRetail": "RetailEconSfWorst",
    "SFBestAuction": "AuctionEconSfBest",
    "SFWorstAuction": "AuctionEconSfWorst",
}
DELTAS = {
    "MoMResid": ("ResidSF", "Residlm", "relative"),
    "MoMBestRet": ("SFBestRetail", "RetailEconSfBest", "difference"),
    "MoMWorstRet": ("SFWorstRetail", "RetailEconSfWorst", "difference"),
    "MoMBestAuc": ("SFBestAuction", "AuctionEconSfBest", "difference"),
    "MoMWorstAuc": ("SFWorstAuction", "AuctionEconSfWorst", "difference"),
}


# -- DOM-11, DOM-12, JN-17 ------------------------------------------------------------------
def class_table(outputs: DataFrame, capped: DataFrame, recency: DataFrame, inherited: DataFrame, p: Params) -> DataFrame:
    """One row per output class with its five factors before the publication rules.

    Decay is the own schedule's capped factor. Retail factors are the inherited factor times the
    schedule's recency (1 where it has none), capped; auction factors multiply the retail ones.
    ``inherited`` has one row per class (``hierarchy.by_class``)."""
    j = (
        outputs.join(capped.select("Schedule", "cap_factor"), "Schedule", "left")
        .join(recency.select("Schedule", F.col("recency").alias("_recency")), "Schedule", "left")
        .join(inherited, "ClassificationId", "left")
        .withColumn("recency", F.coalesce("_recency", F.lit(1.0)))
    )
    worst = least_na(F.col("worst_retail") * F.col("recency"), F.lit(p.worst_cap))
    best = greatest_na(F.lit(p.best_cap), F.col("best_retail") * F.col("recency"))
    j = j.withColumns({"SFWorstRetail": worst, "SFBestRetail": best})
    return j.select(
        F.lit(p.market_code).alias("MarketCode"), "ClassificationId", F.col("cap_factor").alias("ResidSF"), "SFBestRetail", "SFWorstRetail",
        (F.col("best_auction") * F.col("SFBestRetail")).alias("SFBestAuction"),
        (F.col("worst_auction") * F.col("SFWorstRetail")).alias("SFWorstAuction"),
        "recency", "mapped", F.coalesce("has_worst_auction", F.lit(False)).alias("has_worst_auction"),
    )


# -- DOM-18 ---------------------------------------------------------------------------------
def global_row(globs: DataFrame, kinds: dict[str, str], p: Params) -> DataFrame:
    """One row for the global class: clamped decay mean and the plain econ means.

    ``globs`` holds (kind, glob) rows; ``kinds`` maps each output factor to its kind. A
    family without a global value gives NULL (the aggregate always returns one row)."""
    vals = []
    for name in FACTORS:
        g = F.max(F.when(F.col("kind") == kinds[name], F.col("glob")))
        vals.append((clamp(g, p.resid_low, p.resid_high) if name == "ResidSF" else g).alias(name))
    return globs.agg(*vals).select(
        F.lit(p.market_code).alias("MarketCode"), F.lit(p.global_class_id).cast("int").alias("ClassificationId"),
        *FACTORS,
    )


# -- DOM-13 ---------------------------------------------------------------------------------
def enforce_gap(df: DataFrame, p: Params) -> DataFrame:
    """Worst is at least ``econ_gap`` below best, for retail and auction."""
    return df.withColumns(
        {
            "SFWorstRetail": least_na(F.col("SFWorstRetail"), F.col("SFBestRetail") - p.econ_gap),
            "SFWorstAuction": least_na(F.col("SFWorstAuction"), F.col("SFBestAuction") - p.econ_gap),
        }
    )


# -- DOM-14 / DOM-15 ------------------------------------------------------------------------
def mom_limit_col(last, current, limit: float):
    """Keep the month-over-month move within +-limit; no last value -> current."""
    last, current = F.col(last), F.col(current)
    return F.when(last.isNull(), current).otherwise(least_na(last + limit, greatest_na(last - limit, current)))


def attach_last_month(df: DataFrame, last_month: DataFrame) -> DataFrame:
    lm = last_month.select(
        "MarketCode", "ClassificationId", F.col("ResidSf").alias("Residlm"), "RetailEconSfBest",
        "RetailEconSfWorst", "AuctionEconSfBest", "AuctionEconSfWorst",
    )
    return df.join(lm, ["MarketCode", "ClassificationId"], "left")


def mom_limit(df_with_last: DataFrame, p: Params) -> DataFrame:
    return df_with_last.withColumns(
        {f: mom_limit_col(LAST_MONTH_COLUMNS[f], f, p.mom_cap) for f in FACTORS}
    )


def mom_delta(limited: DataFrame) -> DataFrame:
    cols = {}
    for name, (cur, last, kind) in DELTAS.items():
        if kind == "relative":
            cols[name] = safe_div(F.col(cur), F.col(last)) - 1
        else:
            cols[name] = F.col(cur) - F.col(last)
    return limited.withColumns(cols)


def upload_table(share: DataFrame) -> DataFrame:
    return share.select("MarketCode", "ClassificationId", *FACTORS)


# -- DOM-17 ---------------------------------------------------------------------------------
def map_integrity(outputs: DataFrame, taxonomy: DataFrame, schedules: DataFrame) -> DataFrame:
    """(ClassificationId, Schedule, in_taxonomy, schedule_known) of every output class: whether the taxonomy has it
    (else it inherits nothing and has no economic factors) and whether some input row feeds its schedule (else
    it has no factor of its own)."""
    known = taxonomy.select("ClassificationId").distinct().withColumn("_tax", F.lit(True))
    fed = schedules.select("Schedule").distinct().withColumn("_fed", F.lit(True))
    j = outputs.join(known, "ClassificationId", "left").join(fed, "Schedule", "left")
    return j.select("ClassificationId", "Schedule", F.coalesce("_tax", F.lit(False)).alias("in_taxonomy"), F.coalesce("_fed", F.lit(False)).alias("schedule_known"))


def integrity_checks(integrity: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    rows = [F.struct(F.lit(name).alias("check"), n.alias("lhs"), F.count(F.when(F.col(c), 1)).alias("rhs")) for name, c in (("classes_in_taxonomy", "in_taxonomy"), ("schedules_known", "schedule_known"))]
    return integrity.agg(F.array(*rows).alias("r")).select(F.inline("r")).withColumn("ok", F.col("lhs") == F.col("rhs"))


def reconciliation_checks(classes: DataFrame, unique_of: DataFrame, key: list[str]) -> DataFrame:
    """Row-count equalities between result tables plus key uniqueness, as one checks table.

    The class table gives all counts in one aggregate: the decay table against each factor's table
    (worst auction holds only classes with an inherited auction factor), and the rows of the output
    map against the classes they name (rows that a class mapped twice loses are the difference)."""
    n = F.count(F.lit(1))
    pairs = {
        "decay_vs_best_retail": (n, n), "decay_vs_worst_retail": (n, n), "decay_vs_best_auction": (n, n),
        "decay_vs_worst_auction": (n, F.count(F.when(F.col("has_worst_auction"), 1))),
        "classes_mapped_once": (F.coalesce(F.sum("mapped"), F.lit(0)).cast("long"), n),
    }
    rows = F.array(*[F.struct(F.lit(name).alias("check"), a.alias("lhs"), b.alias("rhs")) for name, (a, b) in pairs.items()])
    counts = classes.agg(rows.alias("r")).select(F.inline("r"))
    unique = unique_of.groupBy(*key).count().agg(
        F.lit("unique_" + "_".join(key)).alias("check"), F.count(F.lit(1)).alias("lhs"), F.coalesce(F.sum("count"), F.lit(0)).alias("rhs")
    )
    return counts.unionByName(unique).withColumn("ok", F.col("lhs") == F.col("rhs"))
