"""Adapters from the driver's TPC-H style tables to the logical input relations.

The production inputs (asset costs, comparable sales, schedule values, taxonomy, schedule
maps, last month's factors) are not public. These functions derive relations with the same
schemas from ``lineitem``, ``part`` and ``orders`` so every query runs on data whose size
grows with the given tables. All derivations are lazy DataFrame expressions.

Joins: ``lineitem`` x ``part`` for sales, values and taxonomy; asset costs also need
``orders`` (acquisition date, customer).
"""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from depreco.config import FIXTURE_PARAMS, Params, shift_month_end

# Fixed values of the fixture derivation.
CATEGORIES = 7
UNUSED_CATEGORY = 7  # named so that the taxonomy leaves it out
CONCENTRATED_CATEGORY = 5  # nearly all of one model year: the 3-sd filter drops the rest
MODEL_CLASS_OFFSET = 10_000_000
RBA_SUBCATEGORY_DIGIT = 1
RBA_MAKES = (4, 5)
LAST_MONTH_DROP_MODULUS = 7


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _category_name(cat: Column) -> Column:
    return F.concat(F.when(cat == UNUSED_CATEGORY, "DO NOT USE ").otherwise("Category "), cat.cast("string"))


def _subcategory_name(sub: Column) -> Column:
    return F.concat(F.lit("Subcategory "), sub.cast("string"))


def _taxonomy_cols(pk: Column, p_size: Column, p_brand: Column) -> dict[str, Column]:
    """Category / subcategory / make / model year of a part (fixed derivation rules)."""
    cat = (F.lit(1) + pk % CATEGORIES).cast("int")
    sub = (cat * 10 + p_size % 3).cast("int")
    make = F.substring_index(p_brand, "#", -1).cast("int")
    return {
        "CategoryId": cat,
        "CategoryName": _category_name(cat),
        "SubcategoryId": sub,
        "SubcategoryName": _subcategory_name(sub),
        "MakeId": make,
        "MakeName": p_brand,
        "ModelYear": F.when((cat == CONCENTRATED_CATEGORY) & (pk % 20 != 0), F.lit(1995)).otherwise((F.lit(1986) + F.floor(pk / 5) % 12).cast("int")),
    }


def sales_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem x part with the taxonomy columns (one row per line item)."""
    li = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate",
    )
    # What a part's own columns give is derived on the part's side, once per part: conditions on it are met before the
    # join, and the code that Spark generates for a line item stays short enough for the JVM to compile.
    pk = F.col("p_partkey")
    cols = _taxonomy_cols(pk, F.col("p_size"), F.col("p_brand"))
    ids = ["CategoryId", "SubcategoryId", "MakeId", "ModelYear"]
    pt = _read(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand", *[cols[c].alias(c) for c in ids],
        # some costs at or under the minima of asset costs (10) and comparables (5)
        F.when(pk % 41 == 0, F.lit(4.0)).when(pk % 43 == 0, F.lit(8.0)).otherwise(F.col("p_retailprice")).alias("Cost"),
    )
    b = li.join(pt, li.l_partkey == pt.p_partkey)
    return b.withColumns(
        {
            "CategoryName": _category_name(F.col("CategoryId")),
            "SubcategoryName": _subcategory_name(F.col("SubcategoryId")),
            "MakeName": F.col("p_brand"),
            "ModelId": F.col("l_partkey"),
            "ModelName": F.col("p_name"),
            "SaleDate": F.col("l_shipdate").cast("date"),
            "dsc": F.col("l_discount") + F.lit(0.0),
            "tax": F.col("l_tax") + F.lit(0.0),
        }
    )


def _fact_subcategory() -> Column:
    """Facts of some parts have no subcategory (their make and category are known)."""
    return F.when(F.col("p_partkey") % 53 != 0, F.col("SubcategoryId")).alias("SubcategoryId")


def cost_assets(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    b = base if base is not None else sales_base(spark, sf_dir)
    day = F.col("o_orderdate").cast("date")
    od = _read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 61 == 0, F.add_months(day, -180)).otherwise(day).alias("AcquisitionDate")
    )
    b = b.join(od, b.l_orderkey == od.o_orderkey)
    q, ln, cat = F.col("l_quantity"), F.col("l_linenumber"), F.col("CategoryId")
    shift = F.when(cat == 5, F.lit(0.35)).when(cat == 1, F.lit(-0.1)).otherwise(F.lit(0.0))
    r = (
        F.when(q == 1, F.lit(0.7))
        .when((q == 50) & (ln <= 2), F.lit(1.6))
        .otherwise(F.lit(1.0) + F.lit(0.004) * q + shift)
    )
    out = b.select(
        (F.col("l_orderkey") * 10 + ln).alias("CustomerAssetId"),
        F.col("o_custkey").alias("CustomerId"),
        F.concat(F.lit("Customer#"), F.col("o_custkey").cast("string")).alias("CustomerName"),
        F.when(ln % 2 == 0, F.concat(ln.cast("string"), F.col("l_returnflag"), F.col("l_linestatus")))
        .otherwise(F.concat(F.col("l_returnflag"), ln.cast("string"), F.col("l_linestatus"))).alias("EquipNo"),
        "CategoryId", "CategoryName", _fact_subcategory(), "SubcategoryName", "MakeId", "MakeName",
        "ModelId", "ModelName", "ModelYear",
        "AcquisitionDate",
        F.col("Cost"),
        F.when(F.col("l_orderkey") % 37 != 0, F.col("Cost") * r).alias("CurrentABCostUSNA"),
        F.when(ln < 7, "Y").otherwise("N").alias("IsUsedForABCostUSNA"),
        F.when((F.col("l_linestatus") == "F") & (ln == 1), "Y").otherwise("N").alias("IsPurchasedUsed"),
    )
    return out


def comparables(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    b = base if base is not None else sales_base(spark, sf_dir)
    cost, dsc, tax = F.col("Cost"), F.col("dsc"), F.col("tax")
    auction = (F.col("l_returnflag") == "R") | (F.col("SubcategoryId") == 32) | (F.col("CategoryId") == 4)
    # sales of category 2 fall in price in the last months, so its recency factor meets the band
    late = (F.col("CategoryId") == 2) & (F.col("SaleDate") > F.lit(date(2001, 5, 31)))
    price = cost * (F.lit(0.35) + F.lit(5.0) * dsc + F.lit(2.0) * tax)
    return b.select(
        "CategoryId", "CategoryName", _fact_subcategory(), "SubcategoryName", "MakeId", "MakeName",
        "ModelName", "ModelYear", "SaleDate",
        F.year("SaleDate").alias("SaleYear"),
        F.when(late, price * F.lit(0.7)).otherwise(price).alias("SalePrice"),
        cost.alias("Cost"),
        (cost * (F.lit(0.4) + F.lit(0.04) * F.col("l_quantity"))).alias("CurrentABCostUSNA"),
        (cost * F.lit(0.6)).alias("M1PrecedingFmv"),
        F.when(auction, "Auction").otherwise("Retail").alias("saletype"),
        F.when(F.col("l_linenumber") < 7, "Y").otherwise("N").alias("IsUsedForComparablesUSNA"),
    )


def _levels(df: DataFrame, extra: list[str], model: Column | None = None) -> DataFrame:
    """One row per taxonomy level (C, CS, CSM and, with ``model``, the model) of each input row."""
    cat, sub, make = F.col("CategoryId"), F.col("SubcategoryId"), F.col("MakeId")
    null_i, null_s, null_l = F.lit(None).cast("int"), F.lit(None).cast("string"), F.lit(None).cast("long")

    def lvl(cid, s, sn, m, mn, mo=null_l):
        return F.struct(
            cid.cast("int").alias("ClassificationId"), s.alias("SubcategoryId"), sn.alias("SubcategoryName"),
            m.alias("MakeId"), mn.alias("MakeName"), mo.alias("ModelId"),
        )

    sn, mn = F.col("SubcategoryName"), F.col("MakeName")
    levels = [
        lvl(100 + cat, null_i, null_s, null_i, null_s),
        lvl(1000 + sub, sub, sn, null_i, null_s),
        lvl(100000 + sub * 100 + make, sub, sn, make, mn),
    ]
    if model is not None:
        levels.append(lvl(F.lit(MODEL_CLASS_OFFSET) + model, sub, sn, make, mn, model))
    return df.select("CategoryId", "CategoryName", *extra, F.explode(F.array(*levels)).alias("lv")).select(
        "lv.ClassificationId", "CategoryId", "CategoryName", "lv.SubcategoryId", "lv.SubcategoryName",
        "lv.MakeId", "lv.MakeName", "lv.ModelId", *extra,
    )


def classifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Taxonomy from the product catalogue: the distinct C, CS and CSM classes of ``part``."""
    pt = _read(spark, sf_dir, "part")
    cols = _taxonomy_cols(F.col("p_partkey"), F.col("p_size"), F.col("p_brand"))
    b = pt.select(
        *[cols[c].alias(c) for c in
          ("CategoryId", "CategoryName", "SubcategoryId", "SubcategoryName", "MakeId", "MakeName")]
    ).distinct()
    return _levels(b, []).distinct()


def class_values(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    b = (base if base is not None else sales_base(spark, sf_dir)).withColumns(
        {
            "pub": F.last_day("SaleDate"),
            "flv": F.lit(100.0) * (F.lit(0.30) + F.lit(5.0) * F.col("dsc")),
            "fmv": F.lit(100.0) * (F.lit(0.45) + F.lit(5.0) * F.col("dsc") + F.col("tax")),
        }
    )
    keys = ["ClassificationId", "CategoryId", "CategoryName", "SubcategoryId", "SubcategoryName",
            "MakeId", "MakeName", "ModelId", "pub", "ModelYear"]
    rows = _levels(b, ["ModelYear", "pub", "flv", "fmv"], F.col("l_partkey")).groupBy(*keys)
    # some percentages are missing, which makes their schedule's mean missing
    missing = (F.col("ClassificationId") + F.month("pub")) % 31 == 0
    return rows.agg(F.avg("flv").alias("flv"), F.avg("fmv").alias("fmv")).select(
        "ClassificationId", "CategoryId", "CategoryName", "SubcategoryId", "SubcategoryName", "MakeId",
        "MakeName", "ModelId", "ModelYear", F.year("pub").alias("PublishYear"),
        F.col("pub").alias("AppraisalBookPublishDate"),
        F.when(~missing, F.col("flv")).alias("FlvSchedulePercentage"), F.col("fmv").alias("FmvSchedulePercentage"),
    )


def class_values_in_progress(spark: SparkSession, sf_dir: str, params: Params = FIXTURE_PARAMS) -> DataFrame:
    return (
        class_values(spark, sf_dir)
        .where(F.col("AppraisalBookPublishDate") == F.lit(params.effective_date))
        .drop("AppraisalBookPublishDate", "PublishYear")
    )


def _map_rows(classes: DataFrame) -> DataFrame:
    """Schedule rows: every C and CS class, and CSM classes of most makes."""
    level2 = (
        F.when(F.col("SubcategoryId").isNull(), "Category")
        .when(F.col("MakeId").isNull(), "SubcatGroup")
        .otherwise("Make")
    )
    prefix = F.when(level2 == "Category", "C ").when(level2 == "SubcatGroup", "CS ").otherwise("M ")
    return classes.where(F.col("MakeId").isNull() | (F.col("MakeId") % 5 != 0)).select(
        "ClassificationId", "CategoryId", "CategoryName", "SubcategoryId", "SubcategoryName", "MakeId",
        "MakeName",
        level2.alias("Level2"),
        F.concat(prefix, F.col("ClassificationId").cast("string")).alias("Schedule"),
    )


def in_map(spark: SparkSession, sf_dir: str, classes: DataFrame | None = None) -> DataFrame:
    rows = _map_rows(classes if classes is not None else classifications(spark, sf_dir))
    usa = rows.withColumn("Country", F.lit("USA"))
    can = rows.where(F.col("Level2") == "Category").withColumns(
        {"Country": F.lit("CAN"), "Schedule": F.concat(F.col("Schedule"), F.lit(" CAN"))}
    )
    # a schedule fed by the facts of category 1 that have no subcategory
    none = usa.where((F.col("Level2") == "Category") & (F.col("CategoryId") == 1)).withColumns(
        {"Schedule": F.lit("CS none"), "Level2": F.lit("SubcatGroup"), "ClassificationId": F.lit(None).cast("int")}
    )
    return usa.unionByName(can).unionByName(none).select(
        "Country", "Schedule", "Level2", "CategoryId", "SubcategoryId", "MakeId", "ClassificationId",
        F.lit("Y").alias("Plot"), "CategoryName", "SubcategoryName", "MakeName",
        F.concat_ws(" / ", "CategoryName", "SubcategoryName", "MakeName").alias("CSMM"),
        F.lit("Y").alias("ValidSchedule"), F.lit("N").alias("CanadaPlots"),
    )


def _rba_parents(classes: DataFrame) -> DataFrame:
    return classes.where(
        F.col("SubcategoryId").isNotNull() & F.col("MakeId").isNull()
        & (F.col("SubcategoryId") % 10 == RBA_SUBCATEGORY_DIGIT)
    )


def in_borrow_map(spark: SparkSession, sf_dir: str, classes: DataFrame | None = None) -> DataFrame:
    cls = classes if classes is not None else classifications(spark, sf_dir)
    rba = _rba_parents(cls).select(
        F.lit("USA").alias("Country"),
        F.concat(F.lit("RS RbA "), F.col("ClassificationId").cast("string")).alias("Schedule"),
        F.lit("SubcatGroup").alias("Level2"), "CategoryId", "SubcategoryId", F.lit(None).cast("int").alias("MakeId"),
        "ClassificationId", "CategoryName", "SubcategoryName", "MakeName",
        F.concat(F.lit("CS "), F.col("ClassificationId").cast("string")).alias("BorrowSchedule"),
        F.lit("RetailBorrowAuction").alias("BorrowType"),
    )
    other = cls.where(F.col("SubcategoryId").isNull()).select(
        F.lit("USA").alias("Country"),
        F.concat(F.lit("CA AbR "), F.col("ClassificationId").cast("string")).alias("Schedule"),
        F.lit("Category").alias("Level2"), "CategoryId", F.lit(None).cast("int").alias("SubcategoryId"),
        F.lit(None).cast("int").alias("MakeId"), "ClassificationId", "CategoryName", "SubcategoryName", "MakeName",
        F.concat(F.lit("C "), F.col("ClassificationId").cast("string")).alias("BorrowSchedule"),
        F.lit("AuctionBorrowRetail").alias("BorrowType"),
    )
    return rba.unionByName(other).select(
        "Country", "Schedule", "Level2", "CategoryId", "SubcategoryId", "MakeId", "ClassificationId",
        F.lit("Y").alias("Plot"), "CategoryName", "SubcategoryName", "MakeName",
        F.concat_ws(" / ", "CategoryName", "SubcategoryName", "MakeName").alias("CSMM"),
        F.lit("Y").alias("ValidSchedule"), F.lit("Y").alias("CheckJoin"), "BorrowSchedule", "BorrowType",
    )


def out_map(spark: SparkSession, sf_dir: str, inputs_map: DataFrame | None = None) -> DataFrame:
    src = inputs_map if inputs_map is not None else in_map(spark, sf_dir)
    rows = src.where(F.col("ClassificationId").isNotNull()).select(
        "Country", "ClassificationId", "Schedule", "SubcategoryId", "SubcategoryName", "Level2", "Plot", "CategoryId"
    )
    # classes mapped twice to one schedule, at different levels
    twice = rows.where((F.col("Level2") == "SubcatGroup") & (F.col("CategoryId") == 3)).withColumns({"Level2": F.lit("Category"), "Plot": F.lit("N")})
    # a class that the taxonomy lacks, reading a schedule that nothing feeds
    orphan = rows.where((F.col("Level2") == "Category") & (F.col("CategoryId") == 2)).withColumns(
        {"ClassificationId": (F.col("ClassificationId") + 9000000).cast("int"), "Schedule": F.concat(F.lit("none "), F.col("CategoryId").cast("string"))}
    )
    return rows.unionByName(twice).unionByName(orphan).drop("CategoryId")


def out_borrow_map(spark: SparkSession, sf_dir: str, classes: DataFrame | None = None) -> DataFrame:
    cls = classes if classes is not None else classifications(spark, sf_dir)
    parents = _rba_parents(cls).select(
        F.col("SubcategoryId").alias("psub"), F.col("ClassificationId").alias("pid")
    )
    kids = cls.where(F.col("MakeId").isin(*RBA_MAKES) | (F.col("MakeId") == 6))
    j = kids.join(parents, kids.SubcategoryId == parents.psub)
    sched = F.when(
        F.col("MakeId") == 6, F.concat(F.lit("RS "), F.col("pid").cast("string"))
    ).otherwise(F.concat(F.lit("RS RbA "), F.col("pid").cast("string")))
    return j.select(
        F.lit("USA").alias("Country"), "ClassificationId", sched.alias("Schedule"), "SubcategoryId",
        "SubcategoryName", F.lit("Make").alias("Level2"), F.lit("Y").alias("Plot"),
    )


def last_month_factors(spark: SparkSession, sf_dir: str, params: Params = FIXTURE_PARAMS,
                       classes: DataFrame | None = None) -> DataFrame:
    cls = (classes if classes is not None else classifications(spark, sf_dir)).where(F.col("ClassificationId") % LAST_MONTH_DROP_MODULUS != 0)
    cid = F.col("ClassificationId")

    def month(d: date, bump: float) -> DataFrame:
        best = F.lit(1.0) + (cid % 25).cast("double") * F.lit(0.01) + F.lit(bump)
        worst = F.lit(0.8) + (cid % 20).cast("double") * F.lit(0.01) + F.lit(bump)
        return cls.select(
            F.lit("USNA").alias("MarketCode"), "ClassificationId", "CategoryId", "CategoryName",
            "SubcategoryId", "SubcategoryName", "MakeId", "MakeName",
            best.alias("ResidSf"), best.alias("RetailEconSfBest"), worst.alias("RetailEconSfWorst"),
            best.alias("AuctionEconSfBest"), worst.alias("AuctionEconSfWorst"),
            F.lit(d.year * 100 + d.month).alias("AppraisalBookIssueID"),
            F.lit(d).alias("AppraisalBookPublishDate"),
        )

    last = params.last_month_date
    return month(last, 0.0).unionByName(month(shift_month_end(last, -1), 0.05))


class Inputs:
    """The logical input relations of one run, each built on first use.

    Raw tables are read once per instance and the taxonomy is derived once, so the maps
    and last month's factors share one ``classifications`` plan."""

    def __init__(self, spark: SparkSession, sf_dir: str, params: Params = FIXTURE_PARAMS):
        self.spark, self.sf_dir, self.params = spark, sf_dir, params

    @cached_property
    def sales_base(self) -> DataFrame:
        return sales_base(self.spark, self.sf_dir)

    @cached_property
    def cost_assets(self) -> DataFrame:
        return cost_assets(self.spark, self.sf_dir, self.sales_base)

    @cached_property
    def comparables(self) -> DataFrame:
        return comparables(self.spark, self.sf_dir, self.sales_base)

    @cached_property
    def class_values(self) -> DataFrame:
        return class_values(self.spark, self.sf_dir, self.sales_base)

    @cached_property
    def class_values_in_progress(self) -> DataFrame:
        return self.class_values.where(
            F.col("AppraisalBookPublishDate") == F.lit(self.params.effective_date)
        ).drop("AppraisalBookPublishDate", "PublishYear")

    @cached_property
    def classifications(self) -> DataFrame:
        return classifications(self.spark, self.sf_dir)

    @cached_property
    def in_map(self) -> DataFrame:
        return in_map(self.spark, self.sf_dir, self.classifications)

    @cached_property
    def in_borrow_map(self) -> DataFrame:
        return in_borrow_map(self.spark, self.sf_dir, self.classifications)

    @cached_property
    def out_map(self) -> DataFrame:
        return out_map(self.spark, self.sf_dir, self.in_map)

    @cached_property
    def out_borrow_map(self) -> DataFrame:
        return out_borrow_map(self.spark, self.sf_dir, self.classifications)

    @cached_property
    def last_month(self) -> DataFrame:
        return last_month_factors(self.spark, self.sf_dir, self.params, self.classifications)


def load_inputs(spark: SparkSession, sf_dir: str, params: Params = FIXTURE_PARAMS) -> Inputs:
    return Inputs(spark, sf_dir, params)
