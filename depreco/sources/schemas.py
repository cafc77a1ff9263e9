"""Explicit schemas of the logical inputs (no inference on production reads)."""

from __future__ import annotations

from pyspark.sql import types as T

_I, _L, _D, _S, _DT = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType(), T.DateType()


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


TAXONOMY = [
    ("CategoryId", _I, True), ("CategoryName", _S, True),
    ("SubcategoryId", _I, True), ("SubcategoryName", _S, True),
    ("MakeId", _I, True), ("MakeName", _S, True),
]

COST_ASSETS = _schema(
    ("CustomerAssetId", _L, False), ("CustomerId", _L, True), ("CustomerName", _S, True), ("EquipNo", _S, True),
    *TAXONOMY, ("ModelId", _L, True), ("ModelName", _S, True), ("ModelYear", _I, True),
    ("AcquisitionDate", _DT, True), ("Cost", _D, True), ("CurrentABCostUSNA", _D, True),
    ("IsUsedForABCostUSNA", _S, True), ("IsPurchasedUsed", _S, True),
)

COMPARABLES = _schema(
    *TAXONOMY, ("ModelName", _S, True), ("ModelYear", _I, True), ("SaleDate", _DT, False),
    ("SaleYear", _I, True), ("SalePrice", _D, True), ("Cost", _D, True), ("CurrentABCostUSNA", _D, True),
    ("M1PrecedingFmv", _D, True), ("saletype", _S, True), ("IsUsedForComparablesUSNA", _S, True),
)

CLASS_VALUES = _schema(
    ("ClassificationId", _I, False), *TAXONOMY, ("ModelId", _L, True), ("ModelYear", _I, False),
    ("PublishYear", _I, False), ("AppraisalBookPublishDate", _DT, False),
    ("FlvSchedulePercentage", _D, True), ("FmvSchedulePercentage", _D, True),
)

CLASS_VALUES_IN_PROGRESS = _schema(
    ("ClassificationId", _I, False), *TAXONOMY, ("ModelId", _L, True), ("ModelYear", _I, False),
    ("FlvSchedulePercentage", _D, True), ("FmvSchedulePercentage", _D, True),
)

CLASSIFICATIONS = _schema(("ClassificationId", _I, False), *TAXONOMY, ("ModelId", _L, True))

LAST_MONTH = _schema(
    ("MarketCode", _S, False), ("ClassificationId", _I, False), *TAXONOMY,
    ("ResidSf", _D, True), ("RetailEconSfBest", _D, True), ("RetailEconSfWorst", _D, True),
    ("AuctionEconSfBest", _D, True), ("AuctionEconSfWorst", _D, True),
    ("AppraisalBookIssueID", _I, True), ("AppraisalBookPublishDate", _DT, False),
)

_MAP_COMMON = [
    ("Country", _S, True), ("Schedule", _S, True), ("Level2", _S, True),
    ("CategoryId", _I, True), ("SubcategoryId", _I, True), ("MakeId", _I, True),
    ("ClassificationId", _I, True), ("Plot", _S, True), ("CategoryName", _S, True),
    ("SubcategoryName", _S, True), ("MakeName", _S, True), ("CSMM", _S, True), ("ValidSchedule", _S, True),
]
IN_MAP = _schema(*_MAP_COMMON, ("CanadaPlots", _S, True))
IN_BORROW_MAP = _schema(*_MAP_COMMON, ("CheckJoin", _S, True), ("BorrowSchedule", _S, True), ("BorrowType", _S, True))
OUT_MAP = _schema(
    ("Country", _S, True), ("ClassificationId", _I, True), ("Schedule", _S, True), ("SubcategoryId", _I, True),
    ("SubcategoryName", _S, True), ("Level2", _S, True), ("Plot", _S, True),
)

OUTPUT = _schema(
    ("MarketCode", _S, False), ("ClassificationId", _I, False), ("ResidSF", _D, True),
    ("SFBestRetail", _D, True), ("SFWorstRetail", _D, True), ("SFBestAuction", _D, True),
    ("SFWorstAuction", _D, True),
)

BY_NAME = {
    "cost_assets": COST_ASSETS,
    "comparables": COMPARABLES,
    "class_values": CLASS_VALUES,
    "class_values_in_progress": CLASS_VALUES_IN_PROGRESS,
    "classifications": CLASSIFICATIONS,
    "last_month": LAST_MONTH,
    "in_map": IN_MAP,
    "in_borrow_map": IN_BORROW_MAP,
    "out_map": OUT_MAP,
    "out_borrow_map": OUT_MAP,
}
