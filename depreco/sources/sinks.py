"""Sinks: the upload file (SNK-01), the wide review table (SNK-02) and the taxonomy listing (ST-01)."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame

from depreco.sources.publication import STAGED, Files

UPLOAD_PREFIX = "factors"
REVIEW_PREFIX = "review"
TAXONOMY_PREFIX = "taxonomy"

UPLOAD_ORDER = ["MarketCode", "ClassificationId"]
TAXONOMY_ORDER = ["CategoryName", "SubcategoryName", "MakeName"]


def output_name(prefix: str, stamp: datetime) -> str:
    """File-name stem with the run's date, hour and minute, so a second run that day is kept too."""
    return f"{prefix}{stamp:%Y%m%d%H%M}"


def upload_path(base_path: str, stamp: datetime, prefix: str = UPLOAD_PREFIX) -> str:
    return f"{base_path}/{output_name(prefix, stamp)}.csv"


def single_csv(rows: DataFrame, path: str) -> None:
    """``rows`` in their order as one CSV file with one header, missing values as ``NA``.

    Tasks write the parts side by side; the file is put together from them in the order of their names under
    another name, and renamed last, so the file is whole whenever it is there."""
    files = Files(rows.sparkSession)
    parts = f"{path.rpartition('/')[0]}/{STAGED}{uuid.uuid4().hex}"
    try:
        rows.write.option("header", False).option("nullValue", "NA").csv(f"{parts}/parts")
        found = [f"{parts}/parts/{n}" for n in files.names(f"{parts}/parts") if n.startswith("part-")]
        files.concatenate(found, f"{parts}/whole", ",".join(rows.columns) + "\n")
        files.delete(path)
        files.rename(f"{parts}/whole", path)
    finally:
        files.delete(parts)


def write_upload(upload: DataFrame, base_path: str, stamp: datetime, prefix: str = UPLOAD_PREFIX) -> str:
    """Seven-column upload table as one CSV file, ordered by market and class id."""
    path = upload_path(base_path, stamp, prefix)
    single_csv(upload.orderBy(*UPLOAD_ORDER), path)
    return path


def write_review(review: DataFrame, base_path: str, stamp: datetime, mode: str = "overwrite") -> str:
    """Wide review table (factors, last month's values, month-over-month deltas) as Parquet."""
    path = f"{base_path}/{output_name(REVIEW_PREFIX, stamp)}"
    review.orderBy(*UPLOAD_ORDER).write.mode(mode).parquet(path)
    return path


def write_taxonomy(taxonomy: DataFrame, base_path: str, stamp: datetime, mode: str = "overwrite") -> str:
    """The taxonomy with its parents, ordered by category, subcategory and make name."""
    path = f"{base_path}/{output_name(TAXONOMY_PREFIX, stamp)}"
    taxonomy.orderBy(*TAXONOMY_ORDER).write.mode(mode).parquet(path)
    return path
