"""Month-over-month state: the published factor history.

The batch is monthly and its only state is last month's published table, which the
limiter reads back (SRC-09). The history is a Parquet table partitioned by publish date:
each run appends its own partition (dynamic partition overwrite makes a re-run of the
same month idempotent), and the lookup of one month is a partition-pruned scan.
There is no continuous stream in the original batch, so no Structured Streaming query is
involved; this module is the state store between runs.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depreco.sources import schemas

PARTITION = "AppraisalBookPublishDate"
RENAMES = {
    "ResidSF": "ResidSf",
    "SFBestRetail": "RetailEconSfBest",
    "SFWorstRetail": "RetailEconSfWorst",
    "SFBestAuction": "AuctionEconSfBest",
    "SFWorstAuction": "AuctionEconSfWorst",
}


def to_history(upload: DataFrame, taxonomy: DataFrame, publish_date: date) -> DataFrame:
    """Shape an upload table like the published-factor relation (names, issue id, date)."""
    tax = taxonomy.select("ClassificationId", "CategoryId", "CategoryName", "SubcategoryId", "SubcategoryName",
                          "MakeId", "MakeName")
    j = upload.join(tax, "ClassificationId", "left")
    out = j.select(
        "MarketCode", "ClassificationId", "CategoryId", "CategoryName", "SubcategoryId", "SubcategoryName",
        "MakeId", "MakeName", *[F.col(k).alias(v) for k, v in RENAMES.items()],
        F.lit(publish_date.year * 100 + publish_date.month).alias("AppraisalBookIssueID"),
        F.lit(publish_date).alias(PARTITION),
    )
    return out


def partition_path(path: str, publish_date: date) -> str:
    """The folder of one month."""
    return f"{path.rstrip('/')}/{PARTITION}={publish_date:%Y-%m-%d}"


def append_month(history_rows: DataFrame, path: str) -> None:
    """Write (or rewrite) the month's partition only."""
    history_rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PARTITION).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the history folder is there, by the path's own file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.LAST_MONTH).parquet(path)


def read_month(spark: SparkSession, path: str, publish_date: date) -> DataFrame:
    """One month of published factors (partition-pruned)."""
    return read_history(spark, path).where(F.col(PARTITION) == F.lit(publish_date))
