"""Production inputs: the ten logical relations read from storage with explicit schemas.

``TableInputs`` has the same attributes as the fixture ``Inputs`` so ``plans.pipeline.Run``
accepts either. A relation is a path (Parquet by default; the schedule maps often arrive as CSV
exports) or, with the format ``table``, the name of a table or view of the session's catalog.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depreco.sources import schemas

NAMES = list(schemas.BY_NAME)


def read_table(spark: SparkSession, source: str, name: str, fmt: str = "parquet") -> DataFrame:
    """The relation ``name`` from a path or a named table, with the declared columns and types."""
    schema = schemas.BY_NAME[name]
    if fmt == "table":
        return spark.table(source).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    reader = spark.read.schema(schema)
    if fmt == "csv":
        return reader.option("header", True).option("nullValue", "NA").csv(source)
    return reader.format(fmt).load(source)


class TableInputs:
    def __init__(self, spark: SparkSession, paths: dict[str, str], formats: dict[str, str] | None = None):
        missing = [n for n in NAMES if n not in paths]
        if missing:
            raise ValueError(f"missing input paths: {missing}")
        formats = formats or {}
        for n in NAMES:
            setattr(self, n, read_table(spark, paths[n], n, formats.get(n, "parquet")))
