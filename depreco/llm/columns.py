"""Column helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, **made: Column) -> DataFrame:
    """``df`` with further columns that are computed once for each row.

    The optimizer copies a plain derived column to every place that uses it, into the lambdas of
    higher-order functions too, where it would be computed again for each element. A generator of one
    row keeps it whole."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in made.items()]))))
