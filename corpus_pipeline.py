"""The corpus pipeline: quality classifier, line dedup, near-dedup, decontamination, source mix.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All but the last
return the columns of ``documents``; the last returns what :func:`depreco.llm.mixing.mix_sources` does,
one row for each document left. ``n_chars`` follows the text where a stage changes it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depreco.llm.catalog import table
from depreco.llm.decontaminate import decontaminate
from depreco.llm.line_dedup import line_dedup
from depreco.llm.mixing import mix_sources
from depreco.llm.near_dedup import deduplicate, near_duplicates
from depreco.llm.quality_cnn import quality_filter, train
from depreco.llm.store import Scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.5 or more. It learns from the whole tables, as operator 3 does."""
    return quality_filter(docs, train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the boilerplate lines of their source.

    Near copies count as one page, else what the members of a large group share would be taken for boilerplate."""
    rows = line_dedup(docs, classes=near_duplicates(docs))
    changed = F.when(F.col("n_dropped") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars"))
    new = {"text": F.col("text"), "n_chars": changed}
    return rows.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return deduplicate(docs)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item contaminates."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often the mix takes each document."""
    return mix_sources(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("lines", lines),
    ("near_copies", near_copies),
    ("benchmarks", benchmarks),
    ("mix", mix),
]

#: SQL cannot train or run the classifier; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir))
    return scratch.finish(STAGES[-1][1](spark, docs, sf_dir))
