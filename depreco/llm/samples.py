"""Bounded samples of labelled rows for training on the driver.

A sample is bounded in rows, whatever their texts' lengths. What training needs of the texts is made of them in
tasks (counts, chosen terms); only where it needs the texts themselves is their total size bounded as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import Scratch

#: Most bytes of text of one label value that come to the driver, where texts do.
MOST_BYTES = 24 << 20


def fold(id_col: str = "doc_id"):
    """crc32 of the id as text, modulo 3; rows of fold 1 are never learned from. A null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(3))


def picked(docs: DataFrame, labels: DataFrame, label: str, per_class: dict[int, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, _label, _place, _text): at most ``per_class[v]`` rows of each label value v, outside fold 1, whole texts.

    The rows are those of the smallest hashes of their ids (``_place``), so reruns agree and a text's length plays no part;
    ids are picked from the slim label table first and, as their number is bounded by ``per_class``, broadcast to
    the texts. Of the rows that share an id one text, that of the smallest hash, is left. Null ids or labels and
    repeated label rows are left out of training. The sample is written once, into the run's own folder."""
    known = labels.filter(F.col(label).isNotNull() & F.col(id_col).isNotNull()).filter(fold(id_col) != 1)
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.min(label).cast("int").alias("_label")).withColumn("_place", F.xxhash64(F.lit(11), "_id"))
    ids = None
    for value, most in per_class.items():
        part = known.filter(F.col("_label") == value).orderBy("_place", "_id").limit(most)
        ids = part if ids is None else ids.union(part)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_text")).join(F.broadcast(ids), "_id")
    rows = rows.groupBy("_id", "_label", "_place").agg(F.min_by("_text", F.xxhash64("_text")).alias("_text"))
    return Scratch(docs.sparkSession).keep(rows)


def labelled(
    docs: DataFrame, labels: DataFrame, label: str, per_class: dict[int, int], id_col: str = "doc_id", text_col: str = "text", most_bytes: int = MOST_BYTES
) -> list[tuple[str, int]]:
    """(text, label) of the picked rows whose texts, in the order of their places, come to ``most_bytes`` of each label
    value at most. A long text is as eligible as a short one, unless it alone exceeds the bound."""
    rows = picked(docs, labels, label, per_class, id_col, text_col)
    taken, total = [], dict.fromkeys(per_class, 0)
    sizes = rows.select("_id", "_label", "_place", F.octet_length("_text").alias("size")).filter(F.col("size") <= most_bytes).collect()
    for r in sorted(sizes, key=lambda r: (r._place, r._id)):
        total[r._label] += r.size
        if total[r._label] <= most_bytes:
            taken.append((r._id,))
    if not taken:
        return []
    ids = rows.sparkSession.createDataFrame(taken, rows.select("_id").schema)
    found = rows.join(F.broadcast(ids), "_id").select("_id", "_label", "_text").collect()
    return [(r._text, r._label) for r in sorted(found, key=lambda r: r._id)]
