"""Folds and bounded samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the decimal text of doc_id, modulo `folds`; null for a null doc_id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def bounded(rows: DataFrame, key: str, bound: int) -> DataFrame:
    """At most `bound` rows, the ones whose key has the smallest hash; the same rows on every run."""
    n = rows.count()
    if n <= bound:
        return rows
    share = bound * 1.1 / n
    some = rows.where(F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1 << 30)) < int((1 << 30) * share)) if share < 0.9 else rows
    return some.orderBy(F.xxhash64(F.lit("sample"), F.col(key)), key).limit(bound)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, bound: int) -> DataFrame:
    """(doc_id, text, y) of at most `bound` labelled documents that aren't held out.

    Rows with a null label or doc_id aren't used; a doc_id with several labels has the largest.  The sample's size is
    bounded, so the join broadcasts it and the documents aren't shuffled.
    """
    y = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("y"))
    y = y.where("doc_id IS NOT NULL AND y IS NOT NULL").where(fold(F.col("doc_id"), folds) != held_out).groupBy("doc_id").agg(F.max("y").alias("y"))
    text = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return text.join(F.broadcast(bounded(y, "doc_id", bound)), "doc_id")
