"""The import catalog: segments and files of an archive, their state, and what is to do next."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NUMBER = r"-(\d+)\.warc\.wat\.gz$"


def wat_number(path: Column) -> Column:
    """The number in a file name, as text; null without one."""
    return F.nullif(F.regexp_extract(path, _NUMBER, 1), F.lit(""))


def is_archive_name(name: Column) -> Column:
    return name.rlike(r"^CC-MAIN-\d{4}-\d{2}\z")


def parse_segments(text: str) -> list[int]:
    """`a,b,c`, `a-b` (both included) or one number."""
    if not text:
        return []
    parts = text.split(",") if "," in text else None
    try:
        if parts:
            return [int(p) for p in parts]
        if "-" in text:
            low, high = (int(x) for x in text.split("-"))
            if low > high:
                raise ValueError
            return list(range(low, high + 1))
        return [int(text)]
    except ValueError as e:
        raise ValueError(f"not a list or range of segments: {text!r}") from e


def manifest(lines: DataFrame) -> DataFrame:
    """lines (value) -> archive, segment, segment_id, number, path: a row for each WAT file."""
    part = F.split("value", "/")
    rows = lines.where(F.size(part) > 4).select(F.get(part, F.lit(1)).alias("archive"), F.get(part, F.lit(3)).alias("segment"), F.col("value").alias("path"))
    return rows.select("archive", "segment", F.expr("try_cast(get(split(segment, '[.]'), 1) AS INT)").alias("segment_id"), wat_number(F.col("path")).alias("number"), "path")


def segments(files: DataFrame) -> DataFrame:
    """A row for each segment with its files in order."""
    return files.groupBy("archive", "segment", "segment_id").agg(F.array_sort(F.collect_list(F.struct("number", "path"))).alias("wat_files")).orderBy("segment_id")


def segment_state(found: DataFrame, log: DataFrame) -> DataFrame:
    """segments and the event log (segment, event, at) -> import_started (the first) and import_ended (the last)."""
    state = log.groupBy("segment").agg(F.min(F.when(F.col("event") == "start", F.col("at"))).alias("import_started"), F.max(F.when(F.col("event") == "end", F.col("at"))).alias("import_ended"))
    return found.join(state, "segment", "left")


def next_segment(state: DataFrame) -> DataFrame:
    """The first segment that isn't finished."""
    return state.where("import_ended IS NULL").orderBy("segment_id").limit(1)


def segment_by_id(state: DataFrame, ids: list[int]) -> DataFrame:
    return state.where(F.col("segment_id").isin(ids))


def pending_files(files: DataFrame, done: DataFrame, limit: int | None = None) -> DataFrame:
    """Files of the manifest without an entry (segment, number) in the completion log."""
    left = files.join(done.select("segment", "number").distinct(), ["segment", "number"], "left_anti").orderBy("segment_id", "number")
    return left.limit(limit) if limit is not None else left


def files_left(files: DataFrame, done: DataFrame) -> DataFrame:
    """For each segment the number of files and of those still to do."""
    marked = files.join(done.select("segment", "number").distinct().withColumn("imported", F.lit(True)), ["segment", "number"], "left")
    return marked.groupBy("segment").agg(F.count(F.lit(1)).alias("n_files"), F.count_if(F.col("imported").isNull()).alias("n_left"))


def check_archive(name: str) -> str:
    if not re.fullmatch(r"CC-MAIN-\d{4}-\d{2}", name):
        raise ValueError(f"not an archive name: {name!r}")
    return name
