"""Writers of the delimited files and of the Parquet link store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .readers import loadable


def as_lines(rows: DataFrame, names: tuple[str, ...], *more: str) -> DataFrame:
    """value: the named fields as a line; and the columns `more` as they are."""
    return rows.select(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names]).alias("value"), *more)


def write_lines(rows: DataFrame, names: tuple[str, ...], path: str, mode: str = "overwrite") -> None:
    as_lines(rows, names).write.mode(mode).option("compression", "gzip").text(path)


def write_store(compacted: DataFrame, path: str, archive: str, segment_id: int) -> None:
    """Adds a segment to the store, in its own partition, so that a repeated load replaces it.

    Rows are ordered by link domain, so a lookup reads few row groups.
    """
    rows = loadable(compacted).repartitionByRange("linkdomain").sortWithinPartitions("linkdomain", "linksubdomain", "linkpath", "linkrawquery")
    rows.write.mode("overwrite").parquet(f"{path}/archive={archive}/segment_id={segment_id}")


def append_log(rows: DataFrame, path: str) -> None:
    """Adds entries to an append-only log (imports, finished files, segment events)."""
    rows.coalesce(1).write.mode("append").parquet(path)
