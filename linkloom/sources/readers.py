"""Readers of WAT archives, manifests and the delimited link files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.predicates import is_domain
from ..schemas import COMPACT16, INTEGERS, LINK14, PAGE10

RECORD_SEPARATOR = "WARC/1.0\r\n"


def wat_records(raw: DataFrame) -> DataFrame:
    """raw (wat_file, pos, value: one WARC record) -> wat_file, pos, uri, json of records with an http address and links."""
    uri = F.trim(F.regexp_extract("value", r"WARC-Target-URI:([^\r\n]*)", 1))
    json = F.regexp_extract("value", r"(?:^|\n)(\{[^\r\n]*href[^\r\n]*)", 1)
    gate = F.col("value").contains("WARC-Target-URI: http") & F.col("value").contains("href")
    return raw.where(gate).select("wat_file", "pos", uri.alias("uri"), json.alias("json")).where(F.col("uri").startswith("http") & (F.col("json") != ""))


def read_wat(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """WAT files, one row for each metadata record.  A file isn't splittable, so a file is a task and pos its order."""
    raw = spark.read.option("lineSep", RECORD_SEPARATOR).text(path)
    return wat_records(raw.select(F.col("_metadata.file_name").alias("wat_file"), F.monotonically_increasing_id().alias("pos"), "value"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines (value) of plain or gzip files, also of gzip files to which members were appended."""
    return spark.read.text(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def parse_lines(lines: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """lines (value) -> typed columns; lines with another number of fields are skipped, bad integers are 0."""
    split = lines.select(F.split("value", "[|]", -1).alias("parts")).where(F.size("parts") == len(names))
    return split.select(*[(F.expr(f"CASE WHEN get(parts, {i}) RLIKE '^[+-]?[0-9]+$' THEN coalesce(try_cast(get(parts, {i}) AS INT), 0) ELSE 0 END") if c in INTEGERS else F.get("parts", F.lit(i))).alias(c) for i, c in enumerate(names)])


def read_links(spark: SparkSession, path: str) -> DataFrame:
    return parse_lines(spark.read.text(path), LINK14)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return parse_lines(spark.read.text(path), PAGE10)


def read_compact(spark: SparkSession, path: str) -> DataFrame:
    return parse_lines(spark.read.text(path), COMPACT16)


def loadable(compacted: DataFrame) -> DataFrame:
    """The compacted rows that a store takes: those with a well-formed link domain."""
    return compacted.where(is_domain(F.col("linkdomain")))
