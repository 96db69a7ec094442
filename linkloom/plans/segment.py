"""A segment from WAT files to the store, and its bookkeeping.

The log of events (start and end of a segment, each finished file) is append-only and the only state.  A run goes on where
the last one stopped: files with an entry aren't read again, a file's link lines are a folder of their own that a repeated
run replaces, and the segment is compacted once no file is left.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..operators.catalog import files_left, pending_files, segment_state, segments, wat_number
from ..operators.compact import compact, distinct_links
from ..operators.extract import extract
from ..schemas import COMPACT16, LINK14, PAGE10
from ..sources.readers import read_compact, read_links, read_wat
from ..sources.writers import append_log, as_lines, write_lines, write_store

EVENTS = "segment string, event string, number string, at timestamp"


def log_events(spark: SparkSession, config: EngineConfig, entries: list[tuple[str, str, str]]) -> None:
    """entries (segment, event, number): start or end of a segment, or file for a finished file; repeated events are harmless."""
    now = datetime.now(UTC)
    append_log(spark.createDataFrame([(*e, now) for e in entries], EVENTS), f"{config.folders()['log']}/events")


def events(spark: SparkSession, config: EngineConfig) -> DataFrame:
    """The log, empty before the first run."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{config.folders()['log']}/events")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], EVENTS)
    return spark.read.schema(EVENTS).parquet(path.toString())


def catalog_state(spark: SparkSession, config: EngineConfig, files: DataFrame) -> DataFrame:
    """The segments of a manifest with what the log says of them; finished ones have import_ended, so they aren't taken up again."""
    return segment_state(segments(files), events(spark, config))


def write_by_file(rows: DataFrame, names: tuple[str, ...], path: str) -> None:
    """Lines in a folder for each WAT file, by its number; only the folders of the files in `rows` are replaced."""
    lines = as_lines(rows.withColumn("number", wat_number(F.col("wat_file"))), names, "number")
    lines.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "gzip").partitionBy("number").text(path)


def import_segment(spark: SparkSession, config: EngineConfig, files: DataFrame, segment: str, base: str, save_pages: bool = False) -> DataFrame | None:
    """Imports up to `config.max_wat_files` files of a segment; once none is left, compacts it into the store.

    files: the manifest (archive, segment, segment_id, number, path); base: the folder of the WAT files.  Returns the
    compacted links, or None while files are left.  A finished segment isn't imported again.
    """
    folders, own = config.folders(), files.where(F.col("segment") == segment)
    head = own.select("archive", "segment_id").first()
    if head is None:
        raise ValueError(f"no segment {segment!r} in the manifest")
    compacted = f"{folders['links']}/compact_{head['segment_id']}"
    log = events(spark, config)
    if log.where((F.col("segment") == segment) & (F.col("event") == "end")).limit(1).count():
        return read_compact(spark, compacted)
    if not log.where((F.col("segment") == segment) & (F.col("event") == "start")).limit(1).count():
        log_events(spark, config, [(segment, "start", "")])
    done = log.where("event = 'file'").select("segment", "number")
    chosen = pending_files(own, done, config.max_wat_files).select("number", "path").collect()  # a segment has about a thousand
    links_path = f"{folders['links']}/segment_{head['segment_id']}"
    if chosen:
        pages, links = extract(read_wat(spark, [f"{base}/{r['path'].rpartition('/')[2]}" for r in chosen]))
        write_by_file(links, LINK14, links_path)
        if save_pages:
            write_by_file(pages, PAGE10, f"{folders['pages']}/segment_{head['segment_id']}")
        log_events(spark, config, [(segment, "file", r["number"]) for r in chosen])
    left = files_left(own, events(spark, config).where("event = 'file'").select("segment", "number")).first()["n_left"]
    if left:
        return None
    made = compact_links(spark, links_path, compacted)
    write_store(made, folders["store"], head["archive"], head["segment_id"])
    append_log(spark.createDataFrame([(head["archive"], segment)], "archname string, segment string"), f"{folders['log']}/imported")
    log_events(spark, config, [(segment, "end", "")])
    return made


def compact_links(spark: SparkSession, source: str, target: str | None = None) -> DataFrame:
    """Compaction on its own: a folder of link lines -> compacted rows, also as lines if a target is given."""
    made = compact(distinct_links(read_links(spark, source)))
    if not target:
        return made
    write_lines(made, COMPACT16, target)
    return read_compact(spark, target)
