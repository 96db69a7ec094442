"""A corpus pipeline: documents -> token store, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next
stage's docs.  All stages but the last return the columns of documents.  No SQL can express the trained language model,
the hashed signatures or the tokenizer, so there is none; tests/llm compares the stages with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.decontam import decontaminate
from linkloom.llm.language import keep_identified
from linkloom.llm.mixing import mix
from linkloom.llm.neardup import near_duplicates, without_ids
from linkloom.llm.storage import Workspace
from linkloom.llm.token_store import store_round_trip


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model tells; it learns from the documents it is given."""
    return keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8): the one with the smallest doc_id.

    Rows that share a doc_id are one document, of which the smallest row stays; rows without doc_id stay.
    """
    work = Workspace(spark, "neardup")
    judged = Workspace(spark, "dedup").save(near_duplicates(docs, size=5, percent=80, space=work).select("doc_id", "kept"), "judged")
    work.clear()
    judged = judged.where("doc_id IS NOT NULL")
    out = without_ids(docs, judged.where("NOT kept").select("doc_id"))
    if judged.groupBy("doc_id").count().where("count > 1").limit(1).count():
        one = out.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
        out = one.union(out.where("doc_id IS NULL"))
    return out


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), mode="document")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of the documents that meets the target weights of sources, languages and topics."""
    return mix(docs).where("kept").select("row.*")


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token store's account of each document, as read back from its files."""
    return store_round_trip(docs)


STAGES = [
    ("language_id", identify_language),
    ("minhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", remove_contaminated),
    ("mixing", mix_sources),
    ("token_store", write_tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each written and read again."""
    space = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = space.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
