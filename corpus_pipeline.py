"""A training corpus from ``documents``: five stages, each an operator applied to all that the one before it kept.

All stages but the last return their rows as they came, with every column, also ones whose names an operator uses itself.
A null id, text or source is a value like others: no stage drops a row for it. Rows that repeat an id or a text are judged
each, save that near copies and equal rows leave one. An empty table goes through all stages and gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.llm import decontaminate, mixing, near_copies, toxicity
from waybill.llm import token_records as records
from waybill.llm.common import carried, shared_path, staged


OWN = ("doc_id", "text")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half; labels that are not held out teach the scores.

    Null and empty texts have the score of the base rate; a score of one half goes; without labels every document stays.
    """
    rows, named = carried(docs, OWN)
    scored = toxicity.score(spark, rows, toxicity.learn(spark, docs, sf_dir), rows.columns)
    return named(scored.where(F.col("score") < 0.5))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of the smallest id, of each class connected by 5-word shingle similarities of 0.8 or more.

    SimHash finds most links and prefix filtering the rest. Null and empty texts are copies of each other; a null id comes
    last; of equal rows one stays.
    """
    rows, named = carried(docs, OWN)
    return named(near_copies.keep_one(spark, rows))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs; null and empty texts have none."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows, named = carried(docs, OWN)
    found = decontaminate.find_contamination(spark, rows, benchmark, keep=rows.columns)
    return named(found.where(F.size("spans") == 0))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in as many copies as the mix of sources takes of them; those without words stay once, a null source is one."""
    rows, named = carried(docs, (*OWN, "source"))
    return named(mixing.mixed_rows(spark, rows))


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the record files of the corpus hold, as read back: a row for each record; null texts have only the end id."""
    out = records.token_records(spark, docs, records.vocabulary_path(), shared_path(spark, "corpus"))
    return out.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near-dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token records", write_tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(spark, stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
