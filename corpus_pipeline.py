"""Corpus pipeline: quality, line dedup, near-duplicates, decontamination, mixing.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet and read again as the next
one's ``docs``.  All but the last return the columns of ``docs``; the last adds the mixing schedule.
Stages work on whatever their predecessor kept and read other tables only for labels and benchmark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.llm.common import stored, table
from turnstile.llm.decontam import drop_contaminated
from turnstile.llm.line_templates import drop_recurring_lines
from turnstile.llm.mixing import mix_sources, size_weights
from turnstile.llm.quality_fm import with_quality
from turnstile.llm.rule_ledger import BLANKS
from turnstile.llm.simhash import drop_near_duplicates

THRESHOLD = 0.7


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores at the threshold or above."""
    scored = with_quality(docs, table(spark, sf_dir, "labels"), into="__score")
    return scored.where(F.col("__score") >= THRESHOLD).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring lines go; a document of which nothing is left goes with them."""
    out = drop_recurring_lines(docs, count_into="__dropped")
    out = out.where((F.col("__dropped") == 0) | (F.btrim("text", F.lit(BLANKS)) != ""))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__dropped") > 0, F.length("text").cast(
            docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: the smallest id."""
    return drop_near_duplicates(docs, shingle=3, max_bits=2).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All remaining documents with their place in the mix."""
    return mix_sources(docs, size_weights(docs), carried=True)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing", mixing),
]

#: trained models and hash-based grouping are not SQL: tested against brute force instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
