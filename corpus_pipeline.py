"""The corpus pipeline: quality rules, line dedup, near-duplicates,
decontamination, mixing.

Every stage takes (spark, docs, sf_dir). run() writes each stage's result as
Parquet to the shared folder and reads it again as the next one's input.

Defined results, in all stages: columns besides those of documents pass
through untouched, whatever their names, but that the last one's mix_copies
and mix_words take the place of columns so named; an empty table stays empty.
Null and empty texts have no word and go with the quality rules. A null id is
an id like others, last among ties. Rows that repeat id and text are judged
alike by the first two stages; the third keeps one row of each group, the one
with the least id, so of rows that repeat one is left. Lines stay where they
first occur, by id and place. A null source is a site and a source of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyplan.llm.common import read, scratch_drop, scratch_mark, written
from skyplan.llm.decontaminate import decontaminate
from skyplan.llm.line_dedup import dedup_lines
from skyplan.llm.mixing import mix
from skyplan.llm.quality_rules import filter_quality
from skyplan.llm.simhash import keep_one


def recounted(docs: DataFrame) -> DataFrame:
    """docs with n_chars of the texts as they now are."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a rule rejects go."""
    return filter_quality(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines stay only where they first occur."""
    return recounted(dedup_lines(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages go, and documents that are mostly such."""
    return recounted(decontaminate(docs, read(spark, sf_dir, "benchmark")))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with mix_copies and mix_words."""
    return mix(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: The last stage draws at random and the third is iterative.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, mark = read(spark, sf_dir, "documents"), scratch_mark()
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
        scratch_drop(mark, docs)  # the stage's own tables and its input
    return docs
