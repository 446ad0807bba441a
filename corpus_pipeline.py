"""The corpus pipeline: quality rules, near-dedup, substring dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and reread as the
next stage's docs. All but the last return the columns of ``documents``; further columns of the table pass through them,
whatever their names. Empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ripplebook.llm import decontam, packing, quality, simhash, substring
from ripplebook.llm.common import Scratch, closing_scratch, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every rule of the threshold table. Null and empty texts do not; repeated rows and rows without
    an id are judged each on its own."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the smallest id, null ids last, ties by the text's hash; of repeated rows
    one. Texts without words are one group."""
    return simhash.keep_one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that one of a smaller id has. Documents of which no word is left go; those that had none
    stay. Passages of rows without an id go where a row with one has them."""
    return substring.remove_repeats(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item. Null and empty texts overlap nothing; items without an id count too."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every row in sequences of 2048 tokens at most, null and empty texts as the end token alone."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

#: SimHash classes, gear-hash chunks and packing have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. What a stage has written for itself goes once the next stage's input is written."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with closing_scratch():
            before, docs = docs, scratch.save(stage(spark, docs, sf_dir), name)
        scratch.drop(before)
    return STAGES[-1][1](spark, docs, sf_dir)
