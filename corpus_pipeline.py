"""A training corpus from `documents`: filter, dedup, mix and pack, one operator a stage.

Each stage reads what the stage before has written. All but the last keep the columns of documents.
"""

from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from agoralake.llm.common import small_batches, stored, work_folder
from agoralake.llm.grammar import train_grammar, without_toxic
from agoralake.llm.line_dedup import line_dedup
from agoralake.llm.mixing import mix_sources, mixed
from agoralake.llm.ngram_join import one_of_each
from agoralake.llm.packing import pack

#: Weights of the sources, by name; without any they follow the sources' sizes.
WEIGHTS: dict[str, float] | None = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar, learned from the labelled ones among them, does not reject."""
    small_batches(spark)
    grammar = train_grammar(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return without_toxic(docs, grammar)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, but for those in the last document that holds them."""
    return line_dedup(docs).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links by five-word shingles with Jaccard 0.8 or more."""
    return one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order in which their sources' blocks are scheduled."""
    return mixed(docs, weights=WEIGHTS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document, with its batch; batches fill in the order of mixing.

    Rows of files have no order that holds, so the slots are told again from ids and sources.
    """
    return pack(docs, place=lambda rows: mix_sources(rows, weights=WEIGHTS))


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", lines),
    ("ngram_join", near_duplicates),
    ("mixing", mixing),
    ("packing", packing),
]

#: Toxicity scores come from a learned model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to shared scratch and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = work_folder(spark)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), folder, name)
    return STAGES[-1][1](spark, docs, sf_dir)
