"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage
before kept, and returns a DataFrame; all but the last return the columns of
documents.  ``run`` writes each stage's rows to the shared folder and reads
them as the next one's input.

Null or empty texts, null values, very long texts, repeated rows and extra
columns go through every stage as its operator defines (see the operators'
modules): the rules' base rule ends texts without 50 words, near-dedup keeps
one row of those that repeat and every row without an id, mixing gives rows
of one id one fate.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm import common, cotraining, mixing, neardup, packing, quality_rules
from tickforge.llm.queries import WORDS, vocabulary


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier takes for bad or toxic go."""
    model = cotraining.train(docs, common.table(spark, sf_dir, "labels"))
    return cotraining.filter_documents(docs, model)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the learned decision list rejects go.

    The list is learned from the labelled documents of the whole table: what
    the classifier has left holds hardly any bad ones to learn from.
    """
    learned = quality_rules.learn_from(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
    return quality_rules.filter_documents(docs, learned)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays (five words, 0.8)."""
    return neardup.one_of_each(docs, width=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled by the calibrated probabilities of their cells."""
    dims = {"source": docs["source"], "lang": docs["lang"], "topic": mixing.topic(docs["text"])}
    return mixing.sample(docs, dims, mixing.tokens(docs["text"]))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.pack(docs, vocabulary(WORDS)).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", rules),
    ("near-dedup", near_dedup),
    ("mixing", mix),
    ("packing", pack),
]

# A fitted classifier and learned rules have no SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
