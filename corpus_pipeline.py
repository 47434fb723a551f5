"""The corpus pipeline: toxicity, near-duplicates, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as Parquet in
the shared folder and reads it again as the next stage's ``docs``.

Defined results of every stage: all columns of its input are kept as they are, nulls included, and columns beyond
those of documents as well, whatever their names; an empty table gives an empty table.

* toxicity: null and blank texts are never toxic; rows that repeat an id or text are judged one by one and alike.
* near_duplicates: of a group, and of rows that repeat an id, one row stays; null ids and empty texts have no copies.
* decontamination: null text has no hits; rows that repeat an id are judged one by one.
* mixing: null languages and sources are leaves of their own; a leaf without tokens is taken whole; rows that repeat
  an id in a leaf go together, null ids too.
* sharding: null ids and repeated rows each get their own slot. The result adds the plan's columns; input columns of
  those names are in the shard files but not in the result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hangarlight.llm import decontaminate, mixing, neardup, reshard, toxicity
from hangarlight.llm.common import checkpoint_dir, table

#: Share of the surviving tokens that the mixture takes, each document at most once.
MIX_FRACTION = 0.6


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of a toxic grade is below the threshold; the model is fitted on their labels."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each near-duplicate group."""
    return neardup.dedup(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A token-prefix of each leaf under the target weights."""
    return mixing.mix(docs, MIX_FRACTION, max_epochs=1)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the written shard files hold them, with shard and slot."""
    return reshard.reshard_files(docs, f"{checkpoint_dir(spark)}/shards_{uuid.uuid4().hex}")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", remove_benchmark),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: Near-duplicate components and a fitted model are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents table."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_dir(spark)}/pipeline_{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
