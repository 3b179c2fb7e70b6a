"""The corpus pipeline: documents through five stages, each written as Parquet and read again.

toxicity -> SimHash near-duplicates -> benchmark decontamination -> mixing to targets -> sharding.
Each stage works on everything its predecessor kept; all but the last return the columns of
``documents``. The last adds ``shard`` and ``slot``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldpulse.llm import decontaminate, mixing, sharding, simhash, toxicity
from fieldpulse.llm._common import read_table, scratch_path, staged


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier chain calls toxic go."""
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash group stays (four-word shingles, four bits)."""
    return simhash.keep_one_per_group(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with benchmark passages on at least one word in twenty go."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows drawn so that the tokens follow the targets by source, language and topic."""
    return mixing.sample_to_targets(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row in a uniform order, dealt to shards."""
    got = sharding.shuffle_to_shards(docs, scratch_path(spark, "pipeline-shards"))
    return got.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in ("shard", "slot")], "shard", "slot")


STAGES = [("toxicity", drop_toxic), ("simhash_near_dedup", drop_near_duplicates), ("decontamination", drop_contaminated),
          ("mixing", mix_to_targets), ("sharding", shard)]

#: A trained classifier, fingerprints' components and seeded draws are beyond SQL; the tests hold the
#: stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
