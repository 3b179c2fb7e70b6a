"""Raw topic sources and wildcard routing.

The raw feed has the Kafka source's columns ``(key, value, topic, timestamp)``. On a cluster
with the Kafka connector on the classpath use :func:`read_kafka`; everywhere else the same
rows come from files (:func:`read_raw_files`). Routing applies the broker's wildcard filter
``+/+/sensors/+/<kind>`` and keeps env and tenant from the topic (the reference loses them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldpulse.constants import KINDS
from fieldpulse.schemas import RAW


def read_raw_files(spark: SparkSession, path: str, fmt: str = "parquet", stream: bool = False) -> DataFrame:
    """Raw messages stored as files with the RAW schema (explicit schema, no inference)."""
    reader = spark.readStream if stream else spark.read
    return reader.format(fmt).schema(RAW).load(path)


def read_kafka(spark: SparkSession, bootstrap: str, topics: str, stream: bool = True,
               starting_offsets: str = "earliest") -> DataFrame:
    """Kafka source (needs the spark-sql-kafka package; untested here, no connector jar)."""
    reader = spark.readStream if stream else spark.read
    return (reader.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap)
            .option("subscribePattern" if "*" in topics else "subscribe", topics)
            .option("startingOffsets", starting_offsets)
            .load()
            .select("key", "value", "topic", "timestamp"))


def topic_parts(topic: Column) -> Column:
    return F.split(topic, "/", -1)


def route_by_topic(raw: DataFrame) -> DataFrame:
    """Add ``env, tenant, topic_device, kind``; ``kind`` is null when the topic matches none
    of the four filters ``+/+/sensors/+/<kind>`` ('+' is exactly one level, possibly empty,
    as in MQTT)."""
    with_parts = raw.withColumn("_tp", topic_parts(F.col("topic")))
    at = lambda i: F.try_element_at(F.col("_tp"), F.lit(i + 1))  # noqa: E731 (null past the end)
    ok = (F.size("_tp") == 5) & (at(2) == "sensors") & at(4).isin(*KINDS)
    return with_parts.select(
        *raw.columns,
        F.when(ok, at(0)).alias("env"),
        F.when(ok, at(1)).alias("tenant"),
        F.when(ok, at(3)).alias("topic_device"),
        F.when(ok, at(4)).alias("kind"),
    )


def select_kind(routed: DataFrame, kind: str) -> DataFrame:
    return routed.filter(F.col("kind") == kind)
