"""Kafka topics as streaming/batch sources and sinks.

The Kafka connector jar is not bundled here; these builders only assemble
the reader/writer, so they work unchanged wherever the connector is on the
classpath. Tests use file sources with Kafka-shaped rows instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def topic_options(servers: str, topic: str, starting: str = "latest", **opts: str) -> dict[str, str]:
    o = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    o.update({k: str(v) for k, v in opts.items()})
    return o


def read_topic(spark: SparkSession, servers: str, topic: str, starting: str = "latest", **opts: str) -> DataFrame:
    """Subscribe to a topic as a stream (new records only by default)."""
    return spark.readStream.format("kafka").options(**topic_options(servers, topic, starting, **opts)).load()


def replay_topic(spark: SparkSession, servers: str, topic: str, **opts: str) -> DataFrame:
    """Batch read of a whole topic from the earliest offset, values as text."""
    o = topic_options(servers, topic, "earliest", **opts)
    o["endingOffsets"] = "latest"
    return (
        spark.read.format("kafka").options(**o).load()
        .select(F.col("value").cast("string").alias("value"), "partition", "offset", "timestamp")
    )


def sink_options(servers: str, topic: str, **opts: str) -> dict[str, str]:
    o = {"kafka.bootstrap.servers": servers, "topic": topic}
    o.update({k: str(v) for k, v in opts.items()})
    return o


def publish(df: DataFrame, servers: str, topic: str, **opts: str) -> None:
    """Batch write of a ``value`` (and optional ``key``) column to a topic."""
    df.write.format("kafka").options(**sink_options(servers, topic, **opts)).save()
