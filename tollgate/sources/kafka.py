"""Kafka as source and sink.

Needs org.apache.spark:spark-sql-kafka-0-10 on the cluster. Options go to the
connector as they are (kafka.bootstrap.servers, subscribe, startingOffsets,
maxOffsetsPerTrigger, ...).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def read_kafka(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()


def write_kafka(
    df: DataFrame,
    options: Mapping[str, str],
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """At least once: after a failure a batch may be sent again, so consumers
    drop repeats by key. ``df`` has ``key`` and ``value``, and ``topic`` unless
    the options name one topic for all rows."""
    writer = (
        df.writeStream.format("kafka")
        .options(**options)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
    )
    return (writer.queryName(name) if name else writer).start()
