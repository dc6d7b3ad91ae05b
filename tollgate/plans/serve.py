"""Score a Kafka topic into another one and log the load."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.registry import champion, read_registry
from ..sources.kafka import read_kafka, write_kafka
from ..sources.models import load_model
from ..spec import DatasetSpec
from ..streaming.scoring import route_messages
from ..streaming.telemetry import LoadLog


def serve(
    spark: SparkSession,
    spec: DatasetSpec,
    registry_path: str,
    source: Mapping[str, str],
    sink: Mapping[str, str],
    out_topic: str,
    bad_topic: str,
    checkpoint: str,
    load_log: str,
    flush_seconds: float = 60.0,
) -> StreamingQuery:
    """Start scoring with the registered model.

    The model stays for the life of the query. To take up a newer version, stop
    the query and start it again on the same checkpoint. The load log gets a file every
    ``flush_seconds`` at most, idle or not.
    """
    last = champion(read_registry(spark, registry_path), spec.name).first()
    if last is None:
        raise LookupError(f"no registered version of {spec.name}")
    name = f"score_{spec.name}_v{last.version}"
    spark.streams.addListener(LoadLog(spark, load_log, name=name, flush_seconds=flush_seconds))
    routed = route_messages(
        read_kafka(spark, source), spec, load_model(last.model_uri), out_topic, bad_topic
    )
    return write_kafka(routed, sink, checkpoint, name=name)
