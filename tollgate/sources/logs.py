"""Append-only tables for training runs and stream load."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable, Mapping
from datetime import date, datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .markers import remove

RUNS = (
    "run_id string, model_name string, train_from timestamp, train_to timestamp, "
    "params map<string,string>, metrics map<string,double>, model_uri string, created_at timestamp"
)
REGISTRY = (
    "model_name string, version int, model_uri string, metric_name string, metric_mean double, "
    "metric_var double, n_rep int, prev_version int, t_stat double, p_value double, "
    "created_at timestamp"
)
STREAM_METRICS = (
    "query_id string, batch_id bigint, ts timestamp, n_in bigint, in_rate double, "
    "out_rate double, trigger_ms bigint, add_batch_ms bigint, n_late bigint, idle boolean"
)
#: Partitions of the load log.
DAY, WRITER = "log_date", "writer"
_LOAD_TABLE = f"{STREAM_METRICS}, {WRITER} string, {DAY} date"


def read_log(spark: SparkSession, path: str, schema: str, **options) -> DataFrame:
    """The table at ``path``, whatever folders its files are in; empty before the first append."""
    options = options or {"recursiveFileLookup": True}
    try:
        return spark.read.options(**options).schema(schema).parquet(path)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def append(df: DataFrame, path: str) -> None:
    """Add rows, in a folder of their own: two writers at once share no temporary folder,
    which the first to finish would delete."""
    df.coalesce(1).write.parquet(f"{path}/{uuid.uuid4().hex}")


def log_run(spark: SparkSession, run: Mapping, path: str) -> None:
    """Append one training run."""
    row = {"created_at": datetime.now(timezone.utc), **run}
    row["params"] = {k: str(v) for k, v in row["params"].items()}
    row["metrics"] = {k: None if v is None else float(v) for k, v in row["metrics"].items()}
    append(spark.createDataFrame([row], RUNS), path)


def _moment(text: str) -> datetime:
    return datetime.fromisoformat(text.replace("Z", "+00:00"))


def progress_rows(progress: Iterable) -> list[dict]:
    """One row per micro-batch from streaming progress reports.

    The rates are null where Spark could not measure them, as in a first batch. A
    batch without rows has a measured rate of 0.
    """

    def rate(value, rows):
        known = value is not None and math.isfinite(value)
        return float(value) if known and (value > 0 or rows == 0) else None

    rows = []
    for p in progress:
        spent = dict(p.durationMs)
        rows.append(
            {
                "query_id": str(p.id),
                "batch_id": int(p.batchId),
                "ts": _moment(p.timestamp),
                "n_in": int(p.numInputRows),
                "in_rate": rate(p.inputRowsPerSecond, p.numInputRows),
                "out_rate": rate(p.processedRowsPerSecond, p.numInputRows),
                "trigger_ms": spent.get("triggerExecution"),
                "add_batch_ms": spent.get("addBatch"),
                "n_late": sum(int(s.numRowsDroppedByWatermark) for s in p.stateOperators),
                "idle": False,
            }
        )
    return rows


def idle_row(query_id: str, batch_id: int, timestamp: str) -> dict:
    """A trigger that found nothing to do: no batch, and a measured rate of 0.

    Its batch is the query's last one, -1 before the first; what tells it from other
    idle triggers is its time.
    """
    row = dict.fromkeys(("out_rate", "trigger_ms", "add_batch_ms"))
    known = {"query_id": query_id, "batch_id": batch_id, "ts": _moment(timestamp)}
    return {**row, **known, "n_in": 0, "in_rate": 0.0, "n_late": 0, "idle": True}


def progress_frame(spark: SparkSession, progress: Iterable) -> DataFrame:
    return spark.createDataFrame(progress_rows(progress), STREAM_METRICS)


def log_progress(spark: SparkSession, progress: Iterable, path: str) -> None:
    """Append the load of some micro-batches."""
    log_load(spark, progress_rows(progress), path, uuid.uuid4().hex)


def log_load(spark: SparkSession, rows: list[dict], path: str, writer: str) -> None:
    """Append rows of the load log to the partition of their day, a file a day.

    Of writers at once each needs a name of its own.
    """
    dated = spark.createDataFrame(rows, STREAM_METRICS).withColumn(DAY, F.to_date("ts"))
    dated.coalesce(1).write.mode("append").partitionBy(DAY).parquet(f"{path}/{WRITER}={writer}")


def read_load(spark: SparkSession, path: str, since: date | None = None) -> DataFrame:
    """The load log, each batch and each idle trigger once; older days are not read."""
    rows = read_log(spark, path, _LOAD_TABLE, basePath=path)
    if since is not None:
        rows = rows.filter(F.col(DAY) >= F.lit(since))
    return once(rows).drop(DAY, WRITER)


def once(log: DataFrame) -> DataFrame:
    """Of rows that repeat a batch, or an idle trigger, one."""
    when = F.when(F.col("idle"), F.col("ts"))
    return log.withColumn("_when", when).dropDuplicates(["query_id", "batch_id", "_when"]).drop("_when")


def compact_load(spark: SparkSession, path: str, before: date) -> list[date]:
    """The days earlier than ``before`` that have several files get one each.

    A day's rows are written to a new file first and the old files deleted then. A
    crash in between leaves rows twice, which readers drop, and the next compaction
    mends; no row is ever missing. Returns the days. One compaction at a time.
    """
    rows = read_log(spark, path, _LOAD_TABLE, basePath=path)
    if rows.isEmpty():
        return []
    files = rows.filter(F.col(DAY) < F.lit(before)).select(DAY, F.col("_metadata.file_path").alias("file"))
    several = files.groupBy(DAY).agg(F.collect_set("file").alias("files")).filter(F.size("files") > 1)
    done = []
    for day in several.orderBy(DAY).toLocalIterator():  # a day has as many files as flushes
        old = spark.read.schema(_LOAD_TABLE).option("basePath", path).parquet(*day["files"])
        one = once(old).withColumn(WRITER, F.lit("compacted")).coalesce(1)
        one.write.mode("append").partitionBy(WRITER, DAY).parquet(path)
        remove(spark, day["files"])
        done.append(day[DAY])
    return done
