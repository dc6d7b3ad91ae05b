"""Does the scoring cluster need more or fewer machines?"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.logs import once

_CHUNK = 100_000


def recent(
    df: DataFrame, n: int, value: str, chunk: int = _CHUNK, order: str = "batch_id"
) -> DataFrame:
    """Mean and count of ``value`` over each batch and the n-1 numbers before it.

    ``order`` numbers a query's rows. Its log is cut into chunks of numbers, each with
    the last n-1 of the chunk before it, so a long-lived query does not end up in one
    task.
    """
    if not 1 <= n <= chunk:
        raise ValueError("n must be between 1 and the chunk size")
    home = F.floor(F.col(order) / chunk)
    near_end = F.pmod(F.col(order), F.lit(chunk)) >= chunk - (n - 1)
    both = F.when(near_end, F.array(home, home + 1)).otherwise(F.array(home))
    spread = df.withColumn("_home", home).withColumn("_chunk", F.explode(both))
    frame = Window.partitionBy("query_id", "_chunk").orderBy(order).rangeBetween(-(n - 1), 0)
    return (
        spread.withColumns(
            {
                f"{value}_mean": F.avg(value).over(frame),
                f"{value}_count": F.count(value).over(frame),
            }
        )
        .filter(F.col("_chunk") == F.col("_home"))
        .drop("_home", "_chunk")
    )


def numbered(log: DataFrame) -> DataFrame:
    """The batches and idle triggers of each query once, numbered in order of time (``seq``).

    Rows are numbered within a day, and days by their counts, so neither a long-lived
    query nor one that was idle for months under one batch id ends up in one task.
    """
    rows = once(log).withColumn("_day", F.to_date("ts"))
    days = rows.groupBy("query_id", "_day").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("query_id").orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    days = days.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    days = days.toDF("_query", "_date", "_before")
    same = (F.col("query_id") == F.col("_query")) & F.col("_day").eqNullSafe(F.col("_date"))
    within = F.row_number().over(Window.partitionBy("query_id", "_day").orderBy("ts", "batch_id", "idle"))
    numbered_rows = rows.withColumn("_place", within).join(days, same)
    seq = (F.col("_before") + F.col("_place")).alias("seq")
    return numbered_rows.select(*log.columns, seq)


def scaling_signal(
    stream_metrics: DataFrame, n: int = 5, hi: float = 0.8, lo: float = 0.3
) -> DataFrame:
    """K6: ``out``, ``in`` or ``hold`` after every batch and every idle trigger.

    The measure is input rate over processing rate, averaged over the last n of them.
    Nothing coming in is a load of 0. A batch without measured rates has no ratio, and
    until n rows have one the signal is ``hold``. Of rows that repeat a batch one
    counts. A log without ``idle`` and ``ts`` holds batches only, n batch ids apart.
    """
    timed = {"idle", "ts"} <= set(stream_metrics.columns)
    rows = numbered(stream_metrics) if timed else stream_metrics.dropDuplicates(["query_id", "batch_id"])
    busy = F.col("in_rate") / F.nullif("out_rate", F.lit(0.0))
    ratio = F.when(F.col("in_rate") == 0, 0.0).when(F.col("in_rate") > 0, busy)
    load = recent(rows.withColumn("ratio", ratio), n, "ratio", order="seq" if timed else "batch_id")
    full = F.col("ratio_count") >= n
    signal = (
        F.when(full & (F.col("ratio_mean") > hi), "out")
        .when(full & (F.col("ratio_mean") < lo), "in")
        .otherwise("hold")
    )
    order = ["seq", "ts", "idle"] if timed else []
    return load.select("query_id", "batch_id", *order, "ratio", "ratio_mean", signal.alias("signal"))
