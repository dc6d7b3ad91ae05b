"""Queries on streams: K1-K6, W2, C6 on streams. Messages have Kafka's columns."""

from __future__ import annotations

import uuid
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.clean import dedup_stream
from ..operators.scaling import recent, scaling_signal
from ..operators.train import fit
from ..session import scratch, spread
from ..sources.logs import compact_load, log_progress, read_load
from ..spec import schema_of
from ..streaming.messages import MESSAGES, decode
from ..streaming.scoring import route_messages, score_messages
from ..streaming.telemetry import LoadLog, volume_by_window
from .data import LINEITEM, LINEITEM_FEATURES, bayes_sql, seconds, table
from .training import BAYES, NB_SCORES_SQL, returned_items

QUERIES = {}
ORACLES = {}

_REST = {"user_id": "long", "event_type": "string", "value": "double"}
_EVENT_MESSAGE = schema_of(event_id="long", ts="timestamp", **_REST)
# Wider than the data: a file stream gives no order of time.
_WIDE = "40 days"


def _messages(spark: SparkSession, df: DataFrame, key: Column, value: Column, path: str) -> DataFrame:
    """Rows stored as messages and read back as a stream."""
    rows = spread(df).select(
        key.cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit("in").alias("topic"),
        F.lit(0).alias("partition"),
        F.lit(0).cast("long").alias("offset"),
        F.lit(0).cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
    rows.write.mode("append").parquet(path)
    return spark.readStream.schema(MESSAGES).parquet(path)


def _row_json(df: DataFrame) -> Column:
    return F.to_json(F.struct(*df.columns))


def _run(
    df: DataFrame, spark: SparkSession, out: str | None = None, checkpoint: str | None = None
) -> tuple[StreamingQuery, DataFrame]:
    """All available input through the query into a table. With the table and checkpoint
    of an earlier run, it goes on where that one ended."""
    out = out or scratch(spark, "stream-out")
    query = (
        df.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint or scratch(spark, "stream-checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query, spark.read.schema(df.schema).parquet(out)


def stream_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1, K2, K3: line items as messages, scored, sent out and read back."""
    items = returned_items(spark, sf_dir)
    model = fit(items, LINEITEM, BAYES)
    sent = items.select(*LINEITEM.columns)
    key = F.col("l_orderkey").cast("string")
    stream = _messages(spark, sent, key, _row_json(sent), scratch(spark, "messages"))
    _, out = _run(score_messages(stream, LINEITEM, model), spark)
    result = F.from_json(
        "value", "l_orderkey bigint, l_linenumber int, prediction double, p double"
    ).alias("r")
    return out.select(result).select(
        "r.l_orderkey", "r.l_linenumber", "r.prediction", F.round("r.p", 6).alias("p")
    )


QUERIES["stream_scores"] = stream_scores
ORACLES["stream_scores"] = NB_SCORES_SQL

_CUT_SHORT = "l_linestatus = 'O' AND l_tax = 0"


def stream_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1, K3: messages cut short go to one topic, predictions to another."""
    items = returned_items(spark, sf_dir)
    model = fit(items, LINEITEM, BAYES)
    sent = items.select(*LINEITEM.columns)
    whole = _row_json(sent)
    value = F.when(F.expr(_CUT_SHORT), F.substring(whole, 1, 20)).otherwise(whole)
    key = F.col("l_orderkey").cast("string")
    stream = _messages(spark, sent, key, value, scratch(spark, "messages"))
    _, out = _run(route_messages(stream, LINEITEM, model, "scores", "bad"), spark)
    p = F.from_json("value", "p double")["p"]
    return out.select("topic", "key", F.round(F.when(F.col("topic") == "scores", p), 6).alias("p"))


QUERIES["stream_routing"] = stream_routing
ORACLES["stream_routing"] = f"""
WITH {bayes_sql(LINEITEM_FEATURES.replace("FROM lineitem", f", ({_CUT_SHORT}) AS cut FROM lineitem"), 5)}
SELECT CASE WHEN cut THEN 'bad' ELSE 'scores' END AS topic,
       CASE WHEN NOT cut THEN l_orderkey || '#' || l_linenumber END AS key,
       CASE WHEN NOT cut THEN round(p, 6) END AS p
FROM m_scored"""


_INCOMPLETE = "l_tax = 0.03 AND l_linestatus = 'F'"
_NOT_A_NUMBER = "l_tax = 0.04 AND l_linestatus = 'F'"


def stream_incomplete_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: messages that lack the quantity, or have NaN for it, are told apart with the
    reason, and the others are scored."""
    items = returned_items(spark, sf_dir)
    model = fit(items, LINEITEM, BAYES)
    quantity = F.when(F.expr(_INCOMPLETE), None).when(F.expr(_NOT_A_NUMBER), float("nan"))
    sent = items.select(*LINEITEM.columns).withColumn("l_quantity", quantity.otherwise(F.col("l_quantity")))
    key = F.col("l_orderkey").cast("string")
    stream = _messages(spark, sent, key, _row_json(sent), scratch(spark, "messages"))
    _, out = _run(route_messages(stream, LINEITEM, model, "scores", "bad"), spark)
    good = F.col("topic") == "scores"
    p = F.when(good, F.from_json("value", "p double")["p"])
    why = F.col("headers")[0]["value"].cast("string")
    return out.select("topic", "key", F.round(p, 6).alias("p"), why.alias("why"))


QUERIES["stream_incomplete_messages"] = stream_incomplete_messages
_LACKING = f"(({_INCOMPLETE}) OR ({_NOT_A_NUMBER}))"
ORACLES["stream_incomplete_messages"] = f"""
WITH {bayes_sql(LINEITEM_FEATURES.replace("FROM lineitem", f", {_LACKING} AS lacking FROM lineitem"), 5)}
SELECT CASE WHEN lacking THEN 'bad' ELSE 'scores' END AS topic,
       CASE WHEN NOT lacking THEN l_orderkey || '#' || l_linenumber END AS key,
       CASE WHEN NOT lacking THEN round(p, 6) END AS p,
       CASE WHEN lacking THEN 'number:l_quantity' END AS why
FROM m_scored"""


def decode_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 on stored messages: the events' own JSON, error events' cut short."""
    events = table(spark, sf_dir, "events")
    props = F.col("props")
    value = F.when(F.col("event_type") == "error", F.substring(props, 1, 4)).otherwise(props)
    messages = events.select(value.cast("binary").alias("value"))
    ok, bad = decode(messages, schema_of(k="integer"))
    return ok.select("k", F.lit(None).cast("string").alias("payload")).unionByName(
        bad.select(F.lit(None).cast("int").alias("k"), "payload")
    )


QUERIES["decode_messages"] = decode_messages
ORACLES["decode_messages"] = """
SELECT CASE WHEN event_type <> 'error' THEN CAST(props ->> '$.k' AS INTEGER) END AS k,
       CASE WHEN event_type = 'error' THEN substr(props, 1, 4) END AS payload
FROM events"""


def _event_stream(spark: SparkSession, events: DataFrame, path: str) -> DataFrame:
    sent = events.select(*_EVENT_MESSAGE.fieldNames())
    stream = _messages(spark, sent, F.col("event_id").cast("string"), _row_json(sent), path)
    ok, _ = decode(stream, _EVENT_MESSAGE)
    return ok


def stream_volume_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: events per six hours. One message far in the future moves the watermark
    past all windows, so that they are final and come out."""
    events = table(spark, sf_dir, "events")
    path = scratch(spark, "messages")
    _event_stream(spark, events, path)
    last = events.agg(F.max("event_id").alias("event_id"), F.max("ts").alias("ts"))
    closing = last.select(
        "event_id",
        F.expr("ts + INTERVAL 90 DAYS").alias("ts"),
        *[F.lit(None).cast(t).alias(c) for c, t in _REST.items()],
    )
    counted = volume_by_window(_event_stream(spark, closing, path), "6 hours", delay=_WIDE)
    _, out = _run(counted, spark)
    return out.select(seconds("window_start").alias("window_start"), "n")


QUERIES["stream_volume_window"] = stream_volume_window
ORACLES["stream_volume_window"] = """
SELECT strftime(make_timestamp(CAST(floor(epoch(ts)) AS BIGINT) // 21600 * 21600 * 1000000),
                '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n
FROM events GROUP BY 1"""


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C6 on a stream: all purchases and errors arrive a second time."""
    events = table(spark, sf_dir, "events")
    path = scratch(spark, "messages")
    _event_stream(spark, events, path)
    again = events.filter(F.col("event_type").isin("purchase", "error"))
    stream = _event_stream(spark, again, path)
    _, out = _run(dedup_stream(stream, ["event_id"], "ts", _WIDE), spark)
    return out.select("event_id", seconds("ts").alias("ts"), "user_id", "event_type", "value")


QUERIES["stream_dedup"] = stream_dedup
ORACLES["stream_dedup"] = """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id, event_type, value FROM events"""


def stream_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The load log of a scoring run; rates and times vary from run to run."""
    items = returned_items(spark, sf_dir)
    model = fit(items, LINEITEM, BAYES)
    sent = items.select(*LINEITEM.columns)
    key = F.col("l_orderkey").cast("string")
    stream = _messages(spark, sent, key, _row_json(sent), scratch(spark, "messages"))
    query, _ = _run(score_messages(stream, LINEITEM, model), spark)
    path = scratch(spark, "load-log")
    log_progress(spark, query.recentProgress, path)
    return read_load(spark, path).select(
        "batch_id", "n_in", "in_rate", "out_rate", "trigger_ms", "add_batch_ms"
    )


QUERIES["stream_performance"] = stream_performance


def _scored_groups(spark: SparkSession, sf_dir: str) -> list:
    """Line items scored as a stream of three groups, one a batch: the progress reports.

    A group is written by many tasks, to as many files, and the stream then goes on with
    what is new, so that a batch is one group however many files hold it."""
    items = returned_items(spark, sf_dir)
    model = fit(items, LINEITEM, BAYES)
    sent = items.select(*LINEITEM.columns)
    path, key = scratch(spark, "messages"), F.col("l_orderkey").cast("string")
    out, checkpoint = scratch(spark, "stream-out"), scratch(spark, "stream-checkpoint")
    progress = []
    for group in range(3):
        part = sent.filter(F.col("l_orderkey") % 3 == group)
        stream = _messages(spark, part, key, _row_json(sent), path)
        query, _ = _run(score_messages(stream, LINEITEM, model), spark, out, checkpoint)
        progress += query.recentProgress
    return progress


def stream_load_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The logged load of a scoring run, in what does not vary: rows a batch,
    rates above zero, and no batch longer than its trigger. Each batch is logged twice, as
    after a lost acknowledgement, and the days are compacted; it is read once."""
    progress, path = _scored_groups(spark, sf_dir), scratch(spark, "load-log")
    for _ in range(2):
        log_progress(spark, progress, path)
    compact_load(spark, path, date.today() + timedelta(days=2))
    return read_load(spark, path).select(
        "batch_id",
        "n_in",
        "n_late",
        (F.col("out_rate") > 0).alias("measured"),
        (F.col("add_batch_ms") <= F.col("trigger_ms")).alias("in_time"),
        (F.count("*").over(Window.partitionBy("query_id")) == F.lit(3)).alias("complete"),
    )


QUERIES["stream_load_log"] = stream_load_log
ORACLES["stream_load_log"] = """
SELECT l_orderkey % 3 AS batch_id, count(*) AS n_in, CAST(0 AS BIGINT) AS n_late, TRUE AS measured,
       TRUE AS in_time, TRUE AS complete
FROM lineitem GROUP BY 1"""


def idle_stream_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream gets the events and then nothing more. Its log, written by the
    listener while it runs, says how many came and that the cluster may shrink."""
    messages = scratch(spark, "messages")
    stream = _event_stream(spark, table(spark, sf_dir, "events"), messages)
    path, name = scratch(spark, "load-log"), f"idle_{uuid.uuid4().hex}"
    log = LoadLog(spark, path, name=name, flush_seconds=1.0)
    # a report from an idle stream every 200 ms instead of every ten seconds
    asked = spark.conf.get(_IDLE_EVERY)
    spark.conf.set(_IDLE_EVERY, "200")
    spark.streams.addListener(log)
    try:
        query = (
            stream.writeStream.format("parquet").queryName(name).trigger(processingTime="100 milliseconds")
            .option("path", scratch(spark, "stream-out"))
            .option("checkpointLocation", scratch(spark, "stream-checkpoint"))
            .start()
        )
    finally:
        spark.conf.set(_IDLE_EVERY, asked)
    query.processAllAvailable()
    log.wait(lambda: log.idle_triggers >= 6, seconds=120)
    query.stop()
    log.wait(lambda: log.closed, seconds=120)
    signals = scaling_signal(read_load(spark, path))
    last = F.max_by(F.struct("signal", "idle"), "seq").alias("last")
    rows = signals.join(read_load(spark, path).select("ts", "batch_id", "n_in"), ["ts", "batch_id"])
    return rows.groupBy("query_id").agg(F.sum("n_in").alias("n_in"), last).select(
        "n_in", F.col("last.signal").alias("signal"), F.col("last.idle").alias("idle")
    )


_IDLE_EVERY = "spark.sql.streaming.noDataProgressEventInterval"
QUERIES["idle_stream_signal"] = idle_stream_signal
ORACLES["idle_stream_signal"] = """
SELECT count(*) AS n_in, 'in' AS signal, TRUE AS idle FROM events"""


def load_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load log made from the events: one query per event type, one batch per
    six hours. The mean value, of 89, stands for the share of the time in which the
    cluster was busy, and the first batch has no rates."""
    events = table(spark, sf_dir, "events").select("event_type", "ts", "value")
    hour = F.timestamp_diff("HOUR", F.lit("2024-01-01").cast("timestamp_ntz"), F.col("ts"))
    batch = F.floor(hour / 6)
    counted = events.groupBy(F.col("event_type").alias("query_id"), batch.alias("batch_id")).agg(
        F.count("*").alias("n_in"), F.avg("value").alias("busy")
    )
    in_rate = F.when(F.col("batch_id") > 0, F.col("n_in") / 21_600.0)
    return counted.select(
        "query_id",
        "batch_id",
        "n_in",
        in_rate.alias("in_rate"),
        (in_rate * 89.0 / F.col("busy")).alias("out_rate"),
    )


_LOAD_LOG_SQL = """
    log AS (
        SELECT event_type AS query_id,
               CAST(floor(epoch(ts) - epoch(TIMESTAMP '2024-01-01')) AS BIGINT) // 21600
                   AS batch_id,
               count(*) AS n_in, avg(value) AS busy
        FROM events GROUP BY ALL),
    ratios AS (
        SELECT query_id, batch_id,
               CASE WHEN batch_id > 0 THEN busy / 89e0 END AS ratio
        FROM log),
    loads AS (
        SELECT *, avg(ratio) OVER w AS ratio_mean, count(ratio) OVER w AS ratio_count
        FROM ratios
        WINDOW w AS (PARTITION BY query_id ORDER BY batch_id RANGE BETWEEN 4 PRECEDING AND CURRENT ROW))"""


def recent_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean load of five batches, over a log cut into short chunks."""
    log = load_log(spark, sf_dir).withColumn("ratio", F.col("in_rate") / F.col("out_rate"))
    means = recent(log, 5, "ratio", chunk=16)
    return means.select(
        "query_id", "batch_id", F.round("ratio_mean", 6).alias("ratio_mean"), "ratio_count"
    )


QUERIES["recent_load"] = recent_load
ORACLES["recent_load"] = f"""
WITH {_LOAD_LOG_SQL}
SELECT query_id, batch_id, round(ratio_mean, 6) AS ratio_mean, ratio_count FROM loads"""


def scaling_signal_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: grow, shrink or hold after every batch."""
    found = scaling_signal(load_log(spark, sf_dir), n=5, hi=0.58, lo=0.52)
    return found.select("query_id", "batch_id", F.round("ratio", 6).alias("ratio"), "signal")


QUERIES["scaling_signal"] = scaling_signal_query
ORACLES["scaling_signal"] = f"""
WITH {_LOAD_LOG_SQL}
SELECT query_id, batch_id, round(ratio, 6) AS ratio,
       CASE WHEN ratio_count >= 5 AND ratio_mean > 0.58 THEN 'out'
            WHEN ratio_count >= 5 AND ratio_mean < 0.52 THEN 'in' ELSE 'hold' END AS signal
FROM loads"""
