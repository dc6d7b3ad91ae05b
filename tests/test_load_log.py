"""The load log of streams that work and of streams that idle."""

import os
from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tollgate.operators.scaling import numbered, scaling_signal
from tollgate.queries import serving
from tollgate.sources import logs
from tollgate.sources.logs import STREAM_METRICS, compact_load, log_load, read_load
from tollgate.streaming.telemetry import LoadLog

START = datetime(2024, 1, 1, 23, 59, 0)


def row(batch, at, idle=False, load=0.5, query="q"):
    times = dict.fromkeys(("trigger_ms", "add_batch_ms"))
    rates = {"in_rate": 0.0, "out_rate": None} if idle else {"in_rate": load * 100, "out_rate": 100.0}
    return {"query_id": query, "batch_id": batch, "ts": START + timedelta(seconds=at), "n_in": 0 if idle else 5,
            "n_late": 0, "idle": idle, **rates, **times}


def frame(spark, rows):
    return spark.createDataFrame(rows, STREAM_METRICS)


def signals(spark, rows):
    return [r.signal for r in scaling_signal(frame(spark, rows)).orderBy("seq").collect()]


def test_a_stream_that_falls_idle_shrinks_and_grows_again(spark):
    rows = [row(i, i, load=0.9) for i in range(6)] + [row(5, 6 + i, idle=True) for i in range(8)]
    rows += [row(6 + i, 14 + i, load=0.95) for i in range(6)]
    found = signals(spark, rows)
    assert found[4:6] == ["out", "out"] and found[13] == "in" and found[-1] == "out"


def test_idle_from_the_start(spark):
    assert signals(spark, [row(-1, i, idle=True) for i in range(6)]) == ["hold"] * 4 + ["in"] * 2


def test_an_idle_trigger_logged_twice_counts_once(spark):
    rows = [row(0, 0, load=0.1), *[row(0, 1, idle=True)] * 4, *[row(1, 2, load=0.1)] * 3]
    assert signals(spark, rows) == ["hold"] * 3


def test_numbers_follow_time_over_days_and_queries(spark):
    rows = [row(i // 3, 20 * i, idle=i % 3 > 0, query=q) for i in range(9) for q in ("a", "b")]
    found = numbered(frame(spark, rows)).orderBy("query_id", "ts").collect()
    assert [r.seq for r in found] == list(range(1, 10)) * 2
    assert len({r.ts.date() for r in found}) == 2


def files(path):
    found = Counter()
    for folder, _, names in os.walk(path):
        found[os.path.basename(folder)] += sum(n.endswith(".parquet") for n in names)
    return {day: n for day, n in found.items() if n}


def test_days_are_compacted_and_no_row_is_lost(spark, path):
    rows = [row(i, 20 * i) for i in range(9)]
    for r in rows:
        again = row(r["batch_id"], 20 * r["batch_id"] + 1, idle=True)
        log_load(spark, [r, again], path("log"), f"w{r['batch_id'] % 2}")
    before = sorted(map(str, read_load(spark, path("log")).collect()))
    assert files(path("log")) == {"log_date=2024-01-01": 3, "log_date=2024-01-02": 6}
    assert compact_load(spark, path("log"), date(2024, 1, 2)) == [date(2024, 1, 1)]
    assert files(path("log")) == {"log_date=2024-01-01": 1, "log_date=2024-01-02": 6}
    assert sorted(map(str, read_load(spark, path("log")).collect())) == before and len(before) == 18
    assert read_load(spark, path("log"), since=date(2024, 1, 2)).count() == 12
    assert compact_load(spark, path("log"), date(2024, 1, 2)) == []
    assert compact_load(spark, path("none"), date(2024, 1, 2)) == []


def test_a_crash_before_the_old_files_go_leaves_each_row_once(spark, path, monkeypatch):
    for i in range(3):
        log_load(spark, [row(i, i)], path("log"), "w")

    def crash(*_):
        raise OSError("lost")

    monkeypatch.setattr(logs, "remove", crash)
    with pytest.raises(OSError):
        compact_load(spark, path("log"), date(2024, 1, 2))
    monkeypatch.undo()
    assert files(path("log")) == {"log_date=2024-01-01": 4} and read_load(spark, path("log")).count() == 3
    compact_load(spark, path("log"), date(2024, 1, 2))
    assert files(path("log")) == {"log_date=2024-01-01": 1} and read_load(spark, path("log")).count() == 3


def test_writers_at_once_lose_nothing(spark, path):
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda i: log_load(spark, [row(i, i)], path("log"), f"w{i}"), range(12)))
    assert read_load(spark, path("log")).count() == 12


def test_a_real_stream_left_idle_asks_for_less(spark, path):
    spark.range(10).write.parquet(path("in"))
    asked = spark.conf.get("spark.sql.streaming.noDataProgressEventInterval")
    spark.conf.set("spark.sql.streaming.noDataProgressEventInterval", "100")
    log = LoadLog(spark, path("log"), name="left_idle", flush_seconds=2.0)
    spark.streams.addListener(log)
    try:
        stream = spark.readStream.schema("id long").parquet(path("in")).writeStream.queryName("left_idle")
        query = stream.format("noop").option("checkpointLocation", path("check")).trigger(processingTime="50 milliseconds").start()
    finally:
        spark.conf.set("spark.sql.streaming.noDataProgressEventInterval", asked)
    query.processAllAvailable()
    log.wait(lambda: log.idle_triggers >= 7, 60)
    query.stop()
    log.wait(lambda: log.closed, 60)
    found = scaling_signal(read_load(spark, path("log"))).orderBy(F.desc("seq")).first()
    assert found.signal == "in" and found.idle and found.batch_id == 0
    assert read_load(spark, path("log")).agg(F.sum("n_in")).first()[0] == 10
    assert max(files(path("log")).values()) <= 4


@pytest.mark.parametrize("absent", [None, 1])
def test_a_batch_of_the_logged_run_is_a_group_in_many_files(spark, path, monkeypatch, absent):
    key = F.when(F.col("id") % 50 > 0, F.col("id"))  # some have none, and are in no group
    items = spark.range(600).select(
        key.alias("l_orderkey"), F.lit(1).alias("l_linenumber"), (F.col("id") % 7).cast("double").alias("l_quantity"),
        F.lit(0.1).alias("l_discount"), F.lit(0.02).alias("l_tax"), F.lit("O").alias("l_linestatus"),
        F.when(F.col("id") % 5 == 0, "R").otherwise("N").alias("l_returnflag"),
    )
    if absent is not None:
        items = items.filter(F.col("id") % 3 != absent)
    items.coalesce(1).write.parquet(path("lineitem.parquet"))
    monkeypatch.setattr(serving, "scratch", lambda _, name: path(name))
    found = serving.stream_load_log(spark, path("")).orderBy("batch_id").collect()
    counts = [0 if g == absent else sum(i % 50 > 0 for i in range(g, 600, 3)) for g in range(3)]
    assert [(r.batch_id, r.n_in, r.n_late) for r in found] == [(g, n, 0) for g, n in enumerate(counts)]
    assert [r.measured for r in found] == [n > 0 for n in counts] and all(r.in_time and r.complete for r in found)
    sent = spark.read.parquet(path("messages")).groupBy((F.col("key").cast("string").cast("long") % 3).alias("g"))
    files_of = {r.g: r.n for r in sent.agg(F.count_distinct("_metadata.file_path").alias("n")).collect()}
    assert files_of.keys() == {g for g, n in enumerate(counts) if n} and min(files_of.values()) > 1
    assert spark.read.parquet(path("stream-out")).count() == sum(counts)
