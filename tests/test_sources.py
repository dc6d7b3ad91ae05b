import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tollgate.queries import preparation
from tollgate.sources import (
    anti_manifest,
    load_new,
    log_run,
    new_files,
    read_kafka,
    read_log,
    read_raw,
    scan_text,
    write_clean,
)
from tollgate.sources.logs import RUNS
from tollgate.spec import DatasetSpec, schema_of

SPEC = DatasetSpec(
    name="events",
    schema=schema_of(event_id="long", ts="timestamp_ntz", user_id="long", value="double"),
    key=("event_id",),
    required=("event_id",),
)
GOOD = [f"{i},2024-01-01 00:00:00,3,4.5" for i in range(20)]
BAD = [
    "1,notatime,3,4.0",
    "1,2024-01-01 00:00:00,x,4.0",
    "too,few",
    "1,2024-01-01 00:00:00,1,-4.0,extra",
]


def drop(spark, lines, path):
    spark.createDataFrame([(x,) for x in lines], "value string").write.mode("append").text(path)


def test_bad_lines_are_kept_aside_whatever_is_selected(spark, path):
    drop(spark, GOOD + BAD, path("raw"))
    df = read_raw(spark, path("raw"), SPEC)
    assert df.filter("_corrupt IS NULL").count() == 20
    assert sorted(r[0] for r in df.select("_corrupt").dropna().collect()) == sorted(BAD)
    assert df.select("event_id", "_corrupt").filter("_corrupt IS NOT NULL").count() == 4
    assert df.filter("_corrupt IS NOT NULL").select("value").count() == 4


def test_lines_come_back_as_they_stand_in_the_file(spark, path):
    spec = DatasetSpec(
        name="q", schema=schema_of(id="long", at="timestamp_ntz", x="double", note="string"), key=("id",),
        delimiter=";", header=True,
    )
    bad = ['2;notatime;1.0;"a;b"', '3;2024-01-01 00:00:00;"1,5";', "4;", ' 5 ;x;1;"q""q"', "6;2024-01-01 00:00:00;1.0;a;b"]
    drop(spark, ["id;at;x;note", '1;2024-01-01 00:00:00;1.0;"a;b"', *bad, "", "  "], path("raw"))
    drop(spark, ["id;at;x;note", "7;2024-01-01 00:00:00;2.0;"], path("raw"))
    rows = read_raw(spark, path("raw"), spec).collect()
    assert sorted(r._corrupt for r in rows if r._corrupt is not None) == sorted(bad)
    assert sorted((r.id, r.x, r.note) for r in rows if r._corrupt is None) == [(1, 1.0, "a;b"), (7, 2.0, None)]


def test_rerun_loads_nothing_and_a_new_file_only_its_rows(spark, path):
    drop(spark, GOOD + BAD, path("raw"))
    places = path("raw"), SPEC, path("checkpoint"), path("out")

    def loaded():
        load_new(spark, *places)
        counts = spark.read.parquet(path("out")).groupBy("_status").count().orderBy("_status")
        return [r["count"] for r in counts.collect()]

    assert loaded() == [20, 4]
    assert loaded() == [20, 4]
    drop(spark, GOOD[:7], path("raw"))
    assert loaded() == [27, 4]


@pytest.mark.parametrize("limit", [None, 0])
def test_manifest(spark, path, limit):
    drop(spark, GOOD, path("raw"))
    manifest = spark.read.text(path("raw")).select("_metadata.file_path").distinct()
    manifest.write.parquet(path("manifest"))
    manifest = spark.read.parquet(path("manifest"))
    drop(spark, GOOD[:5], path("raw"))
    fresh = anti_manifest(scan_text(spark, path("raw"), SPEC), manifest, limit)
    assert fresh.count() == 5
    files = new_files(spark, path("raw"), manifest)
    assert files and scan_text(spark, files, SPEC).count() == 5


def test_only_written_partitions_are_replaced(spark, path):
    df = spark.range(10).withColumn("part", F.col("id") % 2)
    write_clean(df, path("t"), ["part"])
    write_clean(df.filter("part = 1").limit(1), path("t"), ["part"])
    assert spark.read.parquet(path("t")).count() == 6


def test_run_log_appends(spark, path):
    assert read_log(spark, path("runs"), RUNS).count() == 0
    for i in range(2):
        run = {
            "run_id": str(i), "model_name": "m", "train_from": None, "train_to": None,
            "params": {"smoothing": 1.0}, "metrics": {"auc": 0.5, "f1": None}, "model_uri": "u",
        }
        log_run(spark, run, path("runs"))
    rows = read_log(spark, path("runs"), RUNS).orderBy("run_id").collect()
    assert [r.run_id for r in rows] == ["0", "1"]
    assert rows[0].params == {"smoothing": "1.0"} and rows[0].metrics == {"auc": 0.5, "f1": None}


def test_kafka_needs_its_connector(spark):
    """There is no broker here; only the options' way to the connector is checked."""
    options = {"kafka.bootstrap.servers": "localhost:1", "subscribe": "in"}
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        read_kafka(spark, options)


PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def store_orders(spark, path, kept="true"):
    """600 orders, a tenth of them spoilt by their queries."""
    priority = F.element_at(F.array(*map(F.lit, PRIORITIES)), (F.col("id") % 5 + 1).cast("int"))
    orders = spark.range(600).filter(kept).select(
        F.col("id").alias("o_orderkey"), F.lit(1).cast("long").alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
        F.when(F.col("id") % 20 < 2, 5_000.0).otherwise(20_000.0).alias("o_totalprice"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("o_orderdate"), priority.alias("o_orderpriority"),
    )
    orders.coalesce(1).write.parquet(path("orders.parquet"))


def files_of(spark, path, group):
    lines = spark.read.text(path).filter("value <> '' and value not like 'o_orderkey%'")
    counted = lines.groupBy(group.alias("g")).agg(F.count_distinct("_metadata.file_path").alias("n"))
    return {r.g: r.n for r in counted.collect()}


@pytest.mark.parametrize("kept", ["true", "id % 3 <> 1"])
def test_a_batch_of_the_streamed_report_is_a_group_in_many_files(spark, path, monkeypatch, kept):
    store_orders(spark, path, kept)
    monkeypatch.setattr(preparation, "scratch", lambda _, name: path(name))
    found = {r.rule: r.n for r in preparation.clean_report_stream(spark, path("")).collect()}
    left = [i for i in range(600) if kept == "true" or i % 3 != 1]
    spoilt = sum(i % 20 < 2 for i in left)
    assert (found["rows_in"], found["rows_rejected"], found["rows_kept"]) == (len(left), spoilt, len(left) - spoilt)
    files = files_of(spark, path("orders-raw"), F.substring_index("value", "|", 1).cast("long") % 3)
    assert files.keys() == {i % 3 for i in left} and min(files.values()) > 1
    assert spark.read.parquet(path("orders-clean")).count() == len(left)


def test_lines_with_headers_are_written_to_many_files(spark, path, monkeypatch):
    store_orders(spark, path)
    monkeypatch.setattr(preparation, "scratch", lambda _, name: path(name))
    found = preparation.raw_scan_lines(spark, path("")).collect()
    lines = {r.line for r in found if r.line is not None}
    assert len(found) == 600 and sum(r.o_orderkey is None for r in found) == sum(i % 20 == 1 for i in range(600))
    assert '0|1|O|5000.0|notatime|"1-URGENT|"' in lines and '"1|1|O|5000.0|2024-01-01 00:00:00|"2-HIGH|"' in lines
    assert not any("o_orderkey" in line for line in lines) and len(lines) == sum(i % 20 < 2 for i in range(600))
    key = F.regexp_extract("value", "[0-9]+", 0).cast("long")
    assert min(files_of(spark, path("orders-text"), key % 2).values()) > 1
    whole = spark.read.text(path("orders-text"), wholetext=True).filter("value <> ''").collect()
    assert all(r.value.startswith("o_orderkey|") and r.value.count("o_orderkey") == 1 for r in whole)
