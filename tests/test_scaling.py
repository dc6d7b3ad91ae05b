import pytest
from pyspark.sql import functions as F

from tollgate.operators.scaling import recent, scaling_signal

LOG = "query_id string, batch_id long, in_rate double, out_rate double"


def signals(spark, loads):
    rows = [("q", i, None if x is None else x * 100, 100.0) for i, x in enumerate(loads)]
    found = scaling_signal(spark.createDataFrame(rows, LOG)).orderBy("batch_id").collect()
    return [r.signal for r in found]


def test_high_load_asks_for_more(spark):
    assert signals(spark, [None] + [0.9] * 6) == ["hold"] * 5 + ["out"] * 2


def test_one_high_batch_holds(spark):
    assert signals(spark, [0.5] * 4 + [1.5] + [0.5] * 4) == ["hold"] * 9


def test_low_load_asks_for_less(spark):
    assert signals(spark, [0.1] * 6)[-1] == "in"


def test_unmeasured_batches_are_ignored(spark):
    assert signals(spark, [0.9, None, 0.9, None, 0.9, 0.9])[-1] == "hold"


def test_an_idle_cluster_shrinks(spark):
    assert signals(spark, [None] + [0.0] * 6) == ["hold"] * 5 + ["in"] * 2


def test_repeated_rows_count_once(spark):
    rows = [("q", i, 90.0, 100.0) for i in (0, 0, 0, 1, 1)]
    assert {r.signal for r in scaling_signal(spark.createDataFrame(rows, LOG)).collect()} == {"hold"}


def test_no_output_is_no_ratio(spark):
    df = spark.createDataFrame([("q", 0, 5.0, 0.0)], LOG)
    assert scaling_signal(df).first().ratio is None


@pytest.mark.parametrize("chunk", [4, 7, 50])
def test_chunks_do_not_matter(spark, chunk):
    df = spark.range(90).select(
        (F.col("id") % 2).cast("string").alias("query_id"),
        F.floor(F.col("id") / 2).alias("batch_id"),
        F.sqrt("id").alias("x"),
    ).filter("batch_id % 11 <> 3")

    def run(size):
        return sorted(map(tuple, recent(df, 4, "x", chunk=size).collect()))

    assert run(chunk) == run(1_000)
