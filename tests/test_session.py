"""Settings: what the user has set stays, and the shuffle is as wide as the inputs ask."""

import pytest

from tollgate.session import shuffle_width, spread, tune


@pytest.fixture
def fresh(spark):
    """A session of its own, as if nothing were set."""
    session = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions", "tollgate.shuffle.width"):
        session.conf.unset(key)
    return session


def test_choices_of_the_user_stay(fresh):
    wanted = {"spark.sql.session.timeZone": "Asia/Tokyo", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "200"}
    for key, value in wanted.items():
        fresh.conf.set(key, value)
    tune(fresh, "/root/testdata/sf0.01/lineitem.parquet")
    assert {key: fresh.conf.get(key) for key in wanted} == wanted


def test_the_shuffle_is_as_wide_as_the_inputs_have_pieces(fresh, path):
    fresh.range(200_000).write.parquet(path("t"))
    if "spark.sql.shuffle.partitions" in fresh.conf.getAll:
        pytest.skip("set for the whole application")
    cores = fresh.sparkContext.defaultParallelism
    assert shuffle_width(tune(fresh)) == cores and fresh.conf.get("spark.sql.session.timeZone") == "UTC"
    fresh.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "10k")
    wide = shuffle_width(tune(fresh, path("t"), path("none")))
    assert wide > cores and shuffle_width(tune(fresh)) == wide


def test_a_table_of_few_files_is_dealt_out(spark, path):
    cores = spark.sparkContext.defaultParallelism
    spark.range(1000).coalesce(1).write.parquet(path("one"))
    spark.range(1000).repartition(cores).write.parquet(path("many"))
    dealt = spread(spark.read.parquet(path("one")))
    assert dealt.count() == 1000 and "Exchange" in dealt._jdf.queryExecution().executedPlan().toString()
    kept = spark.read.parquet(path("many"))
    assert spread(kept) is kept
