"""Properties of physical plans that matter on a cluster."""

import re

import pytest
from pyspark.sql import functions as F

from tollgate.operators.clean import clean, clean_report, dedup, tag
from tollgate.operators.train import fit, score, search
from tollgate.operators.validate import bootstrap, bootstrap_metric, replicate_metric
from tollgate.queries.data import LINEITEM, LINEITEM_COLUMNS, ORDERS, table
from tollgate.queries.preparation import dirty_orders
from tollgate.queries.training import BAYES, returned_items

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return re.findall(r"Exchange (?!SinglePartition)(\w+\([^)]*\))", plan(df))


def test_cleaning_moves_no_rows(spark):
    kept, rejected = clean(dirty_orders(spark, SF_DIR), ORDERS)
    assert not exchanges(kept) and not exchanges(rejected)
    assert len(exchanges(clean_report(tag(dirty_orders(spark, SF_DIR), ORDERS)))) == 1


def test_dedup_limits_keys_before_the_shuffle(spark):
    items = table(spark, SF_DIR, "lineitem")
    text = plan(dedup(items, ["l_orderkey", "l_linenumber"], [F.desc("l_shipdate")]))
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Exchange") < text.rindex("WindowGroupLimit")


@pytest.mark.parametrize("tied", [False, True])
def test_bootstrap_shuffles_before_it_multiplies(spark, path, tied):
    p = F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.rand(1)) if tied else F.rand(1)
    rows = spark.range(3_000).select(
        F.lit("m").alias("model"), "id", p.alias("p"), (F.col("id") % 7 == 0).cast("int").alias("label")
    )
    rows.write.parquet(path("scored"))
    replicates = replicate_metric(bootstrap(spark.read.parquet(path("scored")), ["id"], 8))
    text = plan(replicates)
    first_shuffle = text.rindex("Exchange hashpartitioning(model")
    assert text.rindex("Generate explode") < first_shuffle, "rows are multiplied after it"
    # the rows once, then totals of ranges (and of salted parts)
    assert len(exchanges(replicates)) == (3 if tied else 2)


@pytest.mark.parametrize("tied", [False, True])
def test_metric_without_the_sample_shuffles_the_rows_once(spark, path, tied):
    p = F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.rand(1)) if tied else F.rand(1)
    rows = spark.range(3_000).select(
        F.lit("m").alias("model"), "id", p.alias("p"), (F.col("id") % 7 == 0).cast("int").alias("label")
    )
    rows.write.parquet(path("scored"))
    replicates = bootstrap_metric(spark.read.parquet(path("scored")), ["id"], 100)
    assert len(exchanges(replicates)) == (3 if tied else 2)
    # once multiplied, by the five blocks of replicates
    assert plan(replicates).count("Generate explode(") == 1


def test_search_of_bayes_runs_the_same_jobs_for_any_number_of_settings(spark):
    def jobs(smoothing):
        group = f"search-{len(smoothing)}"
        spark.sparkContext.setJobGroup(group, group)
        search(returned_items(spark, SF_DIR), LINEITEM, {"family": "bayes", "smoothing": smoothing})
        spark.sparkContext.setJobGroup("", "")
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert jobs([1.0]) >= jobs([0.5, 1.0, 2.0, 10.0, 100.0, 1e6]) - 1


def test_scoring_runs_no_python_and_reads_only_its_columns(spark):
    model = fit(returned_items(spark, SF_DIR), LINEITEM, BAYES)
    items = table(spark, SF_DIR, "lineitem").select(*LINEITEM_COLUMNS)
    text = plan(score(items, model).select("l_orderkey", "p"))
    assert "Python" not in text and "Exchange" not in text
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "l_extendedprice" not in schema and "l_returnflag" not in schema
