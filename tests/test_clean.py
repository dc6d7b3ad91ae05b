from datetime import datetime

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tollgate.functions import in_domain, in_range
from tollgate.operators.clean import (
    cast_columns,
    clean,
    clean_report,
    dedup,
    null_policy,
    observe_clean,
    tag,
    tag_rejects,
)
from tollgate.spec import DatasetSpec, Rule, schema_of

SPEC = DatasetSpec(
    name="payments",
    schema=schema_of(id="long", at="timestamp_ntz", amount="double", kind="string"),
    key=("id",),
    event_time="at",
    required=("id", "amount"),
    fill={"kind": "card"},
    formats={"at": "dd.MM.yyyy HH:mm"},
    rules=(
        Rule("amount_range", lambda: in_range("amount", 0, 100)),
        Rule("kind_domain", lambda: in_domain("kind", ["card", "cash"])),
    ),
)
TEXT = "id string, at string, amount string, kind string"


def rules_of(spark, *row):
    df = spark.createDataFrame([row], TEXT)
    return tag(df, SPEC).first()["_rules"]


def test_each_rule(spark):
    at = "05.01.2024 10:30"
    assert rules_of(spark, "1", at, "5", "cash") == []
    assert rules_of(spark, "1", at, "5", None) == []
    assert rules_of(spark, "1", "2024-01-05", "5", "cash") == ["cast:at"]
    assert rules_of(spark, "x", at, "5", "cash") == ["cast:id"]
    assert rules_of(spark, None, at, "5", "cash") == ["null:id"]
    assert rules_of(spark, "1", at, "101", "cash") == ["amount_range"]
    assert rules_of(spark, "1", at, "NaN", "cash") == ["amount_range"]
    assert rules_of(spark, "1", None, "-1", "bond") == ["amount_range", "kind_domain"]


def test_cast_uses_the_declared_format(spark):
    df = spark.createDataFrame([("1", "05.01.2024 10:30", "5", "cash")], TEXT)
    row = cast_columns(df, SPEC).first()
    assert row.at == datetime(2024, 1, 5, 10, 30)
    assert row.id == 1 and row.amount == 5.0


def test_rejected_row_keeps_its_raw_fields(spark):
    df = spark.createDataFrame([("1", "soon", "5", "cash")], TEXT)
    _, rejected = clean(df, SPEC)
    assert '"at":"soon"' in rejected.first()["_raw"]


def test_open_ranges_reject_nan(spark):
    df = spark.createDataFrame([(float("nan"),), (5.0,), (-1.0,), (None,)], "v double")
    flags = df.select(in_range("v", 0.0).alias("lo"), in_range("v", hi=0.0).alias("hi")).collect()
    assert [r.lo for r in flags] == [False, True, False, None]
    assert [r.hi for r in flags] == [False, False, True, None]


def test_tag_rejects_passes_unknown_results(spark):
    df = spark.createDataFrame([(None,), (5,)], "v int")
    tagged = tag_rejects(df, [Rule("small", lambda: F.col("v") < 3)])
    assert [r["_rules"] for r in tagged.collect()] == [[], ["small"]]


def test_null_policy(spark):
    df = spark.createDataFrame([("1", None, "5", None), ("1", None, None, "cash")], TEXT)
    assert [tuple(r) for r in null_policy(df, SPEC).collect()] == [("1", None, "5", "card")]


def test_observed_counts_equal_the_report(spark, path):
    rows = [(str(i), None, str(i * 30), "cash") for i in range(10)]
    df = spark.createDataFrame(rows, TEXT)
    report = {r.rule: r.n for r in clean_report(tag(df, SPEC)).collect()}
    df.write.parquet(path("in"))
    stream = tag(spark.readStream.schema(df.schema).parquet(path("in")), SPEC)
    query = (
        observe_clean(stream, "clean", ["amount_range"])
        .writeStream.format("parquet").option("path", path("out"))
        .option("checkpointLocation", path("checkpoint")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert query.lastProgress.observedMetrics["clean"].asDict() == report


def test_dedup_keeps_the_first_in_order(spark):
    rows = [(1, 3, "a"), (1, 5, "b"), (2, 1, "c"), (1, 5, "a")]
    df = spark.createDataFrame(rows, "k int, load int, v string")
    kept = dedup(df, ["k"], [F.desc("load"), F.asc("v")])
    assert sorted(map(tuple, kept.collect())) == [(1, 5, "a"), (2, 1, "c")]


field = st.one_of(st.none(), st.sampled_from(["1", "50", "-3", "x", "NaN", "1e3", ""]))
row = st.tuples(field, st.sampled_from([None, "05.01.2024 10:30", "never"]), field,
                st.sampled_from([None, "card", "cash", "bond"]))


@settings(max_examples=8, deadline=None)
@given(st.lists(row, min_size=1, max_size=40))
def test_no_row_is_lost_and_cleaning_twice_changes_nothing(spark, rows):
    df = spark.createDataFrame(rows, TEXT)
    kept, rejected = clean(df, SPEC)
    once = sorted(map(repr, kept.collect()))
    assert len(once) + rejected.count() == len(rows)
    again, none = clean(kept, SPEC)
    assert sorted(map(repr, again.collect())) == once
    assert none.count() == 0
