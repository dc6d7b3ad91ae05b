import time

import pytest
from pyspark.sql import functions as F

from tollgate.operators.clean import dedup_stream
from tollgate.operators.train import fit, score
from tollgate.sources.logs import read_load
from tollgate.spec import DatasetSpec, schema_of
from tollgate.streaming.messages import MESSAGES, decode, encode
from tollgate.streaming.scoring import route_messages, score_messages
from tollgate.streaming.telemetry import LoadLog, performance, volume

SPEC = DatasetSpec(
    name="payments",
    schema=schema_of(id="long", amount="double", kind="string"),
    key=("id",),
    label="fraud",
    numeric=("amount",),
    categorical=("kind",),
)


def as_messages(values):
    nothing = {"topic": "in", "partition": 0, "offset": 0, "timestampType": 0}
    kinds = {"topic": "string", "partition": "int", "offset": "long", "timestampType": "int"}
    return values.select(
        F.lit(None).cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        *[F.lit(v).cast(kinds[c]).alias(c) for c, v in nothing.items()],
        F.lit(None).cast("timestamp").alias("timestamp"),
    ).select("key", "value", "topic", "partition", "offset", "timestamp", "timestampType")


def run(df, path, name):
    query = (
        df.writeStream.format("parquet").option("path", path(name))
        .option("checkpointLocation", path(name + "-checkpoint"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query, df.sparkSession.read.schema(df.schema).parquet(path(name))


def test_bad_messages_are_set_aside(spark):
    values = ['{"id": 1, "amount": 2.5, "kind": "card"}', '{"id": 2}', '{"id": "x"}', "no", "", None]
    df = spark.createDataFrame([(v,) for v in values], "value string")
    ok, bad = decode(as_messages(df), SPEC.schema)
    assert sorted(map(tuple, ok.collect())) == [(1, 2.5, "card"), (2, None, None)]
    assert sorted(r.payload or "-" for r in bad.collect()) == ["", "-", "no", '{"id": "x"}'] or {
        r.payload for r in bad.collect()
    } == {"", None, "no", '{"id": "x"}'}


def test_encode_round_trip(spark):
    df = spark.createDataFrame([(1, 2.5, "card")], "id long, amount double, kind string")
    message = encode(df, ["id", "kind"]).first()
    assert message.key == "1#card"
    ok, _ = decode(as_messages(spark.createDataFrame([(message.value,)], "value string")), SPEC.schema)
    assert ok.collect() == df.collect()


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(500).withColumn("amount", F.round(F.rand(1) * 100, 2))
    df = df.withColumn("kind", F.when(F.col("id") % 3 == 0, "cash").otherwise("card"))
    return df.withColumn("fraud", (F.rand(2) * 100 < F.col("amount")).cast("int")).persist()


def test_stream_scores_equal_batch_scores(spark, rows, path):
    model = fit(rows, SPEC, {"family": "bayes"})
    raw = rows.select("id", "amount", "kind")
    messages = as_messages(encode(raw, ["id"]))
    messages.repartition(4).write.parquet(path("in"))
    stream = spark.readStream.schema(MESSAGES).option("maxFilesPerTrigger", 1).parquet(path("in"))
    log = LoadLog(spark, path("load"), flush_every=3)
    spark.streams.addListener(log)
    query, out = run(score_messages(stream, SPEC, model), path, "out")
    got = {r.key: r.p for r in out.select("key", F.from_json("value", "p double")["p"].alias("p")).collect()}
    assert got == {str(r.id): r.p for r in score(raw, model).collect()}

    assert sum(r.n_in for r in volume(spark, query.recentProgress).collect()) == 500
    assert performance(spark, query.recentProgress).filter("trigger_ms > 0").count() == 4
    for _ in range(100):
        logged = read_load(spark, path("load"))
        if logged.agg(F.sum("n_in")).first()[0] == 500:
            break
        time.sleep(0.2)
    spark.streams.removeListener(log)
    assert logged.agg(F.sum("n_in")).first()[0] == 500
    assert logged.filter("query_id = '%s'" % query.id).count() >= 4


def test_routing_keeps_every_message(spark, rows, path):
    model = fit(rows, SPEC, {"family": "bayes"})
    good = encode(rows.select("id", "amount", "kind"), ["id"]).select("value")
    bad = spark.createDataFrame([("{",), ("text",), ('{"id": 1, "amount": "x"}',),
         ('{"id": 7, "kind": "card"}',), ('{"id": 8, "amount": null}',), ("[]",)], "value string")
    as_messages(good.union(bad)).write.parquet(path("in"))
    stream = spark.readStream.schema(MESSAGES).parquet(path("in"))
    _, out = run(route_messages(stream, SPEC, model, "scores", "bad"), path, "out")
    counts = {r.topic: r["count"] for r in out.groupBy("topic").count().collect()}
    assert counts == {"scores": 500, "bad": 6}
    assert {r.value for r in out.filter("topic = 'bad'").collect()} == {r.value for r in bad.collect()}
    why = out.filter("topic = 'bad'").select(F.col("headers")[0]["value"].cast("string")).collect()
    assert sorted(r[0] for r in why) == ["number:amount"] * 2 + ["unreadable"] * 4


def test_repeats_are_dropped_once_across_files(spark, path):
    events = spark.range(200).withColumn("ts", F.timestamp_seconds(F.col("id") * 60 + 1_700_000_000))
    events.write.parquet(path("in"))
    events.filter("id > 150").write.mode("append").parquet(path("in"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path("in"))
    _, out = run(dedup_stream(stream, ["id"], "ts", "2 days"), path, "out")
    assert out.count() == out.select("id").distinct().count() == 200
