import math

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from tollgate.operators.metrics import ScoreCuts, auc, metrics, score_cuts

SCHEMA = "model string, label int, p double"


def value(spark, pairs, **kw):
    df = spark.createDataFrame([("m", y, p) for y, p in pairs], SCHEMA)
    return auc(df, ["model"], **kw).first().auc


def test_hand_cases(spark):
    assert value(spark, [(0, 0.5), (1, 0.5), (0, 0.5)]) == 0.5
    assert value(spark, [(0, 0.1), (0, 0.2), (1, 0.3), (1, 0.9)]) == 1.0
    assert value(spark, [(1, 0.1), (1, 0.2), (0, 0.3), (0, 0.9)]) == 0.0
    assert value(spark, [(1, 0.1), (1, 0.2)]) is None
    assert value(spark, [(0, 0.1)]) is None


@pytest.fixture(scope="module")
def scored(spark):
    """A third of the rows share one score."""
    p = F.when(F.col("id") % 3 == 0, 0.25).otherwise(F.round(F.rand(3), 3))
    df = spark.range(5_000).select("id", F.lit("m").alias("model"), p.alias("p"))
    return df.withColumn("label", (F.rand(5) < 0.1 + 0.5 * F.col("p")).cast("int")).persist()


def test_equals_the_unbinned_evaluator(scored):
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="p", labelCol="label", numBins=0)
    assert auc(scored, ["model"]).first().auc == pytest.approx(evaluator.evaluate(scored), abs=1e-12)


def test_cuts_do_not_matter(scored):
    want = auc(scored, ["model"]).first().auc
    for splits in [(-math.inf, math.inf), (-math.inf, 0.25, 0.5, math.inf), (-math.inf, 0.9, math.inf)]:
        assert auc(scored, ["model"], cuts=ScoreCuts(splits, {})).first().auc == want


def test_unchanged_by_a_rising_map(scored):
    mapped = scored.withColumn("p", F.exp(F.col("p") * 5) - 3)
    assert auc(mapped, ["model"]).first().auc == auc(scored, ["model"]).first().auc


def test_frequent_score_gets_a_range_of_its_own(scored):
    cuts = score_cuts(scored, "p")
    (at, share), = ((i, s) for i, s in cuts.tied.items() if cuts.splits[i] == 0.25)
    assert cuts.splits[at + 1] == math.nextafter(0.25, 1)
    assert share == pytest.approx(1 / 3, abs=0.05)


def test_weights_count_as_copies(spark, scored):
    weighted = scored.withColumn("w", F.col("id") % 4)
    copied = weighted.withColumn("x", F.explode(F.array_repeat(F.lit(1), F.col("w").cast("int"))))
    assert auc(weighted, ["model"], weight="w").first().auc == auc(copied, ["model"]).first().auc


def test_metrics(spark):
    rows = [(1, 0.9), (1, 0.5), (1, 0.7), (0, 0.8), (0, 0.1), (0, 0.2), (0, 0.3)]
    df = spark.createDataFrame([("m", y, p) for y, p in rows], SCHEMA)
    m = metrics(df).first()
    assert (m.n, m.tp, m.fp, m.fn, m.tn) == (7, 2, 1, 1, 3)
    assert m.precision == m.recall == m.f1 == pytest.approx(2 / 3)
    assert m.auc == pytest.approx(10 / 12)


def test_metrics_without_positives(spark):
    m = metrics(spark.createDataFrame([("m", 0, 0.1)], SCHEMA)).first()
    assert m.precision is None and m.recall is None and m.f1 is None and m.auc is None
