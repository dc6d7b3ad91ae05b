import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tollgate.functions import two_sided_p
from tollgate.functions.hashing import POISSON_ONE_CDF
from tollgate.operators.registry import champion, read_registry, register
from tollgate.operators.validate import (
    bootstrap,
    bootstrap_metric,
    common_replicates,
    distribution,
    promote,
    replicate_metric,
    t_test,
)
from tollgate.plans.validate import registry_row

# Two-sided p for df and t.
FIXED = [
    (2, 1.5, 0.272393124891),
    (10, 2.2, 0.052441068449),
    (198, 2.5, 0.013231389059),
    (198, 0.4, 0.689587713186),
    (198, 0.0, 1.0),
    (198, 10.19251345770692, 7.01237051506e-20),
    (1998, 3.1, 0.001962199411),
]


def p_values(spark, pairs):
    df = spark.createDataFrame([(i, n, t) for i, (n, t) in enumerate(pairs)], "i int, n long, t double")
    return [r.p for r in df.orderBy("i").select(two_sided_p(F.col("t"), F.col("n")).alias("p")).collect()]


def test_fixed_p_values(spark):
    got = p_values(spark, [(n, t) for n, t, _ in FIXED])
    assert got == pytest.approx([p for _, _, p in FIXED], rel=1e-9)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 300), st.floats(0, 40)), min_size=1, max_size=20))
def test_p_is_a_probability_and_symmetric(spark, cases):
    pairs = [(2 * h, t) for h, t in cases]
    both = p_values(spark, pairs + [(n, -t) for n, t in pairs])
    assert all(0 <= p <= 1 for p in both)
    assert both[: len(pairs)] == both[len(pairs) :]


def test_no_p_without_t_or_for_odd_df(spark):
    assert p_values(spark, [(198, None), (197, 1.0), (0, 1.0)]) == [None, None, None]


def weight(model, key, b):
    digest = hashlib.md5(f"{model}#{key}#{b // 4}".encode()).hexdigest()
    word = int(digest[8 * (b % 4) : 8 * (b % 4) + 8], 16)
    return sum(word >= bound for bound in POISSON_ONE_CDF)


@pytest.fixture(scope="module")
def scored(spark):
    rows = [
        (m, k, int(k % 5 == 0), 0.25 if k % 3 == 0 else ((k * 37 + len(m)) % 101) / 101)
        for m in ("new", "prev")
        for k in range(300)
    ]
    return spark.createDataFrame(rows, "model string, k int, label int, p double").persist()


def brute_force(rows, b):
    drawn = [(r.label, r.p, weight(r.model, r.k, b)) for r in rows]
    pos = [(p, w) for y, p, w in drawn if y and w]
    neg = [(p, w) for y, p, w in drawn if not y and w]
    pairs = sum(v * w * ((p > q) + 0.5 * (p == q)) for p, v in pos for q, w in neg)
    return pairs / (sum(v for _, v in pos) * sum(w for _, w in neg))


def test_bootstrap_against_brute_force(scored):
    got = {(r.model, r.b): r.metric for r in replicate_metric(bootstrap(scored, ["k"], 6)).collect()}
    assert len(got) == 12
    rows = scored.collect()
    for (model, b), metric in got.items():
        want = brute_force([r for r in rows if r.model == model], b)
        assert metric == pytest.approx(want, abs=1e-12)


@pytest.mark.parametrize("n_rep", [1, 20, 23])
def test_metric_without_the_sample_is_the_same(spark, scored, n_rep):
    odd = spark.createDataFrame([("new", 900, 1, None), ("prev", 901, 0, float("nan"))], scored.schema)
    want = {(r.model, r.b): r.metric for r in replicate_metric(bootstrap(scored, ["k"], n_rep)).collect()}
    for df in (scored, scored.union(odd).repartition(5, "p")):
        got = {(r.model, r.b): r.metric for r in bootstrap_metric(df, ["k"], n_rep).collect()}
        assert got == pytest.approx(want, abs=1e-12) and len(got) == 2 * n_rep


def test_replicates_of_one_class_have_no_metric(spark):
    few = spark.createDataFrame([("m", k, int(k == 0), 0.1 * k) for k in range(3)], "model string, k int, label int, p double")
    got = {r.b: r.metric for r in bootstrap_metric(few, ["k"], 40).collect()}
    want = {r.b: r.metric for r in replicate_metric(bootstrap(few, ["k"], 40)).collect()}
    assert got == want and None in got.values() and len(set(got.values())) > 1


def test_bootstrap_is_the_same_however_rows_are_spread(scored):
    def run(df):
        return sorted(map(tuple, replicate_metric(bootstrap(df, ["k"], 5)).collect()))

    assert run(scored) == run(scored.repartition(3, "p"))


def test_weights_average_one(scored):
    boot = bootstrap(scored, ["k"], 100)
    assert boot.agg(F.sum("w")).first()[0] / (600 * 100) == pytest.approx(1, abs=0.02)


def test_one_class_replicates_leave_for_all_models(spark):
    rows = [("a", 0, 0.5), ("a", 1, None), ("b", 0, 0.7), ("b", 1, 0.6)]
    df = spark.createDataFrame(rows, "model string, b int, metric double")
    assert {r.b for r in common_replicates(df).collect()} == {0}


DIST = "model string, n long, mean double, var double, q025 double, q500 double, q975 double"


def dist(spark, model, mean, var=0.01, n=100):
    return spark.createDataFrame([(model, n, mean, var, mean, mean, mean)], DIST)


def test_gate(spark):
    def passes(new, prev):
        return promote(t_test(dist(spark, "n", new), dist(spark, "p", prev))).count() == 1

    assert passes(0.9, 0.8)
    assert not passes(0.8, 0.9)
    assert not passes(0.801, 0.8)


def test_no_variance_decides_by_the_means(spark):
    row = t_test(dist(spark, "n", 0.9, 0.0), dist(spark, "p", 0.8, 0.0)).first()
    assert row.t == float("inf") and row.p == 0 and row.df == 198
    row = t_test(dist(spark, "n", 0.8, 0.0), dist(spark, "p", 0.8, 0.0)).first()
    assert row.t is None and row.p is None
    assert promote(t_test(dist(spark, "n", 1.0, 0.0), dist(spark, "p", 0.5, 0.0))).count() == 1
    assert promote(t_test(dist(spark, "n", 0.5, 0.0), dist(spark, "p", 1.0, 0.0))).count() == 0


def test_distribution(spark):
    df = spark.createDataFrame([("m", float(i)) for i in range(1, 5)], "model string, metric double")
    row = distribution(df).first()
    assert (row.n, row.mean, row.q500) == (4, 2.5, 2.5)
    assert row["var"] == pytest.approx(5 / 3)


def test_registry(spark, path):
    first = dist(spark, "m", 0.8).selectExpr(
        "n AS n_new", "mean AS mean_new", "var AS var_new", "CAST(NULL AS DOUBLE) AS t",
        "CAST(NULL AS DOUBLE) AS p",
    )
    assert champion(read_registry(spark, path("r")), "a").first() is None
    register(spark, registry_row(first, "a", "one"), path("r"))
    register(spark, registry_row(first, "b", "other"), path("r"))
    better = promote(t_test(dist(spark, "n", 0.9), dist(spark, "p", 0.8)))
    register(spark, registry_row(better, "a", "two"), path("r"))
    worse = promote(t_test(dist(spark, "n", 0.7), dist(spark, "p", 0.8)))
    register(spark, registry_row(worse, "a", "three"), path("r"))
    last = champion(read_registry(spark, path("r")), "a").first()
    assert (last.version, last.prev_version, last.model_uri, last.n_rep) == (2, 1, "two", 100)
    assert read_registry(spark, path("r")).count() == 3
