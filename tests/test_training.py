from dataclasses import replace
from datetime import date

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tollgate.operators.features import attach_labels, class_weights, folds, split
from tollgate.operators.train import best_run, fit, loaded_between, score, search
from tollgate.sources import load_model, save_model
from tollgate.spec import DatasetSpec, schema_of

SPEC = DatasetSpec(
    name="payments",
    schema=schema_of(id="long", amount="double", kind="string"),
    key=("id",),
    label="fraud",
    derived={"big": "CAST(amount > 50 AS DOUBLE)"},
    numeric=("amount", "big"),
    categorical=("kind",),
)


@pytest.fixture(scope="module")
def rows(spark):
    amount = F.round(F.rand(1) * 100, 2)
    kind = F.when(F.rand(2) < 0.3, "cash").otherwise("card")
    df = spark.range(2_000).select("id", amount.alias("amount"), kind.alias("kind"))
    risk = F.col("amount") / 200 + F.when(F.col("kind") == "cash", 0.3).otherwise(0.0)
    df = df.withColumn("fraud", (F.rand(3) < risk).cast("int")).persist()
    df.count()
    return df


def test_split_follows_the_key_only(rows):
    shares = {"train": 70, "valid": 20, "test": 10}
    parts = {r.id: r.part for r in split(rows, ["id"], shares).collect()}
    again = {r.id: r.part for r in split(rows.repartition(3).limit(500), ["id"], shares).collect()}
    assert all(parts[k] == v for k, v in again.items())
    assert sum(v == "train" for v in parts.values()) / 2_000 == pytest.approx(0.7, abs=0.05)
    assert {r.fold for r in folds(rows, ["id"], 3).select("fold").distinct().collect()} == {0, 1, 2}
    with pytest.raises(ValueError):
        split(rows, ["id"], {"train": 70})


def test_weights_balance_the_classes(rows):
    sums = class_weights(rows, "fraud").groupBy("fraud").agg(F.sum("weight").alias("w")).collect()
    assert [r.w for r in sums] == pytest.approx([1_000, 1_000])
    with pytest.raises(ValueError):
        class_weights(rows.filter("fraud = 0"), "fraud")


def test_attach_labels(spark):
    labels = spark.createDataFrame([(1, 1), (5, 0)], "id long, fraud int")
    assert attach_labels(spark.range(3), labels, "id").collect() == [(1, 1)]


@pytest.mark.parametrize(
    "params",
    [
        {"family": "bayes"},
        {"family": "logistic", "maxIter": 5},
        {"family": "forest", "numTrees": 5, "seed": 1},
        {"family": "boosted", "maxIter": 2, "seed": 1},
    ],
)
def test_saved_model_scores_raw_rows_the_same(spark, rows, path, params):
    def held():
        return set(spark.sparkContext._jsc.getPersistentRDDs())

    before = held()
    model = fit(rows, SPEC, params)
    assert held() <= before, "what fit keeps, it gives back"
    raw = rows.select("id", "amount", "kind")
    want = {r.id: r.p for r in score(raw, model).collect()}
    save_model(model, path("model"))
    got = {r.id: r.p for r in score(raw, load_model(path("model"))).collect()}
    assert got == want and all(0 <= p <= 1 for p in want.values())


def test_unknown_category_is_scored(spark, rows):
    model = fit(rows, SPEC, {"family": "bayes"})
    odd = spark.createDataFrame([(1, 3.0, "bond"), (2, 3.0, None)], "id long, amount double, kind string")
    assert all(r.p is not None for r in score(odd, model).collect())


def test_too_many_categories(rows):
    spec = DatasetSpec(
        name="p", schema=SPEC.schema, key=("id",), label="fraud", categorical=("kind",),
        max_categories=1,
    )
    with pytest.raises(ValueError, match="kind"):
        fit(rows, spec, {"family": "bayes"})


def test_search_finds_the_better_setting(rows):
    grid = {"family": "forest", "maxDepth": [0, 3], "numTrees": [5], "seed": [1]}
    model, params, table = search(rows, SPEC, grid)
    metric = {r.params["maxDepth"]: r.metric for r in table.collect()}
    assert metric["0"] == 0.5 < metric["3"]
    assert params["maxDepth"] == 3 and best_run(table).first().folds == 3
    assert score(rows, model).filter("p > 0").count() > 0


@pytest.mark.parametrize("weight", [None, "weight"])
def test_sums_give_the_models_that_fits_give(rows, weight):
    """A grid with modelType is fitted fold by fold, one without is not."""
    df = class_weights(rows, "fraud") if weight else rows
    spec = replace(SPEC, hashed=("id",), hash_buckets=8)
    grid = {"family": "bayes", "smoothing": [0.1, 1.0, 500.0]}
    _, params, table = search(df, spec, grid, weight=weight)
    _, same, fitted = search(df, spec, {**grid, "modelType": ["multinomial"]}, weight=weight)
    got, want = ({r.setting: r.metric for r in t.collect()} for t in (table, fitted))
    assert got == pytest.approx(want, abs=1e-9) and params["smoothing"] == same["smoothing"]


def test_sums_refuse_negative_features(rows):
    with pytest.raises(ValueError, match="negative"):
        search(rows.withColumn("amount", -F.col("amount")), SPEC, {"family": "bayes", "smoothing": [1.0]})


def test_hashed_columns_need_no_list_of_values(spark, rows):
    spec = replace(SPEC, hashed=("id",), hash_buckets=16, categorical=(), max_categories=1)
    model = fit(rows, spec, {"family": "bayes"})
    odd = spark.createDataFrame([(10**12, 3.0, "x"), (None, 3.0, None)], "id long, amount double, kind string")
    found = model.transform(odd).select(F.array_size(vector_to_array("features")).alias("n"), "probability").collect()
    assert [r.n for r in found] == [18, 18] and all(0 < r.probability[1] < 1 for r in found)


def test_one_class_cannot_be_searched(rows):
    with pytest.raises(ValueError, match="one class"):
        search(rows.filter("fraud = 0"), SPEC, {"family": "bayes", "smoothing": [1.0]})


def test_best_run_ignores_unmeasured_and_breaks_ties(spark):
    rows = [(0, {"a": "1"}, None, 0), (1, {"a": "2"}, 0.7, 3), (2, {"a": "3"}, 0.7, 3)]
    df = spark.createDataFrame(rows, "setting int, params map<string,string>, metric double, folds int")
    assert best_run(df).first().setting == 1


def test_load_dates_prune_files(spark, path):
    df = spark.range(9).withColumn("_status", F.lit("kept"))
    df = df.withColumn("load_date", F.date_add(F.lit(date(2024, 1, 1)), F.col("id").cast("int")))
    df.write.partitionBy("_status", "load_date").parquet(path("t"))
    new = loaded_between(spark.read.parquet(path("t")), date(2024, 1, 4), date(2024, 1, 6))
    assert sorted(r.id for r in new.collect()) == [3, 4]
    assert len(new.inputFiles()) >= 2
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull" in plan and "load_date" in plan.split("PartitionFilters")[1]
