"""Fit, search, choose and apply a classifier."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, time, timezone

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from ..session import stored
from ..spec import DatasetSpec
from ..sources.logs import log_run
from ..sources.models import save_model
from ..sources.files import read_clean
from .clean import dedup, last_loaded
from .features import (
    attach_labels,
    check_categories,
    class_weights,
    feature_stages,
    folds,
    split,
    with_label,
)
from .metrics import auc, metrics, score_cuts

FAMILIES = {
    "bayes": NaiveBayes,
    "boosted": GBTClassifier,
    "forest": RandomForestClassifier,
    "logistic": LogisticRegression,
}
ONE_PASS = {"bayes"}
SEARCH_TABLE = "setting int, params map<string,string>, metric double, folds int"


def classifier(spec: DatasetSpec, family: str, weight: str | None = None, **params):
    made = FAMILIES[family](featuresCol="features", labelCol=spec.label, **params)
    return made.setWeightCol(weight) if weight else made


def _assemble(
    df: DataFrame, spec: DatasetSpec, kept: Sequence[str]
) -> tuple[PipelineModel, DataFrame]:
    """Fitted feature stages, and the columns a learner reads."""
    check_categories(df, spec)
    features = Pipeline(stages=feature_stages(spec)).fit(df)
    return features, features.transform(df).select("features", *kept)


def fit(
    df: DataFrame, spec: DatasetSpec, params: Mapping, weight: str | None = None
) -> PipelineModel:
    """Fit features and classifier on labelled rows.

    ``params`` holds ``family`` and that learner's parameters. Learners that pass
    over the rows many times get the assembled features from storage.
    """
    params = dict(params)
    family = params.pop("family")
    learner = classifier(spec, family, weight, **params)
    features, ready = _assemble(df, spec, [spec.label, *([weight] if weight else [])])
    if family in ONE_PASS:
        return PipelineModel(stages=[*features.stages, learner.fit(ready)])
    ready = ready.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return PipelineModel(stages=[*features.stages, learner.fit(ready)])
    finally:
        ready.unpersist()


def score(df: DataFrame, model: PipelineModel) -> DataFrame:
    """The rows with ``prediction`` and ``p``, the positive probability.

    Takes batch and streaming frames alike; no Python runs per row.
    """
    scored = model.transform(df)
    return scored.select(*df.columns, F.col("prediction"), positive_probability().alias("p"))


def positive_probability() -> Column:
    """A model that saw negatives only gives one probability, that of a negative."""
    return F.coalesce(F.get(vector_to_array("probability"), 1), F.lit(0.0))


def score_models(
    rows: DataFrame, spec: DatasetSpec, models: Mapping[str, PipelineModel]
) -> DataFrame:
    """Every labelled row scored by every model, stored once as ``(model, key..., label, p)``.

    The rows are read once for all models. The result is needed twice, for the
    score ranges and for the metric, and scoring is the dear part.
    """
    wide = rows
    for i, model in enumerate(models.values()):
        wide = score(wide, model).withColumnRenamed("p", f"_p{i}").drop("prediction")
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("model"), F.col(f"_p{i}").alias("p"))
            for i, name in enumerate(models)
        ]
    )
    label = F.col(spec.label).cast("int").alias("label")
    return stored(wide.select(*spec.key, label, F.inline(pairs)), "scored")


def search(
    df: DataFrame,
    spec: DatasetSpec,
    grid: Mapping[str, Sequence],
    n_folds: int = 3,
    weight: str | None = None,
    parallelism: int = 4,
) -> tuple[PipelineModel, dict, DataFrame]:
    """T4: cross-validated grid search by ROC AUC.

    ``grid`` holds ``family`` and lists of values. Returns the model refitted on
    all rows with the best parameters, these parameters, and one row per setting.
    Folds come from the key, so copies of a row never face each other. Features
    are assembled once and kept. A fold whose training rows are of one class is
    left out. All settings are scored in one pass and measured in one. (Spark's
    CrossValidator is not used: with a fold column it calls a Python function on
    every row, and its evaluator is binned by default.)
    """
    grid = dict(grid)
    family = grid.pop("family")
    learner = classifier(spec, family, weight)
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder.addGrid(getattr(learner, name), list(values))
    settings = builder.build()

    kept = [spec.label, "fold", *([weight] if weight else [])]
    features, ready = _assemble(folds(df, spec.key, n_folds), spec, kept)
    kept_on = StorageLevel.MEMORY_AND_DISK
    ready = ready.persist(kept_on)
    try:
        usable = _two_class_folds(ready, spec.label, n_folds)
        if not usable:
            raise ValueError("in every fold the training rows are of one class")
        if family == "bayes" and set(grid) <= {"smoothing"}:
            scored = _bayes_scores(ready, spec.label, weight, learner, settings, usable)
        else:
            scored = _fitted_scores(ready, spec.label, learner, settings, usable, parallelism)
        cells = scored.groupBy("setting", "fold", spec.label, "p").agg(F.count("*").alias("rows")).persist(kept_on)
        try:
            by_fold = auc(cells, ["setting", "fold"], "p", spec.label, "rows", score_cuts(cells, "p"))
            by_setting = by_fold.groupBy("setting").agg(F.avg("auc").alias("metric"), F.count("auc").alias("folds"))
            found = {r.setting: (r.metric, r.folds) for r in by_setting.collect()}
        finally:
            cells.unpersist()
        named = [{p.name: v for p, v in s.items()} for s in settings]
        rows = [
            (i, {"family": family, **{k: str(v) for k, v in params.items()}}, *found[i])
            for i, params in enumerate(named)
        ]
        table = df.sparkSession.createDataFrame(rows, SEARCH_TABLE)
        if all(metric is None for metric, _ in found.values()):
            raise ValueError("no fold holds out both classes")
        best = best_run(table).first().setting
        final = learner.fit(ready, settings[best])
    finally:
        ready.unpersist()
    model = PipelineModel(stages=[*features.stages, final])
    return model, {"family": family, **named[best]}, table


def _fitted_scores(
    ready: DataFrame, label: str, learner, settings: Sequence, usable: Sequence[int], parallelism: int
) -> DataFrame:
    """Held-out rows scored by every setting: a fit for each setting and fold, in driver
    threads that only submit jobs; a fold is scored by all its models in one pass."""

    def fitted(place: tuple[int, int]):
        fold, i = place
        return learner.fit(ready.filter(F.col("fold") != fold), settings[i])

    places = [(fold, i) for fold in usable for i in range(len(settings))]
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        models = dict(zip(places, pool.map(inheritable_thread_target(ready.sparkSession)(fitted), places), strict=True))
    scored = None
    for fold in usable:
        wide = ready.filter(F.col("fold") == fold)
        for i in range(len(settings)):
            wide = models[fold, i].transform(wide).withColumn(f"_p{i}", positive_probability())
            wide = wide.drop("rawPrediction", "probability", "prediction")
        pairs = [F.struct(F.lit(i).alias("setting"), F.col(f"_p{i}").alias("p")) for i in range(len(settings))]
        held_out = wide.select("fold", label, F.inline(F.array(*pairs)))
        scored = held_out if scored is None else scored.unionByName(held_out)
    return scored


def _bayes_scores(
    ready: DataFrame, label: str, weight: str | None, learner, settings: Sequence, usable: Sequence[int]
) -> DataFrame:
    """Held-out rows scored by naive Bayes of every smoothing, without a fit.

    The model is made of sums: of weights and of features, by label. They are counted
    once by fold; what a fold is not trained on are the totals less its own. So one pass
    counts and one scores, however many settings and folds there are. What reaches the
    driver are the sums, two feature vectors a fold, and what goes back the models.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    summary = Summarizer.metrics("sum", "min").summary(F.col("features"), w).alias("s")
    counted = ready.groupBy("fold", label).agg(summary, F.sum(w).alias("w")).select("fold", label, "s.sum", "s.min", "w")
    sums = {(r.fold, int(r[1])): (r.w, r["sum"].toArray()) for r in counted.collect() if _nonnegative(r)}
    dims = len(next(iter(sums.values()))[1])
    nothing = (0.0, np.zeros(dims))
    all_folds = sorted({fold for fold, _ in sums})
    models = []
    for fold in usable:
        rest = [[sums.get((f, y), nothing) for f in all_folds if f != fold] for y in (0, 1)]
        n, x = zip(*[(sum(v for v, _ in own), sum(v for _, v in own)) for own in rest], strict=True)
        made = []
        for i, setting in enumerate(settings):
            smooth = setting.get(learner.smoothing, learner.getSmoothing())
            theta = [np.log(x[y] + smooth) - np.log(x[y].sum() + dims * smooth) for y in (0, 1)]
            prior = float(np.log(n[1] + smooth) - np.log(n[0] + smooth))
            made.append((i, prior, (theta[1] - theta[0]).tolist()))
        models.append((fold, made))
    schema = "fold int, models array<struct<setting: int, prior: double, weights: array<double>>>"
    known = F.broadcast(ready.sparkSession.createDataFrame(models, schema))  # folds x settings x features numbers
    rows = ready.join(known, "fold").select("fold", label, F.unwrap_udt("features").alias("x"), F.inline("models"))
    sparse = F.zip_with("x.indices", "x.values", lambda i, v: F.get("weights", i) * v)
    dense = F.zip_with("x.values", "weights", lambda v, b: v * b)
    parts = F.when(F.col("x.type") == 0, sparse).otherwise(dense)
    product = F.aggregate(parts, F.col("prior"), lambda s, v: s + v)
    return rows.select("setting", "fold", label, (1.0 / (1.0 + F.exp(-product))).alias("p"))


def _nonnegative(row) -> bool:
    if min(row["min"].toArray(), default=0.0) < 0:
        raise ValueError("naive Bayes needs features that are not negative")
    return True


def _two_class_folds(ready: DataFrame, label: str, n_folds: int) -> list[int]:
    """Folds whose training rows hold both classes."""
    counts = ready.groupBy("fold").agg(F.count("*").alias("n"), F.sum(label).alias("pos"))
    found = {r.fold: (r.n, r.pos) for r in counts.collect()}
    n, pos = (sum(v[i] for v in found.values()) for i in (0, 1))
    rest = {f: (n - found.get(f, (0, 0))[0], pos - found.get(f, (0, 0))[1]) for f in range(n_folds)}
    return [f for f, (n_rest, pos_rest) in rest.items() if 0 < pos_rest < n_rest and f in found]


def best_run(table: DataFrame) -> DataFrame:
    """The setting with the highest metric; of equals, the first."""
    rank = F.struct(F.col("metric"), -F.col("setting"))
    usable = table.filter(F.col("metric").isNotNull())
    return usable.agg(F.max_by(F.struct(*table.columns), rank).alias("best")).select("best.*")


def loaded_between(clean: DataFrame, since: date, until: date | None = None) -> DataFrame:
    """Kept rows by load date. Both columns are partitions: other files are not read."""
    rows = clean.filter((F.col("_status") == "kept") & (F.col("load_date") >= F.lit(since)))
    return rows if until is None else rows.filter(F.col("load_date") < F.lit(until))


def training_rows(
    spark: SparkSession,
    spec: DatasetSpec,
    clean_path: str,
    since: date,
    until: date | None = None,
    labels: DataFrame | None = None,
) -> DataFrame:
    """The last loaded row of each key, labelled and split into ``part``, stored."""
    rows = loaded_between(read_clean(spark, spec, clean_path, since), since, until)
    rows = dedup(rows, list(spec.key), last_loaded(spec)).select(*spec.columns)
    if labels is not None:
        rows = attach_labels(rows, labels, list(spec.key))
    rows = with_label(rows, spec).select(*spec.columns, spec.label)
    return stored(split(rows, spec.key, {"train": 80, "valid": 20}), "training-rows")


def held_out(
    spark: SparkSession,
    spec: DatasetSpec,
    clean_path: str,
    since: date,
    until: date | None = None,
    labels: DataFrame | None = None,
) -> DataFrame:
    """The rows that ``retrain`` with the same arguments does not train on."""
    return training_rows(spark, spec, clean_path, since, until, labels).filter("part = 'valid'")


def retrain(
    spark: SparkSession,
    spec: DatasetSpec,
    since: date,
    *,
    clean_path: str,
    runs_path: str,
    model_root: str,
    grid: Mapping[str, Sequence],
    until: date | None = None,
    labels: DataFrame | None = None,
    weight: str | None = None,
    n_folds: int = 3,
    rows: DataFrame | None = None,
) -> dict:
    """Search on the rows loaded since ``since``, save the model, log the run.

    Of the rows with one key the last loaded counts. A fifth of the keys is held out
    for the logged metrics and for validation; ``held_out`` gives them. ``weight``
    names a column that gets class weights, taken from the training part. The rows
    are stored, with the columns that the spec names, since training passes over
    them several times. Who needs them afterwards, as validation does, gets them from
    ``training_rows`` and hands them in as ``rows``: they are then made only once.
    """
    if rows is None:
        rows = training_rows(spark, spec, clean_path, since, until, labels)
    fitted = rows.filter(F.col("part") == "train")
    if weight is not None:
        fitted = class_weights(fitted, spec.label, weight)
    model, params, table = search(fitted, spec, grid, n_folds=n_folds, weight=weight)
    run_id = uuid.uuid4().hex
    scored = score_models(rows.filter(F.col("part") == "valid"), spec, {run_id: model})
    measured = metrics(scored).drop("model").first()
    run = {
        "run_id": run_id,
        "model_name": spec.name,
        "train_from": _midnight(since),
        "train_to": _midnight(until) if until else None,
        "params": params,
        "metrics": {
            **(measured.asDict() if measured else {}),
            "search_auc": best_run(table).first().metric,
        },
        "model_uri": save_model(model, f"{model_root}/{spec.name}/{run_id}"),
    }
    log_run(spark, run, runs_path)
    return run


def _midnight(day: date):
    return datetime.combine(day, time(), timezone.utc)
