"""Compare a new model with the registered one and register it if it is better."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.registry import champion, read_registry, register
from ..operators.train import score_models
from ..operators.validate import (
    ALPHA,
    REPLICATES,
    bootstrap_metric,
    common_replicates,
    distribution,
    promote,
    t_test,
)
from ..session import stored
from ..sources.models import load_model
from ..spec import DatasetSpec

METRIC = "roc_auc"


def one_model(dist: DataFrame, model: str) -> DataFrame:
    return dist.filter(F.col("model") == model)


def validate(
    spark: SparkSession,
    spec: DatasetSpec,
    rows: DataFrame,
    model: PipelineModel,
    model_uri: str,
    registry_path: str,
    alpha: float = ALPHA,
    n_rep: int = REPLICATES,
) -> bool:
    """True if ``model`` was registered: it is the first, or significantly better."""
    last = champion(read_registry(spark, registry_path), spec.name).first()
    models = {"new": model}
    if last is not None:
        models["prev"] = load_model(last.model_uri)
    scored = score_models(rows, spec, models)
    replicates = common_replicates(bootstrap_metric(scored, spec.key, n_rep))
    # At most two models times n_rep rows: stored, so that the gate, the registry
    # and the answer below do not each run the bootstrap again.
    dist = distribution(stored(replicates, "replicates"))
    if last is None:
        passed = one_model(dist, "new").select(
            F.col("n").alias("n_new"), F.col("mean").alias("mean_new"), F.col("var").alias("var_new"),
            F.lit(None).cast("double").alias("t"), F.lit(None).cast("double").alias("p"),
        )
    else:
        passed = promote(t_test(one_model(dist, "new"), one_model(dist, "prev")), alpha)
    row = registry_row(passed, spec.name, model_uri)
    if row.first() is None:
        return False
    register(spark, row, registry_path)
    return True


def registry_row(passed: DataFrame, name: str, model_uri: str) -> DataFrame:
    return passed.select(
        F.lit(name).alias("model_name"),
        F.lit(model_uri).alias("model_uri"),
        F.lit(METRIC).alias("metric_name"),
        F.col("mean_new").alias("metric_mean"),
        F.col("var_new").alias("metric_var"),
        F.col("n_new").cast("int").alias("n_rep"),
        F.col("t").alias("t_stat"),
        F.col("p").alias("p_value"),
    )
