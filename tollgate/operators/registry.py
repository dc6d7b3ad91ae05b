"""V6 and V7: the table of registered model versions."""

from __future__ import annotations

from datetime import datetime, timezone
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.logs import REGISTRY, append, read_log
from ..sources.markers import claim

_GIVEN = [
    "model_name", "model_uri", "metric_name", "metric_mean", "metric_var", "n_rep",
    "t_stat", "p_value",
]


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    return read_log(spark, path, REGISTRY)


def champion(registry: DataFrame, name: str | None = None) -> DataFrame:
    """V7: the latest version of one model, or of every model."""
    rows = registry if name is None else registry.filter(F.col("model_name") == name)
    last = F.max_by(F.struct(*rows.columns), "version").alias("last")
    return rows.groupBy("model_name").agg(last).select("last.*")


def register(spark: SparkSession, row: DataFrame, path: str) -> None:
    """V6: append ``row`` as the next version of its model; no row, no version.

    A version is claimed before it is written, by a mark that only one can set: of two
    validations at once each gets a version of its own. One that fails after its claim
    leaves a gap. A first version has null ``prev_version``, ``t_stat`` and ``p_value``.
    """
    schema = spark.createDataFrame([], REGISTRY).schema
    for new in row.select(*_GIVEN).collect():  # one row for each model that is registered
        last = champion(read_registry(spark, path), new.model_name).first()
        version = (last.version if last else 0) + 1
        while not claim(spark, f"{path}/_claims/{quote(new.model_name, safe='')}/{version:08d}"):
            version += 1
        made = {"version": version, "prev_version": last.version if last else None}
        full = {**new.asDict(), **made, "created_at": datetime.now(timezone.utc)}
        append(spark.createDataFrame([full], schema), path)
