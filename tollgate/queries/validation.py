"""Queries on validation and the model registry: V1-V7."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import POISSON_ONE_CDF
from ..operators.registry import champion, read_registry, register
from ..operators.train import retrain, training_rows
from ..operators.validate import (
    ALPHA,
    REPLICATES,
    bootstrap_metric,
    common_replicates,
    distribution,
    promote,
    t_test,
)
from ..plans.prepare import export_latest, latest, prepare
from ..plans.validate import METRIC, one_model, registry_row, validate
from ..session import scratch, stored
from ..sources.logs import RUNS, read_log
from ..sources.models import load_model
from ..spec import DatasetSpec, schema_of
from .data import (
    DOCUMENTS_PREV,
    auc_sql,
    bayes_sql,
    documents_sql,
    labelled_documents,
    table,
    word_sql,
)
from .training import TWO_MODELS_SQL, two_bayes_models

QUERIES = {}
ORACLES = {}


def _replicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bootstrap_metric(two_bayes_models(spark, sf_dir), ["doc_id"])


def bootstrap_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1, V2: ROC AUC of two models on 100 bootstrap samples each."""
    found = _replicates(spark, sf_dir)
    return found.select("model", F.col("b").cast("int").alias("b"), F.round("metric", 6).alias("metric"))


_WEIGHT = " ".join(f"WHEN u < {bound} THEN {k}" for k, bound in enumerate(POISSON_ONE_CDF))
_WORD = word_sql("model || '#' || doc_id || '#' || (b // 4)", "(b % 4)")
_DRAWN_SQL = f"""
    words AS (SELECT model, y, p, b, {_WORD} AS u
              FROM scored, (SELECT unnest(range({REPLICATES})) AS b)),
    drawn AS (SELECT model, y, p, b, CASE {_WEIGHT} ELSE 10 END AS w FROM words),
    replicates AS ({auc_sql("drawn", "model, b", weight="w")})"""
_REPLICATES_SQL = f"{TWO_MODELS_SQL}, {_DRAWN_SQL}"
QUERIES["bootstrap_auc"] = bootstrap_auc
ORACLES["bootstrap_auc"] = f"""
WITH {_REPLICATES_SQL}
SELECT model, CAST(b AS INTEGER) AS b, round(auc, 6) AS metric FROM replicates"""


def _distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distribution(common_replicates(_replicates(spark, sf_dir)))


_SPREAD_SQL = """
    common AS (SELECT model, b, auc FROM replicates
               QUALIFY count(auc) OVER (PARTITION BY b) = count(*) OVER (PARTITION BY b)),
    dist AS (SELECT model, count(auc) AS n, avg(auc) AS mean, var_samp(auc) AS var,
                    quantile_cont(auc, 0.025) AS q025, quantile_cont(auc, 0.5) AS q500,
                    quantile_cont(auc, 0.975) AS q975
             FROM common GROUP BY model)"""
_DIST_SQL = f"{_REPLICATES_SQL}, {_SPREAD_SQL}"


def metric_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3: mean, variance and quantiles of the metric."""
    found = _distribution(spark, sf_dir)
    return found.select(
        "model",
        "n",
        F.round("mean", 6).alias("mean"),
        F.round("var", 9).alias("var"),
        *[F.round(q, 6).alias(q) for q in ("q025", "q500", "q975")],
    )


QUERIES["metric_distribution"] = metric_distribution
ORACLES["metric_distribution"] = f"""
WITH {_DIST_SQL}
SELECT model, n, round(mean, 6) AS mean, round(var, 9) AS var, round(q025, 6) AS q025,
       round(q500, 6) AS q500, round(q975, 6) AS q975
FROM dist"""


def _tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every model against every one, so that better, worse and equal all occur."""
    dist = stored(_distribution(spark, sf_dir), "distribution")
    pairs = [("new", "prev"), ("prev", "new"), ("new", "new")]
    tests = [t_test(one_model(dist, a), one_model(dist, b)) for a, b in pairs]
    return tests[0].unionByName(tests[1]).unionByName(tests[2])


# The p-value here uses the closed form of the series' coefficients.
_TESTS_SQL = f"""{_DIST_SQL},
    pairs AS (
        SELECT a.model AS model_new, b.model AS model_prev, a.n AS n_new, b.n AS n_prev,
               a.mean AS mean_new, b.mean AS mean_prev, a.var AS var_new, b.var AS var_prev,
               a.n + b.n - 2 AS df
        FROM dist a JOIN dist b ON a.model = 'new' OR b.model = 'new'),
    tests AS (
        SELECT *, (mean_new - mean_prev)
            / sqrt(((n_new - 1) * var_new + (n_prev - 1) * var_prev) / df * (1e0 / n_new + 1e0 / n_prev))
            AS t
        FROM pairs),
    angles AS (SELECT *, atan(abs(t) / sqrt(df)) AS theta, df // 2 AS h FROM tests),
    tested AS (
        SELECT *, CASE WHEN t = 0 THEN 1e0
            WHEN abs(t) < 2 THEN 1 - sin(theta) * list_sum(list_transform(range(0, h), lambda k:
                exp(lgamma(2e0 * k + 1) - 2 * lgamma(k + 1e0) - 2e0 * k * ln(2e0)
                    + 2e0 * k * ln(cos(theta)))))
            ELSE sin(theta) * list_sum(list_transform(range(h, h + 10 * df + 201), lambda k:
                exp(lgamma(2e0 * k + 1) - 2 * lgamma(k + 1e0) - 2e0 * k * ln(2e0)
                    + 2e0 * k * ln(cos(theta)))))
            END AS p
        FROM angles)"""


def _rounded() -> list:
    return [
        "model_new",
        "model_prev",
        "n_new",
        "df",
        F.round("mean_new", 6).alias("mean_new"),
        F.round("mean_prev", 6).alias("mean_prev"),
        F.round("t", 6).alias("t"),
        F.round("p", 9).alias("p"),
    ]


_ROUNDED_SQL = """model_new, model_prev, n_new, df, round(mean_new, 6) AS mean_new,
       round(mean_prev, 6) AS mean_prev, round(t, 6) AS t, round(p, 9) AS p"""


def t_test_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V4: new against previous, the reverse, and a model against itself."""
    return _tests(spark, sf_dir).select(*_rounded())


QUERIES["t_test_models"] = t_test_models
ORACLES["t_test_models"] = f"WITH {_TESTS_SQL} SELECT {_ROUNDED_SQL} FROM tested"


def promotion_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V5: of these tests, those that promote."""
    return promote(_tests(spark, sf_dir)).select(*_rounded())


QUERIES["promotion_gate"] = promotion_gate
ORACLES["promotion_gate"] = f"""
WITH {_TESTS_SQL} SELECT {_ROUNDED_SQL} FROM tested WHERE p < {ALPHA} AND mean_new > mean_prev"""


def _registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The previous model registered first, then the new one if it passes the gate,
    then the new one once more, which is no better than itself."""
    path = scratch(spark, "registry")
    dist = stored(_distribution(spark, sf_dir), "distribution")
    new, prev = one_model(dist, "new"), one_model(dist, "prev")
    first = prev.select(
        F.col("n").alias("n_new"),
        F.col("mean").alias("mean_new"),
        F.col("var").alias("var_new"),
        F.lit(None).cast("double").alias("t"),
        F.lit(None).cast("double").alias("p"),
    )
    for passed, uri in (
        (first, "prev"),
        (promote(t_test(new, prev)), "new"),
        (promote(t_test(new, new)), "new"),
    ):
        register(spark, registry_row(passed, "documents", uri), path)
    return read_registry(spark, path)


def _registry_columns() -> list:
    return [
        "model_name",
        "version",
        "metric_name",
        F.round("metric_mean", 6).alias("metric_mean"),
        F.round("metric_var", 9).alias("metric_var"),
        "n_rep",
        "prev_version",
        F.round("t_stat", 6).alias("t_stat"),
        F.round("p_value", 9).alias("p_value"),
    ]


def register_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V6: the registry after three candidates."""
    return _registry(spark, sf_dir).select(*_registry_columns())


_REGISTRY_SQL = f"""{_TESTS_SQL},
    registry AS (
        SELECT 'documents' AS model_name, 1 AS version, '{METRIC}' AS metric_name,
               round(mean, 6) AS metric_mean, round(var, 9) AS metric_var,
               CAST(n AS INTEGER) AS n_rep, CAST(NULL AS INTEGER) AS prev_version,
               CAST(NULL AS DOUBLE) AS t_stat, CAST(NULL AS DOUBLE) AS p_value
        FROM dist WHERE model = 'prev'
        UNION ALL
        SELECT 'documents', 2, '{METRIC}', round(mean_new, 6), round(var_new, 9),
               CAST(n_new AS INTEGER), 1, round(t, 6), round(p, 9)
        FROM tested
        WHERE model_new = 'new' AND model_prev = 'prev' AND p < {ALPHA} AND mean_new > mean_prev)"""
QUERIES["register_version"] = register_version
ORACLES["register_version"] = f"WITH {_REGISTRY_SQL} SELECT * FROM registry"


def champion_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V7: the version a stream would be scored with."""
    return champion(_registry(spark, sf_dir), "documents").select(*_registry_columns())


QUERIES["champion_model"] = champion_model
ORACLES["champion_model"] = f"""
WITH {_REGISTRY_SQL} SELECT * FROM registry ORDER BY version DESC LIMIT 1"""


_KINDS = ("upper_pct", "stop_pct", "space_pct")
MEASURED = DatasetSpec(
    name="measured",
    schema=schema_of(doc_id="long", at="timestamp_ntz", **dict.fromkeys(_KINDS, "double")),
    key=("doc_id",),
    event_time="at",
    label="bad",
    label_expr="cast(quality = 0 as int)",
    numeric=_KINDS,
    required=("doc_id", "at"),
    delimiter=";",
)


def _measured_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two loads of the labelled documents' measures as text. In the first each document
    comes twice, and the later event counts; in the second a third of them come again,
    with an earlier event, and the later load counts."""
    found = labelled_documents(spark, sf_dir).select(
        "doc_id", *[F.expr(DOCUMENTS_PREV.derived[k]).alias(k) for k in _KINDS]
    )

    def lines(rows: DataFrame, at: str, more: float) -> DataFrame:
        fields = ["doc_id", F.lit(f"2024-01-01 {at}:00:00"), F.col("upper_pct") + more, *_KINDS[1:]]
        return rows.select(F.concat_ws(";", *fields).alias("value"))

    again = found.filter(F.col("doc_id") % 3 == 0)
    return lines(found, "10", 0.0).union(lines(found, "12", 1.0)), lines(again, "09", 2.0)


def retrain_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2, C6, S3, T8, V1-V7 in one chain: two loads, the export, a model trained on their
    last rows, its logged metrics on what was held out, and its registration. ``same``
    counts the rows that training and export have alike."""
    raw, checkpoint, clean_path, out, runs, models, registry = (scratch(spark, f"chain-{i}") for i in range(7))
    since = date(2000, 1, 1)
    for lines in _measured_lines(spark, sf_dir):
        lines.write.mode("append").text(raw)
        prepare(spark, MEASURED, raw, checkpoint, clean_path)
    export_latest(spark, MEASURED, clean_path, out, since)
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    rows = training_rows(spark, MEASURED, clean_path, since, labels=labels)
    run = retrain(
        spark, MEASURED, since, clean_path=clean_path, runs_path=runs, model_root=models,
        grid={"family": "bayes", "smoothing": [1.0]}, rows=rows,
    )
    held = rows.filter("part = 'valid'")
    validate(spark, MEASURED, held, load_model(run["model_uri"]), run["model_uri"], registry)
    same = latest(spark, MEASURED, out).join(rows.select("doc_id", *_KINDS), ["doc_id", *_KINDS]).count()
    logged = F.col("metrics")
    measured = read_log(spark, runs, RUNS).select(
        "model_name", *[F.round(logged[c], 6).alias(c) for c in ("n", "tp", "fp", "fn", "tn", "auc")]
    )
    known = read_registry(spark, registry).select(
        "model_name", "version", F.round("metric_mean", 6).alias("metric_mean"), F.round("metric_var", 9).alias("metric_var"), "n_rep"
    )
    return measured.join(known, "model_name").withColumn("same", F.lit(same).cast("long"))


_LAST_SQL = """SELECT doc_id, y, percent, x1 + CASE WHEN doc_id % 3 = 0 THEN 2e0 ELSE 1e0 END AS x1, x2, x3
    FROM (""" + documents_sql(DOCUMENTS_PREV) + ")"
QUERIES["retrain_validate"] = retrain_validate
ORACLES["retrain_validate"] = f"""
WITH {bayes_sql(_LAST_SQL, 3, train="percent < 80", keep="percent >= 80", name="r")},
    scored AS (SELECT 'new' AS model, doc_id, y, p FROM r_scored),
    {_DRAWN_SQL}, {_SPREAD_SQL}
SELECT 'measured' AS model_name, (SELECT count(*) FROM scored)::DOUBLE AS n,
       (SELECT count(*) FROM scored WHERE y = 1 AND p > 0.5)::DOUBLE AS tp,
       (SELECT count(*) FROM scored WHERE y = 0 AND p > 0.5)::DOUBLE AS fp,
       (SELECT count(*) FROM scored WHERE y = 1 AND p <= 0.5)::DOUBLE AS fn,
       (SELECT count(*) FROM scored WHERE y = 0 AND p <= 0.5)::DOUBLE AS tn,
       (SELECT round(auc, 6) FROM ({auc_sql("scored", "model")})) AS auc, 1 AS version,
       round(mean, 6) AS metric_mean, round(var, 9) AS metric_var, CAST(n AS INTEGER) AS n_rep,
       (SELECT count(*) FROM documents JOIN labels USING (doc_id)) AS same
FROM dist"""
