"""Queries on features, training and scoring: J1, T1-T8, W1, S6, S7."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.features import class_weights, feature_stages, folds, split, with_label
from ..operators.metrics import auc, metrics
from ..operators.train import (
    best_run,
    fit,
    positive_probability,
    retrain,
    score,
    score_models,
    search,
)
from ..session import scratch, spread
from ..sources.files import write_clean
from ..sources.logs import RUNS, read_log
from ..sources.models import load_model, save_model
from ..spec import schema_of
from .data import (
    DOCUMENTS,
    DOCUMENTS_NEW,
    DOCUMENTS_PREV,
    LINEITEM,
    LINEITEM_COLUMNS,
    LINEITEM_FEATURES,
    auc_sql,
    bayes_sql,
    documents_spec,
    documents_sql,
    labelled_documents,
    percent_sql,
    table,
    word_sql,
)

QUERIES = {}
ORACLES = {}

BAYES = {"family": "bayes", "smoothing": 1.0}
SHARES = {"train": 60, "valid": 40}


def labelled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-hot language and scaled character shares of the labelled documents."""
    spec = documents_spec(("upper_pct", "stop_pct"), categorical=("lang",), scale=True)
    df = with_label(labelled_documents(spark, sf_dir), spec)
    ready = Pipeline(stages=feature_stages(spec)).fit(df).transform(df)
    x = vector_to_array("features")
    n_langs = F.array_size(x) - 2
    return ready.select(
        "doc_id",
        "lang",
        F.col("bad").alias("label"),
        F.round(F.aggregate(F.slice(x, 1, n_langs), F.lit(0.0), lambda a, v: a + v), 6).alias("lang_part"),
        F.round(F.element_at(x, -2), 6).alias("upper"),
        F.round(F.element_at(x, -1), 6).alias("stop"),
    )


QUERIES["labelled_features"] = labelled_features
ORACLES["labelled_features"] = f"""
WITH f AS ({documents_sql(documents_spec(("upper_pct", "stop_pct")))}),
l AS (SELECT doc_id, lang FROM documents JOIN labels USING (doc_id)),
share AS (SELECT lang, count(*) * 1e0 / sum(count(*)) OVER () AS q, sum(count(*)) OVER () AS n
          FROM l GROUP BY lang)
SELECT doc_id, lang, y AS label,
       round(1e0 / sqrt(q * (1 - q) * n / (n - 1)), 6) AS lang_part,
       round(x1 / (SELECT stddev_samp(x1) FROM f), 6) AS upper,
       round(x2 / (SELECT stddev_samp(x2) FROM f), 6) AS stop
FROM f JOIN l USING (doc_id) JOIN share USING (lang)"""


_HASHED = replace(
    LINEITEM, name="merchants", schema=schema_of(l_suppkey="long", l_quantity="double"), derived={},
    numeric=("l_quantity",), categorical=(), hashed=("l_suppkey",), hash_buckets=64,
)


def hashed_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers, as merchants of any number, dealt out over 64 features, and the
    chance of a return that naive Bayes gives an item of each at one quantity."""
    items = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_quantity", "l_returnflag")
    items = with_label(items, _HASHED)
    model = fit(items, _HASHED, BAYES)
    one = items.select("l_suppkey").distinct().withColumn("l_quantity", F.lit(1.0))
    x = vector_to_array("features")
    found = model.transform(one).withColumn("p", positive_probability())
    return found.select(
        "l_suppkey", (F.array_position(x, 1.0) - 1).alias("bucket"), F.array_size(x).alias("features"), F.round("p", 6).alias("p")
    )


QUERIES["hashed_features"] = hashed_features
_BUCKET = f"{word_sql(chr(39) + 'l_suppkey=' + chr(39) + ' || l_suppkey', '0')} % 64"
ORACLES["hashed_features"] = f"""
WITH i AS (SELECT l_suppkey, {_BUCKET} AS bucket, l_quantity AS q,
                  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y FROM lineitem),
c AS (SELECT y, count(*) AS n, sum(q) AS q FROM i GROUP BY y),
b AS (SELECT bucket, count(*) FILTER (y = 1) AS n1, count(*) FILTER (y = 0) AS n0 FROM i GROUP BY bucket),
t AS (SELECT max(n) FILTER (y = 1) AS n1, max(n) FILTER (y = 0) AS n0,
             max(q) FILTER (y = 1) AS q1, max(q) FILTER (y = 0) AS q0 FROM c)
SELECT DISTINCT l_suppkey, bucket, 65 AS features,
       round(1e0 / (1e0 + exp(-(ln(t.n1 + 1e0) - ln(t.n0 + 1e0)
           + ln(b.n1 + 1e0) - ln(t.n1 + t.q1 + 65) - ln(b.n0 + 1e0) + ln(t.n0 + t.q0 + 65)
           + ln(t.q1 + 1e0) - ln(t.n1 + t.q1 + 65) - ln(t.q0 + 1e0) + ln(t.n0 + t.q0 + 65)))), 6) AS p
FROM i JOIN b USING (bucket), t"""


def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part, fold and class weight of the labelled documents."""
    df = with_label(labelled_documents(spark, sf_dir), DOCUMENTS)
    df = folds(split(df, ["doc_id"], {"train": 60, "valid": 20, "test": 20}), ["doc_id"], 3)
    weighted = class_weights(df, "bad")
    return weighted.select("doc_id", "part", "fold", F.round("weight", 6).alias("weight"))


QUERIES["hash_split"] = hash_split
ORACLES["hash_split"] = f"""
WITH d AS (
    SELECT doc_id, CASE WHEN quality = 0 THEN 1 ELSE 0 END AS y, {percent_sql("doc_id")} AS percent,
           {percent_sql("doc_id", word=1, buckets=3)} AS fold
    FROM documents JOIN labels USING (doc_id))
SELECT doc_id, CASE WHEN percent < 60 THEN 'train' WHEN percent < 80 THEN 'valid' ELSE 'test' END
       AS part, fold,
       round(count(*) OVER () / (2e0 * count(*) OVER (PARTITION BY y)), 6) AS weight
FROM d"""


def returned_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select(*LINEITEM_COLUMNS)
    return with_label(items, LINEITEM)


def _item_scores(scored: DataFrame) -> DataFrame:
    return scored.select(
        "l_orderkey", "l_linenumber", "prediction", F.round("p", 6).alias("p")
    )


def nb_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Naive Bayes fitted on all line items and applied to them."""
    items = returned_items(spark, sf_dir)
    return _item_scores(score(items, fit(items, LINEITEM, BAYES)))


NB_SCORES_SQL = f"""
WITH {bayes_sql(LINEITEM_FEATURES, 5)}
SELECT l_orderkey, l_linenumber, CASE WHEN p > 0.5e0 THEN 1e0 ELSE 0e0 END AS prediction,
       round(p, 6) AS p
FROM m_scored"""
QUERIES["nb_scores"] = nb_scores
ORACLES["nb_scores"] = NB_SCORES_SQL

_SMOOTHING = [0.5, 1000.0, 1e6]
_GRID = {"family": "bayes", "smoothing": _SMOOTHING}
_ITEM_FOLD = percent_sql(
    "CAST(l_orderkey AS VARCHAR) || '#' || CAST(l_linenumber AS VARCHAR)", word=1, buckets=3
)


def _bayes_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, found = search(spread(returned_items(spark, sf_dir)), LINEITEM, _GRID)
    return found


def _setting_columns() -> list:
    return [
        "setting",
        F.col("params")["smoothing"].cast("double").alias("smoothing"),
        F.round("metric", 6).alias("metric"),
        "folds",
    ]


def nb_grid_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: mean ROC AUC over three folds for each smoothing value."""
    return _bayes_search(spark, sf_dir).select(*_setting_columns())


def nb_best_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best row of the same search."""
    return best_run(_bayes_search(spark, sf_dir)).select(*_setting_columns())


def _grid_sql(features: str, d: int, smoothing: list[float], rows: str = "TRUE") -> str:
    """CTE ``grid(setting, smoothing, metric, folds)`` of a three-fold search."""
    fits = ",".join(
        bayes_sql(
            features, d, f"{s!r}::DOUBLE", f"({rows}) AND fold <> {k}", f"({rows}) AND fold = {k}",
            name=f"m{i}_{k}",
        )
        for i, s in enumerate(smoothing)
        for k in range(3)
    )
    union = " UNION ALL ".join(
        f"SELECT {i} AS setting, {s!r}::DOUBLE AS smoothing, {k} AS fold, y, p "
        f"FROM m{i}_{k}_scored, m{i}_{k}_sums WHERE n1 > 0 AND n0 > 0"
        for i, s in enumerate(smoothing)
        for k in range(3)
    )
    return f"""{fits}, held_out AS ({union}),
    by_fold AS ({auc_sql("held_out", "setting, smoothing, fold")}),
    grid AS (SELECT setting, smoothing, round(avg(auc), 6) AS metric,
                    CAST(count(auc) AS INTEGER) AS folds
             FROM by_fold GROUP BY setting, smoothing)"""


_ITEM_GRID = _grid_sql(
    LINEITEM_FEATURES.replace("FROM lineitem", f", {_ITEM_FOLD} AS fold FROM lineitem"),
    5,
    _SMOOTHING,
)
QUERIES["nb_grid_metrics"] = nb_grid_metrics
ORACLES["nb_grid_metrics"] = f"WITH {_ITEM_GRID} SELECT * FROM grid"
QUERIES["nb_best_params"] = nb_best_params
ORACLES["nb_best_params"] = (
    f"WITH {_ITEM_GRID} SELECT * FROM grid ORDER BY metric DESC, setting LIMIT 1"
)


def two_bayes_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out documents scored by a model on five features and one on three."""
    df = split(with_label(labelled_documents(spark, sf_dir), DOCUMENTS), ["doc_id"], SHARES)
    df = df.select("doc_id", "text", "bad", "part")
    train = df.filter("part = 'train'")
    models = {
        "new": fit(train, DOCUMENTS_NEW, BAYES),
        "prev": fit(train, DOCUMENTS_PREV, BAYES),
    }
    return score_models(df.filter("part = 'valid'"), DOCUMENTS, models)


TWO_MODELS_SQL = f"""
    {bayes_sql(documents_sql(DOCUMENTS_NEW), 5, train="percent < 60", keep="percent >= 60", name="a")},
    {bayes_sql(documents_sql(DOCUMENTS_PREV), 3, train="percent < 60", keep="percent >= 60", name="b")},
    scored AS (SELECT 'new' AS model, doc_id, y, p FROM a_scored
               UNION ALL SELECT 'prev', doc_id, y, p FROM b_scored)"""


_MEASURES = ("precision", "recall", "f1", "auc")


def classifier_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: confusion counts, precision, recall, F1 and ROC AUC of two models."""
    measured = metrics(two_bayes_models(spark, sf_dir))
    return measured.select(
        "model", "n", "tp", "fp", "fn", "tn", *[F.round(c, 6).alias(c) for c in _MEASURES]
    )


def _metrics_sql(source: str, by: str) -> str:
    return f"""
    SELECT {by}, n, tp, fp, fn, tn, round(tp / nullif(tp + fp, 0e0), 6) AS precision,
           round(tp / nullif(tp + fn, 0e0), 6) AS recall,
           round(2e0 * tp / nullif(2e0 * tp + fp + fn, 0e0), 6) AS f1, round(auc, 6) AS auc
    FROM (SELECT {by}, count(*) AS n,
                 count(*) FILTER (y = 1 AND p > 0.5) AS tp, count(*) FILTER (y = 0 AND p > 0.5) AS fp,
                 count(*) FILTER (y = 1 AND p <= 0.5) AS fn, count(*) FILTER (y = 0 AND p <= 0.5) AS tn
          FROM {source} GROUP BY {by})
    JOIN ({auc_sql(source, by)}) USING ({by})"""


QUERIES["classifier_metrics"] = classifier_metrics
ORACLES["classifier_metrics"] = f"WITH {TWO_MODELS_SQL} {_metrics_sql('scored', 'model')}"


def ranked_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How well the price alone ranks returned items, per line status."""
    items = table(spark, sf_dir, "lineitem").select(
        "l_linestatus", "l_extendedprice", F.expr(LINEITEM.label_expr).alias("label")
    )
    ranked = auc(items, ["l_linestatus"], "l_extendedprice")
    return ranked.select("l_linestatus", F.round("auc", 9).alias("auc"))


QUERIES["ranked_auc"] = ranked_auc
ORACLES["ranked_auc"] = f"""
WITH i AS (SELECT l_linestatus, l_extendedprice AS p,
                  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y FROM lineitem)
SELECT l_linestatus, round(auc, 9) AS auc FROM ({auc_sql("i", "l_linestatus")})"""


def model_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model saved, loaded and applied to raw columns."""
    items = returned_items(spark, sf_dir)
    uri = save_model(fit(items, LINEITEM, BAYES), scratch(spark, "model"))
    return _item_scores(score(items.drop("returned", "l_returnflag"), load_model(uri)))


QUERIES["model_reload"] = model_reload
ORACLES["model_reload"] = NB_SCORES_SQL


def forest_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3, T7 with a weighted random forest; no SQL equivalent."""
    df = with_label(labelled_documents(spark, sf_dir), DOCUMENTS)
    df = class_weights(split(df, ["doc_id"], SHARES), "bad")
    params = {"family": "forest", "numTrees": 20, "maxDepth": 5, "seed": 7}
    model = fit(df.filter("part = 'train'"), DOCUMENTS, params, weight="weight")
    return score(df.filter("part = 'valid'"), model).select("doc_id", "bad", "prediction", "p")


QUERIES["forest_scores"] = forest_scores


def boosted_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3, T7 with boosted trees; no SQL equivalent."""
    df = split(with_label(labelled_documents(spark, sf_dir), DOCUMENTS), ["doc_id"], SHARES)
    params = {"family": "boosted", "maxIter": 5, "maxDepth": 3, "seed": 7}
    model = fit(df.filter("part = 'train'"), DOCUMENTS, params)
    return score(df.filter("part = 'valid'"), model).select("doc_id", "bad", "prediction", "p")


QUERIES["boosted_scores"] = boosted_scores


_STUMP = replace(
    LINEITEM, name="stump", schema=schema_of(l_linenumber="integer", l_discount="double", l_tax="double"),
    numeric=("l_linenumber", "disc_pct", "tax_pct"), categorical=(),
)


def forest_stump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forest of one tree of one split, over all rows, weighed by class, and
    features of few values. SQL lists all splits, takes the one of most gain, and has the
    same two leaves."""
    items = returned_items(spark, sf_dir).select("l_linenumber", "l_discount", "l_tax", "returned")
    params = {
        "family": "forest", "numTrees": 1, "maxDepth": 1, "bootstrap": False, "subsamplingRate": 1.0,
        "featureSubsetStrategy": "all", "seed": 7,
    }
    scored = score(items, fit(class_weights(items, "returned"), _STUMP, params, weight="weight"))
    return scored.groupBy(F.round("p", 9).alias("p")).agg(
        F.count("*").alias("n"), F.sum("returned").cast("long").alias("returned")
    )


QUERIES["forest_stump"] = forest_stump
ORACLES["forest_stump"] = """
WITH items AS (
    SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, l_linenumber::DOUBLE AS f1,
           l_discount * 100 AS f2, l_tax * 100 AS f3 FROM lineitem),
classes AS (SELECT count(*)::DOUBLE AS n, sum(y)::DOUBLE AS pos FROM items),
cells AS (
    SELECT 1 AS f, f1 AS x, count(*) AS n, sum(y) AS pos FROM items GROUP BY f1
    UNION ALL SELECT 2, f2, count(*), sum(y) FROM items GROUP BY f2
    UNION ALL SELECT 3, f3, count(*), sum(y) FROM items GROUP BY f3),
splits AS (
    SELECT f, x, sum(n) OVER w AS n, sum(pos) OVER w AS pos FROM cells WINDOW w AS (PARTITION BY f ORDER BY x)),
sides AS (
    SELECT f, x, unnest([s.n::DOUBLE, c.n - s.n]) AS n, unnest([s.pos::DOUBLE, c.pos - s.pos]) AS pos,
           c.n / (2 * c.pos) AS w1, c.n / (2 * (c.n - c.pos)) AS w0
    FROM (SELECT f, x, n, pos FROM splits) s, classes c WHERE s.n < c.n),
weighed AS (SELECT *, pos * w1 AS a, (n - pos) * w0 AS b FROM sides),
best AS (SELECT f, x FROM weighed GROUP BY f, x ORDER BY sum((a * a + b * b) / (a + b)) DESC, f, x LIMIT 1)
SELECT round(a / (a + b), 9) AS p, n::BIGINT AS n, pos::BIGINT AS returned FROM weighed JOIN best USING (f, x)"""


def logistic_optimum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A logistic regression without penalty is at its optimum where the residuals
    of label and chance add up to nothing, by themselves and times each feature."""
    items = returned_items(spark, sf_dir)
    params = {"family": "logistic", "regParam": 0.0, "maxIter": 200, "tol": 1e-9}
    scored = score(items, fit(items, LINEITEM, params))
    residual = F.col("returned") - F.col("p")
    features = {
        "one": F.lit(1.0), "l_quantity": F.col("l_quantity") / 50, "l_discount": F.col("l_discount") * 10,
        "l_tax": F.col("l_tax") * 12, "open": (F.col("l_linestatus") == "O").cast("double"),
    }
    sums = [F.struct(F.lit(k).alias("feature"), F.avg(residual * x).alias("slope")) for k, x in features.items()]
    rows = scored.agg(F.array(*sums).alias("s"), F.count("*").alias("n"), F.avg("p").alias("mean_p"))
    return rows.select(F.inline("s"), "n", "mean_p").select(
        "feature", "n", F.round("mean_p", 4).alias("mean_p"), (F.abs("slope") < 1e-5).alias("level")
    )


QUERIES["logistic_optimum"] = logistic_optimum
ORACLES["logistic_optimum"] = """
SELECT feature, count(*) AS n, round(avg(CASE WHEN l_returnflag = 'R' THEN 1e0 ELSE 0e0 END), 4) AS mean_p,
       TRUE AS level
FROM lineitem, (SELECT unnest(['one', 'l_quantity', 'l_discount', 'l_tax', 'open']) AS feature)
GROUP BY feature"""


def boosted_held_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3, T7 with boosted trees, in what SQL can tell: which rows are scored, and that
    prediction and chance agree and the chance ranks better than by accident."""
    scored = boosted_scores(spark, sf_dir)
    ranked = auc(scored.withColumn("model", F.lit("m")), ["model"], "p", "bad").first()
    return scored.select(
        "doc_id",
        "bad",
        ((F.col("prediction") == 1) == (F.col("p") > 0.5)).alias("agree"),
        F.lit(ranked.auc is None or ranked.auc > 0.6).alias("ranks"),
    )


QUERIES["boosted_held_out"] = boosted_held_out
ORACLES["boosted_held_out"] = f"""
SELECT doc_id, CASE WHEN quality = 0 THEN 1 ELSE 0 END AS bad, TRUE AS agree, TRUE AS ranks
FROM documents JOIN labels USING (doc_id) WHERE {percent_sql("doc_id")} >= 60"""


def logistic_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4 over two parameters of a logistic regression; no SQL equivalent."""
    spec = documents_spec(tuple(DOCUMENTS.numeric), categorical=("lang",), scale=True)
    df = class_weights(with_label(labelled_documents(spark, sf_dir), spec), "bad")
    grid = {"family": "logistic", "regParam": [0.001, 0.1], "elasticNetParam": [0.0, 0.5]}
    grid["maxIter"] = [20]
    _, _, found = search(df, spec, grid, weight="weight")
    return found.select(
        "setting",
        F.col("params")["regParam"].alias("reg"),
        F.col("params")["elasticNetParam"].alias("elastic_net"),
        "metric",
        "folds",
    )


QUERIES["logistic_search"] = logistic_search

_LOADED = date(2024, 1, 2)


def retrain_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned documents in two loads, English ones in the second;
    a model trained on the second, and the run as logged."""
    documents = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    day = F.when(F.col("lang") == "en", F.lit(_LOADED)).otherwise(F.lit(date(2024, 1, 1)))
    clean_path, runs_path, models = (scratch(spark, n) for n in ("clean", "runs", "models"))
    loaded = documents.withColumns({"_status": F.lit("kept"), "load_date": day})
    write_clean(loaded, clean_path, ["_status", "load_date"])
    retrain(
        spark,
        DOCUMENTS,
        _LOADED,
        clean_path=clean_path,
        runs_path=runs_path,
        model_root=models,
        grid={"family": "bayes", "smoothing": [1.0, 100.0]},
        labels=table(spark, sf_dir, "labels").select("doc_id", "quality"),
    )
    run = read_log(spark, runs_path, RUNS)
    logged = F.col("metrics")
    return run.select(
        "model_name",
        F.col("params")["smoothing"].cast("double").alias("smoothing"),
        F.round(logged["search_auc"], 6).alias("search_auc"),
        *[F.round(logged[c], 6).alias(c) for c in ("n", "tp", "fp", "fn", "tn", *_MEASURES)],
    )


def _retrain_sql() -> str:
    source = "(SELECT * FROM documents JOIN labels USING (doc_id) WHERE lang = 'en')"
    features = documents_sql(DOCUMENTS, source)
    grid = _grid_sql(features, 5, [1.0, 100.0], rows="percent < 80")
    final = ",".join(
        bayes_sql(features, 5, f"{s!r}::DOUBLE", "percent < 80", "percent >= 80", name=f"f{i}")
        for i, s in enumerate([1.0, 100.0])
    )
    return f"""
WITH {grid}, {final},
best AS (SELECT * FROM grid ORDER BY metric DESC, setting LIMIT 1),
held AS (SELECT 0 AS setting, y, p FROM f0_scored UNION ALL SELECT 1, y, p FROM f1_scored),
measured AS ({_metrics_sql("held", "setting")})
SELECT 'documents' AS model_name, smoothing, metric AS search_auc, n::DOUBLE AS n,
       tp::DOUBLE AS tp, fp::DOUBLE AS fp, fn::DOUBLE AS fn, tn::DOUBLE AS tn,
       precision, recall, f1, auc
FROM best JOIN measured USING (setting)"""


QUERIES["retrain_since"] = retrain_since
ORACLES["retrain_since"] = _retrain_sql()
