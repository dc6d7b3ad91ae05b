"""The jobs one after the other, as a scheduler would call them."""

from datetime import date

from pyspark.sql import functions as F

from tollgate.functions import in_range
from tollgate.operators.registry import champion, read_registry
from tollgate.operators.train import held_out
from tollgate.plans import export_latest, latest, prepare, retrain, validate
from tollgate.sources import load_model
from tollgate.sources.logs import RUNS, read_log
from tollgate.spec import DatasetSpec, Rule, schema_of

SPEC = DatasetSpec(
    name="payments",
    schema=schema_of(id="long", at="timestamp_ntz", amount="double", kind="string"),
    key=("id",),
    event_time="at",
    label="fraud",
    label_expr="CAST(mark = 'yes' AS INT)",
    numeric=("amount",),
    categorical=("kind",),
    required=("id", "at", "amount"),
    rules=(Rule("amount_range", lambda: in_range("amount", 0.0)),),
    partition_cols=("day",),
    partition_exprs={"day": "to_date(at)"},
    delimiter=";",
)


def test_prepare_retrain_validate(spark, path):
    day = F.lit("2024-01-0")
    rows = spark.range(3_000).select(
        "id",
        F.concat(day, (F.col("id") % 3 + 1).cast("string"), F.lit(" 10:00:00")).alias("at"),
        F.round(F.rand(1) * 100 - 2, 2).alias("amount"),
        F.when(F.rand(2) < 0.5, "cash").otherwise("card").alias("kind"),
    )
    rows = rows.persist()
    line = F.concat_ws(";", *[F.col(c).cast("string") for c in rows.columns]).alias("value")
    rows.select(line).write.text(path("raw"))
    risk = F.col("amount") / 100
    labels = rows.select("id", F.when(F.rand(3) < risk, "yes").otherwise("no").alias("mark")).persist()

    report = prepare(spark, SPEC, path("raw"), path("checkpoint"), path("clean"))
    counts = {r.rule: r.n for r in report.collect()}
    assert counts["rows_in"] == 3_000 == counts["rows_kept"] + counts["rows_rejected"]
    assert counts["amount_range"] == counts["rows_rejected"] > 0

    # the same transactions arrive again
    rows.select(line).write.mode("append").text(path("raw"))
    prepare(spark, SPEC, path("raw"), path("checkpoint"), path("clean"))
    since = date(2024, 1, 1)
    export_latest(spark, SPEC, path("clean"), path("latest"), since)
    table = latest(spark, SPEC, path("latest"))
    assert table.count() == counts["rows_kept"]
    assert table.select("day").distinct().count() == 3

    # a late transaction replaces no other one of its day
    late = spark.createDataFrame([("9999;2024-01-02 23:00:00;1.0;card",)], "value string")
    late.write.mode("append").text(path("raw"))
    prepare(spark, SPEC, path("raw"), path("checkpoint"), path("clean"))
    export_latest(spark, SPEC, path("clean"), path("latest"), since)
    assert latest(spark, SPEC, path("latest")).count() == counts["rows_kept"] + 1

    def train(grid, **options):
        return retrain(
            spark, SPEC, since, clean_path=path("clean"), runs_path=path("runs"),
            model_root=path("models"), grid=grid, labels=labels, **options,
        )

    # a tree without a split gives every row one score
    weak = train({"family": "forest", "maxDepth": [0], "numTrees": [1]})
    good = train({"family": "logistic", "maxIter": [10], "regParam": [0.0, 0.1]}, weight="w")
    assert read_log(spark, path("runs"), RUNS).count() == 2
    assert good["metrics"]["auc"] > weak["metrics"]["auc"]

    held = held_out(spark, SPEC, path("clean"), since, labels=labels)
    assert 0 < held.count() == held.select("id").distinct().count() < counts["rows_kept"] / 3

    def check(run):
        model = load_model(run["model_uri"])
        return validate(spark, SPEC, held, model, run["model_uri"], path("registry"), n_rep=20)

    assert check(weak), "a first model is registered"
    assert check(good), "a better one too"
    assert not check(weak), "a worse one is not"
    last = champion(read_registry(spark, path("registry")), SPEC.name).first()
    assert last.version == 2 and last.model_uri == good["model_uri"] and last.p_value < 0.05
