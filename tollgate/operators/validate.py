"""V1-V5: bootstrap distribution of a metric, t-test and promotion gate.

Scored rows are ``(model, key..., label, p)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import hash_word, poisson_one, two_sided_p
from ..functions.hashing import WORDS_PER_HASH, joined_key
from ..session import shuffle_width
from .metrics import (
    RANGE,
    SALT,
    ScoreCuts,
    auc,
    join_ranges,
    score_cuts,
    usable,
    with_range,
    with_salt,
)

REPLICATES = 100
ALPHA = 0.05
# Replicates whose weights one row holds, a column each; whole hashes.
WIDTH = 5 * WORDS_PER_HASH


def bootstrap(
    scored: DataFrame,
    key: Sequence[str],
    n_rep: int = REPLICATES,
    cuts: ScoreCuts | None = None,
) -> DataFrame:
    """V1: each row once per replicate ``b`` that drew it, with its Poisson(1) weight.

    Weights come from the row's key, so a replicate is the same however the rows
    are spread. This is the sample itself; `bootstrap_metric` takes its metric without
    making it.
    """
    placed, carried = _placed(scored, key, cuts)
    last_block = (n_rep - 1) // WORDS_PER_HASH
    block = F.explode(F.sequence(F.lit(0), F.lit(last_block))).alias("_block")
    hashed = placed.select("*", block).withColumn(
        "_digest", F.md5(F.concat_ws("#", "_ident", F.col("_block").cast("string")))
    )
    words = F.array(
        *[
            F.struct(
                (F.col("_block") * WORDS_PER_HASH + i).alias("b"),
                hash_word(F.col("_digest"), i).alias("_word"),
            )
            for i in range(WORDS_PER_HASH)
        ]
    )
    drawn = hashed.select(*carried, F.inline(words))
    return (
        drawn.withColumn("w", poisson_one(F.col("_word")))
        .filter((F.col("w") > 0) & (F.col("b") < n_rep))
        .drop("_word")
    )


def _placed(
    scored: DataFrame, key: Sequence[str], cuts: ScoreCuts | None
) -> tuple[DataFrame, list[str]]:
    """Rows laid out by model and score range, and the columns that they carry.

    They are shuffled *before* they are multiplied, and V2 needs them nowhere else: the
    shuffle carries n rows, not n * n_rep. Rows that share one frequent score are spread
    by a salt.
    """
    cuts = cuts or score_cuts(scored, "p")
    narrow = with_range(scored.select("model", *key, "label", "p"), "p", cuts)
    carried = ["model", "label", "p", RANGE]
    places = ["model", RANGE]
    width = shuffle_width(scored.sparkSession)
    if cuts.tied:
        narrow = with_salt(narrow, key, cuts, width)
        carried.append(SALT)
        places.append(SALT)
    ident = joined_key("model", *key).alias("_ident")
    return narrow.select(*carried, ident).repartition(width, *places), carried


def bootstrap_metric(
    scored: DataFrame,
    key: Sequence[str],
    n_rep: int = REPLICATES,
    cuts: ScoreCuts | None = None,
) -> DataFrame:
    """V1 and V2 in one: ROC AUC of each replicate, as `replicate_metric` of `bootstrap`.

    A row holds the weights of a block of replicates, a column each, so the rows that
    are sorted are n times the blocks, not n times the replicates drawn. Sums and running
    sums are taken per column, and only totals of ranges are unfolded to replicates.
    """
    placed, _ = _placed(usable(scored, "p"), key, cuts)
    blocks = -(-n_rep // WIDTH)
    block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_block")
    per_block = WIDTH // WORDS_PER_HASH
    digests = [
        F.md5(F.concat_ws("#", "_ident", (F.col("_block") * per_block + d).cast("string"))).alias(f"_d{d}")
        for d in range(per_block)
    ]
    places = ["model", RANGE, *([SALT] if SALT in placed.columns else []), "_block"]
    hashed = placed.select("*", block).select(*places, "label", "p", *digests)
    columns = range(WIDTH)
    weights = {
        f"_w{i}": poisson_one(hash_word(F.col(f"_d{i // WORDS_PER_HASH}"), i % WORDS_PER_HASH)).cast("double")
        for i in columns
    }
    is_pos = F.col("label") == 1
    scores = hashed.select(*places, "label", "p", *[w.alias(name) for name, w in weights.items()])
    scores = scores.groupBy(*places, "p").agg(
        *[F.sum(F.when(is_pos, F.col(w)).otherwise(0.0)).alias(w.replace("_w", "_pos")) for w in weights],
        *[F.sum(F.when(is_pos, 0.0).otherwise(F.col(w))).alias(w.replace("_w", "_neg")) for w in weights],
    )
    lower = Window.partitionBy(*places).orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    below = [F.coalesce(F.sum(f"_neg{i}").over(lower), F.lit(0.0)).alias(f"_below{i}") for i in columns]
    ranked = scores.select("*", *below)

    def pairs(i: int):
        return F.sum(F.col(f"_pos{i}") * (F.col(f"_below{i}") + 0.5 * F.col(f"_neg{i}")))

    drawn = [F.col(f"_pos{i}") + F.col(f"_neg{i}") > 0 for i in columns]
    totals = ranked.groupBy(*places).agg(
        *[
            F.struct(
                F.sum(f"_pos{i}").alias("pos"), F.sum(f"_neg{i}").alias("neg"), pairs(i).alias("pairs"),
                F.min(F.when(drawn[i], F.col("p"))).alias("low"), F.max(F.when(drawn[i], F.col("p"))).alias("high"),
            ).alias(f"_t{i}")
            for i in columns
        ]
    )
    replicate = [
        F.struct((F.col("_block") * WIDTH + i).alias("b"), f"_t{i}.*") for i in columns
    ]
    parts = totals.select(*places, F.inline(F.array(*replicate))).drop("_block")
    parts = parts.filter((F.col("b") < n_rep) & F.col("low").isNotNull())
    found = join_ranges(parts, ["model", "b"])
    value = F.col("pairs") / F.nullif(F.col("pos") * F.col("neg"), F.lit(0.0))
    return found.select("model", "b", value.alias("metric"))


def replicate_metric(boot: DataFrame) -> DataFrame:
    """V2: ROC AUC of each replicate; null for one that drew a single class."""
    return auc(boot, ["model", "b"], "p", "label", "w").withColumnRenamed("auc", "metric")


def common_replicates(replicates: DataFrame) -> DataFrame:
    """Replicates whose metric exists for every model, so that all have one size."""
    models = F.count("metric").over(Window.partitionBy("b"))
    rows = F.count("*").over(Window.partitionBy("b"))
    both = replicates.withColumn("_ok", models == rows)
    return both.filter("_ok").drop("_ok")


def distribution(replicates: DataFrame) -> DataFrame:
    """V3: size, mean, variance and quantiles of the metric per model."""
    q = F.percentile("metric", F.array(F.lit(0.025), F.lit(0.5), F.lit(0.975)))
    return (
        replicates.groupBy("model")
        .agg(
            F.count("metric").alias("n"),
            F.avg("metric").alias("mean"),
            F.var_samp("metric").alias("var"),
            q.alias("q"),
        )
        .select(
            "model",
            "n",
            "mean",
            "var",
            F.col("q")[0].alias("q025"),
            F.col("q")[1].alias("q500"),
            F.col("q")[2].alias("q975"),
        )
    )


def t_test(dist_new: DataFrame, dist_prev: DataFrame) -> DataFrame:
    """V4: two-sample t-test with pooled variance, two-sided; one row.

    Both inputs are one row of V3 with equal ``n``. Without any variance, different
    means give an infinite ``t`` and a ``p`` of 0, equal means null.
    """
    sides = dist_new.withColumn("_new", F.lit(True)).unionByName(
        dist_prev.withColumn("_new", F.lit(False))
    )

    def side(col: str, new: bool):
        return F.max(F.when(F.col("_new") == new, F.col(col)))

    row = sides.agg(
        side("model", True).alias("model_new"),
        side("model", False).alias("model_prev"),
        side("n", True).alias("n_new"),
        side("n", False).alias("n_prev"),
        side("mean", True).alias("mean_new"),
        side("mean", False).alias("mean_prev"),
        side("var", True).alias("var_new"),
        side("var", False).alias("var_prev"),
    )
    free = F.col("n_new") + F.col("n_prev") - 2
    inside = (F.col("n_new") - 1) * F.col("var_new") + (F.col("n_prev") - 1) * F.col("var_prev")
    pooled = inside / F.nullif(free.cast("double"), F.lit(0.0))
    error = F.sqrt(pooled * (1.0 / F.nullif(F.col("n_new").cast("double"), F.lit(0.0))
                             + 1.0 / F.nullif(F.col("n_prev").cast("double"), F.lit(0.0))))
    gap = F.col("mean_new") - F.col("mean_prev")
    certain = (error == 0) & (gap != 0)
    t = gap / F.nullif(error, F.lit(0.0))
    p = two_sided_p(F.col("t"), F.col("df"))
    tested = row.withColumn("df", free).withColumn("t", t).withColumn("p", p)
    endless = F.signum(gap) * F.lit(float("inf"))
    return tested.withColumns(
        {
            "t": F.when(certain, endless).otherwise(F.col("t")),
            "p": F.when(certain, F.lit(0.0)).otherwise(F.col("p")),
        }
    )


def promote(test: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """V5: the test's row if the new model is significantly better, else nothing."""
    return test.filter((F.col("p") < alpha) & (F.col("mean_new") > F.col("mean_prev")))
