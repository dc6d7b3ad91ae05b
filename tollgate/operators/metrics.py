"""Exact classification metrics for any number of rows.

ROC AUC needs the negatives below each positive, a ranking over all rows. The
rows are cut into score ranges of about equal size; rows are ranked inside their
range, and ranges are ranked by their totals. No task ever holds a whole group,
and the result does not depend on where the cuts are.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shuffle_width

RANGE = "_range"
SALT = "_salt"
MAX_RANGES = 8_192


@dataclass(frozen=True)
class ScoreCuts:
    """Bounds of the score ranges, and which ranges hold one frequent score only,
    with the share of all rows that have it."""

    splits: tuple[float, ...]
    tied: dict[int, float]


def score_cuts(df: DataFrame, score: str, ranges: int | None = None) -> ScoreCuts:
    """Approximate quantiles of the score; at most MAX_RANGES numbers reach the driver.

    A quantile that comes up twice is a score shared by many rows. It gets a range
    of its own, which needs no ranking inside.
    """
    n = ranges or min(8 * shuffle_width(df.sparkSession), MAX_RANGES)
    probabilities = [i / n for i in range(n + 1)]
    found = df.stat.approxQuantile(score, probabilities, 1.0 / (4 * n))
    shares = {score: times / n for score, times in Counter(found).items() if times > 1}
    bounds = set(found) | {math.nextafter(f, math.inf) for f in shares}
    splits = (-math.inf, *sorted(b for b in bounds if math.isfinite(b)), math.inf)
    at = {bound: i for i, bound in enumerate(splits)}
    return ScoreCuts(splits, {at[f]: share for f, share in shares.items()})


def with_salt(df: DataFrame, keys: Sequence[str], cuts: ScoreCuts, width: int) -> DataFrame:
    """Spread a tied range over as many of ``width`` partitions as its share of rows asks for."""
    salts = [
        max(1, math.ceil(cuts.tied.get(i, 0.0) * width)) for i in range(len(cuts.splits) - 1)
    ]
    # One text literal, since every element of an array literal is a call to the JVM.
    per_range = F.split(F.lit(",".join(map(str, salts))), ",").cast("array<int>")
    salt = F.pmod(F.xxhash64(*keys), F.get(per_range, F.col(RANGE)))
    return df.withColumn(SALT, salt.cast("int"))


def with_range(df: DataFrame, score: str, cuts: ScoreCuts) -> DataFrame:
    if len(cuts.splits) < 3:
        return df.withColumn(RANGE, F.lit(0))
    ranged = Bucketizer(splits=list(cuts.splits), inputCol=score, outputCol=RANGE).transform(df)
    return ranged.withColumn(RANGE, F.col(RANGE).cast("int"))


def _total(c: str) -> Column:
    return F.sum(c).alias(c)


def rank_totals(
    df: DataFrame,
    by: Sequence[str],
    score: str,
    label: str,
    weight: str | None,
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """Per group: weighted positives, negatives, and positive-negative pairs in order.

    A pair with equal scores counts half. ``df`` has a range column; with a salt
    column, rows that share a range, salt and group must already lie in one
    partition, and then nothing but range totals is shuffled. ``extra`` are sums
    over distinct scores of expressions in ``pos``, ``neg`` and the score.
    """
    by, extra = list(by), extra or {}
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    is_pos = F.col(label) == 1
    cell = [*by, RANGE, *([SALT] if SALT in df.columns else [])]
    scores = df.groupBy(*cell, score).agg(
        F.sum(F.when(is_pos, w).otherwise(0.0)).alias("pos"),
        F.sum(F.when(is_pos, 0.0).otherwise(w)).alias("neg"),
    )
    lower = Window.partitionBy(*cell).orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("neg").over(lower), F.lit(0.0))
    parts = (
        scores.withColumn("below", below)
        .groupBy(*cell)
        .agg(
            F.sum(F.col("pos") * (F.col("below") + 0.5 * F.col("neg"))).alias("pairs"),
            F.min(score).alias("low"),
            F.max(score).alias("high"),
            *[F.sum(e).alias(name) for name, e in extra.items()],
            _total("pos"),
            _total("neg"),
        )
    )
    return join_ranges(parts, by, list(extra))


def join_ranges(parts: DataFrame, by: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """Totals of each group from those of its ranges: ``pos``, ``neg``, ``pairs`` inside the
    range, its lowest and highest score, and ``extra`` sums."""
    by, ranges = list(by), parts
    if SALT in parts.columns:
        ranges = parts.groupBy(*by, RANGE).agg(
            _total("pos"),
            _total("neg"),
            _total("pairs"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            *[_total(name) for name in extra],
        )
    one_score = F.col("low") == F.col("high")
    pairs = F.when(one_score, 0.5 * F.col("pos") * F.col("neg")).otherwise(F.col("pairs"))
    lower = Window.partitionBy(*by).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("neg").over(lower), F.lit(0.0))
    return (
        ranges.withColumns({"pairs": pairs, "below": below})
        .groupBy(*by)
        .agg(
            F.sum(F.col("pairs") + F.col("pos") * F.col("below")).alias("pairs"),
            *[_total(name) for name in extra],
            _total("pos"),
            _total("neg"),
        )
    )


def _ratio(top: Column, bottom: Column) -> Column:
    return top / F.nullif(bottom, F.lit(0.0))


def usable(df: DataFrame, score: str) -> DataFrame:
    return df.filter(F.col(score).isNotNull() & ~F.isnan(score))


def auc(
    df: DataFrame,
    by: Sequence[str],
    score: str = "p",
    label: str = "label",
    weight: str | None = None,
    cuts: ScoreCuts | None = None,
) -> DataFrame:
    """Exact ROC AUC per group; null where a class is missing.

    A row whose score is null or NaN has no rank and is left out.
    """
    if RANGE not in df.columns:
        df = with_range(usable(df, score), score, cuts or score_cuts(df, score))
    totals = rank_totals(df, by, score, label, weight)
    value = _ratio(F.col("pairs"), F.col("pos") * F.col("neg"))
    return totals.select(*by, value.alias("auc"))


def metrics(
    scored: DataFrame,
    by: Sequence[str] = ("model",),
    score: str = "p",
    label: str = "label",
    threshold: float = 0.5,
    cuts: ScoreCuts | None = None,
) -> DataFrame:
    """T5: confusion counts, precision, recall, F1 and ROC AUC per group, in one pass.

    A row is predicted positive if its score is above the threshold. A measure
    without a denominator is null. Rows whose score is null or NaN are left out.
    """
    scored = usable(scored, score)
    cuts = cuts or score_cuts(scored, score)
    above = F.col(score) > threshold
    hits = {
        "tp": F.when(above, F.col("pos")).otherwise(0.0),
        "fp": F.when(above, F.col("neg")).otherwise(0.0),
    }
    t = rank_totals(with_range(scored, score, cuts), by, score, label, None, extra=hits)
    tp, fp, pos, neg = (F.col(c) for c in ("tp", "fp", "pos", "neg"))
    return t.select(
        *by,
        (pos + neg).cast("long").alias("n"),
        tp.cast("long").alias("tp"),
        fp.cast("long").alias("fp"),
        (pos - tp).cast("long").alias("fn"),
        (neg - fp).cast("long").alias("tn"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, pos).alias("recall"),
        _ratio(2.0 * tp, pos + tp + fp).alias("f1"),
        _ratio(F.col("pairs"), pos * neg).alias("auc"),
    )
