"""Student's t distribution as a column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Below this |t| the finite series is subtracted from one; above it that would
# cancel, so the remaining terms of the same series are summed instead.
_TAIL_FROM = 2.0


def _series(x: Column, first: Column, last: Column) -> Column:
    """sum of c_k for k in first..last, c_0 = 1, c_k = c_(k-1) * (2k-1)/(2k) * x."""
    start = F.struct(
        F.lit(1.0).alias("c"),
        F.when(first == 0, F.lit(1.0)).otherwise(F.lit(0.0)).alias("total"),
    )

    def step(acc: Column, k: Column) -> Column:
        c = acc["c"] * (2.0 * k - 1.0) / (2.0 * k) * x
        return F.struct(
            c.alias("c"),
            (acc["total"] + F.when(k >= first, c).otherwise(F.lit(0.0))).alias("total"),
        )

    # sequence() would count down from 1 to 0, so an empty run needs its own case
    ks = F.when(last >= 1, F.sequence(F.lit(1).cast("long"), last.cast("long"))).otherwise(
        F.array().cast("array<bigint>")
    )
    return F.aggregate(ks, start, step, lambda acc: acc["total"])


def two_sided_p(t: Column, df: Column) -> Column:
    """P(|T| >= |t|) for an even number of degrees of freedom; null if t is null.

    Abramowitz and Stegun 26.7.4. Two samples of one size always give an even df.
    """
    size = F.abs(t.cast("double"))
    theta = F.atan(size / F.sqrt(df.cast("double")))
    x = F.pow(F.cos(theta), 2)
    half = (df / 2).cast("long")
    near = F.lit(1.0) - F.sin(theta) * _series(x, F.lit(0).cast("long"), half - 1)
    far = F.sin(theta) * _series(x, half, half + 10 * df.cast("long") + 200)
    return F.when((df % 2 == 0) & (df > 0), F.when(size < _TAIL_FROM, near).otherwise(far))
