"""Labels, feature stages, repeatable splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import (
    Bucketizer,
    OneHotEncoder,
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import hash_percent
from ..spec import DatasetSpec


def attach_labels(df: DataFrame, labels: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Inner join on the key; the join strategy is left to adaptive execution."""
    return df.join(labels, key, "inner")


def with_label(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    return df.withColumn(spec.label, F.expr(spec.label_expr)) if spec.label_expr else df


def bucket_sql(column: str, buckets: int) -> str:
    """The place of a value among ``buckets``, from a hash of column name and value; null
    is a value."""
    text = f"coalesce(concat('{column}=', cast({column} AS string)), '{column}')"
    return f"cast(pmod(cast(conv(substr(md5({text}), 1, 8), 16, 10) AS bigint), {buckets}) AS double)"


def feature_stages(spec: DatasetSpec) -> list:
    """The spec's columns to one ``features`` vector, one-hot columns first.

    Derived columns are a stage as well, so a saved model scores raw rows. A
    category not seen in training becomes all zeros. The values of a hashed column,
    however many, share a fixed number of features: none is indexed or reaches the
    driver, and one not seen in training has its feature like any other.
    """
    stages: list = []
    inputs: list[str] = []
    if spec.derived:
        exprs = ", ".join(f"{sql} AS {name}" for name, sql in spec.derived.items())
        stages.append(SQLTransformer(statement=f"SELECT *, {exprs} FROM __THIS__"))
    if spec.categorical:
        indexed = [f"{c}_index" for c in spec.categorical]
        onehot = [f"{c}_onehot" for c in spec.categorical]
        stages.append(
            StringIndexer(
                inputCols=list(spec.categorical), outputCols=indexed, handleInvalid="keep"
            )
        )
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=onehot))
        inputs += onehot
    if spec.hashed:
        buckets = ", ".join(f"{bucket_sql(c, spec.hash_buckets)} AS {c}_hash" for c in spec.hashed)
        stages.append(SQLTransformer(statement=f"SELECT *, {buckets} FROM __THIS__"))
        hashes, places, onehot = ([f"{c}_{x}" for c in spec.hashed] for x in ("hash", "place", "hashed"))
        # bounds that say how many places there are, so that no pass over the rows has to
        bounds = [float(i) for i in range(spec.hash_buckets + 1)]
        stages.append(Bucketizer(splitsArray=[bounds] * len(hashes), inputCols=hashes, outputCols=places))
        stages.append(OneHotEncoder(inputCols=places, outputCols=onehot, dropLast=False))
        inputs += onehot
    inputs += spec.numeric
    assembled = "raw_features" if spec.scale else "features"
    stages.append(VectorAssembler(inputCols=inputs, outputCol=assembled))
    if spec.scale:
        stages.append(StandardScaler(inputCol=assembled, outputCol="features"))
    return stages


def check_categories(df: DataFrame, spec: DatasetSpec) -> None:
    """Indexing brings a column's values to the driver; refuse columns with too many, by an
    approximate count. Such a column belongs in the spec's ``hashed``."""
    if not spec.categorical:
        return
    counts = df.agg(*[F.approx_count_distinct(c).alias(c) for c in spec.categorical]).first()
    wide = {c: n for c, n in counts.asDict().items() if n > spec.max_categories}
    if wide:
        raise ValueError(f"more than {spec.max_categories} categories in {wide}")


def split(df: DataFrame, key: Sequence[str], shares: Mapping[str, int]) -> DataFrame:
    """A ``part`` column by key hash; ``shares`` are whole percents adding up to 100.

    Rows with one key fall in one part, and stay there in every later run.
    """
    if sum(shares.values()) != 100:
        raise ValueError("shares must add up to 100")
    percent = hash_percent(key, word=0)
    names = list(shares)
    bound = shares[names[0]]
    part: Column = F.when(percent < bound, names[0])
    for name in names[1:-1]:
        bound += shares[name]
        part = part.when(percent < bound, name)
    part = part.otherwise(names[-1]) if len(names) > 1 else F.lit(names[0])
    return df.withColumn("part", part)


def folds(df: DataFrame, key: Sequence[str], n: int) -> DataFrame:
    """A ``fold`` column 0..n-1, independent of ``part``."""
    return df.withColumn("fold", hash_percent(key, word=1, buckets=n))


def class_weights(df: DataFrame, label: str, into: str = "weight") -> DataFrame:
    """Weight n / (2 * n_class), which gives both classes one total.

    The two counts come to the driver and go back as literals.
    """
    count = df.agg(F.count(label).alias("n"), F.sum(label).alias("pos")).first()
    n, pos = count.n, count.pos or 0
    if not 0 < pos < n:
        raise ValueError("both classes are needed")
    weight = F.when(F.col(label) == 1, n / (2.0 * pos)).otherwise(n / (2.0 * (n - pos)))
    return df.withColumn(into, weight)
