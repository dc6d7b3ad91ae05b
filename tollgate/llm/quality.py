"""Quality classifier: regularised quadratic discriminant analysis of document statistics.

Every text gives a vector of transformed statistics. For each class Spark sums, over
the labelled rows, the count, the vectors and their outer products; from these few
numbers come means and covariances. A covariance is shrunk towards the pooled one and
then towards its own diagonal mean, so that a class of few or equal rows still has an
invertible one, and its Cholesky factor is kept. A score is the logistic function of
the difference of the two log densities (Mahalanobis distance and log determinant)
plus the log prior odds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.session import stored

from .text import SPACES, Hasher, hashed, rows_of, slices

#: Labelled rows of each class used at most, on average: chosen by a hash of doc_id.
MOST_ROWS = 100_000
#: Weight of the pooled covariance, then of a scaled identity matrix.
POOLED, IDENTITY = 0.1, 0.02
STATISTICS = [
    "log_bytes", "log_words", "word_length", "upper", "digits", "marks", "full_stops", "lines",
    "distinct_words", "top_word", "repeated_next", "distinct_pairs", "high_bytes", "entropy",
    "end_marks",
]
D = len(STATISTICS)

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_MARK = np.zeros(256, bool)
_MARK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_MARK[[44, 46]] = False  # comma and full stop are prose
_HASH = Hasher(8)


def _logit(x: float) -> float:
    return float(np.log((x + 0.002) / (1.002 - x)))


def statistics(rows: list[bytes]) -> np.ndarray:
    """One vector a row, from the whole text; a text without words gives its bytes' ones."""
    out = np.zeros((len(rows), D))
    for first, (words,), offsets in hashed(rows, [_HASH], SPACES):
        for k in range(len(offsets) - 1):
            out[first + k] = _of_text(rows[first + k], words[offsets[k] : offsets[k + 1]])
    return out


def _of_text(text: bytes, words: np.ndarray) -> np.ndarray:
    seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    size, n = max(1, len(text)), len(words)
    letters = max(1, size - int(seen[SPACES].sum()))
    counts = np.unique(words, return_counts=True)[1] if n else np.ones(1, np.int64)
    pairs = len(np.unique(words[1:] * np.uint64(31) + words[:-1])) if n > 1 else 1
    share = counts / counts.sum()
    spread = float(-(share * np.log(share)).sum() / np.log(max(2, n)))
    return np.array(
        [
            np.log1p(len(text)), np.log1p(n), np.log1p(letters / max(1, n)),
            _logit(seen[_UPPER].sum() / letters), _logit(seen[_DIGIT].sum() / letters),
            _logit(seen[_MARK].sum() / letters), _logit(min(1.0, seen[46] / max(1, n))),
            _logit(min(1.0, seen[10] / max(1, n))), _logit(len(counts) / max(1, n) if n else 1.0),
            _logit(float(share.max())) if n > 1 else 0.0,
            _logit(float((words[1:] == words[:-1]).mean()) if n > 1 else 0.0),
            _logit(pairs / max(1, n - 1)), _logit(seen[128:].sum() / size), spread,
            _logit(min(1.0, (seen[33] + seen[124]) / max(1, n))),
        ]
    )


@dataclass
class Model:
    """Means, Cholesky factors and log determinants of the classes 0 and 1."""

    means: np.ndarray
    factors: np.ndarray
    logdets: np.ndarray
    prior: float  # log odds of class 1

    def scores(self, x: np.ndarray) -> np.ndarray:
        dens = []
        for mean, factor, logdet in zip(self.means, self.factors, self.logdets, strict=True):
            z = np.linalg.solve(factor, (x - mean).T)
            dens.append(-0.5 * ((z * z).sum(axis=0) + logdet))
        return 1 / (1 + np.exp(-np.clip(dens[1] - dens[0] + self.prior, -40, 40)))


def model_of(sums: dict[int, tuple[float, np.ndarray, np.ndarray]]) -> Model:
    """From each class's count, sum and sum of outer products, summed over all rows."""
    n = {c: max(sums[c][0], 1e-9) for c in (0, 1)}
    means = {c: sums[c][1] / n[c] for c in (0, 1)}
    scatter = {c: sums[c][2] - n[c] * np.outer(means[c], means[c]) for c in (0, 1)}
    pooled = (scatter[0] + scatter[1]) / max(n[0] + n[1] - 2, 1)
    factors, logdets = [], []
    for c in (0, 1):
        own = scatter[c] / max(n[c] - 1, 1)
        held = POOLED + (1 - POOLED) * D / (D + n[c])  # few rows lean on the pooled one
        cov = (1 - held) * own + held * pooled
        cov = (1 - IDENTITY) * cov + IDENTITY * (np.trace(cov) / D + 1e-6) * np.eye(D)
        factors.append(np.linalg.cholesky(cov))
        logdets.append(2 * np.log(np.diag(factors[-1])).sum())
    prior = float(np.log((sums[1][0] + 1) / (sums[0][0] + 1)))
    return Model(np.array([means[0], means[1]]), np.array(factors), np.array(logdets), prior)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and ``stats`` of every row of ``docs``, stored: texts are read once and never
    shuffled."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            got = pa.array(list(statistics(rows_of(batch.column("text")))), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), got], ["doc_id", "stats"])

    schema = T.StructType([docs.schema["doc_id"], T.StructField("stats", T.ArrayType(T.DoubleType()))])
    return stored(docs.select("doc_id", "text").mapInArrow(measure, schema), "quality-stats")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, D)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((2, 1 + D + D * D))
    for batch in slices(batches):
        x = _matrix(batch.column("stats"))
        y, w = np.array(batch.column("label")), np.array(batch.column("weight"))
        for c in (0, 1):
            z, v = x[y == c], w[y == c]
            total[c] += np.concatenate([[v.sum()], v @ z, ((z * v[:, None]).T @ z).ravel()])
    yield pa.RecordBatch.from_pydict({"sums": [total.ravel().tolist()]})


def train(stats: DataFrame, labels: DataFrame) -> Model:
    """Fit on the rows of ``stats`` (doc_id, stats) that ``labels`` (doc_id, quality) covers.

    Labels other than 0 and 1 are left out. A class of more than MOST_ROWS rows is
    sampled by a hash of doc_id, and weighed by the inverse of its share.
    """
    named = labels.where("quality IN (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("label"))
    n = {r[0]: r[1] for r in named.groupBy("label").count().collect()}
    share = {c: min(1.0, MOST_ROWS / n[c]) if n.get(c) else 1.0 for c in (0, 1)}
    kept = F.when(F.col("label") == 1, F.lit(share[1])).otherwise(F.lit(share[0]))
    chosen = named.where(F.pmod(F.xxhash64(F.lit(8), "doc_id"), F.lit(1 << 30)) < kept * (1 << 30))
    rows = stats.join(chosen.withColumn("weight", 1 / kept), "doc_id")
    parts = rows.select("stats", F.col("label").cast("int").alias("label"), "weight").mapInArrow(
        _sums, "sums array<double>"
    )
    summed = (
        parts.select(F.posexplode("sums").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x"))
    ).collect()
    total = np.zeros(2 * (1 + D + D * D))
    for r in summed:
        total[r["at"]] = r["x"]
    total = total.reshape(2, -1)
    return model_of(
        {c: (total[c, 0], total[c, 1 : 1 + D], total[c, 1 + D :].reshape(D, D)) for c in (0, 1)}
    )


def rated(stats: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of each row of ``stats``."""

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            got = pa.array(model.scores(_matrix(batch.column("stats"))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), got], ["doc_id", "score"])

    schema = T.StructType([stats.schema["doc_id"], T.StructField("score", T.DoubleType())])
    return stats.mapInArrow(rate, schema)


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with a column ``name``: how likely label 1 is. A column of that name is replaced.

    A null text scores as an empty one; equal texts score alike; no rows give no rows.
    """
    docs = docs.drop(name)
    names = [*docs.columns, name]
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            got = model.scores(statistics(rows_of(batch.column("text"))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got)], names)

    return docs.mapInArrow(scored, schema)


def accepted(docs: DataFrame, model: Model, least: float) -> DataFrame:
    """The rows of ``docs`` that score ``least`` or more."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            got = model.scores(statistics(rows_of(batch.column("text"))))
            yield batch.filter(pa.array(got >= least))

    return docs.mapInArrow(keep, docs.schema)


def remainder(divisor: int):
    """crc32 of doc_id as text, modulo ``divisor``."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(divisor))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(remainder(3) != 1)
    stats = measured(docs)
    return rated(stats, train(stats, labels)).select(
        "doc_id", (remainder(3) == 1).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


QUERIES = {"op8_quality": op8_quality}
ORACLES: dict[str, str] = {}

