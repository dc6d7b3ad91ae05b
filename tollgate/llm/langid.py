"""Language identification with error-correcting output codes.

Each language has a codeword; one binary classifier over hashed byte n-grams (1 to 3)
predicts each of its bits. The classifiers are naive Bayes: their weights are log
ratios of the n-gram frequencies of the languages with that bit and without it, taken
from counts that Spark sums per language. A text's margins, averaged over its
n-grams, are decoded by loss: every codeword's loss is the weighted sum of the bits'
logistic losses, weighted by how well the bit separated its languages, and the
codeword of least loss wins. A text whose second-best codeword is nearly as good is
flagged as ambiguous.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .quality import remainder
from .text import rows_of, slices

#: Hashed n-grams.
BUCKETS = 1 << 13
#: Texts of each language that are learned from, on average: chosen by a hash of doc_id.
MOST_ROWS = 20_000
#: A language's name reaches the driver; there may not be more of them.
MOST_LANGUAGES = 10_000
#: A text is ambiguous if the two best languages' losses differ by less than this share.
AMBIGUOUS = 0.05
#: Margins per n-gram are multiplied by this before the logistic loss.
SHARPNESS = 8.0
UNKNOWN = "und"

_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32
_MULTIPLIER = np.uint32(2654435761)


def grams(text: bytes) -> np.ndarray:
    """The buckets of a text's 1-, 2- and 3-grams of lower-cased bytes."""
    x = _LOWER[np.frombuffer(text, np.uint8)]
    two = x[:-1] << np.uint32(8) | x[1:]
    three = two[:-1] << np.uint32(8) | x[2:]
    shift = np.uint32(32 - (BUCKETS - 1).bit_length())
    parts = [x + np.uint32(1 << 25), two + np.uint32(1 << 26), three]
    return np.concatenate([(p * _MULTIPLIER) >> shift for p in parts])


def counts_of(rows: list[bytes]) -> np.ndarray:
    out = np.zeros((len(rows), BUCKETS), dtype=np.float32)
    for i, row in enumerate(rows):
        # whole texts, in pieces that bound memory; a piece keeps the two bytes before it
        for at in range(0, len(row), 1 << 22):
            out[i] += np.bincount(grams(row[max(0, at - 2) : at + (1 << 22)]), minlength=BUCKETS)
    return out


def codewords(n: int, seed: int = 3) -> np.ndarray:
    """One row of -1 and 1 for each of n languages.

    Up to five languages have the exhaustive code of 2^(n-1) - 1 bits; more have random
    codes of 10 log2 n bits, the one of the largest least distance out of 200.
    """
    if n <= 1:
        return np.ones((n, 1), dtype=np.int8)
    if n <= 5:
        bits = [x for x in itertools.product((1, -1), repeat=n) if x[0] == 1 and len(set(x)) == 2]
        return np.array(bits, dtype=np.int8).T
    rng, best, apart = np.random.default_rng(seed), None, -1
    for _ in range(200 if n <= 500 else 5):
        code = rng.choice(np.array([-1, 1], np.int8), (n, int(np.ceil(10 * np.log2(n)))))
        code = code[:, np.abs(code.sum(axis=0)) < n]
        near = (code.shape[1] - code.astype(np.int32) @ code.T) // 2
        least = int((near + np.eye(n, dtype=np.int64) * code.shape[1]).min())
        if least > apart:
            best, apart = code, least
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # buckets x bits
    trust: np.ndarray  # bits

    def decode(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language number, score and ambiguity of each row of n-gram counts."""
        total = np.maximum(counts.sum(axis=1, keepdims=True), 1)
        margins = SHARPNESS * (counts @ self.weights) / total
        losses = np.logaddexp(0, -margins[:, None, :] * self.code[None, :, :]) @ self.trust
        best = losses.argmin(axis=1)
        low = losses.min(axis=1)
        odds = np.exp(-(losses - low[:, None]) * len(self.trust))
        if len(self.languages) == 1:
            return best, np.ones(len(best)), np.zeros(len(best), bool)
        second = np.partition(losses, 1, axis=1)[:, 1]
        return best, 1 / odds.sum(axis=1), second - low < AMBIGUOUS * second


def model_of(languages: list[str], counts: np.ndarray) -> Model:
    """From the n-gram counts of each language, summed over its texts."""
    code = codewords(len(languages))
    share = (counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True)
    weights = np.zeros((BUCKETS, code.shape[1]))
    trust = np.ones(code.shape[1])
    for b in range(code.shape[1]):
        one, other = share[code[:, b] == 1], share[code[:, b] == -1]
        if len(one) and len(other):
            weights[:, b] = np.log(one.mean(axis=0) / other.mean(axis=0))
            # the least margin of any language on its own side, as a share of the mean one
            mean = (share @ weights[:, b]) * code[:, b]
            trust[b] = max(mean.min(), 0.05 * mean.mean())
    return Model(languages, code, weights.astype(np.float32), trust / trust.sum())


def train(docs: DataFrame) -> Model:
    """Fit on the rows of ``docs`` (doc_id, text, lang) that have a text and a language.

    Languages of more than MOST_ROWS rows are sampled by a hash of doc_id.
    """
    docs = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", "lang")
    found = docs.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    names = sorted(r["lang"] for r in found)
    if not names:
        return Model([], np.zeros((0, 1), np.int8), np.zeros((BUCKETS, 1), np.float32), np.ones(1))
    # at most MOST_LANGUAGES rows, so no text is shuffled to meet them
    rows = docs.sparkSession.createDataFrame(
        [(r["lang"], min(1.0, MOST_ROWS / r["count"])) for r in found], "lang string, kept double"
    )
    place = F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(1 << 30))
    chosen = docs.join(F.broadcast(rows), "lang").where(place < F.col("kept") * (1 << 30)).select("text", "lang")

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[str, np.ndarray] = {}
        for batch in slices(batches):
            langs, texts = batch.column("lang").to_pylist(), rows_of(batch.column("text"))
            for lang, text in zip(langs, texts, strict=True):
                if lang not in got:
                    got[lang] = np.zeros(BUCKETS, dtype=np.int64)
                got[lang] += counts_of([text])[0].astype(np.int64)
        for lang, x in got.items():
            at = np.flatnonzero(x)
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(at), "bucket": at, "n": x[at]})

    table = (
        chosen.mapInArrow(summed, "lang string, bucket long, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .groupBy("lang")
        .agg(F.collect_list(F.struct("bucket", "n")).alias("x"))
    )
    counts = np.zeros((len(names), BUCKETS))
    for r in table.toLocalIterator():
        counts[names.index(r["lang"]), [x["bucket"] for x in r["x"]]] = [x["n"] for x in r["x"]]
    return model_of(names, counts)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1) and ambiguous; such columns are replaced.

    A null text, and one without a letter, is ``und`` with score 0 and ambiguous, as is
    every text if no language was learned. Equal texts get equal answers.
    """
    docs = docs.drop("lang_pred", "score", "ambiguous")
    columns = docs.columns
    schema = T.StructType(
        [
            *docs.schema.fields, T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType()),
        ]
    )
    lettered = docs.withColumn("__letter", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            letter = batch.column("__letter").to_pylist()
            rows = rows_of(batch.column("text"))
            names, scores, flags = [], [], []
            for at in range(0, len(rows), 64):
                if model.languages:
                    best, score, flag = model.decode(counts_of(rows[at : at + 64]))
                for k, known in enumerate(letter[at : at + 64]):
                    known = known and bool(model.languages)
                    names.append(model.languages[best[k]] if known else UNKNOWN)
                    scores.append(float(score[k]) if known else 0.0)
                    flags.append(bool(flag[k]) if known else True)
            own = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(flags, pa.bool_())],
                [*columns, "lang_pred", "score", "ambiguous"],
            )

    return lettered.mapInArrow(named, schema)


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = train(docs.where(remainder(4) != 2))
    found = identify(docs.drop("lang"), model)
    return found.select("doc_id", (remainder(4) == 2).alias("held_out"), "lang_pred", "score", "ambiguous")


QUERIES = {"op3_language": op3_language}
ORACLES: dict[str, str] = {}
