"""Approximate nearest neighbours by multi-index hashing of learned binary codes.

Codes are signs of the vectors after a learned rotation: principal axes of a bounded
sample, turned by alternating between the signs and the rotation that fits them best.
A code is split into substrings of about as many bits as number a block's entries, and
each substring is indexed. If two codes differ in at most r bits, some substring differs
in at most r / (number of substrings), so probing all substrings that near retrieves
every code within r; the rest of the codes' bits are then counted, and what is left is
ranked by the exact product of the original vectors. The radius is learned on the
sample, where the true neighbours are known: those of the rank that the sample's share
of all rows makes of the rank asked for. How little is probed depends on the vectors:
near neighbours make a small radius, and neighbours no nearer than others a wide one.

Equal vectors are one entry, with as many of their ids as any answer can hold, so a
vector that a third of the rows share is searched for, and found, once. The queries
are a stated set; they meet the entries in blocks of bounded size, each block with its
own index, and only each query's best of a block leave the task.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tollgate.session import stored

#: Vectors that the rotation and the radius are learned from, on average.
SAMPLE = 4096
#: Entries, and queries, in a block.
ENTRIES, ASKED = 1 << 14, 1 << 11
#: Share of the sample's true neighbours that lie within the radius.
WITHIN = 0.985
#: Bits of a substring, at least and at most.
LEAST_BITS, MOST_BITS = 8, 16


@dataclass
class Coder:
    mean: np.ndarray
    turn: np.ndarray  # dimensions x bits
    radius: int
    bits: int = LEAST_BITS  # of a substring

    def codes(self, x: np.ndarray) -> np.ndarray:
        """One row of bytes for each vector."""
        return np.packbits((x - self.mean) @ self.turn > 0, axis=1)


def _turned(z: np.ndarray, rng: np.random.Generator, rounds: int = 30) -> np.ndarray:
    turn = np.linalg.qr(rng.standard_normal((z.shape[1], z.shape[1])))[0]
    for _ in range(rounds):
        u, _, v = np.linalg.svd(np.sign(z @ turn).T @ z)
        turn = (u @ v).T
    return turn


def learn(x: np.ndarray, k: int, rows: int | None = None, seed: int = 9, turns: int = 2) -> Coder:
    """Rotations and radius from a sample of ``rows`` vectors; None: of no more than these.

    ``turns`` rotations, learned from different starts, make a code of that many times
    the dimensions, in bits. The ``k`` nearest of all rows are as near as k times the
    sample's share of the rows of the sample.
    """
    rows = max(len(x), rows or 0)
    bits = min(MOST_BITS, max(LEAST_BITS, round(np.log2(max(2, min(rows, ENTRIES))))))
    rng, dim = np.random.default_rng(seed), x.shape[1]
    if len(x) < 2:
        return Coder(np.zeros(dim), np.concatenate([np.eye(dim), np.eye(dim)[:, : -dim % 8]], axis=1), 2 * dim)
    mean = np.zeros(dim)  # inner products keep the origin
    axes = np.linalg.svd(x - mean, full_matrices=True)[2].T if len(x) < dim else np.linalg.eigh(x.T @ x)[1]
    turn = np.concatenate([axes @ _turned(x @ axes, rng) for _ in range(turns)], axis=1)
    parts = -(-turn.shape[1] // bits)
    bits = -(-turn.shape[1] // parts)  # parts of one size, few bits said twice
    turn = np.concatenate([turn, turn[:, : parts * bits - turn.shape[1]]], axis=1)
    coder = Coder(mean, turn, turn.shape[1], bits)
    asked = x[rng.permutation(len(x))[:256]]
    near = np.argsort(-(asked @ x.T), axis=1)[:, 1 : max(1, round(k * len(x) / rows)) + 1]
    codes, own = coder.codes(x), coder.codes(asked)
    apart = np.bitwise_count(codes[near] ^ own[:, None, :]).sum(axis=2)
    coder.radius = int(np.quantile(apart, WITHIN))
    return coder


def substrings(codes: np.ndarray, bits: int) -> np.ndarray:
    """One row of substrings, as numbers, for each code; spare bits of the last byte are in none."""
    parts = 8 * codes.shape[1] // bits
    signs = np.unpackbits(codes, axis=1)[:, : parts * bits].reshape(len(codes), parts, bits)
    return signs @ (1 << np.arange(bits))


class Index:
    """The substrings of a block of codes, each with its postings."""

    def __init__(self, codes: np.ndarray, bits: int = LEAST_BITS):
        self.codes, self.bits, self.probed = codes, bits, 0
        parts = substrings(codes, bits)
        self.order = [np.argsort(parts[:, j], kind="stable") for j in range(parts.shape[1])]
        every = np.arange((1 << bits) + 1)
        self.starts = [np.searchsorted(parts[o, j], every) for j, o in enumerate(self.order)]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Every entry whose code differs in at most ``radius`` bits."""
        found = np.zeros(len(self.codes), dtype=bool)
        values = substrings(code[None], self.bits)[0].tolist()
        parts = len(values)
        for j, value in enumerate(values):
            # radius = a * parts + b: the first b + 1 parts are probed to a, the others to a - 1
            far = radius // parts - (j > radius % parts)
            if far < 0:
                continue
            near = masks(self.bits, min(far, self.bits)) ^ value
            first, last = self.starts[j][near], self.starts[j][near + 1]
            n = last - first
            at = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
            found[self.order[j][at]] = True  # their postings
        at = np.flatnonzero(found)
        self.probed += len(at)
        apart = np.bitwise_count(self.codes[at] ^ code).sum(axis=1)
        return at[apart <= radius]


@lru_cache(maxsize=64)
def masks(bits: int, most: int) -> np.ndarray:
    """The numbers of ``bits`` bits with at most ``most`` of them set."""
    numbers = np.arange(1 << bits, dtype=np.int64)
    return numbers[np.bitwise_count(numbers) <= most]


def usable(vectors: DataFrame, column: str) -> DataFrame:
    """Rows whose vector is not null or zero and holds no null, NaN or infinity."""
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(column, lambda x: x != 0)
    return vectors.where(F.col(column).isNotNull() & ~bad & some)


def search(
    vectors: DataFrame, asked: DataFrame, *, k: int = 20, vec_id: str = "vec_id",
    column: str = "embedding", radius: int | None = None,
) -> DataFrame:
    """query_id, rank, vec_id and score of the nearest ``k`` found for each id of ``asked``.

    ``vectors`` has ids and arrays; ``asked`` (vec_id) names those to search for. Nearness is the inner product in double precision; ties go to the smaller id;
    a query is no answer to itself. Vectors that are null, zero or hold a null or
    non-finite number take no part, neither as query nor as candidate, nor do those of
    another length than most of the others (of two lengths as frequent, the larger
    counts). If ids repeat,
    each distinct pair of id and vector is a candidate, and the query's id is left out.
    Where fewer than ``k`` lie within the radius, the query is answered from all rows.
    """
    spark = vectors.sparkSession
    rows = usable(vectors.select(F.col(vec_id).alias("vec_id"), F.col(column).cast("array<double>").alias("v")), "v")
    lengths = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    rows = rows.where(F.size("v") == (lengths["size"] if lengths else 0))
    key = F.xxhash64("v")
    other = F.xxhash64(F.lit(7), "v")  # both together stand for the vector
    kept = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    # k + 1 ids of a vector are all that an answer can need, itself left out
    entries = stored(
        rows.distinct().withColumn("n", kept).where(F.col("n") <= k + 1)
        .groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .withColumn("key", key),
        "ann-entries",
    )
    n = entries.count()
    sample = (
        entries.where(F.pmod(F.xxhash64(F.lit(9), "key"), F.lit(1 << 30)) < (1 << 30) * min(1.0, SAMPLE / max(n, 1)))
        .select("v").toPandas()
    )
    dim = len(sample["v"].iloc[0]) if len(sample) else 1
    coder = learn(np.array(sample["v"].tolist(), dtype=np.float64).reshape(-1, dim), k, n)
    if radius is not None:
        coder.radius = radius

    blocks = max(1, -(-n // ENTRIES))
    queries = stored(
        rows.join(asked.select("vec_id").distinct(), "vec_id", "left_semi").distinct(), "ann-queries"
    )
    wanted = queries.select("v").distinct().withColumns({"key": key, "other": other})
    m = queries.count()
    chunks = max(1, -(-m // ASKED))
    dealt = entries.select("v", "ids", "key", F.pmod("key", F.lit(blocks)).alias("block")).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))
    )
    asking = wanted.withColumn("chunk", F.pmod(F.xxhash64(F.lit(1), "key"), F.lit(chunks)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    )

    def best(all_rows: bool):
        def run(asks: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
            out: list[tuple] = []
            if len(asks) and len(block):
                x = np.array(block["v"].tolist(), dtype=np.float64)
                q = np.array(asks["v"].tolist(), dtype=np.float64)
                index, codes = Index(coder.codes(x), coder.bits), coder.codes(q)
                lengths = np.linalg.norm(x, axis=1)
                # exact scores of near entries pick the order; one query at a time bounds memory
                for i, (key, other) in enumerate(zip(asks["key"].tolist(), asks["other"].tolist(), strict=True)):
                    at = np.arange(len(x)) if all_rows else index.within(codes[i], coder.radius)
                    scores = x[at] @ q[i]
                    if len(at) > k + 1:
                        least = np.partition(scores, -(k + 1))[-(k + 1)]
                        # sums of another order differ by less than this
                        at = at[scores >= least - 1e-12 * lengths[at].max() * np.linalg.norm(q[i])]
                    out += [(key, other, block["v"].iloc[j], block["ids"].iloc[j]) for j in at.tolist()]
            return pd.DataFrame(out, columns=["key", "other", "w", "ids"])

        return run

    def answers(asks: DataFrame, all_rows: bool) -> DataFrame:
        near = (
            asks.groupBy("block", "chunk")
            .cogroup(dealt.groupBy("block", "chunk"))
            .applyInPandas(best(all_rows), "key long, other long, w array<double>, ids array<long>")
        )
        product = F.aggregate(F.zip_with("v", "w", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
        scored = (
            near.join(queries.withColumns({"key": key, "other": other}).withColumnRenamed("vec_id", "query_id"), ["key", "other"])
            .select("query_id", product.alias("score"), F.explode("ids").alias("vec_id"))
            .where("vec_id <> query_id")
        )
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    first = stored(answers(asking, False), "ann-found")
    names = ["query_id", "rank", "vec_id", "score"]
    short = stored(
        queries.join(first.groupBy(F.col("query_id").alias("vec_id")).count().where(F.col("count") >= k), "vec_id", "left_anti")
        .select("v").distinct(),
        "ann-short",
    )
    if short.isEmpty():
        return first.select(*names)
    again = answers(asking.join(short, "v", "left_semi"), True)
    second = stored(again.select(*names), "ann-rest")
    first = first.join(second.select("query_id").distinct(), "query_id", "left_anti")
    return first.select(*names).unionByName(second)


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return search(vectors, vectors.where("vec_id % 20 = 0"))


QUERIES = {"op9_nearest": op9_nearest}
ORACLES: dict[str, str] = {}
