"""Centroid clustering over a VA-file.

Vectors become integers, and beside each block of them lies its approximation: a byte a
dimension, the number of the cell between that dimension's marks that holds the
component. For given centroids, what a cell can add to a distance at least and at most
is a table lookup; the sums are an interval for each centroid. Where the lowest interval
lies below all others the nearest centroid is known from the cells alone, and only where
intervals overlap is the full vector fetched.

The distances compared are those to the centroids less that to the centroids' mean,
which is the same for all: |x - c|^2 - |x - m|^2 is linear in x, so its interval is as
wide as the centroid is far from the mean, and not as the vector is from the centroid.

A round needs its clusters' sums as well. They are carried from round to round, so a
vector counts only if it moves: a round judges each vector by the former and by the new
centroids, and fetches it if either is open or they differ. Nothing but sums per cluster
leaves a task: no vector is shuffled and no assignment stored, and a lost task is
computed again from its blocks. Spark reads a block's cells and vectors together; what
is saved is the work on vectors, not their reading. Integer sums are exact, so results
do not depend on blocks, marks or partitions.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.session import stored

#: Vectors in a block.
BLOCK = 2048
#: Cells of a dimension: their numbers take a byte.
CELLS = 256
#: Vectors that the marks are learned from, on average; only speed depends on it.
SAMPLE = 4096
BLOCKS = "ids binary, id_nulls binary, cells binary, vectors binary"


def usable(column: str, dims: int) -> Column:
    """True for arrays of ``dims`` components, none null, NaN or infinite."""
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(column) == dims) & ~bad, F.lit(False))


def largest(dims: int) -> int:
    """Components from this on may have distances that a long cannot hold."""
    return math.isqrt((1 << 60) // dims)


def integers(rows: pa.Array, dims: int, scale: int) -> np.ndarray:
    """floor(scale * x) of each component, in double precision, as longs."""
    x = np.floor(rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims) * scale)
    if len(x) and np.abs(x).max() >= largest(dims):
        raise ValueError(f"a component times {scale} is {largest(dims)} or more: its distances do not fit a long")
    return x.astype(np.int64)


@dataclass
class Cells:
    """The marks between the cells of each dimension, from the least to the largest value."""

    low: np.ndarray  # dims
    high: np.ndarray
    marks: np.ndarray  # dims x (cells - 1): a cell starts at its mark

    @classmethod
    def learn(cls, low: np.ndarray, high: np.ndarray, sample: np.ndarray) -> Cells:
        shares = np.arange(1, CELLS) / CELLS
        marks = np.quantile(sample, shares, axis=0).T if len(sample) else np.repeat(low[:, None], CELLS - 1, axis=1)
        return cls(low, high, np.clip(np.ceil(marks).astype(np.int64), low[:, None], high[:, None]))

    def encode(self, x: np.ndarray) -> np.ndarray:
        cells = np.empty(x.shape, dtype=np.uint8)
        for d in range(x.shape[1]):
            cells[:, d] = np.searchsorted(self.marks[d], x[:, d], side="right")
        return cells

    def tables(self, centroids: np.ndarray) -> np.ndarray:
        """For each dimension and cell, the least and the most that it adds to the distance
        to each centroid, less that to the centroids' mean."""
        first = np.concatenate([self.low[:, None], self.marks], axis=1)  # dims x cells, both ends held
        last = np.maximum(np.concatenate([self.marks - 1, self.high[:, None]], axis=1), first)
        c = centroids.T[:, :, None]  # dims x k x 1
        m = middle(centroids)[:, None, None]
        one, two = (c * c - m * m + 2 * x[:, None] * (m - c) for x in (first, last))
        return np.concatenate([np.minimum(one, two), np.maximum(one, two)], axis=1).transpose(0, 2, 1).copy()


def middle(centroids: np.ndarray) -> np.ndarray:
    return centroids.sum(axis=0) // len(centroids)


def full(content: pa.Buffer, dims: int) -> np.ndarray:
    """A block's vectors, where they lie."""
    return np.frombuffer(content, dtype="<i4").reshape(-1, dims)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each full vector, ties to the smaller number, and the distance."""
    d = np.stack([((x - c) ** 2).sum(axis=1) for c in centroids], axis=1)
    best = d.argmin(axis=1)
    return best, d[np.arange(len(x)), best]


def decided(cells: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """The nearest centroid where the cells alone tell it, else -1."""
    k = tables.shape[2] // 2
    bounds = np.zeros((len(cells), 2 * k), dtype=np.int64)
    for j in range(cells.shape[1]):
        bounds += tables[j][cells[:, j]]
    best = bounds[:, k:].argmin(axis=1)
    rows = np.arange(len(cells))
    most, least = bounds[rows, k + best], bounds[:, :k]
    least[rows, best] = np.iinfo(np.int64).max
    return np.where((least > most[:, None]).all(axis=1), best, -1)


@dataclass
class Clustering:
    """Integer centroids, and how many vectors each round, the first excluded, fetched."""

    centroids: np.ndarray
    vectors: int
    fetched: list[int] = field(default_factory=list)

    def hashes(self) -> list[str]:
        return [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in self.centroids]


class VaFile:
    """The stored blocks of a table of vectors."""

    def __init__(self, vectors: DataFrame, *, vec_id: str, column: str, dims: int, scale: int):
        self.dims, self.scale = dims, scale
        rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("v"))
        self.rows = rows.where(usable("v", dims))

        def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            low, high, n = None, None, 0
            for batch in batches:
                x = integers(batch.column(0), dims, scale)
                n += len(x)
                if len(x):
                    low = x.min(axis=0) if low is None else np.minimum(low, x.min(axis=0))
                    high = x.max(axis=0) if high is None else np.maximum(high, x.max(axis=0))
            if low is not None:
                d = np.arange(dims)
                arrays = [pa.array(d), pa.array(low), pa.array(high), pa.array(np.full(dims, n))]
                yield pa.RecordBatch.from_arrays(arrays, names=["d", "low", "high", "n"])

        found = self.rows.select("v").mapInArrow(ends, "d long, low long, high long, n long").groupBy("d")
        found = found.agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))
        found = found.toPandas().sort_values("d")  # a row for each dimension
        self.empty = not len(found)
        if self.empty:
            return
        n = int(found["n"].iloc[0])
        sample = self.rows.select("v").sample(min(1.0, SAMPLE / n), seed=13).toPandas()["v"]
        sample = np.array(sample.tolist(), dtype=np.float64)
        cells = Cells.learn(
            found["low"].to_numpy(), found["high"].to_numpy(), np.floor(sample.reshape(-1, dims) * scale)
        )
        self.cells, self.vectors = cells, n

        def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, BLOCK):
                    part = batch.slice(at, BLOCK)
                    x, ids = integers(part.column(1), dims, scale), part.column(0)
                    nulls = ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8)
                    ids = ids.fill_null(0).to_numpy()
                    row = [ids.astype("<i8"), nulls, cells.encode(x), x.astype("<i4")]
                    arrays = [pa.array([np.ascontiguousarray(a).tobytes()], pa.binary()) for a in row]
                    yield pa.RecordBatch.from_arrays(arrays, names=["ids", "id_nulls", "cells", "vectors"])

        self.blocks = stored(self.rows.mapInArrow(blocks, BLOCKS), "vafile-blocks")

    def seeds(self, k: int, salt: str) -> np.ndarray:
        """The vectors of the ``k`` smallest hashes; equal ids are told apart by their vectors."""
        order = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
        first = self.rows.withColumn("h", order).orderBy(F.asc_nulls_last("h"), "v").limit(k).select("v").collect()
        return np.array([r["v"] for r in first], dtype=np.float64)

    def moves(self, former: np.ndarray | None, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """How sums and counts per cluster change from ``former`` centroids to new ones, and
        how many vectors were fetched for that; without former ones, all vectors count."""
        k, dims, cells = len(centroids), self.dims, self.cells

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, counts, fetched = np.zeros((k, dims), np.int64), np.zeros(k, np.int64), 0
            old_table, new_table = None if former is None else cells.tables(former), cells.tables(centroids)

            def add(x: np.ndarray, to: np.ndarray, sign: int) -> None:
                for c in range(k):
                    some = x[to == c]
                    sums[c] += sign * some.sum(axis=0)
                    counts[c] += sign * len(some)

            for batch in batches:
                for i in range(batch.num_rows):
                    near = np.frombuffer(batch.column(0)[i].as_buffer(), np.uint8).reshape(-1, dims)
                    new = decided(near, new_table)
                    if former is None:
                        old, at = None, np.arange(len(near))
                    else:
                        old = decided(near, old_table)
                        at = np.flatnonzero((old < 0) | (new < 0) | (old != new))
                    if not len(at):
                        continue
                    x = full(batch.column(1)[i].as_buffer(), dims)[at].astype(np.int64)
                    fetched += len(at)
                    to, blank = new[at], new[at] < 0
                    to[blank] = nearest(x[blank], centroids)[0]
                    if old is None:
                        add(x, to, 1)
                        continue
                    was, blank = old[at], old[at] < 0
                    was[blank] = nearest(x[blank], former)[0]
                    moved = was != to
                    add(x[moved], to[moved], 1)
                    add(x[moved], was[moved], -1)
            values = np.concatenate([sums.ravel(), counts, [fetched]])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], names=["i", "value"])

        found = self.blocks.select("cells", "vectors").mapInArrow(run, "i long, value long")
        total = found.groupBy("i").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
        values = [0] * (k * dims + k + 1)
        for r in total:  # k * (dims + 1) + 1 of them
            values[r["i"]] = int(r["value"])
        sums = np.array(values[: k * dims], dtype=object).reshape(k, dims)
        return sums, np.array(values[k * dims : -1], dtype=object), values[-1]

    def fit(self, k: int, rounds: int, salt: str) -> Clustering:
        """Rounds of assignment and of floor(sum / count); an empty cluster's centroid stays."""
        centroids = np.floor(self.seeds(k, salt) * self.scale).astype(np.int64)
        out, former, sums, counts = Clustering(centroids, self.vectors), None, 0, 0
        for _ in range(rounds):
            if former is not None and (former == centroids).all():
                break  # no vector moves any more
            more, members, fetched = self.moves(former, centroids)
            sums, counts = sums + more, counts + members
            if former is not None:
                out.fetched.append(fetched)
            former = centroids
            centroids = np.array(
                [[int(s) // n for s in row] if n else old.tolist() for row, n, old in zip(sums, counts, former, strict=True)],
                dtype=np.int64,
            )
        out.centroids = centroids
        return out

    def assigned(self, centroids: np.ndarray) -> DataFrame:
        """vec_id, cluster and distance of every vector; the distance asks for it in full."""
        dims, cells = self.dims, self.cells

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tables = cells.tables(centroids)
            for batch in batches:
                for i in range(batch.num_rows):
                    ids, nulls, near, vectors = (batch.column(j)[i].as_buffer() for j in range(4))
                    to = decided(np.frombuffer(near, np.uint8).reshape(-1, dims), tables)
                    x, blank = full(vectors, dims).astype(np.int64), to < 0
                    to[blank] = nearest(x[blank], centroids)[0]
                    apart = ((x - centroids[to]) ** 2).sum(axis=1)
                    ids = pa.array(np.frombuffer(ids, "<i8"), mask=np.frombuffer(nulls, np.uint8) > 0)
                    arrays = [ids, pa.array(to.astype(np.int32)), pa.array(apart)]
                    yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "cluster", "distance"])

        return self.blocks.mapInArrow(run, "vec_id long, cluster int, distance long")


RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def cluster(
    vectors: DataFrame, *, k: int = 8, rounds: int = 10, salt: str = "3:", vec_id: str = "vec_id",
    column: str = "embedding", dims: int = 64, scale: int = 1024,
) -> tuple[DataFrame, Clustering | None]:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of each vector
    that takes part, and the centroids.

    Vectors of ``dims`` components, none null, NaN or infinite, take part, as
    floor(scale * x). The first centroids are those of the smallest sha256 of ``salt``
    and the id, a null id last, equal ids by their vectors; fewer than ``k`` vectors give
    fewer. Ties of distance go to the smaller number. Repeated rows count again. A
    component of 2^17 or more, at the usual scale and 64 dimensions, raises ValueError. No vectors give no
    rows and no centroids.
    """
    spark = vectors.sparkSession
    file = VaFile(vectors, vec_id=vec_id, column=column, dims=dims, scale=scale)
    if file.empty:
        return spark.createDataFrame([], RESULT), None
    found = file.fit(k, rounds, salt)
    rows = stored(file.assigned(found.centroids), "vafile-assigned")
    sums = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    inertia = {r["cluster"]: int(r["s"]) for r in sums}
    whole, hashes = sum(inertia.values()), found.hashes()
    known = [(c, inertia[c], whole, hashes[c]) for c in sorted(inertia)]  # at most k
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    out = rows.join(F.broadcast(spark.createDataFrame(known, schema)), "cluster")
    return out.select(*[c.split()[0] for c in RESULT.split(", ")]), found


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))[0]


def _sql(rounds: int = 10, k: int = 8) -> str:
    """The rounds one after another, each a common table over the one before."""
    assign = """near{r} AS MATERIALIZED (
  SELECT vec_id, v, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT vec_id, v, c, list_sum(list_transform(list_zip(v, w), lambda x: (x[1] - x[2]) * (x[1] - x[2])))::BIGINT AS d
    FROM vecs, cents{r}) GROUP BY vec_id, v
)"""
    update = """cents{n} AS MATERIALIZED (
  SELECT c, coalesce(list(m ORDER BY i) FILTER (m IS NOT NULL), any_value(w)) AS w FROM (
    SELECT cents{r}.c, any_value(cents{r}.w) AS w, i, floor(sum(x)::DOUBLE / count(x))::BIGINT AS m
    FROM cents{r} LEFT JOIN (SELECT c, unnest(v) AS x, unnest(range(64)) AS i FROM near{r}) AS parts USING (c)
    GROUP BY cents{r}.c, i) GROUP BY c
)"""
    steps = [
        """vecs AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
)""",
        f"""cents0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY sha256('3:' || vec_id)))::INT - 1 AS c, v AS w FROM vecs
  ORDER BY sha256('3:' || vec_id) LIMIT {k}
)""",
    ]
    for r in range(rounds):
        steps += [assign.format(r=r), update.format(r=r, n=r + 1)]
    steps.append(assign.format(r=rounds))
    return f"""WITH {", ".join(steps)}
SELECT vec_id, near{rounds}.c::INT AS cluster, d AS distance,
       (sum(d) OVER (PARTITION BY near{rounds}.c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(w, ',')) AS centroid_sha256
FROM near{rounds} JOIN cents{rounds} USING (c)
"""


QUERIES = {"op13_centroid_clusters": op13_centroid_clusters}
ORACLES = {"op13_centroid_clusters": _sql()}
