"""MinHash near-dedup with odd sketches.

A document's set are the hashes of its distinct word shingles. Documents of equal sets
are one class, found by a 128-bit hash of the set; the rest works on classes. MinHash
samples of a set are banded into bucket keys, and folded into an odd sketch: a bitmap
in which each sample flips one bit, so that the population count of two sketches' XOR
tells how many samples differ, most precisely where few do. A pair that shares a
bucket is a candidate; the sketches discard it unless it may reach the threshold. So
does a second parity bitmap, of the full set: two sets differ in at least as many
elements as their bitmaps differ in bits, which bounds the similarity from above and
never discards a link. What is left is confirmed on the full sets.

A bucket of n classes never gives its n * n pairs. First each member meets only the
bucket's smallest id, and confirmed links make components. Then only members of one
bucket that are in different components meet, so a large group of near copies costs
one pair a member, while no pair that could join two components goes untested.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.session import stored

from .text import SPACES, Hasher, hashed, mixed, rows_of, signed, slices

#: Bands and samples of each: a pair of similarity 0.8 shares no bucket with
#: probability (1 - 0.8 ** 5) ** 48 = 5e-9.
BANDS, ROWS = 48, 5
SAMPLES = BANDS * ROWS
#: Bits of an odd sketch, and the most that may differ. At similarity 0.8, 96 of 480
#: samples differ, give or take 12, and 88 bits, give or take 12; 160 bits are six
#: deviations away.
SKETCH_BITS, MOST_BITS = 1024, 160
#: Bits of the parity bitmap of a full set.
PARITY_BITS = 2048

_U = np.uint64
_RNG = np.random.default_rng(20)
_FLIP = _RNG.integers(0, 2**63, SAMPLES, dtype=np.uint64) * _U(2) + _U(1)
_TIMES = _RNG.integers(0, 2**63, SAMPLES, dtype=np.uint64) * _U(2) + _U(1)
_PLACES = _RNG.integers(0, 2**63, SAMPLES, dtype=np.uint64)
_HASHER = Hasher(2)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """The sorted distinct shingles of a word sequence; of a shorter one, the sequence."""
    n = min(size, len(words))
    if not n:
        return words
    out = np.full(len(words) - n + 1, n, dtype=np.uint64)
    for i in range(n):
        out = mixed(out * _U(0x9E3779B97F4A7C15) + words[i : len(words) - n + 1 + i])
    return np.unique(out)


def minhash(values: np.ndarray) -> np.ndarray:
    """SAMPLES minima of a set that isn't empty."""
    out = np.full(SAMPLES, _U(2**64 - 1))
    for a in range(0, len(values), 128):
        np.minimum(out, ((values[a : a + 128, None] ^ _FLIP) * _TIMES).min(axis=0), out=out)
    return out


def band_keys(samples: np.ndarray) -> np.ndarray:
    out = np.arange(1, BANDS + 1, dtype=np.uint64)
    for r in range(ROWS):
        out = mixed(out * _U(0x9E3779B97F4A7C15) + samples.reshape(BANDS, ROWS)[:, r])
    return out


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Samples folded into a parity bitmap of 64-bit words."""
    return parity(mixed(samples + _PLACES), SKETCH_BITS)


def parity(values: np.ndarray, size: int) -> np.ndarray:
    """A bitmap of ``size`` bits, each flipped once by every value that falls on it."""
    bits = np.bincount((values % _U(size)).astype(np.int64), minlength=size) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.uint64)


def similarity_of(differing_bits: float) -> float:
    """The Jaccard similarity that an XOR of sketches with so many bits set suggests."""
    share = min(2 * differing_bits / SKETCH_BITS, 0.999)
    return max(0.0, 1 + SKETCH_BITS / (4 * SAMPLES) * float(np.log(1 - share)))


def _sets(texts: list[bytes], size: int) -> Iterator[np.ndarray]:
    lower = [t.lower() for t in texts]  # of bytes: A-Z only
    for _, (words,), offsets in hashed(lower, [_HASHER], SPACES):
        for k in range(len(offsets) - 1):
            yield shingles(words[offsets[k] : offsets[k + 1]], size)


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n, h1, h2 (a hash of the set), keys, sketch and bits of each row, stored."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n", "h1", "h2", "keys", "sketch", "bits"]
        longs = pa.list_(pa.int64())
        for batch in slices(batches):
            n, h1, h2, keys, sketches, bits = [], [], [], [], [], []
            for own in _sets(rows_of(batch.column("text")), size):
                n.append(len(own))
                h1.append(int(signed(mixed(own ^ _U(0x51ED27))).sum()))
                h2.append(int(signed(mixed(own + _U(0xA4093822299F31D0))).sum()))
                if len(own):
                    samples = minhash(own)
                    keys.append(signed(band_keys(samples)))
                    sketches.append(signed(odd_sketch(samples)))
                    bits.append(signed(parity(own, PARITY_BITS)))
                else:
                    keys.append(None)
                    sketches.append(None)
                    bits.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(x, pa.int64()) for x in (n, h1, h2)],
                 *[pa.array(x, longs) for x in (keys, sketches, bits)]],
                names,
            )

    fields = [T.StructField(c, T.LongType()) for c in ("doc_id", "n", "h1", "h2")]
    fields += [T.StructField(c, T.ArrayType(T.LongType())) for c in ("keys", "sketch", "bits")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stored(rows.mapInArrow(sign, T.StructType(fields)), "near-signatures")


def full_sets(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """id and set of the rows of ``docs`` with an id of ``ids``, stored."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            got = [signed(s) for s in _sets(rows_of(batch.column("text")), size)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(got, pa.list_(pa.int64()))], ["id", "set"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(ids, "id", "left_semi")
    return stored(rows.mapInArrow(sets, "id long, set array<long>"), "near-sets")


def components(links: DataFrame) -> DataFrame:
    """id and component (the smallest id reachable) of every id in ``links`` (a, b).

    Alternates two steps until nothing changes: every id hands its larger neighbours to
    its smallest one, then its smaller neighbours. Each needs one grouping and one join
    on ids; what reaches the driver are a count and a sum.
    """
    links = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "near-links")
    before = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.where("a <> b").distinct(), "near-large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        links = stored(small.where("a <> b").distinct(), "near-links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = links.select(F.col("b").alias("id")).distinct().withColumn("component", F.col("id"))
    return links.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)


def differing(a: Column, b: Column) -> Column:
    """Bits in which two sketches differ."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def _may_link(a: str, b: str, percent: int) -> Column:
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    sizes = 100 * F.least(na, nb) >= percent * F.greatest(na, nb)
    near = differing(F.col(f"{a}.sketch"), F.col(f"{b}.sketch")) <= MOST_BITS
    apart = differing(F.col(f"{a}.bits"), F.col(f"{b}.bits"))
    # |intersection| <= (na + nb - apart) / 2 and |union| >= (na + nb + apart) / 2
    return sizes & near & (100 * (na + nb - apart) >= percent * (na + nb + apart))


def confirmed(docs: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """The ``pairs`` (a, b) with 100 * intersection >= percent * union, on full sets."""
    pairs = stored(pairs.distinct(), "near-pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    sets = full_sets(docs, stored(ids, "near-ids"), size)
    of = lambda c: sets.select(F.col("id").alias(c), F.col("set").alias(f"set_{c}"))
    both = pairs.join(of("a"), "a").join(of("b"), "b")
    inter = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - inter
    return stored(both.where(100 * inter >= percent * union).select("a", "b").distinct(), "near-confirmed")


def link(docs: DataFrame, *, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs`` (doc_id, text).

    Documents are linked whose sets of ``size``-word shingles have a Jaccard similarity
    of ``percent`` / 100 or more; a component is named after its smallest doc_id, which
    is kept. Texts without words (null, empty) have empty sets, linked with nothing. A
    row without doc_id is kept, in no component. Rows that repeat a doc_id each have
    their own text's component. No rows give no rows.
    """
    signed_rows = signatures(docs, size)
    classes = stored(
        signed_rows.where("n > 0 AND doc_id IS NOT NULL")
        .groupBy("n", "h1", "h2")
        .agg(F.min("doc_id").alias("id"), *[F.first(c).alias(c) for c in ("keys", "sketch", "bits")]),
        "near-classes",
    )
    members = classes.select(F.explode("keys").alias("key"), "id")
    buckets = members.groupBy("key").agg(F.min("id").alias("lead"), F.count("*").alias("size"))
    shared = stored(members.join(buckets.where("size > 1"), "key").select("key", "id", "lead"), "near-buckets")
    sketches = classes.select("id", "n", "sketch", "bits")

    stars = shared.where("id <> lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    stars = (
        stars.join(sketches.alias("x"), F.col("a") == F.col("x.id"))
        .join(sketches.alias("y"), F.col("b") == F.col("y.id"))
        .where(_may_link("x", "y", percent))
        .select("a", "b")
    )
    first = confirmed(docs, stars, size, percent)
    parts = components(first)

    placed = shared.join(parts, "id", "left").select("key", "id", F.coalesce("component", "id").alias("part"))
    split = placed.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high"))
    mixed_up = placed.join(split.where("low <> high").select("key"), "key", "left_semi")
    sided = stored(mixed_up.join(sketches, "id"), "near-sides")
    x, y = sided.alias("x"), sided.alias("y")
    apart = (F.col("x.key") == F.col("y.key")) & (F.col("x.part") < F.col("y.part"))
    across = x.join(y, apart & _may_link("x", "y", percent)).select(
        F.col("x.id").alias("a"), F.col("y.id").alias("b")
    )
    second = confirmed(docs, across, size, percent)

    def part_of(links: DataFrame, column: str) -> DataFrame:
        named = parts.select(F.col("id").alias(column), F.col("component").alias(f"p{column}"))
        joined = links.join(named, column, "left")
        return joined.withColumn(column, F.coalesce(f"p{column}", column)).drop(f"p{column}")

    merged = components(part_of(part_of(second, "a"), "b"))
    merged = merged.select(F.col("id").alias("part"), F.col("component").alias("root"))
    reps = (
        classes.select("n", "h1", "h2", F.col("id").alias("rep"))
        .join(parts.withColumnRenamed("id", "rep"), "rep", "left")
        .withColumn("part", F.coalesce("component", "rep"))
        .join(merged, "part", "left")
        .select("n", "h1", "h2", F.coalesce("root", "part").alias("component_id"))
    )
    return (
        signed_rows.select("doc_id", "n", "h1", "h2")
        .join(reps, ["n", "h1", "h2"], "left")
        .select(
            "doc_id", F.col("n").alias("n_shingles"),
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def deduplicated(docs: DataFrame, *, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that are kept; of rows that repeat a kept doc_id, all."""
    gone = link(docs, size=size, percent=percent).where("NOT kept").select(F.col("doc_id").alias("__gone"))
    gone = stored(gone.distinct(), "near-gone")
    return docs.join(gone, F.col("doc_id") == F.col("__gone"), "left_anti")


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return link(docs, size=2)


_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END)) AS s
  FROM words
), sized AS (
  SELECT doc_id, coalesce(s, []) AS s, coalesce(len(s), 0) AS n FROM sets
), classes AS (
  SELECT min(doc_id) AS id, s, n FROM sized WHERE n > 0 GROUP BY s, n
), ranked AS (
  SELECT id, n, t, row_number() OVER (PARTITION BY id ORDER BY f, t) AS place FROM (
    SELECT id, n, t, count(*) OVER (PARTITION BY t) AS f FROM (SELECT id, n, unnest(s) AS t FROM classes))
), prefixes AS (
  SELECT id, n, t FROM ranked WHERE place <= n - (4 * n + 4) // 5 + 1
), pairs AS (
  SELECT DISTINCT a.id AS a, b.id AS b FROM prefixes a JOIN prefixes b
  ON a.t = b.t AND a.id < b.id AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
), links AS (
  SELECT a, b FROM pairs JOIN classes x ON x.id = a JOIN classes y ON y.id = b
  WHERE 100 * len(list_intersect(x.s, y.s)) >= 80 * (x.n + y.n - len(list_intersect(x.s, y.s)))
), sides AS (
  SELECT a, b FROM links UNION SELECT b, a FROM links
), reached(id, root) AS (
  SELECT id, id FROM classes
  UNION SELECT b, root FROM reached JOIN sides ON a = id WHERE root < b
), roots AS (
  SELECT id, min(root) AS root FROM reached GROUP BY id
)
SELECT d.doc_id, d.n AS n_shingles, coalesce(r.root, d.doc_id) AS component_id,
       d.doc_id = coalesce(r.root, d.doc_id) AS kept
FROM sized d LEFT JOIN classes c ON c.s = d.s AND c.n = d.n AND d.n > 0 LEFT JOIN roots r ON r.id = c.id
"""

QUERIES = {"op2_near_duplicates": op2_near_duplicates}
ORACLES = {"op2_near_duplicates": _SQL}
