"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Every source's documents fall into at most 4,096 blocks by a hash. A source whose
target is f times its size gives floor(f) whole copies of its blocks and part of
one more copy: blocks are taken in permuted order, each if it still fits, so what
is left over is smaller than any block not taken. The first of those is cut in the
same way at two finer levels, down to single documents. This fixes each source's
exact quota of blocks. A tree over the output shards then splits the quotas: each
node hands its left half a multivariate-hypergeometric draw, so every shard gets
the composition of a random shuffle while all quotas stay exact. A shard's blocks
are disjoint ranges of its sources' permuted blocks, and its rows are shuffled by
a hash inside the shard.

What reaches the driver are sums, at most 1,024 group quotas, and nothing per
source; what reaches one task are at most 4,096 blocks of one source. Rerunning
gives the same mix.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollgate.session import stored

WORD = r"[^\x20\x09-\x0D]+"
#: Blocks of a source at each of the three levels, as bits of the hash.
BITS = 12
#: Groups of sources whose quotas the driver splits.
GROUPS = 1024
MOST_COPIES = 3
#: numpy draws from fewer blocks than these.
MOST_DRAWN = 10**9


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """A key that tells null from every text."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def _drawn(rng: np.random.Generator, quotas: np.ndarray, n: int) -> np.ndarray:
    """``n`` blocks drawn from the quotas of the sources.

    Populations beyond what numpy draws from exactly are drawn from the normal limit of
    the same mean and spread, source by source; nothing is lost or drawn twice.
    """
    total, out = int(quotas.sum()), np.zeros_like(quotas)
    if total < MOST_DRAWN:
        return rng.multivariate_hypergeometric(quotas, n, method="marginals")
    for i, own in enumerate(quotas.tolist()):
        rest = total - own
        if total < MOST_DRAWN:
            got = int(rng.hypergeometric(own, rest, n)) if total else 0
        else:
            share = own / total
            spread = math.sqrt(n * share * (1 - share) * ((total - n) / (total - 1)))
            got = min(max(round(rng.normal(n * share, spread)), n - rest, 0), own, n)
        out[i], n, total = got, n - got, rest
    return out


def tree(quotas: np.ndarray, shards: np.ndarray, seed: list[int]) -> np.ndarray:
    """Quotas split among shards of the given capacities: one row per shard.

    The capacities must add up to the quotas. Each node is drawn with a seed of its
    own, so a tree gives the same split wherever it runs.
    """
    if len(shards) == 1:
        return quotas[None, :]
    half = len(shards) // 2
    rng = np.random.default_rng([*seed, len(shards), int(shards.sum())])
    left = _drawn(rng, quotas, int(shards[:half].sum()))
    return np.concatenate(
        [
            tree(left, shards[:half], [*seed, 0]),
            tree(quotas - left, shards[half:], [*seed, 1]),
        ]
    )


def subtree(quotas: np.ndarray, totals: np.ndarray, seed: list[int]) -> np.ndarray:
    """A group's members split among shards when the group's total in each is known."""
    return tree(quotas, totals, seed)


def _bits(level: int, column: str = "hash") -> Column:
    return F.shiftrightunsigned(column, 64 - BITS * level).bitwiseAND(F.lit((1 << BITS) - 1))


def _first_fit(pdf: pd.DataFrame, room: int, seed: int) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Permuted places of the blocks, which are taken, the first that wasn't, what is left."""
    order = np.random.default_rng([seed, len(pdf)]).permutation(len(pdf))
    places = np.empty(len(pdf), dtype=np.int64)
    places[order] = np.arange(len(pdf))
    words, taken, cut = pdf["words"].to_numpy(), np.zeros(len(pdf), dtype=bool), -1
    for i in order:
        if 0 < words[i] <= room:
            taken[i] = True
            room -= int(words[i])
        elif words[i] > 0 and cut < 0:
            cut = int(i)
    return places, taken, cut, room


def _level_one(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("b1", ignore_index=True)
    room = int(pdf["room"].iloc[0])
    places, taken, cut, room = _first_fit(pdf, room, int(pdf["seed"].iloc[0]))
    extra = np.full(len(pdf), -1, dtype=np.int64)
    by_place = np.argsort(places)
    extra[by_place[taken[by_place]]] = np.arange(taken.sum())
    left = np.full(len(pdf), -1, dtype=np.int64)
    if cut >= 0 and room > 0:
        left[cut] = room
    return pd.DataFrame(
        {"key": pdf["key"], "b1": pdf["b1"], "place": places, "extra": extra, "left": left,
         "blocks": len(pdf), "copies": pdf["copies"]}
    )


def _level_below(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("block", ignore_index=True)
    _, taken, cut, room = _first_fit(pdf, int(pdf["left"].iloc[0]), 2)
    more = cut >= 0 and room > 0
    return pd.DataFrame(
        {"key": [pdf["key"].iloc[0]], "b1": [pdf["b1"].iloc[0]],
         "taken": [pdf["block"][taken].tolist()],
         "cut": [int(pdf["block"].iloc[cut]) if more else -1], "left": [room if more else -1]}
    )


def source_targets(
    sized: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: int = MOST_COPIES
) -> DataFrame:
    """key, source_size, target for each source of ``sized`` (key, source, size).

    Sources in order of code points, null last, take the weights in turn and share
    the words of all. A target stops at ``most`` times its source's size; what is
    above is shared again by weight until nothing is above.
    """
    spark = sized.sparkSession
    order = [F.col("source").isNull(), F.col("source")]
    dealt = stored(
        sized.groupBy("key", "source")
        .agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
        .repartitionByRange(*order)
        .withColumn("part", F.spark_partition_id()),
        "mix-sources",
    )
    inside = Window.partitionBy("part").orderBy(*order)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = dealt.groupBy("part").count()
    parts = parts.select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    listed = F.array(*[F.lit(float(w)) for w in weights])
    place = (F.row_number().over(inside) - 1 + F.col("first")) % len(weights)
    ranked = stored(
        dealt.join(parts, "part").withColumn("weight", F.get(listed, place)), "mix-weights"
    )
    cap, level, capped = F.col("source_size") * F.lit(float(most)), None, -1
    while True:  # raises the level until no further source is capped
        full = F.lit(False) if level is None else F.col("weight") * F.lit(level) >= cap
        got = ranked.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(full, cap)).alias("held"),
            F.sum(F.when(~full, F.col("weight"))).alias("open"),
            F.count_if(full).alias("n"),
        ).first()
        if not got["open"] or got["n"] == capped:
            break
        capped = got["n"]
        level = (float(got["all"] or 0) - float(got["held"] or 0.0)) / got["open"]
    target = F.least(F.col("weight") * F.lit(level or 0.0), cap)
    return stored(
        ranked.select("key", "source", "source_size", target.alias("target")), "mix-targets"
    )


def draws(sized: DataFrame, targets: DataFrame, shards: int, seed: int) -> DataFrame:
    """For each source and block: the shards of its whole copies, the shard of its
    further copy (null: none), and how a cut block is cut."""
    size, target = F.col("source_size"), F.col("target")
    copies = F.when(size > 0, F.least(F.floor(target / size), F.lit(MOST_COPIES))).otherwise(0)
    room = F.when(copies < MOST_COPIES, F.round(target - copies * size).cast("long")).otherwise(0)
    sources = targets.select(
        "key",
        copies.cast("int").alias("copies"),
        F.greatest(F.lit(0), F.coalesce(room, F.lit(0))).cast("long").alias("room"),
        F.pmod(F.xxhash64(F.lit(seed), "key"), F.lit(1 << 31)).alias("seed"),
    )
    one = stored(
        sized.groupBy("key", _bits(1).alias("b1"))
        .agg(F.sum("size").alias("words"))
        .join(sources, "key")
        .groupBy("key")
        .applyInPandas(
            _level_one,
            "key string, b1 long, place long, extra long, left long, blocks long, copies int",
        ),
        "mix-blocks",
    )

    def below(cut: DataFrame, level: int) -> DataFrame:
        """``cut`` has key, b1, left and, below the second level, the path to the block."""
        path = [F.col(f"cut{i}") == _bits(i) for i in range(2, level)]
        on = [F.col("k") == F.col("key"), F.col("one") == _bits(1), *path]
        cut = cut.withColumnsRenamed({"key": "k", "b1": "one"})
        return stored(
            sized.join(cut, on)
            .groupBy("key", F.col("one").alias("b1"), "left", _bits(level).alias("block"))
            .agg(F.sum("size").alias("words"))
            .groupBy("key")
            .applyInPandas(
                _level_below, "key string, b1 long, taken array<long>, cut long, left long"
            ),
            f"mix-cut{level}",
        )

    two = below(one.where("left > 0").select("key", "b1", "left"), 2)
    three = below(two.where("left > 0").select("key", "b1", "left", F.col("cut").alias("cut2")), 3)
    cuts = two.select("key", "b1", F.col("taken").alias("taken2"), F.col("cut").alias("cut2")).join(
        three.select("key", "b1", F.col("taken").alias("taken3")), ["key", "b1"], "left"
    )
    quota = (
        F.sum(F.col("copies").cast("long"))
        + F.count_if(F.col("extra") >= 0)
        + F.count_if(F.col("left") > 0)
    )
    group = F.pmod(F.xxhash64(F.lit(seed + 1), "key"), F.lit(GROUPS)).alias("group")
    quotas = stored(one.groupBy("key").agg(quota.alias("quota")).withColumn("group", group), "mix-quotas")
    summed = sorted(quotas.groupBy("group").agg(F.sum("quota")).collect())
    names, counts = [r[0] for r in summed], np.array([r[1] for r in summed], dtype=np.int64)
    total = int(counts.sum())
    capacities = np.full(shards, total // shards) + (np.arange(shards) < total % shards)
    split = tree(counts, capacities, [seed]) if names else np.zeros((shards, 0), np.int64)
    by_group = {g: split[:, i] for i, g in enumerate(names)}

    def members(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("key", ignore_index=True)
        g = int(pdf["group"].iloc[0])
        rows = subtree(pdf["quota"].to_numpy(np.int64), by_group[g], [seed, 7, g])
        ends = np.cumsum(rows, axis=0)
        return pd.DataFrame({"key": pdf["key"], "ends": [x.tolist() for x in ends.T]})

    ranges = quotas.groupBy("group").applyInPandas(members, "key string, ends array<long>")
    # Copy c meets the permuted blocks turned by a share, so copies of a block part.
    turned = lambda c: (
        c * F.col("blocks")
        + (F.col("place") + F.floor(c * F.col("blocks") / (F.col("copies") + 1))) % F.col("blocks")
    )
    shard = lambda at: F.size(F.filter("ends", lambda x: x <= at))
    whole = F.filter(
        F.transform(F.array(*[F.lit(c) for c in range(MOST_COPIES)]),
                    lambda c: F.when(c < F.col("copies"), shard(turned(c)))),
        lambda x: x.isNotNull(),
    )
    extras = F.max(F.col("extra")).over(Window.partitionBy("key")) + 1
    place = F.when(F.col("extra") >= 0, F.col("extra")).when(F.col("left") > 0, F.col("extras"))
    further = F.when(place.isNotNull(), shard(F.col("copies") * F.col("blocks") + place))
    return stored(
        one.withColumn("extras", extras)
        .join(ranges, "key")
        .select("key", "b1", whole.alias("whole"), further.alias("further"),
                (F.col("extra") >= 0).alias("fits"))
        .join(cuts, ["key", "b1"], "left"),
        "mix-draws",
    )


def mix(
    docs: DataFrame,
    *,
    weights: tuple[float, ...] = (1, 2, 3),
    shards: int = 64,
    seed: int = 17,
    keep: list[str] | None = None,
) -> DataFrame:
    """Each row of ``docs`` (doc_id, source, text) with the shards that take it.

    Adds size, source_size, target and ``shards`` (array<int>, one entry a copy;
    empty: not taken); columns of these names in ``docs`` are replaced. ``keep``
    names the columns to return, all by default.

    Null or empty texts have size 0 and are taken with whole copies only. A null
    source is a source, the last. Rows of the same doc_id and source are taken
    alike. No rows give no rows.
    """
    made = ["size", "source_size", "target", "shards"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in made]
    hashed = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("__key"))
    rows = docs.withColumns({"__key": source_key(F.col("source")), "__size": n_words(F.col("text"))})
    rows = rows.withColumn("__hash", hashed)
    sized = stored(
        rows.select(
            F.col("__key").alias("key"), F.col("source").cast("string").alias("source"),
            F.col("__size").alias("size"), F.col("__hash").alias("hash"),
        ),
        "mix-sized",
    )
    targets = source_targets(sized, weights)
    plan = draws(sized, targets, shards, seed).join(
        targets.select("key", "source_size", "target"), "key"
    )
    rows = rows.drop(*made).withColumn("__b1", _bits(1, "__hash"))
    plan = plan.withColumnsRenamed({c: f"__{c}" for c in plan.columns})
    joined = rows.join(plan, ["__key", "__b1"])
    two, three = _bits(2, "__hash"), _bits(3, "__hash")
    in_cut = F.coalesce(
        F.array_contains("__taken2", two)
        | ((F.col("__cut2") == two) & F.array_contains("__taken3", three)),
        F.lit(False),
    )
    further = F.col("__further").isNotNull() & (F.col("__fits") | in_cut) & (F.col("__size") > 0)
    taken = F.concat("__whole", F.when(further, F.array("__further")).otherwise(F.array().cast("array<int>")))
    return joined.select(
        *keep, F.col("__size").alias("size"), F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"), taken.alias("shards"),
    )


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: a row for each copy taken, with ``shard`` and ``position``, by
    which its rows are shuffled; written in that order, a shard is ready to read."""
    seed = options.get("seed", 17)
    taken = mix(docs, **options).drop("size", "source_size", "target")
    rows = taken.select(*[c for c in taken.columns if c not in ("shards", "copy", "shard", "position")],
                        F.posexplode("shards").alias("copy", "shard"))
    rows = rows.withColumn("position", F.xxhash64(F.lit(seed + 2), "doc_id", "copy"))
    return rows.repartitionByRange("shard", "position").sortWithinPartitions("shard", "position")


def op1_mix_sources(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    out = mix(docs, keep=["doc_id"])
    return out.withColumn("taken", F.col("size") * F.size("shards"))


QUERIES = {"op1_mix_sources": op1_mix_sources}
ORACLES: dict[str, str] = {}
