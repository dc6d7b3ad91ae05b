"""Source divergence audit by count-level bitmaps.

Within a language every source is compared with every other, and with the language as
a whole, by f = |p - q| of smoothed term shares. A share depends on nothing but a term's
count and its group's total, so terms need not be compared one by one: for each (group,
count) a bitmap holds the terms of that count, the AND of two bitmaps has as many bits
as the pair of groups has terms in that joint cell, and a cell adds its size times f.
Cells with a zero on one side are complements: the terms of a count less those found in
cells, so

    sum f = sum over cells n(a, b) * (f(a, b) - f(a, 0) - f(0, b) + f(0, 0))
          + sum over a of S(a) * (f(a, 0) - f(0, 0)) + the same for b + V * f(0, 0)

where S(a) is the size of a bitmap and V the number of terms. The first sum is taken
block by block of about a thousand terms, the others from the sizes alone. Ids in a
block follow the terms' order, so a block's leading terms are read off its bitmaps.

Terms are counted in the tasks that read texts before anything is shuffled. A task
holds a block's bitmaps of two tiles of at most about a hundred groups, however many
sources, terms or rows of one source there are.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tollgate.llm.text import slices
from tollgate.session import stored

#: Terms in a block of bitmaps, and groups in a tile, on average.
BLOCK, TILE = 1024, 96
#: Counted entries that a task keeps before it hands them on.
ENTRIES = 200_000
#: Bytes of one text worked on at once, and cells compared at once.
PIECE, CELLS = 1 << 20, 1 << 17

#: Lower-cases A-Z; every other byte up to 0x7F that is no letter ends a term.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a whole text, some at a time."""
    text, at = text.translate(_FOLD), 0
    while at < len(text):
        end = text.find(b" ", at + PIECE)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def term_counts(docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents that hold the term).

    Null texts, languages and sources are read as empty. Each group has a row of the
    empty term, which no text holds, with zeros. Every row is a document of its own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def flushed() -> pa.RecordBatch:
            out: list[list] = [[], [], [], [], []]
            for (lang, source), (counts, held) in tallies.items():
                size = len(counts) + 1
                found = [b"", *counts], [0, *counts.values()], [0, *[held[t] for t in counts]]
                for column, part in zip(out, ([lang] * size, [source] * size, *found), strict=True):
                    column.extend(part)
            tallies.clear()
            kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(out, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=["lang", "source", "term", "n", "docs"])

        entries = 0
        for batch in slices(batches):
            langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, key in enumerate(zip(langs, sources, strict=True)):
                counts, held = tallies.setdefault(key, (Counter(), Counter()))
                before, seen = len(counts), set()
                for some in terms(batch.column(2)[i].as_py()):
                    counts.update(some)
                    seen.update(some)
                held.update(seen)
                entries += len(counts) - before
                if entries >= ENTRIES:
                    yield flushed()
                    entries = 0
        if tallies:
            yield flushed()

    whole = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"),
    )
    counted = whole.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: str, terms_: str, scale: int, add: int) -> Column:
    """1 + floor(scale * (n + add) / (total + add * terms)), exact."""
    above = (n + F.lit(add)).cast("decimal(20,0)") * F.lit(scale).cast("decimal(10,0)")
    below = (F.col(total) + F.lit(add) * F.col(terms_)).cast("decimal(20,0)")
    whole = F.call_function("div", above, below)
    return F.when(below > 0, whole + F.lit(1)).otherwise(F.lit(0)).cast("long")


def bitmaps(cells: DataFrame, by: list[str]) -> DataFrame:
    """``by``, who, n, p, p0, bits: one bitmap of positions for each count of each ``who``.

    ``cells`` has, besides ``by``, who, n, p, p0, pos and size (positions in the block).
    A ``by`` is one block of one tile, so a task's rows are bounded.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["who", "n"], kind="stable", ignore_index=True)
        who, n, pos = rows["who"].to_numpy(), rows["n"].to_numpy(), rows["pos"].to_numpy()
        new = np.concatenate([[True], (who[1:] != who[:-1]) | (n[1:] != n[:-1])])
        level = np.cumsum(new) - 1
        out = rows.loc[new, [*by, "who", "n", "p", "p0"]].copy()
        bits = np.zeros((len(out), -(-int(rows["size"].iloc[0]) // 64) * 8), dtype=np.uint8)
        np.bitwise_or.at(bits, (level, pos >> 3), (1 << (pos & 7)).astype(np.uint8))
        out["bits"] = [b.tobytes() for b in bits]
        return out

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cells.select(*by).schema)
    return cells.groupBy(*by).applyInPandas(run, f"{kinds}, who string, n long, p long, p0 long, bits binary")


def _levels(rows: pd.DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray, int]]:
    """Shares, bitmaps and share of zero for each group."""
    out = {}
    for who, part in rows.groupby("who", sort=False):
        words = np.frombuffer(b"".join(part["bits"]), dtype="<u8").reshape(len(part), -1)
        out[who] = part["p"].to_numpy(), words, int(part["p0"].iloc[0])
    return out


def joint(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many bits each bitmap of ``a`` has in common with each of ``b``."""
    step = max(1, CELLS // max(1, b.size))
    parts = [np.bitwise_count(a[i : i + step, None] & b[None]).sum(axis=2, dtype=np.int64) for i in range(0, len(a), step)]
    return np.concatenate(parts)


def _cells_of(one: tuple, two: tuple) -> int:
    (p, a, p0), (q, b, q0) = one, two
    n = joint(a, b)
    f = np.abs(p[:, None] - q[None]) - np.abs(p - q0)[:, None] - np.abs(p0 - q)[None] + abs(p0 - q0)
    return int((n * f).sum())


def _zeros_of(one: dict, two: dict, v: int) -> int:
    """What the sizes of the bitmaps alone add."""
    base = abs(one["p0"] - two["p0"])
    left = np.dot(one["sizes"], np.abs(one["ps"] - two["p0"]) - base)
    return int(left + np.dot(two["sizes"], np.abs(two["ps"] - one["p0"]) - base)) + v * base


def _tiled(rows: DataFrame) -> DataFrame:
    """Each row once for every pair of tiles that its own is part of."""
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))
    return rows.withColumn("other", other).withColumns(
        {"one": F.least("tile", "other"), "two": F.greatest("tile", "other")}
    )


def _pairs(rows: pd.DataFrame) -> Iterator[tuple[str, str]]:
    """Every pair of a pair of tiles, the smaller name first."""
    tiles = rows.drop_duplicates("who")
    one, two = int(rows["one"].iloc[0]), int(rows["two"].iloc[0])
    left = sorted(tiles.loc[tiles["tile"] == one, "who"])
    right = sorted(tiles.loc[tiles["tile"] == two, "who"])
    for i, a in enumerate(left):
        for b in right[i + 1 :] if one == two else right:
            yield (a, b) if a < b else (b, a)


def audit(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source",
    least_docs: int = 30, scale: int = 1_000_000_000, add: int = 5, top: int = 50,
) -> DataFrame:
    """lang, source, part, item, value, rank: how each source of a language differs.

    A language keeps the terms that at least ``least_docs`` of its documents hold. Part
    ``pair`` ranks all other sources by the sum of f over kept terms, part ``term`` the
    ``top`` kept terms that the source holds and uses more than its language. Ties go to
    the smaller item in UTF-8. Nulls are read as empty, and an empty language or source
    is one like any other; a language without kept terms has pairs of value 0 and no
    terms; repeated rows count again; no rows give none.
    """
    counts = stored(term_counts(docs, text=text, lang=lang, source=source), "divergence-counts")
    by_term = counts.where("term <> ''").groupBy("lang", "term")
    kept = by_term.agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs)
    kept = stored(kept.drop("docs"), "divergence-kept")
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("lang_total"))
    langs = stored(langs, "divergence-langs")  # of known size: the join below need not deal terms out by language
    place = F.pmod(F.xxhash64("term"), F.ceil(F.col("v") / BLOCK))
    block = Window.partitionBy("lang", "block")
    kept = stored(
        kept.join(langs, "lang").withColumn("block", place)
        .withColumns({"pos": F.row_number().over(block.orderBy("term")) - 1, "size": F.count("*").over(block).cast("int")}),
        "divergence-terms",
    )

    held = counts.where("term <> ''").select("lang", "source", "term", "n")
    held = held.join(kept.select("lang", "term", "block", "pos", "size"), ["lang", "term"])
    totals = held.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counts.where("term = ''").select("lang", "source")
    tiles = groups.groupBy("lang").agg(F.ceil(F.count("*") / TILE).alias("tiles"))
    groups = (
        groups.join(totals, ["lang", "source"], "left").join(langs.select("lang", "v"), "lang", "left")
        .na.fill(0, ["total", "v"]).join(tiles, "lang")
        .withColumn("tile", F.pmod(F.xxhash64(F.lit(12), "source"), "tiles"))
        .withColumn("p0", share(F.lit(0).cast("long"), "total", "v", scale, add))
    )
    groups = stored(groups.withColumnRenamed("source", "who"), "divergence-groups")
    cells = held.withColumnRenamed("source", "who").join(groups, ["lang", "who"])
    cells = cells.withColumn("p", share(F.col("n"), "total", "v", scale, add))
    by = ["lang", "block", "tile", "tiles"]
    maps = stored(bitmaps(cells.select(*by, "who", "n", "p", "p0", "pos", "size"), by), "divergence-bitmaps")

    pairs = _pair_sums(maps, groups)
    both = pairs.select("lang", F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("x"), "value")
    pair = both.select("lang", F.col("x.a").alias("source"), F.lit("pair").alias("part"), F.col("x.b").alias("item"), "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pair = pair.withColumn("rank", F.row_number().over(order))

    term = _leading(maps, kept, scale, add, top).join(kept.select("lang", "block", "pos", "term"), ["lang", "block", "pos"])
    term = term.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    term = term.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pair.unionByName(term)


def _pair_sums(maps: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, a, b, value for every pair of sources of a language, a < b."""

    def cells(rows: pd.DataFrame) -> pd.DataFrame:
        levels, lang = _levels(rows), rows["lang"].iloc[0]
        found = [(lang, a, b, _cells_of(levels[a], levels[b])) for a, b in _pairs(rows)]
        return pd.DataFrame(found, columns=["lang", "a", "b", "value"])

    def zeros(rows: pd.DataFrame) -> pd.DataFrame:
        known = {r["who"]: {k: np.asarray(r[k], dtype=np.int64) for k in ("ps", "sizes")} | {"p0": int(r["p0"])}
                 for _, r in rows.iterrows()}
        lang, v = rows["lang"].iloc[0], int(rows["v"].iloc[0])
        found = [(lang, a, b, _zeros_of(known[a], known[b], v)) for a, b in _pairs(rows)]
        return pd.DataFrame(found, columns=["lang", "a", "b", "value"])

    schema = "lang string, a string, b string, value long"
    common = _tiled(maps.drop("n")).groupBy("lang", "block", "one", "two").applyInPandas(cells, schema)
    sizes = maps.groupBy("lang", "who", "n").agg(F.max("p").alias("p"), F.sum(F.bitmap_count("bits")).alias("s"))
    sizes = sizes.groupBy("lang", "who").agg(F.collect_list(F.struct("p", "s")).alias("levels"))
    none = F.array().cast("array<bigint>")
    alone = groups.join(sizes, ["lang", "who"], "left").withColumns(
        {"ps": F.coalesce("levels.p", none), "sizes": F.coalesce("levels.s", none)}
    )
    alone = _tiled(alone.select("lang", "who", "p0", "v", "tile", "tiles", "ps", "sizes"))
    rest = alone.groupBy("lang", "one", "two").applyInPandas(zeros, schema)
    return common.unionByName(rest).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def _leading(maps: DataFrame, kept: DataFrame, scale: int, add: int, top: int) -> DataFrame:
    """lang, source, block, pos, value: each block's ``top`` terms of each source.

    The language's own bitmaps meet the sources'; cells are taken in descending order of
    value until they hold enough terms, ties included, and only those are decoded.
    """
    whole = kept.withColumns({"q": share(F.col("n"), "lang_total", "v", scale, add), "p0": F.lit(0).cast("long"), "who": F.lit("")})
    whole = whole.withColumnRenamed("q", "p").select("lang", "block", "who", "n", "p", "p0", "pos", "size")
    pool = bitmaps(whole, ["lang", "block"])
    wanted = maps.select("lang", "block", "tile").distinct()
    pool = pool.join(wanted, ["lang", "block"])  # a copy for each tile
    pool = pool.toDF(*[f"own_{c}" if c in ("lang", "block", "tile") else c for c in pool.columns])

    def run(rows: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(rows) and len(own):
            lang, block = rows["lang"].iloc[0], int(rows["block"].iloc[0])
            ((q, b, _),) = _levels(own).values()
            for who, (p, a, _) in _levels(rows).items():
                n = joint(a, b)
                i, j = np.nonzero((n > 0) & (p[:, None] > q[None]))
                value = p[i] - q[j]
                order = np.argsort(-value, kind="stable")
                enough = np.searchsorted(np.cumsum(n[i, j][order]), top)
                least = value[order[min(enough, len(order) - 1)]] if len(order) else 0
                found = []
                for k in order[value[order] >= least].tolist():
                    bits = np.unpackbits((a[i[k]] & b[j[k]]).view(np.uint8), bitorder="little")
                    found += [(-int(value[k]), pos) for pos in np.flatnonzero(bits).tolist()]
                out += [(lang, who, block, pos, -minus) for minus, pos in sorted(found)[:top]]
        return pd.DataFrame(out, columns=["lang", "source", "block", "pos", "value"])

    key = ["lang", "block", "tile"]
    schema = "lang string, source string, block long, pos int, value long"
    return maps.groupBy(*key).cogroup(pool.groupBy(*[f"own_{c}" for c in key])).applyInPandas(run, schema)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang", "source"))


_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source
  FROM documents
), words AS (
  SELECT d, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM docs
), kept AS (
  SELECT lang, term, count(*) AS n FROM words GROUP BY ALL HAVING count(DISTINCT d) >= 30
), langs AS (
  SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), held AS (
  SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL
), totals AS (
  SELECT lang, source, sum(n) AS total FROM held GROUP BY ALL
), shares AS (
  SELECT g.lang, g.source, k.term, coalesce(h.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(h.n, 0) + 5)) // (coalesce(t.total, 0) + 5 * l.v) AS p,
         1 + (1000000000::HUGEINT * (k.n + 5)) // (l.total + 5 * l.v) AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
  LEFT JOIN held h ON h.lang = g.lang AND h.source = g.source AND h.term = k.term
  LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value,
       (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)))::INT AS rank
FROM parts QUALIFY part = 'pair' OR rank <= 50
"""

QUERIES = {"op12_source_divergence": op12_source_divergence}
ORACLES = {"op12_source_divergence": _SQL}
