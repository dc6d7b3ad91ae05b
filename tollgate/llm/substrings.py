"""Substring dedup: relative Lempel-Ziv parsing against an index of the whole corpus.

Every document is a reference for the later ones. The index holds anchors: of each
window's word 6-grams the one of least hash (the last, if several), so equal windows
have equal anchors wherever they stand. An anchor's context are all words that a window
with this anchor can hold. Anchors found once in the corpus cannot start a factor. If
all occurrences of an anchor have one context, the first is the reference and the
others copy it as a whole: the inside of a factor. Otherwise contexts part near the
anchor, at a factor's boundary, and each window there is looked up by itself.

Spark counts anchors and finds each key's first occurrence; what a task sends on are
anchors (one for some eight words) and the windows at boundaries. Two Bloom filters of
bounded size tell the second reading of the texts which anchors matter; a false
positive only costs a row, as rows of keys found once are dropped. Documents are then
parsed greedily: at each word the reference that reaches furthest is followed to its
end. Words in factors of a whole window or more are duplicates.

A passage that a thousandth of all anchors are of is looked up in a table that every
task has, of bounded size, and its rows take no part in the join by key.

Equality is that of 128 bits of hash: of the anchor and of the context or window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.session import stored

from .text import SPACES, Hasher, RunningSums, hashed, mixed, rows_of, signed, slices

WINDOW, GRAM = 20, 6
#: 6-grams in a window, and the words of a context on either side of where the gram starts.
GRAMS = WINDOW - GRAM + 1
LEFT, RIGHT = GRAMS - 1, WINDOW
#: Bits of a Bloom filter: twelve for each value up to this bound; beyond, it lets more
#: through, and stays right.
MOST_FILTER_BITS = 1 << 28
PROBES = 3
#: Anchors that are more than one in so many, and their keys of as many rows, are heavy.
HEAVY = 1000

_U = np.uint64
_HASHER = Hasher(5)


def _least(values: np.ndarray) -> np.ndarray:
    """For each run of GRAMS values, the place of the least, the last of equal ones."""
    at, span = np.arange(len(values)), 1
    while span < GRAMS:
        step = min(span, GRAMS - span)
        left, right = at[:-step], at[step:]
        at = np.where(values[right] <= values[left], right, left)
        span += step
    return at


class Anchors:
    """The anchors of several documents' words; ``offsets`` tell where each begins."""

    def __init__(self, words: np.ndarray, offsets: np.ndarray):
        self.offsets = offsets
        n = len(words)
        self.windows = np.zeros(0, np.int64)  # first words
        if n >= WINDOW:
            sums = self.sums = RunningSums(words)
            first = np.arange(n - WINDOW + 1)
            ends = np.repeat(offsets[1:], np.diff(offsets))
            whole = first + WINDOW <= ends[: len(first)]
            grams = sums.of(np.arange(n - GRAM + 1), np.arange(GRAM, n + 1))
            self.windows, self.anchor = first[whole], _least(grams)[whole]
        if not len(self.windows):
            self.places = self.values = self.contexts = np.zeros(0, np.int64)
            return
        # windows of one anchor follow each other
        new = np.concatenate([[True], self.anchor[1:] != self.anchor[:-1]])
        self.places = self.anchor[new]
        self.low = self.windows[new]
        self.high = self.windows[np.concatenate([new[1:], [True]])]
        self.group = np.cumsum(new) - 1
        self.doc = np.searchsorted(offsets, self.places, side="right") - 1
        self.values = grams[self.places]
        a = np.maximum(self.places - LEFT, offsets[self.doc])
        b = np.minimum(self.places + RIGHT, offsets[self.doc + 1])
        cut = (self.places - a).astype(np.uint64) * _U(64) + (b - self.places).astype(np.uint64)
        self.contexts = mixed(sums.of(a, b) + cut)


def _documents(batch: pa.RecordBatch) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """doc_ids, words and offsets of several documents at a time; those without a doc_id
    have no words."""
    ids, rows = batch.column("doc_id").to_pylist(), rows_of(batch.column("text"))
    rows = [r if i is not None else b"" for i, r in zip(ids, rows, strict=True)]
    for first, (words,), offsets in hashed(rows, [_HASHER], SPACES):
        yield ids[first : first + len(offsets) - 1], words, offsets


def _bits(values: np.ndarray, size: int) -> np.ndarray:
    """Places of values in a filter of ``size`` bits, PROBES rows."""
    step = mixed(values + _U(5)) | _U(1)
    return np.array([(values + _U(i) * step) % _U(size) for i in range(PROBES)])


def _filter(values: DataFrame, n: int) -> np.ndarray:
    """A Bloom filter of the column ``value``, as bytes. Tasks make partial filters' set
    words, Spark ORs them; the driver gets at most MOST_FILTER_BITS bits."""
    size = min(MOST_FILTER_BITS, 1 << max(12, int(12 * n).bit_length()))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            at = np.unique(_bits(batch.column("value").to_numpy().view(np.uint64), size))
            word, bit = at >> _U(6), _U(1) << (at & _U(63))
            heads = np.flatnonzero(np.diff(word, prepend=_U(size)))
            bits = np.bitwise_or.reduceat(bit, heads) if len(heads) else bit
            yield pa.RecordBatch.from_pydict({"word": signed(word[heads]), "bits": signed(bits)})

    table = values.mapInArrow(words, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(size >> 6, dtype=np.int64)
    out[table["word"].to_numpy()] = table["bits"].to_numpy()
    return out


def _passing(values: np.ndarray, bloom: np.ndarray) -> np.ndarray:
    filled = bloom.view(np.uint64)
    at = _bits(values, len(bloom) * 64)
    return (filled[at >> _U(6)] >> (at & _U(63)) & _U(1)).all(axis=0)


def units(docs: DataFrame) -> DataFrame:
    """doc_id, low, high, ref_doc, ref_low: ranges of words that an earlier range equals.

    ``docs`` has long doc_ids and texts. Of whole copies every anchor has one context, so
    a copy costs a row for each anchor, not for each window.
    """

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for _, words, offsets in _documents(batch):
                own = Anchors(words, offsets)
                if len(own.places):
                    yield pa.RecordBatch.from_pydict({"value": signed(own.values), "context": signed(own.contexts)})

    found = (
        docs.mapInArrow(index, "value long, context long")
        .groupBy("value")
        .agg(F.count("*").alias("n"), F.min("context").alias("least"), F.max("context").alias("most"))
    )
    repeated = stored(found.where("n > 1").select("value", "n", (F.col("least") == F.col("most")).alias("same")), "substring-anchors")
    n, n_parted, total = repeated.agg(F.count("*"), F.count_if(~F.col("same")), F.coalesce(F.sum("n"), F.lit(0))).first()
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(
        (_filter(repeated.select("value"), n), _filter(repeated.where("NOT same").select("value"), n_parted))
    )

    def occurrences(batches: Iterator[pa.RecordBatch], only: np.ndarray | None, known: Known | None) -> Iterator[pa.RecordBatch]:
        again, parted = shared.value
        for batch in slices(batches):
            for ids, words, offsets in _documents(batch):
                own = Anchors(words, offsets)
                if not len(own.places):
                    continue
                ids = np.array([-1 if i is None else i for i in ids], dtype=np.int64)
                some = _passing(own.values, again) if only is None else np.isin(own.values, only)
                apart = some & _passing(own.values, parted)
                whole = np.flatnonzero(some & ~apart)
                split = np.flatnonzero(apart[own.group])  # windows
                group, low = own.group[split], own.windows[split]
                doc = np.concatenate([own.doc[whole], own.doc[group]])
                before = offsets[doc]
                one = np.concatenate([own.values[whole], own.values[group]])
                two = np.concatenate([own.contexts[whole], own.sums.of(low, low + WINDOW)])
                at = np.concatenate([own.low[whole], low]) - before
                to = np.concatenate([own.high[whole], low]) + WINDOW - before
                found = {"doc_id": pa.array(ids[doc]), "low": pa.array(at.astype(np.int32)), "high": pa.array(to.astype(np.int32))}
                ref_doc, ref_low, open_ = known.of(one, two) if known else (np.zeros(len(one), np.int64), np.zeros(len(one), np.int32), np.ones(len(one), bool))
                # a row that is answered needs no key: a random one takes it to any task
                one = np.where(open_, one, mixed(ids[doc].view(np.uint64) + at.astype(np.uint64)))
                keys = {"one": pa.array(signed(one)), "two": pa.array(signed(two))}
                refs = {"own_doc": pa.array(ref_doc, mask=open_), "own_low": pa.array(ref_low, mask=open_)}
                yield pa.RecordBatch.from_pydict(keys | found | refs)

    def rows(only: np.ndarray | None = None, known: Known | None = None) -> DataFrame:
        schema = "one long, two long, doc_id long, low int, high int, own_doc long, own_low int"
        return docs.mapInArrow(lambda batches: occurrences(batches, only, known), schema)

    # read again rather than stored: windows are many, and hashing them again is cheap
    place = F.struct("doc_id", "low")
    agg = [F.min(place).alias("first"), F.max(place).alias("last"), F.count("*").alias("n")]
    ref = [F.col("first.doc_id").alias("ref_doc"), F.col("first.low").alias("ref_low")]
    firsts = rows().groupBy("one", "two").agg(*agg[:2]).where("first < last").select("one", "two", *ref)
    heavy = [r["value"] for r in repeated.where(F.col("n") * HEAVY > total).select("value").collect()]  # fewer than HEAVY
    known = None
    if heavy:
        hot = rows(only=np.array(heavy, dtype=np.int64).view(np.uint64)).groupBy("one", "two").agg(*agg)
        known = Known(hot.where((F.col("n") * HEAVY > total) & (F.col("first") < F.col("last"))).select("one", "two", *ref).toArrow())
    both = rows(known=known).join(firsts, ["one", "two"], "left")
    both = both.withColumns({"ref_doc": F.coalesce("own_doc", "ref_doc"), "ref_low": F.coalesce("own_low", "ref_low")})
    later = (F.col("doc_id") > F.col("ref_doc")) | ((F.col("doc_id") == F.col("ref_doc")) & (F.col("low") > F.col("ref_low")))
    return both.where(later).select("doc_id", "low", "high", "ref_doc", "ref_low")


class Known:
    """First occurrences of heavy keys: fewer than HEAVY for each window of an anchor."""

    def __init__(self, table: pa.Table):
        one, two = (table[c].to_numpy().view(np.uint64) for c in ("one", "two"))
        order = np.argsort(self.key(one, two))
        self.one, self.two, self.keys = one[order], two[order], self.key(one, two)[order]
        self.doc, self.low = table["ref_doc"].to_numpy()[order], table["ref_low"].to_numpy()[order]

    @staticmethod
    def key(one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return mixed(one ^ mixed(two))

    def of(self, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document and place of the first occurrence, and which rows are not answered."""
        if not len(self.keys):
            return np.zeros(len(one), np.int64), np.zeros(len(one), np.int32), np.ones(len(one), bool)
        at = np.minimum(np.searchsorted(self.keys, self.key(one, two)), len(self.keys) - 1)
        return self.doc[at], self.low[at], (self.one[at] != one) | (self.two[at] != two)


def parse(ranges: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Factors (start, length, ref_doc, ref_start) from ranges (low, high, ref_doc, ref_low).

    Ranges that follow each other in one reference are one; at each word not yet
    covered, the one that reaches furthest is taken, from where the last factor ended.
    """
    runs: dict[tuple[int, int], list[list[int]]] = {}
    for low, high, doc, ref in sorted(ranges):
        own = runs.setdefault((doc, ref - low), [])
        if own and low <= own[-1][1]:
            own[-1][1] = max(own[-1][1], high)
        else:
            own.append([low, high])
    flat = sorted((low, high, doc, shift) for (doc, shift), own in runs.items() for low, high in own)
    out, at, k = [], 0, 0
    best: tuple[int, int, int] | None = None  # reaches, doc, shift
    while True:
        while k < len(flat) and flat[k][0] <= at:
            low, high, doc, shift = flat[k]
            if best is None or high > best[0]:
                best = (high, doc, shift)
            k += 1
        if best is not None and best[0] > at:
            out.append((at, best[0] - at, best[1], best[2] + at))
            at = best[0]
        elif k < len(flat):
            at = flat[k][0]
        else:
            return out


def factors(docs: DataFrame) -> DataFrame:
    """doc_id and ``ranges`` of each document that has copied ranges: struct<span, ref_doc,
    ref_low>, a span being low * 2 ** 32 + high."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    span = F.shiftleft(F.col("low").cast("long"), 32) + F.col("high")
    return units(docs).groupBy("doc_id").agg(
        F.collect_list(F.struct(span.alias("span"), "ref_doc", "ref_low")).alias("ranges")
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words that stay) and factors of each row.

    A word goes if a window of WINDOW words that covers it also starts earlier, in a
    document of smaller doc_id or earlier in its own; windows are those of the input. A
    null text has no words. A row without a doc_id keeps all words and is no reference.
    Rows that repeat a doc_id and its text are one document and come out alike; of rows
    that share a doc_id with different texts, each loses what any of them repeats. No
    rows give no rows.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    joined = texts.join(factors(docs), "doc_id", "left")
    part = "array<struct<start:int,length:int,ref_doc:bigint,ref_start:int>>"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("ref_doc", pa.int64()), ("ref_start", pa.int32())]))
        for batch in slices(batches):
            n, gone, kept, parsed = [], [], [], []
            ranges = batch.column("ranges")
            ends, flat = ranges.offsets.to_numpy(), [ranges.values.field(i).to_numpy() for i in range(3)]
            for k, text in enumerate(rows_of(batch.column("text"))):
                words = text.split()  # of bytes: at 0x20 and 0x09 to 0x0D
                span, ref_doc, ref_low = (c[ends[k] : ends[k + 1]] for c in flat)
                columns = (span >> 32, span & 0xFFFFFFFF, ref_doc, ref_low)
                out = parse(list(zip(*[c.tolist() for c in columns], strict=True)))
                stay, at = [], 0
                for start, length, _, _ in out:
                    stay += words[at:start]
                    at = start + length
                stay += words[at:]
                n.append(len(words))
                gone.append(len(words) - len(stay))
                kept.append(b" ".join(stay).decode())
                parsed.append([dict(zip(("start", "length", "ref_doc", "ref_start"), f, strict=True)) for f in out])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string()), pa.array(parsed, kind)],
                ["doc_id", "n_words", "n_removed", "kept", "factors"],
            )

    return joined.mapInArrow(cut, f"doc_id long, n_words long, n_removed long, kept string, factors {part}")


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = deduplicated(docs)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


_SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS t
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM words WHERE len(w) >= 20)
), later AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY t ORDER BY doc_id, i) AS n FROM windows)
  WHERE n > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM later
), spread AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM words
), kept AS (
  SELECT s.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY s.p) AS t
  FROM spread s ANTI JOIN gone g ON g.doc_id = s.doc_id AND g.p = s.p GROUP BY s.doc_id
)
SELECT w.doc_id, len(w.w) AS n_words, len(w.w) - coalesce(k.n, 0) AS n_removed,
       sha256(coalesce(k.t, '')) AS kept_sha256
FROM words w LEFT JOIN kept k USING (doc_id)
"""

QUERIES = {"op5_substrings": op5_substrings}
ORACLES = {"op5_substrings": _SQL}
