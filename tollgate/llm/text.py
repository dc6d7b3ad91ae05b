"""Words and hashes of whole texts, in numpy, for use inside Spark tasks.

A word is a maximal run of bytes that are no separators. Words are hashed from the
bytes of many rows at once: a polynomial over random values of the bytes, summed
along the buffer, gives every word's hash as a difference of two sums. Work is
done in pieces of bounded size, so memory follows the piece (or one word, if that
is longer), never the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes, and rows, worked on at once.
PIECE = 1 << 18
ROWS = 1000

SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True

#: Everything in ASCII but letters and digits.
MARKS = np.ones(256, dtype=bool)
MARKS[128:] = False
for _c in b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789":
    MARKS[_c] = False

_U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of each value spread over all its bits."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x *= _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(33)
    return x


class Hasher:
    """Hashes words to 64 bits; another seed gives an independent hash."""

    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(1_000_003 + seed)
        self.values = rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)

    def __call__(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return RunningSums(self.values[buf]).of(starts, ends)


class RunningSums:
    """Hashes of ranges of a sequence of values, as differences of its running sums."""

    base = 0x9E3779B97F4A7C15
    powers = inverses = np.ones(1, np.uint64)  # shared by all

    def __init__(self, values: np.ndarray):
        n = len(values) + 1
        if len(RunningSums.powers) < n:
            RunningSums.powers, RunningSums.inverses = (
                np.multiply.accumulate(np.concatenate([np.ones(1, _U), np.full(n, x, _U)]))
                for x in (self.base, pow(self.base, -1, 2**64))
            )
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(values * RunningSums.powers[: n - 1], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * RunningSums.inverses[starts])


def edges(buf: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a buffer start and end."""
    inside = np.zeros(len(buf) + 2, dtype=np.int8)
    inside[1:-1] = ~separators[buf]
    at = np.flatnonzero(np.diff(inside))
    return at[::2], at[1::2]


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, a few at a time: what is made of them stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)
        del batch
        pa.default_memory_pool().release_unused()


def rows_of(column: pa.Array) -> list[bytes]:
    """The rows of a string column as bytes; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def hashed(
    rows: list[bytes], hashers: list[Hasher], separators: np.ndarray = SPACES
) -> Iterator[tuple[int, list[np.ndarray], np.ndarray]]:
    """The word hashes of rows, several rows at a time.

    Yields the first row's number, one array of hashes for each hasher, and the
    offsets at which each row's words begin, with the end as the last.
    """
    i = 0
    while i < len(rows):
        j, size = i, 0
        while j < len(rows) and (j == i or size + len(rows[j]) < PIECE):
            size += len(rows[j]) + 1
            j += 1
        if size <= 2 * PIECE:
            lengths = np.fromiter((len(x) + 1 for x in rows[i:j]), np.int64, j - i)
            buf = np.frombuffer(b"\n".join(rows[i:j]), dtype=np.uint8)
            starts, ends = edges(buf, separators)
            offsets = np.searchsorted(starts, np.concatenate([[0], np.cumsum(lengths)]))
            yield i, [h(buf, starts, ends) for h in hashers], offsets
        else:
            parts = [_long(rows[i], h, separators) for h in hashers]
            yield i, parts, np.array([0, len(parts[0])])
        i = j


def _long(row: bytes, hasher: Hasher, separators: np.ndarray) -> np.ndarray:
    buf, at, out = np.frombuffer(row, dtype=np.uint8), 0, []
    while at < len(buf):
        end = min(at + PIECE, len(buf))
        while end < len(buf):  # on to the end of the word
            stop = np.flatnonzero(separators[buf[end : end + PIECE]])
            if len(stop):
                end += int(stop[0])
                break
            end = min(end + PIECE, len(buf))
        out.append(hasher(buf[at:end], *edges(buf[at:end], separators)))
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's signed longs."""
    return x.view(np.int64)
