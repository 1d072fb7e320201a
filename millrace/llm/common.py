"""Helpers shared by the operators: reading, vectorized words, and rolling hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text, about, that a bucket of documents holds at most.
BUCKET_BYTES = 32 << 20
#: Bytes of text that are turned into numpy arrays at once.
CHUNK_BYTES = 1 << 20

_MASK = (1 << 64) - 1
_BYTE_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucket_of(buckets: int, *columns: str) -> Column:
    """An even, repeatable number from 0 to `buckets` - 1."""
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")


def text_buckets(docs: DataFrame, least: int) -> int:
    """Buckets for the documents: so many that each holds about BUCKET_BYTES of text, and `least` at least."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(least, -(-size // BUCKET_BYTES))


def utf8(column: str) -> Column:
    """A text as bytes; a null counts as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def lower_ascii(column: Column) -> Column:
    """Lower-case A-Z only, whatever the locale."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: spreads every input bit over all output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse for i < n, modulo 2**64; `base` is odd."""
    if base not in _powers or len(_powers[base][0]) < n:
        size = 1 << max(12, n.bit_length())
        both = []
        for factor in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, factor & _MASK, dtype=np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps))
        _powers[base] = (both[0], both[1])
    up, down = _powers[base]
    return up[:n], down[:n]


def chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive texts of about `limit` bytes; a longer text stands alone."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


class Words:
    """The words `[^\\x20\\x09-\\x0D]+` of some texts as arrays.

    `raw` holds the texts, `start` and `end` the byte span of each word in it, `bound[d]` to
    `bound[d + 1]` the words of text d, and `key` a 64-bit hash of each word.
    """

    def __init__(self, texts: list[bytes], lower: bool = False):
        raw = b"\n".join(texts) + b"\n"
        self.raw = raw.lower() if lower else raw
        data = np.frombuffer(self.raw, dtype=np.uint8)
        space = _SPACE[data]
        before = np.empty_like(space)
        before[0] = True
        before[1:] = space[:-1]
        self.start = np.flatnonzero(~space & before)
        self.end = np.flatnonzero(space & ~before)
        sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
        self.bound = np.searchsorted(self.start, np.concatenate(([0], np.cumsum(sizes))))
        self.key = self._hash(data)

    def _hash(self, data: np.ndarray) -> np.ndarray:
        key = np.empty(len(self.start), dtype=np.uint64)
        done = 0
        while done < len(key):
            first = self.start[done]
            stop = max(np.searchsorted(self.end, first + CHUNK_BYTES, side="right"), done + 1)
            up, down = powers(_BYTE_BASE, int(self.end[stop - 1] - first) + 1)
            part = data[first : self.end[stop - 1]]
            total = np.zeros(len(part) + 1, dtype=np.uint64)
            np.cumsum(_BYTE_CODES[part] * up[: len(part)], out=total[1:])
            begin, end = self.start[done:stop] - first, self.end[done:stop] - first
            key[done:stop] = (total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64)
            done = stop
        return mix(key)

    def __len__(self) -> int:
        return len(self.key)

    def word(self, i: int) -> bytes:
        return self.raw[self.start[i] : self.end[i]]

    def text_of(self) -> np.ndarray:
        """For each word the number of its text."""
        return np.repeat(np.arange(len(self.bound) - 1), np.diff(self.bound))


def rolling(key: np.ndarray, width: int, base: int) -> np.ndarray:
    """A hash of each run of `width` keys; empty if there are fewer."""
    n = len(key) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    up, down = powers(base, len(key))
    total = np.zeros(len(key) + 1, dtype=np.uint64)
    np.cumsum(key * up, out=total[1:])
    return mix((total[width:] - total[:-width]) * down[:n])


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def unsigned(x) -> np.ndarray:
    """An Arrow column of longs as unsigned numbers."""
    return x.to_numpy(zero_copy_only=False).astype(np.int64, copy=False).view(np.uint64)
