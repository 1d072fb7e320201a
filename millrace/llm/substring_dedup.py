"""Substring dedup: seed, extend, and cut every repeat of at least 35 words.

Seeds are winnowed anchors. Of the 16-word runs inside a window of 35 words the one with the
smallest hash (the leftmost of equal ones) is the window's anchor, so equal windows have equal
anchors at equal places, while only about one run in ten is an anchor at all. Documents meet on
equal anchors. Each seed that occurs twice is then extended to both sides, over all windows whose
anchor it is: its partners are again joined on the extended text, and what still has a partner is
a repeat. Overlapping repeats of a document are merged to maximal ones, which are removed.

No pair of occurrences is ever formed. Documents are dealt into even buckets; a bucket names each
of its anchors or windows once, so a passage held by a third of all documents costs one row per
bucket. Which keys are repeated goes back to the buckets that named them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import Words, bucket_of, chunks, rolling, shuffle_partitions, signed, text_buckets, unsigned, utf8

#: Words of a window; a repeat is at least so long.
WINDOW = 35
#: Words of an anchor.
ANCHOR = 16

_ANCHOR_BASE = 0xA0761D6478BD642F
_WINDOW_BASES = (0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)


class _Windows:
    """The windows of some texts: `start` (first word), and for each the key of its anchor."""

    def __init__(self, words: Words, window: int, anchor: int):
        last = np.repeat(words.bound[1:], np.diff(words.bound)) - window
        n = max(len(words) - window + 1, 0)
        self.start = np.flatnonzero(np.arange(n) <= last[:n])
        self._key, self._window = words.key, window
        self._runs = rolling(words.key, anchor, _ANCHOR_BASE)
        self._places = window - anchor + 1

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """For each window the place of its anchor, and for each place the key of the run there."""
        if not len(self.start):
            return self.start, self._runs
        views = np.lib.stride_tricks.sliding_window_view(self._runs, self._places)
        least = np.empty(len(views), dtype=np.int64)
        for at in range(0, len(views), 1 << 16):
            least[at : at + (1 << 16)] = views[at : at + (1 << 16)].argmin(axis=1)
        return self.start + least[self.start], self._runs

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Two independent hashes of each window."""
        first, second = (rolling(self._key, self._window, base) for base in _WINDOW_BASES)
        return first[self.start], second[self.start]


def _named(first: np.ndarray, second: np.ndarray, bucket: int) -> pa.Table:
    """Each key once, and whether it occurred more than once in this bucket."""
    order = np.lexsort((second, first))
    first, second = first[order], second[order]
    new = np.ones(len(first), dtype=bool)
    new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(first)))
    return pa.table({
        "bucket": pa.array(np.full(len(at), bucket, dtype=np.int32)),
        "k1": pa.array(signed(first[at])), "k2": pa.array(signed(second[at])), "again": pa.array(times > 1),
    })


_NAMED = "bucket int, k1 long, k2 long, again boolean"


def _repeated(named: DataFrame) -> DataFrame:
    """The named keys that occur more than once anywhere, for each bucket that named them."""
    same = Window.partitionBy("k1", "k2")
    counted = named.withColumn("n", F.count(F.lit(1)).over(same))
    return counted.filter((F.col("n") > 1) | F.col("again")).select("bucket", "k1", "k2")


def _cut(docs: DataFrame, window: int, anchor: int, schema: str, keep: list[str]) -> DataFrame:
    """`docs` holds text (bytes), bucket and the columns `keep`, which are passed through."""
    if not 0 < anchor <= window:
        raise ValueError("an anchor has at least one word, and no more than a window")

    def seeds(table: pa.Table) -> pa.Table:
        texts, found = table["text"].to_pylist(), [np.empty(0, dtype=np.uint64)]
        for lo, hi in chunks(texts):
            place, runs = _Windows(Words(texts[lo:hi]), window, anchor).anchors()
            found.append(runs[np.unique(place)])
        first = np.concatenate(found)
        return _named(first, np.zeros_like(first), table["bucket"][0].as_py())

    def extend(table: pa.Table, known: pa.Table) -> pa.Table:
        texts, seed = table["text"].to_pylist(), np.sort(unsigned(known["k1"]))
        found = [(np.empty(0, dtype=np.uint64),) * 2]
        for lo, hi in chunks(texts) if len(seed) else ():
            windows = _Windows(Words(texts[lo:hi]), window, anchor)
            place, runs = windows.anchors()
            if len(place):
                keys, at = runs[place], np.minimum(np.searchsorted(seed, runs[place]), len(seed) - 1)
                hit = seed[at] == keys
                found.append(tuple(k[hit] for k in windows.keys()))
        first, second = (np.concatenate(x) for x in zip(*found, strict=True))
        return _named(first, second, table["bucket"][0].as_py() if len(table) else 0)

    def remove(table: pa.Table, known: pa.Table) -> pa.Table:
        texts = table["text"].to_pylist()
        k1, k2 = unsigned(known["k1"]), unsigned(known["k2"])
        order = np.lexsort((k2, k1))
        k1, k2 = k1[order], k2[order]
        total, removed, kept = [], [], []
        for lo, hi in chunks(texts):
            words = Words(texts[lo:hi])
            windows = _Windows(words, window, anchor)
            edge = np.zeros(len(words) + 1, dtype=np.int32)
            if len(k1) and len(windows.start):
                first, second = windows.keys()
                hit = np.zeros(len(first), dtype=bool)
                at, end = np.searchsorted(k1, first, side="left"), np.searchsorted(k1, first, side="right")
                while (open_ := np.flatnonzero(at < end)).size:
                    hit[open_] |= k2[at[open_]] == second[open_]
                    at[open_] += 1
                begin = windows.start[hit]
                np.add.at(edge, begin, 1)
                np.add.at(edge, begin + window, -1)
            keep_word = np.cumsum(edge[:-1]) == 0
            for d in range(hi - lo):
                a, b = words.bound[d], words.bound[d + 1]
                own = keep_word[a:b]
                left = texts[lo + d].split()
                if not own.all():
                    left = [left[i] for i in np.flatnonzero(own)]
                total.append(b - a)
                removed.append(b - a - len(left))
                kept.append(b" ".join(left))
        out = table.drop_columns(["text", "bucket"]).append_column("n_words", pa.array(total, pa.int64()))
        out = out.append_column("n_removed", pa.array(removed, pa.int64()))
        return out.append_column("kept_text", pa.array(kept, pa.binary()).cast(pa.string()))

    by_bucket = docs.groupBy("bucket")
    repeated_seeds = _repeated(by_bucket.applyInArrow(seeds, _NAMED))
    windows = by_bucket.cogroup(repeated_seeds.groupBy("bucket")).applyInArrow(extend, _NAMED)
    repeats = _repeated(windows)
    return by_bucket.cogroup(repeats.groupBy("bucket")).applyInArrow(
        remove, f"{schema}, n_words long, n_removed long, kept_text string"
    ).select(*keep, "n_words", "n_removed", "kept_text")


def _buckets(docs: DataFrame) -> int:
    return text_buckets(docs, 2 * shuffle_partitions(docs.sparkSession))


def substring_dedup(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed and kept_text, its words outside all repeats.

    A word goes if a window of `window` words that covers it also starts anywhere else, in the
    same document too; all copies of a repeat go. Repeated rows are documents of their own, so a
    repeated row of `window` words or more loses all of them. A null text has no words, a text of
    fewer than `window` words keeps all, an empty table gives an empty one. Other columns are
    ignored, whatever their names.
    """
    buckets = _buckets(docs)
    dealt = docs.select("doc_id", utf8("text").alias("text"), bucket_of(buckets, "doc_id", "text").alias("bucket"))
    return _cut(dealt, window, anchor, "doc_id long", ["doc_id"])


def without_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """`docs` with all repeats cut from its texts, columns as before.

    A text without a repeat stays as it is, white space included; of others the kept words are
    joined by spaces, and n_chars follows. A document of which nothing is left goes.
    """
    buckets = _buckets(docs)
    others = [c for c in docs.columns if c != "text"]
    dealt = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in others], F.col("text").alias("text")).alias("row"),
        utf8("text").alias("text"), bucket_of(buckets, "doc_id", "text").alias("bucket"),
    )
    kind = dealt.schema["row"].dataType.simpleString()
    cut = _cut(dealt, window, anchor, f"row {kind}", ["row"])
    cut = cut.filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("row.text"))
    new = {"text": text, "n_chars": F.length(text).cast(dict(docs.dtypes).get("n_chars", "long"))}
    return cut.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
