"""Byte-level BPE encoding and decoding by folds of ranked merges.

A task splits its texts into words and folds the merges over the bytes of each distinct word once:
as long as some neighbours form a token, those of lowest rank are merged. The ids of the words are
then put together to those of the documents, in the same task; nothing is shuffled. Decoding
concatenates the bytes of each id.

The same fold in Spark's higher-order functions, over a table of distinct words and a literal rank
map, is `encode_words`. It gives the same ids, but takes some 100 microseconds a word against 10
here, so documents aren't encoded by it; the README has the figures.
"""

from __future__ import annotations

import base64
import heapq
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.packing import PATTERN

#: Words a task knows at once; beyond, it forgets all of them and starts anew.
KNOWN_WORDS = 600_000
#: Bytes of a word from which on the next merge is found in a heap; scanning a longer list is slower.
LONG = 100
#: Small maps the rank map is dealt into.
MAPS = 1 << 16

_NONE = 1 << 30
_SIMPLE = r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
#: Letters of which Python's own patterns and Unicode's classes may think otherwise.
_ODD = "[\x1c-\x1f\xb2\xb3\xb9\xbc-\xbeɐ-\U0010ffff]"


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a file of base64 tokens and numbers, one a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def _letters(token: bytes) -> str:
    return token.decode("latin-1")


def rank_of(ranks: dict[bytes, int]):
    """A function from a column of tokens in letters to their ranks, null for what is no token."""
    import xxhash

    maps: list[dict[str, int]] = [{} for _ in range(MAPS)]
    for token, rank in ranks.items():
        letters = _letters(token)
        maps[xxhash.xxh64_intdigest(letters.encode(), 42) % MAPS][letters] = rank
    literal = F.from_json(F.lit(json.dumps(maps)), "array<map<string,int>>")
    return lambda token: F.element_at(F.get(literal, F.pmod(F.xxhash64(token), F.lit(MAPS)).cast("int")), token)


def fold(word: Column, rank) -> Column:
    """The ids of a word in letters: itself if it is a token, else what is left when no merge is."""

    def ranked(parts: Column) -> Column:
        pairs = F.sequence(F.lit(0), F.size(parts) - 2)
        return F.transform(pairs, lambda i: F.coalesce(rank(F.concat(F.get(parts, i), F.get(parts, i + 1))), F.lit(_NONE)))

    def merged(parts: Column, ranks: Column, least: Column) -> Column:
        at = F.array_position(ranks, least).cast("int")
        pair = F.array(F.concat(F.get(parts, at - 1), F.get(parts, at)))
        return F.concat(F.slice(parts, F.lit(1), at - 1), pair, F.slice(parts, at + 2, F.size(parts)))

    def step(state: Column, _: Column) -> Column:
        parts = state["parts"]

        def choose(ranks: Column) -> Column:
            least = F.array_min(ranks)
            done = least == _NONE
            return F.struct(
                F.when(done, parts).otherwise(merged(parts, ranks, least)).alias("parts"), done.alias("done")
            )

        stepped = F.element_at(F.transform(F.array(ranked(parts)), choose), 1)
        return F.when(state["done"] | (F.size(parts) < 2), state).otherwise(stepped)

    start = F.struct(F.split(word, "").alias("parts"), F.lit(False).alias("done"))
    steps = F.sequence(F.lit(2), F.length(word))
    parts = F.when(F.length(word) < 2, F.array(word)).otherwise(F.aggregate(steps, start, step)["parts"])
    whole = rank(word)
    return F.when(whole.isNotNull(), F.array(whole)).otherwise(F.transform(parts, rank))


def encode_words(words: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """`words` with a column `ids`: each `word` folded by higher-order functions; null for null.

    Meant for a table of distinct words. Bytes are written as letters of equal number while they are
    folded. The rank map is dealt into small literal maps by a hash of the token, as Spark searches
    a map from its beginning. Time grows with the square of a word's length.
    """
    letters = F.decode(F.encode("word", "UTF-8"), "ISO-8859-1")
    folded = F.element_at(F.transform(F.array(letters), lambda w: fold(w, rank_of(ranks))), 1)
    return words.withColumn("ids", F.when(F.length("word") == 0, F.array().cast("array<int>")).when(F.col("word").isNotNull(), folded))


def fold_bytes(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of a word: itself if it is a token, else what is left when no merge is."""
    if word in ranks:
        return [ranks[word]]
    if len(word) > LONG:
        return _fold_long(word, ranks)
    rank = ranks.get
    parts = [word[i : i + 1] for i in range(len(word))]
    order = [rank(word[i : i + 2], _NONE) for i in range(len(word) - 1)]
    while order and (least := min(order)) < _NONE:
        i = order.index(least)
        parts[i] += parts.pop(i + 1)
        del order[i]
        if i < len(order):
            order[i] = rank(parts[i] + parts[i + 1], _NONE)
        if i:
            order[i - 1] = rank(parts[i - 1] + parts[i], _NONE)
    return [ranks[p] for p in parts]


def _fold_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """As `fold_bytes`, with the pairs in a heap: time in proportion to n log n."""
    n = len(word)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the part that begins here
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)

    def offer(i: int) -> None:
        if i >= 0 and end[i] < n:
            stop = end[end[i]]
            if (r := ranks.get(word[i:stop])) is not None:
                heapq.heappush(heap, (r, i, stop))

    while heap:
        _, i, stop = heapq.heappop(heap)
        middle = end[i]
        if middle in (0, n) or end[middle] != stop or middle == stop:  # one of the two is gone or has grown
            continue
        end[i], end[middle] = stop, 0
        if stop < n:
            before[stop] = i
        offer(before[i])
        offer(i)
    return [ranks[word[i : end[i]]] for i in range(n) if end[i]]


class _KnownWords(dict):
    """The ids of each word as bytes, folded when it is first asked for."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, word: str) -> bytes:
        found = self[word] = np.array(fold_bytes(word.encode(), self.ranks), dtype="<i4").tobytes()
        return found


def encode(docs: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """(doc_id, ids) of each row, ids an array of the text's tokens; needs doc_id and text.

    `ranks` holds every single byte. A null or empty text has no ids. Repeated rows are encoded each
    for itself, an empty table gives no row. Other columns are ignored, whatever their names.
    """
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"bytes without a rank: {missing[:5]}")
    shipped = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        simple, exact, odd = re.compile(_SIMPLE).findall, regex.compile(PATTERN).findall, re.compile(_ODD).search
        known = _KnownWords(shipped.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, found = batch.slice(at, 256), []
                for text in part.column(1).to_pylist():
                    if len(known) > KNOWN_WORDS:
                        known.clear()
                    words = (exact if odd(text) else simple)(text)
                    found.append(b"".join(map(known.__getitem__, words)))
                offsets = np.concatenate(([0], np.cumsum([len(f) // 4 for f in found]))).astype(np.int32)
                values = np.frombuffer(b"".join(found), dtype="<i4")
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], names=["doc_id", "ids"])

    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(run, "doc_id long, ids array<int>")


def decode_ids(ids: list[int], tokens: list[bytes]) -> bytes:
    return b"".join([tokens[i] for i in ids])


def token_table(ranks: dict[bytes, int]) -> list[bytes]:
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """(doc_id, decoded) of each row of (doc_id, ids); decoded is bytes, empty for null or no ids."""
    shipped = encoded.sparkSession.sparkContext.broadcast(token_table(ranks))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = shipped.value
        for batch in batches:
            found = [decode_ids(ids or [], tokens) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")


def digests(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of (doc_id, ids): checksums of the ids in
    decimal, joined by commas, and of what they decode to."""
    shipped = encoded.sparkSession.sparkContext.broadcast(token_table(ranks))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        tokens = shipped.value
        decimal = [b"%d" % i for i in range(len(tokens))]
        for batch in batches:
            rows = []
            for ids in batch.column(1):
                own = ids.values.to_numpy(zero_copy_only=False).tolist() if ids.is_valid else []
                rows.append((
                    len(own), hashlib.sha256(b",".join([decimal[i] for i in own])).hexdigest(),
                    hashlib.sha256(decode_ids(own, tokens)).hexdigest(),
                ))
            n, a, b = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return encoded.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
