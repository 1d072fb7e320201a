"""Spelling variants: words one edit apart, found by probing edits against Bloom filters.

Each word of the vocabulary generates its edits and probes them against blocked Bloom filters, one
shard a word length, that Spark builds from the vocabulary and broadcasts. A replaced letter is only
tried upwards and a deleted one only from the longer word, so that each pair is found once; an insertion
is a deletion seen from the other side. Only positives are shuffled to a join with the vocabulary,
which removes the false ones.

Filters have a fixed number of bits a word. Those that don't fit FILTER_BYTES together are probed in several
passes, each with its own broadcast, and a shard that is too large for one pass is cut by a hash of the
word. Hence a broadcast never grows with the vocabulary.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import lower_ascii, mix, powers, signed
from millrace.session import materialize

#: What a word is made of.
RUN = "[A-Za-z\\u00C0-\\u00FF]+"
#: Letters after lower-casing A-Z, in the order of their code points.
ALPHABET = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)], dtype=np.int64)
#: Of how many hashes one drops a letter of its run.
DROP = 97
LEAST_LENGTH = 5
LEAST_COUNT = 3
#: A form occurs this many times as often as the word it stands for, at least.
FORM_RATIO = 2

#: Bytes of the filters that are broadcast at once.
FILTER_BYTES = 64 << 20
#: Bits of filter for each word.
BITS = 16
#: 64-byte blocks of a filter that one task builds.
PIECE_BLOCKS = 1 << 14
#: Words whose edits one task probes, about.
TASK_WORDS = 20_000
#: Probes that are hashed at once.
PROBES = 1 << 19

_BASE = 0x9E3779B97F4A7C15
_WORDS_A_BLOCK = 8


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of all texts: lower-cased runs, one letter dropped where DROP divides the hash of doc_id and run.

    A null text has no word, a null doc_id drops no letter. All in the JVM; repeated words are added up
    before the shuffle.
    """
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"({RUN})"), F.lit(1))).alias("run"))
    runs = runs.select("doc_id", lower_ascii(F.col("run")).alias("run"))
    h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("run")).cast("binary"))
    at = F.pmod(h, F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.pmod(h, F.lit(DROP)) == 0, cut).otherwise(F.col("run"))
    long = runs.select(F.when(h.isNull(), F.col("run")).otherwise(word).alias("word")).filter(F.length("word") >= LEAST_LENGTH)
    return long.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def _letters(words: list[str]) -> np.ndarray:
    """Words of one length as rows of code points."""
    return np.array([list(w.encode("latin-1")) for w in words], dtype=np.int64)


_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def word_hash(letters: np.ndarray) -> np.ndarray:
    """A sum of one term a letter and place, so that the hash of an edit follows from the word's."""
    up, _ = powers(_BASE, letters.shape[1])
    return (_CODES[letters] * up).sum(axis=1, dtype=np.uint64)


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, letters) of the words of each length."""
    length = np.fromiter(map(len, words), np.int64, len(words))
    for own in np.unique(length).tolist():
        at = np.flatnonzero(length == own)
        for some in np.array_split(at, max(1, len(at) * max(own, len(ALPHABET)) // PROBES)):
            yield own, some, _letters([words[i] for i in some])


class Shard:
    """How the filter of the words of one length is laid out: in `parts`, each of `blocks` blocks of 64 bytes."""

    def __init__(self, length: int, blocks: int, parts: int):
        self.length, self.blocks, self.parts = length, blocks, parts

    @classmethod
    def sized(cls, length: int, words: int, most_bytes: int) -> Shard:
        blocks = max(1, -(-words * BITS // 512))
        parts = -(-blocks * 64 // most_bytes)
        return cls(length, -(-blocks // parts), parts)

    def place(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The part and the block of each key, of a mixed word hash."""
        high = key >> np.uint64(32)
        part = (high & np.uint64(0xFFFF)) % np.uint64(self.parts)
        return part.astype(np.int64), ((high >> np.uint64(3)) * np.uint64(self.blocks) >> np.uint64(29)).astype(np.int64)


def _lanes(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Two words of a block and the three bits to be set in each."""
    one, low = np.uint64(1), mix(key ^ np.uint64(_BASE))

    def bits(shift: int) -> np.ndarray:
        out = np.zeros(len(low), np.uint64)
        for i in range(3):
            out |= one << ((low >> np.uint64(shift + 6 * i)) & np.uint64(63))
        return out

    first = (low >> np.uint64(36)) & np.uint64(7)
    second = (first + one + ((low >> np.uint64(39)) & np.uint64(3))) & np.uint64(7)
    return first.astype(np.int64), bits(0), second.astype(np.int64), bits(18)


def passes(counts: dict[int, int], most_bytes: int = FILTER_BYTES) -> list[list[tuple[Shard, int]]]:
    """The shards and parts whose filters are probed together; each pass has `most_bytes` of them at most."""
    found: list[list[tuple[Shard, int]]] = []
    room = 0
    for length in sorted(counts):
        shard = Shard.sized(length, counts[length], most_bytes)
        for part in range(shard.parts):
            if shard.blocks * 64 > room or not found:
                found.append([])
                room = most_bytes
            found[-1].append((shard, part))
            room -= shard.blocks * 64
    return found


def _filters(words: DataFrame, group: list[tuple[Shard, int]]) -> dict[tuple[int, int], np.ndarray]:
    """The blocks of each shard and part: built piece by piece in tasks, then gathered; bounded by FILTER_BYTES."""
    wanted = {(shard.length, part): shard for shard, part in group}
    shards = {shard.length: shard for shard, _ in group}

    def keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, _, letters in _by_length(batch.column(0).to_pylist()):
                key = mix(word_hash(letters))
                part, block = shards[length].place(key)
                keep = np.isin(part, [p for n, p in wanted if n == length])
                n = int(keep.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, length, np.int32)), pa.array(part[keep].astype(np.int32)),
                     pa.array((block[keep] // PIECE_BLOCKS).astype(np.int32)), pa.array(signed(key[keep]))],
                    names=["length", "part", "piece", "key"],
                )

    def build(table: pa.Table) -> pa.Table:
        length, part, piece = (table.column(i)[0].as_py() for i in range(3))
        key = np.asarray(table.column(3)).view(np.uint64)
        _, block = shards[length].place(key)
        bits = np.zeros(PIECE_BLOCKS * _WORDS_A_BLOCK, np.uint64)
        at = (block - piece * PIECE_BLOCKS) * _WORDS_A_BLOCK
        first, low, second, high = _lanes(key)
        np.bitwise_or.at(bits, at + first, low)
        np.bitwise_or.at(bits, at + second, high)
        return pa.table({"length": pa.array([length], pa.int32()), "part": pa.array([part], pa.int32()),
                         "piece": pa.array([piece], pa.int32()), "bits": pa.array([bits.tobytes()], pa.binary())})

    own = words.filter(F.length("word").isin(list(shards))).select("word")
    built = own.mapInArrow(keys, "length int, part int, piece int, key long").groupBy("length", "part", "piece")
    blocks = {k: np.zeros(-(-s.blocks // PIECE_BLOCKS) * PIECE_BLOCKS * _WORDS_A_BLOCK, np.uint64) for k, s in wanted.items()}
    size = PIECE_BLOCKS * _WORDS_A_BLOCK
    for row in built.applyInArrow(build, "length int, part int, piece int, bits binary").toLocalIterator():
        blocks[row.length, row.part][row.piece * size : (row.piece + 1) * size] = np.frombuffer(row.bits, np.uint64)
    return {k: b[: wanted[k].blocks * _WORDS_A_BLOCK] for k, b in blocks.items()}


def _held(shard: Shard, filters: dict[int, np.ndarray], key: np.ndarray) -> np.ndarray:
    """The places of the keys that may be words of this length; `filters` are those of some of its parts."""
    part, block = shard.place(key)
    out = []
    for own, bits in filters.items():
        at = np.arange(len(key)) if shard.parts == 1 else np.flatnonzero(part == own)
        for step in (0, 2):  # the second word of a block is only looked at where the first has all its bits
            lanes = _lanes(key[at])
            mask = lanes[step + 1]
            at = at[bits[block[at] * _WORDS_A_BLOCK + lanes[step]] & mask == mask]
        out.append(at)
    return np.concatenate(out)


def _deletions(letters: np.ndarray) -> np.ndarray:
    """The hash of each word without each of its letters."""
    n, length = letters.shape
    up, _ = powers(_BASE, length)
    code = _CODES[letters]
    before = np.zeros((n, length + 1), np.uint64)
    np.cumsum(code * up, axis=1, out=before[:, 1:])
    moved = np.zeros((n, length), np.uint64)  # letters from the second on, one place to the left
    np.cumsum(code[:, 1:] * up[: length - 1], axis=1, out=moved[:, 1:])
    return before[:, :length] + (moved[:, -1:] - moved)


def near_pairs(words: DataFrame, most_bytes: int = FILTER_BYTES) -> DataFrame:
    """(word, edit): pairs of distinct `word`s one edit apart, each once; needs letters up to U+00FF."""
    spark = words.sparkSession
    counts = {r.length: r.n for r in words.groupBy(F.length("word").alias("length")).agg(F.count(F.lit(1)).alias("n")).collect()}
    tasks = max(spark.sparkContext.defaultParallelism, sum(counts.values()) // TASK_WORDS)
    found = None
    for group in passes(counts, most_bytes):
        bits = _filters(words, group)
        shards = {shard.length: shard for shard, _ in group}
        lengths = sorted({own for length in shards for own in (length, length + 1)} & set(counts))
        prober = _prober(shards, spark.sparkContext.broadcast(bits))
        own = words.filter(F.length("word").isin(lengths)).select("word").repartition(tasks)
        probed = own.mapInArrow(prober, "word string, edit string")
        found = probed if found is None else found.union(probed)
    if found is None:
        return words.select("word", F.col("word").alias("edit")).limit(0)
    return found.join(words.select(F.col("word").alias("edit")), "edit").select("word", "edit")


def _prober(shards: dict[int, Shard], shipped):
    """A function over batches of words that gives (word, edit) of the edits that may be words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters: dict[int, dict[int, np.ndarray]] = {}
        for (length, part), bits in shipped.value.items():
            filters.setdefault(length, {})[part] = bits

        def rows(words: list[str], found: list[tuple[int, str]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([words[i] for i, _ in found], pa.string()), pa.array([e for _, e in found], pa.string())],
                names=["word", "edit"],
            )

        for batch in batches:
            words = batch.column(0).to_pylist()
            for length, places, letters in _by_length(words):
                up, _ = powers(_BASE, length)
                if length - 1 in shards:
                    keys, first = _deletions(letters), np.ones(letters.shape, bool)
                    first[:, 1:] = letters[:, 1:] != letters[:, :-1]  # of a run of equal letters one deletion is enough
                    row, at = np.nonzero(first)
                    hit = _held(shards[length - 1], filters[length - 1], mix(keys[row, at]))
                    yield rows(words, [
                        (i, words[i][:a] + words[i][a + 1 :]) for i, a in zip(places[row[hit]].tolist(), at[hit].tolist(), strict=True)
                    ])
                if length in shards:
                    whole = word_hash(letters)
                    step = max(1, PROBES // (len(places) * len(ALPHABET)))
                    for a in range(0, length, step):
                        part = letters[:, a : a + step]
                        # place by place each greater letter
                        row, at, letter = np.nonzero(part[:, :, None] < ALPHABET[None, None, :])
                        changed = (_CODES[ALPHABET[letter]] - _CODES[part[row, at]]) * up[a + at]
                        hit = _held(shards[length], filters[length], mix(whole[row] + changed))
                        yield rows(words, [
                            (i, words[i][:p] + chr(c) + words[i][p + 1 :])
                            for i, p, c in zip(
                                places[row[hit]].tolist(), (a + at[hit]).tolist(), ALPHABET[letter[hit]].tolist(), strict=True
                            )
                        ])

    return run


def follow(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the end of each chain of forms, by doubling the steps until none moves on.

    Forms are more frequent than their words, so there is no circle.
    """
    links = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = links.join(onward, "root", "left")
        links = materialize(joined.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if not links.filter("moved").isEmpty():
            links = links.drop("moved")
            continue
        return links.drop("moved")


def spelling_variants(docs: DataFrame, most_bytes: int = FILTER_BYTES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each distinct word of LEAST_LENGTH letters and LEAST_COUNT occurrences.

    Needs doc_id and text; other columns are ignored, whatever their names. A null or empty text has no word,
    a repeated row counts its words again, ties of n go to the least word. A word without a near one, or whose
    near ones are too rare, has no form and is its own root. An empty table gives no row.
    """
    words = materialize(word_counts(docs).filter(F.col("n") >= LEAST_COUNT), "words")
    pairs = materialize(near_pairs(words, most_bytes), "pairs")
    both = pairs.union(pairs.select("edit", "word"))
    near = both.join(words.withColumnRenamed("word", "edit"), "edit").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), "edit")).alias("best")
    )
    judged = words.join(near, "word", "left").withColumn("most", -F.col("best.less"))
    enough = F.col("most") >= FORM_RATIO * F.col("n")
    judged = materialize(judged.select(
        "word", F.when(enough, F.col("best.edit")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(enough, F.col("most")).alias("form_n"),
    ), "forms")
    roots = follow(judged.filter(F.col("form").isNotNull()))
    done = judged.join(roots, "word", "left")
    return done.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
