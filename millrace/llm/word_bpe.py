"""BPE with word ends, by a minimal acyclic transducer over the frequent words.

Spark counts the words of all texts, and those above a count that at most LEXICON_WORDS reach are
merged in tasks. The driver compiles them into an acyclic automaton whose states share suffixes:
the outputs on the arcs of a word add up to its number, which names its span of ids. The automaton
is a flat file on shared storage; Spark hands it to each executor, where tasks map it into memory
and walk it for all distinct words of some texts at once. What it doesn't hold is merged exactly.
The lexicon only saves time: ids never depend on what is in it.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import materialize, scratch_path

#: Words the automaton holds at most.
LEXICON_WORDS = 1 << 18
#: Bytes of a word in the automaton, at most; longer words are merged where they occur.
WORD_BYTES = 64
#: Steps a doubling of the count is divided into where the least count of a frequent word is chosen.
COUNT_STEPS = 8
#: Bytes of text that are encoded at once; what a task holds for a slice grows with it, the ids do not depend on it.
TEXT_BYTES = 2 << 20
#: Bytes of a word from which on it is merged for itself, with a heap of pairs.
LONG = 64
#: Letters that are merged at once; each matrix of a round holds about as many cells.
MERGED_LETTERS = 1 << 18

_NONE = 1 << 30
_SETTLED = re.compile("[^\x00-\u02ff]").search


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable in Latin-1, else the next one from U+0100 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in own]
    return [chr(b) if b in own else chr(256 + others.index(b)) for b in range(256)]


@dataclass
class Vocabulary:
    """What the vocabulary file says: ids of tokens, ranks of pairs, word end, pattern, special strings, and the
    file without its tokens, which holds the letter forms and the split of texts beyond ASCII."""

    ids: dict[str, int]
    ranks: dict[tuple[str, str], int]
    end: str
    pattern: str
    special: dict[str, int]
    steps: str

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, (split, _) = file["model"], file["pre_tokenizer"]["pretokenizers"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        return cls(
            model["vocab"], {pair: rank for rank, pair in enumerate(pairs)}, model["end_of_word_suffix"],
            split["pattern"]["Regex"], {t["content"]: t["id"] for t in file["added_tokens"]},
            json.dumps({**file, "added_tokens": [], "model": {**model, "vocab": {}, "merges": []}}),
        )

    def tokens(self) -> list[str]:
        """The token of each id."""
        known = {**self.ids, **self.special}
        table = [""] * (max(known.values()) + 1)
        for token, i in known.items():
            table[i] = token
        return table


class Merger:
    """Ids of words by exact merges, many words at once."""

    def __init__(self, vocabulary: Vocabulary):
        import regex
        import tokenizers

        self.vocabulary = vocabulary
        self.letters = byte_letters()
        self.byte = {letter: b for b, letter in enumerate(self.letters)}
        steps = tokenizers.Tokenizer.from_str(vocabulary.steps)
        self.normal, self.split = steps.normalizer.normalize_str, steps.pre_tokenizer.pre_tokenize_str
        self.pieces = regex.compile(vocabulary.pattern).findall
        self.special = regex.compile("(" + "|".join(map(regex.escape, vocabulary.special)) + ")") if vocabulary.special else None
        ids, end = vocabulary.ids, vocabulary.end
        self.inner = np.array([ids.get(letter, -1) for letter in self.letters], np.int64)
        self.last = np.array([ids.get(letter + end, -1) for letter in self.letters], np.int64)
        pairs = sorted((ids[a] << 32 | ids[b], rank, ids[a + b]) for (a, b), rank in vocabulary.ranks.items())
        self.pair, self.rank, self.merged = (np.array(column, np.int64) for column in zip(*pairs, strict=True))

    def _parts(self, word: str) -> list[bytes | int]:
        """The pieces of a word that are merged each for itself, as bytes, and the ids of special strings."""
        if self.special is None or "<" not in word:
            return self._pieces(word)
        known = self.vocabulary.special
        return [p for part in self.special.split(word) for p in ([known[part]] if part in known else self._pieces(part))]

    def _pieces(self, text: str) -> list[bytes]:
        if not _SETTLED(text):
            return [piece.encode() for piece in self.pieces(text.lower())]
        # which signs are letters, and their lower case, depends on the Unicode version of the file's own steps
        byte = self.byte
        return [bytes([byte[c] for c in piece]) for piece, _ in self.split(self.normal(text))]

    def ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words without ASCII white space, one after the other, and how many each has."""
        parts = [self._parts(word) for word in words]
        owner = np.repeat(np.arange(len(words)), np.fromiter(map(len, parts), np.int64, len(parts)))
        known: dict[bytes | int, int] = {}
        code = np.fromiter((known.setdefault(p, len(known)) for own in parts for p in own), np.int64, len(owner))
        found, size = self._merge_all(list(known))
        ends = np.cumsum(size)
        sizes = size[code]
        flat = np.repeat((ends - size)[code] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        return found[flat], np.bincount(owner, weights=sizes, minlength=len(words)).astype(np.int64)

    def _merge_all(self, pieces: list[bytes | int]) -> tuple[np.ndarray, np.ndarray]:
        """As `ids`, of pieces; those of about the same length are merged together."""
        length = np.fromiter((0 if isinstance(p, int) else len(p) for p in pieces), np.int64, len(pieces))
        order = np.argsort(length, kind="stable")
        found: list[np.ndarray | None] = [None] * len(pieces)
        start = 0
        while start < len(order):
            longest = int(length[order[start]])
            if longest == 0 or longest > LONG:
                piece = pieces[order[start]]
                found[order[start]] = np.array([piece] if isinstance(piece, int) else self._long(piece), np.int64)
                start += 1
                continue
            stop = int(np.searchsorted(length[order], longest + 2 + longest // 4, side="right"))
            stop = min(stop, int(np.searchsorted(length[order], LONG, side="right")), start + max(MERGED_LETTERS // longest, 1))
            some = order[start:stop]
            for i, own in zip(some.tolist(), self._merge([pieces[i] for i in some], length[some]), strict=True):
                found[i] = own
            start = stop
        size = np.fromiter(map(len, found), np.int64, len(found))
        return np.concatenate(found) if found else np.empty(0, np.int64), size

    def _long(self, piece: bytes) -> list[int]:
        parts = [self.letters[b] for b in piece]
        parts[-1] += self.vocabulary.end
        ids = self.vocabulary.ids
        return [ids[p] for p in fold_long(parts, self.vocabulary.ranks) if p in ids]

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged token of each pair; _NONE where it is no pair."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        known = (self.pair[at] == key) & (left >= 0) & (right >= 0)
        return np.where(known, self.rank[at], _NONE), self.merged[at]

    def _merge(self, pieces: list[bytes], length: np.ndarray) -> list[np.ndarray]:
        """The ids of each piece: in each round every row merges its pair of lowest rank, the leftmost of several."""
        width = int(length.max())
        letters = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(-1, width)
        column, row = np.arange(width), np.arange(len(pieces))
        token = np.where(column < length[:, None], self.inner[letters], -1)
        token[row, length - 1] = self.last[letters[row, length - 1]]
        if width == 1:
            return [own[own >= 0] for own in token]
        rank, merged = self._ranks(token[:, :-1], token[:, 1:])
        done: list[np.ndarray | None] = [None] * len(pieces)
        place = row
        while len(place):
            at = rank.argmin(axis=1)
            row = np.arange(len(place))
            more = rank[row, at] < _NONE
            for i, own in zip(place[~more].tolist(), token[~more], strict=True):
                done[i] = own[own >= 0]
            token, rank, merged, at, place = token[more], rank[more], merged[more], at[more], place[more]
            if not len(place):
                break
            row = np.arange(len(place))
            token[row, at] = merged[row, at]
            # close the gap of the right one
            width = token.shape[1]
            beyond = np.arange(width - 1)[None, :] > at[:, None]
            token = np.concatenate((np.where(beyond, token[:, 1:], token[:, :-1]), np.full((len(row), 1), -1)), axis=1)
            beyond = np.arange(width - 2)[None, :] > at[:, None]
            none = np.full((len(row), 1), _NONE)
            rank = np.concatenate((np.where(beyond, rank[:, 1:], rank[:, :-1]), none), axis=1)
            merged = np.concatenate((np.where(beyond, merged[:, 1:], merged[:, :-1]), none), axis=1)
            for side in (at - 1, at):
                ok = (side >= 0) & (side < width - 1)
                r, i = row[ok], side[ok]
                rank[r, i], merged[r, i] = self._ranks(token[r, i], token[r, i + 1])
        return done


def fold_long(parts: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """Merge the pair of lowest rank, the leftmost of several, until no pair has one.

    The pairs are kept in a heap: time in proportion to n log n.
    """
    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    token: list[str | None] = list(parts)
    heap: list[tuple[int, int, str, str]] = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] < n:
            a, b = token[i], token[after[i]]
            if (r := ranks.get((a, b))) is not None:
                heapq.heappush(heap, (r, i, a, b))

    for i in range(n):
        offer(i)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if token[i] != a or j >= n or token[j] != b:  # one of the two is gone or has grown
            continue
        token[i], token[j] = a + b, None
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        offer(before[i])
        offer(i)
    return [t for t in token if t is not None]


class Automaton:
    """A minimal acyclic automaton over words of bytes, as flat arrays that can be mapped into memory.

    `key` holds (state << 8 | letter) of each arc in ascending order, `target` its state, `output` what
    it adds to the number of a word; `final` tells the states where words end, the last state is the
    first one of each word. The word of number n has the ids from `bound[n]` to `bound[n + 1]`.
    """

    FIELDS = (("key", "<i8"), ("bound", "<i8"), ("target", "<i4"), ("output", "<i4"), ("ids", "<u4"), ("final", "u1"))

    def __init__(self, **arrays: np.ndarray):
        self.__dict__.update(arrays)

    @classmethod
    def compile(cls, words: list[bytes], ids: list[list[int]]) -> Automaton:
        """The automaton of distinct words in ascending order: states of equal futures are one."""
        register: dict[tuple, int] = {}
        states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
        path: list[list] = [[False, []]]  # of the word last added: whether it ends here, and the arcs so far

        def close(depth: int, word: bytes) -> None:
            """Replace the states of the path beyond `depth` by registered ones."""
            while len(path) > depth + 1:
                ends, arcs = path.pop()
                shape = (ends, tuple(arcs))
                if shape not in register:
                    register[shape] = len(states)
                    states.append(shape)
                path[-1][1].append((word[len(path) - 1], register[shape]))

        last = b""
        for word in words:
            same = next((i for i, (a, b) in enumerate(zip(last, word, strict=False)) if a != b), min(len(last), len(word)))
            close(same, last)
            path.extend([False, []] for _ in word[same:])
            path[-1][0], last = True, word
        close(0, last)
        states.append((path[0][0], tuple(path[0][1])))

        ways: list[int] = []  # words that can be read from each state on
        keys, targets, outputs = [], [], []
        for state, (ends, arcs) in enumerate(states):
            total = int(ends)
            for letter, to in arcs:
                keys.append(state << 8 | letter)
                targets.append(to)
                outputs.append(total)
                total += ways[to]
            ways.append(total)
        return cls(
            key=np.array(keys, "<i8"), target=np.array(targets, "<i4"), output=np.array(outputs, "<i4"),
            final=np.array([s[0] for s in states], "u1"),
            bound=np.cumsum([0, *map(len, ids)]).astype("<i8"), ids=np.array([i for own in ids for i in own], "<u4"),
        )

    def to_bytes(self) -> bytes:
        arrays = [getattr(self, name).astype(kind) for name, kind in self.FIELDS]
        return np.array([len(a) for a in arrays], "<i8").tobytes() + b"".join(a.tobytes() for a in arrays)

    @classmethod
    def mapped(cls, path: str) -> Automaton:
        """The automaton in a file, mapped into memory: tasks of a machine share its pages."""
        raw = np.memmap(path, dtype="u1", mode="r")
        sizes, at, arrays = raw[: 8 * len(cls.FIELDS)].view("<i8"), 8 * len(cls.FIELDS), {}
        for (name, kind), size in zip(cls.FIELDS, sizes.tolist(), strict=True):
            stop = at + size * np.dtype(kind).itemsize
            arrays[name], at = raw[at:stop].view(kind), stop
        return cls(**arrays)

    def find(self, words: pa.Array) -> np.ndarray:
        """The number of each word, -1 for those not held: one step over all words at a time."""
        _, ends, data = words.buffers()
        ends = np.frombuffer(ends, np.int32)[words.offset : words.offset + len(words) + 1]
        data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
        start, size = ends[:-1].astype(np.int64), np.diff(ends)
        number = np.full(len(words), -1, np.int64)
        state, total = np.full(len(words), len(self.final) - 1, np.int64), np.zeros(len(words), np.int64)
        alive, step = np.flatnonzero((size > 0) & (size <= WORD_BYTES)), 0
        while len(alive) and len(self.key):
            key = state[alive] << 8 | data[start[alive] + step]
            arc = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            known = self.key[arc] == key
            alive, arc, step = alive[known], arc[known], step + 1
            total[alive] += self.output[arc]
            state[alive] = self.target[arc]
            done = size[alive] == step
            ended = alive[done]
            ended = ended[self.final[state[ended]] == 1]
            number[ended] = total[ended]
            alive = alive[~done]
        return number


def _words(texts: pa.Array) -> pa.ListArray:
    """The parts of each text between runs of ASCII white space, some of them empty."""
    return pc.ascii_split_whitespace(texts)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about TEXT_BYTES of text, a longer text for itself."""
    start = size = 0
    for i, own in enumerate(pc.binary_length(batch.column(1)).to_pylist()):
        if size and size + own > TEXT_BYTES:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += own
    yield batch.slice(start)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): how often each word of up to WORD_BYTES bytes occurs in all texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                counted = pc.value_counts(_words(part.column(1)).flatten())
                table = pa.RecordBatch.from_arrays([counted.field(0), counted.field(1)], names=["word", "n"])
                size = pc.binary_length(table.column(0))
                yield table.filter(pc.and_(pc.greater(size, 0), pc.less_equal(size, WORD_BYTES)))

    texts = docs.select(F.lit(0).alias("one"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, most: int = LEXICON_WORDS) -> DataFrame:
    """The words of (word, n) with the least count that at most `most` words reach; no word is ranked globally."""
    step = F.floor(F.log2("n") * COUNT_STEPS).cast("int")
    total, least = 0, None
    for level, words in sorted(counts.groupBy(step.alias("level")).count().collect(), reverse=True):
        total += words
        if total > most:
            break
        least = level
    return counts.filter(F.lit(False) if least is None else step >= least)


def build_lexicon(docs: DataFrame, path: str, most: int = LEXICON_WORDS) -> str:
    """Compile the frequent words of all texts and hand the file to all executors; gives its name.

    The file lies on shared storage, so a new executor fetches it again. No texts give an automaton
    without words.
    """
    spark = docs.sparkSession
    shipped = spark.sparkContext.broadcast(vars(Vocabulary.load(path)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = Merger(Vocabulary(**shipped.value))
        for batch in batches:
            found, size = merger.ids(batch.column(0).to_pylist())
            offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["word", "ids"])

    frequent = frequent_words(materialize(word_counts(docs), "words"), most)
    table = frequent.select("word").mapInArrow(run, "word string, ids array<int>").toArrow()
    rows = sorted(zip([w.encode() for w in table.column(0).to_pylist()], table.column(1).to_pylist(), strict=True))
    compiled = Automaton.compile([w for w, _ in rows], [ids for _, ids in rows])
    return share(spark, compiled.to_bytes())


def share(spark: SparkSession, content: bytes) -> str:
    """Write bytes to a file on shared storage that all executors get a copy of; gives its name."""
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    path = f"{scratch_path(spark, 'lexicon')}/{name}"
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).create(place, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()
    spark.sparkContext.addFile(path)
    return name


@functools.cache
def _mapped(path: str) -> Automaton:
    return Automaton.mapped(path)


def encode(docs: DataFrame, path: str, lexicon: str | None = None) -> DataFrame:
    """(doc_id, ids) of each row, ids an array of the text's tokens by the vocabulary file `path`.

    `lexicon` is the result of `build_lexicon`, by default of the same texts. Special strings in a text
    are their ids. A null or empty text, or one of white space, has no ids. Repeated rows are encoded
    each for itself, an empty table gives no row. Other columns are ignored, whatever their names.
    """
    name = lexicon or build_lexicon(docs, path)
    shipped = docs.sparkSession.sparkContext.broadcast(vars(Vocabulary.load(path)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import SparkFiles

        automaton, merger = _mapped(SparkFiles.get(name)), Merger(Vocabulary(**shipped.value))
        held = automaton.bound[:-1], np.diff(automaton.bound)
        for batch in batches:
            for part in _slices(batch):
                words = _words(part.column(1))
                coded = words.flatten().dictionary_encode()
                number = automaton.find(coded.dictionary)
                unseen = np.flatnonzero(number < 0)
                new, sizes = merger.ids(coded.dictionary.take(pa.array(unseen)).to_pylist())
                # where the ids of each distinct word begin, and how many they are; new ones follow the automaton's
                first, size = np.empty(len(number), np.int64), np.empty(len(number), np.int64)
                seen = number >= 0
                first[seen], size[seen] = held[0][number[seen]], held[1][number[seen]]
                first[unseen], size[unseen] = len(automaton.ids) + np.cumsum(sizes) - sizes, sizes
                pool = np.concatenate((automaton.ids, new.astype(np.uint32)))
                codes = coded.indices.to_numpy(zero_copy_only=False)
                ends = np.concatenate(([0], np.cumsum(size[codes])))
                flat = np.repeat(first[codes] - ends[:-1], size[codes]) + np.arange(ends[-1])
                offsets = words.offsets.to_numpy()
                bound = ends[offsets - offsets[0]]
                ids = pa.ListArray.from_arrays(pa.array(bound.astype(np.int32)), pa.array(pool[flat].view(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], names=["doc_id", "ids"])

    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(run, "doc_id long, ids array<int>")


def _spelled(ids: pa.ListArray, table: pa.Array) -> list[memoryview]:
    """The tokens of each row's ids, joined by one space."""
    bound = ids.offsets.to_numpy() - ids.offsets[0].as_py()
    joined = table.take(ids.flatten())
    _, ends, data = joined.buffers()
    if data is None:
        return [memoryview(b"")] * len(ids)
    ends = np.frombuffer(ends, np.int64)[joined.offset + bound].tolist()
    data = memoryview(data)
    return [data[min(a + 1, b) : b] for a, b in zip(ends, ends[1:], strict=False)]


def _decoder(encoded: DataFrame, path: str, schema: str, finish) -> DataFrame:
    shipped = encoded.sparkSession.sparkContext.broadcast([b" " + t.encode() for t in Vocabulary.load(path).tokens()])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.array(shipped.value, pa.large_binary())
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                ids = pc.fill_null(part.column(1), pa.scalar([], part.column(1).type))
                yield finish(part.column(0), ids, _spelled(ids, table))

    return encoded.select("doc_id", "ids").mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, decoded) of each row of (doc_id, ids): its tokens as the file spells them, joined by one
    space, as the file names no decoder; empty for null or no ids."""

    def finish(doc_id: pa.Array, ids: pa.Array, decoded: list[memoryview]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([doc_id, pa.array(map(bytes, decoded), pa.binary()).cast(pa.string())], names=["doc_id", "decoded"])

    return _decoder(encoded, path, "doc_id long, decoded string", finish)


def digests(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of (doc_id, ids): checksums of the ids as
    little-endian unsigned 32-bit integers, and of the text they decode to."""

    def finish(doc_id: pa.Array, ids: pa.Array, decoded: list[memoryview]) -> pa.RecordBatch:
        import hashlib

        bound = (ids.offsets.to_numpy() - ids.offsets[0].as_py()).tolist()
        flat = memoryview(ids.flatten().to_numpy(zero_copy_only=False).astype("<u4")).cast("B")
        own = [hashlib.sha256(flat[4 * a : 4 * b]).hexdigest() for a, b in zip(bound, bound[1:], strict=False)]
        return pa.RecordBatch.from_arrays(
            [doc_id, pa.array(np.diff(bound), pa.int64()), pa.array(own, pa.string()),
             pa.array([hashlib.sha256(d).hexdigest() for d in decoded], pa.string())],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return _decoder(encoded, path, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", finish)
