"""Best-fit packing of token pieces into sequences of fixed length.

Bounded-space online best-fit: a task keeps a fixed number of open sequences in a bitset keyed by
free space. A piece goes to the fullest sequence that still has room, found by one shift and one
lowest-bit test; when too many are open, the fullest closes first. Pieces come in a repeatable
random order, in blocks that are sorted from long to short, so that most open sequences get filled.

Only numbers are packed: the texts are turned into piece lengths where they are read.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import chunks
from millrace.session import materialize

LENGTH = 1024
#: Open sequences of a task.
OPEN = 1024
#: Pieces that are sorted together before they are packed.
BLOCK = 1536
#: Pieces dealt to one packing task; each task ends with at most OPEN sequences that aren't full.
TASK_PIECES = 1 << 18

#: The words of the pre-tokenizer that byte-level vocabularies of this kind share.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_level_ranks(vocabulary: dict[str, int]) -> dict[bytes, int]:
    """A vocabulary in printable letters as bytes. Bytes that aren't printable have letters from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    letter = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}
    return {bytes(letter[c] for c in token): i for token, i in vocabulary.items() if all(c in letter for c in token)}


def read_vocabulary(path: str) -> dict[str, int]:
    """The vocabulary of a byte-level BPE file of the tokenizers library; its size bounds what tasks receive."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    if model["model"]["type"] != "BPE" or model["pre_tokenizer"]["type"] != "ByteLevel":
        raise ValueError(f"{path} is no byte-level BPE vocabulary")
    return model["model"]["vocab"]


class OpenSequences:
    """Bounded-space best-fit over pieces of 1 to `length`."""

    def __init__(self, length: int, most: int, first_id: int):
        self.length, self.most, self.next_id = length, most, first_id
        self.free: dict[int, list[int]] = {}
        self.bits = self.count = 0

    def _take(self, free: int) -> int:
        ids = self.free[free]
        found = ids.pop()
        if not ids:
            self.bits &= ~(1 << free)
        self.count -= 1
        return found

    def place(self, size: int) -> tuple[int, int]:
        """The sequence a piece goes to, and its offset there."""
        fitting = self.bits >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            found = self._take(free)
        else:
            free, found = self.length, self.next_id
            self.next_id += 1
        left = free - size
        if left:
            if self.count == self.most:  # the fullest closes, be it this one
                fullest = (self.bits & -self.bits).bit_length() - 1
                if left <= fullest:
                    return found, self.length - free
                self._take(fullest)
            self.free.setdefault(left, []).append(found)
            self.bits |= 1 << left
            self.count += 1
        return found, self.length - free


def token_pieces(docs: DataFrame, vocabulary: str, end_id: int, length: int = LENGTH) -> DataFrame:
    """The pieces of each document: doc_id, piece, start, length and the checksum of the ids.

    A document is the ids of its text, then `end_id`. One that is longer than `length` is cut into
    pieces of `length`, of which the first may be shorter. A null text is empty and gives the one
    token `end_id`.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        coder = tiktoken.Encoding(
            "pieces", pat_str=PATTERN, mergeable_ranks=byte_level_ranks(shipped.value), special_tokens={}
        )
        for batch in batches:
            ids = batch.column(0)
            texts = batch.column(1).to_pylist()
            for lo, hi in chunks([t.encode() for t in texts]):
                rows: list[tuple[int, int, int, int, int]] = []
                for d in range(lo, hi):
                    tokens = np.array([*coder.encode_ordinary(texts[d]), end_id], dtype="<u4")
                    n = len(tokens)
                    stop = n % length or min(n, length)
                    start = piece = 0
                    while start < n:
                        rows.append((d, piece, start, stop - start, zlib.crc32(tokens[start:stop].tobytes())))
                        start, stop, piece = stop, stop + length, piece + 1
                columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [ids.take(columns[0]), columns[1].cast(pa.int32()), *columns[2:]],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(pieces: DataFrame, length: int = LENGTH, most_open: int = OPEN, block: int = BLOCK) -> DataFrame:
    """`pieces` (doc_id, piece, start, length, ids_crc32) with sequence_id and offset.

    Pieces of one task share sequences, so all but a bounded number of sequences a task are as full
    as best-fit makes them. A sequence never spans two tasks, so a lost task is simply packed again.
    """
    stored = materialize(pieces, "pieces")
    tasks = -(-stored.count() // TASK_PIECES) or 1
    order = F.xxhash64("doc_id", "piece", "ids_crc32")
    dealt = stored.withColumn("order", order).repartition(tasks, "order").sortWithinPartitions("order")
    names = stored.columns

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        bins = OpenSequences(length, most_open, (context.partitionId() if context else 0) << 40)
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                part = pa.Table.from_batches([batch.slice(at, block)]).select(names)
                sizes = part["length"].to_numpy()
                rank = np.argsort(-sizes, kind="stable")
                placed = [bins.place(n) for n in sizes[rank].tolist()]
                part = part.take(pa.array(rank))
                for i, name in enumerate(("sequence_id", "offset")):
                    part = part.append_column(name, pa.array([p[i] for p in placed], pa.int64()))
                yield from part.to_batches()

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stored.schema)
    return dealt.mapInArrow(pack, f"{kinds}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int, length: int = LENGTH) -> DataFrame:
    """All documents as pieces in sequences of at most `length` tokens, gapless from offset 0.

    Needs doc_id and text; other columns are ignored, whatever their names. Repeated rows are
    packed each for itself. An empty table gives no piece.
    """
    return best_fit(token_pieces(docs, vocabulary, end_id, length), length)
