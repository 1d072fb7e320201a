"""LM scoring by subword lattice likelihood.

The pieces are those of an existing vocabulary. The probability of a word is summed over all its
segmentations into pieces, by a forward recursion in logarithms over the lattice of pieces; letters
without a piece are spelled in the vocabulary's byte pieces. Scores of pieces start from their rank
in the vocabulary and are learned from the distinct words of the training documents. Which pieces fit where in
a word doesn't depend on scores, so the lattice of each distinct word is walked and stored once; a round
of learning, and the scoring at the end, are arithmetic over the stored edges.

A word seen in training is one more edge across its whole lattice: with absolute discounting it has
(c - d) / N, and the mass d * V / N taken from seen words weights all segmentations. The weights of
all words and of the end sum to one, so the score of a text is the log10 of a probability.

A text repeats its own words, so its words are draws from an urn that starts with CONCENTRATION draws
from that distribution and gets one more ball of each word drawn (a Dirichlet process with the lattice
as its base): after i words a word seen k times before in the text has (k + CONCENTRATION * p) /
(i + CONCENTRATION). That is the marginal over all distributions the urn stands for. The end of a text
stays outside the urn, with the same probability after each word.

Words are counted over all documents. Documents are dealt into buckets, a bucket asks once for each
of its words, and gets count and probability back; no table of words is ever held as a whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Words, bucket_of, chunks, lower_ascii, shuffle_partitions, signed, text_buckets
from millrace.session import materialize

#: Bytes of text whose words are counted together before they are shuffled.
COUNT_BYTES = 8 << 20
#: Pseudo-counts that the ranks of the existing vocabulary are worth, for each piece.
PRIOR = 0.02
#: Rounds of expectation and maximization, each over all distinct words.
ROUNDS = 7
#: Distinct words whose lattices are put into blocks together.
BLOCK_WORDS = 50_000
#: Words of a text after which its own counts weigh as much as the model of all texts.
CONCENTRATION = 2000.0
#: Fixed value: the sign of a word's beginning in vocabularies of this kind.
START = "▁"
_CODE = 21


class Block:
    """The lattices of some words of equal length, as flat arrays that don't depend on any score.

    `spans` holds (from, to, number) of each pair of places that some word has a piece between, in ascending
    order, `rows` the words that have one, as packed bits for each span, and `pieces` these pieces in the same
    order. `odd` holds (place, word, letter) of letters that are no piece alone, in ascending order.
    """

    def __init__(self, length: int, size: int, spans: np.ndarray, rows: np.ndarray, pieces: np.ndarray, odd: np.ndarray):
        self.length, self.size, self.spans, self.rows, self.pieces, self.odd = length, size, spans, rows, pieces, odd

    def columns(self) -> tuple:
        return self.length, self.size, self.spans.tobytes(), self.rows.tobytes(), self.pieces.tobytes(), self.odd.tobytes()

    @classmethod
    def stored(cls, length: int, size: int, spans: bytes, rows: bytes, pieces: bytes, odd: bytes) -> Block:
        return cls(
            length, size, np.frombuffer(spans, np.int32).reshape(-1, 3), np.frombuffer(rows, np.uint8),
            np.frombuffer(pieces, np.uint16 if len(pieces) == 2 * int(np.frombuffer(spans, np.int32)[2::3].sum()) else np.int32),
            np.frombuffer(odd, np.int32).reshape(-1, 3),
        )

    def edges(self) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        """(from, to, words, pieces) of each span."""
        found, row, piece, width = [], 0, 0, -(-self.size // 8)
        for i, j, n in self.spans.tolist():
            at = np.flatnonzero(np.unpackbits(self.rows[row : row + width], count=self.size))
            found.append((i, j, at, self.pieces[piece : piece + n]))
            row, piece = row + width, piece + n
        return found

    def spelled(self, byte_logs: np.ndarray) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """For each place the words whose letter is spelled in byte pieces, and the log probability of that."""
        found: list[tuple[np.ndarray, np.ndarray] | None] = [None] * self.length
        letters, inverse = np.unique(self.odd[:, 2], return_inverse=True)
        logs = np.array([byte_logs[list(chr(c).encode("utf-8", "replace"))].sum() for c in letters.tolist()])
        for place in np.unique(self.odd[:, 0]).tolist():
            lo, hi = np.searchsorted(self.odd[:, 0], (place, place + 1))
            found[place] = self.odd[lo:hi, 1], logs[inverse[lo:hi]]
        return found

    def forward(self, edges: list, spelled: list, logs: np.ndarray) -> np.ndarray:
        """Log probabilities of the first 0, 1, ... letters of each word."""
        alpha = np.full((self.length + 1, self.size), -np.inf)
        alpha[0] = 0.0
        done = 0
        for i, j, at, piece in edges:
            done = self._spell(alpha, spelled, done, i)
            alpha[j, at] = np.logaddexp(alpha[j, at], alpha[i, at] + logs[piece])
        self._spell(alpha, spelled, done, self.length)
        return alpha

    @staticmethod
    def _spell(alpha: np.ndarray, spelled: list, done: int, upto: int) -> int:
        """Spell the letters before place `upto`, whose beginnings are complete."""
        for place in range(done, upto):
            if spelled[place] is not None:
                at, log = spelled[place]
                alpha[place + 1, at] = np.logaddexp(alpha[place + 1, at], alpha[place, at] + log)
        return max(done, upto)

    def expected(self, logs: np.ndarray, byte_logs: np.ndarray) -> np.ndarray:
        """How often each piece is expected in the segmentations of the words."""
        edges, spelled = self.edges(), self.spelled(byte_logs)
        alpha, total = self.forward(edges, spelled, logs), np.zeros(len(logs))
        n, beta = self.length, np.full((self.length + 1, self.size), -np.inf)
        beta[n] = 0.0
        done, taken = n, []
        for i, j, at, piece in reversed(edges):
            done = self._spell_back(beta, spelled, done, i)
            log = logs[piece] + beta[j, at]
            beta[i, at] = np.logaddexp(beta[i, at], log)
            taken.append((piece, np.exp(alpha[i, at] + log - alpha[n, at])))
        if taken:
            total += np.bincount(np.concatenate([p for p, _ in taken]), np.concatenate([w for _, w in taken]), len(total))
        return total

    @staticmethod
    def _spell_back(beta: np.ndarray, spelled: list, done: int, downto: int) -> int:
        """Spell the letters from place `downto` on, whose rests are complete."""
        while done > downto:
            done -= 1
            if spelled[done] is not None:
                at, log = spelled[done]
                beta[done, at] = np.logaddexp(beta[done, at], log + beta[done + 1, at])
        return min(done, downto)


class Lattice:
    """Pieces as a trie in arrays, and the natural logarithm of the probability of each."""

    def __init__(self, pieces: list[str], logs: np.ndarray, byte_ids: list[int]):
        nodes: dict[tuple[int, int], int] = {}
        ends: dict[int, int] = {}
        for i, piece in enumerate(pieces):
            if not piece:
                continue
            node = 0
            for letter in piece:
                node = nodes.setdefault((node, ord(letter)), len(nodes) + 1)
            ends[node] = i
        keys = np.array([(n << _CODE) | c for n, c in nodes], dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.next = keys[order], np.array(list(nodes.values()), dtype=np.int64)[order]
        self.piece = np.full(len(nodes) + 1, -1)
        self.piece[list(ends)] = list(ends.values())
        self.kind = np.uint16 if len(pieces) <= 1 << 16 else np.int32
        self.byte_ids = np.array(byte_ids)
        self.logs = logs

    @classmethod
    def restored(cls, state: dict[str, np.ndarray]) -> Lattice:
        lattice = cls.__new__(cls)
        vars(lattice).update(state)
        return lattice

    def _step(self, node: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows that have a next node, and those nodes."""
        key = (node << _CODE) | letter
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        found = np.flatnonzero(self.keys[at] == key)
        return found, self.next[at[found]]

    def block(self, codes: np.ndarray) -> Block:
        """Walk the trie once from each letter of each row."""
        rows, n = codes.shape
        spans, bits, pieces, odd = [], [], [], []
        for i in range(n):
            row, node = np.arange(rows), np.zeros(rows, dtype=np.int64)
            alone = np.zeros(rows, dtype=bool)
            for j in range(i, n):
                found, node = self._step(node, codes[row, j])
                row = row[found]
                if not len(row):
                    break
                piece = self.piece[node]
                held = piece >= 0
                if held.any():
                    has = np.zeros(rows, dtype=bool)
                    has[row[held]] = True
                    spans.append((i, j + 1, int(held.sum())))
                    bits.append(np.packbits(has))
                    pieces.append(piece[held].astype(self.kind))
                    if j == i:
                        alone = has
            odd += [(i, r, int(codes[r, i])) for r in np.flatnonzero(~alone).tolist()]
        return Block(
            n, rows, np.array(spans, np.int32).reshape(-1, 3), np.concatenate(bits) if bits else np.empty(0, np.uint8),
            np.concatenate(pieces) if pieces else np.empty(0, self.kind), np.array(odd, np.int32).reshape(-1, 3),
        )

    def blocks(self, words: list[str]) -> Iterator[tuple[np.ndarray, Block]]:
        """Words of equal length with the sign of the beginning: their numbers and their lattices."""
        length = np.array([len(w) for w in words], dtype=np.int64)
        for n in np.unique(length):
            at, most = np.flatnonzero(length == n), max(1, (1 << 17) // int(n + 1))
            for lo in range(0, len(at), most):
                part = at[lo : lo + most]
                flat = np.frombuffer("".join([START + words[i] for i in part]).encode("utf-32-le"), dtype="<u4")
                yield part, self.block(flat.reshape(len(part), n + 1).astype(np.int64))

    def block_logs(self, block: Block) -> np.ndarray:
        """The log probability of each word of a block, summed over all segmentations."""
        return block.forward(block.edges(), block.spelled(self.logs[self.byte_ids]), self.logs)[-1]

    def word_logs(self, words: list[str]) -> np.ndarray:
        """The log probability of each word, summed over all segmentations."""
        out = np.empty(len(words))
        for part, block in self.blocks(words):
            out[part] = self.block_logs(block)
        return out

    def expected(self, words: list[str]) -> np.ndarray:
        """How often each piece is expected in the segmentations of the words."""
        total = np.zeros(len(self.logs))
        for _, block in self.blocks(words):
            total += block.expected(self.logs, self.logs[self.byte_ids])
        return total


def _count_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, times): each word of some texts once, with its occurrences in those to learn from, maybe 0.

    The empty word stands for the end of a text.
    """
    for batch in batches:
        texts, learn = batch.column(0).to_pylist(), batch.column(1).to_numpy(zero_copy_only=False)
        for lo, hi in chunks(texts, COUNT_BYTES):
            words = Words(texts[lo:hi])
            owner = learn[lo:hi][words.text_of()].astype(np.int64)
            _, first, inverse = np.unique(words.key, return_index=True, return_inverse=True)
            times = np.bincount(inverse, weights=owner, minlength=len(first)).astype(np.int64)
            found = [words.word(i) for i in first.tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([*found, b""], pa.binary()), pa.array(np.append(times, learn[lo:hi].sum()), pa.int64())],
                names=["word", "times"],
            )


class SubwordModel:
    """The counts of training and the lattices of all words; what `score` needs."""

    def __init__(
        self, blocks: DataFrame, ends: int, total: int, distinct: int, discount: float, lattice: Lattice, end_log: float
    ):
        self.blocks, self.ends, self.total, self.distinct, self.discount = blocks, ends, total, distinct, discount
        self.lattice, self.end_log = lattice, end_log

    def __getstate__(self):
        raise TypeError("the model holds a table and stays on the driver")


_BLOCK = ["length", "size", "spans", "rows", "pieces", "odd"]


def _walked(words: DataFrame, lattice: Lattice) -> DataFrame:
    """The lattices of all (word, times) but the empty word, as blocks of words of equal length.

    A block also has the words' hashes and counts, and whether its words were learned from; others are in
    blocks of their own. This is the only walk over the trie: the rounds and the scores reuse the blocks.
    """
    shipped = words.sparkSession.sparkContext.broadcast(vars(lattice))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Lattice.restored(shipped.value)
        waiting: list[pa.RecordBatch] = []

        def blocks() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(waiting)
            waiting.clear()
            times = table["times"].to_numpy()
            for seen in (True, False):
                at = np.flatnonzero((times > 0) == seen)
                if not len(at):
                    continue
                words = table["word"].take(pa.array(at)).to_pylist()
                keys, own_times = Words(words).key, times[at]
                for part, block in own.blocks([w.decode("utf-8", "replace") for w in words]):
                    row = (*block.columns(), keys[part].tobytes(), own_times[part].astype("<i8").tobytes(), seen)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([v], f.type) for v, f in zip(row, _BLOCK_SCHEMA, strict=True)], schema=_BLOCK_SCHEMA
                    )

        for batch in batches:
            waiting.append(batch)
            if sum(b.num_rows for b in waiting) >= BLOCK_WORDS:
                yield from blocks()
        if waiting:
            yield from blocks()

    kinds = "length int, size int, spans binary, rows binary, pieces binary, odd binary, keys binary, times binary, seen boolean"
    return materialize(words.filter(F.length("word") > 0).mapInArrow(run, kinds), "lattices")


_BLOCK_SCHEMA = pa.schema(
    [("length", pa.int32()), ("size", pa.int32()), *[(c, pa.binary()) for c in ("spans", "rows", "pieces", "odd", "keys", "times")],
     ("seen", pa.bool_())]
)


def _expected_counts(blocks: DataFrame, logs: np.ndarray, byte_ids: np.ndarray) -> np.ndarray:
    """Expected occurrences of each piece over all words of the blocks; one number a piece reaches the driver."""
    shipped = blocks.sparkSession.sparkContext.broadcast(logs)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = shipped.value
        total, byte_logs = np.zeros(len(logs)), logs[byte_ids]
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                total += Block.stored(*row).expected(logs, byte_logs)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found])], names=["piece", "n"])

    counts = np.zeros(len(logs))
    for row in blocks.select(*_BLOCK).mapInArrow(run, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect():
        counts[row["piece"]] = row["n"]
    shipped.unpersist()
    return counts


def _learned_lattice(words: DataFrame, vocabulary: str) -> tuple[DataFrame, Lattice, float]:
    """The blocks of all words, the lattice learned from the seen ones in ROUNDS rounds, and the log probability of the end."""
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
    size = own.get_piece_size()
    special = np.array([own.is_control(i) or own.is_unknown(i) for i in range(size)])
    byte_ids = [own.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    if any(not own.is_byte(i) for i in byte_ids):
        raise ValueError("the vocabulary lacks byte pieces")
    spelled = ["" if special[i] or own.is_byte(i) else own.id_to_piece(i) for i in range(size)]
    # the existing scores order the pieces; the prior falls off with the rank, as frequencies do
    existing = np.array([own.get_score(i) for i in range(size)])
    prior = 1.0 / (2.7 + np.argsort(np.argsort(-existing, kind="stable"), kind="stable"))
    prior[special] = 0.0
    prior *= PRIOR * (~special).sum() / prior.sum()
    prior[byte_ids] += 0.01
    end = own.eos_id()
    prior[end] = 1.0

    def logs(weight: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore"):
            return np.log(weight / weight.sum())

    lattice, weight = Lattice(spelled, logs(prior), byte_ids), prior
    blocks = _walked(words, lattice)
    for _ in range(ROUNDS):
        weight = prior + _expected_counts(blocks.filter("seen"), logs(weight), lattice.byte_ids)
    lattice.logs = logs(weight)
    return blocks, lattice, float(np.log(weight[end] / weight.sum()))


def train(docs: DataFrame, learn: Column, vocabulary: str) -> SubwordModel:
    """Count the words of `docs`, learning from rows where `learn` is true; null is false.

    `vocabulary` is the path of a sentencepiece file with byte pieces.
    """
    texts = docs.select(lower_ascii(F.coalesce("text", F.lit(""))).cast("binary").alias("text"),
                        F.coalesce(learn, F.lit(False)).alias("learn"))
    words = texts.mapInArrow(_count_words, "word binary, times long").groupBy("word").agg(F.sum("times").alias("times"))
    words = materialize(words, "words")
    seen = words.filter(F.col("times") > 0)
    total, distinct, one, two, ends = seen.agg(
        F.coalesce(F.sum("times"), F.lit(0)), F.count(F.lit(1)),
        F.count_if(F.col("times") == 1), F.count_if(F.col("times") == 2),
        F.coalesce(F.sum(F.when(F.length("word") == 0, F.col("times"))), F.lit(0)),
    ).first()
    blocks, lattice, end_log = _learned_lattice(words, vocabulary)
    discount = one / (one + 2 * two) if one else 0.5
    discount = min(max(discount, 0.05), 0.95)
    return SubwordModel(blocks, ends, total, distinct, discount, lattice, end_log)


def _word_scores(model: SubwordModel) -> DataFrame:
    """(key, times, score): the hash of each word, its count and the log10 of its probability; key 0 is the end."""
    spark = model.blocks.sparkSession
    shipped = spark.sparkContext.broadcast((model.lattice.logs, model.lattice.byte_ids))
    total, distinct, discount = model.total, model.distinct, model.discount
    spare = np.log10(discount * distinct / total) if total else 0.0

    def mixed(logs: np.ndarray, times: np.ndarray) -> np.ndarray:
        score = logs / np.log(10) + spare
        seen = times > 0
        score[seen] = np.logaddexp(score[seen] * np.log(10), np.log((times[seen] - discount) / total)) / np.log(10)
        return score

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs, byte_ids = shipped.value
        for batch in batches:
            for *row, keys, times in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                block, times = Block.stored(*row), np.frombuffer(times, "<i8")
                own = block.forward(block.edges(), block.spelled(logs[byte_ids]), logs)[-1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(keys, np.int64)), pa.array(times), pa.array(mixed(own, times))],
                    names=["key", "times", "score"],
                )

    end = float(mixed(np.array([model.end_log]), np.array([model.ends]))[0])
    scored = model.blocks.select(*_BLOCK, "keys", "times").mapInArrow(run, "key long, times long, score double")
    return scored.union(spark.createDataFrame([(0, model.ends, end)], "key long, times long, score double"))


def _drawn(logs: np.ndarray, same: np.ndarray, before: np.ndarray, end: float) -> np.ndarray:
    """log10 of the probability of each word given those before it in its text.

    `logs` are the words' log10 probabilities in the model, `same` is equal for equal words of one text,
    `before` counts the words before, and `end` is the log10 probability of the end.
    """
    order = np.argsort(same, kind="stable")
    first = np.flatnonzero(np.append(True, same[order][1:] != same[order][:-1])) if len(same) else order
    times = np.empty(len(same))
    times[order] = np.arange(len(same)) - np.repeat(first, np.diff(np.append(first, len(same))))
    with np.errstate(divide="ignore"):
        own = np.log(times * (1.0 - 10.0**end))
    return np.logaddexp(own, logs * np.log(10) + np.log(CONCENTRATION)) / np.log(10) - np.log10(before + CONCENTRATION)


def score(docs: DataFrame, model: SubwordModel) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of each row; needs doc_id and text.

    Tokens are the words `[^\\x20\\x09-\\x0D]+` of the text with A-Z lower-cased, then one end. A null
    or empty text has the end only. base_score weights whole words with 0.1 added to each count.
    Words that `model` was not trained over at all can't occur, as training counts every row's words,
    those not learned from with 0; score only tables that were passed to `train`. Repeated rows are
    scored each for itself. Other columns are ignored, whatever their names.
    """
    buckets = text_buckets(docs, shuffle_partitions(docs.sparkSession))
    dealt = docs.select(
        "doc_id", lower_ascii(F.coalesce("text", F.lit(""))).cast("binary").alias("text"),
        bucket_of(buckets, "doc_id", "text").alias("bucket"),
    )
    total, distinct = model.total, model.distinct

    def ask(table: pa.Table) -> pa.Table:
        texts, found = table["text"].to_pylist(), [np.zeros(1, dtype=np.uint64)]
        for lo, hi in chunks(texts, COUNT_BYTES):
            found.append(np.unique(Words(texts[lo:hi]).key))
        keys = np.unique(np.concatenate(found))
        bucket = np.full(len(keys), table["bucket"][0].as_py(), dtype=np.int32)
        return pa.table({"bucket": bucket, "key": pa.array(signed(keys))})

    def add(table: pa.Table, answers: pa.Table) -> pa.Table:
        texts = table["text"].to_pylist()
        keys = answers["key"].to_numpy().astype(np.int64, copy=False)
        order = np.argsort(keys)
        keys, times, logs = keys[order], answers["times"].to_numpy()[order], answers["score"].to_numpy()[order].astype(float)
        base = np.log10((times + 0.1) / (total + 0.1 * (distinct + 1)))
        end = int(np.searchsorted(keys, 0))
        columns: list[list[np.ndarray]] = [[], [], [], []]
        for lo, hi in chunks(texts):
            words = Words(texts[lo:hi])
            at, text = np.searchsorted(keys, signed(words.key)), words.text_of()
            size = np.diff(words.bound)
            drawn = _drawn(logs[at], text * len(keys) + at, np.arange(len(at)) - words.bound[text], logs[end])
            each = ((np.ones(len(at)), 1), (times[at] > 0, times[end] > 0), (base[at], base[end]), (drawn, logs[end]))
            for column, (values, last) in zip(columns, each, strict=True):
                sums = np.zeros(len(size))
                if len(at):
                    full = np.flatnonzero(size)
                    sums[full] = np.add.reduceat(values.astype(float), words.bound[:-1][full])
                column.append(sums + last)
        out = [np.concatenate(c) for c in columns]
        return pa.table({
            "doc_id": table["doc_id"], "n_tokens": pa.array(out[0].astype(np.int64)), "n_known": pa.array(out[1].astype(np.int64)),
            "base_score": pa.array(out[2]), "score": pa.array(out[3]),
        })

    by_bucket = dealt.groupBy("bucket")
    asked = by_bucket.applyInArrow(ask, "bucket int, key long")
    answers = asked.join(_word_scores(model), "key").select("bucket", "key", "times", "score")
    scored = by_bucket.cogroup(answers.groupBy("bucket")).applyInArrow(
        add, "doc_id long, n_tokens long, n_known long, base_score double, score double"
    )
    return scored.withColumn("train_tokens", F.lit(total).cast("long"))
