"""Language identification by error-correcting output codes.

Each language has a codeword. For each bit a binary classifier over hashed byte trigrams tells the
languages with a 1 from those with a 0; loss-weighted decoding takes the codeword that loses least,
where a bit counts by how well its classifier separates the two sides. Texts for which the best two
codewords lose about the same are flagged as ambiguous.

The classifiers are log-ratios of trigram frequencies, so fitting is counting.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import chunks, utf8

#: Labelled rows to learn from, about, for each language; all if there are fewer.
SAMPLE_ROWS = 4000
FEATURE_BITS = 14
#: Trigrams from which on a text's length adds little.
ENOUGH = 16
SHARPNESS = 24.0
#: A lower score is ambiguous.
SURE = 0.5
UNDETERMINED = "und"
#: Spark tasks that count the sample.
_TASKS = 16

_FEATURES = 1 << FEATURE_BITS


def _trigrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashed trigrams of all texts in one array, and where each text's begin. A text has at least one."""
    padded = [b" " + t.lower() + b"  " for t in texts]
    data = np.frombuffer(b"".join(padded), dtype=np.uint8).astype(np.uint32)
    data = np.append(data, np.zeros(2, dtype=np.uint32))
    code = data[:-2] * np.uint32(0x9E3779B1) + data[1:-1] * np.uint32(0x85EBCA77) + data[2:] * np.uint32(0xC2B2AE3D)
    code ^= code >> np.uint32(15)
    code *= np.uint32(0x2C1B3C6D)
    size = np.fromiter((len(p) for p in padded), dtype=np.int64, count=len(padded))
    return (code >> np.uint32(32 - FEATURE_BITS)).astype(np.int64), np.cumsum(size) - size


def codewords(n: int) -> np.ndarray:
    """A row of +1 and -1 for each of n languages: all splits in two for a few, else the best of random codes."""
    if n == 1:
        return np.ones((1, 1))
    if n <= 5:
        splits = np.arange((1 << (n - 1)) - 1)
        return np.array([np.ones(len(splits)), *[2.0 * ((splits >> i) & 1) - 1 for i in range(n - 1)]])
    random, bits = np.random.default_rng(7), 16 * int(np.ceil(np.log2(n)))
    best, distance = np.empty(0), -1.0
    for _ in range(50):
        code = random.choice([-1.0, 1.0], size=(n, bits))
        code = code[:, np.abs(code.sum(0)) < n]
        apart = (code.shape[1] - np.abs(code @ code.T - 2 * code.shape[1] * np.eye(n))).min() / 2
        if apart > distance:
            best, distance = code, apart
    return best


class LanguageModel:
    """Languages, codewords, a weight for each trigram and bit, and the say of each bit."""

    def __init__(self, counts: dict[str, np.ndarray]):
        self.languages = sorted(counts)
        self.code = codewords(len(counts)) if counts else np.empty((0, 0))
        if len(counts) < 2:
            return
        rate = np.stack([(counts[x] + 0.05) / (counts[x].sum() + 0.05 * _FEATURES) for x in self.languages])
        one, zero = ((self.code == s).astype(float) for s in (1, -1))
        p, q = (side.T @ rate / side.sum(0)[:, None] for side in (one, zero))
        self.weight = (np.log(p) - np.log(q)).T.astype(np.float32).copy()
        apart = ((p - q) * (np.log(p) - np.log(q))).sum(1)
        self.say = apart / apart.sum()

    def predict(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """For each text the number of the language and its score, the share of its codeword."""
        if len(self.languages) < 2:
            return np.zeros(len(texts), dtype=np.int64), np.ones(len(texts))
        found, begin = _trigrams(texts)
        size = np.diff(np.append(begin, len(found)))
        # the weights of a long text are summed block by block
        total = np.zeros((len(texts), self.weight.shape[1]))
        owner = np.repeat(np.arange(len(texts)), size)
        for at in range(0, len(found), 1 << 18):
            part, own = self.weight[found[at : at + (1 << 18)]], owner[at : at + (1 << 18)]
            first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            total[own[first]] += np.add.reduceat(part, first, axis=0, dtype=np.float64)
        margin = total / size[:, None] * (SHARPNESS * size / (size + ENOUGH))[:, None]
        loss = np.stack([(np.logaddexp(0, -margin * word) * self.say).sum(1) for word in self.code], axis=1)
        share = np.exp(loss.min(1, keepdims=True) - loss)
        share /= share.sum(1, keepdims=True)
        best = share.argmax(1)
        return best, share[np.arange(len(best)), best]


def fit(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> LanguageModel:
    """Learn from `labelled` (doc_id, text, lang); rows without text or language are left out.

    About `sample_rows` rows of each language are drawn by a hash of doc_id. What reaches the driver
    is one vector of counts per language.
    """
    usable = labelled.filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return LanguageModel({})
    parts = 1 << 20
    draw = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(parts))
    some = {x: int(parts * sample_rows / n) for x, n in sizes.items() if n > sample_rows}
    limit: Column = F.lit(parts)
    if some:
        shares = F.create_map(*[F.lit(v) for pair in some.items() for v in pair])
        limit = F.coalesce(F.element_at(shares, F.col("lang")), F.lit(parts))
    sample = usable.filter(draw < limit).select("lang", utf8("text").alias("text"))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi in chunks(texts):
                found, begin = _trigrams(texts[lo:hi])
                for i, own in enumerate(np.split(found, begin[1:])):
                    counts.setdefault(langs[lo + i], np.zeros(_FEATURES, dtype="<i8"))
                    counts[langs[lo + i]] += np.bincount(own, minlength=_FEATURES)
        yield pa.RecordBatch.from_pydict({
            "lang": pa.array(list(counts), pa.string()),
            "counts": pa.array([c.tobytes() for c in counts.values()], pa.binary()),
        })

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(c.as_py(), dtype="<i8") for c in table["counts"])
        return pa.table({"lang": table["lang"][:1].cast(pa.string()), "counts": pa.array([total.tobytes()], pa.binary())})

    schema = "lang string, counts binary"
    summed = sample.repartition(_TASKS).mapInArrow(count, schema).groupBy("lang").applyInArrow(add, schema)
    return LanguageModel({r["lang"]: np.frombuffer(r["counts"], dtype="<i8") for r in summed.collect()})


def judge(docs: DataFrame, model: LanguageModel) -> Column:
    """The column (lang_pred, score, ambiguous) of a table with a text; see `identify`."""
    shipped = docs.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        own = LanguageModel({})
        vars(own).update(shipped.value)
        for texts, letters in batches:
            langs, scores = np.full(len(texts), UNDETERMINED, dtype=object), np.zeros(len(texts))
            at = np.flatnonzero(letters.to_numpy()) if own.languages else np.empty(0, dtype=np.int64)
            some = texts.iloc[at].tolist()
            for lo, hi in chunks(some):
                best, score = own.predict(some[lo:hi])
                langs[at[lo:hi]], scores[at[lo:hi]] = np.array(own.languages, dtype=object)[best], score
            unsure = (langs != UNDETERMINED) & (scores < SURE)
            yield pd.DataFrame({"lang_pred": langs, "score": scores, "ambiguous": unsure})

    # not deterministic as far as the optimizer is concerned, so that a filter doesn't run it twice
    judged = F.pandas_udf(run, "lang_pred string, score double, ambiguous boolean").asNondeterministic()
    return judged(utf8("text"), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, lang_pred, score, ambiguous) for each row, from the text alone.

    A text that is null or has no letter is `und` with score 0 and not ambiguous, as is any text if
    no language was learned. Of equal languages the first by name is taken. Repeated rows are judged
    each for itself. Other columns are ignored, whatever their names.
    """
    return docs.select("doc_id", judge(docs, model).alias("found")).select("doc_id", "found.*")


def remainder(modulus: int) -> Column:
    """crc32 of doc_id as text, modulo `modulus`; null for a null doc_id."""
    return F.crc32(F.col("doc_id").cast("string")) % modulus


def known_language(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows of `docs` whose language can be told; undetermined and ambiguous ones go.

    A null or empty text, or one without a letter, is undetermined. If no language was learned, as none
    was given, all rows with a letter stay. Repeated rows are judged each for itself, an empty table stays empty.
    """
    if not model.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    judged = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), judge(docs, model).alias("found"))
    kept = judged.filter((F.col("found.lang_pred") != UNDETERMINED) & ~F.col("found.ambiguous"))
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
