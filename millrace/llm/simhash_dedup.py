"""SimHash near-dedup by a segment-popcount embedding.

A fingerprint of 64 bits is mapped to the bit counts of its 16 segments of four bits. The Manhattan
distance of two such points is at most the Hamming distance of the fingerprints, so whatever is
linked at two bits lies within distance two on the grid. There every two such points have a cell in
common that is within one step of both: each fingerprint is dealt to its own cell and the cells one
step away, equal cells meet, and their members are verified on the bits.

Only distinct fingerprints are dealt. A cell with few members is compared pair by pair. Of a crowded
one, members go on to a second grid of the same kind with segments of one bit: there a cell holds
at most 65 fingerprints, all within two bits of each other, so a chain through them is enough.

Two bits are about what one changed word in a hundred leaves. To keep one of each group of near
copies, `one_of_each` also takes fingerprints of small samples of a text's five-word shingles, which
stay equal where the sample has no edit. Texts with an equal one are verified on all their shingles,
first against one of them, then, where that leaves several components, whichever share rare shingles.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import Words, chunks, mix, rolling, signed, unsigned, utf8
from millrace.llm.graph import components
from millrace.operators.keys import dense_key
from millrace.session import materialize

SHINGLE = 3
SEED = 42
#: Differing bits of a link.
RADIUS = 2
SEGMENT_BITS = 4
#: A cell with more members is crowded.
CROWDED = 8
#: Near copies share so large a part of all their distinct shingles of so many words.
SIMILARITY = 0.8
NEAR_SHINGLE = 5
#: Samples of a text's shingles, and shingles of a sample. A pair at SIMILARITY has an equal
#: fingerprint with a probability of 1 - (1 - 0.8**4)**16 = 0.9998.
SAMPLES = 16
SAMPLE = 4
#: Up to so many ids of texts to verify are sent to all tasks; beyond, texts are dealt out to them.
BROADCAST_IDS = 1_000_000
_SHINGLE_BASE = 0xD6E8FEB86659FD93

_NIBBLE = np.array([bin(i).count("1") for i in range(16)], dtype=np.int64)
#: Shingles whose bits are counted at once.
_BLOCK = 1 << 15


def fingerprint(words: list[bytes], shingle: int = SHINGLE) -> int:
    """Bit i is set if it is in over half of the XXH64 of the word shingles, repeats included."""
    import xxhash

    if not words:
        return 0
    size = min(shingle, len(words))
    total = np.zeros(64, dtype=np.int64)
    n = len(words) - size + 1
    for at in range(0, n, _BLOCK):
        part = words[at : min(at + _BLOCK, n) + size - 1]
        runs = zip(*(part[i:] for i in range(size)), strict=False)
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(run), SEED) for run in runs], dtype="<u8")
        total += np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) for each row; a null text has the fingerprint zero, as a text without words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = [fingerprint(t.as_py().lower().split()) for t in batch.column(1)]
            values = signed(np.array(fp, dtype=np.uint64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], names=["doc_id", "fp"])

    return docs.select("doc_id", utf8("text").alias("text")).mapInArrow(run, "doc_id long, fp long")


def _popcount_cells(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    segments = 64 // SEGMENT_BITS
    for batch in batches:
        fp = unsigned(batch.column(0))
        counts = np.stack([
            _NIBBLE[((fp >> np.uint64(SEGMENT_BITS * s)) & np.uint64(15)).astype(np.int64)] for s in range(segments)
        ])
        home = sum(counts[s] << (3 * s) for s in range(segments))
        cells, members = [home], [fp]
        for s in range(segments):
            for step, inside in ((1, counts[s] < SEGMENT_BITS), (-1, counts[s] > 0)):
                cells.append((home + step * (1 << (3 * s)))[inside])
                members.append(fp[inside])
        yield _pairs(np.concatenate(cells), signed(np.concatenate(members)), ("cell", "fp"))


def _bit_cells(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    steps = np.concatenate(([np.uint64(0)], np.uint64(1) << np.arange(64, dtype=np.uint64)))
    for batch in batches:
        fp = unsigned(batch.column(0))
        for at in range(0, len(fp), 1000):
            part = fp[at : at + 1000]
            yield _pairs(signed((part[:, None] ^ steps).ravel()), signed(np.repeat(part, 65)), ("cell", "fp"))


def _pairs(a: np.ndarray, b: np.ndarray, names: tuple[str, str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=list(names))


def _within(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links inside the cells of rows sorted by cell; a crowded cell's members come out as (fp, null).

    Only the last cell of a batch is carried on, and no more than CROWDED members of it.
    """
    cell, fp = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    crowded: int | None = None

    def settle(cell: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        new = np.ones(len(cell), dtype=bool)
        new[1:] = cell[1:] != cell[:-1]
        size = np.diff(np.append(np.flatnonzero(new), len(cell)))
        many = np.repeat(size, size) > CROWDED
        loud = np.unique(fp[many])
        cell, fp = cell[~many], fp[~many]
        a, b = [loud], [loud]
        for step in range(1, CROWDED):
            near = (cell[step:] == cell[:-step]) if len(cell) > step else np.empty(0, dtype=bool)
            if not near.any():
                break
            x, y = fp[:-step][near], fp[step:][near]
            linked = np.bitwise_count(x ^ y) <= RADIUS
            a.append(x[linked])
            b.append(y[linked])
        both = np.unique(np.stack([np.concatenate(a), np.concatenate(b)]), axis=1)
        return _pairs(signed(both[0].copy()), signed(both[1].copy()), ("a", "b"))

    for batch in batches:
        more_cell = batch.column(0).to_numpy(zero_copy_only=False)
        more_fp = unsigned(batch.column(1))
        if crowded is not None:  # what follows of a cell that is known to be crowded
            stay = int(np.searchsorted(more_cell, crowded, side="right"))
            if stay:
                loud = signed(np.unique(more_fp[:stay]))
                yield _pairs(loud, loud, ("a", "b"))
            if stay == len(more_cell):
                continue
            more_cell, more_fp, crowded = more_cell[stay:], more_fp[stay:], None
        cell, fp = np.concatenate([cell, more_cell]), np.concatenate([fp, more_fp])
        last = int(np.searchsorted(cell, cell[-1], side="left")) if len(cell) else 0
        if len(cell) - last > CROWDED:
            crowded, last = int(cell[-1]), len(cell)
        yield settle(cell[:last], fp[:last])
        cell, fp = cell[last:], fp[last:]
    yield settle(cell, fp)


def _chains(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Consecutive members of each cell of rows sorted by cell."""
    last: tuple[np.ndarray, np.ndarray] | None = None
    for batch in batches:
        cell, fp = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
        if last is not None:
            cell, fp = np.concatenate([last[0], cell]), np.concatenate([last[1], fp])
        if len(cell):
            same = cell[1:] == cell[:-1]
            both = np.unique(np.stack([fp[:-1][same], fp[1:][same]]), axis=1)
            yield _pairs(both[0].copy(), both[1].copy(), ("a", "b"))
            last = cell[-1:], fp[-1:]


def links(distinct: DataFrame) -> DataFrame:
    """(a, b) of distinct fingerprints: enough links of at most two bits to join all that are linked."""

    def sorted_cells(fps: DataFrame, cells) -> DataFrame:
        return fps.mapInArrow(cells, "cell long, fp long").repartition("cell").sortWithinPartitions("cell", "fp")

    found = materialize(sorted_cells(distinct, _popcount_cells).mapInArrow(_within, "a long, b long"), "links")
    crowded = found.filter(F.col("a") == F.col("b")).select(F.col("a").alias("fp")).distinct()
    chained = sorted_cells(crowded, _bit_cells).mapInArrow(_chains, "a long, b long")
    return found.filter(F.col("a") != F.col("b")).union(chained)


def simhash_components(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row; needs doc_id and text.

    Documents are linked if their fingerprints differ in two bits or fewer; component_id is the
    least doc_id that can be reached, the own one included. Null and empty texts have fingerprint
    zero and are linked like any other. Repeated rows share their component. A null doc_id takes
    part with its text, but gives its component no number. An empty table gives no row. Other
    columns are ignored, whatever their names.
    """
    marked = materialize(fingerprints(docs), "fingerprints")
    distinct = marked.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(links(marked.select("fp").distinct()), "simhash")
    member = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    least = member.groupBy("root").agg(F.min("first").alias("component_id"))
    named = member.join(least, "root").select("fp", "component_id")
    return marked.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def _shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the distinct shingles of each text, sorted; of all words if there are fewer."""
    words = Words(texts, lower=True)
    owner, size = words.text_of(), np.diff(words.bound)
    runs = rolling(words.key, NEAR_SHINGLE, _SHINGLE_BASE)
    at = np.flatnonzero(np.arange(len(runs)) <= (words.bound[1:][owner] - NEAR_SHINGLE)[: len(runs)])
    owners, hashes = [owner[at]], [runs[at]]
    for d in np.flatnonzero((size > 0) & (size < NEAR_SHINGLE)).tolist():
        owners.append(np.array([d]))
        hashes.append(rolling(words.key[words.bound[d] : words.bound[d + 1]], int(size[d]), _SHINGLE_BASE))
    owner, found = np.concatenate(owners), np.concatenate(hashes)
    order = np.lexsort((found, owner))
    owner, found = owner[order], found[order]
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (found[1:] != found[:-1])
    return owner[new], found[new]


def _sample_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text, key) for the fingerprint of each sample of each text, alone and together with the next sample's.

    A shingle belongs to the sample its hash names; of those the ones of least hash are taken.
    """
    owner, found = _shingles(texts)
    part = owner * SAMPLES + (found % np.uint64(SAMPLES)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    part, found = part[order], found[order]
    first = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.empty(0, dtype=np.int64)
    rank = np.arange(len(part)) - np.repeat(first, np.diff(np.append(first, len(part))))
    part, found = part[rank < SAMPLE], found[rank < SAMPLE]
    prints, held = np.zeros((len(texts), SAMPLES), dtype=np.uint64), np.zeros((len(texts), SAMPLES), dtype=bool)
    if len(part):
        first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        bits = np.unpackbits(mix(found).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total = np.add.reduceat(bits, first, axis=0, dtype=np.int64)
        half = np.diff(np.append(first, len(part)))[:, None]
        packed = np.packbits(2 * total > half, axis=1, bitorder="little")
        prints.ravel()[part[first]] = packed.view("<u8")[:, 0]
        held.ravel()[part[first]] = True
    alone = mix(prints + np.arange(SAMPLES, dtype=np.uint64))
    both = mix(alone * np.uint64(0x9E3779B97F4A7C15) + np.roll(alone, -1, axis=1))
    pair_held = held & np.roll(held, -1, axis=1)
    owner = np.concatenate([np.nonzero(held)[0], np.nonzero(pair_held)[0]])
    return owner, np.concatenate([alone[held], both[pair_held]])


def _verified(shown: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of `pairs` (a, b) that share SIMILARITY of all shingles of their texts in `shown` (doc_id, text)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, own = None, np.empty(0, dtype=np.uint64)
        for batch in batches:
            a, b, first, second = batch.columns
            near = []
            for i, one in enumerate(a.to_pylist()):
                if one != known:
                    known, own = one, _shingles([first[i].as_py()])[1]
                other = _shingles([second[i].as_py()])[1]
                shared = len(np.intersect1d(own, other, assume_unique=True))
                near.append(shared >= SIMILARITY * (len(own) + len(other) - shared))
            mask = pa.array(near, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(mask), b.filter(mask)], names=["a", "b"])

    first, second = (shown.select(F.col("doc_id").alias(x), F.col("text").alias(f"text_{x}")) for x in ("a", "b"))
    both = pairs.join(second, "b").join(first, "a")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _prefix_pairs(shown: DataFrame, members: DataFrame) -> DataFrame:
    """(a, b), a < b, of `members` (doc_id, root) of different roots: all that can share SIMILARITY of their shingles.

    A prefix-filter join. With the shingles of each text in one order, rare ones first, two texts of
    sizes m <= n that share s of them, s >= SIMILARITY / (1 + SIMILARITY) * (m + n), have one in common
    among the first m - s + 1 and n - s + 1. Their first common one leaves both at least s shingles.
    A shingle of one root only makes no pair, and its commonest root is not joined with itself.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for lo, hi in chunks(texts):
                owner, found = _shingles(texts[lo:hi])
                at, size = pa.array(owner + lo), np.bincount(owner, minlength=hi - lo)[owner]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(size.astype(np.int64)), pa.array(signed(found))],
                    names=["doc_id", "root", "size", "token"],
                )

    few = members.count() <= BROADCAST_IDS
    texts = shown.join(F.broadcast(members) if few else members, "doc_id").select("doc_id", "root", "text")
    tokens = materialize(texts.mapInArrow(run, "doc_id long, root long, size long, token long"), "shingles")
    common = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    order = Window.partitionBy("doc_id").orderBy("n", "token")
    alone = F.col("size") - F.count(F.lit(1)).over(Window.partitionBy("doc_id"))  # shingles that no other text has
    placed = tokens.join(common, "token").withColumn("at", alone + F.row_number().over(order) - 1)
    least = lambda share: F.ceil(share * F.col("size") - 1e-6)
    share = SIMILARITY / (1 + SIMILARITY)
    prefix = placed.filter(F.col("at") <= F.col("size") - least(SIMILARITY)).select(
        "token", "doc_id", "root", "size", "at", (F.col("at") <= F.col("size") - least(2 * share)).alias("short")
    )
    prefix = materialize(prefix, "prefix")
    roots = prefix.groupBy("token", "root").agg(F.count(F.lit(1)).alias("n"))
    main = roots.groupBy("token").agg(F.max_by("root", "n").alias("main"), F.count(F.lit(1)).alias("roots"))
    prefix = prefix.join(main.filter(F.col("roots") > 1).drop("roots"), "token")
    side = lambda rows, x: rows.select("token", *(F.col(c).alias(f"{c}_{x}") for c in ("doc_id", "root", "size", "at")))
    other, short = F.col("root") != F.col("main"), F.col("short")
    left = F.least(F.col("size_a") - F.col("at_a"), F.col("size_b") - F.col("at_b"))
    can = (
        (F.col("root_a") != F.col("root_b"))
        & (F.col("size_a") <= F.col("size_b"))
        & (left >= share * (F.col("size_a") + F.col("size_b")) - 1e-6)
    )
    met = [
        side(prefix.filter(short & one), "a").join(side(prefix.filter(two), "b"), "token").filter(can)
        for one, two in ((other, F.lit(True)), (~other, other))
    ]
    pairs = met[0].union(met[1]).select(
        F.least("doc_id_a", "doc_id_b").alias("a"), F.greatest("doc_id_a", "doc_id_b").alias("b")
    )
    return pairs.distinct()


def near_links(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(a, b), a < b, of documents among `ids` (doc_id): enough of those that share SIMILARITY of all their shingles.

    Documents with an equal key meet, and each is verified against the least of them on all shingles
    of both texts, so a group costs as many comparisons as it has members. A group that these links
    make one component is closed. In the others, members are mostly unlike the least one, as where many
    texts share a passage; all their members are joined on rare shingles, and what can be alike without
    being in one component yet is verified too.
    """

    def keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids, texts = batch.column(0), batch.column(1).to_pylist()
            for lo, hi in chunks(texts):
                owner, key = _sample_keys(texts[lo:hi])
                yield pa.RecordBatch.from_arrays([pa.array(signed(key)), doc_ids.take(pa.array(owner + lo))], names=["key", "doc_id"])

    texts = docs.select("doc_id", utf8("text").alias("text")).filter(F.col("doc_id").isNotNull())
    named = texts.mapInArrow(keys, "key long, doc_id long").join(ids, "doc_id", "left_semi")
    named = materialize(named.select("key", "doc_id"), "sample_keys")
    met = named.groupBy("key").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("last")).filter(F.col("a") < F.col("last"))
    named = materialize(named.join(met.select("key", "a"), "key"), "met")
    pairs = named.filter(F.col("doc_id") > F.col("a")).select("a", F.col("doc_id").alias("b")).distinct()
    pairs = materialize(pairs, "pairs")
    wanted = materialize(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "wanted")
    few = wanted.count() <= BROADCAST_IDS
    shown = texts.join(F.broadcast(wanted) if few else wanted, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    shown = materialize(shown, "texts")
    found = materialize(_verified(shown, pairs), "star")
    roots = components(found, "star").withColumnRenamed("node", "doc_id")
    rooted = named.join(F.broadcast(roots) if few else roots, "doc_id", "left")
    rooted = rooted.select("key", "doc_id", F.coalesce("root", "doc_id").alias("root"))
    of_key = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    unclosed = of_key.filter(F.col("low") < F.col("high")).select("key")
    members = materialize(rooted.join(unclosed, "key", "left_semi").select("doc_id", "root").distinct(), "members")
    rest = materialize(_prefix_pairs(shown, members), "rest")
    return found.union(_verified(shown, rest))


def _told_apart(docs: DataFrame) -> DataFrame:
    """(doc_id, text, row) of `docs`: rows numbered by doc_id and hash of text, equal ones alike."""
    hashed = docs.select("doc_id", F.xxhash64("text").alias("hash")).filter(F.col("doc_id").isNotNull()).distinct()
    number = dense_key(hashed, ["doc_id", "hash"], "number")
    rows = docs.select("doc_id", F.xxhash64("text").alias("hash"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows.join(number, ["doc_id", "hash"], "left").select(F.col("number").alias("doc_id"), "row.text", "row")


def one_of_each(docs: DataFrame) -> DataFrame:
    """`docs` with one row of each group of near-duplicates, that of least doc_id, as `_one_of_each` tells.

    Rows of one doc_id with different texts are documents of their own, ordered by a hash of the text.
    """
    ids = docs.select("doc_id", F.xxhash64("text").alias("hash")).groupBy("doc_id")
    differ = ids.agg(F.min("hash").alias("low"), F.max("hash").alias("high")).filter(F.col("low") < F.col("high"))
    if differ.filter(F.col("doc_id").isNotNull()).isEmpty():
        return _one_of_each(docs)
    kept = _one_of_each(materialize(_told_apart(docs), "documents"))
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def _one_of_each(docs: DataFrame) -> DataFrame:
    """`docs` with one row of each group of near-duplicates, that of least doc_id.

    Documents are linked by their fingerprints, as in `simhash_components`; those that are left are
    then linked if they share SIMILARITY of all their distinct shingles of NEAR_SHINGLE words. Of
    repeated rows of one doc_id one stays. A row without doc_id can't be told from others and stays.
    An empty table stays empty. Columns are as before, whatever their names.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    first = simhash_components(docs).filter(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    first = materialize(first, "first")
    near = components(near_links(docs, first), "near")
    copies = near.filter(F.col("node") != F.col("root")).select(F.col("node").alias("doc_id"))
    kept = docs.join(first.join(copies, "doc_id", "left_anti"), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.select(*columns).union(docs.filter(F.col("doc_id").isNull()))
