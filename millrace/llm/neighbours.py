"""Approximate nearest neighbours by NN-descent and greedy graph search, for the largest inner product.

Inner product is turned into the cosine of vectors with one more component that makes all of equal
length. Equal vectors are one node. Random-projection trees, whose splits are set on a bounded
sample, deal all nodes into small leaves, and neighbours within a leaf start the graph. NN-descent
then joins neighbours of neighbours: each node's neighbours, in both directions, meet with their
vectors, those pairs of which one is new are compared, and whoever improves a list is sent there,
until few lists change. A node none of whose neighbours is new gathers nothing.
Queries walk the finished graph: each round the best nodes seen but not yet visited are joined with
their neighbours.

Vectors that guide descent and walk are rounded to two bytes a component. Nodes are compared by their
distance, centred within a group, so nearly equal ones are told apart too. Of a walk's pool all those
are scored on the original vectors, in double precision, that the rounding leaves in doubt. Nodes are
dealt into even buckets, so no join has a key that is heavier than a node's list.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import bucket_of, shuffle_partitions
from millrace.session import materialize

#: Neighbours kept for each node, and reverse neighbours a join looks at, the nearest first.
DEGREE = 32
REVERSE = 32
#: Nodes of a leaf, about, and trees.
LEAF = 1000
TREES = 6
#: Vectors the trees' splits are set on, and their bytes, at most.
SAMPLE = 8192
SAMPLE_BYTES = 16 << 20
#: NN-descent ends when less than this share of all list entries is new, and after so many rounds at most.
CHANGED = 0.002
ROUNDS = 12
#: Best nodes a query keeps, and nodes it visits in the first rounds. Then come more rounds like the
#: last, until each query has visited its best AHEAD, and so many at most.
POOL = 400
VISITS = (32, 64, 96, 128, 160)
AHEAD = 64
MORE_VISITS = 12
#: Slices a crowded leaf is cut into by quantiles.
SLICES = 256
#: Bytes of the vectors sent to neighbours, about, that a task handles in a round.
TASK_BYTES = 32 << 20

#: Steps a component is rounded to, either side of zero, and what is worse than any likeness.
STEPS = 32767
NONE = -3.0

_LIST = "bucket int, id long, nbr binary, score binary, fresh binary"


def _rounded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows as two-byte integers, and what to multiply them by."""
    scale = np.abs(x).max(1, keepdims=True) / STEPS
    scale[scale == 0] = 1
    return np.rint(x / scale).astype("<i2"), scale[:, 0].astype(np.float32)


def _likeness(x: np.ndarray) -> np.ndarray:
    """Minus half the squared distance of each two rows: their cosine less one. Centred, so that
    rows which differ little don't drown in the rounding of what they share."""
    x = x - x.mean(0)
    half = (x * x).sum(1) / 2
    return np.minimum(x @ x.T - half[:, None] - half[None, :], 0)


def _packed(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as binary values."""
    rows = np.ascontiguousarray(rows)
    step = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int64) * step
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows.tobytes())]
    ).cast(pa.binary())


def _matrix(column, kind, width: int) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.frombuffer(b"".join(values.to_pylist()), dtype=kind).reshape(-1, width)


def _best(owner: np.ndarray, other: np.ndarray, score: np.ndarray, fresh: np.ndarray, most: int):
    """Of each owner's (other, score) the best `most`, each other once; a known one counts as not fresh."""
    order = np.lexsort((fresh, other, owner))
    owner, other, score, fresh = owner[order], other[order], score[order], fresh[order]
    keep = np.ones(len(owner), dtype=bool)
    keep[1:] = (owner[1:] != owner[:-1]) | (other[1:] != other[:-1])
    owner, other, score, fresh = owner[keep], other[keep], score[keep], fresh[keep]
    order = np.lexsort((other, -score, owner))
    owner, other, score, fresh = owner[order], other[order], score[order], fresh[order]
    first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else np.empty(0, dtype=np.int64)
    size = np.diff(np.append(first, len(owner)))
    rank = np.arange(len(owner)) - np.repeat(first, size)
    keep = rank < most
    return owner[keep], other[keep], score[keep], fresh[keep]


def _lists(bucket: int, owner, other, score, fresh) -> pa.Table:
    """Rows of (owner, its others, scores and whether they are fresh), from arrays sorted by owner."""
    first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else np.empty(0, dtype=np.int64)
    end = np.append(first, len(owner))[1:].astype(np.int64)

    def cut(values: np.ndarray) -> pa.Array:
        raw, step = values.tobytes(), values.itemsize
        return pa.array([raw[a * step : b * step] for a, b in zip(first.tolist(), end.tolist(), strict=True)], pa.binary())

    return pa.table({
        "bucket": pa.array(np.full(len(first), bucket, dtype=np.int32)), "id": pa.array(owner[first], pa.int64()),
        "nbr": cut(other.astype("<i8")), "score": cut(score.astype("<f4")), "fresh": cut(fresh.astype(np.int8)),
    })


def _least(lists: pa.Table) -> np.ndarray:
    """The least score of each row's list; no list is empty."""
    return np.array([np.frombuffer(s, dtype="<f4").min() for s in lists["score"].to_pylist()], dtype=np.float32)


def _flat(lists: pa.Table):
    """The arrays `_lists` was made from."""
    nbr = lists["nbr"].to_pylist()
    size = np.fromiter((len(n) // 8 for n in nbr), dtype=np.int64, count=len(nbr))
    owner = np.repeat(lists["id"].to_numpy(), size)
    join = lambda name, kind: np.frombuffer(b"".join(lists[name].to_pylist()), dtype=kind)
    return owner, np.frombuffer(b"".join(nbr), dtype="<i8"), join("score", "<f4"), join("fresh", np.int8)


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, vector) that take part, each id once.

    Null ids, and vectors that are null, zero, or have null or non-finite components, take no part,
    nor do vectors whose length isn't the most frequent one. Of several vectors of one id the least is taken.
    """
    v = F.col(vector_column).cast("array<float>")
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), v.alias("vector")).filter(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0)
    )
    rows = rows.filter(F.forall("vector", lambda x: x.isNotNull()))
    rows = rows.filter(F.forall("vector", lambda x: ~F.isnan(x) & (F.abs(x) < float("inf"))))
    rows = rows.filter(F.exists("vector", lambda x: x != 0))
    lengths = rows.groupBy(F.size("vector").alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    most = lengths.orderBy(F.desc("rows"), "n").first()
    if most is None:
        return rows
    return rows.filter(F.size("vector") == most["n"]).groupBy("vec_id").agg(F.min("vector").alias("vector"))


class _Space:
    """Nodes with their vectors, dealt into `buckets`, or more if those would hold over TASK_BYTES in a round."""

    def __init__(self, nodes: DataFrame, buckets: int):
        norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
        count, longest, self.width = nodes.agg(F.count(F.lit(1)), F.max(norm), F.max(F.size("vector"))).first()
        self.count, self.longest = count, longest
        sent = self.count * 2 * DEGREE * ((self.width or 0) + 32)
        self.buckets = max(buckets, sent // TASK_BYTES)
        self.nodes = nodes.select(bucket_of(self.buckets, "id").alias("bucket"), "id", "vector")
        self.tasks = max(2 * nodes.sparkSession.sparkContext.defaultParallelism, sent // TASK_BYTES)

    def fewer(self, df: DataFrame) -> DataFrame:
        """`df` in as many tasks as the size of the table calls for: small rounds are neither cut
        into tasks nor written as files of a few rows."""
        return df.coalesce(int(self.tasks))

    def __getstate__(self):
        """What tasks need of it: everything but the table."""
        return {k: v for k, v in vars(self).items() if k != "nodes"}

    def lengthened(self, x: np.ndarray) -> np.ndarray:
        """Rows with one more component, all of length one."""
        x = x.astype(np.float64) / self.longest
        rest = np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(1, keepdims=True)))
        return np.hstack([x, rest]).astype(np.float32)

    def vectors(self, table) -> np.ndarray:
        column = table["vector"]
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, self.width)


def _forest(space: _Space) -> list[tuple[np.ndarray, np.ndarray]]:
    """Splits of each tree as (directions, thresholds), in the order of a heap; set on a bounded sample."""
    part = 1 << 20
    most = max(64, min(SAMPLE, SAMPLE_BYTES // (4 * (space.width + 1))))
    share = int(part * min(1.0, most / max(space.count, 1)))
    drawn = space.nodes.filter(F.pmod(F.xxhash64("id", F.lit("tree")), F.lit(part)) < share).select("id", "vector")
    x = space.lengthened(space.vectors(drawn.limit(2 * most).toArrow().sort_by("id")))
    depth = max(0, int(np.ceil(np.log2(max(1, space.count) / LEAF))))
    depth = min(depth, int(np.log2(max(2, len(x)) / 2)))
    random, trees = np.random.default_rng(11), []
    for _ in range(TREES if depth else 1):
        directions = np.zeros((2**depth, space.width + 1), dtype=np.float32)
        thresholds = np.zeros(2**depth, dtype=np.float32)
        leaf = np.ones(len(x), dtype=np.int64)
        for node in range(1, 2**depth):
            own = np.flatnonzero(leaf == node)
            if len(own) > 1:
                a, b = x[random.choice(own, 2, replace=False)]
                directions[node] = a - b
                value = x[own] @ directions[node]
                thresholds[node] = np.median(value)
                leaf[own] = 2 * node + (value > thresholds[node])
            else:
                leaf[own] = 2 * node
        trees.append((directions, thresholds))
    return trees


def _sliced(dealt: DataFrame, sizes: DataFrame) -> DataFrame:
    """(leaf, id, vector, part) of the dealt nodes: the crowded leaves, `sizes` (leaf, n), in parts of 2 * LEAF, about.

    SLICES along `along` at most; if there must be more parts, each slice is cut at random. There are no
    more crowded leaves than leaves of the trees, so they are broadcast.
    """
    steps = F.percentile_approx("along", [i / SLICES for i in range(1, SLICES)], 10 * SLICES).alias("steps")
    parts = F.ceil(F.first("n") / (2 * LEAF)).cast("long").alias("parts")
    crowded = dealt.join(F.broadcast(sizes), "leaf").groupBy("leaf").agg(parts, steps)
    cut = F.size(F.filter("steps", lambda s: s < F.col("along")))
    whole = F.floor(cut * F.col("parts") / SLICES)
    finer = cut + SLICES * F.pmod(F.xxhash64("id", "leaf"), F.ceil(F.col("parts") / SLICES))
    part = F.when(F.col("parts") <= SLICES, whole).when(F.col("parts") > SLICES, finer).otherwise(0)
    return dealt.join(crowded, "leaf", "left").select("leaf", "id", "vector", part.cast("long").alias("part"))


def _start(space: _Space) -> DataFrame:
    """The first lists: each node's nearest in its leaf of each tree.

    A leaf of more than twice LEAF nodes, as vectors nearer to each other than the sample can tell
    make one, is cut into slices along a direction of its own, by quantiles over all its nodes.
    """
    trees = _forest(space)
    sent = space.nodes.sparkSession.sparkContext.broadcast(trees)
    buckets = space.buckets

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            x = space.lengthened(space.vectors(table))
            for t, (directions, thresholds) in enumerate(sent.value):
                leaf = np.ones(len(x), dtype=np.int64)
                while len(leaf) and leaf[0] < len(thresholds):
                    value = (x * directions[leaf]).sum(1)
                    leaf = 2 * leaf + (value > thresholds[leaf])
                along = x.astype(np.float64) @ np.random.default_rng(t).normal(size=x.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array((np.int64(t) << 40) | leaf), batch.column(0), batch.column(1), pa.array(along)],
                    names=["leaf", "id", "vector", "along"],
                )

    def nearest(table: pa.Table) -> pa.Table:
        ids, x = table["id"].to_numpy(), space.lengthened(space.vectors(table))
        x = x - x.mean(0)
        half = (x * x).sum(1) / 2
        owner, other, score = [], [], []
        most = min(DEGREE, len(ids) - 1)
        for at in range(0, len(ids) if most > 0 else 0, 512):
            s = x[at : at + 512] @ x.T - half[at : at + 512, None] - half[None, :]
            s[np.arange(len(s)), np.arange(at, at + len(s))] = -np.inf
            top = np.argpartition(-s, most - 1, axis=1)[:, :most]
            owner.append(np.repeat(ids[at : at + len(s)], most))
            other.append(ids[top].ravel())
            score.append(np.take_along_axis(s, top, 1).ravel())
        if not owner:
            return _LISTS_EMPTY
        owner, other, score = np.concatenate(owner), np.concatenate(other), np.concatenate(score)
        return _lists(0, owner, other, score, np.ones(len(owner), dtype=np.int8))

    def merge(table: pa.Table) -> pa.Table:
        return _lists(table["bucket"][0].as_py(), *_best(*_flat(table), DEGREE))

    kind = "leaf long, id long, vector array<float>, along double"
    dealt = space.nodes.select("id", "vector").mapInArrow(deal, kind)
    sizes = dealt.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 2 * LEAF)
    sizes = materialize(sizes.coalesce(1), "crowded")
    sized = dealt.select("leaf", "id", "vector", F.lit(0).cast("long").alias("part"))
    if not sizes.isEmpty():
        sized = _sliced(dealt, sizes)
    lists = sized.groupBy("leaf", "part").applyInArrow(nearest, _LIST)
    lists = space.fewer(lists.withColumn("bucket", bucket_of(buckets, "id")))
    return lists.groupBy("bucket").applyInArrow(merge, _LIST)


_LISTS_EMPTY = _lists(0, *(np.empty(0, dtype=k) for k in (np.int64, np.int64, np.float32, np.int8)))
_NEAR = "bucket int, at long, id long, vector binary, scale float, worst float, fresh byte"


def _met(space: _Space, graph: DataFrame, fresh_only: bool = False) -> DataFrame:
    """For each node `at` its neighbours in both directions with rounded vectors, dealt by `at`.

    `worst` is the least score in a neighbour's own list, what a new neighbour of it must beat.
    With `fresh_only`, only for those nodes that have a fresh neighbour.
    """
    buckets = space.buckets

    def arrows(back: bool) -> DataFrame:
        """(at, id, score, fresh): id is seen from at, in the direction of the lists or back."""

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                owner, other, score, fresh = _flat(pa.Table.from_batches([batch]))
                at, seen = (other, owner) if back else (owner, other)
                columns = [pa.array(x) for x in (at, seen, score, fresh)]
                yield pa.RecordBatch.from_arrays(columns, names=["at", "id", "score", "fresh"])

        return graph.mapInArrow(run, "at long, id long, score float, fresh byte")

    def send(links: pa.Table, nodes: pa.Table) -> pa.Table:
        ids = nodes["id"].to_numpy()
        order = np.argsort(ids)
        x, scale = _rounded(space.lengthened(space.vectors(nodes)))
        worst = nodes["worst"].to_numpy()
        row = order[np.searchsorted(ids[order], links["id"].to_numpy())] if links.num_rows else np.empty(0, dtype=np.int64)
        return pa.table({
            "bucket": pa.array(np.zeros(len(row), dtype=np.int32)), "at": links["at"], "id": links["id"],
            "vector": _packed(x[row]), "scale": scale[row], "worst": worst[row].astype(np.float32), "fresh": links["fresh"],
        })

    # the limit on the rank is applied before the shuffle too, so a node that is in very many lists gathers few rows
    nearest = Window.partitionBy("at").orderBy(F.desc("score"), "id")
    reverse = arrows(back=True).withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= REVERSE)
    links = arrows(back=False).drop("score").union(reverse.select("at", "id", "fresh"))
    if fresh_only:
        any_fresh = F.max("fresh").over(Window.partitionBy("at"))
        links = links.withColumn("any", any_fresh).filter(F.col("any") > 0).drop("any")
    links = links.groupBy("at", "id").agg(F.max("fresh").alias("fresh"))
    links = space.fewer(links.withColumn("bucket", bucket_of(buckets, "id")))

    def ends(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            worst = [
                np.frombuffer(s, dtype="<f4").min() if len(s) >= 4 * DEGREE else NONE for s in batch.column(3).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(worst, pa.float32())], names=["of", "worst"])

    limits = graph.mapInArrow(ends, "of long, worst float")
    nodes = space.nodes.join(limits, F.col("id") == F.col("of"), "left").select(
        "bucket", "id", "vector", F.coalesce("worst", F.lit(NONE).cast("float")).alias("worst")
    )
    met = links.groupBy("bucket").cogroup(nodes.groupBy("bucket")).applyInArrow(send, _NEAR)
    return space.fewer(met.withColumn("bucket", bucket_of(buckets, "at")))


def _groups(sorted_ids: np.ndarray) -> Iterator[tuple[int, int]]:
    first = np.flatnonzero(np.append(True, sorted_ids[1:] != sorted_ids[:-1])) if len(sorted_ids) else np.empty(0, int)
    yield from zip(first.tolist(), np.append(first, len(sorted_ids))[1:].tolist(), strict=True)


def _descend(space: _Space, graph: DataFrame) -> DataFrame:
    """One round of NN-descent."""
    width = space.width + 1

    def compare(table: pa.Table) -> pa.Table:
        at = table["at"].to_numpy()
        order = np.argsort(at, kind="stable")
        ids, scale = table["id"].to_numpy()[order], table["scale"].to_numpy()[order]
        worst, fresh = table["worst"].to_numpy()[order], table["fresh"].to_numpy()[order].astype(bool)
        x = _matrix(table["vector"], "<i2", width)[order]
        owner, other, score = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.float32)]
        for a, b in _groups(at[order]):
            if not fresh[a:b].any():
                continue
            y = x[a:b].astype(np.float32) * scale[a:b, None]
            s = _likeness(y)
            good = (s > worst[a:b, None]) & (fresh[a:b, None] | fresh[None, a:b])
            np.fill_diagonal(good, False)
            i, j = np.nonzero(good)
            owner.append(ids[a + i])
            other.append(ids[a + j])
            score.append(s[i, j])
        owner, other, score = np.concatenate(owner), np.concatenate(other), np.concatenate(score)
        return _lists(0, *_best(owner, other, score, np.ones(len(owner), dtype=np.int8), DEGREE))

    def merge(old: pa.Table, new: pa.Table) -> pa.Table:
        a, b = _flat(old), _flat(new)
        a = (*a[:3], np.zeros(len(a[0]), dtype=np.int8))
        table = _best(*(np.concatenate(p) for p in zip(a, b, strict=True)), DEGREE)
        bucket = (old if old.num_rows else new)["bucket"][0].as_py()
        return _lists(bucket, *table)

    found = _met(space, graph, fresh_only=True).groupBy("bucket").applyInArrow(compare, _LIST)
    found = space.fewer(found.withColumn("bucket", bucket_of(space.buckets, "id")))
    return graph.groupBy("bucket").cogroup(found.groupBy("bucket")).applyInArrow(merge, _LIST)


def neighbour_graph(nodes: DataFrame, rounds: int = ROUNDS) -> tuple[_Space, DataFrame]:
    """The graph over `nodes` (id, vector): a list of up to DEGREE near nodes for each, dealt by bucket.

    Rounds go on, at every size, until less than CHANGED of all entries is new, `rounds` at most.
    """
    space = _Space(materialize(nodes, "nodes"), max(1, 2 * shuffle_partitions(nodes.sparkSession)))
    graph = materialize(space.fewer(_start(space)), "graph")
    new = F.length(F.translate(F.hex("fresh"), "0", ""))
    for _ in range(rounds):
        graph = materialize(space.fewer(_descend(space, graph)), "graph")
        changed, entries = graph.agg(F.sum(new), F.sum(F.length("fresh"))).first()
        if (changed or 0) <= CHANGED * (entries or 0):
            break
    return space, graph


def _walk(space: _Space, graph: DataFrame, queries: DataFrame, most_returned: int) -> DataFrame:
    """(query, id) of the best nodes that greedy search from each query's own node finds.

    At least the best `most_returned`, and all whose rounded scores can't be told from the last of these.
    """
    width = space.width + 1
    buckets = space.buckets
    # kept in the partitioning all rounds join on; what a lost executor held is made again from the written graph
    layout = max(shuffle_partitions(graph.sparkSession), int(space.tasks))
    met = _met(space, graph).select("bucket", "at", "id", "vector", "scale")
    met = met.repartition(layout, "bucket").persist(StorageLevel.DISK_ONLY)

    def begin(table: pa.Table) -> pa.Table:
        # a query's own node is its first place to visit
        ids = table["id"].to_numpy()
        return _lists(0, ids, ids, np.full(len(ids), 2.0, dtype=np.float32), np.ones(len(ids), dtype=np.int8))

    # the number of arguments tells Spark what to pass, so `most` is bound by a closure
    def visits(most: int):
        return lambda pool, vectors: visited_next(pool, vectors, most)

    def merges(most: int):
        return lambda pool, found: merge(pool, found, most)

    def visited_next(table: pa.Table, vectors: pa.Table, most: int) -> pa.Table:
        owner, other, score, fresh = _flat(table)
        full = np.fromiter((len(n) >= 8 * POOL for n in table["nbr"].to_pylist()), dtype=bool, count=table.num_rows)
        worst = dict(zip(table["id"].to_pylist(), np.where(full, _least(table), -2.0).tolist(), strict=True))
        new = fresh.astype(bool)
        owner, other, _, _ = _best(owner[new], other[new], score[new], fresh[new], most)
        ids = vectors["id"].to_numpy()
        order = np.argsort(ids)
        x = space.vectors(vectors).astype(np.float32)
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        row = order[np.searchsorted(ids[order], owner)]
        limit = np.array([worst[i] for i in owner.tolist()], dtype=np.float32)
        return pa.table({"at": other, "query": owner, "worst": limit, "vector": _packed(np.hstack([x, np.zeros((len(x), 1), np.float32)])[row])})

    def look(near: pa.Table, asked: pa.Table) -> pa.Table:
        if not near.num_rows or not asked.num_rows:
            return _LISTS_EMPTY
        at, ids = near["at"].to_numpy(), near["id"].to_numpy()
        order = np.argsort(at, kind="stable")
        at, ids, scale = at[order], ids[order], near["scale"].to_numpy()[order]
        x = _matrix(near["vector"], "<i2", width)[order]
        q_at, query, worst = (asked[c].to_numpy() for c in ("at", "query", "worst"))
        q = _matrix(asked["vector"], np.float32, width)
        order = np.argsort(q_at, kind="stable")
        q_at, query, worst, q = q_at[order], query[order], worst[order], q[order]
        owner, other, score = [], [], []
        for a, b in _groups(q_at):
            lo, hi = np.searchsorted(at, q_at[a]), np.searchsorted(at, q_at[a], side="right")
            s = q[a:b] @ (x[lo:hi].astype(np.float32) * scale[lo:hi, None]).T
            i, j = np.nonzero(s > worst[a:b, None])
            owner.append(query[a + i])
            other.append(ids[lo + j])
            score.append(s[i, j])
        owner, other, score = np.concatenate(owner), np.concatenate(other), np.concatenate(score)
        return _lists(0, *_best(owner, other, score, np.ones(len(owner), dtype=np.int8), POOL))

    def merge(pool: pa.Table, found: pa.Table, most: int) -> pa.Table:
        owner, other, score, fresh = _flat(pool)
        new = np.flatnonzero(fresh)
        # what was visited last round is no longer fresh
        v_owner, v_other, _, _ = _best(owner[new], other[new], score[new], fresh[new], most)
        visited = (v_owner, v_other, np.full(len(v_owner), -2.0, np.float32), np.zeros(len(v_owner), np.int8))
        order = np.lexsort((other, owner))
        owner, other, score, fresh = owner[order], other[order], score[order], fresh[order].copy()
        seen = {*zip(visited[0].tolist(), visited[1].tolist(), strict=True)}
        fresh[[i for i, p in enumerate(zip(owner.tolist(), other.tolist(), strict=True)) if p in seen]] = 0
        parts = [np.concatenate(p) for p in zip((owner, other, score, fresh), _flat(found), strict=True)]
        return _lists(pool["bucket"][0].as_py() if pool.num_rows else 0, *_best(*parts, POOL))

    near = met.groupBy("bucket")
    pool = queries.select("bucket", "id").groupBy("bucket").applyInArrow(begin, _LIST)
    pool = materialize(space.fewer(pool.withColumn("bucket", bucket_of(buckets, "id"))), "pool")
    left = F.instr(F.hex(F.substring("fresh", 1, AHEAD)), "1") > 0
    for i, most in enumerate((1, *VISITS, *[VISITS[-1]] * MORE_VISITS)):
        if i > len(VISITS) and pool.filter(left).isEmpty():
            break
        asked = pool.groupBy("bucket").cogroup(queries.groupBy("bucket")).applyInArrow(
            visits(most), "at long, query long, worst float, vector binary"
        )
        asked = space.fewer(asked.withColumn("bucket", bucket_of(buckets, "at")))
        found = near.cogroup(asked.groupBy("bucket")).applyInArrow(look, _LIST)
        found = space.fewer(found.withColumn("bucket", bucket_of(buckets, "id")))
        merged = pool.groupBy("bucket").cogroup(found.groupBy("bucket")).applyInArrow(merges(most), _LIST)
        pool = materialize(space.fewer(merged), "pool")
    met.unpersist()

    # two scores of rounded rows of length one at most can't be told apart if they differ by less
    margin = np.sqrt(width) / STEPS + 1e-6

    def best(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, other, score, fresh = _best(*_flat(pa.Table.from_batches([batch])), POOL)
            keep = np.zeros(len(owner), dtype=bool)
            for a, b in _groups(owner):
                keep[a:b] = score[a:b] >= score[min(b, a + most_returned) - 1] - margin
            owner, other = owner[keep], other[keep]
            yield pa.RecordBatch.from_arrays([pa.array(owner), pa.array(other)], names=["query", "id"])

    return pool.mapInArrow(best, "query long, id long")


def _exact(queries: DataFrame, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(query, id, score) with the inner product of the original vectors in double precision."""
    asked = pairs.join(queries.select(F.col("id").alias("query"), F.col("vector").alias("q")), "query")
    both = asked.join(nodes.select("id", F.col("vector").alias("x")), "id")

    def dot(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q, x = (
                batch.column(i).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)
                for i in (2, 3)
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array((q * x).sum(1))], names=["query", "id", "score"]
            )

    return both.select("query", "id", "q", "x").mapInArrow(dot, "query long, id long, score double")


def nearest_neighbours(vectors: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id",
                       vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of largest inner product found for each query row.

    Queries are the rows of which `is_query`, a condition on the column `vec_id`, holds; a row is no
    candidate for itself. Ranks start from 1, equal scores are in the order of vec_id. See `usable`
    for the rows that take part; an empty table gives no row. Other columns are ignored.
    """
    rows = materialize(usable(vectors, id_column, vector_column), "vectors")
    # equal vectors are one node, named by its least id; no more than k + 1 members can be returned
    classes = rows.groupBy("vector").agg(F.min("vec_id").alias("id"))
    if rows.isEmpty():
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    space, graph = neighbour_graph(classes.select("id", "vector"))
    member = rows.join(space.nodes.select("vector", "id"), "vector").select("vec_id", "id")
    member = materialize(space.fewer(member), "members")
    within = Window.partitionBy("id").orderBy("vec_id")
    shown = member.withColumn("n", F.row_number().over(within)).filter(F.col("n") <= k + 1).select("id", "vec_id")
    asking = member.filter(is_query).select(F.col("vec_id").alias("query_id"), F.col("id").alias("query"))
    asked = asking.select(F.col("query").alias("id")).distinct()
    nodes = space.nodes.join(asked, "id", "left_semi").select("bucket", "id", "vector")
    nodes = materialize(space.fewer(nodes), "queries")
    scored = _exact(nodes, _walk(space, graph, nodes, k + 2), space.nodes)
    found = scored.join(shown, "id").select("query", "vec_id", "score")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1)
    ranked = asking.join(found, "query").filter(F.col("query_id") != F.col("vec_id"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = ranked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
