"""A Merkle manifest of a dataset: one tree a source, one tree over the sources.

Rows are numbered in the order of source and id without a global window. Each level of a tree is one
aggregation of the runs of FAN nodes and is written as node rows that know their parent, their place
in its run and their children. A recursive query then climbs from every leaf to the root, one join
with the node rows a step: it folds the leaf's own digest with its siblings' into the next one, and
appends the run it passed to its path. A path holds run numbers rather than digests, as the digests
of all runs above the first are the same for all leaves of a run; they are put together once a run.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import lower_ascii, shuffle_partitions
from millrace.session import materialize

#: Consecutive nodes that become one.
FAN = 16
#: A node's number is its first leaf's number, shifted by these bits, and its level.
LEVEL_BITS = 6
#: Level of the first nodes over the sources' roots, less one.
TOP = 32
#: Texts whose tampering is tried: those whose crc32 of the decimal doc_id this number divides.
TAMPERED = 5

_ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def field(value: Column) -> Column:
    """A value as part of a leaf: its length in bytes, a colon and itself; `-` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, source, leaf, tampered): digests of each row, and of the row with its text's A-Z lower-cased."""
    head = [field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")]
    chosen = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(TAMPERED)) == 0
    leaf = digest(*head, field(F.col("text")))
    lowered = digest(*head, field(lower_ascii(F.col("text"))))
    rows = docs.select("doc_id", "source", leaf.alias("leaf"), F.when(chosen, lowered).alias("tampered"))
    return rows.withColumn("tampered", F.coalesce("tampered", "leaf"))


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """`rows` with `base` and `pos`: a number that grows with `group`, and 0, 1, ... in it by `order`.

    `base` is the number of rows in all groups before, nulls first. Rows are sorted into ranges and
    numbered range by range; only the length of each range and of its last group is gathered, so a
    group that fills many ranges costs no more than others.
    """
    spark = rows.sparkSession
    schema = f"{rows.select('*').schema.simpleString()[7:-1]}, _range int, _row long, _pos long, _opens boolean"
    names = [*rows.columns, "_range", "_row", "_pos", "_opens"]

    def number(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, row, pos, opens, last = TaskContext.get().partitionId(), 0, 0, True, None
        for batch in batches:
            values = batch.column(group).to_pylist()
            places, first = [], []
            for i, value in enumerate(values):
                if row + i and value != last:
                    pos, opens = 0, False
                places.append(pos)
                first.append(opens)
                pos, last = pos + 1, value
            n = len(values)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * n, pa.int32()), pa.array(range(row, row + n), pa.int64()),
                 pa.array(places, pa.int64()), pa.array(first, pa.bool_())],
                names=names,
            )
            row += n

    keys = [F.col(c).asc_nulls_first() for c in (group, *order)]
    ranged = rows.repartitionByRange(shuffle_partitions(spark), *keys).sortWithinPartitions(*keys)
    placed = materialize(ranged.mapInArrow(number, schema), "numbered")
    # one row a range: how many rows, those of its last group, and whether that is its first one too
    last = F.max(F.struct("_row", "_pos", "_opens", group)).alias("last")
    first = F.min(F.struct("_row", group)).alias("first")
    ranges = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("n"), last, first).orderBy("_range").collect()
    before, shifts, open_group, open_rows = 0, [], None, 0
    for r in ranges:
        carried = open_rows if before and r.first[group] == open_group else 0
        shifts.append((r["_range"], before, carried))
        open_rows = r.last["_pos"] + 1 + (carried if r.last["_opens"] else 0)
        open_group, before = r.last[group], before + r.n
    shift = spark.createDataFrame(shifts, "_range int, _before long, _carried long")
    pos = F.col("_pos") + F.when(F.col("_opens"), F.col("_carried")).otherwise(F.lit(0))
    joined = placed.join(F.broadcast(shift), "_range").withColumn("pos", pos)
    joined = joined.withColumn("base", F.col("_before") + F.col("_row") - F.col("pos"))
    return joined.select("base", "pos", *rows.columns)


def node_id(first: Column, level: int) -> Column:
    return F.shiftleft(first, LEVEL_BITS).bitwiseOR(F.lit(level).cast("long"))


def build_levels(leaves: DataFrame, level: int, payload: list[str]) -> tuple[list[DataFrame], DataFrame, DataFrame, DataFrame]:
    """The trees over (base, pos, id, digest), a tree for each base: (levels, links, roots, leaves linked).

    `levels` are rows (id, digest, children) of the nodes above the leaves, one table a level; `links`
    rows (id, parent, slot) of those that have a parent; `roots` rows (base, id, digest) of each tree's
    last node, which is the leaf itself where it is the only one. The linked leaves are the given ones
    with their `payload`, parent and slot, nulls for an only one. A run is a group of FAN rows at most.
    """
    levels: list[DataFrame] = []
    links: list[DataFrame] = []
    roots: list[DataFrame] = []
    linked = None
    now, kept = leaves, payload
    while True:
        level += 1
        run = F.expr(f"pos div {FAN}").alias("run")
        member = F.struct("pos", "id", "digest", *kept)
        runs = now.groupBy("base", run).agg(F.sort_array(F.collect_list(member)).alias("m"))
        alone = (F.col("run") == 0) & (F.size("m") == 1)
        width = FAN ** (level % TOP)
        parent = node_id(F.col("base") + F.col("run") * F.lit(width).cast("long"), level)
        runs = materialize(runs.select(
            "base", "run", "m", F.when(~alone, parent).alias("id"), digest(F.array_join("m.digest", "")).alias("digest")
        ), "merkle")
        child = F.inline("m").alias("pos", "child", "own", *kept)
        below = runs.select("base", "id", child).withColumn("slot", F.when(F.col("id").isNotNull(), F.col("pos") % FAN).cast("int"))
        if linked is None:
            linked = below.select(
                "base", F.col("child").alias("id"), F.col("own").alias("digest"), *payload, F.col("id").alias("parent"), "slot"
            )
            kept = []
        else:
            links.append(below.filter(F.col("id").isNotNull()).select(F.col("child").alias("id"), F.col("id").alias("parent"), "slot"))
        only = F.col("m")[0]
        roots.append(runs.filter(F.col("id").isNull()).select("base", only["id"].alias("id"), only["digest"].alias("digest")))
        made = runs.filter(F.col("id").isNotNull())
        if made.isEmpty():
            break
        levels.append(made.select("id", "digest", F.col("m.digest").alias("children")))
        now = made.select("base", F.col("run").alias("pos"), "id", "digest")
    none = roots[0].select("id", F.lit(0).cast("long").alias("parent"), F.lit(0).alias("slot")).limit(0)
    return levels, reduce(DataFrame.union, links, none), reduce(DataFrame.union, roots), linked


CLIMB = f"""
WITH RECURSIVE climb(leaf_row, parent, slot, folded, path) AS (
    SELECT leaf_row, parent, slot, tampered, CAST(array() AS array<struct<parent: bigint, slot: int>>)
    FROM {{leaves}}
    UNION ALL
    SELECT leaf_row, n.parent, n.slot,
           sha2(CAST(concat(array_join(slice(children, 1, c.slot), ''), folded,
                            array_join(slice(children, c.slot + 2, {FAN}), '')) AS binary), 256),
           array_append(path, struct(c.parent AS parent, c.slot AS slot))
    FROM climb c JOIN {{nodes}} n ON c.parent = n.id
)
SELECT leaf_row, folded, path FROM climb WHERE parent IS NULL
"""


def others(children: str, slot: str) -> Column:
    """The digests of a run but one, in their order, as one text."""
    return F.concat(
        F.array_join(F.slice(children, F.lit(1), F.col(slot)), ""),
        F.array_join(F.slice(children, F.col(slot) + 2, F.lit(FAN)), ""),
    )


def climb(leaves: DataFrame, nodes: DataFrame) -> DataFrame:
    """(leaf_row, folded, path) of each of `leaves` (leaf_row, tampered, parent, slot), by a recursive query.

    One step joins all rows with `nodes` (id, parent, slot, children), so there are as many as the
    tree has levels. The session's limit for the rows of a recursion is lifted while it runs.
    """
    spark = leaves.sparkSession
    limit = spark.conf.get(_ROW_LIMIT)
    spark.conf.set(_ROW_LIMIT, "-1")
    try:
        return materialize(spark.sql(CLIMB, leaves=leaves, nodes=nodes), "climb")
    finally:
        spark.conf.set(_ROW_LIMIT, limit)


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof, proof_sha256, folded_root, verified) of each row of `docs`.

    Needs doc_id, source, lang, n_chars and text; other columns are ignored, whatever their names. Nulls
    are values of their own, a null doc_id is ordered first and never tampered with, and a null text stays
    so. Rows of equal doc_id are ordered by their digests; repeated rows are leaves each for itself. The only
    row of a table is its own root with an empty proof, an empty table gives no row. `proof` is the text of
    all siblings' digests, level by level.
    """
    rows = leaf_digests(docs)
    placed = numbered(rows, "source", ["doc_id", "leaf"])
    placed = placed.withColumn("id", node_id(F.col("base") + F.col("pos"), 0)).withColumnRenamed("leaf", "digest")
    levels, links, roots, leaves = build_levels(placed, 0, ["doc_id", "tampered"])
    # the trees' roots in the order of sources, which is that of their bases
    one = numbered(roots.withColumn("all", F.lit(0)), "all", ["base"])
    tops = materialize(one.toDF("zero", "pos", "source_base", "id", "digest", "all"), "subroots")
    above, top_links, top_roots, linked = build_levels(
        tops.select(F.col("zero").alias("base"), "pos", "id", "digest"), TOP, []
    )
    all_links = materialize(
        links.union(top_links).union(linked.filter(F.col("parent").isNotNull()).select("id", "parent", "slot")), "links"
    )
    nodes = reduce(DataFrame.union, [*levels, *above], roots.select("id", "digest", F.array("digest").alias("children")).limit(0))
    nodes = materialize(nodes.join(all_links, "id", "left"), "nodes")
    top = top_roots.first()
    root = F.lit(top["digest"] if top else None).cast("string")

    # a leaf that is its source's only one hangs in the tree over the sources
    many = leaves.filter(F.col("parent").isNotNull())
    single = leaves.filter(F.col("parent").isNull()).drop("parent", "slot").join(all_links, "id", "left")
    leaves = materialize(many.unionByName(single), "leaves")
    climbed = climb(leaves.select(F.col("id").alias("leaf_row"), "tampered", "parent", "slot"), nodes)

    # what is above the first run of a path is the same for all its leaves: put together for the first leaf of a run,
    # or for all of those that hang in the tree over the sources, where a run's first node may be no leaf
    level = F.col("id").bitwiseAND((1 << LEVEL_BITS) - 1)
    start = F.get("path", F.lit(0))
    of_sources = start["parent"].bitwiseAND((1 << LEVEL_BITS) - 1) > TOP
    first = climbed.filter((start["slot"] == 0) | of_sources).select(start["parent"].alias("run"), F.posexplode("path").alias("step", "at"))
    first = first.dropDuplicates(["run", "step"])
    steps = first.select("run", "step", F.col("at.parent").alias("id"), F.col("at.slot").alias("slot")).join(
        nodes.select("id", "digest", "children"), "id"
    )
    text = F.when(F.col("step") > 0, others("children", "slot")).otherwise(F.lit(""))
    runs = steps.groupBy("run").agg(
        F.sort_array(F.collect_list(F.struct("step", text.alias("text")))).alias("texts"),
        F.max(F.when(level < TOP, F.struct(level, "digest")))["digest"].alias("subroot"),
        F.max(F.when(F.col("step") == 0, F.col("children"))).alias("children"),
    )
    runs = runs.select("run", "subroot", "children", F.array_join("texts.text", "").alias("above"))

    held = leaves.select("doc_id", F.col("id").alias("leaf_row"), F.col("digest").alias("leaf"), F.col("parent").alias("run"), "slot")
    folded = held.join(climbed.select("leaf_row", "folded"), "leaf_row").join(runs, "run", "left")
    proof = F.coalesce(F.concat(others("children", "slot"), F.col("above")), F.lit(""))
    return folded.select(
        "doc_id", "leaf", F.coalesce("subroot", "leaf").alias("subroot"), root.alias("root"),
        proof.alias("proof"), F.sha2(proof.cast("binary"), 256).alias("proof_sha256"),
        F.col("folded").alias("folded_root"), (F.col("folded") == root).alias("verified"),
    )
