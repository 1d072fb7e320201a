"""Document fingerprints: bottom-k sketches of shingle hashes, in DataFrame functions only.

The sketch of a text is the k smallest distinct 64-bit hashes of its shingles of five words, in
order. Of two sketches the k smallest hashes of their union are a sample of the united shingles;
the part of it that is in both estimates resemblance. Sketches of parts merge to that of the whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHINGLE = 5
#: Hashes of a sketch. The standard error of a resemblance is at most 0.5 / sqrt(K), here 0.044.
K = 128
#: Documents that are put in order together.
BUCKET_ROWS = 2000
#: Ranges of doc_id at most, as their bounds are part of the plan; beyond, ranges grow and are sorted on disk.
MOST_RANGES = 50_000
SALTS = 64

_SPACE = " \t\n\x0b\f\r"
_LEAST = -(1 << 63)


def _with(value: Column, use) -> Column:
    """`use` of a value that is computed once, also where `use` refers to it in a lambda."""
    return F.element_at(F.transform(F.array(value), use), 1)


def shingle_hashes(text: Column, shingle: int = SHINGLE) -> Column:
    """The hash of each run of `shingle` words; of all words if there are fewer, none of no word."""
    trimmed = F.btrim(text, F.lit(_SPACE))
    words = F.split(trimmed, "[ \\t-\\r]+")
    hashes = _with(
        words,
        lambda w: F.transform(
            F.sequence(F.lit(1), F.greatest(F.size(w) - (shingle - 1), F.lit(1))),
            lambda i: F.xxhash64(F.slice(w, i, F.lit(shingle))),
        ),
    )
    return F.when(F.length(trimmed) == 0, F.array().cast("array<bigint>")).otherwise(hashes)


def sketch(text: Column, k: int = K, shingle: int = SHINGLE) -> Column:
    """The sketch of a text; a null text counts as empty."""
    hashes = shingle_hashes(F.coalesce(text, F.lit("")), shingle)
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union of two sketched sets."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def distinct_shingles(s: Column, k: int = K) -> Column:
    """The estimated number of distinct shingles; exact below k."""
    span = (F.element_at(s, -1).cast("double") - float(_LEAST)) / float(1 << 64)
    return F.when(F.size(s) < k, F.size(s).cast("double")).otherwise((k - 1) / span)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """The estimated share of shingles in both texts among those in either; 1 for two empty texts."""
    return _with(
        merge(a, b, k),
        lambda u: F.when(F.size(u) == 0, F.lit(1.0)).otherwise(
            F.size(F.array_intersect(F.array_intersect(u, a), b)) / F.size(u)
        ),
    )


def containment(a: Column, b: Column, k: int = K) -> Column:
    """The estimated share of a's shingles that are in b; 1 for an empty a."""
    shared = resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared / distinct_shingles(a, k)))


def printed(s: Column) -> Column:
    """A sketch as hexadecimal digits, 16 for each hash."""
    return F.array_join(F.transform(s, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def merge_all(sketches: DataFrame, key: str, column: str, k: int = K) -> DataFrame:
    """(key, column): one sketch for each key, of the union of its rows' sets.

    A key with very many rows is reduced to k hashes in each of SALTS parts before they meet.
    """
    hashes = sketches.select(key, F.explode(column).alias("h")).distinct()
    salted = hashes.withColumn("salt", F.pmod(F.xxhash64("h"), F.lit(SALTS)).cast("int"))
    for parts in ([key, "salt"], [key]):
        order = Window.partitionBy(*parts).orderBy("h")
        salted = salted.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= k).drop("at")
    met = salted.groupBy(key).agg(F.sort_array(F.collect_list("h")).alias(column))
    empty = F.array().cast("array<bigint>")
    keys = sketches.select(F.col(key).alias("_key")).distinct()
    joined = keys.join(met, keys["_key"].eqNullSafe(met[key]), "left")
    return joined.select(F.col("_key").alias(key), F.coalesce(column, empty).alias(column))


def with_next(docs: DataFrame, add=None) -> DataFrame:
    """(key, text, next) of each row, `next` the (text, extras) that follow by doc_id; the first follows the last.

    `add` maps names to columns computed from text, once per row; they are found in the row and in
    `next`. Rows are dealt into ranges of doc_id of about BUCKET_ROWS rows, or more if that were
    over MOST_RANGES, so no task holds more than its ranges. The first row of each range is given to the range before it as well. A null
    doc_id comes first; rows of equal doc_id are in the order of a hash of their text.
    """
    add = add or {}
    keyed = docs.select(
        "doc_id", F.coalesce("doc_id", F.lit(_LEAST)).alias("key"), F.coalesce("text", F.lit("")).alias("text")
    )
    ids = docs.select(F.coalesce("doc_id", F.lit(_LEAST)).alias("key"))
    count, least = ids.agg(F.count(F.lit(1)), F.min("key")).first()
    n = min(MOST_RANGES, max(1, -(-count // BUCKET_ROWS)))
    cuts = [least] if count else [0]
    if n > 1:
        shares = F.split(F.lit(",".join(repr(i / n) for i in range(1, n))), ",").cast("array<double>")
        cuts = sorted({least, *ids.agg(F.percentile_approx("key", shares, F.lit(20 * n)).alias("c")).first()["c"]})
    # the range of a key by two short searches: among every width-th cut, then among those that follow
    width = math.isqrt(len(cuts)) + 1
    every, some = (F.split(F.lit(",".join(map(str, c))), ",").cast("array<bigint>") for c in (cuts, cuts[::width]))
    coarse = (F.size(F.filter(some, lambda c: c <= F.col("key"))) - 1) * width
    keyed = keyed.withColumn("coarse", coarse)
    fine = F.size(F.filter(F.slice(every, F.col("coarse") + 1, F.lit(width)), lambda c: c <= F.col("key"))) - 1
    keyed = keyed.withColumn("range", F.col("coarse") + fine)
    own = F.struct(F.col("range"), F.lit(0).alias("guest"))
    before = F.struct(F.pmod(F.col("range") - 1, F.lit(len(cuts))).alias("range"), F.lit(1).alias("guest"))
    first = F.element_at(every, F.col("range") + 1) == F.col("key")
    places = F.explode(F.when(first, F.array(own, before)).otherwise(F.array(own)))
    dealt = keyed.select("doc_id", "key", "text", places.alias("place")).select("doc_id", "key", "text", "place.*")
    dealt = dealt.repartition("range").withColumns({name: of(F.col("text")) for name, of in add.items()})
    order = Window.partitionBy("range").orderBy("guest", "key", F.xxhash64("text"), "text")
    follows = F.lead(F.struct("text", *add)).over(order)
    return dealt.withColumn("next", follows).filter(F.col("guest") == 0).drop("range", "guest", "key")


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Each text, an edited one, and how alike they are; needs doc_id and text.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next
    and n_shingles. The edited text has its last quarter replaced by as much of the beginning of the
    next document, or all of it. A null text is empty; an empty text has the empty fingerprint and
    is like no text but an empty one. Equal texts have equal fingerprints. A single document follows
    itself, an empty table gives no row. Other columns are ignored, whatever their names.
    """
    rows = with_next(docs, {"sketch": sketch})
    quarter = F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.length("text") - quarter), F.substring("next.text", F.lit(1), quarter)
    )
    rows = rows.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), edited.alias("edited"), "sketch",
        F.col("next.sketch").alias("next_sketch"),
    )
    rows = rows.withColumn("edited_sketch", sketch(F.col("edited")))
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        printed(F.col("sketch")).alias("fingerprint"), printed(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        distinct_shingles(F.col("sketch")).alias("n_shingles"),
    )
