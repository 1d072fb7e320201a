"""URL filters: block and allow rules over host suffixes and path prefixes.

Each URL is expanded into the host-suffix and path-prefix expressions that a rule could be written
as. Expressions meet rules on the first bytes of their SHA-256, full digests confirm the match, and
of the confirmed rules the longest decides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import lower_ascii

#: Bytes of the digest that are joined on.
PREFIX_BYTES = 4
#: Up to so many rules are sent to all tasks; beyond, the join is dealt out on prefix and salt.
BROADCAST_RULES = 1_000_000
SALTS = 16
DEFAULT = "allow"

Rule = tuple[str, str, str]


def rule_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """Rules (verdict, host, path) as a table."""
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def host_of(url: Column) -> Column:
    """What is between the first `://` and the next `/`, `?`, `#` or the end, A-Z lower-cased."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge_urls(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """(page_id, host, path, rule, verdict) for each row; needs page_id and url.

    A rule fits its host and all hosts below it if the path starts with its path. The longest fitting
    rule wins; of equally long ones that with the longer host, then `block`. If none fits, rule is
    null and the verdict `allow`. A null url, or one without `://`, has an empty host and path. A
    rule with a null part fits nothing. Repeated rows are judged each for itself. Other columns are
    ignored, whatever their names.
    """
    known = rules.select("verdict", F.col("host").alias("rule_host"), F.col("path").alias("rule_path")).na.drop()
    known = known.withColumn("rule", F.concat("rule_host", "rule_path"))
    # the expressions a rule could be are those with a rule's number of labels and length of path
    shape = known.agg(
        F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_set(F.size(F.split("rule_host", r"\.")))).alias("labels"),
        F.sort_array(F.collect_set(F.length("rule_path"))).alias("lengths"),
    ).first()
    split = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    if not shape["n"]:
        return split.select("*", F.lit(None).cast("string").alias("rule"), F.lit(DEFAULT).alias("verdict"))

    labels, lengths = (F.array(*map(F.lit, shape[c])) for c in ("labels", "lengths"))
    own = F.split("host", r"\.")
    suffixes = F.transform(
        F.filter(labels, lambda n: n <= F.size(own)),
        lambda n: F.array_join(F.slice(own, F.size(own) - n + 1, n), "."),
    )
    prefixes = F.transform(F.filter(lengths, lambda n: n <= F.length("path")), lambda n: F.substring("path", F.lit(1), n))
    places = split.select("host", "path").distinct()  # a hot host with one path is expanded once
    expanded = places.withColumn("suffix", F.explode(suffixes)).withColumn("prefix", F.explode(prefixes))
    expanded = expanded.select("host", "path", F.sha2(F.concat("suffix", "prefix"), 256).alias("digest"))
    expanded = expanded.withColumn("key", F.substring("digest", 1, 2 * PREFIX_BYTES))
    marked = known.withColumn("rule_digest", F.sha2("rule", 256))
    marked = marked.withColumn("key", F.substring("rule_digest", 1, 2 * PREFIX_BYTES))
    on = ["key"]
    if shape["n"] <= BROADCAST_RULES:
        marked = F.broadcast(marked)
    else:
        expanded = expanded.withColumn("salt", F.pmod(F.xxhash64("host", "path"), F.lit(SALTS)).cast("int"))
        marked = marked.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        on = ["key", "salt"]
    fits = expanded.join(marked, on).filter(F.col("digest") == F.col("rule_digest"))
    weight = F.struct(F.length("rule"), F.length("rule_host"), F.col("verdict") == "block")
    best = fits.groupBy("host", "path").agg(F.max_by(F.struct("rule", "verdict"), weight).alias("best"))
    return split.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(DEFAULT)).alias("verdict"),
    )
