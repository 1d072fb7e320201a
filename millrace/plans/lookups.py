"""The eleven lookup tables."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.distinct import LEVELS, distinct_names
from millrace.operators.keys import dense_key, extend_key
from millrace.registry import BY_NAME, BY_PATH, LOOKUPS, LookupSpec, check_mode, with_ancestors
from millrace.session import materialize


def build_lookups(
    records: DataFrame,
    keys: Iterable[str] = tuple(LOOKUPS),
    mode: str = BY_PATH,
    known: dict[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """The requested lookups and their parents, from a single pass over `records`.

    `known` holds the same lookups as an earlier run built them: their rows and ids stay, whether their
    names still occur or not, and new names are numbered from the highest id on.

    Ids are dense, start at 1 and follow the sorted names, so they depend on the
    data alone. A row needs its name and its parents' names present.

    With `by_path` a city belongs to the state and country it was recorded with.
    With `by_name` it is recorded with a state name only and gets one row for
    every state of that name.
    """
    check_mode(mode)
    keys = with_ancestors(keys)
    paths = {key: LOOKUPS[key].ancestry for key in keys}
    if mode == BY_NAME and "city" in paths:
        paths["city"] = paths["city"][:2]
        names = _spread_cities(materialize(distinct_names(records, paths), "names"))
    else:
        names = distinct_names(records, paths)
    if known:
        numbered = extend_key(names, LEVELS, "id", _known_names(known, keys), within=["lookup"])
    else:
        numbered = dense_key(names, LEVELS, "id", within=["lookup"])
    numbered = _with_parent_id(numbered, keys)
    if len(keys) > 1:
        numbered = materialize(numbered, "lookups")
    return {key: _table(numbered, LOOKUPS[key]) for key in keys}


def _spread_cities(names: DataFrame) -> DataFrame:
    """Complete the (city, state) pairs with each country that has a state of that name."""
    is_city = F.col("lookup") == "city"
    states = names.where(F.col("lookup") == "state_provinces").select(
        F.col("name").alias("parent"), F.col("parent").alias("grandparent")
    )
    cities = names.where(is_city).drop("grandparent").join(states, "parent")
    return names.where(~is_city).union(cities.select(*names.columns))


def _known_names(known: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """(lookup, name, parent, grandparent, id) of lookups built before."""
    parts = []
    for key in keys:
        names, up = [], key
        while up:
            names.append(F.col(LOOKUPS[up].name))
            up = LOOKUPS[up].parent
        names += [F.lit(None).cast("string")] * (len(LEVELS) - len(names))
        columns = [column.alias(level) for column, level in zip(names, LEVELS, strict=True)]
        parts.append(lookup_paths(known, key).select(F.lit(key).alias("lookup"), *columns, F.col(LOOKUPS[key].id).cast("bigint").alias("id")))
    return reduce(DataFrame.union, parts)


def _with_parent_id(numbered: DataFrame, keys: list[str]) -> DataFrame:
    """Add the id of the row one level up, for all hierarchies in one join.

    Only rows that have a parent are joined, and only with rows that can be one;
    the others, all flat lookups among them, take no part.
    """
    parents = {key: LOOKUPS[key].parent for key in keys if LOOKUPS[key].parent}
    if not parents:
        return numbered.withColumn("parent_id", F.lit(None).cast("bigint"))
    numbered = materialize(numbered, "numbered")
    below = F.col("lookup").isin(list(parents))
    parent_of = F.create_map(*[F.lit(key) for pair in parents.items() for key in pair])
    above = numbered.where(F.col("lookup").isin(sorted(set(parents.values())))).select(
        F.col("lookup").alias("above_lookup"),
        F.col("name").alias("above_name"),
        F.col("parent").alias("above_parent"),
        F.col("id").alias("parent_id"),
    )
    same_path = [
        F.try_element_at(parent_of, F.col("lookup")) == F.col("above_lookup"),
        F.col("parent") == F.col("above_name"),
        F.col("grandparent").eqNullSafe(F.col("above_parent")),
    ]
    joined = numbered.where(below).join(above, same_path, "left")
    roots = numbered.where(~below).withColumn("parent_id", F.lit(None).cast("bigint"))
    return joined.drop("above_lookup", "above_name", "above_parent").unionByName(roots)


def _table(numbered: DataFrame, spec: LookupSpec) -> DataFrame:
    columns = [F.col("id").cast(spec.id_type).alias(spec.id), F.col("name").alias(spec.name)]
    if spec.parent:
        above = LOOKUPS[spec.parent]
        columns.append(F.col("parent_id").cast(above.id_type).alias(above.id))
    return numbered.where(F.col("lookup") == spec.key).select(*columns)


def lookup_paths(lookups: dict[str, DataFrame], key: str) -> DataFrame:
    """The lookup with its ancestors' rows joined on: the names of its full path."""
    rows, parent = lookups[key], LOOKUPS[key].parent
    while parent:
        rows = rows.join(lookups[parent], LOOKUPS[parent].id)
        parent = LOOKUPS[parent].parent
    return rows
