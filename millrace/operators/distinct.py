"""Distinct values of many columns in one pass over the records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEVELS = ("name", "parent", "grandparent")


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct combinations of `columns` in which every one is present."""
    return df.select(*columns).dropna(how="any").distinct()


def distinct_names(df: DataFrame, paths: Mapping[str, Sequence[str]]) -> DataFrame:
    """(lookup, name, parent, grandparent): the distinct complete paths of every lookup.

    `paths` gives, per lookup, the columns from its own level upwards. Each
    record is read once and emits one short row per lookup; partial aggregation
    then removes the repeats before the only shuffle, so a name that holds a
    third of the records costs no more than any other.
    """
    cells = []
    for lookup, columns in paths.items():
        if len(columns) > len(LEVELS):
            raise ValueError(f"{lookup} has {len(columns)} levels, more than {len(LEVELS)}")
        complete = F.lit(True)
        for column in columns:
            complete = complete & df[column].isNotNull()
        levels = [df[column].cast("string") for column in columns]
        levels[0] = F.when(complete, levels[0])
        levels += [F.lit(None).cast("string")] * (len(LEVELS) - len(levels))
        cells += [F.lit(lookup), *levels]
    stacked = df.select(F.stack(F.lit(len(paths)), *cells).alias("lookup", *LEVELS))
    return stacked.where(F.col("name").isNotNull()).distinct()
