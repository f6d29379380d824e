"""Set operations on rows and arrays."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def combine_ids(sets: Sequence[DataFrame], logic: str = "and") -> DataFrame:
    """Intersection (``and``) or union (``or``) of id sets."""
    if logic == "or":
        return reduce(DataFrame.union, sets).distinct()
    return reduce(DataFrame.intersect, sets)


def concat_results(results: Sequence[DataFrame]) -> DataFrame:
    """Rows of several result tables with their columns aligned by name; absent columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), results)


def dedupe_list(values: Column) -> Column:
    """Distinct elements in first-seen order."""
    return F.array_distinct(values)


def insert_then_prune(old: DataFrame, new: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The table after a rewrite, and the ids of the old rows it no longer holds."""
    return new, old.select(key).join(new.select(key), key, "left_anti")


def bigram_set(text: Column) -> Column:
    """Distinct 2-grams of a text."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit("(?=(..))"), F.lit(1)))


def digit_in_difference(a: Column, b: Column) -> Column:
    """Whether the 2-grams the two texts do not share include a digit."""
    x, y = bigram_set(a), bigram_set(b)
    difference = F.concat(F.array_except(x, y), F.array_except(y, x))
    return F.exists(difference, lambda gram: gram.rlike("[0-9]"))
