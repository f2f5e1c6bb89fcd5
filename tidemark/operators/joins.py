"""Joins of models, planned without Spark's estimates of their size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keyed_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join by shuffle and merge, whatever size Spark thinks the sides have.

    Spark estimates a model from the size of its compressed files, and a column of a payload as a small share of it. Nine
    million replayed headers were taken for less than 10 MB, and gathered in the driver to be broadcast.
    """
    return left.join(right.hint("merge"), key, how)


def hot_key_join(many: DataFrame, one: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join `many` to `one`, which is unique per `key`; one key may hold much of `many`.

    Adaptive execution splits a hot key only when both sides are shuffled for
    the join itself. A side that log replay or an aggregate has left partitioned
    by the key would be used as it is, and all rows of a hot key would meet in
    one task; recomputing the key (the greatest of it and itself, which Catalyst
    does not simplify) gives that side, the smaller one, its own shuffle.
    """
    return keyed_join(many, one.withColumn(key, F.greatest(key, key)), key, how)
