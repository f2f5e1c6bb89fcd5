"""Applying changes to a current-state relation.

Parquet has no MERGE, so each operator returns the new state as a DataFrame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.latest import latest_per_key, merge_source


def merge_changes(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target after a batch of changes: newest change per key deletes, replaces or inserts.

    A change whose delete flag is null fires no arm and leaves its key alone.
    The target carries no LSN, so a late batch with older changes wins; use
    `streaming.state_log` with `guard=True` where that may happen.

    The target is only anti-joined with the batch's keys: when the batch is
    small the join is a broadcast and the target is not shuffled.
    """
    source = merge_source(batch, keys).where(F.col("is_deleted").isNotNull())
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    written = source.where(~F.col("is_deleted")).select(*target.columns)
    return kept.unionByName(written)


def upsert_actions(
    target: DataFrame, stage: DataFrame, keys: Sequence[str], stamp: str = "updated_at"
) -> DataFrame:
    """Target joined with the staged rows; `__action` is insert, update or keep.

    Both sides are unique per key, so no key is hot in the join.
    """
    names = target.columns
    newest = latest_per_key(stage, keys, [F.col(stamp).desc_nulls_first()])
    old = target.select(*keys, F.struct(*names).alias("__old"))
    new = newest.select(*keys, F.struct(*names).alias("__new"))
    newer = F.col(f"__new.{stamp}") > F.col(f"__old.{stamp}")
    action = (
        F.when(F.col("__old").isNull(), "insert")
        .when(F.col("__new").isNotNull() & (F.col(f"__old.{stamp}").isNull() | newer), "update")
        .otherwise("keep")
    )
    return old.join(new, list(keys), "full").select("__old", "__new", action.alias("__action"))


def upsert_newer(
    target: DataFrame, stage: DataFrame, keys: Sequence[str], stamp: str = "updated_at"
) -> DataFrame:
    """Guarded upsert: a staged row replaces only a strictly older one; nothing is deleted.

    Repeating the same stage changes nothing, which makes the overlap of
    extract windows safe.
    """
    actions = upsert_actions(target, stage, keys, stamp)
    row = F.when(F.col("__action") == "keep", F.col("__old")).otherwise(F.col("__new"))
    return actions.select(row.alias("r")).select("r.*")


def upsert_counts(
    target: DataFrame, stage: DataFrame, keys: Sequence[str], stamp: str = "updated_at"
) -> DataFrame:
    """One row with the numbers of inserted and updated rows of that upsert."""
    return upsert_actions(target, stage, keys, stamp).agg(
        F.count_if(F.col("__action") == "insert").alias("inserted_row_count"),
        F.count_if(F.col("__action") == "update").alias("updated_row_count"),
    )


def apply_update(
    table: DataFrame, condition: Column, values: dict[str, Column], as_of: Column | None = None
) -> DataFrame:
    """Range update. Changed rows get `as_of` as their change stamp."""
    changes = dict(values)
    if as_of is not None:
        changes["updated_at"] = as_of
    hit = F.coalesce(condition, F.lit(False))
    return table.withColumns(
        {name: F.when(hit, value).otherwise(F.col(name)) for name, value in changes.items()}
    )


def apply_delete(table: DataFrame, condition: Column) -> DataFrame:
    """Range delete; rows whose condition is null stay."""
    return table.where(~F.coalesce(condition, F.lit(False)))


def apply_insert(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Insert-select."""
    return table.unionByName(rows.select(*table.columns))
