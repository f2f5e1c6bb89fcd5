"""Newest event per key, and the current state rebuilt from it.

Every function ranks with `row_number() ... = 1`. Spark plans that with a
group limit before the shuffle, so a task sends at most one row per key and a
key that holds most of the events costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.payload import field, from_wire, malformed, wire_row, with_event
from tidemark.functions.scalars import delete_flag
from tidemark.operators.reconcile import side_by_side
from tidemark.sources.landing import table_log
from tidemark.sources.registry import ARRIVAL, TableSpec


# The event metadata that replay reads.
_RANKED_BY = ("__lsn", "__source_ts_ms", "__deleted")


def latest_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key under `order`."""
    ranking = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("__rank", F.row_number().over(ranking)).where("__rank = 1").drop("__rank")


def replay_order(nulls: str = "first") -> list[Column]:
    """Newest first by LSN, source time, arrival.

    Log replay puts a null LSN before all others, as a descending sort without
    a null clause does in the warehouse; the merge puts it last.
    """
    names = ("__lsn", "__source_ts_ms", ARRIVAL)
    if nulls == "first":
        return [F.col(name).desc_nulls_first() for name in names]
    if nulls == "last":
        return [F.col(name).desc_nulls_last() for name in names]
    raise ValueError(f"nulls must be 'first' or 'last', not {nulls!r}")


def not_deleted(deleted: Column) -> Column:
    """Delete rule of log replay: exactly the text 'true' deletes; `__op` is ignored."""
    return F.coalesce(deleted, F.lit("false")) != "true"


def _ranked_fields(spec: TableSpec) -> list[Column]:
    """What ranking needs of `__event`, and `__fault`: why it cannot be ranked, else null.

    A key, LSN or source time that is there but of the wrong type is a fault. So
    is a missing key, which would put all such events under one null.
    """

    row = F.col("__event")

    def unread(name: str) -> Column:
        return row.getField(name).isNull() & field(name, strict=False).isNotNull()

    fault = (
        F.when(row.getField(spec.primary_key).isNull(), "unreadable key")
        .when(unread("__lsn"), "unreadable __lsn")
        .when(unread("__source_ts_ms"), "unreadable __source_ts_ms")
    )
    return [
        row.getField(spec.primary_key).alias("__key"),
        row.getField("__lsn").alias("__lsn"),
        row.getField("__source_ts_ms").alias("__source_ts_ms"),
        row.getField("__deleted").alias("__deleted"),
        ARRIVAL,
        fault.alias("__fault"),
    ]


def _rankable(events: DataFrame, spec: TableSpec, quarantine: bool) -> DataFrame:
    """Events without a fault; one with a fault fails the job unless they are quarantined.

    The failure is part of the key that is ranked by.
    """
    if quarantine:
        return events.where(F.col("__fault").isNull())
    error = F.raise_error(F.concat(F.lit(f"{spec.name}: "), "__fault")).cast("bigint")
    return events.withColumn("__key", F.when(F.col("__fault").isNotNull(), error).otherwise(F.col("__key")))


def current_state(landing: DataFrame, spec: TableSpec, nulls: str = "first", quarantine: bool = False) -> DataFrame:
    """Current rows of one table as a `payload` column.

    Deletes are dropped after ranking: dropping them first would bring back the
    version before the delete. An event that cannot be ranked fails the job; with
    `quarantine` it is left to `quarantined`.
    """
    events = with_event(table_log(landing, spec.name), spec, _RANKED_BY).select("payload", *_ranked_fields(spec))
    newest = latest_per_key(_rankable(events, spec, quarantine), ["__key"], replay_order(nulls))
    return live_rows(newest).select("payload")


def newest_typed(landing: DataFrame, spec: TableSpec, nulls: str = "first", quarantine: bool = False) -> DataFrame:
    """Newest event per key with its order, `__deleted`, the wire row as `__row` and whether that is `__malformed`."""
    events = with_event(table_log(landing, spec.name), spec, _RANKED_BY).select(
        *_ranked_fields(spec),
        wire_row(spec).alias("__row"),
        malformed(spec, wire_row(spec), decimals=quarantine).alias("__malformed"),
    )
    return latest_per_key(_rankable(events, spec, quarantine), ["__key"], replay_order(nulls))


def current_typed(landing: DataFrame, spec: TableSpec, nulls: str = "first", quarantine: bool = False) -> DataFrame:
    """Current rows of one table with typed columns.

    The payload is taken apart before ranking, in one pass: the sort and the
    shuffle then carry rows a fraction of its size. A value of the wrong type is
    an error only in a row that is still current; an unreadable key, LSN or
    source time is one in any event, since it cannot be ranked. With `quarantine`
    neither fails: `quarantined` has those rows.
    """
    rows = live_rows(newest_typed(landing, spec, nulls, quarantine))
    if quarantine:
        sound = rows.where(~F.col("__malformed"))
    else:
        key = F.coalesce(F.col("__key").cast("string"), F.lit("unknown"))
        error = F.raise_error(F.concat(F.lit(f"malformed value in {spec.name}, key "), key))
        sound = rows.where(F.when(F.col("__malformed"), error).otherwise(F.lit(True)))
    columns = from_wire(spec, "__row")
    # The key is taken from the ranking, so joins on it can use its partitioning.
    columns[spec.column_names.index(spec.primary_key)] = F.col("__key").alias(spec.primary_key)
    return sound.select(*columns)


def quarantined(landing: DataFrame, spec: TableSpec, nulls: str = "first") -> DataFrame:
    """The events that `current_typed(quarantine=True)` leaves out, whole, with the reason.

    Those that cannot be ranked, and current rows with a malformed value.
    """
    events = with_event(table_log(landing, spec.name), spec, _RANKED_BY).select("payload", "__event", *_ranked_fields(spec))
    unranked = events.where(F.col("__fault").isNotNull()).select("payload", ARRIVAL, F.col("__fault").alias("reason"))
    ranked = _rankable(events.withColumn("__malformed", malformed(spec, wire_row(spec), decimals=True)), spec, True)
    newest = live_rows(latest_per_key(ranked, ["__key"], replay_order(nulls))).where("__malformed")
    return unranked.unionByName(newest.select("payload", ARRIVAL, F.lit("malformed value").alias("reason")))


def replay_account(landing: DataFrame, spec: TableSpec, nulls: str = "first") -> DataFrame:
    """One row: events = current + superseded + deleted + quarantined, each counted."""
    events = with_event(table_log(landing, spec.name), spec, _RANKED_BY).select(*_ranked_fields(spec))
    seen = events.agg(F.count("*").alias("events"), F.count("__fault").alias("unranked"))
    newest = newest_typed(landing, spec, nulls, quarantine=True)
    live = not_deleted(F.col("__deleted"))
    kept = newest.agg(
        F.count("*").alias("keys"),
        F.count_if(live & ~F.col("__malformed")).alias("current"),
        F.count_if(~live).alias("deleted"),
        F.count_if(live & F.col("__malformed")).alias("bad_values"),
    )
    return side_by_side([seen, kept]).select(
        F.lit(spec.name).alias("table_name"),
        "events",
        "current",
        (F.col("events") - F.col("unranked") - F.col("keys")).alias("superseded"),
        "deleted",
        (F.col("unranked") + F.col("bad_values")).alias("quarantined"),
    )


def current_rows(log: DataFrame, keys: Sequence[str], nulls: str = "first") -> DataFrame:
    """Current rows of a flat change log, with its columns."""
    return live_rows(latest_per_key(log, keys, replay_order(nulls)))


def merge_source(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Newest change per key of a batch, with the merge's three-valued `is_deleted`."""
    order = [F.col("__lsn").desc_nulls_last(), F.col("__source_ts_ms").desc_nulls_last()]
    newest = latest_per_key(batch, keys, order)
    return newest.withColumn("is_deleted", delete_flag("__op", "__deleted"))


def snapshot_plus_tail(snapshot: DataFrame, changes: DataFrame) -> DataFrame:
    """One log of the initial rows (`__op = 'r'`) and the changes that follow."""
    initial = snapshot.withColumns(
        {
            "__op": F.lit("r"),
            "__lsn": F.lit(0).cast("bigint"),
            "__source_ts_ms": F.lit(0).cast("bigint"),
            "__deleted": F.lit("false"),
        }
    )
    return changes.unionByName(initial, allowMissingColumns=True)


def advance_versions(versions: DataFrame, events: DataFrame, keys: Sequence[str], nulls: str = "first") -> DataFrame:
    """Newest version per key after more events, deletes kept.

    Persist the result and pass it in again with the next events: a run then
    reads one version per key and what is new, and not the whole history.
    `live_rows` turns versions into current rows.
    """
    return latest_per_key(versions.unionByName(events), keys, replay_order(nulls))


def live_rows(versions: DataFrame) -> DataFrame:
    """Versions that are not deletes."""
    return versions.where(not_deleted(F.col("__deleted")))
