"""End-to-end load test: inserts, then updates and deletes, through landing and merge, then assertions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import moment
from tidemark.operators import merge, reconcile
from tidemark.sources.registry import TABLES
from tidemark.streaming.drain import change_stream
from tidemark.streaming.state_log import StateLog, merge_stream

SPEC = TABLES["customer"]
KEY = SPEC.primary_key


def change_events(rows: DataFrame, op: str, step: int) -> DataFrame:
    """Changed rows as typed change events; later steps have higher LSNs."""
    meta = {
        "__op": F.lit(op),
        "__table": F.lit(SPEC.name),
        "__lsn": F.lit(step).cast("bigint"),
        "__source_ts_ms": F.lit(step).cast("bigint"),
        "__deleted": F.lit("true" if op == "d" else "false"),
        "record_metadata": F.parse_json(F.lit("{}")),
    }
    return rows.withColumns(meta).select(*SPEC.landing_schema.fieldNames())


def run_load_test(
    spark: SparkSession, source: DataFrame, root: str, marker: str, updates: tuple[int, int], deletes: tuple[int, int]
) -> DataFrame:
    """Land and merge the customers of `source`, then changes of two key ranges, and report what arrived.

    `source` has the columns of the customer table; none has `marker` as first
    name. The landing and the merged state are written under `root`. One row
    per assertion: name, actual, expected, passed.
    """
    landing, start = f"{root}/landing", dt.datetime(2024, 1, 1)
    columns = [f for f in SPEC.landing_schema.fields if f.name in SPEC.all_columns]
    state = StateLog(spark, f"{root}/state", type(SPEC.landing_schema)(columns), [KEY])

    def settle(events: DataFrame) -> None:
        events.write.mode("append").parquet(landing)
        merge_stream(change_stream(spark, landing, SPEC.landing_schema), state, f"{root}/checkpoint")

    def in_range(bounds: tuple[int, int]) -> Column:
        return F.col(KEY).between(*bounds)

    first, last = reconcile.key_range(source, KEY)

    def snapshot(prefix: str) -> DataFrame:
        marked = F.col("first_name") == marker
        found = reconcile.reconcile_snapshot(state.read(), KEY, first, last, marked, *deletes)
        return reconcile.observations(found).withColumn("name", F.concat(F.lit(prefix), "name"))

    settle(change_events(source, "c", 1))
    inserted = snapshot("inserted_")
    inserted.write.parquet(f"{root}/after-insert")

    changed = merge.apply_update(
        source, in_range(updates), {"first_name": F.lit(marker)}, moment(start + dt.timedelta(hours=1))
    )
    settle(
        change_events(changed.where(in_range(updates)), "u", 2).unionByName(
            change_events(source.where(in_range(deletes)), "d", 3)
        )
    )
    counts = reconcile.op_counts(spark.read.schema(SPEC.landing_schema).parquet(landing))
    landed = counts.select(F.concat(F.lit("landing_"), "operation").alias("name"), F.col("event_count").alias("actual"))
    total = landed.agg(F.sum("actual").alias("actual")).select(F.lit("landing_total").alias("name"), "actual")
    observed = spark.read.parquet(f"{root}/after-insert").unionByName(snapshot("final_")).unionByName(landed)

    size = source.agg(
        F.count("*").alias("n"), F.count_if(in_range(updates)).alias("u"), F.count_if(in_range(deletes)).alias("d")
    ).first()
    expected = {
        "inserted_total_records": size.n,
        "inserted_missing_count": 0,
        "inserted_duplicate_primary_keys": 0,
        "final_total_records": size.n - size.d,
        "final_missing_surviving_count": 0,
        "final_updated_records": size.u,
        "final_deleted_records_remaining": 0,
        "final_duplicate_primary_keys": 0,
        "landing_c": size.n,
        "landing_u": size.u,
        "landing_d": size.d,
        "landing_total": size.n + size.u + size.d,
    }
    return reconcile.assertions(observed.unionByName(total), reconcile.expectations(spark, expected))
