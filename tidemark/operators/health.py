"""Health checks, their stored results, and the dashboard queries over them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import first_line, moment, seconds_between, truncate_detail
from tidemark.session import child_names, constant_rows

RESULT_SCHEMA = (
    "id bigint, run_id string, checked_at timestamp_ntz, check_name string, "
    "subject string, status string, value double, detail string"
)
# --- fixed values: check names, statuses, detail texts, dashboard limits and list length ---
CONNECT_REACHABLE, CONNECT_SUBJECT = "kafka_connect_reachable", "kafka-connect"
CONNECTOR_STATUS, SLOT_LAG = "connector_status", "replication_slot_lag"
ROW_COUNT, FRESHNESS = "row_count", "table_freshness"
STATUSES = ("ok", "warn", "fail")
NOT_REGISTERED = "connector is not registered"
NOT_AN_OBJECT = "Kafka Connect returned an unexpected response"
NO_SLOTS = "no logical replication slots; is the Debezium connector registered?"
SLOT_WITHOUT_LSN = "slot has no LSN (invalidated?)"
SLOT_INACTIVE = "slot is inactive; PostgreSQL retains WAL until it is consumed"
SLOT_BEHIND = "lag exceeds {} bytes"
TABLE_MISSING, TABLE_EMPTY = "table {}.{} not found", "table is empty"
NO_ROWS, TABLE_STALE = "no rows", "no update for more than {} seconds"
RECENT_LIMIT = 200
AGE_LIMIT_SECONDS, FAILING_LIMIT, WARNING_LIMIT = 900, 1, 1
# --- end of fixed values ---

_STATE = "struct<state: string, trace: string>"
_STATUS = f"connector {_STATE}, tasks array<struct<id: bigint, state: string, trace: string>>"


def _result(name: str, subject: Column, status: Column, value: Column, detail: Column) -> list[Column]:
    return [
        F.lit(name).alias("check_name"),
        subject.alias("subject"),
        status.alias("status"),
        value.cast("double").alias("value"),
        detail.cast("string").alias("detail"),
    ]


def connect_unreachable(spark: SparkSession, error: str) -> DataFrame:
    """The one row of a run in which no connector status could be read."""
    return spark.range(0, 1, 1, 1).select(
        *_result(CONNECT_REACHABLE, F.lit(CONNECT_SUBJECT), F.lit("fail"), F.lit(0.0), truncate_detail(F.lit(error)))
    )


def connector_status(observed: DataFrame, expected: Iterable[str]) -> DataFrame:
    """Status of every expected or observed connector from its status JSON.

    `observed` has name and status_json. Fail without tasks or with a failed
    part, ok when all parts run, else warn; an expected connector that was not
    observed fails, and so does one with a null status (it is not registered)
    or a status that is not an object. The first trace line is added to the
    detail.
    """
    spark = observed.sparkSession
    expected = list(dict.fromkeys(expected))
    # Only the expected names are looked up among the observed, so those are not shuffled.
    known = observed.where(F.col("name").isin(*expected)).select("name").distinct()
    absent = constant_rows(spark, [(name,) for name in expected], "name string").join(known, "name", "left_anti")
    everything = observed.select(
        "name",
        F.from_json("status_json", _STATUS).alias("s"),
        F.coalesce(F.trim("status_json"), F.lit("null")).alias("text"),
    ).withColumn(
        "unusable",
        F.when(F.lower("text") == "null", NOT_REGISTERED).when(~F.col("text").startswith("{"), NOT_AN_OBJECT),
    )

    def part(label: Column, state: Column, trace: Column) -> Column:
        return F.struct(
            label.alias("label"), F.upper(F.coalesce(state, F.lit("unknown"))).alias("state"), trace.alias("trace")
        )

    tasks = F.transform(
        F.coalesce(F.col("s.tasks"), F.array().cast("array<struct<id: bigint, state: string, trace: string>>")),
        lambda t: part(F.concat(F.lit("task "), F.coalesce(t["id"].cast("string"), F.lit("None"))), t["state"], t["trace"]),
    )
    own = F.array(part(F.lit("connector"), F.col("s.connector.state"), F.col("s.connector.trace")))
    parts = everything.select("name", "unusable", F.concat(own, tasks).alias("parts"))

    no_tasks = F.size("parts") == 1
    states = F.array_join(F.transform("parts", lambda p: F.concat(p["label"], F.lit("="), p["state"])), "; ")
    traces = F.filter("parts", lambda p: p["trace"].isNotNull() & (p["trace"] != ""))
    trace = F.when(F.size(traces) > 0, F.concat(F.lit(" | "), first_line(F.element_at(traces, 1)["trace"])))
    detail = F.concat(states, F.when(no_tasks, "; no tasks").otherwise(""), F.coalesce(trace, F.lit("")))
    detail = F.coalesce("unusable", detail)
    outcome = (
        F.when(F.col("unusable").isNotNull() | no_tasks | F.exists("parts", lambda p: p["state"] == "FAILED"), "fail")
        .when(F.forall("parts", lambda p: p["state"] == "RUNNING"), "ok")
        .otherwise("warn")
    )
    name, running = CONNECTOR_STATUS, F.when(outcome == "ok", 1.0).otherwise(0.0)
    rows = parts.select(*_result(name, F.col("name"), outcome, running, truncate_detail(detail)))
    unregistered = F.lit(NOT_REGISTERED)
    return rows.unionByName(absent.select(*_result(name, F.col("name"), F.lit("fail"), F.lit(0.0), unregistered)))


def connect_reachable(spark: SparkSession) -> DataFrame:
    """The row of a run in which the status could be read."""
    return spark.range(0, 1, 1, 1).select(
        *_result(CONNECT_REACHABLE, F.lit(CONNECT_SUBJECT), F.lit("ok"), F.lit(1.0), F.lit(None))
    )


def slot_lag_status(slots: DataFrame, warn_bytes: int) -> DataFrame:
    """Status of each replication slot (name, active, lag); one warning when there is none.

    A slot not known to be active is inactive.
    """
    lag = F.col("lag").cast("double")
    active = F.coalesce("active", F.lit(False))
    outcome = (
        F.when(lag.isNull() | ~active, "fail").when(lag > warn_bytes, "warn").otherwise("ok")
    )
    detail = (
        F.when(lag.isNull(), SLOT_WITHOUT_LSN)
        .when(~active, SLOT_INACTIVE)
        .when(lag > warn_bytes, SLOT_BEHIND.format(warn_bytes))
    )
    name = SLOT_LAG
    rows = slots.select(*_result(name, F.col("name"), outcome, lag, detail))
    nothing = slots.agg(F.count("*").alias("n")).where("n = 0")
    return rows.unionByName(
        nothing.select(*_result(name, F.lit("(none)"), F.lit("warn"), F.lit(None), F.lit(NO_SLOTS)))
    )


def table_health(
    spark: SparkSession,
    tables: Mapping[str, DataFrame | None],
    as_of: dt.datetime,
    warn_seconds: int,
    schema: str = "source",
    stamp: str = "updated_at",
) -> DataFrame:
    """Row count and age of each table, in one aggregate per table.

    A missing table (None) fails, an empty one warns, and so does a table
    without a change stamp or older than the limit; a limit of 0 disables that.
    """
    parts = []
    now = moment(as_of)
    for name, frame in tables.items():
        subject = F.lit(name)
        if frame is None:
            missing = F.lit(TABLE_MISSING.format(schema, name))
            parts.append(spark.range(0, 1, 1, 1).select(*_result(ROW_COUNT, subject, F.lit("fail"), F.lit(None), missing)))
            continue
        stamped = stamp in frame.columns
        newest = F.max(stamp) if stamped else F.lit(None).cast("timestamp_ntz")
        seen = frame.agg(F.count("*").alias("n"), newest.alias("newest"))
        count, age = F.col("n"), seconds_between("newest", now)
        if not stamped:
            status, detail = F.lit("warn"), F.lit(f"{stamp} column missing; add it and fill it")
        else:
            late = age > warn_seconds if warn_seconds else F.lit(False)
            status = F.when(age.isNull() | late, "warn").otherwise("ok")
            detail = F.when(age.isNull(), NO_ROWS).when(late, TABLE_STALE.format(warn_seconds))
        both = F.array(
            F.struct(
                *_result(
                    ROW_COUNT,
                    subject,
                    F.when(count > 0, "ok").otherwise("warn"),
                    count,
                    F.when(count == 0, TABLE_EMPTY),
                )
            ),
            F.struct(*_result(FRESHNESS, subject, status, age, detail)),
        )
        parts.append(seen.select(F.inline(both)))
    return reduce(lambda a, b: a.unionByName(b), parts)


def as_run(results: DataFrame, run_id: str, checked_at: dt.datetime) -> DataFrame:
    """Check rows as stored observations of one run."""
    return results.select(
        F.monotonically_increasing_id().alias("id"),
        F.lit(run_id).alias("run_id"),
        moment(checked_at).alias("checked_at"),
        "check_name",
        "subject",
        "status",
        "value",
        "detail",
    )


def append_results(results: DataFrame, path: str) -> None:
    """Append the observations of a run, partitioned by day."""
    results.withColumn("checked_on", F.to_date("checked_at")).write.mode("append").partitionBy("checked_on").parquet(path)


def retained(results: DataFrame, as_of: dt.datetime, days: int) -> DataFrame:
    """Observations not older than `days`; prunes day partitions when there are any."""
    oldest = as_of - dt.timedelta(days=days)
    kept = results.where(F.col("checked_at") >= moment(oldest))
    if "checked_on" in results.columns:
        kept = kept.where(F.col("checked_on") >= F.lit(oldest.date()))
    return kept


def drop_expired(spark: SparkSession, path: str, as_of: dt.datetime, days: int) -> int:
    """Delete the day folders that lie wholly before the retention limit; the number deleted."""
    oldest = (as_of - dt.timedelta(days=days)).date().isoformat()
    expired = [
        name
        for name in child_names(spark, path)
        if name.startswith("checked_on=") and name.removeprefix("checked_on=") < oldest
    ]
    for name in expired:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return len(expired)


def summarize(results: DataFrame) -> DataFrame:
    """Observations per status, zero for a status that did not occur."""
    spark = results.sparkSession
    statuses = constant_rows(spark, [(s,) for s in STATUSES], "status string")
    counts = results.groupBy("status").agg(F.count("*").alias("n"))
    return statuses.join(counts, "status", "left").select("status", F.coalesce("n", F.lit(0)).alias("checks"))


def run_age(results: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Seconds since the last observation."""
    now = moment(as_of)
    return results.agg(F.max("checked_at").alias("last")).select(seconds_between("last", now).alias("seconds"))


def latest_run(results: DataFrame) -> DataFrame:
    """The observations of the newest run; the run is found by an aggregate of one row."""
    newest = results.agg(F.max_by("run_id", F.struct("checked_at", "id")).alias("run_id"))
    return results.join(F.broadcast(newest), "run_id", "left_semi")


def failing_latest(results: DataFrame) -> DataFrame:
    """Failing checks and warnings of the newest run."""
    return latest_run(results).agg(
        F.count_if(F.col("status") == "fail").alias("failing"),
        F.count_if(F.col("status") == "warn").alias("warnings"),
    )


def source_rows(results: DataFrame) -> DataFrame:
    """Rows in all source tables by the newest run."""
    return latest_run(results).where(F.col("check_name") == ROW_COUNT).agg(F.sum("value").alias("source_rows"))


def connectors_latest(results: DataFrame) -> DataFrame:
    """Connector table of the newest run."""
    shown = F.col("check_name").isin(CONNECT_REACHABLE, CONNECTOR_STATUS)
    rows = latest_run(results).where(shown).orderBy(F.col("check_name").desc(), "subject")
    return rows.select("subject", "status", "detail")


def series(results: DataFrame, check: str, start: dt.datetime, end: dt.datetime) -> DataFrame:
    """Values of a check over time."""
    in_time = F.col("checked_at").between(moment(start), moment(end))
    return (
        results.where((F.col("check_name") == check) & F.col("value").isNotNull() & in_time)
        .select(F.col("checked_at").alias("time"), F.col("subject").alias("metric"), "value")
        .orderBy("time")
    )


def rows_latest(results: DataFrame) -> DataFrame:
    """Rows per table by the newest run."""
    return latest_run(results).where(F.col("check_name") == ROW_COUNT).orderBy("subject").select("subject", "value")


def freshness_latest(results: DataFrame) -> DataFrame:
    """Freshness per table by the newest run."""
    rows = latest_run(results).where(F.col("check_name") == FRESHNESS).orderBy("subject")
    return rows.select("subject", "value", "status", "detail")


def recent_issues(results: DataFrame, start: dt.datetime, end: dt.datetime, limit: int = RECENT_LIMIT) -> DataFrame:
    """The newest warnings and failures."""
    in_time = F.col("checked_at").between(moment(start), moment(end))
    return (
        results.where((F.col("status") != "ok") & in_time)
        .orderBy(F.col("checked_at").desc(), F.col("id").desc())
        .limit(limit)
        .select("checked_at", "check_name", "subject", "status", "detail")
    )


def thresholds(results: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Colour of the age, failing and warnings panels."""

    def panel(name: str, value: Column, limit: int, colour: str) -> Column:
        return F.struct(
            F.lit(name).alias("panel"),
            value.cast("double").alias("value"),
            F.when(value >= limit, colour).otherwise("green").alias("level"),
        )

    age = run_age(results, as_of).select(F.inline(F.array(panel("age", F.col("seconds"), AGE_LIMIT_SECONDS, "red"))))
    failing = panel("failing", F.col("failing"), FAILING_LIMIT, "red")
    warnings = panel("warnings", F.col("warnings"), WARNING_LIMIT, "yellow")
    return age.unionByName(failing_latest(results).select(F.inline(F.array(failing, warnings))))
