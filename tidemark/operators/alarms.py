"""Alarms over metric streams: a statistic per period, a threshold, consecutive periods, a missing-data rule."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import astuple, dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import moment
from tidemark.session import constant_rows


@dataclass(frozen=True)
class AlarmSpec:
    alarm: str
    metric: str
    subject: str
    statistic: str
    period: int
    evaluation_periods: int
    comparison: str
    threshold: float
    missing: str


_SPEC_SCHEMA = (
    "alarm string, metric string, subject string, statistic string, period bigint, "
    "evaluation_periods int, comparison string, threshold double, missing string"
)


_KEYS = ("alarm", "metric", "subject")


def default_specs(subject: str = "stream") -> tuple[AlarmSpec, ...]:
    """The seven alarms on one subject."""
    # --- fixed values: statistic, period in seconds, periods, limit, missing-data rule ---
    rows = (
        ("source-silent", "IncomingRecords", "sum", 300, 2, "<", 1.0, "breaching"),
        ("write-throttled", "WriteProvisionedThroughputExceeded", "sum", 300, 1, ">", 0.0, "notBreaching"),
        ("not-consumed", "GetRecords.Success", "count", 21600, 1, "<", 1.0, "breaching"),
        ("iterator-age", "GetRecords.IteratorAgeMilliseconds", "max", 300, 1, ">", 43200000.0, "notBreaching"),
        ("slot-lag", "OldestReplicationSlotLag", "max", 300, 1, ">", 5368709120.0, "notBreaching"),
        ("low-storage", "FreeStorageSpace", "min", 300, 1, "<", 4294967296.0, "notBreaching"),
        ("usage-limit", "UsageLimitConsumed", "max", 300, 1, ">", 12.8, "notBreaching"),
    )
    # --- end of fixed values ---
    return tuple(AlarmSpec(alarm, metric, subject, *rest) for alarm, metric, *rest in rows)


def _epoch(time: dt.datetime) -> int:
    return int(time.replace(tzinfo=dt.timezone.utc).timestamp())


def _slot_start(start: dt.datetime, seconds: Column) -> Column:
    return moment(start) + seconds * F.expr("interval '1' second")


def _literal(spec: AlarmSpec) -> Column:
    kinds = T.StructType.fromDDL(_SPEC_SCHEMA).fields
    return F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(astuple(spec), kinds, strict=True)])


def _statistic() -> Column:
    kind = F.col("statistic")
    return (
        F.when(kind == "sum", F.col("total"))
        .when(kind == "max", F.col("top"))
        .when(kind == "min", F.col("bottom"))
        .when(kind == "count", F.col("samples").cast("double"))
    )


def _breach(value: Column) -> Column:
    return (
        F.when(value.isNull(), F.col("missing") == "breaching")
        .when(F.col("comparison") == "<", value < F.col("threshold"))
        .otherwise(value > F.col("threshold"))
    )


def _aggregates() -> list[Column]:
    return [
        F.sum("value").alias("total"),
        F.max("value").alias("top"),
        F.min("value").alias("bottom"),
        F.count("value").alias("samples"),
    ]


def evaluate_alarms(
    metrics: DataFrame, specs: Iterable[AlarmSpec], start: dt.datetime, end: dt.datetime
) -> DataFrame:
    """State of each alarm, metric and subject in each period of `[start, end)`.

    All alarms share one pass over the samples: each sample is given the period
    of its alarm and summed up before the shuffle. Periods without samples come
    from a spine, so the missing-data rule applies to them. The window then
    runs over one row per period, however many samples there were.
    """
    spark = metrics.sparkSession
    specs = list(specs)
    spec_rows = F.broadcast(constant_rows(spark, [astuple(s) for s in specs], _SPEC_SCHEMA))
    offset = F.unix_seconds(F.col("ts").cast("timestamp")) - _epoch(start)
    in_time = (F.col("ts") >= moment(start)) & (F.col("ts") < moment(end))
    seen = (
        metrics.where(in_time)
        .join(spec_rows, ["metric", "subject"])
        .withColumn("offset", offset)
        .groupBy(*_KEYS, F.expr("offset div period").alias("slot"))
        .agg(*_aggregates())
    )
    length = _epoch(end) - _epoch(start)
    shortest = min((s.period for s in specs), default=1)
    # made in parallel over the slots of the shortest period, however long the time
    rules = F.array(*[_literal(s) for s in specs]) if specs else F.array().cast(f"array<struct<{_SPEC_SCHEMA}>>")
    spine = (
        spark.range(-(-length // shortest))
        .select(F.col("id").alias("slot"), F.inline(rules))
        .where(F.col("slot") * F.col("period") < length)
    )
    value = _statistic()
    periods = spine.join(seen, [*_KEYS, "slot"], "left").select(
        *_KEYS,
        "slot",
        "period",
        "evaluation_periods",
        value.alias("value"),
        _breach(value).alias("breaching"),
    )
    # Length of the run of breaching periods that ends here: periods since the last one that was fine.
    order = Window.partitionBy(*_KEYS).orderBy("slot")
    last_fine = F.last(F.when(~F.col("breaching"), F.col("slot")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    run = F.col("slot") - F.coalesce(last_fine, F.lit(-1))
    return periods.select(
        *_KEYS,
        _slot_start(start, F.col("slot") * F.col("period")).alias("period_start"),
        "value",
        "breaching",
        F.when(run >= F.col("evaluation_periods"), "ALARM").otherwise("OK").alias("state"),
    )


def stream_alarms(
    samples: DataFrame, ticks: DataFrame, specs: Iterable[AlarmSpec], start: dt.datetime, delay: str = "10 minutes"
) -> DataFrame:
    """The rows of `evaluate_alarms` from `start` on, as a stream: each once, when its period is closed.

    `ticks` (ts) is a clock of at least one tick in each period, such as a rate source. Ticks reach every alarm and are no
    samples, so a period without samples is still judged and the missing-data rule applies to it. A period closes when the
    newest tick or sample is `delay` past its end; samples that come later are dropped. Consecutive periods are counted in
    windows that slide by one period. State is one row for each open period or window of an alarm, however many samples.
    Alarms that share period and number of periods share their state; both inputs are read once for each such group.
    """
    spark = samples.sparkSession
    moments = F.col("ts").cast("timestamp").alias("ts")
    of_spec = [*_KEYS, "statistic", "comparison", "threshold", "missing"]
    groups: dict[tuple[int, int], list[AlarmSpec]] = {}
    for spec in specs:
        groups.setdefault((spec.period, spec.evaluation_periods), []).append(spec)
    results = []
    for (period, needed), own in groups.items():
        rules = F.broadcast(constant_rows(spark, [astuple(s) for s in own], _SPEC_SCHEMA))
        arrived = samples.select("metric", "subject", moments, "value").join(rules, ["metric", "subject"])
        clock = ticks.select(moments, F.inline(F.array(*[_literal(s) for s in own]))).withColumn("value", F.lit(None).cast("double"))
        both = arrived.withColumn("arrived", F.lit(1)).unionByName(clock.withColumn("arrived", F.lit(0)))
        timed = both.where(F.col("ts") >= moment(start).cast("timestamp")).withWatermark("ts", delay)
        length, first = f"{period} seconds", f"{_epoch(start) % period} seconds"
        sums = timed.groupBy(F.window("ts", length, startTime=first), *of_spec).agg(
            *_aggregates(), F.max("arrived").alias("arrived")
        )
        value = F.when(F.col("arrived") == 1, _statistic())
        judged = sums.select("window", *_KEYS, value.alias("value"), *of_spec[len(_KEYS) :])
        judged = judged.withColumn("breaching", _breach(F.col("value")))
        # The newest period of a window, and how many of its periods breach.
        at = F.struct(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "value", "breaching")
        run = F.window(F.window_time("window"), f"{period * needed} seconds", length, first)
        runs = judged.groupBy(run.alias("run"), *_KEYS).agg(F.max(at).alias("at"), F.count_if("breaching").alias("n"))
        results.append(
            runs.where("at.end = run.end").select(
                *_KEYS,
                F.col("at.start").cast("timestamp_ntz").alias("period_start"),
                "at.value",
                "at.breaching",
                F.when(F.col("n") >= needed, "ALARM").otherwise("OK").alias("state"),
            )
        )
    return reduce(DataFrame.unionByName, results)


def rate_ticks(spark: SparkSession, per_second: int = 1) -> DataFrame:
    """A clock that ticks in real time."""
    return spark.readStream.format("rate").option("rowsPerSecond", per_second).load().select(F.col("timestamp").alias("ts"))


def metric_series(metrics: DataFrame, period: str = "5 minutes") -> DataFrame:
    """All statistics of each metric and subject per period. Works on batches and streams."""
    return (
        metrics.groupBy("metric", "subject", F.window("ts", period).alias("w"))
        .agg(*_aggregates())
        .select(
            "metric",
            "subject",
            F.col("w.start").alias("period_start"),
            F.col("total").alias("sum_value"),
            F.col("top").alias("max_value"),
            F.col("bottom").alias("min_value"),
            F.col("samples").alias("sample_count"),
        )
    )


def silent_periods(
    spark: SparkSession, samples: DataFrame, start: dt.datetime, end: dt.datetime, period_seconds: int = 300
) -> DataFrame:
    """Periods of `[start, end)` in which not one sample arrived."""
    offset = F.unix_seconds(F.col("ts").cast("timestamp")) - _epoch(start)
    in_time = (F.col("ts") >= moment(start)) & (F.col("ts") < moment(end))
    seen = samples.where(in_time).select(offset.alias("offset")).select(F.expr(f"offset div {period_seconds}").alias("slot"))
    slots = spark.range(-(-(_epoch(end) - _epoch(start)) // period_seconds)).withColumnRenamed("id", "slot")
    silent = slots.join(seen.distinct(), "slot", "left_anti")
    return silent.select(_slot_start(start, F.col("slot") * period_seconds).alias("period_start"))


def retention_gap(landed: DataFrame, available: DataFrame, key: str = "__table") -> DataFrame:
    """Newest landed LSN against the oldest still in the stream; a gap means events expired unread.

    LSNs are compared by the events between them: the gap is real only when the
    oldest available event is not yet landed.
    """
    newest = landed.groupBy(key).agg(F.max("__lsn").alias("newest_landed_lsn"))
    oldest = available.groupBy(key).agg(F.min("__lsn").alias("oldest_available_lsn"))
    gap = F.col("oldest_available_lsn") > F.col("newest_landed_lsn")
    return newest.join(oldest, key, "full").withColumn("is_gap_possible", F.coalesce(gap, F.lit(False)))
