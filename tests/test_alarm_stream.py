"""Alarms over a stream against the same alarms over a batch."""

import datetime as dt

from tidemark.operators import alarms
from tidemark.session import fresh_dir
from tidemark.streaming import drain

T0 = dt.datetime(2024, 1, 1, 0, 5)
SAMPLES = "metric string, subject string, ts timestamp_ntz, value double"
TICKS = "ts timestamp_ntz"
SPECS = [
    alarms.AlarmSpec("silent", "m", "s", "sum", 300, 2, "<", 1.0, "breaching"),
    alarms.AlarmSpec("three", "m", "s", "max", 300, 3, ">", 4.0, "notBreaching"),
    alarms.AlarmSpec("counted", "m", "s", "count", 600, 1, "<", 2.0, "notBreaching"),
    alarms.AlarmSpec("low", "m", "other", "min", 300, 1, "<", 2.0, "notBreaching"),
]


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def drained(spark, deliveries, delay="10 minutes"):
    """Rows after the drain of each delivery: pairs of samples and ticks, in minutes."""
    root, seen = fresh_dir(spark, "alarm-test"), []
    for samples, ticks in deliveries:
        rows = [("m", subject, at(m), v) for subject, m, v in samples]
        spark.createDataFrame(rows, SAMPLES).write.mode("append").parquet(f"{root}/samples")
        spark.createDataFrame([(at(m),) for m in ticks], TICKS).write.mode("append").parquet(f"{root}/ticks")
        streams = [
            drain.change_stream(spark, f"{root}/{name}", spark.createDataFrame([], schema).schema)
            for name, schema in (("samples", SAMPLES), ("ticks", TICKS))
        ]
        drain.consume(alarms.stream_alarms(*streams, SPECS, T0, delay), f"{root}/out", f"{root}/checkpoint")
        seen.append(sorted(map(tuple, spark.read.parquet(f"{root}/out").collect()), key=repr))
    return seen


def judged(spark, samples, minutes):
    rows = spark.createDataFrame([("m", subject, at(m), v) for subject, m, v in samples], SAMPLES)
    found = alarms.evaluate_alarms(rows, SPECS, T0, at(minutes))
    return sorted(map(tuple, found.select("alarm", "metric", "subject", "period_start", "value", "breaching", "state").collect()), key=repr)


def test_stream_equals_batch_with_silence_and_a_late_sample(spark):
    first = [("s", 0, 5.0), ("s", 6, 6.0), ("s", 11, 7.0), ("other", 3, 1.0), ("s", 13, None), ("s", -1, 99.0)]
    second = [("s", 18, 9.0), ("s", 16, 2.0), ("s", 49, 1.0)]  # minute 16 comes late, 20 to 45 are silent
    third = [("s", 58, 8.0), ("s", 57, 8.0), ("other", 52, 1.5)]
    deliveries = [(first, range(0, 20)), (second, range(20, 50)), (third, range(50, 91))]
    seen = drained(spark, deliveries)
    # a period is there as soon as it is closed, and only once
    assert [max(r[3] for r in rows if r[0] == "silent") for rows in seen] == [at(0), at(30), at(75)]
    want = judged(spark, first + second + third, 80)
    assert seen[-1] == want
    assert {r[-1] for r in want if r[0] == "silent"} == {r[-1] for r in want if r[0] == "three"} == {"OK", "ALARM"}


def test_a_sample_after_its_period_closed_changes_nothing(spark):
    deliveries = [([("s", 1, 9.0)], range(0, 30)), ([("s", 2, 9.0), ("s", 31, 9.0)], range(30, 51))]
    seen = drained(spark, deliveries)
    assert seen[-1] == judged(spark, [("s", 1, 9.0), ("s", 31, 9.0)], 40)


def test_the_clock_is_a_stream(spark):
    ticks = alarms.rate_ticks(spark)
    assert ticks.isStreaming and ticks.columns == ["ts"]
