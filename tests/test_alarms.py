import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators import alarms

T0 = dt.datetime(2024, 1, 1)
METRICS = "metric string, subject string, ts timestamp_ntz, value double"


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def states(spark, samples, spec, minutes):
    metrics = spark.createDataFrame([("m", "s", at(m), float(v)) for m, v in samples], METRICS)
    found = alarms.evaluate_alarms(metrics, [spec], T0, at(minutes)).orderBy("period_start").collect()
    return [r.state for r in found]


def spec(statistic="sum", needed=1, comparison="<", threshold=1.0, missing="breaching"):
    return alarms.AlarmSpec("a", "m", "s", statistic, 300, needed, comparison, threshold, missing)


def test_silence_needs_two_periods(spark):
    assert states(spark, [(0, 1), (16, 1)], spec(needed=2), 25) == ["OK", "OK", "ALARM", "OK", "OK"]


def test_missing_data_rules(spark):
    assert states(spark, [], spec(missing="breaching"), 10) == ["ALARM", "ALARM"]
    assert states(spark, [], spec(missing="notBreaching"), 10) == ["OK", "OK"]


def test_statistics_and_limits(spark):
    samples = [(0, 3), (1, 1), (6, 5)]
    assert states(spark, samples, spec("max", comparison=">", threshold=3.0), 10) == ["OK", "ALARM"]
    assert states(spark, samples, spec("min", comparison="<", threshold=2.0), 10) == ["ALARM", "OK"]
    assert states(spark, samples, spec("count", comparison=">", threshold=1.0), 10) == ["ALARM", "OK"]
    assert states(spark, samples, spec("sum", comparison=">", threshold=4.0), 10) == ["OK", "ALARM"]


def test_other_metrics_and_times_do_not_count(spark):
    metrics = spark.createDataFrame(
        [("m", "other", at(0), 1.0), ("n", "s", at(0), 1.0), ("m", "s", at(5), 1.0), ("m", "s", at(-1), 1.0)], METRICS
    )
    found = alarms.evaluate_alarms(metrics, [spec()], T0, at(5)).collect()
    assert [(r.value, r.state) for r in found] == [(None, "ALARM")]


def test_subjects_are_judged_apart(spark):
    rows = [("m", "a", at(0), 5.0), ("m", "a", at(1), 4.0), ("m", "b", at(0), 7.0), ("m", "b", at(6), 1.0)]
    specs = [alarms.AlarmSpec("x", "m", subject, "sum", 300, 1, ">", 8.0, "notBreaching") for subject in ("a", "b", "c")]
    found = alarms.evaluate_alarms(spark.createDataFrame(rows, METRICS), specs, T0, at(10))
    got = {(r.subject, r.period_start): (r.value, r.state) for r in found.collect()}
    assert found.count() == 6 and {r.metric for r in found.collect()} == {"m"}
    assert got["a", T0] == (9.0, "ALARM") and got["b", T0] == (7.0, "OK") and got["c", T0] == (None, "OK")
    assert got["a", at(5)] == (None, "OK") and got["b", at(5)] == (1.0, "OK")


def test_the_seven_alarms():
    specs = alarms.default_specs()
    assert len(specs) == 7
    assert {s.alarm: s.period for s in specs}["not-consumed"] == 21600


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 39), st.integers(0, 3)), max_size=12), st.integers(1, 3))
def test_consecutive_periods_equal_brute_force(spark, samples, needed):
    got = states(spark, samples, spec("max", needed, ">", 1.0, "notBreaching"), 40)
    breach = [max([v for m, v in samples if m // 5 == p], default=0) > 1 for p in range(8)]
    want = ["ALARM" if p + 1 >= needed and all(breach[p - needed + 1 : p + 1]) else "OK" for p in range(8)]
    assert got == want


def test_series_and_silent_periods(spark, as_rows):
    metrics = spark.createDataFrame([("m", "s", at(1), 2.0), ("m", "s", at(2), 4.0), ("m", "s", at(11), 1.0)], METRICS)
    assert as_rows(alarms.metric_series(metrics)) == [
        ("m", "s", at(0), 6.0, 4.0, 2.0, 2), ("m", "s", at(10), 1.0, 1.0, 1.0, 1),
    ]
    assert as_rows(alarms.silent_periods(spark, metrics, T0, at(15))) == [(at(5),)]


def test_retention_gap(spark, as_rows):
    schema = "__table string, __lsn bigint"
    landed = spark.createDataFrame([("a", 5), ("b", 5)], schema)
    available = spark.createDataFrame([("a", 4), ("a", 9), ("b", 7)], schema)
    assert as_rows(alarms.retention_gap(landed, available)) == [("a", 5, 4, False), ("b", 5, 7, True)]
