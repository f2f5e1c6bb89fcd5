import datetime as dt
import json

from tidemark.operators import health

AS_OF = dt.datetime(2024, 2, 1)


def connectors(spark, texts, expected=()):
    """Rows by connector of raw status texts."""
    observed = spark.createDataFrame(list(texts.items()), "name string, status_json string")
    return {r.subject: r for r in health.connector_status(observed, expected).collect()}


def report(state, *tasks):
    return json.dumps({"connector": {"state": state}, "tasks": [{"id": i, **t} for i, t in enumerate(tasks)]})


def test_connector_states(spark):
    up, down = {"state": "running"}, {"state": "FAILED", "trace": "boom\n  at q"}
    got = connectors(spark, {
        "all-up": report("Running", up, up, up), "half-down": report("RUNNING", up, down), "self-down": report("failed", up),
        "waiting": report("UNASSIGNED", up), "idle": report("RUNNING"), "restarting": report("RUNNING", up, {"state": "RESTARTING"}),
    })
    assert {k: (r.status, r.value) for k, r in got.items()} == {
        "all-up": ("ok", 1.0), "half-down": ("fail", 0.0), "self-down": ("fail", 0.0), "waiting": ("warn", 0.0),
        "idle": ("fail", 0.0), "restarting": ("warn", 0.0),
    }
    assert got["half-down"].detail == "connector=RUNNING; task 0=RUNNING; task 1=FAILED | boom"
    assert got["idle"].detail == "connector=RUNNING; no tasks"


def test_the_first_trace_counts_and_long_ones_are_cut(spark):
    first, second = {"state": "FAILED", "trace": "  t1\nmore"}, {"state": "FAILED", "trace": "t2"}
    got = connectors(spark, {"two": report("RUNNING", first, second), "long": report("RUNNING", {"state": "FAILED", "trace": "z" * 900})})
    assert got["two"].detail.endswith("task 1=FAILED | t1")
    assert len(got["long"].detail) == 500 and got["long"].detail.endswith("zz...")


def test_null_and_unusable_statuses_are_failures_of_their_own(spark):
    got = connectors(spark, {"none": None, "null": " null ", "list": "[1]", "text": '"x"', "empty": "{}"}, ["none", "absent", "empty"])
    assert {r.status for r in got.values()} == {"fail"} and {r.value for r in got.values()} == {0.0}
    assert {k for k, r in got.items() if r.detail == health.NOT_REGISTERED} == {"none", "null", "absent"}
    assert {k for k, r in got.items() if r.detail == health.NOT_AN_OBJECT} == {"list", "text"}
    assert got["empty"].detail == "connector=UNKNOWN; no tasks"


def test_unreachable_is_one_failure(spark):
    [row] = health.connect_unreachable(spark, "refused" * 100).collect()
    assert (row.check_name, row.subject, row.status, row.value, len(row.detail)) == (
        health.CONNECT_REACHABLE, health.CONNECT_SUBJECT, "fail", 0.0, 500,
    )


def test_slots_at_the_limit_and_of_unknown_state(spark):
    rows = [
        ("at", True, 700), ("over", True, 701), ("zero", True, 0), ("unknown", None, 0), ("unknown-over", None, 701),
        ("off-over", False, 701), ("no-lsn", True, None), ("nothing", None, None),
    ]
    slots = spark.createDataFrame(rows, "name string, active boolean, lag bigint")
    got = {r.subject: r for r in health.slot_lag_status(slots, 700).collect()}
    assert {k: r.status for k, r in got.items()} == {
        "at": "ok", "over": "warn", "zero": "ok", "unknown": "fail", "unknown-over": "fail", "off-over": "fail",
        "no-lsn": "fail", "nothing": "fail",
    }
    assert {k for k, r in got.items() if r.detail == health.SLOT_INACTIVE} == {"unknown", "unknown-over", "off-over"}
    [none] = health.slot_lag_status(slots.where("lag < 0"), 700).collect()
    assert (none.subject, none.status, none.value) == ("(none)", "warn", None)


def test_table_checks(spark):
    def aged(*hours):
        return spark.createDataFrame([(AS_OF - dt.timedelta(hours=h) if h is not None else None,) for h in hours], "updated_at timestamp_ntz")

    tables = {"gone": None, "bare": spark.range(4), "void": aged(1).limit(0), "old": aged(30, 9, None), "new": aged(30, 1), "nulls": aged(None)}
    got = {(r.check_name, r.subject): (r.status, r.value) for r in health.table_health(spark, tables, AS_OF, 5 * 3600).collect()}
    counts = {k[1]: v for k, v in got.items() if k[0] == "row_count"}
    ages = {k[1]: v for k, v in got.items() if k[0] == "table_freshness"}
    assert counts == {"gone": ("fail", None), "bare": ("ok", 4.0), "void": ("warn", 0.0), "old": ("ok", 3.0), "new": ("ok", 2.0), "nulls": ("ok", 1.0)}
    assert (ages["old"], ages["new"]) == (("warn", 9 * 3600.0), ("ok", 3600.0))
    assert ages["bare"][0] == ages["void"][0] == ages["nulls"][0] == "warn" and "gone" not in ages
    relaxed = health.table_health(spark, {"old": tables["old"]}, AS_OF, 0).where("check_name = 'table_freshness'")
    assert [r.status for r in relaxed.collect()] == ["ok"]


def results(spark):
    day = dt.timedelta(days=1)
    rows = [
        (1, "old", AS_OF - 9 * day, "row_count", "a", "ok", 5.0, None),
        (2, "mid", AS_OF - 2 * day, "row_count", "a", "fail", 6.0, "x"),
        (3, "new", AS_OF - day, "row_count", "a", "ok", 7.0, None),
        (4, "new", AS_OF - day, "row_count", "b", "warn", 8.0, "y"),
        (5, "new", AS_OF - day, "replication_slot_lag", "s", "ok", None, None),
        (6, "new", AS_OF - day, "table_freshness", "a", "ok", 9.0, None),
    ]
    return spark.createDataFrame(rows, health.RESULT_SCHEMA)


def test_dashboard_queries(spark, as_rows):
    found = results(spark)
    assert as_rows(health.summarize(found)) == [("fail", 1), ("ok", 4), ("warn", 1)]
    assert as_rows(health.summarize(found.where("status = 'ok'"))) == [("fail", 0), ("ok", 4), ("warn", 0)]
    assert as_rows(health.run_age(found, AS_OF)) == [(86400.0,)]
    assert as_rows(health.failing_latest(found)) == [(0, 1)]
    assert as_rows(health.source_rows(found)) == [(15.0,)]
    assert as_rows(health.rows_latest(found)) == [("a", 7.0), ("b", 8.0)]
    assert as_rows(health.freshness_latest(found).select("subject", "value")) == [("a", 9.0)]
    assert health.series(found, "replication_slot_lag", dt.datetime(2024, 1, 1), AS_OF).count() == 0
    recent = health.recent_issues(found, dt.datetime(2024, 1, 1), AS_OF)
    assert [r.detail for r in recent.collect()] == ["y", "x"]
    assert as_rows(health.thresholds(found, AS_OF)) == [
        ("age", 86400.0, "red"), ("failing", 0.0, "green"), ("warnings", 1.0, "yellow"),
    ]


def test_retention(spark, tmp_path):
    path = f"{tmp_path}/results"
    health.append_results(results(spark), path)
    kept = health.retained(spark.read.parquet(path), AS_OF, 7)
    assert sorted(r.id for r in kept.collect()) == [2, 3, 4, 5, 6]
    assert health.drop_expired(spark, path, AS_OF, 7) == 1
    assert health.drop_expired(spark, path, AS_OF, 7) == 0
    assert spark.read.parquet(path).count() == 5
