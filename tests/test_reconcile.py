from pyspark.sql import functions as F

from tidemark.operators import reconcile

FIRST, LAST, GONE_FIRST, GONE_LAST = 41, 100, 71, 80


def load(spark, deleted=True):
    """Sixty keys, the lowest twelve renamed, ten in the middle deleted."""
    name = F.when(F.col("id") < FIRST + 12, "new").otherwise("old")
    rows = spark.range(FIRST, LAST + 1).select(F.col("id").alias("key"), name.alias("name"))
    return rows.where(~F.col("key").between(GONE_FIRST, GONE_LAST)) if deleted else rows


def snapshot(state):
    return reconcile.reconcile_snapshot(state, "key", FIRST, LAST, F.col("name") == "new", GONE_FIRST, GONE_LAST)


def holds(one_row, condition):
    return one_row.select(condition.alias("x")).first().x


def test_converged_load(spark, as_rows):
    state = load(spark)
    assert as_rows(snapshot(state)) == [(50, 50, 0, 12, 0, 10, 0)]
    assert holds(snapshot(state), reconcile.mixed_complete(50, 12))
    assert holds(snapshot(state).withColumn("n", F.lit(50)), reconcile.mixed_complete(F.col("n"), F.lit(12)))
    assert not holds(snapshot(state), reconcile.mixed_complete(50, 13))
    assert not holds(snapshot(state), reconcile.insert_complete(60))
    assert holds(snapshot(load(spark, False)), reconcile.insert_complete(60))
    assert as_rows(reconcile.survivor_equality(state, "key", FIRST, LAST, GONE_FIRST, GONE_LAST)) == [(0, 0, True)]


def test_cleanup_needs_an_empty_state_and_every_delete_landed(spark):
    empty = snapshot(load(spark).where("false"))
    assert holds(empty, reconcile.cleanup_complete(60, F.lit(60)))
    assert not holds(empty, reconcile.cleanup_complete(60, F.lit(59)))
    assert not holds(snapshot(load(spark)), reconcile.cleanup_complete(0, F.lit(60)))


def test_duplicates_missing_and_leftovers(spark, as_rows):
    extra = spark.createDataFrame([(75, "x"), (90, "x"), (3, "outside")], "key bigint, name string")
    state = load(spark).where(~F.col("key").isin(44, 60)).unionByName(extra)
    assert as_rows(snapshot(state)) == [(50, 49, 1, 11, 1, 11, 2)]
    bounds = (FIRST, LAST, GONE_FIRST, GONE_LAST)
    assert as_rows(reconcile.survivor_equality(state, "key", *bounds)) == [(2, 1, False)]
    assert as_rows(reconcile.survivor_difference(state, "key", *bounds)) == [(44, "missing"), (60, "missing"), (75, "unexpected")]
    assert [r.key for r in reconcile.missing_ids_sample(state, "key", FIRST, LAST, 3).collect()] == [44, 60, 71]


def test_empty_state(spark, as_rows):
    empty = load(spark).where("false")
    assert as_rows(snapshot(empty)) == [(0, 0, 0, 0, 0, 60, 50)]
    assert reconcile.key_range(empty, "key") == (0, -1)


def test_operation_counts_and_delta(spark, as_rows):
    schema = "operation string, event_count bigint"
    before = spark.createDataFrame([("c", 7), ("d", 2), ("x", 4)], schema)
    after = spark.createDataFrame([("c", 9), ("u", 3), ("d", 2), ("<NULL>", 1)], schema)
    assert as_rows(reconcile.op_count_delta(after, before)) == [("<NULL>", 1), ("c", 2), ("d", 0), ("u", 3), ("x", -4)]
    events = spark.createDataFrame([("u",), (None,), ("u",), ("c",)], "__op string")
    assert as_rows(reconcile.op_counts(events)) == [("<NULL>", 1), ("c", 1), ("u", 2)]


def report(spark, observed, **expected):
    return reconcile.assertions(observed, reconcile.expectations(spark, expected))


def test_report(spark, as_rows):
    observed = reconcile.observations(snapshot(load(spark)))
    good = report(spark, observed, total_records=50, duplicate_primary_keys=0, landing_r=0)
    assert as_rows(reconcile.report_status(good)) == [(3, 0, "PASSED")]
    bad = report(spark, observed, total_records=51)
    assert as_rows(bad) == [("total_records", 50, 51, False)]
    assert reconcile.report_status(bad).first().status == "FAILED"


def test_what_was_not_observed_fails(spark, as_rows):
    observed = reconcile.observations(snapshot(load(spark)))
    got = report(spark, observed, connector_failures=0, landing_d=0, landing_u=1)
    assert as_rows(got) == [("connector_failures", None, 0, False), ("landing_d", 0, 0, True), ("landing_u", 0, 1, False)]
    empty = report(spark, observed.where("false"), total_records=0)
    assert reconcile.report_status(empty).first().status == "FAILED"
    unknown = spark.createDataFrame([("total_records", None)], "name string, expected bigint")
    assert as_rows(reconcile.assertions(observed, unknown)) == [("total_records", 50, None, False)]


def test_throughput(spark):
    rate = lambda seconds: spark.range(1).select(reconcile.throughput(F.lit(30), F.lit(seconds)).alias("r")).first().r
    assert rate(4.0) == 7.5 and round(rate(0.0)) == 30_000_000_000
