import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import merge
from tidemark.operators.latest import (
    advance_versions,
    current_rows,
    current_typed,
    latest_per_key,
    live_rows,
    merge_source,
    replay_order,
    snapshot_plus_tail,
)
from tidemark.plans.queries import QUERIES
from tidemark.sources import sample_tables as sample
from tidemark.sources.registry import ARRIVAL, TABLES
from tidemark.streaming import drain as drains
from tidemark.streaming import state_log as states

T0 = dt.datetime(2024, 1, 1)
LOG = f"id bigint, v string, __op string, __lsn bigint, __source_ts_ms bigint, __deleted string, {ARRIVAL} timestamp_ntz"


def log(spark, events):
    """Events are (id, value, op, lsn, source ms, deleted); arrival is their order."""
    return spark.createDataFrame([(*e, T0 + dt.timedelta(seconds=i)) for i, e in enumerate(events)], LOG)


def replay(events):
    """Brute force of log replay: null first, then largest, then last arrived."""
    best = {}
    for position, e in enumerate(events):
        order = (e[3] is None, e[3] or 0, e[4] is None, e[4] or 0, position)
        if e[0] not in best or order > best[e[0]][0]:
            best[e[0]] = (order, e)
    return sorted((e[0], e[1]) for _, e in best.values() if (e[5] or "false") != "true")


def merged(batches, guard=False):
    """Brute force of micro-batch merges."""
    state = {}

    def rank(e):
        return (e[3] is not None, e[3] or 0, e[4] is not None, e[4] or 0)

    for number, batch in enumerate(batches):
        newest = {}
        for e in batch:
            if e[0] not in newest or rank(e) > rank(newest[e[0]]):
                newest[e[0]] = e
        for key, e in newest.items():
            known = {"true": True, "false": False}.get(e[5]) or False
            deleted = True if e[2] == "d" or known else (None if e[2] is None else False)
            if deleted is None:
                continue
            if not guard or key not in state or rank(e) >= state[key][0]:
                state[key] = (rank(e), deleted, e[1])
    return sorted((k, v) for k, (_, gone, v) in state.items() if not gone)


def test_null_lsn_wins_replay_and_loses_the_merge(spark, as_rows):
    events = [(1, "null", "u", None, 1, "false"), (1, "nine", "u", 9, 2, "false")]
    assert as_rows(current_rows(log(spark, events), ["id"]).select("v")) == [("null",)]
    assert as_rows(merge_source(log(spark, events), ["id"]).select("v")) == [("nine",)]


def test_ties_fall_to_source_time_then_arrival(spark, as_rows):
    events = [(1, "a", "u", 5, 2, None), (1, "b", "u", 5, 1, None), (2, "c", "u", 5, 1, None), (2, "d", "u", 5, 1, None)]
    assert as_rows(current_rows(log(spark, events), ["id"]).select("v")) == [("a",), ("d",)]


def test_replay_ignores_op_and_only_exact_true_deletes(spark, as_rows):
    events = [(1, "kept", "d", 1, 1, "false"), (2, "kept", "u", 1, 1, "TRUE"), (3, "gone", "u", 1, 1, "true")]
    assert as_rows(current_rows(log(spark, events), ["id"]).select("id")) == [(1,), (2,)]


def test_delete_is_dropped_after_ranking_and_reinsert_returns(spark, as_rows):
    events = [(1, "a", "c", 1, 1, "false"), (1, "a", "d", 2, 2, "true")]
    assert current_rows(log(spark, events), ["id"]).count() == 0
    events.append((1, "b", "c", 3, 3, "false"))
    assert as_rows(current_rows(log(spark, events), ["id"]).select("v")) == [("b",)]


def test_unknown_null_order_is_rejected():
    with pytest.raises(ValueError):
        replay_order("middle")


def test_snapshot_rows_lose_to_changes(spark, as_rows):
    snapshot = spark.createDataFrame([(1, "old", T0), (2, "old", T0)], f"id bigint, v string, {ARRIVAL} timestamp_ntz")
    changes = log(spark, [(1, "new", "u", 7, 7, "false")])
    state = current_rows(snapshot_plus_tail(snapshot, changes), ["id"])
    assert as_rows(state.select("id", "v", "__op")) == [(1, "new", "u"), (2, "old", "r")]


def test_merge_arms(spark, as_rows):
    target = spark.createDataFrame([(1, "t"), (2, "t"), (3, "t"), (4, "t")], "id bigint, v string")
    batch = log(
        spark,
        [
            (1, "u", "u", 1, 1, "false"),
            (2, "u", "d", 1, 1, None),
            (3, "skipped", None, 1, 1, "false"),
            (5, "new", "c", 1, 1, None),
            (6, "never", "d", 1, 1, "true"),
            (7, "skipped", None, 1, 1, None),
        ],
    )
    assert as_rows(merge.merge_changes(target, batch, ["id"])) == [(1, "u"), (3, "t"), (4, "t"), (5, "new")]


def test_merge_has_no_lsn_guard(spark, as_rows):
    target = merge.merge_changes(
        spark.createDataFrame([], "id bigint, v string"), log(spark, [(1, "new", "u", 9, 9, "false")]), ["id"]
    )
    late = log(spark, [(1, "old", "u", 1, 1, "false")])
    assert as_rows(merge.merge_changes(target, late, ["id"])) == [(1, "old")]


def stamped(spark, data):
    return spark.createDataFrame(data, "id bigint, v string, updated_at timestamp_ntz")


def test_upsert_is_strict_and_idempotent(spark, as_rows):
    t1, t2 = T0, T0 + dt.timedelta(minutes=1)
    target = stamped(spark, [(1, "t", t1), (2, "t", t2), (3, "t", None), (4, "t", t1)])
    stage = stamped(spark, [(1, "s", t2), (2, "s", t2), (3, "s", t1), (5, "s", t1), (5, "older", T0 - dt.timedelta(1))])
    result = merge.upsert_newer(target, stage, ["id"])
    assert as_rows(result.select("id", "v")) == [(1, "s"), (2, "t"), (3, "s"), (4, "t"), (5, "s")]
    assert as_rows(merge.upsert_counts(target, stage, ["id"])) == [(1, 2)]
    assert as_rows(merge.upsert_counts(result, stage, ["id"])) == [(0, 0)]


def test_range_update_delete_insert(spark, as_rows):
    table = stamped(spark, [(1, "a", None), (2, "b", None), (3, "c", None)])
    key = F.col("id")
    changed = merge.apply_update(table, key <= 1, {"v": F.lit("X")}, F.lit("2024-02-01").cast("timestamp_ntz"))
    left = merge.apply_delete(changed, key == 2)
    full = merge.apply_insert(left, left.withColumn("id", key + 10))
    assert as_rows(full.select("id", "v")) == [(1, "X"), (11, "X"), (13, "c"), (3, "c")]
    assert full.where("updated_at is not null").count() == 2


EVENT = st.tuples(
    st.integers(1, 3),
    st.sampled_from("abc"),
    st.sampled_from(["c", "u", "d", "r", None]),
    st.one_of(st.none(), st.integers(1, 4)),
    st.one_of(st.none(), st.integers(1, 3)),
    st.sampled_from(["true", "false", None]),
)
SLOW = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@SLOW
@given(st.lists(EVENT, min_size=1, max_size=12))
def test_replay_equals_brute_force(spark, events):
    state = current_rows(log(spark, events), ["id"]).select("id", "v")
    assert sorted(tuple(r) for r in state.collect()) == replay(events)


def test_advancing_versions_equals_one_replay(spark, as_rows):
    events = [
        (1, "a", "c", 1, 1, "false"), (2, "a", "c", 2, 2, "false"), (1, "a", "d", 9, 9, "true"),
        (1, "late", "u", 5, 5, "false"), (2, "b", "u", None, 1, "false"), (2, "c", "u", 7, 7, "false"),
    ]
    everything = log(spark, events).withColumn("n", F.col("__lsn"))
    versions = everything.where("false")
    for low in (0, 2, 4):
        part = everything.where(F.unix_seconds(F.col(ARRIVAL).cast("timestamp")).between(
            int(T0.timestamp()) + low, int(T0.timestamp()) + low + 1))
        versions = advance_versions(versions, part, ["id"])
    assert as_rows(live_rows(versions).select("id", "v")) == replay(events) == [(2, "b")]


def distinct_order(batches):
    """Each event gets its own LSN, since the merge breaks ties arbitrarily."""
    numbered, n = [], 0
    for batch in batches:
        out = []
        for e in batch:
            n += 1
            out.append((*e[:3], e[3] * 100 + n if e[3] else None, n if e[3] is None else e[4], e[5]))
        numbered.append(out)
    return numbered


BATCHES = st.lists(st.lists(EVENT, min_size=1, max_size=6), min_size=1, max_size=3).map(distinct_order)


@SLOW
@given(BATCHES, st.booleans())
def test_state_log_equals_brute_force(spark, tmp_path_factory, batches, guard):
    path = str(tmp_path_factory.mktemp("state"))
    schema = spark.createDataFrame([], "id bigint, v string").schema
    state = states.StateLog(spark, path, schema, ["id"], guard)
    for number, batch in enumerate(batches):
        state.apply(log(spark, batch), number)
    want = merged(batches, guard)
    assert sorted(tuple(r) for r in state.read().collect()) == want
    state.apply(log(spark, batches[-1]), len(batches) - 1)
    state.compact()
    assert sorted(tuple(r) for r in state.read().collect()) == want


def test_guarded_state_keeps_tombstones_through_compaction(spark, tmp_path):
    schema = spark.createDataFrame([], "id bigint, v string").schema
    state = states.StateLog(spark, f"{tmp_path}/s", schema, ["id"], guard=True)
    state.apply(log(spark, [(1, "x", "d", 9, 9, "true")]), 0)
    state.compact()
    state.apply(log(spark, [(1, "late", "u", 5, 5, "false")]), 1)
    assert state.read().count() == 0


def test_empty_state(spark, tmp_path):
    schema = spark.createDataFrame([], "id bigint, v string").schema
    state = states.StateLog(spark, f"{tmp_path}/none", schema, ["id"])
    assert state.read().count() == 0
    state.compact()


def test_streams_reach_the_same_state_as_replay(spark, tmp_path, as_rows):
    first = [(1, "a", "c", 1, 1, "false"), (2, "b", "c", 2, 2, "false"), (3, "c", "c", 3, 3, "false")]
    second = [(1, "late", "u", 0, 0, "false"), (2, "b2", "u", 5, 5, "false"), (3, "c", "d", 6, 6, "true")]
    everything = log(spark, first + second)
    schema = everything.schema
    root = str(tmp_path)
    state = states.StateLog(spark, f"{root}/state", everything.select("id", "v").schema, ["id"], guard=True)
    stream = lambda: drains.change_stream(spark, f"{root}/log", schema)
    for part in (first, second):
        log(spark, part).write.mode("append").parquet(f"{root}/log")
        states.merge_stream(stream(), state, f"{root}/m1")
        states.stream_current_state(stream(), ["id"], ["id", "v"], f"{root}/agg", f"{root}/m2")
    states.merge_stream(stream(), state, f"{root}/m1")
    want = as_rows(current_rows(everything, ["id"], "last").select("id", "v"))
    assert as_rows(state.read()) == want == [(1, "a"), (2, "b2")]
    assert as_rows(states.read_current_state(spark, f"{root}/agg", ["id"]).select("id", "v")) == want


def test_latest_per_key_limits_before_the_shuffle(spark, physical):
    newest = latest_per_key(log(spark, [(1, "a", "c", 1, 1, None)]), ["id"], replay_order())
    plan = physical(newest)
    assert plan.count("WindowGroupLimit") == 2


def test_a_payload_is_taken_apart_once_and_its_table_dealt_by_size(spark, sf_dir, physical):
    """One pass over the payload for ranking and columns; parts that adaptive execution sizes, not one for each core."""
    plan = physical(current_typed(sample.landing_of(spark, sf_dir, "sales_invoice_item"), TABLES["sales_invoice_item"]))
    assert "REBALANCE_PARTITIONS_BY_NONE" in plan and "REPARTITION_BY_NUM" not in plan
    passes = [line for line in plan.splitlines() if "try_variant_get(payload" in line and "StructField" in line]
    ranked = [line for line in plan.splitlines() if "Filter" in line and "$.item_id" in line]
    assert len(passes) == 1 and not ranked


@pytest.mark.parametrize("name, tables", [("fact_purchases", 2), ("fact_sales", 2), ("reversal_links", 2)])
def test_a_join_takes_no_payload_apart_again_and_gathers_no_side(spark, sf_dir, physical, name, tables):
    """The filters that a join adds for its key read fields that are there already; both sides are shuffled."""
    plan = physical(QUERIES[name](spark, sf_dir))
    passes = [line for line in plan.splitlines() if "try_variant_get(payload" in line and "StructField" in line]
    assert len(passes) == tables and all("Generate explode" in line for line in passes)
    assert sum(line.count("StructField(created_at") for line in passes) == tables
    assert "Broadcast" not in plan


def test_merging_a_table_reads_no_metadata_of_records(spark, tmp_path):
    """No state keeps it, so a landing whose metadata cannot be read as such is merged all the same."""
    spec = TABLES["supplier"]
    names = [f.name for f in spec.landing_schema.fields]
    kinds = {f.name: f.dataType.simpleString() for f in spec.landing_schema.fields} | {"record_metadata": "bigint"}
    values = {"supplier_id": "id", "name": "concat('s', id)", "__op": "'u'", "__lsn": "id", "__deleted": "'false'", "record_metadata": "id"}
    rows = spark.range(3).selectExpr(*[f"cast({values.get(n, 'null')} as {kinds[n]}) as {n}" for n in names])
    rows.write.parquet(str(tmp_path / "landing" / "supplier"))
    logs = states.merge_tables(spark, *[str(tmp_path / n) for n in ("landing", "state", "checkpoint")], ["supplier"])
    assert sorted((r.supplier_id, r.name) for r in logs["supplier"].read().collect()) == [(0, "s0"), (1, "s1"), (2, "s2")]
