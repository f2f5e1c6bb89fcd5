"""Dated landing, key buckets, and models kept by change sets, against one replay of everything."""

import datetime as dt
import json
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tidemark.operators import reconcile
from tidemark.plans.incremental import IncrementalModels
from tidemark.plans.models import INTERMEDIATE, MARTS, Models
from tidemark.plans.queries import kept_models
from tidemark.session import child_names, fresh_dir
from tidemark.sources import sample_tables as sample
from tidemark.sources.registry import ARRIVAL, TABLES
from tidemark.streaming.bucket_merge import BucketMerge
from tidemark.streaming.bucket_state import BucketState
from tidemark.streaming.dated_landing import DatedLanding
from tidemark.streaming.drain import raw_file_stream
from tidemark.streaming.state_log import StateLog

START = dt.datetime(2024, 3, 1)


def raw(spark, events):
    """(hour, fields) pairs as event text."""
    rows = [(START + dt.timedelta(hours=hour), json.dumps(fields)) for hour, fields in events]
    return spark.createDataFrame(rows, f"{ARRIVAL} timestamp_ntz, value string")


def entry(hour, key, account, amount, lsn, deleted=None, direction="Credit"):
    fields = {
        "entry_id": key, "transaction_id": 1, "account_id": account, "direction": direction,
        "amount": None if amount is None else str(amount), "created_at": 0, "__op": "u", "__table": "ledger_entry",
        "__lsn": lsn, "__source_ts_ms": lsn, "__deleted": deleted,
    }
    return hour, fields


@pytest.fixture
def kept(spark):
    root = fresh_dir(spark, "test-kept")
    landed = DatedLanding(spark, f"{root}/landing")
    return landed, IncrementalModels(spark, landed, f"{root}/models", ["ledger_entry"], buckets=16)


def balances(models):
    return {r.account_id: r.balance for r in models.models()["int_account_balance"].collect()}


def replayed(spark, landed):
    full = Models(spark, landed.events)
    return {r.account_id: r.balance for r in full["int_account_balance"].collect()}


def test_all_models_after_two_loads_are_those_of_one_replay(spark, sf_dir, as_rows):
    kept = kept_models(spark, sf_dir, list(TABLES))
    full = Models(spark, lambda table: sample.landing_of(spark, sf_dir, table))
    mine = kept.models()
    for name in (*INTERMEDIATE, *MARTS):
        assert mine[name].schema.simpleString() == full[name].schema.simpleString(), name
        assert as_rows(mine[name]) == as_rows(full[name]), name


def test_a_second_run_opens_the_new_folders_only(spark, sf_dir):
    kept = kept_models(spark, sf_dir, ["customer", "ledger_entry"])
    landed = kept.landing
    assert landed.newest() == 1 and landed.mark("models") == 1
    new = landed.events("customer", after=0)
    files = new.inputFiles()
    assert files and all("/__load=1/__table=customer/__date=" in f for f in files)
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "__load=0" not in plan
    assert new.count() + landed.events("customer", upto=0).count() == landed.events("customer").count()
    assert landed.events("customer", after=1).count() == 0 and landed.events("nothing").count() == 0
    assert kept.run() == []


def test_a_run_rewrites_touched_buckets_only(spark, kept):
    landed, models = kept
    landed.write(raw(spark, [entry(0, n, n % 40, n, n) for n in range(1, 400)]), 0)
    assert models.run() == ["ledger_entry"]
    state = models.states["ledger_entry"]

    def files():
        return {f: f.split("__bucket=")[1].split("/")[0] for f in state.read().inputFiles()}

    before = files()
    assert len(set(before.values())) == 16
    landed.write(raw(spark, [entry(5, 7, 3, 1000, 900)]), 1)
    assert models.run() == ["ledger_entry"]
    touched = {str(b) for b in state.touched(models.changes("ledger_entry", 1))}
    assert len(touched) == 1
    assert {b for f, b in files().items() if f not in before} == touched
    assert {b for f, b in before.items() if f not in files()} == touched
    plan = state.read([3])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*__bucket", plan)
    assert balances(models) == replayed(spark, landed)


def test_random_loads_equal_a_replay(spark, kept):
    """Updates that move an entry to another account, deletes, late events, null amounts and null accounts."""
    landed, models = kept
    rng = random.Random(4)
    for load in range(4):
        events = []
        for _ in range(60):
            lsn = rng.randrange(10**6)
            events.append(
                entry(
                    rng.randrange(50), rng.randrange(25), rng.choice([None, 1, 2, 3, 4, 5]), rng.choice([None, 5, 7, 11]),
                    lsn, rng.choice([None, "false", "false", "true"]), rng.choice(["Debit", "Credit"]),
                )
            )
        landed.write(raw(spark, events), load)
        models.run()
        assert balances(models) == replayed(spark, landed)


def test_accounts_that_empty_go_and_come_again(spark, kept):
    landed, models = kept
    steps = [
        [entry(0, 1, 1, 5, 1), entry(0, 2, 2, None, 1)], [entry(1, 1, 1, 5, 2, "true")], [entry(2, 3, 1, 9, 3)],
        [entry(3, 3, 2, 9, 4)], [entry(4, 3, 2, 9, 5, "true"), entry(4, 9, 3, 1, 1, "true")],
    ]
    want = [{1: 5, 2: None}, {2: None}, {1: 9, 2: None}, {2: 9}, {2: None}]
    for load, (events, expected) in enumerate(zip(steps, want, strict=True)):
        landed.write(raw(spark, events), load)
        models.run()
        assert balances(models) == expected == replayed(spark, landed)


def test_a_run_that_died_is_repeated_to_the_same_end(spark, kept, monkeypatch):
    landed, models = kept
    landed.write(raw(spark, [entry(0, n, n % 5, n, n) for n in range(1, 50)]), 0)
    models.run()
    landed.write(raw(spark, [entry(1, n, n % 3, 2 * n, 100 + n) for n in range(1, 20)] + [entry(1, 30, 0, 0, 200, "true")]), 1)

    def dies(*_):
        raise RuntimeError("lost")

    state = models.states["ledger_entry"]
    with monkeypatch.context() as broken:  # balances are applied, versions are not
        broken.setattr(state, "upsert", dies)
        with pytest.raises(RuntimeError):
            models.run()
    assert landed.mark("models") == 0
    with monkeypatch.context() as broken:  # everything is applied, the mark is not set; a later load has come meanwhile
        broken.setattr(landed, "advance", dies)
        with pytest.raises(RuntimeError):
            models.run()
    landed.write(raw(spark, [entry(2, 31, 4, 77, 300)]), 2)
    assert models.run() and landed.mark("models") == 1
    assert models.run() and landed.mark("models") == 2
    assert balances(models) == replayed(spark, landed)
    assert models.expire_runs() == [0, 1] and models.run() == []


def test_a_malformed_current_row_stops_the_run(spark, kept):
    landed, models = kept
    key, fields = entry(0, 1, 1, 5, 1)
    landed.write(raw(spark, [(key, fields | {"account_id": "what"})]), 0)
    with pytest.raises(Exception, match="malformed value in ledger_entry, key 1"):
        models.run()
    assert landed.mark("models") == -1
    landed.write(raw(spark, [(key, fields | {"account_id": "what", "__deleted": "true"}), entry(0, 2, 1, 5, 1)]), 0)
    models.run()
    assert balances(models) == {1: 5}


def test_loads_expire_when_all_consumers_are_done(spark, kept):
    landed, models = kept
    for load in range(3):
        landed.write(raw(spark, [entry(24 * load, load, 1, 5, load)]), load)
        models.run()
    landed.advance("other", 1)
    assert landed.events("ledger_entry", since=dt.date(2024, 3, 2)).count() == 2
    assert landed.expire(dt.date(2024, 3, 3), ["models", "other"]) == [0, 1]
    assert [r.load for r in landed.manifest().collect()] == [2]
    assert landed.events("ledger_entry").count() == 1
    assert landed.mark("models") == 2 and landed.newest() == 2
    assert balances(models) == {1: 15}


def test_deletes_below_the_low_water_are_forgotten(spark, kept):
    landed, models = kept
    landed.write(raw(spark, [entry(0, n, 1, 1, n, "true" if n % 2 else None) for n in range(100)]), 0)
    models.run()
    state = models.states["ledger_entry"]
    assert state.read().count() == 100
    models.expire_deletes("ledger_entry", 60)
    assert state.read().where("row is null").agg(F.min("__lsn")).first()[0] >= 60
    landed.write(raw(spark, [entry(1, 71, 1, 1, 3), entry(1, 4, 1, 1, 1000, "true")]), 1)  # a late event stays dead
    models.run()
    assert models.staged("ledger_entry").count() == 49 and balances(models) == {1: 49}


def test_bucketed_merge_equals_the_log(spark):
    schema = "k long, v string, __lsn long, __source_ts_ms long, __op string, __deleted string"
    rng = random.Random(8)
    for guard in (False, True):
        root = fresh_dir(spark, "test-merge")
        columns = spark.createDataFrame([], "k long, v string").schema
        log = StateLog(spark, f"{root}/log", columns, ["k"], guard)
        state = BucketMerge(spark, f"{root}/buckets", columns, ["k"], guard, buckets=4)
        for n in range(6):
            rows = [
                (rng.randrange(30), str(rng.random()), rng.randrange(1000), 0, rng.choice(["c", "u", "u", "d", None]), rng.choice([None, "false"]))
                for _ in range(25)
            ]
            batch = spark.createDataFrame(rows, schema).dropDuplicates(["k", "__lsn"])
            log.apply(batch, n)
            state.apply(batch, n)
            if n == 3:
                state.apply(batch, n)
        assert sorted(log.read().collect()) == sorted(state.read().collect())
        assert len(child_names(spark, state.state.path)) <= 5  # buckets and the success marker
        state.forget_deletes(10**6)
        assert sorted(log.read().collect()) == sorted(state.read().collect())


def test_state_in_fifty_batches_has_as_many_folders_as_buckets(spark):
    root = fresh_dir(spark, "test-buckets")
    state = BucketState(spark, root, spark.createDataFrame([], "k long, v long").schema, ["k"], buckets=3)
    for n in range(50):
        state.upsert(spark.range(n, n + 3).select(F.col("id").alias("k"), F.lit(n).cast("long").alias("v")))
    assert len([c for c in child_names(spark, state.path) if c.startswith("__bucket=")]) == 3
    assert {r.k: r.v for r in state.read().collect()} == {k: min(k, 49) for k in range(52)}


def test_gaps_of_a_very_long_range(spark):
    ids = [1, 2, 5, 900, 901, 10**6, 10**9, 10**11, 10**12 - 1, 7 * 10**11]
    state = spark.createDataFrame([(i,) for i in ids * 2], "key long").repartition(4)
    got = sorted(map(tuple, reconcile.missing_intervals(state, "key", 1, 10**12).collect()))
    there = sorted(ids)
    want = [(a + 1, b - 1) for a, b in zip([0, *there], [*there, 10**12 + 1], strict=True) if b - a > 1]
    assert got == want
    assert [r.key for r in reconcile.missing_ids_sample(state, "key", 1, 10**12, 4).collect()] == [3, 4, 6, 7]
    short = reconcile.missing_ids(state, "key", 1, 1000, piece=7).collect()
    assert sorted(r.key for r in short) == [i for i in range(1, 1001) if i not in ids]
    nothing = state.where("false")
    assert [tuple(r) for r in reconcile.missing_intervals(nothing, "key", 3, 9).collect()] == [(3, 9)]
    assert reconcile.missing_intervals(nothing, "key", 0, -1).count() == 0


def test_a_state_that_is_not_there_yet_costs_a_join_no_shuffle(spark, physical):
    rows = spark.range(10).select(F.col("id").alias("k"), F.col("id").cast("string").alias("v"))
    state = BucketState(spark, f"{fresh_dir(spark, 'test-absent')}/state", rows.schema, ["k"], 4)
    old = state.read([0, 1]).select("k", F.col("v").alias("old"))
    assert "Exchange" not in physical(rows.join(old.hint("merge"), "k", "left"))
    state.upsert(rows)
    assert state.read().count() == 10


def test_both_loads_are_made_in_one_pass_over_the_logs(spark, sf_dir):
    kept = kept_models(spark, sf_dir, ["supplier"])
    raw = f"{kept.root.removesuffix('/models')}/raw"
    assert [n for n in child_names(spark, raw) if n.startswith("late=")] == ["late=0", "late=1"]
    loads = {r.load: r.n for r in kept.landing.manifest().groupBy("load").agg(F.sum("events").alias("n")).collect()}
    counts = spark.read.parquet(raw).groupBy("late").count().collect()
    assert loads == {r.late: r["count"] for r in counts} and len(loads) == 2


def _shuffled(spark):
    """Files of shuffles on this machine."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.length()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def test_a_run_leaves_on_disk_what_later_runs_read(spark, kept):
    """Shuffles end with the run, and new versions are kept once, in the changes."""
    landed, models = kept
    for load in (0, 1):
        landed.write(raw(spark, [entry(n, n, n % 3, 5 + load, 10 * load + n) for n in range(20)]), load)
        before = _shuffled(spark)
        assert models.run() == ["ledger_entry"]
        assert child_names(spark, f"{models.root}/runs/run-{load:012d}") == ["found", "ledger_entry"]
        until = time.monotonic() + 20
        while (left := _shuffled(spark) - before) and time.monotonic() < until:
            time.sleep(0.2)
        assert not left
    assert balances(models) == replayed(spark, landed)


def test_landed_text_is_not_kept(spark, sf_dir):
    """The queries over two loads keep the landing and the states, not the text that was landed."""
    kept = kept_models(spark, sf_dir, ["supplier"], keep_text=False)
    assert child_names(spark, kept.root.removesuffix("/models")) == ["checkpoint", "landing", "models"]
    assert kept.staged("supplier").count() == Models(spark, lambda t: sample.landing_of(spark, sf_dir, t))["stg_supplier"].count()
