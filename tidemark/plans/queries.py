"""The registered queries: every operator run over whole tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import scalars as fn
from tidemark.functions.payload import event_meta, field, from_wire, sound_events, typed_columns
from tidemark.operators import alarms, derive, health, merge, quality, reconcile
from tidemark.operators.latest import replay_account as replayed_account
from tidemark.operators.latest import (
    current_rows,
    current_state,
    current_typed,
    latest_per_key,
    merge_source,
    quarantined,
    replay_order,
    snapshot_plus_tail,
)
from tidemark.plans import marts
from tidemark.plans.incremental import IncrementalModels
from tidemark.plans.load_test import run_load_test
from tidemark.plans.models import DIMENSIONS, FACTS, INTERMEDIATE, MARTS, STAGING, Models
from tidemark.plans.staging import stage
from tidemark.session import fresh_dir, freed_shuffles, open_writers, remove, whole_payloads
from tidemark.sources import extract, landing
from tidemark.sources import sample_tables as sample
from tidemark.sources.landing import to_payload
from tidemark.sources.registry import ARRIVAL, TABLES
from tidemark.streaming import drain as drains
from tidemark.streaming import state_log as states
from tidemark.streaming.bucket_merge import BucketMerge
from tidemark.streaming.dated_landing import DatedLanding

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Times the operators are run with; events are of January 2024, orders of 1995 to 2001.
MID_MONTH = dt.datetime(2024, 1, 15)
MONTH_START, MONTH_END = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 31)
AS_OF = dt.datetime(2024, 2, 1)
SUPPLIER_OFFSET = 1_000_000_000


def named(name: str) -> Callable[[Query], Query]:
    """Register a query, run in UTC."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return function(spark, sf_dir)

        QUERIES[name] = run
        return function

    return register


def query(function: Query) -> Query:
    """Register a query under its function's name."""
    return named(function.__name__)(function)


def models(spark: SparkSession, sf_dir: str) -> Models:
    return Models(spark, lambda table: sample.landing_of(spark, sf_dir, table))


def _model_query(name: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return models(spark, sf_dir)[name]

    named(name)(run)


for _name in STAGING + INTERMEDIATE + DIMENSIONS + FACTS:
    if _name != "dim_date":
        _model_query(_name)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


_WAREHOUSES: dict[tuple[str, str], tuple[Models, str, set[str]]] = {}


def warehouse(spark: SparkSession, sf_dir: str, names: Sequence[str] = STAGING + MARTS) -> Models:
    """Models as written tables, each made once per application and when it is first asked for.

    Checks read each mart many times; written tables keep them from replaying
    the landing for each check.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    # taken out until all is written, so that after a failure the next call starts anew
    found = _WAREHOUSES.pop(key, None) or (models(spark, sf_dir), fresh_dir(spark, "warehouse"), set())
    built, root, written = found
    missing = [name for name in names if name not in written]
    built.materialize(root, missing)
    written.update(missing)
    _WAREHOUSES[key] = found
    return built


def raw_state(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Current rows of a source table, typed but not cleaned."""
    return current_typed(sample.landing_of(spark, sf_dir, table), TABLES[table])


# --- sources, landing, extraction ---


@query
def landing_parse(spark, sf_dir):
    landed = landing.parse_landing(sample.raw_events(spark, sf_dir))
    return landed.select(
        ARRIVAL,
        field("event_id", "bigint").alias("event_id"),
        field("value", "decimal(12,2)").alias("value"),
        field("__op").alias("__op"),
        "__table",
    )


@query
def landing_refresh(spark, sf_dir):
    root = fresh_dir(spark, "refresh")
    sample.raw_events(spark, sf_dir).write.parquet(f"{root}/raw")
    stream = drains.raw_file_stream(spark, f"{root}/raw")
    drains.drain(stream, f"{root}/landing", f"{root}/checkpoint")
    once = landing.read_landing(spark, f"{root}/landing").count()
    drains.drain(stream, f"{root}/landing", f"{root}/checkpoint")
    landed = landing.read_landing(spark, f"{root}/landing")
    return landed.groupBy("__table", field("__op").alias("__op")).agg(
        F.count("*").alias("events"), F.lit(landed.count() - once).cast("bigint").alias("second_drain_rows")
    )


@query
def landing_by_day(spark, sf_dir):
    """Two loads landed by table and day; what a consumer with a mark after the first one still has to read, by day."""
    root = fresh_dir(spark, "dated")
    landed = DatedLanding(spark, f"{root}/landing")
    raw = sample.raw_events(spark, sf_dir)
    second = F.second(ARRIVAL) % 3 == 0
    for part in (raw.where(~second), raw.where(second)):
        part.write.mode("append").parquet(f"{root}/raw")
        landed.drain(drains.raw_file_stream(spark, f"{root}/raw"), f"{root}/checkpoint")
        if landed.mark("reader") < 0:
            landed.advance("reader", landed.newest())
    new = landed.events("user_event", after=landed.mark("reader")).groupBy("__date").agg(F.count("*").alias("new_events"))
    held = landed.manifest().where("table_name = 'user_event'").groupBy("day").agg(F.sum("events").alias("events"))
    return held.join(new, held["day"] == new["__date"], "left").select(
        "day", "events", F.coalesce("new_events", F.lit(0)).cast("bigint").alias("new_events")
    )


def kept_models(
    spark: SparkSession, sf_dir: str, tables: Sequence[str], buckets: int = 8, keep_text: bool = True
) -> IncrementalModels:
    """Models kept over two loads. A third of all events comes late, so older versions and deletes follow newer ones.

    Without `keep_text` the text of the events goes once all of it is landed.
    """
    root = fresh_dir(spark, "kept")
    landed = DatedLanding(spark, f"{root}/landing")
    kept = IncrementalModels(spark, landed, f"{root}/models", tables, buckets)
    raw = _union([to_payload(sample.LOGS[table](spark, sf_dir)) for table in tables])
    late = F.crc32(F.col("value").cast("binary")) % 3 == 0
    # both parts in one pass over the logs; the second run of the stream sees the folder of late events too
    with open_writers(spark), freed_shuffles(spark):
        raw.withColumn("late", late.cast("int")).write.option("compression", "zstd").partitionBy("late").parquet(f"{root}/raw")
    for second, folders in enumerate(("late=[0]", "late=[01]")):
        landed.drain(drains.raw_file_stream(spark, f"{root}/raw/{folders}"), f"{root}/checkpoint")
        if second and not keep_text:
            remove(spark, f"{root}/raw")
        kept.run()
    return kept


@query
def incremental_dim_account(spark, sf_dir):
    return kept_models(spark, sf_dir, ["account", "ledger_entry"], keep_text=False).models()["dim_account"]


@query
def incremental_dim_product(spark, sf_dir):
    return kept_models(spark, sf_dir, ["product", "inventory_movement"], keep_text=False).models()["dim_product"]


@query
def incremental_fact_sales(spark, sf_dir):
    return kept_models(spark, sf_dir, ["sales_invoice", "sales_invoice_item"], keep_text=False).models()["fact_sales"]


@query
def incremental_fct_ledger_entries(spark, sf_dir):
    return kept_models(spark, sf_dir, ["ledger_entry"], keep_text=False).models()["fct_ledger_entries"]


@query
def envelope_flatten(spark, sf_dir):
    return landing.flatten_envelope(sample.envelopes(spark, sf_dir), sample.USER_EVENT)


@query
def route_fan_in(spark, sf_dir):
    events = landing.fan_in([sample.landing_of(spark, sf_dir, table) for table in TABLES])
    return events.groupBy("__table", field("__op").alias("__op")).agg(F.count("*").alias("events"))


@query
def route_fan_out(spark, sf_dir):
    """All logs through one landing, and each staged table from it: its rows and the sum of its keys."""
    path = f"{fresh_dir(spark, 'routed')}/landing"
    landing.write_landing(landing.fan_in([sample.landing_of(spark, sf_dir, table) for table in TABLES]), path)
    events = landing.read_landing(spark, path)
    parts = [
        stage(events, name)
        .agg(F.count("*").alias("row_count"), F.sum(F.col(spec.primary_key).cast("decimal(38,0)")).alias("key_sum"))
        .withColumn("table_name", F.lit(name))
        for name, spec in TABLES.items()
    ]
    return _union(parts)


@query
def heartbeat_filter(spark, sf_dir):
    events = landing.drop_heartbeats(landing.parse_landing(sample.raw_events(spark, sf_dir)))
    return events.groupBy("__table", field("__op").alias("__op")).agg(F.count("*").alias("events"))


@query
def snapshot_tail_log(spark, sf_dir):
    return _snapshot_and_tail(spark, sf_dir).groupBy("__op").agg(F.count("*").alias("events"))


def _snapshot_and_tail(spark, sf_dir):
    """Customers as the snapshot, their orders as the changes that follow."""
    first = sample.read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_mktsegment").alias("segment"),
        sample.money("c_acctbal", "decimal(12,2)").alias("balance"),
        fn.moment(dt.datetime(1990, 1, 1)).alias(ARRIVAL),
    )
    op = F.expr("if(o_orderstatus = 'F' and o_orderpriority = '5-LOW', 'd', 'u')")
    changes = sample.read_table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("segment"),
        sample.money("o_totalprice", "decimal(12,2)").alias("balance"),
        F.col("o_orderdate").alias(ARRIVAL),
        op.alias("__op"),
        (F.col("o_orderkey") + 1).alias("__lsn"),
        fn.timestamp_to_epoch_ms("o_orderdate").alias("__source_ts_ms"),
        F.when(op == "d", "true").otherwise("false").alias("__deleted"),
    )
    return snapshot_plus_tail(first, changes)


@named("snapshot_plus_tail")
def snapshot_plus_tail_state(spark, sf_dir):
    rows = current_rows(_snapshot_and_tail(spark, sf_dir), ["customer_id"])
    return rows.select("customer_id", "segment", "balance", "__op")


@query
def landing_typed(spark, sf_dir):
    """The typed landing of every table, written and read back with its declared schema."""
    root, parts = fresh_dir(spark, "typed"), []
    for name, spec in TABLES.items():
        typed = landing.typed_landing(sample.landing_of(spark, sf_dir, name), spec)
        with whole_payloads(spark), freed_shuffles(spark):
            typed.write.mode("append").option("compression", "zstd").parquet(f"{root}/{name}")
        rows = spark.read.schema(spec.landing_schema).parquet(f"{root}/{name}")
        label = F.col(spec.column_names[1]).cast("string").alias("label")
        meta = ("updated_at", "__op", "__table", "__lsn", "__source_ts_ms", "__deleted")
        parts.append(rows.select(F.col(spec.primary_key).alias("key"), label, *meta))
    return _union(parts)


@query
def schema_evolution(spark, sf_dir):
    path = f"{fresh_dir(spark, 'evolved')}/product"
    rows = sample.product_log(spark, sf_dir).select("product_id", "unit_price", "description", "__lsn", "__op")
    rows.where("__op = 'c'").drop("description").write.mode("append").parquet(path)
    rows.where("__op <> 'c'").write.mode("append").parquet(path)
    later = landing.read_evolved(spark, path).select("product_id", "unit_price", "description", "__op")
    added = rows.where("__op = 'd'").select("product_id", F.lit("removed").alias("note"))
    return landing.evolve(later, added)


@query
def change_stream(spark, sf_dir):
    root = fresh_dir(spark, "changes")
    log = sample.user_event_log(spark, sf_dir)
    before = F.col("ts") < fn.moment(MID_MONTH)
    reads, seen = [], 0
    for part in (log.where(before), log.where(~before), None):
        if part is not None:
            part.write.mode("append").parquet(f"{root}/log")
        stream = drains.change_stream(spark, f"{root}/log", log.schema)
        drains.consume(stream, f"{root}/out", f"{root}/checkpoint")
        total = spark.read.schema(log.schema).parquet(f"{root}/out").count()
        reads.append(total - seen)
        seen = total
    delivered = spark.read.schema(log.schema).parquet(f"{root}/out")
    first, second, third = (F.lit(n).cast("bigint") for n in reads)
    return delivered.agg(
        F.count("*").alias("delivered"),
        F.countDistinct("event_id").alias("distinct_events"),
        first.alias("first_read"),
        second.alias("second_read"),
        third.alias("third_read"),
    )


def _orders_source(spark, sf_dir):
    return sample.read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("invoice_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("total_sum"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("updated_at"),
    )


_ORDER_COLUMNS = ("invoice_id", "customer_id", "total_sum", "updated_at")


@query
def extract_first_run(spark, sf_dir):
    lower, upper = extract.window_bounds(None, dt.datetime(2000, 1, 1))
    return extract.extract_window(_orders_source(spark, sf_dir), _ORDER_COLUMNS, "invoice_id", lower, upper)


@query
def extract_incremental(spark, sf_dir):
    lower, upper = extract.window_bounds(dt.datetime(1998, 1, 1), dt.datetime(2000, 1, 1))
    return extract.extract_window(_orders_source(spark, sf_dir), _ORDER_COLUMNS, "invoice_id", lower, upper)


@query
def conform_schema(spark, sf_dir):
    spec = TABLES["sales_invoice"]
    return extract.conform_schema(_orders_source(spark, sf_dir), spec.schema)


def _checkpoints(spark, sf_dir):
    """A checkpoint per table, from its newest stamp and its rows."""
    parts = []
    for table, stamp in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts")):
        parts.append(
            sample.read_table(spark, sf_dir, table)
            .agg(F.max(stamp).alias("successful_cutoff"), F.count("*").alias("extracted_row_count"))
            .select(
                F.lit(table).alias("source_table"),
                "successful_cutoff",
                "extracted_row_count",
                F.col("extracted_row_count").alias("inserted_row_count"),
                F.lit(0).cast("bigint").alias("updated_row_count"),
                fn.moment(MONTH_START).alias("ingested_at"),
            )
        )
    return _union(parts)


@query
def checkpoint_read(spark, sf_dir):
    return extract.read_checkpoint(_checkpoints(spark, sf_dir), ["orders", "lineitem", "events", "customer"])


def _user_state(spark, sf_dir, upto: dt.datetime | None = None):
    """Newest event of each user as a source table."""
    log = sample.user_event_log(spark, sf_dir)
    if upto is not None:
        log = log.where(F.col("ts") <= fn.moment(upto))
    newest = latest_per_key(log, ["user_id"], [F.col("ts").desc()])
    return newest.select("user_id", "event_id", "event_type", "value", F.col("ts").alias("updated_at"))


@query
def checkpoint_upsert(spark, sf_dir):
    tables = extract.ExtractedTables(spark, fresh_dir(spark, "extracts"))
    orders = _orders_source(spark, sf_dir)
    first = {"users": (_user_state(spark, sf_dir, MID_MONTH), "user_id"), "orders": (orders, "invoice_id")}
    extract.run_extracts(tables, first, MID_MONTH)
    second = {"users": (_user_state(spark, sf_dir), "user_id"), "orders": (orders, "invoice_id")}
    return extract.run_extracts(tables, second, AS_OF)


@query
def extracted_state(spark, sf_dir):
    tables = extract.ExtractedTables(spark, fresh_dir(spark, "extracts"))
    tables.run(_user_state(spark, sf_dir, MID_MONTH), "users", "user_id", MID_MONTH)
    tables.run(_user_state(spark, sf_dir), "users", "user_id", AS_OF)
    tables.compact("users", "user_id")
    return tables.state("users", "user_id")


_ALL_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@query
def multi_table_counts(spark, sf_dir):
    return extract.table_counts({name: sample.read_table(spark, sf_dir, name) for name in _ALL_TABLES})


# The column of a source table that tells when a row changed; the other tables have none.
_STAMPS = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}


def _stamped_tables(spark, sf_dir):
    """All source tables, change stamps under one name."""
    renamed = {name: {column: "updated_at"} for name, column in _STAMPS.items()}
    return {
        name: sample.read_table(spark, sf_dir, name).withColumnsRenamed(renamed.get(name, {})) for name in _ALL_TABLES
    }


def _counts_long(tables):
    return _union(
        [t.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, t in tables.items()]
    )


@query
def schema_preflight(spark, sf_dir):
    tables = _stamped_tables(spark, sf_dir)
    missing = extract.schema_preflight(extract.catalog_columns(spark, tables), [*tables, "supplier_contract"])
    return missing.join(_counts_long(tables), "table_name", "left")


@query
def schema_columns_by_table(spark, sf_dir):
    tables = _stamped_tables(spark, sf_dir)
    return extract.columns_by_table(extract.catalog_columns(spark, tables)).join(_counts_long(tables), "table_name")


@query
def backfill_column(spark, sf_dir):
    stamp = fn.moment(dt.datetime(2002, 1, 1))
    orders = _orders_source(spark, sf_dir).select(
        F.lit("orders").alias("table_name"),
        F.col("invoice_id").alias("id"),
        F.expr("if(status = 'P', null, updated_at)").alias("updated_at"),
    )
    customers = sample.read_table(spark, sf_dir, "customer").select(
        F.lit("customer").alias("table_name"), F.col("c_custkey").alias("id")
    )
    return _union([extract.backfill_column(rows, "updated_at", stamp) for rows in (orders, customers)])


@query
def mart_materialize(spark, sf_dir):
    built = warehouse(spark, sf_dir)
    return _union(
        [built[n].agg(F.count("*").alias("row_count")).select(F.lit(n).alias("model"), "row_count") for n in MARTS]
    )


@query
def results_retention(spark, sf_dir):
    path = f"{fresh_dir(spark, 'results')}/checks"
    health.append_results(sample.check_results(spark, sf_dir), path)
    health.drop_expired(spark, path, AS_OF, 7)
    kept = health.retained(spark.read.parquet(path), AS_OF, 7)
    return kept.select("id", "run_id", "checked_at", "check_name", "subject", "status", "value")


@query
def payload_decode(spark, sf_dir):
    spec = TABLES["sales_invoice_item"]
    events = sound_events(sample.landing_of(spark, sf_dir, spec.name), spec)
    return events.select(*from_wire(spec, "__event"), *event_meta(), "__table")


# --- newest per key, merges, streams ---


@named("latest_per_key")
def latest_per_key_lines(spark, sf_dir):
    newest = latest_per_key(sample.sales_invoice_item_log(spark, sf_dir), ["item_id"], replay_order())
    return newest.select("item_id", "product_id", "unit_price", "__op", "__lsn")


@named("current_state")
def current_state_users(spark, sf_dir):
    landed = landing.parse_landing(sample.raw_events(spark, sf_dir))
    return current_state(landed, sample.USER_EVENT).select(*typed_columns(sample.USER_EVENT))


def _faulty_products(spark, sf_dir):
    """The products' landing with events of unreadable keys, unreadable LSNs, and newest prices that are no numbers."""
    part = sample.read_table(spark, sf_dir, "part")
    key, turn = F.col("p_partkey"), F.col("p_partkey") % 50
    event = F.struct(
        F.when(turn == 0, F.concat(F.lit("x"), key)).otherwise(key.cast("string")).alias("key"),
        F.when(turn == 1, F.lit("soon")).otherwise(F.lit(2**50).cast("string")).alias("lsn"),
    )
    text = F.format_string(
        '{"product_id":"%s","unit_price":"free","__table":"product","__lsn":"%s","__source_ts_ms":1}', event["key"], event["lsn"]
    )
    raw = part.where(turn < 3).select(fn.moment(MONTH_START).alias(ARRIVAL), text.alias("value"))
    return landing.fan_in([sample.landing_of(spark, sf_dir, "product"), landing.parse_landing(raw)])


@query
def replay_account(spark, sf_dir):
    return replayed_account(_faulty_products(spark, sf_dir), TABLES["product"])


@query
def replay_quarantine(spark, sf_dir):
    rows = quarantined(_faulty_products(spark, sf_dir), TABLES["product"])
    return rows.select("reason", field("product_id").alias("product_key"), field("__lsn").alias("lsn"))


@query
def merge_source_dedup(spark, sf_dir):
    newest = merge_source(sample.user_event_log(spark, sf_dir), ["user_id"])
    return newest.select("user_id", "event_id", "event_type", "value", "is_deleted")


_USER_COLUMNS = ("user_id", "event_id", "event_type", "value", "ts")


def _merge_halves(spark, sf_dir):
    log = sample.user_event_log(spark, sf_dir)
    before = F.col("ts") < fn.moment(MID_MONTH)
    first = merge_source(log.where(before), ["user_id"]).where(~F.col("is_deleted"))
    return first.select(*_USER_COLUMNS), log.where(~before)


@query
def merge_changes(spark, sf_dir):
    target, batch = _merge_halves(spark, sf_dir)
    return merge.merge_changes(target, batch, ["user_id"])


@query
def upsert_source_dedup(spark, sf_dir):
    return _user_state(spark, sf_dir)


def _upsert_inputs(spark, sf_dir):
    """State at mid-month, and all events since two days before it."""
    target = _user_state(spark, sf_dir, MID_MONTH)
    since = fn.moment(MID_MONTH - dt.timedelta(days=2))
    log = sample.user_event_log(spark, sf_dir).where(F.col("ts") > since)
    stage_rows = log.select("user_id", "event_id", "event_type", "value", F.col("ts").alias("updated_at"))
    return target, stage_rows


@query
def upsert_newer(spark, sf_dir):
    return merge.upsert_newer(*_upsert_inputs(spark, sf_dir), ["user_id"])


@query
def upsert_counts(spark, sf_dir):
    return merge.upsert_counts(*_upsert_inputs(spark, sf_dir), ["user_id"])


@query
def apply_mutations(spark, sf_dir):
    """Update the first third of the customers, delete the next third, insert copies of the rest."""
    rows = sample.read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_mktsegment").alias("first_name"),
        F.lit(None).cast("timestamp_ntz").alias("updated_at"),
    )
    low, high = reconcile.key_range(rows, "customer_id")
    third = (high - low + 1) // 3
    key = F.col("customer_id")
    changed = merge.apply_update(
        rows, key.between(low, low + third - 1), {"first_name": F.lit("UPDATED")}, fn.moment(AS_OF)
    )
    left = merge.apply_delete(changed, key.between(low + third, low + 2 * third - 1))
    copies = left.where(key >= low + 2 * third).withColumn("customer_id", key + (high - low + 1))
    return merge.apply_insert(left, copies)


@query
def late_event_replay(spark, sf_dir):
    """Arrival turned round: order by LSN gives the same state."""
    late = fn.moment(AS_OF)
    log = sample.user_event_log(spark, sf_dir).withColumn(ARRIVAL, late + (late - F.col(ARRIVAL)))
    return current_rows(log, ["user_id"]).select(*_USER_COLUMNS)


def _merge_streamed(spark, sf_dir, guard: bool, compact: bool = False):
    root = fresh_dir(spark, "merge")
    log = sample.user_event_log(spark, sf_dir)
    state = states.StateLog(spark, f"{root}/state", log.select(*_USER_COLUMNS).schema, ["user_id"], guard)
    stream = lambda: drains.change_stream(spark, f"{root}/log", log.schema)
    before = F.col("ts") < fn.moment(MID_MONTH)
    # The guarded state gets the newer half first, so the older half arrives late.
    halves = (log.where(~before), log.where(before)) if guard else (log.where(before), log.where(~before))
    for half in halves:
        half.write.mode("append").parquet(f"{root}/log")
        states.merge_stream(stream(), state, f"{root}/checkpoint")
        if compact:
            state.compact()
    return state.read()


@query
def merge_stream(spark, sf_dir):
    return _merge_streamed(spark, sf_dir, guard=False)


@query
def merge_stream_guarded(spark, sf_dir):
    return _merge_streamed(spark, sf_dir, guard=True, compact=True)


@query
def merge_stream_buckets(spark, sf_dir):
    """The newer half first, then the older half late, into hash buckets under the guard."""
    root = fresh_dir(spark, "merge")
    log = sample.user_event_log(spark, sf_dir)
    state = BucketMerge(spark, f"{root}/state", log.select(*_USER_COLUMNS).schema, ["user_id"], guard=True, buckets=8)
    before = F.col("ts") < fn.moment(MID_MONTH)
    for half in (log.where(~before), log.where(before)):
        half.write.mode("append").parquet(f"{root}/log")
        changes = drains.change_stream(spark, f"{root}/log", log.schema).writeStream.foreachBatch(state.apply)
        drains.finish(changes.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start())
    return state.read()


TRADE_TABLES = tuple(TABLES)[:8]


@query
def merge_tables(spark, sf_dir):
    """The streams of the eight trade tables merged side by side."""
    root = fresh_dir(spark, "tables")
    for name in TRADE_TABLES:
        typed = landing.typed_landing(sample.landing_of(spark, sf_dir, name), TABLES[name])
        with whole_payloads(spark), freed_shuffles(spark):
            typed.write.option("compression", "zstd").parquet(f"{root}/landing/{name}")
    merged = states.merge_tables(spark, f"{root}/landing", f"{root}/state", f"{root}/checkpoint", TRADE_TABLES)
    parts = [
        log.read().select(
            F.lit(name).alias("table_name"),
            F.col(TABLES[name].primary_key).alias("key"),
            F.col(TABLES[name].column_names[1]).cast("string").alias("label"),
            "updated_at",
        )
        for name, log in merged.items()
    ]
    return _union(parts)


@query
def load_test(spark, sf_dir):
    """The whole customer range loaded; the first tenth updated, the next twentieth deleted."""
    opened = sample.base_time("c_custkey")
    source = sample.read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_mktsegment").alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.concat("c_name", F.lit("@example.test")).alias("email"),
        F.concat(F.lit("+1"), fn.padded("c_custkey", 10)).alias("phone_number"),
        opened.alias("created_at"),
        opened.alias("updated_at"),
    )
    low, high = reconcile.key_range(source, "customer_id")
    tenth, twentieth = (high - low + 1) // 10, (high - low + 1) // 20
    updates, deletes = (low, low + tenth - 1), (low + tenth, low + tenth + twentieth - 1)
    return run_load_test(spark, source, fresh_dir(spark, "load"), "renamed", updates, deletes)


@query
def stream_current_state(spark, sf_dir):
    root = fresh_dir(spark, "stream-state")
    log = sample.user_event_log(spark, sf_dir)
    before = F.col("ts") < fn.moment(MID_MONTH)
    for half in (log.where(~before), log.where(before)):
        half.write.mode("append").parquet(f"{root}/log")
        states.stream_current_state(
            drains.change_stream(spark, f"{root}/log", log.schema),
            ["user_id"],
            _USER_COLUMNS,
            f"{root}/state",
            f"{root}/checkpoint",
        )
    return states.read_current_state(spark, f"{root}/state", ["user_id"])


@query
def replay_equivalence(spark, sf_dir):
    """State by guarded micro-batches against one replay with the merge's rules."""
    streamed = _merge_streamed(spark, sf_dir, guard=True)
    replayed = merge_source(
        sample.user_event_log(spark, sf_dir).where("__op is not null or __deleted = 'true'"), ["user_id"]
    ).where(~F.col("is_deleted"))
    both = streamed.select("user_id", F.col("event_id").alias("a")).join(
        replayed.select("user_id", F.col("event_id").alias("b")), "user_id", "full"
    )
    return both.agg(
        F.count("a").alias("streamed_rows"),
        F.count_if(F.coalesce(F.col("a") == F.col("b"), F.lit(False))).alias("equal_rows"),
    )


@query
def retention_gap(spark, sf_dir):
    """Landed until mid-month; the stream keeps the last day of January."""
    log = sample.user_event_log(spark, sf_dir).withColumn("__table", F.col("event_type"))
    landed = log.where(F.col("ts") < fn.moment(MID_MONTH))
    available = log.where(F.col("ts") >= fn.moment(MONTH_END - dt.timedelta(hours=24)))
    return alarms.retention_gap(landed, available)


@query
def alarm_silent(spark, sf_dir):
    events = sample.read_table(spark, sf_dir, "events").select("ts")
    return alarms.silent_periods(spark, events, MONTH_START, MONTH_END)


@query
def alarm_eval(spark, sf_dir):
    samples = sample.metric_samples(spark, sf_dir)
    specs = (*alarms.default_specs(), *alarms.default_specs("replica"))
    states_ = alarms.evaluate_alarms(samples, specs, MONTH_START, MONTH_END)
    return states_.withColumn("value", F.round("value", 4))


@query
def alarm_stream(spark, sf_dir):
    """The alarms over a stream: three drains of ten days each, with a clock; some samples arrive a drain late."""
    root, names = fresh_dir(spark, "alarms"), ("samples", "ticks")
    specs = (*alarms.default_specs(), *alarms.default_specs("replica"))
    ts, hour = F.col("ts"), dt.timedelta(hours=1)
    samples = sample.metric_samples(spark, sf_dir).where((ts >= fn.moment(MONTH_START)) & (ts < fn.moment(MONTH_END)))
    # up to an hour after the last period, by when all periods are closed
    n_ticks = int((MONTH_END + hour - MONTH_START).total_seconds()) // 300 + 1
    ticks = spark.range(n_ticks).select((fn.moment(MONTH_START) + F.col("id") * F.expr("interval '300' second")).alias("ts"))
    late = F.when(F.second(ts) % 7 == 0, ts + F.expr("interval '30' minute")).otherwise(ts)
    for day in (0, 10, 20):
        low = MONTH_START + dt.timedelta(days=day)
        high = MONTH_END + 2 * hour if day == 20 else low + dt.timedelta(days=10)
        for name, rows, arrival in zip(names, (samples, ticks), (late, ts), strict=True):
            due = (arrival >= fn.moment(low)) & (arrival < fn.moment(high))
            rows.where(due).write.mode("append").parquet(f"{root}/{name}")
        streams = [drains.change_stream(spark, f"{root}/{name}", rows.schema) for name, rows in zip(names, (samples, ticks), strict=True)]
        states_ = alarms.stream_alarms(*streams, specs, MONTH_START, "1 hour")
        drains.consume(states_, f"{root}/states", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/states").withColumn("value", F.round("value", 4))


@query
def metric_series(spark, sf_dir):
    rows = alarms.metric_series(sample.metric_samples(spark, sf_dir))
    return rows.withColumn("sum_value", F.round("sum_value", 4))


# --- marts: parts, KPIs, invariants ---


@query
def payments_posted(spark, sf_dir):
    transactions = models(spark, sf_dir)["stg_financial_transaction"]
    parts = [
        marts.payments_posted(transactions, kind, key, "paid").select(
            F.lit(kind).alias("transaction_type"), F.col(key).alias("document_id"), "paid"
        )
        for kind, key in (("Invoice Payment", "invoice_id"), ("Bill Payment", "bill_id"))
    ]
    return _union(parts)


@query
def transaction_flags(spark, sf_dir):
    flagged = marts.transaction_flags(models(spark, sf_dir)["stg_financial_transaction"])
    return flagged.select("transaction_id", "status", "transaction_type", "is_reversed", "is_successful")


@query
def ledger_legs_pivot(spark, sf_dir):
    return marts.ledger_legs_pivot(models(spark, sf_dir)["stg_ledger_entry"])


@query
def ledger_entry_stats(spark, sf_dir):
    return quality.ledger_entry_stats(models(spark, sf_dir)["stg_ledger_entry"])


@query
def ledger_balance_violations(spark, sf_dir):
    m = models(spark, sf_dir)
    return quality.ledger_balance_violations(m["stg_financial_transaction"], m["stg_ledger_entry"])


@query
def ledger_sum_zero(spark, sf_dir):
    return quality.ledger_sum_nonzero(models(spark, sf_dir)["stg_ledger_entry"])


@query
def unbalanced_transactions(spark, sf_dir):
    return quality.unbalanced_transactions(models(spark, sf_dir)["stg_ledger_entry"])


@query
def posted_iff_entries(spark, sf_dir):
    m = models(spark, sf_dir)
    return quality.posted_without_entries(m["stg_financial_transaction"], m["stg_ledger_entry"])


@query
def negative_balances(spark, sf_dir):
    m = models(spark, sf_dir)
    return quality.negative_balances(m["stg_ledger_entry"], m["stg_account"])


@query
def sales_by_month(spark, sf_dir):
    m = models(spark, sf_dir)
    return marts.sales_by_month(m["fact_sales"], m["dim_date"])


@query
def dim_date(spark, sf_dir):
    """The date dimension with the events of each day."""
    per_day = sample.read_table(spark, sf_dir, "events").groupBy(fn.date_key("ts").alias("date_key")).count()
    dates = marts.dim_date(spark)
    return dates.join(per_day, "date_key", "left").select(
        *dates.columns, F.coalesce("count", F.lit(0).cast("bigint")).alias("event_count")
    )


@query
def kpi_failure_rate(spark, sf_dir):
    return marts.kpi_failure_rate(models(spark, sf_dir)["fct_transactions"])


@query
def kpi_net_activity(spark, sf_dir):
    return marts.kpi_net_activity(models(spark, sf_dir)["fct_transactions"])


@query
def kpi_card_spend(spark, sf_dir):
    return marts.kpi_card_spend(models(spark, sf_dir)["fct_transactions"])


@query
def reversal_links(spark, sf_dir):
    return marts.reversal_links(models(spark, sf_dir)["stg_financial_transaction"])


# --- quality ---


def _checks(spark, sf_dir, kind: str):
    """All checks of a kind, on staging and the marts that they read."""
    checks = [c for c in quality.DECLARED if c.kind == kind]
    read = {c.model for c in checks} | {c.to[0] for c in checks if c.to}
    names = [*STAGING, *(name for name in MARTS if name in read)]
    return quality.run_checks(warehouse(spark, sf_dir, names).__getitem__, checks)


@query
def dq_not_null(spark, sf_dir):
    return _checks(spark, sf_dir, "not_null")


@query
def dq_unique(spark, sf_dir):
    return _checks(spark, sf_dir, "unique")


@query
def dq_accepted_values(spark, sf_dir):
    return _checks(spark, sf_dir, "accepted_values")


@query
def dq_relationships(spark, sf_dir):
    return _checks(spark, sf_dir, "relationships")


@query
def dq_report(spark, sf_dir):
    report = quality.run_checks(warehouse(spark, sf_dir).__getitem__, quality.DECLARED)
    return report.groupBy("check_name", "severity", "status").agg(
        F.count("*").alias("checks"), F.sum("failures").alias("failures")
    )


@query
def source_rules(spark, sf_dir):
    """Rules of the source tables, on staging; no mart is read, so none is written."""
    return quality.run_checks(warehouse(spark, sf_dir, STAGING).__getitem__, quality.source_checks())


@query
def check_constraints(spark, sf_dir):
    ruled = [spec for spec in TABLES.values() if spec.constraints]
    return _union([quality.check_constraints(raw_state(spark, sf_dir, spec.name), spec) for spec in ruled])


# --- health ---


@query
def connector_status(spark, sf_dir):
    reports = sample.connector_reports(spark, sf_dir)
    rows = health.connector_status(reports, ["connector-0", "source", "sink"])
    return rows.unionByName(health.connect_reachable(spark))


@query
def slot_lag_status(spark, sf_dir):
    return health.slot_lag_status(sample.replication_slots(spark, sf_dir), 1_000_000)


def _all_table_health(spark, sf_dir):
    tables = {**_stamped_tables(spark, sf_dir), "supplier_contract": None}
    return health.table_health(spark, tables, AS_OF, 172_800)


def _table_health(spark, sf_dir, check: str):
    return _all_table_health(spark, sf_dir).where(F.col("check_name") == check)


@query
def health_run(spark, sf_dir):
    """One run of all three check groups, appended to the stored results and read back."""
    path = f"{fresh_dir(spark, 'health')}/results"
    reports = sample.connector_reports(spark, sf_dir)
    groups = [
        health.connect_reachable(spark),
        health.connector_status(reports, ["source", "sink"]),
        health.slot_lag_status(sample.replication_slots(spark, sf_dir), 1_000_000),
        _all_table_health(spark, sf_dir),
    ]
    health.append_results(health.as_run(_union(groups), "run-1", AS_OF), path)
    stored = health.retained(spark.read.parquet(path), AS_OF, 7)
    return health.latest_run(stored).groupBy("run_id", "checked_at", "check_name", "status").agg(
        F.count("*").alias("checks")
    )


@query
def row_count_check(spark, sf_dir):
    return _table_health(spark, sf_dir, "row_count")


@query
def table_freshness(spark, sf_dir):
    return _table_health(spark, sf_dir, "table_freshness")


@query
def health_summary(spark, sf_dir):
    return health.summarize(sample.check_results(spark, sf_dir))


@query
def health_run_age(spark, sf_dir):
    return health.run_age(sample.check_results(spark, sf_dir), AS_OF)


@query
def health_failing_latest(spark, sf_dir):
    return health.failing_latest(sample.check_results(spark, sf_dir))


@query
def health_source_rows(spark, sf_dir):
    return health.source_rows(sample.check_results(spark, sf_dir)).withColumn("source_rows", F.round("source_rows", 4))


@query
def health_connectors(spark, sf_dir):
    return health.connectors_latest(sample.check_results(spark, sf_dir))


@query
def health_lag_series(spark, sf_dir):
    return health.series(sample.check_results(spark, sf_dir), "replication_slot_lag", MONTH_START, AS_OF)


@query
def health_rows_series(spark, sf_dir):
    return health.series(sample.check_results(spark, sf_dir), "row_count", MONTH_START, AS_OF)


@query
def health_rows_latest(spark, sf_dir):
    return health.rows_latest(sample.check_results(spark, sf_dir))


@query
def health_freshness_latest(spark, sf_dir):
    return health.freshness_latest(sample.check_results(spark, sf_dir))


@query
def health_recent_issues(spark, sf_dir):
    return health.recent_issues(sample.check_results(spark, sf_dir), MONTH_START, AS_OF)


@query
def health_thresholds(spark, sf_dir):
    return health.thresholds(sample.check_results(spark, sf_dir), AS_OF)


# --- reconciliation ---


def _users(spark, sf_dir):
    """Current users, the key range of the log, and the upper third as the range to be gone."""
    log = sample.user_event_log(spark, sf_dir)
    first, last = reconcile.key_range(log, "user_id")
    gone = last - (last - first + 1) // 3 + 1
    return current_rows(log, ["user_id"]), first, last, gone


@query
def op_counts(spark, sf_dir):
    return reconcile.op_counts(sample.user_event_log(spark, sf_dir))


@query
def op_count_delta(spark, sf_dir):
    log = sample.user_event_log(spark, sf_dir)
    baseline = reconcile.op_counts(log.where(F.col("ts") < fn.moment(MID_MONTH)))
    return reconcile.op_count_delta(reconcile.op_counts(log), baseline)


@query
def present_ids(spark, sf_dir):
    state, first, last, _ = _users(spark, sf_dir)
    return reconcile.present_ids(state, "user_id", first, last)


@query
def missing_ids(spark, sf_dir):
    state, first, last, _ = _users(spark, sf_dir)
    return reconcile.missing_ids(state, "user_id", first, last)


@query
def missing_ids_sample(spark, sf_dir):
    state, first, last, _ = _users(spark, sf_dir)
    return reconcile.missing_ids_sample(state, "user_id", first, last)


def _snapshot(spark, sf_dir):
    state, first, last, gone = _users(spark, sf_dir)
    return reconcile.reconcile_snapshot(state, "user_id", first, last, F.col("event_type") == "click", gone, last)


@query
def reconcile_snapshot(spark, sf_dir):
    return _snapshot(spark, sf_dir)


@query
def survivor_equality(spark, sf_dir):
    state, first, last, gone = _users(spark, sf_dir)
    return reconcile.survivor_equality(state, "user_id", first, last, gone, last)


def _observed(spark, sf_dir):
    """Snapshot and operation counts as one row per name."""
    counts = reconcile.op_counts(sample.user_event_log(spark, sf_dir))
    landed = counts.select(F.concat(F.lit("landing_"), "operation").alias("name"), F.col("event_count").alias("actual"))
    total = counts.agg(F.sum("event_count").alias("actual")).select(F.lit("landing_total").alias("name"), "actual")
    return _union([reconcile.observations(_snapshot(spark, sf_dir)), landed, total])


# What any load is expected to leave; `survivors_lost` is never observed, so it fails.
_FIXED = {
    "duplicate_primary_keys": 0,
    "deleted_records_remaining": 0,
    "missing_count": 0,
    "missing_surviving_count": 0,
    "survivors_lost": 0,
    "landing_r": 0,
}


def _source_counts(spark, sf_dir):
    """One row of what the source table says a load consists of."""
    kind = F.col("event_type")
    return sample.read_table(spark, sf_dir, "events").agg(
        F.count("*").alias("landing_total"),
        F.count_if(kind == "signup").alias("landing_c"),
        F.count_if(kind == "error").alias("landing_d"),
        F.countDistinct("user_id").alias("distinct_ids"),
    )


def _report(spark, sf_dir):
    counted = reconcile.observations(_source_counts(spark, sf_dir)).withColumnRenamed("actual", "expected")
    expected = counted.unionByName(reconcile.expectations(spark, _FIXED))
    return reconcile.assertions(_observed(spark, sf_dir), expected)


@query
def reconcile_report(spark, sf_dir):
    return _report(spark, sf_dir)


_PHASES = ("insert", "mixed", "cleanup")


def _customer_load(spark, sf_dir):
    """A load over all customers as a change log, and its key range with the first id of the upper third.

    All are inserted; then the upper third is deleted and the rest updated; then the rest is deleted. The log says which
    phase an event belongs to.
    """
    ids = sample.read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    first, last = reconcile.key_range(ids, "id")
    gone = last - (last - first + 1) // 3 + 1
    kept = F.col("id") < gone
    ops = F.array(F.lit("c"), F.when(kept, "u").otherwise("d"), F.when(kept, "d"))
    changes = ids.select("id", F.posexplode(ops).alias("phase", "__op")).where("__op is not null")
    lsn = F.col("phase") * F.lit(last - first + 1) + F.col("id")
    log = changes.select(
        "*",
        lsn.alias("__lsn"),
        lsn.alias("__source_ts_ms"),
        F.when(F.col("__op") == "d", "true").otherwise("false").alias("__deleted"),
        fn.moment(MONTH_START).alias(ARRIVAL),
    )
    return log, first, last, gone


def _landed_loads(log):
    """The load landed whole, and cut short: no event of every tenth id has landed."""
    return {"whole": log, "cut": log.where(F.col("id") % 10 != 0)}


def _load_snapshot(landed, phase: int, first: int, last: int, gone: int):
    state = current_rows(landed.where(F.col("phase") <= phase), ["id"])
    return reconcile.reconcile_snapshot(state, "id", first, last, F.col("__op") == "u", gone, last)


@query
def reconcile_status(spark, sf_dir):
    """The user events, which no load has left complete, and a load after its second phase, landed whole and cut short."""
    reports = {"user_events": _report(spark, sf_dir)}
    log, first, last, gone = _customer_load(spark, sf_dir)
    source = sample.read_table(spark, sf_dir, "customer")
    kept = F.count_if(F.col("c_custkey") < gone)
    wanted = source.agg(
        F.count("*").alias("landing_c"),
        (F.count("*") - kept).alias("landing_d"),
        *[kept.alias(name) for name in ("landing_u", "total_records", "distinct_ids", "updated_records")],
    )
    fixed = {name: 0 for name in ("duplicate_primary_keys", "deleted_records_remaining", "missing_surviving_count", "landing_r")}
    expected = reconcile.observations(wanted).withColumnRenamed("actual", "expected")
    expected = expected.unionByName(reconcile.expectations(spark, fixed))
    for name, landed in _landed_loads(log.where("phase < 2")).items():
        counts = reconcile.op_counts(landed).select(
            F.concat(F.lit("landing_"), "operation").alias("name"), F.col("event_count").alias("actual")
        )
        seen = reconcile.observations(_load_snapshot(landed, 1, first, last, gone))
        reports[name] = reconcile.assertions(seen.unionByName(counts), expected)
    return _union([reconcile.report_status(report).withColumn("load", F.lit(name)) for name, report in reports.items()])


@query
def load_throughput(spark, sf_dir):
    elapsed = fn.seconds_between("a", "b")
    events = sample.read_table(spark, sf_dir, "events")
    return events.groupBy("event_type").agg(F.count("*").alias("n"), F.min("ts").alias("a"), F.max("ts").alias("b")).select(
        "event_type", F.round(reconcile.throughput(F.col("n"), elapsed), 9).alias("events_per_second")
    )


def _phases(facts, expected, survivors, updated, source_deleted):
    done = (
        reconcile.insert_complete(expected),
        reconcile.mixed_complete(survivors, updated),
        reconcile.cleanup_complete(source_deleted, F.col("deletes_landed")),
    )
    rows = [F.struct(F.lit(name).alias("phase"), c.alias("complete")) for name, c in zip(_PHASES, done, strict=True)]
    return facts.select(F.inline(F.array(*rows)))


@query
def convergence(spark, sf_dir):
    """Phases of a load against what the source says: the user events, and a load over customers, whole and cut short."""
    kind = F.col("event_type")
    source = sample.read_table(spark, sf_dir, "events")
    wanted = source.agg(F.countDistinct("user_id").alias("users"), F.count_if(kind == "error").alias("source_deleted"))
    last_kind = source.groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("kind"))
    clicked = last_kind.agg(F.count_if(F.col("kind") == "click").alias("clicked"))
    deletes = F.count_if(F.col("__op") == "d").alias("deletes_landed")
    landed = sample.user_event_log(spark, sf_dir).agg(deletes)
    facts = reconcile.side_by_side([_snapshot(spark, sf_dir), wanted, clicked, landed])
    users = F.col("users")
    found = {"user_events": _phases(facts, users, users, F.col("clicked"), F.col("source_deleted"))}

    log, first, last, gone = _customer_load(spark, sf_dir)
    customers = sample.read_table(spark, sf_dir, "customer")
    wanted = customers.agg(F.count("*").alias("n"), F.count_if(F.col("c_custkey") < gone).alias("kept"))
    for name, landed in _landed_loads(log).items():
        for number, phase in enumerate(_PHASES):
            snapshot = _load_snapshot(landed, number, first, last, gone)
            facts = reconcile.side_by_side([snapshot, wanted, landed.where(F.col("phase") <= number).agg(deletes)])
            judged = _phases(facts, F.col("n"), F.col("kept"), F.col("kept"), F.col("n"))
            found[name, phase] = judged.where(F.col("phase") == phase)
    loads = [rows.withColumn("load", F.lit(key if isinstance(key, str) else key[0])) for key, rows in found.items()]
    return _union(loads)


@query
def ordered_distinct(spark, sf_dir):
    return derive.ordered_distinct(sample.read_table(spark, sf_dir, "events"), "user_id", "event_id")


# --- scalar functions over whole tables ---


@query
def normalize_strings(spark, sf_dir):
    return sample.customer_log(spark, sf_dir).select(
        "customer_id",
        "__lsn",
        fn.clean("first_name").alias("first_name"),
        fn.clean_lower("email").alias("email"),
        fn.clean_upper("email").alias("email_upper"),
    )


def _lines(spark, sf_dir):
    return sample.read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        sample.money("l_extendedprice").alias("unit_price"),
        F.expr("case when l_discount > 0 then cast(cast(l_discount as decimal(10,2)) * 100 as decimal(10,2)) end").alias(
            "discount"
        ),
        "l_returnflag",
        "l_shipdate",
    )


@query
def discounted_price(spark, sf_dir):
    price = fn.discounted_price(F.col("unit_price") * F.col("quantity"), "discount")
    return _lines(spark, sf_dir).select("l_orderkey", "l_linenumber", "unit_price", price.alias("net"))


@query
def tax_price(spark, sf_dir):
    total = sample.money("o_totalprice")
    tax = F.round(total * F.expr("0.20"), 2)
    return sample.read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey"), fn.tax_price(total, tax).cast("decimal(17,2)").alias("with_tax")
    )


@query
def signed_quantity(spark, sf_dir):
    kind = F.expr("case l_returnflag when 'R' then 'IN' when 'A' then 'OUT' else l_returnflag end")
    return _lines(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "unit_price", fn.signed_quantity(kind, "quantity").alias("signed_quantity")
    )


@query
def signed_amount(spark, sf_dir):
    """'Credit' adds; every other direction, a missing one too, takes away."""
    direction = F.expr("case o_orderstatus when 'F' then 'Credit' when 'O' then 'Debit' end")
    amount = fn.signed_amount(direction, sample.money("o_totalprice", "decimal(12,2)"))
    return sample.read_table(spark, sf_dir, "orders").select("o_orderkey", amount.alias("signed_amount"))


@query
def epoch_ms(spark, sf_dir):
    ms = fn.timestamp_to_epoch_ms("ts")
    return sample.read_table(spark, sf_dir, "events").select(
        "event_id", ms.alias("ms"), fn.epoch_ms_to_timestamp(ms).alias("ts_ms")
    )


@query
def date_key(spark, sf_dir):
    return _lines(spark, sf_dir).groupBy(fn.date_key("l_shipdate").alias("ship_date_key")).agg(
        F.count("*").alias("line_count")
    )


@query
def delete_flag(spark, sf_dir):
    log = sample.user_event_log(spark, sf_dir)
    words = F.expr(
        "case event_type when 'signup' then 'ON' when 'view' then 'Yes' when 'click' then 'off' "
        "when 'purchase' then 'maybe' else '0' end"
    )
    return log.select("event_id", fn.delete_flag("__op", words).alias("is_deleted"))


@query
def status_rule(spark, sf_dir):
    orders = sample.read_table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", derive.cycled("o_custkey", ("north", "east", "south", "west")).alias("status"))


@query
def due_dates(spark, sf_dir):
    orders = sample.read_table(spark, sf_dir, "orders").withColumn("n", F.expr("o_custkey % 13"))
    return orders.select(
        "o_orderkey",
        derive.stepped_date("o_orderdate", "n", 10).alias("invoice_date"),
        F.expr("o_orderdate + interval '3' day").alias("due_date"),
    )


# --- derived documents ---


def _products(spark, sf_dir):
    return sample.read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), sample.money("p_retailprice").alias("unit_price")
    )


@query
def priced_lines(spark, sf_dir):
    lines = _lines(spark, sf_dir).select("l_orderkey", "l_linenumber", "product_id", "quantity", "l_shipdate")
    return derive.priced_lines(lines, _products(spark, sf_dir), "0.58")


@query
def invoice_totals(spark, sf_dir):
    lines = _lines(spark, sf_dir).select(
        "l_orderkey",
        "product_id",
        "quantity",
        F.expr("cast(if(discount > 5, 2.50, 0.00) as decimal(10,2))").alias("rebate"),
    )
    priced = derive.priced_lines(lines, _products(spark, sf_dir))
    return derive.document_totals(priced, "l_orderkey", "rebate")


@query
def bill_totals(spark, sf_dir):
    lines = _lines(spark, sf_dir).select("l_orderkey", "product_id", "quantity")
    return derive.cost_totals(lines, "l_orderkey", _products(spark, sf_dir), "0.55")


@query
def lateral_agg(spark, sf_dir):
    documents = sample.read_table(spark, sf_dir, "orders").select("o_orderkey")
    lines = _lines(spark, sf_dir).withColumnRenamed("l_orderkey", "o_orderkey")
    totals = derive.lateral_subtotals(documents, lines, "o_orderkey")
    return totals.withColumn("subtotal", F.col("subtotal").cast("decimal(18,2)"))


@query
def scalar_subquery(spark, sf_dir):
    lines = _lines(spark, sf_dir).select("l_orderkey", "l_linenumber", "product_id", "quantity", "unit_price")
    return derive.looked_up_price(lines, _products(spark, sf_dir))


@query
def derive_movements(spark, sf_dir):
    m = models(spark, sf_dir)
    return derive.derive_movements(
        m["stg_purchase_bill_item"], m["stg_purchase_bill"], m["stg_sales_invoice_item"], m["stg_sales_invoice"]
    )


@query
def derive_accounts(spark, sf_dir):
    m = models(spark, sf_dir)
    return derive.derive_accounts(m["stg_customer"], m["stg_supplier"], SUPPLIER_OFFSET)


@query
def derive_cards(spark, sf_dir):
    return derive.derive_cards(models(spark, sf_dir)["stg_customer"])


def _payments(spark, sf_dir):
    m = models(spark, sf_dir)
    return derive.derive_payments(m["stg_sales_invoice"], m["stg_purchase_bill"], SUPPLIER_OFFSET)


@query
def derive_payments(spark, sf_dir):
    return _payments(spark, sf_dir)


@query
def ledger_legs(spark, sf_dir):
    return derive.ledger_legs(_payments(spark, sf_dir))


@query
def reversal_entries(spark, sf_dir):
    """Large incoming payments reversed, and the legs of all of them."""
    large = (F.col("transaction_type") == "Invoice Payment") & (F.col("amount") > 300000)
    reversed_ = derive.reverse_transactions(_payments(spark, sf_dir), large, 10_000_000_000)
    return derive.ledger_legs(reversed_).select("transaction_id", "account_id", "direction", "amount")
