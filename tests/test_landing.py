import datetime as dt
import json
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tidemark.functions.payload import field, typed_columns
from tidemark.operators.latest import current_state, current_typed, quarantined, replay_account
from tidemark.plans.staging import stage
from tidemark.sources import landing, sample_tables
from tidemark.sources.registry import ARRIVAL, TABLES
from tidemark.streaming import drain as drains
from tidemark.streaming.dated_landing import DatedLanding

T0 = dt.datetime(2024, 9, 1)


def raw(spark, values):
    return spark.createDataFrame([(T0 + dt.timedelta(seconds=i), v) for i, v in enumerate(values)], drains.RAW_SCHEMA)


def customer(lsn, op="u", deleted="false", **columns):
    body = {"customer_id": 990001, "first_name": "A", "created_at": 1725000000123, "__table": "customer"}
    body |= {"__op": op, "__lsn": lsn, "__source_ts_ms": 1, "__deleted": deleted} | columns
    return json.dumps({k: v for k, v in body.items() if v is not None})


def test_unparsable_text_is_dropped_and_heartbeats_are_kept(spark, as_rows):
    events = landing.parse_landing(raw(spark, [customer(1), "{", "", None, '{"ts_ms":1}', '{"a":1,"a":2}']))
    assert as_rows(events.select("__table")) == [("customer",), (None,)]
    assert landing.drop_heartbeats(events).count() == 1


def test_missing_path_and_text_decimals(spark):
    event = '{"product_id":1,"unit_price":"19.999","__table":"product","__lsn":1}'
    row = landing.parse_landing(raw(spark, [event])).select(*typed_columns(TABLES["product"])).first()
    assert (row.product_id, str(row.unit_price), row.name, row.created_at) == (1, "20.00", None, None)


def test_quarantine_mode_turns_bad_values_into_null(spark):
    events = landing.parse_landing(raw(spark, ['{"customer_id":"x","__table":"customer"}']))
    assert events.select(field("customer_id", "key", strict=False).alias("k")).first().k is None


def test_only_a_current_malformed_row_fails(spark, as_rows):
    bad = '{"product_id":1,"unit_price":"free","__table":"product","__lsn":%d,"__source_ts_ms":1}'
    good = '{"product_id":1,"unit_price":"2.00","__table":"product","__lsn":5,"__source_ts_ms":1}'
    superseded = landing.parse_landing(raw(spark, [bad % 1, good]))
    assert as_rows(stage(superseded, "product").select("product_id")) == [(1,)]
    current = landing.parse_landing(raw(spark, [bad % 9, good]))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        stage(current, "product").collect()
    wrong = '{"product_id":2,"created_at":"soon","__table":"product","__lsn":%d,"__source_ts_ms":1}'
    right = '{"product_id":2,"created_at":1000,"__table":"product","__lsn":5,"__source_ts_ms":1}'
    assert stage(landing.parse_landing(raw(spark, [wrong % 1, right])), "product").count() == 1
    with pytest.raises(Exception, match="malformed value in product, key 2"):
        stage(landing.parse_landing(raw(spark, [wrong % 9, right])), "product").collect()


def test_no_event_with_an_unreadable_key_vanishes(spark, as_rows):
    spec = TABLES["product"]

    def event(key, lsn, price='"1.00"', deleted="false"):
        return f'{{"product_id":{key},"unit_price":{price},"__table":"product","__lsn":{lsn},"__source_ts_ms":1,"__deleted":"{deleted}"}}'

    bad = [event('"x"', 1), event('"y"', 2), event('"z"', 9, deleted="true"), event("null", 3), event(4, '"soon"'), event(5, "{}")]
    good = [event(5, 1), event(5, 2), event(6, 1), event(6, 2, deleted="true"), event(7, 1), event(8, 1, '"free"'), event(8, 2), event(9, 3, '"free"')]
    events = landing.parse_landing(raw(spark, bad + good))
    for run in (current_state, current_typed):
        with pytest.raises(Exception, match="unreadable"):
            run(events, spec).collect()
    assert as_rows(current_typed(events, spec, quarantine=True).select("product_id")) == [(5,), (7,), (8,)]
    reasons = [r.reason for r in quarantined(events, spec).collect()]
    assert sorted(reasons) == ["malformed value", *["unreadable __lsn"] * 2, *["unreadable key"] * 4]
    account = replay_account(events, spec).first()
    assert (account.events, account.current, account.superseded, account.deleted, account.quarantined) == (14, 3, 3, 1, 7)
    assert account.events == account.current + account.superseded + account.deleted + account.quarantined
    clean = landing.parse_landing(raw(spark, good[:5]))
    assert as_rows(current_typed(clean, spec).select("product_id")) == [(5,), (7,)] and quarantined(clean, spec).count() == 0


def test_typed_and_payload_states_agree(spark, as_rows):
    events = landing.parse_landing(raw(spark, [customer(1), customer(None, first_name="null lsn"), customer(7, "d", "true")]))
    spec = TABLES["customer"]
    typed = as_rows(current_typed(events, spec))
    assert typed == as_rows(current_state(events, spec).select(*typed_columns(spec)))
    assert [r[1] for r in typed] == ["null lsn"]


def test_insert_update_then_delete(spark, as_rows):
    events = [customer(1, "c", first_name=" New "), customer(2, "u", first_name=" Updated ")]
    staged = stage(landing.parse_landing(raw(spark, events)), "customer")
    assert as_rows(staged.select("customer_id", "first_name")) == [(990001, "Updated")]
    gone = [*events, customer(3, "d", "true")]
    assert stage(landing.parse_landing(raw(spark, gone)), "customer").count() == 0


def test_envelope_takes_the_old_image_of_a_delete(spark, as_rows):
    def event(op, before, after):
        source = {"table": "product", "lsn": 7, "ts_ms": 9}
        return json.dumps({"before": before, "after": after, "op": op, "ts_ms": 10, "source": source})

    image = {"product_id": 1, "name": "n", "unit_price": "1.00"}
    flat = landing.flatten_envelope(
        raw(spark, [event("c", None, image), event("d", image, None), '{"ts_ms": 1}']), TABLES["product"]
    )
    kept = flat.select("product_id", "unit_price", "__op", "__lsn", "__deleted")
    assert as_rows(kept) == [(1, "1.00", "c", 7, "false"), (1, "1.00", "d", 7, "true")]
    again = landing.parse_landing(landing.to_payload(flat))
    assert again.where(field("__deleted") == "true").count() == 1


def test_written_landing_prunes_to_one_table(spark, tmp_path, physical, as_rows):
    events = landing.parse_landing(raw(spark, [customer(1), '{"product_id":1,"__table":"product"}', '{"ts_ms":1}']))
    landing.write_landing(events, f"{tmp_path}/landing")
    one = landing.table_log(landing.read_landing(spark, f"{tmp_path}/landing"), "product")
    assert one.count() == 1
    filters = physical(one).split("PartitionFilters: [")[1].split("]")[0]
    assert "product" in filters
    landing.write_landing(events, f"{tmp_path}/even", rebalance=True)
    assert landing.read_landing(spark, f"{tmp_path}/even").count() == 3


def test_typed_landing_has_the_declared_schema(spark):
    spec = TABLES["customer"]
    typed = landing.typed_landing(landing.parse_landing(raw(spark, [customer(1, updated_at=1000)])), spec)
    assert [(f.name, f.dataType) for f in typed.schema] == [(f.name, f.dataType) for f in spec.landing_schema]
    assert typed.first().updated_at == dt.datetime(1970, 1, 1, 0, 0, 1)


def test_typed_landing_takes_each_payload_apart_once(spark, physical):
    spec = TABLES["customer"]
    typed = landing.typed_landing(landing.parse_landing(raw(spark, [customer(1), customer(None, first_name=None)])), spec)
    passes = [line for line in physical(typed).splitlines() if re.search(r"try_variant_get\(payload#\d+, \$, StructField", line)]
    assert len(passes) == 1 and "Generate explode" in passes[0]
    assert sorted((r.first_name or "", r["__lsn"] or 0) for r in typed.collect()) == [("", 0), ("A", 1)]
    for bad in (customer(1, created_at="soon"), customer("x")):
        with pytest.raises(Exception, match="malformed"):
            landing.typed_landing(landing.parse_landing(raw(spark, [bad])), spec).collect()


def test_schema_evolution(spark, tmp_path, as_rows):
    old = spark.createDataFrame([(1, "a")], "id int, name string")
    new = spark.createDataFrame([(2, 5)], "id int, size int")
    assert as_rows(landing.evolve(old, new)) == [(1, "a", None), (2, None, 5)]
    for frame in (old, new):
        frame.write.mode("append").parquet(f"{tmp_path}/t")
    merged = landing.read_evolved(spark, f"{tmp_path}/t").select("id", "name", "size")
    assert as_rows(merged) == [(1, "a", None), (2, None, 5)]


def test_drain_reads_only_what_is_new(spark, tmp_path):
    source, target, mark = f"{tmp_path}/raw", f"{tmp_path}/landing", f"{tmp_path}/mark"
    raw(spark, [customer(1), "{", '{"ts_ms":1}']).write.mode("append").parquet(source)
    stream = drains.raw_file_stream(spark, source)
    landed_rows = lambda: landing.read_landing(spark, target).count()
    drains.drain(stream, target, mark)
    assert landed_rows() == 2
    drains.drain(stream, target, mark)
    assert landed_rows() == 2
    raw(spark, [customer(2)]).write.mode("append").parquet(source)
    drains.drain(stream, target, mark)
    assert landed_rows() == 3
    landed = landing.read_landing(spark, target)
    assert landed.where(F.col("__table") == "customer").count() == 2
    assert landed.count() == 3 and ARRIVAL in landed.columns


def test_events_are_routed_without_sorting_them_by_table(spark, tmp_path, monkeypatch):
    """Tasks keep a file open for each folder; a sort would spill whole payloads once a task holds many events."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before, seen = spark.conf.get(key), []
    write = DataFrameWriter.parquet
    monkeypatch.setattr(
        DataFrameWriter, "parquet", lambda self, path, *a, **b: (seen.append(int(spark.conf.get(key))), write(self, path, *a, **b))[1]
    )
    text = raw(spark, [customer(1), json.dumps({"product_id": 1, "__table": "product"})])
    landing.write_landing(landing.parse_landing(text), str(tmp_path / "landing"))
    DatedLanding(spark, str(tmp_path / "dated")).write(text, 0)
    assert seen[0] > 0 and seen[1] > 0 and spark.conf.get(key) == before
    assert sorted(r[0] for r in landing.read_landing(spark, str(tmp_path / "landing")).select("__table").collect()) == [
        "customer", "product",
    ]


def plan(frame) -> str:
    return frame._jdf.queryExecution().toString()


def test_times_of_a_log_are_moved_without_the_calendar(spark, tmp_path):
    columns = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
    orders = spark.createDataFrame([(k, k % 3, "F", 9000.0 + k, dt.datetime(1996, 2, 28, 23, 30), "1-URGENT") for k in range(20)], columns)
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    log = sample_tables.sales_invoice_log(spark, str(tmp_path))
    assert "INTERVAL '9497" not in plan(log.select("invoice_date", "created_at"))
    moved = log.where("invoice_id = 3 and __op = 'c'").select("invoice_date", "created_at").first()
    at = dt.datetime(1996, 2, 28, 23, 30, tzinfo=dt.timezone.utc) + dt.timedelta(days=sample_tables.SHIFT_DAYS, hours=10)
    assert tuple(moved) == (at.timestamp() * 1000, (at + dt.timedelta(hours=1)).timestamp() * 1000)


def test_texts_are_parsed_in_compiled_code_and_replay_decodes_no_more_than_it_reads(spark):
    events = landing.parse_landing(raw(spark, [customer(1), "{", None, "null"]))
    assert "lambda" not in plan(events)
    texts = [json.loads(r[0]) for r in events.select(F.to_json("payload")).collect()]
    assert texts == [json.loads(customer(1)), None]
    staged = plan(stage(events, "customer"))
    assert "StructField(__lsn" in staged and "StructField(__op" not in staged and "StructField(__table" not in staged


def test_a_written_landing_holds_payloads_whole(spark, tmp_path):
    key = "spark.sql.variant.writeShredding.enabled"
    before = spark.conf.get(key)
    events = landing.parse_landing(raw(spark, [customer(1), customer(2, email="a@b.test")]))
    landing.write_landing(events, f"{tmp_path}/landing")
    assert spark.conf.get(key) == before
    for file in (tmp_path / "landing").rglob("*.parquet"):
        assert pq.read_schema(file).field("payload").type.num_fields == 2  # value and metadata
    assert stage(landing.read_landing(spark, f"{tmp_path}/landing"), "customer").select("email").first()[0] == "a@b.test"


def test_typed_landing_makes_its_metadata_without_a_text(spark, physical):
    """The same objects as by way of JSON, an empty one for an event without an arrival."""
    rows = [(T0, customer(1)), (dt.datetime(1969, 12, 31, 23, 59, 59, 999000), customer(2)), (None, customer(3))]
    events = landing.parse_landing(spark.createDataFrame(rows, drains.RAW_SCHEMA))
    typed = landing.typed_landing(events, TABLES["customer"])
    assert "to_json" not in physical(typed) and "StructsToJson" not in physical(typed)
    by_text = F.parse_json(F.to_json(F.struct(F.unix_millis(F.col(ARRIVAL).cast("timestamp")).alias("arrival_ms"))))
    want = {bytes(r.m.value) for r in events.select(by_text.alias("m")).collect()}
    got = typed.select("__lsn", F.col("record_metadata").alias("m"), F.to_json("record_metadata").alias("t")).collect()
    assert {r.t for r in got} == {'{"arrival_ms":1725148800000}', '{"arrival_ms":-1}', "{}"}
    assert {bytes(r.m.value) for r in got} == want
