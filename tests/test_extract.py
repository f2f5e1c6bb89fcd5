import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import moment
from tidemark.sources import extract

NINE, TEN = dt.datetime(2026, 8, 24, 9), dt.datetime(2026, 8, 24, 10)
SCHEMA = "id bigint, v string, updated_at timestamp_ntz"


def table(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_window_bounds():
    assert extract.window_bounds(None, TEN) == (None, TEN)
    assert extract.window_bounds(NINE, TEN) == (dt.datetime(2026, 8, 24, 8, 55), TEN)


def test_window_is_open_below_and_closed_above(spark):
    minute = dt.timedelta(minutes=1)
    source = table(
        spark, [(1, "a", NINE), (2, "b", NINE + minute), (3, "c", TEN), (4, "d", TEN + minute), (5, "e", None)]
    )
    window = extract.extract_window(source, ["id"], "id", NINE, TEN)
    assert [r.id for r in window.collect()] == [2, 3]
    first = extract.extract_window(source, ["id", "updated_at"], "id", None, TEN)
    assert [r.id for r in first.collect()] == [1, 2, 3]


def test_bounds_and_columns_reach_the_scan(spark, sf_dir, physical):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    window = extract.extract_window(
        orders, ["o_orderkey"], "o_orderkey", dt.datetime(1998, 1, 1), dt.datetime(1999, 1, 1), "o_orderdate"
    )
    plan = physical(window)
    assert "GreaterThan(o_orderdate,1998-01-01" in plan and "LessThanOrEqual(o_orderdate,1999-01-01" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_conform_and_backfill(spark, as_rows):
    rows = spark.createDataFrame([(1, "2.345")], "id int, price string")
    schema = T.StructType(
        [T.StructField("price", T.DecimalType(10, 2)), T.StructField("id", T.LongType()), T.StructField("x", T.DateType())]
    )
    assert extract.conform_schema(rows, schema).schema.simpleString() == schema.simpleString()
    filled = extract.backfill_column(table(spark, [(1, "a", None), (2, "b", NINE)]), "updated_at", moment(TEN))
    assert [r.updated_at for r in filled.orderBy("id").collect()] == [TEN, NINE]
    assert extract.backfill_column(rows, "updated_at", moment(TEN)).first().updated_at == TEN


def test_preflight_names_tables_without_the_column(spark, as_rows):
    tables = {"a": table(spark, []), "b": spark.createDataFrame([], "id int")}
    columns = extract.catalog_columns(spark, tables)
    assert as_rows(extract.schema_preflight(columns, ["a", "b", "c"])) == [("b",), ("c",)]
    assert as_rows(extract.columns_by_table(columns)) == [("a", True), ("b", False)]


def test_checkpoint_upsert_and_read(spark, as_rows):
    old = spark.createDataFrame([("a", NINE, 1, 1, 0, NINE), ("b", NINE, 1, 1, 0, NINE)], extract.CHECKPOINT_SCHEMA)
    new = spark.createDataFrame([("a", TEN, 6, 4, 2, TEN)], extract.CHECKPOINT_SCHEMA)
    after = extract.upsert_checkpoint(old, new)
    assert sorted((r.source_table, r.successful_cutoff, r.inserted_row_count) for r in after.collect()) == [
        ("a", TEN, 4),
        ("b", NINE, 1),
    ]
    found = extract.read_checkpoint(after, ["a", "z"])
    assert as_rows(found) == [("a", TEN, False), ("z", None, True)]


def test_runs_move_state_and_cutoff_together(spark, tmp_path, as_rows):
    tables = extract.ExtractedTables(spark, f"{tmp_path}/x")
    assert tables.state("t", "id") is None
    tables.run(table(spark, [(1, "a", NINE), (2, "b", NINE), (9, "future", TEN)]), "t", "id", NINE)
    assert as_rows(tables.state("t", "id").select("id", "v")) == [(1, "a"), (2, "b")]
    # Row 1 changed, row 2 is read again through the overlap and must not count, row 3 is new.
    later = NINE + dt.timedelta(minutes=30)
    source = table(spark, [(1, "a2", later), (2, "again", NINE), (3, "c", later)])
    tables.run(source, "t", "id", TEN)
    assert as_rows(tables.state("t", "id").select("id", "v")) == [(1, "a2"), (2, "b"), (3, "c")]
    mark = tables.checkpoints().first()
    counts = (mark.extracted_row_count, mark.inserted_row_count, mark.updated_row_count)
    assert (mark.successful_cutoff, counts) == (TEN, (3, 1, 1))
    # An empty window still moves the cutoff.
    end = TEN + dt.timedelta(hours=1)
    tables.run(table(spark, []), "t", "id", end)
    assert tables.checkpoints().first().successful_cutoff == end
    tables.run(table(spark, [(7, "other", NINE)]), "u", "id", TEN)
    tables.compact("t", "id")
    assert as_rows(tables.state("t", "id").select("id", "v")) == [(1, "a2"), (2, "b"), (3, "c")]
    assert sorted(r.source_table for r in tables.checkpoints().collect()) == ["t", "u"]


def test_an_unfinished_run_is_invisible(spark, tmp_path, as_rows):
    tables = extract.ExtractedTables(spark, f"{tmp_path}/x")
    tables.run(table(spark, [(1, "a", NINE)]), "t", "id", NINE)
    # State written, process lost before the checkpoint.
    orphan = table(spark, [(1, "lost", TEN)]).withColumns(
        {"__action": F.lit("update"), "__run": F.lit(2).cast("bigint")}
    )
    orphan.write.parquet(f"{tmp_path}/x/state/t/run-000000000002")
    assert as_rows(tables.state("t", "id").select("v")) == [("a",)]
    tables.run(table(spark, [(5, "u", NINE)]), "other", "id", TEN)
    assert as_rows(tables.state("t", "id").select("v")) == [("a",)]


def test_table_counts(spark, as_rows):
    assert as_rows(extract.table_counts({"a": spark.range(3), "b": spark.range(0)})) == [(3, 0)]
