import compare
import duckdb
import pathlib
import pytest

from __spark_entry__ import entry
from tidemark.plans.models import INTERMEDIATE, STAGING, Models, save_bucketed
from tidemark.session import fresh_dir, shared_dir
from tidemark.sources import sample_tables as sample
from tidemark.plans.oracle import ORACLE_SQL as ORACLES
from tidemark.plans.queries import QUERIES, warehouse


@pytest.fixture(scope="module")
def oracle(sf_dir):
    connection = duckdb.connect()
    for path in sorted(pathlib.Path(sf_dir).glob("*.parquet")):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_oracle_and_has_no_pairwise_join(spark, sf_dir, oracle, physical, name):
    frame = QUERIES[name](spark, sf_dir)
    got = frame.collect()
    plan = physical(frame)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan and "MapInPandas" not in plan
    cursor = oracle.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(frame.columns) == sorted(columns)
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    assert {c: compare.KINDS.get(t, t.upper()) for c, t in frame.dtypes} == kinds
    assert compare.rows_of(got, frame.columns) == compare.rows_of(cursor.fetchall(), columns)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    frame = entry(spark)
    assert frame.count() > 0 and "net_amount" in frame.columns


def test_models_as_views(spark, sf_dir):
    built = Models(spark, lambda table: sample.landing_of(spark, sf_dir, table))
    built.views(INTERMEDIATE)
    assert spark.sql("select count(balance) as n from int_account_balance").first().n > 0


def test_bucketed_models_join_without_a_shuffle(spark, sf_dir, physical):
    built = warehouse(spark, sf_dir)
    root = fresh_dir(spark, "bucketed")
    names = {"bucketed_items": "stg_sales_invoice_item", "bucketed_invoices": "stg_sales_invoice"}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        for table, model in names.items():
            save_bucketed(built[model], table, ["invoice_id"], 4, f"{root}/{table}")
        joined = spark.table("bucketed_items").join(spark.table("bucketed_invoices"), "invoice_id")
        assert "Exchange" not in physical(joined)
        assert joined.count() == QUERIES["fact_sales"](spark, sf_dir).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for table in names:
            spark.sql(f"drop table if exists {table}")


def test_shared_folder_is_read_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_dir(spark) == configured.rstrip("/")
    assert fresh_dir(spark, "x") != fresh_dir(spark, "x")


def test_joins_on_a_unique_key_use_the_partitioning_of_log_replay(spark, sf_dir, physical):
    settings = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key in settings:
            spark.conf.set(key, "-1")
        shuffles = lambda name: physical(QUERIES[name](spark, sf_dir)).count("Exchange hashpartitioning")
        # Two replays and the payments; two replays and both sides of the join, which may be split.
        assert shuffles("fct_receivables") == 3
        assert shuffles("fact_sales") == 4
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def test_source_rules_write_staging_only(spark, sf_dir):
    path = f"{sf_dir}/."  # a warehouse of its own
    assert QUERIES["source_rules"](spark, path).count() > 0
    mart = warehouse(spark, path, STAGING)["fct_payables"]
    assert mart.inputFiles() and all("/stg_" in file for file in mart.inputFiles())
    assert warehouse(spark, path, [*STAGING, "fct_payables"])["fct_payables"].inputFiles()[0].count("/fct_payables/") == 1


def test_metric_samples_are_dealt_out(spark, sf_dir, physical):
    assert "REBALANCE" in physical(sample.metric_samples(spark, sf_dir)).upper()
