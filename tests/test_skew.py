"""One key with a third of all rows: plans that split it or never gather it."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import derive, quality
from tidemark.operators.latest import latest_per_key
from tidemark.plans import marts

HOT = "case when id % 3 = 0 then 0 else id end"


@pytest.fixture
def skew_conf(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def final_plan(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def items(spark):
    return spark.range(0, 90_000, 1, 8).selectExpr(
        "id as item_id",
        f"{HOT} as invoice_id",
        "id % 50 as product_id",
        "cast(1 as int) as quantity",
        "cast(2 as decimal(10,2)) as unit_price",
        "cast(null as decimal(10,2)) as discount",
        "cast(2 as decimal(16,2)) as total_price_with_discount",
        "cast(id as string) as note",
    )


def invoices(spark):
    """Headers as they come out of log replay: the newest of two versions."""
    versions = spark.range(0, 180_000, 1, 8).selectExpr(
        "id div 2 as invoice_id", "id as v"
    )
    newest = latest_per_key(versions, ["invoice_id"], [F.col("v").desc()])
    return newest.select(
        "invoice_id",
        F.lit(1).alias("customer_id"),
        F.expr("timestamp_ntz'2026-01-01 00:00:00'").alias("invoice_date"),
        F.lit("Paid").alias("status"),
    )


def test_hot_invoice_is_split_in_the_sales_join(spark, skew_conf):
    sales = marts.fact_sales(items(spark), invoices(spark))
    assert "skew=true" in final_plan(sales)
    assert sales.count() == 90_000


def test_hot_product_is_split_when_lines_are_priced(spark, skew_conf):
    lines = items(spark).select("item_id", F.expr("if(item_id % 3 = 0, 0, item_id)").alias("product_id"), "note")
    products = spark.range(0, 90_000, 1, 8).selectExpr("id as product_id", "cast(3 as decimal(10,2)) as unit_price")
    products = latest_per_key(products, ["product_id"], [F.col("unit_price").desc()])
    assert "skew=true" in final_plan(derive.priced_lines(lines, products))
    assert "skew=true" in final_plan(derive.looked_up_price(lines, products))


def test_children_are_counted_before_the_relationship_join(spark, skew_conf):
    frames = {
        "child": items(spark),
        "parent": spark.range(0, 90_000, 1, 8).selectExpr("id as invoice_id").where("invoice_id <> 0"),
    }
    check = quality.Check("child", "invoice_id", "relationships", to=("parent", "invoice_id"))
    report = quality.run_checks(frames.__getitem__, [check])
    assert report.first().failures == 30_000
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LeftAnti") < plan.index("Aggregate [", plan.index("LeftAnti"))


def test_a_hot_key_sends_one_row_per_task(spark, skew_conf):
    log = spark.range(0, 90_000, 1, 8).selectExpr("id % 1 as k", "id as v")
    newest = latest_per_key(log, ["k"], [F.col("v").desc()])
    assert newest.first().v == 89_999
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_replayed_headers_are_not_broadcast_by_a_wrong_estimate(spark, physical):
    """Headers that a replay leaves look small to Spark; joined by shuffle they never pass through the driver."""
    sales = marts.fact_sales(items(spark), invoices(spark))
    assert "BroadcastHashJoin" not in final_plan(sales)
    assert sales.count() == 90_000
    lines = items(spark).selectExpr("item_id", "invoice_id as bill_id", "invoice_id", "product_id", "quantity")
    bills = invoices(spark).selectExpr("invoice_id as bill_id", "invoice_date as bill_date")
    assert "BroadcastHashJoin" not in final_plan(derive.derive_movements(lines, bills, lines, invoices(spark)))
    moved = spark.range(0, 100, 1, 2).selectExpr(
        "id as transaction_id", "if(id % 2 = 0, id - 1, null) as reverses_transaction_id", "id as amount", "'Posted' as status"
    )
    assert "BroadcastHashJoin" not in final_plan(marts.reversal_links(moved))
