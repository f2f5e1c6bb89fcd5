import datetime as dt
import time
from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.operators import derive
from tidemark.plans import marts
from tidemark.plans.models import Models

D = Decimal
DAY = dt.datetime(2026, 8, 1)


def test_document_totals(spark, as_rows):
    lines = spark.createDataFrame(
        [(1, D("6.90"), 2, D("5.00")), (1, D("12.00"), 1, D("0.00")), (2, D("0.33"), 1, D("0.00"))],
        "doc int, unit_price decimal(10,2), quantity int, rebate decimal(10,2)",
    )
    assert as_rows(derive.document_totals(lines, "doc", "rebate")) == [(1, D("20.80"), D("4.16")), (2, D("0.33"), D("0.07"))]


def test_totals_at_cost_are_of_the_given_lines(spark, as_rows):
    products = spark.createDataFrame([(7, D("10.00")), (900, D("0.99"))], "product_id bigint, unit_price decimal(10,2)")
    lines = spark.createDataFrame(
        [(1, 7, 3), (1, 900, 10), (2, 900, 1), (3, 8, 5)], "bill_id bigint, product_id bigint, quantity int"
    )
    # Bill 1: 3 at 5.50 and 10 at 0.54; bill 3 has no known product.
    assert as_rows(derive.cost_totals(lines, "bill_id", products, "0.55")) == [
        (1, D("21.90"), D("4.38")), (2, D("0.54"), D("0.11")),
    ]


def test_labels_by_modulo_and_dates_by_steps(spark):
    keys = spark.createDataFrame([(0,), (1,), (5,), (-1,), (None,)], "k bigint")
    assert [r.s for r in keys.select(derive.cycled("k", ("a", "b", "c")).alias("s")).collect()] == ["a", "b", "c", "c", None]
    dates = spark.createDataFrame([(DAY, 0), (DAY, 3), (None, 1)], "d timestamp_ntz, n int")
    got = [r.s for r in dates.select(derive.stepped_date("d", "n", 10).alias("s")).collect()]
    assert got == [DAY, DAY + dt.timedelta(days=30), None]


def payments(spark):
    invoices = spark.createDataFrame(
        [(3, 1, "Paid", D("10.00"), D("2.00"), DAY), (4, 1, "Pending", D("1.00"), D("0.20"), DAY)],
        "invoice_id bigint, customer_id bigint, status string, total_sum decimal(10,2), tax_amount decimal(10,2), "
        "invoice_date timestamp_ntz",
    )
    bills = spark.createDataFrame(
        [(3, 5, D("7.00"), DAY), (4, 5, D("0.00"), DAY), (5, 5, None, DAY)],
        "bill_id bigint, supplier_id bigint, paid_amount decimal(10,2), bill_date timestamp_ntz",
    )
    return derive.derive_payments(invoices, bills, 12)


def test_payments_and_legs(spark, as_rows):
    found = payments(spark)
    kept = found.select("transaction_id", "transaction_type", "amount", "from_account", "to_account")
    assert as_rows(kept) == [(6, "Invoice Payment", D("12.00"), 3, 1), (7, "Bill Payment", D("7.00"), 1, 17)]
    legs = derive.ledger_legs(found).select("transaction_id", "account_id", "direction", "amount")
    assert as_rows(legs) == [
        (6, 1, "Credit", D("12.00")), (6, 3, "Debit", D("12.00")), (7, 1, "Debit", D("7.00")), (7, 17, "Credit", D("7.00")),
    ]


def test_reversal_swaps_accounts_and_nets_to_nothing(spark, as_rows):
    after = derive.reverse_transactions(payments(spark), F.col("transaction_type") == "Invoice Payment", 1000)
    states = after.select("transaction_id", "status", "reverses_transaction_id")
    assert as_rows(states) == [(1006, "Posted", 6), (6, "Reversed", None), (7, "Posted", None)]
    legs = derive.ledger_legs(after)
    undo = legs.where("transaction_id = 1006").select("account_id", "direction")
    assert as_rows(undo) == [(1, "Debit"), (3, "Credit")]
    signed = F.when(F.col("direction") == "Credit", F.col("amount")).otherwise(-F.col("amount"))
    pair = legs.where("transaction_id in (6, 1006)").groupBy("account_id").agg(F.sum(signed).alias("net"))
    assert as_rows(pair) == [(1, D("0.00")), (3, D("0.00"))]


def test_lateral_and_scalar_subqueries(spark, as_rows):
    documents = spark.createDataFrame([(1,), (2,)], "doc int")
    lines = spark.createDataFrame([(1, 7, 2, D("1.50")), (1, 8, 1, D("1.00"))], "doc int, product_id int, quantity int, unit_price decimal(10,2)")
    assert as_rows(derive.lateral_subtotals(documents, lines, "doc")) == [(1, 2, D("4.00")), (2, 0, None)]
    products = spark.createDataFrame([(7, D("9.00"))], "product_id int, unit_price decimal(10,2)")
    looked = derive.looked_up_price(lines, products).select("product_id", "list_price")
    assert as_rows(looked) == [(7, D("9.00")), (8, None)]


def test_ordered_distinct(spark):
    rows = spark.createDataFrame([(0, "b"), (1, "a"), (2, "b"), (3, "c")], "n int, v string")
    assert [r.v for r in derive.ordered_distinct(rows, "v", "n").collect()] == ["b", "a", "c"]


def test_date_dimension(spark):
    dates = marts.dim_date(spark)
    assert dates.count() == 4018
    rows = {r.date_key: r for r in dates.where("date_key in (20200101, 20270101, 20301231)").collect()}
    assert (rows[20270101].week_number, rows[20270101].month_name, rows[20270101].day_name) == (53, "January", "Fri")
    assert (rows[20200101].quarter, rows[20301231].quarter) == (1, 4)


def test_receivables_and_payables(spark, as_rows):
    transactions = spark.createDataFrame(
        [
            ("Invoice Payment", "Posted", D("12.00"), 1, None),
            ("Invoice Payment", "Reversed", D("12.00"), 2, None),
            ("Invoice Payment", "Posted", D("12.00"), 3, None),
            ("Bill Payment", "Posted", D("5.00"), None, 1),
        ],
        "transaction_type string, status string, amount decimal(12,2), invoice_id bigint, bill_id bigint",
    )
    invoices = spark.createDataFrame(
        [(1, "Paid"), (2, "Paid"), (3, "Pending"), (4, "Pending"), (5, None)], "invoice_id bigint, status string"
    ).withColumns({"customer_id": F.lit(1), "invoice_date": F.lit(DAY), "total_amount_with_tax": F.lit(D("12.00"))})
    found = marts.fct_receivables(invoices, transactions).select("invoice_id", "outstanding_amount", "is_status_mismatch")
    assert as_rows(found) == [
        (1, D("0.00"), False), (2, D("12.00"), True), (3, D("0.00"), True), (4, D("12.00"), False), (5, D("12.00"), False),
    ]
    bills = spark.createDataFrame(
        [(1, D("5.00")), (2, D("5.00")), (3, None)], "bill_id bigint, paid_amount decimal(10,2)"
    ).withColumns(
        {"supplier_id": F.lit(1), "bill_date": F.lit(DAY), "total_amount_with_tax": F.lit(D("12.00")), "status": F.lit("Paid")}
    )
    found = marts.fct_payables(bills, transactions).select("bill_id", "ledger_paid_amount", "is_paid_amount_mismatch")
    assert as_rows(found) == [(1, D("5.00"), False), (2, D("0.00"), True), (3, D("0.00"), False)]


def test_inventory_balance_and_null_in_product(spark, as_rows):
    moves = spark.createDataFrame([(1, "IN", 5), (1, "OUT", 2), (1, "ADJUST", 9)], "product_id int, movement_type string, quantity int")
    balance = marts.int_inventory_balance(moves)
    assert as_rows(balance) == [(1, 3)]
    products = spark.createDataFrame([(1, "a"), (2, "b")], "product_id int, name string").withColumns(
        {"description": F.lit(""), "unit_price": F.lit(D("1.00"))}
    )
    assert as_rows(marts.dim_product(products, balance).select("product_id", "balance_quantity")) == [(1, 3), (2, None)]


def test_failure_rate(spark, as_rows):
    rows = spark.createDataFrame([("Failed",), ("Posted",), ("Posted",), ("Reversed",), ("Pending",), (None,)], "status string")
    assert as_rows(marts.kpi_failure_rate(rows)) == [(1, 4, 0.25)]
    assert as_rows(marts.kpi_failure_rate(rows.where("status = 'Pending'"))) == [(0, 0, None)]


def _shuffled(spark):
    """Files of shuffles on this machine."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.length()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def test_written_models_leave_no_shuffle_behind(spark, tmp_path):
    """Models written side by side hold on disk what they shuffle only until they are written."""
    models = Models(spark, lambda table: None)
    for name in ("stg_customer", "stg_card", "stg_supplier"):
        models.replace(name, spark.range(1000).repartition(4, "id"))
    before = _shuffled(spark)
    models.materialize(str(tmp_path), ["stg_customer", "stg_card", "stg_supplier", "dim_customer"])
    until = time.monotonic() + 20
    while (left := _shuffled(spark) - before) and time.monotonic() < until:
        time.sleep(0.2)
    assert not left
    assert models["dim_customer"].count() == 1000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
