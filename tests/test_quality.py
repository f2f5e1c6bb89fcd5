from collections import Counter
from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.plans import marts
from tidemark.sources.registry import TABLES

ENTRIES = "entry_id bigint, transaction_id bigint, account_id bigint, direction string, amount decimal(12,2)"
TRANSACTIONS = "transaction_id bigint, transaction_type string, status string, amount decimal(12,2)"


def money(value):
    return Decimal(value)


def entries(spark, data):
    rows = [(i, t, a, d, money(m)) for i, (t, a, d, m) in enumerate(data)]
    frame = spark.createDataFrame(rows, ENTRIES)
    signed = F.when(F.col("direction") == "Credit", F.col("amount")).otherwise(-F.col("amount"))
    return frame.withColumn("signed_amount", signed.cast("decimal(12,2)"))


def transactions(spark, data):
    return spark.createDataFrame([(i, "Transfer", s, money(m)) for i, s, m in data], TRANSACTIONS)


def test_declared_checks():
    assert Counter(c.kind for c in quality.DECLARED) == {
        "not_null": 73, "unique": 18, "accepted_values": 15, "relationships": 30,
    }
    assert sum(c.severity == "warn" for c in quality.DECLARED) == 4


def test_failures_are_counted_as_declared(spark):
    model = spark.createDataFrame(
        [(1, "a", 1), (1, "b", 9), (2, "z", 9), (None, None, None), (None, "z", None)], "id int, v string, p int"
    )
    parent = spark.createDataFrame([(1,), (None,)], "k int")
    frames = {"m": model, "parent": parent}
    checks = [
        quality.Check("m", "id", "not_null"),
        quality.Check("m", "v", "not_null"),
        quality.Check("m", "id", "unique"),
        quality.Check("m", "v", "accepted_values", "warn", values=("a", "b")),
        quality.Check("m", "p", "relationships", to=("parent", "k")),
        quality.Check("parent", "k", "unique"),
    ]
    report = quality.run_checks(frames.__getitem__, checks)
    assert tuple(report.columns) == quality.REPORT_COLUMNS
    got = {(r.model, r.column_name, r.check_name): (r.failures, r.status) for r in report.collect()}
    assert got == {
        ("m", "id", "not_null"): (2, "fail"),
        ("m", "v", "not_null"): (1, "fail"),
        ("m", "id", "unique"): (1, "fail"),
        ("m", "v", "accepted_values"): (1, "warn"),
        ("m", "p", "relationships"): (2, "fail"),
        ("parent", "k", "unique"): (0, "pass"),
    }


def test_values_without_a_text_of_their_own_are_counted_as_they_are(spark):
    """Both zeros are one value, keys of different types are compared as before, and widths of integers do not matter."""
    rows = [(0.0, 1, "1", True, 7), (-0.0, 2, "x", None, 7), (1.5, None, None, False, None)]
    model = spark.createDataFrame(rows, "d double, small int, code string, flag boolean, k int")
    parent = spark.createDataFrame([(1, "1"), (1, "1"), (7, None)], "k bigint, code string")
    dated = spark.sql("select cast(1 as decimal(10,2)) as amount, timestamp'2026-03-01 00:00:00' as at from range(2)")
    checks = [
        quality.Check("m", "d", "unique"),
        quality.Check("m", "small", "relationships", to=("parent", "k")),
        quality.Check("m", "code", "relationships", "warn", to=("parent", "code")),
        quality.Check("m", "flag", "accepted_values", values=(False,)),
        quality.Check("m", "k", "unique"),
        quality.Check("m", "d", "not_null"),
        quality.Check("dated", "amount", "unique"),
        quality.Check("dated", "at", "unique"),
        quality.Check("dated", "amount", "relationships", to=("parent", "k")),
    ]
    frames = {"m": model, "parent": parent, "dated": dated}
    got = [(r.failures, r.status) for r in quality.run_checks(frames.__getitem__, checks).collect()]
    want = [1, 1, 1, 1, 1, 0, 1, 1, 0]
    assert sorted(got) == sorted((n, "pass" if n == 0 else "warn" if i == 2 else "fail") for i, n in enumerate(want))


def test_no_rows_no_failures(spark):
    empty = spark.createDataFrame([], "id int, p int")
    checks = [
        quality.Check("m", "id", kind, values=(1,), to=("m", "id") if kind == "relationships" else None)
        for kind in ("not_null", "unique", "accepted_values", "relationships")
    ]
    report = quality.run_checks({"m": empty}.__getitem__, checks).collect()
    assert [(r.failures, r.status) for r in report] == [(0, "pass")] * 4


def test_declared_checks_read_each_model_and_each_parent_key_once(spark, tmp_path):
    """A scan for each model and each parent key, and one join for all relationships, though the parents are small."""
    columns: dict = {}
    for check in quality.DECLARED:
        columns.setdefault(check.model, {})[check.column] = check
        if check.to:
            columns.setdefault(check.to[0], {}).setdefault(check.to[1], None)
    frames = {}
    for name, own in columns.items():
        kinds = []
        for column, check in own.items():
            value = check.values[0] if check and check.values else None
            kinds.append(f"cast(null as {'boolean' if isinstance(value, bool) else 'string'}) as {column}")
        path = str(tmp_path / name)
        spark.range(1).selectExpr(*kinds).write.parquet(path)
        frames[name] = spark.read.parquet(path)
    models = {c.model for c in quality.DECLARED}
    parents = {c.to for c in quality.DECLARED if c.to}
    report = quality.run_checks(frames.__getitem__, quality.DECLARED)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(" parquet\n") == len(models) + len(parents)
    assert plan.count("LeftAnti") == 1
    assert len(report.collect()) == len(quality.DECLARED)


def test_ledger_violations(spark, as_rows):
    legs = [
        (1, 10, "Debit", "5.00"), (1, 11, "Credit", "5.00"),
        (2, 10, "Debit", "5.00"),
        (3, 10, "Debit", "5.00"), (3, 11, "Credit", "4.99"),
        (4, 10, "Debit", "1.00"), (4, 11, "Credit", "1.00"),
        (6, 10, "Credit", "2.00"), (6, 11, "Credit", "2.00"),
    ]
    heads = [(1, "Posted", "5"), (2, "Posted", "5"), (3, "Reversed", "5"), (4, "Pending", "1"), (5, "Posted", "1"),
             (6, "Posted", "2"), (7, "Failed", "3")]
    e, t = entries(spark, legs), transactions(spark, heads)
    bad = quality.ledger_balance_violations(t, e)
    assert sorted(r.transaction_id for r in bad.collect()) == [2, 3, 4, 5, 6]
    assert as_rows(quality.posted_without_entries(t, e)) == [(4, "Pending"), (5, "Posted")]
    assert sorted(r.transaction_id for r in quality.unbalanced_transactions(e).collect()) == [2, 3, 6]
    assert as_rows(quality.ledger_sum_nonzero(e)) == [(Decimal("-1.01"),)]
    even = entries(spark, legs[:2])
    assert quality.ledger_sum_nonzero(even).count() == 0


def test_negative_balances_leave_clearing_out(spark, as_rows):
    e = entries(spark, [(1, 1, "Debit", "5.00"), (1, 2, "Debit", "5.00"), (1, 3, "Credit", "5.00")])
    accounts = spark.createDataFrame(
        [(1, "Clearing"), (2, "Checking"), (3, "Business")], "account_id bigint, account_type string"
    )
    assert as_rows(quality.negative_balances(e, accounts)) == [(2, Decimal("-5.00"), "Checking")]


def test_a_null_rule_passes(spark, as_rows):
    spec = TABLES["card"]
    cards = spark.createDataFrame(
        [
            (1, 1, "Debit", "Visa", "0042", 12, 2028, "Active"),
            (2, 1, "Debit", "Amex", "42", 13, 2028, None),
            (3, 1, None, None, None, None, None, None),
        ],
        "card_id bigint, account_id bigint, card_type string, brand string, last4 string, "
        "expiry_month smallint, expiry_year smallint, status string",
    )
    assert as_rows(quality.check_constraints(cards, spec)) == [
        ("card", 2, "brand_known,last4_digits,expiry_month_range")
    ]


def test_flags_are_three_valued(spark):
    rows = spark.createDataFrame(
        [(1, "Posted", "Transfer"), (2, "Reversed", "Transfer"), (3, "Posted", "Reversal"), (4, None, "Transfer")],
        "transaction_id int, status string, transaction_type string",
    )
    flagged = {r.transaction_id: (r.is_reversed, r.is_successful) for r in marts.transaction_flags(rows).collect()}
    assert flagged == {1: (False, True), 2: (True, True), 3: (False, False), 4: (None, None)}
