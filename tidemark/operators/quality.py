"""Declared checks, ledger invariants and row constraints."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    IntegralType,
    StringType,
    TimestampNTZType,
)

from tidemark.operators.joins import keyed_join
from tidemark.plans.marts import SETTLED
from tidemark.sources.registry import TABLES, TableSpec

REPORT_COLUMNS = ("model", "column_name", "check_name", "failures", "severity", "status")


@dataclass(frozen=True)
class Check:
    """One declared check. `values` for accepted_values, `to` for relationships."""

    model: str
    column: str
    kind: str
    severity: str = "error"
    values: tuple = ()
    to: tuple[str, str] | None = None


def _declare(model: str, columns: Mapping[str, Iterable]) -> list[Check]:
    """A column's checks: 'not_null', 'unique', a tuple of values, or 'model.column'; in `{'warn': ...}` a warning."""
    checks = []
    for column, rules in columns.items():
        for rule in rules:
            severity = "error"
            if isinstance(rule, dict):
                severity, rule = "warn", rule["warn"]
            if isinstance(rule, tuple):
                checks.append(Check(model, column, "accepted_values", severity, values=rule))
            elif "." in rule:
                checks.append(Check(model, column, "relationships", severity, to=tuple(rule.split("."))))
            else:
                checks.append(Check(model, column, rule, severity))
    return checks


# --- fixed values: the checks declared on the marts ---
N, U = "not_null", "unique"
DECLARED: tuple[Check, ...] = tuple(
    _declare(
        "dim_customer",
        {
            "customer_id": (N, U, "stg_customer.customer_id"),
            "first_name": (N,),
            "last_name": (N,),
            "email": (N, U),
            "created_at": (N,),
        },
    )
    + _declare(
        "dim_supplier",
        {
            "supplier_id": (N, U, "stg_supplier.supplier_id"),
            "name": (N,),
            "contact_email": (U,),
            "contact_phone": (U,),
            "created_at": (N,),
        },
    )
    + _declare(
        "dim_product",
        {"product_id": (N, U, "stg_product.product_id"), "name": (N,), "unit_price": (N,)},
    )
    + _declare(
        "dim_date",
        {
            "date_key": (N, U),
            "date_day": (N, U),
            "year": (N,),
            "quarter": (N, (1, 2, 3, 4)),
            "month_number": (N, (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12)),
            "month_name": (N,),
            "week_number": (N,),
            "day_of_month": (N,),
            "day_name": (N,),
        },
    )
    + _declare(
        "dim_account",
        {
            "account_id": (N, U),
            "account_number": (N, U),
            "customer_id": ("stg_customer.customer_id",),
            "supplier_id": ("stg_supplier.supplier_id",),
            "account_type": (N, ("Checking", "Savings", "Business", "Operating", "Clearing")),
            "status": (N, ("Active", "Frozen", "Closed")),
            "current_balance": (N,),
        },
    )
    + _declare(
        "dim_card",
        {
            "card_id": (N, U),
            "account_id": (N, "dim_account.account_id"),
            "card_type": (N, ("Credit", "Debit")),
            "brand": (N, ("Visa", "Mastercard")),
            "status": (N, ("Active", "Blocked", "Expired")),
        },
    )
    + _declare(
        "fact_sales",
        {
            "item_id": (N, U),
            "invoice_id": (N, {"warn": "stg_sales_invoice.invoice_id"}),
            "product_id": (N, "stg_product.product_id"),
            "customer_id": (N, "stg_customer.customer_id"),
            "invoice_date_key": (N, "dim_date.date_key"),
            "quantity": (N,),
            "unit_price": (N,),
            "gross_amount": (N,),
            "net_amount": (N,),
            "invoice_status": (N, ("Pending", "Paid", "Cancelled", "Overdue")),
        },
    )
    + _declare(
        "fact_purchases",
        {
            "item_id": (N, U),
            "bill_id": (N, {"warn": "stg_purchase_bill.bill_id"}),
            "product_id": (N, "stg_product.product_id"),
            "supplier_id": (N, "stg_supplier.supplier_id"),
            "bill_date_key": (N, "dim_date.date_key"),
            "quantity": (N,),
            "unit_price": (N,),
            "gross_amount": (N,),
            "paid_amount": (N,),
            "bill_status": (N, ("Pending", "Paid", "Cancelled", "Partially Paid")),
        },
    )
    + _declare(
        "fct_inventory_movements",
        {
            "movement_id": (N, U),
            "product_id": (N, "stg_product.product_id"),
            "movement_date_key": (N, "dim_date.date_key"),
            "movement_type": (N, ("IN", "OUT")),
            "quantity": (N,),
            "signed_quantity": (N,),
        },
    )
    + _declare(
        "fct_transactions",
        {
            "transaction_id": (N, U),
            "transaction_type": (
                N,
                (
                    "Deposit",
                    "Withdrawal",
                    "Transfer",
                    "Card Payment",
                    "Invoice Payment",
                    "Bill Payment",
                    "Reversal",
                ),
            ),
            "status": (N, ("Pending", "Posted", "Failed", "Reversed")),
            "amount": (N,),
            "transaction_date_key": (N, "dim_date.date_key"),
            "card_id": ("dim_card.card_id",),
            "invoice_id": ("stg_sales_invoice.invoice_id",),
            "bill_id": ("stg_purchase_bill.bill_id",),
            "reverses_transaction_id": ("stg_financial_transaction.transaction_id",),
            "from_account_id": ("dim_account.account_id",),
            "to_account_id": ("dim_account.account_id",),
        },
    )
    + _declare(
        "fct_ledger_entries",
        {
            "entry_id": (N, U),
            "transaction_id": (N, "stg_financial_transaction.transaction_id"),
            "account_id": (N, "dim_account.account_id"),
            "entry_date_key": (N, "dim_date.date_key"),
            "direction": (N, ("Debit", "Credit")),
            "signed_amount": (N,),
        },
    )
    + _declare(
        "fct_receivables",
        {
            "invoice_id": (N, U),
            "customer_id": (N, "stg_customer.customer_id"),
            "invoice_date_key": (N, "dim_date.date_key"),
            "is_status_mismatch": ({"warn": (False,)},),
        },
    )
    + _declare(
        "fct_payables",
        {
            "bill_id": (N, U),
            "supplier_id": (N, "stg_supplier.supplier_id"),
            "bill_date_key": (N, "dim_date.date_key"),
            "is_paid_amount_mismatch": ({"warn": (False,)},),
        },
    )
)
# --- end of fixed values ---


def source_checks() -> tuple[Check, ...]:
    """UNIQUE and foreign-key rules of the source tables, as checks on staging."""
    checks = []
    for spec in TABLES.values():
        model = f"stg_{spec.name}"
        checks += [Check(model, c, "unique") for c in (spec.primary_key, *spec.unique)]
        checks += [
            Check(model, c, "relationships", to=(f"stg_{table}", key))
            for c, (table, key) in spec.references.items()
        ]
    return tuple(checks)


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


# Types whose text is equal exactly if the values are. Text of a double or of a zoned timestamp is not.
_PLAIN = (StringType, DateType, BooleanType, DecimalType, TimestampNTZType)


def _as_text(column: Column, kind: DataType) -> Column | None:
    """A value as text that stands for it, or None if the type has no such text."""
    if isinstance(kind, IntegralType):
        return column.cast("bigint").cast("string")
    return column.cast("string") if isinstance(kind, _PLAIN) else None


def _comparable(one: DataType, other: DataType) -> bool:
    return one == other or (isinstance(one, IntegralType) and isinstance(other, IntegralType))


def _fault(check: Check, number: int, text: Column) -> Column:
    """What a row tells a check: the value to be counted, and whether it counts at all."""
    value = F.col(check.column)
    counts = {
        "not_null": lambda: value.isNull(),
        "accepted_values": lambda: value.isNotNull() & ~value.isin(*check.values),
    }.get(check.kind, lambda: value.isNotNull())()
    target = F.lit(".".join(check.to) if check.to else None).cast("string")
    return F.struct(
        F.lit(number).alias("number"), target.alias("parent"), text.alias("value"), counts.alias("counts")
    )


def _native(models: Callable[[str], DataFrame], check: Check) -> DataFrame:
    """(values, rows, repeated) of one check, in the column's own type."""
    value = F.col(check.column)
    model = models(check.model)
    rows = model.where(value.isNotNull())
    if check.kind == "accepted_values":
        rows = rows.where(~value.isin(*check.values))
    counted = rows.groupBy(value.alias("k")).agg(F.count("*").alias("n"))
    if check.kind == "relationships":
        counted = keyed_join(counted, models(check.to[0]).select(F.col(check.to[1]).alias("k")), "k", "left_anti")
    return counted.agg(*_totals())


def _totals() -> list[Column]:
    return [
        F.count("*").alias("values"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count_if(F.col("n") > 1).alias("repeated"),
    ]


_MEASURES = ("values", "rows", "repeated")
# what fails: rows that are null or have no parent, values that are repeated or not in the list
_MEASURE = {"not_null": "rows", "relationships": "rows", "unique": "repeated", "accepted_values": "values"}


def run_checks(models: Callable[[str], DataFrame], checks: Iterable[Check]) -> DataFrame:
    """One report row per check: failures, severity, status pass/warn/fail.

    A not-null check counts rows, a relationship rows without a parent, a unique check values that occur more than once,
    an accepted-values check distinct values outside the list; nulls count in the first only.

    Each model is read once, however many checks it has: a row becomes the few (check, value) pairs that count, all
    models' pairs are counted together, and one anti join against the keys of all parents, each read once, takes the
    values that have a parent away. Values are counted before that join, so a key that very many rows hold is one row in
    it. Checks on doubles and zoned timestamps, or between keys of different types, are counted one by one.
    """
    checks = list(checks)
    types = {name: {f.name: f.dataType for f in models(name).schema} for name in {c.model for c in checks}}
    for check in checks:
        if check.to and check.to[0] not in types:
            types[check.to[0]] = {f.name: f.dataType for f in models(check.to[0]).schema}
    together: dict[str, list[Column]] = {}
    parents: dict[tuple[str, str], None] = {}
    alone: list[tuple[int, Check]] = []
    for number, check in enumerate(checks):
        kind = types[check.model][check.column]
        text = _as_text(F.col(check.column), kind) if check.kind != "not_null" else F.lit(None).cast("string")
        if text is None or (check.to and not _comparable(kind, types[check.to[0]][check.to[1]])):
            alone.append((number, check))
            continue
        together.setdefault(check.model, []).append(_fault(check, number, text))
        if check.to:
            parents[check.to] = None
    parts = []
    if together:
        faults = _union(models(m).select(F.inline(F.array(*pairs))).where("counts") for m, pairs in together.items())
        counted = faults.groupBy("number", "parent", "value").agg(F.count("*").alias("n"))
        if parents:
            keys = _union(
                models(name).select(
                    F.lit(f"{name}.{key}").alias("of"), _as_text(F.col(key), types[name][key]).alias("known")
                )
                for name, key in parents
            )
            # n is in the condition so that the join stays above the count: below, it would be one for each model
            has_parent = (F.col("parent") == F.col("of")) & (F.col("value") == F.col("known")) & (F.col("n") > 0)
            counted = counted.join(keys.hint("merge"), has_parent, "left_anti")
        parts.append(counted.groupBy("number").agg(*_totals()))
    parts += [_native(models, check).select(F.lit(number).alias("number"), *_MEASURES) for number, check in alone]
    declared = [
        F.struct(
            F.lit(number).alias("number"), F.lit(c.model).alias("model"), F.lit(c.column).alias("column_name"),
            F.lit(c.kind).alias("check_name"), F.lit(c.severity).alias("severity"), F.lit(_MEASURE[c.kind]).alias("measure"),
        )
        for number, c in enumerate(checks)
    ]
    spark = models(checks[0].model).sparkSession
    report = spark.range(1).select(F.inline(F.array(*declared))).join(_union(parts), "number", "left")
    measured = F.coalesce(*[F.when(F.col("measure") == m, F.col(m)) for m in _MEASURES], F.lit(0)).cast("bigint")
    status = F.when(measured == 0, "pass").otherwise(F.when(F.col("severity") == "warn", "warn").otherwise("fail"))
    return report.select("model", "column_name", "check_name", measured.alias("failures"), "severity", status.alias("status"))


def ledger_entry_stats(entries: DataFrame) -> DataFrame:
    """Entry and debit counts, and both totals, per transaction."""
    debit, credit = F.col("direction") == "Debit", F.col("direction") == "Credit"
    nothing = F.lit(0).cast("decimal(12,2)")
    return entries.groupBy("transaction_id").agg(
        F.count("*").alias("entry_count"),
        F.count_if(debit).alias("debit_count"),
        F.sum(F.when(debit, F.col("amount")).otherwise(nothing)).alias("debit_total"),
        F.sum(F.when(credit, F.col("amount")).otherwise(nothing)).alias("credit_total"),
    )


def ledger_balance_violations(transactions: DataFrame, entries: DataFrame) -> DataFrame:
    """Settled transactions without exactly one debit and one credit of their amount, and others with entries."""
    joined = keyed_join(transactions, ledger_entry_stats(entries), "transaction_id", "left")
    settled = F.col("status").isin(*SETTLED)
    has_entries = F.col("entry_count").isNotNull()
    wrong = (
        ~has_entries
        | (F.col("entry_count") != 2)
        | (F.col("debit_count") != 1)
        | (F.col("debit_total") != F.col("amount"))
        | (F.col("credit_total") != F.col("amount"))
    )
    return joined.where((settled & wrong) | (~settled & has_entries)).select(
        "transaction_id", "status", "amount", "entry_count", "debit_total", "credit_total"
    )


def ledger_sum_nonzero(entries: DataFrame) -> DataFrame:
    """No row when all entries net to zero, else one with the net total."""
    return entries.agg(F.sum("signed_amount").alias("net_total")).where("net_total <> 0")


def unbalanced_transactions(entries: DataFrame) -> DataFrame:
    """Transactions whose debits differ from their credits, or with fewer than two entries."""
    return ledger_entry_stats(entries).where("debit_total <> credit_total or entry_count < 2")


def posted_without_entries(transactions: DataFrame, entries: DataFrame) -> DataFrame:
    """Transactions for which being settled and having entries disagree."""
    keys = entries.select("transaction_id").distinct().withColumn("entered", F.lit(True))
    settled = F.col("status").isin(*SETTLED)
    return (
        keyed_join(transactions, keys, "transaction_id", "left")
        .where(settled != F.coalesce("entered", F.lit(False)))
        .select("transaction_id", "status")
    )


def negative_balances(entries: DataFrame, accounts: DataFrame) -> DataFrame:
    """Accounts below zero; clearing accounts may be.

    Entries are summed per account before the join, so a busy account is one row in it.
    """
    signed = F.when(F.col("direction") == "Credit", F.col("amount")).otherwise(-F.col("amount"))
    balances = entries.groupBy("account_id").agg(F.sum(signed).alias("balance")).where("balance < 0")
    others = accounts.where("account_type <> 'Clearing'").select("account_id", "account_type")
    return keyed_join(balances, others, "account_id")


def check_constraints(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows that break a rule, with the rules' names; a rule that is null passes."""
    failed = F.array_compact(
        F.array(*[F.when(~F.expr(rule), F.lit(name)) for name, rule in spec.constraints.items()])
    )
    return (
        rows.select(F.lit(spec.name).alias("table_name"), F.col(spec.primary_key).alias("key"), failed.alias("failed"))
        .where(F.size("failed") > 0)
        .withColumn("failed", F.array_join("failed", ","))
    )
