"""Intermediate and mart models over staging DataFrames.

Aggregates are taken before the joins, so each join has one side that is
unique per key; partial aggregation keeps hot keys from crossing the shuffle
more than once per task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import date_key, signed_quantity
from tidemark.operators.joins import hot_key_join, keyed_join

# --- fixed values: bounds of the date dimension (the end is exclusive) and settled statuses ---
SPINE_START = dt.date(2020, 1, 1)
SPINE_END = dt.date(2031, 1, 1)
SETTLED = ("Posted", "Reversed")
# --- end of fixed values ---


def int_account_balance(stg_ledger_entry: DataFrame) -> DataFrame:
    return stg_ledger_entry.groupBy("account_id").agg(F.sum("signed_amount").alias("balance"))


def int_inventory_balance(stg_inventory_movement: DataFrame) -> DataFrame:
    """Signed by the movement type as stored, which staging has already raised and trimmed."""
    moved = signed_quantity("movement_type", "quantity")
    return stg_inventory_movement.groupBy("product_id").agg(F.sum(moved).alias("balance_quantity"))


def dim_product(stg_product: DataFrame, inventory_balance: DataFrame) -> DataFrame:
    """Products without movements keep a null balance."""
    return keyed_join(stg_product, inventory_balance, "product_id", "left").select(
        "product_id", "name", "description", "unit_price", "balance_quantity"
    )


def dim_account(stg_account: DataFrame, account_balance: DataFrame) -> DataFrame:
    """Accounts without entries have balance 0."""
    joined = keyed_join(stg_account, account_balance, "account_id", "left")
    balance = F.coalesce("balance", F.lit(0).cast("decimal(12,2)"))
    return joined.select(*stg_account.columns, balance.alias("current_balance"))


def date_spine(spark: SparkSession, start: dt.date, end_exclusive: dt.date) -> DataFrame:
    """One row per day, the end day left out."""
    last = end_exclusive - dt.timedelta(days=1)
    days = F.explode(F.sequence(F.lit(start), F.lit(last), F.expr("interval 1 day")))
    return spark.range(0, 1, 1, 1).select(days.alias("date_day"))


def dim_date(spark: SparkSession, start: dt.date = SPINE_START, end_exclusive: dt.date = SPINE_END) -> DataFrame:
    day = F.col("date_day")
    return date_spine(spark, start, end_exclusive).select(
        date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).alias("week_number"),
        F.dayofmonth(day).alias("day_of_month"),
        F.date_format(day, "E").alias("day_name"),
    )


def fact_sales(stg_sales_invoice_item: DataFrame, stg_sales_invoice: DataFrame) -> DataFrame:
    header = stg_sales_invoice.select(
        "invoice_id", "customer_id", "invoice_date", F.col("status").alias("invoice_status")
    )
    gross = F.col("quantity") * F.col("unit_price")
    return hot_key_join(stg_sales_invoice_item, header, "invoice_id").select(
        "item_id",
        "invoice_id",
        "product_id",
        "customer_id",
        date_key("invoice_date").alias("invoice_date_key"),
        "quantity",
        "unit_price",
        F.col("discount").alias("discount_percentage"),
        gross.alias("gross_amount"),
        (gross - F.col("total_price_with_discount")).alias("discount_amount"),
        F.col("total_price_with_discount").alias("net_amount"),
        "invoice_status",
    )


def fact_purchases(stg_purchase_bill_item: DataFrame, stg_purchase_bill: DataFrame) -> DataFrame:
    """The bill's paid amount repeats on each line; do not sum it."""
    header = stg_purchase_bill.select(
        "bill_id", "supplier_id", "bill_date", "paid_amount", F.col("status").alias("bill_status")
    )
    return hot_key_join(stg_purchase_bill_item, header, "bill_id").select(
        "item_id",
        "bill_id",
        "product_id",
        "supplier_id",
        date_key("bill_date").alias("bill_date_key"),
        "quantity",
        "unit_price",
        (F.col("quantity") * F.col("unit_price")).alias("gross_amount"),
        "paid_amount",
        "bill_status",
    )


def fct_inventory_movements(stg_inventory_movement: DataFrame) -> DataFrame:
    return stg_inventory_movement.select(
        "movement_id",
        "product_id",
        date_key("movement_date").alias("movement_date_key"),
        "movement_type",
        "quantity",
        signed_quantity("movement_type", "quantity").alias("signed_quantity"),
    )


def fct_ledger_entries(stg_ledger_entry: DataFrame) -> DataFrame:
    return stg_ledger_entry.select(
        "entry_id",
        "transaction_id",
        "account_id",
        date_key("created_at").alias("entry_date_key"),
        "direction",
        "amount",
        "signed_amount",
    )


def ledger_legs_pivot(stg_ledger_entry: DataFrame) -> DataFrame:
    """The account each transaction takes from and the one it gives to."""

    def account_of(direction: str) -> Column:
        return F.max(F.when(F.col("direction") == direction, F.col("account_id")))

    return stg_ledger_entry.groupBy("transaction_id").agg(
        account_of("Debit").alias("from_account_id"), account_of("Credit").alias("to_account_id")
    )


def transaction_flags(stg_financial_transaction: DataFrame) -> DataFrame:
    """Adds `is_reversed` and `is_successful`; a null status gives null flags."""
    status, kind = F.col("status"), F.col("transaction_type")
    return stg_financial_transaction.withColumns(
        {
            "is_reversed": status == "Reversed",
            "is_successful": status.isin(*SETTLED) & (kind != "Reversal"),
        }
    )


def fct_transactions(stg_financial_transaction: DataFrame, stg_ledger_entry: DataFrame) -> DataFrame:
    legs = ledger_legs_pivot(stg_ledger_entry)
    return keyed_join(transaction_flags(stg_financial_transaction), legs, "transaction_id", "left").select(
        "transaction_id",
        "transaction_type",
        "status",
        "amount",
        "currency",
        date_key("transaction_date").alias("transaction_date_key"),
        "transaction_date",
        "card_id",
        "invoice_id",
        "bill_id",
        "reverses_transaction_id",
        "from_account_id",
        "to_account_id",
        "is_reversed",
        "is_successful",
    )


def payments_posted(stg_financial_transaction: DataFrame, kind: str, document: str, total: str) -> DataFrame:
    """Posted payments per document; reversed ones drop out with their status."""
    posted = (F.col("transaction_type") == kind) & (F.col("status") == "Posted")
    return stg_financial_transaction.where(posted).groupBy(document).agg(F.sum("amount").alias(total))


def fct_receivables(stg_sales_invoice: DataFrame, stg_financial_transaction: DataFrame) -> DataFrame:
    payments = payments_posted(stg_financial_transaction, "Invoice Payment", "invoice_id", "paid")
    due, paid, status = F.col("amount_due"), F.col("amount_paid"), F.col("invoice_status")
    mismatch = (
        F.when((status == "Paid") & (paid < due), True)
        .when((status != "Paid") & (paid >= due), True)
        .otherwise(False)
    )
    return (
        keyed_join(stg_sales_invoice, payments, "invoice_id", "left")
        .select(
            "invoice_id",
            "customer_id",
            date_key("invoice_date").alias("invoice_date_key"),
            F.col("status").alias("invoice_status"),
            F.col("total_amount_with_tax").alias("amount_due"),
            F.coalesce("paid", F.lit(0).cast("decimal(12,2)")).alias("amount_paid"),
        )
        .withColumns({"outstanding_amount": due - paid, "is_status_mismatch": mismatch})
    )


def fct_payables(stg_purchase_bill: DataFrame, stg_financial_transaction: DataFrame) -> DataFrame:
    payments = payments_posted(stg_financial_transaction, "Bill Payment", "bill_id", "paid")
    recorded = F.coalesce("recorded_paid_amount", F.lit(0).cast("decimal(10,2)"))
    return (
        keyed_join(stg_purchase_bill, payments, "bill_id", "left")
        .select(
            "bill_id",
            "supplier_id",
            date_key("bill_date").alias("bill_date_key"),
            F.col("status").alias("bill_status"),
            F.col("total_amount_with_tax").alias("amount_due"),
            F.col("paid_amount").alias("recorded_paid_amount"),
            F.coalesce("paid", F.lit(0).cast("decimal(12,2)")).alias("ledger_paid_amount"),
        )
        .withColumns(
            {
                "outstanding_amount": F.col("amount_due") - F.col("ledger_paid_amount"),
                "is_paid_amount_mismatch": recorded != F.col("ledger_paid_amount"),
            }
        )
    )


def sales_by_month(sales: DataFrame, dates: DataFrame) -> DataFrame:
    """Net sales per month, looked up in the date dimension.

    Sales are summed per day first; the dimension has a fixed number of days,
    so it is safe to broadcast.
    """
    per_day = sales.groupBy(F.col("invoice_date_key").alias("date_key")).agg(
        F.sum("net_amount").alias("net"), F.count("*").alias("n")
    )
    months = dates.select("date_key", "year", "month_number", "month_name")
    return (
        per_day.join(F.broadcast(months), "date_key")
        .groupBy("year", "month_number", "month_name")
        .agg(F.sum("net").alias("net_amount"), F.sum("n").alias("line_count"))
    )


def kpi_failure_rate(transactions: DataFrame) -> DataFrame:
    """Failed over all that are no longer pending."""
    failed = F.count_if(F.col("status") == "Failed")
    decided = F.count_if(F.col("status") != "Pending")
    return transactions.agg(
        failed.alias("failed"),
        decided.alias("decided"),
        F.when(decided > 0, failed / decided).alias("failure_rate"),
    )


def kpi_net_activity(transactions: DataFrame) -> DataFrame:
    """Posted amounts by type; reversed originals and their reversals cancel out and are left out."""
    counted = (F.col("status") == "Posted") & (F.col("transaction_type") != "Reversal")
    return transactions.where(counted).groupBy("transaction_type").agg(
        F.sum("amount").alias("net_amount"), F.count("*").alias("transaction_count")
    )


def kpi_card_spend(transactions: DataFrame) -> DataFrame:
    """Posted card payments per card."""
    spent = (F.col("status") == "Posted") & (F.col("transaction_type") == "Card Payment")
    return transactions.where(spent).groupBy("card_id").agg(
        F.sum("amount").alias("card_spend"), F.count("*").alias("payment_count")
    )


def reversal_links(transactions: DataFrame) -> DataFrame:
    """Each reversal with the transaction it undoes."""
    reversals = transactions.where("reverses_transaction_id is not null").select(
        F.col("transaction_id").alias("reversal_id"),
        F.col("reverses_transaction_id").alias("transaction_id"),
        F.col("amount").alias("reversal_amount"),
    )
    return hot_key_join(reversals, transactions, "transaction_id", "left").select(
        "reversal_id",
        F.col("transaction_id").alias("original_id"),
        F.col("status").alias("original_status"),
        (F.col("reversal_amount") == F.col("amount")).alias("amounts_match"),
    )
