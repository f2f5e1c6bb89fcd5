"""Staging models: the current rows of each source table, typed and cleaned."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import (
    clean,
    clean_lower,
    clean_upper,
    discounted_price,
    signed_amount,
    tax_price,
)
from tidemark.operators.latest import current_typed
from tidemark.sources.registry import TABLES, TableSpec

# Text columns are trimmed; these are also lowered or raised, or left alone.
_LOWERED = {("customer", "email"), ("supplier", "contact_email")}
_RAISED = {
    ("inventory_movement", "movement_type"),
    ("account", "currency"),
    ("financial_transaction", "currency"),
}
_UNTOUCHED = {("card", "last4")}


def _cleaner(table: str, column: str) -> Callable[[str], Column]:
    if (table, column) in _UNTOUCHED:
        return F.col
    if (table, column) in _LOWERED:
        return clean_lower
    return clean_upper if (table, column) in _RAISED else clean


# Computed columns per table: name, the column it follows, and its expression.
_COMPUTED: dict[str, tuple[tuple[str, str, Callable[[], Column]], ...]] = {
    "sales_invoice": (
        ("total_amount_with_tax", "tax_amount", lambda: tax_price("total_sum", "tax_amount")),
    ),
    "sales_invoice_item": (
        (
            "total_price_with_discount",
            "discount",
            lambda: discounted_price(F.col("unit_price") * F.col("quantity"), "discount"),
        ),
    ),
    "purchase_bill": (
        ("total_amount_with_tax", "tax_amount", lambda: tax_price("total_sum", "tax_amount")),
        (
            "outstanding_amount",
            "paid_amount",
            lambda: (F.col("total_amount_with_tax") - F.col("paid_amount")).cast("decimal(10,2)"),
        ),
    ),
    "ledger_entry": (("signed_amount", "amount", lambda: signed_amount("direction", "amount")),),
}


def stage_rows(rows: DataFrame, spec: TableSpec, carried: Sequence[str] = ()) -> DataFrame:
    """Cleaning and computed columns over typed rows of one table; `carried` columns come along."""
    texts = {
        name: _cleaner(spec.name, name)(name) for name, kind in spec.columns.items() if kind == "string"
    }
    staged = rows.withColumns(texts) if texts else rows
    order = list(spec.column_names)
    for name, after, expression in _COMPUTED.get(spec.name, ()):
        staged = staged.withColumn(name, expression())
        order.insert(order.index(after) + 1, name)
    return staged.select(*carried, *order)


def stage(landing: DataFrame, table: str) -> DataFrame:
    """Staging model of one table, straight from landed events."""
    spec = TABLES[table]
    return stage_rows(current_typed(landing, spec), spec)
