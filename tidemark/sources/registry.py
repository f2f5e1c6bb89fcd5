"""The source tables: columns, wire types, keys and row constraints."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import types as T

# Key columns are BIGINT, so tables may grow past 2**31 rows.
_KINDS = {
    "key": T.LongType(),
    "int": T.IntegerType(),
    "smallint": T.ShortType(),
    "string": T.StringType(),
    "timestamp": T.TimestampNTZType(),
    "decimal(10,2)": T.DecimalType(10, 2),
    "decimal(12,2)": T.DecimalType(12, 2),
}

# Event metadata carried next to the row's own columns.
META_FIELDS = (
    T.StructField("__op", T.StringType()),
    T.StructField("__table", T.StringType()),
    T.StructField("__lsn", T.LongType()),
    T.StructField("__source_ts_ms", T.LongType()),
    T.StructField("__deleted", T.StringType()),
)
ARRIVAL = "approximate_arrival_timestamp"


@dataclass(frozen=True)
class TableSpec:
    """One source table. `constraints` maps a rule name to a SQL predicate."""

    name: str
    primary_key: str
    columns: dict[str, str]
    constraints: dict[str, str] = field(default_factory=dict, hash=False)
    unique: tuple[str, ...] = ()
    references: dict[str, tuple[str, str]] = field(default_factory=dict, hash=False)

    @property
    def column_names(self) -> tuple[str, ...]:
        return tuple(self.columns)

    @property
    def all_columns(self) -> tuple[str, ...]:
        """The table's columns and its change stamp."""
        return (*self.columns, "updated_at")

    @property
    def schema(self) -> T.StructType:
        """Types of the table in a typed relation."""
        return T.StructType([T.StructField(c, _KINDS[k]) for c, k in self.columns.items()])

    @property
    def wire_schema(self) -> T.StructType:
        """Types on the wire: decimals are text, timestamps are epoch milliseconds."""

        def wire(kind: str) -> T.DataType:
            if kind == "timestamp":
                return T.LongType()
            return T.StringType() if kind.startswith("decimal") else _KINDS[kind]

        return T.StructType([T.StructField(c, wire(k)) for c, k in self.columns.items()])

    @property
    def landing_schema(self) -> T.StructType:
        """Types of the append-only typed landing table."""
        return T.StructType(
            [
                *self.schema.fields,
                T.StructField("updated_at", T.TimestampNTZType()),
                *META_FIELDS,
                T.StructField("record_metadata", T.VariantType()),
            ]
        )


# --- fixed values: table shapes, enumerations and row rules of the source system ---
_SPECS = (
    TableSpec(
        "customer",
        "customer_id",
        {
            "customer_id": "key",
            "first_name": "string",
            "last_name": "string",
            "email": "string",
            "phone_number": "string",
            "created_at": "timestamp",
        },
        unique=("email", "phone_number"),
    ),
    TableSpec(
        "supplier",
        "supplier_id",
        {
            "supplier_id": "key",
            "name": "string",
            "contact_name": "string",
            "contact_email": "string",
            "contact_phone": "string",
            "created_at": "timestamp",
        },
        unique=("contact_email", "contact_phone"),
    ),
    TableSpec(
        "product",
        "product_id",
        {
            "product_id": "key",
            "name": "string",
            "description": "string",
            "unit_price": "decimal(10,2)",
            "created_at": "timestamp",
        },
    ),
    TableSpec(
        "sales_invoice",
        "invoice_id",
        {
            "invoice_id": "key",
            "customer_id": "key",
            "invoice_date": "timestamp",
            "total_sum": "decimal(10,2)",
            "tax_amount": "decimal(10,2)",
            "status": "string",
            "created_at": "timestamp",
        },
        references={"customer_id": ("customer", "customer_id")},
    ),
    TableSpec(
        "sales_invoice_item",
        "item_id",
        {
            "item_id": "key",
            "invoice_id": "key",
            "product_id": "key",
            "quantity": "int",
            "unit_price": "decimal(10,2)",
            "discount": "decimal(10,2)",
            "created_at": "timestamp",
        },
        constraints={"quantity_positive": "quantity > 0", "unit_price_not_negative": "unit_price >= 0"},
        references={
            "invoice_id": ("sales_invoice", "invoice_id"),
            "product_id": ("product", "product_id"),
        },
    ),
    TableSpec(
        "purchase_bill",
        "bill_id",
        {
            "bill_id": "key",
            "supplier_id": "key",
            "bill_date": "timestamp",
            "total_sum": "decimal(10,2)",
            "tax_amount": "decimal(10,2)",
            "paid_amount": "decimal(10,2)",
            "status": "string",
            "created_at": "timestamp",
        },
        references={"supplier_id": ("supplier", "supplier_id")},
    ),
    TableSpec(
        "purchase_bill_item",
        "item_id",
        {
            "item_id": "key",
            "bill_id": "key",
            "product_id": "key",
            "quantity": "int",
            "unit_price": "decimal(10,2)",
            "created_at": "timestamp",
        },
        constraints={"unit_price_not_negative": "unit_price >= 0"},
        references={
            "bill_id": ("purchase_bill", "bill_id"),
            "product_id": ("product", "product_id"),
        },
    ),
    TableSpec(
        "inventory_movement",
        "movement_id",
        {
            "movement_id": "key",
            "product_id": "key",
            "movement_type": "string",
            "quantity": "int",
            "movement_date": "timestamp",
            "created_at": "timestamp",
        },
        constraints={"movement_type_known": "movement_type in ('IN', 'OUT')"},
        references={"product_id": ("product", "product_id")},
    ),
    TableSpec(
        "account",
        "account_id",
        {
            "account_id": "key",
            "account_number": "string",
            "customer_id": "key",
            "supplier_id": "key",
            "account_type": "string",
            "currency": "string",
            "status": "string",
            "opened_at": "timestamp",
            "created_at": "timestamp",
        },
        constraints={
            "account_type_known": "account_type in ('Checking', 'Savings', 'Business', 'Operating', 'Clearing')",
            "status_known": "status in ('Active', 'Frozen', 'Closed')",
            "single_owner": "customer_id is null or supplier_id is null",
            "internal_type": "(customer_id is null and supplier_id is null) = (account_type in ('Operating', 'Clearing'))",
        },
        unique=("account_number",),
        references={
            "customer_id": ("customer", "customer_id"),
            "supplier_id": ("supplier", "supplier_id"),
        },
    ),
    TableSpec(
        "card",
        "card_id",
        {
            "card_id": "key",
            "account_id": "key",
            "card_type": "string",
            "brand": "string",
            "last4": "string",
            "expiry_month": "smallint",
            "expiry_year": "smallint",
            "status": "string",
            "created_at": "timestamp",
        },
        constraints={
            "card_type_known": "card_type in ('Credit', 'Debit')",
            "brand_known": "brand in ('Visa', 'Mastercard')",
            "last4_digits": "last4 rlike '^[0-9]{4}$'",
            "expiry_month_range": "expiry_month between 1 and 12",
            "status_known": "status in ('Active', 'Blocked', 'Expired')",
        },
        references={"account_id": ("account", "account_id")},
    ),
    TableSpec(
        "financial_transaction",
        "transaction_id",
        {
            "transaction_id": "key",
            "transaction_type": "string",
            "status": "string",
            "amount": "decimal(12,2)",
            "currency": "string",
            "card_id": "key",
            "invoice_id": "key",
            "bill_id": "key",
            "reverses_transaction_id": "key",
            "description": "string",
            "transaction_date": "timestamp",
            "created_at": "timestamp",
        },
        constraints={
            "transaction_type_known": (
                "transaction_type in ('Deposit', 'Withdrawal', 'Transfer', 'Card Payment', "
                "'Invoice Payment', 'Bill Payment', 'Reversal')"
            ),
            "status_known": "status in ('Pending', 'Posted', 'Failed', 'Reversed')",
            "amount_positive": "amount > 0",
            "invoice_rule": "(transaction_type = 'Invoice Payment') = (invoice_id is not null)",
            "bill_rule": "(transaction_type = 'Bill Payment') = (bill_id is not null)",
            "reversal_rule": "(transaction_type = 'Reversal') = (reverses_transaction_id is not null)",
            "card_rule": "transaction_type <> 'Card Payment' or card_id is not null",
        },
        references={
            "card_id": ("card", "card_id"),
            "invoice_id": ("sales_invoice", "invoice_id"),
            "bill_id": ("purchase_bill", "bill_id"),
            "reverses_transaction_id": ("financial_transaction", "transaction_id"),
        },
    ),
    TableSpec(
        "ledger_entry",
        "entry_id",
        {
            "entry_id": "key",
            "transaction_id": "key",
            "account_id": "key",
            "direction": "string",
            "amount": "decimal(12,2)",
            "created_at": "timestamp",
        },
        constraints={
            "direction_known": "direction in ('Debit', 'Credit')",
            "amount_positive": "amount > 0",
        },
        references={
            "transaction_id": ("financial_transaction", "transaction_id"),
            "account_id": ("account", "account_id"),
        },
    ),
)

TABLES: dict[str, TableSpec] = {spec.name: spec for spec in _SPECS}

# The tables that the merge and the window extract cover; the ledger tables come by log replay only.
EXTRACTED = (
    "customer",
    "supplier",
    "product",
    "sales_invoice",
    "sales_invoice_item",
    "purchase_bill",
    "purchase_bill_item",
    "inventory_movement",
)
# --- end of fixed values ---


def select_tables(names: Iterable[str] | None = None) -> list[TableSpec]:
    """The named tables in the order given, each once; all extracted tables by default."""
    if names is None:
        return [TABLES[name] for name in EXTRACTED]
    wanted = list(dict.fromkeys(names))
    unknown = sorted(set(wanted).difference(EXTRACTED))
    if unknown:
        raise ValueError(f"unknown tables {unknown}; choose from {list(EXTRACTED)}")
    return [TABLES[name] for name in wanted]
