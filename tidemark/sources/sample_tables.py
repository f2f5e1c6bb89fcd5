"""The order-entry benchmark tables seen as change logs of the source tables.

The benchmark data has no change log, so each source table's log is derived
from it row by row: no shuffle, one to three events per row. Columns are in
wire types (keys BIGINT, decimals as text, timestamps as epoch milliseconds).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import padded, timestamp_to_epoch_ms
from tidemark.session import constant_rows
from tidemark.sources.landing import parse_landing, to_payload
from tidemark.sources.registry import ARRIVAL, TableSpec

# Order dates run from 1995 to 2001; moved by 26 years they fall inside the date dimension.
SHIFT_DAYS = 9497


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table dealt out evenly: the sample files are one row group each, which one task reads.

    Adaptive execution gives every core a part of a small table, and a large one parts of bounded size, so that what a
    task sorts does not grow with the table.
    """
    return read_table(spark, sf_dir, name).hint("rebalance")


def money(column: str, kind: str = "decimal(10,2)") -> Column:
    """A double money column as a decimal."""
    return F.col(column).cast(kind)


def base_time(key: str) -> Column:
    """A creation time spread over about 69 days by key."""
    return F.expr(f"timestamp_ntz'2024-01-01 00:00:00' + ({key} % 100000) * interval '1' minute")


def _ms(column: Column) -> Column:
    return timestamp_to_epoch_ms(column)


def _shifted_ms(column: str, hours: int = 0) -> Column:
    """A table's time, moved, in epoch milliseconds; moved as a number, since a sum of times goes through the calendar."""
    return _ms(F.col(column)) + F.lit((SHIFT_DAYS * 24 + hours) * 3_600_000)


def _text(column: Column) -> Column:
    return column.cast("string")


def _versions(rows: DataFrame, deleted_when: str | None = None, count: int = 2) -> DataFrame:
    """Each row as versions v = 0 .. count-1, and one more where a condition holds."""
    plain = F.array(*[F.lit(v) for v in range(count)])
    if deleted_when is None:
        versions = plain
    else:
        longer = F.array(*[F.lit(v) for v in range(count + 1)])
        versions = F.when(F.expr(f"coalesce({deleted_when}, false)"), longer).otherwise(plain)
    return rows.withColumn("v", F.explode(versions))


def _meta(table: str, key: str, ops: tuple[str, ...], lsn: Column | None = None) -> list[Column]:
    op = F.element_at(F.array(*[F.lit(o) for o in ops]), F.col("v") + 1)
    lsn = F.col(key) * 4 + F.col("v") if lsn is None else lsn
    return [
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + v * interval '1' hour").alias(ARRIVAL),
        op.alias("__op"),
        F.lit(table).alias("__table"),
        lsn.cast("bigint").alias("__lsn"),
        (F.col(key) * 1000 + F.col("v") * 100).cast("bigint").alias("__source_ts_ms"),
        F.when(op == "d", "true").when(F.col("v") > 0, "false").alias("__deleted"),
    ]


def customer_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot row, a profile update, a delete where the balance is under -900.

    The snapshot rows of one nation have no LSN.
    """
    rows = _versions(_source(spark, sf_dir, "customer"), "c_acctbal < -900")
    lsn = F.expr("case when c_nationkey = 7 and v = 0 then null else c_custkey * 4 + v end")
    return rows.select(
        F.col("c_custkey").alias("customer_id"),
        F.concat(F.lit("  "), "c_mktsegment", F.when(F.col("v") > 0, " v2 ").otherwise("")).alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.concat(F.lit(" "), "c_name", F.lit("@Example.Test ")).alias("email"),
        F.concat(F.lit("+1"), padded("c_custkey", 10)).alias("phone_number"),
        _ms(base_time("c_custkey")).alias("created_at"),
        *_meta("customer", "c_custkey", ("r", "u", "d"), lsn),
    )


def supplier_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _versions(_source(spark, sf_dir, "supplier"))
    return rows.select(
        F.col("s_suppkey").alias("supplier_id"),
        F.concat(F.col("s_name"), F.lit(" ")).alias("name"),
        F.when(F.col("v") > 0, F.concat(F.lit("Contact "), "s_name")).alias("contact_name"),
        F.concat(F.upper("s_name"), F.lit("@SUPPLY.TEST")).alias("contact_email"),
        F.when(F.col("s_nationkey") != 3, F.concat(F.lit("+2"), padded("s_suppkey", 10))).alias("contact_phone"),
        _ms(base_time("s_suppkey")).alias("created_at"),
        *_meta("supplier", "s_suppkey", ("c", "u")),
    )


def product_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later price for large parts; parts of size 50 are deleted."""
    rows = _versions(_source(spark, sf_dir, "part"), "p_size = 50")
    raised = (F.col("v") > 0) & (F.col("p_size") > 25)
    price = money("p_retailprice") + F.when(raised, F.expr("1.00")).otherwise(F.expr("0.00"))
    return rows.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        F.concat(F.lit(" "), "p_brand", F.lit(" "), "p_type").alias("description"),
        _text(price.cast("decimal(10,2)")).alias("unit_price"),
        _ms(base_time("p_partkey")).alias("created_at"),
        *_meta("product", "p_partkey", ("c", "u", "d")),
    )


def sales_invoice_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Created Pending, then the final status; small open low-priority orders are deleted."""
    rows = _versions(
        _source(spark, sf_dir, "orders"),
        "o_orderpriority = '5-LOW' and o_orderstatus = 'P' and o_totalprice < 20000",
    )
    final = F.expr("case o_orderstatus when 'F' then ' Paid' when 'O' then 'Pending' else 'Overdue ' end")
    total = money("o_totalprice")
    return rows.select(
        F.col("o_orderkey").alias("invoice_id"),
        F.col("o_custkey").alias("customer_id"),
        _shifted_ms("o_orderdate", 10).alias("invoice_date"),
        _text(total).alias("total_sum"),
        _text(F.round(total * F.expr("0.20"), 2).cast("decimal(10,2)")).alias("tax_amount"),
        F.when(F.col("v") == 0, "Pending").otherwise(final).alias("status"),
        _shifted_ms("o_orderdate", 11).alias("created_at"),
        *_meta("sales_invoice", "o_orderkey", ("c", "u", "d")),
    )


def _line_key() -> Column:
    """Order and line number as one key; the benchmark repeats some, which gives versions."""
    return F.col("l_orderkey") * 8 + F.col("l_linenumber")


def _line_meta(table: str) -> list[Column]:
    """LSN by ship day, source time by part and supplier, arrival by price: ties at each level."""
    deleted = F.expr("l_returnflag = 'R' and l_discount >= 0.095")
    return [
        F.expr(
            "timestamp_ntz'2024-01-01 00:00:00' + cast(l_extendedprice * 100 as bigint) * interval '0.01' second"
        ).alias(ARRIVAL),
        F.when(deleted, "d").otherwise(F.expr("if(l_linestatus = 'F', 'u', 'c')")).alias("__op"),
        F.lit(table).alias("__table"),
        F.datediff("l_shipdate", F.lit("1990-01-01").cast("date")).cast("bigint").alias("__lsn"),
        (F.col("l_partkey") * 1000000 + F.col("l_suppkey")).alias("__source_ts_ms"),
        F.when(deleted, "true").otherwise("false").alias("__deleted"),
    ]




def sales_invoice_item_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _source(spark, sf_dir, "lineitem")
    percent = (money("l_discount") * 100).cast("decimal(10,2)")
    return rows.select(
        _line_key().alias("item_id"),
        F.col("l_orderkey").alias("invoice_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        _text(money("l_extendedprice")).alias("unit_price"),
        F.when(percent > 0, _text(percent)).alias("discount"),
        _shifted_ms("l_shipdate").alias("created_at"),
        *_line_meta("sales_invoice_item"),
    )


def purchase_bill_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bill per order at 60 % of its price, first unpaid, then in its final state."""
    rows = _versions(_source(spark, sf_dir, "orders"))
    total = (money("o_totalprice") * F.expr("0.60")).cast("decimal(10,2)")
    tax = F.round(total * F.expr("0.20"), 2).cast("decimal(10,2)")
    paid = (
        F.when(F.col("v") == 0, F.expr("0.00").cast("decimal(10,2)"))
        .when(F.col("o_orderstatus") == "F", (total + tax).cast("decimal(10,2)"))
        .when(F.col("o_orderstatus") == "O", (total * F.expr("0.60")).cast("decimal(10,2)"))
        .when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.expr("0.00").cast("decimal(10,2)"))
    )
    final = F.expr("case o_orderstatus when 'F' then 'Paid' when 'O' then 'Partially Paid' else 'Pending' end")
    return rows.select(
        F.col("o_orderkey").alias("bill_id"),
        (F.col("o_custkey") % 100).alias("supplier_id"),
        _shifted_ms("o_orderdate", 8).alias("bill_date"),
        _text(total).alias("total_sum"),
        _text(tax).alias("tax_amount"),
        _text(paid).alias("paid_amount"),
        F.when(F.col("v") == 0, "Pending").otherwise(final).alias("status"),
        _shifted_ms("o_orderdate", 9).alias("created_at"),
        *_meta("purchase_bill", "o_orderkey", ("c", "u")),
    )


def purchase_bill_item_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _source(spark, sf_dir, "lineitem")
    return rows.select(
        _line_key().alias("item_id"),
        F.col("l_orderkey").alias("bill_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        _text((money("l_extendedprice") * F.expr("0.62")).cast("decimal(10,2)")).alias("unit_price"),
        _shifted_ms("l_shipdate").alias("created_at"),
        *_line_meta("purchase_bill_item"),
    )


def inventory_movement_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned lines go in, accepted lines go out, the rest are of another type."""
    rows = _source(spark, sf_dir, "lineitem")
    kind = F.expr("case l_returnflag when 'R' then ' in' when 'A' then 'Out ' else 'adjust' end")
    return rows.select(
        _line_key().alias("movement_id"),
        F.col("l_partkey").alias("product_id"),
        kind.alias("movement_type"),
        F.col("l_quantity").cast("int").alias("quantity"),
        _shifted_ms("l_shipdate", 2).alias("movement_date"),
        _shifted_ms("l_shipdate", 3).alias("created_at"),
        *_line_meta("inventory_movement"),
    )


OPERATING, CLEARING = -2, -4


def account_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Checking account per customer, a Business account per supplier, two internal ones."""
    null_key = F.lit(None).cast("bigint")
    owners = (
        _source(spark, sf_dir, "customer")
        .select(
            (F.col("c_custkey") * 2).alias("id"),
            F.col("c_custkey").alias("customer_id"),
            null_key.alias("supplier_id"),
            F.lit("Checking").alias("account_type"),
            F.col("c_acctbal").alias("balance"),
        )
        .unionByName(
            _source(spark, sf_dir, "supplier").select(
                (F.col("s_suppkey") * 2 + 1).alias("id"),
                null_key.alias("customer_id"),
                F.col("s_suppkey").alias("supplier_id"),
                F.lit("Business").alias("account_type"),
                F.col("s_acctbal").alias("balance"),
            )
        )
        .unionByName(
            constant_rows(
                spark,
                [(OPERATING, None, None, "Operating", 0.0), (CLEARING, None, None, "Clearing", 0.0)],
                "id bigint, customer_id bigint, supplier_id bigint, account_type string, balance double",
            )
        )
    )
    rows = _versions(owners)
    opened = _ms(F.expr("timestamp_ntz'2024-01-01 00:00:00' + (abs(id) % 100000) * interval '1' minute"))
    return rows.select(
        F.col("id").alias("account_id"),
        F.concat(F.lit("ACC-"), padded("id", 8)).alias("account_number"),
        "customer_id",
        "supplier_id",
        "account_type",
        F.lit("eur").alias("currency"),
        F.when((F.col("v") > 0) & (F.col("balance") < 0), "Frozen").otherwise("Active").alias("status"),
        opened.alias("opened_at"),
        opened.alias("created_at"),
        *_meta("account", "id", ("c", "u")),
    )


def card_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One card per customer; blocked later when the balance is under 100, deleted under -950."""
    rows = _versions(_source(spark, sf_dir, "customer"), "c_acctbal < -950")
    return rows.select(
        F.col("c_custkey").alias("card_id"),
        (F.col("c_custkey") * 2).alias("account_id"),
        F.expr("if(c_nationkey < 5, 'Credit', 'Debit')").alias("card_type"),
        F.expr("if(c_custkey % 2 = 0, 'Mastercard', 'Visa')").alias("brand"),
        padded(F.col("c_custkey") % 10000, 4).alias("last4"),
        (F.col("c_custkey") % 12 + 1).cast("int").alias("expiry_month"),
        (F.col("c_custkey") % 5 + 2026).cast("int").alias("expiry_year"),
        F.when((F.col("v") > 0) & (F.col("c_acctbal") < 100), "Blocked").otherwise("Active").alias("status"),
        _ms(base_time("c_custkey") + F.expr("interval '1' day")).alias("created_at"),
        *_meta("card", "c_custkey", ("c", "u", "d")),
    )


# Order priority to transaction type, and order status to transaction status.
_TXN_TYPE = (
    "case o_orderpriority when '1-URGENT' then 'Invoice Payment' when '2-HIGH' then 'Bill Payment' "
    "when '3-MEDIUM' then 'Card Payment' when '4-NOT SPECIFIED' then 'Transfer' else 'Deposit' end"
)
_REVERSED = "o_orderpriority = '3-MEDIUM' and o_orderstatus = 'F' and o_totalprice > 400000"


def _txn_amount() -> Column:
    """Invoices are paid with tax; other transactions move the order's price."""
    total = money("o_totalprice", "decimal(12,2)")
    tax = F.round(money("o_totalprice") * F.expr("0.20"), 2).cast("decimal(12,2)")
    with_tax = (total + tax).cast("decimal(12,2)")
    return F.when(F.col("o_orderpriority") == "1-URGENT", with_tax).otherwise(total)


def _transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transaction per order, and a reversal (`part = 1`) of some card payments."""
    parts = F.when(F.expr(_REVERSED), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        _source(spark, sf_dir, "orders")
        .select(
            "o_orderkey",
            "o_custkey",
            "o_orderstatus",
            "o_totalprice",
            F.expr(_TXN_TYPE).alias("kind"),
            F.expr(_REVERSED).alias("reversed"),
            _shifted_ms("o_orderdate", 12).alias("at"),
            _txn_amount().alias("amount"),
            F.explode(parts).alias("part"),
        )
        .withColumn("id", F.col("o_orderkey") * 2 + F.col("part"))
    )


def financial_transaction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _versions(_transactions(spark, sf_dir))
    original = F.col("part") == 0
    final = F.expr(
        "case when reversed and part = 0 then 'Reversed' when o_orderstatus = 'F' then 'Posted' "
        "when o_orderstatus = 'P' then 'Pending' else 'Failed' end"
    )
    kind = F.when(original, F.col("kind")).otherwise("Reversal")
    return rows.select(
        F.col("id").alias("transaction_id"),
        kind.alias("transaction_type"),
        F.when((F.col("v") == 0) & original, "Pending").otherwise(final).alias("status"),
        _text(F.col("amount")).alias("amount"),
        F.lit("eur").alias("currency"),
        F.when(kind == "Card Payment", F.col("o_custkey")).alias("card_id"),
        F.when(kind == "Invoice Payment", F.col("o_orderkey")).alias("invoice_id"),
        F.when(kind == "Bill Payment", F.col("o_orderkey")).alias("bill_id"),
        F.when(~original, F.col("o_orderkey") * 2).alias("reverses_transaction_id"),
        F.concat(F.lit(" Order "), F.col("o_orderkey").cast("string")).alias("description"),
        F.col("at").alias("transaction_date"),
        F.col("at").alias("created_at"),
        *_meta("financial_transaction", "id", ("c", "u")),
    )


def ledger_entry_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Debit and Credit of each settled transaction; reversals swap the accounts.

    So that the ledger checks find something: the credit is missing above 490,000
    and one cent short above 480,000, settled transactions under 2,000 have no
    entries, and pending ones above 499,000 have some.
    """
    legs = F.explode(F.array(F.lit(0), F.lit(1))).alias("leg")
    entered = "(o_orderstatus = 'F' and o_totalprice >= 2000) or (o_orderstatus = 'P' and o_totalprice > 499000)"
    settled = _transactions(spark, sf_dir).where(entered).select("*", legs)
    customer = F.col("o_custkey") * 2
    other = F.expr(f"case when kind = 'Deposit' then {CLEARING} else {OPERATING} end").cast("bigint")
    outgoing = (F.col("leg") == 0) == (F.col("part") == 0)
    short = (F.col("leg") == 1) & (F.col("o_totalprice") > 480000)
    amount = F.col("amount") - F.when(short, F.expr("0.01")).otherwise(F.expr("0.00"))
    rows = settled.where("not (leg = 1 and o_totalprice > 490000)").withColumn("v", F.lit(0))
    return rows.withColumn("entry", F.col("id") * 2 + F.col("leg")).select(
        F.col("entry").alias("entry_id"),
        F.col("id").alias("transaction_id"),
        F.when(outgoing, customer).otherwise(other).alias("account_id"),
        F.expr("if(leg = 0, 'Debit', ' Credit')").alias("direction"),
        _text(amount.cast("decimal(12,2)")).alias("amount"),
        F.col("at").alias("created_at"),
        *_meta("ledger_entry", "entry", ("c",)),
    )


LOGS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "customer": customer_log,
    "supplier": supplier_log,
    "product": product_log,
    "sales_invoice": sales_invoice_log,
    "sales_invoice_item": sales_invoice_item_log,
    "purchase_bill": purchase_bill_log,
    "purchase_bill_item": purchase_bill_item_log,
    "inventory_movement": inventory_movement_log,
    "account": account_log,
    "card": card_log,
    "financial_transaction": financial_transaction_log,
    "ledger_entry": ledger_entry_log,
}


def landing_of(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One table's log as landed events: written as JSON text and parsed again."""
    return parse_landing(to_payload(LOGS[table](spark, sf_dir)))


def user_event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as a flat change log keyed by user.

    High-value views have no LSN and high-value purchases no operation.
    """
    op = F.expr(
        "case when event_type = 'signup' then 'c' when event_type = 'error' then 'd' "
        "when event_type = 'purchase' and value >= 250 then null else 'u' end"
    )
    return read_table(spark, sf_dir, "events").select(
        "user_id",
        "event_id",
        "event_type",
        money("value", "decimal(12,2)").alias("value"),
        "ts",
        op.alias("__op"),
        F.lit("user_event").alias("__table"),
        F.expr("case when event_type = 'view' and value >= 250 then null else event_id end").alias("__lsn"),
        _ms(F.col("ts")).alias("__source_ts_ms"),
        F.expr("case event_type when 'signup' then null when 'error' then 'true' else 'false' end").alias("__deleted"),
        F.col("ts").alias(ARRIVAL),
    )


USER_EVENT = TableSpec(
    "user_event",
    "user_id",
    {
        "user_id": "key",
        "event_id": "key",
        "event_type": "string",
        "value": "decimal(12,2)",
        "ts": "timestamp",
    },
)


def user_event_wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same log in wire types."""
    return user_event_log(spark, sf_dir).withColumns({"value": _text(F.col("value")), "ts": _ms(F.col("ts"))})


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as stream text: large errors are cut short, large clicks are heartbeats."""
    wire = user_event_wire(spark, sf_dir)
    fields = [F.col(c) for c in wire.columns if c != ARRIVAL]
    body = F.to_json(F.struct(*fields))
    large = F.col("value").cast("decimal(12,2)") >= 100
    heartbeat = F.to_json(F.struct(F.col("ts").alias("ts_ms")))
    text = (
        F.when((F.col("event_type") == "error") & large, F.expr("substring(body, 1, length(body) - 1)"))
        .when((F.col("event_type") == "click") & large, heartbeat)
        .otherwise(F.col("body"))
    )
    return wire.withColumn("body", body).select(ARRIVAL, text.alias("value"))


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as nested change events: deletes have a before image, the rest an after image."""
    wire = user_event_wire(spark, sf_dir)
    image = F.struct(*[F.col(c) for c in USER_EVENT.column_names])
    is_delete = F.coalesce(F.col("__op") == "d", F.lit(False))
    event = F.struct(
        F.when(is_delete, image).alias("before"),
        F.when(~is_delete, image).alias("after"),
        F.col("__op").alias("op"),
        F.col("__source_ts_ms").alias("ts_ms"),
        F.struct(
            F.col("__table").alias("table"), F.col("__lsn").alias("lsn"), F.col("__source_ts_ms").alias("ts_ms")
        ).alias("source"),
    )
    return wire.select(ARRIVAL, F.to_json(event).alias("value"))


def connector_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as connector status JSON, one connector per event with 0 to 3 tasks."""
    failed = F.col("event_type") == "error"
    trace = F.concat(
        F.lit("  Error: value "), money("value", "decimal(12,2)").cast("string"),
        F.when(F.col("value") > 50, F.repeat(F.lit("x"), 600)).otherwise(""), F.lit("\n\tat a.b"),
    )
    state = F.when(F.col("event_type") == "view", "paused").otherwise("running")
    task = lambda i: F.struct(
        i.alias("id"),
        F.when(failed & (i == 0), "FAILED").otherwise(state).alias("state"),
        F.when(failed & (i == 0), trace).alias("trace"),
    )
    count = (F.col("event_id") % 4).cast("int")
    tasks = F.transform(F.sequence(F.lit(0), count - 1), task)
    none = F.array().cast("array<struct<id: int, state: string, trace: string>>")
    report = F.struct(
        F.struct(state.alias("state")).alias("connector"), F.when(count > 0, tasks).otherwise(none).alias("tasks")
    )
    return read_table(spark, sf_dir, "events").select(
        F.concat(F.lit("connector-"), F.col("event_id").cast("string")).alias("name"),
        F.when(F.col("value") < 2, F.lit(None)).when(F.col("value") < 3, "[]").otherwise(F.to_json(report)).alias("status_json"),
    )


def replication_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as replication slots."""
    return read_table(spark, sf_dir, "events").select(
        F.concat(F.lit("slot-"), F.col("event_id").cast("string")).alias("name"),
        F.when(F.col("value") >= 3, F.col("event_type") != "error").alias("active"),
        F.expr("case when event_type = 'view' and value < 1 then null else value * 10000 end").alias("lag"),
    )


def check_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as health-check observations, one run per day."""
    return read_table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.concat(F.lit("run-"), F.date_format("ts", "yyyy-MM-dd")).alias("run_id"),
        F.col("ts").alias("checked_at"),
        F.expr(
            "case event_type when 'error' then 'connector_status' when 'view' then 'replication_slot_lag' "
            "when 'click' then 'row_count' when 'purchase' then 'table_freshness' "
            "else 'kafka_connect_reachable' end"
        ).alias("check_name"),
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("subject"),
        F.expr(
            "case when value >= 100 then 'fail' when value >= 50 then 'warn' else 'ok' end"
        ).alias("status"),
        F.expr("case when event_type = 'view' and value < 1 then null else value end").alias("value"),
        F.col("props").alias("detail"),
    )


def metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as metric samples of two streams, by user, scaled to come near the alarm limits."""
    events = _source(spark, sf_dir, "events")
    names = F.expr(
        "case event_type when 'signup' then array('OldestReplicationSlotLag', 'FreeStorageSpace') "
        "when 'purchase' then array('GetRecords.IteratorAgeMilliseconds', 'UsageLimitConsumed') "
        "when 'click' then array('IncomingRecords') "
        "when 'error' then array('WriteProvisionedThroughputExceeded') else array('GetRecords.Success') end"
    )
    scale = F.expr(
        "case metric when 'IncomingRecords' then 0.02 when 'WriteProvisionedThroughputExceeded' then 1 "
        "when 'GetRecords.IteratorAgeMilliseconds' then 500000 when 'OldestReplicationSlotLag' then 50000000 "
        "when 'FreeStorageSpace' then 200000000 when 'UsageLimitConsumed' then 0.1 else 1 end"
    ).cast("double")
    subject = F.when(F.col("user_id") % 3 == 0, "replica").otherwise("stream").alias("subject")
    return events.select("ts", "value", subject, F.explode(names).alias("metric")).select(
        "metric", "subject", "ts", (F.col("value") * scale).alias("value")
    )
