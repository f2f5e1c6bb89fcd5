"""Equivalent SQL of the registered queries, over the same tables.

`CTES` holds named building blocks; `compose` prefixes a query with those it
uses. The SQL works on typed columns directly and never sees the event text,
so it also checks that nothing is lost on the way through the landing.
"""

from __future__ import annotations

import re

from tidemark.operators.quality import DECLARED, Check, source_checks
from tidemark.plans.models import MARTS
from tidemark.sources.registry import TABLES, TableSpec

SHIFT = "to_days(9497)"


def _state(log: str, key: str) -> str:
    """Newest row per key by log replay, deletes dropped."""
    return (
        f"select * from (select * from {log} qualify row_number() over (partition by {key} order by "
        f"__lsn desc nulls first, __source_ts_ms desc nulls first, arrival desc nulls first) = 1) "
        f"where coalesce(__deleted, 'false') <> 'true'"
    )


def _versions(table: str, condition: str | None = None, count: int = 2) -> str:
    short = str(list(range(count)))
    if condition is None:
        return f"(select *, unnest({short}) as v from {table})"
    longer = str(list(range(count + 1)))
    return f"(select *, unnest(case when {condition} then {longer} else {short} end) as v from {table})"


def _meta(key: str, ops: str, lsn: str | None = None) -> str:
    return f"""
        timestamp '2024-01-01' + to_hours(v) as arrival, {ops}[v + 1] as __op,
        {lsn or f'{key} * 4 + v'} as __lsn, {key} * 1000 + v * 100 as __source_ts_ms,
        case when {ops}[v + 1] = 'd' then 'true' when v > 0 then 'false' end as __deleted"""


_LINE_META = """
    timestamp '2024-01-01' + to_microseconds(cast(l_extendedprice * 100 as bigint) * 10000) as arrival,
    case when l_returnflag = 'R' and l_discount >= 0.095 then 'd' when l_linestatus = 'F' then 'u' else 'c' end as __op,
    date_diff('day', date '1990-01-01', l_shipdate::date) as __lsn,
    l_partkey * 1000000 + l_suppkey as __source_ts_ms,
    case when l_returnflag = 'R' and l_discount >= 0.095 then 'true' else 'false' end as __deleted"""

_LINE_KEY = "l_orderkey * 8 + l_linenumber"


def _base_time(key: str) -> str:
    return f"timestamp '2024-01-01' + to_minutes({key} % 100000)"


def date_key(column: str) -> str:
    return f"cast(strftime({column}, '%Y%m%d') as integer)"


def signed_quantity() -> str:
    return "case movement_type when 'IN' then quantity when 'OUT' then -quantity else 0 end"


CTES: dict[str, str] = {
    # --- change logs of the source tables ---
    "log_customer": f"""
        select c_custkey as customer_id,
               '  ' || c_mktsegment || case when v > 0 then ' v2 ' else '' end as first_name,
               c_name as last_name, ' ' || c_name || '@Example.Test ' as email,
               '+1' || lpad(c_custkey::varchar, 10, '0') as phone_number,
               {_base_time('c_custkey')} as created_at, {_meta('c_custkey', "['r','u','d']",
               'case when c_nationkey = 7 and v = 0 then null else c_custkey * 4 + v end')}
        from {_versions('customer', 'c_acctbal < -900')}""",
    "log_supplier": f"""
        select s_suppkey as supplier_id, s_name || ' ' as name,
               case when v > 0 then 'Contact ' || s_name end as contact_name,
               upper(s_name) || '@SUPPLY.TEST' as contact_email,
               case when s_nationkey <> 3 then '+2' || lpad(s_suppkey::varchar, 10, '0') end as contact_phone,
               {_base_time('s_suppkey')} as created_at, {_meta('s_suppkey', "['c','u']")}
        from {_versions('supplier')}""",
    "log_product": f"""
        select p_partkey as product_id, p_name as name, ' ' || p_brand || ' ' || p_type as description,
               (p_retailprice::decimal(10,2) + case when v > 0 and p_size > 25 then 1.00 else 0.00 end)::decimal(10,2) as unit_price,
               {_base_time('p_partkey')} as created_at, {_meta('p_partkey', "['c','u','d']")}
        from {_versions('part', 'p_size = 50')}""",
    "log_sales_invoice": f"""
        select o_orderkey as invoice_id, o_custkey as customer_id,
               o_orderdate + {SHIFT} + to_hours(10) as invoice_date,
               o_totalprice::decimal(10,2) as total_sum,
               round(o_totalprice::decimal(10,2) * 0.20, 2)::decimal(10,2) as tax_amount,
               case when v = 0 then 'Pending' when o_orderstatus = 'F' then ' Paid'
                    when o_orderstatus = 'O' then 'Pending' else 'Overdue ' end as status,
               o_orderdate + {SHIFT} + to_hours(11) as created_at, {_meta('o_orderkey', "['c','u','d']")}
        from {_versions('orders', "o_orderpriority = '5-LOW' and o_orderstatus = 'P' and o_totalprice < 20000")}""",
    "log_sales_invoice_item": f"""
        select {_LINE_KEY} as item_id, l_orderkey as invoice_id, l_partkey as product_id,
               l_quantity::integer as quantity, l_extendedprice::decimal(10,2) as unit_price,
               case when l_discount::decimal(10,2) > 0 then (l_discount::decimal(10,2) * 100)::decimal(10,2) end as discount,
               l_shipdate + {SHIFT} as created_at, {_LINE_META}
        from lineitem""",
    "log_purchase_bill": f"""
        select * from (
        select o_orderkey as bill_id, o_custkey % 100 as supplier_id,
               o_orderdate + {SHIFT} + to_hours(8) as bill_date, total as total_sum, tax as tax_amount,
               case when v = 0 then 0 when o_orderstatus = 'F' then total + tax
                    when o_orderstatus = 'O' then (total * 0.60)::decimal(10,2)
                    when o_orderpriority <> '4-NOT SPECIFIED' then 0 end::decimal(10,2) as paid_amount,
               case when v = 0 then 'Pending' when o_orderstatus = 'F' then 'Paid'
                    when o_orderstatus = 'O' then 'Partially Paid' else 'Pending' end as status,
               o_orderdate + {SHIFT} + to_hours(9) as created_at, {_meta('o_orderkey', "['c','u']")}
        from (select *, round(total * 0.20, 2)::decimal(10,2) as tax
              from (select *, (o_totalprice::decimal(10,2) * 0.60)::decimal(10,2) as total from {_versions('orders')})))""",
    "log_purchase_bill_item": f"""
        select {_LINE_KEY} as item_id, l_orderkey as bill_id, l_partkey as product_id,
               l_quantity::integer as quantity, (l_extendedprice::decimal(10,2) * 0.62)::decimal(10,2) as unit_price,
               l_shipdate + {SHIFT} as created_at, {_LINE_META}
        from lineitem""",
    "log_inventory_movement": f"""
        select {_LINE_KEY} as movement_id, l_partkey as product_id,
               case l_returnflag when 'R' then ' in' when 'A' then 'Out ' else 'adjust' end as movement_type,
               l_quantity::integer as quantity, l_shipdate + {SHIFT} + to_hours(2) as movement_date,
               l_shipdate + {SHIFT} + to_hours(3) as created_at, {_LINE_META}
        from lineitem""",
    "account_owners": """
        select c_custkey * 2 as id, c_custkey as customer_id, null::bigint as supplier_id,
               'Checking' as account_type, c_acctbal as balance from customer
        union all select s_suppkey * 2 + 1, null, s_suppkey, 'Business', s_acctbal from supplier
        union all select -2, null, null, 'Operating', 0.0
        union all select -4, null, null, 'Clearing', 0.0""",
    "log_account": f"""
        select id as account_id,
               'ACC-' || case when length(id::varchar) >= 8 then id::varchar else lpad(id::varchar, 8, '0') end as account_number,
               customer_id, supplier_id, account_type, 'eur' as currency,
               case when v > 0 and balance < 0 then 'Frozen' else 'Active' end as status,
               {_base_time('abs(id)')} as opened_at, {_base_time('abs(id)')} as created_at,
               {_meta('id', "['c','u']")}
        from {_versions('account_owners')}""",
    "log_card": f"""
        select c_custkey as card_id, c_custkey * 2 as account_id,
               case when c_nationkey < 5 then 'Credit' else 'Debit' end as card_type,
               case when c_custkey % 2 = 0 then 'Mastercard' else 'Visa' end as brand,
               lpad((c_custkey % 10000)::varchar, 4, '0') as last4,
               (c_custkey % 12 + 1)::smallint as expiry_month, (c_custkey % 5 + 2026)::smallint as expiry_year,
               case when v > 0 and c_acctbal < 100 then 'Blocked' else 'Active' end as status,
               {_base_time('c_custkey')} + to_days(1) as created_at, {_meta('c_custkey', "['c','u','d']")}
        from {_versions('customer', 'c_acctbal < -950')}""",
    "transactions": f"""
        select *, o_orderkey * 2 + part as id from (
        select o_orderkey, o_custkey, o_orderstatus, o_totalprice,
               case o_orderpriority when '1-URGENT' then 'Invoice Payment' when '2-HIGH' then 'Bill Payment'
                    when '3-MEDIUM' then 'Card Payment' when '4-NOT SPECIFIED' then 'Transfer' else 'Deposit' end as kind,
               (o_orderpriority = '3-MEDIUM' and o_orderstatus = 'F' and o_totalprice > 400000) as reversed,
               o_orderdate + {SHIFT} + to_hours(12) as moment,
               (case when o_orderpriority = '1-URGENT'
                     then o_totalprice::decimal(12,2) + round(o_totalprice::decimal(10,2) * 0.20, 2)
                     else o_totalprice::decimal(12,2) end)::decimal(12,2) as amount,
               unnest(case when o_orderpriority = '3-MEDIUM' and o_orderstatus = 'F' and o_totalprice > 400000
                           then [0, 1] else [0] end) as part
        from orders)""",
    "log_financial_transaction": f"""
        select id as transaction_id, transaction_type, status, amount, 'eur' as currency,
               case when transaction_type = 'Card Payment' then o_custkey end as card_id,
               case when transaction_type = 'Invoice Payment' then o_orderkey end as invoice_id,
               case when transaction_type = 'Bill Payment' then o_orderkey end as bill_id,
               case when part = 1 then o_orderkey * 2 end as reverses_transaction_id,
               ' Order ' || o_orderkey as description, moment as transaction_date, moment as created_at,
               arrival, __op, __lsn, __source_ts_ms, __deleted
        from (select *, case when part = 0 then kind else 'Reversal' end as transaction_type,
                     case when v = 0 and part = 0 then 'Pending' when reversed and part = 0 then 'Reversed'
                          when o_orderstatus = 'F' then 'Posted' when o_orderstatus = 'P' then 'Pending'
                          else 'Failed' end as status, {_meta('id', "['c','u']")}
              from {_versions('transactions')})""",
    "log_ledger_entry": f"""
        select entry as entry_id, id as transaction_id,
               case when (leg = 0) = (part = 0) then o_custkey * 2
                    when kind = 'Deposit' then -4 else -2 end as account_id,
               case when leg = 0 then 'Debit' else ' Credit' end as direction,
               (amount - case when leg = 1 and o_totalprice > 480000 then 0.01 else 0.00 end)::decimal(12,2) as amount,
               moment as created_at, {_meta('entry', "['c']")}
        from (select *, id * 2 + leg as entry, 0 as v
              from (select *, unnest([0, 1]) as leg from transactions
                    where (o_orderstatus = 'F' and o_totalprice >= 2000) or (o_orderstatus = 'P' and o_totalprice > 499000)))
        where not (leg = 1 and o_totalprice > 490000)""",
    # --- staging ---
    "stg_customer": f"""
        select customer_id, trim(first_name) as first_name, trim(last_name) as last_name,
               lower(trim(email)) as email, trim(phone_number) as phone_number, created_at
        from ({_state('log_customer', 'customer_id')})""",
    "stg_supplier": f"""
        select supplier_id, trim(name) as name, trim(contact_name) as contact_name,
               lower(trim(contact_email)) as contact_email, trim(contact_phone) as contact_phone, created_at
        from ({_state('log_supplier', 'supplier_id')})""",
    "stg_product": f"""
        select product_id, trim(name) as name, trim(description) as description, unit_price, created_at
        from ({_state('log_product', 'product_id')})""",
    "stg_sales_invoice": f"""
        select invoice_id, customer_id, invoice_date, total_sum, tax_amount,
               (total_sum + tax_amount)::decimal(17,2) as total_amount_with_tax,
               trim(status) as status, created_at
        from ({_state('log_sales_invoice', 'invoice_id')})""",
    "stg_sales_invoice_item": f"""
        select item_id, invoice_id, product_id, quantity, unit_price, discount,
               (unit_price * quantity * (1 - coalesce(discount, 0)::decimal(5,2) * 0.01::decimal(4,2)))::decimal(16,2)
                   as total_price_with_discount, created_at
        from ({_state('log_sales_invoice_item', 'item_id')})""",
    "stg_purchase_bill": f"""
        select bill_id, supplier_id, bill_date, total_sum, tax_amount,
               (total_sum + tax_amount)::decimal(17,2) as total_amount_with_tax, paid_amount,
               (total_sum + tax_amount - paid_amount)::decimal(10,2) as outstanding_amount,
               trim(status) as status, created_at
        from ({_state('log_purchase_bill', 'bill_id')})""",
    "stg_purchase_bill_item": f"""
        select item_id, bill_id, product_id, quantity, unit_price, created_at
        from ({_state('log_purchase_bill_item', 'item_id')})""",
    "stg_inventory_movement": f"""
        select movement_id, product_id, upper(trim(movement_type)) as movement_type, quantity,
               movement_date, created_at
        from ({_state('log_inventory_movement', 'movement_id')})""",
    "stg_account": f"""
        select account_id, trim(account_number) as account_number, customer_id, supplier_id,
               trim(account_type) as account_type, upper(trim(currency)) as currency, trim(status) as status,
               opened_at, created_at
        from ({_state('log_account', 'account_id')})""",
    "stg_card": f"""
        select card_id, account_id, card_type, brand, last4, expiry_month, expiry_year, status, created_at
        from ({_state('log_card', 'card_id')})""",
    "stg_financial_transaction": f"""
        select transaction_id, trim(transaction_type) as transaction_type, trim(status) as status, amount,
               upper(trim(currency)) as currency, card_id, invoice_id, bill_id, reverses_transaction_id,
               trim(description) as description, transaction_date, created_at
        from ({_state('log_financial_transaction', 'transaction_id')})""",
    "stg_ledger_entry": f"""
        select entry_id, transaction_id, account_id, trim(direction) as direction, amount,
               (case when trim(direction) = 'Credit' then amount else -amount end)::decimal(12,2) as signed_amount,
               created_at
        from ({_state('log_ledger_entry', 'entry_id')})""",
    # --- intermediate and marts ---
    "int_account_balance": """
        select account_id, sum(signed_amount)::decimal(22,2) as balance from stg_ledger_entry group by account_id""",
    "int_inventory_balance": f"""
        select product_id, sum({signed_quantity()})::bigint as balance_quantity
        from stg_inventory_movement group by product_id""",
    "dim_customer": "select * from stg_customer",
    "dim_supplier": "select * from stg_supplier",
    "dim_card": "select * from stg_card",
    "dim_product": """
        select p.product_id, p.name, p.description, p.unit_price, i.balance_quantity
        from stg_product p left join int_inventory_balance i on p.product_id = i.product_id""",
    "dim_account": """
        select a.*, coalesce(b.balance, 0)::decimal(22,2) as current_balance
        from stg_account a left join int_account_balance b on a.account_id = b.account_id""",
    "dim_date": f"""
        select {date_key('d')} as date_key, d as date_day, year(d)::integer as year, quarter(d)::integer as quarter,
               month(d)::integer as month_number, strftime(d, '%B') as month_name,
               week(d)::integer as week_number, day(d)::integer as day_of_month, strftime(d, '%a') as day_name
        from (select unnest(generate_series(date '2020-01-01', date '2030-12-31', interval 1 day))::date as d)""",
    "fact_sales": f"""
        select l.item_id, l.invoice_id, l.product_id, i.customer_id, {date_key('i.invoice_date')} as invoice_date_key,
               l.quantity, l.unit_price, l.discount as discount_percentage,
               (l.quantity * l.unit_price)::decimal(21,2) as gross_amount,
               (l.quantity * l.unit_price - l.total_price_with_discount)::decimal(22,2) as discount_amount,
               l.total_price_with_discount as net_amount, i.status as invoice_status
        from stg_sales_invoice_item l join stg_sales_invoice i on l.invoice_id = i.invoice_id""",
    "fact_purchases": f"""
        select l.item_id, l.bill_id, l.product_id, b.supplier_id, {date_key('b.bill_date')} as bill_date_key,
               l.quantity, l.unit_price, (l.quantity * l.unit_price)::decimal(21,2) as gross_amount,
               b.paid_amount, b.status as bill_status
        from stg_purchase_bill_item l join stg_purchase_bill b on l.bill_id = b.bill_id""",
    "fct_inventory_movements": f"""
        select movement_id, product_id, {date_key('movement_date')} as movement_date_key, movement_type, quantity,
               {signed_quantity()} as signed_quantity
        from stg_inventory_movement""",
    "fct_ledger_entries": f"""
        select entry_id, transaction_id, account_id, {date_key('created_at')} as entry_date_key, direction,
               amount, signed_amount
        from stg_ledger_entry""",
    "ledger_legs_pivot": """
        select transaction_id, max(account_id) filter (where direction = 'Debit') as from_account_id,
               max(account_id) filter (where direction = 'Credit') as to_account_id
        from stg_ledger_entry group by transaction_id""",
    "fct_transactions": f"""
        select t.transaction_id, t.transaction_type, t.status, t.amount, t.currency,
               {date_key('t.transaction_date')} as transaction_date_key, t.transaction_date, t.card_id,
               t.invoice_id, t.bill_id, t.reverses_transaction_id, l.from_account_id, l.to_account_id,
               t.status = 'Reversed' as is_reversed,
               t.status in ('Posted', 'Reversed') and t.transaction_type <> 'Reversal' as is_successful
        from stg_financial_transaction t left join ledger_legs_pivot l on t.transaction_id = l.transaction_id""",
    "invoice_payments": """
        select invoice_id, sum(amount) as paid from stg_financial_transaction
        where transaction_type = 'Invoice Payment' and status = 'Posted' group by invoice_id""",
    "bill_payments": """
        select bill_id, sum(amount) as paid from stg_financial_transaction
        where transaction_type = 'Bill Payment' and status = 'Posted' group by bill_id""",
    "fct_receivables": f"""
        select *, (amount_due - amount_paid)::decimal(23,2) as outstanding_amount,
               case when invoice_status = 'Paid' then amount_paid < amount_due
                    when invoice_status is null then false else amount_paid >= amount_due end as is_status_mismatch
        from (select i.invoice_id, i.customer_id, {date_key('i.invoice_date')} as invoice_date_key,
                     i.status as invoice_status, i.total_amount_with_tax as amount_due,
                     coalesce(p.paid, 0)::decimal(22,2) as amount_paid
              from stg_sales_invoice i left join invoice_payments p on i.invoice_id = p.invoice_id)""",
    "fct_payables": f"""
        select *, (amount_due - ledger_paid_amount)::decimal(23,2) as outstanding_amount,
               coalesce(recorded_paid_amount, 0) <> ledger_paid_amount as is_paid_amount_mismatch
        from (select b.bill_id, b.supplier_id, {date_key('b.bill_date')} as bill_date_key,
                     b.status as bill_status, b.total_amount_with_tax as amount_due,
                     b.paid_amount as recorded_paid_amount, coalesce(p.paid, 0)::decimal(22,2) as ledger_paid_amount
              from stg_purchase_bill b left join bill_payments p on b.bill_id = p.bill_id)""",
}

CTES.update(
    {
        "log_user_event": """
            select user_id, event_id, event_type, value::decimal(12,2) as value, ts,
                   case when event_type = 'signup' then 'c' when event_type = 'error' then 'd'
                        when event_type = 'purchase' and value >= 250 then null else 'u' end as __op,
                   case when event_type = 'view' and value >= 250 then null else event_id end as __lsn,
                   epoch_us(ts) // 1000 as __source_ts_ms,
                   case event_type when 'signup' then null when 'error' then 'true' else 'false' end as __deleted,
                   ts as arrival,
                   (event_type = 'error' and value >= 100) as broken, (event_type = 'click' and value >= 100) as heartbeat
            from events""",
        "all_logs": " union all ".join(
            f"select '{name.removeprefix('log_')}' as __table, __op from {name}"
            for name in CTES
            if name.startswith("log_")
        ),
        "check_results": """
            select event_id as id, 'run-' || strftime(ts, '%Y-%m-%d') as run_id, ts as checked_at,
                   case event_type when 'error' then 'connector_status' when 'view' then 'replication_slot_lag'
                        when 'click' then 'row_count' when 'purchase' then 'table_freshness'
                        else 'kafka_connect_reachable' end as check_name,
                   'user-' || user_id as subject,
                   case when value >= 100 then 'fail' when value >= 50 then 'warn' else 'ok' end as status,
                   case when event_type = 'view' and value < 1 then null else value end as value, props as detail
            from events""",
        "latest_checks": """
            select * from check_results
            where run_id = (select run_id from check_results order by checked_at desc, id desc limit 1)""",
        "user_bounds": """
            select a, b, b - (b - a + 1) // 3 + 1 as gone from (select min(user_id) as a, max(user_id) as b from events)""",
        "user_state": _state("log_user_event", "user_id"),
        "merge_newest": """
            select *, (__op = 'd') or coalesce(__deleted = 'true', false) as is_deleted from log_user_event
            qualify row_number() over (partition by user_id order by __lsn desc nulls last, __source_ts_ms desc nulls last) = 1""",
        "metric_samples": """
            select metric, subject, ts, value * case metric when 'IncomingRecords' then 0.02::double
                when 'WriteProvisionedThroughputExceeded' then 1::double
                when 'GetRecords.IteratorAgeMilliseconds' then 500000::double
                when 'OldestReplicationSlotLag' then 50000000::double when 'FreeStorageSpace' then 200000000::double
                when 'UsageLimitConsumed' then 0.1::double else 1::double end as value
            from (select ts, value, case when user_id % 3 = 0 then 'replica' else 'stream' end as subject, unnest(case event_type
                when 'signup' then ['OldestReplicationSlotLag', 'FreeStorageSpace']
                when 'purchase' then ['GetRecords.IteratorAgeMilliseconds', 'UsageLimitConsumed']
                when 'click' then ['IncomingRecords'] when 'error' then ['WriteProvisionedThroughputExceeded']
                else ['GetRecords.Success'] end) as metric from events)""",
        "alarm_specs": """
            select * from (values
                ('source-silent', 'IncomingRecords', 'sum', 300, 2, '<', 1.0::double, true),
                ('write-throttled', 'WriteProvisionedThroughputExceeded', 'sum', 300, 1, '>', 0.0::double, false),
                ('not-consumed', 'GetRecords.Success', 'count', 21600, 1, '<', 1.0::double, true),
                ('iterator-age', 'GetRecords.IteratorAgeMilliseconds', 'max', 300, 1, '>', 43200000.0::double, false),
                ('slot-lag', 'OldestReplicationSlotLag', 'max', 300, 1, '>', 5368709120.0::double, false),
                ('low-storage', 'FreeStorageSpace', 'min', 300, 1, '<', 4294967296.0::double, false),
                ('usage-limit', 'UsageLimitConsumed', 'max', 300, 1, '>', 12.8::double, false)
            ) as t(alarm, metric, statistic, period, needed, comparison, threshold, missing_breaches),
            (values ('stream'), ('replica')) as u(subject)""",
        "alarm_seen": """
            select alarm, subject, (date_diff('second', timestamp '2024-01-01', date_trunc('second', ts)) // period)::bigint as slot,
                   case any_value(statistic) when 'sum' then sum(value) when 'max' then max(value)
                        when 'min' then min(value) else count(value)::double end as value
            from metric_samples join alarm_specs using (metric, subject)
            where ts >= timestamp '2024-01-01' and ts < timestamp '2024-01-31' group by 1, 2, 3""",
        "alarm_periods": """
            select s.alarm, s.metric, s.subject, s.slot, s.period, s.needed, seen.value,
                   case when seen.value is null then missing_breaches
                        when comparison = '<' then seen.value < threshold else seen.value > threshold end as breaching
            from (select *, unnest(range(0, 2592000 // period)) as slot from alarm_specs) s
            left join alarm_seen seen on s.alarm = seen.alarm and s.subject = seen.subject and s.slot = seen.slot""",
        "paid_invoices": """
            select invoice_id * 2 as transaction_id, 'Invoice Payment' as transaction_type, 'Posted' as status,
                   (total_sum + tax_amount)::decimal(12,2) as amount, invoice_id, null::bigint as bill_id,
                   'Payment of invoice ' || invoice_id as description, invoice_date + to_days(3) as transaction_date,
                   customer_id + 2 as from_account, 1::bigint as to_account
            from stg_sales_invoice where status = 'Paid'""",
        "paid_bills": """
            select bill_id * 2 + 1 as transaction_id, 'Bill Payment' as transaction_type, 'Posted' as status,
                   paid_amount::decimal(12,2) as amount, null::bigint as invoice_id, bill_id,
                   'Payment of bill ' || bill_id as description, bill_date + to_days(5) as transaction_date,
                   1::bigint as from_account, supplier_id + 1000000000 as to_account
            from stg_purchase_bill where paid_amount > 0""",
        "payments": "select * from paid_invoices union all select * from paid_bills",
        "sample_lines": """
            select l_orderkey, l_linenumber, l_partkey as product_id, l_quantity::integer as quantity,
                   l_extendedprice::decimal(10,2) as unit_price,
                   case when l_discount > 0 then (l_discount::decimal(10,2) * 100)::decimal(10,2) end as discount,
                   l_returnflag, l_shipdate
            from lineitem""",
        "sample_products": "select p_partkey as product_id, p_retailprice::decimal(10,2) as unit_price from part",
    }
)


def _check_sql(check: Check) -> str:
    """One report row of a declared check."""
    c, m = check.column, check.model
    if check.kind == "not_null":
        failures = f"select count(*) from {m} where {c} is null"
    elif check.kind == "unique":
        failures = f"select count(*) from (select {c} from {m} where {c} is not null group by {c} having count(*) > 1)"
    elif check.kind == "accepted_values":
        values = ", ".join(str(v).lower() if isinstance(v, bool) else repr(v) for v in check.values)
        failures = f"select count(distinct {c}) from {m} where {c} not in ({values})"
    else:
        failures = (
            f"select count(*) from {m} where {c} is not null and {c} not in "
            f"(select {check.to[1]} from {check.to[0]} where {check.to[1]} is not null)"
        )
    bad = "warn" if check.severity == "warn" else "fail"
    return (
        f"select '{m}' as model, '{c}' as column_name, '{check.kind}' as check_name, failures, "
        f"'{check.severity}' as severity, case when failures = 0 then 'pass' else '{bad}' end as status "
        f"from (select ({failures}) as failures)"
    )


def _checks_sql(checks) -> str:
    return " union all ".join(_check_sql(c) for c in checks)


def _constraints_sql(spec: TableSpec) -> str:
    """Rows of a source table, before cleaning, with the rules they break."""
    cases = ", ".join(
        f"case when not ({rule.replace(' rlike ', ' similar to ')}) then '{name}' end"
        for name, rule in spec.constraints.items()
    )
    state = _state(f"log_{spec.name}", spec.primary_key)
    return (
        f"select * from (select '{spec.name}' as table_name, {spec.primary_key} as key, "
        f"concat_ws(',', {cases}) as failed from ({state})) where failed <> ''"
    )


_WORD = re.compile(r"[a-z_][a-z_0-9]*")


def compose(body: str) -> str:
    """`body` with the building blocks it names, directly or through others."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for word in dict.fromkeys(_WORD.findall(text)):
            if word in CTES and word not in ordered:
                visit(CTES[word])
                if word not in ordered:
                    ordered.append(word)

    visit(body)
    if not ordered:
        return body.strip()
    blocks = ",\n".join(f"{name} as ({CTES[name].strip()})" for name in ordered)
    own = body.strip()
    return f"with {blocks},\n{own.removeprefix('with ')}" if own.startswith("with ") else f"with {blocks}\n{own}"


def _by_kind(kind: str) -> str:
    return _checks_sql(c for c in DECLARED if c.kind == kind)


_STAMPED = (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts"))
_UNSTAMPED = tuple(
    "region nation customer supplier part documents embeddings pages benchmark labels conversations".split()
)
_USERS = "user_id, event_id, event_type, value, ts"
_SERIES = (
    "select checked_at as time, subject as metric, value from check_results where check_name = '{}' "
    "and value is not null and checked_at between timestamp '2024-01-01' and timestamp '2024-02-01'"
)

_BODIES: dict[str, str] = {
    # --- sources, landing, extraction ---
    "landing_parse": """
        select ts as approximate_arrival_timestamp, case when not heartbeat then event_id end as event_id,
               case when not heartbeat then value end as value, case when not heartbeat then __op end as __op,
               case when not heartbeat then 'user_event' end as __table
        from log_user_event where not broken""",
    "landing_refresh": """
        select case when not heartbeat then 'user_event' end as __table, case when not heartbeat then __op end as __op,
               count(*) as events, 0::bigint as second_drain_rows
        from log_user_event where not broken group by 1, 2""",
    "heartbeat_filter": """
        select 'user_event' as __table, __op, count(*) as events
        from log_user_event where not broken and not heartbeat group by 2""",
    "envelope_flatten": """
        select ts as approximate_arrival_timestamp, user_id, event_id, event_type, value::varchar as value,
               epoch_us(ts) // 1000 as ts, __op, 'user_event' as __table, __lsn, __source_ts_ms,
               case when __op = 'd' then 'true' else 'false' end as __deleted
        from log_user_event""",
    "route_fan_in": "select __table, __op, count(*) as events from all_logs group by 1, 2",
    "route_fan_out": " union all ".join(
        f"select count(*) as row_count, sum({spec.primary_key})::decimal(38,0) as key_sum, '{name}' as table_name from stg_{name}"
        for name, spec in TABLES.items()
    ),
    "snapshot_tail_log": """
        select 'r' as __op, count(*) as events from customer union all
        select case when o_orderstatus = 'F' and o_orderpriority = '5-LOW' then 'd' else 'u' end, count(*)
        from orders group by 1""",
    "snapshot_plus_tail": """
        select customer_id, segment, balance, __op from (
            select c_custkey as customer_id, c_mktsegment as segment, c_acctbal::decimal(12,2) as balance, 'r' as __op, 0 as n
            from customer union all
            select o_custkey, o_orderpriority, o_totalprice::decimal(12,2),
                   case when o_orderstatus = 'F' and o_orderpriority = '5-LOW' then 'd' else 'u' end, o_orderkey + 1
            from orders
        ) qualify row_number() over (partition by customer_id order by n desc) = 1 and __op <> 'd'""",
    "landing_typed": " union all ".join(
        f"select {spec.primary_key} as key, {spec.column_names[1]}::varchar as label, "
        f"make_timestamp_ms(__source_ts_ms) as updated_at, __op, '{name}' as __table, __lsn, __source_ts_ms, __deleted "
        f"from log_{name}"
        for name, spec in TABLES.items()
    ),
    "schema_evolution": """
        select product_id, unit_price::varchar as unit_price, case when __op <> 'c' then description end as description,
               __op, null::varchar as note from log_product
        union all select product_id, null, null, null, 'removed' from log_product where __op = 'd'""",
    "change_stream": """
        select count(*) as delivered, count(distinct event_id) as distinct_events,
               count(*) filter (where ts < timestamp '2024-01-15') as first_read,
               count(*) filter (where ts >= timestamp '2024-01-15') as second_read, 0::bigint as third_read
        from events""",
    "extract_first_run": """
        select o_orderkey as invoice_id, o_custkey as customer_id, o_totalprice as total_sum, o_orderdate as updated_at
        from orders where o_orderdate <= timestamp '2000-01-01'""",
    "extract_incremental": """
        select o_orderkey as invoice_id, o_custkey as customer_id, o_totalprice as total_sum, o_orderdate as updated_at
        from orders where o_orderdate > timestamp '1997-12-31 23:55:00' and o_orderdate <= timestamp '2000-01-01'""",
    "conform_schema": """
        select o_orderkey as invoice_id, o_custkey as customer_id, null::timestamp as invoice_date,
               o_totalprice::decimal(10,2) as total_sum, null::decimal(10,2) as tax_amount, o_orderstatus as status,
               null::timestamp as created_at
        from orders""",
    "checkpoint_read": """
        select t as source_table, cutoff as successful_cutoff, cutoff is null as first_run from (
            select 'orders' as t, max(o_orderdate) as cutoff from orders union all
            select 'lineitem', max(l_shipdate) from lineitem union all
            select 'events', max(ts) from events union all select 'customer', null)""",
    "checkpoint_upsert": """
        select 'users' as source_table, timestamp '2024-02-01' as successful_cutoff,
               count(*) filter (where b > timestamp '2024-01-14 23:55:00') as extracted_row_count,
               count(*) filter (where a is null) as inserted_row_count, count(*) filter (where b > a) as updated_row_count,
               timestamp '2024-02-01' as ingested_at
        from (select user_id, max(ts) as b, max(ts) filter (where ts <= timestamp '2024-01-15') as a from events group by 1)
        union all select 'orders', timestamp '2024-02-01', 0, 0, 0, timestamp '2024-02-01'""",
    "extracted_state": """
        select user_id, event_id, event_type, value::decimal(12,2) as value, ts as updated_at from events
        qualify row_number() over (partition by user_id order by ts desc) = 1""",
    "multi_table_counts": "select "
    + ", ".join(
        f"(select count(*) from {t}) as {t}"
        for t in (
            "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
            "labels conversations"
        ).split()
    ),
    "schema_preflight": "".join(f"select '{t}' as table_name, count(*) as row_count from {t} union all " for t in _UNSTAMPED)
    + "select 'supplier_contract', null",
    "schema_columns_by_table": " union all ".join(
        f"select '{t}' as table_name, {flag} as has_updated_at, count(*) as row_count from {t}"
        for t, flag in [(t, "true") for t, _ in _STAMPED] + [(t, "false") for t in _UNSTAMPED]
    ),
    "backfill_column": """
        select 'orders' as table_name, o_orderkey as id,
               case when o_orderstatus = 'P' then timestamp '2002-01-01' else o_orderdate end as updated_at from orders
        union all select 'customer', c_custkey, timestamp '2002-01-01' from customer""",
    "mart_materialize": " union all ".join(
        f"select '{m}' as model, count(*) as row_count from {m}" for m in MARTS
    ),
    "results_retention": """
        select id, run_id, checked_at, check_name, subject, status, value
        from check_results where checked_at >= timestamp '2024-01-25'""",
    "payload_decode": """
        select item_id, invoice_id, product_id, quantity, unit_price, discount, created_at, __op, __lsn,
               __source_ts_ms, __deleted, 'sales_invoice_item' as __table
        from log_sales_invoice_item""",
    # --- newest per key, merges, streams ---
    "latest_per_key": """
        select item_id, product_id, unit_price::varchar as unit_price, __op, __lsn from log_sales_invoice_item
        qualify row_number() over (partition by item_id order by __lsn desc, __source_ts_ms desc, arrival desc) = 1""",
    "current_state": """
        select user_id, event_id, event_type, value, date_trunc('milliseconds', ts) as ts from (
            select * from log_user_event where not broken and not heartbeat
            qualify row_number() over (partition by user_id order by __lsn desc nulls first,
                __source_ts_ms desc nulls first, arrival desc nulls first) = 1)
        where coalesce(__deleted, 'false') <> 'true'""",
    "replay_account": """
        with newest as (
            select * from log_product qualify row_number() over (partition by product_id order by
                __lsn desc nulls first, __source_ts_ms desc nulls first, arrival desc nulls first) = 1),
        kept as (
            select count(*) as keys,
                   count(*) filter (where product_id % 50 <> 2 and coalesce(__deleted, 'false') <> 'true') as current,
                   count(*) filter (where product_id % 50 <> 2 and __deleted = 'true') as deleted from newest),
        bad as (select count(*) as n, count(*) filter (where p_partkey % 50 < 2) as unranked from part where p_partkey % 50 < 3),
        seen as (select count(*) as n from log_product)
        select 'product' as table_name, seen.n + bad.n as events, current, seen.n + bad.n - unranked - keys as superseded,
               deleted, bad.n as quarantined from kept, bad, seen""",
    "replay_quarantine": """
        select case p_partkey % 50 when 0 then 'unreadable key' when 1 then 'unreadable __lsn' else 'malformed value' end as reason,
               case when p_partkey % 50 = 0 then 'x' else '' end || p_partkey as product_key,
               case when p_partkey % 50 = 1 then 'soon' else '1125899906842624' end as lsn
        from part where p_partkey % 50 < 3""",
    "merge_source_dedup": "select user_id, event_id, event_type, value, is_deleted from merge_newest",
    "merge_changes": f"""
        with halves as (
            select *, ts >= timestamp '2024-01-15' as late,
                   (__op = 'd') or coalesce(__deleted = 'true', false) as is_deleted from log_user_event
            qualify row_number() over (partition by user_id, ts >= timestamp '2024-01-15'
                order by __lsn desc nulls last, __source_ts_ms desc nulls last) = 1)
        select {_USERS} from (select * from halves where is_deleted is not null
            qualify row_number() over (partition by user_id order by late desc) = 1) where not is_deleted""",
    "upsert_source_dedup": """
        select user_id, event_id, event_type, value::decimal(12,2) as value, ts as updated_at from events
        qualify row_number() over (partition by user_id order by ts desc) = 1""",
    "upsert_counts": """
        select count(*) filter (where a is null) as inserted_row_count, count(*) filter (where b > a) as updated_row_count
        from (select user_id, max(ts) filter (where ts > timestamp '2024-01-13') as b,
                     max(ts) filter (where ts <= timestamp '2024-01-15') as a from events group by 1)
        where b is not null""",
    "apply_mutations": """
        with span as (select min(c_custkey) as a, max(c_custkey) as b, (max(c_custkey) - min(c_custkey) + 1) // 3 as t from customer),
        kept as (
            select c_custkey as customer_id, case when c_custkey < a + t then 'UPDATED' else c_mktsegment end as first_name,
                   case when c_custkey < a + t then timestamp '2024-02-01' end as updated_at, a, b, t
            from customer, span where not c_custkey between a + t and a + 2 * t - 1)
        select customer_id, first_name, updated_at from kept
        union all select customer_id + (b - a + 1), first_name, updated_at from kept where customer_id >= a + 2 * t""",
    "late_event_replay": f"""
        select {_USERS} from (select * from log_user_event qualify row_number() over (partition by user_id
            order by __lsn desc nulls first, __source_ts_ms desc nulls first, arrival asc) = 1)
        where coalesce(__deleted, 'false') <> 'true'""",
    "merge_stream_guarded": f"""
        with halves as (
            select *, (__op = 'd') or coalesce(__deleted = 'true', false) as is_deleted from log_user_event
            qualify row_number() over (partition by user_id, ts >= timestamp '2024-01-15'
                order by __lsn desc nulls last, __source_ts_ms desc nulls last) = 1)
        select {_USERS} from (select * from halves where is_deleted is not null
            qualify row_number() over (partition by user_id order by __lsn desc nulls last,
                __source_ts_ms desc nulls last) = 1) where not is_deleted""",
    "stream_current_state": f"select {_USERS} from user_state",
    "replay_equivalence": """
        select count(*) as streamed_rows, count(*) as equal_rows from (
            select * from log_user_event where __op is not null or __deleted = 'true'
            qualify row_number() over (partition by user_id order by __lsn desc nulls last, __source_ts_ms desc nulls last) = 1)
        where __op <> 'd'""",
    "retention_gap": """
        select coalesce(l.__table, a.__table) as __table, newest_landed_lsn, oldest_available_lsn,
               coalesce(oldest_available_lsn > newest_landed_lsn, false) as is_gap_possible
        from (select event_type as __table, max(__lsn) as newest_landed_lsn from log_user_event
              where ts < timestamp '2024-01-15' group by 1) l
        full join (select event_type as __table, min(__lsn) as oldest_available_lsn from log_user_event
                   where ts >= timestamp '2024-01-30' group by 1) a on l.__table = a.__table""",
    "alarm_silent": """
        select timestamp '2024-01-01' + to_seconds(slot * 300) as period_start
        from (select unnest(range(0, 8640)) as slot)
        where slot not in (select date_diff('second', timestamp '2024-01-01', date_trunc('second', ts)) // 300 from events
                           where ts < timestamp '2024-01-31')""",
    "alarm_eval": """
        select alarm, metric, subject, timestamp '2024-01-01' + to_seconds(slot * period) as period_start,
               round(value, 4) as value, breaching,
               case when breaching and (needed = 1 or coalesce(before, false)) then 'ALARM' else 'OK' end as state
        from (select *, lag(breaching) over (partition by alarm, subject order by slot) as before from alarm_periods)""",
    "metric_series": """
        select metric, subject, time_bucket(interval '5 minutes', ts) as period_start,
               round(sum(value), 4) as sum_value, max(value) as max_value, min(value) as min_value, count(value) as sample_count
        from metric_samples group by 1, 2, 3""",
    # --- marts: parts, KPIs, invariants ---
    "payments_posted": """
        select 'Invoice Payment' as transaction_type, invoice_id as document_id, paid::decimal(22,2) as paid from invoice_payments
        union all select 'Bill Payment', bill_id, paid::decimal(22,2) from bill_payments""",
    "transaction_flags": """
        select transaction_id, status, transaction_type, is_reversed, is_successful from fct_transactions""",
    "ledger_legs_pivot": "select * from ledger_legs_pivot",
    "ledger_entry_stats": "select * from entry_stats",
    "ledger_balance_violations": """
        select t.transaction_id, t.status, t.amount, e.entry_count, e.debit_total, e.credit_total
        from stg_financial_transaction t left join entry_stats e on t.transaction_id = e.transaction_id
        where case when t.status in ('Posted', 'Reversed')
              then e.entry_count is null or e.entry_count <> 2 or e.debit_count <> 1
                   or e.debit_total <> t.amount or e.credit_total <> t.amount
              else e.entry_count is not null end""",
    "ledger_sum_zero": """
        select sum(signed_amount)::decimal(22,2) as net_total from stg_ledger_entry having sum(signed_amount) <> 0""",
    "unbalanced_transactions": "select * from entry_stats where debit_total <> credit_total or entry_count < 2",
    "posted_iff_entries": """
        select transaction_id, status from stg_financial_transaction t
        where (status in ('Posted', 'Reversed')) <> exists (
            select 1 from stg_ledger_entry e where e.transaction_id = t.transaction_id)""",
    "negative_balances": """
        select account_id, sum(signed_amount)::decimal(22,2) as balance, any_value(account_type) as account_type
        from stg_ledger_entry join stg_account using (account_id) where account_type <> 'Clearing'
        group by account_id having sum(signed_amount) < 0""",
    "sales_by_month": """
        select year, month_number, month_name, sum(net_amount)::decimal(36,2) as net_amount, count(*) as line_count
        from fact_sales join dim_date on invoice_date_key = date_key group by 1, 2, 3""",
    "dim_date": """
        select d.*, count(e.event_id) as event_count
        from dim_date d left join events e on d.date_day = e.ts::date group by all""",
    "kpi_failure_rate": """
        select count(*) filter (where status = 'Failed') as failed, count(*) filter (where status <> 'Pending') as decided,
               count(*) filter (where status = 'Failed') / count(*) filter (where status <> 'Pending') as failure_rate
        from fct_transactions""",
    "kpi_net_activity": """
        select transaction_type, sum(amount)::decimal(22,2) as net_amount, count(*) as transaction_count
        from fct_transactions where status = 'Posted' and transaction_type <> 'Reversal' group by 1""",
    "kpi_card_spend": """
        select card_id, sum(amount)::decimal(22,2) as card_spend, count(*) as payment_count
        from fct_transactions where status = 'Posted' and transaction_type = 'Card Payment' group by 1""",
    "reversal_links": """
        select r.transaction_id as reversal_id, r.reverses_transaction_id as original_id, o.status as original_status,
               r.amount = o.amount as amounts_match
        from stg_financial_transaction r left join stg_financial_transaction o on r.reverses_transaction_id = o.transaction_id
        where r.reverses_transaction_id is not null""",
    # --- quality ---
    "dq_not_null": _by_kind("not_null"),
    "dq_unique": _by_kind("unique"),
    "dq_accepted_values": _by_kind("accepted_values"),
    "dq_relationships": _by_kind("relationships"),
    "dq_report": f"""
        select check_name, severity, status, count(*) as checks, sum(failures)::bigint as failures
        from ({_checks_sql(DECLARED)}) group by 1, 2, 3""",
    "source_rules": _checks_sql(source_checks()),
    "check_constraints": " union all ".join(_constraints_sql(s) for s in TABLES.values() if s.constraints),
    # --- health ---
    "connector_status": """
        with parts as (
            select event_id, value as amount, event_id % 4 as n, case when event_type = 'view' then 'PAUSED' else 'RUNNING' end as state,
                   event_type = 'error' and event_id % 4 > 0 as failed,
                   'Error: value ' || value::decimal(12,2) || case when value > 50 then repeat('x', 600) else '' end as trace
            from events),
        detailed as (
            select *, 'connector=' || state || case when n = 0 then '; no tasks' else
                   '; ' || array_to_string(list_transform(range(0, n), lambda i:
                       'task ' || i || '=' || case when failed and i = 0 then 'FAILED' else state end), '; ') end
                   || case when failed then ' | ' || trace else '' end as full_text from parts)
        select 'connector_status' as check_name, 'connector-' || event_id as subject,
               case when amount < 3 or n = 0 or failed then 'fail' when state = 'RUNNING' then 'ok' else 'warn' end as status,
               case when amount >= 3 and n > 0 and not failed and state = 'RUNNING' then 1.0 else 0.0 end::double as value,
               case when amount < 2 then 'connector is not registered' when amount < 3 then 'Kafka Connect returned an unexpected response'
                    when length(full_text) <= 500 then full_text else full_text[1:497] || '...' end as detail
        from detailed
        union all select 'connector_status', unnest(['source', 'sink']), 'fail', 0.0, 'connector is not registered'
        union all select 'kafka_connect_reachable', 'kafka-connect', 'ok', 1.0, null""",
    "slot_lag_status": """
        select 'replication_slot_lag' as check_name, name as subject,
               case when lag is null or not coalesce(active, false) then 'fail' when lag > 1000000 then 'warn' else 'ok' end as status,
               lag as value,
               case when lag is null then 'slot has no LSN (invalidated?)'
                    when not coalesce(active, false) then 'slot is inactive; PostgreSQL retains WAL until it is consumed'
                    when lag > 1000000 then 'lag exceeds 1000000 bytes' end as detail
        from (select 'slot-' || event_id as name, case when value >= 3 then event_type <> 'error' end as active,
                     case when event_type = 'view' and value < 1 then null else value * 10000 end as lag from events)""",
    "row_count_check": " union all ".join(
        f"select 'row_count' as check_name, '{t}' as subject, 'ok' as status, count(*)::double as value, "
        f"null::varchar as detail from {t}"
        for t in [t for t, _ in _STAMPED] + list(_UNSTAMPED)
    )
    + " union all select 'row_count', 'supplier_contract', 'fail', null, 'table source.supplier_contract not found'",
    "table_freshness": " union all ".join(
        f"select 'table_freshness' as check_name, '{t}' as subject, case when age > 172800 then 'warn' else 'ok' end as status, "
        f"age as value, case when age > 172800 then 'no update for more than 172800 seconds' end as detail from "
        f"(select (epoch_us(timestamp '2024-02-01') - epoch_us(max({c}))) / 1e6 as age from {t})"
        for t, c in _STAMPED
    )
    + "".join(
        f" union all select 'table_freshness', '{t}', 'warn', null, 'updated_at column missing; add it and fill it'"
        for t in _UNSTAMPED
    ),
    "health_summary": """
        select s as status, count(id) as checks from (select unnest(['ok', 'warn', 'fail']) as s)
        left join check_results on status = s group by 1""",
    "health_run_age": """
        select (epoch_us(timestamp '2024-02-01') - epoch_us(max(checked_at))) / 1e6 as seconds from check_results""",
    "health_failing_latest": """
        select count(*) filter (where status = 'fail') as failing, count(*) filter (where status = 'warn') as warnings
        from latest_checks""",
    "health_source_rows": """
        select round(sum(value), 4) as source_rows from latest_checks where check_name = 'row_count'""",
    "health_connectors": """
        select subject, status, detail from latest_checks
        where check_name in ('kafka_connect_reachable', 'connector_status')""",
    "health_lag_series": _SERIES.format("replication_slot_lag"),
    "health_rows_series": _SERIES.format("row_count"),
    "health_rows_latest": "select subject, value from latest_checks where check_name = 'row_count'",
    "health_freshness_latest": """
        select subject, value, status, detail from latest_checks where check_name = 'table_freshness'""",
    "health_recent_issues": """
        select checked_at, check_name, subject, status, detail from check_results
        where status <> 'ok' order by checked_at desc, id desc limit 200""",
    "health_thresholds": """
        with age as (select (epoch_us(timestamp '2024-02-01') - epoch_us(max(checked_at))) / 1e6 as v from check_results)
        select 'age' as panel, v as value, case when v >= 900 then 'red' else 'green' end as level from age
        union all select 'failing', count(*)::double, case when count(*) >= 1 then 'red' else 'green' end
                  from latest_checks where status = 'fail'
        union all select 'warnings', count(*)::double, case when count(*) >= 1 then 'yellow' else 'green' end
                  from latest_checks where status = 'warn'""",
    # --- reconciliation ---
    "op_counts": "select coalesce(__op, '<NULL>') as operation, count(*) as event_count from log_user_event group by 1",
    "op_count_delta": """
        select coalesce(__op, '<NULL>') as operation, count(*) filter (where ts >= timestamp '2024-01-15') as delta
        from log_user_event group by 1""",
    "present_ids": "select user_id from user_state",
    "missing_ids": """
        select user_id from (select unnest(range(a, b + 1)) as user_id from user_bounds)
        where user_id not in (select user_id from user_state)""",
    "missing_ids_sample": """
        select user_id from (select unnest(range(a, b + 1)) as user_id from user_bounds)
        where user_id not in (select user_id from user_state) order by 1 limit 25""",
    "reconcile_snapshot": "select * from user_snapshot",
    "survivor_equality": """
        select missing_surviving_count as missing, deleted_records_remaining as unexpected,
               missing_surviving_count = 0 and deleted_records_remaining = 0 as is_equal from user_snapshot""",
    "reconcile_report": "select * from user_assertions",
    "reconcile_status": """
        select count(*) as assertions, count(*) filter (where not passed) as failed,
               case when bool_and(passed) then 'PASSED' else 'FAILED' end as status, 'user_events' as load from user_assertions
        union all
        select 10, (n <> customers)::int + (n - kept <> customers - survivors)::int + 4 * (kept <> survivors)::int
                   + (lost <> 0)::int,
               case when n = customers and kept = survivors and lost = 0 then 'PASSED' else 'FAILED' end, load
        from customer_loads""",
    "load_throughput": """
        select event_type, round(count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6), 9) as events_per_second
        from events group by 1""",
    "convergence": """
        with facts as (
            select s.*, (select count(distinct user_id) from events) as users,
                   (select count(*) from (select arg_max(event_type, event_id) as kind from events group by user_id)
                    where kind = 'click') as clicked,
                   (select count(*) from events where event_type = 'error') as source_deleted,
                   (select count(*) from log_user_event where __op = 'd') as landed
            from user_snapshot s)
        select 'user_events' as load, 'insert' as phase, total_records = users and distinct_ids = users and missing_count = 0
               and duplicate_primary_keys = 0 as complete from facts
        union all select 'user_events', 'mixed', total_records = users and distinct_ids = users and duplicate_primary_keys = 0
               and updated_records = clicked and deleted_records_remaining = 0 and missing_surviving_count = 0 from facts
        union all select 'user_events', 'cleanup', total_records = 0 and landed >= source_deleted from facts
        union all select load, 'insert', n = customers and n = last - first + 1 from customer_loads
        union all select load, 'mixed', kept = survivors and lost = 0 from customer_loads
        union all select load, 'cleanup', n >= customers from customer_loads""",
    "ordered_distinct": "select user_id, min(event_id) as first_position from events group by 1",
    # --- scalar functions ---
    "normalize_strings": """
        select customer_id, __lsn, trim(first_name) as first_name, lower(trim(email)) as email,
               upper(trim(email)) as email_upper from log_customer""",
    "discounted_price": """
        select l_orderkey, l_linenumber, unit_price,
               (unit_price * quantity * (1 - coalesce(discount, 0)::decimal(5,2) * 0.01::decimal(4,2)))::decimal(16,2) as net
        from sample_lines""",
    "tax_price": """
        select o_orderkey, (o_totalprice::decimal(10,2) + round(o_totalprice::decimal(10,2) * 0.20, 2))::decimal(17,2) as with_tax
        from orders""",
    "signed_quantity": """
        select l_orderkey, l_linenumber, unit_price,
               case l_returnflag when 'R' then quantity when 'A' then -quantity else 0 end as signed_quantity
        from sample_lines""",
    "signed_amount": """
        select o_orderkey, (case when o_orderstatus = 'F' then 1 else -1 end * o_totalprice::decimal(12,2))::decimal(12,2) as signed_amount
        from orders""",
    "epoch_ms": """
        select event_id, epoch_us(ts) // 1000 as ms, date_trunc('milliseconds', ts) as ts_ms from events""",
    "date_key": f"""
        select {date_key('l_shipdate')} as ship_date_key, count(*) as line_count from lineitem group by 1""",
    "delete_flag": """
        select event_id, (__op = 'd') or event_type in ('signup', 'view') as is_deleted from log_user_event""",
    "status_rule": """
        select o_orderkey, case o_custkey % 4 when 0 then 'north' when 1 then 'east' when 2 then 'south' when 3 then 'west' end as status
        from orders""",
    "due_dates": """
        select o_orderkey, o_orderdate + to_days((o_custkey % 13 * 10)::integer) as invoice_date,
               o_orderdate + to_days(3) as due_date from orders""",
    # --- derived documents ---
    "priced_lines": """
        select product_id, l_orderkey, l_linenumber, quantity, l_shipdate, round(p.unit_price * 0.58, 2)::decimal(10,2) as unit_price
        from (select * exclude (unit_price) from sample_lines) join sample_products p using (product_id)""",
    "invoice_totals": """
        select l_orderkey, round(s, 2)::decimal(18,2) as total_sum, round(s * 0.20, 2)::decimal(18,2) as tax_amount
        from (select l_orderkey, sum(p.unit_price * l.quantity - case when l.discount > 5 then 2.50 else 0.00 end) as s
              from sample_lines l join sample_products p on l.product_id = p.product_id group by 1)""",
    "bill_totals": """
        select l_orderkey, round(s, 2)::decimal(18,2) as total_sum, round(s * 0.20, 2)::decimal(18,2) as tax_amount
        from (select l_orderkey, sum(round(p.unit_price * 0.55, 2)::decimal(10,2) * quantity) as s
              from sample_lines join sample_products p using (product_id) group by 1)""",
    "lateral_agg": """
        select o_orderkey, count(l.quantity) as line_count, sum(l.unit_price * l.quantity)::decimal(18,2) as subtotal
        from orders left join sample_lines l on l_orderkey = o_orderkey group by 1""",
    "scalar_subquery": """
        select l_orderkey, l_linenumber, l.product_id, quantity, l.unit_price, p.unit_price as list_price
        from sample_lines l left join sample_products p on p.product_id = l.product_id""",
    "derive_movements": """
        select item_id * 2 as movement_id, product_id, 'IN' as movement_type, quantity,
               bill_date + to_hours(2) as movement_date, bill_date + to_minutes(125) as created_at
        from stg_purchase_bill_item join (select bill_id, bill_date from stg_purchase_bill) using (bill_id)
        union all
        select item_id * 2 + 1, product_id, 'OUT', quantity, invoice_date + to_hours(2), invoice_date + to_minutes(125)
        from stg_sales_invoice_item join (select invoice_id, invoice_date from stg_sales_invoice) using (invoice_id)""",
    "derive_accounts": """
        select customer_id + 2 as account_id, 'ACC-' || lpad((customer_id + 2)::varchar, 8, '0') as account_number,
               customer_id, null::bigint as supplier_id, 'Checking' as account_type, created_at as opened_at, created_at
        from stg_customer union all
        select supplier_id + 1000000000, 'ACC-' || (supplier_id + 1000000000), null, supplier_id, 'Business', created_at, created_at
        from stg_supplier""",
    "derive_cards": """
        select customer_id as card_id, customer_id + 2 as account_id, 'Debit' as card_type,
               case when month(created_at + to_days(1)) > 6 then 'Mastercard' else 'Visa' end as brand,
               lpad((customer_id % 10000)::varchar, 4, '0') as last4,
               month(created_at + to_days(1))::smallint as expiry_month,
               (year(created_at + to_days(1)) + 4)::smallint as expiry_year, created_at + to_days(1) as created_at
        from stg_customer""",
    "derive_payments": "select * from payments",
    "ledger_legs": """
        select transaction_id, from_account as account_id, 'Debit' as direction, amount, transaction_date as created_at from payments
        union all select transaction_id, to_account, 'Credit', amount, transaction_date from payments""",
    "reversal_entries": """
        with large as (select *, transaction_type = 'Invoice Payment' and amount > 300000 as hit from payments)
        select transaction_id, from_account as account_id, 'Debit' as direction, amount from large
        union all select transaction_id, to_account, 'Credit', amount from large
        union all select transaction_id + 10000000000, to_account, 'Debit', amount from large where hit
        union all select transaction_id + 10000000000, from_account, 'Credit', amount from large where hit""",
}
_P2_TABLES = {name: (spec.primary_key, f"{spec.column_names[1]}::varchar") for name, spec in list(TABLES.items())[:8]}
_BODIES["merge_tables"] = " union all ".join(
    f"select '{t}' as table_name, {key} as key, {label} as label, make_timestamp_ms(__source_ts_ms) as updated_at from ("
    f"select * from log_{t} qualify row_number() over (partition by {key} order by __lsn desc nulls last, "
    f"__source_ts_ms desc nulls last) = 1) where __op <> 'd'"
    for t, (key, label) in _P2_TABLES.items()
)
_BODIES["health_run"] = f"""
    select 'run-1' as run_id, timestamp '2024-02-01' as checked_at, check_name, status, count(*) as checks from (
        select check_name, status from all_connectors union all select check_name, status from all_slots
        union all select check_name, status from ({_BODIES['row_count_check']})
        union all select check_name, status from ({_BODIES['table_freshness']})) group by 3, 4"""
CTES["all_slots"] = _BODIES["slot_lag_status"]
CTES["all_connectors"] = _BODIES["connector_status"]
_BODIES["load_test"] = """
    with span as (select min(c_custkey) as a, max(c_custkey) - min(c_custkey) + 1 as n from customer),
    sizes as (
        select count(*) as total, count(*) filter (where c_custkey < a + n // 10) as updated,
               count(*) filter (where c_custkey between a + n // 10 and a + n // 10 + n // 20 - 1) as deleted
        from customer, span)
    select name, value as actual, value as expected, true as passed from (
        select unnest(['inserted_total_records', 'inserted_missing_count', 'inserted_duplicate_primary_keys',
                       'final_total_records', 'final_missing_surviving_count', 'final_updated_records',
                       'final_deleted_records_remaining', 'final_duplicate_primary_keys',
                       'landing_c', 'landing_u', 'landing_d', 'landing_total']) as name,
               unnest([total, 0, 0, total - deleted, 0, updated, 0, 0, total, updated, deleted,
                       total + updated + deleted]) as value
        from sizes)"""
_BODIES["alarm_stream"] = _BODIES["alarm_eval"]
_BODIES["upsert_newer"] = _BODIES["extracted_state"]
_BODIES["merge_stream"] = _BODIES["merge_changes"]
_BODIES["merge_stream_buckets"] = _BODIES["merge_stream_guarded"]
_BODIES["landing_by_day"] = """
    select ts::date as day, count(*) as events, count(*) filter (where extract(second from ts)::integer % 3 = 0) as new_events
    from log_user_event where not broken and not heartbeat group by 1"""
for _model in ("dim_account", "dim_product", "fact_sales", "fct_ledger_entries"):
    _BODIES[f"incremental_{_model}"] = f"select * from {_model}"

CTES["entry_stats"] = """
    select transaction_id, count(*) as entry_count, count(*) filter (where direction = 'Debit') as debit_count,
           coalesce(sum(amount) filter (where direction = 'Debit'), 0)::decimal(22,2) as debit_total,
           coalesce(sum(amount) filter (where direction = 'Credit'), 0)::decimal(22,2) as credit_total
    from stg_ledger_entry group by 1"""
CTES["user_snapshot"] = """
    select count(user_id) as total_records, count(distinct user_id) as distinct_ids,
           count(user_id) - count(distinct user_id) as duplicate_primary_keys,
           count(*) filter (where event_type = 'click') as updated_records,
           count(*) filter (where user_id >= gone) as deleted_records_remaining,
           any_value(b) - any_value(a) + 1 - count(distinct user_id) as missing_count,
           any_value(gone) - any_value(a) - count(distinct user_id) filter (where user_id < gone) as missing_surviving_count
    from user_bounds left join user_state on true"""
# Each customer is one insert and one delete; survivors are those below the upper third of the key range.
CTES["customer_loads"] = """
    select load, first, last, count(*) filter (where landed) as n,
           count(*) filter (where landed and c_custkey < gone) as kept, count(*) as customers,
           count(*) filter (where c_custkey < gone) as survivors,
           gone - first - count(*) filter (where landed and c_custkey < gone) as lost
    from (select load, c_custkey, first, last, last - (last - first + 1) // 3 + 1 as gone, load = 'whole' or c_custkey % 10 <> 0 as landed
          from customer, (select min(c_custkey) as first, max(c_custkey) as last from customer),
               (values ('whole'), ('cut')) as loads(load))
    group by load, first, last, gone"""
CTES["user_assertions"] = """
    select name, actual, expected, coalesce(actual = expected, false) as passed from (
        select 'duplicate_primary_keys' as name, duplicate_primary_keys as actual, 0::bigint as expected from user_snapshot
        union all select 'deleted_records_remaining', deleted_records_remaining, 0 from user_snapshot
        union all select 'missing_count', missing_count, 0 from user_snapshot
        union all select 'missing_surviving_count', missing_surviving_count, 0 from user_snapshot
        union all select 'survivors_lost', null, 0
        union all select 'distinct_ids', distinct_ids, (select count(distinct user_id) from events) from user_snapshot
        union all select 'landing_total', count(*), (select count(*) from events) from log_user_event
        union all select 'landing_c', count(*), (select count(*) from events where event_type = 'signup')
            from log_user_event where __op = 'c'
        union all select 'landing_d', count(*), (select count(*) from events where event_type = 'error')
            from log_user_event where __op = 'd'
        union all select 'landing_r', count(*), 0 from log_user_event where __op = 'r')"""

_MODELS = [
    name
    for name in CTES
    if name.startswith(("stg_", "int_", "dim_", "fact_", "fct_")) and name != "dim_date"
]

ORACLE_SQL: dict[str, str] = {name: compose(f"select * from {name}") for name in _MODELS}
ORACLE_SQL.update({name: compose(body) for name, body in _BODIES.items()})
