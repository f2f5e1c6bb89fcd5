"""Column functions. All are built-in expressions, so they stay in generated code."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DETAIL_LIMIT = 500


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def moment(value: dt.datetime) -> Column:
    """A zone-less timestamp constant; filters on it reach the scan."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def date_key(column: Column | str) -> Column:
    """Integer YYYYMMDD of a date or timestamp."""
    day = _col(column).cast("date")
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def epoch_ms_to_timestamp(column: Column | str) -> Column:
    """Zone-less timestamp of an epoch in milliseconds; independent of the session zone."""
    epoch = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    return epoch + _col(column).cast("bigint") * F.expr("interval '0.001' second")


def timestamp_to_epoch_ms(column: Column | str) -> Column:
    """Epoch milliseconds of a zone-less timestamp; needs the session zone to be UTC."""
    return F.unix_millis(_col(column).cast("timestamp"))


def tax_price(extended_price: Column | str, tax_amount: Column | str, scale: int = 2) -> Column:
    """Price plus tax; the tax is rounded to `scale` first."""
    return _col(extended_price) + _col(tax_amount).cast(f"decimal(16,{scale})")


def discounted_price(extended_price: Column | str, percent: Column | str, scale: int = 2) -> Column:
    """Price less a percentage; a missing percentage is no discount."""
    keep = F.lit(1) - F.coalesce(_col(percent), F.lit(0).cast("decimal(10,2)")) / F.expr("100.0")
    return (_col(extended_price) * keep).cast(f"decimal(16,{scale})")


def signed_amount(direction: Column | str, amount: Column | str) -> Column:
    """+amount for exactly 'Credit', -amount for anything else, null included."""
    return F.when(_col(direction) == "Credit", _col(amount)).otherwise(-_col(amount))


def signed_quantity(movement_type: Column | str, quantity: Column | str) -> Column:
    """+quantity for 'IN', -quantity for 'OUT', 0 otherwise."""
    kind, n = _col(movement_type), _col(quantity)
    return F.when(kind == "IN", n).when(kind == "OUT", -n).otherwise(F.lit(0))


def clean(column: Column | str) -> Column:
    return F.trim(_col(column))


def clean_lower(column: Column | str) -> Column:
    return F.lower(F.trim(_col(column)))


def clean_upper(column: Column | str) -> Column:
    return F.upper(F.trim(_col(column)))


def to_boolean(text: Column | str) -> Column:
    """Lenient text to boolean; null when the text is none of the known words."""
    word = F.lower(_col(text))
    return (
        F.when(word.isin("true", "t", "yes", "y", "on", "1"), F.lit(True))
        .when(word.isin("false", "f", "no", "n", "off", "0"), F.lit(False))
    )


def delete_flag(op: Column | str, deleted: Column | str) -> Column:
    """`op = 'd' or deleted`, three-valued: a null op with a false flag stays null."""
    return (_col(op) == "d") | F.coalesce(to_boolean(deleted), F.lit(False))


def seconds_between(earlier: Column | str, later: Column | str) -> Column:
    """Seconds as a double, with microsecond precision."""
    micros = F.unix_micros(_col(later).cast("timestamp")) - F.unix_micros(_col(earlier).cast("timestamp"))
    return micros / F.lit(1e6)


def truncate_detail(text: Column | str, limit: int = DETAIL_LIMIT) -> Column:
    """Text of at most `limit` characters, cut text ending in '...'."""
    full = _col(text)
    return F.when(F.length(full) <= limit, full).otherwise(
        F.concat(F.substring(full, 1, limit - 3), F.lit("..."))
    )


def first_line(text: Column | str) -> Column:
    """First line after leading and trailing white space is removed."""
    stripped = F.regexp_replace(_col(text), r"^\s+|\s+$", "")
    return F.split(stripped, r"\r\n|\r|\n", 2)[0]


def padded(number: Column | str, width: int) -> Column:
    """Number as text, zero-padded on the left; longer numbers are kept whole."""
    text = _col(number).cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))
