import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.functions import scalars as fn


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_date_key(spark):
    assert one(spark, fn.date_key(F.lit("2026-08-09").cast("date"))) == 20260809
    assert one(spark, fn.date_key(F.lit(None).cast("timestamp_ntz"))) is None


def test_epoch_round_trip_keeps_milliseconds(spark):
    assert one(spark, fn.epoch_ms_to_timestamp(F.lit(1725000000123))) == dt.datetime(2024, 8, 30, 6, 40, 0, 123000)
    assert one(spark, fn.epoch_ms_to_timestamp(F.lit(-1))) == dt.datetime(1969, 12, 31, 23, 59, 59, 999000)
    assert one(spark, fn.timestamp_to_epoch_ms(fn.moment(dt.datetime(1970, 1, 1, 0, 0, 1, 999999)))) == 1999


def test_epoch_does_not_depend_on_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(spark, fn.epoch_ms_to_timestamp(F.lit(0))) == dt.datetime(1970, 1, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_prices(spark):
    price = F.lit("100.05").cast("decimal(10,2)")
    assert one(spark, fn.discounted_price(price, F.lit("50").cast("decimal(10,2)"))) == Decimal("50.03")
    assert one(spark, fn.discounted_price(price, F.lit(None).cast("decimal(10,2)"))) == Decimal("100.05")
    assert one(spark, fn.discounted_price(price, F.lit("0").cast("decimal(10,2)"), 4)) == Decimal("100.0500")
    assert one(spark, fn.tax_price(price, F.lit("20.01").cast("decimal(10,2)"))) == Decimal("120.06")


def test_signs(spark):
    amount = F.lit("5.00").cast("decimal(12,2)")
    assert one(spark, fn.signed_amount(F.lit("Credit"), amount)) == Decimal("5.00")
    assert one(spark, fn.signed_amount(F.lit("credit"), amount)) == Decimal("-5.00")
    assert one(spark, fn.signed_amount(F.lit(None).cast("string"), amount)) == Decimal("-5.00")
    assert [one(spark, fn.signed_quantity(F.lit(k), F.lit(3))) for k in ("IN", "OUT", "in", None)] == [3, -3, 0, 0]


def test_delete_flag_is_three_valued(spark):
    def flag(op, deleted):
        return one(spark, fn.delete_flag(F.lit(op).cast("string"), F.lit(deleted).cast("string")))

    assert flag("d", None) is True
    assert flag("u", "true") is True
    assert flag("u", "ON") is True
    assert flag("u", "no") is False
    assert flag("u", "maybe") is False
    assert flag(None, "true") is True
    assert flag(None, "false") is None
    assert flag(None, None) is None


def test_text_helpers(spark):
    assert one(spark, F.length(fn.truncate_detail(F.repeat(F.lit("x"), 501)))) == 500
    assert one(spark, fn.truncate_detail(F.repeat(F.lit("x"), 501))).endswith("x...")
    assert one(spark, fn.truncate_detail(F.repeat(F.lit("x"), 500))) == "x" * 500
    assert one(spark, fn.first_line(F.lit("\n a: b\r\n\tat c\nd "))) == "a: b"
    assert one(spark, fn.padded(F.lit(42), 8)) == "00000042"
    assert one(spark, fn.padded(F.lit(1234567890), 8)) == "1234567890"
    assert one(spark, fn.clean(F.lit("  a b  "))) == "a b"


def test_seconds_between(spark):
    a, b = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 0, 1, 500000)
    assert one(spark, fn.seconds_between(fn.moment(a), fn.moment(b))) == 1.5
