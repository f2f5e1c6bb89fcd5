import pytest
from pyspark.sql import types as T

from tidemark.sources.registry import EXTRACTED, TABLES, select_tables


def test_twelve_tables_and_their_keys():
    assert len(TABLES) == 12
    assert {name: spec.primary_key for name, spec in TABLES.items()}["sales_invoice_item"] == "item_id"
    assert all(spec.primary_key in spec.columns for spec in TABLES.values())


def test_all_extracted_tables_by_default():
    assert [s.name for s in select_tables()] == list(EXTRACTED)
    assert len(EXTRACTED) == 8


def test_order_kept_and_duplicates_removed():
    assert [s.name for s in select_tables(["product", "customer", "product"])] == ["product", "customer"]


def test_unknown_table_is_rejected():
    with pytest.raises(ValueError, match="nowhere"):
        select_tables(["customer", "nowhere"])


def test_wire_and_typed_schemas():
    spec = TABLES["purchase_bill"]
    assert spec.wire_schema["total_sum"].dataType == T.StringType()
    assert spec.wire_schema["bill_date"].dataType == T.LongType()
    assert spec.schema["total_sum"].dataType == T.DecimalType(10, 2)
    assert spec.all_columns[-1] == "updated_at"
    assert spec.landing_schema["record_metadata"].dataType == T.VariantType()
