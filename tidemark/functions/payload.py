"""Typed access to the variant payload of a landed event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import epoch_ms_to_timestamp
from tidemark.sources.registry import META_FIELDS, TableSpec

META_NAMES = tuple(field.name for field in META_FIELDS)


def field(name: str, kind: str = "string", payload: str = "payload", strict: bool = True) -> Column:
    """One payload field; a missing path is null.

    Decimals travel as text and are cast from text, never through a double.
    `strict=False` turns a value of the wrong type into null, for quarantine jobs.
    """
    get = F.variant_get if strict else F.try_variant_get
    source = F.col(payload)
    path = f"$.{name}"
    if kind == "timestamp":
        return epoch_ms_to_timestamp(get(source, path, "bigint"))
    if kind.startswith("decimal"):
        text = get(source, path, "string")
        return text.cast(kind) if strict else text.try_cast(kind)
    return get(source, path, {"key": "bigint"}.get(kind, kind))


def event_row(spec: TableSpec, meta: Sequence[str] = META_NAMES) -> Column:
    """All columns of a table and the event metadata named in `meta`, in wire types, in one pass over the payload.

    A value of the wrong type is null. Each value costs a cast of its own, so only metadata that is read should be named.
    """
    fields = T.StructType([*spec.wire_schema.fields, *(f for f in META_FIELDS if f.name in meta)])
    return F.try_variant_get("payload", "$", fields.simpleString())


def with_event(landing: DataFrame, spec: TableSpec, meta: Sequence[str] = META_NAMES) -> DataFrame:
    """Landed events with their event row as `__event`, made once for each event.

    It comes out of an array of one, since filters on its fields, such as those a join adds for its key, would be pushed
    below a projection and take every payload apart again for each field they read.
    """
    return landing.select("*", F.explode(F.array(event_row(spec, meta))).alias("__event"))


def typed_columns(spec: TableSpec, strict: bool = True) -> list[Column]:
    """All columns of a table, decoded from the payload."""
    return [field(name, kind, strict=strict).alias(name) for name, kind in spec.columns.items()]


def meta_columns(strict: bool = True) -> list[Column]:
    """The event metadata held in the payload."""
    return [
        field("__op", strict=strict).alias("__op"),
        field("__lsn", "bigint", strict=strict).alias("__lsn"),
        field("__source_ts_ms", "bigint", strict=strict).alias("__source_ts_ms"),
        field("__deleted", strict=strict).alias("__deleted"),
    ]


def wire_row(spec: TableSpec) -> Column:
    """The columns of a table of `__event`; null for a payload that is no object."""
    row = F.col("__event")
    return F.when(row.isNotNull(), F.struct(*[row.getField(f.name).alias(f.name) for f in spec.wire_schema.fields]))


def malformed(spec: TableSpec, row: Column, decimals: bool = False, meta: bool = False) -> Column:
    """Whether the wire row lacks a value that the payload has. The payload is only looked at for null values.

    With `decimals`, text that is no number of its decimal type counts too; else it is left to the cast. With `meta`,
    `row` is an event row, and its metadata is looked at as well.
    """
    result = F.lit(False)
    for name, kind in spec.columns.items() if decimals else ():
        if kind.startswith("decimal"):
            text = row.getField(name)
            result = result | (text.isNotNull() & text.try_cast(kind).isNull())
    for field_ in (*spec.wire_schema.fields, *(META_FIELDS if meta else ())):
        if not isinstance(field_.dataType, T.StringType):
            present = F.try_variant_get("payload", f"$.{field_.name}", "string").isNotNull()
            result = result | (row.getField(field_.name).isNull() & present)
    return result


def sound_events(landing: DataFrame, spec: TableSpec) -> DataFrame:
    """Landed events with `__event`; a value of the wrong type fails the job, as `field` does."""
    rows = with_event(landing, spec)
    error = F.raise_error(F.lit(f"malformed value in an event of {spec.name}")).cast("boolean")
    return rows.where(F.when(malformed(spec, F.col("__event"), meta=True), error).otherwise(F.lit(True)))


def event_meta() -> list[Column]:
    """The event metadata held in `__event`."""
    return [F.col(f"__event.{name}").alias(name) for name in ("__op", "__lsn", "__source_ts_ms", "__deleted")]


def from_wire(spec: TableSpec, row: str) -> list[Column]:
    """Typed columns of a wire row: decimals from text, timestamps from epoch milliseconds."""

    def decode(name: str, kind: str) -> Column:
        value = F.col(f"{row}.{name}")
        if kind == "timestamp":
            return epoch_ms_to_timestamp(value)
        return value.cast(kind) if kind.startswith("decimal") else value

    return [decode(name, kind).alias(name) for name, kind in spec.columns.items()]
