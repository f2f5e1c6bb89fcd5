"""From raw change events to the landing relation and per-table logs.

The landing relation has `approximate_arrival_timestamp`, `payload` (variant)
and `__table`. Written landings are partitioned by `__table`, so reading one
table prunes to its folder.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.payload import event_meta, from_wire, sound_events
from tidemark.functions.scalars import epoch_ms_to_timestamp
from tidemark.session import open_writers, whole_payloads
from tidemark.sources.registry import ARRIVAL, META_FIELDS, TableSpec

LANDING_SCHEMA = T.StructType(
    [
        T.StructField(ARRIVAL, T.TimestampNTZType()),
        T.StructField("payload", T.VariantType()),
        T.StructField("__table", T.StringType()),
    ]
)


def parse_landing(raw: DataFrame, value: str = "value") -> DataFrame:
    """Events whose text is valid JSON, as landing rows. Works on batches and streams.

    `raw` has the event text and an arrival timestamp. Text that does not parse
    is dropped. Heartbeats parse and stay, with a null `__table`.
    """
    # explode over an array of one parses each text once; a filter on a parsed column
    # would be pushed below the projection and parse it twice. A lambda over the array
    # would be interpreted, and the parser with it.
    parsed = F.array(F.try_parse_json(F.col(value).cast("string")))
    landed = raw.select(ARRIVAL, F.explode(parsed).alias("payload")).where(F.col("payload").isNotNull())
    return landed.withColumn("__table", F.try_variant_get("payload", "$.__table", "string"))


def drop_heartbeats(landing: DataFrame) -> DataFrame:
    """Only the events that belong to a table."""
    return landing.where(F.col("__table").isNotNull())


def fan_in(logs: Iterable[DataFrame]) -> DataFrame:
    """Per-table landings as one stream of events."""
    return reduce(lambda left, right: left.unionByName(right), logs)


def write_landing(landing: DataFrame, path: str, mode: str = "append", rebalance: bool = False) -> None:
    """One stream routed to per-table folders.

    By default rows stay in the tasks that read them, and every task writes a
    file per table. `rebalance` is for large loads: one shuffle by table, in
    which adaptive execution splits the tables that are too big for a task and
    joins the small ones, so files come out even and a hot table is still
    written by many tasks.

    Payloads are written whole, since every reader takes them whole, and with
    zstd, since they are larger so.
    """
    rows = landing.hint("rebalance", "__table") if rebalance else landing
    with open_writers(rows.sparkSession), whole_payloads(rows.sparkSession):
        rows.write.mode(mode).option("compression", "zstd").partitionBy("__table").parquet(path)


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LANDING_SCHEMA).parquet(path)


def table_log(landing: DataFrame, table: str) -> DataFrame:
    """The events of one table; a partition filter on a written landing."""
    return landing.where(F.col("__table") == table)


def envelope_schema(spec: TableSpec) -> T.StructType:
    """The nested before/after form of a change event of one table."""
    return T.StructType(
        [
            T.StructField("before", spec.wire_schema),
            T.StructField("after", spec.wire_schema),
            T.StructField("op", T.StringType()),
            T.StructField("ts_ms", T.LongType()),
            T.StructField(
                "source",
                T.StructType(
                    [
                        T.StructField("table", T.StringType()),
                        T.StructField("lsn", T.LongType()),
                        T.StructField("ts_ms", T.LongType()),
                    ]
                ),
            ),
        ]
    )


def flatten_envelope(raw: DataFrame, spec: TableSpec, value: str = "value") -> DataFrame:
    """Nested change events as flat rows: the new image, or the old one of a delete.

    A delete is kept as a row with `__deleted = 'true'`.
    """
    event = F.from_json(F.col(value).cast("string"), envelope_schema(spec))
    unpacked = raw.select(ARRIVAL, event.alias("event")).where("event.source.table is not null")
    image = F.coalesce("event.after", "event.before")
    return unpacked.select(
        ARRIVAL,
        *[image.getField(name).alias(name) for name in spec.column_names],
        F.col("event.op").alias("__op"),
        F.col("event.source.table").alias("__table"),
        F.col("event.source.lsn").alias("__lsn"),
        F.col("event.source.ts_ms").alias("__source_ts_ms"),
        F.when(F.col("event.op") == "d", "true").otherwise("false").alias("__deleted"),
    )


def to_payload(flat: DataFrame) -> DataFrame:
    """Flat wire rows as event text, the form a stream carries."""
    body = [F.col(name) for name in flat.columns if name != ARRIVAL]
    return flat.select(ARRIVAL, F.to_json(F.struct(*body)).alias("value"))


def typed_landing(landing: DataFrame, spec: TableSpec) -> DataFrame:
    """The events of one table with fixed columns, ready to append to typed landing."""
    stamped = [
        F.coalesce(
            epoch_ms_to_timestamp(F.try_variant_get("payload", "$.updated_at", "bigint")),
            epoch_ms_to_timestamp(F.col("__event.__source_ts_ms")),
        ).alias("updated_at")
    ]
    op, lsn, ts_ms, deleted = event_meta()
    # made without a text in between; an event without an arrival has an empty object, as its JSON would
    arrival = F.to_variant_object(F.struct(F.unix_millis(F.col(ARRIVAL).cast("timestamp")).alias("arrival_ms")))
    metadata = F.when(F.col(ARRIVAL).isNotNull(), arrival).otherwise(F.parse_json(F.lit("{}")))
    return sound_events(table_log(landing, spec.name), spec).select(
        *from_wire(spec, "__event"),
        *stamped,
        op,
        F.col("__table"),
        lsn,
        ts_ms,
        deleted,
        metadata.alias("record_metadata"),
    )


def evolve(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Append of rows that may bring new columns or lack old ones; gaps are null."""
    return current.unionByName(incoming, allowMissingColumns=True)


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    """A landing folder whose files differ in columns."""
    return spark.read.option("mergeSchema", "true").parquet(path)


META_NAMES = tuple(field.name for field in META_FIELDS)
