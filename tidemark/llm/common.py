"""What the operators of this package share: reading, texts as bytes, saved intermediate tables, held-out rows."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import fresh_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(frame: DataFrame, label: str) -> DataFrame:
    """`frame` written to the shared folder and read back, so that lost executors cost no recomputation."""
    spark = frame.sparkSession
    path = fresh_dir(spark, label)
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def utf8(text: str | Column = "text") -> Column:
    """A text column as its UTF-8 bytes; null is empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("binary")


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """True for the documents that no model may learn labels from: crc32 of the id as text, mod 4, is 2.

    A null id hashes as the empty text.
    """
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def small_batches(frame: DataFrame, most: str = "4m") -> DataFrame:
    """`frame`, in a session whose Arrow batches are bounded by bytes, not only by rows.

    Texts may be long, and a batch of 10,000 of them is held by the JVM and by Python, for each task. A bound that the
    session already has is left as it is.
    """
    conf, key = frame.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(key, None) is None:
        conf.set(key, most)
    return frame


def give_back() -> None:
    """Hands freed memory to the system: Python workers are kept for later tasks, and would keep it too."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # only glibc has it


def gathered(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Batches of at least `most` bytes, but for the last."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= most:
            yield pa.concat_batches(held)
            held, size = [], 0
    if size:
        yield pa.concat_batches(held)


def per_batch(frame: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], dict]], schema: str) -> DataFrame:
    """`mapInArrow` with a function from a batch to columns; `make` is called once per task."""
    arrow = arrow_schema(schema)
    small_batches(frame)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            if batch.num_rows:
                yield batch_of(step(batch), arrow)
        give_back()

    return frame.mapInArrow(run, schema)


_ARROW = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(), "string": pa.string(),
    "binary": pa.binary(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()),
    "array<int>": pa.list_(pa.int32()), "array<float>": pa.list_(pa.float32()),
    "array<string>": pa.list_(pa.string()), "array<binary>": pa.list_(pa.binary()),
}


def arrow_schema(schema: str) -> pa.Schema:
    """An Arrow schema from `name type, name type`."""
    return pa.schema([(name, _ARROW[kind]) for name, kind in (part.split() for part in schema.split(","))])


def batch_of(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            columns[f.name].cast(f.type) if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name], f.type)
            for f in schema
        ],
        schema=schema,
    )


def bounded_sample(labelled: DataFrame, label: str, per_class: int) -> DataFrame:
    """At most `per_class` rows of each class 0 and 1 of a (doc_id, label) table, picked by a hash of the id."""
    parts = [
        labelled.where(F.col(label) == value)
        .select("doc_id", label)
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(per_class)
        for value in (0, 1)
    ]
    return parts[0].unionByName(parts[1])
