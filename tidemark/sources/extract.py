"""Timestamp-window extraction with checkpoints, and the schema work around it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import moment
from tidemark.operators.latest import latest_per_key
from tidemark.session import child_names, committed, constant_rows
from tidemark.sources.registry import TableSpec

CHECKPOINT_SCHEMA = (
    "source_table string, successful_cutoff timestamp_ntz, extracted_row_count bigint, "
    "inserted_row_count bigint, updated_row_count bigint, ingested_at timestamp_ntz"
)
OVERLAP = dt.timedelta(minutes=5)


def window_bounds(
    previous_cutoff: dt.datetime | None, upper: dt.datetime, overlap: dt.timedelta = OVERLAP
) -> tuple[dt.datetime | None, dt.datetime]:
    """`(cutoff - overlap, upper]`; the first run has no lower bound."""
    return (None if previous_cutoff is None else previous_cutoff - overlap), upper


def extract_window(
    source: DataFrame,
    columns: Sequence[str],
    primary_key: str,
    lower: dt.datetime | None,
    upper: dt.datetime,
    stamp: str = "updated_at",
    ordered: bool = True,
) -> DataFrame:
    """Rows changed in `(lower, upper]`. A null stamp is never extracted.

    Bounds and columns reach the scan (`PushedFilters`, `ReadSchema`). The sort
    is a range sort over all tasks; pass `ordered=False` where a merge follows.
    """
    changed = F.col(stamp) <= moment(upper)
    if lower is not None:
        changed = (F.col(stamp) > moment(lower)) & changed
    rows = source.where(changed).select(*columns)
    return rows.orderBy(stamp, primary_key) if ordered else rows


def read_jdbc_window(
    spark: SparkSession,
    options: Mapping[str, str],
    spec: TableSpec,
    bounds: tuple[int, int],
    partitions: int,
    fetch_size: int = 1000,
) -> DataFrame:
    """A source table over JDBC, read in parallel by key ranges with a bounded fetch."""
    return (
        spark.read.format("jdbc")
        .options(**options)
        .option("dbtable", spec.name)
        .option("fetchsize", fetch_size)
        .option("partitionColumn", spec.primary_key)
        .option("lowerBound", bounds[0])
        .option("upperBound", bounds[1])
        .option("numPartitions", partitions)
        .load()
        .select(*spec.all_columns)
    )


def conform_schema(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows with the columns, order and types of a target; missing columns are null."""
    present = set(rows.columns)
    return rows.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def catalog_columns(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table and column, from schemas only."""
    rows = [(name, column) for name, frame in tables.items() for column in frame.columns]
    return constant_rows(spark, rows, "table_name string, column_name string")


def columns_by_table(columns: DataFrame, column: str = "updated_at") -> DataFrame:
    """Whether each table has `column`."""
    return columns.groupBy("table_name").agg(F.bool_or(F.col("column_name") == column).alias(f"has_{column}"))


def schema_preflight(columns: DataFrame, expected: Iterable[str], column: str = "updated_at") -> DataFrame:
    """Expected tables that lack `column`."""
    spark = columns.sparkSession
    wanted = constant_rows(spark, [(name,) for name in expected], "table_name string")
    having = columns.where(F.col("column_name") == column)
    return wanted.join(having, "table_name", "left_anti")


def backfill_column(rows: DataFrame, column: str, value: Column) -> DataFrame:
    """`column` added if absent, and its nulls filled."""
    filled = F.coalesce(F.col(column), value) if column in rows.columns else value
    return rows.withColumn(column, filled)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row with the number of rows of each table."""
    counts = [t.agg(F.count("*").alias("n")).select(F.lit(name).alias("t"), "n") for name, t in tables.items()]
    stacked = reduce(lambda a, b: a.unionByName(b), counts)
    return stacked.agg(*[F.max(F.when(F.col("t") == name, F.col("n"))).alias(name) for name in tables])


def read_checkpoint(checkpoints: DataFrame, tables: Iterable[str]) -> DataFrame:
    """Cutoff of each table; a table without one is on its first run."""
    spark = checkpoints.sparkSession
    wanted = constant_rows(spark, [(name,) for name in tables], "source_table string")
    return wanted.join(checkpoints.select("source_table", "successful_cutoff"), "source_table", "left").select(
        "source_table", "successful_cutoff", F.col("successful_cutoff").isNull().alias("first_run")
    )


def upsert_checkpoint(checkpoints: DataFrame, rows: DataFrame) -> DataFrame:
    """Checkpoints with the rows of finished runs replaced or added."""
    kept = checkpoints.join(rows.select("source_table"), "source_table", "left_anti")
    return kept.unionByName(rows)


class ExtractedTables:
    """Current state of extracted tables, with checkpoints, in parquet folders.

    A run writes its window to a stage, then the rows that pass the guard as one
    part of the table's state, then a small checkpoint folder that lists the
    parts. The checkpoint's success marker is the commit: cutoff and state
    change together, and a run that dies before it leaves the old pair in force.
    A run costs what it extracts: older parts are only read for the staged keys.
    `compact` folds the parts of a table into one.
    """

    _MANIFEST = f"{CHECKPOINT_SCHEMA}, parts array<string>"

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root

    def _committed_runs(self) -> list[str]:
        folder = f"{self.root}/checkpoints"
        return [n for n in child_names(self.spark, folder) if committed(self.spark, f"{folder}/{n}")]

    def _manifest(self) -> DataFrame:
        runs = self._committed_runs()
        if not runs:
            return constant_rows(self.spark, [], self._MANIFEST)
        return self.spark.read.schema(self._MANIFEST).parquet(f"{self.root}/checkpoints/{runs[-1]}")

    def _entry(self, table: str) -> Row | None:
        return self._manifest().where(F.col("source_table") == table).first()

    def _commit(self, run: str, row: Sequence) -> None:
        """Write the checkpoints of all tables with this one replaced."""
        result = constant_rows(self.spark, [row[:-1]], CHECKPOINT_SCHEMA).withColumn(
            "parts", F.array(*[F.lit(part) for part in row[-1]])
        )
        rows = upsert_checkpoint(self._manifest(), result).coalesce(1)
        rows.write.mode("overwrite").parquet(f"{self.root}/checkpoints/{run}")

    def _next_run(self) -> tuple[str, int]:
        runs = self._committed_runs()
        number = int(runs[-1].removeprefix("run-")) + 1 if runs else 1
        return f"run-{number:012d}", number

    def checkpoints(self) -> DataFrame:
        return self._manifest().drop("parts")

    def _versions(self, parts: Sequence[str]) -> DataFrame:
        return self.spark.read.parquet(*parts)

    def state(self, table: str, primary_key: str) -> DataFrame | None:
        """Current rows of a table; None before its first run.

        Only rows that passed the guard were written, so the newest run of a key wins.
        """
        entry = self._entry(table)
        if entry is None:
            return None
        newest = latest_per_key(self._versions(entry.parts), [primary_key], [F.col("__run").desc()])
        return newest.drop("__run", "__action")

    def run(
        self,
        source: DataFrame,
        table: str,
        primary_key: str,
        upper: dt.datetime,
        overlap: dt.timedelta = OVERLAP,
        stamp: str = "updated_at",
    ) -> None:
        """Extract one window, merge it, and move the checkpoint to `upper`, even with no rows."""
        entry = self._entry(table)
        run, number = self._next_run()
        lower, _ = window_bounds(None if entry is None else entry.successful_cutoff, upper, overlap)
        window = extract_window(source, source.columns, primary_key, lower, upper, stamp, ordered=False)
        # The source is read once; every later step reads the stage.
        staged_path = f"{self.root}/stage/{table}/{run}"
        window.write.mode("overwrite").parquet(staged_path)
        staged = self.spark.read.schema(source.schema).parquet(staged_path)
        newest = latest_per_key(staged, [primary_key], [F.col(stamp).desc_nulls_first()])
        if entry is None:
            accepted = newest.withColumn("__action", F.lit("insert"))
        else:
            # A small stage is broadcast here, and the state is scanned without a shuffle.
            touched = self._versions(entry.parts).join(staged.select(primary_key).distinct(), primary_key, "left_semi")
            known = latest_per_key(touched, [primary_key], [F.col("__run").desc()]).select(
                primary_key, F.col(stamp).alias("__old"), F.lit(True).alias("__known")
            )
            newer = F.col("__old").isNull() | (F.col(stamp) > F.col("__old"))
            action = F.when(F.col("__known").isNull(), "insert").when(newer, "update")
            matched = newest.join(known, primary_key, "left").withColumn("__action", action)
            accepted = matched.where(F.col("__action").isNotNull()).select(*source.columns, "__action")
        part = f"{self.root}/state/{table}/{run}"
        accepted.withColumn("__run", F.lit(number).cast("bigint")).write.mode("overwrite").parquet(part)
        written = self.spark.read.parquet(part).agg(
            F.count_if(F.col("__action") == "insert").alias("inserted"),
            F.count_if(F.col("__action") == "update").alias("updated"),
        ).first()
        parts = ([] if entry is None else list(entry.parts)) + [part]
        self._commit(run, (table, upper, staged.count(), written.inserted, written.updated, upper, parts))

    def compact(self, table: str, primary_key: str) -> None:
        """Fold the parts of a table into one; its checkpoint is otherwise unchanged."""
        entry = self._entry(table)
        if entry is None or len(entry.parts) < 2:
            return
        run, _ = self._next_run()
        part = f"{self.root}/state/{table}/{run}-base"
        newest = latest_per_key(self._versions(entry.parts), [primary_key], [F.col("__run").desc()])
        newest.write.mode("overwrite").parquet(part)
        self._commit(run, (*entry[:-1], [part]))


def run_extracts(
    tables: ExtractedTables,
    sources: Mapping[str, tuple[DataFrame, str]],
    upper: dt.datetime,
    overlap: dt.timedelta = OVERLAP,
) -> DataFrame:
    """One run over several tables, `name -> (source, primary key)`; returns their checkpoints."""
    for name, (source, primary_key) in sources.items():
        tables.run(source, name, primary_key, upper, overlap)
    return tables.checkpoints().where(F.col("source_table").isin(*sources))
