"""Models kept by change sets: a run reads new events and the stored versions of the keys they touch, never the history.

A run takes the loads after its mark. Of each table it finds the newest new event per key, compares it with the stored version
of that key, and writes down what changed: the old row and the new one. Versions are then replaced in their buckets, and
balances get the difference, the new row's amount less the old one's. Changes are written before anything is applied, and each
balance carries the run that last changed it, so a run that dies anywhere is repeated to the same end.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.payload import from_wire
from tidemark.functions.scalars import signed_quantity
from tidemark.operators.latest import newest_typed, not_deleted
from tidemark.plans.models import Models
from tidemark.plans.staging import stage_rows
from tidemark.session import child_names, committed, freed_shuffles, remove
from tidemark.sources.registry import ARRIVAL, TABLES
from tidemark.streaming.bucket_state import BucketState
from tidemark.streaming.dated_landing import DatedLanding

_META = [
    T.StructField("__key", T.LongType()),
    T.StructField("__lsn", T.LongType()),
    T.StructField("__source_ts_ms", T.LongType()),
    T.StructField(ARRIVAL, T.TimestampNTZType()),
]
_TOTAL = "decimal(38,2)"


def newer(left: str, right: str) -> Column:
    """Whether event `left` replaces `right` under replay's order: LSN, source time, arrival, nulls newest, equals replace."""
    top, latest = F.lit(2**63 - 1), F.expr("timestamp_ntz'9999-12-31 23:59:59.999999'")

    def order(side: str) -> Column:
        return F.struct(
            F.coalesce(f"{side}.__lsn", top), F.coalesce(f"{side}.__source_ts_ms", top), F.coalesce(f"{side}.{ARRIVAL}", latest)
        )

    return order(left) >= order(right)


class Balance:
    """A stored sum over the rows of one table, by one of its columns.

    A key is there as long as it has rows; its sum is null as long as all their amounts are.
    """

    def __init__(
        self, state_path: str, spark: SparkSession, table: str, key: str, amount: Column, name: str, buckets: int
    ) -> None:
        self.table, self.key, self.amount, self.name = table, key, amount, name
        schema = T.StructType.fromDDL(f"{key} long, total {_TOTAL}, amounts long, rows long, run long")
        self.state = BucketState(spark, state_path, schema, [key], buckets)

    def _delta(self, changes: DataFrame) -> DataFrame:
        """(key, total, amounts, rows): what the changes add."""

        def side(row: str, sign: int) -> DataFrame:
            rows = changes.where(F.col(row).isNotNull()).select(f"{row}.*")
            amount = self.amount.cast(_TOTAL)
            return rows.select(
                self.key, (amount * sign).cast(_TOTAL).alias("total"),
                F.when(amount.isNotNull(), F.lit(sign)).otherwise(0).cast("long").alias("amounts"),
                F.lit(sign).cast("long").alias("rows"),
            )

        both = side("old_row", -1).unionByName(side("new_row", 1))
        return both.groupBy(self.key).agg(
            F.coalesce(F.sum("total"), F.lit(0)).cast(_TOTAL).alias("total"), F.sum("amounts").alias("amounts"),
            F.sum("rows").alias("rows"),
        )

    def apply(self, changes: DataFrame, run: int) -> None:
        """Add what the changes of a run differ by. A key that already has the run is left as it is."""
        delta = self._delta(changes)
        buckets = self.state.touched(delta)
        if not buckets:
            return
        # keys without rows go with the next run that comes by, not with the one that emptied them
        old = self.state.read(buckets).where((F.col("rows") != 0) | (F.col("run") == run))
        done = old.where(F.col("run") == run).select(F.col(self.key).alias("done"))
        fresh = delta.join(done, F.col(self.key).eqNullSafe(F.col("done")), "left_anti")
        rows = old.select(*self.state.columns).unionByName(fresh.withColumn("run", F.lit(run).cast("long")))
        self.state.overwrite(
            rows.groupBy(self.key).agg(
                F.sum("total").cast(_TOTAL).alias("total"), F.sum("amounts").alias("amounts"), F.sum("rows").alias("rows"),
                F.max("run").alias("run"),
            )
        )

    def read(self, kind: str) -> DataFrame:
        """(key, balance) as the model has it, the sum as `kind`."""
        total = F.when(F.col("amounts") > 0, F.col("total")).cast(kind)
        return self.state.read().where("rows > 0").select(self.key, total.alias(self.name))


class IncrementalModels:
    """All models over states under `root`, brought up to date by `run` from a dated landing.

    `tables` are the source tables to keep, `buckets` the hash buckets of each state. An event that cannot be ranked, or a
    row with a malformed value that becomes current, fails the run, and the mark stays. Log replay is more lenient in one
    case: a malformed row that a later load corrects fails the run that first sees it.
    """

    def __init__(
        self, spark: SparkSession, landing: DatedLanding, root: str, tables: Iterable[str] = TABLES, buckets: int = 64,
        consumer: str = "models",
    ) -> None:
        self.spark, self.landing, self.root, self.consumer = spark, landing, root, consumer
        self.tables = [t for t in TABLES if t in set(tables)]
        self.states = {
            t: BucketState(spark, f"{root}/state/{t}", self._version_schema(t), ["__key"], buckets) for t in self.tables
        }
        kept = (
            ("int_account_balance", "ledger_entry", "account_id", F.col("signed_amount"), "balance"),
            (
                "int_inventory_balance", "inventory_movement", "product_id", signed_quantity("movement_type", "quantity"),
                "balance_quantity",
            ),
        )
        self.balances = {
            model: Balance(f"{root}/balance/{model}", spark, table, key, amount, name, buckets)
            for model, table, key, amount, name in kept
            if table in self.tables
        }

    def _row_schema(self, table: str) -> T.StructType:
        spec = TABLES[table]
        wire = self.spark.createDataFrame([], T.StructType([T.StructField("__row", spec.wire_schema)]))
        return stage_rows(wire.select(*from_wire(spec, "__row")), spec).schema

    def _version_schema(self, table: str) -> T.StructType:
        return T.StructType([*_META, T.StructField("row", self._row_schema(table))])

    def _new_versions(self, table: str, after: int, upto: int) -> DataFrame:
        """Newest new event per key: its order and the staged row, null for a delete."""
        spec = TABLES[table]
        newest = newest_typed(self.landing.events(table, after, upto), spec)
        live = not_deleted(F.col("__deleted"))
        key = F.coalesce(F.col("__key").cast("string"), F.lit("unknown"))
        error = F.raise_error(F.concat(F.lit(f"malformed value in {table}, key "), key))
        sound = newest.where(F.when(live & F.col("__malformed"), error).otherwise(F.lit(True)))
        meta = [f.name for f in _META]
        # deletes have no row: nothing of theirs is decoded
        rows = sound.withColumn("__live", live).withColumn("__row", F.when(F.col("__live"), F.col("__row")))
        staged = stage_rows(rows.select(*meta, "__live", *from_wire(spec, "__row")), spec, [*meta, "__live"])
        names = [f.name for f in self._row_schema(table).fields]
        return staged.select(*meta, F.when(F.col("__live"), F.struct(*names)).alias("row"))

    def _run_path(self, run: int, name: str) -> str:
        return f"{self.root}/runs/run-{run:012d}/{name}"

    def changes(self, table: str, run: int) -> DataFrame:
        """What a run changed in a table: (__key, order of the new version, old_row, new_row), one row per key."""
        row = self._row_schema(table)
        schema = T.StructType([*_META, T.StructField("old_row", row), T.StructField("new_row", row)])
        return self.spark.read.schema(schema).parquet(self._run_path(run, table))

    def _find_changes(self, table: str, after: int, run: int) -> None:
        state, path = self.states[table], self._run_path(run, f"new-{table}")
        self._new_versions(table, after, run).write.mode("overwrite").option("compression", "zstd").parquet(path)
        new = self.spark.read.schema(self._version_schema(table)).parquet(path)
        old = state.read(state.touched(new)).select("__key", F.struct(*[f.name for f in _META], "row").alias("old"))
        meta = [F.col(f"new.{f.name}").alias(f.name) for f in _META]
        both = new.select("__key", F.struct(*[f.name for f in _META], "row").alias("new")).join(old, "__key", "left")
        changed = both.where(F.col("old").isNull() | newer("new", "old"))
        changed.select(*meta, F.col("old.row").alias("old_row"), F.col("new.row").alias("new_row")).write.mode(
            "overwrite"
        ).option("compression", "zstd").parquet(self._run_path(run, table))
        remove(self.spark, path)  # all of it that counts is in the changes; a run that starts anew makes it anew

    def run(self) -> list[str]:
        """Take in the loads that came since the last run; names the tables that had events."""
        after = self.landing.mark(self.consumer)
        # a run that died after it had found its changes is finished before later loads are looked at
        begun = [int(name.removeprefix("run-")) for name in child_names(self.spark, f"{self.root}/runs")]
        upto = next((n for n in begun if n > after and self._found(n)), self.landing.newest())
        if upto <= after:
            return []
        with freed_shuffles(self.spark):
            held = self.landing.manifest(after, upto).where(F.col("table_name").isin(self.tables))
            names = {r.table_name for r in held.select("table_name").distinct().collect()}
            moved = [t for t in self.tables if t in names]
            if not self._found(upto):
                for table in moved:
                    self._find_changes(table, after, upto)
                self.spark.range(1).write.mode("overwrite").parquet(self._run_path(upto, "found"))
            for table in moved:
                self.apply(table, upto)
        self.landing.advance(self.consumer, upto)
        return moved

    def _found(self, run: int) -> bool:
        return committed(self.spark, self._run_path(run, "found"))

    def apply(self, table: str, run: int) -> None:
        """Bring the balances and versions of a table to what the run found. Repeating it is harmless."""
        changes = self.changes(table, run)
        for balance in self.balances.values():
            if balance.table == table:
                balance.apply(changes, run)
        self.states[table].upsert(changes.withColumnRenamed("new_row", "row").drop("old_row"))

    def expire_runs(self) -> list[int]:
        """Remove what finished runs found; the newest stays. Says which went."""
        done = self.landing.mark(self.consumer)
        names = child_names(self.spark, f"{self.root}/runs")
        gone = [n for n in (int(name.removeprefix("run-")) for name in names) if n < done]
        for run in gone:
            remove(self.spark, f"{self.root}/runs/run-{run:012d}")
        return gone

    def expire_deletes(self, table: str, before_lsn: int) -> list[int]:
        """Forget deleted keys whose delete is older than a low-water LSN, below which no event can come any more."""
        keep = F.col("row").isNotNull() | F.col("__lsn").isNull() | (F.col("__lsn") >= before_lsn)
        return self.states[table].prune(keep)

    def staged(self, table: str) -> DataFrame:
        """The staging model of a table, from its state."""
        return self.states[table].read().where(F.col("row").isNotNull()).select("row.*")

    def models(self) -> Models:
        """All models over the kept tables. Staging reads states, balances are the stored ones; no event is read."""

        def refuse(table: str) -> DataFrame:
            raise KeyError(f"{table} is not kept")

        models = Models(self.spark, refuse)
        for table in self.tables:
            models.replace(f"stg_{table}", self.staged(table))
        for model, balance in self.balances.items():
            kind = models[model].schema[balance.name].dataType.simpleString()
            models.replace(model, balance.read(kind))
        return models
