"""Current state kept by micro-batches in key buckets.

The same merge as `state_log`, with another trade: a batch rewrites the buckets that its keys fall in, so reading ranks
nothing, the state has as many folders as buckets for ever, and deletes can be forgotten. It suits tables whose batches touch
a small part of the buckets, or that are read more often than written; the log suits wide batches that are read rarely.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.latest import latest_per_key, merge_source
from tidemark.sources.registry import select_tables
from tidemark.streaming.bucket_state import BucketState
from tidemark.streaming.drain import change_stream, finish
from tidemark.streaming.state_log import MERGE_ORDER


class BucketMerge:
    """Keyed state of one table; rules as in `StateLog`.

    Without `guard` a later batch wins whatever its LSNs, with it the higher LSN wins. Deletes stay as rows until
    `forget_deletes`, else a late older change would revive a guarded key.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], guard: bool = False,
        buckets: int = 64,
    ) -> None:
        self.keys, self.guard = list(keys), guard
        self.columns = [f.name for f in schema.fields]
        self.state = BucketState(spark, path, T.StructType([*schema.fields, *MERGE_ORDER.fields]), keys, buckets)

    def _order(self) -> list[Column]:
        batch = F.col("__batch").desc()
        if not self.guard:
            return [batch]
        return [F.col("__lsn").desc_nulls_last(), F.col("__source_ts_ms").desc_nulls_last(), batch]

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Merge one batch; the function for `foreachBatch`. A repeated batch leaves the same state."""
        newest = merge_source(batch, self.keys).where(F.col("is_deleted").isNotNull())
        # the batch is read once: it is narrowed to its newest changes, which are used three times
        changes = newest.select(
            *self.columns, "__lsn", "__source_ts_ms", "is_deleted", F.lit(batch_id).cast("bigint").alias("__batch")
        ).persist()
        try:
            buckets = self.state.touched(changes)
            if buckets:
                old = self.state.read(buckets).select(*self.state.columns)
                self.state.overwrite(latest_per_key(old.unionByName(changes), self.keys, self._order()))
        finally:
            changes.unpersist()

    def read(self) -> DataFrame:
        """Current rows."""
        return self.state.read().where(~F.col("is_deleted")).select(*self.columns)

    def forget_deletes(self, before_lsn: int) -> list[int]:
        """Drop deletes below a low-water LSN, under which no event can come any more; says which buckets were rewritten."""
        old_delete = F.col("is_deleted") & F.coalesce(F.col("__lsn") < before_lsn, F.lit(False))
        return self.state.prune(~old_delete)


def merge_tables_by_bucket(
    spark: SparkSession, landing_root: str, state_root: str, checkpoint_root: str, names: Iterable[str] | None = None,
    guard: bool = False, buckets: int = 64,
) -> dict[str, BucketMerge]:
    """Drain the typed landing of each table into its bucketed state; the tables' streams run side by side."""
    states, queries = {}, []
    for spec in select_tables(names):
        columns = T.StructType([f for f in spec.landing_schema.fields if f.name in spec.all_columns])
        states[spec.name] = BucketMerge(spark, f"{state_root}/{spec.name}", columns, [spec.primary_key], guard, buckets)
        queries.append(
            change_stream(spark, f"{landing_root}/{spec.name}", spec.landing_schema)
            .writeStream.foreachBatch(states[spec.name].apply)
            .option("checkpointLocation", f"{checkpoint_root}/{spec.name}")
            .trigger(availableNow=True)
            .start()
        )
    for query in queries:
        finish(query)
    return states
