"""Load-test reconciliation: state of a key range, operation counts, assertions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import constant_rows, fresh_dir

# --- fixed value: ids shown as a sample of the missing ones ---
SAMPLE_SIZE = 25
# --- end of fixed value ---


def key_range(rows: DataFrame, key: str) -> tuple[int, int]:
    """Smallest and largest key, from an aggregate (two numbers reach the driver)."""
    low, high = rows.agg(F.min(key), F.max(key)).first()
    return (0, -1) if low is None else (low, high)


def present_ids(state: DataFrame, key: str, first: int, last: int) -> DataFrame:
    return state.where(F.col(key).between(first, last)).select(key).distinct()


def missing_intervals(state: DataFrame, key: str, first: int, last: int) -> DataFrame:
    """(first_id, last_id): the gaps between the ids of the range that are there, as intervals.

    The work goes with the ids that are there, however long the range. They are dealt by range; inside one, a window sees the
    next id, and the edges of the ranges, one row each, are put together once more. An empty range of ids has no gaps.
    """
    dealt = present_ids(state, key, first, last).select(F.col(key).cast("long").alias("id")).repartitionByRange("id")
    path = fresh_dir(state.sparkSession, "ids")
    dealt.withColumn("range", F.spark_partition_id()).write.parquet(path)
    ids = state.sparkSession.read.schema("id long, range int").parquet(path)
    inside = ids.select("id", F.lead("id").over(Window.partitionBy("range").orderBy("id")).alias("next"))
    edges = ids.groupBy("range").agg(F.min("id").alias("low"), F.max("id").alias("high")).select("low", "high")
    # beyond both ends of the range stands an id that is there
    ends = constant_rows(state.sparkSession, [(first - 1, first - 1), (last + 1, last + 1)], "low long, high long")
    across = edges.unionByName(ends).select(
        F.col("high").alias("id"), F.lead("low").over(Window.orderBy("low")).alias("next")
    )
    gaps = inside.unionByName(across).where(F.col("next") - F.col("id") > 1)
    return gaps.select((F.col("id") + 1).alias("first_id"), (F.col("next") - 1).alias("last_id"))


def missing_ids(state: DataFrame, key: str, first: int, last: int, piece: int = 65_536) -> DataFrame:
    """Ids of the range that the state lacks: its gaps, spelled out in pieces, so that a long gap is no long array."""
    pieces = missing_intervals(state, key, first, last).select(
        F.explode(F.sequence("first_id", "last_id", F.lit(piece).cast("long"))).alias("low"), "last_id"
    )
    dealt = pieces.repartition("low")
    return dealt.select(
        F.explode(F.sequence("low", F.least("last_id", F.col("low") + (piece - 1)))).alias(key)
    )


def missing_ids_sample(state: DataFrame, key: str, first: int, last: int, size: int = SAMPLE_SIZE) -> DataFrame:
    """The smallest missing ids: those of as many gaps at most."""
    gaps = missing_intervals(state, key, first, last).orderBy("first_id").limit(size)
    ids = F.explode(F.sequence("first_id", F.least("last_id", F.col("first_id") + (size - 1))))
    return gaps.select(ids.alias(key)).orderBy(key).limit(size)


def reconcile_snapshot(
    state: DataFrame, key: str, first: int, last: int, updated: Column, deleted_first: int, deleted_last: int
) -> DataFrame:
    """One row on a key range: totals, duplicates, updated rows, deleted rows left, missing ids.

    `updated` marks rows that carry the update; ids from `deleted_first` to
    `deleted_last` are expected to be gone. Duplicates are total less distinct,
    from counts per key, so no key is hot.
    """
    in_range = state.where(F.col(key).between(first, last))
    per_key = in_range.groupBy(key).agg(F.count("*").alias("n"), F.count_if(updated).alias("u"))
    gone = F.col(key).between(deleted_first, deleted_last)
    found = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
        F.count("*").alias("distinct_ids"),
        F.coalesce(F.sum("u"), F.lit(0)).alias("updated_records"),
        F.coalesce(F.sum(F.when(gone, F.col("n"))), F.lit(0)).alias("deleted_records_remaining"),
        F.count_if(~gone).alias("survivors"),
    )
    size = last - first + 1
    kept = size - max(0, min(last, deleted_last) - max(first, deleted_first) + 1)
    return found.select(
        "total_records",
        "distinct_ids",
        (F.col("total_records") - F.col("distinct_ids")).alias("duplicate_primary_keys"),
        "updated_records",
        "deleted_records_remaining",
        (F.lit(size) - F.col("distinct_ids")).cast("bigint").alias("missing_count"),
        (F.lit(kept) - F.col("survivors")).cast("bigint").alias("missing_surviving_count"),
    )


def op_counts(landing: DataFrame, op: str = "__op") -> DataFrame:
    """Events per operation; a missing operation counts as `<NULL>`."""
    label = F.coalesce(F.col(op), F.lit("<NULL>")).alias("operation")
    return landing.groupBy(label).agg(F.count("*").alias("event_count"))


def op_count_delta(current: DataFrame, baseline: DataFrame) -> DataFrame:
    """Change of each count; an operation on one side only counts 0 on the other."""
    zero = F.lit(0)
    now = current.select("operation", F.col("event_count").alias("now"))
    then = baseline.select("operation", F.col("event_count").alias("then"))
    delta = F.coalesce("now", zero) - F.coalesce("then", zero)
    return now.join(then, "operation", "full").select("operation", delta.cast("bigint").alias("delta"))


def survivor_difference(
    state: DataFrame, key: str, first: int, last: int, deleted_first: int, deleted_last: int
) -> DataFrame:
    """Ids that should have survived and did not (`missing`), and the reverse (`unexpected`)."""
    gone = F.col(key).between(deleted_first, deleted_last)
    # the ids on both sides of the deleted range, each a range of its own
    sides = ((first, min(last, deleted_first - 1)), (max(first, deleted_last + 1), last))
    missing = reduce(DataFrame.unionByName, [missing_ids(state, key, low, high) for low, high in sides if low <= high] or [
        present_ids(state, key, first, last).where("false")
    ])
    # Within the range, an id outside the expected set is one that lies in the deleted range.
    unexpected = present_ids(state, key, first, last).where(gone).withColumn("difference", F.lit("unexpected"))
    return missing.withColumn("difference", F.lit("missing")).unionByName(unexpected)


def survivor_equality(
    state: DataFrame, key: str, first: int, last: int, deleted_first: int, deleted_last: int
) -> DataFrame:
    """One row: how many ids differ each way, and whether the sets are equal. One pass over the state."""
    never = F.lit(False)
    snapshot = reconcile_snapshot(
        present_ids(state, key, first, last), key, first, last, never, deleted_first, deleted_last
    )
    missing, unexpected = F.col("missing_surviving_count"), F.col("deleted_records_remaining")
    return snapshot.select(
        missing.alias("missing"),
        unexpected.alias("unexpected"),
        ((missing == 0) & (unexpected == 0)).alias("is_equal"),
    )


def insert_complete(expected: int | Column) -> Column:
    """Over a snapshot: whether all inserts have arrived, each once."""
    return (
        (F.col("total_records") == expected)
        & (F.col("distinct_ids") == expected)
        & (F.col("missing_count") == 0)
        & (F.col("duplicate_primary_keys") == 0)
    )


def mixed_complete(expected: int | Column, updated: int | Column) -> Column:
    """Over a snapshot: whether updates and deletes have arrived and exactly the survivors are left."""
    return (
        (F.col("total_records") == expected)
        & (F.col("distinct_ids") == expected)
        & (F.col("duplicate_primary_keys") == 0)
        & (F.col("updated_records") == updated)
        & (F.col("deleted_records_remaining") == 0)
        & (F.col("missing_surviving_count") == 0)
    )


def cleanup_complete(source_deleted: int | Column, delete_delta: Column) -> Column:
    """Over a snapshot: whether nothing is left and every delete at the source has landed."""
    return (F.col("total_records") == 0) & (delete_delta >= source_deleted)


def observations(one_row: DataFrame) -> DataFrame:
    """The columns of a one-row result as rows of name and actual value."""
    pairs = [
        F.struct(F.lit(c).alias("name"), F.col(c).cast("bigint").alias("actual")) for c in one_row.columns
    ]
    return one_row.select(F.inline(F.array(*pairs)))


def side_by_side(one_rows: Sequence[DataFrame]) -> DataFrame:
    """One row of the columns of several one-row results, by a union and an aggregate: no join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), one_rows)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def expectations(spark: SparkSession, fixed: Mapping[str, int]) -> DataFrame:
    """Expected values that do not depend on the data, as rows of name and expected."""
    return constant_rows(spark, fixed.items(), "name string, expected bigint")


def assertions(observed: DataFrame, expected: DataFrame, counted: str = "landing_") -> DataFrame:
    """A row per expectation (name, expected) with its outcome.

    Operation counts, named with the prefix `counted`, are 0 where an operation
    has not landed. Anything else that was not observed fails, and so does an
    expectation without a value.
    """
    absent = F.when(F.col("name").startswith(counted), F.lit(0)).cast("bigint")
    actual = F.coalesce(F.col("actual"), absent)
    passed = F.coalesce(actual == F.col("expected"), F.lit(False))
    return expected.join(observed, "name", "left").select(
        "name", actual.alias("actual"), "expected", passed.alias("passed")
    )


def report_status(outcomes: DataFrame) -> DataFrame:
    """PASSED when every assertion holds."""
    return outcomes.agg(
        F.count("*").alias("assertions"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.when(F.bool_and("passed"), "PASSED").otherwise("FAILED").alias("status"),
    )


def throughput(count: Column, seconds: Column) -> Column:
    """Records per second; an elapsed time of nothing counts as one nanosecond."""
    return count / F.greatest(seconds, F.lit(1e-9))
