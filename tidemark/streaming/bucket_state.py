"""Keyed state in hash buckets: a run reads and rewrites the buckets its keys fall in, and no others.

The bucket of a key is a partition folder, so it prunes reads, and Spark's dynamic partition overwrite replaces whole buckets
when a job commits. A run that touches few keys costs the buckets they are in; the state never grows by folders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import path_exists

BUCKET = "__bucket"


class BucketState:
    """Rows by key under `path`. The number of buckets is part of the path: another number is another state.

    Choose it so that a bucket is what one task writes well, about 256 MB; keys are dealt by hash, so buckets are even.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int = 64
    ) -> None:
        self.spark = spark
        self.path = f"{path}/buckets-{buckets}"
        self.keys = list(keys)
        self.buckets = buckets
        self.columns = [f.name for f in schema.fields]
        self.schema = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])

    def bucket(self, keys: Sequence[str | Column] | None = None) -> Column:
        return F.pmod(F.xxhash64(*(keys or self.keys)), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets that the keys of `rows` fall in: at most as many numbers as there are buckets."""
        return sorted(r[0] for r in rows.select(self.bucket().alias(BUCKET)).distinct().collect())

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """The rows, with their bucket; of some buckets only, if given."""
        if not path_exists(self.spark, self.path):
            # false as a plan: a join with a state that is not there yet is planned away, and shuffles nothing
            return self.spark.createDataFrame([], self.schema).where("false")
        rows = self.spark.read.schema(self.schema).parquet(self.path)
        return rows if buckets is None else rows.where(F.col(BUCKET).isin(list(buckets)))

    def overwrite(self, rows: DataFrame) -> None:
        """Replace the buckets that `rows` fall in by `rows`, which must hold all that is to stay in them."""
        dealt = rows.select(*self.columns, self.bucket().alias(BUCKET))
        # one file for each bucket, more where adaptive execution finds it large
        dealt.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, *self.keys).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).option("compression", "zstd").partitionBy(BUCKET).parquet(self.path)

    def upsert(self, rows: DataFrame) -> list[int]:
        """Put rows, one per key, in place of those with their keys; says which buckets were rewritten. Repeating it is harmless."""
        buckets = self.touched(rows)
        if buckets:
            same = [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in self.keys]
            new = rows.select(*self.columns)
            kept = self.read(buckets).alias("old").join(new.select(*self.keys).alias("new"), same, "left_anti")
            self.overwrite(kept.select(*self.columns).unionByName(new))
        return buckets

    def prune(self, keep: Column) -> list[int]:
        """Rewrite the buckets with rows that `keep` is not true for, without them; says which.

        A bucket that would be left empty stays as it is, since an overwrite by nothing replaces nothing.
        """
        rows = self.read()
        gone = sorted(r[0] for r in rows.where(~F.coalesce(keep, F.lit(False))).select(BUCKET).distinct().collect())
        if gone:
            some = self.read(gone)
            left = some.where(keep)
            full = [r[0] for r in left.select(BUCKET).distinct().collect()]
            gone = [b for b in gone if b in full]
            if gone:
                self.overwrite(left.where(F.col(BUCKET).isin(gone)))
        return gone
