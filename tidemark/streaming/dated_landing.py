"""Landing by load, table and day, with a stored high-water mark for each consumer.

A drain writes every micro-batch to a folder of its own, `__load=<n>`, split by table and by day of arrival. What each load
holds is written down in a manifest. A consumer keeps the last load it has finished with; its next run opens the folders of
later loads, of the tables it wants, and lists no others, however long the history. Days serve range reads and expiry.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import child_names, committed, constant_rows, open_writers, remove, whole_payloads
from tidemark.sources.landing import LANDING_SCHEMA, parse_landing
from tidemark.sources.registry import ARRIVAL
from tidemark.streaming.drain import finish

DATED_SCHEMA = T.StructType(
    [
        *LANDING_SCHEMA.fields,
        T.StructField("__date", T.DateType()),
        T.StructField("__load", T.LongType()),
    ]
)
MANIFEST_SCHEMA = "load long, table_name string, day date, events long"


class DatedLanding:
    """A landing under `root`: `events`, the manifest `loads`, and the `marks` of its consumers."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.events_path = f"{root}/events"
        self.loads_path = f"{root}/loads"
        self.marks_path = f"{root}/marks"

    def write(self, raw: DataFrame, load: int) -> None:
        """Land one batch of event text as load `load`; a repeated batch replaces its own folder."""
        path = f"{self.events_path}/__load={load}"
        rows = parse_landing(raw).withColumn("__date", F.to_date(ARRIVAL))
        with open_writers(raw.sparkSession), whole_payloads(raw.sparkSession):
            rows.write.mode("overwrite").option("compression", "zstd").partitionBy("__table", "__date").parquet(path)
        held = self._read([path]).groupBy("__load", "__table", "__date").agg(F.count("*").alias("events"))
        held.select(
            F.col("__load").alias("load"), F.col("__table").alias("table_name"), F.col("__date").alias("day"), "events"
        ).write.mode("overwrite").parquet(f"{self.loads_path}/load-{load:012d}")

    def drain(self, raw: DataFrame, checkpoint_path: str) -> None:
        """Land what the stream of event text has not yet delivered, and stop. Loads go by the stream's batch ids."""
        query = (
            raw.writeStream.foreachBatch(self.write)
            .option("checkpointLocation", checkpoint_path)
            .trigger(availableNow=True)
            .start()
        )
        finish(query)

    def _read(self, paths: list[str]) -> DataFrame:
        reader = self.spark.read.schema(DATED_SCHEMA).option("basePath", self.events_path)
        return reader.parquet(*paths)

    def _loads(self) -> list[int]:
        """Finished loads, oldest first."""
        names = child_names(self.spark, self.loads_path)
        return [int(n.removeprefix("load-")) for n in names if committed(self.spark, f"{self.loads_path}/{n}")]

    def newest(self) -> int:
        """The last finished load, -1 before the first."""
        names = child_names(self.spark, self.loads_path)
        for name in reversed(names):
            if committed(self.spark, f"{self.loads_path}/{name}"):
                return int(name.removeprefix("load-"))
        return -1

    def manifest(self, after: int = -1, upto: int | None = None) -> DataFrame:
        """(load, table_name, day, events) of the loads in (after, upto]."""
        loads = [n for n in self._loads() if n > after and (upto is None or n <= upto)]
        if not loads:
            return constant_rows(self.spark, [], MANIFEST_SCHEMA)
        return self.spark.read.schema(MANIFEST_SCHEMA).parquet(*[f"{self.loads_path}/load-{n:012d}" for n in loads])

    def events(self, table: str, after: int = -1, upto: int | None = None, since: dt.date | None = None) -> DataFrame:
        """Landed events of one table in the loads (after, upto], from day `since` on; only their folders are opened."""
        held = self.manifest(after, upto).where(F.col("table_name") == table)
        if since is not None:
            held = held.where(F.col("day") >= F.lit(since))
        # one number for each new load
        loads = sorted(r.load for r in held.select("load").distinct().collect())
        if not loads:
            return self.spark.createDataFrame([], DATED_SCHEMA)
        found = self._read([f"{self.events_path}/__load={n}/__table={table}" for n in loads])
        return found if since is None else found.where(F.col("__date") >= F.lit(since))

    def mark(self, consumer: str) -> int:
        """The last load that the consumer has finished with, -1 before its first."""
        path = f"{self.marks_path}/{consumer}"
        done = [n for n in child_names(self.spark, path) if committed(self.spark, f"{path}/{n}")]
        return int(done[-1].removeprefix("load-")) if done else -1

    def advance(self, consumer: str, load: int) -> None:
        """Record that the consumer has finished with everything up to `load`."""
        row = constant_rows(self.spark, [(consumer, load)], "consumer string, load long")
        row.write.mode("overwrite").parquet(f"{self.marks_path}/{consumer}/load-{load:012d}")

    def expire(self, before: dt.date, consumers: Iterable[str]) -> list[int]:
        """Remove loads whose every event arrived before a day and that all consumers have finished with; says which.

        Of the marks of a consumer only the newest stays.
        """
        done = min((self.mark(c) for c in consumers), default=-1)
        last = self.manifest(upto=done).groupBy("load").agg(F.max("day").alias("last"))
        gone = sorted(r.load for r in last.where(F.col("last") < F.lit(before)).collect())
        for load in gone:
            # the manifest goes first: a load that is not in it is not read
            remove(self.spark, f"{self.loads_path}/load-{load:012d}")
            remove(self.spark, f"{self.events_path}/__load={load}")
        for consumer in consumers:
            for name in child_names(self.spark, f"{self.marks_path}/{consumer}")[:-1]:
                remove(self.spark, f"{self.marks_path}/{consumer}/{name}")
        return gone
