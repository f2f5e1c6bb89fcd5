"""All models by name, each built lazily from the ones it reads."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import marts
from tidemark.plans.staging import stage
from tidemark.session import freed_shuffles
from tidemark.sources.registry import TABLES

Builder = Callable[["Models"], DataFrame]

STAGING = tuple(f"stg_{table}" for table in TABLES)
INTERMEDIATE = ("int_account_balance", "int_inventory_balance")
DIMENSIONS = ("dim_customer", "dim_supplier", "dim_product", "dim_date", "dim_account", "dim_card")
FACTS = (
    "fact_sales",
    "fact_purchases",
    "fct_inventory_movements",
    "fct_ledger_entries",
    "fct_transactions",
    "fct_receivables",
    "fct_payables",
)
MARTS = DIMENSIONS + FACTS

_BUILDERS: dict[str, Builder] = {
    "int_account_balance": lambda m: marts.int_account_balance(m["stg_ledger_entry"]),
    "int_inventory_balance": lambda m: marts.int_inventory_balance(m["stg_inventory_movement"]),
    "dim_customer": lambda m: m["stg_customer"],
    "dim_supplier": lambda m: m["stg_supplier"],
    "dim_card": lambda m: m["stg_card"],
    "dim_product": lambda m: marts.dim_product(m["stg_product"], m["int_inventory_balance"]),
    "dim_date": lambda m: marts.dim_date(m.spark),
    "dim_account": lambda m: marts.dim_account(m["stg_account"], m["int_account_balance"]),
    "fact_sales": lambda m: marts.fact_sales(m["stg_sales_invoice_item"], m["stg_sales_invoice"]),
    "fact_purchases": lambda m: marts.fact_purchases(m["stg_purchase_bill_item"], m["stg_purchase_bill"]),
    "fct_inventory_movements": lambda m: marts.fct_inventory_movements(m["stg_inventory_movement"]),
    "fct_ledger_entries": lambda m: marts.fct_ledger_entries(m["stg_ledger_entry"]),
    "fct_transactions": lambda m: marts.fct_transactions(
        m["stg_financial_transaction"], m["stg_ledger_entry"]
    ),
    "fct_receivables": lambda m: marts.fct_receivables(
        m["stg_sales_invoice"], m["stg_financial_transaction"]
    ),
    "fct_payables": lambda m: marts.fct_payables(m["stg_purchase_bill"], m["stg_financial_transaction"]),
}


class Models:
    """`models["fact_sales"]` is a DataFrame; nothing runs until it is used.

    `landing_of(table)` gives the landed events of one source table: a written
    landing filtered by partition, or any other source.
    """

    def __init__(self, spark: SparkSession, landing_of: Callable[[str], DataFrame]) -> None:
        self.spark = spark
        self._landing_of = landing_of
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            if name in STAGING:
                table = name.removeprefix("stg_")
                self._built[name] = stage(self._landing_of(table), table)
            else:
                self._built[name] = _BUILDERS[name](self)
        return self._built[name]

    def replace(self, name: str, rows: DataFrame) -> None:
        """Later models read `rows` in place of the model's plan."""
        self._built[name] = rows

    def views(self, names: Iterable[str] = STAGING + INTERMEDIATE) -> None:
        """Register models as temporary views, evaluated when read."""
        for name in names:
            self[name].createOrReplaceTempView(name)

    def materialize(self, root: str, names: Iterable[str] = MARTS, threads: int = 2) -> None:
        """Write models as parquet tables; models built later read the written ones.

        Staging models do not depend on each other, nor do the rest, so each of
        the two groups is submitted from two threads and shares the executors:
        one is deriving while the other ends. Each holds all it has shuffled until
        its model is written, so more threads hold more on disk and gain little time.
        """

        def write(name: str) -> tuple[str, DataFrame]:
            path = f"{root}/{name}"
            self[name].write.mode("overwrite").option("compression", "zstd").parquet(path)
            return name, self.spark.read.schema(self[name].schema).parquet(path)

        wanted = list(names)
        staging = [name for name in wanted if name in STAGING]
        for group in (staging, [name for name in wanted if name not in STAGING]):
            for name in group:
                self[name]  # plans are made here, one at a time
            with freed_shuffles(self.spark), ThreadPoolExecutor(threads) as pool:
                for name, written in pool.map(write, group):
                    self.replace(name, written)


def save_bucketed(rows: DataFrame, table: str, keys: list[str], buckets: int, path: str) -> None:
    """Write a model bucketed by key, so joins on that key read it without a shuffle."""
    (
        rows.write.mode("overwrite")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .option("path", path)
        .saveAsTable(table)
    )
