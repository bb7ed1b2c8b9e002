"""Rebuild only the months of the monthly models that new batches touched.

Every monthly model depends, within a month, on raw rows of that month and on
master data. So the months of all batches not built yet are computed from the
month partitions of the raw tables alone and replace those partitions of the
models. The executive indicators look back over the calendar, but read one row
per month: they are derived from the stored income statement when asked for.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from castledger.functions.expr import first_of_month
from castledger.operators.marts import FinanceParams, mart_kpis_executivo
from castledger.plans.models import Models
from castledger.sources.bronze import PART_MONTH
from castledger.streaming.upsert import MonthStore, exists, in_months, overwrite_months

#: In the order in which they are built: later ones read earlier ones back.
MONTHLY = ("int_receita_liquida", "int_cmv_mensal", "int_despesas_dre", "mart_dre_mensal",
           "mart_margem_produto", "mart_orcado_realizado")
#: Raw tables without a month partition that have the month in two numbers.
BY_YEAR_AND_MONTH = ("raw_orcamento",)


class MonthlyModels:
    """Stored monthly models below ``folder``, over upserted raw tables.

    ``masters`` returns the raw tables that are not upserted (master data and
    budgets) by name; after one of them has changed, call ``rebuild_for``.
    """

    def __init__(self, spark: SparkSession, folder: str, stores: Iterable[MonthStore],
                 masters: Callable[[str], DataFrame], params: FinanceParams = FinanceParams()):
        self.spark = spark
        self.folder = folder
        self.stores = {store.spec.table: store for store in stores}
        self.masters = masters
        self.params = params

    def _path(self, model: str) -> str:
        return f"{self.folder}/{model}"

    def _built(self) -> set[tuple[str, str]]:
        folder = f"{self.folder}/_built"
        if not exists(self.spark, folder):
            return set()
        return {tuple(r) for r in self.spark.read.schema("tabela string, batch string").parquet(folder).collect()}

    def refresh(self) -> list[dt.date]:
        """Build the months of all batches that count and are not built yet. A
        refresh that fails is repeated by the next one: its batches are noted last."""
        built = self._built()
        pending = {(table, batch): months for table, store in self.stores.items()
                   for batch, months in store.logged(self.spark).items() if (table, batch) not in built}
        if not pending:
            return []
        months = sorted({m for touched in pending.values() for m in touched if m is not None})
        self.rebuild(months)
        self.spark.createDataFrame(list(pending), "tabela string, batch string").coalesce(1).write.mode(
            "append").parquet(f"{self.folder}/_built")
        return months

    def rebuild(self, months: list[dt.date]) -> None:
        if not months:
            return
        models = Models(lambda table: self._source(table, months), self.params)
        for name in MONTHLY:
            # adaptive execution cuts a big month into several files
            rows = models.get(name).withColumn(PART_MONTH, first_of_month("ano", "mes")).hint("rebalance", PART_MONTH)
            overwrite_months(self.spark, rows, self._path(name), months)
            models.store(name, self._stored(name, rows.schema).where(in_months(months)).drop(PART_MONTH))

    def rebuild_for(self, table: str) -> list[dt.date]:
        """Build what a changed master table reaches: the months a budget plans,
        else all months of the upserted tables."""
        if table in BY_YEAR_AND_MONTH:
            held = self.masters(table).select(first_of_month("ano", "mes").alias("month"))
        else:
            held = reduce(DataFrame.union, (s.rows(self.spark).select(F.col(PART_MONTH).alias("month"))
                                            for s in self.stores.values()))
        months = sorted(r["month"] for r in held.where("month is not null").distinct().collect())
        self.rebuild(months)
        return months

    def _source(self, table: str, months: list[dt.date]) -> DataFrame:
        if table in self.stores:
            return self.stores[table].rows(self.spark).where(in_months(months)).drop(PART_MONTH)
        rows = self.masters(table)
        if table in BY_YEAR_AND_MONTH:
            day = first_of_month("ano", "mes")
            return rows.where(day.isin(months))
        return rows

    def _stored(self, model: str, schema=None) -> DataFrame:
        reader = self.spark.read.schema(schema) if schema is not None else self.spark.read
        return reader.parquet(self._path(model))

    def get(self, model: str) -> DataFrame:
        """A stored model, or the indicators derived from the income statement."""
        if model == "mart_kpis_executivo":
            return mart_kpis_executivo(self.get("mart_dre_mensal"))
        return self._stored(model).drop(PART_MONTH)
