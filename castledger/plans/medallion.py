"""One full run: raw files to bronze, checks, silver, gold, checks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from castledger.operators import quality
from castledger.operators.intermediate import MONTH
from castledger.operators.marts import FinanceParams
from castledger.plans.models import INTERMEDIATE, MARTS, STAGING, Models
from castledger.sources import bronze
from castledger.sources.bronze import Layers
from castledger.sources.registry import TABLES, TableSpec

# Stored tables keep rows near their reading order; no global sort is stored.
_READING_ORDER = {
    "dim_historico_custos": ["produto_id", "valid_from"],
    "mart_dre_mensal": MONTH,
    "mart_kpis_executivo": MONTH,
    "mart_margem_produto": [*MONTH, "ranking_margem_mes"],
    "mart_orcado_realizado": [*MONTH, "natureza"],
}
_DESCRIPTIONS = {
    "dim_historico_custos": "Standard cost versions with validity interval",
    "mart_dre_mensal": "Monthly income statement, gross revenue to net profit",
    "mart_kpis_executivo": "Executive indicators: MoM, YoY and year to date",
    "mart_margem_produto": "Margin, rank and revenue share per product and month",
    "mart_orcado_realizado": "Budget against actual per month and nature",
}
TABLE_MODELS = ("dim_historico_custos", *MARTS)


def ordered(spark: SparkSession, name: str, layers: Layers = Layers()) -> DataFrame:
    """A stored table in its reading order."""
    schema = layers.silver if name == "dim_historico_custos" else layers.gold
    return spark.table(f"{schema}.{name}").orderBy(*_READING_ORDER[name])


def _store(spark: SparkSession, models: Models, name: str, schema: str) -> None:
    """Write a model and note what its column checks found in the rows written."""
    table = f"{schema}.{name}"
    rows = models.get(name).sortWithinPartitions(*_READING_ORDER[name])
    rows, found = quality.observed(rows, name)
    bronze.write_table(spark, rows, table, _DESCRIPTIONS[name])
    models.store(name, spark.table(table))
    models.findings[name] = found.get


#: What every join of sales with costs meets on.
PRODUCT_MONTH = ("produto_id", "ano", "mes")
BUCKETED = {"stg_vendas": "Cleaned sales by product and month", "stg_custos": "Cleaned unit costs by product and month"}


def store_bucketed(spark: SparkSession, models: Models, buckets: int, layers: Layers = Layers()) -> None:
    """Store cleaned sales and costs in buckets of product and month. The models
    built on them fold sales and join costs without another exchange, and the
    raw sales are cleaned once instead of once per model."""
    for name, description in BUCKETED.items():
        table = f"{layers.silver}.{name}"
        bronze.write_bucketed(spark, models.get(name), table, description, PRODUCT_MONTH, buckets)
        models.store(name, spark.table(table))


def build(spark: SparkSession, layers: Layers = Layers(),
          params: FinanceParams = FinanceParams(), buckets: int | None = None) -> Models:
    """Silver views and gold tables from bronze.

    Models that are tables are written and read back before anything is built
    on them, so the KPI table does not recompute the income statement. With
    ``buckets``, cleaned sales and costs are stored too (``store_bucketed``).
    """
    layers.create(spark)
    models = Models(bronze.bronze_source(spark, layers), params)
    if buckets:
        store_bucketed(spark, models, buckets, layers)
    for name in (*STAGING, *INTERMEDIATE):
        if name in TABLE_MODELS:
            _store(spark, models, name, layers.silver)
        else:
            models.get(name).createOrReplaceTempView(name)
    for name in MARTS:
        _store(spark, models, name, layers.gold)
    return models


def check(models: Models) -> DataFrame:
    """Every declared check on every model, as one report. Column checks of stored
    models were made by the jobs that wrote them; the others take one pass each."""
    return quality.union_all([
        quality.column_checks(models.get, models.findings),
        quality.dq_unique(models.get), quality.dq_relationships(models.get)])


def run(spark: SparkSession, folder: str, layers: Layers = Layers(),
        params: FinanceParams = FinanceParams(), loaded_at: dt.datetime | None = None,
        tables: Iterable[TableSpec] = TABLES, buckets: int | None = None) -> Models:
    """Load, validate, build. Raises if bronze validation finds a failure."""
    tables = list(tables)
    bronze.ingest(spark, folder, layers, loaded_at, tables)
    quality.assert_valid(quality.validate_bronze(bronze.bronze_source(spark, layers), tables))
    return build(spark, layers, params, buckets)
