"""Registered queries: ``name -> (spark, folder) -> DataFrame`` on the test tables.

Outputs are normalised for comparison: decimals as DOUBLE, integers as BIGINT.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from castledger.operators import intermediate, planning, quality, reports, scd2, sketches, staging
from castledger.plans.models import INTERMEDIATE, MARTS, STAGING, Models
from castledger.plans.refresh import MonthlyModels
from castledger.session import shared_folder
from castledger.sources import bronze, quarantine
from castledger.sources.registry import INGESTED_AT, SPECS
from castledger.sources.testdata import BASE_YEAR, TestData
from castledger.streaming.history import HistoryStore
from castledger.streaming.upsert import MonthStore, apply_batch, upsert_new_files

Query = Callable[[SparkSession, str], DataFrame]

# Rates and factors the planning queries use.
LINKED_RATES = {"Comissões sobre Vendas": "0.0215", "Fretes sobre Vendas": "0.0160"}
PAYROLL_STAND_IN = "1-URGENT"
FIXED_STAND_IN = "4-NOT"


def flat(df: DataFrame) -> DataFrame:
    def out(f: T.StructField):
        if isinstance(f.dataType, T.DecimalType):
            return F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            return F.col(f.name).cast("bigint").alias(f.name)
        return F.col(f.name)

    return df.select(*[out(f) for f in df.schema if f.name != INGESTED_AT])


def models(spark: SparkSession, folder: str) -> Models:
    return Models(TestData(spark, folder).raw)


def _model(name: str) -> Query:
    return lambda spark, folder: models(spark, folder).get(name)


def _on(name: str, report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: report(models(spark, folder).get(name))


# -- variants of the sources that exercise failing checks ------------------

def _repeating_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Sales whose id is order and line number, which repeats in the data."""
    return TestData(spark, folder).raw_vendas(line_key_only=True).withColumn(
        INGESTED_AT, F.current_timestamp())


def _with_repeats(spark: SparkSession, folder: str):
    m = models(spark, folder)
    repeated = _repeating_sales(spark, folder)
    m.store("raw_vendas", repeated)
    return m.get


def _with_orphans(spark: SparkSession, folder: str):
    """Sales whose product number was put together with the line number: the last
    ones name products that are not there."""
    m = models(spark, folder)
    m.store("raw_vendas", TestData(spark, folder).raw_vendas(line_in_product=True).withColumn(
        INGESTED_AT, F.current_timestamp()))
    return m.get


def _dedup_vendas(spark: SparkSession, folder: str) -> DataFrame:
    sales = staging.stg_vendas(_repeating_sales(spark, folder)).drop(INGESTED_AT)
    return quality.deduplicate(sales, "venda_id", ["data_emissao", "produto_id"])


def _net_reconciliation(spark: SparkSession, folder: str) -> DataFrame:
    """Sales whose net value lacks the tax of returned lines."""
    netted = TestData(spark, folder).raw_vendas(net_of_tax=True).withColumn(INGESTED_AT, F.current_timestamp())
    return quality.net_reconciliation(staging.stg_vendas(netted))


# -- bronze ---------------------------------------------------------------

def _date_coercion(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with dates as texts: in several patterns, mixed, and with values that
    are no dates."""
    ordered = F.col("o_orderdate")
    day, local = F.date_format(ordered, "yyyy-MM-dd"), F.date_format(ordered, "dd/MM/yyyy")
    text = TestData(spark, folder).read("orders").select(
        F.col("o_orderkey").alias("pedido_id"),
        day.alias("data_pedido"),
        F.when(F.col("o_orderkey") % 211 == 0, "n/d").otherwise(day).alias("data_prevista"),
        F.when(F.col("o_orderkey") % 5 != 0, day).alias("vigencia_inicio"),
        day.alias("observacao"),
        local.alias("data_local"),
        F.date_format(ordered, "MM/dd/yyyy").alias("data_mes_primeiro"),
        F.date_format(ordered, "yyyyMMdd").alias("data_compacta"),
        F.when(F.col("o_orderkey") % 2 == 0, day).otherwise(local).alias("data_mista"))
    coerced = bronze.coerce_dates(text)
    return coerced.select(*[
        F.col(f.name).cast("date").alias(f.name) if isinstance(f.dataType, T.TimestampType)
        else F.col(f.name) for f in coerced.schema])


def _load_report(spark: SparkSession, folder: str) -> DataFrame:
    """The report of a full load of the nine tables, with their storage layout."""
    mark, data = uuid.uuid4().hex, TestData(spark, folder)
    layers = bronze.Layers(*(f"{schema}_{mark}" for schema in ("bronze", "silver", "gold")))
    report = bronze.ingest_from(spark, lambda spec: getattr(data, spec.table)(), layers)
    for schema in (layers.bronze, layers.silver, layers.gold):
        spark.sql(f"DROP SCHEMA {schema} CASCADE")
    layout = spark.createDataFrame([(t.table, t.partition or "", ",".join(t.cluster)) for t in bronze.TABLES],
                                   "tabela string, particao string, clusters string")
    return report.drop("bytes").join(F.broadcast(layout), "tabela")


def _text_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Expenses as an unreliable system might deliver them, all as text."""
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    return TestData(spark, folder).read("orders").select(
        F.when(key % 67 != 0, F.concat(F.lit("DESP-"), key.cast("string"))).alias("despesa_id"),
        F.when(key % 61 == 0, F.date_format(day, "dd/MM/yyyy")).otherwise(F.date_format(day, "yyyy-MM-dd"))
        .alias("mes_referencia"),
        F.col("o_orderstatus").alias("centro_custo_tipo"), F.col("o_orderpriority").alias("natureza"),
        F.lit("DEPRECIACAO").alias("classificacao_dre"),
        F.when(key % 53 == 0, "n/d").when(key % 59 == 0, "1.234,50").when(key % 71 == 0, " ")
        .otherwise(F.format_string("%.2f", "o_totalprice")).alias("valor"))


def _quarantined(spark: SparkSession, folder: str) -> quarantine.Load:
    target = f"{shared_folder(spark)}/quarantine-{uuid.uuid4().hex}"
    return quarantine.load(spark, _text_feed(spark, folder), SPECS["raw_despesas"], target)


def _accepted(spark: SparkSession, folder: str) -> DataFrame:
    return _quarantined(spark, folder).accepted.withColumn("mes_referencia", F.col("mes_referencia").cast("date"))


def _rejected(spark: SparkSession, folder: str) -> DataFrame:
    return _quarantined(spark, folder).rejected.select(
        F.get_json_object("delivered", "$.despesa_id").alias("despesa_id"),
        F.get_json_object("delivered", "$.mes_referencia").alias("entregue"), "coluna", "valor", "motivo")


def _distinct_sketches(spark: SparkSession, folder: str) -> DataFrame:
    """Exact distinct counts per line and month, per year and per line, and whether
    the counts merged from sketches of the months keep their error bound."""
    sales = models(spark, folder).get("stg_vendas")
    months = sketches.sales_sketches(sales)
    levels = {"mes": intermediate.MONTH_LINE, "ano": ["ano"], "linha": ["linha_producao_id"]}
    keys = {"ano": "bigint", "mes": "bigint", "linha_producao_id": "string"}
    return quality.union_all(
        sketches.compared(sales, by, months).select(
            F.lit(level).alias("nivel"),
            *[F.col(c) if c in by else F.lit(None).cast(t).alias(c) for c, t in keys.items()],
            *sketches.COUNTED.values(), "dentro_do_limite")
        for level, by in levels.items())


def _deliveries(sales: DataFrame) -> list[DataFrame]:
    """Sales as they might arrive: first most rows, some with a wrong amount; then
    rows of a few months that come late; then the wrong rows again, put right."""
    day = F.col("data_emissao")
    late = (F.month(day) == 5) & (F.dayofmonth(day) % 3 == 0)
    wrong = (F.month(day) == 2) & (F.year(day) % 2 == 0) & (F.dayofmonth(day) > 14)
    doubled = F.when(wrong, F.col("valor_bruto") * 2).otherwise(F.col("valor_bruto"))
    return [sales.where(~late).withColumn("valor_bruto", doubled), sales.where(late), sales.where(wrong)]


def _upserted_income_statement(spark: SparkSession, folder: str) -> DataFrame:
    """The income statement after three deliveries, of which each rebuilt only the
    months it touched."""
    data, root = TestData(spark, folder), f"{shared_folder(spark)}/upsert-{uuid.uuid4().hex}"
    sales, costs, expenses = (MonthStore(root, SPECS[t], key) for t, key in (
        ("raw_vendas", ()), ("raw_custos", ("produto_id", "mes_referencia")), ("raw_despesas", ())))
    for store in (costs, expenses):
        apply_batch(data.raw(store.spec.table).to(T.StructType([
            *store.spec.schema.fields, T.StructField(INGESTED_AT, T.TimestampType())])), "first", store)
    built = MonthlyModels(spark, f"{root}/gold", [sales, costs, expenses], data.raw)
    for rows in _deliveries(data.raw_vendas().to(sales.spec.schema)):
        rows.write.mode("append").parquet(f"{root}/incoming")
        upsert_new_files(spark, sales, f"{root}/incoming", f"{root}/seen").awaitTermination()
        built.refresh()
    return built.get("mart_dre_mensal")


# -- history --------------------------------------------------------------

def _facts(m: Models) -> DataFrame:
    return m.get("stg_vendas").select("venda_id", "produto_id", "data_emissao", "quantidade")


def _scd2_between(spark: SparkSession, folder: str) -> DataFrame:
    m = models(spark, folder)
    return scd2.lookup_between(_facts(m), "data_emissao", m.get("dim_historico_custos"))


def _scd2_asof(spark: SparkSession, folder: str) -> DataFrame:
    m = models(spark, folder)
    return scd2.lookup_asof(_facts(m), "data_emissao", m.get("dim_historico_custos"))


def _scd2_current(spark: SparkSession, folder: str) -> DataFrame:
    m = models(spark, folder)
    return scd2.lookup_current(_facts(m), m.get("dim_historico_custos"))


def _scd2_build(spark: SparkSession, folder: str) -> DataFrame:
    events = models(spark, folder).get("dim_historico_custos").select(
        "historico_id", "produto_id", "valid_from", "custo_padrao_novo", "motivo_alteracao")
    return scd2.scd2_build(events)


def _scd2_merged(spark: SparkSession, folder: str) -> DataFrame:
    """The history after three batches of events: the second one brings late events
    that fall between stored versions, the third one is the second again."""
    events = models(spark, folder).get("dim_historico_custos").select(
        "historico_id", "produto_id", "valid_from", "custo_padrao_novo", "motivo_alteracao")
    late = F.col("motivo_alteracao") == "RENEGOCIACAO_FORNECEDOR"
    store = HistoryStore(f"{shared_folder(spark)}/history-{uuid.uuid4().hex}", parts=16)
    store.apply(events.where(~late), "first")
    store.apply(events.where(late), "late")
    store.apply(events.where(late), "late")
    return store.history(spark)


def _margin_vs_history(spark: SparkSession, folder: str) -> DataFrame:
    m = models(spark, folder)
    return reports.margin_vs_history(m.get("product_margins"), m.get("dim_historico_custos"))


# -- planning -------------------------------------------------------------

def _cost_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """The spine runs one year past the published indices, which then default."""
    m, data = models(spark, folder), TestData(spark, folder)
    sold = data.read("lineitem").agg(
        F.min("l_shipdate").cast("date").alias("lo"),
        F.add_months(F.max("l_shipdate").cast("date"), 12).alias("hi"))
    return planning.cost_rollup(
        m.get("stg_produtos"), m.get("stg_commodities"),
        sold.select("lo").scalar(), sold.select("hi").scalar(), BASE_YEAR)


def _budget_phasing(spark: SparkSession, folder: str) -> DataFrame:
    m = models(spark, folder)
    return planning.budget_phasing(
        m.get("stg_vendas"), m.get("stg_despesas"), payroll=PAYROLL_STAND_IN)


def _revenue_linked(spark: SparkSession, folder: str) -> DataFrame:
    """Whole calendar years, so months without sales appear with zero."""
    m, data = models(spark, folder), TestData(spark, folder)
    edge = data.read("lineitem").agg(
        F.trunc(F.min("l_shipdate").cast("date"), "year").alias("lo"),
        F.add_months(F.trunc(F.max("l_shipdate").cast("date"), "year"), 11).alias("hi"))
    calendar = edge.select(F.explode(planning.month_spine(F.col("lo"), F.col("hi")))
                           .alias("mes_referencia"))
    return planning.revenue_linked_expense(m.get("stg_vendas"), calendar, LINKED_RATES)


def _escalation(spark: SparkSession, folder: str) -> DataFrame:
    nature = F.col("natureza")
    return planning.escalate_expenses(
        models(spark, folder).get("stg_despesas"),
        planning.factors_from(BASE_YEAR, planning.ESCALATION_BY_YEAR),
        fixed=nature.startswith(FIXED_STAND_IN), payroll=nature.contains(PAYROLL_STAND_IN))


def _price_escalation(spark: SparkSession, folder: str) -> DataFrame:
    return planning.escalate_prices(
        models(spark, folder).get("stg_vendas"),
        planning.factors_from(BASE_YEAR, planning.ESCALATION_BY_YEAR))


def _commodity_impact(spark: SparkSession, folder: str) -> DataFrame:
    m = models(spark, folder)
    return reports.commodity_impact(m.get("stg_commodities"), m.get("stg_custos"))


def _commodity_margin_effect(spark: SparkSession, folder: str) -> DataFrame:
    m = models(spark, folder)
    return reports.commodity_margin_effect(m.get("stg_vendas"), m.get("stg_custos"))


def _sources(check: Callable) -> Query:
    return lambda spark, folder: check(TestData(spark, folder).raw)


_QUERIES: dict[str, Query] = {
    **{name: _model(name) for name in (*STAGING, *INTERMEDIATE, *MARTS)},
    "expenses_pivot": _on("stg_despesas", intermediate.expenses_pivot),
    "bronze_date_coercion": _date_coercion,
    "bronze_month_partitions": _sources(quality.month_partitions),
    "bronze_load_report": _load_report,
    "bronze_row_counts": _sources(quality.row_counts),
    "bronze_null_keys": _sources(quality.null_keys),
    "bronze_duplicate_keys": lambda s, d: quality.duplicate_key_samples(_with_repeats(s, d)),
    "bronze_profile_vendas": _on("raw_vendas", quality.profile_vendas),
    "bronze_profile_custos": _on("raw_custos", quality.profile_custos),
    "bronze_load_ranges": _sources(quality.load_ranges),
    "upserted_income_statement": _upserted_income_statement,
    "quarantine_accepted": _accepted,
    "quarantine_rejected": _rejected,
    "distinct_sketches": _distinct_sketches,
    "dq_not_null": lambda s, d: quality.dq_not_null(models(s, d).get),
    "dq_unique": lambda s, d: quality.dq_unique(_with_repeats(s, d)),
    "dq_accepted_values": lambda s, d: quality.dq_accepted_values(models(s, d).get),
    "dq_relationships": lambda s, d: quality.dq_relationships(_with_orphans(s, d)),
    "dq_min_rows": _sources(quality.min_rows),
    "dq_ingested_at": _sources(quality.ingested_at_nulls),
    "dq_net_reconciliation": _net_reconciliation,
    "dedup_vendas": _dedup_vendas,
    "scd2_lookup_between": _scd2_between,
    "scd2_lookup_asof": _scd2_asof,
    "scd2_current": _scd2_current,
    "scd2_build": _scd2_build,
    "scd2_merged": _scd2_merged,
    "product_status_counts": _on("stg_produtos", reports.product_status_counts),
    "revenue_grand_totals": _on("stg_vendas", reports.revenue_grand_totals),
    "dre_waterfall": _on("mart_dre_mensal", reports.dre_waterfall),
    "dre_trend": _on("mart_dre_mensal", reports.dre_trend),
    "top10_products": _on("product_margins", reports.top10_products),
    "margin_by_line": _on("product_margins", reports.margin_by_line),
    "margin_heatmap": _on("product_margins", reports.margin_heatmap),
    "margin_vs_history": _margin_vs_history,
    "margin_vs_volume": _on("product_margins", reports.margin_vs_volume),
    "product_margin_counts": _on("product_margins", reports.product_margin_counts),
    "margin_alerts": _on("product_margins", reports.margin_alerts),
    "budget_traffic_light": _on("mart_orcado_realizado", reports.budget_traffic_light),
    "budget_attainment": _on("mart_orcado_realizado", reports.budget_attainment),
    "budget_overruns": _on("mart_orcado_realizado", reports.budget_overruns),
    "annual_summary": _on("mart_dre_mensal", reports.annual_summary),
    "worst_ebitda_months": _on("mart_dre_mensal", reports.worst_ebitda_months),
    "seasonality_index": _on("mart_dre_mensal", reports.seasonality_index),
    "commodity_impact": _commodity_impact,
    "commodity_margin_effect": _commodity_margin_effect,
    "kpis_by_calendar": _on("mart_dre_mensal", reports.kpis_by_calendar),
    "cost_rollup": _cost_rollup,
    "budget_phasing": _budget_phasing,
    "revenue_linked_expense": _revenue_linked,
    "sales_valuation": _on("stg_vendas", planning.sales_valuation),
    "escalation": _escalation,
    "price_escalation": _price_escalation,
}


def queries() -> dict[str, Query]:
    def normalised(query: Query) -> Query:
        return lambda spark, folder: flat(query(spark, folder))

    return {name: normalised(query) for name, query in _QUERIES.items()}
