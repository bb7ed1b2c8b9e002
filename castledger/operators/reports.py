"""Dashboard and insight questions, answered on the gold tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from castledger.functions.expr import TOTAL, dec, growth_pct, pct, ratio, times, total
from castledger.operators.intermediate import MONTH, product_months
from castledger.operators.marts import FinanceParams
from castledger.operators.scd2 import lookup_asof

# The commodity each production line depends on.
LINE_COMMODITY = {"LP01": "ACO", "LP02": "ALUMINIO", "LP03": "POLIMERO", "LP04": "MISTO"}
# Income-statement lines in reading order, with their sign.
WATERFALL = (
    ("receita_bruta", 1), ("descontos", -1), ("devolucoes", -1), ("cmv", -1),
    ("despesa_vendas", -1), ("despesa_admin", -1), ("despesa_fabrica", -1),
    ("depreciacao", -1), ("resultado_financeiro", -1), ("ir_csll", -1),
)


def line_commodity() -> Column:
    """Commodity of ``linha_producao_id``; NULL for an unknown line."""
    pairs = [F.lit(text) for pair in LINE_COMMODITY.items() for text in pair]
    return F.create_map(*pairs)[F.col("linha_producao_id")]


def dre_waterfall(statement: DataFrame) -> DataFrame:
    """Ten signed steps per month and their running total, down to net profit."""
    steps = F.array(*[
        F.struct(F.lit(i + 1).cast("bigint").alias("ordem"), F.lit(name).alias("etapa"),
                 (F.coalesce(F.col(name), F.lit(0)) * sign).cast(TOTAL).alias("valor"))
        for i, (name, sign) in enumerate(WATERFALL)])
    running = Window.partitionBy(*MONTH).orderBy("ordem")
    return statement.select(*MONTH, F.inline(steps)).select(
        *MONTH, "ordem", "etapa", "valor",
        F.sum("valor").over(running).cast(TOTAL).alias("acumulado"))


def dre_trend(statement: DataFrame) -> DataFrame:
    return statement.select(
        *MONTH, "data_referencia", "receita_liquida", "lucro_bruto", "ebitda", "lucro_liquido",
        "margem_bruta_pct", "margem_ebitda_pct", "margem_liquida_pct").orderBy(*MONTH)


def _margin_totals(margins: DataFrame, *group: str) -> DataFrame:
    return margins.groupBy(*group).agg(
        F.sum("qtd_vendida").alias("qtd_vendida"),
        total("receita_liquida").alias("receita_liquida"),
        total("cmv_produto").alias("cmv"),
        total("margem_bruta").alias("margem_bruta"))


def _with_margin_pct(totals: DataFrame) -> DataFrame:
    return totals.withColumn(
        "margem_bruta_pct", pct(F.col("margem_bruta"), F.col("receita_liquida")))


def top10_products(margins: DataFrame) -> DataFrame:
    """The ten products that earn the most gross margin."""
    return _with_margin_pct(_margin_totals(margins, "produto_id", "produto_nome")).orderBy(
        F.desc("margem_bruta"), "produto_id").limit(10)


def margin_by_line(margins: DataFrame) -> DataFrame:
    return _with_margin_pct(_margin_totals(margins, "linha_producao_id"))


def margin_heatmap(margins: DataFrame) -> DataFrame:
    """Margin percentage of each month and production line, one row per cell, so
    that any line is there."""
    return _with_margin_pct(_margin_totals(margins, *MONTH, "linha_producao_id")).select(
        *MONTH, "linha_producao_id", "margem_bruta_pct")


def margin_vs_history(margins: DataFrame, history: DataFrame) -> DataFrame:
    """Real unit cost of each product-month against the standard cost that was in
    force on the month's first day, not today's. Joined on product-months, so
    sales lines are folded before the history is looked up."""
    rows = margins.select(
        *MONTH, "produto_id", "linha_producao_id", "custo_unitario_real",
        F.make_date(F.col("ano").cast("int"), F.col("mes").cast("int"), F.lit(1)).alias("inicio_mes"))
    real, standard = F.col("custo_unitario_real"), F.col("custo_padrao_vigente")
    return lookup_asof(rows, "inicio_mes", history).select(
        *MONTH, "produto_id", "linha_producao_id", "custo_unitario_real", "historico_id",
        standard.cast(TOTAL).alias("custo_padrao_vigente"),
        pct(real - standard, standard).alias("variacao_custo_vs_historico_pct"))


def margin_vs_volume(margins: DataFrame) -> DataFrame:
    return _with_margin_pct(_margin_totals(margins, "produto_id", "linha_producao_id"))


def product_margin_counts(margins: DataFrame,
                          params: FinanceParams = FinanceParams()) -> DataFrame:
    """Products per margin band, judged on their whole-period margin."""
    products = _with_margin_pct(_margin_totals(margins, "produto_id"))
    band = (
        F.when(F.col("margem_bruta") < 0, "MARGEM_NEGATIVA")
        .when(F.col("margem_bruta_pct") < dec(params.margem_threshold) * 100, "ABAIXO_THRESHOLD")
        .otherwise("SAUDAVEL"))
    return products.groupBy(band.alias("status_margem")).agg(F.count("*").alias("qtd_produtos"))


def margin_alerts(margins: DataFrame) -> DataFrame:
    """Product-months below the threshold."""
    return margins.where("status_margem <> 'SAUDAVEL'").select(
        *MONTH, "produto_id", "produto_nome", "linha_producao_id", "receita_liquida",
        "margem_bruta", "margem_bruta_pct", "status_margem")


def budget_traffic_light(comparison: DataFrame) -> DataFrame:
    return comparison.groupBy("status_desvio").agg(
        F.count("*").alias("linhas"),
        total("valor_orcado").alias("valor_orcado"),
        total("valor_realizado").alias("valor_realizado"))


def _attainment(comparison: DataFrame, group: str) -> DataFrame:
    """Expense lines only: revenue budgets have no actuals in this comparison."""
    return comparison.where("tipo <> 'RECEITA'").groupBy(group).agg(
        total("valor_orcado").alias("valor_orcado"),
        total("valor_realizado").alias("valor_realizado"))


def budget_attainment(comparison: DataFrame) -> DataFrame:
    return _attainment(comparison, "ano").withColumn(
        "atingimento_pct", pct(F.col("valor_realizado"), F.col("valor_orcado")))


def budget_overruns(comparison: DataFrame) -> DataFrame:
    """Natures by overspend, worst first."""
    gap = (F.col("valor_realizado") - F.col("valor_orcado")).cast(TOTAL)
    return _attainment(comparison, "natureza").select(
        "*", gap.alias("variancia_absoluta"), pct(gap, F.col("valor_orcado")).alias("variancia_pct"),
    ).orderBy(F.desc("variancia_absoluta"), "natureza")


def annual_summary(statement: DataFrame) -> DataFrame:
    """Results per year and revenue growth; the window sees one row per year."""
    measures = ("receita_liquida", "lucro_bruto", "ebitda", "lucro_liquido")
    years = statement.groupBy("ano").agg(*[total(m).alias(m) for m in measures])
    net = F.col("receita_liquida")
    before = F.lag("receita_liquida").over(Window.orderBy("ano"))
    return years.select(
        "ano", *measures,
        pct(F.col("lucro_bruto"), net).alias("margem_bruta_pct"),
        pct(F.col("ebitda"), net).alias("margem_ebitda_pct"),
        pct(F.col("lucro_liquido"), net).alias("margem_liquida_pct"),
        growth_pct(net, before, False).alias("crescimento_receita_pct"))


def worst_ebitda_months(statement: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` months of lowest EBITDA margin; the report names no number."""
    return statement.select(
        *MONTH, "receita_liquida", "total_despesas_operacionais", "ebitda", "margem_ebitda_pct",
    ).orderBy(F.asc_nulls_last("margem_ebitda_pct"), *MONTH).limit(n)


def seasonality_index(statement: DataFrame) -> DataFrame:
    """Average revenue of a calendar month over the average of all months."""
    by_month = statement.groupBy("mes").agg(
        total("receita_liquida").alias("receita"), F.count("*").alias("meses"))
    everything = Window.partitionBy()  # twelve rows
    counted = "decimal(9,0)"
    own = F.col("receita") * F.sum("meses").over(everything).cast(counted)
    overall = F.sum("receita").over(everything).cast(TOTAL) * F.col("meses").cast(counted)
    wide = "decimal(26,2)"
    return by_month.select(
        "mes", "meses",
        F.round(F.try_divide(F.col("receita"), F.col("meses")), 2).cast(TOTAL)
        .alias("receita_media"),
        F.round(F.try_divide(own.cast(wide), overall.cast(wide)), 4).cast("decimal(18,4)")
        .alias("indice_sazonal"))


def commodity_impact(indices: DataFrame, costs: DataFrame) -> DataFrame:
    """Index movement next to the mean unit cost of the line that depends on it.

    The windows run per commodity and per line over one row per month.
    """
    by_commodity = Window.partitionBy("commodity").orderBy(*MONTH)
    moved = indices.select(
        *MONTH, "commodity", "indice",
        _growth4(F.col("indice"), F.lag("indice").over(by_commodity)).alias("indice_mom_pct"))

    line_month = costs.groupBy("linha_producao_id", *MONTH).agg(
        F.count("*").alias("produtos"),
        total("custo_materia_prima").alias("mp"), total("custo_total_unitario").alias("ct"))
    mean = {name: F.round(F.try_divide(F.col(s), F.col("produtos")), 2).cast(TOTAL)
            for s, name in (("mp", "custo_mp_medio"), ("ct", "custo_total_medio"))}
    by_line = Window.partitionBy("linha_producao_id").orderBy(*MONTH)
    lines = line_month.select(
        "linha_producao_id", *MONTH, line_commodity().alias("commodity"), "produtos",
        *[c.alias(n) for n, c in mean.items()],
    ).select(
        "*", growth_pct(F.col("custo_mp_medio"), F.lag("custo_mp_medio").over(by_line), False)
        .alias("custo_mp_mom_pct"))
    return lines.join(moved, [*MONTH, "commodity"], "left").select(
        "linha_producao_id", *MONTH, "commodity", "indice", "indice_mom_pct", "produtos",
        "custo_mp_medio", "custo_mp_mom_pct", "custo_total_medio")


def commodity_margin_effect(sales: DataFrame, costs: DataFrame) -> DataFrame:
    """What the commodity index does to the margin of each product and month: its
    raw material at the month's index against the same at index 1, times the
    quantity sold. Sales are folded to product-months before the costs are joined."""
    unit = costs.where(F.col("custo_total_unitario").isNotNull()).select(
        "produto_id", "ano", "mes", "indice_commodity", "custo_total_unitario", "custo_materia_prima",
        ratio(F.col("custo_materia_prima"), F.nullif("indice_commodity", F.lit(0)), 2, "decimal(20,4)").alias("mp_neutra"))
    sold = product_months(sales).join(unit.hint("merge"), ["produto_id", "ano", "mes"])
    net, margin = F.col("receita_liquida"), F.col("margem_bruta")
    without = (margin + F.col("efeito_commodity")).cast(TOTAL)
    return sold.select(
        *MONTH, "produto_id", "linha_producao_id", line_commodity().alias("commodity"), "indice_commodity", "qtd_vendida",
        "receita_liquida", (net - times("qtd_vendida", "custo_total_unitario")).cast(TOTAL).alias("margem_bruta"),
        times("qtd_vendida", F.col("custo_materia_prima") - F.col("mp_neutra")).alias("efeito_commodity"),
    ).select(
        "*", without.alias("margem_sem_commodity"), pct(margin, net).alias("margem_bruta_pct"),
        pct(without, net).alias("margem_sem_commodity_pct"))


def kpis_by_calendar(statement: DataFrame) -> DataFrame:
    """Each month against the same month of the year before, by the calendar: a
    missing month leaves its comparison empty instead of shifting all later ones.
    The window sees one row per month."""
    number = F.col("ano") * 12 + F.col("mes")
    year_before = Window.orderBy("_month").rangeBetween(-12, -12)
    measures = ("receita_liquida", "lucro_bruto", "ebitda", "lucro_liquido")
    return statement.withColumn("_month", number).select(
        *MONTH, *measures, *[F.max(m).over(year_before).alias(f"{m}_ano_anterior") for m in measures],
    ).select(
        "*", *[growth_pct(F.col(m), F.col(f"{m}_ano_anterior"), m != "receita_liquida").alias(f"{m}_yoy_calendario_pct")
               for m in measures])


def _growth4(now: Column, before: Column) -> Column:
    """Percent change of a four-digit index."""
    change = F.try_divide((now - before).cast("decimal(18,4)"), before.cast("decimal(18,4)"))
    return F.round(change * 100, 2).cast(TOTAL)


def product_status_counts(products: DataFrame) -> DataFrame:
    return products.groupBy("status").agg(F.count("*").alias("produtos"))


def revenue_grand_totals(sales: DataFrame) -> DataFrame:
    return sales.agg(
        total("valor_bruto").alias("receita_bruta"),
        total("valor_liquido").alias("receita_liquida"),
        total("valor_desconto").alias("descontos"),
        total("devolucao_valor").alias("devolucoes"))
