"""The four gold tables: income statement, product margin, budget, executive KPIs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from castledger.functions.expr import (
    TOTAL, TOTAL4, dec, first_of_month, growth_pct, not_below_zero, or_zero, pct, times, total,
)
from castledger.operators.intermediate import MONTH, product_months
from castledger.operators.ordered import rank_within


@dataclass(frozen=True)
class FinanceParams:
    """Project variables: income-tax rate and margin alert threshold."""

    aliquota_ir_csll: str = "0.34"
    margem_threshold: str = "0.15"


def mart_dre_mensal(revenue: DataFrame, cogs: DataFrame, expenses: DataFrame,
                    params: FinanceParams = FinanceParams()) -> DataFrame:
    """Income statement per month. Revenue drives it: a month without sales is
    absent, a month without costs or expenses keeps zeros in the profit lines."""
    revenue_month = revenue.groupBy(*MONTH).agg(
        *[total(c).alias(c) for c in ("receita_bruta", "total_descontos", "total_devolucoes",
                                      "receita_liquida")],
        F.sum("qtd_vendas").alias("qtd_vendas"),
        F.sum("qtd_pecas_vendidas").alias("qtd_pecas_vendidas"))
    cogs_month = cogs.groupBy(*MONTH).agg(
        *[total(c).alias(c) for c in ("cmv_total", "cmv_materia_prima", "cmv_mao_obra", "cmv_cif")])
    joined = revenue_month.join(cogs_month, MONTH, "left").join(expenses, MONTH, "left")

    # The chain from net revenue to profit before tax, each step once.
    steps = joined.select(
        "*", (F.col("receita_liquida") - or_zero("cmv_total")).cast(TOTAL).alias("bruto"),
    ).select(
        "*", (F.col("bruto") - or_zero("total_despesas_operacionais")).cast(TOTAL).alias("caixa"),
    ).select(
        "*", (F.col("caixa") - or_zero("depreciacao")).cast(TOTAL).alias("operacional"),
    ).select(
        "*", (F.col("operacional") - or_zero("resultado_financeiro")).cast(TOTAL).alias("lair"),
    ).select(
        "*", not_below_zero((F.col("lair") * dec(params.aliquota_ir_csll)).cast(TOTAL4))
        .alias("imposto"),
    ).select("*", (F.col("lair") - F.col("imposto")).cast(TOTAL4).alias("liquido"))

    net = F.col("receita_liquida")

    def cents(c: Column | str) -> Column:
        return F.round(F.col(c) if isinstance(c, str) else c, 2).cast(TOTAL)

    return steps.select(
        *MONTH,
        first_of_month("ano", "mes").alias("data_referencia"),
        "receita_bruta",
        F.col("total_descontos").alias("descontos"),
        F.col("total_devolucoes").alias("devolucoes"),
        "receita_liquida",
        F.col("cmv_total").alias("cmv"), "cmv_materia_prima", "cmv_mao_obra", "cmv_cif",
        F.col("bruto").alias("lucro_bruto"),
        pct(F.col("bruto"), net).alias("margem_bruta_pct"),
        *[or_zero(c).alias(c) for c in ("despesa_vendas", "despesa_admin", "despesa_fabrica",
                                        "total_despesas_operacionais")],
        F.col("caixa").alias("ebitda"),
        pct(F.col("caixa"), net).alias("margem_ebitda_pct"),
        or_zero("depreciacao").alias("depreciacao"),
        F.col("operacional").alias("ebit"),
        pct(F.col("operacional"), net).alias("margem_ebit_pct"),
        or_zero("resultado_financeiro").alias("resultado_financeiro"),
        F.col("lair").alias("lucro_antes_ir"),
        cents("imposto").alias("ir_csll"),
        cents("liquido").alias("lucro_liquido"),
        pct(F.col("liquido"), net, TOTAL4).alias("margem_liquida_pct"),
        "qtd_vendas",
        "qtd_pecas_vendidas",
        cents(F.try_divide(F.col("receita_bruta"), F.col("qtd_vendas"))).alias("ticket_medio"),
    )


def product_margins(sales: DataFrame, costs: DataFrame, products: DataFrame,
                    params: FinanceParams = FinanceParams()) -> DataFrame:
    """Margin per month, product and line, with its status but not its rank."""
    unit = costs.where(F.col("custo_total_unitario").isNotNull()).select(
        "produto_id", "ano", "mes", F.col("custo_total_unitario").alias("custo_unitario_real"))
    master = products.select(
        "produto_id", "produto_nome", "linha_producao_nome", "custo_padrao_unitario")
    rows = (
        product_months(sales)
        .join(unit.hint("merge"), ["produto_id", "ano", "mes"], "inner")
        .join(master, "produto_id", "left")
        .select("*", times("qtd_vendida", "custo_unitario_real").alias("cmv_produto"))
        .select("*", (F.col("receita_liquida") - F.col("cmv_produto")).cast(TOTAL)
                .alias("margem_bruta"))
    )
    real, standard = F.col("custo_unitario_real"), F.col("custo_padrao_unitario")
    net = F.col("receita_liquida")
    per_unit = F.try_divide(net, F.col("qtd_vendida").cast("decimal(18,0)"))
    margin_pct = F.col("margem_bruta_pct")
    limit = dec(params.margem_threshold) * 100
    return rows.select(
        *MONTH, "produto_id", "produto_nome", "linha_producao_id", "linha_producao_nome",
        "qtd_vendida", "receita_bruta", "receita_liquida", "custo_unitario_real", "cmv_produto",
        "margem_bruta",
        pct(F.col("margem_bruta"), net).alias("margem_bruta_pct"),
        F.round(per_unit - real, 2).cast(TOTAL).alias("margem_contribuicao_unitaria"),
        "custo_padrao_unitario",
        pct(real - standard, standard).alias("variacao_custo_vs_padrao_pct"),
    ).select(
        "*",
        F.when(F.col("margem_bruta") < 0, "MARGEM_NEGATIVA")
        .when(margin_pct < limit, "ABAIXO_THRESHOLD").otherwise("SAUDAVEL").alias("status_margem"),
    )


def mart_margem_produto(margins: DataFrame) -> DataFrame:
    """Rank in the month and share of its revenue.

    A month holds every product sold in it, which grows with the catalogue, so
    it is ranked in cells of similar margins rather than in one window task.
    """
    ranked = rank_within(
        margins, group=MONTH, value="margem_bruta",
        ties=["produto_id", "linha_producao_id", "custo_unitario_real"],
        rank="ranking_margem_mes", group_sums={"_month_revenue": "receita_liquida"})
    return ranked.select(
        *margins.columns, "ranking_margem_mes",
        pct(F.col("receita_liquida"), F.col("_month_revenue")).alias("pct_receita_mes"))


def mart_orcado_realizado(budget: DataFrame, expenses: DataFrame) -> DataFrame:
    """Budget against actual per month and nature: one full outer join, so that
    either side is computed once.

    Such a join holds the rows of a key in memory and can't split a hot one. There
    is none: the actuals are folded to class and cost centre first, with map-side
    combine, so a key has as many rows as there are of those, however many expenses
    it has; and a budget has one row per line. The join is never a broadcast.
    """
    key = ["ano", "mes", "natureza"]
    planned = budget.select(*key, "tipo", "centro_custo_tipo", "valor_orcado")
    actual = expenses.groupBy(
        *key, F.col("classificacao_dre").alias("tipo_real"),
        F.col("centro_custo_tipo").alias("centro_real"),
    ).agg(total("valor").alias("valor_realizado"))
    compared = planned.join(actual, key, "full_outer").select(
        *key, F.coalesce("tipo", "tipo_real").alias("tipo"),
        F.coalesce("centro_custo_tipo", "centro_real").alias("centro_custo_tipo"),
        F.col("valor_orcado").cast(TOTAL).alias("orcado"), F.col("valor_realizado").alias("real"))

    gap = (or_zero("real") - or_zero("orcado")).cast(TOTAL)
    base = F.nullif(F.col("orcado"), F.lit(0).cast(TOTAL))
    size = F.abs("variancia_pct")
    return compared.select(
        *key, "tipo", "centro_custo_tipo",
        or_zero("orcado").alias("valor_orcado"),
        or_zero("real").alias("valor_realizado"),
        gap.alias("variancia_absoluta"),
        pct(gap, base).alias("variancia_pct"),
        pct(F.col("real"), base).alias("atingimento_pct"),
    ).select(
        "*",
        F.when(size > 20, "DESVIO_CRITICO").when(size > 10, "DESVIO_ALERTA")
        .when(size > 5, "DESVIO_MODERADO").otherwise("DENTRO_ORCAMENTO").alias("status_desvio"),
        F.when(F.col("variancia_absoluta") > 0, "ACIMA_ORCADO")
        .when(F.col("variancia_absoluta") < 0, "ABAIXO_ORCADO")
        .otherwise("NO_ORCADO").alias("direcao_desvio"),
    )


def mart_kpis_executivo(statement: DataFrame) -> DataFrame:
    """Month-over-month, year-over-year and year-to-date on the income statement.

    The unpartitioned window sees one row per calendar month, never raw rows.
    Offsets count rows: a missing month shifts the comparison by design.
    """
    timeline = Window.orderBy("ano", "mes")
    year_to_date = Window.partitionBy("ano").orderBy("mes")

    # measure, output stem, months back, whether the base is taken as magnitude
    comparisons = (
        ("receita_liquida", "receita", 1, False),
        ("lucro_bruto", "lucro_bruto", 1, True),
        ("ebitda", "ebitda", 1, True),
        ("receita_liquida", "receita", 12, False),
        ("lucro_bruto", "lucro_bruto", 12, True),
    )
    wording = {1: ("mes_anterior", "mom_pct"), 12: ("ano_anterior", "yoy_pct")}
    evolution = []
    for measure, stem, back, magnitude in comparisons:
        earlier = F.lag(measure, back).over(timeline)
        past, change = wording[back]
        evolution += [
            earlier.alias(f"{measure}_{past}"),
            growth_pct(F.col(measure), earlier, magnitude).alias(f"{stem}_{change}"),
        ]
    return statement.select(
        *MONTH, "data_referencia",
        "receita_bruta", "receita_liquida", "cmv", "lucro_bruto", "ebitda", "ebit", "lucro_liquido",
        "margem_bruta_pct", "margem_ebitda_pct", "margem_ebit_pct", "margem_liquida_pct",
        "qtd_vendas", "qtd_pecas_vendidas", "ticket_medio", "total_despesas_operacionais",
        *evolution,
        *[F.sum(m).over(year_to_date).cast(TOTAL).alias(f"{m}_ytd")
          for m in ("receita_liquida", "lucro_bruto", "ebitda", "lucro_liquido")],
    )
