"""Planning jobs: cost roll-forward, budget phasing, linked expenses, escalation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from castledger.functions.expr import (
    MONEY, RATE, TOTAL, dec, month_index, month_of, month_start, total, year_of,
)
from castledger.operators.reports import line_commodity

# Seasonal weight of each calendar month.
SEASONAL_WEIGHTS = {
    1: "0.55", 2: "0.72", 3: "0.90", 4: "0.95", 5: "1.00", 6: "1.00",
    7: "0.80", 8: "1.10", 9: "1.15", 10: "1.18", 11: "1.08", 12: "0.50",
}
# Cost shares, yearly labour factors, monthly overhead inflation.
COST_SHARES = {"materia_prima": "0.60", "mao_obra": "0.25", "indireto": "0.15"}
LABOUR_BY_YEAR = ("1.00", "1.07", "1.12")
OVERHEAD_MONTHLY = 1.004
# Yearly price and expense factors, thirteenth-salary factor.
ESCALATION_BY_YEAR = ("1.00", "1.06", "1.11")
THIRTEENTH_SALARY = "1.35"
PAYROLL_WORD = "Salários"
REVENUE_NATURE = ("RECEITA", "Receita Bruta de Vendas", "COMERCIAL")

_PLAN = "decimal(10,4)"


def _cents(c: Column) -> Column:
    return F.round(c, 2).cast(MONEY)


def month_spine(first: Column, last: Column) -> Column:
    """Array of month starts; exploding it needs no join with a calendar."""
    return F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("interval 1 month"))


def seasonal_weight(month: Column) -> Column:
    table = F.create_map(*[
        c for m, w in SEASONAL_WEIGHTS.items() for c in (F.lit(m).cast("bigint"), dec(w))])
    return table[month.cast("bigint")].cast("decimal(4,2)")


def year_factor(year: Column, factors: Mapping[int, str]) -> Column:
    """Factor of a listed year, 1.00 for any other."""
    value = dec("1.00")
    for listed, factor in factors.items():
        value = F.when(year == listed, dec(factor)).otherwise(value)
    return value.cast(_PLAN)


def factors_from(base_year: int, factors: tuple[str, ...]) -> dict[int, str]:
    return {base_year + n: f for n, f in enumerate(factors)}


def cost_rollup(products: DataFrame, indices: DataFrame, first: Column, last: Column,
                base_year: int) -> DataFrame:
    """Unit cost per active product and month, rolled forward from standard cost.

    Material follows the commodity index of the line (1.0 where none is
    published), labour a yearly factor, overhead monthly compounding.
    """
    grid = products.where("status = 'ATIVO'").select(
        "produto_id", "linha_producao_id", F.col("custo_padrao_unitario").alias("padrao"),
        line_commodity().alias("commodity"), F.explode(month_spine(first, last)).alias("mes_referencia"))
    published = indices.select("commodity", "mes_referencia", "indice")

    age = month_index("mes_referencia", base_year)
    overhead = F.round(F.pow(F.lit(OVERHEAD_MONTHLY), age), 12).cast("decimal(18,12)")
    labour = year_factor(F.year("mes_referencia"), factors_from(base_year, LABOUR_BY_YEAR))
    standard = F.col("padrao")
    costed = grid.join(published, ["commodity", "mes_referencia"], "left").select(
        "produto_id", "linha_producao_id", "mes_referencia", "padrao",
        F.coalesce(F.col("indice"), dec("1.0000")).cast(RATE).alias("indice_commodity"),
        _cents(standard * dec(COST_SHARES["mao_obra"]) * labour).alias("custo_mao_obra_direta"),
        _cents((standard * dec(COST_SHARES["indireto"])).cast("decimal(14,4)") * overhead)
        .alias("custo_indireto_fabricacao"),
    ).select(
        "*", _cents(standard * dec(COST_SHARES["materia_prima"])
                    * F.col("indice_commodity").cast(_PLAN))
        .alias("custo_materia_prima"),
    ).select(
        "*", (F.col("custo_materia_prima") + F.col("custo_mao_obra_direta")
              + F.col("custo_indireto_fabricacao")).cast(MONEY).alias("custo_total_unitario"))
    return costed.select(
        "produto_id", "mes_referencia", "custo_materia_prima", "custo_mao_obra_direta",
        "custo_indireto_fabricacao", "custo_total_unitario",
        standard.alias("custo_padrao_unitario"),
        F.round(F.try_divide((F.col("custo_total_unitario") - standard).cast(MONEY), standard), 4)
        .cast(RATE).alias("variacao_custo_pct"),
        "indice_commodity", "linha_producao_id")


def budget_phasing(sales: DataFrame, expenses: DataFrame, payroll: str = PAYROLL_WORD,
                   revenue_factor: str = "1.00", expense_factor: str = "1.00") -> DataFrame:
    """Annual totals spread over twelve months.

    Revenue follows the seasonal weights; expenses are linear, except payroll
    natures, whose last two months carry the thirteenth salary on top.
    """
    weights = F.array(*[
        F.struct(F.lit(m).cast("bigint").alias("mes"), dec(w).cast("decimal(4,2)").alias("peso"))
        for m, w in SEASONAL_WEIGHTS.items()])
    weight_sum = F.lit(sum(int(w.replace(".", "")) for w in SEASONAL_WEIGHTS.values())).cast(
        "decimal(6,0)")

    kind, nature, centre = REVENUE_NATURE
    yearly_sales = sales.groupBy("ano").agg(total("valor_bruto").alias("anual")).select(
        "ano", F.round(F.col("anual") * dec(revenue_factor), 2).cast(TOTAL).alias("anual"),
        F.inline(weights))
    revenue = yearly_sales.select(
        "ano", "mes", F.lit(kind).alias("tipo"), F.lit(nature).alias("natureza"),
        F.lit(centre).alias("centro_custo_tipo"),
        # weights carry two digits, their sum is in hundredths: w*100 / (100*sum)
        F.round(F.try_divide(F.col("anual") * F.col("peso") * 100, weight_sum), 2).cast(TOTAL)
        .alias("valor_orcado"))

    yearly_costs = expenses.groupBy("ano", "natureza").agg(
        F.min("centro_custo_tipo").alias("centro_custo_tipo"), total("valor").alias("anual"),
    ).select(
        "ano", "natureza", "centro_custo_tipo",
        F.round(F.col("anual") * dec(expense_factor), 2).cast(TOTAL).alias("anual"),
        F.inline(weights))
    extra = F.col("natureza").contains(payroll) & (F.col("mes") >= 11)
    share = F.when(extra, dec(THIRTEENTH_SALARY)).otherwise(dec("1.00"))
    spread = yearly_costs.select(
        "ano", "mes", F.lit("DESPESA").alias("tipo"), "natureza", "centro_custo_tipo",
        F.round(F.try_divide(F.col("anual") * share, F.lit(12).cast("decimal(2,0)")), 2)
        .cast(TOTAL).alias("valor_orcado"))
    return revenue.unionByName(spread)


def revenue_linked_expense(sales: DataFrame, calendar: DataFrame,
                           rates: Mapping[str, str]) -> DataFrame:
    """Expenses that are a share of the month's revenue, zero in months without.

    ``calendar`` has one ``mes_referencia`` per month.
    """
    earned = sales.groupBy(month_start("data_emissao").alias("mes_referencia")).agg(
        total("valor_bruto").alias("receita"))
    natures = F.array(*[
        F.struct(F.lit(n).alias("natureza"), dec(r).cast(RATE).alias("taxa"))
        for n, r in rates.items()])
    months = calendar.join(earned, "mes_referencia", "left").select(
        "mes_referencia", F.coalesce(F.col("receita"), F.lit(0)).cast(TOTAL).alias("receita"),
        F.inline(natures))
    return months.select(
        "mes_referencia", "natureza", "receita",
        F.round(F.col("receita") * F.col("taxa"), 2).cast(TOTAL).alias("valor"))


def sales_valuation(lines: DataFrame) -> DataFrame:
    """Value sales lines from unit price, quantities and discount rate."""
    price, quantity = F.col("preco_unitario"), F.col("quantidade").cast("decimal(10,0)")
    returned = F.col("devolucao_quantidade").cast("decimal(10,0)")
    discount = F.col("desconto_percentual").cast("decimal(6,4)")
    return lines.select(
        "*", (price * quantity).cast(MONEY).alias("bruto"),
        _cents((price * returned).cast(MONEY) * (dec("1.0000") - discount)).alias("devolvido"),
    ).select("*", _cents(F.col("bruto") * discount).alias("desconto")).select(
        "venda_id", "produto_id", "preco_unitario", "quantidade",
        F.col("bruto").alias("valor_bruto"), F.col("desconto").alias("valor_desconto"),
        F.col("devolvido").alias("devolucao_valor"),
        (F.col("bruto") - F.col("desconto") - F.col("devolvido")).cast(MONEY)
        .alias("valor_liquido"))


def escalate_prices(lines: DataFrame, factors: Mapping[int, str]) -> DataFrame:
    """List price raised by the yearly factor of the sale's year."""
    return lines.select(
        "venda_id", "produto_id", "ano", "mes", "preco_unitario",
        _cents(F.col("preco_unitario") * year_factor(F.col("ano"), factors))
        .alias("preco_reajustado"))


def escalate_expenses(expenses: DataFrame, factors: Mapping[int, str], fixed: Column,
                      payroll: Column) -> DataFrame:
    """Expense raised by year; variable ones also follow 85 % fixed plus 15 %
    seasonal load, and payroll carries the thirteenth salary in Nov and Dec."""
    month = month_of("mes_referencia")
    load = F.when(fixed, dec("1.0000")).otherwise(
        dec("0.85") + dec("0.15") * seasonal_weight(month)).cast(_PLAN)
    raised = F.col("valor") * year_factor(year_of("mes_referencia"), factors)
    thirteenth = F.when(payroll & (month >= 11), dec(THIRTEENTH_SALARY)).otherwise(dec("1.00"))
    adjusted = _cents(raised.cast("decimal(22,6)") * load)
    return expenses.select(
        "despesa_id", "ano", "mes", "natureza", "valor",
        _cents(adjusted * thirteenth).alias("valor_reajustado"))
