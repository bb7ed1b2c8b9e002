"""Monthly revenue, cost of goods sold and expense totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from castledger.functions.expr import TOTAL, times, total

# The five income-statement classes and the operating ones.
EXPENSE_CLASSES = ("DESPESA_FABRICA", "DESPESA_VENDAS", "DESPESA_ADMIN", "DEPRECIACAO",
                   "RESULTADO_FINANCEIRO")
OPERATING_CLASSES = EXPENSE_CLASSES[:3]
OTHER_CLASSES = "OUTRAS"

MONTH = ["ano", "mes"]
MONTH_LINE = ["ano", "mes", "linha_producao_id"]


def int_receita_liquida(sales: DataFrame) -> DataFrame:
    """Revenue lines and counts per month and line.

    Three distinct counts in one aggregation would expand every sale to four
    rows. Here sums and products come from sales folded to products first, and
    clients and sale ids from narrow distinct lists of their own.
    """
    money = ("valor_bruto", "valor_desconto", "devolucao_valor", "quantidade")
    by_product = sales.groupBy(*MONTH_LINE, "produto_id").agg(*[F.sum(c).alias(c) for c in money])
    sums = by_product.groupBy(*MONTH_LINE).agg(
        total("valor_bruto").alias("receita_bruta"),
        total("valor_desconto").alias("total_descontos"),
        total("devolucao_valor").alias("total_devolucoes"),
        (F.sum("valor_bruto") - F.sum("valor_desconto") - F.sum("devolucao_valor"))
        .cast(TOTAL).alias("receita_liquida"),
        F.sum("quantidade").alias("qtd_pecas_vendidas"),
        F.count("produto_id").alias("qtd_produtos_vendidos"),
    )

    def counted(column: str, name: str) -> DataFrame:
        return sales.select(*MONTH_LINE, column).distinct().groupBy(
            *[F.col(c).alias(f"_{c}") for c in MONTH_LINE]).agg(F.count(column).alias(name))

    for column, name in (("venda_id", "qtd_vendas"), ("cliente_id", "qtd_clientes")):
        same = F.lit(True)
        for c in MONTH_LINE:
            same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
        sums = sums.join(counted(column, name), same).drop(*[f"_{c}" for c in MONTH_LINE])
    return sums.select(
        *MONTH_LINE, "receita_bruta", "total_descontos", "total_devolucoes", "receita_liquida",
        "qtd_vendas", "qtd_pecas_vendidas", "qtd_produtos_vendidos", "qtd_clientes")


def product_months(sales: DataFrame) -> DataFrame:
    """Sales folded to one row per month, product and line.

    Everything that needs a unit cost starts here: a best-selling product
    collapses in the map-side combine before any row of it is shuffled.
    """
    return sales.groupBy("ano", "mes", "produto_id", "linha_producao_id").agg(
        F.sum("quantidade").alias("qtd_vendida"),
        total("valor_bruto").alias("receita_bruta"),
        total("valor_liquido").alias("receita_liquida"),
    )


def int_cmv_mensal(sales: DataFrame, costs: DataFrame) -> DataFrame:
    """Quantity times unit cost, per month and line.

    The unit cost is constant within a product-month, so quantities are summed
    first and multiplied once; that is exact in decimals. Costs are summed per
    product-month too (with their row count, in case a month was delivered
    twice), which makes the join one-to-one and turns the distinct product
    count into a plain count.
    """
    key = ["produto_id", "ano", "mes"]
    components = ("custo_total_unitario", "custo_materia_prima", "custo_mao_obra_direta",
                  "custo_indireto_fabricacao")
    unit = costs.where(F.col("custo_total_unitario").isNotNull()).groupBy(*key).agg(
        *[F.sum(c).alias(c) for c in components], F.count("*").alias("n_custos"))

    # Both sides have the product-month grain and grow together: never broadcast.
    sold = product_months(sales)
    costed = sold.join(unit.hint("merge"), key, "inner")

    def cost_of(component: str, name: str):
        return total(times("qtd_vendida", component)).alias(name)

    return costed.groupBy(*MONTH_LINE).agg(
        cost_of("custo_total_unitario", "cmv_total"),
        cost_of("custo_materia_prima", "cmv_materia_prima"),
        cost_of("custo_mao_obra_direta", "cmv_mao_obra"),
        cost_of("custo_indireto_fabricacao", "cmv_cif"),
        F.sum(F.col("qtd_vendida") * F.col("n_custos")).alias("qtd_total_vendida"),
        F.count("produto_id").alias("qtd_produtos"),
    )


def int_despesas_dre(expenses: DataFrame) -> DataFrame:
    kind = F.col("classificacao_dre")

    def only(condition, name: str):
        return total(F.when(condition, F.col("valor")).otherwise(F.lit(0))).alias(name)

    return expenses.groupBy(*MONTH).agg(
        *[only(kind == c, c.lower()) for c in EXPENSE_CLASSES],
        only(kind.isin(*OPERATING_CLASSES), "total_despesas_operacionais"),
        total("valor").alias("total_despesas"),
    )


def expenses_pivot(expenses: DataFrame) -> DataFrame:
    """The same classes as a pivot, all others together as OUTRAS; absent classes
    stay NULL. The value list is fixed, so no extra pass over the data looks for it."""
    kind = F.col("classificacao_dre")
    named = F.when(kind.isin(*EXPENSE_CLASSES), kind).otherwise(OTHER_CLASSES)
    return expenses.withColumn("classe", named).groupBy(*MONTH).pivot(
        "classe", [*EXPENSE_CLASSES, OTHER_CLASSES]).agg(total("valor"))
