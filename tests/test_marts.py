from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from castledger.functions.expr import MONEY
from castledger.operators import intermediate, marts, reports
from castledger.operators.marts import FinanceParams


def frame(spark, columns, rows):
    """``name:type`` columns; d = money, i = bigint, s = string."""
    kinds = {"d": MONEY, "i": "bigint", "s": "string"}
    parts = [c.split(":") for c in columns.split()]
    data = [tuple(D(str(v)) if k == "d" and v is not None else v
                  for v, (_, k) in zip(r, parts)) for r in rows]
    return spark.createDataFrame(data, ", ".join(f"{n} {kinds[k]}" for n, k in parts))


def statement(spark, months, costs=(), expenses=()):
    """months: (ano, mes, R); costs: (ano, mes, C); expenses: (ano, mes, O, D, F)."""
    revenue = frame(
        spark, "ano:i mes:i linha_producao_id:s receita_bruta:d total_descontos:d "
        "total_devolucoes:d receita_liquida:d qtd_vendas:i qtd_pecas_vendidas:i",
        [(a, m, "LP01", r, 0, 0, r, 2, 4) for a, m, r in months])
    cogs = frame(spark, "ano:i mes:i linha_producao_id:s cmv_total:d cmv_materia_prima:d "
                 "cmv_mao_obra:d cmv_cif:d", [(a, m, "LP01", c, c, 0, 0) for a, m, c in costs])
    spent = frame(
        spark, "ano:i mes:i despesa_fabrica:d despesa_vendas:d despesa_admin:d depreciacao:d "
        "resultado_financeiro:d total_despesas_operacionais:d total_despesas:d",
        [(a, m, o, 0, 0, d, f, o, o + d + f) for a, m, o, d, f in expenses])
    return marts.mart_dre_mensal(revenue, cogs, spent)


def test_loss_month_pays_no_tax(spark):
    r = statement(spark, [(2022, 1, 100)], [(2022, 1, 60)], [(2022, 1, 50, 5, 5)]).first()
    assert (r.ebitda, r.ebit, r.lucro_antes_ir) == (-10, -15, -20)
    assert (r.ir_csll, r.lucro_liquido, r.margem_liquida_pct) == (0, -20, D("-20.00"))


def test_profit_month(spark):
    r = statement(spark, [(2022, 1, 100)], [(2022, 1, 40)], [(2022, 1, 20, 5, 5)]).first()
    assert (r.lucro_bruto, r.ebitda, r.ebit, r.lucro_antes_ir) == (60, 40, 35, 30)
    assert (r.ir_csll, r.lucro_liquido, r.ticket_medio) == (D("10.20"), D("19.80"), 50)
    assert str(r.data_referencia) == "2022-01-01"


def test_tax_rate_is_a_parameter(spark):
    revenue = frame(
        spark, "ano:i mes:i linha_producao_id:s receita_bruta:d total_descontos:d "
        "total_devolucoes:d receita_liquida:d qtd_vendas:i qtd_pecas_vendidas:i",
        [(2022, 1, "LP01", 100, 0, 0, 100, 1, 1)])
    empty_c = frame(spark, "ano:i mes:i cmv_total:d cmv_materia_prima:d cmv_mao_obra:d cmv_cif:d", [])
    empty_d = frame(
        spark, "ano:i mes:i despesa_fabrica:d despesa_vendas:d despesa_admin:d depreciacao:d "
        "resultado_financeiro:d total_despesas_operacionais:d", [])
    r = marts.mart_dre_mensal(revenue, empty_c, empty_d, FinanceParams("0.25")).first()
    assert r.ir_csll == 25


def test_month_without_costs_keeps_null_cost_and_full_profit(spark):
    r = statement(spark, [(2022, 1, 100)]).first()
    assert r.cmv is None and r.lucro_bruto == 100 and r.despesa_vendas == 0


def test_month_without_sales_is_absent(spark):
    assert statement(spark, [(2022, 1, 100)], [(2022, 2, 60)], [(2022, 2, 1, 1, 1)]).count() == 1


def test_zero_revenue_gives_null_margins(spark):
    r = statement(spark, [(2022, 1, 0)], [(2022, 1, 10)]).first()
    assert r.margem_bruta_pct is None and r.lucro_bruto == -10


def test_lag_counts_rows_not_months(spark):
    kpis = marts.mart_kpis_executivo(
        statement(spark, [(2022, 1, 100), (2022, 3, 150)])).orderBy("mes").collect()
    assert (kpis[1].receita_liquida_mes_anterior, kpis[1].receita_mom_pct) == (100, 50)
    assert kpis[1].receita_liquida_ytd == 250 and kpis[0].receita_mom_pct is None


def test_year_over_year_and_magnitude_base(spark):
    months = [(2021 + i // 12, i % 12 + 1, 100 + i) for i in range(14)]
    costs = [(2021, 1, 110), (2022, 1, 107)]
    rows = marts.mart_kpis_executivo(statement(spark, months, costs)).orderBy("ano", "mes").collect()
    january = rows[12]
    assert january.receita_liquida_ano_anterior == 100 and january.receita_yoy_pct == 12
    # gross profit went from -10 to 5 on a base taken as magnitude
    assert (january.lucro_bruto_ano_anterior, january.lucro_bruto_yoy_pct) == (-10, 150)


SALES = "ano:i mes:i produto_id:s linha_producao_id:s quantidade:i valor_bruto:d valor_liquido:d"
COSTS = ("produto_id:s ano:i mes:i custo_total_unitario:d custo_materia_prima:d "
         "custo_mao_obra_direta:d custo_indireto_fabricacao:d")
PRODUCTS = "produto_id:s produto_nome:s linha_producao_nome:s custo_padrao_unitario:d"


def margins(spark, sales, costs, products=()):
    return marts.product_margins(
        frame(spark, SALES, sales), frame(spark, COSTS, costs), frame(spark, PRODUCTS, products))


@pytest.mark.parametrize("net, cost, status", [
    ("99.99", "100", "MARGEM_NEGATIVA"), ("100", "85.01", "ABAIXO_THRESHOLD"),
    ("100", "85.00", "SAUDAVEL"), ("0", "0", "SAUDAVEL")])
def test_margin_status(spark, net, cost, status):
    row = margins(spark, [(2022, 1, "p", "LP01", 1, 100, net)],
                  [("p", 2022, 1, cost, 0, 0, 0)]).first()
    assert row.status_margem == status


def test_sales_without_cost_leave_margins_and_their_denominator(spark):
    df = margins(spark, [(2022, 1, "p", "LP01", 1, 10, 10), (2022, 1, "q", "LP01", 1, 90, 90)],
                 [("p", 2022, 1, 4, 0, 0, 0)], [("p", "P", "L", 5)])
    row = marts.mart_margem_produto(df).collect()
    assert len(row) == 1 and row[0].pct_receita_mes == 100
    assert row[0].variacao_custo_vs_padrao_pct == -20
    assert row[0].margem_contribuicao_unitaria == 6


def test_rank_is_total_and_shares_add_up(spark):
    n = 40
    sales = [(2022, m, f"p{i:02d}", "LP01", 1, 100, 100 + i // 4) for m in (1, 2) for i in range(n)]
    costs = [(f"p{i:02d}", 2022, m, 10, 0, 0, 0) for m in (1, 2) for i in range(n)]
    rows = marts.mart_margem_produto(margins(spark, sales, costs)).collect()
    for month in (1, 2):
        mine = [r for r in rows if r.mes == month]
        want = sorted(mine, key=lambda r: (-r.margem_bruta, r.produto_id))
        assert [r.ranking_margem_mes for r in want] == list(range(1, n + 1))
        assert abs(sum(r.pct_receita_mes for r in mine) - 100) < D("0.5")


def test_cost_of_goods_matches_row_level_sums(spark):
    sales = [(2022, 1, p, line, q, 10, 10) for p, line, q in (
        ("a", "LP01", 1), ("a", "LP01", 2), ("a", "LP02", 3), ("b", "LP01", 4), ("c", "LP01", 9))]
    costs = [("a", 2022, 1, "1.11", "1", "0.1", "0.01"), ("b", 2022, 1, "2.22", "2", "0.2", None),
             ("b", 2022, 1, "0.50", None, "0.5", None)]  # month delivered twice; c has no cost
    got = {r.linha_producao_id: r for r in intermediate.int_cmv_mensal(
        frame(spark, SALES, sales), frame(spark, COSTS, costs)).collect()}
    one = got["LP01"]
    assert one.cmv_total == D("3.33") + 4 * (D("2.22") + D("0.50"))
    assert (one.cmv_materia_prima, one.cmv_cif) == (11, D("0.03"))
    assert (one.qtd_total_vendida, one.qtd_produtos) == (11, 2)
    assert got["LP02"].cmv_total == D("3.33")


BUDGET = "ano:i mes:i tipo:s natureza:s centro_custo_tipo:s valor_orcado:d"
SPENT = "ano:i mes:i classificacao_dre:s natureza:s centro_custo_tipo:s valor:d"


def compare(spark, budget, spent):
    return marts.mart_orcado_realizado(frame(spark, BUDGET, budget), frame(spark, SPENT, spent))


@pytest.mark.parametrize("actual, status", [
    ("120.00", "DESVIO_ALERTA"), ("120.01", "DESVIO_CRITICO"), ("110.00", "DESVIO_MODERADO"),
    ("105.00", "DENTRO_ORCAMENTO"), ("79.99", "DESVIO_CRITICO")])
def test_deviation_bands(spark, actual, status):
    row = compare(spark, [(2022, 1, "DESPESA", "n", "A", 100)],
                  [(2022, 1, "DESPESA_ADMIN", "n", "A", actual)]).first()
    assert row.status_desvio == status


def test_unbudgeted_spend_is_within_budget_and_revenue_never_matches(spark):
    rows = {r.natureza: r for r in compare(
        spark, [(2022, 1, "RECEITA", "receita", "COMERCIAL", 100)],
        [(2022, 1, "DESPESA_ADMIN", "extra", "A", 50)]).collect()}
    assert (rows["extra"].status_desvio, rows["extra"].direcao_desvio) == (
        "DENTRO_ORCAMENTO", "ACIMA_ORCADO")
    assert rows["extra"].variancia_pct is None and rows["extra"].tipo == "DESPESA_ADMIN"
    assert (rows["receita"].variancia_pct, rows["receita"].status_desvio) == (-100, "DESVIO_CRITICO")
    assert rows["receita"].atingimento_pct is None


def test_one_budget_line_meets_every_cost_centre(spark):
    rows = compare(spark, [(2022, 1, "DESPESA", "n", "A", 100)],
                   [(2022, 1, "DESPESA_ADMIN", "n", cc, 10) for cc in "AB"]).collect()
    assert len(rows) == 2 and all(r.valor_orcado == 100 and r.centro_custo_tipo == "A" for r in rows)


def test_null_keys_stay_apart(spark):
    rows = compare(spark, [(2022, 1, "DESPESA", None, "A", 100)],
                   [(2022, 1, "DESPESA_ADMIN", None, "A", 10)]).collect()
    assert sorted(r.valor_orcado for r in rows) == [0, 100]


def test_expense_pivot_agrees_with_conditional_sums(spark):
    spent = frame(spark, SPENT, [(2022, 1, c, "n", "A", i + 1) for i, c in enumerate(
        intermediate.EXPENSE_CLASSES)] + [(2022, 1, "OUTRA", "n", "A", 99)])
    sums = intermediate.int_despesas_dre(spent).first()
    pivot = intermediate.expenses_pivot(spent).first()
    assert all(sums[c.lower()] == pivot[c] for c in intermediate.EXPENSE_CLASSES)
    assert (sums.total_despesas_operacionais, sums.total_despesas) == (6, 114)
    assert pivot[intermediate.OTHER_CLASSES] == 99


def test_heatmap_has_every_line(spark):
    cells = reports.margin_heatmap(frame(
        spark, "ano:i mes:i linha_producao_id:s qtd_vendida:i receita_liquida:d cmv_produto:d margem_bruta:d",
        [(2022, 1, "LP01", 1, 10, 5, 5), (2022, 1, "LP05", 1, 100, 75, 25)])).collect()
    assert {r.linha_producao_id: int(r.margem_bruta_pct) for r in cells} == {"LP01": 50, "LP05": 25}


def test_revenue_counts_distinct_ids(spark):
    df = frame(spark, "ano:i mes:i linha_producao_id:s venda_id:s produto_id:s cliente_id:s "
               "quantidade:i valor_bruto:d valor_desconto:d devolucao_valor:d",
               [(2022, 1, "LP01", v, "p", c, 2, 10, 1, 1) for v, c in (("a", "x"), ("a", "y"),
                                                                      ("b", None))])
    row = intermediate.int_receita_liquida(df).first()
    assert (row.qtd_vendas, row.qtd_produtos_vendidos, row.qtd_clientes) == (2, 1, 2)
    assert (row.receita_liquida, row.qtd_pecas_vendidas) == (24, 6)


def test_a_missing_month_leaves_only_its_own_comparison_empty(spark):
    from castledger.operators.reports import kpis_by_calendar

    rows = [(2022, m, m, m, m, m) for m in range(1, 13) if m != 3] + [(2023, m, 2 * m, 2 * m, -m, 2 * m) for m in range(1, 5)]
    statement = spark.createDataFrame(rows, "ano bigint, mes bigint, " + ", ".join(
        f"{c} int" for c in ("receita_liquida", "lucro_bruto", "ebitda", "lucro_liquido"))).select(
        "ano", "mes", *[F.col(c).cast("decimal(20,2)") for c in ("receita_liquida", "lucro_bruto", "ebitda", "lucro_liquido")])
    got = {(r.ano, r.mes): (r.receita_liquida_ano_anterior, r.receita_liquida_yoy_calendario_pct, r.ebitda_yoy_calendario_pct)
           for r in kpis_by_calendar(statement).collect()}
    assert got[(2023, 3)] == (None, None, None) and got[(2022, 5)] == (None, None, None)
    assert [got[(2023, m)] for m in (1, 2, 4)] == [(m, 100, -200) for m in (1, 2, 4)]
