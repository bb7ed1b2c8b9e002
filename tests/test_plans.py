"""Physical plans: what reaches the scan, what is joined how, what stays in the JVM."""

import pytest

from castledger.plans.queries import models, queries

LAZY = ["mart_dre_mensal", "mart_kpis_executivo", "mart_orcado_realizado", "margin_by_line",
        "int_cmv_mensal", "int_receita_liquida", "scd2_current", "dedup_vendas",
        "dq_relationships", "cost_rollup", "budget_phasing"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, folder, name):
    plan = plan_of(queries()[name](spark, folder))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan and "Pandas" not in plan


def test_income_statement_skips_unused_tables_and_columns(spark, folder):
    plan = plan_of(models(spark, folder).get("mart_dre_mensal"))
    assert "customer.parquet" not in plan and "c_name" not in plan
    assert "o_custkey" not in plan and "p_name" not in plan and "l_tax" not in plan


def test_filters_reach_the_scan(spark, folder, tmp_path):
    from castledger.operators.staging import stg_vendas
    from castledger.sources.testdata import TestData

    path = str(tmp_path / "vendas")
    TestData(spark, folder).raw("raw_vendas").write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = plan_of(stg_vendas(spark.read.parquet(path)).select("venda_id", "valor_bruto"))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters"):]
    for part in ("IsNotNull(venda_id)", "GreaterThan(quantidade", "GreaterThan(valor_bruto"):
        assert part in pushed
    assert "cliente_nome" not in plan


def test_costs_are_never_broadcast(spark, folder):
    plan = plan_of(models(spark, folder).get("int_cmv_mensal"))
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_budget_and_actuals_are_read_once(spark, folder, tmp_path):
    from castledger.operators.marts import mart_orcado_realizado

    m = models(spark, folder)
    for name in ("stg_orcamento", "stg_despesas"):
        m.get(name).write.parquet(str(tmp_path / name))
    df = mart_orcado_realizado(*(spark.read.parquet(str(tmp_path / n)) for n in ("stg_orcamento", "stg_despesas")))
    plan = plan_of(df)
    assert plan.count("FileScan parquet") == 2 and "FullOuter" in plan and "Broadcast" not in plan
    # only the aggregate and the join move rows
    assert plan.count("Exchange") <= 3


def test_month_ranking_has_no_large_task(spark, folder):
    from castledger.operators import ordered
    from castledger.operators.intermediate import MONTH

    margins = models(spark, folder).get("product_margins")
    placed = ordered.with_cells(margins, MONTH, "margem_bruta", ["produto_id", "linha_producao_id"], cells=8)
    cells = {(r.ano, r.mes, r[ordered._CELL]): r["count"] for r in placed.groupBy(*MONTH, ordered._CELL).count().collect()}
    for month in {c[:2] for c in cells}:
        own = [n for c, n in cells.items() if c[:2] == month]
        assert max(own) <= 2 * sum(own) / 8 + 1
