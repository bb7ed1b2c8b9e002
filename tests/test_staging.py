import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from castledger.operators import staging
from castledger.sources.registry import INGESTED_AT, SPECS

NOW = dt.datetime(2024, 1, 1)


def raw(spark, table, rows):
    """Rows given as dicts; missing columns are NULL."""
    schema = SPECS[table].schema
    data = [tuple(r.get(f.name) for f in schema) for r in rows]
    return spark.createDataFrame(data, schema).withColumn(INGESTED_AT, F.lit(NOW))


def sale(**changes):
    base = dict(venda_id="V1", nota_fiscal="N1", data_emissao=dt.datetime(2022, 3, 5, 23, 30),
                cliente_id="C1", cliente_nome=" acme ", tipo_cliente=" montadora\t",
                produto_id="P1", quantidade=2.5, preco_unitario=10.005, valor_bruto=25.005,
                desconto_percentual=0.01235, valor_desconto=0.285, valor_liquido=24.72,
                linha_producao_id="LP01")
    return {**base, **changes}


def test_sales_are_typed_and_cleaned(spark):
    row = staging.stg_vendas(raw(spark, "raw_vendas", [sale()])).first()
    assert (row.quantidade, row.preco_unitario, row.valor_bruto) == (3, D("10.01"), D("25.01"))
    assert (row.cliente_nome, row.tipo_cliente) == ("ACME", "MONTADORA")
    assert (row.data_emissao, row.ano, row.mes) == (dt.date(2022, 3, 5), 2022, 3)
    assert row.desconto_percentual == D("0.0124")
    assert (row.devolucao_quantidade, row.devolucao_valor) == (0, D("0.00"))
    assert row[INGESTED_AT] == NOW


@pytest.mark.parametrize("bad", [
    dict(venda_id=None), dict(quantidade=0.0), dict(quantidade=0.4), dict(quantidade=-1.0),
    dict(quantidade=None), dict(valor_bruto=0.0), dict(valor_bruto=-5.0), dict(valor_bruto=None)])
def test_invalid_sales_are_dropped(spark, bad):
    assert staging.stg_vendas(raw(spark, "raw_vendas", [sale(**bad)])).count() == 0


def test_small_positive_values_survive(spark):
    kept = staging.stg_vendas(raw(spark, "raw_vendas", [sale(quantidade=0.5, valor_bruto=0.001)]))
    assert [(r.quantidade, r.valor_bruto) for r in kept.collect()] == [(1, D("0.00"))]


def test_costs_without_value_are_dropped(spark):
    rows = [dict(produto_id="P", mes_referencia=NOW, custo_total_unitario=v)
            for v in (1.0, 0.0, -1.0, None)] + [
        dict(produto_id=None, mes_referencia=NOW, custo_total_unitario=1.0),
        dict(produto_id="P", mes_referencia=None, custo_total_unitario=1.0)]
    assert staging.stg_custos(raw(spark, "raw_custos", rows)).count() == 1


def test_nature_keeps_its_case(spark):
    row = staging.stg_despesas(raw(spark, "raw_despesas", [dict(
        despesa_id="D", mes_referencia=NOW, centro_custo_tipo=" produção ", natureza=" Energia ",
        classificacao_dre="despesa_fabrica ", valor=-1.005)])).first()
    assert (row.natureza, row.centro_custo_tipo) == ("Energia", "PRODUÇÃO")
    assert (row.classificacao_dre, row.valor) == ("DESPESA_FABRICA", D("-1.01"))


def test_commodity_month_is_redefined_from_the_source(spark):
    row = staging.stg_commodities(raw(spark, "raw_commodities", [
        dict(mes=dt.datetime(2023, 7, 1), commodity="aço ", indice=1.23456)])).first()
    assert (row.mes_referencia, row.ano, row.mes) == (dt.date(2023, 7, 1), 2023, 7)
    assert (row.commodity, row.indice) == ("AÇO", D("1.2346"))


def test_product_margin_is_null_without_price(spark):
    rows = [dict(produto_id=p, preco_venda_unitario=v, custo_padrao_unitario=60.0, status="ativo")
            for p, v in (("a", 100.0), ("b", 0.0))]
    got = {r.produto_id: r.margem_padrao_pct
           for r in staging.stg_produtos(raw(spark, "raw_produtos", rows)).collect()}
    assert got == {"a": D("0.4000"), "b": None}


def test_cost_change_needs_a_positive_base(spark):
    rows = [dict(historico_id=h, custo_padrao_anterior=b, custo_padrao_novo=11.0, is_current=True,
                 data_vigencia_fim=dt.datetime(9999, 12, 31))
            for h, b in (("a", 10.0), ("b", 0.0), ("c", None))]
    got = {r.historico_id: (r.variacao_pct, r.valid_to) for r in
           staging.dim_historico_custos(raw(spark, "raw_historico_custos", rows)).collect()}
    assert got["a"] == (D("0.1000"), dt.date(9999, 12, 31))
    assert got["b"][0] is None and got["c"][0] is None


def test_unusable_numbers_raise(spark):
    df = spark.createDataFrame(
        [("O", "2024", "13", "T", "N", "C", "abc")],
        "orcamento_id string, ano string, mes string, tipo string, natureza string, "
        "centro_custo_tipo string, valor_orcado string").withColumn(INGESTED_AT, F.lit(NOW))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.stg_orcamento(df).collect()
