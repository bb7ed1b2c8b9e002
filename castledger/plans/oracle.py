"""Reference SQL for DuckDB, one self-contained statement per registered query.

Percentages are computed here in whole numbers (HUGEINT), rounding halves away
from zero exactly, so the SQL is an independent check of the decimal
arithmetic on the Spark side.
"""

from __future__ import annotations

import re

from castledger.functions.expr import NUMERIC
from castledger.operators import planning, quality, reports, sketches
from castledger.operators.intermediate import EXPENSE_CLASSES, OPERATING_CLASSES
from castledger.plans import queries as q
from castledger.sources.registry import SPECS, TABLES
from castledger.sources.testdata import BASE_YEAR, QUARTERS

M = "decimal(18,2)"


# -- expression helpers ----------------------------------------------------

def cents(x: str) -> str:
    """Amount with two decimals as a whole number of cents."""
    return f"cast(round(({x}) * 100, 0) as hugeint)"


def quotient(a: str, b: str, scale: int) -> str:
    """``round(a / b * 10^scale)`` of two whole numbers; NULL when b is zero."""
    up = 10 ** scale
    return (f"(case when ({b}) = 0 then null else sign({a}) * sign({b}) * "
            f"((2 * {up} * abs({a}) + abs({b})) // (2 * abs({b}))) end)")


def whole_pct(a: str, b: str) -> str:
    """Percentage of two whole numbers, two digits, as a decimal."""
    return f"cast({quotient(a, b, 4)} as decimal(30,0)) * cast('0.01' as decimal(3,2))"


def pct(a: str, b: str) -> str:
    return whole_pct(cents(a), cents(b))


def growth(now: str, before: str, magnitude: bool) -> str:
    return pct(f"{now} - {before}", f"abs({before})" if magnitude else before)


def d(value: str) -> str:
    whole, _, frac = value.partition(".")
    return f"cast('{value}' as decimal({max(len(whole) + len(frac), 1)},{len(frac)}))"


def r2(x: str) -> str:
    return f"cast(round({x}, 2) as {M})"


def money(x: str) -> str:
    return f"cast(round(cast({x} as {NUMERIC}), 2) as {M})"


def rate(x: str) -> str:
    return f"cast(round(cast({x} as {NUMERIC}), 4) as decimal(18,4))"


def clean(x: str) -> str:
    return f"upper(trim({x}))"


def dated(x: str, name: str) -> str:
    return (f"cast({x} as date) as {name}, cast(year(cast({x} as date)) as bigint) as ano, "
            f"cast(month(cast({x} as date)) as bigint) as mes")


def month(x: str) -> str:
    return f"cast(date_trunc('month', {x}) as date)"


def age(x: str) -> str:
    return f"((year({x}) - {BASE_YEAR}) * 12 + month({x}) - 1)"


def total(x: str) -> str:
    return f"cast(sum({x}) as decimal(20,2))"


# -- raw tables ------------------------------------------------------------

PADRAO = r2(f"cast(p_retailprice as {M}) * {d('0.60')}")
INDEX = "cast(100 + ({i} * 7 + ({k}) * 13) % 36 as decimal(10,0)) * " + d("0.01")


def _sales(id_tail: str, product: str = "l_partkey", tax: str = "0") -> str:
    gross = f"cast(l_extendedprice as {M})"
    discount = r2(f"{gross} * cast(l_discount as decimal(6,4))")
    back = r2(f"{gross} * {d('0.1')}")
    returned = f"case l_returnflag when 'R' then {{0}} when 'N' then 0 end"
    return f"""
      select case when l_orderkey % 103 <> 0
               then 'VND-' || l_orderkey || '-' || l_linenumber{id_tail} end as venda_id,
        'NF-' || l_orderkey as nota_fiscal, l_shipdate as data_emissao,
        cast(o_custkey as varchar) as cliente_id,
        ' ' || lower(c_name) || ' ' as cliente_nome,
        case when c_mktsegment = 'AUTOMOBILE' then ' montadora ' else 'distribuidor' end
          as tipo_cliente,
        cast({product} as varchar) as produto_id,
        case when l_orderkey % 97 = 0 then 0.0::double else l_quantity end as quantidade,
        l_extendedprice as preco_unitario,
        case when l_orderkey % 101 = 0 then 0.0::double else l_extendedprice end as valor_bruto,
        l_discount as desconto_percentual,
        cast({discount} as double) as valor_desconto,
        {returned.format('floor(l_quantity / 10)')} as devolucao_quantidade,
        {returned.format(f'cast({back} as double)')} as devolucao_valor,
        cast({gross} - {discount} - case when l_returnflag = 'R' then {back} + {tax} else 0 end as double)
          as valor_liquido,
        'LP0' || (l_partkey % 4 + 1) as linha_producao_id
      from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey"""


_LONG_ID = " || '-' || l_partkey || '-' || l_suppkey || '-' || cast(l_shipdate as date)"

CTES: dict[str, str] = {
    "calendario": """
      select cast(unnest(generate_series(date_trunc('month', min(l_shipdate)),
        date_trunc('month', max(l_shipdate)), interval 1 month)) as date) as mes from lineitem""",
    "raw_vendas": _sales(_LONG_ID),
    "raw_vendas_linha": _sales(""),
    "raw_vendas_composto": _sales(_LONG_ID, product="l_partkey + l_linenumber - 1"),
    "raw_vendas_imposto": _sales(_LONG_ID, tax=r2(f"cast(l_extendedprice as {M}) * cast(l_tax as decimal(6,4))")),
    "custo_base": f"""
      select p_partkey, mes, {age('mes')} as i, {PADRAO} as padrao,
        cast({INDEX.format(i=age('mes'), k='p_partkey % 4')} as decimal(6,4)) as indice
      from part, calendario where p_partkey % 17 <> 0""",
    "custo_partes": f"""
      select *, {r2(f"padrao * {d('0.60')} * indice")} as mp,
        {r2(f"padrao * {d('0.25')} * case i % 3 when 0 then {d('1.00')} when 1 then {d('1.07')} else {d('1.12')} end")} as mod,
        {r2(f"padrao * {d('0.15')} * cast(1 + {d('0.004')} * cast(i as decimal(10,0)) as decimal(10,4))")} as cif
      from custo_base""",
    "raw_custos": f"""
      select cast(p_partkey as varchar) as produto_id, mes as mes_referencia,
        cast(mp as double) as custo_materia_prima, cast(mod as double) as custo_mao_obra_direta,
        cast(cif as double) as custo_indireto_fabricacao,
        case when p_partkey % 19 = 0 and month(mes) = 1 then 0.0::double
          else cast(mp + mod + cif as double) end as custo_total_unitario,
        cast(padrao as double) as custo_padrao_unitario,
        {quotient(cents('mp + mod + cif - padrao'), cents('padrao'), 4)} / 10000.0::double
          as variacao_custo_pct,
        cast(indice as double) as indice_commodity,
        'LP0' || (p_partkey % 4 + 1) as linha_producao_id
      from custo_partes""",
    "raw_despesas": f"""
      select 'DESP-' || o_orderkey as despesa_id, {month('o_orderdate')} as mes_referencia,
        case o_orderstatus when 'F' then 'produção' when 'O' then 'comercial '
          else 'ADMINISTRATIVO' end as centro_custo_tipo,
        case when o_orderpriority = '5-LOW' then ' 5-LOW '
          else o_orderpriority || ' / ' || o_orderstatus end as natureza,
        case left(o_orderpriority, 1) when '1' then 'DESPESA_FABRICA' when '2' then ' despesa_vendas'
          when '3' then 'DESPESA_ADMIN' when '4' then 'DEPRECIACAO'
          else 'RESULTADO_FINANCEIRO' end as classificacao_dre,
        case when o_orderkey % 89 <> 0
          then cast({r2(f"cast(o_totalprice as {M}) * {d('0.5')}")} as double) end as valor
      from orders""",
    "raw_orcamento": f"""
      select 'ORC-' || (ano + 1) || '-' || mes || '-' || natureza as orcamento_id,
        ano + 1 as ano, mes, tipo, natureza, centro_custo_tipo, cast(v as double) as valor_orcado
      from (
        select ano, mes, 'DESPESA' as tipo, natureza, min(centro_custo_tipo) as centro_custo_tipo,
          case when natureza like '4%' and mes = 2 then 0
            else {r2(f"sum(valor) * {d('1.1')}")} end as v
        from stg_despesas group by ano, mes, natureza
        union all
        select ano, mes, 'RECEITA', 'Receita Bruta de Vendas', 'COMERCIAL',
          {r2(f"sum(valor_bruto) * {d('1.1')}")}
        from stg_vendas group by ano, mes)""",
    "raw_historico_custos": f"""
      select 'HIST-' || p_partkey || '-' || qn as historico_id,
        cast(p_partkey as varchar) as produto_id,
        cast(lag(novo) over w as double) as custo_padrao_anterior,
        cast(novo as double) as custo_padrao_novo, inicio as data_vigencia_inicio,
        case when lead(qn) over w is null then date '9999-12-31'
          else cast(inicio + interval 3 month - interval 1 day as date) end as data_vigencia_fim,
        case when qn = 0 then 'CUSTO_INICIAL' else (case qn % 4 when 0 then 'REAJUSTE_COMMODITY'
          when 1 then 'REVISAO_TRIMESTRAL' when 2 then 'RENEGOCIACAO_FORNECEDOR'
          else 'ALTERACAO_PROCESSO' end) end as motivo,
        lead(qn) over w is null as is_current
      from (
        select p_partkey, qn, cast(date '{BASE_YEAR}-01-01' + to_months(cast(qn * 3 as integer)) as date)
            as inicio,
          {r2(f"{PADRAO} * cast(100 + case when qn = 0 then 0 else (p_partkey * 5 + qn * 7) % 18 - 5 end as decimal(10,0)) * {d('0.01')}")} as novo
        from part, range({QUARTERS}) as t(qn)
        where p_partkey % 17 <> 0 and (qn = 0 or (p_partkey * 7 + qn * 3) % 10 < 6))
      window w as (partition by p_partkey order by qn)""",
    "raw_produtos": f"""
      select cast(p_partkey as varchar) as produto_id, ' ' || p_name || ' ' as produto_nome,
        'LP0' || (p_partkey % 4 + 1) as linha_producao_id,
        lower('LP0' || (p_partkey % 4 + 1)) as linha_producao_nome, ' pç ' as unidade_medida,
        cast({PADRAO} as double) as custo_padrao_unitario,
        case when p_partkey % 23 = 0 then 0.0::double else p_retailprice end as preco_venda_unitario,
        cast(p_size as double) as peso_kg,
        case when p_partkey % 17 = 0 then 'INATIVO' else 'ATIVO' end as status,
        date '1994-01-01' as data_cadastro, '7000.' || p_size as ncm
      from part""",
    "raw_clientes": f"""
      select cast(c_custkey as varchar) as cliente_id, ' ' || lower(c_name) || ' ' as cliente_nome,
        case when c_mktsegment = 'AUTOMOBILE' then ' montadora ' else 'distribuidor' end as tipo,
        cast(abs(cast(c_acctbal as {M})) * {d('0.0001')} as double) as peso_volume
      from customer""",
    "raw_centros_custo": """
      select 'CC' || n_nationkey as centro_custo_id, n_name as centro_custo_nome from nation""",
    "raw_commodities": f"""
      select mes, commodity, cast({INDEX.format(i=age('mes'), k='k')} as double) as indice
      from calendario, (values (0, 'aco'), (1, 'aluminio'), (2, 'polimero'), (3, 'misto'))
        as c(k, commodity)""",
}


CTES["entrega"] = """
    select case when o_orderkey % 67 <> 0 then 'DESP-' || o_orderkey end as despesa_id,
      case when o_orderkey % 61 = 0 then strftime(o_orderdate, '%d/%m/%Y') else strftime(o_orderdate, '%Y-%m-%d') end
        as mes_referencia,
      o_orderstatus as centro_custo_tipo, o_orderpriority as natureza, 'DEPRECIACAO' as classificacao_dre,
      case when o_orderkey % 53 = 0 then 'n/d' when o_orderkey % 59 = 0 then '1.234,50'
        when o_orderkey % 71 = 0 then ' ' else printf('%.2f', o_totalprice) end as valor,
      case when o_orderkey % 61 <> 0 then cast(o_orderdate as date) end as dia,
      case when o_orderkey % 53 <> 0 and o_orderkey % 59 <> 0 and o_orderkey % 71 <> 0
        then cast(printf('%.2f', o_totalprice) as double) end as numero
    from orders"""


# -- staging ---------------------------------------------------------------

def _stg_vendas(raw: str) -> str:
    return f"""
      select venda_id, nota_fiscal, produto_id, cliente_id, linha_producao_id,
        {dated('data_emissao', 'data_emissao')}, {clean('cliente_nome')} as cliente_nome,
        {clean('tipo_cliente')} as tipo_cliente, cast(round(quantidade) as bigint) as quantidade,
        {money('preco_unitario')} as preco_unitario, {money('valor_bruto')} as valor_bruto,
        {rate('desconto_percentual')} as desconto_percentual,
        {money('valor_desconto')} as valor_desconto,
        cast(round(coalesce(devolucao_quantidade, 0)) as bigint) as devolucao_quantidade,
        {money('coalesce(devolucao_valor, 0)')} as devolucao_valor,
        {money('valor_liquido')} as valor_liquido
      from {raw}
      where venda_id is not null and round(quantidade) > 0 and valor_bruto > 0"""


CTES |= {
    "stg_vendas": _stg_vendas("raw_vendas"),
    "stg_vendas_linha": _stg_vendas("raw_vendas_linha"),
    "stg_vendas_composto": _stg_vendas("raw_vendas_composto"),
    "stg_vendas_imposto": _stg_vendas("raw_vendas_imposto"),
    "stg_custos": f"""
      select produto_id, linha_producao_id, {dated('mes_referencia', 'mes_referencia')},
        {', '.join(f'{money(c)} as {c}' for c in (
            'custo_materia_prima', 'custo_mao_obra_direta', 'custo_indireto_fabricacao',
            'custo_total_unitario', 'custo_padrao_unitario'))},
        {rate('variacao_custo_pct')} as variacao_custo_pct,
        {rate('indice_commodity')} as indice_commodity
      from raw_custos where custo_total_unitario > 0""",
    "stg_despesas": f"""
      select despesa_id, {dated('mes_referencia', 'mes_referencia')},
        {clean('centro_custo_tipo')} as centro_custo_tipo, trim(natureza) as natureza,
        {clean('classificacao_dre')} as classificacao_dre, {money('valor')} as valor
      from raw_despesas where valor is not null""",
    "stg_orcamento": f"""
      select orcamento_id, cast(ano as bigint) as ano, cast(mes as bigint) as mes,
        {clean('tipo')} as tipo, trim(natureza) as natureza,
        {clean('centro_custo_tipo')} as centro_custo_tipo, {money('valor_orcado')} as valor_orcado
      from raw_orcamento""",
    "stg_produtos": f"""
      select produto_id, {clean('produto_nome')} as produto_nome, linha_producao_id,
        {clean('linha_producao_nome')} as linha_producao_nome,
        {clean('unidade_medida')} as unidade_medida, {clean('status')} as status, ncm,
        {money('custo_padrao_unitario')} as custo_padrao_unitario,
        {money('preco_venda_unitario')} as preco_venda_unitario, {money('peso_kg')} as peso_kg,
        {quotient(f"({cents(money('preco_venda_unitario'))} - {cents(money('custo_padrao_unitario'))})",
                  cents(money('preco_venda_unitario')), 4)} / 10000.0::double as margem_padrao_pct,
        data_cadastro
      from raw_produtos""",
    "stg_clientes": f"""
      select cliente_id, {clean('cliente_nome')} as cliente_nome, {clean('tipo')} as tipo_cliente,
        {rate('peso_volume')} as peso_volume
      from raw_clientes""",
    "stg_commodities": f"""
      select {dated('r.mes', 'mes_referencia')}, {clean('commodity')} as commodity,
        {rate('indice')} as indice
      from raw_commodities r""",
    "dim_historico_custos": f"""
      select historico_id, produto_id, {money('custo_padrao_anterior')} as custo_padrao_anterior,
        {money('custo_padrao_novo')} as custo_padrao_novo,
        data_vigencia_inicio as valid_from, data_vigencia_fim as valid_to, is_current,
        motivo as motivo_alteracao,
        case when custo_padrao_anterior > 0 then
          {quotient(f"({cents(money('custo_padrao_novo'))} - {cents(money('custo_padrao_anterior'))})",
                    cents(money('custo_padrao_anterior')), 4)} / 10000.0::double end as variacao_pct
      from raw_historico_custos""",
}

# -- intermediate and gold -------------------------------------------------

_KPI = ("receita_liquida", "lucro_bruto", "ebitda", "lucro_liquido")


def _class_sum(*classes: str) -> str:
    return total(f"valor) filter (where classificacao_dre in ({_list(classes)})")


def _list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


CTES |= {
    "int_receita_liquida": f"""
      select ano, mes, linha_producao_id, {total('valor_bruto')} as receita_bruta,
        {total('valor_desconto')} as total_descontos, {total('devolucao_valor')} as total_devolucoes,
        {total('valor_bruto - valor_desconto - devolucao_valor')} as receita_liquida,
        count(distinct venda_id) as qtd_vendas,
        cast(sum(quantidade) as bigint) as qtd_pecas_vendidas,
        count(distinct produto_id) as qtd_produtos_vendidos,
        count(distinct cliente_id) as qtd_clientes
      from stg_vendas group by all""",
    "int_cmv_mensal": f"""
      select v.ano, v.mes, v.linha_producao_id,
        {total('quantidade * custo_total_unitario')} as cmv_total,
        {total('quantidade * custo_materia_prima')} as cmv_materia_prima,
        {total('quantidade * custo_mao_obra_direta')} as cmv_mao_obra,
        {total('quantidade * custo_indireto_fabricacao')} as cmv_cif,
        cast(sum(quantidade) as bigint) as qtd_total_vendida,
        count(distinct v.produto_id) as qtd_produtos
      from stg_vendas v join stg_custos c using (produto_id, ano, mes) group by all""",
    "int_despesas_dre": f"""
      select ano, mes, {', '.join(f'coalesce({_class_sum(c)}, 0) as {c.lower()}' for c in EXPENSE_CLASSES)},
        coalesce({_class_sum(*OPERATING_CLASSES)}, 0) as total_despesas_operacionais,
        {total('valor')} as total_despesas
      from stg_despesas group by all""",
    "dre_base": f"""
      select ano, mes, r.*exclude(ano, mes), c.*exclude(ano, mes),
        coalesce(d.despesa_vendas, 0) as dv, coalesce(d.despesa_admin, 0) as da,
        coalesce(d.despesa_fabrica, 0) as df, coalesce(d.depreciacao, 0) as dep,
        coalesce(d.resultado_financeiro, 0) as fin,
        coalesce(d.total_despesas_operacionais, 0) as op,
        r.receita_liquida - coalesce(c.cmv, 0) as lb
      from (select ano, mes, sum(receita_bruta) as receita_bruta, sum(total_descontos) as descontos,
              sum(total_devolucoes) as devolucoes, sum(receita_liquida) as receita_liquida,
              sum(qtd_vendas) as qv, sum(qtd_pecas_vendidas) as qp
            from int_receita_liquida group by ano, mes) r
      left join (select ano, mes, sum(cmv_total) as cmv, sum(cmv_materia_prima) as cmv_materia_prima,
              sum(cmv_mao_obra) as cmv_mao_obra, sum(cmv_cif) as cmv_cif
            from int_cmv_mensal group by ano, mes) c using (ano, mes)
      left join int_despesas_dre d using (ano, mes)""",
    # profit before tax and tax in 1/10000 of the currency unit, as whole numbers
    "dre_lucro": f"""
      select *, lb - op as caixa, lb - op - dep as oper, lb - op - dep - fin as lair,
        {cents('lb - op - dep - fin')} * 100 as l4,
        greatest({cents('lb - op - dep - fin')} * 34, 0) as t4
      from dre_base""",
    "mart_dre_mensal": f"""
      select ano, mes, make_date(ano, mes, 1) as data_referencia, receita_bruta, descontos, devolucoes,
        receita_liquida, cmv, cmv_materia_prima, cmv_mao_obra, cmv_cif, lb as lucro_bruto,
        {pct('lb', 'receita_liquida')} as margem_bruta_pct, dv as despesa_vendas,
        da as despesa_admin, df as despesa_fabrica, op as total_despesas_operacionais,
        caixa as ebitda, {pct('caixa', 'receita_liquida')} as margem_ebitda_pct,
        dep as depreciacao, oper as ebit, {pct('oper', 'receita_liquida')} as margem_ebit_pct,
        fin as resultado_financeiro, lair as lucro_antes_ir,
        cast({quotient('t4', '100', 0)} as decimal(30,0)) * {d('0.01')} as ir_csll,
        cast({quotient('(l4 - t4)', '100', 0)} as decimal(30,0)) * {d('0.01')} as lucro_liquido,
        {whole_pct('(l4 - t4)', f"({cents('receita_liquida')} * 100)")} as margem_liquida_pct,
        cast(qv as bigint) as qtd_vendas, cast(qp as bigint) as qtd_pecas_vendidas,
        cast({quotient(cents('receita_bruta'), 'cast(qv as hugeint)', 0)} as decimal(30,0))
          * {d('0.01')} as ticket_medio
      from dre_lucro""",
    "mart_kpis_executivo": f"""
      select ano, mes, data_referencia, receita_bruta, receita_liquida, cmv, lucro_bruto, ebitda, ebit,
        lucro_liquido, margem_bruta_pct, margem_ebitda_pct, margem_ebit_pct, margem_liquida_pct,
        qtd_vendas, qtd_pecas_vendidas, ticket_medio, total_despesas_operacionais,
        r1 as receita_liquida_mes_anterior, {growth('receita_liquida', 'r1', False)} as receita_mom_pct,
        b1 as lucro_bruto_mes_anterior, {growth('lucro_bruto', 'b1', True)} as lucro_bruto_mom_pct,
        e1 as ebitda_mes_anterior, {growth('ebitda', 'e1', True)} as ebitda_mom_pct,
        r12 as receita_liquida_ano_anterior, {growth('receita_liquida', 'r12', False)} as receita_yoy_pct,
        b12 as lucro_bruto_ano_anterior, {growth('lucro_bruto', 'b12', True)} as lucro_bruto_yoy_pct,
        {', '.join(f'{m}_ytd' for m in _KPI)}
      from (select *, lag(receita_liquida) over t as r1, lag(lucro_bruto) over t as b1,
              lag(ebitda) over t as e1, lag(receita_liquida, 12) over t as r12,
              lag(lucro_bruto, 12) over t as b12,
              {', '.join(f'sum({m}) over y as {m}_ytd' for m in _KPI)}
            from mart_dre_mensal
            window t as (order by ano, mes), y as (partition by ano order by mes))""",
    "vendas_mes": f"""
      select ano, mes, produto_id, linha_producao_id, cast(sum(quantidade) as bigint) as qtd_vendida,
        {total('valor_bruto')} as receita_bruta, {total('valor_liquido')} as receita_liquida
      from stg_vendas group by all""",
    "product_margins": f"""
      select *, case when margem_bruta < 0 then 'MARGEM_NEGATIVA'
          when margem_bruta_pct < 15 then 'ABAIXO_THRESHOLD' else 'SAUDAVEL' end as status_margem
      from (
        select ano, mes, produto_id, produto_nome, v.linha_producao_id, linha_producao_nome,
          qtd_vendida, receita_bruta, receita_liquida, c.custo_total_unitario as custo_unitario_real,
          cast(qtd_vendida * c.custo_total_unitario as decimal(20,2)) as cmv_produto,
          cast(receita_liquida - qtd_vendida * c.custo_total_unitario as decimal(20,2))
            as margem_bruta,
          {pct('receita_liquida - qtd_vendida * c.custo_total_unitario', 'receita_liquida')}
            as margem_bruta_pct,
          cast({quotient(f"({cents('receita_liquida')} - qtd_vendida * {cents('c.custo_total_unitario')})",
                         'qtd_vendida', 0)} as decimal(30,0)) * {d('0.01')}
            as margem_contribuicao_unitaria,
          p.custo_padrao_unitario,
          {pct('c.custo_total_unitario - p.custo_padrao_unitario', 'p.custo_padrao_unitario')}
            as variacao_custo_vs_padrao_pct
        from vendas_mes v join stg_custos c using (produto_id, ano, mes)
        left join stg_produtos p using (produto_id))""",
    "mart_margem_produto": f"""
      select *exclude(mes_total), {pct('receita_liquida', 'mes_total')} as pct_receita_mes
      from (select *, row_number() over (partition by ano, mes order by margem_bruta desc nulls last,
                produto_id, linha_producao_id) as ranking_margem_mes,
              sum(receita_liquida) over (partition by ano, mes) as mes_total
            from product_margins)""",
    "gasto_mes": f"""
      select ano, mes, natureza, classificacao_dre as tipo, centro_custo_tipo,
        {total('valor')} as realizado
      from stg_despesas group by all""",
    "mart_orcado_realizado": f"""
      select *, case when abs(variancia_pct) > 20 then 'DESVIO_CRITICO'
          when abs(variancia_pct) > 10 then 'DESVIO_ALERTA'
          when abs(variancia_pct) > 5 then 'DESVIO_MODERADO' else 'DENTRO_ORCAMENTO' end
          as status_desvio,
        case sign(variancia_absoluta) when 1 then 'ACIMA_ORCADO' when -1 then 'ABAIXO_ORCADO'
          else 'NO_ORCADO' end as direcao_desvio
      from (
        select ano, mes, natureza, coalesce(o.tipo, r.tipo) as tipo,
          coalesce(o.centro_custo_tipo, r.centro_custo_tipo) as centro_custo_tipo,
          coalesce(valor_orcado, 0) as valor_orcado, coalesce(realizado, 0) as valor_realizado,
          coalesce(realizado, 0) - coalesce(valor_orcado, 0) as variancia_absoluta,
          {pct('coalesce(realizado, 0) - valor_orcado', 'valor_orcado')} as variancia_pct,
          {pct('realizado', 'valor_orcado')} as atingimento_pct
        from stg_orcamento o full join gasto_mes r using (ano, mes, natureza))""",
}


# -- final statements ------------------------------------------------------

def _out(relation: str, doubles: str = "", bigints: str = "") -> str:
    """``select *`` with measures as DOUBLE and counts as BIGINT."""
    casts = [f"cast({c} as double) as {c}" for c in doubles.split()]
    casts += [f"cast({c} as bigint) as {c}" for c in bigints.split()]
    replace = f" replace ({', '.join(casts)})" if casts else ""
    return f"select *{replace} from {relation}"


_STATEMENT_MONEY = (
    "receita_bruta descontos devolucoes receita_liquida cmv cmv_materia_prima cmv_mao_obra cmv_cif "
    "lucro_bruto margem_bruta_pct despesa_vendas despesa_admin despesa_fabrica "
    "total_despesas_operacionais ebitda margem_ebitda_pct depreciacao ebit margem_ebit_pct "
    "resultado_financeiro lucro_antes_ir ir_csll lucro_liquido margem_liquida_pct ticket_medio")
_KPI_MONEY = (
    "receita_bruta receita_liquida cmv lucro_bruto ebitda ebit lucro_liquido margem_bruta_pct "
    "margem_ebitda_pct margem_ebit_pct margem_liquida_pct ticket_medio total_despesas_operacionais "
    "receita_liquida_mes_anterior receita_mom_pct lucro_bruto_mes_anterior lucro_bruto_mom_pct "
    "ebitda_mes_anterior ebitda_mom_pct receita_liquida_ano_anterior receita_yoy_pct "
    "lucro_bruto_ano_anterior lucro_bruto_yoy_pct receita_liquida_ytd lucro_bruto_ytd ebitda_ytd "
    "lucro_liquido_ytd")
_MARGIN_MONEY = (
    "receita_bruta receita_liquida custo_unitario_real cmv_produto margem_bruta margem_bruta_pct "
    "margem_contribuicao_unitaria custo_padrao_unitario variacao_custo_vs_padrao_pct")
_SALES_MONEY = ("preco_unitario valor_bruto desconto_percentual valor_desconto devolucao_valor "
                "valor_liquido")


def _margin_totals(*group: str) -> str:
    keys = ", ".join(group)
    return f"""(select *, {pct('margem_bruta', 'receita_liquida')} as margem_bruta_pct from (
        select {keys}, cast(sum(qtd_vendida) as bigint) as qtd_vendida,
          {total('receita_liquida')} as receita_liquida, {total('cmv_produto')} as cmv,
          {total('margem_bruta')} as margem_bruta
        from product_margins group by {keys}))"""


def _attainment(group: str) -> str:
    return f"""(select {group}, {total('valor_orcado')} as valor_orcado,
        {total('valor_realizado')} as valor_realizado
        from mart_orcado_realizado where tipo <> 'RECEITA' group by {group})"""


def _union(parts) -> str:
    return " union all ".join(parts)


def _check(check: str, table: str, column: str, failing: str) -> str:
    return (f"select '{check}' as check_name, '{table}' as table_name, "
            f"'{column}' as column_name, cast({failing} as bigint) as failing_rows")


def _dq_not_null() -> str:
    return _union(
        _check("not_null", t, c, f"count(*) - count({c})") + f" from {t}"
        for t, columns in quality.NOT_NULL.items() for c in columns)


def _dq_accepted() -> str:
    return _union(
        _check("accepted_values", t, c, f"count(*) filter ({c} not in ({_list(values)}))")
        + f" from {t}"
        for t, columns in quality.ACCEPTED_VALUES.items() for c, values in columns.items())


def _repeated(table: str) -> str:
    return table.replace("_vendas", "_vendas_linha")


def _dq_unique() -> str:
    return _union(
        _check("unique", t, k, "count(*)")
        + f" from (select {k} from {_repeated(t)} where {k} is not null group by {k} "
          "having count(*) > 1)"
        for t, k in quality.UNIQUE.items())


def _dq_relationships() -> str:
    def child(table: str) -> str:
        return f"{table}_composto" if table == "stg_vendas" else table

    return _union(
        _check("relationships", table, k, "count(*)")
        + f" from {child(table)} f where {k} is not null and not exists "
          f"(select 1 from {up} p where p.{k} = f.{k})"
        for table, k, up in quality.RELATIONSHIPS)


def _loaded(table: str) -> str:
    """When a row of the test binding was loaded."""
    def after(x: str) -> str:
        return f"cast(date_trunc('month', {x}) + interval 1 month as timestamp)"

    spec = SPECS[table]
    special = {
        "raw_vendas": f"case when venda_id is not null then {after('data_emissao')} end",
        "raw_orcamento": "cast(make_date(ano - 1, 12, 1) as timestamp)",
        "raw_historico_custos": "cast(data_vigencia_inicio as timestamp)", "raw_commodities": after("mes")}
    if table in special:
        return special[table]
    if spec.partition:
        return after(spec.partition)
    return f"cast(date '2025-01-01' + to_days(cast(length({spec.key}) as integer)) as timestamp)"


def _load_line(t) -> str:
    day = f"cast({{}}({t.partition}) as date)" if t.partition else "cast(null as date)"
    nulls = f"count(*) - count({t.key})" if t.key else "cast(0 as bigint)"
    return (f"select '{t.table}' as tabela, count(*) as registros, {nulls} as chaves_nulas, cast(0 as bigint) as sem_carga, "
            f"{day.format('min')} as primeira_data, {day.format('max')} as ultima_data, '{t.partition or ''}' as particao, "
            f"'{','.join(t.cluster)}' as clusters from {t.table}")


def _problems() -> str:
    return _union((
        "select despesa_id, mes_referencia as entregue, 'despesa_id' as coluna, cast(null as varchar) as valor, "
        "'MISSING_KEY' as motivo from entrega where despesa_id is null",
        "select despesa_id, mes_referencia, 'mes_referencia', mes_referencia, 'NOT_A_DATE' from entrega where dia is null",
        "select despesa_id, mes_referencia, 'valor', valor, 'NOT_A_NUMBER' from entrega "
        "where numero is null and trim(valor) <> ''"))


def _distinct_level(level: str, by: tuple[str, ...]) -> str:
    keys = ", ".join(c if c in by else f"cast(null as {t}) as {c}" for c, t in (
        ("ano", "bigint"), ("mes", "bigint"), ("linha_producao_id", "varchar")))
    counts = ", ".join(f"count(distinct {c}) as {name}" for c, name in sketches.COUNTED.items())
    return (f"select '{level}' as nivel, {keys}, {counts}, true as dentro_do_limite from stg_vendas "
            f"group by {', '.join(by)}")


def _duplicate_samples() -> str:
    keys = {t.table: t.key for t in TABLES}
    return _union(
        f"(select '{t}' as tabela, {keys[t]} as pk, count(*) as duplicatas from {_repeated(t)} "
        f"group by {keys[t]} having count(*) > 1 "
        f"order by duplicatas desc, pk nulls first limit 5)"
        for t in quality.DUPLICATE_TABLES)


def _waterfall() -> str:
    steps = _union(
        f"select ano, mes, {i + 1} as ordem, '{name}' as etapa, {sign} * coalesce({name}, 0) as valor "
        f"from mart_dre_mensal" for i, (name, sign) in enumerate(reports.WATERFALL))
    return f"""select ano, mes, cast(ordem as bigint) as ordem, etapa, cast(valor as double) as valor,
      cast(sum(valor) over (partition by ano, mes order by ordem) as double) as acumulado
      from ({steps})"""


def _lookup(kind: str) -> str:
    facts = "select venda_id, produto_id, data_emissao, quantidade from stg_vendas"
    joins = {
        "between": "left join dim_historico_custos h on f.produto_id = h.produto_id "
                   "and f.data_emissao between h.valid_from and h.valid_to",
        "asof": "asof left join dim_historico_custos h on f.produto_id = h.produto_id "
                "and f.data_emissao >= h.valid_from",
        "current": "left join dim_historico_custos h on f.produto_id = h.produto_id "
                   "and h.is_current",
    }
    return (f"select f.*, h.historico_id, cast(h.custo_padrao_novo as double) "
            f"as custo_padrao_vigente from ({facts}) f {joins[kind]}")


def _factor_case(year: str, factors: tuple[str, ...]) -> str:
    whens = " ".join(f"when {BASE_YEAR + n} then {d(f)}" for n, f in enumerate(factors))
    return f"cast(case {year} {whens} else {d('1.00')} end as decimal(10,4))"


def _line_commodity() -> str:
    whens = " ".join(f"when '{line}' then '{name}'" for line, name in reports.LINE_COMMODITY.items())
    return f"case linha_producao_id {whens} end"


def _cost_rollup() -> str:
    factor = f"cast(round(pow(1.004::double, {age('m')}), 12) as decimal(18,12))"
    share = planning.COST_SHARES
    mp = r2(f"padrao * {d(share['materia_prima'])} * cast(indice as decimal(10,4))")
    mod = r2(f"padrao * {d(share['mao_obra'])} * {_factor_case('year(m)', planning.LABOUR_BY_YEAR)}")
    cif = r2(f"cast(padrao * {d(share['indireto'])} as decimal(20,4)) * {factor}")
    return f"""select produto_id, m as mes_referencia, cast(mp as double) as custo_materia_prima,
        cast(mod as double) as custo_mao_obra_direta, cast(cif as double) as custo_indireto_fabricacao,
        cast(mp + mod + cif as double) as custo_total_unitario,
        cast(padrao as double) as custo_padrao_unitario,
        {quotient(cents('mp + mod + cif - padrao'), cents('padrao'), 4)} / 10000.0::double
          as variacao_custo_pct,
        cast(indice as double) as indice_commodity, linha_producao_id
      from (select *, {mp} as mp, {mod} as mod, {cif} as cif
        from (select produto_id, linha_producao_id, custo_padrao_unitario as padrao, m,
                coalesce(indice, 1) as indice
              from stg_produtos p
              cross join (select cast(unnest(generate_series(date_trunc('month', min(l_shipdate)),
                  date_trunc('month', max(l_shipdate)) + interval 12 month, interval 1 month))
                  as date) as m from lineitem) s
              left join stg_commodities c
                on c.mes_referencia = m and c.commodity = {_line_commodity()}
              where status = 'ATIVO'))"""


def _weights() -> str:
    rows = ", ".join(f"({m}, {int(w.replace('.', ''))})" for m, w in planning.SEASONAL_WEIGHTS.items())
    return f"(values {rows}) as w(mes, peso)"


def _budget_phasing() -> str:
    kind, nature, centre = planning.REVENUE_NATURE
    weight_sum = sum(int(w.replace(".", "")) for w in planning.SEASONAL_WEIGHTS.values())
    revenue = quotient(f"({cents('anual')} * peso)", str(weight_sum), 0)
    extra = f"case when natureza like '%{q.PAYROLL_STAND_IN}%' and w.mes >= 11 then 135 else 100 end"
    expense = quotient(f"({cents('anual')} * {extra})", "1200", 0)
    return f"""select ano, cast(w.mes as bigint) as mes, '{kind}' as tipo, '{nature}' as natureza,
        '{centre}' as centro_custo_tipo, {revenue} / 100.0::double as valor_orcado
      from (select ano, sum(valor_bruto) as anual from stg_vendas group by ano), {_weights()}
      union all
      select ano, cast(w.mes as bigint), 'DESPESA', natureza, cc, {expense} / 100.0::double
      from (select ano, natureza, min(centro_custo_tipo) as cc, sum(valor) as anual
            from stg_despesas group by ano, natureza), {_weights()}"""


def _revenue_linked() -> str:
    rates = ", ".join(f"('{n}', {r})" for n, r in q.LINKED_RATES.items())
    return f"""select m as mes_referencia, natureza, cast(receita as double) as receita,
        cast(round(receita * cast(taxa as decimal(18,4)), 2) as double) as valor
      from (select m, coalesce(r.receita, 0) as receita
            from (select cast(unnest(generate_series(date_trunc('year', min(l_shipdate)),
                date_trunc('year', max(l_shipdate)) + interval 11 month, interval 1 month))
                as date) as m from lineitem)
            left join (select {month('data_emissao')} as m, {total('valor_bruto')} as receita
                       from stg_vendas group by 1) r using (m)),
        (values {rates}) as t(natureza, taxa)"""


def _valuation() -> str:
    one = "(1 - cast(desconto_percentual as decimal(6,4)))"
    return f"""select venda_id, produto_id, cast(preco_unitario as double) as preco_unitario,
        quantidade, cast(b as double) as valor_bruto, cast(ds as double) as valor_desconto,
        cast(dv as double) as devolucao_valor, cast(b - ds - dv as double) as valor_liquido
      from (select *, {r2('b * cast(desconto_percentual as decimal(6,4))')} as ds,
              {r2(f'cast(preco_unitario * devolucao_quantidade as {M}) * {one}')} as dv
            from (select *, cast(preco_unitario * quantidade as {M}) as b from stg_vendas))"""


def _escalation() -> str:
    weight = "case mes " + " ".join(
        f"when {m} then {d(w)}" for m, w in planning.SEASONAL_WEIGHTS.items()) + " end"
    load = (f"cast(case when natureza like '{q.FIXED_STAND_IN}%' then 1 "
            f"else {d('0.85')} + {d('0.15')} * {weight} end as decimal(10,4))")
    raised = f"valor * {_factor_case('ano', planning.ESCALATION_BY_YEAR)}"
    adjusted = r2(f"cast({raised} as decimal(22,6)) * {load}")
    extra = (f"case when natureza like '%{q.PAYROLL_STAND_IN}%' and mes >= 11 "
             f"then {d('1.35')} else {d('1.00')} end")
    return f"""select despesa_id, ano, mes, natureza, cast(valor as double) as valor,
        cast({r2(f'{adjusted} * {extra}')} as double) as valor_reajustado from stg_despesas"""


def _price_escalation() -> str:
    raised = r2(f"preco_unitario * {_factor_case('ano', planning.ESCALATION_BY_YEAR)}")
    return f"""select venda_id, produto_id, ano, mes, cast(preco_unitario as double) as preco_unitario,
        cast({raised} as double) as preco_reajustado from stg_vendas"""


def _commodity_impact() -> str:
    def mean(x: str) -> str:
        return f"cast({quotient(cents(f'sum({x})'), 'count(*)', 0)} as decimal(30,0)) * {d('0.01')}"

    idx = "cast(round(indice * 10000, 0) as hugeint)"
    return f"""select linha_producao_id, ano, mes, commodity, cast(indice as double) as indice,
        cast(indice_mom_pct as double) as indice_mom_pct, produtos,
        cast(custo_mp_medio as double) as custo_mp_medio,
        cast({growth('custo_mp_medio', 'antes', False)} as double) as custo_mp_mom_pct,
        cast(custo_total_medio as double) as custo_total_medio
      from (select *, {_line_commodity()} as commodity,
              lag(custo_mp_medio) over (partition by linha_producao_id order by ano, mes) as antes
            from (select linha_producao_id, ano, mes, count(*) as produtos,
                    {mean('custo_materia_prima')} as custo_mp_medio,
                    {mean('custo_total_unitario')} as custo_total_medio
                  from stg_custos group by linha_producao_id, ano, mes))
      left join (select ano, mes, commodity, indice, {whole_pct('(x - x0)', 'x0')} as indice_mom_pct
            from (select *, {idx} as x,
                    lag({idx}) over (partition by commodity order by ano, mes) as x0
                  from stg_commodities)) using (ano, mes, commodity)"""


def _commodity_margin_effect() -> str:
    neutral = quotient(cents("custo_materia_prima"), "cast(round(indice_commodity * 10000, 0) as hugeint)", 4)
    return f"""select ano, mes, produto_id, linha_producao_id, {_line_commodity()} as commodity,
        cast(indice_commodity as double) as indice_commodity, qtd_vendida, cast(receita_liquida as double) as receita_liquida,
        cast(margem as double) as margem_bruta, cast(efeito as double) as efeito_commodity,
        cast(margem + efeito as double) as margem_sem_commodity,
        cast({pct('margem', 'receita_liquida')} as double) as margem_bruta_pct,
        cast({pct('margem + efeito', 'receita_liquida')} as double) as margem_sem_commodity_pct
      from (select v.*, c.indice_commodity, receita_liquida - qtd_vendida * custo_total_unitario as margem,
              cast(qtd_vendida * ({cents('custo_materia_prima')} - {neutral}) as decimal(30,0)) * {d('0.01')} as efeito
            from vendas_mes v join stg_custos c using (produto_id, ano, mes))"""


def _kpis_by_calendar() -> str:
    measures = ("receita_liquida", "lucro_bruto", "ebitda", "lucro_liquido")
    return f"""select a.ano, a.mes, {', '.join(f'cast(a.{m} as double) as {m}' for m in measures)},
        {', '.join(f'cast(b.{m} as double) as {m}_ano_anterior' for m in measures)},
        {', '.join(f"cast({growth(f'a.{m}', f'b.{m}', m != 'receita_liquida')} as double) as {m}_yoy_calendario_pct"
                   for m in measures)}
      from mart_dre_mensal a left join mart_dre_mensal b on b.ano = a.ano - 1 and b.mes = a.mes"""


def _seasonality() -> str:
    return f"""select mes, n as meses, {quotient('r', 'n', 0)} / 100.0::double as receita_media,
        {quotient('(r * sum(n) over ())', '(sum(r) over () * n)', 4)} / 10000.0::double
          as indice_sazonal
      from (select mes, {cents('sum(receita_liquida)')} as r, count(*) as n
            from mart_dre_mensal group by mes)"""


def _profile_mean(x: str, name: str) -> str:
    return f"{quotient(cents(f'sum({money(x)})'), f'count({x})', 0)} / 100.0::double as {name}"


_SCD2_BUILT = f"""
      select historico_id, produto_id, cast(antes as double) as custo_padrao_anterior,
        cast(novo as double) as custo_padrao_novo, valid_from,
        coalesce(cast(proximo - interval 1 day as date), date '9999-12-31') as valid_to,
        proximo is null as is_current, motivo_alteracao,
        case when antes > 0 then {quotient(f"({cents('novo')} - {cents('antes')})", cents('antes'), 4)}
          / 10000.0::double end as variacao_pct
      from (select historico_id, produto_id, valid_from, motivo_alteracao, custo_padrao_novo as novo,
              lag(custo_padrao_novo) over w as antes, lead(valid_from) over w as proximo
            from dim_historico_custos
            window w as (partition by produto_id order by valid_from, historico_id))"""

_FINAL: dict[str, str] = {
    "stg_vendas": _out("stg_vendas", _SALES_MONEY),
    "stg_custos": _out("stg_custos", "custo_materia_prima custo_mao_obra_direta "
                       "custo_indireto_fabricacao custo_total_unitario custo_padrao_unitario "
                       "variacao_custo_pct indice_commodity"),
    "stg_despesas": _out("stg_despesas", "valor"),
    "stg_orcamento": _out("stg_orcamento", "valor_orcado"),
    "stg_produtos": _out("stg_produtos", "custo_padrao_unitario preco_venda_unitario peso_kg "
                         "margem_padrao_pct"),
    "stg_clientes": _out("stg_clientes", "peso_volume"),
    "stg_commodities": _out("stg_commodities", "indice"),
    "dim_historico_custos": _out("dim_historico_custos",
                                 "custo_padrao_anterior custo_padrao_novo variacao_pct"),
    "int_receita_liquida": _out("int_receita_liquida", "receita_bruta total_descontos "
                                "total_devolucoes receita_liquida"),
    "int_cmv_mensal": _out("int_cmv_mensal", "cmv_total cmv_materia_prima cmv_mao_obra cmv_cif"),
    "int_despesas_dre": _out("int_despesas_dre", "despesa_fabrica despesa_vendas despesa_admin "
                             "depreciacao resultado_financeiro total_despesas_operacionais "
                             "total_despesas"),
    "mart_dre_mensal": _out("mart_dre_mensal", _STATEMENT_MONEY),
    "mart_kpis_executivo": _out("mart_kpis_executivo", _KPI_MONEY),
    "mart_margem_produto": _out("mart_margem_produto", _MARGIN_MONEY + " pct_receita_mes"),
    "mart_orcado_realizado": _out("mart_orcado_realizado", "valor_orcado valor_realizado "
                                  "variancia_absoluta variancia_pct atingimento_pct"),
    "expenses_pivot": "select ano, mes, " + ", ".join(
        f"cast({_class_sum(c)} as double) as {c}" for c in EXPENSE_CLASSES)
        + f""", cast({total(f"valor) filter (where coalesce(classificacao_dre not in ({_list(EXPENSE_CLASSES)}), true)")}
          as double) as OUTRAS from stg_despesas group by ano, mes""",
    "bronze_date_coercion": """
      select o_orderkey as pedido_id, cast(o_orderdate as date) as data_pedido,
        case when o_orderkey % 211 = 0 then 'n/d' else strftime(o_orderdate, '%Y-%m-%d') end
          as data_prevista,
        case when o_orderkey % 5 <> 0 then cast(o_orderdate as date) end as vigencia_inicio,
        strftime(o_orderdate, '%Y-%m-%d') as observacao,
        cast(o_orderdate as date) as data_local, cast(o_orderdate as date) as data_mes_primeiro,
        cast(o_orderdate as date) as data_compacta,
        case when o_orderkey % 2 = 0 then strftime(o_orderdate, '%Y-%m-%d')
          else strftime(o_orderdate, '%d/%m/%Y') end as data_mista
      from orders""",
    "bronze_month_partitions": _union(
        f"select '{t.table}' as tabela, {month(t.partition)} as mes_particao, count(*) as registros "
        f"from {t.table} group by 1, 2" for t in TABLES if t.partition),
    "bronze_load_report": _union(map(_load_line, TABLES)),
    "upserted_income_statement": _out("mart_dre_mensal", _STATEMENT_MONEY),
    "quarantine_accepted": """
      select despesa_id, dia as mes_referencia, centro_custo_tipo, natureza, classificacao_dre, numero as valor
      from entrega where despesa_id is not null and dia is not null and (numero is not null or trim(valor) = '')""",
    "quarantine_rejected": _problems(),
    "distinct_sketches": _union(_distinct_level(level, by) for level, by in (
        ("mes", ("ano", "mes", "linha_producao_id")), ("ano", ("ano",)), ("linha", ("linha_producao_id",)))),
    "bronze_row_counts": _union(
        f"select '{t.table}' as tabela, count(*) as registros from {t.table}" for t in TABLES),
    "bronze_null_keys": _union(
        f"select '{t}.{SPECS[t].key}' as campo, count(*) - count({SPECS[t].key}) as nulos from {t}"
        for t in quality.NULL_KEY_TABLES),
    "bronze_duplicate_keys": _duplicate_samples(),
    "bronze_profile_vendas": f"""
      select cast(min(data_emissao) as date) as data_min, cast(max(data_emissao) as date) as data_max,
        count(distinct produto_id) as produtos_distintos,
        count(distinct cliente_id) as clientes_distintos,
        cast(sum({money('valor_bruto')}) as double) as receita_bruta_total,
        {_profile_mean('valor_bruto', 'ticket_medio')}
      from raw_vendas""",
    "bronze_profile_custos": f"""
      select min(mes_referencia) as mes_min, max(mes_referencia) as mes_max,
        {_profile_mean('custo_total_unitario', 'custo_medio')},
        min(custo_total_unitario) as custo_min, max(custo_total_unitario) as custo_max
      from raw_custos""",
    "dq_not_null": _dq_not_null(),
    "dq_unique": _dq_unique(),
    "dq_accepted_values": _dq_accepted(),
    "dq_relationships": _dq_relationships(),
    "dq_min_rows": _union(
        f"select '{t.table}' as tabela, count(*) as registros, "
        f"cast({t.min_rows} as bigint) as min_esperado, "
        f"case when count(*) >= {t.min_rows} then 'OK' else 'ALERTA' end as status from {t.table}"
        for t in TABLES),
    "dq_ingested_at": _union(
        f"select '{t.table}' as tabela, count(*) as registros, count(*) - count(carga) as nulos, "
        f"count(distinct carga) as cargas from (select {_loaded(t.table)} as carga from {t.table})" for t in TABLES),
    "bronze_load_ranges": _union(
        f"select '{t}' as tabela, min(carga) as primeira_carga, max(carga) as ultima_carga "
        f"from (select {_loaded(t)} as carga from {t})"
        for t in quality.LOAD_RANGE_TABLES),
    "dq_net_reconciliation": """
      select ano, mes, count(*) as registros,
        count(*) filter (abs(gap) > 0.01) as divergentes,
        cast(coalesce(sum(gap) filter (abs(gap) > 0.01), 0) as double) as diferenca
      from (select *, valor_bruto - valor_desconto - devolucao_valor - valor_liquido as gap
            from stg_vendas_imposto)
      group by ano, mes""",
    "dedup_vendas": _out("""(select *exclude(posicao) from (
        select *, row_number() over (partition by venda_id order by data_emissao, produto_id,
          nota_fiscal, cliente_id, linha_producao_id, ano, mes, cliente_nome, tipo_cliente, quantidade,
          preco_unitario, valor_bruto, desconto_percentual, valor_desconto, devolucao_quantidade,
          devolucao_valor, valor_liquido) as posicao
        from stg_vendas_linha) where posicao = 1)""", _SALES_MONEY),
    "scd2_lookup_between": _lookup("between"),
    "scd2_lookup_asof": _lookup("asof"),
    "scd2_current": _lookup("current"),
    "scd2_build": _SCD2_BUILT,
    "scd2_merged": _SCD2_BUILT,
    "product_status_counts":
        "select status, count(*) as produtos from stg_produtos group by status",
    "revenue_grand_totals": """
      select cast(sum(valor_bruto) as double) as receita_bruta,
        cast(sum(valor_liquido) as double) as receita_liquida,
        cast(sum(valor_desconto) as double) as descontos,
        cast(sum(devolucao_valor) as double) as devolucoes
      from stg_vendas""",
    "dre_waterfall": _waterfall(),
    "dre_trend": _out("""(select ano, mes, data_referencia, receita_liquida, lucro_bruto, ebitda,
        lucro_liquido, margem_bruta_pct, margem_ebitda_pct, margem_liquida_pct
        from mart_dre_mensal)""", "receita_liquida lucro_bruto ebitda lucro_liquido "
                      "margem_bruta_pct margem_ebitda_pct margem_liquida_pct"),
    "top10_products": _out(
        f"(select * from {_margin_totals('produto_id', 'produto_nome')} "
        "order by margem_bruta desc, produto_id limit 10)",
        "receita_liquida cmv margem_bruta margem_bruta_pct"),
    "margin_by_line": _out(_margin_totals("linha_producao_id"),
                           "receita_liquida cmv margem_bruta margem_bruta_pct"),
    "margin_heatmap": "select ano, mes, linha_producao_id, "
        "cast(margem_bruta_pct as double) as margem_bruta_pct "
        f"from {_margin_totals('ano', 'mes', 'linha_producao_id')}",
    "margin_vs_history": _out(
        f"""(select f.ano, f.mes, f.produto_id, f.linha_producao_id, f.custo_unitario_real,
          h.historico_id, h.custo_padrao_novo as custo_padrao_vigente,
          {pct('f.custo_unitario_real - h.custo_padrao_novo', 'h.custo_padrao_novo')}
            as variacao_custo_vs_historico_pct
        from (select *, make_date(ano, mes, 1) as dia from product_margins) f
        asof left join dim_historico_custos h
          on f.produto_id = h.produto_id and f.dia >= h.valid_from)""",
        "custo_unitario_real custo_padrao_vigente variacao_custo_vs_historico_pct"),
    "margin_vs_volume": _out(_margin_totals("produto_id", "linha_producao_id"),
                             "receita_liquida cmv margem_bruta margem_bruta_pct"),
    "product_margin_counts": f"""
      select case when margem_bruta < 0 then 'MARGEM_NEGATIVA'
          when margem_bruta_pct < 15 then 'ABAIXO_THRESHOLD' else 'SAUDAVEL' end as status_margem,
        count(*) as qtd_produtos
      from {_margin_totals('produto_id')} group by 1""",
    "margin_alerts": _out("""(select ano, mes, produto_id, produto_nome, linha_producao_id,
        receita_liquida, margem_bruta, margem_bruta_pct, status_margem from product_margins
        where status_margem <> 'SAUDAVEL')""", "receita_liquida margem_bruta margem_bruta_pct"),
    "budget_traffic_light": """
      select status_desvio, count(*) as linhas, cast(sum(valor_orcado) as double) as valor_orcado,
        cast(sum(valor_realizado) as double) as valor_realizado
      from mart_orcado_realizado group by status_desvio""",
    "budget_attainment": _out(
        f"(select *, {pct('valor_realizado', 'valor_orcado')} as atingimento_pct "
        f"from {_attainment('ano')})", "valor_orcado valor_realizado atingimento_pct"),
    "budget_overruns": _out(
        f"(select *, valor_realizado - valor_orcado as variancia_absoluta, "
        f"{pct('valor_realizado - valor_orcado', 'valor_orcado')} as variancia_pct "
        f"from {_attainment('natureza')})",
        "valor_orcado valor_realizado variancia_absoluta variancia_pct"),
    "annual_summary": _out(
        f"""(select ano, receita_liquida, lucro_bruto, ebitda, lucro_liquido,
          {pct('lucro_bruto', 'receita_liquida')} as margem_bruta_pct,
          {pct('ebitda', 'receita_liquida')} as margem_ebitda_pct,
          {pct('lucro_liquido', 'receita_liquida')} as margem_liquida_pct,
          {growth('receita_liquida', 'antes', False)} as crescimento_receita_pct
        from (select *, lag(receita_liquida) over (order by ano) as antes
              from (select ano, {', '.join(f'sum({m}) as {m}' for m in _KPI)}
                    from mart_dre_mensal group by ano)))""",
        " ".join(_KPI) + " margem_bruta_pct margem_ebitda_pct margem_liquida_pct "
        "crescimento_receita_pct"),
    "worst_ebitda_months": _out(
        """(select ano, mes, receita_liquida, total_despesas_operacionais, ebitda, margem_ebitda_pct
        from mart_dre_mensal order by margem_ebitda_pct nulls last, ano, mes limit 10)""",
        "receita_liquida total_despesas_operacionais ebitda margem_ebitda_pct"),
    "seasonality_index": _seasonality(),
    "commodity_impact": _commodity_impact(),
    "commodity_margin_effect": _commodity_margin_effect(),
    "kpis_by_calendar": _kpis_by_calendar(),
    "cost_rollup": _cost_rollup(),
    "budget_phasing": _budget_phasing(),
    "revenue_linked_expense": _revenue_linked(),
    "sales_valuation": _valuation(),
    "escalation": _escalation(),
    "price_escalation": _price_escalation(),
}


def _with(statement: str) -> str:
    """Prefix the CTEs a statement uses, in definition order of their needs."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(CTES[name])
                if name not in needed:
                    needed.append(name)

    visit(statement)
    ctes = ",\n".join(f"{name} as ({CTES[name]})" for name in needed)
    return f"with {ctes}\n{statement}" if ctes else statement


def oracle_sql() -> dict[str, str]:
    return {name: _with(statement) for name, statement in _FINAL.items()}
