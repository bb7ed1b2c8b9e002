"""Cleaned, typed views over the raw tables, one function per view.

Each function is a single narrow projection plus its row filter, so it fuses
with the scan. Where a filter works on a converted value, the plain comparison
it implies is filtered as well: that form reaches the Parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from castledger.functions.expr import (
    UNIT, int_round, money, month_of, numeric, rate, ratio, trim_all, upper_trim, year_of,
)
from castledger.sources.registry import INGESTED_AT


def _strings(*names: str):
    return [F.col(n).cast("string").alias(n) for n in names]


def _moneys(*names: str):
    return [money(n).alias(n) for n in names]


def _rates(*names: str):
    return [rate(n).alias(n) for n in names]


def _dated(source: str, name: str):
    """The date itself plus its year and month."""
    day = F.col(source).cast("date")
    return [day.alias(name), year_of(day).alias("ano"), month_of(day).alias("mes")]


def stg_vendas(raw: DataFrame) -> DataFrame:
    sold = raw.where(
        F.col("venda_id").isNotNull()
        & (F.col("quantidade") > 0) & (int_round("quantidade") > 0)
        & (F.col("valor_bruto") > 0) & (numeric("valor_bruto") > 0)
    )
    return sold.select(
        *_strings("venda_id", "nota_fiscal", "produto_id", "cliente_id", "linha_producao_id"),
        *_dated("data_emissao", "data_emissao"),
        upper_trim("cliente_nome").alias("cliente_nome"),
        upper_trim("tipo_cliente").alias("tipo_cliente"),
        int_round("quantidade").alias("quantidade"),
        *_moneys("preco_unitario", "valor_bruto"),
        *_rates("desconto_percentual"),
        *_moneys("valor_desconto"),
        F.coalesce(int_round("devolucao_quantidade"), F.lit(0).cast("bigint"))
        .alias("devolucao_quantidade"),
        F.coalesce(money("devolucao_valor"), money(F.lit(0))).alias("devolucao_valor"),
        *_moneys("valor_liquido"),
        INGESTED_AT,
    )


def stg_custos(raw: DataFrame) -> DataFrame:
    known = raw.where(
        F.col("produto_id").isNotNull() & F.col("mes_referencia").isNotNull()
        & (F.col("custo_total_unitario") > 0) & (numeric("custo_total_unitario") > 0)
    )
    return known.select(
        *_strings("produto_id", "linha_producao_id"),
        *_dated("mes_referencia", "mes_referencia"),
        *_moneys("custo_materia_prima", "custo_mao_obra_direta", "custo_indireto_fabricacao",
                 "custo_total_unitario", "custo_padrao_unitario"),
        *_rates("variacao_custo_pct", "indice_commodity"),
        INGESTED_AT,
    )


def stg_despesas(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("despesa_id").isNotNull() & F.col("valor").isNotNull()).select(
        *_strings("despesa_id"),
        *_dated("mes_referencia", "mes_referencia"),
        upper_trim("centro_custo_tipo").alias("centro_custo_tipo"),
        trim_all("natureza").alias("natureza"),
        upper_trim("classificacao_dre").alias("classificacao_dre"),
        *_moneys("valor"),
        INGESTED_AT,
    )


def stg_orcamento(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("orcamento_id").isNotNull()).select(
        *_strings("orcamento_id"),
        int_round("ano").alias("ano"),
        int_round("mes").alias("mes"),
        upper_trim("tipo").alias("tipo"),
        trim_all("natureza").alias("natureza"),
        upper_trim("centro_custo_tipo").alias("centro_custo_tipo"),
        *_moneys("valor_orcado"),
        INGESTED_AT,
    )


def stg_produtos(raw: DataFrame) -> DataFrame:
    price, cost = numeric("preco_venda_unitario"), numeric("custo_padrao_unitario")
    return raw.where(F.col("produto_id").isNotNull()).select(
        *_strings("produto_id"),
        upper_trim("produto_nome").alias("produto_nome"),
        *_strings("linha_producao_id"),
        upper_trim("linha_producao_nome").alias("linha_producao_nome"),
        upper_trim("unidade_medida").alias("unidade_medida"),
        upper_trim("status").alias("status"),
        *_strings("ncm"),
        *_moneys("custo_padrao_unitario", "preco_venda_unitario", "peso_kg"),
        ratio(price - cost, F.nullif(price, numeric(F.lit(0))), 4, UNIT).alias("margem_padrao_pct"),
        F.col("data_cadastro").cast("date").alias("data_cadastro"),
        INGESTED_AT,
    )


def stg_clientes(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("cliente_id").isNotNull()).select(
        *_strings("cliente_id"),
        upper_trim("cliente_nome").alias("cliente_nome"),
        upper_trim("tipo").alias("tipo_cliente"),
        *_rates("peso_volume"),
        INGESTED_AT,
    )


def stg_commodities(raw: DataFrame) -> DataFrame:
    # One select: the output column "mes" (number) replaces the input one (date).
    return raw.where(F.col("mes").isNotNull()).select(
        *_dated("mes", "mes_referencia"),
        upper_trim("commodity").alias("commodity"),
        *_rates("indice"),
        INGESTED_AT,
    )


def dim_historico_custos(raw: DataFrame) -> DataFrame:
    before, after = numeric("custo_padrao_anterior"), numeric("custo_padrao_novo")
    return raw.where(F.col("historico_id").isNotNull()).select(
        *_strings("historico_id", "produto_id"),
        *_moneys("custo_padrao_anterior", "custo_padrao_novo"),
        F.col("data_vigencia_inicio").cast("date").alias("valid_from"),
        F.col("data_vigencia_fim").cast("date").alias("valid_to"),
        F.col("is_current").cast("boolean").alias("is_current"),
        upper_trim("motivo").alias("motivo_alteracao"),
        F.when(before > 0, ratio(after - before, before, 4, UNIT)).alias("variacao_pct"),
        INGESTED_AT,
    )
