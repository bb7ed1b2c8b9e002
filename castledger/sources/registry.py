"""The nine raw tables: files, layout, keys, thresholds and explicit schemas."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

INGESTED_AT = "_ingested_at"

_TYPES = {
    "str": T.StringType(),
    "int": T.LongType(),
    "num": T.DoubleType(),
    "ts": T.TimestampType(),
    "date": T.DateType(),
    "bool": T.BooleanType(),
}


def _schema(columns: str) -> T.StructType:
    fields = (entry.split(":") for entry in columns.split())
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


@dataclass(frozen=True)
class TableSpec:
    """How one raw file becomes one bronze table."""

    table: str
    file: str
    description: str
    schema: T.StructType
    key: str | None
    min_rows: int
    partition: str | None = None
    cluster: tuple[str, ...] = ()


# Table and file names, columns, layout and row thresholds.
TABLES: tuple[TableSpec, ...] = (
    TableSpec(
        "raw_vendas", "vendas.parquet", "Sales lines as delivered",
        _schema("venda_id:str nota_fiscal:str data_emissao:ts cliente_id:str cliente_nome:str "
                "tipo_cliente:str produto_id:str quantidade:num preco_unitario:num valor_bruto:num "
                "desconto_percentual:num valor_desconto:num devolucao_quantidade:num "
                "devolucao_valor:num valor_liquido:num linha_producao_id:str"),
        key="venda_id", min_rows=9000,
        partition="data_emissao", cluster=("produto_id", "cliente_id"),
    ),
    TableSpec(
        "raw_custos", "custos_producao.parquet", "Unit production cost per product and month",
        _schema("produto_id:str mes_referencia:ts custo_materia_prima:num custo_mao_obra_direta:num "
                "custo_indireto_fabricacao:num custo_total_unitario:num custo_padrao_unitario:num "
                "variacao_custo_pct:num indice_commodity:num linha_producao_id:str"),
        key="produto_id", min_rows=1700,
        partition="mes_referencia", cluster=("produto_id",),
    ),
    TableSpec(
        "raw_despesas", "despesas_operacionais.parquet", "Operating expenses per month",
        _schema("despesa_id:str mes_referencia:ts centro_custo_tipo:str natureza:str "
                "classificacao_dre:str valor:num"),
        key="despesa_id", min_rows=800,
        partition="mes_referencia", cluster=("classificacao_dre",),
    ),
    TableSpec(
        "raw_orcamento", "orcamento_anual.parquet", "Annual budget by month and nature",
        _schema("orcamento_id:str ano:int mes:int tipo:str natureza:str centro_custo_tipo:str "
                "valor_orcado:num"),
        key="orcamento_id", min_rows=850,
    ),
    TableSpec(
        "raw_produtos", "cadastro_produtos.parquet", "Product master",
        _schema("produto_id:str produto_nome:str linha_producao_id:str linha_producao_nome:str "
                "unidade_medida:str custo_padrao_unitario:num preco_venda_unitario:num peso_kg:num "
                "status:str data_cadastro:date ncm:str"),
        key="produto_id", min_rows=45,
    ),
    TableSpec(
        "raw_centros_custo", "cadastro_centros_custo.parquet", "Cost centres",
        _schema("centro_custo_id:str centro_custo_nome:str tipo:str linha_producao_vinculada:str "
                "responsavel:str ativo:bool"),
        key="centro_custo_id", min_rows=10,
    ),
    TableSpec(
        "raw_clientes", "cadastro_clientes.parquet", "Customer master",
        _schema("cliente_id:str cliente_nome:str tipo:str peso_volume:num"),
        key="cliente_id", min_rows=20,
    ),
    TableSpec(
        "raw_historico_custos", "historico_custos_produtos.parquet", "Standard-cost revisions",
        _schema("historico_id:str produto_id:str custo_padrao_anterior:num custo_padrao_novo:num "
                "data_vigencia_inicio:ts data_vigencia_fim:ts motivo:str is_current:bool"),
        key="historico_id", min_rows=300,
    ),
    TableSpec(
        "raw_commodities", "indices_commodities.parquet", "Monthly commodity indices",
        _schema("mes:ts commodity:str indice:num"),
        key=None, min_rows=140,
    ),
)

SPECS: dict[str, TableSpec] = {spec.table: spec for spec in TABLES}
