"""Data-quality checks as grouped Spark jobs.

All column checks of a table share one aggregate pass; duplicates and foreign
keys are folded by key before anything is compared, so a hot key costs one row
per map task. Every check reports ``check_name, table_name, column_name,
failing_rows``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from castledger.functions.expr import TOTAL, month_start, money, total
from castledger.sources.registry import INGESTED_AT, TABLES, TableSpec

Source = Callable[[str], DataFrame]

# The declared checks.
NOT_NULL: dict[str, tuple[str, ...]] = {
    "raw_vendas": ("venda_id",),
    "raw_custos": ("produto_id", "mes_referencia"),
    "raw_despesas": ("despesa_id",),
    "raw_orcamento": ("orcamento_id",),
    "raw_produtos": ("produto_id",),
    "raw_centros_custo": ("centro_custo_id",),
    "raw_clientes": ("cliente_id",),
    "raw_historico_custos": ("historico_id",),
    "stg_vendas": ("venda_id", "data_emissao", "produto_id", "cliente_id", "valor_bruto",
                   "valor_liquido"),
    "stg_custos": ("produto_id", "mes_referencia", "custo_total_unitario"),
    "stg_despesas": ("despesa_id", "classificacao_dre"),
    "stg_produtos": ("produto_id", "linha_producao_id"),
    "stg_clientes": ("cliente_id",),
    "stg_orcamento": ("orcamento_id",),
    "dim_historico_custos": ("historico_id", "produto_id", "valid_from", "is_current"),
    "int_receita_liquida": ("ano", "mes", "receita_bruta", "receita_liquida"),
    "int_cmv_mensal": ("ano", "mes", "cmv_total"),
    "int_despesas_dre": ("ano", "mes"),
    "mart_dre_mensal": ("ano", "mes", "receita_bruta", "receita_liquida"),
    "mart_margem_produto": ("produto_id", "ano", "mes"),
    "mart_orcado_realizado": ("ano", "mes"),
    "mart_kpis_executivo": ("ano", "mes", "receita_liquida"),
}
UNIQUE: dict[str, str] = {
    "raw_vendas": "venda_id",
    "raw_despesas": "despesa_id",
    "raw_orcamento": "orcamento_id",
    "raw_produtos": "produto_id",
    "raw_centros_custo": "centro_custo_id",
    "raw_clientes": "cliente_id",
    "raw_historico_custos": "historico_id",
    "stg_vendas": "venda_id",
    "stg_despesas": "despesa_id",
    "stg_produtos": "produto_id",
    "stg_clientes": "cliente_id",
    "stg_orcamento": "orcamento_id",
    "dim_historico_custos": "historico_id",
}
_CLASSES = ("DESPESA_FABRICA", "DESPESA_VENDAS", "DESPESA_ADMIN", "DEPRECIACAO",
            "RESULTADO_FINANCEIRO")
_CLIENT_TYPES = ("MONTADORA", "DISTRIBUIDOR")
ACCEPTED_VALUES: dict[str, dict[str, tuple[str, ...]]] = {
    "raw_despesas": {"classificacao_dre": _CLASSES},
    "stg_vendas": {"tipo_cliente": _CLIENT_TYPES},
    "stg_despesas": {"classificacao_dre": _CLASSES},
    "stg_produtos": {"status": ("ATIVO", "INATIVO"),
                     "linha_producao_id": ("LP01", "LP02", "LP03", "LP04")},
    "stg_clientes": {"tipo_cliente": _CLIENT_TYPES},
    "stg_commodities": {"commodity": ("ACO", "ALUMINIO", "POLIMERO", "MISTO")},
    "dim_historico_custos": {"motivo_alteracao": (
        "CUSTO_INICIAL", "REAJUSTE_COMMODITY", "REVISAO_TRIMESTRAL", "RENEGOCIACAO_FORNECEDOR",
        "ALTERACAO_PROCESSO")},
    "mart_margem_produto": {"status_margem": ("SAUDAVEL", "ABAIXO_THRESHOLD", "MARGEM_NEGATIVA")},
    "mart_orcado_realizado": {"status_desvio": (
        "DENTRO_ORCAMENTO", "DESVIO_MODERADO", "DESVIO_ALERTA", "DESVIO_CRITICO")},
}
RELATIONSHIPS: tuple[tuple[str, str, str], ...] = (
    ("stg_vendas", "produto_id", "stg_produtos"),
    ("stg_vendas", "cliente_id", "stg_clientes"),
    ("stg_custos", "produto_id", "stg_produtos"),
)
NULL_KEY_TABLES = ("raw_vendas", "raw_custos", "raw_despesas", "raw_produtos", "raw_clientes")
DUPLICATE_TABLES = ("raw_vendas", "raw_produtos")
LOAD_RANGE_TABLES = ("raw_vendas", "raw_custos", "raw_despesas")


class ValidationError(ValueError):
    """Raised after the report is complete when any check failed."""


def union_all(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _count(condition: Column) -> Column:
    return F.count_if(condition)


def _not_null_tests(table: str) -> dict[str, Column]:
    return {c: F.col(c).isNull() for c in NOT_NULL.get(table, ())}


def _accepted_tests(table: str) -> dict[str, Column]:
    return {c: F.col(c).isNotNull() & ~F.col(c).isin(*values) for c, values in ACCEPTED_VALUES.get(table, {}).items()}


def _column_tests(table: str) -> dict[tuple[str, str], Column]:
    """The declared column checks of a table by check and column."""
    return {**{("not_null", c): test for c, test in _not_null_tests(table).items()},
            **{("accepted_values", c): test for c, test in _accepted_tests(table).items()}}


def _counts(tests: dict[tuple[str, str], Column]) -> list[Column]:
    return [_count(test).alias(f"{check}.{column}") for (check, column), test in tests.items()]


def _checked(table: str, df: DataFrame, tests: dict[tuple[str, str], Column]) -> DataFrame:
    """One pass over ``df``; one output row per test."""
    rows = F.array(*[_finding(check, table, column, F.col(f"`{check}.{column}`")) for check, column in tests])
    return df.agg(*_counts(tests)).select(F.inline(rows))


def observed(df: DataFrame, table: str) -> tuple[DataFrame, Observation]:
    """The rows with their column checks attached: whatever job writes them counts
    the failures, and no other pass is needed."""
    found = Observation()
    return df.observe(found, F.count(F.lit(1)).alias("rows"), *_counts(_column_tests(table))), found


def column_checks(source: Source, findings: dict[str, dict[str, int]] | None = None) -> DataFrame:
    """NOT NULL and accepted-value checks of every model: those of a model in
    ``findings`` as they were counted when it was written, those of the others in
    one pass over each."""
    findings, parts, known = findings or {}, [], []
    for table in {**NOT_NULL, **ACCEPTED_VALUES}:
        tests = _column_tests(table)
        if table in findings:
            known += [(check, table, column, findings[table][f"{check}.{column}"]) for check, column in tests]
        else:
            parts.append(_checked(table, source(table), tests))
    if known:
        parts.append(SparkSession.active().createDataFrame(
            known, "check_name string, table_name string, column_name string, failing_rows bigint"))
    return union_all(parts)


def dq_not_null(source: Source) -> DataFrame:
    return union_all(
        _checked(table, source(table), {("not_null", c): t for c, t in _not_null_tests(table).items()})
        for table in NOT_NULL)


def dq_accepted_values(source: Source) -> DataFrame:
    return union_all(
        _checked(table, source(table), {("accepted_values", c): t for c, t in _accepted_tests(table).items()})
        for table in ACCEPTED_VALUES)


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return df.groupBy(key).agg(F.count("*").alias("duplicatas")).where("duplicatas > 1")


def dq_unique(source: Source) -> DataFrame:
    """Number of distinct non-null keys that repeat."""
    return union_all(
        duplicate_keys(source(table).where(F.col(key).isNotNull()), key).agg(
            F.count("*").alias("failing_rows"),
        ).select(F.lit("unique").alias("check_name"), F.lit(table).alias("table_name"),
                 F.lit(key).alias("column_name"), "failing_rows")
        for table, key in UNIQUE.items())


def dq_relationships(source: Source) -> DataFrame:
    """Rows whose non-null foreign key has no parent.

    Keys are counted first, so the anti join compares distinct keys only.
    """
    def orphans(child: str, key: str, parent: str) -> DataFrame:
        held = source(child).where(F.col(key).isNotNull()).groupBy(key).agg(
            F.count("*").alias("n"))
        return held.join(source(parent).select(key), key, "left_anti").agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("failing_rows"),
        ).select(F.lit("relationships").alias("check_name"), F.lit(child).alias("table_name"),
                 F.lit(key).alias("column_name"), "failing_rows")

    return union_all(orphans(*r) for r in RELATIONSHIPS)


def row_counts(source: Source, tables: Iterable[TableSpec] = TABLES) -> DataFrame:
    return union_all(
        source(t.table).agg(F.count("*").alias("registros")).select(
            F.lit(t.table).alias("tabela"), "registros")
        for t in tables)


def min_rows(source: Source, tables: Iterable[TableSpec] = TABLES) -> DataFrame:
    """Row counts against the expected minimum."""
    def graded(spec: TableSpec) -> DataFrame:
        return row_counts(source, [spec]).select(
            "tabela", "registros", F.lit(spec.min_rows).cast("bigint").alias("min_esperado"),
            F.when(F.col("registros") >= spec.min_rows, "OK").otherwise("ALERTA").alias("status"))

    return union_all(graded(t) for t in tables)


def ingested_at_nulls(source: Source, tables: Iterable[TableSpec] = TABLES) -> DataFrame:
    """Audit column: rows, rows without load time, distinct load times."""
    return union_all(
        source(t.table).agg(
            F.count("*").alias("registros"), _count(F.col(INGESTED_AT).isNull()).alias("nulos"),
            F.count_distinct(INGESTED_AT).alias("cargas"),
        ).select(F.lit(t.table).alias("tabela"), "registros", "nulos", "cargas")
        for t in tables)


def load_ranges(source: Source) -> DataFrame:
    return union_all(
        source(t).agg(F.min(INGESTED_AT).alias("primeira_carga"),
                      F.max(INGESTED_AT).alias("ultima_carga")).select(
            F.lit(t).alias("tabela"), "primeira_carga", "ultima_carga")
        for t in LOAD_RANGE_TABLES)


def null_keys(source: Source) -> DataFrame:
    keys = {t.table: t.key for t in TABLES}
    return union_all(
        source(t).agg(_count(F.col(keys[t]).isNull()).alias("nulos")).select(
            F.lit(f"{t}.{keys[t]}").alias("campo"), "nulos")
        for t in NULL_KEY_TABLES)


def duplicate_key_samples(source: Source, limit: int = 5) -> DataFrame:
    """The most repeated keys of each table, NULL counted as a key.

    The limit is part of the report: it shows examples, not all failures.
    """
    keys = {t.table: t.key for t in TABLES}
    return union_all(
        duplicate_keys(source(t), keys[t]).orderBy(
            F.desc("duplicatas"), F.col(keys[t]).asc_nulls_first()).limit(limit).select(
            F.lit(t).alias("tabela"), F.col(keys[t]).alias("pk"), "duplicatas")
        for t in DUPLICATE_TABLES)


def _mean(column: str) -> Column:
    return F.round(F.try_divide(F.sum(money(column)).cast(TOTAL), F.count(column)), 2).cast(TOTAL)


def profile_vendas(raw: DataFrame) -> DataFrame:
    return raw.agg(
        F.min("data_emissao").cast("date").alias("data_min"),
        F.max("data_emissao").cast("date").alias("data_max"),
        F.count_distinct("produto_id").alias("produtos_distintos"),
        F.count_distinct("cliente_id").alias("clientes_distintos"),
        total(money("valor_bruto")).alias("receita_bruta_total"),
        _mean("valor_bruto").alias("ticket_medio"))


def profile_custos(raw: DataFrame) -> DataFrame:
    return raw.agg(
        F.min("mes_referencia").cast("date").alias("mes_min"),
        F.max("mes_referencia").cast("date").alias("mes_max"),
        _mean("custo_total_unitario").alias("custo_medio"),
        F.min("custo_total_unitario").alias("custo_min"),
        F.max("custo_total_unitario").alias("custo_max"))


def month_partitions(source: Source, tables: Iterable[TableSpec] = TABLES) -> DataFrame:
    """Rows per month partition of the tables that are partitioned."""
    return union_all(
        source(t.table).groupBy(month_start(t.partition).alias("mes_particao")).agg(
            F.count("*").alias("registros")).select(
            F.lit(t.table).alias("tabela"), "mes_particao", "registros")
        for t in tables if t.partition)


def net_reconciliation(sales: DataFrame) -> DataFrame:
    """Sales whose stored net value differs from gross - discount - return."""
    gap = (F.col("valor_bruto") - F.col("valor_desconto") - F.col("devolucao_valor")
           - F.col("valor_liquido"))
    return sales.groupBy("ano", "mes").agg(
        F.count("*").alias("registros"),
        _count(F.abs(gap) > 0.01).alias("divergentes"),
        F.coalesce(F.sum(F.when(F.abs(gap) > 0.01, gap)), F.lit(0)).cast(TOTAL)
        .alias("diferenca"))


def deduplicate(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """First row per key in a total order; rows without key are all kept, since
    nothing says that they are the same.

    The minimum of a struct, unlike ``row_number``, is combined on the map side:
    a key with millions of copies reaches its reducer as one row per map task.
    """
    rest = [c for c in df.columns if c != key and c not in order]
    first = F.min(F.struct(*order, *rest)).alias("_first")
    keyed = df.where(F.col(key).isNotNull()).groupBy(key).agg(first)
    return keyed.select(key, "_first.*").select(*df.columns).union(df.where(F.col(key).isNull()))


def assert_valid(report: DataFrame) -> None:
    """Fail the run if any row reports failures. The report has one row per
    declared check, so it is collected as a whole."""
    failed = report.where("failing_rows > 0").collect()
    if failed:
        listing = "; ".join(
            f"{r.check_name} {r.table_name}.{r.column_name}: {r.failing_rows}" for r in failed)
        raise ValidationError(f"{len(failed)} check(s) failed: {listing}")


def validate_bronze(source: Source, tables: Iterable[TableSpec] = TABLES) -> DataFrame:
    """Readability, minimum rows and audit column of every table, in one report.

    A table that cannot be resolved, or whose files fail while they are read, is a
    finding, not a reason to skip it or to end the report. Each table is one small
    job; they run side by side.
    """
    def findings(spec: TableSpec) -> list[tuple[str, str, str, int]]:
        try:
            found = source(spec.table).agg(
                F.count("*").alias("n"), _count(F.col(INGESTED_AT).isNull()).alias("nulls")).first()
        except (PySparkException, Py4JJavaError):
            return [("readable", spec.table, "", 1)]
        return [("min_rows", spec.table, "", max(spec.min_rows - found["n"], 0)),
                ("not_null", spec.table, INGESTED_AT, found["nulls"])]

    tables = list(tables)
    with ThreadPoolExecutor(max(len(tables), 1)) as pool:
        rows = [row for found in pool.map(findings, tables) for row in found]
    return SparkSession.active().createDataFrame(
        rows, "check_name string, table_name string, column_name string, failing_rows bigint")


def _finding(check: str, table: str, column: str, failing: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check_name"), F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"), failing.cast("bigint").alias("failing_rows"))
