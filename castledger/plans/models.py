"""The model graph: every model as a property, every edge as an argument."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame

from castledger.operators import intermediate, marts, staging
from castledger.operators.marts import FinanceParams
from castledger.sources.registry import INGESTED_AT, SPECS

STAGING = ("stg_vendas", "stg_custos", "stg_despesas", "stg_orcamento", "stg_produtos",
           "stg_clientes", "stg_commodities", "dim_historico_custos")
INTERMEDIATE = ("int_receita_liquida", "int_cmv_mensal", "int_despesas_dre")
MARTS = ("mart_dre_mensal", "mart_margem_produto", "mart_orcado_realizado", "mart_kpis_executivo")


class Models:
    """Lazy DataFrames over a source of raw tables.

    ``source(name)`` returns a raw table: bronze storage in production, the
    test-data binding in checks. ``stored`` replaces a model by its saved table,
    so that what is built on it does not compute it again.
    """

    def __init__(self, source: Callable[[str], DataFrame], params: FinanceParams = FinanceParams(),
                 stored: dict[str, DataFrame] | None = None):
        self.source = source
        self.params = params
        self._stored = dict(stored or {})
        self.findings: dict[str, dict[str, int]] = {}  # of the column checks made while a model was written

    def store(self, name: str, table: DataFrame) -> None:
        self._stored[name] = table

    def get(self, name: str) -> DataFrame:
        if name in self._stored:
            return self._stored[name]
        return self.source(name) if name in SPECS else getattr(self, name)

    def business(self, name: str) -> DataFrame:
        """A model without its audit column."""
        return self.get(name).drop(INGESTED_AT)

    # -- silver -----------------------------------------------------------

    @cached_property
    def stg_vendas(self) -> DataFrame:
        return staging.stg_vendas(self.get("raw_vendas"))

    @cached_property
    def stg_custos(self) -> DataFrame:
        return staging.stg_custos(self.get("raw_custos"))

    @cached_property
    def stg_despesas(self) -> DataFrame:
        return staging.stg_despesas(self.get("raw_despesas"))

    @cached_property
    def stg_orcamento(self) -> DataFrame:
        return staging.stg_orcamento(self.get("raw_orcamento"))

    @cached_property
    def stg_produtos(self) -> DataFrame:
        return staging.stg_produtos(self.get("raw_produtos"))

    @cached_property
    def stg_clientes(self) -> DataFrame:
        return staging.stg_clientes(self.get("raw_clientes"))

    @cached_property
    def stg_commodities(self) -> DataFrame:
        return staging.stg_commodities(self.get("raw_commodities"))

    @cached_property
    def dim_historico_custos(self) -> DataFrame:
        return staging.dim_historico_custos(self.get("raw_historico_custos"))

    @cached_property
    def int_receita_liquida(self) -> DataFrame:
        return intermediate.int_receita_liquida(self.get("stg_vendas"))

    @cached_property
    def int_cmv_mensal(self) -> DataFrame:
        return intermediate.int_cmv_mensal(self.get("stg_vendas"), self.get("stg_custos"))

    @cached_property
    def int_despesas_dre(self) -> DataFrame:
        return intermediate.int_despesas_dre(self.get("stg_despesas"))

    # -- gold -------------------------------------------------------------

    @cached_property
    def mart_dre_mensal(self) -> DataFrame:
        return marts.mart_dre_mensal(
            self.get("int_receita_liquida"), self.get("int_cmv_mensal"),
            self.get("int_despesas_dre"), self.params)

    @cached_property
    def product_margins(self) -> DataFrame:
        """Margins before ranking: enough for every report that needs no rank."""
        return marts.product_margins(
            self.get("stg_vendas"), self.get("stg_custos"), self.get("stg_produtos"), self.params)

    @cached_property
    def mart_margem_produto(self) -> DataFrame:
        return marts.mart_margem_produto(self.get("product_margins"))

    @cached_property
    def mart_orcado_realizado(self) -> DataFrame:
        return marts.mart_orcado_realizado(self.get("stg_orcamento"), self.get("stg_despesas"))

    @cached_property
    def mart_kpis_executivo(self) -> DataFrame:
        return marts.mart_kpis_executivo(self.get("mart_dre_mensal"))
