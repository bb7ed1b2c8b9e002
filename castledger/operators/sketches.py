"""Approximate distinct counts that merge upward.

Exact distinct counts per month can't be added up to a year: a client of two
months would count twice, so each level needs the sales again. A sketch can: the
sketches per month and line are built in one pass that combines map-side, are a
few kilobytes each, and every coarser level is merged from them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from castledger.functions.expr import total
from castledger.operators.intermediate import MONTH_LINE

#: Registers of a sketch, as a power of two. One takes up to 16 KB.
LOG_REGISTERS = 14
#: Relative error of a merged sketch: one standard error, and the bound that is stated.
STANDARD_ERROR = 1.04 / 2 ** (LOG_REGISTERS / 2)
ERROR_BOUND = 5 * STANDARD_ERROR

# What is counted, and under which name.
COUNTED = {"venda_id": "qtd_vendas", "produto_id": "qtd_produtos_vendidos", "cliente_id": "qtd_clientes"}


def sales_sketches(sales: DataFrame) -> DataFrame:
    """Per month and line: sums, and a sketch of sales, products and clients."""
    return sales.groupBy(*MONTH_LINE).agg(
        total("valor_bruto").alias("receita_bruta"), F.sum("quantidade").alias("qtd_pecas_vendidas"),
        *[F.hll_sketch_agg(column, F.lit(LOG_REGISTERS)).alias(f"{name}_sketch") for column, name in COUNTED.items()])


def rolled_up(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """The same columns per ``by``, from sketches of any finer level."""
    return sketches.groupBy(*by).agg(
        F.sum("receita_bruta").cast("decimal(20,2)").alias("receita_bruta"),
        F.sum("qtd_pecas_vendidas").alias("qtd_pecas_vendidas"),
        *[F.hll_union_agg(f"{name}_sketch").alias(f"{name}_sketch") for name in COUNTED.values()])


def estimates(sketches: DataFrame) -> DataFrame:
    """Sketches replaced by the counts they estimate."""
    return sketches.select(*[
        F.hll_sketch_estimate(c).alias(c.removesuffix("_sketch")) if c.endswith("_sketch") else F.col(c)
        for c in sketches.columns])


def exact_counts(sales: DataFrame, by: Sequence[str]) -> DataFrame:
    """Exact distinct counts per ``by``. Each column gets a narrow distinct list of
    its own: several distinct counts in one aggregation would expand every sale."""
    def counted(column: str, name: str) -> DataFrame:
        return sales.select(*by, column).distinct().groupBy(*by).agg(F.count(column).alias(name))

    (column, name), *others = COUNTED.items()
    found = counted(column, name)
    for column, name in others:
        more = counted(column, name).withColumnsRenamed({c: f"_{c}" for c in by})
        same = F.lit(True)
        for c in by:
            same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
        # a level without keys has one row on either side
        found = found.join(more, same).drop(*[f"_{c}" for c in by])
    return found


def compared(sales: DataFrame, by: Sequence[str], sketches: DataFrame | None = None) -> DataFrame:
    """Exact counts beside estimates per ``by``, and whether all are within
    ``ERROR_BOUND`` of the exact ones."""
    guessed = estimates(rolled_up(sketches if sketches is not None else sales_sketches(sales), by))
    guessed = guessed.withColumnsRenamed({c: f"_{c}" for c in by} | {n: f"{n}_aprox" for n in COUNTED.values()})
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    near = F.lit(True)
    for name in COUNTED.values():
        near = near & (F.abs(F.col(f"{name}_aprox") - F.col(name)) <= ERROR_BOUND * F.col(name))
    return exact_counts(sales, by).join(guessed, same).select(
        *by, *COUNTED.values(), *[f"{n}_aprox" for n in COUNTED.values()], near.alias("dentro_do_limite"))
