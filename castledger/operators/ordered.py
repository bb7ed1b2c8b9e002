"""Ranking within groups that may not fit one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_ORDER, _CELL, _HASH = "_order", "_cell", "_hash"
#: Cells that a group is cut into, and rows sampled for each to find the cuts.
CELLS, SAMPLES = 64, 64
_BLOCK = 8


def _same(group: list[str]) -> Column:
    """Null-safe equality of ``group`` with its copies ``_g_*``."""
    same = F.lit(True)
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    return same


def _keys(group: list[str]) -> list[Column]:
    return [F.col(c).alias(f"_g_{c}") for c in group]


def _per(df: DataFrame, keys: list[str], *aggregates: Column) -> DataFrame:
    """Aggregate by ``keys`` (renamed). It reads every column, so that it shares
    the exchange below it with whatever else reads the rows."""
    return (df.groupBy(*_keys(keys)).agg(*aggregates, F.max(F.xxhash64(*df.columns)).alias(_HASH))
            .where(F.col(_HASH).isNotNull()).drop(_HASH))


def _place(splitters: str, row: str) -> Column:
    """How many of the sorted splitters are not after the row: by the first of each
    block of them, then within one block."""
    def upto(array: Column) -> Column:
        return F.size(F.filter(array, lambda s: s <= F.col(row)))

    cuts = F.col(splitters)
    heads = F.filter(cuts, lambda s, i: i % _BLOCK == 0)
    block = upto(heads)
    return F.when(block > 0, (block - 1) * _BLOCK + upto(F.slice(cuts, (block - 1) * _BLOCK + 1, F.lit(_BLOCK)))
                  ).otherwise(0)


def with_cells(df: DataFrame, group: list[str], value: str, ties: list[str], cells: int = CELLS,
               group_sums: dict[str, str] | None = None) -> DataFrame:
    """Rows with their order, their cell and sums of their whole group.

    The cells of a group follow each other in the order (largest ``value`` first,
    NULL last, then ``ties``). They are cut at quantiles of a sample over the whole
    order, so rows of equal value spread over cells too. The sample is drawn by
    hash: a stage that runs again cuts at the same places. Per group one array of
    ``cells`` splitters is broadcast, so groups must be few, like months.
    """
    sums = group_sums or {}
    order = F.struct(F.col(value).isNull().alias("n"), (-F.col(value)).alias("v"), *ties)
    drawn = F.xxhash64(value, *ties)
    rows = df.withColumn(_ORDER, order).repartition(*group, F.pmod(drawn, F.lit(cells)))
    sizes = _per(rows, group, F.count("*").alias("_rows"), *[F.sum(c).alias(name) for name, c in sums.items()])
    share = F.pmod(F.shiftright(drawn, 20), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sampled = rows.join(F.broadcast(sizes.select("_rows", *[f"_g_{c}" for c in group])), _same(group)).where(
        share * F.col("_rows") < cells * SAMPLES).drop(*[f"_g_{c}" for c in group], "_rows")
    sample = _per(sampled, group, F.sort_array(F.collect_set(_ORDER)).alias("_sample"))
    held = F.size("_sample")
    splitters = sample.select(*[F.col(f"_g_{c}").alias(c) for c in group], F.transform(
        F.sequence(F.lit(1), F.lit(max(cells - 1, 1))),
        lambda i: F.element_at(F.col("_sample"), F.floor(held * i / cells).cast("int") + 1)).alias("_splitters"))
    cut = splitters.join(sizes, _same(group), "right").drop(*group, "_rows")
    return rows.join(F.broadcast(cut), _same(group)).select(
        *df.columns, _ORDER, *sums, F.coalesce(_place("_splitters", _ORDER), F.lit(0)).alias(_CELL))


def rank_within(df: DataFrame, group: list[str], value: str, ties: list[str], rank: str,
                group_sums: dict[str, str] | None = None, cells: int = CELLS) -> DataFrame:
    """``row_number()`` per group, largest ``value`` first, NULL last, ``ties``
    ascending; plus whole-group sums ``{output: column}``.

    Rows are numbered within their cell and moved up by the rows of the cells
    before it. Rows are shuffled twice, whatever reads them: once spread evenly,
    once by cell.
    """
    sums = group_sums or {}
    placed = with_cells(df, group, value, ties, cells, sums).repartition(*group, _CELL)
    counts = _per(placed, [*group, _CELL], F.count("*").alias("_n"))
    before = Window.partitionBy(*[f"_g_{c}" for c in group]).orderBy(f"_g_{_CELL}").rowsBetween(
        Window.unboundedPreceding, -1)  # as many rows as a group has cells
    offsets = counts.select(*[f"_g_{c}" for c in (*group, _CELL)], F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*group, _CELL).orderBy(_ORDER)
    numbered = placed.withColumn("_position", F.row_number().over(inside))
    return numbered.join(offsets, _same([*group, _CELL])).select(
        *df.columns, (F.col("_position") + F.col("_before")).alias(rank), *sums)
