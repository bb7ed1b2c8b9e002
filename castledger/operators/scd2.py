"""Slowly changing cost history: build it, and look costs up at a point in time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from castledger.functions.expr import UNIT, month_start, ratio

OPEN_END = dt.date(9999, 12, 31)


def scd2_build(events: DataFrame) -> DataFrame:
    """History from change events ``(historico_id, produto_id, valid_from,
    custo_padrao_novo, motivo_alteracao)``.

    Each version ends the day before the next one starts; the last stays open
    and is the current one. Of several events of a product on one day only the
    one with the highest id was ever in force, so it alone becomes a version.
    That leaves a product at most one version per calendar day, which bounds the
    window group. Events without product are one group of their own.
    """
    daily = events.groupBy("produto_id", "valid_from").agg(
        F.max(F.struct("historico_id", "custo_padrao_novo", "motivo_alteracao")).alias("v")
    ).select("produto_id", "valid_from", "v.*")
    product = Window.partitionBy("produto_id").orderBy("valid_from")
    linked = daily.select(
        "*", F.lag("custo_padrao_novo").over(product).alias("custo_padrao_anterior"),
        F.lead("valid_from").over(product).alias("_next_start"))
    before, after = F.col("custo_padrao_anterior"), F.col("custo_padrao_novo")
    return linked.select(
        "historico_id", "produto_id", "custo_padrao_anterior", "custo_padrao_novo", "valid_from",
        F.coalesce(F.date_sub("_next_start", 1), F.lit(OPEN_END)).alias("valid_to"),
        F.col("_next_start").isNull().alias("is_current"),
        "motivo_alteracao",
        F.when(before > 0, ratio(after - before, before, 4, UNIT)).alias("variacao_pct"),
    )


def _valid_at(facts: DataFrame, day: str, versions: DataFrame,
              until: dt.date | None) -> DataFrame:
    """Left join of facts to the versions ``[_from, _to]`` that cover their day.

    Versions are unrolled to the months they touch, so both sides meet on
    (product, month): a plain equi-join that spreads one product over all its
    months, lets skewed partitions be split, and compares a fact only with the
    few versions of its own month. Months outside the history's own range count
    as its first or last one, on both sides alike; the comparison of days keeps
    the answer exact. ``until`` moves the upper end, so that facts later than the
    newest version stay spread over their months.
    """
    starts = versions.agg(F.min("_from").alias("lo"), F.max("_from").alias("hi"))
    earliest = month_start(starts.select("lo").scalar())
    latest = month_start(F.greatest(starts.select("hi").scalar(), F.lit(until)))

    def within(month):
        return F.least(F.greatest(month, earliest), latest)

    # an interval that ends before it starts covers no day
    unrolled = versions.where("_from <= _to").withColumn("_month", F.explode(F.sequence(
        within(month_start("_from")), within(month_start("_to")), F.expr("interval 1 month")))).hint("merge")
    unrolled = unrolled.withColumnsRenamed({"produto_id": "_product", "historico_id": "_version"})
    match = (
        (F.col("produto_id") == F.col("_product"))
        & (F.col("_fact_month") == F.col("_month"))
        & F.col(day).between(F.col("_from"), F.col("_to"))
    )
    joined = facts.withColumn("_fact_month", within(month_start(day))).join(unrolled, match, "left")
    return joined.select(*facts.columns, F.col("_version").alias("historico_id"),
                         F.col("_cost").alias("custo_padrao_vigente"))


def lookup_between(facts: DataFrame, day: str, history: DataFrame,
                   until: dt.date | None = None) -> DataFrame:
    """Cost whose recorded validity covers the day; NULL inside a gap."""
    versions = history.select(
        "produto_id", "historico_id", F.col("custo_padrao_novo").alias("_cost"),
        F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to"))
    return _valid_at(facts, day, versions, until)


def lookup_asof(facts: DataFrame, day: str, history: DataFrame,
                until: dt.date | None = None) -> DataFrame:
    """Latest cost that had started by the day, whatever its recorded end.

    Of several versions starting on one day the highest id wins. After that
    fold a product has at most one version per calendar day, which bounds the
    window group regardless of data volume.
    """
    daily = history.where(F.col("valid_from").isNotNull()).groupBy("produto_id", "valid_from").agg(
        F.max(F.struct("historico_id", "custo_padrao_novo")).alias("v"))
    next_start = F.lead("valid_from").over(
        Window.partitionBy("produto_id").orderBy("valid_from"))
    versions = daily.select(
        "produto_id", "v.historico_id", F.col("v.custo_padrao_novo").alias("_cost"),
        F.col("valid_from").alias("_from"),
        F.coalesce(F.date_sub(next_start, 1), F.lit(OPEN_END)).alias("_to"))
    return _valid_at(facts, day, versions, until)


def lookup_current(facts: DataFrame, history: DataFrame) -> DataFrame:
    """Today's cost of the product, through the current flag."""
    current = history.where("is_current").select(
        "produto_id", "historico_id", F.col("custo_padrao_novo").alias("custo_padrao_vigente"))
    return facts.join(current, "produto_id", "left")
