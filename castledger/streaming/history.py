"""Keep a stored cost history current by change events.

The history is stored in parts by the hash of the product. New events are merged
with the versions of their products, these products' chains are closed anew, and
only the parts that hold them are written. A late event, dated before versions
that are stored already, splits the version it falls into.

As with ``upsert``, a batch is staged, published and logged under its name, so a
replayed batch changes nothing. Events never change once delivered; of several on
one day the one with the highest id counts, whichever arrives first.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from castledger.operators.scd2 import scd2_build
from castledger.streaming.upsert import exists, delete

PART = "_part"
_EVENT = ["historico_id", "produto_id", "valid_from", "custo_padrao_novo", "motivo_alteracao"]


@dataclass(frozen=True)
class HistoryStore:
    """A history in ``parts`` folders; their number is fixed when it is created."""

    root: str
    parts: int = 64

    def _part(self) -> Column:
        return F.pmod(F.xxhash64("produto_id"), F.lit(self.parts)).cast("int")

    @property
    def data(self) -> str:
        return f"{self.root}/data"

    def versions(self, spark: SparkSession) -> DataFrame | None:
        """The history, with its part; None before the first batch."""
        return spark.read.parquet(self.data) if exists(spark, self.data) else None

    def history(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.data).drop(PART)

    def apply(self, events: DataFrame, name: str) -> list[int]:
        """Merge a batch of events; the parts that were written."""
        spark = events.sparkSession
        log, stage = f"{self.root}/log/batch={name}", f"{self.root}/stage/{name}"
        if exists(spark, f"{log}/_SUCCESS"):
            return self._noted(spark, log)
        if not exists(spark, f"{stage}/parts/_SUCCESS"):
            self._stage(events.select(*_EVENT), stage)
        parts = self._noted(spark, f"{stage}/parts")
        if parts:
            (spark.read.parquet(f"{stage}/rows").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(PART).parquet(self.data))
        spark.read.parquet(f"{stage}/parts").write.mode("overwrite").parquet(log)
        delete(spark, stage)
        return parts

    @staticmethod
    def _noted(spark: SparkSession, folder: str) -> list[int]:
        return sorted(r[0] for r in spark.read.schema("part int").parquet(folder).collect())

    def _stage(self, events: DataFrame, stage: str) -> None:
        spark = events.sparkSession
        events.write.mode("overwrite").parquet(f"{stage}/events")
        events = spark.read.parquet(f"{stage}/events")
        parts = [r[0] for r in events.select(self._part().alias("p")).distinct().collect()]  # self.parts at most
        if parts:
            stored, untouched = self.versions(spark), None
            if stored is not None:
                products = events.select("produto_id").distinct().withColumnRenamed("produto_id", "_touched")
                same = F.col("produto_id").eqNullSafe(F.col("_touched"))
                held = stored.where(F.col(PART).isin(parts))
                untouched = held.join(products, same, "left_anti")
                events = events.unionByName(held.join(products, same, "left_semi").select(*_EVENT))
            rebuilt = scd2_build(events).withColumn(PART, self._part())
            rows = rebuilt if untouched is None else rebuilt.unionByName(untouched.select(*rebuilt.columns))
            rows.hint("rebalance", PART).write.mode("overwrite").partitionBy(PART).parquet(f"{stage}/rows")
        spark.createDataFrame([(p,) for p in parts], "part int").coalesce(1).write.mode("overwrite").parquet(
            f"{stage}/parts")
