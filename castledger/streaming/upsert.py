"""Upsert loading: each batch of files replaces the rows it delivers again.

A table is kept in one folder, partitioned by month. A batch is merged with the
months it touches, those of its rows and those in which its keys were held so
far, and these months are written anew; no other partition is read as a whole or
written. A batch goes through three written steps, so it counts exactly once
whatever happens in between:

1. *Stage*: the rows of the batch and what its months keep are written beside the
   table, each laid out for storage, then the list of touched months, which marks
   the stage as complete.
2. *Publish*: the staged months replace those of the table, partition by
   partition. This reads the stage only and may be repeated.
3. *Log*: the months are noted under the batch's name. A batch that is in the
   log changes nothing when it is replayed.

Within a batch the greatest row of a key wins (by date, then by all columns), so
a replayed stage is the same. Only rows whose key repeats are folded; a batch is read
more than once and must give the same rows each time, as one of a stream does. Rows without key are all kept: nothing says that
they are the same. Folders must be on storage that all executors share, and one
writer at a time may work on a table.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from castledger.functions.expr import month_start
from castledger.sources.bronze import PART_MONTH, arrange
from castledger.sources.registry import INGESTED_AT, TableSpec

_NO_MONTH = "__HIVE_DEFAULT_PARTITION__"


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def partition_folder(month: dt.date | None) -> str:
    return f"{PART_MONTH}={month.isoformat() if month else _NO_MONTH}"


def in_months(months: list[dt.date | None]) -> Column:
    """Condition on the partition column that prunes partitions; None is a month
    of its own, for rows without date."""
    known = [m for m in months if m is not None]
    chosen = F.col(PART_MONTH).isin(known) if known else F.lit(False)
    return chosen | F.col(PART_MONTH).isNull() if None in months else chosen


def overwrite_months(spark: SparkSession, rows: DataFrame, folder: str, months: list[dt.date | None]) -> None:
    """Replace these month partitions of a folder; months without rows go.
    ``rows`` must not read the folder, and are written by the tasks they come from. The
    months that have rows are noted by the job that writes them."""
    for month in set(months) - _write_months(rows, folder, "dynamic"):
        delete(spark, f"{folder}/{partition_folder(month)}")


def _write_months(rows: DataFrame, folder: str, overwrite: str) -> set[dt.date | None]:
    """Write rows by month and return the months they have."""
    seen = Observation()
    written = rows.observe(
        seen, F.collect_set(PART_MONTH).alias("months"), F.count_if(F.col(PART_MONTH).isNull()).alias("undated"))
    written.write.mode("overwrite").option("partitionOverwriteMode", overwrite).partitionBy(PART_MONTH).parquet(folder)
    return {*(seen.get["months"] or []), *([None] if seen.get["undated"] else [])}


@dataclass(frozen=True)
class MonthStore:
    """A raw table partitioned by month, kept current by upserts."""

    root: str
    spec: TableSpec
    key_columns: tuple[str, ...] = ()  # where the spec's key alone does not tell rows apart

    @property
    def key(self) -> list[str]:
        return list(self.key_columns or ([self.spec.key] if self.spec.key else []))

    def has_key(self) -> Column:
        return reduce(Column.__and__, [F.col(c).isNotNull() for c in self.key])

    @property
    def data(self) -> str:
        return f"{self.root}/{self.spec.table}/data"

    def _stage(self, batch: str) -> str:
        return f"{self.root}/{self.spec.table}/stage/{batch}"

    def _log(self, batch: str) -> str:
        return f"{self.root}/{self.spec.table}/log/batch={batch}"

    def schema(self) -> T.StructType:
        return T.StructType([*self.spec.schema.fields, T.StructField(INGESTED_AT, T.TimestampType()),
                             T.StructField(PART_MONTH, T.DateType())])

    def rows(self, spark: SparkSession) -> DataFrame:
        """The table with its month column; empty before the first batch."""
        if not exists(spark, self.data):
            return spark.createDataFrame([], self.schema())
        return spark.read.schema(self.schema()).parquet(self.data)

    def logged(self, spark: SparkSession) -> dict[str, list[dt.date | None]]:
        """Touched months of each batch that counts."""
        folder = f"{self.root}/{self.spec.table}/log"
        if not exists(spark, folder):
            return {}
        found: dict[str, list[dt.date | None]] = {}
        for row in spark.read.schema("month date, batch string").parquet(folder).collect():
            found.setdefault(row["batch"], []).append(row["month"])
        return found


def _newest(batch: DataFrame, store: MonthStore, repeated: str) -> DataFrame:
    """One row per key: the greatest. Hashes of the keys that repeat are written to
    ``repeated``; the rows of all other keys pass as they are, since a maximum of
    structs sorts whatever it is given."""
    spark, key_hash = batch.sparkSession, "_key_hash"
    hashed = batch.withColumn(key_hash, F.when(store.has_key(), F.xxhash64(*store.key)))
    hashed.where(F.col(key_hash).isNotNull()).groupBy(key_hash).count().where("count > 1").select(
        key_hash).write.mode("overwrite").parquet(repeated)
    several = spark.read.schema(f"{key_hash} long").parquet(repeated)
    if several.isEmpty():
        return batch
    dated = store.spec.partition
    rest = [c for c in (dated, *[c for c in batch.columns if c != dated]) if c not in store.key]
    folded = hashed.join(several, key_hash, "left_semi").groupBy(*store.key).agg(F.max(F.struct(*rest)).alias("_row"))
    return (folded.select(*store.key, "_row.*").select(*batch.columns)
            .unionByName(hashed.join(several, key_hash, "left_anti").drop(key_hash)))


def apply_batch(batch: DataFrame, name: str, store: MonthStore) -> list[dt.date | None]:
    """Merge one batch into the table and return the months it touched."""
    spark, spec = batch.sparkSession, store.spec
    if spec.partition is None or not store.key:
        raise ValueError(f"{spec.table} has no month or no key to merge by")
    if exists(spark, f"{store._log(name)}/_SUCCESS"):
        return store.logged(spark)[name]
    stage = store._stage(name)
    if not exists(spark, f"{stage}/months/_SUCCESS"):
        _stage(batch, stage, store)
    months = [r["month"] for r in spark.read.schema("month date").parquet(f"{stage}/months").collect()]
    staged = reduce(DataFrame.unionByName, (spark.read.schema(store.schema()).parquet(f"{stage}/{part}")
                                            for part in ("rows", "kept") if exists(spark, f"{stage}/{part}")))
    overwrite_months(spark, staged, store.data, months)
    spark.read.schema("month date").parquet(f"{stage}/months").write.mode("overwrite").parquet(store._log(name))
    delete(spark, stage)
    return months


def _stage(batch: DataFrame, stage: str, store: MonthStore) -> None:
    spark, spec = batch.sparkSession, store.spec
    delete(spark, stage)
    fresh = _newest(batch.drop(PART_MONTH), store, f"{stage}/repeated").withColumn(
        PART_MONTH, month_start(spec.partition)).select(*store.schema().names)
    months = list(_write_months(arrange(fresh, spec), f"{stage}/rows", "static"))
    if exists(spark, store.data):
        held = store.rows(spark)
        keys = spark.read.schema(store.schema()).parquet(f"{stage}/rows").where(store.has_key()).select(*store.key)
        left = held.join(keys, store.key, "left_semi").select(PART_MONTH).distinct()
        months = list({*months, *(r[0] for r in left.collect())})
        kept = held.where(in_months(months)).join(keys, store.key, "left_anti").select(*fresh.columns)
        _write_months(arrange(kept, spec), f"{stage}/kept", "static")
    spark.createDataFrame([(m,) for m in months], "month date").coalesce(1).write.mode("overwrite").parquet(
        f"{stage}/months")


def upsert_new_files(spark: SparkSession, store: MonthStore, incoming: str, checkpoint: str,
                     files_per_batch: int = 1000) -> StreamingQuery:
    """Merge every file in ``incoming`` not seen before, then stop. A batch is
    named after its stream and number, so a stream that starts anew with an empty
    checkpoint is not mistaken for a replay."""
    def merge(batch: DataFrame, number: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        apply_batch(batch, f"{stream}-{number}", store)

    return (
        spark.readStream.schema(store.spec.schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(incoming)
        .withColumn(INGESTED_AT, F.current_timestamp())
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
