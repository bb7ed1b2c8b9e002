"""Load raw Parquet files into partitioned, clustered bronze tables."""

from __future__ import annotations

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from castledger.sources.registry import INGESTED_AT, SPECS, TABLES, TableSpec

PART_MONTH = "_part_month"
# Name parts that mark a text column as a date.
DATE_NAME_PARTS = ("data", "date", "vigencia", "mes_referencia")
_SALT = 4096


@dataclass(frozen=True)
class Layers:
    """Schemas of the three layers."""

    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"

    def create(self, spark: SparkSession) -> None:
        for schema in (self.bronze, self.silver, self.gold):
            spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")


class LoadError(RuntimeError):
    """One or more tables could not be loaded."""


def read_raw(spark: SparkSession, folder: str, spec: TableSpec,
             declared: bool = False) -> DataFrame:
    """Scan one raw file. Bronze keeps the stored types; ``declared`` reads with
    the registered schema instead, for feeds known to match it."""
    reader = spark.read.schema(spec.schema) if declared else spark.read
    return reader.parquet(f"{folder.rstrip('/')}/{spec.file}")


def add_audit(df: DataFrame, loaded_at: dt.datetime) -> DataFrame:
    """One load time for the whole table, taken from the caller's clock."""
    return df.withColumn(INGESTED_AT, F.lit(loaded_at).cast("timestamp"))


#: Patterns of date texts, in the order in which they are preferred: a column that
#: reads as day first and as month first is taken as day first.
DATE_PATTERNS = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "dd/MM/yyyy", "dd/MM/yyyy HH:mm:ss",
                 "MM/dd/yyyy", "yyyy/MM/dd", "dd-MM-yyyy", "dd.MM.yyyy", "yyyyMMdd")


def date_votes(df: DataFrame, names: Iterable[str], patterns: Iterable[str] = DATE_PATTERNS) -> dict[str, dict[str, int]]:
    """How many texts of each column each pattern would lose: one aggregate for
    all columns and patterns."""
    names, patterns = list(names), list(patterns)
    lost = df.agg(*[
        F.count_if(F.col(n).isNotNull() & F.try_to_timestamp(F.col(n), F.lit(p)).isNull()).alias(f"{i}_{j}")
        for i, n in enumerate(names) for j, p in enumerate(patterns)]).first()
    return {n: {p: lost[f"{i}_{j}"] for j, p in enumerate(patterns)} for i, n in enumerate(names)}


def coerce_dates(df: DataFrame, patterns: Iterable[str] = DATE_PATTERNS) -> DataFrame:
    """Turn text columns that are named like dates into timestamps.

    A column is converted as a whole or left alone: the first pattern that loses
    none of its values is adopted for all of them. Columns that mix patterns, or
    hold anything else, stay text.
    """
    patterns = list(patterns)
    names = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)
             and any(part in f.name.lower() for part in DATE_NAME_PARTS)]
    if not names:
        return df
    adopted = {n: next((p for p in patterns if votes[p] == 0), None)
               for n, votes in date_votes(df, names, patterns).items()}
    return df.select(*[
        F.try_to_timestamp(F.col(c), F.lit(adopted[c])).alias(c) if adopted.get(c) else F.col(c)
        for c in df.columns])


def is_month_partitioned(df: DataFrame, spec: TableSpec) -> bool:
    temporal = (T.TimestampType, T.TimestampNTZType, T.DateType)
    return spec.partition in df.columns and isinstance(
        df.schema[spec.partition].dataType, temporal)


def arrange(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Lay rows out for storage: months together, cluster columns sorted.

    Range partitioning on (month, cluster columns, salt) cuts a hot month, or a
    hot product inside it, into several tasks, while each file covers a narrow
    key range and can be skipped by its row-group statistics.
    """
    cluster = [c for c in spec.cluster if c in df.columns]
    by_month = is_month_partitioned(df, spec)
    if by_month:
        df = df.withColumn(PART_MONTH, F.trunc(F.col(spec.partition).cast("date"), "month"))
    keys = ([PART_MONTH] if by_month else []) + cluster
    if not keys:
        return df
    salt = F.pmod(F.xxhash64(*[c for c in df.columns if c != INGESTED_AT]), F.lit(_SALT))
    return df.repartitionByRange(*keys, salt).sortWithinPartitions(*keys)


def write_table(spark: SparkSession, df: DataFrame, name: str, description: str,
                partition_by: str | None = None) -> None:
    """Replace a table: running the same load twice leaves the same rows. The new
    rows go to a folder of their own and the table is pointed at it when they are
    complete, so a load that fails leaves the old table as it was."""
    schema, table = name.split(".")
    folder = f"{spark.catalog.getDatabase(schema).locationUri}/{table}-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(folder)
    before = _location(spark, name)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path=folder, source="parquet", description=description)
    if partition_by:
        spark.catalog.recoverPartitions(name)
    if before:
        path = spark._jvm.org.apache.hadoop.fs.Path(before)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_bucketed(spark: SparkSession, df: DataFrame, name: str, description: str,
                   keys: Sequence[str], buckets: int) -> None:
    """Replace a table, stored in ``buckets`` files by the hash of ``keys`` and
    sorted by them. Tables that are bucketed alike are grouped by these keys (and
    more) and joined on them without an exchange.

    A table read often this way pays the exchange once, when it is written. The
    keys should be those of the join, whole: a product and month, not a product
    alone, so that one product is spread over its months. As with ``write_table``,
    a write that fails leaves the old table as it was.
    """
    schema, table = name.split(".")
    made = f"{table}_{uuid.uuid4().hex}"
    folder = f"{spark.catalog.getDatabase(schema).locationUri}/{made}"
    (df.repartition(buckets, *keys).write.option("path", folder).bucketBy(buckets, *keys).sortBy(*keys)
     .saveAsTable(f"{schema}.{made}"))
    before = _location(spark, name)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"ALTER TABLE {schema}.{made} RENAME TO {name}")
    spark.sql("COMMENT ON TABLE IDENTIFIER(:name) IS " + repr(description), {"name": name})
    if before:
        path = spark._jvm.org.apache.hadoop.fs.Path(before)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _location(spark: SparkSession, name: str) -> str | None:
    if not spark.catalog.tableExists(name):
        return None
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first().data_type


def measured(df: DataFrame, spec: TableSpec) -> tuple[DataFrame, Observation]:
    """Rows, missing keys and load times, and the range of the partition column,
    gathered by whatever job writes the rows. Place it right before the write:
    each output task counts once there, however often earlier tasks run again."""
    figures = Observation()
    temporal = spec.partition if is_month_partitioned(df, spec) else None

    def day(pick) -> Column:
        return (pick(F.col(temporal).cast("date")) if temporal else pick(F.lit(None).cast("date")))

    return df.observe(
        figures, F.count(F.lit(1)).alias("registros"),
        (F.count_if(F.col(spec.key).isNull()) if spec.key in df.columns else F.count_if(F.lit(False))).alias("chaves_nulas"),
        F.count_if(F.col(INGESTED_AT).isNull()).alias("sem_carga"),
        day(F.min).alias("primeira_data"), day(F.max).alias("ultima_data")), figures


def load_table(spark: SparkSession, folder: str, spec: TableSpec, layers: Layers,
               loaded_at: dt.datetime) -> Row:
    return load_rows(spark, read_raw(spark, folder, spec), spec, layers, loaded_at)


def load_rows(spark: SparkSession, raw: DataFrame, spec: TableSpec, layers: Layers,
              loaded_at: dt.datetime) -> Row:
    """Store one bronze table and return its line of the load report."""
    df = add_audit(coerce_dates(raw), loaded_at)
    partition = PART_MONTH if is_month_partitioned(df, spec) else None
    laid, figures = measured(arrange(df, spec), spec)
    name = f"{layers.bronze}.{spec.table}"
    write_table(spark, laid, name, spec.description, partition)
    return Row(tabela=spec.table, bytes=_bytes(spark, _location(spark, name)), **figures.get)


def _bytes(spark: SparkSession, folder: str) -> int:
    """Size of the stored files, from the file system's own listing."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


def ingest(spark: SparkSession, folder: str, layers: Layers = Layers(),
           loaded_at: dt.datetime | None = None,
           tables: Iterable[TableSpec] = TABLES) -> DataFrame:
    """Load every table from its file, and report."""
    return ingest_from(spark, lambda spec: read_raw(spark, folder, spec), layers, loaded_at, tables)


def ingest_from(spark: SparkSession, raw: Callable[[TableSpec], DataFrame], layers: Layers = Layers(),
                loaded_at: dt.datetime | None = None, tables: Iterable[TableSpec] = TABLES) -> DataFrame:
    """Load every table, one Spark job each and side by side, and report. A table
    that fails does not stop the others; all failures are raised together at the
    end."""
    stamp = loaded_at or dt.datetime.now(dt.timezone.utc)
    tables = list(tables)
    layers.create(spark)
    with ThreadPoolExecutor(max(len(tables), 1)) as pool:
        loads = {spec.table: pool.submit(lambda s: load_rows(spark, raw(s), s, layers, stamp), spec)
                 for spec in tables}
    failed = {table: error for table, load in loads.items() if (error := load.exception())}
    if failed:
        raise LoadError("; ".join(f"{table}: {error}" for table, error in failed.items()))
    return load_report(spark, [load.result() for load in loads.values()])


REPORT = ("tabela string, registros bigint, bytes bigint, chaves_nulas bigint, sem_carga bigint, "
          "primeira_data date, ultima_data date")


def load_report(spark: SparkSession, figures: Iterable[Row]) -> DataFrame:
    """One line per loaded table, as measured while it was written: nothing is
    read again."""
    return spark.createDataFrame([tuple(row[c.split()[0]] for c in REPORT.split(", ")) for row in figures], REPORT)


def bronze_source(spark: SparkSession, layers: Layers = Layers(),
                  first: dt.date | None = None, last: dt.date | None = None):
    """Raw tables by name from bronze storage. With ``first`` and ``last``, only
    the rows of those days are read from the tables partitioned by month, and
    only their partitions."""
    def source(table: str) -> DataFrame:
        df = spark.table(f"{layers.bronze}.{table}")
        if PART_MONTH in df.columns and (first or last):
            df = between_dates(df, SPECS[table].partition, first or dt.date.min, last or dt.date.max)
        return df.drop(PART_MONTH)

    return source


def between_dates(df: DataFrame, column: str, first: dt.date, last: dt.date) -> DataFrame:
    """Filter a bronze table by date so that month partitions are pruned too.

    Spark does not derive the partition filter from the date filter.
    """
    chosen = df.where(F.col(column).cast("date").between(F.lit(first), F.lit(last)))
    if PART_MONTH not in df.columns:
        return chosen
    return chosen.where(
        F.col(PART_MONTH).between(F.lit(first.replace(day=1)), F.lit(last.replace(day=1))))


def export(df: DataFrame, folder: str, name: str) -> None:
    """Write the table twice, as CSV with a header and as Parquet."""
    df.write.mode("overwrite").option("header", True).csv(f"{folder}/csv/{name}")
    df.write.mode("overwrite").parquet(f"{folder}/parquet/{name}")
