"""Incremental bronze loading: new files only, each exactly once.

The file sink keeps a commit log next to the data, so a batch that is replayed
after a failure adds nothing; the source remembers consumed files in the
stream checkpoint. Both folders must be on storage all executors share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from castledger.functions.expr import month_start
from castledger.sources.bronze import PART_MONTH
from castledger.sources.registry import INGESTED_AT, TableSpec


def load_new_files(spark: SparkSession, spec: TableSpec, incoming: str, target: str,
                   checkpoint: str, files_per_batch: int = 1000) -> StreamingQuery:
    """Append every file in ``incoming`` not loaded before, then stop.

    Rows carry one load time per batch and go to the partition of their month,
    however late they arrive.
    """
    stream = (
        spark.readStream.schema(spec.schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(incoming)
        .withColumn(INGESTED_AT, F.current_timestamp())
    )
    if spec.partition:
        stream = stream.withColumn(PART_MONTH, month_start(spec.partition))
    writer = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if spec.partition:
        writer = writer.partitionBy(PART_MONTH)
    return writer.start(target)


def loaded(spark: SparkSession, target: str) -> DataFrame:
    """Committed rows only: the sink's log decides which files count."""
    return spark.read.parquet(target)
