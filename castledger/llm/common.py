"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import time
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from castledger.session import shared_folder


class Tables:
    """Intermediate tables of one run, written once to the shared folder.

    A written table survives lost executors and cuts the lineage; ``drop``
    deletes one that nothing reads any more.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self.count = 0

    def keep(self, frame: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.folder}/{self.count}"
        frame.write.parquet(path)
        table = self.spark.read.schema(frame.schema).parquet(path)
        table.kept_at = path
        return table

    def release(self) -> None:
        """Let Spark delete the shuffle files of finished steps now: it does so
        when the driver's garbage is collected, which may be long after."""
        for _ in range(2):  # what the first round frees may hold more
            gc.collect()
            self.spark._jvm.System.gc()
            time.sleep(0.3)

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark._jvm
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(table.kept_at)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def document_blocks(batches: Iterable[pa.RecordBatch],
                    chars: int) -> Iterator[tuple[int, int | None, str]]:
    """(block, doc_id, text) of a task's rows, in blocks of about ``chars``
    characters, a longer text alone. A null text counts as empty.

    The block number depends only on the task's partition and the order of its
    rows, so that a repeated scan of the same input gives the same blocks.
    """
    size, number = 0, TaskContext.get().partitionId() << 32
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                text = text or ""
                if size and size + len(text) > chars:
                    size, number = 0, number + 1
                size += max(len(text), 1)
                yield number, doc, text


def documents_of(docs: DataFrame) -> DataFrame:
    """Only the two columns the operators read; others, whatever their names, go."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"),
                       docs["text"].cast("string").alias("text"))


def unused(docs: DataFrame, name: str) -> str:
    """A column name like ``name`` that the caller's table does not have."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
