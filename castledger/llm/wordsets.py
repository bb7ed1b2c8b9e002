"""Sets of word shingles of documents, for task functions and as tables."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from castledger.llm.decontaminate import bit_filter, may_have
from castledger.llm.textwords import WordHashes, shingles, space_words

FILTER_BITS = 25


def shingle_set(text: str | None, hashes: WordHashes, size: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles; fewer words are one shingle."""
    words = space_words(text)
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(shingles(hashes.of(words), min(size, len(words))))


def set_id(members: np.ndarray) -> bytes:
    return hashlib.blake2b(members.tobytes(), digest_size=16).digest()


def full_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(set_id, members) of the wanted (set_id, doc_id). A bit filter of fixed size
    keeps other documents' sets from leaving Python; the join makes it exact."""
    bits = docs.sparkSession.sparkContext.broadcast(bit_filter(
        wanted.select(F.xxhash64("doc_id").alias("h")), "h", FILTER_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            passed = may_have(bits.value, batch.column(2).to_numpy().view(np.uint64))
            for i in np.flatnonzero(passed).tolist():
                members = shingle_set(batch.column(1)[i].as_py(), hashes, size)
                yield pa.record_batch([
                    pa.array([batch.column(0)[i].as_py()], pa.int64()),
                    pa.array([set_id(members)], pa.binary()),
                    pa.array([members.tobytes()], pa.binary())], names=["doc_id", "set_id", "members"])

    return (docs.withColumn("h", F.xxhash64("doc_id"))
            .mapInArrow(run, "doc_id long, set_id binary, members binary")
            .join(wanted, ["doc_id", "set_id"], "left_semi")
            .dropDuplicates(["set_id"]).select("set_id", "members"))
