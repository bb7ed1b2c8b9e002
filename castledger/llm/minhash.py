r"""MinHash near-deduplication with exactly confirmed links.

A document's set holds the hashes of its distinct word shingles. Equal sets form
a class, and one member of each class goes on. Many universal hash minima of the
set are cut into bands; classes that agree in a band share a bucket. Candidate
pairs pass a signature check (far below the threshold, so that it costs no
link), then their full sets are compared. Confirmed links are closed to
components by alternating large-star and small-star.

Only components are asked for, so a bucket need not be compared pair by pair. A
set is first compared with one that is first in most of its buckets. Sets that
still share a bucket with another component are then joined exactly, by prefixes
of their rarest shingles (``prefix_groups``), so that neither a large group of near
copies nor one of texts just below the threshold is compared pair by pair. Nothing
is capped, and no pair that could join two components is left out.

With 32 bands of 4, a pair at the threshold of 0.85 misses all bands with
probability 6e-11.

Null and empty texts have an empty set and link with nothing. Rows that repeat a
doc_id are one vertex: their classes are linked. Rows without doc_id get no
component and are kept. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from castledger.llm import prefix_groups
from castledger.llm.common import Tables, documents_of
from castledger.llm.textwords import WordHashes
from castledger.llm.wordsets import full_sets, set_id, shingle_set

BANDS, ROWS = 32, 4
#: Agreeing minima that a pair needs to be compared in full: 7 standard
#: deviations below the mean of a pair at 0.85.
LEAST_AGREEING = 80

SIGNED = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_id", pa.binary()),
                    ("minima", pa.binary())])


def multipliers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and addends of the universal hash functions."""
    drawn = np.random.default_rng(20).integers(0, 2**63, (2, count, 1), dtype=np.uint64)
    return drawn[0] * np.uint64(2) + np.uint64(1), drawn[1] * np.uint64(2)


def minima(members: np.ndarray, factors: np.ndarray, addends: np.ndarray) -> bytes:
    least = np.full(len(factors), ~np.uint64(0))
    for at in range(0, len(members), 1024):
        least = np.minimum(least, (members[at:at + 1024] * factors + addends).min(axis=1))
    return (least >> np.uint64(32)).astype(np.uint32).tobytes()


def sign(docs: DataFrame, size: int) -> DataFrame:
    factors, addends = multipliers(BANDS * ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            counts, ids, least = [], [], []
            for text in batch.column(1):
                members = shingle_set(text.as_py(), hashes, size)
                counts.append(len(members))
                ids.append(set_id(members) if len(members) else None)
                least.append(minima(members, factors, addends) if len(members) else None)
            yield pa.record_batch([batch.column(0), pa.array(counts, pa.int64()),
                                   pa.array(ids, pa.binary()), pa.array(least, pa.binary())],
                                  schema=SIGNED)

    return docs.mapInArrow(run, "doc_id long, n_shingles long, set_id binary, minima binary")


def _compared(with_both: DataFrame, first: str, second: str, agree) -> DataFrame:
    """Pairs (a, b) for which ``agree`` holds on two binary columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = pa.array([agree(x.as_py(), y.as_py()) for x, y in
                             zip(batch.column(2), batch.column(3))], pa.bool_())
            yield batch.select([0, 1]).filter(held)

    return with_both.select("a", "b", first, second).mapInArrow(run, "a binary, b binary")


def _with_values(pairs: DataFrame, values: DataFrame, name: str) -> DataFrame:
    def side(key: str) -> DataFrame:
        return values.select(F.col("set_id").alias(key), F.col(name).alias(f"{name}_{key}"))
    return pairs.join(side("a"), "a").join(side("b"), "b")


def links_among(pairs: DataFrame, classes: DataFrame, sets: DataFrame, percent: int, tables: Tables) -> DataFrame:
    """Of the candidate pairs (a, b), those whose full sets are similar enough."""
    def signatures_agree(x: bytes, y: bytes) -> bool:
        return int((np.frombuffer(x, np.uint32) == np.frombuffer(y, np.uint32)).sum()) >= LEAST_AGREEING

    def sets_agree(x: bytes, y: bytes) -> bool:
        x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        both = len(np.intersect1d(x, y, assume_unique=True))
        return 100 * both >= percent * (len(x) + len(y) - both)

    likely = tables.keep(_compared(_with_values(pairs, classes, "minima"),
                                   "minima_a", "minima_b", signatures_agree))
    links = tables.keep(_compared(_with_values(likely, sets, "members"),
                                  "members_a", "members_b", sets_agree))
    tables.drop(likely)
    return links


def near_duplicates(docs: DataFrame, size: int = 3, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document, for shingles of
    ``size`` words and a Jaccard similarity of at least ``percent`` / 100 (0.8 or
    more: bands and signature check are set for that)."""
    tables = Tables(docs.sparkSession, "minhash")
    docs = documents_of(docs)
    signed = tables.keep(sign(docs, size))
    known = signed.where("set_id is not null and doc_id is not null")
    classes = tables.keep(known.groupBy("set_id").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"),
        F.first("minima").alias("minima")))

    width = 4 * ROWS
    banded = classes.select("set_id", "n_shingles", F.explode(
        F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(
            b, F.substring(F.col("minima"), b * width + 1, F.lit(width))))).alias("bucket"))
    shared = (banded.groupBy("bucket").agg(F.min("set_id").alias("first"), F.max("set_id").alias("last"))
              .where("first < last"))
    buckets = tables.keep(banded.join(shared, "bucket"))
    tables.release()
    met = tables.keep(classes.join(buckets, "set_id", "left_semi").select("set_id", "doc_id"))
    sets = tables.keep(full_sets(docs, met, size))

    # rows that repeat a doc_id link their classes
    repeated = known.groupBy("doc_id").agg(F.min("set_id").alias("v"), F.max("set_id").alias("m")).where("v < m")
    same_id = known.join(repeated, "doc_id").select(F.col("set_id").alias("a"), F.col("v").alias("b")).distinct()
    labels = prefix_groups.relabelled(
        tables.keep(classes.select("set_id", F.col("set_id").alias("label"))), same_id, tables)

    # every set with the first one of the bucket partners it meets most often
    hubs = (buckets.where("set_id <> first").groupBy("set_id", "first").agg(F.count("*").alias("shared"))
            .groupBy("set_id").agg(F.max(F.struct("shared", "first")).alias("hub")))
    pairs = tables.keep(hubs.select(F.col("set_id").alias("a"), F.col("hub.first").alias("b")))
    labels = prefix_groups.relabelled(labels, links_among(pairs, classes, sets, percent, tables), tables)
    tables.release()

    # what still shares a bucket with another component
    members = tables.keep(buckets.join(labels, "set_id"))
    undone = members.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y")
    open_sets = tables.keep(members.join(undone, "bucket", "left_semi").select("set_id", "label").distinct())
    rest = tables.keep(prefix_groups.with_longs(sets.join(open_sets, "set_id", "left_semi")))
    joined = prefix_groups.connected(rest, percent, tables, open_sets).toDF("set_id", "joined")
    labels = prefix_groups.relabelled(labels, joined.join(open_sets, "set_id").where("label <> joined").select(
        F.col("set_id").alias("a"), F.col("joined").alias("b")), tables)

    names = classes.select("set_id", "doc_id").join(labels.withColumnRenamed("label", "component"), "set_id")
    least = names.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = tables.keep(names.join(least, "component").select("set_id", "component_id"))
    tables.drop(classes, buckets, met, sets, members, open_sets, pairs, rest)
    tables.release()
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return (signed.drop("minima").join(named, "set_id", "left")
            .select("doc_id", "n_shingles", component.alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP3_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + least(3, len(words)) - 1], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 1) + 1)) AS i
        FROM w WHERE len(words) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * shared >= 85 * (x.n + y.n - shared)
), r AS (
  SELECT doc_id, doc_id AS reached FROM n
  UNION
  SELECT r.doc_id, l.b FROM r JOIN l ON r.reached = l.a
), c AS (
  SELECT doc_id, min(reached) AS component_id FROM r GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id,
       doc_id = coalesce(component_id, doc_id) AS kept
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""
