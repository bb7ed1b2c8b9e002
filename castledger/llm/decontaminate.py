r"""Benchmark decontamination by a prefix-filtered set join.

Every window of an item (``window`` consecutive words; a shorter item is one
window) is a set of word shingles. Shingles are ordered by rarity, counted over
the whole corpus. Containment is exact here, so the necessary prefix of a window
is its rarest shingle alone: only that one is joined with the documents'
shingles. Its place within the window fixes where the window would have to
stand; candidates that would leave the document are dropped (length and position
bounds) and the rest is compared word by word.

Hits keep the words, so hash collisions can't make false ones. A fixed-size bit
filter thins the documents' shingles before they are shuffled; it grows neither
with the corpus nor with the benchmark, and only saves work. The join is salted,
so a passage that any share of all documents holds is spread over tasks.

Null text has no words. Null item ids count for hits but not for ``n_items``.
Repeated or null doc_ids give a row each; extra columns are ignored; an empty
table on either side gives no hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from castledger.llm.common import Tables, documents_of
from castledger.llm.textwords import WordHashes, alnum_words, shingles

WINDOW, SHINGLE = 10, 5
#: Bits of the filter: 4 MB, broadcast.
FILTER_BITS = 25
SALTS = 16

ITEM_WINDOWS = "item_id string, words string, n int, size int, shingles array<long>"
SHINGLE_COUNTS = pa.schema([("size", pa.int32()), ("shingle", pa.int64()), ("n", pa.int64())])
FOUND = pa.struct([("size", pa.int32()), ("shingle", pa.int64()), ("place", pa.int64()),
                   ("before", pa.int32()), ("words", pa.list_(pa.string()))])
SCANNED = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()),
                     ("found", pa.list_(FOUND))])
SCANNED_SQL = ("row long, doc_id long, n_words long, found array<struct<size: int, shingle: long, "
               "place: long, before: int, words: array<string>>>")


def item_windows(benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """One row per window of each item, with the hashes of its shingles in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            rows = []
            for item, text in zip(*(c.to_pylist() for c in batch.columns)):
                words = alnum_words(text)
                if not words:
                    continue
                n = min(window, len(words))
                size = min(shingle, n)
                own = shingles(hashes.of(words), size).view(np.int64)
                for at in range(len(words) - n + 1):
                    rows.append((item, b" ".join(words[at:at + n]).decode(), n, size,
                                 own[at:at + n - size + 1].tolist()))
            yield pa.record_batch([pa.array(list(c), t) for c, t in zip(
                zip(*rows) if rows else [[]] * 5,
                (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.list_(pa.int64())))],
                names=["item_id", "words", "n", "size", "shingles"])

    return benchmark.select(benchmark["item_id"].cast("string").alias("item_id"),
                            benchmark["text"].cast("string").alias("text")
                            ).mapInArrow(run, ITEM_WINDOWS)


def bit_filter(values: DataFrame, name: str, bits: int) -> np.ndarray:
    """``2 ** bits`` bits, whatever the set; those of the column's values are set."""
    rows = (values.select(F.shiftrightunsigned(name, 64 - bits).alias("at"))
            .groupBy(F.shiftright("at", 6).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits"))
            .toPandas())
    words = np.zeros(1 << (bits - 6), np.int64)
    words[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return words.view(np.uint64)


def may_have(filtered: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes >> np.uint64(64 - (len(filtered).bit_length() + 5))
    return (filtered[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) > 0


def count_shingles(docs: DataFrame, sizes: list[int], filtered) -> DataFrame:
    """(size, shingle, occurrences): how often shingles that pass the filter occur in all
    documents, added up within each task first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, bits = WordHashes(), filtered.value
        for batch in batches:
            found = {size: [] for size in sizes}
            for text in batch.column(1):
                own = hashes.of(alnum_words(text.as_py()))
                for size in sizes:
                    own_shingles = shingles(own, size)
                    found[size].append(own_shingles[may_have(bits, own_shingles)])
            for size, parts in found.items():
                values, n = np.unique(np.concatenate(parts or [np.empty(0, np.uint64)]),
                                      return_counts=True)
                yield pa.record_batch([pa.array(np.full(len(values), size, np.int32)),
                                       pa.array(values.view(np.int64)),
                                       pa.array(n.astype(np.int64))], schema=SHINGLE_COUNTS)

    return (docs.mapInArrow(run, "size int, shingle long, n long")
            .groupBy("size", "shingle").agg(F.sum("n").alias("occurrences")))


def scan(docs: DataFrame, sizes: list[int], filtered, window: int) -> DataFrame:
    """One row per document with its candidate shingles and the words around."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, bits = WordHashes(), filtered.value
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                counts, found = [], []
                for text in part.column(1).to_pylist():
                    words = alnum_words(text)
                    own = hashes.of(words)
                    here = []
                    for size in sizes:
                        values = shingles(own, size)
                        for p in np.flatnonzero(may_have(bits, values)).tolist():
                            first = max(0, p - window + size)
                            here.append({"size": size, "shingle": int(values[p].view(np.int64)),
                                         "place": p, "before": p - first,
                                         "words": [w.decode("utf-8", "replace")
                                                   for w in words[first:p + window]]})
                    counts.append(len(words))
                    found.append(here)
                yield pa.record_batch([
                    pa.array(np.arange(row, row + len(counts))), part.column(0),
                    pa.array(counts, pa.int64()), pa.array(found, pa.list_(FOUND))],
                    schema=SCANNED)
                row += len(counts)

    return docs.mapInArrow(run, SCANNED_SQL)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  shingle: int = SHINGLE, filter_bits: int = FILTER_BITS) -> DataFrame:
    """(doc_id, n_words, n_hit, hits, items) of every document: its words, those
    inside an occurrence of a window, the merged hit runs [first, end) in words,
    and the sorted ids of the items with such windows."""
    spark = docs.sparkSession
    context, tables = spark.sparkContext, Tables(spark, "decontaminate")
    docs = documents_of(docs)
    windows = tables.keep(item_windows(benchmark, window, shingle))
    members = windows.select("words", "n", "size", F.posexplode("shingles").alias("offset", "shingle"))
    sizes = sorted(r[0] for r in windows.select("size").distinct().collect())  # shingle sizes at most

    rarity = count_shingles(docs, sizes, context.broadcast(
        bit_filter(members, "shingle", filter_bits)))
    prefix = tables.keep(
        members.distinct().join(rarity, ["size", "shingle"], "left")
        .groupBy("words", "n", "size")
        .agg(F.min(F.struct(F.coalesce("occurrences", F.lit(0)), "shingle", "offset")).alias("rarest"))
        .select("words", "n", "size", "rarest.shingle", "rarest.offset"))

    scanned = tables.keep(scan(docs, sizes, context.broadcast(
        bit_filter(prefix, "shingle", filter_bits)), window))
    places = scanned.select("row", F.explode("found").alias("f")).select(
        "row", "f.*", F.pmod(F.hash("row", "f.place"), F.lit(SALTS)).alias("salt"))
    salted = prefix.select("n", "size", "shingle", "offset", F.col("words").alias("wanted"),
                           F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    start = F.col("before") - F.col("offset")
    hits = tables.keep(
        places.join(salted, ["size", "shingle", "salt"])
        .where((start >= 0) & (start + F.col("n") <= F.size("words")))
        .where(F.array_join(F.slice("words", start + 1, F.col("n")), " ") == F.col("wanted"))
        .select("row", (F.col("place") - F.col("offset")).alias("first"),
                (F.col("place") - F.col("offset") + F.col("n")).alias("end"), "wanted").distinct())

    # merged runs: a hit opens one unless an earlier hit reaches it
    order = Window.partitionBy("row").orderBy("first", "end")
    runs = (hits.select("row", "first", "end").distinct()
            .withColumn("reach", F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)))
            .withColumn("opens", F.when(F.col("first") <= F.col("reach"), 0).otherwise(1))
            .withColumn("run", F.sum("opens").over(order))
            .groupBy("row", "run").agg(F.min("first").alias("first"), F.max("end").alias("end"))
            .groupBy("row").agg(F.sum(F.col("end") - F.col("first")).alias("n_hit"),
                                F.sort_array(F.collect_list(F.struct("first", "end"))).alias("hits")))
    owners = windows.where("item_id is not null").select("item_id", F.col("words").alias("wanted")).distinct()
    items = (hits.select("row", "wanted").distinct().join(owners, "wanted")
             .groupBy("row").agg(F.sort_array(F.collect_set("item_id")).alias("items")))
    return (scanned.select("row", "doc_id", "n_words").join(runs, "row", "left").join(items, "row", "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("hits", F.expr("cast(array() as array<struct<first: long, end: long>>)")).alias("hits"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                          spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


OP6_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), b AS (
  SELECT item_id::VARCHAR AS item_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
), i AS (
  SELECT item_id, words, least(10, len(words)) AS n, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS pos
  FROM b WHERE len(words) > 0
), w AS (
  SELECT DISTINCT item_id, n, array_to_string(words[pos:pos + n - 1], ' ') AS win FROM i
), p AS (
  SELECT r, n, unnest(range(1, len(words) - n + 2)) AS pos, words
  FROM d, (SELECT DISTINCT n FROM w) WHERE len(words) >= n
), h AS (
  SELECT r, pos, n, win FROM (SELECT r, pos, n, array_to_string(words[pos:pos + n - 1], ' ') AS win FROM p)
  SEMI JOIN w USING (n, win)
), c AS (
  SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(pos, pos + n)) AS k FROM h) GROUP BY r
), t AS (
  SELECT r, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS sha
  FROM (SELECT DISTINCT r, item_id FROM h JOIN w USING (n, win) WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, coalesce(len(words), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, coalesce(sha, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN t USING (r)
"""
