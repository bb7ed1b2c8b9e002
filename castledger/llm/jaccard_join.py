r"""N-gram Jaccard join by grouped prefixes, closed to components.

A document's set holds the hashes of its distinct word shingles; equal sets form
a class, of which one member goes on.

* **Who can link at all.** A set with a partner has enough shingles that other
  documents have too. That is counted exactly, without moving sets: a block of
  documents sends its shingles as sorted, packed keys to the task of their range,
  which returns how many of each document occur elsewhere. Keys are cut to 48
  bits: a false match only lets a document through to the next step. Equal sets
  leave a block once.
* **Groups.** The sets that are left are joined by prefixes of their rarest
  shingles, sets of the same prefix and size collapsed into one group
  (``prefix_groups``): pairs of groups are filtered, then expanded to members,
  which are verified on full sets.

Only components are asked for, so sets that are known to be connected are not
compared again. No list is cut, and no pair that could join two components is
left out.

Null and empty texts have an empty set and link with nothing. Rows that repeat a
doc_id are one vertex: their classes are linked. Rows without doc_id get no
component. Extra columns are ignored; an empty table gives an empty result. A
text of any length is one set.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from castledger.llm import prefix_groups
from castledger.llm.common import Tables, document_blocks, documents_of, partitions
from castledger.llm.wordsets import full_sets, set_id, shingle_set
from castledger.llm.textwords import WordHashes

BLOCK_CHARS = 12_000_000
#: Bits of a shingle's key while occurrences are counted.
KEY_BITS = 48

SCANNED = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("number", pa.int64()), ("doc_id", pa.int64()),
                     ("n", pa.int64()), ("set_id", pa.binary()), ("packed", pa.binary())])
SCANNED_SQL = "part int, block long, number long, doc_id long, n long, set_id binary, packed binary"
SIGNED = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("set_id", pa.binary()), ("shared", pa.int64())])


# -- which documents share enough -----------------------------------------------------------

def _planes(values: np.ndarray, width: int) -> bytes:
    """Byte planes of unsigned numbers: those of high places are mostly zero, and
    Spark's compression of shuffled rows removes them."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _numbers(data: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(width, -1)
    whole = np.zeros((planes.shape[1], 8), np.uint8)
    whole[:, :width] = planes.T
    return whole.view("<u8").ravel()


def _pack(keys: np.ndarray, numbers: np.ndarray) -> bytes:
    """Sorted keys as differences, and their documents' numbers."""
    return _planes(np.diff(keys, prepend=np.uint64(0)), KEY_BITS // 8) + _planes(numbers, 4)


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(data) // (KEY_BITS // 8 + 4)
    return (np.cumsum(_numbers(data[:n * KEY_BITS // 8], KEY_BITS // 8), dtype=np.uint64),
            _numbers(data[n * KEY_BITS // 8:], 4))


def _scan(size: int, parts: int, chars: int):
    """Each document's class, and each block's shingles by range of keys."""
    def rows(part, block, number, doc_id, n, ids, packed) -> pa.RecordBatch:
        count = len(part)
        return pa.record_batch([pa.array(part, pa.int32()), pa.array([block] * count, pa.int64()),
                                *(pa.array(x, t) for x, t in ((number, pa.int64()), (doc_id, pa.int64()), (n, pa.int64()),
                                                              (ids, pa.binary()), (packed, pa.binary())))], schema=SCANNED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        edges = np.array([(i << KEY_BITS) // parts for i in range(1, parts)], np.uint64)
        for block, docs in groupby(document_blocks(batches, chars), itemgetter(0)):
            doc_ids, counts, ids, keys, seen = [], [], [], [], set()
            for _, doc, text in docs:
                members = shingle_set(text, hashes, size)
                own = set_id(members) if len(members) else None
                fresh = own is not None and own not in seen
                seen.add(own)
                doc_ids.append(doc)
                counts.append(len(members))
                ids.append(own)
                keys.append(members >> np.uint64(64 - KEY_BITS) if fresh else members[:0])
            numbers = np.arange(len(ids))
            empty = [None] * len(ids)
            yield rows(((numbers + block) % parts).astype(np.int32), block, numbers, doc_ids, counts, ids, empty)
            numbers = np.repeat(numbers.astype(np.uint32), [len(k) for k in keys])
            flat = np.concatenate(keys)
            del keys
            order = np.argsort(flat)
            flat, numbers = flat[order], numbers[order]
            at = np.r_[0, np.searchsorted(flat, edges), len(flat)]
            held = np.flatnonzero(at[1:] > at[:-1]).tolist()
            for some in (held[i:i + 64] for i in range(0, len(held), 64)):
                empty = [None] * len(some)
                yield rows(some, block, empty, empty, empty, empty,
                           [_pack(flat[at[p]:at[p + 1]], numbers[at[p]:at[p + 1]]) for p in some])
    return run


def _elsewhere(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For the blocks of each range of keys, how many keys of a document occur in
    another one too; rows of documents pass."""
    held: dict[int, list[tuple[int, bytes]]] = {}
    for batch in batches:
        packed = batch.column("packed").is_valid()
        yield batch.filter(pc.invert(packed))
        own = batch.filter(packed)
        for part, block, data in zip(*(own.column(c).to_pylist() for c in ("part", "block", "packed"))):
            held.setdefault(part, []).append((block, data))
    for part in list(held):
        blocks, packed = zip(*held.pop(part))
        keys, numbers = zip(*map(_unpack, packed))
        of_block = np.repeat(np.arange(len(blocks)), [len(k) for k in keys])
        keys, numbers = np.concatenate(keys), np.concatenate(numbers)
        order = np.argsort(keys, kind="stable")
        keys, of_block, numbers = keys[order], of_block[order], numbers[order]
        same = keys[1:] == keys[:-1]
        shared = np.r_[same, False] | np.r_[False, same]
        found, times = np.unique((of_block[shared].astype(np.uint64) << np.uint64(32)) | numbers[shared], return_counts=True)
        edges = np.searchsorted(found, np.arange(len(blocks) + 1, dtype=np.uint64) << np.uint64(32))
        rows = [(blocks[i], _planes(found[a:b] & np.uint64(0xFFFFFFFF), 4) + _planes(times[a:b], 4))
                for i, (a, b) in enumerate(zip(edges[:-1], edges[1:])) if b > a]
        empty = [None] * len(rows)
        yield pa.record_batch([pa.array([part] * len(rows), pa.int32()), pa.array([r[0] for r in rows], pa.int64()),
                               *(pa.array(empty, t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.binary())),
                               pa.array([r[1] for r in rows], pa.binary())], schema=SCANNED)


def _tally(rows: pa.Table) -> pa.Table:
    """A block's documents with the number of their shingles that occur elsewhere."""
    docs = rows.filter(pc.is_null(rows.column("packed")))
    counts = np.zeros(len(docs), np.int64)
    for data in rows.column("packed").drop_null().to_pylist():
        numbers, times = _numbers(data[:len(data) // 2], 4), _numbers(data[len(data) // 2:], 4)
        counts[numbers.astype(np.int64)] += times.astype(np.int64)
    return pa.table([docs.column("doc_id"), docs.column("n"), docs.column("set_id"),
                     pa.array(counts[docs.column("number").to_numpy()])], schema=SIGNED)


def signed(docs: DataFrame, size: int, chars: int, tables: Tables) -> DataFrame:
    """(doc_id, n, set_id, shared) of every document. ``shared`` is, for one row at
    least of each class, at least the size of its overlap with any other class."""
    parts = partitions(docs.sparkSession)
    scanned = docs.mapInArrow(_scan(size, parts, chars), SCANNED_SQL).repartitionById(parts, "part")
    tallied = tables.keep(scanned.mapInArrow(_elsewhere, SCANNED_SQL))
    rows = tables.keep(tallied.groupBy("block").applyInArrow(_tally, "doc_id long, n long, set_id binary, shared long"))
    tables.drop(tallied)
    return rows


# -- the operator ---------------------------------------------------------------------------

def jaccard_join(docs: DataFrame, size: int = 5, percent: int = 80, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document, for shingles of
    ``size`` words and a Jaccard similarity of at least ``percent`` / 100."""
    tables = Tables(docs.sparkSession, "jaccard")
    docs = documents_of(docs)
    rows = signed(docs, size, block_chars, tables)
    tables.release()
    known = rows.where("set_id is not null and doc_id is not null")
    classes = tables.keep(known.groupBy("set_id").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"),
                                                      F.max("shared").alias("shared")))
    able = tables.keep(classes.where(F.col("shared") >= prefix_groups.least_overlap(F.col("n"), percent)).select("set_id", "doc_id"))

    sets = tables.keep(prefix_groups.with_longs(full_sets(docs, able, size)))
    labels = prefix_groups.connected(sets, percent, tables)

    # rows that repeat a doc_id link their classes
    repeated = known.groupBy("doc_id").agg(F.min("set_id").alias("v"), F.max("set_id").alias("m")).where("v < m")
    named = classes.select("set_id", "doc_id").join(labels, "set_id", "left").select(
        "set_id", "doc_id", F.coalesce("label", "set_id").alias("label"))
    same_id = known.join(repeated, "doc_id").select(F.col("set_id").alias("a"), F.col("v").alias("b")).distinct()
    named = named.select("doc_id", "set_id").join(
        prefix_groups.relabelled(named.select("set_id", "label"), same_id, tables), "set_id")
    least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    named = tables.keep(named.join(least, "label").select("set_id", "component_id"))
    return rows.join(named, "set_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP12_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + least(5, len(words)) - 1], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i
        FROM w WHERE len(words) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * shared >= 80 * (x.n + y.n - shared)
), r AS (
  SELECT doc_id, doc_id AS reached FROM n
  UNION
  SELECT r.doc_id, l.b FROM r JOIN l ON r.reached = l.a
), c AS (
  SELECT doc_id, min(reached) AS component_id FROM r GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""
