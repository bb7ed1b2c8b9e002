r"""Ranked lexical search with MaxScore on joint maxima of term pairs.

The queries are taken in blocks of bounded size, and for each block of them:

* **Index.** One scan of the documents cuts them into blocks and keeps, per block,
  the postings of the queries' terms. Document frequencies and lengths are added
  up over all blocks; then each posting gets its impact, the share of the score it
  brings, and each list its maximum. For pairs of terms that neighbour in a query
  when its terms are ordered by frequency, the two lists are intersected and the
  largest joint impact is stored. The index holds every document and is written
  before it is searched.
* **Search.** Each task goes through its blocks and keeps the best documents of
  every query. A query's terms are ordered by their maxima; those whose combined
  bound stays below the score to beat can't lift a document on their own, so
  candidates come from the other lists only, and are dropped as soon as what they
  have and the bound of the rest is too little. Two terms with a stored pair count
  with the most that one document gets from them: their joint maximum or that of
  one alone, which is less than the sum of both maxima. A block in which all terms
  together stay below is skipped.
* The best of all tasks are ranked by Spark.

All arithmetic but the weights' logarithm is on 64-bit integers, and a candidate
is dropped only if its bound is strictly below the score to beat, so the result
is that of scoring every document.

Null and empty texts have no terms: such documents are never found, such items
find nothing. Each row of items is ranked on its own, so repeated item ids, like
null ones, give a ranking each. Rows that repeat a doc_id are ranked each; null
doc_ids come last among equal scores. Extra columns are ignored. Without items
or without documents there are no rows. A text of any length is read as a whole.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import groupby, repeat
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from castledger.llm.common import Tables, document_blocks, documents_of
from castledger.llm.textwords import alnum_words

BEST = 20
BLOCK_CHARS = 24_000_000
#: Items searched at a time; their terms are broadcast.
ITEMS_AT_A_TIME = 2_000
#: A term is paired with so many of its neighbours.
NEIGHBOURS = 2
SALTS = 64

_POSTINGS = ("doc_ids", "null_ids", "lengths", "terms", "starts", "docs", "tfs")
_BOUNDS = ("doc_ids", "null_ids", "terms", "starts", "docs", "impacts", "maxima", "pairs", "joint")
FOUND = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])


# -- the index -------------------------------------------------------------------------------

def postings(docs: DataFrame, terms: dict[bytes, int], chars: int) -> DataFrame:
    """One row per block of documents: how many have terms, all their terms, and
    the postings of ``terms``, by term and document. Documents without any of them
    need no place."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for block, texts in groupby(document_blocks(batches, chars), itemgetter(0)):
            ids, lengths, found = [], [], []
            some = total = 0
            for _, doc, text in texts:
                words = alnum_words(text)
                own = np.fromiter(map(number, words, repeat(-1)), np.int32, len(words))
                some, total = some + (len(words) > 0), total + len(words)
                own = own[own >= 0]
                if len(own):
                    ids.append(doc)
                    lengths.append(len(words))
                    found.append(own)
            flat = np.concatenate(found or [np.empty(0, np.int32)]).astype(np.int64)
            of = np.repeat(np.arange(len(ids)), [len(x) for x in found])
            entries, tfs = np.unique((flat << 32) | of, return_counts=True)
            held, starts = np.unique(entries >> 32, return_index=True)
            arrays = (np.array([x or 0 for x in ids], np.int64), np.array([x is None for x in ids], np.int8),
                      np.array(lengths, np.int64), held.astype(np.int32), np.append(starts, len(entries)).astype(np.int32),
                      (entries & 0xFFFFFFFF).astype(np.int32), tfs.astype(np.int32))
            yield pa.record_batch([pa.array([block]), pa.array([some]), pa.array([total]),
                                   *(pa.array([a.tobytes()], pa.binary()) for a in arrays)],
                                  names=["block", "some", "total", *_POSTINGS])

    return docs.mapInArrow(run, "block long, some long, total long, " + ", ".join(f"{c} binary" for c in _POSTINGS))


def frequencies(blocks: DataFrame) -> dict[int, int]:
    """Document frequency by term number; -1 and -2 are the documents that have
    terms and all their terms. As many numbers as the queries have terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                terms, starts = np.frombuffer(row["terms"], np.int32), np.frombuffer(row["starts"], np.int32)
                yield pa.record_batch([pa.array(np.append(terms, [-1, -2]).astype(np.int32)),
                                       pa.array(np.append(np.diff(starts), [row["some"], row["total"]]).astype(np.int64))],
                                      names=["term", "n"])

    rows = (blocks.select("some", "total", "terms", "starts").mapInArrow(run, "term int, n long")
            .groupBy("term").agg(F.sum("n").alias("n")).collect())
    return {r["term"]: r["n"] for r in rows}


def weight(documents: int, frequency: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency + 1)))


def query_pairs(terms: dict[int, int], weights: np.ndarray) -> set[tuple[int, int]]:
    """Pairs of an item's terms that neighbour when ordered by weight."""
    order = sorted(terms, key=lambda t: (weights[t], t))
    return {(min(p), max(p)) for step in range(1, NEIGHBOURS + 1) for p in zip(order, order[step:])}


def with_bounds(blocks: DataFrame, weights: np.ndarray, pairs: np.ndarray, documents: int, total: int) -> DataFrame:
    """The blocks with the impact of each posting, the largest one of each list,
    and the largest joint impact of each pair of lists that have a document in
    common. ``pairs`` are numbers of rows of the given pairs."""
    shared = blocks.sparkSession.sparkContext.broadcast((weights, pairs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, pairs = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in _POSTINGS}
                lengths = np.frombuffer(row["lengths"], np.int64)
                terms, starts, docs, tfs = (np.frombuffer(row[c], np.int32) for c in ("terms", "starts", "docs", "tfs"))
                length = 100 - 25 + (25 * lengths * documents) // max(total, 1)
                tf = tfs.astype(np.int64)
                impacts = (np.repeat(weights[terms], np.diff(starts))
                           * ((1_000_000_000 * tf) // (1000 * tf + 12 * length[docs])))
                maxima = np.maximum.reduceat(impacts, starts[:-1]) if len(terms) else impacts
                numbers, joint = joint_maxima(pairs, terms, starts, docs, impacts)
                yield pa.record_batch([pa.array([x], pa.binary()) for x in (
                    row["doc_ids"], row["null_ids"], row["terms"], row["starts"], row["docs"],
                    impacts.tobytes(), maxima.tobytes(), numbers.tobytes(), joint.tobytes())], names=list(_BOUNDS))

    return blocks.select(*_POSTINGS).mapInArrow(run, ", ".join(f"{c} binary" for c in _BOUNDS))


def joint_maxima(pairs: np.ndarray, terms: np.ndarray, starts: np.ndarray, docs: np.ndarray,
                 impacts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the pairs whose lists intersect, and the largest sum of impacts
    of a document of the intersection."""
    if not len(terms) or not len(pairs):
        return np.empty(0, np.int32), np.empty(0, np.int64)
    place = np.searchsorted(terms, pairs).clip(max=len(terms) - 1)
    numbers, joint = [], []
    for number in np.flatnonzero((terms[place] == pairs).all(axis=1)).tolist():
        a, b = sorted(place[number], key=lambda t: starts[t + 1] - starts[t])
        few, many = docs[starts[a]:starts[a + 1]], docs[starts[b]:starts[b + 1]]
        at = np.searchsorted(many, few).clip(max=len(many) - 1)
        both = np.flatnonzero(many[at] == few)
        if len(both):
            numbers.append(number)
            joint.append((impacts[starts[a]:starts[a + 1]][both] + impacts[starts[b]:starts[b + 1]][at[both]]).max())
    return np.array(numbers, np.int32), np.array(joint, np.int64)


# -- the search ------------------------------------------------------------------------------

def prefix_bounds(most: list[int], times: list[int], maxima: list[int], joint: dict[tuple[int, int], int | None]) -> list[int]:
    """For each number of leading terms, the most that one document can get from
    them. ``most`` are times * maxima, rising. ``joint`` has the pairs of places
    that are stored, with their joint maximum, 0 if no document has both. A term
    is matched with the earlier free one that lowers the bound most."""
    partners: dict[int, list[tuple[int, int]]] = {}
    for (a, b), value in joint.items():
        partners.setdefault(max(a, b), []).append((min(a, b), value))
    bounds, matched = [0], set()
    for place, own in enumerate(most):
        saved, with_ = 0, None
        for other, value in partners.get(place, ()):
            if other in matched:
                continue
            # with unequal factors, the surplus of one counts with its own maximum
            least = min(times[place], times[other])
            both = value * least + (times[place] - least) * maxima[place] + (times[other] - least) * maxima[other] if value else 0
            saving = own + most[other] - max(both, own, most[other])
            if saving > saved:
                saved, with_ = saving, other
        if with_ is not None:
            matched |= {place, with_}
        bounds.append(bounds[-1] + own - saved)
    return bounds


class _Best:
    """The best documents of one item so far."""

    def __init__(self, count: int):
        self.count = count
        self.scores = np.empty(0, np.int64)
        self.ids = np.empty(0, np.int64)
        self.nulls = np.empty(0, np.int8)

    @property
    def to_beat(self) -> int:
        """A lower score is of no use."""
        return int(self.scores[-1]) if len(self.scores) == self.count else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        scores, ids, nulls = (np.concatenate(x) for x in ((self.scores, scores), (self.ids, ids), (self.nulls, nulls)))
        order = np.lexsort((ids, nulls, -scores))[:self.count]
        self.scores, self.ids, self.nulls = scores[order], ids[order], nulls[order]


class _Block:
    """A block of the index, read for searching."""

    def __init__(self, row: dict[str, bytes], pairs: np.ndarray):
        self.ids, self.nulls = np.frombuffer(row["doc_ids"], np.int64), np.frombuffer(row["null_ids"], np.int8)
        terms, self.starts, self.docs = (np.frombuffer(row[c], np.int32) for c in ("terms", "starts", "docs"))
        self.impacts, self.maxima = (np.frombuffer(row[c], np.int64) for c in ("impacts", "maxima"))
        self.place = {t: i for i, t in enumerate(terms.tolist())}
        stored = pairs[np.frombuffer(row["pairs"], np.int32)]
        self.joint = dict(zip(map(tuple, stored.tolist()), np.frombuffer(row["joint"], np.int64).tolist()))
        self.sums = np.zeros(len(self.ids), np.int64)

    def list_of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        at = slice(self.starts[self.place[term]], self.starts[self.place[term] + 1])
        return self.docs[at], self.impacts[at]

    def search(self, terms: dict[int, int], paired: set[tuple[int, int]], best: _Best) -> None:
        """Add the documents that can be among the best."""
        most = {t: q * int(self.maxima[self.place[t]]) for t, q in terms.items() if t in self.place}
        order = sorted(most, key=lambda t: (most[t], t))
        place = {t: i for i, t in enumerate(order)}
        joint = {(place[a], place[b]): self.joint.get((a, b), 0) for a, b in paired if a in place and b in place}
        bounds = prefix_bounds([most[t] for t in order], [terms[t] for t in order],
                               [int(self.maxima[self.place[t]]) for t in order], joint)
        to_beat = best.to_beat
        first = next((i for i in range(len(order)) if bounds[i + 1] >= to_beat), None)
        if first is None:
            return
        sums = self.sums
        for term in order[first:]:
            docs, impacts = self.list_of(term)
            sums[docs] += terms[term] * impacts
        found = np.flatnonzero(sums)
        scores = sums[found]
        sums[found] = 0
        for i in range(first - 1, -1, -1):
            kept = scores + bounds[i + 1] >= to_beat
            found, scores = found[kept], scores[kept]
            if not len(found):
                return
            docs, impacts = self.list_of(order[i])
            at = np.searchsorted(docs, found).clip(max=len(docs) - 1)
            scores += np.where(docs[at] == found, terms[order[i]] * impacts[at], 0)
        kept = scores >= to_beat
        best.add(scores[kept], self.ids[found[kept]], self.nulls[found[kept]])


def best_documents(index: DataFrame, items: list[dict[int, int]], paired: list[set[tuple[int, int]]],
                   pairs: np.ndarray, best: int) -> DataFrame:
    """(item, doc_id, score): each task's best documents of each item."""
    shared = index.sparkSession.sparkContext.broadcast((items, pairs, paired))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, pairs, paired = shared.value
        kept = [_Best(best) for _ in items]
        for batch in batches:
            for i in range(batch.num_rows):
                block = _Block({c: batch.column(c)[i].as_py() for c in _BOUNDS}, pairs)
                for terms, own, held in zip(items, paired, kept):
                    block.search(terms, own, held)
        for item, held in enumerate(kept):
            if len(held.scores):
                yield pa.record_batch([pa.array(np.full(len(held.scores), item, np.int32)),
                                       pa.array(held.ids, mask=held.nulls.astype(bool)), pa.array(held.scores)], schema=FOUND)

    return index.mapInArrow(run, "item int, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, best: int = BEST, block_chars: int = BLOCK_CHARS,
           items_at_a_time: int = ITEMS_AT_A_TIME) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``best`` highest-scoring documents of
    each item, equal scores by doc_id."""
    spark = docs.sparkSession
    tables, docs = Tables(spark, "lexical"), documents_of(docs)
    asked = tables.keep(items.select(items["item_id"].alias("item_id"), items["text"].cast("string").alias("text"))
                        .withColumn("row", F.monotonically_increasing_id()))
    rounds = max(1, math.ceil(asked.count() / items_at_a_time))
    found = None
    for number in range(rounds):
        # hashed rows: about ``items_at_a_time``, whatever the number of items
        queries = asked.where(F.pmod(F.xxhash64("row"), F.lit(rounds)) == number).select("row", "text").collect()
        own = _round(docs, [(r["row"], r["text"]) for r in queries], best, block_chars, tables)
        if own is not None:
            found = own if found is None else found.union(own)
    if found is None:
        return asked.limit(0).select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"),
                                     F.lit(0).cast("long").alias("score"))

    def ranked(rows: DataFrame, *keys: str) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)

    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    top = ranked(ranked(salted, "row", "salt").drop("rank"), "row")
    return top.join(asked.select("row", "item_id"), "row").select("item_id", "rank", "doc_id", "score")


def _round(docs: DataFrame, queries: list[tuple[int, str | None]], best: int, block_chars: int,
           tables: Tables) -> DataFrame | None:
    """(row, doc_id, score) of some of the items."""
    spark = docs.sparkSession
    words = [(row, Counter(alnum_words(text))) for row, text in queries]
    numbers = {t: i for i, t in enumerate(sorted(set().union(*(c for _, c in words))))}
    if not numbers:
        return None
    blocks = tables.keep(postings(docs, numbers, block_chars))
    counts = frequencies(blocks)
    documents, total = counts.get(-1, 0), counts.get(-2, 0)
    weights = np.array([weight(documents, counts.get(t, 0)) for t in range(len(numbers))], np.int64)
    items = [{numbers[t]: q for t, q in own.items() if numbers[t] in counts} for _, own in words]
    paired = [query_pairs(own, weights) for own in items]
    pairs = np.array(sorted(set().union(*paired)), np.int32).reshape(-1, 2)
    index = tables.keep(with_bounds(blocks, weights, pairs, documents, total))
    tables.drop(blocks)
    rows = spark.createDataFrame([(i, row) for i, (row, _) in enumerate(queries)], "item int, row long")
    found = tables.keep(best_documents(index, items, paired, pairs, best).join(F.broadcast(rows), "item").select("row", "doc_id", "score"))
    tables.drop(index)
    return found


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                  spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS terms
  FROM documents
), b AS (
  SELECT row_number() OVER () AS i, item_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS terms
  FROM benchmark
), q AS (
  SELECT i, term, count(*) AS q FROM (SELECT i, unnest(terms) AS term FROM b) GROUP BY ALL
), c AS (
  SELECT count(*)::BIGINT AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM d WHERE len(terms) > 0
), t AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) GROUP BY ALL
), w AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM t, c GROUP BY term, n_docs
), m AS (
  SELECT r, doc_id, 100 - 25 + (25 * len(terms) * n_docs) // n_terms AS m FROM d, c WHERE len(terms) > 0
), s AS (
  SELECT i, r, sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM q JOIN t USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY i, r
), k AS (
  SELECT i, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank
  FROM s JOIN m USING (r) WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM k JOIN b USING (i) WHERE rank <= 20
"""
