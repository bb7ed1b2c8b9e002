"""Exact substring deduplication: bytes covered by a string of ``length`` bytes
that also starts in a document with a smaller doc_id.

Equal strings must meet in one task without shipping a string per byte. Each
window of ``length`` bytes has an anchor, the 20-byte piece inside it with the
least hash; equal windows have equal anchors. Consecutive windows with one anchor
form a fragment.

1. Each block of documents sends its distinct anchors, sorted and packed, by hash
   range; those found in two blocks come back as a bitmap.
2. Blocks send the distinct fragments at anchors of two documents or more, each
   with its least doc_id. Fragments with one anchor meet in a task, which finds
   equal windows by backward extension of intervals on a Burrows-Wheeler
   transform (``bwt``) and the least doc_id of each.
3. The least ids return to the blocks, which remove what is covered.

Blocks combine before every shuffle, so copies in any number send one row per
block. An anchor with many fragments in a block, or in many blocks, is split
further: its windows travel one by one, keyed by their own content.

Null text counts as empty. Rows are independent: equal doc_ids don't remove from
each other, a null doc_id neither removes nor loses bytes. Extra columns are
ignored. The input is scanned three times and must give the same rows in the same
order (any file scan does); if it does not, the run fails.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from castledger.llm.bwt import least_owner
from castledger.llm.common import Tables, document_blocks, documents_of, partitions
from castledger.llm.textwords import mix, sliding_min
from castledger.llm.wordvalues import Numbers

LENGTH, ANCHOR = 50, 20
BLOCK_CHARS = 8_000_000
#: Symbols that one transform covers (a whole group of fragments at least).
CHUNK = 1_000_000
#: An anchor with more fragments in a block, or in more blocks, is split.
BUSY_FRAGMENTS, BUSY_BLOCKS = 32, 256
#: Windows hashed at a time: their arrays fit into a core's cache.
_SEGMENT = 1 << 15
_NO_ID = np.iinfo(np.int64).max
_BYTE = np.random.default_rng(50).integers(0, 2**63, 256, dtype=np.uint64)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)

ANCHORS = "block long, part long, n long, anchors binary, busy binary"
TEXTS = "block long, doc_ids array<long>, sizes array<long>, packed binary"
FRAGMENTS = "block long, anchor long, number int, fragment binary, least long, last long"
DECIDED = "block long, number array<int>, first array<int>, least array<long>"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def _anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window: place and hash of its anchor, the leftmost of equal ones."""
    spread = length - ANCHOR + 1
    n = max(len(data) - length + 1, 0)
    places, found = np.empty(n, np.int64), np.empty(n, np.uint64)
    for at in range(0, n, _SEGMENT):
        stop = min(at + _SEGMENT, n)
        one = _BYTE[data[at:stop + length - 1]]
        two = one[:-1] * _FACTOR + one[1:]
        four = two[:-2] * (_FACTOR ** np.uint64(2)) + two[2:]
        eight = four[:-4] * (_FACTOR ** np.uint64(4)) + four[4:]
        sixteen = eight[:-8] * (_FACTOR ** np.uint64(8)) + eight[8:]
        pieces = mix(sixteen[:-4] * (_FACTOR ** np.uint64(4)) + four[16:])
        # the place in the low bits makes the least value the leftmost
        keys = (pieces & ~np.uint64(0xFFFFFF)) | np.arange(len(pieces), dtype=np.uint64)
        least = sliding_min(keys, spread) & np.uint64(0xFFFFFF)
        places[at:stop] = least.astype(np.int64) + at
        found[at:stop] = pieces[least]
    return places, found


class Block:
    """Texts of a block and their fragments: runs of windows with one anchor."""

    def __init__(self, data: bytes, sizes: np.ndarray, doc_ids: np.ndarray, length: int):
        self.data, self.sizes, self.length = data, sizes, length
        self.bytes = np.frombuffer(data, np.uint8)
        self.starts = np.cumsum(sizes) - sizes
        places, hashes = _anchors(self.bytes, length)
        text = np.repeat(np.arange(len(sizes)), np.maximum(sizes - length + 1, 0))
        windows = np.maximum(sizes - length + 1, 0)
        ends = np.cumsum(windows)
        at = np.repeat(self.starts - (ends - windows), windows) + np.arange(len(text))
        places = places[at]
        opens = np.flatnonzero(np.r_[True, (places[1:] != places[:-1]) | (text[1:] != text[:-1])]
                               if len(at) else [])
        self.first = at[opens]
        self.count = np.diff(np.r_[opens, len(at)])
        self.anchor = hashes[self.first]
        self.text = text[opens]
        self.doc = doc_ids[self.text] if len(opens) else np.empty(0, np.int64)
        self.distinct, self.which = np.unique(self.anchor, return_inverse=True)

    def in_two_texts(self) -> np.ndarray:
        """Which distinct anchors stand in more than one text."""
        low = np.full(len(self.distinct), _NO_ID)
        high = np.full(len(self.distinct), -1)
        np.minimum.at(low, self.which, self.text)
        np.maximum.at(high, self.which, self.text)
        return low < high

    def busy(self, limit: int) -> np.ndarray:
        """Which distinct anchors have more than ``limit`` different fragments."""
        busy = np.bincount(self.which, minlength=len(self.distinct)) > limit
        at = np.flatnonzero(busy[self.which])
        own: dict[int, set[bytes]] = {}
        for a, f, c in zip(*(x[at].tolist() for x in (self.which, self.first, self.count))):
            own.setdefault(a, set()).add(self.data[f:f + c + self.length - 1])
        for a, contents in own.items():
            busy[a] = len(contents) > limit
        return busy

    def pieces(self, shared: np.ndarray, split: np.ndarray):
        """Fragments at shared anchors, single windows at split ones: (first,
        count, number) of each, and the distinct contents in order of number
        with their keys."""
        taken = shared[self.which]
        alone = split[self.which] & taken
        whole = taken & ~alone
        counts = self.count[alone]
        ends = np.cumsum(counts)
        first = np.concatenate([self.first[whole], np.repeat(self.first[alone] - (ends - counts), counts)
                                + np.arange(counts.sum())])
        count = np.concatenate([self.count[whole], np.ones(counts.sum(), np.int64)])
        text = np.concatenate([self.text[whole], np.repeat(self.text[alone], counts)])
        numbers, data = Numbers(), self.data
        ends = first + count + self.length - 1
        number = np.fromiter((numbers[data[f:e]] for f, e in zip(first.tolist(), ends.tolist())), np.int64, len(first))
        keys = np.empty(len(numbers), np.uint64)
        keys[number[:whole.sum()]] = self.anchor[whole]
        content = list(numbers)
        for i in np.unique(number[whole.sum():]).tolist():
            keys[i] = int.from_bytes(hashlib.blake2b(content[i], digest_size=8).digest(), "little")
        return first, count, text, number, content, keys


def _blocks(batches, chars: int, length: int) -> Iterator[tuple[int, Block, np.ndarray]]:
    for block, docs in groupby(document_blocks(batches, chars), itemgetter(0)):
        ids, texts = [], []
        for _, doc, text in docs:
            ids.append(doc)
            texts.append(text.encode("utf-8", "surrogatepass"))
        yield block, b"".join(texts), [len(t) for t in texts], ids


def _ids(ids: list[int | None]) -> np.ndarray:
    return np.array([_NO_ID if x is None else x for x in ids], np.int64)


def _pack_sorted(values: np.ndarray) -> bytes:
    """Differences of sorted values, in byte planes."""
    steps = np.diff(values, prepend=np.uint64(0))
    return zlib.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _unpack_sorted(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _bits(flags: np.ndarray) -> bytes:
    return zlib.compress(np.packbits(flags).tobytes(), 1)


def _flags(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(data), np.uint8), count=n).astype(bool)


def block_anchors(docs: DataFrame, parts_bits: int, chars: int, length: int, busy: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, data, sizes, ids in _blocks(batches, chars, length):
            block = Block(data, np.array(sizes, np.int64), _ids(ids), length)
            part = block.distinct >> np.uint64(64 - parts_bits)
            edges = np.searchsorted(part, np.arange((1 << parts_bits) + 1, dtype=np.uint64))
            flags = block.busy(busy)
            used = [p for p in range(1 << parts_bits) if edges[p] < edges[p + 1]]
            yield pa.record_batch([
                pa.array([number] * len(used), pa.int64()), pa.array(used, pa.int64()),
                pa.array([int(edges[p + 1] - edges[p]) for p in used], pa.int64()),
                pa.array([_pack_sorted(block.distinct[edges[p]:edges[p + 1]]) for p in used], pa.binary()),
                pa.array([_bits(flags[edges[p]:edges[p + 1]]) for p in used], pa.binary())],
                names=["block", "part", "n", "anchors", "busy"])

    return docs.mapInArrow(run, ANCHORS)


def shared_anchors(anchors: DataFrame, busy_blocks: int) -> DataFrame:
    """Per block and part: which of its anchors another block has too, and which
    are to be split."""
    def run(table: pa.Table) -> pa.Table:
        counts = np.array(table.column("n").to_pylist())
        values = np.concatenate([_unpack_sorted(x.as_py()) for x in table.column("anchors")])
        busy = np.concatenate([_flags(x.as_py(), n) for x, n in zip(table.column("busy"), counts)])
        _, which, blocks = np.unique(values, return_inverse=True, return_counts=True)
        split = blocks > busy_blocks
        split[which[busy]] = True
        ends = np.cumsum(counts)
        ranges = [slice(e - n, e) for e, n in zip(ends, counts)]
        return pa.table([
            table.column("block"), table.column("part"), table.column("n"),
            pa.array([_bits((blocks > 1)[which[r]]) for r in ranges], pa.binary()),
            pa.array([_bits(split[which[r]]) for r in ranges], pa.binary())],
            names=["block", "part", "n", "shared", "split"])

    return anchors.groupBy("part").applyInArrow(
        run, "block long, part long, n long, shared binary, split binary")


def block_texts(docs: DataFrame, chars: int, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, data, sizes, ids in _blocks(batches, chars, length):
            yield pa.record_batch([
                pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                pa.array([sizes], pa.list_(pa.int64())), pa.array([zlib.compress(data, 1)], pa.binary())],
                names=["block", "doc_ids", "sizes", "packed"])

    return docs.mapInArrow(run, TEXTS)


def _pieces(texts: pa.Table, marks: pa.Table, length: int):
    if len(texts) != 1:
        raise RuntimeError("the input gave other rows when it was read again; write it first")
    ids = texts.column("doc_ids")[0].as_py()
    block = Block(zlib.decompress(texts.column("packed")[0].as_py()),
                  np.array(texts.column("sizes")[0].as_py(), np.int64), _ids(ids), length)
    marks = sorted(zip(*(marks.column(c).to_pylist() for c in ("part", "n", "shared", "split"))))
    if sum(m[1] for m in marks) != len(block.distinct):
        raise RuntimeError("the input gave other rows when it was read again; write it first")
    none = [np.zeros(0, bool)]
    shared = np.concatenate([_flags(m[2], m[1]) for m in marks] or none) | block.in_two_texts()
    split = np.concatenate([_flags(m[3], m[1]) for m in marks] or none)
    return ids, block, block.pieces(shared, split)


def block_fragments(texts: DataFrame, marks: DataFrame, length: int) -> DataFrame:
    """Distinct fragments of each block with the least and last id that has them."""
    def run(key, texts: pa.Table, marks: pa.Table) -> pa.Table:
        ids, block, (_, _, text, number, content, keys) = _pieces(texts, marks, length)
        doc = _ids(ids)[text]
        least = np.full(len(content), _NO_ID)
        last = np.full(len(content), np.iinfo(np.int64).min)
        np.minimum.at(least, number, doc)
        np.maximum.at(last, number, np.where(doc == _NO_ID, np.iinfo(np.int64).min, doc))
        n = len(content)
        return pa.table([
            pa.array(np.full(n, key[0].as_py())), pa.array(keys.view(np.int64)),
            pa.array(np.arange(n, dtype=np.int32)), pa.array(content, pa.binary()),
            pa.array(least), pa.array(last)],
            names=["block", "anchor", "number", "fragment", "least", "last"])

    return texts.groupBy("block").cogroup(marks.groupBy("block")).applyInArrow(run, FRAGMENTS)


def decide(fragments: DataFrame, length: int, chunk: int) -> DataFrame:
    """Least id of each window of the fragments, as runs, for the blocks that have
    a larger id there."""
    def solve(contents, anchors, which, block, number, least, last):
        owners = np.full(len(contents), _NO_ID)
        np.minimum.at(owners, which, least)
        sizes = np.fromiter(map(len, contents), np.int64, len(contents)) - length + 1
        ends = np.cumsum(sizes)
        window = np.repeat(owners, sizes)
        # a fragment whose anchor no other one has can't share a window with another
        several = np.isin(anchors, *[a[c > 1] for a, c in [np.unique(anchors, return_counts=True)]])
        if several.any():
            window[np.repeat(several, sizes)] = least_owner(
                [c for c, s in zip(contents, several) if s], owners[several], length)
        opens = np.r_[True, window[1:] != window[:-1]]
        opens[(ends - sizes)] = True
        runs = np.flatnonzero(opens)
        content_of = np.repeat(np.arange(len(contents)), sizes)[runs]
        first = runs - (ends - sizes)[content_of]
        run_ends = np.searchsorted(content_of, np.arange(len(contents)), "right")
        run_counts = np.bincount(content_of, minlength=len(contents))
        lowest = np.minimum.reduceat(window, ends - sizes)
        rows = np.flatnonzero(lowest[which] < last)
        rows = rows[np.argsort(block[rows], kind="stable")]
        counts = run_counts[which[rows]]
        stops = np.cumsum(counts)
        at = np.repeat(run_ends[which[rows]] - stops, counts) + np.arange(stops[-1] if len(stops) else 0)
        edges = np.flatnonzero(np.r_[True, block[rows][1:] != block[rows][:-1]]) if len(rows) else []
        offsets = np.r_[(stops - counts)[edges], stops[-1:]].astype(np.int32) if len(rows) else np.zeros(1, np.int32)

        def lists(values):
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))

        return pa.record_batch([
            pa.array(block[rows][edges].astype(np.int64) if len(rows) else np.empty(0, np.int64)),
            lists(np.repeat(number[rows], counts).astype(np.int32)),
            lists(first[at].astype(np.int32)), lists(window[runs][at])],
            names=["block", "number", "first", "least"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contents, anchors, rows, size = [], [], [], 0
        for batch in batches:
            columns = (c.to_pylist() for c in batch.columns)
            for block, anchor, number, fragment, least, last in zip(*columns):
                if not contents or anchor != anchors[-1] or fragment != contents[-1]:
                    if size >= chunk and anchor != anchors[-1]:
                        table = np.array(rows, np.int64)
                        yield solve(contents, np.array(anchors), *table.T)
                        contents, anchors, rows, size = [], [], [], 0
                    contents.append(fragment)
                    anchors.append(anchor)
                    size += len(fragment) + 1
                rows.append((len(contents) - 1, block, number, least, last))
        if rows:
            yield solve(contents, np.array(anchors), *np.array(rows, np.int64).T)

    return (fragments.repartition("anchor").sortWithinPartitions("anchor", "fragment")
            .mapInArrow(run, DECIDED))


def remove_covered(texts: DataFrame, marks: DataFrame, decided: DataFrame, length: int) -> DataFrame:
    """What is left of every text."""
    both = marks.withColumn("decided", F.lit(None).cast("struct<number: array<int>, first: array<int>, least: array<long>>"))
    both = both.unionByName(decided.select("block", F.struct("number", "first", "least").alias("decided")),
                            allowMissingColumns=True)

    def run(key, texts: pa.Table, rows: pa.Table) -> pa.Table:
        is_mark = rows.column("part").is_valid()
        ids, block, (start, count, text, number, content, _) = _pieces(texts, rows.filter(is_mark), length)
        found = [x.as_py() for x in rows.filter(pa.compute.invert(is_mark)).column("decided")]
        run_number, run_first, run_least = (
            np.array([v for x in found for v in x[c]], np.int64) for c in ("number", "first", "least"))
        order = np.lexsort((run_first, run_number))
        run_number, run_first, run_least = run_number[order], run_first[order], run_least[order]
        # the runs of each piece's number, and where each run ends
        low = np.searchsorted(run_number, number, "left")
        runs = np.searchsorted(run_number, number, "right") - low
        stops = np.cumsum(runs)
        piece = np.repeat(np.arange(len(number)), runs)
        at = np.repeat(low - (stops - runs), runs) + np.arange(len(piece))
        begin = run_first[at]
        end = count[piece]
        more = np.flatnonzero(piece[1:] == piece[:-1])
        end[more] = begin[more + 1]
        doc = _ids(ids)[text[piece]]
        goes = (run_least[at] < doc) & (doc != _NO_ID)
        edge = np.zeros(len(block.bytes) + 1, np.int64)
        np.add.at(edge, start[piece][goes] + begin[goes], 1)
        np.add.at(edge, start[piece][goes] + end[goes] + length - 1, -1)
        gone = np.cumsum(edge[:-1]) > 0
        out = []
        for doc_id, at, size in zip(ids, block.starts.tolist(), block.sizes.tolist()):
            own = gone[at:at + size]
            spans = int(own[:1].sum() + (own[1:] & ~own[:-1]).sum())
            out.append((doc_id, size, int(own.sum()), spans, block.bytes[at:at + size][~own].tobytes()))
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.table([pa.array(list(c), t) for c, t in zip(zip(*out), types)],
                        names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return texts.groupBy("block").cogroup(both.groupBy("block")).applyInArrow(run, RESULT)


def suffix_dedup(docs: DataFrame, length: int = LENGTH, block_chars: int = BLOCK_CHARS,
                 chunk: int = CHUNK, busy_fragments: int = BUSY_FRAGMENTS,
                 busy_blocks: int = BUSY_BLOCKS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of every document; ``kept`` are
    the remaining bytes. ``length`` is at least 32."""
    docs = documents_of(docs)
    parts_bits = max(1, (4 * partitions(docs.sparkSession) - 1).bit_length())
    marks = Tables(docs.sparkSession, "suffix").keep(shared_anchors(
        block_anchors(docs, parts_bits, block_chars, length, busy_fragments), busy_blocks))
    texts = block_texts(docs, block_chars, length)
    decided = decide(block_fragments(texts, marks, length), length, chunk)
    return remove_covered(texts, marks, decided, length)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
