"""Work once per distinct word of a corpus, then bring the results back in place.

Documents are taken in blocks. A block sends each of its distinct pre-tokens
once, with its number within the block; the word shuffle brings equal pre-tokens
of all blocks side by side, a function values each distinct one once, and the
values go back to their blocks. There they meet the pre-token numbers of the
block's documents, in order of position.

A pre-token however frequent crosses the network once per block, so no key is
hot. The input is scanned twice and must give the same rows in the same order
(any file scan does); if it does not, the run fails instead of mixing blocks.
"""

from __future__ import annotations

import re
import zlib
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from functools import cache
from itertools import groupby, islice
from operator import itemgetter

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from castledger.llm.common import document_blocks, documents_of

BLOCK_CHARS = 24_000_000
#: Entries gathered before they are packed by block.
PACK_ENTRIES = 200_000

WORDS = pa.schema([("block", pa.int64()), ("number", pa.int64()), ("word", pa.binary())])
PLACES = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()),
                    ("numbers", pa.binary())])
VALUES = pa.schema([("block", pa.int64()), ("packed", pa.binary())])

#: Values each word of an ordered stream: one integer array per word.
Valuer = Callable[[Iterable[bytes]], Iterator[np.ndarray]]


class Numbers(dict):
    """Numbers words in order of first appearance."""

    def __missing__(self, word: str | bytes) -> int:
        self[word] = number = len(self)
        return number


def _pack(numbers: np.ndarray) -> bytes:
    """Byte planes compress far better than whole integers."""
    return zlib.compress(np.ascontiguousarray(
        numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


@cache
def _below_17_bits() -> str:
    """``public_tokenizers.PATTERN`` for Python's own, faster engine: its classes spelled out
    as ``regex`` has them, for texts without characters beyond 16 bits."""
    every = "".join(map(chr, range(1 << 16)))
    letters, numbers, spaces = (
        "".join(rf"\u{run.start():04x}-\u{run.end() - 1:04x}" for run in regex.finditer(kind, every))
        for kind in (r"\p{L}+", r"\p{N}+", r"\s+"))
    return (rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{spaces}{letters}{numbers}]+"
            rf"|[{spaces}]+(?![^{spaces}])|[{spaces}]+")


def finder(pattern: str) -> Callable[[str], list[str]]:
    """``findall`` of the pattern."""
    find = regex.compile(pattern).findall
    if pattern != public_tokenizers.PATTERN:
        return find
    quick, beyond = re.compile(_below_17_bits()).findall, re.compile("[\U00010000-\U0010ffff]").search
    return lambda text: quick(text) if text.isascii() or not beyond(text) else find(text)


def _words(pattern: str, chars: int):
    def rows(block: int, seen: Numbers) -> Iterator[pa.RecordBatch]:
        words = iter(seen)
        for at in range(0, len(seen), 20_000):
            part = [w.encode() for w in islice(words, 20_000)]
            yield pa.record_batch([
                pa.array(np.full(len(part), block)),
                pa.array(np.arange(at, at + len(part))),
                pa.array(part, pa.binary())], schema=WORDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = finder(pattern)
        for block, docs in groupby(document_blocks(batches, chars), itemgetter(0)):
            seen = Numbers()
            for _, _, text in docs:
                deque(map(seen.__getitem__, find(text)), 0)
            yield from rows(block, seen)
    return run


def _places(pattern: str, chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = finder(pattern)
        for block, docs in groupby(document_blocks(batches, chars), itemgetter(0)):
            seen = Numbers()
            ids, packed = [], []
            for _, doc, text in docs:
                found = find(text)
                ids.append(doc)
                packed.append(_pack(np.fromiter(map(seen.__getitem__, found), np.uint32,
                                                len(found))))
            yield pa.record_batch([
                pa.array([block] * len(ids), pa.int64()), pa.array(ids, pa.int64()),
                pa.array([len(seen)] * len(ids), pa.int64()),
                pa.array(packed, pa.binary())], schema=PLACES)
    return run


def _valued(valuer: Valuer):
    def distinct(batches, entries):
        """Each word once; ``entries`` remembers what asks for it."""
        last, count = None, -1
        for batch in batches:
            blocks, numbers = (batch.column(i).to_numpy() for i in (0, 1))
            which = np.empty(len(blocks), np.int64)
            for row, word in enumerate(batch.column(2).to_pylist()):
                if word != last:
                    last, count = word, count + 1
                    yield word
                which[row] = count
            entries.append((blocks, numbers, which))

    def flush(entries, values, base):
        blocks, numbers, which = (np.concatenate(x) for x in zip(*entries))
        order = np.argsort(blocks, kind="stable")
        blocks, numbers, which = blocks[order], numbers[order], which[order] - base
        edges = np.r_[np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]]), len(blocks)]
        packed = []
        for a, b in zip(edges[:-1], edges[1:]):
            own = [values[i] for i in which[a:b]]
            lengths = np.fromiter(map(len, own), np.uint32, len(own))
            head = np.array([len(own)], np.uint32)
            packed.append(_pack(np.concatenate([head, numbers[a:b].astype(np.uint32), lengths,
                                                *own]).astype(np.uint32)))
        return pa.record_batch([pa.array(blocks[edges[:-1]]), pa.array(packed, pa.binary())],
                               schema=VALUES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries: list = []
        values: list[np.ndarray] = []
        base = 0
        for value in valuer(distinct(batches, entries)):
            # whole batches are noted only when all their words have been asked for
            values.append(value)
            if len(entries) and sum(len(e[0]) for e in entries) >= PACK_ENTRIES:
                yield flush(entries, values, base)
                # the batch being read refers to the word just valued and maybe the one before
                base, values = base + len(values) - 2, values[-2:]
                entries.clear()
        if entries:
            yield flush(entries, values, base)
    return run


def _meet(shape):
    def run(key, places: pa.Table, values: pa.Table) -> pa.Table:
        n_words = places.column("n_words")[0].as_py() if len(places) else -1
        lengths = np.zeros(max(n_words, 0), np.int64)
        parts = []
        for packed in values.column("packed").to_pylist():
            data = _unpack(packed)
            n = int(data[0])
            parts.append((data[1:1 + n], data[1 + n:1 + 2 * n], data[1 + 2 * n:]))
        if sum(len(p[0]) for p in parts) != max(n_words, 0):
            raise RuntimeError("the input gave other rows when it was read again; write it first")
        for number, length, _ in parts:
            lengths[number] = length
        starts = np.cumsum(lengths) - lengths
        flat = np.empty(int(lengths.sum()), np.int32)
        for number, length, value in parts:
            flat[_spread(starts[number], length.astype(np.int64))] = value
        return shape(places.column("doc_id"),
                     (_gather(_unpack(x), starts, lengths, flat)
                      for x in places.column("numbers").to_pylist()))
    return run


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of each run, one run after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def _gather(numbers, starts, lengths, flat):
    return flat[_spread(starts[numbers], lengths[numbers])]


def per_word(docs: DataFrame, pattern: str, valuer: Valuer, shape, schema: str,
             prefix_bytes: int | None = None, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Apply ``valuer`` to the corpus's distinct matches of ``pattern``.

    ``valuer`` gets the distinct words of a shuffle partition in byte order.
    ``shape`` gets a block's doc_ids and, for each document, the values of its
    words joined in order, and returns the rows. With ``prefix_bytes``, words
    that share so many leading bytes are shuffled together.
    """
    docs = documents_of(docs)
    words = docs.mapInArrow(_words(pattern, block_chars), "block long, number long, word binary")
    key = F.col("word") if prefix_bytes is None else F.substring("word", 1, prefix_bytes)
    values = (words.repartition(F.xxhash64(key)).sortWithinPartitions("word")
              .mapInArrow(_valued(valuer), "block long, packed binary"))
    places = docs.mapInArrow(_places(pattern, block_chars),
                             "block long, doc_id long, n_words long, numbers binary")
    return (places.groupBy("block").cogroup(values.groupBy("block"))
            .applyInArrow(_meet(shape), schema))
