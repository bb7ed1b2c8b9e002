"""Byte-level BPE encoding and decoding by a global distinct-word shuffle.

Pre-tokens are taken from whole texts with their positions; each distinct one
of the corpus is encoded once; its ids are joined back and the documents are
reassembled by position (``wordvalues``). Decoding joins the ids with the table
of token bytes.

Null text counts as empty: no ids, empty bytes. Rows are independent: repeated
rows, equal or null doc_ids each give a row of their own. Extra columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from castledger.llm.wordvalues import BLOCK_CHARS, _spread, per_word

ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
DECODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())),
                     ("bytes", pa.binary())])
#: Ids whose bytes are gathered at a time.
PIECE = 500_000
#: Words up to this many bytes are merged by plain scans, longer ones with a heap.
SCAN_BYTES = 48


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


def encode_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: merge the pair of lowest rank, leftmost first, until
    no pair of neighbours is a token."""
    if word in ranks:
        return [ranks[word]]
    return (_scan if len(word) <= SCAN_BYTES else _heap)(word, ranks)


def _scan(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    parts = [word[i:i + 1] for i in range(len(word))]
    pairs = [ranks.get(a + b, 1 << 60) for a, b in zip(parts, parts[1:])]
    while pairs and (low := min(pairs)) < 1 << 60:
        i = pairs.index(low)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], 1 << 60)
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], 1 << 60)
    return [ranks[p] for p in parts]


def _heap(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    n = len(word)
    end = list(range(1, n + 1))  # end of the part that starts here, 0 once merged away
    before = list(range(-1, n))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        middle = end[i]
        if not middle or middle >= n or end[middle] != stop:
            continue
        end[i], end[middle] = stop, 0
        if stop < n:
            before[stop] = i
            if (r := ranks.get(word[i:end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (left := before[i]) >= 0 and (r := ranks.get(word[left:stop])) is not None:
            heapq.heappush(heap, (r, left, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i:end[i]]])
        i = end[i]
    return out


def encode(docs: DataFrame, rank_file: str, pattern: str = public_tokenizers.PATTERN,
           block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, ids) of every document. The rank file is read on the driver and
    broadcast: its size is that of the vocabulary, whatever the corpus."""
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(rank_file))

    def valuer(words):
        table = ranks.value
        for word in words:
            yield np.array(encode_word(word, table), np.uint32)

    def shape(doc_ids, values):
        parts = list(values)
        edges = np.cumsum([0, *map(len, parts)]).astype(np.int32)
        flat = np.concatenate(parts or [np.empty(0, np.int32)])
        return pa.table([doc_ids, pa.ListArray.from_arrays(pa.array(edges), pa.array(flat, pa.int32()))], schema=ENCODED)

    return per_word(docs, pattern, valuer, shape, "doc_id long, ids array<int>",
                    block_chars=block_chars)


@dataclass(frozen=True)
class TokenBytes:
    """The token-byte table: all tokens' bytes side by side, by id."""

    flat: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray  # -1: no such id

    @staticmethod
    def of(ranks: dict[bytes, int]) -> TokenBytes:
        lengths = np.full(max(ranks.values(), default=-1) + 1, -1, np.int64)
        ordered = sorted(ranks, key=ranks.__getitem__)
        lengths[[ranks[t] for t in ordered]] = [len(t) for t in ordered]
        held = np.maximum(lengths, 0)
        return TokenBytes(np.frombuffer(b"".join(ordered), np.uint8), np.cumsum(held) - held, lengths)

    def decoded(self, ids: pa.ListArray) -> pa.Array:
        """Bytes of each list of ids; pieces of the whole batch are gathered at a time."""
        edges = ids.offsets.to_numpy()
        flat = ids.values.to_numpy(zero_copy_only=False)[edges[0]:edges[-1]]
        if len(flat) and (flat.min() < 0 or flat.max() >= len(self.lengths) or self.lengths[flat].min() < 0):
            raise KeyError("an id is not in the vocabulary")
        ends = np.concatenate([[0], np.cumsum(self.lengths[flat])])
        pieces = [flat[i:i + PIECE] for i in range(0, len(flat), PIECE)]
        data = np.concatenate([self.flat[_spread(self.starts[p], self.lengths[p])] for p in pieces] or [self.flat[:0]])
        offsets = ends[edges - edges[0]]
        whole = pa.Array.from_buffers(pa.large_binary(), len(ids), [
            None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())])
        return pc.if_else(ids.is_valid(), whole, None).cast(pa.binary())


def decode(encoded: DataFrame, rank_file: str) -> DataFrame:
    """(doc_id, ids, bytes): ids joined with the token-byte table, in order. The
    table has the vocabulary's size and is broadcast. Null ids give null bytes,
    an unknown id raises."""
    table = encoded.sparkSession.sparkContext.broadcast(TokenBytes.of(read_ranks(rank_file)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = table.value
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                yield pa.record_batch([part.column(0), part.column(1), tokens.decoded(part.column(1))], schema=DECODED)

    return encoded.select("doc_id", "ids").mapInArrow(
        run, "doc_id long, ids array<int>, bytes binary")


def digest(decoded: DataFrame, *columns: str) -> DataFrame:
    """Counts and checksums of ids and decoded bytes, beside ``columns``."""
    return decoded.select(
        *columns, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return digest(decode(encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), path), path), "doc_id")
